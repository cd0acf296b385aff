"""Hand-made frames for the view semantics: ties, nulls, one-word names, sprint-only drivers."""

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from gridline.functions import short_name, title_case
from gridline.operators import analytics as A
from gridline.plans import race_views as V

FACT = ("season INT, round INT, constructor_id STRING, driver_id STRING, grid_position INT, points DOUBLE, "
        "final_position INT, status STRING, session_type STRING")


def gold(spark, fact_rows, drivers=None, constructors=None):
    fact = spark.createDataFrame(fact_rows, FACT).withColumns({
        "is_win": F.col("final_position") == 1, "is_podium": F.col("final_position").between(1, 3),
        "has_points": F.col("points") > 0, "is_pole": F.col("grid_position") == 1})
    ids = sorted({r[3] for r in fact_rows})
    cons = sorted({r[2] for r in fact_rows})
    dd = drivers or [(d, d.title() + " Driver", "Nation") for d in ids]
    cc = constructors or [(c, c.title() + " Team", "Nation") for c in cons]
    races = sorted({(r[0], r[1]) for r in fact_rows})
    return SimpleNamespace(
        fact=fact,
        dim_drivers=spark.createDataFrame(dd, "driver_id STRING, driver_name STRING, nationality STRING"),
        dim_constructors=spark.createDataFrame(cc, "constructor_id STRING, constructor_name STRING, nationality STRING"),
        dim_races=spark.createDataFrame([(s, r, f"R{r} Grand Prix", f"C{r}", "X") for s, r in races],
                                        "season INT, round INT, race_name STRING, circuit_name STRING, country STRING"),
        ref_color=spark.createDataFrame([("red", "#FF0000", "red.svg")],
                                        "constructor_id STRING, color_code STRING, logo_svg STRING"),
        ref_driver_code=spark.createDataFrame([("d1", "DON")], "driver_id STRING, fia_driver_code STRING"),
        ref_country_image=spark.createDataFrame([("X", "x.png")], "country STRING, flag_32_png STRING"))


CFG = V.RaceConfig(min_season=2020)


def test_countback_tie_breaks(spark):
    # d1 and d2: equal points and histogram; d1 won first (round 1) -> ahead.
    # d3 and d4: identical in everything but the id -> d3 ahead. d5: points, no classified finish -> last.
    rows = [
        (2024, 1, "red", "d1", 1, 25.0, 1, "Finished", "RACE"), (2024, 2, "red", "d1", 2, 0.0, 5, "Engine", "RACE"),
        (2024, 1, "blue", "d2", 2, 0.0, 5, "Engine", "RACE"), (2024, 2, "blue", "d2", 1, 25.0, 1, "Finished", "RACE"),
        (2024, 1, "g", "d3", 3, 10.0, 3, "+1 Lap", "RACE"), (2024, 1, "g", "d4", 4, 10.0, 3, "+1 Lap", "RACE"),
        (2024, 1, "g", "d5", 5, 40.0, None, None, "SPRINT"), (2024, 2, "g", "d5", 5, 0.0, 7, "Lapped", "RACE"),
    ]
    st = {r.driver_id: r.standing for r in V.driver_standings(gold(spark, rows), CFG).collect()}
    assert st == {"d5": 1, "d1": 2, "d2": 3, "d3": 4, "d4": 5}


def test_group_winners_keep_ties(spark):
    rows = [(2024, 1, "red", "d1", 1, 10.0, 1, "Finished", "RACE"),
            (2024, 1, "blue", "d2", 2, 10.0, 2, "Finished", "RACE"),
            (2024, 1, "g", "d3", 3, 5.0, 3, "Finished", "RACE")]
    w = V.constructor_round_wins(gold(spark, rows), CFG).collect()
    assert sorted(r.constructor_id for r in w) == ["blue", "red"]
    assert {r.final_position for r in w} == {1}
    red = [r for r in w if r.constructor_id == "red"][0]
    blue = [r for r in w if r.constructor_id == "blue"][0]
    assert red.cons_logo == "red.svg" and blue.cons_logo is None and blue.color_code == CFG.default_color


def test_switch_team_latest_attribution_and_fan_out(spark):
    rows = [(2024, 1, "red", "d1", 1, 1.0, 1, "Finished", "RACE"),
            (2024, 2, "blue", "d1", 1, 1.0, 1, "Finished", "RACE"),
            (2024, 2, "red", "d1", 1, 1.0, 1, "Finished", "RACE")]     # two teams in the last round
    g = gold(spark, rows)
    ref = sorted(r.constructor_id for r in V.constructor_reference(g, CFG).collect())
    assert ref == ["blue", "red"]
    one = A.latest_attribution(g.fact, ["season", "driver_id"], "round", "constructor_id", ties="one").collect()
    assert [r.constructor_id for r in one] == ["blue"]


def test_sprint_only_driver_has_null_colour_and_zero_filled_rounds(spark):
    rows = [(2024, 1, "red", "d1", 1, 25.0, 1, "Finished", "RACE"),
            (2024, 3, "red", "d1", 1, 25.0, 1, "Finished", "RACE"),
            (2024, 2, "red", "d2", 1, 8.0, 1, "Finished", "SPRINT")]
    evo = V.driver_evolution(gold(spark, rows), CFG).collect()
    d2 = sorted((r["round"], r.round_points, r.cumulative_points, r.color_code) for r in evo if r.driver_id == "d2")
    assert d2 == [(1, 0.0, 0.0, None), (2, 8.0, 8.0, None), (3, 0.0, 8.0, None)]
    d1 = sorted((r["round"], r.cumulative_points, r.driver_rank) for r in evo if r.driver_id == "d1")
    assert d1 == [(1, 25.0, 1), (2, 25.0, 1), (3, 50.0, 1)]


def test_status_mix_in_stats_and_standings(spark):
    st = ["Finished", "Lapped", "+1 Lap", "+2 Laps", "Engine", None]
    rows = [(2024, i + 1, "red", "d1", 2, 1.0, 2, s, "RACE") for i, s in enumerate(st)]
    stats = V.driver_stats(gold(spark, rows), CFG).collect()[0]
    assert stats["dnf/dns/dsq"] == -1                     # only Engine; Lapped and null are not DNFs
    stand = V.driver_standings(gold(spark, rows), CFG).collect()[0]
    assert stand.standing == 1
    hist = A.finish_histogram(V._classified(gold(spark, rows).fact), ["season", "driver_id"], "final_position",
                              "round").collect()[0]
    assert hist.p2 == 3                                   # Finished, +1 Lap, +2 Laps (not Lapped, not null)


def test_null_position_flags_are_null(spark):
    rows = [(2024, 1, "red", "d1", None, None, None, "Engine", "RACE")]
    r = gold(spark, rows).fact.collect()[0]
    assert (r.is_win, r.is_podium, r.has_points, r.is_pole) == (None, None, None, None)


@pytest.mark.parametrize("name,expected", [
    ("Max Emilian Verstappen", "M. Verstappen"), ("Zhou", "Z. "), (None, None), ("Jean-eric Vergne", "J. Vergne"),
    ("Patrick O'ward", "P. O'ward"), ("Sergio Pérez", "S. Pérez")])
def test_short_name(spark, name, expected):
    df = spark.createDataFrame([(name,)], "n STRING")
    assert df.select(short_name("n").alias("s")).collect()[0].s == expected


def test_title_case_splits_on_spaces_only(spark):
    df = spark.createDataFrame([("jean-eric vERGNE",)], "n STRING")
    assert df.select(title_case("n").alias("s")).collect()[0].s == "Jean-eric Vergne"
