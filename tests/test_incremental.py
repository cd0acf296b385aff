"""Incremental views equal the full ones after each batch, and read and write changed seasons only."""

import random

import pytest

from gridline.operators import analytics as A
from gridline.plans import incremental as I
from gridline.plans import race_views as V
from gridline.session import scratch_path
from gridline.sinks import snapshots as S

SCHEMA = ("season int, round int, driver_id long, constructor_id long, session_type string, points double, "
          "final_position int, status string")
KEYS = ["season", "round", "driver_id", "session_type"]
CFG = V.RaceConfig(min_season=2000)


def rows(rng, seasons, rounds, drivers):
    return [(s, r, d, d % 3, t, float(rng.choice([0, 0, 1, 2.5, 25, -1])), rng.randrange(1, 23), rng.choice(["Finished", "+1 Lap", "Out"]))
            for s in seasons for r in rounds for d in drivers for t in ("RACE", "SPRINT") if rng.random() < 0.6]


def upsert(spark, fact, data):
    df = spark.createDataFrame(data, SCHEMA)
    S.upsert_table(df, fact, KEYS, [c for c in df.columns if c not in KEYS], ["season", "round"])


def full(spark, st):
    base = A.in_scope(S.read_table(spark, st.fact), "season", CFG.min_season, ["RACE", "SPRINT"])
    e = st.entity
    pts = A.step_totals(base, ["season", "round", e], "points", "round_points")
    series = A.cumulative_rank(pts, "season", "round", e, "round_points", "cumulative_points", "entity_rank", st.densify)
    totals = A.step_totals(base, ["season", e], "points", "total_points")
    return series, totals, A.finish_histogram(V._classified(base), ["season", e], "final_position", "round")


def same(a, b):
    cols = sorted(b.columns)
    key = lambda df: sorted(str(tuple(r)) for r in df.select(*cols).collect())
    return key(a) == key(b)


@pytest.mark.parametrize("entity, densify", [("driver_id", True), ("constructor_id", False)])
def test_equals_the_full_view_after_each_batch(spark, entity, densify):
    rng = random.Random(9)
    st = I.ViewState(scratch_path(spark, "state"), scratch_path(spark, "fact"), entity, densify)
    batches = [rows(rng, [1999, 2001, 2002], [1, 2, 3], range(5)), rows(rng, [2001], [3, 4, 5], range(4)),
               rows(rng, [2002], [2], range(9)), rows(rng, [2003], [1], range(3)), rows(rng, [2001], [1], [0, 11])]
    before = {}
    for n, data in enumerate(batches):
        upsert(spark, st.fact, data)
        I.refresh(spark, st)
        series, totals, finishes = full(spark, st)
        assert same(S.read_table(spark, st.series).filter("season >= 2000"), series)
        points, hist = I.standing_parts(spark, st, CFG)
        assert same(points, totals) and same(hist, finishes)
        now = {t: dict(S.version(spark, t).folders) for t in (st.totals, st.series, st.seasons)}
        changed = {t: {k.split("/")[0] for k in f if f[k] != before.get(t, {}).get(k)} for t, f in now.items()}
        if n:
            assert all(c == {f"season={data[0][0]}"} for c in changed.values())
        before = now
    assert I.refresh(spark, st) == S.version(spark, st.fact).number
    assert {t: dict(S.version(spark, t).folders) for t in before} == before         # nothing new: nothing written


def test_a_refresh_that_died_is_caught_up(spark, monkeypatch):
    rng = random.Random(3)
    st = I.ViewState(scratch_path(spark, "state"), scratch_path(spark, "fact"), "driver_id", True)
    upsert(spark, st.fact, rows(rng, [2001], [1, 2], range(4)))
    I.refresh(spark, st)
    upsert(spark, st.fact, rows(rng, [2001], [2, 3], range(6)))
    with monkeypatch.context() as m:
        m.setattr(I, "_advance_series", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            I.refresh(spark, st)
    upsert(spark, st.fact, rows(rng, [2002], [1], range(6)))
    I.refresh(spark, st)
    series, totals, _ = full(spark, st)
    assert same(S.read_table(spark, st.series), series) and same(I.standing_parts(spark, st, CFG)[0], totals)


def test_only_changed_folders_of_the_fact_are_opened(spark, monkeypatch):
    rng = random.Random(5)
    st = I.ViewState(scratch_path(spark, "state"), scratch_path(spark, "fact"), "driver_id", True)
    upsert(spark, st.fact, rows(rng, [2001, 2002], [1, 2, 3], range(4)))
    I.refresh(spark, st)
    upsert(spark, st.fact, rows(rng, [2002], [3], range(4)))
    opened, read = [], S._open
    monkeypatch.setattr(S, "_open", lambda spark, path, v, only=None: (opened.append((path, only)), read(spark, path, v, only))[1])
    I.refresh(spark, st)
    assert ([o for p, o in opened if p == st.fact]) == [["season=2002/round=3"]]
    assert all(o is not None and all(k.startswith("season=2002") for k in o) for p, o in opened)
