"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks.

Words are laid out per (source, shard) in a seeded order of documents and cut into blocks of
``block_words``. All blocks of the mix are apportioned to the sources by the highest quotients
target / (2 * seats + 1), and each source's blocks to its shards in the same way by their sizes. A
shard whose quota is q of its n blocks is taken q // n times as a whole, plus q % n blocks that
follow each other from a seeded start (the order of documents being seeded, that is a seeded
choice). What a document gives is then arithmetic on its place in the shard: no block is a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ranking import rank_within
from .common import spread_join, stored, text_of, words_of

UNIT = ["src_no", "shard"]


def _draw(seed: int, *of: Column) -> Column:
    """32 seeded bits of the given values, the same in any engine that has md5."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), *[x.cast("string") for x in of])), 1, 8),
                  16, 10).cast("bigint")


def _name(docs: DataFrame) -> Column:
    """What a document is drawn by: its doc_id; rows without one go by their texts, so that they spread as well."""
    return F.coalesce(docs["doc_id"].cast("string"), F.concat(F.lit("-"), F.md5(text_of(docs))))


def draw_of(docs: DataFrame, seed: int) -> Column:
    """The seeded draw of a document."""
    return _draw(seed, _name(docs))


def _with_group(units: DataFrame, group: str, key: list[str], *sums: Column) -> DataFrame:
    """``units`` plus aggregates of their group: partial sums joined back, large groups split."""
    by = units.groupBy(group).agg(*sums, F.count(F.lit(1)).alias("__size"))
    return spread_join(units, by, [group], "__size", units.count(), F.struct(*key)).drop("__size")


def apportion(units: DataFrame, group: str, key: list[str], votes: str, seats: str) -> DataFrame:
    """Sainte-Lague within each ``group``: ``units`` (unique on ``key``) plus an integer ``quota``.

    Rounding votes * seats / all votes gives nearly all seats; the rest go to (or come from) the
    highest (lowest) quotients votes / (2k + 1). With n units in the group a unit can be off by at
    most its share of n / 2, and one, so that many quotients of each unit are enough: about 2.5 n
    rows, however many seats there are. Ties go to the lower ``key`` (numbers). A group may hold any
    number of units: its sums are partial aggregates, its quotients are numbered over ranges of them.
    ``units`` is read several times and should be a stored table.
    """
    whole = F.sum(F.col(votes).cast("decimal(38,10)")).cast("double")     # the same in any order
    u = _with_group(units, group, key, whole.alias("__all"), F.count(F.lit(1)).alias("__n"))
    share = F.when(F.col("__all") > 0, F.col(votes) / F.col("__all")).otherwise(F.lit(0.0))
    reach = (F.ceil(share * F.col("__n") / 2) + 1).cast("int")
    u = (u.withColumn("__base", F.floor(share * F.col(seats) + 0.5).cast("bigint")).withColumn("__reach", reach)
         .drop("__all", "__n"))
    u = stored(_with_group(u, group, key, (F.first(seats) - F.sum("__base")).alias("__off")), "mix-rounded")
    up = F.col("__off") > 0
    steps = F.when(up, F.col("__reach")).when(F.col("__off") < 0, F.least("__reach", F.col("__base").cast("int")))
    cand = u.filter(F.col("__off") != 0).filter(steps > 0).withColumn("__k", F.explode(F.sequence(F.lit(0), steps - 1)))
    held = F.when(up, F.col("__base") + F.col("__k")).otherwise(F.col("__base") - 1 - F.col("__k"))
    sign = F.when(up, F.lit(1)).otherwise(F.lit(-1))
    order = {"__q": -sign * F.col(votes) / (2 * held + 1), **{f"__t{i}": sign * F.col(k) for i, k in enumerate(key)}}
    cand = cand.select(*dict.fromkeys([group, *key]), "__off", *[c.alias(n) for n, c in order.items()], "__k")
    won = (rank_within(cand, [group], [(n, "asc") for n in (*order, "__k")], out="__rn", unique=True)
           .filter(F.col("__rn") <= F.abs("__off")).groupBy(*key).agg(F.count(F.lit(1)).alias("__won")))
    quota = F.col("__base") + F.coalesce(F.signum("__off") * F.col("__won"), F.lit(0)).cast("bigint")
    return u.join(won, key, "left").withColumn("quota", quota).drop("__base", "__reach", "__off", "__won")


def source_targets(sizes: DataFrame, max_repeat: int = 3) -> DataFrame:
    """(source, source_size) -> plus src_no, target: one row per source.

    Sources in code-point order, null last, weigh 1, 2, 3, repeating, and share all words; a target
    stops at ``max_repeat`` times its source and the excess is reshared by weight: the level that all
    others reach per unit of weight rises, an aggregate over the sources at a time, until no cap lies below it.
    """
    ranked = rank_within(sizes, [], [("source", "asc_nulls_last")], out="src_no", unique=True)
    ranked = (ranked.withColumn("__w", ((F.col("src_no") - 1) % 3 + 1).cast("bigint"))
              .withColumn("__cap", F.lit(max_repeat) * F.col("source_size")))
    ratio, level, n_full = F.col("__cap") / F.col("__w"), None, -1
    while True:
        full = F.lit(False) if level is None else ratio < level
        r = ranked.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum(F.when(full, F.col("__cap"))), F.lit(0)),
                       F.sum(F.when(~full, F.col("__w"))), F.count(F.when(full, 1))).first()
        if not r[2] or r[3] == n_full:
            break
        level, n_full = (r[0] - r[1]) / r[2], r[3]
    return (ranked.withColumn("target", F.least(F.col("__cap").cast("double"), F.lit(level or 0.0) * F.col("__w")))
            .select("source", "source_size", "src_no", "target"))


def plan_mix(docs: DataFrame, block_words: int = 16, shard_words: int = 1 << 20, max_repeat: int = 3,
             seed: int = 7) -> DataFrame:
    """``docs`` plus size, source_size, target, taken (words the mix takes, repeats counted) and
    ``parts``, the word ranges taken, as an array of (first, end).

    Null or empty text has size 0 and gives nothing; rows without source form a source of their own;
    repeated rows are documents each (those of one doc_id share its shard), rows without doc_id are
    drawn by their texts; an empty table gives no rows. Input columns of these names
    are replaced, others pass through.
    """
    size = F.size(words_of(text_of(docs))).cast("bigint")
    own = docs.drop("size", "source_size", "target", "taken", "parts")
    drawn = draw_of(docs, seed)
    sized = stored(docs.select(drawn.alias("draw"), docs["source"].alias("source"), size.alias("size")), "mix-sizes")
    total = sized.agg(F.sum("size")).first()[0] or 0
    shards = max(1, -(-total // shard_words))

    units = sized.groupBy("source", (F.col("draw") % shards).alias("shard")).agg(F.sum("size").alias("unit_size"))
    units = stored(units, "mix-units")
    sources = source_targets(units.groupBy("source").agg(F.sum("unit_size").alias("source_size")), max_repeat)
    sources = stored(apportion(sources.withColumn("__one", F.lit(0))
                               .withColumn("__seats", F.lit((2 * total + block_words) // (2 * block_words)).cast("bigint")),
                               "__one", ["src_no"], "target", "__seats").drop("__one", "__seats"), "mix-sources")
    u = units.join(sources.withColumnRenamed("quota", "__seats"), units["source"].eqNullSafe(sources["source"]))
    u = u.select(units["source"], "shard", "unit_size", "source_size", "target", "src_no", "__seats")
    u = apportion(stored(u, "mix-votes"), "src_no", UNIT, "unit_size", "__seats")
    n = F.ceil(F.col("unit_size") / block_words).cast("bigint")
    q = F.least(F.col("quota"), n * max_repeat)
    some = F.col("unit_size") > 0
    u = u.select("source", "shard", "unit_size", "source_size", "target",
                 F.when(some, F.floor(q / n)).otherwise(0).cast("bigint").alias("rounds"),
                 F.when(some, q % n).otherwise(0).alias("extra"), n.alias("n"),
                 F.when(some, _draw(seed, F.col("src_no"), F.col("shard")) % n).otherwise(0).alias("start"))
    u = u.withColumnsRenamed({c: f"__{c}" for c in u.columns})

    rows = own.withColumn("size", size).withColumn("__of", drawn % shards)
    seeded = F.md5(F.concat_ws(":", F.lit(str(seed)), _name(docs)))
    placed = Window.partitionBy("source", "__of").orderBy(seeded, "doc_id", "size")
    rows = rows.withColumn("__end", F.sum("size").over(placed.rowsBetween(Window.unboundedPreceding, 0)))
    rows = rows.withColumn("__first", F.col("__end") - F.col("size"))
    joined = rows.join(u, rows["source"].eqNullSafe(u["__source"]) & (F.col("__of") == F.col("__shard")))

    def meet(a: Column, b: Column) -> Column:
        """The part of the document's words within words a to b of its shard."""
        return F.struct((F.greatest(a, F.col("__first")) - F.col("__first")).alias("first"),
                        (F.least(b, F.col("__end")) - F.col("__first")).alias("end"))

    a, last = F.col("__start") * block_words, F.col("__start") + F.col("__extra")
    b = F.least(last * block_words, F.col("__unit_size"))
    over = F.greatest(last - F.col("__n"), F.lit(0)) * block_words
    whole = F.array_repeat(F.struct(F.lit(0).cast("bigint").alias("first"), F.col("size").alias("end")),
                           F.col("__rounds").cast("int"))
    parts = F.filter(F.concat(whole, F.array(meet(a, b), meet(F.lit(0).cast("bigint"), over))),
                     lambda p: p["end"] > p["first"])
    taken = F.aggregate("parts", F.lit(0).cast("bigint"), lambda s, p: s + p["end"] - p["first"])
    return (joined.withColumn("parts", parts).withColumn("taken", taken)
            .withColumnRenamed("__source_size", "source_size").withColumnRenamed("__target", "target")
            .select(*own.columns, "size", "source_size", "target", "taken", "parts"))


def mix(docs: DataFrame, **settings) -> DataFrame:
    """The mixed corpus, in the columns of ``docs``: a row per taken part of a document.

    A document taken twice is two rows; one that a block boundary cuts gives the words taken, with
    the white space between them (n_chars, if there, is counted anew); one not taken gives none.
    """
    planned = plan_mix(docs, **settings).withColumn("__part", F.explode("parts"))
    pieces = F.regexp_extract_all(text_of(planned), F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0))
    first, end = F.col("__part")["first"], F.col("__part")["end"]
    cut = F.array_join(F.slice(pieces, (first + 1).cast("int"), (end - first).cast("int")), "")
    out = planned.withColumn("__cut", end - first < F.col("size"))
    out = out.withColumn("text", F.when(F.col("__cut"), F.btrim(cut, F.lit(" \t\n\x0b\x0c\r"))).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        chars = F.length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(F.col("__cut"), chars).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)
