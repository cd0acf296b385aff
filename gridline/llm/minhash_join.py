"""Near duplicates by an inverted join of MinHash signature coordinates.

1. Each text becomes its set of 5-word shingles (64-bit hashes), a 128-bit sum over the set, and a
   signature of ``COORDS`` minima. Texts of equal sets are one class, standing for all copies.
2. Each class is posted under every (coordinate, value) of its signature. Two classes with a
   Jaccard similarity of 0.75 agree in 36 of 48 coordinates on average, and in fewer than 21 in
   less than one of a million cases (``LOSS``); that number of matches follows from the similarity asked for.
3. Prefix: with all values ordered by how many classes hold them, rarest first, two classes that
   agree in 21 values share one of the first 48 - 21 + 1 of either. So only these postings are kept,
   and values that one class alone holds fill places without being posted: most classes vanish here.
4. Skip: only lists of up to ``SHORT`` classes form their pairs. In a longer one each class is compared
   in full with the list's lead alone, which gives its missing shingles M and its further ones E. The
   lead is the class whose values are the most common ones: of texts that are copies of one, or
   hold one passage, it is nearest to what they have in common, so the differences are small. Two classes of
   a lead then share |lead| - |M| - |M'| + (elements that both differences have) shingles. If
   both are linked to the lead, nothing is left to find. If one is not, a link to any other
   needs common elements of the differences, more the further both are from the lead, so these
   pairs are found by a prefix join over the differences, rarest elements first, which gives only the
   pairs whose remaining elements could suffice. An element that
   more than ``FEW`` of these classes hold isn't joined so: its most central class is
   a lead of the next level, and 4 is done again with that. A large group of near copies, or of
   texts with one passage in common, thus costs its size, not its square.
5. The pairs of short lists, and those found in 4, count their collisions on
   whole signatures; those with enough matches are confirmed on the full shingle sets, and the
   confirmed links give the components.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import spread_join, stored, text_of
from .components import components
from .hashing import chunks, mix64, shingle_sets
from .numeric import give_back

COORDS = 48
LOSS = 1e-6       # share of the pairs at the very threshold that may have too few matches
_RNG = np.random.default_rng(75)
_FACTOR = _RNG.integers(1, 1 << 63, COORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_COORD = _RNG.integers(1, 1 << 63, COORDS, dtype=np.uint64)
BLOCK = 4096      # shingles whose minima are taken at once
SHORT = 8         # classes of a signature value's list whose pairs are formed
FEW = 1 << 12     # classes with an element of their differences in common that are held against each other


def matches_for(least: int) -> int:
    """The most matches that pairs of a similarity of ``least`` percent fall short of in ``LOSS`` of all cases at most."""
    p, below, m = least / 100, 0.0, 0
    while m < COORDS:
        below += math.comb(COORDS, m) * p**m * (1 - p)**(COORDS - m)
        if below > LOSS:
            break
        m += 1
    if not m:
        raise ValueError(f"{COORDS} coordinates can't find pairs at {least} percent; ask for a higher similarity")
    return m


def _signature(shingles: np.ndarray) -> np.ndarray:
    least = np.full(COORDS, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(shingles), BLOCK):
        hashed = np.multiply.outer(_FACTOR, shingles[i:i + BLOCK])
        least = np.minimum(least, (hashed ^ (hashed >> np.uint64(32))).min(1))
    return mix64(least ^ _COORD).view(np.int64)


def _describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Set size, set sums and signature of each text; texts without words have none."""
    for batch in batches:
        ids, fps, at = batch["doc_id"].tolist(), batch["fp"].tolist(), 0
        for part in chunks(batch["text"].tolist()):
            rows = []
            for doc_id, fp, s in zip(ids[at:], fps[at:], shingle_sets(part)):
                if len(s):
                    sums = [int(x.sum(dtype=np.uint64).view(np.int64)) for x in (mix64(s), mix64(s ^ _COORD[0]))]
                    rows.append((doc_id, fp, len(s), *sums, _signature(s)))
                else:   # a first sum of its own, so that empty texts don't meet in one partition
                    rows.append((doc_id, fp, 0, hash(doc_id), 0, None))
            at += len(part)
            out = pd.DataFrame(rows, columns=["doc_id", "fp", "n_shingles", "s1", "s2", "sig"])
            yield out.astype({"doc_id": "Int64"})
    give_back()


def _confirm(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Keep the pairs (a, b) whose texts' full sets are similar; each text of a batch is hashed once."""
    for batch in batches:
        texts = list(dict.fromkeys([*batch["text_a"], *batch["text_b"]]))
        sets = dict(zip(texts, (s for part in chunks(texts) for s in shingle_sets(part))))
        keep = []
        for a, b, least in zip(batch["text_a"], batch["text_b"], batch["least"].tolist()):
            both = len(np.intersect1d(sets[a], sets[b], assume_unique=True))
            keep.append(100 * both >= least * (len(sets[a]) + len(sets[b]) - both))
        yield batch.loc[np.array(keep, bool), ["a", "b"]]
    give_back()


def _differ(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """What each text's set lacks of its reference's (marked) and has besides."""
    for batch in batches:
        texts = list(dict.fromkeys([*batch["text"], *batch["text_ref"]]))
        sets = dict(zip(texts, (s for part in chunks(texts) for s in shingle_sets(part))))
        rows = []
        for rep, weight, ref, a, b in zip(*(batch[c].tolist() for c in ("rep", "weight", "ref", "text", "text_ref"))):
            own, base = sets[a], sets[b]
            lacks = np.setdiff1d(base, own, assume_unique=True)
            has = np.setdiff1d(own, base, assume_unique=True)
            both = np.concatenate([mix64(lacks ^ _COORD[1]), has]).view(np.int64)
            rows.append((rep, weight, ref, len(base), len(lacks), len(has), both))
        yield pd.DataFrame(rows, columns=["rep", "weight", "ref", "n_ref", "lacks", "has", "diff"])
    give_back()


DIFF = "rep bigint, weight bigint, ref bigint, n_ref bigint, lacks bigint, has bigint, diff array<bigint>"


class _Join:
    """The classes' postings, signatures and texts, and the links confirmed so far."""

    def __init__(self, classes: DataFrame, docs: DataFrame, least: int):
        self.least, self.matches = least, matches_for(least)
        tokens = classes.select("rep", F.explode("sig").alias("token"))
        lists = stored(tokens.groupBy("token").agg(F.count(F.lit(1)).alias("df")).filter("df > 1"), "minhash-lists")
        held = (self.spread(tokens, lists, ["token"])
                .groupBy("rep").agg(F.array_sort(F.collect_list(F.struct("df", "token"))).alias("t"),
                                    F.sum("df").alias("weight")))
        # The values that a class alone holds come first and take their places unposted.
        room = F.lit(COORDS - self.matches + 1) - (F.lit(COORDS) - F.size("t"))
        posted = held.filter(room > 0).select("rep", "weight", F.explode(F.slice("t", F.lit(1), room)).alias("t"))
        self.postings = stored(posted.select("rep", "weight", "t.token"), "minhash-postings")
        involved = stored(self.postings.select("rep", "weight").distinct().join(classes, "rep"), "minhash-signatures")
        self.known = involved.select("rep", "sig", "n_shingles")
        texts = docs.join(involved.select(F.col("rep").alias("doc_id"), "fp", "weight"), ["doc_id", "fp"])
        self.texts = stored(texts.select(F.col("doc_id").alias("rep"), "weight", "text").dropDuplicates(["rep", "text"]),
                            "minhash-texts")
        self.links: DataFrame | None = None

    @staticmethod
    def spread(big: DataFrame, small: DataFrame, keys: list[str]) -> DataFrame:
        """Join with a table of keys and their frequencies df, hot keys split."""
        return spread_join(big, small, keys, "df", small.agg(F.sum("df")).first()[0] or 0, F.col("rep"))

    def add(self, links: DataFrame) -> None:
        self.links = links if self.links is None else self.links.union(links)

    def roots(self) -> DataFrame:
        return components(self.links).withColumnRenamed("node", "rep")

    @staticmethod
    def lead() -> Column:
        """Of the classes of a list, the one of the largest weight, the smallest of equal ones."""
        return F.max(F.struct("weight", F.bitwise_not("rep").alias("rep"))).alias("lead")

    def led(self) -> DataFrame:
        """(rep, token, df, lead): the postings in lists of two classes or more."""
        lead = self.postings.groupBy("token").agg(F.count(F.lit(1)).alias("df"), self.lead()).filter("df > 1")
        lead = stored(lead.select("token", "df", F.bitwise_not("lead.rep").alias("lead")), "minhash-leaders")
        return stored(self.spread(self.postings.select("rep", "token"), lead, ["token"]), "minhash-led")

    def pairs_of_lists(self, led: DataFrame) -> DataFrame:
        """The pairs (a, b) of the lists of few classes."""
        few = led.filter(F.col("df") <= SHORT)
        a, b = (few.select("token", F.col("rep").alias(x)) for x in ("a", "b"))
        return a.join(b, "token").filter("a < b").select("a", "b").distinct()

    def groups(self, led: DataFrame) -> DataFrame:
        """(rep, ref): the classes of longer lists with their leads."""
        more = led.filter((F.col("df") > SHORT) & (F.col("rep") != F.col("lead")))
        return stored(more.select("rep", F.col("lead").alias("ref")).distinct(), "minhash-groups")

    def differ(self, pairs: DataFrame) -> DataFrame:
        """The difference of each class rep from the class ref; adds the links among these pairs."""
        ref = self.texts.select(F.col("rep").alias("ref"), F.col("text").alias("text_ref"))
        near = F.lit(100 - self.least) * F.col("n_ref")
        far = F.lit(100) * F.col("lacks") + F.lit(self.least) * F.col("has")
        diffs = stored(pairs.join(self.texts, "rep").join(ref, "ref").select("rep", "weight", "ref", "text", "text_ref")
                       .mapInPandas(_differ, DIFF)
                       .withColumn("far", far).withColumn("near", near), "minhash-differences")
        self.add(diffs.filter("far <= near").select(F.col("rep").alias("a"), F.col("ref").alias("b")))
        return diffs

    def lists_of(self, diffs: DataFrame) -> DataFrame:
        """(ref, el, rep, far, near, loose, rest, df, lead): lists of classes with an element in common.

        With ``far`` = 100 |M| + least |E| and ``near`` = (100 - least) |ref|, two classes are linked
        if (100 + least) * common elements >= far + far' - near. One of a new link is loose, which is
        not linked to the reference: far > near. A class's elements are ordered rarest first; if one
        is the first in common, the ``rest`` from it on must suffice, and far' is at least
        the least among the element's loose or tied holders. df counts a list's classes, lead is the lead among them.
        """
        d = diffs.withColumn("loose", F.col("far") > F.col("near"))
        elements = d.select("rep", "ref", "far", "loose", F.explode("diff").alias("el"))
        lists = elements.groupBy("ref", "el").agg(
            F.count(F.lit(1)).alias("df"), F.min(F.when(F.col("loose"), F.col("far"))).alias("loose_far"),
            F.min(F.when(~F.col("loose"), F.col("far"))).alias("tied_far"))
        lists = stored(lists.filter("df > 1 and loose_far is not null"), "minhash-elements")
        # Plain joins: of an element a group holds a row per class, which adaptive execution splits where it is skewed.
        held = (elements.select("rep", "ref", "el").join(lists, ["ref", "el"]).groupBy("rep", "ref")
                .agg(F.array_sort(F.collect_list(F.struct("df", "el", "loose_far", "tied_far"))).alias("t")))
        held = held.join(d.select("rep", "ref", "weight", "far", "near", "loose"), ["rep", "ref"])
        # Elements that a class alone holds come before those of ``t``.
        placed = F.transform("t", lambda x, i: F.struct(
            x["el"].alias("el"), (F.size("t") - i).alias("rest"),
            F.when(F.col("loose"), F.least(x["loose_far"], x["tied_far"])).otherwise(x["loose_far"]).alias("other")))
        of_use = F.filter(placed, lambda x: self.suffice(x["rest"], x["other"]))
        own = ["ref", "rep", "weight", "far", "near", "loose"]
        posted = stored(held.select(*own, F.explode(of_use).alias("e")).select(*own, "e.el", "e.rest"), "minhash-index")
        lead = posted.groupBy("ref", "el").agg(F.count(F.lit(1)).alias("df"), self.lead(), F.max("loose").alias("open"))
        lead = stored(lead.filter("df > 1 and open").select("ref", "el", "df", F.bitwise_not("lead.rep").alias("lead")),
                      "minhash-element-leaders")
        return stored(posted.drop("weight").join(lead, ["ref", "el"]), "minhash-element-lists")

    def suffice(self, common: Column, other: Column) -> Column:
        """Whether so many common elements link a class to one that is ``other`` far from their reference."""
        return F.lit(100 + self.least) * common >= F.col("far") + other - F.col("near")

    def pairs_by_difference(self, lists: DataFrame) -> DataFrame:
        """The pairs (a, b) of the lists of few classes that may be linked, one of them loose."""
        few = lists.filter(F.col("df") <= FEW)
        a = few.select("ref", "el", F.col("rep").alias("a"), "far", "near", "loose", "rest")
        b = few.select("ref", "el", F.col("rep").alias("b"), *[F.col(c).alias(f"{c}_b") for c in ("far", "loose", "rest")])
        near = self.suffice(F.least("rest", "rest_b"), F.col("far_b"))
        return a.join(b, ["ref", "el"]).filter("a < b and (loose or loose_b)").filter(near).select("a", "b").distinct()

    def regroup(self, lists: DataFrame) -> DataFrame:
        """(rep, ref): the classes of longer lists with the lead as a reference of the next level.

        A lead is before the others of its list by weight and rep, so references come later from level to level and the levels end.
        """
        more = lists.filter((F.col("df") > FEW) & (F.col("rep") != F.col("lead")))
        return stored(more.select("rep", F.col("lead").alias("ref")).distinct(), "minhash-groups")

    def confirm(self, pairs: DataFrame, name: str) -> None:
        """Add the pairs (a, b) that pass the count of collisions and the comparison of full sets."""
        def side(x: str) -> DataFrame:
            return self.known.select(F.col("rep").alias(x), F.col("sig").alias(f"sig_{x}"),
                                     F.col("n_shingles").alias(f"n_{x}"))

        def text(x: str) -> DataFrame:
            return self.texts.select(F.col("rep").alias(x), F.col("text").alias(f"text_{x}"))

        same = F.aggregate(F.zip_with("sig_a", "sig_b", lambda x, y: (x == y).cast("int")), F.lit(0),
                           lambda s, x: s + x)
        sized = 100 * F.least("n_a", "n_b") >= self.least * F.greatest("n_a", "n_b")
        near = pairs.join(side("a"), "a").join(side("b"), "b").filter(sized).filter(same >= self.matches)
        near = stored(near.select("a", "b"), f"minhash-{name}-pairs")
        both = near.join(text("b"), "b").join(text("a"), "a").withColumn("least", F.lit(self.least))
        self.add(stored(both.mapInPandas(_confirm, "a bigint, b bigint"), f"minhash-{name}-links"))

    def run(self) -> DataFrame:
        led = self.led()
        self.confirm(self.pairs_of_lists(led), "list")
        diffs = self.differ(self.groups(led))
        while not diffs.isEmpty():
            lists = self.lists_of(diffs)
            self.confirm(self.pairs_by_difference(lists), "difference")
            diffs = self.differ(self.regroup(lists))
        return self.roots()


def near_duplicates(docs: DataFrame, least: int = 75) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept): a row per row of ``docs``.

    Documents are linked if 100 * intersection >= ``least`` * union of their sets of distinct 5-word
    shingles (words lower-cased A-Z; with fewer words the whole sequence is the one shingle).
    component_id is the smallest doc_id reachable, kept whether that is the document itself. Null or
    empty texts have no shingles and are linked with nothing. Repeated rows share their component
    (rows of one doc_id with different texts go by their own text); rows without doc_id are kept,
    have no component and link nothing. Below 26 percent 48 coordinates don't suffice, which is refused. An empty table gives no rows. Other columns are not read.
    """
    d = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of(docs).alias("text"))
    d = d.withColumn("fp", F.xxhash64("text"))
    sets = stored(d.mapInPandas(
        _describe, "doc_id bigint, fp bigint, n_shingles bigint, s1 bigint, s2 bigint, sig array<bigint>"),
        "minhash-sets")
    first = F.min(F.struct("doc_id", "fp"))
    classes = sets.filter("n_shingles > 0 and doc_id is not null").groupBy("s1", "s2").agg(
        first.alias("f"), F.count(F.lit(1)).alias("n"), F.first("n_shingles").alias("n_shingles"),
        F.first("sig").alias("sig"))
    classes = stored(classes.select("s1", "s2", F.col("f.doc_id").alias("rep"), F.col("f.fp").alias("fp"), "n",
                                    "n_shingles", "sig"), "minhash-classes")
    roots = _Join(classes, d, least).run()
    found = stored(classes.select("s1", "s2", "rep", "n").join(roots, "rep", "left")
                   .select("s1", "s2", F.coalesce("root", "rep").alias("root"), "n"), "minhash-roots")
    total = found.agg(F.sum("n")).first()[0] or 0
    rows = spread_join(sets.drop("sig"), found, ["s1", "s2"], "n", total, F.struct("doc_id", "fp"), how="left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("root", "doc_id"))
    return (rows.withColumn("component_id", component)
            .withColumn("kept", F.coalesce(F.col("component_id") == F.col("doc_id"), F.lit(True)))
            .select("doc_id", "n_shingles", "component_id", "kept"))


def keep_one_of_each(docs: DataFrame, least: int = 75) -> DataFrame:
    """The rows of ``docs`` whose document is the smallest of its group, or of none.

    Rows without doc_id are in no group and stay; repeated rows of a kept document all stay.
    """
    gone = (near_duplicates(docs, least).filter(~F.col("kept")).select(F.col("doc_id").alias("__gone")).distinct())
    return docs.join(gone, docs["doc_id"].cast("bigint") == F.col("__gone"), "left_anti")
