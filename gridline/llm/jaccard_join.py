"""Jaccard join of word n-gram sets by the universe-partition pigeonhole.

Two sets a and b with a Jaccard similarity of ``least`` percent or more differ in at most
D = (|a| + |b|) (100 - least) / (100 + least) elements.

1. Texts become sets of 3-word shingles (64-bit hashes); equal sets are one class.
2. Size bands: a class belongs to the band of its size and, where it is large enough for a partner in
   the next one, to that too, so both sides of a link meet in the band of the larger. A band fixes H,
   the most that two of its sets may differ in, and how the universe is cut: elements are hashed to
   segments, and a set's part in a segment is its subset there.
3. Allocation by cost. Exact subsets: with m > H segments a linked pair has m - H equal subsets, so
   of the m subsets, ordered rarest first, one of the first D(a) + 1 of either is shared; the costly
   rest isn't indexed. One deletion: segments that also index their subset less each element meet
   where they differ in one element, so such a segment counts for two and H + 1 - d segments do, d of
   them with deletions. Bands of sets up to ``SHORT`` elements index both ways, and the rows and pairs each
   makes decide which is used; for larger sets a deletion index costs a row per element,
   and exact subsets are taken.
4. No list of an index is expanded into its pairs. Classes that hang together by the leaders of their
   lists get one reference R; a class is compared with R only, which gives its difference from R, as a
   set. Two sets' difference is the difference of their differences, so classes of one reference are
   linked by an overlap join over these: a class needs so many common elements with any partner that
   may link it to something new, and indexes its rarest ones only. Lists that span references get a
   common reference for their members and the same join. Groups of near copies, whose differences are
   small and private, cost their size, not its square.
5. Every link is confirmed on full sets: from the two texts, or as |a| + |b| less the size of the
   difference, taken from the exact differences. Components are taken over the links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import spread_join, stored, text_of
from .components import components
from .hashing import chunks, mix64, word_hashes

SIZE = 3                  # words of a shingle
GROWTH = 1.5              # sizes of a band, largest to smallest
SPARE = 8                 # segments beyond H + 1 at most
SHORT = 63                # largest sets that may index deletions
_RNG = np.random.default_rng(1390)
_PLACE = _RNG.integers(1, 1 << 63, SIZE + 1, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SALT = int(_RNG.integers(1, 1 << 62)) * 2 + 1


def shingle_sets(texts: list[bytes]) -> list[np.ndarray]:
    """Per text its distinct shingles, as sorted hashes; a text of fewer words is one shingle."""
    words, of = word_hashes(texts)
    counts = np.bincount(of, minlength=len(texts))
    ends = np.cumsum(counts)
    grams = np.zeros(0, np.uint64)
    if len(words) >= SIZE:
        m = len(words) - SIZE + 1
        grams = mix64(sum((words[j:j + m] * _PLACE[j] for j in range(1, SIZE)), words[:m] * _PLACE[0]))
    out = []
    for end, n in zip(ends.tolist(), counts.tolist()):
        if n >= SIZE:
            out.append(np.unique(grams[end - n:end - SIZE + 1]))
        elif n:
            short = sum((words[end - n + j:end - n + j + 1] * _PLACE[j] for j in range(n)), np.full(1, n, np.uint64))
            out.append(mix64(short ^ _PLACE[SIZE]))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


class Bands:
    """Size bands and their segments for a similarity of ``least`` percent."""

    def __init__(self, least: int):
        self.least = least
        # Two smaller sets are equal or not linked.
        self.first = -(-(100 + least) // (2 * (100 - least))) if least < 100 else 1 << 40
        self.growth = max(GROWTH, 101 / least)
        self.lows = [self.first]

    def low(self, band: int) -> int:
        while len(self.lows) <= band:
            self.lows.append(max(self.lows[-1] + 1, int(self.lows[-1] * self.growth)))
        return self.lows[band]

    def of(self, n: int) -> list[int]:
        """The bands in which a set of n elements may meet a partner: its own, if any, and the next
        if a partner there may be similar (as for sets just below the smallest band)."""
        band = -1
        while self.low(band + 1) <= n:
            band += 1
        both = [band] if band >= 0 else []
        return both + [band + 1] if 100 * n >= self.least * self.low(band + 1) else both

    def differ(self, band: int) -> int:
        """The most elements that two linked sets of a band differ in."""
        return 2 * (self.low(band + 1) - 1) * (100 - self.least) // (100 + self.least)

    def keys(self, s: np.ndarray, band: int, deletions: bool) -> np.ndarray:
        """The index keys of a set: of each segment's subset, by deletions also less each element of it."""
        h = self.differ(band)
        double = (h + 1) // 2 if deletions else 0
        m = h + 1 - double if deletions else h + 1 + min((h + 1) // 2, SPARE)
        salt = np.uint64(_SALT * (2 * band + deletions + 1) & (1 << 64) - 1)
        segment = (mix64(s ^ salt) >> np.uint64(32)).astype(np.int64) % m
        element = mix64(s + salt)
        sums = np.zeros(m, np.uint64)
        np.add.at(sums, segment, element)
        own = mix64(np.arange(m, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ salt)
        keys = [mix64(sums ^ own)]
        if deletions:
            at = segment < double
            keys.append(mix64((sums[segment] - element)[at] ^ own[segment][at]))
        return np.unique(np.concatenate(keys)).view(np.int64)


SETS = ("doc_id bigint, fp bigint, n_shingles bigint, s1 bigint, s2 bigint, "
        "exact0 array<bigint>, exact1 array<bigint>, less0 array<bigint>, less1 array<bigint>")
KEYS = ("exact0", "exact1", "less0", "less1")


def _describe(batches: Iterator[pd.DataFrame], least: int) -> Iterator[pd.DataFrame]:
    """Set size, set sums and index keys of each text, by band and way."""
    bands = Bands(least)
    for batch in batches:
        sets = [s for part in chunks(batch["text"].tolist()) for s in shingle_sets(part)]
        rows = []
        for doc_id, fp, s in zip(batch["doc_id"].tolist(), batch["fp"].tolist(), sets):
            if not len(s):   # a first sum of its own, so that empty texts don't meet in one partition
                rows.append((doc_id, fp, 0, hash(doc_id), 0, None, None, None, None))
                continue
            sums = [int(x.sum(dtype=np.uint64).view(np.int64)) for x in (mix64(s), mix64(s ^ _PLACE[0]))]
            own = bands.of(len(s))
            exact = [bands.keys(s, b, False) for b in own] + [None] * (2 - len(own))
            less = [bands.keys(s, b, True) if bands.low(b + 1) - 1 <= SHORT else None for b in own] + [None] * (2 - len(own))
            # The column number says which of a set's bands it is; the band itself follows from the size.
            rows.append((doc_id, fp, len(s), *sums, *exact, *less))
        yield pd.DataFrame(rows, columns=["doc_id", "fp", "n_shingles", "s1", "s2", *KEYS]).astype({"doc_id": "Int64"})


def _differ(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Each text's difference from its reference, as a set, and the sizes of both sets."""
    for batch in batches:
        texts = list(dict.fromkeys([*batch["text"], *batch["text_ref"]]))
        sets = dict(zip(texts, (s for part in chunks(texts) for s in shingle_sets(part))))
        rows = []
        for rep, ref, a, b in zip(batch["rep"].tolist(), batch["ref"].tolist(), batch["text"], batch["text_ref"]):
            own, base = sets[a], sets[b]
            rows.append((rep, ref, len(own), len(base), np.setxor1d(own, base, assume_unique=True).view(np.int64)))
        yield pd.DataFrame(rows, columns=["rep", "ref", "n", "n_ref", "diff"])


DIFF = "rep bigint, ref bigint, n bigint, n_ref bigint, diff array<bigint>"


def _total(df: DataFrame, column: str) -> int:
    return df.agg(F.sum(column)).first()[0] or 0


class _Join:
    """The classes' postings and texts, and the links confirmed so far."""

    def __init__(self, classes: DataFrame, docs: DataFrame, least: int):
        self.least, self.links = least, None
        bands = Bands(least)
        n = F.col("n_shingles")
        self.postings = self.allocate(classes, bands, n)
        involved = stored(self.postings.select("rep").distinct().join(classes.select("rep", "fp"), "rep"), "jaccard-involved")
        texts = docs.join(involved.select(F.col("rep").alias("doc_id"), "fp"), ["doc_id", "fp"], "left_semi")
        self.texts = stored(texts.select(F.col("doc_id").alias("rep"), "text").dropDuplicates(["rep", "text"]),
                            "jaccard-texts")

    def allocate(self, classes: DataFrame, bands: Bands, n: Column) -> DataFrame:
        """(rep, key): the index keys that are used, of those that two classes or more hold."""
        least = F.lit(self.least)
        slots = F.array(*[F.struct(F.lit(i % 2).alias("slot"), F.lit(i < 2).alias("exact"), F.col(k).alias("keys"))
                          for i, k in enumerate(KEYS)])
        rows = classes.select("rep", n.alias("n"), F.explode(slots).alias("s")).select("rep", "n", "s.*")
        rows = rows.filter("keys is not null").withColumn("held", F.size("keys"))
        tokens = rows.select("rep", "n", "slot", "exact", "held", F.explode("keys").alias("key"))
        lists = stored(tokens.groupBy("key").agg(F.count(F.lit(1)).alias("df")).filter("df > 1"), "jaccard-lists")
        # Most keys are of one class and go here; a key of very many is a skewed one of this join, which
        # adaptive execution splits, as the other side holds it once.
        found = stored(tokens.join(lists, "key"), "jaccard-tokens")
        # Rarest first; keys that a class alone holds come before and take their places unposted.
        by = ["rep", "n", "slot", "held"]
        t = (found.filter("exact").groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("df", "key"))).alias("t")))
        most = F.floor(F.col("n") * (100 - least) / least).cast("int") + 1
        room = most - (F.col("held") - F.size("t"))
        exact = t.filter(room > 0).withColumn("t", F.explode(F.slice("t", F.lit(1), room)))
        exact = exact.select("rep", "n", "slot", F.col("t.df").alias("df"), F.col("t.key").alias("key"), F.lit(True).alias("exact"))
        less = found.filter("not exact").select("rep", "n", "slot", "df", "key", "exact")
        rows = stored(exact.unionByName(less), "jaccard-index")
        # Of the bands that index both ways, the cheaper one: a row costs one, a list of df rows its pairs.
        limits = [bands.low(i) for i in range(64) if bands.low(i) <= SHORT + 1]
        band = sum((F.when(F.col("n") >= x, 1).otherwise(0) for x in limits), F.lit(-1)) + F.col("slot")
        # Sets too small for the first band have it as their one slot.
        band = F.when(F.col("n") < limits[0], F.lit(0)).otherwise(band) if limits else F.lit(0)
        rows = rows.withColumn("band", band)
        short = len([x for x in limits if x <= SHORT + 1]) - 1
        cost = (rows.filter(F.col("band") < short).groupBy("band", "exact")
                .agg(F.sum(F.lit(1) + (F.col("df") - 1) / 2).alias("cost")).collect())
        costs: dict[int, dict[bool, float]] = {b: {} for b in range(max(short, 0))}
        for r in cost:
            costs[r["band"]][r["exact"]] = r["cost"]
        by_deletion = [b for b, c in costs.items() if c.get(False, 0.0) < c.get(True, 0.0)]
        keep = F.when(F.col("band").isin(by_deletion), ~F.col("exact")).otherwise(F.col("exact"))
        return stored(rows.filter(keep).select("rep", "key").distinct(), "jaccard-postings")

    def add(self, links: DataFrame) -> None:
        self.links = links if self.links is None else stored(self.links.union(links), "jaccard-links")

    def roots(self) -> DataFrame:
        """(rep, root) of the classes that are linked and aren't the root."""
        return stored(components(self.links).withColumnRenamed("node", "rep"), "jaccard-roots")

    def refer(self) -> DataFrame:
        """(rep, key, ref): the postings with each class's reference."""
        lead = self.postings.groupBy("key").agg(F.min("rep").alias("lead"), F.count(F.lit(1)).alias("df"))
        lead = stored(lead.filter("df > 1"), "jaccard-leaders")
        p = stored(spread_join(self.postings, lead, ["key"], "df", _total(lead, "df"), F.col("rep")), "jaccard-lists")
        votes = p.filter("lead <> rep").groupBy("rep", "lead").agg(F.count(F.lit(1)).alias("c"))
        # Of the leaders other than the class itself, the one of most lists.
        best = votes.groupBy("rep").agg(F.max(F.struct("c", (-F.col("lead")).alias("minus"))).alias("best"))
        refs = components(best.select(F.col("rep").alias("a"), (-F.col("best.minus")).alias("b")))
        p = p.join(refs.withColumnRenamed("node", "rep"), "rep", "left")
        return stored(p.select("rep", "key", "df", F.coalesce("root", "rep").alias("ref")), "jaccard-referred")

    def across(self, referred: DataFrame) -> DataFrame:
        """(rep, ref): a common reference of the classes whose lists span several references."""
        spans = referred.groupBy("key").agg(F.min("ref").alias("lead_ref"), F.max("ref").alias("hi"),
                                            F.count(F.lit(1)).alias("df"))
        spans = stored(spans.filter("lead_ref < hi").drop("hi"), "jaccard-mixed")
        total = _total(spans, "df")
        mixed = stored(spread_join(referred.drop("df"), spans, ["key"], "df", total, F.col("rep"))
                       .select("rep", "ref", "lead_ref").distinct(), "jaccard-members")
        joined = components(mixed.select(F.col("ref").alias("a"), F.col("lead_ref").alias("b")))
        members = mixed.select("rep", "ref").distinct().join(joined.withColumnRenamed("node", "ref"), "ref", "left")
        return members.select("rep", F.coalesce("root", "ref").alias("ref")).filter("rep <> ref")

    def linked(self, both: Column, common: Column) -> Column:
        """Whether sets of ``both`` elements together that differ in so many are similar."""
        return F.lit(100 + self.least) * common <= F.lit(100 - self.least) * both

    def within(self, groups: DataFrame, name: str) -> None:
        """Add the links between classes (rep, ref) of one reference, and to the reference."""
        groups = stored(groups, f"jaccard-{name}-groups")
        sizes = stored(groups.groupBy("ref").agg(F.count(F.lit(1)).alias("rows")), f"jaccard-{name}-sizes")
        base = (sizes.join(self.texts.select(F.col("rep").alias("ref"), F.col("text").alias("text_ref")), "ref"))
        own = groups.join(self.texts, "rep")
        pairs = spread_join(own, base, ["ref"], "rows", _total(sizes, "rows"), F.col("rep"))
        d = pairs.select("rep", "ref", "text", "text_ref").mapInPandas(_differ, DIFF)
        d = d.withColumn("size", F.size("diff"))
        diffs = stored(d.withColumn("tied", self.linked(F.col("n") + F.col("n_ref"), F.col("size"))),
                       f"jaccard-{name}-differences")
        self.add(diffs.filter("tied").select(F.col("rep").alias("a"), F.col("ref").alias("b")))
        # Where all are linked to the reference, nothing is left to find.
        open_ = diffs.filter("not tied").groupBy("ref").agg(F.count(F.lit(1)).alias("loose"))
        diffs = stored(diffs.join(open_.select("ref"), "ref", "left_semi"), f"jaccard-{name}-open")
        postings = self.index(diffs, name)
        lead = stored(postings.groupBy("ref", "el").agg(F.min("rep").alias("b"), F.count(F.lit(1)).alias("df"))
                      .filter("df > 1"), f"jaccard-{name}-leaders")
        p = stored(spread_join(postings, lead, ["ref", "el"], "df", _total(lead, "df"), F.col("rep")),
                   f"jaccard-{name}-lists")
        self.confirm(p.filter("rep <> b").select(F.col("rep").alias("a"), "b", "ref").distinct(), diffs, f"{name}-leader")
        # What else a list may link: classes of different components, one of them not linked to the reference.
        p = p.join(self.roots(), "rep", "left").withColumn("root", F.coalesce("root", "rep"))
        parts = p.groupBy("ref", "el").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.min("tied").alias("all_tied"))
        left = stored(p.join(parts.filter("lo < hi and not all_tied").select("ref", "el"), ["ref", "el"], "left_semi")
                      .select("rep", "ref", "el", "root", "tied"), f"jaccard-{name}-left")
        q = left.select("ref", "el", *[F.col(c).alias(f"{c}_b") for c in ("rep", "root", "tied")])
        pairs = left.join(q, ["ref", "el"]).filter("rep < rep_b and root <> root_b and not (tied and tied_b)")
        self.confirm(pairs.select(F.col("rep").alias("a"), F.col("rep_b").alias("b"), "ref").distinct(), diffs, f"{name}-pair")

    def index(self, diffs: DataFrame, name: str) -> DataFrame:
        """(rep, ref, tied, el): the rarest elements of each difference, as many as a new link needs.

        In units of 1 / (100 + least), a class's difference exceeds its share by
        f = (100 + least) |diff| - (100 - least) n, and two are linked if their common elements are
        at least (f + f') / 2 units. A new link has a class that isn't tied to the reference, whose f is
        above g = (100 - least) n_ref: so a tied class, and any with a partner that isn't tied, needs
        more than (f + g) / 2. With a tied partner of n' <= 100 n / least elements, which holds all
        common ones in its difference, a class needs f - (100 - least) n' units at least.
        """
        unit, rest, least = F.lit(100 + self.least), F.lit(100 - self.least), F.lit(self.least)
        f = unit * F.col("size") - rest * F.col("n")
        loose_partner = F.floor((f + rest * F.col("n_ref")) / (2 * unit) + 1e-9) + 1
        tied_partner = F.ceil((f - rest * 100 * F.col("n") / least) / unit - 1e-9)
        need = F.greatest(F.lit(1), F.when(F.col("tied"), loose_partner).otherwise(F.least(loose_partner, tied_partner)))
        elements = diffs.select("rep", "ref", "tied", "size", need.alias("need"), F.explode("diff").alias("el"))
        lists = stored(elements.groupBy("ref", "el").agg(F.count(F.lit(1)).alias("df")).filter("df > 1"),
                       f"jaccard-{name}-elements")
        found = spread_join(elements, lists, ["ref", "el"], "df", _total(lists, "df"), F.col("rep"))
        held = (found.groupBy("rep", "ref", "tied", "size", "need")
                .agg(F.array_sort(F.collect_list(F.struct("df", "el"))).alias("t")))
        room = (F.size("t") - F.col("need") + 1).cast("int")   # elements it alone has take places unposted
        held = held.filter(room > 0).withColumn("el", F.explode(F.slice("t", F.lit(1), room)))
        return stored(held.select("rep", "ref", "tied", "el.el"), f"jaccard-{name}-index")

    def confirm(self, pairs: DataFrame, diffs: DataFrame, name: str) -> None:
        """Add the pairs (a, b) of a reference whose sets are similar, by their differences from it."""
        def side(x: str) -> DataFrame:
            return diffs.select("ref", F.col("rep").alias(x), F.col("n").alias(f"n_{x}"), F.col("diff").alias(f"diff_{x}"))

        common = F.size("diff_a") + F.size("diff_b") - 2 * F.size(F.array_intersect("diff_a", "diff_b"))
        rows = pairs.join(side("a"), ["ref", "a"]).join(side("b"), ["ref", "b"])
        near = self.linked(F.col("n_a") + F.col("n_b"), common)
        self.add(stored(rows.filter(near).select("a", "b"), f"jaccard-{name}-links"))

    def run(self) -> DataFrame:
        referred = self.refer()
        self.within(referred.filter("rep <> ref").select("rep", "ref").distinct(), "own")
        mixed = stored(self.across(referred), "jaccard-across")
        if not mixed.isEmpty():
            self.within(mixed, "across")
        return self.roots()


def similar_documents(docs: DataFrame, least: int = 90) -> DataFrame:
    """(doc_id, n_shingles, component_id): a row per row of ``docs``.

    Documents are linked if 100 * intersection >= ``least`` * union of their sets of distinct 3-word
    shingles (words lower-cased A-Z; with fewer words the whole sequence is the one shingle);
    component_id is the smallest doc_id that links reach. Null, empty and blank texts have no shingles
    and are linked with nothing. Very long texts are sets like others, worked on whole. Repeated rows
    share their component (rows of one doc_id with different texts go by their own text); rows
    without doc_id are kept, have no component and link nothing. An empty table gives no rows; other columns
    are not read. ``least`` may be 51 to 100.
    """
    d = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of(docs).alias("text"))
    d = d.withColumn("fp", F.xxhash64("text"))
    sets = stored(d.mapInPandas(lambda batches: _describe(batches, least), SETS), "jaccard-sets")
    first = F.min(F.struct("doc_id", "fp"))
    classes = sets.filter("n_shingles > 0 and doc_id is not null").groupBy("s1", "s2").agg(
        first.alias("f"), F.count(F.lit(1)).alias("n"), *[F.first(c).alias(c) for c in ("n_shingles", *KEYS)])
    classes = stored(classes.select("s1", "s2", F.col("f.doc_id").alias("rep"), F.col("f.fp").alias("fp"), "n",
                                    "n_shingles", *KEYS), "jaccard-classes")
    roots = _Join(classes, d, least).run()
    found = stored(classes.select("s1", "s2", "rep", "n").join(roots, "rep", "left")
                   .select("s1", "s2", F.coalesce("root", "rep").alias("root"), "n"), "jaccard-found")
    rows = spread_join(sets.drop(*KEYS), found, ["s1", "s2"], "n", _total(found, "n"), F.struct("doc_id", "fp"), how="left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("root", "doc_id"))
    return rows.select("doc_id", "n_shingles", component.alias("component_id"))
