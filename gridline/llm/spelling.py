"""Spelling variants of words by Bloom-guided neighbourhoods.

Two words are near if one inserted, deleted or replaced code point turns one into the other. Each near
pair is generated once, from its longer word by a deletion, or from the larger one of two equally long
words by a replacement with a smaller letter; both lead to a word of the vocabulary. Edits are probed
against blocked Bloom filters, sharded by length; only positives shuffle, to an exact join with the
vocabulary that removes the false ones.

The filters of one pass hold ``PASS_BYTES`` at most, whatever the vocabulary: a length with very many
words is split into parts by the words' hash, and shards that don't fit into one pass take further
passes over the vocabulary. So what is broadcast is bounded, and the result doesn't depend on it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, spread_join, stored, text_of
from .hashing import mix64

# Fixed values of the contract: letters of a run, the checksum's divisor, code points and occurrences of a word.
RUN = r"[A-Za-zÀ-ÿ]{6,}"
DROP, LETTERS, LEAST = 199, 6, 5
ALPHABET = np.array([*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)], np.int64)
_RANK = np.zeros(0x100, np.int64)
_RANK[ALPHABET] = np.arange(len(ALPHABET))     # letters smaller than each letter
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
LONG = 64                 # words of this length or more share a shard, so there are few lengths
BITS, HOLDS = 16, 4       # filter bits per word, and bits that a word sets in its 64-bit block
PART_BYTES = 1 << 21      # a shard's filter at most
PASS_BYTES = 1 << 25      # filters broadcast at once
EDITS = 1 << 20           # edits worked on at once


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n): the vocabulary. A run of letters, lower-cased A-Z, loses a letter where the checksum
    of doc_id and run says so; words are the results of ``LETTERS`` code points and ``LEAST`` occurrences."""
    d = docs.select(F.coalesce(docs["doc_id"].cast("string"), F.lit("")).alias("id"),
                    F.explode(F.regexp_extract_all(text_of(docs), F.lit(RUN), F.lit(0))).alias("run"))
    d = d.withColumn("run", ascii_lower(F.col("run")))
    d = d.withColumn("h", F.crc32(F.encode(F.concat("id", F.lit(":"), "run"), "UTF-8")))
    at = F.pmod("h", F.length("run").cast("bigint")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    word = F.when(F.col("h") % DROP == 0, cut).otherwise(F.col("run"))
    return (d.select(word.alias("word")).filter(F.length("word") >= LETTERS)
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= LEAST))


def _points(words: list[str]) -> np.ndarray:
    """The code points of equally long words, a row per word."""
    return np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.int64).reshape(len(words), -1)


def _powers(base: int, n: int) -> np.ndarray:
    return np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(n, base, np.uint64))])


def _hashes(points: np.ndarray) -> np.ndarray:
    """Raw hashes of words: sums of code point by power of the base."""
    return (points.astype(np.uint64) * _powers(_BASE, points.shape[1])[:-1]).sum(1, dtype=np.uint64)


def _mixed(raw: np.ndarray, length: int) -> np.ndarray:
    return mix64(raw ^ np.uint64(length * 0xD1342543DE82EF95 & (1 << 64) - 1))


def _mask(h: np.ndarray) -> np.ndarray:
    """The bits that a word sets in its block."""
    out = np.zeros(len(h), np.uint64)
    for i in range(HOLDS):
        out |= np.uint64(1) << ((h >> np.uint64(6 * i)) & np.uint64(63))
    return out


def _place(h: np.ndarray, parts: int, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Part and block of a word in its length's shards."""
    high = h >> np.uint64(24)
    return (high % np.uint64(parts)).astype(np.int64), (high // np.uint64(parts) % np.uint64(blocks)).astype(np.int64)


def _by_length(words: list[str]) -> Iterator[tuple[int, np.ndarray]]:
    """Indexes of the words of each length."""
    lengths = np.array([len(w) for w in words], np.int64)
    for n in np.unique(lengths).tolist():
        yield n, np.flatnonzero(lengths == n)


class Shards:
    """Parts and blocks of each length's filter, and which parts each pass broadcasts."""

    def __init__(self, counts: dict[int, int], part_bytes: int = PART_BYTES, pass_bytes: int = PASS_BYTES):
        self.size = {}
        for length, n in counts.items():
            parts = -(-n * BITS // 8 // part_bytes) or 1
            self.size[length] = parts, max(1, -(-n * BITS // 64 // parts))
        self.passes: list[set[tuple[int, int]]] = []
        room = 0
        for length, (parts, blocks) in sorted(self.size.items()):
            for part in range(parts):
                if 8 * blocks > room:
                    self.passes.append(set())
                    room = pass_bytes
                self.passes[-1].add((length, part))
                room -= 8 * blocks


def _fill(batches: Iterator[pd.DataFrame], shards: Shards) -> Iterator[pd.DataFrame]:
    """The filters of the shards in a task: the words of a shard come to one task."""
    filters: dict[tuple[int, int], np.ndarray] = {}
    for batch in batches:
        words = batch["word"].tolist()
        for length, at in _by_length(words):
            h = _mixed(_hashes(_points([words[i] for i in at])), length)
            parts, blocks = shards.size[min(length, LONG)]
            part, block = _place(h, parts, blocks)
            for p in np.unique(part).tolist():
                own = filters.setdefault((min(length, LONG), p), np.zeros(blocks, np.uint64))
                np.bitwise_or.at(own, block[part == p], _mask(h[part == p]))
    for (length, part), cells in filters.items():
        yield pd.DataFrame({"length": [length], "part": [part], "cells": [cells.tobytes()]})


def _shard_of(batches: Iterator[pd.DataFrame], shards: Shards) -> Iterator[pd.DataFrame]:
    for batch in batches:
        words = batch["word"].tolist()
        part = np.zeros(len(words), np.int64)
        for length, at in _by_length(words):
            h = _mixed(_hashes(_points([words[i] for i in at])), length)
            part[at] = _place(h, *shards.size[min(length, LONG)])[0]
        yield batch.assign(part=part)


class _Prober:
    """Yields the edits of words that the filters of a pass say may be words."""

    def __init__(self, shards: Shards, filters: dict[tuple[int, int], np.ndarray]):
        self.shards, self.filters = shards, filters

    def hit(self, raw: np.ndarray, length: int) -> np.ndarray:
        """Which of the edits, hashed, a filter of this pass holds."""
        found = np.zeros(len(raw), bool)
        if min(length, LONG) not in self.shards.size:
            return found
        h = _mixed(raw, length)
        parts, blocks = self.shards.size[min(length, LONG)]
        part, block = _place(h, parts, blocks)
        mask = _mask(h)
        for p in range(parts):
            cells = self.filters.get((min(length, LONG), p))
            if cells is not None:
                own = slice(None) if parts == 1 else np.flatnonzero(part == p)
                found[own] = cells[block[own]] & mask[own] == mask[own]
        return found

    def deletions(self, words: list[str], c: np.ndarray, raw: np.ndarray) -> Iterator[tuple[int, str]]:
        n = c.shape[1]
        power = _powers(_BASE, n)[:-1]
        total = np.cumsum(c.astype(np.uint64) * power, 1, dtype=np.uint64)
        before = total - c.astype(np.uint64) * power
        edits = before + (raw[:, None] - total) * np.uint64(_INVERSE)
        # Of equal letters in a row one deletion stands for all.
        last = np.concatenate([c[:, 1:] != c[:, :-1], np.ones((len(c), 1), bool)], 1)
        row, at = np.nonzero(last)
        for i in np.flatnonzero(self.hit(edits[row, at], n - 1)).tolist():
            w, j = words[row[i]], int(at[i])
            yield int(row[i]), w[:j] + w[j + 1:]

    def replacements(self, words: list[str], c: np.ndarray, raw: np.ndarray) -> Iterator[tuple[int, str]]:
        n = c.shape[1]
        power = _powers(_BASE, n)[:-1]
        cells = c.reshape(-1)
        ranks = _RANK[cells]
        ends = np.cumsum(ranks)
        done = 0
        while done < len(cells):               # as many letters as make EDITS edits
            base = int(ends[done - 1]) if done else 0
            stop = max(done + 1, int(np.searchsorted(ends, base + EDITS, "right")))
            k = ranks[done:stop]
            cell = np.repeat(np.arange(done, stop), k)
            letter = ALPHABET[np.arange(len(cell)) - np.repeat(ends[done:stop] - k - base, k)]
            change = (letter - cells[cell]).astype(np.uint64)
            for i in np.flatnonzero(self.hit(raw[cell // n] + change * power[cell % n], n)).tolist():
                w, j = words[cell[i] // n], int(cell[i] % n)
                yield int(cell[i] // n), w[:j] + chr(letter[i]) + w[j + 1:]
            done = stop

    def __call__(self, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            all_words, counts = batch["word"].tolist(), batch["n"].to_numpy()
            for length, at in _by_length(all_words):
                step = max(1, EDITS // length)
                for i in range(0, len(at), step):
                    own = at[i:i + step]
                    words = [all_words[j] for j in own]
                    c = _points(words)
                    raw = _hashes(c)
                    pairs = [*self.deletions(words, c, raw), *self.replacements(words, c, raw)]
                    if pairs:
                        row = np.array([r for r, _ in pairs])
                        yield pd.DataFrame({"word": [words[r] for r in row], "n": counts[own[row]],
                                            "edit": [e for _, e in pairs]})


def near_pairs(vocabulary: DataFrame, part_bytes: int = PART_BYTES, pass_bytes: int = PASS_BYTES) -> DataFrame:
    """(word, n, near, near_n): each near pair of a vocabulary (word, n) of distinct words, once."""
    spark = vocabulary.sparkSession
    length = F.least(F.length("word"), F.lit(LONG)).alias("length")
    counts = {r["length"]: r["n"] for r in vocabulary.groupBy(length).agg(F.count(F.lit(1)).alias("n")).collect()}
    shards = Shards(counts, part_bytes, pass_bytes)
    placed = (vocabulary.select("word", length)
              .mapInPandas(lambda batches: _shard_of(batches, shards), "word string, length int, part bigint"))
    filled = stored(placed.repartition("length", "part").select("word")
                    .mapInPandas(lambda batches: _fill(batches, shards), "length int, part bigint, cells binary"),
                    "spelling-filters")
    found = None
    for own in shards.passes:
        wanted = spark.createDataFrame(sorted(own), "length int, part bigint")
        filters = {(r["length"], r["part"]): np.frombuffer(r["cells"], np.uint64)
                   for r in filled.join(F.broadcast(wanted), ["length", "part"]).collect()}   # PASS_BYTES at most
        held = spark.sparkContext.broadcast(filters)
        edits = vocabulary.mapInPandas(lambda batches, held=held: _Prober(shards, held.value)(batches),
                                       "word string, n bigint, edit string")
        known = vocabulary.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
        pairs = stored(edits.join(known, edits["edit"] == known["near"]).drop("edit"), "spelling-pairs")
        held.unpersist()
        found = pairs if found is None else found.union(pairs)
    return found if found is not None else vocabulary.limit(0).select(
        "word", "n", F.col("word").alias("near"), F.col("n").alias("near_n"))


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of the words that have a form, following forms to the last.

    An occurrence count grows by five at each form, so a chain has few of them; each round follows
    every open word by twice as many. Words that hang on one form may be many: that key is split.
    """
    at = stored(forms.select("word", F.col("form").alias("root")), "spelling-forms")
    while True:
        held = at.groupBy("root").agg(F.count(F.lit(1)).alias("rows"))
        step = (held.join(at.select(F.col("word").alias("root"), F.col("root").alias("next")), "root"))
        step = stored(step, "spelling-steps")
        total = step.agg(F.sum("rows")).first()[0]
        if not total:
            return at
        moved = spread_join(at, step, ["root"], "rows", total, F.col("word"), how="left")
        at = stored(moved.select("word", F.coalesce("next", "root").alias("root")), "spelling-roots")


def variant_groups(docs: DataFrame, part_bytes: int = PART_BYTES, pass_bytes: int = PASS_BYTES) -> DataFrame:
    """(word, n, n_near, form, form_n, root): a row per word of the texts of ``docs``.

    A word's form is its near word of most occurrences (ties: the smallest in code-point order) if
    these are at least five times its own; root is the last form reached from the word. Null, empty and
    blank texts hold no words; a run of any length is a word like others; rows without doc_id take
    part with an empty id; repeated rows count each time; an empty table gives no rows; other columns
    are not read.
    """
    v = stored(word_counts(docs), "spelling-words")
    pairs = near_pairs(v, part_bytes, pass_bytes)
    turned = pairs.select(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"),
                          F.col("n").alias("near_n"))
    # A word has at most 180 near words per letter, so its group is bounded.
    near = pairs.union(turned).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), "near")).alias("best"))
    out = v.join(near, "word", "left")
    has = -F.col("best.minus") >= LEAST * F.col("n")
    out = stored(out.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
                            F.when(has, F.col("best.near")).alias("form"),
                            F.when(has, -F.col("best.minus")).alias("form_n")), "spelling-near")
    roots = _roots(out.filter("form is not null"))
    return out.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
