"""Periodic runs of words by multi-scale minimizers, and texts with their runs collapsed.

A run is a stretch of consecutive words with smallest period q and at least max(24, 3 q) words that no
neighbouring word extends keeping the period. All work on a batch of texts is whole-array work over
the texts' word numbers, laid end to end with a value of its own between two texts: a stretch of 2 q
matches at distance q can't span that value, so no run crosses texts.

1. Periods below ``SCAN``: a direct lag scan each. Stretches of x[i] = x[i + q] give the runs.
2. Periods of a scale [Q, 2 Q), Q = SCAN, 2 SCAN, ...: the hashes of all k = Q / 4 words in a row; a
   place is a minimizer if its hash is the least of some window of Q / 2 places. Places inside a
   stretch of period k / 2 or less, found at a lower scale, are left out: such a stretch holds the same
   hash over and over. The rest with one hash are more than k / 2 apart, so a place has a bounded
   number of partners at a distance in [Q, 2 Q).
   Why no run is missed: a run of period q in [Q, 2 Q) isn't periodic with k / 2 or less as a whole,
   so a place that counts lies in its first q + k / 2 places, hence a window of Q / 2 + k words and
   its copy q further on lie in the run (7/8 Q <= q), and both have their least hash at the same
   offset: an equal pair at distance q.
3. Pairs are kept if the q words from the first on equal those from the second on, or the q up to the
   first those up to the second (one holds in a run of 3 q), by hashes of stretches; their ends are
   searched by bisection, and each stretch so found is compared word by word.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_of
from .hashing import mix64

LEAST, TIMES = 24, 3      # words of a run, and its periods
SCAN = 32                 # shorter periods are scanned directly
WEAK = 8                  # matches in a row that make a short stretch worth leaving out of the minima
WORDS = 1 << 20           # words worked on at once; a longer text is worked on alone
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
RUNS = "runs array<struct<start:bigint,length:bigint,period:bigint>>"


def _stretches(x: np.ndarray, q: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """First place and number of matches of the maximal stretches of x[i] = x[i + q] of ``least`` or more."""
    hit = np.flatnonzero(x[q:] == x[:-q])
    if len(hit) < least:
        return hit[:0], hit[:0]
    cut = np.flatnonzero(np.diff(hit) > 1)
    first = np.concatenate([[0], cut + 1])
    n = np.concatenate([cut, [len(hit) - 1]]) - first + 1
    return hit[first[n >= least]], n[n >= least]


def _slide(a: np.ndarray, w: int, least: bool) -> np.ndarray:
    """Least or greatest value of each w places in a row, by running values within blocks of w."""
    of = np.minimum if least else np.maximum
    pad = np.iinfo(np.uint64).max if least else 0
    n = len(a)
    blocks = np.concatenate([a, np.full(-n % w, pad, np.uint64)]).reshape(-1, w)
    ahead = of.accumulate(blocks, 1).reshape(-1)
    back = of.accumulate(blocks[:, ::-1], 1)[:, ::-1].reshape(-1)
    return of(back[:n - w + 1], ahead[w - 1:n])


class _Stretch:
    """Hashes of any stretch of the word numbers, from sums over prefixes."""

    def __init__(self, x: np.ndarray):
        n = len(x)
        power = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(n, _BASE, np.uint64))])
        self.n = n
        self.back = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(n, _INVERSE, np.uint64))])
        terms = mix64(x.astype(np.uint64) + np.uint64(1)) * power[:n]
        self.total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms)])

    def grams(self, k: int) -> np.ndarray:
        m = self.n - k + 1
        return mix64((self.total[k:self.n + 1] - self.total[:m]) * self.back[:m])

    def same(self, a: np.ndarray, b: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Whether n words from a equal n from b; False where either leaves the array."""
        inside = (a >= 0) & (b >= 0) & (a + n <= self.n) & (b + n <= self.n)
        a, b, n = (np.where(inside, v, 0) for v in (a, b, n))
        one, other = ((self.total[v + n] - self.total[v]) * self.back[v] for v in (a, b))
        return inside & (one == other)

    def reach(self, a: np.ndarray, b: np.ndarray, ahead: bool) -> np.ndarray:
        """How many words from a and b on are equal (or up to before a and b)."""
        reach = np.zeros(len(a), np.int64)
        step = 1 << (self.n.bit_length() - 1)
        while step:
            more = reach + step
            ok = self.same(a, b, more) if ahead else self.same(a - more, b - more, more)
            reach = np.where(ok, more, reach)
            step >>= 1
        return reach


def _seeded(s: _Stretch, q0: int, known: list[tuple[np.ndarray, np.ndarray, int]]) -> set[tuple[int, int, int]]:
    """(first, matches, period) of the stretches with 2 periods of matches or more, of periods in [q0, 2 q0)."""
    k, w = q0 // 4, q0 // 2
    h = s.grams(k)
    edge = np.zeros(len(h) + 1, np.int64)
    for first, n, d in known:                  # places whose k words recur d <= k / 2 before them
        if d <= k // 2:
            first, n = first[n >= k], n[n >= k]
            np.add.at(edge, np.minimum(first + d, len(h)), 1)
            np.add.at(edge, np.minimum(first + d + n - k + 1, len(h)), -1)
    h[np.cumsum(edge)[:-1] > 0] = np.iinfo(np.uint64).max
    lows = _slide(h, w, True)
    best = _slide(np.concatenate([np.zeros(w - 1, np.uint64), lows, np.zeros(w - 1, np.uint64)]), w, False)
    at = np.flatnonzero((best == h) & (h < np.iinfo(np.uint64).max))
    at = at[np.argsort(h[at], kind="stable")]
    value, pairs, t = h[at], [], 1
    while True:
        near = np.flatnonzero((value[t:] == value[:-t]) & (at[t:] - at[:-t] < 2 * q0))
        if not len(near):
            break
        a, b = at[near], at[near + t]
        keep = b - a >= q0
        pairs.append(np.stack([a[keep], b[keep]], 1))
        t += 1
    if not pairs:
        return set()
    a, b = np.concatenate(pairs).T
    q = b - a
    twice = s.same(a, b, q) | s.same(a - q + 1, a + 1, q)
    a, b, q = a[twice], b[twice], q[twice]
    left, right = s.reach(a, b, False), s.reach(a, b, True)
    return set(zip((a - left).tolist(), (left + right).tolist(), q.tolist()))


def find_runs(x: np.ndarray, lengths: list[int]) -> np.ndarray:
    """Rows (start, length, period) of all runs of texts' word numbers, ordered by start and period.

    ``x`` holds the texts end to end, longest first, each with a value of its own after it;
    ``lengths`` are the texts' words. A scale looks at the texts that are long enough for it.
    """
    known: list[tuple[np.ndarray, np.ndarray, int]] = []
    for q in range(1, min(SCAN - 1, lengths[0] // TIMES) + 1):
        known.append((*_stretches(x, q, max((TIMES - 1) * q, WEAK)), q))
    q0, s = SCAN, None
    while lengths[0] >= TIMES * q0:
        part = x[:sum(n + 1 for n in lengths if n >= TIMES * q0)]
        s = s or _Stretch(part)
        s.n = len(part)
        for first, n, q in sorted(_seeded(s, q0, known)):
            if not np.array_equal(part[first:first + n], part[first + q:first + q + n]):
                known.append((*_stretches(part, q, (TIMES - 1) * q), q))   # hashes equal by chance: scanned
            elif n >= (TIMES - 1) * q:
                known.append((np.array([first]), np.array([n]), q))
        q0 *= 2
    rows = [np.stack([f, n + q, np.full(len(f), q)], 1) for f, n, q in known]
    rows = np.concatenate([np.zeros((0, 3), np.int64), *rows])
    rows = rows[(rows[:, 1] >= LEAST) & (rows[:, 1] >= TIMES * rows[:, 2])]
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    # A stretch found with a period and its multiples is a run of the smallest.
    first = np.concatenate([np.ones(min(1, len(rows)), bool), (np.diff(rows[:, :2], axis=0) != 0).any(1)])
    rows = rows[first]
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def _planted(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words, with a tail made periodic in the documents that the id's checksum picks."""
    n = len(words)
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    period = words[a:a + p]
    return words[:a] + (period * (-(-(n - a) // p)))[:n - a]


def _part(texts: list[list[bytes]]) -> list[tuple[list[dict], str]]:
    """Runs and collapsed text of each text."""
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    lengths = [len(texts[i]) for i in order]
    number: dict[bytes, int] = {}
    x, ends = np.empty(sum(lengths) + len(texts), np.int32), np.cumsum(np.array(lengths) + 1)
    for i, end in zip(order, ends.tolist()):
        words = texts[i]
        x[end - 1 - len(words):end - 1] = [number.setdefault(w, len(number)) for w in words]
    x[ends - 1] = -1 - np.arange(len(texts))
    runs = find_runs(x, lengths)
    edge = np.zeros(len(x) + 1, np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    kept = np.cumsum(edge)[:-1] == 0
    cut = np.searchsorted(runs[:, 0], np.concatenate([[0], ends])).tolist()
    out: list = [None] * len(texts)
    for j, (i, end) in enumerate(zip(order, ends.tolist())):
        words, start, rows = texts[i], end - 1 - lengths[j], []
        if cut[j] < cut[j + 1]:
            rows = [{"start": s - start, "length": n, "period": q} for s, n, q in runs[cut[j]:cut[j + 1]].tolist()]
            words = [words[w] for w in np.flatnonzero(kept[start:end - 1]).tolist()]
        out[i] = rows, b" ".join(words).decode()
    return out


def _runs(batches: Iterator[pd.DataFrame], plant: bool) -> Iterator[pd.DataFrame]:
    for batch in batches:
        ids = [None if pd.isna(i) else int(i) for i in batch["doc_id"]]
        held: list[list[bytes]] = []
        out, size = [], 0
        for doc_id, text in zip(ids, batch["text"]):
            words = text.encode().split()      # bytes are split at ASCII white space alone
            words = _planted(words, doc_id) if plant else words
            if held and size + len(words) > WORDS:
                out += _part(held)
                held, size = [], 0
            held.append(words)
            size += len(words)
        if held:
            out += _part(held)
        yield pd.DataFrame({
            "doc_id": pd.array(ids, dtype="Int64"), "collapsed": [c for _, c in out], "runs": [r for r, _ in out]})


def periodic_runs(docs: DataFrame, plant: bool = False) -> DataFrame:
    """(doc_id, runs, collapsed): a row per row of ``docs``.

    ``runs`` lists the text's runs by start, then period; ``collapsed`` is the text's words joined by
    one space without those that a run holds after its first period. With ``plant`` the tail of the
    texts that the checksum of doc_id picks is first made periodic (the query's test data; rows
    without doc_id never are). A null, empty or blank text has no words, no runs and an empty
    ``collapsed``. Texts of any length are worked on whole, one longer than ``WORDS`` alone. Runs
    that start at one word are listed by period; repeated rows are repeated; an empty table gives no
    rows; other columns are not read.
    """
    d = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of(docs).alias("text"))
    return d.mapInPandas(lambda batches: _runs(batches, plant), f"doc_id bigint, collapsed string, {RUNS}")


def digest(found: DataFrame) -> DataFrame:
    """Per row of ``periodic_runs``: number of runs, the run of greatest length / period (ties: the
    smallest start, then period; nulls without one), and digests of all runs and of the collapsed text."""
    # Cross products compare the fractions exactly; the runs come by start and period, so a tie keeps the earlier.
    best = F.when(F.size("runs") > 0, F.aggregate(
        "runs", F.col("runs")[0],
        lambda a, r: F.when(r["length"] * a["period"] > a["length"] * r["period"], r).otherwise(a)))
    lines = F.concat_ws("", F.transform("runs", lambda r: F.format_string("%d,%d,%d\n", r["start"], r["length"], r["period"])))
    d = found.withColumn("best", best)
    return d.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), F.col("best.start").alias("start"),
        F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
