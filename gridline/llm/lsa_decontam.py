"""Benchmark decontamination by latent semantic retrieval.

1. Every text becomes the hashed terms of its words (white space and punctuation apart). The same
   pass counts in how many passages each term stands and adds up a sketch of the TF-IDF matrix of all
   passages: its product with a sparse random matrix that gives each passage one column and sign.
2. The sketch's singular vectors span the matrix's leading directions (randomised SVD) and give each
   term a vector; a passage's is the sum of its terms'.
3. Every window of every text is compared with every benchmark passage by cosine. The benchmark is a
   stated query set, taken in blocks of bounded size; pairs above ``cosine`` go on.
4. A cosine can miss what the check would accept, short or much changed passages above all. So every
   place that shares enough words with a passage goes on too: a common subsequence of k of a
   passage's n words holds at least t of any n - k + t of them, so the rarest ones are counted.
5. A candidate is confirmed on the words around the window: by the longest common subsequence with
   the whole benchmark passage, and for paraphrases, whose subsequence is shorter, also by its answer,
   the passage's last words.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored, text_of
from .hashing import SEPARATORS, chunks, mix64, word_hashes
from .numeric import PARTS, blocks_of, summed

TERMS = 1 << 14            # hash buckets of terms
COLUMNS = 96               # columns of the sketch
DIMS = 96                  # latent dimensions kept
WINDOW = 32                # words of a passage
STRIDE = 16                # words between the windows that are compared
ANSWER = 5                 # last words of a benchmark passage that count as its answer
ITEMS = 10_000             # benchmark passages compared in one pass over the corpus


def _terms(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    words, of = word_hashes(texts, SEPARATORS)
    return (words >> np.uint64(50)).astype(np.uint16), np.bincount(of, minlength=len(texts)), words


def _passages(counts: np.ndarray, size: int) -> np.ndarray:
    """First word of each passage of ``size`` words; a text's last one may be shorter."""
    ends = np.cumsum(counts)
    per = -(-counts // size)
    base = np.repeat(ends - counts, per)
    return base + size * (np.arange(per.sum()) - np.repeat(np.cumsum(per) - per, per))


def _sketch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Add up the sketch (a column per random column) and, as its last column, the terms' counts."""
    table = np.zeros(TERMS * (COLUMNS + 1))
    for batch in batches:
        for terms, counts, sums in zip(batch["terms"], batch["counts"], batch["sums"]):
            terms = np.frombuffer(terms, np.uint16).astype(np.int64)
            if not len(terms):
                continue
            first = _passages(np.frombuffer(counts, "<i8"), WINDOW)
            draw = np.frombuffer(sums, np.uint64)
            passage = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(terms))))
            pair = np.unique(passage * TERMS + terms)
            passage, term = pair // TERMS, pair % TERMS
            column = (draw % np.uint64(COLUMNS)).astype(np.int64)
            sign = 1.0 - 2.0 * ((draw >> np.uint64(40)) & np.uint64(1))
            size = np.sqrt(np.bincount(passage, minlength=len(first)))
            np.add.at(table, term * (COLUMNS + 1) + column[passage], (sign / size)[passage])
            np.add.at(table, term * (COLUMNS + 1) + COLUMNS, 1.0)
    yield from blocks_of(table)


FEED = "doc_ids array<bigint>, fps array<bigint>, counts binary, terms binary, sums binary"


def _feed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """About a megabyte of texts per row: the documents, their numbers of words, the words' terms, and
    a draw per passage that depends on its words alone."""
    for batch in batches:
        ids = [None if pd.isna(x) else int(x) for x in batch["doc_id"].tolist()]
        fps, at = batch["fp"].tolist(), 0
        for part in chunks(batch["text"].tolist()):
            terms, counts, words = _terms(part)
            first = _passages(counts, WINDOW)
            draws = mix64(np.add.reduceat(words, first)) if len(first) else np.zeros(0, np.uint64)
            here = slice(at, at + len(part))
            at += len(part)
            yield pd.DataFrame({"doc_ids": [ids[here]], "fps": [fps[here]], "counts": [counts.astype("<i8").tobytes()],
                                "terms": [terms.tobytes()], "sums": [draws.tobytes()]})


def term_vectors(sketch: np.ndarray) -> np.ndarray:
    """(TERMS, DIMS) vectors by which passages are compared, from the summed sketch.

    A term's direction is its row of the whitened singular vectors, its length a power of its inverse
    frequency: so a term of a language that is rare in the corpus weighs as much as any other.
    """
    df = sketch[:, COLUMNS]
    idf = np.where(df > 0, np.log((df.max(initial=0) + 1) / (df + 1)) + 1, 0.0)
    left, values, _ = np.linalg.svd(sketch[:, :COLUMNS] * idf[:, None], full_matrices=False)
    keep = values[:DIMS] > 1e-9 * max(values[0], 1e-30)
    rows = left[:, :DIMS][:, keep] / values[:DIMS][keep]
    return (_normal(rows) * idf[:, None] ** 1.5).astype(np.float32)


def _step_sums(terms: np.ndarray, first: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """The vectors' sums over each step of up to STRIDE words; a word said again there counts once."""
    size = np.diff(np.append(first, len(terms)))
    out = np.zeros((len(first), vectors.shape[1]), np.float32)
    none = np.vstack([vectors, np.zeros((1, vectors.shape[1]), np.float32)])     # its last row adds nothing
    for i in range(0, len(first), 512):       # a part of the sums that stays in the cache
        part, before = out[i:i + 512], []
        for j in range(STRIDE):
            own = terms[np.minimum(first[i:i + 512] + j, len(terms) - 1)].astype(np.int64)
            new = size[i:i + 512] > j
            for other in before:
                new &= own != other
            before.append(own)
            part += none[np.where(new, own, len(vectors))]
    return out


def _windows(terms: np.ndarray, counts: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, ...]:
    """First word, text and vector of each window: a step and the next one of its text."""
    first = _passages(counts, STRIDE)
    text = np.searchsorted(np.cumsum(counts), first, "right")
    steps = _step_sums(terms, first, vectors)
    out = steps.copy()
    more = np.flatnonzero(text[1:] == text[:-1])
    out[more] += steps[more + 1]
    return first, text, _normal(out)


def _normal(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.sqrt((x * x).sum(1, keepdims=True)), 1e-30)


def common_subsequence(item: list[int], words: list[int]) -> int:
    """Length of the longest common subsequence, a bit per word of ``item``."""
    places: dict[int, int] = {}
    for i, w in enumerate(item):
        places[w] = places.get(w, 0) | 1 << i
    every = (1 << len(item)) - 1
    row = every
    for w in words:
        hit = row & places.get(w, 0)
        row = ((row + hit) | (row - hit)) & every
    return len(item) - row.bit_count()


class Benchmark:
    """A block of benchmark passages: terms, and vectors of their windows."""

    def __init__(self, ids: list, texts: list[str], vectors: np.ndarray, df: np.ndarray, least: float):
        self.ids, self.terms, rows, self.of = [], [], [], []
        for i, t in zip(ids, texts):
            terms = _terms([(t or "").encode("utf-8", "surrogatepass")])[0]
            if not len(terms):
                continue
            own = _windows(terms, np.array([len(terms)]), vectors)[2]
            # The last step's own window adds nothing to the one before it.
            rows += list(own[:max(1, len(own) - 1)])
            self.of += [len(self.ids)] * max(1, len(own) - 1)
            self.ids.append(i)
            self.terms.append(terms.astype(np.int64).tolist())
        self.of = np.array(self.of, np.int64)
        self.rows = np.array(rows, np.float32).reshape(len(rows), vectors.shape[1])
        self.size = np.array([len(t) for t in self.terms], np.int64)
        self.times = [Counter(t) for t in self.terms]
        # Of a passage's words the rarest, and how many of these any stretch must hold that has a
        # common subsequence of ``least`` of the words.
        need = np.maximum(1, np.ceil(least * self.size - 1e-9)).astype(np.int64)
        self.must = np.maximum(1, need // 2)
        held = []
        for i, t in enumerate(self.terms):
            rare = sorted(t, key=lambda w: (df[w], w))[:len(t) - int(need[i]) + int(self.must[i])]
            held += [(w, i, n) for w, n in Counter(rare).items()]
        term, self.held, self.weight = np.array(sorted(held), np.int64).reshape(-1, 3).T
        self.at = np.searchsorted(term, np.arange(TERMS + 1))
        self.has = np.zeros((len(self.terms), TERMS), bool)
        for own, t in zip(self.has, self.terms):
            own[t] = True


def _shared(terms: np.ndarray, counts: np.ndarray, bench: Benchmark) -> tuple[np.ndarray, ...]:
    """Item, text, first and last + 1 word of each stretch that holds enough of an item's rarest words.

    A stretch is a run of WINDOW words and the item's length on either side, so any run of up to twice
    the item's length lies in one. Words are counted by whole runs that the stretch touches.
    """
    first, ends = _passages(counts, WINDOW), np.cumsum(counts)
    runs, items = len(first), len(bench.size)
    known = np.flatnonzero((bench.at[1:] > bench.at[:-1])[terms])
    run = np.searchsorted(first, known, "right") - 1
    pair = np.unique(run * TERMS + terms[known])         # a word said again in a run counts once
    run, term = pair // TERMS, pair % TERMS
    size = bench.at[term + 1] - bench.at[term]
    place = np.repeat(bench.at[term] - (np.cumsum(size) - size), size) + np.arange(size.sum())
    table = np.bincount(bench.held[place] * runs + np.repeat(run, size), bench.weight[place], items * runs)
    total = np.zeros((items, runs + 1), np.int32)
    np.cumsum(table.reshape(items, runs), axis=1, out=total[:, 1:], dtype=np.int32)
    text = np.searchsorted(ends, first, "right")
    begin, end = np.searchsorted(text, text, "left"), np.searchsorted(text, text, "right")
    reach, found = -(-bench.size // WINDOW), []
    for r in np.unique(reach):
        own = np.flatnonzero(reach == r)
        low, high = np.maximum(begin, np.arange(runs) - r), np.minimum(end, np.arange(runs) + r + 1)
        i, k = np.nonzero(total[own][:, high] - total[own][:, low] >= bench.must[own][:, None])
        found.append((own[i], k))
    item, k = (np.concatenate(x) for x in zip(*found))
    low = np.maximum(ends[text[k]] - counts[text[k]], first[k] - bench.size[item])
    return item, text[k], low, np.minimum(ends[text[k]], first[k] + WINDOW + bench.size[item])


def _finder(bench: Benchmark, vectors: np.ndarray, cosine: float, verbatim: float, paraphrase: float
            ) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def check(item: int, terms: np.ndarray) -> tuple[float, float]:
        """Shares of the item, and of its answer, that are a common subsequence with the words."""
        own, times = bench.terms[item], bench.times[item]
        words = terms[bench.has[item][terms]].tolist()
        if len(words) < paraphrase * len(own) or sum(times[w] for w in set(words)) < paraphrase * len(own):
            return 0.0, 0.0
        answer = own[-ANSWER:]
        return (common_subsequence(own, words) / len(own), common_subsequence(answer, words) / len(answer))

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for ids, fps, counts, terms in zip(batch["doc_ids"], batch["fps"], batch["counts"], batch["terms"]):
                counts, terms = np.frombuffer(counts, "<i8"), np.frombuffer(terms, np.uint16)
                if not len(terms) or not len(bench.rows):
                    continue
                first, doc, windows = _windows(terms, counts, vectors)
                like = windows @ bench.rows.T
                w, q = np.nonzero(like >= cosine)
                ends = np.cumsum(counts)
                item, d, at = bench.of[q], doc[w], first[w]
                order = np.lexsort((at, d, item))
                item, d, at, close = item[order], d[order], at[order], like[w, q][order]
                reach = bench.size[item]
                # Windows of a text that lie together are looked at together.
                new = np.ones(len(at), bool)
                new[1:] = (item[1:] != item[:-1]) | (d[1:] != d[:-1]) | (at[1:] > at[:-1] + WINDOW + reach[1:])
                lead = np.flatnonzero(new)
                last = np.append(lead[1:], len(at))[:len(lead)] - 1
                low = np.maximum(ends[d[lead]] - counts[d[lead]], at[lead] - reach[lead])
                high = np.minimum(ends[d[lead]], at[last] + WINDOW + reach[lead])
                close = np.maximum.reduceat(close, lead) if len(lead) else close
                best: dict[tuple[int, int], tuple] = {}
                for i, k, a, b, c in zip(item[lead].tolist(), d[lead].tolist(), low.tolist(), high.tolist(), close.tolist()):
                    share, answer = check(i, terms[a:b])
                    if share >= verbatim or share >= paraphrase and answer >= 0.8:
                        best[k, i] = max(best.get((k, i), ()), (share, answer, c))
                for i, k, a, b in zip(*(x.tolist() for x in _shared(terms, counts, bench))):
                    share, answer = check(i, terms[a:b])
                    if share >= verbatim or share >= paraphrase and answer >= 0.8:
                        c = float(like[np.searchsorted(first, a):np.searchsorted(first, b)][:, bench.of == i].max(initial=-1))
                        best[k, i] = max(best.get((k, i), ()), (share, answer, c))
                out += [(ids[k], fps[k], bench.ids[i], *v) for (k, i), v in best.items()]
            frame = pd.DataFrame(out, columns=["doc_id", "text_hash", "item_id", "lcs_share", "answer_share", "cosine"])
            yield frame.astype({"doc_id": "Int64", "item_id": "Int64"})
    return find


FOUND = "doc_id bigint, text_hash bigint, item_id bigint, lcs_share double, answer_share double, cosine double"


def contaminated(docs: DataFrame, benchmark: DataFrame, cosine: float = 0.42, verbatim: float = 0.8,
                 paraphrase: float = 0.6) -> DataFrame:
    """(doc_id, text_hash, item_id, lcs_share, answer_share, cosine): documents holding a benchmark passage.

    A row per row of ``docs`` and benchmark passage found in it: at least ``verbatim`` of the
    passage's words are a common subsequence with the words around some window of the text, or at
    least ``paraphrase`` of them and four fifths of its answer's. text_hash tells apart texts of one
    doc_id (or of none). Null and empty texts and passages match nothing, passages shorter than a
    window are compared as they are, repeated rows are found each, an empty table on either side
    gives no rows. Other columns are not read.
    """
    text = text_of(docs)
    feed = stored(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(text).alias("fp"),
                              text.alias("text")).mapInPandas(_feed, FEED), "lsa-terms")
    sketch = summed(feed.select("counts", "terms", "sums").mapInPandas(_sketch, PARTS), (TERMS, COLUMNS + 1))
    vectors = term_vectors(sketch.astype(np.float64))
    passages = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), text_of(benchmark).alias("text"))
    # The queries in blocks: each block is compared with the whole corpus in a pass of its own.
    blocks = max(1, -(-passages.count() // ITEMS))
    out = None
    for b in range(blocks):
        rows = passages.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).orderBy("item_id").collect()
        bench = Benchmark([r["item_id"] for r in rows], [r["text"] for r in rows], vectors, sketch[:, COLUMNS],
                          min(verbatim, paraphrase))
        found = feed.mapInPandas(_finder(bench, vectors, cosine, verbatim, paraphrase), FOUND)
        out = found if out is None else out.unionByName(found)
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, **settings) -> DataFrame:
    """``docs`` without the documents that ``contaminated`` finds."""
    found = stored(contaminated(docs, benchmark, **settings).select(
        F.col("doc_id").alias("__id"), F.col("text_hash").alias("__fp")).distinct(), "contaminated")
    same = docs["doc_id"].cast("bigint").eqNullSafe(F.col("__id")) & (F.xxhash64(text_of(docs)) == F.col("__fp"))
    return docs.join(found, same, "left_anti")
