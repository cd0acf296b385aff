"""Quality classifier from weak labels.

1. Overlapping heuristic labellers vote on every document: bad, good, or not at all. Given labels, where a
   document has one, are a labeller like the others.
2. Expectation-maximisation (Dawid-Skene) estimates each labeller's accuracies and the share of good
   documents from how often each pattern of votes occurs in the whole corpus. There are at most
   3 ** labellers patterns, so this table is small at any size.
3. The posterior labels of a bounded sample train a logistic scorer over hashed word features and the
   votes; it judges every document by its whole text, also where no labeller of weight speaks.
Quality and tone are separate questions with labellers and scorers of their own: a well-formed text
may be toxic. Tone is judged by the worst window of a text's words, as a passage may be toxic in a long
text that is civil elsewhere. A document is kept if both scorers take it for good.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored, text_of
from .hashing import chunks, mix64, span_hashes, word_hashes, word_spans
from .numeric import give_back

BAD, NONE, GOOD = 0, 1, 2
# Fixed list: English insults.
INSULTS = ("stupid idiot idiots loser losers pathetic scum worthless moron morons trash clown disgusting dumb fool "
           "fools jerk ugly creep freak imbecile coward liar vermin filth garbage retard lunatic hateful bastard")
# Labellers by what they speak of; the last of each is the given label, the others look at the text.
TASKS = {"quality": ("symbols", "table", "capitals", "stutter", "poor", "shouting", "prose", "rich", "given_quality"),
         "tone": ("insult", "civil", "given_tone")}
HEURISTICS = tuple(n for names in TASKS.values() for n in names[:-1])
GIVEN_ERROR = 0.001        # share of the given labels that may be taken for wrong
BUCKETS = 1 << 16
SCALE, FEW = 50.0, 40      # a feature is its share of the text's words (FEW at least) times SCALE
WINDOW = 250               # words of a window; a text's last one takes what is left
_INSULTS = np.sort(word_hashes([INSULTS.encode()])[0])
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>{}[]^~=@\\"]] = True
_UPPER, _LOWER, _BANG = (np.zeros(256, bool) for _ in range(3))
_UPPER[ord("A"):ord("Z") + 1], _LOWER[ord("a"):ord("z") + 1], _BANG[ord("!")] = True, True, True
_FOLD = np.arange(256, dtype=np.uint64)
_FOLD[ord("A"):ord("Z") + 1] += 32


class Texts:
    """Measures, votes and features of a chunk of texts."""

    def __init__(self, texts: list[bytes]):
        n = self.n = len(texts)
        self.bytes, self.first, self.end, self.of = word_spans(texts)
        self.words = span_hashes(self.bytes, self.first, self.end)
        self.count = np.bincount(self.of, minlength=n)

    def _share(self, flags: np.ndarray) -> np.ndarray:
        """Share of each text's words that are flagged."""
        return np.bincount(self.of, flags, self.n) / np.maximum(self.count, 1)

    def windows(self) -> "Texts":
        """The same words with each window as a text of its own; ``owner`` names each window's text."""
        out = object.__new__(Texts)
        out.__dict__.update(self.__dict__)
        per = np.maximum(1, self.count // WINDOW)
        base = np.cumsum(per) - per
        place = np.arange(len(self.of)) - (np.cumsum(self.count) - self.count)[self.of]
        out.of = base[self.of] + np.minimum(place // WINDOW, per[self.of] - 1)
        out.n, out.owner = int(per.sum()), np.repeat(np.arange(self.n), per)
        out.count = np.bincount(out.of, minlength=out.n)
        return out

    def _worst(self, flags: np.ndarray) -> np.ndarray:
        """Share of flagged words in each text's worst window; one word alone is none in a long text."""
        w = self.windows()
        hits = np.bincount(w.of, flags, w.n)
        share = np.where((hits > 1) | (self.count[w.owner] < 2 * WINDOW), hits / np.maximum(w.count, 1), 0.0)
        return np.maximum.reduceat(share, np.searchsorted(w.owner, np.arange(self.n))) if self.n else share

    def _per_word(self, table: np.ndarray) -> np.ndarray:
        """How many of each word's bytes the table marks."""
        total = np.concatenate([[0], np.cumsum(table[self.bytes], dtype=np.int64)])
        return total[self.end] - total[self.first]

    def votes(self) -> np.ndarray:
        size = self.end - self.first
        symbols, capitals, small = (self._per_word(t) for t in (_SYMBOL, _UPPER, _LOWER))
        same = np.zeros(len(self.words), bool)
        same[1:] = (self.words[1:] == self.words[:-1]) & (self.of[1:] == self.of[:-1])
        key = np.sort((self.of.astype(np.uint64) << np.uint64(44)) | (self.words >> np.uint64(20)))
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        distinct = np.bincount((key >> np.uint64(44)).astype(np.int64), new, self.n) / np.maximum(self.count, 1)
        # Texts repeat words more the longer they are; compare with what a text of that length may have.
        usual = np.minimum(1.0, 1.6 * np.maximum(self.count, 1) ** -0.25)
        symbol, table = self._share(symbols > 0), self._share((symbols == 1) & (size == 1))
        upper, stutter = self._share((capitals > 1) & (small == 0)), self._share(same)
        bang, insult = self._share(self._per_word(_BANG) > 0), self._share(_member(self.words, _INSULTS))
        worst = np.maximum(insult, self._worst(_member(self.words, _INSULTS)))
        plain = (symbol < 0.05) & (upper < 0.2) & (stutter < 0.05) & (bang < 0.2)
        some = self.count > 0
        bad = {"symbols": symbol > 0.2, "table": table > 0.15, "capitals": upper > 0.4, "stutter": stutter > 0.2,
               "poor": distinct < 0.4 * usual, "shouting": bang > 0.3, "insult": worst > 0.002}
        good = {"prose": plain & some, "rich": plain & (distinct > 0.7 * usual) & some,
                "civil": plain & (insult == 0) & (self.count >= 1000)}
        return np.stack([np.where(bad[n], BAD, NONE) if n in bad else np.where(good[n], GOOD, NONE)
                         for n in HEURISTICS], 1).astype(np.int8)

    def features(self, votes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, bucket, value), each pair of text and bucket once."""
        head = np.zeros(len(self.first), np.uint64)
        for k in range(4):
            at = np.minimum(self.first + k, len(self.bytes) - 1)
            head = head * np.uint64(256) + np.where(self.first + k < self.end, _FOLD[self.bytes[at]], np.uint64(0))
        tail = np.zeros(len(self.first), np.uint64)
        for k in range(2):
            at = np.maximum(self.end - 1 - k, 0)
            tail = tail * np.uint64(256) + np.where(self.end - 1 - k >= self.first, self.bytes[at].astype(np.uint64), np.uint64(0))
        whole = mix64(self.words) * np.uint64(4) + np.uint64(3)
        keys = np.concatenate([head * np.uint64(4), tail * np.uint64(4) + np.uint64(1), whole])
        bucket = (mix64(keys) >> np.uint64(48)).astype(np.int64)
        pair = np.concatenate([self.of, self.of, self.of]) * BUCKETS + bucket
        pair.sort()
        at = np.flatnonzero(np.append(True, pair[1:] != pair[:-1])) if len(pair) else np.zeros(0, np.int64)
        times, pair = np.diff(np.append(at, len(pair))), pair[at]
        text = pair // BUCKETS
        value = times * SCALE / np.maximum(self.count, FEW)[text]
        t, k = np.nonzero(votes != NONE)
        vote = (mix64((k * 8 + votes[t, k]).astype(np.uint64) * np.uint64(4) + np.uint64(2)) >> np.uint64(48)).astype(np.int64)
        return (np.concatenate([text, t]), np.concatenate([pair % BUCKETS, vote]),
                np.concatenate([value, np.ones(len(t))]))


def _member(x: np.ndarray, among: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(among, x), len(among) - 1)
    return among[at] == x


def _vote(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        votes = [Texts(part).votes() for part in chunks(batch["text"].tolist())]
        out = pd.DataFrame(np.concatenate(votes) if votes else np.zeros((0, len(HEURISTICS)), np.int8),
                           columns=list(HEURISTICS), index=batch.index)
        yield pd.concat([batch[["doc_id", "fp"]].astype({"doc_id": "Int64"}), out], axis=1)


VOTES = "doc_id bigint, fp bigint, " + ", ".join(f"{h} tinyint" for h in HEURISTICS)
SAMPLED = "doc_id bigint, fp bigint, buckets binary, vals binary"


def _sample(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows, at = [], 0
        for part in chunks(batch["text"].tolist()):
            t = Texts(part)
            text, bucket, value = t.features(t.votes())
            order = np.argsort(text, kind="stable")
            cuts = np.searchsorted(text[order], np.arange(1, t.n))
            for b, v in zip(np.split(bucket[order], cuts), np.split(value[order], cuts)):
                rows.append((batch["doc_id"].iloc[at], batch["fp"].iloc[at], b.astype(np.uint16).tobytes(),
                             v.astype(np.float16).tobytes()))
                at += 1
        yield pd.DataFrame(rows, columns=["doc_id", "fp", "buckets", "vals"]).astype({"doc_id": "Int64"})


# ---- weak labels -------------------------------------------------------------------------------
def estimate(patterns: np.ndarray, counts: np.ndarray, steps: int = 200) -> tuple[float, np.ndarray]:
    """Share of good documents and table[labeller, class, vote] by expectation-maximisation.

    ``patterns`` holds a row of votes per pattern, the given label last. It starts from the balance of
    votes, the given one counting most, and every vote keeps a little probability, so that no labeller becomes certain. Of the
    given labels at most a share of ``GIVEN_ERROR`` may be taken for wrong: what only they know, such
    as insults in languages without a word list, is not outvoted.
    """
    good = (patterns == GOOD).astype(int) - (patterns == BAD)
    post = 1 / (1 + np.exp(-1.5 * (good.sum(1) + 3 * good[:, -1]) - 0.5))
    votes = np.stack([patterns == v for v in (BAD, NONE, GOOD)], 2).astype(float)     # pattern, labeller, vote
    share, table = 0.5, None
    for _ in range(steps):
        weight = np.stack([(1 - post) * counts, post * counts])                         # class, pattern
        table = np.einsum("cp,plv->lcv", weight, votes) + 0.5
        table /= table.sum(2, keepdims=True)
        for kind, wrong, right in ((0, GOOD, BAD), (1, BAD, GOOD)):
            too_much = max(0.0, table[-1, kind, wrong] - GIVEN_ERROR * (1 - table[-1, kind, NONE]))
            table[-1, kind, wrong] -= too_much
            table[-1, kind, right] += too_much
        share = (weight[1].sum() + 1) / (counts.sum() + 2)
        log = np.einsum("plv,lcv->pc", votes, np.log(table)) + np.log([1 - share, share])
        new = 1 / (1 + np.exp(np.clip(log[:, 0] - log[:, 1], -50, 50)))
        if np.abs(new - post).max(initial=0) < 1e-9:
            break
        post = new
    return share, table


def posterior(patterns: np.ndarray, share: float, table: np.ndarray) -> np.ndarray:
    """Probability that documents with these votes are good."""
    own = np.stack([np.log(table[l][:, patterns[:, l]]) for l in range(patterns.shape[1])]).sum(0)
    return 1 / (1 + np.exp(np.clip(own[0] + np.log(1 - share) - own[1] - np.log(share), -50, 50)))


# ---- scorer ------------------------------------------------------------------------------------
def fit(rows: list[np.ndarray], values: list[np.ndarray], labels: np.ndarray, epochs: int = 12, batch: int = 256,
        rate: float = 0.5, shrink: float = 1e-5, seed: int = 10) -> np.ndarray:
    """Logistic weights per bucket, and the constant last, by adaptive gradient steps.

    A text's values add up to about 100, so single steps swing its score; the result is the average
    of the weights over the second half of the epochs.
    """
    weights, power = np.zeros(BUCKETS + 1), np.full(BUCKETS + 1, 1e-3)
    total, steps = np.zeros(BUCKETS + 1), 0
    order = np.random.default_rng(seed)
    for epoch in range(epochs):
        mixed = order.permutation(len(rows))
        for i in range(0, len(mixed), batch):
            own = mixed[i:i + batch]
            at = np.concatenate([rows[j] for j in own] + [np.full(len(own), BUCKETS)]).astype(np.int64)
            x = np.concatenate([values[j] for j in own] + [np.ones(len(own))]).astype(float)
            text = np.concatenate([np.repeat(np.arange(len(own)), [len(rows[j]) for j in own]), np.arange(len(own))])
            score = np.bincount(text, weights[at] * x, len(own))
            push = 1 / (1 + np.exp(-np.clip(score, -30, 30))) - labels[own]
            used, where = np.unique(at, return_inverse=True)
            grad = np.bincount(where, push[text] * x) / len(own) + shrink * weights[used]
            power[used] += grad * grad
            weights[used] -= rate * grad / np.sqrt(power[used])
            if 2 * epoch >= epochs:
                total += weights
                steps += 1
    return total / max(steps, 1)


def _judge(weights: dict[str, np.ndarray], threshold: float) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            scores: list[np.ndarray] = []
            for part in chunks(batch["text"].tolist()):
                t = Texts(part)
                votes = t.votes()
                own, parts = t.features(votes), t.windows()
                # A window has its own words and the votes on its text.
                small = parts.features(votes[parts.owner]) if parts.n > t.n else own
                rows = []
                for task, w in weights.items():
                    text, bucket, value = small if task == "tone" else own
                    row = np.bincount(text, w[bucket] * value, parts.n if task == "tone" else t.n) + w[-1]
                    rows.append(np.minimum.reduceat(row, np.searchsorted(parts.owner, np.arange(t.n)))
                                if task == "tone" else row)
                scores.append(np.stack(rows))
            score = np.concatenate(scores, 1) if scores else np.zeros((len(weights), 0))
            p = 1 / (1 + np.exp(-np.clip(score, -50, 50)))
            out = {"doc_id": batch["doc_id"].astype("Int64"), "fp": batch["fp"]}
            out |= {f"p_{task}": p[i] for i, task in enumerate(weights)}
            yield pd.DataFrame(out | {"kept": (p >= threshold).all(0)})
    return judge


def given_votes(labels: DataFrame) -> DataFrame:
    """(doc_id, given_quality, given_tone): the given labels as votes; contradictory ones are none."""
    def vote(name: str, good: int) -> Column:
        lo, hi = F.min(name), F.max(name)
        return F.when(lo == hi, F.when(lo == good, GOOD).otherwise(BAD)).otherwise(NONE).cast("tinyint")

    return (labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), "quality", "toxic").dropna(subset=["doc_id"])
            .groupBy("doc_id").agg(vote("quality", 1).alias("given_quality"), vote("toxic", 0).alias("given_tone")))


def classify(docs: DataFrame, labels: DataFrame, max_train: int = 30_000, threshold: float = 0.6) -> DataFrame:
    """(doc_id, fp, p_quality, p_tone, kept): a row per row of ``docs``; fp is xxhash64 of the text.

    kept is whether both scorers, of quality and of tone, give at least ``threshold``. A scorer is
    trained on at most about ``max_train`` documents on which some labeller of its task spoke, a fixed
    share by the hash of their ids and texts; votes, patterns and verdicts take every document. Null
    and empty texts get no votes and are judged by the constant; repeated rows get equal verdicts;
    rows without doc_id have no given label. An empty table gives no rows, and without
    labels the heuristics alone speak. Other columns are not read.
    """
    text = text_of(docs)
    d = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(text).alias("fp"), text.alias("text"))
    given = given_votes(labels)
    votes = stored(stored(d.mapInPandas(_vote, VOTES), "weak-votes").join(given, "doc_id", "left")
                   .fillna(NONE, subset=["given_quality", "given_tone"]), "weak-given")
    weights = {}
    for task, names in TASKS.items():
        seen = votes.groupBy(*names).agg(F.count(F.lit(1)).alias("n")).orderBy(*names).toPandas()
        spoke = (seen[list(names)] != NONE).any(axis=1)
        patterns, counts = seen.loc[spoke, list(names)].to_numpy(np.int64), seen.loc[spoke, "n"].to_numpy(float)
        share, table = estimate(patterns, counts)
        unit = 1_000_000
        rate = int(np.ceil(unit * min(1.0, max_train / max(1.0, counts.sum()))))
        own = F.pmod(F.xxhash64("doc_id", "fp", F.lit(task)), F.lit(unit)) < rate
        told = F.lit(False)
        for n in names:
            told = told | (F.col(n) != NONE)
        chosen = (votes.filter(own).filter(told).dropDuplicates(["doc_id", "fp"])
                  .select(F.col("doc_id").alias("id"), F.col("fp").alias("h"), *names))
        sample = (d.filter(own).mapInPandas(_sample, SAMPLED).dropDuplicates(["doc_id", "fp"])
                  .join(chosen, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("fp") == F.col("h")))
                  .select("buckets", "vals", *names, F.xxhash64("fp", "doc_id").alias("order")))
        # A part at a time, so that the driver holds the sample once, as packed numbers.
        rows = [(r["order"], r["buckets"], r["vals"], [r[n] for n in names])
                for r in stored(sample, "weak-sample").toLocalIterator()]
        rows.sort(key=lambda r: (r[0], r[1]))
        weights[task] = fit([np.frombuffer(r[1], np.uint16) for r in rows], [np.frombuffer(r[2], np.float16) for r in rows],
                            posterior(np.array([r[3] for r in rows], np.int64).reshape(-1, len(names)), share, table))
        del rows
        give_back()
    return d.mapInPandas(_judge(weights, threshold),
                         "doc_id bigint, fp bigint, p_quality double, p_tone double, kept boolean")
