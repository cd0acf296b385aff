"""Spelling variants, periodic runs and the n-gram join against brute force, and their edge cases."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import pytest

from gridline.llm import jaccard_join, periodic_runs, spelling

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id bigint, text string, word string, n bigint, key int, rep bigint, runs string"


def frame(spark, docs):
    """The documents with columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, "x", 1, 2, 3, "y") for i, t in docs], SCHEMA).repartition(5)


# --- spelling ------------------------------------------------------------------------------
def plain_words(docs):
    counts = Counter()
    for i, t in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += len(run) >= 6
    return {w: n for w, n in counts.items() if n >= 5}


def plain_groups(words):
    near, form = defaultdict(set), {}
    for w in words:
        for v in words:
            if len(v) == len(w) and sum(a != b for a, b in zip(v, w)) == 1 or len(v) == len(w) - 1 and any(
                    w[:i] + w[i + 1:] == v for i in range(len(w))):
                near[w].add(v)
                near[v].add(w)
    for w in near:
        best = min(near[w], key=lambda v: (-words[v], v))
        if words[best] >= 5 * words[w]:
            form[w] = best
    out = {}
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out[w] = (n, len(near[w]), form.get(w), words.get(form.get(w)), root)
    return out


@pytest.fixture(scope="module")
def spelled():
    rng = random.Random(11)
    letters = "abcdezßÀÿ÷"
    words = ["".join(rng.choice(letters) for _ in range(rng.choice([5, 6, 7, 8, 12, 70]))) for _ in range(40)]
    for w in list(words):
        for _ in range(3):
            i = rng.randrange(len(w))
            words.append(rng.choice([w[:i] + w[i + 1:], w[:i] + rng.choice(letters) + w[i + 1:], w[:i] + rng.choice(letters) + w[i:]]))
    docs = []
    for i in range(300):
        picked = [rng.choice(words[:rng.choice([5, 20, len(words)])]) for _ in range(60)]
        docs.append((i, " ".join(w.title() if rng.random() < 0.2 else w for w in picked)))
    docs += [(900, None), (901, ""), (902, " \n"), (None, "alphabet " * 7), (903, "alphabet " * 7), (903, "alphabet " * 7),
             (904, ("k" * 20_000 + " ") * 5 + ("k" * 20_001 + ",") * 30)]
    return docs


@pytest.mark.parametrize("sizes", [{}, {"part_bytes": 16, "pass_bytes": 64}])
def test_spelling(spark, spelled, sizes):
    got = {r.word: (r.n, r.n_near, r.form, r.form_n, r.root)
           for r in spelling.variant_groups(frame(spark, spelled), **sizes).collect()}
    want = plain_groups(plain_words(spelled))
    assert got == want
    assert sum(w[2] is not None for w in want.values()) > 20 and want["k" * 20_000][2] == "k" * 20_001


def test_spelling_chains_and_ties(spark):
    counts = {"aaaaaa": 5, "aaaaab": 25, "aaaabb": 125, "aaabbb": 625, "cccccc": 5, "cccccd": 30, "bccccc": 30, "ccccc": 99}
    docs = [(1_000_000 + i, f"{w} " * n) for i, (w, n) in enumerate(counts.items())]
    assert plain_words(docs) == {w: n for w, n in counts.items() if len(w) >= 6}
    got = {r.word: (r.form, r.root, r.n_near) for r in spelling.variant_groups(frame(spark, docs)).collect()}
    assert got["aaaaaa"] == ("aaaaab", "aaabbb", 1) and got["aaaabb"] == ("aaabbb", "aaabbb", 2)
    assert got["cccccc"] == ("bccccc", "bccccc", 2) and got["cccccd"] == (None, "cccccd", 1)


def test_spelling_without_words(spark):
    assert spelling.variant_groups(frame(spark, [(1, "too short here"), (2, None)])).count() == 0
    assert spelling.variant_groups(frame(spark, [(1, "x")]).limit(0)).count() == 0


# --- periodic runs --------------------------------------------------------------------------
def plain_runs(words):
    n, found = len(words), {}
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(24, 3 * q):
                found.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted((s, n, q) for (s, n), q in found.items())


def plain_digest(doc_id, text, plant=True):
    words = (text or "").encode().split()
    n, h = len(words), 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if plant and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None,) * 3
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            sha("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()),
            sha(b" ".join(w for i, w in enumerate(words) if i not in gone)))


def made_text(rng):
    out = []
    for _ in range(rng.randint(1, 5)):
        k = rng.choice([1, 2, 3, 30, 200])
        piece = [rng.randrange(k) for _ in range(rng.choice([1, 2, 3, 7, 31, 32, 33, 64, 65, 100, 150]))]
        if rng.random() < 0.4:                 # a piece that is periodic itself, but for its end
            piece = piece * rng.randint(3, 9) + [rng.randrange(50) for _ in range(rng.randint(0, 9))]
        out += (piece * rng.choice([1, 2, 3, 4, 5]))[:rng.randint(1, 900)]
    return " ".join(map(str, out[:1200]))


def test_periodic_runs(spark):
    rng = random.Random(12)
    docs = [(i, made_text(rng)) for i in range(150)]
    docs += [(900, None), (901, ""), (902, " \t\n"), (None, "a b " * 20), (903, "é x\x85y " * 40), (903, "é x\x85y " * 40),
             (904, " ".join(f"w{i % 20_011}" for i in range(70_000))), (905, "Tie tie " * 12 + "end " + "up up2 " * 12)]
    out = periodic_runs.digest(periodic_runs.periodic_runs(frame(spark, docs), plant=True)).collect()
    long = [r for r in out if r.doc_id == 904]
    assert (long[0].n_runs, long[0].start, long[0].length, long[0].period) == (1, 0, 70_000, 20_011)
    want = [plain_digest(i, t) for i, t in docs if i != 904]
    assert sorted(map(str, (tuple(r) for r in out if r.doc_id != 904))) == sorted(map(str, want))
    assert sum(w[1] > 0 for w in want) > 60 and max(w[4] or 0 for w in want) > 100
    assert periodic_runs.periodic_runs(frame(spark, docs).limit(0)).count() == 0


def test_texts_split_over_parts(spark, monkeypatch):
    rng = random.Random(13)
    texts = [[w.encode() for w in made_text(rng).split()] for _ in range(30)] + [[], []]
    together = periodic_runs._part(texts)
    assert together == [periodic_runs._part([t])[0] for t in texts]


# --- n-gram Jaccard join -----------------------------------------------------------------------
def plain_join(docs, least):
    sets = {}
    for i, t in docs:
        w = WORD.findall((t or "").translate(LOWER))
        sets[i] = {tuple(w[j:j + 3]) for j in range(len(w) - 2)} if len(w) >= 3 else {tuple(w)} - {()}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= least * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return sorted((i, len(s), find(i)) for i, s in sets.items())


def variants(seed, vocabulary, n, sizes):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(vocabulary)]
    bases = [[rng.choice(words) for _ in range(rng.choice(sizes))] for _ in range(15)]
    docs = []
    for i in range(n):
        w = list(rng.choice(bases))
        for _ in range(rng.choice([0, 1, 1, 2, 3, 5])):
            at = rng.randrange(len(w) + 1)
            w[at:at + rng.randint(0, 1)] = [rng.choice(words) for _ in range(rng.randint(0, 1))]
        docs.append((i, " ".join(w).title() if i % 3 == 0 else "\t".join(w)))
    return docs + [(5000, None), (5001, ""), (5002, "a b"), (5003, "A  b"), (5004, "a")]


@pytest.mark.parametrize("seed, vocabulary, least, sizes", [
    (1, 300, 90, [3, 8, 9, 11, 12, 14, 17, 22, 30, 45]), (2, 25, 90, [12, 20, 60, 100, 200]),
    (3, 300, 75, [3, 5, 8, 12, 30, 80]), (4, 300, 100, [3, 10, 30])])
def test_join(spark, seed, vocabulary, least, sizes):
    docs = variants(seed, vocabulary, 500, sizes)
    out = jaccard_join.similar_documents(frame(spark, docs), least).collect()
    assert sorted(map(tuple, out)) == plain_join(docs, least)


def test_join_of_hubs(spark):
    """Two families that share half of their words, near copies around either, and texts built on one passage."""
    rng = random.Random(7)
    make = lambda n, tag: [f"{tag}{rng.randrange(10 ** 6)}" for _ in range(n)]
    shared, docs = make(60, "s"), []
    families = [shared + make(60, "a"), shared + make(60, "b")]
    for i in range(300):
        w = list(families[i % 2])
        for _ in range(rng.choice([0, 1, 2, 3, 4])):
            w[rng.randrange(len(w))] = f"x{rng.randrange(10 ** 6)}"
        docs.append((i, " ".join(w)))
    docs += [(1000 + i, " ".join(shared[:50] + make(8, "p"))) for i in range(150)]
    out = jaccard_join.similar_documents(frame(spark, docs)).collect()
    assert sorted(map(tuple, out)) == plain_join(docs, 90)


def test_join_edges(spark):
    long = " ".join(f"word{i % 977} and{i % 31}" for i in range(30_000))
    docs = [(7, long), (8, long + " tail"), (3, "one two three four"), (3, "one two three four"), (3, "another text of this id"),
            (9, "ONE two three four"), (None, "one two three four"), (None, None), (4, None), (5, " ")]
    out = jaccard_join.similar_documents(frame(spark, docs)).collect()
    assert len(out) == len(docs)
    got = sorted((r.doc_id or -1, r.n_shingles, r.component_id) for r in out)
    assert {g[2] for g in got if g[0] in (7, 8)} == {7} and {g[2] for g in got if g[0] in (3, 9)} == {3}
    assert [g for g in got if g[0] in (4, 5)] == [(4, 0, 4), (5, 0, 5)] and all(g[2] is None for g in got if g[0] == -1)
    assert jaccard_join.similar_documents(frame(spark, docs).limit(0)).count() == 0
