"""The findings of round 4 on near duplicates: leads near to what a group has in common keep the differences small."""

import random

import pytest

from gridline.llm import minhash_join
from gridline.llm.hashing import shingle_sets


def brute_components(texts, least=75):
    sets = [set(s.tolist()) for s in shingle_sets([t.encode() for t in texts])]
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            both = len(a & b)
            if both and 100 * both >= least * (len(a) + len(b) - both):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return [find(i) for i in range(len(sets))]


def copies(n=60, far=20):
    """Copies of one text with a few words changed; those of the smallest ids, and a few others, have many changed."""
    words = random.Random(11)
    base = [f"b{i}" for i in range(200)]
    out = []
    for i in range(n + far):
        copy = base[:]
        for at in words.sample(range(200), 20 if i < far // 2 or i >= n + far // 2 else 3 + i % 3):
            copy[at] = f"e{words.getrandbits(60)}"
        out.append(" ".join(copy))
    return out


@pytest.mark.parametrize("few", [minhash_join.FEW, 2])
def test_differences_from_a_lead_are_those_from_what_is_common(spark, monkeypatch, few):
    monkeypatch.setattr(minhash_join, "FEW", few)
    sizes, differ = [], minhash_join._Join.differ

    def counted(self, pairs):
        diffs = differ(self, pairs)
        sizes.append([len(r["diff"]) for r in diffs.select("diff").collect()])
        return diffs

    monkeypatch.setattr(minhash_join._Join, "differ", counted)
    texts = copies()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    rows = {r.doc_id: r.component_id for r in minhash_join.near_duplicates(docs).collect()}
    assert [rows[i] for i in range(len(texts))] == brute_components(texts)
    # Against one of the 20 far texts 70 of 80 differences are longer than 80.
    assert sizes[0] and sorted(sizes[0])[len(sizes[0]) // 2] < 80
