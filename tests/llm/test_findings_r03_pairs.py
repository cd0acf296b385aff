"""The findings of round 3 on time and rows: near duplicates with a passage in common, and new words of the tokenizer."""

import random

import numpy as np
import pytest

from gridline.llm import minhash_join, token_blocks
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


def with_a_passage(n_long=120, n_short=10):
    """Texts with 60 shingles in common; the first is far from all, the short ones are near each other."""
    words = random.Random(7)
    passage = " ".join(f"p{i}" for i in range(64))
    sizes = [64, *[30 + i % 30 for i in range(n_long)], *[4 + i % 5 for i in range(n_short)]]
    return [" ".join([passage, *[f"w{words.getrandbits(60)}" for _ in range(n)]]) for n in sizes]


def near_copies(n=80):
    words = random.Random(3)
    base = [f"b{i}" for i in range(100)]
    out = [" ".join(base)]
    for i in range(n):
        copy = base[:]
        for at in words.sample(range(100), 1 + i % 9):
            copy[at] = f"e{words.getrandbits(60)}"
        out.append(" ".join(copy))
    return out


def found(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    rows = {r.doc_id: r.component_id for r in minhash_join.near_duplicates(docs).collect()}
    return [rows[i] for i in range(len(texts))]


def test_texts_with_a_passage_in_common_form_no_square_of_pairs(spark, monkeypatch):
    formed, confirm = {}, minhash_join._Join.confirm

    def counted(self, pairs, name):
        formed[name] = formed.get(name, 0) + pairs.count()
        confirm(self, pairs, name)

    monkeypatch.setattr(minhash_join._Join, "confirm", counted)
    texts = with_a_passage()
    assert found(spark, texts) == brute_components(texts)
    assert formed["difference"] < len(texts)


@pytest.mark.parametrize("texts", [with_a_passage(30, 25), near_copies()], ids=["passage", "copies"])
def test_levels_of_references_find_all_links(spark, monkeypatch, texts):
    monkeypatch.setattr(minhash_join, "FEW", 2)
    levels, differ = [], minhash_join._Join.differ

    def counted(self, pairs):
        levels.append(1)
        return differ(self, pairs)

    monkeypatch.setattr(minhash_join._Join, "differ", counted)
    assert found(spark, texts) == brute_components(texts)
    assert len(levels) > 1


class Counting:
    """A tokenizer that counts the calls of its model."""

    def __init__(self, tokenizer):
        self.tokenizer, self.calls, self.model = tokenizer, 0, self

    def tokenize(self, text):
        self.calls += 1
        return self.tokenizer.model.tokenize(text)

    def encode_batch_fast(self, texts, **kw):
        return self.tokenizer.encode_batch_fast(texts, **kw)


ODD = ["", " ", "Hello", "a\n\nb  c", "it's don't 'tis, x.,. ..", "éàla carte, café.\n", " \t tab", "1,5 a.b <|endoftext|> end.",
       "….. ®, ½. ²,", "end. ", "x y, z"]


def test_new_words_are_merged_in_runs():
    import public_tokenizers
    path = public_tokenizers.path("byte_bpe_50k.json")
    words = random.Random(5)
    texts = [*ODD, " ".join("".join(words.choices("abcdefghij", k=8)) + words.choice(["", ".", ",", ".,"]) for _ in range(3000))]
    encoder = token_blocks.PieceEncoder(path)
    plain, encoder.tokenizer = encoder.tokenizer, Counting(encoder.tokenizer)
    want = [[*e.ids, token_blocks.END] for e in plain.encode_batch(texts, add_special_tokens=False)]
    for _ in range(2):          # new pieces, then known ones
        ids, counts = encoder.encode(texts)
        assert counts.tolist() == [len(x) for x in want] and ids.tolist() == [i for x in want for i in x]
    assert 0 < encoder.tokenizer.calls < 30
    encoder = token_blocks.PieceEncoder(path)
    encoder.apart = False       # a vocabulary whose tokens reach across
    assert np.array_equal(encoder.encode(texts)[0], ids)


def test_tokens_that_reach_across_the_parts_of_a_piece():
    across = ["a.", "aĠ", ".Ġ", "Ã©,", "©,"]        # the last ones: letters of two bytes, whole and cut
    assert all(map(token_blocks._reaches_across, across))
    assert not any(map(token_blocks._reaches_across, ["Ġa", "..", "Â®,", "ĠĠ"]))
