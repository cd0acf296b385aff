"""Operators that SQL can't express, against plain versions or held-out accuracy."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest
import xxhash

from gridline.llm import lsa_decontam, quality_llr, token_blocks
from gridline.llm import queries as Q

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def table():
    return pq.read_table(f"{SF}/documents.parquet").to_pylist()


def test_blocks_round_trip():
    rng = np.random.default_rng(3)
    for n in (0, 1, 127, 128, 129, 5000):
        for ids in (rng.integers(0, 50257, n), np.zeros(n), np.where(rng.random(n) < 0.04, 2**32 - 1, rng.integers(0, 9, n))):
            payload, starts = token_blocks.pack(ids.astype(np.uint32))
            assert np.array_equal(token_blocks.unpack(payload, starts), ids.astype(np.uint32))
            if len(starts) > 2:                       # any block alone
                assert np.array_equal(token_blocks.unpack(payload, starts[1:2]), ids[128:256].astype(np.uint32))


def test_op2_equals_plain_encoding(spark, table):
    import public_tokenizers
    from tokenizers import Tokenizer
    got = {r.doc_id: r for r in Q.op2_token_blocks(spark, SF).collect()}
    tokenizer, at = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), 0
    for row in sorted(table, key=lambda r: r["doc_id"]):
        ids = np.array(tokenizer.encode(row["text"] or "", add_special_tokens=False).ids + [0], "<u4")
        g = got[row["doc_id"]]
        assert (g.start, g.n_tokens, g.ids_crc32) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


def test_op4_base_and_verdict(spark, table):
    got = {r.doc_id: r for r in Q.op4_quality_rules(spark, SF).collect()}
    labels = {r["doc_id"]: r for r in pq.read_table(f"{SF}/labels.parquet").to_pylist()}
    buckets, target, raw, lang_t, lang_r = 1 << 15, {}, {}, Counter(), Counter()
    h = lambda *parts: _xx(parts) % buckets
    docs = [(r, WORD.findall(r["text"] or "")) for r in table]
    for r, words in docs:
        label = labels.get(r["doc_id"])
        good = label and label["quality"] == 1 and not label["toxic"]
        for w in words:
            lang_r[r["lang"]] += 1
            lang_t[r["lang"]] += bool(good)
            for name, gram in (("head", w[:4]), ("tail", w[-2:])):
                key = (name, h(r["lang"], name, gram))
                raw.setdefault(key, Counter())[r["lang"]] += 1
                target[key] = target.get(key, 0) + bool(good)
    weight = {k: round(1e6 * math.log((target[k] + 2) / (sum(n * lang_t[x] / lang_r[x] for x, n in c.items()) + 2)))
              for k, c in raw.items()}
    for r, words in docs:
        n, g = len(words), got[r["doc_id"]]
        grams = [tuple(words[i:i + 5]) for i in range(n - 4)]
        times = Counter(grams)
        covered = {j for i, x in enumerate(grams) if times[x] > 1 for j in range(i, i + 5)}
        failed = n < 10 or 100 * len(covered) > 20 * n
        assert (g.n_words, g.n_repeat_words, g.base_failed) == (n, len(covered), failed)
        means = [sum(weight[f, h(r["lang"], f, x(w))] for w in words) / max(n, 1) / 1e6
                 for f, x in (("head", lambda w: w[:4]), ("tail", lambda w: w[-2:]))]
        if all(abs(m + 0.25 / math.sqrt(max(n, 1))) > 1e-5 for m in means):
            assert g.kept == (not failed and all(m + 0.25 / math.sqrt(max(n, 1)) >= 0 for m in means))


def _xx(parts) -> int:
    seed = 42
    for p in parts:
        seed = xxhash.xxh64(p.encode(), seed=seed).intdigest()
    return seed - (1 << 64) if seed >= 1 << 63 else seed


def test_op6_base_score_and_proper_model(spark, table):
    got = {r.doc_id: r for r in Q.op6_lm_scores(spark, SF).collect()}
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tokens = {r["doc_id"]: [*WORD.findall((r["text"] or "").translate(lower)), " "] for r in table}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in tokens}
    c = Counter(w for i, t in tokens.items() if not held[i] for w in t)
    n, v = sum(c.values()), len(c)
    bits = chars = 0
    for i, t in tokens.items():
        g, base = got[i], sum(math.log10((c[w] + 1) / (n + v + 1)) for w in t)
        assert (g.held_out, g.n_tokens, g.n_known, g.train_tokens) == (held[i], len(t), sum(c[w] > 0 for w in t), n)
        assert g.base_score == pytest.approx(base, rel=1e-9)
        if held[i]:
            bits -= g.score / math.log10(2)
            chars += sum(len(w.encode()) + 1 for w in t)
    assert bits / chars < 2.6                      # held-out bits per byte; 8 without a model, 4.3 by letters alone


def test_op5_equals_the_articles(spark):
    import html
    got = {r.page_id: r.text for r in Q.op5_html_extraction(spark, SF).collect()}
    for p in pq.read_table(f"{SF}/pages.parquet").to_pylist():
        body = re.search(r"<article>(.*?)</article>", p["html"], re.S).group(1)
        body = re.sub(r"</?b>", "", re.sub(r"</?(p|h1|br)>", " ", body))
        assert got[p["page_id"]] == " ".join(html.unescape(body).split())


def test_op9_finds_all_verbatim_and_most_paraphrases(spark, table):
    bench = pq.read_table(f"{SF}/benchmark.parquet").to_pylist()
    norm = lambda t: " ".join(re.findall(r"[^\s!-/:-@\[-`{-~]+", t.lower()))
    want = {(r["doc_id"], b["item_id"]) for r in table for b in bench if norm(b["text"]) in norm(r["text"] or "")}
    found = Q.op9_benchmark_decontamination(spark, SF).collect()
    assert want == {(r.doc_id, r.item_id) for r in found}
    rng = random.Random(5)
    hosts = [r["text"].split() for r in table if r["text"] and len(r["text"].split()) > 80]
    rows = []
    for b in bench:
        words = [w if rng.random() > 0.1 else "replaced" for w in b["text"].split()]
        host, other = rng.choice(hosts), rng.choice(hosts)
        rows.append((10_000 + b["item_id"], " ".join([*host[:40], *words, *host[40:]])))
        rows.append((20_000 + b["item_id"], " ".join(other[::-1])))
    docs = spark.createDataFrame(rows + [(r["doc_id"], r["text"]) for r in table], "doc_id bigint, text string")
    b = spark.createDataFrame([(x["item_id"], x["text"]) for x in bench], "item_id bigint, text string")
    hits = {(r.doc_id, r.item_id) for r in lsa_decontam.contaminated(docs, b).collect()}
    assert sum((10_000 + x["item_id"], x["item_id"]) in hits for x in bench) >= 0.9 * len(bench)
    assert not any(d >= 20_000 for d, _ in hits)


def test_op10_on_held_out_labels(spark):
    from gridline.llm import weak_label
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    shown = labels.filter("doc_id % 4 <> 0")
    out = weak_label.classify(docs, shown).join(labels.filter("doc_id % 4 = 0"), "doc_id").collect()
    share = lambda q, t: np.mean([r.kept for r in out if (r.quality, r.toxic) == (q, t)])
    assert share(1, 0) > 0.97 and share(0, 0) < 0.05 and share(1, 1) < 0.4


def test_pipeline_stages(spark):
    import corpus_pipeline as P
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = P.quality_rules(spark, docs, SF)
    assert kept.columns == docs.columns
    small = spark.createDataFrame(kept.limit(300).collect(), kept.schema)
    one = P.near_dedup(spark, small, SF)
    clean = P.decontamination(spark, one, SF)
    mixed = P.source_mixing(spark, clean, SF)
    assert one.columns == clean.columns == mixed.columns == docs.columns
    out = P.token_output(spark, mixed, SF)
    assert out.count() == mixed.count() > 0
    assert small.count() >= one.count() >= clean.count() > 0
    sets = {r.doc_id: _shingles(r.text) for r in small.collect()}
    left = [r.doc_id for r in one.collect()]
    pairs = [(a, b) for i, a in enumerate(left) for b in left[:i] if sets[a] & sets[b]]
    assert all(100 * len(sets[a] & sets[b]) < 75 * len(sets[a] | sets[b]) for a, b in pairs)


def _shingles(text: str) -> set:
    w = WORD.findall(text.lower())
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)}
