"""What the review of round 2 found cut short: each of these failed before."""

import random

import numpy as np
import pyarrow.parquet as pq
import pytest

from gridline.llm import lsa_decontam

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("share", [0.6, 0.65, 0.7, 0.8])
def test_op9_finds_all_that_a_plain_subsequence_search_accepts(spark, share):
    rng = random.Random(int(share * 100))
    table = [(r["doc_id"], r["text"]) for r in pq.read_table(f"{SF}/documents.parquet").to_pylist() if r["text"]]
    bench = [(r["item_id"], r["text"]) for r in pq.read_table("/root/testdata/sf0.1/benchmark.parquet").to_pylist()]
    hosts = [t.split() for _, t in table if len(t.split()) > 80]
    rows, want = [], set()
    for i, text in bench:
        words, host = text.split(), rng.choice(hosts)
        # Words before the answer are changed until no more may be; the answer's are kept.
        keep = -(-round(share * 100) * len(words) // 100)
        for k in rng.sample(range(len(words) - 5), min(len(words) - 5, len(words) - keep)):
            words[k] = rng.choice(host)
        cut = rng.randrange(len(host))
        rows.append((10_000_000 + i, " ".join([*host[:cut], *words, *host[cut:]])))
        own, new = (lsa_decontam._terms([t.encode()])[0].tolist() for t in (text, " ".join(words)))
        if _lcs(own, new) >= 0.6 * len(own) and _lcs(own[-5:], new) >= 4:
            want.add((10_000_000 + i, i))
    docs = spark.createDataFrame(table + rows, "doc_id bigint, text string")
    items = spark.createDataFrame(bench, "item_id bigint, text string")
    found = {(r.doc_id, r.item_id) for r in lsa_decontam.contaminated(docs, items).collect()}
    assert len(want) > 150 and not want - found, f"{len(want - found)} of {len(want)} not found"


def _lcs(a: list, b: list) -> int:
    row = np.zeros(len(b) + 1, int)
    for x in a:
        new = row.copy()
        for j, y in enumerate(b):
            new[j + 1] = row[j] + 1 if x == y else max(new[j], row[j + 1])
        row = new
    return int(row[-1])


def test_op9_texts_without_a_near_window(spark):
    docs = spark.createDataFrame([(1, "some words of no passage"), (2, "alpha beta gamma delta epsilon")], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, "alpha beta gamma delta epsilon")], "item_id bigint, text string")
    for cosine in (0.42, 2.0):      # no pair at all is this near
        found = lsa_decontam.contaminated(docs, items, cosine=cosine).collect()
        assert [(r.doc_id, r.item_id, r.lcs_share) for r in found] == [(2, 1, 1.0)]


def test_op4_languages_without_trusted_text_are_judged_by_their_text(spark):
    from gridline.llm import quality_llr
    good = [" ".join(f"{w}{i}" for w in ("house", "river", "garden", "window")) + " stands by these quiet old green hills" for i in range(60)]
    junk = [" ".join(f"{w}{i}" for w in ("zzxq", "qqwk", "xxvb", "kkjh")) + " xkcdz qzwxv bbnmq vvvxz wqzzk jjxqw" for i in range(60)]
    rows = [(i, t, "en") for i, t in enumerate(good + junk)]
    rows += [(1000 + i, t, lang) for i, (t, lang) in enumerate((t, lang) for lang in (None, "pl") for t in good[:20])]
    rows += [(2000 + i, t, lang) for i, (t, lang) in enumerate((t, lang) for lang in (None, "pl") for t in junk[:20])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    trusted = spark.createDataFrame([(i,) for i in range(0, 60)], "doc_id bigint")
    got = {r.doc_id: r.kept for r in quality_llr.judge(docs, quality_llr.fit_weights(docs, trusted)).collect()}
    assert all(got[i] == (i < 60) for i in range(120))
    assert all(got[1000 + i] and not got[2000 + i] for i in range(40))


@pytest.mark.parametrize("n", [64 + 1, 64 + 5, 2 * 64 + 7, 320])
def test_op5_every_page_of_a_host_has_a_whole_block_to_compare_with(spark, n):
    from gridline.llm import html_wrapper
    rng = random.Random(n)
    said = [" ".join(rng.choice("abcdefgh") * 3 + str(rng.randrange(10**6)) for _ in range(30)) for _ in range(n)]
    rows = [(i, f"http://h/{i}", f"<article><h2>{t.split()[0]}</h2><p>{t}</p><blockquote>Read more on our site</blockquote></article>")
            for i, t in enumerate(said)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = {r.page_id: r.text for r in html_wrapper.main_texts(pages).collect()}
    assert got == {i: f"{t.split()[0]} {t}" for i, t in enumerate(said)}


def test_op5_keeps_all_articles():
    from gridline.llm import html_wrapper
    page = ("<main><article><h1>One</h1><p>first text</p></article><article><p>second one</p></article></main>"
            "<div class=comments><article>a reader's</article></div>")
    assert html_wrapper.extract([page]) == ["One first text second one"]


def test_op10_recall_of_toxic_documents_and_passages(spark):
    from gridline.llm import weak_label
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    texts = {r.doc_id: r.text for r in docs.filter("text is not null").collect()}
    told = {r.doc_id: (r.quality, r.toxic) for r in labels.collect() if r.doc_id in texts}
    held = lambda kind: [i for i in sorted(told) if i % 4 == 0 and told[i] == kind]
    rng, rows = random.Random(1), []
    for i in held((1, 1)):      # a toxic text within a civil one of some thousand words, and that one alone
        host = " ".join(texts[k] for k in rng.sample(held((1, 0)), 12)).split()
        cut = rng.randrange(len(host))
        rows += [(10**7 + i, " ".join([*host[:cut], texts[i], *host[cut:]])), (2 * 10**7 + i, " ".join(host))]
    more = docs.unionByName(spark.createDataFrame(rows, "doc_id bigint, text string"))
    kept = {r.doc_id: r.kept for r in weak_label.classify(more, labels.filter("doc_id % 4 <> 0")).collect()}
    share = lambda ids: np.mean([kept[i] for i in ids])
    assert share(held((1, 1))) <= 0.09 and share(held((1, 0))) > 0.97
    assert share([10**7 + i for i in held((1, 1))]) < 0.5 and share([2 * 10**7 + i for i in held((1, 1))]) > 0.97
