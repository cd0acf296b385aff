"""The registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_conf
from .common import table
from .html_wrapper import main_texts
from .jaccard_join import similar_documents
from .line_dedup import dedup_lines
from .lsa_decontam import contaminated
from .minhash_join import near_duplicates
from .mix_lm import score_documents
from .mixing import plan_mix
from .oracle_sql import OP11_SQL, OP12_SQL, OP13_SQL
from .periodic_runs import digest, periodic_runs
from .quality_llr import BASE, fit_weights, judge, trusted_ids
from .secret_ledger import BASE_RULES, RULES, find_secrets, spans_text
from .spelling import variant_groups
from .token_blocks import read_documents, write_tokens
from .weak_label import classify


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_conf(spark)
    out = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


OP1_SQL = r"""
with l as (
  select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) pos
  from documents),
k as (
  select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') key
  from l),
r as (
  select key, max(doc_id) owner from k where length(key) >= 20
  group by key having count(distinct doc_id) >= 3),
m as (
  select k.doc_id, pos, line, r.key is not null and k.doc_id <> r.owner dropped
  from k left join r on k.key = r.key)
select doc_id, count(*)::bigint n_lines, (count(*) filter (dropped))::bigint n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (not dropped), '')) kept_sha256
from m group by doc_id
"""

def op2_token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    ensure_conf(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return read_documents(spark, write_tokens(docs, public_tokenizers.path("byte_bpe_50k.json")))


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_conf(spark)
    out = plan_mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return out.select("doc_id", "size", "source_size", "target", "taken")


OP3_SQL = r"""
with d as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint size,
         md5('7:' || doc_id) draw
  from documents),
p as (select greatest(1, ceil(sum(size) / 1048576.0))::bigint shards, floor(sum(size) / 16 + 0.5)::bigint seats from d),
s0 as (select source, sum(size)::bigint source_size, row_number() over (order by source nulls last) no from d group by source),
s1 as (select *, (no - 1) % 3 + 1 w, 3 * source_size cap from s0),
s2 as (
  select *, (sum(source_size) over () - coalesce(sum(cap) over (order by cap / w, no rows between unbounded preceding and 1 preceding), 0))
            / sum(w) over (order by cap / w, no rows between current row and unbounded following) lvl
  from s1),
s as (
  select *, least(cap::double, (select lvl from s2 where lvl <= cap / w order by cap / w, no limit 1) * w) target
  from s2),
sq as (  -- all quotients of all sources; the highest ones hold the seats
  select no, k, row_number() over (order by target / (2 * k + 1) desc, no) rank
  from s, (select unnest(range((select seats from p) + 1)) k) where k <= target / 16 + (select count(*) from s0)),
seats as (select no, count(*) q from sq where rank <= (select seats from p) group by no),
u0 as (select source, ('0x' || substr(draw, 1, 8))::bigint % shards shard, sum(size)::bigint z from d, p group by all),
u1 as (select s.no, shard, z, coalesce(q, 0) q, s.source_size, s.target from u0 join s on u0.source is not distinct from s.source left join seats using (no)),
uq as (
  select no, shard, q, row_number() over (partition by no order by z / (2 * k + 1) desc, shard) rank
  from (select *, unnest(range(q + 1)) k from u1)),
u2 as (select no, shard, count(*) q from uq where rank <= q group by all),
u as (
  select u1.no, shard, z, source_size, target, ceil(z / 16.0)::bigint n, least(coalesce(u2.q, 0), 3 * ceil(z / 16.0)::bigint) q,
         ('0x' || substr(md5('7:' || u1.no || ':' || shard), 1, 8))::bigint draw
  from u1 left join u2 using (no, shard)),
v as (select *, case when n > 0 then q // n else 0 end rounds, case when n > 0 then q % n else 0 end extra, case when n > 0 then draw % n else 0 end start from u),
l as (
  select doc_id, size, s.no, ('0x' || substr(draw, 1, 8))::bigint % shards shard,
         sum(size) over (partition by s.no, ('0x' || substr(draw, 1, 8))::bigint % shards order by draw, doc_id, size rows unbounded preceding) hi
  from d join s on d.source is not distinct from s.source, p)
select doc_id, size, source_size, target,
       (rounds * size
        + greatest(0, least(hi, least((start + extra) * 16, z)) - greatest(hi - size, start * 16))
        + greatest(0, least(hi, greatest(start + extra - n, 0) * 16) - (hi - size)))::bigint taken
from l join v using (no, shard)
"""

def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_conf(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    weights = fit_weights(docs, trusted_ids(table(spark, sf_dir, "labels")))
    return judge(docs, weights).select("doc_id", *BASE, "llr_head", "llr_tail", "kept")


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_conf(spark)
    return main_texts(table(spark, sf_dir, "pages"))


def op6_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_conf(spark)
    return score_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op7_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_conf(spark)
    found = find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    kinds = [r.kind for r in BASE_RULES]
    base = F.filter("spans", lambda s: s["kind"].isin(kinds))
    named = F.transform("spans", lambda s: s["kind"])
    counts = [(F.size(named) - F.size(F.array_remove(named, k))).cast("bigint").alias(f"n_{k}") for k in kinds]
    return found.select("doc_id", *counts, F.sha2(spans_text(base), 256).alias("base_sha256"),
                        spans_text(F.col("spans")).alias("spans"))


def _op7_sql() -> str:
    """Every rule's spans from the pieces between its matches, as the sums of their lengths."""
    quoted = lambda p: "'" + p.replace("'", "''") + "'"
    parts = " union all ".join(
        f"select doc_id, '{r.kind}' kind, {i} k, {r.least} least, regexp_extract_all(t, {quoted(r.pattern)}, 0) ms, "
        f"regexp_extract_all(t, {quoted(r.pattern)}, {r.group}) gs, regexp_split_to_array(t, {quoted(r.pattern)}) ps from d"
        for i, r in enumerate(RULES))
    return f"""
with d as (select doc_id, coalesce(text, '') t from documents),
m as ({parts}),
u as (select doc_id, kind, k, least, unnest(ms) m, unnest(gs) g, unnest(ps[1:len(ms)]) b, unnest(range(len(ms))) i from m),
w as (
  select *, sum(length(b) + length(m)) over (partition by doc_id, kind order by i) fin from u),
s as (select doc_id, kind, k, fin - length(m) st, fin from w where length(g) >= least),
a as (
  select doc_id, count(*) filter (kind = 'assign') n_assign, count(*) filter (kind = 'access') n_access,
         count(*) filter (kind = 'hex') n_hex,
         string_agg(kind || ':' || st::bigint || ':' || fin::bigint, ',' order by st, k) filter (k < 3) base,
         string_agg(kind || ':' || st::bigint || ':' || fin::bigint, ',' order by st, k) spans
  from s group by doc_id)
select doc_id, coalesce(n_assign, 0)::bigint n_assign, coalesce(n_access, 0)::bigint n_access,
       coalesce(n_hex, 0)::bigint n_hex, sha256(coalesce(base, '')) base_sha256, coalesce(spans, '') spans
from documents left join a using (doc_id)
"""


def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_conf(spark)
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


# All pairs that share a shingle, compared in full; components by a recursive walk from each document.
OP8_SQL = r"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') w
  from documents),
s as (
  select distinct doc_id, unnest(case when len(w) >= 5 then list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))
                                      when len(w) > 0 then ['short ' || array_to_string(w, ' ')] else [] end) g
  from w),
n as (select doc_id, count(*) n from s group by doc_id),
p as (
  select a.doc_id a, b.doc_id b, count(*) shared from s a join s b on a.g = b.g and a.doc_id <> b.doc_id group by all),
e as (
  select a, b from p join n x on a = x.doc_id join n y on b = y.doc_id where 100 * shared >= 75 * (x.n + y.n - shared)),
r as (
  select doc_id node, doc_id root from documents
  union
  select e.b, r.root from r join e on e.a = r.node)
select d.doc_id, coalesce(n.n, 0)::bigint n_shingles, c.component_id, d.doc_id = c.component_id kept
from documents d left join n on d.doc_id = n.doc_id
join (select node, min(root) component_id from r group by node) c on c.node = d.doc_id
"""


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_conf(spark)
    return contaminated(table(spark, sf_dir, "documents").select("doc_id", "text"),
                        table(spark, sf_dir, "benchmark"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_conf(spark)
    out = classify(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", "p_quality", "p_tone", "kept")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_conf(spark)
    return variant_groups(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_conf(spark)
    return digest(periodic_runs(table(spark, sf_dir, "documents").select("doc_id", "text"), plant=True))


def op13_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_conf(spark)
    return similar_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_token_blocks": op2_token_blocks,
    "op3_mix_sources": op3_mix_sources,
    "op4_quality_rules": op4_quality_rules,
    "op5_html_extraction": op5_html_extraction,
    "op6_lm_scores": op6_lm_scores,
    "op7_secret_scans": op7_secret_scans,
    "op8_minhash_near_dedup": op8_minhash_near_dedup,
    "op9_benchmark_decontamination": op9_benchmark_decontamination,
    "op10_quality_classifier": op10_quality_classifier,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_ngram_jaccard_join": op13_ngram_jaccard_join,
}

ORACLES = {
    "op1_line_dedup": OP1_SQL,
    "op3_mix_sources": OP3_SQL,
    "op7_secret_scans": _op7_sql(),
    "op8_minhash_near_dedup": OP8_SQL,
    "op11_spelling_variants": OP11_SQL,
    "op12_periodic_runs": OP12_SQL,
    "op13_ngram_jaccard_join": OP13_SQL,
}
