"""SQL of the queries on words, periods and n-gram sets (DuckDB)."""

LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def crc32(text: str) -> str:
    """The unsigned checksum of a string's UTF-8 bytes, bit by bit: a byte joins at the first of its eight steps."""
    at = f"('0x' || substr(hex(encode({text})), (2 * (k // 8) + 1)::bigint, 2))::bigint"
    steps = f"list_transform(range(8 * octet_length(encode({text}))), lambda k: case when k % 8 = 0 then {at} else 0 end)"
    step = "case when xor(c, b) & 1 = 1 then xor(xor(c, b) >> 1, 3988292384) else xor(c, b) >> 1 end"
    return f"xor(list_reduce(list_concat([4294967295::bigint], {steps}), lambda c, b: {step}), 4294967295::bigint)"


OP11_SQL = f"""
with recursive r as (
  select doc_id, {LOWER.format("unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]{6,}'))")} run from documents),
g as (select doc_id, run, count(*) c, doc_id || ':' || run id from r group by all),
h as (select *, {crc32("id")} h from g),
w as (
  select case when h % 199 = 0 then left(run, (h % length(run))::int) || substr(run, (h % length(run))::int + 2) else run end word, c
  from h),
v as (select word, sum(c)::bigint n from w where length(word) >= 6 group by word having sum(c) >= 5),
i as (select word, n, unnest(range(length(word)))::int i from v),
d as (select distinct word, n, left(word, i) || substr(word, i + 2) edit from i),
p as (select word, n, left(word, i) || '*' || substr(word, i + 2) edit from i),
e as (
  select d.word, d.n, v.word near, v.n near_n from d join v on v.word = d.edit
  union all select v.word, v.n, d.word, d.n from d join v on v.word = d.edit
  union all select a.word, a.n, b.word, b.n from p a join p b on a.edit = b.edit and a.word <> b.word),
f as (
  select word, near form, near_n form_n from e
  qualify row_number() over (partition by word order by near_n desc, near) = 1 and near_n >= 5 * n),
c as (
  select word, word root, 0 depth from v
  union all select c.word, f.form, depth + 1 from c join f on f.word = c.root)
select v.word, v.n, coalesce(m.n_near, 0)::bigint n_near, f.form, f.form_n, c.root
from v left join (select word, count(*) n_near from e group by word) m using (word) left join f using (word)
join (select word, arg_max(root, depth) root from c group by word) c using (word)
"""

OP12_SQL = f"""
with t as (
  select doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') w, {crc32("doc_id::varchar")} h from documents),
u as (select *, len(w)::bigint n, h // 10 g from t),
o as (select *, case when n > 0 then g % n else 0 end a from u),
x as (select *, case when h % 10 = 0 and n > 0 then a else n end first, 1 + (n - a) // (3 + g % 8) p from o),
l as (select *, unnest(range(n)) i from x),
y as (select doc_id, n, i, w[case when i < first then i else first + (i - first) % p end + 1] word from l),
m as (select a.doc_id, a.i, b.i - a.i q from y a join y b on a.doc_id = b.doc_id and a.word = b.word
      and b.i > a.i and 3 * (b.i - a.i) <= a.n),
s as (
  select doc_id, q, min(i) start, count(*) + q length
  from (select *, i - row_number() over (partition by doc_id, q order by i) k from m) group by doc_id, q, k
  having count(*) + q >= greatest(24, 3 * q)),
r as (select doc_id, start, length, min(q) period from s group by doc_id, start, length),
b as (
  select * from r
  qualify row_number() over (partition by doc_id order by length / period desc, start, period) = 1),
k as (
  select doc_id, i, word from y
  where not exists (select 1 from r where r.doc_id = y.doc_id and i >= start + period and i < start + length)),
c as (select doc_id, string_agg(word, ' ' order by i) t from k group by doc_id),
z as (select doc_id, count(*) n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' order by start, period) t
      from r group by doc_id)
select d.doc_id, coalesce(z.n_runs, 0)::bigint n_runs, b.start::bigint start, b.length::bigint length, b.period::bigint period,
       (1000 * b.length // b.period)::bigint exponent_milli, sha256(coalesce(z.t, '')) runs_sha256,
       sha256(coalesce(c.t, '')) collapsed_sha256
from documents d left join z using (doc_id) left join b using (doc_id) left join c using (doc_id)
"""

# All pairs that share a shingle, compared in full; components by a recursive walk from each document.
OP13_SQL = f"""
with recursive w as (
  select doc_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[^\\x20\\x09-\\x0D]+') w from documents),
s as (
  select distinct doc_id, unnest(case when len(w) >= 3 then list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i+2], ' '))
                                      when len(w) > 0 then ['short ' || array_to_string(w, ' ')] else [] end) g
  from w),
n as (select doc_id, count(*) n from s group by doc_id),
p as (
  select a.doc_id a, b.doc_id b, count(*) shared from s a join s b on a.g = b.g and a.doc_id <> b.doc_id group by all),
e as (
  select a, b from p join n x on a = x.doc_id join n y on b = y.doc_id where 100 * shared >= 90 * (x.n + y.n - shared)),
r as (
  select doc_id node, doc_id root from documents
  union
  select e.b, r.root from r join e on e.a = r.node)
select d.doc_id, coalesce(n.n, 0)::bigint n_shingles, c.component_id
from documents d left join n on d.doc_id = n.doc_id
join (select node, min(root) component_id from r group by node) c on c.node = d.doc_id
"""
