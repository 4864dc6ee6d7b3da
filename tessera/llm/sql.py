"""DuckDB SQL for the queries that it can express, over the whole tables.

The others have none: tokenisers, trained models, XXH64 fingerprints, edit distances of regions and packing are not
SQL; tests/llm compares them with brute force.
"""

from __future__ import annotations

#: Words' windows counted as hashes of their joined words; the words of windows counted twice or more go.
SUBSTRING_TREES = r"""
with w as (select doc_id, rowid_, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from (select *, row_number() over () as rowid_ from documents)),
p as (select rowid_, unnest(range(1, len(ws) - 33)) as i, ws from w where len(ws) >= 35),
k as (select rowid_, i, sha256(array_to_string(ws[i:i + 34], ' ')) as h from p),
hit as (select rowid_, i from k where h in (select h from k group by h having count(*) > 1)),
gone as (select rowid_, list(distinct j) as js from (select rowid_, unnest(range(i, i + 35)) as j from hit) group by 1)
select w.doc_id, cast(len(ws) as bigint) as n_words, cast(coalesce(len(js), 0) as bigint) as n_removed,
  sha256(array_to_string(case when js is null then ws else list_filter(ws, lambda x, i: not list_contains(js, i)) end, ' ')) as kept_sha256
from w left join gone on gone.rowid_ = w.rowid_"""

#: Bytes' windows as 128-bit hashes of their hex digits (read in overlapping parts, as a substring far in costs its place).
RUN_LENGTH_INDEX = """
with d as (select row_number() over () as r, doc_id, hex(encode(coalesce(text, ''))) as x from documents),
c as (select r, coalesce(doc_id, 9223372036854775807) as o, unnest(list_transform(range(0, cast(length(x) // 2 - 49 as bigint), 400), lambda c: {'c': c, 'y': substr(x, 2 * c + 1, 898)})) as w from d where length(x) >= 100),
p as (select r, o, unnest(list_transform(range(0, least(400, cast(length(w.y) // 2 - 49 as bigint))), lambda j: {'i': w.c + j, 's': md5_number(substr(w.y, 2 * j + 1, 100))})) as w from c),
k as (select r, o, w.i as i, w.s as s from p),
m as (select s, min(o) as least from k group by s),
hit as (select r, i from k join m using (s) where least < o),
step as (select r, i, lead(i) over (partition by r order by i) as nx, lag(i) over (partition by r order by i) as pv from hit),
run as (select r, i, sum(case when pv is null or i > pv + 50 then 1 else 0 end) over (partition by r order by i) as g from step),
span as (select r, g, min(i) as a, max(i) + 50 as b from run group by r, g),
s2 as (select r, list(a order by a) as ax, list(b order by a) as bx, count(*) as n, sum(b - a) as gone from span group by r)
select doc_id, cast(length(x) // 2 as bigint) as n_bytes, cast(coalesce(gone, 0) as bigint) as n_removed, cast(coalesce(n, 0) as bigint) as n_spans,
 sha256(from_hex(case when n is null then x else array_to_string(list_transform(range(0, cast(n + 1 as bigint)), lambda q: substr(x, 2 * (case when q = 0 then 0 else bx[q] end) + 1, 2 * ((case when q = n then length(x) // 2 else ax[q + 1] end) - (case when q = 0 then 0 else bx[q] end)))), '') end)) as kept_sha256
from d left join s2 on s2.r = d.r"""

#: All inner products of the query rows.
NEIGHBOURS = """
with v as (select vec_id, cast(embedding as double[]) as e from embeddings where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0),
s as (select q.vec_id as query_id, c.vec_id, list_inner_product(q.e, c.e) as score from v q join v c on q.vec_id <> c.vec_id where q.vec_id % 20 = 0),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s)
select query_id, cast(rank as integer) as rank, vec_id, score from r where rank <= 20"""

#: CRC-32 of a short ASCII text: each character's bits are shifted through the polynomial.
CRC32 = """xor(4294967295, list_reduce(flatten(list_prepend([4294967295], list_transform(range(1, length({x}) + 1), lambda i: [ord(substr({x}, i, 1)), -1, -1, -1, -1, -1, -1, -1, -1]))),
  lambda c, b: case when b >= 0 then xor(c, b) else xor(c >> 1, 3988292384 * (c & 1)) end))"""

#: Equal words of one text at each distance up to a fourth of it, in islands of neighbours.
PERIODIC_RUNS = (
    r"""
with b as (select row_number() over () as r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws, """
    + CRC32.format(x="cast(doc_id as varchar)")
    + r""" as h from documents),
c as (select *, len(ws) as n, h // 10 as g, case when len(ws) > 0 then (h // 10) % len(ws) end as a from b),
e as (select *, 1 + (n - a) // (3 + g % 8) as p from c),
d as (select r, doc_id, n, case when h % 10 = 0 and n > 0 then list_transform(range(0, n), lambda i: ws[cast(case when i < a then i else a + (i - a) % p end as bigint) + 1]) else ws end as ws from e),
w as (select r, n, unnest(range(0, n)) as i, unnest(ws) as w from d),
m as (select x.r, x.i, y.i - x.i as q from w x join w y on x.r = y.r and x.w = y.w and y.i > x.i and 4 * (y.i - x.i) <= x.n),
s as (select r, q, i, i - row_number() over (partition by r, q order by i) as island from m),
t as (select r, q, min(i) as start, count(*) + q as length from s group by r, q, island having count(*) + q >= greatest(6, 4 * q)),
u as (select r, start, length, min(q) as period from t group by r, start, length),
k as (select r, count(*) as n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' order by start, period) as said, arg_max({'start': start, 'length': length, 'period': period}, (length, -start, -period)) as best from u group by r),
gone as (select distinct r, unnest(range(start + period, start + length)) as i from u),
kept as (select w.r, string_agg(w.w, ' ' order by w.i) as kept from w anti join gone on w.r = gone.r and w.i = gone.i group by w.r)
select doc_id, cast(coalesce(n_runs, 0) as bigint) as n_runs, cast(best.start as bigint) as start, cast(best.length as bigint) as length, cast(best.period as bigint) as period,
  cast(1000 * best.length // best.period as bigint) as exponent_milli, sha256(coalesce(said, '')) as runs_sha256, sha256(coalesce(kept, '')) as collapsed_sha256
from d left join k using (r) left join kept using (r)"""
)

#: One column in a leaf.
FIELD = "case when {c} is null then '-' else strlen(cast({c} as varchar)) || ':' || {c} end"
#: Levels as lists of digests, up to one; siblings gathered, and leaves folded, level by level.
MERKLE_MANIFEST = (
    "with recursive b as (select doc_id, lang, sha256("
    + " || ".join(FIELD.format(c=c) for c in ("doc_id", "source", "lang", "n_chars", "text"))
    + ") as leaf, sha256("
    + " || ".join(FIELD.format(c=c) for c in ("doc_id", "source", "lang", "n_chars", "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"))
    + ") as lower_leaf, "
    + CRC32.format(x="cast(doc_id as varchar)")
    + """ as crc from documents),
d as (select *, coalesce('=' || lang, '-') as t, case when crc % 3 = 0 then lower_leaf else leaf end as shown, row_number() over (order by lang nulls first, doc_id nulls first, leaf) as r,
  row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as i from b),
lower_levels as (select t, 0 as k, list(leaf order by i) as hs from d group by t
  union all select t, k + 1, list_transform(range(0, len(hs), 8), lambda j: sha256(array_to_string(hs[j + 1:j + 8], ''))) from lower_levels where len(hs) > 1),
subroots as (select t, hs[1] as subroot, k as deep, row_number() over (order by t) - 1 as place from lower_levels where len(hs) = 1),
upper_levels as (select 0 as k, list(subroot order by t) as hs from subroots
  union all select k + 1, list_transform(range(0, len(hs), 8), lambda j: sha256(array_to_string(hs[j + 1:j + 8], ''))) from upper_levels where len(hs) > 1),
levels as (select t, k, hs from lower_levels where len(hs) > 1 union all select s.t, s.deep + u.k, u.hs from upper_levels u, subroots s where len(u.hs) > 1),
spots as (select d.r, l.k, l.hs, case when l.k < s.deep then d.i // cast(pow(8, l.k) as bigint) else s.place // cast(pow(8, l.k - s.deep) as bigint) end as i from d join subroots s on s.t = d.t join levels l on l.t = d.t),
steps as (select r, k, array_to_string(hs[i // 8 * 8 + 1:i], '') as before, array_to_string(hs[i + 2:i // 8 * 8 + 8], '') as after from spots),
folding as (select r, 0 as k, shown as h from d union all select f.r, f.k + 1, sha256(s.before || f.h || s.after) from folding f join steps s on s.r = f.r and s.k = f.k),
folded as (select r, arg_max(h, k) as h from folding group by r),
proofs as (select r, string_agg(before || after, '' order by k) as said from steps group by r),
top as (select hs[1] as root from upper_levels where len(hs) = 1)
select doc_id, leaf, subroot, root, sha256(coalesce(said, '')) as proof_sha256, folded.h as folded_root, folded.h = root as verified
from d join subroots s on s.t = d.t join folded on folded.r = d.r left join proofs on proofs.r = d.r, top"""
)

#: Sets that share a shingle, their overlaps, and all that links reach.
JACCARD_JOIN = r"""
with recursive w as (select row_number() over () as r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as ws from documents),
s as (select r, doc_id, case when len(ws) = 0 then cast([] as varchar[]) when len(ws) < 4 then [array_to_string(ws, ' ')] else list_sort(list_distinct(list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' ')))) end as g from w),
u as (select g, min(r) as node, len(g) as n from s where len(g) > 0 group by g),
t as (select node, n, unnest(g) as h from u),
l as (select a.node as a, b.node as b from t a join t b on a.h = b.h and a.node < b.node and 100 * a.n >= 85 * b.n and 100 * b.n >= 85 * a.n group by a.node, b.node, a.n, b.n having 100 * count(*) >= 85 * (a.n + b.n - count(*))),
e as (select a, b from l union all select b, a from l),
x as (select node as a, node as b from u union select x.a, e.b from x join e on x.b = e.a),
d as (select u.node, min(s.doc_id) as least from u join s on s.g = u.g group by u.node),
c as (select x.a as node, min(d.least) as least from x join d on d.node = x.b group by x.a)
select doc_id, cast(len(s.g) as bigint) as n_shingles, case when len(s.g) = 0 then doc_id else c.least end as component_id
from s left join u on u.g = s.g left join c on c.node = u.node"""

ORACLES = {"op2_substring_trees": SUBSTRING_TREES, "op5_run_length_index": RUN_LENGTH_INDEX, "op10_one_bit_neighbours": NEIGHBOURS, "op11_merkle_manifest": MERKLE_MANIFEST, "op12_periodic_runs": PERIODIC_RUNS, "op13_jaccard_join": JACCARD_JOIN}
