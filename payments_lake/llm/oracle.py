"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

SPACE = r"\x20\x09-\x0D"
LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP1 = """
with keyed as (
    select page_id, coalesce(html, '') as payload, sha1(coalesce(html, '')) as digest from pages
), named as (
    select *, max(page_id) over (partition by digest) as keeper from keyed
)
select
    page_id,
    cast(strlen(payload) as bigint) as payload_bytes,
    array_to_string(list_transform(range(0, 32), lambda i: substr(
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        1 + cast(((('0x' || substr(digest, 1 + 5 * (i // 4), 5))::integer >> (15 - 5 * (i % 4))) & 31) as integer),
        1)), '') as payload_digest,
    case when page_id = keeper then 'response' else 'revisit' end as record_type,
    case when page_id <> keeper then keeper end as refers_to
from named
"""

_SHINGLES = f"""
{{name}}_words as (
    select {{id}} as id, regexp_extract_all({LOWER}, '[^{SPACE}]+') as w from {{table}}
), {{name}} as (
    select distinct id, unnest(list_transform(
        range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i:i + 4], ' ')
    )) as shingle
    from {{name}}_words where len(w) > 0
), {{name}}_size as (select id, count(*) as n from {{name}} group by id)
"""

OP4 = f"""
with recursive {_SHINGLES.format(name="sets", id="doc_id", table="documents")},
shared as (
    select a.id as a, b.id as b, count(*) as n
    from sets a join sets b on a.shingle = b.shingle and a.id < b.id group by a.id, b.id
), links as (
    select a, b from shared join sets_size x on x.id = a join sets_size y on y.id = b
    where 100 * shared.n >= 75 * (x.n + y.n - shared.n)
), both_ways as (
    select a, b from links union all select b, a from links
), reach(id, other) as (
    select doc_id, doc_id from documents
    union
    select reach.id, both_ways.b from reach join both_ways on reach.other = both_ways.a
)
select doc_id, coalesce(s.n, 0) as n_shingles, c.component_id
from documents
join (select id, min(other) as component_id from reach group by id) c on c.id = doc_id
left join sets_size s on s.id = doc_id
"""

OP10 = f"""
with {_SHINGLES.format(name="sets", id="doc_id", table="documents")},
{_SHINGLES.format(name="items", id="item_id", table="benchmark")},
shared as (
    select s.id as doc_id, i.id as item_id, count(*) as n_shared
    from sets s join items i using (shingle) group by s.id, i.id
)
select doc_id, item_id, n as n_item_shingles, n_shared, n_shared / n as containment
from shared join items_size on items_size.id = item_id
where 100 * n_shared >= 75 * n
"""

# Embeddings without null, NaN or infinite components, as (row number, place, integer) lines. The
# row numbers follow the order of vec_id.
_VECTORS = """
kept as materialized (
    select row_number() over (order by vec_id, embedding) as r, vec_id, label, embedding as e from embeddings
    where len(embedding) {length} and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), parts as materialized (
    select r, cast(unnest(list_transform(e, lambda x: floor(1024 * x::double))) as bigint) as x,
        unnest(range(0, len(e))) as i
    from kept
)
"""

_ASSIGN = """
, near{t} as materialized (
    select r, p, arg_min(k, (d, k)) as k, min(d) as d from (
        select v.r, c.p, c.k, cast(sum((v.x - c.x) * (v.x - c.x)) as bigint) as d
        from parts v join book{t} c on v.i = c.i group by v.r, c.p, c.k
    ) group by r, p
)
"""

# The floor of a quotient of whole numbers, also below zero.
_STEP = """
, sums{t} as materialized (
    select c.p, c.k, c.i, sum(v.x) as s, count(*) as n
    from near{b} a join parts v using (r) join (select distinct p, k, i from book{b}) c on c.p = a.p and c.k = a.k and c.i = v.i
    group by c.p, c.k, c.i
), book{t} as materialized (
    select p, k, i, cast(case when n is null then x else (s - ((s % n) + n) % n) // n end as bigint) as x
    from book{b} left join sums{t} using (p, k, i)
)
"""


def _trained(first: str, rounds: int, length: str) -> str:
    steps = "".join(_ASSIGN.format(t=t) + _STEP.format(t=t + 1, b=t) for t in range(rounds))
    return f"with {_VECTORS.format(length=length)}, book0 as materialized ({first}){steps}{_ASSIGN.format(t=rounds)}"


OP11 = _trained(
    """
    select 0 as p, s.k, v.i, v.x from parts v join (
        select r, row_number() over (order by sha256('3:' || vec_id::varchar), e) - 1 as k from kept
    ) s using (r) where s.k < 8
    """, 10, "= 64",
) + """
, named as (
    select k, sha256(string_agg(x::varchar, ',' order by i)) as centroid_sha256 from book10 group by k
), totals as (select k, sum(d) as cluster_inertia from near10 group by k)
select
    vec_id, cast(k as integer) as cluster, d as distance, cast(cluster_inertia as bigint) as cluster_inertia,
    cast((select sum(d) from near10) as bigint) as inertia, centroid_sha256
from near10 join kept using (r) join named using (k) join totals using (k)
"""

OP13 = _trained(
    """
    select v.i // (len(e) // 4) as p, r - 1 as k, v.i, v.x from parts v join kept using (r) where r <= 256
    """, 4, "> 0",
) + """
, coded as (
    select r, string_agg(lpad(lower(to_hex(k)), 2, '0'), '' order by p) as code, sum(d) as error
    from near4 group by r
), totals as (
    select label, sum(error) as label_error from coded join kept using (r) group by label
)
select
    vec_id, code, cast(error as bigint) as error, cast(label_error as bigint) as label_error,
    (select sha256(string_agg(x::varchar, ',' order by p, k, i)) from book4) as codebooks_sha256
from coded join kept using (r) join totals on totals.label is not distinct from kept.label
"""

ORACLE = {
    "op1_warc_chunks": OP1,
    "op4_jaccard_join": OP4,
    "op10_decontamination": OP10,
    "op11_centroid_clusters": OP11,
    "op13_vector_codes": OP13,
}
