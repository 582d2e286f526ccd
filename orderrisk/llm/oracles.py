"""SQL for those queries of this package whose rows SQL can express in seconds."""

from __future__ import annotations

_PARTS, _ENTRIES, _ROUNDS = 8, 16, 6


def _vector_codes() -> str:
    """Every round is a table of nearest entries and one of means."""
    gap = "list_sum([(a.v[i] - b.v[i]) * (a.v[i] - b.v[i]) for i in range(1, len(a.v) + 1)])"
    steps = [
        f"""with kept as (
  select vec_id, label, [cast(floor(4096 * cast(x as double)) as bigint) for x in embedding] as v from embeddings
  where embedding is not null and len([x for x in embedding if x is null or not isfinite(x)]) = 0
), parts as (
  select vec_id, p, v[p * (len(v) // {_PARTS}) + 1 : (p + 1) * (len(v) // {_PARTS})] as v from kept, range({_PARTS}) t(p)
), book0 as (
  select p, row_number() over (partition by p order by vec_id) - 1 as e, v from parts
  qualify row_number() over (partition by p order by vec_id) <= {_ENTRIES}
)"""
    ]
    for r in range(1, _ROUNDS + 2):
        steps.append(f"""near{r} as materialized (
  select a.vec_id, a.p, a.v, min(struct_pack(d := {gap}, e := b.e)) as best from parts a join book{r - 1} b on a.p = b.p group by all
)""")
        if r <= _ROUNDS:
            steps.append(f"""mean{r} as (
  select p, e, list(m order by i) as v from (
    select p, best.e as e, i, cast(floor(cast(sum(v[i]) as double) / count(*)) as bigint) as m
    from near{r}, range(1, len(v) + 1) t(i) group by all
  ) group by all
), book{r} as materialized (
  select b.p, b.e, coalesce(m.v, b.v) as v from book{r - 1} b left join mean{r} m on b.p = m.p and b.e = m.e
)""")
    return ",\n".join(steps) + f""", coded as (
  select vec_id, string_agg(format('{{:02x}}', best.e), '' order by p) as code, cast(sum(best.d) as bigint) as error
  from near{_ROUNDS + 1} group by vec_id
), digest as (
  select sha256(string_agg(array_to_string(v, ','), ',' order by p, e)) as h from book{_ROUNDS}
)
select k.vec_id, k.label, c.code, c.error, cast(sum(c.error) over (partition by k.label) as bigint) as label_error, h as codebooks_sha256
from kept k join coded c on k.vec_id = c.vec_id, digest"""


def _terms(key: str, table: str) -> str:
    return f"""select {key}, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) as term from {table}"""


def _lexical_search() -> str:
    return f"""with postings as materialized (
  select doc_id, term, count(*) as tf from ({_terms('doc_id', 'documents')}) group by all
), lengths as (
  select doc_id, cast(sum(tf) as bigint) as n from postings group by all
), whole as (
  select count(*) as n_docs, cast(sum(n) as bigint) as n_terms from lengths
), weights as (
  select term, cast(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) as bigint) as w from postings, whole group by term, n_docs
), sized as (
  select doc_id, 100 - 90 + ((90 * n * n_docs) // n_terms) as m from lengths, whole
), scored as (
  select item_id, doc_id, cast(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) as bigint) as score
  from (select distinct * from ({_terms('item_id', 'benchmark')})) join postings using (term) join weights using (term) join sized using (doc_id)
  group by all
)
select item_id, cast(row_number() over (partition by item_id order by score desc, doc_id) as integer) as rank, doc_id, score
from scored where score > 0 qualify rank <= 10"""


def _near_duplicates(percent: int, more: str = "") -> str:
    """Shared shingles of every pair, and components by walking the links."""
    return f"""with recursive words as (
  select doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') as w from documents
), shingles as materialized (
  select distinct doc_id, array_to_string(w[i : i + 4], ' ') as s from words, range(1, greatest(len(w) - 4, 1) + 1) t(i) where len(w) > 0
), sizes as materialized (
  select doc_id, count(*) as n from shingles group by doc_id
), links as materialized (
  select x, y from (
    select a.doc_id as x, b.doc_id as y, count(*) as shared from shingles a join shingles b on a.s = b.s and a.doc_id != b.doc_id group by all
  ) join sizes p on p.doc_id = x join sizes q on q.doc_id = y where 100 * shared >= {percent} * (p.n + q.n - shared)
), reached as (
  select doc_id as x, doc_id as y from documents
  union
  select r.x, l.y from reached r join links l on r.y = l.x
)
select d.doc_id, coalesce(n, 0) as n_shingles, min(y) as component_id{more} from documents d left join sizes using (doc_id) join reached on x = d.doc_id
group by d.doc_id, n"""


ORACLES: dict[str, str] = {
    "op2_ngram_jaccard": _near_duplicates(75),
    "op11_vector_codes": _vector_codes(),
    "op12_lexical_search": _lexical_search(),
    "op13_minhash_dedup": _near_duplicates(85, ", min(y) = d.doc_id as kept"),
}
