"""The corpus queries in DuckDB SQL, where SQL can say them. Rounds of iterative ones are spelled out."""

from __future__ import annotations

_FINITE = "embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0"


def _floor_div(a: str, n: str) -> str:
    """Quotient of whole numbers rounded down; `//` cuts towards zero."""
    return f"(({a}) - ((({a}) % ({n})) + ({n})) % ({n})) // ({n})"


def _squares(a: str, b: str) -> str:
    return f"list_sum(list_transform(list_zip({a}, {b}), lambda z: (z[1] - z[2])::bigint * (z[1] - z[2])::bigint))::bigint"


def vector_codes_sql(parts: int = 16, entries: int = 64, rounds: int = 2, scale: int = 256) -> str:
    steps = [f"""kept as materialized (
        select vec_id, label, list_transform(embedding, lambda x: floor({scale} * x::double)::bigint) as v from embeddings
        where {_FINITE})""",
             f"""part as materialized (
        select vec_id, label, p, v[p * (len(v) // {parts}) + 1 : (p + 1) * (len(v) // {parts})] as x
        from kept, range({parts}) t(p))""",
             f"""book0 as materialized (
        select p, row_number() over (partition by p order by vec_id) - 1 as e, x as c from part
        where vec_id in (select vec_id from kept order by vec_id limit {entries}))"""]
    for k in range(rounds + 1):
        steps.append(f"""near{k} as materialized (
        select vec_id, any_value(label) as label, p, any_value(x) as x, min(d * {entries} + e) % {entries} as e,
               min(d * {entries} + e) // {entries} as d
        from (select part.*, e, {_squares('x', 'c')} as d from part join book{k} using (p)) group by vec_id, p)""")
        if k == rounds:
            break
        steps.append(f"""sum{k} as materialized (
        select p, e, list(m order by i) as c from (
            select p, e, i, ({_floor_div('sum(y)', 'count(*)')})::bigint as m
            from (select p, e, unnest(x) as y, unnest(range(1, len(x) + 1)) as i from near{k}) group by p, e, i)
        group by p, e)""")
        steps.append(f"""book{k + 1} as materialized (
        select b.p, b.e, coalesce(s.c, b.c) as c from book{k} b left join sum{k} s on b.p = s.p and b.e = s.e)""")
    return f"""with {', '.join(steps)}, coded as (
        select vec_id, any_value(label) as label, sum(d)::bigint as error,
               string_agg(lower(lpad(printf('%x', e), 2, '0')), '' order by p) as code
        from near{rounds} group by vec_id)
        select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error,
               (select sha256(string_agg(array_to_string(c, ','), ',' order by p, e)) from book{rounds}) as codebooks_sha256
        from coded"""


def centroids_sql(clusters: int = 8, rounds: int = 10, scale: int = 1024, length: int = 64, seed: int = 3) -> str:
    steps = [f"""kept as materialized (
        select vec_id, list_transform(embedding, lambda x: floor({scale} * x::double)::bigint) as v from embeddings
        where {_FINITE} and len(embedding) = {length})""",
             f"""center0 as materialized (
        select row_number() over (order by sha256('{seed}:' || vec_id)) - 1 as j, v as c from kept
        order by sha256('{seed}:' || vec_id) limit {clusters})"""]
    for k in range(rounds + 1):
        steps.append(f"""near{k} as materialized (
        select vec_id, any_value(v) as v, min(d * {clusters} + j) % {clusters} as j, min(d * {clusters} + j) // {clusters} as d
        from (select vec_id, v, j, {_squares('v', 'c')} as d from kept, center{k}) group by vec_id)""")
        if k == rounds:
            break
        steps.append(f"""center{k + 1} as materialized (
        select b.j, coalesce(s.c, b.c) as c from center{k} b left join (
            select j, list(m order by i) as c from (
                select j, i, ({_floor_div('sum(y)', 'count(*)')})::bigint as m
                from (select j, unnest(v) as y, unnest(range(1, len(v) + 1)) as i from near{k}) group by j, i)
            group by j) s on b.j = s.j)""")
    return f"""with {', '.join(steps)}
        select vec_id, n.j::int as cluster, d::bigint as distance, (sum(d) over (partition by n.j))::bigint as cluster_inertia,
               (sum(d) over ())::bigint as inertia, sha256(array_to_string(c, ',')) as centroid_sha256
        from near{rounds} n join center{rounds} b on n.j = b.j"""


MIXING = r"""
    with doc as materialized (
        select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size,
               md5('13:' || doc_id) as key from documents),
    by_source as (select source, sum(size)::bigint as source_size from doc group by source),
    weighed as materialized (
        select *, 1 + (row_number() over (order by source nulls last) - 1) % 3 as weight, 3 * source_size as most
        from by_source),
    -- Sources in the order in which they reach their bound, and what is left without those before.
    filling as materialized (
        select *, sum(source_size) over () - (sum(most) over before - most) as budget_left,
               sum(weight) over () - (sum(weight) over before - weight) as weight_left, row_number() over before as k
        from weighed window before as (order by most / weight, source nulls last
                                       rows between unbounded preceding and current row)),
    first_free as (
        select arg_min(budget_left, k)::bigint as budget_left, arg_min(weight_left, k)::bigint as weight_left, min(k) as k
        from filling where most * weight_left > budget_left * weight),
    target as (
        select source, source_size, case when f.k is null or t.k < f.k then most
                                         else f.budget_left * weight // f.weight_left end as budget,
               case when f.k is null or t.k < f.k then most::double
                    else (f.budget_left * weight)::double / f.weight_left end as target
        from filling t, first_free f),
    placed as (
        select doc_id, size, source_size, target, budget,
               sum(size) over (partition by doc.source order by key, size
                               rows between unbounded preceding and current row) - size as before
        from doc join target on doc.source is not distinct from target.source)
    select doc_id, size, source_size, target, (case when source_size = 0 then 0 else
        budget // source_size * size + greatest(0, least(size, budget % source_size - before)) end)::bigint as taken
    from placed"""

def components_sql(nodes: str, links: str, node: str) -> str:
    """CTEs `both` and `part` (node, component) over the relations `nodes` (node) and `links` (x, y)."""
    return f"""both_ways as (select x, y from {links} union select y, x from {links}),
    reach(node, seen) as (select {node}, {node} from {nodes}
                          union select r.node, b.y from reach r join both_ways b on r.seen = b.x),
    part as (select node, min(seen) as component from reach group by node)"""


EMBEDDINGS = f"""
    with recursive usable as materialized (
        select vec_id, label, embedding::double[] as v from embeddings
        where label is not null and {_FINITE} and len(list_filter(embedding, lambda x: x <> 0)) > 0),
    links as materialized (
        select a.vec_id as x, b.vec_id as y from usable a join usable b
        on a.label = b.label and a.vec_id < b.vec_id and len(a.v) = len(b.v) and list_cosine_similarity(a.v, b.v) >= 0.98),
    {components_sql('embeddings', 'links', 'vec_id')},
    degree as (select x, count(*) as n from both_ways group by x)
    select vec_id, coalesce(n, 0)::bigint as n_links, component as component_id, vec_id = component as kept
    from embeddings join part on vec_id = part.node left join degree on vec_id = x"""

MINHASH = rf"""
    with recursive doc as materialized (
        select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
    shingle as materialized (
        select distinct doc_id, unnest(case when len(w) = 0 then [] when len(w) < 3 then [array_to_string(w, ' ')]
            else list_transform(range(1, len(w) - 1), lambda k: array_to_string(w[k:k + 2], ' ')) end) as s from doc),
    size as materialized (select doc_id, count(*) as n from shingle group by doc_id),
    common as (select a.doc_id as x, b.doc_id as y, count(*) as c from shingle a join shingle b
               on a.s = b.s and a.doc_id < b.doc_id group by 1, 2),
    links as materialized (
        select x, y from common join size a on a.doc_id = x join size b on b.doc_id = y
        where 100 * c >= 85 * (a.n + b.n - c)),
    {components_sql('doc', 'links', 'doc_id')}
    select doc_id, coalesce(n, 0)::bigint as n_shingles, component as component_id, doc_id = component as kept
    from doc join part on doc_id = part.node left join size using (doc_id)"""

DECONTAMINATION = r"""
    with doc_word as (
        select doc_id, unnest(t) as w, unnest(range(len(t))) as i from (
            select doc_id, string_split_regex(lower(text), '[^\p{L}\p{N}]+') as t from documents where text is not null)),
    item as (
        select item_id, list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') as t
        from benchmark where text is not null),
    item_word as (
        select item_id, len(t) as size, least(20, len(t)) as n, unnest(t) as w, unnest(range(len(t))) as j
        from item where len(t) >= 8),
    diagonal as materialized (
        select doc_id, item_id, i - j as diag, any_value(size) as size, any_value(n) as n, list(j) as js
        from doc_word join item_word using (w) group by 1, 2, 3 having 100 * count(*) >= 80 * any_value(n)),
    placed as (select *, unnest(range(size - n + 1)) as s from diagonal),
    scored as (select doc_id, item_id, n, diag + s as place, len(list_filter(js, lambda j: j >= s and j < s + n)) as agree
               from placed),
    best as (select doc_id, item_id, max(struct_pack(agree := agree, n := n, before := -place)) as b
             from scored where 100 * agree >= 80 * n group by 1, 2)
    select doc_id, item_id, b.agree::int as n_agree, b.n::int as n_compared, (-b.before)::int as doc_place from best"""

ORACLES = {
    "op6_embeddings": EMBEDDINGS,
    "op8_minhash": MINHASH,
    "op9_decontamination": DECONTAMINATION,
    "op11_vector_codes": vector_codes_sql(),
    "op12_centroids": centroids_sql(),
    "op13_mixing": MIXING,
}
