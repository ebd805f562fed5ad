"""SQL counterparts of the text queries that SQL can express."""

# crc32 of an id written as text: bit by bit over its digits; a step shifts right and, where the bit
# that falls out is set, adds the polynomial (fixed value 0xEDB88320) without carry.
CRC32 = r"""
    crc as materialized (
        select doc_id, xor(list_reduce(
            list_prepend(4294967295::bigint, list_transform(string_split(doc_id::varchar, ''), lambda c: ascii(c)::bigint)),
            lambda r, c: list_reduce(
                list_prepend(xor(r, c), [0::bigint, 0, 0, 0, 0, 0, 0, 0]),
                lambda x, i: xor(x >> 1, (x & 1) * 3988292384)
            )
        ), 4294967295) as h
        from (select distinct doc_id from documents)
    )
"""

LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _leaf(text: str) -> str:
    values = ["doc_id::varchar", "source", "lang", "n_chars::varchar", text]
    return "sha256(" + " || ".join(f"coalesce(strlen({v}) || ':' || {v}, '-')" for v in values) + ")"


# Level by level for all trees at once; a tree that has one node left is done.
def _tree(name: str, leaves: str) -> str:
    return f"""
    {name} as (
        select 0 as level, tree, i, digest, n from ({leaves})
        union all
        select level + 1, tree, i // 16, sha256(string_agg(digest, '' order by i)), max((n + 15) // 16)
        from {name} where n > 1 group by level, tree, i // 16
    ),
    {name}_beside as (
        select a.level, a.tree, a.i, a.n, a.digest,
               coalesce(string_agg(b.digest, '' order by b.i) filter (b.i < a.i), '') as l,
               coalesce(string_agg(b.digest, '' order by b.i) filter (b.i > a.i), '') as r
        from {name} a join {name} b on a.level = b.level and a.tree = b.tree and a.i // 16 = b.i // 16
        where a.n > 1 group by all
    ),
    {name}_top as (select tree, digest from {name} where n = 1)
"""


OP11 = f"""
    with recursive {CRC32},
    given as materialized (
        select doc_id, '=' || source as named, {_leaf("text")} as leaf,
               case when h % 5 = 0 then {_leaf(LOWER.format("text"))} else {_leaf("text")} end as start
        from documents left join crc using (doc_id)
    ),
    leaves as materialized (
        select doc_id, coalesce(named, '') as tree, leaf, start,
               row_number() over (partition by named order by doc_id, leaf) - 1 as i, count(*) over (partition by named) as n
        from given
    ),
    {_tree("low", "select tree, i, leaf as digest, n from leaves")},
    {_tree("high", "select '' as tree, row_number() over (order by tree) - 1 as i, digest, count(*) over () as n from low_top")},
    named as (select tree, row_number() over (order by tree) - 1 as i from low_top),
    steps as (
        select doc_id, leaves.i, leaves.tree, b.level, b.l, b.r
        from leaves join low_beside b on b.tree = leaves.tree and b.i = leaves.i // (16 ** b.level)::bigint
        union all
        select doc_id, leaves.i, leaves.tree, 100 + b.level, b.l, b.r
        from leaves join named on named.tree = leaves.tree
        join high_beside b on b.i = named.i // (16 ** b.level)::bigint
    ),
    paths as (
        select tree, i, list(l order by level) as ls, list(r order by level) as rs, string_agg(l || r, '' order by level) as beside
        from steps group by tree, i
    ),
    folds as (
        select tree, i, 0 as step, start as digest, coalesce(len(ls), 0) as size from leaves left join paths using (tree, i)
        union all
        select tree, i, step + 1, sha256(ls[step + 1] || digest || rs[step + 1]), size
        from folds join paths using (tree, i) where step < size
    )
    select doc_id, leaf, low_top.digest as subroot, high_top.digest as root, sha256(coalesce(beside, '')) as proof_sha256,
           folds.digest as folded_root, folds.digest = high_top.digest as verified
    from leaves join low_top using (tree) cross join high_top left join paths using (tree, i)
    join folds on folds.tree = leaves.tree and folds.i = leaves.i and step = size
"""

# A run of period q is a stretch of equal words q apart, joined with the q words behind; a stretch
# with a smaller period has that one.
OP12 = rf"""
    with recursive {CRC32},
    texts as materialized (
        select doc_id, h, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words from documents left join crc using (doc_id)
    ),
    planted as (
        select doc_id, words, len(words) as n, h // 10 as g, (h // 10) % len(words) as a, h % 10 = 0 and len(words) > 0 as chosen from texts
    ),
    turned as materialized (
        select doc_id, n, case when chosen then list_transform(range(n),
                lambda i: words[case when i < a then i else a + (i - a) % (1 + (n - a) // (3 + g % 8)) end + 1])
            else words end as words
        from planted
    ),
    each as materialized (select doc_id, n, unnest(words) as w, unnest(range(n)) as i from turned),
    equal as (
        select x.doc_id, x.i, y.i - x.i as q from each x join each y on x.doc_id = y.doc_id and x.w = y.w
        where y.i > x.i and 4 * (y.i - x.i) <= x.n
    ),
    islands as (select doc_id, q, i, i - row_number() over (partition by doc_id, q order by i) as island from equal),
    stretches as (
        select doc_id, q, min(i) as s, max(i) + 1 + q as e from islands group by doc_id, q, island
        having count(*) + q >= greatest(6, 4 * q)
    ),
    runs as materialized (select doc_id, s, e - s as size, min(q) as q from stretches group by doc_id, s, e),
    best as (select *, row_number() over (partition by doc_id order by size::double / q desc, s, q) as place from runs),
    told as (select doc_id, count(*) as n_runs, string_agg(s || ',' || size || ',' || q || chr(10), '' order by s, q) as listed from runs group by doc_id),
    dropped as (select distinct doc_id, unnest(range(s + q, s + size)) as i from runs),
    kept as (
        select doc_id, string_agg(w, ' ' order by i) as collapsed from each anti join dropped using (doc_id, i) group by doc_id
    )
    select t.doc_id, coalesce(n_runs, 0) as n_runs, s as start, size as length, q as period,
           (1000 * size) // q as exponent_milli, sha256(coalesce(listed, '')) as runs_sha256,
           sha256(coalesce(collapsed, '')) as collapsed_sha256
    from turned t left join told using (doc_id) left join kept using (doc_id)
    left join best on best.doc_id = t.doc_id and place = 1
"""

ORACLE = {
    "op8_exact_dedup": r"""
        with d as (
            select doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                            'abcdefghijklmnopqrstuvwxyz')) as text_sha256
            from documents
        )
        select doc_id, max(doc_id) over g as keep_id, count(*) over g as group_size,
               doc_id = max(doc_id) over g as kept, text_sha256
        from d window g as (partition by text_sha256)
    """,
    "op11_merkle_manifest": OP11,
    "op12_periodic_runs": OP12,
}
