"""SQL counterparts of this folder's queries, for those that SQL can express."""

LEVELS, TOP_LEVELS = 8, 4  # trees of up to 8**8 rows and 8**4 groups; the queries themselves have no limit


def crc32_sql(data: str) -> str:
    """Unsigned crc32 of a binary expression."""
    byte = f"cast('0x' || substr(hex({data}), 2 * i + 1, 2) as bigint)"
    bit = "list_reduce(list_prepend(xor(c, b), range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))"
    return (f"xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(octet_length({data})), "
            f"lambda i: {byte})), lambda c, b: {bit}))")


def _encoded(value: str) -> str:
    text = f"cast({value} as varchar)"
    return f"coalesce(cast(octet_length(encode({text})) as varchar) || ':' || {text}, '-')"


def _tree_sql(name: str, levels: int) -> str:
    """Levels ``name``0.. of trees over ``name``0 (tree, pos, n, h), siblings ``name``_side0.., and ``name``_top."""
    parts = []
    for k in range(levels):
        parts.append(f"""{name}{k + 1} as (select tree, pos // 8 as pos, (max(n) + 7) // 8 as n,
            sha256(string_agg(h, '' order by pos)) as h from {name}{k} where n > 1 group by tree, pos // 8)""")
        parts.append(f"""{name}_side{k} as (select tree, pos,
            coalesce(string_agg(h, '') over (partition by tree, pos // 8 order by pos rows between unbounded preceding and 1 preceding), '') as l,
            coalesce(string_agg(h, '') over (partition by tree, pos // 8 order by pos rows between 1 following and unbounded following), '') as r
            from {name}{k} where n > 1)""")
    tops = " union all ".join(f"select tree, h from {name}{k} where n = 1" for k in range(levels + 1))
    return ", ".join(parts) + f", {name}_top as ({tops})"


def _folds_sql(source: str, name: str, levels: int, place: str, tree: str, key: str) -> str:
    """CTEs ``name``_fold1..: hash so far (h) and siblings so far (proof), one level a step."""
    parts = []
    for k in range(levels):
        parts.append(f"""{name}_fold{k + 1} as (select f.* exclude (h, proof),
            case when s.pos is null then f.h else sha256(s.l || f.h || s.r) end as h, f.proof || coalesce(s.l || s.r, '') as proof
            from {source if k == 0 else f'{name}_fold{k}'} f left join {name}_side{k} s on s.tree = {tree} and s.pos = f.{place} // {8 ** k})""")
    return ", ".join(parts)


def manifest_sql() -> str:
    fields = lambda text: " || ".join(_encoded(v) for v in ("doc_id", "source", "lang", "n_chars", text))
    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    hit = f"doc_id is not null and {crc32_sql('encode(cast(doc_id as varchar))')} % 3 = 0"
    return f"""
    with leaves as (select doc_id, coalesce('=' || lang, '') as tree, sha256({fields('text')}) as leaf,
            case when {hit} then sha256({fields(lowered)}) else sha256({fields('text')}) end as found from documents),
        placed as (select *, row_number() over (partition by tree order by doc_id nulls first, leaf) - 1 as pos,
            count(*) over (partition by tree) as n from leaves),
        low0 as (select tree, pos, n, leaf as h from placed),
        {_tree_sql('low', LEVELS)},
        high0 as (select '' as tree, row_number() over (order by tree) - 1 as pos, count(*) over () as n, h, tree as grp from low_top),
        {_tree_sql('high', TOP_LEVELS)},
        start as (select p.doc_id, p.tree, p.leaf, p.pos, g.pos as gpos, g.h as subroot, t.h as root, p.found as h, '' as proof
            from placed p join high0 g on g.grp = p.tree, high_top t),
        {_folds_sql('start', 'low', LEVELS, 'pos', 'f.tree', 'tree')},
        {_folds_sql(f'low_fold{LEVELS}', 'high', TOP_LEVELS, 'gpos', "''", 'grp')}
    select doc_id, leaf, subroot, root, sha256(proof) as proof_sha256, h as folded_root, h = root as verified
    from high_fold{TOP_LEVELS}"""


def spelling_sql() -> str:
    """Near words by shared remainders: one letter left out at the same place, or of the longer word only."""
    hashed = crc32_sql("encode(concat(cast(doc_id as varchar), ':', run))")
    return f"""
    with recursive runs as (select doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run from documents),
        counted as (select doc_id, run, count(*) as n from runs group by doc_id, run),
        hashed as (select run, n, {hashed} as h from counted),
        written as (select n, case when h % 31 = 0
            then substr(run, 1, cast(h % length(run) as bigint)) || substr(run, cast(h % length(run) as bigint) + 2) else run end as word from hashed),
        words as (select word, cast(sum(n) as bigint) as n from written where length(word) >= 7 group by word having sum(n) >= 2),
        places as (select word, n, unnest(range(1, length(word) + 1)) as place from words),
        remains as (select word, n, place, substr(word, 1, place - 1) || substr(word, place + 1) as rest from places),
        shorter as (select distinct r.word, r.n, w.word as other, w.n as other_n from remains r join words w on w.word = r.rest),
        pairs as (
            select a.word, b.word as other, b.n as other_n from remains a join remains b on a.rest = b.rest and a.place = b.place and a.word <> b.word
            union all select word, other, other_n from shorter
            union all select other, word, n from shorter),
        ranked as (select *, row_number() over (partition by word order by other_n desc, other) as k, count(*) over (partition by word) as near from pairs),
        known as (select w.word, w.n, coalesce(r.near, 0) as n_near, case when r.other_n >= 10 * w.n then r.other end as form,
            case when r.other_n >= 10 * w.n then r.other_n end as form_n from words w left join ranked r on r.word = w.word and r.k = 1),
        ends as (select word, coalesce(form, word) as at, form is null as done from known
            union all select e.word, coalesce(k.form, e.at), k.form is null from ends e join known k on k.word = e.at where not e.done)
    select k.word, k.form, e.at as root, k.n, k.n_near, k.form_n from known k join ends e on e.word = k.word and e.done"""


ORACLES: dict[str, str] = {"op11_manifest": manifest_sql(), "op13_spelling": spelling_sql()}
