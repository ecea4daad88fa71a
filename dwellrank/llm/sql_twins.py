"""SQL that gives the rows of op11 and op12; the steps that repeat per level are written by loops."""

from __future__ import annotations

from dwellrank.llm.url_filter import ORDER


def url_models_sql() -> str:
    """op11: one mixing step per order of context."""
    laws = """
        laws0 as (
            select gram, case when s.na > 0 then (coalesce(a, 0) + s.ta * u) / (s.na + s.ta) else u end as pa,
                case when s.nr > 0 then (coalesce(r, 0) + s.tr * u) / (s.nr + s.tr) else u end as pr
            from (select distinct right(gram, 1) as gram from wanted) left join (
                select right(gram, 1) as gram, sum(a) as a, sum(r) as r from counts group by 1) using (gram),
            (select coalesce(sum(a), 0) as na, count(case when a > 0 then 1 end) as ta, coalesce(sum(r), 0) as nr,
                count(case when r > 0 then 1 end) as tr, cast(1 as double) / (count(*) + 1) as u
             from (select right(gram, 1) as gram, sum(a) as a, sum(r) as r from counts group by 1)) s
        )"""
    for k in range(1, ORDER + 1):
        laws += f""",
        here{k} as (select right(gram, {k + 1}) as gram, sum(a) as a, sum(r) as r from counts group by 1),
        behind{k} as (
            select left(gram, {k}) as context, sum(a) as na, count(case when a > 0 then 1 end) as ta,
                sum(r) as nr, count(case when r > 0 then 1 end) as tr from here{k} group by 1),
        laws{k} as (
            select w.gram,
                case when coalesce(na, 0) > 0 then (coalesce(a, 0) + ta * s.pa) / (na + ta) else s.pa end as pa,
                case when coalesce(nr, 0) > 0 then (coalesce(r, 0) + tr * s.pr) / (nr + tr) else s.pr end as pr
            from (select distinct right(gram, {k + 1}) as gram from wanted) w
            join laws{k - 1} s on s.gram = right(w.gram, {k})
            left join here{k} h on h.gram = w.gram left join behind{k} b on b.context = left(w.gram, {k})
        )"""
    return f"""
        with split as (
            select page_id, url, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                    'abcdefghijklmnopqrstuvwxyz') as host,
                regexp_extract(substring(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') as path
            from (select page_id, coalesce(url, '') as url,
                case when instr(url, '://') > 0 then substring(url, instr(url, '://') + 3) else '' end as rest from pages)
        ), ruled as (
            select *, case when (host = 'example.net' or host like '%.example.net') and path like '/en/%' then 'example.net/en/'
                when (host = 'example.com' or host like '%.example.com') and path like '/de/%' then 'example.com/de/'
                when (host = 'org' or host like '%.org') and path like '/fr/%' then 'org/fr/'
                when (host = 'net' or host like '%.net') and path like '/%' then 'net/' end as rule
            from split
        ), marked as (
            select *, case when rule in ('example.net/en/', 'org/fr/') then 'allow' when rule is not null then 'block' end as ruled from ruled
        ), pieces as (
            select url, ruled, fold, substring(padded, cast(i as bigint), {ORDER + 1}) as gram from (
                select url, ruled, repeat(chr(2), {ORDER}) || url || chr(3) as padded, sha256(url)[1] in ('0', '1', '2') as fold,
                    unnest(range(1, length(url) + 2)) as i
                from (select distinct url, ruled from marked))
        ), counts as (
            select gram, count(case when ruled = 'allow' then 1 end) as a, count(case when ruled = 'block' then 1 end) as r
            from pieces where ruled is not null and not fold group by 1
        ), wanted as (select distinct gram from pieces where ruled is null or fold),
        {laws},
        scores as (
            select url, any_value(ruled) as ruled, cast(floor(sum(ratio) / (count(*) * 1000)) as bigint) as step
            from pieces join (
                select gram, cast(round((ln(pa) - ln(pr)) * 1000000) as bigint) as ratio from laws{ORDER}) using (gram)
            where ruled is null or fold group by 1
        ), steps as (
            select least(step, greatest(0, lead(step) over (order by step desc) + 1)) as step, sum(a) over (order by step desc) * sum(r) over () - sum(r) over (order by step desc) * sum(a) over () as gain,
                sum(a) over () * sum(r) over () as cells
            from (select step, count(case when ruled = 'allow' then 1 end) as a, count(case when ruled = 'block' then 1 end) as r
                from scores where ruled is not null group by 1)
        ), least as (select coalesce((select step from steps where cells > 0 order by gain desc, abs(step), step limit 1), 0) as least)
        select page_id, host, path, rule,
            coalesce(m.ruled, case when step >= least then 'allow' else 'block' end) as verdict
        from marked m left join scores s using (url), least
    """


def _tree(name: str, nodes: str, levels: int) -> str:
    """Tables of a tree's nodes and of the siblings left and right of each, level by level."""
    out = f"{name}0 as ({nodes})"
    for k in range(levels):
        out += f""",
        {name}{k + 1} as (
            select grp, pos // 8 as pos, (any_value(n) + 7) // 8 as n,
                case when any_value(n) = 1 then any_value(digest) else sha256(string_agg(digest, '' order by pos)) end as digest
            from {name}{k} group by grp, pos // 8),
        {name}_steps{k} as (
            select grp, pos, n > 1 as up,
                coalesce(string_agg(digest, '') over (partition by grp, pos // 8 order by pos rows between unbounded preceding and 1 preceding), '') as l,
                coalesce(string_agg(digest, '') over (partition by grp, pos // 8 order by pos rows between 1 following and unbounded following), '') as r
            from {name}{k})"""
    return out


def _walk(source: str, name: str, levels: int) -> str:
    """``source`` with fold and proof carried up a tree."""
    for k in range(levels):
        source = f"""(
            select w.* exclude (fold, proof), case when up then sha256(s.l || w.fold || s.r) else w.fold end as fold,
                case when up then w.proof || s.l || s.r else w.proof end as proof
            from {source} w join {name}_steps{k} s on s.grp = w.{name}_grp and s.pos = w.{name}_pos // {8**k})"""
    return source


def manifest_sql(lower: int = 7, upper: int = 3) -> str:
    """op12, for up to 8**lower rows of a language and 8**upper languages."""
    leaf = " || ".join(
        f"coalesce(strlen(cast({c} as varchar)) || ':' || cast({c} as varchar), '-')" for c in ("doc_id", "source", "lang", "n_chars")
    )
    digest = f"sha256({leaf} || coalesce(strlen(BODY) || ':' || BODY, '-'))"
    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    in_language = _walk("(select doc_id, leaf, tampered as fold, '' as proof, grp as low_grp, pos as low_pos from numbered)", "low", lower)
    below_root = f"""(
            select u.*, '' as high_grp, s.pos as high_pos, s.digest as subroot
            from {in_language} u join subroots s on s.of_grp = u.low_grp)"""
    return f"""
        with crcs as (
            select list(list_reduce(list_prepend(i, range(8)),
                lambda c, x: case when c & 1 = 1 then xor(3988292384, c >> 1) else c >> 1 end) order by i) as crcs
            from range(256) t(i)
        ), checked as (
            select *, xor(4294967295, list_reduce(
                list_prepend(4294967295, list_transform(range(1, length(cast(doc_id as varchar)) + 1),
                    lambda i: cast(ascii(substring(cast(doc_id as varchar), i, 1)) as bigint))),
                lambda c, b: xor(c >> 8, crcs[(xor(c, b) & 255) + 1]))) % 3 = 0 as hit
            from documents, crcs
        ), digests as (
            select doc_id, case when lang is null then '' else '=' || lang end as grp, {digest.replace("BODY", "text")} as leaf,
                {digest.replace("BODY", f"(case when hit then {lowered} else text end)")} as tampered
            from checked
        ), numbered as (
            select *, row_number() over (partition by grp order by doc_id nulls first, leaf) - 1 as pos, count(*) over (partition by grp) as n
            from digests
        ), {_tree("low", "select grp, pos, n, leaf as digest from numbered", lower)},
        subroots as (select grp as of_grp, row_number() over (order by grp) - 1 as pos, count(*) over () as n, digest from low{lower}),
        {_tree("high", "select '' as grp, pos, n, digest from subroots", upper)}
        select doc_id, leaf, subroot, root, sha256(proof) as proof_sha256, fold as folded_root, fold = root as verified
        from {_walk(below_root, "high", upper)}, (select digest as root from high{upper})
    """
