"""Statements in DuckDB SQL that are put together from parts, for the queries that use them."""

from __future__ import annotations

LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def url_filter(rules: list[tuple[str, str]], words: list[str]) -> str:
    """Rules and unwanted domains by comparison of every URL with every one of them."""
    listed = ", ".join(f"('{key}', '{verdict}')" for key, verdict in rules)
    host = LOWER.format("regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1)")
    pattern = rf"(?:^|\.)((?:[^.]*-)?(?:{'|'.join(words)})(?:-[^.]*)?\..+)$"
    return rf"""
with urls as (
    select page_id, {host} as host,
           regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) as path
    from pages
), numbered as (select *, row_number() over () as row from urls
), rules as (
    select *, string_split(key, '/')[1] as rule_host, key[strpos(key, '/'):] as rule_path
    from (values {listed}) as r(key, action)
), fitting as (
    select row, arg_max(key, (length(key), key)) as key, arg_max(action, (length(key), key)) as action
    from numbered join rules
      on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path)
    group by row
), domains as (
    select distinct regexp_extract(host, '{pattern}', 1) as domain from urls
), unwanted as (
    select distinct row from numbered join domains
      on domain <> '' and (host = domain or ends_with(host, '.' || domain))
)
select page_id, host, path, key as rule,
       coalesce(action, case when unwanted.row is null then 'allow' else 'block' end) as verdict,
       unwanted.row is not null as listed
from numbered left join fitting using (row) left join unwanted using (row)
"""


def _climb(name: str, fanout: int, levels: int) -> list[str]:
    """Levels of trees above ``{name}0 (tree, place, n, node)``, and the runs of each level."""
    parts = []
    for k in range(levels):
        parts.append(f"""{name}{k + 1} as (
    select tree, place // {fanout} as place, (n + {fanout - 1}) // {fanout} as n,
           case when n > 1 then sha256(string_agg(node, '' order by place)) else max(node) end as node
    from {name}{k} group by tree, place // {fanout}, n
)""")
        parts.append(f"""{name}_run{k} as (
    select tree, place // {fanout} as up, list(node order by place) as run
    from {name}{k} where n > 1 group by tree, place // {fanout}
)""")
    return parts


def _fold(name: str, start: str, tree: str, place: str, fanout: int, levels: int) -> list[str]:
    """The rows of ``start`` taken up level by level: ``proof`` grows and ``folded`` changes."""
    parts, before = [], start
    for k in range(levels):
        slot = f"(b.{place} // {fanout ** k}) % {fanout}"
        parts.append(f"""{start}_{name}{k} as (
    select b.* exclude (proof, folded),
           case when run is null then proof else proof || array_to_string(run[:{slot}], '')
               || array_to_string(run[{slot} + 2:], '') end as proof,
           case when run is null then folded else sha256(array_to_string(run[:{slot}], '')
               || folded || array_to_string(run[{slot} + 2:], '')) end as folded
    from {before} b left join {name}_run{k} r
      on r.tree = b.{tree} and r.up = b.{place} // {fanout ** (k + 1)}
)""")
        before = f"{start}_{name}{k}"
    return parts


def merkle_manifest(fanout: int, levels: int) -> str:
    """All levels written out; trees with more than ``fanout ** levels`` leaves are too large."""
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    text = "coalesce(strlen({0}::varchar) || ':' || {0}::varchar, '-')"
    leaf = "sha256(" + " || ".join(text.format(f) for f in fields) + ")"
    lowered = "sha256(" + " || ".join(
        text.format(LOWER.format(f) if f == "text" else f) for f in fields
    ) + ")"
    parts = [
        """steps as (
    select range as byte, range::ubigint as c, 0 as k from range(256)
    union all
    select byte, case when c & 1 = 1 then xor(c >> 1, 3988292384::ubigint) else c >> 1 end, k + 1
    from steps where k < 8
)""",
        "crc as (select list(c order by byte) as crc from steps where k = 8)",
        f"""leaves as (
    select doc_id, source, {leaf} as leaf, {lowered} as lowered,
           xor(list_reduce(
               list_transform(string_split(coalesce(doc_id::varchar, ''), ''),
                              lambda ch: ascii(ch)::ubigint),
               lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255)::bigint + 1]),
               4294967295::ubigint), 4294967295::ubigint) % 5 = 0 as tampered
    from documents, crc
)""",
        """placed as (
    select *, dense_rank() over (order by source nulls first) - 1 as tree,
           row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as place,
           '' as proof, case when tampered then lowered else leaf end as folded
    from leaves
)""",
        """doc0 as (
    select tree, place, count(*) over (partition by tree) as n, leaf as node from placed
)""",
        *_climb("doc", fanout, levels),
        f"""top0 as (
    select 0 as tree, tree as place, count(*) over () as n, node from doc{levels}
)""",
        *_climb("top", fanout, levels),
        *_fold("doc", "placed", "tree", "place", fanout, levels),
        f"""joined as (
    select p.*, d.node as subroot, 0 as one
    from placed_doc{levels - 1} p join doc{levels} d using (tree)
)""",
        *_fold("top", "joined", "one", "tree", fanout, levels),
    ]
    return (
        "with recursive " + ", ".join(parts) + f"""
select doc_id, leaf, subroot, t.node as root, sha256(proof) as proof_sha256,
       folded as folded_root, folded = t.node as verified
from joined_top{levels - 1}, top{levels} t
"""
    )


def collocations(least: int, most: int) -> str:
    """Every phrase of every place counted, without a parse."""
    return rf"""
with pieces as (
    select coalesce(lang, 'und') as lang,
           unnest(string_split_regex({LOWER.format("coalesce(text, '')")}, '[.,;:!?\x0A-\x0D]')) as piece
    from documents
), stretches as (
    select lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') as words
    from pieces
), places as (
    select lang, words, unnest(range(1, len(words) + 1)) as i from stretches
), phrases as (
    select lang, words[i:i + size - 1] as words, size
    from places, (select unnest([1, 2, 3, 4]) as size) where i + size - 1 <= len(words)
), counts as (
    select lang, words, size, count(*) as f from phrases group by all having count(*) >= {least}
), totals as (
    select lang, count(*) as n from places group by lang
), cuts as (
    select c.lang, c.words, c.size, c.f as a, k, x.f as l, y.f as r,
           2000000::hugeint * c.f // (x.f + y.f) as score
    from (select *, unnest(range(1, size)) as k from counts where size > 1) c
    join counts x on x.lang = c.lang and x.words = c.words[:k]
    join counts y on y.lang = c.lang and y.words = c.words[k + 1:]
), candidates as (
    select * from cuts
    qualify row_number() over (partition by lang, words order by score, k) = 1
), inside as (
    select lang, words[b:b + short - 1] as words, max(a) as longer
    from candidates, (select unnest([2, 3]) as short), (select unnest([1, 2, 3]) as b)
    where short < size and b + short - 1 <= size
    group by all
), ranked as (
    select c.*, array_to_string(c.words, ' ') as phrase
    from candidates c left join inside i on i.lang = c.lang and i.words = c.words
    where longer is null or 100::hugeint * longer < 80::hugeint * a
)
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank,
       phrase, a, l, r, n, score::bigint as score
from ranked join totals using (lang)
qualify row_number() over (partition by lang order by score desc, a desc, phrase) <= {most}
"""
