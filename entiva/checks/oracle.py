"""The queries of ``checks/queries.py`` stated independently in DuckDB SQL."""

from __future__ import annotations

from entiva.functions.aliases import INSTITUTION_ALIASES
from entiva.functions.keys import LEGAL_SUFFIX_PATTERN, LEGAL_SUFFIXES
from entiva.plans.delivery import FULL_RATINGS, INDICATOR_RATINGS
from entiva.plans.trusted import (
    COMPLAINT_COLUMNS,
    COMPLAINT_COUNTS,
    RATING_COLUMNS,
    REVIEW_COLUMNS,
    REVIEW_PROFILE_COLUMNS,
)


def text(x: str) -> str:
    return f"cast({x} as varchar)"


def norm_name(x: str) -> str:
    value = f"upper(replace(trim(coalesce({x}, '')), 'ß', 'SS'))"
    for suffix in LEGAL_SUFFIXES:
        value = f"replace({value}, '{suffix}', '')"
    return _alphanumeric(f"strip_accents({value})")


def norm_name_pattern(x: str) -> str:
    value = f"upper(replace(trim(coalesce({x}, '')), 'ß', 'SS'))"
    value = f"regexp_replace({value}, '{LEGAL_SUFFIX_PATTERN}', ' ', 'gi')"
    accented, plain = "ÁÀÂÃÄÉÈÊËÍÌÎÏÓÒÔÕÖÚÙÛÜÇ", "AAAAAEEEEIIIIOOOOOUUUUC"
    return _alphanumeric(f"translate({value}, '{accented}', '{plain}')")


def _alphanumeric(value: str) -> str:
    kept = f"regexp_replace({value}, '[^A-Z0-9 ]', '', 'g')"
    return f"trim(regexp_replace({kept}, ' +', ' ', 'g'))"


def norm_id(x: str) -> str:
    return f"regexp_replace(regexp_replace(coalesce({x}, ''), '[^0-9]', '', 'g'), '^0+', '')"


def comma_number(x: str) -> str:
    bare = rf"regexp_replace({x}, '\s', '', 'g')"
    return f"try_cast(replace(replace({bare}, '.', ''), ',', '.') as double)"


def as_long(x: str) -> str:
    return f"cast(trunc(try_cast({x} as decimal(38, 10))) as bigint)"


def institution(key: str, dropped: str = "0") -> str:
    return (
        f"(case {key} % 4 when 0 then 'Banco ' when 1 then 'Crédito ' when 2 then 'Cooperativa '"
        f" else 'Instituição ' end || upper(substr(md5({text(key)}), 1, 14 - ({dropped}))))"
    )


RAW_REGISTRY = f"""raw_registry as (
  select c_mktsegment as "Segmento",
    case when c_custkey % 7 = 0 then '0' else {text("c_custkey")} end as "CNPJ",
    (case c_custkey when 10 then 'Banco do Brasil' when 12 then 'Itaú Unibanco'
      else {institution("c_custkey")} end)
    || (case (c_custkey + copy) % 5 when 0 then ' - PRUDENCIAL' when 1 then ' S.A.'
      when 2 then ' LTDA' when 3 then ' S/A' else '' end) as "Nome"
  from customer, (select 0 as copy union all select 1) copies
  where copy = 0 or c_custkey % 50 = 0)"""

_CONTESTED = f"""raw_registry as (
  select * from listed_registry
  union all
  select 'RIVAL', '0', {institution("c_custkey", "1")} || 'Z' from customer
  where c_custkey % 22 = 14 or c_custkey % 9 = 4)"""

_TOTAL = text("o_orderkey % 7 + o_orderkey % 5 + o_orderkey % 3")
_CUT_SHORT = "case o_custkey % 11 when 3 then 1 when 5 then 3 else 0 end"
_CUT_FURTHER = f"case when o_custkey % 22 = 14 and o_orderkey % 2 = 0 then 2 else {_CUT_SHORT} end"


def _raw_complaints(dropped: str) -> str:
    return f"""raw_complaints as (
  select {text("year(o_orderdate)")} as ano,
    {text("quarter(o_orderdate)")} as trimestre,
    o_orderpriority as categoria,
    o_orderstatus as tipo,
    case when o_custkey % 2 = 0 then ' ' else lpad({text("o_custkey")}, 8, '0') end as cnpj_if,
    (case o_custkey when 10 then 'BB' when 12 then 'Itaú' else
      {institution("o_custkey", dropped)} end)
      || ' (conglomerado)' as instituicao_financeira,
    case when o_orderkey % 13 = 0 then ' '
      else translate(format('{{:,.2f}}', o_totalprice), ',.', '.,') end as indice,
    {text("o_orderkey % 7")} as qtd_reclamacoes_reguladas_procedentes,
    {text("o_orderkey % 5")} as qtd_reclamacoes_reguladas_outras,
    {text("o_orderkey % 3")} as qtd_reclamacoes_nao_reguladas,
    case when o_orderkey % 101 = 0 then 'x' when o_orderkey % 4 = 0 then {_TOTAL} || '.0'
      else {_TOTAL} end as qtd_total_reclamacoes,
    case when o_orderkey % 10 = 0 then '0' else {text("o_orderkey % 97 * 1000")} end
      as qtd_total_clientes_ccs_e_scr,
    {text("o_orderkey % 11")} as qtd_clientes_ccs,
    {text("o_orderkey % 17")} as qtd_clientes_scr
  from orders)"""


RAW_COMPLAINTS = _raw_complaints(_CUT_SHORT)

_PROFILE = ",\n    ".join(
    f"'{c} ' || {text('s_suppkey')} as {c}" for c in REVIEW_PROFILE_COLUMNS
)


def _rating(i: int, name: str) -> str:
    tenths = f"((cast(round(abs(s_acctbal) * 100) as bigint) + {3 * i}) % 41 + 10)"
    value = f"{text(f'{tenths} // 10')} || '.' || {text(f'{tenths} % 10')}"
    if i == 0:
        return f"{value} as {name}"
    return f"case when (s_suppkey + {i}) % 13 = 0 then null else {value} end as {name}"


_RATINGS = ",\n    ".join(_rating(i, c) for i, c in enumerate(RATING_COLUMNS))
RAW_REVIEWS = f"""all_reviews as (
  select s_suppkey,
    {_PROFILE},
    {_RATINGS},
    'S' || {text("s_suppkey % 5")} as segmento,
    lpad({text("s_suppkey")}, 8, '0') as cnpj,
    {institution("s_suppkey", "case when s_suppkey % 9 = 4 then 1 else 0 end")} as nome,
    {text("s_suppkey % 101")} as match_percent
  from supplier),
raw_reviews as (
  select {", ".join(c if c != "cnpj" else "null as cnpj" for c in REVIEW_COLUMNS)},
    'match_v2' as origem from all_reviews where s_suppkey % 5 <> 0
  union all
  select {", ".join(c if c != "segmento" else "null as segmento" for c in REVIEW_COLUMNS)},
    'match_less' as origem from all_reviews where s_suppkey % 5 = 0 or s_suppkey % 20 = 1)"""

TRUSTED_REGISTRY = f"""registry as (
  select "Segmento" as segmento, "CNPJ" as cnpj, "Nome" as nome,
    {norm_name('"Nome"')} as nome_norm, {norm_id('"CNPJ"')} as cnpj_norm
  from raw_registry)"""
REGISTRY = f"{RAW_REGISTRY}, {TRUSTED_REGISTRY}"

_TYPED = {c: as_long(c) for c in COMPLAINT_COUNTS} | {"indice": comma_number("indice")}
TRUSTED_COMPLAINTS = f"""complaints as (
  select {", ".join(f"{_TYPED[c]} as {c}" if c in _TYPED else c for c in COMPLAINT_COLUMNS)},
    {norm_name("instituicao_financeira")} as nome_norm, {norm_id("cnpj_if")} as cnpj_norm
  from raw_complaints)"""
COMPLAINTS = f"{RAW_COMPLAINTS}, {TRUSTED_COMPLAINTS}"

_OTHER_REVIEW = [c for c in REVIEW_COLUMNS if c not in RATING_COLUMNS]
REVIEWS = f"""{RAW_REVIEWS},
reviews as (
  select {", ".join(_OTHER_REVIEW)}, origem,
    {", ".join(f"try_cast({c} as double) as {c}" for c in RATING_COLUMNS)},
    {norm_name("nome")} as nome_norm, {norm_id("cnpj")} as cnpj_norm
  from raw_reviews)"""

# by way of text, as the direct cast of a double to a wide decimal is not exact
MEAN_INDEX = (
    "cast(cast(sum(cast(cast(indice as varchar) as decimal(38, 10))) as varchar) as double)"
    " / count(indice)"
)
MEASURES = f"""cast(sum(qtd_total_reclamacoes) as bigint) as qtd_total_reclamacoes,
    cast(sum(qtd_reclamacoes_reguladas_procedentes) as bigint) as qtd_procedentes,
    {MEAN_INDEX} as indice_medio,
    count(*) as trimestres_com_reclamacao"""
METRICS = ["qtd_total_reclamacoes", "qtd_procedentes", "indice_medio", "trimestres_com_reclamacao"]
INDICATOR_MEASURES = f"""cast(sum(qtd_total_reclamacoes) as bigint) as reclamacao_total,
    {MEAN_INDEX} as reclamacao_indice_bacen,
    count(distinct trimestre) as reclamacao_trimestres,
    cast(sum(qtd_total_clientes_ccs_e_scr) as bigint) as total_clientes,
    cast(sum(qtd_reclamacoes_reguladas_procedentes) as bigint) as total_procedentes"""
INDICATORS = [
    "reclamacao_total", "reclamacao_indice_bacen", "reclamacao_trimestres",
    "reclamacao_indice_calculado", "reclamacao_pct_procedentes",
]
REGISTRY_ORDER = "segmento, cnpj, nome, nome_norm, cnpj_norm"
DEDUP = f"""kept as (
  select * from registry qualify row_number() over (
    partition by cnpj_norm <> '', case when cnpj_norm <> '' then cnpj_norm else nome_norm end
    order by {REGISTRY_ORDER}) = 1)"""
BY_ID = f"""by_id as (
  select cnpj_norm, {MEASURES} from complaints where cnpj_norm <> '' group by cnpj_norm)"""
BY_NAME = f"""by_name as (
  select nome_norm, {MEASURES} from complaints where nome_norm <> '' group by nome_norm)"""
ALIASES = "aliases(alias, canonical) as (values " + ", ".join(
    f"('{a}', '{c}')" for a, c in INSTITUTION_ALIASES.items()
) + ")"
RATINGS_BY_NAME = f"""ratings_by_name as (
  select nome_norm, {", ".join(RATING_COLUMNS)} from reviews where nome_norm <> ''
  qualify row_number() over (partition by nome_norm
    order by cnpj_norm = '', cnpj_norm, {", ".join(f"{c} nulls first" for c in RATING_COLUMNS)}
  ) = 1)"""
RATINGS_BY_ID = f"""ratings_by_id as (
  select cnpj_norm, {", ".join(RATING_COLUMNS)} from reviews where cnpj_norm <> ''
  qualify row_number() over (partition by cnpj_norm
    order by nome_norm, {", ".join(f"{c} nulls first" for c in RATING_COLUMNS)}) = 1)"""


def _similar_pairs(left: str, right: str, name: str) -> str:
    """All pairs by edit distance, those of equal canonical names before all others."""
    return f"""{name}_pairs as (
  select l.nome_norm, r.nome_norm as candidate,
    case when lc = rc then 101 else
      (greatest(length(lc), length(rc)) - levenshtein(lc, rc)) * 100
        // greatest(length(lc), length(rc)) end as score
  from (select distinct nome_norm, coalesce(canonical, nome_norm) as lc
        from {left} left join aliases on alias = nome_norm where nome_norm <> '') l,
    (select nome_norm, coalesce(canonical, nome_norm) as rc
     from {right} left join aliases on alias = nome_norm where nome_norm <> '') r)"""


def similar(left: str, right: str, cutoff: int, name: str) -> str:
    """Best candidate per open name, for names that no other wants."""
    return f"""{_similar_pairs(left, right, name)},
{name} as (
  select nome_norm, candidate from {name}_pairs where score >= {cutoff}
  qualify row_number() over (partition by nome_norm order by score desc, candidate) = 1)"""


def _greedy_rounds(rounds: int, name: str = "") -> tuple[str, str]:
    """Mutual best pairs of the table ``open0``, taken round by round, and the table of all those
    taken; more rounds than the data needs."""
    order = "order by score desc, tie, s, t"
    steps = []
    for n in range(rounds):
        best, now, later = f"{name}best{n}", f"{name}open{n}", f"{name}open{n + 1}"
        steps.append(f"""{best} as materialized (
  select s, t, score from (select *, row_number() over (partition by s {order}) as of_s,
    row_number() over (partition by t {order}) as of_t from {now}) where of_s = 1 and of_t = 1),
{later} as materialized (
  select * from {now} where s not in (select s from {best}) and t not in (select t from {best}))
""")
    return ", ".join(steps), " union all ".join(
        f"select * from {name}best{n}" for n in range(rounds)
    )


def one_to_one(left: str, right: str, cutoff: int, name: str) -> str:
    """Best pair first over all open names and candidates, each of which is given once."""
    steps, taken = _greedy_rounds(6, f"{name}_")
    return f"""{_similar_pairs(left, right, name)},
{name}_open0 as materialized (
  select nome_norm as s, candidate as t, score,
    substr(md5(nome_norm || chr(1) || candidate), 1, 15) as tie
  from {name}_pairs where score >= {cutoff}),
{steps},
{name} as (select s as nome_norm, t as candidate from ({taken}))"""


def _master(metrics: list[str], ratings: dict[str, str], metric_ctes: str, by_name_first: bool,
            columns: list[str], sources: str = f"{REGISTRY}, {COMPLAINTS}", match=similar) -> str:
    name_join = "left join by_name n on n.nome_norm = k.nome_norm" if by_name_first else ""
    exact = [
        f"coalesce(i.{m}, n.{m}) as {m}" if by_name_first else f"i.{m} as {m}" for m in metrics
    ]
    rated = [f"coalesce(ri.{r}, rn.{r}) as {r}" for r in ratings]
    filled = [
        f"case when e.{metrics[0]} is null then coalesce(e.{m}, m.{m}) else e.{m} end as {m}"
        for m in metrics
    ] + [
        f"case when e.geral is null then coalesce(e.{r}, v.{r}) else e.{r} end as {alias}"
        for r, alias in ratings.items()
    ]
    return f"""with {sources}, {REVIEWS}, {ALIASES}, {DEDUP}, {metric_ctes},
{RATINGS_BY_ID}, {RATINGS_BY_NAME},
exact as (
  select k.*, {", ".join(exact + rated)}
  from kept k
  left join by_id i on i.cnpj_norm = k.cnpj_norm
  {name_join}
  left join ratings_by_id ri on ri.cnpj_norm = k.cnpj_norm
  left join ratings_by_name rn on rn.nome_norm = k.nome_norm),
open_metrics as (select nome_norm from exact where {metrics[0]} is null),
open_ratings as (select nome_norm from exact where geral is null),
{match("open_metrics", "by_name", 80, "metric_match")},
{match("open_ratings", "ratings_by_name", 90, "rating_match")}
select {", ".join(f"e.{c} as {c}" for c in columns)}, {", ".join(filled)}
from exact e
left join metric_match mm on mm.nome_norm = e.nome_norm
left join by_name m on m.nome_norm = mm.candidate
left join rating_match rm on rm.nome_norm = e.nome_norm
left join ratings_by_name v on v.nome_norm = rm.candidate"""


MASTER = _master(
    METRICS, FULL_RATINGS, f"{BY_ID}, {BY_NAME}", True,
    ["segmento", "cnpj", "nome", "cnpj_norm", "nome_norm"],
)
_LISTED = RAW_REGISTRY.replace("raw_registry", "listed_registry", 1)
MASTER_CONTESTED = _master(
    METRICS, FULL_RATINGS, f"{BY_ID}, {BY_NAME}", True,
    ["segmento", "cnpj", "nome", "cnpj_norm", "nome_norm"],
    f"{_LISTED}, {_CONTESTED}, {TRUSTED_REGISTRY}, "
    f"{_raw_complaints(_CUT_FURTHER)}, {TRUSTED_COMPLAINTS}",
    one_to_one,
)
_INDICATOR_ROW = f"""select *,
    cast(reclamacao_total as double) / nullif(total_clientes, 0) as reclamacao_indice_calculado,
    cast(total_procedentes as double) / nullif(reclamacao_total, 0) as reclamacao_pct_procedentes
  from (select %s, {INDICATOR_MEASURES} from complaints where %s group by 1)"""
INDICATOR_TABLE = _master(
    INDICATORS, INDICATOR_RATINGS,
    f"""by_id as ({_INDICATOR_ROW % ("cnpj_norm", "cnpj_norm <> ''")}),
by_name as ({_INDICATOR_ROW % ("nome_norm", "cnpj_norm = '' and nome_norm <> ''")})""", False,
    ["nome", "nome_norm", "cnpj_norm", "segmento"],
)
TWO_BRANCH = f"""select case when cnpj_norm <> '' then 'id' else 'name' end as key_type,
    case when cnpj_norm <> '' then cnpj_norm else nome_norm end as key,
    {INDICATOR_MEASURES}
  from complaints where cnpj_norm <> '' or nome_norm <> '' group by 1, 2"""
PRECEDENCE = f"""precedence as (
  select k.segmento, k.cnpj, k.nome, k.nome_norm, k.cnpj_norm,
    {", ".join(f"coalesce(i.{m}, n.{m}) as {m}" for m in METRICS)}
  from kept k left join by_id i on i.cnpj_norm = k.cnpj_norm
  left join by_name n on n.nome_norm = k.nome_norm)"""
RATED = f"""{REGISTRY}, {COMPLAINTS}, {REVIEWS}, {DEDUP}, {BY_ID}, {BY_NAME}, {PRECEDENCE},
first_reviews as (
  select nome_norm, geral from reviews where nome_norm <> ''
  qualify row_number() over (partition by nome_norm
    order by cnpj_norm = '', {", ".join(f"{c} nulls first" for c in REVIEW_COLUMNS)}) = 1),
rated as (
  select p.*, f.geral as nota_geral
  from precedence p left join first_reviews f on f.nome_norm = p.nome_norm)"""
_PART_NAME = norm_name("p_brand || ' ' || p_name")
_CUSTOMER_NAME = norm_name("c_name")


def _score(a: str, b: str) -> str:
    longer = f"greatest(length({a}), length({b}))"
    return f"cast(({longer} - levenshtein({a}, {b})) * 100 // {longer} as integer)"


def _masks(text: str) -> str:
    """Per character of a text the bits of its places: bit 0 for the first."""
    chars = f"string_split({text}, '')"
    bits = f"""list_reduce(list_transform(range(len({text})), lambda i:
      case when {text}[i + 1] = c then 1::hugeint << i::hugeint else 0::hugeint end),
      lambda x, y: x | y, 0::hugeint)"""
    return f"map_from_entries(list_transform(list_distinct({chars}), lambda c: (c, {bits})))"


def _common(masks: str, size: str, other: str) -> str:
    """Longest common subsequence of a text of under 120 characters, given by its masks and
    length, and another: a bit that is cleared for each character of it."""
    every = f"((1::hugeint << ({size})::hugeint) - 1)"
    hits = f"coalesce({masks}[c], 0::hugeint)"
    steps = f"""list_reduce(
      list_transform(string_split({other}, ''), lambda c: {hits}),
      lambda row, hit: ((row + (row & hit)) | (row & xor(hit, {every}))) & {every}, {every})"""
    return f"case when {size} = 0 or len({other}) = 0 then 0 else {size} - bit_count({steps}) end"


def _weighted_pairs(cutoff: int) -> str:
    """All pairs of the tables ``l`` and ``r`` (a text ``t`` each) by their weighted ratio.

    The texts' lengths differ too little for the scores of parts: ``fail`` says if not.
    """
    ratio = "200.0::double * {common} / (len({a}) + len({b}))"
    of_texts = ratio.format(common=_common("lm", "len(lt)", "rt"), a="lt", b="rt")
    of_sorted = ratio.format(common=_common("lsm", "len(ls)", "rs"), a="ls", b="rs")
    return f"""texts as (select t, list_sort(string_split(t, ' ')) as w from (
    select t from l union select t from r)),
known as materialized (select t, w, array_to_string(w, ' ') as s, {_masks("t")} as m,
  {_masks("array_to_string(w, ' ')")} as sm from texts),
pairs as (select len(list_distinct(a.w)) = len(a.w) and len(list_distinct(b.w)) = len(b.w) as plain,
    a.t as lt, b.t as rt, a.s as ls, b.s as rs, a.m as lm, a.sm as lsm,
    list_filter(list_distinct(a.w), lambda x: list_contains(b.w, x)) as shared,
    array_to_string(list_sort(list_filter(list_distinct(a.w),
      lambda x: not list_contains(b.w, x))), ' ') as lo,
    array_to_string(list_sort(list_filter(list_distinct(b.w),
      lambda x: not list_contains(a.w, x))), ' ') as ro
  from known a, known b where a.t in (select t from l) and b.t in (select t from r)),
sized as (select *, case when greatest(len(lt), len(rt)) < 1.5 * least(len(lt), len(rt)) then 0
      else error('lengths differ too much') end as fail,
    len(array_to_string(shared, ' ')) as c, case when len(shared) > 0 then 1 else 0 end as gap,
    case when len(shared) > 0 or not plain then {_masks("lo")} end as lom from pairs),
scored as (select lt, rt, fail, greatest({of_texts}, 0.95::double * greatest({of_sorted},
    case when gap = 1 and (lo = '' or ro = '') then 100.0::double
    when gap = 0 and plain then 0.0::double -- all words against all words, in order
    else greatest(
      100.0::double * (1 - (len(lo) + len(ro) - 2 * ({_common("lom", "len(lo)", "ro")}))::double
        / (2 * (c + gap) + len(lo) + len(ro))),
      gap * 200.0::double * c / (c + c + gap + len(lo)),
      gap * 200.0::double * c / (c + c + gap + len(ro))) end)) as score from sized)
select lt as left, rt as right, score from scored where score >= {cutoff} and fail = 0"""


_STEPS, _TAKEN = _greedy_rounds(12)
ONE_TO_ONE = f"""with r as (select distinct {_CUSTOMER_NAME} as t from customer),
l as (select distinct substr(t, 1, length(t) - 1) as s from r),
open0 as materialized (
  select s, t, {_score("s", "t")} as score, substr(md5(s || chr(1) || t), 1, 15) as tie
  from l, r where abs(length(s) - length(t)) <= 1 and {_score("s", "t")} >= 94),
{_STEPS} select s as left, t as right, score from ({_TAKEN})"""

SQL: dict[str, str] = {
    "src_delimited_text": f"""select {text("c_custkey")} as c_custkey, c_name, c_mktsegment
from customer""",
    "src_text_dialect": f"select {text('event_id')} as event_id, props, event_type from events",
    "src_multi_file": f"""select {text("event_id")} as event_id, {text("user_id")} as user_id,
  value, event_type as origem_arquivo from events""",
    "src_phantom_column": f"""select {text("o_orderkey")} as o_orderkey, o_orderstatus,
  o_orderpriority from orders""",
    "src_parquet_layer": f"""with {COMPLAINTS}
select cnpj_norm, nome_norm, indice from complaints where cnpj_norm <> ''""",
    "sink_parquet_overwrite": "select c_custkey, c_name, c_acctbal from customer",
    "sink_typed_table": """select o_orderpriority as nome,
  cast(sum(floor(o_totalprice)) as bigint) as total, count(*) as pedidos
from orders group by 1""",
    "sink_load_layer": """select 'customer' as table_name, 2 * count(*) as n_rows from customer
union all select 'orders', 2 * count(*) from orders
union all select 'supplier', 2 * count(*) from supplier""",
    "sink_load_batches": """select o_orderkey, o_orderstatus, o_totalprice,
  case when o_orderstatus = 'O' then 'day-1' else 'day-2' end as lote from orders""",
    "proj_select_rename": f"""with {RAW_REGISTRY}
select "Nome" as nome, "CNPJ" as cnpj, "Segmento" as faixa from raw_registry""",
    "proj_positional_rename": f"""with {RAW_COMPLAINTS}
select ano, trimestre, instituicao_financeira, qtd_clientes_scr, 'kept' as extra
from raw_complaints""",
    "proj_drop_all_null": f"""with {RAW_COMPLAINTS}
select ano, trimestre, indice from raw_complaints""",
    "proj_fix_types": f"""with {COMPLAINTS}
select nome_norm, cast(cast(indice as decimal(11, 2)) as double) as indice, qtd_total_reclamacoes
from complaints""",
    "proj_select_present": f"""with {COMPLAINTS}, t as ({TWO_BRANCH})
select key, reclamacao_total,
  cast(total_procedentes as double) / nullif(reclamacao_total, 0) as reclamacao_pct_procedentes
from t""",
    "set_union_by_name": f"""with {RAW_REVIEWS}
select nome, segmento, cnpj, geral, origem from raw_reviews""",
    "set_union_in_order": f"""with {RAW_REVIEWS}
select nome, segmento, cnpj, origem from raw_reviews""",
    "scalar_normalize_name": f"""select doc_id, md5(n) as digest,
  cast(length(n) as integer) as n_chars_kept
from (select doc_id, {norm_name("text")} as n from documents)""",
    "scalar_normalize_name_regex": f"""select doc_id, md5(n) as digest,
  cast(length(n) as integer) as n_chars_kept
from (select doc_id, {norm_name_pattern("text")} as n from documents)""",
    "scalar_normalize_id": f"select page_id, {norm_id('url')} as id_of_url from pages",
    "scalar_decimal_comma": f"""with {RAW_COMPLAINTS}
select instituicao_financeira, {comma_number("indice")} as indice from raw_complaints""",
    "scalar_safe_cast": f"""select l_orderkey, l_linenumber, try_cast(t as double) as as_double,
  {as_long("t")} as as_long
from (select *, {text("l_quantity")} || case when l_linenumber = 3 then 'x' else '' end as t
  from lineitem)""",
    "scalar_alias_resolve": f"""with {ALIASES}, numbered as (
  select alias, row_number() over () - 1 as position from aliases),
named as (
  select p_partkey, case when p_partkey % 3 = 0 then n.alias else {norm_name("p_name")} end as name
  from part left join numbered n on n.position = p_partkey % {len(INSTITUTION_ALIASES)})
select p_partkey, name, coalesce(canonical, name) as canonical
from named left join aliases on aliases.alias = name""",
    "filter_key_present": f"""with {COMPLAINTS}
select cnpj_norm, nome_norm, indice, qtd_total_reclamacoes from complaints
where cnpj_norm <> ''""",
    "dedup_by_name": f"""with {REGISTRY}
select * from registry qualify row_number() over (
  partition by nome_norm order by {REGISTRY_ORDER}) = 1""",
    "dedup_by_key_priority": f"with {REGISTRY}, {DEDUP} select * from kept",
    "agg_by_key": f"""with {COMPLAINTS}, {BY_NAME}
select nome_norm, {", ".join(f"{m} as n_{m}" for m in METRICS)} from by_name""",
    "agg_count_column": f"""with {COMPLAINTS}
select cnpj_norm, count(*) as n_rows, count(qtd_total_reclamacoes) as n_values
from complaints where cnpj_norm <> '' group by 1""",
    "agg_count_distinct": f"""with {COMPLAINTS}
select nome_norm, count(distinct trimestre) as n_quarter_numbers,
  count(distinct ano || '/' || trimestre) as n_quarters
from complaints where nome_norm <> '' group by 1""",
    "agg_two_branch": f"with {COMPLAINTS} {TWO_BRANCH}",
    "agg_ratio_metrics": f"""with {COMPLAINTS}
select nome_norm,
  cast(sum(qtd_total_reclamacoes) as double)
    / nullif(sum(qtd_total_clientes_ccs_e_scr), 0) as per_customer,
  cast(sum(qtd_reclamacoes_reguladas_procedentes) as double)
    / nullif(sum(qtd_total_reclamacoes), 0) as share_upheld
from complaints where nome_norm <> '' group by 1""",
    "join_left_by_id": f"""with {REGISTRY}, {COMPLAINTS}, {BY_ID}
select r.nome, r.cnpj_norm, {", ".join(METRICS)}
from registry r left join by_id i on i.cnpj_norm = r.cnpj_norm""",
    "join_left_by_name": f"""with {REGISTRY}, {COMPLAINTS}, {BY_NAME}
select r.nome, r.nome_norm, {", ".join(METRICS)}
from registry r left join by_name n on n.nome_norm = r.nome_norm""",
    "join_lookup_one": f"""with {REGISTRY}, {REVIEWS}, found as (
  select nome_norm, cnpj_norm as r_cnpj_norm, {", ".join(RATING_COLUMNS[:3])}
  from reviews where nome_norm <> '' qualify row_number() over (partition by nome_norm
    order by cnpj_norm = '', cnpj_norm,
      {", ".join(f"{c} nulls first" for c in RATING_COLUMNS[:3])}) = 1)
select r.nome, r.nome_norm, r_cnpj_norm, {", ".join(RATING_COLUMNS[:3])}
from registry r left join found f on f.nome_norm = r.nome_norm""",
    "join_empty_key_guard": f"""with {REGISTRY}, {COMPLAINTS}, {BY_ID}
select r.nome, r.cnpj_norm, qtd_total_reclamacoes as total
from registry r left join by_id i on i.cnpj_norm = r.cnpj_norm and r.cnpj_norm <> ''""",
    "join_key_precedence": f"""with {REGISTRY}, {COMPLAINTS}, {DEDUP}, {BY_ID}, {BY_NAME},
{PRECEDENCE} select * from precedence""",
    "join_semi_coverage": f"""with {REGISTRY}, {COMPLAINTS},
n as (select distinct nome_norm, nome_norm in (select nome_norm from registry) as known
  from complaints)
select 'matched' as table_name, count(*) filter (known) as n_rows from n
union all select 'unmatched', count(*) filter (not known) from n""",
    "join_anti_unmatched": f"""with {REGISTRY}, {COMPLAINTS}
select distinct nome_norm from complaints
where nome_norm not in (select nome_norm from registry)""",
    "match_exact_canonical": f"""with {REGISTRY}, {COMPLAINTS}, {ALIASES},
l as (select nome_norm, coalesce(canonical, nome_norm) as c,
    row_number() over (partition by coalesce(canonical, nome_norm) order by nome_norm) as rn
  from (select distinct nome_norm from registry) left join aliases on alias = nome_norm),
r as (select nome_norm, coalesce(canonical, nome_norm) as c,
    row_number() over (partition by coalesce(canonical, nome_norm) order by nome_norm) as rn
  from (select distinct nome_norm from complaints) left join aliases on alias = nome_norm)
select l.nome_norm as left, r.nome_norm as right from l join r using (c, rn)""",
    "match_fuzzy_levenshtein": f"""with r as (select distinct {_PART_NAME} as t from part),
l as (select distinct replace(replace(t, 'OL', 'LO'), 'RED', 'REDD') as s from r),
p as (select s, t, {_score("s", "t")} as score from l, r)
select s as left, t as right, score from p where score >= 80
qualify row_number() over (partition by s order by score desc, t) = 1""",
    "match_fuzzy_wratio": f"""with r as (select distinct {_PART_NAME} as t from part),
l as (select distinct replace(replace(t, 'OL', 'LO'), 'RED', 'REDD') as t from r),
{_weighted_pairs(80)}
qualify row_number() over (partition by lt order by score desc, rt) = 1""",
    "match_one_to_one": ONE_TO_ONE,
    "match_backfill": f"""with {REGISTRY}, {COMPLAINTS}, {DEDUP}, {BY_NAME},
base as (select k.nome, k.nome_norm, {", ".join(f"n.{m}" for m in METRICS)}
  from kept k left join by_name n on n.nome_norm = k.nome_norm),
pairs as (select l.nome_norm, r.nome_norm as candidate,
    {_score("l.nome_norm", "r.nome_norm")} as score
  from (select distinct nome_norm from base where qtd_total_reclamacoes is null) l, by_name r),
best as (select * from pairs where score >= 80
  qualify row_number() over (partition by nome_norm order by score desc, candidate) = 1)
select b.nome, b.nome_norm, {", ".join(f"coalesce(b.{m}, n.{m}) as {m}" for m in METRICS)}
from base b left join best on best.nome_norm = b.nome_norm
left join by_name n on n.nome_norm = best.candidate""",
    "job_raw": f"""with {RAW_COMPLAINTS}
select *, ano || '_tri_0' || trimestre as origem_arquivo from raw_complaints""",
    "job_trusted_registry": f"with {REGISTRY} select * from registry",
    "job_trusted_reviews": f"""with {REVIEWS}
select employer_name, nome, cnpj, segmento, origem, {", ".join(RATING_COLUMNS)}, nome_norm,
  cnpj_norm from reviews""",
    "job_trusted_complaints": f"with {COMPLAINTS} select * from complaints",
    "delivery_master_table": MASTER,
    "delivery_contested_names": MASTER_CONTESTED,
    "delivery_indicators": INDICATOR_TABLE,
    "job_full_run": MASTER,
    "job_full_run_indicators": INDICATOR_TABLE,
    "job_raw_counts": f"""with {RAW_REGISTRY}, {RAW_COMPLAINTS}, {RAW_REVIEWS}
select 'bancos' as table_name, count(*) as n_rows from raw_registry
union all select 'empregados', count(*) from raw_reviews
union all select 'reclamacoes', count(*) from raw_complaints""",
    "report_cast_losses": f"""with {REVIEWS}, {COMPLAINTS}
{" union all ".join(
    f"select '{name}' as dataset, '{c}' as field, "
    f"(select count(*) from raw_{of} where trim({c}) <> '') - (select count({c}) from {of}) as lost"
    for name, of, fields in (
        ("empregados", "reviews", RATING_COLUMNS),
        ("reclamacoes", "complaints", ["indice", *COMPLAINT_COUNTS]),
    )
    for c in fields
)}""",
    "report_layer_counts": f"""with {REGISTRY}, {COMPLAINTS}, {REVIEWS}, {DEDUP}
select 'registry' as table_name, count(*) as n_rows from registry
union all select 'reviews', count(*) from reviews
union all select 'complaints', count(*) from complaints
union all select 'delivery', count(*) from kept""",
    "report_coverage": f"""with {RATED}
select count(*) as n_total, count(qtd_total_reclamacoes) as n_first,
  count(nota_geral) as n_second,
  count(*) filter (qtd_total_reclamacoes is not null and nota_geral is not null) as n_both
from rated""",
    "report_key_completeness": f"""with {COMPLAINTS}
select count(*) as n_rows, count(*) filter (cnpj_norm = '') as n_missing,
  cast(count(*) filter (cnpj_norm = '') as double) / count(*) as share_missing
from complaints""",
    "report_replacement_chars": """select 'text' as column_name,
  cast(sum(length(text) - length(replace(text, 'é', ''))) as bigint) as n_lost,
  count(*) filter (contains(text, 'é')) as n_rows from documents
union all select 'lang', 0, 0 union all select 'source', 0, 0""",
    "report_match_uplift": f"""with {RAW_REGISTRY}, {RAW_COMPLAINTS},
a as (select distinct regexp_replace("CNPJ", '[^0-9]', '', 'g') as k from raw_registry),
b as (select distinct {norm_id('"CNPJ"')} as k from raw_registry)
select 'digits' as rule, count(*) as n_matched from a where k <> '' and k in
  (select regexp_replace(cnpj_if, '[^0-9]', '', 'g') from raw_complaints)
union all
select 'without_zeros', count(*) from b where k <> '' and k in
  (select {norm_id("cnpj_if")} from raw_complaints)""",
    "report_ranked": f"""with {RATED}
select nome_norm, segmento, qtd_total_reclamacoes,
  cast(round(cast(indice_medio as decimal(20, 6)), 1) as double) as indice, nota_geral
from rated where nota_geral is not null and qtd_total_reclamacoes is not null""",
}
