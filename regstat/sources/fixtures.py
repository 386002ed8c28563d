"""Raw register layouts derived from the driver's test tables (FIXTURES.md).

The registers themselves are not public test data, so each raw layout is
*derived* from a driver table by integer arithmetic: establishments from
``orders``, employment links from ``lineitem``, municipal GDP from the
``nation ⨝ region ⨝ customer ⨝ orders ⨝ lineitem`` join.  The derivation
is written once as SQL expressions emitted for two dialects — Spark (run
through ``selectExpr``, so it stays in Catalyst/codegen and grows with the
table) and DuckDB (used by the oracles).  Only the *inputs* are shared this
way; the operators under test are DataFrame code on one side and
hand-written SQL on the other.

No hash, random or clock function is used, so both engines give the same rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from .. import dims
from ..schemas import ESTAB_HEADERS, GDP_DROP, GDP_HEADERS
from ..functions.columns import SENTINELS_LINKS, normalize_name
from ..operators.vintage import MONTHS
from ..session import spread, wide


@dataclass(frozen=True)
class Dialect:
    name: str  # "spark" | "duckdb"

    def idiv(self, a: str, b: str | int) -> str:
        return f"({a} div {b})" if self.name == "spark" else f"({a} // {b})"

    def pick(self, values, idx: str) -> str:
        vals = ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values)
        if self.name == "spark":
            return f"element_at(array({vals}), cast({idx} AS int) + 1)"
        return f"([{vals}])[{idx} + 1]"

    def s(self, x: str) -> str:
        return f"cast({x} AS string)" if self.name == "spark" else f"cast({x} AS varchar)"


SPARK, DUCK = Dialect("spark"), Dialect("duckdb")

UF_NUM = [int(c) for c, _ in dims.UF_CODES]
# Nine spellings of "unknown" as they appear in the extracts (links spelling).
SPELLINGS = list(SENTINELS_LINKS)
# Legal natures drawn by the fixture: the 20 enterprise ones and four others.
NATURES = dims.ENTERPRISE_NATURES + ["1031", "2143", "3069", "3999"]


def fixture_codes() -> list[str]:
    """Known activity codes for fixtures, generated by rule: three per division
    range entry, every listed exception, and the unknown-sector codes."""
    codes = []
    for (lo, hi), _ in dims.DIVISION_SECTOR:
        for div in range(lo, hi + 1):
            for j in range(3):
                codes.append(f"{div:02d}{(11 * j + div) % 100:02d}{j}0{j}")
    codes += list(dims.SECTOR_EXCEPTIONS)
    codes += ["9999999", "9999997"]
    return sorted(set(codes))


def raw_codes() -> list[str]:
    """Codes the raw extracts carry: the known ones plus unlisted codes of known divisions."""
    return fixture_codes() + ["4799999", "0199999", "8899999", "2599991"]


def _money_text(d: Dialect, cents: str) -> str:
    """Integer cents → decimal-comma text '1234,05'."""
    return (f"{d.s(d.idiv(cents, 100))} || ',' || lpad({d.s(f'({cents}) % 100')}, 2, '0')")


# --------------------------------------------------------------------------
# Establishments (from orders); canonical (target) names, all strings.
# --------------------------------------------------------------------------
def estab_base(d: Dialect) -> list[tuple[str, str]]:
    """Per-row terms computed once (the row key, the drawn code, the year)."""
    codes = raw_codes()
    return [("k", "o_orderkey"), ("ck", "o_custkey"),
            ("code", d.pick(codes, f"o_orderkey % {len(codes)}")),
            ("y", "cast(year(o_orderdate) + 15 AS int)")]


def estab_exprs(d: Dialect) -> list[tuple[str, str]]:
    k, ck, code = "k", "ck", "code"
    act = f"({ck} % 250)"
    clt = d.idiv(f"{act} * 3", 4)
    spell = lambda idx: d.pick(SPELLINGS, idx)
    return [
        ("ano", "y"),
        ("id_municipio", f"CASE WHEN {k} % 97 = 0 THEN '{{ñ class}}' "
                         f"ELSE {d.s(d.pick(UF_NUM, f'{k} % 27') + f' * 10000 + {ck} % 10000')} END"),
        ("sigla_uf", d.s(d.pick(UF_NUM, f"{k} % 27"))),
        ("cnae_2_subclasse", f"CASE WHEN {k} % 79 = 0 THEN '{{ñ class}}' WHEN {k} % 101 = 0 THEN '0000000' "
                             f"WHEN {k} % 2 = 0 THEN {d.s(f'cast({code} AS int)')} ELSE {code} END"),
        ("cnae_2_classe", f"CASE WHEN {k} % 13 = 0 THEN ' ' || substr({code}, 1, 5) || ' ' "
                          f"WHEN {k} % 17 = 0 THEN chr(160) || substr({code}, 1, 5) ELSE substr({code}, 1, 5) END"),
        ("cnae_1_classe", d.s(f"({k} * 7) % 99999")),
        ("nat_jur", f"CASE WHEN {k} % 89 = 0 THEN '0000-1' ELSE {d.pick(NATURES, f'{k} % 24')} END"),
        ("tam_estab", f"CASE WHEN {k} % 83 = 0 THEN '{{ñ' WHEN {k} % 71 = 0 THEN NULL "
                      f"ELSE lpad({d.s(f'{k} % 11')}, 2, '0') END"),
        ("qtd_vinc_ativos", d.s(act)),
        ("qtd_vinc_clt", d.s(clt)),
        ("qtd_vinc_estat", d.s(f"{act} - {clt}")),
        ("ind_rais_negativa", f"CASE WHEN {act} = 0 THEN '1' ELSE '0' END"),
        ("ind_ativ_ano", f"CASE WHEN {k} % 61 = 0 THEN '000-1' ELSE {d.s(f'{k} % 2')} END"),
        ("ind_cei_vinculado", d.s(f"{d.idiv(k, 2)} % 2")),
        ("ind_pat", d.s(f"{d.idiv(k, 3)} % 2")),
        ("ind_simples", f"CASE WHEN {k} % 61 = 0 THEN '000-1' ELSE {d.s(f'{d.idiv(k, 5)} % 2')} END"),
        ("bairro_sp", f"CASE WHEN {k} % 7 = 0 THEN {spell(f'{k} % 9')} ELSE {d.s(f'{k} % 500')} END"),
        ("bairro_fortaleza", f"CASE WHEN {k} % 11 = 0 THEN {spell(f'{d.idiv(k, 11)} % 9')} "
                             f"ELSE {d.s(f'{k} % 300')} END"),
        ("bairro_rj", d.s(f"{k} % 200")),
        ("distrito_sp", f"CASE WHEN {k} % 5 = 0 THEN '{{ñ class}}' ELSE {d.s(f'{k} % 96')} END"),
        ("regiao_adm_df", d.s(f"{k} % 33")),
        ("cep", d.s(f"{k} % 99999")),
        ("subsetor_ibge", d.s(f"{k} % 26")),
        ("tipo_estab", d.s(f"1 + {k} % 2")),
        ("ctg_tipo_estab", f"CASE WHEN {k} % 2 = 0 THEN 'CNPJ' ELSE 'CEI' END"),
    ]



# The two header layouts, in file column order (older files have no CEP,
# subsector or type description; newer ones repeat "Tipo Estab").
ESTAB_LAYOUT_OLD = ["MUNICIPIO", "UF", "BAIRRO_SP", "BAIRRO FORT", "BAIRRO_RJ", "DISTRITO_SP", "REG ADM DF",
                    "CLAS CNAE 95", "CLAS CNAE 20", "SB CLAS 20", "ESTOQUE", "EST CLT OUT", "ESTOQUE ESTA",
                    "IND ATIV ANO", "IND CEI VINC", "IND PAT", "IND RAIS NEG", "IND SIMPLES", "NAT JURIDICA",
                    "TAMESTAB", "TIPO ESTBL"]
ESTAB_LAYOUT_NEW = ["Bairros SP", "Bairros Fortaleza", "Bairros RJ", "CNAE 2.0 Classe", "CNAE 95 Classe",
                    "Distritos SP", "Qtd Vínculos CLT", "Qtd Vínculos Ativos", "Qtd Vínculos Estatutários",
                    "Ind Atividade Ano", "Ind CEI Vinculado", "Ind Estab Participa PAT", "Ind Rais Negativa",
                    "Ind Simples", "Município", "Natureza Jurídica", "Regiões Adm DF", "CNAE 2.0 Subclasse",
                    "Tamanho Estabelecimento", "Tipo Estab", "Tipo Estab", "UF", "IBGE Subsetor", "CEP Estab"]
ESTAB_NEW_FROM = 2014


def _layout_names(layout: list[str]) -> list[tuple[str, str]]:
    """(raw name as the CSV reader gives it, canonical name) in file order."""
    out, seen = [], {}
    dup = {h for h in layout if layout.count(h) > 1}
    for pos, h in enumerate(layout):
        raw = f"{h}{pos}" if h in dup else h
        n = seen.get(h, 0)
        seen[h] = n + 1
        canon = ESTAB_HEADERS.get(h) if h not in dup else ["tipo_estab", "ctg_tipo_estab"][n]
        out.append((raw, canon))
    return out


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; its files and row groups decide the splits."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_estab_canonical(spark: SparkSession, sf_dir: str, orders_filter: str | None = None) -> DataFrame:
    """All raw establishment rows under target names (all strings, plus ``ano``).

    ``orders_filter`` is a predicate on the raw ``orders`` columns, so that it
    reaches the Parquet scan (a filter on the derived year would not)."""
    base = [f"{e} AS {n}" for n, e in estab_base(SPARK)]
    exprs = [f"{e} AS `{n}`" for n, e in estab_exprs(SPARK)]
    orders = read_table(spark, sf_dir, "orders")
    if orders_filter:
        orders = orders.filter(orders_filter)
    return orders.selectExpr(*base).selectExpr(*exprs)


def raw_estab_layouts(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The raw extract as two header layouts (old before 2014, new from 2014),
    columns named as the CSV reader names them, plus the file's year ``ano``."""
    split = f"TIMESTAMP_NTZ '{ESTAB_NEW_FROM - 15}-01-01 00:00:00'"  # first order date of the new layout
    frames = []
    for layout, cond in [(ESTAB_LAYOUT_OLD, f"o_orderdate < {split}"), (ESTAB_LAYOUT_NEW, f"o_orderdate >= {split}")]:
        cols = [f"`{canon_name}` AS `{raw}`" for raw, canon_name in _layout_names(layout)]
        frames.append(raw_estab_canonical(spark, sf_dir, cond).selectExpr(*cols, "ano"))
    return frames


# --------------------------------------------------------------------------
# Employment links (from lineitem); canonical (normalised) names, all strings.
# --------------------------------------------------------------------------
# Raw header of each canonical link column (normalisation gives the canonical name back).
LINK_HEADERS = {
    "bairros_sp": "Bairros SP", "bairros_fortaleza": "Bairros Fortaleza", "bairros_rj": "Bairros RJ",
    "causa_afastamento_1": "Causa Afastamento 1", "causa_afastamento_2": "Causa Afastamento 2",
    "causa_afastamento_3": "Causa Afastamento 3", "motivo_desligamento": "Motivo Desligamento",
    "cbo_ocupacao_2002": "CBO Ocupação 2002", "cnae_2_0_classe": "CNAE 2.0 Classe",
    "cnae_95_classe": "CNAE 95 Classe", "distritos_sp": "Distritos SP",
    "vinculo_ativo_31_12": "Vínculo Ativo 31/12", "faixa_etaria": "Faixa Etária",
    "faixa_hora_contrat": "Faixa Hora Contrat", "faixa_remun_dezem_sm": "Faixa Remun Dezem (SM)",
    "faixa_remun_media_sm": "Faixa Remun Média (SM)", "faixa_tempo_emprego": "Faixa Tempo Emprego",
    "escolaridade_apos_2005": "Escolaridade após 2005", "qtd_hora_contr": "Qtd Hora Contr",
    "idade": "Idade", "ind_cei_vinculado": "Ind CEI Vinculado", "ind_simples": "Ind Simples",
    "mes_admissao": "Mês Admissão", "mes_desligamento": "Mês Desligamento", "mun_trab": "Mun Trab",
    "municipio": "Município", "nacionalidade": "Nacionalidade", "natureza_juridica": "Natureza Jurídica",
    "ind_portador_defic": "Ind Portador Defic", "qtd_dias_afastamento": "Qtd Dias Afastamento",
    "raca_cor": "Raça Cor", "regioes_adm_df": "Regiões Adm DF",
    "vl_remun_dezembro_nom": "Vl Remun Dezembro Nom", "vl_remun_dezembro_sm": "Vl Remun Dezembro (SM)",
    "vl_remun_media_nom": "Vl Remun Média Nom", "vl_remun_media_sm": "Vl Remun Média (SM)",
    "cnae_2_0_subclasse": "CNAE 2.0 Subclasse", "sexo_trabalhador": "Sexo Trabalhador",
    "tamanho_estabelecimento": "Tamanho Estabelecimento", "tempo_emprego": "Tempo Emprego",
    "tipo_admissao": "Tipo Admissão", "tipo_estab41": "Tipo Estab", "tipo_estab42": "Tipo Estab",
    "tipo_defic": "Tipo Defic", "tipo_vinculo": "Tipo Vínculo", "ibge_subsetor": "IBGE Subsetor",
    "ano_chegada_brasil": "Ano Chegada Brasil", "ind_trab_intermitente": "Ind Trab Intermitente",
    "ind_trab_parcial": "Ind Trab Parcial", "tipo_salario": "Tipo Salário",
    "vl_salario_contratual": "Vl Salário Contratual",
}
_MONTH_HEADER = {"janeiro": "Janeiro", "fevereiro": "Fevereiro", "marco": "Março", "abril": "Abril",
                 "maio": "Maio", "junho": "Junho", "julho": "Julho", "agosto": "Agosto",
                 "setembro": "Setembro", "outubro": "Outubro", "novembro": "Novembro"}
for _m in MONTHS:
    LINK_HEADERS[f"vl_rem_{_m}_cc"] = f"Vl Rem {_MONTH_HEADER[_m]} CC"
    LINK_HEADERS[f"vl_rem_{_m}_sc"] = f"Vl Rem {_MONTH_HEADER[_m]} SC"


def links_base(d: Dialect) -> list[tuple[str, str]]:
    """Per-row terms computed once: key, part, year, cents, drawn code and states."""
    codes = fixture_codes()
    k = "(l_orderkey * 8 + l_linenumber)"
    return [("k", k), ("pk", "l_partkey"), ("y", "cast(year(l_shipdate) + 19 AS int)"),
            ("cents", "cast(round(l_extendedprice * 100) AS bigint)"),
            ("price", "l_extendedprice"), ("qty", "l_quantity"),
            ("code", d.pick(codes, f"l_partkey % {len(codes)}")),
            ("uf", d.pick(UF_NUM, f"{k} % 27")), ("uf2", d.pick(UF_NUM, f"({k} + 1) % 27"))]


def links_exprs(d: Dialect) -> list[tuple[str, str]]:
    k, pk, ano, cents, uf, uf2 = "k", "pk", "y", "cents", "uf", "uf2"
    spell = lambda idx: d.pick(SPELLINGS, idx)
    e = [
        ("ano", "y"),
        ("municipio", f"CASE WHEN {k} % 107 = 0 THEN NULL "
                      f"WHEN {k} % 103 = 0 THEN '99' || lpad({d.s(f'{pk} % 10000')}, 4, '0') "
                      f"ELSE {d.s(f'{uf} * 10000 + {pk} % 10000')} END"),
        ("mun_trab", d.s(f"{uf2} * 10000 + {pk} % 10000")),
        ("vl_remun_dezembro_nom", f"lpad(replace({d.s('cast(price AS decimal(15,2))')}, '.', ','), 13, '0')"),
        ("vl_remun_dezembro_sm", _money_text(d, f"{k} % 500000")),
        ("vl_remun_media_nom", f"CASE WHEN {k} % 29 = 0 THEN '1.' || lpad({d.s(f'{k} % 1000')}, 3, '0') || ',50' "
                               f"ELSE {_money_text(d, f'({k} * 37) % 10000000')} END"),
        ("vl_remun_media_sm", _money_text(d, f"{k} % 30000")),
        ("tempo_emprego", f"{d.s('cast(qty AS int)')} || ',' || {d.s(f'{k} % 10')}"),
        ("bairros_sp", f"CASE WHEN {k} % 7 = 0 THEN {spell(f'{k} % 9')} ELSE {d.s(f'{k} % 100')} END"),
        ("bairros_fortaleza", f"CASE WHEN {k} % 7 = 0 THEN {spell(f'{d.idiv(k, 3)} % 9')} ELSE {d.s(f'{k} % 200')} END"),
        ("bairros_rj", f"CASE WHEN {k} % 7 = 0 THEN {spell(f'{d.idiv(k, 5)} % 9')} ELSE {d.s(f'{k} % 150')} END"),
        ("distritos_sp", f"CASE WHEN {k} % 7 = 0 THEN {spell(f'{d.idiv(k, 7)} % 9')} ELSE {d.s(f'{k} % 96')} END"),
        ("nacionalidade", f"CASE WHEN {k} % 7 = 0 THEN {spell(f'{d.idiv(k, 11)} % 9')} ELSE {d.s(f'10 + {k} % 50')} END"),
        ("vinculo_ativo_31_12", d.s(f"{k} % 2")),
        ("sexo_trabalhador", d.s(f"{k} % 2 + 1")),
        ("faixa_etaria", d.s(f"{k} % 8 + 1")),
        ("escolaridade_apos_2005", d.s(f"{k} % 11 + 1")),
        ("cbo_ocupacao_2002", d.s(f"(1 + {pk} % 9) * 100000 + {pk} % 1000")),
        ("cnae_2_0_classe", "substr(code, 1, 5)"),
        ("cnae_2_0_subclasse", "code"),
        ("cnae_95_classe", d.s(f"{pk} % 50000")),
        ("tamanho_estabelecimento", d.s(f"1 + {pk} % 10")),
        ("causa_afastamento_1", f"CASE WHEN {k} % 13 = 0 THEN '{{ñ class}}' ELSE {d.s(f'{k} % 10')} END"),
        ("causa_afastamento_2", d.s(f"{d.idiv(k, 2)} % 10")),
        ("causa_afastamento_3", d.s(f"{d.idiv(k, 3)} % 10")),
        ("motivo_desligamento", d.s(f"{k} % 7")),
        ("faixa_hora_contrat", d.s(f"{k} % 6 + 1")),
        ("faixa_remun_dezem_sm", d.s(f"{k} % 12")),
        ("faixa_remun_media_sm", d.s(f"{d.idiv(k, 2)} % 12")),
        ("faixa_tempo_emprego", d.s(f"{k} % 9 + 1")),
        ("qtd_hora_contr", d.s(f"20 + {k} % 25")),
        ("idade", d.s(f"16 + {k} % 60")),
        ("ind_cei_vinculado", d.s(f"{k} % 2")),
        ("ind_simples", d.s(f"{d.idiv(k, 2)} % 2")),
        ("mes_admissao", d.s(f"{k} % 13")),
        ("mes_desligamento", d.s(f"{d.idiv(k, 3)} % 13")),
        ("natureza_juridica", d.pick(NATURES, f"{k} % 24")),
        ("ind_portador_defic", d.s(f"{d.idiv(k, 5)} % 2")),
        ("qtd_dias_afastamento", f"CASE WHEN {k} % 211 = 0 THEN '40000' ELSE {d.s(f'{k} % 400')} END"),
        ("raca_cor", d.s(f"{k} % 6 + 1")),
        ("regioes_adm_df", d.s(f"{k} % 33")),
        ("tipo_admissao", d.s(f"{k} % 10")),
        ("tipo_estab41", d.s(f"1 + {k} % 2")),
        ("tipo_estab42", f"CASE WHEN {k} % 2 = 0 THEN 'CNPJ' ELSE 'CEI' END"),
        ("tipo_defic", d.s(f"{k} % 7")),
        ("tipo_vinculo", d.s(f"10 + {k} % 20")),
        ("ibge_subsetor", f"CASE WHEN {ano} >= 2015 THEN {d.s(f'1 + {pk} % 25')} END"),
        ("ano_chegada_brasil", f"CASE WHEN {ano} >= 2016 THEN {d.s(f'1950 + {k} % 70')} END"),
        ("ind_trab_intermitente", f"CASE WHEN {ano} >= 2017 THEN {d.s(f'{k} % 2')} END"),
        ("ind_trab_parcial", f"CASE WHEN {ano} >= 2017 THEN {d.s(f'{d.idiv(k, 2)} % 2')} END"),
        ("tipo_salario", f"CASE WHEN {ano} >= 2018 THEN {d.s(f'1 + {k} % 5')} END"),
        ("vl_salario_contratual", f"CASE WHEN {ano} >= 2018 THEN {_money_text(d, f'({k} * 13) % 1000000')} END"),
    ]
    for i, m in enumerate(MONTHS, start=1):
        val = _money_text(d, d.idiv(cents, i))
        e.append((f"vl_rem_{m}_cc", f"CASE WHEN {ano} BETWEEN 2015 AND 2019 THEN {val} END"))
        e.append((f"vl_rem_{m}_sc", f"CASE WHEN {ano} >= 2020 THEN {val} END"))
    return e


#: The lineitem columns that the links are derived from.
LINK_SOURCES = ["l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", "l_extendedprice", "l_quantity"]


def raw_links_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All raw link rows under target names; the narrow rows are dealt over all cores before they become wide ones."""
    base = [f"{e} AS {n}" for n, e in links_base(SPARK)]
    exprs = [f"{e} AS `{n}`" for n, e in links_exprs(SPARK)]
    lines = spread(read_table(spark, sf_dir, "lineitem").select(*LINK_SOURCES))
    return wide(lines.selectExpr(*base).selectExpr(*exprs))


def raw_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw links extract: header names as the CSV reader gives them
    (the repeated "Tipo Estab" carries its column index), plus ``ano``."""
    canon = raw_links_canonical(spark, sf_dir)
    cols, pos = [], 0
    for name in canon.columns:
        if name == "ano":
            continue
        raw = LINK_HEADERS[name]
        if raw == "Tipo Estab":
            raw = f"Tipo Estab{pos}"
        cols.append(f"`{name}` AS `{raw}`")
        pos += 1
    return canon.selectExpr(*cols, "ano")


def in_vintage(raw_header: str, year: int) -> bool:
    """Whether a year's extract has the column (Appendix A of the blueprint)."""
    name = normalize_name(raw_header)
    if name in ("tipo_salario", "vl_salario_contratual"):
        return year == 2018
    if name in ("ind_trab_parcial", "ind_trab_intermitente"):
        return year >= 2017
    if name == "ano_chegada_brasil":
        return year >= 2016
    if name.startswith("vl_rem_"):
        return year >= 2020 if name.endswith("_sc") else 2015 <= year <= 2019
    return name != "ibge_subsetor" or year >= 2015


# --------------------------------------------------------------------------
# Municipal GDP (from the 5-table join), two workbook vintages.
# --------------------------------------------------------------------------

GDP_VINTAGE_SPLIT = 2010   # first year of the second workbook
GDP_YEAR_SHIFT = 12        # order year 1995..2001 → GDP year 2007..2013


def gdp_line_exprs(d: Dialect) -> list[str]:
    """Per-line select list over the join: value added in 10^-4 units, as integers."""
    cents = "cast(round(l_extendedprice * 100) AS bigint)"
    rev = f"{cents} * cast(100 - round(l_discount * 100) AS bigint)"
    tax = f"{cents} * cast(round(l_tax * 100) AS bigint)"
    line = [
        f"cast(year(o_orderdate) + {GDP_YEAR_SHIFT} AS bigint) AS ano",
        "n_nationkey", "n_name", "r_regionkey", "r_name",
        f"CASE WHEN l_returnflag = 'A' THEN {rev} ELSE 0 END AS agro",
        f"CASE WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN {rev} ELSE 0 END AS ind",
        f"CASE WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN {rev} ELSE 0 END AS serv",
        f"CASE WHEN l_returnflag = 'R' THEN {rev} ELSE 0 END AS pub",
        f"{tax} AS tax",
    ]
    return line


def gdp_value_exprs(d: Dialect) -> list[tuple[str, str]]:
    """Canonical GDP columns over the per-(ano, nation) aggregate ``g`` joined to population ``p``."""
    v = lambda c: f"cast({c} AS double) / cast(10000 AS double)"
    total = f"({v('s_agro')} + {v('s_ind')} + {v('s_serv')} + {v('s_pub')})"
    pib = f"({total} + {v('s_tax')})"
    return [
        ("ano", "ano"),
        ("codigo_grande_regiao", "cast(r_regionkey + 1 AS bigint)"),
        ("nome_grande_regiao", "'  ' || r_name || ' '"),
        ("codigo_uf", "cast(n_nationkey + 11 AS bigint)"),
        ("sigla_uf", f"lpad({d.s('n_nationkey')}, 2, '0')"),
        ("nome_uf", "' ' || n_name"),
        ("id_municipio", "cast((n_nationkey + 11) * 100000 + r_regionkey AS bigint)"),
        ("nome_municipio", "n_name || ' '"),
        ("vab_agropecuaria", v("s_agro")),
        ("vab_industria", v("s_ind")),
        ("vab_servicos", v("s_serv")),
        ("vab_servicos_publicos", v("s_pub")),
        ("vab_total", total),
        ("impostos_liquidos_sobre_produtos", v("s_tax")),
        ("pib_corrente", pib),
        ("pib_per_capita_corrente", f"{pib} * 1000 / cast(n_pop AS double)"),
        ("atividade_principal_vab", "' Demais serviços '"),
        ("atividade_2_vab", "'Indústrias de transformação' || chr(160)"),
        ("atividade_3_vab", f"'  Agricultura ' || {d.s('ano % 3')}"),
    ]


def gdp_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GDP rows under table names, one per (year, nation), before any treatment."""
    t = lambda n: read_table(spark, sf_dir, n)
    from pyspark.sql import functions as F

    lines = (t("lineitem").join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
             .join(t("customer"), F.col("o_custkey") == F.col("c_custkey"))
             .join(F.broadcast(t("nation")), F.col("c_nationkey") == F.col("n_nationkey"))
             .join(F.broadcast(t("region")), F.col("n_regionkey") == F.col("r_regionkey"))
             .selectExpr(*gdp_line_exprs(SPARK)))
    g = lines.groupBy("ano", "n_nationkey", "n_name", "r_regionkey", "r_name").agg(
        *[F.sum(c).alias(f"s_{c}") for c in ["agro", "ind", "serv", "pub", "tax"]])
    pop = population(spark, sf_dir)
    g = g.join(F.broadcast(pop), on="n_nationkey", how="left")
    return g.selectExpr(*[f"{e} AS `{n}`" for n, e in gdp_value_exprs(SPARK)])


def population(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inhabitants per place for QRY-07: customers per nation."""
    from pyspark.sql import functions as F

    return (read_table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("n_nationkey"))
            .agg(F.count(F.lit(1)).alias("n_pop")))


def raw_gdp_vintages(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The two workbooks as read: workbook headers, 24 extra columns, the
    second one without the third-activity column."""
    from ..session import checkpoint_root

    # The 5-table join runs once: its small (year, place) result is checkpointed
    # to the shared folder, and both workbooks are cut from it (a union would
    # otherwise recompute the join per branch).
    checkpoint_root(spark)
    canon = gdp_canonical(spark, sf_dir).checkpoint(eager=True)
    inverse = {v: k for k, v in GDP_HEADERS.items()}
    frames = []
    for cond, drop in [(f"ano < {GDP_VINTAGE_SPLIT}", None),
                       (f"ano >= {GDP_VINTAGE_SPLIT}", "atividade_3_vab")]:
        cols = [f"`{c}` AS `{inverse[c]}`" for c in canon.columns if c != drop]
        extra = [f"{SPARK.s(f'id_municipio % {i + 7}')} AS `{name}`" for i, name in enumerate(GDP_DROP)]
        frames.append(canon.filter(cond).selectExpr(*cols, *extra))
    return frames
