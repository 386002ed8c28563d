"""DuckDB oracles: for each registered query, the same result as plain SQL.

The raw layouts are derived from the driver tables with the same fixture
expressions as the Spark side (``sources.fixtures``, DuckDB dialect); every
transformation after that is written here in SQL, independently of the
DataFrame operators it checks.
"""

from __future__ import annotations

from . import dims, schemas
from .operators.vintage import INT_COLUMNS, MONTHS, PAY_COLUMNS
from .plans import flows as P
from .plans.analyses import BREAKDOWN
from .plans.queries import AS_OF, ESTAB_RAW_COLUMNS, OWNER, PROFILED, STAGING_VIEW
from .sources import fixtures as fx

D = fx.DUCK
# Fixed values, written here a second time: a wrong entry in the engine's own lists must show.
STATES = [("11", "RO"), ("12", "AC"), ("13", "AM"), ("14", "RR"), ("15", "PA"), ("16", "AP"), ("17", "TO"),
          ("21", "MA"), ("22", "PI"), ("23", "CE"), ("24", "RN"), ("25", "PB"), ("26", "PE"), ("27", "AL"), ("28", "SE"), ("29", "BA"),
          ("31", "MG"), ("32", "ES"), ("33", "RJ"), ("35", "SP"), ("41", "PR"), ("42", "SC"), ("43", "RS"),
          ("50", "MS"), ("51", "MT"), ("52", "GO"), ("53", "DF")]
NOT_ENTERPRISE = ["84", "94", "99"]
NATURES = ["2046", "2054", "2062", "2135", "2232", "2240", "2259", "2267", "2283", "2291",
           "2305", "2313", "2321", "2330", "2348", "4014", "4022", "4081", "4111", "4120"]
UNKNOWN_ESTAB = ["0000-1", "000-1", "00-1", "0-1", "{ñ", "{ñ class}", "{ñ c", "{ñ clas", "{ñ cl"]
UNKNOWN_LINKS = [*UNKNOWN_ESTAB[:-1], "{ñ cl}"]
WS = r"[\t\n\x0B\f\r \x{00A0}]"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def in_list(values) -> str:
    return "(" + ", ".join(q(v) for v in values) + ")"


def decode(x: str, spellings=UNKNOWN_ESTAB) -> str:
    return f"CASE WHEN {x} IN {in_list(spellings)} THEN '-1' ELSE {x} END"


def uf_case(code: str) -> str:
    whens = " ".join(f"WHEN {q(c)} THEN {q(s)}" for c, s in STATES)
    return f"coalesce(CASE {code} {whens} END, 'NI')"


def activity_values() -> str:
    return dims.values_sql(dims.activity_rows(fx.fixture_codes()), ["a_code", "a_ibge", "a_sebrae"])


def size_values() -> str:
    return dims.values_sql(dims.size_rows(), ["s_setor", "s_tam", "s_porte"])


# --------------------------------------------------------------------------
# raw layouts
# --------------------------------------------------------------------------
def raw_estab() -> str:
    base = ", ".join(f"{e} AS {n}" for n, e in fx.estab_base(D))
    cols = ", ".join(f'{e} AS "{n}"' for n, e in fx.estab_exprs(D))
    return f"SELECT {cols} FROM (SELECT {base} FROM orders) b"


def raw_links() -> str:
    base = ", ".join(f"{e} AS {n}" for n, e in fx.links_base(D))
    cols = ", ".join(f'{e} AS "{n}"' for n, e in fx.links_exprs(D))
    return f"SELECT {cols} FROM (SELECT {base} FROM lineitem) b"


LINK_RAW_COLUMNS = [n for n, _ in fx.links_exprs(D)]
OLD_LAYOUT_MISSING = {"cep", "subsetor_ibge", "ctg_tipo_estab"}


def estab_stacked() -> str:
    """Both layouts after rename: the old one has no CEP, subsector or type text."""
    cols = []
    for c in ESTAB_RAW_COLUMNS:
        cols.append(f"CASE WHEN ano >= {fx.ESTAB_NEW_FROM} THEN {c} END AS {c}" if c in OLD_LAYOUT_MISSING else c)
    return f"SELECT {', '.join(cols)} FROM ({raw_estab()}) r"


# --------------------------------------------------------------------------
# PIPE-01 in SQL
# --------------------------------------------------------------------------
def estab_treated() -> str:
    strings = [c for c in ESTAB_RAW_COLUMNS if c not in ("ano", "sigla_uf", "ctg_tipo_estab")]
    s1 = []
    for c in strings:
        src = f"CASE WHEN ano < 2014 THEN '-1' ELSE {c} END" if c in ("cep", "subsetor_ibge") else c
        s1.append(f"coalesce({decode(strip(src))}, '-1') AS {c}")
    s1.append("coalesce(TRY_CAST(trunc(TRY_CAST(id_municipio AS DOUBLE) / 10000) AS INTEGER), -1) AS sigla_uf")
    t1 = f"SELECT ano, {', '.join(s1)} FROM ({estab_stacked()}) r"
    t2 = (f"SELECT * REPLACE (CASE WHEN length(cnae_2_subclasse) = 6 THEN '0' || cnae_2_subclasse "
          f"ELSE cnae_2_subclasse END AS cnae_2_subclasse) FROM ({t1}) t1")
    div = "lpad(CAST(TRY_CAST(cnae_2_subclasse AS INTEGER) AS VARCHAR), 2, '0')"
    t3 = (f"SELECT * REPLACE (CAST(TRY_CAST(tam_estab AS INTEGER) AS VARCHAR) AS tam_estab), "
          f"CASE WHEN NOT ({div} IN {in_list(NOT_ENTERPRISE)}) "
          f"AND nat_jur IN {in_list(NATURES)} THEN 1 ELSE 0 END AS padrao_sebrae FROM ({t2}) t2")
    t4 = (f"SELECT t3.*, coalesce(a_ibge, '-1') AS setor_ibge, coalesce(a_sebrae, '-1') AS setor_sebrae "
          f"FROM ({t3}) t3 LEFT JOIN {activity_values()} ON t3.cnae_2_subclasse = a_code")
    t5 = (f"SELECT t4.*, coalesce(s_porte, '-1') AS porte_sebrae FROM ({t4}) t4 "
          f"LEFT JOIN {size_values()} ON t4.setor_ibge = s_setor AND t4.tam_estab = s_tam")
    out = []
    for c in schemas.ESTAB_OUTPUT_ORDER:
        if c in P.ESTAB_INT_COLUMNS:
            out.append(f"coalesce(TRY_CAST({c} AS INTEGER), -1) AS {c}")
        elif c == "ano":
            out.append("ano")
        elif c == "curr_date":
            out.append(f"{q(AS_OF)} AS curr_date")
        elif c == "ds_owner":
            out.append(f"{q(OWNER)} AS ds_owner")
        else:
            out.append(f"coalesce({strip(c)}, '-1') AS {c}")
    return f"SELECT {', '.join(out)} FROM ({t5}) t5"


def estab_table() -> str:
    cols = [f"TRY_CAST({f.name} AS {schemas.sql_type(f.dataType)}) AS {f.name}"
            for f in schemas.SCHEMA_ESTAB_TABLE.fields]
    return f"SELECT {', '.join(cols)} FROM ({estab_treated()}) e"


# --------------------------------------------------------------------------
# PIPE-02 in SQL
# --------------------------------------------------------------------------
def _rule_sql(target: str) -> tuple[str, str]:
    """(SQL expression, kind) of one harmonised links column; kind: int/double/text."""
    money = lambda c: f"TRY_CAST(replace({c}, ',', '.') AS DOUBLE)"
    tr = lambda c, p: f"TRY_CAST(translate({c}, {q(p)}, '-1') AS INTEGER)"
    if target in ("bairros_sp", "bairros_fortaleza", "bairros_rj"):
        return f"CASE WHEN ano <= 2015 THEN {tr(target, '{ñ c')} ELSE {tr(target, '{ñ class}')} END", "int"
    if target == "distritos_sp":
        return tr(target, "{ñ class}"), "int"
    if target == "nacionalidade":
        return tr(target, "{ñ"), "int"
    if target in PAY_COLUMNS:
        return money(target), "double"
    if target == "tempo_emprego":
        return f"replace({target}, ',', '.')", "text"
    if target.startswith("vl_rem_") and target.endswith("_cc"):
        sc = target[:-3] + "_sc"
        return (f"CASE WHEN ano <= 2014 THEN CAST(0 AS DOUBLE) WHEN ano <= 2019 THEN {money(target)} "
                f"ELSE {money(sc)} END"), "double"
    if target == "ano_chegada_brasil":
        return f"CASE WHEN ano <= 2015 THEN '1900' ELSE {target} END", "text"
    if target in ("ind_trab_parcial", "ind_trab_intermitente"):
        return f"CASE WHEN ano <= 2016 THEN '-1' ELSE {target} END", "text"
    if target == "tipo_salario":
        return f"CASE WHEN ano = 2018 THEN {target} ELSE '-1' END", "text"
    if target == "ibge_subsetor":
        return f"CASE WHEN ano <= 2014 THEN '-1' ELSE {target} END", "text"
    if target == "vl_salario_contratual":
        return f"CASE WHEN ano = 2018 THEN {money(target)} ELSE CAST(0 AS DOUBLE) END", "double"
    if target in INT_COLUMNS:
        return f"TRY_CAST({target} AS INTEGER)", "int"
    raise KeyError(target)


RULE_TARGETS = (["bairros_sp", "bairros_fortaleza", "bairros_rj", "distritos_sp", "nacionalidade"] + PAY_COLUMNS
                + ["tempo_emprego"] + [f"vl_rem_{m}_cc" for m in MONTHS]
                + ["ano_chegada_brasil", "ind_trab_parcial", "ind_trab_intermitente", "tipo_salario",
                   "ibge_subsetor", "vl_salario_contratual"] + INT_COLUMNS)


def links_stage1() -> tuple[str, list[str]]:
    """Staging rows in SQL, and the names of its text columns."""
    passthrough = [c for c in LINK_RAW_COLUMNS if c not in RULE_TARGETS and c != "ano"]
    cols = list(passthrough)
    text = list(passthrough)
    for t in RULE_TARGETS:
        e, kind = _rule_sql(t)
        cols.append(f"{e} AS {t}")
        if kind == "text":
            text.append(t)
    cols += [f"{uf_case('substr(municipio, 1, 2)')} AS uf", "ano",
             f"DATE {q(AS_OF)} AS curr_date", f"{q(OWNER)} AS ds_owner"]
    text.append("ds_owner")
    return f"SELECT {', '.join(cols)} FROM ({raw_links()}) r", text


def links_typed(uf: str | None = None) -> str:
    s1, text = links_stage1()
    out = []
    rename = {"tipo_estab41": "tipo_estab", "tipo_estab42": "tipo_estab_dsc"}
    src_of = {v: k for k, v in rename.items()}
    for f in schemas.SCHEMA_LINKS.fields:
        src = src_of.get(f.name, f.name)
        e = decode(src, UNKNOWN_LINKS) if src in text else src
        if f.name == "uf":
            e = "coalesce(uf, 'NI')"
        if f.name == "tempo_emprego":
            e = f"trunc(TRY_CAST({e} AS DOUBLE))"
        out.append(f"TRY_CAST({e} AS {schemas.sql_type(f.dataType)}) AS {f.name}")
    where = f" WHERE coalesce(uf, 'NI') = {q(uf)}" if uf else ""
    return f"SELECT {', '.join(out)} FROM ({s1}) s1{where}"


def comparable(sql: str, fields) -> str:
    cols = []
    for name, dt in fields:
        if dt.startswith("decimal"):
            cols.append(f"CAST({name} AS DOUBLE) AS {name}")
        elif dt == "date":
            cols.append(f"CAST({name} AS VARCHAR) AS {name}")
        else:
            cols.append(name)
    return f"SELECT {', '.join(cols)} FROM ({sql}) c"


LINK_FIELDS = [(f.name, schemas.sql_type(f.dataType)) for f in schemas.SCHEMA_LINKS.fields]


# --------------------------------------------------------------------------
# PIPE-03 in SQL
# --------------------------------------------------------------------------
def gdp_raw() -> str:
    lines = (f"SELECT {', '.join(fx.gdp_line_exprs(D))} FROM lineitem JOIN orders ON l_orderkey = o_orderkey "
             f"JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey "
             f"JOIN region ON n_regionkey = r_regionkey")
    g = (f"SELECT ano, n_nationkey, n_name, r_regionkey, r_name, sum(agro) AS s_agro, sum(ind) AS s_ind, "
         f"sum(serv) AS s_serv, sum(pub) AS s_pub, sum(tax) AS s_tax FROM ({lines}) l "
         f"GROUP BY ano, n_nationkey, n_name, r_regionkey, r_name")
    pop = "SELECT c_nationkey AS n_nationkey, count(*) AS n_pop FROM customer GROUP BY c_nationkey"
    vals = ", ".join(f"{e} AS {n}" for n, e in fx.gdp_value_exprs(D))
    return f"SELECT {vals} FROM ({g}) g LEFT JOIN ({pop}) p USING (n_nationkey)"


GDP_TEXT = ["nome_grande_regiao", "sigla_uf", "nome_uf", "nome_municipio", "atividade_principal_vab",
            "atividade_2_vab", "atividade_3_vab"]


def gdp_treated(conform: bool = True) -> str:
    cols = []
    for f in schemas.SCHEMA_GDP.fields:
        n = f.name
        if n == "curr_date":
            e = q(AS_OF)
        elif n == "ds_owner":
            e = q(OWNER)
        elif n == "atividade_3_vab":
            e = f"CASE WHEN ano < {fx.GDP_VINTAGE_SPLIT} THEN {strip(n)} END"
        elif n in GDP_TEXT:
            e = strip(n)
        else:
            e = n
        cols.append(f"CAST({e} AS {schemas.sql_type(f.dataType)}) AS {n}" if conform else f"{e} AS {n}")
    return f"SELECT {', '.join(cols)} FROM ({gdp_raw()}) g"


# --------------------------------------------------------------------------
# dimensions (SRC-05, PIPE-04)
# --------------------------------------------------------------------------
def dimensions_long() -> str:
    def part(table, sql_code, sql_desc, src):
        return (f"SELECT {q(table)} AS tabela, {strip(sql_code)} AS codigo, {strip(sql_desc)} AS descricao, "
                f"{q(AS_OF)} AS curr_date, {q(OWNER)} AS ds_owner FROM {src}")
    parts = [
        part("TB_RAIS_ESTABREGIAO", "CAST(r_regionkey AS VARCHAR)", "' ' || r_name", "region"),
        part("TB_RAIS_ESTABNACAO", "CAST(n_nationkey AS VARCHAR)", "' ' || n_name", "nation"),
        part("TB_RAIS_ESTABMARCA", "regexp_extract(p_brand, '(\\d+)$', 1)", "' ' || p_brand",
             "(SELECT DISTINCT p_brand FROM part)"),
        part("TB_RAIS_ESTABPRIORIDADE", "split_part(o_orderpriority, '-', 1)", "' ' || o_orderpriority",
             "(SELECT DISTINCT o_orderpriority FROM orders)"),
        part("TB_RAIS_ESTABSEGMENTO", "c_mktsegment", "' ' || c_mktsegment",
             "(SELECT DISTINCT c_mktsegment FROM customer)"),
        part("TB_RAIS_ESTABEVENTO", "event_type", "' ' || event_type", "(SELECT DISTINCT event_type FROM events)"),
    ]
    return " UNION ALL ".join(parts)


# --------------------------------------------------------------------------
# the oracles
# --------------------------------------------------------------------------
def _estab_decoded() -> str:
    cols = []
    for c in ESTAB_RAW_COLUMNS:
        if c == "ano":
            cols.append("ano")
            continue
        e = decode(strip(c))
        if c in ("cnae_2_subclasse", "nat_jur", "tam_estab"):
            e = f"coalesce({e}, '-1')"
        if c == "cnae_2_subclasse":
            e = f"CASE WHEN length({e}) = 6 THEN '0' || {e} ELSE {e} END"
        cols.append(f"{e} AS {c}")
    return f"SELECT {', '.join(cols)} FROM ({estab_stacked()}) s"


def _flag(div: str) -> str:
    return (f"CASE WHEN NOT ({div} IN {in_list(NOT_ENTERPRISE)}) "
            f"AND nat_jur IN {in_list(NATURES)} THEN 1 ELSE 0 END")


def build() -> dict[str, str]:
    e = estab_treated()
    lk = links_typed()
    gdp = gdp_treated()
    stage1, _ = links_stage1()
    div = "lpad(CAST(TRY_CAST(cnae_2_subclasse AS INTEGER) AS VARCHAR), 2, '0')"
    mixed = [*STAGING_VIEW, "tipo_estab41", "tipo_salario", "ind_trab_parcial"]
    staging_view = comparable(f"SELECT {', '.join(STAGING_VIEW)} FROM ({stage1}) s", [
        (n, "date" if n == "curr_date" else "x") for n in STAGING_VIEW])
    o: dict[str, str] = {}

    o["src01_read_cp1252"] = estab_stacked()
    o["src02_read_latin1"] = f"SELECT * FROM ({raw_links()}) r"
    o["src03_duplicate_headers"] = ("SELECT ano, tipo_estab41 AS tipo_estab, tipo_estab42 AS tipo_estab_dsc, "
                                    f"count(*) AS n_linhas FROM ({raw_links()}) r GROUP BY ALL")
    o["src04_load_vintages"] = gdp_treated(conform=False)
    o["src05_load_dimensions"] = dimensions_long()
    o["src06_read_staging"] = f"SELECT * FROM ({staging_view}) v WHERE uf = 'SP'"
    o["src07_select_files"] = f"""
        SELECT doc_id, arquivo,
          coalesce(arquivo = 'RAIS_ESTAB_PUB.7z' OR starts_with(arquivo, 'ESTB') OR starts_with(arquivo, 'Estb'), false)
            AS estab,
          NOT (coalesce(contains(arquivo, 'ESTB'), true) OR coalesce(contains(arquivo, 'ESTAB'), true)
               OR coalesce(contains(arquivo, 'Estb'), true) OR coalesce(contains(arquivo, 'Legado'), true)
               OR coalesce(contains(arquivo, 'Leia'), true)) AS vinculos
        FROM (SELECT doc_id, CASE doc_id % 6 WHEN 0 THEN 'RAIS_ESTAB_PUB.7z' WHEN 1 THEN 'ESTB' || source || '.7z'
              WHEN 2 THEN 'Estb' || source || '.7z' WHEN 3 THEN 'SP' || source || '.7z'
              WHEN 4 THEN 'Leia-me.txt' ELSE source || '_Legado.7z' END AS arquivo FROM documents) d"""
    o["src08_year_slices"] = (f"SELECT ano, count(*) AS n_linhas FROM ({raw_estab()}) r "
                              f"WHERE ano BETWEEN 2011 AND 2014 GROUP BY ano")
    o["src09_incremental"] = f"SELECT * FROM ({raw_estab()}) r"

    o["snk01_append_staging"] = staging_view
    o["snk02_append_table"] = estab_table()
    o["snk03_replace_table"] = f"SELECT count(*) AS n_linhas, count(*) AS n_lido FROM ({gdp}) g"
    o["snk04_range_bucket"] = f"""
        SELECT CAST(CASE WHEN ano BETWEEN 2010 AND 2018 THEN 2010 + 3 * ((ano - 2010) // 3) END AS INTEGER) AS ano_de,
               CAST(CASE WHEN ano BETWEEN 2010 AND 2018 THEN 2010 + 3 * ((ano - 2010) // 3) + 2 END AS INTEGER) AS ano_ate,
               count(*) AS n_linhas
        FROM ({lk}) l GROUP BY ALL"""
    o["snk05_validate"] = f"""
        SELECT ano, uf, count(*) AS n_linhas,
               coalesce(uf IN {in_list([s for _, s in STATES] + ['NI'])}, true) AND coalesce(ano BETWEEN 2010 AND 2019, false) AS aceito
        FROM ({lk}) l GROUP BY ALL"""
    narrow = []
    for i, c in enumerate(schemas.ESTAB_OUTPUT_ORDER):
        if c in P.ESTAB_INT_COLUMNS or c == "ano":
            narrow.append(f"SELECT {i} AS posicao, '{c}' AS coluna, CASE WHEN max({c}) < 32767 THEN 'smallint' "
                          f"WHEN max({c}) < 2147483647 THEN 'int' ELSE 'bigint' END AS tipo FROM ({e}) e")
        else:
            narrow.append(f"SELECT {i} AS posicao, '{c}' AS coluna, 'varchar(' || "
                          f"CAST(greatest(coalesce(max(length({c})), 1), 1) AS VARCHAR) || ')' AS tipo FROM ({e}) e")
    o["snk07_infer_types"] = " UNION ALL ".join(narrow)
    o["snk08_write_dimension"] = dimensions_long()

    gdp_raw_cols = [n for n, _ in fx.gdp_value_exprs(D)]
    o["prj01_drop_rename_gdp"] = (f"SELECT * REPLACE (CASE WHEN ano < {fx.GDP_VINTAGE_SPLIT} THEN atividade_3_vab "
                                  f"END AS atividade_3_vab) FROM (SELECT {', '.join(gdp_raw_cols)} "
                                  f"FROM ({gdp_raw()}) g) g")
    o["prj02_rename_estab"] = estab_stacked()
    accents, base = "áàâãäåéèêëíìîïóòôõöúùûüçñýÿºª", "aaaaaaeeeeiiiiooooouuuucnyyoa"
    head = "' Vl Remun Média ' || p_name || ' (SM)  Ação/' || p_type || '__' || p_brand"
    o["prj03_normalize_header"] = f"""
        SELECT p_partkey, regexp_replace(replace(regexp_replace(translate(lower({head}), '{accents}', '{base}'),
               '[^0-9a-z_]', '_', 'g'), '__', '_'), '^_+|_+$', '', 'g') AS normalizado FROM part"""
    o["prj04_audit"] = (f"SELECT o_orderkey, o_orderstatus, {q(AS_OF)} AS curr_date, {q(OWNER)} AS ds_owner, "
                        f"CAST(year(o_orderdate) + 15 AS INTEGER) AS ano FROM orders")
    o["prj05_harmonize_links"] = f"SELECT * REPLACE (CAST(curr_date AS VARCHAR) AS curr_date) FROM ({stage1}) s"
    o["prj06_harmonize_estab"] = (f"SELECT ano, id_municipio, cnae_2_subclasse, tipo_estab, "
                                  f"CASE WHEN ano < 2014 THEN '-1' ELSE cep END AS cep, "
                                  f"CASE WHEN ano < 2014 THEN '-1' ELSE subsetor_ibge END AS subsetor_ibge "
                                  f"FROM ({estab_stacked()}) s")

    o["flt01_by_uf"] = comparable(
        f"SELECT ano, uf, municipio, vl_remun_dezembro_nom, vinculo_ativo_31_12 FROM ({links_typed('SP')}) l",
        [("ano", "x"), ("uf", "x"), ("municipio", "x"), ("vl_remun_dezembro_nom", "decimal"),
         ("vinculo_ativo_31_12", "x")])
    yt = "CAST(year(o_orderdate) + 15 AS VARCHAR)"
    o["flt02_valid_year"] = f"""
        SELECT o_orderkey, ano_texto, coalesce(regexp_matches(ano_texto, '^20[0-9]{{2}}$'), false) AS valido
        FROM (SELECT o_orderkey, CASE o_orderkey % 5 WHEN 1 THEN substr({yt}, 1, 3) WHEN 2 THEN {yt} || '5'
              WHEN 3 THEN 'abcd' WHEN 4 THEN '19' || substr({yt}, 3, 2) ELSE {yt} END AS ano_texto FROM orders) o"""
    o["flt03_enterprise_flag"] = (f"SELECT {div} AS divisao, nat_jur, {_flag(div)} AS padrao_sebrae, "
                                  f"{_flag('substr(cnae_2_subclasse, 1, 2)')} AS padrao_sebrae_estrito, "
                                  f"count(*) AS n_linhas FROM ({_estab_decoded()}) d GROUP BY ALL")
    o["flt04_is_unknown"] = ("SELECT ano, " + ", ".join(
        f"CAST(sum(CASE WHEN {c} IS NULL OR {c} = -1 THEN 1 ELSE 0 END) AS BIGINT) AS n_{c}"
        for c in ["cnae_2_subclasse", "nat_jur", "tam_estab", "id_municipio"]) + f" FROM ({e}) e GROUP BY ano")

    cn = strip("cnae_2_subclasse")
    pad = f"CASE WHEN length({cn}) = 6 THEN '0' || {cn} ELSE {cn} END"
    ut = "substr(id_municipio, 1, 2)"
    o["scl_codes"] = f"""
        SELECT ano, id_municipio, {strip('cnae_2_classe')} AS classe_limpa, {decode(cn)} AS cnae_decod,
          {pad} AS cnae_pad, lpad(CAST(TRY_CAST({pad} AS INTEGER) AS VARCHAR), 2, '0') AS divisao,
          substr({pad}, 1, 2) AS divisao_estrita, CAST(TRY_CAST(tam_estab AS INTEGER) AS VARCHAR) AS tam_texto,
          coalesce(tam_estab, '-1') AS tam_nulo, concat_ws('', sigla_uf, tam_estab) AS chave,
          {ut} AS uf_texto, TRY_CAST(trunc(TRY_CAST(id_municipio AS DOUBLE) / 10000) AS INTEGER) AS uf_numero,
          {uf_case(ut)} AS uf_sigla, coalesce(CASE WHEN ano = 2013 THEN NULL ELSE {uf_case(ut)} END, 'NI') AS uf_ni,
          {q(AS_OF)} AS curr_date
        FROM ({raw_estab()}) r"""
    o["scl_values"] = f"""
        SELECT ano, municipio,
          TRY_CAST(translate(bairros_rj, '{{ñ c', '-1') AS INTEGER) AS bairro_c,
          TRY_CAST(translate(bairros_rj, '{{ñ class}}', '-1') AS INTEGER) AS bairro_class,
          TRY_CAST(translate(nacionalidade, '{{ñ', '-1') AS INTEGER) AS nacionalidade,
          TRY_CAST(replace(vl_remun_media_nom, ',', '.') AS DOUBLE) AS media_nom,
          CAST(TRY_CAST(replace(vl_remun_dezembro_nom, ',', '.') AS DECIMAL(15,2)) AS DOUBLE) AS dezembro_nom,
          TRY_CAST(trunc(TRY_CAST(replace(tempo_emprego, ',', '.') AS DOUBLE)) AS SMALLINT) AS tempo_emprego,
          TRY_CAST(qtd_dias_afastamento AS SMALLINT) AS dias_afastamento, TRY_CAST(idade AS INTEGER) AS idade
        FROM ({raw_links()}) r"""

    o["lkp01_02_sectors"] = (f"SELECT cnae_2_subclasse, coalesce(a_ibge, '-1') AS setor_ibge, "
                             f"coalesce(a_sebrae, '-1') AS setor_sebrae, count(*) AS n_linhas "
                             f"FROM ({_estab_decoded()}) d LEFT JOIN {activity_values()} ON cnae_2_subclasse = a_code "
                             f"GROUP BY ALL")
    o["lkp03_porte"] = f"SELECT setor_ibge, tam_estab, porte_sebrae, count(*) AS n_linhas FROM ({e}) e GROUP BY ALL"
    uf_vals = dims.values_sql([(int(c), s) for c, s in STATES] + [(99, "NI")], ["u_code", "uf"])
    sectors = f"(SELECT DISTINCT a_ibge, a_sebrae FROM {activity_values()}) s"
    o["lkp04_star_join"] = (f"SELECT ano, uf, a_sebrae AS setor_sebrae_dim, count(*) AS n_linhas, "
                            f"CAST(sum(qtd_vinc_ativos) AS BIGINT) AS estoque FROM ({e}) e "
                            f"LEFT JOIN {uf_vals} ON e.sigla_uf = u_code LEFT JOIN {sectors} ON e.setor_ibge = a_ibge "
                            f"GROUP BY ALL")
    o["lkp04_orphans"] = (f"SELECT cnae_2_subclasse, count(*) AS n_linhas FROM ({_estab_decoded()}) d "
                          f"WHERE cnae_2_subclasse IS NULL OR cnae_2_subclasse NOT IN "
                          f"(SELECT a_code FROM {activity_values()}) GROUP BY ALL")

    o["agg01_n_rows"] = f"SELECT count(*) AS n_linhas FROM ({e}) e"
    o["agg02_total"] = f"SELECT CAST(sum(qtd_vinc_ativos) AS BIGINT) AS total_qtd_vinc_ativos FROM ({e}) e"
    o["agg03_by_uf"] = (f"SELECT sigla_uf, CAST(sum(qtd_vinc_ativos) AS BIGINT) AS soma_vinc_ativos, "
                        f"count(id_municipio) AS n_municipio FROM ({e}) e GROUP BY sigla_uf")
    o["agg04_null_profile"] = " UNION ALL ".join(
        f"SELECT '{c}' AS coluna, CAST(sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_nulos "
        f"FROM ({raw_estab()}) r" for c in ESTAB_RAW_COLUMNS)
    o["agg05_sentinel_profile"] = " UNION ALL ".join(
        f"SELECT '{c}' AS coluna, CAST(sum(CASE WHEN {c} = -1 THEN 1 ELSE 0 END) AS BIGINT) AS n_menos_um FROM ({e}) e"
        for c in schemas.ESTAB_OUTPUT_ORDER if c in P.ESTAB_INT_COLUMNS or c == "ano")
    o["agg06_column_profile"] = " UNION ALL ".join(
        f"SELECT '{c}' AS coluna, CAST(max({c}) AS VARCHAR) AS max_valor, "
        f"CAST(max(length(CAST({c} AS VARCHAR))) AS BIGINT) AS max_len, "
        f"CAST(count(DISTINCT {c}) AS BIGINT) AS n_distintos FROM ({e}) e"
        for c in ["sigla_uf", "nat_jur", "cnae_2_subclasse", "setor_ibge", "porte_sebrae", "cep"])

    act = f"SELECT *, cbo_ocupacao_2002 // 100000 AS cbo_grande_grupo FROM ({lk}) l WHERE vinculo_ativo_31_12 = 1"
    o["qry01_headcount"] = f"""
        SELECT ano, CASE WHEN GROUPING(uf) = 0 THEN 'uf' WHEN GROUPING(ibge_subsetor) = 0 THEN 'setor'
                         WHEN GROUPING(cbo_grande_grupo) = 0 THEN 'ocupacao' END AS nivel,
               uf, ibge_subsetor, CAST(cbo_grande_grupo AS INTEGER) AS cbo_grande_grupo,
               faixa_etaria, escolaridade_apos_2005, sexo_trabalhador, count(*) AS n_vinculos
        FROM ({act}) a
        GROUP BY GROUPING SETS ((ano, uf, faixa_etaria, escolaridade_apos_2005, sexo_trabalhador),
                                (ano, ibge_subsetor, faixa_etaria, escolaridade_apos_2005, sexo_trabalhador),
                                (ano, cbo_grande_grupo, faixa_etaria, escolaridade_apos_2005, sexo_trabalhador))"""
    o["qry02_headcount_by_size"] = (f"SELECT ano, tamanho_estabelecimento, ibge_subsetor, "
                                    f"CAST(sum(CASE WHEN vinculo_ativo_31_12 = 1 THEN 1 ELSE 0 END) AS BIGINT) "
                                    f"AS n_ativos, count(*) AS n_vinculos FROM ({lk}) l GROUP BY ALL")
    o["qry03_mean_pay"] = f"""
        SELECT ano, uf, CAST(cbo_grande_grupo AS INTEGER) AS cbo_grande_grupo, ibge_subsetor, count(*) AS n_vinculos,
               CASE WHEN count(c) > 0 THEN CAST(sum(c) AS DOUBLE) / CAST(count(c) AS DOUBLE) / CAST(100 AS DOUBLE) END AS remun_media
        FROM (SELECT *, CAST(vl_remun_dezembro_nom * 100 AS BIGINT) AS c FROM ({act}) a) a
        GROUP BY ano, uf, cbo_grande_grupo, ibge_subsetor"""
    bd = BREAKDOWN
    o["qry04_estab_breakdown"] = " UNION ALL ".join(
        f"SELECT ano, '{d}' AS dimensao, CAST({d} AS VARCHAR) AS valor, count(*) AS n_estab, "
        f"CAST(sum(qtd_vinc_ativos) AS BIGINT) AS estoque FROM ({e}) e GROUP BY ano, {d}" for d in bd)
    def growth(g: str) -> str:
        return f"""
        SELECT g.ano, g.id_municipio, g.pib_corrente, p.pib_corrente AS pib_anterior,
               CASE WHEN p.pib_corrente > 0 THEN g.pib_corrente / p.pib_corrente - CAST(1 AS DOUBLE) END AS crescimento
        FROM ({g}) g LEFT JOIN ({g}) p ON p.id_municipio = g.id_municipio AND p.ano = g.ano - 1"""
    o["qry05_gdp_growth"] = growth(gdp)
    o["qry05_gdp_growth_gap"] = growth(f"SELECT * FROM ({gdp}) x WHERE ano <> 2010")
    o["qry06_gdp_rank"] = f"""
        SELECT ano, id_municipio, pib_corrente,
               CAST(rank() OVER (PARTITION BY ano ORDER BY pib_corrente DESC) AS INTEGER) AS posicao,
               round(pib_corrente / sum(pib_corrente) OVER (PARTITION BY ano), 8) AS participacao
        FROM ({gdp}) g"""
    o["qry07_gdp_per_capita"] = f"""
        SELECT ano, id_municipio, pib_corrente, populacao + ano - 2000 AS populacao,
               CASE WHEN populacao + ano - 2000 > 0 THEN pib_corrente * CAST(1000 AS DOUBLE) / CAST(populacao + ano - 2000 AS DOUBLE) END AS pib_per_capita
        FROM ({gdp}) g LEFT JOIN (SELECT CAST(c_nationkey + 11 AS BIGINT) AS k, count(*) AS populacao
                                 FROM customer GROUP BY c_nationkey) p ON g.codigo_uf = p.k"""
    o["srt02_preview"] = (f"SELECT ano, sigla_uf, id_municipio, pib_corrente FROM ({gdp}) g "
                          f"ORDER BY ano, sigla_uf, id_municipio LIMIT 5")
    o["estab_standardize"] = e
    o["estab_table"] = estab_table()
    o["estab_load"] = f"SELECT * FROM ({estab_table()}) t WHERE ano BETWEEN 2010 AND 2027"
    o["links_standardize"] = comparable(lk, LINK_FIELDS)
    o["links_load"] = comparable(lk, LINK_FIELDS)
    o["gdp_standardize"] = gdp
    o["set02_two_files_one_year"] = comparable(lk, LINK_FIELDS)
    o["estab_two_files"] = o["estab_load"]
    o["gdp_load_text"] = gdp
    o["src02_mixed_vintages"] = comparable(f"SELECT {', '.join(mixed)} FROM ({stage1}) s", [(n, "date" if n == "curr_date" else "x") for n in mixed])
    o["gdp_load"] = f"SELECT *, count(*) OVER () AS n_lido FROM ({gdp}) g"
    whole = "bool_and(regexp_full_match({c}, '-?(0|[1-9][0-9]*)'))"
    o["dimensions_build"] = " UNION ALL ".join(
        f"SELECT tabela, '{c}' AS coluna, CASE WHEN {whole.format(c=c)} THEN CASE WHEN max(TRY_CAST({c} AS BIGINT)) < 32767 THEN 'smallint' "
        f"WHEN max(TRY_CAST({c} AS BIGINT)) < 2147483647 THEN 'int' ELSE 'bigint' END "
        f"ELSE 'varchar(' || CAST(max(length({c})) AS VARCHAR) || ')' END AS tipo, count(*) AS n_linhas FROM ({dimensions_long()}) d GROUP BY tabela"
        for c in ("codigo", "descricao", "curr_date", "ds_owner"))
    later_rounds(o, lk, gdp)
    return o


def later_rounds(o: dict[str, str], lk: str, gdp: str) -> None:
    """Queries over versioned tables: what is in them after all loads."""
    o["src01_malformed"] = f"""
        SELECT chave, situacao, CASE WHEN curto THEN NULL ELSE prioridade END AS prioridade,
               CASE WHEN curto THEN concat_ws(';', chave, situacao) WHEN longo THEN concat_ws(';', chave, situacao, prioridade, 'x') END AS registro_invalido,
               true AS com_arquivo
        FROM (SELECT CAST(o_orderkey AS VARCHAR) AS chave, o_orderstatus AS situacao, o_orderpriority AS prioridade, o_orderkey % 101 = 0 AS longo,
                     o_orderkey % 97 = 0 AND o_orderkey % 101 <> 0 AS curto FROM orders) s"""
    per_year = {y: sum(fx.in_vintage(fx.LINK_HEADERS[n], y) for n in LINK_RAW_COLUMNS if n != "ano") for y in range(2014, 2021)}
    o["src02_file_headers"] = " UNION ALL ".join(f"SELECT {y} AS ano, {n} AS n_colunas" for y, n in per_year.items())
    o["src09_stream_mixed"] = comparable(lk, LINK_FIELDS)
    o["snk03_replace_from_itself"] = f"SELECT * FROM ({gdp}) g WHERE ano <> 2010"
    kinds = {"codigo": ["CAST(p_partkey % 1000 AS VARCHAR)", "CAST(p_partkey + 100000 AS VARCHAR)", "'P' || p_partkey"],
             "descricao": ["p_brand", "p_type", "CAST(p_partkey + 3000000000 AS VARCHAR)"]}
    sheet = " UNION ALL ".join(f"SELECT {i + 1} AS carga, {kinds['codigo'][i]} AS codigo, {kinds['descricao'][i]} AS descricao FROM part WHERE p_partkey % 3 = {i}" for i in range(3))
    o["snk07_widening"] = f"""
        SELECT n AS carga, CASE n WHEN 1 THEN 'smallint' WHEN 2 THEN 'int' ELSE 'varchar(' || greatest(11, max(length(codigo))) || ')' END AS tipo_codigo,
               'varchar(' || greatest(max(length(descricao)) FILTER (WHERE carga < 3), CASE n WHEN 3 THEN 20 ELSE 0 END) || ')' AS tipo_descricao,
               count(*) AS n_linhas, CAST(max(length(codigo)) AS INTEGER) AS max_len
        FROM ({sheet}) s JOIN (SELECT unnest([1, 2, 3]) AS n) k ON carga <= n GROUP BY n"""
    t = estab_table()
    ints = [f.name for f in schemas.SCHEMA_ESTAB_TABLE.fields if schemas.sql_type(f.dataType) in ("smallint", "int")]
    parts = ["SELECT 'linhas' AS medida, '' AS coluna, count(*) AS valor FROM t", "SELECT 'total', 'qtd_vinc_ativos', sum(qtd_vinc_ativos) FROM t"]
    parts += [f"SELECT 'nulos', '{f.name}', count(*) FILTER (WHERE {f.name} IS NULL) FROM t" for f in schemas.SCHEMA_ESTAB_TABLE.fields]
    parts += [f"SELECT 'menos_um', '{c}', count(*) FILTER (WHERE {c} = -1) FROM t" for c in ints]
    for code, letters in STATES:
        parts += [f"SELECT 'linhas_uf', '{letters}', count(*) FILTER (WHERE sigla_uf = {int(code)}) FROM t",
                  f"SELECT 'total_uf', '{letters}', coalesce(sum(qtd_vinc_ativos) FILTER (WHERE sigla_uf = {int(code)}), 0) FROM t"]
    o["agg05_load_report"] = f"WITH t AS MATERIALIZED (SELECT * FROM ({t}) e WHERE ano BETWEEN 2010 AND 2027) SELECT medida, coluna, CAST(valor AS BIGINT) AS valor FROM ({' UNION ALL '.join(parts)}) u"
    o["agg06_profile_by_year"] = f"WITH t AS MATERIALIZED (SELECT * FROM ({t}) e WHERE ano BETWEEN 2010 AND 2027) " + " UNION ALL ".join(
        f"SELECT '{c}' AS coluna, CAST(max({c}) AS VARCHAR) AS max_valor, CAST(max(length(CAST({c} AS VARCHAR))) AS BIGINT) AS max_len, count(DISTINCT {c}) AS n_distintos FROM t" for c in PROFILED)
    o["set02_corrected_file"] = comparable(f"SELECT * FROM ({lk}) l WHERE NOT (ano = 2018 AND uf = 'RO')", LINK_FIELDS)
    o["set02_load_made_up"] = comparable(lk, LINK_FIELDS)
    reloaded = f"(SELECT * FROM ({lk}) l WHERE NOT (ano = 2018 AND uf = 'SP') OR sexo_trabalhador = 1)"
    o["qry01_headcount_mart"] = o["qry01_headcount"].replace(f"({lk})", reloaded)
    o["qry04_breakdown_mart"] = o["qry04_estab_breakdown"].replace(f"({estab_treated()})", f"({t})")
    o["snk05_place_lookup"] = comparable(f"SELECT * FROM ({lk}) l WHERE uf = 'SP' AND municipio = (SELECT min(municipio) FROM ({lk}) m WHERE uf = 'SP')", LINK_FIELDS)


_CACHE: dict[str, str] | None = None


def oracle_sql() -> dict[str, str]:
    global _CACHE
    if _CACHE is None:
        _CACHE = build()
    return dict(_CACHE)
