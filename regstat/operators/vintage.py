"""Vintage harmonisation as a data-driven rule table: PRJ-05 (links), PRJ-06 (establishments).

The year is a *column*, so every vintage of a layout is harmonised by one
``select`` in one job (no branch per year, no loop per file).  Each target
column has a list of rules ``(first_year, last_year, producer)``; the rule
list compiles into one ``CASE WHEN ano ...`` expression.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..schemas import ESTAB_HEADERS, ESTAB_MAY_LACK, LINKS_MAY_LACK, SCHEMA_LINKS, require
from .shape import disambiguation_map, qcol

MIN_YEAR, MAX_YEAR = 0, 9999
# The establishment layout switches once, at 2014.
ESTAB_SWITCH_YEAR = 2014
#: Columns of the links table that the flow itself makes.
MADE = {"uf", "ano", "curr_date", "ds_owner"}


@dataclass(frozen=True)
class Rule:
    first: int
    last: int
    kind: str          # translate | double | dot_text | int | src | lit_str | lit_double
    source: str | None = None
    arg: str | None = None


def _src(df_cols: set[str], name: str | None) -> Column:
    """The source column; NULL for one that its layout may lack (callers check)."""
    return qcol(name) if name in df_cols else F.lit(None).cast("string")


def _produce(rule: Rule, df_cols: set[str]) -> Column:
    s = _src(df_cols, rule.source)
    if rule.kind == "translate":
        return C.translate_sentinel(s, rule.arg)
    if rule.kind == "double":
        return C.comma_to_double(s)
    if rule.kind == "dot_text":
        return C.comma_to_dot(s)
    if rule.kind == "int":
        return s.try_cast("int")
    if rule.kind == "src":
        return s
    if rule.kind == "lit_str":
        return F.lit(rule.arg)
    if rule.kind == "lit_double":
        return F.lit(float(rule.arg))
    raise ValueError(rule.kind)


def compile_rules(rules: list[Rule], year: Column, df_cols: set[str], _conds: dict | None = None) -> Column:
    """One CASE over the year; a rule covering every year is the ELSE branch."""
    conds = {} if _conds is None else _conds
    expr = None
    for r in rules:
        v = _produce(r, df_cols)
        if r.first <= MIN_YEAR and r.last >= MAX_YEAR:
            return v if expr is None else expr.otherwise(v)
        key = (r.first, r.last)
        if key not in conds:
            conds[key] = (year <= r.last if r.first <= MIN_YEAR
                          else year >= r.first if r.last >= MAX_YEAR else year.between(r.first, r.last))
        expr = F.when(conds[key], v) if expr is None else expr.when(conds[key], v)
    return expr


# Months of the monthly-pay columns (11, December has its own columns).
MONTHS = ["janeiro", "fevereiro", "marco", "abril", "maio", "junho", "julho", "agosto",
          "setembro", "outubro", "novembro"]
PAY_COLUMNS = ["vl_remun_dezembro_nom", "vl_remun_dezembro_sm", "vl_remun_media_nom", "vl_remun_media_sm"]
INT_COLUMNS = ["vinculo_ativo_31_12", "qtd_hora_contr", "idade", "mes_admissao",
               "mes_desligamento", "qtd_dias_afastamento"]


def _all(kind, source=None, arg=None):
    return [Rule(MIN_YEAR, MAX_YEAR, kind, source, arg)]


def links_rules() -> dict[str, list[Rule]]:
    """Appendix A of the blueprint as data (year ranges inclusive)."""
    rules: dict[str, list[Rule]] = {}
    for c in ["bairros_sp", "bairros_fortaleza", "bairros_rj"]:
        rules[c] = [Rule(MIN_YEAR, 2015, "translate", c, "{ñ c"),
                    Rule(2016, MAX_YEAR, "translate", c, "{ñ class}")]
    rules["distritos_sp"] = _all("translate", "distritos_sp", "{ñ class}")
    rules["nacionalidade"] = _all("translate", "nacionalidade", "{ñ")
    for c in PAY_COLUMNS:
        rules[c] = _all("double", c)
    rules["tempo_emprego"] = _all("dot_text", "tempo_emprego")
    for m in MONTHS:
        rules[f"vl_rem_{m}_cc"] = [Rule(MIN_YEAR, 2014, "lit_double", arg="0"),
                                   Rule(2015, 2019, "double", f"vl_rem_{m}_cc"),
                                   Rule(2020, MAX_YEAR, "double", f"vl_rem_{m}_sc")]
    rules["ano_chegada_brasil"] = [Rule(MIN_YEAR, 2015, "lit_str", arg="1900"),
                                   Rule(2016, MAX_YEAR, "src", "ano_chegada_brasil")]
    for c in ["ind_trab_parcial", "ind_trab_intermitente"]:
        rules[c] = [Rule(MIN_YEAR, 2016, "lit_str", arg="-1"), Rule(2017, MAX_YEAR, "src", c)]
    rules["tipo_salario"] = [Rule(2018, 2018, "src", "tipo_salario"),
                             Rule(MIN_YEAR, MAX_YEAR, "lit_str", arg="-1")]
    rules["ibge_subsetor"] = [Rule(MIN_YEAR, 2014, "lit_str", arg="-1"),
                              Rule(2015, MAX_YEAR, "src", "ibge_subsetor")]
    rules["vl_salario_contratual"] = [Rule(2018, 2018, "double", "vl_salario_contratual"),
                                      Rule(MIN_YEAR, MAX_YEAR, "lit_double", arg="0")]
    for c in INT_COLUMNS:
        rules[c] = _all("int", c)
    return rules


def links_sources(years: Iterable[int]) -> set[str]:
    """Raw columns that the rules of some years read."""
    return {r.source for some in links_rules().values() for r in some if r.source and any(r.first <= y <= r.last for y in years)}


def check_links(columns: Sequence[str], years: Iterable[int]) -> None:
    """Refuse a header group that lacks a column of its own years (or one that no year may lack)."""
    always = {r.source for some in links_rules().values() for r in some if r.source} - set(LINKS_MAY_LACK)
    need = always | links_sources(years) | ({f for f in SCHEMA_LINKS.fieldNames()} - set(links_rules()) - MADE)
    copies = disambiguation_map(columns, {"tipo_estab": ["tipo_estab", "tipo_estab_dsc"]})
    missing = sorted(need - {copies.get(c, c) for c in columns})
    if missing:
        raise ValueError(f"columns not found for the years {sorted(years)}: {missing}")


def check_estab(columns: Sequence[str], years: Iterable[int]) -> None:
    """The same for establishments: from the switch on, no column may be absent."""
    need = set(ESTAB_HEADERS.values()) - {"ctg_tipo_estab", "sigla_uf"} - (set() if any(y >= ESTAB_SWITCH_YEAR for y in years) else set(ESTAB_MAY_LACK))
    missing = sorted(need - set(columns))
    if missing:
        raise ValueError(f"columns not found for the years {sorted(years)}: {missing}")


def harmonize_links(df: DataFrame, ano="ano") -> DataFrame:
    """PRJ-05: every link vintage → one layout, in one projection.

    ``ano`` is a column name or Column (the year of the file each row came
    from), so a frame that stacks several years is harmonised at once.
    """
    year = qcol(ano) if isinstance(ano, str) else ano
    cols = set(df.columns)
    rules = links_rules()
    require({r.source for some in rules.values() for r in some if r.source}, cols, LINKS_MAY_LACK)
    out = [qcol(c) for c in df.columns if c not in rules]
    conds: dict = {}
    out += [compile_rules(r, year, cols, conds).alias(t) for t, r in rules.items()]
    return df.select(out)


def estab_fixed(source: Mapping[str, Column], year: Column) -> dict[str, Column]:
    """The columns that the layouts before the switch fix at -1, from their raw columns."""
    return {c: F.when(year < ESTAB_SWITCH_YEAR, F.lit("-1")).otherwise(source[c]) for c in ESTAB_MAY_LACK}


def harmonize_estab(df: DataFrame, ano="ano") -> DataFrame:
    """PRJ-06: before 2014 ``cep`` and ``subsetor_ibge`` are -1 (even when present);
    from 2014 the type description column is dropped."""
    year = qcol(ano) if isinstance(ano, str) else ano
    cols = set(df.columns)
    fixed = estab_fixed({c: _src(cols, c) for c in ESTAB_MAY_LACK}, year)
    out = [qcol(c) for c in df.columns if c not in fixed and c != "ctg_tipo_estab"]
    out += [v.alias(k) for k, v in fixed.items()]
    return df.select(out)
