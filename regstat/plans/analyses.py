"""QRY-01..07: the analyses the registers are loaded for.

Aggregations use partial (map-side) aggregation, so a hot state or sector
is pre-aggregated inside each task before the shuffle; the breakdowns use
grouping sets so several breakdowns come from one pass.  Money is summed
as integer cents (exact), and means are one IEEE division of exact totals.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DEMOGRAPHICS = ["faixa_etaria", "escolaridade_apos_2005", "sexo_trabalhador"]


def _cbo_group(df: DataFrame) -> DataFrame:
    return df.withColumn("cbo_grande_grupo", (F.col("cbo_ocupacao_2002") / F.lit(100000)).cast("int"))


def _active(df: DataFrame) -> DataFrame:
    return df.filter(F.col("vinculo_ativo_31_12") == 1)


# --- QRY-01 ---------------------------------------------------------------
def headcount(links: DataFrame) -> DataFrame:
    """Jobs active at 31/12 by age band, schooling and sex, for each of
    geography (state), sector (IBGE subsector) and occupation (CBO major group)."""
    df = _cbo_group(_active(links))
    levels = {"uf": "uf", "setor": "ibge_subsetor", "ocupacao": "cbo_grande_grupo"}
    sets = [["ano", col, *DEMOGRAPHICS] for col in levels.values()]
    keys = ["ano", *levels.values(), *DEMOGRAPHICS]
    agg = df.groupingSets(sets, *keys).agg(
        F.count(F.lit(1)).alias("n_vinculos"),
        *[F.grouping(c).alias(f"g_{name}") for name, c in levels.items()],
    )
    nivel = None
    for name in levels:
        cond = F.col(f"g_{name}") == 0
        nivel = F.when(cond, F.lit(name)) if nivel is None else nivel.when(cond, F.lit(name))
    return agg.select("ano", nivel.alias("nivel"), *levels.values(), *DEMOGRAPHICS, "n_vinculos")


# --- QRY-02 ---------------------------------------------------------------
def headcount_by_size(links: DataFrame) -> DataFrame:
    return links.groupBy("ano", "tamanho_estabelecimento", "ibge_subsetor").agg(
        F.sum(F.when(F.col("vinculo_ativo_31_12") == 1, 1).otherwise(0)).cast("bigint").alias("n_ativos"),
        F.count(F.lit(1)).alias("n_vinculos"),
    )


# --- QRY-03 ---------------------------------------------------------------
def mean_pay(links: DataFrame) -> DataFrame:
    """Mean December pay of jobs active at 31/12 by state, occupation group and sector."""
    df = _cbo_group(_active(links))
    cents = (F.col("vl_remun_dezembro_nom") * 100).cast("bigint")
    agg = df.groupBy("ano", "uf", "cbo_grande_grupo", "ibge_subsetor").agg(
        F.sum(cents).alias("soma_centavos"), F.count(cents).alias("n_com_valor"),
        F.count(F.lit(1)).alias("n_vinculos"))
    mean = F.col("soma_centavos").cast("double") / F.col("n_com_valor").cast("double") / F.lit(100.0)
    return agg.select("ano", "uf", "cbo_grande_grupo", "ibge_subsetor", "n_vinculos",
                      F.when(F.col("n_com_valor") > 0, mean).alias("remun_media"))


# --- QRY-04 ---------------------------------------------------------------
BREAKDOWN = ["sigla_uf", "setor_ibge", "nat_jur", "tam_estab", "ind_rais_negativa"]


def estab_breakdown(estab: DataFrame, dims=BREAKDOWN) -> DataFrame:
    """Establishments and stock of jobs per year by each dimension, one pass
    (GROUPING SETS), as a long table (ano, dimensao, valor, n_estab, estoque)."""
    dims = list(dims)
    agg = estab.groupingSets([["ano", d] for d in dims], "ano", *dims).agg(
        F.count(F.lit(1)).alias("n_estab"),
        F.sum("qtd_vinc_ativos").cast("bigint").alias("estoque"),
        *[F.grouping(d).alias(f"g{i}") for i, d in enumerate(dims)],
    )
    dimensao = valor = None
    for i, d in enumerate(dims):
        cond = F.col(f"g{i}") == 0
        v = F.col(d).cast("string")
        dimensao = F.when(cond, F.lit(d)) if dimensao is None else dimensao.when(cond, F.lit(d))
        valor = F.when(cond, v) if valor is None else valor.when(cond, v)
    return agg.select("ano", dimensao.alias("dimensao"), valor.alias("valor"), "n_estab", "estoque")


# --- QRY-05 ---------------------------------------------------------------
def gdp_growth(gdp: DataFrame) -> DataFrame:
    """Year-on-year GDP growth per place; without the year before there is none.

    The window is partitioned by place, so it scales with the number of
    places, one short series each.
    """
    w = Window.partitionBy("id_municipio").orderBy("ano")
    prev = F.when(F.lag("ano").over(w) == F.col("ano") - 1, F.lag("pib_corrente").over(w))
    return gdp.select(
        "ano", "id_municipio", "pib_corrente", prev.alias("pib_anterior"),
        F.when(prev > 0, F.col("pib_corrente") / prev - F.lit(1.0)).alias("crescimento"),
    )


# --- QRY-06 ---------------------------------------------------------------
def gdp_rank(gdp: DataFrame, share_digits: int = 8) -> DataFrame:
    """Rank of each place's GDP within its year and its share of the year's total.

    The total is a partial aggregation joined back; the rank's window holds
    the places of one year, whose number the country bounds.
    """
    by_year = Window.partitionBy("ano").orderBy(F.col("pib_corrente").desc())
    total = gdp.groupBy("ano").agg(F.sum("pib_corrente").alias("total"))
    return gdp.join(total, "ano").select(
        "ano", "id_municipio", "pib_corrente",
        F.rank().over(by_year).alias("posicao"),
        F.round(F.try_divide(F.col("pib_corrente"), F.col("total")), share_digits).alias("participacao"),   # a zero total gives NULL, not an error
    )


# --- QRY-07 ---------------------------------------------------------------
def gdp_per_capita(gdp: DataFrame, pop: DataFrame, key: Sequence[str] = ("id_municipio", "ano")) -> DataFrame:
    """GDP (R$ 1.000) per inhabitant in R$: × 1000 / population, NULL without population.

    ``pop`` has one row per place and year; two rows of one key are an error, not two results.
    """
    key = list(key)
    if pop.groupBy(*key).count().filter("count > 1").limit(1).count():
        raise ValueError(f"population has several rows for one {key}")
    df = gdp.join(pop.select(*key, "populacao"), on=key, how="left")
    per_head = F.col("pib_corrente") * F.lit(1000.0) / F.col("populacao").cast("double")
    return df.select("ano", "id_municipio", "pib_corrente", "populacao",
                     F.when(F.col("populacao") > 0, per_head).alias("pib_per_capita"))
