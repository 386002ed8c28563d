"""Code dimensions as small DataFrames (broadcast on join, never a UDF closure).

Everything here is bounded by a code list (27 states, ~1.4k activity codes,
99 size keys), so these frames have a proven size bound.  The activity
dimension is built from a rule (division → sector, plus listed exceptions)
applied to a list of known codes the caller supplies — the official
subclass list in production, a rule-generated list in fixtures.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# IBGE state code → two-letter state; 99 and anything unknown → NI.
UF_CODES = [
    ("11", "RO"), ("12", "AC"), ("13", "AM"), ("14", "RR"), ("15", "PA"), ("16", "AP"),
    ("17", "TO"), ("21", "MA"), ("22", "PI"), ("23", "CE"), ("24", "RN"), ("25", "PB"),
    ("26", "PE"), ("27", "AL"), ("28", "SE"), ("29", "BA"), ("31", "MG"), ("32", "ES"),
    ("33", "RJ"), ("35", "SP"), ("41", "PR"), ("42", "SC"), ("43", "RS"), ("50", "MS"),
    ("51", "MT"), ("52", "GO"), ("53", "DF"),
]
UF_UNKNOWN = "NI"
# The 28 accepted state values of the links table (27 + NI).
UF_VALID = ["AC", "AL", "AM", "AP", "BA", "CE", "DF", "ES", "GO", "MA", "MG", "MS", "MT",
            "PA", "PB", "PE", "PI", "PR", "RJ", "RN", "RO", "RR", "RS", "SC", "SE", "SP",
            "TO", "NI"]

# IBGE economic sectors and the SEBRAE sector each one maps to.
AGRO = "Agropecuária, Extração Vegetal, Caça e Pesca"
EXTRATIVA = "Extrativa Mineral"
TRANSFORMACAO = "Indústria de Transformação"
SIUP = "Serviços Industriais de Utilidade Pública"
CONSTRUCAO = "Construção Civil"
COMERCIO = "Comércio"
SERVICOS = "Serviços"
ADM_PUBLICA = "Administração Pública"
UNKNOWN = "-1"
SEBRAE_SECTOR = {
    AGRO: "Agropecuária",
    EXTRATIVA: "Indústria",
    TRANSFORMACAO: "Indústria",
    SIUP: "Indústria",
    CONSTRUCAO: "Construção Civil",
    COMERCIO: "Comércio",
    SERVICOS: "Serviços",
    ADM_PUBLICA: "Administração Pública",
    UNKNOWN: UNKNOWN,
}

# CNAE 2.0 division ranges (inclusive) → IBGE sector.
DIVISION_SECTOR = [
    ((1, 3), AGRO),
    ((5, 9), EXTRATIVA),
    ((10, 33), TRANSFORMACAO),
    ((35, 39), SIUP),
    ((40, 41), SERVICOS),
    ((42, 43), CONSTRUCAO),
    ((45, 47), COMERCIO),
    ((49, 53), SERVICOS),
    ((55, 56), SERVICOS),
    ((58, 59), TRANSFORMACAO),
    ((60, 66), SERVICOS),
    ((68, 75), SERVICOS),
    ((77, 82), SERVICOS),
    ((84, 84), ADM_PUBLICA),
    ((85, 88), SERVICOS),
    ((90, 94), SERVICOS),
    ((95, 95), COMERCIO),
    ((96, 97), SERVICOS),
    ((99, 99), UNKNOWN),
]

# Subclasses whose sector differs from their division's.
SECTOR_EXCEPTIONS = {
    "0230600": SERVICOS,
    "3103900": SERVICOS,
    "3313999": SERVICOS,
    "3314709": SERVICOS,
    "3316302": SERVICOS,
    "3600602": COMERCIO,
    "3831901": TRANSFORMACAO,
    "3831999": TRANSFORMACAO,
    "3832700": TRANSFORMACAO,
    "3839499": TRANSFORMACAO,
    "4120400": CONSTRUCAO,
    "5229002": COMERCIO,
    "5620101": TRANSFORMACAO,
    "5620102": TRANSFORMACAO,
    "5620104": TRANSFORMACAO,
    "5913800": SERVICOS,
    "5914600": SERVICOS,
    "8130300": AGRO,
    "8430200": SERVICOS,
    "9511800": SERVICOS,
    "9900800": SERVICOS,
}
# Codes that are listed and map to the unknown sector.
UNKNOWN_CODES = ["9999999", "9999997", "-1"]

# Size classes by sector group (size code 1..10; -1 is unknown).
_TRADE_SERVICES = [(1, 3, "Micro"), (4, 5, "Pequena"), (6, 6, "Média"), (7, 10, "Grande")]
_INDUSTRY = [(1, 4, "Micro"), (5, 6, "Pequena"), (7, 8, "Média"), (9, 10, "Grande")]
SIZE_RULES = {
    AGRO: [(1, 5, "M/P"), (6, 10, "M/G")],
    COMERCIO: _TRADE_SERVICES,
    SERVICOS: _TRADE_SERVICES,
    CONSTRUCAO: _INDUSTRY,
    EXTRATIVA: _INDUSTRY,
    TRANSFORMACAO: _INDUSTRY,
    SIUP: _INDUSTRY,
    ADM_PUBLICA: [(1, 10, "Não se aplica")],
    UNKNOWN: [(1, 10, UNKNOWN)],
}
# Class of the unknown size (-1) per sector.
SIZE_UNKNOWN_CLASS = {ADM_PUBLICA: "Não se aplica"}

# Legal natures that count as an enterprise, and divisions that never do.
ENTERPRISE_NATURES = ["2046", "2054", "2062", "2135", "2232", "2240", "2259", "2267",
                      "2283", "2291", "2305", "2313", "2321", "2330", "2348", "4014",
                      "4022", "4081", "4111", "4120"]
NON_ENTERPRISE_DIVISIONS = ["84", "94", "99"]


def bounded(df: DataFrame, rows: int | None) -> DataFrame:
    """Record an upper bound of ``df``'s row count (known by construction)."""
    if rows is not None:
        df._regstat_rows = rows  # type: ignore[attr-defined]
    return df


def row_bound(df: DataFrame) -> int | None:
    return getattr(df, "_regstat_rows", None)


def sector_of(code: str) -> str:
    """IBGE sector of one listed subclass code (rule + exceptions)."""
    if code in SECTOR_EXCEPTIONS:
        return SECTOR_EXCEPTIONS[code]
    if code in UNKNOWN_CODES:
        return UNKNOWN
    division = int(code[:2])
    for (lo, hi), sector in DIVISION_SECTOR:
        if lo <= division <= hi:
            return sector
    return UNKNOWN


def activity_rows(codes: Iterable[str]) -> list[tuple[str, str, str]]:
    """(cnae_2_subclasse, setor_ibge, setor_sebrae) for each known code."""
    rows = {}
    for code in list(codes) + UNKNOWN_CODES:
        sector = sector_of(code)
        rows[code] = (code, sector, SEBRAE_SECTOR[sector])
    return sorted(rows.values())


ACTIVITY_SCHEMA = T.StructType([
    T.StructField("cnae_2_subclasse", T.StringType(), False),
    T.StructField("setor_ibge", T.StringType(), False),
    T.StructField("setor_sebrae", T.StringType(), False),
])


def activity_dimension(spark: SparkSession, codes: Iterable[str] | DataFrame) -> DataFrame:
    """LKP-01/02 dimension from the list of known 7-digit codes.

    ``codes`` may be a DataFrame with a ``cnae_2_subclasse`` column (the
    official list loaded as a dimension); the rule then runs in Spark.
    """
    if isinstance(codes, DataFrame):
        from .functions.columns import pad_cnae, sector_from_code

        from pyspark.sql import functions as F

        listed = codes.select(pad_cnae(F.col("cnae_2_subclasse").cast("string")).alias("cnae_2_subclasse")).unionByName(
            spark.createDataFrame([(c,) for c in UNKNOWN_CODES], "cnae_2_subclasse string")
        ).distinct()
        ibge = sector_from_code(F.col("cnae_2_subclasse"))
        return listed.select(
            "cnae_2_subclasse",
            ibge.alias("setor_ibge"),
            sebrae_from_sector(ibge).alias("setor_sebrae"),
        )
    rows = activity_rows(codes)
    return bounded(spark.createDataFrame(rows, ACTIVITY_SCHEMA), len(rows))


def sebrae_from_sector(sector_col):
    from pyspark.sql import functions as F

    expr = None
    for ibge, sebrae in SEBRAE_SECTOR.items():
        cond = sector_col == F.lit(ibge)
        expr = F.when(cond, F.lit(sebrae)) if expr is None else expr.when(cond, F.lit(sebrae))
    return expr.otherwise(F.lit(UNKNOWN))


def size_rows() -> list[tuple[str, str, str]]:
    """(setor_ibge, tam_estab, porte_sebrae): the 99 keys of the size matrix."""
    rows = []
    for sector, bands in SIZE_RULES.items():
        for lo, hi, label in bands:
            rows.extend((sector, str(size), label) for size in range(lo, hi + 1))
        rows.append((sector, "-1", SIZE_UNKNOWN_CLASS.get(sector, UNKNOWN)))
    return rows


SIZE_SCHEMA = T.StructType([
    T.StructField("setor_ibge", T.StringType(), False),
    T.StructField("tam_estab", T.StringType(), False),
    T.StructField("porte_sebrae", T.StringType(), False),
])


def size_dimension(spark: SparkSession) -> DataFrame:
    rows = size_rows()
    return bounded(spark.createDataFrame(rows, SIZE_SCHEMA), len(rows))


def uf_dimension(spark: SparkSession) -> DataFrame:
    """(codigo_uf int, uf string) for the 27 states plus 99 → NI."""
    rows = [(int(c), s) for c, s in UF_CODES] + [(99, UF_UNKNOWN)]
    return bounded(spark.createDataFrame(rows, "codigo_uf int, uf string"), len(rows))


def values_sql(rows, columns) -> str:
    """Rows as an inline ``VALUES`` relation (used by oracles and SQL users)."""

    def lit(v):
        if v is None:
            return "NULL"
        if isinstance(v, str):
            return "'" + v.replace("'", "''") + "'"
        return str(v)

    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"(VALUES {body}) AS t({', '.join(columns)})"
