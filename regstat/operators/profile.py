"""Aggregations and profiles: AGG-01..06 and SNK-07.

Every profile is ONE aggregation pass over the data (partial aggregation on
the map side, a one-row final), then a ``stack`` to a long (column, value)
table — never one job per profiled column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import dims
from ..sources import versions
from .shape import qcol

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _stack(row: DataFrame, pairs: Sequence[tuple[str, str]], names: Sequence[str]) -> DataFrame:
    """Unpivot a one-row frame: ``pairs`` are (label, column of row) per output row."""
    args = ", ".join(f"'{label}', `{col}`" for label, col in pairs)
    return row.selectExpr(f"stack({len(pairs)}, {args}) AS ({', '.join(names)})")


# --- AGG-01 / AGG-02 ------------------------------------------------------
def n_rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_linhas"))


def total(df: DataFrame, col: str = "qtd_vinc_ativos", alias: str | None = None) -> DataFrame:
    return df.agg(F.sum(qcol(col)).alias(alias or f"total_{col}"))


# --- AGG-03 ---------------------------------------------------------------
def by_uf_summary(df: DataFrame, uf: str = "sigla_uf") -> DataFrame:
    """Per state: sum of active links and count of (non-null) municipality values."""
    return df.groupBy(uf).agg(
        F.sum("qtd_vinc_ativos").alias("soma_vinc_ativos"),
        F.count("id_municipio").alias("n_municipio"),
    )


# --- AGG-04 ---------------------------------------------------------------
def null_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    cols = list(cols or df.columns)
    row = df.agg(*[F.sum(F.when(qcol(c).isNull(), 1).otherwise(0)).cast("bigint").alias(f"c{i}")
                   for i, c in enumerate(cols)])
    return _stack(row, [(c, f"c{i}") for i, c in enumerate(cols)], ["coluna", "n_nulos"])


# --- AGG-05 ---------------------------------------------------------------
def sentinel_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Count of -1 in each integer column (a one-pass version of the per-column report)."""
    if cols is None:
        cols = [f.name for f in df.schema.fields if isinstance(f.dataType, _INTEGRAL)]
    cols = list(cols)
    row = df.agg(*[F.sum(F.when(qcol(c) == -1, 1).otherwise(0)).cast("bigint").alias(f"c{i}")
                   for i, c in enumerate(cols)])
    return _stack(row, [(c, f"c{i}") for i, c in enumerate(cols)], ["coluna", "n_menos_um"])


# --- AGG-04 / AGG-05 as a load's own report ---------------------------------
def load_metrics(df: DataFrame, total: str, state: str) -> dict[str, Column]:
    """Aggregates for ``versions.commit(metrics=…)``: rows, the total, nulls of every column, -1 of every integer column, rows and total by state.

    They are computed in the tasks that write the rows, so a load's report costs no
    scan of its own.  States are a fixed list, so their sums are plain conditional aggregates.
    """
    count = lambda cond: F.coalesce(F.sum(F.when(cond, 1).otherwise(0)), F.lit(0)).cast("bigint")
    amount = F.coalesce(qcol(total).cast("bigint"), F.lit(0))
    out = {"linhas|": F.count(F.lit(1)), f"total|{total}": F.coalesce(F.sum(amount), F.lit(0))}
    for f in df.schema.fields:
        out[f"nulos|{f.name}"] = count(qcol(f.name).isNull())
        if isinstance(f.dataType, _INTEGRAL):
            out[f"menos_um|{f.name}"] = count(qcol(f.name) == -1)
    numbers = isinstance(df.schema[state].dataType, _INTEGRAL)
    for code, letters in dims.UF_CODES:
        mine = qcol(state) == (F.lit(int(code)) if numbers else F.lit(letters))
        out[f"linhas_uf|{letters}"] = count(mine)
        out[f"total_uf|{letters}"] = F.coalesce(F.sum(F.when(mine, amount)), F.lit(0)).cast("bigint")
    return out


def load_report(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """(medida, coluna, valor) of the load that made a table's version, from the notes it left."""
    found = versions.latest(spark, path, number)
    metrics = found.notes.get("metrics", {}) if found else {}
    return spark.createDataFrame([(*k.split("|", 1), int(v)) for k, v in metrics.items()], "medida string, coluna string, valor bigint")


# --- AGG-06 ---------------------------------------------------------------
def distinct_values(df: DataFrame, cols: Sequence[str] | None = None, by: Sequence[str] = ()) -> DataFrame:
    """(by…, posicao, valor): the distinct non-null values of each column, as text.

    One pass: a row's values are counted into their (column, value) in the reading
    task, and only the distinct ones of a task are shuffled.
    """
    cols = list(cols or df.columns)
    pairs = F.array(*[F.struct(F.lit(i).alias("posicao"), qcol(c).cast("string").alias("valor")) for i, c in enumerate(cols)])
    long = df.select(*[qcol(k) for k in by], F.explode(pairs).alias("p")).select(*[qcol(k) for k in by], "p.*")
    return long.filter("valor is not null").distinct()


def _profile_of(values: DataFrame, fields: Sequence[T.StructField]) -> DataFrame:
    """The profile from distinct values; maxima follow each column's own type."""
    measured = [F.struct(F.lit(i).alias("posicao"), F.lit(f.name).alias("coluna")) for i, f in enumerate(fields)]
    names = values.sparkSession.range(1).select(F.explode(F.array(*measured)).alias("c")).select("c.*")
    best = [F.max(F.when(F.col("posicao") == i, F.col("valor").try_cast(f.dataType))).cast("string") for i, f in enumerate(fields)]
    tops = F.array(*best)
    sizes = values.groupBy("posicao").agg(F.max(F.length("valor")).cast("bigint").alias("max_len"), F.count(F.lit(1)).alias("n_distintos"))
    top = values.agg(tops.alias("tops")).select(F.posexplode("tops").alias("posicao", "max_valor"))
    return (names.join(sizes, "posicao", "left").join(top, "posicao", "left")
            .select("coluna", "max_valor", "max_len", F.coalesce("n_distintos", F.lit(0)).cast("bigint").alias("n_distintos")))


def column_profile(df: DataFrame, cols: Sequence[str] | None = None, exact_distinct: bool = True) -> DataFrame:
    """Per column: max value (as text), max text length, number of distinct values.

    Exact counts come from :func:`distinct_values`; ``exact_distinct=False`` swaps them
    for HyperLogLog in one aggregation without a shuffle of values, the cheaper choice on very wide tables.
    """
    cols = list(cols or df.columns)
    if exact_distinct:
        return _profile_of(distinct_values(df, cols), [df.schema[c] for c in cols])
    aggs = []
    for i, c in enumerate(cols):
        aggs += [F.max(qcol(c)).cast("string").alias(f"m{i}"), F.max(F.length(qcol(c).cast("string"))).cast("bigint").alias(f"l{i}"),
                 F.approx_count_distinct(qcol(c)).cast("bigint").alias(f"d{i}")]
    row = df.agg(*aggs)
    args = ", ".join(f"'{c}', `m{i}`, `l{i}`, `d{i}`" for i, c in enumerate(cols))
    return row.selectExpr(f"stack({len(cols)}, {args}) AS (coluna, max_valor, max_len, n_distintos)")


def refresh_profile(spark: SparkSession, table: str, state: str, cols: Sequence[str], by: str = "ano") -> DataFrame:
    """The profile of a versioned table, kept up to date slice by slice.

    ``state`` keeps each year's distinct values and a mergeable sketch of each column; only years in which the
    table differs from what the state was made from are read again, then the states are merged.
    """
    now, kept = versions.latest(spark, table), versions.latest(spark, state)
    old = versions.latest(spark, table, kept.notes["table"]) if kept else None
    touched = {s[by] for s in versions.changed(old, now)}
    fields = [now.schema[c] for c in cols]
    if touched:
        fresh = distinct_values(versions.rows(spark, table, now, lambda s: s[by] in touched), cols, (by,))
        versions.commit(fresh, state, (by,), versions.where(lambda s: s[by] in touched), notes={"table": now.number})
    values = versions.read(spark, state).select("posicao", "valor").distinct()
    return _profile_of(values, fields)


def sketched_profile(df: DataFrame, cols: Sequence[str], by: str = "ano") -> DataFrame:
    """One row per (``by``, column): max length and a HyperLogLog sketch (binary) that :func:`merge_sketches` adds up later."""
    aggs = [F.struct(F.lit(c).alias("coluna"), F.max(F.length(qcol(c).cast("string"))).cast("bigint").alias("max_len"),
                     F.hll_sketch_agg(qcol(c).cast("string")).alias("esboco")) for c in cols]
    return df.groupBy(qcol(by)).agg(F.array(*aggs).alias("p")).select(by, F.explode("p").alias("p")).select(by, "p.*")


def merge_sketches(state: DataFrame) -> DataFrame:
    """(coluna, max_len, n_distintos): the slices' sketches merged into one estimate per column."""
    return state.groupBy("coluna").agg(F.max("max_len").alias("max_len"), F.hll_sketch_estimate(F.hll_union_agg("esboco")).alias("n_distintos"))


# --- SNK-07 ---------------------------------------------------------------
def integers_of_text(df: DataFrame) -> DataFrame:
    """Text columns whose every value is an integer become bigint (one aggregation pass); leading zeros are codes and stay text."""
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    if not text:
        return df
    whole = [F.coalesce(F.bool_and(qcol(c).rlike(r"^-?(0|[1-9][0-9]{0,17})$")), F.lit(False)).alias(f"w{i}") for i, c in enumerate(text)]
    row = df.agg(*whole).first()
    ints = {c for i, c in enumerate(text) if row[f"w{i}"]}
    return df.select([qcol(c).cast("bigint").alias(c) if c in ints else qcol(c) for c in df.columns])


def infer_narrow_types(df: DataFrame, use_min: bool = False) -> DataFrame:
    """Narrowest table type per column, from one aggregation pass.

    Integer columns (by schema): smallint when max < 32767, int when max <
    2147483647, else bigint (strict bounds; only the max is looked at, as the
    reference does).  ``use_min=True`` also requires min > -32768 / > -2147483648,
    so negative values cannot overflow the chosen type.
    Every other column: varchar(longest text), at least 1.
    """
    fields = df.schema.fields
    aggs = []
    for i, f in enumerate(fields):
        if isinstance(f.dataType, _INTEGRAL):
            # with use_min, a value far below zero pushes the type up like a large one
            hi = F.max(qcol(f.name)).cast("decimal(20,0)")
            v = F.greatest(hi, -(F.min(qcol(f.name)).cast("decimal(20,0)")) - 1) if use_min else hi
            aggs.append(v.cast("decimal(20,0)").alias(f"v{i}"))
        else:
            aggs.append(F.max(F.length(qcol(f.name).cast("string"))).cast("decimal(20,0)").alias(f"v{i}"))
    row = df.agg(*aggs)
    args = ", ".join(
        f"{i}, '{f.name}', {'true' if isinstance(f.dataType, _INTEGRAL) else 'false'}, `v{i}`"
        for i, f in enumerate(fields)
    )
    long = row.selectExpr(f"stack({len(fields)}, {args}) AS (posicao, coluna, inteiro, v)")
    tipo = (F.when(~F.col("inteiro"), F.concat(F.lit("varchar("), F.greatest(F.coalesce("v", F.lit(1)), F.lit(1)).cast("string"), F.lit(")")))
            .when(F.col("v") < 32767, F.lit("smallint"))
            .when(F.col("v") < 2147483647, F.lit("int"))
            .otherwise(F.lit("bigint")))
    return long.select(F.col("posicao").cast("int").alias("posicao"), "coluna", tipo.alias("tipo"))
