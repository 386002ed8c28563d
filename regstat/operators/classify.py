"""Classification: FLT-03 and the dictionary lookups LKP-01..04 as joins.

Lookups are left equi-joins against small dimensions.  A dimension is
broadcast by force only when it was built from a fixed code list; for any
other the join is left to the planner (Spark's byte threshold, AQE), so a
grown dimension can never blow up executor memory.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import dims
from ..functions import columns as C

# A dimension built from a fixed list of at most this many rows is broadcast (the largest here has ~1.4k).
BROADCAST_MAX_ROWS = 200_000


def fits_broadcast(dim: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> bool:
    """True for a frame built here from a fixed code list (``dims.row_bound``).

    Any other frame is left to Spark's own byte threshold and AQE: no job runs
    while the plan is built, and a grown dimension is never forced on executors.
    """
    known = dims.row_bound(dim)
    return known is not None and known <= max_rows


def lookup(df: DataFrame, dim: DataFrame, on: Sequence[str] | str, defaults: Mapping[str, object],
           max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Left join ``dim`` on ``on``; looked-up columns missing a match take ``defaults``."""
    on = [on] if isinstance(on, str) else list(on)
    side = F.broadcast(dim) if fits_broadcast(dim, max_rows) else dim
    joined = df.join(side, on=on, how="left")
    out = [F.col(c) for c in df.columns]
    out += [F.coalesce(F.col(c), F.lit(v)).alias(c) for c, v in defaults.items()]
    return joined.select(out)


# --- FLT-03 ---------------------------------------------------------------
def enterprise_flag_col(cnae_col="cnae_2_subclasse", nat_col="nat_jur", strict: bool = False) -> Column:
    """1 when the division is not 84/94/99 and the legal nature is an enterprise one."""
    div = C.cnae_division(cnae_col, strict=strict)
    nat = F.col(nat_col) if isinstance(nat_col, str) else nat_col
    cond = ~div.isin(dims.NON_ENTERPRISE_DIVISIONS) & nat.cast("string").isin(dims.ENTERPRISE_NATURES)
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


# --- LKP-01 / LKP-02 ------------------------------------------------------
def add_sectors(df: DataFrame, activity_dim: DataFrame, code_col: str = "cnae_2_subclasse") -> DataFrame:
    """``setor_ibge`` and ``setor_sebrae`` in one join ('-1' when the code is not listed)."""
    dim = dims.bounded(activity_dim.select(F.col("cnae_2_subclasse").alias(code_col), "setor_ibge", "setor_sebrae"),
                       dims.row_bound(activity_dim))
    return lookup(df, dim, code_col, {"setor_ibge": dims.UNKNOWN, "setor_sebrae": dims.UNKNOWN})


# --- LKP-03 ---------------------------------------------------------------
def add_porte(df: DataFrame, size_dim: DataFrame) -> DataFrame:
    """(setor_ibge, tam_estab) → ``porte_sebrae``; any pair not listed → '-1'."""
    return lookup(df, size_dim, ["setor_ibge", "tam_estab"], {"porte_sebrae": dims.UNKNOWN})


# --- LKP-04 ---------------------------------------------------------------
def star_join(fact: DataFrame, dims_by_key: Mapping[str, DataFrame]) -> DataFrame:
    """Enrich a fact with each dimension's columns (chained left joins, checked broadcast)."""
    out = fact
    for key, dim in dims_by_key.items():
        side = F.broadcast(dim) if fits_broadcast(dim) else dim
        out = out.join(side, on=key, how="left")
    return out


def orphans(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Codes of ``fact`` with no dimension row, with their row counts.

    Pre-aggregated per code before the anti join, so a hot code is one row
    by the time it meets the dimension.
    """
    side = dims.bounded(dim.select(key).distinct(), dims.row_bound(dim))
    side = F.broadcast(side) if fits_broadcast(side) else side
    per_code = fact.groupBy(key).agg(F.count(F.lit(1)).alias("n_linhas"))
    return per_code.join(side, on=key, how="left_anti")
