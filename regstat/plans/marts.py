"""QRY marts kept beside a versioned table: partial aggregates per slice, added up on reading.

A mart notes which version of its table it was made from.  A refresh compares the
two manifests, reads only the slices that differ (new, loaded again or gone), and
replaces their aggregates in one commit; the other slices' rows stay as they are.
Aggregates of a slice hold one row per combination of codes, never per register row.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import versions
from . import analyses
from .analyses import DEMOGRAPHICS


@dataclass(frozen=True)
class Mart:
    keys: tuple[str, ...]                              # the table's slices
    partial: Callable[[DataFrame], DataFrame]          # rows of some slices → their aggregates, by slice
    merge: Callable[[DataFrame], DataFrame]            # aggregates of all slices → the query's result


LEVELS = {"uf": None, "setor": "ibge_subsetor", "ocupacao": "cbo_grande_grupo"}


def _headcount_by_slice(links: DataFrame) -> DataFrame:
    """QRY-01's three breakdowns inside each (ano, uf)."""
    df = analyses._cbo_group(analyses._active(links))
    keys = ["ano", "uf", "ibge_subsetor", "cbo_grande_grupo", *DEMOGRAPHICS]
    sets = [["ano", "uf", *([c] if c else []), *DEMOGRAPHICS] for c in LEVELS.values()]
    out = df.groupingSets(sets, *keys).agg(F.count(F.lit(1)).alias("n_vinculos"), F.grouping("ibge_subsetor").alias("g_setor"), F.grouping("cbo_grande_grupo").alias("g_ocupacao"))
    nivel = F.when(F.col("g_setor") == 0, F.lit("setor")).when(F.col("g_ocupacao") == 0, F.lit("ocupacao")).otherwise(F.lit("uf"))
    return out.select("ano", "uf", nivel.alias("nivel"), "ibge_subsetor", "cbo_grande_grupo", *DEMOGRAPHICS, "n_vinculos")


def _headcount_merged(state: DataFrame) -> DataFrame:
    by = ["ano", "nivel", "uf", "ibge_subsetor", "cbo_grande_grupo", *DEMOGRAPHICS]
    whole = state.withColumn("uf", F.when(F.col("nivel") == "uf", F.col("uf")))
    return whole.groupBy(*by).agg(F.sum("n_vinculos").alias("n_vinculos")).select(*by, "n_vinculos")


def _as_stored(state: DataFrame) -> DataFrame:
    return state


#: Marts by the name of their query; a query whose groups lie inside one slice needs no merging.
MARTS = {
    "headcount": Mart(("ano", "uf"), _headcount_by_slice, _headcount_merged),
    "mean_pay": Mart(("ano", "uf"), analyses.mean_pay, _as_stored),
    "estab_breakdown": Mart(("ano",), analyses.estab_breakdown, _as_stored),
}


def refresh(spark: SparkSession, name: str, table: str, mart: str) -> list[versions.Slice]:
    """Bring a mart up to its table; returns the slices that were read or removed."""
    rule = MARTS[name]
    now, kept = versions.latest(spark, table), versions.latest(spark, mart)
    if now is None:
        raise ValueError(f"{table} is not a versioned table")
    old = versions.latest(spark, table, kept.notes["table"]) if kept else None
    touched = versions.changed(old, now)
    if touched or kept is None:
        slices = {tuple(s[k] for k in rule.keys) for s in touched}
        mine = lambda s: tuple(s[k] for k in rule.keys) in slices
        versions.commit(rule.partial(versions.rows(spark, table, now, mine)), mart, rule.keys, versions.where(mine), notes={"table": now.number})
    return touched


def result(spark: SparkSession, name: str, mart: str) -> DataFrame:
    """The query's result from its mart alone."""
    return MARTS[name].merge(versions.read(spark, mart))
