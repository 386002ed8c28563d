"""Sinks: SNK-01..05, SNK-08 (batch writes to partitioned Parquet).

Partitioned writes are rebalanced on the partition columns (AQE splits a
skewed partition by size and merges small ones) or, on request, spread over
a fixed number of tasks by a deterministic salt.  Either way a state holding
a third of all rows is written by several tasks instead of one, and a task
retried after an executor loss recomputes exactly the same rows.  Overwrites
replace only the partitions present in the data (dynamic, per write).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import dims
from ..operators.shape import qcol
from ..session import FREED, settings
from . import versions


#: Parquet writer options of every table: denser than Spark's default codec.
DENSE = {"compression": "zstd"}


def salted(df: DataFrame, keys: Sequence[str], salt_buckets: int, partitions: int | None = None) -> DataFrame:
    """Repartition by ``keys`` + a deterministic salt (hash of the whole row)."""
    salt = F.pmod(F.xxhash64(*[qcol(c) for c in df.columns]), F.lit(salt_buckets))
    cols = [qcol(k) for k in keys] + [salt]
    return df.repartition(partitions, *cols) if partitions else df.repartition(*cols)


def goes(n: int, year: str = "ano") -> list[Column]:
    """Conditions that deal whole years to ``n`` goes, every row to one of them (rows without a year to the first)."""
    return [F.coalesce(F.pmod(qcol(year).try_cast("int"), F.lit(n)), F.lit(0)) == i for i in range(n)]


def write_partitioned(df: DataFrame, path: str, partition_by: Sequence[str] = ("ano",), mode: str = "append",
                      salt_buckets: int | None = None, observed: tuple[Observation, Mapping[str, Column]] | None = None,
                      sort_by: Sequence[str] = (), options: Mapping[str, str] | None = None, gathered: bool = False,
                      rounds: int | None = None) -> None:
    """Partitioned Parquet write.

    With ``salt_buckets`` every partition value is spread over that many
    writer tasks (fixed spread).  Without it the rows are rebalanced on the
    partition columns (``REBALANCE`` hint): AQE splits a skewed partition by
    size into several tasks and merges tiny ones, so there are neither huge
    single-task partitions nor floods of small files.  ``gathered`` rows are read from
    files that hold few partition values each; they are written where they are read, without a shuffle.
    A job's shuffle files are deleted as soon as it ends.  With ``rounds`` the years (``ano``, one of
    ``partition_by``) are written in so many jobs, one after the other, so that only
    one job's rows lie in shuffle files at a time; each job reads its own years, so it is
    meant for inputs that a filter on the year makes small (year folders, a column of a table).

    ``observed`` collects aggregates in the writing tasks themselves (after the
    shuffle, where a retried task counts once).  ``sort_by`` orders rows inside each slice of each file.
    """
    if rounds and (observed or "ano" not in partition_by):
        raise ValueError("rounds are for writes by year without observed aggregates")
    if rounds:
        for i, mine in enumerate(goes(rounds)):
            write_partitioned(df.filter(mine), path, partition_by, "append" if i and mode == "errorifexists" else mode, salt_buckets,
                              sort_by=sort_by, options=options, gathered=gathered)
        return
    if salt_buckets:
        df = salted(df, partition_by, salt_buckets)
    elif partition_by and not gathered:
        df = df.hint("rebalance", *partition_by)
    if observed:
        df = df.observe(observed[0], *[v.alias(k) for k, v in observed[1].items()])
    if sort_by:
        df = df.sortWithinPartitions(*partition_by, *sort_by)
    w = df.write.mode(mode).options(**{**DENSE, **(options or {})})
    if mode == "overwrite" and partition_by:
        # replace only the partitions present in df (per write, not a session setting)
        w = w.option("partitionOverwriteMode", "dynamic")
    if partition_by:
        w = w.partitionBy(*partition_by)
    with settings(df.sparkSession, FREED):
        w.parquet(path)


# --- SNK-01 ---------------------------------------------------------------
def append_staging(df: DataFrame, path: str, partition_by: Sequence[str] = ("ano",),
                   salt_buckets: int | None = None, replace_partitions: bool = False, options: Mapping[str, str] | None = None,
                   rounds: int | None = None) -> None:
    """Append treated rows to staging.  Plain append by default (a re-run appends
    again, as the reference's staging does); ``replace_partitions=True`` makes a
    re-run replace the years it loads instead.  ``rounds`` as in :func:`write_partitioned`."""
    write_partitioned(df, path, partition_by, "overwrite" if replace_partitions else "append", salt_buckets, options=options, rounds=rounds)


# --- SNK-02 ---------------------------------------------------------------
def check_schema(df: DataFrame, schema: T.StructType) -> None:
    have = {f.name: f.dataType for f in df.schema.fields}
    bad = [f.name for f in schema.fields if have.get(f.name) != f.dataType]
    extra = [c for c in df.columns if c not in set(schema.fieldNames())]
    if bad or extra:
        raise ValueError(f"schema mismatch: wrong or missing {bad}, unexpected {extra}")


def append_table(df: DataFrame, path: str, schema: T.StructType, partition_by: Sequence[str] = ("ano",),
                 idempotent: bool = True, salt_buckets: int | None = None) -> None:
    """Write typed rows in schema order; a frame off the schema is rejected.

    ``idempotent=True`` replaces only the partitions present in ``df``
    (dynamic partition overwrite), so re-running a slice does not duplicate it.
    """
    check_schema(df, schema)
    out = df.select([qcol(n) for n in schema.fieldNames()])
    write_partitioned(out, path, partition_by, "overwrite" if idempotent else "append", salt_buckets)


# --- SNK-03 ---------------------------------------------------------------
def replace_table(df: DataFrame, path: str) -> int:
    """Replace the whole table in one step, then read the row count back.

    The rows are written beside the table and become its next version when all
    of them are there (see :mod:`versions`): a failed load leaves the old table, and a
    table can be replaced from itself.  Read it with :func:`read_back`.
    """
    versions.commit(df, path)
    return versions.read(df.sparkSession, path).count()


# --- SNK-04 ---------------------------------------------------------------
def flag_range(df: DataFrame, col: str = "ano", start: int = 2010, width: int = 3, end: int = 2027) -> DataFrame:
    """``aceito`` (the row lies in a range) and the bounds of its ``width``-year range, in the same pass as the rows."""
    c = qcol(col)
    inside = F.coalesce(c.between(start, end), F.lit(False))
    lo = F.when(inside, (F.lit(start) + F.lit(width) * F.floor((c - F.lit(start)) / F.lit(width))).cast("int"))
    return df.select("*", inside.alias("aceito"), lo.alias(f"{col}_de"), (lo + F.lit(width - 1)).alias(f"{col}_ate"))


def range_bucket(df: DataFrame, col: str = "ano", start: int = 2010, width: int = 3,
                 end: int = 2027) -> tuple[DataFrame, DataFrame]:
    """Route rows to ``width``-year ranges [start, end]; rows outside are split off.

    Returns (in range with ``<col>_de``/``<col>_ate`` bounds, out of range); use :func:`flag_range` to treat both in one pass.
    """
    flagged = flag_range(df, col, start, width, end)
    return flagged.filter("aceito").drop("aceito"), flagged.filter("not aceito").select(*[qcol(c) for c in df.columns])


# --- SNK-05 ---------------------------------------------------------------
def flag_valid(df: DataFrame, uf_col: str = "uf", years: tuple[int, int] | None = None) -> DataFrame:
    """``aceito``: the state is one of the 28 values (NULL passes, as a SQL CHECK lets it) and the year, if asked, inside ``years``."""
    ok = F.coalesce(qcol(uf_col).isin(dims.UF_VALID), F.lit(True))
    if years is not None:
        ok = ok & F.coalesce(F.col("ano").between(*years), F.lit(False))
    return df.select("*", ok.alias("aceito"))


def validate_and_partition(df: DataFrame, uf_col: str = "uf", years: tuple[int, int] | None = None
                           ) -> tuple[DataFrame, DataFrame]:
    """Split rows by the table's constraint; use :func:`flag_valid` to treat both sides in one pass."""
    flagged = flag_valid(df, uf_col, years)
    return flagged.filter("aceito").drop("aceito"), flagged.filter("not aceito").drop("aceito")


# --- SNK-08 ---------------------------------------------------------------
def write_dimension(df: DataFrame, path: str) -> int:
    """Load a dimension in one batch write (replacing it); returns its row count."""
    return replace_table(df, path)


def read_back(spark: SparkSession, path: str) -> DataFrame:
    """A table as its last finished load left it."""
    return versions.read(spark, path)


__all__ = ["append_staging", "append_table", "replace_table", "range_bucket", "validate_and_partition", "flag_range", "flag_valid",
           "write_dimension", "write_partitioned", "salted", "check_schema", "read_back"]
