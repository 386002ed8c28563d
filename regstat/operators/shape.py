"""Projections, set operations and sorts: SURVEY §2.3, SET-01, SRT-01/02, SRC-03.

Every operator here is one ``select`` (one Project node), never a chain of
``withColumn``/``withColumnRenamed`` calls: the analyzer cost of a chain grows
with each node, a single projection does not.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import columns as C


def qcol(name: str) -> Column:
    """Column by exact name; dots and spaces in raw headers are not paths."""
    return F.col("`" + name.replace("`", "``") + "`")


# --- PRJ-01 ---------------------------------------------------------------
def drop_strict(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Drop columns; a name that is not there is an error (Spark's drop ignores it)."""
    cols = list(cols)
    present = set(df.columns)
    missing = [c for c in cols if c not in present]
    if missing:
        raise ValueError(f"columns not found: {missing}")
    drop = set(cols)
    return df.select([qcol(c) for c in df.columns if c not in drop])


# --- PRJ-02 ---------------------------------------------------------------
def rename_by_dict(df: DataFrame, mapping: Mapping[str, str], case_sensitive: bool | None = None) -> DataFrame:
    """Rename by dictionary in one projection; unknown headers stay as they are.

    Header keys match like Spark resolves names (``spark.sql.caseSensitive``,
    off by default: ``Uf`` matches ``UF``); ``case_sensitive=True`` matches
    exactly, as a pandas rename does.
    """
    if case_sensitive is None:
        case_sensitive = df.sparkSession.conf.get("spark.sql.caseSensitive", "false").lower() == "true"
    return df.select([named(c, t) for c, t in zip(df.columns, renamed(df.columns, mapping, case_sensitive))])


def renamed(columns: Sequence[str], mapping: Mapping[str, str], case_sensitive: bool = False) -> list[str]:
    """The names that :func:`rename_by_dict` gives to columns."""
    folded = {} if case_sensitive else {k.lower(): v for k, v in reversed(list(mapping.items()))}
    return [mapping.get(c) or folded.get(c.lower()) or c for c in columns]


def named(source: str, target: str) -> Column:
    """A column under another name; no alias if the name stays (every alias of a filtered column costs the optimizer)."""
    return qcol(source) if source == target else qcol(source).alias(target)


# --- PRJ-03 ---------------------------------------------------------------
def normalize_headers(df: DataFrame) -> DataFrame:
    return df.select([named(c, C.normalize_name(c)) for c in df.columns])


# --- PRJ-04 ---------------------------------------------------------------
def with_audit(df: DataFrame, owner: str, ano=None, as_of: str | None = None,
               date_as: str = "date", ano_type: str = "int") -> DataFrame:
    """Add ``curr_date``, ``ds_owner`` and, when given, ``ano`` (a value or a Column)."""
    audit = {"curr_date": C.load_date(as_of, date_as), "ds_owner": F.lit(owner)}
    if ano is not None:
        audit["ano"] = (ano if isinstance(ano, Column) else F.lit(ano)).cast(ano_type)
    keep = [qcol(c) for c in df.columns if c not in audit]
    return df.select(keep + [v.alias(k) for k, v in audit.items()])


# --- PRJ-07 / PRJ-08 ------------------------------------------------------
def select_ordered(df: DataFrame, names: Sequence[str] | T.StructType) -> DataFrame:
    if isinstance(names, T.StructType):
        names = names.fieldNames()
    return df.select([qcol(n) for n in names])


# --- FLT-01 ---------------------------------------------------------------
def by_uf(df: DataFrame, uf: str, col: str = "uf") -> DataFrame:
    """Rows of one state; a NULL state counts as NI (filled before the filter, D7).
    On a table partitioned by state this is a partition filter."""
    return df.filter(C.null_to_ni(qcol(col)) == F.lit(uf))


# --- SRC-03 ---------------------------------------------------------------
def disambiguation_map(columns: Sequence[str], groups: Mapping[str, Sequence[str]]) -> dict[str, str]:
    """{copy name: target name} for the copies of each duplicated header, in file order."""
    rename: dict[str, str] = {}
    for base, targets in groups.items():
        pat = re.compile(r"^" + re.escape(base) + r"(\.?\d+)?$")
        copies = [c for c in columns if pat.match(c)]
        if len(copies) > len(targets):
            raise ValueError(f"{len(copies)} copies of {base!r}, {len(targets)} names given")
        rename.update(zip(copies, targets))
    return rename


def disambiguate(df: DataFrame, groups: Mapping[str, Sequence[str]]) -> DataFrame:
    """Rename the copies of a duplicated header, in file order.

    The CSV reader appends the column index to each copy (``tipo_estab41``,
    ``tipo_estab42``); pandas appends ``.1``.  The literal index is not relied
    upon: copies are matched by ``base`` + digits (or ``.digits``) and ranked by
    position.
    """
    return rename_by_dict(df, disambiguation_map(df.columns, groups))


# --- SET-01 ---------------------------------------------------------------
def stack_vintages(dfs: Iterable[DataFrame]) -> DataFrame:
    """Stack by column name; a column missing in one vintage is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


# --- SRT-01 / SRT-02 ------------------------------------------------------
def sort_gdp(df: DataFrame) -> DataFrame:
    return df.orderBy("ano", "sigla_uf", "id_municipio")


def sorted_for_write(df: DataFrame, keys: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Scale form of a sort before a write: range partitions, then sort inside each."""
    if partitions:
        df = df.repartitionByRange(partitions, *keys)
    return df.sortWithinPartitions(*keys)


def preview(df: DataFrame, n: int, order_by: Sequence[str]) -> DataFrame:
    """First ``n`` rows in a fixed order (a top-n, the order keeps it repeatable)."""
    return df.orderBy(*order_by).limit(n)
