"""Frame-level cleansing: SCL-01, SCL-02, SCL-04, SCL-09, SCL-10 (conform).

Each operator rewrites the affected columns inside one projection.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import columns as C
from ..schemas import require, sql_type
from .shape import qcol


def _string_cols(df: DataFrame) -> set[str]:
    return {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}


def _rewrite(df: DataFrame, fn) -> DataFrame:
    out = []
    for f in df.schema.fields:
        new = fn(f)
        out.append(qcol(f.name) if new is None else new.alias(f.name))
    return df.select(out)


# --- SCL-01 ---------------------------------------------------------------
def trim_strings(df: DataFrame, skip: Iterable[str] = ()) -> DataFrame:
    """Strip white space (no-break space included) from every string column; ``skip`` names columns left alone."""
    skip = set(skip)
    return _rewrite(df, lambda f: C.strip_ws(qcol(f.name)) if isinstance(f.dataType, T.StringType) and f.name not in skip else None)


# --- SCL-02 ---------------------------------------------------------------
def decode_sentinels(df: DataFrame, cols: Sequence[str] | None = None,
                     spellings: Sequence[str] = C.SENTINELS, skip: Iterable[str] = ()) -> DataFrame:
    """Exact-match sentinel → '-1', on string columns only (an int column never holds one)."""
    strings = _string_cols(df)
    target = (set(cols) if cols is not None else strings) & strings
    target -= set(skip)
    return _rewrite(df, lambda f: C.sentinel_to_unknown(qcol(f.name), spellings) if f.name in target else None)


# --- SCL-04 ---------------------------------------------------------------
def null_to_unknown(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """NULL → -1 for the named columns ('-1' text on string columns)."""
    target = set(cols)
    missing = target - set(df.columns)
    if missing:
        raise ValueError(f"columns not found: {sorted(missing)}")
    return _rewrite(df, lambda f: C.null_to_unknown_col(qcol(f.name), f.dataType) if f.name in target else None)


def fill_unknown(df: DataFrame, skip: Iterable[str] = ()) -> DataFrame:
    """Every integer column NULL → -1, every string column NULL → '-1'; ``skip`` names columns left alone."""
    skip = set(skip)

    def fill(f):
        if f.name in skip:
            return None
        if isinstance(f.dataType, (T.ShortType, T.IntegerType, T.LongType)):
            return F.coalesce(qcol(f.name), F.lit(-1).cast(f.dataType))
        if isinstance(f.dataType, T.StringType):
            return F.coalesce(qcol(f.name), F.lit("-1"))
        return None
    return _rewrite(df, fill)


# --- SCL-09 ---------------------------------------------------------------
def cast_ints(df: DataFrame, cols: Sequence[str], type_name: str = "int") -> DataFrame:
    target = set(cols)
    return _rewrite(df, lambda f: qcol(f.name).try_cast(type_name) if f.name in target else None)


# --- SCL-10 / SNK-06 ------------------------------------------------------
def conform(df: DataFrame, schema: T.StructType, may_lack: Sequence[str] = ()) -> DataFrame:
    """Ordered select of ``try_cast`` into ``schema``.

    Columns not in the schema are dropped; a schema column the frame lacks is an
    error that names it, or NULL of its type if it is one of ``may_lack``.  A
    value that does not fit (text, smallint overflow) becomes NULL.
    """
    present = set(df.columns)
    require(schema.fieldNames(), present, may_lack)
    out = []
    for f in schema.fields:
        src = qcol(f.name) if f.name in present else F.lit(None)
        out.append(src.try_cast(sql_type(f.dataType)).alias(f.name))
    return df.select(out)
