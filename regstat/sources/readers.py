"""Sources: SRC-01..08.

Raw extracts are read as text with every column a string (no schema
inference pass over the data).  The year of each row comes from its file
(``_metadata.file_path``), so many yearly files are one scan, one job.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import columns as C
from ..operators.shape import qcol, stack_vintages
from . import versions

# Bytes 0x80–0x9F: ISO-8859-1 maps them to C1 controls, cp1252 to printable
# characters.  The mapping comes from Python's own codec (5 bytes are
# undefined in cp1252 and stay as they are).
_C1_FROM, _C1_TO = "", ""
for _b in range(0x80, 0xA0):
    try:
        _to = bytes([_b]).decode("cp1252")
    except UnicodeDecodeError:
        continue
    _C1_FROM += chr(_b)
    _C1_TO += _to


def cp1252_fix(c) -> Column:
    """Text read as ISO-8859-1 → the characters cp1252 meant."""
    return F.translate(c if isinstance(c, Column) else qcol(c), _C1_FROM, _C1_TO)


def cp1252_fix_name(name: str) -> str:
    return name.translate(str.maketrans(_C1_FROM, _C1_TO))


# --- SRC-01 / SRC-02 ------------------------------------------------------
#: Column of rows that have a field too few or too many for their header (:func:`read_raw` ``malformed``).
MALFORMED = "registro_invalido"
#: One task takes one file whole up to this size; only its first record is read.
WHOLE_FILE = 2**40


def list_files(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(path, length, modified) of the data files under paths, folders or globs: names only, hidden folders left out, listed by Spark."""
    found = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path if isinstance(path, str) else list(path)))
    return found.select("path", "length", F.col("modificationTime").alias("modified"))


def file_headers(spark: SparkSession, path: str | Sequence[str], encoding: str = "cp1252", known: str | None = None) -> DataFrame:
    """(path, header): the first record of each file under ``path``, read by the executors, one short task a file.

    A record goes on over line breaks while a quote is open; empty files have no row.
    ``known`` names a table that keeps the headers by (path, length, time of change):
    files in it are not opened again, and new ones are added to it.
    """
    java_enc, files = _java_encoding(encoding), list_files(spark, path)
    if known is None:
        return _first_records(spark, [r["path"] for r in files.select("path").collect()], java_enc)
    have = versions.latest(spark, known)
    if have is not None:
        files = files.join(versions.read(spark, known).drop("header"), ["path", "length", "modified"], "left_anti")
    fresh = files.collect()                                          # one row a file, what a reader needs to plan its scan
    if fresh:
        table = spark.createDataFrame(fresh, files.schema).join(_first_records(spark, [r["path"] for r in fresh], java_enc), "path", "left")
        versions.commit(table, known, replaces=versions.nothing)
    return list_files(spark, path).join(versions.read(spark, known), ["path", "length", "modified"]).select("path", "header").filter("header is not null")


def _first_records(spark: SparkSession, files: Sequence[str], java_enc: str) -> DataFrame:
    schema = "path string, header string"
    if not files:
        return spark.createDataFrame([], schema)
    side = spark.newSession()                                        # its own settings; the caller's stay as they are
    for name, value in (("spark.sql.files.maxPartitionBytes", WHOLE_FILE), ("spark.sql.files.openCostInBytes", WHOLE_FILE),
                        ("spark.sql.execution.arrow.maxRecordsPerBatch", 16), ("spark.sql.sources.parallelPartitionDiscovery.threshold", 32)):
        side.conf.set(name, str(value))
    lines = side.read.text(list(files)).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), F.col("value").cast("binary").alias("line"))

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        record, path = None, None
        for batch in batches:
            if path is None and batch.num_rows:
                if batch["start"][0].as_py():
                    return                                           # a later part of a very large file
                path = unquote(batch["path"][0].as_py())                  # Spark gives it as a URI
            for line in batch["line"].to_pylist():
                text = line.decode(java_enc, "replace")
                record = text if record is None else record + "\n" + text
                if record.count('"') % 2 == 0:
                    break
            else:
                continue
            break                                                    # the rest of the file stays unread
        if record:
            yield pa.record_batch([pa.array([path]), pa.array([record])], names=["path", "header"])

    found = lines.mapInArrow(first, schema).collect()                # one row a file
    return spark.createDataFrame(found, schema)


def header_fields(header: str, sep: str) -> list[str]:
    """A header record's column names, made unique as Spark's reader does: a repeated one carries its index, an empty one is ``_c<index>``."""
    fields = next(csv.reader([header], delimiter=sep), [])
    folded = [f.lower() for f in fields]
    return [f"_c{i}" if not f else f"{f}{i}" if folded.count(f.lower()) > 1 else f for i, f in enumerate(fields)]


def _java_encoding(encoding: str) -> str:
    return "ISO-8859-1" if encoding.lower().replace("_", "-") in ("cp1252", "windows-1252") else encoding


def _base_path(path: str) -> str:
    """The folder below which ``name=value`` folders are columns."""
    parts = path.rstrip("/").split("/")
    plain = next((i for i, p in enumerate(parts) if any(c in p for c in "*?[{") or "=" in p), len(parts))
    return "/".join(parts[:plain])


def read_raw(spark: SparkSession, path: str | Sequence[str], encoding: str = "cp1252", sep: str = ";", year_from_name: str | None = None,
             multi_line: bool = False, file_col: str | None = None, treat: Callable[[DataFrame], DataFrame] | None = None,
             malformed: bool = False, known_headers: str | None = None, check: Callable[[Sequence[str], Iterable[int]], None] | None = None) -> DataFrame:
    """Read ``sep``-delimited text with a header, every column a string.

    Each file is read by its own header (:func:`file_headers`, read by the executors):
    files are grouped by their header record, every group is one scan, and the groups are
    stacked by column name (a column that a group lacks is NULL).  ``treat`` runs on each
    group before, so headers that only differ in spelling can be brought together, and
    ``check(columns, years)`` may refuse a group that lacks a column of its own years.

    With ``malformed``, column ``registro_invalido`` holds the text of every record that has a field
    too few or too many, and is NULL for the others.  ``known_headers`` names a table that
    keeps headers from run to run.

    Spark's CSV source refuses ``cp1252``; it is read as ISO-8859-1 (same
    bytes outside 0x80–0x9F) and the 27 differing characters are translated
    back, in the same projection.  ``year_from_name`` is a regex with one group
    that pulls the year out of the file's *name* into column ``ano``; a name
    without a year is an error that names the file.  ``multi_line`` is for
    exports with line breaks inside quoted headers or values.
    """
    groups: dict[str, list[str]] = {}
    for row in file_headers(spark, path, encoding, known_headers).collect():
        groups.setdefault(row["header"], []).append(row["path"])
    if not groups:
        raise ValueError(f"no file with a header under {path}")
    frames = []
    for header, files in sorted(groups.items(), key=lambda g: min(g[1])):
        df = _read_group(spark, header_fields(header, sep), sorted(files), path, encoding, sep, year_from_name, multi_line, file_col, malformed)
        df = treat(df) if treat else df
        if check:
            check(df.columns, _years_of_files(files, year_from_name))
        frames.append(df)
    return stack_vintages(frames)


def _years_of_files(files: Iterable[str], year_from_name: str | None) -> set[int]:
    """The years that files are of, by their ``ano=YYYY`` folder or their name."""
    found = set()
    for f in files:
        folder = re.search(r"/ano=(\d{4})/", f)
        name = re.search(year_from_name, f.rsplit("/", 1)[1]) if year_from_name and not folder else None
        found |= {int(m.group(1)) for m in (folder, name) if m}
    return found


def _read_group(spark, fields, files, path, encoding, sep, year_from_name, multi_line, file_col, malformed) -> DataFrame:
    java_enc = _java_encoding(encoding)
    schema = T.StructType([T.StructField(n, T.StringType()) for n in fields + [MALFORMED] * malformed])
    reader = (spark.read.schema(schema).option("sep", sep).option("header", "true").option("encoding", java_enc)
              .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", MALFORMED).option("multiLine", str(multi_line).lower()))
    base = _base_path(path if isinstance(path, str) else path[0])
    if any("=" in f.rsplit("/", 1)[0] for f in files) and base:
        reader = reader.option("basePath", base)
    df = reader.csv(files)
    fix = java_enc != encoding
    cols = []
    for f in df.schema.fields:
        text = isinstance(f.dataType, T.StringType)
        name = cp1252_fix_name(f.name) if fix else f.name
        cols.append(cp1252_fix(f.name).alias(name) if fix and text else qcol(f.name))
    if year_from_name and "ano" not in df.columns:      # ano=YYYY folders already give it
        name = F.col("_metadata.file_name")
        year = F.regexp_extract(name, year_from_name, 1)
        cols.append(F.when(year == "", F.raise_error(F.concat(F.lit("no year in the file name "), name))).otherwise(year).cast("int").alias("ano"))
    if file_col:
        cols.append(F.col("_metadata.file_name").alias(file_col))
    return df.select(cols)


# --- SRC-04 ---------------------------------------------------------------
def load_vintages(spark: SparkSession, readers: Iterable[Callable[[], DataFrame]],
                  treat: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Read, treat and stack several vintages of one wide table, skipping empty ones."""
    frames = []
    for read in readers:
        df = read()
        if df.isEmpty():
            continue
        frames.append(treat(df))
    if not frames:
        raise ValueError("every vintage is empty")
    return stack_vintages(frames)


# --- SRC-05 ---------------------------------------------------------------
def dimension_table_names(sheets: Sequence[str], prefix: str, skip_head: int = 1,
                          skip_tail: int = 1) -> dict[str, str]:
    """Sheet → table name: the first ``skip_head`` and last ``skip_tail`` sheets are
    skipped, the name is ``upper(prefix + sheet[2:])``."""
    kept = list(sheets)[skip_head: len(sheets) - skip_tail if skip_tail else None]
    return {s: (prefix + s[2:]).upper() for s in kept}


def load_dimensions(sheets: Mapping[str, Callable[[], DataFrame]], prefix: str,
                    skip_head: int = 1, skip_tail: int = 1) -> dict[str, DataFrame]:
    names = dimension_table_names(list(sheets), prefix, skip_head, skip_tail)
    return {table: sheets[s]() for s, table in names.items()}


# --- SRC-06 ---------------------------------------------------------------
def read_staging(spark: SparkSession, path: str, uf: str | None = None) -> DataFrame:
    """Re-read staging without its technical ``_id``; ``uf`` prunes partitions."""
    df = versions.read(spark, path)
    if "_id" in df.columns:
        df = df.drop("_id")
    if uf is not None:
        mine = F.col("uf") == F.lit(uf)
        df = df.filter(mine | F.col("uf").isNull() if uf == "NI" else mine)     # staging keeps an unknown state as NULL
    return df


# --- SRC-07 ---------------------------------------------------------------
# File-name rules of the two yearly downloads.
ESTAB_INCLUDE_EQUALS = ["RAIS_ESTAB_PUB.7z"]
ESTAB_INCLUDE_PREFIXES = ["ESTB", "Estb"]
LINKS_EXCLUDE_SUBSTRINGS = ["ESTB", "ESTAB", "Estb", "Legado", "Leia"]


def select_files(name: Column | str, include_equals: Sequence[str] = (), include_prefixes: Sequence[str] = (),
                 exclude_substrings: Sequence[str] = ()) -> Column:
    """Predicate on a file-name column: (equals any | starts with any) and contains none."""
    n = qcol(name) if isinstance(name, str) else name
    inc = None
    for v in include_equals:
        inc = (n == F.lit(v)) if inc is None else inc | (n == F.lit(v))
    for p in include_prefixes:
        inc = n.startswith(p) if inc is None else inc | n.startswith(p)
    cond = F.coalesce(inc, F.lit(False)) if inc is not None else F.lit(True)
    for s in exclude_substrings:
        cond = cond & ~F.coalesce(n.contains(s), F.lit(True))
    return cond


def select_paths(spark: SparkSession, root: str, include_equals: Sequence[str] = (),
                 include_prefixes: Sequence[str] = (), exclude_substrings: Sequence[str] = (),
                 glob: str = "*") -> list[str]:
    """Paths of the files under ``root`` whose names pass :func:`select_files`.

    The listing is a ``binaryFile`` scan with only ``path`` selected, so no
    file content is read; the result is file metadata (one string per file),
    which is what a reader needs on the driver to plan its scan.
    """
    files = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
             .option("recursiveFileLookup", "true").load(root).select("path"))
    name = F.element_at(F.split("path", "/"), -1)
    keep = select_files(name, include_equals, include_prefixes, exclude_substrings)
    return sorted(r["path"] for r in files.filter(keep).collect())


# --- SRC-08 ---------------------------------------------------------------
def year_slices(spark: SparkSession, first: int, last: int) -> DataFrame:
    """One row per valid year from ``first`` to ``last`` (FLT-02 applied)."""
    years = spark.range(1).select(F.explode(F.sequence(F.lit(first), F.lit(last))).alias("ano"))
    return years.filter(C.valid_year(F.col("ano").cast("string")))


def in_years(df: DataFrame, first: int, last: int, col: str = "ano") -> DataFrame:
    """Keep rows of the valid years from ``first`` to ``last``: a range on the column, which prunes partitions and reaches the scan."""
    return df.filter(F.col(col).between(max(first, 2000), min(last, 2099)))
