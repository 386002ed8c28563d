"""SRC-09: incremental load — a file already handled is never loaded again.

A Structured Streaming file source over the *names* of the files, with
``trigger(availableNow=True)``: each run takes exactly the files that arrived since
the last run and stops.  Every micro-batch reads its own files by their own
headers and commits them as one version of a table, together with its batch
number: a batch that is started again after it was published loads nothing, one that
failed before leaves the table as it was.  The checkpoint (in the shared folder) is
the "already seen" list.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources import versions
from ..sources.readers import _java_encoding, cp1252_fix, cp1252_fix_name, file_headers, header_fields

#: What the stream reads of a file.
NAMES = "path string, modificationTime timestamp, length long, content binary"


def each_batch_of_files(spark: SparkSession, in_dir: str, checkpoint: str, handle: Callable[[list[str], int], int],
                        max_files_per_trigger: int | None = None, timeout_s: int | None = None) -> int:
    """Call ``handle(files, batch)`` for the files of ``in_dir`` not seen before, however old they are; returns the sum of its results.

    ``handle`` may be called again with the same batch after a failure.  A run is only stopped by time if ``timeout_s`` is given.
    """
    reader = spark.readStream.format("binaryFile").schema(NAMES).option("recursiveFileLookup", "true").option("maxFileAge", "36500d")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    results: dict[int, int] = {}
    failed: list[Exception] = []

    def batch_of(names: DataFrame, batch: int) -> None:
        files = sorted(r["path"] for r in names.collect())           # names only: one row a file
        try:
            if files:
                results[batch] = handle(files, batch)
        except Exception as ex:
            failed.append(ex)
            raise

    query = (reader.load(in_dir).select("path").writeStream.foreachBatch(batch_of)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    try:
        if timeout_s is None:
            query.awaitTermination()
        elif not query.awaitTermination(timeout_s):
            raise TimeoutError("incremental load did not finish")
    except StreamingQueryException as ex:
        raise failed[0] if failed else ex                            # the batch's own error, not the stream's
    finally:
        if query.isActive:
            query.stop()
    return sum(results.values())


def load_new_files(spark: SparkSession, in_dir: str, out_dir: str, checkpoint: str, schema: T.StructType,
                   fmt: str = "csv", encoding: str = "cp1252", sep: str = ";",
                   transform: Callable[[DataFrame], DataFrame] | None = None,
                   partition_by: Sequence[str] = (), max_files_per_trigger: int | None = None,
                   timeout_s: int | None = None) -> int:
    """Load files of one layout from ``in_dir``, those not seen before, into the versioned table ``out_dir``.

    A batch with a text file whose header is not the schema's is refused as a whole.
    Returns the number of rows this run loaded.
    """
    java_enc = _java_encoding(encoding)

    def load(files: list[str], batch: int) -> int:
        reader = spark.read.schema(schema).option("basePath", in_dir.rstrip("/"))
        if fmt == "csv":
            check_headers(spark, files, schema, encoding, sep)
            reader = reader.option("sep", sep).option("header", "true").option("encoding", java_enc)
        df = reader.format(fmt).load(files)
        if fmt == "csv" and java_enc != encoding:
            df = df.select([cp1252_fix(c).alias(cp1252_fix_name(c)) if isinstance(f.dataType, T.StringType)
                            else F.col(c) for c, f in zip(df.columns, df.schema.fields)])
        df = df.withColumn("arquivo", F.col("_metadata.file_name"))
        version = versions.commit(transform(df) if transform else df, out_dir, partition_by, versions.nothing,
                                  transaction=(checkpoint, batch), metrics={"linhas": F.count(F.lit(1))})
        return version.notes["metrics"]["linhas"]

    return each_batch_of_files(spark, in_dir, checkpoint, load, max_files_per_trigger, timeout_s)


def check_headers(spark: SparkSession, files: Sequence[str], schema: T.StructType, encoding: str, sep: str) -> None:
    """Every text file's header must be the schema's columns in order (a repeated header carries its index, as Spark's reader names it)."""
    for row in file_headers(spark, files, encoding).collect():
        named, file = header_fields(row["header"], sep), row["path"]
        folders = {p.split("=", 1)[0] for p in file.split("/")[:-1] if "=" in p}
        want = [c for c in schema.fieldNames() if c not in folders]
        if [c.lower() for c in named] != [c.lower() for c in want]:
            raise ValueError(f"{file}: its header is not this layout's; it differs in {sorted(set(named) ^ set(want)) or 'the order'}")
