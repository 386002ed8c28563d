"""Token ids in length-delimited binary record files.

File format (one ``.rec`` file per range of ids, records in ascending doc_id
order)::

    u64  length of the payload            little-endian
    u32  masked crc32 of those 8 bytes
    payload: the ids, u16 if the vocabulary fits, else u32
    u32  masked crc32 of the payload

The mask rotates the checksum right by 15 bits and adds a constant, so a
checksum over bytes that hold checksums stays sound.  The offset index is a
Parquet table beside the files (shard, offset, length, doc_id): a
reader seeks to any record without scanning, which is what shuffled reads do.

Writing: documents are range-partitioned by id and sorted in their partition;
each task encodes its texts and writes one file under a name of its own, and
only the rows a successful task returns enter the index, so a retried task
leaves at most an unindexed file.  Reading verifies both checksums.

The tokenizer file drops white space before anything else, so a text's ids
are the ids of its space-separated words one after the other: each different
word is encoded by the library once per worker process (a bounded memo).

Defined cases: a null or empty text has the end id only; rows with a null id
come first; repeated ids stay as records of their own; an empty table gives an
empty index; other columns are ignored.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from regstat.llm.common import crc32, local_dir, small_batches, sub_batches, texts
from regstat.session import scratch_path

MASK_DELTA = 0xA282EAD8      # fixed value of the masked-checksum format
MEMO_WORDS = 800_000         # words per generation of a worker process's memo
BAR = b"\x01"                 # parts words in a text of many
MARKED = re.compile(rb"^(.*[A-Za-z0-9])([.,;:!?]+)$")
INDEX = "shard int, file string, offset long, length long, doc_id long"


def masked(data: bytes) -> int:
    c = crc32(data)
    return (((c >> 15) | (c << 17)) + MASK_DELTA) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    head = struct.pack("<Q", len(payload))
    return b"".join((head, struct.pack("<I", masked(head)), payload, struct.pack("<I", masked(payload))))


def unframe(data: bytes) -> bytes:
    """The payload of one framed record; raises if a length or checksum is wrong."""
    head, payload = data[:8], data[12:-4]
    if len(data) < 16 or struct.unpack("<Q", head)[0] != len(payload) or struct.unpack("<I", data[8:12])[0] != masked(head):
        raise ValueError("record length is damaged")
    if struct.unpack("<I", data[-4:])[0] != masked(payload):
        raise ValueError("record payload is damaged")
    return payload


class WordIds:
    """word -> its packed ids: the new words of a batch are encoded at once.

    Two generations of at most ``MEMO_WORDS`` words are remembered: words met
    again move to the young one, so frequent words stay.
    """

    def __init__(self, tokenizer_file: str, dtype: str):
        from tokenizers import Tokenizer
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer, self.dtype = Tokenizer.from_file(tokenizer_file), np.dtype(dtype)
        lower, upper, apart, bar, barred = (self._ids([t])[0] for t in ("az 9.,", "AZ 9.,", "az 9 .,", BAR.decode(), f"az {BAR.decode()} 9.,"))
        self.lower_cased, self.parts_marks = lower == upper, apart == lower
        self.bar = bar[0] if len(bar) == 1 and barred == lower[:1] + bar + lower[1:] else None
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _packed(self, words: list[bytes]) -> Iterator[bytes]:
        """Packed ids of each word: many words go to the library as one text, with a word of one control character between them."""
        if self.bar is None:
            yield from (np.asarray(ids, self.dtype).tobytes() for ids in self._ids([w.decode() for w in words]))
            return
        for at in range(0, len(words), 4096):
            some = words[at:at + 4096]
            ids = np.array(list(chain.from_iterable(self._ids([(b" %b " % BAR).join([*some[i:i + 256], b""]).decode() for i in range(0, len(some), 256)]))), self.dtype)
            data, ends = ids.tobytes(), (np.flatnonzero(ids == self.bar) * ids.itemsize).tolist()
            start = 0
            for end in ends:
                yield data[start:end]
                start = end + ids.itemsize

    def learn(self, words: set[bytes]) -> None:
        """Remembers the ids of all ``words``."""
        if len(self.young) + len(words) > MEMO_WORDS:
            self.old, self.young = self.young, {}
        young, old = self.young, self.old
        unmet = words.difference(young)
        young.update((w, old[w]) for w in unmet if w in old)
        unmet = unmet.difference(young)
        barred = {w for w in unmet if BAR in w}          # a word with the parting character in it goes alone
        young.update(zip(barred, (np.asarray(i, self.dtype).tobytes() for i in self._ids([w.decode() for w in barred])), strict=True))
        unmet -= barred
        # marks after a letter or digit are pieces of their own: "word," and "word." share "word"
        cut = {w: m.groups() for w in unmet if (m := MARKED.match(w))} if self.parts_marks else {}
        new = list({p for parts in cut.values() for p in parts}.union(unmet.difference(cut)).difference(young))
        young.update(zip(new, self._packed(new), strict=True))
        for w, (word, marks) in cut.items():
            young[w] = young[word] + young[marks]

    def encode(self, batch: list[bytes]) -> list[bytes]:
        """Packed ids of each text."""
        # ASCII white space, all of which the tokenizer drops, parts the words; capitals are lowered early unless a special token may be about
        words = [(t.lower() if self.lower_cased and b"<|" not in t else t).split() for t in batch]
        ids = [list(map(self.young.get, ws)) for ws in words]
        gaps = [(ws, found, _gaps(found)) for ws, found in zip(words, ids, strict=True) if None in found]
        if gaps:
            self.learn({ws[k] for ws, _, at in gaps for k in at})
            for ws, found, at in gaps:
                for k in at:
                    found[k] = self.young[ws[k]]
        return list(map(b"".join, ids))


def _gaps(found: list) -> list[int]:
    """Places of None."""
    out, at = [], -1
    for _ in range(found.count(None)):
        at = found.index(None, at + 1)
        out.append(at)
    return out


@cache
def word_ids(tokenizer_file: str, dtype: str) -> WordIds:
    """One memo for all tasks that a worker process runs."""
    return WordIds(tokenizer_file, dtype)


def write_records(docs: DataFrame, folder: str, tokenizer_file: str, end_id: int, dtype: str = "<u2") -> DataFrame:
    """Encodes and writes every document; returns the index, read back from ``folder/index``."""
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        words, path, offset, out = word_ids(tokenizer_file, dtype), None, 0, None
        end = np.asarray([end_id], dtype).tobytes()
        try:
            for batch in sub_batches(batches, 2048):
                if out is None:
                    os.makedirs(local_dir(folder), exist_ok=True)
                    path = f"{local_dir(folder)}/{shard:06d}-{uuid.uuid4().hex}.rec"
                    out = open(path, "wb")
                offsets, lengths = [], []
                for ids in words.encode(texts(batch)):
                    framed = frame(ids + end)
                    out.write(framed)
                    offsets.append(offset)
                    lengths.append(len(framed))
                    offset += len(framed)
                n = batch.num_rows
                yield pa.RecordBatch.from_arrays([pa.array([shard] * n, pa.int32()), pa.array([path] * n, pa.string()), pa.array(offsets, pa.int64()),
                                                  pa.array(lengths, pa.int64()), batch.column(0).cast(pa.int64())],
                                                 names=["shard", "file", "offset", "length", "doc_id"])
        finally:
            if out is not None:
                out.flush()
                os.fsync(out.fileno())
                out.close()

    spark = docs.sparkSession
    ordered = small_batches(docs).select(F.col("doc_id").cast("long"), F.col("text").cast("string")).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(write, INDEX).write.parquet(f"{folder}/index")
    return spark.read.schema(INDEX).parquet(f"{folder}/index")


def read_records(index: DataFrame, dtype: str = "<u2") -> DataFrame:
    """Per indexed record: shard, offset, doc_id, n_tokens, ids_crc32, read from the files in any order."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, f = None, None
        for batch in batches:
            rows = batch.to_pydict()
            n, crcs = [], []
            for file, offset, length in zip(rows["file"], rows["offset"], rows["length"], strict=True):
                if file != path:
                    if f is not None:
                        f.close()
                    path, f = file, open(file, "rb")
                if f.tell() != offset:
                    f.seek(offset)
                ids = np.frombuffer(unframe(f.read(length)), dtype)
                n.append(len(ids))
                crcs.append(crc32(ids.astype("<u4").tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array(rows["shard"], pa.int32()), pa.array(rows["offset"], pa.int64()), pa.array(rows["doc_id"], pa.int64()),
                                              pa.array(n, pa.int64()), pa.array(crcs, pa.int64())],
                                             names=["shard", "offset", "doc_id", "n_tokens", "ids_crc32"])
        if f is not None:
            f.close()

    return index.mapInArrow(read, "shard int, offset long, doc_id long, n_tokens long, ids_crc32 long")


def with_starts(records: DataFrame) -> DataFrame:
    """Adds ``start``, the ids before each record: summed inside each file, plus the totals of the files before (one row a file)."""
    before = (Window.unboundedPreceding, -1)
    inside = records.withColumn("inside", F.coalesce(F.sum("n_tokens").over(Window.partitionBy("shard").orderBy("offset").rowsBetween(*before)), F.lit(0)))
    files = records.groupBy("shard").agg(F.sum("n_tokens").alias("total"))
    bases = files.select("shard", F.coalesce(F.sum("total").over(Window.orderBy("shard").rowsBetween(*before)), F.lit(0)).alias("base"))
    return inside.join(bases, "shard").withColumn("start", F.col("base") + F.col("inside")).drop("base", "inside")


def fresh_folder(spark: SparkSession) -> str:
    return scratch_path(spark, "records")
