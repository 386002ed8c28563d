"""SentencePiece encoding and decoding by a max-plus scan over chunks.

The model is byte-pair encoding with byte fallback: the library merges the
best-scored neighbours first.  The same segmentation is the best path of a
max-plus dynamic program: an edge is a piece, and two pieces may follow each
other with weight 0 if the merges leave exactly that pair apart when run on
their joined text, else with weight minus infinity.  A sequence whose
neighbouring pairs are all stable is the encoding of its text, so exactly one
path has weight 0.

A giant document is split into chunks of ``CHUNK`` characters.  A boundary state
is the piece that starts last before the boundary, with its end (at or beyond
the boundary).  Each chunk gives, in a task of its own, the transfer matrix from
the states at its start to the states at its end: all weights are 0 or minus
infinity, so a row is a bit mask.  Matrices combine associatively
(:func:`combine`); the scan over a document's small matrices fixes the state at
each boundary, and then every chunk is traced back independently.  Where no
piece of the vocabulary spans two neighbouring characters, the path surely
breaks (a word border, mostly): the rows of a matrix are then all alike.

The text gets a space in front, and spaces become the mark U+2581; decoding
gives the text back (with that mark read as a space).

Defined cases: null and empty texts have no ids and decode to the empty text;
repeated rows and ids each get a row; an empty table gives an empty result;
other columns are ignored; characters outside the vocabulary become byte pieces.
"""

from __future__ import annotations

import re
import struct
import uuid
from collections.abc import Iterator
from functools import cache, reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regstat.llm.common import crc32, small_batches, staged, sub_batches

CHUNK = 1 << 15
MEMO = 200_000            # words per generation of a task's memo
MARK = "▁"
WORDS = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
RESULT = "doc_id long, n_tokens long, n_chunks int, ids_crc32 long, round_trip boolean, ids array<int>"


class Pieces:
    """The vocabulary and the stability of neighbouring pieces."""

    def __init__(self, model_file: str):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        plain = [i for i in range(model.get_piece_size()) if not (model.is_unknown(i) or model.is_control(i) or model.is_byte(i) or model.is_unused(i))]
        self.id = {model.id_to_piece(i): i for i in plain}
        self.score = {p: model.get_score(i) for p, i in self.id.items()}
        self.byte_id = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.longest = max(map(len, self.id))
        self.raw = [b""] * model.get_piece_size()
        for p, i in self.id.items():
            self.raw[i] = p.replace(MARK, " ").encode()
        for b, i in enumerate(self.byte_id):
            self.raw[i] = bytes([b])
        self.joined = {p[i:i + 2] for p in self.id for i in range(len(p) - 1) if p[i] in self.id and p[i + 1] in self.id}
        self.reach: dict[str, int] = {}           # four characters -> length of the longest piece that ends in them
        for p in self.id:
            if len(p) >= 4:
                self.reach[p[-4:]] = max(self.reach.get(p[-4:], 0), len(p))
        self._stable: dict[tuple[str, str], bool] = {}
        self._name = {p: p for p in self.id}      # one string object per piece
        self._young: dict[str, bytes] = {}
        self._old: dict[str, bytes] = {}
        self._packed = {p: struct.pack("<H", i) for p, i in self.id.items()}
        self._reached = {p for p in self.id if self.merged(p) == [p]}

    def merged(self, text: str) -> list[str]:
        """The merges themselves, best score first, leftmost of equals; for texts of a few characters."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = self.score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if at < 0:
                return parts
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def whole(self, piece: str) -> bool:
        """The piece is in the vocabulary and the merges reach it."""
        return piece in self._reached

    def stable(self, left: str, right: str) -> bool:
        """Weight 0 (else minus infinity) of ``right`` following ``left``."""
        got = self._stable.get((left, right))
        if got is None:
            if len(self._stable) >= 2 * MEMO:
                self._stable.clear()
            got = self._stable[self._name.get(left, left), self._name.get(right, right)] = left[-1] + right[0] not in self.joined or self.merged(left + right) == [left, right]
        return got

    def breaks(self, text: str, at: int) -> bool:
        """No piece spans the characters before and after ``at``."""
        return text[at - 1:at + 1] not in self.joined

    def ids_of(self, piece: str) -> list[int]:
        i = self.id.get(piece)
        return [i] if i is not None else [self.byte_id[b] for b in piece.encode()]

    def segments(self, sorted_texts: list[str]) -> Iterator[bytes]:
        """Packed ids of the weight-0 path of each text.

        One piece ends the path of each prefix, whatever follows, so
        neighbours in sorted order share the part of their common prefix.
        """
        reached, known, reach, packed = self._reached, self._stable, self.reach, self._packed
        last, before = [""], ""
        for text in sorted_texts:
            same = 0
            for x, y in zip(text, before, strict=False):
                if x != y:
                    break
                same += 1
            del last[same + 1:]
            for end in range(same + 1, len(text) + 1):
                for start in range(max(0, end - reach.get(text[end - 4:end], 3) if end > 3 else 0), end):
                    piece = text[start:end]
                    if piece in reached:
                        if not start:
                            break
                        ok = known.get((last[start], piece))
                        if ok is None:
                            ok = self.stable(last[start], piece)
                        if ok:
                            break
                last.append(piece)          # at the latest the character alone, in the vocabulary or not
            path, at = [], len(text)
            while at:
                piece = last[at]
                path.append(packed.get(piece) or self._pack(piece))
                at -= len(piece)
            before = text
            yield b"".join(path[::-1])

    def _pack(self, piece: str) -> bytes:
        """Packed ids of a character outside the vocabulary (kept if there is room)."""
        ids = self.ids_of(piece)
        out = struct.pack(f"<{len(ids)}H", *ids)
        if len(self._packed) < 4 * len(self.id):
            self._packed[piece] = out
        return out

    def learn(self, words: set[str]) -> None:
        """Remembers the packed ids of texts that start and end at breaks; two generations, so frequent ones stay."""
        if len(self._young) + len(words) > MEMO:
            self._old, self._young = self._young, {}
        young, old = self._young, self._old
        unmet = words.difference(young)
        young.update((w, old[w]) for w in unmet if w in old)
        new = sorted(unmet.difference(young))
        young.update(zip(new, self.segments(new), strict=True))

    def forget(self) -> None:
        """Drops the words met: a worker process outlives its tasks and goes on to other stages."""
        self._young, self._old = {}, {}

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Packed ids of marked texts that start and end at breaks: word by word, since nothing spans a character and a mark after it."""
        words = [WORDS.findall(t) for t in texts]
        self.learn(set().union(*words))
        return [b"".join(map(self._young.__getitem__, ws)) for ws in words]

    def encode(self, text: str) -> bytes:
        return self.encode_batch([text])[0]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.raw.__getitem__, np.frombuffer(ids, "<u2").tolist()))


@cache
def pieces(model_file: str) -> Pieces:
    return Pieces(model_file)


def marked(text: str) -> str:
    return MARK + text.replace(" ", MARK) if text else ""


# ---- chunks of giant documents -----------------------------------------------------------------------------------------------------------

def states(v: Pieces, text: str, at: int) -> list[tuple[int, int]]:
    """(start, end) relative to ``at`` of the pieces that may start last before it; one state (0, 0) at a break or an end of the text."""
    if at == 0 or at == len(text) or v.breaks(text, at):
        return [(0, 0)]
    out = []
    for start in range(max(0, at - v.longest), at):
        for end in range(at, min(len(text), start + v.longest) + 1):
            if v.whole(text[start:end]):
                out.append((start - at, end - at))
    return out


def _forward(v: Pieces, text: str, nodes: dict[int, dict[str, int]], lo: int, hi: int) -> None:
    """Extends ``nodes`` (place -> piece that ends there -> bit mask of sources; "" is a break) by the pieces that start in [lo, hi)."""
    for at in range(lo, hi):
        here = nodes.get(at)
        if not here:
            continue
        if at > lo and v.breaks(text, at):
            here = nodes[at] = {"": reduce(int.__or__, here.values())}
        for end in range(at + 1, min(len(text), at + v.longest) + 1):
            piece = text[at:end]
            if v.whole(piece) or end == at + 1:
                mask = 0
                for left, m in here.items():
                    if not left or v.stable(left, piece):
                        mask |= m
                if mask:
                    nodes.setdefault(end, {})
                    nodes[end][piece] = nodes[end].get(piece, 0) | mask
            if end < len(text) and v.breaks(text, end):
                break


def _first_break(v: Pieces, text: str, lo: int, hi: int, step: int) -> int | None:
    return next((i for i in (range(lo, hi) if step > 0 else range(hi - 1, lo - 1, -1)) if v.breaks(text, i)), None)


def _start_nodes(v: Pieces, text: str, lo: int, sources: list[tuple[int, int]]) -> dict[int, dict[str, int]]:
    nodes: dict[int, dict[str, int]] = {}
    for bit, (a, b) in enumerate(sources):
        nodes.setdefault(lo + b, {})
        piece = text[lo + a:lo + b]
        nodes[lo + b][piece] = nodes[lo + b].get(piece, 0) | 1 << bit
    return nodes


def _row(v: Pieces, text: str, hi: int, nodes: dict[int, dict[str, int]], targets: list[tuple[int, int]]) -> list[int]:
    """For each target state the mask of sources that reach it."""
    if targets == [(0, 0)]:
        return [reduce(int.__or__, nodes.get(hi, {}).values(), 0)]
    return [nodes.get(hi + b, {}).get(text[hi + a:hi + b], 0) for a, b in targets]


def transfer(v: Pieces, text: str, lo: int, hi: int) -> list[int]:
    """The chunk [lo, hi): for each state at ``hi`` the mask of states at ``lo`` from which a path of weight 0 leads to it.

    ``text`` holds the chunk with up to ``longest`` characters around it.
    """
    sources, targets = states(v, text, lo), states(v, text, hi)
    nodes = _start_nodes(v, text, lo, sources)
    first = _first_break(v, text, lo + 1, hi, 1)
    if first is not None:
        _forward(v, text, nodes, lo, first)
        through = reduce(int.__or__, nodes.get(first, {}).values(), 0)
        last = _first_break(v, text, first, hi, -1)
        tail = {last: {"": 1}}
        _forward(v, text, tail, last, hi)
        return [through if m else 0 for m in _row(v, text, hi, tail, targets)]
    _forward(v, text, nodes, lo, hi)
    return _row(v, text, hi, nodes, targets)


def combine(a: list[int], b: list[int]) -> list[int]:
    """Max-plus product of two transfer matrices with weights 0 and minus infinity (associative)."""
    return [reduce(int.__or__, (m for i, m in enumerate(a) if row >> i & 1), 0) for row in b]


def fixed_states(matrices: list[list[int]]) -> list[tuple[int, int]]:
    """(state at the start, state at the end) of each chunk on the one path of weight 0."""
    reach, before = [1], []               # the document starts in its only state
    for m in matrices:
        before.append(reach)
        reach = combine(reach, m)
    out, state = [], next(i for i, m in enumerate(reach) if m)
    for m, reached in zip(matrices[::-1], before[::-1], strict=True):
        start = next(i for i, r in enumerate(reached) if r and m[state] >> i & 1)
        out.append((start, state))
        state = start
    return out[::-1]


def trace(v: Pieces, text: str, lo: int, hi: int, start: int, end: int) -> tuple[bytes, int, int]:
    """Packed ids of the pieces that start in [lo, hi), and the stretch of text they cover, given the states at both ends."""
    a, b = states(v, text, lo)[start]
    c, d = states(v, text, hi)[end]
    begin, final = lo + b, hi + d
    first = _first_break(v, text, begin + 1, hi, 1) if begin < hi else None
    if first is None:
        return _path(v, text, begin, hi, final, text[lo + a:begin], text[hi + c:final]), begin, final
    last = _first_break(v, text, first, hi, -1)
    head = _path(v, text, begin, first, first, text[lo + a:begin], "") if begin < first else b""
    return head + v.encode(text[first:last]) + _path(v, text, last, hi, final, "", text[hi + c:final]), begin, final


def _path(v: Pieces, text: str, begin: int, hi: int, final: int, left: str, right: str) -> bytes:
    """Packed ids of the path over a stretch without breaks, from ``begin`` (after the piece ``left``) to ``final`` (its last piece ``right``, if known)."""
    nodes = {begin: {left: 1}}
    _forward(v, text, nodes, begin, hi)
    path, at, piece = [], final, right or next(iter(nodes[final]))
    while at > begin:
        path.append(piece)
        at -= len(piece)
        if at > begin:
            piece = next(p for p in nodes[at] if v.stable(p, piece))
    return np.array([i for p in path[::-1] for i in v.ids_of(p)], "<u2").tobytes()


# ---- Spark -------------------------------------------------------------------------------------------------------------------------------

def _result(doc_ids: pa.Array, chunks: list[int], ids: list[bytes], same: list[bool]) -> pa.RecordBatch:
    sizes = np.array([len(x) // 2 for x in ids], np.int64)
    flat = np.frombuffer(b"".join(ids), "<u2").astype(np.int32)
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    crcs = [crc32(x) for x in np.split(flat.astype("<u4"), offsets[1:-1])] if len(ids) else []
    return pa.RecordBatch.from_arrays([doc_ids.cast(pa.int64()), pa.array(sizes), pa.array(chunks, pa.int32()), pa.array(crcs, pa.int64()), pa.array(same),
                                       pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))],
                                      names=["doc_id", "n_tokens", "n_chunks", "ids_crc32", "round_trip", "ids"])


def _short(docs: DataFrame, model_file: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = pieces(model_file)
        for batch in sub_batches(batches, 1024):
            text = [marked(t or "") for t in batch.column(1).to_pylist()]
            ids = v.encode_batch(text)
            same = [v.decode(i) == t.replace(MARK, " ").encode() for i, t in zip(ids, text, strict=True)]
            yield _result(batch.column(0), [min(len(t), 1) for t in text], ids, same)
        v.forget()
    return docs.mapInArrow(run, RESULT)


def _chunks(docs: DataFrame, model_file: str, chunk: int) -> DataFrame:
    """One row a chunk of each long document: row (a name for the document's row), place and the text with what lies around it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        around = pieces(model_file).longest
        for batch in sub_batches(batches, 1):
            text, row = marked(batch.column(1)[0].as_py()), uuid.uuid4().hex
            doc_id = batch.column(0)[0].as_py()
            starts = range(0, len(text), chunk)
            for some in (starts[i:i + 64] for i in range(0, len(starts), 64)):
                parts = [(doc_id, row, at // chunk, min(at, around), min(at, around) + min(chunk, len(text) - at),
                          text[max(0, at - around):at + chunk + around]) for at in some]
                yield pa.RecordBatch.from_pylist([dict(zip(("doc_id", "row", "chunk", "lo", "hi", "text"), p, strict=True)) for p in parts],
                                                 pa.schema([("doc_id", pa.int64()), ("row", pa.string()), ("chunk", pa.int32()), ("lo", pa.int32()),
                                                            ("hi", pa.int32()), ("text", pa.string())]))
    return docs.mapInArrow(run, "doc_id long, row string, chunk int, lo int, hi int, text string")


def _transfers(chunks: DataFrame, model_file: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = pieces(model_file)
        for batch in sub_batches(batches, 64):
            rows = batch.to_pydict()
            masks = [[str(m) for m in transfer(v, t, lo, hi)] for t, lo, hi in zip(rows["text"], rows["lo"], rows["hi"], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(masks, pa.list_(pa.string()))], names=["row", "chunk", "masks"])
    return chunks.select("row", "chunk", "text", "lo", "hi").mapInArrow(run, "row string, chunk int, masks array<string>")


def _fixed(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("chunk")
    ends = fixed_states([[int(m) for m in masks] for masks in pdf["masks"]])
    return pd.DataFrame({"row": pdf["row"], "chunk": pdf["chunk"], "first": [a for a, _ in ends], "last": [b for _, b in ends]})


def _traced(chunks: DataFrame, model_file: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = pieces(model_file)
        for batch in sub_batches(batches, 64):
            rows = batch.to_pydict()
            ids, same = [], []
            for t, lo, hi, a, b in zip(rows["text"], rows["lo"], rows["hi"], rows["first"], rows["last"], strict=True):
                packed, begin, final = trace(v, t, lo, hi, a, b)
                ids.append(packed)
                same.append(v.decode(packed) == t[begin:final].replace(MARK, " ").encode())
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(3)), pa.array(ids, pa.binary()), pa.array(same)],
                                             names=["doc_id", "row", "chunk", "packed", "same"])
        v.forget()
    return chunks.select("doc_id", "row", "chunk", "text", "lo", "hi", "first", "last").mapInArrow(
        run, "doc_id long, row string, chunk int, packed binary, same boolean")


def _gathered(traced: DataFrame) -> DataFrame:
    """A document's chunks put together: its ids, as bounded as the text value they come from."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sub_batches(batches, 16):
            rows = batch.to_pydict()
            yield _result(batch.column(0), rows["n"], [b"".join(p) for p in rows["packed"]], rows["same"])
    parts = traced.groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.count(F.lit(1)).cast("int").alias("n"),
                                      F.array_sort(F.collect_list(F.struct("chunk", "packed"))).getField("packed").alias("packed"), F.min("same").alias("same"))
    return parts.select("doc_id", "n", "packed", "same").mapInArrow(run, RESULT)


def encode(docs: DataFrame, model_file: str, chunk: int = CHUNK) -> DataFrame:
    """Ids of every document, with the check that they decode to its text (``RESULT``)."""
    plain = small_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")))
    long = F.length("text") >= chunk
    parts = staged(_chunks(plain.filter(long), model_file, chunk), "chunks")
    spread = parts.repartition("row", "chunk")           # a giant document's chunks go to many tasks
    ends = _transfers(spread, model_file).groupBy("row").applyInPandas(_fixed, "row string, chunk int, first int, last int")
    traced = staged(_traced(parts.join(ends, ["row", "chunk"]), model_file), "traced")
    return _short(plain.filter(~long), model_file).unionByName(_gathered(traced))
