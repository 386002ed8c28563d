"""Record files and piece encoding against the libraries; exact round trips."""

import random
import zlib

import numpy as np
import pytest

from regstat.llm import piece_encoding, queries, records
from regstat.llm.common import table

from . import odd

WORDS, PIECES = queries.tokenizer_path(queries.WORD_TOKENIZER), queries.tokenizer_path(queries.PIECE_MODEL)
MIXED = ["a", "b", "the", "tion", " ", "  ", "é", "日", "\n", "🤗", "x", "=", "----", "oo", ".", ",", "▁", "0", "12", "s", "'", "in", "er", "re", "!!", "THE", "\x01",
         "<|endoftext|>", "\u00a0", "\u0301", "'s", "\t"]


def word_library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(WORDS)


def piece_library():
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


def test_frames():
    for payload in (b"", b"x", bytes(range(256)) * 5):
        framed = records.frame(payload)
        assert records.unframe(framed) == payload and len(framed) == len(payload) + 16
        for at in range(0, len(framed), 7):
            with pytest.raises(ValueError):
                records.unframe(framed[:at] + bytes([framed[at] ^ 1]) + framed[at + 1:])


def test_word_ids_match_library():
    library, memo = word_library(), records.WordIds(WORDS, "<u2")
    assert memo.lower_cased and memo.parts_marks and memo.bar is not None
    rng = random.Random(4)
    texts = ["".join(rng.choice(MIXED) for _ in range(rng.randint(0, 30))) for _ in range(1500)]
    got = memo.encode([t.encode() for t in texts])
    for t, ids in zip(texts, got, strict=True):
        assert np.frombuffer(ids, "<u2").tolist() == library.encode(t, add_special_tokens=False).ids, repr(t)


def test_small_memo(monkeypatch):
    monkeypatch.setattr(records, "MEMO_WORDS", 5)
    library, memo = word_library(), records.WordIds(WORDS, "<u2")
    for texts in (["one two three four", "five six"], ["one six seven eight", "nine two, two."], ["one two five"]):
        assert [np.frombuffer(i, "<u2").tolist() for i in memo.encode([t.encode() for t in texts])] == [
            e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("some", ["documents", None, []])
def test_record_files(spark, some):
    docs = table(spark, "/root/testdata/sf0.001", "documents") if some == "documents" else odd.docs(spark, some)
    index = records.write_records(docs, records.fresh_folder(spark), WORDS, 2)
    out = records.with_starts(records.read_records(index)).collect()
    library = word_library()
    want = sorted(((r["doc_id"], r["text"] or "") for r in docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0))
    assert len(out) == len(want)
    out = sorted(out, key=lambda r: (r["start"]))
    start = 0
    ids = {}
    for i, t in want:
        e = library.encode(t, add_special_tokens=False).ids + [2]
        ids.setdefault(i, []).append((len(e), zlib.crc32(np.asarray(e, "<u4").tobytes())))
    for r, (doc_id, _) in zip(out, want, strict=True):
        assert r["doc_id"] == doc_id and r["start"] == start and (r["n_tokens"], r["ids_crc32"]) in ids[doc_id]
        start += r["n_tokens"]
    # shuffled reads seek by the index alone
    again = records.read_records(index.orderBy("length", "doc_id")).collect()
    assert sorted((r["shard"], r["offset"], r["ids_crc32"]) for r in again) == sorted((r["shard"], r["offset"], r["ids_crc32"]) for r in out)


def test_pieces_match_library():
    v, library = piece_encoding.pieces(PIECES), piece_library()
    rng = random.Random(3)
    texts = ["", " ", "  a", *("".join(rng.choice(MIXED) for _ in range(rng.randint(0, 40))) for _ in range(1500))]
    for t, ids in zip(texts, v.encode_batch([piece_encoding.marked(t) for t in texts]), strict=True):
        assert np.frombuffer(ids, "<u2").tolist() == library.encode(t), repr(t)
        assert v.decode(ids).decode() == (" " + t.replace("▁", " ") if t else "")


def cut(v, text, chunk):
    m, around = piece_encoding.marked(text), v.longest
    return [(m[max(0, at - around):at + chunk + around], min(at, around), min(at, around) + min(chunk, len(m) - at)) for at in range(0, len(m), chunk)]


def test_chunks_match_library():
    """Chunks cut anywhere, also inside words and in text without any break."""
    v, library = piece_encoding.pieces(PIECES), piece_library()
    rng = random.Random(8)
    solid = ["a", "b", "the", "tion", "oo", "s", "in", "er", "re", "=", "--", "ab", "an", "x", "1"]
    for k in range(300):
        t = "".join(rng.choice(MIXED if k % 3 == 0 else solid) for _ in range(rng.randint(30, 300)))
        parts = cut(v, t, rng.choice([17, 20, 33, 64]))
        ends = piece_encoding.fixed_states([piece_encoding.transfer(v, *p) for p in parts])
        got = [i for p, e in zip(parts, ends, strict=True) for i in np.frombuffer(piece_encoding.trace(v, *p, *e)[0], "<u2").tolist()]
        assert got == library.encode(t), repr(t)


def test_transfer_matrices_combine_associatively():
    v = piece_encoding.pieces(PIECES)
    ms = [piece_encoding.transfer(v, *p) for p in cut(v, "abthetionooinerre" * 12, 20)]
    a, b, c = ms[2:5]
    assert piece_encoding.combine(piece_encoding.combine(a, b), c) == piece_encoding.combine(a, piece_encoding.combine(b, c))


@pytest.mark.parametrize("some, chunk", [("documents", 200), (None, 64), (None, piece_encoding.CHUNK), ([], 64)])
def test_encode_frames(spark, some, chunk):
    docs = table(spark, "/root/testdata/sf0.001", "documents") if some == "documents" else odd.docs(spark, some)
    out = piece_encoding.encode(docs, PIECES, chunk).collect()
    library = piece_library()
    want = sorted(((r["doc_id"], tuple(library.encode(r["text"] or ""))) for r in docs.collect()), key=repr)
    assert sorted(((r["doc_id"], tuple(r["ids"])) for r in out), key=repr) == want
    for r in out:
        assert r["round_trip"] and r["n_tokens"] == len(r["ids"]) and r["ids_crc32"] == zlib.crc32(np.asarray(r["ids"], "<u4").tobytes())
