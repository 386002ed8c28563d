"""The pipeline: stages, columns, and every stage's decisions against its operator's plain version."""

import corpus_pipeline as c
import __spark_entry__ as entry

from regstat.llm import decontaminate, queries
from regstat.llm.common import staged, table

from . import odd
from .test_near_dup import brute as near_copies
from .test_repeats import brute as repeated

SF = "/root/testdata/sf0.001"


def test_registered():
    assert [n for n, _ in c.STAGES] == ["quality_rules", "near_duplicates", "repeated_strings", "decontamination", "encoding"]
    names = [q for q in entry.queries() if q.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry.queries() and set(queries.QUERIES) <= set(entry.queries())


def test_stages(spark):
    docs = table(spark, SF, "documents")
    for name, stage in c.STAGES:
        before = {r["doc_id"]: r for r in docs.collect()}
        out = staged(stage(spark, docs, SF), name)
        after = {r["doc_id"]: r for r in out.collect()}
        assert set(after) <= set(before) and out.count() == len(after)
        if name != "encoding":
            assert out.columns == docs.columns
        if name == "quality_rules":
            assert all(len(r["text"].split()) >= 20 for r in after.values()) and len(after) > 0.7 * len(before)
        if name == "near_duplicates":
            assert set(after) == {i for i, (comp, _) in near_copies({i: r["text"] for i, r in before.items()}, 5).items() if comp == i}
        if name == "repeated_strings":
            want = {r[0]: r[1] - r[2] for r in repeated(sorted((i, r["text"]) for i, r in before.items()))}
            assert set(after) == set(before) and all(0 <= want[i] - len(r["text"].encode()) <= 6 and r["n_chars"] == len(r["text"]) for i, r in after.items())
        if name == "decontamination":
            bench = [r["text"] for r in table(spark, SF, "benchmark").collect()]
            held = {i for i, r in before.items() if any(" ".join(t.split()) in " ".join(r["text"].split()) for t in bench)}
            assert set(after).isdisjoint(held)
        if name == "encoding":
            library = __import__("sentencepiece").SentencePieceProcessor(model_file=queries.tokenizer_path(queries.PIECE_MODEL))
            assert {i: r["ids"] for i, r in after.items()} == {i: library.encode(r["text"]) for i, r in before.items()}
        docs = out
    assert c.run(spark, SF).count() == docs.count()


def test_odd_documents(spark):
    for some in (None, []):
        docs = odd.docs(spark, some)
        for name, stage in c.STAGES[:-1]:
            docs = staged(stage(spark, docs, SF), name)
            assert docs.columns == odd.DOCS.names
        assert c.STAGES[-1][1](spark, docs, SF).count() == docs.count()


def test_paraphrase_check_is_shared():
    item, = decontaminate.items_of([(1, b"One two three four. Five six seven.")])
    assert item.answer == [b"five", b"six", b"seven"]
