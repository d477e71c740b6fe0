"""The pipeline's stages on planted cases, and as a whole."""

import zlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from gridframe.llm import packing
from gridframe.llm.tokens import WordEncoder
from tests.llm.conftest import DOCS, prose

EN = [f"{a}{b}{c}" for a in ("th", "wh", "o", "in") for b in ("ea", "ou", "io") for c in ("nd", "st", "re", "ly", "sh", "ing")]
FR = [f"{a}{b}" for a in ("eau", "qu", "é", "pai", "r") for b in ("aux", "elle", "oi", "ment", "tion", "è")]


def planted(spark, folder):
    item = prose(900, 40, EN)
    texts = [prose(k, 150, EN if k % 2 else FR) for k in range(40)]
    texts += [texts[3], texts[4].replace(" ", "  "), "", None, "1234 !!", texts[5] + " " + item + " " + texts[7], prose(77, 60, EN) + ' token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" ' + prose(78, 60, EN)]
    rows = [(k, t, "en" if k % 2 else "fr", "s", None if t is None else len(t)) for k, t in enumerate(texts)]
    spark.createDataFrame(rows, DOCS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(0, item), (1, "tiny")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return texts


def test_stages(spark, tmp_path):
    folder = f"{tmp_path}/sf"
    texts = planted(spark, folder)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    gone = {"language": {42, 43, 44}, "near_dedup": {40, 41}, "decontaminate": {45}, "secrets": set()}
    left = set(range(len(texts)))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, folder)
        assert after.columns == DOCS.names
        after = spark.createDataFrame(after.collect(), DOCS)
        left -= gone[name]
        assert {r.doc_id for r in after.collect()} == left, name
        docs = after
    kept = {r.doc_id: r.text for r in docs.collect()}
    assert "[SECRET]" in kept[46] and "24be64439e" not in kept[46]
    assert all(kept[k] == texts[k] for k in kept if k != 46)
    tokenizer = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    pieces = corpus_pipeline.run(spark, folder).collect()
    assert {r.doc_id for r in pieces} == left
    for k in left:
        ids = np.array([*tokenizer.encode(kept[k], add_special_tokens=False).ids, 2], "<u4")
        own = sorted((r for r in pieces if r.doc_id == k), key=lambda r: r.start)
        assert sum(r.length for r in own) == len(ids) and all(r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length]) for r in own)


def test_names_and_queries():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_dedup", "decontaminate", "secrets", "pack"]
    known = __spark_entry__.queries()
    assert "pipeline" in known and [n for n in range(1, 11) if sum(q.startswith(f"op{n}_") for q in known) != 1] == []
    assert set(__spark_entry__.oracle_sql()) <= set(known)


def test_odd_tables(spark, tmp_path):
    """Repeated rows, null ids, columns with operators' own names, and a benchmark without rows; then no documents at all."""
    folder = f"{tmp_path}/odd"
    texts = [prose(k, 60, EN if k % 2 else FR) for k in range(12)]
    rows = [(k, t, "en" if k % 2 else "fr", "s", len(t)) for k, t in enumerate(texts)]
    rows += [rows[3], rows[3], (None, texts[5] + " more", "en", "s", 1), (None, None, None, None, None), (90, "", "en", "s", 0)]
    docs = spark.createDataFrame(rows, DOCS).selectExpr("*", *(f"'clash' AS {n}" for n in ("score", "words", "piece", "length", "copy", "h")))
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, folder).collect(), docs.schema)
    assert sorted(r.doc_id for r in docs.where("doc_id IS NOT NULL").collect()) == list(range(12)) and docs.where("text IS NULL OR text = ''").count() == 0
    assert {r.doc_id for r in corpus_pipeline.run(spark, folder).collect()} >= set(range(12))
    empty = f"{tmp_path}/empty"
    spark.createDataFrame([], DOCS).write.parquet(f"{empty}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{empty}/benchmark.parquet")
    assert corpus_pipeline.run(spark, empty).count() == 0


def test_pack_encodes_little_at_a_time(make, monkeypatch):
    """The last stage's workers stand beside executors that the stages before have filled: a megabyte of texts, and one text more, is encoded together; the pieces don't depend on it."""
    texts = [prose(k, 3000) for k in range(200)]
    rows = pa.RecordBatch.from_pydict({"doc_id": range(len(texts)), "text": texts})
    seen, encode = [], WordEncoder.encode_column
    monkeypatch.setattr(WordEncoder, "encode_column", lambda self, column: seen.append(sum(map(len, column.to_pylist()))) or encode(self, column))
    monkeypatch.setattr(packing, "mapped", lambda df, fn, schema: pa.Table.from_batches(fn(iter([rows]))))
    monkeypatch.setattr(packing.TaskContext, "get", lambda: type("Task", (), {"partitionId": lambda self: 0})())
    small = corpus_pipeline.pack(None, make([]), "")
    assert max(seen) <= (1 << 20) + max(map(len, texts)) and sum(seen) == sum(map(len, texts)) > 3 << 20
    seen.clear()
    assert small.equals(packing.pack(make([]), P.path("word_bpe_49k.json"))) and len(seen) == 1
