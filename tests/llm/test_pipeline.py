"""The pipeline's stages on tables with awkward cases, and their order."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from helpers import edge_docs, empty_docs, sf_docs, words
from tidelog.llm import line_dedup, line_frequency, packing, simhash


def written(spark, docs, scratch):
    docs.write.parquet(f"{scratch}/documents.parquet")
    return docs


@pytest.fixture
def sequences(spark, scratch):
    def run(docs):
        written(spark, docs, scratch)
        return corpus_pipeline.run(spark, scratch)
    return run


COLUMNS = ["doc_id", "piece", "start", "length", "ids_crc32", "position", "sequence_id", "offset"]


def test_stages_keep_the_documents_columns(spark, scratch):
    docs = written(spark, edge_docs(spark), scratch)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, scratch)
        assert out.schema.simpleString() == docs.schema.simpleString(), name
        path = f"{scratch}/{name.replace(' ', '-')}"
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        sizes = docs.filter("text IS NOT NULL").select("text", "n_chars").collect()
        assert all(r.n_chars == len(r.text) for r in sizes), name
    last = corpus_pipeline.STAGES[-1][1](spark, docs, scratch)
    assert last.columns == COLUMNS


def test_an_empty_table_and_edge_rows(spark, sequences):
    assert sequences(empty_docs(spark)).collect() == []


def test_stages_equal_their_parts(spark, scratch):
    """Each stage's decision against the operator it calls."""
    docs = written(spark, sf_docs(spark), scratch)
    rules = corpus_pipeline.quality_rules(spark, docs, scratch)
    kept = {r.doc_id for r in line_frequency.verdicts(docs).filter("kept").collect()}
    assert {r.doc_id for r in rules.collect()} == kept
    lines = corpus_pipeline.line_dedup_stage(spark, rules, scratch)
    seen, want = {}, {}
    for r in sorted(rules.collect(), key=lambda r: r.doc_id):
        out = []
        for line in (r.text or "").split("\n"):
            k = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\f\r"))
            if len(k) < line_dedup.MIN_CHARS or seen.setdefault(k, r.doc_id) == r.doc_id:
                out.append(line)
        want[r.doc_id] = "\n".join(out)
    assert {r.doc_id: r.text for r in lines.collect()} == want
    near = {r.doc_id: r.component_id for r in simhash.near_duplicates(lines).collect()}
    alone = corpus_pipeline.simhash_near_dedup(spark, lines, scratch)
    assert {r.doc_id for r in alone.collect()} == {i for i, c in near.items() if i == c}
    mixed = corpus_pipeline.mixing(spark, alone, scratch)
    texts = {r.doc_id: r.text for r in alone.collect()}
    assert all(texts[r.doc_id] == r.text for r in mixed.collect())


def test_sequences_come_in_training_order(spark, sequences, scratch):
    """Early documents are in early sequences, at no more than 1% more sequences
    than packing by length alone, and every piece has its place."""
    out = sequences(sf_docs(spark, "/root/testdata/sf0.01"))
    rows = out.collect()
    assert out.columns == COLUMNS
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append(r)
    assert sorted(by) == list(range(len(by)))
    means = []
    for k in sorted(by):
        at = 0
        for r in sorted(by[k], key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= packing.CAPACITY
        means.append(sum(r.position for r in by[k]) / len(by[k]))
    assert means == sorted(means)
    assert len(by) <= 1.01 * -(-sum(r.length for r in rows) // packing.CAPACITY) + 1
    # The position is the rank of the document in the mixed table.
    positions = sorted({r.position for r in rows})
    assert positions == [float(k) for k in range(len(positions))]


def test_documents_without_files_have_no_order(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string")
    assert {r._position for r in corpus_pipeline.in_written_order(docs).collect()} == {0}
