"""NULLs, empty and very long texts, ties, repeated rows, empty tables, clashing names."""

from collections import Counter

import pytest

import corpus_pipeline
from tabforge.llm import context_mixing, line_dedup, quality_knn, quality_llr, secret_scan, sentencepiece_scan
from tabforge.llm import simhash_dedup, spaced_seed, toxicity

from .conftest import edge_rows

ALWAYS = ["doc_id", "text", "lang", "source", "n_chars"]


def ids(rows):
    return Counter(r["doc_id"] for r in rows)


EXPECTED = Counter(r[0] for r in edge_rows())


def test_every_row_comes_back(edge_docs, edge_labels):
    for out in (simhash_dedup.simhash_groups(edge_docs).select("doc_id"),
                quality_llr.quality_rules(edge_docs, edge_labels).select("row.doc_id"),
                secret_scan.secret_spans(edge_docs).select("doc_id"),
                toxicity.toxicity_scores(edge_docs, edge_labels).select("doc_id"),
                quality_knn.quality_scores(edge_docs, edge_labels).select("doc_id"),
                line_dedup.line_dedup(edge_docs).select("row.doc_id"),
                sentencepiece_scan.encode(edge_docs).select("row.doc_id"),
                context_mixing.lm_scores(edge_docs, edge_docs["doc_id"].isNotNull()).select("doc_id")):
        assert ids(out.collect()) == EXPECTED


def test_empty_tables(spark, no_docs, edge_labels, edge_items):
    no_labels, no_items = edge_labels.limit(0), edge_items.limit(0)
    assert simhash_dedup.simhash_groups(no_docs).count() == 0
    assert simhash_dedup.keep_first(no_docs).count() == 0
    assert quality_llr.quality_rules(no_docs, no_labels).count() == 0
    assert secret_scan.secret_spans(no_docs).count() == 0
    assert toxicity.toxicity_scores(no_docs, no_labels).count() == 0
    assert quality_knn.quality_scores(no_docs, no_labels).count() == 0
    assert line_dedup.line_dedup(no_docs).count() == 0
    assert sentencepiece_scan.encode(no_docs).count() == 0
    assert sentencepiece_scan.decode(sentencepiece_scan.encode(no_docs)).count() == 0
    assert context_mixing.lm_scores(no_docs, no_docs["doc_id"].isNotNull()).count() == 0
    assert spaced_seed.contaminated(no_docs, no_items).count() == 0
    assert spaced_seed.contaminated(no_docs, edge_items).count() == 0


def test_nothing_to_learn_from(edge_docs, edge_labels, edge_items):
    none = edge_labels.limit(0)
    assert {r.score for r in toxicity.toxicity_scores(edge_docs, none).collect()} == {0.0}
    assert {r.score for r in quality_knn.quality_scores(edge_docs, none).collect()} == {1.0}
    llr = quality_llr.quality_rules(edge_docs, none).collect()
    assert all(r.kept != r.base_failed for r in llr)
    assert spaced_seed.contaminated(edge_docs, edge_items.limit(0)).count() == 0
    rows = context_mixing.lm_scores(edge_docs, edge_docs["doc_id"].isNull() & edge_docs["doc_id"].isNotNull()).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 and r.base_score == 0 and r.score <= 0 for r in rows)


def test_empty_texts(edge_docs, edge_labels):
    rows = {r.doc_id: r for r in simhash_dedup.simhash_groups(edge_docs).collect()}
    assert rows[4].fp == rows[5].fp == rows[6].fp == 0
    assert rows[4]["first"].doc_id == rows[6]["first"].doc_id
    rows = {r["row"].doc_id: r for r in line_dedup.line_dedup(edge_docs).collect()}
    assert rows[4].n_lines == rows[5].n_lines == 1 and rows[4].kept == ""
    rows = {r["row"].doc_id: r for r in sentencepiece_scan.encode(edge_docs).collect()}
    assert rows[4].ids == rows[5].ids == []
    rows = {r.doc_id: r for r in secret_scan.secret_spans(edge_docs).collect()}
    assert rows[4].spans == []
    rows = {r.doc_id: r for r in context_mixing.lm_scores(edge_docs, edge_docs["doc_id"] > 5).collect()}
    assert rows[4].n_tokens == 1 and rows[4].score == rows[5].score


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages(spark, tmp_path, edge_docs, no_docs, edge_labels, edge_items, name):
    edge_labels.write.parquet(str(tmp_path / "labels.parquet"))
    edge_items.write.parquet(str(tmp_path / "benchmark.parquet"))
    stage = dict(corpus_pipeline.STAGES)[name]
    out = stage(spark, edge_docs, str(tmp_path))
    out.write.parquet(str(tmp_path / "out"))
    got = spark.read.parquet(str(tmp_path / "out"))
    if name != "sentencepiece":
        assert got.columns == edge_docs.columns
    kept = ids(got.collect())
    assert not kept - EXPECTED
    if name == "quality_rules":
        assert 18 not in kept and 4 not in kept and kept[1] == kept[7] == 1 and kept[11] == 2
    if name in ("line_dedup", "sentencepiece"):
        assert kept == EXPECTED
    if name == "simhash_near_dedup":
        assert kept[1] == kept[11] == 1 and kept[2] == kept[8] == kept[5] == 0 and kept[4] == kept[7] == 1
        assert kept[None] == 0  # copies of documents with an id
    if name == "benchmark_decontamination":
        bad = {r[0] for r in edge_rows() if r[1] and "".join(edge_items.first().text.split()) in "".join(r[1].split())}
        assert bad and EXPECTED - kept == Counter({d: n for d, n in EXPECTED.items() if d in bad} | (
            {None: 1} if None in bad else {}))
    assert stage(spark, no_docs, str(tmp_path)).count() == 0


def test_stages_return_document_columns(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, sf_dir).columns == ALWAYS, name
