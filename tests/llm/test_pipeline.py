"""The pipeline against brute force, stage by stage on what the stage before kept."""

import numpy as np
import pytest

import corpus_pipeline
from tabforge.llm import quality_llr, spaced_seed
from tabforge.llm import sentencepiece_scan as sps

from .test_brute import brute_components, brute_fingerprint, check_quality


@pytest.fixture(scope="module")
def stages(spark, sf_dir, tmp_path_factory):
    """Rows after each stage, the table ``documents`` first."""
    docs, out = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    out.append({r.doc_id: r for r in docs.collect()})
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("pipeline") / name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        rows = docs.collect()
        out.append({r.doc_id: r for r in rows})
        assert len(out[-1]) == len(rows)
    return out


def test_quality(spark, sf_dir, stages):
    labels: dict = {}
    for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect():
        labels.setdefault(r.doc_id, []).append(r.quality)
    rows = quality_llr.quality_rules(spark.read.parquet(f"{sf_dir}/documents.parquet"),
                                     spark.read.parquet(f"{sf_dir}/labels.parquet")).collect()
    check_quality([(r, r["row"].text) for r in rows], [(d, r.text) for d, r in stages[0].items()], labels)
    assert set(stages[1]) == {r["row"].doc_id for r in rows if r.kept}
    assert all(stages[1][d] == stages[0][d] for d in stages[1])
    rejected = [d for d in stages[0] if d not in stages[1]]
    assert not [d for d in rejected if labels.get(d) == [1] and len(stages[0][d].text.split()) >= 50]


def test_lines(stages):
    def key(x):
        return x.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})

    seen: dict = {}
    for d in sorted(stages[1]):
        for x in stages[1][d].text.split("\n"):
            seen.setdefault(key(x), []).append(d)
    assert set(stages[2]) == set(stages[1])
    for d, r in stages[1].items():
        kept = [x for x in r.text.split("\n") if len(key(x)) < 10 or len(set(seen[key(x)])) < 2 or seen[key(x)][0] == d]
        assert stages[2][d].text == "\n".join(kept) and stages[2][d].n_chars == len("\n".join(kept))
        assert stages[2][d].lang == r.lang and stages[2][d].source == r.source


def test_near_copies(stages):
    fps = {d: brute_fingerprint(r.text) for d, r in stages[2].items()}
    comp = brute_components(set(fps.values()))
    first: dict = {}
    for d in sorted(fps):
        first.setdefault(comp[fps[d]], d)
    assert set(stages[3]) == set(first.values())
    assert all(stages[3][d] == stages[2][d] for d in stages[3])


def test_benchmark(spark, sf_dir, stages):
    items = [r.text.lower().split() for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    number: dict = {}

    def tokens(ws):
        return np.array([number.setdefault(w, len(number)) for w in ws], np.int64)

    items = [tokens(x) for x in items if len(x) >= spaced_seed.MIN_TOKENS]

    def overlaps(doc, item):
        if len(np.intersect1d(doc, item)) < 4:
            return False
        w = min(spaced_seed.WINDOW, len(item))
        same = doc[:, None] == item[None, :]
        for diag in range(-len(item) + w, len(doc) - w + 1):
            line = np.diagonal(same, -diag)
            if len(line) >= w and np.convolve(line, np.ones(w, int), "valid").max() >= spaced_seed.MIN_AGREE * w:
                return True
        return False

    bad = {d for d, r in stages[3].items() if any(overlaps(tokens(r.text.lower().split()), i) for i in items)}
    assert set(stages[4]) == set(stages[3]) - bad


def test_pieces(spark, sf_dir, stages):
    v = sps.Pieces.of(None)
    assert set(stages[5]) == set(stages[4])
    for d, r in stages[5].items():
        assert v.decode(r.ids).decode() == stages[4][d].text and r.n_ids == len(r.ids)
        assert "text" not in r.asDict()
    assert sorted(r.doc_id for r in corpus_pipeline.run(spark, sf_dir).select("doc_id").collect()) == sorted(stages[5])
