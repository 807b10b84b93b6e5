"""Quality classifier by nearest-neighbour voting in a latent-semantic space.

Terms are hashed byte trigrams (``TERMS`` of them), weighted by log(1 + count) times the
inverse document frequency over all documents and brought to unit length, and the
shares of immediately repeated words, repeated lines, capital letters and symbols,
which trigrams blur.  The space is the truncated singular value decomposition of the
neighbours' term vectors.

Neighbours are at most ``MAX_NEIGHBOURS`` distinct labelled texts, the first by a hash
of the text, so copies count once and the broadcast is bounded (neighbours x DIMS
floats).  Every document is compared with all of them in blocks of exact cosine
products; its score is the share of label 1 among its ``VOTERS`` nearest, weighted by
similarity.

Defined results: NULL and empty texts have a zero vector and the neighbours' mean
label; without labelled rows every score is 1.0; repeated rows are scored each.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import hash128, materialise, ship, text_buffers, text_slices, text_tokens

TERMS = 1024
EXTRA = 4
EXTRA_WEIGHT = 5.0  # of the shares, beside trigram vectors of length 1
DAMP = 10           # words or lines (5 times as many bytes) added to the base of a share: one case in a short text is little
DIMS = 48
VOTERS = 15
MAX_NEIGHBOURS = 4096
BLOCK = 512


_CAPITAL = np.zeros(256, np.int64)
_CAPITAL[65:91] = 1
_SYMBOL = np.zeros(256, np.int64)
_SYMBOL[list(b"!#$%&*+/<=>?@[]^_{|}~")] = 1


def term_counts(data, off) -> np.ndarray:
    """Row per text: hashed byte trigrams, then the shares of repeated words, repeated
    lines, capital letters and symbols (symbols threefold, up to 1)."""
    n = len(off) - 1
    out = np.zeros((n, TERMS + EXTRA), np.float32)
    capitals = np.concatenate(([0], np.cumsum(_CAPITAL[data])))
    symbols = np.concatenate(([0], np.cumsum(_SYMBOL[data])))
    d = data.astype(np.uint32)
    if len(d) > 2:
        h = (d[:-2] * np.uint32(0x9E3779B1) + d[1:-1] * np.uint32(0x85EBCA77) + d[2:] * np.uint32(0xC2B2AE3D))
        h = ((h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)) >> np.uint32(22)  # 10 bits
    first, words, _, _ = text_tokens(data, off)
    same = np.concatenate(([False], words[1:] == words[:-1])) if len(words) else np.zeros(0, bool)
    for i in range(n):
        a, b = off[i], off[i + 1]
        if b - a > 2:
            out[i, :TERMS] = np.bincount(h[a:b - 2], minlength=TERMS)
        s, e = first[i], first[i + 1]
        if e - s > 1:
            out[i, TERMS] = same[s + 1:e].sum() / (e - s + DAMP)
        if b > a:
            lines = data[a:b].tobytes().split(b"\n")
            out[i, TERMS + 1] = (len(lines) - len(set(lines))) / (len(lines) + DAMP)
            out[i, TERMS + 2] = (capitals[b] - capitals[a]) / (b - a + 5 * DAMP)
            out[i, TERMS + 3] = min(1, 3 * (symbols[b] - symbols[a]) / (b - a + 5 * DAMP))
    return out


def _weighted(counts, idf):
    terms = np.log1p(counts[:, :TERMS]) * idf
    return np.hstack((unit(terms), EXTRA_WEIGHT * counts[:, TERMS:]))


def _document_frequency(docs: DataFrame, text_col: str) -> tuple[np.ndarray, int]:
    """Documents per term and their number: TERMS + 1 rows reach the driver."""
    def run(batches):
        import pyarrow as pa
        df = np.zeros(TERMS + 1, np.int64)
        for batch in batches:
            data, off = text_buffers(batch.column(0))
            for i, j in text_slices(off):
                c = term_counts(data[off[i]:off[j]], off[i:j + 1] - off[i])
                df[:-1] += (c[:, :TERMS] > 0).sum(axis=0)
                df[-1] += j - i
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(df))), pa.array(df)], names=["term", "df"])

    rows = (docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("t")).mapInArrow(run, "term long, df long")
            .groupBy("term").agg(F.sum("df").alias("df")).collect())
    df = np.zeros(TERMS + 1, np.int64)
    for r in rows:
        df[r.term] = r.df
    return df[:-1], int(df[-1])


def sample_labelled(docs: DataFrame, labels: DataFrame, label_col: str, limit: int, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(label, text) of at most ``limit`` distinct labelled texts, the first by hash;
    the label of a text is the rounded mean of its copies' labels."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    marks = labels.where(F.col(label_col).isNotNull()).groupBy(F.col("doc_id").alias("id")).agg(
        F.avg(label_col).alias("label"))
    hashed = docs.select(F.col(id_col).alias("id"), *hash128(text)).join(marks, "id")
    chosen = (hashed.groupBy("h1", "h2").agg(F.min("id").alias("id"), F.round(F.avg("label")).cast("int").alias("label"))
              .orderBy("h1", "h2").limit(limit).select("id", "label"))
    chosen = materialise(chosen, "sample")
    # At most `limit` ids: a bounded broadcast keeps all other texts out of the shuffle.
    found = docs.select(F.col(id_col).alias("id"), text.alias("text")).join(F.broadcast(chosen), "id")
    return found.dropDuplicates(["id"]).select("label", "text")


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text"):
    """(idf, projection, neighbours, their labels)."""
    df, n = _document_frequency(docs, text_col)
    idf = np.log((n + 1) / (df + 1)).astype(np.float32) + np.float32(0.1)

    def run(batches):
        import pyarrow as pa
        for batch in batches:
            data, off = text_buffers(batch.column(1))
            for i, j in text_slices(off):
                x = _weighted(term_counts(data[off[i]:off[j]], off[i:j + 1] - off[i]), idf)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(list(x), pa.list_(pa.float32()))],
                                                 names=["label", "x"])

    rows = (sample_labelled(docs, labels, "quality", MAX_NEIGHBOURS, id_col, text_col)
            .mapInArrow(run, "label int, x array<float>").toPandas())  # at most MAX_NEIGHBOURS vectors
    if not len(rows):
        return None
    x = np.stack(rows["x"].to_numpy()).astype(np.float32)
    _, vectors = np.linalg.eigh(x.T.astype(np.float64) @ x)
    project = np.ascontiguousarray(vectors[:, ::-1][:, :DIMS]).astype(np.float32)
    return idf, project, unit(x @ project), rows["label"].to_numpy().astype(np.float32)


def unit(z):
    return z / np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-9)


def vote(z, neighbours, labels, voters: int = VOTERS):
    """Similarity-weighted share of label 1 among the nearest neighbours."""
    sim = z @ neighbours.T
    k = min(voters, len(labels))
    near = np.argpartition(-sim, k - 1, axis=1)[:, :k]
    w = np.maximum(np.take_along_axis(sim, near, axis=1), 0) + 1e-9
    score = (w * labels[near]).sum(axis=1) / w.sum(axis=1)
    return np.where(np.abs(z).max(axis=1) < 1e-6, labels.mean(), score)


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) of every row of ``docs``; ``labels`` are those to learn from."""
    ship(docs.sparkSession)
    model = fit(docs, labels, id_col, text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    if model is None:
        return rows.select("doc_id", F.lit(1.0).alias("score"))
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        import pyarrow as pa
        idf, project, neighbours, marks = held.value
        for batch in batches:
            data, off = text_buffers(batch.column(1))
            score = np.zeros(len(off) - 1)
            for i, j in text_slices(off):
                for s in range(i, j, BLOCK):
                    e = min(s + BLOCK, j)
                    x = _weighted(term_counts(data[off[s]:off[e]], off[s:e + 1] - off[s]), idf)
                    score[s:e] = vote(unit(x @ project), neighbours, marks)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.clip(score, 0, 1))], names=["doc_id", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, score double")
