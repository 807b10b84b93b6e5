"""Token counts as delta-maintained rollups.

A rollup keeps additive totals (documents, tokens) by source, language and tokenizer
version.  Batches carry signed facts about documents: ``set`` (an insert or a revised
count) and ``delete``.  A batch is turned into ledger entries, minus what the document
contributed before and plus what it contributes now, so totals change by the sum of
the batch's entries and are never counted anew.

Commit protocol.  A batch writes ``ledger/batch=N`` and ``deltas/batch=N`` (both
overwritten on a retry; they are computed from earlier batches only) and then the
marker ``commits/batch=N``.  Readers use marked batches only; applying a marked batch
again changes nothing.  Batches are numbered in the order they must be applied.

Defined results: ids may be of any type and are kept as text; facts without id cannot be revised or deleted
and are not counted (the query names rows without id by a hash of their content first);
of several facts about one document and version in a batch, the last by ``seq`` counts
(the larger count on a tie), so a repeated row counts once; deleting an unknown
document does nothing; NULL source and language are groups of their own; a NULL text
has no tokens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ship, text_buffers

KEY = ["doc_id", "version"]
GROUP = ["source", "lang", "version"]
LEDGER = "doc_id string, version string, source string, lang string, d_docs long, d_tokens long"
DELTAS = "source string, lang string, version string, d_docs long, d_tokens long"


class TokenRollup:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _committed(self) -> list[int]:
        root = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/commits")
        fs = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(root):
            return []
        return sorted(int(s.getPath().getName().split("=")[1]) for s in fs.listStatus(root)
                      if fs.exists(self.spark._jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS")))

    def _read(self, kind: str, batches: list[int], schema: str) -> DataFrame:
        if not batches:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{kind}/batch={b}" for b in batches])

    def apply(self, batch: int, facts: DataFrame) -> bool:
        """Apply one batch of facts (doc_id, version, source, lang, op, n_tokens, seq);
        False if it was committed before."""
        done = self._committed()
        if batch in done:
            return False
        if done and batch < done[-1]:
            raise ValueError(f"batch {batch} comes after batch {done[-1]} was committed")
        last = (facts.where("doc_id is not null").withColumn("doc_id", F.col("doc_id").cast("string")).groupBy(*KEY)
                .agg(F.max(F.struct("seq", "n_tokens", "op", "source", "lang")).alias("f"))
                .select(*KEY, "f.*"))
        # Only the batch's documents are looked up, before anything is summed.
        before = (self._read("ledger", done, LEDGER).join(last.select(*KEY), KEY, "left_semi")
                  .groupBy(*KEY, "source", "lang").agg(F.sum("d_docs").alias("d_docs"), F.sum("d_tokens").alias("d_tokens"))
                  .where("d_docs <> 0 or d_tokens <> 0"))
        minus = before.select(*KEY, "source", "lang", (-F.col("d_docs")).alias("d_docs"),
                              (-F.col("d_tokens")).alias("d_tokens"))
        plus = last.where("op <> 'delete'").select(*KEY, "source", "lang", F.lit(1).cast("long").alias("d_docs"),
                                                   F.col("n_tokens").cast("long").alias("d_tokens"))
        entries = (minus.unionByName(plus).groupBy(*KEY, "source", "lang")
                   .agg(F.sum("d_docs").alias("d_docs"), F.sum("d_tokens").alias("d_tokens"))
                   .where("d_docs <> 0 or d_tokens <> 0"))
        entries.write.mode("overwrite").parquet(f"{self.path}/ledger/batch={batch}")
        (self._read("ledger", [batch], LEDGER).groupBy(*GROUP)
         .agg(F.sum("d_docs").alias("d_docs"), F.sum("d_tokens").alias("d_tokens"))
         .write.mode("overwrite").parquet(f"{self.path}/deltas/batch={batch}"))
        self.spark.range(1).write.mode("overwrite").parquet(f"{self.path}/commits/batch={batch}")
        return True

    def totals(self) -> DataFrame:
        """(source, lang, version, n_docs, n_tokens) of the committed batches."""
        return (self._read("deltas", self._committed(), DELTAS).groupBy(*GROUP)
                .agg(F.sum("d_docs").alias("n_docs"), F.sum("d_tokens").alias("n_tokens")).where("n_docs <> 0"))


_encoders: dict = {}


def _encoder(folder: str | None, name: str):
    """A tiktoken encoding, loaded once per worker."""
    if (folder, name) not in _encoders:
        import base64
        import os

        import public_tokenizers
        import tiktoken
        file = os.path.join(folder, name) if folder else public_tokenizers.path(name)
        with open(file, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _encoders[folder, name] = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                                    special_tokens={})
    return _encoders[folder, name]


def with_token_counts(docs: DataFrame, text_col: str = "text", vocabulary: str = "byte_bpe_50k.tiktoken",
                      folder: str | None = None, out: str = "n_tokens") -> DataFrame:
    """``docs`` without its text, with the text's number of tokens."""
    ship(docs.sparkSession)
    rest = [c for c in docs.columns if c != text_col]

    def run(batches):
        import pyarrow as pa
        enc = _encoder(folder, vocabulary)
        for batch in batches:
            data, off = text_buffers(batch.column(len(rest)))
            raw = data.tobytes()
            n = [len(enc.encode_ordinary(raw[off[i]:off[i + 1]].decode("utf-8", "replace"))) for i in range(len(off) - 1)]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(rest))), pa.array(n, pa.int64())],
                                             names=[*rest, out])

    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in rest)
    return docs.select(*[F.col(f"`{c}`") for c in rest], F.coalesce(F.col(text_col), F.lit("")).alias(text_col)).mapInArrow(
        run, f"{schema}, {out} long")
