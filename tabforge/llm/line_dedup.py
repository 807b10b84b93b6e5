"""Line dedup: explode normalised lines, hash, count distinct documents per hash,
drop lines over threshold, reassemble by position.  DataFrame functions only.

Plan: the text is scanned once for (document, position, line hash) rows, which are
pre-aggregated per hash (min and max document: no distinct lists); repeated keys are
joined back to the positions, and only the sorted list of dropped positions per
document travels to the text.  A key found in a third of all lines is joined by a
bounded broadcast (``join_heavy``), all others by a shuffle.

Defined results: a NULL text is one empty line; a NULL ``doc_id`` is one document that
comes after all others; rows that share a ``doc_id`` are one document for the count,
and each row is still returned; columns other than id and text pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WS_CHARS, ascii_lower, hash128, join_heavy, let, materialise

MIN_CHARS = 10


def line_dedup(docs: DataFrame, min_chars: int = MIN_CHARS, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """Columns: ``row`` (the input row as a struct), ``kept`` (the text without lines
    repeated from an earlier document), ``n_lines``, ``n_dropped``."""
    base = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("txt"))
    base = base.withColumn("th", F.xxhash64("txt"))
    lines = (base.select("id", "th", F.posexplode(F.split("txt", "\n")).alias("pos", "line"))
             .withColumn("key", ascii_lower(F.trim(F.col("line"), F.lit(WS_CHARS))))
             .where(F.char_length("key") >= min_chars)
             .select("id", "th", "pos", *hash128(F.col("key"))))
    lines = materialise(lines, "lines")
    repeated = (lines.groupBy("h1", "h2")
                .agg(F.min("id").alias("keeper"), F.max("id").alias("last"),
                     F.max(F.col("id").isNull()).alias("no_id"), F.count("*").alias("n"))
                .where((F.col("keeper") != F.col("last")) | (F.col("no_id") & F.col("keeper").isNotNull()))
                .select("h1", "h2", "keeper", "n"))
    repeated = materialise(repeated, "repeated-lines")
    drops = (join_heavy(lines, repeated, ["h1", "h2"], lines.count())
             .where(~F.col("id").eqNullSafe(F.col("keeper")))
             .groupBy(F.col("id").alias("d_id"), F.col("th").alias("d_th"))
             .agg(F.sort_array(F.collect_set("pos")).alias("drop")))
    out = base.join(drops, F.col("id").eqNullSafe(F.col("d_id")) & (F.col("th") == F.col("d_th")), "left")
    # The kept lines are the stretches between dropped positions: linear in the text.
    before = F.concat(F.array(F.lit(-1)), F.col("drop"))

    def stretches(ls):
        after = F.concat(F.col("drop"), F.array(F.size(ls)))
        return F.array_join(F.flatten(F.zip_with(before, after, lambda p, q: F.slice(ls, p + 2, q - p - 1))), "\n")

    kept = F.when(F.col("drop").isNull(), F.col("txt")).otherwise(let(F.split("txt", "\n"), stretches))
    return out.select("row", kept.alias("kept"), F.size(F.split("txt", "\n")).cast("long").alias("n_lines"),
                      F.coalesce(F.size("drop"), F.lit(0)).cast("long").alias("n_dropped"))


def drop_repeated_lines(docs: DataFrame, **kw) -> DataFrame:
    """Pipeline form: the same columns as ``docs`` with the kept text; ``n_chars``,
    where present, is counted anew."""
    out = line_dedup(docs, **kw)
    text_col = kw.get("text_col", "text")
    cols = []
    for c in docs.columns:
        if c == text_col:
            cols.append(F.col("kept").alias(c))
        elif c == "n_chars":
            cols.append(F.char_length("kept").cast(docs.schema[c].dataType).alias(c))
        else:
            cols.append(F.col("row")[c].alias(c))
    return out.select(*cols)
