"""Helpers shared by the training-data operators.

* reading: a document table may have NULLs in any column, repeated rows and extra
  columns; operators take the columns they need by name and treat a NULL text as
  the empty text.
* ``materialise``: cut lineage by a Parquet table in the shared scratch folder (with
  ``scratch_path`` from the session module).
* ``join_heavy``: equi-join against a unique-key table that stays balanced when one
  key holds a third of the rows.
* ``text_tokens``: words of a whole Arrow batch of texts as numpy arrays.
"""

from __future__ import annotations

import os
import tempfile
import zipfile

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabforge.session import materialise, scratch_path  # noqa: F401  (used by the operators)

#: White space of every contract: space and U+0009 .. U+000D.
WS_CHARS = " \t\n\x0b\x0c\r"
WS_CLASS = r"[\x20\x09-\x0D]"

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_shipped: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Send this package to the Python workers once per application, so that operators
    also run where it is not installed on the executors."""
    sc = spark.sparkContext
    if sc.applicationId not in _shipped:
        top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        path = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="tabforge-code-")), "tabforge.zip")
        with zipfile.ZipFile(path, "w") as z:
            for folder, _, names in os.walk(top):
                for name in names:
                    if name.endswith(".py"):
                        file = os.path.join(folder, name)
                        z.write(file, os.path.relpath(file, os.path.dirname(top)))
        sc.addPyFile(path)
        _shipped.add(sc.applicationId)
    return spark


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once per row.  A plain column would be
    inlined by the optimizer and evaluated again inside every lambda call."""
    return F.element_at(F.transform(F.array(value), body), 1)


def hash128(*cols: Column) -> list[Column]:
    """Two independently seeded 64-bit hashes: equality stands for equality of the
    values (2^-128 per pair)."""
    return [F.xxhash64(*cols).alias("h1"), F.xxhash64(F.lit(1), *cols).alias("h2")]


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only.  Pure ASCII values take the built-in; others (where
    ``lower`` would also change accented letters) go through ``translate``."""
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(
        F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


HEAVY_SHARE = 1024


def join_heavy(left: DataFrame, right: DataFrame, on: list[str], total: int, n: str = "n") -> DataFrame:
    """Inner join of ``left`` to ``right`` (one row per key) when a few keys may hold
    a large share of ``left``; column ``n`` of ``right`` counts the key's rows there.

    Keys with more than ``total / HEAVY_SHARE`` rows number fewer than
    ``HEAVY_SHARE`` whatever the data: their right rows are broadcast under that
    bound.  Every other key holds a smaller share and takes the shuffle join (by a hint:
    files of numbers that repeat are far smaller than their rows in the driver's memory).
    Both inputs are read twice, so they should be materialised.
    """
    heavy = right.where(F.col(n) > total / HEAVY_SHARE).limit(HEAVY_SHARE)
    hot = left.join(F.broadcast(heavy), on)
    cold = left.join(F.broadcast(heavy.select(*on)), on, "left_anti").join(
        right.where(F.col(n) <= total / HEAVY_SHARE).hint("merge"), on)
    return hot.unionByName(cold)


# ------------------------------------------------------------------ Arrow text batches

def text_buffers(col):
    """(bytes, offsets) of an Arrow string column; a NULL is the empty text."""
    import pyarrow as pa
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if not pa.types.is_large_string(col.type):
        col = col.cast(pa.large_string())
    if col.null_count:
        col = col.fill_null("")
    off = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + len(col) + 1]
    raw = col.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and len(col) else np.empty(0, np.uint8)
    if len(off) == 0:
        off = np.zeros(1, np.int64)
    return data[off[0]:off[-1]], off - off[0]


def text_slices(offsets, limit: int = 1 << 21):
    """Ranges [i, j) of consecutive texts holding about ``limit`` bytes (one longer
    text makes a range of its own): bounds the arrays made per step."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


_WS = np.zeros(256, bool)
_WS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += 32
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX1, _MIX2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)


def mix64(x):
    """Finaliser of a 64-bit hash (bijective)."""
    x = x ^ (x >> np.uint64(33))
    x = x * _MIX1
    x = x ^ (x >> np.uint64(33))
    x = x * _MIX2
    return x ^ (x >> np.uint64(33))


def text_tokens(data, offsets, inside=None):
    """Words ``[^\\x20\\x09-\\x0D]+`` of consecutive texts, A-Z lower-cased (or the
    runs of the byte values marked in ``inside``).

    Returns (first, hashes, starts, ends): text t has words ``first[t]:first[t+1]``;
    ``hashes`` are 64-bit values of the lower-cased UTF-8 bytes and their length;
    starts and ends are byte positions in ``data``.  A word never spans two texts.
    """
    n = len(data)
    if n == 0:
        z = np.zeros(0, np.int64)
        return np.zeros(len(offsets), np.int64), np.zeros(0, np.uint64), z, z
    word = ~_WS[data] if inside is None else inside[data]
    begin = word.copy()
    begin[1:] &= ~word[:-1]
    cuts = offsets[(offsets > 0) & (offsets < n)]
    begin[cuts] |= word[cuts]  # a text may begin right behind the last word of another
    starts = np.flatnonzero(begin)
    if len(starts) == 0:
        z = np.zeros(0, np.int64)
        return np.zeros(len(offsets), np.int64), np.zeros(0, np.uint64), z, z
    stop = np.empty(n, bool)
    stop[:-1] = ~word[1:]
    stop[-1] = True
    stop[cuts - 1] = True
    ends = np.flatnonzero(stop & word) + 1
    lens = ends - starts
    at = np.flatnonzero(word)
    rel = at - np.repeat(starts, lens)
    powers = np.full(int(lens.max()), _BASE)
    powers[0] = 1
    powers = np.multiply.accumulate(powers)
    vals = (_LOWER[data[at]] + np.uint64(1)) * powers[rel]
    heads = np.concatenate(([0], np.cumsum(lens)[:-1]))
    hashes = mix64(np.add.reduceat(vals, heads) + lens.astype(np.uint64))
    return np.searchsorted(starts, offsets), hashes, starts, ends
