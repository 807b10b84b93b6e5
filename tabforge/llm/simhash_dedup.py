"""SimHash near-dedup by anchor-point covering.

Fingerprints: 64 majority bits over the XXH64 values of word shingles.  Two texts are
linked when at most ``max_bits`` bits differ; groups are connected components.

Search.  The 64 bits are cut into ``blocks`` blocks; two fingerprints within
``max_bits`` agree up to ``t = max_bits // blocks`` bits in some block.  The anchors of
a block are the codewords of the perfect Hamming code of length 31 (63 for a single
block), whose covering radius is 1: every point has an anchor within distance 1.  For
two points at distance t take the point half-way between them; its anchor lies within
``1 + ceil(t / 2)`` of both (covering radius plus each side's part of the threshold),
so replicating every fingerprint to all anchors within that reach brings the pair
together.  With two blocks that is 16 anchors out of 2^26 per block and fingerprint.
One block (about 650 anchors out of 2^57) is the setting for billions of documents,
where buckets of the shorter code would fill up.

Per anchor.  Exact copies are one fingerprint beforehand.  Anchors holding more than
``CELL`` fingerprints are divided into cells and every pair of cells is a group of its
own, so no task gets an unbounded group.  Within a group a breadth-first search over
the not yet reached fingerprints finds the components of its links; each member is
joined to the smallest one (never all pairs).

Defined results: NULL or wordless texts have fingerprint zero and are linked like any
other; a NULL ``doc_id`` sorts after all others; rows that share an id are separate
rows of the result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import join_heavy, materialise, ship, text_buffers
from .graph import connected_components

SHINGLE_WORDS = 4
MAX_BITS = 4
BLOCKS = 2
CELL = 4096
_STEP = 1 << 16  # shingles hashed at a time


def fingerprint(text: bytes, k: int = SHINGLE_WORDS) -> int:
    """Unsigned 64-bit SimHash of one UTF-8 text."""
    from xxhash import xxh64_digest
    words = text.lower().split()  # bytes: A-Z only, and exactly the six white-space bytes
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(k, len(words))
    a, b = starts[:len(words) - k + 1].tolist(), ends[k - 1:].tolist()
    ones = np.zeros(64, np.int64)
    for i in range(0, len(a), _STEP):
        raw = b"".join([xxh64_digest(line[s:e], 42) for s, e in zip(a[i:i + _STEP], b[i:i + _STEP])])
        ones += np.unpackbits(np.frombuffer(raw, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(a)).tobytes(), "big")


def fingerprints(docs: DataFrame, k: int = SHINGLE_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, th, fp): th is a hash of the text, fp the fingerprint as a signed long."""
    def run(batches):
        import pyarrow as pa
        for batch in batches:
            data, off = text_buffers(batch.column(2))
            raw = data.tobytes()
            fps = np.array([fingerprint(raw[off[i]:off[i + 1]], k) for i in range(len(off) - 1)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fps.view(np.int64))],
                                             names=["doc_id", "th", "fp"])

    ship(docs.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit(""))
    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("th"), text.alias("text"))
            .mapInArrow(run, "doc_id long, th long, fp long"))


def _code(length: int, reach: int) -> list[np.ndarray]:
    """For each syndrome of the Hamming code: the error patterns of weight up to
    ``reach`` that lead from a word with this syndrome to a codeword."""
    found: list[list[int]] = [[] for _ in range(length + 1)]
    for w in range(reach + 1):
        for places in combinations(range(1, length + 1), w):
            s = 0
            for p in places:
                s ^= p
            found[s].append(sum(1 << (p - 1) for p in places))
    return [np.array(x, np.uint64) for x in found]


def _anchor_rows(blocks: int, max_bits: int):
    width = 64 // blocks
    length = width - 1  # the block's last bit takes no part in the code; dropping it shortens no distance up
    patterns = _code(length, 1 + -(-(max_bits // blocks) // 2))
    places = np.arange(1, length + 1, dtype=np.uint64)
    by_byte = np.zeros((8, 256), np.uint64)  # syndrome of each byte at each place
    for at in range(8):
        for bit in range(8):
            if at * 8 + bit < length:
                by_byte[at] ^= np.where(np.arange(256) >> bit & 1, places[at * 8 + bit], np.uint64(0))

    def run(frames):
        import pandas as pd
        for df in frames:
            fp = df["fp"].to_numpy().view(np.uint64)
            for b in range(blocks):
                v = (fp >> np.uint64(b * width)) & np.uint64((1 << length) - 1)
                s = np.zeros(len(v), np.uint64)
                for at in range(8):
                    s ^= by_byte[at][((v >> np.uint64(8 * at)) & np.uint64(255)).astype(np.int64)]
                for syndrome in np.unique(s):
                    own = s == syndrome
                    p = patterns[int(syndrome)]
                    anchors = (v[own][:, None] ^ p[None, :]).ravel()
                    yield pd.DataFrame({"block": np.int32(b), "anchor": anchors.view(np.int64),
                                        "fp": np.repeat(fp[own].view(np.int64), len(p))})
    return run


def _stars(fp: np.ndarray, max_bits: int) -> tuple[list, list]:
    """Components of the links among sorted distinct fingerprints, as edges from every
    member to its component's smallest."""
    child, parent = [], []
    rest = fp
    while len(rest) > 1:
        root, queue, rest = rest[0], [rest[0]], rest[1:]
        while queue and len(rest):
            near = np.bitwise_count(rest ^ queue.pop()) <= max_bits
            if near.any():
                got = rest[near]
                child.append(got)
                parent.append(np.full(len(got), root))
                queue.extend(got)
                rest = rest[~near]
    return child, parent


def _links(max_bits: int):
    def groups(frames) -> Iterator[np.ndarray]:
        """Fingerprints of each group; a partition's rows come sorted by group."""
        held_key, held = None, []
        for df in frames:
            key = df[["block", "anchor", "i", "j"]].to_numpy()
            fp = df["fp"].to_numpy().view(np.uint64)
            cut = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1
            bounds = [0, *cut.tolist(), len(fp)]
            for s, e in zip(bounds[:-1], bounds[1:]):
                k = tuple(key[s])
                if k != held_key:
                    if held:
                        yield np.concatenate(held)
                    held_key, held = k, []
                held.append(fp[s:e])
        if held:
            yield np.concatenate(held)

    def run(frames):
        import pandas as pd
        u, v, n = [], [], 0
        for fp in groups(f for f in frames if len(f)):
            if len(fp) == 2:
                if int(fp[0] ^ fp[1]).bit_count() <= max_bits:
                    u.append(fp[:1])
                    v.append(fp[1:])
                    n += 1
            else:
                c, p = _stars(np.unique(fp), max_bits)
                u += c
                v += p
                n += sum(map(len, c))
            if n >= 100_000:
                yield pd.DataFrame({"u": np.concatenate(u).view(np.int64), "v": np.concatenate(v).view(np.int64)})
                u, v, n = [], [], 0
        if n:
            yield pd.DataFrame({"u": np.concatenate(u).view(np.int64), "v": np.concatenate(v).view(np.int64)})
    return run


def near_links(fps: DataFrame, max_bits: int = MAX_BITS, blocks: int = BLOCKS) -> DataFrame:
    """Edges (u, v) between distinct fingerprints (column ``fp``) whose components are
    those of all pairs within ``max_bits``."""
    rows = fps.select("fp").mapInPandas(_anchor_rows(blocks, max_bits), "block int, anchor long, fp long")
    sizes = rows.groupBy("block", "anchor").count().where("count > 1")
    cells = F.ceil(F.col("count") / CELL).cast("int")
    own = F.pmod(F.xxhash64("fp"), cells).cast("int")
    # Both sides are made by Python from a small file and look as small to Spark: without a hint one is broadcast.
    pairs = (rows.join(sizes.hint("merge"), ["block", "anchor"])
             .select("block", "anchor", "fp", own.alias("own"), F.explode(F.sequence(F.lit(0), cells - 1)).alias("o"))
             .select("block", "anchor", "fp", F.least("own", "o").alias("i"), F.greatest("own", "o").alias("j")))
    return (pairs.repartition("block", "anchor", "i", "j").sortWithinPartitions("block", "anchor", "i", "j")
            .mapInPandas(_links(max_bits), "u long, v long"))


def simhash_groups(docs: DataFrame, k: int = SHINGLE_WORDS, max_bits: int = MAX_BITS, blocks: int = BLOCKS,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, th, fp, and ``first``, a struct naming the
    group's first document (no_id, doc_id, th)."""
    rows = materialise(fingerprints(docs, k, id_col, text_col), "fingerprints")
    me = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "th")
    distinct = materialise(rows.groupBy("fp").agg(F.min(me).alias("first"), F.count("*").alias("n")), "distinct-fp")
    roots = materialise(connected_components(near_links(distinct, max_bits, blocks)), "components")
    rooted = distinct.join(roots.hint("merge"), distinct.fp == roots.node, "left").select(
        "fp", "first", "n", F.coalesce("root", "fp").alias("root"))
    firsts = rooted.groupBy("root").agg(F.min("first").alias("first"), F.count("*").alias("n_fp"))
    # A root with many fingerprints is a hot key here, but only a (fp, first) pair wide.
    rooted, firsts = materialise(rooted.drop("first"), "rooted"), materialise(firsts, "firsts")
    by_fp = materialise(join_heavy(rooted, firsts, ["root"], rooted.count(), "n_fp").select("fp", "n", "first"),
                        "first-by-fp")
    return join_heavy(rows, by_fp, ["fp"], rows.count()).select("doc_id", "th", "fp", "first")


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """Pipeline form: one row of ``docs`` per group, that with the smallest id."""
    from pyspark.sql import Window

    def key(i, h):  # NULL-safe, and one partitioning for the join and the window
        return [F.coalesce(i, F.lit(0)).alias("k_id"), i.isNull().alias("k_nil"), h.alias("k_h")]

    first = simhash_groups(docs, id_col=id_col, text_col=text_col, **kw).select("first.*").distinct()
    first = first.select(*key(F.col("doc_id"), F.col("th")))
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.struct("*").alias("row"), *key(F.col(id_col).cast("long"), F.xxhash64(text)))
    kept = rows.join(first, ["k_id", "k_nil", "k_h"], "left_semi")
    # A row repeated as a whole is one document.
    once = F.row_number().over(Window.partitionBy("k_id", "k_nil", "k_h").orderBy("k_h"))
    return kept.withColumn("nth", once).where("nth = 1").select("row.*")
