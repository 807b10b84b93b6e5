"""Hard negatives by score windows, over Hilbert-ordered blocks with zone maps.

Rows are quantised, ordered along a Hilbert curve through the dimensions with the largest
variance and cut into blocks of about ``BLOCK_BYTES``: one Parquet row each, with the
smallest and largest value of every dimension (its zone map) and its labels.  Interval
arithmetic on a zone map bounds every inner product of an anchor with the block:
``sum(max(a*lo, a*hi))`` from above, ``sum(min(a*lo, a*hi))`` from below.

1. The anchors of one block travel together.  Inside their own block they find preliminary
   positives; the k-th best score is a threshold.
2. Every bundle of anchors visits the zone maps (chunks of ``Layout.chunk`` blocks) and asks for the
   blocks that hold its label and whose upper bound reaches the threshold.  Asked chunks and
   their bundles meet in one task per (chunk, share of the bundles); the exact scores
   are computed block by block, best bound first, and the threshold rises on the way.
3. The windows [50 %, 95 %] of the positives' scores go the same way: preliminary negatives in the
   own block, then all blocks with another label whose bounds meet a window above the
   score of its third negative so far.

A block that no bound excludes is always read, so results equal brute force, whatever the data;
clustered vectors read few blocks, unstructured ones all.  A task holds one chunk and at most
about ``Layout.share`` anchors; nothing holds all anchors, blocks or pairs.

Defined results: rows with a NULL label, a NULL vector, or a NULL or non-finite component take no
part; vectors of different lengths are never compared; a row with a NULL id is no anchor and comes
last among ties; repeated rows are rows each (a copy of an anchor can be its positive); quantised
components beyond 2^31 are cut to that; an anchor without positives, or a positive without a negative in
its window, has no rows; empty tables give none.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, ship

class Layout(NamedTuple):
    block_bytes: int = 1 << 18  # quantised components of a block (4 bytes each)
    chunk: int = 32             # blocks of a task
    share: int = 8192           # asks of a task, about
    maps: int = 1024            # zone maps of a task, about


CURVE_DIMS, CURVE_BITS = 10, 6
LIMIT = 2 ** 31 - 1
NONE = -(1 << 62)       # below every score


# ------------------------------------------------------------------ Hilbert curve

def hilbert_key(cells, bits: int):
    """Place on the Hilbert curve of each row of ``cells`` (rows x dims, 0 .. 2^bits - 1):
    the bits are taken from the highest plane down, undoing the reflections and exchanges
    that each plane brings to those below it; then a Gray code is decoded."""
    x = cells.astype(np.int64).T.copy()
    dims = len(x)
    for plane in range(bits - 1, 0, -1):
        one, below = np.int64(1) << plane, (np.int64(1) << plane) - 1
        for d in range(dims):
            on = (x[d] & one) != 0
            swap = np.where(on, 0, (x[0] ^ x[d]) & below)
            x[0] ^= np.where(on, below, swap)
            x[d] ^= swap
    for d in range(1, dims):
        x[d] ^= x[d - 1]
    flip = np.zeros(x.shape[1], np.int64)
    for plane in range(bits - 1, 0, -1):
        flip ^= np.where(x[-1] & (np.int64(1) << plane), (np.int64(1) << plane) - 1, 0)
    x ^= flip
    key = np.zeros(x.shape[1], np.int64)
    for plane in range(bits - 1, -1, -1):
        for d in range(dims):
            key = (key << 1) | ((x[d] >> plane) & 1)
    return key


# ------------------------------------------------------------------ blocks

VECTOR = "uid long, id long, none boolean, label long, d int, q binary"
VECTOR_NAMES = ["uid", "id", "none", "label", "d", "q"]


def quantised(rows: DataFrame, scale: int, id_col: str, vec_col: str, label: Column) -> DataFrame:
    """(uid, id, none, label, d, q) of the rows that take part; ``none`` marks a NULL id, q
    holds d little-endian int32."""
    def run(batches):
        import pyarrow as pa
        for b in batches:
            col = b.column(3)
            off = np.asarray(col.offsets)
            flat = col.values
            values = flat.to_numpy(zero_copy_only=False).astype(np.float64)
            bad = np.concatenate(([0], np.cumsum(~np.isfinite(values))))
            ok = np.flatnonzero((bad[off[1:]] == bad[off[:-1]]) & ~np.asarray(col.is_null()))
            with np.errstate(invalid="ignore"):
                q = np.clip(np.floor(scale * np.nan_to_num(values, posinf=0, neginf=0)), -LIMIT, LIMIT).astype("<i4")
            keep = b.take(pa.array(ok))
            size = (off[1:] - off[:-1])[ok]
            yield pa.RecordBatch.from_arrays(
                [keep.column(0), keep.column(1).fill_null(0), keep.column(1).is_null(), keep.column(2),
                 pa.array(size, pa.int32()), pa.array([q[off[i]:off[i + 1]].tobytes() for i in ok], pa.binary())],
                names=VECTOR_NAMES)

    ship(rows.sparkSession)
    found = rows.select(F.monotonically_increasing_id().alias("uid"), F.col(id_col).cast("long").alias("id"),
                        label.cast("long").alias("label"), F.col(vec_col).cast("array<double>").alias("vec"))
    found = found.where("label is not null and vec is not null")
    return materialise(found.mapInArrow(run, VECTOR), "vectors")


def spread(vectors: DataFrame) -> dict[int, tuple]:
    """Per vector length: the curve's dimensions, their lowest values and extents.  One
    row per length and dimension comes to the driver."""
    def run(batches):
        import pandas as pd
        for b in batches:
            for d, part in b.groupby("d"):
                q = np.frombuffer(b"".join(part["q"]), "<i4").reshape(len(part), d).astype(np.float64)
                yield pd.DataFrame({"d": int(d), "pos": np.arange(d), "n": len(q), "s": q.sum(0), "s2": (q * q).sum(0),
                                    "lo": q.min(0, initial=0), "hi": q.max(0, initial=0)})

    parts = vectors.select("d", "q").mapInPandas(run, "d int, pos int, n long, s double, s2 double, lo double, hi double")
    stats = parts.groupBy("d", "pos").agg(*[F.sum(c).alias(c) for c in ("n", "s", "s2")], F.min("lo").alias("lo"),
                                          F.max("hi").alias("hi"))
    var = F.col("s2") / F.col("n") - (F.col("s") / F.col("n")) * (F.col("s") / F.col("n"))
    top = stats.withColumn("r", F.row_number().over(Window.partitionBy("d").orderBy(F.round(var, 6).desc(), "pos")))
    out: dict[int, list] = {}
    for r in top.where(F.col("r") <= CURVE_DIMS).orderBy("d", "r").collect():
        out.setdefault(r.d, []).append((r.pos, r.lo, max(r.hi - r.lo, 1.0)))
    return {d: tuple(np.array(x) for x in zip(*v)) for d, v in out.items()}


BLOCK = ("block long, chunk long, d int, n int, ids binary, nulls binary, uids binary, labels binary, kinds array<long>, "
         "q binary, lo binary, hi binary")


def blocks(vectors: DataFrame, total: int, layout: Layout = Layout()) -> DataFrame:
    """The block table, ordered along the curve; rows of a block by (id, uid), NULL ids last.
    ``chunk`` groups ``layout.chunk`` neighbouring blocks, ``block`` is the range partition and
    the place in it."""
    spark = vectors.sparkSession
    curve = spread(vectors)

    def keys(batches):
        for b in batches:
            key = np.zeros(len(b), np.int64)
            for d, at in b.groupby("d").indices.items():
                if d in curve:
                    pos, lo, extent = curve[d]
                    q = np.frombuffer(b"".join(b["q"].iloc[at]), "<i4").reshape(len(at), d)[:, pos.astype(int)]
                    cells = np.minimum((q - lo) / extent * (1 << CURVE_BITS), (1 << CURVE_BITS) - 1)
                    key[at] = hilbert_key(np.maximum(cells, 0), CURVE_BITS)
            b["key"] = key
            yield b

    def cut(batches):
        import pandas as pd
        from pyspark import TaskContext
        part, seq, held = TaskContext.get().partitionId(), 0, None

        def close(rows):
            nonlocal seq
            rows = rows.sort_values(["none", "id", "uid"])
            d = int(rows["d"].iloc[0])
            q = np.frombuffer(b"".join(rows["q"]), "<i4").reshape(len(rows), d)
            labels = rows["label"].to_numpy("<i8")
            seq += 1
            return {"block": (part << 32) + seq - 1, "chunk": (part << 32) + (seq - 1) // layout.chunk, "d": d, "n": len(rows),
                    "ids": rows["id"].to_numpy("<i8").tobytes(), "nulls": rows["none"].to_numpy(bool).tobytes(),
                    "uids": rows["uid"].to_numpy("<i8").tobytes(), "labels": labels.tobytes(),
                    "kinds": np.unique(labels).tolist(), "q": q.tobytes(), "lo": q.min(0).tobytes(),
                    "hi": q.max(0).tobytes()}

        for b in batches:
            held = b if held is None or not len(held) else pd.concat([held, b], ignore_index=True)
            out = []
            while len(held):
                d = int(held["d"].iloc[0])
                size = max(16, layout.block_bytes // (4 * max(d, 1)))
                same = int(np.argmax(np.append(held["d"].to_numpy() != d, True)))
                if same < size and same == len(held):
                    break  # the block may go on in the next batch
                out.append(close(held.iloc[:min(size, same)]))
                held = held.iloc[min(size, same):]
            if out:
                yield pd.DataFrame(out)
        if held is not None and len(held):
            yield pd.DataFrame([close(held)])

    parts = min(int(spark.conf.get("spark.sql.shuffle.partitions", "200")), 1 + total // 20_000)
    keyed = vectors.mapInPandas(keys, VECTOR + ", key long")
    ranged = keyed.repartitionByRange(parts, "d", "key", "uid").sortWithinPartitions("d", "key", "uid")
    return materialise(ranged.mapInPandas(cut, BLOCK), "blocks")


# ------------------------------------------------------------------ scores inside a block

class Block:
    """A block row as arrays."""

    def __init__(self, r):
        self.block, self.n, self.d = int(r["block"]), int(r["n"]), int(r["d"])
        self.ids = np.frombuffer(r["ids"], "<i8")
        self.nulls = np.frombuffer(r["nulls"], bool)
        self.uids = np.frombuffer(r["uids"], "<i8")
        self.labels = np.frombuffer(r["labels"], "<i8")
        self.q = np.frombuffer(r["q"], "<i4").reshape(self.n, self.d)

    def scores(self, vectors):
        return products(vectors, self.q.T)


def products(a, b):
    """Exact integer matrix product: in floating point where every partial sum is exact."""
    a, b = np.asarray(a), np.asarray(b)
    top = a.shape[1] * (np.abs(a.astype(np.int64)).max(initial=0)) * (np.abs(b.astype(np.int64)).max(initial=0))
    if top < 1 << 24:
        return (a.astype(np.float32) @ b.astype(np.float32)).astype(np.int64)
    if top < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64)).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64)


def bounds(vectors, lo, hi):
    """(lower, upper) bounds of the inner products of every vector with every zone map."""
    pos, neg = np.maximum(vectors, 0), np.minimum(vectors, 0)
    return products(pos, lo.T) + products(neg, hi.T), products(pos, hi.T) + products(neg, lo.T)


def best(scores, k: int):
    """Up to ``k`` (row, column, score) per row, the highest first, the leftmost among equals;
    ``NONE`` is no score.  ``scores`` is overwritten."""
    rows, cols, found, every = [], [], [], np.arange(len(scores))
    for _ in range(min(k, scores.shape[1])):
        at = scores.argmax(1)
        top = scores[every, at]
        ok = top > NONE
        if not ok.any():
            break
        rows.append(every[ok]), cols.append(at[ok]), found.append(top[ok])
        scores[every, at] = NONE
    if not rows:
        z = np.zeros(0, np.int64)
        return z, z, z
    return np.concatenate(rows), np.concatenate(cols), np.concatenate(found)


def kth(rows, found, n: int, k: int):
    """Per row 0 .. n - 1 the k-th highest of ``found``, ``NONE`` where there are fewer."""
    out = np.full(n, NONE, np.int64)
    order = np.lexsort((-found, rows))
    r = rows[order]
    first = np.searchsorted(r, np.arange(n))
    at = first + k - 1
    ok = (at < len(r)) & (np.searchsorted(r, np.arange(n), side="right") - first >= k)
    out[ok] = found[order][at[ok]]
    return out


# An ask of an anchor (step 1): the best k rows of the same label but itself, scores from
# ``floor`` up.  An ask of a window (step 2): the best k rows of another label with scores in
# [floor, top].
ASK = ("uid", "id", "label", "tag", "pscore", "floor", "top")
BUNDLE = "home long, d int, n int, asks binary, q binary"
BUNDLE_NAMES = ["home", "d", "n", "asks", "q"]
FOUND_NAMES = ["home", "uid", "aid", "tag", "pscore", "score", "id", "row"]
FOUND = ", ".join(f"{c} long" for c in FOUND_NAMES)


def serve(asks, block: Block, other: bool, k: int):
    """(ask, column, score) of the best ``k`` rows of ``block`` per ask.  ``asks`` is a dict of
    arrays: q (asks x d), uid, label, floor, top; equal neighbours in q are scored once."""
    out = []
    step = max(1, (1 << 20) // max(block.n, 1))
    for i in range(0, len(asks["uid"]), step):
        part = {x: v[i:i + step] for x, v in asks.items()}
        new = np.append(True, part["uid"][1:] != part["uid"][:-1])
        s = block.scores(part["q"][new])[np.cumsum(new) - 1]
        same = part["label"][:, None] == block.labels[None, :]
        ok = (s >= part["floor"][:, None]) & (s <= part["top"][:, None])
        ok &= ~same if other else same & (part["uid"][:, None] != block.uids[None, :])
        r, c, v = best(np.where(ok, s, NONE), k)
        out.append((r + i, c, v))
    return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, np.int64),) * 3


def pack(home: int, d: int, asks) -> dict:
    return {"home": home, "d": d, "n": len(asks["uid"]),
            "asks": np.column_stack([asks[c] for c in ASK]).astype("<i8").tobytes(),
            "q": np.ascontiguousarray(asks["q"], "<i4").tobytes()}


def unpack(r) -> dict:
    n, d = int(r["n"]), int(r["d"])
    cols = np.frombuffer(r["asks"], "<i8").reshape(n, len(ASK))
    return dict(zip(ASK, cols.T.copy())) | {"q": np.frombuffer(r["q"], "<i4").reshape(n, d)}


def _spread_out(df: DataFrame, name: str, n: int) -> DataFrame:
    return df.withColumn(name, F.explode(F.sequence(F.lit(0), F.lit(n - 1))))


def choose_blocks(bundles: DataFrame, cut: DataFrame, other: bool, layout: Layout = Layout()) -> DataFrame:
    """(bundle, chunk, want, high, share): the asks of a bundle that no zone map of the
    chunk's blocks excludes.  Zone maps are dealt into ``map`` groups of about ``layout.maps`` blocks, the
    bundles into shares of about ``layout.share`` asks; a task sees one of each."""
    shares = 1 + (bundles.agg(F.sum("n").alias("n")).first()["n"] or 0) // layout.share
    maps = 1 + cut.count() // layout.maps
    zones = cut.select("block", "chunk", F.col("d").alias("zd"), "kinds", "lo", "hi").withColumn(
        "map", F.pmod(F.xxhash64("chunk", "zd"), F.lit(maps)).cast("int"))
    dealt = bundles.withColumn("share", F.pmod(F.xxhash64("home"), F.lit(shares)).cast("int"))

    def choose(key, left, right):
        import pandas as pd
        out = []
        for (d, chunk), zone in left.sort_values("block").groupby(["zd", "chunk"]):
            lo = np.frombuffer(b"".join(zone["lo"]), "<i4").reshape(len(zone), d)
            hi = np.frombuffer(b"".join(zone["hi"]), "<i4").reshape(len(zone), d)
            for r in right[right["d"] == d].to_dict("records"):
                asks = unpack(r)
                low, high = bounds(asks["q"], lo, hi)
                want = (high >= asks["floor"][:, None]) & (low <= asks["top"][:, None])
                for j, kinds in enumerate(zone["kinds"]):
                    has = np.isin(asks["label"], kinds)
                    want[:, j] &= (~has | (len(kinds) > 1)) if other else has
                rows = want.any(1)
                if rows.any():
                    out.append(pack(int(r["home"]), int(d), {x: v[rows] for x, v in asks.items()}) | {
                        "chunk": int(chunk), "want": np.packbits(want[rows], axis=1).tobytes(),
                        "high": high[rows].max(0).astype("<i8").tobytes(), "blocks": int(want.sum()),
                        "share": int(r["share"])})
        return pd.DataFrame(out, columns=[*BUNDLE_NAMES, "chunk", "want", "high", "blocks", "share"])

    left = _spread_out(zones, "share", shares).groupBy("map", "share")
    return materialise(left.cogroup(_spread_out(dealt, "map", maps).groupBy("map", "share")).applyInPandas(
        choose, BUNDLE + ", chunk long, want binary, high binary, blocks long, share int"), "asked")


def read_blocks(asked: DataFrame, cut: DataFrame, other: bool, k: int) -> DataFrame:
    """(home, uid, aid, tag, pscore, score, id, row): for every ask the best ``k`` rows of every
    chunk it had to visit; the best over all chunks are among them."""
    def visit(key, left, right):
        import pandas as pd
        rows = left.sort_values("block").to_dict("records")
        held: dict[int, Block] = {}
        found: list[list] = [[] for _ in FOUND_NAMES]
        for r in right.to_dict("records"):
            asks = unpack(r)
            n = len(asks["uid"])
            want = np.unpackbits(np.frombuffer(r["want"], np.uint8).reshape(n, -1), axis=1).astype(bool)
            high = np.frombuffer(r["high"], "<i8")
            got = [np.zeros(0, np.int64)] * 5  # ask, score, NULL id, id, uid
            for j in np.argsort(-high, kind="stable"):
                live = np.flatnonzero(want[:, j] & (asks["floor"] <= high[j]))
                if not len(live):
                    continue
                blk = held[j] = held.get(j) or Block(rows[j])
                a, c, v = serve({x: y[live] for x, y in asks.items()}, blk, other, k)
                new = [live[a], v, blk.nulls[c].astype(np.int64), blk.ids[c], blk.uids[c]]
                got = [np.concatenate(x) for x in zip(got, new)]
                order = np.lexsort((got[4], got[3], got[2], -got[1], got[0]))
                got = [x[order] for x in got]
                top = np.arange(len(order)) - np.searchsorted(got[0], got[0]) < k
                got = [x[top] for x in got]
                asks["floor"] = np.maximum(asks["floor"], kth(got[0], got[1], n, k))
            a = got[0]
            home = np.full(len(a), int(r["home"]))
            for to, x in zip(found, (home, asks["uid"][a], asks["id"][a], asks["tag"][a], asks["pscore"][a], got[1],
                                     np.where(got[2] > 0, NONE, got[3]), got[4])):
                to.append(x)
        return pd.DataFrame({c: np.concatenate(v) if v else np.zeros(0, np.int64) for c, v in zip(FOUND_NAMES, found)})

    pairs = asked.groupBy("chunk", "d", "share").agg(F.sum("blocks").alias("blocks")).select(
        F.col("chunk").alias("of"), F.col("d").alias("size"), F.col("share").alias("part"))
    bodies = cut.join(pairs, (F.col("chunk") == F.col("of")) & (F.col("d") == F.col("size"))).select(*cut.columns, "part")
    found = bodies.groupBy("chunk", "d", "part").cogroup(asked.select(
        F.col("chunk").alias("to"), "d", F.col("share").alias("from_share"), *[
            c for c in asked.columns if c not in ("chunk", "d", "share")]).groupBy("to", "d", "from_share")).applyInPandas(
        visit, FOUND)
    return found.withColumn("id", F.when(F.col("id") != NONE, F.col("id")))


def own_block(cut: DataFrame, k: int, anchor_mod: int) -> DataFrame:
    """Bundles of anchors, with the score of the k-th same-label row of their own block as floor."""
    def run(batches):
        import pandas as pd
        for b in batches:
            out = []
            for r in b.to_dict("records"):
                blk = Block(r)
                at = np.flatnonzero((blk.ids % anchor_mod == 0) & ~blk.nulls)
                if len(at):
                    asks = {"uid": blk.uids[at], "id": blk.ids[at], "label": blk.labels[at], "q": blk.q[at],
                            "tag": blk.uids[at], "pscore": np.zeros(len(at), np.int64),
                            "floor": np.full(len(at), NONE + 1), "top": np.full(len(at), -NONE)}
                    a, _, v = serve(asks, blk, False, k)
                    asks["floor"] = np.maximum(asks["floor"], kth(a, v, len(at), k))
                    out.append(pack(blk.block, blk.d, asks))
            yield pd.DataFrame(out, columns=BUNDLE_NAMES)
    return materialise(cut.mapInPandas(run, BUNDLE), "anchors")


def windows(cut: DataFrame, positives: DataFrame, k: int, low: int, high: int) -> DataFrame:
    """Bundles of the positives' windows, floors raised by what the anchors' own block offers."""
    def run(key, left, right):
        import pandas as pd
        out = []
        if len(right) and len(left):
            blk = Block(left.iloc[0])
            right = right.sort_values(["uid", "place"])
            at = pd.Series(np.arange(blk.n), index=blk.uids)[right["uid"].to_numpy()].to_numpy()
            p = right["score"].to_numpy(np.int64)
            asks = {"uid": right["uid"].to_numpy(np.int64), "id": right["aid"].to_numpy(np.int64), "label": blk.labels[at],
                    "q": blk.q[at], "tag": right["row"].to_numpy(np.int64), "pscore": p,
                    "floor": -((-low * p) // 100), "top": (high * p) // 100}
            ok = asks["floor"] <= asks["top"]
            asks = {x: v[ok] for x, v in asks.items()}
            if ok.any():
                a, _, v = serve(asks, blk, True, k)
                asks["floor"] = np.maximum(asks["floor"], kth(a, v, len(asks["uid"]), k))
                out.append(pack(blk.block, blk.d, asks))
        return pd.DataFrame(out, columns=BUNDLE_NAMES)

    left = cut.withColumn("home", F.col("block")).groupBy("home")
    return materialise(left.cogroup(positives.groupBy("home")).applyInPandas(run, BUNDLE), "windows")


def best_rows(found: DataFrame, by: list[str], k: int, name: str) -> DataFrame:
    w = Window.partitionBy(*by).orderBy(F.col("score").desc(), F.col("id").asc_nulls_last(), "row")
    return found.withColumn(name, F.row_number().over(w)).where(F.col(name) <= k)


def hard_negatives(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label: Column | str = "label",
                   scale: int = 256, anchor_mod: int = 50, n_positive: int = 5, n_negative: int = 3,
                   low: int = 50, high: int = 95, layout: Layout = Layout()) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of every row
    whose id is divisible by ``anchor_mod``; ``label`` is a column or an expression."""
    vectors = quantised(rows, scale, id_col, vec_col, F.col(label) if isinstance(label, str) else label)
    cut = blocks(vectors, vectors.count(), layout)
    anchors = own_block(cut, n_positive, anchor_mod)
    found = read_blocks(choose_blocks(anchors, cut, False, layout), cut, False, n_positive)
    positives = materialise(best_rows(found, ["uid"], n_positive, "place"), "positives")
    asked = windows(cut, positives, n_negative, low, high)
    hits = read_blocks(choose_blocks(asked, cut, True, layout), cut, True, n_negative)
    named = positives.select("uid", F.col("row").alias("tag"), F.col("id").alias("positive_id"))
    return best_rows(hits, ["uid", "tag"], n_negative, "rank").join(named, ["uid", "tag"]).select(
        F.col("aid").alias("anchor_id"), "positive_id", "rank", F.col("id").alias("negative_id"),
        F.col("pscore").alias("positive_score"), F.col("score").alias("negative_score"))
