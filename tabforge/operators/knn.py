"""Exact k-nearest-neighbour imputation (C5) for any number of columns.

Semantics (scikit-learn ``KNNImputer(n_neighbors=5)``, uniform weights): for a row
``r`` missing column ``j``, the donors are the rows where ``j`` is present; the
distance is NaN-Euclidean over the coordinates present in both rows,
``sqrt(p / m * sum(diff^2))`` with ``p`` features and ``m`` co-present ones
(undefined when ``m = 0``).  The imputed value is the mean of ``j`` over the ``k``
nearest donors with a defined distance (ties: smaller donor key first); a row with
no such donor gets the column mean.

Method: pivots and bounds.

1. Donors are ordered by their three nearest pivots (a bounded sample of donors; missing
   coordinates take the column mean for this step only), rows with the same frequent pattern of
   missing values and equal points side by side, and cut into blocks of ``Layout.block`` rows.
   A block knows the range of each column, the columns present in all of its rows, its pivot and
   the largest distance from it.
2. Two lower bounds hold for the distance of a receiver to every donor of a block: the distance
   to the block's box, and by the triangle inequality the distance to its pivot less the radius.
   Both allow for columns that only some donors have.
   Receivers that miss the same columns as many others (``OWN``) have blocks of their own: donors of one
   of these columns, ordered without them.  Else a receiver would have to read blocks all along the columns
   that it misses, more and more of them as the rows grow.
3. Receivers travel in bundles of neighbours.  The donor sample gives each (receiver, column) a first
   k-th distance; the block with the smallest bound improves it; then every block whose bound does
   not exceed the k-th distance is read.  Where a bound equals it, a block is read only if its smallest
   donor key comes early enough, so one point that holds a third of the rows costs one block.
4. A bundle meets all blocks that it asked of a chunk at once: matrix products leave out pairs that are too far even with
   their rounding error, the distances of the few others are computed exactly.  The best ``k`` of all chunks give the mean.

No block is left out but by a bound, so results equal brute force; there is no cap on candidates,
and the plan grows with the number of columns, not with its subsets.  Receivers of a bundle that miss the same
columns are bounded together first; only blocks that such a group may need are bounded for each receiver.  What
travels between the steps is a list of blocks per bundle and chunk.
A task holds the bounds of about ``Layout.maps`` blocks or of the blocks of a chunk, and a share of the bundles.  The driver holds the
sample: at most ``Layout.sample`` rows.

``key`` orders donors at equal distance; NULL and repeated keys are allowed (a row number
decides among them) and every row comes back once.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import as_double, c
from ..session import materialise, ship_package


class Layout(NamedTuple):
    block: int = 512      # donors of a block
    chunk: int = 32       # a task reads the donors of so many full blocks, in as many blocks as they make
    maps: int = 1024      # bounds of blocks in a task, about
    bundle: int = 128     # receivers that travel together
    tile: int = 2048      # donors that a bundle is held against at a time
    share: int = 64       # bundles of a task, about
    pivots: int = 1024
    sample: int = 4096    # donors that give first thresholds, and the pivots


LAST = np.iinfo(np.int64).max
OWN = 8  # sets of missing columns that more than 1 / OWN of the receivers share have their own blocks
SLACK = 1 - 1e-9  # for bounds that are not computed by the very steps of a distance


# ------------------------------------------------------------------ numbers

def distances(r, x):
    """NaN-Euclidean distances (rows of r x rows of x), infinite where undefined.  Summed column by
    column, so that equal differences give equal distances wherever they are computed."""
    p = r.shape[1]
    s, m = np.zeros((len(r), len(x))), np.zeros((len(r), len(x)))
    for i in range(p):
        d = r[:, i, None] - x[None, :, i]
        ok = ~np.isnan(d)
        m += ok
        s += np.where(ok, d * d, 0.0)
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(m > 0, np.sqrt(p / m * s), np.inf)


def pair_distances(r, x):
    """NaN-Euclidean distances of the pairs (row of r, row of x), by the same steps as ``distances``."""
    p = r.shape[1]
    s, m = np.zeros(len(r)), np.zeros(len(r))
    for i in range(p):
        d = r[:, i] - x[:, i]
        ok = ~np.isnan(d)
        m += ok
        s += np.where(ok, d * d, 0.0)
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(m > 0, np.sqrt(p / m * s), np.inf)


class Near:
    """Finds the rows that may be within a distance of rows of ``r``, by matrix products."""

    def __init__(self, r):
        self.has = (~np.isnan(r)).astype(float)
        self.x = np.where(np.isnan(r), 0.0, r)
        self.square = self.x * self.x

    def within(self, limit, x):
        """(row of r, row of x) of every pair whose distance is not above ``limit`` (one per row of r), and of some
        others: squares are compared less their rounding error.  What cannot be compared is a pair too."""
        some = (~np.isnan(x)).astype(float)
        y = np.where(np.isnan(x), 0.0, x)
        with np.errstate(over="ignore", invalid="ignore"):
            sums = self.square @ some.T
            sums += self.has @ (y * y).T
            least = self.x @ y.T
            least *= -2
            least += sums * (1 - 1e-12)
            most = (limit * limit / self.x.shape[1] * (1 + 1e-9))[:, None] * (self.has @ some.T)
            return np.nonzero(~(least > most))


class Zones:
    """Bounds of several blocks as arrays."""

    def __init__(self, lo, hi, always, missing, pivot, radius):
        self.lo, self.hi, self.always, self.missing = lo, hi, always, missing  # most columns a donor misses
        self.pivot, self.radius = pivot, radius
        self.some = ~np.isnan(lo)
        self.plain = (self.some == always).all(1)  # the same columns present in all donors

    @staticmethod
    def of(rows, pivots):
        """From block rows."""
        n, p = len(rows), pivots.shape[1]
        return Zones(np.frombuffer(b"".join(rows["lo"])).reshape(n, p), np.frombuffer(b"".join(rows["hi"])).reshape(n, p),
                     np.frombuffer(b"".join(rows["always"]), bool).reshape(n, p), rows["missing"].to_numpy(),
                     pivots[rows["pivot"].to_numpy()], rows["radius"].to_numpy())

    def at(self, places):
        return Zones(self.lo[places], self.hi[places], self.always[places], self.missing[places], self.pivot[places],
                     self.radius[places])


def box_bound(r, z: Zones):
    """Lower bounds (receivers x blocks) of the distances to the donors of a block.

    With the same columns present in all donors this is the distance to the nearest point of the box,
    by the same steps as a distance: never above it, not even by rounding.  Otherwise a donor lacks
    at most ``missing`` columns, so the mean of squares is at least that without so many of the
    largest gaps."""
    p = r.shape[1]
    out = np.empty((len(r), len(z.lo)))
    at = np.flatnonzero(z.plain)
    s, m = np.zeros((len(r), len(at))), np.zeros((len(r), len(at)))
    for i in range(p):
        d = r[:, i, None] - np.clip(r[:, i, None], z.lo[None, at, i], z.hi[None, at, i])
        ok = ~np.isnan(d)
        m += ok
        s += np.where(ok, d * d, 0.0)
    with np.errstate(divide="ignore", invalid="ignore"):
        out[:, at] = np.where(m > 0, np.sqrt(p / m * s), np.inf)
        at = np.flatnonzero(~z.plain)
        for i in range(0, len(at), 256):
            zone = at[i:i + 256]
            gap = (r[:, None, :] - np.clip(r[:, None, :], z.lo[None, zone], z.hi[None, zone])) ** 2
            gap = np.sort(np.where(np.isnan(gap), np.inf, gap), axis=2)
            shared = np.isfinite(gap).sum(2)
            mean = np.cumsum(gap, axis=2) / np.arange(1, p + 1)
            left = np.arange(1, p + 1)[None, None, :]
            kept = (left <= shared[:, :, None]) & (left >= np.maximum(shared - z.missing[None, zone], 1)[:, :, None])
            out[:, zone] = np.sqrt(p * np.where(kept, mean, np.inf).min(2)) * SLACK
    return out


def pivot_bound(r, z: Zones):
    """|r - d| over the shared columns S is at least |r - pivot| over the columns all donors
    have, less the largest |d - pivot|; there are at most as many shared columns as the block and
    the receiver have.  Squares by matrix products, less their rounding error."""
    has = ~np.isnan(r)
    x, c = np.where(has, r, 0.0), np.where(z.always, z.pivot, 0.0)
    a, b = (x * x) @ z.always.T.astype(float), has.astype(float) @ (c * c).T
    far = np.sqrt(np.maximum(a - 2 * x @ c.T + b - 1e-12 * (a + b), 0.0))
    most = has.astype(float) @ z.some.T.astype(float)
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(most > 0, np.sqrt(r.shape[1] / most) * np.maximum(far - z.radius, 0) * SLACK, np.inf)


def group_bound(x, z: Zones):
    """Lower bounds (one per block) of the distances of any of the receivers ``x``, which miss the same
    columns, to the donors of a block: gaps between boxes over the columns that all of them have."""
    has = ~np.isnan(x[0])
    lo, hi = x[:, has].min(0), x[:, has].max(0)
    gap = np.maximum(np.maximum(z.lo[:, has] - hi, lo - z.hi[:, has]), 0.0)
    far = np.where(z.always[:, has], gap * gap, 0.0).sum(1)
    most = z.some[:, has].sum(1)
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(most > 0, np.sqrt(x.shape[1] / most * far) * SLACK, np.inf)


def worth_bounding(x, loosest, z: Zones):
    """Places of the blocks that some receiver of ``x`` may need, as ``loosest`` (its largest k-th distance) allows."""
    some, of = np.unique(np.isnan(x), axis=0, return_inverse=True)
    of = of.ravel()
    need = np.zeros(len(z.lo), bool)
    for i in range(len(some)):
        if not some[i].all():
            need |= group_bound(x[of == i], z) <= loosest[of == i].max()
    return np.flatnonzero(need)


def smallest(d, k: int):
    """(row, column) of up to ``k`` smallest finite entries per row, the leftmost among
    equals (columns stand in donor order); ``d`` is overwritten."""
    rows, cols, every = [], [], np.arange(len(d))
    for _ in range(min(k, d.shape[1])):
        at = d.argmin(1)
        ok = np.isfinite(d[every, at])
        if not ok.any():
            break
        rows.append(every[ok]), cols.append(at[ok])
        d[every, at] = np.inf
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(rows), np.concatenate(cols)


def tighten(limit, ord_, row, col, dist, o, k: int):
    """Lower the k-th (distance, donor) of each (receiver, column) by candidates."""
    if not len(row):
        return
    by = np.lexsort((o, dist, col, row))
    cell = row[by] * limit.shape[1] + col[by]
    first = np.flatnonzero(np.append(True, cell[1:] != cell[:-1]))
    size = np.diff(np.append(first, len(cell)))
    at = by[(first + k - 1)[size >= k]]
    r, j = row[at], col[at]
    better = (dist[at] < limit[r, j]) | ((dist[at] == limit[r, j]) & (o[at] < ord_[r, j]))
    at, r, j = at[better], r[better], j[better]
    limit[r, j], ord_[r, j] = dist[at], o[at]


class Bundle:
    """Receivers with their k-th (distance, donor) so far per column."""

    def __init__(self, r, p: int):
        self.rows = np.frombuffer(r["rows"], "<i8")
        self.x = np.frombuffer(r["x"], "<f8").reshape(-1, p)
        self.limit = np.frombuffer(r["lim"], "<f8").reshape(-1, p).copy()
        self.ord = np.frombuffer(r["ords"], "<i8").reshape(-1, p).copy()


BUNDLE = "bundle long, plan int, rows binary, x binary, lim binary, ords binary"
BLOCK = ("block long, chunk long, plan int, n int, ords binary, x binary, lo binary, hi binary, always binary, missing int, "
         "pivot int, radius double, first long")
FOUND = "bundle long, place int, row long, j int, dist double, ord long, value double"


def knn_impute(df: DataFrame, cols: list[str], key: str, k: int = 5, donors: DataFrame | None = None,
               layout: Layout = Layout()) -> DataFrame:
    """Impute NULLs of ``cols`` (numeric) from the k nearest rows of ``donors`` (the rows
    seen at fit time; by default ``df`` itself); ``key`` is an orderable column that
    breaks distance ties.  Imputed columns are double."""
    spark, p = df.sparkSession, len(cols)
    if not cols:
        return df
    ship_package(spark)

    def point(rows: DataFrame):
        return F.array(*[F.coalesce(as_double(x, rows.schema[x].dataType), F.lit(math.nan)) for x in cols])

    # Row numbers are fixed by writing them once.
    df = materialise(df.withColumn("_row", F.monotonically_increasing_id()), "knn-rows")
    source = df if donors is None else donors.withColumn("_row", F.monotonically_increasing_id())
    parts = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    given = source.select(c(key).alias("_key"), "_row", point(source).alias("x"))
    given = materialise(  # donors numbered in key order
        given.repartitionByRange(parts, "_key", "_row").sortWithinPartitions("_key", "_row")
        .select(F.monotonically_increasing_id().alias("ord"), "x"), "knn-donors")

    def present(i: int):
        v = F.col("x")[i]
        return F.when(~F.isnan(v), v)

    stat = given.agg(F.count(F.lit(1)).alias("n"), *[F.avg(present(i)).alias(f"m{i}") for i in range(p)]).first()
    means = [stat[f"m{i}"] for i in range(p)]
    asked = df.select(F.col("_row").alias("row"), point(df).alias("x")).where(F.exists("x", F.isnan))
    fills = None
    if stat["n"]:
        found = _search(given, asked, stat["n"], np.array([m if m is not None else 0.0 for m in means]), p, k, layout)
        w = Window.partitionBy("row", "j").orderBy("dist", "ord")
        best = found.withColumn("r", F.row_number().over(w)).where(F.col("r") <= k)
        vals = best.groupBy("row", "j").agg(F.avg("value").alias("v"))
        fills = materialise(vals.groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("j", "v"))).alias("_fill"))
                            .withColumnRenamed("row", "_row"), "knn-values")
    out = df.withColumn("_fill", F.lit(None).cast("map<int,double>")) if fills is None else df.join(fills, "_row", "left")

    def filled(i: int, x: str):
        return F.coalesce(as_double(x, df.schema[x].dataType), F.col("_fill")[i], F.lit(means[i])).alias(x)

    at = {x: i for i, x in enumerate(cols)}
    return out.select(*[filled(at[x], x) if x in at else c(x) for x in df.columns if x != "_row"])


def _pivots(points, n: int, layout: Layout):
    points = np.unique(points, axis=0)
    count = min(layout.pivots, max(1, math.isqrt(n)), len(points))
    return points[np.linspace(0, len(points) - 1, count).astype(int)]


def _search(given: DataFrame, asked: DataFrame, n: int, means, p: int, k: int, layout: Layout) -> DataFrame:
    """(row, j, dist, ord, value): the nearest donors of every receiver and missing column."""
    sample = given.orderBy(F.xxhash64("ord")).limit(layout.sample).collect()
    sample = sorted(sample, key=lambda r: r["ord"])
    sx = np.array([r["x"] for r in sample], dtype=float).reshape(-1, p)
    so = np.array([r["ord"] for r in sample], dtype=np.int64)
    total = asked.count()
    misses = asked.groupBy(F.transform("x", F.isnan).alias("miss")).count().where(F.col("count") * OWN > total)
    plans = sorted((tuple(r["miss"]), r["count"]) for r in misses.collect())  # fewer than OWN
    others = total > sum(m for _, m in plans)
    # A plan's columns that its receivers miss; the last plan is that of all other receivers.
    plans = [np.array(miss, bool) for miss, _ in plans] + [np.zeros(p, bool)] * others
    pivots = [_pivots(np.where(miss, 0.0, np.where(np.isnan(sx), means, sx)), n, layout) for miss in plans]
    spread_by = np.random.default_rng(7).integers(1, 2 ** 62, p, dtype=np.int64) | 1

    def near_pivots(x, plan):
        full = np.where(plans[plan], 0.0, np.where(np.isnan(x), means, x))
        d = (full * full).sum(1)[:, None] - 2 * full @ pivots[plan].T + (pivots[plan] * pivots[plan]).sum(1)
        first, every = [], np.arange(len(x))
        for _ in range(min(3, d.shape[1])):
            first.append(d.argmin(1).astype(np.int32))
            d[every, first[-1]] = np.inf
        return np.pad(np.stack(first, 1), ((0, 0), (0, 3 - len(first))), mode="edge")

    def pattern(x):
        with np.errstate(over="ignore"):
            return ((~np.isnan(x)) * spread_by).sum(1)

    def stack(col):
        return np.array(col.tolist(), dtype=float).reshape(len(col), p)

    def patterns(batches):
        import pandas as pd
        for b in batches:
            got, times = np.unique(pattern(stack(b["x"])), return_counts=True)
            yield pd.DataFrame({"pattern": got, "n": times})

    seen = given.select("x").mapInPandas(patterns, "pattern long, n long").groupBy("pattern").agg(F.sum("n").alias("n"))
    often = [r["pattern"] for r in seen.where(F.col("n") > n / 1024).collect()]  # fewer than 1024

    def place(plan_of):
        def run(batches):
            for b in batches:
                x = stack(b["x"])
                for plan, mine in enumerate(plan_of(x)):
                    if mine.any():
                        rows = b[mine].copy()
                        rows["plan"] = plan
                        rows["p1"], rows["p2"], rows["p3"] = near_pivots(x[mine], plan).T
                        rows["pattern"] = pattern(x[mine])
                        rows["rare"] = ~np.isin(rows["pattern"], often)
                        with np.errstate(over="ignore"):  # brings rows together that are equal but for what the plan leaves out
                            rows["same"] = np.bitwise_xor.reduce(
                                (np.where(plans[plan], 0.0, x[mine]) + 0.0).view(np.int64) * spread_by, axis=1)
                        yield rows
        return run

    def of_donor(x):
        """Plans in which a donor has one of the missing values."""
        return [(~np.isnan(x[:, miss])).any(1) if miss.any() else np.ones(len(x), bool) for miss in plans]

    def of_receiver(x):
        at = [(np.isnan(x) == miss).all(1) if miss.any() else np.ones(len(x), bool) for miss in plans]
        return [mine & ~np.any(at[:i], axis=0) if i else mine for i, mine in enumerate(at)]

    keys = ["plan", "p1", "rare", "pattern", "p2", "p3", "same", "ord"]
    extra = "plan int, p1 int, p2 int, p3 int, rare boolean, pattern long, same long"
    parts = min(int(given.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")), 1 + n * len(plans) // (16 * layout.block))
    placed = given.mapInPandas(place(of_donor), f"ord long, x array<double>, {extra}")

    # Small tables are cut finer, so that there are tasks enough.
    chunk_rows = min(layout.chunk * layout.block, max(layout.block, n // 64))

    def cut(batches):
        import pandas as pd
        from pyspark import TaskContext
        part, seq, held = TaskContext.get().partitionId(), 0, None
        chunk, size_of_chunk, plan_of_chunk = 0, 0, None

        def close(rows):
            nonlocal seq, chunk, size_of_chunk, plan_of_chunk
            plan = int(rows["plan"].iloc[0])
            if size_of_chunk >= chunk_rows or plan != plan_of_chunk:
                chunk, size_of_chunk, plan_of_chunk = chunk + 1, 0, plan
            size_of_chunk += len(rows)
            rows = rows.sort_values("ord")
            x = stack(rows["x"])
            pivot = int(rows["p1"].iloc[0])
            gap = (x - pivots[plan][pivot])[:, ~plans[plan]]  # receivers lack the other columns
            some = ~np.isnan(x)
            lo = np.where(some.any(0), np.where(some, x, np.inf).min(0), np.nan)
            hi = np.where(some.any(0), np.where(some, x, -np.inf).max(0), np.nan)
            seq += 1
            return {"block": (part << 32) + seq - 1, "chunk": (part << 32) + chunk, "plan": plan, "n": len(rows),
                    "ords": rows["ord"].to_numpy("<i8").tobytes(), "x": x.astype("<f8").tobytes(), "lo": lo.tobytes(),
                    "hi": hi.tobytes(), "always": some.all(0).tobytes(), "missing": int((~some).sum(1).max()), "pivot": pivot,
                    "radius": float(np.sqrt(np.nansum(gap * gap, axis=1)).max()), "first": int(rows["ord"].iloc[0])}

        for b in batches:
            held = b if held is None or not len(held) else pd.concat([held, b], ignore_index=True)
            out = []
            while len(held):
                cell, rare = held["p1"].to_numpy(), held["rare"].to_numpy()
                other = (cell != cell[0]) | (rare != rare[0]) | (held["plan"].to_numpy() != held["plan"].iloc[0])
                if not rare[0]:
                    other |= held["pattern"].to_numpy() != held["pattern"].iloc[0]
                same = int(np.argmax(np.append(other, True)))
                if same < layout.block and same == len(held):
                    break  # the block may go on in the next batch
                size = min(layout.block, same)
                out.append(close(held.iloc[:size]))
                held = held.iloc[size:]
            if out:
                yield pd.DataFrame(out)
        if held is not None and len(held):
            yield pd.DataFrame([close(held)])

    blocks = materialise(placed.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).mapInPandas(cut, BLOCK),
                         "knn-blocks")

    def bundles(batches):
        import pandas as pd
        from pyspark import TaskContext
        part, seq = TaskContext.get().partitionId(), 0
        for b in batches:
            out = []
            cuts = [0, *(np.flatnonzero(np.diff(b["plan"])) + 1).tolist(), len(b)]
            for i, end in ((i, end) for begin, end in zip(cuts, cuts[1:]) for i in range(begin, end, layout.bundle)):
                rows = b.iloc[i:min(i + layout.bundle, end)]
                x = stack(rows["x"])
                limit = np.where(np.isnan(x), np.inf, -1.0)
                ords = np.full(x.shape, LAST)
                d = distances(x, sx)
                for j in np.flatnonzero(np.isnan(x).any(0)):
                    who = np.flatnonzero(np.isnan(x[:, j]))
                    has = np.flatnonzero(~np.isnan(sx[:, j]))
                    a, at = smallest(d[np.ix_(who, has)], k)
                    tighten(limit, ords, who[a], np.full(len(a), j), d[who[a], has[at]], so[has[at]], k)
                out.append({"bundle": (part << 32) + seq, "plan": int(rows["plan"].iloc[0]), "rows": rows["row"].to_numpy("<i8").tobytes(), "x": x.tobytes(),
                            "lim": limit.tobytes(), "ords": ords.astype("<i8").tobytes()})
                seq += 1
            yield pd.DataFrame(out, columns=["bundle", "plan", "rows", "x", "lim", "ords"])

    rparts = min(int(given.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")), 1 + total // (8 * layout.bundle))
    homes = asked.withColumnRenamed("row", "ord").mapInPandas(place(of_receiver), f"ord long, x array<double>, {extra}")
    homes = homes.repartitionByRange(rparts, "plan", "p1", "p2", "p3", "same", "ord") \
        .sortWithinPartitions("plan", "p1", "p2", "p3", "same", "ord")
    sent = materialise(homes.select(F.col("ord").alias("row"), "plan", "x").mapInPandas(bundles, BUNDLE), "knn-bundles")
    shares = 1 + sent.count() // (layout.share * max(1, len(plans)))
    maps = 1 + blocks.count() // (layout.maps * max(1, len(plans)))
    zones = blocks.select("plan", "block", "chunk", "lo", "hi", "always", "missing", "pivot", "radius", "first")

    def visits(bundled: DataFrame, nearest_only: bool) -> DataFrame:
        """(bundle, chunk, blocks, share): the blocks of a chunk that a bundle has to read."""
        def choose(key, left, right):
            import pandas as pd
            out = []
            left = left.sort_values("first")  # the earliest donors come first among equal bounds
            first, many = left["first"].to_numpy(np.int64), len(left)
            zones = Zones.of(left, pivots[int(left["plan"].iloc[0])] if many else pivots[0])
            names = left[["chunk", "block"]].to_numpy()
            for b in right.to_dict("records") if many else ():
                mine = Bundle(b, p)
                loosest = np.where(np.isnan(mine.x), mine.limit, -1.0).max(1)
                places = worth_bounding(mine.x, loosest, zones)
                if not len(places):
                    continue
                zone = zones.at(places)
                low = np.maximum(box_bound(mine.x, zone), pivot_bound(mine.x, zone))
                near = (low <= loosest[:, None]) & np.isfinite(low)
                if nearest_only:
                    near &= np.arange(len(places)) == low.argmin(1)[:, None]
                asked: dict = {}
                for z in np.flatnonzero(near.any(0)):
                    bound = low[:, z, None]
                    want = (bound < mine.limit) | ((bound == mine.limit) & (first[places[z]] <= mine.ord))
                    if (want & zone.some[z] & near[:, z, None]).any():
                        chunk, block = names[places[z]]
                        asked.setdefault(chunk, []).append(block)
                out += [(b["bundle"], chunk, blocks, key[2]) for chunk, blocks in asked.items()]
            return pd.DataFrame(out, columns=["bundle", "chunk", "blocks", "share"])

        def deal(rows, name, m):
            return rows.withColumn(name, F.explode(F.sequence(F.lit(0), F.lit(m - 1))))

        left = deal(zones.withColumn("map", F.pmod(F.xxhash64("chunk"), F.lit(maps)).cast("int")), "share", shares)
        right = deal(bundled.withColumn("share", F.pmod(F.xxhash64("bundle"), F.lit(shares)).cast("int")), "map", maps)
        return materialise(left.groupBy("plan", "map", "share").cogroup(right.groupBy("plan", "map", "share")).applyInPandas(
            choose, "bundle long, chunk long, blocks array<long>, share int"), "knn-visits")

    def read(bundled: DataFrame, wanted: DataFrame) -> DataFrame:
        """The best ``k`` donors of every chunk per receiver and column."""
        def visit(key, left, right):
            import pandas as pd
            places = {b: i for i, b in enumerate(left["block"])}
            points = [np.frombuffer(x).reshape(-1, p) for x in left["x"]]
            names = [np.frombuffer(x, "<i8") for x in left["ords"]]
            out = []
            for b in right.to_dict("records"):
                mine = Bundle(b, p)
                miss = np.isnan(mine.x)
                near = Near(mine.x)
                asks = [places[x] for x in b["asks"]]
                donors, donor_ords = np.concatenate([points[i] for i in asks]), np.concatenate([names[i] for i in asks])
                rows: list = []
                for begin in range(0, len(donors), layout.tile):
                    x, ords = donors[begin:begin + layout.tile], donor_ords[begin:begin + layout.tile]
                    who, at = near.within(mine.limit.max(1), x)
                    dist = pair_distances(mine.x[who], x[at])
                    of, j = np.nonzero(miss[who] & ~np.isnan(x[at]) & (dist[:, None] <= mine.limit[who]) & np.isfinite(dist)[:, None])
                    r, dist, o, v = who[of], dist[of], ords[at[of]], x[at[of], j]
                    ok = (dist < mine.limit[r, j]) | (o <= mine.ord[r, j])
                    r, j, dist, o, v = r[ok], j[ok], dist[ok], o[ok], v[ok]
                    if len(r):
                        rows.append((r, j, dist, o, v))
                        tighten(mine.limit, mine.ord, r, j, dist, o, k)
                if rows:
                    r, j, dist, o, v = (np.concatenate(y) for y in zip(*rows))
                    by = np.lexsort((o, dist, j, r))
                    r, j, dist, o, v = r[by], j[by], dist[by], o[by], v[by]
                    cell = r * p + j
                    top = np.arange(len(r)) - np.searchsorted(cell, cell) < k
                    out.append(pd.DataFrame({"bundle": b["bundle"], "place": r[top].astype("int32"), "row": mine.rows[r[top]],
                                             "j": j[top].astype("int32"), "dist": dist[top], "ord": o[top], "value": v[top]}))
            return pd.concat(out) if out else pd.DataFrame(
                {x.split()[0]: [] for x in FOUND.split(", ")}).astype({"bundle": "int64", "row": "int64", "ord": "int64",
                                                                      "place": "int32", "j": "int32"})

        asks = wanted.select("bundle", F.col("chunk").alias("to"), F.col("share").alias("from"),
                             F.col("blocks").alias("asks")).join(bundled, "bundle")
        pairs = wanted.select(F.explode("blocks").alias("b"), "share").distinct()
        bodies = blocks.join(pairs, F.col("block") == F.col("b")).select(
            "chunk", "share", "block", "ords", "x")
        return bodies.groupBy("chunk", "share").cogroup(asks.groupBy("to", "from")).applyInPandas(visit, FOUND)

    def improve(key, left, right):
        b = left.iloc[0].to_dict()
        mine = Bundle(b, p)
        if len(right):
            tighten(mine.limit, mine.ord, right["place"].to_numpy(np.int64), right["j"].to_numpy(np.int64),
                    right["dist"].to_numpy(), right["ord"].to_numpy(np.int64), k)
        left = left.iloc[:1].copy()
        left["lim"], left["ords"] = [mine.limit.tobytes()], [mine.ord.astype("<i8").tobytes()]
        return left

    near = materialise(read(sent, visits(sent, True)).withColumnRenamed("bundle", "of"), "knn-near")
    better = sent.groupBy("bundle").cogroup(near.groupBy("of")).applyInPandas(improve, BUNDLE)
    better = materialise(better, "knn-bundles")
    return read(better, visits(better, False)).select("row", "j", "dist", "ord", "value")
