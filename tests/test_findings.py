"""Cases of reviewed findings."""

import numpy as np
from pyspark.sql import functions as F

from tabforge.operators import knn


def test_group_bounds_hold():
    """The bound of receivers that miss the same columns is never above a distance; no needed block is left out."""
    rnd = np.random.default_rng(5)
    for case in range(40):
        p = 2 + case % 5
        r = rnd.normal(size=(12, p)).round(1)
        r[rnd.random(r.shape) < 0.4] = np.nan
        blocks = []
        for _ in range(6):
            x = rnd.normal(size=(7, p)).round(1) + rnd.integers(-3, 4)
            x[rnd.random(x.shape) < 0.2 * (case % 3)] = np.nan
            blocks.append(x)
        some = [~np.isnan(x) for x in blocks]
        lo = np.array([np.where(s.any(0), np.where(s, x, np.inf).min(0), np.nan) for s, x in zip(some, blocks)])
        hi = np.array([np.where(s.any(0), np.where(s, x, -np.inf).max(0), np.nan) for s, x in zip(some, blocks)])
        zones = knn.Zones(lo, hi, np.array([s.all(0) for s in some]), np.array([(~s).sum(1).max() for s in some]),
                          np.zeros((6, p)), np.zeros(6))
        least = np.array([knn.distances(r, x).min(1) for x in blocks]).T
        for i in range(len(r)):
            same = (np.isnan(r) == np.isnan(r[i])).all(1)
            if not np.isnan(r[i]).all():
                assert (knn.group_bound(r[same], zones) <= least[same].min(0)).all()
        limit = np.sort(least, axis=1)[:, 1]
        needed = (np.isfinite(least) & (least <= limit[:, None])).any(0)
        assert set(np.flatnonzero(needed)) <= set(knn.worth_bounding(r, limit, zones))


def test_visits_are_one_row_per_bundle_and_chunk(spark, monkeypatch):
    """What travels does not grow with the number of blocks into which patterns of missing values cut the donors."""
    rows = spark.range(3000).select("id", *[
        F.when((F.col("id") * (i + 3)) % 17 != 5, F.abs(F.xxhash64("id", F.lit(i))) % 1000 / 100.0).alias(f"x{i}") for i in range(8)])
    kept = []
    write = knn.materialise
    monkeypatch.setattr(knn, "materialise", lambda df, name: kept.append((name, write(df, name))) or kept[-1][1])
    knn.knn_impute(rows, [f"x{i}" for i in range(8)], "id").count()
    blocks = next(t for name, t in kept if name == "knn-blocks")
    for name, visits in kept:
        if name == "knn-visits":
            assert "binary" not in dict(visits.dtypes).values()
            assert visits.count() == visits.select("bundle", "chunk").distinct().count() > 0
    assert blocks.select("chunk").distinct().count() <= 2 * 3000 // knn.Layout().block + 8 < blocks.count()


def test_grid_search_ranks_the_rows_once(spark, monkeypatch):
    """All folds are taken from one cached table."""
    from pyspark.ml.tuning import CrossValidator

    from tabforge.ml import models as M
    df = spark.createDataFrame([(i, float(i % 7), i % 2) for i in range(80)], "k long, x double, y int")
    seen, fit = [], CrossValidator.fit

    def spied(self, data):
        seen.append(data)
        assert data.is_cached
        return fit(self, data)

    monkeypatch.setattr(CrossValidator, "fit", spied)
    _, results, _ = M.grid_search(df, ["x"], "y", ["k"], "random_forest", "classification", {"n_estimators": [2, 3]}, 2)
    assert results.count() == 2 and len(seen) == 1 and not seen[0].is_cached


def test_train_then_infer_builds_the_customer_table_once(spark, sf_dir, monkeypatch):
    from tabforge.plans import jobs, q_ml
    calls, build = [], jobs.c360

    def counted(*a):
        calls.append(a)
        return build(*a)

    monkeypatch.setattr(jobs, "c360", counted)
    monkeypatch.setattr(q_ml, "c360", counted)
    row = q_ml.train_then_infer(spark, sf_dir).first()
    assert len(calls) == 1 and row.n_test > 0 and row.n_different == 0


def test_receivers_that_miss_a_column_read_few_blocks(spark, monkeypatch):
    """blocks of donors lie along the columns that a receiver has, not along the one that it misses."""
    rnd = np.random.default_rng(3)
    rows = [[i, *map(float, rnd.uniform(0, 1000, 2))] for i in range(6000)]
    for i, r in enumerate(rows):
        if i % 10 < 2:
            r[1 + i % 10] = None
    read, write = [], knn.materialise

    def counted(df, name):
        out = write(df, name)
        if name == "knn-visits":
            read.append(out.agg(F.coalesce(F.sum(F.size("blocks")), F.lit(0))).first()[0])
        return out

    monkeypatch.setattr(knn, "materialise", counted)
    df = spark.createDataFrame(rows, "k long, a double, b double")
    out = {r.k: r for r in knn.knn_impute(df, ["a", "b"], "k", 5, layout=knn.Layout(block=16, chunk=8, bundle=16, pivots=64, sample=64)).collect()}
    x = np.array([[np.nan if v is None else v for v in r[1:]] for r in rows])
    for i in (0, 1, 10, 11, 5990, 5991):
        j = i % 10
        d = np.where(np.isnan(x[:, j]), np.inf, np.abs(x[:, 1 - j] - x[i, 1 - j]))
        d[np.isnan(d)] = np.inf
        best = np.argsort(d, kind="stable")[:5]
        assert abs(out[i][1 + j] - x[best, j].mean()) < 1e-9
    assert read[-1] < 2000  # of 1,200 receivers in 75 bundles; 4,461 when all shared one order of donors


def test_knn_pairs_by_matrix_products():
    """No pair at or below the limit is lost, whatever the values, and hardly any other is found; distances of pairs
    are those of all pairs to the last bit."""
    rnd = np.random.default_rng(3)
    r, x = (rnd.normal(size=(n, 20)).round(1) for n in (60, 900))
    for v in (r, x):
        v[rnd.random(v.shape) < 0.1] = np.nan
    x[:50] = x[50:100]  # equal distances
    r[0], x[0] = np.nan, np.nan
    with np.errstate(invalid="ignore", over="ignore"):
        every = knn.distances(r, x)
        limit = np.sort(every, axis=1)[:, 5]
        who, at = knn.Near(r).within(limit, x)
        assert np.array_equal(knn.pair_distances(r[who], x[at]), every[who, at])
        found = set(zip(who.tolist(), at.tolist()))
        want = set(zip(*(i.tolist() for i in np.nonzero(every <= limit[:, None]))))
        assert want <= found and len({(i, j) for i, j in found - want if np.isfinite(every[i, j])}) < 5
        r[1:4, 0], x[1:4, 1], x[4:9, 0] = (np.inf, 1e200, -1e160), (1e200, -np.inf, 1e308), (1e200, 1e160, np.inf, -np.inf, 1e-200)
        every = knn.distances(r, x)
        limit = np.where(np.arange(60) % 2, np.inf, every[:, 7])
        found = set(zip(*(i.tolist() for i in knn.Near(r).within(limit, x))))
        assert {(i, j) for i, j in zip(*np.nonzero(every <= limit[:, None])) if np.isfinite(every[i, j])} <= found
