"""Invariants: distributed helpers equal brute force, results do not depend on
partitioning, splits are exact, disjoint and complete, fit-then-apply equals the
one-shot operator, and models learn a planted signal."""

import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabforge.functions.ranks import average_ranks, exact_quantiles, prefix_sums
from tabforge.ml import models as M
from tabforge.operators import split as L
from tabforge.plans.fixtures import table


def _rows(seed, n=2000):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        g = rnd.choice(["a", "b", "c"])
        # one hot value holding a third of the rows, plus ties and a long tail
        v = 7.0 if rnd.random() < 0.33 else float(rnd.randint(0, 300)) / rnd.choice([1, 2, 4])
        out.append((i, g, v))
    return out


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("sketch", [10_000, 50])
def test_exact_quantiles_match_numpy(spark, monkeypatch, seed, sketch):
    """With a coarse sketch and narrow brackets as well, where ranks lie at bracket ends."""
    from tabforge.functions import ranks
    monkeypatch.setattr(ranks, "SKETCH", sketch)
    monkeypatch.setattr(ranks, "NEAR", 6.0 / sketch)
    rows = _rows(seed)
    df = spark.createDataFrame(rows, "id long, g string, value double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    got = {(r["g"], r["prob"]): r["quantile"]
           for r in exact_quantiles(df, ["g"], probs, n_partitions=7).collect()}
    for g in "abc":
        vals = np.array([v for _, gg, v in rows if gg == g])
        for p in probs:
            assert got[(g, p)] == pytest.approx(float(np.quantile(vals, p)), rel=1e-12, abs=1e-12)


@pytest.mark.parametrize("bracket, few", [(10 ** 6, 10), (30, 10), (5, 10)])
def test_exact_quantiles_by_brackets(spark, monkeypatch, bracket, few):
    """Brackets in use from the first rows, and narrowed until they hold few."""
    from tabforge.functions import ranks
    for name, value in (("SKETCH", 300), ("NEAR", 6.0 / 300), ("FEW", few), ("BRACKET", bracket)):
        monkeypatch.setattr(ranks, name, value)
    rng = np.random.default_rng(9)
    values = {"a": rng.normal(0, 1, 3000), "hot": np.where(rng.random(2000) < .4, 1.5, rng.integers(0, 40, 2000) / 8),
              "one": np.array([4.0]), "same": np.full(500, 2.0), None: rng.exponential(1, 900), "few": rng.normal(0, 1, 9)}
    rows = [(g, float(v)) for g, x in values.items() for v in x] + [("a", None)]
    df = spark.createDataFrame(rows, "g string, value double").repartition(5)
    probs = [0.0, 0.01, 0.25, 0.26, 0.5, 0.75, 0.99, 1.0]
    got = {(r["g"], r["prob"]): r["quantile"] for r in exact_quantiles(df, ["g"], probs).collect()}
    assert len(got) == len(values) * len(probs)
    for g, x in values.items():
        for p in probs:
            assert got[(g, p)] == pytest.approx(float(np.quantile(x, p)), rel=1e-12, abs=1e-12), (g, p)
    whole = exact_quantiles(df.select("value"), [], [0.5]).first()["quantile"]
    assert whole == pytest.approx(float(np.quantile(np.concatenate(list(values.values())), 0.5)))


def test_prefix_sums_and_ranks_match_brute_force(spark):
    rows = _rows(3, 1500)
    df = spark.createDataFrame(rows, "id long, g string, value double")
    ps = prefix_sums(df.withColumn("one", F.lit(1)), ["g"], "value", ["one"], n_partitions=5).collect()
    for r in ps[:200]:
        expect = sum(1 for _, gg, v in rows if gg == r["g"] and v <= r["value"])
        assert r["cum_one"] == expect
    rk = {(r["g"], r["value"]): r["rank"] for r in average_ranks(df, ["g"], n_partitions=5).collect()}
    for g in "abc":
        vals = sorted(v for _, gg, v in rows if gg == g)
        for v in set(vals[:50]):
            first = vals.index(v) + 1
            last = len(vals) - vals[::-1].index(v)
            assert rk[(g, v)] == pytest.approx((first + last) / 2)


def test_prefix_sums_on_strings(spark):
    words = [f"w{random.Random(5).randint(0, 50):03d}{i % 7}" for i in range(400)]
    df = spark.createDataFrame([(w,) for w in words], "value string").distinct().withColumn("one", F.lit(1))
    got = {r["value"]: r["cum_one"] for r in prefix_sums(df, [], "value", ["one"], n_partitions=9).collect()}
    for i, w in enumerate(sorted(set(words))):
        assert got[w] == i + 1


def test_results_do_not_depend_on_partitioning(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    a = exact_quantiles(li.select(F.lit("x").alias("feature"), F.col("l_extendedprice").alias("value")),
                        ["feature"], [0.1, 0.5, 0.9]).orderBy("prob").collect()
    b = exact_quantiles(li.repartition(13).select(F.lit("x").alias("feature"),
                                                  F.col("l_extendedprice").alias("value")),
                        ["feature"], [0.1, 0.5, 0.9]).orderBy("prob").collect()
    assert a == b
    s1 = L.split(table(spark, sf_dir, "orders"), ["o_orderkey"], 0.3, 9).where("is_test") \
        .select("o_orderkey").orderBy("o_orderkey").collect()
    s2 = L.split(table(spark, sf_dir, "orders").repartition(7), ["o_orderkey"], 0.3, 9).where("is_test") \
        .select("o_orderkey").orderBy("o_orderkey").collect()
    assert s1 == s2


@pytest.mark.parametrize("test_size", [0.0, 0.2, 0.5, 1.0])
def test_split_exact_disjoint_complete(spark, sf_dir, test_size):
    o = table(spark, sf_dir, "orders")
    n = o.count()
    s = L.split(o, ["o_orderkey"], test_size, 42)
    t = s.where("is_test").count()
    assert t == int(np.ceil(test_size * n))
    assert s.count() == n and s.select("o_orderkey").distinct().count() == n


def test_stratified_split_per_class(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    s = L.split(o, ["o_orderkey"], 0.25, 1, stratify_by="o_orderstatus")
    for r in s.groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.sum(F.col("is_test").cast("int"))
                                            .alias("t")).collect():
        assert r["t"] == int(np.ceil(0.25 * r["n"]))


def test_folds_balanced(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    f = L.assign_folds(o, ["o_orderkey"], 5, 3, stratify_by="o_orderstatus")
    sizes = [r["n"] for r in f.groupBy("fold").count().withColumnRenamed("count", "n").collect()]
    assert len(sizes) == 5 and max(sizes) - min(sizes) <= 3


def test_fit_apply_equals_one_shot(spark, sf_dir):
    from tabforge.operators.scale import apply_scaler, fit_scaler, scale
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_tax")
    one, _ = scale(li, "robust", ["l_quantity", "l_tax"])
    two = apply_scaler(li, fit_scaler(li, "robust", ["l_quantity", "l_tax"]))
    assert sorted(one.collect()) == sorted(two.collect())


def test_models_learn_a_planted_label(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax", "l_extendedprice")
    v = F.col("l_quantity") * (1 - F.col("l_discount"))
    med = li.select(F.percentile(v, 0.5).alias("m")).first()["m"]
    df = li.withColumn("y", (v > med).cast("int")).withColumn("k", F.monotonically_increasing_id())
    tr, te = L.train_test(df, ["l_orderkey", "l_linenumber", "k"], 0.3, 1)
    feats = ["l_quantity", "l_discount", "l_tax"]
    for mt, hp in (("random_forest", {"n_estimators": 20, "max_depth": 5}), ("logistic_regression", {"C": 10.0})):
        m = M.train(tr, feats, "y", mt, "classification", hp)
        p = M.predict(m, te, ["k"], "y")
        sums = p.select(F.aggregate("probability", F.lit(0.0), lambda a, b: a + b).alias("s")).collect()
        assert all(abs(r["s"] - 1) < 1e-9 for r in sums)
        met = {r["metric"]: r["value"] for r in M.evaluate(m, te, ["k"], "y").collect()}
        assert met["roc_auc"] > 0.9 and met["accuracy"] > 0.8


def test_unsupported_model_raises(spark):
    with pytest.raises(ValueError):
        M.build_estimator("xgboost", "classification", {}, 10)


def test_stratified_split_null_class_is_its_own_stratum(spark):
    rows = [(i, None if i % 4 == 0 else ("a" if i % 3 else "b")) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, cls string")
    s = L.split(df, ["id"], 0.3, 5, stratify_by="cls")
    got = {r["cls"]: (r["n"], r["t"]) for r in s.groupBy("cls").agg(
        F.count("*").alias("n"), F.sum(F.col("is_test").cast("int")).alias("t")).collect()}
    for cls, (n, t) in got.items():
        assert t == int(np.ceil(0.3 * n)), cls


def _knn_brute(rows, k=5):
    """Reference KNN imputation (NaN-Euclidean, ties by key) in plain Python."""
    p = len(rows[0]) - 1
    out = {}
    for key, *x in rows:
        filled = list(x)
        for j in range(p):
            if x[j] is not None:
                continue
            cands = []
            for dkey, *y in rows:
                if y[j] is None:
                    continue
                co = [i for i in range(p) if i != j and x[i] is not None and y[i] is not None]
                if not co:
                    continue
                dist = (p / len(co) * sum((x[i] - y[i]) ** 2 for i in co)) ** 0.5
                cands.append((dist, dkey, y[j]))
            cands.sort()
            if cands:
                filled[j] = sum(v for _, _, v in cands[:k]) / len(cands[:k])
            else:
                filled[j] = sum(r[j + 1] for r in rows if r[j + 1] is not None) / sum(
                    1 for r in rows if r[j + 1] is not None)
        out[key] = filled
    return out


def test_knn_matches_brute_force_with_a_hot_point(spark):
    from tabforge.operators.knn import knn_impute
    rnd = random.Random(11)
    rows = []
    for i in range(300):
        if i % 3 == 0:                       # a third of the rows share one point
            x = [1.0, 2.0, 3.0]
        else:
            x = [float(rnd.randint(0, 20)), rnd.random() * 10, float(rnd.randint(0, 5))]
        if i % 7 == 0:
            x[i % 3] = None
        if i % 29 == 0:
            x[(i + 1) % 3] = None
        rows.append((i, *x))
    df = spark.createDataFrame(rows, "id long, a double, b double, c double")
    got = {r["id"]: [r["a"], r["b"], r["c"]] for r in knn_impute(df, ["a", "b", "c"], "id", 5).collect()}
    exp = _knn_brute(rows)
    for key, vals in exp.items():
        assert got[key] == pytest.approx(vals, rel=1e-12, abs=1e-12), key


def _wide_rows(n, p, seed):
    rng = np.random.default_rng(seed)
    centers = rng.normal(0, 5, (12, p))
    x = centers[rng.integers(0, 12, n)] + rng.normal(0, 1, (n, p))
    x[rng.random(n) < 0.3] = centers[0]                          # a third of the rows at one point
    x[:, 1] = np.round(x[:, 1])
    holes = rng.random((n, p)) < np.where(rng.random((n, 1)) < 0.5, 0.2, 0.0)  # many patterns
    holes[:5] = True                                             # rows with nothing to compare
    holes[5:9, 1:] = True
    return [(i, *[None if h else float(v) for v, h in zip(r, hs)]) for i, (r, hs) in enumerate(zip(x, holes))]


@pytest.mark.parametrize("small", [False, True])
def test_knn_with_many_columns_and_patterns(spark, small):
    from tabforge.operators import knn
    rows = _wide_rows(500, 14, 3)
    cols = [f"c{i}" for i in range(14)]
    df = spark.createDataFrame(rows, "id long, " + ", ".join(f"{x} double" for x in cols))
    layout = knn.Layout(block=8, chunk=3, maps=6, bundle=16, share=3, pivots=9, sample=20) if small else knn.Layout()
    got = {r["id"]: [r[x] for x in cols] for r in knn.knn_impute(df, cols, "id", 4, layout=layout).collect()}
    exp = _knn_brute(rows, 4)
    assert len(got) == len(rows)
    for key, vals in exp.items():
        assert got[key] == pytest.approx(vals, rel=1e-9, abs=1e-9), key


def test_knn_bounds_hold():
    from tabforge.operators import knn
    rng = np.random.default_rng(4)
    for _ in range(200):
        x = np.round(rng.normal(0, 1, (6, 5)), 1)
        x[rng.random(x.shape) < rng.choice([0, .3, .7])] = np.nan
        r = np.round(rng.normal(0, 1, (9, 5)), 1)
        r[rng.random(r.shape) < .3] = np.nan
        some = ~np.isnan(x)
        lo = np.where(some.any(0), np.where(some, x, np.inf).min(0), np.nan)
        hi = np.where(some.any(0), np.where(some, x, -np.inf).max(0), np.nan)
        least = knn.distances(r, x).min(1)
        pivot = rng.normal(0, 1, 5)
        radius = np.sqrt(np.nansum((x - pivot) ** 2, axis=1)).max()
        zone = knn.Zones(lo[None], hi[None], some.all(0)[None], np.array([(~some).sum(1).max()]), pivot[None],
                         np.array([radius]))
        assert (knn.box_bound(r, zone)[:, 0] <= least).all()
        assert (knn.pivot_bound(r, zone)[:, 0] <= least).all()


def test_registry_roundtrip(spark, sf_dir, tmp_path):
    from tabforge.ml import registry as P
    li = table(spark, sf_dir, "lineitem").select("l_quantity", "l_discount", "l_tax").limit(200) \
        .withColumn("y", (F.col("l_quantity") > 25).cast("int"))
    m = M.train(li, ["l_quantity", "l_discount"], "y", "logistic_regression", "classification", {"max_iter": 20})
    reg = str(tmp_path / "registry")
    for name, acc, when in [("lr_a", 0.81, "2024-01-01T10:00:00"), ("lr_b", 0.75, "2024-02-01T11:30:00")]:
        M.save_model(m, str(tmp_path / name), {"model_type": name, "training_date": when,
                                               "evaluation_metrics": {"accuracy": acc, "precision": acc,
                                                                      "recall": acc, "f1_score": acc}},
                     registry_dir=reg)
    lb = P.read_registry(spark, reg)
    rec = P.recommend(lb).first()
    assert rec["recommended_model"] == "lr_a" and rec["confidence"] == "high"
    assert rec["improvement_pct"] == pytest.approx((0.81 - 0.75) / 0.75 * 100)
    cur = P.current_model(lb).first()
    assert cur["model_type"] == "lr_b" and cur["version_id"] == "lr_b_v20240201_1130"


def test_hash_positions_are_the_md5_order(spark):
    import hashlib
    rows = [(i, "hot" if i % 3 else ("x" if i % 2 else None)) for i in range(600)]
    df = spark.createDataFrame(rows, "id long, g string")
    got = {r["id"]: r["_pos"] for r in L.hash_positions(df, ["id"], 7, "g").collect()}
    for g in {r[1] for r in rows}:
        ids = [i for i, gg in rows if gg == g]
        order = sorted(ids, key=lambda i: (hashlib.md5(f"{i}|7".encode()).hexdigest(), i))
        assert [got[i] for i in order] == list(range(len(order)))


@pytest.mark.parametrize("op", ["target", "label", "frequency", "cramers", "mi", "describe", "auc"])
def test_operators_do_not_depend_on_partitioning(spark, sf_dir, op):
    from tabforge.operators import assoc, encode, metrics, profile, select
    from tabforge.plans.fixtures import doc_label, order_preds

    def run(df_fn):
        if op == "target":
            return encode.target_encode(df_fn(doc_label(spark, sf_dir)), ["lang", "source"], "quality")
        if op == "label":
            return encode.label_encode(df_fn(table(spark, sf_dir, "part")), ["p_brand", "p_name"])[0]
        if op == "frequency":
            return encode.frequency_encode(df_fn(table(spark, sf_dir, "customer")), ["c_mktsegment"])
        if op == "cramers":
            return assoc.cramers_v_pairs(df_fn(table(spark, sf_dir, "orders")),
                                         [("o_orderstatus", "o_orderpriority")], None)
        if op == "mi":
            return select.mutual_information(df_fn(table(spark, sf_dir, "orders")), ["o_orderpriority"],
                                             "o_orderstatus")
        if op == "describe":
            return profile.describe_numeric(df_fn(table(spark, sf_dir, "lineitem")), ["l_quantity", "l_tax"])
        return metrics.roc_auc(df_fn(order_preds(spark, sf_dir)))

    def canon(df):
        return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect())

    a = canon(run(lambda d: d))
    b = canon(run(lambda d: d.repartition(11)))
    assert a == b


def _holed(n, p, seed):
    rng = np.random.default_rng(seed)
    x = rng.normal(0, 1, (n, p)) + rng.normal(0, 1, (n, 1)) + 1e6
    x[:, 1] = np.where(rng.random(n) < .5, 7.0, np.round(x[:, 0]))  # a hot value
    x[:, 2] = 3.25                                                  # constant
    x[rng.random((n, p)) < .05] = np.nan
    x[:, p // 2:][rng.random(n) < .2] = np.nan                      # columns missing together
    return pd.DataFrame(x, columns=[f"c{i}" for i in range(p)])


@pytest.mark.parametrize("p", [10, 40])
def test_gram_matrices_match_pandas(spark, p):
    from tabforge.operators import gram
    from tabforge.operators.profile import correlation_long
    frame = _holed(400, p, p)
    frame.loc[:, "c3":"c6"] = np.where(frame[["c0"]].isna(), np.nan, np.round(frame.loc[:, "c3":"c6"], 1))
    df = spark.createDataFrame(frame).repartition(6)
    for method, out in (("pearson", gram.pearson_wide(df, list(frame))), ("spearman", gram.spearman_wide(df, list(frame)))):
        got = {(r.feature1, r.feature2): r.correlation for r in out.collect()}
        exp = frame.corr(method=method)
        assert len(got) == p * (p - 1) // 2
        for (a, b), r in got.items():
            assert (r is None) == math.isnan(exp[a][b]) and (r is None or r == pytest.approx(exp[a][b], abs=1e-9)), (a, b)
    if p == 10:
        old = {(r.feature1, r.feature2): r.correlation for r in correlation_long(df, list(frame)).collect()}
        new = {(r.feature1, r.feature2): r.correlation for r in gram.pearson_wide(df, list(frame)).collect()}
        assert old.keys() == new.keys() and all(old[k] == pytest.approx(new[k], abs=1e-9) for k in old if old[k] is not None)


def test_wide_correlations_plan_and_edges(spark):
    from tabforge.operators import gram
    from tabforge.operators import assoc
    frame = _holed(60, 300, 1)
    out = assoc.pearson_matrix(spark.createDataFrame(frame), list(frame))
    got = {(r.feature1, r.feature2): r.correlation for r in out.collect()}
    exp = frame.corr()
    assert len(got) == 300 * 299 // 2 and got[("c0", "c299")] == pytest.approx(exp["c0"]["c299"], abs=1e-9)
    none = spark.createDataFrame([], "a double, b double, c double")
    for out in (gram.pearson_wide(none, ["a", "b", "c"]), gram.spearman_wide(none, ["a", "b", "c"])):
        assert [r.correlation for r in out.collect()] == [None] * 3
    assert assoc.spearman_matrix(none, ["a"]).count() == 0


def test_spearman_matches_pandas_with_nulls(spark):
    import pandas as pd
    from tabforge.operators import assoc
    rnd = random.Random(3)
    rows = []
    for i in range(300):
        a = float(rnd.randint(0, 30)) if i % 7 else None
        b = (a or 0) * 0.5 + rnd.random() * 10 if i % 5 else None
        c = float(rnd.randint(0, 4)) if i % 11 else None
        rows.append((a, b, c))
    df = spark.createDataFrame(rows, "a double, b double, c double")
    got = {(r["feature1"], r["feature2"]): r["correlation"] for r in assoc.spearman_matrix(df, ["a", "b", "c"]).collect()}
    exp = pd.DataFrame(rows, columns=["a", "b", "c"]).corr(method="spearman")
    for (x, y), v in got.items():
        assert v == pytest.approx(exp.loc[x, y], rel=1e-9, abs=1e-12)
