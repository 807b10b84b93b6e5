"""Categorical encoders (section D).

* one-hot (D1) for columns with at most ``max_categories`` distinct values: columns
  ``<col>_<cat>`` in sorted category order, NULL its own category (``nan``, last),
  original dropped and the new columns appended; unseen values -> all zeros.
* label (D2): code = position of ``coalesce(value, 'nan')`` among the sorted
  distinct strings; computed with distributed prefix sums, applied by a join.
* auto routing (D3), smoothed target encoding (D4), frequency encoding (D5),
  dummy encoding with drop-first (D6), as columns up to a limit that raises, or as one sparse
  vector for any number of categories.

Category lists that go through the driver are bounded by ``max_categories`` (``max_columns`` for dummies).
Per-value maps (label, target, frequency) stay DataFrames and are joined; Spark
chooses the join by the map's size in bytes and splits skewed keys at run time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import c, string_columns, unpivot_strings
from ..functions.params import params_from_rows
from ..functions.ranks import prefix_sums
from ..session import materialise

NULL_LABEL = "nan"
MAX_DUMMY_COLUMNS = 10_000


def _join_map(df: DataFrame, m: DataFrame, left_col, right_col: str) -> DataFrame:
    # Maps hold no NULL value: a plain equality, so that NULL rows need no partner.
    return df.join(m, left_col == F.col(right_col), "left").drop(right_col)


def distinct_counts(df: DataFrame, cols: list[str]) -> dict[str, int]:
    """Exact number of distinct non-null values per column, all columns in one job."""
    if not cols:
        return {}
    long = unpivot_strings(df, cols, drop_nulls=True).distinct()
    got = {r["feature"]: r["n"] for r in long.groupBy("feature").agg(F.count(F.lit(1)).alias("n")).collect()}
    return {x: got.get(x, 0) for x in cols}


def fit_onehot(df: DataFrame, cols: list[str], max_categories: int = 10,
               drop_first: bool = False, include_null: bool = True) -> DataFrame:
    """Category lists for columns with <= max_categories distinct non-null values.
    Only those lists reach the driver (bounded by columns x max_categories)."""
    spark = df.sparkSession
    long = unpivot_strings(df, cols).distinct()
    sizes = long.where(F.col("value").isNotNull()).groupBy("feature").agg(F.count(F.lit(1)).alias("k"))
    small = sizes.where(F.col("k") <= max_categories).select("feature")
    cats = long.join(F.broadcast(small), "feature").collect()  # small has <= len(cols) rows
    per: dict[str, list] = {}
    for r in cats:
        per.setdefault(r["feature"], []).append(r["value"])
    rows = []
    for col in cols:
        if col not in per:
            continue
        vals = sorted(v for v in per[col] if v is not None)
        if include_null and any(v is None for v in per[col]):
            vals.append(None)
        if drop_first and vals:
            vals = vals[1:]
        op = "dummy" if drop_first else "onehot"
        rows += [(op, col, NULL_LABEL if v is None else v, float(i), v) for i, v in enumerate(vals)]
    return params_from_rows(spark, rows)


def apply_onehot(df: DataFrame, params: DataFrame, as_type: str = "double") -> DataFrame:
    got: dict[str, list[tuple[float, str, str | None]]] = {}
    for r in params.where(F.col("op").isin("onehot", "dummy")).collect():
        got.setdefault(r["feature"], []).append((r["num"], r["key"], r["text"]))
    keep = [c(x) for x in df.columns if x not in got]
    new = []
    for col in [x for x in df.columns if x in got]:
        for _, label, val in sorted(got[col]):
            ind = c(col).isNull() if val is None else F.coalesce(c(col) == F.lit(val), F.lit(False))
            # A NULL next to the literal text "nan": the text keeps the name, NULL gets one of its own.
            clash = val is None and any(v == NULL_LABEL for _, _, v in got[col])
            new.append(ind.cast(as_type).alias(f"{col}_{label}" + ("_null" if clash else "")))
    return df.select(*keep, *new)


def onehot_encode(df: DataFrame, cols: list[str] | None = None, max_categories: int = 10):
    cols = cols if cols is not None else string_columns(df)
    p = fit_onehot(df, cols, max_categories)
    return apply_onehot(df, p), p


def dummy_encode(df: DataFrame, cols: list[str] | None = None, as_type: str = "int",
                 max_columns: int = MAX_DUMMY_COLUMNS) -> DataFrame:
    """``pd.get_dummies(drop_first=True)``: all categories of every string column, the
    lowest dropped; NULL gets no column (its row is all zeros).  More than ``max_columns`` new
    columns raise: :func:`dummy_vector` takes any number."""
    cols = cols if cols is not None else string_columns(df)
    wide = sum(max(n - 1, 0) for n in distinct_counts(df, cols).values())
    if wide > max_columns:
        raise ValueError(f"{wide} dummy columns are more than {max_columns}; use dummy_vector")
    p = fit_onehot(df, cols, max_categories=2 ** 31 - 1, drop_first=True, include_null=False)
    return apply_onehot(df, p, as_type)


def fit_dummy_positions(df: DataFrame, cols: list[str]) -> DataFrame:
    """(feature, value, position, code, size): the place of every dummy column among those of all ``cols``
    (in the order of ``cols``, then of the values; the lowest value of a feature has none), its place within
    its feature and the feature's number of places.  The list of categories stays distributed; one
    number per column reaches the driver."""
    values = unpivot_strings(df, cols, drop_nulls=True).distinct().withColumn("_one", F.lit(1))
    ranked = materialise(prefix_sums(values, ["feature"], "value", ["_one"]).select(
        "feature", "value", (F.col("cum__one") - 2).alias("code"), (F.col("tot__one") - 1).alias("size")), "dummy-codes")
    sizes = {r["feature"]: r["size"] for r in ranked.groupBy("feature").agg(F.first("size").alias("size")).collect()}
    before, starts = 0, []
    for x in cols:
        starts.append(F.when(F.col("feature") == x, F.lit(before)))
        before += sizes.get(x, 0)
    return ranked.where("code >= 0").select("feature", "value", (F.coalesce(*starts) + F.col("code")).cast("long")
                                            .alias("position"), F.col("code").cast("long").alias("code"),
                                            F.col("size").cast("long").alias("size"))


def apply_dummy_positions(df: DataFrame, positions: DataFrame, cols: list[str], out: str = "dummies",
                          which: str = "position") -> DataFrame:
    """``df`` without ``cols`` and with ``out``, an array of the row's positions (``code``: of its place within each
    column, in the order of ``cols``, NULL for none).  NULL, lowest and unseen values have none."""
    names = [f"_dummy{i}" for i in range(len(cols))]
    res = df
    for x, name in zip(cols, names):
        one = positions.where(F.col("feature") == x).select(F.col("value").alias("_dv"), F.col(which).alias(name))
        res = _join_map(res, one, c(x).cast("string"), "_dv")
    found = F.array(*[F.col(n) for n in names]).cast("array<bigint>")
    if which == "position":
        found = F.array_compact(found)
    return res.select(*[c(x) for x in df.columns if x not in cols], found.alias(out))


def dummy_vector(df: DataFrame, cols: list[str] | None = None, out: str = "dummies",
                 positions: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Drop-first dummies as one sparse vector column for models, any number of categories: every value's code
    comes by a join, Spark's encoder and assembler make the vector.  Returns (rows, positions); ``positions``
    of an earlier call re-applies its columns."""
    from pyspark.ml.feature import OneHotEncoder, VectorAssembler
    cols = cols if cols is not None else string_columns(df)
    if positions is None:
        positions = materialise(fit_dummy_positions(df, cols), "dummy-positions")
    sizes = {r["feature"]: r["size"] for r in positions.groupBy("feature").agg(F.first("size").alias("size")).collect()}
    wide = [x for x in cols if sizes.get(x)]
    if not wide:
        raise ValueError("no column has two values")
    rows = apply_dummy_positions(df, positions, cols, "_codes", "code")
    codes, vectors = [f"_code{i}" for i in range(len(wide))], [f"_vector{i}" for i in range(len(wide))]
    # A code one past the last stands for no category; the encoder leaves it (handleInvalid, dropLast) all zeros.
    rows = rows.select("*", *[F.coalesce(F.get("_codes", F.lit(cols.index(x))), F.lit(sizes[x])).cast("double").alias(n)
                              for x, n in zip(wide, codes)])
    largest = df.sparkSession.createDataFrame([tuple(float(sizes[x] - 1) for x in wide)], [*codes])
    encoder = OneHotEncoder(inputCols=codes, outputCols=vectors, handleInvalid="keep", dropLast=True).fit(largest)
    rows = VectorAssembler(inputCols=vectors, outputCol=out).transform(encoder.transform(rows))
    return rows.drop("_codes", *codes, *vectors), positions


def fit_label(df: DataFrame, col: str) -> DataFrame:
    """(value, code): code = index of the value among sorted distinct strings, NULL
    counted as the text ``nan``.  Distinct values -> prefix sums (no global window)."""
    d = df.select(F.coalesce(c(col).cast("string"), F.lit(NULL_LABEL)).alias("value")).distinct() \
        .withColumn("_one", F.lit(1))
    ps = prefix_sums(d, [], "value", ["_one"])
    return ps.select("value", (F.col("cum__one") - 1).cast("int").alias("code"))


def apply_label(df: DataFrame, col: str, mapping: DataFrame, out: str | None = None) -> DataFrame:
    m = mapping.select(F.col("value").alias("_lv"), F.col("code").alias("_lc"))  # other columns may be there
    j = _join_map(df, m, F.coalesce(c(col).cast("string"), F.lit(NULL_LABEL)), "_lv")
    target = out or col
    cols = [F.col("_lc").alias(target) if x == target else c(x) for x in df.columns]
    if target not in df.columns:
        cols.append(F.col("_lc").alias(target))
    return j.select(*cols)


def label_encode(df: DataFrame, cols: list[str]) -> tuple[DataFrame, dict[str, DataFrame]]:
    maps = {}
    for col in cols:
        maps[col] = fit_label(df, col)
        df = apply_label(df, col, maps[col])
    return df, maps


def encode_categorical(df: DataFrame, strategy: str = "onehot", cols: list[str] | None = None,
                       max_categories: int = 10, target: str | None = None):
    """Auto routing (D3): one-hot when strategy is onehot and the column has at most
    max_categories values; label when strategy is label or cardinality is larger.
    ``target`` (documented but unimplemented in the reference) routes to smoothed
    target encoding (D4) and needs the target column."""
    if strategy == "target":
        if target is None:
            raise ValueError("strategy 'target' needs the target column")
        cols = [x for x in (cols if cols is not None else string_columns(df, [target])) if x in df.columns]
        g, table = fit_target_encoding(df, cols, target)
        return apply_target_encoding(df, cols, g, table), {"target": table, "global_mean": g}
    if strategy not in ("onehot", "label"):
        raise ValueError(f"Unknown encoding strategy: {strategy}")
    cols = [x for x in (cols if cols is not None else string_columns(df)) if x in df.columns]
    sizes = distinct_counts(df, cols)
    oh = [x for x in cols if strategy == "onehot" and sizes[x] <= max_categories]
    lab = [x for x in cols if x not in oh]
    out, maps = label_encode(df, lab)
    params = fit_onehot(df, oh, max_categories) if oh else None
    if params is not None:
        out = apply_onehot(out, params)
    return out, {"onehot": params, "label": maps}


def fit_target_encoding(df: DataFrame, cols: list[str], target: str, min_samples: int = 10,
                        smoothing: float = 1.0) -> tuple[float, DataFrame]:
    """Global mean and (feature, value, enc) for categories with n >= min_samples:
    enc = (n*mean + smoothing*global) / (n + smoothing).  One aggregate for all columns."""
    g = df.agg(F.avg(c(target)).alias("g")).first()["g"]
    long = unpivot_strings(df, cols, keep=[target], drop_nulls=True)
    st = long.groupBy("feature", "value").agg(F.avg(c(target)).alias("m"), F.count(c(target)).alias("n"))
    st = st.where(F.col("n") >= min_samples)
    enc = (F.col("n") * F.col("m") + F.lit(smoothing) * F.lit(g)) / (F.col("n") + F.lit(smoothing))
    return g, st.select("feature", "value", enc.alias("enc"))


def apply_target_encoding(df: DataFrame, cols: list[str], global_mean: float, table: DataFrame,
                          suffix: str = "_target_encoded") -> DataFrame:
    out = df
    for col in cols:
        m = table.where(F.col("feature") == col).select(F.col("value").alias("_tv"),
                                                         F.col("enc").alias("_te"))
        out = _join_map(out, m, c(col), "_tv")
        out = out.withColumn(col + suffix, F.coalesce(F.col("_te"), F.lit(global_mean))).drop("_te")
    return out


def target_encode(df: DataFrame, cols: list[str], target: str, min_samples: int = 10,
                  smoothing: float = 1.0) -> DataFrame:
    g, t = fit_target_encoding(df, cols, target, min_samples, smoothing)
    return apply_target_encoding(df, cols, g, t)


def fit_frequency(df: DataFrame, cols: list[str]) -> DataFrame:
    """(feature, value, freq) = share among non-null values; only columns with more
    than one distinct value get a map."""
    long = unpivot_strings(df, cols, drop_nulls=True)
    vc = long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
    tot = vc.groupBy("feature").agg(F.sum("n").alias("t"), F.count(F.lit(1)).alias("k"))
    # tot has one row per column: bounded.
    return vc.join(F.broadcast(tot.where(F.col("k") > 1)), "feature") \
        .select("feature", "value", (F.col("n") / F.col("t")).alias("freq"))


def apply_frequency(df: DataFrame, cols: list[str], table: DataFrame, suffix: str = "_frequency") -> DataFrame:
    """Join the fitted shares; values unseen at fit time (and NULL) get NULL."""
    out = df
    present = {r["feature"] for r in table.select("feature").distinct().collect()}  # <= len(cols) rows
    for col in cols:
        if col not in present:
            continue
        m = table.where(F.col("feature") == col).select(F.col("value").alias("_fv"),
                                                         F.col("freq").alias(col + suffix))
        out = _join_map(out, m, c(col), "_fv")
    return out


def frequency_encode(df: DataFrame, cols: list[str] | None = None, exclude: list[str] = (),
                     suffix: str = "_frequency") -> DataFrame:
    cols = cols if cols is not None else string_columns(df, exclude)
    return apply_frequency(df, cols, fit_frequency(df, cols), suffix)
