"""Distributed running totals, exact quantiles and average ranks.

No global ``Window.orderBy`` (one partition) is used anywhere.  Running totals are
computed as follows:

1. callers first collapse their input to value counts where possible
   (``groupBy(group, value).count()``, map-side combined, so a hot value is one row);
2. the table is range-partitioned on ``(group, order)`` with Spark's range
   partitioner (sampled bounds, binary search per row), and the partition id is
   recorded.  The result is checkpointed to the shared checkpoint folder, so the
   partition ids stay fixed if a stage is recomputed or an executor is lost;
3. per-(group, partition) totals (a table of about ``partitions + groups`` rows)
   give exclusive offsets through a window over that small table;
4. the running sum inside each ``(group, partition)`` window plus the offset is
   the global running sum.

The window partitions are range partitions, so they are balanced by construction.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .columns import c
from ..session import materialise, reliable_checkpoint


def default_partitions(spark) -> int:
    return max(8, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def prefix_sums(df: DataFrame, group_cols: list[str], order_col: str, value_cols: list[str],
                n_partitions: int | None = None) -> DataFrame:
    """Add ``cum_<v>`` (running sum up to and including the current order value,
    ties included) and ``tot_<v>`` (group total) for every ``v`` in value_cols."""
    P = n_partitions or default_partitions(df.sparkSession)
    gc = [c(g) for g in group_cols]
    ranged = df.repartitionByRange(P, *gc, c(order_col)).withColumn("_pbk", F.spark_partition_id())
    # Reliable checkpoint: partition ids must not change if this is recomputed.
    ranged = ranged.transform(reliable_checkpoint)
    per_part = ranged.groupBy(*gc, "_pbk").agg(*[F.sum(c(v)).alias(f"_bs_{v}") for v in value_cols])
    wb = Window.partitionBy(*gc).orderBy("_pbk")
    wg = Window.partitionBy(*gc)
    offsets = per_part.select(
        *gc, "_pbk",
        *[F.coalesce(F.sum(f"_bs_{v}").over(wb.rowsBetween(Window.unboundedPreceding, -1)),
                     F.lit(0)).alias(f"_off_{v}") for v in value_cols],
        *[F.sum(f"_bs_{v}").over(wg).alias(f"tot_{v}") for v in value_cols])
    # offsets has at most (partitions + groups) rows; written, so that the planner knows
    # its size and chooses the join by it.  Null-safe on the group columns: a NULL group is a group of its own.
    off = offsets.select(*[c(g).alias(f"_og{i}") for i, g in enumerate(group_cols)],
                         F.col("_pbk").alias("_opbk"), *[x for x in offsets.columns
                                                         if x not in group_cols and x != "_pbk"])
    cond = [F.col("_pbk") == F.col("_opbk")] + [c(g).eqNullSafe(F.col(f"_og{i}"))
                                                for i, g in enumerate(group_cols)]
    b = ranged.join(materialise(off, "offsets"), cond, "inner") \
        .drop("_opbk", *[f"_og{i}" for i in range(len(group_cols))])
    w = Window.partitionBy(*gc, "_pbk").orderBy(c(order_col)) \
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    out = b.select("*", *[(F.sum(c(v)).over(w) + F.col(f"_off_{v}")).alias(f"cum_{v}")
                          for v in value_cols])
    return out.drop("_pbk", *[f"_off_{v}" for v in value_cols])


def value_counts(long_df: DataFrame, group_cols: list[str], value_col: str = "value") -> DataFrame:
    return long_df.groupBy(*[c(g) for g in group_cols], c(value_col)).agg(
        F.count(F.lit(1)).alias("_n"))


# Exact quantiles from bracketed ranks.  A sketch (bounded state, combined before the
# shuffle) gives values around each wanted rank; SKETCH is its accuracy, so its ranks
# are off by at most n / SKETCH, and the bracket NEAR is wider than that.
SKETCH = 10_000
NEAR = 6.0 / SKETCH
FEW = 20_000          # rows of a group that are ranked whole, without brackets
BRACKET = 1_000_000   # rows of a bracket that one window task may rank
PIECES = 64           # parts into which a larger bracket is cut


def _brackets(data: DataFrame, gc: list, names: list[str], probs: list[float]) -> DataFrame:
    """(_g0.., _n, _lo0, _hi0, ...): per group the row count and, per wanted rank, values below and
    above it by the sketch; a group of few rows is one bracket."""
    asked = [0.0, 1.0] + [min(1.0, max(0.0, p + d)) for p in probs for d in (-NEAR, NEAR)]
    ends = data.groupBy(*gc).agg(F.count(F.lit(1)).alias("_n"), F.percentile_approx("_v", asked, SKETCH).alias("_e"))
    few = F.col("_n") <= FEW
    cuts = [F.when(few, F.col("_e")[side]).otherwise(F.col("_e")[2 + 2 * i + side]).alias(f"_{end}{i}")
            for i in range(len(probs)) for side, end in enumerate(("lo", "hi"))]
    return ends.select(*[g.alias(f"_g{k}") for k, g in enumerate(gc)], "_n", *cuts)


def _with_brackets(data: DataFrame, ends: DataFrame, group_cols: list[str]) -> DataFrame:
    if not group_cols:
        return data.join(F.broadcast(ends))  # one row
    same = [c(g).eqNullSafe(F.col(f"_g{k}")) for k, g in enumerate(group_cols)]
    return data.join(ends, same).drop(*[f"_g{k}" for k in range(len(group_cols))])


def _inside(i: int):
    return (F.col("_v") >= F.col(f"_lo{i}")) & (F.col("_v") <= F.col(f"_hi{i}"))


def _refine(data: DataFrame, ends: DataFrame, group_cols: list[str], probs: list[float], size: float) -> DataFrame:
    """Narrower brackets: one pass counts the rows below each bracket and inside it and sketches
    the inside in ``PIECES`` parts; the new bracket is the part that holds the rank, with two more on
    either side."""
    m = len(probs)
    joined = _with_brackets(data, ends, group_cols)
    steps = [j / PIECES for j in range(PIECES + 1)]
    aggs = []
    for i in range(m):
        aggs += [F.count_if(F.col("_v") < F.col(f"_lo{i}")).alias(f"_below{i}"), F.count_if(_inside(i)).alias(f"_in{i}"),
                 F.percentile_approx(F.when(_inside(i), F.col("_v")), steps, SKETCH).alias(f"_cut{i}"),
                 F.first(f"_lo{i}").alias(f"_lo{i}"), F.first(f"_hi{i}").alias(f"_hi{i}")]
    gc = [c(g) for g in group_cols]
    out = joined.groupBy(*gc).agg(F.first("_n").alias("_n"), *aggs)
    cuts = []
    for i, p in enumerate(probs):
        pos = (F.col("_n") - 1).cast("double") * p
        part = (pos - F.col(f"_below{i}")) / F.col(f"_in{i}") * PIECES
        large = F.col(f"_in{i}") > size
        low = F.greatest(F.floor(part) - 2, F.lit(0)).cast("int")
        high = F.least(F.ceil(part + PIECES / F.col(f"_in{i}")) + 2, F.lit(PIECES)).cast("int")
        cuts += [F.when(large, F.get(f"_cut{i}", low)).otherwise(F.col(f"_lo{i}")).alias(f"_lo{i}"),
                 F.when(large, F.get(f"_cut{i}", high)).otherwise(F.col(f"_hi{i}")).alias(f"_hi{i}")]
    return out.select(*[g.alias(f"_g{k}") for k, g in enumerate(gc)], "_n", *cuts)


def exact_quantiles(long_df: DataFrame, group_cols: list[str], probs: list[float],
                    value_col: str = "value", n_partitions: int | None = None) -> DataFrame:
    """Linear-interpolated quantiles (numpy/pandas default, SQL ``quantile_cont``), exact:

    1. per group, the row count and a bracket of values around every wanted rank (a bounded
       sketch per group; about 0.12 % of the group's rows per rank);
    2. where a bracket holds more than ``BRACKET`` rows, it is narrowed by a sketch of its inside, again
       until it does not: each pass leaves about a thirteenth;
    3. one aggregate keyed by (group, value) counts the values inside brackets one by one and the
       rows between brackets as one; running sums over these few rows give exact ranks.

    A row is read once per pass and never multiplied, and no task receives a group as a
    whole.  Returns (group_cols..., prob double, quantile double); NULL values are ignored."""
    order = sorted({float(p) for p in probs})
    gc = [c(g) for g in group_cols]
    data = long_df.where(c(value_col).isNotNull()).select(*gc, c(value_col).cast("double").alias("_v"))
    ends = materialise(_brackets(data, gc, group_cols, order), "quantile-brackets")
    most = ends.agg(F.max("_n")).first()[0] or 0
    share = 2 * NEAR * most
    while share > BRACKET:
        ends = materialise(_refine(data, ends, group_cols, order, BRACKET), "quantile-brackets")
        share *= 6.0 / PIECES
    joined = _with_brackets(data, ends, group_cols)
    # Outside all brackets a row only counts: behind the highest bracket below it (NULL: before the first).
    behind = F.greatest(*[F.when(F.col("_v") > F.col(f"_hi{i}"), F.col(f"_hi{i}")) for i in range(len(order))]) \
        if len(order) > 1 else F.when(F.col("_v") > F.col("_hi0"), F.col("_hi0"))
    inside = _inside(0)
    for i in range(1, len(order)):
        inside = inside | _inside(i)
    # A value equal to a bracket's end is inside, so a row outside follows all rows at its key.
    cells = joined.groupBy(*gc, F.when(inside, F.col("_v")).otherwise(behind).alias("_v"), (~inside).alias("_o")).agg(
        F.count(F.lit(1)).alias("_k"), F.first("_n").alias("_n"))
    w = Window.partitionBy(*gc).orderBy(F.col("_v").asc_nulls_first(), "_o").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    ranked = cells.withColumn("_last", F.sum("_k").over(w) - 1).withColumn("_first", F.col("_last") - F.col("_k") + 1)

    def at(rank):
        return F.max(F.when(~F.col("_o") & (rank >= F.col("_first")) & (rank <= F.col("_last")), F.col("_v")))

    found = []
    for p in order:
        pos = (F.col("_n") - 1).cast("double") * p
        found.append(F.struct(F.lit(p).alias("prob"), at(F.floor(pos)).alias("lo"), at(F.ceil(pos)).alias("hi"),
                              F.max(pos - F.floor(pos)).alias("f")))
    out = ranked.groupBy(*gc).agg(F.array(*found).alias("_q")).select(*gc, F.inline("_q"))
    value = F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("f")
    out = materialise(out.select(*gc, "prob", value.alias("quantile")), "quantiles")
    if not out.where(F.col("quantile").isNull()).isEmpty():  # a sketch off by more than it promises
        return _prefix_quantiles(data, group_cols, probs, "_v", n_partitions)
    return out


def _prefix_quantiles(data: DataFrame, group_cols: list[str], probs: list[float], value_col: str,
                      n_partitions: int | None) -> DataFrame:
    vc = value_counts(data, group_cols, value_col)
    ps = prefix_sums(vc, group_cols, value_col, ["_n"], n_partitions)
    parr = F.array(*[F.lit(float(p)) for p in probs])
    first_pos = F.col("cum__n") - F.col("_n")
    last_pos = F.col("cum__n") - 1

    def _pos(p):
        return (F.col("tot__n") - 1).cast("double") * p

    def _hit(p):
        lo, hi = F.floor(_pos(p)), F.ceil(_pos(p))
        return ((lo >= first_pos) & (lo <= last_pos)) | ((hi >= first_pos) & (hi <= last_pos))

    hits = ps.where(F.exists(parr, _hit)).select(
        *[c(g) for g in group_cols], c(value_col).alias("_v"), first_pos.alias("_a"),
        last_pos.alias("_b"), "tot__n", F.explode(parr).alias("prob"))
    pos = (F.col("tot__n") - 1).cast("double") * F.col("prob")
    lo, hi = F.floor(pos), F.ceil(pos)
    hits = hits.select("*", ((lo >= F.col("_a")) & (lo <= F.col("_b"))).alias("_is_lo"),
                       ((hi >= F.col("_a")) & (hi <= F.col("_b"))).alias("_is_hi"),
                       (pos - lo).alias("_frac"))
    g = hits.groupBy(*[c(g) for g in group_cols], "prob").agg(
        F.max(F.when(F.col("_is_lo"), F.col("_v"))).alias("_vlo"),
        F.max(F.when(F.col("_is_hi"), F.col("_v"))).alias("_vhi"),
        F.max("_frac").alias("_frac"))
    q = F.col("_vlo") + (F.col("_vhi") - F.col("_vlo")) * F.col("_frac")
    return g.select(*[c(g_) for g_ in group_cols], "prob", q.cast("double").alias("quantile"))


def quantile_table(df: DataFrame, cols: list[str], probs: list[float],
                   n_partitions: int | None = None) -> DataFrame:
    """Exact quantiles of several numeric columns at once: (feature, prob, quantile)."""
    from .columns import unpivot_numeric
    return exact_quantiles(unpivot_numeric(df, cols), ["feature"], probs, n_partitions=n_partitions)


def quantiles_wide(df: DataFrame, cols: list[str], probs: list[float], names: list[str],
                   n_partitions: int | None = None) -> DataFrame:
    """(feature, <name_i>...) — one row per feature with each requested quantile."""
    q = quantile_table(df, cols, probs, n_partitions)
    return q.groupBy("feature").agg(*[
        F.max(F.when(F.col("prob") == float(p), F.col("quantile"))).alias(n)
        for p, n in zip(probs, names)])


def average_ranks(long_df: DataFrame, group_cols: list[str], value_col: str = "value",
                  n_partitions: int | None = None) -> DataFrame:
    """Average (1-based) rank of every distinct value within its group, as
    pandas ``rank(method='average')``: (group..., value, rank)."""
    vc = value_counts(long_df.where(c(value_col).isNotNull()), group_cols, value_col)
    ps = prefix_sums(vc, group_cols, value_col, ["_n"], n_partitions)
    rank = F.col("cum__n") - (F.col("_n") - 1) / 2.0
    return ps.select(*[c(g) for g in group_cols], c(value_col), rank.cast("double").alias("rank"),
                     F.col("_n").alias("n"), F.col("cum__n").alias("cum_n"),
                     F.col("tot__n").alias("tot_n"))
