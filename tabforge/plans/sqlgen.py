"""SQL text builders for the oracle side (plain ANSI-ish SQL run by DuckDB).

These spell out the textbook definition of each statistic per column or pair, so
the oracle is an independent formulation of what the Spark operators compute.
"""

from __future__ import annotations


def rsig(x: str, digits: int = 12) -> str:
    """SQL twin of :func:`tabforge.functions.stats.rsig`."""
    x = f"({x})"
    m = f"CAST({digits - 1} - floor(log10(abs({x}))) AS INTEGER)"
    return (f"(CASE WHEN {x} IS NULL OR {x} = 0 THEN {x} WHEN {m} >= 0 "
            f"THEN round({x} * pow(10.0, {m}), 0) / pow(10.0, {m}) "
            f"ELSE round({x} / pow(10.0, -{m}), 0) * pow(10.0, -{m}) END)")


def union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def pairs(cols: list[str]) -> list[tuple[str, str]]:
    return [(cols[i], cols[j]) for i in range(len(cols)) for j in range(i + 1, len(cols))]


def pearson_long(src: str, cols: list[str], extra: bool = False) -> str:
    """(feature1, feature2, correlation[, slope, intercept]) pairwise-complete."""
    parts = []
    for a, b in pairs(cols):
        r = (f"regr_sxy(CAST({b} AS DOUBLE), CAST({a} AS DOUBLE)) / "
             f"sqrt(regr_sxx(CAST({b} AS DOUBLE), CAST({a} AS DOUBLE)) * "
             f"regr_syy(CAST({b} AS DOUBLE), CAST({a} AS DOUBLE)))")
        sel = f"SELECT '{a}' AS feature1, '{b}' AS feature2, {r} AS correlation"
        if extra:
            sel += (f", regr_slope(CAST({b} AS DOUBLE), CAST({a} AS DOUBLE)) AS slope"
                    f", regr_intercept(CAST({b} AS DOUBLE), CAST({a} AS DOUBLE)) AS intercept")
        parts.append(f"{sel} FROM {src}")
    return union(parts)


def cramers_v_grid(src: str, pair_list: list[tuple[str, str]], decimals: int | None = 3) -> str:
    """(feature1, feature2, cramers_v) from chi-square over the FULL contingency grid
    (zero cells included), Yates-corrected when dof = 1, as scipy's default."""
    obs = union([f"SELECT '{a}' AS f1, '{b}' AS f2, CAST({a} AS VARCHAR) AS v1, CAST({b} AS VARCHAR) AS v2 "
                 f"FROM {src} WHERE {a} IS NOT NULL AND {b} IS NOT NULL" for a, b in pair_list])
    v = ("CASE WHEN least(nr, nc) - 1 <= 0 THEN 0.0 ELSE sqrt(chi2 / (n * (least(nr, nc) - 1))) END")
    if decimals is not None:
        v = f"round({v}, {decimals})"
    return f"""(WITH cv_rows AS ({obs}),
cv_o AS (SELECT f1, f2, v1, v2, count(*) AS o FROM cv_rows GROUP BY f1, f2, v1, v2),
cv_r AS (SELECT f1, f2, v1, sum(o) AS r FROM cv_o GROUP BY f1, f2, v1),
cv_c AS (SELECT f1, f2, v2, sum(o) AS cc FROM cv_o GROUP BY f1, f2, v2),
cv_n AS (SELECT f1, f2, sum(r) AS n, count(*) AS nr FROM cv_r GROUP BY f1, f2),
cv_m AS (SELECT f1, f2, count(*) AS nc FROM cv_c GROUP BY f1, f2),
cv_grid AS (SELECT r.f1, r.f2, r.v1, c.v2, r.r, c.cc, n.n, n.nr, m.nc, r.r * c.cc / n.n AS e,
                   coalesce(o.o, 0) AS o
            FROM cv_r r JOIN cv_c c ON r.f1 = c.f1 AND r.f2 = c.f2
            JOIN cv_n n ON n.f1 = r.f1 AND n.f2 = r.f2 JOIN cv_m m ON m.f1 = r.f1 AND m.f2 = r.f2
            LEFT JOIN cv_o o ON o.f1 = r.f1 AND o.f2 = r.f2 AND o.v1 = r.v1 AND o.v2 = c.v2),
cv_chi AS (SELECT f1, f2, any_value(n) AS n, any_value(nr) AS nr, any_value(nc) AS nc,
                  sum(CASE WHEN (nr - 1) * (nc - 1) = 1
                           THEN pow(greatest(abs(o - e) - 0.5, 0), 2) / e
                           ELSE pow(o - e, 2) / e END) AS chi2
           FROM cv_grid GROUP BY f1, f2)
SELECT f1 AS feature1, f2 AS feature2, {v} AS cramers_v FROM cv_chi)"""


def avg_rank(col: str, src: str) -> str:
    """Average rank (ties share the mean position) as a window expression."""
    return (f"(rank() OVER (ORDER BY {col}) + (count(*) OVER (PARTITION BY {col}) - 1) / 2.0)")


def mi_sql(src: str, features: list[tuple[str, str]], target: str) -> str:
    """(feature, mi) plug-in mutual information in nats; features given as
    (name, SQL expression of the discrete value)."""
    rows = union([f"SELECT '{n}' AS feature, CAST({e} AS VARCHAR) AS x, CAST({target} AS VARCHAR) AS y "
                  f"FROM {src}" for n, e in features])
    return f"""(WITH mi_rows AS (SELECT * FROM ({rows}) WHERE x IS NOT NULL AND y IS NOT NULL),
mi_xy AS (SELECT feature, x, y, count(*) AS nxy FROM mi_rows GROUP BY feature, x, y),
mi_x AS (SELECT feature, x, count(*) AS nx FROM mi_rows GROUP BY feature, x),
mi_y AS (SELECT feature, y, count(*) AS ny FROM mi_rows GROUP BY feature, y),
mi_n AS (SELECT feature, count(*) AS n FROM mi_rows GROUP BY feature)
SELECT a.feature, greatest(sum(a.nxy / n.n * ln(a.nxy * n.n / (x.nx * y.ny))), 0) AS mi
FROM mi_xy a JOIN mi_x x ON a.feature = x.feature AND a.x = x.x
JOIN mi_y y ON a.feature = y.feature AND a.y = y.y JOIN mi_n n ON a.feature = n.feature
GROUP BY a.feature)"""
