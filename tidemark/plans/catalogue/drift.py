"""Feature and prediction drift."""

from pyspark.sql import functions as F

from tidemark.functions.columns import rounded
from tidemark.functions.exact_ks import EXACT_MAX_ROWS
from tidemark.operators import drift
from tidemark.plans.catalogue.base import CUT, FEATURES, lineitem, long_sql, query, rnd, scored, scored_ctes, tidy
from tidemark.sources.tables import load_parquet

IS_BASE = f"CAST(l_shipdate < TIMESTAMP '{CUT}' AS INTEGER) AS b"


def ks_ctes(rows: str) -> str:
    """CTEs ending in ``ks(feature, n, m, d)`` from rows (b, feature, v)."""
    return f"""vals AS (SELECT feature, v, sum(b)::DOUBLE AS cb, sum(1 - b)::DOUBLE AS cp FROM ({rows}) WHERE v IS NOT NULL GROUP BY 1, 2),
run AS (SELECT feature, sum(cb) OVER w AS fb, sum(cp) OVER w AS fp, sum(cb) OVER (PARTITION BY feature) AS n,
  sum(cp) OVER (PARTITION BY feature) AS m FROM vals WINDOW w AS (PARTITION BY feature ORDER BY v)),
ks AS (SELECT feature, max(n) AS n, max(m) AS m, max(abs(fb / nullif(n, 0) - fp / nullif(m, 0))) AS d FROM run GROUP BY feature)"""


def p_ctes(method: str) -> str:
    """CTEs ending in ``test(feature, n, m, d, p)``."""
    if method == "limit":
        z = "d * sqrt(n * m / (n + m))"
    else:
        size = "round_even(n * m / (n + m), 0)"
        z = f"d * sqrt({size}) + 1.0e0 / (6.0e0 * sqrt({size})) + (d * sqrt({size}) - 1.0e0) / (4.0e0 * {size})"
    return f"""shifted AS (SELECT *, {z} AS z FROM ks),
series AS (SELECT feature, sum(CASE WHEN k % 2 = 1 THEN 2.0e0 ELSE -2.0e0 END * exp(-2.0e0 * k * k * z * z)) AS s
  FROM shifted CROSS JOIN generate_series(1, 100) AS g(k) GROUP BY feature),
test AS (SELECT shifted.*, CASE WHEN z < 0.2e0 THEN 1.0e0 ELSE greatest(0.0e0, least(1.0e0, s)) END AS p
  FROM shifted JOIN series USING (feature))"""


RESULT = f"""feature, n::BIGINT AS n_base, m::BIGINT AS n_prod, {rnd("d")} AS drift_score, {rnd("p")} AS p_value,
  coalesce(p < 0.05e0, false) AS has_drift"""
LINE_ROWS = long_sql(FEATURES, IS_BASE)


def _sides(spark, folder):
    rows, cut = lineitem(spark, folder), F.lit(CUT).cast("timestamp_ntz")
    return rows.filter(F.col("l_shipdate") < cut), rows.filter(F.col("l_shipdate") >= cut)


@query("ks_two_sample", f"WITH {ks_ctes(LINE_ROWS)}, {p_ctes('asymp')} SELECT {RESULT} FROM test")
def ks_two_sample(spark, folder):
    return tidy(drift.ks_two_sample(*_sides(spark, folder), FEATURES, method="asymp"))


@query("ks_two_sample_cells", f"WITH {ks_ctes(LINE_ROWS)}, {p_ctes('asymp')} SELECT {RESULT} FROM test")
def ks_two_sample_cells(spark, folder):
    return tidy(drift.ks_two_sample(*_sides(spark, folder), FEATURES, method="asymp"))


@query("ks_limit_pvalue", f"WITH {ks_ctes(LINE_ROWS)}, {p_ctes('limit')} SELECT {RESULT} FROM test")
def ks_limit_pvalue(spark, folder):
    return tidy(drift.ks_two_sample(*_sides(spark, folder), FEATURES, method="limit"))


EVENT_CUT = "2024-01-16"
EVENT_FEATURES = ("value", "user_id")
EVENT_ROWS = long_sql(EVENT_FEATURES, f"CAST(ts < TIMESTAMP '{EVENT_CUT}' AS INTEGER) AS b", "events")


def exact_ctes() -> str:
    """CTEs from ``ks`` to ``exact(feature, p)``, for sides of up to ``EXACT_MAX_ROWS`` values.

    The chance that a random lattice path to (n, m) has stayed where |i/n - j/m| < d, one diagonal i + j = t a step:
    ``stay`` holds it for the points (i, t - i) inside, from i = ``lo`` on. A point is entered from (i - 1, t - i) with
    chance i/t, else from (i, t - i - 1); what lies outside the list has chance 0.
    """
    edge = "(t + 1) * b"
    low = f"greatest(0, t + 1 - m, CAST(floor(({edge} - reach) / (a + b)::DOUBLE) AS BIGINT) + 1)"
    high = f"least(n, t + 1, CAST(ceil(({edge} + reach) / (a + b)::DOUBLE) AS BIGINT) - 1)"
    return f"""sides AS (SELECT feature, n::BIGINT AS n, m::BIGINT AS m, d, gcd(n::BIGINT, m::BIGINT) AS g FROM ks
  WHERE n >= 1 AND m >= 1 AND greatest(n, m) <= {EXACT_MAX_ROWS}),
walk AS (SELECT feature, n, m, m // g AS a, n // g AS b, CAST(round(d * (n // g * m)) AS BIGINT) AS reach, 0::BIGINT AS t,
  0::BIGINT AS lo, [1.0::DOUBLE] AS stay FROM sides
  UNION ALL
  SELECT feature, n, m, a, b, reach, t + 1, low, list_transform(range(low, high + 1), lambda i:
    i / (t + 1)::DOUBLE * coalesce(stay[i - lo], 0.0::DOUBLE) + (t + 1 - i) / (t + 1)::DOUBLE * coalesce(stay[i - lo + 1], 0.0::DOUBLE))
  FROM (SELECT *, {low} AS low, {high} AS high FROM walk WHERE t < n + m AND reach > 0)),
exact AS (SELECT feature, CASE WHEN reach <= 0 THEN 1.0e0 ELSE greatest(0.0e0, 1.0e0 - coalesce(stay[n - lo + 1], 0.0::DOUBLE)) END AS p
  FROM walk WHERE t = n + m OR reach <= 0)"""


EXACT_OR_SERIES = "(SELECT test.* EXCLUDE (p), coalesce(exact.p, test.p) AS p FROM test LEFT JOIN exact USING (feature))"


@query("ks_exact_pvalue", f"WITH RECURSIVE {ks_ctes(EVENT_ROWS)}, {p_ctes('asymp')}, {exact_ctes()} SELECT {RESULT} FROM {EXACT_OR_SERIES}")
def ks_exact_pvalue(spark, folder):
    """Automatic choice of the p-value: exact while both sides are small."""
    events, cut = load_parquet(spark, folder, "events"), F.lit(EVENT_CUT).cast("timestamp_ntz")
    sides = events.filter(F.col("ts") < cut), events.filter(F.col("ts") >= cut)
    return tidy(drift.ks_two_sample(*sides, EVENT_FEATURES, method="auto"))


MEANS = """means AS (SELECT feature, avg(v) FILTER (b = 1) AS baseline_mean, avg(v) FILTER (b = 0) AS production_mean
  FROM (ROWS_) GROUP BY feature), shifts AS (SELECT *, (production_mean - baseline_mean) / nullif(baseline_mean, 0) * 100 AS diff_pct FROM means)"""


@query(
    "mean_diff_pct",
    f"""WITH {MEANS.replace("ROWS_", LINE_ROWS)} SELECT feature, {rnd("baseline_mean", 4)} AS baseline_mean,
  {rnd("production_mean", 4)} AS production_mean, {rnd("diff_pct", 4)} AS diff_pct FROM shifts""",
)
def mean_diff_pct(spark, folder):
    return tidy(drift.mean_diff(*_sides(spark, folder), FEATURES), 4)


SHIFTED_ROWS = long_sql(("l_quantity", "l_discount", "price"), "b", f"(SELECT *, {IS_BASE}, CASE WHEN l_shipdate < TIMESTAMP '{CUT}' THEN l_extendedprice ELSE l_extendedprice * 1.3e0 END AS price FROM lineitem)")


@query(
    "drift_report",
    f"""WITH {ks_ctes(SHIFTED_ROWS)}, {p_ctes("asymp")}, {MEANS.replace("ROWS_", SHIFTED_ROWS)}
SELECT coalesce(bool_or(p < 0.05e0), false) AS any_drift,
  coalesce(string_agg(feature, ',' ORDER BY feature) FILTER (p < 0.05e0), '') AS drifted_features,
  {rnd("max(abs(diff_pct))", 4)} AS max_abs_diff_pct,
  CASE WHEN coalesce(bool_or(p < 0.05e0), false) THEN '{drift.RETRAIN}' ELSE '{drift.STABLE}' END AS recommendation
FROM test JOIN shifts USING (feature)""",
)
def drift_report(spark, folder):
    base, prod = _sides(spark, folder)
    base = base.withColumn("price", F.col("l_extendedprice"))
    prod = prod.withColumn("price", F.col("l_extendedprice") * 1.3)
    report = drift.drift_report(base, prod, ["l_quantity", "l_discount", "price"], method="asymp")
    return tidy(report.withColumn("drifted_features", F.array_join("drifted_features", ",")), 4)


SCORE_ROWS = f"SELECT {IS_BASE}, 'prediction_probability' AS feature, {rnd('prediction_probability')} AS v FROM scored"


@query("prediction_drift", f"WITH {scored_ctes()}, {ks_ctes(SCORE_ROWS)}, {p_ctes('asymp')} SELECT {RESULT} FROM test")
def prediction_drift(spark, folder):
    rows, cut = scored(spark, folder), F.lit(CUT).cast("timestamp_ntz")
    rows = rows.withColumn("prediction_probability", rounded("prediction_probability"))
    sides = rows.filter(F.col("l_shipdate") < cut), rows.filter(F.col("l_shipdate") >= cut)
    return tidy(drift.prediction_drift(*sides, method="asymp"))


@query(
    "class_share_drift",
    f"""WITH {scored_ctes()}, c AS (SELECT predicted_class AS class, count(*) FILTER (b = 1) AS x, count(*) FILTER (b = 0) AS y
  FROM (SELECT predicted_class, {IS_BASE} FROM scored) GROUP BY 1),
s AS (SELECT class, x / sum(x) OVER () AS baseline_share, y / sum(y) OVER () AS recent_share FROM c)
SELECT class, {rnd("baseline_share")} AS baseline_share, {rnd("recent_share")} AS recent_share,
  {rnd("recent_share - baseline_share")} AS share_diff FROM s""",
)
def class_share_drift(spark, folder):
    rows, cut = scored(spark, folder), F.lit(CUT).cast("timestamp_ntz")
    return tidy(drift.class_share_drift(rows.filter(F.col("l_shipdate") < cut), rows.filter(F.col("l_shipdate") >= cut)))
