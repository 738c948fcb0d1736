"""Preparation, validation, splitting and scaling."""

from pyspark.sql import functions as F

from tidemark.operators import prep
from tidemark.operators.evaluate import evaluate_predictions, long_metrics
from tidemark.operators.scaling import apply_scaler, fit_scaler
from tidemark.operators.scoring import join_labels
from tidemark.operators.split import part, stratified_split
from tidemark.plans.catalogue.base import CLASS_NAMES, FEATURES, query, rnd, scored, scored_ctes, tidy
from tidemark.sources.tables import load_parquet


@query("normalized_names", "SELECT p_partkey AS part_key, p_size AS size_cm, p_retailprice AS retail_price_usd FROM part")
def normalized_names(spark, folder):
    awkward = load_parquet(spark, folder, "part").select(
        F.col("p_partkey").alias("part key"),
        F.col("p_size").alias("size (cm)"),
        F.col("p_retailprice").alias("retail price (usd)"),
    )
    return prep.normalize_names(awkward)


@query("feature_projection", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def feature_projection(spark, folder):
    features, _ = prep.split_features_label(load_parquet(spark, folder, "orders"), "o_orderstatus")
    return prep.select_features(features, prep.numeric_columns(features))


@query(
    "class_name_map",
    """WITH ids AS (SELECT CAST(dense_rank() OVER (ORDER BY event_type) - 1 AS INTEGER) AS class_id FROM events)
SELECT class_id, CASE class_id WHEN 0 THEN 'Setosa' WHEN 1 THEN 'Versicolor' WHEN 2 THEN 'Virginica'
  ELSE 'Classe ' || class_id END AS class_name, count(*) AS n FROM ids GROUP BY class_id""",
)
def class_name_map(spark, folder):
    ids = prep.dense_class_ids(load_parquet(spark, folder, "events"), "event_type")
    named = prep.map_labels(ids, "class_id", CLASS_NAMES)
    return named.groupBy("class_id", "class_name").agg(F.count("*").alias("n"))


@query(
    "ratio_area_features",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  l_extendedprice / l_quantity AS price_ratio, l_extendedprice * l_quantity AS price_area,
  CASE WHEN l_discount = 0 THEN NULL ELSE l_tax / l_discount END AS levy_ratio, l_tax * l_discount AS levy_area FROM lineitem""",
)
def ratio_area_features(spark, folder):
    pairs = {"price": ("l_extendedprice", "l_quantity"), "levy": ("l_tax", "l_discount")}
    rows = prep.ratio_area(load_parquet(spark, folder, "lineitem"), pairs)
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return rows.select(*keys, "price_ratio", "price_area", "levy_ratio", "levy_area")


@query(
    "date_range_rows",
    """SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE o_orderdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1996-12-31'""",
)
def date_range_rows(spark, folder):
    rows = prep.date_range(load_parquet(spark, folder, "orders"), "o_orderdate", "1996-01-01", "1996-12-31")
    return rows.select("o_orderkey", "o_custkey", "o_totalprice")


def _rules(df):
    return {
        **prep.null_rules(["l_quantity", "l_tax"]),
        **prep.range_rules({"l_quantity": (0, 45), "l_discount": (None, 0.07), "l_extendedprice": (2000, None)}),
        **prep.type_rules(df, {"l_returnflag": "int"}),
    }


@query(
    "dq_violations",
    """WITH t AS (SELECT count(*) AS total_rows, count(*) FILTER (l_quantity IS NULL) AS a, count(*) FILTER (l_tax IS NULL) AS b,
  count(*) FILTER (l_quantity < 0 OR l_quantity > 45) AS c, count(*) FILTER (l_discount > 0.07e0) AS d,
  count(*) FILTER (l_extendedprice < 2000) AS e, count(*) FILTER (try_cast(l_returnflag AS INTEGER) IS NULL) AS f FROM lineitem)
SELECT 'l_quantity_null' AS rule, 'l_quantity' AS "column", a AS violations, total_rows FROM t
UNION ALL SELECT 'l_tax_null', 'l_tax', b, total_rows FROM t
UNION ALL SELECT 'l_quantity_range', 'l_quantity', c, total_rows FROM t
UNION ALL SELECT 'l_discount_range', 'l_discount', d, total_rows FROM t
UNION ALL SELECT 'l_extendedprice_range', 'l_extendedprice', e, total_rows FROM t
UNION ALL SELECT 'l_returnflag_type', 'l_returnflag', f, total_rows FROM t""",
)
def dq_violations(spark, folder):
    rows = load_parquet(spark, folder, "lineitem")
    return prep.dq_report(rows, _rules(rows))


@query(
    "dq_rejected_rows",
    """SELECT broken_rules, count(*) AS n, sum(l_quantity) AS quantity FROM (
  SELECT concat_ws(',', CASE WHEN l_quantity < 0 OR l_quantity > 45 THEN 'l_quantity_range' END,
    CASE WHEN l_discount > 0.07e0 THEN 'l_discount_range' END,
    CASE WHEN l_extendedprice < 2000 THEN 'l_extendedprice_range' END) AS broken_rules, l_quantity FROM lineitem)
WHERE broken_rules <> '' GROUP BY broken_rules""",
)
def dq_rejected_rows(spark, folder):
    rows = load_parquet(spark, folder, "lineitem")
    rules = {k: v for k, v in _rules(rows).items() if not k.endswith("_type")}
    _, rejected = prep.dq_split(rows, rules)
    return rejected.groupBy(F.array_join("broken_rules", ",").alias("broken_rules")).agg(
        F.count("*").alias("n"), F.sum("l_quantity").alias("quantity")
    )


@query(
    "features_labels_join",
    "SELECT doc_id, n_chars, quality, toxic FROM documents JOIN labels USING (doc_id)",
)
def features_labels_join(spark, folder):
    documents = load_parquet(spark, folder, "documents").select("doc_id", "n_chars")
    joined, _ = join_labels(documents, load_parquet(spark, folder, "labels"), ["doc_id"])
    return joined


@query(
    "features_labels_unmatched",
    """SELECT doc_id, 'features' AS side FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
UNION ALL SELECT doc_id, 'labels' FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents)""",
)
def features_labels_unmatched(spark, folder):
    documents = load_parquet(spark, folder, "documents").select("doc_id", "n_chars")
    _, lost = join_labels(documents, load_parquet(spark, folder, "labels"), ["doc_id"])
    return lost


def split_ctes(label: str, table: str, key: str, fractions: dict[str, float], seed: int = 42) -> str:
    """CTEs ending in ``parts(key, class, split)``: largest-remainder quotas, ranks by seeded hash."""
    names = list(fractions)
    sizes = ", ".join(f"CAST(ceil(round({f!r}e0 * sum(n) OVER (), 6)) AS BIGINT) AS size{i}" for i, f in enumerate(fractions.values()))
    shares = ", ".join(f"(size{i} * n) // total AS base{i}, (size{i} * n) % total AS rest{i}" for i in range(len(names)))
    quotas = ", ".join(
        f"base{i} + CASE WHEN row_number() OVER (ORDER BY rest{i} DESC, class) <= size{i} - sum(base{i}) OVER () THEN 1 ELSE 0 END AS quota{i}"
        for i in range(len(names))
    )
    cases = " ".join(
        f"WHEN r <= {' + '.join(f'quota{j}' for j in range(i + 1))} THEN '{name}'" for i, name in enumerate(names)
    )
    return f"""counted AS (SELECT {label} AS class, count(*) AS n FROM {table} GROUP BY 1),
sized AS (SELECT class, n, CAST(sum(n) OVER () AS BIGINT) AS total, {sizes} FROM counted),
shared AS (SELECT *, {shares} FROM sized),
quotas AS (SELECT class, {quotas} FROM shared),
ranked AS (SELECT {key}, {label} AS class,
  row_number() OVER (PARTITION BY {label} ORDER BY md5('{seed}|' || {key}), CAST({key} AS VARCHAR)) AS r FROM {table}),
parts AS (SELECT {key}, ranked.class, CASE {cases} ELSE 'train' END AS split FROM ranked JOIN quotas
  ON ranked.class IS NOT DISTINCT FROM quotas.class)"""


def _split(name, label, fractions):
    ctes = split_ctes(label or "0", "orders", "o_orderkey", fractions)

    @query(name, f"WITH {ctes} SELECT o_orderkey, split FROM parts")
    def run(spark, folder):
        orders = load_parquet(spark, folder, "orders")
        return stratified_split(orders, label, ["o_orderkey"], fractions).select("o_orderkey", "split")


_split("split_exact", "o_orderstatus", {"test": 0.2})
_split("split_exact_refined", "o_orderstatus", {"test": 0.2})
_split("split_three_way", "o_orderpriority", {"test": 0.2, "validation": 0.2})
_split("split_three_way_refined", "o_orderpriority", {"test": 0.2, "validation": 0.2})
_split("split_unstratified", None, {"test": 0.3})


@query(
    "scale_fit",
    " UNION ALL ".join(
        f"SELECT '{f}' AS feature, {rnd(f'avg({f})', 4)} AS mean, "
        f"{rnd(f'CASE WHEN stddev_pop({f}) = 0 THEN 1.0e0 ELSE stddev_pop({f}) END', 4)} AS scale FROM lineitem"
        for f in FEATURES
    ),
)
def scale_fit(spark, folder):
    return tidy(fit_scaler(load_parquet(spark, folder, "lineitem"), FEATURES), 4)


@query(
    "scale_apply",
    f"""WITH p AS (SELECT {", ".join(f"avg({f}) AS m{i}, stddev_pop({f}) AS s{i}" for i, f in enumerate(FEATURES))} FROM lineitem)
SELECT l_orderkey, l_partkey, {", ".join(f"{rnd(f'({f} - m{i}) / s{i}')} AS {f}" for i, f in enumerate(FEATURES))}
FROM lineitem CROSS JOIN p""",
)
def scale_apply(spark, folder):
    rows = load_parquet(spark, folder, "lineitem")
    scaled = apply_scaler(rows, fit_scaler(rows, FEATURES), FEATURES)
    return tidy(scaled.select("l_orderkey", "l_partkey", *FEATURES))


@query(
    "prepare_train_test",
    f"""WITH {split_ctes("o_orderstatus", "orders", "o_orderkey", {"test": 0.2})},
rows_ AS (SELECT o_orderkey, o_totalprice, split FROM orders JOIN parts USING (o_orderkey)),
p AS (SELECT avg(o_totalprice) AS m, stddev_pop(o_totalprice) AS s FROM rows_ WHERE split = 'train')
SELECT o_orderkey, split, {rnd("(o_totalprice - m) / s")} AS o_totalprice FROM rows_ CROSS JOIN p""",
)
def prepare_train_test(spark, folder):
    parts = stratified_split(load_parquet(spark, folder, "orders"), "o_orderstatus", ["o_orderkey"])
    params = fit_scaler(part(parts, "train"), ["o_totalprice"])
    return tidy(apply_scaler(parts, params, ["o_totalprice"]).select("o_orderkey", "split", "o_totalprice"))


@query(
    "metric_gate",
    f"""WITH {scored_ctes()}
SELECT 'accuracy' AS metric, {rnd("avg(CASE WHEN target = predicted_class THEN 1.0e0 ELSE 0.0e0 END)")} AS value,
  0.9e0 AS required, avg(CASE WHEN target = predicted_class THEN 1.0e0 ELSE 0.0e0 END) >= 0.9e0 AS passed FROM scored""",
)
def metric_gate(spark, folder):
    metrics = long_metrics(evaluate_predictions(scored(spark, folder), "target", "predicted_class"))
    return tidy(prep.metric_gate(metrics, {"accuracy": 0.9}))
