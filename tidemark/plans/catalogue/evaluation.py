"""Classification metrics and model comparison."""

from pyspark.sql import functions as F

from tidemark.functions.columns import rounded
from tidemark.operators import evaluate
from tidemark.operators.drift import performance_by_window
from tidemark.operators.scaling import fit_scaler
from tidemark.operators.scoring import score_pair
from tidemark.operators.split import stratified_split
from tidemark.plans.catalogue.base import (
    CLASS_IDS,
    CLASS_NAMES,
    FEATURES,
    MODEL,
    RIVAL,
    labelled,
    month,
    query,
    rnd,
    scored,
    scored_ctes,
    tidy,
)
from tidemark.plans.catalogue.prep import split_ctes
from tidemark.plans.catalogue.scoring import PAIR_CTES
from tidemark.sources.tables import load_parquet


def class_ctes(by: str = "", source: str = "counts") -> str:
    """CTEs ending in ``classes``: hits, support and predicted count per label from (by, y, p, n)."""
    keys = f"{by}, " if by else ""
    group = f"{by}, label" if by else "label"
    return f"""sides AS (SELECT {keys}y AS label, n AS support, 0 AS predicted, CASE WHEN y = p THEN n ELSE 0 END AS hits FROM {source}
  UNION ALL SELECT {keys}p, 0, n, 0 FROM {source}),
sums AS (SELECT {group}, sum(support)::DOUBLE AS support, sum(predicted)::DOUBLE AS predicted, sum(hits)::DOUBLE AS hits FROM sides GROUP BY {group}),
classes AS (SELECT *, coalesce(hits / nullif(predicted, 0), 0) AS precision_, coalesce(hits / nullif(support, 0), 0) AS recall_,
  coalesce(2 * hits / nullif(support + predicted, 0), 0) AS f1_ FROM sums)"""


WEIGHTED = f"""{rnd("sum(hits) / sum(support)")} AS accuracy, {rnd("sum(precision_ * support) / sum(support)")} AS precision,
  {rnd("sum(recall_ * support) / sum(support)")} AS recall, {rnd("sum(f1_ * support) / sum(support)")} AS f1_score,
  sum(support)::BIGINT AS total"""
COUNTS = f"{scored_ctes()}, counts AS (SELECT target AS y, predicted_class AS p, count(*) AS n FROM scored GROUP BY 1, 2)"


def _counts(spark, folder):
    return evaluate.confusion_counts(scored(spark, folder), "target", "predicted_class")


@query(
    "confusion_matrix",
    f"""WITH {COUNTS}, labels AS (SELECT y AS c FROM counts UNION SELECT p FROM counts)
SELECT a.c AS label, b.c AS prediction, coalesce(n, 0)::BIGINT AS n
FROM labels a CROSS JOIN labels b LEFT JOIN counts ON y = a.c AND p = b.c""",
)
def confusion_matrix(spark, folder):
    return evaluate.confusion_matrix(_counts(spark, folder))


@query("weighted_metrics", f"WITH {COUNTS}, {class_ctes()} SELECT {WEIGHTED} FROM classes")
def weighted_metrics(spark, folder):
    return tidy(evaluate.weighted_metrics(_counts(spark, folder)))


# documents judged by length and by language: labels that never occur on one side
DOC_COUNTS = """docs AS (SELECT quality AS y, CASE WHEN n_chars > 4000 THEN 2 WHEN n_chars > 800 THEN 1 ELSE 0 END AS p
  FROM documents JOIN labels USING (doc_id)), counts AS (SELECT y, p, count(*) AS n FROM docs GROUP BY 1, 2)"""


def _documents(spark, folder):
    documents = load_parquet(spark, folder, "documents").select("doc_id", "n_chars")
    guess = F.when(F.col("n_chars") > 4000, 2).when(F.col("n_chars") > 800, 1).otherwise(0)
    return documents.join(load_parquet(spark, folder, "labels"), "doc_id").withColumn("guess", guess)


def _report(ctes: str, entry: str) -> str:
    lines = [f"SELECT {entry} AS entry, precision_ AS a, recall_ AS b, f1_ AS c, support AS s FROM classes"]
    accuracy = "sum(hits) / sum(support)"
    lines.append(f"SELECT 'accuracy', {accuracy}, {accuracy}, {accuracy}, sum(support) FROM classes")
    lines.append("SELECT 'macro avg', avg(precision_), avg(recall_), avg(f1_), sum(support) FROM classes")
    weighted = ", ".join(f"sum({m} * support) / sum(support)" for m in ("precision_", "recall_", "f1_"))
    lines.append(f"SELECT 'weighted avg', {weighted}, sum(support) FROM classes")
    return f"WITH {ctes}, {class_ctes()}, report AS ({' UNION ALL '.join(lines)})"


@query(
    "classification_report",
    f"""{_report(DOC_COUNTS, "CAST(label AS VARCHAR)")} SELECT entry, {rnd("a")} AS precision, {rnd("b")} AS recall,
  {rnd("c")} AS f1_score, s::BIGINT AS support FROM report""",
)
def classification_report(spark, folder):
    counts = evaluate.confusion_counts(_documents(spark, folder), "quality", "guess")
    return tidy(evaluate.classification_report(counts))


@query(
    "flat_report_metrics",
    f"""{_report(COUNTS, "CASE label WHEN 0 THEN 'Setosa' WHEN 1 THEN 'Versicolor' WHEN 2 THEN 'Virginica' END")}
SELECT entry || '_precision' AS metric, {rnd("a")} AS value FROM report WHERE entry <> 'accuracy'
UNION ALL SELECT entry || '_recall', {rnd("b")} FROM report WHERE entry <> 'accuracy'
UNION ALL SELECT entry || '_f1-score', {rnd("c")} FROM report WHERE entry <> 'accuracy'
UNION ALL SELECT entry || '_support', {rnd("s")} FROM report WHERE entry <> 'accuracy'""",
)
def flat_report_metrics(spark, folder):
    report = evaluate.classification_report(_counts(spark, folder), CLASS_NAMES)
    return tidy(evaluate.flatten_report(report))


@query(
    "accuracy_by_split",
    f"""WITH {split_ctes("o_orderstatus", "orders", "o_orderkey", {"test": 0.2})},
judged AS (SELECT split, CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END AS y, CAST(o_custkey % 3 AS INTEGER) AS p
  FROM orders JOIN parts USING (o_orderkey)),
counts AS (SELECT split, y, p, count(*) AS n FROM judged GROUP BY 1, 2, 3), {class_ctes("split")}
SELECT split, {WEIGHTED} FROM classes GROUP BY split""",
)
def accuracy_by_split(spark, folder):
    parts = stratified_split(load_parquet(spark, folder, "orders"), "o_orderstatus", ["o_orderkey"])
    status = F.col("o_orderstatus")
    judged = parts.withColumns(
        {"y": F.when(status == "F", 0).when(status == "O", 1).otherwise(2), "p": (F.col("o_custkey") % 3).cast("int")}
    )
    return tidy(evaluate.evaluate_predictions(judged, "y", "p", ["split"]))


@query(
    "log_loss",
    f"""WITH {scored_ctes()} SELECT strftime(l_shipdate, '%Y') AS year, {rnd('''avg(-ln(greatest(
  CASE target WHEN 0 THEN probability_class_0 WHEN 1 THEN probability_class_1 ELSE probability_class_2 END, 1e-15)))''')} AS log_loss
FROM scored GROUP BY 1""",
)
def log_loss(spark, folder):
    rows = scored(spark, folder).withColumn("year", F.date_format("l_shipdate", "yyyy"))
    return tidy(evaluate.log_loss(rows, "target", CLASS_IDS, ["year"]))


# the score is rounded on both sides: ties must be the same ties in both engines
ROC_SQL = f"""WITH {scored_ctes()}, long AS ({" UNION ALL ".join(
    f"SELECT {c} AS class, {rnd(f'probability_class_{c}')} AS v, CAST(target = {c} AS INTEGER) AS y FROM scored" for c in CLASS_IDS)}),
vals AS (SELECT class, v, sum(y) AS pos, sum(1 - y) AS neg FROM long GROUP BY 1, 2),
run AS (SELECT class, pos, neg, sum(neg) OVER (PARTITION BY class ORDER BY v) - neg AS below FROM vals)
SELECT class, {rnd("sum(pos * (below + neg / 2.0e0)) / (sum(pos)::DOUBLE * sum(neg)::DOUBLE)")} AS auc, sum(pos)::BIGINT AS support
FROM run GROUP BY class"""


def _rounded_scores(spark, folder):
    rows = scored(spark, folder)
    return rows.withColumns({f"probability_class_{c}": rounded(f"probability_class_{c}") for c in CLASS_IDS})


@query("roc_auc", ROC_SQL)
def roc_auc(spark, folder):
    return tidy(evaluate.roc_auc(_rounded_scores(spark, folder), "target", CLASS_IDS))


@query("roc_auc_cells", ROC_SQL)
def roc_auc_cells(spark, folder):
    return tidy(evaluate.roc_auc(_rounded_scores(spark, folder), "target", CLASS_IDS))


@query(
    "ab_compare",
    f"""WITH {PAIR_CTES}, counts AS (
  SELECT 'production' AS alias, target AS y, production_class AS p, count(*) AS n FROM pair GROUP BY ALL
  UNION ALL SELECT 'challenger', target, challenger_class, count(*) FROM pair GROUP BY ALL), {class_ctes("alias")},
m AS (SELECT alias, sum(hits) / sum(support) AS a, sum(precision_ * support) / sum(support) AS b,
  sum(recall_ * support) / sum(support) AS c, sum(f1_ * support) / sum(support) AS d FROM classes GROUP BY alias)
SELECT {", ".join(f"{rnd(f'p.{x}')} AS production_{n}, {rnd(f'c.{x}')} AS challenger_{n}"
    for x, n in zip("abcd", evaluate.METRICS))},
  CASE WHEN c.a > p.a THEN 'challenger' ELSE 'production' END AS winner, {rnd("c.a - p.a")} AS improvement
FROM m p JOIN m c ON p.alias = 'production' AND c.alias = 'challenger'""",
)
def ab_compare(spark, folder):
    rows = labelled(spark, folder)
    pair = score_pair(rows, MODEL, RIVAL, fit_scaler(rows, FEATURES))
    return tidy(evaluate.compare_predictions(pair, "target", "production_class", "challenger_class"))


@query(
    "accuracy_by_window",
    f"""WITH judged AS (SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, CAST(user_id % 3 AS INTEGER) AS y, CAST(event_id % 3 AS INTEGER) AS p FROM events),
counts AS (SELECT day, y, p, count(*) AS n FROM judged GROUP BY ALL), {class_ctes("day")}
SELECT day, {WEIGHTED}, {rnd("sum(hits) / sum(support) - 0.34e0")} AS accuracy_change,
  sum(hits) / sum(support) - 0.34e0 < 0 AS degraded FROM classes GROUP BY day""",
)
def accuracy_by_window(spark, folder):
    events = load_parquet(spark, folder, "events").withColumns(
        {"y": (F.col("user_id") % 3).cast("int"), "p": (F.col("event_id") % 3).cast("int")}
    )
    rows = performance_by_window(events, "ts", "y", "p", baseline_accuracy=0.34)
    return tidy(rows.withColumn("day", F.to_date("window_start").cast("string")).drop("window_start"))


@query(
    "metrics_by_month",
    f"""WITH {scored_ctes()}, counts AS (SELECT strftime(l_shipdate, '%Y-%m') AS month, target AS y, predicted_class AS p, count(*) AS n
  FROM scored GROUP BY ALL), {class_ctes("month")} SELECT month, {WEIGHTED} FROM classes GROUP BY month""",
)
def metrics_by_month(spark, folder):
    rows = scored(spark, folder).withColumn("month", month("l_shipdate"))
    return tidy(evaluate.evaluate_predictions(rows, "target", "predicted_class", ["month"]))
