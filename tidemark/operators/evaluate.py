"""Classification metrics. One shuffle over the rows, everything else on class-by-class counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import column, ratio, ratio_or_zero
from tidemark.operators.ordering import (
    cell_grid,
    match_keys,
    running_before,
    to_cells,
)
from tidemark.sources.workspace import Summary

METRICS = ("accuracy", "precision", "recall", "f1_score")


def confusion_counts(df: DataFrame, label: Column | str, prediction: Column | str, by: Sequence[str] = ()) -> DataFrame:
    """Rows ``(*by, label, prediction, n)``; pre-aggregated before the shuffle."""
    return df.groupBy(*by, column(label).alias("label"), column(prediction).alias("prediction")).agg(
        F.count("*").alias("n")
    )


def class_metrics(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows ``(*by, label, precision, recall, f1_score, support)`` over the union of labels; 0/0 is 0.

    Rows without a label are not judged: their predictions count nowhere.
    """
    counts = counts.filter(F.col("label").isNotNull())
    sides = F.array(
        F.struct(
            F.col("label").alias("label"),
            F.col("n").alias("support"),
            F.lit(0).cast("bigint").alias("predicted"),
            F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0).alias("hits"),
        ),
        F.struct(
            F.col("prediction").alias("label"),
            F.lit(0).cast("bigint").alias("support"),
            F.col("n").alias("predicted"),
            F.lit(0).cast("bigint").alias("hits"),
        ),
    )
    return (
        counts.select(*by, F.inline(sides))
        .filter(F.col("label").isNotNull())
        .groupBy(*by, "label")
        .agg(F.sum("support").alias("support"), F.sum("predicted").alias("predicted"), F.sum("hits").alias("hits"))
        .select(
            *by,
            "label",
            ratio_or_zero("hits", "predicted").alias("precision"),
            ratio_or_zero("hits", "support").alias("recall"),
            ratio_or_zero(2 * F.col("hits"), F.col("support") + F.col("predicted")).alias("f1_score"),
            "support",
            "hits",
        )
    )


def _weighted(name: str) -> Column:
    return ratio_or_zero(F.sum(F.col(name) * F.col("support")), F.sum("support"))


def weighted_metrics(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows ``(*by, accuracy, precision, recall, f1_score, total)``; averages weighted by true support."""
    return (
        class_metrics(counts, by)
        .groupBy(*by)
        .agg(
            ratio(F.sum("hits"), F.sum("support")).alias("accuracy"),
            *[_weighted(m).alias(m) for m in METRICS[1:]],
            F.sum("support").alias("total"),
        )
    )


def confusion_matrix(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows ``(*by, label, prediction, n)`` for every pair of known labels, zeros included."""
    by = list(by)
    known = counts.groupBy(*by).agg(
        F.sort_array(F.array_union(F.collect_set("label"), F.collect_set("prediction"))).alias("_all")
    )
    grid = known.select(*by, "_all", F.explode("_all").alias("label")).select(
        *by, "label", F.explode("_all").alias("prediction")
    )
    keys = [*by, "label", "prediction"]
    filled = counts.select(*[F.col(k).alias(f"_{k}") for k in keys], "n")
    return grid.join(filled, match_keys(keys), "left").select(*keys, F.coalesce("n", F.lit(0).cast("bigint")).alias("n"))


def confusion_array(counts: DataFrame) -> DataFrame:
    """One row with ``labels`` and the nested count ``matrix`` (rows = true, columns = predicted)."""
    lines = (
        confusion_matrix(counts)
        .groupBy("label")
        .agg(F.sort_array(F.collect_list(F.struct("prediction", "n"))).alias("line"))
        .select(F.struct("label", F.transform("line", lambda x: x["n"]).alias("cells")).alias("row"))
    )
    return lines.agg(F.sort_array(F.collect_list("row")).alias("rows")).select(
        F.transform("rows", lambda x: x["label"]).alias("labels"), F.transform("rows", lambda x: x["cells"]).alias("matrix")
    )


def classification_report(counts: DataFrame, names: Mapping[int, str] | None = None) -> DataFrame:
    """Rows ``(entry, precision, recall, f1_score, support)``: the classes, then accuracy, macro and
    weighted averages. The accuracy row repeats the accuracy in all three metric columns."""
    classes = class_metrics(counts)
    entry = F.col("label").cast("string")
    if names:
        pairs = F.create_map(*[F.lit(x) for k, v in names.items() for x in (str(k), v)])
        entry = F.coalesce(F.try_element_at(pairs, entry), entry)
    support = F.sum("support").alias("support")
    accuracy = ratio(F.sum("hits"), F.sum("support"))
    return (
        classes.select(entry.alias("entry"), *METRICS[1:], "support")
        .unionByName(classes.agg(*[accuracy.alias(m) for m in METRICS[1:]], support).withColumn("entry", F.lit("accuracy")))
        .unionByName(classes.agg(*[F.avg(m).alias(m) for m in METRICS[1:]], support).withColumn("entry", F.lit("macro avg")))
        .unionByName(
            classes.agg(*[_weighted(m).alias(m) for m in METRICS[1:]], support).withColumn("entry", F.lit("weighted avg"))
        )
    )


def flatten_report(report: DataFrame) -> DataFrame:
    """Long rows ``("{entry}_{metric}", value)`` of the per-class and average lines."""
    columns = {"precision": "precision", "recall": "recall", "f1-score": "f1_score", "support": "support"}
    rows = F.array(
        *[
            F.struct(F.concat("entry", F.lit(f"_{name}")).alias("metric"), F.col(c).cast("double").alias("value"))
            for name, c in columns.items()
        ]
    )
    return report.filter(F.col("entry") != "accuracy").select(F.inline(rows))


def log_loss(df: DataFrame, label: str, class_ids: Sequence[int], by: Sequence[str] = (), floor: float = 1e-15) -> DataFrame:
    """Mean negative log probability of the true class, ``(*by, log_loss)``.

    Rows without a label are left out. A label outside ``class_ids``, or a missing probability of a labelled row,
    is an error when the rows are read: neither has a loss.
    """
    p_true = None
    for c in class_ids:
        value = F.col(f"probability_class_{c}")
        p_true = F.when(F.col(label) == c, value) if p_true is None else p_true.when(F.col(label) == c, value)
    unknown = F.raise_error(F.concat(F.lit("no probability for label "), F.col(label).cast("string"))).cast("double")
    p_true = F.when(F.col(label).isNull(), F.lit(None)).when(p_true.isNull() | F.isnan(p_true), unknown).otherwise(p_true)
    loss = F.when(p_true.isNotNull(), -F.log(F.greatest(p_true, F.lit(floor))))
    return df.groupBy(*by).agg(F.avg(loss).alias("log_loss"))


def roc_auc(df: DataFrame, label: str, class_ids: Sequence[int]) -> DataFrame:
    """One-vs-rest area under the ROC curve, rows ``(class, auc, support)``; ties count half.

    A tally of positives and negatives per ordered cell ranks whole cells. Only cells that hold both
    are looked into score by score; in the others every positive has the cell's own rank.
    """
    scores = [f"probability_class_{c}" for c in class_ids]
    own_class = F.get(F.array(*[F.lit(c) for c in class_ids]), F.col("feature"))
    rows = df.select(label, *scores).filter(F.col(label).isNotNull())
    positive = F.when(F.col(label) == own_class, 1).otherwise(0)
    counts = F.sum(positive).alias("pos"), F.sum(1 - positive).alias("neg")
    long = to_cells(rows, cell_grid(rows, scores), [label])
    tally = Summary(long.groupBy("feature", "cell").agg(*counts))
    placed = tally.rows.withColumn("base", running_before("neg", ["feature"], "cell"))
    mixed = (F.col("pos") > 0) & (F.col("neg") > 0)
    pure = placed.filter(~mixed).select("feature", "pos", "neg", (F.col("pos") * F.col("base").cast("double")).alias("wins"))
    open_cells = tally.joinable(
        placed.filter(mixed).select(F.col("feature").alias("_feature"), F.col("cell").alias("_cell"), "base")
    )
    values = long.join(open_cells, match_keys(["feature", "cell"])).groupBy("feature", "cell", "value", "base").agg(*counts)
    below = F.col("base") + running_before("neg", ["feature", "cell"], "value") + F.col("neg") / 2.0
    inside = values.select("feature", "pos", "neg", (F.col("pos") * below).alias("wins"))
    sums = (
        pure.unionByName(inside)
        .groupBy("feature")
        .agg(F.sum("wins").alias("wins"), F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    )
    return sums.select(
        own_class.alias("class"),
        ratio("wins", F.col("pos").cast("double") * F.col("neg")).alias("auc"),
        F.col("pos").alias("support"),
    )


def weighted_auc(per_class: DataFrame) -> DataFrame:
    """One row: the one-vs-rest areas weighted by support."""
    return per_class.agg(ratio(F.sum(F.col("auc") * F.col("support")), F.sum("support")).alias("roc_auc"))


def evaluate_predictions(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """Weighted metrics straight from labelled predictions."""
    return weighted_metrics(confusion_counts(df, label, prediction, by), by)


def long_metrics(metrics: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Metric columns as rows ``(*by, metric, value)``."""
    return metrics.unpivot(list(by), list(METRICS), "metric", "value")


def compare_predictions(df: DataFrame, label: str, production: str, challenger: str) -> DataFrame:
    """Two prediction columns over the same rows, compared in one pass.

    One row ``(production_*, challenger_*, winner, improvement)``. The challenger wins only with a
    strictly greater accuracy.
    """
    joint = df.groupBy(
        F.col(label).alias("label"), F.col(production).alias("p"), F.col(challenger).alias("c")
    ).agg(F.count("*").alias("n"))
    sides = F.array(
        F.struct(F.lit("production").alias("alias"), F.col("p").alias("prediction")),
        F.struct(F.lit("challenger").alias("alias"), F.col("c").alias("prediction")),
    )
    counts = (
        joint.select("label", "n", F.inline(sides))
        .groupBy("alias", "label", "prediction")
        .agg(F.sum("n").alias("n"))
    )
    metrics = weighted_metrics(counts, ["alias"])
    wide = metrics.agg(
        *[
            F.max(F.when(F.col("alias") == a, F.col(m))).alias(f"{a}_{m}")
            for a in ("production", "challenger")
            for m in METRICS
        ]
    )
    better = F.col("challenger_accuracy") > F.col("production_accuracy")
    return wide.withColumn("winner", F.when(better, F.lit("challenger")).otherwise(F.lit("production"))).withColumn(
        "improvement", F.col("challenger_accuracy") - F.col("production_accuracy")
    )
