"""Distributed training; every model leaves as a table of coefficients or a saved pipeline."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import forests
from tidemark.operators.prep import check_schema
from tidemark.operators.scoring import LinearModel
from tidemark.sources.workspace import fresh_folder


#: Classes of a model at most: each has a row of weights on the driver.
MAX_CLASSES = 10_000
#: Bytes of a tree's nodes at most that are sent to every task, and of the trees that are sent together.
FOREST_BYTES = 1 << 28
TOGETHER_BYTES = 1 << 25
FOREST = "model_name string, version int, tree int, node int, feature int, threshold double, left int, right int, share array<double>, classes array<int>, width int"


def _vectors(df: DataFrame, features: Sequence[str]) -> DataFrame:
    if len(features) == 1 and isinstance(df.schema[features[0]].dataType, T.ArrayType):
        return df.withColumn("_features", array_to_vector(F.col(features[0]).cast("array<double>")))
    wide = df.withColumns({f"_d{i}": F.col(f).cast("double") for i, f in enumerate(features)})
    assembler = VectorAssembler(inputCols=[f"_d{i}" for i in range(len(features))], outputCol="_features")
    return assembler.transform(wide)


def train_logreg(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    max_iter: int = 200,
    C: float = 1.0,
    solver: str = "lbfgs",
    tol: float = 1e-6,
    name: str = "model",
    version: int = 1,
    depth: int = 2,
) -> LinearModel:
    """L2-regularised logistic regression over the rows of ``df``.

    The objective is 1/2*|w|^2 + C * sum of losses with a free intercept, which Spark states as the
    mean loss plus 1/(C*n) times the penalty. Labels may be any whole numbers; the model keeps them. Rows without a label
    take no part.
    """
    if solver != "lbfgs":
        raise ValueError(f"solver '{solver}' is not available; use 'lbfgs'")
    check_schema(df, [*features, label])
    df = df.filter(F.col(label).isNotNull())
    # one row per class; more classes than these are no class labels
    counts = df.groupBy(label).agg(F.count("*").alias("n")).orderBy(label).limit(MAX_CLASSES + 1).collect()
    if len(counts) > MAX_CLASSES:
        raise ValueError(f"'{label}' has more than {MAX_CLASSES} distinct values: no class label")
    if odd := [r[label] for r in counts if isinstance(r[label], float) and not r[label].is_integer() or isinstance(r[label], str)]:
        raise ValueError(f"labels must be whole numbers: {odd[:5]}")
    classes, total = [int(r[label]) for r in counts], sum(r["n"] for r in counts)
    if len(classes) < 2:
        raise ValueError("training needs at least two classes")
    index = F.array_position(F.array(*[F.lit(c) for c in classes]), F.col(label).cast("int")) - 1
    rows = _vectors(df, features).select("_features", index.cast("double").alias("_label"))
    fitted = LogisticRegression(
        featuresCol="_features",
        labelCol="_label",
        family="binomial" if len(classes) == 2 else "multinomial",
        maxIter=max_iter,
        regParam=1.0 / (C * total),
        elasticNetParam=0.0,
        standardization=False,
        tol=tol,
        aggregationDepth=depth,
    ).fit(rows)
    weights = fitted.coefficientMatrix.toArray().tolist()
    intercepts = fitted.interceptVector.toArray().tolist()
    if len(classes) == 2:
        # a two-class softmax over (0, z) is the logistic function of z
        weights, intercepts = [[0.0] * len(weights[0]), weights[0]], [0.0, intercepts[0]]
    return LinearModel(
        name, version, tuple(features), tuple(classes), tuple(intercepts), tuple(tuple(w) for w in weights)
    )


def train_forest(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    trees: int = 100,
    max_depth: int | None = None,
    min_leaf: int = 1,
    seed: int = 42,
) -> forests.Forest:
    """Random forest; an unlimited depth becomes 30. Its nodes are a stored table, see ``forests``."""
    check_schema(df, [*features, label])
    depth = 30 if max_depth is None else max_depth
    return forests.grow(df, _array(df, features), label, trees, depth, min_leaf, seed)


def _array(df: DataFrame, features: Sequence[str]) -> Column:
    if len(features) == 1 and isinstance(df.schema[features[0]].dataType, T.ArrayType):
        return F.col(features[0]).cast("array<double>")
    return F.array(*[F.col(f).cast("double") for f in features])


def forest_predictions(model: forests.Forest, df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Adds ``predicted_class`` and ``prediction_probability``. Rows are stored with a number, by which votes come back."""
    folder = fresh_folder(df.sparkSession, "rows")
    marked = df.withColumn("_row", F.monotonically_increasing_id())
    marked.write.parquet(folder)
    rows = df.sparkSession.read.schema(marked.schema).parquet(folder)
    scored = rows.join(forests.votes(model, rows, _array(df, features), "_row"), "_row")
    best = F.array_max("p")
    kept = scored.withColumns({"predicted_class": (F.array_position("p", best) - 1).cast("int"), "prediction_probability": best})
    return kept.select(*df.columns, "predicted_class", "prediction_probability")


def forest_table(model: forests.Forest, spark: SparkSession, classes: Sequence[int], name: str = "forest", version: int = 1) -> DataFrame:
    """The nodes of a forest as rows (``FOREST``), to be kept by name and version like coefficients.

    A leaf has feature -1 and no children; ``share`` holds the class shares of the training rows that came to the node,
    in the order of ``classes``. The rows come from the subtrees' table, never gathered on the driver.
    """
    return forests.numbered(model, spark).select(
        F.lit(name).alias("model_name"),
        F.lit(version).alias("version"),
        "tree",
        "node",
        "feature",
        "threshold",
        "left",
        "right",
        "share",
        F.array(*[F.lit(int(c)) for c in classes]).alias("classes"),
        F.lit(len(model.thresholds)).alias("width"),
    )


def score_forest(df: DataFrame, nodes: DataFrame, features: Sequence[str], name: str = "forest", version: int = 1) -> DataFrame:
    """Adds ``predicted_class`` and ``prediction_probability`` by walking the trees of one version of a forest table.

    Whole Arrow batches walk a tree at a time, level by level. Trees are sent to every task, as many together
    as ``TOGETHER_BYTES`` allow (one at least); the votes are stored before the next ones. A tree beyond ``FOREST_BYTES``
    is an error. Rows with a missing or not finite feature, or with another number of them, get NULLs.
    """
    check_schema(df, features)
    own = nodes.filter((F.col("model_name") == name) & (F.col("version") == version))
    first = own.first()
    if first is None:
        raise ValueError(f"forest {name} has no version {version}")
    classes, width = first["classes"], first["width"]
    sizes = {r["tree"]: r["count"] for r in own.groupBy("tree").count().collect()}
    groups, room = [], 0
    for tree, count in sorted(sizes.items()):
        needed = count * (24 + 8 * len(classes))
        if needed > FOREST_BYTES:
            raise ValueError(f"tree {tree} of forest {name} version {version} has {count} nodes, too many to send to every task")
        if needed > room:
            groups.append([])
            room = TOGETHER_BYTES
        groups[-1].append(tree)
        room -= needed
    scored = df
    for i, group in enumerate(groups):
        votes, sent = _tree_votes(df.sparkSession, own.where(F.col("tree").between(group[0], group[-1])), width, len(classes))
        votes = votes(_array(df, features))
        scored = scored.withColumn("_p", F.zip_with("_p", votes, lambda a, b: a + b) if i else votes)
        if i + 1 < len(groups):
            folder = fresh_folder(df.sparkSession, "votes")
            scored.write.parquet(folder)
            scored = df.sparkSession.read.schema(scored.schema).parquet(folder)
            sent.destroy()
    total = F.aggregate("_p", F.lit(0.0), lambda a, x: a + x)
    scored = scored.withColumn("_p", F.transform("_p", lambda v: v / F.greatest(total, F.lit(1e-300))))
    best = F.array_max("_p")
    ids = F.array(*[F.lit(int(c)) for c in classes])
    return scored.withColumns(
        {"predicted_class": F.get(ids, (F.array_position("_p", best) - 1).cast("int")), "prediction_probability": best}
    ).drop("_p")


def _tree_votes(spark: SparkSession, nodes: DataFrame, width: int, classes: int):
    """The sums of class shares over the trees of ``nodes``, as a function of an array of features, and the broadcast it reads."""
    table = nodes.select("tree", "node", "feature", "threshold", "left", "right", "share").orderBy("tree", "node").toArrow().combine_chunks()
    tree = table.column("tree").to_numpy()
    begin = np.searchsorted(tree, tree)
    sent = spark.sparkContext.broadcast(
        {
            "begin": np.unique(begin),
            "feature": table.column("feature").to_numpy(),
            "threshold": table.column("threshold").fill_null(0.0).to_numpy(),
            "left": table.column("left").to_numpy() + begin,
            "right": table.column("right").to_numpy() + begin,
            "share": table.column("share").combine_chunks().flatten().to_numpy().reshape(-1, classes),
        }
    )

    @F.pandas_udf("array<double>")
    def votes(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        trees = sent.value
        blank = np.full(width, np.nan)
        for batch in batches:
            x = np.array([blank if v is None or len(v) != width else np.asarray(v, "float64") for v in batch]).reshape(-1, width)
            total = np.zeros((len(x), classes))
            with np.errstate(invalid="ignore"):
                for root in trees["begin"]:
                    leaf = forests.walk(x, np.full(len(x), root), *(trees[c] for c in ("feature", "threshold", "left", "right")))
                    total += trees["share"][leaf]
            known = np.isfinite(x).all(axis=1)
            yield pd.Series([s if k else None for s, k in zip(total, known)], dtype="object")

    return votes, sent
