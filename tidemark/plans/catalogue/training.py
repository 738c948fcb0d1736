"""Training on the labelled vectors; results are checked by properties, not by SQL."""

from pyspark.sql import functions as F

from tidemark.operators.evaluate import evaluate_predictions
from tidemark.operators.scoring import score
from tidemark.operators.split import part, stratified_split
from tidemark.operators.training import forest_predictions, forest_table, score_forest, train_forest, train_logreg
from tidemark.plans.catalogue.base import query, tidy
from tidemark.sources.tables import load_parquet
from tidemark.sources.workspace import durable


@query("train_logreg")
def logreg_accuracy(spark, folder):
    """Train and test metrics of a logistic regression on the vectors."""
    parts = stratified_split(load_parquet(spark, folder, "embeddings"), "label", ["vec_id"])
    model = train_logreg(part(parts, "train"), ["embedding"], "label")
    return tidy(evaluate_predictions(score(parts, model), "label", "predicted_class", ["split"]))


@query("train_logreg_coefficients")
def logreg_coefficients(spark, folder):
    """The coefficient table: norm and intercept per class."""
    vectors = load_parquet(spark, folder, "embeddings")
    table = train_logreg(vectors, ["embedding"], "label", name="vectors", version=1).to_table(spark)
    norm = F.sqrt(F.aggregate("weights", F.lit(0.0), lambda a, w: a + w * w))
    return tidy(table.select("model_name", "version", "class_id", "intercept", norm.alias("weight_norm")), 3)


@query("train_forest")
def forest_accuracy(spark, folder):
    """Train and test metrics of a forest on the vectors."""
    parts = stratified_split(load_parquet(spark, folder, "embeddings"), "label", ["vec_id"])
    model = train_forest(part(parts, "train"), ["embedding"], "label")
    scored = forest_predictions(model, parts, ["embedding"])
    return tidy(evaluate_predictions(scored, "label", "predicted_class", ["split"]))


@query(
    "forest_table_scores",
    "SELECT count(*) AS n, 100::BIGINT AS trees, count(*) AS scored, 0::BIGINT AS class_differences, 0::BIGINT AS probability_differences FROM embeddings",
)
def forest_table_scores(spark, folder):
    """A forest of the configured size as a table of nodes: its scores beside the trainer's own, over all rows."""
    vectors = load_parquet(spark, folder, "embeddings")
    model = train_forest(vectors, ["embedding"], "label")
    nodes = durable(forest_table(model, spark, range(10)))
    own = forest_predictions(model, vectors, ["embedding"]).select("vec_id", F.col("predicted_class").alias("c"), F.col("prediction_probability").alias("p"))
    walked = score_forest(vectors, nodes, ["embedding"]).join(own, "vec_id")
    trees = nodes.agg(F.count_distinct("tree").alias("trees"))
    return walked.agg(
        F.count("*").alias("n"),
        F.count("predicted_class").alias("scored"),
        F.count_if(F.col("predicted_class") != F.col("c")).alias("class_differences"),
        F.count_if(F.abs(F.col("prediction_probability") - F.col("p")) > 1e-9).alias("probability_differences"),
    ).withColumn("trees", trees.scalar())
