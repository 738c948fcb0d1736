"""Scoring and alignment."""

from pyspark.sql import functions as F

from tidemark.operators import scoring
from tidemark.operators.scaling import fit_scaler
from tidemark.plans.catalogue.base import FEATURES, MODEL, RIVAL, labelled, query, rnd, scored, scored_ctes, tidy
from tidemark.sources.tables import load_parquet

OUTPUT = ["predicted_class", "prediction_probability", "probability_class_0", "probability_class_1", "probability_class_2"]


@query(
    "score_softmax",
    f"""WITH {scored_ctes()}
SELECT l_orderkey, l_partkey, l_suppkey, predicted_class, model_version,
  {", ".join(f"{rnd(c)} AS {c}" for c in OUTPUT[1:])} FROM scored""",
)
def score_softmax(spark, folder):
    return tidy(scored(spark, folder).select("l_orderkey", "l_partkey", "l_suppkey", "model_version", *OUTPUT))


def _class_sql(z: str) -> str:
    return f"CASE WHEN {z}0 >= {z}1 AND {z}0 >= {z}2 THEN 0 WHEN {z}1 >= {z}2 THEN 1 ELSE 2 END"


def _logit_sql(model: scoring.LinearModel, prefix: str) -> str:
    return ", ".join(
        f"{b!r}e0 + " + " + ".join(f"({w!r}e0) * x{j}" for j, w in enumerate(ws)) + f" AS {prefix}{i}"
        for i, (b, ws) in enumerate(zip(model.intercepts, model.weights))
    )


PAIR_CTES = f"""{scored_ctes()}, pair AS (SELECT target, {_class_sql("p")} AS production_class,
  {_class_sql("c")} AS challenger_class FROM (SELECT target, {_logit_sql(MODEL, "p")}, {_logit_sql(RIVAL, "c")} FROM scored_x))"""


@query(
    "score_pair",
    f"WITH {PAIR_CTES} SELECT production_class, challenger_class, count(*) AS n FROM pair GROUP BY 1, 2",
)
def score_pair(spark, folder):
    rows = labelled(spark, folder)
    pair = scoring.score_pair(rows, MODEL, RIVAL, fit_scaler(rows, FEATURES))
    return pair.groupBy("production_class", "challenger_class").agg(F.count("*").alias("n"))


# one two-class model per event type, written as a formula of the type's rank
EVENT_MODELS = {"click": 1, "error": 2, "purchase": 3, "signup": 4, "view": 5}


def _row_model_sql(models: dict[str, int]) -> str:
    """CTEs ending in ``e``: events with the logits and exponents of their own type's model."""
    values = ", ".join(f"('{kind}', {rank})" for kind, rank in models.items())
    return f"""m(event_type, r) AS (VALUES {values}),
z AS (SELECT event_id, event_type, 0.1e0 * r AS z0, -0.2e0 * r + (value / 100.0e0) * (0.3e0 * r) AS z1 FROM events LEFT JOIN m USING (event_type)),
e AS (SELECT event_id, event_type, z0, z1, exp(z0 - greatest(z0, z1)) AS e0, exp(z1 - greatest(z0, z1)) AS e1 FROM z)"""


def _scored_by_type(spark, folder, models: dict[str, int]):
    events = load_parquet(spark, folder, "events").withColumn("x", F.col("value") / 100.0)
    rank = F.create_map(*[F.lit(v) for item in models.items() for v in item])[F.col("event_type")]
    kinds = events.select("event_type").distinct().withColumn("r", rank.cast("double")).filter("r IS NOT NULL")
    coefficients = kinds.select(
        "event_type",
        F.inline(
            F.array(
                F.struct(F.lit(0).alias("class_id"), (F.col("r") * 0.1).alias("intercept"), F.array(F.lit(0.0)).alias("weights")),
                F.struct(
                    F.lit(1).alias("class_id"), (F.col("r") * -0.2).alias("intercept"), F.array(F.col("r") * 0.3).alias("weights")
                ),
            )
        ),
    )
    return scoring.score_by_row_model(events, coefficients, ["event_type"], ["x"])


@query(
    "score_by_row_model",
    f"""WITH {_row_model_sql(EVENT_MODELS)}
SELECT event_id, CASE WHEN z0 >= z1 THEN 0 WHEN z0 < z1 THEN 1 END AS predicted_class,
  floor(greatest(e0, e1) / (e0 + e1) * 1e6 + 0.5e0) / 1e6 AS prediction_probability FROM e""",
)
def score_by_row_model(spark, folder):
    rows = _scored_by_type(spark, folder, EVENT_MODELS)
    return tidy(rows.select("event_id", "predicted_class", "prediction_probability"))


KNOWN_TYPES = {kind: rank for kind, rank in EVENT_MODELS.items() if kind != "view"}


@query(
    "score_rows_without_model",
    f"""WITH {_row_model_sql(KNOWN_TYPES)}
SELECT event_type, count(*) AS n, count(z0) AS scored, count(CASE WHEN z0 < z1 THEN 1 END) AS class_1 FROM e GROUP BY event_type""",
)
def score_rows_without_model(spark, folder):
    """Models for all types but one: its rows stay, without a score."""
    rows = _scored_by_type(spark, folder, KNOWN_TYPES)
    return rows.groupBy("event_type").agg(
        F.count("*").alias("n"), F.count("predicted_class").alias("scored"), F.count_if(F.col("predicted_class") == 1).alias("class_1")
    )


# the vectors of every fourth row are cut, carry an infinity, or hold a NULL: none of these has a score
ODD_VECTORS = """SELECT vec_id, CASE vec_id % 16 WHEN 0 THEN embedding[1:63] WHEN 4 THEN list_append(embedding, 1) WHEN 8 THEN list_append(embedding[1:63], 'inf'::FLOAT)
  WHEN 12 THEN list_append(embedding[1:63], NULL) ELSE embedding END AS v FROM embeddings"""


@query(
    "score_both_ways",
    f"""WITH o AS ({ODD_VECTORS}) SELECT count(*) AS n, count(CASE WHEN vec_id % 4 <> 0 THEN 1 END) AS scored, 0::BIGINT AS differences FROM o""",
)
def score_both_ways(spark, folder):
    """The same wide model as plain arithmetic and as one matrix product per batch, over regular and odd vectors."""
    rows = load_parquet(spark, folder, "embeddings").select("vec_id", F.col("embedding").alias("v"))
    short, last = F.slice("v", 1, 63), lambda x: F.concat(F.slice("v", 1, 63), F.array(x.cast("float")))
    turn = F.col("vec_id") % 16
    odd = F.when(turn == 0, short).when(turn == 4, F.concat("v", F.array(F.lit(1.0).cast("float")))).when(turn == 8, last(F.lit("inf")))
    rows = rows.withColumn("embedding", odd.when(turn == 12, last(F.lit(None))).otherwise(F.col("v"))).drop("v")
    names = ["predicted_class", *[f"probability_class_{c}" for c in WIDE.class_ids]]
    ways = [scoring.with_probabilities(rows, WIDE, unroll=unroll).select("vec_id", *names) for unroll in (0, 1 << 20)]
    both = ways[0].join(ways[1].select("vec_id", *[F.col(n).alias(f"_{n}") for n in names]), "vec_id")
    same = F.col("predicted_class").eqNullSafe(F.col("_predicted_class"))
    for n in names[1:]:
        same = same & (F.abs(F.col(n) - F.col(f"_{n}")) < 1e-9).eqNullSafe(F.when(F.col(n).isNotNull() | F.col(f"_{n}").isNotNull(), F.lit(True)))
    return both.agg(F.count("*").alias("n"), F.count("predicted_class").alias("scored"), F.count_if(~same).alias("differences"))


WIDE = scoring.LinearModel(
    name="vectors",
    version=1,
    features=("embedding",),
    class_ids=tuple(range(10)),
    intercepts=tuple(c / 20 for c in range(10)),
    weights=tuple(tuple(((c * 7 + j * 13) % 11 - 5) / 2 for j in range(64)) for c in range(10)),
)


@query(
    "score_wide_vectors",
    f"""WITH z AS (SELECT vec_id, c.c, c.c / 20.0e0 + list_sum([embedding[j + 1]::DOUBLE * (((c.c * 7 + j * 13) % 11 - 5) / 2.0e0)
    FOR j IN range(64)]) AS z FROM embeddings CROSS JOIN range(10) AS c(c)),
e AS (SELECT vec_id, c, z, exp(z - max(z) OVER (PARTITION BY vec_id)) AS e FROM z),
p AS (SELECT vec_id, c, z, e / sum(e) OVER (PARTITION BY vec_id) AS p FROM e)
SELECT vec_id, CAST(arg_max(c, z) AS INTEGER) AS predicted_class, {rnd("max(p)")} AS prediction_probability,
  {rnd("max(p) FILTER (c = 0)")} AS probability_class_0, {rnd("max(p) FILTER (c = 9)")} AS probability_class_9
FROM p GROUP BY vec_id""",
)
def score_wide_vectors(spark, folder):
    rows = scoring.score(load_parquet(spark, folder, "embeddings"), WIDE)
    kept = ["vec_id", "predicted_class", "prediction_probability", "probability_class_0", "probability_class_9"]
    return tidy(rows.select(*kept))


@query(
    "keyed_alignment_join",
    """SELECT o_orderkey, o_custkey, o_totalprice,
  CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_orderkey % 3 AS INTEGER) END AS predicted_class FROM orders""",
)
def keyed_alignment_join(spark, folder):
    orders = load_parquet(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    predictions = orders.filter("o_orderkey % 7 <> 0").select(
        "o_orderkey", (F.col("o_orderkey") % 3).cast("int").alias("predicted_class")
    )
    return scoring.align_predictions(orders, predictions, ["o_orderkey"])


@query(
    "alignment_report",
    """WITH k AS (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1)
SELECT count(*) FILTER (n IS NOT NULL AND o_orderkey IS NOT NULL) AS matched_keys, count(*) FILTER (n IS NULL) AS only_original,
  count(*) FILTER (o_orderkey IS NULL) AS only_predictions, count(*) FILTER (n > 1) AS duplicate_keys
FROM orders FULL JOIN k ON o_orderkey = l_orderkey""",
)
def alignment_report(spark, folder):
    orders = load_parquet(spark, folder, "orders").select(F.col("o_orderkey").alias("key"))
    items = load_parquet(spark, folder, "lineitem").select(F.col("l_orderkey").alias("key"))
    return scoring.alignment_report(orders, items, ["key"])
