"""The model lifecycle end to end: prepare, train, compare, promote, score, summarise, monitor.

Every step reads and writes tables of a ``TableSpace``; rows stay on the executors.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators import evaluate, feedback, registry
from tidemark.operators.batch import batch_statistics, build_predictions, new_batch_id, retrain_triggers
from tidemark.operators.drift import class_share_drift, drift_details, mean_diff, prediction_drift
from tidemark.operators.prep import check_schema, check_signature, dq_report, model_signature, normalize_names, require_rows
from tidemark.operators.scaling import apply_scaler, fit_scaler, scaler_values
from tidemark.operators.scoring import COEFFICIENTS, LinearModel, score, score_pair
from tidemark.operators.split import part, stratified_split
from tidemark.operators.training import train_logreg
from tidemark.sources import predictions as history
from tidemark.sources.ledger import Ledger
from tidemark.sources.tables import TableSpace, load_inference
from tidemark.sources.workspace import durable

SCALER = "scaler_params"
MODEL_SCALERS = "model_scalers"
MODELS = "model_coefficients"
VERSIONS = "model_versions"
ALIASES = "model_alias_log"
METRICS = "metrics_log"
PARAMS = "params_log"
SIGNATURES = "model_signatures"


@dataclass(frozen=True)
class Lifecycle:
    """One model in one table space."""

    space: TableSpace
    model_name: str
    features: tuple[str, ...]
    label: str = "target"
    train_table: str = "train"
    test_table: str = "test"
    #: Columns (name, type) of rows to score that tell them apart, for labels that come later.
    key: tuple[tuple[str, str], ...] = ()

    # state tables -------------------------------------------------------------------------------

    def alias_log(self) -> DataFrame:
        return self.space.read_or_empty(ALIASES, registry.ALIAS_LOG)

    def versions(self) -> DataFrame:
        return self.space.read_or_empty(VERSIONS, registry.VERSIONS)

    def coefficients(self) -> DataFrame:
        return self.space.read_or_empty(MODELS, COEFFICIENTS)

    def scaler(self, version: int) -> dict:
        """The scaling that the training data of one version had."""
        rows = self.space.read(MODEL_SCALERS)
        return scaler_values(rows.filter((F.col("model_name") == self.model_name) & (F.col("version") == version)))

    def _taken(self) -> DataFrame:
        """Registered versions, and those that a training run left behind without registering them."""
        left = self.coefficients().select("model_name", "version", F.lit(None).cast("timestamp").alias("created_at"))
        if self.space.exists(MODEL_SCALERS):
            left = left.unionByName(self.space.read(MODEL_SCALERS).select("model_name", "version", F.lit(None).cast("timestamp").alias("created_at")))
        return self.versions().unionByName(left.distinct())

    def _record(self, events: DataFrame) -> None:
        # the events are derived from the table they are appended to, so they are fixed first
        self.space.append(durable(events), ALIASES)

    def _this(self, **columns: object) -> DataFrame:
        row = {"model_name": self.model_name, **columns}
        return self.space.spark.createDataFrame([tuple(row.values())], list(row))

    # steps --------------------------------------------------------------------------------------

    def prepare(
        self,
        raw: DataFrame,
        key: Sequence[str],
        test_size: float = 0.2,
        seed: int = 42,
        rules: Mapping[str, tuple[str, Column]] | None = None,
    ) -> None:
        """Names, optional quality rules, exact stratified split, scaler on the training part only.

        Writes the scaled train and test tables, the unscaled test table (``*_raw``: every model is tested in the
        scale it was trained in) and the scaler parameters fitted on raw values. Models keep their own copy.
        """
        rows = check_schema(normalize_names(raw), [*self.features, self.label, *key])
        if rules:
            dq_report(rows, rules, strict=True)
        columns = [*self.features, self.label]
        split = stratified_split(rows, self.label, key, {"test": test_size}, seed).select(*columns, "split")
        # written once, by part: what follows reads its part alone
        parts = self.space.overwrite(split, f"{self.train_table}_parts", ["split"])
        params = self.space.overwrite(fit_scaler(part(parts, "train"), self.features), SCALER)
        scales = scaler_values(params)
        self.space.overwrite(part(parts, "test").select(*columns), f"{self.test_table}_raw")
        for name, table in (("train", self.train_table), ("test", self.test_table)):
            self.space.overwrite(apply_scaler(part(parts, name), scales, self.features).select(*columns), table)

    def train(
        self, max_iter: int = 200, solver: str = "lbfgs", ts: datetime | None = None, run_id: str = "train"
    ) -> LinearModel:
        """Trains on the prepared rows, logs its parameters and metrics and registers a new version.

        The version becomes ``challenger`` when a production version exists, else ``baseline``. The version row
        and then the alias are written last: a run that stops before leaves no usable version, and its number
        is not given again.
        """
        train, test = self.space.read(self.train_table), self.space.read(self.test_table)
        at = F.lit(ts)
        rows, events = registry.register(self._taken(), self.alias_log(), self._this(), at)
        rows = durable(rows)
        version = rows.first()["version"]
        model = train_logreg(
            train, self.features, self.label, max_iter, solver=solver, name=self.model_name, version=version
        )
        scaler = self.space.read(SCALER).withColumns({"model_name": F.lit(self.model_name), "version": F.lit(version)})
        events = durable(events)
        self.space.append(durable(scaler), MODEL_SCALERS)
        params = {"solver": solver, "max_iter": max_iter, "features": ",".join(self.features), "label": self.label, "classes": len(model.class_ids)}
        self.space.append(registry.param_rows(self.space.spark, params, run_id, model.name, version), PARAMS)
        self.space.append(self._training_metrics(model, train, test, run_id), METRICS)
        self.space.append(model.to_table(self.space.spark), MODELS)
        signature = self._this(version=version, signature=model_signature(train, self.features))
        self.space.append(signature, SIGNATURES)
        self.space.append(rows, VERSIONS)
        self._record(events)
        return model

    def _training_metrics(self, model: LinearModel, train: DataFrame, test: DataFrame, run_id: str) -> DataFrame:
        """Accuracy on both parts, and the weighted metrics, log loss and ROC area on the training part."""
        both = train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))
        scored = score(both, model)
        by_split = evaluate.evaluate_predictions(scored, self.label, "predicted_class", ["split"])
        weighted = evaluate.long_metrics(by_split, ["split"])
        weighted = weighted.filter((F.col("split") == "train") | (F.col("metric") == "accuracy"))
        fitted = scored.filter(F.col("split") == "train")
        loss = evaluate.log_loss(fitted, self.label, model.class_ids).select(
            F.lit("train_log_loss").alias("metric"), F.col("log_loss").alias("value")
        )
        area = evaluate.weighted_auc(evaluate.roc_auc(fitted, self.label, model.class_ids)).select(
            F.lit("train_roc_auc").alias("metric"), F.col("roc_auc").alias("value")
        )
        rows = weighted.select(F.concat_ws("_", "split", "metric").alias("metric"), "value").unionByName(loss).unionByName(area)
        return registry.metric_rows(rows, run_id, model.name, model.version)

    def evaluate_alias(self, alias: str) -> DataFrame:
        """Weighted metrics of the model behind an alias on the test table, with alias and version."""
        model = registry.model_by_alias(self.coefficients(), self.alias_log(), self.model_name, alias)
        scored = score(self.space.read(f"{self.test_table}_raw"), model, self.scaler(model.version))
        metrics = evaluate.evaluate_predictions(scored, self.label, "predicted_class")
        return metrics.withColumns({"alias": F.lit(alias), "version": F.lit(model.version)})

    def compare(self) -> DataFrame:
        """One row: status, versions, both accuracies, winner, improvement, advice, message."""
        log = self.alias_log()
        found = {a: registry.version_by_alias(log, self.model_name, a) for a in ("production", "challenger")}
        accuracies = self.space.spark.createDataFrame([], "model_name string, version int, accuracy double")
        if all(found.values()):
            models = [LinearModel.from_table(self.coefficients(), self.model_name, v) for v in found.values()]
            scalers = [self.scaler(model.version) for model in models]
            pair = score_pair(self.space.read(f"{self.test_table}_raw"), *models, *scalers)
            result = evaluate.compare_predictions(pair, self.label, "production_class", "challenger_class")
            accuracies = result.select(
                F.lit(self.model_name).alias("model_name"),
                F.inline(
                    F.array(
                        *[
                            F.struct(F.lit(v).alias("version"), F.col(f"{a}_accuracy").alias("accuracy"))
                            for a, v in found.items()
                        ]
                    )
                ),
            ).distinct()
        return registry.evaluate_ab(self._this(), log, accuracies)

    def promote(self, only_if_better: bool = True, from_alias: str = "challenger", ts: datetime | None = None) -> None:
        """Moves production to the version behind ``from_alias``; nothing happens without one."""
        models = self.compare().select("model_name", "should_promote") if only_if_better else self._this()
        self._record(registry.promote(self.alias_log(), models, from_alias, ts=F.lit(ts)))

    def rollback(self, version: int, ts: datetime | None = None) -> None:
        self._record(registry.rollback(self.alias_log(), self._this(version=version), self.versions(), F.lit(ts)))

    def score_batch(
        self, source: DataFrame | None = None, alias: str = "production", ts: datetime | None = None, batch_id: str | None = None
    ) -> str:
        """Validates, scales, scores and appends one batch in a single lazy plan; returns its id.

        The batch is published as a whole; repeated under the id of a published one it is left out.
        """
        ts, batch_id = ts or datetime.now(), batch_id or new_batch_id()
        keys = [name for name, _ in self.key]
        wanted = [*self.features, *keys]
        rows = load_inference(self.space, wanted) if source is None else require_rows(check_schema(source, wanted))
        model = registry.model_by_alias(self.coefficients(), self.alias_log(), self.model_name, alias)
        contract = self.space.read(SIGNATURES).filter(
            (F.col("model_name") == self.model_name) & (F.col("version") == model.version)
        )
        typed = rows.withColumns({f: F.col(f).cast("double") for f in self.features})
        check_signature(typed, contract.first()["signature"])
        scored = score(typed, model, self.scaler(model.version))
        ledger = history.predictions_ledger(self.space, self.features, model.class_ids, self.key)
        ledger.append(build_predictions(scored, self.features, model.class_ids, batch_id, ts, alias, keys), batch_id)
        return batch_id

    def summarize_batch(self, batch_id: str | None = None, ts: datetime | None = None) -> DataFrame:
        """Statistics of one batch (the last one by default), also appended to their history."""
        batch_id = batch_id or self.predictions().last_batch()[0]
        rows = require_rows(self.predictions().read_batch(batch_id), f"batch {batch_id}")
        stats = durable(batch_statistics(rows))
        history.append_metadata(self.space, stats, ts or datetime.now())
        return stats

    # monitoring ---------------------------------------------------------------------------------

    def predictions(self) -> Ledger:
        return history.open_ledger(self.space)

    def recent(self, days: int | None = None) -> DataFrame:
        """Published predictions of the last ``days`` load dates up to the newest one; of all without."""
        ledger = self.predictions()
        newest = None if days is None else ledger.days().agg(F.max("day")).first()[0]
        return ledger.read(None if newest is None else newest - timedelta(days=days - 1))

    def monitor(
        self, baseline: DataFrame, production: DataFrame | None = None, days: int | None = None, **options
    ) -> DataFrame:
        """Drift per feature of recent rows (of the prediction history by default) against a baseline."""
        return drift_details(baseline, self.recent(days) if production is None else production, self.features, **options)

    def monitor_predictions(self, days: int, before: int, **options) -> DataFrame:
        """Drift of the confidence and of class shares: the last ``days`` load dates against the ``before`` ahead of them.

        Rows (measure, item, baseline, recent, change, has_drift): the test's distance for the confidence, shares for classes.
        """
        ledger = self.predictions()
        newest = ledger.days().agg(F.max("day")).first()[0]
        edge = newest - timedelta(days=days)
        old, new = ledger.read(edge - timedelta(days=before - 1), edge), ledger.read(edge + timedelta(days=1), newest)
        test = prediction_drift(old, new, **options).select(
            F.lit("confidence").alias("measure"),
            F.lit(None).cast("int").alias("item"),
            F.lit(None).cast("double").alias("baseline"),
            F.lit(None).cast("double").alias("recent"),
            F.col("drift_score").alias("change"),
            "has_drift",
        )
        shares = class_share_drift(old, new).select(
            F.lit("class share").alias("measure"),
            F.col("class").alias("item"),
            F.col("baseline_share").alias("baseline"),
            F.col("recent_share").alias("recent"),
            F.col("share_diff").alias("change"),
            F.lit(None).cast("boolean").alias("has_drift"),
        )
        return test.unionByName(shares)

    def _feedback(self) -> tuple[Ledger, Ledger]:
        if not self.key:
            raise ValueError("labels that come later need a key; give the model's lifecycle one")
        return feedback.labels_ledger(self.space, self.key), feedback.outcomes_ledger(self.space, self.key)

    def record_labels(self, labels: DataFrame, batch_id: str, day: date) -> None:
        """Appends true classes (key columns and ``label``) that arrived on ``day``, as one batch."""
        ledger, _ = self._feedback()
        keys = [name for name, _ in self.key]
        ledger.append(labels.select(*keys, "label", F.lit(day).alias(feedback.LABEL_DAY)), batch_id)

    def performance(self, horizon: int = 30, since: date | None = None, until: date | None = None) -> DataFrame:
        """Joins what has arrived since the last call, then gives metrics per load date of the predictions."""
        labels, outcomes = self._feedback()
        keys = [name for name, _ in self.key]
        feedback.match_labels(self.predictions(), labels, outcomes, keys, horizon)
        return feedback.performance_by_day(self.predictions(), outcomes, keys, since, until)

    def retrain_due(self, batch_id: str | None = None, baseline: DataFrame | None = None, days: int | None = None, **limits) -> DataFrame:
        """Retrain signals of one batch (the last one by default), with the greatest mean shift if a baseline is given."""
        stats = batch_statistics(self.predictions().read_batch(batch_id or self.predictions().last_batch()[0]))
        shift = None
        if baseline is not None:
            shift = mean_diff(baseline, self.recent(days), self.features).agg(F.max(F.abs("diff_pct")).alias("max_abs_diff_pct"))
        return retrain_triggers(stats, shift, **limits)

    def discard_loser(self, ts: datetime | None = None) -> None:
        """Takes the alias from a challenger that does not beat production."""
        self._record(registry.discard_losers(self.alias_log(), self.compare(), F.lit(ts)))
