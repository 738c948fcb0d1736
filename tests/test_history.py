import uuid
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.operators import batch
from tidemark.operators.scoring import LinearModel, score
from tidemark.sources import predictions as history
from tidemark.sources import tables
from tidemark.sources.ledger import Ledger
from tidemark.streaming import scores

MODEL = LinearModel("m", 2, ("a", "b"), (0, 1), (0.0, 0.1), ((1.0, -1.0), (0.3, 0.2)))
STAMP = datetime(2024, 5, 6, 23, 59, 59)


@pytest.fixture
def space(spark):
    return tables.TableSpace(spark, f"t{uuid.uuid4().hex}").create()


@pytest.fixture
def rows(spark):
    return spark.createDataFrame([(i, i / 3, 1 - i / 7) for i in range(20)], "id long, a double, b double")


def test_statistics_of_all_batches(spark):
    nan = float("nan")
    data = [("x", 0, 0.7, 1), ("x", 1, 0.69, 1), ("x", 1, nan, 1), ("x", None, None, 1), ("y", 2, 0.9, 3)]
    df = spark.createDataFrame(data, "batch_id string, predicted_class int, prediction_probability double, model_version int")
    found = {r["batch_id"]: r for r in batch.batch_statistics(df).collect()}
    x = found["x"]
    assert x["class_distribution"] == {0: 1, 1: 2} and x["total_predictions"] == 4
    assert x["avg_confidence"] == pytest.approx(0.695) and x["max_confidence"] == 0.7
    assert x["low_confidence_count"] == 1 and x["low_confidence_pct"] == 25.0
    assert found["y"]["model_version"] == 3 and found["y"]["low_confidence_pct"] == 0.0


def test_retrain_triggers(spark):
    stats = spark.createDataFrame([(0.75, 15.0), (0.74, 10.0), (0.9, 15.1)], "avg_confidence double, low_confidence_pct double")
    assert [r["retrain"] for r in batch.retrain_triggers(stats).collect()] == [False, True, True]
    assert [r["retrain"] for r in batch.retrain_triggers(stats, 20.5).collect()] == [True] * 3
    shift = spark.createDataFrame([(20.0,)], "max_abs_diff_pct double")
    assert [r["features_moved"] for r in batch.retrain_triggers(stats, shift).collect()] == [False] * 3


def test_history_round_trip(space, rows):
    history.create_predictions_table(space, MODEL.features, MODEL.class_ids)
    history.create_predictions_table(space, MODEL.features, MODEL.class_ids)
    first = batch.build_predictions(score(rows, MODEL), MODEL.features, MODEL.class_ids, "b1", STAMP)
    history.append_predictions(space, first.select(*reversed(first.columns)))
    later = batch.build_predictions(score(rows.limit(5), MODEL), MODEL.features, MODEL.class_ids, "b2", datetime(2024, 5, 7))
    history.append_predictions(space, later)
    stored = space.read(history.PREDICTIONS)
    types = {n: t for n, t, _ in history.prediction_columns(MODEL.features, MODEL.class_ids)}
    assert {f.name: f.dataType.simpleString().upper() for f in stored.schema.fields} == types
    assert stored.count() == 25 and batch.batch_rows(stored, "b2").count() == 5
    assert batch.rows_of_day(stored, "2024-05-06").count() == 20
    plan = batch.batch_rows(stored, "b2", "2024-05-07")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(data_carga" in plan
    with pytest.raises(ValueError, match="columns differ"):
        history.append_predictions(space, later.drop("model_alias"))


def test_pointer_and_metadata(space, rows):
    with pytest.raises(ValueError, match="no batch id"):
        history.read_pointer(space)
    for batch_id in ("b1", "b2"):
        history.write_pointer(space, batch_id, STAMP)
        preds = batch.build_predictions(score(rows, MODEL), MODEL.features, MODEL.class_ids, batch_id, STAMP)
        history.append_metadata(space, batch.batch_statistics(preds), STAMP)
    assert history.read_pointer(space) == "b2"
    assert {r["batch_id"] for r in space.read(history.METADATA).collect()} == {"b1", "b2"}
    assert {r["tableName"] for r in space.tables().collect()} == {history.POINTER, history.METADATA}


def test_table_sources(space, rows):
    labelled = rows.withColumn("target", (F.col("id") % 2).cast("int"))
    tables.save_train_test(space, labelled, labelled.limit(4))
    x_train, x_test, y_train, y_test = tables.load_train_test(space)
    assert (x_train.count(), x_test.count()) == (20, 4) and y_test.columns == ["target"] and y_train.count() == 20
    space.overwrite(rows, "dataset_drift")
    assert tables.load_inference(space, ["b", "a"]).columns == ["b", "a"]
    assert tables.stage_new_data(space, ["a"]).columns == rows.columns
    with pytest.raises(ValueError, match="missing"):
        tables.load_inference(space, ["zzz"])
    space.overwrite(rows.limit(0), "dataset_drift")
    with pytest.raises(ValueError, match="empty"):
        tables.stage_new_data(space, ["a"])


def test_stream_scores_equal_batch_scores(spark, rows, tmp_path):
    rows.repartition(4).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    for _ in range(2):  # the second run finds nothing new
        scores.write_stream(scores.score_stream(stream, MODEL), out, state).awaitTermination()
    found = spark.read.parquet(out)
    expected = score(rows, MODEL)
    assert found.count() == 20 and found.exceptAll(expected.select(*found.columns)).isEmpty()


def without_commits(state):
    """As if the process had died after the write and before the commit of the micro-batch."""
    for entry in (state / "commits").iterdir():
        if entry.is_file():
            entry.unlink()


def test_stream_into_history_does_not_repeat_a_batch(spark, space, rows, tmp_path):
    rows.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    ledger = history.predictions_ledger(space, MODEL.features, MODEL.class_ids, [("id", "BIGINT")])
    state = tmp_path / "state"
    for _ in range(2):
        scores.append_scored_batches(ledger, stream, MODEL, str(state), clock=lambda: STAMP, key=["id"]).awaitTermination()
        without_commits(state)
    assert ledger.read().count() == 20 and ledger.published().select("batch_id").distinct().count() == 1


@pytest.mark.parametrize("dies", ["stage", "publish"])
def test_stream_that_dies_while_it_appends_gives_each_row_once(spark, space, rows, tmp_path, monkeypatch, dies):
    rows.repartition(4).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    ledger = history.predictions_ledger(space, MODEL.features, MODEL.class_ids, [("id", "BIGINT")])
    state = str(tmp_path / "state")
    step, calls = getattr(Ledger, dies), []

    def stop(self, batch, *more):
        calls.append(1)
        if len(calls) == 3:
            if dies == "stage":
                step(self, batch.limit(2), *more)  # some of its rows are in the table
            raise RuntimeError("died")
        return step(self, batch, *more)

    monkeypatch.setattr(Ledger, dies, stop)
    with pytest.raises(Exception, match="died"):
        scores.append_scored_batches(ledger, stream, MODEL, state, clock=lambda: STAMP, key=["id"]).awaitTermination()
    left = ledger.read().count()
    assert 0 < left < 20 and space.read(ledger.table).count() > left
    monkeypatch.setattr(Ledger, dies, step)
    scores.append_scored_batches(ledger, stream, MODEL, state, clock=lambda: STAMP, key=["id"]).awaitTermination()
    assert sorted(r["id"] for r in ledger.read().collect()) == list(range(20))


def test_daily_windows_close_with_the_watermark(spark, tmp_path):
    days = [(datetime(2024, 1, d, 12), "k", float(d)) for d in (1, 1, 2, 3, 4)]
    spark.createDataFrame(days, "ts timestamp_ntz, kind string, v double").coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("ts timestamp_ntz, kind string, v double").parquet(str(tmp_path / "in"))
    daily = scores.daily_stream_profile(stream, "ts", ["kind"], "v")
    scores.write_stream(daily, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    found = spark.read.parquet(str(tmp_path / "out")).orderBy("window_start").collect()
    assert [(r["window_start"].day, r["n"], r["avg_v"]) for r in found] == [(1, 2, 1.0), (2, 1, 2.0)]
