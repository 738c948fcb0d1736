"""Appends that are whole or absent, and labels joined to them later."""

import random
import uuid
from collections import defaultdict
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators import feedback
from tidemark.sources.ledger import Ledger
from tidemark.sources.tables import TableSpace

DAY = date(2024, 1, 1)
COLUMNS = (("id", "BIGINT"), ("a", "DOUBLE"), ("data_carga", "DATE"))
KEY = (("id", "BIGINT"),)


@pytest.fixture
def space(spark):
    return TableSpace(spark, f"t{uuid.uuid4().hex}").create()


@pytest.fixture
def ledger(space):
    return Ledger(space, "rows", COLUMNS).create()


def rows(spark, ids, day=0):
    return spark.createDataFrame([(i, float(i), DAY + timedelta(days=day)) for i in ids], "id long, a double, data_carga date")


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_batches_are_seen_once_and_whole(spark, ledger):
    assert ledger.read().count() == 0 and ledger.published().count() == 0
    with pytest.raises(ValueError, match="no batch"):
        ledger.last_batch()
    assert ledger.append(rows(spark, range(5)), "b1", datetime(2024, 1, 1))
    assert ledger.append(rows(spark, range(5, 9), 1).select("data_carga", "id", "a"), "b2", datetime(2024, 1, 2))
    assert not ledger.append(rows(spark, range(50)), "b1")
    ledger.stage(rows(spark, range(100, 200)))  # never published
    assert ids(ledger.read()) == list(range(9))
    assert ids(ledger.read_batch("b2")) == [5, 6, 7, 8] and ids(ledger.read_batch("none")) == []
    assert {(r["day"], r["batches"], r["n"]) for r in ledger.days().collect()} == {(DAY, 1, 5), (DAY + timedelta(days=1), 1, 4)}
    assert ledger.last_batch() == ("b2", DAY + timedelta(days=1), DAY + timedelta(days=1))
    with pytest.raises(ValueError, match="columns differ"):
        ledger.append(rows(spark, [1]).drop("a"), "b3")


def test_empty_batch_is_dealt_with(spark, ledger):
    assert ledger.append(rows(spark, []), "none") and not ledger.append(rows(spark, [1]), "none")
    assert ledger.read().count() == 0 and ledger.days().count() == 0


def test_two_writers_of_one_batch(spark, ledger):
    """A writer that was taken for dead publishes as well: readers see one attempt only, and always the same."""
    first, second = ledger.stage(rows(spark, range(4))), ledger.stage(rows(spark, range(4)))
    ledger.publish("b", second, datetime(2024, 1, 1, 0, 0, 1))
    assert ids(ledger.read()) == list(range(4))
    ledger.publish("b", first, datetime(2024, 1, 1, 0, 0, 2))
    assert ids(ledger.read()) == list(range(4)) and {r["attempt"] for r in ledger.published().collect()} == {second}


def test_batch_over_several_days_and_rows_without_day(spark, ledger):
    three = rows(spark, [1]).union(rows(spark, [2, 3], 1)).union(spark.createDataFrame([(4, 0.0, None)], "id long, a double, data_carga date"))
    ledger.append(three, "b")
    assert ids(ledger.read()) == [1, 2, 3, 4] and ids(ledger.read(DAY + timedelta(days=1))) == [2, 3]
    assert ids(ledger.read(until=DAY)) == [1]
    assert {(r["day"], r["n"]) for r in ledger.published().collect()} == {(None, 0), (None, 1), (DAY, 1), (DAY + timedelta(days=1), 2)}


def test_days_and_attempts_prune_the_files(spark, ledger):
    for n in range(6):
        ledger.append(rows(spark, range(n, n + 3), n), f"b{n}")
    plan = ledger.read(DAY + timedelta(days=1), DAY + timedelta(days=2))._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "PartitionFilters" in line and "data_carga" in line.split("PartitionFilters")[1])
    assert "data_carga" in scan.split("PartitionFilters:")[1].split("]")[0]
    read = ledger.read(DAY + timedelta(days=1), DAY + timedelta(days=2))
    assert ids(read) == [1, 2, 2, 3, 3, 4]


def brute(predictions, labels, horizon, early):
    """(id, batch, label) of the last label of each prediction."""
    told = defaultdict(list)
    for i, label, day in labels:
        told[i].append((day, label))
    out = {}
    for i, batch, day in predictions:
        near = [(d, y) for d, y in told[i] if -early <= d - day <= horizon]
        if near:
            out[i, batch] = max(near)[1]
    return out


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_late_labels_by_brute_force(spark, space, seed, monkeypatch):
    """Batches of both sides in random order, with runs in between, one of which dies."""
    rng = random.Random(seed)
    columns = (*KEY, ("batch_id", "STRING"), ("model_version", "INT"), ("predicted_class", "INT"), ("data_carga", "DATE"))
    preds = Ledger(space, "preds", columns).create()
    labels, outcomes = feedback.labels_ledger(space, KEY), feedback.outcomes_ledger(space, KEY)
    made, told = [], []
    died = False
    for n in range(7):
        day = rng.randrange(12)
        some = rng.sample(range(30), 12)
        if rng.random() < 0.5:
            made += [(i, f"p{n}", day) for i in some]
            frame = spark.createDataFrame([(i, f"p{n}", 1, i % 3, DAY + timedelta(days=day)) for i in some], "id long, batch_id string, model_version int, predicted_class int, data_carga date")
            preds.append(frame, f"x{n}")
        else:
            new = [(i, rng.randrange(3), day) for i in some]
            told += new
            frame = spark.createDataFrame([(i, y, DAY + timedelta(days=d)) for i, y, d in new], "id long, label int, labelled_on date")
            labels.append(frame, f"x{n}")
        if rng.random() < 0.6:
            if not died:
                died = True
                with monkeypatch.context() as m:
                    m.setattr(Ledger, "publish", lambda *a, **k: 1 / 0)
                    with pytest.raises(ZeroDivisionError):
                        feedback.match_labels(preds, labels, outcomes, ["id"], 4, 2)
            feedback.match_labels(preds, labels, outcomes, ["id"], 4, 2)
    feedback.match_labels(preds, labels, outcomes, ["id"], 4, 2)
    assert feedback.match_labels(preds, labels, outcomes, ["id"], 4, 2) is None
    found = {(r["id"], r["batch_id"]): r["label"] for r in feedback.latest_outcomes(outcomes.read(), ["id"]).collect()}
    assert found == brute(made, told, 4, 2)
    # every pair once, however often the join ran
    pairs = sum(1 for i, _, d in made for j, _, e in told if i == j and -2 <= e - d <= 4)
    assert outcomes.read().count() == pairs


def test_performance_counts_labels_and_days_without(spark, space):
    columns = (*KEY, ("batch_id", "STRING"), ("model_version", "INT"), ("predicted_class", "INT"), ("data_carga", "DATE"))
    preds = Ledger(space, "preds", columns).create()
    labels, outcomes = feedback.labels_ledger(space, KEY), feedback.outcomes_ledger(space, KEY)
    assert feedback.performance_by_day(preds, outcomes, ["id"]).count() == 0
    for d in range(3):
        frame = spark.createDataFrame([(i, f"p{d}", 1, i % 2, DAY + timedelta(days=d)) for i in range(10)], "id long, batch_id string, model_version int, predicted_class int, data_carga date")
        preds.append(frame, f"p{d}")
    told = [(i, (i % 2) if i < 3 else 1 - i % 2, DAY + timedelta(days=1)) for i in range(4)] + [(4, None, DAY + timedelta(days=1)), (None, 1, DAY)]
    labels.append(spark.createDataFrame(told, "id long, label int, labelled_on date"), "l")
    feedback.match_labels(preds, labels, outcomes, ["id"], horizon=1)
    got = {r["data_carga"].day: (r["n_predictions"], r["n_labelled"], r["coverage"], r["accuracy"]) for r in feedback.performance_by_day(preds, outcomes, ["id"]).collect()}
    assert got == {1: (10, 4, 0.4, 0.75), 2: (10, 4, 0.4, 0.75), 3: (10, 0, 0.0, None)}


def test_label_join_reads_only_days_in_reach(spark, space):
    columns = (*KEY, ("batch_id", "STRING"), ("model_version", "INT"), ("predicted_class", "INT"), ("data_carga", "DATE"))
    preds = Ledger(space, "preds", columns).create()
    labels, outcomes = feedback.labels_ledger(space, KEY), feedback.outcomes_ledger(space, KEY)
    for d in (0, 50, 100):
        preds.append(spark.createDataFrame([(1, f"p{d}", 1, 0, DAY + timedelta(days=d))], "id long, batch_id string, model_version int, predicted_class int, data_carga date"), f"p{d}")
    feedback.match_labels(preds, labels, outcomes, ["id"])
    labels.append(spark.createDataFrame([(1, 0, DAY + timedelta(days=51))], "id long, label int, labelled_on date"), "l")
    asked = []
    read = Ledger.read
    with pytest.MonkeyPatch.context() as m:
        m.setattr(Ledger, "read", lambda self, *a: asked.append((self.table, a[:2])) or read(self, *a))
        feedback.match_labels(preds, labels, outcomes, ["id"], horizon=10)
    assert asked == [("preds", (DAY + timedelta(days=41), DAY + timedelta(days=51))), (feedback.LABELS, (DAY + timedelta(days=51),) * 2)]
    assert [r["batch_id"] for r in outcomes.read().select(F.col("batch_id")).collect()] == ["p50"]
