import hashlib
import math

import pytest
from pyspark.sql import functions as F

from tidemark.operators.split import part, stratified_split


def labelled(spark, sizes, partitions=3):
    """Row ids with a label; sizes maps label to row count."""
    rows, n = [], 0
    for label, size in sizes.items():
        rows += [(n + i, label) for i in range(size)]
        n += size
    return spark.createDataFrame(rows, "id long, y string").repartition(partitions)


def expected(sizes, fractions, seed=42):
    """Brute force: quotas by largest remainder, members by rank of the seeded hash."""
    total, out, n = sum(sizes.values()), {}, 0
    quotas = {label: [] for label in sizes}
    for fraction in fractions.values():
        size = math.ceil(round(fraction * total, 6))
        base = {k: size * v // total for k, v in sizes.items()}
        order = sorted(sizes, key=lambda k: (-(size * sizes[k] % total), k))
        for k in order[: size - sum(base.values())]:
            base[k] += 1
        for k in sizes:
            quotas[k].append(base[k])
    for label, size in sizes.items():
        ids = sorted(range(n, n + size), key=lambda i: (hashlib.md5(f"{seed}|{i}".encode()).hexdigest(), str(i)))
        names = [name for name, q in zip(fractions, quotas[label]) for _ in range(q)]
        out.update(zip(ids, names + ["train"] * size))
        n += size
    return out


@pytest.mark.parametrize("fractions", [{"test": 0.2}, {"test": 0.2, "validation": 0.15}])
def test_members_match_brute_force(spark, fractions):
    sizes = {"a": 701, "b": 333, "c": 17}
    df = stratified_split(labelled(spark, sizes), "y", ["id"], fractions)
    assert {r["id"]: r["split"] for r in df.collect()} == expected(sizes, fractions)


def test_layout_does_not_matter(spark):
    sizes = {"a": 400, "b": 100}
    one, many = (
        {(r["id"], r["split"]) for r in stratified_split(labelled(spark, sizes, p), "y", ["id"]).collect()}
        for p in (1, 11)
    )
    assert one == many


def test_unstratified_and_parts(spark):
    df = stratified_split(labelled(spark, {"a": 15}), None, ["id"], {"test": 0.2})
    assert part(df, "test").count() == 3 and part(df, "train").count() == 12
    assert "split" not in part(df, "test").columns


def test_null_label_is_a_class(spark):
    df = labelled(spark, {"a": 50, "b": 50}).withColumn("y", F.when(F.col("y") == "a", "a"))
    counts = {(r["y"], r["split"]): r["count"] for r in stratified_split(df, "y", ["id"]).groupBy("y", "split").count().collect()}
    assert counts == {("a", "test"): 10, ("a", "train"): 40, (None, "test"): 10, (None, "train"): 40}


def test_copies_of_a_key_stay_together(spark):
    df = labelled(spark, {"a": 90}).withColumn("id", F.when(F.col("id") < 30, 0).otherwise(F.col("id")))
    sides = stratified_split(df, "y", ["id"]).groupBy("id").agg(F.count_distinct("split").alias("n"))
    assert sides.filter("n > 1").isEmpty()


def test_errors(spark):
    with pytest.raises(ValueError, match="fewer than 2"):
        stratified_split(labelled(spark, {"a": 20, "b": 1}), "y", ["id"])
    with pytest.raises(ValueError, match="fewer rows than there are classes"):
        stratified_split(labelled(spark, {"a": 2, "b": 2, "c": 2}), "y", ["id"], {"test": 0.3})
    with pytest.raises(ValueError, match="fractions"):
        stratified_split(labelled(spark, {"a": 20}), "y", ["id"], {"test": 1.0})
