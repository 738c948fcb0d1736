"""Toxicity by compression distance.

Windows are compressed with two zstandard dictionaries, of which only the common base is trained, on ordinary
windows: toxic and ordinary rows share almost all of their words, and dictionaries trained separately told them apart
worse. The two differ in an end of equal size: the words of toxic rows that are ``LIFT`` times as frequent there, or common words of ordinary rows. The
classifier is fitted on a bounded sample of labelled rows (``SAMPLE_ROWS``); scores cover everything. A window of words is compressed with both; how much shorter the toxic dictionary
makes it is evidence that ordinary text does not explain. A document's shares of windows beyond several gains
are calibrated to a probability on labelled rows that trained no dictionary.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard as zstd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import pieces, stored

#: Words in a window; bytes of the base dictionary and of the end that differs, at most; compression level.
WINDOW_WORDS, BASE_BYTES, SIDE_BYTES, LEVEL = 8, 110_000, 4096, 3
#: A distinctive word is in this share of toxic rows, in three of them, and so many times rarer in ordinary rows.
SHARE, LIFT = 0.01, 10.0
#: Labelled rows that the classifier is fitted on, at most, about: ordinary and toxic ones, by hash of doc_id. Two thirds
#: of them train (at most TRAIN_ROWS of the ordinary ones the base dictionary), one third calibrates.
SAMPLE_ROWS, TRAIN_ROWS = (18_000, 9_000), 3000
GAINS = (2, 3, 4, 5, 6)
WIDTH = len(GAINS) + 4
#: The commonest words of ordinary rows are in the base anyway; the ordinary end starts after so many.
COMMON_WORDS = 200
WORD = re.compile(r"[^\W_]+").findall


def words_of(text: str | None) -> list[str]:
    return WORD(text.lower()) if text else []


def windows_of(words: list[str]) -> list[bytes]:
    return [(" " + " ".join(words[i : i + WINDOW_WORDS]) + " ").encode("utf-8", "replace") for i in range(0, len(words), WINDOW_WORDS)]


def _dictionary(samples: list[bytes]) -> bytes:
    """Content of a trained dictionary; as much sample text as fits where there is too little to train on."""
    try:
        return zstd.train_dictionary(min(BASE_BYTES, max(256, sum(map(len, samples)) // 4)), samples, k=64, d=8).as_bytes()
    except (zstd.ZstdError, ValueError):
        return b"".join(samples)[-BASE_BYTES:]


def _end(words: list[str], size: int) -> bytes:
    """The first words that fit, the first of them last: nearest to what is compressed."""
    chosen, used = [], 1
    for word in words:
        used += len(word.encode()) + 1
        if used > size:
            break
        chosen.append(word)
    return (" " + " ".join(reversed(chosen)) + " ").encode()


@dataclass
class Distance:
    """The compressors of both sides, and the calibration."""

    toxic: bytes
    ordinary: bytes
    weights: np.ndarray = field(default_factory=lambda: np.zeros(WIDTH + 1))
    centre: np.ndarray = field(default_factory=lambda: np.zeros(WIDTH))
    scale: np.ndarray = field(default_factory=lambda: np.ones(WIDTH))

    def compressors(self) -> tuple:
        raw = lambda b: zstd.ZstdCompressor(dict_data=zstd.ZstdCompressionDict(b, dict_type=zstd.DICT_TYPE_RAWCONTENT), level=LEVEL, write_content_size=False)
        return tuple(raw(side).compress for side in (self.ordinary, self.toxic))

    def features(self, texts: list[str | None], compressors: tuple) -> np.ndarray:
        """Per text: share of windows beyond each gain, mean clipped gain, log number of windows, largest gain, and how many are large."""
        ordinary, toxic = compressors
        out = np.zeros((len(texts), WIDTH))
        for i, text in enumerate(texts):
            windows = windows_of(words_of(text))
            if windows:
                gain = np.array([len(ordinary(w)) - len(toxic(w)) for w in windows])
                out[i] = [*((gain >= g).mean() for g in GAINS), np.clip(gain, -4, 8).mean(), np.log(len(windows)), gain.max(), (gain >= 4).sum() / (2 + (gain >= 4).sum())]
        return out

    def probability(self, features: np.ndarray) -> np.ndarray:
        x = (features - self.centre) / self.scale
        return 1.0 / (1.0 + np.exp(-np.clip(self.weights[0] + x @ self.weights[1:], -30, 30)))

    def calibrate(self, features: np.ndarray, toxic: np.ndarray, weight: np.ndarray | float = 1.0) -> None:
        """Logistic regression with a small ridge, by Newton steps; ``weight`` undoes unequal sampling of the classes."""
        self.centre, self.scale = features.mean(axis=0), np.maximum(features.std(axis=0), 1e-9)
        x = np.column_stack([np.ones(len(features)), (features - self.centre) / self.scale])
        self.weights = np.zeros(x.shape[1])
        for _ in range(50):
            p = 1.0 / (1.0 + np.exp(-np.clip(x @ self.weights, -30, 30)))
            ridge = np.diag([1e-6] + [1.0] * (x.shape[1] - 1))
            step = np.linalg.solve(x.T @ (x * (weight * p * (1 - p))[:, None]) + ridge, x.T @ (weight * (toxic - p)) - ridge @ self.weights)
            self.weights += step
            if abs(step).max() < 1e-8:
                break


def _sample(rows: DataFrame, salt: str, bound: int, count: int) -> DataFrame:
    return rows.where(F.pmod(F.xxhash64(F.lit(salt), "key"), F.lit(max(1, count))) < bound)


def train(docs: DataFrame, labels: DataFrame, learn: Column) -> Distance:
    """Dictionaries from two thirds of the sampled labelled rows where ``learn`` holds, calibration from the last third.

    Sampling looks at ids and labels only; the texts of the sample are then picked out of the scan. Rows with equal
    texts count once. With no toxic or no ordinary row every score is 0.
    """
    known = labels.where(F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    ids = stored(docs.where(learn).select("doc_id").join(known, "doc_id").distinct(), "labelled-ids")
    whole = {r["toxic"]: r["n"] for r in ids.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    total = F.when(F.col("toxic") == 1, whole.get(1, 1)).otherwise(whole.get(0, 1))
    bound = F.when(F.col("toxic") == 1, SAMPLE_ROWS[1]).otherwise(SAMPLE_ROWS[0])
    picked = F.broadcast(ids.where(F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), total) < bound))  # bounded by SAMPLE_ROWS
    rows = docs.where(learn).select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).join(picked, "doc_id")
    rows = stored(rows.groupBy("text").agg(F.max("toxic").alias("toxic")).withColumn("key", F.xxhash64("text")), "labelled")
    role = F.pmod(F.xxhash64(F.lit("role"), "key"), F.lit(3))
    fitting, checking = rows.where(role < 2), rows.where(role == 2)
    sizes = {(r["part"], r["toxic"]): r["n"] for r in rows.groupBy((role == 2).alias("part"), "toxic").agg(F.count("*").alias("n")).collect()}
    n_toxic, n_ordinary = sizes.get((False, 1), 0), sizes.get((False, 0), 0)
    if not (n_toxic and n_ordinary and sizes.get((True, 1), 0) and sizes.get((True, 0), 0)):
        distance = Distance(b"", b"")
        distance.weights[0] = -30.0
        return distance

    def distinct_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", 1 << 20):
            bags = [list(set(words_of(t))) for t in batch.column("text").to_pylist()]
            flat = [w for bag in bags for w in bag]
            kinds = np.repeat(batch.column("toxic").to_numpy(), [len(b) for b in bags])
            yield pa.RecordBatch.from_arrays([pa.array(flat, pa.string()), pa.array(kinds)], ["word", "toxic"])

    counted = fitting.select("text", "toxic").mapInArrow(distinct_words, "word string, toxic int").groupBy("word").agg(F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good"))
    enough = max(3, int(np.ceil(SHARE * n_toxic)))
    telling = [r["word"] for r in counted.where((F.col("bad") >= enough) & (F.col("bad") / n_toxic >= LIFT * F.col("good") / n_ordinary)).orderBy(F.desc("bad"), "word").limit(SIDE_BYTES).collect()]
    usual = [r["word"] for r in counted.orderBy(F.desc("good"), "word").limit(COMMON_WORDS + SIDE_BYTES).collect()][COMMON_WORDS:]
    toxic = _end(telling, SIDE_BYTES)
    sample = _sample(fitting.where("toxic = 0"), "ordinary", TRAIN_ROWS, n_ordinary).select("text").collect()
    base = _dictionary([w for r in sample for w in windows_of(words_of(r["text"]))])
    distance = Distance(base + toxic, base + _end(usual, len(toxic)))
    shared = docs.sparkSession.sparkContext.broadcast(distance)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressors = shared.value.compressors()
        for batch in pieces(batches, "text", 1 << 20):
            found = shared.value.features(batch.column("text").to_pylist(), compressors)
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), *map(pa.array, found.T)], ["toxic", *(f"f{i}" for i in range(WIDTH))])

    kind = "toxic int, " + ", ".join(f"f{i} double" for i in range(WIDTH))
    seen = checking.select("text", "toxic").mapInArrow(measure, kind).toPandas()
    toxic = seen["toxic"].to_numpy()
    weight = max(1.0, whole[0] / SAMPLE_ROWS[0]) / max(1.0, whole[1] / SAMPLE_ROWS[1])
    distance.calibrate(seen.drop(columns="toxic").to_numpy(), toxic, np.where(toxic == 1, 1.0, weight))
    return distance


def score_toxicity(docs: DataFrame, labels: DataFrame, learn: Column | None = None) -> DataFrame:
    """doc_id and score (0 to 1) of every row of ``docs``, from its text alone.

    Learns from the rows of ``docs`` where ``learn`` holds (all by default) that ``labels`` (doc_id, toxic 0/1)
    marks; other labels are ignored and of several for a doc_id the largest counts. Null, empty and wordless texts
    get the score of a document without windows. Repeated rows get a row each.
    """
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels, F.lit(True) if learn is None else learn))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressors = shared.value.compressors()
        for batch in pieces(batches, "text", 1 << 20):
            found = shared.value.probability(shared.value.features(batch.column("text").to_pylist(), compressors))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found)], ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(score, "doc_id long, score double")
