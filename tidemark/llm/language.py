"""Language identification by one interpolated Kneser-Ney character model per language.

Models see letters only, word by word: n-grams of up to ``ORDER`` characters from the word's start to its end.
Counts cover every training row. Tasks count n-grams over their distinct words, Spark adds the counts up, and
the driver turns the whole tables into probabilities: sorted arrays of n-gram hashes beside one row of log
probabilities per language, and the same for the back-off weights of contexts. No n-gram is left out, so models
grow with the number of distinct ones. The language with the lowest
cross-entropy per character wins; a document whose cross-entropy even then lies beyond what the language's own
training rows show is rejected.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import mix64, pieces, quoted, raw_bytes, stored
from tidemark.operators.ordering import exact_quantiles

ORDER = 4
#: Rejection needs this much more cross-entropy (nats) than usual, and beyond that more than all but this share of
#: a language's training rows. Meant for text in none of the languages, not for unusual documents in one.
MARGIN, CALIBRATION_SHARE = 0.7, 0.999
#: Characters after which more text makes neither score nor rejection stricter.
SURE = 60
BATCH_BYTES = 1 << 20
BEGIN, END = 0x20, 0x0A
_FACTORS = [np.uint64(f) for f in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD)]
ROOT = np.uint64(1)


@lru_cache(maxsize=1)
def _letters() -> tuple[np.ndarray, np.ndarray]:
    """For every code point: whether it is a letter, and its lower case where that is one character."""
    is_letter, lower = np.zeros(sys.maxunicode + 1, bool), np.arange(sys.maxunicode + 1, dtype=np.uint32)
    for i in range(sys.maxunicode + 1):  # no list of all characters: every worker would hold it, if only for a moment
        point = chr(i)
        is_letter[i] = point.isalpha()
        low = point.lower()
        if low != point and len(low) == 1:
            lower[i] = ord(low)
    return is_letter, lower


@dataclass(frozen=True)
class WordBag:
    """The words of some texts: distinct ones as code points between BEGIN and END, and which word occurs where."""

    points: np.ndarray
    starts: np.ndarray  # of each distinct word in points, and the end
    codes: np.ndarray  # distinct word of each occurrence
    texts: np.ndarray  # text of each occurrence

    @staticmethod
    def of(array: pa.Array) -> WordBag:
        data, offsets = raw_bytes(array)
        points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
        heads = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        offsets = heads[offsets]
        is_letter, lower = _letters()
        inside = is_letter[points]
        begin = inside.copy()
        begin[1:] &= ~inside[:-1]
        texts = offsets[:-1][offsets[:-1] < len(points)]
        begin[texts] = inside[texts]
        starts = np.flatnonzero(begin)
        if not len(starts):
            return WordBag(np.empty(0, np.uint32), np.zeros(1, np.int64), np.empty(0, np.int64), np.empty(0, np.int64))
        letters = lower[points[inside]]
        first = np.flatnonzero(begin[inside])
        lengths = np.diff(first, append=len(letters))
        place = np.arange(len(letters)) - np.repeat(first, lengths)
        powers = np.cumprod(np.full(int(lengths.max()), _FACTORS[0]))
        hashes = mix64(np.add.reduceat((letters.astype(np.uint64) + np.uint64(1)) * powers[place], first))
        _, sample, codes = np.unique(hashes, return_index=True, return_inverse=True)
        sizes = lengths[sample]
        ends = np.cumsum(sizes + 2)
        flat = np.full(int(ends[-1]), BEGIN, np.uint32)
        flat[ends - 1] = END
        step = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        flat[np.repeat(ends - sizes - 1, sizes) + step] = letters[np.repeat(first[sample], sizes) + step]
        return WordBag(flat, np.concatenate([[0], ends]), codes, np.searchsorted(offsets, starts, "right") - 1)

    def grams(self) -> tuple[np.ndarray, list[np.ndarray]]:
        """Distance of every code point from its word's start, and the hashes of the n-grams that end at each (n = 0 first)."""
        place = np.arange(len(self.points)) - np.repeat(self.starts[:-1], np.diff(self.starts))
        values, total, hashes = self.points.astype(np.uint64) + np.uint64(1), np.zeros(len(self.points), np.uint64), []
        for n in range(ORDER + 1):
            hashes.append(np.full(len(total), ROOT) if n == 0 else mix64(total + np.uint64(n)))
            if n < ORDER:
                shifted = np.zeros_like(values)
                shifted[n:] = values[: len(values) - n]
                total = total + shifted * _FACTORS[n]
        return place, hashes


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of n-gram counts: (lang, n, gram, context, suffix, opens, count)."""
    held: list[pd.DataFrame] = []

    def compact() -> pd.DataFrame:
        whole = pd.concat(held)
        return whole.groupby(["lang", "n", "gram", "context", "suffix", "opens"], as_index=False)["count"].sum()

    for batch in pieces(batches, "text", BATCH_BYTES):
        langs = batch.column("lang").dictionary_encode()
        of_text = langs.indices.to_numpy()
        bag = WordBag.of(batch.column("text"))
        if not len(bag.codes):
            continue
        place, hashes = bag.grams()
        word = np.repeat(np.arange(len(bag.starts) - 1), np.diff(bag.starts))
        for code, lang in enumerate(langs.dictionary.to_pylist()):
            times = np.bincount(bag.codes[of_text[bag.texts] == code], minlength=len(bag.starts) - 1)
            weight = times[word]
            for n in range(1, ORDER + 1):
                at = np.flatnonzero((weight > 0) & (place >= max(1, n - 1)))
                grams, sample, where = np.unique(hashes[n][at], return_index=True, return_inverse=True)
                first = at[sample]
                held.append(pd.DataFrame({"lang": lang, "n": n, "gram": grams, "context": hashes[n - 1][first - 1], "suffix": hashes[n - 1][first], "opens": place[first] == n - 1, "count": np.bincount(where, weights=weight[at]).astype(np.int64)}))
        if sum(map(len, held)) > 1 << 18:
            held = [compact()]
    if held:
        out = compact()
        for name in ("gram", "context", "suffix"):
            out[name] = out[name].to_numpy().view(np.int64)
        yield pa.RecordBatch.from_pandas(out.astype({"n": "int32"}), preserve_index=False)


@dataclass(frozen=True)
class CharModels:
    languages: list[str]
    grams: np.ndarray  # sorted hashes of n-grams of every order
    log_p: np.ndarray  # a row per n-gram, a column per language
    contexts: np.ndarray  # sorted hashes of contexts
    log_rest: np.ndarray  # weight that a context leaves to the next shorter one
    log_unseen: np.ndarray  # a character that no model has seen

    @staticmethod
    def fit(counts: pd.DataFrame) -> CharModels:
        """From summed counts (lang, n, gram, context, suffix, opens, count)."""
        codes, names = pd.factorize(counts["lang"], sort=True)
        hashes = (counts[c].to_numpy(np.int64).view(np.uint64) for c in ("gram", "context", "suffix"))
        return CharModels.fit_columns(list(names), codes, counts["n"].to_numpy(), *hashes, counts["opens"].to_numpy(bool), counts["count"].to_numpy(np.int64))

    @staticmethod
    def fit_columns(languages: list[str], lang: np.ndarray, order: np.ndarray, gram: np.ndarray, context: np.ndarray, suffix: np.ndarray, opens: np.ndarray, count: np.ndarray) -> CharModels:
        """From summed counts as plain columns, ``lang`` as the place in ``languages``: the driver holds little beside them."""
        shorter, below = np.array([ROOT]), np.full((1, len(languages)), 1.0 / max(2, len(np.unique(gram[order == 1])) + 1))
        unseen = below[0]
        grams, log_p, contexts, log_rest = [], [], [], []
        for n in range(1, ORDER + 1):
            own = np.flatnonzero(order == n)
            own = own[np.isin(suffix[own], shorter)]
            if not len(own):
                break
            index, sample = np.unique(gram[own], return_index=True)
            above, links = np.unique(context[own], return_inverse=True)
            rest, seen = np.ones((len(above), len(languages))), np.zeros((len(index), len(languages)))
            for i in range(len(languages)):
                mine = lang[own] == i
                part = own[mine]
                if not len(part):
                    continue
                value = count[part].astype(float)
                if n < ORDER:  # how many different characters precede it; a word's start has none
                    followed, times = np.unique(suffix[(order == n + 1) & (lang == i)], return_counts=True)
                    before = np.zeros(len(part), np.int64)
                    if len(followed):
                        at = np.minimum(np.searchsorted(followed, gram[part]), len(followed) - 1)
                        before = np.where(followed[at] == gram[part], times[at], 0)
                    value = np.where(opens[part], value, np.maximum(before, 1))
                where = links[mine]
                ones, twos = (value == 1).sum(), (value == 2).sum()
                discount = ones / (ones + 2 * twos) if ones and twos else 0.75
                total = np.bincount(where, value, len(above))
                kinds = np.bincount(where, minlength=len(above))
                known = total > 0
                rest[known, i] = discount * kinds[known] / total[known]
                seen[np.searchsorted(index, gram[part]), i] = (value - discount) / total[where]
            if n == 1:
                unseen = rest[0] * unseen
            lower = below[np.searchsorted(shorter, suffix[own][sample])]
            below = seen + rest[links[sample]] * lower
            shorter = index
            grams, log_p, contexts, log_rest = [*grams, index], [*log_p, np.log(below)], [*contexts, above], [*log_rest, np.log(rest)]
        if not grams:
            return CharModels([], *[np.empty(0)] * 5)
        by_gram, by_context = np.concatenate(grams).argsort(), np.concatenate(contexts).argsort()
        return CharModels(languages, np.concatenate(grams)[by_gram], np.concatenate(log_p)[by_gram].astype(np.float32), np.concatenate(contexts)[by_context], np.concatenate(log_rest)[by_context].astype(np.float32), np.log(unseen))

    def word_scores(self, bag: WordBag) -> tuple[np.ndarray, np.ndarray]:
        """Log probability of each distinct word by language, and its number of predicted characters."""
        place, hashes = bag.grams()
        scores = np.zeros((len(place), len(self.languages)), np.float32)
        open_ = np.flatnonzero(place > 0)
        for n in range(ORDER, 0, -1):
            here = open_[place[open_] >= n - 1]
            later = open_[place[open_] < n - 1]
            at = np.minimum(np.searchsorted(self.grams, hashes[n][here]), len(self.grams) - 1)
            hit = self.grams[at] == hashes[n][here]
            scores[here[hit]] += self.log_p[at[hit]]
            missed = here[~hit]
            above = np.minimum(np.searchsorted(self.contexts, hashes[n - 1][missed - 1]), len(self.contexts) - 1)
            known = self.contexts[above] == hashes[n - 1][missed - 1]
            if n > 1:
                scores[missed[known]] += self.log_rest[above[known]]
            else:
                scores[missed] += self.log_unseen
            open_ = np.sort(np.concatenate([missed, later])) if len(later) else missed
        return np.add.reduceat(scores, bag.starts[:-1], axis=0), np.diff(bag.starts) - 1

    def text_scores(self, array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy per character (nats) of each text by language, and its number of characters (0: no letter)."""
        bag, n, width = WordBag.of(array), len(array), len(self.languages)
        if not len(bag.codes) or not width:
            return np.zeros((n, width)), np.zeros(n, np.int64) if width else np.bincount(bag.texts, minlength=n)
        words, sizes = self.word_scores(bag)
        total = np.stack([np.bincount(bag.texts, words[bag.codes, i], n) for i in range(width)], axis=1)
        length = np.bincount(bag.texts, sizes[bag.codes], n).astype(np.int64)
        return -total / np.maximum(length, 1)[:, None], length


def held_out(modulus: int, part: int, id_column: str = "doc_id") -> Column:
    """Whether crc32 of the id as text leaves this remainder; rows without id are not held out."""
    rest = F.pmod(F.crc32(F.encode(F.col(id_column).cast("string"), "UTF-8")), F.lit(modulus))
    return F.coalesce(rest == part, F.lit(False))


@dataclass(frozen=True)
class Identifier:
    models: CharModels
    usual: np.ndarray  # mean cross-entropy of a language's own rows
    excess: np.ndarray  # what lies beyond it at most, times the root of the counted length

    def judge(self, array: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Language, score, cross-entropy and rejection of each text."""
        entropy, length = self.models.text_scores(array)
        names = np.array([*self.models.languages, "und"], object)
        if not self.models.languages:
            return ["und"] * len(array), np.zeros(len(array)), np.zeros(len(array)), np.ones(len(array), bool)
        best = entropy.argmin(axis=1)
        lowest = entropy[np.arange(len(best)), best]
        counted = np.minimum(length, SURE)
        odds = np.exp(-(entropy - lowest[:, None]) * counted[:, None]).sum(axis=1)
        none = length == 0
        rejected = none | ((lowest - self.usual[best] - MARGIN) * np.sqrt(counted) > self.excess[best])
        return names[np.where(none, -1, best)].tolist(), np.where(none, 0.0, 1.0 / odds), np.where(none, 0.0, lowest), rejected


def _gathered(summed: DataFrame) -> CharModels:
    """Models from the whole table of counts. Its columns come as Arrow buffers and languages as numbers: 38 bytes a row on
    the driver instead of an object for each value."""
    languages = sorted(r["lang"] for r in summed.select("lang").distinct().collect())
    code = F.array_position(F.array(*map(F.lit, languages)), F.col("lang")) - 1 if languages else F.lit(0)
    plain = summed.select(code.cast("smallint").alias("lang"), F.col("n").cast("tinyint").alias("n"), "gram", "context", "suffix", "opens", "count").toArrow()
    hashes = (plain.column(c).to_numpy().view(np.uint64) for c in ("gram", "context", "suffix"))
    return CharModels.fit_columns(languages, plain.column("lang").to_numpy(), plain.column("n").to_numpy(), *hashes, plain.column("opens").to_numpy(), plain.column("count").to_numpy())


def train(docs: DataFrame, learn: Column) -> Identifier:
    """Models and rejection bounds from the rows where ``learn`` holds and lang is not null."""
    text = F.col("text").cast("string").alias("text")
    rows = docs.where(learn & F.col("lang").isNotNull()).select(F.col("lang").cast("string").alias("lang"), text, F.col("doc_id"))
    kind = "lang string, n int, gram long, context long, suffix long, opens boolean, count long"
    grams = rows.select("lang", "text").mapInArrow(_count_batches, kind)
    summed = stored(grams.groupBy("lang", "n", "gram").agg(F.first("context").alias("context"), F.first("suffix").alias("suffix"), F.first("opens").alias("opens"), F.sum("count").alias("count")), "grams")
    models = _gathered(summed)
    column = {lang: i for i, lang in enumerate(models.languages)}
    shared = docs.sparkSession.sparkContext.broadcast(models)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", BATCH_BYTES):
            entropy, length = shared.value.text_scores(batch.column("text"))
            own = np.array([column.get(lang, -1) for lang in batch.column("lang").to_pylist()])
            right = (own >= 0) & (length > 0)
            right &= entropy.argmin(axis=1) == own if len(column) else right
            values = entropy[np.flatnonzero(right), own[right]]
            yield pa.RecordBatch.from_arrays([pa.array(own[right].astype(np.int32)), pa.array(values), pa.array(length[right])], ["own", "entropy", "length"])

    seen = stored(rows.select("lang", "text").mapInArrow(score, "own int, entropy double, length long"), "scored")
    usual, excess = np.zeros(len(column)), np.full(len(column), np.inf)
    means = seen.groupBy("own").agg(F.avg("entropy").alias("mean")).toPandas()
    if len(means):
        usual[means["own"]] = means["mean"]
        mean = F.get(F.array(*map(F.lit, usual.tolist())), F.col("own"))
        beyond = (F.col("entropy") - mean) * F.sqrt(F.least("length", F.lit(SURE)))
        tails = exact_quantiles(seen.select("own", beyond.alias("beyond")), ["beyond"], [CALIBRATION_SHARE], ["own"]).toPandas()
        excess[tails["own"]] = np.maximum(1.0, tails["value"])
    return Identifier(models, usual, excess)


def identify(docs: DataFrame, learn: Column | None = None, keep: bool = False, prefix: str = "") -> DataFrame:
    """doc_id, lang_pred, score (0 to 1), entropy and rejected of every row; ``keep`` adds the columns of ``docs``.

    ``prefix`` goes before the new names; input columns that still have such a name are replaced.

    Learns from ``text`` and ``lang`` of the rows where ``learn`` holds (all by default) and scores whole texts by
    themselves. A null text or one without letters is ``und``, score 0, rejected; so is everything when nothing can
    be learnt. Repeated rows get a row each.
    """
    added = {f"{prefix}lang_pred": "string", f"{prefix}score": "double", f"{prefix}entropy": "double", f"{prefix}rejected": "boolean"}
    names = [n for n in docs.columns if n.lower() not in added] if keep else ["doc_id", "text"]
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, F.lit(True) if learn is None else learn))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", BATCH_BYTES):
            found = shared.value.judge(batch.column("text"))
            rest = [c for c in batch.schema.names if keep or c != "text"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), *map(pa.array, found)], [*rest, *added])

    # the names of other columns may be any: only plain ones go to Python
    plain = {n: n if n in ("doc_id", "text") else f"_{i}" for i, n in enumerate(names)}
    rows = docs.select(*(F.col(quoted(n)).cast("string").alias(n) if n == "text" else F.col(quoted(n)).alias(plain[n]) for n in names))
    kinds = [(f.name, f.dataType.simpleString()) for f in rows.schema.fields if keep or f.name != "text"]
    found = rows.mapInArrow(judge, ", ".join(f"{n} {k}" for n, k in [*kinds, *added.items()]))
    return found.toDF(*(n for n in names if keep or n != "text"), *added)
