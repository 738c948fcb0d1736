"""Spelling variants of words by PartEnum signatures.

A word's letters are a set of (letter, occurrence) elements, a binary vector. One inserted or deleted letter changes
one element, a replaced one two: words at edit distance one have vectors at Hamming distance two at most. PartEnum cuts
the dimensions into ``FIRST`` parts, of which one differs in at most ``ceil(3 / FIRST) - 1`` places, and each part
into ``SECOND`` pieces: leaving out any so many pieces of a part and hashing the rest gives a word's signatures, and two
words within the distance share one of them for certain. Signatures are equi-joined and what meets is verified by edit
distance.

A signature that very many words share (letters in other orders, repeated letters) is joined by position too: an edit in
the one half of a word leaves the other half as it is, so such words meet by signature, length and one equal half.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import parallelism, pieces, stored

MIN_LENGTH, MIN_COUNT, RATIO = 6, 5, 5
DISTANCE, FIRST, SECOND = 2, 1, 7
#: Words of a signature at most before they must also share half of their letters in place.
CROWD = 64
BATCH_BYTES = 1 << 22
#: Distinct words that a task holds before it sends their counts on, and texts it reads at once.
HELD_WORDS, PART = 1 << 18, 1 << 22


def corpus_words(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, damage: int | None = None) -> DataFrame:
    """(word, n): words of at least ``min_length`` code points that occur at least ``min_count`` times.

    A word is a maximal run of A-Z, a-z and U+00C0 to U+00FF, of which only A-Z are lower-cased. With ``damage`` a
    run whose CRC-32 (of ``<doc_id>:<run>``) is divisible by it loses one code point, at that number modulo its length:
    a reproducible source of misspellings. Reads ``doc_id`` and ``text`` only; a null text has no words, a null doc_id
    counts as an empty one, repeated rows count each, an empty table has no words.
    """
    letters = "a-zÀ-ÿ"
    run, other = re.compile(f"[{letters}]{{{max(1, min_length)},}}"), re.compile(f"[^{letters}]")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, int] = {}

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])

        for batch in pieces(batches, "text", BATCH_BYTES):
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist()
            for doc, raw in zip(ids, texts):
                text = raw.lower().decode()
                prefix = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                start = 0
                while start < len(text):
                    end = other.search(text, start + PART)
                    stop = end.start() if end else len(text)
                    for word, n in Counter(run.findall(text, start, stop)).items():
                        if damage:
                            h = zlib.crc32(word.encode(), prefix)
                            if h % damage == 0:
                                at = h % len(word)
                                word = word[:at] + word[at + 1 :]
                                if len(word) < min_length:
                                    continue
                        held[word] = held.get(word, 0) + n
                    start = stop
                if len(held) > HELD_WORDS:
                    yield out()
                    held.clear()
        if held:
            yield out()

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).where("text is not null")
    return rows.mapInArrow(counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def _signatures(word: str = "word", first: int = FIRST, second: int = SECOND) -> tuple[Column, Column, Column]:
    """A word's elements (to be named ``__e``), the hashes of their pieces (``__h``), and from these all its signatures."""
    left_out = math.ceil((DISTANCE + 1) / first) - 1
    letters = F.array_sort(F.filter(F.split(F.col(word), ""), lambda c: c != ""))
    # the same letter again is another dimension; sorted, its occurrences follow each other
    elements = F.transform(letters, lambda c, i: F.xxhash64(c, (i - F.array_position(letters, c)).cast("int")))

    def joined(part: Column) -> Column:
        return F.aggregate(F.filter(F.col("__e"), lambda e: F.pmod(e, F.lit(first * second)) == part), F.lit(0).cast("long"), lambda a, e: a.bitwiseXOR(e))

    hashes = F.transform(F.sequence(F.lit(0), F.lit(first * second - 1)), joined)
    keys = []
    for part in range(first):
        own = range(part * second, part * second + second)
        for gone in combinations(own, left_out):
            rest = F.lit(0).cast("long")
            for piece in own:
                if piece not in gone:
                    rest = rest.bitwiseXOR(F.col("__h")[piece])
            keys.append(F.xxhash64(F.lit(part), *map(F.lit, gone), rest))
    return elements, hashes, F.array(*keys)


def _halves(short: Column) -> Column:
    """Of a word with ``short`` letters in the shorter word of a pair: the halves that an edit may leave alone."""
    half = (short / 2).cast("int")
    return F.array(F.struct(F.lit(0).alias("side"), F.substring("word", F.lit(1), half).alias("half")), F.struct(F.lit(1).alias("side"), F.substring("word", F.length("word") - (short - half) + 1, short - half).alias("half")))


def near_words(words: DataFrame) -> DataFrame:
    """(a, a_n, b, b_n), a < b: all pairs of the distinct ``words`` (word, n) that differ by exactly one inserted,
    deleted or replaced code point."""
    elements, hashes, signatures = _signatures()
    # a word's signatures are much more than the word: the work is dealt out by words, not by bytes
    words = words.repartition(parallelism(words.sparkSession), "word")
    signed = words.withColumn("__e", elements).withColumn("__h", hashes).select(F.explode(signatures).alias("sig"), "word", "n")
    signed = stored(signed, "signatures")
    crowded = signed.groupBy("sig").agg(F.count("*").alias("members")).where(F.col("members") > CROWD).select("sig")
    crowded = stored(crowded, "crowded")
    close = (F.abs(F.length("a") - F.length("b")) <= 1) & (F.levenshtein("a", "b", 1) == 1)

    def met(rows: DataFrame, *keys: str) -> DataFrame:
        left = rows.select(*keys, F.col("word").alias("a"), F.col("n").alias("a_n"))
        right = rows.select(*keys, F.col("word").alias("b"), F.col("n").alias("b_n"))
        return left.join(right, [*keys]).where((F.col("a") < F.col("b")) & close).select("a", "a_n", "b", "b_n")

    calm = met(signed.join(crowded, "sig", "left_anti"), "sig")
    busy = signed.join(crowded, "sig", "left_semi")
    # a word is the shorter (or equal) one of a pair, or the longer one by a letter
    sized = busy.withColumn("short", F.explode(F.array(F.length("word"), F.length("word") - 1)))
    placed = sized.withColumn("at", F.explode(_halves(F.col("short")))).select("sig", "short", "at.side", "at.half", "word", "n")
    return calm.union(met(placed, "sig", "short", "side", "half")).distinct()


def _roots(forms: DataFrame, hops: int) -> DataFrame:
    """(word, root): the last form reached from each word with a form, ``hops`` steps away at most, by doubling."""
    reached = forms.select("word", F.col("form").alias("root"))
    for _ in range(max(0, math.ceil(math.log2(max(1, hops))))):
        after = reached.select(F.col("word").alias("root"), F.col("root").alias("further"))
        reached = stored(reached.join(after, "root", "left").select("word", F.coalesce("further", "root").alias("root")), "roots")
    return reached


def spelling_variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """For each of the distinct ``words`` (word, n): word, form, root, n, n_near, form_n.

    ``form`` is the near word (``near_words``) of largest n, ties by code-point order, if its n is at least
    ``ratio`` (two or more) times the word's; else null. ``root`` follows forms to the last. An empty table gives an
    empty result; a null word takes no part.
    """
    if ratio < 2:
        raise ValueError("a ratio below 2 does not bound the length of chains")
    words = stored(words.where("word is not null").select("word", "n"), "words")
    pairs = near_words(words)
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("other"), F.col("b_n").alias("other_n"))
    both = both.union(pairs.select("b", "a", "a_n"))
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best"))
    enough = -F.col("best.less") >= ratio * F.col("n")
    found = words.join(best, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(enough, F.col("best.other")).alias("form"), F.when(enough, -F.col("best.less")).alias("form_n"))
    found = stored(found, "forms")
    most, least = words.agg(F.max("n"), F.min("n")).first()
    # every step multiplies n by the ratio
    hops = int(math.log(max(1, most or 1) / max(1, least or 1), ratio)) + 1
    roots = _roots(found.where("form is not null"), hops)
    return found.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
