"""Line deduplication by a log-template tree, in DataFrame expressions only.

As in fixed-depth log parsing, a line descends by its token count and its ``DEPTH`` leading tokens; tokens with
digits are variable from the start. In a leaf, a token stays in the template where it recurs at its position in
``MIN_DOCS`` texts (``LONG_DOCS`` for lines of ``LONG_TOKENS`` or more: so much is not written twice by chance), and
becomes a wildcard elsewhere, so the template of a line does not depend on the order of lines. Templates that keep
enough of their tokens and recur in as many texts are boilerplate: their lines are dropped. Documents with one text
count once, so exact copies are no recurrence. Only lines of leaves that recur at all are looked at token by token, each distinct line once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored

DEPTH = 3
#: Different texts in which a token, and a template, must recur; in long lines, fewer.
MIN_DOCS, LONG_DOCS, LONG_TOKENS = 3, 2, 50
#: Share of a line's tokens that its template must keep; a line that fails is its own template.
KEPT_SHARE = 0.6
WILD = "<*>"


#: Leaves that recur, at most, that are sent to every task (16 MB); more are joined by a shuffle.
SENT_LEAVES = 1 << 20


def _masked(tokens):
    # a token is looked at from its start only
    return F.when(tokens.rlike("[0-9]"), F.regexp_replace(tokens, r"(?<![^ ])[^ 0-9]*+[0-9][^ ]*+", WILD)).otherwise(tokens)


def _tokens(line: str) -> Column:
    return F.length(line) - F.length(F.replace(F.col(line), F.lit(" "), F.lit(""))) + 1


def _needed(tokens: Column, min_docs: int, long_docs: int) -> Column:
    return F.when(tokens >= LONG_TOKENS, min(min_docs, long_docs)).otherwise(min_docs)


def _lines(docs: DataFrame) -> DataFrame:
    """(doc_id, row, line_no, leaf, tokens, line): whitespace-trimmed, with variable tokens masked; blank lines left out.

    ``leaf`` is a 64-bit hash of the token count and the leading tokens.
    """
    text = F.col("text").cast("string")
    lines = docs.select(F.col("doc_id").cast("long"), F.xxhash64(text).alias("row"), F.posexplode(F.split(text, "\n")).alias("line_no", "raw"))
    # of the raw line, so that the replacements are not evaluated for the filter as well
    lines = lines.where(F.btrim("raw", F.lit(" \t\r")) != "")
    # only irregular white space and lines with digits go through the expensive replacements
    odd = F.contains("raw", F.lit("  ")) | F.contains("raw", F.lit("\t")) | F.contains("raw", F.lit("\r"))
    squeezed = F.trim(F.when(odd, F.regexp_replace("raw", r"[ \t\r]+", " ")).otherwise(F.col("raw")))
    lines = lines.select("doc_id", "row", "line_no", squeezed.alias("squeezed")).select("doc_id", "row", "line_no", _masked(F.col("squeezed")).alias("line"))
    lines = lines.withColumn("tokens", _tokens("line"))
    return lines.select("doc_id", "row", "line_no", "line", "tokens", F.xxhash64("tokens", F.substring_index("line", " ", DEPTH)).alias("leaf"))


def recurring_lines(docs: DataFrame, min_docs: int = MIN_DOCS, kept_share: float = KEPT_SHARE, long_docs: int = LONG_DOCS) -> DataFrame:
    """(doc_id, row, line_no, template) of the lines whose template recurs in at least ``min_docs`` different texts, or
    ``long_docs`` where the line is long.

    ``template`` is a hash. Lines are compared by 64-bit hashes within their leaf; rows carry hashes, and every distinct
    line of a leaf that recurs its text once.
    """
    lines = _lines(docs)
    busy = stored(lines.groupBy("leaf").agg(F.count("*").alias("n"), F.min("tokens").alias("tokens")).where(F.col("n") >= _needed(F.col("tokens"), min_docs, long_docs)).select("leaf"), "leaves")
    few = busy.count() <= SENT_LEAVES
    inside = lines.join(F.broadcast(busy) if few else busy, "leaf").withColumn("key", F.xxhash64("line"))
    inside = stored(inside.select("doc_id", "row", "line_no", "leaf", "key", "line"), "leaf-lines")
    # texts by distinct line, and the line itself: all that the tree needs to know of the rows
    holders = inside.select("leaf", "key", "row").distinct().groupBy("leaf", "key").agg(F.count("*").alias("docs"))
    texts = inside.groupBy("leaf", "key").agg(F.min("line").alias("line"))
    distinct = stored(holders.join(texts, ["leaf", "key"]).withColumn("needed", _needed(_tokens("line"), min_docs, long_docs)), "leaf-texts")
    tokens = distinct.select("leaf", "key", "docs", "needed", F.posexplode(F.split("line", " ")).alias("at", "token"))
    frequent = tokens.groupBy("leaf", "at", "token").agg(F.sum("docs").alias("n"), F.min("needed").alias("needed")).where("n >= needed").select("leaf", "at", "token", F.lit(True).alias("frequent"))
    judged = tokens.join(frequent, ["leaf", "at", "token"], "left").withColumn("frequent", F.coalesce("frequent", F.lit(False)))
    word = F.when(F.col("frequent"), F.col("token")).otherwise(F.lit(WILD))
    ordered = F.sort_array(F.collect_list(F.struct("at", word.alias("word"))))
    kept = F.avg(F.when(F.col("frequent") & (F.col("token") != WILD), 1.0).otherwise(0.0))
    templates = judged.groupBy("leaf", "key").agg(F.xxhash64(F.concat_ws(" ", ordered["word"])).alias("general"), kept.alias("kept"), F.min("needed").alias("needed"))
    # a line is its own template under its own hash: that of a general form equal to it
    templates = templates.select("leaf", "key", "needed", F.when(F.col("kept") >= kept_share, F.col("general")).otherwise(F.col("key")).alias("template"))
    placed = stored(inside.join(stored(templates, "templates"), ["leaf", "key"]).select("doc_id", "row", "line_no", "leaf", "needed", "template"), "placed")
    # a text with two lines of a template counts once
    recurring = placed.select("leaf", "needed", "template", "row").distinct().groupBy("leaf", "template").agg(F.count("*").alias("docs"), F.min("needed").alias("needed")).where("docs >= needed")
    recurring = stored(recurring.select("leaf", "template"), "recurring")
    return placed.join(recurring, ["leaf", "template"]).select("doc_id", "row", "line_no", "template")


def without_recurring_lines(docs: DataFrame, min_docs: int = MIN_DOCS, kept_share: float = KEPT_SHARE, long_docs: int = LONG_DOCS) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_lines, n_dropped, text (without the recurring lines).

    Lines end at a line feed. Reads ``doc_id`` and ``text`` only. A null text has no lines and stays null; an empty
    text is one blank line, and blank lines always stay. Rows with equal text count once, whatever their doc_id, and
    each get the result. Near copies are different texts: remove them first where one of them should stay whole. An empty table gives an empty result.
    """
    dropped = recurring_lines(docs, min_docs, kept_share, long_docs).groupBy("doc_id", "row").agg(F.collect_set("line_no").alias("dropped"))
    text = F.col("text").cast("string")
    keyed = docs.select(F.col("doc_id").cast("long"), text.alias("text"), F.xxhash64(text).alias("row"))
    same = keyed["doc_id"].eqNullSafe(dropped["doc_id"]) & (keyed["row"] == dropped["row"])
    joined = keyed.join(dropped, same, "left").select(keyed["doc_id"], "text", F.coalesce("dropped", F.array().cast("array<int>")).alias("dropped"))
    lines = F.split("text", "\n")
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), "dropped")
    whole = F.size("dropped") == 0
    result = F.when(whole, F.col("text")).otherwise(F.concat_ws("\n", F.transform(left, lambda i: F.get(lines, i))))
    n_lines = F.coalesce(F.when(F.col("text").isNotNull(), F.size(lines)), F.lit(0))
    return joined.select("doc_id", n_lines.cast("long").alias("n_lines"), F.size("dropped").cast("long").alias("n_dropped"), result.alias("text"))
