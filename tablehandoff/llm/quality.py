"""Documents judged by lines that many documents of their host share.

Lines are normalised (small letters, single blanks), hashed and counted once for each document
of a host; lines in more documents than the limit are removed, and a document that loses too
many words is rejected. Lines are exploded, texts are never shuffled; the counts combine before
the shuffle, and the join with the frequent lines splits a hot line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablehandoff.llm.expressions import SPACES, let, words
from tablehandoff.llm.frames import numbered, stored

SYMBOLS = "#*$%&|<>"
# A line in more documents of one host than this is removed.
LINE_DOCUMENTS = 30
# A document that keeps a smaller part of its words than this is rejected.
LEAST_KEPT = 0.5


def repeat_words(found: Column) -> Column:
    """Words inside three-word windows that occur at least twice among ``found``."""
    n = F.size(found)
    windows = F.transform(
        F.sequence(F.lit(0), n - 3),
        lambda i: F.struct(F.xxhash64(F.get(found, i), F.get(found, i + 1), F.get(found, i + 2)).alias("h"), i.alias("at")),
    )

    def places(s: Column) -> Column:
        # Neighbours in order of hash are equal windows.
        twice = F.filter(
            s, lambda x, i: (F.get(s, i - 1)["h"] == x["h"]) | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False))
        )
        return F.array_sort(F.transform(twice, lambda x: x["at"]))

    def covered(p: Column) -> Column:
        steps = F.transform(p, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(p, i + 1) - x, F.lit(3))))
        return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

    whole = let(F.sort_array(windows), lambda s: let(places(s), covered))
    return F.when(n >= 4, whole).otherwise(0).cast("long")


def _has_word(line: Column) -> Column:
    return F.translate(line, SPACES, "") != ""


def measures(text: Column) -> Column:
    """A struct of n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words."""
    lines = F.filter(F.split(text, "\n"), _has_word)
    counted = let(words(text), lambda w: F.struct(F.size(w).cast("long").alias("n"), repeat_words(w).alias("r")))
    return F.struct(
        counted.alias("w"),
        F.length(F.translate(text, SPACES, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")).alias("n_dup_lines"),
    )


def _lines(docs: DataFrame) -> DataFrame:
    """``row``, ``key`` (host and normalised line) and ``n`` (words), one row for each line with a word."""
    line = F.explode(F.filter(F.split("text", "\n"), _has_word))
    return docs.select("row", "host", line.alias("line")).select(
        "row", F.array_join(words("line"), " ").alias("normal"), "host"
    ).select(
        "row", F.xxhash64(F.coalesce("host", F.lit("")), F.lower("normal")).alias("key"),
        (F.length("normal") - F.length(F.translate("normal", " ", "")) + 1).cast("long").alias("n"),
    )


def frequent_lines(docs: DataFrame, limit: int) -> DataFrame:
    """``key`` of the lines that more than ``limit`` documents of a host have."""
    keys = F.array_distinct(
        F.transform(
            F.filter(F.split("text", "\n"), _has_word),
            lambda x: F.xxhash64(F.coalesce(F.col("host"), F.lit("")), F.lower(F.array_join(words(x), " "))),
        )
    )
    return docs.select(F.explode(keys).alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > limit).select("key")


def judge(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source",
    limit: int = LINE_DOCUMENTS, least_kept: float = LEAST_KEPT,
) -> DataFrame:
    """``doc_id``, ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``,
    ``base_failed``, ``kept``, ``n_line_words`` (words in removed lines).

    ``base_failed``: fewer than 50 words, or more than half of them in repeated windows. ``kept``:
    not failed, and the lines removed leave at least ``least_kept`` of the words. A null text
    counts as empty and fails. Rows that share a null host share a host. A row repeated counts
    as often as it is there. An empty table gives an empty result. Other columns are not read.
    """
    rows = numbered(docs, text, [c for c in dict.fromkeys((doc_id, host)) if c != text]).select(
        "row", F.col("rest").getField(doc_id).alias("doc_id"),
        F.col("rest").getField(host).cast("string").alias("host"), F.coalesce("text", F.lit("")).alias("text"),
    )
    frequent = stored(frequent_lines(rows, limit), "frequent-lines")
    removed = stored(
        _lines(rows).join(frequent, "key", "left_semi").groupBy("row").agg(F.sum("n").alias("n_line_words")), "line-words"
    )
    base = rows.select("row", "doc_id", measures(F.col("text")).alias("m")).select(
        "row", "doc_id", F.col("m.w.n").alias("n_words"), "m.word_chars", "m.n_symbols", "m.n_dup_lines",
        F.col("m.w.r").alias("n_repeat_words"),
    )
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    line_words = F.coalesce("n_line_words", F.lit(0))
    return base.join(removed, "row", "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
        (~failed & (F.col("n_words") - line_words >= least_kept * F.col("n_words"))).alias("kept"),
        line_words.cast("long").alias("n_line_words"),
    )


def without_frequent_lines(docs: DataFrame, text: str = "text", host: str = "source", limit: int = LINE_DOCUMENTS) -> DataFrame:
    """``docs`` with the frequent lines taken out of the texts (null stays null)."""
    rows = numbered(docs, text)
    slim = rows.select("row", F.coalesce("text", F.lit("")).alias("text"), F.col("rest").getField(host).cast("string").alias("host"))
    frequent = stored(frequent_lines(slim, limit), "frequent-lines")
    gone = _lines(slim).join(frequent, "key", "left_semi").groupBy("row").agg(F.collect_set("key").alias("gone"))
    joined = rows.join(gone, "row", "left").withColumn("gone", F.coalesce("gone", F.array().cast("array<bigint>")))
    key = lambda x: F.xxhash64(
        F.coalesce(F.col("rest").getField(host).cast("string"), F.lit("")), F.lower(F.array_join(words(x), " "))
    )
    left = F.filter(F.split("text", "\n"), lambda x: ~_has_word(x) | ~F.array_contains("gone", key(x)))
    kept = F.array_join(left, "\n").alias(text)
    return joined.select(*[kept if c == text else F.col("rest").getField(c).alias(c) for c in docs.columns])


