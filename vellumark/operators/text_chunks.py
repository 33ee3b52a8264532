"""Splitting texts into chunks. All but the semantic one are map-only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.feature import RegexTokenizer, StopWordsRemover
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellumark.functions.values import let, stripped
from vellumark.functions.xml import ordered_text
from vellumark.operators.skew import join_unique
from vellumark.operators.topics import topic_model
from vellumark.session import stored

WORDS = 500
SENTENCES = 5
# Where a sentence ends, and what starts a heading.
SENTENCE_END = r"(?U)(?<=[.!?])\s+(?=[A-Z])"
HEADING = r"(?U)(?:^|\n)(?:#+\s|[A-Z][A-Z\s]+:|\d+\.\s)"
_SPACE = r"(?U)\s+"


def words(text: Column) -> Column:
    return F.filter(F.split(text, _SPACE), lambda w: w != "")


def sentences(text: Column) -> Column:
    return F.split(stripped(text), SENTENCE_END)


def _runs(parts: Column, length: int) -> Column:
    """Consecutive runs of an array, each joined by one space."""

    def cut(p: Column) -> Column:
        starts = F.when(F.size(p) > 0, F.sequence(F.lit(1), F.size(p), F.lit(length)))
        return F.transform(starts, lambda i: F.array_join(F.slice(p, i, length), " "))

    return F.coalesce(let(parts, cut), F.array().cast("array<string>"))


def _filled(pieces: Column) -> Column:
    return F.filter(F.transform(pieces, lambda p: stripped(p)), lambda p: p != "")


def fixed(text: Column, length: int = WORDS) -> Column:
    return _runs(words(text), length)


def by_sentence(text: Column, length: int = SENTENCES) -> Column:
    return _runs(sentences(text), length)


def by_heading(text: Column) -> Column:
    return _filled(F.split(text, HEADING))


def hybrid(text: Column, length: int = WORDS) -> Column:
    """Heading pieces; those with more words than `length` are cut by words."""
    return F.flatten(
        F.transform(
            by_heading(text), lambda p: F.when(F.size(words(p)) > length, fixed(p, length)).otherwise(F.array(p))
        )
    )


def by_paragraph(text: Column) -> Column:
    return _filled(F.split(text, "\n\n"))


STRATEGIES: dict[str, Callable[[Column], Column]] = {
    "fixed": fixed,
    "sentence": by_sentence,
    "heading": by_heading,
    "hybrid": hybrid,
    "paragraph": by_paragraph,
}


def chunks(df: DataFrame, strategy: str = "paragraph", key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, chunk_no, text; any strategy without an own rule splits by paragraph."""
    if strategy == "semantic":
        return semantic(df, key, text)
    cut = STRATEGIES.get(strategy, by_paragraph)
    return df.select(key, F.posexplode(cut(F.col(text))).alias("chunk_no", "text"))


def semantic(
    df: DataFrame, key: str = "doc_id", text: str = "text", topics: int = 3, iterations: int = 10, seed: int = 42
) -> DataFrame:
    """Paragraphs of a text grouped by their main topic, in order of first appearance.

    One topic model is fitted to the paragraphs of the whole collection.
    """
    paragraphs = df.select(
        key, F.posexplode(F.filter(F.split(text, "\n\n"), lambda p: stripped(p) != "")).alias("at", "text")
    )
    words_of = RegexTokenizer(inputCol="text", outputCol="all", pattern=r"(?U)\W+", minTokenLength=2)
    kept = StopWordsRemover(inputCol="all", outputCol="words").transform(words_of.transform(paragraphs))
    placed = kept.select(key, "at", "text", "words", F.monotonically_increasing_id().alias("_row"))
    placed = stored(placed, "paragraphs")
    model = topic_model(placed, "words", topics, iterations, seed)
    if model is None:
        scored, topic = paragraphs, F.lit(0)
    else:
        scored, topic = join_unique(placed, model[0], "_row"), F.coalesce("topic", F.lit(0))
    grouped = scored.groupBy(key, topic.alias("topic")).agg(
        F.min("at").alias("first"), ordered_text(F.col("at"), F.col("text"), "\n\n").alias("text")
    )
    per_text = grouped.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("first", "text"))).alias("c"))
    return per_text.select(key, F.posexplode(F.transform("c", lambda c: c["text"])).alias("chunk_no", "text"))
