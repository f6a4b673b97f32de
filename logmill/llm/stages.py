"""Stages of the corpus pipeline. Each takes (spark, docs, sf_dir) and works on all rows of docs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logmill.functions.scratch import discard
from logmill.llm import jaccard, language, lines, packing, passages
from logmill.llm.common import any_without_id, in_few_files, key_of, materialize, table

#: Bytes that a repeated passage must have: a passage of over 50 words has as many if its words
#: have four letters on average. The grams leave as much room as those of ``passages``.
PASSAGE, PASSAGE_GRAM = 240, 96
#: Contexts of one such gram that one task compares (some 110 MB); more go through a shuffle.
PASSAGE_MANY = 1 << 15

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def run(spark: SparkSession, sf_dir: str, stages: list[tuple[str, Stage]]) -> DataFrame:
    """The stages one after the other on ``documents``, each on what the one before wrote."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in stages[:-1]:
        before, (docs, _) = docs, materialize(stage(spark, docs, sf_dir), name)
        discard(before)
    return stages[-1][1](spark, docs, sf_dir)


def _row(docs: DataFrame) -> Column:
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns])


def _with_text(docs: DataFrame, found: DataFrame, text: Column) -> DataFrame:
    """The rows in ``carry`` with a new text and its length."""
    new = {"text": text, "n_chars": F.char_length(text).cast("long")}
    return in_few_files(
        found.select(*[new[c].alias(c) if c in new else F.col(f"carry.`{c}`").alias(c) for c in docs.columns])
    )


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told, with it as ``lang``; others go (no text, or no letter)."""
    model = language.train(docs)
    rows = docs.select(_row(docs).alias("row"), "text")
    found = language.predict(rows, model, "row", "text").filter(F.col("lang_pred") != language.UNKNOWN)
    return found.select(*[F.col("lang_pred" if c == "lang" else f"doc.`{c}`").alias(c) for c in docs.columns])


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that others repeat. One that keeps no word goes."""
    index = lines.LineIndex(spark).insert_in_batches(docs, lines.BATCHES)
    found = index.apply(docs, carry=_row(docs)).filter(F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    return _with_text(docs, found, F.col("text"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that of the smallest id. Documents without
    an id come after all others; of those of one text, not blank, any one stays."""
    if any_without_id(docs):
        keyed = docs.select(key_of().alias("key"), _row(docs).alias("doc"), "text")
        found = jaccard.near_duplicates(keyed.select("key", "text"), "key").filter("component < doc")
        left = keyed.join(found.select(F.col("doc").alias("key")).distinct(), "key", "left_anti")
        alike = F.col("key.none") & F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
        left = left.filter(~alike).union(left.filter(alike).dropDuplicates(["key"]))
        return in_few_files(left.select(*[F.col(f"doc.`{c}`").alias(c) for c in docs.columns]))
    found = jaccard.near_duplicates(docs).filter("component < doc").select(F.col("doc").alias("doc_id")).distinct()
    return in_few_files(docs.join(found, "doc_id", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns]))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of ``PASSAGE`` bytes or more that occur again, here or elsewhere.
    What a removal leaves of a character goes as well; a document that keeps no word goes."""
    size = {"length": PASSAGE, "gram": PASSAGE_GRAM, "many": PASSAGE_MANY}
    if any_without_id(docs):
        keyed = docs.select(key_of().alias("key"), "text", _row(docs).alias("row"))
        found = passages.without_repeats(keyed, "key", carry=F.col("row"), as_text=True, **size)
    else:
        found = passages.without_repeats(docs, carry=_row(docs), as_text=True, **size)
    return _with_text(docs, found.filter(F.col("kept").rlike(r"[^\x20\x09-\x0D]")), F.col("kept"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of training sequences."""
    return packing.digest(packing.pack(docs))
