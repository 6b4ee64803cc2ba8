"""From raw documents to packed training sequences: five stages, each over all rows that the one before it kept.

A stage takes (spark, docs, sf_dir); its rows are written as Parquet and read again for the next. All but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablehaul.llm.components import stored
from tablehaul.llm.decontaminate import find_leaks, remove_leaks
from tablehaul.llm.jaccard import Similarity, one_of_each_group
from tablehaul.llm.packing import pack_documents
from tablehaul.llm.quality import fit_quality, judge_quality
from tablehaul.llm.queries import table, tokenizer_file
from tablehaul.llm.spans import remove_repeated_spans

#: Near duplicates: five words in a shingle, 80 per cent of them in common.
NEAR = Similarity(size=5, percent=80)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule and the trees keep; the trees learn from ``labels``.

    Each row is judged by its own text, so null and repeated ids make no difference; a null or empty text fails the base
    rule. Very long texts are judged whole. No documents, no rows.
    """
    trees = fit_quality(docs, table(spark, sf_dir, "labels"))
    return judge_quality(docs, trees).where("kept").select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest doc_id, of several rows with that id the one
    whose text has the smallest hash.

    A null doc_id comes after all others. Rows that share a doc_id are in one group only if their texts are near duplicates;
    of repeated rows one stays. Rows without a word are in no group; they all stay. No documents, no rows.
    """
    return one_of_each_group(docs, NEAR)


def repeated_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated sentence spans; those of which nothing is left go. ``n_chars`` follows the text.

    Rows lose only their own repeats, whatever rows share their doc_id; null and empty texts stay as they are.
    """
    out = remove_repeated_spans(docs).where("n_removed = 0 OR n_removed < n_sentences")
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars")).cast("bigint"))
    return out.select(docs.columns)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of ``benchmark``.

    Only rows whose own text holds one go, not others with the same or no doc_id. Null and empty texts hold none.
    """
    leaks = stored(find_leaks(docs, table(spark, sf_dir, "benchmark")), "leaks")
    return remove_leaks(docs, leaks).select(docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each piece of each document with its place in a sequence.

    A null or empty text is one piece of one token, its end. Null and repeated ids are rows like others. Very long texts are
    cut into pieces. No documents, no rows.
    """
    return pack_documents(docs, tokenizer_file("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality),
    ("ngram_jaccard_join", near_duplicates),
    ("substring_dedup", repeated_spans),
    ("benchmark_decontamination", benchmark_leaks),
    ("best_fit_packing", packing),
]

#: Boosted trees, the tokenizer and packing have no counterpart in SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each but the last is written to the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
