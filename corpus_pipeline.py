"""The corpus pipeline: rules, line dedup, near dedup, decontamination, tokenizing, each stage written and read again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapewright.llm.decontamination import find_leaks
from tapewright.llm.line_dedup import dedup_lines
from tapewright.llm.minhash_dedup import near_duplicates
from tapewright.llm.piece_codec import encode_decode
from tapewright.llm.quality_rules import clean_lines
from tapewright.llm.shared import new_path, table


def _with_text(docs: DataFrame, text: Column) -> DataFrame:
    """The columns of documents, with another text and its length."""
    return docs.withColumn("text", text).withColumn("n_chars", F.length("text").cast("long")).select("doc_id", "text", "lang", "source", "n_chars")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes failing lines, and the documents that the rules reject, those without text among them.

    Each row is judged alone: rows that repeat an id or have none are judged like others. An empty table stays empty.
    """
    judged = docs.select("doc_id", "text", F.struct("lang", "source").alias("rest"))
    done = clean_lines(judged, carry=["rest"]).filter("kept")
    return _with_text(done.select("doc_id", "clean_text", "rest.*"), F.col("clean_text"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes lines that another document holds first. A document without text, or whose lines all go, goes too.

    Rows with a null id keep their lines and take none from others; rows that repeat an id are one document.
    """
    done = dedup_lines(docs, carry=["lang", "source"])
    return _with_text(done, F.col("kept_text")).filter("n_chars > 0")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies (sets of 5-word shingles, similarity 0.8 or more).

    Rows with a null id are no documents and stay; rows that repeat a kept id all stay.
    """
    gone = near_duplicates(docs).filter("NOT kept").select("doc_id")
    return docs.join(gone, "doc_id", "left_anti")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes documents that overlap a benchmark item. Rows with a null id and those without text stay; equal rows share their fate."""
    leaks = find_leaks(docs, table(spark, sf_dir, "benchmark"))
    return docs.join(leaks.select("doc_id"), "doc_id", "left_anti")


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids and n_tokens of each row, and whether decoding them gives the text back. A null text is empty: no ids, and true."""
    import public_tokenizers

    coded = encode_decode(docs, public_tokenizers.path("piece_bpe_32k.model"), carry=["text"])
    return coded.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"), (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("MinHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("SentencePiece encoding and decoding", tokenize),
]

#: SQL cannot express SentencePiece encoding; the tests hold run() against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to documents, each written as Parquet to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_path(spark, "stage-" + name.split()[0].lower())
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
