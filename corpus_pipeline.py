"""Corpus cleaning pipeline: stages over documents, each fed what its predecessor kept.

Every stage but the last returns the columns of documents. ``run`` chains them in one plan; a scheduler
can as well write each stage's result as Parquet and feed it to the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone.llm.common import table
from quillstone.llm.decontaminate import decontaminate
from quillstone.llm.language_id import fit_language_model, identify_language
from quillstone.llm.line_dedup import line_dedup
from quillstone.llm.near_copies import drop_near_copies
from quillstone.llm.piece_codec import piece_codec

#: A document is rejected if it has no letter, if no learned language has at least this share of the likelihood, or if letters drawn
#: one by one explain it better than the language does: by as many nats a letter, and so many in all that chance is ruled out.
LEAST_LANGUAGE_SCORE, LEAST_EVIDENCE_A_LETTER, SURE = 0.5, -0.75, -12.0


def keep_identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language, which is clear. The model learns from the rows of docs that name a language and have a text.

    A null text, or one without letters, goes. Ids may be null or repeated; equal rows stay or go together.
    """
    found = identify_language(docs, fit_language_model(docs))
    foreign = (F.col("evidence") < SURE) & (F.col("evidence") < LEAST_EVIDENCE_A_LETTER * F.col("letters"))
    return found.filter((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_LANGUAGE_SCORE) & ~foreign).select(*docs.columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated three-line windows; one of which nothing is left goes.

    A null text becomes empty. Ids may be null or repeated: places are of texts under ids, in the order of both.
    """
    cut = line_dedup(docs)
    left = (F.col("n_removed_lines") == 0) | (F.trim("text") != "")
    return cut.filter(left).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def dedup_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a similarity of 0.8 of five-word shingles: that of the smallest id, a null id last.

    Texts that share an id are judged each by itself; of repeated rows one stays; null and empty texts are copies of each other.
    """
    return drop_near_copies(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark; null and empty texts stay, and rows that share an id are judged by their texts."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, decoded, library_agrees of every document; a null text counts as empty, repeated rows give repeated rows."""
    return piece_codec(docs).select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded", "library_agrees")


STAGES = [
    ("language_id", keep_identified),
    ("line_dedup", dedup_lines),
    ("simhash_near_dedup", dedup_near_copies),
    ("decontamination", drop_benchmark),
    ("piece_codec", encode_pieces),
]
#: Language scores and piece ids can't be computed in SQL; tests hold the stages, and a whole run, against what they are to keep.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs
