"""A training corpus from raw documents: five stages, each written as Parquet and read by the next."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulgrain.llm import line_dedup, minhash, sentencepiece_fst, toxicity, wumanber
from haulgrain.llm.shared import importable, new_folder, table

TOKENIZER = "piece_bpe_32k.model"


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject; null and empty texts and repeated rows stay."""
    return toxicity.clean_documents(docs, table(spark, sf_dir, "labels"))


def remove_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later runs of repeated lines; one that loses all its words goes, one that had none stays."""
    return line_dedup.documents_without_repeated_lines(docs)


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies; rows without an id, and texts without words, all stay."""
    return minhash.one_of_each_group(docs)


def remove_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item; null and empty texts stay."""
    return wumanber.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of piece ids per document, with the text decoded from them; a null text has no ids."""
    rows = sentencepiece_fst.encode(docs, public_tokenizers.path(TOKENIZER))
    return rows.select("doc_id", "ids", F.size("ids").cast("bigint").alias("n_pieces"), "decoded", "round_trip")


STAGES = [
    ("toxicity", importable(remove_toxic)),
    ("line dedup", importable(remove_repeated_lines)),
    ("minhash near-dedup", importable(remove_near_duplicates)),
    ("benchmark decontamination", importable(remove_contaminated)),
    ("sentencepiece", importable(encode_pieces)),
]

#: SQL can't express the toxicity model and the piece lattice
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage for ``documents`` below ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    folder = new_folder(spark, "corpus")
    for number, (_, stage) in enumerate(STAGES, 1):
        path = f"{folder}/{number}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
