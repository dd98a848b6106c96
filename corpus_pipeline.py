"""A document pipeline in five stages, each an operator of ``rowgate.llm`` applied to all that the stage before kept.

``run`` writes what each stage returns as Parquet to the shared folder and reads it back for the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowgate.llm import chunks, pieces, quality, simhash, tiling
from rowgate.llm.queries import vocabulary
from rowgate.storage import cut

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, learned from all labelled documents of the fold it may see, accepts."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    learn = labels.where(quality.crc_fold(F.col("doc_id"), 3) != 1)
    scored = quality.score(docs.select(*COLUMNS), quality.fit(docs, learn))
    return scored.where("score >= 0.5").select(*COLUMNS)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: fingerprints of three-word shingles, three bits or fewer apart."""
    return simhash.representatives(docs.select(*COLUMNS))


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier one has; ``n_chars`` follows the text."""
    left = chunks.deduplicate(docs.select(*COLUMNS))
    return left.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return tiling.clean(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their pieces; the text is the one decoded from them."""
    with open(vocabulary("piece_bpe_32k.model"), "rb") as file:
        return pieces.tokenise(docs.select(*COLUMNS), file.read())


STAGES = [
    ("quality classifier", good_quality),
    ("SimHash near-dedup", one_of_each_group),
    ("substring dedup", without_repeats),
    ("benchmark decontamination", without_benchmark),
    ("SentencePiece encoding and decoding", encoded),
]

#: Hashes, learned weights and tokenizers are beyond SQL; tests hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
