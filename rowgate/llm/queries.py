"""One query for each operator over its whole table, and SQL where SQL can express it."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowgate.llm import chunks, dialogues, exact, oracles, pages, pieces, pq, quality, simhash, spelling, tiling, token_files, toxicity, urls
from rowgate.storage import fresh_dir

#: Where Python workers of a local session find this package; on a cluster it is installed or sent with the job.
_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.sparkContext.environment.setdefault("PYTHONPATH", _ROOT)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    """Where a public tokenizer's file is."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = chunks.deduplicate(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return docs.select("doc_id", "n_bytes", "n_removed", F.size("spans").alias("n_spans"), "text")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    with open(vocabulary("byte_bpe_50k.json"), encoding="utf-8") as file:
        definition = file.read()
    path = fresh_dir(spark, "tokens")
    token_files.write(_table(spark, sf_dir, "documents"), path, definition, literal=False)
    return token_files.digests(spark, path)


def op4_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiling.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op5_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.assess(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op6_suffix_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.removals(_table(spark, sf_dir, "documents")).drop("spans")


def op7_nbsvm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.assess(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op8_pq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pq.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op9_minimum_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.extract(_table(spark, sf_dir, "pages"))


def op10_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    with open(vocabulary("piece_bpe_32k.model"), "rb") as file:
        return pieces.digests(_table(spark, sf_dir, "documents"), file.read())


def op11_composition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(_table(spark, sf_dir, "documents"))


def op12_url_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(_table(spark, sf_dir, "pages")).drop("score")


def op13_hirschberg(spark: SparkSession, sf_dir: str) -> DataFrame:
    damaged = dialogues.damage(_table(spark, sf_dir, "conversations"))
    return dialogues.repair(damaged, copies=F.col("copies"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    _table(spark, sf_dir, "documents")
    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_chunks,
        op2_simhash,
        op3_token_files,
        op4_tiling,
        op5_kneser_ney,
        op6_suffix_arrays,
        op7_nbsvm,
        op8_pq,
        op9_minimum_cut,
        op10_pieces,
        op11_composition,
        op12_url_models,
        op13_hirschberg,
        pipeline,
    )}


def oracle_sql() -> dict[str, str]:
    return {"op12_url_models": oracles.url_filter()}
