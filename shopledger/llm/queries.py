"""The training-data operators as registered queries, with DuckDB SQL where SQL can express them."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopledger.llm import (
    decontamination,
    divergence,
    embeddings,
    htmlextract,
    langid,
    licenses,
    oracles,
    phrases,
    pieces,
    pii,
    sharding,
    simhash,
    urlfilter,
    warc,
)
from shopledger.llm.common import shared_folder


def public_model() -> str:
    """The installed public vocabulary; its place is only the default of a parameter."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    return langid.predict(documents, langid.train(langid.labelled_part(documents)))


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_table(spark, sf_dir, "documents"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.placements(_table(spark, sf_dir, "documents"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", F.array_min("items").alias("first_item"), F.size("items").cast("long").alias("n_items"), "coverage", "n_windows"
    )


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(_table(spark, sf_dir, "documents"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op7_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.captures(_table(spark, sf_dir, "pages"), shared_folder(spark))


def op9_htmlextract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmlextract.extract(_table(spark, sf_dir, "pages"))


def op10_sentencepiece(spark: SparkSession, sf_dir: str, model_file: str | None = None) -> DataFrame:
    return pieces.encode(_table(spark, sf_dir, "documents"), pieces.load(model_file or public_model()))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(_table(spark, sf_dir, "documents")).drop("first_doc", "first_word")


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(_table(spark, sf_dir, "documents"))


def op13_urlfilter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judged(_table(spark, sf_dir, "pages"), urlfilter.train(urlfilter.labelled(spark)))


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if re.match(r"op\d+_", name)}


def all_oracles() -> dict[str, str]:
    return {
        "op3_sharding": oracles.sharding(),
        "op4_decontamination": oracles.decontamination(),
        "op7_embeddings": oracles.embeddings(),
        "op8_warc": oracles.warc(),
        "op11_collocations": oracles.collocations(),
        "op12_divergence": oracles.divergence(),
    }
