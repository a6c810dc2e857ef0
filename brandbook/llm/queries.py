"""The queries opN_<name> over the tables of a folder, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from brandbook.llm import (
    bpe,
    decision_list,
    decontaminate,
    html_text,
    infill,
    mixture,
    oracle,
    quality,
    resampling,
    simhash,
    token_counts,
    toxicity,
    url_filter,
    warc,
)
from brandbook.session import table, tidied


#: The date that fresh headers carry; a parameter, so that a query gives the same archive every time.
WARC_DATE = "2024-01-01T00:00:00Z"


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"), WARC_DATE).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return decontaminate.digest(found)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, keep=["doc_id"])


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op6_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture.mix(table(spark, sf_dir, "documents"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.attribute(table(spark, sf_dir, "documents"), ["text"])


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), keep=["doc_id", "source", "lang"])


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages")).drop("score")


def op10_decision_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = decision_list.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op11_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return infill.digest(infill.transform(table(spark, sf_dir, "documents"), keep=["doc_id"]))


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest(bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), keep=["doc_id"])))


QUERIES = {
    f.__name__: tidied(f)
    for f in (
        op1_warc,
        op2_html_text,
        op3_decontaminate,
        op4_toxicity,
        op5_simhash,
        op6_mixture,
        op7_token_counts,
        op8_quality,
        op9_url_filter,
        op10_decision_list,
        op11_infill,
        op12_resampling,
        op13_bpe,
    )
}

ORACLE_SQL = oracle.ORACLE_SQL
