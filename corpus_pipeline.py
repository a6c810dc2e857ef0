"""The corpus pipeline: documents in, a decontaminated and mixed corpus out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as
the next one's docs. Documents rejected for toxicity or quality go, one document of each near-duplicate group
and no contaminated document stays, and the last stage repeats and shuffles what is left by its sources'
weights. Rows are carried through an operator as one struct, so columns of any name come out as they went in.

Every stage takes nulls in any column, empty and very long texts, repeated rows and tables without rows, labels or
benchmark items: a document without text has no words and is judged, grouped and matched as an empty one; one
without id is never labelled or held out; an empty table stays empty. What else each does is in its docstring.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from brandbook.llm import decontaminate, mixture, quality, simhash, toxicity
from brandbook.session import materialise, scratch, table


def _packed(docs: DataFrame) -> DataFrame:
    return docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is below the threshold. Learned from the labels of ids open to learning; without any, all
    stay. Repeated rows have equal scores and go or stay together."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(_packed(docs), model, "row.text", "row.doc_id").where("predicted = 0").select("row.*")


def reject_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose posterior is at the threshold or above. Null sources and languages are sites of their own; without
    labels of both kinds all are judged by the labels' mean and, without any, stay."""
    judged = quality.judge(_packed(docs), table(spark, sf_dir, "labels"), "row.source", "row.lang", "row.text", "row.doc_id")
    return judged.where("kept").select("row.*")


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts linked by a Jaccard similarity of 0.8 or more of their sets of five-word
    shingles: the one with the least id, of rows that share it the one with the least set name and hash. Texts without
    words are one group."""
    return simhash.keep_one_similar(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words is in windows of benchmark items; a document without words
    is never contaminated."""
    found = decontaminate.find_overlaps(_packed(docs), table(spark, sf_dir, "benchmark"), "row.text")
    return found.where("not contaminated").select("row.*")


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the inverse Poisson distribution of its source's rate says, with copy and mix_key, in
    the order of mix_key. A null source is a source; a null id is hashed as an empty string; ties and repeated rows
    get equal counts."""
    return mixture.mix(docs)


STAGES = [
    ("toxicity", reject_toxic),
    ("quality", reject_poor),
    ("near_duplicates", deduplicate),
    ("decontamination", decontaminated),
    ("mixture", mixed),
]

#: The classifiers are fitted iteratively and fingerprints use XXH64: SQL can't express the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        with scratch(spark) as keep:
            docs = keep(materialise(stage(spark, docs, sf_dir), name))
    return docs
