"""Records a second of the resolver over made-up records: python bench_resolver.py [RECORDS...]; one JSON line.

Of each ten animals three have papers in a second registry, found by name and birth date, cross-reference or DNA
case in turn; every record names two parents, of which some are never recorded themselves."""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import DataFrame, SparkSession, functions as F

from brandbook.operators import resolve
from brandbook.schema import PARENT
from brandbook.session import scratch


def made_up(spark: SparkSession, n: int) -> DataFrame:
    animals = n * 10 // 13
    none = lambda kind: F.lit(None).cast(kind)
    base = spark.range(animals).select("id", F.explode(F.when(F.col("id") % 10 < 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("paper"))
    way = F.col("id") % 3
    text = lambda c: c.cast("string")
    parent = lambda by: F.struct(none("string").alias("intl_id"), F.lit("CHIA").alias("association"), F.concat(F.lit("C"), text(F.expr(f"id div {by}"))).alias("regNumber"), F.concat(F.lit("HERD "), text(F.expr(f"id div {by}")), F.lit("A")).alias("name")).cast(PARENT)
    return base.select(
        (F.col("id") * 2 + F.col("paper")).alias("seq"), none("string").alias("intl_id"), F.when(F.col("paper") == 0, "CHIA").otherwise("MAINE").alias("association"), F.concat(F.when(F.col("paper") == 0, "C").otherwise("M"), text(F.col("id"))).alias("regNumber"),
        F.concat(F.lit("HERD "), text(F.col("id")), F.lit("A")).alias("name"), F.when(F.col("id") % 2 == 0, "M").otherwise("F").alias("sex"), F.when((F.col("paper") == 0) | (way == 0), F.lit("2001-02-03")).alias("dob"),
        *(none("string").alias(c) for c in ("tattoo", "color", "horn_status", "breeder", "owner")), F.array(F.struct(F.lit("AN").alias("breed"), F.lit(100.0).alias("percent"))).alias("breed_composition"),
        F.array(F.struct(F.lit("TH").alias("code"), F.lit("F").alias("status"))).alias("defects"), F.when(way == 2, F.array(F.concat(F.lit("AGI-"), text(F.col("id") + 1000)))).otherwise(F.array().cast("array<string>")).alias("dna_cases"),
        F.when((F.col("paper") == 1) & (way == 1), F.array(F.struct(F.lit("CHIA").alias("association"), F.concat(F.lit("C"), text(F.col("id"))).alias("regNumber")))).alias("cross_refs"), none("map<string,string>").alias("epds"), none("string").alias("attributes"),
        F.when(F.col("id") > 3, parent(2)).alias("sire"), F.when(F.col("id") > 3, parent(3)).alias("dam"), none("string").alias("source_url"), none("string").alias("scraped_at"),
    )


def main(sizes: list[int]) -> None:
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = SparkSession.builder.master(f"local[{cpus}]").config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "12g").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    rates = {}
    for n in [1000, *sizes]:  # the first warms up
        with scratch(spark):
            began = time.perf_counter()
            tables = resolve.replay(made_up(spark, n))
            animals = tables["animal"].count()
            rates[n] = {"seconds": round(time.perf_counter() - began, 2), "records_per_s": round(n / (time.perf_counter() - began)), "animals": animals}
    print(json.dumps({"metric": "resolver", "sizes": {str(k): v for k, v in rates.items() if k != 1000}}))
    spark.stop()


if __name__ == "__main__":
    main([int(x) for x in sys.argv[1:]] or [10_000, 100_000])
