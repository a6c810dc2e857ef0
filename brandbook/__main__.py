"""python -m brandbook load RECORDS... --to DIR | animal DIR UID | pedigree DIR UID | carriers DIR CODE | breeds DIR BREED PERCENT | shared DIR |
duplicates DIR | reconcile DIR --to DIR | without-steers DIR --to DIR | tail FILE... --graph DIR | rebuild FILE... --graph DIR | state DIR | schema"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from brandbook import schema
from brandbook.operators import graph
from brandbook.plans.read_api import Herd
from brandbook.session import published
from brandbook.sources.records import read_records
from brandbook.streaming import tail


def main(args: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="brandbook", description=__doc__)
    verbs = parser.add_subparsers(dest="verb", required=True)
    load = verbs.add_parser("load")
    load.add_argument("records", nargs="+")
    load.add_argument("--to", required=True)
    load.add_argument("--array", action="store_true")
    load.add_argument("--skip-steers", action="store_true")
    for name, extra in (("animal", ["uid"]), ("pedigree", ["uid"]), ("carriers", ["code"]), ("breeds", ["breed", "percent"]), ("shared", []), ("duplicates", []), ("state", []), ("reconcile", []), ("without-steers", [])):
        verb = verbs.add_parser(name)
        for field in ("path", *extra):
            verb.add_argument(field)
        if name in ("reconcile", "without-steers"):
            verb.add_argument("--to", required=True)
    for name in ("tail", "rebuild"):
        follow = verbs.add_parser(name)
        follow.add_argument("files", nargs="+")
        follow.add_argument("--graph", required=True)
        if name == "tail":
            follow.add_argument("--once", action="store_true")
    verbs.add_parser("schema")
    got = parser.parse_args(args)
    spark = SparkSession.builder.appName("brandbook").getOrCreate()
    if got.verb == "load":
        Herd.load(read_records(spark, got.records, got.array), skip_steers=got.skip_steers).save(got.to)
        return
    if got.verb == "schema":
        for name, ddl in schema.TABLES.items():
            print(f"{name}: {ddl}; unique by {', '.join(schema.UNIQUE.get(name, [])) or 'whole row'}")
        return
    if got.verb == "tail":
        epoch = tail.current_epoch(spark, got.graph)
        query = tail.follow(spark, got.files, tail.load_graph(got.graph, epoch), f"{got.graph}/{epoch}/_checkpoint", got.once)
        query.awaitTermination()
        return
    if got.verb == "rebuild":
        print(tail.rebuild(spark, got.files, got.graph))
        return
    if got.verb == "state":
        print(published(spark, got.path))
        graph.cardinalities(Herd.current(spark, got.path).tables).show(truncate=False)
        return
    herd = Herd.open(spark, got.path)
    if got.verb in ("reconcile", "without-steers"):
        (herd.reconciled() if got.verb == "reconcile" else herd.without_steers()).save(got.to)
        return
    found = {
        "animal": lambda: herd.get_animal(got.uid), "pedigree": lambda: herd.pedigree(got.uid), "carriers": lambda: herd.carriers_of(got.code),
        "breeds": lambda: herd.by_breed(got.breed, float(got.percent)), "shared": lambda: herd.multi_association(), "duplicates": lambda: herd.duplicates(),
    }[got.verb]()
    found.show(200, truncate=False)


if __name__ == "__main__":
    main()
