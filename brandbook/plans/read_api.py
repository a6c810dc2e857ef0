"""The public reads over one set of graph tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from brandbook.operators import graph, resolve
from brandbook.schema import TABLES
from brandbook.streaming import tail


class Herd:
    """An engine over the tables of a load; every method returns a DataFrame."""

    def __init__(self, tables: dict[str, DataFrame]):
        self.tables = {name: tables[name] for name in TABLES}

    @classmethod
    def load(cls, records: DataFrame, **options) -> Herd:
        """Resolve ``records`` with ``seq`` from scratch."""
        return cls(resolve.replay(records, **options))

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> Herd:
        return cls({name: spark.read.schema(ddl).parquet(f"{path}/{name}") for name, ddl in TABLES.items()})

    @classmethod
    def current(cls, spark: SparkSession, path: str) -> Herd:
        """The graph that a following load (``tail.load_graph``) published last."""
        index, batch = tail.loaded(spark, path)
        return cls(index.tables(batch))

    def save(self, path: str) -> None:
        """A new version: all tables into an empty folder."""
        for name, df in self.tables.items():
            df.write.mode("errorifexists").parquet(f"{path}/{name}")

    def get_animal(self, uid: str) -> DataFrame:
        return graph.profile({n: t.where(F.col("child_uid" if n == "parentage" else "uid") == uid) if n != "animal" else t for n, t in self.tables.items()}).where(F.col("uid") == uid)

    def multi_association(self, limit: int = 200) -> DataFrame:
        names = self.tables["animal"].select("uid", "name")
        return graph.multi_association(self.tables["registration"]).join(names, "uid").orderBy(F.asc_nulls_last("name"), "uid").limit(limit)

    def carriers_of(self, code: str, limit: int = 200) -> DataFrame:
        return graph.carriers(self.tables["animal"], self.tables["animal_defect"], code, limit)

    def by_breed(self, breed: str, at_least: float = 0.0, limit: int = 200) -> DataFrame:
        return graph.by_breed(self.tables["animal"], self.tables["animal_breed"], breed, at_least, limit)

    def pedigree(self, uid: str, generations: int = 5) -> DataFrame:
        spark = self.tables["animal"].sparkSession
        found = graph.pedigree_of(spark, self.tables["parentage"], uid, generations)
        return found.join(self.tables["animal"].select("uid", "name"), "uid", "left").orderBy("depth", "uid")

    def find(self, text: str) -> DataFrame:
        return graph.find(self.tables["animal"], self.tables["registration"], text)

    def duplicates(self, most: int = 50) -> DataFrame:
        return graph.duplicate_preview(self.tables["animal"], most)

    def reconciled(self) -> Herd:
        return Herd(graph.reconcile(self.tables))

    def without_steers(self) -> Herd:
        return Herd(graph.without_steers(self.tables))
