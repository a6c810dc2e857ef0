"""Queries that hold sources, page parsers, resolution and the reads of a herd against SQL, over records and
pages made from the driver's tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from brandbook.operators import frontier, graph, pages, progress, resolve, robots
from brandbook.operators.block_index import BlockIndex
from brandbook.operators.ordered import numbered
from brandbook.plans.read_api import Herd
from brandbook.plans.registry import long, query
from brandbook.schema import PARENT, RECORD, TABLES
from brandbook.session import materialise, spread, table, workspace
from brandbook.sources import archive, records
from brandbook.streaming import history

_FIELDS = {c.strip().split(" ")[0]: c.strip().split(" ", 1)[1] for c in pages.columns_of(RECORD)}


def none(kind: str) -> Column:
    return F.lit(None).cast(kind)


def as_records(rows: DataFrame, seq: Column, **values: Column) -> DataFrame:
    """Records with the given fields, the others null."""
    return rows.select(seq.cast("bigint").alias("seq"), *(values.get(name, none(kind)).cast(kind).alias(name) for name, kind in _FIELDS.items()))


def parent(association: str, reg: Column, name: Column | None = None) -> Column:
    return F.struct(none("string").alias("intl_id"), F.lit(association).alias("association"), reg.cast("string").alias("regNumber"), (none("string") if name is None else name).alias("name")).cast(PARENT)


# ---- sources


@query("""
SELECT row_number() OVER (ORDER BY c_custkey) - 1 AS seq, 'CHIA' AS association, c_custkey::VARCHAR AS reg, c_name AS name, c_mktsegment AS color FROM customer""")
def records_round_trip(spark, d):
    """Records written as JSONL with blank and malformed lines beside them, and read in order of file and place."""
    c = table(spark, d, "customer")
    path = workspace(spark, "jsonl")
    made = as_records(c, F.col("c_custkey"), association=F.lit("CHIA"), regNumber=F.col("c_custkey"), name=F.col("c_name"), color=F.col("c_mktsegment"))
    records.append_records(made.repartitionByRange(4, "seq").sortWithinPartitions("seq"), path)
    spark.createDataFrame([("",), ("{not json",), ('{"association": "CHIA"}',)], "value string").coalesce(1).write.mode("append").text(path)
    return records.read_records(spark, path).select("seq", "association", F.col("regNumber").alias("reg"), "name", "color")


@query("""SELECT c_nationkey::VARCHAR AS association, count(DISTINCT c_custkey // 2) AS n FROM customer WHERE c_mktsegment <> 'FURNITURE' GROUP BY 1""")
def loadable_counts(spark, d):
    sex = F.when(F.col("c_mktsegment") == "FURNITURE", " s ").when(F.col("c_mktsegment") == "BUILDING", "M")
    rows = table(spark, d, "customer").select(F.concat(F.lit(" "), F.col("c_nationkey").cast("string")).alias("association"), F.expr("cast(c_custkey div 2 as string)").alias("regNumber"), sex.alias("sex"))
    return records.loadable(rows)


@query("""
SELECT association, reg_number, max(priority) AS priority FROM (
  SELECT CASE o_orderkey % 3 WHEN 2 THEN 'MAINE' ELSE 'CHIA' END AS association, (o_custkey + 500)::VARCHAR AS reg_number, 3 AS priority FROM orders
  UNION ALL SELECT 'SIMM', x::VARCHAR, 0 FROM range(100, 121) t(x)) GROUP BY 1, 2""")
def seed_files(spark, d):
    """Seed lines of three forms with comments, and a range of numbers, as a queue of an older layout brought up to date."""
    k, reg = F.col("o_orderkey") % 3, (F.col("o_custkey") + 500).cast("string")
    line = F.when(k == 0, reg).when(k == 1, F.concat(F.lit("chia:"), reg, F.lit("  # known"))).otherwise(F.concat(F.lit(" maine,"), reg))
    path = workspace(spark, "seeds")
    table(spark, d, "orders").select(line.alias("value")).union(spark.createDataFrame([("# all",), ("",)], "value string")).write.text(path)
    seeds = records.read_seeds(spark, path, "CHIA", 3).unionByName(records.enumerated(spark, "simm", 100, 120))
    old = records.empty_frontier(spark).select("association", "reg_number")
    return frontier.seeded(records.migrated_frontier(old), seeds).select("association", "reg_number", "priority")


@query("""
SELECT event_type AS association, CASE WHEN event_type = 'view' THEN 'running' ELSE 'idle' END AS state, count(*) AS done, count(*) // 2 AS pending, max(event_id)::VARCHAR AS reg FROM events GROUP BY 1 HAVING event_type = 'view' OR count(*) > 0""")
def status_files(spark, d):
    """Status objects written as files, an unreadable one and one of a crawler that never ran among them, and what of
    them may be published."""
    rows = table(spark, d, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.max("event_id").alias("last"))
    current = F.struct(F.col("event_type").alias("association"), F.col("last").cast("string").alias("reg"), F.lit("secret").alias("color"))
    made = rows.select(F.to_json(F.struct(F.col("event_type").alias("association"), F.when(F.col("event_type") == "view", "running").otherwise("idle").alias("state"), current.alias("current"), F.create_map(F.lit("done"), F.col("n"), F.lit("pending"), F.floor(F.col("n") / 2)).alias("counts"))).alias("value"))
    path = workspace(spark, "status")
    extra = spark.createDataFrame([("{broken",), ('{"association": "NEVER", "state": "idle", "counts": {"pending": 5}}',)], "value string")
    both = made.union(extra)
    both.repartition(both.count(), "value").write.option("maxRecordsPerFile", 1).text(path)
    return progress.published(records.read_status(spark, path)).select("association", "state", "done", "pending", "current.reg")


@query("""SELECT 'P' || page_id AS reg, length(html) AS chars, substr(sha1('P' || page_id), 1, 2) AS shard, page_id % 3 = 0 AS again FROM pages""")
def archive_round_trip(spark, d):
    """Pages saved in the archive, some of them twice; a page counts as it was saved last."""
    path = workspace(spark, "archive")
    rows = table(spark, d, "pages").select(F.lit("chia").alias("association"), F.concat(F.lit("P"), F.col("page_id").cast("string")).alias("reg"), F.lit("container").alias("suffix"), "html", "page_id")
    archive.save(rows.where("page_id % 3 = 0").withColumn("html", F.lit("old")), path)
    archive.save(rows, path)
    saved = archive.latest(archive.scan(spark, path, "CHIA", ["container"])).select("reg", F.length("html").alias("chars"), "shard")
    twice = archive.scan(spark, path).groupBy("reg").agg((F.count("*") > 1).alias("again"))
    return saved.join(twice, "reg")


@query("""SELECT 'CHIA' AS association, 'P' || page_id AS reg FROM pages WHERE page_id % 4 <> 1""")
def archive_missing(spark, d):
    path = workspace(spark, "archive")
    rows = table(spark, d, "pages").select(F.lit("CHIA").alias("association"), F.concat(F.lit("P"), F.col("page_id").cast("string")).alias("reg"), F.lit("epds").alias("suffix"), "html", "page_id")
    archive.save(rows.where("page_id % 4 = 1"), path)
    return archive.missing(rows.select("association", "reg", "suffix"), spark, path).select("association", "reg")


# ---- page parsers


def _cells(*cells: Column | str) -> Column:
    parts = [x for c in cells for x in (F.lit("<td>"), F.lit(c) if isinstance(c, str) else c.cast("string"), F.lit("</td>"))]
    return F.concat(F.lit("<tr>"), *parts, F.lit("</tr>"))


def _page(*parts: Column | str) -> Column:
    return F.concat(F.lit("<html><body>"), *(F.lit(p) if isinstance(p, str) else p for p in parts), F.lit("</body></html>"))


def registry_pages(spark, d) -> DataFrame:
    """Five tabs for every part: every seventh container is the site's shell for an unknown animal, every fifth animal
    has no EPDs."""
    k = F.col("p_partkey")
    number = lambda add: F.concat(F.lit("MA"), (k + add).cast("string"))
    container = F.when(k % 7 == 0, _page("<table>", _cells("Search:", ""), "</table>")).otherwise(_page(
        "<script>var s='<td>Name:</td><td>WRONG</td>';</script><table><tr><td><table>", _cells("Registration:", number(100000), "Name:", F.concat(F.lit("<b>"), "p_name", F.lit("</b>"))),
        _cells("Sex:", F.when(k % 2 == 0, "Bull").otherwise("Cow"), "Color:", F.col("p_brand")), _cells("Genetic Makeup:", F.concat((k % 100).cast("string"), F.lit(".5% MA | 1% an"))), _cells("Chianina %:", k % 50), _cells("Name:", "SECOND"),
        "</table></td></tr></table><p>DOB:&nbsp;9/", (k % 28 + 1).cast("string"), "/2011</p><a onClick=\"PullUpAnimalDetail('", (k + 400000).cast("string"), "', 'American Maine-Anjou Association')\">x</a>"))
    pedigree = _page("<table>", _cells("Sire:", F.concat(number(200000), F.lit(" BIG SIRE [ 01W ] -- AMFT"))), _cells("Dam:", F.concat(number(300000), F.lit(" GOOD DAM"))), "<tr><td><table>", _cells(F.concat(number(500000), F.lit(" OLD ONE"))), _cells(F.concat(number(200000), F.lit(" BIG SIRE"))), _cells(F.concat(number(500000), F.lit(" OLD ONE"))), _cells("nobody"), "</table></td></tr></table>")
    genotype = _page("<table>", _cells("Tibial Hemimelia (TH)", F.when(k % 3 == 0, "Free by Test").otherwise("Carrier by test"), "8/5/2014"), _cells("Alpha Mann (AM)", "Not tested"), "</table> case agi 10", (k + 1000).cast("string"))
    epds = _page("<table>", _cells("", "CED", "BW", "WW", "YW"), _cells("Subject", "THIS ONE", F.concat((k % 20).cast("string"), F.lit(" +1")), "1.25", "n/a", "-3"), "</table>")
    progeny = _page("<table><tr><td><table>", _cells("Active", "3/4/2016", "M", number(600000), "T2", "CALF", F.concat(number(700000), F.lit(" - MATE"))), "</table></td></tr></table>")
    tabs = [("container", container), ("pedigree", pedigree), ("genotype", genotype), ("epds", F.when(k % 5 > 0, epds)), ("progeny", progeny)]
    parts = spread(table(spark, d, "part"), "p_partkey")
    # a branch a tab: who reads one tab has only its pages made
    made = (parts.select(F.lit("chia").alias("association"), number(100000).alias("reg"), F.lit(name).alias("suffix"), html.alias("html")) for name, html in tabs)
    return reduce(DataFrame.union, made).where("html is not null")


@query(r"""
SELECT 'MA' || (100000 + k) AS reg, p_name AS name, CASE WHEN k % 2 = 0 THEN 'M' ELSE 'F' END AS sex, p_brand AS color, '2011-09-' || lpad((k % 28 + 1)::VARCHAR, 2, '0') AS dob, 'MA=' || printf('%.1f', k % 100 + 0.5) || ',AN=1.0' AS breeds,
  'TH=' || CASE WHEN k % 3 = 0 THEN 'F' ELSE 'C' END AS defects, 'AGI10' || (k + 1000) AS cases, 'MAINE:' || (400000 + k) AS cross_refs, CASE WHEN k % 5 > 0 THEN 'BW=1.25,CED=' || printf('%.1f', k % 20 + 0.0) || ',YW=-3.0' END AS epds, 'MA' || (200000 + k) || ' BIG SIRE' AS sire, 'MA' || (300000 + k) || ' GOOD DAM' AS dam,
  (k % 50)::VARCHAR AS chianina, '3' AS ancestors FROM (SELECT *, p_partkey AS k FROM part) WHERE k % 7 <> 0""")
def page_records(spark, d):
    found = pages.parsed(registry_pages(spark, d))[0]
    pair = lambda c, a, b: F.array_join(F.transform(c, lambda x: F.concat_ws("=", x[a], x[b].cast("string"))), ",")
    epds = F.array_join(F.array_sort(F.transform(F.map_entries("epds"), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string")))), ",")
    bag = lambda f: F.get_json_object("attributes", f"$.{f}")
    return found.select(
        F.col("regNumber").alias("reg"), "name", "sex", "color", "dob", pair("breed_composition", "breed", "percent").alias("breeds"), pair("defects", "code", "status").alias("defects"), F.array_join("dna_cases", ",").alias("cases"),
        F.array_join(F.transform("cross_refs", lambda x: F.concat_ws(":", x["association"], x["regNumber"])), ",").alias("cross_refs"), epds.alias("epds"), F.concat_ws(" ", "sire.regNumber", "sire.name").alias("sire"), F.concat_ws(" ", "dam.regNumber", "dam.name").alias("dam"),
        bag("chianina_percent").alias("chianina"), bag("pedigree_ancestors").alias("ancestors"),
    )


@query("""
SELECT 'MA' || (100000 + p_partkey) AS reg, n_association, CASE WHEN n_association = 'CHIA' THEN 'MA' ELSE '' END || (base + p_partkey) AS n_reg, relation FROM part,
  (VALUES ('CHIA', 200000, 'sire'), ('CHIA', 300000, 'dam'), ('CHIA', 500000, 'pedigree'), ('CHIA', 600000, 'progeny'), ('CHIA', 700000, 'progeny'), ('MAINE', 400000, 'cross-registration')) v(n_association, base, relation) WHERE p_partkey % 7 <> 0""")
def page_neighbours(spark, d):
    relation = F.when(F.col("relation") == "mate", "progeny").otherwise(F.col("relation"))  # a mate counts as progeny
    return pages.parsed(registry_pages(spark, d))[1].select("reg", "n_association", "n_reg", relation.alias("relation"))


@query("""
SELECT (20000 + k)::VARCHAR AS reg, p_name AS name, CASE WHEN k % 2 = 0 THEN 'M' ELSE 'F' END AS sex, '09/14/2016' AS dob, 'AM=F' AS defects, (500000 + k)::VARCHAR AS sire, (700000 + k)::VARCHAR AS dam, 'MAINE:' || (400000 + k) AS cross_refs, '+' || (k % 30) || '.5' AS ced, 3 AS near FROM (SELECT *, p_partkey AS k FROM part)""")
def angus_pages(spark, d):
    """Detail pages of the second kind of site: identity, parents, composition by rule, other registrations, neighbours."""
    k = F.col("p_partkey")
    number = lambda add: (k + add).cast("string")
    html = _page(
        "<h1>", F.col("p_name"), "</h1><div>Reg: AAA #+", number(20000), "</div><p>", F.when(k % 2 == 0, "Bull").otherwise("Cow"), "</p><p>Birth Date: 09/14/2016\n  Tattoo: none</p><p>[ AMF ]</p><p>also AMAA #", number(400000), "</p><table class='pedigree'>",
        _cells(F.concat(F.lit("AAA #"), number(500000)), F.concat(F.lit("AAA "), number(600000))), _cells(F.concat(F.lit("AAA "), number(700000)), "none"), "</table><table class='mobile-table'>", _cells("CED", "$B"), _cells(F.concat(F.lit("+"), (k % 30).cast("string"), F.lit(".5%")), "185"), "</table>",
    )
    made = spread(table(spark, d, "part"), "p_partkey").select(F.lit("ANGUS").alias("association"), number(20000).alias("reg"), F.lit("detail").alias("suffix"), html.alias("html"))
    found, near = pages.parsed(made)
    pair = F.array_join(F.transform("defects", lambda x: F.concat_ws("=", x["code"], x["status"])), ",")
    refs = F.array_join(F.transform("cross_refs", lambda x: F.concat_ws(":", x["association"], x["regNumber"])), ",")
    rows = found.select(F.col("regNumber").alias("reg"), "name", "sex", "dob", pair.alias("defects"), F.col("sire.regNumber").alias("sire"), F.col("dam.regNumber").alias("dam"), refs.alias("cross_refs"), F.element_at("epds", "CED").alias("ced"))
    return rows.join(near.groupBy("reg").agg(F.count("*").cast("int").alias("near")).hint("merge"), "reg")


# ---- resolution


_LADDER = """
WITH k AS (SELECT c_custkey AS k, c_custkey % 8 AS kind FROM customer)
SELECT k, CASE kind WHEN 0 THEN 'intl_id' WHEN 1 THEN 'registration' WHEN 2 THEN 'dna' WHEN 3 THEN 'cross_ref' WHEN 4 THEN 'tattoo_dob_sex' WHEN 5 THEN 'name_dob' WHEN 6 THEN 'name_dob' ELSE 'created' END AS rung,
  CASE kind WHEN 7 THEN 'MAINE:B' || k WHEN 6 THEN 'MAINE:B' || k ELSE 'CHIA:A' || k END AS uid, CASE kind WHEN 7 THEN 2 ELSE 1 END AS animals FROM k"""


@query(_LADDER)
def resolve_ladder(spark, d):
    """Two records of each customer that one rung of the ladder joins, by customer: international id, registration, case,
    cross reference, tattoo with birth date and sex, name with birth date, a nameless-date stub swept up, or none."""
    c = spread(table(spark, d, "customer"), "c_custkey")
    k, kind = F.col("c_custkey"), F.col("c_custkey") % 8
    key = k.cast("string")
    when = lambda i, value: F.when(kind == i, value)
    name = lambda tail: F.concat(F.lit("HERD "), key, F.lit(tail))
    shared = {
        "intl_id": when(0, F.concat(F.lit("I"), key)), "dna_cases": when(2, F.array(F.concat(F.lit("AGI 9"), key))), "tattoo": when(4, F.concat(F.lit("T"), key)),
        "sex": F.lit("F"), "breed_composition": F.array(F.struct(F.lit("AN").alias("breed"), F.lit(100.0).alias("percent"))),
    }
    dob = F.when(kind == 7, none("string")).otherwise("2001-02-03")
    first = as_records(c, 2 * k, association=F.lit("CHIA"), regNumber=F.concat(F.lit("A"), key), name=name(" ONE"), dob=F.when(kind == 6, none("string")).otherwise(dob), **shared)
    second_name = F.when(kind.isin(5, 6), name(" ONE")).otherwise(name(" TWO"))
    refs = when(3, F.array(F.struct(F.lit("CHIA").alias("association"), F.concat(F.lit("A"), key).alias("regNumber"))))
    again = F.when(kind == 1, F.concat(F.lit("A"), key)).otherwise(F.concat(F.lit("B"), key))
    second = as_records(c, 2 * k + 1, association=F.when(kind == 1, "CHIA").otherwise("MAINE"), regNumber=again, name=second_name, dob=dob, cross_refs=refs, **shared)
    tables = resolve.replay(first.unionByName(second))
    log = tables["log"].where("pmod(mention, 3) = 0 and pmod(mention div 3, 2) = 1").groupBy(F.expr("mention div 6").alias("k")).agg(F.max_by("rung", "step").alias("rung"))
    home = tables["mention"].withColumn("k", F.expr("mention div 6")).groupBy("k").agg(F.max_by("uid", "mention").alias("uid"), F.countDistinct("uid").cast("int").alias("animals"))
    return log.join(home, "k").select("k", "rung", "uid", "animals")


@query("""
SELECT rung, sum(n)::BIGINT AS n FROM (
  SELECT 'created' AS rung, count(*) AS n FROM customer UNION ALL SELECT CASE c_custkey % 3 WHEN 0 THEN 'registration' WHEN 1 THEN 'dna' ELSE 'created' END, count(*) FROM customer GROUP BY 1) GROUP BY 1""")
def resolve_stats(spark, d):
    """How many records each rung took: each customer comes twice, joined by registration, by a case, or not at all."""
    c = spread(table(spark, d, "customer"), "c_custkey")
    key, kind = F.col("c_custkey").cast("string"), F.col("c_custkey") % 3
    case = F.when(kind == 1, F.array(F.concat(F.lit("NEO"), key)))
    one = as_records(c, F.col("c_custkey"), association=F.lit("CHIA"), regNumber=key, dna_cases=case, sex=F.lit("M"))
    two = as_records(c, F.col("c_custkey") + 10_000_000, association=F.when(kind == 0, "CHIA").otherwise("MAINE"), regNumber=key, dna_cases=case, sex=F.lit("M"))
    return resolve.stats(resolve.replay(one.unionByName(two)))


def _herd(spark, d) -> dict[str, DataFrame]:
    """Customers as animals, their orders as registrations, brands as breeds, ship states as defects, and the lines of
    ``key div 2`` and ``key div 3``."""
    c, o = table(spark, d, "customer"), table(spark, d, "orders")
    animal = c.select(
        F.col("c_custkey").cast("string").alias("uid"), none("string").alias("intl_id"), F.col("c_name").alias("name"), F.concat(F.lit("N "), F.col("c_nationkey").cast("string"), F.lit(" "), "c_mktsegment").alias("name_norm"),
        F.when(F.col("c_mktsegment") == "FURNITURE", "S").otherwise("F").alias("sex"), F.concat(F.lit("2001-02-"), F.lpad((F.floor(F.abs("c_acctbal")) % 28 + 1).cast("string"), 2, "0")).alias("dob"), none("string").alias("tattoo"), F.when(F.col("c_custkey") % 4 > 0, F.col("c_mktsegment")).alias("color"), none("string").alias("horn_status"),
    )
    uid = F.col("o_custkey").cast("string").alias("uid")
    registration = o.select(F.col("o_orderpriority").alias("association"), F.col("o_orderkey").cast("string").alias("regNumber"), uid, *(none("string").alias(x) for x in ("name_as_recorded", "breeder", "owner", "epds", "attributes", "source_url", "scraped_at")), (F.col("o_orderstatus") == "P").alias("stub"), none("boolean").alias("via_cross_ref"))
    breed = o.select(uid, F.col("o_orderstatus").alias("breed"), F.lit(50.0).alias("percent")).distinct()
    defect = o.groupBy(uid, F.col("o_orderstatus").alias("code")).agg(F.lit("Free").alias("status"))
    dna = o.where("o_orderkey % 9 = 0").select(F.concat(F.lit("AGI"), F.col("o_orderkey").cast("string")).alias("case_id"), uid)
    keys = c.select(F.col("c_custkey").alias("k"))
    lines = [keys.select(F.col("k").cast("string").alias("child_uid"), F.expr(f"k div {n}").cast("string").alias("parent_uid"), F.lit(role).alias("role")).where(f"k div {n} >= 1") for n, role in ((2, "SIRE"), (3, "DAM"))]
    made = {"animal": animal, "registration": registration, "animal_breed": breed, "animal_defect": defect, "animal_dna": dna, "parentage": lines[0].unionByName(lines[1])}
    return {name: made[name].select(*(x.strip().split(" ")[0] for x in ddl.split(","))) for name, ddl in TABLES.items()}


@query("""
WITH r AS (SELECT o_custkey AS k, count(*) AS registrations, min(o_orderpriority || ':' || o_orderkey) AS first FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1),
b AS (SELECT o_custkey AS k, string_agg(DISTINCT o_orderstatus, ',' ORDER BY o_orderstatus) AS breeds FROM orders GROUP BY 1), n AS (SELECT o_custkey AS k, count(*) AS cases FROM orders WHERE o_orderkey % 9 = 0 GROUP BY 1)
SELECT c_custkey AS k, c_name AS name, registrations, breeds, breeds AS defects, cases, CASE WHEN c_custkey >= 3 THEN 'DAM:' || c_custkey // 3 || ',SIRE:' || c_custkey // 2 WHEN c_custkey = 2 THEN 'SIRE:1' END AS parents
FROM customer LEFT JOIN r ON r.k = c_custkey LEFT JOIN b ON b.k = c_custkey LEFT JOIN n ON n.k = c_custkey""")
def animal_profiles(spark, d):
    """Every animal with what hangs on it, stub registrations left out."""
    found = graph.profile(_herd(spark, d))
    words = lambda c, *f: F.array_join(F.transform(c, lambda x: F.concat_ws(":", *(x[y] for y in f))), ",")
    return found.select(long("uid").alias("k"), "name", long(F.size("registrations")).alias("registrations"), words("breeds", "breed").alias("breeds"), words("defects", "code").alias("defects"), long(F.size("cases")).alias("cases"), words("parents", "role", "parent_uid").alias("parents")).withColumn(
        "registrations", F.when(F.col("registrations") >= 0, F.col("registrations"))
    ).withColumn("cases", F.when(F.col("cases") >= 0, F.col("cases")))


@query("""
SELECT c_custkey AS k, c_name AS name, (SELECT count(*) FROM orders WHERE o_custkey = 17 AND o_orderstatus <> 'P') AS registrations, '5,8' AS parents FROM customer WHERE c_custkey = 17""")
def get_animal(spark, d):
    found = Herd(_herd(spark, d)).get_animal("17")
    return found.select(long("uid").alias("k"), "name", long(F.size("registrations")).alias("registrations"), F.array_join(F.transform("parents", lambda x: x["parent_uid"]), ",").alias("parents"))


@query("""
SELECT c_custkey AS k, c_name AS name, string_agg(DISTINCT o_orderpriority, ',' ORDER BY o_orderpriority) AS associations FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2 HAVING count(DISTINCT o_orderpriority) > 1 ORDER BY name, k::VARCHAR LIMIT 200""")
def multi_association_names(spark, d):
    return Herd(_herd(spark, d)).multi_association().select(long("uid").alias("k"), "name", F.array_join("associations", ",").alias("associations"))


@query("""
WITH RECURSIVE lines AS (SELECT c_custkey AS child, c_custkey // 2 AS parent, 'SIRE' AS role FROM customer WHERE c_custkey // 2 >= 1 UNION ALL SELECT c_custkey, c_custkey // 3, 'DAM' FROM customer WHERE c_custkey // 3 >= 1),
up AS (SELECT parent AS k, 1 AS depth, role FROM lines WHERE child = 100 UNION ALL SELECT l.parent, depth + 1, l.role FROM up JOIN lines l ON l.child = k WHERE depth < 4)
SELECT k, depth, role, c_name AS name FROM up JOIN customer ON c_custkey = k""")
def herd_pedigree(spark, d):
    return Herd(_herd(spark, d)).pedigree("100", 4).select(long("uid").alias("k"), F.col("depth").cast("int").alias("depth"), "role", "name")


@query("""
SELECT 'uid' AS way, 17 AS k UNION ALL SELECT 'name', min(c_custkey) FROM customer WHERE contains(lower(c_name), 'er#00000001')
UNION ALL SELECT 'number', o_custkey FROM orders WHERE o_orderkey = (SELECT max(o_orderkey) FROM orders) UNION ALL SELECT 'none', NULL""")
def find_ways(spark, d):
    """A search by uid, by part of a name, by a registration number that is in no name and no uid, and for nothing."""
    herd = Herd({n: materialise(t, n) for n, t in _herd(spark, d).items()})
    last = str(table(spark, d, "orders").agg(F.max("o_orderkey")).first()[0])
    number = herd.tables["registration"].withColumn("regNumber", F.concat(F.lit("r-"), "regNumber"))
    found = [("uid", herd.find("17")), ("name", herd.find("ER#00000001")), ("number", graph.find(herd.tables["animal"], number, f"R-{last}")), ("none", herd.find("no such animal"))]
    out = None
    for way, rows in found:
        one = spark.range(1).select(F.lit(way).alias("way")).join(rows.select(long("uid").alias("k")), F.lit(True), "left")
        out = one if out is None else out.unionByName(one)
    return out


_RECONCILED = """
WITH a AS (SELECT c_custkey::VARCHAR AS uid, 'N ' || c_nationkey || ' ' || c_mktsegment AS name_norm, '2001-02-' || lpad((floor(abs(c_acctbal))::BIGINT % 28 + 1)::VARCHAR, 2, '0') AS dob, CASE WHEN c_custkey % 4 > 0 THEN c_mktsegment END AS color FROM customer),
m AS (SELECT uid, min(uid) OVER (PARTITION BY name_norm, dob) AS keep FROM a)
"""


@query(_RECONCILED + """
SELECT keep AS uid, count(DISTINCT m.uid) AS merged, first(color ORDER BY m.uid) FILTER (WHERE color IS NOT NULL) AS color, any_value(r.papers) AS papers, any_value(p.lines) AS lines FROM m JOIN a ON a.uid = m.uid
LEFT JOIN (SELECT keep AS k, count(*) AS papers FROM orders JOIN m ON m.uid = o_custkey::VARCHAR GROUP BY 1) r ON r.k = keep
LEFT JOIN (SELECT k, count(*) AS lines FROM (
  SELECT DISTINCT c.keep AS k, p.keep AS parent, role FROM (SELECT c_custkey::VARCHAR AS child, (c_custkey // 2)::VARCHAR AS parent, 'SIRE' AS role FROM customer WHERE c_custkey // 2 >= 1 UNION ALL SELECT c_custkey::VARCHAR, (c_custkey // 3)::VARCHAR, 'DAM' FROM customer WHERE c_custkey // 3 >= 1)
  JOIN m c ON c.uid = child JOIN m p ON p.uid = parent) GROUP BY 1) p ON p.k = keep GROUP BY 1""")
def reconciled(spark, d):
    """Animals of one name and birth date merged into the first: gaps filled, registrations and lines follow."""
    tables = {n: materialise(t, n) for n, t in _herd(spark, d).items()}
    merged = graph.reconcile(tables)
    papers = merged["registration"].groupBy("uid").agg(F.count("*").alias("papers"))
    lines = merged["parentage"].groupBy(F.col("child_uid").alias("uid")).agg(F.count("*").alias("lines"))
    twins = tables["animal"].groupBy("name_norm", "dob").agg(F.min("uid").alias("uid"), F.count("*").alias("merged"))
    return merged["animal"].select("uid", "color").join(twins.select("uid", "merged"), "uid").join(papers, "uid", "left").join(lines, "uid", "left")


@query("""
WITH s AS (SELECT c_custkey AS k FROM customer WHERE c_mktsegment = 'FURNITURE')
SELECT 'animal' AS "table", count(*) AS n FROM customer WHERE c_custkey NOT IN (FROM s) UNION ALL SELECT 'registration', count(*) FROM orders WHERE o_custkey NOT IN (FROM s)
UNION ALL SELECT 'parentage', count(*) FROM (SELECT c_custkey AS c, c_custkey // 2 AS p FROM customer WHERE c_custkey >= 2 UNION ALL SELECT c_custkey, c_custkey // 3 FROM customer WHERE c_custkey >= 3) WHERE c NOT IN (FROM s) AND p NOT IN (FROM s)
UNION ALL SELECT 'animal_dna', count(*) FROM orders WHERE o_orderkey % 9 = 0 AND o_custkey NOT IN (FROM s) UNION ALL SELECT 'animal_breed', count(*) FROM (SELECT DISTINCT o_custkey, o_orderstatus FROM orders WHERE o_custkey NOT IN (FROM s))
UNION ALL SELECT 'animal_defect', count(*) FROM (SELECT DISTINCT o_custkey, o_orderstatus FROM orders WHERE o_custkey NOT IN (FROM s))""")
def steers_deleted(spark, d):
    return graph.cardinalities(graph.without_steers(_herd(spark, d)))


@query("""
WITH RECURSIVE lines AS (SELECT c_custkey AS child, c_custkey // 2 AS parent FROM customer WHERE c_custkey // 2 >= 1 UNION ALL SELECT c_custkey, c_custkey // 3 FROM customer WHERE c_custkey // 3 >= 1),
up AS (SELECT c_custkey AS root, c_custkey AS uid, 0 AS depth FROM customer UNION ALL SELECT root, parent, depth + 1 FROM up JOIN lines ON child = uid WHERE depth < 4),
nodes AS (SELECT DISTINCT root, uid FROM (SELECT root, uid FROM up UNION ALL SELECT parent, child FROM lines)),
placed AS (SELECT *, row_number() OVER (PARTITION BY root ORDER BY uid <> root, uid) AS n FROM nodes)
SELECT root, uid FROM placed WHERE n <= 6""")
def subgraph_view(spark, d):
    """What a drawing of six nodes shows of the surroundings of every animal."""
    tables = _herd(spark, d)
    lines = materialise(tables["parentage"].select(long("child_uid").alias("child_uid"), long("parent_uid").alias("parent_uid"), "role"), "lines")
    return graph.view(graph.subgraph(lines, tables["animal"].select(long("uid").alias("uid")), 4)[0], 6)


@query("""
WITH lines AS (SELECT DISTINCT c_custkey // 2 AS root, c_custkey AS uid FROM customer WHERE c_custkey // 2 >= 1 UNION SELECT c_custkey // 3, c_custkey FROM customer WHERE c_custkey // 3 >= 1),
placed AS (SELECT *, row_number() OVER (PARTITION BY root ORDER BY uid) AS n FROM lines) SELECT root, uid FROM placed WHERE n <= 3""")
def kids_capped(spark, d):
    lines = _herd(spark, d)["parentage"]
    return graph.kids_shown(lines.select(long("child_uid").alias("child_uid"), long("parent_uid").alias("parent_uid")), 3)


@query(_RECONCILED + """SELECT name_norm, dob, count(*) AS copies FROM a WHERE NOT ends_with(dob, '-01-01') GROUP BY 1, 2 HAVING count(*) > 1 ORDER BY copies DESC, name_norm, dob LIMIT 50""")
def duplicate_groups_shown(spark, d):
    return Herd(_herd(spark, d)).duplicates().select("name_norm", "dob", "copies")


@query("""
WITH c AS (SELECT c_custkey AS k, c_custkey // 2 AS pair FROM customer), r AS (SELECT k, pair, min(k) OVER (PARTITION BY pair) AS first FROM c)
SELECT k AS seq, 'CHIA:' || first AS uid, CASE WHEN k = first THEN 'created' ELSE 'dna' END AS rung FROM r""")
def resolve_extended(spark, d):
    """A load of half of the records and one that adds the rest: customers in pairs that a case joins, every second pair
    over the seam."""
    c = table(spark, d, "customer")
    half = c.count() // 2 + 1
    key = F.col("c_custkey").cast("string")
    rows = as_records(c, F.col("c_custkey"), association=F.lit("CHIA"), regNumber=key, dna_cases=F.array(F.concat(F.lit("AGI"), F.expr("cast(c_custkey div 2 as string)"))), sex=F.lit("F"))
    index = BlockIndex(spark, workspace(spark, "index"))
    for batch, part in enumerate((F.col("seq") < half, F.col("seq") >= half)):
        index.add(rows.where(part).withColumnRenamed("seq", "at"), batch, ["at"])
    tables = index.tables(1)
    uid = tables["mention"].select(F.expr("mention div 3").alias("at"), "uid")
    # records are numbered as they come; their registration says which customer that was
    numbers = numbered(c.select(F.col("c_custkey").alias("seq")), ["seq"], "at")
    return uid.join(tables["log"].select(F.expr("mention div 3").alias("at"), "rung"), "at").join(numbers, "at").select("seq", "uid", "rung")


@query("""
SELECT c_custkey AS seq, 'record_start' AS type, 'CHIA:' || c_custkey AS detail FROM customer UNION ALL SELECT c_custkey, 'record_end', NULL FROM customer
UNION ALL SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'animal' ELSE 'merge' END, CASE WHEN c_custkey % 2 = 0 THEN 'created' ELSE 'intl_id' END FROM customer""")
def load_trace(spark, d):
    """What a load does, step by step: customers in pairs of one international id."""
    c = table(spark, d, "customer")
    rows = as_records(c, F.col("c_custkey"), association=F.lit("CHIA"), regNumber=F.col("c_custkey"), intl_id=F.concat(F.lit("I"), F.expr("cast(c_custkey div 2 as string)")), sex=F.lit("F"))
    return resolve.trace(rows, resolve.replay(rows)).select("seq", "type", "detail")


@query("""
WITH rules AS (
  SELECT DISTINCT 'n' || s_nationkey || '.example' AS host, s_suppkey % 3 = 0 AS allow, '/c/' || s_suppkey % 40 AS base, s_suppkey % 5 = 0 AS wild FROM supplier
  UNION ALL SELECT DISTINCT 'n' || s_nationkey || '.example', FALSE, '/c/1', FALSE FROM supplier),
urls AS (
  SELECT o_orderkey, 'n' || c_nationkey || '.example' AS host, '/c/' || o_custkey || '/o' || o_orderkey % 7 || CASE WHEN o_orderkey % 4 = 0 THEN 'x' ELSE '' END AS path
  FROM orders JOIN customer ON o_custkey = c_custkey),
met AS (
  SELECT o_orderkey, allow, row_number() OVER (PARTITION BY o_orderkey ORDER BY length(base) + CASE WHEN wild THEN 3 ELSE 0 END DESC, allow DESC) AS n
  FROM urls JOIN rules ON urls.host = rules.host AND starts_with(path, base) AND (NOT wild OR (ends_with(path, 'x') AND length(path) > length(base))))
SELECT o_orderkey, urls.host, path, coalesce(allow, TRUE) AS allowed FROM urls LEFT JOIN met USING (o_orderkey) WHERE coalesce(n, 1) = 1""")
def robots_rules(spark, d):
    """A robots.txt a nation, of its suppliers' rules, some with * and $, and the addresses of all orders."""
    s = table(spark, d, "supplier")
    rule = F.concat(F.when(F.col("s_suppkey") % 3 == 0, "Allow").otherwise("disallow "), F.lit(": /c/"), (F.col("s_suppkey") % 40).cast("string"), F.when(F.col("s_suppkey") % 5 == 0, "*x$ # wild").otherwise(""))
    host = F.concat(F.lit("N"), F.col("s_nationkey").cast("string"), F.lit(".example"))
    head = "User-Agent: other\nDisallow: /\n\nUser-agent: *\nUser-agent: none\r\nDisallow: /c/1\n"
    files = s.groupBy(host.alias("host")).agg(F.concat(F.lit(head), F.array_join(F.collect_list(rule), "\n")).alias("text"))
    places = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), F.concat(F.lit("n"), F.col("c_nationkey").cast("string"), F.lit(".example")).alias("host"))
    path = F.concat(F.lit("/c/"), F.col("o_custkey").cast("string"), F.lit("/o"), (F.col("o_orderkey") % 7).cast("string"), F.when(F.col("o_orderkey") % 4 == 0, "x").otherwise(""))
    asked = table(spark, d, "orders").join(places, "o_custkey").select("o_orderkey", "host", path.alias("path"))
    return robots.judged(asked, robots.for_agent(robots.rules(files), "Herdbot/2"))


# ---- progress and frontier


@query("""
WITH q AS (SELECT event_type, CASE WHEN user_id % 3 = 0 THEN 'done' ELSE 'pending' END AS status FROM events), c AS (SELECT event_type, count(*) FILTER (WHERE status = 'done') AS done, count(*) AS n FROM q GROUP BY 1)
SELECT event_type AS association, done, n - done AS pending, n AS processed, round(n / 3600.0 * 60, 1)::DOUBLE AS rate_per_min, round(done / n * 100, 1) AS pct FROM c""")
def heartbeats_written(spark, d):
    """Heartbeats written as a snapshot over an older one, and read back."""
    events = table(spark, d, "events").withColumnRenamed("event_type", "association")
    queue = events.select("association", F.when(F.col("user_id") % 3 == 0, "done").otherwise("pending").alias("status"))
    runs = events.groupBy("association").agg(F.count("*").alias("processed")).select("association", F.lit("running").alias("state"), none("string").alias("current"), "processed", F.lit(3600).alias("elapsed"))
    path = workspace(spark, "heartbeats")
    told = progress.heartbeats(queue, runs, F.lit("2024-01-01T00:00:00Z"))
    records.snapshot(told.limit(1), path)
    records.snapshot(told, path)
    back = records.read_snapshot(spark, path, "association string, counts map<string,bigint>, processed bigint, rate_per_min double, pct double")
    return back.select("association", F.col("counts")["done"].alias("done"), F.col("counts")["pending"].alias("pending"), "processed", "rate_per_min", "pct")


@query("""
WITH b AS (SELECT event_type AS association, user_id % 5 AS source, event_id, strftime(date_trunc('second', ts), '%Y-%m-%dT%H:%M:%SZ') AS u FROM events),
r AS (SELECT *, row_number() OVER (PARTITION BY association ORDER BY u DESC, source, event_id) AS n FROM b) SELECT association, source, event_id, u AS updated_at FROM r WHERE n = 1""")
def boards_merged(spark, d):
    """Boards of five publishers: the newest reading of each association counts."""
    at = F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    rows = table(spark, d, "events").select((F.col("user_id") % 5).alias("source"), F.struct("event_id", F.col("event_type").alias("association"), at.alias("updated_at")).alias("b"))
    # a publisher's board of an hour, as they come in: an array holds that and not all there ever was
    entries = rows.groupBy("source", F.substring("b.updated_at", 1, 13).alias("hour")).agg(F.array_sort(F.collect_list("b")).alias("boards"))
    return progress.merged_boards(entries).select("association", "source", "event_id", "updated_at")


@query("""SELECT max(event_id) FILTER (WHERE event_type = 'click') AS animals, strftime(date_trunc('second', max(ts) FILTER (WHERE event_type = 'click')), '%Y-%m-%dT%H:%M:%SZ') AS at FROM events""")
def graph_newest(spark, d):
    at = F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    entries = table(spark, d, "events").select((F.col("user_id") % 5).alias("source"), at.alias("publishedAt"), F.when(F.col("event_type") == "click", F.struct(F.col("event_id").alias("animals"))).alias("graph"))
    return progress.newest_graph(entries).select("graph.animals", F.col("publishedAt").alias("at"))


@query("""
SELECT animals, registrations, multi, polled, 'ok' AS state FROM (SELECT count(*) AS animals, count(*) FILTER (WHERE c_mktsegment = 'BUILDING') AS polled FROM customer), (SELECT count(*) AS registrations FROM orders WHERE o_orderstatus <> 'P'),
  (SELECT count(*) AS multi FROM (SELECT o_custkey FROM orders GROUP BY 1 HAVING count(DISTINCT o_orderpriority) > 1))""")
def graph_snapshot(spark, d):
    """The counts of a graph that may be published, without the loader's error text."""
    tables = _herd(spark, d)
    tables["animal"] = tables["animal"].withColumn("horn_status", F.when(F.col("name_norm").endswith("BUILDING"), "Polled"))
    shown = progress.graph_snapshot(tables, F.lit("2024-01-01T00:00:00Z"), F.lit("connection refused: bolt://secret"))
    return shown.select("animals", "registrations", "multi", "polled", F.when(F.col("error").isNull() | (F.col("error") == "error"), "ok").alias("state"))


@query("""WITH h AS (SELECT event_type AS association, epoch(date_trunc('hour', ts))::BIGINT AS t, count(*) AS n FROM events GROUP BY 1, 2), s AS (SELECT t, sum(n)::BIGINT AS n FROM h GROUP BY 1) SELECT t, n FROM s ORDER BY t DESC LIMIT 24""")
def trend_table(spark, d):
    hours = table(spark, d, "events").groupBy((F.expr("unix_timestamp(cast(ts as timestamp)) div 3600") * 3600).alias("t")).agg(F.count("*").alias("n"))
    return progress.trend(hours)


@query("""
SELECT page_id, url FROM pages WHERE url IS NOT NULL AND NOT (starts_with(url, 'https://') AND NOT starts_with(url, 'https://m.')) OR url IS NULL""")
def url_rules(spark, d):
    """Addresses that the longest fitting rule doesn't forbid."""
    rules = spark.createDataFrame([("https://", False), ("https://m.", True), ("http", True), ("ftp://x", False)], "prefix string, allow boolean")
    return frontier.allowed(table(spark, d, "pages").select("page_id", "url"), rules, F.col("url"))


@query("""
WITH b AS (SELECT event_type AS association, count(*) AS done FROM events GROUP BY 1)
SELECT 'kept' AS board, association, done FROM b UNION ALL SELECT 'filled', association, done FROM b
UNION ALL SELECT 'renewed', association, done FROM (SELECT event_type AS association, count(*) AS done FROM events WHERE user_id % 2 = 0 GROUP BY 1)""")
def empty_board(spark, d):
    """Boards published over others and read back: an empty one doesn't replace one with readings, unless forced; others do."""
    full = table(spark, d, "events").groupBy(F.col("event_type").alias("association")).agg(F.count("*").alias("done"))
    empty, half = full.where("done < 0"), table(spark, d, "events").where("user_id % 2 = 0").groupBy(F.col("event_type").alias("association")).agg(F.count("*").alias("done"))
    boards = []
    for name, first, then, force in (("kept", full, empty, False), ("forced", full, empty, True), ("filled", empty, full, False), ("renewed", full, half, False)):
        path = workspace(spark, "board")
        for board, forced in ((first, True), (then, force)):
            records.replace_board(board, path, "association string, done bigint", forced)
        boards.append(records.read_snapshot(spark, path, "association string, done bigint").select(F.lit(name).alias("board"), "association", "done"))
    return reduce(DataFrame.union, boards)


@query("""
WITH q AS (SELECT o_custkey AS reg, max(o_orderkey % 7) AS p, min(o_orderkey) AS src FROM orders GROUP BY 1)
SELECT reg::VARCHAR AS reg_number, p AS priority, 'first ' || lpad(src::VARCHAR, 9, '0') AS discovered_from, CASE WHEN reg % 3 = 0 THEN 0 ELSE 2 END AS attempts FROM q""")
def frontier_reset(spark, d):
    """Seeds with where they were found, failed ones among them brought back."""
    rows = table(spark, d, "orders").select(F.lit("chia").alias("association"), F.col("o_custkey").cast("string").alias("reg_number"), (F.col("o_orderkey") % 7).cast("int").alias("priority"), F.concat(F.lit("first "), F.lpad(F.col("o_orderkey").cast("string"), 9, "0")).alias("discovered_from"))
    queue = frontier.seeded(records.empty_frontier(spark), rows)
    queue = queue.withColumn("attempts", F.lit(2)).withColumn("status", F.when(F.col("reg_number").cast("bigint") % 3 == 0, "failed").otherwise("done"))
    return frontier.reset(queue, "failed").select("reg_number", long("priority").alias("priority"), "discovered_from", "attempts")


@query("""SELECT event_type AS association, epoch(date_trunc('second', max(ts)))::BIGINT AS last, count(*) AS beats FROM events GROUP BY 1""")
def heartbeat_batches(spark, d):
    """The latest heartbeat of each association, from the windows that the alerting stream works out."""
    rows = table(spark, d, "events").select(F.col("event_type").alias("association"), F.col("ts").cast("timestamp").alias("at"))
    windows = history.stale(rows)
    return windows.groupBy("association").agg(F.max(F.unix_timestamp("last")).alias("last"), F.sum("beats").alias("beats"))
