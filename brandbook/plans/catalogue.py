"""All queries over the driver tables by name, and their SQL.

The driver's tables hold no animals, so each operator runs on a relation of the same structure: customers as
animals, orders as registrations (their priority is the registry), lines as composition, events as readings.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from brandbook.functions import extract, norm
from brandbook.operators import frontier, graph, progress, resolve
from brandbook.plans.registry import ORACLE_SQL, QUERIES, epoch, long, query
from brandbook.schema import PARENT
from brandbook.session import materialise, table

__all__ = ["ORACLE_SQL", "QUERIES"]

# ---- scalar functions


@query(r"""SELECT p_partkey, trim(regexp_replace(regexp_replace(upper(p_name || ' #' || p_size), '[^A-Z0-9 ]', '', 'g'), '\s+', ' ', 'g')) AS name_norm FROM part""")
def norm_name_part(spark, d):
    raw = F.concat(F.lit("[ "), "p_brand", F.lit(" ] "), "p_name", F.lit(" #"), F.col("p_size").cast("string"))
    return table(spark, d, "part").select("p_partkey", norm.name(raw).alias("name_norm"))


_CLASSED = r"""
WITH named AS (SELECT CASE p_size % 5 WHEN 0 THEN 'ANGUS' WHEN 1 THEN 'AN X MA' WHEN 2 THEN upper(p_name) WHEN 3 THEN upper(p_name) || ' ' || p_size ELSE '1/2 AN' END AS raw FROM part),
normal AS (SELECT trim(regexp_replace(regexp_replace(raw, '[^A-Z0-9 ]', '', 'g'), '\s+', ' ', 'g')) AS n FROM named),
flags AS (SELECT n = '' OR n IN ('ANGUS', 'AN', 'MA') OR contains(n, ' X ') OR (regexp_matches(n, '^[0-9/ ]*(AN|MA|CA|SM|SH)( |$)') AND NOT regexp_matches(n, '[A-Z]{3,}')) AS generic, n FROM normal)
SELECT generic, NOT generic AND regexp_matches(n, '[0-9]') AND len(string_split(n, ' ')) >= 2 AS specific, count(*) AS n FROM flags GROUP BY 1, 2
"""


@query(_CLASSED)
def name_classes(spark, d):
    kind = F.col("p_size") % 5
    raw = F.when(kind == 0, "ANGUS").when(kind == 1, "AN X MA").when(kind == 2, F.upper("p_name")).when(kind == 3, F.concat(F.upper("p_name"), F.lit(" "), F.col("p_size").cast("string"))).otherwise("1/2 AN")
    rows = table(spark, d, "part").select(norm.name(raw).alias("n"))
    return rows.groupBy(norm.is_generic(F.col("n")).alias("generic"), norm.is_specific(F.col("n")).alias("specific")).agg(F.count("*").alias("n"))


@query("""SELECT CASE o_orderstatus WHEN 'F' THEN 'Free' ELSE 'Unknown' END AS status, count(*) AS n FROM orders GROUP BY 1""")
def status_norm(spark, d):
    rows = table(spark, d, "orders").select(norm.defect_status(F.col("o_orderstatus")).alias("status"))
    return graph.defect_distribution(rows)


@query("""
SELECT CASE WHEN starts_with(lower(p_type), 'poll') THEN 'Polled' WHEN starts_with(lower(p_type), 'scur') THEN 'Scurred'
  ELSE array_to_string(list_transform(regexp_extract_all(p_type, '([A-Za-z]+|[^A-Za-z]+)'), lambda r: upper(r[1:1]) || lower(r[2:])), '') END AS horn, count(*) AS n FROM part GROUP BY 1""")
def horn_norm(spark, d):
    return table(spark, d, "part").groupBy(norm.horn(F.col("p_type")).alias("horn")).agg(F.count("*").alias("n"))


@query("""SELECT CASE c_mktsegment WHEN 'BUILDING' THEN 'M' WHEN 'MACHINERY' THEN 'F' WHEN 'FURNITURE' THEN 'S' END AS sex, count(*) AS n FROM customer GROUP BY 1""")
def sex_map(spark, d):
    word = norm.lookup({"BUILDING": "bull", "MACHINERY": "Heifer", "FURNITURE": "STEER", "HOUSEHOLD": "ox"}, F.col("c_mktsegment"))
    return table(spark, d, "customer").groupBy(norm.sex(word).alias("sex")).agg(F.count("*").alias("n"))


@query("""
SELECT l_orderkey, CASE l_returnflag WHEN 'A' THEN 'AN' WHEN 'N' THEN 'MA' ELSE 'CA' END AS breed, round(sum(l_quantity + l_linenumber / 8.0), 4) AS percent, count(*) AS n FROM lineitem GROUP BY 1, 2""")
def makeup_parse(spark, d):
    breed = F.lower(norm.lookup({"A": "AN", "N": "MA", "R": "CA"}, F.col("l_returnflag")))
    item = F.concat((F.col("l_quantity") + F.col("l_linenumber") / 8.0).cast("decimal(12,3)").cast("string"), F.lit("% "), breed)
    text = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.concat_ws(" | ", F.collect_list(item)).alias("text"))
    rows = text.select("l_orderkey", F.explode(extract.genetic_makeup(F.col("text"))).alias("x")).select("l_orderkey", "x.breed", "x.percent")
    return rows.groupBy("l_orderkey", "breed").agg(F.round(F.sum("percent"), 4).alias("percent"), F.count("*").alias("n"))


@query("""
SELECT CASE l_returnflag WHEN 'A' THEN 'AM' WHEN 'N' THEN 'NH' ELSE 'PHA' END AS code, CASE l_linestatus WHEN 'F' THEN 'F' ELSE 'C' END AS status, count(*) AS n
FROM lineitem WHERE l_linenumber <> 3 GROUP BY 1, 2""")
def defect_codes(spark, d):
    locus = norm.lookup({"A": "AM", "N": "NH", "R": "PHA"}, F.col("l_returnflag"))
    token = F.concat(locus, F.when(F.col("l_linenumber") == 3, "ZZ").when(F.col("l_linestatus") == "F", "FT").otherwise("CT"))
    rows = table(spark, d, "lineitem").select(F.explode(extract.defect_codes(F.concat(F.lit(" XX "), token))).alias("x"))
    return rows.groupBy("x.code", "x.status").agg(F.count("*").alias("n"))


@query("""
WITH refs AS (SELECT o_custkey, o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'ANGUS' WHEN 'O' THEN 'MAINE' END AS association, 10000 + o_orderkey % 1000 AS n FROM orders)
SELECT association, n::VARCHAR AS reg, count(DISTINCT o_custkey) AS customers FROM refs WHERE association IS NOT NULL GROUP BY 1, 2""")
def registry_refs(spark, d):
    prefix = norm.lookup({"F": "AAA #", "O": "AMAA +", "P": "ZZZ "}, F.col("o_orderstatus"))
    text = F.concat(F.lit("see "), prefix, (10000 + F.col("o_orderkey") % 1000).cast("string"), F.lit(" and ACA #55555"))
    rows = table(spark, d, "orders").select("o_custkey", F.explode(extract.registry_refs(text, F.lit("CHIA"))).alias("r"))
    return rows.groupBy("r.association", F.col("r.regNumber").alias("reg")).agg(F.countDistinct("o_custkey").alias("customers"))


@query("""SELECT strftime(o_orderdate, '%Y-%m-%d') AS iso, count(*) AS n FROM orders GROUP BY 1""")
def iso_date(spark, d):
    return table(spark, d, "orders").groupBy(norm.iso_date(F.date_format("o_orderdate", "M/d/yyyy")).alias("iso")).agg(F.count("*").alias("n"))


@query(r"""
WITH links AS (SELECT page_id, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS href FROM pages)
SELECT page_id, count(*) AS links, min(href) AS first_href, max(href) AS last_href FROM links GROUP BY page_id""")
def href_registration(spark, d):
    hrefs = F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1))
    rows = table(spark, d, "pages").select("page_id", F.explode(hrefs).alias("href"))
    carried = rows.withColumn("reg", extract.href_registration(F.concat(F.lit("http://registry/modules.php?animal_registration="), F.call_function("url_encode", "href"))))
    decoded = F.call_function("url_decode", "reg")
    return carried.groupBy("page_id").agg(F.count("*").alias("links"), F.min(decoded).alias("first_href"), F.max(decoded).alias("last_href"))


@query("""SELECT event_type, json_extract_string(props, '$.k') AS k, count(*) AS n FROM events GROUP BY 1, 2""")
def json_bag(spark, d):
    return table(spark, d, "events").groupBy("event_type", norm.bag(F.col("props"), "k").alias("k")).agg(F.count("*").alias("n"))


@query("""SELECT substr(sha1(c_name), 1, 2) AS shard, count(*) AS n FROM customer GROUP BY 1""")
def sha_shard(spark, d):
    return table(spark, d, "customer").groupBy(norm.shard(F.col("c_name")).alias("shard")).agg(F.count("*").alias("n"))


@query("""
SELECT o_orderkey, CASE WHEN s < 10 THEN 'just now' WHEN s < 90 THEN s || 's ago' WHEN s < 5400 THEN floor(s / 60.0 + 0.5)::BIGINT || 'm ago' WHEN s < 172800 THEN floor(s / 3600.0 + 0.5)::BIGINT || 'h ago' ELSE floor(s / 86400.0 + 0.5)::BIGINT || 'd ago' END AS said,
  CASE WHEN p < 1000 THEN printf('%.0f', p) WHEN p < 1000000 THEN printf('%.1fk', p / 1000) ELSE printf('%.2fM', p / 1000000) END AS short
FROM (SELECT o_orderkey, o_orderkey * 37 % 200000 AS s, floor(o_totalprice / 100) * 100 + 32 AS p FROM orders)""")
def display_values(spark, d):
    return table(spark, d, "orders").select("o_orderkey", norm.ago(F.col("o_orderkey") * 37 % 200000).alias("said"), norm.compact_number(F.floor(F.col("o_totalprice") / 100) * 100 + 32).alias("short"))


# ---- projections, joins and aggregates of the graph


@query("""SELECT 'animals' AS what, count(*) AS n FROM customer UNION ALL SELECT 'registrations', count(*) FROM orders""")
def animals_count(spark, d):
    return graph.cardinalities({"animals": table(spark, d, "customer"), "registrations": table(spark, d, "orders")}).withColumnRenamed("table", "what")


@query("""
SELECT p.o_orderpriority AS association, count(o.o_orderkey) AS n FROM (SELECT DISTINCT o_orderpriority FROM orders UNION ALL SELECT 'NONE') p
LEFT JOIN orders o ON o.o_orderpriority = p.o_orderpriority AND o.o_orderstatus <> 'P' GROUP BY 1""")
def regs_per_assoc(spark, d):
    orders = table(spark, d, "orders")
    regs = orders.select(F.col("o_orderkey").alias("regNumber"), F.col("o_orderpriority").alias("association"), F.col("o_custkey").alias("uid"), (F.col("o_orderstatus") == "P").alias("stub"))
    animals = table(spark, d, "customer").select(F.col("c_custkey").alias("uid"), F.lit("F").alias("sex"))
    codes = regs.select("association").distinct().union(spark.range(1).select(F.lit("NONE")))
    return graph.per_association(graph.real_registrations(regs, animals), codes)


_MULTI = "SELECT o_custkey AS uid, string_agg(DISTINCT o_orderpriority, ',' ORDER BY o_orderpriority) AS associations FROM orders GROUP BY 1 HAVING count(DISTINCT o_orderpriority) > 1"


@query(_MULTI)
def multi_assoc(spark, d):
    regs = table(spark, d, "orders").select(F.col("o_custkey").alias("uid"), F.col("o_orderpriority").alias("association"))
    return graph.multi_association(regs).withColumn("associations", F.concat_ws(",", "associations"))


def _shares(spark, d) -> DataFrame:
    """Share of each brand in an order's quantity, in percent."""
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    brands = lines.join(table(spark, d, "part").select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
    by = brands.groupBy("l_orderkey", "p_brand").agg(F.sum("l_quantity").alias("q"))
    whole = lines.groupBy("l_orderkey").agg(F.sum("l_quantity").alias("total"))
    return by.join(whole, "l_orderkey").select(F.col("l_orderkey").alias("uid"), F.col("p_brand").alias("breed"), F.round(F.col("q") / F.col("total") * 100, 3).alias("percent"))


_SHARE_SQL = """
WITH by_brand AS (SELECT l_orderkey, p_brand, sum(l_quantity) AS q FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2),
whole AS (SELECT l_orderkey, sum(l_quantity) AS total FROM lineitem GROUP BY 1),
shares AS (SELECT l_orderkey AS uid, p_brand AS breed, round(q / total * 100, 3) AS percent FROM by_brand JOIN whole USING (l_orderkey))
"""


@query(_SHARE_SQL + "SELECT uid, o_orderpriority AS name, breed, percent FROM shares JOIN orders ON o_orderkey = uid WHERE breed = 'Brand#11' AND percent >= 20 ORDER BY percent DESC, name, uid LIMIT 200")
def breed_share(spark, d):
    orders = table(spark, d, "orders").select(F.col("o_orderkey").alias("uid"), F.col("o_orderpriority").alias("name"))
    return graph.by_breed(orders, _shares(spark, d), "Brand#11", 20.0)


@query(_SHARE_SQL + "SELECT uid, round(sum(percent), 1) AS total FROM shares GROUP BY 1")
def breed_total(spark, d):
    return graph.breed_totals(_shares(spark, d)).withColumn("total", F.round("total", 1))


@query("""
SELECT o_orderkey AS uid, o_orderpriority AS name FROM orders
WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_linenumber = 2 AND l_returnflag = 'R') ORDER BY name, uid LIMIT 200""")
def carriers(spark, d):
    orders = table(spark, d, "orders").select(F.col("o_orderkey").alias("uid"), F.col("o_orderpriority").alias("name"))
    tests = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("uid"), F.col("l_linenumber").cast("string").alias("code"), norm.defect_status(F.when(F.col("l_returnflag") == "R", "carrier").otherwise("free")).alias("status"))
    return graph.carriers(orders, tests, "2")


@query("""
WITH o AS (SELECT o_custkey, count(*) AS orders, string_agg(DISTINCT o_orderpriority, ',' ORDER BY o_orderpriority) AS priorities, round(max(o_totalprice), 2) AS top FROM orders GROUP BY 1),
l AS (SELECT o_custkey, count(*) AS lines FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1)
SELECT c_custkey, n_name, coalesce(orders, 0) AS orders, coalesce(priorities, '') AS priorities, top, coalesce(lines, 0) AS lines
FROM customer JOIN nation ON n_nationkey = c_nationkey LEFT JOIN o ON o.o_custkey = c_custkey LEFT JOIN l ON l.o_custkey = c_custkey""")
def profile(spark, d):
    orders = table(spark, d, "orders")
    o = orders.groupBy("o_custkey").agg(F.count("*").alias("orders"), F.concat_ws(",", F.array_sort(F.collect_set("o_orderpriority"))).alias("priorities"), F.round(F.max("o_totalprice"), 2).alias("top"))
    lines = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n"))  # before the join: rows don't multiply
    per = orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey")).groupBy("o_custkey").agg(F.sum("n").alias("lines"))
    rows = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("n_nationkey") == F.col("c_nationkey")).withColumnRenamed("c_custkey", "o_custkey").join(o, "o_custkey", "left").join(per, "o_custkey", "left")
    return rows.select(F.col("o_custkey").alias("c_custkey"), "n_name", F.coalesce("orders", F.lit(0)).alias("orders"), F.coalesce("priorities", F.lit("")).alias("priorities"), "top", F.coalesce("lines", F.lit(0)).alias("lines"))


@query("""SELECT p_name, p_brand, p_size, count(*) AS copies, string_agg(p_partkey, ',' ORDER BY p_partkey) AS uids FROM part GROUP BY 1, 2, 3 HAVING count(*) > 1""")
def dup_groups_a(spark, d):
    return graph.duplicate_groups(table(spark, d, "part"), ["p_name", "p_brand", "p_size"], uid="p_partkey").withColumn("uids", F.concat_ws(",", F.col("uids").cast("array<string>")))


@query(r"""
WITH named AS (SELECT p_partkey, trim(regexp_replace(regexp_replace(upper(p_name), '[^A-Z0-9 ]', '', 'g'), '\s+', ' ', 'g')) AS name_norm, '2000-' || lpad((p_size % 12 + 1)::VARCHAR, 2, '0') || '-01' AS dob FROM part)
SELECT name_norm, dob, count(*) AS copies, string_agg(p_partkey, ',' ORDER BY p_partkey) AS uids FROM named WHERE contains(name_norm, ' ') AND NOT contains(name_norm, ' X ') AND NOT ends_with(dob, '-01-01') GROUP BY 1, 2 HAVING count(*) > 1""")
def dup_preview_r(spark, d):
    dob = F.concat(F.lit("2000-"), F.lpad((F.col("p_size") % 12 + 1).cast("string"), 2, "0"), F.lit("-01"))
    rows = table(spark, d, "part").select(F.col("p_partkey").alias("uid"), norm.name(F.col("p_name")).alias("name_norm"), dob.alias("dob"))
    return graph.duplicate_groups(rows, ["name_norm", "dob"], norm.is_reconcilable(F.col("name_norm"), F.col("dob"))).withColumn("uids", F.concat_ws(",", F.col("uids").cast("array<string>")))


@query("""SELECT doc_id, min(doc_id) OVER (PARTITION BY text) AS keep FROM documents""")
def exact_dups_docs(spark, d):
    docs = table(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("h"))
    keep = materialise(docs.groupBy("h").agg(F.min("doc_id").alias("keep")), "keep")
    return docs.join(keep, F.coalesce(docs.h, F.lit("")) == F.coalesce(keep.h, F.lit(""))).select("doc_id", "keep")


@query("""
WITH dup AS (SELECT p_partkey, min(p_partkey) OVER (PARTITION BY p_name, p_brand, p_size) AS keep FROM part)
SELECT keep AS uid, count(*) AS lines, count(DISTINCT l_orderkey) AS orders FROM lineitem JOIN dup ON l_partkey = p_partkey GROUP BY 1""")
def merge_rewrite(spark, d):
    part = table(spark, d, "part").select(F.col("p_partkey").alias("uid"), "p_name", "p_brand", "p_size")
    groups = graph.duplicate_groups(part, ["p_name", "p_brand", "p_size"])
    pairs = groups.select(F.explode("uids").alias("a"), F.col("uids")[0].alias("b"))
    keep = materialise(graph.merged_pairs(pairs).where("uid <> keep"), "keep")
    lines = table(spark, d, "lineitem").join(keep, F.col("l_partkey") == F.col("uid"), "left").select(F.coalesce("keep", "l_partkey").alias("uid"), "l_orderkey")
    return lines.groupBy("uid").agg(F.count("*").alias("lines"), F.countDistinct("l_orderkey").alias("orders"))


@query("""
SELECT CASE WHEN c_custkey % 3 = 0 THEN c_custkey ELSE coalesce(n.c, c_custkey) END AS c_custkey, coalesce(new_bal, c_acctbal) AS c_acctbal, c_mktsegment
FROM customer LEFT JOIN (SELECT c_custkey AS c, c_acctbal + 1 AS new_bal FROM customer WHERE c_custkey % 2 = 0) n ON n.c = c_custkey""")
def graph_upsert(spark, d):
    old = table(spark, d, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    new = old.where("c_custkey % 2 = 0").select("c_custkey", (F.col("c_acctbal") + 1).alias("c_acctbal"), F.lit(None).cast("string").alias("c_mktsegment"))
    return graph.upsert(old, new, ["c_custkey"])


@query("""SELECT 'customer' AS "table", c_nationkey::VARCHAR AS key, count(*) AS n FROM customer GROUP BY 2 HAVING count(*) > 1""")
def constraint_check(spark, d):
    rows = table(spark, d, "customer").select(F.col("c_nationkey").alias("uid"))
    return graph.violations({"animal": rows}).withColumn("table", F.lit("customer"))


@query("""
SELECT * FROM (
  SELECT c_custkey AS uid, c_name AS name, 0 AS way FROM customer WHERE c_custkey::VARCHAR = '17'
  UNION ALL SELECT c_custkey, c_name, 1 FROM customer WHERE contains(lower(c_name), '17')) ORDER BY way, name, uid LIMIT 1""")
def search_one(spark, d):
    animals = table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("uid"), F.col("c_name").alias("name"))
    regs = table(spark, d, "orders").select(F.col("o_custkey").cast("string").alias("uid"), F.col("o_orderkey").cast("string").alias("regNumber"))
    return graph.find(animals, regs, "17").select(long("uid").alias("uid"), "name", F.lit(0).alias("way"))


# ---- pedigrees


def _lines(spark, d) -> DataFrame:
    """Sire is key / 2, dam key / 3, as far as those exist."""
    keys = table(spark, d, "customer").select(F.col("c_custkey").alias("child_uid"))
    lines = [keys.select("child_uid", F.expr(f"child_uid div {n}").alias("parent_uid"), F.lit(role).alias("role")) for n, role in ((2, "SIRE"), (3, "DAM"))]
    return materialise(lines[0].unionByName(lines[1]).where("parent_uid >= 1"), "lines")


_LINES_SQL = "lines AS (SELECT c_custkey AS child, c_custkey // 2 AS parent, 'SIRE' AS role FROM customer WHERE c_custkey // 2 >= 1 UNION ALL SELECT c_custkey, c_custkey // 3, 'DAM' FROM customer WHERE c_custkey // 3 >= 1)"


@query(f"""
WITH RECURSIVE {_LINES_SQL}, up AS (
  SELECT c_custkey AS root, parent AS uid, 1::BIGINT AS depth, role FROM customer JOIN lines ON child = c_custkey
  UNION ALL SELECT root, l.parent, depth + 1, l.role FROM up JOIN lines l ON l.child = up.uid WHERE depth < 5)
SELECT root, uid, depth, role, count(*) AS paths FROM up GROUP BY ALL""")
def pedigree_paths(spark, d):
    roots = table(spark, d, "customer").select(F.col("c_custkey").alias("uid"))
    return graph.pedigree(_lines(spark, d), roots, 5).groupBy("root", "uid", long("depth").alias("depth"), "role").agg(F.count("*").alias("paths"))


@query(f"""
WITH RECURSIVE {_LINES_SQL}, up AS (
  SELECT 100::BIGINT AS root, parent AS uid, 1::BIGINT AS depth, role, '100>' || parent AS path FROM lines WHERE child = 100
  UNION ALL SELECT root, l.parent, depth + 1, l.role, path || '>' || l.parent FROM up JOIN lines l ON l.child = up.uid WHERE depth < 5)
SELECT * FROM up""")
def pedigree_one(spark, d):
    lines = _lines(spark, d).select(F.col("child_uid").cast("string"), F.col("parent_uid").cast("string"), "role")
    return graph.pedigree_of(spark, lines, "100", 5).select(long("root").alias("root"), long("uid").alias("uid"), long("depth").alias("depth"), "role", F.array_join("path", ">").alias("path"))


_SUBGRAPH = f"""
WITH RECURSIVE {_LINES_SQL}, roots AS (SELECT c_custkey AS root FROM customer),
up AS (SELECT root, root AS uid, 0 AS depth FROM roots UNION ALL SELECT root, parent, depth + 1 FROM up JOIN lines ON child = uid WHERE depth < 4),
nodes AS (SELECT DISTINCT root, uid FROM (SELECT root, uid FROM up UNION ALL SELECT root, child FROM roots JOIN lines ON parent = root))
"""


@query(_SUBGRAPH + "SELECT root, n.uid AS child_uid, l.parent AS parent_uid, l.role FROM nodes n JOIN lines l ON l.child = n.uid JOIN nodes p USING (root) WHERE p.uid = l.parent")
def subgraph_distinct(spark, d):
    roots = table(spark, d, "customer").select(F.col("c_custkey").alias("uid"))
    return graph.subgraph(_lines(spark, d), roots, 4)[1]


_CLOSURE = """
WITH RECURSIVE keys AS (
  SELECT c_custkey AS m, 'A' || c_nationkey || ':' || floor(c_acctbal / 40)::BIGINT AS k FROM customer
  UNION ALL SELECT c_custkey, 'B' || c_mktsegment || ':' || floor(c_acctbal / 10)::BIGINT FROM customer),
least AS (SELECT k, min(m) AS a FROM keys GROUP BY k),
edges AS (SELECT DISTINCT m AS x, a AS y FROM keys JOIN least USING (k) WHERE m <> a),
both_ways AS (SELECT x, y FROM edges UNION SELECT y, x FROM edges),
reach AS (SELECT c_custkey AS m, c_custkey AS r FROM customer UNION SELECT reach.m, y FROM reach JOIN both_ways ON x = r)
SELECT m AS mention, min(r) AS entity FROM reach GROUP BY m"""


@query(_CLOSURE)
def resolve_closure(spark, d):
    customers = table(spark, d, "customer")
    bucket = lambda n: F.floor(F.col("c_acctbal") / n).cast("string")
    keys = F.array(F.concat(F.lit("A"), F.col("c_nationkey").cast("string"), F.lit(":"), bucket(40)), F.concat(F.lit("B"), "c_mktsegment", F.lit(":"), bucket(10)))
    return resolve.closure(customers.select(F.col("c_custkey").alias("mention"), F.explode(keys).alias("key")))


@query(r"""
WITH named AS (SELECT c_custkey, regexp_replace(n_name || ' ' || floor(c_acctbal / 5)::BIGINT || 'A', '[^A-Z0-9 ]', '', 'g') AS name_norm FROM customer JOIN nation ON c_nationkey = n_nationkey)
SELECT 'CHIA:' || min(c_custkey) AS uid, count(*) AS papers, name_norm FROM named GROUP BY name_norm""")
def resolve_replay(spark, d):
    """Customers as records; those of one nation and balance have the same name and birth date."""
    c = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    name = F.concat("n_name", F.lit(" "), F.floor(F.col("c_acctbal") / 5).cast("string"), F.lit("A"))
    none = lambda kind: F.lit(None).cast(kind)
    dam = F.struct(none("string").alias("intl_id"), F.lit("CHIA").alias("association"), F.expr("cast(c_custkey div 2 as string)").alias("regNumber"), none("string").alias("name")).cast(PARENT)
    records = c.select(
        F.col("c_custkey").alias("seq"), none("string").alias("intl_id"), F.lit("CHIA").alias("association"), F.col("c_custkey").cast("string").alias("regNumber"), name.alias("name"), F.lit("F").alias("sex"), F.lit("2001-02-03").alias("dob"),
        *(none("string").alias(x) for x in ("tattoo", "color", "horn_status", "breeder", "owner")), F.array(F.struct(F.lit("AN").alias("breed"), F.lit(100.0).alias("percent"))).alias("breed_composition"),
        F.array(F.struct(F.lit("TH").alias("code"), F.lit("F").alias("status"))).alias("defects"), none("array<string>").alias("dna_cases"), none("array<struct<association:string,regNumber:string>>").alias("cross_refs"),
        none("map<string,string>").alias("epds"), none("string").alias("attributes"), none(PARENT).alias("sire"), F.when(F.col("c_custkey") > 1, dam).alias("dam"), none("string").alias("source_url"), none("string").alias("scraped_at"),
    )
    tables = resolve.replay(records)
    return tables["registration"].groupBy("uid").agg(F.count("*").alias("papers")).join(tables["animal"].select("uid", "name_norm"), "uid")


# ---- frontier


@query("""
WITH RECURSIVE next AS (SELECT DISTINCT o_custkey AS a, (o_custkey * 7 + o_orderkey % 3) % (SELECT max(c_custkey) FROM customer) + 1 AS b FROM orders),
walk AS (SELECT c_custkey AS node, 0 AS depth FROM customer WHERE c_custkey < 5 UNION SELECT b, depth + 1 FROM walk JOIN next ON a = node WHERE depth < 3)
SELECT node, min(depth) AS depth FROM walk GROUP BY node""")
def frontier_bfs(spark, d):
    most = table(spark, d, "customer").agg(F.max("c_custkey")).first()[0]
    links = table(spark, d, "orders").select(F.col("o_custkey").alias("node"), ((F.col("o_custkey") * 7 + F.col("o_orderkey") % 3) % most + 1).alias("next")).distinct()
    return frontier.breadth_first(links, table(spark, d, "customer").where("c_custkey < 5").select(F.col("c_custkey").alias("node")), 3)


def _queue(spark, d) -> DataFrame:
    """Each user's page of an event type, pending, with its number of events as attempts."""
    rows = table(spark, d, "events").groupBy(F.upper("event_type").alias("association"), F.col("user_id").cast("string").alias("reg_number")).agg(F.count("*").cast("int").alias("attempts"))
    none = F.lit(None).cast("string")
    return rows.select("association", "reg_number", F.when(F.col("reg_number").endswith("7"), "done").otherwise("pending").alias("status"), (F.col("attempts") % 4).alias("depth"), (F.length("association") % 3).alias("priority"), "attempts", none.alias("last_error"), none.alias("discovered_from"), none.alias("updated_at"))


_QUEUE = """
WITH queue AS (
  SELECT upper(event_type) AS association, user_id::VARCHAR AS reg_number, CASE WHEN user_id % 10 = 7 THEN 'done' ELSE 'pending' END AS status, (count(*) % 4)::INTEGER AS depth, (length(event_type) % 3)::INTEGER AS priority, count(*)::INTEGER AS attempts
  FROM events GROUP BY event_type, user_id)
"""


@query(_QUEUE + "SELECT association, reg_number, depth, priority, attempts FROM queue WHERE status = 'pending' ORDER BY priority DESC, depth, attempts, association, reg_number LIMIT 25")
def frontier_pick(spark, d):
    return frontier.pick(_queue(spark, d), 25).select("association", "reg_number", "depth", "priority", "attempts")


@query(_QUEUE + """, new AS (SELECT DISTINCT 'ERROR' AS association, (user_id + 20)::VARCHAR AS reg_number, 2 AS p FROM events)
SELECT coalesce(q.association, n.association) AS association, coalesce(q.reg_number, n.reg_number) AS reg_number, coalesce(status, 'pending') AS status, coalesce(depth, 1)::INTEGER AS depth, greatest(coalesce(priority, 0), coalesce(p, 0))::INTEGER AS priority, coalesce(attempts, 0)::INTEGER AS attempts
FROM queue q FULL JOIN new n ON q.association = n.association AND q.reg_number = n.reg_number""")
def frontier_upsert(spark, d):
    seeds = table(spark, d, "events").select(F.lit("error").alias("association"), (F.col("user_id") + 20).cast("string").alias("reg_number"), F.lit(2).alias("priority"))
    return frontier.seeded(_queue(spark, d), seeds, 1).select("association", "reg_number", "status", "depth", "priority", "attempts")


@query(_QUEUE + """SELECT CASE WHEN status = 'done' THEN 'done' WHEN reg_number::BIGINT % 5 = 0 THEN 'skipped' WHEN reg_number::BIGINT % 3 = 0 THEN CASE WHEN attempts + 1 >= 12 THEN 'failed' ELSE 'pending' END ELSE status END AS status, count(*) AS n FROM queue GROUP BY 1""")
def queue_states(spark, d):
    q = _queue(spark, d)
    n = long("reg_number")
    outcomes = q.where("status <> 'done'").select("association", "reg_number", F.when(n % 5 == 0, "skipped").when(n % 3 == 0, "failed").otherwise("refused").alias("outcome"), F.lit("no answer").alias("error"))
    return frontier.status_counts(frontier.visited(q, outcomes, F.lit("2024-01-01T00:00:00Z"), 12))


@query(_QUEUE + "SELECT association, count(*) AS n FROM queue WHERE status = 'pending' GROUP BY 1")
def pending_counts(spark, d):
    return frontier.pending_by_association(_queue(spark, d))


@query(_QUEUE + "SELECT status, count(*) AS n FROM (SELECT CASE WHEN status = 'pending' AND association <> 'CLICK' THEN 'skipped' ELSE status END AS status FROM queue) GROUP BY 1")
def park_scope(spark, d):
    return frontier.status_counts(frontier.parked(_queue(spark, d), "click", F.lit("2024-01-01T00:00:00Z")))


@query("""SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')""")
def anti_seed(spark, d):
    urgent = table(spark, d, "orders").where("o_orderpriority = '1-URGENT'").select(F.lit("X").alias("association"), F.col("o_custkey").alias("reg_number"))
    return frontier.unknown(table(spark, d, "customer").select(F.lit("X").alias("association"), F.col("c_custkey").alias("reg_number")), urgent).select(F.col("reg_number").alias("c_custkey"))


@query("""SELECT c_custkey, c_name FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 300000)""")
def semi_exists(spark, d):
    return table(spark, d, "customer").join(table(spark, d, "orders").where("o_totalprice > 300000"), F.col("o_custkey") == F.col("c_custkey"), "left_semi").select("c_custkey", "c_name")


@query("""
WITH r AS (SELECT event_id, user_id, ts, event_type = 'error' AS refused, sum((event_type <> 'error')::INT) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS run FROM events),
s AS (SELECT event_id, user_id, CASE WHEN refused THEN sum(refused::INT) OVER (PARTITION BY user_id, run ORDER BY ts, event_id) ELSE 0 END AS streak FROM r)
SELECT event_id, streak::BIGINT AS streak, CASE WHEN streak > 0 THEN least(30 * streak, 300) ELSE 0 END::BIGINT AS wait, streak >= 5 AS stop FROM s""")
def backoff_streak(spark, d):
    rows = frontier.refusal_streaks(table(spark, d, "events"), "user_id", ["ts", "event_id"], F.col("event_type") == "error")
    return rows.select("event_id", long("streak").alias("streak"), long("wait").alias("wait"), "stop")


# ---- progress


@query("""SELECT event_type, event_id, user_id FROM (SELECT *, row_number() OVER (PARTITION BY event_type, user_id ORDER BY ts DESC, event_id) AS n FROM events) WHERE n = 1""")
def newest_wins(spark, d):
    return progress.newest(table(spark, d, "events"), ["event_type", "user_id"], "ts", "event_id").select("event_type", "event_id", "user_id")


@query("""
WITH RECURSIVE t AS (SELECT DISTINCT event_type, epoch(date_trunc('second', ts))::BIGINT AS t FROM events),
next AS (SELECT event_type, t, min(t) OVER (PARTITION BY event_type ORDER BY t RANGE BETWEEN 600 FOLLOWING AND UNBOUNDED FOLLOWING) AS nt FROM t),
kept AS (SELECT event_type, min(t) AS t FROM t GROUP BY 1 UNION ALL SELECT k.event_type, nt FROM kept k JOIN next n ON n.event_type = k.event_type AND n.t = k.t WHERE nt IS NOT NULL)
SELECT event_type, t FROM kept""")
def history_sample(spark, d):
    points = table(spark, d, "events").select("event_type", epoch("ts").alias("t"))
    return progress.sample(points, "event_type", "t")


@query("""
WITH p AS (SELECT DISTINCT epoch(date_trunc('second', ts))::BIGINT AS t FROM events), m AS (SELECT max(t) AS now FROM p),
s AS (SELECT t, CASE WHEN now - t <= 86400 THEN 600 WHEN now - t <= 1209600 THEN 3600 ELSE 21600 END AS step FROM p, m)
SELECT t FROM (SELECT max(t) AS t FROM s GROUP BY step, t // step) ORDER BY t DESC LIMIT 700""")
def history_compact(spark, d):
    points = table(spark, d, "events").select(epoch("ts").alias("t")).distinct()
    now = points.agg(F.max("t")).first()[0]
    return progress.compact(points, F.lit(now))


_HOURLY = "hourly AS (SELECT event_type AS association, epoch(date_trunc('hour', ts))::BIGINT AS t, count(*) AS n, sum(user_id % 7)::BIGINT AS m FROM events GROUP BY 1, 2)"


def _hourly(spark, d) -> DataFrame:
    rows = table(spark, d, "events").select("event_type", (F.expr("unix_timestamp(cast(ts as timestamp)) div 3600") * 3600).alias("t"), "user_id")
    return rows.groupBy(F.col("event_type").alias("association"), "t").agg(F.count("*").alias("n"), F.sum(F.col("user_id") % 7).alias("m"))


@query(f"""
WITH {_HOURLY}, grid AS (SELECT a.association, t.t FROM (SELECT DISTINCT association FROM hourly) a, (SELECT DISTINCT t FROM hourly) t),
held AS (SELECT g.t, last_value(n IGNORE NULLS) OVER w AS done, last_value(m IGNORE NULLS) OVER w AS pending FROM grid g LEFT JOIN hourly h USING (association, t) WINDOW w AS (PARTITION BY g.association ORDER BY g.t))
SELECT t, sum(coalesce(done, 0))::BIGINT AS done, sum(coalesce(pending, 0))::BIGINT AS pending FROM held GROUP BY t HAVING sum(coalesce(done, 0)) <> 0 OR sum(coalesce(pending, 0)) <> 0""")
def series_locf(spark, d):
    return progress.carried_forward(_hourly(spark, d).select("association", "t", F.col("n").alias("done"), F.col("m").alias("pending")))


@query(f"""
WITH {_HOURLY}, d AS (SELECT *, t - lag(t) OVER w AS gap, n - lag(n) OVER w AS more FROM hourly WINDOW w AS (PARTITION BY association ORDER BY t))
SELECT association, t, n, CASE WHEN gap > 0 THEN round(more / gap * 60, 6) END AS rate_per_min FROM d""")
def rate_delta(spark, d):
    return progress.rates(_hourly(spark, d).drop("m"), done="n", digits=6)


_BOARD = """
WITH b AS (SELECT event_type AS association, count(*) FILTER (WHERE user_id % 3 = 0) AS done, count(*) FILTER (WHERE user_id % 3 = 1) AS pending, count(*) FILTER (WHERE user_id % 3 = 2) AS failed, round(avg(value), 1) AS rate, strftime(max(ts), '%Y-%m-%dT%H:%M:%SZ') AS updated_at, epoch(date_trunc('second', max(ts)))::BIGINT AS u FROM events GROUP BY 1),
e AS (SELECT *, (SELECT max(epoch(date_trunc('second', ts)))::BIGINT + 30 FROM events) - u AS age, CASE WHEN rate > 0 THEN round(pending / rate / 60 / 24, 1) END AS eta FROM b)
"""


def _board(spark, d) -> DataFrame:
    events = table(spark, d, "events")
    when = lambda k: F.count(F.when(F.col("user_id") % 3 == k, 1))
    rows = events.groupBy(F.col("event_type").alias("association")).agg(when(0).alias("done"), when(1).alias("pending"), when(2).alias("failed"), F.round(F.avg("value"), 1).alias("rate_per_min"), F.date_format(F.max("ts"), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("updated_at"))
    now = events.agg(F.max(epoch("ts"))).first()[0] + 30
    lag = events.groupBy(F.col("event_type").alias("association")).agg(F.countDistinct("user_id").alias("registrations"), F.max(F.col("user_id") % 11).alias("behind")).where("association <> 'error'")
    return progress.boards(rows, lag, F.lit(now))


@query(_BOARD + """SELECT association, done, pending, failed, age AS "ageSec", age > 300 AS stale, eta AS "etaDays", graphed, behind
FROM e LEFT JOIN (SELECT event_type AS association, count(DISTINCT user_id) AS graphed, max(user_id % 11)::BIGINT AS behind FROM events WHERE event_type <> 'error' GROUP BY 1) USING (association)""")
def board_rows(spark, d):
    return _board(spark, d).select("association", "done", "pending", "failed", "ageSec", "stale", "etaDays", "graphed", "behind")


@query(_BOARD + """SELECT sum(done)::BIGINT AS done, sum(pending)::BIGINT AS pending, sum(failed)::BIGINT AS failed, (SELECT sum(x)::BIGINT FROM (SELECT max(user_id % 11) AS x FROM events WHERE event_type <> 'error' GROUP BY event_type)) AS behind, max(eta) AS "etaDaysOverall" FROM e""")
def board_summary(spark, d):
    return progress.totals(_board(spark, d))


@query(_BOARD + "SELECT association, sum(done)::BIGINT AS done, sum(pending)::BIGINT AS pending, sum(failed)::BIGINT AS failed FROM e GROUP BY ROLLUP (association)")
def totals_rollup(spark, d):
    return progress.rollup(_board(spark, d))


@query("""
SELECT c_nationkey AS association, least(real, loadable) AS written, greatest(loadable - least(real, loadable), 0) AS remaining, least(100.0, round(least(real, loadable) / loadable * 100, 1)) AS pct
FROM (SELECT c_nationkey, count(*) AS loadable, count(*) FILTER (WHERE c_acctbal > 0) AS real FROM customer GROUP BY 1)""")
def load_progress(spark, d):
    c = table(spark, d, "customer").withColumnRenamed("c_nationkey", "association")
    return progress.load_progress(graph.per_association(c.where("c_acctbal > 0")), graph.per_association(c))


@query("""
WITH f AS (SELECT o_orderpriority AS association, sum(o_orderkey % 500)::BIGINT AS size, sum(o_orderkey % 400)::BIGINT AS off, count(*) FILTER (WHERE o_orderstatus <> 'O') AS loaded FROM orders GROUP BY 1)
SELECT association, greatest(0, size - off) AS behind_bytes, CASE WHEN size <= off THEN 0 WHEN off > 0 AND loaded > 0 THEN floor((size - off) / (off / loaded)) END::BIGINT AS behind FROM f""")
def lag_estimate(spark, d):
    o = table(spark, d, "orders").groupBy(F.col("o_orderpriority").alias("association"))
    sizes = o.agg(F.sum(F.col("o_orderkey") % 500).alias("size"))
    offsets = o.agg(F.sum(F.col("o_orderkey") % 400).alias("offset"), F.count(F.when(F.col("o_orderstatus") != "O", 1)).alias("loaded"))
    return progress.file_lag(offsets, sizes).withColumn("behind", long("behind"))


@query("""
SELECT user_id, arg_min(event_id, (ts, event_id)) AS first_event, arg_max(event_type, (ts, event_id)) AS last_type, arg_min(event_type, (ts, event_id)) FILTER (WHERE event_type <> 'view') AS first_deed FROM events GROUP BY user_id""")
def first_last_fill(spark, d):
    order = F.struct("ts", "event_id")
    deed = F.when(F.col("event_type") != "view", order)
    return table(spark, d, "events").groupBy("user_id").agg(F.min_by("event_id", order).alias("first_event"), F.max_by("event_type", order).alias("last_type"), F.min_by("event_type", deed).alias("first_deed"))


@query("""SELECT DISTINCT a, b FROM (SELECT o_custkey AS a, o_orderkey % 50 AS b FROM orders UNION ALL SELECT c_custkey, c_custkey % 50 FROM customer)""")
def edge_union(spark, d):
    one = table(spark, d, "orders").select(F.col("o_custkey").alias("a"), (F.col("o_orderkey") % 50).alias("b"))
    return one.unionByName(table(spark, d, "customer").select(F.col("c_custkey").alias("a"), (F.col("c_custkey") % 50).alias("b"))).distinct()


@query("""
SELECT event_id, CASE WHEN event_type = 'error' THEN 'unexpected field: error' WHEN NOT regexp_matches(CASE WHEN user_id % 9 = 0 THEN 'x' ELSE 'CHIA' END, '^[A-Z]{2,10}$') THEN 'bad code' WHEN event_type = 'view' AND user_id % 2 = 0 THEN 'not a number: view' END AS error FROM events""")
def validate_payload(spark, d):
    value = F.when((F.col("event_type") == "view") & (F.col("user_id") % 2 == 0), "many").otherwise(F.col("value").cast("string"))
    payload = F.create_map(F.col("event_type"), value, F.lit("association"), F.when(F.col("user_id") % 9 == 0, "x").otherwise("CHIA"))
    types = ["association", "click", "purchase", "view", "signup", "login", "logout", "search", "scroll"]
    return table(spark, d, "events").select("event_id", progress.payload_error(payload, types, types[1:], "association").alias("error"))


@query("""
WITH s AS (SELECT event_type AS association, count(*) AS done, epoch(date_trunc('second', max(ts)))::BIGINT AS u FROM events GROUP BY 1), n AS (SELECT max(epoch(date_trunc('second', ts)))::BIGINT + 200 AS now FROM events)
SELECT association, CASE WHEN now - u > 300 THEN 'crawler silent' WHEN association = 'click' THEN 'unit is failed' END AS problem FROM s, n WHERE now - u > 300 OR association = 'click'
UNION ALL SELECT association, 'not yet in the graph' FROM s WHERE done > 5000""")
def health_report(spark, d):
    events = table(spark, d, "events")
    now = events.agg(F.max(epoch("ts"))).first()[0] + 200
    by = events.groupBy(F.col("event_type").alias("association"))
    crawl = by.agg((F.lit(now) - F.max(epoch("ts"))).alias("age")).select("association", F.lit(None).cast("string").alias("error"), "age", F.when(F.col("association") == "click", "failed").otherwise("active").alias("unit"))
    return progress.problems(crawl, by.agg(F.count("*").alias("behind")))


@query(_SHARE_SQL + f", multi AS ({_MULTI}) SELECT o_orderkey AS uid, o_custkey, breed, percent, associations FROM shares JOIN orders ON o_orderkey = uid JOIN multi m ON m.uid = o_custkey WHERE percent >= 50")
def flagship(spark, d):
    """Brand shares of half an order or more, for orders of customers with several priorities."""
    orders = table(spark, d, "orders").select(F.col("o_orderkey").alias("uid"), "o_custkey")
    multi = multi_assoc(spark, d).withColumnRenamed("uid", "o_custkey")
    return _shares(spark, d).where("percent >= 50").join(orders, "uid").join(multi, "o_custkey").select("uid", "o_custkey", "breed", "percent", "associations")
