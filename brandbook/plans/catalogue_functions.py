"""Queries that hold the scalar functions against SQL, over inputs made from the driver's tables."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from brandbook.functions import extract, norm
from brandbook.operators import progress
from brandbook.plans.registry import epoch, long, query
from brandbook.session import table
from brandbook.sources import records


def text(*parts: Column | str) -> Column:
    """Strings as they are and columns as text, one after another."""
    return F.concat(*(F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts))


@query("""SELECT o_orderkey, '2-HIGH ' || o_orderkey AS key, '' AS none, regexp_replace('a b/' || o_orderpriority || '.x', '[^A-Za-z0-9_.-]', '_', 'g') AS token FROM orders""")
def key_norm(spark, d):
    raw = text("  2-high ", F.col("o_orderkey"), "  ")
    return table(spark, d, "orders").select("o_orderkey", norm.key(raw).alias("key"), norm.key(F.lit(None).cast("string")).alias("none"), norm.safe_token(text("a b/", F.col("o_orderpriority"), ".x")).alias("token"))


@query("""
SELECT o_orderkey, CASE o_orderkey % 7 WHEN 0 THEN 'Free' WHEN 1 THEN 'Carrier' WHEN 2 THEN 'Suspect' WHEN 3 THEN 'Free' WHEN 4 THEN 'Free' WHEN 5 THEN 'Unknown' ELSE 'Unknown' END AS status,
  CASE o_orderkey % 7 WHEN 5 THEN 'Affected' END AS kept, CASE o_orderkey % 3 WHEN 0 THEN 'Horned' WHEN 1 THEN 'Scurred' END AS horn FROM orders""")
def status_words(spark, d):
    word = F.element_at(F.array(*map(F.lit, ["Carrier FREE", "carrier by test", " s ", "clear", "NORMAL", "A", "?"])), (F.col("o_orderkey") % 7 + 1).cast("int"))
    horn = F.element_at(F.array(*map(F.lit, ["HORNED bull", "scurs", "  "])), (F.col("o_orderkey") % 3 + 1).cast("int"))
    kept = norm.defect_status(word, preserve_affected=True)
    return table(spark, d, "orders").select("o_orderkey", norm.defect_status(word).alias("status"), F.when(F.col("o_orderkey") % 7 == 5, kept).alias("kept"), norm.horn(horn).alias("horn"))


@query("""
SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN 'about ' || o_orderkey WHEN 2 THEN strftime(o_orderdate, '%Y-%m-%d') END AS iso FROM orders""")
def date_words(spark, d):
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    kind = F.col("o_orderkey") % 4
    raw = F.when(kind == 0, F.date_format("o_orderdate", " M/d/yyyy ")).when(kind == 1, text("about ", F.col("o_orderkey"), " ")).when(kind == 2, day).otherwise("  ")
    return table(spark, d, "orders").select("o_orderkey", norm.iso_date(raw).alias("iso"))


@query("""
SELECT p_partkey, CASE WHEN p_size % 4 < 3 THEN 'MA' || (100000 + p_partkey) END AS reg, CASE WHEN p_size % 4 < 3 THEN upper(p_name) END AS name, CASE p_size % 4 WHEN 0 THEN 'T' || p_size WHEN 1 THEN 'T' || p_size END AS tattoo,
  CASE p_size % 4 WHEN 0 THEN 'AM:F,DD:S' WHEN 1 THEN '' WHEN 2 THEN 'MSUD:C' END AS defects FROM part""")
def ancestor_cells(spark, d):
    base = text(" MA", F.col("p_partkey") + 100000, "  ", F.upper("p_name"))
    kind = F.col("p_size") % 4
    cell = F.when(kind == 0, text(base, " [ T", F.col("p_size"), " ] -- AMFT DDS QQ")).when(kind == 1, text(base, "[T", F.col("p_size"), "]")).when(kind == 2, text(base, " -- MSUDCT")).otherwise(text("unknown ", F.col("p_name")))
    a = extract.ancestor(cell)
    defects = F.array_join(F.transform(a["defects"], lambda x: F.concat_ws(":", x["code"], x["status"])), ",")
    return table(spark, d, "part").select("p_partkey", a["regNumber"].alias("reg"), a["name"].alias("name"), a["tattoo"].alias("tattoo"), defects.alias("defects"))


@query("""
SELECT o_orderkey, 'AGI' || (10000 + o_orderkey % 50) || ',GNS77' || (100 + o_custkey % 7) || CASE WHEN o_orderkey % 2 = 0 THEN ',NEO-5555' ELSE '' END AS cases, 'GS 4444' || ',agi ' || (10000 + o_orderkey % 50) AS angus FROM orders""")
def dna_words(spark, d):
    number = F.col("o_orderkey") % 50 + 10000
    t = text("case agi ", number, " or GNS 77", F.col("o_custkey") % 7 + 100, " AGI", number, F.when(F.col("o_orderkey") % 2 == 0, " neo-5555").otherwise(" neo-555"), " XAGI 99999")
    angus = text("see agi ", number, ", GS 4444 and GNS 55555")
    return table(spark, d, "orders").select("o_orderkey", F.array_join(extract.dna_cases(t), ",").alias("cases"), F.array_join(extract.dna_cases(angus, angus=True), ",").alias("angus"))


@query("""
SELECT o_orderkey, o_orderpriority AS breeder, CASE WHEN o_orderkey % 2 = 0 THEN (20000 + o_orderkey)::VARCHAR ELSE 'F' || o_orderkey END AS reg, CASE o_orderkey % 4 WHEN 0 THEN 'M' WHEN 1 THEN 'F' WHEN 2 THEN 'S' END AS sex,
  'AM:F,CA:C' || CASE WHEN o_orderkey % 3 = 0 THEN ',D2:F' ELSE '' END AS defects, 20 AS owners, 'Owner 0' AS first_owner FROM orders""")
def angus_words(spark, d):
    k = F.col("o_orderkey")
    reg = F.when(k % 2 == 0, text("Reg: AAA #+", k + 20000)).otherwise("Reg: none")
    sex = F.element_at(F.array(*map(F.lit, ["Bull", "Heifer", "Steer", "Ox"])), (k % 4 + 1).cast("int"))
    t = text(reg, "\n", sex, "\nBreeder:  ", F.col("o_orderpriority"), "   Tattoo: x\n[ AMF-CAC-", F.when(k % 3 == 0, "D2F").otherwise("QQX"), " ]\nOwner(s):\n", F.array_join(F.transform(F.sequence(F.lit(0), F.lit(24)), lambda i: text(" Owner ", i, " ")), "\n"), "\nNext Block: y")
    defects = F.array_join(F.transform(extract.angus_defects(t), lambda x: F.concat_ws(":", x["code"], x["status"])), ",")
    owners = extract.angus_owners(t)
    return table(spark, d, "orders").select(
        "o_orderkey", extract.labelled(t, "Breeder").alias("breeder"), extract.angus_registration(t, text("F", k)).alias("reg"), extract.angus_sex(t).alias("sex"), defects.alias("defects"), F.size(owners).alias("owners"), owners[0].alias("first_owner")
    )


@query("""
SELECT event_id, CASE WHEN event_id % 4 = 0 THEN user_id WHEN event_id % 4 = 1 THEN 0 END::INTEGER AS retry, 'https://' || CASE WHEN event_id % 2 = 0 THEN 'chianina' ELSE 'redangus' END || '.digitalbeef.com/modules.php?op=modload&name=_animal&file=_animal&animal_registration=' || user_id AS url,
  CASE WHEN event_id % 4 = 3 THEN NULL ELSE 1000 + user_id END AS age FROM events""")
def headers_and_urls(spark, d):
    k, u = F.col("event_id") % 4, F.col("user_id")
    header = F.when(k == 0, text(" ", u)).when(k == 1, text("-", u)).when(k == 2, "Wed, 21 Oct 2015 07:28:00 GMT")
    said = F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss")
    iso = F.when(k == 0, said).when(k == 1, text(said, "Z")).when(k == 2, text(said, "+00:00")).otherwise("soon")
    return table(spark, d, "events").select("event_id", norm.retry_after(header).alias("retry"), norm.animal_url(F.when(F.col("event_id") % 2 == 0, "chia").otherwise("RED"), text(u)).alias("url"), long(norm.age_seconds(iso, epoch("ts") + 1000 + u)).alias("age"))


@query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 9 THEN '?' WHEN b < 1024 THEN printf('%.0fB', b) WHEN b < 1048576 THEN printf('%.1fK', b / 1024) WHEN b < 1073741824 THEN printf('%.1fM', b / 1048576) ELSE printf('%.1fG', b / 1073741824) END AS bytes,
  CASE WHEN o_orderkey % 11 = 10 THEN NULL WHEN x < 1 THEN greatest(1, floor(x * 24 + 0.5))::BIGINT || ' hr' WHEN x < 14 THEN floor(x + 0.5)::BIGINT || CASE WHEN floor(x + 0.5) = 1 THEN ' day' ELSE ' days' END WHEN x < 70 THEN printf('%.1f wks', x / 7) ELSE printf('%.1f mo', x / 30.44) END AS lasts,
  CASE WHEN o_orderkey % 11 = 10 THEN 'Never updated' ELSE 'Updated just now' END AS updated
FROM (SELECT o_orderkey, (CASE o_orderkey % 10 WHEN 0 THEN o_orderkey % 1024 WHEN 1 THEN o_orderkey * 1024 WHEN 2 THEN (o_orderkey % 4000 + 2048) * 1048576 ELSE 2048 END)::DOUBLE AS b, (CASE o_orderkey % 11 WHEN 0 THEN 0.25 WHEN 1 THEN 1.25 WHEN 2 THEN 13.25 WHEN 3 THEN 0.015625 WHEN 4 THEN 16.0 WHEN 5 THEN 121.76 ELSE o_orderkey % 13 + 1.25 END)::DOUBLE AS x FROM orders)""")
def sizes_and_spans(spark, d):
    k = F.col("o_orderkey")
    b = F.when(k % 10 == 0, k % 1024).when(k % 10 == 1, k * 1024).when(k % 10 == 2, (k % 4000 + 2048) * 1048576).when(k % 10 != 9, F.lit(2048))
    at = k % 11
    days = F.when(at == 10, None)
    for i, value in enumerate((0.25, 1.25, 13.25, 0.015625, 16.0, 121.76)):
        days = days.when(at == i, value)
    days = days.otherwise(k % 13 + 1.25)
    return table(spark, d, "orders").select("o_orderkey", norm.human_bytes(b).alias("bytes"), norm.duration(days).alias("lasts"), norm.updated(F.when(at != 10, 5)).alias("updated"))


@query("""
WITH s AS (SELECT o_custkey, min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders GROUP BY 1), r AS (SELECT *, (hi - lo) / 4.0 AS rough FROM s WHERE hi > lo), p AS (SELECT *, 10.0 ** floor(log10(rough)) AS power FROM r)
SELECT o_custkey, power * CASE WHEN rough / power <= 1 THEN 1 WHEN rough / power <= 2 THEN 2 WHEN rough / power <= 5 THEN 5 ELSE 10 END AS step, round(lo - (hi - lo) * 0.08, 4) AS low, round(hi + (hi - lo) * 0.08, 4) AS high, 0.0::DOUBLE AS none FROM p""")
def axis_ticks(spark, d):
    s = table(spark, d, "orders").groupBy("o_custkey").agg(F.min("o_totalprice").alias("lo"), F.max("o_totalprice").alias("hi")).where("hi > lo")
    low, high = norm.padded_domain(F.col("lo"), F.col("hi"))
    flat = norm.padded_domain(F.col("hi") - 1, F.col("hi") - 1)[0]
    return s.select("o_custkey", norm.tick_step(F.col("hi") - F.col("lo")).alias("step"), F.round(low, 4).alias("low"), F.round(high, 4).alias("high"), F.round(F.abs(flat - (F.col("hi") - 1)) - F.greatest(F.lit(1.0), (F.col("hi") - 1) * 0.08), 4).alias("none"))


@query("""
SELECT user_id, CASE WHEN done + pending > 0 THEN round(done * 1.0 / (done + pending) * 100, 1) ELSE 0 END AS pct, CASE WHEN elapsed > 0 THEN round(done * 1.0 / elapsed * 60, 1) ELSE 0 END AS rate
FROM (SELECT user_id, (count(*) FILTER (WHERE event_type = 'view'))::DOUBLE AS done, count(*) FILTER (WHERE event_type = 'click') AS pending, (sum(event_id) % 64)::DOUBLE AS elapsed FROM events GROUP BY 1)""")
def shares_and_rates(spark, d):
    count = lambda kind: F.count(F.when(F.col("event_type") == kind, 1))
    rows = table(spark, d, "events").groupBy("user_id").agg(count("view").alias("done"), count("click").alias("pending"), (F.sum("event_id") % 64).alias("elapsed"))
    return rows.select("user_id", norm.percent_done(F.col("done"), F.col("pending")).alias("pct"), norm.rate_per_minute(F.col("done"), F.col("elapsed")).alias("rate"))


@query("""
SELECT page_id, replace(replace(replace(replace(coalesce(url, ''), '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;') || '&lt;b&gt;&quot;' AS escaped,
  '10.0.0.' || (page_id % 256) || ',10.0.1.1' AS pinned, 'chianina_percent=' || (page_id % 100) AS percents FROM pages""")
def escapes_and_pins(spark, d):
    last = F.col("page_id") % 256
    pins = norm.pins(text(" Host.A=10.0.0.", last, ",10.0.1.1; junk other=", last, " "))
    pairs = F.create_map(F.lit("Chianina %"), text(F.col("page_id") % 100), F.lit("Name"), F.lit("x"), F.lit("Maine %"), F.lit(""))
    percents = F.array_join(F.transform(F.map_entries(norm.percent_keys(pairs)), lambda e: F.concat_ws("=", e["key"], e["value"])), ",")
    return table(spark, d, "pages").select("page_id", norm.escape_html(F.concat(F.coalesce("url", F.lit("")), F.lit('<b>"'))).alias("escaped"), F.array_join(pins["host.a"], ",").alias("pinned"), percents.alias("percents"))


@query("""
SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 'MAINE' WHEN p_partkey % 3 = 1 THEN 'SIMM' END AS other, CASE WHEN p_partkey % 3 < 2 THEN (400000 + p_partkey)::VARCHAR END AS reg, 3 AS statements, 'CREATE b' || p_partkey AS second FROM part""")
def footers_and_scripts(spark, d):
    k = F.col("p_partkey")
    who = F.when(k % 3 == 0, "American Maine-Anjou Association").when(k % 3 == 1, " american simmental association ").otherwise("American Chianina Association")
    found = F.get(extract.cross_registrations(text("<a onClick=\"PullUpAnimalDetail( '", k + 400000, "' , '", who, "')\">x</a>"), F.lit("chia")), F.lit(0))
    parts = records.statements(text("CREATE a; // one; two\n CREATE\n  b", k, ";\n\n; CREATE c"))
    return table(spark, d, "part").select("p_partkey", found["association"].alias("other"), found["regNumber"].alias("reg"), F.size(parts).alias("statements"), parts[1].alias("second"))


@query("""
SELECT event_id, CASE WHEN event_id % 5 = 0 THEN 'running' WHEN event_id % 5 = 1 THEN 'stopped' WHEN event_id % 5 = 2 THEN 'stopped' WHEN event_id % 5 = 3 THEN CASE WHEN user_id % 40 <= 20 THEN 'running' ELSE 'idle' END ELSE 'idle' END AS label, event_id % 5 <> 1 AND event_id % 5 <> 4 AND user_id % 600 < 300 AS loading FROM events""")
def state_labels(spark, d):
    k = F.col("event_id") % 5
    age = F.when(k == 3, F.col("user_id") % 40).otherwise(F.lit(400))
    label = progress.state_label(k == 0, k == 1, F.when(k == 2, "stopped").otherwise("running"), age)
    read_at = F.when(k != 4, F.date_format(F.timestamp_seconds(epoch("ts") - F.col("user_id") % 600), "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    return table(spark, d, "events").select("event_id", label.alias("label"), progress.loading(k != 1, read_at, epoch("ts")).alias("loading"))
