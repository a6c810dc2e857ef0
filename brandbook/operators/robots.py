"""Rules of robots.txt files: parsed to a table, and which addresses they allow.

A file's groups are one or more user-agent lines and the rules after them; blank and unknown lines don't end a group. A
crawler obeys all groups that name it, or, if none does, those of ``*``. Of the rules that fit an address
the one with the longest path wins, of equally long ones an allow; ``*`` stands for any characters and a final ``$`` for
the end. Without a file, or a rule that fits, an address is allowed, and so is the file itself. Paths are compared as
they are written. (Readers that take a file's first fitting line differ where a shorter rule stands before a longer one.)

A file is one row, and its lines are looked at within it; addresses meet plain rules by equi-joins of host and beginning, and
only rules with ``*`` or ``$`` by host, so a host with very many addresses is split like any join's key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from brandbook.session import materialise

#: Of a longer file only so much is read, as crawlers do; the last line that is whole counts.
MOST_CHARS = 500 * 1024


def rules(files: DataFrame) -> DataFrame:
    """(host, agent, allow, path) of ``files(host, text)``, agents in lower case; rules without a path fit nothing and fall.
    Of a host's several files all count; a null text has no rules."""
    text = F.when(F.length("text") > MOST_CHARS, F.regexp_replace(F.substring("text", 1, MOST_CHARS), r"[^\r\n]*\z", "")).otherwise(F.col("text"))
    whole = files.select(F.lower("host").alias("host"), F.monotonically_increasing_id().alias("file"), F.regexp_replace(text, "^\ufeff", "").alias("text"))
    rows = whole.select("host", "file", F.posexplode(F.split("text", r"\r\n|\r|\n")).alias("at", "line"))
    bare = F.regexp_replace("line", "#.*", "")
    told = rows.select("host", "file", "at", F.lower(F.trim(F.regexp_extract(bare, r"^([^:]*):", 1))).alias("field"), F.trim(F.regexp_extract(bare, r"^[^:]*:(.*)$", 1)).alias("value"))
    told = materialise(told.where(F.col("field").isin("user-agent", "allow", "disallow")), "lines")
    in_file = Window.partitionBy("file").orderBy("at")
    opens = (F.col("field") == "user-agent") & (F.coalesce(F.lag("field").over(in_file), F.lit("")) != "user-agent")
    placed = told.withColumn("opens", opens.cast("int")).withColumn("group", F.sum("opens").over(in_file)).where(F.col("group") > 0)
    agents = placed.where("field = 'user-agent'").select("file", "group", F.lower("value").alias("agent")).distinct()
    paths = placed.where("field <> 'user-agent' and value <> ''").select("host", "file", "group", (F.col("field") == "allow").alias("allow"), F.col("value").alias("path"))
    return paths.join(agents, ["file", "group"]).select("host", "agent", "allow", "path").distinct()


def for_agent(table: DataFrame, agent: str) -> DataFrame:
    """(host, allow, path) that a crawler with the product name ``agent`` obeys."""
    own = agent.split("/")[0].strip().lower()
    named = table.where(F.col("agent") == own)
    others = table.where("agent = '*'").join(table.where(F.col("agent") == own).select("host").distinct(), "host", "left_anti")
    return named.unionByName(others).select("host", "allow", "path").distinct()


def pattern(path: Column) -> Column:
    """The regular expression of a rule's path with ``*`` or ``$``."""
    body = F.regexp_replace(path, r"\$\z", "")
    quoted = F.array_join(F.transform(F.split(body, r"\*"), lambda x: F.concat(F.lit("\\Q"), F.regexp_replace(x, r"\\E", r"\\E\\\\E\\Q"), F.lit("\\E"))), ".*")
    return F.concat(F.lit("(?s)\\A"), quoted, F.when(path.endswith("$"), F.lit("\\z")).otherwise(F.lit("")))


def judged(addresses: DataFrame, obeyed: DataFrame) -> DataFrame:
    """``addresses(host, path, ...)`` with ``allowed``, by rules as ``for_agent`` gives them. A null host or path is allowed."""
    wild = F.col("path").contains("*") | F.col("path").endswith("$")
    plain, other = materialise(obeyed.where(~wild), "plain"), obeyed.where(wild).select("host", "allow", F.length("path").alias("n"), pattern(F.col("path")).alias("pattern"))
    asked = materialise(addresses.select(F.lower("host").alias("_host"), F.col("path").alias("_path")).where("_host is not null and _path is not null").distinct(), "asked")
    lengths = plain.groupBy("host").agg(F.sort_array(F.collect_set(F.length("path"))).alias("lengths"))  # of one file's rules
    begun = asked.join(lengths, F.col("_host") == F.col("host")).where(F.length("_path") >= F.col("lengths")[0])
    begun = begun.select("_host", "_path", F.explode(F.filter("lengths", lambda n: n <= F.length("_path"))).alias("n"))
    fits = begun.withColumn("begun", F.expr("substring(_path, 1, n)")).join(plain, (F.col("_host") == F.col("host")) & (F.col("begun") == F.col("path"))).select("_host", "_path", "n", "allow")
    matched = asked.join(other, F.col("_host") == F.col("host")).where(F.expr("_path rlike pattern")).select("_host", "_path", "n", "allow")
    verdict = fits.union(matched).groupBy("_host", "_path").agg(F.max_by("allow", F.struct("n", "allow")).alias("_allow"))
    refused = verdict.where("not _allow and _path <> '/robots.txt'").select("_host", "_path", F.lit(False).alias("_ok"))
    on = (F.lower("host") == F.col("_host")) & (F.col("path") == F.col("_path"))
    return addresses.join(refused, on, "left").withColumn("allowed", F.coalesce("_ok", F.lit(True))).drop("_host", "_path", "_ok")
