"""Importance resampling towards a target distribution, with hashed n-grams from a position table.

Words of a text are exploded with their positions; a window per document takes the words that follow with ``lead()``, once
for each order, so each position gives its n-grams as columns, hashed into buckets. That position table (buckets only, no
words) is written once and read twice: grouped by bucket for the counts of the corpus, and joined with the gains of the
buckets, whose sum over a document is its weight. Gumbel noise from a hash of seed and id makes a draw without replacement
out of the largest scores.

How it scales: the texts are shuffled once, by row, before they are exploded, so the window needs no exchange of words; rows
are put in order before the explosion, so the window's sort finds its input sorted. Counts are partial in each task
and have one row a bucket after it; gains are one row a bucket, bounded by ``buckets``, and broadcast. Ranks are numbered
per range partition (``operators.ordered``). No group grows with the corpus in one task: a window is one text.

A row is told from others by a number from its place in the scan, which a repeated task gives again; a table whose order
changes when it is read again must be written first.

Edge cases: a null or empty text has no words, weight 0 and is never drawn (for ``least_words`` above 0); a null id is hashed
as an empty string and sorts first; repeated rows are rows of their own; of equal scores the smaller id is first, and of equal ids
the order is by weight and features, then arbitrary; a text of any length is taken whole; an empty corpus gives no rows, with an
empty target gains come from the corpus alone; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from brandbook.operators.ordered import numbered
from brandbook.session import materialise

SEED = "42"
ORDERS = 3
BUCKETS = 10_000
#: Documents of fewer words aren't drawn; of the others so many per cent are.
LEAST_WORDS, PER_CENT = 20, 5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words before A-Z are lower-cased: upper case counts, which splits texts at the same places.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def lowered(word: Column) -> Column:
    """``word`` with A-Z lower-cased. For ASCII words that is what ``lower`` does, much faster than ``translate``."""
    return F.when(F.octet_length(word) == F.char_length(word), F.lower(word)).otherwise(F.translate(word, UPPER, LOWER))


def positions(docs: DataFrame, text: str = "text", key: str | None = "doc_id", orders: int = ORDERS, buckets: int = BUCKETS) -> DataFrame:
    """(row, id, n_words, b1 .. b``orders``): per word position the buckets of the n-grams that start there, null where
    the text ends before; a text without words has one row without buckets."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), (F.col(key) if key else F.lit(None)).alias("id"), F.make_valid_utf8(F.col(text)).alias("text"))
    dealt = rows.repartition("row").sortWithinPartitions("row")
    words = dealt.select("row", "id", F.coalesce(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), F.array().cast("array<string>")).alias("words"))
    exploded = words.select("row", "id", F.size("words").alias("n_words"), F.posexplode_outer("words").alias("pos", "raw"))
    text_of_row = Window.partitionBy("row").orderBy("pos")
    words = exploded.select("row", "id", "n_words", "pos", lowered(F.col("raw")).alias("w0"))
    follow = words.select("*", *(F.lead("w0", k).over(text_of_row).alias(f"w{k}") for k in range(1, orders)))
    grams, gram = [], F.col("w0")
    for k in range(orders):
        gram = gram if not k else F.concat(gram, F.lit(" "), F.col(f"w{k}"))  # null beyond the end
        grams.append((F.crc32(gram.cast("binary")) % buckets).cast("int").alias(f"b{k + 1}"))
    return follow.select("row", "id", "n_words", *grams)


def _buckets(table: DataFrame) -> Column:
    return F.array(*(F.col(c) for c in table.columns if c.startswith("b")))


def bucket_counts(table: DataFrame) -> DataFrame:
    """(bucket, n) of a position table."""
    return table.select(F.explode(_buckets(table)).alias("bucket")).where("bucket is not null").groupBy("bucket").agg(F.count("*").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, gain) from the counts of both: a thousand times the log of how much likelier the bucket is in the target,
    with one more feature in each bucket, rounded down."""
    s_all, t_all = (counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] for counts in (corpus, target))
    both = corpus.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    both = both.join(corpus.withColumnRenamed("n", "s"), "bucket", "left").join(target.withColumnRenamed("n", "t"), "bucket", "left").na.fill(0, ["s", "t"])
    s, t = F.col("s").cast("double"), F.col("t").cast("double")
    ratio = (t + 1) * F.lit(float(s_all + buckets)) / ((s + 1) * F.lit(float(t_all + buckets)))
    return both.select("bucket", F.floor(F.lit(1000.0) * F.ln(ratio)).cast("bigint").alias("gain"))


def noise(seed: str, key: Column) -> Column:
    """A thousandfold Gumbel variable from SHA-256, rounded down."""
    digits = F.substring(F.sha2(F.concat(F.lit(seed + ":"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"), 256), 1, 8)
    u = (F.conv(digits, 16, 10).cast("double") + F.lit(0.5)) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.ln(-F.ln(u))).cast("bigint")


def weigh(table: DataFrame, gain: DataFrame, seed: str = SEED) -> DataFrame:
    """(id, n_words, n_features, weight, score) of each row of a position table."""
    buckets = table.select("row", "id", "n_words", F.explode(_buckets(table)).alias("bucket"))
    joined = buckets.join(F.broadcast(gain), "bucket", "left")
    summed = joined.groupBy("row", "id", "n_words").agg(F.count("bucket").alias("n_features"), F.coalesce(F.sum("gain"), F.lit(0)).alias("weight"))
    return summed.select("id", "n_words", "n_features", "weight", (F.col("weight") + noise(seed, F.col("id"))).alias("score"))


def resample(
    docs: DataFrame, target: DataFrame, text: str = "text", key: str = "doc_id", target_text: str = "text", orders: int = ORDERS,
    buckets: int = BUCKETS, least_words: int = LEAST_WORDS, per_cent: int = PER_CENT, seed: str = SEED,
) -> DataFrame:
    """(``key``, n_features, weight, score, rank) of every document; rank is null for those that aren't drawn."""
    table = materialise(positions(docs, text, key, orders, buckets), "positions")
    corpus = materialise(bucket_counts(table), "corpus_buckets")
    wanted = materialise(bucket_counts(positions(target, target_text, None, orders, buckets)), "target_buckets")
    gain = materialise(gains(corpus, wanted, buckets), "gains")
    scored = materialise(weigh(table, gain, seed), "scored")
    open_rows = scored.where(F.col("n_words") >= least_words).withColumn("_down", -F.col("score"))
    drawn = per_cent * open_rows.count() // 100
    ranked = numbered(open_rows, ["_down", "id", "weight", "n_features"])
    rank = F.when(F.col("seq") < drawn, F.col("seq") + 1).cast("bigint").alias("rank")
    result = ["n_features", "weight", "score"]
    first = ranked.select(F.col("id").alias(key), *result, rank)
    rest = scored.where(F.col("n_words") < least_words).select(F.col("id").alias(key), *result, F.lit(None).cast("bigint").alias("rank"))
    return first.union(rest)


def drawn(docs: DataFrame, ranked: DataFrame, key: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` whose id was drawn; of rows with one id all, if one of them was. Ids are joined by sorting."""
    return docs.join(ranked.where("rank is not null").select(key).distinct().hint("merge"), key, "left_semi")


#: The same rows by SQL, with the production parameters; CRC-32 is worked out byte by byte, for each different feature once.
RESAMPLING_SQL = f"""
WITH texts AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
  UNION ALL
  SELECT -row_number() OVER () AS row, NULL, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark),
places AS (SELECT row, w, unnest(range(1, len(w) + 1)) AS i FROM texts),
features AS (
  SELECT row, f FROM (SELECT row, array_to_string(w[i:i + k - 1], ' ') AS f, i + k - 1 <= len(w) AS whole FROM places, (SELECT unnest(range(1, {ORDERS} + 1)) AS k))
  WHERE whole),
crc AS (
  SELECT list_transform(range(0, 256), lambda n: list_reduce(list_prepend(n, [0, 0, 0, 0, 0, 0, 0, 0]),
    lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS step),
hashed AS (
  SELECT f, xor(list_reduce(list_prepend(4294967295, list_transform(range(0, strlen(f)), lambda j: ('0x' || substr(hex(encode(f)), 2 * j + 1, 2))::BIGINT)),
    lambda c, b: xor(c >> 8, step[(xor(c, b) & 255) + 1])), 4294967295) % {BUCKETS} AS bucket
  FROM (SELECT DISTINCT f FROM features), crc),
found AS (SELECT row, bucket FROM features JOIN hashed USING (f)),
counts AS (SELECT bucket, count(*) FILTER (row > 0) AS s, count(*) FILTER (row < 0) AS t FROM found GROUP BY bucket),
gains AS (
  SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * ((sum(s) OVER ()) + {BUCKETS})::DOUBLE / ((s + 1)::DOUBLE * ((sum(t) OVER ()) + {BUCKETS})::DOUBLE)))::BIGINT AS gain
  FROM counts),
weights AS (SELECT row, count(*) AS n_features, sum(gain)::BIGINT AS weight FROM found JOIN gains USING (bucket) WHERE row > 0 GROUP BY row),
scored AS (
  SELECT row, doc_id, len(w) AS n, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
    (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('{SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5)::DOUBLE / 4294967296))))::BIGINT AS score
  FROM texts LEFT JOIN weights USING (row) WHERE row > 0),
ranked AS (SELECT row, row_number() OVER (ORDER BY score DESC, doc_id NULLS FIRST, weight, n_features) AS r, count(*) OVER () AS many FROM scored WHERE n >= {LEAST_WORDS})
SELECT doc_id, n_features, weight, score, CASE WHEN r <= {PER_CENT} * many // 100 THEN r END::BIGINT AS rank FROM scored LEFT JOIN ranked USING (row)
"""
