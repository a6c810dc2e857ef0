"""Fill-in-the-middle: a text cut at two drawn places and put together again as prefix, suffix, middle.

The cutting is SQL: DuckDB runs inside ``mapInArrow``, each batch is registered as a table, and one statement
splits texts into units, draws the cuts, slices and joins. Rows enter and leave as Arrow; no Python code
sees a single row. Batches are taken in slices of bounded bytes, so DuckDB holds a few megabytes of text or one
document; it has one thread a task and no spill folder.

Units are ``[white space]*[others]+`` or a white space run at the end, so they spell the text. All that is drawn comes
from the SHA-256 of seed and id, so a repeated task gives the same rows. A text holding a mark is left plain,
since a reader couldn't tell its mark from ours; ``restored`` takes any output apart again.

Edge cases: a null text is empty, an empty one is plain with 0 units; a null id is drawn as an empty string; bytes
that aren't UTF-8 are replaced as Spark does; repeated rows give equal rows; an empty table gives no rows; the needs of a
text grow with its length alone; a kept column named like a result is refused.
"""

from __future__ import annotations

import duckdb
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from brandbook.llm.arrow import carried, field, slices, uncarried, without_scan

SEED = "42"
#: Per cent of texts that are cut, and per cent of those with the suffix in front.
CUT, SUFFIX_FIRST = 50, 80
#: Before prefix, suffix and middle.
MARKS = ("<P>", "<S>", "<M>")
UNIT = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"
RESULTS = {"n": "bigint", "form": "string", "prefix_chars": "bigint", "middle_chars": "bigint", "output": "string"}


def statement(cut: int = CUT, suffix_first: int = SUFFIX_FIRST, marks: tuple[str, str, str] = MARKS, source: str = "batch") -> str:
    """The SQL over a table ``source(i, draw, text)``; ``draw`` is what is hashed."""
    p, s, m = ("'" + mark.replace("'", "''") + "'" for mark in marks)
    held = " OR ".join(f"contains(text, {mark})" for mark in (p, s, m))
    draws = ", ".join(f"('0x' || substr(digest, {8 * k + 1}, 8))::BIGINT AS h{k + 1}" for k in range(4))
    return f"""
WITH units AS (
  SELECT i, text, sha256(draw) AS digest, regexp_extract_all(text, '{UNIT}') AS unit FROM {source}),
draws AS (SELECT i, text, unit, len(unit) AS n, {draws} FROM units),
places AS (
  SELECT i, text, unit, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN text = '' OR {held} OR h3 % 100 >= {cut} THEN 'plain' WHEN h4 % 100 < {suffix_first} THEN 'spm' ELSE 'psm' END AS form
  FROM draws),
parts AS (
  SELECT i, text, n, form,
    CASE WHEN form <> 'plain' THEN coalesce(array_to_string(list_slice(unit, 1, a), ''), '') END AS prefix,
    CASE WHEN form <> 'plain' THEN coalesce(array_to_string(list_slice(unit, a + 1, b), ''), '') END AS middle,
    CASE WHEN form <> 'plain' THEN coalesce(array_to_string(list_slice(unit, b + 1, n), ''), '') END AS suffix
  FROM places)
SELECT n::BIGINT AS n, form, length(prefix)::BIGINT AS prefix_chars, length(middle)::BIGINT AS middle_chars,
  CASE form WHEN 'plain' THEN text
    WHEN 'psm' THEN {p} || prefix || {s} || suffix || {m} || middle
    ELSE {s} || suffix || {p} || prefix || {m} || middle END AS output
FROM parts ORDER BY i
"""


def _checked(marks: tuple[str, str, str]) -> None:
    firsts = {mark[:1] for mark in marks}
    if len(set(marks)) < 3 or "" in firsts or any(first in mark[1:] for first in firsts for mark in marks):
        raise ValueError("marks differ, and none may begin inside one, or outputs can't be taken apart")


def transform(
    docs: DataFrame, keep: list[str] | None = None, text: str = "text", key: str = "doc_id", cut: int = CUT,
    suffix_first: int = SUFFIX_FIRST, marks: tuple[str, str, str] = MARKS, seed: str = SEED,
) -> DataFrame:
    """The columns ``keep`` of ``docs`` (all but the text, unless given) with n (units), form (plain, psm or spm),
    prefix_chars, middle_chars (code points, null if plain) and output."""
    _checked(marks)
    kept = [c for c in docs.columns if c != text] if keep is None else keep
    if clash := set(kept) & set(RESULTS):
        raise ValueError(f"columns named like results: {sorted(clash)}")
    draw = F.concat(F.lit(seed + ":"), F.coalesce(F.col(key).cast("string"), F.lit("")))
    whole = docs.withColumn(text, F.make_valid_utf8(F.coalesce(F.col(text), F.lit(""))))
    rows, path = carried(whole, kept, text, draw.alias("draw"))
    sql = statement(cut, suffix_first, marks)

    def run(batches):
        with duckdb.connect(config={"threads": 1, "temp_directory": ""}) as engine:
            for received in batches:
                for batch in slices(received, path):
                    table = {"i": pa.array(range(batch.num_rows)), "draw": batch.column("draw"), "text": field(batch, path).cast(pa.string())}
                    engine.register("batch", pa.table(table))
                    made = engine.sql(sql).to_arrow_table()
                    engine.unregister("batch")
                    passed = [c for c in without_scan(batch) if c != "draw"]
                    columns = [*(batch.column(c) for c in passed), *(made.column(c).combine_chunks() for c in RESULTS)]
                    yield pa.RecordBatch.from_arrays(columns, names=[*passed, *RESULTS])

    schema = ([f"row {rows.schema['row'].dataType.simpleString()}"] if "row" in rows.columns else []) + [f"{n} {t}" for n, t in RESULTS.items()]
    return uncarried(rows.mapInArrow(run, ", ".join(schema)), *RESULTS)


def restored(output: str = "output", form: str = "form", marks: tuple[str, str, str] = MARKS) -> Column:
    """The text that an output was made from."""
    p, s, m = marks

    def parts(first: str, second: str) -> tuple[Column, Column, Column]:
        rest = F.substring(output, len(first) + 1, 1 << 30)
        tail = F.split_part(rest, F.lit(second), F.lit(2))
        return F.split_part(rest, F.lit(second), F.lit(1)), F.split_part(tail, F.lit(m), F.lit(1)), F.split_part(tail, F.lit(m), F.lit(2))

    prefix, suffix, middle = parts(p, s)
    psm = F.concat(prefix, middle, suffix)
    suffix, prefix, middle = parts(s, p)
    return F.when(F.col(form) == "psm", psm).when(F.col(form) == "spm", F.concat(prefix, middle, suffix)).otherwise(F.col(output))


def digest(rows: DataFrame) -> DataFrame:
    """``rows`` with the digests of output and restored text in place of the output."""
    hashed = [F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"), F.sha2(restored().cast("binary"), 256).alias("restored_sha256")]
    return rows.select(*(F.col(f"`{c}`") for c in rows.columns if c != "output"), *hashed)


#: The same rows by SQL, with the production parameters: each text is cut with string positions, not with lists.
INFILL_SQL = f"""
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('{SEED}:' || coalesce(doc_id::VARCHAR, '')) AS d,
    regexp_extract_all(coalesce(text, ''), '{UNIT}') AS u FROM documents),
drawn AS (
  SELECT *, len(u)::BIGINT AS n, ('0x' || substr(d, 1, 8))::BIGINT % (len(u) + 1) AS x, ('0x' || substr(d, 9, 8))::BIGINT % (len(u) + 1) AS y,
    CASE WHEN text = '' OR regexp_matches(text, '<[PSM]>') OR ('0x' || substr(d, 17, 8))::BIGINT % 100 >= {CUT} THEN 'plain'
      WHEN ('0x' || substr(d, 25, 8))::BIGINT % 100 < {SUFFIX_FIRST} THEN 'spm' ELSE 'psm' END AS form FROM docs),
sized AS (
  SELECT *, coalesce(list_sum(list_transform(u[1:least(x, y)], lambda v: length(v))), 0)::BIGINT AS a,
    coalesce(list_sum(list_transform(u[1:greatest(x, y)], lambda v: length(v))), 0)::BIGINT AS b FROM drawn),
made AS (
  SELECT *, CASE form WHEN 'plain' THEN text
    WHEN 'psm' THEN '<P>' || substr(text, 1, a) || '<S>' || substr(text, b + 1) || '<M>' || substr(text, a + 1, b - a)
    ELSE '<S>' || substr(text, b + 1) || '<P>' || substr(text, 1, a) || '<M>' || substr(text, a + 1, b - a) END AS output FROM sized)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(output) AS output_sha256, sha256(text) AS restored_sha256 FROM made
"""
