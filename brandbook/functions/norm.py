"""Normalisation rules as column expressions; nulls follow SQL unless a rule says otherwise."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from brandbook.schema import BREED_TOKENS, RECONCILE_WORDS, SEXES, SUBDOMAINS

SPACES = r"\s+"


def literal_map(values: dict[str, str]) -> Column:
    return F.create_map(*(F.lit(x) for pair in values.items() for x in pair))


def lookup(values: dict[str, str], key: Column) -> Column:
    """The value of ``key``, or null."""
    return F.try_element_at(literal_map(values), key)


def name(raw: Column) -> Column:
    """Upper case without a leading [herd prefix] and punctuation, spaces single; null becomes empty."""
    bare = F.upper(F.regexp_replace(F.coalesce(raw, F.lit("")), r"^\s*\[[^\]]*\]\s*", ""))
    return F.trim(F.regexp_replace(F.regexp_replace(bare, "[^A-Z0-9 ]", ""), SPACES, " "))


def key(raw: Column) -> Column:
    """Identifiers and registration numbers: trimmed upper case, null becomes empty."""
    return F.upper(F.trim(F.coalesce(raw, F.lit(""))))


def is_generic(normal: Column) -> Column:
    """Breed or foundation placeholders, not names of animals."""
    fraction = normal.rlike("^[0-9/ ]*(AN|MA|CA|SM|SH)( |$)") & ~normal.rlike("[A-Z]{3,}")
    return (normal == "") | normal.isin(BREED_TOKENS) | normal.contains(" X ") | fraction


def is_specific(normal: Column) -> Column:
    """Names that identify an animal by themselves: two tokens or more and a digit."""
    return ~is_generic(normal) & normal.rlike("[0-9]") & (F.size(F.split(normal, " ")) >= 2)


def is_reconcilable(normal: Column, dob: Column) -> Column:
    """The stricter filter of the reconcile report."""
    return normal.contains(" ") & ~normal.contains(" X ") & dob.isNotNull() & ~dob.endswith("-01-01") & ~normal.isin(RECONCILE_WORDS)


def defect_status(raw: Column, preserve_affected: bool = False) -> Column:
    """Free, Carrier, Suspect or Unknown; the order of tests matters ("CARRIER FREE" is Free). With
    ``preserve_affected`` an A result is kept as Affected instead of Unknown."""
    s = key(raw)
    free = s.contains("FREE") | s.contains("CLEAR") | s.contains("NORMAL") | s.startswith("F")
    out = F.when(free, "Free").when(s.contains("CARRIER") | s.startswith("C"), "Carrier").when(s.contains("SUSPECT") | s.startswith("S"), "Suspect")
    if preserve_affected:
        out = out.when(s.startswith("A"), "Affected")
    return out.otherwise("Unknown")


def horn(raw: Column) -> Column:
    v = F.lower(F.trim(F.coalesce(raw, F.lit(""))))
    return (
        F.when(v == "", None).when(v.startswith("horn"), "Horned").when(v.startswith("poll") | v.isin("p", "pp"), "Polled").when(v.startswith("scur"), "Scurred").otherwise(title(F.trim(raw)))
    )


def title(raw: Column) -> Column:
    """Upper case after anything that isn't a letter, lower case after a letter (``initcap`` only looks at spaces)."""
    runs = F.regexp_extract_all(raw, F.lit(r"(\p{L}+|\P{L}+)"), F.lit(1))
    return F.array_join(F.transform(runs, lambda r: F.concat(F.upper(F.substring(r, 1, 1)), F.lower(F.substring(r, 2, 1 << 30)))), "")


def sex(raw: Column) -> Column:
    return lookup(SEXES, F.upper(F.coalesce(raw, F.lit(""))))


def iso_date(raw: Column) -> Column:
    """M/D/YYYY to ISO; anything else, ISO or junk, stays as it is (trimmed)."""
    v = F.trim(raw)
    part = lambda i: F.regexp_extract(v, r"^(\d{1,2})/(\d{1,2})/(\d{4})$", i)
    return F.when(v == "", None).when(part(3) != "", F.concat_ws("-", part(3), F.lpad(part(1), 2, "0"), F.lpad(part(2), 2, "0"))).otherwise(v)


def retry_after(raw: Column) -> Column:
    """Seconds of a Retry-After header; dates and junk give null."""
    seconds = F.trim(raw).try_cast("int")
    return F.when(seconds < 0, 0).otherwise(seconds)


def safe_token(raw: Column) -> Column:
    return F.regexp_replace(raw, "[^A-Za-z0-9_.-]", "_")


def shard(raw: Column) -> Column:
    """Two hex digits that spread registrations over 256 folders."""
    return F.substring(F.sha1(raw.cast("binary")), 1, 2)


def animal_url(association: Column, reg: Column) -> Column:
    """The page of an animal; an unknown registry is an error."""
    code = F.upper(association)
    host = F.coalesce(lookup(SUBDOMAINS, code), F.raise_error(F.concat(F.lit("no site for registry "), code)))
    return F.concat(F.lit("https://"), host, F.lit(".digitalbeef.com/modules.php?op=modload&name=_animal&file=_animal&animal_registration="), reg)


def bag(json: Column, field: str) -> Column:
    """A field of a JSON object; malformed text gives null."""
    return F.try_variant_get(F.try_parse_json(json), f"$.{field}", "string")


def percent_keys(pairs: Column) -> Column:
    """'Chianina %' -> chianina_percent, for labels that end in %, values not empty."""
    chosen = F.map_filter(pairs, lambda k, v: k.endswith("%") & (v != ""))
    return F.transform_keys(chosen, lambda k, _: F.lower(F.replace(k, F.lit(" %"), F.lit("_percent"))))


def age_seconds(iso: Column, now: Column) -> Column:
    """Seconds from an ISO time (no zone: UTC) to ``now`` (epoch seconds); null if unreadable."""
    zoned = F.when(iso.rlike(r"(Z|[+-]\d\d:?\d\d)$"), iso).otherwise(F.concat(iso, F.lit("Z")))
    return now - F.unix_timestamp(F.try_to_timestamp(zoned))


def human_bytes(n: Column) -> Column:
    k = n.cast("double")
    return (
        F.when(n.isNull(), "?").when(k < 1024, F.format_string("%.0fB", k)).when(k < 1 << 20, F.format_string("%.1fK", k / 1024)).when(k < 1 << 30, F.format_string("%.1fM", k / (1 << 20))).otherwise(F.format_string("%.1fG", k / (1 << 30)))
    )


def ago(s: Column) -> Column:
    unit = lambda size, mark: F.concat(F.floor(s / size + 0.5).cast("string"), F.lit(mark + " ago"))
    return F.when(s < 10, "just now").when(s < 90, unit(1, "s")).when(s < 5400, unit(60, "m")).when(s < 172800, unit(3600, "h")).otherwise(unit(86400, "d"))


def updated(s: Column) -> Column:
    return F.when(s.isNull(), "Never updated").otherwise(F.concat(F.lit("Updated "), ago(s)))


def duration(days: Column) -> Column:
    whole = F.floor(days + 0.5)
    return (
        F.when(days.isNull(), None).when(days < 1, F.concat(F.greatest(F.lit(1), F.floor(days * 24 + 0.5)).cast("string"), F.lit(" hr")))
        .when(days < 14, F.concat(whole.cast("string"), F.when(whole == 1, " day").otherwise(" days")))
        .when(days < 70, F.format_string("%.1f wks", days / 7)).otherwise(F.format_string("%.1f mo", days / 30.44))
    )


def compact_number(n: Column) -> Column:
    k = n.cast("double")
    return F.when(F.abs(k) >= 1e6, F.format_string("%.2fM", k / 1e6)).when(F.abs(k) >= 1e3, F.format_string("%.1fk", k / 1e3)).otherwise(F.format_string("%.0f", k))


def tick_step(span: Column, wanted: int = 4) -> Column:
    """The step of 1, 2 or 5 times a power of ten that cuts ``span`` into about ``wanted`` parts."""
    rough = span / F.lit(float(wanted))
    power = F.pow(F.lit(10.0), F.floor(F.log10(rough)).cast("double"))
    share = rough / power
    return F.when(share <= 1, power).when(share <= 2, 2 * power).when(share <= 5, 5 * power).otherwise(10 * power)


def padded_domain(low: Column, high: Column, pad: float = 0.08) -> tuple[Column, Column]:
    """Ends 8 % beyond the data; never of zero width."""
    margin = F.when(high > low, (high - low) * pad).otherwise(F.greatest(F.lit(1.0), F.abs(high) * pad))
    return low - margin, high + margin


def percent_done(done: Column, pending: Column) -> Column:
    total = done + pending
    return F.when(total > 0, F.round(done / total * 100, 1)).otherwise(F.lit(0.0))


def rate_per_minute(processed: Column, elapsed: Column) -> Column:
    return F.when(elapsed > 0, F.round(processed / elapsed * 60, 1)).otherwise(F.lit(0.0))


def escape_html(raw: Column) -> Column:
    out = F.coalesce(raw, F.lit(""))
    for mark, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        out = F.replace(out, F.lit(mark), F.lit(entity))
    return out


def pins(raw: Column) -> Column:
    """'host=ip,ip other=ip' as a map of host to addresses."""
    entries = F.filter(F.split(F.trim(raw), r"[;\s]+"), lambda e: e.contains("="))
    pair = lambda e: F.struct(F.lower(F.split_part(e, F.lit("="), F.lit(1))), F.filter(F.split(F.split_part(e, F.lit("="), F.lit(2)), ","), lambda a: a != ""))
    return F.map_from_entries(F.transform(entries, pair))
