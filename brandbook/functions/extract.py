"""Facts picked out of text: composition, defect codes, ancestors, registry references, DNA cases."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from brandbook.functions.norm import key, lookup
from brandbook.schema import ASSOCIATION_NAMES, LOCI, PREFIXES, SUFFIXES

# Formats that pages print.
ANCESTOR = r"^([A-Z]{0,3}[0-9]{5,9})\s+(.+?)(?:\s*\[\s*([^\]]*)\s*\])?(?:\s*--\s*([A-Z0-9 ]+))?$"
REFERENCE = r"\b([A-Z]{2,5})\s*#?\+?\s*([0-9]{4,9})\b"
STATUS_LETTERS = {"F": "F", "C": "C", "A": "A"}


def _all(text: Column, pattern: str, group: int) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(pattern), F.lit(group))


def genetic_makeup(text: Column) -> Column:
    """'73.049% MA | 19.733% AN' as an array of (breed, percent)."""
    pattern = r"([0-9]+(?:\.[0-9]+)?)\s*%\s*([A-Za-z]{1,3})"
    return F.transform(F.arrays_zip(_all(text, pattern, 2).alias("b"), _all(text, pattern, 1).alias("p")), lambda x: F.struct(F.upper(x["b"]).alias("breed"), x["p"].cast("double").alias("percent")))


def defect_codes(text: Column) -> Column:
    """'AMFT DDS' as an array of (code, status). The longest locus that begins a token decides; tokens with an
    unknown suffix are dropped."""
    loci = "|".join(sorted(LOCI, key=lambda x: (-len(x), x)))
    found = F.transform(
        F.split(F.trim(F.coalesce(text, F.lit(""))), r"\s+"),
        lambda t: F.struct(F.regexp_extract(t, f"^({loci})(.*)$", 1).alias("code"), lookup(SUFFIXES, F.regexp_extract(t, f"^({loci})(.*)$", 2)).alias("status")),
    )
    return F.filter(found, lambda x: (x["code"] != "") & x["status"].isNotNull())


def ancestor(text: Column) -> Column:
    """A pedigree cell as (regNumber, name, tattoo, defects), or null if it isn't one."""
    t = F.trim(text)
    part = lambda i: F.nullif(F.trim(F.regexp_extract(t, ANCESTOR, i)), F.lit(""))
    return F.when(t.rlike(ANCESTOR), F.struct(part(1).alias("regNumber"), part(2).alias("name"), part(3).alias("tattoo"), defect_codes(part(4)).alias("defects")))


def href_registration(url: Column) -> Column:
    return F.trim(F.try_parse_url(url, F.lit("QUERY"), F.lit("animal_registration")))


def registry_refs(text: Column, own: Column | None = None, own_reg: Column | None = None) -> Column:
    """Known foreign registrations in text as an array of (association, regNumber), first mention first."""
    zipped = F.arrays_zip(_all(text, REFERENCE, 1).alias("p"), _all(text, REFERENCE, 2).alias("n"))
    refs = F.transform(zipped, lambda x: F.struct(lookup(PREFIXES, F.upper(x["p"])).alias("association"), x["n"].alias("regNumber")))
    keep = F.filter(refs, lambda r: r["association"].isNotNull())
    if own is not None:
        keep = F.filter(keep, lambda r: ~r["association"].eqNullSafe(own))
    if own_reg is not None:
        keep = F.filter(keep, lambda r: ~r["regNumber"].eqNullSafe(own_reg))
    return F.array_distinct(keep)


def cross_registrations(html: Column, own: Column) -> Column:
    """Handles of the page footer that open the same animal elsewhere, as (association, regNumber)."""
    pattern = r"PullUpAnimalDetail\(\s*'([^']+)'\s*,\s*'([^']+)'\s*\)"
    zipped = F.arrays_zip(_all(html, pattern, 1).alias("n"), _all(html, pattern, 2).alias("a"))
    refs = F.transform(zipped, lambda x: F.struct(lookup(ASSOCIATION_NAMES, F.lower(F.trim(x["a"]))).alias("association"), F.trim(x["n"]).alias("regNumber")))
    return F.filter(refs, lambda r: r["association"].isNotNull() & (r["association"] != F.upper(own)))


def dna_cases(text: Column, angus: bool = False) -> Column:
    """Sorted different case numbers: upper case without spaces, but for Angus pages as printed."""
    labs = "AGI|NEO|GS" if angus else "AGI|NEO|GS|GNS"
    found = _all(text, rf"(?i)\b((?:{labs})[- ]?[0-9]{{4,}})\b", 1)
    return F.array_sort(F.array_distinct(found if angus else F.transform(found, lambda c: F.upper(F.regexp_replace(c, r"\s", "")))))


def labelled(text: Column, label: str) -> Column:
    """The value after 'label:' up to two spaces or the end of the line."""
    value = F.regexp_extract(text, rf"{label}\s*:\s*([^\n]+?)(?:\s{{2,}}|$)", 1)
    return F.nullif(F.trim(F.regexp_replace(value, r"\s+", " ")), F.lit(""))


def angus_registration(text: Column, fallback: Column) -> Column:
    return F.coalesce(F.nullif(F.regexp_extract(text, r"Reg:\s*AAA\s*#?\+?\s*([0-9]{5,9})", 1), F.lit("")), fallback)


def angus_sex(text: Column) -> Column:
    return lookup({"Bull": "M", "Cow": "F", "Heifer": "F", "Steer": "S"}, F.regexp_extract(text, r"\b(Bull|Cow|Heifer|Steer)\b", 1))


def angus_defects(text: Column) -> Column:
    """'[ AMF-CAF-D2F ]': each token is a locus and a status letter."""
    tokens = F.transform(F.split(F.regexp_extract(text, r"\[\s*([A-Z0-9\-]+)\s*\]", 1), "-"), lambda t: F.trim(t))
    split = F.transform(tokens, lambda t: F.struct(F.substring(t, F.lit(1), F.length(t) - 1).alias("code"), lookup(STATUS_LETTERS, F.right(t, F.lit(1))).alias("status")))
    return F.filter(split, lambda x: (x["code"] != "") & x["status"].isNotNull())


def angus_owners(text: Column) -> Column:
    """The lines of the owners' block, 20 at most (as the pages' reader shows them)."""
    block = F.regexp_extract(text, r"(?s)Owner\(s\):\s*(.+?)(?:\n[A-Z][a-z]+ ?[A-Za-z]*:|\z)", 1)
    lines = F.filter(F.transform(F.split(block, "\n"), lambda x: F.trim(x)), lambda x: x != "")
    return F.slice(lines, 1, 20)


def seeds(line: Column, own: Column) -> Column:
    """'ASSOC:REG', 'ASSOC,REG' or 'REG' as (association, reg_number); comments and blanks are null."""
    bare = F.trim(F.regexp_replace(line, "#.*$", ""))
    found = lambda i: F.regexp_extract(bare, r"^([^:,]+)[:,](.+)$", i)
    pair = F.struct(key(F.when(found(2) != "", found(1)).otherwise(own)).alias("association"), F.trim(F.when(found(2) != "", found(2)).otherwise(bare)).alias("reg_number"))
    return F.when(bare != "", pair)
