import pytest
from pyspark.sql import functions as F

from brandbook.functions import extract as X
from brandbook.functions import norm as N


def values(spark, make, inputs, kind="string"):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {kind}")
    return [r.o for r in frame.select("i", make(F.col("v")).alias("o")).orderBy("i").collect()]


def plain(x):
    return [tuple(y) for y in x] if x is not None else None


CASES = [
    (N.name, ["[ ZNT707T ] ZNT JENNA 707T", None, " o'Brien  3rd-x "], ["ZNT JENNA 707T", "", "OBRIEN 3RDX"]),
    (lambda c: N.is_generic(N.name(c)), ["ANGUS", "AN X MA", "CA X AN", "AN X MA X CA", "MA", "1/2 AN", "ZNT JENNA 707T", "OHL GIGGLES 320N", "DALLAS LADY BERTA"], [True] * 6 + [False] * 3),
    (lambda c: N.is_specific(N.name(c)), ["ZNT JENNA 707T", "DALLAS LADY BERTA", "707T", "AN X 7"], [True, False, False, False]),
    (N.defect_status, ["F", "Carrier Free", "C", "carrier by test", "S", "A", "Affected by Test", "", None, "clear"], ["Free", "Free", "Carrier", "Carrier", "Suspect", "Unknown", "Unknown", "Unknown", "Unknown", "Free"]),
    (lambda c: N.defect_status(c, True), ["Affected by Test", "F"], ["Affected", "Free"]),
    (N.horn, ["Horned", "POLLED", "pp", "scurred", " ", None, "o'brien 3rd-x"], ["Horned", "Polled", "Polled", "Scurred", None, None, "O'Brien 3Rd-X"]),
    (N.iso_date, ["9/1/2011", "2011-09-10", "Sept 2011", " 09/10/2011 ", "", None], ["2011-09-01", "2011-09-10", "Sept 2011", "2011-09-10", None, None]),
    (N.sex, ["Bull", "heifer", "S", "?", None], ["M", "F", "S", None, None]),
    (N.retry_after, ["12", "-4", "Wed, 21 Oct", None], [12, 0, None, None]),
    (N.escape_html, ['<a href="x">&', None], ["&lt;a href=&quot;x&quot;&gt;&amp;", ""]),
    (lambda c: N.bag(c, "k"), ['{"k": 5}', "{bad", None], ["5", None, None]),
    (lambda c: N.age_seconds(c, F.lit(1_700_000_000).cast("long")), ["2023-11-14T22:13:10Z", "2023-11-14T22:13:10", "junk"], [10, 10, None]),
    (lambda c: X.href_registration(c), ["http://a/x?op=1&animal_registration=MA1", "http://a/x", "::"], ["MA1", None, None]),
    (lambda c: X.labelled(c, "Birth Date"), ["x Birth Date: 01/02/2000  Tattoo: 5", "none"], ["01/02/2000", None]),
]


@pytest.mark.parametrize(("make", "inputs", "wanted"), CASES)
def test_scalars(spark, make, inputs, wanted):
    assert values(spark, make, inputs) == wanted


def test_extracted_arrays(spark):
    got = values(spark, X.genetic_makeup, ["73.049% MA | 19.733% AN | 2.881% CA | 4.338% XX", None])
    assert plain(got[0]) == [("MA", 73.049), ("AN", 19.733), ("CA", 2.881), ("XX", 4.338)] and got[1] == []
    got = values(spark, X.defect_codes, ["AMFT CAFT DDS NHFT PHAFT THFT", "PHAS", "DDS", "ZZF AMQ", None])
    assert [plain(g) for g in got] == [[("AM", "F"), ("CA", "F"), ("DD", "S"), ("NH", "F"), ("PHA", "F"), ("TH", "F")], [("PHA", "S")], [("DD", "S")], [], []]
    a, b, c = values(spark, X.ancestor, ["MA402617 GVC SUH 01W [ 01W DGW ] -- AMFT DDS", "337003 ZNT JENNA 707T", "not one"])
    assert (a.regNumber, a.name, a.tattoo, plain(a.defects)) == ("MA402617", "GVC SUH 01W", "01W DGW", [("AM", "F"), ("DD", "S")])
    assert (b.regNumber, b.name, b.tattoo, b.defects) == ("337003", "ZNT JENNA 707T", None, []) and c is None
    refs = values(spark, lambda c: X.registry_refs(c, F.lit("ANGUS"), F.lit("777777")), ["AMAA #430053 AAA 123456 ZZ 99999 ACA 777777 AMAA +430053 RAAA 1234567"])
    assert plain(refs[0]) == [("MAINE", "430053"), ("RED", "1234567")]
    cross = values(spark, lambda c: X.cross_registrations(c, F.lit("chia")), ["PullUpAnimalDetail('430053', 'American Maine-Anjou Association') PullUpAnimalDetail( '1','American Chianina Association')"])
    assert plain(cross[0]) == [("MAINE", "430053")]
    assert values(spark, X.dna_cases, ["agi 778812 NEO-4455667 GNS1234 AGI-12 agi 778812"]) == [["AGI778812", "GNS1234", "NEO-4455667"]]
    assert plain(values(spark, X.angus_defects, ["x [ AMF-CAF-D2F-QQZ ]"])[0]) == [("AM", "F"), ("CA", "F"), ("D2", "F")]
    assert values(spark, X.angus_owners, ["Owner(s): A Ranch\n B Ranch \nBreeder: C"]) == [["A Ranch", "B Ranch"]]
    got = values(spark, lambda c: X.seeds(c, F.lit("chia")), ["MAINE:12", "short,S1 # x", "MA5", "# no", ""])
    assert [tuple(g) if g else None for g in got] == [("MAINE", "12"), ("SHORT", "S1"), ("CHIA", "MA5"), None, None]


def test_numbers(spark):
    assert values(spark, N.human_bytes, [5, 2048, 3 << 20, 5 << 30, None], "bigint") == ["5B", "2.0K", "3.0M", "5.0G", "?"]
    assert values(spark, N.ago, [3, 60, 600, 7200, 400_000], "bigint") == ["just now", "60s ago", "10m ago", "2h ago", "5d ago"]
    assert values(spark, N.duration, [0.01, 1.0, 13.2, 21.0, 300.0, None], "double") == ["1 hr", "1 day", "13 days", "3.0 wks", "9.9 mo", None]
    assert values(spark, N.compact_number, [12.0, 12_345.0, 1_234_567.0], "double") == ["12", "12.3k", "1.23M"]
    assert values(spark, lambda c: N.tick_step(c), [8.0, 100.0, 0.35], "double") == [2.0, 50.0, pytest.approx(0.1)]
    low, high = values(spark, lambda c: F.array(*N.padded_domain(c, c)), [5.0], "double")[0]
    assert low < 5 < high
    got = values(spark, N.pins, ["a.com=1.1.1.1,2.2.2.2 B.com=3.3.3.3"])[0]
    assert got == {"a.com": ["1.1.1.1", "2.2.2.2"], "b.com": ["3.3.3.3"]}
    row = spark.range(1).select(N.percent_keys(F.create_map(F.lit("Chianina %"), F.lit("2.88"), F.lit("Name"), F.lit("x"))).alias("m"), N.shard(F.lit("MA430053")).alias("s"), N.animal_url(F.lit("chia"), F.lit("9")).alias("u")).first()
    assert row.m == {"chianina_percent": "2.88"} and len(row.s) == 2 and row.u.startswith("https://chianina.")
