"""Record sets with known results, and a sequential model to hold the replay against."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from brandbook.schema import RECORD


def record(assoc, reg, name=None, **more):
    return {"association": assoc, "regNumber": reg, "name": name, **more}


def parent(assoc, reg, name=None, intl=None):
    return {"intl_id": intl, "association": assoc, "regNumber": reg, "name": name}


def frame(spark, records):
    fields = [f.strip().split(" ")[0] for f in _top_level(RECORD)]
    rows = spark.createDataFrame([(i, *(r.get(f) for f in fields)) for i, r in enumerate(records)], f"seq bigint, {RECORD}")
    return rows.repartition(3, F.col("seq"))


def _top_level(ddl):
    depth, start = 0, 0
    for i, c in enumerate(ddl):
        depth += (c == "<") - (c == ">")
        if c == "," and not depth:
            yield ddl[start:i]
            start = i + 1
    yield ddl[start:]


# Record sets whose resolution is known.
SIX = [
    record("CHIA", "MA430053", "MAB Sherwood Ace 7X", intl_id="USAM20180211Z001", sex="M", dob="2018-02-11", tattoo="MAB7X", dna_cases=["AGI-778812"], cross_refs=[{"association": "MAINE", "regNumber": "402303"}],
           breed_composition=[{"breed": "MA", "percent": 50.0}, {"breed": "AN", "percent": 50.0}], defects=[{"code": c, "status": "F"} for c in ("TH", "PHA", "CA")],
           sire=parent("SHORT", "3790685", "Big Sky 88", "USAM20140305Z002"), dam=parent("CHIA", "400001", "MAB Duchess 22", "USAM20150410Z003")),
    record("MAINE", "402303", "MAB Sherwood Ace 7X", intl_id="USAM20180211Z001", sex="M", dob="2018-02-11", tattoo="MAB7X", dna_cases=["AGI-778812"], cross_refs=[{"association": "CHIA", "regNumber": "MA430053"}],
           breed_composition=[{"breed": "MA", "percent": 50.0}, {"breed": "AN", "percent": 50.0}], defects=[{"code": c, "status": "F"} for c in ("TH", "PHA")],
           sire=parent("SHORT", "3790685", "Big Sky 88", "USAM20140305Z002"), dam=parent("CHIA", "400001", "MAB Duchess 22", "USAM20150410Z003")),
    record("SHORT", "3790685", "Big Sky 88", intl_id="USAM20140305Z002", sex="M", dob="2014-03-05", tattoo="BS88", dna_cases=["AGI-551200"], breed_composition=[{"breed": "SH", "percent": 100.0}],
           defects=[{"code": c, "status": "F"} for c in ("TH", "PHA", "MSUD")]),
    record("CHIA", "MA555000", "Rolling Hills Bella 3F", intl_id="USAM20210120Z005", sex="F", dob="2021-01-20", tattoo="RH3F", dna_cases=["AGI-991000"],
           breed_composition=[{"breed": "MA", "percent": 25.0}, {"breed": "AN", "percent": 25.0}, {"breed": "SH", "percent": 50.0}], defects=[{"code": "TH", "status": "F"}, {"code": "PHA", "status": "C"}, {"code": "CA", "status": "F"}],
           sire=parent("CHIA", "MA430053", "MAB Sherwood Ace 7X", "USAM20180211Z001"), dam=parent("SHORT", "S99001", "Big Sky Rose", "USAM20170101Z004")),
    record("SHORT", "S12345", "R H Bella 3F", intl_id="", sex="F", dob="2021-01-20", tattoo="RH3F", dna_cases=["AGI-991000"],
           breed_composition=[{"breed": "SH", "percent": 50.0}, {"breed": "MA", "percent": 25.0}, {"breed": "AN", "percent": 25.0}], defects=[{"code": "TH", "status": "F"}, {"code": "PHA", "status": "C"}],
           sire=parent("CHIA", "MA430053", "MAB Sherwood Ace 7X", "USAM20180211Z001"), dam=parent("SHORT", "S99001", "Big Sky Rose", "USAM20170101Z004")),
    record("ANGUS", "19876543", "Connealy Black Granite", intl_id="USAA20160914Z006", sex="M", dob="2016-09-14", tattoo="CBG1", dna_cases=["NEO-4455667"], breed_composition=[{"breed": "AN", "percent": 100.0}],
           defects=[{"code": c, "status": "F"} for c in ("AM", "NH", "CA", "DD")]),
]

JENNA = "ZNT JENNA 707T"
SEVEN = [
    record("CHIA", "337003", JENNA, sex="F", dob="2007-09-30"), record("MAINE", "378987", f"[ ZNT707T ] {JENNA}", sex="F", dob="2007-09-30"), record("CHIA", "C1", "ANGUS", sex="F", dob="1988-01-01"), record("CHIA", "C2", "ANGUS", sex="F", dob="1988-01-01"),
    record("CHIA", "337003", JENNA, sex="F", dob="2007-09-30"), record("CHIA", "MA430053", "ZNT MOVES LIKE JAGGER", sex="M", dob="2011-09-10", cross_refs=[{"association": "MAINE", "regNumber": "430053"}]),
    record("MAINE", "430053", "ZNT MOVES LIKE JAGGER", sex="M", dob="2011-09-10", cross_refs=[{"association": "CHIA", "regNumber": "MA430053"}]),
]
CALF_FIRST = [
    record("MAINE", "C900", "SOME CALF", sex="M", dob="2015-01-02", dam=parent("MAINE", "378987", f"[ ZNT707T ] {JENNA}")), record("CHIA", "337003", JENNA, sex="F", dob="2007-09-30"), record("MAINE", "378987", f"[ ZNT707T ] {JENNA}", sex="F", dob="2007-09-30"),
]
CALF_LAST = [record("CHIA", "337003", JENNA, sex="F", dob="2007-09-30"), record("MAINE", "C901", "HER CALF", sex="M", dob="2016-02-02", dam=parent("MAINE", "378987", f"[ ZNT707T ] {JENNA}"))]


def random_records(rng: random.Random, n: int):
    """Records from a few values of each key, so that keys collide."""
    pick = lambda *xs: rng.choice([None, *xs])
    names = ["ALPHA ONE 1A", "BETA TWO 2B", "ANGUS", "GAMMA", "DELTA 9"]
    who = lambda: parent(rng.choice("AB") * 2, pick("1", "2", "3", "4", "5"), pick(*names), pick("I1", "I2"))
    for _ in range(n):
        yield record(
            rng.choice("AB") * 2, rng.choice("123456"), pick(*names), intl_id=pick("I1", "I2", "I3", ""), sex=pick("M", "F", "S"), dob=pick("2001-01-02", "2002-02-03"), tattoo=pick("T1", "T2"), color=pick("Red", "Black"),
            dna_cases=rng.sample(["AGI-1111", "AGI-2222", "agi-1111 "], rng.randrange(2)), cross_refs=[{"association": rng.choice("AB") * 2, "regNumber": rng.choice("123456")} for _ in range(rng.randrange(2))],
            breed_composition=[{"breed": rng.choice(["AN", "MA"]), "percent": float(rng.choice([25, 50]))}], defects=[{"code": rng.choice(["TH", "PHA"]), "status": rng.choice("FCS")}], sire=rng.choice([None, who()]), dam=rng.choice([None, who()]),
        )


class Animal:
    """Of the model below: what one animal is known by."""

    def __init__(self, uid, values):
        self.uid, self.values, self.known = uid, dict(values), set()


class Model:
    """Reads prepared records one by one with nothing but lists: every question is a walk over all animals, in the order
    in which they came. Slow, and written apart from the replay."""

    def __init__(self):
        self.animals, self.papers, self.shares, self.tests, self.lines, self.homes, self.rungs = [], {}, set(), [], [], {}, []

    def who(self, *key):
        return next((a for a in self.animals if key in a.known), None)

    def claim(self, animal, *key):
        for a in self.animals:
            a.known.discard(key)
        animal.known.add(key)

    def where(self, **values):
        return [a for a in self.animals if all((not a.values.get(k)) if v is None else a.values.get(k) == v for k, v in values.items())]

    def learn(self, animal, values):
        for k, v in values.items():
            if v and not animal.values.get(k):
                animal.values[k] = v

    def note(self, animal, key, values):
        self.papers[key] = {**self.papers.get(key, {}), **values}
        self.claim(animal, "reg", *key)

    def unite(self, keep, drop):
        self.animals.remove(drop)
        self.learn(keep, drop.values)
        keep.known |= drop.known
        self.shares = {(keep if a is drop else a, *rest) for a, *rest in self.shares}
        moved = []
        for a, code, status in self.tests:
            a = keep if a is drop else a
            same = [i for i, (b, c, _) in enumerate(moved) if b is a and c == code]
            if same:
                moved[same[0]] = (a, code, status)
            else:
                moved.append((a, code, status))
        self.tests = moved
        self.lines = [(m, *(keep if x is drop else x for x in ends)) for m, *ends in self.lines if not ends[0] is ends[1] is drop]
        self.homes = {m: keep if a is drop else a for m, a in self.homes.items()}

    def record(self, r):
        keys = [("intl", r["intl"])] if r["intl"] else []
        ways = [("intl_id", keys), ("registration", [("reg", r["assoc"], r["reg"])]), ("dna", [("case", c) for c in r["cases"]]), ("cross_ref", [("reg", x["assoc"], x["reg"]) for x in r["xrefs"]])]
        found = next(((rung, a) for rung, many in ways for key in many if (a := self.who(*key))), None)
        if not found and r["tattoo"] and r["dob"] and r["sex"] and (same := self.where(tattoo=r["tattoo"], dob=r["dob"], sex=r["sex"])):
            found = "tattoo_dob_sex", same[0]
        if not found and r["norm"] and r["dob"] and not r["generic"] and (same := self.where(name_norm=r["norm"], dob=r["dob"])):
            found = "name_dob", same[0]
        values = {"intl_id": r["intl"] or None, "name": r["name"], "name_norm": r["norm"], "horn_status": r["horn"], **{k: r[k] for k in ("sex", "dob", "tattoo", "color")}}
        if found:
            animal = found[1]
            self.learn(animal, values)
            if r["intl"] and not self.who("intl", r["intl"]):
                self.claim(animal, "intl", r["intl"])
        else:
            animal = Animal(f"{r['assoc']}:{r['reg']}", values)
            self.animals.append(animal)
            if r["intl"]:
                self.claim(animal, "intl", r["intl"])
        self.rungs.append(found[0] if found else "created")
        if r["norm"] and r["dob"] and not r["generic"]:
            for twin in self.where(name_norm=r["norm"], dob=r["dob"]):
                if twin is not animal:
                    self.unite(animal, twin)
                    self.rungs.append("name_dob")
        if r["dob"] and r["specific"]:
            for stub in self.where(name_norm=r["norm"], dob=None):
                if stub is not animal:
                    self.unite(animal, stub)
                    self.rungs.append("name_dob")
        self.note(animal, (r["assoc"], r["reg"]), {"stub": False})
        for c in r["cases"]:
            self.claim(animal, "case", c)
        self.shares |= {(animal, b["breed"], b["percent"]) for b in r["breeds"]}
        for d in r["defects"]:
            at = [i for i, (a, code, _) in enumerate(self.tests) if a is animal and code == d["code"]]
            if at:
                self.tests[at[0]] = (animal, d["code"], d["status"])
            else:
                self.tests.append((animal, d["code"], d["status"]))
        for x in r["xrefs"]:
            if not self.who("reg", x["assoc"], x["reg"]):
                self.note(animal, (x["assoc"], x["reg"]), {"stub": True, "via_cross_ref": True})
        self.homes[3 * r["seq"]] = animal
        for role, side in ((1, "sire"), (2, "dam")):
            p = r[side] and self.parent(r[side])
            if p:
                self.homes[3 * r["seq"] + role] = p
                self.lines.append((3 * r["seq"] + role, self.homes[3 * r["seq"]], p))

    def parent(self, p):
        key = (p["assoc"], p["reg"]) if p.get("reg") else None
        known = (self.who("intl", p["intl"]) if p["intl"] else None) or (self.who("reg", *key) if key else None)
        if known or not (key or p["intl"]):
            return known
        dated = [a for a in self.animals if p["specific"] and a.values.get("name_norm") == p["norm"] and a.values.get("dob")]
        animal = dated[0] if dated else Animal(":".join(key) if key else p["intl"], {"intl_id": p["intl"] or None, "name": p.get("name"), "name_norm": p["norm"]})
        if not dated:
            self.animals.append(animal)
            if p["intl"]:
                self.claim(animal, "intl", p["intl"])
            self.rungs.append("created")
        if key:
            self.note(animal, key, {"stub": True})
        return animal

    def tables(self):
        """Rows of each table, as tuples."""
        homes = {m: a.uid for m, a in self.homes.items()}
        return {
            "animal": [(a.uid, *(a.values.get(f) for f in ("intl_id", "name", "name_norm", "sex", "dob", "tattoo", "color", "horn_status"))) for a in self.animals],
            "registration": [(k[1], k[2], a.uid, self.papers[k[1:]].get("stub"), self.papers[k[1:]].get("via_cross_ref")) for a in self.animals for k in a.known if k[0] == "reg"],
            "animal_dna": [(k[1], a.uid) for a in self.animals for k in a.known if k[0] == "case"],
            "animal_breed": [(a.uid, *rest) for a, *rest in self.shares], "animal_defect": [(a.uid, *rest) for a, *rest in self.tests], "mention": [*homes.items()],
            "parentage": [*{(c.uid, p.uid, "SIRE" if m % 3 == 1 else "DAM") for m, c, p in self.lines}],
        }
