"""Record and graph schemas in DDL, and the registries' dictionaries as literal maps."""

from __future__ import annotations

PARENT = "struct<intl_id:string,association:string,regNumber:string,name:string>"
RECORD = (
    "intl_id string, association string, regNumber string, name string, sex string, dob string, tattoo string, color string, horn_status string, breeder string, owner string, "
    "breed_composition array<struct<breed:string,percent:double>>, defects array<struct<code:string,status:string>>, dna_cases array<string>, "
    "cross_refs array<struct<association:string,regNumber:string>>, epds map<string,string>, attributes string, "
    f"sire {PARENT}, dam {PARENT}, source_url string, scraped_at string"
)
FRONTIER = (
    "association string, reg_number string, status string, depth int, priority int, attempts int, last_error string, discovered_from string, updated_at string"
)
STATUS = (
    "association string, state string, current struct<association:string,reg:string,name:string,color:string,dob:string,sex:string,defects:array<struct<code:string,status:string>>>, "
    "counts map<string,bigint>, processed bigint, rate_per_min double, pct double, pid bigint, updated_at string"
)
TABLES = {
    "animal": "uid string, intl_id string, name string, name_norm string, sex string, dob string, tattoo string, color string, horn_status string",
    "registration": "association string, regNumber string, uid string, name_as_recorded string, breeder string, owner string, epds string, attributes string, source_url string, scraped_at string, stub boolean, via_cross_ref boolean",
    "animal_dna": "case_id string, uid string",
    "animal_breed": "uid string, breed string, percent double",
    "animal_defect": "uid string, code string, status string",
    "parentage": "child_uid string, parent_uid string, role string",
}
#: What a load keeps beside the graph, for the next one.
RESOLUTION = {"log": "mention bigint, step bigint, uid string, rung string", "mention": "mention bigint, uid string", "fallen": "mention bigint"}
#: Key columns that hold one row each.
UNIQUE = {"animal": ["uid"], "registration": ["association", "regNumber"], "animal_dna": ["case_id"], "animal_defect": ["uid", "code"]}

# Fixed values, all that follow: they must equal what registries print.
SUBDOMAINS = {
    "MAINE": "maine-anjou", "CHIA": "chianina", "SHORT": "shorthorn", "GELB": "gelbvieh", "SIMM": "simmental",
    "RED": "redangus", "HERF": "hereford", "SALERS": "salers", "LIMI": "limousin", "BRAUN": "braunvieh",
}
ASSOCIATION_NAMES = {
    "american maine-anjou association": "MAINE", "american chianina association": "CHIA", "american shorthorn association": "SHORT", "american angus association": "ANGUS", "american simmental association": "SIMM",
    "american gelbvieh association": "GELB", "american hereford association": "HERF", "red angus association of america": "RED", "north american limousin foundation": "LIMI",
}
PREFIXES = {"AAA": "ANGUS", "RAAA": "RED", "AMAA": "MAINE", "ACA": "CHIA", "ASA": "SIMM", "AHA": "HERF", "AGA": "GELB", "NALF": "LIMI", "ASN": "SALERS"}
BREED_TOKENS = [
    "ANGUS", "RED ANGUS", "SIMMENTAL", "SIM", "CHIANINA", "CHIA", "MAINE ANJOU", "MAINEANJOU", "MAINE", "SHORTHORN", "SHORT", "HEREFORD", "HERF", "GELBVIEH", "GELB", "LIMOUSIN", "LIMI",
    "SALERS", "BRAUNVIEH", "BRAUN", "CHIANGUS", "COMMERCIAL", "AN", "MA", "CA", "SM", "SH", "HH", "XX", "UNKNOWN",
]
RECONCILE_WORDS = ["ANGUS", "RED ANGUS", "SIMMENTAL", "CHIANINA", "MAINE ANJOU", "MAINEANJOU", "SHORTHORN", "HEREFORD", "GELBVIEH", "LIMOUSIN", "SALERS", "BRAUNVIEH", "CHIANGUS"]
SEXES = {"BULL": "M", "MALE": "M", "M": "M", "COW": "F", "HEIFER": "F", "FEMALE": "F", "F": "F", "STEER": "S", "S": "S"}
LOCI = ["PHA", "MYO", "MSUD", "TH", "CA", "AM", "NH", "DD", "DS", "OS", "MA"]
SUFFIXES = {"FT": "F", "FP": "F", "F": "F", "S": "S", "CT": "C", "C": "C", "A": "A"}
RESULTS = {
    "free by test": "F", "free by pedigree": "F", "free": "F", "suspect": "S", "suspected carrier": "S", "carrier by test": "C", "carrier": "C", "affected by test": "A", "affected": "A",
}
TRAITS = ["CED", "BW", "WW", "YW", "MILK", "TM", "CEM", "STAY", "DOC", "YG", "CW", "CREA", "MARB", "CFAT", "API", "TI", "REA", "FAT", "IMF", "CE"]
