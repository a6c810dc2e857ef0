import random
import re

from brandbook.operators import robots as R


def groups_of(text):
    """(agents, rules) of a file, read line by line."""
    found, agents, rules = [], [], []
    for line in re.split(r"\r\n|\r|\n", text or ""):
        line = line.split("#")[0]
        if ":" not in line:
            continue
        field, value = (x.strip(" ") for x in line.split(":", 1))
        field = field.lower()
        if field == "user-agent":
            if rules or not agents:
                if agents:
                    found.append((agents, rules))
                agents, rules = [], []
            agents = [*agents, value.lower()]
        elif field in ("allow", "disallow") and agents:
            rules = [*rules, (field == "allow", value)]
    return [*found, (agents, rules)] if agents else found


def fits(rule, path):
    at, parts = 0, rule.removesuffix("$").split("*")
    ends = rule.endswith("$")

    def go(at, parts):
        if len(parts) == 1:
            return not ends or at == len(path)
        return any(path.startswith(parts[1], k) and go(k + len(parts[1]), parts[1:]) for k in range(at, len(path) + 1))

    return path.startswith(parts[0]) and go(len(parts[0]), parts)


def brute(text, agent, path):
    groups = groups_of(text)
    own = [r for agents, rules in groups if agent in agents for r in rules if r[1]]
    if not any(agent in agents and any(v for _, v in rules) for agents, rules in groups):
        own = [r for agents, rules in groups if "*" in agents for r in rules if r[1]]
    met = sorted((len(v), allow) for allow, v in own if fits(v, path))
    return path == "/robots.txt" or not met or met[-1][1]


def made(rng):
    path = lambda: "/" + "".join(rng.choice(["a", "b", "/", "*", "$", ".", "?x=1", "\\E", "é"]) for _ in range(rng.randrange(5)))
    lines = []
    for _ in range(rng.randrange(6)):
        lines += [f"{rng.choice(['User-agent', 'user-AGENT '])}: {rng.choice(['*', 'Herdbot', 'other'])}" for _ in range(rng.randrange(1, 3))]
        lines += [rng.choice([f"Disallow: {path()}", f"Allow:{path()}  # why", "Disallow:", "", "Crawl-delay: 3", "nonsense", "# all"]) for _ in range(rng.randrange(5))]
    return rng.choice(["\n", "\r\n", "\r"]).join(lines)


def test_against_a_reader(spark):
    rng = random.Random(4)
    files = [(f"h{i}.example", made(rng)) for i in range(60)] + [("none.example", None), ("empty.example", "")]
    paths = ["/", "", "/robots.txt", "/a/b.b?x=1", None] + ["/" + "".join(rng.choice("ab/.é$*") for _ in range(rng.randrange(6))) for _ in range(25)]
    asked = [(h.upper() if rng.random() < 0.1 else h, p, 7) for h, _ in files for p in paths] + [("unknown.example", "/a", 7), (None, "/a", 7)]
    table = R.rules(spark.createDataFrame(files, "host string, text string"))
    got = R.judged(spark.createDataFrame(asked, "host string, path string, n int"), R.for_agent(table, "Herdbot/1.0")).collect()
    assert len(got) == len(asked)
    texts = dict(files)
    for r in got:
        want = True if r.host is None or r.path is None else brute(texts.get(r.host.lower()), "herdbot", r.path)
        assert r.allowed == want, (r, texts.get((r.host or "").lower()))
    assert 0 < sum(r.allowed for r in got) < len(got)


def test_known_files(spark):
    text = "Crawl-delay: 1\nDisallow: /early\nUser-agent: a\nUser-agent: *\nDisallow: /\nAllow: /public/\nAllow: /*.html$\nDisallow: /public/private\n\nSitemap: x\nDisallow: /late\nUser-agent: b\nDisallow:\n"
    table = R.rules(spark.createDataFrame([("H", text)], "host string, text string"))
    asked = spark.createDataFrame([("h", p) for p in ("/x", "/public/y", "/public/private/z", "/x.html", "/x.html?q", "/early", "/late", "/robots.txt")], "host string, path string")
    allowed = lambda agent: {r.path for r in R.judged(asked, R.for_agent(table, agent)).where("allowed").collect()}
    assert allowed("a") == allowed("anyone") == {"/public/y", "/x.html", "/robots.txt"}
    assert R.judged(asked.limit(0), table.drop("agent")).count() == 0
    assert R.judged(asked, R.for_agent(table.limit(0), "a")).where("allowed").count() == 8
