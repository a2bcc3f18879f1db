import random
import re

from quern.llm.urls import HOST_PATH_RULES, METHOD_RULES, Rule, RuleIndex, host_path_rule, judge_urls, tokens_of, word_rule

URLS = [
    None, "", "no scheme/path", "http://", "https://Example.ORG/es/1", "http://a.b.example.org/en/148.html", "ftp://x.org",
    "http://x.org/", "http://xorg/", "http://org/a", "http://com/fr/", "http://shop.COM/fr/?q", "http://shop.com/FR/x",
    "http://shop.com/de/#x", "http://shop.com?x/fr/", "http://cheap-pills.example.net/a", "http://my.spam_farm.net",
    "http://xspam-farm.net/", "://x.com/fr/", "a://b://c.org/", "http://example.org/en/2", "http://x.com:80/fr/1",
    "http://user@x.org/", "http://\u212aspam-farm.net/", "http://x.org/\n/a", "http://" + "a." * 5000 + "org/" + "x/" * 5000,
]


def parts(url):
    url = url or ""
    rest = url.split("://", 1)[1] if "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def brute(url):
    host, path = parts(url)
    best = None
    for rule in HOST_PATH_RULES:
        name, _, rest = rule.name.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + rest):
            if best is None or len(rule.name) > len(best.name):
                best = rule
    if best:
        return host, path, best.name, "allow" if best.allow else "block"
    spam = any(re.search(r.pattern, host + path) for r in METHOD_RULES)
    return host, path, None, "block" if spam else "allow"


def test_awkward_urls(spark):
    rows = [(i, u) for i, u in enumerate(URLS)] + [(None, "http://x.org/"), (3, "http://x.org/"), (3, "http://x.org/")]
    df = spark.createDataFrame(rows, "page_id bigint, url string").selectExpr("*", "1 AS Host", "2 AS other")
    got = judge_urls(df, HOST_PATH_RULES, METHOD_RULES)
    assert got.columns == ["page_id", "url", "other", "host", "path", "rule", "verdict"]
    said = sorted((str(r.page_id), r.host, r.path, str(r.rule), r.verdict) for r in got.collect())
    want = ((str(i), *brute(u)) for i, u in rows)
    assert said == sorted((i, h, p, str(r), v) for i, h, p, r, v in want)
    assert judge_urls(df.limit(0), HOST_PATH_RULES, METHOD_RULES).count() == 0


def test_index_finds_what_all_rules_find():
    rnd = random.Random(0)
    names = ["a", "bb", "c1", "news", "shop", "x"]
    rules = []
    for _ in range(200):
        host = ".".join(rnd.choices(names, k=rnd.randint(1, 3)))
        path = "/".join(rnd.choices(names, k=rnd.randint(0, 2))) + rnd.choice(["", "/"])
        rules.append(host_path_rule(f"{host}/{path}", rnd.random() < 0.5, rank=rnd.randint(0, 3)))
    rules += [word_rule("w", ["bb", "c1"]), Rule("any", r"news[0-9]", (), False, 2)]
    index = RuleIndex(rules, {n: rnd.randint(0, 50) for n in names})
    for _ in range(2000):
        host = ".".join(rnd.choices([*names, "bb-c1", "news7"], k=rnd.randint(1, 4)))
        path = "".join("/" + p for p in rnd.choices([*names, "NEWS", "xa"], k=rnd.randint(0, 3))) + rnd.choice(["", "/"])
        fitting = [(r.rank, r.name, r.allow) for r in rules if re.search(r.pattern, host + path)]
        got = index.decide(host, path)
        assert (got and got[:2]) == (max(fitting)[:2] if fitting else None)


def test_rules_are_filed_under_their_rarest_token():
    index = RuleIndex(HOST_PATH_RULES, {"org": 50, "example": 90, "es": 3, "en": 70, "com": 60, "fr": 5, "de": 99})
    assert {t: sorted(e[1] for e in held) for t, held in index.filed.items()} == {
        "org": ["example.org/en/1", "org/"], "es": ["example.org/es/"], "fr": ["com/fr/"], "com": ["com/de/"],
    }
    assert tokens_of("A.b-C9/é") == {"a", "b", "c9", ""}


def test_no_rules(spark):
    df = spark.createDataFrame([(1, "http://x.org/")], "page_id bigint, url string")
    assert [tuple(r)[2:] for r in judge_urls(df, [], []).collect()] == [("x.org", "/", None, "allow")]
