import random
import re

import pytest
from pyspark.sql import functions as F

from quern.llm.columns import without
from quern.llm.secrets import BASE_RULES, MORE_RULES, join_spans, redact, scan_secrets
from quern.llm.trigrams import trigram_query
from tests.llm.data import TEXTS, documents, prose

RULES = [*BASE_RULES, *MORE_RULES]
PIECES = [
    "password=", "PassWord: '", "secret", "api_key=\"", "APIKEY:", "token", "=", ":", " ", "AKIA", "AKIAAKIA", "0123456789abcdef",
    "ABCDEFGHIJKLMNOP", "é", "\U0001d4b3", "ghp_", "a" * 36, "eyJ", ".", "-----BEGIN RSA PRIVATE KEY-----", "\nMIIB==\n",
    "-----END RSA PRIVATE KEY-----", "xoxb-", "1234567890-", "AIza", "B" * 35, "\u017fecret=abcdefghijkl", "to\u212aen=abcdefghijkl",
]


def brute(text, rules=RULES):
    spans = []
    for number, rule in enumerate(rules):
        for found in re.finditer(rule.pattern, text or "", re.ASCII):
            if len(found[rule.group]) >= rule.least:
                spans.append((found.start(), number, found.end()))
    return sorted(spans)


def spans_by_row(df):
    return sorted((str(r.doc_id), r.text or "", [tuple(s) for s in r.secret_spans]) for r in df.collect())


def nasty(n, seed=0):
    rnd = random.Random(seed)
    return [(i, "".join(rnd.choices(PIECES, k=rnd.randint(1, 12)))) for i in range(n)]


@pytest.mark.parametrize("rows", [TEXTS, nasty(400)], ids=["awkward", "made of pieces"])
def test_same_spans_as_a_plain_scan(spark, rows):
    want = sorted((str(i), t or "", brute(t)) for i, t in rows)
    df = documents(spark, rows, extra="1 AS Secret_Spans")
    assert spans_by_row(scan_secrets(df, RULES)) == want


def test_repeated_rows_null_ids_and_empty_table(spark):
    secret = "x password=abcdefghijklmnop y"
    rows = [(None, secret), (None, secret), (1, secret), (1, secret), (1, "other token=0123456789ab"), (2, None)]
    want = sorted((str(i), t or "", brute(t)) for i, t in rows)
    assert spans_by_row(scan_secrets(documents(spark, rows), RULES)) == want
    assert scan_secrets(documents(spark, []), RULES).count() == 0
    assert scan_secrets(documents(spark, rows), BASE_RULES[2:3]).count() == len(rows)


def test_hidden_by_an_earlier_match(spark):
    """A match that is too short still takes its characters."""
    rows = [(1, "secret: token:abcdefghijklmnop"), (2, "password=token=abcdefgh")]
    df = scan_secrets(documents(spark, rows), BASE_RULES[:1])
    assert [(r.doc_id, len(r.secret_spans)) for r in df.orderBy("doc_id").collect()] == [(1, 0), (2, 1)]


def test_redacted(spark):
    rows = nasty(200, seed=3) + [(1000, LONG_SECRET)]
    df = redact(scan_secrets(documents(spark, rows), RULES), mark="#")
    for r in df.collect():
        text = dict(rows)[r.doc_id]
        out, at = [], 0
        for start, _, end in brute(text):
            if start > at or not out:
                out += [text[at:start], "#"]
            at = max(at, end)
        assert r.text == "".join(out) + text[at:]
    assert without(df, ["text"]).columns == ["doc_id", "secret_spans"]


LONG_SECRET = "password=abcdefghijkl and " + prose(3000, 8) + " token: 0123456789abcdef0123"


def test_joined_spans(spark):
    names = [r.kind for r in RULES]
    df = scan_secrets(documents(spark, [(1, "é token=0123456789abcdef0123")]), RULES)
    assert df.select(join_spans(F.col("secret_spans"), names).alias("s")).first().s == "assign:2:28,hex:8:28"


def satisfied(query, text):
    low = text.lower()
    return all(any(all(t in low for t in term) for term in clause) for clause in query)


def test_queries_never_rule_a_match_out():
    for rule in RULES:
        query = trigram_query(rule.pattern)
        for _, text in nasty(3000, seed=9):
            if re.search(rule.pattern, text, re.ASCII):
                assert satisfied(query, text)
    assert trigram_query(r"[0-9a-f]+") == [] and trigram_query(r"ab|cde") == [] and trigram_query("a.b") == []
    assert trigram_query("AKIA[A-Z0-9]+") == [{frozenset({"aki", "kia"})}]
    assert trigram_query("(?:abcd|xyz)?") == [] and trigram_query("(?:abcd)+x") == [{frozenset({"abc", "bcd"})}]
    assert trigram_query("abc(?:d|e)") == [{frozenset({"abc", "bcd"}), frozenset({"abc", "bce"})}]
    assert trigram_query("foo.*bar") == [{frozenset({"foo"})}, {frozenset({"bar"})}]
