import hashlib
import random
import zlib

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quern.llm.prefixes import conversation_trie, numbered_turns
from quern.llm.queries import QUERIES

TURNS = "conv_id bigint, turn bigint, role string, text string"


def brute(paths):
    """{conv_id: [(role, text)]} -> rows, by walking every prefix of every conversation."""
    members = {}
    for conv, path in paths.items():
        for depth in range(len(path) + 1):
            members.setdefault(tuple(path[:depth]), []).append(conv)
    own = {p: (len(m) - 1) * len(p[-1][1].encode()) if p else 0 for p, m in members.items()}
    kids = {p: [q for q in members if len(q) == len(p) + 1 and q[: len(p)] == p] for p in members}
    out = []
    for p, m in members.items():
        below = [q for q in members if q[: len(p)] == p]
        ends = ",".join(map(str, sorted(c for c in m if len(paths[c]) == len(p))))
        out.append((
            min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids[p]), sum(not kids[q] for q in below),
            sum(own[q] for q in below), hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=lambda r: r[:2])


def ordered(rows):
    """{conv_id: [(role, text)]} in order."""
    out = {}
    for conv, turn, role, text in rows:
        role, text = role or "", text or ""
        digest = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
        if conv is not None:
            out.setdefault(conv, []).append(((turn is not None, turn or 0, digest), (role, text)))
    return {conv: [turn for _, turn in sorted(turns)] for conv, turns in out.items()}


def rebuilt(paths):
    """The contract's heads, one conversation at a time."""
    out = {}
    for c, own in paths.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = paths.get(c - c % 5, [])[:h] + own[h:]
    return out


def trie(spark, rows, extra=(), **options):
    turns = numbered_turns(spark.createDataFrame(rows, TURNS).selectExpr("*", "1 AS depth", "2 AS place", "3 AS bytes"))
    convs = turns.select("conv_id").union(spark.createDataFrame([(c,) for c in extra], "conv_id bigint")).distinct()
    return sorted((tuple(r) for r in conversation_trie(turns, convs, **options).collect()), key=lambda r: r[:2])


def talk(conv, texts, role="user"):
    return [(conv, i, role, t) for i, t in enumerate(texts)]


def test_awkward_rows(spark):
    rows = [
        *talk(1, "abcdefghij"), *talk(2, "abcdefghij"), *talk(3, "abcdefgxyz"), *talk(4, "abcd"), *talk(5, "abc"), *talk(-6, "abcdefgh"),
        *talk(7, "zbcdefgh"), *talk(8, "a"), (9, None, None, None), (9, 0, "user", ""), (9, 0, "assistant", None), (9, 0, "user", ""),
        (None, 0, "user", "nobody"), (10, 0, "user", "é\U0001d4b3" * 30_000), (11, 0, "user", "é\U0001d4b3" * 30_000), (12, 0, "us", "era"),
        (13, 0, "user", "a"), (14, None, "user", "a"), (15, 5, "user", "a"), *talk(16, ["t"] * 50), *talk(17, ["t"] * 49 + ["u"]),
    ]
    paths = ordered(rows) | {20: [], 21: []}
    for block in (1, 3, 4, 100):
        assert trie(spark, rows, [20, 21], block_turns=block) == brute(paths)
    assert trie(spark, []) == [] and trie(spark, [], [3]) == brute({3: []})


@settings(max_examples=4, deadline=None)
@given(st.lists(st.text("ab", max_size=9), min_size=1, max_size=30))
def test_any_conversations(spark, texts):
    rows = [turn for conv, text in enumerate(texts) for turn in talk(conv, text)]
    assert trie(spark, rows, range(len(texts)), block_turns=3) == brute({c: [] for c in range(len(texts))} | ordered(rows))


def test_one_conversation_and_one_first_turn_with_most_rows(spark):
    rnd = random.Random(2)
    rows = [*talk(0, [str(i % 7) for i in range(400)]), *talk(1, [str(i % 7) for i in range(300)])]
    rows += [t for c in range(2, 80) for t in talk(c, ["0", *[rnd.choice("12") for _ in range(3)]])]
    assert trie(spark, rows, limit=50) == brute(ordered(rows))


def test_inner_turns_of_a_shared_block_are_not_grouped(spark, monkeypatch):
    """Only blocks in which siblings diverge are refined."""
    import quern.llm.prefixes as P

    kept = {}
    store = P.stored
    monkeypatch.setattr(P, "stored", lambda df, label: kept.setdefault(label, store(df, label)))
    rows = [*talk(1, "abcdefgh"), *talk(2, "abcdefgh"), *talk(3, "abcdxfgh"), *talk(4, "abcd")]
    trie(spark, rows, block_turns=4)
    assert sorted((r.conv_id, r.depth) for r in kept["refined-turns"].collect()) == [(c, d) for c in (1, 2, 3) for d in (5, 6, 7, 8)]


def test_query(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = sorted((tuple(r) for r in QUERIES["op11_prefix_trie"](spark, sf).collect()), key=lambda r: r[:2])
    assert got == brute(rebuilt(ordered(rows)))
    # Absent and short first conversations, conversations left without a turn, repeats and nulls.
    rows = [turn for c in (1, 2, 3, 5, 6, 7, 9, 12, 13, 14, 20, 21, 22, 1003, 1004) for turn in talk(c, "abcdefghijk"[: c % 11])]
    rows += [(5, None, None, None), (None, 1, "user", "x"), (30, 0, "user", "only"), (31, 0, "user", "gone")]
    spark.createDataFrame(rows, TURNS).write.parquet(f"{tmp_path}/conversations.parquet")
    got = sorted((tuple(r) for r in QUERIES["op11_prefix_trie"](spark, str(tmp_path)).collect()), key=lambda r: r[:2])
    assert got == brute(rebuilt(ordered(rows))) and any(not p for p in rebuilt(ordered(rows)).values())
