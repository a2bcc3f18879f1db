"""Secret scans over a trigram inverted index, in DataFrame operations only.

Every rule's expression gives a Boolean query over trigrams (`trigrams.py`). The index holds a posting for each trigram
that any query names and each text it occurs in. A rule's candidates are the texts whose postings satisfy its query; they
alone run the expression. A rule without a mandatory trigram scans every text.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.llm.columns import without
from quern.llm.storage import stored
from quern.llm.trigrams import Query, trigram_query

SPAN = "struct<start:int,kind:int,end:int>"


@dataclass(frozen=True)
class Rule:
    """A kind of secret: an expression, and how long a match has to be (or one of its groups).

    Matches are the leftmost ones that do not overlap; one that is too short is dropped afterwards.
    """

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


# The base rules, and kinds with a fixed mark.
BASE_RULES = [
    Rule(
        "assign",
        r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        group=2,
        least=12,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", least=18),
    Rule("hex", r"[0-9a-f]+", least=16),
]
MORE_RULES = [
    Rule("private_key", r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----[A-Za-z0-9+/=\s]*(?:-----END [A-Z ]{0,20}PRIVATE KEY-----)?"),
    Rule("forge_token", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("cloud_key", r"AIza[A-Za-z0-9_-]{35}"),
]


def spans_of(text: Column, rule: Rule, number: int) -> Column:
    """All matches of a rule as (start, kind, end) in code points.

    The text is cut at the matches; the lengths of the pieces between them and of the matches, added up, are the places.
    """
    pieces = F.transform(F.split(text, rule.pattern, -1), lambda p: F.length(p))
    found = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    measured = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)) if rule.group else found
    steps = F.arrays_zip(
        F.slice(pieces, 1, F.size(found)).alias("gap"),
        F.transform(found, lambda m: F.length(m)).alias("size"),
        F.transform(measured, lambda m: F.length(m)).alias("measured"),
    )
    none = F.array().cast(f"array<{SPAN}>")

    def step(state: Column, item: Column) -> Column:
        start = state["at"] + item["gap"]
        end = start + item["size"]
        span = F.array(F.struct(start.alias("start"), F.lit(number).alias("kind"), end.alias("end")))
        added = F.when(item["measured"] >= rule.least, F.concat(state["spans"], span)).otherwise(state["spans"])
        return F.struct(end.alias("at"), added.alias("spans"))

    begin = F.struct(F.lit(0).alias("at"), none.alias("spans"))
    return F.aggregate(steps, begin, step, lambda state: state["spans"])


def quick_test(rule: Rule) -> str:
    """An expression that finds whether a text has a long enough match at all (never misses one)."""
    if rule.group == 0 and rule.least > 1 and rule.pattern.endswith("]+") and rule.pattern.count("+") == 1:
        head, _, chars = rule.pattern[:-1].rpartition("[")
        return f"{head}[{chars}{{{rule.least - len(head)}}}"
    return rule.pattern


def build_index(texts: DataFrame, queries: Sequence[Query]) -> DataFrame:
    """Postings (trigram, __key) of every trigram that a query names, from `texts` (__key, __text)."""
    wanted = sorted({t for query in queries for clause in query for term in clause for t in term})
    if not wanted:
        return texts.select(F.lit("").alias("trigram"), "__key").limit(0)
    lowered = texts.select("__key", F.lower("__text").alias("__text"))
    present = F.filter(F.array(*map(F.lit, wanted)), lambda t: F.contains(F.col("__text"), t))
    return lowered.select(F.explode(present).alias("trigram"), "__key")


def candidates(postings: DataFrame, queries: Sequence[Query]) -> DataFrame:
    """(__key, __rules): the numbers of the rules whose query the postings of a text satisfy."""
    held = postings.groupBy("__key").agg(F.collect_set("trigram").alias("held"))

    def satisfied(query: Query) -> Column:
        clauses = []
        for clause in query:
            terms = [
                reduce(lambda a, b: a & b, [F.array_contains("held", t) for t in sorted(term)])
                for term in sorted(clause, key=sorted)
            ]
            clauses.append(reduce(lambda a, b: a | b, terms))
        return reduce(lambda a, b: a & b, clauses)

    numbers = [F.when(satisfied(q), F.lit(i)) for i, q in enumerate(queries) if q]
    if not numbers:
        return held.select("__key", F.array().cast("array<int>").alias("__rules")).limit(0)
    return held.select("__key", F.array_compact(F.array(*numbers)).alias("__rules")).where(F.size("__rules") > 0)


def join_spans(spans: Column, names: Sequence[str]) -> Column:
    """kind:start:end by start, then kind in the order of the rules, joined by commas."""
    kinds = F.array(*map(F.lit, names))
    text = F.transform(
        F.array_sort(spans),
        lambda s: F.concat_ws(":", F.element_at(kinds, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")),
    )
    return F.array_join(text, ",")


def scan_secrets(
    docs: DataFrame, rules: Sequence[Rule], id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Add secret_spans, (start, kind, end) by start and kind: kind is the rule's number, places are in code points.

    Whole texts are scanned; a null text is empty and has no spans. Rows that repeat are scanned alike, with a null id
    too; an empty table gives no rows; other columns stay, but for one called secret_spans. Texts are told apart by id
    and a hash of the text. Only the candidates' texts are moved, to meet their rules; then spans, not texts, are joined
    to the rows.
    """
    queries = [trigram_query(r.pattern) for r in rules]
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    key = F.struct(F.col(id_col).alias("id"), F.xxhash64(text).alias("hash"))
    base = without(docs, ["secret_spans"])
    texts = docs.select(key.alias("__key"), text.alias("__text"))
    hits = stored(candidates(build_index(texts, queries), queries), "candidates")
    every = [(i, r) for i, r in enumerate(rules) if not queries[i]]
    some = [(i, r) for i, r in enumerate(rules) if queries[i]]
    none = F.array().cast(f"array<{SPAN}>")

    def found(column: Column, chosen: Sequence[tuple[int, Rule]], when) -> Column:
        parts = [F.when(when(i, r), spans_of(column, r, i)).otherwise(none) for i, r in chosen]
        return F.concat(none, *parts)

    checked = stored(
        texts.join(hits, "__key")
        .select("__key", found(F.col("__text"), some, lambda i, _: F.array_contains("__rules", i)).alias("__found"))
        .where(F.size("__found") > 0)
        .dropDuplicates(["__key"]),
        "spans",
    )
    own = found(text, every, lambda _, r: F.rlike(text, F.lit(quick_test(r))))
    marked = base.withColumn("__key", key).withColumn("__own", own)
    return (
        marked.join(checked, "__key", "left")
        .withColumn("secret_spans", F.array_sort(F.concat("__own", F.coalesce("__found", none))))
        .drop("__key", "__own", "__found")
    )


def redact(docs: DataFrame, text_col: str = "text", mark: str = "[secret]") -> DataFrame:
    """Put `mark` in the place of every span of secret_spans; spans that overlap or touch become one mark."""
    text = F.col(text_col)
    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))

    def step(state: Column, span: Column) -> Column:
        gap = F.substring(text, state["at"] + 1, span["start"] - state["at"])
        fresh = (span["start"] > state["at"]) | (F.size(state["parts"]) == 0)
        added = F.when(fresh, F.concat(state["parts"], F.array(gap, F.lit(mark)))).otherwise(state["parts"])
        return F.struct(F.greatest(state["at"], span["end"]).alias("at"), added.alias("parts"))

    def finish(state: Column) -> Column:
        return F.concat(F.array_join(state["parts"], ""), F.substring(text, state["at"] + 1, F.length(text)))

    cleaned = F.when(F.size("secret_spans") > 0, F.aggregate("secret_spans", begin, step, finish)).otherwise(text)
    return docs.withColumn(text_col, cleaned)
