"""Boolean trigram queries derived from regular expressions.

A query is a conjunction of clauses; a clause is a choice of terms; a term is a set of trigrams that all have to occur in a
(lower-cased) text. Every text that an expression matches satisfies its query. An expression that forces no trigram has
an empty query, which every text satisfies.
"""

from __future__ import annotations

import re
from re import _constants as op
from re import _parser as parser

Term = frozenset[str]
Query = list[set[Term]]

#: A run of literal choices is cut where it would stand for more strings than this.
MOST_STRINGS = 64


def _fold(char: int) -> str:
    """Lower-case, as the texts of the index are; characters outside ASCII break a run."""
    return chr(char).lower() if char < 128 else ""


def _class(items) -> list[str] | None:
    """The characters of a class, if they are few."""
    chars: set[str] = set()
    for kind, value in items:
        if kind is op.LITERAL:
            chars.add(_fold(value))
        elif kind is op.RANGE and value[1] - value[0] < 8:
            chars.update(_fold(c) for c in range(value[0], value[1] + 1))
        else:
            return None
    return None if "" in chars or len(chars) > 8 else sorted(chars)


def _strings(node) -> list[str] | None:
    """All strings that an element can match, if they are few."""
    kind, value = node
    if kind is op.LITERAL:
        return [_fold(value)] if _fold(value) else None
    if kind is op.IN:
        return _class(value)
    if kind is op.AT:
        return [""]
    if kind is op.SUBPATTERN:
        return _join(value[-1])
    if kind is op.BRANCH:
        found = [_join(branch) for branch in value[1]]
        return None if None in found else _few([s for f in found for s in f])
    if kind in (op.MAX_REPEAT, op.MIN_REPEAT):
        low, high, body = value
        if high is op.MAXREPEAT or high > 4:
            return None
        once = _join(body)
        if once is None:
            return None
        runs, out = [""], [""] if low == 0 else []
        for n in range(1, high + 1):
            runs = _few([r + s for r in runs for s in once])
            if runs is None:
                return None
            out += runs if n >= low else []
        return _few(out)
    return None


def _few(strings: list[str]) -> list[str] | None:
    strings = sorted(set(strings))
    return strings if len(strings) <= MOST_STRINGS else None


def _join(sequence) -> list[str] | None:
    out: list[str] | None = [""]
    for node in sequence:
        found = _strings(node)
        out = None if found is None else _few([a + b for a in out for b in found])
        if out is None:
            return None
    return out


def _clause(strings: list[str]) -> set[Term] | None:
    """One term per string, but for those that say no more than another; None if a string is too short for a trigram."""
    if any(len(s) < 3 for s in strings):
        return None
    terms = {frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings}
    return {t for t in terms if not any(other < t for other in terms)}


def _walk(sequence) -> Query:
    query: Query = []
    run = [""]

    def flush():
        nonlocal run
        clause = _clause(run)
        if clause:
            query.append(clause)
        run = [""]

    for node in sequence:
        kind, value = node
        found = _strings(node)
        if found is not None:
            longer = _few([a + b for a in run for b in found])
            if longer is None:
                flush()
                longer = found
            run = longer
            continue
        if kind in (op.MAX_REPEAT, op.MIN_REPEAT) and value[0] > 0:
            once = _join(value[2])
            if once is not None:
                # What is repeated occurs once at least: it ends this run, and begins none.
                longer = _few([a + b for a in run for b in once])
                run = longer if longer is not None else run
                flush()
                continue
        flush()
        if kind is op.SUBPATTERN:
            query += _walk(value[-1])
        elif kind in (op.MAX_REPEAT, op.MIN_REPEAT) and value[0] > 0:
            query += _walk(value[2])
    flush()
    return query


def trigram_query(pattern: str) -> Query:
    return _walk(parser.parse(pattern, re.ASCII))
