"""Main text of web pages by a tree-structured graphical model over the DOM.

Every element of a page is outside the main text, inside it, or mixed, that is around both; a text block is outside or
inside. What an element shows (its tag, the words of its class and id, its share of the page, a first heading) and what a text block shows (length, share of links,
how it ends) are evidence for its state, and a potential ties the states of parent and child. The potentials are those under
which the labels of labelled pages are most likely. Sum-product messages go up from the leaves and down from the root, for the nodes of many pages
at once, a depth at a time; they give each block's exact marginal, and blocks more likely inside than not are kept.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.llm.columns import add_from_batches
from quern.llm.dom import Node, name_tokens, parse
from quern.llm.layouts import labelled_pages

OUT, MIXED, IN = 0, 1, 2
NEVER = -1e9
#: Steps of the fit, their size, and the pull of weights to 0.
ROUNDS, RATE, SHRINK = 80, 0.15, 0.3
#: Nodes whose messages are computed together, and names of elements remembered by a task.
NODES, REMEMBERED = 100_000, 20_000
ADDED = T.StructType([T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])


def block_evidence(node: Node) -> list[str]:
    """What a text block shows."""
    text = node.text
    size, share = len(text), node.linked / max(1, len(text))
    ending = "stop" if text.endswith((".", "!", "?")) else "none"
    length = "1" if size < 20 else "2" if size < 60 else "3" if size < 150 else "4"
    return [f"size {length}", f"links {0 if share < 0.1 else 1 if share < 0.6 else 2}", f"ends {ending}", f"rights {'©' in text}"]


def element_evidence(node: Node, whole: int) -> tuple[str, str]:
    """What an element shows by its contents, on a page of so much text."""
    share = 10 * node.size // max(1, whole)
    return f"share {0 if share < 1 else 1 if share < 3 else 2 if share < 6 else 3}", f"titled {node.titled or node.tag == 'h1'}"


def shown_by(node: Node, whole: int) -> list[str]:
    """The keys of a node's evidence."""
    if node.tag is None:
        return block_evidence(node)
    named = sorted(f"name {t}" for t in name_tokens(node.attributes))
    return [f"tag {node.tag}", *named, *element_evidence(node, whole)]


def states_of(nodes: list[Node]) -> list[int]:
    """The state of every node of a labelled page: that of the nearest mark; elements around marked ones are mixed."""
    states: list[int] = []
    for n in nodes:
        state = IN if "data-main" in n.attributes else OUT if "data-other" in n.attributes else None
        if state is None:
            state = states[n.parent] if n.parent >= 0 else MIXED
        states.append(OUT if n.tag is None and state == MIXED else state)
    return states


@dataclass
class Model:
    """Potentials as logarithms: `weights` by evidence and state, `ties` by kind (element or text block), parent and child
    state. A page itself is mixed."""

    keys: dict[str, int]
    weights: np.ndarray
    ties: np.ndarray
    seen: dict[tuple, np.ndarray] = field(default_factory=dict)

    def shown(self, node: Node, whole: int) -> np.ndarray:
        key = tuple(block_evidence(node)) if node.tag is None else (node.tag, node.attributes, *element_evidence(node, whole))
        known = self.seen.get(key)
        if known is None:
            rows = [self.keys[k] for k in shown_by(node, whole) if k in self.keys]
            known = self.weights[rows].sum(axis=0)
            if len(self.seen) >= REMEMBERED:
                self.seen.clear()
            self.seen[key] = known
        return known


def fit(pages: Iterable[str], rounds: int = ROUNDS, rate: float = RATE, shrink: float = SHRINK) -> Model:
    """Most likely potentials of labelled pages, by gradient steps: what is counted in them less what the model expects.

    Expected counts are the exact marginals of nodes and of parents with children. `shrink` keeps weights small, so that
    rare names say little.
    """
    forest = Forest([parse(page) for page in pages])
    states = np.array([s for page in forest.pages for s in states_of(page)])
    at, names = [], []
    for i, node in enumerate(forest.nodes):
        if node.depth:
            found = [k for k in shown_by(node, forest.wholes[i]) if k not in ("name main", "name other") or "data-" not in node.attributes]
            names += found
            at += [i] * len(found)
    keys = {k: i for i, k in enumerate(sorted(set(names)))}
    at, column = np.array(at), np.array([keys[k] for k in names])
    model = Model(keys, np.zeros((len(keys), 3)), np.zeros((2, 3, 3)))
    below = np.flatnonzero(forest.depths > 0)
    observed, tied = np.zeros_like(model.weights), np.zeros_like(model.ties)
    np.add.at(observed, (column, states[at]), 1)
    np.add.at(tied, (forest.leaves[below], states[forest.parents[below]], states[below]), 1)
    by_node, by_key = Sums(at), Sums(column)
    steps = [(model.weights, observed), (model.ties, tied)]
    moments = [(np.zeros_like(w), np.zeros_like(w)) for w, _ in steps]
    for n in range(1, rounds + 1):
        shown = np.zeros((len(forest.nodes), 3))
        by_node.add(shown, model.weights[column])
        single, pairs = forest.marginals(model, shown, pairs=True)
        expected = np.zeros_like(model.weights)
        by_key.add(expected, single[at])
        for (w, seen), have, (mean, square) in zip(steps, (expected, pairs), moments):
            slope = (seen - have) - shrink * w
            mean += 0.1 * (slope - mean)
            square += 0.01 * (slope * slope - square)
            w += rate * (mean / (1 - 0.9**n)) / (np.sqrt(square / (1 - 0.99**n)) + 1e-8)
    return model


def _log_sum(values: np.ndarray, axis: int) -> np.ndarray:
    top = values.max(axis=axis, keepdims=True)
    return np.log(np.exp(values - top).sum(axis=axis)) + np.squeeze(top, axis)


class Sums:
    """Adding up rows by number, with the order of the numbers found once."""

    def __init__(self, numbers: np.ndarray):
        self.order = np.argsort(numbers, kind="stable")
        self.numbers, self.starts = np.unique(numbers[self.order], return_index=True)

    def add(self, into: np.ndarray, rows: np.ndarray) -> None:
        if len(self.order):
            into[self.numbers] += np.add.reduceat(rows[self.order], self.starts, axis=0)


class Forest:
    """The nodes of several pages, as arrays; a depth's nodes are treated together."""

    def __init__(self, pages: list[list[Node]]):
        self.pages = pages
        self.nodes = [n for page in pages for n in page]
        sizes = [len(p) for p in pages]
        starts = np.repeat(np.cumsum([0, *sizes])[:-1], sizes)
        self.wholes = [page[0].size for page in pages for _ in page]
        self.parents = np.array([n.parent for n in self.nodes]) + starts
        self.depths = np.array([n.depth for n in self.nodes])
        self.leaves = np.array([int(n.tag is None) for n in self.nodes])
        order = np.argsort(self.depths, kind="stable")
        self.levels = np.split(order, np.flatnonzero(np.diff(self.depths[order])) + 1)
        self.upward = [Sums(self.parents[level]) for level in self.levels]

    def marginals(self, model: Model, shown: np.ndarray, pairs: bool = False):
        """Probability of each state of each node, by messages from the deepest nodes up and from the roots down.

        With `pairs` also the expected number of each pair of states of parent and child, by kind of child.
        """
        # A page is mixed; a text block never is.
        up = shown + np.where((self.depths == 0)[:, None], [NEVER, 0.0, NEVER], 0.0)
        up += np.where((self.leaves == 1)[:, None], [0.0, NEVER, 0.0], 0.0)
        sent = np.zeros_like(up)
        for level, sums in reversed([*zip(self.levels, self.upward)][1:]):
            # What a child says of its parent's states.
            sent[level] = _log_sum(model.ties[self.leaves[level]] + up[level][:, None, :], 2)
            sums.add(up, sent[level])
        both = up.copy()
        counted = np.zeros((2, 3, 3))
        for level in self.levels[1:]:
            without = both[self.parents[level]] - sent[level]
            joint = model.ties[self.leaves[level]] + without[:, :, None]
            both[level] += _log_sum(joint, 1)
            if pairs:
                shares = _shares(joint + up[level][:, None, :])
                for kind in (0, 1):
                    counted[kind] += shares[self.leaves[level] == kind].sum(axis=0)
        single = _shares(both)
        return (single, counted) if pairs else single


def _shares(logs: np.ndarray) -> np.ndarray:
    """Probabilities that add up to 1 per first index."""
    axes = tuple(range(1, logs.ndim))
    weights = np.exp(logs - logs.max(axis=axes, keepdims=True))
    return weights / weights.sum(axis=axes, keepdims=True)


def main_texts(model: Model, pages: list[list[Node]]) -> list[str]:
    """The main text of each parsed page: its inside blocks, each with single spaces, joined by empty lines."""
    forest = Forest(pages)
    shown = np.array([model.shown(n, page[0].size) for page in pages for n in page])
    inside = (forest.marginals(model, shown)[:, IN] > 0.5).tolist()
    out, at = [], 0
    for page in pages:
        out.append("\n\n".join(n.text for n, kept in zip(page, inside[at : at + len(page)]) if kept and n.tag is None))
        at += len(page)
    return out


def extract_main(pages: DataFrame, model: Model | None = None, html_col: str = "html") -> DataFrame:
    """Add text and n_chars to every row: the page's main text and its number of code points.

    The model is fitted on `labelled_pages()` unless one is given. A null or empty page, and one without main text, has an empty
    text. Pages are read whole, of any length and depth, and need not be well formed; rows that repeat have the same text;
    an empty table gives no rows. Other columns stay, but for those with the name of an added one.
    """
    model = model or fit(labelled_pages())

    def run(batch: pa.Array) -> list[pa.Array]:
        texts, waiting, size = [], [], 0
        for page in batch:
            nodes = parse(page.as_py() or "")
            waiting.append(nodes)
            size += len(nodes)
            if size >= NODES:
                texts += main_texts(model, waiting)
                waiting, size = [], 0
        texts += main_texts(model, waiting) if waiting else []
        return [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]

    return add_from_batches(pages.withColumn(html_col, F.col(html_col).cast("string")), [html_col], ADDED, run)
