"""Quality rules: fixed rules on document statistics, and boosted trees over them for what passes.

The statistics are computed for runs of texts at once from their bytes and word hashes. The trees (`trees.py`) are fitted
on a bounded sample of labelled documents; shares of symbols, capitals, repeated lines and repeated words can only lower
the score.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.llm.columns import add_from_batches
from quern.llm.sketches import CHUNK, SPACES, windows, words_of
from quern.llm.trees import Forest, fit_forest

# Fixed values of the base rules.
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = b"#*$%&|<>"
MARKS = b".,;:!?"

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: Labelled documents that the trees are fitted on, at most.
SAMPLE_ROWS = 4000

#: Feature and the direction in which it may move the score.
FEATURES = {
    "log_words": 0, "chars_per_word": 0, "symbols_per_word": -1, "dup_line_share": -1, "repeat_share": -1,
    "distinct_share": 0, "capital_share": -1, "digit_share": 0, "marks_per_word": 0, "words_per_line": 0,
}


def _byte_counts(part: np.ndarray) -> np.ndarray:
    return sum((np.bincount(part[i : i + CHUNK], minlength=256) for i in range(0, len(part), CHUNK)), np.zeros(256, np.int64))


def _repeat_words(grams: np.ndarray) -> int:
    """Words that lie in a three-word window found twice or more."""
    if len(grams) < 2:
        return 0
    _, which, counts = np.unique(grams, return_inverse=True, return_counts=True)
    again = counts[which] > 1
    covered = np.zeros(len(grams) + 2, bool)
    for k in range(3):
        covered[k : k + len(grams)] |= again
    return int(covered.sum())


def statistics(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(COUNTS, FEATURES) of each text, as two arrays with a row per text; null counts as empty.

    Words are runs of anything but ASCII white space. All whole texts are read; a long one is worked on in pieces.
    """
    counts, features = [], []
    symbols, marks = list(SYMBOLS), list(MARKS)
    for _, _, part, bounds, hashes, words in words_of(texts):
        grams = windows(hashes, 3)
        for k in range(len(bounds) - 1):
            text, lo, hi = part[bounds[k] : bounds[k + 1]], int(words[k]), int(words[k + 1])
            bytes_of = _byte_counts(text)
            n = hi - lo
            chars = len(text) - int(bytes_of[128:192].sum()) - int(bytes_of[SPACES].sum())
            lines = [line for line in text.tobytes().split(b"\n") if line.strip()]
            dup = len(lines) - len(set(lines))
            repeat = _repeat_words(grams[lo : max(lo, hi - 2)])
            per_word, per_line, per_char = 1 / max(n, 1), 1 / max(len(lines), 1), 1 / max(chars, 1)
            n_symbols = int(bytes_of[symbols].sum())
            counts.append((n, chars, n_symbols, dup, repeat))
            features.append((
                np.log1p(n), chars * per_word, n_symbols * per_word, dup * per_line, repeat * per_word,
                len(np.unique(hashes[lo:hi])) * per_word, bytes_of[65:91].sum() * per_char,
                bytes_of[48:58].sum() * per_char, bytes_of[marks].sum() * per_word, n * per_line,
            ))
    return np.array(counts, np.int64).reshape(-1, len(COUNTS)), np.array(features, float).reshape(-1, len(FEATURES))


def fit_quality(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
    sample_rows: int = SAMPLE_ROWS,
) -> Forest:
    """Trees for the label (1: good) on at most `sample_rows` labelled documents, drawn by a hash of the id.

    The sample and its statistics (ten numbers a document) are all that the driver sees. Rows without an id or label are
    left out; of rows that repeat an id, one counts. Without usable labels every document is held good.
    """
    key = F.col(id_col).cast("bigint")
    sample = (
        labels.select(key.alias("id"), F.col(label_col).cast("int").alias("good"))
        .where("id is not null and good is not null")
        .groupBy("id").agg(F.min("good").alias("good"))
        .orderBy(F.xxhash64("id"), "id").limit(sample_rows)
    )
    texts = docs.select(key.alias("id"), F.col(text_col).cast("string").alias("text")).join(F.broadcast(sample), "id")
    measured = add_from_batches(
        texts, ["text"], T.StructType([T.StructField("features", T.ArrayType(T.DoubleType()))]),
        lambda t: [pa.array(list(statistics(t)[1]), pa.list_(pa.float64()))],
    )
    rows = measured.groupBy("id").agg(F.min(F.struct("good", "features")).alias("row")).orderBy("id").collect()
    x = np.array([r.row.features for r in rows], float).reshape(-1, len(FEATURES))
    y = np.array([r.row.good for r in rows], float)
    return fit_forest(x, y, list(FEATURES.values()))


def judge_quality(docs: DataFrame, forest: Forest, text_col: str = "text", least: float = 0.5) -> DataFrame:
    """Add the counts, base_failed, quality_score and kept to every row.

    base_failed: under 50 words, or more than half of the words in repeated three-word windows. A document is kept when the
    base rules pass it and its score is `least` or more. A null text has no words, and so fails; rows that repeat are
    judged alike; an empty table gives no rows. Other columns stay, but for those with the name of an added one.
    """
    added = T.StructType(
        [T.StructField(c, T.LongType()) for c in COUNTS]
        + [T.StructField("base_failed", T.BooleanType()), T.StructField("quality_score", T.DoubleType())]
        + [T.StructField("kept", T.BooleanType())]
    )

    def judge(texts: pa.Array) -> list[pa.Array]:
        counts, features = statistics(texts)
        n, repeat = counts[:, 0], counts[:, 4]
        failed = (n < MIN_WORDS) | (100 * repeat > MAX_REPEAT_PERCENT * n)
        score = forest.probability(features)
        return [*map(pa.array, counts.T.copy()), pa.array(failed), pa.array(score), pa.array(~failed & (score >= least))]

    return add_from_batches(docs, [text_col], added, judge)
