"""Quality rules: counting rules first, then gradient-boosted trees over document statistics.

Statistics of a text (words are runs of anything but space and the controls 9 to 13):

    n_words         words
    word_chars      code points in words
    n_symbols       characters # * $ % & | < >
    n_dup_lines     lines, split at newlines, that hold a word and equal an earlier line
    n_repeat_words  words that lie in a window of eight words found twice or more

A document fails the base rules with fewer than 20 words, or with more than 30 % of its words in
repeated windows. The others are judged by boosted regression trees on shares built from these
counts and a few more (capitals, exclamation marks, bars, digits, distinct words, line lengths).

Trees are grown on binned features with the logistic loss. Features listed in ``FALLING`` may only
lower the score: a split that would raise it is refused, and the middle of its two values bounds all
values below it, so the ordering holds for whole trees. Fitted trees are laid out flat, as arrays of
split feature, threshold, left child and value, and batches descend all trees level by level in numpy.

Fitting takes a bounded sample: ``Fit.rows`` labelled documents chosen by a hash of doc_id. Everything
else reads whole texts of all documents.

Defined cases: a NULL or blank text has counts 0 and fails the base rules. Labels with NULL doc_id or
quality are ignored; of several labels of a document the lowest counts. Without labels of both
classes, all documents that pass the base rules are kept. Repeated rows each give a row; an empty
table gives none. Columns other than doc_id and text are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldspark.llm.common import hashed_share, over_batches, texts, window_hashes, word_hashes

SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
WINDOW = 8
COUNTS = [
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_capitals", "n_exclamations", "n_bars", "n_digits", "n_distinct_words", "n_chars",
]
FEATURES = [
    "log_words", "word_length", "symbol_share", "dup_line_share", "repeat_share", "words_per_line",
    "capital_share", "exclamation_share", "bar_share", "digit_share", "distinct_share",
]
# More of these never makes a document better.
FALLING = ["symbol_share", "dup_line_share", "repeat_share", "capital_share", "exclamation_share", "bar_share"]


@dataclass(frozen=True)
class Fit:
    """Bound of the training sample and settings of the trees."""

    rows: int = 12_000
    trees: int = 60
    depth: int = 4
    rate: float = 0.15
    bins: int = 48
    smallest_leaf: int = 20
    damping: float = 1.0
    keep_from: float = 0.5


def text_counts(text: str | None) -> list[int]:
    """The counts of one text, in the order of ``COUNTS``."""
    if not text:
        return [0] * len(COUNTS)
    raw = text.encode()
    words = raw.split()
    lines = [line for line in text.split("\n") if line.strip(BLANKS)]
    hashes = word_hashes(words)
    return [
        len(words), len(text) - sum(map(text.count, BLANKS)), sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)), _repeated(hashes), len(lines),
        _between(raw, b"A", b"Z"), text.count("!"), text.count("|"), _between(raw, b"0", b"9"),
        len(np.unique(hashes)), len(text),
    ]


def _between(raw: bytes, low: bytes, high: bytes) -> int:
    return int(np.count_nonzero(np.frombuffer(raw, np.uint8) - np.uint8(low[0]) <= high[0] - low[0]))


def _repeated(hashes: np.ndarray) -> int:
    """Words inside windows that occur twice or more."""
    if len(hashes) <= WINDOW:
        return 0
    windows = window_hashes(hashes, WINDOW)
    known, at, counts = np.unique(windows, return_inverse=True, return_counts=True)
    if len(known) == len(windows):
        return 0
    again = counts[at] > 1
    edges = np.zeros(len(hashes) + 1, np.int64)
    edges[:-WINDOW][again] += 1
    edges[WINDOW:][again] -= 1
    return int(np.count_nonzero(np.cumsum(edges[:-1])))


def features(counts: np.ndarray) -> np.ndarray:
    """Feature columns, in the order of ``FEATURES``, from count columns."""
    column = dict(zip(COUNTS, counts.T.astype(float), strict=True))
    words, chars, lines = (np.maximum(column[name], 1) for name in ("n_words", "n_chars", "n_lines"))
    return np.stack([
        np.log(words), column["word_chars"] / words, column["n_symbols"] / words, column["n_dup_lines"] / lines,
        column["n_repeat_words"] / words, column["n_words"] / lines, column["n_capitals"] / chars,
        column["n_exclamations"] / words, column["n_bars"] / words, column["n_digits"] / chars,
        column["n_distinct_words"] / words,
    ], axis=1)


@dataclass
class FlatTrees:
    """All trees in one set of node arrays. A leaf is its own child, so that descent may go on."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    base: float

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Probability of good quality."""
        at = np.broadcast_to(self.roots, (len(rows), len(self.roots))).copy()
        each = np.arange(len(rows))[:, None]
        for _ in range(self.depth):
            beyond = rows[each, self.feature[at]] > self.threshold[at]
            at = self.left[at] + (beyond & (self.left[at] != at))
        return 1 / (1 + np.exp(-self.base - self.value[at].sum(axis=1)))


def fit_trees(rows: np.ndarray, good: np.ndarray, fit: Fit, falling: list[int]) -> FlatTrees:
    """Boosted trees for P(good); features listed in ``falling`` may only lower it."""
    edges = [np.unique(np.quantile(column, np.linspace(0, 1, fit.bins + 1)[1:-1])) for column in rows.T]
    binned = np.stack([np.searchsorted(edge, column) for edge, column in zip(edges, rows.T, strict=True)], axis=1)
    share = np.clip(good.mean(), 1e-3, 1 - 1e-3)
    base = float(np.log(share / (1 - share)))
    margin = np.full(len(rows), base)
    nodes: list[list[float]] = []  # feature, threshold, left child, value
    roots = []
    for _ in range(fit.trees):
        chance = 1 / (1 + np.exp(-margin))
        slope, bend = good - chance, chance * (1 - chance)
        roots.append(len(nodes))
        nodes.append([0, 0.0, len(nodes), 0.0])
        open_nodes = [(roots[-1], np.arange(len(rows)), -np.inf, np.inf)]
        for level in range(fit.depth + 1):
            following = []
            for node, members, low, high in open_nodes:
                value = _leaf(slope[members].sum(), bend[members].sum(), fit, low, high)
                split = _best_split(binned[members], slope[members], bend[members], edges, fit, falling, low, high) if level < fit.depth else None
                if split is None:
                    nodes[node][3] = fit.rate * value
                    margin[members] += fit.rate * value
                    continue
                feature, place, left_value, right_value = split
                child = len(nodes)
                nodes[node][:3] = [feature, edges[feature][place], child]
                nodes += [[0, 0.0, child, 0.0], [0, 0.0, child + 1, 0.0]]
                goes_left = binned[members, feature] <= place
                middle = (left_value + right_value) / 2
                bounds = [(low, high), (low, high)]
                if feature in falling:
                    bounds = [(max(low, middle), high), (low, min(high, middle))]
                following.append((child, members[goes_left], *bounds[0]))
                following.append((child + 1, members[~goes_left], *bounds[1]))
            open_nodes = following
    table = np.array(nodes)
    return FlatTrees(
        table[:, 0].astype(np.int64), table[:, 1], table[:, 2].astype(np.int64), table[:, 3], np.array(roots), fit.depth, base
    )


def _leaf(slope, bend, fit: Fit, low: float, high: float):
    return np.clip(slope / (bend + fit.damping), low, high)


def _best_split(binned, slope, bend, edges, fit: Fit, falling, low, high):
    """Best (feature, edge, left value, right value), or None if nothing gains."""
    best, best_gain = None, 1e-6
    total_slope, total_bend, count = slope.sum(), bend.sum(), len(slope)
    whole = _leaf(total_slope, total_bend, fit, low, high)

    def worth(s, b, value):
        return s * value - 0.5 * (b + fit.damping) * value**2

    for feature, edge in enumerate(edges):
        size = len(edge) + 1
        if size < 2:
            continue
        left_slope = np.bincount(binned[:, feature], slope, size).cumsum()[:-1]
        left_bend = np.bincount(binned[:, feature], bend, size).cumsum()[:-1]
        left_count = np.bincount(binned[:, feature], minlength=size).cumsum()[:-1]
        left = _leaf(left_slope, left_bend, fit, low, high)
        right = _leaf(total_slope - left_slope, total_bend - left_bend, fit, low, high)
        gain = worth(left_slope, left_bend, left) + worth(total_slope - left_slope, total_bend - left_bend, right)
        gain = gain - worth(total_slope, total_bend, whole)
        allowed = (left_count >= fit.smallest_leaf) & (count - left_count >= fit.smallest_leaf)
        if feature in falling:
            allowed &= left >= right
        gain = np.where(allowed, gain, -np.inf)
        place = int(gain.argmax())
        if gain[place] > best_gain:
            best, best_gain = (feature, place, float(left[place]), float(right[place])), gain[place]
    return best


def training_sample(docs: DataFrame, labels: DataFrame, fit: Fit) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the bounded sample: at most ``fit.rows`` labelled documents."""
    graded = labels.where("doc_id is not null and quality is not null").groupBy(
        F.col("doc_id").cast("long").alias("doc_id")
    ).agg(F.min("quality").alias("quality"))
    share = min(1.0, 1.1 * fit.rows / max(1, graded.count()))
    # Bounded by the sample size, so it may be sent to every task.
    chosen = graded.where(hashed_share("doc_id", F.lit(share))).orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit.rows)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id")

    def start():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            counts = np.array([text_counts(text) for text in texts(batch)])
            return pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("quality"), *[pa.array(c) for c in counts.T]], ["doc_id", "quality", *COUNTS]
            )
        return step

    schema = "doc_id long, quality long, " + ", ".join(f"{name} long" for name in COUNTS)
    found = over_batches(rows.select("doc_id", "text", F.col("quality").cast("long").alias("quality")), schema, start).toPandas()
    found = found.sort_values(["doc_id", *COUNTS]).drop_duplicates("doc_id")
    return features(found[COUNTS].to_numpy()), (found["quality"].to_numpy() > 0).astype(float)


def fit_quality(docs: DataFrame, labels: DataFrame, fit: Fit = Fit()) -> FlatTrees | None:
    """Trees fitted on a labelled sample; None without labels of both classes."""
    rows, good = training_sample(docs, labels, fit)
    if not len(good) or good.min() == good.max():
        return None
    return fit_trees(rows, good, fit, [FEATURES.index(name) for name in FALLING])


def judge(docs: DataFrame, trees: FlatTrees | None, fit: Fit = Fit()) -> DataFrame:
    """Rows (doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, score)."""
    def start():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            counts = np.array([text_counts(text) for text in texts(batch)])
            words, repeated = counts[:, 0], counts[:, COUNTS.index("n_repeat_words")]
            failed = (words < 20) | (100 * repeated > 30 * words)
            score = trees.score(features(counts)) if trees else np.ones(len(counts))
            return pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(c) for c in counts.T[:5]], pa.array(failed),
                 pa.array(~failed & (score >= fit.keep_from)), pa.array(score)],
                ["doc_id", *COUNTS[:5], "base_failed", "kept", "score"],
            )
        return step

    schema = "doc_id long, " + ", ".join(f"{name} long" for name in COUNTS[:5]) + ", base_failed boolean, kept boolean, score double"
    return over_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), schema, start)
