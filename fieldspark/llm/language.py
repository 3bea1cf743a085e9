"""Language of documents by a linear-chain conditional random field over their words.

Each word has features: its affixes, its letter n-grams and, as lexicon entry, the word itself. The
field scores a label sequence by the features of each word and by a learned weight for each pair of
successive labels; forward-backward gives every word's label probabilities within its text, so a
text that switches language keeps each stretch's own label. A document's prediction is the label with
the highest mean probability over its words, and its score is that mean.

Fitting takes a bounded sample: about ``Fit.documents`` labelled rows per language, chosen by a hash
of doc_id, and from each a window of ``Fit.window`` characters at a hashed place. Half of the training
sequences are windows as they are; the other half alternate stretches of different languages, so that
the transition weights know switches. Prediction reads every text whole.

The chain runs in blocks: all blocks of a batch advance together, each giving the matrix that carries
label weights across it; those matrices connect the blocks of a document; a second pass yields the
probabilities of each word. Time is linear in the words and memory bounded, however long a text.

Defined cases: text NULL or without a letter: ``und`` with score 0. Rows with NULL lang or NULL doc_id
are not learned from; a NULL doc_id is not held out. Without any row to learn from, all are ``und``.
Repeated rows each give a row, an empty table none. Only text and, for fitting, lang are looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from fieldspark.llm.common import hashed_share, over_batches, texts

UNKNOWN = "und"
BLOCK = 64
# Words whose chain runs at once, and most word types whose scores a task keeps.
TOGETHER, KEPT = 200_000, 300_000
_WORD = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class Fit:
    """Bounds and settings of the training sample."""

    documents: int = 250
    window: int = 2_000
    stretch: int = 12
    rounds: int = 60
    rate: float = 0.3
    decay: float = 1e-3
    seed: int = 7


@dataclass
class Field:
    """Labels, feature numbers, weights (features x labels) and transition weights."""

    labels: list[str]
    features: dict[str, int]
    weights: np.ndarray
    transitions: np.ndarray


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def word_features(word: str) -> list[str]:
    """Lexicon entry, affixes up to three letters and letter pairs and triples."""
    framed = f"^{word}$"
    found = ["=" + word]
    for n in (1, 2, 3):
        found += ["<" + word[:n], ">" + word[-n:]]
    for n in (2, 3):
        found += [framed[k:k + n] for k in range(len(framed) - n + 1)]
    return found


def posteriors(emissions: np.ndarray, lengths: np.ndarray, transitions: np.ndarray):
    """Label probabilities of each word, and expected label pairs, of sequences laid end to end.

    ``emissions``: positive weights (words x labels); ``lengths``: words of each sequence, none 0;
    ``transitions``: positive weights (labels x labels), also applied before the first word.
    """
    count = emissions.shape[1]
    blocks = -(-lengths // BLOCK)
    owner = np.repeat(np.arange(len(lengths)), blocks)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    begin = np.repeat(np.cumsum(lengths) - lengths, blocks) + nth * BLOCK
    size = np.minimum(BLOCK, np.repeat(lengths, blocks) - nth * BLOCK)
    order = np.argsort(-size, kind="stable")
    begin, size, owner, nth = begin[order], size[order], owner[order], nth[order]
    live = [int(np.searchsorted(-size, -t)) for t in range(BLOCK)]  # blocks longer than t come first

    # Matrix of each block: label weights before it to label weights after it.
    across = np.broadcast_to(np.eye(count), (len(begin), count, count)).copy()
    for t in range(BLOCK):
        k = live[t]
        if not k:
            break
        moved = (across[:k].reshape(-1, count) @ transitions).reshape(k, count, count)
        moved *= emissions[begin[:k] + t][:, None, :]
        across[:k] = moved / moved.max(axis=(1, 2), keepdims=True)

    # Connect the blocks of each sequence, all sequences side by side.
    at = np.empty((len(lengths), int(blocks.max())), np.int64)
    at[owner, nth] = np.arange(len(owner))
    entry, exit_ = np.empty((len(begin), count)), np.empty((len(begin), count))
    by_length = np.argsort(-blocks, kind="stable")
    for direction in (1, -1):
        state = np.full((len(lengths), count), 1.0 / count)
        for step in range(int(blocks.max())):
            here = by_length[: int(np.searchsorted(-blocks[by_length], -step))]
            block = at[here, step if direction == 1 else blocks[here] - 1 - step]
            (entry if direction == 1 else exit_)[block] = state[here]
            matrix = across[block] if direction == 1 else across[block].transpose(0, 2, 1)
            moved = np.einsum("bi,bij->bj", state[here], matrix)
            state[here] = moved / moved.sum(axis=1, keepdims=True)

    forward = np.empty_like(emissions)
    state = entry
    for t in range(BLOCK):
        k = live[t]
        if not k:
            break
        moved = (state[:k] @ transitions) * emissions[begin[:k] + t]
        state[:k] = forward[begin[:k] + t] = moved / moved.sum(axis=1, keepdims=True)
    pairs = np.zeros((count, count))
    result = np.empty_like(emissions)
    state = exit_
    for t in range(BLOCK - 1, -1, -1):
        k = live[t]
        if not k:
            continue
        places = begin[:k] + t
        joint = forward[places] * state[:k]
        result[places] = joint / joint.sum(axis=1, keepdims=True)
        weighed = emissions[places] * state[:k]
        inner = np.ones(k, bool) if t else nth[:k] > 0
        previous = forward[places[inner] - 1]
        total = np.einsum("bi,ij,bj->b", previous, transitions, weighed[inner])
        pairs += (previous / total[:, None]).T @ weighed[inner] * transitions
        moved = weighed @ transitions.T
        state[:k] = moved / moved.sum(axis=1, keepdims=True)
    return result, pairs


def fit_field(samples: Iterable[tuple[str, str]], fit: Fit) -> Field | None:
    """Fit by gradient steps on the log-likelihood of (text, label) samples; None without words."""
    sequences = [(words, label) for text, label in samples if (words := words_of(text))]
    labels = sorted({label for _, label in sequences})
    if not labels:
        return None
    number = {label: k for k, label in enumerate(labels)}
    rng = np.random.default_rng(fit.seed)
    chains = [(words, [number[label]] * len(words)) for words, label in sequences]
    chains = chains[::2] + _switching(chains[1::2], fit.stretch, rng)

    types: dict[str, int] = {}
    word_ids = np.array([types.setdefault(w, len(types)) for words, _ in chains for w in words])
    truth = np.array([label for _, own in chains for label in own])
    lengths = np.array([len(words) for words, _ in chains])
    names: dict[str, int] = {}
    listed = [[names.setdefault(f, len(names)) for f in word_features(w)] for w in types]
    flat = np.concatenate(listed)
    per_type = np.array([len(f) for f in listed])
    starts = np.cumsum(per_type) - per_type

    count = len(labels)
    inner = np.ones(len(truth), bool)
    inner[np.cumsum(lengths) - lengths] = False
    seen_pairs = np.zeros((count, count))
    np.add.at(seen_pairs, (truth[np.flatnonzero(inner) - 1], truth[inner]), 1)
    seen = np.zeros((len(types), count))
    np.add.at(seen, (word_ids, truth), 1)

    # Adam on the mean log-likelihood with a small decay.
    values = [np.zeros((len(names), count)), np.zeros((count, count))]
    means, squares = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values]
    for turn in range(1, fit.rounds + 1):
        scores = np.add.reduceat(values[0][flat], starts, axis=0)
        scores -= scores.max(axis=1, keepdims=True)
        found, pairs = posteriors(np.exp(scores)[word_ids], lengths, np.exp(values[1]))
        expected = np.stack([np.bincount(word_ids, found[:, k], len(types)) for k in range(count)], axis=1)
        gap = np.repeat(seen - expected, per_type, axis=0)
        of_features = np.stack([np.bincount(flat, gap[:, k], len(names)) for k in range(count)], axis=1)
        for k, gradient in enumerate((of_features, seen_pairs - pairs)):
            gradient = gradient / len(truth) - fit.decay * values[k] / len(truth)
            means[k] = 0.9 * means[k] + 0.1 * gradient
            squares[k] = 0.99 * squares[k] + 0.01 * gradient**2
            step = (means[k] / (1 - 0.9**turn)) / (np.sqrt(squares[k] / (1 - 0.99**turn)) + 1e-8)
            values[k] = values[k] + fit.rate * step / np.sqrt(turn)
    return Field(labels, names, values[0].astype(np.float32), values[1])


def _switching(chains, stretch: int, rng) -> list:
    """The words of the chains in stretches of random length that alternate between chains."""
    mixed = []
    for first in range(0, len(chains), 4):
        some = [chains[k] for k in rng.permutation(np.arange(first, min(first + 4, len(chains))))]
        taken = [0] * len(some)
        words, labels = [], []
        while any(taken[k] < len(some[k][0]) for k in range(len(some))):
            k = int(rng.integers(len(some)))
            n = int(rng.geometric(1 / stretch))
            words += some[k][0][taken[k]:taken[k] + n]
            labels += some[k][1][taken[k]:taken[k] + n]
            taken[k] += n
        mixed.append((words, labels))
    return mixed


def training_sample(docs: DataFrame, fit: Fit) -> list[tuple[str, str]]:
    """The bounded sample of (text window, lang): rows by hash of doc_id, windows at a hashed place."""
    usable = docs.where("text is not null and lang is not null and doc_id is not null").select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", "lang"
    )
    sizes = {row["lang"]: row["count"] for row in usable.groupBy("lang").count().collect()}
    if not sizes:
        return []
    # Twice the wanted share, then cut to the wanted number in the order of the hash.
    share = F.element_at(F.create_map(*[
        F.lit(v) for lang, n in sorted(sizes.items()) for v in (lang, min(1.0, 2 * fit.documents / n))
    ]), F.col("lang"))
    place = F.pmod(F.xxhash64("doc_id", F.lit("window")), F.greatest(F.lit(1), F.length("text") - fit.window + 1))
    chosen = usable.where(hashed_share("doc_id", share)).select(
        "lang", "doc_id", F.xxhash64("doc_id").alias("turn"),
        F.substring("text", (place + 1).cast("int"), F.lit(fit.window)).alias("text"),
    )
    rows = sorted(chosen.collect(), key=lambda r: (r["lang"], r["turn"], r["doc_id"], r["text"]))
    taken: dict[str, int] = {}
    sample = []
    for row in rows:
        taken[row["lang"]] = taken.get(row["lang"], 0) + 1
        if taken[row["lang"]] <= fit.documents:
            sample.append((row["text"], row["lang"]))
    order = np.random.default_rng(fit.seed).permutation(len(sample))
    return [sample[k] for k in order]


def fit_languages(docs: DataFrame, fit: Fit = Fit()) -> Field | None:
    """The field of the bounded sample, fitted in one task: it takes memory that a driver may not have to spare."""
    sample = training_sample(docs, fit)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _ in batches:
            field = fit_field(sample, fit)
            if field is not None:
                parts = [field.labels, list(field.features), field.weights.tobytes(), field.transitions.tobytes()]
                yield pa.RecordBatch.from_arrays([pa.array([part]) for part in parts], names)
                del field, parts
        pa.default_memory_pool().release_unused()

    names = ["labels", "features", "weights", "transitions"]
    one = docs.sparkSession.range(0, 1, 1, 1)
    fitted = one.mapInArrow(run, "labels array<string>, features array<string>, weights binary, transitions binary").first()
    if fitted is None:
        return None
    count = len(fitted["labels"])
    weights, transitions = np.frombuffer(fitted["weights"], np.float32), np.frombuffer(fitted["transitions"])
    features = {name: k for k, name in enumerate(fitted["features"])}
    return Field(fitted["labels"], features, weights.reshape(-1, count), transitions.reshape(count, count))


def predict_languages(docs: DataFrame, field: Field | None) -> DataFrame:
    """Rows (doc_id, lang_pred, score), one per document; the text is the only input of a prediction."""
    columns = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    if field is None:
        return columns.select("doc_id", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def start():
        scorer = _Scorer(shared.value)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            labels, scores = scorer.predict(texts(batch))
            return pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(labels, pa.string()), pa.array(scores, pa.float64())],
                ["doc_id", "lang_pred", "score"],
            )
        return step

    return over_batches(columns, "doc_id long, lang_pred string, score double", start)


def with_languages(docs: DataFrame, field: Field | None) -> DataFrame:
    """All columns of ``docs``, row by row, then lang_pred and score as predicted, and certainty.

    ``certainty`` is the mean over the words of each word's own highest probability, whatever its
    label: a text in several languages can be certain where no label has a high mean. It is 0 for a
    text without letters, and NULL without a field where there are letters.
    """
    if field is None:
        none = F.when(~F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)), 0.0)
        return docs.withColumns({"lang_pred": F.lit(UNKNOWN), "score": F.lit(0.0), "certainty": none})
    shared = docs.sparkSession.sparkContext.broadcast(field)
    schema = StructType([*docs.schema.fields, StructField("lang_pred", StringType()), *(StructField(name, DoubleType()) for name in ("score", "certainty"))])

    def start():
        scorer = _Scorer(shared.value)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            labels, scores, certainties = scorer.judge(texts(batch))
            return pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(labels, pa.string()), pa.array(scores, pa.float64()), pa.array(certainties, pa.float64())],
                schema.names,
            )
        return step

    return over_batches(docs, schema, start)


class _Scorer:
    """Predictions of a task; emission weights are kept by word type."""

    def __init__(self, field: Field):
        self.field = field
        self.transitions = np.exp(field.transitions)
        # One row more for features that training never saw.
        self.weights = np.vstack([field.weights, np.zeros((1, len(field.labels)), np.float32)])
        self.forget()

    def forget(self) -> None:
        self.types: dict[str, int] = {}
        self.emissions = np.empty((0, len(self.field.labels)))

    def learn(self, words: list[str]) -> None:
        """Emission weights of new word types."""
        get, missing = self.field.features.get, len(self.weights) - 1
        rows = []
        for first in range(0, len(words), 20_000):
            listed = [[get(f, missing) for f in word_features(w)] for w in words[first:first + 20_000]]
            counts = np.array([len(f) for f in listed])
            scores = np.add.reduceat(self.weights[np.concatenate(listed)], np.cumsum(counts) - counts, axis=0).astype(float)
            rows.append(np.exp(scores - scores.max(axis=1, keepdims=True)))
        self.types.update(zip(words, range(len(self.types), len(self.types) + len(words)), strict=True))
        self.emissions = np.concatenate([self.emissions, *rows])

    def predict(self, batch: Iterable[str | None]) -> tuple[list[str], list[float]]:
        return self.judge(batch)[:2]

    def judge(self, batch: Iterable[str | None]) -> tuple[list[str], list[float], list[float]]:
        """Labels, scores and certainties."""
        labels, scores, certainties, pending, waiting = [], [], [], [], 0
        for text in batch:
            pending.append(words_of(text))
            waiting += len(pending[-1])
            if waiting >= TOGETHER:
                self._run(pending, labels, scores, certainties)
                pending, waiting = [], 0
        self._run(pending, labels, scores, certainties)
        return labels, scores, certainties

    def _run(self, documents: list[list[str]], labels: list[str], scores: list[float], certainties: list[float]) -> None:
        new = {word for words in documents for word in words if word not in self.types}
        if len(self.types) + len(new) > KEPT:
            self.forget()
            new = {word for words in documents for word in words}
        if new:
            self.learn(sorted(new))
        # Characters that are numerals, not letters, also make words; such words alone are no text.
        used = [k for k, words in enumerate(documents) if any(c.isalpha() for word in words for c in word)]
        best: dict[int, tuple[str, float, float]] = {}
        if used:
            lengths = np.array([len(documents[k]) for k in used])
            of_type = self.types.__getitem__
            at = np.fromiter((of_type(w) for k in used for w in documents[k]), np.int64, int(lengths.sum()))
            found, _ = posteriors(self.emissions[at], lengths, self.transitions)
            starts = np.cumsum(lengths) - lengths
            means = np.add.reduceat(found, starts, axis=0) / lengths[:, None]
            certain = np.add.reduceat(found.max(axis=1), starts) / lengths
            top = means.argmax(axis=1)
            for row, k in enumerate(used):
                best[k] = self.field.labels[top[row]], min(1.0, float(means[row, top[row]])), min(1.0, float(certain[row]))
        for k in range(len(documents)):
            label, score, certainty = best.get(k, (UNKNOWN, 0.0, 0.0))
            labels.append(label)
            scores.append(score)
            certainties.append(certainty)
