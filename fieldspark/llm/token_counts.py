"""Token counts under a unigram vocabulary, by dynamic programming over a trie of pre-tokens.

A text is split into pre-tokens, and each pre-token into the pieces with the largest sum of scores;
of equal sums the one with fewer pieces counts. The forward score of a prefix, the best sum over
its segmentations, is the same for all pre-tokens that begin with it. So the distinct new pre-tokens
of a batch are put into a trie of bytes, every node's forward score is computed once, from the nodes
above it, and a pre-token's count is read at its terminal node.

The scores of a rank file follow Zipf's law: piece r scores -log(r + 1), the rank standing for the
frequency; tokenizers are not trained here. All single bytes are pieces, so every text can be split.

Defined cases: a NULL or empty text has counts 0. A NULL doc_id is passed on, repeated rows each give
a row, an empty table none. Texts and pre-tokens are taken whole, however long. Columns other than
doc_id and text are not looked at.
"""

from __future__ import annotations

import base64
import math
from collections.abc import Iterable

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldspark.llm.common import over_batches, texts

# Most pre-tokens whose counts a task keeps, and nodes after which a trie is dropped.
KEPT, NODES = 400_000, 300_000


def zipf_scores(rank_file: str) -> dict[bytes, float]:
    """Piece scores from a file of base64 pieces and ranks."""
    scores = {}
    with open(rank_file, "rb") as lines:
        for line in lines:
            if line.strip():
                piece, rank = line.split()
                scores[base64.b64decode(piece)] = -math.log(int(rank) + 1)
    missing = [b for b in range(256) if bytes([b]) not in scores]
    if missing:
        raise ValueError(f"the vocabulary has no piece for the bytes {missing}")
    return scores


class PrefixTrie:
    """Forward scores (best sum, fewest pieces) of the prefixes of pre-tokens, one node each."""

    def __init__(self, scores: dict[bytes, float]):
        self.scores = scores
        self.longest = max(map(len, scores))
        self.clear()

    def clear(self) -> None:
        self.child: dict[int, int] = {}
        self.best: list[tuple[float, int]] = [(0.0, 0)]

    def count(self, token: bytes) -> int:
        """Insert a pre-token; the number of pieces of its best segmentation."""
        node, path, child = 0, [0], self.child
        for depth, byte in enumerate(token, 1):
            edge = node << 8 | byte
            following = child.get(edge)
            if following is None:
                following = child[edge] = len(self.best)
                self.best.append(self._forward(token, depth, path))
            path.append(following)
            node = following
        return -self.best[node][1]

    def _forward(self, token: bytes, depth: int, path: list[int]) -> tuple[float, int]:
        """Best (sum, minus pieces) of a prefix from those of its own prefixes."""
        scores, best, found = self.scores, self.best, (-math.inf, 0)
        for size in range(1, min(depth, self.longest) + 1):
            score = scores.get(token[depth - size:depth])
            if score is not None:
                total, pieces = best[path[depth - size]]
                found = max(found, (total + score, pieces - 1))
        return found


class Counter:
    """Token counts of a task; terminal counts are kept by pre-token."""

    def __init__(self, rank_file: str, pattern: str):
        self.trie = PrefixTrie(zipf_scores(rank_file))
        self.split = regex.compile(pattern).findall
        self.known: dict[str, int] = {}

    def learn(self, tokens: Iterable[str]) -> None:
        # Sorted, neighbours share prefixes also when the trie is dropped in between.
        for token in sorted(tokens):
            raw = token.encode()
            if len(self.trie.best) + len(raw) > NODES:
                self.trie.clear()
            self.known[token] = self.trie.count(raw)
        self.trie.clear()

    def counts(self, batch: list[str]) -> tuple[list[int], list[int]]:
        """Pre-tokens and tokens of each text."""
        found: set[str] = set()
        for text in batch:
            found.update(self.split(text))
        if len(self.known) + len(found) > KEPT:
            self.known = {}
        self.learn(token for token in found if token not in self.known)
        pre_tokens, tokens = [], []
        for text in batch:
            parts = self.split(text)
            pre_tokens.append(len(parts))
            tokens.append(sum(map(self.known.__getitem__, parts)))
        return pre_tokens, tokens


def token_counts(docs: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """Rows (doc_id, n_pre_tokens, n_tokens), one per document."""
    def start():
        counter = Counter(rank_file, pattern)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            pre_tokens, tokens = counter.counts([text or "" for text in texts(batch)])
            return pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(pre_tokens, pa.int64()), pa.array(tokens, pa.int64())],
                ["doc_id", "n_pre_tokens", "n_tokens"],
            )
        return step

    columns = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return over_batches(columns, "doc_id long, n_pre_tokens long, n_tokens long", start)
