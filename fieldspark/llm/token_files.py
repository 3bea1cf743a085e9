"""Token-id files: one concatenated id array with Elias-Fano encoded document boundaries.

A file set is a Parquet folder with one row per segment, written and committed by Spark, so that
any store works and a lost executor only repeats its tasks. Segments follow ascending doc_id:

    shard, segment   place of the segment in the order
    shard_start      ids of the shard before the segment
    n_docs, n_ids    documents and ids of the segment
    doc_ids          the doc_id of each document
    ids              all ids one after another, little-endian, 2 bytes each if all are below 65,536, else 4
    id_bytes         that width
    low_bits         l, the number of low bits of a boundary
    low, high        the two parts of the Elias-Fano code

Of n boundaries up to u, each keeps l = floor(log2(u / n)) low bits as they are; its high part h
sets bit h + i of a bit vector of at most n + u / 2^l + 1 bits, i being its rank. That is about
2 + log2(u / n) bits a document where a table of offsets takes 64. ``Boundaries.select`` finds the
i-th boundary as the place of the i-th set bit: a directory with the number of set bits before
each 64-bit word leads to the word, in which the bit is counted out.

Defined cases: a NULL text counts as empty and has the end id only. Documents of one doc_id follow
each other by text; a NULL doc_id comes first. Texts are taken whole; a document never spans two
segments. An empty table gives an empty file set. Columns other than doc_id and text are not looked at.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from fieldspark.llm.common import kept_in_process, over_batches, texts

# A segment closes with the document that takes it over so many ids or documents.
SEGMENT_IDS, SEGMENT_DOCS = 1 << 20, 1 << 14
# Most words and pre-tokens whose ids a worker process keeps; a full table starts anew. Longer words are not kept.
KEPT, LONGEST_KEPT = 800_000, 64

SEGMENT_SCHEMA = (
    "shard int, segment int, shard_start long, n_docs long, n_ids long, doc_ids array<long>, "
    "ids binary, id_bytes int, low_bits int, low binary, high binary"
)


class Boundaries:
    """Elias-Fano code of a rising sequence of integers."""

    def __init__(self, n: int, low_bits: int, low: bytes, high: bytes):
        self.n, self.low_bits = n, low_bits
        self.low = np.frombuffer(low, np.uint8)
        self.words = np.frombuffer(high, "<u8")
        # Set bits before each word: the directory that select starts from.
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words).astype(np.int64))])

    @staticmethod
    def encode(values: np.ndarray) -> tuple[int, bytes, bytes]:
        """Low bit count, low bits and high bits of rising values."""
        n = len(values)
        top = int(values[-1]) if n else 0
        low_bits = max(0, (top // n).bit_length() - 1) if n else 0
        low = (values[:, None] >> np.arange(low_bits)) & 1
        high = np.zeros(-(-(n + (top >> low_bits) + 1) // 64) * 64, np.uint8)
        high[(values >> low_bits) + np.arange(n)] = 1
        pack = lambda bits: np.packbits(bits.astype(np.uint8).reshape(-1), bitorder="little").tobytes()
        return low_bits, pack(low), pack(high)

    def select(self, ranks: np.ndarray) -> np.ndarray:
        """The values of the given ranks."""
        ranks = np.asarray(ranks, np.int64)
        word = np.searchsorted(self.before, ranks, side="right") - 1
        bits = (self.words[word][:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)
        nth = ranks - self.before[word]
        place = (bits.cumsum(axis=1) <= nth[:, None].astype(np.uint64)).sum(axis=1)
        high = word * 64 + place - ranks
        at = ranks[:, None] * self.low_bits + np.arange(self.low_bits)
        low = (self.low[at >> 3] >> (at & 7)) & 1 if self.low_bits else np.zeros((len(ranks), 0), np.int64)
        return (high << self.low_bits) + (low.astype(np.int64) << np.arange(self.low_bits)).sum(axis=1)


class WordEncoder:
    """Ids of whole texts with a tokenizers file, the ids of repeated words and pre-tokens kept.

    The file's own steps are followed: NFC, lower case, split into pre-tokens, bytes as
    characters, merges. Pre-tokens hold no blank and are encoded apart from each other, so the ids of a
    text are those of its blank-separated words in a row, and those of a word the ids of its
    pre-tokens. A word with characters whose class or case could be read differently here, or with a
    special token's name, goes through the library. Up to U+024F nothing composes, so NFC changes nothing.
    """

    # Beyond these ranges, classes and cases are left to the library.
    _UNUSUAL = re.compile("[^\x00-ɏ]|[²³¹¼-¾İ]|<\\|")
    _PRE_TOKEN = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:_|[^\w\s])+")
    # Control characters that only Python reads as blanks.
    _SEPARATORS = "\x1c\x1d\x1e\x1f"

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.known = _Known(self._of_word)
        # Printable bytes stand for themselves, the others for characters from 256 on.
        shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
        hidden = iter(range(256, 512))
        self.byte_signs = {b: chr(b) if b in shown else chr(next(hidden)) for b in range(256)}

    def __call__(self, text: str) -> bytes:
        """The ids of a text as 32-bit integers."""
        if any(sign in text for sign in self._SEPARATORS):
            return self.by_library(text)
        # Lower case makes fewer words; beyond ASCII it is left to each word.
        words = (text.lower() if text.isascii() else text).split()
        return b"".join(map(self.known.__getitem__, words))

    def by_library(self, text: str) -> bytes:
        return array("I", self.library.encode(text, add_special_tokens=False).ids).tobytes()

    def _of_word(self, word: str) -> bytes:
        # Small letters alone are one pre-token, and most words.
        if word.isascii() and word.isalpha() and word.islower():
            return self._of_token(word)
        if self._UNUSUAL.search(word):
            return self.by_library(word)
        tokens = self._PRE_TOKEN.findall(word.lower())
        if tokens == [word]:
            return self._of_token(word)
        return b"".join([self.known.get(token) or self.known.keep(token, self._of_token(token)) for token in tokens])

    def _of_token(self, token: str) -> bytes:
        signs = token if token.isascii() and token.isprintable() else "".join([self.byte_signs[b] for b in token.encode()])
        return array("I", [piece.id for piece in self.library.model.tokenize(signs)]).tobytes()


class _Known(dict):
    """Ids of words, worked out when they are first asked for."""

    def __init__(self, ids_of: Callable[[str], bytes]):
        super().__init__()
        self.ids_of = ids_of

    def __missing__(self, word: str) -> bytes:
        return self.keep(word, self.ids_of(word))

    def keep(self, word: str, ids: bytes) -> bytes:
        if len(word) <= LONGEST_KEPT:
            if len(self) >= KEPT:
                self.clear()
            self[word] = ids
        return ids


def write_token_files(docs: DataFrame, tokenizer: str, end_id: int, path: str) -> None:
    """Encode every text, append ``end_id``, and write the ids in ascending doc_id order."""
    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
        .repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
        .select(F.spark_partition_id().alias("shard"), "doc_id", "text")
    )

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = kept_in_process(("words of", tokenizer), lambda: WordEncoder(tokenizer))
        end = np.array([end_id], "<u4").tobytes()
        doc_ids, parts, held, number, shard_start, shard = [], [], 0, 0, 0, 0

        def close() -> pa.RecordBatch:
            lengths = np.array([len(part) // 4 for part in parts], np.int64)
            ids = np.frombuffer(b"".join(parts), "<u4")
            id_bytes = 2 if ids.max() < 1 << 16 else 4
            low_bits, low, high = Boundaries.encode(np.cumsum(lengths))
            values = [
                shard, number, shard_start, len(parts), len(ids), doc_ids,
                ids.astype(f"<u{id_bytes}").tobytes(), id_bytes, low_bits, low, high,
            ]
            types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()),
                     pa.binary(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
            names = [column.split()[0] for column in SEGMENT_SCHEMA.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types, strict=True)], names)

        for batch in batches:
            if batch.num_rows:
                shard = batch.column("shard")[0].as_py()
                first = batch.column("text")[0].as_py()
                if encode(first) != encode.by_library(first):
                    raise ValueError("the tokenizers library encodes a text of this batch differently")
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts(batch), strict=True):
                doc_ids.append(doc_id)
                parts.append(encode(text) + end)
                held += len(parts[-1]) // 4
                if held >= SEGMENT_IDS or len(parts) >= SEGMENT_DOCS:
                    yield close()
                    shard_start, number = shard_start + held, number + 1
                    doc_ids, parts, held = [], [], 0
        if parts:
            yield close()

    ordered.mapInArrow(segments, SEGMENT_SCHEMA).write.parquet(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Rows (doc_id, start, ids): the documents of a file set with their place in the whole id array."""
    segments = spark.read.schema(SEGMENT_SCHEMA).parquet(path)
    # One row per shard, that is per partition of the writing job: a window without keys is small.
    shards = segments.groupBy("shard").agg(F.sum("n_ids").alias("in_shard")).select(
        "shard", (F.sum("in_shard").over(W.orderBy("shard")) - F.col("in_shard")).alias("before")
    )
    placed = segments.join(F.broadcast(shards), "shard").withColumn("start", F.col("before") + F.col("shard_start"))

    def start():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            doc_ids, starts, ids = [], [], []
            for row in batch.to_pylist():
                array = np.frombuffer(row["ids"], f"<u{row['id_bytes']}")
                code = Boundaries(row["n_docs"], row["low_bits"], row["low"], row["high"])
                ends = code.select(np.arange(row["n_docs"]))
                begins = np.concatenate([[0], ends[:-1]])
                doc_ids += row["doc_ids"]
                starts.append(row["start"] + begins)
                ids += [array[i:j].astype("<u4").tobytes() for i, j in zip(begins.tolist(), ends.tolist(), strict=True)]
            return pa.RecordBatch.from_arrays(
                [pa.array(doc_ids, pa.int64()), pa.array(np.concatenate(starts)), pa.array(ids, pa.binary())],
                ["doc_id", "start", "ids"],
            )
        return step

    return over_batches(placed, "doc_id long, start long, ids binary", start, rows=4)


def id_digests(read: DataFrame) -> DataFrame:
    """Rows (doc_id, start, n_tokens, ids_crc32) of documents read back."""
    return read.select(
        "doc_id", "start", F.expr("octet_length(ids) div 4").alias("n_tokens"), F.crc32("ids").alias("ids_crc32")
    )
