"""Small tables with the awkward cases, and brute-force forms of shared steps."""

import re
import zlib

from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

SENTENCE = "the quick brown fox jumps over the lazy dog and then it sleeps near the old river bank today"


def awkward_rows():
    long_text = " ".join(f"word{k % 997}x{k % 31}" for k in range(60_000))
    texts = [
        None, "", " \t\n ", "one", "one", "THE Quick brown", SENTENCE, SENTENCE, SENTENCE.upper(), SENTENCE + " extra",
        long_text, long_text + " end", "a\n\na\nb\n a", "7 % $ & ## !!", "١٢٣ ½ ²", "日本語のテキスト と ▁ mark", "\x00 \x1c zero",
        "mail bob.smith@example.org or +1 (132) 555-1352, 4952935900253052", "<|endoftext|> and </s> <unk>", "ß İ Σας ﬁ é é",
    ]
    rows = [(k, text, "en" if k % 3 else None, f"s{k % 4}" if k % 5 else None, len(text or "")) for k, text in enumerate(texts)]
    rows.append((None, SENTENCE, "en", "s0", 3))
    rows += [rows[6], rows[6]]
    return rows


def awkward(spark):
    """The awkward documents, with extra columns named like results."""
    docs = spark.createDataFrame(awkward_rows(), SCHEMA)
    for name in ("size", "score", "kept", "component_id", "ids", "label", "found", "n_replaced", "key", "n", "weight"):
        docs = docs.withColumn(name, F.lit("clash"))
    return docs


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def crc_bucket(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 4


def shingles(text, width):
    words = [w.lower() if w.isascii() else "".join(c.lower() if "A" <= c <= "Z" else c for c in w) for w in WORD.findall(text or "")]
    if not words:
        return frozenset()
    return frozenset(zip(*[words[k:] for k in range(width)], strict=False)) if len(words) >= width else frozenset([tuple(words)])


def brute_components(sets, percent=80):
    """Smallest linked id of every id, from all pairs."""
    parent = {k: k for k in sets}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    ids = sorted(sets)
    for place, a in enumerate(ids):
        for b in ids[:place]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {k: root(k) for k in sets}
