import os
import random
import re
import unicodedata
import zlib
from collections import Counter
from hashlib import sha256

import helpers
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from fieldspark.llm import common, language, pii, quality, queries, sentencepiece_codec, token_counts, token_files, toxicity

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def docs(spark):
    return helpers.awkward(spark)


@pytest.fixture(scope="module")
def rows():
    return helpers.awkward_rows()


def mixed_texts(seed, count):
    rng = random.Random(seed)
    parts = [" ", "  ", "▁", "\n", "\t", "a", "the", "ing", "é", "É", "%%%", "!!", "中", "🙂", "́", "\x00", "　", "1", "23", "ﬁ",
             "Σ", "İ", "²", "_", "'s", "'ll", "\x1c", "\x85", "<|endoftext|>", "</s>", "<0x0A>", "----", "\r\n"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(count)]


# SentencePiece

def test_codec_equals_the_library_on_awkward_strings():
    codec, library = sentencepiece_codec.MergeCodec(PIECES), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    texts = mixed_texts(1, 2_000) + ["x" * 3_000, "#" * 500, "ab" * 400]
    codec.learn(texts)
    for text in texts:
        theirs = library.encode(text, add_eos=True)
        assert codec.encode(text).tolist() == theirs
        assert codec.decode(codec.encode(text)) == library.decode(theirs)


def test_both_forms_of_the_agenda_agree():
    codec = sentencepiece_codec.MergeCodec(PIECES)
    parts = ["▁" + "".join(random.Random(k).choices("abcdetionsh", k=k % 20 + 1)) for k in range(300)]
    assert codec.merge_short(parts) == [codec.merge_long(part) for part in parts]


def test_pieces_cut_each_text_once_and_keep_frequent_parts(monkeypatch):
    monkeypatch.setattr(sentencepiece_codec, "KEPT_PARTS", 40)
    monkeypatch.setattr(sentencepiece_codec, "CUT_CHARS", 300)
    codec, library = sentencepiece_codec.MergeCodec(PIECES), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    cut, learned, cuts = codec.cut, [], []
    encode_parts = codec._encode_parts
    monkeypatch.setattr(codec, "cut", lambda text: cuts.append(text) or cut(text))
    monkeypatch.setattr(codec, "_encode_parts", lambda parts: learned.extend(parts) or encode_parts(parts))
    texts = [f"the same words and new ones: {'xyzab'[k % 5]}{k} w{k * 7919}" for k in range(60)] + ["", "long " * 200]
    assert [ids.tolist() for ids in codec.encode_all(texts)] == library.encode(texts, add_eos=True)
    assert cuts == texts
    # A full table does not lose the parts that go on coming.
    assert learned.count("▁same") == learned.count("▁words") == 1 and len(codec.parts) < 150


def test_codec_query_columns(spark, docs, rows):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    found = queries.codec_digests(sentencepiece_codec.encode_decode(docs, PIECES)).collect()
    expected = []
    for doc_id, text, *_ in rows:
        ids = library.encode(text or "", add_eos=True)
        digests = [sha256(x.encode()).hexdigest() for x in (" ".join(map(str, ids)), library.decode(ids))]
        expected.append((doc_id, len(ids), *digests))
    assert Counter(map(tuple, found)) == Counter(expected)
    assert sentencepiece_codec.encode_decode(helpers.empty(spark), PIECES).count() == 0


# Token files

def test_word_encoder_equals_the_library():
    encode, library = token_files.WordEncoder(WORDS), Tokenizer.from_file(WORDS)
    for text in mixed_texts(2, 2_000) + ["DON'T stop", "x" * 2_000]:
        assert np.frombuffer(encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_word_encoder_by_words_equals_the_library(monkeypatch):
    """Words with signs the library must read stand alone; a table that starts anew changes nothing."""
    monkeypatch.setattr(token_files, "KEPT", 50)
    encode, library = token_files.WordEncoder(WORDS), Tokenizer.from_file(WORDS)
    pieces = [
        "plain", "It's", "naïve", "Straße", "İstanbul", "ΣΑΣ", "日本語", "don\u2019t", "½", "e\u0301", "\u0301", "<|endoftext|>", "<|", "x<|startoftext|>y",
        "A" * 70 + "é", "...", "a_b", "٣", "ǅ", "\u2003wide", "\x85", "\xa0", "\x1c", "'S", "\u00ad", "ﬁ", "\ufeff", "\x00", "\x7f.", "\x9f",
    ]
    rng = np.random.default_rng(8)
    for _ in range(3_000):
        words = [pieces[k] for k in rng.integers(0, len(pieces), 6)]
        text = "".join(word + str(rng.choice(np.array([" ", "  ", "\n", "\t", "", "\x0b", "\u3000"], object))) for word in words)
        assert np.frombuffer(encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_nothing_composes_in_the_range_read_here():
    signs = [chr(c) for c in range(0x250)]
    assert all(unicodedata.is_normalized("NFC", a + b) for a in signs for b in signs)


@pytest.mark.parametrize("values", [[7], [0, 0, 0], [1, 3, 3, 900, 100_000], list(range(0, 5_000, 3))])
def test_boundaries_round_trip(values):
    values = np.array(values, np.int64)
    low_bits, low, high = token_files.Boundaries.encode(values)
    code = token_files.Boundaries(len(values), low_bits, low, high)
    assert code.select(np.arange(len(values))).tolist() == values.tolist()
    assert code.select(np.array([len(values) - 1])).tolist() == [values[-1]]


def test_token_files_round_trip(spark, docs, rows, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "SEGMENT_DOCS", 3)
    library = Tokenizer.from_file(WORDS)
    path = str(tmp_path / "ids")
    token_files.write_token_files(docs, WORDS, 1, path)
    found = token_files.id_digests(token_files.read_token_files(spark, path)).collect()
    start, expected = 0, []
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    for doc_id, text, *_ in ordered:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        expected.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, found), key=lambda r: r[1]) == expected
    assert spark.read.parquet(path).where("n_docs <= 3").count() == spark.read.parquet(path).count()


def test_no_documents_give_an_empty_file_set(spark, tmp_path):
    path = str(tmp_path / "none")
    token_files.write_token_files(helpers.empty(spark), WORDS, 1, path)
    assert token_files.read_token_files(spark, path).count() == 0


# Token counts

def brute_token_count(scores, token):
    best = [(0.0, 0)]
    for end in range(1, len(token) + 1):
        best.append(max((best[k][0] + scores[token[k:end]], best[k][1] - 1) for k in range(end) if token[k:end] in scores))
    return -best[-1][1]


def test_token_counts_equal_plain_segmentation(spark, docs, rows):
    scores = token_counts.zipf_scores(RANKS)
    split = token_counts.Counter(RANKS, public_tokenizers.PATTERN).split
    found = token_counts.token_counts(docs, RANKS, public_tokenizers.PATTERN).collect()
    expected = []
    for doc_id, text, *_ in rows:
        parts = split(text or "")
        known = {part: brute_token_count(scores, part.encode()) for part in set(parts)}
        expected.append((doc_id, len(parts), sum(known[part] for part in parts)))
    assert Counter(map(tuple, found)) == Counter(expected)
    assert token_counts.token_counts(helpers.empty(spark), RANKS, public_tokenizers.PATTERN).count() == 0


def test_a_small_trie_is_dropped_without_harm(monkeypatch):
    whole = token_counts.Counter(RANKS, public_tokenizers.PATTERN)
    expected = whole.counts([helpers.SENTENCE, "abc " * 50])
    monkeypatch.setattr(token_counts, "NODES", 12)
    assert token_counts.Counter(RANKS, public_tokenizers.PATTERN).counts([helpers.SENTENCE, "abc " * 50]) == expected


# Quality

def brute_counts(text):
    words = helpers.WORD.findall(text or "")
    lines = [line for line in (text or "").split("\n") if helpers.WORD.search(line)]
    windows = [tuple(words[k:k + 8]) for k in range(len(words) - 7)]
    seen = Counter(windows)
    covered = {k + j for k, window in enumerate(windows) if seen[window] > 1 for j in range(8)}
    return (len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered))


def test_quality_counts_and_base_rules(spark, docs, rows):
    extra = [(100, "x y\nx y\n" + " ".join("abcdefghij") * 1 + " " + " ".join("abcdefghij"), None, None, 0)]
    table = docs.select("doc_id", "text", "score").union(spark.createDataFrame([(r[0], r[1], "c") for r in extra]))
    found = quality.judge(table, None).collect()
    expected = []
    for doc_id, text, *_ in rows + extra:
        counts = brute_counts(text)
        failed = counts[0] < 20 or 100 * counts[4] > 30 * counts[0]
        expected.append((doc_id, *counts, failed, not failed))
    assert Counter(tuple(row)[:8] for row in found) == Counter(expected)


def test_trees_learn_and_keep_their_order():
    rng = np.random.default_rng(5)
    rows = rng.random((3_000, 3))
    good = (rows[:, 0] < 0.6).astype(float)
    trees = quality.fit_trees(rows[:2_000], good[:2_000], quality.Fit(trees=20), [0])
    assert ((trees.score(rows[2_000:]) > 0.5) == (good[2_000:] > 0)).mean() > 0.97
    # The flat arrays against a walk node by node.
    for row, score in zip(rows[:50], trees.score(rows[:50]), strict=True):
        total = trees.base
        for node in trees.roots:
            while trees.left[node] != node:
                node = trees.left[node] + int(row[trees.feature[node]] > trees.threshold[node])
            total += trees.value[node]
        assert score == pytest.approx(1 / (1 + np.exp(-total)))
    noisy = quality.fit_trees(rows, rng.random(3_000).round(), quality.Fit(trees=20, smallest_leaf=2), [0, 2])
    grid = np.repeat(rows[:40], 30, axis=0)
    for feature in (0, 2):
        varied = grid.copy()
        varied[:, feature] = np.tile(np.linspace(0, 1, 30), 40)
        assert (np.diff(noisy.score(varied).reshape(40, 30), axis=1) <= 1e-12).all()


def test_quality_query_on_held_out_labels(spark, sf_dir):
    docs, labels = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    trees = quality.fit_quality(docs, labels.where("doc_id % 2 = 0"), quality.Fit(smallest_leaf=3))
    judged = quality.judge(docs, trees).join(labels.where("doc_id % 2 = 1 and quality = 1"), "doc_id").where("not base_failed")
    assert judged.where("kept").count() >= 0.9 * judged.count()
    assert quality.fit_quality(helpers.empty(spark), labels) is None
    assert quality.fit_quality(docs, labels.where("quality = 1")) is None


# Language

def test_chain_probabilities_equal_plain_forward_backward():
    rng = np.random.default_rng(0)
    lengths = np.array([1, 5, 130, 64, 65, 3])
    emissions, moves = rng.random((lengths.sum(), 3)) + 0.01, rng.random((3, 3)) + 0.05
    found, pairs = language.posteriors(emissions, lengths, moves)
    first, total = 0, np.zeros((3, 3))
    for n in lengths:
        e, forward, backward, state = emissions[first:first + n], np.zeros((n, 3)), np.ones((n, 3)), np.full(3, 1 / 3)
        for t in range(n):
            state = (state @ moves) * e[t]
            forward[t] = state = state / state.sum()
        for t in range(n - 2, -1, -1):
            backward[t] = moves @ (e[t + 1] * backward[t + 1])
            backward[t] /= backward[t].sum()
        joint = forward * backward
        assert np.allclose(joint / joint.sum(axis=1, keepdims=True), found[first:first + n])
        for t in range(1, n):
            step = forward[t - 1][:, None] * moves * (e[t] * backward[t])
            total += step / step.sum()
        first += n
    assert np.allclose(total, pairs)


def test_language_of_held_out_documents(spark, sf_dir):
    found = queries.op7_language_id(spark, sf_dir).join(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang"), "doc_id")
    rows = found.where("held_out").collect()
    assert all(helpers.crc_bucket(r.doc_id) == 2 for r in rows)
    assert sum(r.lang_pred == r.lang for r in rows) >= 0.95 * len(rows)
    assert all(0 <= r.score <= 1 for r in found.collect())


def test_switched_text_keeps_its_stretches():
    samples = [("el perro come la carne y el gato duerme en casa", "es"), ("the dog eats the meat and the cat sleeps at home", "en")] * 20
    scorer = language._Scorer(language.fit_field(samples, language.Fit()))
    words = "the dog sleeps at home el gato come la carne".split()
    scorer.learn(sorted(set(words)))
    at = np.array([scorer.types[w] for w in words])
    found, _ = language.posteriors(scorer.emissions[at], np.array([len(words)]), scorer.transitions)
    assert [scorer.field.labels[k] for k in found.argmax(axis=1)] == ["en"] * 5 + ["es"] * 5


def test_language_of_awkward_documents(spark, docs, rows):
    field = language.fit_field([("the quick fox", "en"), ("le chien noir", "fr")] * 5, language.Fit(rounds=5))
    found = language.predict_languages(docs, field).collect()
    assert len(found) == len(rows)
    letters = {r[0]: any(c.isalpha() for c in r[1] or "") for r in rows if r[0] is not None}
    for row in found:
        if row.doc_id is not None:
            assert (row.lang_pred != "und") == letters[row.doc_id] and (row.score == 0) == (row.lang_pred == "und")
    assert language.fit_languages(helpers.empty(spark)) is None
    assert {r.lang_pred for r in language.predict_languages(docs, None).collect()} == {"und"}


# Toxicity

def test_toxicity_of_held_out_documents(spark, sf_dir):
    docs, labels = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    found = toxicity.severity(docs, toxicity.fit_toxicity(docs, labels)).join(labels, "doc_id")
    clean = found.where("toxic_label = 0") if "toxic_label" in found.columns else found.where(labels["toxic"] == 0)
    assert clean.where("grade > 0").count() <= 0.02 * clean.count()


def test_ordinal_scale_recovers_ordered_grades():
    rng = random.Random(3)
    samples = []
    for k in range(900):
        grade = k % 3
        words = {f"plain{rng.randint(0, 60)}" for _ in range(12)} | {f"nasty{rng.randint(0, 5)}" for _ in range(3 * grade)}
        samples.append((words, grade))
    scale = toxicity.fit_scale(samples[:600], toxicity.Fit(fewest=2))
    assert scale.thresholds == sorted(scale.thresholds)
    grades = [sum(scale.score(words) > t for t in scale.thresholds) for words, _ in samples[600:]]
    assert np.mean([g == true for g, (_, true) in zip(grades, samples[600:], strict=True)]) > 0.85
    assert toxicity.fit_scale([({"a"}, 1)] * 5) is None and toxicity.fit_scale([]) is None


def test_severity_of_awkward_documents(spark, docs, rows):
    scale = toxicity.Scale({"fox": 3.0}, [1.0, 5.0])
    found = toxicity.severity(docs, scale).collect()
    assert len(found) == len(rows)
    plain = [1 / (1 + np.exp(-(s - t))) for s, t in ((3.0, 1.0), (3.0, 5.0))]
    assert {(r.severity == pytest.approx(sum(plain)), r.grade) for r in found if r.doc_id == 6} == {(True, 1)}
    assert all(r.severity == 0 and not r.toxic for r in toxicity.severity(docs, None).collect())


# Personal data

def luhn(digits):
    return sum(sum(divmod(2 * int(d), 10)) if k % 2 else int(d) for k, d in enumerate(reversed(digits))) % 10 == 0


def replaced(spark, texts, key="k"):
    frame = spark.createDataFrame([(k, text) for k, text in enumerate(texts)], "doc_id long, text string")
    return [row.text for row in pii.pseudonymise(frame, key).orderBy("doc_id").collect()]


def test_pseudonyms_keep_formats_and_links(spark):
    cards = ["4952935900253052", "4952 9359 0025 3052", "4952-9359-0025-3052"]
    found = replaced(spark, cards)
    assert len({re.sub("[ -]", "", card) for card in found}) == 1 and luhn(found[0]) and found[0] != cards[0]
    shapes = {
        "34@mail7.example.com": r"\d\d@[a-z]{4}\d\.[a-z]{7}\.com", "+1 (132) 555-1352": r"\+1 \(\d{3}\) \d{3}-\d{4}", "126.40.69.100": r"(\d{1,3}\.){3}\d{1,3}",
        "1984-02-29": r"\d{4}-\d\d-\d\d", "29.02.1984": r"\d\d\.\d\d\.\d{4}", "123-45-6789": r"\d{3}-\d\d-\d{4}",
        "7702344ead31d5951ffa625c69a7546f3a470a7f": r"[0-9a-f]{40}",
    }
    for text, new in zip(shapes, replaced(spark, list(shapes)), strict=True):
        assert re.fullmatch(shapes[text], new) and new != text
    assert replaced(spark, ["1984-02-29"])[0] == "-".join(reversed(replaced(spark, ["29.02.1984"])[0].split(".")))
    assert replaced(spark, cards, "other") != found


def test_invalid_values_and_clean_texts_stay(spark):
    texts = ["4952935900253053", "300.1.1.1", "1.2.3.4.5", "2021-02-30", "666-12-1234", "1500-01-01", "plain text, 12 of 34", None, "", "a" * 200_000]
    assert replaced(spark, texts) == texts


def test_permutations_are_one_to_one(spark):
    days = [str(d)[:10] for d in np.arange("1930-01-01", "2030-01-01", dtype="datetime64[D]")]
    assert len(days) == 36_525
    assert sorted(replaced(spark, days)) == days
    lines = [f"mail q{k:02d}@ab.de" for k in range(100)]
    assert len(set(replaced(spark, lines))) == 100


def test_personal_data_of_awkward_documents(spark, docs, rows):
    found = pii.pseudonymise(docs, "k")
    assert found.columns == [*docs.columns, "n_replaced_"]
    by_id = {r.doc_id: r for r in found.where("doc_id is not null").collect()}
    for doc_id, text, *_ in rows:
        if doc_id is not None and doc_id != 17:
            assert by_id[doc_id].text == text and by_id[doc_id]["n_replaced_"] == 0
    assert by_id[17]["n_replaced_"] == 3 and found.count() == len(rows)
    assert pii.pseudonymise(helpers.empty(spark), "k").count() == 0


def test_no_planted_value_is_left(spark, sf_dir):
    kinds = [r"\S+@\S+\.com", r"\+1 \(\d{3}\) \d{3}-\d{4}", r"\d+\.\d+\.\d+\.\d+", r"[0-9a-f]{40}", r"(?<!\d)\d{16}(?!\d)"]
    before = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for row in queries.op10_pii_pseudonyms(spark, sf_dir).collect():
        values = {v for kind in kinds for v in re.findall(kind, before[row.doc_id] or "") if not v.isdigit() or luhn(v)}
        assert not [v for v in values if v in row.text]
        assert values or row.text == before[row.doc_id]


def test_secrets_of_both_cases_are_replaced_and_linked(spark):
    token = "9233A8ECF7C5B09FE5949719B6B82BC439E9329B"
    upper, lower = replaced(spark, [f'TOKEN = "{token}"', f'TOKEN = "{token.lower()}"'])
    assert re.fullmatch('TOKEN = "[0-9A-F]{40}"', upper) and token not in upper
    assert lower[9:-1] == upper[9:-1].lower()


def test_no_planted_secret_of_either_case_is_left(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("text rlike '[0-9a-f]{40}|[0-9A-F]{40}'").select("doc_id", "text")
    before = {r.doc_id: r.text for r in docs.collect()}
    assert {2514, 8743} <= before.keys()
    for row in pii.pseudonymise(docs, "k").collect():
        values = re.findall(r"\b(?:[0-9a-f]{32,64}|[0-9A-F]{32,64})\b", before[row.doc_id])
        assert not [v for v in values if re.search("[0-9]", v) and v in row.text]


def test_phones_in_all_groupings_are_replaced_whole_and_linked(spark):
    same = [
        ["+91 98765 43210", "+919876543210", "+91-98765-43210"], ["+33 6 12 34 56 78", "+33612345678", "+33 (0)6 12 34 56 78", "+33.6.12.34.56.78"],
        ["+33 1 23 45 67 89", "+33123456789"], ["+49 (0)30 1234567", "+49 30 1234567", "+49301234567", "+49 (30) 123-4567"],
        ["+1 (132) 555-1352", "+11325551352", "+1 132 555 1352"], ["+353 1 234 5678", "+35312345678"], ["+49 170 1234567", "+49 170 12 34 567"],
    ]
    given = [value for values in same for value in values]
    found = dict(zip(given, replaced(spark, given), strict=True))
    for values in same:
        for value in values:
            assert re.sub("[0-9]", "9", found[value]) == re.sub("[0-9]", "9", value)
            assert value.replace("(0)", "")[-7:] != found[value].replace("(0)", "")[-7:]
        assert len({re.sub("[^0-9]", "", found[value].replace("(0)", "")) for value in values}) == 1
    # Values beside a phone number are found as without it.
    others = ["31/12/1984", "1984-12-31", "4952 9359 0025 3052", "123-45-6789", "126.40.69.100", "34@mail7.example.com", "(132) 555-1352"]
    for phone in ("+49 30 1234567", "+33 6 12 34 56 78", "+1 (132) 555-1352"):
        own = replaced(spark, [phone, *others])
        assert replaced(spark, [f"{phone} {other}" for other in others]) == [f"{own[0]} {other}" for other in own[1:]]
    assert replaced(spark, ["+1 (132) 555-1352 2020"])[0].endswith(" 2020")


def test_day_first_dates_with_slashes_move_like_others(spark):
    day_first, iso, month_first, dotted = replaced(spark, ["31/12/1984", "1984-12-31", "12/31/1984", "31.12.1984"])
    assert day_first != "31/12/1984" and day_first.replace("/", ".") == dotted
    year, month, day = iso.split("-")
    assert day_first == f"{day}/{month}/{year}" and month_first == f"{month}/{day}/{year}"
    assert replaced(spark, ["31/02/1984", "32/12/1984"]) == ["31/02/1984", "32/12/1984"]


def test_a_worker_process_drops_what_other_operators_kept():
    class Rows:
        def mapInArrow(self, run, schema):
            return lambda: list(run(iter([])))

    made = []

    def keeping():
        common.kept_in_process(("test", 1), lambda: made.append(1) or object())
        return lambda batch: batch

    first, other = common.over_batches(Rows(), "a long", keeping), common.over_batches(Rows(), "a long", lambda: lambda batch: batch)
    first()
    first()
    assert made == [1]
    other()
    assert not common._keeper().kept
    first()
    assert made == [1, 1]


def test_languages_are_fitted_in_a_task(spark, sf_dir, monkeypatch):
    docs, fit = common.documents(spark, sf_dir), language.Fit(rounds=2, documents=5)
    expected, found = language.fit_field(language.training_sample(docs, fit), fit), language.fit_languages(docs, fit)
    assert (found.labels, found.features) == (expected.labels, expected.features)
    np.testing.assert_array_equal(found.weights, expected.weights)
    np.testing.assert_array_equal(found.transitions, expected.transitions)
    assert language.fit_languages(docs.limit(0), fit) is None
    # The driver's memory is left alone.
    monkeypatch.setattr(language, "fit_field", lambda *_: language.Field([str(os.getpid())], {}, np.zeros((0, 1), np.float32), np.zeros((1, 1))))
    assert language.fit_languages(docs, fit).labels != [str(os.getpid())]
