from collections import Counter
from hashlib import sha256

import helpers
import public_tokenizers
import sentencepiece

import corpus_pipeline
from fieldspark.llm import mixing


def rows_of(frame):
    return {r.doc_id: r for r in frame.collect()}


def test_every_stage_on_what_the_last_one_kept(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert [stage for _, stage in corpus_pipeline.STAGES] == [
        corpus_pipeline.identify_language, corpus_pipeline.drop_near_duplicates, corpus_pipeline.pseudonymise_pii,
        corpus_pipeline.mix_sources, corpus_pipeline.encode_pieces,
    ]
    given = docs
    for name, stage in corpus_pipeline.STAGES:
        before = given.collect()
        given = corpus_pipeline.stored(stage(spark, given, sf_dir), "test-stage")
        after = given.collect()
        if stage is corpus_pipeline.identify_language:
            assert Counter(after) == Counter(r for r in before if any(c.isalpha() for c in r.text))
        elif stage is corpus_pipeline.drop_near_duplicates:
            labels = helpers.brute_components({r.doc_id: helpers.shingles(r.text, 5) for r in before})
            assert Counter(after) == Counter(r for r in before if labels[r.doc_id] == r.doc_id)
        elif stage is corpus_pipeline.pseudonymise_pii:
            assert Counter(r.doc_id for r in after) == Counter(r.doc_id for r in before)
            assert all(r.n_chars == len(r.text) for r in after)
        elif stage is corpus_pipeline.mix_sources:
            source = spark.createDataFrame(before)
            weights = mixing.label_weights(spark.read.parquet(f"{sf_dir}/labels.parquet"))
            copies = {r.doc_id: r.copies for r in mixing.mix(source, weights).collect()}
            assert Counter(after) == Counter({r: copies[r.doc_id] for r in before if copies[r.doc_id]})
        else:
            library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
            ids = {r.doc_id: library.encode(r.text, add_eos=True) for r in before}
            expected = Counter((r.doc_id, len(ids[r.doc_id]), sha256(" ".join(map(str, ids[r.doc_id])).encode()).hexdigest()) for r in before)
            assert Counter((r.doc_id, r.n_tokens, r.ids_sha256) for r in after) == expected
        if stage is not corpus_pipeline.encode_pieces:
            assert given.columns == docs.columns


def test_awkward_and_empty_tables(spark, sf_dir):
    for docs in (helpers.awkward(spark), helpers.empty(spark)):
        for _, stage in corpus_pipeline.STAGES:
            before = docs.collect()
            docs = corpus_pipeline.stored(stage(spark, docs, sf_dir), "test-stage")
            after = docs.collect()
            assert bool(before) == bool(after)
            if stage is corpus_pipeline.identify_language:
                assert Counter(r.text for r in after) <= Counter(r.text for r in before if r.text and any(c.isalpha() for c in r.text))
                assert docs.columns == corpus_pipeline.COLUMNS
            elif stage is corpus_pipeline.drop_near_duplicates:
                # Equal rows leave one; a row without doc_id stays.
                assert sum(r.doc_id is None for r in after) == sum(r.doc_id is None for r in before)
                assert max(Counter(r.doc_id for r in after if r.doc_id is not None).values(), default=1) == 1
            elif stage is corpus_pipeline.mix_sources:
                assert set(after) <= set(before)


def test_repeated_rows_leave_one(spark, sf_dir):
    docs = helpers.awkward(spark).select(*corpus_pipeline.COLUMNS).where("doc_id in (6, 8, 9)")
    assert [r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, docs, sf_dir).collect()] == [6]


def test_rows_are_judged_by_their_own_text(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = [r.text for r in docs.where("lang = 'en' and length(text) between 300 and 3000").orderBy("doc_id").limit(3).collect()]
    own = [(None, texts[0], "en", "s", 1), (-5, texts[1], "en", "s", 2), (-5, texts[2], "en", "s", 3), (-5, "7 % 12", "en", "s", 4), (None, "12", "en", "s", 5)]
    given = docs.unionByName(spark.createDataFrame(own, docs.schema))
    kept = corpus_pipeline.identify_language(spark, given, sf_dir).where("doc_id is null or doc_id < 0").collect()
    assert Counter(tuple(r) for r in kept) == Counter(own[:3])
    # Beside them a near copy of a higher id, and a repeated row.
    rows = [*own[:3], own[1], (9, texts[2] + " end", "en", "s", 6)]
    left = corpus_pipeline.drop_near_duplicates(spark, spark.createDataFrame(rows, docs.schema), sf_dir).collect()
    assert Counter(tuple(r) for r in left) == Counter(own[:3])


def test_texts_in_several_languages_stay(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    words = {}
    for r in docs.where("length(text) between 1000 and 5000").orderBy("doc_id").collect():
        words.setdefault(r.lang, r.text.split()[:60])
    parts = [own for _, own in sorted(words.items()) if len(own) == 60][:3]
    assert len(parts) == 3
    own = [(-2, " ".join(parts[0] + parts[1]), None, "s", 1), (-3, " ".join(sum(parts, [])), None, "s", 2), (-4, "12 %", None, "s", 3)]
    mixed = spark.createDataFrame(own, docs.schema)
    kept = corpus_pipeline.identify_language(spark, docs.unionByName(mixed), sf_dir).where("doc_id < 0").collect()
    assert sorted(r.doc_id for r in kept) == [-3, -2]
    # Without any lang to learn from, texts with letters stay.
    assert sorted(r.doc_id for r in corpus_pipeline.identify_language(spark, mixed, sf_dir).collect()) == [-3, -2]
