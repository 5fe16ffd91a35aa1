import random
from collections import Counter

import pytest
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import functions as F

from conftest import SMALL, plan_of
from pagedater import session
from pagedater.operators import subwords, tokens
from pagedater.plans import experiment
from pagedater.registry import queries


def docs(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_word_tokens(spark):
    got = tokens.word_tokens(docs(spark, "aa, bb;cc. Aa", "a b c　d\te\x1ff", " .;,", "")).orderBy("doc_id")
    assert [r.tokens for r in got.collect()] == [["aa", "bb", "cc", "Aa"], list("abcdef"), [], []]


def test_minimum_share_is_inclusive(spark):
    df = tokens.word_tokens(docs(spark, "rare common", *["common"] * 18, ""))
    frequencies = tokens.doc_frequency(tokens.bag_of_words(df))
    assert sorted(frequencies.collect()) == sorted(tokens.doc_frequency(df).collect())
    kept = tokens.prune_vocabulary(frequencies, df, 0.05).orderBy("token_id").collect()
    assert [(r.token, r.df, r.token_id) for r in kept] == [("common", 19, 0), ("rare", 1, 1)]
    assert [r.token for r in tokens.prune_vocabulary(frequencies, df, 0.0501).collect()] == ["common"]


def test_vocabulary_and_vectors_agree_with_the_library(spark):
    df = tokens.word_tokens(queries.documents(spark, SMALL))
    bag = session.stage(tokens.bag_of_words(df), "bag")
    vocabulary = session.stage(tokens.prune_vocabulary(tokens.doc_frequency(bag), df), "vocabulary")
    names = tokens.feature_names(vocabulary)
    library = CountVectorizer(inputCol="tokens", outputCol="features", minDF=0.05).fit(df)
    assert set(names) == set(library.vocabulary) and names == sorted(names)

    vectors = {r.doc_id: r.features for r in tokens.vectorise(df, names).collect()}
    table = tokens.feature_table(df.select("doc_id", "lang", "tokens"), vocabulary).collect()
    assert len(table) == sum(v.numNonzeros() for v in vectors.values())
    assert all(vectors[r.doc_id][r.token_id] == r.n for r in table)


def test_feature_table_counts_known_tokens_only(spark, monkeypatch):
    rows = [(1, "fr", ["b", "a", None, "b", "x"]), (1, "fr", ["b"]), (None, None, ["a"]), (4, "en", None), (5, "en", [])]
    df = spark.createDataFrame(rows, "doc_id long, lang string, tokens array<string>")
    vocabulary = spark.createDataFrame([(3, "a"), (8, "b"), (9, "absent"), (2, None)], "token_id int, token string")
    none = tokens.feature_table(df, vocabulary.limit(0))
    assert none.columns == ["doc_id", "lang", "token_id", "n"] and none.isEmpty()
    wanted = tokens.counted_tokens(df).select("doc_id", "lang", F.explode("bag").alias("pair"))
    wanted = wanted.join(vocabulary, F.col("pair.token") == F.col("token")).select("doc_id", "lang", "token_id", "pair.n")

    def refused(_):
        raise AssertionError("every token is sorted and counted")

    monkeypatch.setattr(tokens, "counted_tokens", refused)
    found = tokens.feature_table(df, vocabulary)
    assert found.schema.simpleString() == wanted.schema.simpleString()
    assert sorted(map(repr, found.collect())) == sorted(map(repr, wanted.collect()))


def test_wide_features(spark):
    bag = tokens.bag_of_words(tokens.word_tokens(docs(spark, "a b a", "b c")))
    wide = tokens.wide_features(bag, ["a", "b"]).orderBy("doc_id").collect()
    assert [tuple(r) for r in wide] == [(0, 2, 1), (1, 0, 1)]


def learn(words, n):
    """Plain byte-pair learning over a dict of words."""
    table = {tuple(w): c for w, c in words.items()}
    merges = []
    for _ in range(n):
        pairs = Counter()
        for symbols, count in table.items():
            for pair in zip(symbols, symbols[1:]):
                pairs[pair] += count
        pairs = {p: c for p, c in pairs.items() if c >= 2}
        if not pairs:
            break
        best = min(pairs, key=lambda p: (-pairs[p], p))
        merges.append(best)
        rewritten = Counter()
        for symbols, count in table.items():
            out, i = [], 0
            while i < len(symbols):
                if symbols[i : i + 2] == best:
                    out.append(symbols[i] + symbols[i + 1])
                    i += 2
                else:
                    out.append(symbols[i])
                    i += 1
            rewritten[tuple(out)] += count
        table = rewritten
    return merges, table


def drawn_texts(seed, letters, n=20):
    rng = random.Random(seed)
    return [" ".join("".join(rng.choice(letters) for _ in range(rng.randint(1, 9))) for _ in range(30)) for _ in range(n)]


@pytest.mark.parametrize("letters, candidates", [("aab", 512), ("ab", 7), ("abcd", 512), ("aaaabc", 3), ("abcdefgh", 512)])
def test_learn_and_apply_merges(spark, monkeypatch, letters, candidates):
    """Rounds of many merges learn what one merge at a time learns, twins and long runs included."""
    monkeypatch.setattr(subwords, "CANDIDATES", candidates)
    texts = drawn_texts(3, letters) + ["a" * 40 + " " + "ab" * 20 + " " + "aab" * 11]
    frame = docs(spark, *texts)
    counts = session.stage(subwords.word_counts(frame), "counts")
    expected, table = learn({r.word: r.n for r in counts.collect()}, 60)
    merges = subwords.learn_merges(counts, 60)
    assert [(r.left, r.right) for r in merges.orderBy("rank").collect()] == expected

    ranks = subwords.merge_ranks(merges)
    segments = {r.word: tuple(subwords.segment(r.word, ranks)) for r in counts.collect()}
    assert all("".join(symbols) == word for word, symbols in segments.items())
    assert set(segments.values()) == set(table)

    found = {(r.doc_id, r.token): r.n for r in subwords.subword_tokens(frame, merges).collect()}
    bags = Counter((i, s) for i, text in enumerate(texts) for word in text.split() for s in segments[word])
    assert found == bags
    lists = {r.doc_id: r.tokens for r in subwords.subword_lists(frame, merges).collect()}
    assert lists == {i: [s for word in text.split() for s in segments[word]] for i, text in enumerate(texts)}


def test_rounds_merge_many_pairs_of_real_words(spark, monkeypatch):
    rounds = []
    whole = subwords.chosen

    def counted(*args):
        rounds.append(whole(*args))
        return rounds[-1]

    monkeypatch.setattr(subwords, "chosen", counted)
    counts = session.stage(subwords.word_counts(queries.documents(spark, SMALL)), "counts")
    expected, _ = learn({r.word: r.n for r in counts.collect()}, 150)
    merges = subwords.learn_merges(counts, 150)
    assert [(r.left, r.right) for r in merges.orderBy("rank").collect()] == expected
    assert len(rounds) < 30 and any(wave for r in rounds for _, wave in r)


def test_learning_ends_by_count(spark):
    merges = subwords.learn_merges(subwords.word_counts(docs(spark, "a b c")), 5)
    assert merges.count() == 0 and merges.columns == ["rank", "left", "right"]
    counts = subwords.word_counts(docs(spark, "abab abab xy", "xy xy"))
    assert [(r.left, r.right) for r in subwords.learn_merges(counts, 9, min_count=3).collect()] == [("a", "b"), ("x", "y")]


def test_subwords_shuffle_nothing(spark):
    merges = spark.createDataFrame([(0, "a", "b")], subwords.MERGES)
    frame = docs(spark, "ab abc", None, "")
    counted, listed = subwords.subword_tokens(frame, merges), subwords.subword_lists(frame, merges)
    assert "Exchange" not in plan_of(counted) + plan_of(listed)
    assert {tuple(r) for r in counted.collect()} == {(0, "ab", 2), (0, "c", 1)}
    assert [r.tokens for r in listed.orderBy("doc_id").collect()] == [["ab", "ab", "c"], [], []]


def test_a_long_run_is_segmented_quickly():
    ranks = {("a" * n, "a" * n): [k] for k, n in enumerate((1, 2, 4, 8))}
    assert subwords.segment("a" * 200_001, ranks) == ["a" * 16] * 12_500 + ["a"]


def test_pieces_keep_every_mark(spark):
    got = subwords.word_counts(docs(spark, "L'été 1854, (où)\x01")).collect()
    assert {r.word: r.n for r in got} == {
        "L": 1, "'": 1, "été": 1, "185": 1, "4": 1, ",": 1, "(": 1, "où": 1, ")\x01": 1,
    }


def test_counting_tokens_shuffles_nothing(spark):
    frame = tokens.word_tokens(docs(spark, "b a b", "", None, "x " * 5000 + "y"))
    bag = tokens.bag_of_words(frame)
    assert "Exchange" not in plan_of(bag) and "Python" not in plan_of(bag)
    assert sorted(map(tuple, bag.collect())) == [(0, "a", 1), (0, "b", 2), (3, "x", 5000), (3, "y", 1)]


def test_vocabulary_is_numbered_without_one_task(spark):
    frame = tokens.word_tokens(docs(spark, *[f"w{i % 500} w{i}" for i in range(3000)]))
    vocabulary = tokens.prune_vocabulary(tokens.doc_frequency(frame), frame, 0)
    assert "SinglePartition" not in plan_of(vocabulary) and "Window" not in plan_of(vocabulary)
    rows = vocabulary.orderBy("token").collect()
    assert [r.token_id for r in rows] == list(range(3000)) and [r.token for r in rows] == sorted(f"w{i}" for i in range(3000))
    assert tokens.prune_vocabulary(tokens.doc_frequency(frame), frame, 1.0).collect() == []


def test_bags_give_the_vectors_of_token_lists(spark):
    merges = spark.createDataFrame([(0, "a", "b"), (1, "ab", "c"), (2, "a", "b")], subwords.MERGES)
    frame = docs(spark, "abc ab  zab, ab", None, "", "q abcab 12", "ab " * 3000, "zz")
    names = ["ab", "abc", "c", "z"]
    bags = subwords.subword_bags(frame, merges)
    assert "Exchange" not in plan_of(bags)
    found = tokens.bag_vectors(bags, names)
    listed = tokens.vectorise(subwords.subword_lists(frame, merges), names)
    assert found.schema["features"].dataType == listed.schema["features"].dataType
    got, expected = ({r.doc_id: r.features for r in df.collect()} for df in (found, listed))
    assert got == expected and len(got) == 6
    counted = {(r.doc_id, r.token): r.n for r in subwords.subword_tokens(frame, merges).collect()}
    assert counted == {(r.doc_id, p.token): p.n for r in bags.collect() for p in r.bag}


def test_a_text_is_cut_into_subwords_once(spark, monkeypatch):
    read = []
    whole = subwords.pieces_of
    monkeypatch.setattr(subwords, "pieces_of", lambda df, text="text": read.append(1) or whole(df, text))
    rows = [(i, i % 2, "le chat dort la nuit " * (1 + i % 3)) for i in range(60)]
    frame = spark.createDataFrame(rows, "page_id long, semicentury int, text string")
    vectors, names = experiment.features(frame, merges=5)
    # Once for the words that merges are learned from, once for the counts.
    assert len(read) == 2 and names and vectors.count() == 60


def test_common_vectors_are_those_of_the_vocabulary(spark, monkeypatch):
    """Words at the very share, texts without words or without anything, batches of few rows; no word is shuffled."""
    random.seed(5)
    known = [f"w{i}" for i in range(40)] + ["é", "\U0001f600", "�"]
    texts = [" ".join(random.choices(known, k=random.randint(0, 9))) for _ in range(190)]
    texts += [None, "", " .;,", "a.b;c,d\te\x1ff　g\x85h", ".w1;", "rare"] + ["w1 w1 w2"] * 4
    rows = [(i, t, "train" if i % 5 else "test") for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, split string").repartition(3)
    train = frame.filter("split = 'train'")
    cut = tokens.word_tokens(frame)
    counted = tokens.doc_frequency(tokens.word_tokens(train))
    # A share that some word has exactly.
    share = sorted(r["df"] for r in counted.collect())[25] / train.count()
    monkeypatch.setattr(tokens, "TEXTS", 16)
    for min_df in (share, 0.05, 0.0, 1.0):
        expected = tokens.feature_names(tokens.prune_vocabulary(counted, train, min_df))
        vectors, names = tokens.common_vectors(frame, F.col("split") == "train", min_df)
        assert names == expected
        assert vectors.columns == ["doc_id", "split", "features"] and vectors.count() == len(rows)
        if names:
            filled = cut.withColumn("tokens", F.coalesce("tokens", F.array().cast("array<string>")))
            wanted = {r.doc_id: r.features for r in tokens.vectorise(filled, names).collect()}
            assert {r.doc_id: r.features for r in vectors.collect()} == wanted
    # What a batch finds common leaves the task, and no more.
    many = spark.createDataFrame([(f"same own{i}",) for i in range(640)], "text string").coalesce(1)
    assert [r.token for r in tokens.common_tokens(many, 0.5).collect()] == ["same"]


def test_words_end_at_the_same_signs_as_word_tokens(spark):
    signs = [chr(i) for i in range(1, 0x3100) if not 0xD800 <= i < 0xE000]
    frame = spark.createDataFrame([(i, f"a{c}b") for i, c in enumerate(signs)], "doc_id long, text string")
    names = sorted({w for r in tokens.word_tokens(frame).collect() for w in r.tokens}, key=str.encode)
    vectors = tokens.count_vectors(frame, names)
    found = {r.doc_id: r.features for r in vectors.collect()}
    assert found == {r.doc_id: r.features for r in tokens.vectorise(tokens.word_tokens(frame), names).collect()}
