from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from breachline.llm import quality, queries
from breachline.llm.quality import Settings, accuracies, features_of, score_documents, signals_of

GOOD = "This is a plain sentence about some thing. Another one follows it, and then it ends."
BAD = [
    "BUY NOW!! CHEAP!! OFFER!! ONLY!! TODAY!! CLICK!! HERE!!",
    "win$$$ free*** cash### now%%% best&&& deal$$$ here***",
    "same same same same same same same same same same",
    "one | two | three | four | five | six | seven | eight",
]


def rows():
    good = [(i, " ".join([GOOD] * (1 + i % 4)) + f" Number {i}.", 1) for i in range(120)]
    return good + [(1000 + i, " ".join([BAD[i % 4]] * (1 + i % 3)) + f" {i}", 0) for i in range(60)]


def frame(spark, data):
    return spark.createDataFrame(data, "doc_id long, text string, truth int")


def test_good_and_bad_are_told_apart(spark):
    odd = frame(spark, rows()).withColumns({n: F.lit(1) for n in ("_signals", "words", "weak_label")})
    got = score_documents(odd)
    assert got.columns == ["doc_id", "text", "truth", "_signals", "words", "weak_label", "quality"]
    data = got.collect()
    assert len(data) == 180
    assert all(0 <= r["quality"] <= 1 and 0 <= r["weak_label"] <= 1 for r in data)
    assert sum((r["quality"] >= 0.5) == bool(r["truth"]) for r in data) >= 175


def test_nulls_empty_and_repeated_rows(spark):
    extra = [(5000, None, 0), (5001, "", 0), (5002, "123 456", 0), (None, GOOD, 1), (5003, GOOD, 1), (5003, GOOD, 1)]
    got = score_documents(frame(spark, rows() + extra)).collect()
    scores = {r["doc_id"]: r["quality"] for r in got if r["doc_id"] is None or r["doc_id"] >= 5000}
    assert scores[5000] == scores[5001] == scores[5002] == 0
    assert scores[None] == scores[5003] > 0.5
    assert sum(r["doc_id"] == 5003 for r in got) == 2


def test_empty_table(spark):
    assert score_documents(frame(spark, [])).count() == 0


def test_nothing_depends_on_slices(monkeypatch):
    long_word = "go " + "x1" * 400 + " go go " + "Y" * 300
    for text in (" ".join([GOOD, *BAD, GOOD]), "again " * 500, " " * 300 + "end", long_word, "a\u2003b" * 200):
        signals, (at, value) = signals_of(text), features_of(text, 1 << 10)
        for size in (1, 3, 32, 257):
            with monkeypatch.context() as patch:
                patch.setattr(quality, "_SLICE", size)
                assert "".join(quality._slices(text)) == text
                assert signals_of(text) == signals
                cut_at, cut_value = features_of(text, 1 << 10)
                assert cut_at.tolist() == at.tolist() and np.allclose(cut_value, value, atol=1e-12)


def test_words_of_a_long_text_are_counted_exactly():
    text = "eleven characters " * 100_000
    assert len(text) > quality._SLICE and signals_of(text)[0] == 200_000


def plain_signals(text):
    """The signals, character by character."""
    from unicodedata import category

    words, kinds = (text or "").split(), [(c, category(c)) for c in text or ""]
    odd = [c for c, k in kinds if k[0] not in "LMNZ" and c not in "\t\n\x0b\x0c\r"]
    bars = sum(c == "|" for c in odd)
    return (
        len(words),
        sum(k[0] in "LM" for _, k in kinds),
        sum(k == "Lu" for _, k in kinds),
        sum(c not in ".!?,;:'\"()-’“”" for c in odd),
        sum(c in ".!?,;:" for c in odd),
        sum(x == y for x, y in zip(words, words[1:])),
        bars,
    )


def test_query_equals_brute_force(spark):
    """All texts are in the sample here, so the scorer can be fitted again in plain Python."""
    folder, settings = "/root/testdata/sf0.001", Settings()
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    names, rules = quality._SIGNALS, list(quality.labellers().values())
    rows = [(r["doc_id"], *plain_signals(r["text"])) for r in docs]
    frame = spark.createDataFrame(rows, "doc_id long, " + ", ".join(f"{n} long" for n in names))
    pattern = {r[0]: tuple(r[1:]) for r in frame.select("doc_id", *rules).collect()}
    prior, right = quality.accuracies(Counter(pattern.values()))
    label = {k: float(quality.posterior(np.array([p], float), prior, right)[0]) for k, p in pattern.items()}
    texts = {r["text"]: (r["doc_id"], r["text"]) for r in docs if plain_signals(r["text"])[1]}
    weights, bias = quality.fit([(*features_of(t, settings.buckets), label[k]) for k, t in texts.values()], settings)
    got = {r["doc_id"]: r for r in queries.op9_quality(spark, folder).collect()}
    assert len(got) == len(docs)
    for r in docs:
        at, value = features_of(r["text"], settings.buckets)
        want = 1 / (1 + np.exp(-(weights[at] @ value + bias))) if plain_signals(r["text"])[1] else 0.0
        one = got[r["doc_id"]]
        assert abs(one["quality"] - want) < 1e-6 and abs(one["weak_label"] - label[r["doc_id"]]) < 1e-9
        assert one["keep"] == (one["quality"] >= 0.5)


def test_signals():
    words, letters, upper, symbols, marks, repeats, bars = signals_of("Go go GO | x$ x$ é1.")
    assert (words, letters, upper, symbols, marks, repeats, bars) == (7, 9, 3, 3, 1, 1, 1)
    assert signals_of(None) == signals_of("") == (0,) * 7


def test_features_have_length_one():
    for text in (GOOD, "", None, "x"):
        at, value = features_of(text, 1 << 10)
        assert at.max() < 1 << 10 and abs(np.linalg.norm(value) - 1) < 1e-9


def test_em_finds_accuracies():
    pick = np.random.default_rng(1)
    truth = np.where(pick.random(20_000) < 0.7, 1, -1)
    right = np.array([0.9, 0.75, 0.65, 0.85])
    votes = np.where(pick.random((20_000, 4)) < right, truth[:, None], -truth[:, None])
    votes[pick.random(votes.shape) < 0.4] = 0
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    prior, found = accuracies({tuple(p): int(n) for p, n in zip(patterns.tolist(), counts)})
    assert abs(prior - 0.7) < 0.03 and np.abs(found - right).max() < 0.03


def test_agrees_with_given_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = score_documents(docs, Settings(rounds=200)).join(labels.withColumnRenamed("quality", "truth"), "doc_id")
    data = got.select("quality", "truth").collect()
    assert sum((r["quality"] >= 0.5) == bool(r["truth"]) for r in data) >= 0.97 * len(data)


def test_the_sample_is_bounded_and_of_different_texts_with_letters(spark, monkeypatch):
    fitted = []

    def fit(rows, settings, real=quality.fit):
        fitted.extend(rows)
        return real(rows, settings)

    monkeypatch.setattr(quality, "fit", fit)
    # Nulls, and for each of some texts a group of copies: whichever groups are drawn are drawn once.
    extra = [(2000 + i, None, 0) for i in range(500)] + [(3000 + i, f"{GOOD} Copy {i % 9}.", 1) for i in range(900)]
    got = score_documents(frame(spark, rows() + extra), Settings(sample_docs=40)).collect()
    good = [r for r in fitted if r[2] >= 0.5]
    # Of 129 and 60 different texts with letters.
    assert len(good) == 40 and len(fitted) - len(good) == 40
    junk = [r["quality"] for r in got if 1000 <= r["doc_id"] < 2000]
    assert sum(q < 0.5 for q in junk) >= 57
    assert all(r["quality"] == 0 for r in got if r["text"] is None)
