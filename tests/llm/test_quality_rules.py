"""Weak supervision by rules: signals and EM against plain loops, and what the verdict is worth."""

import math
import os
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from breachline.llm import quality_rules
from breachline.llm.queries import op12_quality_rules

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def base_of(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, by the words of their definition."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    hit = {
        i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)
    }
    lines = text.split("\n")
    dup = sum(bool(re.search(r"[^\x20\x09-\x0D]", x)) and x in lines[:i] for i, x in enumerate(lines))
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(hit)


def fit_by_loops(names, patterns, rounds, trust=0.02):
    """The same EM, rule by rule and pattern by pattern; patterns are (votes, count)."""
    n = sum(c for _, c in patterns)
    extra = trust * n + 1
    belief = [[0.3, 0.5, 0.2], [0.03, 0.37, 0.6]]
    prior, rates = 0.8, [[list(b) for b in belief] for _ in names]
    for _ in range(rounds):
        good = []
        for votes, _ in patterns:
            odds = math.log(prior / (1 - prior))
            for j, v in enumerate(votes):
                odds += math.log(rates[j][1][v + 1] / rates[j][0][v + 1])
            good.append(1 / (1 + math.exp(-odds)))
        prior = (sum(g * c for g, (_, c) in zip(good, patterns)) + 0.8 * extra) / (n + extra)
        for j in range(len(names)):
            for y in (0, 1):
                mass = [extra * b for b in belief[y]]
                for g, (votes, c) in zip(good, patterns):
                    mass[votes[j] + 1] += c * (g if y else 1 - g)
                rates[j][y] = [m / sum(mass) for m in mass]
            for v, side in ((0, 0), (2, 1)):
                rates[j][side][v] = max(rates[j][0][v], rates[j][1][v]) if (
                    rates[j][side][v] < rates[j][1 - side][v]
                ) else rates[j][side][v]
            rates[j] = [[x / sum(r) for x in r] for r in rates[j]]
    return prior, rates


TEXTS = [
    None,
    "",
    " \n\t\x0b\x0c\r",
    "one",
    "a b c a b c",
    "a b c d a b c",
    "a a a a",
    "x y\nx y\n\n\n x y\nx y\r\nx y\r",
    "ä é ü ü # | <b> 100% $5 & more * \U0001f600",
    "\x1c\x1d und \x85  ",
    "w " * 70_000,
    " ".join(f"word{i}" for i in range(300)) + "\n" + " ".join(f"word{i}" for i in range(40)),
]


def test_signals_as_defined():
    for text in TEXTS:
        assert quality_rules.signals_of(text)[:5] == base_of(text)


def test_signals_of_long_texts_do_not_depend_on_pieces(monkeypatch):
    rng = random.Random(3)
    text = "".join(rng.choice(["a", "b", "cc", " ", " ", "\n", "é "]) for _ in range(4000))
    whole = quality_rules.signals_of(text)
    monkeypatch.setattr(quality_rules, "_PIECE", 7)
    assert quality_rules.signals_of(text) == whole
    assert whole[:5] == base_of(text)


def test_em_as_by_plain_loops():
    rng = np.random.default_rng(1)
    patterns = sorted({tuple(rng.integers(-1, 2, 4)) for _ in range(30)})
    counts = rng.integers(1, 500, len(patterns))
    fit = quality_rules.estimate(tuple("abcd"), np.array(patterns), counts.astype(float), rounds=25)
    prior, rates = fit_by_loops("abcd", list(zip(patterns, counts.tolist())), 25)
    assert fit.prior == pytest.approx(prior) and fit.rates == pytest.approx(np.array(rates))


def test_em_finds_how_far_rules_can_be_trusted():
    rng = np.random.default_rng(2)
    good = rng.random(40_000) < 0.7
    votes = []
    for accuracy, speaks in ((0.95, 0.9), (0.8, 0.5), (0.65, 0.7), (0.9, 0.4)):
        right = rng.random(len(good)) < accuracy
        vote = np.where(right == good, 1, -1)
        votes.append(np.where(rng.random(len(good)) < speaks, vote, 0))
    patterns, counts = np.unique(np.stack(votes, 1), axis=0, return_counts=True)
    fit = quality_rules.estimate(tuple("abcd"), patterns, counts.astype(float), 1000, trust=0)
    assert list(fit.accuracies.values()) == pytest.approx([0.95, 0.8, 0.65, 0.9], abs=0.04)
    assert fit.prior == pytest.approx(0.7, abs=0.04)


def test_rows_of_every_kind(spark):
    rows = [(i, t, "x") for i, t in enumerate(TEXTS)] + [(None, TEXTS[-1], "y"), (3, "one", "z")]
    documents = spark.createDataFrame(rows, "doc_id bigint, text string, votes string").repartition(3)
    got = quality_rules.judge(documents).collect()
    assert len(got) == len(rows)
    want = Counter((d, *base_of(t)) for d, t, _ in rows)
    base = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert Counter(tuple(r[c] for c in base) for r in got) == want
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert r.kept == (not r.base_failed and r.quality >= 0.5)
    none = spark.createDataFrame([], documents.schema)
    assert quality_rules.judge(none).count() == 0


def test_too_many_rules_are_refused(spark):
    documents = spark.createDataFrame([(1, "x")], "doc_id bigint, text string")
    with pytest.raises(ValueError):
        quality_rules.judge(documents, {str(i): F.lit(0) for i in range(9)})


def test_the_query_agrees_with_labels(spark):
    got = {r.doc_id: r for r in op12_quality_rules(spark, SF).collect()}
    texts = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    assert got.keys() == {d for d, _ in texts}
    for d, t in texts:
        r = got[d]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == base_of(t)
    labels = duckdb.sql(f"SELECT doc_id, quality FROM '{SF}/labels.parquet'").fetchall()
    judged = [(got[d].kept, bool(q)) for d, q in labels if not got[d].base_failed]
    assert sum(k == q for k, q in judged) >= 0.97 * len(judged)
