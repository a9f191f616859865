"""Quality of documents: weak labellers, their accuracies by EM, and a hashed linear scorer."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import hide, kept_by_worker, stage

_SIGNALS = ["words", "letters", "upper", "symbols", "marks", "repeats", "bars"]
#: Characters of a text that are looked at together, to bound memory, but for the end of a word.
_SLICE = 1 << 20
_SPACE = re.compile(r"\s")


@dataclass(frozen=True)
class Settings:
    """Size of the scorer and of the sample it is fitted to.

    At most `sample_docs` different texts are drawn from either side of the weak labels; of each only
    hashed features reach the driver, at most `buckets` numbers. The scorer has one weight per bucket.
    """

    sample_docs: int = 2000
    buckets: int = 1 << 14
    rounds: int = 300
    rate: float = 0.1
    decay: float = 1e-4


def labellers() -> dict[str, Column]:
    """The heuristics, over the columns of the signals: 1 for good, -1 for bad, 0 for no opinion.

    Most know one kind of bad text and say nothing of the rest: that a text is not shouted does not
    make it good. Several may speak of the same text, which is how their accuracies show.
    """

    def share(part: str, of: str) -> Column:
        return F.col(part) / F.greatest(F.col(of), F.lit(1))

    def vote(bad: Column, good: Column = F.lit(False)) -> Column:
        return F.when(bad, -1).when(good, 1).otherwise(0)

    upper, symbols = share("upper", "letters"), share("symbols", "words")
    repeats, bars = share("repeats", "words"), share("bars", "words")
    length, marks = share("letters", "words"), share("marks", "words")
    plain = (upper < 0.3) & (symbols < 0.2) & (repeats < 0.05) & (bars < 0.05)
    return {
        "shouting": vote(upper > 0.5),
        "symbols": vote(symbols > 0.5),
        "repetition": vote(repeats > 0.1),
        "tables": vote(bars > 0.1),
        "words": vote((length < 2) | (length > 15)),
        "marks": vote((marks > 0.7) | (marks < 0.01), plain & (marks > 0.03) & (marks < 0.4)),
        "prose": vote(~plain, plain & (length > 3) & (length < 9)),
        "letters": vote(F.col("letters") == 0),
    }


def _classes() -> np.ndarray:
    return kept_by_worker("character classes", _class_table)


def _class_table() -> np.ndarray:
    """A class for every character: space, lower, upper, digit, other letter, or its own."""
    table = np.arange(0x110000, dtype=np.uint32) + 16
    for c in range(0x110000):
        kind = unicodedata.category(chr(c))
        if kind[0] == "L" or kind[0] == "M":
            table[c] = {"Ll": 1, "Lu": 2}.get(kind, 4)
        elif kind[0] == "N":
            table[c] = 3
        elif kind[0] == "Z" or c in (9, 10, 11, 12, 13):
            table[c] = 0
    return table


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def _slices(text: str | None) -> Iterator[str]:
    """Parts of a text that end between words; a single longer word is a part."""
    text, start = text or "", 0
    while start < len(text):
        end = start + _SLICE
        if end < len(text):
            cut = _SPACE.search(text, end)
            end = cut.start() if cut else len(text)
        yield text[start:end]
        start = end


_MARKS = np.array([ord(c) + 16 for c in ".!?,;:"], np.uint32)
_PLAIN = np.array([ord(c) + 16 for c in ".!?,;:'\"()-’“”"], np.uint32)
_BARS = np.array([ord(c) + 16 for c in "|\t"], np.uint32)


def signals_of(text: str | None) -> tuple[int, ...]:
    """Counts over a whole text: words, letters, capitals, odd symbols, marks, repeats, bars."""
    total, carried = np.zeros(7, np.int64), []
    for part in _slices(text):
        kind = _classes()[_codes(part)]
        own = kind[kind >= 16]
        words = carried + part.split()
        total[0] += len(words) - len(carried)
        total[1] += int(((kind > 0) & (kind != 3) & (kind < 16)).sum())
        total[2] += int((kind == 2).sum())
        total[3] += int((~np.isin(own, _PLAIN)).sum())
        total[4] += int(np.isin(own, _MARKS).sum())
        total[5] += sum(map(eq, words, words[1:]))
        total[6] += int(np.isin(own, _BARS).sum())
        carried = words[-1:]
    return tuple(total.tolist())


def features_of(
    text: str | None, buckets: int, signals: tuple[int, ...] | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of a whole text: runs of three and four character classes, and repetition.

    A run of one class counts as one, so words look alike whatever their letters and length. Values
    are logarithms of shares, scaled to length one. Signals that are known already can be passed on.
    """
    count, before = np.zeros(buckets), np.empty(0, np.uint64)
    for part in _slices(text):
        # The last classes of a part go before the next, so that no run of them is lost between two.
        kind = np.concatenate([before, _classes()[_codes(part)].astype(np.uint64)])
        kind = kind[np.append(True, kind[1:] != kind[:-1])]
        for n, seed in ((3, 0x9E3779B97F4A7C15), (4, 0xC2B2AE3D27D4EB4F)):
            new = kind[max(0, before.size - n + 1) :]
            if new.size >= n:
                h = np.full(new.size - n + 1, seed, np.uint64)
                for k in range(n):
                    h = (h ^ new[k : new.size - n + 1 + k]) * np.uint64(0xFF51AFD7ED558CCD)
                    h ^= h >> np.uint64(33)
                count += np.bincount((h % np.uint64(buckets - 16)).astype(np.int64), minlength=buckets)
        before = kind[-3:]
    words, *_, repeats, _ = signals or signals_of(text)
    at = np.flatnonzero(count)
    value = np.log1p(100 * count[at] / max(1.0, count.sum()))
    at = np.append(at, buckets - 16 + min(9, int(10 * repeats / max(1, words))))
    value = np.append(value, 3.0)
    return at, value / np.linalg.norm(value)


def accuracies(
    patterns: Mapping[tuple[int, ...], int], rounds: int = 200, prior: float = 0.7
) -> tuple[float, np.ndarray]:
    """Share of good documents and the accuracy of each labeller where it votes, by EM.

    Labellers are taken to err independently given the truth. Each step weighs every pattern of
    votes by how often it occurs. Labellers are held to be better than chance, which settles which
    side is which.
    """
    votes = np.array([*patterns], float).reshape(len(patterns), len(next(iter(patterns), ())))
    weight = np.array([*patterns.values()], float)
    right = np.full(votes.shape[1], 0.8)
    for _ in range(rounds if weight.sum() else 0):
        good = posterior(votes, prior, right)
        prior = float(np.clip((weight * good).sum() / weight.sum(), 0.01, 0.99))
        agree = np.where(votes > 0, good[:, None], 1 - good[:, None])
        voted = weight[:, None] * (votes != 0)
        right = np.clip(((voted * agree).sum(axis=0) + 4) / (voted.sum(axis=0) + 5), 0.55, 0.99)
    return prior, right


def posterior(votes: np.ndarray, prior: float, right: np.ndarray) -> np.ndarray:
    """Probability that documents with these votes are good."""
    odds = np.log(prior / (1 - prior)) + votes @ np.log(right / (1 - right))
    return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))


def fit(rows: Sequence[tuple], settings: Settings) -> tuple[np.ndarray, float]:
    """Weights and intercept of a logistic scorer, from rows of buckets, values and target."""
    weights, bias = np.zeros(settings.buckets), 0.0
    if not rows:
        return weights, bias
    at = np.concatenate([np.asarray(r[0], np.int64) for r in rows])
    value = np.concatenate([np.asarray(r[1]) for r in rows])
    row = np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows])
    target = np.array([r[2] for r in rows])
    # Both sides weigh the same, however many of each were drawn.
    weight = 0.5 * target / max(target.sum(), 1e-9) + 0.5 * (1 - target) / max((1 - target).sum(), 1e-9)
    step, bias_step = np.full(settings.buckets, 1e-8), 1e-8
    for _ in range(settings.rounds):
        score = np.bincount(row, weights[at] * value, len(rows)) + bias
        error = weight * (1 / (1 + np.exp(-np.clip(score, -30, 30))) - target)
        slope = np.bincount(at, error[row] * value, settings.buckets) + settings.decay * weights
        step += slope**2
        weights -= settings.rate * slope / np.sqrt(step)
        bias_slope = error.sum()
        bias_step += bias_slope**2
        bias -= settings.rate * bias_slope / np.sqrt(bias_step)
    return weights, float(bias)


def signals(text: Column) -> Column:
    """The signals of a text column, a struct."""

    @F.pandas_udf(", ".join(f"{name} long" for name in _SIGNALS))
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([signals_of(t) for t in batch], columns=_SIGNALS, dtype="int64")

    return of(text)


def score_documents(
    documents: DataFrame, settings: Settings = Settings(), rules: Mapping[str, Column] | None = None
) -> DataFrame:
    """The documents with `weak_label` and `quality`, both from 0 (bad) to 1.

    Every document is put before the labellers. How often each pattern of votes occurs, over all
    documents, gives their accuracies and the posterior of each pattern, the weak label. A linear
    scorer over hashed features learns weak labels from a sample and gives the quality, so that it
    can also judge what no rule speaks to. No given label is used.

    There are at most three to the number of labellers patterns, which bounds what reaches the
    driver besides the sample. Null and empty texts have no letters: their quality is 0. All rows
    and columns stay; columns with the two names are replaced. Equal rows, and equal texts, give
    equal results. Very long texts are read in slices that end between words and share the classes
    around their ends, so their length changes no result. With no documents there is nothing to
    learn and no row.
    """
    rules = labellers() if rules is None else dict(rules)
    spark = documents.sparkSession
    pattern = F.array(*[v.cast("tinyint") for v in rules.values()])
    carried, restored = hide(documents, ("text",), ("weak_label", "quality"))
    text = F.col("text")

    def voted(frame: DataFrame) -> DataFrame:
        return frame.withColumns({s: F.col(f"_signals.{s}") for s in _SIGNALS})

    # Staged without the texts, so they are read along once for the votes and once for the scores.
    looked_at = stage(documents.select(F.xxhash64("text").alias("hash"), signals(text).alias("_signals")))
    votes = voted(looked_at).withColumn("pattern", pattern)
    lettered = F.when(F.col("letters") > 0, F.col("hash"))
    seen = votes.groupBy("pattern").agg(F.count("*"), F.approx_count_distinct(lettered)).collect()
    counts = {tuple(r[0]): r[1] for r in seen}
    prior, right = accuracies(counts)
    label = {
        p: float(posterior(np.array([p], float), prior, right)[0]) for p in counts
    }
    pairs = [F.lit(x) for p, v in label.items() for x in (",".join(map(str, p)), v)]
    known = F.create_map(*pairs).cast("map<string,double>")
    weak = F.try_element_at(known, F.array_join(pattern.cast("array<string>"), ","))
    # Texts without letters are not drawn, as their quality is fixed, and copies are drawn once. A cut on
    # the hash leaves somewhat more than the sample, from about how many texts there are; then it is exact.
    n_good = sum(r[2] for r in seen if label[tuple(r[0])] >= 0.5)
    n_bad = sum(r[2] for r in seen) - n_good
    leave = 1.5 * settings.sample_docs + 100
    good_rate, bad_rate = (min(1.0, leave / max(1, n)) for n in (n_good, n_bad))

    texts = votes.where("letters > 0").select("hash", weak.alias("label"))
    texts = texts.withColumn("good", F.col("label") >= 0.5)
    place = F.pmod(F.col("hash"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    thinned = texts.where(place < F.when(F.col("good"), good_rate).otherwise(bad_rate))
    folded = thinned.groupBy("good", "hash").agg(F.max("label").alias("label"))
    least = Window.partitionBy("good").orderBy(place, "hash")
    drawn = folded.withColumn("rank", F.row_number().over(least)).where(F.col("rank") <= settings.sample_docs)
    # Staged, its size is known: the hashes are broadcast and the texts stay where they are.
    drawn = stage(drawn.groupBy("hash").agg(F.max("label").alias("label")))
    found = documents.select("text", F.xxhash64("text").alias("hash")).where("text IS NOT NULL").join(drawn, "hash")
    drawn_texts = found.groupBy("hash").agg(F.max("text").alias("text"), F.max("label").alias("label"))
    buckets = settings.buckets

    @F.pandas_udf("at array<int>, value array<double>")
    def features(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [features_of(t, buckets) for t in batch]
            yield pd.DataFrame({"at": [f[0].astype("int32") for f in found], "value": [f[1] for f in found]})

    rows = drawn_texts.select(features(text).alias("f"), "label").select("f.at", "f.value", "label")
    model = spark.sparkContext.broadcast(fit([tuple(r) for r in rows.collect()], settings))

    @F.pandas_udf(", ".join(f"{name} long" for name in _SIGNALS) + ", judged double")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        weights, bias = model.value
        for batch in batches:
            out = []
            for t in batch:
                own = signals_of(t)
                at, value = features_of(t, buckets, own)
                out.append((*own, 1 / (1 + np.exp(-np.clip(weights[at] @ value + bias, -30, 30)))))
            frame = pd.DataFrame(out, columns=[*_SIGNALS, "judged"])
            yield frame.astype(dict.fromkeys(_SIGNALS, "int64") | {"judged": "float64"})

    scored = voted(documents.select(*carried, judge(text).alias("_signals")))
    return scored.select(
        *restored.values(),
        weak.alias("weak_label"),
        F.when(F.col("letters") == 0, 0.0).otherwise(F.col("_signals.judged")).alias("quality"),
    )
