"""Quality rules as weak supervision: rules vote or abstain, and EM says what their votes are worth."""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import stage

SIGNALS = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_lines",
    "n_letters",
    "n_capitals",
    "n_marks",
    "n_ends",
)

_SPACE = b"\x20\t\n\x0b\x0c\r"
_GAP = re.compile(rb"[\x20\t\n\x0b\x0c\r]")
#: UTF-8 bytes that begin no character.
_INNER = bytes(range(0x80, 0xC0))
_CAPITALS = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
_SYMBOLS = b"#*$%&|<>"
#: ASCII signs and digits: what in a word is no letter.
_NO_LETTERS = bytes(c for c in range(33, 127) if not chr(c).isalpha())
_MARKS = (b"!!", b"??", b"..", b",,", b"--")
#: Bytes of a text whose words are held at once.
_PIECE = 1 << 20


def _pieces(body: bytes) -> Iterator[bytes]:
    """The text in pieces that end between words."""
    at = 0
    while at < len(body):
        gap = _GAP.search(body, at + _PIECE)
        end = gap.start() if gap else len(body)
        yield body[at:end]
        at = end


def _count(body: bytes, signs: bytes) -> int:
    return len(body) - len(body.translate(None, signs))


def _repeated(ids: np.ndarray, n_kinds: int) -> int:
    """Words that lie in a window of three words which occurs twice or more."""
    if len(ids) < 4:
        return 0
    _, pairs = np.unique(ids[:-1] * n_kinds + ids[1:], return_inverse=True)
    _, windows, n = np.unique(pairs[:-1] * n_kinds + ids[2:], return_inverse=True, return_counts=True)
    again = n[windows] > 1
    hit = np.zeros(len(ids), bool)
    for k in range(3):
        hit[k : k + len(again)] |= again
    return int(hit.sum())


def signals_of(text: str | None) -> tuple[int, ...]:
    """`SIGNALS` of a whole text; null has none of anything.

    Words are maximal runs of other than ASCII white space and told apart by their bytes. Only a
    piece's words are held beside the numbers of the words, so memory is some ten bytes a word.
    """
    body = (text or "").encode("utf-8", "surrogatepass")
    kinds: dict[bytes, int] = {}
    found = [
        np.array([kinds.setdefault(w, len(kinds)) for w in piece.split()], np.int64)
        for piece in _pieces(body)
    ]
    ids = np.concatenate(found) if found else np.empty(0, np.int64)
    seen: set[bytes] = set()
    n_lines = n_dup = 0
    for line in body.split(b"\n"):
        if line.strip(_SPACE):
            n_lines += 1
            n_dup += line in seen
            seen.add(line)
    solid = body.translate(None, _SPACE + _INNER)
    ends = sum(body.count(e + s) for e in (b".", b"!", b"?") for s in (b" ", b"\n"))
    return (
        len(ids),
        len(solid),
        _count(solid, _SYMBOLS),
        n_dup,
        _repeated(ids, len(kinds)),
        n_lines,
        len(solid.translate(None, _NO_LETTERS)),
        _count(solid, _CAPITALS),
        sum(body.count(m) for m in _MARKS),
        ends + body.rstrip(_SPACE).endswith((b".", b"!", b"?")),
    )


def with_signals(documents: DataFrame) -> DataFrame:
    """`doc_id` and `SIGNALS`, as bigint, for every row."""
    kind = pa.struct([(s, pa.int64()) for s in SIGNALS])

    def measure(texts: pa.Array) -> pa.Array:
        rows = np.array([signals_of(t.as_py()) for t in texts], np.int64).reshape(-1, len(SIGNALS))
        return pa.StructArray.from_arrays([pa.array(c) for c in rows.T], fields=list(kind))

    ddl = "struct<" + ",".join(f"{s}:bigint" for s in SIGNALS) + ">"
    # Not deterministic to Spark, so that it runs once for all its fields.
    udf = F.arrow_udf(measure, ddl).asNondeterministic()
    return documents.select("doc_id", udf(F.col("text")).alias("_s")).select("doc_id", "_s.*")


def base_failed() -> Column:
    """What no vote can mend: under 50 words, or over half of the words in repeated windows."""
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def rules() -> dict[str, Column]:
    """The rules over the columns of `SIGNALS`: 1 for good, -1 for bad, 0 to abstain.

    Between its two limits a rule abstains, and some know only one kind of bad text.
    """

    def share(part: str, of: str) -> Column:
        return F.col(part) / F.greatest(F.col(of), F.lit(1))

    def vote(bad: Column, good: Column = F.lit(False)) -> Column:
        return F.when(bad, -1).when(good, 1).otherwise(0)

    symbols, repeats = share("n_symbols", "n_words"), share("n_repeat_words", "n_words")
    lines, capitals = share("n_dup_lines", "n_lines"), share("n_capitals", "word_chars")
    length, letters = share("word_chars", "n_words"), share("n_letters", "word_chars")
    marks, ends = share("n_marks", "n_words"), share("n_ends", "n_words")
    return {
        "symbols": vote(symbols > 0.1, symbols < 0.01),
        "repeats": vote(repeats > 0.3, repeats < 0.1),
        "lines": vote(lines > 0.3),
        "capitals": vote(capitals > 0.3, capitals < 0.06),
        "length": vote((length < 3) | (length > 10), (length > 4.5) & (length < 7)),
        "letters": vote(letters < 0.9, letters > 0.94),
        "marks": vote(marks > 0.1),
        "sentences": vote((ends < 0.005) | (ends > 0.5), (ends > 0.03) & (ends < 0.25)),
    }


@dataclass(frozen=True)
class Fit:
    """What EM found: the share of good documents, and how often each rule votes how.

    `rates[j, y, v]` is the probability that rule `j` gives the vote `v - 1` to a document that is
    bad (`y` 0) or good (1). `accuracies` are those of its votes, abstentions aside.
    """

    names: tuple[str, ...]
    prior: float
    rates: np.ndarray

    @property
    def accuracies(self) -> dict[str, float]:
        share = self.rates * np.array([1 - self.prior, self.prior])[None, :, None]
        right = share[:, 0, 0] + share[:, 1, 2]
        return dict(zip(self.names, (right / share[:, :, [0, 2]].sum(axis=(1, 2))).tolist()))

    def log_odds(self, votes: Column) -> Column:
        """Of good against bad, from an array of votes in the order of the rules."""
        worth = np.log(self.rates[:, 1, :] / self.rates[:, 0, :])
        total = F.lit(float(np.log(self.prior / (1 - self.prior))))
        for j, w in enumerate(worth.tolist()):
            vote = F.get(votes, F.lit(j))
            total += F.when(vote < 0, w[0]).when(vote > 0, w[2]).otherwise(w[1])
        return total


def estimate(
    names: tuple[str, ...], votes: np.ndarray, counts: np.ndarray, rounds: int = 100, trust: float = 0.02
) -> Fit:
    """EM over patterns of votes (rows of -1, 0, 1) and how many documents have each.

    Starts from the belief that rules are better than chance, and keeps a share `trust` of it as
    pseudo-documents, so that a rule that never speaks, or a table of one kind, has rates all the
    same. A bad vote never counts for a document, nor a good one against it.
    """
    n = counts.sum()
    belief = np.array([[0.3, 0.5, 0.2], [0.03, 0.37, 0.6]])
    prior, rates = 0.8, np.repeat(belief[None], len(names), axis=0)
    at = votes + 1
    rule = np.arange(len(names))
    for _ in range(rounds):
        worth = np.log(rates)[rule, :, at].sum(axis=1) + np.log([1 - prior, prior])
        odds = np.clip(worth[:, 1] - worth[:, 0], -500, 500)
        good = counts / (1 + np.exp(-odds))
        mass = np.stack([counts - good, good])
        extra = trust * n + 1
        prior = float((mass[1].sum() + 0.8 * extra) / (n + extra))
        new = np.empty_like(rates)
        for v in range(3):
            new[:, :, v] = ((at == v).T[:, None, :] * mass).sum(axis=2)
        rates = (new + extra * belief) / (new + extra * belief).sum(axis=2, keepdims=True)
        # Where a vote means the contrary of what it says it means nothing.
        for v, side in ((0, 0), (2, 1)):
            wrong = rates[:, side, v] < rates[:, 1 - side, v]
            rates[wrong, side, v] = rates[wrong, 1 - side, v]
        rates /= rates.sum(axis=2, keepdims=True)
    return Fit(names, prior, rates)


def judge(documents: DataFrame, chosen: Mapping[str, Column] | None = None, least: float = 0.5) -> DataFrame:
    """Judge every row: `doc_id`, `SIGNALS`, `base_failed`, `votes`, `quality`, `kept`.

    Texts are read once, for the signals, which are staged. Rules vote on these, and documents are
    counted by their pattern of votes. There are at most `3 ** rules` patterns, so these counts, over
    all documents, go to the driver, where EM fits a rate for every rule, kind of document and vote.
    `quality` is the posterior probability that a document is good, and it is kept with `least` or
    more, unless it fails the base rules.

    Null and empty texts have no words and fail the base. Equal rows are judged alike and count
    each. The empty table gives no rows. Columns other than `doc_id` and `text` are not read.
    """
    chosen = dict(rules() if chosen is None else chosen)
    if not 1 <= len(chosen) <= 8:
        raise ValueError("between one and eight rules, whose patterns fit the driver")
    votes = F.array(*[c.cast("int") for c in chosen.values()])
    measured = stage(with_signals(documents)).withColumn("votes", votes)
    patterns = measured.groupBy("votes").agg(F.count("*").alias("n")).collect()
    patterns.sort(key=lambda r: r["votes"])
    fit = estimate(
        tuple(chosen),
        np.array([r["votes"] for r in patterns], np.int64).reshape(-1, len(chosen)),
        np.array([r["n"] for r in patterns], float),
    )
    quality = 1 / (1 + F.exp(-fit.log_odds(F.col("votes"))))
    judged = measured.withColumns({"base_failed": base_failed(), "quality": quality})
    return judged.select(
        "doc_id",
        *SIGNALS,
        "base_failed",
        "votes",
        "quality",
        (~F.col("base_failed") & (F.col("quality") >= least)).alias("kept"),
    )
