"""Identify languages by compression with a dictionary per language."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import hide, stage

_LETTER = re.compile(r"[^\W\d_]")
UNKNOWN = "und"


@dataclass(frozen=True)
class Settings:
    """Bounds of what is learned, and how texts are measured.

    A dictionary holds at most `dictionary_bytes`, all of them together `all_bytes`, so what is sent
    to executors does not grow with the corpus. They are made of about `sample_docs` labelled
    different texts per language, of each of which at most `excerpt_chars` are looked at, in `pieces`
    from start to end. Texts are compressed in blocks of `block_bytes`, so that a long text cannot
    stand in for the dictionary, and in lower case, so that shouting reads like speech.
    """

    sample_docs: int = 300
    excerpt_chars: int = 2000
    pieces: int = 4
    dictionary_bytes: int = 128 << 10
    all_bytes: int = 16 << 20
    block_bytes: int = 2048
    level: int = 6


class Compressors:
    """A compressor for each language, with a raw-content dictionary."""

    def __init__(self, dictionaries: dict[str, bytes], settings: Settings):
        import zstandard as zstd

        self.block, self.by_language = settings.block_bytes, {}
        for language in sorted(dictionaries):
            content = zstd.ZstdCompressionDict(
                dictionaries[language], dict_type=zstd.DICT_TYPE_RAWCONTENT
            )
            content.precompute_compress(level=settings.level)
            self.by_language[language] = zstd.ZstdCompressor(
                level=settings.level, dict_data=content, write_content_size=False
            )

    def judge(self, text: str | None) -> tuple[str, float]:
        """The language whose dictionary makes the text smallest, and the margin to the second.

        The margin is the share of the second-best size that the best saves, and 1 where there is
        no second. Ties go to the first language by code point.
        """
        if not text or not self.by_language or not _LETTER.search(text):
            return UNKNOWN, 0.0
        raw = text.lower().encode("utf-8", "replace")
        blocks = [raw[i : i + self.block] for i in range(0, len(raw), self.block)]
        sizes = sorted(
            (sum(len(c.compress(b)) for b in blocks), language)
            for language, c in self.by_language.items()
        )
        if len(sizes) == 1:
            return sizes[0][1], 1.0
        return sizes[0][1], (sizes[1][0] - sizes[0][0]) / sizes[1][0]


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept out of training."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def learn(labelled: DataFrame, settings: Settings = Settings()) -> dict[str, bytes]:
    """A dictionary of sample text for each value of `lang` among the labelled rows.

    The sample is the different texts of each language with the least hash; copies count once. It
    is chosen in two steps: a cut on the hash that leaves about twice the sample, from the number of
    different texts of the language, then the exact choice among those. Only excerpts of that
    bounded sample are shuffled and reach the driver. Every document of the sample is in the
    dictionary: short ones whole, and what they leave is shared evenly among the others.
    """
    rows = labelled.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    rows = rows.select("lang", "text", F.xxhash64("text").alias("_hash"))
    # Staged, its size is known: a number per language is broadcast and the texts stay in place.
    different = rows.select("lang", "_hash").distinct()
    counts = stage(different.groupBy("lang").agg(F.count("*").alias("_n")))
    keep = F.least(F.lit(1.0), F.lit(2.0 * settings.sample_docs + 50) / F.col("_n"))
    place = F.pmod(F.col("_hash"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    thinned = rows.join(counts, "lang").where(place < keep)
    excerpts = thinned.select("lang", "_hash", _excerpt(F.col("text"), settings).alias("text"))
    once = excerpts.groupBy("lang", "_hash").agg(F.min("text").alias("text"))
    ranked = once.withColumn("_rank", F.row_number().over(Window.partitionBy("lang").orderBy(place, "_hash")))
    sample = ranked.where(F.col("_rank") <= settings.sample_docs)
    by_language: dict[str, list[bytes]] = {}
    for row in sorted(sample.collect(), key=lambda r: (r["lang"], -r["_rank"])):
        by_language.setdefault(row["lang"], []).append(row["text"].lower().encode("utf-8", "replace"))
    each = min(settings.dictionary_bytes, settings.all_bytes // max(1, len(by_language)))
    return {language: _shared(texts, each) for language, texts in by_language.items()}


def _excerpt(text: Column, settings: Settings) -> Column:
    """At most `excerpt_chars` of a text, in pieces that lie evenly from its start to its end."""
    n, pieces = F.length(text), settings.pieces
    size = settings.excerpt_chars // pieces
    start = [F.floor((n - size) * (k / max(1, pieces - 1))).cast("int") + 1 for k in range(pieces)]
    spread = F.concat_ws("\n", *[F.substring(text, s, F.lit(size)) for s in start])
    return F.when(n <= settings.excerpt_chars, text).otherwise(spread)


def _shared(texts: list[bytes], most: int) -> bytes:
    """The texts in `most` bytes: short ones whole, the others their middle, all of one length."""
    left, limit = most - len(texts), 0
    for i, size in enumerate(sorted(map(len, texts))):
        limit = left // (len(texts) - i)
        if size > limit:
            break
        left -= size
    else:
        limit = max(map(len, texts), default=0)
    cut = [t[(len(t) - limit) // 2 :][:limit] if len(t) > limit else t for t in texts]
    return b"\n".join(cut)[:most]


def language(text: Column, dictionaries: Broadcast, settings: Settings = Settings()) -> Column:
    """The language of a text column: a struct of `lang` and `margin`."""

    @F.pandas_udf("lang string, margin double")
    def judge(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = Compressors(dictionaries.value, settings)
        for batch in texts:
            yield pd.DataFrame([model.judge(t) for t in batch], columns=["lang", "margin"])

    return judge(text)


def identify(
    documents: DataFrame, labelled: DataFrame, settings: Settings = Settings(), margin: float = 0.005
) -> DataFrame:
    """Every document with `lang_pred`, `lang_margin` and `lang_rejected`.

    Learned from `lang` and `text` of the labelled rows; predicted from the whole text alone.
    `lang_rejected` is true where the margin is below `margin`, and where the text is null or has no
    letter, for which `lang_pred` is `und` and the margin 0. With no labelled rows everything is
    `und`; with one language everything with a letter is that. Columns of the documents are kept;
    any that have the names of the three added ones are replaced. Rows stay where they are.
    """
    model = documents.sparkSession.sparkContext.broadcast(learn(labelled, settings))
    carried, restored = hide(documents, ("text",), ("lang_pred", "lang_margin", "lang_rejected"))
    judged = documents.select(*carried, language(F.col("text"), model, settings).alias("_judged"))
    found, by = F.col("_judged.lang"), F.col("_judged.margin")
    return judged.select(
        *restored.values(),
        found.alias("lang_pred"),
        by.alias("lang_margin"),
        ((found == UNKNOWN) | (by < margin)).alias("lang_rejected"),
    )
