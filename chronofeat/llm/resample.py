"""Resampling documents towards a target corpus by hashed n-gram importance weights."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronofeat.llm.common import Scratch
from chronofeat.llm.numbering import numbered

BUCKETS = 10_000
#: Longest run of words that is a feature.
ORDER = 1
LEAST_WORDS = 20
PERCENT = 10
SEED = 2024

#: Bytes of a long text that are split at once.
CHUNK = 1 << 20

#: Letters become lower case; every other ASCII byte that is no digit becomes a blank. Bytes of
#: longer UTF-8 characters stay, so words are found without decoding.
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or 48 <= b <= 57 or b >= 128 else 32
    for b in range(256)
)


def word_chunks(text: bytes, chunk: int = CHUNK) -> Iterator[list[bytes]]:
    """The words of a UTF-8 text, in lists of about `chunk` bytes; a word is never cut."""
    at = 0
    while len(text) - at > chunk:
        blank = text.translate(_WORD_BYTES) if not at else text
        text = blank
        end = text.find(b" ", at + chunk)
        if end < 0:
            break
        yield text[at:end].split()
        at = end
    rest = text[at:] if at else text.translate(_WORD_BYTES)
    yield rest.split()


def feature_codes(words: list[bytes], order: int, carried: int = 0) -> list[int]:
    """crc32 of all runs of 1 to `order` words, joined by one space, that end after `carried` words.

    The sum of a longer run goes on from that of the run without its last word.
    """
    codes = list(map(crc32, words))
    out = codes[carried:]
    spaced = [b" " + w for w in words[1:]] if order > 1 else []
    for more in range(1, order):
        codes = list(map(crc32, spaced[more - 1 :], codes))
        out += codes[max(0, carried - more) :]
    return out


def text_codes(text: bytes, order: int, chunk: int = CHUNK) -> Iterator[tuple[int, np.ndarray]]:
    """(words, codes of all features) of a text, chunk by chunk."""
    tail: list[bytes] = []
    for words in word_chunks(text, chunk):
        codes = feature_codes(tail + words, order, len(tail))
        yield len(words), np.fromiter(codes, np.uint32, len(codes))
        tail = (tail + words)[-(order - 1) :] if order > 1 else []


def bucket_counts(texts: DataFrame, text_col: str, order: int, buckets: int) -> dict[int, int]:
    """Features of all texts per bucket. Each task reduces its texts to one counter of buckets, and
    the counters are added by a shuffle; at most `buckets` rows reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[int] = Counter()
        for batch in batches:
            for text in batch.column(0):
                for _, codes in text_codes(text.as_py() or b"", order):
                    total.update((codes % buckets).tolist())
        yield pa.RecordBatch.from_pydict(
            {"bucket": pa.array(total.keys(), pa.int64()), "n": pa.array(total.values(), pa.int64())}
        )

    counted = texts.select(F.col(text_col).cast("binary")).mapInArrow(run, "bucket long, n long")
    return {r[0]: r[1] for r in counted.groupBy("bucket").agg(F.sum("n")).collect()}


def bucket_gains(corpus: dict[int, int], target: dict[int, int], buckets: int) -> list[int]:
    """Per bucket the log ratio of its smoothed shares in target and corpus, in thousandths."""
    every, wanted = float(sum(corpus.values()) + buckets), float(sum(target.values()) + buckets)
    return [
        math.floor(
            1000
            * math.log((target.get(b, 0) + 1.0) * every / ((corpus.get(b, 0) + 1.0) * wanted))
        )
        for b in range(buckets)
    ]


def importance_weights(
    docs: DataFrame,
    gains: list[int],
    order: int = ORDER,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document: doc_id, n_words, n_features, weight (floored mean gain, 0 if none).

    Null texts have no words. Rows with repeated or null ids are rows of their own; an empty table
    gives none; no other column is read, so their names are free.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.array(gains, np.int64)
        for batch in batches:
            found: list[tuple[int, int, int]] = []
            for text in batch.column(1):
                words = features = total = 0
                for n, codes in text_codes(text.as_py() or b"", order):
                    words, features = words + n, features + len(codes)
                    total += int(table[codes % len(table)].sum())
                found.append((words, features, total // features if features else 0))
            columns = np.array(found, np.int64).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(columns[:, k]) for k in range(3))],
                ["doc_id", "n_words", "n_features", "weight"],
            )

    rows = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("binary"))
    return rows.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def resample(
    docs: DataFrame,
    target: DataFrame,
    order: int = ORDER,
    buckets: int = BUCKETS,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    seed: int = SEED,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document: doc_id, n_features, weight, score, rank.

    `weight` says how much likelier the document's hashed n-grams are in `target` than in `docs`;
    `score` adds Gumbel noise that depends on seed and id only, so that the highest scores are a
    draw without replacement in proportion to the weights. Of the documents with `least_words`
    words, `percent` in a hundred (rounded down) are drawn and ranked from 1, ties by id, null ids
    last; all others have a null rank.

    Null texts are documents without features, of weight 0. Rows of one id have one noise; of rows
    that tie in score and id either may come first. Null ids share the noise of an empty id. Empty
    `docs` give no rows; an empty `target` is uniform over the buckets.
    """
    scratch = Scratch(docs.sparkSession, "resample")
    gains = bucket_gains(
        bucket_counts(docs, text_col, order, buckets),
        bucket_counts(target, text_col, order, buckets),
        buckets,
    )
    weighed = importance_weights(docs, gains, order, id_col, text_col)
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    uniform = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("long") + 0.5
    noise = F.floor(-1000 * F.log(-F.log(uniform / 4294967296.0)))
    scored = scratch.keep(weighed.withColumn("score", F.col("weight") + noise), "scored")
    enough = F.col("n_words") >= least_words
    ranked = numbered(
        scored.where(enough), scratch, "rank", F.desc("score"), F.asc_nulls_last("doc_id")
    )
    draws = scored.where(enough).count() * percent // 100
    ranked = ranked.withColumn("rank", F.when(F.col("rank") < draws, F.col("rank") + 1))
    rest = scored.where(~enough).withColumn("rank", F.lit(None).cast("long"))
    out = ranked.unionByName(rest)
    return out.select(F.col("doc_id").alias(id_col), "n_features", "weight", "score", "rank")


def draw(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The documents that `resample` draws, with all their columns, whatever these are called.

    Ids are taken to name documents: rows that share a drawn id all come, rows without id never do.
    """
    drawn = resample(docs, target, id_col=id_col, **options).where(F.col("rank").isNotNull())
    return docs.join(drawn.select(id_col).distinct(), id_col, "left_semi").select(*docs.columns)
