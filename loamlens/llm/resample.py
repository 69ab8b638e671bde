"""Importance resampling towards a target distribution of hashed word runs."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from loamlens.llm.ranking import with_positions
from loamlens.session import durable

#: buckets features are hashed into; longest run of words that is a feature
BUCKETS, MAX_RUN = 10_000, 1
#: fewest words of a document that can be drawn, and the percentage drawn
MIN_WORDS, PERCENT = 20, 10
SEED = 2024
#: bytes of a text whose words are in memory at once
STEP = 1 << 20

# letters, digits and bytes of longer characters stay, A-Z become a-z, all others separate words
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
               for b in range(256))


def word_lists(text: str | None) -> Iterator[list[bytes]]:
    """The words of a text in order, in lists of bounded size; a list ends where a word does."""
    data = (text or "").encode("utf-8", "surrogatepass").translate(_TABLE)
    at = 0
    while at < len(data):
        end = data.find(b" ", at + STEP)
        end = len(data) if end < 0 else end
        if words := data[at:end].split():
            yield words
        at = end


def feature_counts(text: str | None, buckets: int, max_run: int) -> tuple[int, Counter]:
    """Number of words, and how often each bucket has a feature.

    A run's checksum goes on from that of the run without its last word: ``crc32(b" " + word, crc)``.
    """
    if max_run == 1:
        counted: Counter = Counter()
        for words in word_lists(text):
            counted.update(words)
        found: Counter = Counter()
        for word, n in counted.items():
            found[crc32(word) % buckets] += n
        return counted.total(), found
    n_words, found, tail = 0, Counter(), []
    for words in word_lists(text):
        n_words += len(words)
        whole = tail + words
        sums = [crc32(w) for w in whole]
        for length in range(1, max_run + 1):
            if length > 1:
                sums = [crc32(b" " + w, c) for c, w in zip(sums, whole[length - 1:])]
            # runs that end within the list before have been counted with it
            found.update(c % buckets for c in sums[max(0, len(tail) - length + 1):])
        tail = whole[-(max_run - 1):]
    return n_words, found


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS, max_run: int = MAX_RUN) -> DataFrame:
    """``bucket`` and ``n``, how many features of all ``text`` fall into it.

    Each task adds up one array of all buckets, whatever it reads, so the shuffle has at most
    ``buckets`` rows per task.
    """
    def run(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for text in batch.column("text"):
                for bucket, n in feature_counts(text.as_py(), buckets, max_run)[1].items():
                    total[bucket] += n
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used])], ["bucket", "n"])

    return texts.select("text").mapInArrow(run, "bucket bigint, n bigint") \
        .groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, max_run: int = MAX_RUN) -> DataFrame:
    """``bucket`` and ``gain`` for every bucket: a thousand times the logarithm of how much more often, with one
    feature more in each bucket, the target has it, rounded down."""
    ours = bucket_counts(docs, buckets, max_run).withColumnRenamed("n", "s")
    theirs = bucket_counts(target, buckets, max_run).withColumnRenamed("n", "t")
    none = F.lit(0).cast("bigint")
    # at most one row per bucket: the sums over all of them meet in one task
    both = durable(docs.sparkSession.range(buckets).withColumnRenamed("id", "bucket")
                   .join(ours, "bucket", "left").join(theirs, "bucket", "left")
                   .select("bucket", F.coalesce("s", none).alias("s"), F.coalesce("t", none).alias("t")))
    sums = both.agg(F.sum("s").alias("s"), F.sum("t").alias("t")).first()
    ratio = (F.col("t") + 1.0) * (F.lit(float(sums["s"])) + buckets) / (
        (F.col("s") + 1.0) * (F.lit(float(sums["t"])) + buckets))
    return both.select("bucket", F.floor(F.log(ratio) * 1000).alias("gain"))


def with_weight(docs: DataFrame, gains: Sequence[int], max_run: int = MAX_RUN) -> DataFrame:
    """``text`` is replaced by ``n_words``, ``n_features`` and ``weight``, the mean gain rounded down; 0 without features."""
    kept, buckets = [c for c in docs.columns if c != "text"], len(gains)
    counted = ["n_words", "n_features", "weight"]
    schema = docs.select(*kept, *[F.lit(0).cast("bigint").alias(c) for c in counted]).schema

    def run(batches):
        for batch in batches:
            rows = []
            for text in batch.column("text"):
                n_words, found = feature_counts(text.as_py(), buckets, max_run)
                n = found.total()
                rows.append((n_words, n, sum(gains[b] * k for b, k in found.items()) // n if n else 0))
            columns = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in kept] + [pa.array(c, pa.int64()) for c in columns], [*kept, *counted])

    return docs.mapInArrow(run, schema)


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """A thousandth-part Gumbel variate, rounded down, that follows from the id."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.log(-F.log((h + 0.5) / 4294967296.0)) * -1000)


def resampled(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS,
              carry: Sequence[str] = ("doc_id",), buckets: int = BUCKETS, max_run: int = MAX_RUN,
              seed: int = SEED) -> DataFrame:
    """Every row of ``docs`` with its weight, its score, and its rank if it is drawn.

    ``docs`` has ``doc_id`` and ``text``, ``target`` has ``text``; the columns in ``carry`` are kept in a
    struct ``row``, so no name can clash (``docs.columns`` gives the drawn texts themselves). Drawn
    are the highest scores, weight plus noise, of the rows of at least ``min_words`` words; equal ones
    by the smaller id, a null id last, then in the order rows are stored; repeated rows count each. Only the
    gains, one number a bucket, pass the driver. Texts are read twice and never shuffled unless carried; a
    long one is split a step at a time. Null texts have no words; empty tables give an empty result, and an
    empty target equal gains for what is equally frequent.
    """
    gains = [0] * buckets
    for bucket, gain in bucket_gains(docs, target, buckets, max_run).collect():
        gains[bucket] = gain
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"), F.col("doc_id").alias("id"), "text")
    weighted = with_weight(rows, gains, max_run)
    scored = durable(weighted.select(
        "row", "id", "n_features", "weight", (F.col("weight") + noise(F.col("id"), seed)).alias("score"),
        (F.col("n_words") >= min_words).alias("able")))
    drawn = scored.where("able").count() * percent // 100
    placed = with_positions(scored, ["able"], [F.col("score").desc(), F.col("id").asc_nulls_last()])
    return placed.select("row", "n_features", "weight", "score", F.when(
        F.col("able") & (F.col("position") < drawn), F.col("position") + 1).alias("rank"))
