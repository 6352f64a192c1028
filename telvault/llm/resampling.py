"""Target-distribution importance resampling of documents.

A text's features are its runs of 1 to ``most`` words, hashed into buckets. One
pass counts the buckets of all documents and of the target texts; a bucket's
gain is the floored log ratio of the two smoothed shares. A second pass scores
each text: the floored mean of an array of gains. A Gumbel number from a hash of
the id is added, so the highest scores are a draw without replacement by weight.

The draw takes no sort of all rows. Scores are written once; the cutoff comes
from numeric bisection: jobs count the written scores at and above midpoints
until exactly one score is left, and go on with the ids (and then the numbers
of features) of the rows tied there. Only the selected rows are then dealt by
range, and get their ranks from the sizes of the ranges before them.

Counts and gains are arrays of ``buckets`` numbers, whatever the input; each
task holds one such array.

Ids are integers. Defined results: null and empty texts have no features, weight
0 and are not drawn; null ids are hashed as an empty id and come last among
ties; rows that repeat an id are told apart by score and number of features, and
are interchangeable beyond that; an empty table gives no rows, an empty target
counts no feature; further columns are dropped.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from telvault.llm.bpe import pieces_of
from telvault.llm.common import gapless_position, hold, quoted, shared_table

MOST_WORDS, BUCKETS, LEAST_WORDS, PERCENT, SEED = 1, 10_000, 20, 10, 2024
HALVINGS = 3  # of the search interval that one counting job decides
CACHED = 400_000  # words of a task's cache
# A-Z become a-z; ASCII characters that are neither letters nor digits become spaces
PLAIN = bytes(c + 32 if 65 <= c <= 90 else c if c > 127 or chr(c).isalnum() else 32 for c in range(256))


class Bucket(dict):
    """Bucket of each known feature; forgets all when full."""

    def __init__(self, buckets: int):
        self.buckets = buckets

    def __missing__(self, feature: bytes) -> int:
        if len(self) >= CACHED:
            self.clear()
        self[feature] = got = zlib.crc32(feature) % self.buckets
        return got


def features(text: bytes, most: int, bucket: Bucket) -> tuple[int, np.ndarray]:
    """Number of words, and the bucket of each run of 1 to ``most`` words."""
    words = text.translate(PLAIN).split()
    runs = [words] + [list(map(b" ".join, zip(*(words[k:] for k in range(n))))) for n in range(2, most + 1)]
    return len(words), np.fromiter((b for r in runs for b in map(bucket.__getitem__, r)), np.int64, sum(map(len, runs)))


def texts_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of batches, and the UTF-8 bytes of their last column (null: empty)."""
    hold("resampling")
    for batch in batches:
        for b in pieces_of(batch):
            yield b, [t or b"" for t in b.column(b.num_columns - 1).cast(pa.binary()).to_pylist()]


def bucket_counts(texts: DataFrame, text_col: str, most: int = MOST_WORDS, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all ``texts`` fall in each bucket. A task sends its sums, not its features."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, total = Bucket(buckets), np.zeros(buckets, np.int64)
        for _, rows in texts_of(batches):
            for t in rows:
                total += np.bincount(features(t, most, bucket)[1], minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    found = (texts.select(quoted(text_col).alias("text")).mapInArrow(count, "bucket long, n long")
             .groupBy("bucket").agg(F.sum("n").alias("n")).collect())  # at most ``buckets`` rows
    out = np.zeros(buckets, np.int64)
    for r in found:
        out[r["bucket"]] = r["n"]
    return out


def gains(docs: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Floored thousandfold log ratio of the smoothed shares of each bucket."""
    k, s_all, t_all = len(docs), int(docs.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1) * (s_all + k) / ((s + 1) * (t_all + k))))
                     for s, t in zip(docs.tolist(), target.tolist())], np.int64)


def weights(docs: DataFrame, gain: np.ndarray, id_col: str, text_col: str, most: int = MOST_WORDS) -> DataFrame:
    """(id bigint, n_words, n_features, weight) per row."""
    known = docs.sparkSession.sparkContext.broadcast(gain)  # one number for each bucket

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = known.value
        bucket = Bucket(len(gain))
        for b, rows in texts_of(batches):
            out = []
            for t in rows:
                n_words, at = features(t, most, bucket)
                out.append((n_words, len(at), int(gain[at].sum()) // len(at) if len(at) else 0))
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, pa.int64()) for c in zip(*out))], names=["id", "n_words", "n_features", "weight"])

    rows = docs.select(quoted(id_col).cast("bigint").alias("id"), quoted(text_col).alias("text"))
    return rows.mapInArrow(score, "id long, n_words long, n_features long, weight long")


def perturbed(weight: Column, id_: Column, seed: int = SEED) -> Column:
    """Weight plus the floored thousandfold Gumbel number of the id."""
    first = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_.cast("string"), F.lit(""))), 256), 1, 8)
    h = F.conv(first, 16, 10).cast("double")
    return weight + F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def nth_largest(rows: DataFrame, key: Column, n: int) -> tuple[int, int]:
    """The n-th largest value of an integer key among ``rows`` (written; at least ``n``), and how many rows are above.

    Bisection: [low, high] always holds the value sought. A job counts at the midpoints that the next HALVINGS steps
    may ask for, so it takes log(range) / HALVINGS scans of one column.
    """
    low, high = rows.agg(F.min(key), F.max(key)).first()
    above = 0  # rows over ``high``
    while low < high:
        parts = 1 << HALVINGS
        points = sorted({low + (high - low + 1) * k // parts for k in range(1, parts)} - {low})
        counts = rows.agg(*[F.count_if(key >= F.lit(p)) for p in points]).first()
        reach = [p for p, c in zip(points, counts) if c >= n]
        beyond = [(p, c) for p, c in zip(points, counts) if c < n]
        low = max(reach, default=low)
        if beyond:
            high, above = beyond[0][0] - 1, beyond[0][1]
    return low, above


def highest(rows: DataFrame, keys: list[Column], n: int) -> Column:
    """Condition that holds for the ``n`` rows with the largest keys (integers, compared in order), and for rows equal to
    the last of these in all keys."""
    if n <= 0:
        return F.lit(False)
    chosen, tied, need = [], rows, n
    for key in keys:
        if tied.count() <= need:  # all that are tied so far
            break
        value, above = nth_largest(tied, key, need)
        chosen.append((key, value))
        tied, need = tied.where(key == F.lit(value)), need - above
    condition = F.lit(True)
    for key, value in reversed(chosen):
        condition = (key > F.lit(value)) | ((key == F.lit(value)) & condition)
    return condition


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text: str = "text",
             most: int = MOST_WORDS, buckets: int = BUCKETS, least_words: int = LEAST_WORDS, percent: int = PERCENT,
             seed: int = SEED) -> DataFrame:
    """(id bigint, n_features, weight, score, rank) per row of ``docs``: rank 1, 2, ... for those drawn, ``percent`` of
    the rows with at least ``least_words`` words."""
    gain = gains(bucket_counts(docs, text_col, most, buckets), bucket_counts(target, target_text, most, buckets))
    scored = weights(docs, gain, id_col, text_col, most).withColumn("score", perturbed(F.col("weight"), F.col("id"), seed))
    scored = shared_table(scored, "scored")
    able = scored.where(F.col("n_words") >= least_words)
    n = able.count() * percent // 100
    # larger keys first; ~x turns the order of x and cannot overflow
    keys = [F.col("score"), F.col("id").isNotNull().cast("long"), F.bitwise_not(F.coalesce("id", F.lit(0).cast("long"))), F.bitwise_not("n_features")]
    drawn = (F.col("n_words") >= least_words) & highest(able, keys, n)
    order = scored.where(drawn).select("*", (-F.col("score")).alias("_score"), F.col("id").isNull().alias("_none"))
    ranked = gapless_position(order, [], ["_score", "_none", "id", "n_features"], "_at")
    rank = F.when(F.col("_at") < n, F.col("_at") + 1)
    out = ["id", "n_features", "weight", "score"]
    rest = scored.where(~drawn).select(*out, F.lit(None).cast("long").alias("rank"))
    return ranked.select(*out, rank.alias("rank")).unionAll(rest).withColumnRenamed("id", id_col)


def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    return resample(docs, items)
