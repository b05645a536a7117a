"""Quality selection by importance resampling: hashed n-gram models of target and raw text, sampled by Gumbel top-k."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from recoflow.llm.common import _LOWER, cut, fit_logistic, labelled_sample, mix, runs_hash, text_chunks, text_slices

BUCKETS, SAMPLE_ROWS, SMOOTHING, SEED = 1 << 16, 20_000, 1.0, 17
_U = np.uint64
_KIND = np.full(256, 2, np.uint8)
_KIND[[0x20, 9, 10, 11, 12, 13]] = 0
_KIND[[c for c in range(128) if chr(c).isalnum()] + list(range(128, 256))] = 1
_UPPER = np.zeros(256, np.int64)
_UPPER[65:91] = 1


def gram_buckets(data: np.ndarray, bounds: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams of a chunk and the number of the text of each.

    Tokens are runs of word characters or of marks. N-grams are tokens, pairs of neighbours, words in capitals, and
    tokens that repeat the one before.
    """
    kind = np.concatenate([[0], _KIND[data], [0]])
    edge = np.flatnonzero(kind[1:] != kind[:-1])
    starts, ends = edge[:-1], edge[1:]
    full = kind[starts + 1] > 0
    starts, ends = starts[full], ends[full]
    token = runs_hash(_LOWER[data], starts, ends)
    text = np.searchsorted(bounds, starts, "right") - 1
    upper = np.concatenate([[0], np.cumsum(_UPPER[data])])
    loud = (upper[ends] - upper[starts] == ends - starts) & (ends - starts > 1)
    near = text[1:] == text[:-1]
    again = near & (token[1:] == token[:-1])
    pairs = mix(token[:-1] * _U(3) + token[1:])[near]
    grams = np.concatenate([token, pairs, np.full(int(loud.sum()), _U(11)), np.full(int(again.sum()), _U(13))])
    owner = np.concatenate([text, text[1:][near], text[loud], text[1:][again]])
    return (mix(grams) % _U(buckets)).astype(np.int64), owner


def count_rows(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """N-gram counts of one task: of all its texts, and of those labelled as target."""
    raw, target = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
    for batch in text_slices(batches, 0):
        wanted = np.array([x == 1 for x in batch.column(1).to_pylist()], bool)
        for first, after, data, bounds in text_chunks(batch.column(0).to_pylist()):
            bucket, owner = gram_buckets(data, bounds, buckets)
            raw += np.bincount(bucket, minlength=buckets)
            target += np.bincount(bucket[wanted[first:after][owner]], minlength=buckets)
    used = np.flatnonzero(raw)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(raw[used]), pa.array(target[used])], names=["bucket", "raw", "target"])


def weight_rows(batches: Iterator[pa.RecordBatch], ratio: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in text_slices(batches, 1):
        total, grams, low = [], [], []
        for first, after, data, bounds in text_chunks(batch.column(1).to_pylist()):
            bucket, owner = gram_buckets(data, bounds, len(ratio))
            value = ratio[bucket]
            total.append(np.bincount(owner, value, minlength=after - first).astype(float))
            low.append(np.bincount(owner, value < -0.5, minlength=after - first).astype(float))
            grams.append(np.bincount(owner, minlength=after - first))
        empty = np.zeros(0)
        yield pa.RecordBatch.from_arrays([
            batch.column(0), pa.array(np.concatenate(grams or [empty]).astype(np.int64)),
            pa.array(np.concatenate(total or [empty])), pa.array(np.concatenate(low or [empty]))],
            names=["doc_id", "n_grams", "log_weight", "unlikely"])


def selected(scored: DataFrame, key: str, k: int) -> DataFrame:
    """Rows whose ``key`` (double) is among the ``k`` largest; rows that tie with the last one stay.

    The bound is found digit by digit on the key as a whole number, from counts of at most 2^13 values a round; no row
    is sorted and nothing but those counts leaves the executors.
    """
    if k <= 0:
        return scored.where(F.lit(False))
    whole = (F.greatest(F.least(F.col(key), F.lit(2.0 ** 19)), F.lit(-2.0 ** 19)) * F.lit(2.0 ** 32) + F.lit(2.0 ** 51)).cast("long")
    bound, left = 0, k
    for shift in (39, 26, 13, 0):
        inside = scored.where(F.shiftright(whole, shift + 13) == (bound >> (shift + 13)))
        digits = inside.groupBy(F.shiftright(whole, shift).bitwiseAND(F.lit((1 << 13) - 1)).alias("digit")).count().collect()
        for digit, count in sorted(((r[0], r[1]) for r in digits), reverse=True):
            bound_digit = digit
            if count >= left:
                break
            left -= count
        else:
            return scored
        bound |= bound_digit << shift
    return scored.where(whole >= bound)


def sample_by_importance(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS, sample_rows: int = SAMPLE_ROWS,
                         smoothing: float = SMOOTHING, seed: int = SEED, k: int | None = None) -> DataFrame:
    """The sampled rows as ``doc_id``, ``n_grams``, ``log_weight`` (target over raw), ``log_odds``, ``key``, ``kept`` (true).

    The raw model counts the n-grams of all documents, the target model those of documents labelled of good quality;
    their log ratio is a document's importance. At most ``sample_rows`` labels (broadcast) say which texts are target and
    turn the mean log ratio and the share of unlikely n-grams into log odds. ``k`` is the expected number of
    good documents, the sum of the odds' probabilities over all documents, unless given; the ``k`` largest of
    log odds plus Gumbel noise stay. The noise is a hash of ``doc_id``, so a task that runs again decides the same.

    Null and empty texts have no n-grams and the log odds of the constant alone. Rows that repeat a ``doc_id`` are
    scored each; ties with the last sampled key stay. Without labels every log odds is 0. Other columns are ignored.
    """
    spark = docs.sparkSession
    sample = cut(labelled_sample(labels, "quality", sample_rows))
    marked = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id", "left").select("text", "label")
    counts = (marked.mapInArrow(lambda it: count_rows(it, buckets), "bucket long, raw long, target long")
              .groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).collect())
    raw, target = np.zeros(buckets), np.zeros(buckets)
    for bucket, all_texts, good in counts:
        raw[bucket], target[bucket] = all_texts, good
    # Smoothing by the raw model: what the target never shows counts as it does in raw text of the target's size.
    prior = (raw + smoothing) / (raw.sum() + smoothing * buckets)
    model = (target + smoothing * buckets * prior) / (target.sum() + smoothing * buckets)
    shared = spark.sparkContext.broadcast(np.log(model / prior))
    scored = cut(docs.select("doc_id", "text").mapInArrow(
        lambda it: weight_rows(it, shared.value), "doc_id long, n_grams long, log_weight double, unlikely double"))
    mean, share = F.col("log_weight") / F.greatest("n_grams", F.lit(1)), F.col("unlikely") / F.greatest("n_grams", F.lit(1))
    rows = scored.join(F.broadcast(sample), "doc_id").select(mean.alias("mean"), share.alias("share"), "label").toPandas()
    w = fit_logistic(rows[["mean", "share"]].to_numpy(float), rows["label"].to_numpy(float), ridge=1e-5)
    odds = F.lit(float(w[0])) * mean + F.lit(float(w[1])) * share + F.lit(float(w[2]))
    uniform = (F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(seed)), 11).cast("double") + 0.5) / F.lit(2.0 ** 53)
    keyed = scored.withColumn("log_odds", odds).withColumn("key", F.col("log_odds") - F.log(-F.log(uniform)))
    if k is None:
        k = round(keyed.agg(F.sum(1 / (1 + F.exp(-F.col("log_odds"))))).first()[0] or 0)
    return selected(keyed, "key", k).select("doc_id", "n_grams", "log_weight", "log_odds", "key", F.lit(True).alias("kept"))


def keep_sampled(docs: DataFrame, labels: DataFrame, **parameters) -> DataFrame:
    """The rows of ``docs`` whose document is sampled."""
    stay = sample_by_importance(docs, labels, **parameters).select(F.col("doc_id").alias("stay_id")).distinct()
    return docs.join(stay, docs["doc_id"].eqNullSafe(stay["stay_id"]), "left_semi")
