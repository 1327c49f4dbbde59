"""Importance resampling towards a target distribution.

The features of a text, runs of one or more consecutive words, fall into a fixed number of buckets by their CRC-32. A bucket's gain
says how much commoner it is in the target than in the corpus; both counts cover all rows. A document's weight is the mean gain of its
features, read from an array of gains, and its score is the weight and Gumbel noise, so that the highest scores are a draw without
replacement in proportion to the exponential of the weights.

The cutoff is found without sorting the corpus. A quantile sketch of the scores proposes a bracket around it; exact counts above and inside of the
bracket confirm it, or it is widened; only the rows inside are sorted, and the one at the wanted place is the cutoff.
"""

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardstream.llm.common import fields, fresh, map_batches, slices
from wardstream.llm.wordhash import ALNUM, LOWER, text_bytes
from wardstream.operators.keys import dense_keys
from wardstream.session import materialise

#: Buckets of features: the size of the arrays that are gathered and handed to the tasks.
BUCKETS = 10_000
#: The sketch's places are off by one in so many rows at the most; the bracket starts at twice that on each side.
ACCURACY = 10_000
#: Words longer than this are finished one by one.
_SHORT = 32
_ONES = np.uint32(0xFFFFFFFF)


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        # The reversed polynomial of CRC-32, a fixed value.
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


_TABLE = _crc_table()


def crc_runs(data: np.ndarray, start: np.ndarray, end: np.ndarray, crc: np.ndarray) -> np.ndarray:
    """The CRC-32 of each run of bytes, each carried on from ``crc`` (0: from nothing)."""
    size = end - start
    order = np.argsort(-np.minimum(size, _SHORT + 1), kind="stable")
    at, state = start[order], crc[order] ^ _ONES
    # How many runs are longer than 0, 1, 2, ... bytes.
    longer = len(size) - np.cumsum(np.bincount(np.minimum(size, _SHORT), minlength=_SHORT + 1))
    for j in range(_SHORT):
        n = longer[j]
        if not n:
            break
        now = state[:n]
        state[:n] = _TABLE[(now ^ data[at[:n] + j]) & np.uint32(255)] ^ (now >> np.uint32(8))
    out = np.empty_like(state)
    out[order] = state ^ _ONES
    for i in np.flatnonzero(size > _SHORT).tolist():
        out[i] = zlib.crc32(data[start[i] + _SHORT : end[i]].tobytes(), int(out[i]))
    return out


def features(column: pa.Array, longest: int = 2, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bucket of each feature of all texts and the text it is of, and the words of each text."""
    data, offsets = text_bytes(column)
    data = LOWER[data]
    solid = ALNUM[data]
    edge = np.ones(len(data) + 1, bool)  # places where a run may begin or end: where bytes change kind, and between texts
    edge[1:-1] = solid[1:] != solid[:-1]
    edge[offsets] = True
    places = np.flatnonzero(edge)
    inside = solid[places[:-1]] if len(data) else np.zeros(0, bool)
    start, end = places[:-1][inside], places[1:][inside]
    first = np.searchsorted(start, offsets)
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    here = np.arange(len(start))  # the words that a feature begins with
    crc = crc_runs(data, start, end, np.zeros(len(start), np.uint32))
    all_buckets, all_texts = [], []
    for n in range(1, longest + 1):
        all_buckets.append((crc % np.uint32(buckets)).astype(np.int64))
        all_texts.append(text[here])
        # Carried on by a space and the next word, where the text has one.
        more = here + n < first[text[here] + 1]
        here, crc = here[more], crc[more] ^ _ONES
        spaced = _TABLE[(crc ^ np.uint32(0x20)) & np.uint32(255)] ^ (crc >> np.uint32(8)) ^ _ONES
        if n < longest:
            crc = crc_runs(data, start[here + n], end[here + n], spaced)
    return np.concatenate(all_buckets), np.concatenate(all_texts), np.diff(first)


def bucket_counts(docs: DataFrame, text: str = "text", longest: int = 2, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts fall into each bucket. Each task adds up its own; ``buckets`` numbers reach the driver."""

    def run(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in slices(batch, text):
                total += np.bincount(features(part.column(text), longest, buckets)[0], minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["bucket", "n"])

    parts = map_batches(docs.select(text), run, "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for r in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r.bucket] = r.n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of how much likelier each bucket is in the target, both smoothed by one."""
    in_corpus, in_target = float(corpus.sum() + len(corpus)), float(target.sum() + len(target))
    return np.array(
        [
            math.floor(1000 * math.log((t + 1.0) * in_corpus / ((s + 1.0) * in_target)))
            for s, t in zip(corpus.tolist(), target.tolist(), strict=True)
        ],
        np.int64,
    )


def weighed(
    docs: DataFrame, gain: np.ndarray, text: str = "text", longest: int = 2,
    names: tuple[str, str, str] = ("n_words", "n_features", "weight"),
) -> DataFrame:
    """``docs`` with the words and features of the whole text and the floored mean of their gains (0 without any) in ``names``."""
    if text in names:
        raise ValueError("results need columns of their own")
    rows = docs.drop(*names)
    array = docs.sparkSession.sparkContext.broadcast(gain)  # one number a bucket

    def run(batches):
        held = array.value
        for batch in batches:
            for part in slices(batch, text):
                bucket, of, words = features(part.column(text), longest, len(held))
                n = np.bincount(of, minlength=part.num_rows)
                # Sums of whole numbers far below 2^53 are exact in doubles.
                total = np.bincount(of, held[bucket], minlength=part.num_rows).astype(np.int64)
                found = [words.astype(np.int64), n, total // np.maximum(n, 1)]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, *map(pa.array, found)], [*part.schema.names, *names]
                )

    return map_batches(rows, run, fields(rows, more=", ".join(f"`{n}` long" for n in names)))


def noise(key: str, seed: int):
    """Gumbel noise in thousandths, fixed by the key and the seed; a null key counts as the text ``null``."""
    spelled = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("null")))
    h = F.conv(F.substring(F.sha2(spelled, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def _bracket(rows: DataFrame, score: str, n: int, k: int, accuracy: int) -> tuple[int, int, int]:
    """Scores low and high between which the ``k``-th highest of ``n`` lies, and how many are above high."""
    wide = 2 / accuracy
    while True:
        share = 1 - k / n
        ends = [max(0.0, share - wide), min(1.0, share + wide)]
        low, high = rows.agg(F.percentile_approx(score, ends, accuracy).alias("ends")).first().ends
        if wide >= 1:  # the whole range, whatever the sketch says
            low, high = rows.agg(F.min(score), F.max(score)).first()
        above, below = rows.agg(
            F.count_if(F.col(score) > high), F.count_if(F.col(score) < low)
        ).first()
        if above < k <= n - below:
            return low, high, above
        wide *= 8


def draw(
    scored: DataFrame,
    percent: int,
    key: str = "doc_id",
    score: str = "score",
    among: str | None = None,
    rank: str = "rank",
    accuracy: int = ACCURACY,
) -> DataFrame:
    """``scored`` with the place (1, 2, ...) of the ``percent`` of rows with the highest scores, ties to the smaller key, in ``rank``;
    null for all others.

    ``among`` names a boolean column: only rows where it is true take part and count. Null keys come before others, rows of one
    key and score in any order: of repeated rows, as many are drawn as there are places. An empty table stays empty.

    Pass a stored table: it is read several times.
    """
    rows = scored.drop(rank)
    down, at = fresh(rows, "down", "at")
    able = F.lit(True) if among is None else F.coalesce(F.col(among), F.lit(False))
    part = rows.filter(able)
    n = part.count()
    k = n * percent // 100
    if k == 0:
        return rows.withColumn(rank, F.lit(None).cast("long"))
    low, high, above = _bracket(part, score, n, k, accuracy)
    inside = part.filter(F.col(score).between(low, high)).select(key, (-F.col(score)).alias(down))
    cut = dense_keys(inside, [down, key], above, at).filter(F.col(at) == k).first()
    no_later = F.col(key).isNull() if cut[key] is None else F.col(key).isNull() | (F.col(key) <= cut[key])
    drawn = able & ((F.col(score) > -cut[down]) | ((F.col(score) == -cut[down]) & no_later))
    drawn = F.coalesce(drawn, F.lit(False))
    placed = dense_keys(rows.filter(drawn).withColumn(down, -F.col(score)), [down, key], 0, rank).drop(down)
    # Rows that repeat the cutoff's key and score may be more than there are places.
    placed = placed.withColumn(rank, F.when(F.col(rank) <= k, F.col(rank)))
    return placed.unionByName(rows.filter(~drawn).withColumn(rank, F.lit(None).cast("long")))


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = 25,
    least_words: int = 20,
    seed: int = 7,
    key: str = "doc_id",
    text: str = "text",
    longest: int = 2,
    buckets: int = BUCKETS,
) -> DataFrame:
    """``docs`` without the text and with ``n_words``, ``n_features``, ``weight``, ``score`` and ``rank`` (replaced if there): those with a
    rank are the draw.

    Words are runs of digits, letters a-z and all characters above ASCII, after A-Z are lower-cased; a null text has none. Documents
    of fewer than ``least_words`` words are scored but take no part. The texts of ``target`` are in its column ``text``.
    An empty table stays empty, an empty target makes rare features gain.
    """
    gain = gains(bucket_counts(docs, text, longest, buckets), bucket_counts(target, "text", longest, buckets))
    rows = docs.drop(*(c for c in ("score", "rank") if c not in (key, text)))
    found = weighed(rows, gain, text, longest).drop(text)
    (able,) = fresh(found, "able")
    found = found.withColumn("score", F.col("weight") + noise(key, seed))
    stored = materialise(found.withColumn(able, F.col("n_words") >= least_words), "resample")
    return draw(stored, percent, key, among=able).drop(able)
