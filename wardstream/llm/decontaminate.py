"""Benchmark decontamination by winnowing.

A document is contaminated where it repeats ``n`` words in a row of a benchmark item (or the whole
of an item that is shorter). Of each ``n`` words in a row, winnowing keeps one fingerprint, the least hash
of the ``k``-word grams inside (the rightmost of equals). Equal windows keep equal fingerprints, so
joining the fingerprints of both tables meets every shared span of ``n`` words; each hit is then
extended both ways, word by word, and counts if the shared run is long enough.

Before the join, a bitmap of fixed size (``BITS``) of the benchmark's fingerprints drops most
documents' fingerprints where they arise. It only saves work: those that pass are joined exactly.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardstream.llm.common import fields, map_batches, rows_and_files, slices
from wardstream.llm.wordhash import Words, grams, words
from wardstream.session import materialise

#: Size of the bitmap: 2^22 bits, 512 KB at the most, however large the benchmark.
BITS = 22
ANCHOR = "array<struct<n:int,hash:bigint,pos:bigint,back:array<bigint>,ahead:array<bigint>>>"


def gram_size(n: int, k: int) -> int:
    return min(k, n)


def winnow(w: Words, n: int, k: int) -> np.ndarray:
    """Places of the grams that are the least of a window of ``n`` words (rightmost of equals)."""
    k = gram_size(n, k)
    h = grams(w.hash, k)
    count = len(w.hash) - n + 1
    if count <= 0:
        return np.zeros(0, np.int64)
    best, at = h[:count].copy(), np.arange(count)
    for j in range(1, n - k + 1):
        less = h[j : j + count] <= best
        best[less] = h[j : j + count][less]
        at[less] = np.flatnonzero(less) + j
    text = w.text
    return np.unique(at[text[:count] == text[n - 1 : n - 1 + count]])


def _around(w: Words, at: np.ndarray, text: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """Word hashes at ``steps`` from each place, 0 outside the text."""
    places = at[:, None] + steps[None, :]
    inside = (places >= w.first[text][:, None]) & (places < w.first[text + 1][:, None])
    return np.where(inside, w.hash[np.clip(places, 0, len(w.hash) - 1)], 0).astype(np.int64)


def _anchors(w: Words, sizes: list[int], longest: int, k: int, bitmap=None, own=False) -> pa.Array:
    """For each text the list of its anchors. ``own``: windows of each text's own size only."""
    lengths = np.diff(w.first)
    parts = []
    for n in sizes:
        at = winnow(w, n, k)
        text = np.searchsorted(w.first, at, side="right") - 1
        h = grams(w.hash, gram_size(n, k))[at].view(np.int64)
        keep = np.ones(len(at), bool)
        if own:
            keep = np.minimum(lengths[text], longest) == n
        if bitmap is not None:
            bit = (h.view(np.uint64) >> np.uint64(64 - BITS)).astype(np.int64)
            keep &= (bitmap[bit >> 3] >> (bit & 7) & 1).astype(bool)
        at, text, h = at[keep], text[keep], h[keep]
        reach = n - gram_size(n, k)
        back = _around(w, at, text, -1 - np.arange(reach))
        ahead = _around(w, at, text, np.arange(n))
        parts.append((text, np.full(len(at), n), h, at - w.first[text], back, ahead))
    if not parts:
        none = np.zeros(0, np.int64)
        parts = [(none, none, none, none, none.reshape(0, 0), none.reshape(0, 1))]
    text = np.concatenate([p[0] for p in parts])
    order = np.argsort(text, kind="stable")

    def lists(i: int) -> pa.Array:
        flat = pa.array(np.concatenate([p[i].ravel() for p in parts]))
        ends = np.cumsum(np.concatenate([np.full(len(p[0]), p[i].shape[1]) for p in parts]))
        return pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), flat)

    struct = pa.StructArray.from_arrays(
        [
            pa.array(np.concatenate([p[1] for p in parts]), pa.int32()),
            pa.array(np.concatenate([p[2] for p in parts]), pa.int64()),
            pa.array(np.concatenate([p[3] for p in parts]), pa.int64()),
            lists(4),
            lists(5),
        ],
        ["n", "hash", "pos", "back", "ahead"],
    ).take(pa.array(order))
    offsets = np.searchsorted(text[order], np.arange(len(lengths) + 1))
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), struct)


def _scan(df: DataFrame, sizes, longest: int, k: int, bitmap=None, own=False) -> DataFrame:
    """From (key, text): key, text_hash, n_words and the anchors."""
    rows = df.select("key", F.xxhash64("text").alias("text_hash"), "text")

    def run(batches):
        bits = None if bitmap is None else np.frombuffer(bitmap.value, np.uint8)
        for batch in batches:
            for part in slices(batch, "text", 2 << 20):
                w = words(part.column("text"))
                found = _anchors(w, sizes, longest, k, bits, own)
                yield pa.RecordBatch.from_arrays(
                    [part.column("key"), part.column("text_hash"), pa.array(np.diff(w.first)), found],
                    ["key", "text_hash", "n_words", "anchors"],
                )

    more = f"text_hash bigint, n_words bigint, anchors {ANCHOR}"
    return map_batches(rows, run, fields(df, "key", more=more))


def _bitmap(anchors: DataFrame) -> bytes:
    """The benchmark's fingerprints by their first BITS bits; a row for each 4 KB that has any."""
    bit = F.shiftrightunsigned("hash", 64 - BITS) + 1  # bitmap positions count from 1
    parts = (
        anchors.select(bit.alias("bit"))
        .groupBy(F.bitmap_bucket_number("bit").alias("part"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits"))
        .collect()
    )
    out = bytearray((1 << BITS) // 8)
    for part, bits in parts:
        out[(part - 1) * 4096 : part * 4096] = bits
    return bytes(out)


def shared_spans(
    docs: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    n: int = 10,
    k: int = 5,
) -> DataFrame:
    """One row per document: ``key`` (under its own name), ``text_hash`` (xxhash64), ``n_words``, ``items``
    (sorted ids as strings) and ``spans`` (sorted, distinct runs of words, first and end) shared with items.

    Words are runs of digits, ASCII letters (in lower case) and characters above ASCII. A null text has no words, and an
    item without words matches nothing. An item shorter than ``n`` words must be repeated whole. A null item id reads
    as the empty id; repeated items count once. Rows equal in key and text have equal results; a null key is a
    key like any other. Empty tables give no spans, or no rows. Other columns are not read.
    """
    if not 1 <= k <= n:
        raise ValueError("k must be from 1 to n")
    spark = docs.sparkSession
    bench = materialise(
        _scan(
            items.select(
                F.coalesce(F.col(item_key).cast("string"), F.lit("")).alias("key"),
                F.col(item_text).alias("text"),
            ),
            list(range(1, n + 1)),
            n,
            k,
            own=True,
        )
        .select("key", F.explode("anchors").alias("a"))
        .select(F.col("key").alias("item"), "a.n", "a.hash", "a.back", "a.ahead")
        .distinct(),
        "benchmark-fingerprints",
        rows_and_files(items, item_text)[1],
    )
    sizes = sorted(r.n for r in bench.select("n").distinct().collect())  # n at the most
    bitmap = spark.sparkContext.broadcast(_bitmap(bench))
    plain = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    scanned = materialise(_scan(plain, sizes, n, k, bitmap), "document-fingerprints")

    def run_of(a: Column, b: Column) -> Column:
        """How many of the first words agree."""
        differ = F.array_position(F.zip_with(a, b, lambda x, y: (x == y) & (x != 0)), F.lit(False))
        return F.when(differ == 0, F.size(a)).otherwise(differ - 1)

    hits = (
        scanned.select("key", "text_hash", F.explode("anchors").alias("a"))
        .select("key", "text_hash", "a.*")
        .join(bench.withColumnsRenamed({"back": "item_back", "ahead": "item_ahead"}), ["n", "hash"])
        .withColumn("left", run_of(F.col("back"), F.col("item_back")))
        .withColumn("right", run_of(F.col("ahead"), F.col("item_ahead")))
        .filter(F.col("left") + F.col("right") >= F.col("n"))
        .select(
            "key",
            "text_hash",
            "item",
            F.struct(
                (F.col("pos") - F.col("left")).alias("start"),
                (F.col("pos") + F.col("right")).alias("end"),
            ).alias("span"),
        )
        .groupBy("key", "text_hash")
        .agg(
            F.sort_array(F.collect_set("item")).alias("items"),
            F.sort_array(F.collect_set("span")).alias("spans"),
        )
        .withColumnsRenamed({"key": "hit_key", "text_hash": "hit_hash"})
    )
    same = F.col("key").eqNullSafe(F.col("hit_key")) & (F.col("text_hash") == F.col("hit_hash"))
    return scanned.join(hits, same, "left").select(
        F.col("key").alias(key),
        "text_hash",
        "n_words",
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.coalesce("spans", F.array().cast("array<struct<start:bigint,end:bigint>>")).alias("spans"),
    )


def covered(spans: Column) -> Column:
    """Words in the union of sorted spans."""
    start = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("upto"))
    return F.aggregate(
        spans,
        start,
        lambda acc, s: F.struct(
            (acc["n"] + F.greatest(F.lit(0), s["end"] - F.greatest(acc["upto"], s["start"]))).alias("n"),
            F.greatest(acc["upto"], s["end"]).alias("upto"),
        ),
        lambda acc: acc["n"],
    )


def decontaminated(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` without those that share a span with an item; same columns. Nulls and repeated rows as above."""
    bad = shared_spans(docs, items, key, text, **options).filter(F.size("spans") > 0)
    bad = bad.select(F.col(key).alias("bad_key"), F.col("text_hash").alias("bad_hash"))
    same = F.col(f"docs.{key}").eqNullSafe(F.col("bad.bad_key")) & (
        F.xxhash64(f"docs.{text}") == F.col("bad.bad_hash")
    )
    return docs.alias("docs").join(bad.alias("bad"), same, "left_anti")
