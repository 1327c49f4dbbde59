"""Near-duplicates: improved consistent weighted sampling over TF-IDF shingles, banded and verified.

A document is the weighted set of its five-word shingles (a shorter one is a single shingle of all its words). A shingle
weighs its count in the document times its inverse document frequency, damped to lie between 1 - DAMP and 1, so that a
passage common to many documents counts less without making copies of a much-copied text look unlike. Document
frequencies are counted over all documents in a sketch of COUNTERS counters, a fixed size; what hashing adds to a counter
on average is taken off, and shingles rarer than the sketch can tell weigh 1.

Samples agree with the probability of the weighted Jaccard similarity (Ioffe 2010). BANDS bands of ROWS samples make the
buckets: a pair of similarity 0.8 meets in one with probability 0.998. Equal word sequences are one text from the start.
In each bucket all texts are compared with two leaders; connected components of the pairs that pass
become classes; then texts of different classes that share a bucket are compared as well, in blocks of a bounded size. All pairs
are verified by their weighted Jaccard similarity over both whole texts; of those with a leader, pairs whose samples agree far
too little are put aside first. Pairs are never listed inside a class nor in a block, so a group
of copies costs a few rows for each, and no link between classes that share a bucket is lost. Texts of a bucket's main class are dealt out once.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wardstream.llm.common import fields, fresh, hashable, map_batches, rows_and_files, ship, slices
from wardstream.llm.wordhash import Words, grams, mix, words
from wardstream.session import materialise

SHINGLE = 5
SIMILAR = 0.8
DAMP = 0.25
COUNTERS = 1 << 20
BANDS, ROWS = 20, 6
SAMPLES = BANDS * ROWS
#: A pair goes on to verification if this share of its samples agree: five standard deviations below SIMILAR.
AGREE = 0.62
#: Bytes of text in a block of a bucket.
BLOCK = 1 << 21
#: Draws of the sampling variables; a shingle's hash picks one for each sample.
_DRAWS = 1 << 16
_CHUNK = 1 << 12
_ODD = np.uint64(0x9E3779B97F4A7C15)

_rng = np.random.default_rng(20100101)
_R = _rng.gamma(2.0, 1.0, _DRAWS).astype(np.float32)
_LOG_C = np.log(_rng.gamma(2.0, 1.0, _DRAWS)).astype(np.float32)
_BETA = _rng.random(_DRAWS).astype(np.float32)
#: Logarithm of the value that is minimised, for weight 1.
_UNIT = _LOG_C + _R * (_BETA - 1)
_PICK = _rng.integers(1, 1 << 63, SAMPLES, dtype=np.uint64) | np.uint64(1)


def _shingles(w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, hash and count of each distinct shingle, in the order of the texts."""
    n = len(w.first) - 1
    doc = w.text
    h = grams(w.hash, SHINGLE)
    whole = doc[: len(h)] == doc[SHINGLE - 1 : SHINGLE - 1 + len(h)]
    text, value = doc[: len(h)][whole], h[whole]
    size = np.diff(w.first)
    short = np.flatnonzero((size > 0) & (size < SHINGLE))
    if len(short):
        text = np.append(text, short)
        value = np.append(value, _sequence(w, _ODD)[short])
    order = np.lexsort((value, text))
    text, value = text[order], value[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (value[1:] != value[:-1])
    at = np.flatnonzero(new)
    return text[at], value[at], np.diff(np.append(at, len(text)))


def _sequence(w: Words, base: np.uint64) -> np.ndarray:
    """A hash of each text's whole word sequence."""
    n = len(w.hash)
    place = np.arange(n) - w.first[w.text] if n else np.zeros(0, np.int64)
    part = mix(w.hash * base + (place.astype(np.uint64) + np.uint64(1)) * mix(np.array([base]))[0])
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(part)])
    return mix(total[w.first[1:]] - total[w.first[:-1]] + np.diff(w.first).astype(np.uint64))


def _counter(value: np.ndarray) -> np.ndarray:
    return (value >> np.uint64(64 - 20)).astype(np.int64)


def frequencies(docs: DataFrame, text: str) -> np.ndarray:
    """Document frequencies of shingles by counter, over all documents."""

    def count(batches):
        counts = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            for part in slices(batch, text, 1 << 20):
                counts += np.bincount(_counter(_shingles(words(part.column(text)))[1]), minlength=COUNTERS)
        for at in range(0, COUNTERS, _CHUNK):
            piece = counts[at : at + _CHUNK]
            if piece.any():
                yield _piece(at, piece)

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for at, raw in zip(*batch.to_pydict().values(), strict=True):
                sums[at] = sums.get(at, 0) + np.frombuffer(raw, np.int64)
        for at, piece in sums.items():
            yield _piece(at, piece)

    def _piece(at: int, piece: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([at], pa.int32()), pa.array([piece.tobytes()], pa.binary())], ["at", "counts"]
        )

    schema = "at int, counts binary"
    parts = map_batches(docs.select(text), count, schema).repartition("at")
    parts = map_batches(parts, add, schema)
    out = np.zeros(COUNTERS, np.int64)
    for at, raw in parts.collect():  # COUNTERS numbers at the most
        out[at : at + _CHUNK] = np.frombuffer(raw, np.int64)
    return out


def weights(counts: np.ndarray, n_docs: int) -> np.ndarray:
    """The weight of a shingle by its counter."""
    mean = counts.sum() / COUNTERS
    floor = max(1.0, 2 * np.sqrt(mean))
    df = np.maximum(counts - mean, floor)
    rarest = np.log1p(n_docs / floor)
    return (1 - DAMP + DAMP * np.log1p(n_docs / df) / rarest).astype(np.float32)


def _samples(text: np.ndarray, value: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
    """The samples of each text, one row a text; a row of a text without shingles means nothing."""
    out = np.zeros((n, SAMPLES), np.uint64)
    if not len(text):
        return out
    starts = np.flatnonzero(np.append(True, text[1:] != text[:-1]))
    owner = np.cumsum(np.append(True, text[1:] != text[:-1])) - 1
    spread = mix(value)
    odd = np.flatnonzero(weight != 1)
    log_w = np.log(weight[odd])
    for s in range(SAMPLES):
        pick = ((spread * _PICK[s]) >> np.uint64(48)).astype(np.int64)
        log_a = _UNIT[pick]
        p = pick[odd]
        t = np.floor(log_w / _R[p] + _BETA[p])
        log_a[odd] = _LOG_C[p] - _R[p] * (t - _BETA[p] + 1)
        least = np.minimum.reduceat(log_a, starts)
        at = np.flatnonzero(log_a == least[owner])
        at = at[np.append(True, owner[at[1:]] != owner[at[:-1]])]
        step = np.zeros(len(value), np.float32)
        step[odd] = t
        # A sample is the shingle and the step of its weight.
        sample = spread[at] + step[at].astype(np.int64).view(np.uint64) * _ODD
        out[text[starts], s] = mix(sample * _PICK[s])
    return out


def _sign(rows: DataFrame, table) -> DataFrame:
    """From (key, h1, h2, text): h1, h2, key, n_words, the sequence s1, s2, bands and samples (32 bits)."""

    def run(batches):
        weight = np.frombuffer(table.value, np.float32)
        for batch in batches:
            for part in slices(batch, "text", 1 << 18):
                w = words(part.column("text"))
                n = part.num_rows
                text, value, count = _shingles(w)
                samples = _samples(text, value, weight[_counter(value)] * count.astype(np.float32), n)
                bands = np.zeros((n, BANDS), np.uint64)
                for j in range(ROWS):
                    bands = mix(bands * _ODD + samples[:, j::ROWS])
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("key"),
                        part.column("h1"),
                        part.column("h2"),
                        pa.array(np.diff(w.first)),
                        pa.array(_sequence(w, np.uint64(0xD6E8FEB86659FD93)).view(np.int64)),
                        pa.array(_sequence(w, np.uint64(0xA0761D6478BD642F)).view(np.int64)),
                        _lists(bands.view(np.int64), pa.int64()),
                        _lists((samples & np.uint64(0x7FFFFFFF)).astype(np.int32), pa.int32()),
                    ],
                    ["key", "h1", "h2", "n_words", "s1", "s2", "bands", "samples"],
                )

    return map_batches(
        rows,
        run,
        fields(
            rows,
            "key",
            more="h1 bigint, h2 bigint, n_words bigint, s1 bigint, s2 bigint, "
            "bands array<bigint>, samples array<int>",
        ),
    )


def _lists(matrix: np.ndarray, kind: pa.DataType) -> pa.Array:
    n, width = matrix.shape
    return pa.ListArray.from_arrays(
        pa.array(np.arange(n + 1) * width, pa.int32()), pa.array(matrix.ravel(), kind)
    )


def weighted_jaccard(a: pa.Array, b: pa.Array, weight: np.ndarray) -> np.ndarray:
    """Similarity of each text of ``a`` and the one beside it in ``b``."""
    pair, value, count = zip(*(_shingles(words(x)) for x in (a, b)), strict=True)
    pairs, values = np.concatenate(pair), np.concatenate(value)
    key = mix(values + pairs.astype(np.uint64) * _ODD)
    _, one, where = np.unique(key, return_index=True, return_inverse=True)
    n = len(count[0])
    left = np.bincount(where[:n], count[0], len(one))
    right = np.bincount(where[n:], count[1], len(one))
    w = weight[_counter(values[one])].astype(np.float64)
    shared = np.bincount(pairs[one], w * np.minimum(left, right), len(a))
    total = np.bincount(pairs[one], w * np.maximum(left, right), len(a))
    return np.divide(shared, total, out=np.zeros(len(a)), where=total > 0)


def _id(name: str, start: str = "s") -> Column:
    return F.struct(F.col(f"{start}1").alias("s1"), F.col(f"{start}2").alias("s2")).alias(name)


def _verified(pairs: DataFrame, signed: DataFrame, texts: DataFrame, table, similar: float) -> DataFrame:
    """The pairs (a, b) whose similarity is enough."""

    def side(of: DataFrame, name: str, column: str) -> DataFrame:
        return of.select(F.col("id").alias(name), F.col(column).alias(f"{name}_{column}"))

    agreeing = F.size(
        F.filter(F.zip_with("a_samples", "b_samples", lambda x, y: x == y), lambda x: x)
    )
    near = (
        pairs.join(side(signed, "a", "samples"), "a")
        .join(side(signed, "b", "samples"), "b")
        .filter(agreeing >= AGREE * SAMPLES)
        .select("a", "b")
    )
    both = near.join(side(texts, "a", "text"), "a").join(side(texts, "b", "text"), "b")

    def run(batches):
        weight = np.frombuffer(table.value, np.float32)
        for batch in batches:
            sizes = pa.compute.add(
                pa.compute.binary_length(batch.column("a_text")),
                pa.compute.binary_length(batch.column("b_text")),
            )
            for part in slices(batch, sizes, 1 << 20):
                found = weighted_jaccard(part.column("a_text"), part.column("b_text"), weight)
                keep = pa.array(found >= similar)
                yield part.select(["a", "b"]).filter(keep)

    ids = "struct<s1:bigint,s2:bigint>"
    return map_batches(both.select("a", "b", "a_text", "b_text"), run, f"a {ids}, b {ids}")


def _linked(
    roots: list, texts: pa.Array, weight: np.ndarray, similar: float, most: np.ndarray | None = None
) -> list[tuple[int, int]]:
    """Pairs of places, enough to join what is similar among texts that have ``roots`` for classes.

    All texts but those of the commonest class are compared with all others, by an index of shingles;
    a pair inside a class, or inside what has been joined, needs no comparison. ``most`` tells which texts are of the
    commonest class, if it is known; then the others are compared with these alone.
    """
    names = {r: i for i, r in enumerate(dict.fromkeys(roots))}
    of = np.array([names[r] for r in roots])
    main = np.bincount(of).argmax() if most is None or not most.any() else of[most.argmax()]
    if most is not None and (not most.any() or most.all()):
        return []
    other = np.ones(len(of), bool) if most is None else most
    text, value, count = _shingles(words(texts))
    mass = weight[_counter(value)].astype(np.float64)
    n = len(of)
    total = np.bincount(text, mass * count, n)
    order = np.argsort(value, kind="stable")
    ranked, owner, times = value[order], text[order], count[order]
    first = np.searchsorted(text, np.arange(n + 1))
    out = []
    for u in np.flatnonzero(of != main):
        own = slice(first[u], first[u + 1])
        low = np.searchsorted(ranked, value[own], side="left")
        high = np.searchsorted(ranked, value[own], side="right")
        size = high - low
        at = np.repeat(low - np.cumsum(size) + size, size) + np.arange(size.sum())
        least = np.minimum(times[at], np.repeat(count[own], size)) * np.repeat(mass[own], size)
        shared = np.bincount(owner[at], least, n)
        for v in np.flatnonzero((shared >= similar * (total[u] + total - shared)) & other):
            if of[v] != of[u]:
                out.append((int(u), int(v)))
                # The joined class takes the name of one side; the main class keeps its own.
                gone, stays = (of[u], of[v]) if of[v] == main else (of[v], of[u])
                of[of == gone] = stays
    return out


def _compared(rest: DataFrame, texts: DataFrame, table, similar: float, files: int | None = None) -> DataFrame:
    """Links between texts of different classes (``root``) that share a bucket.

    The class with most text in a bucket is its main one, and members of it need no comparison with each other. So main texts and
    others are cut into blocks of about BLOCK bytes; a group is a block of either, or two blocks of others, and a bucket that is no
    more than a block of each is one group. Others that fit one block are sent to each block of main texts, which go out once: what is dealt
    is at most three times what is held. A group sends no more links than it has texts.
    """
    ship(rest.sparkSession)
    sizes = texts.select("id", F.octet_length("text").alias("size"))
    sized = rest.join(sizes, "id").groupBy("bucket", "root").agg(F.sum("size").alias("size"))
    most = F.max(F.struct("size", "root"))
    blocks = materialise(
        sized.groupBy("bucket").agg(most.alias("most"), F.sum("size").alias("size")).select(
            "bucket",
            F.col("most.root").alias("main"),
            F.greatest(F.ceil(F.col("most.size") / BLOCK), F.lit(1)).cast("int").alias("n_main"),
            F.greatest(F.ceil((F.col("size") - F.col("most.size")) / BLOCK), F.lit(1)).cast("int").alias("n_other"),
        ),
        "blocks",
        files,
    )
    groups = _groups(rest.join(blocks, "bucket"))
    dealt = groups.join(texts, "id").select("bucket", "kind", "x", "y", "id", "root", "in_main", "text")

    def compare(group: pa.Table) -> pa.Table:
        weight = np.frombuffer(table.value, np.float32)
        group = group.combine_chunks()
        roots = [(r["s1"], r["s2"]) for r in group["root"].to_pylist()]
        column = group["text"].combine_chunks()
        across = group["kind"][0].as_py() == _ACROSS
        main = group["in_main"].to_numpy(zero_copy_only=False) if across else None
        pairs = _linked(roots, column, weight, similar, main)
        ids = group["id"].combine_chunks()
        a, b = (pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1))
        return pa.table({"a": ids.take(a), "b": ids.take(b)})

    ids = "struct<s1:bigint,s2:bigint>"
    return dealt.groupBy("bucket", "kind", "x", "y").applyInArrow(compare, f"a {ids}, b {ids}")


#: Kinds of groups: all of a bucket; a block of main texts and one of others; two blocks of others.
_ALL, _ACROSS, _OTHERS = 0, 1, 2


def _groups(placed: DataFrame) -> DataFrame:
    """The groups (``kind``, ``x``, ``y``) that each text of a bucket goes to, and whether it is ``in_main``."""
    own = F.xxhash64("id")
    x, y = F.pmod(own, "n_main").cast("int"), F.pmod(own, "n_other").cast("int")

    def group(kind: int, a: Column, b: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), a.alias("x"), b.alias("y"))

    upto_main, upto_other = (F.sequence(F.lit(0), F.col(n) - 1) for n in ("n_main", "n_other"))
    zero = F.lit(0)
    whole = (F.col("n_main") == 1) & (F.col("n_other") == 1)
    # Others of one block are compared with each other in one group of their own.
    among = F.transform(upto_other, lambda j: group(_OTHERS, F.least("own", j), F.greatest("own", j)))
    of_other = F.concat(F.transform(upto_main, lambda i: group(_ACROSS, i, F.col("own"))), among)
    of_main = F.transform(upto_other, lambda j: group(_ACROSS, F.col("own"), j))
    in_main = F.col("root") == F.col("main")
    found = placed.withColumn("in_main", in_main).withColumn("own", F.when(in_main, x).otherwise(y))
    dealt = F.when(whole, F.array(group(_ALL, zero, zero))).when(F.col("in_main"), of_main).otherwise(of_other)
    return found.select("bucket", "id", "root", "in_main", F.explode(dealt).alias("g")).select(
        "bucket", "id", "root", "in_main", "g.kind", "g.x", "g.y"
    )


def components(edges: DataFrame, files: int | None = None) -> DataFrame:
    """The least node (``root``) that each node of the edges (a, b) hangs together with, but for roots themselves.

    Alternating large and small stars (Kiveris et al. 2014): nodes move to the least neighbour they know, until nothing
    changes. Minima are taken before the shuffle; each step is a stored table, in ``files`` files at the most.
    """

    def stored(pairs: DataFrame) -> tuple[DataFrame, tuple]:
        table = materialise(pairs.filter("a != b").distinct(), "edges", files)
        return table, table.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    # From the greater node to the less, as the steps leave them: finished edges are found to be so in one step.
    edges, before = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")))
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # A hub meets the same least node once for each neighbour: doubles go before they meet at the hub.
        large = large.filter("a != b").distinct()
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        low = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(
            low.select("a", F.col("m").alias("b"))
        )
        edges, state = stored(small)
        if state == before:
            return edges.select(F.col("a").alias("id"), F.col("b").alias("root"))
        before = state


def classes(
    docs: DataFrame, key: str = "doc_id", text: str = "text", similar: float = SIMILAR
) -> DataFrame:
    """One row per document: ``key``, ``h1``, ``h2`` (hashes of key and text), ``n_words``, ``class_id`` (the least key of its
    class), ``first1``, ``first2`` (hashes of that document) and ``class_size``.

    Words are as in decontamination: digits, ASCII letters in lower case, characters above ASCII. Documents without words (null, empty, marks only)
    are each a class of their own; those of equal words are one class whatever their marks. Rows equal in key and
    text are copies. A null key is the least. An empty table gives no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    rows = rows.select(
        "key", F.xxhash64("key", "text").alias("h1"), F.xxhash64(F.lit(11), "key", "text").alias("h2"), "text"
    )
    n, files = rows_and_files(rows, "text")
    table = spark.sparkContext.broadcast(weights(frequencies(rows, "text"), max(1, n)).tobytes())
    signed = materialise(_sign(rows, table), "signed", files)
    unique = materialise(
        signed.filter("n_words > 0")
        .groupBy(_id("id"))
        .agg(
            F.min(F.struct("h1", "h2")).alias("doc"),
            F.any_value("bands").alias("bands"),
            F.any_value("samples").alias("samples"),
        ),
        "texts",
        files,
    )
    spread = unique.select("id", F.posexplode("bands").alias("band", "value")).select(
        F.xxhash64("band", "value").alias("bucket"), "id"
    )
    # Two leaders a bucket, other ones in each bucket.
    rank = F.struct(F.xxhash64("bucket", "id").alias("r"), "id")
    # Stored, as are other sides of joins that are summed up by the join's own key: so the join
    # deals out both sides itself and can split a bucket or class of many texts.
    leaders = materialise(
        spread.groupBy("bucket")
        .agg(F.min(rank)["id"].alias("lead"), F.max(rank)["id"].alias("other"))
        .filter("lead != other"),
        "leaders",
        files,
    )
    members = materialise(spread.join(leaders, "bucket"), "buckets", files)
    wanted = unique.join(members.select("id").distinct(), "id", "left_semi")
    texts = materialise(
        rows.join(wanted.select("id", "doc.h1", "doc.h2"), ["h1", "h2"])
        .select("id", "text")
        .dropDuplicates(["id"]),
        "candidates",
        files,
    )

    def ordered(pairs: DataFrame) -> DataFrame:
        return (
            pairs.filter("a != b")
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
            .distinct()
        )

    stars = members.select(F.explode(F.array("lead", "other")).alias("a"), F.col("id").alias("b"))
    links = materialise(_verified(ordered(stars), unique, texts, table, similar), "links", files)
    roots = components(links, files)
    # What is left: texts of different classes that share a bucket.
    placed = members.join(roots, "id", "left").select(
        "bucket", "id", F.coalesce("root", "id").alias("root")
    )
    mixed = placed.groupBy("bucket").agg(F.min("root").alias("x"), F.max("root").alias("y"))
    mixed = materialise(mixed.filter("x != y").select("bucket"), "mixed", files)
    rest = materialise(placed.join(mixed, "bucket", "left_semi"), "rest", files)
    more = materialise(_compared(rest, texts, table, similar, files), "links", files)
    # The classes so far stand for the links they were made of.
    roots = components(roots.select(F.col("id").alias("a"), F.col("root").alias("b")).unionByName(more), files)

    worded = F.col("n_words") > 0
    joined = materialise(
        signed.select("key", "h1", "h2", "n_words", _id("id"))
        .join(roots, "id", "left")
        .withColumn("root", F.when(worded, F.coalesce("root", "id")).otherwise(_id("root", "h")))
        .withColumn("worded", worded)
        .drop("id"),
        "placed",
        files,
    )
    heads = materialise(
        joined.groupBy("root", "worded").agg(
            F.min(F.struct("key", "h1", "h2")).alias("head"), F.count("*").alias("class_size")
        ),
        "heads",
        files,
    )
    return joined.join(heads, ["root", "worded"]).select(
        F.col("key").alias(key),
        "h1",
        "h2",
        "n_words",
        F.col("head.key").alias("class_id"),
        F.col("head.h1").alias("first1"),
        F.col("head.h2").alias("first2"),
        "class_size",
    )


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", similar: float = SIMILAR) -> DataFrame:
    """``docs`` with one document of each class, that of the least key; same columns.

    Of rows equal in key and text one stays, the least by a hash of all columns. Nulls as in ``classes``.
    """
    h1, h2, order, n = fresh(docs, "h1", "h2", "order", "n")
    heads = (
        classes(docs, key, text, similar)
        .filter("h1 = first1 AND h2 = first2")
        .select(F.col("h1").alias(h1), F.col("h2").alias(h2))
        .distinct()
    )
    hashed = docs.withColumns(
        {
            h1: F.xxhash64(key, F.col(text).cast("string")),
            h2: F.xxhash64(F.lit(11), key, F.col(text).cast("string")),
            order: F.xxhash64(*hashable(docs)),
        }
    )
    place = F.row_number().over(Window.partitionBy(h1, h2).orderBy(order))
    return hashed.join(heads, [h1, h2]).withColumn(n, place).filter(F.col(n) == 1).select(docs.columns)
