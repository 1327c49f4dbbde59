"""Operators 11 to 13 against the tokenizers' libraries, brute force and plain replays, and their edge cases."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wardstream.llm import align, prefix_bpe, resample
from wardstream.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
ODD = "ab é世 \n\t'srvlm,.-!1▁<\x00\x1c\x85  😀՘\U0003d000\U00011de0Ᲊ"


def odd_texts(n, size=30, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice(ODD) for _ in range(rng.randrange(size))) for _ in range(n)]


@pytest.fixture(scope="module")
def docs(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


# 11. Byte-level BPE.


@pytest.fixture(scope="module")
def bpe():
    return prefix_bpe.PrefixBpe(prefix_bpe.read_ranks(Path(prefix_bpe.RANKS).read_bytes()))


@pytest.fixture(scope="module")
def library(bpe):
    import public_tokenizers
    import tiktoken

    assert prefix_bpe.PATTERN == public_tokenizers.PATTERN
    return tiktoken.Encoding("own", pat_str=prefix_bpe.PATTERN, mergeable_ranks=bpe.rank, special_tokens={})


def test_op11_ids_of_the_library(spark, docs, library):
    got = {r.doc_id: r for r in QUERIES["op11_prefix_bpe"](spark, SF).collect()}
    assert set(got) == set(docs)
    for i, text in docs.items():
        ids = library.encode_ordinary(text or "")
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()


def test_bpe_of_odd_texts(bpe, library):
    texts = [*odd_texts(3000), "x" * 5000, "ab" * 3000 + " " * 700 + "\n" * 300, "世" * 2000]
    ids, offsets = bpe.encode_column(pa.array(texts))
    for i, text in enumerate(texts):
        assert ids[offsets[i] : offsets[i + 1]].tolist() == library.encode_ordinary(text) == bpe.encode(text)


def test_bpe_splits_every_character_as_the_library(bpe):
    """A character joins a letter, a number or another sign exactly if the library puts both into one match."""
    import tiktoken

    single = {bytes([i]): i for i in range(256)}
    every = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for lead in "a1!":
        ranks = single | {lead.encode() + bytes([x]): 256 + x for x in range(256)}
        theirs = tiktoken.Encoding("probe", pat_str=prefix_bpe.PATTERN, mergeable_ranks=ranks, special_tokens={})
        for c in every[:: 1 if lead == "a" else 7]:
            text = lead + chr(c)
            one = len(theirs.encode_ordinary(text)) < 1 + len(chr(c).encode())
            assert one == (sum(map(len, bpe.matches(text))) == 1), hex(c)


@settings(max_examples=200, deadline=None)
@given(st.data())
def test_prefix_tables_of_any_vocabulary(data):
    """Random tokens in random order of rank, some of which merging never makes."""
    words = data.draw(st.lists(st.binary(min_size=2, max_size=5).map(lambda b: bytes(97 + x % 3 for x in b)), max_size=25, unique=True))
    ranks = {bytes([i]): i for i in range(256)} | {w: 256 + i for i, w in enumerate(words)}
    bpe = prefix_bpe.PrefixBpe(ranks)
    text = data.draw(st.text("abc", max_size=40)).encode()
    table = prefix_bpe.PrefixTable(bpe, text)
    assert table.ids() == bpe.merged(text)
    for end in range(1, len(text) + 1):
        assert bpe.row(table.last[:end]) == bpe.merged(text[:end])
    more = data.draw(st.text("abc", max_size=10)).encode()
    table.append(more)
    assert table.ids() == bpe.merged(text + more)
    a = data.draw(st.integers(0, len(table.data)))
    b = data.draw(st.integers(a, len(table.data)))
    was = table.data
    table.replace(a, b, more)
    assert table.data == was[:a] + more + was[b:] and table.ids() == bpe.merged(table.data)


def test_an_edit_is_computed_near_its_place(bpe):
    rng = random.Random(2)
    text = "".join(rng.choice("abcdefgh") for _ in range(20_000)).encode()
    table = prefix_bpe.PrefixTable(bpe, text)
    assert table.replace(10_000, 10_003, b"zz") < 500
    assert table.ids() == prefix_bpe.PrefixTable(bpe, table.data).ids()


def test_bpe_revise(spark, bpe, library):
    rng, rows = random.Random(4), []
    for text, new in zip(odd_texts(600, 60), odd_texts(600, 6, 9), strict=True):
        a = rng.randrange(len(text) + 1)
        rows.append((text, library.encode_ordinary(text), a, rng.randrange(a, len(text) + 1), new))
    rows += [(None, None, 3, None, "new"), ("a b", library.encode_ordinary("a b"), None, None, "c d"), ("", [], -5, 99, None)]
    long = "word " * 50_000
    rows.append((long, library.encode_ordinary(long), 125_001, 125_003, "X"))
    df = spark.createDataFrame(rows, "text string, ids array<int>, start int, stop int, new string")
    for r in prefix_bpe.revise(df).collect():
        assert r.ids == library.encode_ordinary(r.text)
    one = prefix_bpe.revise(df.filter("text = 'a b'")).first()
    assert one.text == "a bc d"
    with pytest.raises(ValueError, match="not those of the text"):
        bpe.revise("one two three", [1, 2], 9, 9, "x")


def test_bpe_edges(spark, library):
    df = spark.createDataFrame(
        [(1, None, "x"), (1, None, "x"), (None, "", None), (2, "a b", None)], "doc_id long, text string, IDS string"
    )
    with_ids = prefix_bpe.encode(df, ids="tokens")
    assert with_ids.columns == [*df.columns, "tokens"]
    assert sorted(len(r.tokens) for r in with_ids.collect()) == [0, 0, 0, 2]
    replaced = prefix_bpe.encode(df)
    assert replaced.columns == ["doc_id", "text", "ids"]
    for packed in (False, True):
        back = prefix_bpe.decode(prefix_bpe.encode(df, ids="tokens", packed=packed), "tokens")
        assert sorted(bytes(r.decoded) for r in back.collect()) == [b"", b"", b"", b"a b"]
    none = spark.createDataFrame([(None,), ([],)], "ids array<int>")
    assert [r.decoded for r in prefix_bpe.decode(none).collect()] == [None, bytearray()]
    assert prefix_bpe.encode(df.limit(0)).count() == 0
    long = spark.createDataFrame([("palabra " * 300_000 + "z" * 200_000,)], "text string")
    got = prefix_bpe.encode(long).first()
    assert got.ids == library.encode_ordinary(got.text)


# 12. Alignment.


@pytest.fixture(scope="module")
def sides():
    a, b = Path(align.BYTE_LEVEL).read_bytes(), Path(align.PIECES).read_bytes()
    return align.ByteLevel(a), align.Pieces(b)


def aligned(sides, text):
    """Ids, groups and linked pairs, byte by byte."""
    if not text:
        return [], [], [], []
    ids = [side.encode([text])[0] for side in sides]
    owner = [[n for n, i in enumerate(row) for _ in side.spelled[i]] for side, row in zip(sides, ids, strict=True)]
    for side, row in zip(sides, ids, strict=True):
        if b"".join(side.spelled[i] for i in row) != f" {text}".encode():
            return [], [], [], []
    pairs = list(dict.fromkeys(zip(*owner, strict=True)))
    groups, last = [], (-1, -1)
    for k, (x, y) in enumerate(zip(*owner, strict=True)):
        after = (owner[0][k + 1], owner[1][k + 1]) if k + 1 < len(owner[0]) else (x + 1, y + 1)
        if after[0] > x and after[1] > y:
            groups.append((ids[0][last[0] + 1 : x + 1], ids[1][last[1] + 1 : y + 1]))
            last = (x, y)
    return *ids, groups, [(ids[0][x], ids[1][y]) for x, y in pairs]


def spelled(groups):
    return ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)


def corpus_columns(found):
    """What the query has to return, from the alignments of all documents."""
    count = Counter(p for *_, links in found.values() for p in set(links))
    most = defaultdict(int)
    for (a, _), n in count.items():
        most[a] = max(most[a], n)
    out = {}
    for i, (a, b, groups, links) in found.items():
        best = sum(count[p] == most[p[0]] for p in links)
        digest = hashlib.sha256(spelled(groups).encode()).hexdigest() if groups else ""
        out[i] = (len(a), len(b), len(groups), len(links), best, sum(count[p] for p in links), digest)
    return out, count


def columns_of(df):
    names = "n_a n_b n_groups n_links n_best count_sum groups_sha256".split()
    return {r.doc_id: tuple(r[n] for n in names) for r in df.collect()}


def test_op12_against_bytes(spark, docs, sides):
    want, _ = corpus_columns({i: aligned(sides, text) for i, text in docs.items()})
    assert columns_of(QUERIES["op12_diagonal_runs"](spark, SF)) == want


def test_alignment_of_odd_texts_over_blocks(spark, sides, monkeypatch):
    monkeypatch.setattr(align, "BLOCK", 600)
    monkeypatch.setattr(align, "PART", 200)
    monkeypatch.setattr(align, "REMEMBERED", 40)
    monkeypatch.setattr(align, "WINDOW", 7)
    texts = [*odd_texts(800, 25), None, "", "▁", "a ▁b", "<s> </s> <|endoftext|> <0x41>", "a b", "a b"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    want, count = corpus_columns({i: aligned(sides, text) for i, text in enumerate(texts)})
    found, pairs = align.linked(df)
    assert columns_of(found) == want
    assert {(r.a, r.b): r.documents for r in pairs.collect()} == count
    for r in align.align(df.filter("doc_id < 100")).collect():
        a, b, groups, _ = aligned(sides, r.text)
        x = r.alignment
        assert (x.a, x.b) == (a, b)
        starts = zip([0, *x.ends_a], x.ends_a, [0, *x.ends_b], x.ends_b, strict=False)
        assert [(a[p:q], b[s:t]) for p, q, s, t in starts] == groups


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 3), min_size=1, max_size=60), st.lists(st.integers(1, 3), min_size=1, max_size=60))
def test_runs_and_groups_of_any_ends(x, y):
    a, b = np.cumsum(x).tolist(), np.cumsum(y).tolist()
    end = max(a[-1], b[-1])
    a, b = ([*e, end] if e[-1] < end else e for e in (a, b))
    runs, group_a, group_b = align.group_starts(a, b)
    starts = sorted([(i + k, j + k) for i, j, n in runs for k in range(n)] + list(zip(group_a, group_b, strict=True)))
    cuts = sorted(set(a) & set(b))
    assert starts == [(0, 0)] + [(a.index(c) + 1, b.index(c) + 1) for c in cuts[:-1]]
    for one, two in zip(runs, runs[1:], strict=False):
        assert one[0] + one[2] < two[0]
    ga, gb = (np.array([*x, n]) for x, n in zip(zip(*starts, strict=True), (len(a), len(b)), strict=True))
    links = sorted(zip(*(x.tolist() for x in align.overlaps(np.array(a), np.array(b), ga, gb)), strict=True))
    owner = [[n for n, (s, t) in enumerate(zip([0, *e], e, strict=False)) for _ in range(t - s)] for e in (a, b)]
    assert links == sorted(set(zip(*owner, strict=True)))


def test_alignment_edges(spark, sides):
    df = spark.createDataFrame(
        [(None, "one two", 5, "x"), (None, "one two", 5, "x"), (3, None, None, None)], "doc_id long, text string, N_A int, block string"
    )
    found, pairs = align.linked(df)
    assert set(found.columns) == {"doc_id", "block", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"}
    got = sorted(((r.doc_id, r.block, r.n_a, r.count_sum) for r in found.collect()), key=repr)
    a, *_, links = aligned(sides, "one two")
    assert got == [(3, None, 0, 0), (None, "x", len(a), 2 * len(links)), (None, "x", len(a), 2 * len(links))]
    assert {r.documents for r in pairs.collect()} == {2}
    found, pairs = align.linked(df.limit(0))
    assert found.count() == pairs.count() == 0
    long = spark.createDataFrame([(1, "uno dos " * 200_000 + "é" * 300_000)], "doc_id long, text string")
    r = align.linked(long)[0].first()
    a, b = (side.encode([long.first().text])[0] for side in sides)
    assert (r.n_a, r.n_b, r.n_links) == (len(a), len(b), len(a) + len(b) - r.n_groups)


# 13. Resampling.


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def test_features_of_odd_texts():
    texts = [*odd_texts(500, 60, 3), None, "", "B" * 100 + " " + "é" * 40 + " x", "a"]
    bucket, of, n_words = resample.features(pa.array(texts), 3)
    for i, text in enumerate(texts):
        w = plain_words(text)
        runs = [" ".join(w[p : p + n]) for n in (1, 2, 3) for p in range(len(w) - n + 1)]
        assert sorted(bucket[of == i].tolist()) == sorted(zlib.crc32(x.encode()) % 10000 for x in runs)
        assert n_words[i] == len(w)


def scores(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, score long, able boolean, down string")


def places(rows, percent):
    able = sorted((-s, i is not None, i or 0) for i, s, ok, _ in rows if ok)
    return able[: len(able) * percent // 100]


@pytest.mark.parametrize("accuracy", [10000, 3])
@pytest.mark.parametrize("percent", [0, 1, 25, 99, 100])
def test_draw_of_ties_and_repeated_rows(spark, accuracy, percent):
    rng = random.Random(percent)
    rows = [(i, rng.choice([5, 5, 5, rng.randrange(-50, 50)]), rng.random() < 0.9, "d") for i in range(700)]
    rows += [(7, 5, True, "d")] * 40 + [(None, 5, True, "d")] * 3 + [(9999, 1, None, "d")]
    drawn = resample.draw(scores(spark, rows), percent, among="able", accuracy=accuracy)
    assert drawn.columns == ["doc_id", "score", "able", "down", "rank"]
    got = drawn.collect()
    assert len(got) == len(rows)
    in_order = sorted((r.rank, -r.score, r.doc_id is not None, r.doc_id or 0) for r in got if r.rank is not None)
    want = places(rows, percent)
    assert [r[0] for r in in_order] == list(range(1, len(want) + 1))
    assert [r[1:] for r in in_order] == want


def test_a_bracket_that_misses_is_widened(spark, monkeypatch):
    rows = [(i, i, True, "") for i in range(1000)]
    calls = []
    found = F.percentile_approx

    def off(column, ends, accuracy):
        calls.append(ends)
        # The sketch names the lowest scores until the bracket is wide.
        return found(column, [0.0, 0.01] if len(calls) < 3 else ends, accuracy)

    monkeypatch.setattr(resample.F, "percentile_approx", off)
    drawn = resample.draw(scores(spark, rows), 25, among="able")
    assert {r.doc_id: r.rank for r in drawn.filter("rank IS NOT NULL").collect()} == {999 - k: k + 1 for k in range(250)}
    assert len(calls) >= 3


def test_resample_edges(spark):
    said = " ".join(f"w{i}" for i in range(30))
    rows = [(1, said, "a"), (1, said, "a"), (None, said, None), (2, None, None), (3, "", None), (4, "few words", "b")]
    df = spark.createDataFrame(rows, "doc_id long, text string, SCORE string")
    items = spark.createDataFrame([(1, said), (2, None)], "item_id long, text string")
    got = resample.resample(df, items, percent=100)
    assert got.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    by = defaultdict(list)
    for r in got.collect():
        by[r.doc_id].append(r)
    assert sorted(r.rank for r in by[1] + by[None]) == [1, 2, 3]
    assert [(by[i][0].n_features, by[i][0].weight, by[i][0].rank) for i in (2, 3)] == [(0, 0, None)] * 2
    assert by[4][0].n_features == 3 and by[4][0].rank is None
    assert resample.resample(df.limit(0), items).count() == 0
    assert resample.resample(df, items.limit(0)).count() == 6
    long = spark.createDataFrame([(1, "x" * 1_000_000 + " " + "y " * 500_000)], "doc_id long, text string")
    assert resample.resample(long, items, percent=100).first().n_features == 500_001 + 500_000
