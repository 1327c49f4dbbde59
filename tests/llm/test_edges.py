"""Nulls in any column, empty and very long texts, ties and repeated rows, empty tables, clashing names."""

import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wardstream.llm import (
    chat,
    decontaminate,
    fertility,
    line_dedup,
    main_text,
    near_dup,
    piece_fst,
    secrets,
    sharding,
    zip_warc,
)
from wardstream.llm.wordhash import SOLID, words
from wardstream.session import scratch_dir

DOCS = "doc_id long, text string, source string"


def frame(spark, rows, schema=DOCS):
    return spark.createDataFrame(rows, schema)


def sentence(i, n=40):
    return " ".join(f"w{i}x{j}" for j in range(n))


# Words.


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=40)), max_size=8))
def test_words_are_those_of_the_pattern(texts):
    for inside, lower, pattern in ((None, True, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"), (SOLID, False, r"[^\x20\x09-\x0D]+")):
        texts = [t if t is None else t.encode("utf-8", "ignore").decode() for t in texts]
        column = pa.array(texts, pa.string())
        w = words(column) if inside is None else words(column, inside, lower)
        found, ids = [], {}
        for t in texts:
            t = t or ""
            t = re.sub("[A-Z]", lambda m: m[0].lower(), t) if lower else t
            found.append(re.findall(pattern, t))
        assert np.diff(w.first).tolist() == [len(x) for x in found]
        for word, h in zip((x for xs in found for x in xs), w.hash.tolist(), strict=True):
            assert ids.setdefault(word, h) == h
        assert len(set(ids.values())) == len(ids)


# 1. Benchmark decontamination.


def spans(df):
    return {r.doc_id: (r.n_words, r["items"], [tuple(s) for s in r.spans]) for r in df.collect()}


def test_spans_of_long_and_short_items(spark):
    item = sentence(1, 25)
    docs = frame(
        spark,
        [
            (1, "a b " + " ".join(item.split()[5:20]).upper() + ", c", "s"),
            (2, " ".join(item.split()[:9]), "s"),
            (3, "x one--TWO y one two", "s"),
            (4, None, "s"),
            (5, "", None),
            (None, "one two", "s"),
            (None, "one two", "s"),
        ],
    )
    items = frame(spark, [(1, item), (2, "one two"), (3, None), (4, ""), (2, "one two"), (None, "zzz")], "item_id long, text string")
    found = decontaminate.shared_spans(docs, items)
    got = spans(found.filter("doc_id IS NOT NULL"))
    assert got[1][:2] == (18, ["1"])
    assert {x for a, b in got[1][2] for x in range(a, b)} == set(range(2, 17))
    assert got[2] == (9, [], [])
    assert got[3] == (6, ["2"], [(1, 3), (4, 6)])
    assert got[4] == (0, [], []) and got[5] == (0, [], [])
    assert found.filter("doc_id IS NULL AND size(spans) = 1").count() == 2
    left = decontaminate.decontaminated(docs, items)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == [2, 4, 5]


def test_no_items_or_no_documents(spark):
    docs, items = frame(spark, [(1, "a b c", "s")]), frame(spark, [], "item_id long, text string")
    assert spans(decontaminate.shared_spans(docs, items)) == {1: (3, [], [])}
    assert decontaminate.shared_spans(docs.limit(0), items).count() == 0


@settings(max_examples=15, deadline=None)
@given(st.lists(st.sampled_from("ab"), min_size=1, max_size=60), st.lists(st.sampled_from("ab"), min_size=1, max_size=30))
def test_winnowing_keeps_a_fingerprint_of_each_window(doc, item):
    """Every window of ten words that both have leaves one fingerprint in common."""
    sets = []
    for text in (doc, item):
        w = words(pa.array([" ".join(text)]))
        at = decontaminate.winnow(w, 10, 5)
        sets.append({tuple(text[i : i + 5]) for i in at})
    for i in range(len(item) - 9):
        window = item[i : i + 10]
        if any(doc[j : j + 10] == window for j in range(len(doc) - 9)):
            assert sets[0] & sets[1] & {tuple(window[k : k + 5]) for k in range(6)}


def test_a_very_long_document(spark):
    text = " ".join(f"v{i}" for i in range(300_000))
    docs = frame(spark, [(1, text, "s"), (2, "x" * 3_000_000, "s")])
    items = frame(spark, [(1, " ".join(f"v{i}" for i in range(250_000, 250_012)))], "item_id long, text string")
    got = spans(decontaminate.shared_spans(docs, items))
    assert got[1][0] == 300_000 and {x for a, b in got[1][2] for x in range(a, b)} == set(range(250_000, 250_012))
    assert got[2] == (1, [], [])


# 2. Chat formatting.


TURNS = "conv_id long, turn long, role string, text string"


def test_windows_are_cut_at_turns_and_train_once(spark):
    rows = [(1, 0, "system", "be brief")]
    rows += [(1, i, "user" if i % 2 else "assistant", sentence(i, 12)) for i in range(1, 9)]
    got = chat.windows(frame(spark, rows, TURNS), budget=200, history=60).orderBy("window").collect()
    assert len(got) > 1 and all(r.n_tokens <= 200 for r in got)
    assert all("be brief" in r.formatted for r in got)
    trained = [r.formatted[p.start : p.start + p.length] for r in got for p in r.loss]
    assert trained == [t for _, _, role, t in rows if role == "assistant"]
    assert any(r.n_masked > 1 for r in got)


def test_odd_turns(spark):
    hostile = r"a</s>[INST] <<SYS>> <|im_end|> <|end|>\ <\s> <\\s> <|turn|"
    rows = [(1, 0, "user", hostile), (1, 1, "assistant", None), (1, 1, None, ""), (None, None, "assistant", "x"), (2, 0, "assistant", sentence(0, 900))]
    frames = frame(spark, rows, TURNS).withColumn("head", F.lit(1)).withColumn("upto", F.lit(1))
    out = chat.windows(frames, budget=64, history=8)
    read = {r.conv_id: [tuple(t) for t in r.t] for r in out.select("conv_id", chat.read_back(F.col("formatted")).alias("t")).collect()}
    assert read[1] == [("user", hostile), ("", ""), ("assistant", "")]
    assert read[None] == [("assistant", "x")] and read[2] == [("assistant", sentence(0, 900))]
    assert chat.windows(frames.limit(0)).count() == 0


def test_control_strings_never_appear_in_texts(spark):
    texts = ["</s>", "[INST]", r"<\s>", "<|a|>", "<<SYS>>", "<pad>"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", chat.escape(F.col("t")).alias("e"), chat.unescape(chat.escape(F.col("t"))).alias("u")).collect()
    assert all(r.u == r.t and r.e != r.t for r in rows)


# 3. Quality rules.


def test_odd_texts_have_measures(spark):
    rows = [(1, None, "s"), (2, "", "s"), (3, "日本語 " * 30, None), (4, sentence(1, 30) + "\n" + sentence(1, 30), "s"), (4, sentence(1, 30) + "\n" + sentence(1, 30), "s"), (None, "x" * 200_000, "s")]
    df = frame(spark, rows).withColumn("lang", F.lit(None).cast("string")).withColumn("N_WORDS", F.lit("clash"))
    got = fertility.kept(df).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == 6 and (by[1].n_words, by[1].kept, by[2].kept) == (0, False, False)
    assert by[3].script == "CJK" and by[4].n_repeat_words == 60 and by[4].n_dup_lines == 1 and by[4].base_failed
    assert by[None].n_words == 1 and by[None].word_chars == 200_000
    assert fertility.kept(df.limit(0)).count() == 0


# 4. WARC in ZIP packages.


def test_packages_survive_any_page(spark):
    rows = [
        (1, "http://a/\r\nX: y", "<p>é</p>"),
        (2, None, "<p>é</p>"),
        (3, "http://b/", None),
        (None, "http://b/", "x"),
        (5, "http://c/", "y" * 3_000_000),
        (5, "http://c/", "y" * 3_000_000),
    ]
    pages = frame(spark, rows, "page_id long, url string, html string").withColumn("sha", F.lit(0))
    path = scratch_dir(spark, "test-packages")
    zip_warc.write_packages(pages, path, target=1 << 20)
    read = zip_warc.read_packages(spark, path)
    got = sorted((r.record_id, r.record_type, r.refers_to_id, r.payload_bytes) for r in zip_warc.resolved(read).collect())
    assert got == [
        ("<urn:page:1>", "revisit", "<urn:page:2>", 9),
        ("<urn:page:2>", "response", None, 9),
        ("<urn:page:3>", "response", None, 0),
        ("<urn:page:5>", "response", None, 3_000_000),
        ("<urn:page:5>", "response", None, 3_000_000),
        ("<urn:page:null>", "response", None, 1),
    ]
    assert {bytes(r.payload or b"") for r in read.filter("record_type = 'response'").collect()} == {"<p>é</p>".encode(), b"", b"x", b"y" * 3_000_000}


def test_the_least_size_of_a_revisit(spark):
    pages = frame(spark, [(1, "u", "aa"), (2, "u", "aa"), (3, "u", "bbbb"), (4, "u", "bbbb")], "page_id long, url string, html string")
    path = scratch_dir(spark, "test-packages")
    zip_warc.write_packages(pages, path, least=3, zip64=False)
    got = {r.record_id: r.record_type for r in zip_warc.read_packages(spark, path).collect()}
    assert list(got.values()).count("revisit") == 1 and got["<urn:page:3>"] == "revisit"


@pytest.mark.parametrize("zip64", [False, True])
def test_directories_agree_with_the_standard_library(tmp_path, zip64):
    import io
    import zipfile

    data = zip_warc.package([("archive/a", b"123"), ("b", b"")], b"note", zip64)
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        assert [(i.filename, z.read(i)) for i in z.infolist()] == [("archive/a", b"123"), ("b", b"")]
    found = zip_warc.members(lambda at, n: data[at : at + n], len(data))
    assert {k: data[a : a + n] for k, (a, n) in found.items()} == {"archive/a": b"123", "b": b""}
    own = io.BytesIO()
    with zipfile.ZipFile(own, "w") as z:
        z.writestr("kept", b"xyz")
        z.writestr("packed", b"0" * 99, zipfile.ZIP_DEFLATED)
        z.comment = b"PK\x05\x06 a comment that looks like an end"
    raw = own.getvalue()
    found = zip_warc.members(lambda at, n: raw[at : at + n], len(raw))
    assert list(found) == ["kept"] and raw[found["kept"][0] :][:3] == b"xyz"
    with pytest.raises(ValueError):
        zip_warc.members(lambda at, n: b"no zip file"[at : at + n], 11)


def test_places_beyond_4_gb_are_read_by_range(tmp_path):
    """A sparse file of 5 GB: only the directory and the member's range are read."""
    import zipfile

    path, read = tmp_path / "big.zip", []
    with open(path, "wb") as f:
        f.seek(5 << 30)
        with zipfile.ZipFile(f, "w", allowZip64=True) as z:
            z.writestr("indexes/x", b"far")
    size = path.stat().st_size
    with open(path, "rb") as f:

        def read_at(at, n):
            read.append(n)
            f.seek(at)
            return f.read(n)

        (at, n) = zip_warc.members(read_at, size)["indexes/x"]
        assert at > 5 << 30 and read_at(at, n) == b"far" and sum(read) < 1 << 17


# 5. Near-duplicates.


def test_classes_of_odd_documents(spark):
    base = sentence(1, 100)
    near = base.replace("w1x50", "other")
    far = sentence(2, 100)
    rows = [(9, base, "s"), (8, base.upper() + "!", "s"), (7, near, "s"), (6, far, "s"), (5, None, "s"), (4, "", None), (3, "...", "s"), (2, "a b", "s"), (1, "A, b", "s"), (0, "b a", "s"), (None, far, "s"), (7, near, "s")]
    df = frame(spark, rows).withColumn("h1", F.lit("clash")).withColumn("root", F.lit(1))
    got = near_dup.classes(df)
    by = {r.doc_id: (r.class_id, r.class_size) for r in got.collect()}
    assert got.count() == 12
    assert by[9] == by[8] == by[7] == (7, 4) and by[6] == by[None] == (None, 2)
    assert by[5] == (5, 1) and by[4] == (4, 1) and by[3] == (3, 1)
    assert by[2] == by[1] == (1, 2) and by[0] == (0, 1)
    left = near_dup.one_of_each(df)
    assert left.columns == df.columns
    assert sorted(((r.doc_id is not None, r.doc_id or 0) for r in left.collect())) == [(False, 0), (True, 0), (True, 1), (True, 3), (True, 4), (True, 5), (True, 7)]
    assert near_dup.classes(df.limit(0)).count() == 0


def test_samples_agree_as_often_as_the_weighted_similarity():
    rng = np.random.default_rng(5)
    value = rng.integers(1, 1 << 63, 400, dtype=np.uint64)
    a, b = rng.uniform(0.5, 3, 400), rng.uniform(0.5, 3, 400)
    a[:60], b[60:120] = 0, 0
    rows = []
    for w in (a, b):
        keep = w > 0
        rows.append(near_dup._samples(np.zeros(keep.sum(), np.int64), value[keep], w[keep].astype(np.float32), 1)[0])
    share = (rows[0] == rows[1]).mean()
    true = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    assert abs(share - true) < 4 * np.sqrt(true * (1 - true) / near_dup.SAMPLES)


def test_components_of_a_long_chain(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(100, 101), (5, 5)]
    edges = spark.createDataFrame(pairs, "a long, b long")
    got = {r.id: r.root for r in near_dup.components(edges).collect()}
    assert got == {i: 0 for i in range(1, 41)} | {101: 100}


# 6. Line de-duplication.


def test_runs_of_lines(spark):
    run = "\n".join(f"line {i} of many" for i in range(5))
    long = sentence(3, 45)
    rows = [(1, f"top\n{run}\nend", "s"), (2, f"{run}\n\nnew", "s"), (3, f"line 1 of many\nline 2 of many\n{long}", "s"), (4, f"{long}\n{long}", None), (5, None, "s"), (6, "", "s"), (7, run, "s"), (7, run, "s"), (None, "x", "s")]
    df = frame(spark, rows).withColumn("n_lines", F.lit("clash")).withColumn("key", F.lit(1))
    got = line_dedup.without_repeats(df)
    assert got.columns == ["doc_id", "text", "source", "key", "n_lines", "n_deleted"]
    by = {r.doc_id: (r.text, r.n_lines, r.n_deleted) for r in got.collect()}
    assert by[1] == (rows[0][1], 7, 0) and by[2] == ("\nnew", 7, 5) and by[3] == (rows[2][1], 3, 0)
    assert by[4] == ("", 2, 2) and by[5] == (None, 0, 0) and by[6] == ("", 1, 0) and by[7] == ("", 5, 5)
    assert got.count() == 9 and line_dedup.without_repeats(df.limit(0)).count() == 0


# 7. Secret scans.


def test_the_model_finds_unnamed_strings(spark):
    rng = np.random.default_rng(3)

    def random(alphabet, n):
        return "".join(alphabet[i] for i in rng.integers(0, len(alphabet), n))

    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    train = [(i, f"The ordinary words of a sentence_number_{i % 7} are here, token = '{random(letters, 30)}' and more plain identifiers", "s") for i in range(200)]
    model = secrets.train(frame(spark, train))
    unnamed = [random(letters, 24) for _ in range(20)]
    unnamed = [x for x in unnamed if re.search("[0-9]", x)]
    plain = ["sentence_number_identifiers_7", "ordinary-words-of-2024", "plain_identifier_numbers_1"]
    rows = [(i, f"see {x}.", "s") for i, x in enumerate(unnamed + plain)]
    got = {r.doc_id: r.s for r in secrets.scan(frame(spark, rows), model=model).select("doc_id", secrets.spelled(F.col("spans")).alias("s")).collect()}
    held = [got[i] == f"markov:4:{4 + len(x)}" for i, x in enumerate(unnamed)]
    assert np.mean(held) >= 0.9
    assert not any(got[len(unnamed) + i] for i in range(len(plain)))


def test_every_run_is_scored(spark):
    rng = np.random.default_rng(5)

    def random(alphabet, n):
        return "".join(alphabet[i] for i in rng.integers(0, len(alphabet), n))

    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
    signs = letters + "0123456789"
    train = [(i, f"The ordinary words of a sentence_number_{i % 7} of The Quick Brown Foxes Jumping Over Lazy Dogs And Zebras Visiting Kings Under Great Halls Where Naomi Packed Eleven Yellow Crates In 1999 Monday Rather Simple, token = '{random(signs, 30)}' and more plain identifiers", "s") for i in range(800)]
    model = secrets.train(frame(spark, train))
    head, tail, hexes = random(signs, 20), random(signs, 21) + "Z", random("0123456789abcdef", 24)
    texts = [f"see {random(letters, 24)}." for _ in range(20)] + [f"see {random(signs, 12)}." for _ in range(20)]
    texts += [f"see {head}Z{hexes}{tail}.", f"see Z{tail}_token=abcdef12", f"ordinary-{hexes}"]
    got = {r.doc_id: (r.s, r.b) for r in secrets.scan(frame(spark, [(i, x, "s") for i, x in enumerate(texts)]), model=model).select("doc_id", secrets.spelled(F.col("spans")).alias("s"), secrets.spelled(F.col("base")).alias("b")).collect()}
    assert np.mean([got[i][0] == "markov:4:28" for i in range(20)]) >= 0.9
    assert np.mean([got[i][0] == "markov:4:16" for i in range(20, 40)]) >= 0.7
    assert got[40][0].split(",")[0] == f"markov:4:{len(texts[40]) - 1}" and "hex:" in got[40][1]
    assert got[41][0] == "markov:4:28,assign:28:42"
    assert got[42][0] == got[42][1] != ""


def test_odd_secrets(spark):
    rows = [
        (1, None, "s"),
        (2, "", "s"),
        (3, "😀 Password: 'abc' passwd=abcdef secret=token=xyzxyz", None),
        (3, "😀 Password: 'abc' passwd=abcdef secret=token=xyzxyz", None),
        (4, "AKIA" + "A" * 16 + "0" * 30, "s"),
        (None, "a" * 100_000, "s"),
    ]
    df = frame(spark, rows).withColumn("base", F.lit("clash")).withColumn("whole", F.lit(1))
    out = secrets.scan(df).select("doc_id", secrets.spelled(F.col("base")).alias("b"), "whole")
    got = {r.doc_id: r.b for r in out.collect()}
    assert got[1] == got[2] == "" and out.count() == 6
    assert got[3] == "assign:18:31,assign:32:51"
    assert got[4] == "access:0:50,hex:20:50" and got[None] == "hex:0:100000"
    assert secrets.scan(df.limit(0)).count() == 0


# 8. Sharding.


def test_shards_of_odd_rows(spark):
    rows = [(i % 40, f"t{i % 40}", None if i % 3 == 0 else ("hot" if i % 3 == 1 else "")) for i in range(203)] + [(None, None, None)]
    df = frame(spark, rows).withColumn("shard", F.lit("clash")).withColumn("total", F.lit(1))
    got = sharding.interleave(df, "doc_id", "source", 7).collect()
    assert len(got) == 204
    slots = {}
    for r in got:
        slots.setdefault(r.shard, []).append(r.slot)
    assert sorted(slots) == list(range(7)) and max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    for source in (None, "hot", ""):
        n = [sum(r.source == source for r in got if r.shard == s) for s in range(7)]
        assert max(n) - min(n) <= 2
    again = sharding.interleave(df.repartition(5), "doc_id", "source", 7).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, got))
    assert sharding.interleave(df.limit(0), "doc_id", "source").count() == 0


# 9. Main text.


def test_blocks_of_odd_markup():
    page = """<body><nav>menu</nav><div class="Cookie-notice">x</div><header>top</header><article><header><h1>A &amp; B&nbsp;C</h1></header>
    <p>one <b>two</b>three<br>four<script>var x = "<p>no</p>";</script><p>five<!-- no --> six<aside>side</aside><div class='share'>no</div>
    <ul><li>seven<li>eight</ul><section class=comments><p>reader</p></section>tail</article><footer>no</footer><!-- open"""
    kinds = main_text.blocks(page)
    inside = [t for k, t in kinds if k == main_text.ARTICLE]
    assert inside == ["A & B C", "one twothree four", "five six", "seven", "eight", "tail"]
    assert main_text.blocks("") == [] and main_text.blocks("<") == [(main_text.OPEN, "<")]


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ('<div style="overflow:hidden"><p>text</p></div>', [(1, "text")]),
        ('<div class="overflow-hidden" data-hidden=1><p>text</p></div>', [(1, "text")]),
        ("<div hidden>no</div><p style='color:red; display : none'>no</p><p>text</p>", [(2, "no"), (2, "no"), (1, "text")]),
        ('<body class="has-sidebar comments-open"><article>text</article></body>', [(0, "text")]),
        ('<body class="sidebar" style="display:none"><p>text</p></body>', [(1, "text")]),
        ('<article><div class="entry-header"><h1>title</h1></div><div class="header">by</div>text</article>', [(0, "title"), (0, "by"), (0, "text")]),
        ('<div class="social-history"><p>text</p></div>', [(1, "text")]),
        ('<div class="sidebar"><p>no</p><article>text<nav>no</nav></article></div>', [(2, "no"), (0, "text"), (2, "no")]),
        ('<form><main>text</main></form>', [(0, "text")]),
        ('<p>text of the page</p><div class="comments"><article>reader</article></div>', [(1, "text of the page"), (2, "reader")]),
        ('<div hidden><article>no</article></div>', [(2, "no")]),
        ('<article>text<div class="comments"><article>reader</article></div></article>', [(0, "text"), (2, "reader")]),
        ('<article class="related teaser">no</article><main>text</main>', [(2, "no"), (0, "text")]),
        ('<div class="site-footer">no</div><div class="share-buttons">no</div>', [(2, "no"), (2, "no")]),
        ('<article><p class="notice">no<p>one<p class="notice"><b>no<div>two</div><p class=ad>no<hr>three</article>', [(2, "no"), (0, "one"), (2, "no"), (0, "two"), (2, "no"), (0, "three")]),
    ],
)
def test_containers_by_their_own_names(page, want):
    assert main_text.blocks(page) == want


def test_pages_without_an_article_lose_what_their_host_repeats(spark):
    menu = "home news sport weather travel culture science shop about contact"
    rows = [(i, f"http://h.example/{i}", f"<div>{menu}</div><p>{sentence(i, 15)}</p>") for i in range(6)]
    rows += [(10, "http://h.example/0", rows[0][2]), (11, "http://other.example/", f"<div>{menu}</div>"), (12, None, None), (None, "odd", ""), (13, "http://x/", "<main>kept " + menu + "</main>")]
    df = frame(spark, rows, "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    got = {r.page_id: r.text for r in main_text.extract(df).collect()}
    assert all(got[i] == sentence(i, 15) for i in range(6)) and got[10] == got[0]
    assert got[11] == menu and got[12] == "" and got[None] == "" and got[13] == "kept " + menu
    assert main_text.extract(df.limit(0)).count() == 0


def test_articles_lose_what_many_pages_of_their_host_repeat(spark):
    plea = "please subscribe to our letter and never miss a story again"
    quote = sentence(99, 12)
    rows, want = [], {}
    for h in range(4):
        for i in range(8):
            k, own = 100 * h + i, sentence(100 * h + i, 30)
            text = f"{own} {quote}" if i < 2 else own
            rows.append((k, f"http://h{h}.example/{i}", f"<nav>menu {k}</nav><article><p>{text}</p><div>{plea}</div></article>"))
            want[k] = text
        # Copies of one article, the second with another menu and the third edited.
        copy = sentence(100 * h + 50, 40)
        for i, more in enumerate(("", "", " edited")):
            rows.append((100 * h + 50 + i, f"http://h{h}.example/copy{i}", f"<nav>{i}</nav><main><p>{copy}{more}</p></main>"))
            want[100 * h + 50 + i] = copy + more
        # An open page that has the same plea.
        rows.append((100 * h + 60, f"http://h{h}.example/open", f"<p>{sentence(h + 1000, 9)}</p><p>{plea}</p>"))
        want[100 * h + 60] = sentence(h + 1000, 9)
    for i in range(3):
        k, only = 900 + i, sentence(900, 40) + f" version {i}"
        rows.append((k, f"http://copies.example/{i}", f"<article>{only}</article>"))
        want[k] = only
    df = frame(spark, rows, "page_id long, url string, html string")
    out = main_text.extract(df.repartition(3).union(df.limit(20))).collect()
    assert {r.page_id: r.text for r in out} == want and len(out) == len(rows) + 20
    # Hosts in one chunk and hosts in several.
    one, many = (sorted(map(tuple, main_text.repeated(df, chunk=n).collect())) for n in (main_text.CHUNK, 100))
    assert one == many and len(one) > 32


@settings(max_examples=30, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=40), st.integers(1, 9))
def test_suffix_ranks_order_prefixes(tokens, depth):
    rank = main_text.suffix_classes(np.array(tokens), depth)
    want = sorted({tuple(tokens[i : i + depth]) for i in range(len(tokens))})
    assert [want[r - 1] for r in rank] == [tuple(tokens[i : i + depth]) for i in range(len(tokens))]


# 10. SentencePiece.


@pytest.fixture(scope="module")
def machines():
    import sentencepiece

    return piece_fst.PieceTransducer(piece_fst._load(piece_fst.MODEL)), sentencepiece.SentencePieceProcessor(model_file=piece_fst.MODEL)


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from(" ▁\n abethnd")), max_size=40))
def test_ids_are_those_of_the_library(machines, text):
    fst, library = machines
    assert fst.encode(text) == library.encode(text)
    ids = pa.array([fst.encode(text)], pa.list_(pa.int32()))
    assert piece_fst._texts(ids, fst).to_pylist() == [text.replace("▁", " ")]


def test_the_path_of_a_unigram_model_is_the_cheapest(machines):
    """The same search with scores as weights, against all segmentations."""
    import itertools

    fst = piece_fst.PieceTransducer(piece_fst._load(piece_fst.MODEL))
    fst.bpe, fst.floor, fst.longest = False, -20.0, 4
    fst.score = {"a": -3.0, "b": -3.0, "ab": -4.0, "ba": -3.5, "aba": -6.9, "bb": -5.0}
    fst.sizes = [1, 2, 3, 4]
    fst.upto = [0, 1, 2, 3]
    for letters in itertools.product("abc", repeat=5):
        text = "".join(letters)
        costs = []
        for cuts in itertools.product([0, 1], repeat=4):
            parts, last = [], 0
            for i, c in enumerate((*cuts, 1), 1):
                if c:
                    parts.append(text[last:i])
                    last = i
            if all(len(p) == 1 or p in fst.score for p in parts):
                costs.append(sum(-fst.score.get(p, -20.0) for p in parts))
        found = fst.path(text)
        assert "".join(found) == text
        assert sum(-fst.score.get(p, -20.0) for p in found) == pytest.approx(min(costs))


def test_odd_texts_are_encoded(spark, machines):
    rows = [(1, None, "s"), (2, "", "s"), (3, "a▁b  c\n", None), (3, "a▁b  c\n", None), (None, "日本" * 50_000, "s")]
    df = frame(spark, rows).withColumn("ids", F.lit("clash"))
    out = piece_fst.encode(df, again="ok")
    got = {r.doc_id: r for r in out.collect()}
    assert out.count() == 5 and all(r.ok for r in got.values())
    assert got[1]["ids"] == got[2]["ids"] == [] and got[3]["ids"] == machines[1].encode("a▁b  c\n")
    back = {r.doc_id: r.decoded for r in piece_fst.decode(out).collect()}
    assert back[3] == "a b  c\n" and back[None] == rows[-1][1] and back[1] == ""
    nothing = piece_fst.decode(spark.createDataFrame([(None,), ([131, 132],)], "ids array<int>")).collect()
    assert nothing[0].decoded is None and nothing[1].decoded == "��"
    assert piece_fst.encode(df.limit(0)).count() == 0


def test_rules_of_the_normaliser(machines):
    fst = piece_fst.PieceTransducer(piece_fst._load(piece_fst.MODEL), {"ﬁ": "fi", "ﬁx": "fasten", "\t": " "})
    assert fst.encode("ﬁn\tﬁx") == machines[1].encode("fin fasten")
    column = pa.array(["ﬁn\tﬁx", None], pa.string())
    assert piece_fst._ids(column, fst).to_pylist() == [machines[1].encode("fin fasten"), []]
