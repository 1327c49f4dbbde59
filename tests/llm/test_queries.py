"""The registered queries against SQL, or against a plain replay, over whole tables."""

import hashlib
import re
from collections import Counter

import duckdb
import pytest

from corpus_pipeline import PIPELINE_QUERIES
from wardstream.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ("documents", "pages", "benchmark", "conversations")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.fixture(scope="module")
def docs(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def by_id(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


def test_one_query_for_each_operator():
    numbers = sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES)
    assert numbers == list(range(1, 14))
    assert list(PIPELINE_QUERIES) == ["pipeline"]


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_against_sql(spark, duck, name):
    ours = QUERIES[name](spark, SF)
    cols = sorted(ours.columns)
    theirs = duck.execute(f"SELECT {', '.join(cols)} FROM ({ORACLE[name]})").fetchall()
    mine = [tuple(r) for r in ours.select(*cols).collect()]
    assert sorted(mine, key=repr) == sorted(theirs, key=repr)
    assert len(mine) > 0


def test_op2_spells_each_turn_and_trains_each_answer_once(spark, duck):
    rows = duck.execute("SELECT conv_id, role, coalesce(text, '') FROM conversations ORDER BY conv_id, turn").fetchall()
    rows += [(-1, role, "</s>[INST] ok [/INST]") for role in ("user", "assistant")]
    said, taught, n = {}, {}, Counter()
    for conv, role, text in rows:
        said[conv] = said.get(conv, "") + f"{role}\n{text}\n"
        taught[conv] = taught.get(conv, "") + (text if role == "assistant" else "")
        n[conv] += 1
    got = by_id(QUERIES["op2_chat_windows"](spark, SF), "conv_id")
    assert set(got) == set(said)
    for conv, r in got.items():
        assert r.n_turns == n[conv]
        assert r.turns_sha256 == hashlib.sha256(said[conv].encode()).hexdigest()
        assert r.loss_chars == len(taught[conv])
        assert r.loss_sha256 == hashlib.sha256(taught[conv].encode()).hexdigest()
        assert r.formatted_chars > len(said[conv]) - 2 * n[conv]


def test_op3_base_rules(spark, docs):
    got = by_id(QUERIES["op3_fertility_rules"](spark, SF))
    assert set(got) == set(docs)
    for i, r in got.items():
        text = docs[i].text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", text)
        windows = Counter(tuple(w[j : j + 8]) for j in range(len(w) - 7))
        hit = {x for j in range(len(w) - 7) if windows[tuple(w[j : j + 8])] > 1 for x in range(j, j + 8)}
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        failed = len(w) < 20 or 100 * len(hit) > 30 * len(w)
        want = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit), failed)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == want
        assert not (r.base_failed and r.kept)


def test_op3_keeps_labelled_clean_documents(spark):
    sf = "/root/testdata/sf0.01"
    kept = QUERIES["op3_fertility_rules"](spark, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    found = kept.join(labels, "doc_id").filter("NOT base_failed")
    share = {(r.quality, r.kept): r["count"] for r in found.groupBy("quality", "kept").count().collect()}
    assert share.get((1, False), 0) == 0
    assert share[0, False] >= 0.4 * (share[0, False] + share.get((0, True), 0))


def test_op3_rejects_labelled_bad_documents(spark):
    sf = "/root/testdata/sf0.1"
    kept = QUERIES["op3_fertility_rules"](spark, sf)
    found = kept.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").filter("NOT base_failed")
    share = {(r.quality, r.kept): r["count"] for r in found.groupBy("quality", "kept").count().collect()}
    assert share.get((1, False), 0) == 0
    assert share[0, False] >= 0.95 * (share[0, False] + share.get((0, True), 0))


def test_op3_keeps_short_prose(spark):
    from wardstream.llm import fertility

    texts = {
        "en": "The council met on Tuesday to discuss the new bridge, and after two hours of debate its members agreed to ask the engineers for another report.",
        "de": "Der Rat traf sich am Dienstag, um über die neue Brücke zu sprechen, und nach zwei Stunden bat er die Ingenieure um einen weiteren Bericht.",
        "es": "El consejo se reunió el martes para hablar del nuevo puente y, después de dos horas, pidió a los ingenieros otro informe sobre los costes.",
        "fr": "Le conseil s'est réuni mardi pour parler du nouveau pont et, après deux heures, il a demandé aux ingénieurs un autre rapport sur les coûts.",
    }
    docs = spark.createDataFrame(list(texts.items()), "lang string, text string")
    assert [r.kept for r in fertility.kept(docs).collect()] == [True] * 4


def test_op5_classes_of_plain_comparison(spark, docs):
    """All pairs by plain Python on the sampled weights' own terms."""
    import numpy as np
    import pyarrow as pa

    from wardstream.llm import near_dup as nd
    from wardstream.llm.wordhash import words

    ids = sorted(docs)
    texts = pa.array([docs[i].text for i in ids], pa.string())
    text, value, count = nd._shingles(words(texts))
    weight = nd.weights(np.bincount(nd._counter(value), minlength=nd.COUNTERS), len(ids))
    bags = [{} for _ in ids]
    for t, v, c in zip(text, value, count, strict=True):
        bags[t][v] = float(c * weight[nd._counter(np.array([v]))[0]])
    root = list(range(len(ids)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(ids)):
        for b in range(a):
            keys = bags[a].keys() & bags[b].keys()
            if keys:
                low = sum(min(bags[a][k], bags[b][k]) for k in keys)
                if low / (sum(bags[a].values()) + sum(bags[b].values()) - low) >= 0.8:
                    x, y = find(a), find(b)
                    root[max(x, y)] = min(x, y)
    got = by_id(QUERIES["op5_weighted_minhash"](spark, SF))
    assert {i: got[i].class_id for i in ids} == {i: ids[find(k)] for k, i in enumerate(ids)}


def test_op7_base_spans(spark, docs):
    names = "password passwd secret token api_?key".split()
    either = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in x) for x in names)
    assign = re.compile(rf"""({either})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    for i, r in by_id(QUERIES["op7_markov_secrets"](spark, SF)).items():
        text = docs[i].text or ""
        found = [[(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 6]]
        found.append([(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20])
        found.append([(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24])
        spelled = [f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(sum(found, []))]
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(map(len, found))
        assert r.base_sha256 == hashlib.sha256(",".join(spelled).encode()).hexdigest()
        assert [x for x in r.spans.split(",") if x and not x.startswith("markov")] == spelled


def test_op9_articles(spark):
    import html

    got = by_id(QUERIES["op9_host_suffixes"](spark, SF), "page_id")
    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    assert len(pages) == len(got)
    for p in pages:
        inside = re.search(r"<article>(.*)</article>", p.html, re.S)[1]
        parts = (html.unescape(re.sub("<[^>]*>", "", x)) for x in re.split("</?(?:p|h1)>", inside))
        want = "\n".join(y for y in (" ".join(x.split()) for x in parts) if y)
        assert (got[p.page_id].text, got[p.page_id].n_chars) == (want, len(want))


def test_op10_pieces_of_the_library(spark, docs):
    import sentencepiece

    from wardstream.llm.piece_fst import MODEL

    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    got = by_id(QUERIES["op10_piece_transducer"](spark, SF))
    assert set(got) == set(docs)
    for i, r in got.items():
        assert r.ids == library.encode(docs[i].text or "")
        assert r.spelled_again and r.n_pieces == len(r.ids)
