"""The pipeline's stages against plain replays of what each decides."""

import re

import pytest

import corpus_pipeline as cp
from wardstream.session import materialise

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def states(spark):
    """The documents before the first stage and after each."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, stage in cp.STAGES:
        docs = materialise(stage(spark, docs, SF), name)
        out.append(docs)
    return out


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_stages_and_columns(states):
    assert [n for n, _ in cp.STAGES] == ["quality", "lines", "near_duplicates", "clean_of_benchmark", "pieces"]
    assert all(s.columns == COLUMNS for s in states[:-1])


def test_quality_rejects_what_fails(spark, states):
    from wardstream.llm.queries import QUERIES

    verdict = {r.doc_id: r.kept for r in QUERIES["op3_fertility_rules"](spark, SF).collect()}
    before, after = rows(states[0]), rows(states[1])
    assert after == {i: r for i, r in before.items() if verdict[i]}
    assert 0 < len(after) < len(before)


def test_lines_lose_later_runs(states):
    """Replay: a run of five units that an earlier document or place has goes."""
    before, after = rows(states[1]), rows(states[2])
    seen, want = set(), {}
    for i in sorted(before):
        lines = before[i].text.split("\n")
        units = []
        for n, line in enumerate(lines):
            count = min(5, -(-len(re.findall(r"[^\x09-\x0D\x20]+", line)) // 10))
            units += [(line, j, n) for j in range(count)]
        runs = [tuple(u[:2] for u in units[p : p + 5]) for p in range(len(units) - 4)]
        gone = set()
        for p, run in enumerate(runs):
            if run in seen:
                gone |= set(range(units[p][2], units[p + 4][2] + 1))
            seen.add(run)
        text = "\n".join(x for n, x in enumerate(lines) if n not in gone)
        if not gone or re.search(r"[^\x09-\x0D\x20]", text):
            want[i] = text
    assert {i: r.text for i, r in after.items()} == want
    assert all(r.n_chars == len(r.text) for i, r in after.items() if r.text != before[i].text)


def test_one_of_each_class_stays(spark, states):
    from wardstream.llm import near_dup

    classes = {r.doc_id: r.class_id for r in near_dup.classes(states[2]).collect()}
    before, after = rows(states[2]), rows(states[3])
    assert after == {i: r for i, r in before.items() if classes[i] == i}


def test_benchmark_passages_are_gone(spark, states):
    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))

    windows = set()
    for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect():
        w = words(r.text)
        windows |= {tuple(w[p : p + 10]) for p in range(max(1, len(w) - 9))} if w else set()
    before, after = rows(states[3]), rows(states[4])

    def hit(t):
        w = words(t)
        return any(tuple(w[p : p + n]) in windows for n in set(map(len, windows)) for p in range(len(w) - n + 1))

    assert after == {i: r for i, r in before.items() if not hit(r.text)}
    assert len(after) < len(before)


def test_run_ends_in_the_pieces_of_what_is_left(spark, states):
    import sentencepiece

    from wardstream.llm.piece_fst import MODEL

    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    texts = {i: r.text for i, r in rows(states[4]).items()}
    got = {r.doc_id: r.ids for r in cp.run(spark, SF).collect()}
    assert got == {i: library.encode(t) for i, t in texts.items()}


def test_odd_rows(spark):
    """Nulls in any column, empty and very long texts, repeated rows, no rows."""
    long = " ".join(f"w{i} alpha beta{i % 97}" for i in range(60_000))
    data = [
        (None, None, None, None, None),
        (1, None, "en", "s", 0),
        (2, "", "en", "s", 0),
        (3, "\n\n  \n", None, None, 3),
        (4, long, "xx", "s", len(long)),
        (4, long, "xx", "s", len(long)),
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for given in (data, []):
        docs = spark.createDataFrame(given, schema)
        for _, stage in cp.STAGES[:-1]:
            docs = materialise(stage(spark, docs, SF), "odd")
            assert docs.columns == COLUMNS
        last = cp.STAGES[-1][1](spark, docs, SF).collect()
        assert [r.doc_id for r in last] == ([4] if given else [])
