"""Long texts and long conversations, and the model's spans against a plain replay."""

import math
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from wardstream.llm import chat, secrets

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    return secrets.train(spark.read.parquet(f"{SF}/documents.parquet"))


def ratio(token, model):
    total, before = 0.0, 0
    for c in token:
        now = secrets.ALPHABET.find(c) + 1
        total += model[before * secrets.SYMBOLS + now]
        before = now
    return total


def enough(total, n):
    return total >= (secrets.MARGIN if n >= secrets.LONG else max(secrets.MARGIN, n * secrets.SHORT_MARGIN))


def plainly(text, model):
    """Base spans, and those that the model adds, from the definitions."""
    base = [(m.start(), 0, m.end()) for m in re.finditer(secrets.ASSIGN, text) if len(m[2]) >= secrets.LEAST]
    base += [(m.start(), k, m.end()) for k, p in ((1, secrets.ACCESS), (2, secrets.HEX)) for m in re.finditer(p, text)]
    more = []
    for m in re.finditer(secrets.CANDIDATE, text):
        start, end = m.span()
        near = [b for b in base if b[0] < end and start < b[2]]
        if not near:
            if enough(ratio(m[0], model), end - start):
                more.append((start, 3, end))
            continue
        end = min([end, *(b[0] for b in near if b[1] == 0)])
        left = "".join(" " if any(b[0] <= i < b[2] for b in base) else text[i] for i in range(start, end)).split()
        n = sum(map(len, left))
        if n and enough(sum(ratio(x, model) for x in left), n):
            more.append((start, 3, end))
    return sorted(base), sorted(base + more)


def odd_texts(n, seed=1):
    rng = random.Random(seed)
    bits = ["password=", "token: ", "AKIA" + "B7" * 10, "deadbeef" * 4, "Zk3p9Qx", "-", "/", " ", ". ", "secret='", "word", "+" * 3, "é", "aB3dE5gH7"]
    return ["".join(rng.choice(bits) for _ in range(rng.randrange(12))) for _ in range(n)]


@pytest.mark.parametrize("sizes", [(256, 512, 32), (3, 8, 2)])
def test_spans_of_plain_python(spark, model, monkeypatch, sizes):
    for name, size in zip(("BLOCK", "TILE", "FAN"), sizes, strict=True):
        monkeypatch.setattr(secrets, name, size)
    texts = odd_texts(500) + [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").filter(F.length("text") < 3000).limit(200).collect()]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    # A model that is readier to see secrets, so that it adds many.
    for used in (model, [x + 0.35 for x in model]):
        want = {i: plainly(x, used) for i, x in enumerate(texts)}
        got = {r.doc_id: (list(map(tuple, r.base)), list(map(tuple, r.spans))) for r in secrets.scan(df, model=used).collect()}
        assert got == want
    assert sum(len(s) - len(b) for b, s in want.values()) > 100


KEYS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"


@pytest.mark.parametrize(("n", "least"), [(8, 0.3), (12, 0.5), (16, 0.9), (24, 0.95), (40, 0.99)])
def test_recall_on_planted_keys(spark, model, n, least):
    rng = random.Random(n)
    rows = [(i, f"the value {''.join(rng.choice(KEYS) for _ in range(n))} was set") for i in range(400)]
    found = secrets.scan(spark.createDataFrame(rows, "doc_id long, text string"), model=model)
    hit = found.filter(F.exists("spans", lambda s: (s["start"] == 10) & (s["end"] == 10 + n))).count()
    print(f"recall on keys of {n} characters: {hit / 400:.3f}")
    assert hit / 400 >= least


def test_false_alarms_on_clean_documents(spark, model):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    clean = docs.join(spark.read.parquet(f"{SF}/labels.parquet").filter("quality = 1 AND toxic = 0"), "doc_id", "left_semi")
    found = secrets.scan(clean, model=model)
    alarms, words = found.agg(F.sum(F.size("spans") - F.size("base")), F.sum(F.size(F.split("text", r"\s+")))).first()
    print(f"false alarms: {alarms} in {words} words")
    assert alarms <= 20 * math.ceil(words / 1e6)


def test_long_runs_and_many_assignments(spark, model):
    rng = random.Random(2)
    run = "".join(rng.choice(KEYS + "+/") for _ in range(1_000_000))
    many = " ".join(f"password=ab{rng.randrange(10**6):06d}c" for _ in range(50_000))
    df = spark.createDataFrame([(1, run), (2, many)], "doc_id long, text string")
    secrets.scan(df.limit(0).union(spark.createDataFrame([(0, "x")], df.schema)), model=model).collect()
    began = time.monotonic()
    got = {r.doc_id: r.spans for r in secrets.scan(df, model=model).collect()}
    # A quadratic scan takes hours on the first and minutes on the second.
    assert time.monotonic() - began < 60
    assert [tuple(s) for s in got[1]] == [(0, 3, 1_000_000)]
    assert len(got[2]) == 50_000 and tuple(got[2][-1]) == (49_999 * 19, 0, 49_999 * 19 + 18)


def test_a_conversation_of_many_turns(spark):
    n = 100_000
    roles = F.when(F.col("id") % 2 == 0, "user").otherwise("assistant")
    turns = spark.range(n).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), roles.alias("role"), F.concat(F.lit("turn "), F.col("id").cast("string"), F.lit(" <s>")).alias("text"))
    began = time.monotonic()
    found = chat.windows(turns)
    fresh = F.slice(chat.read_back(F.col("formatted")), F.col("n_masked") + 1, F.length("formatted") + 1)
    spoken = found.select("window", F.explode(fresh).alias("t")).select("window", "t.text").collect()
    assert time.monotonic() - began < 60
    assert sorted(r.text for r in spoken) == sorted(f"turn {i} <s>" for i in range(n))
    assert found.filter("n_tokens > 1024").isEmpty() and found.select("window").distinct().count() == found.count()
    trained = found.select(F.explode(chat.under_loss(F.col("formatted"), F.col("loss"))).alias("text"))
    assert trained.count() == trained.distinct().count() == n // 2


def replay(said, budget, history):
    """The windows by the definition, turn by turn: (first, fresh, end) after a leading system turn."""
    sums = [0]
    for _, n in said:
        sums.append(sums[-1] + n)
    lead = int(said[0][0] == "system")
    out = []
    for i in range(lead, len(said)):
        if out and sums[lead] + sums[i + 1] - sums[out[-1][0]] <= budget:
            out[-1][2] = i + 1
            continue
        start = i
        while out and start > lead and sums[i] - sums[start - 1] <= history:
            start -= 1
        if not out or sums[lead] + sums[i + 1] - sums[start] > budget:
            start = i
        out.append([start, i, i + 1])
    return lead, out or [[lead, lead, len(said)]]


@pytest.mark.parametrize(("budget", "history"), [(40, 12), (25, 0), (1024, 256)])
def test_windows_of_plain_python(spark, budget, history):
    rng, rows, want = random.Random(budget), [], {}
    for conv in range(120):
        said = [(rng.choice(["system", "user", "assistant"]) if t else rng.choice(["system", "user"]), rng.randrange(30)) for t in range(rng.randrange(1, 25))]
        rows += [(conv, t, role, " ".join("w" * 1 for _ in range(n))) for t, (role, n) in enumerate(said)]
        lead, spans = replay([(role, n + 1 + chat.MARKS) for role, n in said], budget, history)
        for w, (first, fresh, end) in enumerate(spans):
            kept = list(range(lead)) + list(range(first, end))
            want[conv, w] = (tuple((said[t][0], said[t][1]) for t in kept), fresh - first + (lead if w else 0))
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    got = {}
    for r in chat.windows(df, budget=budget, history=history).withColumn("turns", chat.read_back(F.col("formatted"))).collect():
        got[r.conv_id, r.window] = (tuple((t.role, len(t.text.split())) for t in r.turns), r.n_masked)
    assert got == want
