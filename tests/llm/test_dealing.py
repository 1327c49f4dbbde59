"""What near-duplicates and line de-duplication send, and to whom."""

import math
import random
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import functions as F

from wardstream.llm import line_dedup, near_dup
from wardstream.llm.wordhash import words


def close_texts(n, words=120, seed=3, changes=6):
    """Texts that differ from one another in a few words each."""
    rng = random.Random(seed)
    whole = [f"w{i}" for i in range(words)]
    out = []
    for k in range(n):
        mine = list(whole)
        for i in rng.sample(range(words), rng.randrange(changes)):
            mine[i] = f"x{k}y{i}"
        out.append(" ".join(mine))
    return out


def bucket(spark, n_main, others):
    ids = [(1, (k, k), (0, 0)) for k in range(n_main)] + [(1, (10**6 + k, k), (1 + k // others[1], 1)) for k in range(others[0])]
    pair = "struct<s1:bigint,s2:bigint>"
    return spark.createDataFrame(ids, f"bucket bigint, id {pair}, root {pair}")


def dealt(spark, rest, blocks):
    main = F.struct(F.lit(0).cast("long").alias("s1"), F.lit(0).cast("long").alias("s2"))
    sized = rest.withColumns({"main": main, "n_main": F.lit(blocks[0]), "n_other": F.lit(blocks[1])})
    return near_dup._groups(sized).collect()


def test_every_pair_of_classes_meets_once(spark):
    for blocks in ((1, 1), (5, 1), (4, 3), (1, 3)):
        rows = dealt(spark, bucket(spark, 40, (17, 2)), blocks)
        members = {}
        for r in rows:
            members.setdefault((r.kind, r.x, r.y), []).append(r)
        met = {}
        for (kind, _, _), held in members.items():
            for a in held:
                for b in held:
                    across = kind == near_dup._ACROSS and a.in_main == b.in_main
                    if a.id < b.id and a.root != b.root and not across:
                        met[a.id, b.id] = met.get((a.id, b.id), 0) + 1
        everyone = {(r.id, r.root) for r in rows}
        want = {(a, b) for a, x in everyone for b, y in everyone if a < b and x != y}
        assert set(met) == want


def test_one_stray_text_beside_many_copies(spark):
    """Main texts go out once, the stray one to each of their blocks."""
    rows = dealt(spark, bucket(spark, 5000, (1, 1)), (100, 1))
    assert len([r for r in rows if r.in_main]) == 5000
    assert len([r for r in rows if not r.in_main]) <= 101


def test_bytes_dealt_for_a_cluster_of_close_texts(spark, monkeypatch):
    """At most three times what is held, however large the cluster; and the same classes with blocks of any size."""
    seen = []
    groups = near_dup._groups

    def watched(placed):
        out = groups(placed)
        seen.append((placed.count(), out.count()))
        return out

    monkeypatch.setattr(near_dup, "_groups", watched)
    for n in (300, 900):
        docs = spark.createDataFrame(list(enumerate(close_texts(n, changes=14))), "doc_id long, text string")
        found = {}
        for block in (1 << 21, 1 << 15):
            monkeypatch.setattr(near_dup, "BLOCK", block)
            found[block] = sorted((r.doc_id, r.class_id) for r in near_dup.classes(docs).collect())
        assert len({tuple(x) for x in found.values()}) == 1
        held, sent = seen[-1]
        assert held and sent <= 3 * held


def test_shared_lines_are_joined_as_stored(spark, monkeypatch):
    """Nothing stands between the exchanges of the fingerprints and their join, which may then split a hot one."""
    plans = []
    store = line_dedup.materialise

    def watched(df, label):
        if label == "runs":
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return store(df, label)

    monkeypatch.setattr(line_dedup, "materialise", watched)
    names = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"
    for c in names:
        spark.conf.set(c, "-1")
    try:
        docs = spark.createDataFrame([(i, "\n".join(f"line {j} of six words here" for j in range(9))) for i in range(20)], "doc_id long, text string")
        out = line_dedup.without_repeats(docs).collect()
    finally:
        for c in names:
            spark.conf.unset(c)
    assert sum(r.n_deleted == 0 for r in out) == 1
    (plan,) = plans
    assert "SortMergeJoin" in plan and "Aggregate" not in plan and plan.count("Exchange hashpartitioning") == 2


def test_shingles_and_weights_of_plain_python(spark):
    """Counts of five-word shingles, and classes, by tuples of words and exact document frequencies."""
    docs = [r.text or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").collect()]
    docs += close_texts(12, 60, changes=9) + ["a b", "A, b!", "a b c", ""]
    bags = []
    for text in docs:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
        grams = [tuple(w[i : i + 5]) for i in range(len(w) - 4)] or ([tuple(w)] if w else [])
        bags.append(Counter(grams))
    of, _, count = near_dup._shingles(words(pa.array(docs)))
    for d, bag in enumerate(bags):
        mine = of == d
        assert sorted(count[mine].tolist()) == sorted(bag.values())
    frequency = Counter(g for bag in bags for g in bag)
    mean = sum(frequency.values()) / near_dup.COUNTERS
    floor = max(1.0, 2 * math.sqrt(mean))

    def weight(gram):
        rare = math.log1p(len(docs) / max(frequency[gram] - mean, floor)) / math.log1p(len(docs) / floor)
        return 1 - near_dup.DAMP + near_dup.DAMP * rare

    root = list(range(len(docs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    doubtful = set()
    for a, x in enumerate(bags):
        for b, y in enumerate(bags[:a]):
            if x.keys() & y.keys():
                low = sum(min(x[g], y[g]) * weight(g) for g in x.keys() & y.keys())
                similar = low / (sum(x[g] * weight(g) for g in x) + sum(y[g] * weight(g) for g in y) - low)
                # Counters that two shingles share move a similarity by less than this.
                if abs(similar - 0.8) < 0.002:
                    doubtful |= {a, b}
                elif similar >= 0.8:
                    p, q = find(a), find(b)
                    root[max(p, q)] = min(p, q)
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in near_dup.classes(df).collect()}
    unsure = {find(d) for d in doubtful}
    assert {d: c for d, c in got.items() if find(d) not in unsure} == {d: find(d) for d in got if find(d) not in unsure}
    assert len(unsure) < 5
