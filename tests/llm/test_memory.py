"""What the operators keep in memory beside the texts they work on."""

import random
import tracemalloc
import uuid

import numpy as np
import pyarrow as pa

import corpus_pipeline
from wardstream import session
from wardstream.llm import fertility, line_dedup, near_dup, piece_fst
from wardstream.llm.wordhash import run_hashes


def peak(function, *args) -> float:
    """MB taken at once by Python and numpy while ``function`` runs."""
    tracemalloc.start()
    try:
        function(*args)
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_hashing_does_not_hold_values_of_all_bytes():
    data = np.full(4 << 20, ord("x"), np.uint8)
    end = np.arange(1000, len(data), 1000)
    assert peak(run_hashes, data, end - 999, end) < 16


def test_hashes_do_not_depend_on_what_is_hashed_at_once():
    data = np.frombuffer(random.Random(1).randbytes(1 << 20), np.uint8)
    cuts = np.array([0, 5, 9, 1 << 17, 3 << 17, (3 << 17) + 2, 1 << 20])
    together = run_hashes(data, cuts[:-1], cuts[1:])
    alone = [run_hashes(data[a:b], np.array([0]), np.array([b - a]))[0] for a, b in zip(cuts, cuts[1:], strict=False)]
    assert together.tolist() == alone


def test_pieces_of_many_words_are_not_held_several_times():
    """Per word a few integers: its place, its stretch and its ids."""
    fst = piece_fst.PieceTransducer(piece_fst._load(piece_fst.MODEL), {})
    words = random.Random(1).choices(["ab", "the", "of", "in", "x"], k=400_000)
    column = pa.array([" ".join(words)])
    piece_fst._ids(column, fst)
    assert peak(piece_fst._ids, column, fst) < 30
    assert piece_fst._ids(column, fst).to_pylist() == [fst.encode(" ".join(words))]


def test_small_tables_do_not_take_a_file_for_each_shuffle_partition(spark, tmp_path, monkeypatch):
    """Each new file costs the executor a process that sets its rights."""
    enough = 2 * spark.sparkContext.defaultParallelism
    conf = {"spark.sql.shuffle.partitions": str(3 * enough), "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {c: spark.conf.get(c) for c in conf}
    monkeypatch.setattr(session, "scratch_dir", lambda _, label: f"{tmp_path}/{label}-{uuid.uuid4().hex}")
    draw = random.Random(3)
    texts = [" ".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=60)) for _ in range(200)]
    texts += [f"{x} {x[:9]}" for x in texts]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    try:
        for c, v in conf.items():
            spark.conf.set(c, v)
        left = near_dup.one_of_each(docs).count()
        lines = line_dedup.without_repeats(docs, unit=1).filter("n_deleted > 0").count()
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)
    assert (left, lines) == (200, 0)
    written = {p.name: len(list(p.glob("part-*"))) for p in tmp_path.iterdir()}
    assert {x.rsplit("-", 1)[0] for x in written} >= {"signed", "texts", "leaders", "links", "edges", "heads", "shared-fingerprints", "first-runs"}
    assert max(written.values()) <= enough


class Task:
    """Stands for a DataFrame whose batches go through a function: keeps the function."""

    def __init__(self, function):
        self.function = function

    def _same(self, *_, **__):
        return self

    withColumn = select = _same


def _worker_peak(module, stage, docs, monkeypatch, texts) -> float:
    monkeypatch.setattr(module, "map_batches", lambda df, function, schema: Task(function))
    batch = pa.RecordBatch.from_pydict({"text": texts})

    def run(function):
        for _ in function(iter([batch])):
            pass

    return peak(run, stage(docs).function)


def test_workers_of_the_pipeline_take_part_of_a_batch_at_once(spark, monkeypatch):
    draw = random.Random(5)
    texts = [" ".join(draw.choices(["ab", "the", "of", "in", "house"], k=75_000)) for _ in range(32)]
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    assert _worker_peak(fertility, fertility.measures, docs, monkeypatch, texts) < 140
    assert _worker_peak(piece_fst, lambda x: corpus_pipeline.pieces(spark, x, ""), docs, monkeypatch, texts) < 115
