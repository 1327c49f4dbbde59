"""Alignment of two tokenizers' tokens over the same text.

Both sides tell where, in bytes, each of their tokens ends. While the ends of the one at i and of the other at i + shift are
equal, tokens match one to one: blocks of ends at that shift, of doubling length, are compared until one differs, and the run's
length is found by halving. Where ends differ, the side that is behind moves on by a token until both end together: an irregular
group, after which the shift is another. So a text is cut into groups wherever tokens of both sides end.

Two tokens are linked if they have bytes in common. How many documents link a pair of ids is a statement on the whole corpus.
Tasks count pairs by block (a few MB of text), the counts of all blocks are added up by pair, and each block is handed the
counts of its own pairs, a number bounded by its text; no table of all pairs is held anywhere.

Tokenizers are applied to distinct stretches of text, which begin at spaces that both split at whatever stands around.
"""

import hashlib
import json
import os
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardstream.llm.common import fields, fresh, map_batches, slices
from wardstream.llm.wordhash import text_bytes
from wardstream.session import materialise

#: The tokenizers' places on the driver, which hands them to the tasks.
BYTE_LEVEL = "/opt/tokenizers/byte_bpe_50k.json"
PIECES = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
#: Bytes of text in a block, and of those aligned at once; distinct stretches a task remembers; stretches in a window.
BLOCK, PART, REMEMBERED, WINDOW = 16 << 20, 2 << 20, 1 << 18, 1 << 18


def _byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: printable ones for themselves, others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class ByteLevel:
    """A byte-level tokenizer of a JSON file, applied to a space and the text."""

    def __init__(self, file: bytes):
        # One core a task, as Spark reckons.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(file.decode())
        self.tokenizer.encode_special_tokens = True
        alphabet = _byte_alphabet()
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.spelled = [b""] * (max(self.tokenizer.get_vocab().values()) + 1)
        for token, i in vocabulary.items():
            self.spelled[i] = bytes(alphabet[c] for c in token)
        state = json.loads(file)
        if state.get("normalizer") or (state["pre_tokenizer"] or {}).get("type") != "ByteLevel":
            raise ValueError("only byte-level tokenizers without a normaliser")

    def encode(self, texts: list[str]) -> list[list[int]]:
        spaced = [f" {t}" for t in texts]
        return [e.ids for e in self.tokenizer.encode_batch_fast(spaced, add_special_tokens=False)]


class Pieces:
    """A SentencePiece model, which puts a space before the text by itself."""

    def __init__(self, file: bytes):
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

        self.processor = SentencePieceProcessor(model_proto=file)
        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(file)
        spec = proto.normalizer_spec
        if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.add_dummy_prefix:
            raise ValueError("only models that leave the text as it is and put a space before it")
        inside = [p.piece for p in proto.pieces if MARK in p.piece.lstrip(MARK)]
        if inside:
            raise ValueError(f"pieces that go on after a space: {inside[:3]}")
        # Kind 6 is a byte, 1 a plain piece: fixed values of the model format.
        self.spelled = [
            bytes([int(p.piece[3:-1], 16)]) if p.type == 6 else p.piece.replace(MARK, " ").encode() if p.type == 1 else b""
            for p in proto.pieces
        ]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.processor.encode(texts, num_threads=1)


def group_starts(a: list[int], b: list[int]) -> tuple[list[tuple[int, int, int]], list[int], list[int]]:
    """Two rows of ends that end together, cut where both have an end.

    Returns the one-to-one runs (place in ``a``, place in ``b``, length) and the places where irregular groups begin in ``a`` and in ``b``.
    """
    runs, group_a, group_b = [], [], []
    i = j = 0
    n = len(a)
    # Past the ends nothing is equal.
    a, b = [*a, -1], [*b, -2]
    while i < n:
        x, y = a[i], b[j]
        if x == y:
            k, step = 1, 1
            while a[i + k : i + k + step] == b[j + k : j + k + step] and i + k < n:
                k += step
                step *= 2
            while step > 1:
                step //= 2
                if a[i + k : i + k + step] == b[j + k : j + k + step]:
                    k += step
            runs.append((i, j, k))
            i += k
            j += k
            if i >= n:
                break
            x, y = a[i], b[j]
        group_a.append(i)
        group_b.append(j)
        while x != y:
            if x < y:
                i += 1
                x = a[i]
            else:
                j += 1
                y = b[j]
        i += 1
        j += 1
    return runs, group_a, group_b


def overlaps(end_a: np.ndarray, end_b: np.ndarray, group_a: np.ndarray, group_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places of tokens that have bytes in common, given the ends of all tokens and where groups begin, and one more."""
    sizes_a, sizes_b = np.diff(group_a), np.diff(group_b)
    single = (sizes_a == 1) & (sizes_b == 1)
    one_a, one_b = group_a[:-1][single], group_b[:-1][single]
    # In an irregular group each stretch between neighbouring ends of either side is of one pair, and each pair has one.
    ends = np.sort(np.concatenate([end_a[np.repeat(~single, sizes_a)], end_b[np.repeat(~single, sizes_b)]]))
    ends = ends[np.append(True, ends[1:] != ends[:-1])] if len(ends) else ends
    return np.concatenate([one_a, np.searchsorted(end_a, ends)]), np.concatenate([one_b, np.searchsorted(end_b, ends)])


@dataclass
class Aligned:
    """Tokens, groups and links of the texts of a block; those of text t are ``first_x[t]:first_x[t + 1]``.

    ``group_a`` and ``group_b`` are the places where groups begin, one more than there are groups; ``link_a`` and ``link_b`` the places of
    linked tokens. Texts that a side does not spell have none.
    """

    a: np.ndarray
    b: np.ndarray
    first_a: np.ndarray
    first_b: np.ndarray
    group_a: np.ndarray
    group_b: np.ndarray
    first_group: np.ndarray
    link_a: np.ndarray
    link_b: np.ndarray


def _gather(flat: np.ndarray, counts: np.ndarray, where: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows ``where`` of a list of rows, one after another, and their offsets."""
    first = np.cumsum(counts) - counts
    n = counts[where]
    total = np.concatenate([[0], np.cumsum(n)])
    return flat[np.repeat(first[where] - total[:-1], n) + np.arange(total[-1])], total


class Aligner:
    def __init__(self, side_a: ByteLevel, side_b: Pieces):
        self.sides = side_a, side_b
        self.size = [np.array(list(map(len, s.spelled)), np.int64) for s in self.sides]
        self.width = len(side_b.spelled)
        many = max(map(len, self.size))
        #: The text of each id with a comma, a bar or a semicolon after it.
        self.words = np.array([f"{i}{c}" for i in range(many) for c in ",|;"], object)
        self._forget()

    def _forget(self, keep: np.ndarray | None = None) -> None:
        """Forget all stretches, but those of the numbers ``keep``."""
        if keep is None:
            self.known: dict[bytes, int] = {}
            self.flat = [np.zeros(0, np.int64), np.zeros(0, np.int64)]
            self.counts = [np.zeros(0, np.int64), np.zeros(0, np.int64)]
            self.right, self.uses = np.zeros(0, bool), np.zeros(0, np.int64)
            return
        self.flat = [_gather(f, c, keep)[0] for f, c in zip(self.flat, self.counts, strict=True)]
        self.counts = [c[keep] for c in self.counts]
        self.right, self.uses = self.right[keep], self.uses[keep] // 2
        number = np.full(len(self.known), -1)
        number[keep] = np.arange(len(keep))
        number = number.tolist()
        self.known = {s: number[i] for s, i in self.known.items() if number[i] >= 0}

    def _learn(self, stretches: list[bytes]) -> np.ndarray:
        """The numbers of stretches, of which new ones are encoded by both sides."""
        if len(self.known) >= REMEMBERED:
            # Those met in most parts stay.
            most = np.argsort(-self.uses, kind="stable")[: REMEMBERED // 2]
            self._forget(np.sort(most[self.uses[most] > 1]))
        new = [s for s in stretches if s not in self.known]
        for k in range(0, len(new), 1 << 13):
            self._encode(new[k : k + (1 << 13)])
        found = np.fromiter(map(self.known.__getitem__, stretches), np.int64, len(stretches))
        self.uses[found] += 1
        return found

    def _encode(self, new: list[bytes]) -> None:
        texts = [s[1:].decode() for s in new]
        right, rows, sizes = np.ones(len(new), bool), [], []
        bytes_ = np.fromiter(map(len, new), np.int64, len(new))
        for side, size in zip(self.sides, self.size, strict=True):
            ids = side.encode(texts)
            n = np.fromiter(map(len, ids), np.int64, len(ids))
            flat = np.fromiter(chain.from_iterable(ids), np.int64, n.sum())
            if b"".join(map(side.spelled.__getitem__, flat.tolist())) != b"".join(new) or not np.array_equal(
                np.add.reduceat(np.append(size[flat], 0), np.cumsum(n) - n), bytes_
            ):
                right &= [b"".join(map(side.spelled.__getitem__, row)) == s for row, s in zip(ids, new, strict=True)]
            rows.append(flat)
            sizes.append(n)
        for x in (0, 1):
            self.flat[x] = np.concatenate([self.flat[x], rows[x][np.repeat(right, sizes[x])]])
            self.counts[x] = np.concatenate([self.counts[x], np.where(right, sizes[x], 0)])
        first = len(self.known)
        self.known.update(zip(new, range(first, first + len(new)), strict=True))
        self.right = np.concatenate([self.right, right])
        self.uses = np.concatenate([self.uses, np.zeros(len(new), np.int64)])

    def tokens(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of both sides, and the offsets of texts in them; and the places in both where stretches begin."""
        empty = pc.fill_null(pc.equal(column, ""), True)
        spaced = pc.if_else(empty, "", pc.binary_join_element_wise(" ", column, ""))
        data, offsets = text_bytes(spaced)
        # A space between two characters that are neither white space nor the mark: printable ASCII, or U+00C0 to U+07FF.
        low = (data > 0x20) & (data < 0x7F)
        two = (data >= 0xC3) & (data <= 0xDF)
        begins = np.zeros(len(data) + 1, bool)
        if len(data) > 2:
            before = low.copy()
            before[1:] |= two[:-1] & (data[1:] >= 0x80) & (data[1:] < 0xC0)
            begins[1 : len(data) - 1] = (data[1:-1] == 0x20) & before[:-2] & (low | two)[2:]
        begins[offsets] = True
        edges = np.flatnonzero(begins)
        n = len(edges) - 1
        buffers = [None, pa.py_buffer(edges.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))]
        coded = pa.Array.from_buffers(pa.large_binary(), n, buffers).dictionary_encode()
        number = self._learn(coded.dictionary.to_pylist())
        where = number[coded.indices.to_numpy(zero_copy_only=False)] if n else np.zeros(0, np.int64)
        at = np.searchsorted(edges, offsets)
        # A text of which a stretch is not spelled by a side has no tokens at all.
        wrong = np.concatenate([[0], np.cumsum(~self.right[where])])
        whole = wrong[at[1:]] == wrong[at[:-1]]
        stays = np.repeat(whole, np.diff(at))
        where = where[stays]
        at = np.concatenate([[0], np.cumsum(np.where(whole, np.diff(at), 0))])
        out = []
        for x in (0, 1):
            ids, starts = _gather(self.flat[x], self.counts[x], where)
            out.append((ids, starts[at], starts))
        (a, first_a, starts_a), (b, first_b, starts_b) = out
        return a, b, first_a, first_b, np.stack([starts_a, starts_b])

    def align(self, column: pa.Array) -> Aligned:
        a, b, first_a, first_b, starts = self.tokens(column)
        end_a, end_b = np.cumsum(self.size[0][a]), np.cumsum(self.size[1][b])
        starts_a, starts_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        # Stretches end together, so they can be aligned some at a time.
        for k in range(0, starts.shape[1] - 1, WINDOW):
            to = min(k + WINDOW, starts.shape[1] - 1)
            (a0, b0), (a1, b1) = starts[:, k].tolist(), starts[:, to].tolist()
            runs, irregular_a, irregular_b = group_starts(end_a[a0:a1].tolist(), end_b[b0:b1].tolist())
            run = np.array(runs, np.int64).reshape(-1, 3)
            inside = np.arange(run[:, 2].sum()) - np.repeat(np.cumsum(run[:, 2]) - run[:, 2], run[:, 2])
            group_a = np.concatenate([np.repeat(run[:, 0], run[:, 2]) + inside, irregular_a]).astype(np.int64)
            group_b = np.concatenate([np.repeat(run[:, 1], run[:, 2]) + inside, irregular_b]).astype(np.int64)
            order = np.argsort(group_a, kind="stable")
            starts_a.append(group_a[order] + a0)
            starts_b.append(group_b[order] + b0)
        group_a, group_b = np.concatenate(starts_a), np.concatenate(starts_b)
        first_group = np.searchsorted(group_a, first_a)
        group_a, group_b = np.append(group_a, len(a)), np.append(group_b, len(b))
        links = overlaps(end_a, end_b, group_a, group_b)
        return Aligned(a, b, first_a, first_b, group_a, group_b, first_group, *links)

    def spelled(self, found: Aligned) -> Iterator[str]:
        """The groups of each text: ids of a side joined by commas, sides by a bar, groups by semicolons."""
        sizes_a, sizes_b = np.diff(found.group_a), np.diff(found.group_b)
        codes = np.zeros(len(found.a) + len(found.b), np.int64)
        # Before a token stand all tokens of its side, and those of the other side's groups up to it.
        at_a = np.arange(len(found.a)) + np.repeat(found.group_b[:-1], sizes_a)
        at_b = np.arange(len(found.b)) + np.repeat(found.group_a[1:], sizes_b)
        codes[at_a], codes[at_b] = found.a * 3, found.b * 3
        codes[at_a[found.group_a[1:] - 1]] += 1
        codes[at_b[found.group_b[1:] - 1]] += 2
        ends = (found.first_a + found.first_b).tolist()
        for x, y in zip(ends, ends[1:], strict=False):
            yield "".join(self.words[codes[x:y]])[:-1]


@lru_cache(maxsize=2)
def _compiled(a: bytes, b: bytes) -> Aligner:
    """One aligner for all tasks of a Python worker."""
    return Aligner(ByteLevel(a), Pieces(b))


def _files(df: DataFrame, a: str, b: str) -> Callable[[], Aligner]:
    context = df.sparkSession.sparkContext
    files = [context.broadcast(Path(p).read_bytes()) for p in (a, b)]
    return lambda: _compiled(files[0].value, files[1].value)


def _lists(flat: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat).cast(kind))


def align(docs: DataFrame, text: str = "text", a: str = BYTE_LEVEL, b: str = PIECES, out: str = "alignment") -> DataFrame:
    """``docs`` with the alignment of the whole text in ``out`` (replaced if there): the ids of both sides, ``a`` and ``b``, and how many
    ids of each side there are up to the end of each group, ``ends_a`` and ``ends_b``.

    Text is taken with a space before it. Where a text is null or empty, or the bytes of a side's tokens are not those of the space
    and the text, all lists are empty. Repeated rows are aligned alike; no other column is looked at, and an empty table stays empty.
    """
    if out == text:
        raise ValueError("the result needs a column of its own")
    rows, aligner = docs.drop(out), _files(docs, a, b)

    def run(batches):
        one = aligner()
        for batch in batches:
            for part in slices(batch, text, PART):
                found = one.align(part.column(text))
                groups = np.diff(found.first_group)
                ends_a = found.group_a[1:] - np.repeat(found.first_a[:-1], groups)
                ends_b = found.group_b[1:] - np.repeat(found.first_b[:-1], groups)
                sides = [
                    _lists(found.a, found.first_a, pa.int32()),
                    _lists(found.b, found.first_b, pa.int32()),
                    _lists(ends_a, found.first_group, pa.int32()),
                    _lists(ends_b, found.first_group, pa.int32()),
                ]
                column = pa.StructArray.from_arrays(sides, ["a", "b", "ends_a", "ends_b"])
                yield pa.RecordBatch.from_arrays([*part.columns, column], [*part.schema.names, out])

    kind = "struct<a: array<int>, b: array<int>, ends_a: array<int>, ends_b: array<int>>"
    return map_batches(rows, run, fields(rows, more=f"`{out}` {kind}"))


#: What :func:`linked` adds.
FOUND = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"


def _block_rows(aligner: Callable[[], Aligner], text: str, block: str, pairs: str, times: str):
    """Rows of documents, with their distinct pairs and how often each is linked, and, after those of a block, one more
    with the block's distinct pairs and how many of its documents have each."""
    from pyspark import TaskContext

    def run(batches):
        one = aligner()
        wide = np.int64(len(one.size[0])) * one.width
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for whole in slices(batch, text, BLOCK):
                seen = []
                for part in slices(whole, text, PART):
                    found = one.align(part.column(text))
                    doc = np.searchsorted(found.first_a, found.link_a, side="right") - 1
                    n_links = np.bincount(doc, minlength=part.num_rows)
                    key = doc * wide + found.a[found.link_a] * one.width + found.b[found.link_b]
                    key, n = np.unique(key, return_counts=True)
                    pair = key % wide
                    seen.append(np.unique(pair, return_counts=True))
                    first = np.searchsorted(key, np.arange(part.num_rows + 1) * wide)
                    digest = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in one.spelled(found)]
                    numbers = np.diff(found.first_a), np.diff(found.first_b), np.diff(found.first_group), n_links
                    keep = [c for c in part.schema.names if c != text]
                    columns = [part.column(c) for c in keep]
                    columns += [*map(pa.array, numbers), pa.array(digest, pa.string())]
                    columns += [pa.array(np.full(part.num_rows, number))]
                    columns += [_lists(pair, first, pa.int64()), _lists(n, first, pa.int64())]
                    names = [*keep, "n_a", "n_b", "n_groups", "n_links", "groups_sha256", block, pairs, times]
                    yield pa.RecordBatch.from_arrays(columns, names)
                held, where = np.unique(np.concatenate([p for p, _ in seen]), return_inverse=True)
                docs = np.bincount(where, np.concatenate([n for _, n in seen]), minlength=len(held)).astype(np.int64)
                none = [pa.nulls(1, c.type) for c in columns[:-3]]
                last = [pa.array([-1 - number]), pa.array([held], pa.list_(pa.int64())), pa.array([docs], pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays([*none, *last], names)
                number += 1

    return run


def linked(
    docs: DataFrame, text: str = "text", a: str = BYTE_LEVEL, b: str = PIECES
) -> tuple[DataFrame, DataFrame]:
    """Two tables: ``docs`` without the text and with what the corpus says of its links, and the pairs themselves.

    The first has ``n_a`` and ``n_b`` (tokens), ``n_groups``, ``n_links``, ``n_best`` (links whose pair no other of the same id ``a``
    exceeds in documents), ``count_sum`` (documents of each link's pair, added up) and ``groups_sha256`` of the groups as text
    (``a1,a2|b1;a3|b2``; empty without tokens); columns of these names are replaced. The second has a row for each pair linked anywhere:
    ``a``, ``b``, ``documents`` and whether it is ``best``.

    Which texts have no tokens, :func:`align` says; all their numbers are 0. Each row counts as a document, repeated ones too.
    An empty table gives two empty ones.
    """
    new = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    rows = docs.drop(*(c for c in new if c != text))
    kept = rows.drop(text)
    block, pairs, times = fresh(kept, "block", "pairs", "times")
    declared = fields(kept, more=f"{FOUND}, `{block}` long, `{pairs}` array<long>, `{times}` array<long>")
    aligner = _files(docs, a, b)
    stored = materialise(map_batches(rows, _block_rows(aligner, text, block, pairs, times), declared), "alignment")
    width = len(Pieces(Path(b).read_bytes()).spelled)

    held = F.explode(F.arrays_zip(F.col(pairs).alias("pair"), F.col(times).alias("n"))).alias("x")
    of_blocks = stored.filter(F.col(block) < 0).select((-1 - F.col(block)).alias("block"), held)
    of_blocks = of_blocks.select("block", "x.pair", "x.n")
    # Stored, so that nothing stands between an exchange and the join, which may then split a pair that every block has.
    summed = of_blocks.groupBy("pair").agg(F.sum("n").alias("documents"))
    summed = summed.withColumn("a", F.expr(f"pair div {width}L"))
    top = summed.groupBy("a").agg(F.max("documents").alias("most"))
    counts = materialise(summed.join(top, "a").select("pair", "documents", (F.col("documents") == F.col("most")).alias("best")), "pairs")
    known = of_blocks.drop("n").join(counts, "pair").select("block", "pair", "documents", "best")

    names = [f.name for f in declared][:-3]
    out = fields(kept, more=f"{FOUND}, n_best long, count_sum long")

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        pair = right.column("pair").to_numpy()
        order = np.argsort(pair)
        documents = right.column("documents").to_numpy()[order]
        best = right.column("best").to_numpy(zero_copy_only=False)[order]
        left = left.combine_chunks()
        listed = left.column(pairs).combine_chunks()
        size = pc.list_value_length(listed).to_numpy(zero_copy_only=False)
        of = np.repeat(np.arange(left.num_rows), size)
        at = np.searchsorted(pair[order], listed.flatten().to_numpy())
        n = left.column(times).combine_chunks().flatten().to_numpy()
        found = []
        for x in (n * best[at], n * documents[at]):
            total = np.concatenate([[0], np.cumsum(x)])
            ends = np.concatenate([[0], np.cumsum(size)])
            found.append(pa.array(total[ends[1:]] - total[ends[:-1]], pa.int64()))
        return left.select(names).append_column("n_best", found[0]).append_column("count_sum", found[1])

    of_docs = stored.filter(F.col(block) >= 0)
    scored = of_docs.groupBy(block).cogroup(known.groupBy("block")).applyInArrow(score, out)
    table = counts.select(
        F.expr(f"pair div {width}L").cast("int").alias("a"), F.expr(f"pair % {width}L").cast("int").alias("b"), "documents", "best"
    )
    return scored, table
