"""Byte-level BPE encoding and decoding by dynamic programming over byte prefixes.

A text is split by a pattern, and each match is encoded on its own. Of each byte prefix of a match only its last token is
stored. It is unique: a row of tokens is what merging by rank gives if and only if merging any two neighbours
alone leaves both as they are (the first merge across a border would also come first within that
pair). So the last token of a prefix is the one suffix that follows the last token of what stands before it, and
the tokens of any prefix are read off backwards.

What is stored of a prefix does not depend on what comes after it. Bytes can be appended without encoding again what is there,
and after an edit the table is computed anew only until it agrees with the old one over the length of the longest token.

Where a match as a whole is in the vocabulary, it is that token, as in the library these ranks are made for.
"""

import base64
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, islice
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from wardstream.llm.common import fields, map_batches, slices

#: The places of the ranks and of the pattern, on the driver, which hands them to the tasks.
RANKS = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
# Fixed value: the pattern that splits texts for these ranks.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Distinct matches and pairs that a task remembers before it starts anew.
REMEMBERED, PAIRS = 1 << 19, 1 << 20
#: Longer texts are split in steps, longer matches are not remembered.
STEP, SHORT = 1 << 20, 1 << 8
# Letters and numbers that came after Unicode 16.0. The ranks' library does not know them, the module that splits does.
NEWER = (
    "\u0558\u058b-\u058c\u088f\u0c5c\u0cdc\u208f\u209d-\u209f\ua7ce-\ua7cf\ua7d2\ua7d4\ua7dd\ua7e2\ua7f1\uab6c-\uab6d"
    "\U000107bb-\U000107bf\U00010940-\U00010959\U00010ec5-\U00010ec7\U00010ed9-\U00010eee\U00011b0a\U00011db0-\U00011ddb"
    "\U00011de0-\U00011de9\U00011df1\U0001246f\U00012475-\U0001247f\U00012550-\U00012686\U00016ea0-\U00016eb8"
    "\U00016ebb-\U00016ed3\U00016ff2-\U00016ff6\U000187f8-\U000187ff\U00018cd6-\U00018cda\U00018d09-\U00018d20"
    "\U00018d80-\U00018df2\U00018e00-\U00019191\U000191a0-\U000191d2\U0001b123-\U0001b128\U0001b168\U0001d6a6"
    "\U0001df1f-\U0001df24\U0001df2b-\U0001df81\U0001df90-\U0001df96\U0001dfcd-\U0001dfff\U0001e6c0-\U0001e6de"
    "\U0001e6e0-\U0001e6e2\U0001e6e4-\U0001e6e5\U0001e6e7-\U0001e6ed\U0001e6f0-\U0001e6f4\U0001e6fe-\U0001e6ff"
    "\U0002b73a-\U0002b73f\U0002b81e\U0002cea2-\U0002cead\U000323b0-\U00033479\U0003d000-\U0003fc3f"
)
#: Stands for them while a text is split: neither letter nor number nor white space.
_OTHER = "\ue000"


def read_ranks(data: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, data.splitlines())}


class PrefixTable:
    """The last token of each byte prefix of ``data``."""

    def __init__(self, bpe: "PrefixBpe", data: bytes = b""):
        self.bpe, self.data, self.last = bpe, b"", []
        self.append(data)

    def append(self, more: bytes) -> None:
        self.data += more
        self.bpe.fill(self.data, self.last, len(self.data))

    def replace(self, start: int, stop: int, new: bytes) -> int:
        """Put ``new`` in place of the bytes ``start:stop``; returns how many prefixes were computed anew."""
        old, moved = self.last, len(new) - (stop - start)
        self.data = self.data[:start] + new + self.data[stop:]
        last, reach = old[:start], self.bpe.longest
        # From here on, no token that ends here reaches back into the edit.
        end, alike = start + len(new) + reach, 0
        while len(last) < len(self.data):
            self.bpe.fill(self.data, last, len(last) + 1)
            at = len(last)
            alike = alike + 1 if at > end and last[-1] == old[at - moved - 1] else 0
            if alike == reach:
                self.last = last + old[at - moved :]
                return at - start
        self.last = last
        return len(last) - start

    def ids(self) -> list[int]:
        return self.bpe.row(self.last)


class PrefixBpe:
    """A vocabulary of byte strings and ranks, which are also the ids."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = PATTERN):
        import regex

        self.rank, self.longest = ranks, max(map(len, ranks))
        missing = [i for i in range(256) if bytes([i]) not in ranks]
        if missing:
            raise ValueError(f"bytes without a token: {missing}")
        self.split = regex.compile(pattern)
        self.newer = regex.compile(f"[{NEWER}]")
        self.beyond = re.compile(f"[^\\x00-{chr(ord(NEWER[0]) - 1)}]")
        # A place where the pattern begins a match whatever stands around it: a space between a character that is no white space and a
        # letter that no version of Unicode takes for anything else.
        self.anchor = regex.compile(r"(?<=\S) (?=[a-zA-Z])")
        self.backwards = regex.compile(r"(?r)(?<=\S) (?=[a-zA-Z])")
        size = max(ranks.values()) + 1
        self.spelled = [b""] * size
        for token, i in ranks.items():
            self.spelled[i] = token
        self.size = np.array(list(map(len, self.spelled)))
        self.first = np.cumsum(self.size) - self.size
        self.bytes = np.frombuffer(b"".join(self.spelled), np.uint8)
        # The lengths of the tokens that end in three (or, none of which is longer, two) given bytes, the longest first.
        ends: dict[bytes, set[int]] = {}
        for token in ranks:
            if len(token) > 1:
                ends.setdefault(token[-3:], {1}).add(len(token))
        for end, sizes in ends.items():
            if len(end) == 3 and end[1:] in ranks:
                sizes.add(2)
        self.lengths = {end: sorted(n, reverse=True) for end, n in ends.items()}
        self.pairs: dict[tuple[int, int], bool] = {}
        self._forget()

    def _forget(self) -> None:
        self.index = _Index()
        self.flat, self.counts = np.zeros(0, np.uint32), np.zeros(0, np.int64)

    def merged(self, data: bytes) -> list[int]:
        """Merging by rank, the leftmost of equals first: what defines the encoding."""
        parts, rank = [data[i : i + 1] for i in range(len(data))], self.rank
        while True:
            found = [(r, i) for i in range(len(parts) - 1) if (r := rank.get(parts[i] + parts[i + 1])) is not None]
            if not found:
                return [rank[p] for p in parts]
            i = min(found)[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]

    def follows(self, a: int, b: int) -> bool:
        """Whether merging the bytes of ``a`` and ``b`` leaves these two; ``a`` -1: ``b`` at the start."""
        known = self.pairs.get((a, b))
        if known is None:
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            row = [b] if a < 0 else [a, b]
            known = self.pairs[a, b] = self.merged(b"".join(self.spelled[i] for i in row)) == row
        return known

    def fill(self, data: bytes, last: list[int], stop: int) -> None:
        """Append to ``last`` the last token of each prefix of ``data`` up to ``stop``."""
        rank, lengths, pairs = self.rank, self.lengths, self.pairs
        for end in range(len(last) + 1, stop + 1):
            sizes = lengths.get(data[end - 3 : end]) if end > 2 else None
            if sizes is None:
                sizes = (2, 1) if end > 1 and data[end - 2 : end] in lengths else (1,)
            for n in sizes:
                token = rank.get(data[end - n : end]) if n <= end else None
                if token is None:
                    continue
                before = last[end - n - 1] if n < end else -1
                known = pairs.get((before, token))
                if known or known is None and self.follows(before, token):
                    last.append(token)
                    break
            else:
                raise AssertionError("a prefix without a last token")

    def row(self, last: list[int]) -> list[int]:
        """The tokens of the longest prefix, read off backwards."""
        out, end = [], len(last)
        while end:
            out.append(last[end - 1])
            end -= len(self.spelled[last[end - 1]])
        return out[::-1]

    def encode_match(self, data: bytes) -> list[int]:
        whole = self.rank.get(data)
        if whole is not None:
            return [whole]
        last: list[int] = []
        self.fill(data, last, len(data))
        return self.row(last)

    def encode_many(self, data: list[bytes]) -> list[list[int]]:
        """The ids of matches. What is stored of a prefix is kept for the next one in order of bytes that begins alike."""
        out: list[list[int]] = [[]] * len(data)
        last, before = [], b""
        for i in sorted(range(len(data)), key=data.__getitem__):
            now = data[i]
            whole = self.rank.get(now)
            if whole is not None:
                out[i] = [whole]
                continue
            same = 0
            for x, y in zip(now, before):  # noqa: B905
                if x != y:
                    break
                same += 1
            del last[same:]
            self.fill(now, last, len(now))
            out[i], before = self.row(last), now
        return out

    def matches(self, text: str) -> Iterator[list[str]]:
        """The matches of the pattern, some at a time; what it skips belongs to none."""
        shown = text
        if not text.isascii() and self.beyond.search(text) and self.newer.search(text):
            shown = self.newer.sub(_OTHER, text)
        if len(text) <= STEP and shown is text:
            yield self.split.findall(text)
            return
        found = self.split.finditer(shown)
        while some := [text[m.start() : m.end()] for m in islice(found, STEP >> 4)]:
            yield some

    def encode(self, text: str) -> list[int]:
        return [i for some in self.matches(text) for m in some for i in self.encode_match(m.encode())]

    def revise(self, text: str, ids: list[int], start: int, stop: int, new: str) -> tuple[str, list[int]]:
        """``text`` with ``new`` in place of the characters ``start:stop``, and its ids, made of ``ids``, those of ``text``.

        Only the stretch between the nearest places where a match begins in any case is encoded.
        """
        low = self.backwards.search(text, 0, max(0, start - 1))
        high = self.anchor.search(text, min(len(text), stop + 1))
        a, b = low.start() if low else 0, high.start() if high else len(text)
        head = _count(self.size, ids, len(text[:a].encode()))
        tail = _count(self.size, ids[::-1], len(text[b:].encode()))
        kept = ids[:head], ids[len(ids) - tail :]
        return text[:start] + new + text[stop:], kept[0] + self.encode(text[a:start] + new + text[stop:b]) + kept[1]

    def encode_column(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after another, and the offsets of the texts; null is empty."""
        if len(self.index) >= REMEMBERED:
            self._forget()
        codes: list[int] = []
        ends = [0]
        code = self.index.__getitem__
        long: dict[int, list[int]] = {}
        for text in pc.fill_null(column, "").to_pylist():
            for some in self.matches(text):
                if max(map(len, some), default=0) <= SHORT:
                    codes += map(code, some)
                    continue
                for match in some:
                    if len(match) > SHORT:
                        long[len(codes)] = self.encode_match(match.encode())
                        codes.append(-1)
                    else:
                        codes.append(code(match))
            ends.append(len(codes))
        rows = self.encode_many([m.encode() for m in self.index.new])
        self.index.new = []
        self.flat = np.concatenate([self.flat, np.fromiter(chain.from_iterable(rows), np.uint32)])
        self.counts = np.concatenate([self.counts, np.fromiter(map(len, rows), np.int64, len(rows))])
        flat, counts = self.flat, self.counts
        first = np.cumsum(counts) - counts
        if long:
            flat = np.concatenate([flat, *(np.asarray(x, np.uint32) for x in long.values())])
            sizes = np.array([len(x) for x in long.values()])
            more = np.cumsum(sizes) - sizes + (first[-1] + counts[-1] if len(counts) else 0)
            for n, place in enumerate(long):
                codes[place] = len(counts) + n
            counts, first = np.concatenate([counts, sizes]), np.concatenate([first, more])
        where = np.asarray(codes, np.int64)
        n = counts[where]
        total = np.concatenate([[0], np.cumsum(n)])
        take = np.repeat(first[where] - total[:-1], n) + np.arange(total[-1])
        return flat[take], total[np.asarray(ends)]

    def decode_column(self, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes that the rows of ids spell, one after another, and the offsets of the rows."""
        n = self.size[ids]
        total = np.concatenate([[0], np.cumsum(n)])
        take = np.repeat(self.first[ids] - total[:-1], n) + np.arange(total[-1])
        return self.bytes[take], total[offsets]


class _Index(dict):
    """The number of each distinct match; ``new`` ones have no ids yet."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, match: str) -> int:
        self.new.append(match)
        number = self[match] = len(self)
        return number


def _count(size: np.ndarray, ids: list[int], n_bytes: int) -> int:
    """How many of the first ``ids`` spell ``n_bytes``."""
    ends = np.concatenate([[0], np.cumsum(size[np.asarray(ids, np.int64)])])
    at = int(np.searchsorted(ends, n_bytes))
    if at > len(ids) or ends[at] != n_bytes:
        raise ValueError("the ids are not those of the text")
    return at


@lru_cache(maxsize=2)
def _compiled(data: bytes, pattern: str) -> PrefixBpe:
    """One machine for all tasks of a Python worker."""
    return PrefixBpe(read_ranks(data), pattern)


def _load(df: DataFrame, ranks: str):
    return df.sparkSession.sparkContext.broadcast(Path(ranks).read_bytes())


def _binary(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    buffers = [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))]
    return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, buffers).cast(pa.binary())


def _ids_array(ids: np.ndarray, offsets: np.ndarray, packed: bool) -> pa.Array:
    if packed:
        return _binary(ids.astype("<u4").view(np.uint8), offsets * 4)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids.astype(np.int32)))


def _ids_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The ids of a column of lists or of packed ids, and the offsets of its rows; null is empty."""
    if pa.types.is_list(column.type):
        counts = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
        ids = column.flatten().to_numpy(zero_copy_only=False)
    else:
        rows = pc.fill_null(column, b"").to_pylist()
        counts = np.array([len(x) // 4 for x in rows], np.int64)
        ids = np.frombuffer(b"".join(rows), "<u4")
    return ids.astype(np.int64), np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])


def encode(
    docs: DataFrame,
    text: str = "text",
    ids: str = "ids",
    ranks: str = RANKS,
    pattern: str = PATTERN,
    packed: bool = False,
    decoded: str | None = None,
) -> DataFrame:
    """``docs`` with the ids of the whole text in ``ids`` (replaced if there): an array of int or, ``packed``, little-endian
    unsigned 32-bit integers in a binary.

    ``decoded``: also a column of the bytes that the ids spell. A null or empty text has no ids. Repeated rows are encoded alike; no
    other column is looked at, and an empty table stays empty.
    """
    new = [ids, decoded] if decoded else [ids]
    if text in new or len(set(new)) < len(new):
        raise ValueError("results need columns of their own")
    rows, file = docs.drop(*new), _load(docs, ranks)

    def run(batches):
        bpe = _compiled(file.value, pattern)
        for batch in batches:
            for part in slices(batch, text):
                found, offsets = bpe.encode_column(part.column(text))
                out = [_ids_array(found, offsets, packed)]
                if decoded:
                    out.append(_binary(*bpe.decode_column(found.astype(np.int64), offsets)))
                yield pa.RecordBatch.from_arrays([*part.columns, *out], [*part.schema.names, *new])

    more = f"`{ids}` {'binary' if packed else 'array<int>'}" + (f", `{decoded}` binary" if decoded else "")
    return map_batches(rows, run, fields(rows, more=more))


def decode(df: DataFrame, ids: str = "ids", decoded: str = "decoded", ranks: str = RANKS) -> DataFrame:
    """``df`` with the bytes that ``ids`` (array of int, or packed) spell; null ids give a null."""
    if ids == decoded:
        raise ValueError("the result needs a column of its own")
    rows, file = df.drop(decoded), _load(df, ranks)
    in_list = isinstance(df.schema[ids].dataType, T.ArrayType)

    def run(batches):
        bpe = _compiled(file.value, PATTERN)
        for batch in batches:
            column = batch.column(ids)
            size = pc.list_value_length(column) if in_list else pc.binary_length(column)
            for part in slices(batch, pc.fill_null(size, 0), 1 << 20):
                spelled = _binary(*bpe.decode_column(*_ids_of(part.column(ids))))
                spelled = pc.if_else(part.column(ids).is_valid(), spelled, None)
                yield pa.RecordBatch.from_arrays([*part.columns, spelled], [*part.schema.names, decoded])

    return map_batches(rows, run, fields(rows, more=f"`{decoded}` binary"))


def revise(
    df: DataFrame,
    start: str = "start",
    stop: str = "stop",
    new: str = "new",
    text: str = "text",
    ids: str = "ids",
    ranks: str = RANKS,
    pattern: str = PATTERN,
) -> DataFrame:
    """``df`` after one edit a row: ``new`` in place of the characters ``start:stop`` of ``text``, and ``ids`` (an array, those
    of ``text``) brought up to date, near the edit alone. With both at the end of the text, an append.

    ``start`` and ``stop`` count code points and are cut to the text; a null in them is the end of the text, a null text or ``new`` is
    empty, and null ids are those of an empty text.
    """
    file = _load(df, ranks)

    def run(batches):
        bpe = _compiled(file.value, pattern)
        for batch in batches:
            texts, rows = [], []
            columns = (batch.column(c).to_pylist() for c in (text, ids, start, stop, new))
            for was, row, a, b, put in zip(*columns, strict=True):
                was = was or ""
                a = len(was) if a is None else min(max(a, 0), len(was))
                b = len(was) if b is None else min(max(b, a), len(was))
                one = bpe.revise(was, row or [], a, b, put or "")
                texts.append(one[0])
                rows.append(one[1])
            done = {text: pa.array(texts, pa.string()), ids: pa.array(rows, pa.list_(pa.int32()))}
            names = batch.schema.names
            yield pa.RecordBatch.from_arrays([done.get(n, batch.column(n)) for n in names], names)

    return map_batches(df, run, df.schema)
