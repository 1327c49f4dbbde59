"""SentencePiece encoding and decoding with a weighted transducer.

A text passes three machines. The normaliser rewrites it (rules, white space to the mark U+2581, a mark
in front). The piece machine reads characters and writes pieces, with an arc for each piece of the vocabulary
and byte-fallback arcs for other characters. The order machine reads pieces and allows what the
model's training order allows. Their composition with a text is searched for the shortest path in the tropical semiring
(weights add along a path, the least sum wins), arc by arc, without building it.

For a unigram model an arc weighs minus the piece's score and the order machine allows all. For a BPE model the
order machine carries the merge order: pieces a, b may follow one another only if merging the characters
of a + b by rank ends in a, b again. A path all of whose neighbours pass is what merging the whole text gives, since the
first merge across any border would also happen within that pair. So one path has finite
weight, and it is the tokenizer's own result.
"""

from array import array
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from wardstream.llm.common import fields, map_batches, slices
from wardstream.llm.wordhash import run_hashes, text_bytes

#: The model's place on the driver, which hands it to the tasks.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
#: Penalty of a character outside the vocabulary below the lowest score.
UNKNOWN_PENALTY = 10.0
#: Arcs of the order machine that a task remembers before it starts anew.
ARCS = 1 << 18
_INF = float("inf")
#: Kinds of pieces, fixed values of the model format.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


class PieceTransducer:
    """The compiled machines of one model."""

    def __init__(self, model: bytes, rules: dict[str, str] | None = None):
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(model)
        spec = proto.normalizer_spec
        if spec.precompiled_charsmap and rules is None:
            raise ValueError("give the model's normalisation rules as a table")
        kinds = {p.type for p in proto.pieces}
        if proto.trainer_spec.model_type not in (UNIGRAM, BPE) or kinds & {USER, UNUSED}:
            raise ValueError("only unigram and BPE models of plain and byte pieces are compiled")
        self.bpe = proto.trainer_spec.model_type == BPE
        self.rules = dict(rules or {})
        self.longest_rule = max(map(len, self.rules), default=0)
        self.prefix, self.squeeze = spec.add_dummy_prefix, spec.remove_extra_whitespaces
        self.text = [p.piece for p in proto.pieces]
        self.id = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == NORMAL}
        self.score = {p.piece: p.score for p in proto.pieces if p.type == NORMAL}
        self.byte = {int(p.piece[3:-1], 16): i for i, p in enumerate(proto.pieces) if p.type == BYTE}
        self.unknown = next(i for i, p in enumerate(proto.pieces) if p.type == UNKNOWN)
        self.is_byte = np.array([p.type == BYTE for p in proto.pieces])
        self.longest = max(map(len, self.id))
        # Lengths in the order they are tried, short ones first; for texts of n, those up to n.
        self.sizes = sorted(range(1, self.longest + 1), key=lambda n: (n > 3, n == 1, n))
        self.upto = [max((i + 1 for i, x in enumerate(self.sizes) if x <= n), default=0) for n in range(self.longest)]
        self.floor = min(self.score.values()) - UNKNOWN_PENALTY
        #: If no piece goes on after white space, a text falls apart before each run of marks.
        self.splits = not any(MARK in p.lstrip(MARK) for p in self.id)
        self.arcs: dict[tuple[str, str], bool] = {}
        # Decoding: the bytes each id stands for.
        self.spelled = [
            b"" if p.type == CONTROL else bytes([int(p.piece[3:-1], 16)]) if p.type == BYTE
            else " ⁇ ".encode() if p.type == UNKNOWN else p.piece.replace(MARK, " ").encode()
            for p in proto.pieces
        ]
        self.spelled_size = np.array(list(map(len, self.spelled)))
        self.spelled_at = np.cumsum(self.spelled_size) - self.spelled_size
        self.spelled_bytes = np.frombuffer(b"".join(self.spelled), np.uint8)

    def normalise(self, text: str) -> str:
        """The normaliser: longest rule first, then white space."""
        if self.rules:
            out, i = [], 0
            while i < len(text):
                for n in range(min(self.longest_rule, len(text) - i), 0, -1):
                    if (new := self.rules.get(text[i : i + n])) is not None:
                        break
                else:
                    n, new = 1, text[i]
                out.append(new)
                i += n
            text = "".join(out)
        if self.squeeze:
            text = " ".join(x for x in text.replace(MARK, " ").split(" ") if x)
        text = text.replace(" ", MARK)
        return MARK + text if self.prefix and text else text

    def _follows(self, a: str, b: str) -> bool:
        """The order machine's arc from piece ``a`` to piece ``b`` (``a`` empty: at the start).

        The characters are merged by rank, the leftmost of equals first; the arc is there if no merge
        crosses the border and the two pieces are what is left.
        """
        symbols, border, score = [*a, *b], len(a), self.score
        while True:
            best, at = -_INF, -1
            for i in range(len(symbols) - 1):
                rank = score.get(symbols[i] + symbols[i + 1])
                if rank is not None and rank > best:
                    best, at = rank, i
            if at < 0:
                return symbols == ([a, b] if a else [b])
            if at + 1 == border:
                return False
            border -= at < border
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]

    def follows(self, a: str, b: str) -> bool:
        known = self.arcs.get((a, b))
        if known is None:
            if len(self.arcs) >= ARCS:
                self.arcs.clear()
            known = self.arcs[a, b] = self._follows(a, b)
        return known

    def paths(self, texts: list[str]) -> Iterator[list[str]]:
        """The pieces of the shortest path through each normalised text.

        What is known of the places in a text depends only on what stands before them, so it is kept
        for the prefix shared with the next text; sorted texts share most.
        """
        cost, back, last = [0.0], [""], ""
        longest, sizes, bpe = self.longest, self.sizes, self.bpe
        get, arcs = self.score.get, self.arcs
        for text in texts:
            n, keep = len(text), 0
            for x, y in zip(text, last):  # noqa: B905
                if x != y:
                    break
                keep += 1
            del cost[keep + 1 :], back[keep + 1 :]
            last = text
            for end in range(keep + 1, n + 1):
                least, by = _INF, ""
                for size in sizes if end >= longest else sizes[: self.upto[end]]:
                    if size > end:
                        continue
                    before = end - size
                    piece = text[before:end]
                    score = get(piece)
                    if score is None:
                        if size > 1:
                            continue
                        score = self.floor
                    if not bpe:
                        if cost[before] - score < least:
                            least, by = cost[before] - score, piece
                        continue
                    known = arcs.get((back[before], piece))
                    if known or known is None and self.follows(back[before], piece):
                        least, by = 0.0, piece
                        break  # no other path to this place is finite
                cost.append(least)
                back.append(by)
            out = []
            while n:
                out.append(back[n])
                n -= len(back[n])
            yield out[::-1]

    def path(self, text: str) -> list[str]:
        return next(self.paths([text]))

    def ids(self, path: list[str]) -> list[int]:
        """The ids along a path: the order of byte-fallback arcs for a character without a piece."""
        out: list[int] = [self.id.get(p, -1) for p in path]
        if -1 not in out:
            return out
        out = []
        for piece in path:
            one = self.id.get(piece)
            if one is not None:
                out.append(one)
            elif self.byte:
                out += [self.byte[b] for b in piece.encode()]
            elif not out or out[-1] != self.unknown:
                out.append(self.unknown)
        return out

    def encode(self, text: str) -> list[int]:
        return self.ids(self.path(self.normalise(text)))


def _load(model: str) -> bytes:
    return Path(model).read_bytes()


def _ids(column: pa.Array, fst: PieceTransducer) -> pa.Array:
    """The ids of each text: the distinct stretches of all texts are searched once."""
    if fst.rules or fst.squeeze or not fst.splits:
        texts = [fst.normalise(x or "") for x in column.to_pylist()]
        return pa.array(map(fst.ids, fst.paths(texts)), pa.list_(pa.int32()))
    column = pc.replace_substring(pc.fill_null(column, ""), MARK, " ")
    if fst.prefix:
        column = pc.if_else(pc.equal(column, ""), "", pc.binary_join_element_wise(" ", column, ""))
    data, offsets = text_bytes(column)
    del column
    space = data == 0x20
    begins = np.zeros(len(data), bool)
    begins[1:] = space[1:] & ~space[:-1]
    begins[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
    start = np.flatnonzero(begins)
    del space, begins
    end = np.append(start[1:], len(data))[: len(start)]
    _, one, where = np.unique(run_hashes(data, start, end), return_index=True, return_inverse=True)
    where = where.astype(np.int32)
    ends = np.searchsorted(start, offsets)
    bounds = np.stack([start[one], end[one]], 1).tolist()
    del start, end
    stretches = [data[a:b].tobytes().decode().replace(" ", MARK) for a, b in bounds]
    del data, bounds
    order = sorted(range(len(one)), key=stretches.__getitem__)
    ids, first = array("i"), np.zeros(len(one) + 1, np.int32)
    for i, path in enumerate(fst.paths([stretches[i] for i in order])):
        ids.extend(fst.ids(path))
        first[i + 1] = len(ids)
    del stretches
    place = np.empty(len(one), np.int32)
    place[order] = np.arange(len(one), dtype=np.int32)
    del order
    # The ids of each distinct stretch, at each place where it stands.
    each = pa.ListArray.from_arrays(pa.array(first), pa.array(np.frombuffer(ids, np.int32), pa.int32())).take(pa.array(place[where]))
    total = each.offsets.to_numpy()
    return pa.ListArray.from_arrays(pa.array(total[ends] - total[0]), each.flatten())


def _texts(column: pa.Array, fst: PieceTransducer) -> pa.Array:
    """The text of each list of ids, without the mark in front."""
    ids = column.flatten().to_numpy(zero_copy_only=False)
    counts = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    n = fst.spelled_size[ids]
    take = np.repeat(fst.spelled_at[ids] - np.cumsum(n) + n, n) + np.arange(n.sum())
    data = fst.spelled_bytes[take]
    ends = np.concatenate([[0], np.cumsum(n)])[np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])]
    buffers = [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(data)]
    texts = pa.Array.from_buffers(pa.large_string(), len(column), buffers)
    try:
        texts.validate(full=True)
    except pa.ArrowInvalid:  # ids that spell no text: as the decoder of UTF-8 mends it
        raw = data.tobytes()
        texts = pa.array([raw[a:b].decode("utf-8", "replace") for a, b in zip(ends, ends[1:], strict=False)], pa.large_string())
    if fst.prefix:
        texts = pc.if_else(pc.starts_with(texts, " "), pc.utf8_slice_codeunits(texts, 1), texts)
    return pc.if_else(column.is_valid(), texts, None).cast(pa.string())


def _spelled_again(column: pa.Array, ids: pa.Array, fst: PieceTransducer) -> pa.Array:
    """Whether each list of ids spells its text, marks U+2581 as spaces."""
    out, done = [], 0
    for part in slices(pa.RecordBatch.from_arrays([column], ["text"]), "text", 2 << 20):
        written = pc.replace_substring(pc.fill_null(part.column("text"), ""), MARK, " ")
        out.append(pc.equal(_texts(ids.slice(done, part.num_rows), fst), written))
        done += part.num_rows
    return pa.concat_arrays(out)


def encode(
    docs: DataFrame,
    text: str = "text",
    ids: str = "ids",
    model: str = MODEL,
    rules: dict[str, str] | None = None,
    again: str | None = None,
    at_once: int = 8 << 20,
) -> DataFrame:
    """``docs`` with the piece ids of the whole text in ``ids`` (array of int; replaced if there).

    ``again``: also a column that tells whether decoding the ids gives the text back, with
    every mark U+2581 as a space (for models without rules). ``at_once``: bytes of text in a search; the ids do not depend on it.

    A null or empty text has no pieces. Repeated rows are encoded alike; no other column is
    looked at, and an empty table stays empty.
    """
    if text in (ids, again):
        raise ValueError("results need columns of their own")
    rows = docs.drop(ids, *([again] if again else []))
    file = docs.sparkSession.sparkContext.broadcast(_load(model))
    new = [ids, again] if again else [ids]

    def run(batches):
        fst = PieceTransducer(file.value, rules)
        for batch in batches:
            # The more texts at once, the fewer stretches are searched twice.
            for part in slices(batch, text, at_once):
                found = [_ids(part.column(text), fst)]
                if again:
                    found.append(_spelled_again(part.column(text), found[0], fst))
                yield pa.RecordBatch.from_arrays([*part.columns, *found], [*part.schema.names, *new])

    check = f", `{again}` boolean" if again else ""
    return map_batches(rows, run, fields(rows, more=f"`{ids}` array<int>{check}"))


def decode(df: DataFrame, ids: str = "ids", text: str = "decoded", model: str = MODEL) -> DataFrame:
    """``df`` with the text that ``ids`` spells (replaced if there); null ids give a null text."""
    if ids == text:
        raise ValueError("text needs a column of its own")
    rows = df.drop(text)
    file = df.sparkSession.sparkContext.broadcast(_load(model))

    def run(batches):
        fst = PieceTransducer(file.value, {})
        for batch in batches:
            sizes = pc.fill_null(pc.list_value_length(batch.column(ids)), 0)
            for part in slices(batch, sizes, 1 << 20):
                found = _texts(part.column(ids), fst)
                yield pa.RecordBatch.from_arrays([*part.columns, found], [*part.schema.names, text])

    return map_batches(rows, run, fields(rows, more=f"`{text}` string"))


def byte_range(model: str = MODEL) -> tuple[int, int]:
    """The first and last id of the byte pieces, which stand together; (0, -1) if there are none."""
    found = np.flatnonzero(PieceTransducer(_load(model), {}).is_byte)
    if len(found) and found[-1] - found[0] + 1 != len(found):
        raise ValueError("the byte pieces do not stand together")
    return (int(found[0]), int(found[-1])) if len(found) else (0, -1)
