"""Quality rules by tokeniser fertility.

Public vocabularies tell prose from noise: text that a vocabulary covers badly falls into many short tokens
(few characters a token), into raw bytes (byte fallback), or into a few tokens over and over (low entropy). Each
document is measured over its whole text and kept if every measure lies in the band of its language, or
else of its script.

Words are tokenised one by one, each with a space before it, and each distinct word once per slice of texts.
Byte fallback is measured in bytes: those of a document's words that the piece vocabulary spells byte by byte.
"""

import base64
import re
import unicodedata
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardstream.llm.common import fields, map_batches, slices
from wardstream.llm.wordhash import SOLID, grams, mix, text_bytes, words

#: Where the public vocabularies lie on the driver, which hands them to the tasks (1.4 MB).
VOCABULARIES = "/opt/tokenizers"
RANKS = "byte_bpe_multi_50k.tiktoken"
PIECES = "piece_bpe_32k.model"
#: Bytes of words tokenised in one call.
RUN = 1 << 16


#: A few odd words (a key, a number) weigh much in a short text: its least characters per token are lower by this over the
#: root of its words.
SLACK = 0.6


@dataclass(frozen=True)
class Band:
    """What is kept, both ends included."""

    chars_per_token: tuple[float, float] = (1.0, 12.0)
    byte_share: tuple[float, float] = (0.0, 0.2)
    entropy: tuple[float, float] = (3.0, 16.0)
    #: A short text has few tokens, and so little entropy: its least is lower by this over the root of its tokens.
    entropy_slack: float = 0.0


#: By the table's language code, set from labelled documents that pass the base rules: close below the lowest clean one of sf0.01,
#: sf0.1 and check_l, with what short texts are given (characters per token 1.91, 1.90, 1.94, 1.88; entropy 6.71, 6.79, 6.76, 6.80).
LANGUAGES = {
    "en": Band((1.88, 12.0), entropy=(6.68, 16.0), entropy_slack=16.0),
    "de": Band((1.88, 12.0), entropy=(6.75, 16.0), entropy_slack=16.0),
    "es": Band((1.92, 12.0), entropy=(6.72, 16.0), entropy_slack=16.0),
    "fr": Band((1.85, 12.0), entropy=(6.76, 16.0), entropy_slack=16.0),
}
#: By the script of most letters, for other or missing languages.
SCRIPTS = {
    "LATIN": Band((1.7, 12.0)),
    "CYRILLIC": Band((1.2, 12.0)),
    "GREEK": Band((0.8, 12.0)),
    "CJK": Band((0.4, 12.0), (0.0, 0.6)),
    "HIRAGANA": Band((0.4, 12.0), (0.0, 0.6)),
    "HANGUL": Band((0.3, 12.0), (0.0, 0.9)),
}
OTHER = Band((0.2, 12.0), (0.0, 1.0))

MEASURES = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
    "n_tokens bigint, chars_per_token double, byte_share double, entropy double, script string"
)
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_IN_LINE = np.ones(256, bool)
_IN_LINE[10] = False


class _Vocabulary:
    """Tokens of distinct words under the public vocabularies."""

    def __init__(self, ranks: bytes, pieces: bytes):
        import public_tokenizers
        import sentencepiece
        import tiktoken

        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        self.bpe = tiktoken.Encoding(
            "fertility", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={}
        )
        self.opens = np.zeros(max(table.values()) + 1, bool)
        self.opens[[i for token, i in table.items() if token.startswith(b" ")]] = True
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=pieces)
        size = self.pieces.vocab_size()
        self.bytes = {i for i in range(size) if self.pieces.is_byte(i)}
        letters = "".join(x for x in map(self.pieces.id_to_piece, range(size)) if len(x) == 1)
        self.strange = re.compile(f"[^{re.escape(letters)}]")

    def tokens(self, found: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all words, each with a space before it, and the place of each word's first."""
        ids: list[int] = []
        at, size = 0, 0
        for i, word in enumerate(found):
            size += len(word)
            if size >= RUN or i + 1 == len(found):
                # A word holds no space, so a token that opens with one opens a word.
                ids += self.bpe.encode_ordinary(" " + b" ".join(found[at : i + 1]).decode())
                at, size = i + 1, 0
        out = np.array(ids, np.int64)
        if len(out) and self.opens[out].sum() != len(found):
            raise AssertionError("a token spans two words")
        return out, np.append(np.flatnonzero(self.opens[out]) if len(out) else out, len(out))

    def fallen(self, word: str) -> int:
        """Bytes of the word that its pieces spell byte by byte."""
        return sum(p in self.bytes for p in self.pieces.encode(word)) if self.strange.search(word) else 0


def _sums(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of ``flags`` in each of the runs between ``offsets``."""
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def _repeated(text: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each (text, hash) occurs twice or more, and whether it is a later occurrence."""
    key = mix(h + text.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, first, where, count = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
    return count[where] > 1, first[where] != np.arange(len(h))


def _script(sample: str) -> str:
    """The script of most letters of a word list."""
    seen: dict[str, int] = {}
    for c in sample:
        if c.isalpha():
            name = unicodedata.name(c, "OTHER").split(" ")[0]
            seen[name] = seen.get(name, 0) + 1
    return max(sorted(seen), key=seen.get) if seen else "NONE"


def _entropy(doc: np.ndarray, ids: np.ndarray, n: int) -> np.ndarray:
    """Bits of entropy of each document's token counts."""
    keys, count = np.unique(doc << 32 | ids, return_counts=True)
    keys >>= 32
    total = np.bincount(keys, count, n)
    share = count / total[keys]
    return np.bincount(keys, -share * np.log2(share), n).astype(float)


def _measure(column: pa.Array, vocabulary: _Vocabulary) -> list[pa.Array]:
    data, offsets = text_bytes(column)
    n = len(offsets) - 1
    w = words(column, SOLID, lower=False)
    doc = w.text
    solid = SOLID[data]
    starts_char = (data & 0xC0) != 0x80
    # Lines with a word.
    lines = words(column, _IN_LINE, lower=False)
    total = np.concatenate([[0], np.cumsum(solid, dtype=np.int64)])
    wordy = total[lines.end] > total[lines.start]
    line_doc = lines.text[wordy]
    _, later = _repeated(line_doc, lines.hash[wordy])
    # Words in repeated windows of eight.
    g = grams(w.hash, 8)
    whole = doc[: len(g)] == doc[7 : 7 + len(g)] if len(g) else np.zeros(0, bool)
    at = np.flatnonzero(whole)
    twice, _ = _repeated(doc[at], g[at])
    cover = np.zeros(len(w.hash) + 1, np.int64)
    np.add.at(cover, at[twice], 1)
    np.add.at(cover, at[twice] + 8, -1)
    cover = np.cumsum(cover)[:-1] > 0
    # Tokens of each distinct word, then of each word.
    _, one, where = np.unique(w.hash, return_index=True, return_inverse=True)
    raw = data.tobytes()
    found = [raw[a:b] for a, b in zip(w.start[one].tolist(), w.end[one].tolist(), strict=True)]
    ids, first = vocabulary.tokens(found)
    fallen = np.array([0 if x.isascii() and x.decode().isprintable() else vocabulary.fallen(x.decode()) for x in found], np.int64)
    n_ids = (first[1:] - first[:-1])[where]
    tokens = _sums(n_ids, w.first)
    take = np.repeat(first[:-1][where] - np.cumsum(n_ids) + n_ids, n_ids) + np.arange(n_ids.sum())
    entropy = _entropy(np.repeat(doc, n_ids), ids[take], n)
    chars = _sums(starts_char & solid, offsets)
    size = _sums(solid, offsets)
    with np.errstate(invalid="ignore", divide="ignore"):
        per_token = np.where(tokens > 0, chars / tokens, 0.0)
        share = np.where(size > 0, _sums(fallen[where], w.first) / size, 0.0)
    high = _sums(data >= 0x80, offsets)
    scripts = [
        # Mostly ASCII needs no closer look.
        "LATIN" if 2 * h < chars[i] else _script(raw[offsets[i] : offsets[i + 1]].decode())
        for i, h in enumerate(high)
    ]
    return [
        pa.array(np.diff(w.first)),
        pa.array(chars),
        pa.array(_sums(_SYMBOL[data], offsets)),
        pa.array(np.bincount(line_doc, later, n).astype(np.int64)),
        pa.array(_sums(cover, w.first)),
        pa.array(tokens),
        pa.array(per_token),
        pa.array(share),
        pa.array(entropy),
        pa.array(scripts, pa.string()),
    ]


def measures(docs: DataFrame, text: str = "text", vocabularies: str = VOCABULARIES) -> DataFrame:
    """``docs`` with the measures of MEASURES; input columns of those names are replaced.

    A null or empty text has no words: counts and measures 0 and script NONE or LATIN. Repeated rows are measured
    alike, and an empty table stays empty. No other column is looked at.
    """
    names = [x.split()[0] for x in MEASURES.split(", ")]
    rows = docs.drop(*[x for x in names if x != text])
    if text in names:
        raise ValueError(f"the text column can't be called {text}")
    folder = Path(vocabularies)
    context = docs.sparkSession.sparkContext
    files = context.broadcast(((folder / RANKS).read_bytes(), (folder / PIECES).read_bytes()))

    def run(batches):
        vocabulary = _Vocabulary(*files.value)
        for batch in batches:
            # A worker takes about 50 bytes for each byte of text, and part of that stays with it in later stages.
            for part in slices(batch, text, 2 << 20):
                found = _measure(part.column(text), vocabulary)
                yield pa.RecordBatch.from_arrays([*part.columns, *found], [*part.schema.names, *names])

    return map_batches(rows, run, fields(rows, more=MEASURES))


def base_failed() -> Column:
    """Too short, or more than 30 % of the words in repeated windows."""
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def in_band(language: Column, languages=LANGUAGES, scripts=SCRIPTS, other: Band = OTHER) -> Column:
    """Whether all measures lie in the band of the language, else of the script. False without words."""

    def inside(band: Band) -> Column:
        low, high = band.chars_per_token
        chars = F.col("chars_per_token")
        return (
            (chars >= low - SLACK / F.sqrt("n_words"))
            & (chars <= high)
            & F.col("byte_share").between(*band.byte_share)
            & (F.col("entropy") >= band.entropy[0] - band.entropy_slack / F.sqrt("n_tokens"))
            & (F.col("entropy") <= band.entropy[1])
        )

    rule = F.when(F.col("n_words") == 0, F.lit(False))
    for kind, bands in ((F.coalesce(language, F.lit("")), languages), (F.col("script"), scripts)):
        for name, band in bands.items():
            rule = rule.when(kind == name, inside(band))
    return rule.otherwise(inside(other))


def fit_bands(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    language: str = "lang",
    quality: str = "quality",
    lost: float = 0.0,
    margin: tuple[float, float, float] = (0.03, 0.01, 0.03),
    entropy_slack: float = 16.0,
    least: int = 20,
    **options,
) -> dict[str, Band]:
    """A band for each language, for ``in_band``: as close to the clean documents as it can be.

    ``labels`` has ``key`` and ``quality``: 1 is clean. Of clean documents that pass the base rules, a share of ``lost`` may fall out at
    each end; ``margin`` is left beyond the last one that stays (characters per token, share of bytes, bits of entropy). All labelled documents
    count, and a row for each language reaches the driver. Languages of fewer than ``least`` clean documents get no band, and neither do
    documents without a language.
    """
    clean = labels.filter(F.col(quality) == 1).select(key).distinct()
    rows = measures(docs.select(key, text, language).join(clean, key, "left_semi"), text, **options)
    chars = F.col("chars_per_token") + SLACK / F.sqrt("n_words")
    bits = F.col("entropy") + entropy_slack / F.sqrt("n_tokens")

    def end(measure: Column, high: bool) -> Column:
        if lost == 0:
            return F.max(measure) if high else F.min(measure)
        return F.percentile_approx(measure, 1 - lost if high else lost, 10000)

    found = (
        rows.filter(~base_failed() & F.col(language).isNotNull())
        .groupBy(F.col(language).alias("language"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            end(chars, False).alias("low_chars"),
            end(F.col("chars_per_token"), True).alias("high_chars"),
            end(F.col("byte_share"), True).alias("bytes"),
            end(bits, False).alias("low_bits"),
            end(F.col("entropy"), True).alias("high_bits"),
        )
        .filter(F.col("n") >= least)
    )
    return {
        r.language: Band(
            (r.low_chars - margin[0], r.high_chars + margin[0]),
            (0.0, r.bytes + margin[1]),
            (r.low_bits - margin[2], r.high_bits + margin[2]),
            entropy_slack,
        )
        for r in found.collect()
    }


def kept(docs: DataFrame, text: str = "text", language: str = "lang", **options) -> DataFrame:
    """``docs`` with the measures, ``base_failed`` and ``kept``. Nulls and repeated rows as in ``measures``."""
    rows = measures(docs.drop("base_failed", "kept"), text, **options)
    return rows.withColumn("base_failed", base_failed()).withColumn(
        "kept", ~F.col("base_failed") & in_band(F.col(language))
    )
