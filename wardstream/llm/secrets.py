"""Secret scans: fixed patterns, and character Markov models for strings without one.

Two first-order models of characters are trained on the corpus: one of random strings (the values that the fixed patterns find)
and one of ordinary words and identifiers (those outside of them). Every run of 8 or more key characters is scored. One of LONG or
more is a secret where the random model explains it better by a log-likelihood ratio of MARGIN, a shorter one by one of
SHORT_MARGIN a character. What stands before an assignment in the same run is a run of its own; where fixed patterns match only a part of a run, the
rest is scored by itself, and the whole run is the secret if the rest is one. The labelled sample is
bounded: the documents whose seeded hash is lowest, SAMPLE of them as expected; every document is
scanned, over its whole text.

Only DataFrame functions are used. Offsets are in characters, the end exclusive: a text split by a pattern gives the lengths
between its matches, and the sums of both lengths give the places.
"""

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardstream.llm.common import fresh

# The fixed patterns; each stands for its kind. Letters of the first in either case.
_NAME = "|".join(
    "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)
    for word in ("password", "passwd", "secret", "token", "api_?key")
)
ASSIGN = rf"""({_NAME})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "markov")
#: Characters of the value of an assignment.
LEAST = 6
CANDIDATE = r"[A-Za-z0-9+/_=-]{8,}"
#: Characters from which a run is scored as a whole.
LONG = 16
ORDINARY = r"[A-Za-z0-9_-]{4,}"
#: What every run has that a fixed pattern matches in part (the name of an assignment may end a run).
_HOLDS = f"{_NAME}|{ACCESS}|{HEX}"
SPANS = "array<struct<start:int,rank:int,end:int>>"
RUNS = "array<struct<start:int,rank:int,end:int,secret:boolean,run:string>>"
NEAR = f"array<struct<start:int,rank:int,end:int,secret:boolean,run:string,near:{SPANS}>>"
#: Parts of a text whose places are added up at once; characters of the tiles in which spans are looked up; tiles in a wider one.
BLOCK, TILE, FAN = 256, 512, 32

ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
#: Symbols of the models: 0 for the beginning and any other character.
SYMBOLS = len(ALPHABET) + 1
SAMPLE = 4000
MARGIN = 8.0
SHORT_MARGIN = 1.0
SMOOTHING = 0.5


def _let(value: Column, use) -> Column:
    """``use`` of a value that is computed once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _placed(parts: Column, one, kind: str) -> Column:
    """For each of ``parts`` (a gap of characters before a match, and the ``n`` of the match, null behind the last) what ``one`` makes of it and
    its place: an array of ``kind``, none or one.

    Lists that grow by one are copied each time, so places are added up within blocks of parts, and then over the blocks.
    """
    none = F.array().cast(kind)

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + x["gap"]
        out = F.when(x["n"].isNotNull(), F.concat(acc["out"], one(x, begin))).otherwise(acc["out"])
        return F.struct((begin + F.coalesce(x["n"], F.lit(0))).alias("at"), out.alias("out"))

    def block(some: Column) -> Column:
        return F.aggregate(some, F.struct(F.lit(0).alias("at"), none.alias("out")), step)

    def moved(s: Column, by: Column) -> Column:
        names = [f.split(":")[0] for f in kind.removeprefix("array<struct<").removesuffix(">>").split(",")]
        return F.struct(*((s[n] + by if n in ("start", "end") else s[n]).alias(n) for n in names))

    def join(acc: Column, x: Column) -> Column:
        some = F.transform(x["out"], lambda s: moved(s, acc["at"]))
        return F.struct((acc["at"] + x["at"]).alias("at"), F.concat(acc["out"], F.array(some)).alias("out"))

    blocks = _let(
        parts,
        lambda p: F.transform(
            F.sequence(F.lit(0), F.floor((F.size(p) - 1) / BLOCK).cast("int")),
            lambda i: block(F.slice(p, i * BLOCK + 1, BLOCK)),
        ),
    )
    start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{kind}>").alias("out"))
    return F.flatten(F.aggregate(blocks, start, join, lambda acc: acc["out"]))


def _places(text: Column, pattern: str, rank: int, value: int | None = None) -> Column:
    """The leftmost, non-overlapping matches of a pattern; ``value``: a group of LEAST characters or more."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(value or 0))
    parts = F.zip_with(
        F.split(text, pattern, -1),
        F.arrays_zip(found.alias("m"), values.alias("v")),
        lambda gap, x: F.struct(
            F.length(gap).alias("gap"), F.length(x["m"]).alias("n"), F.length(x["v"]).alias("v")
        ),
    )

    def one(x: Column, begin: Column) -> Column:
        span = F.struct(begin.alias("start"), F.lit(rank).alias("rank"), (begin + x["n"]).alias("end"))
        return F.array(span) if value is None else F.when(x["v"] >= LEAST, F.array(span)).otherwise(F.array().cast(SPANS))

    spans = _placed(parts, one, SPANS)
    return F.when(F.regexp_like(text, F.lit(pattern)), spans).otherwise(F.array().cast(SPANS))


def base_spans(text: Column) -> Column:
    """Matches of the fixed patterns, by start and then kind."""
    return F.sort_array(
        F.concat(_places(text, ASSIGN, 0, 2), _places(text, ACCESS, 1), _places(text, HEX, 2))
    )


def _symbol(c: Column) -> Column:
    return F.instr(F.lit(ALPHABET), c)


def _symbols(token: Column) -> Column:
    """The symbol of each character."""
    return F.transform(F.split(token, ""), _symbol)


def _pairs(token: Column) -> Column:
    """Each character's cell in the model: the symbol before times SYMBOLS, plus its own."""
    return _let(
        _symbols(token),
        lambda s: F.zip_with(F.concat(F.array(F.lit(0)), F.slice(s, 1, F.size(s) - 1)), s, lambda x, y: x * SYMBOLS + y),
    )


def train(docs: DataFrame, key: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> list[float]:
    """The log-likelihood ratio of random against ordinary for each cell: SYMBOLS squared of them.

    Without labelled strings of one sort its model is uniform. Documents of a null key or text may be sampled too.
    """
    total = max(1, docs.count())
    share = min(1.0, sample / total)
    chosen = docs.select(F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"), F.xxhash64(F.lit("sample"), F.col(key)).alias("h"))
    chosen = chosen.filter(F.pmod("h", F.lit(1 << 30)) < int(share * (1 << 30)))
    spans = base_spans(F.col("text"))
    cut = chosen.select("text", spans.alias("spans")).select(
        F.transform("spans", lambda s: _value(F.substring("text", s["start"] + 1, s["end"] - s["start"]))).alias("random"),
        F.regexp_extract_all(
            F.regexp_replace("text", f"(?:{ASSIGN})|(?:{ACCESS})|(?:{HEX})", " "), F.lit(ORDINARY), F.lit(0)
        ).alias("plain"),
    )
    strings = cut.select(F.explode("random").alias("token"), F.lit(1).alias("is_random")).unionAll(
        cut.select(F.explode("plain").alias("token"), F.lit(0).alias("is_random"))
    )
    counted = strings.groupBy("token", "is_random").agg(F.count("*").alias("n"))
    cells = (
        counted.select("is_random", "n", F.explode(_pairs(F.col("token"))).alias("cell"))
        .groupBy("is_random", "cell")
        .agg(F.sum("n").alias("n"))
        .collect()  # 2 * SYMBOLS squared rows at the most
    )
    counts = [[0] * SYMBOLS**2, [0] * SYMBOLS**2]
    for row in cells:
        counts[row.is_random][row.cell] = row.n
    rows = [[sum(c[i : i + SYMBOLS]) for i in range(0, len(c), SYMBOLS)] for c in counts]

    def logp(sort: int, cell: int) -> float:
        return math.log(
            (counts[sort][cell] + SMOOTHING) / (rows[sort][cell // SYMBOLS] + SMOOTHING * SYMBOLS)
        )

    return [logp(1, cell) - logp(0, cell) for cell in range(SYMBOLS**2)]


def _value(match: Column) -> Column:
    """A match without the name and signs before its value."""
    return F.regexp_replace(match, rf"""^({_NAME})["']?\x20*[:=]\x20*["']?""", "")


def _ratio(symbols: Column, model: list[float]) -> Column:
    """The log-likelihood ratio of random against ordinary of strings of symbols, a -1 before each but the first."""
    table = F.from_json(F.lit(str(model)), "array<double>")  # folded into one literal
    start = F.struct(F.lit(0).alias("before"), F.lit(0.0).alias("sum"))

    def step(acc: Column, x: Column) -> Column:
        more = F.when(x < 0, F.lit(0.0)).otherwise(F.get(table, acc["before"] * SYMBOLS + x))
        return F.struct(F.greatest(x, F.lit(0)).alias("before"), (acc["sum"] + more).alias("sum"))

    return F.aggregate(symbols, start, step, lambda acc: acc["sum"])


def score(token: Column, model: list[float]) -> Column:
    """The log-likelihood ratio of random against ordinary."""
    return _ratio(_symbols(token), model)


def _enough(ratio: Column, n: Column) -> Column:
    """Whether a log-likelihood ratio of ``n`` characters makes a secret."""
    return ratio >= F.when(n >= LONG, F.lit(MARGIN)).otherwise(F.greatest(F.lit(MARGIN), n * F.lit(SHORT_MARGIN)))


def _scored(text: Column, model: list[float]) -> Column:
    """Places of the runs that are secrets, or that may hold a match of a fixed pattern or the name of one; with the text of the latter."""
    parts = F.zip_with(
        F.split(text, CANDIDATE, -1),
        F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0)),
        lambda gap, x: F.struct(
            F.length(gap).alias("gap"),
            F.length(x).alias("n"),
            _enough(score(x, model), F.length(x)).alias("secret"),
            F.regexp_like(x, F.lit(_HOLDS)).alias("holds"),
            x.alias("run"),
        ),
    )
    none = F.array().cast(RUNS)

    def one(x: Column, begin: Column) -> Column:
        span = F.struct(
            begin.alias("start"), F.lit(3).alias("rank"), (begin + x["n"]).alias("end"), x["secret"].alias("secret"), x["run"].alias("run")
        )
        return F.when(x["secret"] | x["holds"], F.array(span)).otherwise(none)

    return _placed(parts, one, RUNS)


def _tiles(base: Column, n: Column) -> Column:
    """For each TILE of ``n`` characters the spans that begin in it, and those before that reach into it, one of a kind at the
    most. Found in wide tiles first, so that a text of many spans is not gone through for each tile."""

    def tiles(spans: Column, first: Column, count: Column, size: int) -> Column:
        return F.transform(
            F.sequence(F.lit(0), count - 1),
            lambda t: F.struct(
                F.filter(spans, lambda s: F.floor(s["start"] / size) == first + t).alias("begin"),
                F.filter(spans, lambda s: (s["start"] < (first + t) * size) & (s["end"] > (first + t) * size)).alias("reach"),
            ),
        )

    found = tiles(base, F.lit(0), F.floor(n / (TILE * FAN**2)).cast("int") + 1, TILE * FAN**2)
    for size in (TILE * FAN, TILE):
        found = F.flatten(_narrower(found, tiles, size))
    return found


def _narrower(wide: Column, tiles, size: int) -> Column:
    return _let(
        wide, lambda w: F.transform(w, lambda x, i: tiles(F.concat(x["reach"], x["begin"]), i * FAN, F.lit(FAN), size))
    )


def _near(tiles: Column, s: Column) -> Column:
    """The spans that overlap ``s``, by start and kind."""
    first, last = F.floor(s["start"] / TILE).cast("int"), F.floor((s["end"] - 1) / TILE).cast("int")
    begin = F.flatten(F.transform(F.slice(tiles, first + 1, last - first + 1), lambda t: t["begin"]))
    some = F.concat(F.get(tiles, first)["reach"], begin)
    return F.sort_array(F.filter(some, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))


def _uncovered(s: Column) -> Column:
    """The parts of a run that no span near it covers."""
    kind = "array<struct<at:int,n:int>>"
    start = F.struct(s["start"].alias("at"), F.array().cast(kind).alias("out"))

    def gap(at: Column, end: Column) -> Column:
        return F.when(at < end, F.array(F.struct(at.alias("at"), (end - at).alias("n")))).otherwise(F.array().cast(kind))

    def step(acc: Column, b: Column) -> Column:
        out = F.concat(acc["out"], gap(acc["at"], F.least(b["start"], s["end"])))
        return F.struct(F.greatest(acc["at"], b["end"]).alias("at"), out.alias("out"))

    return F.aggregate(s["near"], start, step, lambda acc: F.concat(acc["out"], gap(acc["at"], s["end"])))


def scan(
    docs: DataFrame, key: str = "doc_id", text: str = "text", model: list[float] | None = None
) -> DataFrame:
    """``docs`` with ``base`` and ``spans`` (start, rank in KINDS, end; sorted), replaced if there.

    ``base`` has the matches of the fixed patterns, ``spans`` those and what the model adds outside of them. A null text is empty
    and has none. Repeated rows are scanned alike. The model is trained on ``docs`` unless given. An empty
    table stays empty. Other columns are kept as they are.
    """
    model = train(docs, key, text) if model is None else model
    rows = docs.drop(*[c for c in ("base", "spans") if c != text])
    whole, token = fresh(rows, "whole", "token")
    # Each step stands on a column of its own, so that no pattern is run twice.
    found = rows.withColumn(whole, F.coalesce(F.col(text).cast("string"), F.lit("")))
    # Few runs are secrets, so each one is scored before places are added up. Where a fixed pattern matches too, its run is looked at below.
    found = found.withColumn("base", base_spans(F.col(whole))).withColumn(token, _scored(F.col(whole), model))
    many = F.size("base") > 0
    tiles = F.when(many, _tiles(F.col("base"), F.length(whole)))
    none = F.array().cast(SPANS)

    def with_near(s: Column, t: Column) -> Column:
        return F.struct(*(s[n].alias(n) for n in ("start", "rank", "end", "secret", "run")), F.when(t.isNotNull(), _near(t, s)).otherwise(none).alias("near"))

    # Tiles are made only where there is a run to look at.
    found = found.withColumn(
        token, F.when(F.size(token) > 0, _let(tiles, lambda t: F.transform(token, lambda s: with_near(s, t))))
    ).withColumn(token, F.coalesce(token, F.array().cast(NEAR)))
    own = F.filter(token, lambda s: s["secret"] & (F.size(s["near"]) == 0))

    def cut(s: Column) -> Column:
        """The run up to the first assignment in it."""
        named = F.transform(F.filter(s["near"], lambda b: b["rank"] == 0), lambda b: b["start"])
        end = F.least(s["end"], F.coalesce(F.array_min(named), s["end"]))
        return F.struct(s["start"].alias("start"), s["rank"].alias("rank"), end.alias("end"), s["run"].alias("run"), s["near"].alias("near"))

    def has_more(s: Column) -> Column:
        return _let(
            F.struct(_uncovered(s).alias("gaps"), _symbols(s["run"]).alias("symbols")),
            lambda x: _enough(
                _ratio(
                    F.flatten(
                        F.transform(
                            x["gaps"],
                            lambda g: F.concat(F.array(F.lit(-1)), F.slice(x["symbols"], g["at"] - s["start"] + 1, g["n"])),
                        )
                    ),
                    model,
                ),
                F.aggregate(x["gaps"], F.lit(0), lambda acc, g: acc + g["n"]),
            )
            & (F.size(x["gaps"]) > 0),
        )

    touched = F.filter(token, lambda s: F.size(s["near"]) > 0)
    pieces = F.filter(F.transform(touched, cut), lambda s: s["start"] < s["end"])
    more = F.filter(pieces, has_more)

    def plain(spans: Column) -> Column:
        return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end")))

    return found.withColumn("spans", F.sort_array(F.concat("base", plain(own), plain(more)))).drop(whole, token)


def spelled(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    kinds = F.array(*map(F.lit, KINDS))
    return F.concat_ws(
        ",",
        F.transform(
            spans,
            lambda s: F.concat_ws(":", F.get(kinds, s["rank"]), s["start"].cast("string"), s["end"].cast("string")),
        ),
    )
