"""Chat formatting in budgeted windows.

A conversation becomes one or more training texts of at most ``budget`` tokens. Prefix sums of the turns' tokens choose the
windows: each holds the leading system turn, the last turns of the window before as far as they fit ``history`` tokens, and
then as many new turns as fit. Windows begin and end at turns. The loss covers the texts of new assistant turns, so
that a repeated one is masked and each counts once.

The template marks a turn as ``<|turn|>role<|text|>text<|end|>``. Strings in roles and texts that a template or tokenizer might take
for control are escaped by a backslash after their (last) opening bracket, and one more where there are some
already, so that unescaping gives every text back.

Only DataFrame functions are used. Windows are chosen on the sums alone; of a conversation only these numbers are gathered. The turns are
then joined to their windows by place, and the texts of a window, which the budget bounds, are gathered: work grows with the
turns, however many a conversation has.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wardstream.session import materialise

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
#: Control strings after their last opening character; fixed values of common templates. None holds another opening
#: character, so what is put in after one never changes another.
_CONTROL = r"(?=/?s>|/?INST\]|/?SYS>>|\|[A-Za-z0-9_]+\|>|(?:pad|unk|bos|eos|mask)>)"
_FIRST = r"([<\[])"

MARKS = 3
WINDOW = "struct<first:int,fresh:int,upto:int>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _FIRST + r"(\\*)" + _CONTROL, r"$1\\$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _FIRST + r"\\(\\*)" + _CONTROL, "$1$2")


def n_tokens(text: Column) -> Column:
    """Tokens of a text: words, numbers and single marks."""
    return F.regexp_count(text, F.lit(r"\p{L}+|\p{N}{1,3}|[^\s\p{L}\p{N}]")).cast("long")


def windows(
    turns: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    budget: int = 1024,
    history: int = 256,
) -> DataFrame:
    """A row for each window of each conversation: ``conv``, ``window`` (from 0), ``formatted``, ``n_tokens``,
    ``n_masked`` (turns repeated from before), and ``loss`` (start and length of each trained stretch of ``formatted``,
    in characters).

    Turns are ordered by ``turn``, then role and text; null turns come first. A null role or text is empty, and a null ``conv`` is
    one conversation. A turn beyond the budget has a window of its own, whole. Repeated rows are turns
    of their own. An empty table has no windows. Other columns are not read.
    """
    if not 0 <= history < budget:
        raise ValueError("history must be from 0 to below budget")
    said = turns.select(
        F.col(conv).alias("conv"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    # Three markers a turn, so the sums rise.
    tokens = n_tokens(F.col("role")) + n_tokens(F.col("text")) + MARKS
    in_order = Window.partitionBy("conv").orderBy("turn", "role", "text")
    placed = said.withColumn("tokens", tokens).select(
        "conv",
        (F.row_number().over(in_order) - 1).alias("place"),
        F.sum("tokens").over(in_order.rowsBetween(Window.unboundedPreceding, 0)).alias("upto"),
        (F.col("role") == "system").alias("system"),
        F.concat(F.lit(TURN), escape(F.col("role")), F.lit(TEXT)).alias("head"),
        escape(F.col("text")).alias("body"),
        (F.col("role") == "assistant").alias("target"),
    )
    # Stored, since the sums and the texts are read apart.
    placed = materialise(placed, "turns")
    spans = _spans(placed.select("conv", "place", "upto", "system"), budget, history)
    own = F.when(
        F.col("s.first") < F.col("s.upto"), F.sequence(F.col("s.first"), F.col("s.upto") - 1)
    ).otherwise(F.array().cast("array<int>"))
    members = spans.select(
        "conv",
        "window",
        "n_tokens",
        "n_masked",
        F.explode(F.concat(F.slice(F.array(F.lit(0)), 1, F.col("lead")), own)).alias("place"),
    )
    # With a null conversation too; spread by place, so that a long conversation is many groups.
    by_place = (F.col("m.conv").eqNullSafe(F.col("p.conv"))) & (F.col("m.place") == F.col("p.place"))
    turn_of = F.struct("p.place", "head", "body", "target").alias("t")
    joined = members.alias("m").join(placed.drop("upto", "system").alias("p"), by_place)
    gathered = (
        joined.select("m.conv", "window", "n_tokens", "n_masked", turn_of)
        .groupBy("conv", "window", "n_tokens", "n_masked")
        .agg(F.sort_array(F.collect_list("t")).alias("chosen"))
    )
    return _written(gathered).select(
        F.col("conv").alias(conv), "window", "formatted", "n_tokens", "n_masked", "loss"
    )


def _spans(sums: DataFrame, budget: int, history: int) -> DataFrame:
    """The windows of each conversation, chosen by the prefix sums: ``s`` (first turn, first new one, end), ``lead`` (1 after
    a leading system turn), tokens, and turns repeated from before."""
    numbers = (
        sums.groupBy("conv")
        .agg(F.sort_array(F.collect_list(F.struct("place", "upto"))).alias("t"), F.max(F.col("system") & (F.col("place") == 0)).alias("lead"))
        .select("conv", F.col("lead").cast("int").alias("lead"), F.concat(F.array(F.lit(0).cast("long")), F.col("t.upto")).alias("upto"))
    )

    def before(i: Column) -> Column:
        return F.get("upto", i)

    def near(i: Column) -> Column:
        """Where a window opened at turn i takes up its history: the first turn that is near enough."""
        reach = history // MARKS + 1  # turns that could fit at all
        near_sums = F.slice("upto", F.greatest(i + 1 - reach, F.lit(1)), reach)
        fit = F.size(F.filter(near_sums, lambda s: (s < before(i)) & (before(i) - s <= history)))
        return F.greatest(F.col("lead"), i - fit)

    system = before(F.col("lead"))

    def span(first: Column, fresh: Column, upto: Column) -> Column:
        return F.struct(first.cast("int").alias("first"), fresh.cast("int").alias("fresh"), upto.cast("int").alias("upto"))

    def grow(acc: Column, i: Column) -> Column:
        """Add turn i to the open window, or close it and open one. The list of windows is touched only then."""
        last = acc["last"]
        some = last["upto"] > 0
        fits = some & (system + before(i + 1) - before(last["first"]) <= budget)
        # History gives way if even one new turn does not fit beside it.
        start = F.when(some & (system + before(i + 1) - before(near(i)) <= budget), near(i)).otherwise(i)
        return F.struct(
            F.when(fits, span(last["first"], last["fresh"], i + 1)).otherwise(span(start, i, i + 1)).alias("last"),
            F.when(some & ~fits, F.concat(acc["done"], F.array(last))).otherwise(acc["done"]).alias("done"),
        )

    count = F.size("upto") - 1
    new = F.when(count > F.col("lead"), F.sequence(F.col("lead"), count - 1)).otherwise(
        F.array().cast("array<int>")
    )
    zero = F.lit(0)
    start = F.struct(span(zero, zero, zero).alias("last"), F.array().cast(f"array<{WINDOW}>").alias("done"))
    # A conversation of a system turn alone is one window of it.
    alone = F.array(span(F.col("lead"), F.col("lead"), count))
    spans = F.aggregate(
        new, start, grow, lambda acc: F.when(acc["last"]["upto"] > 0, F.concat(acc["done"], F.array(acc["last"]))).otherwise(alone)
    )
    rows = numbers.withColumn("spans", spans)
    # The sums of each window, so that the list of all is not copied beside every one.
    of_window = F.transform(
        "spans", lambda s: F.struct(s.alias("s"), (system + before(s["upto"]) - before(s["first"])).alias("n_tokens"))
    )
    rows = rows.select("conv", "lead", F.posexplode(of_window).alias("window", "w"))
    masked = F.col("w.s.fresh") - F.col("w.s.first") + F.when(F.col("window") > 0, F.col("lead")).otherwise(0)
    return rows.select("conv", "lead", "window", "w.s", "w.n_tokens", masked.alias("n_masked"))


def _written(rows: DataFrame) -> DataFrame:
    """Each window's text, and what of it is trained: the texts of assistant turns after the repeated ones."""
    state = F.struct(
        F.lit(0).cast("long").alias("at"),
        F.array().cast("array<struct<start:bigint,length:bigint,target:boolean>>").alias("found"),
    )

    def place(acc: Column, t: Column) -> Column:
        start = acc["at"] + F.length(t["head"])
        size = F.length(t["body"]).cast("long")
        one = F.struct(start.alias("start"), size.alias("length"), t["target"].alias("target"))
        return F.struct(
            (start + size + len(END)).alias("at"),
            F.concat(acc["found"], F.array(one)).alias("found"),
        )

    places = F.aggregate("chosen", state, place, lambda acc: acc["found"])
    own = F.filter("places", lambda p, i: p["target"] & (i >= F.col("n_masked")))
    return rows.withColumn("places", places).select(
        "conv",
        "window",
        F.concat_ws(
            "", F.transform("chosen", lambda t: F.concat(t["head"], t["body"], F.lit(END)))
        ).alias("formatted"),
        "n_tokens",
        "n_masked",
        F.transform(
            own, lambda p: F.struct(p["start"].alias("start"), p["length"].alias("length"))
        ).alias("loss"),
    )


def read_back(formatted: Column) -> Column:
    """The turns (role, text) that a formatted window spells."""
    parts = F.split(formatted, r"<\|turn\|>", -1)
    return F.transform(
        F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))),
        lambda p: F.struct(
            unescape(F.split_part(p, F.lit(TEXT), F.lit(1))).alias("role"),
            unescape(
                F.substring(
                    F.split_part(p, F.lit(END), F.lit(1)),
                    F.length(F.split_part(p, F.lit(TEXT), F.lit(1))) + len(TEXT) + 1,
                    F.length(p),
                )
            ).alias("text"),
        ),
    )


def under_loss(formatted: Column, loss: Column) -> Column:
    """The texts that the loss covers, unescaped."""
    return F.transform(
        loss,
        lambda p: unescape(F.substring(formatted, (p["start"] + 1).cast("int"), p["length"].cast("int"))),
    )
