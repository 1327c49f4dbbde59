"""Main text of web pages: a suffix array over each host, checked by named containers.

The pages of a host share what is no article: menus, notices, adverts, footers. The token streams of a host's pages, articles and
all, are concatenated into suffix arrays, sorted by prefix doubling as deep as a repeat must be long (LENGTH tokens). Neighbours
there with equal prefixes are the long substrings; the tokens of one that is boilerplate are removed from every page, and
unique runs are kept.

Repeats alone cannot give exact articles: a menu that no other page has would stay, and an article published
twice would go, or a passage that two articles quote. So where a page names its containers (``article``, ``main``, ``nav``,
``aside``, class names and the like), an exact check follows. Text in other named containers or beside an article goes. A block in
a named article goes, unless it is a heading, if all of it is substrings that many pages of the host have in their articles: MANY
distinct pages at the least and a share of WIDE of all. What fewer pages have is another copy of the article or of a part of it, and stays;
so does an article of which such blocks make up half. On pages without an article, substrings that stand outside of articles on two distinct
pages go too.

Hosts of up to CHUNK tokens are decided in one suffix array. A larger one is split into chunks, and what it shares
is found in three steps that send no places: each chunk names the substrings that a share of WIDE / 2 of its own pages have; those named
by chunks of enough pages are counted on all pages (of a substring that WIDE of all pages have, no count can fail this test); and
those found wide are looked up again on each page.
"""

import hashlib
import html as entities
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardstream.llm.common import fields, map_batches, slices
from wardstream.llm.wordhash import SOLID, grams, mix, words
from wardstream.session import materialise

_KEY = "host bigint, stream bigint, variant bigint"
LENGTH = 8
CHUNK = 1 << 19
#: A substring of named articles is boilerplate on so many distinct pages and such a share of the host's distinct pages.
MANY = 3
WIDE = 0.5

ARTICLE, OPEN, OTHER = 0, 1, 2
#: Only while a page is read: an article inside of an element that is none, and what is not shown at all.
_NESTED, _UNSEEN = 3, 4
# Names of elements; fixed values of HTML.
_RAW = "script|style|template|textarea|title|noscript|iframe|svg|math|object|canvas|audio|video|select"
_ASIDE = set("nav header footer aside form menu dialog button fieldset figure".split()) - {"figure"}
_INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr".split()
)
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: Words in class names, ids and roles that name something beside the article.
_ASIDE_NAMES = set(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner navigation nav navbar menu "
    "breadcrumb breadcrumbs sidebar aside header masthead footer colophon notice notices cookie cookies consent gdpr popup "
    "modal overlay newsletter subscribe subscription signup login share sharing social comment comments disqus reply "
    "replies related recommended teaser pagination pager widget toolbar search contentinfo complementary".split()
)
#: Words that may stand beside those in one name (site-footer, share-buttons) and leave its sense.
_ASIDE_PARTS = set(
    "site main page top bottom left right primary secondary global bar box list item items link links button buttons section "
    "area container wrapper block content form menu icon icons text".split()
)
_ARTICLE_NAMES = set("main article".split())
_HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
#: Start tags that end an open paragraph.
_ENDS_P = set(
    "address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 "
    "h5 h6 header hgroup hr li main menu nav ol p pre search section summary table ul".split()
)
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(?P<raw>{_RAW})\b.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-z][^\s/>]*)(?P<rest>(?:\"[^\"]*\"|'[^']*'|[^>\"'])*+|[^>]*)(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)"
    r"|(?P<text>[^<]+|<)",
    re.S | re.I,
)
_NAMED = re.compile(r"class|id|role|itemprop|hidden|style", re.I)
_ATTRIBUTE = re.compile(r"([^\s=/\"'<>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_UNDISPLAYED = re.compile(r"(?<![\w-])display\s*:\s*none", re.I)
_SPACE = re.compile(r"\s+")
_WORD = re.compile(r"[a-z]+")


def _is_aside(value: str, around: int) -> bool:
    """Whether a class, id or role names something beside the article: a whole name of it does, not a word of one."""
    for name in value.split():
        found = set(_WORD.findall(name))
        if found & _ASIDE_NAMES and found <= _ASIDE_NAMES | _ASIDE_PARTS:
            # An article's own header holds its title.
            if not (found == {"header"} and around in (ARTICLE, _NESTED)):
                return True
    return False


def _kind(tag: str, rest: str, around: int) -> int:
    """What an element holds, given what it stands in."""
    if around == _UNSEEN or tag in ("html", "body"):
        return around
    inner = _NESTED if around in (OTHER, _NESTED) else ARTICLE
    named, aside = tag in ("article", "main"), tag in _ASIDE and not (tag == "header" and around in (ARTICLE, _NESTED))
    if rest and _NAMED.search(rest):
        for name, *values in _ATTRIBUTE.findall(rest):
            name, value = name.lower(), "".join(values).lower()
            if name == "hidden" and value not in ("until-found", "false"):
                return _UNSEEN
            if name == "aria-hidden" and value == "true" or name == "style" and _UNDISPLAYED.search(value):
                return _UNSEEN
            if name == "itemprop":
                named = named or value == "articlebody"
            elif name in ("class", "id", "role"):
                aside = aside or _is_aside(value, around)
                named = named or name == "role" and not _ARTICLE_NAMES.isdisjoint(value.split())
    return OTHER if aside else inner if named else around


def blocks(page: str, headings: set[int] | None = None) -> list[tuple[int, str]]:
    """The text blocks of a page, in order, and what each stands in. The places of headings are added to ``headings``.

    An article inside of an element that is none (a comment, a teaser; or all of a page in a form) counts if the page has no other
    and less text outside of elements that are none.
    """
    out: list[tuple[int, str]] = []
    stack: list[tuple[str, int]] = []
    around, held = OPEN, []

    def flush() -> None:
        if held:
            text = _SPACE.sub(" ", "".join(held)).strip()
            held.clear()
            if text:
                if headings is not None and any(tag in _HEADINGS for tag, _ in stack):
                    headings.add(len(out))
                out.append((around, text))

    for token in _TOKEN.finditer(page):
        text = token["text"]
        if text is not None:
            held.append(entities.unescape(text) if "&" in text else text)
            continue
        tag = token["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if tag == "br":
            held.append(" ")
        if tag in _ENDS_P and not token["close"]:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == "p":
                    flush()
                    around = stack[i][1]
                    del stack[i:]
                if i == len(stack) or stack[i][0] not in _INLINE:
                    break
        if tag in _VOID:
            continue
        if not token["close"]:
            kind = _kind(tag, token["rest"], around)
            if tag in _INLINE and kind == around:
                continue
            flush()
            if not token["rest"].endswith("/") and tag != "p":
                stack.append((tag, around))
            elif tag == "p" and kind != around:
                stack.append((tag, around))
            else:
                continue
            around = kind
        elif tag in _INLINE and not any(t == tag for t, _ in stack):
            continue
        else:
            flush()
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    around = stack[i][1]
                    del stack[i:]
                    break
    flush()
    size = [sum(len(text) for kind, text in out if kind == k) for k in (ARTICLE, OPEN, _NESTED)]
    nested = OTHER if size[0] or size[1] >= size[2] else ARTICLE
    final = {_NESTED: nested, _UNSEEN: OTHER}
    return [(final.get(kind, kind), text) for kind, text in out]


def _keyed(pages: DataFrame, key: str, url: str, html: str) -> DataFrame:
    rows = pages.select(
        F.col(key).alias("key"), F.col(url).cast("string").alias("url"), F.col(html).cast("string").alias("html")
    )
    return rows.withColumns(
        {"h1": F.xxhash64("key", "url", "html"), "h2": F.xxhash64(F.lit(13), "key", "url", "html")}
    )


def _number(tokens: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(tokens.tobytes(), digest_size=8).digest(), "little", signed=True)


def _streams(rows: DataFrame) -> DataFrame:
    """Each page's tokens by host, and the ends of runs of tokens: outside of named articles, inside, outside and so on.

    A token is 32 bits of its hash; LENGTH of them in a row tell substrings apart. ``stream`` and ``variant`` are hashes of the tokens and of the
    ends. Of pages that are equal in them, a task gives the tokens once; the others have none, and so have pages of less than LENGTH.
    """
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))

    def run(batches):
        seen: set[tuple[int, int, int]] = set()
        for batch in batches:
            for part in slices(batch, "html"):
                texts, counts, pages = [], [], []
                for x in part.column("html").to_pylist():
                    runs: list[tuple[bool, list[str]]] = [(False, [])]
                    for kind, text in blocks(x or ""):
                        if (kind == ARTICLE) != runs[-1][0]:
                            runs.append((kind == ARTICLE, []))
                        runs[-1][1].append(text)
                    texts += [" ".join(r) for _, r in runs]
                    counts.append(len(runs))
                    pages.append(len(texts))
                w = words(pa.array(texts, pa.string()), SOLID, lower=False)
                hashes = w.hash.astype(np.uint32).view(np.int32)
                first = w.first[np.append(0, pages)]
                ends = w.first[1:] - np.repeat(first[:-1], counts)
                where = np.append(0, pages)
                keys, tokens, cuts = [], [], []
                for i, at in enumerate(part.column("host").to_pylist()):
                    mine, cut = hashes[first[i] : first[i + 1]], ends[where[i] : where[i + 1]]
                    key = (at, _number(mine), _number(cut.astype(np.int64)))
                    keys.append(key)
                    fresh = len(mine) >= LENGTH and key not in seen
                    if fresh:
                        seen.add(key)
                    tokens.append(mine if fresh else None)
                    cuts.append(cut if fresh else None)
                columns = [part.column("h1"), part.column("h2"), *(pa.array([k[i] for k in keys], pa.int64()) for i in range(3))]
                columns.append(pa.array(np.diff(first), pa.int32()))
                columns += [pa.array(tokens, pa.list_(pa.int32())), pa.array(cuts, pa.list_(pa.int32()))]
                yield pa.RecordBatch.from_arrays(columns, ["h1", "h2", "host", "stream", "variant", "size", "tokens", "ends"])

    schema = f"h1 bigint, h2 bigint, {_KEY}, size int, tokens array<int>, ends array<int>"
    return map_batches(rows.select("h1", "h2", F.xxhash64(host).alias("host"), "html"), run, schema)


def suffix_classes(tokens: np.ndarray, depth: int) -> np.ndarray:
    """For each suffix its place among the distinct prefixes of ``depth`` tokens, in their order.

    Prefix doubling: suffixes ranked by n tokens are ranked by 2 n from the ranks n places on. Past the end is less.
    """
    rank = np.unique(tokens, return_inverse=True)[1].astype(np.int64) + 1
    known = 1
    while known < depth:
        step = min(known, depth - known)
        later = np.zeros_like(rank)
        later[:-step] = rank[step:]
        rank = np.unique(rank * (len(rank) + 2) + later, return_inverse=True)[1].astype(np.int64) + 1
        known += step
    return rank


def _lists(values: np.ndarray, starts: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.append(starts, len(values)), pa.int32()), pa.array(values).cast(kind))


def _inside(n: int, ends: list[int]) -> np.ndarray:
    """Which of ``n`` tokens stand in a named article; all of them on a page that names none."""
    if len(ends) == 1:
        return np.ones(n, bool)
    return np.repeat(np.arange(len(ends)) % 2 == 1, np.diff(ends, prepend=0))


class _Array:
    """The suffix array of pages of one host, (host, stream, variant, tokens, ends) in order of streams.

    Prefixes are numbered; ``page`` and ``place`` tell where each stands, ``group`` which prefix it is. Pages of equal streams are one page.
    """

    def __init__(self, held: list[tuple]):
        lengths = np.array([len(x[3]) for x in held])
        # A token of its own after each page, so that no prefix reaches into the next.
        marks = mix(np.arange(1, len(held) + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        self.tokens = np.concatenate([y for x, e in zip(held, marks, strict=True) for y in (x[3], [e])])
        first = np.concatenate([[0], np.cumsum(lengths + 1)])
        page = np.repeat(np.arange(len(held)), lengths + 1)
        at = np.arange(len(self.tokens))
        whole = at + LENGTH < first[page + 1]
        rank = suffix_classes(self.tokens, LENGTH)
        self.order = at[whole][np.argsort(rank[whole], kind="stable")]
        new = np.append(True, rank[self.order[1:]] != rank[self.order[:-1]])[: len(self.order)]
        self.starts, self.group = np.flatnonzero(new), np.cumsum(new) - 1
        self.page = page[self.order]
        self.place = self.order - first[self.page]
        self.inside = np.concatenate([np.append(_inside(n, x[4]), False) for n, x in zip(lengths, held, strict=True)])[self.order]
        self.named = np.array([len(x[4]) > 1 for x in held])[self.page]
        streams = np.array([x[1] for x in held], np.int64)
        number = np.cumsum(np.append(True, streams[1:] != streams[:-1])) - 1
        self.number, self.pages = number[self.page], int(number[-1]) + 1

    def on(self, which: np.ndarray) -> np.ndarray:
        """On how many distinct pages each prefix stands at the places ``which``."""
        group, number = self.group[which], self.number[which]
        # Places of a prefix are in the order of pages.
        new = np.append(True, (group[1:] != group[:-1]) | (number[1:] != number[:-1]))[: len(group)]
        return np.bincount(group[new], minlength=len(self.starts))


_COVERED = f"{_KEY}, covered array<int>"


def _covered(held: list[tuple]) -> pa.RecordBatch | None:
    """What is covered on each page of a whole host."""
    array = _Array(held)
    if not len(array.order):
        return None
    count = array.on(array.inside)
    wide = ((count >= MANY) & (count >= WIDE * array.pages))[array.group] & array.inside
    # On pages without an article all places count as inside of one, and all are outside too.
    twice = (array.on(~array.inside | ~array.named) > 1)[array.group] & ~array.named
    hit = wide | twice
    key = np.sort(array.page[hit] << 32 | (2 * array.place[hit] + wide[hit]))
    on, where = np.unique(key >> 32, return_index=True)
    if not len(on):
        return None
    columns = [pa.array(np.array([held[i][k] for i in on], np.int64)) for k in range(3)]
    columns.append(_lists(key & 0xFFFFFFFF, where, pa.int32()))
    return pa.RecordBatch.from_arrays(columns, ["host", "stream", "variant", "covered"])


def _candidates(held: list[tuple]) -> pa.RecordBatch | None:
    """The prefixes that half of WIDE of a chunk's pages have in their articles, and the number of its pages."""
    array = _Array(held)
    if not len(array.order):
        return None
    often = array.on(array.inside) >= max(1, WIDE / 2 * array.pages)
    prefix = grams(array.tokens, LENGTH)[array.order[array.starts[often]]].view(np.int64)
    columns = [np.full(len(prefix), held[0][0], np.int64), prefix, np.full(len(prefix), array.pages, np.int64)]
    return pa.RecordBatch.from_arrays(list(map(pa.array, columns)), ["host", "prefix", "pages"])


def _rows(batches):
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("host", "stream", "variant")]
        for *row, tokens, ends in zip(*columns, batch.column("tokens"), batch.column("ends"), strict=True):
            yield (*row, mix(tokens.values.to_numpy().view(np.uint32).astype(np.uint64)), ends.as_py())


def _by_chunk(decide, chunk: int | None):
    """``decide`` on the rows of each host, which come sorted by host, stream and variant; on ``chunk`` tokens at a time, if given. Rows of one
    stream stay together, and of rows equal in all one counts."""

    def run(batches):
        held: list[tuple] = []
        size = 0
        for row in _rows(batches):
            full = chunk is not None and size >= chunk and held and held[-1][1] != row[1]
            if held and (held[0][0] != row[0] or full):
                if (out := decide(held)) is not None:
                    yield out
                held, size = [], 0
            if held and held[-1][:3] == row[:3]:
                continue
            held.append(row)
            size += len(row[3])
        if held and (out := decide(held)) is not None:
            yield out

    return run


def _found(pick, schema: str, wanted: str | None = None):
    """A function for batches of pages that makes, of each page's prefixes and places, rows of ``schema`` besides the page's key.

    ``pick`` chooses among the places inside of articles (all, on pages without one) and gives the columns; ``wanted`` names a column of
    prefixes, those that count.
    """
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches):
        for batch in batches:
            given = batch.column(wanted) if wanted else [None] * batch.num_rows
            out = []
            for (*key, tokens, ends), some in zip(_rows([batch]), given, strict=True):
                prefix = grams(tokens, LENGTH).view(np.int64)
                inside = _inside(len(tokens), ends)[: len(prefix)]
                known = None if some is None else np.isin(prefix, some.values.to_numpy())
                values = pick(prefix, inside, len(ends) > 1, known)
                if len(values[0]):
                    out.append((*key, *values))
            columns = [pa.array([x[i] for x in out], pa.int64()) for i in range(3)]
            columns += [pa.array([x[3 + i] for x in out], pa.list_(pa.int64())) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays(columns, ["host", "stream", "variant", *names])

    return run


def _wide_on_many_chunks(pages: DataFrame, sizes: DataFrame, chunk: int) -> DataFrame:
    """For hosts of several chunks the places of prefixes that many pages have in their articles: rows of _COVERED."""
    dealt = pages.repartitionByRange("host", "stream").sortWithinPartitions("host", "stream", "variant")
    named = map_batches(dealt, _by_chunk(_candidates, chunk), "host bigint, prefix bigint, pages bigint")
    # Where WIDE of all pages have a prefix, chunks that name it have this share of the pages. So at most 1 / share times as many prefixes
    # are left as the pages of a chunk can have in common: some times the length of a page, whatever the number of chunks.
    share = WIDE / 2 / (1 - WIDE / 2)
    likely = (
        named.groupBy("host", "prefix")
        .agg(F.sum("pages").alias("pages"))
        .join(sizes, "host")
        .filter(F.col("pages") >= share * F.col("total"))
        .groupBy("host")
        .agg(F.collect_list("prefix").alias("wanted"))
    )
    likely = materialise(likely, "likely-prefixes")
    having = _found(lambda prefix, inside, named, known: [np.unique(prefix[inside & known])], "prefixes array", "wanted")
    schema = f"{_KEY}, prefixes array<bigint>"
    counted = (
        map_batches(pages.join(likely, "host"), having, schema)
        .select("host", "stream", F.explode("prefixes").alias("prefix"))
        .groupBy("host", "prefix")
        .agg(F.countDistinct("stream").alias("pages"))
    )
    wide = (
        counted.join(sizes, "host")
        .filter((F.col("pages") >= MANY) & (F.col("pages") >= WIDE * F.col("total")))
        .groupBy("host")
        .agg(F.collect_list("prefix").alias("wanted"))
    )
    wide = materialise(wide, "wide-prefixes")
    covering = _found(lambda prefix, inside, named, known: [2 * np.flatnonzero(inside & known) + 1], "covered array", "wanted")
    return map_batches(pages.join(wide, "host"), covering, f"{_KEY}, covered array<bigint>")


def _twice_on_many_chunks(pages: DataFrame) -> DataFrame:
    """For hosts of several chunks the places, on pages without an article, of prefixes that stand outside of articles on two pages."""
    nameless = pages.filter(F.size("ends") == 1)
    some = materialise(nameless.select("host").distinct(), "nameless-hosts")

    def beside(prefix, inside, named, known):
        return [np.unique(prefix[~inside] if named else prefix)]

    outside = map_batches(pages.join(some, "host", "left_semi"), _found(beside, "prefixes array"), f"{_KEY}, prefixes array<bigint>")
    shared = (
        outside.select("host", "stream", F.explode("prefixes").alias("prefix"))
        .groupBy("host", "prefix")
        .agg(F.min("stream").alias("low"), F.max("stream").alias("high"))
        .filter("low < high")
        .select("host", "prefix")
    )
    shared = materialise(shared, "shared-prefixes")
    placed = map_batches(
        nameless,
        _found(lambda prefix, inside, named, known: [prefix, np.arange(len(prefix))], "prefixes array, places array"),
        f"{_KEY}, prefixes array<bigint>, places array<bigint>",
    )
    each = placed.select("host", "stream", "variant", F.explode(F.arrays_zip("prefixes", "places")).alias("x"))
    found = each.select("host", "stream", "variant", F.col("x.prefixes").alias("prefix"), "x.places").join(shared, ["host", "prefix"])
    return found.groupBy("host", "stream", "variant").agg(F.collect_list(2 * F.col("places")).alias("covered"))


def repeated(
    pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", chunk: int = CHUNK
) -> DataFrame:
    """For each page with boilerplate: ``h1``, ``h2`` (hashes of key, url and html) and ``covered``, the sorted places
    in its stream where such a substring of LENGTH tokens begins, times two, plus one if many pages of the host have it in
    their articles. On a page with an article only such places inside of it are named.

    Pages of equal streams are one page here, so that copies do not make each other boilerplate, and copies in any number
    are decided once.
    """
    streams = materialise(_streams(_keyed(pages, key, url, html)), "streams")
    known = streams.filter(F.col("size") >= LENGTH)
    texts = streams.filter("tokens IS NOT NULL").select("host", "stream", "variant", "tokens", "ends")
    sizes = (
        known.groupBy("host", "stream")
        .agg(F.first("size").alias("size"))
        .groupBy("host")
        .agg(F.count(F.lit(1)).alias("total"), F.sum("size").alias("size"))
    )
    large = materialise(sizes.filter(F.col("size") > chunk), "large-hosts")
    order = ["host", "stream", "variant"]
    dealt = texts.join(large, "host", "left_anti").repartition("host").sortWithinPartitions(*order)
    found = map_batches(dealt, _by_chunk(_covered, None), _COVERED)
    if not large.isEmpty():
        parts = texts.join(large, "host", "left_semi")
        both = _wide_on_many_chunks(parts, large, chunk).unionByName(_twice_on_many_chunks(parts))
        merged = both.groupBy("host", "stream", "variant").agg(F.flatten(F.collect_list("covered")).alias("c"))
        # A place that is both counts once, as wide.
        lesser = F.transform(F.filter("c", lambda x: x % 2 == 1), lambda x: x - 1)
        covered = F.sort_array(F.array_except("c", lesser)).cast("array<int>")
        found = found.unionByName(merged.select("host", "stream", "variant", covered.alias("covered")))
    # Stored, so that pages of which there are many copies can be split.
    found = materialise(found, "covered")
    each = known.select("h1", "h2", "host", "stream", "variant").distinct()
    return each.join(found, ["host", "stream", "variant"]).select("h1", "h2", "covered")


def _unique_runs(page: str, covered: list[int]) -> tuple[str, bool]:
    """The article's blocks, or else the open ones, without what is boilerplate, and whether there is an article."""
    headings: set[int] = set()
    found = blocks(page, headings)
    named = any(kind == ARTICLE for kind, _ in found)
    wanted = ARTICLE if named else OPEN
    every = "\n".join(text for kind, text in found if kind == wanted)
    if not covered:
        return every, named
    gone = {i for x in covered for i in range(x >> 1, (x >> 1) + LENGTH)}
    out, place, size, lost = [], 0, 0, 0
    for number, (kind, text) in enumerate(found):
        tokens = re.findall(r"[^\x20\x09-\x0D]+", text)
        if kind == wanted:
            left = [t for i, t in enumerate(tokens, place) if i not in gone]
            if named and (left or number in headings):
                left = tokens
            size, lost = size + len(tokens), lost + len(tokens) - len(left)
            if left:
                out.append(" ".join(left))
        place += len(tokens)
    if named and 2 * lost >= size:
        # Another copy of the article.
        return every, named
    return "\n".join(out), named


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One row per page: ``key``, ``url``, ``text`` (its main text, blocks joined by line ends; empty if none) and ``named``
    (whether the page named its article).

    Character references are decoded, and white space inside a block becomes one space. A null or empty
    page has no text, a null or odd url is of the host without a name. Rows equal in key, url and html are alike. An
    empty table gives no rows. Other columns are not read.
    """
    rows = _keyed(pages, key, url, html)

    # Stored, so that a small one need not deal out the pages.
    boilerplate = materialise(repeated(pages, key, url, html), "boilerplate")
    joined = rows.join(boilerplate, ["h1", "h2"], "left")

    def decide(batches):
        for batch in batches:
            for part in slices(batch, "html"):
                found = [
                    _unique_runs(x or "", c or [])
                    for x, c in zip(*(part.column(n).to_pylist() for n in ("html", "covered")), strict=True)
                ]
                texts, named = pa.array([t for t, _ in found], pa.string()), pa.array([n for _, n in found], pa.bool_())
                yield pa.RecordBatch.from_arrays(
                    [part.column("key"), part.column("url"), texts, named], ["key", "url", "text", "named"]
                )

    schema = fields(rows, "key", more="url string, text string, named boolean")
    decided = map_batches(joined.select("key", "url", "html", "covered"), decide, schema)
    return decided.select(F.col("key").alias(key), F.col("url").alias(url), "text", "named")
