"""Host suffix arrays against plain Python, headings and whole blocks, and the articles of all test pages."""

import html
import random
import re
from collections import defaultdict

import pytest

from wardstream.llm import main_text
from wardstream.llm.queries import QUERIES

PAGES = "page_id long, url string, html string"


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_op9_articles_of_all_pages(spark, sf):
    folder = f"/root/testdata/{sf}"
    got = {r.page_id: r for r in QUERIES["op9_host_suffixes"](spark, folder).collect()}
    pages = spark.read.parquet(f"{folder}/pages.parquet").collect()
    assert len(pages) == len(got)
    for p in pages:
        inside = re.search(r"<article>(.*)</article>", p.html, re.S)[1]
        parts = (html.unescape(re.sub("<[^>]*>", "", x)) for x in re.split("</?(?:p|h1)>", inside))
        want = "\n".join(y for y in (" ".join(x.split()) for x in parts) if y)
        assert (got[p.page_id].text, got[p.page_id].n_chars) == (want, len(want))


def random_pages(rng, hosts=3, n=14):
    """Pages of phrases, some of them shared, with and without an article; and their tokens by part."""
    phrases = [[f"t{rng.randrange(6)}" for _ in range(rng.randrange(3, 14))] for _ in range(5)]
    out = []
    for h in range(hosts):
        for i in range(n):
            parts = [sum((rng.choice(phrases) for _ in range(rng.randrange(3))), []) for _ in range(3)]
            named = rng.random() < 0.6
            before, inside, after = (" ".join(p) for p in parts)
            page = f"<div>{before}</div><article>{inside}</article><div>{after}</div>" if named else f"<p>{before}</p><p>{inside}</p><p>{after}</p>"
            out.append((100 * h + i, f"http://h{h}.example/{i}", page, parts, named and bool(parts[1])))
    return out


def plainly(pages):
    """The covered places of each page, from sets of all substrings."""
    size, covered = main_text.LENGTH, {}
    hosts = defaultdict(list)
    for key, url, _, parts, named in pages:
        tokens = sum(parts, [])
        if len(tokens) >= size:
            first = len(parts[0])
            inside = [not named or first <= i < first + len(parts[1]) for i in range(len(tokens))]
            hosts[url.split("/")[2]].append((key, tuple(tokens), inside, named))
    for held in hosts.values():
        total = len({t for _, t, _, _ in held})
        within, beside = defaultdict(set), defaultdict(set)
        for _, tokens, inside, named in held:
            for i in range(len(tokens) - size + 1):
                if inside[i]:
                    within[tokens[i : i + size]].add(tokens)
                if not named or not inside[i]:
                    beside[tokens[i : i + size]].add(tokens)
        for key, tokens, inside, named in held:
            for i in range(len(tokens) - size + 1):
                on = len(within[tokens[i : i + size]])
                wide = inside[i] and on >= main_text.MANY and on >= main_text.WIDE * total
                if wide or not named and len(beside[tokens[i : i + size]]) > 1:
                    covered.setdefault(key, []).append(2 * i + wide)
    return covered


@pytest.mark.parametrize("seed", range(4))
def test_covered_places_of_plain_python(spark, seed):
    pages = random_pages(random.Random(seed))
    want = plainly(pages)
    rows = [p[:3] for p in pages]
    df = spark.createDataFrame(rows + rows[:5], PAGES).repartition(3)
    hashes = {(r.h1, r.h2): r.key for r in main_text._keyed(df, "page_id", "url", "html").collect()}
    assert want and {x % 2 for v in want.values() for x in v} == {0, 1}
    for chunk in (main_text.CHUNK, 25):
        found = main_text.repeated(df, chunk=chunk).collect()
        assert {hashes[r.h1, r.h2]: r.covered for r in found} == want and len(found) == len(want)


def test_headings_and_parts_of_blocks_stay(spark):
    plea = "please subscribe to our letter and never miss a story"
    rows, want = [], {}
    for i in range(6):
        own = " ".join(f"w{i}x{j}" for j in range(30))
        rows.append((i, f"http://h.example/{i}", f"<article><h1>{plea}</h1><p>{own}</p><p>{plea}</p><p>{own[:9]} {plea}</p></article>"))
        want[i] = f"{plea}\n{own}\n{own[:9]} {plea}"
    # Two pages of three share a headline that the third only names beside its article.
    line = "a headline of two articles that a third page names in a list"
    for i in range(3):
        own = " ".join(f"z{i}x{j}" for j in range(30))
        page = f"<article><p>{line}</p><p>{own}</p></article>" if i < 2 else f"<article>{own}</article><div>{line}</div>"
        rows.append((10 + i, f"http://three.example/{i}", page))
        want[10 + i] = f"{line}\n{own}" if i < 2 else own
    got = {r.page_id: r.text for r in main_text.extract(spark.createDataFrame(rows, PAGES)).collect()}
    assert got == want


def test_nameless_containers(spark):
    """Pages whose containers have no names: the arrays decide. Precision and recall of the article's words."""
    rng = random.Random(5)
    rows, want = [], {}
    for h in range(6):
        menu = " ".join(f"m{h}x{j}" for j in range(15))
        foot = " ".join(f"f{h}x{j}" for j in range(25))
        for i in range(12):
            own = " ".join(f"w{rng.randrange(3000)}" for _ in range(rng.randrange(30, 120)))
            rows.append((100 * h + i, f"http://h{h}.example/{i}", f"<div>{menu}</div><div><p>{own}</p></div><div>{foot} {2000 + i}</div>"))
            want[100 * h + i] = own.split()
    got = {r.page_id: r.text.split() for r in main_text.extract(spark.createDataFrame(rows, PAGES)).collect()}
    kept = sum(len(got[k]) for k in want)
    right = sum(len(set(got[k]) & set(want[k])) for k in want)
    assert right >= 0.99 * sum(len(set(w)) for w in want.values())
    assert sum(len([x for x in got[k] if x in set(want[k])]) for k in want) >= 0.97 * kept


def test_many_copies_of_a_page(spark):
    """Copies are one page: they do not make each other boilerplate, and each is decided."""
    menu = "home news sport weather travel culture science shop about contact"
    page = f"<div>{menu}</div><p>{' '.join(f'c{j}' for j in range(40))}</p>"
    rows = [(i, f"http://h.example/{i}", page) for i in range(300)] + [(1000 + i, f"http://h.example/o{i}", f"<div>{menu}</div><p>{' '.join(f'o{i}x{j}' for j in range(20))}</p>") for i in range(3)]
    df = spark.createDataFrame(rows, PAGES).repartition(4)
    got = {r.page_id: r.text for r in main_text.extract(df).collect()}
    assert {got[i] for i in range(300)} == {" ".join(f"c{j}" for j in range(40))}
    assert all(got[1000 + i] == " ".join(f"o{i}x{j}" for j in range(20)) for i in range(3))
