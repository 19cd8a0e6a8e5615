"""Archives, main text and URL rules."""

import gzip
import hashlib
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import Row

from payfeed.llm import pagetext, urls, warc


@pytest.fixture
def make_pages(spark):
    def make(rows):
        schema = "page_id long, url string, html string, text string, rule string, digest string"
        return spark.createDataFrame([Row(i, u, h, "x", "y", "z") for i, u, h in rows], schema)

    return make


BIG = "é" * 300
ROWS = [(i, f"http://h/{i}", BIG if i % 3 == 0 else f"page {i} " * 20) for i in range(60)] + [
    (60, None, None), (61, "bad\r\nurl x", "small"), (62, "u", "small"), (None, "u", BIG), (63, "u", "\r\n\r\nWARC/1.1\r\n" * 30), (64, "u", "x" * 3_000_000), (5, "again", "page 5 " * 20),
]


def test_archives_round_trip(make_pages):
    got = warc.archive_pages(make_pages(ROWS), payload=True).collect()
    first = {}
    for page_id, _, page in ROWS:
        if page_id is not None and len((page or "").encode()) >= 100:
            first[page] = min(page_id, first.get(page, page_id))
    want = Counter()
    for page_id, _, page in ROWS:
        data = (page or "").encode()
        refers = first.get(page) if page_id != first.get(page) else None
        want[page_id, len(data), hashlib.sha256(data).hexdigest(), "response" if refers is None else "revisit", refers] += 1
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == want
    assert {bytes(r.payload) for r in got if r.payload is not None} == {(p or "").encode() for _, _, p in ROWS}


def test_no_pages(make_pages):
    assert warc.archive_pages(make_pages([])).count() == 0
    assert urls.judge(make_pages([]), ["page_id"]).count() == 0
    assert pagetext.extract(make_pages([]), ["page_id"], MODEL()).count() == 0


def test_normaliser_reads_any_gzip_and_indexes_members(tmp_path):
    made = [warc.encode_record(i, f"http://x/{i}", b"data %d" % i * 50, "d", None) for i in range(20)]
    whole = tmp_path / "a.warc.gz"
    whole.write_bytes(gzip.compress(b"".join(made[:12])) + gzip.compress(b"".join(made[12:])))
    path, index, count = warc.normalise_file(str(whole), str(tmp_path / "out"))
    assert count == 20
    import json

    data = open(path, "rb").read()
    lines = [json.loads(x) for x in open(index)]
    assert [zlib.decompress(data[x["offset"] : x["offset"] + x["length"]], 31) for x in lines] == made
    assert sum(x["length"] for x in lines) == len(data)
    (tmp_path / "cut.warc.gz").write_bytes(gzip.compress(b"".join(made)[:-3]))
    with pytest.raises(ValueError):
        warc.normalise_file(str(tmp_path / "cut.warc.gz"), str(tmp_path / "out"))


def MODEL():
    return pagetext.default_model()


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body>
<nav><ul><li><a href="/a">Home</a></li><li><a href="/b">News</a></li><li><a href="/c">About us</a></li></ul></nav>
<div class="ad">Buy these things now.</div><!-- <p>hidden</p> -->
<article><h1>A   title &amp; more</h1><p><b>First line of the text,
with words &lt;and&gt; more of them to read.<br><p>Second paragraph that goes on for a while, as texts do when they say something.
<p>Third one, also rather long, so that nobody takes it for a menu or a notice of any kind.</p></article>
<form><label>Name</label><input><p>Sign up here</p></form>
<footer>&copy; somebody 2020</footer></body></html>"""


def test_main_text():
    assert pagetext.main_texts([PAGE], MODEL())[0] == (
        "A title & more\nFirst line of the text, with words <and> more of them to read.\n"
        "Second paragraph that goes on for a while, as texts do when they say something.\n"
        "Third one, also rather long, so that nobody takes it for a menu or a notice of any kind."
    )


def test_held_out_pages_of_other_layouts():
    trees = [pagetext.parse(p) for p in pagetext.labelled_pages(100, seed=1234)]
    found = pagetext.marginals(trees, MODEL()) > 0.5
    label = np.concatenate([t.label for t in trees])
    leaf = np.concatenate([[t is not None for t in tree.text] for tree in trees])
    assert (found == (label == 1))[leaf & (label >= 0)].mean() > 0.93


def test_messages_give_exact_marginals():
    """Against the sum over all labellings of small trees."""
    rng = np.random.default_rng(5)
    for n in (1, 2, 5, 8):
        tree = pagetext.Tree()
        for i in range(n):
            tree.add(int(rng.integers(0, i)) if i else -1, "p", [], None, -1)
        forest = pagetext.Forest([tree])
        unary, pair = rng.normal(size=(n, 2)), rng.normal(size=(n, 2, 2))
        belief = forest.beliefs(unary, pair)[2]
        weight = np.zeros((n, 2))
        for labels in np.ndindex(*(2,) * n):
            score = sum(unary[i, x] for i, x in enumerate(labels)) + sum(pair[i, labels[tree.parent[i]], labels[i]] for i in range(1, n))
            for i, x in enumerate(labels):
                weight[i, x] += np.exp(score)
        assert np.allclose(np.exp(belief[:, 1]) / np.exp(belief).sum(1), weight[:, 1] / weight.sum(1))


@pytest.mark.parametrize("page", [None, "", "<", "<p", "</p></div>", "<div><div><p>x", "<script>", "<!-- open", "plain text", "<a><b></a></b>" * 50, "<div>" * 3000 + "deep", "&#0;&bogus;&#x110000;"])
def test_broken_pages(page):
    tree = pagetext.parse(page)
    assert all(p < i for i, p in enumerate(tree.parent))
    assert isinstance(pagetext.main_texts([page], MODEL())[0], str)


JUNK = ["<a ", '<a "x ', "<a '", '<a href="', "<div>", "</p>", "<h1>", "<li>", "<span>", "<button>", "<svg>", "<p><svg>", "<svg><foreignObject><p>", "<!--", "<![CDATA["]


@pytest.mark.parametrize("junk", JUNK)
def test_junk_is_read_in_linear_time(junk):
    import time

    took = []
    for size in (25_000, 100_000):
        began = time.process_time()
        pagetext.main_texts([junk * (size // len(junk))], MODEL())
        took.append(time.process_time() - began)
    assert took[1] < max(1.5, 10 * took[0])


def prose(n, k=0):
    return " ".join(("lorem", "ipsum", "dolor", "amet", "sit")[(i + k) % 5] for i in range(n)).capitalize() + "."


NAV = "<nav><ul>" + "".join(f'<li><a href="/{i}">Link {i}</a></li>' for i in range(6)) + "</ul></nav>"
FOOT = "<footer><p>Copyright 2020 by somebody.</p></footer>"


@pytest.mark.parametrize("tag", ["article", "div", "section", "main"])
@pytest.mark.parametrize("count, size", [(1, 18), (1, 54), (2, 18), (2, 54), (4, 18), (8, 54)])
def test_short_articles_without_heading(tag, count, size):
    blocks = [prose(size, i) for i in range(count)]
    page = f"<html><head><title>t</title></head><body>{NAV}<{tag}>{''.join(f'<p>{b}</p>' for b in blocks)}</{tag}>{FOOT}</body></html>"
    assert pagetext.main_texts([page], MODEL()) == ["\n".join(blocks)]


@pytest.mark.parametrize(
    "page, want",
    [
        ("<article><p>Press <button>Go</button> now to continue.</p></article>", "Press now to continue."),
        ("<article><details><summary>More of it</summary><p>Some text that is here to be read.</p></details></article>", "More of it\nSome text that is here to be read."),
        ("<article><p>a&nbsp;b &amp; c&#x41;</p></article>", "a b & cA"),
        ('<p title="abc>One sentence is here and it goes on.</p><p>Two</p>', "One sentence is here and it goes on.\nTwo"),
        (NAV + FOOT, ""),
        ('<div class="ad"><p>Buy it now.</p></div>' + FOOT, ""),
        ('<div class="sidebar"><h3>More</h3><p>Read this as well.</p></div>' + FOOT, ""),
        ("<form><p>Search here for it.</p></form>", ""),
    ],
)
def test_pages_with_little_text(page, want):
    assert pagetext.main_texts([page], MODEL()) == [want]


def test_quotes_of_attributes():
    page = "<div data-x='a>b' class=\"c>d\" e=f'g><p it's>One</p><p x = \"q\"y>Two</p><p a=\"open>Three</p>"
    assert [t for t in pagetext.parse(page).text if t] == ["One", "Two", "Three"]
    assert [t for t in pagetext.parse("<p>a</p><p b='c").text if t] == ["a", "<p b='c"]


def test_extract_keeps_rows(make_pages):
    rows = [(1, "u", PAGE), (1, "u", PAGE), (2, None, None), (None, "v", PAGE)]
    got = pagetext.extract(make_pages(rows), ["page_id", "url"], MODEL()).collect()
    assert Counter(r.page_id for r in got) == Counter(r[0] for r in rows)
    assert all(r.n_chars == len(r.text) for r in got)


CASES = {
    "http://example.com/en/1": ("com" + "/", "allow"),
    "https://WWW.Example.com/en/1?x": ("www.example.com/en/", "allow"),
    "https://m.example.com/en/": ("example.com/en/", "block"),
    "https://notexample.com/en/": ("com/", "allow"),
    "https://a.b.net/es/x#y": ("net/es/", "block"),
    "https://net/fr/": ("net/fr/", "block"),
    "https://a.net/FR/": (None, "allow"),
    "https://casino-win.example.org/x": (None, "block"),
    "https://casinos.example.org/x": (None, "allow"),
    "http://example.com": (None, "allow"),
    "http://com:80/en/": (None, "allow"),
    "example.com/en/": (None, "allow"),
    "": (None, "allow"),
    None: (None, "allow"),
}


def test_url_rules(make_pages, monkeypatch):
    CASES["http://example.com/en/1"] = ("example.com/en/", "block")
    rows = [(i, u, "") for i, u in enumerate(CASES)] * 2
    for most in (50_000, 2):  # one block of rules, and several
        monkeypatch.setattr(urls, "RULES", most)
        got = urls.judge(make_pages(rows), ["page_id"]).collect()
        assert len(got) == len(rows)
        assert {r.page_id: (r.rule, r.verdict) for r in got} == dict(enumerate(CASES.values()))


def test_url_parts(make_pages):
    parts = {"HTTP://A.b/P?q#f": ("a.b", "/P"), "x://h?q/r": ("h", ""), "x://h#f": ("h", ""), "x://É.COM/y://z": ("É.com", "/y://z"), "://": ("", ""), "x://u@h:1/a\nb": ("u@h:1", "/a\nb")}
    got = urls.judge(make_pages([(i, u, "") for i, u in enumerate(parts)]), ["page_id"]).collect()
    assert {r.page_id: (r.host, r.path) for r in got} == dict(enumerate(parts.values()))


def test_rules_stand_under_rare_tokens():
    rule = urls.host_rule("block", "example.com", "/en/page")
    assert rule.tokens == ("example", "com", "en")  # the open end of a path is no literal token
