import random
import re
import time
from html.parser import HTMLParser

import pytest

from atende.llm.html_text import BLOCK, UNSEEN, VOID, events, html_text, page_text

CASES = {
    "": "", "plain &amp; simple": "plain & simple", "<p>a<p>b": "a\n\nb", "<div>a</div><div>b</div>": "a\nb", "a<br>b<br><br>c": "a\nb\n\nc",
    "<ul><li>x<li>y<ul><li>z</ul></ul>t": "  - x\n".replace("  - ", "- ") + "- y\n  - z\n\nt", "<ol><li>x</li><li>y</li></ol>": "1. x\n2. y",
    "<b>a</b> <i>b</i>c": "a bc", "<b>a </b> b": "a b", "<script>var t='</p>';</script>x": "x", "<style>p{}</style><p hidden>h</p>v": "v",
    "<p style='display: none'>h</p>v": "v", "<table><tr><td>a<td>bbb<tr><td>cccc<td>d</table>": "a     bbb\ncccc  d",
    "<table><td>lone cell</table>": "lone cell", "<pre> a\n  b</pre>": " a\n  b", "<head><title>t</title></head><body>b": "b", "<!-- x --><!DOCTYPE html>y": "y",
    "a < b and c > d": "a < b and c > d", "<p>unclosed <b>bold": "unclosed bold", "</div></p>x": "x", "<a href='x>y'>link</a>": "link", "<input type=hidden value=1>k": "k",
    "<div>" * 20000 + "deep": "deep", "<title>t</title>seen": "tseen", "<td>stray</td>": "stray", "x<!-- open": "x", "<p": "<p", "<textarea>a <b> c</textarea>": "a <b> c",
}


@pytest.mark.parametrize("page", list(CASES))
def test_page_text(page):
    assert page_text(page) == CASES[page]


def test_events_are_balanced():
    for page in CASES:
        open_ = []
        for kind, name, _ in events(page):
            if kind == "open":
                open_.append(name)
            elif kind == "close":
                assert open_.pop() == name
        assert not open_


class Reader(HTMLParser):
    """Words of a page in order, by the parser of the standard library: what is inside a hidden element is left out."""

    def __init__(self):
        super().__init__()
        self.open, self.words = [], [""]

    def handle_starttag(self, tag, attrs):
        named = dict(attrs)
        style = (named.get("style") or "").replace(" ", "")
        unseen = tag in UNSEEN or "hidden" in named or "display:none" in style or "visibility:hidden" in style
        if tag in BLOCK or tag in ("br", "td", "th", "tr"):
            self.words.append("")
        if tag not in VOID:
            self.open.append((tag, unseen))

    def handle_endtag(self, tag):
        while self.open and any(t == tag for t, _ in self.open):
            if self.open.pop()[0] == tag:
                break
        if tag in BLOCK or tag in ("td", "th", "tr"):
            self.words.append("")

    def handle_data(self, data):
        if not any(unseen for _, unseen in self.open):
            self.words[-1] += data


def read(page):
    reader = Reader()
    reader.feed(page)
    reader.close()
    return [w for part in reader.words for w in part.split()]


def unmarked(text):
    """Words of a rendered page without list markers and rules."""
    return [w for line in text.split("\n") for w in re.sub(r"^ *((- |\d+\. ) *)*|^ *---$", "", line).split()]


def test_real_pages_against_another_parser(spark, sf_dir):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    got = html_text(spark.read.parquet(f"{sf_dir}/pages.parquet")).select("row.page_id", "visible_text").collect()
    assert len(got) == len(pages)
    for r in got:
        assert sorted(unmarked(r.visible_text)) == sorted(unmarked("\n".join(read(pages[r.page_id])))), r.page_id


# --- Random pages against a recursive rendering of the tree they were made from ---------------------------


def make(r, depth=0):
    """A node: (tag, hidden, children) or a text."""
    if depth > 4 or r.random() < 0.3:
        return " ".join(f"w{r.randrange(10**6)}" for _ in range(r.randrange(1, 4)))
    tag = r.choice(["p", "div", "ul", "ol", "b", "span", "section", "table"])
    if tag in ("ul", "ol"):
        kids = [("li", False, [make(r, depth + 2) for _ in range(r.randrange(1, 3))]) for _ in range(r.randrange(1, 4))]
    elif tag == "table":
        width = r.randrange(1, 4)
        kids = [("tr", False, [("td", False, [f"c{r.randrange(10**r.randrange(1, 6))}"]) for _ in range(width)]) for _ in range(r.randrange(1, 4))]
    elif tag in ("p", "b", "span"):
        kids = [make(r, 9) for _ in range(r.randrange(1, 3))]
    else:
        kids = [make(r, depth + 1) for _ in range(r.randrange(1, 4))]
    return tag, r.random() < 0.15, kids


def markup(r, node):
    if isinstance(node, str):
        return node
    tag, hidden, kids = node
    body = " ".join(markup(r, k) for k in kids)
    close = "" if tag in ("li", "td", "tr") and r.random() < 0.5 else f"</{tag.upper() if r.random() < 0.2 else tag}>"
    attrs = r.choice([" hidden", " style='display:none'", ' style="Display: None"']) if hidden else r.choice(["", " id=x", " title='a > b'", ' data-x="<p>"'])
    return f"<{tag}{attrs}>{body}{close}"


def lines(node):
    """Words of each line of a node: blocks and items on lines of their own, cells of a row side by side."""
    if isinstance(node, str):
        return [["inline", node.split()]]
    tag, hidden, kids = node
    if hidden:
        return [["break", []]] if tag in BLOCK else []
    if tag == "tr":
        return [["line", [k[2][0] for k in kids]]]
    inner = [x for k in kids for x in lines(k)]
    return [["break", []], *inner, ["break", []]] if tag in BLOCK else inner


def expected_lines(nodes):
    out, run = [], []
    for kind, words in [x for n in nodes for x in lines(n)] + [["break", []]]:
        if kind == "inline":
            run += words
            continue
        out += [run] if run else []
        run = []
        out += [words] if kind == "line" else []
    return out


@pytest.mark.parametrize("seed", range(300))
def test_random_pages_against_a_recursive_rendering(seed):
    r = random.Random(seed)
    nodes = [make(r) for _ in range(r.randrange(1, 5))]
    text = page_text(" ".join(markup(r, n) for n in nodes))
    assert [w for line in text.split("\n") if (w := unmarked(line))] == expected_lines(nodes)
    tables = [n for n in nodes if not isinstance(n, str) and n[0] == "table" and not n[1]]
    for _, _, rows in tables:  # the cells of a column start at the same place
        cells = [[k[2][0] for k in row[2]] for row in rows]
        width = [max(len(row[k]) for row in cells) for k in range(len(cells[0]))]
        for row in cells:
            assert "  ".join(c.ljust(n) for c, n in zip(row, width)).rstrip() in text


SLOW = {
    "quotes": "<p a='b' " * 100_000, "odd quotes": "<a " + '"x' * 400_001, "tags": "<a " * 330_000, "open quotes": '<a "' * 250_000, "quoted ends": '<a ">" ' * 150_000,
    "comments": "<!--" * 250_000, "signs": "<" * 1_000_000, "items": "<li><div>" * 100_000, "lists": "<ul><li>x" * 50_000, "scope": "<table><tr><td>" + "<i>" * 99_999 + "</b>" * 99_999,
    "scripts": "<script>" * 100_000, "entities": "&amp;" * 200_000, "paragraphs": "<p>" * 300_000, "wide": "<table><tr><td>" + "x" * 500_000 + "<td>y" + "<tr><td>a<td>b" * 20_000,
}


@pytest.mark.parametrize("name", list(SLOW))
def test_long_pages_take_linear_time(name):
    start = time.process_time()
    half = len(SLOW[name]) // 2
    page_text(SLOW[name][:half])
    middle = time.process_time()
    text = page_text(SLOW[name])
    assert time.process_time() - middle < 4 * (middle - start) + 2
    assert len(text) < 8 * len(SLOW[name])


@pytest.mark.parametrize("page, text", [
    ("<SCRIPT>x</SCRIPT><p>\u0130 visible</p>", "\u0130 visible"), ("<STYLE>p</sTyLe>\u0130 a", "\u0130 a"), ("<script>a</\u017fcript>b</script>c", "c"),
    ('<p title="open>a</p><p>b', "a\n\nb"), ("<a href='x>y", "y"),
])
def test_broken_markup_loses_no_text(page, text):
    assert page_text(page) == text


def test_nulls_and_empty_table(spark):
    df = spark.createDataFrame([(1, None, "u"), (1, None, "u"), (None, "<p>a", "v")], "page_id long, html string, visible_text string")
    assert sorted(r.visible_text for r in html_text(df).collect()) == ["", "", "a"]
    assert html_text(df.where("false")).count() == 0
