import random
import re
import time
from html import unescape

import pytest

from tidewater.llm.html import render

HARD = {
    "a wide cell": "<table><tr><td>" + "word " * 10_000 + "<td>x" + "<tr><td>a<td>b" * 2000 + "</table>",
    "a megabyte": "<table><tr><td>" + "word " * 100_000 + "<td>x" + "<tr><td>a<td>b" * 35_000 + "</table>",
    "blocks in a stray cell": "<p><td>" + "<div>" * 100_000 + "x",
    "deep lists": "<ul><li>x" * 20_000,
    "deep quotes": "<blockquote>x" * 20_000,
    "many columns": "<table><tr>" + "<td>x" * 5000 + ("<tr>" + "<td colspan=1000>" * 4 + "<td colspan=999><td>y") * 2000,
    "deep tables": "<table><tr><td>a<td>b" * 2000,
    "stray ends": "<td>" * 20_000 + "</b>" * 20_000 + "x",
    "odd comments": "<!-- --!>a" * 20_000,
}


@pytest.mark.parametrize("name", HARD)
def test_hard_pages_take_linear_time_and_space(name):
    page = HARD[name]
    began = time.process_time()
    text = render(page)
    assert len(text) <= 10 * len(page) and time.process_time() - began < 20


def test_what_browsers_show():
    assert render("a<svg><title>no</title><desc>no</desc><text>seen</text></svg>b") == "aseenb"
    assert render("<textarea>abc <b>x &amp; y</textarea>z") == "abc <b>x & y\nz"
    assert render("<xmp><i>k</i> &amp;</xmp>w<plaintext>abc <b>x</plaintext> more") == "<i>k</i> &amp;\nw\nabc <b>x</plaintext> more"
    assert render("<textarea>never <i>closed") == "never <i>closed"
    assert render("a<!-- x --!>b<!-- y -->c --!> d") == "abc --!> d"
    assert render("<dialog>no</dialog><dialog open>yes</dialog>") == "yes"
    assert render("<center>a</center>b") == "a\nb"
    assert render("<ol reversed><li>a<li>b<li value=9>c</ol>") == "3. a\n2. b\n9. c"
    assert render("<ol start=-1><li>x<li>y</ol>") == "-1. x\n0. y"


def test_tables_are_aligned_while_that_is_mostly_text():
    assert render("<table><tr><td>name<td>n<tr><td>a longer one<td>12</table>") == "name          n\na longer one  12"
    wide = render("<table><tr><td>" + "w " * 300 + "<td>x" + "<tr><td>a<td>b" * 50 + "</table>")
    assert wide.splitlines()[1:] == ["a  b"] * 50


def plain(page):
    """The words of a page of balanced elements, in order: what is left without unseen elements and tags."""
    page = re.sub(r"<!--.*?-->", "", page, flags=re.S)
    page = re.sub(r"<(script|style|title)>.*?</\1>", "", page, flags=re.S)
    while (less := re.sub(r"<(\w+) hidden>(?:(?!</?\1\b).)*</\1>", " ", page, flags=re.S)) != page:
        page = less
    return unescape(re.sub(r"<[^>]*>", " ", page)).split()


def test_all_visible_words_of_generated_pages():
    """Random nested blocks, lists and tables against a plain second reading; marks of lists aren't words."""
    rng = random.Random(41)
    number = iter(range(1_000_000))

    def words():
        return " ".join(f"w{next(number)}" for _ in range(rng.randrange(1, 4)))

    def make(depth):
        kind = rng.choice(["text", "text", "p", "div", "b", "ul", "table", "section", "script", "comment", "hidden", "blockquote", "entity"] if depth < 5 else ["text"])
        inner = lambda: "".join(f" {make(depth + 1)} " for _ in range(rng.randrange(1, 4)))
        if kind == "text":
            return words()
        if kind == "entity":
            return words() + " &lt;e&gt; " + words()
        if kind == "script":
            return f"<script>{words()} < b</script>"
        if kind == "comment":
            return f"<!-- {words()} <p> -->"
        if kind == "hidden":
            return f"<section hidden>{words()}</section>"
        if kind == "ul":
            return "<ul>" + "".join(f"<li>{inner()}</li>" for _ in range(2)) + "</ul>"
        if kind == "table":
            return "<table>" + "".join("<tr>" + "".join(f"<td>{words()}</td>" for _ in range(3)) + "</tr>" for _ in range(2)) + "</table>"
        return f"<p>{words()}</p>" if kind == "p" else f"<{kind}>{inner()}</{kind}>"

    for _ in range(300):
        page = "".join(f" {make(0)} " for _ in range(4))
        assert [w for w in render(page).split() if w != "-"] == plain(page)
