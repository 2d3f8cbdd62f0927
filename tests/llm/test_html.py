"""Main texts of pages: wrappers of a host, tree matching against brute force, awkward markup."""

import random
import time
from functools import lru_cache

from payments_lake.llm.dom import tokens, tree
from payments_lake.llm.wrapper_induction import (
    Aligner, TreeMatch, main_text, main_texts, page_shape, read_shape,
)

SCHEMA = "page_id bigint, url string, html string, host string, template int, salt int, `a.b` int"


def pages(spark, rows):
    return spark.createDataFrame([(*row, "h", 1, 2, 3) for row in rows], SCHEMA)


def text_of(html):
    return main_text(html, None, frozenset(), Aligner())


def words(draw, n):
    return " ".join("".join(draw.choice("abcdefgh") for _ in range(draw.randint(3, 8))) for _ in range(n))


def plain_page(title, paragraphs, tail="</body></html>"):
    """A page whose elements don't say what they are."""
    body = "".join(f"<p>{p}</p>" for p in paragraphs)
    return (
        f"<html><head><title>{title}</title></head><body><div><span>The Daily Example</span> <a href=/>Home</a></div>"
        f"<div><div><h1>{title}</h1>{body}<p>Tell us what you think!</p></div></div>"
        f"<div>Made by Example Press. All rights reserved.</div>{tail}"
    )


def test_constant_nodes_are_template_and_varying_slots_content(spark):
    draw = random.Random(5)
    rows, want = [], {}
    passage = words(draw, 60)
    for i in range(30):
        title, paragraphs = words(draw, 8), [words(draw, 30) for _ in range(draw.randint(1, 6))]
        if i % 3 == 0:
            paragraphs.insert(1, passage)  # shared by a third of the pages, but no template
        rows.append((i, f"https://user@News.example.com:443/{i}", plain_page(title, paragraphs)))
        want[i] = " ".join([title, *paragraphs])
    copies = [(100 + i, "http://news.example.com/copy", rows[1][2]) for i in range(300)]
    want |= {100 + i: want[1] for i in range(300)}
    # Too few differing pages for a template, however often they are repeated.
    lonely = plain_page("lonely title", ["lonely words"])
    copies += [(500 + i, "http://lonely.example.com/", lonely) for i in range(20)]
    whole = "The Daily Example Home lonely title lonely words Tell us what you think! Made by Example Press. All rights reserved."
    want |= {500 + i: whole for i in range(20)}
    found = {r.page_id: r for r in main_texts(pages(spark, rows + copies)).collect()}
    assert {i: r.text for i, r in found.items()} == want
    assert all(r.n_chars == len(r.text) for r in found.values())


def test_template_found_though_shapes_differ(spark):
    draw = random.Random(6)
    rows, want = [], {}
    for i in range(12):
        title, first, second = words(draw, 6), words(draw, 25), words(draw, 25)
        extra = f"<div><ul><li>{words(draw, 2)}</li></ul></div>" * (i % 2) + "<table><tr><td>x</td></tr></table>" * (i % 3)
        html = f"<div>Shared head line</div><section><h1>{title}</h1><p>{first}<div>{second}</div></section>{extra}<div>Shared foot line</div>"
        rows.append((i, "//shapes.example.org/a", html))
        want[i] = (title, first, second)
    for r in main_texts(pages(spark, rows)).collect():
        assert "Shared" not in r.text and r.text.startswith(" ".join(want[r.page_id]))


def test_elements_that_say_what_they_are():
    html = """<!DOCTYPE html><html><head><title>x</title><style>p{}</style></head><body class="has-sidebar">
    <header>Site</header><nav><ul><li>One<li>Two</ul></nav><div class="cookie-notice">We use cookies</div>
    <div id="page" class="main-content sidebar-right"><article class="post comments-open"><header><h1>A &amp; B</h1></header>
    <p>First <b>bold<i>er</b> text&nbsp;here.<br>Next line<p>Second<aside>Pull quote</aside><div class="adSlot">Buy!</div>
    <ul><li>item 1<li>item 2</ul><table><tr><td>c1<td>c2</table><form><input name=q>Search</form>
    <pre>a
      b</pre><section id="comments"><article class="comment">Nice!</article></section><p hidden>secret</p></article></div>
    <div role=complementary>Side</div><footer>Foot</footer><script>var t="</p><p>no</p>";</script><!-- <p>no</p> --></body></html>"""
    assert text_of(html) == "A & B First bolder text here. Next line Second item 1 item 2 c1 c2 a b"


def test_awkward_markup():
    assert text_of("") == text_of("   \n ") == text_of("<p></p><div>") == text_of("<!-- never ends <p>x") == ""
    assert text_of("just words") == "just words"
    assert text_of("<p>1 < 2 & 3 &lt; 4 &#x41;&copy;&unknown;") == "1 < 2 & 3 < 4 A©&unknown;"
    assert text_of('<p title="a > b">x</p><p title="never ends>y</p><p>z') == "x y z"
    assert text_of("<script>alert('<p>')") == "" and text_of("<p>a<script>x</SCRIPT >b") == "ab"
    assert text_of("a</div></p></ul>b<wbr>c<hr>d") == "a bc d"
    assert text_of("<DIV><P>Upper</P></DIV><![CDATA[x]]><?php y ?>z") == "Upper z"
    deep = "<div>" * 20_000 + "deep" + "</div>" * 20_000 + "<p>after</p>"
    assert text_of(deep) == "deep after"


def test_time_grows_with_length_only():
    for part in ("<", "<a ", '<p x="', "<!--", "</", "<script>", "<div a='b>", "<div><p>x", "<h2>a</h2><div>b</div>", "&amp", "x\n"):
        started = time.monotonic()
        text_of(part * 60_000)
        assert time.monotonic() - started < 20, part


def test_long_article_is_whole():
    paragraphs = [f"paragraph {i} " + "word " * 200 for i in range(3000)]
    html = "<nav>menu</nav><article>" + "".join(f"<p>{p}</p>" for p in paragraphs) + "</article>"
    assert text_of(html) == " ".join(" ".join(p.split()) for p in paragraphs)


def test_nulls_repeats_and_empty_tables(spark):
    rows = [(1, None, "<p>no host</p>"), (2, "http://h.example/", None), (None, "http://h.example/", "<p>x</p>"), (3, "", ""), (3, "", "")]
    found = main_texts(pages(spark, rows))
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted((r.page_id or 0, r.text, r.n_chars) for r in found.collect()) == [
        (0, "x", 1), (1, "no host", 7), (2, "", 0), (3, "", 0), (3, "", 0)
    ]
    assert main_texts(pages(spark, [])).collect() == []


def brute_score(a, b):
    """Simple tree matching by its definition."""

    @lru_cache(None)
    def best(i, j, one, other):
        if i == len(one) or j == len(other):
            return 0
        found = max(best(i + 1, j, one, other), best(i, j + 1, one, other))
        return max(found, score(one[i], other[j]) + best(i + 1, j + 1, one, other)) if one[i][0] == other[j][0] else found

    def score(x, y):
        return 1 + best(0, 0, x[1], y[1]) if x[0] == y[0] else 0

    return score(a, b)


def frozen(node):
    return node[0], tuple(frozen(c) for c in node[1])


def test_tree_matching_against_its_definition():
    draw = random.Random(9)

    def grow(depth):
        return (draw.choice("abc"), [grow(depth - 1) if depth and draw.random() < 0.7 else ("#", []) for _ in range(draw.randint(1, 4))])

    for _ in range(150):
        first, second = ("r", grow(3)[1]), ("r", grow(3)[1])
        match = TreeMatch(first, second)
        assert match.score(first, second) == brute_score(frozen(first), frozen(second))
        placed = [p for p in match.slots if p >= 0]
        assert placed == sorted(set(placed))


def test_shapes_keep_order_and_number_slots():
    root, _, shape = page_shape("<div>a<p>b</p></div><div>c</div><ul class='menu 12'><li>d<li>e</ul><div><div>f</div></div>")
    assert shape.text == "html(div(#) ul.menu(li(#)) div(div(#)))"
    assert [[n.text for n in slot] for slot in shape.slots] == [["a", "b", "c"], ["d", "e"], ["f"]]
    assert read_shape(shape.text) == ("html", [("div", [("#", [])]), ("ul.menu", [("li", [("#", [])])]), ("div", [("div", [("#", [])])])])
    assert [t for t in tokens("<br/>x")] == [("open", "br", {}), ("text", "x", {})]
    assert tree("<title>T &amp; U</title>x")[1] == "T & U"
