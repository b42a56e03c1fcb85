"""The block labeller: blocks of pages, gradients, held-out pages."""

import html
import re

import numpy as np
import pytest

from pricepanel.llm import extract, leaves


def texts(page):
    return [leaf.text for leaf in leaves.leaves(page, leaves.Paths())]


@pytest.mark.parametrize("page, want", [
    (None, []), ("", []), ("just  text\n", ["just text"]), ("<p>a<p>b</p>c", ["a", "b", "c"]), ("<div>a <b>b</b>c<br>d</div>e", ["a bc d", "e"]),
    ("<p>1 &lt; 2 &amp;amp; &#233;&nbsp;x</p>", ["1 < 2 &amp; é x"]), ("a<!-- x <p>y</p> -->b<!-->c", ["abc"]), ("a<!-- never ends <p>b</p>", ["a"]),
    ("<script>if (a<b) '</p>'</script>x<style>p{}</style><SCRIPT>y</script >z", ["xz"]), ("<script>never ends <p>a</p>", []), ("<title>T</title><textarea>x</textarea><p>y", ["y"]),
    ('<a href="x>y">l</a><img alt=">">m', ["lm"]), ("<p title='a<b>c'>x</p>", ["x"]), ('<p title="never ends>x</p>', []), ("a < b <3 c", ["a < b <3 c"]),
    ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>e", ["a", "b", "c", "d", "e"]), ("<table><tr><td>a<td>b<tr><th>c</table>d", ["a", "b", "c", "d"]), ("</p></div>a</ul>b", ["a", "b"]),
    ("<p><b>a<br><p>b", ["a", "b"]), ("<!DOCTYPE html><?xml x?></3>t", ["t"]),
])
def test_blocks(page, want):
    assert texts(page) == want


def test_paths_hold_tags_and_names():
    paths = leaves.Paths()
    a, b, c = leaves.leaves('<div class="siteHeader left"><p>a</p></div><p id=main>b</p><ul><li><a href="/class=no">c</a> d</li></ul>', paths)
    assert set(paths.slots(a.path)) == {leaves.slot(x) for x in ("div", ".site", ".header", ".left", "p")}
    assert set(paths.slots(b.path)) == {leaves.slot(x) for x in ("p", ".main")}
    assert c.linked == 1 and c.text == "c d" and leaves.slot(".no") not in paths.slots(c.path)


def test_blocks_of_a_long_page_are_found_in_one_pass():
    page = "<div><b>" * 20_000 + "".join(f"<li>{i} <i>x</span>" for i in range(60_000)) + '<a "' * 10_000
    assert len(texts(page)) == 60_000


def test_gradient():
    pages, paths, labels = extract.made_pages(3, 1)
    net = extract.Labeller()
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    b, y = extract.encode(pages, paths), np.concatenate(labels)
    _, g = net.gradient(b, y)
    for k, d in g.items():
        j, e = int(np.abs(d).argmax()), 1e-3
        flat = net.p[k].reshape(-1)
        at = flat[j]
        loss = []
        for x in (at + e, at - e):
            flat[j] = x
            loss.append(net.gradient(b, y)[0])
        flat[j] = at
        assert abs((loss[0] - loss[1]) / (2 * e) - d.reshape(-1)[j]) < 0.02 * abs(d).max() + 2e-4, k


def test_side_by_side_equals_alone():
    pages, paths, _ = extract.made_pages(9, 2)
    net = extract.Labeller()
    codes = net.p["tags"], net.p["words"]
    together = net.scores(extract.encode([*pages, [], pages[0]], paths, *codes))
    alone = np.concatenate([net.scores(extract.encode([p], paths, *codes)) for p in [*pages, pages[0]]])
    np.testing.assert_allclose(together, alone, atol=1e-4)
    b, dense = extract.encode(pages, paths, *codes), extract.encode(pages, paths)
    np.testing.assert_allclose(b.paths, dense.paths @ net.p["tags"], atol=1e-4)
    np.testing.assert_allclose(b.words, dense.words @ net.p["words"], atol=1e-4)


def test_held_out_pages():
    net = extract.fitted()
    pages, paths, labels = extract.made_pages(200, 99)
    y = np.concatenate(labels) > 0
    assert ((net.scores(extract.encode(pages, paths, net.p["tags"], net.p["words"])) > 0) == y).mean() > 0.99


OTHER = """<html><body><div id="cookie-notice"><p>We use cookies on this site.</p></div><header><h1>The Paper</h1></header><nav><a href="/">Home</a> <a href="/a">World</a></nav>
<div class="container"><aside class="sidebar"><h3>Most read</h3><p>A long teaser of another story that stands in the sidebar.</p></aside>
<div class="post-content"><h1>A title of some words</h1><p>The first paragraph, with <b>bold</b> words and <a href="/x">a link</a>.</p><div class="advertisement">Buy one, get one.</div>
<p>Second &amp; last.</p></div><div id="comments"><h2>2 comments</h2><ol class="comment-list"><li class="comment"><p>I do not agree with a word of this story, sorry.</p></li><li class="comment"><p>Nice.</p></li></ol>
<form><p>Leave a comment</p><textarea></textarea><button>Send</button></form></div></div><footer><p>&copy; The Paper</p></footer></body></html>"""


def test_given_and_other_pages(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()
    kinds = "page_id long, url string, html string, text string, n_chars string"
    odd = [(-1, None, None), (None, "u", ""), (-3, "u", "<p>" * 1000), (-4, "u", OTHER), (-4, "u", OTHER)]
    got = extract.extract(spark.createDataFrame([(*r, "x", "y") for r in [*map(tuple, rows), *odd]], kinds).repartition(4)).collect()
    assert [c for c in got[0].__fields__] == ["page_id", "url", "text", "n_chars"] and len(got) == len(rows) + len(odd)
    assert all(r.n_chars == len(r.text) for r in got)
    by_id = {r.page_id: r.text for r in got}
    same = 0
    for r in rows:
        article = re.search("<article>(.*?)</article>", r.html, re.S)[1]
        same += by_id[r.page_id] == " ".join(html.unescape(re.sub("<[^>]*>", "", re.sub("</?(p|h1|br)>", " ", article))).split())
    assert same >= 0.98 * len(rows)
    assert by_id[-1] == by_id[None] == by_id[-3] == ""
    assert [r.text for r in got if r.page_id == -4] == ["A title of some words The first paragraph, with bold words and a link. Second & last."] * 2
    assert extract.extract(spark.createDataFrame([], kinds)).collect() == []
