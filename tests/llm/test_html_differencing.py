import html
import random
import re

import pytest

from ridemart.llm import html_differencing as H

SF = "/root/testdata/sf0.01"


def text_of(page, near=()):
    lines, classes = H.read_page(page)
    near = [H.Neighbour(k, p, [H._key(t) for t in H.read_page(x)[0]]) for k, (p, x) in enumerate(near)]
    return "\n".join(H.main_lines(lines, classes, [H._key(t) for t in lines], "/a/1", near)[0])


def lcs(a, b):
    t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
    return t[-1][-1]


@pytest.mark.parametrize("seed", range(60))
def test_alignment_is_a_longest_common_subsequence(seed):
    rng = random.Random(seed)
    a, b = ([rng.randint(0, rng.choice([1, 3, 30])) for _ in range(rng.randint(0, 40))] for _ in range(2))
    for cells in (1 << 28, 1, 50):
        shared = H.shared_lines(a, b, cells)
        kept = [x for x, s in zip(a, shared) if s]
        it = iter(b)
        assert all(x in it for x in kept) and len(kept) == lcs(a, b)


def test_alignment_of_long_pages():
    a = [k % 7 for k in range(6_000)] + list(range(100, 6_100))
    b = list(range(100, 6_100, 2)) + [3] * 4_000
    assert sum(H.shared_lines(a, b, 1 << 22)) == 3_000


def test_markup():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><body class="has-sidebar">
    <header><h1>Site</h1></header><nav><ul><li><a href=x>Menu</a></ul></nav><div id="cookie-notice">We use cookies</div>
    <div class="page with-sidebar"><main><article class="post"><header><h1>Title &amp; more</h1></header>
    <p>One <b>bold</b>\n\t word&nbsp;here<br>after &lt;p&gt; &#8211; &copy;
    <p>Two<script>var x="</p><article>no</article>";</script> still two<!-- <p>no</p> --> end
    <div class="adSlot"><p>Buy</p></div><ul><li>a<li>b</ul><table><tr><td>c<td>d</table>
    <div style="display: none">hidden</div><aside>side</aside><form>Mail <input></form><svg><path/></svg><svg/><figure><figcaption>cap</figcaption></figure>
    <section class="comments"><article class="comment"><p>First!</p></article></section><p>Last</article>
    <section class="related"><article><p>Other story</p></article></section></main></div><footer>&copy; me</footer>"""
    assert text_of(page) == "Title & more\nOne bold word here after <p> – ©\nTwo still two end\na\nb\nc\nd\ncap\nLast"
    assert text_of("<body><div class='content'><p>Only</p></div><div class=sidebar>no</div>") == "Only"
    wrapped = "<div id=main-wrapper><div>Path &gt; here</div><div class='post-content'><p>A long paragraph of text.</p><p>Another.</p></div><div class=post-date>May</div></div>"
    assert text_of(wrapped) == "A long paragraph of text.\nAnother."
    assert text_of("<form id=page><div role=main><p>x</div></form>") == "x"
    for odd in ("", "plain", "<", "<p", "<p a='", "</div>" * 50, "<![if x]>t", "<![CDATA[x]]>t", "<!x", "&#xD800;&#0;&bogus;", "<article></article>", "<p>" * 5000 + "x", "<div>" * 3000 + "y"):
        H.read_page(odd)
    assert text_of("<article><p>Text <br><span class=share>Share</span> more<button>Go</button>.</p><div> <span class=ad>Ad</span> </div></article>") == "Text more."
    assert text_of("<script>never closed <p>x</p>") == "" and text_of(None) == ""


def test_differencing_decides_open_pages():
    def page(*body, foot="All rights"):
        return "<body><div>Top links</div><div>Home</div>" + "".join(f"<p>{x}</p>" for x in body) + f"<div>{foot}</div>"

    mine = page("a story", "Home", "its end")
    assert text_of(mine, [("/a/2", page("another"))]) == "a story\nHome\nits end"
    assert text_of(mine) == "Top links\nHome\na story\nHome\nits end\nAll rights"
    assert text_of(mine, [("/b/2", mine), ("/a/2", mine)]) == text_of(mine)  # copies on both sides
    assert text_of(mine, [("/a/2", mine), ("/b/2", page("another", foot="x"))]) == "a story\nHome\nits end\nAll rights"
    # The nearer URL is the partner.
    far, near = page("x", foot="Other"), page("y")
    assert text_of(mine, [("/z/2", far), ("/a/2", near)]) == "a story\nHome\nits end"
    declared = "<article><p>same</p><p>more</p></article><p>foot</p>"
    assert text_of(declared, [("/a/2", declared)]) == "same\nmore"


def run(spark, rows, parts=4):
    df = spark.createDataFrame([(*r, 0, "t", [1]) for r in rows], "page_id long, url string, html string, place long, host string, keys array<int>").repartition(parts)
    return {(r.page_id, r.url): r for r in H.main_text_report(H.extract_main_text(df)).collect()}


def test_edges(spark):
    def page(k):
        return f"<div>Top</div><p>text {k}</p><div>Foot</div>"

    rows = [(k, f"http://h.x/en/{k:03d}?q={k}#t", page(k)) for k in range(100)]
    rows += [(200, None, page(200)), (201, "rel/x", page(201)), (202, "https://single.y/1", page(202)), (203, "http://h.x/zz", None), (None, "HTTP://H.X/zzz", page(5)),
             (204, "http://c.z/1", page(1)), (204, "http://c.z/1", page(1)), (205, "//k.z/é/1", "<p>é &amp; &eacute;  ü</p>"), (206, "http://big.z/", "<p>" + "word " * 200_000 + "</p>")]
    got = run(spark, rows)
    for k in range(100):
        assert (got[k, f"http://h.x/en/{k:03d}?q={k}#t"].text) == f"text {k}"
    assert got[200, None].text == "Top\ntext 200\nFoot" and got[200, None].paired_page_id is None
    assert got[201, "rel/x"].text == "Top\ntext 201\nFoot" and got[202, "https://single.y/1"].text == "Top\ntext 202\nFoot"
    assert got[203, "http://h.x/zz"].text == "" and got[203, "http://h.x/zz"].n_chars == 0
    assert got[204, "http://c.z/1"].text == "Top\ntext 1\nFoot"
    assert got[205, "//k.z/é/1"].text == "é & é ü" and got[205, "//k.z/é/1"].n_chars == 7
    assert got[206, "http://big.z/"].n_chars == 5 * 200_000 - 1
    assert run(spark, rows, 1) == got
    assert run(spark, [], 1) == {}


def test_pages_with_an_article_are_paired_and_aligned(spark):
    def page(*body):
        return "<nav>Menu</nav><article>" + "".join(f"<p>{x}</p>" for x in body) + "</article><footer>Foot</footer>"

    rows = [(1, "http://h.x/a/1", page("one", "both")), (2, "http://h.x/a/2", page("two", "both")), (3, "http://h.x/b/1", "<p>open</p><div>Foot</div>"),
            (4, "http://other.x/a/1", page("one", "both")), (5, None, page("one", "both"))]
    got = {k[0]: (r.text, r.paired_page_id, r.n_lines, r.n_shared_lines, r.n_deleted_lines) for k, r in run(spark, rows).items()}
    assert got == {1: ("one\nboth", 2, 4, 3, 0), 2: ("two\nboth", 1, 4, 3, 0), 3: ("open", 2, 2, 1, 1),
                   4: ("one\nboth", None, 4, 0, 0), 5: ("one\nboth", None, 4, 0, 0)}


def test_whole_table(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r.page_id: r for r in H.main_text_report(H.extract_main_text(pages)).collect()}
    assert len(got) == pages.count()
    for r in pages.collect():
        article = re.search("<article>(.*?)</article>", r.html, re.S).group(1)
        blocks = [" ".join(html.unescape(x).split()) for x in re.split("</?(?:p|h1)>", re.sub("</?b>", "", article.replace("<br>", " ")))]
        want = "\n".join(b for b in blocks if b)
        assert (got[r.page_id].text, got[r.page_id].n_chars, got[r.page_id].url) == (want, len(want), r.url)
