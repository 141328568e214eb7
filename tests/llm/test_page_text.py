"""Main text of pages: the given pages against a plain reading, alignment against a table of lengths, odd pages."""

import html
import random
import re

import pytest
from pyspark.sql import functions as F

from keyedlake.llm import page_text, queries
from keyedlake.llm.common import table
from keyedlake.llm.page_text import common, lines_of, main_text

SF = "/root/testdata/sf0.001"


def lcs_length(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(max(new[j], row[j + 1], row[j] + (x == y)))
        row = new
    return row[-1]


@pytest.mark.parametrize("bits", [1 << 26, 16])
def test_alignment_is_a_longest_common_subsequence(bits, monkeypatch):
    monkeypatch.setattr(page_text, "ALIGN_BITS", bits)
    rnd = random.Random(3)
    for _ in range(300):
        a, b = ([rnd.choice("abcdef"[:rnd.randint(1, 6)]) for _ in range(rnd.randint(0, 30))] for _ in range(2))
        at = common(a, b)
        assert at == sorted(set(at)) and len(at) == lcs_length(a, b)
        rest = iter(b)
        assert all(a[i] in rest for i in at)  # a subsequence of b too


def test_given_pages(spark):
    got = {r.page_id: r for r in queries.op12_page_text(spark, SF).collect()}
    pages = table(spark, SF, "pages").collect()
    assert len(got) == len(pages)
    for p in pages:
        article = re.search("<article>(.*?)</article>", p.html, re.S)[1]
        blocks = (" ".join(html.unescape(re.sub("</?b>", "", x)).split()) for x in re.split("</?(?:p|h1)>|<br>", article))
        want = "\n".join(x for x in blocks if x)
        assert (got[p.page_id].text, got[p.page_id].n_chars, got[p.page_id].url) == (want, len(want), p.url)


def run(spark, rows, **extra):
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns(extra)
    return {r.page_id: r for r in main_text(df).collect()}


def page(*blocks, head="Top menu", foot="All rights"):
    return f"<html><body><div>{head}</div>" + "".join(f"<div>{b}</div>" for b in blocks) + f"<div>{foot}</div></body></html>"


def test_lines_shared_with_the_nearest_page_go(spark):
    got = run(spark, [
        (1, "http://h.org/a/1", page("one", "two", "more at the end")), (2, "http://h.org/a/2", page("three", "two b")),
        (3, "http://h.org/z/9", page("nine", head="Other menu")), (4, "http://h.org/z/8", page("eight", head="Other menu")),
        (5, "http://alone.org/a/1", page("only"))])
    assert [got[i].text for i in range(1, 6)] == ["one\ntwo\nmore at the end", "three\ntwo b", "nine", "eight",
                                                  "Top menu\nonly\nAll rights"]
    assert [got[i].n_shared for i in range(1, 6)] == [2, 2, 2, 2, 0]


def test_markup_corrects_the_alignment(spark):
    quoted = "<p>The same quotation.</p>"
    got = run(spark, [
        (1, "http://h.org/1", f"<nav>a b</nav><article><header><h1>One</h1></header>{quoted}<div class='Cookie-notice'>ok?</div>"
                              "<p>x</p><section id=comments><article>me too</article></section></article><aside>see</aside>"),
        (2, "http://h.org/2", f"<header>Site</header><div class=has-sidebar><article><h1>Two</h1>{quoted}<form>mail</form>"
                              "<p>y<br>z &lt;b&gt; &amp &eacute;&nbsp;!</p></article></div><div role=contentinfo>late</div>"),
        (3, "http://h.org/3", f"<main>{quoted}<ul><li>i<li>j</ul><div hidden>h</div></main><footer>f</footer>loose")])
    assert got[1].text == "One\nThe same quotation.\nx"
    assert got[2].text == "Two\nThe same quotation.\ny z <b> & é !"
    assert got[3].text == "The same quotation.\ni\nj\nloose"


def test_tokens():
    texts = lambda h: [t for _, t in lines_of(h)]
    assert texts("a<!-- <p>no</p> -->b<!-->c<script>if (x < 1) '</p>'</script>d<style>p{}</style>") == ["abcd"]
    assert texts("<p title='a>b' x=\"</p>\">in</p><p y=it's>on") == ["in", "on"]
    assert texts("5 < 6 <3 </> <?php x ?>&lt;p&gt;<P>up</P >cut<p cla") == ["5 < 6 <3 <p>", "up", "cut"]
    assert texts("<p>a<div>b") == ["a", "b"] and texts("<b>a</b><i>b</i>\n\tc<td>d<td>e") == ["ab c", "d", "e"]
    assert texts("x<script>never closed <p>y") == ["x"] and texts("x<!-- never closed <p>y") == ["x"]
    assert texts("&amp;lt; &#65;&#x42; &nosuch; &am") == ["&lt; AB &nosuch; &am"]


def test_odd_pages(spark):
    long = "<article>" + "".join(f"<p>line {i % 977} of many</p>" for i in range(30_000)) + "</article>"
    same = page("copy")
    rows = [(1, None, page("no url")), (2, "no host", page("odd url")), (3, "http://h/1", None), (4, "http://h/2", ""),
            (5, "http://h/3", long), (6, "http://h/4", long.replace("line 5 ", "line five ")), (None, "http://h/5", "<article>x</article>"),
            (7, "http://s/1", same), (7, "http://s/1", same), (8, "http://s/1", same), (9, "http://h/6", "<" * 5000 + "<a " * 5000)]
    clash = {c: F.lit("x") for c in ("host", "path", "key", "part", "ghost", "also", "text", "n_chars", "copy", "group")}
    got = run(spark, rows, **clash)
    assert len(got) == 10
    assert got[1].text == "Top menu\nno url\nAll rights" and got[2].text == "Top menu\nodd url\nAll rights"
    assert (got[3].text, got[4].text, got[4].n_chars, got[None].text) == ("", "", 0, "x")
    assert got[5].n_chars == len(re.sub("</?(article|p)>", "\n", long).replace("\n\n", "\n").strip("\n")) and got[6].n_shared > 29_000
    assert got[7].text == got[8].text == "Top menu\ncopy\nAll rights" and got[7].n_shared == 0
    empty = main_text(spark.createDataFrame([], "page_id long, url string, html string"))
    assert empty.collect() == [] and empty.columns == ["page_id", "url", "text", "n_chars", "n_shared"]


def test_split_hosts_give_the_same(spark, monkeypatch):
    rows = [(i, f"http://{'hot' if i % 3 else i % 5}.org/{i % 7}/{i % 40 if i % 4 else 1}", page(f"own {i}", f"few {i % 6}"))
            for i in range(400)]
    whole = run(spark, rows)
    monkeypatch.setattr(page_text, "PART_PAGES", 3)
    split = run(spark, rows)
    assert split == whole and len({r.text for r in whole.values()}) > 300
