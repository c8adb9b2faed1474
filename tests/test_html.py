from __future__ import annotations

from pyspark.sql import functions as F

from gleanspark.functions import html as H

S = F.col("s")


def test_text_nodes_are_trimmed_and_joined(values):
    cases = {
        "<p>a<b> b </b>c</p>": "a b c", "x<br/>y": "x y", "<!-- no -->t<script>var a='</p>'</script><style>p{}</style>u": "t u",
        "a &amp; b &lt;i&gt; &eacute;&#233;&#xe9; &nbsp;": "a & b <i> ééé", "&#128;&#0;&bogus; &amp": "€�&bogus; &amp",
        "<a title='1 > 0'>z</a>": "z", "2 < 3 and 4 > 1": "2 < 3 and 4 > 1", "": "", "<p>line\n two</p>": "line\n two",
    }
    assert values(H.html_to_text(S), list(cases)) == list(cases.values())


def test_plain_text_keeps_what_is_between_nodes(values):
    assert values(H.html_to_plain(S), [" <b>A</b> &amp; B "]) == ["A & B"]


def test_links(values):
    page = """<a href="/a?x=1&amp;y=2" data-href="no">A</a><a class=x href='b'>B</a><A HREF=c>C <b>c</b></A><!-- <a href="d">D</a> --><a name=e>E</a>"""
    assert values(H.hrefs(S), [page]) == [["/a?x=1&y=2", "b", "c"]]
    assert [tuple(a) for a in values(H.anchors(S), [page])[0]] == [("/a?x=1&y=2", "A"), ("b", "B"), ("c", "Cc")]


def test_first_external_link(values):
    link = H.first_external_link(S, lambda h: h.startswith("http"), F.lit("own"))
    assert values(link, ['<a href="/x">', '<a href="/x"><a href="http://y">', ""]) == ["own", "http://y", "own"]
    assert values(H.first_external_link(S, lambda h: h.startswith("http"), F.lit("")), ["none"]) == [None]


def test_meta(values):
    pages = ['<meta content="T &amp; U" property="og:title"/>', "<META property='og:title' content='V'>", '<meta property="og:title" content="">',
             '<meta property="og:titles" content="no">', '<meta name=x content="a>b"><meta property=og:title content=w>']
    assert values(H.meta_content(S, "og:title"), pages) == ["T & U", "V", None, None, "w"]


def test_context_is_the_nearest_paragraph_or_item(values):
    page = """<a href="http://out">out</a><div class="x body"><p>What's new: <a href=" http://a ">A <i>x</i></a> is good</p>
      <ul><li>One<li>Two <a href="http://b">B</a></ul><p>never closed <a href="http://c">C</a></div><p>after</p>"""
    links = values(H.context_anchors(S, "body"), [page, None, "<p>no container</p>"])
    assert [tuple(a) for a in links[0]] == [
        ("http://a", "Ax", "What's new: A x is good"), ("http://b", "B", "Two B"), ("http://c", "C", "never closed C")]
    assert links[1:] == [[], []]


def test_classed_rows(values):
    page = """<div class="row a" data-ts="1" data-u="/x"><b><i class=name>N</i></b><span class="tag">T <u>t</u></span></div><div class=row><i class=name>M</i></div>"""
    rows = values(H.classed_rows(S, "row", {"ts": "data-ts", "u": "data-u"}, {"name": "name", "tag": "tag"}), [page])[0]
    assert [tuple(r) for r in rows] == [("1", "/x", "N", "Tt"), (None, None, "M", "")]


def test_unclosed_anchor_and_markup_in_attributes(values):
    page = """<a title="a > b" href="/1">one<a class="x""  href = /2 >two</a><a data-x='href="no"' href=/3>three"""
    assert values(H.hrefs(S), [page]) == [["/1", "/2", "/3"]]
    assert [tuple(a) for a in values(H.anchors(S), [page])[0]] == [("/1", "one"), ("/2", "two"), ("/3", "three")]


def test_pages_of_unclosed_elements_take_proportional_time():
    from time import process_time

    from gleanspark.functions.html import _Tree

    def seconds(n):
        start = process_time()
        _Tree("<div class='x'>" + "<p>some text <b>more</p>" * n + "<p>" * n + "</q>" * n, "x")
        tree = _Tree("<div class='row'><span class='name'>a" * n, row_class="row", children={"name": "name", "tag": "tag"})
        assert len(tree.rows) == n and tree.rows[0]["children"]["name"]["start"] == 0
        return process_time() - start

    seconds(100)
    assert seconds(20_000) < 40 * seconds(2_000)


def test_rows_inside_rows():
    from gleanspark.functions.html import _Tree

    tree = _Tree('<div class="row"><i class="n">a</i><div class="row n">b<i class="n">c</i></div><i class="t">d</i></div><i class="n">e</i><div class="row">',
                 row_class="row", children={"n": "n", "t": "t"})
    told = [{out: tree.text(child, "") for out, child in row["children"].items()} for row in tree.rows]
    assert told == [{"n": "a", "t": "d"}, {"n": "c"}, {}]


def test_references_without_a_semicolon(values):
    assert values(H.html_to_text(F.col("s")), ["&copy 2024 &amp b", "caf&eacute<b>x</b>", "&#233 &#xe9, &bogus x &copyx;", "a&copy", "R&D &notit;"]) == [
        "© 2024 & b", "café x", "é é, &bogus x &copyx;", "a&copy", "R&D &notit;"]


def test_pages_are_read_in_slices(spark):
    import pyarrow as pa

    from gleanspark.functions.html import _slices

    pages = pa.array(["a" * 10, None, "", "b" * 95, "c" * 30, "d" * 30, "e" * 30, "f"])
    parts = [p.to_pylist() for p in _slices(pages, 91)]
    assert [x for p in parts for x in p] == pages.to_pylist()
    assert [len(p) for p in parts] == [3, 1, 4] and list(_slices(pages.slice(0, 0))) == []
    # a batch of many slices gives each page its own links, in a column beside others
    page = F.concat(F.lit("<p>"), F.repeat(F.lit("x"), 2000), F.lit('<a href="u'), "id", F.lit('">t</a></p>'))
    rows = spark.range(0, 3000, 1, 1).select("id", F.when(F.col("id") % 7 > 0, page).alias("page"))
    found = rows.select("id", H.context_anchors(F.col("page")).alias("links")).collect()
    assert len(found) == 3000
    assert all([x["href"] for x in r["links"]] == ([f"u{r['id']}"] if r["id"] % 7 else []) for r in found)
