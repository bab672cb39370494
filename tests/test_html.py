from pyspark.sql import functions as F

from conftest import rows
from tessera.operators import html as hx
from tessera.operators.html import parse_page


def _tree(html):
    nodes, text = parse_page(html)
    return [(n[4], html[n[9]:n[10]], text[n[7]:n[8]]) for n in nodes]


def test_implied_close_p_and_void_tags():
    t = _tree("<div><p>a<br>b<p>c<img src=x>d</div><p>e")
    tags = [x[0] for x in t]
    assert tags == ["div", "p", "br", "p", "img", "p"]
    assert t[1] == ("p", "<p>a<br>b", "ab")
    assert t[3] == ("p", "<p>c<img src=x>d", "cd")      # closed by </div>
    assert t[5] == ("p", "<p>e", "e")                    # closed at end of page


def test_li_td_tr_implied_close():
    t = _tree("<ul><li>a<li>b</ul><table><tr><td>1<td>2<tr><th>x</table>")
    assert [x for x in t if x[0] == "li"] == [("li", "<li>a", "a"), ("li", "<li>b", "b")]
    tds = [x for x in t if x[0] in ("td", "th")]
    assert [x[2] for x in tds] == ["1", "2", "x"]
    trs = [x for x in t if x[0] == "tr"]
    assert len(trs) == 2 and trs[0][1] == "<tr><td>1<td>2"


def test_entities_script_and_comments():
    t = _tree('<p>A &amp; B &lt;x&gt;<!-- c --><script>var s="</p>";</script>Z</p>')
    p = t[0]
    assert p[2] == "A & B <x>Z"
    assert [x[0] for x in t] == ["p", "script"]


def test_stray_end_tag_ignored_and_nested_close():
    t = _tree("<div><b>x</i>y</div>z")
    assert t[0] == ("div", "<div><b>x</i>y</div>", "xy")
    assert t[1] == ("b", "<b>x</i>y", "xy")


def test_html_nodes_spark(spark):
    pages = spark.createDataFrame([(1, '<p class="a b">x</p><p>y<a href="/u">L</a>'), (2, None)], "page_id long, html string")
    n = hx.html_nodes(pages)
    assert rows(n, "page_id", "node_id", "tag", "tag_idx") == [(1, 0, "p", 0), (1, 1, "p", 1), (1, 2, "a", 0)]
    sel = hx.select_nodes(n, tag="p", cls="b")
    assert rows(sel, "node_id") == [(0,)]
    within = hx.select_nodes(n, tag="a", within_tag="p")
    assert rows(within, "node_id") == [(2,)]
    attrs = n.filter("tag = 'a'").select(F.col("attrs")["href"].alias("h")).first()["h"]
    assert attrs == "/u"


TABLE_HTML = """
<html><body><main>
<h2>Alpha Conference</h2>
<table>
 <tr><td>Standings 2024</td><td></td></tr>
 <tr><th>Pos</th><th class="hide-on-medium-down">School</th><th>Conf</th><th>Overall</th><th>PTS</th></tr>
 <tr><td>1</td><td>North College*</td><td>5-1</td><td>9-2-1</td><td>15</td></tr>
 <tr><td>2</td><td>South (OH) University</td><td>4-2</td><td>8-3</td>
 <tr><td></td><td></td><td></td><td></td><td></td></tr>
 <tr><td>3</td><td>East Tech</td><td>3-3</td><td>7-5</td><td>18</td></tr>
</table>
<table><tr><td>a</td><td>1</td></tr><tr><td>b</td><td>2</td><td>3</td></tr></table>
</main></body></html>"""


def test_tables_header_align_and_generated(spark):
    pages = spark.createDataFrame([(7, TABLE_HTML)], "page_id long, html string")
    nodes = hx.html_nodes(pages)
    r = hx.html_rows(nodes)
    h = hx.detect_header(r)
    hd = {x["table_id"]: x for x in h.collect()}
    t1, t2 = sorted(hd)
    assert hd[t1]["header_idx"] == 1                       # th row beats the title row
    assert hd[t1]["header"] == ["Pos", "School", "Conf", "Overall", "PTS"]
    assert hd[t2]["header_idx"] == 0 or hd[t2]["header_idx"] is None
    rec = hx.table_records(r, h)
    got = {(x["table_id"], x["row_idx"]): x["cells"] for x in rec.collect()}
    assert got[(t1, 2)] == ["2", "South (OH) University", "4-2", "8-3", ""]   # padded
    assert (t1, 3) not in got                                                   # empty row dropped
    assert got[(t1, 4)][1] == "East Tech"


def test_header_none_gives_generated_names(spark):
    pages = spark.createDataFrame([(1, "<table><tr><td>1</td><td>2</td></tr><tr><td>3</td></tr></table>")],
                                  "page_id long, html string")
    nodes = hx.html_nodes(pages)
    r = hx.html_rows(nodes)
    h = hx.detect_header(r)
    rec = hx.table_records(r, h).collect()
    assert all(x["header"] == ["col1", "col2"] for x in rec)
    assert sorted(x["cells"] for x in rec) == [["1", "2"], ["3", ""]]


def test_visible_positions(spark):
    df = spark.createDataFrame([(["a hide-on-medium-down", "b", "hide-on-medium-down"], False),
                                (["x", "hide-on-large", ""], True), (["x", "y"], False)],
                               "cls array<string>, side boolean")
    got = [r[0] for r in df.select(hx.visible_positions(F.col("cls"), F.col("side"))).collect()]
    assert got == [[0, 2], [0, 2], [0, 1]]


def test_paragraphs_and_chunks(spark):
    html = "<p>1</p><p>2<p>3</p><div><p>4</div><p>5"
    pages = spark.createDataFrame([(1, html)], "page_id long, html string")
    n = hx.html_nodes(pages, outer_tags={"p"}, tags={"p"})
    p = hx.paragraphs(n)
    assert [x["outer_html"] for x in p.orderBy("p_idx").collect()] == ["<p>1</p>", "<p>2", "<p>3</p>", "<p>4", "<p>5"]
    ch = hx.chunk_rows(p, "page_id", "p_idx", "outer_html", 2, index="p_idx")
    assert rows(ch, "chunk_idx", "chunk", "n_items") == [(0, "<p>1</p>\n<p>2", 2), (1, "<p>3</p>\n<p>4", 2), (2, "<p>5", 1)]
    ch2 = hx.chunk_rows(p, "page_id", "node_id", "outer_html", 2)
    assert rows(ch2, "chunk_idx", "chunk") == rows(ch, "chunk_idx", "chunk")


def test_html_to_text_and_forward_header(spark):
    df = spark.createDataFrame([("<p>Hi&nbsp;<b>there</b></p><ul><li>one</li><li>two</li></ul><br/><br><br>&amp;end",),
                                ("x\nBegin forwarded message:\nFrom: a\nSubject: Offer\nBody here",)], "h string")
    out = [r[0] for r in df.select(hx.html_to_text(F.col("h"))).collect()]
    assert out[0] == "Hi there\n• one\n• two\n\n&end"
    fw = [r[0] for r in df.select(hx.strip_forward_header(F.col("h"))).collect()]
    assert fw[1] == "Body here"
    assert fw[0] == "<p>Hi&nbsp;<b>there</b></p><ul><li>one</li><li>two</li></ul><br/><br><br>&amp;end"
