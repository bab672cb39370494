"""The repaired tree on misnested pages, and error rows."""
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.operators import html as hx
from tessera.operators.html_tree import Node, RepairedTree, parse_repaired, records


def shown(html):
    t = RepairedTree(html)
    t.feed(html)
    t.close()

    def show(n):
        return "".join(c if isinstance(c, str) else c.tag + ("." + c.attrs["class"] if "class" in c.attrs else "") + f"[{show(c)}]" for c in n.children)
    return show(t.root)


@pytest.mark.parametrize("html,want", [
    # examples of the HTML standard (without its implied tbody)
    ("<p>1<b>2<i>3</b>4</i>5</p>", "p[1b[2i[3]]i[4]5]"),
    ("<b>1<p>2</b>3</p>", "b[1]p[b[2]3]"),
    ("<table><b><tr><td>aaa</td></tr>bbb</table>ccc", "b[]b[bbb]table[tr[td[aaa]]]b[ccc]"),
    ("<p><b class=x><b class=x><b><b class=x><b class=x><b>X<p>X<p><b><b class=x><b>X<p></b></b></b></b></b></b>X",
     "p[b.x[b.x[b[b.x[b.x[b[X]]]]]]]p[b.x[b[b.x[b.x[b[X]]]]]]p[b.x[b[b.x[b.x[b[b[b.x[b[X]]]]]]]]]p[X]"),
    ("<a href=1>x<div>y<a href=2>z", "a[x]div[a[y]a[z]]"),
    ("<font><p>hello<b>cruel</font>world</b>", "font[]p[font[hellob[cruel]]b[world]]"),
    # a cell is a wall
    ("<table><td><b>x<td>y</table>z", "table[td[b[x]]td[y]]z"),
    ("<b><table><td>x</b>y</td></table>z", "b[table[td[xy]]z]"),
    ("<a><table><td><a>x</table></a>y", "a[table[td[a[x]]]]y"),
    # misplaced in tables
    ("<div><table>stray<div>d<tr><td>c</div>e</td></tr></table></div>", "div[straydiv[d]table[tr[td[ce]]]]"),
    ("<table><tr>x<td>1</td>y</tr><p>z</p></table>w", "xyp[z]table[tr[td[1]]]w"),
    ("<table><tr><td><table><p>in</table>q</td></tr></table>", "table[tr[td[p[in]table[]q]]]"),
    ("<i>a<div>b<span>c</i>d</span>e</div>f", "i[a]div[i[bspan[c]]de]f"),
    ("<ul><li><b>x<li>y</ul>z", "ul[li[b[x]]li[b[y]]]b[z]"),
    ("</b></p>x</table>", "x"), ("<b/>x<br/>y", "b[]xbr[]y"), ("", "")])
def test_misnested_pages(html, want):
    assert shown(html) == want


_PIECES = st.lists(st.sampled_from(["<b>", "</b>", "<i>", "</i>", "<a>", "</a>", "<p>", "</p>", "<div>", "</div>", "<table>", "</table>", "<tr>", "</tr>", "<td>",
                                    "</td>", "<li>", "<ul>", "</ul>", "<font color=r>", "</font>", "<br>", "x", "y ", " ", "<span>", "</span>"]), max_size=40)


@settings(max_examples=1500, deadline=None)
@given(_PIECES)
def test_any_page_gives_a_sound_tree(pieces):
    html = "".join(pieces)
    nodes, text, chunks, error = parse_repaired(html)
    assert error is None and sorted(text) == sorted(p for s in pieces if not s.startswith("<") for p in s)
    for i, n in enumerate(nodes):
        assert n[0] == i and n[1] < i and n[2] == len(n[11]) == len(n[12])
        assert n[11] == ([] if n[1] < 0 else [*nodes[n[1]][11], n[1]]) and n[12] == [nodes[a][4] for a in n[11]]
        assert 0 <= n[7] <= n[8] <= len(text) and 0 <= n[9] <= n[10] <= len(html)
    assert sum(len(t) for n in nodes for t in n[6]) <= len(text)


@settings(max_examples=200, deadline=None)
@given(st.recursive(st.sampled_from(["x", "yz"]), lambda kids: st.tuples(st.sampled_from(["div", "b", "i", "span", "ul"]), st.lists(kids, max_size=3)), max_leaves=12))
def test_well_nested_pages_agree_with_the_source_tree(tree):
    def write(t):
        return t if isinstance(t, str) else f"<{t[0]}>" + "".join(map(write, t[1])) + f"</{t[0]}>"
    html = write(tree)
    # a block inside formatting is misnested only when closed across
    a, b = parse_repaired(html), hx._parsed(html)
    assert [n[:6] + n[7:] for n in a[0]] == [n[:6] + n[7:] for n in b[0]] and a[1] == b[1] and a[2] == b[2]


def test_nodes_and_error_rows(spark):
    pages = spark.createDataFrame([(1, "<p>a</p><![bad[x <b>lost"), (2, "<b>1<p>2</b>3</p>"), (3, None), (4, "")], "page_id long, html string")
    for repair in (False, True):
        nodes = hx.html_nodes(pages, repair=repair)
        err = [(r["page_id"], r["error"]) for r in hx.page_errors(nodes).collect()]
        assert len(err) == 1 and err[0][0] == 1 and "bad" in err[0][1]
        assert [r["text"] for r in nodes.where("page_id = 1 and tag = 'p'").collect()] == ["a"]
    got = sorted((r["node_id"], r["parent_id"], r["tag"], r["text"], r["own_text"]) for r in hx.html_nodes(pages, repair=True).where("page_id = 2").collect())
    assert got == [(0, -1, "b", "1", "1"), (1, -1, "p", "23", "3"), (2, 1, "b", "2", "2")]


def test_records_of_an_empty_root():
    assert records(Node("#root", {}, 0, 0)) == ([], "", [])
