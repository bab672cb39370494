"""Property tests for the tree builder on random tag soup (no Spark)."""

from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.operators.html import parse_page

TAGS = ["p", "div", "li", "ul", "td", "tr", "table", "b", "a", "br", "img", "script", "h1", "span"]
piece = st.one_of(
    st.sampled_from([f"<{t}>" for t in TAGS] + [f"</{t}>" for t in TAGS] + ['<a href="/x">', "<!-- c -->",
                     "&amp;", "&lt;", " ", "\n", "<p class='a b'>"]),
    st.text(alphabet="abcxyz é1", min_size=1, max_size=5))


@settings(max_examples=300, deadline=None)
@given(st.lists(piece, max_size=40))
def test_tree_builder_invariants(parts):
    html = "".join(parts)
    nodes, text, b = parse_page(html, with_builder=True)
    by_id = {n[0]: n for n in nodes}
    for n in nodes:
        nid, parent, depth, _sib, tag, _attrs, _own, ts, te, start, end, anc = n[:12]
        assert 0 <= start <= end <= len(html)
        assert html[start:start + 1 + len(tag)].lower() == "<" + tag
        assert ts <= te <= len(text)
        assert depth == len(anc) and (parent == (anc[-1] if anc else -1))
        if parent >= 0:
            p = by_id[parent]
            assert p[7] <= ts and te <= p[8]              # child text inside parent text
            assert p[9] <= start and end <= p[10]        # child source inside parent source
