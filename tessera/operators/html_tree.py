"""B1, browser tree: node records of pages whose tags are misnested.

The source tree of ``html.py`` closes, at an end tag, everything opened inside
the element.  Browsers repair more, and this builder follows them:

* a formatting element (``b``, ``i``, ``a`` ...) that is closed from outside
  goes on behind its block: it is opened again, as a copy, before the next
  text or element; closed across a block, it ends before the block and a copy
  holds what the block had of it (the adoption rule of the HTML standard);
* text and elements misplaced in a table (outside its cells) are moved before
  the table; a table tag closes what is open above its table;
* a cell is a wall: formatting opened outside does not go on inside it.

Implied end tags, void elements and raw text are those of ``html.py``; no
``tbody`` is invented.  A copy has no source of its own: its slice runs from
its first to its last content.
"""

from __future__ import annotations

from html.parser import HTMLParser

from tessera.operators.html import IMPLIED_CLOSE, P_CLOSERS, P_SCOPE_STOP, RAW_TAGS, VOID_TAGS

# The element classes of the HTML standard.
FORMATTING = frozenset("a b big code em font i nobr s small strike strong tt u".split())
SPECIAL = P_CLOSERS | frozenset(
    "applet area base body br button caption center col colgroup dd dt embed frame frameset head html iframe img input li link "
    "listing marquee meta noembed noframes noscript object param plaintext script select source style summary tbody td template "
    "textarea tfoot th thead title tr track wbr xmp".split())
TABLE_PARTS = frozenset("caption col colgroup tbody td tfoot th thead tr script style template".split())
TABLE_BODY = frozenset(["table", "tbody", "tfoot", "thead", "tr"])
WALLS = frozenset(["td", "th", "caption", "button", "object", "applet", "marquee", "template"])
_CONTEXT = {"tr": {"table", "tbody", "thead", "tfoot"}, "td": {"tr", "table", "tbody", "thead", "tfoot"}, "th": {"tr", "table", "tbody", "thead", "tfoot"},
            "tbody": {"table"}, "thead": {"table"}, "tfoot": {"table"}, "caption": {"table"}, "colgroup": {"table"}}


class Node:
    __slots__ = ("tag", "attrs", "parent", "children", "start", "end")

    def __init__(self, tag, attrs, start, end):
        self.tag, self.attrs, self.start, self.end = tag, attrs, start, end
        self.parent, self.children = None, []

    def put(self, child, before=None):
        if isinstance(child, Node):
            if child.parent is not None:
                child.parent.children.remove(child)
            child.parent = self
        at = len(self.children)
        while before is not None and self.children[at - 1] is not before:     # it is near the end
            at -= 1
        at -= before is not None
        if isinstance(child, str) and at and isinstance(self.children[at - 1], str):
            self.children[at - 1] += child
        else:
            self.children.insert(at, child)

    def copy(self, at):
        return Node(self.tag, self.attrs, at, None)


class RepairedTree(HTMLParser):
    def __init__(self, src: str):
        super().__init__(convert_charrefs=True)
        self.src, self.lines = src, [0]
        at = src.find("\n")
        while at >= 0:
            self.lines.append(at + 1)
            at = src.find("\n", at + 1)
        self.root = Node("#root", {}, 0, len(src))
        self.stack = [self.root]
        self.active: list = []            # open formatting elements; None is a wall

    # ------------------------------------------------------------ the stack

    def _offset(self) -> int:
        line, col = self.getpos()
        return self.lines[line - 1] + col

    def _pop(self, end: int) -> Node:
        n = self.stack.pop()
        n.end = end
        if n.tag in WALLS:
            while self.active and self.active.pop() is not None:
                pass
        return n

    def _pop_to(self, size: int, end: int) -> None:
        while len(self.stack) > size:
            self._pop(end)

    def _find(self, names, stops=()) -> int:
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].tag in names:
                return i
            if self.stack[i].tag in stops:
                return -1
        return -1

    def _place(self, target: Node):
        """(parent, child to come before): before the table for content that a
        table cannot hold."""
        if target.tag in TABLE_BODY:
            t = self.stack.index(target) if target in self.stack else 0
            while t and self.stack[t].tag != "table":
                t -= 1
            if t > 0:
                table = self.stack[t]
                if table.parent is not None:
                    return table.parent, table
                return self.stack[t - 1], None
        return target, None

    def _insert(self, node, foster=True):
        parent, before = self._place(self.stack[-1]) if foster else (self.stack[-1], None)
        parent.put(node, before)

    # ------------------------------------------------------------ formatting

    def _reopen(self, at: int) -> None:
        """Open again, as copies, the formatting elements that are not open."""
        i = len(self.active)
        while i and self.active[i - 1] is not None and self.active[i - 1] not in self.stack:
            i -= 1
        for k in range(i, len(self.active)):
            n = self.active[k].copy(at)
            self._insert(n)
            self.stack.append(n)
            self.active[k] = n

    def _last_active(self, tag: str):
        for n in reversed(self.active):
            if n is None:
                return None
            if n.tag == tag:
                return n
        return None

    def _adopt(self, tag: str, start: int, end: int) -> bool:
        """The end of a formatting element; False if none is open."""
        top = self.stack[-1]
        if top.tag == tag and top not in self.active:
            self._pop(end)
            return True
        for _ in range(8):
            of = self._last_active(tag)
            if of is None:
                return _ > 0
            if of not in self.stack:
                self.active.remove(of)
                return True
            at = self.stack.index(of)
            block = next((k for k in range(at + 1, len(self.stack)) if self.stack[k].tag in SPECIAL), -1)
            if block < 0:
                self._pop_to(at + 1, start)
                self._pop(end)
                self.active.remove(of)
                return True
            far, above = self.stack[block], self.stack[at - 1]
            mark, last, k, inner = self.active.index(of), far, block, 0
            while True:
                k -= 1
                n = self.stack[k]
                inner += 1
                if n is of:
                    break
                if inner > 3 and n in self.active:
                    if self.active.index(n) < mark:
                        mark -= 1
                    self.active.remove(n)
                if n not in self.active:
                    n.end = start
                    self.stack.remove(n)
                    continue
                new = n.copy(start)
                n.end = start
                self.active[self.active.index(n)] = self.stack[k] = new
                if last is far:
                    mark = self.active.index(new) + 1
                new.put(last)
                last = new
            parent, before = self._place(above)
            parent.put(last, before)
            new = of.copy(far.start)
            for c in list(far.children):
                if isinstance(c, Node):
                    new.put(c)
                else:
                    new.children.append(c)
            far.children = []
            far.put(new)
            of.end = start
            gone = self.active.index(of)
            self.active.remove(of)
            self.active.insert(mark - (gone < mark), new)
            self.stack.remove(of)
            self.stack.insert(self.stack.index(far) + 1, new)
        return True

    # ------------------------------------------------------------ tokens

    def handle_starttag(self, tag, attrs):
        start = self._offset()
        end = start + len(self.get_starttag_text() or "")
        if tag == "table" and self.stack[-1].tag in TABLE_BODY:
            self._pop_to(max(self._find({"table"}), 1), start)       # ends the open table
        table = self._find({"table"})
        if tag in P_CLOSERS:
            i = self._find({"p"}, P_SCOPE_STOP)
            if i > 0:
                self._pop_to(i, start)
        if tag in _CONTEXT and table > 0:
            while len(self.stack) - 1 > table and self.stack[-1].tag not in _CONTEXT[tag]:
                self._pop(start)
        elif tag in IMPLIED_CLOSE:
            i = self._find(*IMPLIED_CLOSE[tag])
            if i > 0:
                self._pop_to(i, start)
        if tag == "a" and self._last_active("a") is not None:
            old = self._last_active("a")
            self._adopt("a", start, start)
            if old in self.active:
                self.active.remove(old)
        if tag not in TABLE_PARTS and tag not in SPECIAL or tag in ("br", "img", "input", "button", "select"):
            self._reopen(start)
        held: dict = {}
        for k, v in attrs:
            held.setdefault(k, v if v is not None else "")
        n = Node(tag, held, start, end)
        self._insert(n, foster=tag not in TABLE_PARTS)
        if tag in VOID_TAGS:
            return
        self.stack.append(n)
        if tag in WALLS:
            self.active.append(None)
        if tag in FORMATTING:
            same = [x for x in self._since_wall() if x.tag == tag and x.attrs == held]
            if len(same) >= 3:
                self.active.remove(same[0])
            self.active.append(n)

    def _since_wall(self):
        out = []
        for n in reversed(self.active):
            if n is None:
                break
            out.append(n)
        return out[::-1]

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        n = self.stack[-1]
        if tag not in VOID_TAGS and n.tag == tag:
            self._pop(n.end)
            if n in self.active:
                self.active.remove(n)

    def handle_endtag(self, tag):
        start = self._offset()
        close = self.src.find(">", start)
        end = close + 1 if close >= 0 else len(self.src)
        if tag in FORMATTING and self._adopt(tag, start, end):
            return
        # a table's end is the end of the nearest table only; other ends do
        # not reach out of a cell
        i = self._find({tag}, WALLS if tag not in TABLE_BODY and tag not in WALLS else ({"table"} if tag != "table" else ()))
        if i > 0:
            self._pop_to(i + 1, start)
            self._pop(end)

    def handle_data(self, data):
        if not data:
            return
        top = self.stack[-1]
        if top.tag in RAW_TAGS:
            top.put(data)
            return
        if top.tag in TABLE_BODY and not data.strip():
            top.put(data)
            return
        self._reopen(self._offset())
        self._insert(data)


def records(root: Node):
    """Node records in document order, the page's text, and its text chunks,
    as ``html.parse_page`` gives them."""
    nodes, text, chunks = [], [], []
    size = 0

    def close(rec, n):
        rec[8], rec[14] = size, len(chunks)
        if n.end is None or n.end < n.start:
            n.end = n.start
        rec[10] = n.end

    work = [(root, None, iter(root.children), 0)]
    seen: dict = {}
    while work:
        n, rec, rest, raw = work[-1]
        child = next(rest, None)
        if child is None:
            work.pop()
            if rec is not None:
                close(rec, n)
            continue
        if isinstance(child, str):
            if rec is not None:
                rec[6].append(child)
            if not raw:
                text.append(child)
                size += len(child)
                if child.strip():
                    chunks.append(child.strip())
            continue
        nid, parent = len(nodes), rec[0] if rec is not None else -1
        sib = seen.get(parent, 0)
        seen[parent] = sib + 1
        ids = [*rec[11], rec[0]] if rec is not None else []
        tags = [*rec[12], rec[4]] if rec is not None else []
        new = [nid, parent, len(ids), sib, child.tag, child.attrs, [], size, None, child.start, None, ids, tags, len(chunks), None]
        nodes.append(new)
        work.append((child, new, iter(child.children), raw or child.tag in RAW_TAGS))
    return nodes, "".join(text), chunks


def parse_repaired(html: str):
    """(node records, text, chunks, error): the error tells why the page ends
    early, None for a whole page."""
    b = RepairedTree(html or "")
    error = None
    try:
        b.feed(html or "")
        b.close()
    except Exception as e:   # beyond the tolerance of the tokenizer
        error = f"{type(e).__name__}: {e}"
    b._pop_to(1, len(html or ""))
    return (*records(b.root), error)
