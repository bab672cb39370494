"""Relational view of HTML: node table, selection, tables, header detection.

``html_nodes`` (B1) is the only Python step: one ``mapInArrow`` pass per page
with the standard-library ``html.parser``.  Everything after it is native
DataFrame code over the node table

    page_id, node_id, parent_id, depth, sib_idx, tag_idx, tag, attrs, own_text,
    text, start, end, outer_html, ancestor_ids, ancestor_tags

``tag_idx`` numbers the elements of one tag name in document order (the
first ``h1`` of a page has ``tag_idx = 0``), so "first/nth element" needs no
window and no shuffle.

``start``/``end`` are character offsets of the element in the page source, so
``outer_html`` is the exact source slice (kept only for the tags a caller asks
for, because materialising it for every node grows with depth x size).

Tree-building rule (our rule, fixed by tests; a simplified form of the HTML
standard's implied end tags):

* void elements never get children; ``script``/``style`` content is raw text;
  comments and doctype are skipped;
* a ``p`` start tag or a block start tag closes an open ``p``;
  ``li`` closes an open ``li`` up to its list; ``dt``/``dd`` close each other
  up to ``dl``; ``tr`` closes an open ``tr``; ``td``/``th`` close an open cell
  up to ``tr``; ``thead/tbody/tfoot`` close each other; ``option`` closes
  ``option``;
* an end tag closes the nearest open element of that name and everything
  opened inside it; an end tag with no open element is ignored;
* at the end of the page every open element is closed.

Character references in text are decoded.  ``text`` is all descendant text
(no separator) and excludes script/style content.
"""

from __future__ import annotations

from collections.abc import Callable
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from tessera.functions.common import at
from pyspark.sql import types as T

VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TAGS = frozenset(["script", "style"])
# start tags that close an open <p>
P_CLOSERS = frozenset(
    "address article aside blockquote details dialog div dl fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
# element -> (the open element it closes, with everything inside it; tags that stop the search)
IMPLIED_CLOSE = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table", "thead", "tbody", "tfoot"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "thead": ({"thead", "tbody", "tfoot"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot"}, {"table"}),
    "option": ({"option"}, {"select", "datalist"}),
}
P_SCOPE_STOP = frozenset(["button", "table", "td", "th", "caption", "marquee", "object", "applet", "html"])

NODE_SCHEMA = T.StructType([
    T.StructField("page_id", T.LongType()),
    T.StructField("node_id", T.IntegerType()),
    T.StructField("parent_id", T.IntegerType()),
    T.StructField("depth", T.IntegerType()),
    T.StructField("sib_idx", T.IntegerType()),
    T.StructField("tag_idx", T.IntegerType()),
    T.StructField("tag", T.StringType()),
    T.StructField("attrs", T.MapType(T.StringType(), T.StringType())),
    T.StructField("own_text", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("start", T.IntegerType()),
    T.StructField("end", T.IntegerType()),
    T.StructField("outer_html", T.StringType()),
    T.StructField("ancestor_ids", T.ArrayType(T.IntegerType())),
    T.StructField("ancestor_tags", T.ArrayType(T.StringType())),
])

_ARROW_SCHEMA = pa.schema([
    ("page_id", pa.int64()), ("node_id", pa.int32()), ("parent_id", pa.int32()),
    ("depth", pa.int32()), ("sib_idx", pa.int32()), ("tag_idx", pa.int32()), ("tag", pa.string()),
    ("attrs", pa.map_(pa.string(), pa.string())), ("own_text", pa.string()),
    ("text", pa.string()), ("start", pa.int32()), ("end", pa.int32()),
    ("outer_html", pa.string()), ("ancestor_ids", pa.list_(pa.int32())),
    ("ancestor_tags", pa.list_(pa.string())),
])


class _TreeBuilder(HTMLParser):
    """Builds flat node records for one page (see module doc for the rule)."""

    def __init__(self, src: str):
        super().__init__(convert_charrefs=True)
        self.src = src
        self.line_starts = [0]
        pos = src.find("\n")
        while pos >= 0:
            self.line_starts.append(pos + 1)
            pos = src.find("\n", pos + 1)
        self.nodes = []          # [node_id, parent, depth, sib, tag, attrs, own, tstart, tend, start, end, anc_ids, anc_tags]
        self.stack = []          # node ids
        self.child_count = {-1: 0}
        self.text_parts = []
        self.text_len = 0
        self.chunks = []         # stripped non-empty text chunks (for separator-joined text)
        self.raw_depth = 0

    def _offset(self) -> int:
        line, col = self.getpos()
        return self.line_starts[line - 1] + col

    def _close_top(self, end: int):
        nid = self.stack.pop()
        n = self.nodes[nid]
        n[8] = self.text_len
        n[10] = end
        n[14] = len(self.chunks)
        if n[4] in RAW_TAGS:
            self.raw_depth -= 1

    def _close_through(self, idx: int, end: int):
        while len(self.stack) > idx:
            self._close_top(end)

    def _find_open(self, names, stops):
        for i in range(len(self.stack) - 1, -1, -1):
            t = self.nodes[self.stack[i]][4]
            if t in names:
                return i
            if t in stops:
                return -1
        return -1

    def handle_starttag(self, tag, attrs):
        start = self._offset()
        raw = self.get_starttag_text() or ""
        if tag in P_CLOSERS:
            i = self._find_open({"p"}, P_SCOPE_STOP)
            if i >= 0:
                self._close_through(i, start)
        rule = IMPLIED_CLOSE.get(tag)
        if rule:
            i = self._find_open(rule[0], rule[1])
            if i >= 0:
                self._close_through(i, start)
        parent = self.stack[-1] if self.stack else -1
        sib = self.child_count.get(parent, 0)
        self.child_count[parent] = sib + 1
        nid = len(self.nodes)
        amap = {}
        for k, v in attrs:
            if k not in amap:
                amap[k] = v if v is not None else ""
        anc_ids = list(self.stack)
        anc_tags = [self.nodes[a][4] for a in anc_ids]
        end = start + len(raw)
        self.nodes.append([nid, parent, len(self.stack), sib, tag, amap, [], self.text_len, None,
                           start, end, anc_ids, anc_tags, len(self.chunks), None])
        if tag in VOID_TAGS:
            self.nodes[nid][8] = self.text_len
            self.nodes[nid][14] = len(self.chunks)
            return
        self.stack.append(nid)
        self.child_count[nid] = 0
        if tag in RAW_TAGS:
            self.raw_depth += 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID_TAGS and self.stack and self.nodes[self.stack[-1]][4] == tag:
            self._close_top(self.nodes[self.stack[-1]][10])

    def handle_endtag(self, tag):
        start = self._offset()
        gt = self.src.find(">", start)
        end = gt + 1 if gt >= 0 else len(self.src)
        for i in range(len(self.stack) - 1, -1, -1):
            if self.nodes[self.stack[i]][4] == tag:
                # elements opened inside close where this end tag starts
                while len(self.stack) > i + 1:
                    self._close_top(start)
                self._close_top(end)
                return

    def handle_data(self, data):
        if not data:
            return
        if self.stack:
            self.nodes[self.stack[-1]][6].append(data)
        if self.raw_depth:
            return
        self.text_parts.append(data)
        self.text_len += len(data)
        d = data.strip()
        if d:
            self.chunks.append(d)

    def finish(self):
        self.close()
        self._close_through(0, len(self.src))
        return self.nodes, "".join(self.text_parts)


    def sep_text(self, n, sep: str) -> str:
        """Descendant text as stripped chunks joined by ``sep``."""
        return sep.join(self.chunks[n[13]:n[14]])


ERROR_TAG = "#error"


def _built(html: str):
    b = _TreeBuilder(html)
    error = None
    try:
        b.feed(html)
        b.finish()
    except Exception as e:  # malformed beyond the tokenizer's tolerance: what was built, and why it ends
        error = f"{type(e).__name__}: {e}"
        b._close_through(0, len(html))
    return b, error


def _parsed(html: str):
    """(node records, text, text chunks, error) of the source tree."""
    b, error = _built(html)
    return b.nodes, "".join(b.text_parts), b.chunks, error


def parse_page(html: str, with_builder: bool = False):
    """Node records and text of one page; used by tests."""
    b, _ = _built(html or "")
    out = (b.nodes, "".join(b.text_parts))
    return (*out, b) if with_builder else out


def _error_node(nodes: list, text_len: int, error: str) -> list:
    """The record that marks a page as cut short, after its last node."""
    top = sum(1 for n in nodes if n[1] == -1)
    return [len(nodes), -1, 0, top, ERROR_TAG, {}, [error], text_len, text_len, 0, 0, [], [], 0, 0]


def page_errors(nodes: DataFrame) -> DataFrame:
    """``page_id, error`` of the pages whose parse ended early."""
    return nodes.filter(F.col("tag") == ERROR_TAG).select("page_id", F.col("own_text").alias("error"))


def in_class(*names: str) -> Callable[[str, dict, list], bool]:
    """``text_when`` for elements of one of the classes."""
    held = set(names)
    return lambda tag, attrs, above: not held.isdisjoint(attrs.get("class", "").split())


def _nodes_batches(batches, text_tags, outer_tags, text_sep=None, text_when=None, parse=_parsed):
    for batch in batches:
        ids = batch.column("page_id").to_pylist()
        htmls = batch.column("html").to_pylist()
        cols = {f.name: [] for f in _ARROW_SCHEMA}
        for pid, html in zip(ids, htmls):
            if html is None:
                continue
            nodes, text, chunks, error = parse(html)
            if error is not None:
                nodes = [*nodes, _error_node(nodes, len(text), error)]
            per_tag = {}
            for n in nodes:
                tag = n[4]
                ti = per_tag.get(tag, 0)
                per_tag[tag] = ti + 1
                cols["tag_idx"].append(ti)
                cols["page_id"].append(pid)
                cols["node_id"].append(n[0])
                cols["parent_id"].append(n[1])
                cols["depth"].append(n[2])
                cols["sib_idx"].append(n[3])
                cols["tag"].append(tag)
                cols["attrs"].append(list(n[5].items()))
                cols["own_text"].append("".join(n[6]))
                keep_text = text_when(tag, n[5], n[12]) if text_when is not None else text_tags is None or tag in text_tags
                if not keep_text:
                    cols["text"].append(None)
                elif text_sep is not None:
                    cols["text"].append(text_sep.join(chunks[n[13]:n[14]]))
                else:
                    cols["text"].append(text[n[7]:n[8]])
                cols["start"].append(n[9])
                cols["end"].append(n[10])
                keep_outer = outer_tags is not None and (outer_tags == "*" or tag in outer_tags)
                cols["outer_html"].append(html[n[9]:n[10]] if keep_outer else None)
                cols["ancestor_ids"].append(n[11])
                cols["ancestor_tags"].append(n[12])
            if len(cols["page_id"]) >= 20000:
                yield pa.RecordBatch.from_pydict(cols, schema=_ARROW_SCHEMA)
                cols = {f.name: [] for f in _ARROW_SCHEMA}
        if cols["page_id"]:
            yield pa.RecordBatch.from_pydict(cols, schema=_ARROW_SCHEMA)


def html_nodes(pages: DataFrame, text_tags=None, outer_tags=None, tags=None, carry: list[str] | None = None,
               text_sep: str | None = None, text_when: Callable[[str, dict, list], bool] | None = None, repair: bool = False) -> DataFrame:
    """B1: one row per element of every page.

    A page that breaks the tokenizer keeps the nodes before the break and gets
    one more row, of tag ``#error``, whose ``own_text`` tells why
    (``page_errors``).

    ``text_tags``: tags whose full descendant text is kept (None = all);
    ``text_when``: the same as a test of tag, attributes and enclosing tags;
    ``outer_tags``: tags whose source slice is kept (None = none, "*" = all);
    ``tags``: if given, only these element rows are returned (the tree is
    still built whole, so ancestry and implied closing are unaffected);
    ``carry``: page columns copied onto every node row (e.g. ``url`` for
    link resolution) so no join back to the pages is needed;
    ``repair``: build the tree of ``html_tree`` instead, which mends misnested
    formatting and content misplaced in tables as browsers do;
    ``text_sep``: when set, ``text`` is the stripped non-empty text chunks
    joined by it (``get_text(sep, strip=True)``) instead of the raw
    concatenation.
    The parse runs inside the tasks that read ``pages``: no shuffle.
    """
    text_tags = None if text_tags is None else frozenset(text_tags)
    if outer_tags is not None and outer_tags != "*":
        outer_tags = frozenset(outer_tags)
    keep = None if tags is None else frozenset(tags)
    carry = list(carry or [])
    carry_fields = [pages.schema[c] for c in carry]

    def run(batches):
        import pyarrow.compute as pc

        from tessera.operators.html_tree import parse_repaired
        for batch in batches:
            for rb in _nodes_batches([batch], text_tags, outer_tags, text_sep, text_when, parse_repaired if repair else _parsed):
                if keep is not None:
                    rb = rb.filter(pc.is_in(rb.column("tag"), value_set=pa.array(sorted(keep))))
                    if rb.num_rows == 0:
                        continue
                if carry:
                    # page values follow their page_id (rows of a batch keep page order)
                    ids = batch.column("page_id")
                    idx = pc.index_in(rb.column("page_id"), value_set=ids)
                    cols = [rb.column(i) for i in range(rb.num_columns)]
                    names = list(rb.schema.names)
                    for c in carry:
                        cols.append(pc.take(batch.column(c), idx))
                        names.append(c)
                    rb = pa.RecordBatch.from_arrays(cols, names=names)
                yield rb

    schema = T.StructType(NODE_SCHEMA.fields + carry_fields)
    return pages.select(F.col("page_id").cast("long"), "html", *carry).mapInArrow(run, schema)


# ---------------------------------------------------------------- selection (B2)

def has_class(cls: str) -> Column:
    return F.array_contains(F.split(F.trim(F.coalesce(F.col("attrs")["class"], F.lit(""))), r"\s+"), cls)


def select_nodes(nodes: DataFrame, tag=None, cls=None, attr=None, attr_value=None,
                 attr_contains=None, within_tag=None, within_cls=None) -> DataFrame:
    """B2: CSS-like selection as native predicates.

    ``within_tag``/``within_cls`` test the ancestor chain carried on each node,
    so a descendant selector is a filter, not a join.
    """
    cond = F.lit(True)
    if tag is not None:
        tags = [tag] if isinstance(tag, str) else list(tag)
        cond = cond & F.col("tag").isin(tags)
    if cls is not None:
        cond = cond & has_class(cls)
    if attr is not None:
        v = F.col("attrs")[attr]
        if attr_value is not None:
            cond = cond & (v == F.lit(attr_value))
        elif attr_contains is not None:
            cond = cond & F.coalesce(v.contains(attr_contains), F.lit(False))
        else:
            cond = cond & v.isNotNull()
    if within_tag is not None:
        cond = cond & F.array_contains(F.col("ancestor_tags"), within_tag)
    out = nodes.filter(cond)
    if within_cls is not None:
        anc = nodes.filter(has_class(within_cls)).select("page_id", F.col("node_id").alias("_anc"))
        out = (out.select("*", F.explode("ancestor_ids").alias("_anc"))
               .join(anc, ["page_id", "_anc"], "left_semi").drop("_anc").dropDuplicates(["page_id", "node_id"]))
    return out


def nearest_ancestor(tag: str) -> Column:
    """Id of the nearest enclosing element with this tag (null if none)."""
    z = F.arrays_zip(F.col("ancestor_ids").alias("i"), F.col("ancestor_tags").alias("t"))
    hits = F.filter(z, lambda x: x["t"] == F.lit(tag))
    return F.when(F.size(hits) > 0, at(hits, -1)["i"])


# ---------------------------------------------------------------- tables

def html_rows(nodes: DataFrame) -> DataFrame:
    """One row per ``tr`` with its ordered cell texts, cell tags and classes.

    A row belongs to its nearest enclosing table (nested tables stay apart);
    a cell to its nearest row.  Grouping is by page (bounded by page size).
    """
    cells = (nodes.filter(F.col("tag").isin("td", "th"))
             .select("page_id", nearest_ancestor("tr").alias("tr_id"), "node_id",
                     F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), r"\s+", " ")).alias("c"),
                     "tag", F.coalesce(F.col("attrs")["class"], F.lit("")).alias("cls"))
             .filter(F.col("tr_id").isNotNull()))
    trs = (nodes.filter(F.col("tag") == "tr")
           .select("page_id", F.col("node_id").alias("tr_id"), nearest_ancestor("table").alias("table_id"))
           .filter(F.col("table_id").isNotNull()))
    agg = (cells.groupBy("page_id", "tr_id")
           .agg(F.array_sort(F.collect_list(F.struct("node_id", "c", "tag", "cls"))).alias("cs")))
    rows = trs.join(agg, ["page_id", "tr_id"], "left")
    w = Window.partitionBy("page_id", "table_id").orderBy("tr_id")
    return rows.select(
        "page_id", "table_id", (F.row_number().over(w) - 1).alias("tr_idx"),
        F.coalesce(F.transform("cs", lambda x: x["c"]), F.array().cast("array<string>")).alias("cells"),
        F.coalesce(F.transform("cs", lambda x: x["tag"]), F.array().cast("array<string>")).alias("tags"),
        F.coalesce(F.transform("cs", lambda x: x["cls"]), F.array().cast("array<string>")).alias("classes"))


def header_score() -> Column:
    """B5 score of a candidate header row: non-empty ``th`` count; without
    ``th``, the count of cells with a Latin letter when they are at least half
    of the non-empty cells."""
    z = F.arrays_zip(F.col("cells").alias("c"), F.col("tags").alias("t"))
    th = F.filter(z, lambda x: x["t"] == "th")
    th_score = F.size(F.filter(th, lambda x: F.trim(x["c"]) != ""))
    nonempty = F.size(F.filter("cells", lambda c: F.trim(c) != ""))
    alpha = F.size(F.filter("cells", lambda c: c.rlike("[A-Za-z]")))
    td_score = F.when((nonempty > 0) & (alpha * 2 >= nonempty), alpha).otherwise(0)
    return F.when(F.size(th) > 0, th_score).otherwise(td_score)


def detect_header(rows: DataFrame, max_rows: int = 3, saved: DataFrame | None = None) -> DataFrame:
    """Per table the header row among the first ``max_rows`` rows: highest
    score, earliest on ties, score > 0.  A ``saved`` table
    ``(page_id, table_id, header_row)`` of earlier decisions wins.
    Returns ``page_id, table_id, header_idx, header, header_classes,
    header_tags`` (null header when none qualifies)."""
    cand = rows.filter(F.col("tr_idx") < max_rows).withColumn("score", header_score())
    best = (cand.groupBy("page_id", "table_id")
            .agg(F.max_by(F.struct("tr_idx", "cells", "classes", "score"),
                          F.struct("score", (-F.col("tr_idx")).alias("neg"))).alias("b")))
    best = best.select("page_id", "table_id",
                       F.when(F.col("b.score") > 0, F.col("b.tr_idx")).alias("header_idx"))
    if saved is not None:
        best = (best.join(saved.select("page_id", "table_id", F.col("header_row").alias("_saved")),
                          ["page_id", "table_id"], "left")
                .select("page_id", "table_id", F.coalesce("_saved", "header_idx").alias("header_idx")))
    hdr = rows.select("page_id", "table_id", F.col("tr_idx").alias("header_idx"),
                      F.col("cells").alias("header"), F.col("classes").alias("header_classes"), F.col("tags").alias("header_tags"))
    return best.join(hdr, ["page_id", "table_id", "header_idx"], "left")


def visible_positions(header_classes: Column, sidearm: Column) -> Column:
    """Header positions shown on a wide screen.  Positions whose class has
    ``hide-on-medium-down`` when any has it; else on a Sidearm page those
    without ``hide-on-large``; else all."""
    n = F.size(header_classes)
    idx = F.sequence(F.lit(0), n - 1)
    marked = F.filter(idx, lambda i: at(header_classes, i + 1).contains("hide-on-medium-down"))
    not_large = F.filter(idx, lambda i: ~at(header_classes, i + 1).contains("hide-on-large"))
    return (F.when(n == 0, F.array().cast("array<int>"))
            .when(F.size(marked) > 0, marked)
            .when(sidearm, not_large)
            .otherwise(idx))


def align_rows(cells: Column, width: Column) -> Column:
    """Pad with '' or cut to the header width."""
    return F.slice(F.concat(cells, F.array_repeat(F.lit(""), width)), 1, width)


def non_empty_row(cells: Column) -> Column:
    return F.exists(cells, lambda c: F.trim(c) != "")


def table_records(rows: DataFrame, headers: DataFrame) -> DataFrame:
    """B7 + B8 + F7 (widest row): data rows below the header aligned to the header width (or to
    the widest row with generated ``col1..colN`` headers when no header was
    found); empty rows dropped.  ``row_idx`` numbers all aligned rows 1..n
    before empty ones are removed (G2 numbers over all of them)."""
    r = rows.join(headers.select("page_id", "table_id", "header_idx", "header", "header_classes"),
                  ["page_id", "table_id"], "inner")
    wtab = Window.partitionBy("page_id", "table_id")
    r = r.withColumn("_maxw", F.max(F.size("cells")).over(wtab))  # F7
    gen = F.transform(F.sequence(F.lit(1), F.greatest(F.col("_maxw"), F.lit(1))),
                      lambda i: F.concat(F.lit("col"), i.cast("string")))
    r = (r.withColumn("header", F.when(F.col("header_idx").isNull(), gen).otherwise(F.col("header")))
         .withColumn("header_classes", F.coalesce("header_classes", F.array().cast("array<string>")))
         .filter(F.col("header_idx").isNull() | (F.col("tr_idx") > F.col("header_idx"))))
    width = F.size("header")
    r = r.withColumn("cells", align_rows(F.col("cells"), width)).withColumn(
        "tags", align_rows(F.col("tags"), width))
    w = Window.partitionBy("page_id", "table_id").orderBy("tr_idx")
    r = r.withColumn("row_idx", F.row_number().over(w))
    return r.filter(non_empty_row(F.col("cells"))).drop("_maxw")


def choose_tables(tables: DataFrame, tier: Column) -> DataFrame:
    """Keep all tables of the first non-empty tier per page
    (given path = 0, inside ``main`` = 1, any = 2)."""
    w = Window.partitionBy("page_id")
    return (tables.withColumn("_tier", tier)
            .withColumn("_best", F.min("_tier").over(w))
            .filter(F.col("_tier") == F.col("_best")).drop("_tier", "_best"))


# ---------------------------------------------------------------- text forms

def paragraphs(nodes: DataFrame) -> DataFrame:
    """Every ``<p>`` as its HTML source slice, in document order
    (``p_idx`` is the node's ``tag_idx``: map-only, no shuffle)."""
    return (nodes.filter(F.col("tag") == "p")
            .select("page_id", "node_id", F.col("tag_idx").alias("p_idx"), "outer_html", "text"))


def chunk_rows(df: DataFrame, key: str, order: str, value: str, n: int, sep: str = "\n",
               index: str | None = None) -> DataFrame:
    """Groups of ``n`` consecutive items per key joined by ``sep``.

    ``index`` names a column that already numbers the items 0.. per key
    (``p_idx`` from the node table): then no window is needed.  Otherwise
    the item number comes from ``row_number`` over the key (for keys of
    bounded size: a page, a message).  Each group holds at most ``n`` items.
    """
    if index is None:
        w = Window.partitionBy(key).orderBy(order)
        df = df.withColumn("_i", F.row_number().over(w) - 1)
    else:
        df = df.withColumn("_i", F.col(index))
    x = df.withColumn("chunk_idx", F.floor(F.col("_i") / n).cast("int"))
    return (x.groupBy(key, "chunk_idx")
            .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_i", F.col(value).alias("v")))),
                                          lambda s: s["v"]), sep).alias("chunk"),
                 F.count(F.lit(1)).alias("n_items")))


# The replacement order of the mail HTML-to-text step.
def html_to_text(html: Column) -> Column:
    """``br`` and block ends become newlines, ``li`` a bullet, four
    entities decoded, tags removed, 3+ newlines squeezed to two, trimmed."""
    x = F.coalesce(html, F.lit(""))
    x = F.regexp_replace(x, r"(?i)<br\s*/?>", "\n")
    x = F.regexp_replace(x, r"(?i)</(p|div|li|h\d)>", "\n")
    x = F.regexp_replace(x, r"(?i)<li>", "• ")
    x = F.regexp_replace(x, "&nbsp;", " ")
    x = F.regexp_replace(x, "&amp;", "&")
    x = F.regexp_replace(x, "&lt;", "<")
    x = F.regexp_replace(x, "&gt;", ">")
    x = F.regexp_replace(x, r"<[^>]+>", "")
    x = F.regexp_replace(x, r"\n{3,}", "\n\n")
    return F.regexp_replace(x, r"^\s+|\s+$", "")


def strip_forward_header(txt: Column) -> Column:
    """From a 'Begin forwarded message' marker on, drop the header lines
    up to and including the Subject line (decision D15)."""
    pos = F.regexp_instr(txt, F.lit(r"(?i)Begin forwarded message"))
    cut_txt = F.when(pos > 0, F.substring(txt, pos, F.lit(1 << 30)))
    removed = F.regexp_replace(cut_txt, r"(?is)^.*?Subject:[^\n]*\n", "")
    return F.when(pos > 0, removed).otherwise(txt)
