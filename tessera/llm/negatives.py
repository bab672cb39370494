"""Hard negatives of anchor vectors, by best-first search in packed R-trees.

A row's score is its integer inner product with the anchor; higher scores come
first, ties by smaller id.  An anchor's positives are its first rows of the
same label; for each of them the first rows of other labels whose score lies
in a share window of the positive's score are its hard negatives.

1. Rows are dealt to tiles sort-tile-recursive: cuts along the two coordinates
   that spread most, placed by a sample of about ``SAMPLE`` rows (by hashes).  A
   tile with many rows (copies of one vector) is split by hash.  There are at
   most ``2 * MAX_TILES`` tiles, each of them one stored row: the packed
   R-tree of its rows.  Every row is in one tile; nothing is approximate.
2. The tiles' bounding boxes (a table of that bounded size) tell the interval
   of an anchor's scores in each tile.  An anchor first asks the tile with the
   greatest bound; with the k-th score found there it asks all others that
   may hold a score not below it, inside the windows.
3. In a tile, a queue of boxes by greatest possible score opens boxes until the
   next lies strictly below the k-th score or outside the windows.
4. Per anchor and window the tiles' first rows are merged.

The anchors are a stated query set asked against all rows in blocks of
``BLOCK``.  Where no box can be pruned (vectors without any structure) every
tile is read for every block, so work grows with anchors times rows.

Defined results: rows with a null label, a null vector or a null or non-finite
component take no part; identical rows (id, label and vector) count once; rows
of the anchor's id are no positives of it; a null id is no anchor and comes
last in ties; shorter vectors are read as filled up with zeros; components
and scores are held to 64 bits (scores beyond 2^53 are rounded); a negative
positive score has no window; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm import rtree
from tessera.llm.common import as_column, stored

POSITIVES = 5
NEGATIVES = 10
LOW, HIGH = 30, 90       # window, in hundredths of the positive's score
SCALE = 256
TILE_ROWS = 1 << 12
MAX_TILES = 1 << 12
SAMPLE = 1 << 15
BLOCK = 1 << 16
_INF = float("inf")


def prepared(rows: DataFrame, id_col: str, vector_col: str, label: Column, scale: int = SCALE) -> DataFrame:
    """``id, label, v (array of long), tag``: the rows that take part."""
    x = F.col(vector_col).cast("array<double>")
    whole = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(_INF)))
    out = rows.select(F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"),
                      F.when(whole, F.transform(x, lambda c: F.floor(c * scale))).alias("v"))
    out = out.where("label is not null and v is not null")
    return out.withColumn("tag", F.xxhash64("label", "v")).dropDuplicates(["id", "tag"])


def _matrix(lists, dims: int) -> np.ndarray:
    """Rows of an Arrow list column as float64, filled up with zeros."""
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    size = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if (size == dims).all():
        return flat.reshape(-1, dims)
    out = np.zeros((len(lists), dims))
    out[np.arange(dims) < size[:, None]] = flat
    return out


class Cuts:
    """Slabs along one coordinate, tiles along another inside each slab."""

    def __init__(self, sample: np.ndarray, tiles: int):
        spread = sample.var(0) if len(sample) else np.zeros(1)
        self.axes = np.argsort(-spread, kind="stable")[:2]
        self.side = max(1, int(np.ceil(np.sqrt(tiles))))
        share = np.arange(1, self.side) / self.side
        first = sample[:, self.axes[0]] if len(sample) else np.zeros(1)
        second = sample[:, self.axes[-1]] if len(sample) else np.zeros(1)
        self.slabs = np.quantile(first, share) if self.side > 1 else np.zeros(0)
        slab = np.searchsorted(self.slabs, first, side="right")
        self.inner = [np.quantile(second[slab == s], share) if self.side > 1 and (slab == s).any() else np.zeros(0) for s in range(self.side)]

    def tile(self, v: np.ndarray) -> np.ndarray:
        slab = np.searchsorted(self.slabs, v[:, self.axes[0]], side="right")
        out = slab * self.side
        for s in range(self.side):
            at = slab == s
            out[at] += np.searchsorted(self.inner[s], v[at, self.axes[-1]], side="right")
        return out


_TILE = "tile long, ids binary, tags binary, labels binary, vectors binary, lo array<double>, hi array<double>"
_NO_ID = np.iinfo(np.int64).max


def _pack(dims: int):
    def run(key, table):
        v = _matrix(table.column("v"), dims)
        order = rtree.packed_order(v)
        v = v[order]
        # ids with null as the last, flagged by a tag column of their own
        ids = table.column("id").combine_chunks()
        gone = np.asarray(ids.is_null())
        ids = ids.fill_null(_NO_ID).to_numpy(zero_copy_only=False)
        small = v.astype(np.int16) if np.abs(v).max(initial=0) < 2**15 else v
        return pa.table({"tile": pa.array([key[0].as_py()], pa.int64()),
                         "ids": pa.array([np.concatenate([ids[order], gone[order].astype(np.int64)]).tobytes()], pa.binary()),
                         "tags": pa.array([table.column("tag").to_numpy()[order].tobytes()], pa.binary()),
                         "labels": pa.array([table.column("label").to_numpy()[order].tobytes()], pa.binary()),
                         "vectors": pa.array([small.tobytes()], pa.binary()),
                         "lo": pa.array([v.min(0).tolist()], pa.list_(pa.float64())), "hi": pa.array([v.max(0).tolist()], pa.list_(pa.float64()))})
    return run


class Index:
    """The tiles of a stored table of rows, and their boxes."""

    def __init__(self, rows: DataFrame, tile_rows: int = TILE_ROWS, max_tiles: int = MAX_TILES, sample: int = SAMPLE):
        n, dims = rows.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
        self.dims = dims = max(1, int(dims))
        tiles = max(1, min(max_tiles, -(-n // tile_rows)))
        share = F.pmod(F.xxhash64("tag", "id"), F.lit(1 << 30)) < int((1 << 30) * min(1.0, sample / max(n, 1)))
        some = rows.where(share).select("v").toArrow()
        cuts = Cuts(_matrix(some.column("v"), dims), tiles)

        def deal(batches):
            for b in batches:
                t = cuts.tile(_matrix(as_column(b, "v"), dims)) if b.num_rows else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays([as_column(b, c) for c in ("id", "label", "v", "tag")] + [pa.array(t, pa.int64())],
                                                 names=["id", "label", "v", "tag", "t"])

        dealt = stored(rows.select("id", "label", "v", "tag").mapInArrow(deal, "id long, label long, v array<long>, tag long, t long"), "negatives-dealt")
        # parts of the tiles that hold more than twice their share
        large = -(-n // tiles) * 2 if n else 1
        full = dealt.groupBy("t").count().where(F.col("count") > large).toArrow()
        parts = {t: -(-c // large) for t, c in zip(full.column("t").to_pylist(), full.column("count").to_pylist())}
        part = F.lit(0).cast("long")
        if parts:
            of = F.create_map(*[F.lit(x).cast("long") for kv in parts.items() for x in kv])
            part = F.pmod(F.xxhash64("tag", "id", F.lit(3)), F.coalesce(of[F.col("t")], F.lit(1).cast("long")))
        self.tiles = stored(dealt.withColumn("tile", F.shiftleft("t", 20) + part).groupBy("tile").applyInArrow(_pack(dims), _TILE), "negatives-tiles")
        boxes = self.tiles.select("tile", "lo", "hi").orderBy("tile").toArrow()
        self.names = boxes.column("tile").to_numpy()
        self.lo, self.hi = _matrix(boxes.column("lo"), dims), _matrix(boxes.column("hi"), dims)

    def _route(self, asked: DataFrame, home: bool) -> DataFrame:
        """Requests (tile, row of ``asked``): the first tile of each, or all
        others that its windows and floors leave open."""
        names, lo, hi, dims = self.names, self.lo, self.hi, self.dims
        out = T.StructType([*asked.schema.fields, T.StructField("tile", T.LongType())])

        def run(batches):
            for b in batches:
                if not b.num_rows or not names.size:
                    continue
                least, most = rtree.intervals(_matrix(as_column(b, "v"), dims), lo, hi)
                low, high, floor = (as_column(b, c).to_pylist() for c in ("low", "high", "floor"))
                who, where = [], []
                for i in range(b.num_rows):
                    # the tile that may hold the best score inside the windows
                    cap = max(high[i])
                    first = int(np.lexsort((-most[i], -np.minimum(most[i], cap)))[0])
                    if home:
                        tiles = np.array([first])
                    else:
                        open_ = np.zeros(names.size, bool)
                        for a, z, f in zip(low[i], high[i], floor[i]):
                            open_ |= (most[i] >= max(a, f)) & (least[i] <= z)
                        open_[first] = False
                        tiles = np.flatnonzero(open_)
                    who.append(np.full(tiles.size, i))
                    where.append(tiles)
                who, where = np.concatenate(who), np.concatenate(where)
                yield pa.RecordBatch.from_arrays([c.take(pa.array(who)) for c in b.columns] + [pa.array(names[where])], names=[*b.schema.names, "tile"])

        return asked.mapInArrow(run, out)

    def _ask(self, asked: DataFrame, blocks: int, home: bool, k: int, same: bool) -> DataFrame:
        dims = self.dims
        requests = self._route(asked, home).withColumn("block", F.pmod(F.xxhash64("a_id", "a_tag"), F.lit(blocks)))
        tiles = self.tiles.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
        schema = "a_id long, a_tag long, w int, score long, r_id long, r_tag long"

        def run(key, left, right):
            cols = [[], [], [], []]
            if left.num_rows and right.num_rows:
                t = right.slice(0, 1).to_pylist()[0]
                tags, labels = (np.frombuffer(t[c], np.int64) for c in ("tags", "labels"))
                ids, gone = np.frombuffer(t["ids"], np.int64).reshape(2, -1)
                v = np.frombuffer(t["vectors"], np.int16 if len(t["vectors"]) == 2 * tags.size * dims else np.float64).reshape(-1, dims)
                rank = np.empty(tags.size, np.int64)
                rank[np.lexsort((tags, ids, gone))] = np.arange(tags.size)
                a_id, a_label = left.column("a_id").to_numpy(), left.column("a_label").to_numpy()

                def allowed(who, rows):
                    mine = labels[rows] == a_label[who]
                    return mine & ((ids[rows] != a_id[who]) | (gone[rows] == 1)) if same else ~mine

                low, high, floor = (left.column(c).to_pylist() for c in ("low", "high", "floor"))
                for who, j, score, rows in rtree.Tree(v).search(_matrix(left.column("v"), dims), low, high, floor, k, allowed, rank):
                    for c, x in zip(cols, (np.full(rows.size, who), np.full(rows.size, j), np.clip(score, -2.0**63, 2.0**63 - 1024), rows)):
                        c.append(x)
            who, j, score, at = (np.concatenate(c) if c else np.zeros(0, np.int64) for c in cols)
            r_id, r_tag, none = (ids[at], tags[at], gone[at] == 1) if at.size else (at, at, at == 1)
            return pa.table({"a_id": left.column("a_id").take(pa.array(who)), "a_tag": left.column("a_tag").take(pa.array(who)),
                             "w": pa.array(j, pa.int32()), "score": pa.array(score.astype(np.int64)),
                             "r_id": pa.array(r_id, pa.int64(), mask=none), "r_tag": pa.array(r_tag, pa.int64())})

        return requests.groupBy("tile", "block").cogroup(tiles.groupBy("tile", "block")).applyInArrow(run, schema)

    def first(self, asked: DataFrame, k: int, same: bool, block: int = BLOCK) -> DataFrame:
        """``asked`` (a stored table: a_id, a_tag, a_label, v, low, high: arrays
        of equal length) -> ``a_id, a_tag, w, nth, score, r_id, r_tag``: the
        ``k`` first rows per window."""
        blocks = max(1, -(-asked.count() // block))
        asked = asked.withColumn("floor", F.transform("low", lambda x: F.lit(-_INF)))
        near = stored(self._ask(asked, blocks, True, k, same), "negatives-home")
        # the k-th score of the windows that are full already
        kth = (near.groupBy("a_id", "a_tag", "w").agg(F.count(F.lit(1)).alias("n"), F.min("score").cast("double").alias("kth"))
                   .where(F.col("n") >= k).groupBy(F.col("a_id").alias("k_id"), F.col("a_tag").alias("k_tag"))
                   .agg(F.map_from_entries(F.collect_list(F.struct("w", "kth"))).alias("kth")))
        again = asked.join(kth, (F.col("a_id") == F.col("k_id")) & (F.col("a_tag") == F.col("k_tag")), "left")
        floors = F.transform("low", lambda x, i: F.coalesce(F.try_element_at("kth", i), F.lit(-_INF)))
        again = stored(again.withColumn("floor", floors).select(*asked.columns), "negatives-asked")
        every = near.unionByName(self._ask(again, blocks, False, k, same))
        # at most k rows of each tile
        w = Window.partitionBy("a_id", "a_tag", "w").orderBy(F.desc("score"), F.asc_nulls_last("r_id"), "r_tag")
        return every.withColumn("nth", F.row_number().over(w)).where(F.col("nth") <= k)


def mine(rows: DataFrame, anchors: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
         low: int = LOW, high: int = HIGH, **options) -> DataFrame:
    """``rows`` (``prepared``) and a condition that names the anchors ->
    ``anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score``."""
    rows = stored(rows, "negatives-rows")
    index = Index(rows, **options)
    asked = rows.where(anchors & F.col("id").isNotNull()).select(F.col("id").alias("a_id"), F.col("tag").alias("a_tag"), F.col("label").alias("a_label"), "v")
    asked = stored(asked, "negatives-anchors")
    whole = asked.withColumns({"low": F.array(F.lit(-_INF)), "high": F.array(F.lit(_INF))})
    found = stored(index.first(whole, positives, True), "negatives-positives")
    score = F.col("score").cast("decimal(20,0)")
    found = found.withColumns({"low": F.ceil(score * low / 100).cast("double"), "high": F.floor(score * high / 100).cast("double")})
    # an anchor's positives, in order: a handful
    wins = (found.where("low <= high").groupBy(F.col("a_id").alias("p_id"), F.col("a_tag").alias("p_tag"))
                 .agg(F.array_sort(F.collect_list(F.struct("nth", "low", "high"))).alias("p")))
    open_ = asked.join(wins, (F.col("a_id") == F.col("p_id")) & (F.col("a_tag") == F.col("p_tag")))
    open_ = stored(open_.select("a_id", "a_tag", "a_label", "v", F.col("p.nth").alias("nth"), F.col("p.low").alias("low"), F.col("p.high").alias("high")), "negatives-windows")
    hard = index.first(open_.drop("nth"), negatives, False).select(
        F.col("a_id").alias("h_id"), F.col("a_tag").alias("h_tag"), "w", F.col("nth").alias("rank"), F.col("r_id").alias("negative_id"), F.col("score").alias("negative_score"))
    # window number -> positive
    pos = found.where("low <= high").withColumn("w", F.row_number().over(Window.partitionBy("a_id", "a_tag").orderBy("nth")) - 1)
    out = pos.withColumnRenamed("w", "p_w").join(hard, (F.col("a_id") == F.col("h_id")) & (F.col("a_tag") == F.col("h_tag")) & (F.col("p_w") == F.col("w")))
    return out.select(F.col("a_id").alias("anchor_id"), F.col("r_id").alias("positive_id"), F.col("rank").cast("int").alias("rank"), "negative_id",
                      F.col("score").alias("positive_score"), "negative_score")
