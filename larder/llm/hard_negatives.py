"""Hard negatives through STR-packed R-trees.

The rows are tiled: slabs by cuts of the coordinate that varies most, ranges
of the next one inside.  Each task packs its rows into trees by sort-tile-
recursion: leaves of neighbouring rows with their minimum bounding boxes, and
boxes of boxes above.  For a query a box gives an interval of inner products,
coordinate by coordinate (the larger and the smaller of q * low and q * high).
A best-first queue opens the box of the largest upper end first and leaves out
boxes whose interval misses every score window, whose upper end is strictly
below the kth score found so far, or whose labels cannot match.

Queries are taken in blocks of bounded size, each block in two passes over the
trees: the positives, then the negatives in the windows that they set.  Tasks
return their best few; one grouped cut per query and window merges them.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from larder.llm.common import numbered, slices, stored
from larder.llm.vectors import scaled, usable
from larder.session import scratch_dir

SCALE = 256
TREE_ROWS, LEAF_ROWS, FANOUT = 8192, 256, 8
# Bytes of a block of queries, as doubles; bounds every broadcast.
BLOCK_BYTES = 8 << 20
# Queries whose boxes' intervals a task computes at once.
QUERIES_AT_ONCE = 512
LOWEST, HIGHEST = -(1 << 63), (1 << 63) - 1


def _narrow(x: np.ndarray) -> np.ndarray:
    """The whole numbers in the smallest type that holds them."""
    most = int(np.abs(x).max()) if x.size else 0
    return x.astype("<i2" if most < 1 << 15 else "<i4" if most < 1 << 31 else "<i8")


# ------------------------------------------------------------------ trees


def tile_order(x: np.ndarray, leaf_rows: int) -> np.ndarray:
    """Row order of a sort-tile-recursive packing into leaves of ``leaf_rows``."""
    leaves = math.ceil(len(x) / leaf_rows)
    spread = x.astype(np.float64).var(0)
    dims = [int(d) for d in np.argsort(-spread, kind="stable")[:max(1, math.ceil(math.log2(max(leaves, 2))))]]

    def pack(rows: np.ndarray, left: list[int]) -> list[np.ndarray]:
        here = math.ceil(len(rows) / leaf_rows)
        if here <= 1 or not left:
            return [rows]
        slabs = math.ceil(here ** (1 / len(left)))
        size = math.ceil(here / slabs) * leaf_rows
        rows = rows[np.argsort(x[rows, left[0]], kind="stable")]
        return [part for lo in range(0, len(rows), size) for part in pack(rows[lo:lo + size], left[1:])]

    return np.concatenate(pack(np.arange(len(x)), dims))


class Tree:
    """An R-tree over whole vectors: rows in packed order, boxes by level."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray, leaf_rows: int = LEAF_ROWS, fanout: int = FANOUT):
        self.ids, self.labels, self.x, self.leaf_rows, self.fanout = ids, labels, x, leaf_rows, fanout
        starts = np.arange(0, len(x), leaf_rows)
        cut = lambda f, a, at: f.reduceat(a, at, axis=0)
        level = [cut(np.minimum, x, starts), cut(np.maximum, x, starts), cut(np.minimum, labels, starts), cut(np.maximum, labels, starts)]
        self.levels = [level]
        while len(level[0]) > 1:
            at = np.arange(0, len(level[0]), fanout)
            level = [cut(f, a, at) for f, a in zip((np.minimum, np.maximum) * 2, level, strict=True)]
            self.levels.append(level)
        self.label_ranges = [list(zip(lv[2].tolist(), lv[3].tolist(), strict=True)) for lv in self.levels]

    def intervals(self, q: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """(lower, upper) ends of the inner products of each query with each
        box, by level."""
        plus, minus = np.maximum(q, 0), np.minimum(q, 0)
        return [(plus @ lo.T + minus @ hi.T, plus @ hi.T + minus @ lo.T) for lo, hi, _, _ in self.levels]


def search(tree: Tree, q: np.ndarray, own_id: int, label: int, same: bool, ends: list[tuple[list, list]],
           lows: list[int], highs: list[int], scores: np.ndarray, ids: np.ndarray) -> int:
    """Merge the tree's rows into the best of each window; the boxes opened.

    ``ends``: by level, the (lower, upper) ends of this query's intervals.
    ``scores``, ``ids``: (window, place), best first, kept up to date; free
    places hold ``LOWEST``.  Rows of the query's own id never count.
    """
    opened, top = 0, len(tree.levels) - 1
    floors = [max(low, int(s)) for low, s in zip(lows, scores[:, -1], strict=True)]
    queue = [(-u, top, k) for k, u in enumerate(ends[top][1])]
    heapq.heapify(queue)
    while queue:
        minus_upper, level, k = heapq.heappop(queue)
        lower, upper = ends[level][0][k], -minus_upper
        if upper < min(floors):
            break  # and so is all that waits
        if not any(lower <= high and upper >= floor for high, floor in zip(highs, floors, strict=True)):
            continue
        least, most = tree.label_ranges[level][k]
        if not (least <= label <= most) if same else least == most == label:
            continue
        opened += 1
        if level:
            uppers = ends[level - 1][1]
            for child in range(k * tree.fanout, min((k + 1) * tree.fanout, len(uppers))):
                heapq.heappush(queue, (-uppers[child], level - 1, child))
            continue
        rows = slice(k * tree.leaf_rows, (k + 1) * tree.leaf_rows)
        s = tree.x[rows] @ q
        fits = (tree.labels[rows] == label) == same
        fits &= (s >= min(floors)) & (s <= max(highs)) & (tree.ids[rows] != own_id)
        found = np.flatnonzero(fits)
        if not len(found):
            continue
        s, who = s[found].astype(np.int64), tree.ids[rows][found]
        for w, (high, floor) in enumerate(zip(highs, floors, strict=True)):
            inside = (s >= floor) & (s <= high)
            if inside.any():
                all_s, all_ids = np.concatenate([scores[w], s[inside]]), np.concatenate([ids[w], who[inside]])
                order = np.lexsort((all_ids, ~all_s))[:scores.shape[1]]  # ~ falls like -, and takes LOWEST
                scores[w], ids[w] = all_s[order], all_ids[order]
                floors[w] = max(lows[w], int(scores[w, -1]))
    return opened


def _exact(x: np.ndarray, q: np.ndarray) -> type:
    """Doubles where they hold every sum exactly, else whole numbers."""
    most = [int(np.abs(a).max()) if a.size else 0 for a in (x, q)]
    return np.float64 if most[0] * most[1] * max(x.shape[1], 1) < 1 << 53 else np.int64


def pack_trees(rows: DataFrame, width: int, n: int) -> DataFrame:
    """(ids, labels, x, kind): a row for each tree, of at most ``TREE_ROWS`` rows."""
    spark = rows.sparkSession

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, squares = np.zeros(width), np.zeros(width)
        for batch in slices(batches, 8192):
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, width).astype(np.float64)
            total += x.sum(0)
            squares += (x * x).sum(0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width, dtype=np.int32)), pa.array(total), pa.array(squares)], ["d", "s", "ss"])

    parts = rows.select("x").mapInArrow(moments, "d int, s double, ss double").groupBy("d")
    spread = parts.agg((F.sum("ss") / n - (F.sum("s") / n) ** 2).alias("v")).orderBy(F.desc("v"), "d").limit(2).collect()
    first, second = spread[0]["d"], spread[-1]["d"]
    trees = max(1, math.ceil(n / TREE_ROWS))
    slabs = math.ceil(math.sqrt(trees))
    coordinate = F.col("x")[first]
    cuts = rows.select(coordinate.alias("c")).approxQuantile("c", [k / slabs for k in range(1, slabs)], 0.01) if slabs > 1 else []
    slab = sum(((coordinate > F.lit(c)).cast("int") for c in cuts), F.lit(0))
    dealt = rows.withColumns({"slab": slab, "c": F.col("x")[second]})
    # The id last: copies of a frequent vector are dealt over many trees.
    dealt = dealt.repartitionByRange(trees, "slab", "c", "id").sortWithinPartitions("slab", "c", "id").select("id", "label", "x")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def tree() -> pa.RecordBatch:
            t = pa.Table.from_batches(held).combine_chunks()
            x = t.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            order = tile_order(x, LEAF_ROWS)
            packed = _narrow(x[order])
            numbers = [np.ascontiguousarray(t.column(c).to_numpy()[order], "<i8").tobytes() for c in ("id", "label")]
            return pa.RecordBatch.from_arrays([*(pa.array([b], pa.binary()) for b in (*numbers, packed.tobytes())),
                                               pa.array([packed.dtype.str])], ["ids", "labels", "x", "kind"])

        for batch in slices(batches, TREE_ROWS):
            while batch.num_rows:
                part = batch.slice(0, TREE_ROWS - sum(b.num_rows for b in held))
                held.append(part)
                batch = batch.slice(part.num_rows)
                if sum(b.num_rows for b in held) == TREE_ROWS:
                    yield tree()
                    held.clear()
        if held:
            yield tree()

    return stored(spark, dealt.mapInArrow(build, "ids binary, labels binary, x binary, kind string"), "hard-negatives-trees")


# ----------------------------------------------------------------- search


def _pass(trees: DataFrame, queries: dict[str, np.ndarray], same: bool, k: int) -> DataFrame:
    """The first ``k`` rows of each query's windows: no, w, score, id.

    ``queries``: id, label, x and, by query and window, low and high (a window
    with low above high is no window)."""
    spark = trees.sparkSession
    block = spark.sparkContext.broadcast(queries)  # bounded by BLOCK_BYTES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b = block.value
        n, windows = b["low"].shape
        scores, ids = np.full((n, windows, k), LOWEST, np.int64), np.full((n, windows, k), HIGHEST, np.int64)
        for batch in slices(batches, 1):
            kind = np.dtype(batch.column("kind")[0].as_py())
            x = np.frombuffer(batch.column("x")[0].as_py(), kind).reshape(-1, b["x"].shape[1])
            exact = _exact(x, b["x"])
            own, labels = (np.frombuffer(batch.column(c)[0].as_py(), "<i8") for c in ("ids", "labels"))
            tree = Tree(own, labels, x.astype(exact))
            for lo in range(0, n, QUERIES_AT_ONCE):
                q = b["x"][lo:lo + QUERIES_AT_ONCE].astype(exact)
                ends = tree.intervals(q)
                for j in range(len(q)):
                    a = lo + j
                    some = np.flatnonzero(b["low"][a] <= b["high"][a])
                    if len(some):
                        s, i = scores[a, some], ids[a, some]
                        search(tree, q[j], int(b["id"][a]), int(b["label"][a]), same,
                               [(low[j].tolist(), up[j].tolist()) for low, up in ends],
                               b["low"][a, some].tolist(), b["high"][a, some].tolist(), s, i)
                        scores[a, some], ids[a, some] = s, i
        a, w, place = np.nonzero(scores > LOWEST)
        for lo in range(0, len(a), 1 << 16):
            at = (a[lo:lo + (1 << 16)], w[lo:lo + (1 << 16)], place[lo:lo + (1 << 16)])
            yield pa.RecordBatch.from_arrays([pa.array(at[0]), pa.array(at[1]), pa.array(scores[at]), pa.array(ids[at])], ["no", "w", "score", "id"])

    found = trees.mapInArrow(run, "no long, w long, score long, id long")
    best = Window.partitionBy("no", "w").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def _block_of(anchors: DataFrame, lo: int, hi: int) -> dict[str, np.ndarray] | None:
    """The queries numbered lo to hi - 1 as arrays."""
    t = anchors.where((F.col("no") >= lo) & (F.col("no") < hi)).orderBy("no").toArrow()
    if not t.num_rows:
        return None
    x = t.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(t.num_rows, -1)
    return {"id": t.column("id").to_numpy(), "label": t.column("label").to_numpy(), "x": x}


def mine(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", every: int = 100,
         n_positives: int = 5, n_negatives: int = 5, least_percent: int = 80) -> DataFrame:
    """Hard negatives: anchor_id, positive_id, rank, negative_id,
    positive_score, negative_score.

    Entries become floor(256 * c); a score is the whole inner product with the
    anchor; higher first, ties by smaller id.  Anchors are the rows whose id is
    divisible by ``every``; positives an anchor's first rows of its label;
    negatives of a pair the first rows of another label whose score is at least
    ``least_percent`` percent of the positive's and at most the positive's.

    Rows with a null id or label, and rows whose vector is null, empty, of
    another length than most, or holds null or non-finite entries take no part.
    Repeated rows count as often as they stand there, but rows of the anchor's
    own id are none of its positives or negatives; a repeated anchor gives its
    rows as often.  Pairs without a negative give no row; an empty table gives
    none.  Scores must fit a long.  Other columns are not read.
    """
    spark = df.sparkSession
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    rows = df.select(df[id_col].cast("long").alias("id"), df[label_col].cast("long").alias("label"), df[vector_col].alias("v"))
    rows = usable(rows.where("id is not null and label is not null"), "v")
    rows = stored(spark, rows.select("id", "label", scaled(F.col("v"), SCALE).alias("x")), "hard-negatives-rows")
    size = rows.agg(F.count("*").alias("n"), F.max(F.size("x")).alias("width"),
                    F.count(F.when(F.col("id") % every == 0, 1)).alias("anchors")).first()
    if not size["anchors"]:
        return spark.createDataFrame([], schema)
    trees = pack_trees(rows, size["width"], size["n"])
    anchors = numbered(rows.where(F.col("id") % every == 0), "no", "hard-negatives-anchors")
    at_once = max(1, BLOCK_BYTES // (8 * size["width"]))
    out = scratch_dir(spark, "hard-negatives")
    for lo in range(0, size["anchors"], at_once):
        _mine_block(spark, trees, _block_of(anchors, lo, lo + at_once), n_positives, n_negatives, least_percent).write.mode("append").parquet(out)
    return spark.read.schema(schema).parquet(out)


def _mine_block(spark: SparkSession, trees: DataFrame, queries: dict[str, np.ndarray], n_positives: int, n_negatives: int,
                least_percent: int) -> DataFrame:
    n = len(queries["id"])
    whole = {"low": np.full((n, 1), LOWEST, np.int64), "high": np.full((n, 1), HIGHEST, np.int64)}
    found = _pass(trees, queries | whole, True, n_positives).select("no", "rank", "score", "id").toArrow()  # a few for each query of the block
    no, place = found.column("no").to_numpy(), found.column("rank").to_numpy() - 1
    score, who = np.zeros((n, n_positives), np.int64), np.zeros((n, n_positives), np.int64)
    score[no, place], who[no, place] = found.column("score").to_numpy(), found.column("id").to_numpy()
    low, high = np.ones((n, n_positives), np.int64), np.zeros((n, n_positives), np.int64)  # no window
    # least_percent * positive <= 100 * negative, in whole numbers
    low[no, place], high[no, place] = -(-least_percent * score[no, place] // 100), score[no, place]
    best = _pass(trees, queries | {"low": low, "high": high}, False, n_negatives)
    pairs = pa.table({"no": no, "w": place, "anchor_id": queries["id"][no], "positive_id": who[no, place], "positive_score": score[no, place]})
    named = spark.createDataFrame(pairs)
    return best.join(F.broadcast(named.withColumns({c: F.col(c).cast("long") for c in ("no", "w")})), ["no", "w"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))
