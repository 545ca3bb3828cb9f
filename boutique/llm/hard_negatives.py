"""Hard negatives of anchors, found in STR-packed R-trees by inner product.

Rows are integer vectors with an id and a label. An anchor's positives are its
``WANTED`` best other rows of its label; for each positive, the negatives are the
``WANTED`` best rows of other labels whose score lies in a window below the positive's.

1. Sort-tile-recursive packing: rows are range-partitioned by label and leading
   coordinates, tiled inside a task by label and the coordinates with the widest
   spread, and cut into leaves of ``LEAF`` rows with a minimum bounding box. The leaves are
   written once; every search reads them.
2. A task stacks boxes of ``FANOUT`` children over its leaves. For an anchor, each
   coordinate of a box gives an interval of products, their sum an interval of scores.
3. A best-first queue opens the box with the highest upper bound. It leaves out boxes
   without a fitting label, boxes outside the score window, and boxes strictly below
   the ``WANTED``-th score so far (an equal bound may still win by a smaller id). A box
   carries the anchors that still need it, so bounds and scores are matrix products.
4. Each task gives at most ``WANTED`` rows per search; a window merges them.

Anchors are taken ``ANCHORS`` at a time (by a hash, so blocks are even), each block in one
pass for positives and one for negatives over all leaves; only a block is on the driver.

Rows with a null label or vector, or a null or non-finite component, take no part.
Components beyond 2**26 count as 2**26, so that scores stay in 64 bits. Rows of another
vector length than the anchor's have no score with it. Equal rows count as often as they
come, as candidates and as anchors. A row without an id is no anchor; as a candidate
it comes last among equal scores. An empty table gives no rows.
"""

from __future__ import annotations

import heapq
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from boutique.llm.common import scratch_path, written

WANTED = 5
LEAF = 32
FANOUT = 16
#: Anchors searched at once; each has WANTED windows.
ANCHORS = 4096
#: Searches that share a queue.
TOGETHER = 512
#: Coordinates that tile the rows of a task after the label.
TILE_AXES = 3
#: Leaves held by a task at once.
LEAVES = 512
LARGEST = 1 << 26
#: Stands for a missing id inside tasks: after all others.
NO_ID = np.iinfo(np.int64).max

SCHEMA = ("anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
LEAF_SCHEMA = "dim int, n int, ids binary, labels binary, copies binary, vectors binary"
FOUND_SCHEMA = "q int, score long, id long"


def vectors(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
            scale: int = 256) -> DataFrame:
    """(id, label, v, copies): the distinct rows that take part, components floor(scale * x)."""
    real = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    whole = F.transform(vector_col, lambda x: F.greatest(F.least(
        F.floor(F.lit(scale) * x.cast("double")), F.lit(LARGEST)), F.lit(-LARGEST)).cast("int"))
    rows = table.where(F.col(label_col).isNotNull() & F.col(vector_col).isNotNull() & real).select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), whole.alias("v"))
    return rows.groupBy("id", "label", "v").agg(F.count("*").alias("copies"))


def str_order(label: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Sort-tile-recursive order of rows: by label, then in slabs along the
    coordinates of the widest spread."""
    n = len(label)
    if not v.shape[1]:
        return np.argsort(label, kind="stable")
    axes = np.argsort(-v.std(axis=0), kind="stable")[:TILE_AXES]
    order = np.lexsort((v[:, axes[0]], label))
    slab = np.zeros(n, np.int64)
    for k in range(1, len(axes)):
        slabs = max(1, round((n / LEAF) ** (1 / len(axes))))
        # Rows of a slab stay together: equal shares of the present order inside each old slab.
        start = np.flatnonzero(np.diff(slab, prepend=-1))
        size = np.diff(np.append(start, n))
        place = np.arange(n) - np.repeat(start, size)
        slab = slab * slabs + place * slabs // np.repeat(size, size)
        order = order[np.lexsort((v[order, axes[k]], label[order], slab))]
    return order


def _pack(batches):
    for batch in batches:
        ids = batch.column("id").fill_null(int(NO_ID)).to_numpy(zero_copy_only=False)
        label, copies = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("label", "copies"))
        lists = batch.column("v")
        dims = np.diff(lists.offsets.to_numpy(zero_copy_only=False))
        flat = lists.values.to_numpy(zero_copy_only=False)
        start = lists.offsets.to_numpy(zero_copy_only=False)[:-1]
        for dim in np.unique(dims):
            at = np.flatnonzero(dims == dim)
            v = flat[start[at][:, None] + np.arange(dim)[None, :]].astype(np.int32)
            at_order = str_order(label[at], v)
            v, at = v[at_order], at[at_order]
            leaves = [slice(i, i + LEAF) for i in range(0, len(at), LEAF)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(dim)] * len(leaves), pa.int32()), pa.array([len(at[s]) for s in leaves], pa.int32())]
                + [pa.array([x[s].astype(t).tobytes() for s in leaves], pa.binary())
                   for x, t in ((ids[at], np.int64), (label[at], np.int64), (copies[at], np.int64), (v, np.int32))],
                names=["dim", "n", "ids", "labels", "copies", "vectors"])


def pack(rows: DataFrame) -> DataFrame:
    """Leaves of ``rows`` (id, label, v, copies). Equal keys are split by id, so
    one label or one common vector fills many partitions."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lead = [F.try_element_at("v", F.lit(i)) for i in (1, 2)]
    placed = rows.repartitionByRange(parts, F.size("v"), "label", *lead, "id")
    return written(placed.mapInArrow(_pack, LEAF_SCHEMA), "leaves")


class Tree:
    """Boxes over consecutive leaves of one vector length, from the leaves up."""

    def __init__(self, n, ids, labels, copies, v):
        self.ids, self.labels, self.copies, self.v = ids, labels, copies, v
        self.first = np.concatenate(([0], np.cumsum(n)))
        start = self.first[:-1]
        self.levels = [tuple(f.reduceat(x, start) for f, x in (
            (np.minimum, v), (np.maximum, v), (np.minimum, labels), (np.maximum, labels)))]
        while len(self.levels[-1][0]) > 1:
            low, high, least, most = self.levels[-1]
            start = np.arange(0, len(low), FANOUT)
            self.levels.append((np.minimum.reduceat(low, start), np.maximum.reduceat(high, start),
                                np.minimum.reduceat(least, start), np.maximum.reduceat(most, start)))


class Search:
    """Searches of one vector length with their best rows so far. ``same`` looks
    for the anchor's label, else for the others. Scores stay in [low, high]."""

    def __init__(self, number, ids, labels, v, same: bool, low=None, high=None):
        # Sums of products of at most LARGEST: doubles are exact up to 2**53, else 64-bit integers.
        self.number, self.ids, self.labels, self.same = number, ids, labels, same
        self.v = v
        n = len(ids)
        self.low = np.full(n, np.iinfo(np.int64).min) if low is None else low
        self.high = np.full(n, np.iinfo(np.int64).max) if high is None else high
        self.best = np.full((n, WANTED), np.iinfo(np.int64).min)
        self.best_id = np.full((n, WANTED), NO_ID)
        self.held = np.zeros(n, np.int64)

    def bar(self) -> np.ndarray:
        """The least score that can still matter, for each search."""
        return np.maximum(self.low, np.where(self.held == WANTED, self.best[:, -1], self.low))

    def run(self, tree: Tree) -> None:
        largest = max(int(np.abs(tree.v).max(initial=0)), 1) * max(int(np.abs(self.v).max(initial=0)), 1)
        kind = np.float64 if largest * max(1, self.v.shape[1]) < 1 << 53 else np.int64
        q = self.v.astype(kind)
        plus, minus = np.maximum(q, 0), np.minimum(q, 0)
        top, tick = len(tree.levels) - 1, count()
        queue: list = []

        def push(level: int, boxes: slice, who: np.ndarray) -> None:
            low, high, least, most = (x[boxes] for x in tree.levels[level])
            low, high = low.astype(kind).T, high.astype(kind).T
            upper = (plus[who] @ high + minus[who] @ low).astype(np.int64)
            lower = (plus[who] @ low + minus[who] @ high).astype(np.int64)
            own = self.labels[who][:, None]
            fits = (least <= own) & (own <= most) if self.same else (least != own) | (most != own)
            fits &= (upper >= self.bar()[who][:, None]) & (lower <= self.high[who][:, None])
            for i in np.flatnonzero(fits.any(axis=0)):
                some = np.flatnonzero(fits[:, i])
                heapq.heappush(queue, (-int(upper[some, i].max()), next(tick), level, boxes.start + int(i),
                                       who[some], upper[some, i]))

        push(top, slice(0, len(tree.levels[top][0])), np.arange(len(q)))
        while queue:
            _, _, level, box, who, upper = heapq.heappop(queue)
            who = who[upper >= self.bar()[who]]
            if not len(who):
                continue
            if level:
                push(level - 1, slice(box * FANOUT, min((box + 1) * FANOUT, len(tree.levels[level - 1][0]))), who)
            else:
                self.leaf(tree, slice(tree.first[box], tree.first[box + 1]), who, q, kind)

    def leaf(self, tree: Tree, rows: slice, who: np.ndarray, q: np.ndarray, kind) -> None:
        scores = (q[who] @ tree.v[rows].astype(kind).T).astype(np.int64)
        label, ids, copies = tree.labels[rows], tree.ids[rows], tree.copies[rows]
        alike = self.labels[who][:, None] == label[None, :]
        fits = (alike if self.same else ~alike) & (scores >= self.bar()[who][:, None]) & (scores <= self.high[who][:, None])
        a, r = np.nonzero(fits)
        if not len(a):
            return
        times = np.minimum(copies[r], WANTED + 1)
        if self.same:  # the anchor's own row is no candidate, other copies of it are
            itself = np.flatnonzero(self.ids[who[a]] == ids[r])
            itself = itself[(self.v[who[a[itself]]] == tree.v[rows][r[itself]]).all(axis=1)]
            times[itself] -= 1
        a, r = np.repeat(a, times), np.repeat(r, times)
        self.merge(who[a], scores[a, r] if len(a) else np.zeros(0, np.int64), ids[r])

    def merge(self, who: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(who):
            return
        touched = np.unique(who)
        old = np.arange(WANTED)[None, :] < self.held[touched][:, None]
        who = np.concatenate([np.repeat(touched, self.held[touched]), who])
        score = np.concatenate([self.best[touched][old], score])
        ids = np.concatenate([self.best_id[touched][old], ids])
        order = np.lexsort((ids, -score, who))
        who, score, ids = who[order], score[order], ids[order]
        start = np.searchsorted(who, touched)
        place = np.arange(len(who)) - np.repeat(start, np.diff(np.append(start, len(who))))
        keep = place < WANTED
        self.best[who[keep], place[keep]] = score[keep]
        self.best_id[who[keep], place[keep]] = ids[keep]
        self.held[touched] = np.minimum(np.bincount(np.searchsorted(touched, who), minlength=len(touched)), WANTED)

    def found(self):
        who, place = np.nonzero(np.arange(WANTED)[None, :] < self.held[:, None])
        ids = self.best_id[who, place]
        return self.number[who], self.best[who, place], pa.array(ids, pa.int64(), mask=ids == NO_ID)


def _trees(batch, dims):
    """(dim, tree) over up to LEAVES leaves of a batch."""
    dim_of = batch.column("dim").to_numpy(zero_copy_only=False)
    for dim in dims:
        at = np.flatnonzero(dim_of == dim)
        for i in range(0, len(at), LEAVES):
            some = batch.take(pa.array(at[i:i + LEAVES]))
            n = some.column("n").to_numpy(zero_copy_only=False)
            ids, label, copies, v = (
                np.frombuffer(b"".join(x.as_py() for x in some.column(c)), t)
                for c, t in (("ids", np.int64), ("labels", np.int64), ("copies", np.int64), ("vectors", np.int32)))
            yield dim, Tree(n, ids, label, copies, v.reshape(len(ids), dim))


def _searching(queries: list[tuple], same: bool):
    """``queries``: tuples of arrays (number, ids, labels, vectors, low, high),
    one for each vector length and at most TOGETHER searches."""
    def run(batches):
        searches: dict[int, list[Search]] = {}
        for number, ids, label, v, low, high in queries:
            searches.setdefault(v.shape[1], []).append(Search(number, ids, label, v, same, low, high))
        for batch in batches:
            for dim, tree in _trees(batch, searches):
                for s in searches[dim]:
                    s.run(tree)
        for s in (s for some in searches.values() for s in some):
            number, score, ids = s.found()
            yield pa.RecordBatch.from_arrays([pa.array(number, pa.int32()), pa.array(score, pa.int64()), ids],
                                             names=["q", "score", "id"])
    return run


def _best(found: DataFrame) -> DataFrame:
    """Merge of the tasks' rows: (q, score, id, place)."""
    order = Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= WANTED)


def _queries(anchors: list, windows: list[tuple[int, int, int]] | None = None) -> list[tuple]:
    """Searches of the collected ``anchors``, grouped by vector length. A window is
    (place of the anchor, low, high); without windows each anchor has one search."""
    plan = [(i, None, None) for i in range(len(anchors))] if windows is None else windows
    by_dim: dict[int, list[int]] = {}
    for q, (i, _, _) in enumerate(plan):
        by_dim.setdefault(len(anchors[i]["v"]), []).append(q)
    out = []
    for dim, qs in sorted(by_dim.items()):
        for at in range(0, len(qs), TOGETHER):
            some = qs[at:at + TOGETHER]
            own = [anchors[plan[q][0]] for q in some]
            low, high = (None if windows is None else np.array([plan[q][k] for q in some], np.int64) for k in (1, 2))
            out.append((np.array(some, np.int32), np.array([a["id"] for a in own], np.int64),
                        np.array([a["label"] for a in own], np.int64),
                        np.array([a["v"] for a in own], np.int64).reshape(len(own), dim), low, high))
    return out


def mine(rows: DataFrame, is_anchor: Column, least_percent: int = 80, most_percent: int = 100) -> DataFrame:
    """Hard negatives (``SCHEMA``) of the rows of ``rows`` (as by ``vectors``) that
    ``is_anchor`` marks: negatives with least_percent * positive_score <= 100 *
    negative_score <= most_percent * positive_score."""
    spark = rows.sparkSession
    rows = written(rows, "vectors")
    leaves = pack(rows)
    anchors = rows.where(F.col("id").isNotNull() & is_anchor)
    blocks = -(-anchors.count() // ANCHORS)
    anchors = written(anchors.withColumn("block", F.pmod(F.xxhash64("id", "label", "v"), F.lit(max(blocks, 1)))), "anchors")
    out = scratch_path(spark, "negatives")
    for b in range(blocks):
        some = anchors.where(F.col("block") == b).collect()
        first = _best(leaves.mapInArrow(_searching(_queries(some), True), FOUND_SCHEMA)).collect()
        windows, place = [], {}
        for r in first:
            low, high = -(-least_percent * r["score"] // 100), most_percent * r["score"] // 100
            if low <= high and (r["q"], low, high) not in place:
                place[r["q"], low, high] = len(windows)
                windows.append((r["q"], low, high))
        pairs = [(place[key], some[r["q"]]["id"], some[r["q"]]["copies"], r["id"], r["score"]) for r in first
                 if (key := (r["q"], -(-least_percent * r["score"] // 100), most_percent * r["score"] // 100)) in place]
        if not pairs:
            continue
        found = _best(leaves.mapInArrow(_searching(_queries(some, windows), False), FOUND_SCHEMA))
        positives = spark.createDataFrame(pairs, "q int, anchor_id long, copies long, positive_id long, positive_score long")
        positives = positives.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
        (found.join(positives, "q")
         .select("anchor_id", "positive_id", F.col("place").cast("int").alias("rank"), F.col("id").alias("negative_id"),
                 "positive_score", F.col("score").alias("negative_score"))
         .write.mode("append").parquet(out))
    if not blocks:
        return spark.createDataFrame([], SCHEMA)
    spark.createDataFrame([], SCHEMA).write.mode("append").parquet(out)
    return spark.read.schema(SCHEMA).parquet(out)


def hard_negatives(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                   anchor_every: int = 100, **windows) -> DataFrame:
    """Hard negatives of every row whose id is divisible by ``anchor_every``."""
    rows = vectors(table.select(id_col, vector_col, label_col), id_col, vector_col, label_col)
    return mine(rows, F.col("id") % anchor_every == 0, **windows)


def relabelled(table: DataFrame) -> DataFrame:
    """``embeddings`` with the label (label + 1) % 10 where vec_id is divisible by 7."""
    return table.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))


HARD_NEGATIVES_SQL = """
WITH r AS (
  SELECT row_number() OVER () AS k, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.k AS ak, a.vec_id AS anchor_id, b.vec_id, b.label = a.label AS same,
         CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM r a JOIN r b ON a.k <> b.k WHERE a.vec_id % 100 = 0),
p AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ak ORDER BY score DESC, vec_id) AS pr FROM s WHERE same)
  WHERE pr <= 5),
n AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.ak, p.pr ORDER BY s.score DESC, s.vec_id) AS rank
  FROM p JOIN s ON s.ak = p.ak AND NOT s.same AND 100 * s.score BETWEEN 80 * p.score AND 100 * p.score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM n WHERE rank <= 5
"""
