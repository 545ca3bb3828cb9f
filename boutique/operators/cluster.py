"""k-means and sweeps over k.

k-means is Lloyd's steps over Spark partitions from fixed start rows, with exact sums:
a task sends one row of whole numbers per centre, added up on the executors. A fitted model is a table (cluster, centre); rows are assigned to
it by blocked matrix products, whatever its size.

A sweep fits and scores all rows for every k of a grid. Rows that a task can hold are one packed
block, and Spark spreads the k; larger tables are fitted and scored block by block, one k
after the other.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from boutique.functions.clean import squared_distance
from boutique.operators import blocks, quality, tree

MAX_CENTERS = 5000


def assign_nearest(points: DataFrame, vec: str, centers: list[list[float]],
                   out: str = "cluster") -> DataFrame:
    """Nearest center by squared distance, ties to the lowest index. The k
    centers (bounded by MAX_CENTERS) are one literal in the expression; see
    :func:`predict` for models of any size."""
    if len(centers) > MAX_CENTERS:
        raise ValueError("too many centers")
    cs = F.lit([[float(v) for v in c] for c in centers])
    d = F.transform(cs, lambda c: squared_distance(vec, c))
    return points.withColumn(out, (F.array_position(d, F.array_min(d)) - 1).cast("int"))


def _means(points: DataFrame, vec: str, label: str, dim: int) -> dict[int, list[float]]:
    rows = quality.centroids(points, vec, label, dim).collect()
    return {int(r[label]): [float(v) for v in r["centroid"]] for r in rows}


def lloyd(points: DataFrame, key: str, vec: str, k: int, steps: int) -> DataFrame:
    """k-means from fixed starting centers — the k rows with the smallest
    keys — for a fixed number of Lloyd steps (assign, re-average). A cluster
    that loses all rows keeps its previous center. Returns (key, cluster).

    Each step is one distributed aggregate; only the k centers travel to
    the driver."""
    dim = quality.vector_dim(points, vec)
    start = points.orderBy(key).limit(k).select(vec).collect()
    centers = [[float(v) for v in r[vec]] for r in start]
    pts = points.select(key, vec)
    for _ in range(steps):
        assigned = assign_nearest(pts, vec, centers)
        new = _means(assigned, vec, "cluster", dim)
        centers = [new.get(i, c) for i, c in enumerate(centers)]
    return assign_nearest(pts, vec, centers).select(key, "cluster")


#: Rows that a task adds up before it sends its sums: at 2**40 units each they stay below 2**62.
ROWS_AT_ONCE = 1 << 22


def unit_of(data: DataFrame, vec: str) -> float:
    """Vector entries are summed as whole multiples of this, so that a centre does
    not depend on the order of rows or the number of partitions: 2**-40 of the power of
    two that covers the largest entry (and at least one)."""
    size = F.abs(F.array_max(vec)), F.abs(F.array_min(vec))
    largest = data.agg(F.max(F.greatest(*size))).first()[0] or 0.0
    if not math.isfinite(largest):
        raise ValueError("a vector has an entry that is not finite")
    return 2.0 ** (max(0, math.ceil(math.log2(largest)) if largest else 0) - 40)


def _far(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Squared distances to the centres in whole 1e-9, each row's own square left out."""
    far = x @ (-2.0 * centers.T)
    far += (centers * centers).sum(axis=1)[None, :]
    far *= 1e9
    return np.rint(far, out=far)


def _nearest(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Nearest centre of each row, ties (to nine digits) to the lowest index."""
    return _far(x, centers).argmin(axis=1)


def _sums(vec: str, centers: np.ndarray, unit: float):
    """One task's sums of the rows next to each centre: (node, s), s the sums by dimension
    and the row count."""
    k, dim = centers.shape

    def entries(sums, sizes):
        used = np.flatnonzero(sizes)
        whole = np.column_stack((sums[used], sizes[used]))
        return pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array([s.tobytes() for s in whole], pa.binary())],
                                          names=["node", "s"])

    def run(batches):
        sums, sizes, seen = np.zeros((k, dim), np.int64), np.zeros(k, np.int64), 0
        for batch in batches:
            for data in batch.column("data"):
                x = blocks.matrix(blocks.from_bytes(data).column(vec))
                label = _nearest(x, centers)
                order = np.argsort(label, kind="stable")
                first = np.flatnonzero(np.diff(label[order], prepend=-1))
                whole = np.rint(x[order] / unit).astype(np.int64)
                sums[label[order][first]] += np.add.reduceat(whole, first, axis=0)
                sizes += np.bincount(label, minlength=k)
                seen += len(x)
                if seen >= ROWS_AT_ONCE:
                    yield entries(sums, sizes)
                    sums[:], sizes[:], seen = 0, 0, 0
        if seen:
            yield entries(sums, sizes)
    return run


def assign(points: DataFrame, key: str, vec: str, centers: np.ndarray) -> DataFrame:
    """(key, vec, cluster): the nearest centre of each row."""
    kinds = dict(points.dtypes)

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                label = _nearest(blocks.matrix(batch.column(vec)), centers)
                yield pa.RecordBatch.from_arrays([batch.column(key), batch.column(vec), pa.array(label, pa.int32())],
                                                 names=[key, vec, "cluster"])

    return points.select(key, vec).mapInArrow(run, f"`{key}` {kinds[key]}, `{vec}` {kinds[vec]}, cluster int")


def fit(rows: DataFrame, vec: str, centers: np.ndarray, unit: float, max_iter: int) -> np.ndarray:
    """Centres of Lloyd steps from ``centers`` over packed rows, until no row moves."""
    past = set()
    for _ in range(max_iter):
        used, high, low = blocks.add_up(rows.mapInArrow(_sums(vec, centers, unit), "node int, s binary"))
        whole = (high.astype(object) << 32) + low.astype(object)
        new = centers.copy()
        new[used] = whole[:, :-1].astype(float) / whole[:, -1:].astype(float) * unit
        # The same centres again: no row moved, or rows only swap between equally near ones.
        state = hashlib.blake2b(new.tobytes()).digest()
        if np.array_equal(new, centers) or state in past:
            return new
        past.add(state)
        centers = new
    raise RuntimeError(f"no convergence in {max_iter} steps")


#: Lloyd steps after which a fit is given up: 900,000 rows need over 600.
MAX_STEPS = 100_000


def kmeans(df: DataFrame, key: str, vec: str, k: int, seed: int,
           max_iter: int = MAX_STEPS) -> tuple[np.ndarray, DataFrame]:
    """k-means on every row (C1): (centres, rows with their cluster).

    Starts from the k rows with the smallest seeded key hashes and repeats
    Lloyd steps until no row moves; the result is the same for any layout
    of the rows. A step is one pass over packed rows; each task sends one row of sums per
    centre, and the driver keeps k centres. A centre without rows stays. Asking for more
    clusters than rows raises, and so do ``max_iter`` steps without an end, and
    entries that are not finite."""
    data = df.select(key, vec).checkpoint(eager=True)
    start = quality.sample_points(data, key, k, seed).collect()
    if len(start) < k:
        raise ValueError(f"{k} clusters of {len(start)} rows")
    if not start:
        return np.zeros((0, 0)), data.withColumn("cluster", F.lit(0))
    unit = unit_of(data, vec)
    # A task per core: a step is short, and tasks only stream their blocks.
    rows = blocks.packed(data.select(vec).coalesce(df.sparkSession.sparkContext.defaultParallelism)).checkpoint(eager=True)
    centers = fit(rows, vec, np.array([r[vec] for r in start], dtype=float), unit, max_iter)
    return centers, assign(data, key, vec, centers)


def model_table(spark, centers: np.ndarray) -> DataFrame:
    """A fitted model as a table (cluster, centre)."""
    return spark.createDataFrame([(i, [float(v) for v in c]) for i, c in enumerate(centers)],
                                 "cluster int, centre array<double>")


def predict(points: DataFrame, key: str, vec: str, model: DataFrame) -> DataFrame:
    """(key, cluster): the nearest centre of a model table for every row (C2),
    ties (to nine digits) to the lowest cluster. Row blocks meet centre blocks in matrix
    products; each pair of blocks gives one candidate per row. ``key`` is unique."""
    kind = dict(points.dtypes)[key]

    def work(left: pa.Table, right: pa.Table):
        right = right.sort_by("cluster")
        x, c = blocks.matrix(left.column(vec)), blocks.matrix(right.column("centre"))
        far = np.round((c * c).sum(axis=1)[None, :] - 2.0 * (x @ c.T), 9)
        best = far.argmin(axis=1)
        yield pa.RecordBatch.from_arrays(
            [left.column(key).combine_chunks(), pa.array(far[np.arange(len(x)), best]),
             right.column("cluster").combine_chunks().take(pa.array(best))], names=[key, "far", "cluster"])

    near = blocks.meet(points.select(key, vec), model.select("cluster", "centre"), "cluster", work,
                       f"`{key}` {kind}, far double, cluster int")
    return near.groupBy(key).agg(F.min(F.struct("far", "cluster")).alias("m")).select(key, F.col("m.cluster").alias("cluster"))


# ------------------------------------------------------------------ sweeps

SWEEP_SCHEMA = ("method string, k int, davies_bouldin_score double, silhouette_score double, "
                "calinski_harabasz_score double, n_features long, n_noise long")
#: Numbers (vectors, and distances to the largest k) of rows that one task fits.
TASK_NUMBERS = 1 << 24
#: Clusters of the labelings that are scored in one pass over the pairs of blocks.
PASS_CLUSTERS = 4096


#: Rows of a fit in one task that are measured at once.
FIT_ROWS = 1024


def _fit_sample(x: np.ndarray, k: int) -> np.ndarray:
    """k-means labels of the rows that a task holds, from the first k."""
    centers, label = x[:k].copy(), np.full(len(x), -1)
    # Some rows at a time: their distances stay in the cache.
    parts = [slice(at, at + FIT_ROWS) for at in range(0, len(x), FIT_ROWS)]
    far = np.empty((len(x), k))
    for part in parts:
        far[part] = _far(x[part], centers)
    for _ in range(MAX_STEPS):
        new = np.concatenate([far[part].argmin(axis=1) for part in parts])
        if np.array_equal(new, label):
            break
        label = new
        order = np.argsort(label, kind="stable")
        first = np.flatnonzero(np.diff(label[order], prepend=-1))
        sizes = np.diff(np.append(first, len(x)))
        before = centers.copy()
        centers[label[order][first]] = np.add.reduceat(x[order], first, axis=0) / sizes[:, None]
        # A centre that stays has the same distances.
        moved = np.flatnonzero((centers != before).any(axis=1))
        if len(moved):
            for part in parts:
                far[part, moved] = _far(x[part], centers[moved])
    return label


def _score_work(vec: str):
    """Scores of each row of the left block (method, k, names, labels) on the right block, which is all rows."""
    def work(left: pa.Table, right: pa.Table):
        right = right.sort_by("place")
        x, rows, labels = blocks.matrix(right.column(vec)), left.to_pylist(), []
        for r in rows:
            if r["method"] == "kmeans":
                labels.append(_fit_sample(x, r["k"]))
            elif r["names"]:
                of = dict(zip(r["names"], r["labels"]))
                labels.append(np.array([of[p] for p in right.column("name").to_pylist()]))
            else:
                labels.append(np.array(r["labels"]))
        for r, label, (db, si, ch) in zip(rows, labels, quality.samples_scores(x, labels)):
            noise = int((label == -1).sum())
            values = (r["method"], r["k"], db, si, ch, len(np.unique(label[label != -1])), noise)
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, (
                pa.string(), pa.int32(), pa.float64(), pa.float64(), pa.float64(), pa.int64(), pa.int64()))],
                names=["method", "k", "davies_bouldin_score", "silhouette_score", "calinski_harabasz_score", "n_features", "n_noise"])
    return work


#: Labelings that share the distances of the rows in one task: fits, and cuts of one tree.
FITS_AT_ONCE, CUTS_AT_ONCE = 16, 64

TASK_SCHEMA = "method string, k int, names array<string>, labels array<int>"


def _tasks(spark, rows: list, at_once: int) -> DataFrame:
    """``rows``, ``at_once`` to a partition; each has small and large k."""
    n = -(-len(rows) // at_once)
    return spark.createDataFrame(spark.sparkContext.parallelize([r for i in range(n) for r in rows[i::n]], n), TASK_SCHEMA)


def sweep(df: DataFrame, key: str, vec: str, ks: list[int], seed: int, sample: int | None = None,
          methods: tuple[str, ...] = ("kmeans",)) -> DataFrame:
    """Every row (or one repeatable ``sample``, F9), fitted for every k of the grid and scored on
    the same rows (C9, C10): a row per method and k. Values of k above the number of rows
    have no fit and no row. ``tree`` builds one divisive tree and cuts it at every k."""
    spark = df.sparkSession
    data = df.select(key, vec)
    data = (data if sample is None else quality.sample_points(data, key, sample, seed)).checkpoint(eager=True)
    n, dim = data.count(), quality.vector_dim(data, vec)
    ks = [k for k in ks if k <= n]
    grown, points, cuts = None, data.withColumn("grp", F.lit("all")), {}
    if "tree" in methods and ks:
        grown = tree.grow(points, key, vec, {"all": max(ks)})
        cuts = grown.cuts("all")
    # A tree may have fewer leaves than asked for: equal rows are never split.
    cut = [k for k in ks if k <= len(cuts)]
    fits = ks if "kmeans" in methods else []
    if not fits and not cut:
        return spark.createDataFrame([], SWEEP_SCHEMA)
    if n * (dim + max(ks)) > TASK_NUMBERS:
        return _sweep_blocks(data, key, vec, fits, seed, grown, points, cuts, cut)
    names = data.withColumn("name", F.lit(""))
    if grown is not None:
        names = grown.rows(points, key, vec, keep=[vec]).select(key, vec, F.col("path").alias("name"))
    leaves = sorted(cuts)
    parts = [_tasks(spark, rows, at_once) for rows, at_once in (
        ([("kmeans", k, [], []) for k in fits], FITS_AT_ONCE),
        ([("tree", k, leaves, [cuts[p][min(k, len(leaves)) - 1] for p in leaves]) for k in cut], CUTS_AT_ONCE)) if rows]
    tasks = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    seeded = F.concat(F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))), F.col(key).cast("string"))
    return blocks.meet(tasks, names.select(seeded.alias("place"), vec, "name"), "place", _score_work(vec), SWEEP_SCHEMA,
                       left_rows=max(FITS_AT_ONCE, CUTS_AT_ONCE), right_rows=n, broadcast_bytes=16 * TASK_NUMBERS)


def _by_clusters(ks: list[int]) -> list[list[int]]:
    """``ks`` in runs of up to PASS_CLUSTERS clusters."""
    out: list[list[int]] = []
    for k in ks:
        if out and sum(out[-1]) + k <= PASS_CLUSTERS:
            out[-1].append(k)
        else:
            out.append([k])
    return out


def _sweep_blocks(data: DataFrame, key: str, vec: str, fits: list[int], seed: int, grown, points: DataFrame,
                  cuts: dict[str, list[int]], cut: list[int]) -> DataFrame:
    """A sweep of more rows than a task holds: the steps of a fit are passes over all rows, and some labelings
    at a time are scored in common passes over the pairs of blocks of all rows."""
    spark, kind = data.sparkSession, dict(data.dtypes)[vec]
    out = []

    def score(rows: DataFrame, work, method: str, ks: list[int]) -> None:
        numbered = rows.withColumn("id", F.monotonically_increasing_id())
        kinds = dict(numbered.dtypes)
        labelled = numbered.select("id", F.col(vec).alias("v"), *[c for c in kinds if c not in ("id", vec)]).mapInArrow(
            work, f"id long, v {kind}, labels array<int>").checkpoint(eager=True)
        out.append(quality.scores_of_labelings(labelled, ks).select(F.lit(method).alias("method"), "*"))

    if fits:
        start = np.array([r[vec] for r in quality.sample_points(data, key, max(fits), seed).collect()], dtype=float)
        unit = unit_of(data, vec)
        rows = blocks.packed(data.select(vec).coalesce(spark.sparkContext.defaultParallelism)).checkpoint(eager=True)
        for ks in _by_clusters(fits):
            score(data.select(vec), _fit_labels([fit(rows, vec, start[:k], unit, MAX_STEPS) for k in ks]), "kmeans", ks)
    if cut:
        paths = grown.rows(points, key, vec, keep=[vec]).select(vec, "path").checkpoint(eager=True)
        for ks in _by_clusters(cut):
            score(paths, _cut_labels({p: [at[k - 1] for k in ks] for p, at in cuts.items()}), "tree", ks)
    every = out[0]
    for part in out[1:]:
        every = every.unionByName(part)
    return every


def _labelled(batch, labels: np.ndarray) -> pa.RecordBatch:
    ends = pa.array(np.arange(len(labels) + 1) * labels.shape[1], pa.int32())
    lists = pa.ListArray.from_arrays(ends, pa.array(labels.reshape(-1), pa.int32()))
    return pa.RecordBatch.from_arrays([batch.column("id"), batch.column("v"), lists], names=["id", "v", "labels"])


def _fit_labels(models: list[np.ndarray]):
    """(id, v, labels): the nearest centre of each row in every model."""
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                x = blocks.matrix(batch.column("v"))
                yield _labelled(batch, np.column_stack([_nearest(x, centers) for centers in models]))
    return run


def _cut_labels(numbers: dict[str, list[int]]):
    """(id, v, labels): the cluster of each row's leaf in every cut."""
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield _labelled(batch, np.array([numbers[p] for p in batch.column("path").to_pylist()]))
    return run


def score_labels(points: DataFrame, key: str, vec: str, labels: DataFrame) -> DataFrame:
    """The scores of given labels (k, key, label) on every row, for every k at
    once. Every k labels every row; repeated keys are matched in order. No task
    holds more than two blocks of rows (:func:`quality.scores_of_labelings`)."""
    name = F.col(key).cast("string").alias("p")
    nth = lambda *by: F.row_number().over(Window.partitionBy(*by[:-1]).orderBy(by[-1]))
    rows = points.select(name, F.col(vec).alias("v")).withColumn("o", nth("p", F.xxhash64("v")))
    lists = (labels.select(F.col("k").cast("int").alias("k"), name, F.col("label").cast("int").alias("label"))
             .where("label is not null").withColumn("o", nth("k", "p", F.col("label")))
             .groupBy(F.col("p").alias("q"), F.col("o").alias("r"))
             .agg(F.array_sort(F.collect_list(F.struct("k", "label"))).alias("l")))
    ks = sorted(int(r["k"]) for r in labels.select("k").distinct().collect())
    both = rows.join(lists, F.col("p").eqNullSafe(F.col("q")) & (F.col("o") == F.col("r"))).select(
        F.monotonically_increasing_id().alias("id"), "v", F.transform("l", lambda s: s["label"]).alias("labels"))
    scores = quality.scores_of_labelings(both.checkpoint(eager=True), ks)
    return scores.select(F.lit("given").alias("method"), "*")


def best_k(sweep_table: DataFrame, metric: str = "silhouette_score", higher: bool = True) -> DataFrame:
    """The sweep row with the best score (C10); ties go to the smaller k."""
    order = F.desc(metric) if higher else F.asc(metric)
    return sweep_table.filter(F.col(metric).isNotNull()).orderBy(order, "k").limit(1)
