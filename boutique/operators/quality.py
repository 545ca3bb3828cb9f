"""Cluster quality scores (C6-C8, A11, A12) as DataFrame aggregates.

Points are ``(id, vector array<double>, label)``. Every pass over the
points is a grouped aggregate or a join to the k centroids (k bounded by the
clustering, checked before broadcast); the only k × k step runs on the
k-row centroid table.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boutique.functions.clean import distance, squared_distance
from boutique.operators import blocks
from boutique.operators.bounded import bounded_broadcast


def vector_dim(points: DataFrame, vec: str) -> int:
    """Vector width, read from one row."""
    row = points.select(F.size(vec).alias("d")).limit(1).first()
    return int(row["d"]) if row else 0


def centroids(points: DataFrame, vec: str, label: str, dim: int) -> DataFrame:
    """(label, n, centroid array<double>) — one partial+final aggregate.

    The vector mean is one typed aggregate (``Summarizer``) rather than one
    ``avg`` per dimension, so hundreds of dimensions do not blow up the
    generated code."""
    g = points.withColumn("_v", array_to_vector(F.col(vec))).groupBy(label).agg(
        F.count(F.lit(1)).alias("n"), Summarizer.mean(F.col("_v")).alias("_m"))
    return g.select(label, "n", vector_to_array(F.col("_m")).alias("centroid"))


def vector_mean(points: DataFrame, vec: str) -> list[float]:
    """Mean vector of all rows (one global aggregate; d numbers)."""
    row = points.select(Summarizer.mean(array_to_vector(F.col(vec))).alias("m")).first()
    return [float(v) for v in row["m"]]


def cluster_stats(points: DataFrame, vec: str, label: str, dim: int | None = None) -> DataFrame:
    """(label, n, centroid, spread = mean distance to the centroid,
    sse = sum of squared distances to it)."""
    dim = dim if dim is not None else vector_dim(points, vec)
    cents = centroids(points, vec, label, dim)
    small = bounded_broadcast(cents.select(label, "centroid"))
    j = points.select(label, vec).join(small, label)
    per = j.groupBy(label).agg(F.avg(distance(vec, "centroid")).alias("spread"),
                               F.sum(squared_distance(vec, "centroid")).alias("sse"))
    return cents.join(per, label)


def davies_bouldin_from_stats(st: DataFrame, label: str) -> DataFrame:
    """Davies–Bouldin from the k-row cluster table of :func:`cluster_stats`:
    executors compare their clusters with all k (one matrix row at a time)."""
    rows = st.select(label, "centroid", "spread").collect()
    labels = np.array([r[label] for r in rows])
    centres = np.array([r["centroid"] for r in rows], dtype=float)
    spreads = np.array([r["spread"] for r in rows], dtype=float)

    def worst(batches):
        for pdf in batches:
            out = []
            for one, c, s in zip(pdf["l"], pdf["c"], pdf["s"]):
                far = np.sqrt(((centres - np.asarray(c)) ** 2).sum(axis=1))
                ratio = np.divide(s + spreads, far, out=np.zeros(len(far)), where=(far > 0) & (labels != one))
                out.append(ratio.max())
            yield pd.DataFrame({"r": out})

    per = st.select(F.col(label).alias("l"), F.col("centroid").alias("c"), F.col("spread").alias("s"))
    return per.mapInPandas(worst, "r double").agg(F.round(F.avg("r"), 6).alias("davies_bouldin_score"))


def davies_bouldin(points: DataFrame, vec: str = "embedding", label: str = "label",
                   dim: int | None = None) -> DataFrame:
    """Mean over clusters of max_{j≠i} (s_i + s_j) / ‖c_i − c_j‖; a zero
    centroid distance contributes 0, as in the common library definition."""
    return davies_bouldin_from_stats(cluster_stats(points, vec, label, dim), label)


def calinski_from_stats(st: DataFrame, points: DataFrame, vec: str, dim: int) -> DataFrame:
    """Calinski–Harabasz from the cluster table and one global mean."""
    mean = F.lit(vector_mean(points, vec))
    per = st.select((F.col("n") * squared_distance("centroid", mean)).alias("between"),
                    "sse", "n")
    tot = per.agg(F.sum("between").alias("b"), F.sum("sse").alias("s"),
                  F.sum("n").alias("n"), F.count(F.lit(1)).alias("k"))
    score = F.when(F.col("s") == 0, F.lit(1.0)).otherwise(
        F.col("b") * (F.col("n") - F.col("k")) / (F.col("s") * (F.col("k") - 1)))
    return tot.select(F.round(score, 6).alias("calinski_harabasz_score"))


def calinski_harabasz(points: DataFrame, vec: str = "embedding", label: str = "label",
                      dim: int | None = None) -> DataFrame:
    """[Σ n_i‖c_i − c‖² / (k−1)] / [Σ‖x − c_label‖² / (n−k)]; 1.0 when the
    within-cluster sum is 0."""
    dim = dim if dim is not None else vector_dim(points, vec)
    return calinski_from_stats(cluster_stats(points, vec, label, dim), points, vec, dim)


def label_counts(points: DataFrame, label: str = "label") -> DataFrame:
    """Rows of each label (A11, W5); ``orderBy`` the count shows the largest first."""
    return points.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def noise_count(points: DataFrame, label: str = "label") -> DataFrame:
    """n_features = distinct labels other than -1; n_noise = rows at -1."""
    return points.agg(
        F.countDistinct(F.when(F.col(label) != -1, F.col(label))).cast("bigint").alias("n_features"),
        F.coalesce(F.sum((F.col(label) == -1).cast("bigint")), F.lit(0)).cast("bigint")
        .alias("n_noise"))


def sample_points(points: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """A repeatable sample of exactly min(n, N) rows (F9): the n smallest
    rows by the MD5 of seed and key. Spark keeps the n best per partition
    and merges those, so no task sees more than n × partitions rows."""
    h = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    return points.withColumn("_h", h).orderBy("_h", key).limit(n).drop("_h")


#: Rows of a block of :func:`silhouette`: two blocks and their distances fit a task.
SILHOUETTE_BLOCK = 2048


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    d = x @ y.T
    d *= -2.0
    d += (x * x).sum(axis=1)[:, None]
    d += (y * y).sum(axis=1)[None, :]
    return np.sqrt(np.maximum(d, 0.0, out=d), out=d)


def _label_sums(dist: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct labels of the columns, and each row's sum over the columns of a label."""
    order = np.argsort(label, kind="stable")
    first = np.flatnonzero(np.append(True, label[order][1:] != label[order][:-1]))
    return label[order][first], np.add.reduceat(dist[:, order], first, axis=1)


def _block_sums(pairs):
    """(k, label, other, s): each row's summed distance to the rows of every
    label of the other block; the distances of a pair of blocks serve both sides."""
    for batch in pairs:
        for one, two, same in zip(batch.column("data"), batch.column("other"), batch.column("same").to_pylist()):
            left, right = (blocks.from_bytes(t) for t in (one, two))
            dist = _distances(blocks.matrix(left.column("v")), blocks.matrix(right.column("v")))
            if same:
                np.fill_diagonal(dist, 0.0)
            for a, b, d in ((left, right, dist), (right, left, dist.T))[:1 if same else 2]:
                others, s = _label_sums(d, b.column("label").to_numpy())
                n, m = s.shape
                rows = pa.array(np.repeat(np.arange(n), m))
                yield pa.RecordBatch.from_arrays(
                    [a.column("k").combine_chunks().take(rows), a.column("label").combine_chunks().take(rows),
                     pa.array(np.tile(others, n)).cast(a.schema.field("label").type), pa.array(s.reshape(-1))],
                    names=["k", "label", "other", "s"])


def silhouette(points: DataFrame, key: str, vec: str = "embedding", label: str = "label",
               block: int = SILHOUETTE_BLOCK) -> DataFrame:
    """Exact Euclidean silhouette over every row.

    The score needs each row's mean distance to every cluster, which is
    quadratic work. Rows are cut into blocks by a hash of the key and packed; a
    triangular schedule takes every unordered pair of blocks once, and its distances
    give the partial sums of both sides, one per (row, label), never a pair
    of rows. Keys are distinct; rows without a label have no score."""
    pts = points.where(F.col(label).isNotNull()).select(
        F.col(key).alias("k"), F.col(label).alias("label"), F.col(vec).alias("v"))
    data, count = blocks.numbered(pts, "k", block)
    data = data.checkpoint(eager=True)
    left = data.select(F.col("block").alias("b"), F.col("packed").alias("data"),
                       F.explode(F.sequence(F.col("block"), F.lit(count - 1).cast("long"))).alias("c"))
    right = data.select(F.col("block").alias("c"), F.col("packed").alias("other"))
    pairs = left.join(right, "c").select("data", "other", (F.col("b") == F.col("c")).alias("same"))
    kind = dict(pts.dtypes)
    part = pairs.mapInArrow(_block_sums, f"k {kind['k']}, label {kind['label']}, other {kind['label']}, s double")
    sizes = pts.groupBy(F.col("label").alias("other")).agg(F.count("*").alias("n"))
    per = part.groupBy("k", "label", "other").agg(F.sum("s").alias("s")).join(sizes, "other")
    own = F.col("label") == F.col("other")
    ab = per.groupBy("k").agg(F.max(F.when(own, F.try_divide(F.col("s"), F.col("n") - 1))).alias("a"),
                              F.min(F.when(~own, F.col("s") / F.col("n"))).alias("b"))
    score = F.when(F.col("a").isNull() | F.col("b").isNull(), F.lit(0.0)).otherwise(
        F.coalesce(F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b")), F.lit(0.0)))
    return ab.agg(F.round(F.avg(score), 6).alias("silhouette_score"))


#: Distances that :func:`samples_scores` holds at once.
DISTANCES = 1 << 20


def sample_scores(x: np.ndarray, label: np.ndarray) -> tuple[float | None, float | None, float | None]:
    """(Davies-Bouldin, silhouette, Calinski-Harabasz) of a sample that a task
    holds; None for fewer than two clusters, or as many clusters as rows."""
    return samples_scores(x, [label])[0]


def samples_scores(x: np.ndarray, labels: list[np.ndarray]) -> list[tuple[float | None, float | None, float | None]]:
    """:func:`sample_scores` of several labelings, which share the distances of the rows."""
    n, out, open_ = len(x), [(None, None, None)] * len(labels), []
    for t, label in enumerate(labels):
        names, place = np.unique(label, return_inverse=True)
        if 2 <= len(names) < n:
            open_.append((t, place, np.bincount(place, minlength=len(names)).astype(float)))
    total = dict.fromkeys((t for t, *_ in open_), 0.0)
    joint, parts = _refinement([place for _, place, _ in open_])
    step = min(SILHOUETTE_BLOCK, max(1, DISTANCES // max(n, 1)))
    for at in range(0, n if open_ else 0, step):
        d = _distances(x[at:at + step], x)
        d[np.arange(len(d)), at + np.arange(len(d))] = 0.0
        if joint is not None:
            d = _row_sums(d, joint, len(parts[0]))
        for i, (t, place, size) in enumerate(open_):
            s = _row_sums(d, place if joint is None else parts[i], len(size))
            total[t] += _silhouettes(s, place[at:at + step], size)
    for t, place, size in open_:
        db, ch = _centre_scores(x, place, size)
        out[t] = db, round(float(total[t] / n), 6), ch
    return out


def _refinement(places: list[np.ndarray]) -> tuple[np.ndarray | None, list[np.ndarray]]:
    """The classes of rows that no labeling parts, and each labeling of these classes; no classes
    if they are nearly as many as rows. The cuts of one tree have no more than leaves."""
    if len(places) < 2:
        return None, []
    joint = places[0]
    for place in places[1:]:
        joint = np.unique(joint.astype(np.int64) * (place.max() + 1) + place, return_inverse=True)[1]
        if joint.max() + 1 > len(joint) // 4:
            return None, []
    first = np.unique(joint, return_index=True)[1]
    return joint, [place[first] for place in places]


def _row_sums(d: np.ndarray, place: np.ndarray, n: int) -> np.ndarray:
    """Each row's sums over the columns of every one of ``n`` labels."""
    return np.array([np.bincount(place, row, n) for row in d])


def _silhouettes(s: np.ndarray, own: np.ndarray, size: np.ndarray) -> float:
    """The sum of the silhouettes of rows of the clusters ``own``, whose distances to the rows of each cluster add up to ``s``."""
    rows = np.arange(len(s))
    a = np.divide(s[rows, own], size[own] - 1, out=np.zeros(len(s)), where=size[own] > 1)
    s = s / size[None, :]
    s[rows, own] = np.inf
    b = s.min(axis=1)
    top = np.maximum(a, b)
    return np.divide(b - a, top, out=np.zeros(len(s)), where=(top > 0) & (size[own] > 1)).sum()


def _centre_scores(x: np.ndarray, place: np.ndarray, size: np.ndarray) -> tuple[float, float]:
    """(Davies-Bouldin, Calinski-Harabasz) of one labeling of 2 clusters or more."""
    n, k = len(x), len(size)
    order = np.argsort(place, kind="stable")
    first = np.searchsorted(place[order], np.arange(k))
    centre = np.add.reduceat(x[order], first, axis=0) / size[:, None]
    off = x - centre[place]
    square = (off * off).sum(axis=1)
    spread = np.bincount(place, np.sqrt(square), k) / size
    apart = _distances(centre, centre)
    np.fill_diagonal(apart, 0.0)
    ratio = np.divide(spread[:, None] + spread[None, :], apart, out=np.zeros_like(apart), where=apart > 0)
    middle = centre - x.mean(axis=0)
    within = square.sum()
    between = (size * (middle * middle).sum(axis=1)).sum()
    ch = 1.0 if within == 0 else between * (n - k) / (within * (k - 1))
    return round(float(ratio.max(axis=1).mean()), 6), round(float(ch), 6)


#: Numbers of a right-hand block of :func:`scores_of_labelings`, and rows of a left-hand one.
LABELING_NUMBERS = 1 << 20
LABELING_ROWS = 512


def _labeling_sums(place: list[dict[int, int]], width: int, left: pa.Table, right: pa.Table) -> np.ndarray:
    """Each left row's summed distances to the right rows of every label of every labeling."""
    dist = _distances(blocks.matrix(left.column("v")), blocks.matrix(right.column("v")))
    _, i, j = np.intersect1d(left.column("id").to_numpy(), right.column("id").to_numpy(), return_indices=True)
    dist[i, j] = 0.0
    label = blocks.matrix(right.column("labels")).astype(np.int64)
    if width <= 32 * len(place):
        onehot = np.zeros((dist.shape[1], width))
        for t, at in enumerate(place):
            onehot[np.arange(len(onehot)), [at[v] for v in label[:, t].tolist()]] = 1.0
        return dist @ onehot
    sums = np.zeros((len(dist), width))
    for t, at in enumerate(place):
        low = min(at.values())
        sums[:, low:low + len(at)] = _row_sums(dist, np.array([at[v] for v in label[:, t].tolist()]) - low, len(at))
    return sums


def _labeling_silhouettes(place: list[dict[int, int]], size: np.ndarray, count: int):
    """(t, s): the sums of the silhouettes of each left block in each labeling. A block meets
    all ``count`` right blocks one after the other; only its own sums are held."""
    def done(left, sums):
        label, out = blocks.matrix(left.column("labels")).astype(np.int64), []
        for t, at in enumerate(place):
            low = min(at.values())
            own = np.array([at[v] for v in label[:, t].tolist()]) - low
            part = slice(low, low + len(at))
            out.append(float(_silhouettes(sums[:, part], own, size[part])) if len(at) > 1 else 0.0)
        return pa.RecordBatch.from_arrays([pa.array(range(len(out)), pa.int32()), pa.array(out, pa.float64())], names=["t", "s"])

    def run(batches):
        name, left, sums, met = None, None, 0.0, 0
        for batch in batches:
            for one, data, other in zip(batch.column("left").to_pylist(), batch.column("data"), batch.column("packed")):
                if one != name:
                    name, left, sums, met = one, blocks.from_bytes(data), 0.0, 0
                sums = sums + _labeling_sums(place, len(size), left, blocks.from_bytes(other))
                met += 1
                if met == count:
                    yield done(left, sums)
                    name = None
        if name is not None:
            raise RuntimeError("a block of rows did not meet all others in one task")
    return run


def scores_of_labelings(rows: DataFrame, ks: list[int]) -> DataFrame:
    """Davies-Bouldin, silhouette and Calinski-Harabasz of several labelings of the
    same ``rows`` (id, v, labels: one label for each of ``ks``), for all at once.

    The silhouette is quadratic work: blocks of rows meet blocks of rows, their distances
    serve every labeling, and a row keeps one sum for each cluster. The driver
    holds the cluster tables only."""
    spark = rows.sparkSession
    long = rows.select("v", F.posexplode("labels").alias("t", "label"))
    key = ["t", "label"]
    cents = long.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), Summarizer.mean(array_to_vector("v")).alias("m")).select(
        *key, "n", vector_to_array("m").alias("c")).checkpoint(eager=True)
    per = long.join(bounded_broadcast(cents.select(*key, "c")), key).groupBy(*key).agg(
        F.avg(distance("v", "c")).alias("spread"), F.sum(squared_distance("v", "c")).alias("sse"))
    table = cents.join(per, key).toPandas().sort_values(key, ignore_index=True)
    place = [{int(v): int(i) for i, v in zip(part.index, part["label"])} for t in range(len(ks)) for part in [table[table["t"] == t]]]
    size, dim = table["n"].to_numpy(float), vector_dim(rows, "v")
    schema = "k int, davies_bouldin_score double, silhouette_score double, calinski_harabasz_score double, n_features long, n_noise long"
    if not len(table):
        return spark.createDataFrame([], schema)
    pairs, count = blocks.streamed(rows, rows, "id", LABELING_ROWS, max(LABELING_ROWS, LABELING_NUMBERS // max(dim, 1)))
    total = {r["t"]: r["s"] for r in pairs.mapInArrow(_labeling_silhouettes(place, size, count), "t int, s double")
             .groupBy("t").agg(F.sum("s").alias("s")).collect()}
    out = []
    for t, k in enumerate(ks):
        part = table[table["t"] == t]
        n, c, m = int(part["n"].sum()), np.array(part["c"].tolist(), dtype=float), part["n"].to_numpy(float)
        db = si = ch = None
        if 2 <= len(part) < n:
            spread, worst = part["spread"].to_numpy(), []
            for i in range(len(c)):
                far = np.sqrt(((c - c[i]) ** 2).sum(axis=1))
                worst.append(np.divide(spread[i] + spread, far, out=np.zeros(len(far)), where=far > 0).max())
            middle = c - (m[:, None] * c).sum(axis=0) / n
            within = float(part["sse"].sum())
            between = float((m * (middle * middle).sum(axis=1)).sum())
            db, si = round(float(np.mean(worst)), 6), round(total[t] / n, 6)
            ch = round(1.0 if within == 0 else between * (n - len(c)) / (within * (len(c) - 1)), 6)
        noise = int(part.loc[part["label"] == -1, "n"].sum())
        out.append((k, db, si, ch, int((part["label"] != -1).sum()), noise))
    return spark.createDataFrame(out, schema)


def silhouette_squared(points: DataFrame, vec: str = "embedding", label: str = "label",
                       dim: int | None = None, max_clusters: int = 100_000) -> DataFrame:
    """Silhouette with squared Euclidean distance over all rows in O(n·k):
    mean squared distance to a cluster is ‖x‖² − 2 x·mean + mean(‖y‖²), so
    only per-cluster sums are needed (the measure Spark's
    ClusteringEvaluator reports). The k cluster summaries (bounded by
    ``max_clusters``) enter the row expression as literals."""
    dim = dim if dim is not None else vector_dim(points, vec)
    sqn = F.aggregate(vec, F.lit(0.0), lambda acc, v: acc + v * v)
    pts = points.select(label, vec, sqn.alias("_sq"))
    cents = centroids(pts, vec, label, dim)
    table = cents.join(pts.groupBy(label).agg(F.avg("_sq").alias("_msq")), label)
    rows = table.orderBy(label).limit(max_clusters + 1).collect()
    if len(rows) > max_clusters:
        raise ValueError("too many clusters for the O(n·k) silhouette")
    k = len(rows)
    labs = F.lit([r[label] for r in rows])
    ns = F.lit([float(r["n"]) for r in rows])
    cs = F.lit([[float(v) for v in r["centroid"]] for r in rows])
    ms = F.lit([float(r["_msq"]) for r in rows])
    seq = F.sequence(F.lit(0), F.lit(k - 1))
    dot = lambda c: F.aggregate(F.zip_with(F.col(vec), c, lambda a, b: a * b), F.lit(0.0),
                                lambda acc, v: acc + v)
    d = F.transform(seq, lambda i: F.col("_sq") - 2 * dot(cs[i]) + ms[i])
    own = F.array_position(labs, F.col(label)).cast("int") - 1
    j = pts.withColumn("_d", d).withColumn("_own", own)
    own_n = ns[F.col("_own")]
    a = F.col("_d")[F.col("_own")] * own_n / (own_n - 1)
    b = F.array_min(F.filter(F.transform(seq, lambda i: F.when(i != F.col("_own"), F.col("_d")[i])),
                             lambda x: x.isNotNull()))
    s = F.when(own_n <= 1, F.lit(0.0)).otherwise((b - a) / F.greatest(a, b))
    return j.select(s.alias("s")).agg(F.round(F.avg("s"), 6).alias("silhouette_squared"))


def histogram(points: DataFrame, vec: str, bins: int = 10) -> DataFrame:
    """Per-dimension histogram with ``bins`` equal-width bins between the
    dimension's min and max, the max falling in the last bin (X12).
    (dim, bin, n); the per-dimension bounds table has one row per dimension."""
    x = points.select(F.posexplode(vec).alias("dim", "v"))
    mm = x.groupBy("dim").agg(F.min("v").alias("mn"), F.max("v").alias("mx"))
    j = x.join(bounded_broadcast(mm), "dim")
    b = F.when(F.col("mx") == F.col("mn"), F.lit(0)).otherwise(
        F.least(F.floor((F.col("v") - F.col("mn")) / (F.col("mx") - F.col("mn")) * bins),
                F.lit(bins - 1)))
    return j.groupBy(F.col("dim").cast("bigint").alias("dim"), b.cast("bigint").alias("bin")).agg(
        F.count(F.lit(1)).alias("n"))
