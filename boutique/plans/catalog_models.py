"""Queries of steps 5-6: cluster quality, clustering, regression, scoring
and evaluation."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from boutique import params
from boutique import sources as src
from boutique.operators import cluster, encode, model, quality, score, tree
from boutique.operators import customers as cust
from boutique.operators import prefs
from boutique.plans import retail as R
from boutique.plans.catalog import register
from boutique.plans.oracle import q
from boutique.sources.tables import kept

P = params
LLOYD_K = 10
LLOYD_STEPS = 2
HIST_BINS = 10
KMEANS_K_ALL = 210          # final k-means fit on all preferences
TREE_K = 165                # clusters of the final agglomerative fits per segment
FIT_SAMPLE = 20000          # rows of the fit whose model is applied to all
SWEEP_KS = [10, 20, 30]     # a short grid beside the surveyed ones (sweep_*)

SQ = "list_sum(list_transform(list_zip({a}, {b}), lambda x: (x[1] - x[2]) * (x[1] - x[2])))"

# ------------------------------------------------------------------ step 5: quality

_CENT_SQL = """
cent AS (SELECT label, list(m ORDER BY i) AS c FROM (
    SELECT label, i, avg(v) AS m FROM (
        SELECT label, unnest(generate_series(1, len(embedding))) AS i, unnest(embedding) AS v FROM embeds)
    GROUP BY label, i) GROUP BY label),
sizes AS (SELECT label, count(*) AS n FROM embeds GROUP BY label)"""


@register("quality_davies_bouldin", q(f""", {_CENT_SQL},
spread AS (SELECT e.label, avg(list_distance(e.embedding, c.c)) AS s
           FROM embeds e JOIN cent c ON e.label = c.label GROUP BY e.label),
pairs AS (SELECT a.label, max(CASE WHEN list_distance(a.c, b.c) = 0 THEN 0.0
                                   ELSE (sa.s + sb.s) / list_distance(a.c, b.c) END) AS r
          FROM cent a JOIN cent b ON a.label <> b.label
          JOIN spread sa ON sa.label = a.label JOIN spread sb ON sb.label = b.label
          GROUP BY a.label)
SELECT round(avg(r), 6) AS davies_bouldin_score FROM pairs"""))
def quality_davies_bouldin(spark, d):
    return quality.davies_bouldin(src.embeddings(spark, d), "embedding", "label")


@register("quality_calinski", q(f""", {_CENT_SQL},
mean AS (SELECT list(m ORDER BY i) AS c FROM (
    SELECT i, avg(v) AS m FROM (
        SELECT unnest(generate_series(1, len(embedding))) AS i, unnest(embedding) AS v FROM embeds)
    GROUP BY i)),
b AS (SELECT sum(z.n * {SQ.format(a="c.c", b="mean.c")}) AS b, count(*) AS k, sum(z.n) AS n
      FROM cent c JOIN sizes z ON c.label = z.label, mean),
w AS (SELECT sum({SQ.format(a="e.embedding", b="c.c")}) AS s FROM embeds e JOIN cent c ON e.label = c.label)
SELECT round(CASE WHEN w.s = 0 THEN 1.0 ELSE b.b * (b.n - b.k) / (w.s * (b.k - 1)) END, 6)
       AS calinski_harabasz_score FROM b, w"""))
def quality_calinski(spark, d):
    return quality.calinski_harabasz(src.embeddings(spark, d), "embedding", "label")


def _silhouette_sql(dist: str, name: str) -> str:
    return q(f""",
d AS (SELECT a.vec_id, a.label AS la, b.label AS lb, {dist} AS dist
      FROM embeds a JOIN embeds b ON a.vec_id <> b.vec_id),
per AS (SELECT vec_id, la, lb, sum(dist) / count(*) AS m FROM d GROUP BY 1, 2, 3),
ab AS (SELECT vec_id, max(CASE WHEN lb = la THEN m END) AS a, min(CASE WHEN lb <> la THEN m END) AS b
       FROM per GROUP BY vec_id)
SELECT round(avg(CASE WHEN a IS NULL THEN 0.0 ELSE (b - a) / greatest(a, b) END), 6) AS {name}
FROM embeds e LEFT JOIN ab ON e.vec_id = ab.vec_id""")


@register("quality_silhouette", _silhouette_sql("list_distance(a.embedding, b.embedding)",
                                                "silhouette_score"))
def quality_silhouette(spark, d):
    return quality.silhouette(src.embeddings(spark, d), "vec_id", "embedding", "label")


@register("quality_silhouette_squared", _silhouette_sql(SQ.format(a="a.embedding", b="b.embedding"),
                                                        "silhouette_squared"))
def quality_silhouette_squared(spark, d):
    return quality.silhouette_squared(src.embeddings(spark, d), "embedding", "label")


@register("label_counts", q("""
SELECT label, count(*) AS n FROM embeds WHERE label IS NOT NULL GROUP BY label"""))
def label_counts(spark, d):
    return quality.label_counts(src.embeddings(spark, d), "label")


@register("noise_count", q("""
SELECT CAST(count(DISTINCT CASE WHEN label <> -1 THEN label END) AS BIGINT) AS n_features,
       CAST(coalesce(sum(CASE WHEN label = -1 THEN 1 ELSE 0 END), 0) AS BIGINT) AS n_noise
FROM embeds"""))
def noise_count(spark, d):
    return quality.noise_count(src.embeddings(spark, d), "label")


def _assign_sql(c: str) -> str:
    return (f"SELECT vec_id, cluster FROM (SELECT p.vec_id, c.cluster, row_number() OVER "
            f"(PARTITION BY p.vec_id ORDER BY {SQ.format(a='p.e', b='c.e')}, c.cluster) AS rn "
            f"FROM pts p CROSS JOIN {c} c) WHERE rn = 1")


def _update_sql(a: str, c: str) -> str:
    return (f"SELECT c.cluster, coalesce(n.e, c.e) AS e FROM {c} c LEFT JOIN ("
            f"SELECT cluster, list(m ORDER BY i) AS e FROM (SELECT cluster, i, avg(v) AS m FROM ("
            f"SELECT a.cluster, unnest(generate_series(1, len(p.e))) AS i, unnest(p.e) AS v "
            f"FROM {a} a JOIN pts p ON a.vec_id = p.vec_id) GROUP BY cluster, i) GROUP BY cluster) n "
            f"ON c.cluster = n.cluster")


def _lloyd_sql() -> str:
    parts = ["pts AS (SELECT vec_id, embedding AS e FROM embeds)",
             f"c0 AS (SELECT CAST(row_number() OVER (ORDER BY vec_id) - 1 AS INTEGER) AS cluster, e "
             f"FROM (SELECT * FROM pts ORDER BY vec_id LIMIT {LLOYD_K}))"]
    for s in range(LLOYD_STEPS):
        parts.append(f"a{s} AS ({_assign_sql(f'c{s}')})")
        parts.append(f"c{s + 1} AS ({_update_sql(f'a{s}', f'c{s}')})")
    parts.append(f"a{LLOYD_STEPS} AS ({_assign_sql(f'c{LLOYD_STEPS}')})")
    return q(", " + ",\n".join(parts) + f"\nSELECT vec_id, cluster FROM a{LLOYD_STEPS}")


@register("kmeans_lloyd_fixed", _lloyd_sql())
def kmeans_lloyd_fixed(spark, d):
    return cluster.lloyd(src.embeddings(spark, d), "vec_id", "embedding", LLOYD_K, LLOYD_STEPS)


@register("feature_histogram", q(f""",
x AS (SELECT vec_id, unnest(generate_series(0, len(embedding) - 1)) AS dim, unnest(embedding) AS v
      FROM embeds),
mm AS (SELECT dim, min(v) AS mn, max(v) AS mx FROM x GROUP BY dim)
SELECT CAST(x.dim AS BIGINT) AS dim,
       CAST(CASE WHEN mm.mx = mm.mn THEN 0
                 ELSE least(floor((x.v - mm.mn) / (mm.mx - mm.mn) * {HIST_BINS}), {HIST_BINS - 1}) END
            AS BIGINT) AS bin,
       count(*) AS n
FROM x JOIN mm ON x.dim = mm.dim GROUP BY 1, 2"""))
def feature_histogram(spark, d):
    return quality.histogram(src.embeddings(spark, d), "embedding", HIST_BINS)


# ------------------------------------------------------------------ step 5: clustering


@register("sample_fixed", q(f"""
SELECT customer_id FROM (SELECT DISTINCT customer_id FROM pshares)
ORDER BY md5('{P.SEED}:' || customer_id), customer_id LIMIT {P.CLUSTER_SAMPLE}"""))
def sample_fixed(spark, d):
    """The sample of one sweep: its size is the feature."""
    customers = R.shares(spark, d).select("customer_id").distinct()
    return quality.sample_points(customers, "customer_id", P.CLUSTER_SAMPLE, P.SEED)


SMALL_SAMPLE = 100


@register("sample_small", q(f"""
SELECT customer_id FROM (SELECT DISTINCT customer_id FROM pshares)
ORDER BY md5('{P.SEED}:' || customer_id), customer_id LIMIT {SMALL_SAMPLE}"""))
def sample_small(spark, d):
    """A sample with fewer rows than any given table has customers."""
    customers = R.shares(spark, d).select("customer_id").distinct()
    return quality.sample_points(customers, "customer_id", SMALL_SAMPLE, P.SEED)


def _kmeans_all(spark, d):
    """The final fit; a table with fewer rows has one cluster for each."""
    vecs = _segment_vectors(spark, d, "full")
    return cluster.kmeans(vecs, "customer_id", "prefs", min(KMEANS_K_ALL, vecs.count()), P.SEED)


@register("kmeans_fit")
def kmeans_fit(spark, d):
    return _kmeans_all(spark, d)[1].select("customer_id", "cluster")


@register("kmeans_conditions", q("""
SELECT customer_id, true AS nearest FROM (SELECT DISTINCT customer_id FROM pshares)"""))
def kmeans_conditions(spark, d):
    """Whether each row's own cluster mean, averaged anew from its rows, is
    the closest of all cluster means."""
    _, rows = _kmeans_all(spark, d)
    rows = rows.checkpoint(eager=True)
    means = quality.centroids(rows, "prefs", "cluster", 0).collect()
    labels, mat = np.array([r["cluster"] for r in means]), np.array([r["centroid"] for r in means])

    def check(batches):
        for pdf in batches:
            if len(pdf):
                x = np.vstack(pdf["prefs"].to_numpy())
                far = ((x * x).sum(axis=1)[:, None] + (mat * mat).sum(axis=1)[None, :] - 2 * x @ mat.T)
                own = far[labels[None, :] == pdf["cluster"].to_numpy()[:, None]]
                yield pd.DataFrame({"customer_id": pdf["customer_id"], "nearest": own <= far.min(axis=1) + 1e-8})

    kind = dict(rows.dtypes)["customer_id"]
    return rows.mapInPandas(check, f"customer_id {kind}, nearest boolean")


#: Groups of the cluster orders and the columns they give.
ORDER_COLUMNS = {"full": "full_order", "male": "mens_order", "female": "womens_order", "family": "fam_order"}


def _grouped_vectors(spark, d):
    """(customer_id, grp, prefs): every customer with preferences, once for all
    customers and once for the own segment. Only one row of each is written."""
    vecs = R.purchased_vectors(spark, d)
    segs = cust.customer_segments(R.purchased_info(spark, d))
    return by_group(vecs.join(segs, "customer_id", "left").checkpoint(eager=True))


def by_group(vecs):
    """(customer_id, grp, prefs) from (customer_id, prefs, segment): a row for all customers
    and one for the own segment."""
    both = F.filter(F.array(F.lit("full"), F.col("segment")), lambda g: g.isin(list(ORDER_COLUMNS)))
    return vecs.select("customer_id", F.explode(both).alias("grp"), "prefs")


def _segment_vectors(spark, d, segment: str):
    return _grouped_vectors(spark, d).where(F.col("grp") == segment).select("customer_id", "prefs")


def _order_trees(spark, d):
    """One divisive tree per group, all grown in the same passes (C4)."""
    points = _grouped_vectors(spark, d)
    return points, _grown(points)


def _grown(points):
    return tree.grow(points, "customer_id", "prefs", dict.fromkeys(ORDER_COLUMNS, TREE_K))


def _orders(spark, d):
    points, grown = _order_trees(spark, d)
    return tree.leaf_ranks(grown.rows(points, "customer_id", "prefs"), "customer_id")


def orders_of(info, points):
    """``info`` with the four leaf-order columns of ``points`` (customer_id, grp, prefs)."""
    ranks = tree.leaf_ranks(_grown(points).rows(points, "customer_id", "prefs"), "customer_id")
    return tree.join_orders(info, ranks, "customer_id", ORDER_COLUMNS)


@register("tree_clusters")
def tree_clusters(spark, d):
    """Group, leaf and cluster of every customer: the final agglomerative fits
    of the surveyed code, for all segments at once (C4)."""
    points, grown = _order_trees(spark, d)
    rows = grown.rows(points, "customer_id", "prefs")
    numbers = spark.createDataFrame([(g, p, i) for g in ORDER_COLUMNS for i, p in enumerate(grown.leaves(g))],
                                    "grp string, path string, cluster int")
    return rows.join(F.broadcast(numbers), ["grp", "path"]).select("customer_id", "grp", "cluster", "path")


_GROUPS_SQL = """,
members AS (SELECT DISTINCT customer_id FROM pshares),
grouped AS (SELECT customer_id, 'full' AS grp FROM members UNION ALL
            SELECT m.customer_id, s.segment FROM members m JOIN segs s ON s.customer_id = m.customer_id
            WHERE s.segment <> 'boundary')"""


@register("tree_conditions", q(_GROUPS_SQL + f"""
SELECT grp, count(*) AS n, true AS ranks_dense, true AS leaves_together, true AS leaves_enough
FROM grouped GROUP BY grp"""))
def tree_conditions(spark, d):
    """Per group: whether the leaf ranks are 0..n-1, the rows of a leaf have neighbouring
    ranks, and there are as many leaves as asked for or as distinct vectors allow."""
    points, grown = _order_trees(spark, d)
    rows = grown.rows(points, "customer_id", "prefs")
    ranks = tree.leaf_ranks(rows, "customer_id").join(rows.select("customer_id", "grp", "path"), ["customer_id", "grp"])
    per_leaf = ranks.groupBy("grp", "path").agg(F.count("*").alias("m"), F.min("order").alias("lo"), F.max("order").alias("hi"))
    leaf = per_leaf.groupBy("grp").agg(F.sum("m").alias("n"), F.bool_and(F.col("hi") - F.col("lo") + 1 == F.col("m")).alias("leaves_together"),
                                       F.count("*").alias("leaves"))
    dense = ranks.groupBy("grp").agg(((F.min("order") == 0) & (F.max("order") == F.count("*") - 1)
                                      & (F.count_distinct("order") == F.count("*"))).alias("ranks_dense"))
    kinds = points.groupBy("grp").agg(F.count_distinct("prefs").alias("kinds"))
    enough = F.col("leaves") == F.least(F.col("kinds"), F.lit(TREE_K))
    return leaf.join(dense, "grp").join(kinds, "grp").select("grp", "n", "ranks_dense", "leaves_together", enough.alias("leaves_enough"))


@register("leaf_rank")
def leaf_rank(spark, d):
    """Leaf order of all customers with preferences."""
    return _orders(spark, d).where("grp = 'full'").select("customer_id", F.col("order").alias("full_order"))


def cluster_orders(spark, d):
    """customer_info ⟗ the four leaf-order columns, nulls → 0."""
    return tree.join_orders(R.purchased_info(spark, d), _orders(spark, d), "customer_id", ORDER_COLUMNS)


@register("cluster_orders_joined")
def cluster_orders_joined(spark, d):
    return cluster_orders(spark, d)


_GIVEN_SQL = _GROUPS_SQL + """,
ranks AS (SELECT customer_id, grp, row_number() OVER (PARTITION BY grp ORDER BY customer_id DESC) - 1 AS r FROM grouped)"""


@register("given_orders_joined", q(_GIVEN_SQL + """
SELECT coalesce(i.customer_id, f.customer_id, m.customer_id, w.customer_id, fa.customer_id) AS customer_id,
       CAST(coalesce(f.r, 0) AS BIGINT) AS full_order, CAST(coalesce(m.r, 0) AS BIGINT) AS mens_order,
       CAST(coalesce(w.r, 0) AS BIGINT) AS womens_order, CAST(coalesce(fa.r, 0) AS BIGINT) AS fam_order
FROM cx_info i
FULL JOIN (SELECT * FROM ranks WHERE grp = 'full') f ON i.customer_id = f.customer_id
FULL JOIN (SELECT * FROM ranks WHERE grp = 'male') m ON coalesce(i.customer_id, f.customer_id) = m.customer_id
FULL JOIN (SELECT * FROM ranks WHERE grp = 'female') w ON coalesce(i.customer_id, f.customer_id, m.customer_id) = w.customer_id
FULL JOIN (SELECT * FROM ranks WHERE grp = 'family') fa
  ON coalesce(i.customer_id, f.customer_id, m.customer_id, w.customer_id) = fa.customer_id"""))
def given_orders_joined(spark, d):
    """The join of the four order columns (J13, J16) on given orders: the
    place of a customer among its group's, last id first."""
    members = R.purchased_shares(spark, d).select("customer_id").distinct()
    segs = cust.customer_segments(R.purchased_info(spark, d))
    both = F.filter(F.array(F.lit("full"), F.col("segment")), lambda g: g.isin(list(ORDER_COLUMNS)))
    grouped = members.join(segs, "customer_id", "left").select("customer_id", F.explode(both).alias("grp"))
    codes = encode.dense_codes(grouped, ["grp", "customer_id"], "c")
    last = codes.groupBy("grp").agg(F.max("c").alias("last"))
    orders = codes.join(F.broadcast(last), "grp").select("customer_id", "grp", (F.col("last") - F.col("c")).alias("order"))
    out = tree.join_orders(R.purchased_info(spark, d), orders, "customer_id", ORDER_COLUMNS)
    return out.select("customer_id", *ORDER_COLUMNS.values())


@register("kmeans_predict", q(f"""
SELECT vec_id, cluster FROM (
  SELECT p.vec_id, CAST(c.vec_id / 10 AS INTEGER) AS cluster,
         row_number() OVER (PARTITION BY p.vec_id ORDER BY {SQ.format(a='p.embedding', b='c.embedding')}, c.vec_id) AS r
  FROM embeds p JOIN embeds c ON c.vec_id % 10 = 0)
WHERE r = 1"""))
def kmeans_predict(spark, d):
    """Every row to its nearest centre of a model table (C2): a tenth of the rows as centres."""
    emb = src.embeddings(spark, d)
    held = emb.where("vec_id % 10 = 0").select((F.col("vec_id") / 10).cast("int").alias("cluster"), F.col("embedding").alias("centre"))
    return cluster.predict(emb, "vec_id", "embedding", held)


@register("kmeans_sample_predict")
def kmeans_sample_predict(spark, d):
    """k-means fitted on a sample (C1), its model applied to every customer."""
    vecs = _segment_vectors(spark, d, "full")
    part = quality.sample_points(vecs, "customer_id", FIT_SAMPLE, P.SEED)
    centers, _ = cluster.kmeans(part, "customer_id", "prefs", min(KMEANS_K_ALL, part.count()), P.SEED)
    return cluster.predict(vecs, "customer_id", "prefs", cluster.model_table(spark, centers))


@register("kmeans_sweep")
def kmeans_sweep(spark, d):
    return cluster.sweep(_segment_vectors(spark, d, "full"), "customer_id", "prefs", SWEEP_KS, P.SEED).drop("method")


def _sweep(spark, d, segment: str, grid: tuple[int, int, int], methods: tuple[str, ...]):
    return cluster.sweep(_segment_vectors(spark, d, segment), "customer_id", "prefs", list(range(*grid)),
                         P.SEED, methods=methods)


@register("sweep_male")
def sweep_male(spark, d):
    """The surveyed sweep of the male segment, k-means and tree, over its grid."""
    return _sweep(spark, d, "male", P.KGRID_MALE, ("kmeans", "tree"))


@register("sweep_female")
def sweep_female(spark, d):
    return _sweep(spark, d, "female", P.KGRID_FEMALE, ("kmeans", "tree"))


@register("sweep_family")
def sweep_family(spark, d):
    return _sweep(spark, d, "family", P.KGRID_FAMILY, ("kmeans", "tree"))


@register("sweep_all")
def sweep_all(spark, d):
    return _sweep(spark, d, "full", P.KGRID_ALL, ("kmeans",))


_K_SCORES_SQL = f""",
lab AS (SELECT k, vec_id, label % k AS label, embedding AS e FROM embeds, range(2, 10) t(k)),
cent AS (SELECT k, label, list(m ORDER BY i) AS c, any_value(n) AS n FROM (
    SELECT k, label, i, avg(v) AS m, count(*) AS n FROM (
        SELECT k, label, unnest(generate_series(1, len(e))) AS i, unnest(e) AS v FROM lab)
    GROUP BY k, label, i) GROUP BY k, label),
spread AS (SELECT l.k, l.label, avg(list_distance(l.e, c.c)) AS s, sum({SQ.format(a="l.e", b="c.c")}) AS sse
           FROM lab l JOIN cent c ON l.k = c.k AND l.label = c.label GROUP BY 1, 2),
db AS (SELECT k, avg(r) AS db FROM (
    SELECT a.k, a.label, max(CASE WHEN list_distance(a.c, b.c) = 0 THEN 0.0 ELSE (sa.s + sb.s) / list_distance(a.c, b.c) END) AS r
    FROM cent a JOIN cent b ON a.k = b.k AND a.label <> b.label
    JOIN spread sa ON sa.k = a.k AND sa.label = a.label JOIN spread sb ON sb.k = b.k AND sb.label = b.label
    GROUP BY 1, 2) GROUP BY k),
mean AS (SELECT list(m ORDER BY i) AS c FROM (
    SELECT i, avg(v) AS m FROM (
        SELECT unnest(generate_series(1, len(embedding))) AS i, unnest(embedding) AS v FROM embeds)
    GROUP BY i)),
ch AS (SELECT c.k, sum(c.n * {SQ.format(a="c.c", b="mean.c")}) * (sum(c.n) - count(*)) / (sum(s.sse) * (count(*) - 1)) AS ch,
              count(*) AS n_features
       FROM cent c JOIN spread s ON c.k = s.k AND c.label = s.label, mean GROUP BY c.k),
d AS (SELECT a.vec_id, b.label, sum(list_distance(a.embedding, b.embedding)) AS s, count(*) AS n, a.label AS own
      FROM embeds a JOIN embeds b ON a.vec_id <> b.vec_id GROUP BY 1, 2, 5),
per AS (SELECT k, vec_id, own % k AS la, label % k AS lb, sum(s) / sum(n) AS m FROM d, range(2, 10) t(k) GROUP BY 1, 2, 3, 4),
ab AS (SELECT k, vec_id, max(CASE WHEN lb = la THEN m END) AS a, min(CASE WHEN lb <> la THEN m END) AS b FROM per GROUP BY 1, 2),
si AS (SELECT k, avg(CASE WHEN a IS NULL THEN 0.0 ELSE (b - a) / greatest(a, b) END) AS si FROM ab GROUP BY k),
scores AS (SELECT CAST(db.k AS INTEGER) AS k, round(db, 6) AS davies_bouldin_score, round(si, 6) AS silhouette_score,
       round(ch, 6) AS calinski_harabasz_score, CAST(n_features AS BIGINT) AS n_features, CAST(0 AS BIGINT) AS n_noise
FROM db JOIN si ON db.k = si.k JOIN ch ON db.k = ch.k)"""


@register("scores_by_k", q(_K_SCORES_SQL + " SELECT * FROM scores"))
def scores_by_k(spark, d):
    """The sweep's scores on given labels (the label modulo k), every k at once."""
    emb = src.embeddings(spark, d)
    labels = emb.select("vec_id", "label", F.explode(F.sequence(F.lit(2), F.lit(9))).alias("k"))
    return cluster.score_labels(emb, "vec_id", "embedding", labels.withColumn("label", F.col("label") % F.col("k"))).drop("method")


@register("best_k", q(_K_SCORES_SQL + " SELECT * FROM scores ORDER BY silhouette_score DESC, k LIMIT 1"))
def best_k(spark, d):
    """The k with the best silhouette of those scores."""
    return cluster.best_k(scores_by_k(spark, d))


# ------------------------------------------------------------------ step 6: models

_X_SQL = """,
x AS (SELECT customer_id, CAST(FN AS DOUBLE) AS FN,
             CAST("fashion_news_frequency_Regularly" AS DOUBLE) AS "fashion_news_frequency_Regularly",
             CAST("club_member_status_LEFT CLUB" AS DOUBLE) AS "club_member_status_LEFT CLUB",
             CAST("club_member_status_PRE-CREATE" AS DOUBLE) AS "club_member_status_PRE-CREATE",
             CAST(female AS DOUBLE) AS female, CAST(male AS DOUBLE) AS male,
             CAST(children AS DOUBLE) AS children,
             CAST(least(greatest(age, 0), 85) AS INTEGER) AS age_idx
      FROM cx_info WHERE customer_id IN (SELECT customer_id FROM pshares))"""


@register("standardised_columns", q("""
SELECT customer_id, round(CASE WHEN (SELECT stddev_pop(age) FROM cx_info) > 0
         THEN (age - (SELECT avg(age) FROM cx_info)) / (SELECT stddev_pop(age) FROM cx_info) ELSE 0 END, 9) AS age,
       round(CASE WHEN (SELECT stddev_pop(FN) FROM cx_info) > 0
         THEN (FN - (SELECT avg(FN) FROM cx_info)) / (SELECT stddev_pop(FN) FROM cx_info) ELSE 0 END, 9) AS FN,
       round(CASE WHEN (SELECT stddev_pop(female) FROM cx_info) > 0
         THEN (female - (SELECT avg(female) FROM cx_info)) / (SELECT stddev_pop(female) FROM cx_info) ELSE 0 END, 9) AS female
FROM cx_info"""))
def standardised_columns(spark, d):
    """Standardised columns (M3), on given ones: the cluster columns take the same step."""
    cols = ["age", "FN", "female"]
    out = model.standardise(R.info(spark, d).select("customer_id", *cols), cols)
    return out.select("customer_id", *[F.round(c, 9).alias(c) for c in cols])


@register("age_category", q("""
SELECT customer_id, CAST(least(greatest(age, 0), 85) AS INTEGER) AS age_idx FROM cx_info"""))
def age_category(spark, d):
    return model.age_category(R.info(spark, d))


@register("model_inputs", q(_X_SQL + "\nSELECT * FROM x"))
def model_inputs(spark, d):
    return model.model_inputs(R.info(spark, d), R.shares(spark, d))


def _gram_sql() -> str:
    cols = model.INFO_COLS
    base = 1 + P.AGE_CATEGORIES
    qc = [f'"{c}"' for c in cols]
    xx = ["SELECT 0 AS i, 0 AS j, CAST(count(*) AS DOUBLE) AS v FROM x",
          "SELECT 0, age_idx + 1, CAST(count(*) AS DOUBLE) FROM x GROUP BY age_idx",
          "SELECT age_idx + 1, age_idx + 1, CAST(count(*) AS DOUBLE) FROM x GROUP BY age_idx"]
    for p, c in enumerate(qc):
        xx.append(f"SELECT 0, {base + p}, sum({c}) FROM x")
        xx.append(f"SELECT age_idx + 1, {base + p}, sum({c}) FROM x GROUP BY age_idx")
        for qi in range(p, len(qc)):
            xx.append(f"SELECT {base + p}, {base + qi}, sum({c} * {qc[qi]}) FROM x")
    xy = ["SELECT 0 AS i, feature_idx AS j, sum(share) AS v FROM ys GROUP BY feature_idx",
          "SELECT age_idx + 1, feature_idx, sum(share) FROM ys GROUP BY age_idx, feature_idx"]
    for p, c in enumerate(qc):
        xy.append(f"SELECT {base + p}, feature_idx, sum(share * {c}) FROM ys GROUP BY feature_idx")
    return q(_X_SQL + """,
ys AS (SELECT s.feature_idx, s.share, x.* FROM pshares s JOIN x ON s.customer_id = x.customer_id)
SELECT 'xx' AS block, CAST(i AS BIGINT) AS i, CAST(j AS BIGINT) AS j, round(v, 6) AS value FROM ("""
             + "\nUNION ALL ".join(xx) + """)
UNION ALL
SELECT 'xy', CAST(i AS BIGINT), CAST(j AS BIGINT), round(v, 6) FROM (""" + "\nUNION ALL ".join(xy) + ")")


@register("gram_matrix", _gram_sql())
def gram_matrix(spark, d):
    x = model.model_inputs(R.info(spark, d), R.shares(spark, d))
    g = model.gram(x, R.shares(spark, d), model.INFO_COLS)
    return g.withColumn("value", F.round("value", 6))


#: Inputs of the fit: the customer columns and the standardised cluster columns.
FIT_COLS = model.INFO_COLS + model.CLUSTER_COLS


def _fit(spark, d, group: str | None = None, rank: int | None = None):
    """(coefficients, inputs, preference width, number of inputs). The general
    fit takes the cluster columns in; the fits by segment take the customer columns."""
    width, vecs = R.feature_width(spark, d), R.purchased_vectors(spark, d)
    cols = model.INFO_COLS if group else FIT_COLS
    if group:
        x = model.model_inputs(R.purchased_info(spark, d), vecs)
        x = x.join(cust.customer_segments(R.purchased_info(spark, d)), "customer_id")
    else:
        orders = model.standardise(cluster_orders(spark, d).select("customer_id", *model.CLUSTER_COLS), model.CLUSTER_COLS)
        x = model.model_inputs(R.purchased_info(spark, d), vecs, extra=orders, extra_cols=model.CLUSTER_COLS)
    x = x.checkpoint(eager=True)
    g = model.vector_gram(x, vecs, cols, width, group=group)
    p = 1 + P.AGE_CATEGORIES + len(cols)
    fit = model.fit_pref_regression(g, p, width, P.L1_STRENGTH, group=group, rank=rank)
    return fit, x, width, p


@register("pref_regression")
def pref_regression(spark, d):
    return _fit(spark, d)[0]


@register("pref_regression_rank")
def pref_regression_rank(spark, d):
    """The regression with the rank of the surveyed network's linear map (M1)."""
    return _fit(spark, d, rank=P.PREFERENCE_RANK)[0]


def _conditions(spark, d, check, group: str | None = None, rank: int | None = None):
    """Optimality of a fit, checked anew from its written coefficients: (grp?, feature_idx, optimal)."""
    fit, x, width, p = _fit(spark, d, group, rank)
    fit = fit.checkpoint(eager=True)
    cols = model.INFO_COLS if group else FIT_COLS
    entries = model.vector_gram(x, R.purchased_vectors(spark, d), cols, width, group=group).toPandas()
    out = []
    for key in ([None] if group is None else sorted(entries[group].unique())):
        part = entries if group is None else entries[entries[group] == key]
        G, C, n = model.dense_gram(part, p, width)
        good = check(G, C, n, model.coef_matrix(fit, p, width, group, key))
        out += [((key,) if group else ()) + (i, bool(v)) for i, v in enumerate(good)]
    return spark.createDataFrame(out, ("" if group is None else f"{group} string, ") + "feature_idx long, optimal boolean")


_OPTIMAL_SQL = "SELECT feature_idx, true AS optimal FROM dict_kept"


@register("pref_regression_conditions", q(_OPTIMAL_SQL))
def pref_regression_conditions(spark, d):
    """Whether the L1 fit with all eleven columns meets its optimality conditions (M1, M2, M5)."""
    return _conditions(spark, d, lambda G, C, n, B: model.lasso_conditions(G, C, n, P.L1_STRENGTH, B))


@register("pref_rank_conditions", q(_OPTIMAL_SQL))
def pref_rank_conditions(spark, d):
    """The same of the fit of capped rank (M1)."""
    return _conditions(spark, d, lambda G, C, n, B: model.rank_conditions(G, C, n, P.PREFERENCE_RANK, B),
                       rank=P.PREFERENCE_RANK)


@register("pref_segment_conditions", q("""
SELECT segment, feature_idx, true AS optimal FROM dict_kept, (
  SELECT DISTINCT segment FROM segs WHERE customer_id IN (SELECT customer_id FROM pshares))"""))
def pref_segment_conditions(spark, d):
    """The same of the fits by segment (M7)."""
    return _conditions(spark, d, lambda G, C, n, B: model.lasso_conditions(G, C, n, P.L1_STRENGTH, B), group="segment")


@register("pref_regression_by_segment")
def pref_regression_by_segment(spark, d):
    return _fit(spark, d, "segment")[0]


def train_segment(spark, d, segment: str):
    """Per-segment fit for one gender segment (M7); other labels raise."""
    if segment not in ("male", "female"):
        raise ValueError(f"no model for segment {segment!r}: male and female only")
    coefs = _fit(spark, d, "segment")[0]
    return coefs.filter(F.col("segment") == segment)


@register("cluster_standardised")
def cluster_standardised(spark, d):
    orders = cluster_orders(spark, d).select("customer_id", *model.CLUSTER_COLS)
    return model.standardise(orders, model.CLUSTER_COLS)


@register("predicted_prefs")
def predicted_prefs(spark, d):
    coefs, x, width, p = _fit(spark, d)
    return model.predict_prefs(x, model.coef_matrix(coefs, p, width), FIT_COLS)


# ------------------------------------------------------------------ scoring


def _train_counts(spark, d):
    """Preference counts of the training window. The evaluations read them
    several times (vectors, customer set, pair scores), so they are written
    once to the checkpoint folder instead of re-deriving the join."""
    tx = R.purchases(spark, d).where("n_train > 0").select("customer_id", "article_id", F.col("n_train").alias("n"))
    return prefs.pref_counts(tx, R.art_long(spark, d)).checkpoint(eager=True)


def _test_purchases(spark, d):
    return R.purchases(spark, d).where("n_test > 0").select("customer_id", "article_id", F.col("n_test").alias("y"))


def _scored_test(spark, d, counts):
    """(customer_id, article_id, y, score) of the test purchases of live
    articles by customers with a training window."""
    y = _test_purchases(spark, d).join(R.live_slots(spark, d).select("article_id"), "article_id").join(
        counts.select("customer_id").distinct(), "customer_id")
    return score.pair_scores(y, counts, R.art_long(spark, d)).join(y, ["customer_id", "article_id"])


def _train_vectors(spark, d, counts):
    return score.count_vectors(counts, R.feature_width(spark, d))


@register("topk_articles", q(f""",
cust AS (SELECT customer_id, sum(n) AS total FROM pcounts GROUP BY customer_id),
sc AS (SELECT p.customer_id, a.article_id, sum(p.n) AS s
       FROM pcounts p JOIN art_long a ON p.feature_idx = a.feature_idx GROUP BY 1, 2),
allp AS (SELECT c.customer_id, c.total, l.article_id, coalesce(sc.s, 0) AS s
         FROM cust c CROSS JOIN live l
         LEFT JOIN sc ON sc.customer_id = c.customer_id AND sc.article_id = l.article_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY s DESC, article_id) AS rk
           FROM allp)
SELECT customer_id, CAST(rk AS BIGINT) AS rank, article_id, CAST(s AS DOUBLE) AS raw_score,
       CAST(s AS DOUBLE) / total AS score
FROM ranked WHERE rk <= {P.TOPK}"""))
def topk_articles(spark, d):
    width = R.feature_width(spark, d)
    counts = prefs.pref_counts(R.purchases(spark, d).select("customer_id", "article_id", "n"), R.art_long(spark, d))
    return score.topk(score.count_vectors(counts, width), R.live_slots(spark, d), width, P.TOPK)


_TRAIN_SQL = f""",
purch_tr AS (SELECT customer_id, article_id, count(*) AS n FROM transactions
             WHERE t_dat < DATE '{P.TEST_CUTOFF}' GROUP BY 1, 2),
pc_tr AS (SELECT p.customer_id, a.feature_idx, sum(p.n) AS n
          FROM purch_tr p JOIN art_long a ON p.article_id = a.article_id GROUP BY 1, 2),
cust_tr AS (SELECT customer_id, sum(n) AS total FROM pc_tr GROUP BY customer_id),
sc_tr AS (SELECT p.customer_id, a.article_id, sum(p.n) AS s
          FROM pc_tr p JOIN art_long a ON p.feature_idx = a.feature_idx GROUP BY 1, 2),
y AS (SELECT customer_id, article_id, count(*) AS y FROM transactions
      WHERE t_dat >= DATE '{P.TEST_CUTOFF}' GROUP BY 1, 2)"""


@register("article_scores", q(_TRAIN_SQL + """
SELECT y.customer_id, y.article_id, CAST(coalesce(sc.s, 0) AS BIGINT) AS raw_score,
       CAST(coalesce(sc.s, 0) AS DOUBLE) / c.total AS score
FROM y JOIN cust_tr c ON y.customer_id = c.customer_id
LEFT JOIN sc_tr sc ON sc.customer_id = y.customer_id AND sc.article_id = y.article_id"""))
def article_scores(spark, d):
    counts = _train_counts(spark, d)
    pairs = _test_purchases(spark, d).join(counts.select("customer_id").distinct(), "customer_id")
    return score.pair_scores(pairs, counts, R.art_long(spark, d))


@register("eval_hit_rate", q(_TRAIN_SQL + f""",
allp AS (SELECT c.customer_id, l.article_id, coalesce(sc.s, 0) AS s
         FROM cust_tr c CROSS JOIN live l
         LEFT JOIN sc_tr sc ON sc.customer_id = c.customer_id AND sc.article_id = l.article_id),
top AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY s DESC, article_id) AS rk
                       FROM allp) WHERE rk <= {P.TOPK}),
evalc AS (SELECT DISTINCT y.customer_id FROM y JOIN cust_tr c ON y.customer_id = c.customer_id),
hits AS (SELECT e.customer_id, max(CASE WHEN y.y IS NOT NULL THEN 1 ELSE 0 END) AS hit
         FROM evalc e JOIN top t ON t.customer_id = e.customer_id
         LEFT JOIN y ON y.customer_id = t.customer_id AND y.article_id = t.article_id
         GROUP BY e.customer_id)
SELECT count(*) AS n_customers, CAST(sum(hit) AS BIGINT) AS n_hits,
       CAST(sum(hit) AS DOUBLE) / count(*) AS hit_rate FROM hits"""))
def eval_hit_rate(spark, d):
    counts = _train_counts(spark, d)
    y = _test_purchases(spark, d)
    vecs = score.of_customers(_train_vectors(spark, d, counts), y)
    top = score.topk(vecs, R.live_slots(spark, d), R.feature_width(spark, d), P.TOPK)
    evalc = y.select("customer_id").distinct().join(counts.select("customer_id").distinct(),
                                                     "customer_id")
    t = top.join(evalc, "customer_id").join(y, ["customer_id", "article_id"], "left")
    per = t.groupBy("customer_id").agg(F.max(F.col("y").isNotNull().cast("int")).alias("hit"))
    return per.agg(F.count(F.lit(1)).alias("n_customers"),
                   F.sum("hit").cast("bigint").alias("n_hits"),
                   F.try_divide(F.sum("hit").cast("double"), F.count(F.lit(1))).alias("hit_rate"))


@register("eval_mse", q(_TRAIN_SQL + """,
grid AS (SELECT CAST(coalesce(sc.s, 0) AS DOUBLE) / c.total AS p, coalesce(y.y, 0) AS y
         FROM cust_tr c CROSS JOIN live l
         LEFT JOIN sc_tr sc ON sc.customer_id = c.customer_id AND sc.article_id = l.article_id
         LEFT JOIN y ON y.customer_id = c.customer_id AND y.article_id = l.article_id)
SELECT round(avg((y - p) * (y - p)), 9) AS mse, count(*) AS n_pairs FROM grid"""))
def eval_mse(spark, d):
    """Mean squared error over every (customer, live article) pair, from
    Σp² (Gram matrices) − 2Σyp + Σy² (purchased pairs only)."""
    counts = _train_counts(spark, d)
    return score.mean_squared_error(_train_vectors(spark, d, counts), R.live_slots(spark, d),
                                    R.feature_width(spark, d), _scored_test(spark, d, counts))


_GRID_SQL = _TRAIN_SQL + """,
grid AS (SELECT c.customer_id, l.article_id, CAST(coalesce(sc.s, 0) AS DOUBLE) / c.total AS p, coalesce(y.y, 0) AS y
         FROM cust_tr c CROSS JOIN live l
         LEFT JOIN sc_tr sc ON sc.customer_id = c.customer_id AND sc.article_id = l.article_id
         LEFT JOIN y ON y.customer_id = c.customer_id AND y.article_id = l.article_id)"""

_LOSS_SQL = """,
lse AS (SELECT customer_id, ln(sum(exp(p))) AS lse FROM grid GROUP BY customer_id)
SELECT round(sum(g.y * (l.lse - g.p)) / sum(g.y), 9) AS cross_entropy, CAST(sum(g.y) AS BIGINT) AS n
FROM grid g JOIN lse l ON g.customer_id = l.customer_id"""


@register("eval_cross_entropy", q(_GRID_SQL + _LOSS_SQL))
def eval_cross_entropy(spark, d):
    """Sparse categorical cross-entropy (M10): the customer's scores as logits
    over the live articles, each test purchase a sample."""
    counts = _train_counts(spark, d)
    scored = kept(_scored_test(spark, d, counts))
    vecs = score.of_customers(_train_vectors(spark, d, counts), scored)
    return score.cross_entropy(score.log_sum_exp(vecs, R.live_slots(spark, d), R.feature_width(spark, d)), scored)


@register("eval_accuracy", q(_GRID_SQL + """,
best AS (SELECT customer_id, article_id FROM (
  SELECT customer_id, article_id, row_number() OVER (PARTITION BY customer_id ORDER BY p DESC, article_id) AS r FROM grid)
  WHERE r = 1)
SELECT CAST(sum(CASE WHEN b.article_id = g.article_id THEN g.y ELSE 0 END) AS DOUBLE) / sum(g.y) AS accuracy,
       CAST(sum(CASE WHEN b.article_id = g.article_id THEN g.y ELSE 0 END) AS BIGINT) AS n_right,
       CAST(sum(g.y) AS BIGINT) AS n
FROM grid g JOIN best b ON g.customer_id = b.customer_id"""))
def eval_accuracy(spark, d):
    """Share of the test purchases whose article is the best-scored one."""
    counts = _train_counts(spark, d)
    scored = kept(_scored_test(spark, d, counts))
    vecs = score.of_customers(_train_vectors(spark, d, counts), scored)
    best = score.topk(vecs, R.live_slots(spark, d), R.feature_width(spark, d), 1)
    return score.accuracy(best, scored.select("customer_id", "article_id", "y"))


@register("chained_scores")
def chained_scores(spark, d):
    """customer → predicted preferences → top-k live articles."""
    coefs, x, width, p = _fit(spark, d)
    pred = model.predict_prefs(x, model.coef_matrix(coefs, p, width), FIT_COLS)
    out = score.topk(score.dense_vectors(pred), R.live_slots(spark, d), width, P.TOPK)
    return out.select("customer_id", "rank", "article_id", "score")


def _chained(spark, d, pred):
    """(vectors, scored test purchases) of predicted preferences."""
    slots = R.live_slots(spark, d)
    y = _test_purchases(spark, d).join(slots.select("article_id"), "article_id").join(
        pred.select("customer_id"), "customer_id")
    scored = kept(score.pair_predictions(y, pred, slots).join(y, ["customer_id", "article_id"]))
    return score.dense_vectors(pred), scored


def _held_predictions(spark, d):
    """Predictions of the marginal coefficients, which are held in a table."""
    width = R.feature_width(spark, d)
    x = model.model_inputs(R.purchased_info(spark, d), R.purchased_shares(spark, d))
    coefs = model.marginal_coefs(model.gram(x, R.purchased_shares(spark, d), model.INFO_COLS), len(model.INFO_COLS))
    p = 1 + P.AGE_CATEGORIES + len(model.INFO_COLS)
    return model.predict_prefs(x, model.coef_matrix(coefs, p, width), model.INFO_COLS).checkpoint(eager=True)


_MARGINAL_SQL = _X_SQL + """,
ys AS (SELECT s.feature_idx, s.share, x.* FROM pshares s JOIN x ON s.customer_id = x.customer_id),
xl AS (""" + "\nUNION ALL ".join(
    f'SELECT customer_id, {1 + P.AGE_CATEGORIES + i} AS x_idx, "{c}" AS v FROM x' for i, c in enumerate(model.INFO_COLS)) + f"""),
xs AS (SELECT x_idx, count(*) AS n, sum(v) AS s, sum(v * v) AS ss FROM xl GROUP BY x_idx),
y0 AS (SELECT feature_idx, sum(share) AS y FROM ys GROUP BY feature_idx),
xy AS (SELECT l.x_idx, s.feature_idx, sum(l.v * s.share) AS xy FROM xl l JOIN pshares s ON l.customer_id = s.customer_id
       GROUP BY 1, 2),
slope AS (SELECT xy.x_idx, xy.feature_idx, (xy - s * y / n) / (ss - s * s / n) / {len(model.INFO_COLS)} AS b, s / n AS m
          FROM xy JOIN xs USING (x_idx) JOIN y0 USING (feature_idx) WHERE ss - s * s / n > {model.CONSTANT}),
coefs AS (
  SELECT 0 AS x_idx, feature_idx, -sum(b * m) AS coef FROM slope GROUP BY feature_idx
  UNION ALL
  SELECT age_idx + 1, feature_idx, sum(share) / (SELECT count(*) FROM x WHERE x.age_idx = ys.age_idx)
  FROM ys GROUP BY age_idx, feature_idx
  UNION ALL
  SELECT x_idx, feature_idx, b FROM slope)"""


@register("marginal_coefs", q(_MARGINAL_SQL + """
SELECT CAST(x_idx AS BIGINT) AS x_idx, CAST(feature_idx AS BIGINT) AS feature_idx, round(coef, 9) AS coef FROM coefs"""))
def marginal_coefs(spark, d):
    """A customer → preference model in closed form: the mean shares of the
    age category and the slope of each column taken alone."""
    x = model.model_inputs(R.purchased_info(spark, d), R.purchased_shares(spark, d))
    g = model.gram(x, R.purchased_shares(spark, d), model.INFO_COLS)
    return model.marginal_coefs(g, len(model.INFO_COLS)).withColumn("coef", F.round("coef", 9))


@register("predicted_prefs_held", q(_MARGINAL_SQL + """,
base AS (SELECT feature_idx, coef FROM coefs WHERE x_idx = 0),
inputs AS (SELECT customer_id, age_idx + 1 AS x_idx, 1.0 AS v FROM x UNION ALL SELECT customer_id, x_idx, v FROM xl),
p AS (SELECT i.customer_id, c.feature_idx, sum(i.v * c.coef) AS p FROM inputs i JOIN coefs c USING (x_idx) GROUP BY 1, 2)
SELECT x.customer_id, CAST(b.feature_idx AS BIGINT) AS feature_idx, round(b.coef + coalesce(p.p, 0), 9) AS pred
FROM x CROSS JOIN base b LEFT JOIN p ON p.customer_id = x.customer_id AND p.feature_idx = b.feature_idx"""))
def predicted_prefs_held(spark, d):
    """Predicted preferences of held coefficients (M8), feature by feature; features
    that nobody bought have no coefficient and no row."""
    pred = _held_predictions(spark, d).select("customer_id", F.posexplode("pred").alias("feature_idx", "pred"))
    known = R.purchased_shares(spark, d).select("feature_idx").distinct()
    return pred.withColumn("feature_idx", F.col("feature_idx").cast("long")).join(known, "feature_idx", "left_semi").select(
        "customer_id", "feature_idx", F.round("pred", 9).alias("pred"))


_CHAINED_SQL = _MARGINAL_SQL + f""",
base AS (SELECT feature_idx, coef FROM coefs WHERE x_idx = 0),
inputs AS (SELECT customer_id, age_idx + 1 AS x_idx, 1.0 AS v FROM x UNION ALL SELECT customer_id, x_idx, v FROM xl),
pred AS (SELECT i.customer_id, c.feature_idx, sum(i.v * c.coef) AS p FROM inputs i JOIN coefs c USING (x_idx) GROUP BY 1, 2),
sc AS (SELECT p.customer_id, a.article_id, sum(p.p + b.coef) AS p
       FROM pred p JOIN base b USING (feature_idx) JOIN art_long a USING (feature_idx)
       WHERE a.article_id IN (SELECT article_id FROM live) GROUP BY 1, 2),
y AS (SELECT customer_id, article_id, count(*) AS y FROM transactions
      WHERE t_dat >= DATE '{P.TEST_CUTOFF}' GROUP BY 1, 2),
grid AS (SELECT x.customer_id, l.article_id, coalesce(sc.p, 0) AS p, coalesce(y.y, 0) AS y
         FROM x CROSS JOIN live l
         LEFT JOIN sc ON sc.customer_id = x.customer_id AND sc.article_id = l.article_id
         LEFT JOIN y ON y.customer_id = x.customer_id AND y.article_id = l.article_id)"""


@register("eval_chained_mse", q(_CHAINED_SQL + """
SELECT round(avg((y - p) * (y - p)), 9) AS mse, count(*) AS n_pairs FROM grid"""))
def eval_chained_mse(spark, d):
    """The chained model (M8, M9) on held coefficients: customer columns →
    predicted preferences → every live article, squared error against the test purchases."""
    vecs, scored = _chained(spark, d, _held_predictions(spark, d))
    return score.mean_squared_error(vecs, R.live_slots(spark, d), R.feature_width(spark, d), scored)


@register("eval_chained_cross_entropy", q(_CHAINED_SQL + _LOSS_SQL))
def eval_chained_cross_entropy(spark, d):
    """Cross-entropy of the chained model on held coefficients."""
    vecs, scored = _chained(spark, d, _held_predictions(spark, d))
    vecs = score.of_customers(vecs, scored)
    return score.cross_entropy(score.log_sum_exp(vecs, R.live_slots(spark, d), R.feature_width(spark, d)), scored)


def evaluate_chained(pred, slots, width: int, bought, scored, buyers=None):
    """(mse, n_pairs, cross_entropy, accuracy) of predicted preferences; ``buyers`` are those
    of the customers in ``bought`` and ``scored``, if they are given apart."""
    vecs = score.dense_vectors(pred)
    own = vecs if buyers is None else score.dense_vectors(buyers)
    few, most = (own, own) if buyers is not None else (score.of_customers(vecs, scored), score.of_customers(vecs, bought))
    best = score.topk(most, slots, width, 1)
    parts = [score.mean_squared_error(vecs, slots, width, scored),
             score.cross_entropy(score.log_sum_exp(few, slots, width), scored).select("cross_entropy"),
             score.accuracy(best, bought).select("accuracy")]
    kinds = {"mse": "double", "n_pairs": "long", "cross_entropy": "double", "accuracy": "double"}
    rows = [p.select(*[(F.col(c) if c in p.columns else F.lit(None)).cast(k).alias(c) for c, k in kinds.items()]) for p in parts]
    every = rows[0].unionByName(rows[1]).unionByName(rows[2])
    return every.agg(*[F.max(c).alias(c) for c in kinds])


@register("eval_chained_fit")
def eval_chained_fit(spark, d):
    """The fitted chained model on the test purchases (M8-M10): squared
    error over all pairs, cross-entropy and accuracy."""
    coefs, x, width, p = _fit(spark, d)
    # Inputs are narrow and predictions wide: they are predicted where they are used, and joins take the inputs.
    B = model.coef_matrix(coefs, p, width)
    predict = lambda rows: model.predict_prefs(rows, B, FIT_COLS)
    slots = R.live_slots(spark, d)
    y = kept(_test_purchases(spark, d).join(slots.select("article_id"), "article_id").join(x.select("customer_id"), "customer_id"))
    buyers = (x.join(y.select("customer_id").distinct(), "customer_id", "left_semi")
              .repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "customer_id").checkpoint(eager=True))
    scored = kept(score.pair_predictions(y, predict(buyers), slots).join(y, ["customer_id", "article_id"]))
    return evaluate_chained(predict(x), slots, width, scored.select("customer_id", "article_id", "y"), scored, predict(buyers))


AUC_THRESHOLDS = 200


def _score_groups(spark, d):
    """Equal scores of all pairs, and of the bought ones."""
    counts = _train_counts(spark, d)
    groups = score.score_groups(_train_vectors(spark, d, counts), R.live_slots(spark, d), R.feature_width(spark, d))
    pos = _scored_test(spark, d, counts).groupBy("score").agg(F.count(F.lit(1)).alias("p"))
    return groups, pos


@register("eval_auc", q(_GRID_SQL + f""",
th AS (SELECT i, CASE WHEN i = 0 THEN CAST(-1e-7 AS DOUBLE)
                      WHEN i = {AUC_THRESHOLDS - 1} THEN CAST(1 AS DOUBLE) + 1e-7
                      ELSE CAST(i AS DOUBLE) / CAST({AUC_THRESHOLDS - 1} AS DOUBLE) END AS t
       FROM range({AUC_THRESHOLDS}) r(i)),
cnt AS (SELECT t.i, sum(CASE WHEN g.p > t.t AND g.y > 0 THEN 1 ELSE 0 END) AS tp,
               sum(CASE WHEN g.p > t.t AND g.y = 0 THEN 1 ELSE 0 END) AS fp
        FROM grid g CROSS JOIN th t GROUP BY t.i),
tot AS (SELECT sum(CASE WHEN y > 0 THEN 1 ELSE 0 END) AS pos, sum(CASE WHEN y = 0 THEN 1 ELSE 0 END) AS neg
        FROM grid),
r AS (SELECT i, CAST(tp AS DOUBLE) / pos AS tpr, CAST(fp AS DOUBLE) / neg AS fpr FROM cnt, tot),
s AS (SELECT (fpr - lead(fpr) OVER (ORDER BY i)) * (tpr + lead(tpr) OVER (ORDER BY i)) / 2 AS a FROM r)
SELECT round(sum(a), 9) AS auc FROM s"""))
def eval_auc(spark, d):
    """Pooled ROC AUC over every (customer, live article) pair, label =
    bought in the test window, on the 200-threshold grid of the surveyed
    metric (M10)."""
    auc = score.grid_auc(*_score_groups(spark, d), score.auc_thresholds(AUC_THRESHOLDS))
    return spark.createDataFrame([(None if auc is None else round(auc, 9),)], "auc double")


@register("eval_auc_exact", q(_GRID_SQL + """,
g AS (SELECT p, CAST(sum(CASE WHEN y > 0 THEN 1 ELSE 0 END) AS DOUBLE) AS pos,
             CAST(sum(CASE WHEN y = 0 THEN 1 ELSE 0 END) AS DOUBLE) AS neg FROM grid GROUP BY p),
r AS (SELECT pos, neg, sum(neg) OVER (ORDER BY p) - neg AS below FROM g)
SELECT round(sum(pos * (below + neg / 2)) / (sum(pos) * sum(neg)), 9) AS auc FROM r"""))
def eval_auc_exact(spark, d):
    """The same AUC without a grid: tie-averaged rank sum over score groups."""
    return score.rank_auc(*_score_groups(spark, d))


@register("purchase_matrix_wide", q(f"""
SELECT c.code AS customer_code, list(p.article_id ORDER BY p.article_id) AS idx, list(p.n ORDER BY p.article_id) AS val
FROM (SELECT customer_id, article_id, count(*) AS n FROM transactions GROUP BY 1, 2) p
JOIN (SELECT customer_id, CAST(row_number() OVER (ORDER BY customer_id) - 1 AS BIGINT) AS code
      FROM (SELECT DISTINCT customer_id FROM customers)) c ON p.customer_id = c.customer_id
WHERE p.article_id IN (SELECT article_id FROM lifespans WHERE Last_Date >= DATE '{P.TEST_CUTOFF}')
GROUP BY c.code"""))
def purchase_matrix_wide(spark, d):
    """Customer × test-article purchase counts (E5): the bought articles of a
    customer and their counts."""
    from boutique.operators import encode, lifespan
    test = lifespan.last_sale_between(R.lifespans(spark, d), first_cutoff=P.TEST_CUTOFF)
    codes = encode.dense_codes(src.customers(spark, d), ["customer_id"], "code")
    long = prefs.purchase_matrix(src.transactions(spark, d), codes).join(
        test.select("article_id"), "article_id", "left_semi")
    return encode.wide_from_long(long.where("customer_code is not null"), "customer_code", "article_id", "n")


@register("target_class_count", q(f"""
SELECT CAST(count(DISTINCT article_id) AS BIGINT) AS n_classes
FROM lifespans WHERE Last_Date >= DATE '{P.TEST_CUTOFF}'"""))
def target_class_count(spark, d):
    """Distinct target classes of the article model."""
    from boutique.operators import lifespan
    test = lifespan.last_sale_between(R.lifespans(spark, d), first_cutoff=P.TEST_CUTOFF)
    return test.agg(F.countDistinct("article_id").cast("bigint").alias("n_classes"))


@register("customer_clusters")
def customer_clusters(spark, d):
    """Customer features ⟗ the k-means label of each customer (J11), joined
    on the key, not on row position (D11)."""
    return R.info(spark, d).join(kmeans_fit(spark, d), "customer_id", "full")


@register("segment_clusters")
def segment_clusters(spark, d):
    """Family-segment customers ⋈ their k-means label (J12), whose frequencies
    the surveyed value_counts reads."""
    part = R.segments(spark, d).filter(F.col("segment") == "family").select("customer_id")
    return part.join(kmeans_fit(spark, d), "customer_id", "inner")


def _given_labels(spark, d):
    """Labels by a rule, for customers with an odd age: not every customer has one."""
    return R.info(spark, d).where("age % 2 = 1").select("customer_id", (F.col("age") % 7).cast("int").alias("cluster"))


_LABELS_SQL = """,
given AS (SELECT customer_id, CAST(age % 7 AS INTEGER) AS cluster FROM cx_info WHERE age % 2 = 1)"""


@register("customer_labels_joined", q(_LABELS_SQL + """
SELECT coalesce(i.customer_id, g.customer_id) AS customer_id, i.FN, i.age, g.cluster
FROM cx_info i FULL JOIN given g ON i.customer_id = g.customer_id"""))
def customer_labels_joined(spark, d):
    """J11 on given labels."""
    return R.info(spark, d).select("customer_id", "FN", "age").join(_given_labels(spark, d), "customer_id", "full")


@register("segment_label_counts", q(_LABELS_SQL + """
SELECT s.segment, g.cluster, count(*) AS n FROM segs s JOIN given g ON s.customer_id = g.customer_id GROUP BY 1, 2"""))
def segment_label_counts(spark, d):
    """J12 on given labels, every segment with its label counts."""
    return (R.segments(spark, d).join(_given_labels(spark, d), "customer_id", "inner")
            .groupBy("segment", "cluster").agg(F.count(F.lit(1)).alias("n")))
