"""Customer → preference regression from distributed sufficient statistics
(M1-M5, M7, M8 first half).

The surveyed network has no activations, so its map from (age category,
customer columns, cluster columns) to the 620 preference shares is linear.
It is fitted here as a multi-output L1 regression: one distributed pass
builds XᵀX and XᵀY (sizes set by the feature count, not the row count),
and a coordinate-descent solve on those small matrices runs on the driver.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from boutique import params
from boutique.operators import blocks

INFO_COLS = params.INFO_COLS
CLUSTER_COLS = params.CLUSTER_COLS


def age_category(info: DataFrame, n_cat: int = params.AGE_CATEGORIES) -> DataFrame:
    """Age (already shifted) clipped to 0..n_cat-1 as a category (M4)."""
    return info.select("customer_id", F.least(F.greatest(F.col("age"), F.lit(0)),
                                               F.lit(n_cat - 1)).cast("int").alias("age_idx"))


def standardise(df: DataFrame, cols: list[str]) -> DataFrame:
    """(x − mean) / population std per column (M3); a constant column gives
    0. Mean and std come from one global aggregate."""
    stats = df.agg(*[F.avg(c).alias(f"m_{i}") for i, c in enumerate(cols)],
                   *[F.stddev_pop(c).alias(f"s_{i}") for i, c in enumerate(cols)]).first()
    out = df
    for i, c in enumerate(cols):
        m, s = stats[f"m_{i}"] or 0.0, stats[f"s_{i}"] or 0.0
        out = out.withColumn(c, (F.col(c) - F.lit(m)) / F.lit(s) if s > 0 else F.lit(0.0))
    return out


def model_inputs(info: DataFrame, shares: DataFrame | None, extra: DataFrame | None = None,
                 extra_cols: list[str] | None = None) -> DataFrame:
    """One row per customer that has preferences (J10, P2): age category
    and the customer columns (plus optional standardised cluster columns)."""
    x = info.select("customer_id", *[F.col(f"`{c}`").cast("double").alias(c) for c in INFO_COLS],
                    F.least(F.greatest(F.col("age"), F.lit(0)),
                            F.lit(params.AGE_CATEGORIES - 1)).cast("int").alias("age_idx"))
    if extra is not None:
        x = x.join(extra.select("customer_id", *extra_cols), "customer_id", "left").na.fill(
            0.0, subset=extra_cols)
    has_prefs = shares.select("customer_id").distinct()
    return x.join(has_prefs, "customer_id", "inner")


def gram(x: DataFrame, shares: DataFrame, cols: list[str], group: str | None = None,
         n_age: int = params.AGE_CATEGORIES) -> DataFrame:
    """Long Gram entries (grp, block, i, j, value): block 'xx' holds XᵀX
    (i ≤ j) and 'xy' holds XᵀY with j = feature_idx, over the customers
    that have preference rows.

    One pass: each preference row is joined to its customer's single X row
    (no pair blow-up), the customer's first row (a window over the join's
    customer partitioning, ≤ feature-count rows per customer) carries the
    XᵀX terms, and one aggregate per (age, feature) yields both blocks."""
    g = [group] if group else []
    base = 1 + n_age
    xc = [F.col(f"`{c}`") for c in cols]
    ys = shares.select("customer_id", "feature_idx", "share").join(x, "customer_id", "inner")
    first = (F.row_number().over(Window.partitionBy("customer_id").orderBy("feature_idx")) == 1)
    ys = ys.withColumn("_f", first.cast("double"))
    f = F.col("_f")
    per = ys.groupBy(*g, "age_idx", "feature_idx").agg(
        F.sum(f).alias("n"),
        *[F.sum(f * c).alias(f"s{p}") for p, c in enumerate(xc)],
        *[F.sum(f * xc[p] * xc[q]).alias(f"s{p}_{q}")
          for p in range(len(cols)) for q in range(p, len(cols))],
        F.sum("share").alias("y"),
        *[F.sum(F.col("share") * c).alias(f"y{p}") for p, c in enumerate(xc)])
    # Every Gram entry a group row contributes, as one SQL array expression
    # (one parse instead of hundreds of column objects). c counts the
    # contributing customers, so an entry exists exactly when some customer
    # contributes to it (even if its value is 0).
    def entry(block: str, i: str, j: str, v: str) -> str:
        c = "n" if block == "xx" else "1.0D"
        return (f"named_struct('block', '{block}', 'i', CAST({i} AS BIGINT), "
                f"'j', CAST({j} AS BIGINT), 'v', CAST({v} AS DOUBLE), 'c', CAST({c} AS DOUBLE))")

    age_i, fj = "age_idx + 1", "feature_idx"
    entries = [entry("xx", "0", "0", "n"), entry("xx", "0", age_i, "n"),
               entry("xx", age_i, age_i, "n")]
    for p in range(len(cols)):
        entries += [entry("xx", "0", str(base + p), f"s{p}"),
                    entry("xx", age_i, str(base + p), f"s{p}")]
        entries += [entry("xx", str(base + p), str(base + q), f"s{p}_{q}")
                    for q in range(p, len(cols))]
    entries += [entry("xy", "0", fj, "y"), entry("xy", age_i, fj, "y")]
    entries += [entry("xy", str(base + p), fj, f"y{p}") for p in range(len(cols))]
    exploded = F.expr(f"explode(array({', '.join(entries)}))")
    out = (per.select(*g, exploded.alias("e"))
           .groupBy(*g, F.col("e.block").alias("block"), F.col("e.i").alias("i"),
                    F.col("e.j").alias("j"))
           .agg(F.sum("e.v").alias("value"), F.sum("e.c").alias("_c")))
    return out.filter(F.col("_c") > 0).select(*g, "block", "i", "j", "value")


def vector_gram(x: DataFrame, vecs: DataFrame, cols: list[str], width: int, group: str | None = None,
                n_age: int = params.AGE_CATEGORIES) -> DataFrame:
    """The non-zero entries of :func:`gram` from share vectors (customer_id, prefs): a task
    multiplies matrices of its rows and sends one row of sums per input column, which
    meet by column. A customer's first row carries the X'X terms there too."""
    base = 1 + n_age
    p = base + len(cols)
    first = F.row_number().over(Window.partitionBy("customer_id").orderBy("age_idx")) == 1
    rows = x.join(vecs.select("customer_id", "prefs"), "customer_id", "inner").select(
        (F.col(group) if group else F.lit("")).alias("grp"), first.cast("double").alias("f"), "age_idx", "prefs",
        *[F.col(f"`{c}`").cast("double").alias(f"x{i}") for i, c in enumerate(cols)])

    def batch_of(sums):
        keys = [(g, i) for g in sums for i in range(p)]
        return pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int32()),
             pa.array([sums[g][i].tobytes() for g, i in keys], pa.binary())], names=["grp", "i", "s"])

    def products(batches):
        sums: dict = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            n = batch.num_rows
            a = np.zeros((n, p))
            a[:, 0] = 1.0
            a[np.arange(n), 1 + batch.column("age_idx").to_numpy(zero_copy_only=False)] = 1.0
            for c in range(len(cols)):
                a[:, base + c] = batch.column(f"x{c}").to_numpy(zero_copy_only=False)
            f = batch.column("f").to_numpy(zero_copy_only=False)
            y = blocks.matrix(batch.column("prefs"))
            groups = np.array(batch.column("grp").to_pylist(), dtype=object)
            for g in dict.fromkeys(groups):
                at = groups == g
                one = np.hstack((a[at].T @ (a[at] * f[at, None]), a[at].T @ y[at]))
                sums[g] = sums[g] + one if g in sums else one
        yield batch_of(sums)

    def merged(batches):
        held: dict = {}
        for batch in batches:
            for g, i, s in zip(batch.column("grp").to_pylist(), batch.column("i").to_pylist(), batch.column("s")):
                one = np.frombuffer(s.as_buffer(), float)
                held[g, i] = held[g, i] + one if (g, i) in held else one
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in held], pa.string()), pa.array([k[1] for k in held], pa.int64()),
             pa.array([v.tolist() for v in held.values()], pa.list_(pa.float64()))], names=["grp", "i", "v"])

    whole = rows.mapInArrow(products, "grp string, i int, s binary").repartition(blocks.MERGERS, "grp", "i").mapInArrow(
        merged, "grp string, i long, v array<double>")
    long = whole.select("grp", "i", F.posexplode("v").alias("j", "value")).where((F.col("value") != 0) & (F.col("j") >= F.col("i")))
    entry = F.col("j") < p
    return long.select(*([F.col("grp").alias(group)] if group else []), F.when(entry, "xx").otherwise("xy").alias("block"), "i",
                       F.when(entry, F.col("j")).otherwise(F.col("j") - p).cast("long").alias("j"), "value")


#: Sums of squares about the mean up to this count as none (a constant column).
CONSTANT = 1e-9


def marginal_coefs(gram_df: DataFrame, cols: int, n_age: int = params.AGE_CATEGORIES) -> DataFrame:
    """(x_idx, feature_idx, coef) of a model in closed form, as joins of Gram
    entries: an age category predicts its mean shares, and each of ``cols``
    columns adds its slope taken alone, divided by their number."""
    base = 1 + n_age
    g = gram_df.checkpoint(eager=True)
    xx, xy = g.where("block = 'xx'"), g.where("block = 'xy'").select(F.col("i").alias("x_idx"), F.col("j").alias("feature_idx"), "value")
    n = xx.where("i = 0 and j = 0").first()
    n = n["value"] if n else 0.0
    sums = xx.where((F.col("i") == 0) & (F.col("j") > 0)).select(F.col("j").alias("x_idx"), F.col("value").alias("s"))
    squares = xx.where((F.col("i") == F.col("j")) & (F.col("j") >= base)).select(F.col("j").alias("x_idx"), F.col("value").alias("ss"))
    spread = F.col("ss") - F.col("s") * F.col("s") / n
    totals = xy.where("x_idx = 0").select("feature_idx", F.col("value").alias("y"))
    slope = (xy.where(F.col("x_idx") >= base).join(sums.join(squares, "x_idx").where(spread > CONSTANT), "x_idx").join(totals, "feature_idx")
             .select("x_idx", "feature_idx", ((F.col("value") - F.col("s") * F.col("y") / n) / spread / cols).alias("coef"),
                     (F.col("s") / n).alias("m")))
    bias = slope.groupBy("feature_idx").agg((-F.sum(F.col("coef") * F.col("m"))).alias("coef")).select(
        F.lit(0).cast("long").alias("x_idx"), "feature_idx", "coef")
    ages = xy.where((F.col("x_idx") > 0) & (F.col("x_idx") < base)).join(sums, "x_idx").select(
        "x_idx", "feature_idx", (F.col("value") / F.col("s")).alias("coef"))
    return bias.unionByName(ages).unionByName(slope.select("x_idx", "feature_idx", "coef"))


def lasso_gram(G: np.ndarray, C: np.ndarray, n: float, lam: float | np.ndarray,
               tol: float = 1e-8, max_iter: int = 5000) -> np.ndarray:
    """Minimise (1/2n)‖Y − XB‖² + lam Σ_{i≥1} |B_i| (row 0 = unpenalised
    bias) by coordinate descent on the Gram: G = XᵀX, C = XᵀY. All
    targets are updated together; ``lam`` may differ by target. Raises if
    ``max_iter`` sweeps do not converge."""
    p, f = C.shape
    B = np.zeros((p, f))
    Gn, Cn = G / n, C / n
    diag = np.diag(Gn).copy()
    GB = np.zeros((p, f))
    for _ in range(max_iter):
        delta = 0.0
        for j in range(p):
            if diag[j] <= 0:
                continue
            rho = Cn[j] - GB[j] + diag[j] * B[j]
            if j == 0:
                new = rho / diag[j]
            else:
                new = np.sign(rho) * np.maximum(np.abs(rho) - lam, 0.0) / diag[j]
            step = new - B[j]
            if np.any(step != 0):
                GB += np.outer(Gn[:, j], step)
                B[j] = new
                delta = max(delta, float(np.abs(step).max()))
        if delta < tol:
            return B
    raise RuntimeError(f"no convergence in {max_iter} sweeps: last step {delta:.3g}")


#: Ridge of the reduced-rank solve, on standardised columns.
RIDGE = 1e-3


def standardised_gram(G: np.ndarray, C: np.ndarray, n: float):
    """(live, mean, sd, y_mean, S, T): columns that vary, and the Gram of the
    standardised columns and centred targets, divided by n."""
    mean, y_mean = G[0] / n, C[0] / n
    sd = np.sqrt(np.maximum(np.diag(G) / n - mean ** 2, 0.0))
    sd[0] = 0.0
    live = np.flatnonzero(sd > 1e-12)
    S = (G[np.ix_(live, live)] / n - np.outer(mean[live], mean[live])) / np.outer(sd[live], sd[live])
    T = (C[live] / n - np.outer(mean[live], y_mean)) / sd[live][:, None]
    return live, mean, sd, y_mean, S, T


def _raw_scale(Z: np.ndarray, shape, live, mean, sd, y_mean) -> np.ndarray:
    """Coefficients on the raw scale, row 0 the bias."""
    B = np.zeros(shape)
    B[live] = Z / sd[live][:, None]
    B[0] = y_mean - mean[live] @ B[live]
    return B


def lasso_standardised(G: np.ndarray, C: np.ndarray, n: float, strength: float) -> np.ndarray:
    """L1 regression on standardised columns, from the Gram of the raw ones.

    Row 0 is the bias. Each target's penalty is ``strength`` times the
    smallest one that zeroes all its coefficients, max_j |corr(x_j, y)|.
    Columns that never vary get 0. Coefficients are returned on the raw
    scale."""
    live, mean, sd, y_mean, S, T = standardised_gram(G, C, n)
    Z = np.zeros(T.shape)
    if len(live):
        one = np.eye(1 + len(live))
        one[1:, 1:] = S
        Z = lasso_gram(one, np.vstack([np.zeros(C.shape[1]), T]), 1.0, strength * np.abs(T).max(axis=0))[1:]
    return _raw_scale(Z, C.shape, live, mean, sd, y_mean)


def reduced_rank(G: np.ndarray, C: np.ndarray, n: float, rank: int, ridge: float = RIDGE) -> np.ndarray:
    """Ridge regression on standardised columns whose coefficients (bias apart)
    have at most ``rank`` dimensions, as the surveyed network's have: the ridge solution
    projected onto the leading eigenvectors of its fitted covariance, which is the
    optimum under the cap. Same scale and bias as :func:`lasso_standardised`."""
    live, mean, sd, y_mean, S, T = standardised_gram(G, C, n)
    Z = np.linalg.solve(S + ridge * np.eye(len(live)), T) if len(live) else np.zeros(T.shape)
    if min(Z.shape, default=0) > rank:
        _, vectors = np.linalg.eigh(T.T @ Z)
        V = vectors[:, -rank:]
        Z = Z @ V @ V.T
    return _raw_scale(Z, C.shape, live, mean, sd, y_mean)


def lasso_conditions(G, C, n, strength: float, B: np.ndarray, tol: float = 1e-6) -> np.ndarray:
    """For each target, whether coefficients meet the optimality conditions of
    :func:`lasso_standardised`: the gradient of a non-zero coefficient equals the penalty
    with its sign, that of a zero one stays within it, and the bias fits the means."""
    live, mean, sd, y_mean, S, T = standardised_gram(G, C, n)
    Z = B[live] * sd[live][:, None]
    gradient = T - S @ Z
    penalty = strength * np.abs(T).max(axis=0, initial=0.0)
    on = np.where(Z != 0, np.abs(gradient - penalty * np.sign(Z)), np.maximum(np.abs(gradient) - penalty, 0.0))
    bias = np.abs(B[0] + mean[live] @ B[live] - y_mean)
    still = np.setdiff1d(np.arange(1, len(B)), live)
    return (on.max(axis=0, initial=0.0) <= tol) & (bias <= tol) & (B[still] == 0).all(axis=0)


def rank_conditions(G, C, n, rank: int, B: np.ndarray, ridge: float = RIDGE, tol: float = 1e-6) -> np.ndarray:
    """For each target, whether coefficients are the optimum of :func:`reduced_rank`:
    at most ``rank`` dimensions, no gradient left inside them, and none of the dimensions left out
    explains more than any kept one."""
    live, mean, sd, y_mean, S, T = standardised_gram(G, C, n)
    Z = B[live] * sd[live][:, None]
    A = S + ridge * np.eye(len(live))
    _, size, rows = np.linalg.svd(Z, full_matrices=False) if Z.size else (None, np.zeros(0), np.zeros((0, C.shape[1])))
    V = rows[size > 1e-9 * max(size.max(initial=0.0), 1e-300)].T
    inside = (T - A @ Z) @ V @ V.T
    kept = np.linalg.eigvalsh(V.T @ T.T @ np.linalg.solve(A, T @ V)) if V.size else np.zeros(0)
    rest = T - T @ V @ V.T
    left = np.linalg.eigvalsh(rest.T @ np.linalg.solve(A, rest)).max(initial=0.0) if Z.size else 0.0
    whole = V.shape[1] <= rank and (V.shape[1] < rank or left <= kept.min(initial=np.inf) + tol)
    bias = np.abs(B[0] + mean[live] @ B[live] - y_mean)
    return whole & (np.abs(inside).max(axis=0, initial=0.0) <= tol) & (bias <= tol)


def dense_gram(entries: pd.DataFrame, p: int, width: int) -> tuple[np.ndarray, np.ndarray, float]:
    G = np.zeros((p, p))
    C = np.zeros((p, width))
    xx = entries[entries.block == "xx"]
    G[xx.i.to_numpy(), xx.j.to_numpy()] = xx.value.to_numpy()
    G = np.triu(G) + np.triu(G, 1).T
    xy = entries[entries.block == "xy"]
    C[xy.i.to_numpy(), xy.j.to_numpy()] = xy.value.to_numpy()
    return G, C, G[0, 0]


def fit_pref_regression(gram_df: DataFrame, p: int, width: int, lam: float = params.L1_STRENGTH,
                        group: str | None = None, groups: list[str] | None = None,
                        rank: int | None = None) -> DataFrame:
    """Solve the L1 regression, or with ``rank`` the one of capped rank, from
    Gram entries (bounded: p² + p·width numbers per group). Returns (grp?, x_idx,
    feature_idx, coef) for non-zero coefficients (M1, M7)."""
    spark = gram_df.sparkSession
    pdf = gram_df.toPandas()
    rows = []
    keys = [None] if group is None else (groups or sorted(pdf[group].unique()))
    for key in keys:
        part = pdf if group is None else pdf[pdf[group] == key]
        if group is not None and part.empty:
            continue
        G, C, n = dense_gram(part, p, width)
        if n <= 0:
            continue
        B = lasso_standardised(G, C, n, lam) if rank is None else reduced_rank(G, C, n, rank)
        nz = np.argwhere(B != 0)
        rows += [((key,) if group else ()) + (int(i), int(f), float(B[i, f])) for i, f in nz]
    schema = ("" if group is None else f"{group} string, ") + "x_idx long, feature_idx long, coef double"
    return spark.createDataFrame(rows, schema)


def coef_matrix(coefs: DataFrame, p: int, width: int, group: str | None = None,
                key: str | None = None) -> np.ndarray:
    """Dense p × width coefficients of one fit (bounded by feature counts)."""
    c = coefs if group is None else coefs.filter(F.col(group) == key)
    B = np.zeros((p, width))
    for r in c.select("x_idx", "feature_idx", "coef").collect():
        B[int(r[0]), int(r[1])] = float(r[2])
    return B


def predict_prefs(x: DataFrame, B: np.ndarray, cols: list[str],
                  n_age: int = params.AGE_CATEGORIES) -> DataFrame:
    """(customer_id, pred array<double>[width]) with
    pred = b0 + b_age + Σ_p x_p b_p (first half of M8): one matrix product
    per Arrow batch with the coefficients, whose size the feature counts
    bound."""
    base = 1 + n_age
    ages, rest = B[0] + B[1:base], B[base:base + len(cols)]

    def run(batches):
        for pdf in batches:
            values = pdf[[f"x{i}" for i in range(len(cols))]].to_numpy(float)
            pred = ages[pdf["age_idx"].to_numpy(int)] + values @ rest
            yield pd.DataFrame({"customer_id": pdf["customer_id"], "pred": list(pred)})

    kind = x.schema["customer_id"].dataType.simpleString()
    narrow = x.select("customer_id", "age_idx", *[F.col(f"`{c}`").cast("double").alias(f"x{i}")
                                                 for i, c in enumerate(cols)])
    return narrow.mapInPandas(run, f"customer_id {kind}, pred array<double>")
