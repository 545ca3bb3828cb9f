"""Mixing sources to target weights by a min-cost flow.

Documents are aggregated by membership pattern (the set of sources a document
belongs to). Each pattern offers its words three times, the repetitions at rising
(convex) cost; each source asks for its target. The cheapest flow from patterns to
sources says how many words each pattern gives; sources without overlap need no flow. The driver
holds one row per pattern and source, whatever the number of documents. Within a pattern
the documents are taken in the order of a seeded hash: whole repetitions for
all, then one more for the first ones, up to the exact number of words; the
document on the boundary gives the words that remain.

The order needs no sort of a whole source: words are summed in 4,096 hash
buckets, and only the bucket on the boundary is ranked.

Null and empty texts have size 0 and give nothing. Repeated rows are documents
of their own. Null sources are one source, last in order.
"""

from __future__ import annotations

from collections import deque

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from boutique.llm.common import written

WEIGHTS = (1, 2, 3)
MAX_REPEATS = 3
#: Cost of a word's first, second and third use.
REPEAT_COSTS = (0, 1, 3)
SEED = "mix"


def n_words(text_col: str = "text"):
    return F.coalesce(F.regexp_count(text_col, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: dict, weights=WEIGHTS, most: int = MAX_REPEATS) -> dict:
    """Words of each source: by weight, at most ``most`` times its size, the
    excess shared again by weight."""
    order = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total = float(sum(sizes.values()))
    # The source that reaches its bound first has the greatest weight per word.
    rest, share, out = total, float(sum(weight.values())), {}
    for s in sorted(order, key=lambda s: (-weight[s] / sizes[s] if sizes[s] else float("-inf"), order.index(s))):
        wish = rest * weight[s] / share if share else 0.0
        out[s] = min(wish, float(most * sizes[s]))
        if out[s] < wish:
            rest -= out[s]
            share -= weight[s]
    return out


def min_cost_flow(offers: dict, asks: dict, costs=REPEAT_COSTS) -> dict:
    """Words that each pattern (a tuple of sources) gives, so that as many
    words as possible of ``asks`` are met, at the least cost. Successive shortest paths;
    all quantities are whole numbers."""
    patterns, sources = list(offers), list(asks)
    start, end = 0, 1 + len(patterns) + len(sources)
    head, cap, cost, out_of = [], [], [], [[] for _ in range(end + 1)]

    def arc(u, v, c, w):
        for a, b, room, price in ((u, v, c, w), (v, u, 0, -w)):
            out_of[a].append(len(head))
            head.append(b)
            cap.append(room)
            cost.append(price)

    room = sum(asks.values())
    place = {s: 1 + len(patterns) + i for i, s in enumerate(sources)}
    for i, p in enumerate(patterns):
        for price in costs:
            arc(start, 1 + i, offers[p], price)
        for s in p:
            arc(1 + i, place[s], room, 0)
    for s in sources:
        arc(place[s], end, asks[s], 0)
    while True:
        best, via, waiting, queued = {start: 0}, {}, deque([start]), {start}
        while waiting:
            u = waiting.popleft()
            queued.discard(u)
            for k in out_of[u]:
                v = head[k]
                if cap[k] > 0 and best[u] + cost[k] < best.get(v, float("inf")):
                    best[v], via[v] = best[u] + cost[k], k
                    if v not in queued:
                        waiting.append(v)
                        queued.add(v)
        if end not in via:
            break
        path, v = [], end
        while v != start:
            path.append(via[v])
            v = head[via[v] ^ 1]
        amount = min(cap[k] for k in path)
        for k in path:
            cap[k] -= amount
            cap[k ^ 1] += amount
    given = {p: 0 for p in patterns}
    for i, p in enumerate(patterns):
        given[p] = sum(
            cap[k] for k in out_of[1 + i] if head[k] == start)
    return given


def routed(offers: dict, asks: dict) -> dict:
    """:func:`min_cost_flow` for sources that share patterns. A source of which
    no pattern overlaps another is met from its only pattern, as far as that reaches."""
    shared = {s for p in offers if len(p) > 1 for s in p}
    flow = {p: n for p, n in offers.items() if shared & set(p)}
    given = min_cost_flow(flow, {s: n for s, n in asks.items() if s in shared}) if flow else {}
    most = len(REPEAT_COSTS)
    return given | {p: min(asks[p[0]], most * n) if p else 0 for p, n in offers.items() if p not in flow}


def mix(docs: DataFrame, sources_col: str, id_col: str = "doc_id", text_col: str = "text",
        weights=WEIGHTS, seed: str = SEED) -> DataFrame:
    """id_col, sources, size and taken of each row; ``sources_col`` is an array
    of the sources the row belongs to (a row with none gives nothing)."""
    spark = docs.sparkSession
    key = F.array_join(F.transform("sources", lambda x: F.coalesce(F.concat(F.lit("="), x), F.lit("-"))), "\u0001")
    sized = docs.select(
        F.col(id_col).cast("long").alias("id"), n_words(text_col).alias("size"),
        F.array_sort(F.array_distinct(F.coalesce(F.col(sources_col), F.array().cast("array<string>")))).alias("sources"),
        F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit("")))).alias("h"))
    sized = written(sized.withColumn("pattern", key).withColumn("bucket", F.conv(F.substring("h", 1, 3), 16, 10).cast("int")),
                    "sizes")
    buckets = written(sized.groupBy("pattern", "bucket").agg(F.sum("size").alias("words")), "buckets")
    rows = sized.groupBy("pattern").agg(F.sum("size").alias("words"), F.first("sources").alias("sources")).collect()
    rows.sort(key=lambda r: r["pattern"])
    sizes: dict = {}
    for r in rows:
        for s in r["sources"]:
            sizes[s] = sizes.get(s, 0) + r["words"]
    # With overlap, a word counts once in what is shared out.
    total, wanted = sum(r["words"] for r in rows if r["sources"]), targets(sizes, weights)
    scale = total / sum(wanted.values()) if sum(wanted.values()) else 0.0
    wanted = {s: v * scale for s, v in wanted.items()} if abs(scale - 1) > 1e-9 else wanted
    order = {tuple(r["sources"]): r for r in rows}
    given = routed({p: r["words"] for p, r in order.items()}, {s: int(v) for s, v in wanted.items()})
    plan = [(r["pattern"], given[p] // r["words"] if r["words"] else 0, given[p] % r["words"] if r["words"] else 0)
            for p, r in order.items()]
    plan = spark.createDataFrame(plan, "pattern string, rounds long, rest long")

    before = F.sum("words").over(Window.partitionBy("pattern").orderBy("bucket")
                                 .rowsBetween(Window.unboundedPreceding, -1))
    edge = (buckets.withColumn("below", F.coalesce(before, F.lit(0))).join(F.broadcast(plan), "pattern")
            .where("below <= rest and rest < below + words")
            .groupBy("pattern").agg(F.min("bucket").alias("edge"), F.min("below").alias("below")))
    edges = plan.join(edge, "pattern", "left")  # one row for each pattern
    placed = sized.join(F.broadcast(edges), "pattern")
    inside = F.sum("size").over(Window.partitionBy("pattern").orderBy("h", "id", "size")
                                .rowsBetween(Window.unboundedPreceding, -1))
    on_edge = placed.where("bucket = edge").withColumn(
        "part", F.greatest(F.lit(0), F.least("size", F.col("rest") - F.col("below") - F.coalesce(inside, F.lit(0)))))
    off_edge = placed.where("edge is null or bucket != edge").withColumn(
        "part", F.when(F.col("bucket") < F.col("edge"), F.col("size")).otherwise(F.lit(0)))
    return on_edge.unionByName(off_edge).select(
        F.col("id").alias(id_col), "sources", "size", (F.col("rounds") * F.col("size") + F.col("part")).alias("taken"))


def mixed_documents(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target and taken of documents with one source
    each; one row for each row of ``docs``."""
    own = docs.select("doc_id", "text", F.array("source").alias("sources"))
    done = mix(own, "sources").withColumn("source", F.get("sources", F.lit(0)))
    done = written(done, "mix")
    rows = done.groupBy("source").agg(F.sum("size").alias("n")).collect()
    wanted = targets({r["source"]: r["n"] for r in rows})
    sizes = docs.sparkSession.createDataFrame(
        [(r["source"], r["n"], wanted[r["source"]]) for r in rows], "s string, source_size long, target double")
    return done.join(F.broadcast(sizes), F.col("source").eqNullSafe(F.col("s"))).select(
        "doc_id", "size", "source_size", "target", "taken")


MIX_SQL = """
WITH d AS (
  SELECT doc_id, source,
         CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size,
         md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS n,
         (row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1) % 3 + 1 AS w
  FROM d GROUP BY source),
r AS (
  SELECT *, row_number() OVER (ORDER BY CASE WHEN n = 0 THEN -1e300 ELSE -w / CAST(n AS DOUBLE) END,
                               source IS NULL, encode(source)) AS k,
         CAST(sum(n) OVER () AS DOUBLE) AS total FROM s),
a AS (
  SELECT *, total - coalesce(sum(3 * n) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
         sum(w) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS share FROM r),
c AS (SELECT *, 3.0 * n < rest * w / share AS capped FROM a),
f AS (SELECT coalesce(min(k), 1e9) AS k FROM c WHERE NOT capped),
g AS (SELECT rest, share FROM c, f WHERE c.k = f.k),
t AS (
  SELECT source, n, CASE WHEN c.k < f.k THEN 3.0 * n
                         ELSE (SELECT rest / share FROM g) * w END AS target FROM c, f),
p AS (
  SELECT source, n, CAST(target AS DOUBLE) AS target,
         CASE WHEN n = 0 THEN 0 ELSE CAST(floor(target) AS BIGINT) // n END AS rounds,
         CASE WHEN n = 0 THEN 0 ELSE CAST(floor(target) AS BIGINT) % n END AS rest FROM t),
q AS (
  SELECT d.*, p.n, p.target, p.rounds, p.rest,
         coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY h, doc_id, size
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
  FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, n AS source_size, target,
       CAST(rounds * size + greatest(0, least(size, rest - below)) AS BIGINT) AS taken
FROM q
"""
