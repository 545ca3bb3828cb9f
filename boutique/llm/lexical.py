"""Ranked lexical search: the best documents of each query item, found in an
FP-tree of the documents by branch and bound.

1. One pass over the whole texts keeps, for each document, its length and the
   frequencies of the terms that some item asks for (its restricted vector);
   document frequencies, the number of documents and their length are summed by Spark.
2. A task takes some thousand vectors at a time. Terms are ordered by document
   frequency, the most frequent first, so that documents share the beginnings of
   their vectors: the paths of a trie. Paths without a fork are one node. Equal vectors
   are one entry with their smallest ids.
3. Each node has, over the documents below it, the largest frequency of every term and
   the smallest length norm m. A term's part of a score grows with the frequency
   and falls with m, so both bound the score of anything below.
4. Items go down depth first, the most promising branch first. An item leaves a branch
   whose bound is strictly below its ``TOP``-th score so far (an equal score may
   still win by a smaller id). Nodes carry the items that remain, so bounds and
   scores of several items are one matrix product, exact in integers.
5. Each task gives at most ``TOP`` rows per item; windows merge them in two steps.

Items are taken in blocks of at most ``BLOCK_PAIRS`` item-term pairs (an item is never cut);
only a block's terms are on the driver and sent to tasks.

A null, empty or term-free text has no terms: it is neither counted nor found. Rows
with the same id are documents of their own; a null id comes after all others at
an equal score. Item rows with the same id are one item with the terms of all. An
empty table, or an item without any known term, gives no rows.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from boutique.llm.common import scratch_path, written

TOP = 50
#: Item-term pairs of one pass over the documents.
BLOCK_PAIRS = 500_000
#: Items x terms of one tree (its dense weights take 8 bytes each).
CELLS = 1 << 22
#: Documents of a tree, at most, and of a leaf.
DOCS = 8192
LEAF = 64
#: Groups that the first merge deals the tasks' rows to.
MERGE_GROUPS = 64
PIECE_BYTES = 1 << 20
#: Stands for a missing id inside tasks: after all others.
NO_ID = np.iinfo(np.int64).max

SCHEMA = "item_id long, rank int, doc_id long, score long"

#: Bytes of terms: digits, letters and everything beyond ASCII; A-Z folded, the rest blank.
_FOLD = bytes(c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c > 0x7F else 0x20
              for c in range(256))


def term_pieces(text: str | None):
    """Lists of the terms (folded bytes) of a text, in order."""
    data = (text or "").encode().translate(_FOLD)
    at = 0
    while at < len(data):
        end = data.find(b" ", at + PIECE_BYTES)
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end


def _item_terms(batches):
    for batch in batches:
        ids, terms = [], []
        for one, text in zip(batch.column("item_id").to_pylist(), batch.column("text")):
            found = sorted({t for piece in term_pieces(text.as_py()) for t in piece})
            ids += [one] * len(found)
            terms += found
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(terms, pa.binary())], names=["item_id", "term"])


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, term): each item's terms once."""
    texts = items.select(F.col("item_id").cast("long").alias("item_id"), "text")
    return texts.mapInArrow(_item_terms, "item_id long, term binary").distinct()


def _restrict(vocabulary: dict[bytes, int]):
    """Documents as (id, n, terms, tfs), terms as numbers of the vocabulary."""
    def run(batches):
        for batch in batches:
            ns, terms, tfs = [], [], []
            for text in batch.column("text"):
                n, tf = 0, Counter()
                for piece in term_pieces(text.as_py()):
                    n += len(piece)
                    tf.update(map(vocabulary.get, piece))
                tf.pop(None, None)
                ns.append(n)
                terms.append(list(tf))
                tfs.append(list(tf.values()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(ns, pa.int64()), pa.array(terms, pa.list_(pa.int32())),
                 pa.array(tfs, pa.list_(pa.int64()))], names=["id", "n", "terms", "tfs"])
    return run


def weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def part(tf, m):
    """A term's part of a score before its weight."""
    return 1_000_000_000 * tf // (1000 * tf + 20 * m)


class Items:
    """Some items whose weights fill a dense table, and their best documents so far."""

    def __init__(self, items: list[tuple[int, dict[int, int]]]):
        """``items``: (number, {term rank: weight})."""
        self.number = np.array([i for i, _ in items], np.int64)
        self.ranks = np.array(sorted({r for _, w in items for r in w}), np.int64)
        place = {r: i for i, r in enumerate(self.ranks.tolist())}
        self.weights = np.zeros((len(self.ranks), len(items)), np.int64)
        for k, (_, w) in enumerate(items):
            for r, x in w.items():
                self.weights[place[r], k] = x
        # Parts are at most 10**6; doubles are exact up to 2**53.
        if self.weights.sum(axis=0).max(initial=0) * 1_000_000 < 1 << 53:
            self.weights = self.weights.astype(np.float64)
        self.score = np.zeros((len(items), TOP), np.int64)
        self.doc = np.full((len(items), TOP), NO_ID)
        self.held = np.zeros(len(items), np.int64)

    def scores(self, parts: np.ndarray, terms: np.ndarray, who: np.ndarray) -> np.ndarray:
        """Scores (documents x items) of parts given for the local ``terms``."""
        return (parts.astype(self.weights.dtype) @ self.weights[np.ix_(terms, who)]).astype(np.int64)

    def bar(self) -> np.ndarray:
        """The least score that can still enter."""
        return np.where(self.held == TOP, self.score[:, -1], 1)

    def merge(self, who: np.ndarray, score: np.ndarray, doc: np.ndarray) -> None:
        touched = np.unique(who)
        old = np.arange(TOP)[None, :] < self.held[touched][:, None]
        who = np.concatenate([np.repeat(touched, self.held[touched]), who])
        score = np.concatenate([self.score[touched][old], score])
        doc = np.concatenate([self.doc[touched][old], doc])
        order = np.lexsort((doc, -score, who))
        who, score, doc = who[order], score[order], doc[order]
        start = np.searchsorted(who, touched)
        size = np.diff(np.append(start, len(who)))
        place = np.arange(len(who)) - np.repeat(start, size)
        keep = place < TOP
        self.score[who[keep], place[keep]] = score[keep]
        self.doc[who[keep], place[keep]] = doc[keep]
        self.held[touched] = np.minimum(size, TOP)


class Tree:
    """FP-tree of documents given by flat entries: sorted by their sequences of term
    places, a node is a range of documents with a common beginning."""

    def __init__(self, ids, m, owner, terms, tf):
        """Entries (owner, terms, tf) ordered by owner, then by term."""
        first = np.searchsorted(owner, np.arange(len(ids) + 1))
        big, pair = terms.astype(">u4"), np.stack([terms, tf], axis=1) if len(terms) else np.zeros((0, 2), np.int64)
        alike: dict[bytes, list[int]] = {}
        for i in range(len(ids)):
            if first[i] < first[i + 1]:
                alike.setdefault(pair[first[i]:first[i + 1]].tobytes() + m[i].tobytes(), []).append(i)
        # Of equal vectors no more than TOP can be among an item's best: the smallest ids.
        groups = [sorted(ids[g].tolist())[:TOP] if len(g) > 1 else [int(ids[g[0]])] for g in alike.values()]
        one = [g[0] for g in alike.values()]
        path = [big[first[i]:first[i + 1]].tobytes() for i in one]
        order = sorted(range(len(one)), key=path.__getitem__)
        self.docs = [groups[k] for k in order]
        chosen = np.array([one[k] for k in order], np.int64)
        self.m = m[chosen]
        size = (first[1:] - first[:-1])[chosen]
        self.first = np.concatenate(([0], np.cumsum(size)))
        at = np.repeat(first[chosen] - self.first[:-1], size) + np.arange(self.first[-1])
        self.terms, self.tf = terms[at], tf[at]
        self.common = np.array([_common(path[a], path[b]) for a, b in zip(order, order[1:])], np.int64)

    def children(self, low: int, high: int) -> list[tuple[int, int]]:
        """Ranges of the branches of a node, none with over half of its documents
        (such a branch is replaced by its own); small neighbours are one leaf."""
        half, ranges, todo = (high - low) // 2, [], [(low, high)]
        while todo:
            a, b = todo.pop()
            if b - a <= max(half, 1):
                ranges.append((a, b))
                continue
            inner = self.common[a:b - 1]
            edges = [a, *(a + 1 + np.flatnonzero(inner == inner.min())).tolist(), b]
            todo += list(zip(edges, edges[1:]))[::-1]
        out = []
        for a, b in ranges:
            if out and out[-1][0] + LEAF >= b:
                out[-1] = (out[-1][0], b)
            else:
                out.append((a, b))
        return out


def _common(a: bytes, b: bytes) -> int:
    """Terms that two paths have in common at the beginning."""
    n = min(len(a), len(b)) // 4
    x, y = np.frombuffer(a, ">u4", n), np.frombuffer(b, ">u4", n)
    differ = np.flatnonzero(x != y)
    return int(differ[0]) if len(differ) else n


class Node:
    """A range of documents with the largest frequency of every term below and the smallest m."""

    __slots__ = ("low", "high", "below", "terms", "tf", "m")

    def __init__(self, tree: Tree, low: int, high: int, width: int):
        self.low, self.high = low, high
        # Branches have at most half of the documents, so this nests no deeper than their logarithm.
        self.below = [Node(tree, a, b, width) for a, b in tree.children(low, high)] if high - low > LEAF else []
        most = np.zeros(width, np.int64)
        if self.below:
            for x in self.below:
                most[x.terms] = np.maximum(most[x.terms], x.tf)
        else:
            some = slice(tree.first[low], tree.first[high])
            np.maximum.at(most, tree.terms[some], tree.tf[some])
        self.terms = np.flatnonzero(most)
        self.tf = most[self.terms]
        self.m = tree.m[low:high].min()


def search(tree: Tree, items: Items) -> None:
    """Enter the best documents of ``tree``."""
    if not len(tree.docs):
        return
    width = len(items.ranks)
    todo = [(Node(tree, 0, len(tree.docs), width), np.arange(len(items.number)), None)]
    while todo:
        node, who, upper = todo.pop()
        if upper is not None:
            who = who[upper >= items.bar()[who]]
        if not len(who):
            continue
        if not node.below:
            _leaf(tree, node, who, items)
            continue
        ways = []
        for x in node.below:
            upper = items.scores(part(x.tf, x.m)[None, :], x.terms, who)[0]
            some = np.flatnonzero(upper >= items.bar()[who])
            if len(some):
                ways.append((int(upper[some].max()), x, who[some], upper[some]))
        todo += [w[1:] for w in sorted(ways, key=lambda w: w[0])]


def _leaf(tree: Tree, node: Node, who: np.ndarray, items: Items) -> None:
    for low in range(node.low, node.high, LEAF):
        high = min(low + LEAF, node.high)
        some = slice(tree.first[low], tree.first[high])
        owner = np.repeat(np.arange(high - low), np.diff(tree.first[low:high + 1]))
        parts = np.zeros((high - low, len(node.terms)), np.int64)
        parts[owner, np.searchsorted(node.terms, tree.terms[some])] = part(tree.tf[some], tree.m[low:high][owner])
        scores = items.scores(parts, node.terms, who)
        d, a = np.nonzero(scores >= items.bar()[who][None, :])
        if len(d):
            size = np.array([len(tree.docs[low + i]) for i in d])
            docs = np.concatenate([tree.docs[low + i] for i in d]).astype(np.int64)
            items.merge(np.repeat(who[a], size), np.repeat(scores[d, a], size), docs)


def _flat(batch, low: int, high: int, rank: np.ndarray, norm):
    """ids, m and entries (owner, rank, tf) of rows of a batch."""
    some = batch.slice(low, high - low)
    ids = some.column("id").fill_null(int(NO_ID)).to_numpy(zero_copy_only=False)
    m = norm(some.column("n").to_numpy(zero_copy_only=False))
    terms, tfs = some.column("terms"), some.column("tfs")
    size = np.diff(terms.offsets.to_numpy(zero_copy_only=False))
    owner = np.repeat(np.arange(high - low), size)
    return ids, m, owner, rank[terms.flatten().to_numpy(zero_copy_only=False)], tfs.flatten().to_numpy(zero_copy_only=False)


def _searching(groups: list[list[tuple[int, dict[int, int]]]], rank: np.ndarray, documents: int, length: int):
    def norm(n):
        return np.array([50 + 50 * x * documents // length for x in n.tolist()], np.int64)

    def run(batches):
        parts = [Items(g) for g in groups]
        for batch in batches:
            for low in range(0, batch.num_rows, DOCS):
                ids, m, owner, r, tf = _flat(batch, low, min(low + DOCS, batch.num_rows), rank, norm)
                for items in parts:
                    at = np.minimum(np.searchsorted(items.ranks, r), len(items.ranks) - 1)
                    mine = np.flatnonzero(items.ranks[at] == r)
                    mine = mine[np.lexsort((at[mine], owner[mine]))]
                    step = max(LEAF, min(DOCS, LEAF * (CELLS // max(1, len(items.ranks)))))
                    own = owner[mine]
                    for a in range(0, len(ids), step):
                        cut = mine[np.searchsorted(own, a):np.searchsorted(own, a + step)]
                        search(Tree(ids[a:a + step], m[a:a + step], owner[cut] - a, at[cut], tf[cut]), items)
        for items in parts:
            who, place = np.nonzero(np.arange(TOP)[None, :] < items.held[:, None])
            doc = items.doc[who, place]
            yield pa.RecordBatch.from_arrays(
                [pa.array(items.number[who], pa.int32()), pa.array(doc, pa.int64(), mask=doc == NO_ID),
                 pa.array(items.score[who, place], pa.int64())], names=["q", "doc_id", "score"])
    return run


def _groups(items: list[tuple[int, dict[int, int]]]) -> list[list]:
    """Items dealt to trees of at most CELLS weights."""
    out, ranks = [], set()
    for one in items:
        if not out or (len(out[-1]) + 1) * len(ranks | one[1].keys()) > CELLS:
            out.append([])
            ranks = set()
        out[-1].append(one)
        ranks |= one[1].keys()
    return out


def _best(found: DataFrame, *more: str) -> DataFrame:
    order = Window.partitionBy("q", *more).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= TOP)


def ranked_search(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The ``TOP`` best rows of ``docs`` (doc_id, text) for each item of ``items``
    (item_id, text), as ``SCHEMA``."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), "text")
    pairs = written(item_terms(items), "item_terms")
    blocks = -(-pairs.count() // BLOCK_PAIRS)
    out = scratch_path(spark, "ranked")
    spark.createDataFrame([], SCHEMA).write.parquet(out)
    for b in range(blocks):
        own: dict = {}
        for r in pairs.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b).collect():
            own.setdefault(r["item_id"], []).append(bytes(r["term"]))
        if not own:
            continue
        numbers = sorted(own, key=lambda i: (i is None, i))
        vocabulary = {t: i for i, t in enumerate(sorted({t for some in own.values() for t in some}))}
        vectors = written(texts.mapInArrow(_restrict(vocabulary), "id long, n long, terms array<int>, tfs array<long>"),
                          "restricted").where("n > 0")
        total = vectors.agg(F.count("*").alias("n"), F.coalesce(F.sum("n"), F.lit(0)).alias("length")).first()
        dfs = np.zeros(len(vocabulary), np.int64)
        for r in vectors.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count("*").alias("df")).collect():
            dfs[r["t"]] = r["df"]
        rank = np.empty(len(vocabulary), np.int64)
        rank[np.lexsort((np.arange(len(dfs)), -dfs))] = np.arange(len(dfs))
        asked = [(i, {int(rank[v]): weight(total["n"], int(dfs[v])) for t in own[one] if dfs[v := vocabulary[t]]})
                 for i, one in enumerate(numbers)]
        asked = [(i, w) for i, w in asked if w]
        if not asked:
            continue
        found = vectors.where(F.size("terms") > 0).mapInArrow(
            _searching(_groups(asked), rank, total["n"], total["length"]), "q int, doc_id long, score long")
        few = _best(found.withColumn("part", F.spark_partition_id() % MERGE_GROUPS), "part").drop("rank", "part")
        names = spark.createDataFrame([(i, one) for i, one in enumerate(numbers)], "q int, item_id long")
        (_best(few).join(names, "q").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
         .write.mode("append").parquet(out))
    return spark.read.schema(SCHEMA).parquet(out)


RANKED_SQL = """
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[0-9a-z\\x{80}-\\x{10FFFF}]+') AS ws FROM documents),
t AS (SELECT doc_id, len(ws) AS n, ws FROM d WHERE len(ws) > 0),
s AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS length FROM t),
q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\\x{80}-\\x{10FFFF}]+')) AS term
  FROM benchmark),
u AS (SELECT doc_id, n, unnest(ws) AS term FROM t),
f AS (SELECT doc_id, n, term, count(*) AS tf FROM u WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM f, s GROUP BY term, docs),
r AS (
  SELECT q.item_id, f.doc_id,
         CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // length)))) AS BIGINT) AS score
  FROM q JOIN f USING (term) JOIN w USING (term), s GROUP BY 1, 2)
SELECT * FROM (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
  FROM r WHERE score > 0)
WHERE rank <= 50
"""
