"""A divisive tree over the rows of several groups at once.

The surveyed agglomerative trees are quadratic in rows. Here every group (a segment, or all
customers) is split top-down: each round takes the leaves whose sums of squares are among the
largest of all nodes and splits all of them, of all groups, by two-way k-means in common
passes over the rows, until the nodes with the largest sums are all split.
A pass sends down the fitted splits and returns one row of sums per node from each task;
the driver keeps one pair of centres per split, bounded by the number of leaves asked for.

A node is named by its path of 0 and 1, so paths in order are the leaves in order, and
the cut at k clusters opens the nodes with the largest sums of squares first.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boutique.operators import blocks
from boutique.operators.encode import dense_codes

#: Two-way k-means steps of a round, at most.
STEPS = 5
#: Rows that a task adds up before it sends its sums.
ROWS_AT_ONCE = 1 << 22
#: Numbers of a block of vectors: its rows go down the tree together, node by node, so
#: blocks much larger than the number of nodes keep the work per row even.
BLOCK_NUMBERS = 1 << 19


def _sides(x: np.ndarray, split: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """True for the rows nearer to the second centre; ties (to nine digits) to the first."""
    a, b = split
    return np.round(x @ (b - a) - ((b * b).sum() - (a * a).sum()) / 2, 9) > 0


def descend(x: np.ndarray, splits: dict[str, tuple]) -> list[tuple[str, np.ndarray]]:
    """(path, rows) of the leaves that the rows of ``x`` reach."""
    out, todo = [], [("", np.arange(len(x)))]
    while todo:
        path, rows = todo.pop()
        if path not in splits or not len(rows):
            out.append((path, rows))
            continue
        right = _sides(x[rows], splits[path])
        todo += [(path + "1", rows[right]), (path + "0", rows[~right])]
    return out


def _by_group(table, vec: str):
    column = table.column("grp")
    coded = (column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column).dictionary_encode()
    codes, names = coded.indices.to_numpy(zero_copy_only=False), coded.dictionary.to_pylist()
    x = blocks.matrix(table.column(vec))
    for i in sorted(range(len(names)), key=names.__getitem__):
        at = np.flatnonzero(codes == i)
        yield names[i], at, x[at]


def _sums(vec: str, dim: int, splits: dict, wanted: dict[tuple[str, str], int], unit: float):
    """Sums of the wanted leaves: (node, s), s the entries and the squares by dimension and the row count."""
    n = max(wanted.values(), default=-1) + 1

    def run(batches):
        sums, squares, sizes, seen = np.zeros((n, dim), np.int64), np.zeros((n, dim), np.int64), np.zeros(n, np.int64), 0
        for batch in batches:
            for data in batch.column("data"):
                for g, _, x in _by_group(blocks.from_bytes(data), vec):
                    found = [(wanted[g, path], rows) for path, rows in descend(x, splits.get(g, {})) if (g, path) in wanted and len(rows)]
                    if not found:
                        continue
                    nodes, size = np.array([node for node, _ in found]), np.array([len(rows) for _, rows in found])
                    x = x[np.concatenate([rows for _, rows in found])]
                    first = np.cumsum(size) - size
                    sums[nodes] += np.add.reduceat(np.rint(x / unit).astype(np.int64), first, axis=0)
                    # Squares in units of the largest square's 2**-40.
                    squares[nodes] += np.add.reduceat(np.rint(x * x / (unit * unit * 2.0 ** 40)).astype(np.int64), first, axis=0)
                    sizes[nodes] += size
                    seen += len(x)
                if seen >= ROWS_AT_ONCE:
                    yield _entries(sums, squares, sizes)
                    sums[:], squares[:], sizes[:], seen = 0, 0, 0, 0
        if seen:
            yield _entries(sums, squares, sizes)
    return run


def _entries(sums, squares, sizes) -> pa.RecordBatch:
    used = np.flatnonzero(sizes)
    whole = np.column_stack((sums[used], squares[used], sizes[used]))
    return pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array([s.tobytes() for s in whole], pa.binary())], names=["node", "s"])


class Tree:
    """Splits by group and path; ``size`` and ``sse`` of every node ever made."""

    def __init__(self, dim: int):
        self.dim = dim
        self.splits: dict[str, dict[str, tuple]] = {}
        self.sse: dict[tuple[str, str], float] = {}
        self.size: dict[tuple[str, str], int] = {}

    def leaves(self, group: str) -> list[str]:
        return sorted(p for g, p in self.size if g == group and p not in self.splits.get(group, {}))

    def order(self, group: str) -> list[str]:
        """Split nodes, those with the largest sums of squares first, parents before children."""
        splits, out = self.splits.get(group, {}), []
        queue = [(-self.sse[group, ""], "")] if "" in splits else []
        while queue:
            _, path = heapq.heappop(queue)
            out.append(path)
            for child in (path + "0", path + "1"):
                if child in splits:
                    heapq.heappush(queue, (-self.sse[group, child], child))
        return out

    def prune(self, leaves: dict[str, int]) -> None:
        """Keep the splits of the cut at ``leaves[group]`` clusters."""
        for g, most in leaves.items():
            kept = self.order(g)[:max(most - 1, 0)]
            self.splits[g] = {p: self.splits[g][p] for p in kept}
            alive = {"", *(p + side for p in kept for side in "01")}
            for w in [w for w in self.size if w[0] == g and w[1] not in alive]:
                del self.size[w], self.sse[w]

    def cuts(self, group: str) -> dict[str, list[int]]:
        """For each leaf its cluster at k = 1, 2, ...; clusters numbered in leaf order."""
        leaves, opened, out = self.leaves(group), set(), {p: [] for p in self.leaves(group)}
        for step in [None, *self.order(group)]:
            if step is not None:
                opened.add(step)
            number: dict[str, int] = {}
            for leaf in leaves:
                path = ""
                while path in opened:
                    path = leaf[:len(path) + 1]
                out[leaf].append(number.setdefault(path, len(number)))
        return out

    def rows(self, points: DataFrame, key: str, vec: str, keep: list[str] | None = None) -> DataFrame:
        """(key, grp, path, keep...): the leaf of every row in its group."""
        splits, kinds = self.splits, dict(points.dtypes)
        more = keep or []

        def run(batches):
            for batch in batches:
                path = np.empty(batch.num_rows, dtype=object)
                for g, at, x in _by_group(batch, vec):
                    for p, rows in descend(x, splits.get(g, {})):
                        path[at[rows]] = p
                yield pa.RecordBatch.from_arrays([batch.column(key), batch.column("grp"), pa.array(path, pa.string()),
                                                  *[batch.column(c) for c in more]], names=[key, "grp", "path", *more])

        cols = ", ".join([f"`{key}` {kinds[key]}", "grp string", "path string", *[f"`{c}` {kinds[c]}" for c in more]])
        return points.select(key, "grp", *dict.fromkeys([vec, *more])).mapInArrow(run, cols)


def grow(points: DataFrame, key: str, vec: str, leaves: dict[str, int], steps: int = STEPS) -> Tree:
    """The trees of the groups of ``points`` (key, grp, vec), with up to
    ``leaves[group]`` leaves each; a group of equal rows stays one leaf. An empty
    table, or a group without rows, has a tree without splits."""
    from boutique.operators import cluster, quality
    data = points.select("grp", vec).where(F.col("grp").isin(list(leaves)))
    tree = Tree(quality.vector_dim(data, vec))
    if not tree.dim:
        return tree
    rows = blocks.packed(data.coalesce(points.sparkSession.sparkContext.defaultParallelism),
                         max(blocks.LEFT_ROWS, BLOCK_NUMBERS // tree.dim)).checkpoint(eager=True)
    unit = cluster.unit_of(data, vec)

    def measured(splits: dict, wanted: list[tuple[str, str]]) -> dict:
        """(n, mean, variance by dim) of the wanted leaves that have rows."""
        numbers = {w: i for i, w in enumerate(wanted)}
        node, high, low = blocks.add_up(rows.mapInArrow(_sums(vec, tree.dim, splits, numbers, unit), "node int, s binary"))
        n, s, q = np.zeros(len(wanted)), np.zeros((len(wanted), tree.dim)), np.zeros((len(wanted), tree.dim))
        if len(node):
            value = high * 2.0 ** 32 + low
            n[node] = value[:, -1]
            s[node] = value[:, :tree.dim] * unit
            q[node] = value[:, tree.dim:-1] * unit * unit * 2.0 ** 40
        out = {}
        for w, i in numbers.items():
            if n[i]:
                mean = s[i] / n[i]
                out[w] = (int(n[i]), mean, np.maximum(q[i] / n[i] - mean * mean, 0.0))
        return out

    def put(stats: dict) -> None:
        for w, (n, mean, var) in stats.items():
            tree.size[w], tree.sse[w] = n, float(var.sum() * n)
            state[w] = (mean, var)

    state: dict = {}
    put(measured({}, [(g, "") for g in sorted(leaves)]))
    done: set = set()  # leaves that can't be split
    while True:
        chosen = []
        for g, most in sorted(leaves.items()):
            # The nodes that the cut at most clusters would open, by what is known so far.
            held = [(tree.sse[g, p], p) for p in tree.splits.get(g, {})]
            held += [(tree.sse[g, p], p) for p in tree.leaves(g) if (g, p) not in done and tree.size[g, p] > 1
                     and tree.sse[g, p] > 1e-9 * tree.size[g, p]]
            held.sort(key=lambda t: (-t[0], t[1]))
            chosen += [(g, p) for _, p in held[:most - 1] if p not in tree.splits.get(g, {})]
        if not chosen:
            tree.prune(leaves)
            return tree
        # Start: either side of the mean along the widest dimension.
        pair = {}
        for w in chosen:
            mean, var = state[w]
            shift = np.zeros(tree.dim)
            shift[var.argmax()] = np.sqrt(var.max())
            pair[w] = (mean - shift, mean + shift)
        wanted = [(g, p + side) for g, p in chosen for side in "01"]
        for step in range(steps):
            splits = {g: dict(s) for g, s in tree.splits.items()}
            for (g, p), two in pair.items():
                splits.setdefault(g, {})[p] = two
            stats = measured(splits, wanted)
            if step == steps - 1:
                break
            new = {(g, p): tuple(stats[g, p + side][1] if (g, p + side) in stats else pair[g, p][int(side)] for side in "01")
                   for g, p in chosen}
            if all(np.array_equal(a, b) for w in chosen for a, b in zip(new[w], pair[w])):
                break
            pair = new
        for g, p in chosen:
            if (g, p + "0") in stats and (g, p + "1") in stats:
                tree.splits.setdefault(g, {})[p] = pair[g, p]
                put({w: stats[w] for w in ((g, p + "0"), (g, p + "1"))})
            else:
                done.add((g, p))


def leaf_ranks(rows: DataFrame, key: str, out: str = "order") -> DataFrame:
    """(key, grp, out): rank 0..n-1 of every row of a group in leaf order, ties
    within a leaf broken by key (C5, D12)."""
    codes = dense_codes(rows.select("grp", "path", key), ["grp", "path", key], "_code")
    first = codes.groupBy("grp").agg(F.min("_code").alias("_first"))
    return codes.join(F.broadcast(first), "grp").select(key, "grp", (F.col("_code") - F.col("_first")).alias(out))


def join_orders(info: DataFrame, orders: DataFrame, key: str, names: dict[str, str], value: str = "order") -> DataFrame:
    """``info`` ⟗ one column per group of ``orders`` (key, grp, value), nulls 0
    (J13, J16): one pivot and one full join in place of one join per group."""
    wide = orders.groupBy(key).agg(*[F.max(F.when(F.col("grp") == g, F.col(value))).alias(c) for g, c in names.items()])
    return info.join(wide, key, "full").na.fill(0, subset=list(names.values()))
