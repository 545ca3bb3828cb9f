"""Hard negatives, ranked search and SimHash against brute force, and on odd rows."""

import re
from collections import Counter

import numpy as np
import pytest
import xxhash

from boutique.llm import hard_negatives, lexical, simhash
from boutique.llm.common import documents
from conftest import SF001


# SimHash ------------------------------------------------------------------

def plain_fingerprint(text):
    words = [w for w in re.split(r"[\x20\x09-\x0d]+", re.sub("[A-Z]", lambda x: x[0].lower(), text or "")) if w]
    if not words:
        return 0
    n = max(1, len(words) - 2)
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + 3]).encode(), 42) for i in range(n)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > n)


def plain_components(fps, ids):
    """Smallest id reachable, nulls left out."""
    comp = list(range(len(fps)))
    def root(i):
        while comp[i] != i:
            i = comp[i]
        return i
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 2:
                comp[root(i)] = root(j)
    low = {}
    for i, one in enumerate(ids):
        if one is not None:
            low[root(i)] = min(low.get(root(i), one), one)
    return [low.get(root(i)) for i in range(len(fps))]


def test_simhash_brute_force(spark):
    docs = documents(spark, SF001).limit(400)
    rows = docs.collect()
    fps = [plain_fingerprint(r.text) for r in rows]
    want = sorted(zip([r.doc_id for r in rows], [f"{f:016x}" for f in fps], plain_components(fps, [r.doc_id for r in rows])))
    for bucket in (64, 1):
        got = simhash.near_duplicates(spark.createDataFrame(rows, docs.schema), bucket=bucket)
        assert sorted((r.doc_id, r.fingerprint, r.component_id) for r in got.collect()) == want


def test_golay_code_is_perfect_and_keys_meet():
    index = simhash.codeword_index()
    words = np.bincount(index, minlength=4096)
    assert (words == 2048).all()  # spheres of radius three fill the space
    rng = np.random.default_rng(5)
    for flips in (0, 1, 2):
        fp = rng.integers(0, 2**64, 3000, dtype=np.uint64)
        other = fp.copy()
        for _ in range(flips):
            other ^= np.uint64(1) << rng.integers(0, 64, 3000, dtype=np.uint64)
        sets = []
        for some in (fp, other):
            keys, rows = simhash.golay_keys(some)
            assert np.bincount(rows).max() <= 18
            sets.append(set(zip(rows.tolist(), keys.tolist())))
        assert {r for r, _ in sets[0] & sets[1]} == set(range(3000))


@pytest.mark.parametrize("bucket", [64, 4])
def test_simhash_links_of_crowded_fingerprints(spark, bucket):
    rng = np.random.default_rng(6)
    weak = np.array([1, 2, 5, 20, 22, 30, 41, 44, 50, 63], np.uint64)
    crowd = {int(0x0123456789ABCDEF ^ int(sum(1 << int(b) for b in rng.choice(weak, rng.integers(0, 5), replace=False)))) for _ in range(150)}
    fps = sorted(crowd | {int(x) for x in rng.integers(0, 2**64, 100, dtype=np.uint64)} | {0, 1 << 63, 3 << 62})
    nodes = spark.createDataFrame([(int(np.uint64(f).view(np.int64)),) for f in fps], "fp long")
    got = simhash.labels(simhash.components(simhash.links(nodes, bucket)))
    comp = {int(np.int64(r.id).view(np.uint64)): int(np.int64(r.comp).view(np.uint64)) for r in got.collect()}
    want = plain_components(fps, list(range(len(fps))))
    mine = [comp.get(f, f) for f in fps]
    assert len(set(zip(want, mine))) == len(set(want)) == len(set(mine))


def test_simhash_pieces_of_long_texts(monkeypatch):
    text = "Some words\tand\n more  words é " * 300
    whole = simhash.fingerprint(text)
    assert whole == plain_fingerprint(text)
    monkeypatch.setattr(simhash, "PIECE_BYTES", 40)
    assert simhash.fingerprint(text) == whole


def test_simhash_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (None, ""), (4, "a"), (5, "A"), (5, "one two three four"), (None, "one two three four"),
            (7, "word " * 50_000), (None, "alone and nameless as it is")]
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], "doc_id long, text string, fp int, component_id string, key int")
    got = simhash.near_duplicates(df).collect()
    assert len(got) == len(rows) and set(got[0].asDict()) == {"doc_id", "fingerprint", "component_id"}
    by = Counter((r.doc_id, r.component_id) for r in got)
    assert by == Counter([(1, 1), (2, 1), (3, 1), (None, 1), (4, 4), (5, 4), (5, 5), (None, 5), (7, 7), (None, None)])
    assert {r.fingerprint for r in got if r.doc_id in (1, 2, 3)} == {"0" * 16}
    assert simhash.near_duplicates(df.limit(0)).count() == 0


# Hard negatives -------------------------------------------------------------

def plain_negatives(rows):
    """rows: (id, label, vector of ints)."""
    out = []
    key = lambda x: (-x[0], x[1] is None, x[1] or 0)
    for i, (a, la, va) in enumerate(rows):
        if a is None or a % 100:
            continue
        scored = [(int(np.dot(va, v)), b, lb) for j, (b, lb, v) in enumerate(rows) if j != i and len(v) == len(va)]
        for p, pid, _ in sorted((x for x in scored if x[2] == la), key=key)[:5]:
            fit = sorted((x for x in scored if x[2] != la and 80 * p <= 100 * x[0] <= 100 * p), key=key)[:5]
            out += [(a, pid, r, nid, p, n) for r, (n, nid, _) in enumerate(fit, 1)]
    return sorted(out, key=str)


def test_hard_negatives_brute_force(spark):
    rng = np.random.default_rng(7)
    rows = [(i * 10, int(rng.integers(0, 3)), rng.integers(-6, 7, 4).tolist()) for i in range(400)]
    rows += [(None, 1, [3, 3, 3, 3]), (rows[10][0], rows[10][1], rows[10][2]), (100, 2, [5, -5, 1, 1]), (9, 1, [1, 2]), (200, 1, [2, 2])]
    rows += [(7000 + i, 0, [6, 6, 6, 6]) for i in range(60)] + [rows[20]] * 7
    df = spark.createDataFrame([(i, [x / 256 + 0.001 for x in v], label) for i, label, v in rows],
                               "vec_id long, embedding array<double>, label int")
    got = hard_negatives.hard_negatives(df).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain_negatives(rows)


def test_hard_negatives_many_blocks(spark, monkeypatch):
    rng = np.random.default_rng(8)
    rows = [(i * 25, int(rng.integers(0, 2)), (rng.normal(0, 30, 8)).astype(int).tolist()) for i in range(600)]
    df = spark.createDataFrame([(i, [x / 256 for x in v], label) for i, label, v in rows],
                               "vec_id long, embedding array<float>, label int")
    monkeypatch.setattr(hard_negatives, "ANCHORS", 40)
    got = hard_negatives.hard_negatives(df).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain_negatives(rows)


def test_hard_negatives_odd_rows(spark):
    schema = "vec_id long, embedding array<double>, label int, id string, v int, copies int, q int"
    more = ("x", 1, 2, 3)
    bad = [(100, None, 1), (200, [1.0, None], 1), (300, [float("nan"), 1.0], 1), (400, [float("inf"), 1.0], 1), (500, [1.0, 1.0], None)]
    df = spark.createDataFrame([(*r, *more) for r in bad], schema)
    assert hard_negatives.hard_negatives(df).count() == 0
    assert hard_negatives.hard_negatives(df.limit(0)).count() == 0
    good = [(0, [1.0, 0.0], 1), (1, [0.5, 0.0], 1), (2, [0.45, 9.0], 2), (3, [], 1), (4, [1e300, 0.0], 1)]
    got = hard_negatives.hard_negatives(spark.createDataFrame([(*r, *more) for r in bad + good], schema)).collect()
    assert [tuple(r) for r in got] == [(0, 1, 1, 2, 256 * 128, 256 * 115)]


def test_large_components_are_exact():
    rng = np.random.default_rng(9)
    v = rng.integers(-(1 << 26), 1 << 26, (200, 6)).astype(np.int32)
    label = np.zeros(200, np.int64)
    order = hard_negatives.str_order(label, v)
    v = v[order]
    tree = hard_negatives.Tree(np.array([32] * 6 + [8]), np.arange(200), label, np.ones(200, np.int64), v)
    s = hard_negatives.Search(np.array([0]), np.array([-1]), np.array([0]), v[:1].astype(np.int64), True)
    s.run(tree)
    want = sorted((int(x) for x in v.astype(object) @ v[0].astype(object)), reverse=True)[:5]
    assert s.best[0].tolist() == want


# Ranked search ---------------------------------------------------------------

def plain_ranking(docs, items):
    terms = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda x: x[0].lower(), t or ""))
    docs = [(i, terms(t)) for i, t in docs]
    docs = [(i, w, Counter(w)) for i, w in docs if w]
    n_docs, length = len(docs), sum(len(w) for _, w, _ in docs)
    df = Counter(t for _, _, tf in docs for t in tf)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(terms(t))
    out = []
    for item, q in asked.items():
        rows = []
        for i, w, tf in docs:
            m = 50 + 50 * len(w) * n_docs // length
            score = sum(lexical.weight(n_docs, df[t]) * (10**9 * tf[t] // (1000 * tf[t] + 20 * m)) for t in q if t in tf)
            if score > 0:
                rows.append((-score, i is None, i or 0, i, score))
        out += [(item, r, i, s) for r, (_, _, _, i, s) in enumerate(sorted(rows, key=lambda x: x[:3])[:50], 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("small", [False, True])
def test_ranked_search_brute_force(spark, monkeypatch, small):
    if small:
        for name, value in (("LEAF", 4), ("DOCS", 64), ("CELLS", 200), ("BLOCK_PAIRS", 60), ("PIECE_BYTES", 16), ("MERGE_GROUPS", 2)):
            monkeypatch.setattr(lexical, name, value)
    rng = np.random.default_rng(10)
    words = [f"w{i}" for i in range(60)] + ["É", "déjà", "日本", "A1"]
    p = 1 / np.arange(1, len(words) + 1)
    text = lambda k: " ,\n"[rng.integers(0, 3)].join(rng.choice(words, k, p=p / p.sum()))
    docs = [(i, text(rng.integers(0, 40))) for i in range(300)]
    docs += [(1000 + i, "W1 w2 w3 w50") for i in range(70)] + [(None, "w1 w2 w3 w50"), (None, None), (3, ""), (4, "--"), (5, "w1 w2 w3 w50")]
    docs += [(2000, " ".join(words) * 400)]
    items = [(i, text(rng.integers(1, 12))) for i in range(25)] + [(1, "w50 W50 w9"), (None, "w3 w4"), (90, None), (91, "nowhere"), (92, "w50 w1")]
    got = lexical.ranked_search(spark.createDataFrame([(*d, 1, 2) for d in docs], "doc_id long, text string, score int, rank int").repartition(3),
                                spark.createDataFrame([(*i, "z") for i in items], "item_id long, text string, term string"))
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain_ranking(docs, items)


def test_tree_of_nested_paths_is_shallow_and_whole():
    n = 3000  # each document has one term more than the one before
    owner = np.repeat(np.arange(n), np.arange(1, n + 1))
    terms = np.concatenate([np.arange(i + 1) for i in range(n)])
    tree = lexical.Tree(np.arange(n), np.full(n, 100), owner, terms, np.ones(len(terms), np.int64))
    leaves, todo = [], [(lexical.Node(tree, 0, n, n), 0)]
    while todo:
        node, depth = todo.pop()
        assert depth < 14
        todo += [(x, depth + 1) for x in node.below]
        if not node.below:
            assert node.high - node.low <= lexical.LEAF
            leaves += range(node.low, node.high)
    assert sorted(leaves) == list(range(n))


def test_ranked_search_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert lexical.ranked_search(docs.limit(0), items).count() == 0
    assert lexical.ranked_search(docs, items.limit(0)).count() == 0
    assert lexical.ranked_search(docs.where("false"), items.where("false")).columns == ["item_id", "rank", "doc_id", "score"]
