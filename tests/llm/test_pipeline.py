"""The pipeline on a small table: every stage takes effect, clean documents stay."""

import corpus_pipeline
from boutique.llm import common
from conftest import SF001


def test_run(spark):
    docs = common.documents(spark, SF001)
    sizes, now = [docs.count()], docs
    for name, stage in corpus_pipeline.STAGES:
        path = common.scratch_path(spark, name)
        stage(spark, now, SF001).write.parquet(path)
        now = spark.read.parquet(path)
        sizes.append(now.count())
        if name != "mix":
            assert now.columns == corpus_pipeline.COLUMNS
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] == sizes[-2] == sizes[-3]
    assert sizes[1] > 0.8 * sizes[0] and sizes[-1] > 0.6 * sizes[0]
    ids = {r.doc_id for r in now.collect()}
    assert ids <= {r.doc_id for r in docs.collect()}
    assert corpus_pipeline.run(spark, SF001).count() == sizes[-1]


def test_one_row_of_each_group_stays(spark):
    """Against brute force: groups by exact similarity, repeated rows and ids, nulls."""
    rng = __import__("random").Random(3)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for g in range(6):
        base = rng.choices(words, k=60)
        for c in range(4):
            text = list(base)
            if c:
                text[rng.randrange(60)] = f"z{g}{c}"
            rows.append((10 * g + c, " ".join(text)))
    rows += [rows[0], rows[0], rows[5], (500, rows[0][1]), (None, rows[0][1]), (None, None), (501, None), (501, None), (502, ""), (500, "other text")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")

    def grams(t):
        w = (t or "").split()
        return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    ids = sorted({i for i, _ in rows if i is not None})
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    known = [(i, grams(t)) for i, t in rows if i is not None]
    for i, a in known:
        for j, b in known:
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    want = {i for i in ids if find(i) == i}
    got = [r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, docs, SF001).collect()]
    assert sorted(i for i in got if i is not None) == sorted(want) and got.count(None) == 2
    none = corpus_pipeline.drop_near_duplicates(spark, docs.limit(0), SF001)
    assert none.count() == 0 and none.columns == corpus_pipeline.COLUMNS
