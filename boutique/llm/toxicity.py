"""Toxicity: a weighted lexicon matched by Aho-Corasick on folded text.

Folding lower-cases, maps look-alike letters (Cyrillic, Greek, full-width,
accented) to plain ones and undoes digit and sign substitutions. The lexicon
and its weights are learned from labelled rows: entries are word beginnings,
short whole words, and pieces of runs in scripts without word spaces, whose share
of toxic texts far exceeds their share of clean ones, by more than chance
explains. An entry counts at the start of a word only (anywhere in scripts
without word spaces), and not inside an exception phrase (given,
or learned: a word pair around hits that clean texts use and toxic ones do
not). The score is a logistic function of the summed weights, absolute and
per hundred words, fitted on the same labelled rows.

Learning uses at most ``MAX_PER_CLASS`` rows of each label, chosen by a hash of
the id, all outside the held-out fold; that bounds the lexicon and the exception phrases, which
are never cut. An id labelled both toxic and clean has no label. Scoring reads every whole text. Without
labelled toxic rows the lexicon is empty and every score is the base rate.
Null and empty texts are scored as texts without hits.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boutique.llm.common import held_out

#: Labelled rows of each class that the model learns from.
MAX_PER_CLASS = 6000
MIN_SUPPORT = 3
MIN_LOG_ODDS = 3.0
#: Largest chance that an entry's texts are toxic this often by their share alone.
CHANCE = 1e-3
#: Letters of word beginnings; shorter words count as a whole.
SHORTEST, LONGEST = 4, 12
#: Letters of the pieces in scripts without word spaces.
LONGEST_PIECE = 6
#: Keys counted at once in a task.
KEYS_AT_ONCE = 500_000
THRESHOLD = 0.7

# Look-alike letters and substitutions.
LOOK_ALIKES = {
    "а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c",
    "т": "t", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s",
    "α": "a", "β": "b", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t",
    "υ": "u", "χ": "x", "ı": "i", "0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t",
    "@": "a", "$": "s", "!": "i", "|": "i",
}

_WORD = re.compile(r"[^\W\d_]+")
# Thai, Lao, Myanmar, Khmer, Kana and Han, with their marks.
_UNSPACED = re.compile("[\u0e01-\u0e4e\u0e81-\u0ece\u1000-\u103f\u1050-\u109f\u1780-\u17d3\u3005-\u3007\u3041-\u30ff"
                       "\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff]+")
PREFIX, EXCEPTION, WHOLE = range(3)
_CACHE: dict = {}


def fold_table() -> dict[int, str]:
    table = _CACHE.get("fold")
    if table is None:
        table = {ord(k): v for k, v in LOOK_ALIKES.items()}
        for c in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00), *range(0xFF01, 0xFF5F)]:
            plain = unicodedata.normalize("NFKD", chr(c).lower())[:1].lower()
            if plain.isascii() and plain.isalnum():
                table.setdefault(c, LOOK_ALIKES.get(plain, plain))
        table[0x200B] = table[0x200C] = table[0x200D] = table[0xAD] = ""
        _CACHE["fold"] = table
    return table


def fold(text: str | None) -> str:
    return (text or "").lower().translate(fold_table())


def keys(folded: str) -> set[str]:
    """What entries are chosen from: word beginnings, short words (followed by
    a space) and pieces of unspaced runs."""
    seen = set()
    if not folded.isascii():
        for run in set(_UNSPACED.findall(folded)):
            seen.update(run[i:i + k] for k in range(1, LONGEST_PIECE + 1) for i in range(len(run) - k + 1))
        folded = _UNSPACED.sub(" ", folded)
    for w in set(_WORD.findall(folded)):
        if len(w) < SHORTEST:
            seen.add(w + " ")
        seen.update(w[:k] for k in range(SHORTEST, min(len(w), LONGEST) + 1))
    return seen


def _letter(c: str) -> bool:
    """Whether ``c`` next to a word of a spaced script belongs to that word."""
    return c.isalpha() and (c.isascii() or not _UNSPACED.match(c))


def automaton(entries: dict[str, float], exceptions: list[str]):
    import ahocorasick
    a = ahocorasick.Automaton()
    for e, w in entries.items():
        word = e.removesuffix(" ")
        a.add_word(word, (len(word), w, PREFIX if word == e else WHOLE))
    for e in exceptions:
        a.add_word(e, (len(e), 0.0, EXCEPTION))
    if len(a):
        a.make_automaton()
    return a


def hits(folded: str, machine) -> list[tuple[int, int, float]]:
    """(start, end, weight) of the entries at word starts, the longest at each
    start, outside exception phrases. In unspaced runs entries may start
    anywhere, but not inside one another."""
    if not len(machine):
        return []
    found: dict[int, tuple[int, float]] = {}
    excused: list[tuple[int, int]] = []
    unspaced = set()
    for last, (n, w, kind) in machine.iter(folded):
        start = last - n + 1
        if not folded[start].isascii() and _UNSPACED.match(folded[start]):
            unspaced.add(start)
        elif start and _letter(folded[start - 1]):
            continue
        if kind == WHOLE and last + 1 < len(folded) and _letter(folded[last + 1]):
            continue
        if kind == EXCEPTION:
            excused.append((start, last + 1))
        elif start not in found or found[start][0] < last + 1:
            found[start] = (last + 1, w)
    if excused:
        excused.sort()
        merged = []
        for s, e in excused:
            if merged and s <= merged[-1][1]:
                merged[-1][1] = max(e, merged[-1][1])
            else:
                merged.append([s, e])
        starts = [m[0] for m in merged]
        import bisect
        for s in list(found):
            k = bisect.bisect_right(starts, s) - 1
            if k >= 0 and found[s][0] <= merged[k][1]:
                del found[s]
    out, end = [], 0
    for s, (e, w) in sorted(found.items()):
        if s in unspaced and s < end:
            continue
        out.append((s, e, w))
        end = e
    return out


def features(folded: str, machine) -> tuple[float, float]:
    total = sum(w for _, _, w in hits(folded, machine))
    if not total:
        return 0.0, 0.0
    words = sum(1 for _ in folded.split())
    if not folded.isascii():  # two letters of an unspaced run are about a word
        words += sum(map(len, _UNSPACED.findall(folded))) // 2
    words = max(1, words)
    return math.log1p(total), math.log1p(100.0 * total / words)


def labelled_sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, text, toxic) of the rows learned from."""
    # An id with both labels has none.
    marks = (labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).where(F.col("toxic").isin(0, 1) & ~held_out())
             .groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("_most"))
             .where("toxic = _most").drop("_most"))
    parts = [marks.where(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_PER_CLASS)
             for y in (0, 1)]
    chosen = parts[0].unionByName(parts[1])
    return docs.select("doc_id", "text").join(chosen, "doc_id")


def _counts(batches):
    """Texts of each class that have a key: summed over a partition, or as many
    of its keys as are held at once, before the shuffle."""
    toxic, clean = Counter(), Counter()
    for batch in batches:
        for text, y in _labelled(batch):
            (toxic if y else clean).update(keys(fold(text)))
            if len(toxic) + len(clean) > KEYS_AT_ONCE:
                yield from _count_batches("entry", toxic, clean)
                toxic, clean = Counter(), Counter()
    yield from _count_batches("entry", toxic, clean)


def _labelled(batch):
    return zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist())


def _count_batches(name: str, toxic: Counter, clean: Counter, rows: int = 50_000):
    keys = sorted(toxic.keys() | clean.keys())
    for at in range(0, len(keys), rows):
        some = keys[at:at + rows]
        yield pa.RecordBatch.from_arrays(
            [pa.array(some, pa.string()), pa.array([toxic[k] for k in some], pa.int64()),
             pa.array([clean[k] for k in some], pa.int64())], names=[name, "toxic", "clean"])


def choose_entries(rows: list[tuple[str, int, float]]) -> dict[str, float]:
    """Of nested beginnings: as long as no more specific one is clearly
    stronger, the longest that keeps the same toxic texts."""
    count = {e: n for e, n, _ in rows}
    weight = {e: w for e, _, w in rows}
    children: dict[str, list[str]] = {}
    for e in sorted(count):
        children.setdefault(e[:-1], []).append(e)
    kept: dict[str, float] = {}
    todo = [e for e in sorted(count) if e[:-1] not in count]
    while todo:
        e = todo.pop()
        below = children.get(e, [])
        if (any(count[c] >= 0.3 * count[e] and weight[c] > weight[e] + 0.3 for c in below)
                or any(count[c] == count[e] and weight[c] >= weight[e] for c in below)):
            todo += below
        else:
            kept[e] = weight[e]
    return kept


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.01) -> np.ndarray:
    """Newton's method; the intercept (last) isn't penalised."""
    a = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(a.shape[1])
    penalty = np.diag([ridge] * x.shape[1] + [1e-6]) * len(x)
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        grad = a.T @ (p - y) + penalty @ w
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + penalty + 1e-9 * np.eye(len(w)), grad)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def train(docs: DataFrame, labels: DataFrame, exceptions: list[str] = ()) -> dict:
    sample = labelled_sample(docs, labels).persist()
    try:
        totals = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
        n1, n0 = totals.get(1, 0), totals.get(0, 0)
        model = {"entries": {}, "exceptions": [fold(e) for e in exceptions],
                 "coef": [0.0, 0.0, math.log((n1 + 0.5) / (n0 + 0.5)) if n1 + n0 else -3.0]}
        if not n1 or not n0:
            return model
        odds = (F.log((F.col("toxic") + 0.5) / (n1 + 1.0)) - F.log((F.col("clean") + 0.5) / (n0 + 1.0)))
        # Chernoff's bound on the chance of so many toxic texts among an entry's; chance words stay out.
        share = n1 / (n1 + n0)
        uses = F.col("toxic") + F.col("clean")
        surprise = (F.col("toxic") * F.log(F.col("toxic") / (uses * share))
                    + F.when(F.col("clean") > 0, F.col("clean") * F.log(F.col("clean") / (uses * (1 - share)))).otherwise(0.0))
        found = (sample.select("text", "toxic").mapInArrow(_counts, "entry string, toxic long, clean long")
                 .groupBy("entry").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
                 .where(F.col("toxic") >= MIN_SUPPORT).withColumn("w", odds)
                 .where((F.col("w") >= MIN_LOG_ODDS) & (surprise >= -math.log(CHANCE)))
                 .orderBy(F.desc("w"), "entry").collect())
        model["entries"] = choose_entries([(r["entry"], r["toxic"], r["w"]) for r in found])
        model["exceptions"] += _learn_exceptions(sample, model)
        got = sample.select("text", "toxic").mapInArrow(_featurise(model), "a double, b double, toxic int").toPandas()
        if len(got):
            x = got[["a", "b"]].to_numpy()
            model["coef"] = [float(v) for v in fit_logistic(x, got["toxic"].to_numpy())]
        return model
    finally:
        sample.unpersist()


def _learn_exceptions(sample: DataFrame, model: dict) -> list[str]:
    entries = model["entries"]

    def pairs(batches):
        machine = automaton(entries, [])
        toxic, clean = Counter(), Counter()
        for batch in batches:
            for text, y in _labelled(batch):
                folded, seen = fold(text), set()
                for s, e, _ in hits(folded, machine):
                    before = re.search(r"\w+ $", folded[max(0, s - 40):s])
                    after = re.match(r"\w* \w+", folded[e:e + 60])
                    end = e + len(re.match(r"\w*", folded[e:e + 40])[0])
                    if before:
                        seen.add(before[0] + folded[s:end])
                    if after:
                        seen.add(folded[s:e] + after[0])
                (toxic if y else clean).update(seen)
        yield from _count_batches("phrase", toxic, clean)

    found = (sample.select("text", "toxic").mapInArrow(pairs, "phrase string, toxic long, clean long")
             .groupBy("phrase").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
             .where((F.col("clean") >= MIN_SUPPORT) & (F.col("toxic") == 0))
             .orderBy("phrase").collect())
    return [r["phrase"] for r in found]


def _featurise(model: dict):
    def run(batches):
        machine = automaton(model["entries"], model["exceptions"])
        for batch in batches:
            f = [features(fold(t), machine) for t, _ in _labelled(batch)]
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in f], pa.float64()), pa.array([x[1] for x in f], pa.float64()),
                                              batch.column("toxic")], names=["a", "b", "toxic"])
    return run


def score(docs: DataFrame, model: dict, text_col: str = "text", out_col: str = "score",
          keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all, by default) and the score of each text."""
    keep = docs.columns if keep is None else keep
    coef = model["coef"]

    def run(batches):
        machine = automaton(model["entries"], model["exceptions"])
        for batch in batches:
            values = []
            for t in batch.column("_text"):
                a, b = features(fold(t.as_py()), machine)
                z = coef[0] * a + coef[1] * b + coef[2]
                values.append(1 / (1 + math.exp(-max(-30.0, min(30.0, z)))))
            columns = [batch.column(f"_k{i}") for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays(columns + [pa.array(values, pa.float64())],
                                             names=[f"_k{i}" for i in range(len(keep))] + ["_score"])

    own = docs.select(F.col(text_col).alias("_text"), *[F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)])
    types = [f.dataType.simpleString() for f in docs.select(*keep).schema.fields]
    schema = ", ".join([f"_k{i} {t}" for i, t in enumerate(types)] + ["_score double"])
    done = own.mapInArrow(run, schema)
    return done.select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)], F.col("_score").alias(out_col))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted (score >= 0.7) of every document."""
    scored = score(docs, train(docs, labels), keep=["doc_id"])
    return scored.select("doc_id", held_out().alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the score doesn't reject."""
    columns = docs.columns
    scored = score(docs, train(docs, labels), out_col="_toxicity")
    return scored.where(F.col("_toxicity") < THRESHOLD).select(*columns)
