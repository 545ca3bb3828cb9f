"""Language identification by string kernels.

A text is the set of its hashed character n-grams (one to three characters,
letters lower-cased, everything else one blank). The kernel of two texts is the
size of the common set over the geometric mean of both sizes (a blended
spectrum presence kernel). Nyström landmarks, some of each language, stand for
the kernel; one ridge regression per language is fitted in their space, and a
batch of texts is scored by two matrix products.

Learning takes at most ``MAX_PER_LANG`` texts of each language (by a hash of
the id, outside the held-out fold), of all languages with a label there; beyond 40
languages fewer of each. Repeated rows are texts of their own. A letter is what Unicode calls one.
Every whole text is scored; a null text or one without a letter is ``und``
with score 0, as is every text if there is no language to learn.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from boutique.llm.common import held_out

BITS = 14
GRAMS = 3
#: Texts and landmarks of a language. With many languages each has fewer, but one at least,
#: so that all texts and all landmarks stay near the totals.
MAX_PER_LANG, TOTAL = 500, 20_000
LANDMARKS_PER_LANG, TOTAL_LANDMARKS = 64, 4096
RIDGE = 1e-3
ROWS_AT_ONCE = 128
TRAIN_ROWS = 1024
#: Rows (id, language) that may be broadcast.
BROADCAST_ROWS = 1_000_000
CHARS_AT_ONCE = 1 << 18

_CACHE: dict = {}


def _letters() -> np.ndarray:
    table = _CACHE.get("letters")
    if table is None:
        table = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
        _CACHE["letters"] = table
    return table


def presence(text: str | None, out: np.ndarray) -> bool:
    """Mark the hashed n-grams of ``text`` in ``out``; whether it has a letter."""
    letters, any_letter = _letters(), False
    text = text or ""
    for at in range(0, len(text), CHARS_AT_ONCE):
        piece = text[max(0, at - GRAMS + 1):at + CHARS_AT_ONCE].lower()
        c = np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), np.uint32)
        ok = letters[c]
        if not ok.any():
            continue
        any_letter = True
        c = np.where(ok, c, 32).astype(np.uint32)
        c = c[np.flatnonzero(ok | np.concatenate(([True], ok[:-1])))]
        h = c * np.uint32(2654435761)
        for n in range(1, GRAMS + 1):
            if n > 1:
                h = (h[:-1] * np.uint32(0x01000193)) ^ (c[n - 1:] * np.uint32(2654435761))
            m = h ^ (h >> np.uint32(15))
            m = (m * np.uint32(0x85EBCA6B)) + np.uint32(n)
            out[m >> np.uint32(32 - BITS)] = True
    return any_letter


def _packed(batches):
    for batch in batches:
        bits = []
        for t in batch.column("text"):
            row = np.zeros(1 << BITS, bool)
            ok = presence(t.as_py(), row)
            bits.append(np.packbits(row).tobytes() if ok else None)
        yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("doc_id"), pa.array(bits, pa.binary())],
                                         names=["lang", "doc_id", "bits"])


def train(docs: DataFrame) -> dict | None:
    """Landmark matrix and coefficients; None without labelled text."""
    labelled = docs.select("doc_id", "text", "lang").where(~held_out() & F.col("lang").isNotNull())
    n_langs = labelled.where("text is not null").agg(F.count_distinct("lang")).first()[0]
    if not n_langs:
        return None
    most = max(1, min(MAX_PER_LANG, TOTAL // n_langs))
    # The first rows by hash: those below a bound that leaves about three times as many, then ranked.
    sizes = labelled.where("text is not null").groupBy("lang").agg(F.count("*").alias("n"))  # one row per language
    draw = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(1 << 30)) / float(1 << 30)
    few = (labelled.where("text is not null").select("doc_id", "lang").join(F.broadcast(sizes.select("lang", (3.0 * most / F.col("n")).alias("_share"))), "lang")
           .where(draw < F.col("_share")).select("doc_id", "lang", draw.alias("_d")))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("_d", "doc_id"))
    ids = few.withColumn("_r", place).where(F.col("_r") <= most).select("doc_id", "lang")
    if n_langs * most <= BROADCAST_ROWS:
        ids = F.broadcast(ids)
    rows = (labelled.join(ids, ["doc_id", "lang"], "left_semi")
            .mapInArrow(_packed, "lang string, doc_id long, bits binary").where("bits is not null").collect())
    if not rows:
        return None
    rows.sort(key=lambda r: (r["lang"], r["doc_id"], r["bits"]))
    langs = sorted({r["lang"] for r in rows})
    bits = np.stack([np.frombuffer(bytes(r["bits"]), np.uint8) for r in rows])
    y = np.array([langs.index(r["lang"]) for r in rows])
    most = max(1, min(LANDMARKS_PER_LANG, TOTAL_LANDMARKS // len(langs)))
    marks = _unpacked(bits[np.concatenate([np.flatnonzero(y == k)[:most] for k in range(len(langs))])])
    used = np.flatnonzero(marks.any(axis=0))
    model = {"langs": langs, "used": used.astype(np.int32),
             "marks": np.packbits(marks[:, used].astype(bool), axis=1), "sizes": marks.sum(axis=1)}
    # The normal equations are summed over blocks of texts.
    weight = 1.0 / np.bincount(y, minlength=len(langs))[y]
    left = RIDGE * kernel(marks, model) + 1e-6 * np.eye(len(marks))
    right = np.zeros((len(marks), len(langs)))
    for at in range(0, len(y), TRAIN_ROWS):
        k = kernel(_unpacked(bits[at:at + TRAIN_ROWS]), model)
        kw = (k * weight[at:at + TRAIN_ROWS, None]).T
        left += kw @ k
        right += kw @ np.where(y[at:at + TRAIN_ROWS, None] == np.arange(len(langs))[None, :], 1.0, -1.0)
    model["alpha"] = np.linalg.solve(left, right).astype(np.float32)
    return model


def _unpacked(bits: np.ndarray) -> np.ndarray:
    return np.unpackbits(bits, axis=1).astype(np.float32)


def kernel(x: np.ndarray, model: dict) -> np.ndarray:
    marks = np.unpackbits(model["marks"], axis=1, count=len(model["used"])).astype(np.float32)
    size = np.maximum(1.0, x.sum(axis=1))
    return (x[:, model["used"]] @ marks.T) / np.sqrt(size[:, None] * model["sizes"][None, :])


def _predict(model: dict | None):
    def run(batches):
        for batch in batches:
            langs, scores = [], []
            texts = batch.column("text")
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                n = min(ROWS_AT_ONCE, batch.num_rows - at)
                x = np.zeros((n, 1 << BITS), bool)
                ok = [presence(texts[at + i].as_py(), x[i]) for i in range(n)]
                if model is None:
                    langs += ["und"] * n
                    scores += [0.0] * n
                    continue
                f = np.round(kernel(x.astype(np.float32), model) @ model["alpha"], 5)
                top = f.argmax(axis=1)
                s = np.clip((f[np.arange(n), top] + 1) / 2, 0, 1)
                langs += [model["langs"][k] if good else "und" for k, good in zip(top, ok)]
                scores += [float(v) if good else 0.0 for v, good in zip(s, ok)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(langs, pa.string()),
                                              pa.array(scores, pa.float64())],
                                             names=["doc_id", "lang_pred", "score"])
    return run


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row."""
    model = train(docs)
    done = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _predict(model), "doc_id long, lang_pred string, score double")
    return done.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
