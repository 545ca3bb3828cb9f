"""Token counts: rollups by source, language and tokenizer version, kept by
signed deltas.

A ledger is a shared folder. A batch writes its signed rows (doc_id, source, lang,
tokenizer, docs, tokens, chars): an insert adds a row for each tokenizer version, a delete
adds the negative of what the ledger holds for the document, a revision does both. Then
it writes their sums by source, language and version, the batch's delta. The rollup adds up
deltas only: a few rows per batch, whatever the number of documents.

A batch counts only once its delta is written whole (Spark's ``_SUCCESS`` file). A
commit of a batch that is already there does nothing; one that broke off
is written anew. So a retried or repeated batch never counts twice. One writer at a time.

Within a batch, deletes and revisions apply to what was held before it, once for each
id however often they name it; inserts come on top. A document both deleted and revised is
gone. The last revised text by (source, lang, text) order wins. Deletes and revisions of unknown
documents do nothing. Every insert row counts, also of an id that is held already or named
twice; a later delete takes all of them. Rows without an id can be inserted, but not
deleted or revised. Null source or language is a group of its own. Null and empty texts have no tokens.
"""

from __future__ import annotations

import base64
import os

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Folder of public vocabulary files, and the versions counted by default.
TOKENIZER_DIR = "/opt/tokenizers"
VERSION = "byte_bpe_50k"
VERSIONS = ("byte_bpe_50k", "byte_bpe_multi_50k")
# Fixed value: how these vocabularies split text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: A longer text is cut before a blank that follows a letter and precedes one:
#: there the pattern splits anyway, so the sum is that of the whole text.
PIECE_CHARS = 1 << 20

GROUP = ["source", "lang", "tokenizer"]
MEASURES = ["docs", "tokens", "chars"]
DELTA_SCHEMA = "source string, lang string, tokenizer string, docs long, tokens long, chars long"
ROW_SCHEMA = f"doc_id long, {DELTA_SCHEMA}"

_CACHE: dict = {}


def _encoding(folder: str, version: str):
    import tiktoken
    key = (folder, version)
    if key not in _CACHE:
        with open(os.path.join(folder, f"{version}.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _CACHE[key] = tiktoken.Encoding(version, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _CACHE[key]


def pieces(text: str, size: int = PIECE_CHARS):
    at = 0
    while len(text) - at > size:
        cut = at + size
        while cut < len(text) and not (text[cut] == " " and text[cut - 1].isalpha()
                                       and text[cut + 1:cut + 2].isalpha()):
            cut += 1
        yield text[at:cut]
        at = cut
    yield text[at:]


def _count(folder: str, version: str):
    def run(batches):
        own = _encoding(folder, version)
        for batch in batches:
            n = []
            for t in batch.column("text"):
                text = t.as_py() or ""
                n.append(sum(len(own.encode_ordinary(p)) for p in pieces(text)))
            keep = [c for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in keep] + [pa.array(n, pa.int64())],
                                             names=keep + ["tokens"])
    return run


def counted(docs: DataFrame, folder: str = TOKENIZER_DIR, version: str = VERSION) -> DataFrame:
    """Signed insert rows of ``docs`` for one version."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", "lang",
                      F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("chars"), "text")
    return own.mapInArrow(_count(folder, version),
                          "doc_id long, source string, lang string, chars long, tokens long").select(
        "doc_id", "source", "lang", F.lit(version).alias("tokenizer"), F.lit(1).cast("long").alias("docs"),
        "tokens", "chars")


class Ledger:
    """Committed batches below ``path`` (a shared folder), counted by ``versions``."""

    def __init__(self, spark: SparkSession, path: str, versions: tuple[str, ...] = (VERSION,), folder: str = TOKENIZER_DIR):
        self.spark, self.path, self.versions, self.folder = spark, path.rstrip("/"), versions, folder

    def _at(self, *names: str):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path("/".join([self.path, *names]))
        return p, p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def committed(self, batch: str) -> bool:
        p, fs = self._at("deltas", f"batch={batch}", "_SUCCESS")
        return fs.exists(p)

    def batches(self) -> list[str]:
        p, fs = self._at("deltas")
        names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
        return sorted(n[6:] for n in names if n.startswith("batch=") and self.committed(n[6:]))

    def _read(self, kind: str, schema: str) -> DataFrame:
        paths = [f"{self.path}/{kind}/batch={b}" for b in self.batches()]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def rows(self) -> DataFrame:
        """All signed rows."""
        return self._read("rows", ROW_SCHEMA)

    def state(self) -> DataFrame:
        """What the ledger holds now for each document."""
        return _summed(self.rows(), "doc_id", *GROUP)

    def commit(self, batch: str, inserts: DataFrame | None = None, deletes: DataFrame | None = None,
               revisions: DataFrame | None = None) -> bool:
        """Apply a batch: documents to insert, ids to delete, documents whose
        text or labels replace what is held. False if it was already there."""
        if self.committed(batch):
            return False
        parts = [] if inserts is None else self._counted(inserts)
        touched = []
        if deletes is not None:
            gone = deletes.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id is not null").distinct()
            touched.append(gone)
        if revisions is not None:
            last = (revisions.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
                    .agg(F.max(F.struct("source", "lang", "text")).alias("r")).select("doc_id", "r.source", "r.lang", "r.text"))
            new = last.join(self.state().select("doc_id").distinct(), "doc_id", "left_semi")
            parts += self._counted(new if deletes is None else new.join(gone, "doc_id", "left_anti"))
            touched.append(last.select("doc_id"))
        if touched:
            ids = touched[0] if len(touched) == 1 else touched[0].unionByName(touched[1]).distinct()
            held = self.state().join(ids, "doc_id", "left_semi")
            parts.append(held.select("doc_id", *GROUP, *[(-F.col(m)).alias(m) for m in MEASURES]))
        if not parts:
            return False
        rows = parts[0]
        for p in parts[1:]:
            rows = rows.unionByName(p)
        path = f"{self.path}/rows/batch={batch}"
        rows.write.mode("overwrite").parquet(path)
        _summed(self.spark.read.schema(ROW_SCHEMA).parquet(path), *GROUP).write.mode("overwrite").parquet(
            f"{self.path}/deltas/batch={batch}")
        return True

    def _counted(self, docs: DataFrame) -> list[DataFrame]:
        return [counted(docs, self.folder, v) for v in self.versions]

    def rollup(self) -> DataFrame:
        """Documents, tokens and characters by source, language and tokenizer."""
        return _summed(self._read("deltas", DELTA_SCHEMA), *GROUP)


def _summed(rows: DataFrame, *by: str) -> DataFrame:
    return (rows.groupBy(*by).agg(*[F.sum(m).alias(m) for m in MEASURES])
            .where("docs != 0 or tokens != 0 or chars != 0"))
