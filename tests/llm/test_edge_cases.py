"""Every operator on nulls, empty and very long texts, ties, repeated rows, an
empty table and extra columns whose names clash with its own."""

import hashlib
import re

import pytest

from boutique.llm import (decontaminate, dedup, extract, fingerprint, langid, licenses, mixing, secrets, tokens,
                          toxicity)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, score double, h long, part int, t long"
LONG = " ".join(f"word{i % 977}x{i // 977}" for i in range(60_000))
PROSE = "one quiet morning the baker opened the old shop near the river and sold warm bread to all"
TEXTS = [None, "", " \n\t", "a", PROSE, PROSE, LONG, PROSE + " password=abcdefgh1234", "été " * 5, "x" * 200_000]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, None if i % 4 == 0 else ("en" if i % 2 else "fr"), None if i == 3 else f"s{i % 3}",
             None, 7, 0.5, 1, 2, 3) for i, t in enumerate(TEXTS)]
    rows += [rows[4], rows[1], (None, PROSE, "en", "s1", 5, 1, 1.0, 1, 1, 1), (None, None, None, None, None, 1, 1.0, 1, 1, 1)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, 1, i % 2, "x") for i in range(8)] + [(None, None, None, "y"), (3, None, None, "z")],
                                 "doc_id long, quality int, toxic int, text string")


N = len(TEXTS) + 4


def test_near_duplicates(docs, none):
    got = dedup.near_duplicates(docs, size=4).collect()
    assert len(got) == N
    by = {r.doc_id: r for r in got if r.doc_id is not None}
    assert [by[i].n_shingles for i in (0, 1, 2, 3)] == [0, 0, 0, 1]
    assert by[5].component_id == 4 and not by[5].kept and by[4].kept
    assert by[7].component_id == 4  # 15 of 16 shingles
    assert all(by[i].component_id == i for i in (0, 1, 2, 3, 6, 8, 9))
    assert all(r.kept and r.component_id is None for r in got if r.doc_id is None)
    assert dedup.near_duplicates(none).count() == 0


def test_toxicity(docs, labels, none):
    got = toxicity.toxicity(docs, labels).collect()
    assert len(got) == N and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    assert toxicity.toxicity(none, labels).count() == 0
    assert toxicity.toxicity(docs, labels.limit(0)).count() == N
    assert toxicity.drop_toxic(docs, labels.limit(0)).columns == docs.columns


def test_language(docs, none):
    got = langid.identify(docs).collect()
    assert len(got) == N
    assert all(r.lang_pred == "und" and r.score == 0 for r in got if r.doc_id in (0, 1, 2))
    assert all(r.lang_pred in ("en", "fr") for r in got if r.doc_id in (4, 6, 8, 9))
    assert langid.identify(none).count() == 0


def test_secrets(docs, none):
    got = secrets.scan(docs).collect()
    assert len(got) == N
    by = {r.doc_id: r for r in got}
    assert by[7].n_assign == 1 and by[0].base_sha256 == hashlib.sha256(b"").hexdigest()
    s, e = len(PROSE) + 1, len(TEXTS[7])
    assert by[7].spans == f"assign:{s}:{e}"
    clean = secrets.redact(docs)
    assert clean.columns == docs.columns
    assert clean.where("doc_id = 7").first().text == PROSE + " [secret]"
    assert clean.where("doc_id = 6").first().text == LONG
    assert secrets.scan(none).count() == 0


def test_mix(docs, none):
    got = mixing.mixed_documents(docs).collect()
    assert len(got) == N
    assert all(0 <= r.taken <= 3 * r.size for r in got)
    by_source = {}
    for r in got:
        by_source[r.source_size, r.target] = by_source.get((r.source_size, r.target), 0) + r.taken
    assert all(abs(taken - target) <= 1 for (_, target), taken in by_source.items())
    assert mixing.mixed_documents(none).count() == 0


def test_decontamination(spark, docs, none):
    bench = spark.createDataFrame([(1, PROSE, "q"), (2, None, "q"), (3, "", "q"), (None, PROSE, "q"), (4, "short one", "q")],
                                  "item_id long, text string, h string")
    got = decontaminate.contamination(docs, bench).collect()
    assert len(got) == N
    assert {r.doc_id for r in got if r.contaminated} == {4, 5, 7}
    assert all(r["items"] == "1" for r in got if r.contaminated)
    assert decontaminate.contamination(none, bench).count() == 0
    assert decontaminate.contamination(docs, bench.limit(0)).where("contaminated").count() == 0
    assert decontaminate.drop_contaminated(docs, bench).columns == docs.columns


def test_fingerprints(docs, none):
    got = fingerprint.document_fingerprints(docs).collect()
    assert len(got) == N
    assert {r.fingerprint for r in got if r.doc_id in (0, 1, 2)} == {""}
    assert len({r.fingerprint for r in got if r.doc_id in (4, 5)}) == 1
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    assert fingerprint.document_fingerprints(none).count() == 0


def test_licenses(docs, none, spark):
    more = docs.unionByName(spark.createDataFrame(
        [(50, "Released under the MIT License.\n" + PROSE, "en", "s", None, 1, 1.0, 1, 1, 1)], SCHEMA))
    got = licenses.license_scan(more).collect()
    assert len(got) == N + 1
    assert {r.doc_id: r.families for r in got if r.families} == {50: "MIT"}
    assert licenses.license_scan(none).count() == 0


def test_tokens(docs, none, spark):
    from boutique.llm.common import scratch_path
    ledger = tokens.Ledger(spark, scratch_path(spark, "t"))
    assert ledger.rollup().count() == 0
    assert ledger.commit("a", inserts=docs) and not ledger.commit("a", inserts=docs)
    assert ledger.rollup().agg({"docs": "sum"}).first()[0] == N
    assert ledger.commit("b", inserts=none)


def test_extract(spark):
    pages = spark.createDataFrame(
        [(1, "u", None, "x"), (2, "u", "", "x"), (3, None, "no markup at all", "x"), (4, "u", "<p>", "x"),
         (5, "u", "<div>" * 3000 + "deep text.", "x"),
         (6, "u", "<html><body><nav><a href=x>Home</a></nav><article><p>One &amp;  two\n three</p><p>Four.<br>Five</article>"
                  "<footer>&copy; us</footer>", "x")], "page_id long, url string, html string, text string")
    got = {r.page_id: r for r in extract.extract(pages).collect()}
    assert got[1].text == got[2].text == got[4].text == "" and got[1].n_chars == 0
    assert got[6].text == "One & two three\n\nFour. Five" and got[6].n_chars == len(got[6].text)
    assert extract.extract(pages.limit(0)).count() == 0


def test_words_are_split_by_ascii_space_only():
    import numpy as np
    from boutique.llm.common import word_hashes
    text = "A b C\x0bd\x1ce  f"
    n = len(re.findall(r"[^\x20\x09-\x0D]+", text))
    assert len(word_hashes(np.frombuffer(text.encode(), np.uint8))) == n
