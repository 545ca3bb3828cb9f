"""The operators against brute force, round trips and held-out accuracy on small tables."""

import hashlib
import re

import duckdb
import numpy as np
import pytest

import __spark_entry__ as entry
from boutique.llm import common, decontaminate, dedup, extract, fingerprint, licenses, mixing, secrets, tokens, toxicity
from boutique.llm.registry import oracle_sql
from conftest import SF001, SF01
from oracle_check import compare, duck


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_oracle(spark, name):
    r = compare(spark, duck(SF001), name, entry.queries()[name], oracle_sql()[name], SF001)
    assert r["status"] == "ok", r


def test_bin_minima_agree_as_the_sets_do():
    rng, order = np.random.default_rng(1), dedup._probe_order()
    for n in (10, 40, 400):
        shared = rng.integers(0, 2**64, 8 * n // 10, dtype=np.uint64)
        agree = []
        for _ in range(60):
            a, b = (np.unique(np.concatenate([shared, rng.integers(0, 2**64, n // 10, dtype=np.uint64)])) for _ in "ab")
            agree.append((dedup.bin_minima(a, order) == dedup.bin_minima(b, order)).mean())
        assert abs(np.mean(agree) - 0.8) < 0.1


def test_chain_of_near_copies_is_one_component(spark):
    words = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(30):  # each differs from the next by one word; the ends have little in common
        rows.append((100 - i, " ".join(words)))
        words[4 * i] = f"z{i}"
    got = dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), size=4).collect()
    assert {r.component_id for r in got} == {71}


def test_long_text_equals_short_blocks(monkeypatch):
    data = np.frombuffer(("some Words  and\nmore words " * 400).encode(), np.uint8)
    whole = common.word_hashes(data)
    monkeypatch.setattr(common, "BLOCK_BYTES", 64)
    assert (common.word_hashes(data) == whole).all()


def test_toxicity_held_out(spark):
    docs, labels = common.documents(spark, SF01), spark.read.parquet(f"{SF01}/labels.parquet")
    got = toxicity.toxicity(docs, labels).join(labels, "doc_id").where("held_out").toPandas()
    assert ((got.predicted == got.toxic).mean()) > 0.93


def test_folding_and_exceptions():
    m = toxicity.automaton({"idiot": 2.0}, ["no idiot"])
    fold = toxicity.fold
    assert len(toxicity.hits(fold("1DіOT, idiöts and no idiot; xidiot"), m)) == 2


def test_rare_short_and_unspaced_toxic_terms(spark):
    rng = np.random.default_rng(2)
    word = lambda: "word" + "".join(rng.choice(list("abcdefgh"), 3))
    han = lambda: "".join(rng.choice(list("\u6211\u4eec\u8bf4\u4eca\u5929\u4e0b\u96e8\u4e86"), 3))
    own = ["grobnik"] * 2000 + ["zurbel", "gyx", "\u574f\u86cb"] * 24
    rows = []
    for i in range(len(own) * 2):  # even rows are toxic
        term = own[i // 2] if i % 2 == 0 else ""
        words = [word() for _ in range(8)] + ["gyxland"] * (i % 40 == 1)
        if i % 10 == 1 or not term.isascii():
            words.append(han() + term * (not term.isascii()) + han())
        if term.isascii() and term:
            words[i % 8] = term
        rows.append((i, " ".join(words), int(i % 2 == 0)))
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.train(frame.select("doc_id", "text"), frame.select("doc_id", "toxic"))
    new = spark.createDataFrame([(1, "a zurbel here"), (2, "such a gyx, yes"), (3, "\u4f60\u4eec\u574f\u86cb\u4eec"), (4, "gyxland is far"), (5, "grobnik")],
                                "doc_id long, text string")
    got = {r.doc_id: r.score >= toxicity.THRESHOLD for r in toxicity.score(new, model).collect()}
    assert got == {1: True, 2: True, 3: True, 4: False, 5: True}


def test_language_held_out(spark):
    from boutique.llm import langid
    docs = common.documents(spark, SF01)
    got = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert (got.lang == got.lang_pred).mean() > 0.97


def test_base_spans_consume_failing_matches():
    assert secrets.base_spans("secret: token: abcdefghij") == []
    assert secrets.base_spans('API_KEY = "abcdefgh"') == [(0, "assign", 19)]
    text = "token=" + "a" * 40
    assert [k for _, k, _ in secrets.base_spans(text)] == ["assign", "hex"]
    assert secrets.base_spans("AKIA" + "B" * 11) == [] and len(secrets.base_spans("AKIA" + "B" * 12)) == 1


@pytest.fixture(scope="module")
def net(spark):
    return secrets.train(common.documents(spark, SF01))


def test_network_finds_keys_of_unseen_forms(net):
    for held_back in (False, True):
        p, y = [], []
        for text, s, e, label in secrets.generated(800, seed=99, held_back=held_back):
            p.append(secrets.probability(secrets.forward(secrets.windows(text, [(s, e)])[0], net), net).max())
            y.append(label)
        p, y = np.array(p), np.array(y)
        assert (p[y == 1] >= net["threshold"]).mean() > 0.9 and (p[y == 0] >= net["threshold"]).mean() < 0.02


def test_candidates_of_any_form_outside_base_findings():
    def cands(text):
        return [text[s:e] for s, e in secrets.candidates(text, secrets.base_spans(text))]
    assert cands("sk_live_abcdEFGH12 and " + "q" * 32 + ".") == ["sk_live_abcdEFGH12", "q" * 32]
    assert cands("postgres://user:s3cretP4ss@host ordinary words only") == ["s3cretP4ss"]
    inner = "a1" * 20
    assert cands(f"zz-Left9part_{inner}XY9right_Part") == ["zz-Left9part_", "XY9right_Part"]
    assert cands("password=abcdefgh1234 thunderstorm") == []


def test_spans_brute_force(spark, net):
    planted = "use postgres://user:k9Qw7Zx2Lm4T@host and ghp_" + "aB3" * 12 + " now"
    docs = spark.createDataFrame([(-1, planted), (-2, "password=abcdefgh1234"), (3, None), (None, "AKIA" + "Q7" * 8), (2, "nothing")],
                                 "doc_id long, text string").unionByName(common.documents(spark, SF001).select("doc_id", "text"))
    texts = [(r.doc_id, r.text or "") for r in docs.collect()]
    want = []
    for i, t in texts:
        spans = secrets.base_spans(t)
        for s, e in secrets.candidates(t, spans):
            w = secrets.windows(t, [(s, e)])[0]
            if max(secrets.probability(secrets.forward(w[k:k + 1], net), net)[0] for k in range(len(w))) >= net["threshold"]:
                spans = spans + [(s, "net", e)]
        order = {k: n for n, k in enumerate(secrets.KINDS)}
        want.append((i, ",".join(f"{k}:{s}:{e}" for s, k, e in sorted(spans, key=lambda x: (x[0], order[x[1]], x[2])))))
    got = docs.mapInArrow(secrets._scan(net), "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
    assert sorted(((r.doc_id, r.spans) for r in got.collect()), key=str) == sorted(want, key=str)
    found = dict(want)[-1]
    assert found.count("net:") == 2


def test_secret_windows_at_the_ends():
    text = "k9Qw7Zx2Lm4T" * 30
    k, owner = secrets.windows(text, [(0, len(text)), (3, 11)])
    assert k.shape[1] == secrets.LENGTH and owner.tolist().count(1) == 1 and owner.tolist().count(0) > 5
    assert (k[-1] >= secrets.N_CLASSES).sum() == 8


def test_changed_numbers_and_names_still_match(spark):
    bench = spark.createDataFrame([(1, "Yesterday the driver Maria carried 12 boxes for 30 km and then Maria carried 12 more boxes home alone.")],
                                  "item_id long, text string")
    docs = spark.createDataFrame([
        (1, "so it goes. Yesterday the driver Pedro carried 99 boxes for 7 miles and then Pedro carried 99 more boxes home alone. The end"),
        (2, "Yesterday the driver Pedro carried 99 boxes for 7 miles and then Olga carried 98 more boxes home alone."),
        (3, "the driver was alone at home with 12 boxes")], "doc_id long, text string")
    got = {r.doc_id: r.contaminated for r in decontaminate.contamination(docs, bench).collect()}
    assert got[1] and not got[3]
    pairs = {r.doc_id: r.covered for r in decontaminate.contamination(docs, bench).collect()}
    assert pairs[2] < pairs[1]  # one value stands for two: that alignment is refused


def test_partly_changed_dense_and_opening_copies_match(spark):
    tail = "every red wagon near the old river bridge was painted twice before the summer fair opened its gates"
    bench = spark.createDataFrame([
        (1, f"In the shed stood 12 carts and later 12 more carts while {tail}."),
        (2, "Berlin 14 Paris 20 km Rome 31 Oslo 7 kg Madrid 19 Lisbon 8"),
        (3, "Maria walked slowly along the quiet harbour wall at night."),
        (4, "a farmer sold 3 sheep and bought 5 geese at the market")], "item_id long, text string")
    docs = spark.createDataFrame([
        (1, f"In the shed stood 99 carts and later 98 more carts while {tail}."),
        (2, "seen: Berlin 14 Paris 20 km Rome 31 Oslo 7 kg Madrid 19 Lisbon 8"),
        (3, "Pedro walked slowly along the quiet harbour wall at night."),
        (4, "a farmer sold 6 sheep and bought 6 geese at the market"),
        (5, "Berlin 3 Rome 4 km Paris 5")], "doc_id long, text string")
    got = {r.doc_id: r["items"] for r in decontaminate.contamination(docs, bench).collect()}
    assert got == {1: "1", 2: "2", 3: "3", 4: "4", 5: ""}


def test_short_items_match_only_where_they_stand_alone(spark):
    bench = spark.createDataFrame([(1, "What is the answer?"), (2, "Add 12 apples to the large basket")], "item_id long, text string")
    texts = {1: "People ask what is the answer to life and get none.", 2: "We met. What is the answer? Nobody knew.",
             3: "what is the answer", 4: 'He said "What is the answer" and left.', 5: "First line\nWhat is the answer\nlast line",
             6: "Please add 15 apples to the large basket now", 7: "Please do this: add 15 apples to the large basket", 8: "so what is the answer?",
             9: "What is the answer to life?"}
    long = 70_000 * "the inn by the river was full of guests. "
    texts[10], texts[11] = long + "What is the answer? " + long, long + "People ask what is the answer to life. " + long
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: r["items"] for r in decontaminate.contamination(docs, bench).collect()}
    assert got == {1: "", 2: "1", 3: "1", 4: "1", 5: "1", 6: "", 7: "2", 8: "", 9: "", 10: "1", 11: ""}


def test_edges_of_long_texts_equal_those_of_the_whole(monkeypatch):
    text = ("It rained (all day). 3.5 km on, the road ended: nobody went\nfurther | " * 40).encode()
    data = np.frombuffer(text, np.uint8)
    _, values, kinds, edges = decontaminate.tokens(data)
    edges[0] = True
    for step in (16, 50, 333):
        monkeypatch.setattr(common, "BLOCK_BYTES", step)
        v, k, e = decontaminate.text_tokens(data)
        assert (v == values).all() and (e == edges).all()


def test_consistent_cover_brute_force():
    from itertools import product
    rng = np.random.default_rng(4)
    for _ in range(300):
        rows = [(i, [int(v) for v in rng.integers(0, 3, k)], [int(v) for v in rng.integers(0, 2, k)])
                for i, k in enumerate(rng.integers(0, 3, 7))]
        def fits(some):
            pairs = {p for _, a, b in some for p in zip(a, b)}
            return len({a for a, _ in pairs}) == len(pairs)
        def cover(some):
            return len({at + j for at, _, _ in some for j in range(4)})
        runs = max((cover(rows[i:j]) for i in range(7) for j in range(i + 1, 8) if fits(rows[i:j])), default=0)
        most = max(cover([r for r, k in zip(rows, keep) if k]) for keep in product((0, 1), repeat=7)
                   if fits([r for r, k in zip(rows, keep) if k]))
        assert runs <= decontaminate.consistent_cover(rows, 4) <= most


def test_decontamination_brute_force(spark):
    import re
    con = duckdb.connect()
    docs = con.execute(f"SELECT doc_id, text FROM '{SF01}/documents.parquet'").fetchall()
    items = con.execute(f"SELECT text FROM '{SF01}/benchmark.parquet'").fetchall()
    tok = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    grams = {tuple(w[i:i + 13]) for (t,) in items for w in [tok(t)] for i in range(len(w) - 12)}
    want = {d for d, t in docs for w in [tok(t)] if any(tuple(w[i:i + 13]) in grams for i in range(len(w) - 12))}
    got = decontaminate.contamination(common.documents(spark, SF01), spark.read.parquet(f"{SF01}/benchmark.parquet"))
    assert want <= {r.doc_id for r in got.where("contaminated").collect()}
    assert got.where("contaminated").count() <= len(want) + 3


def test_window_map_grows_and_holds_all(spark, monkeypatch):
    """A map of any size holds every window; a small, full one changes no result."""
    rng = np.random.default_rng(3)
    values = rng.integers(-2**63, 2**63 - 1, 5000)
    windows = spark.createDataFrame([(int(v),) for v in values] + [(0,), (-1,)], "h long")
    monkeypatch.setattr(decontaminate, "MAP_BITS", (15, 29))
    grown = decontaminate.window_map(windows)
    assert len(grown) == 1 << 14  # 16 bits for each of 5,002 windows, as a power of two
    other = rng.integers(0, 2**63, 100_000).astype(np.uint64) * np.uint64(2)
    for bitmap, most in ((grown, 0.05), (_map_of(windows, monkeypatch, (15, 15)), 0.16)):
        assert decontaminate.may_hold(bitmap, np.append(values, [0, -1]).astype(np.int64).view(np.uint64)).all()
        assert decontaminate.may_hold(bitmap, other).mean() < most
    words = [f"w{k}" for k in range(400)]
    benchmark = spark.createDataFrame([(i, " ".join(rng.choice(words, 20))) for i in range(300)], "item_id long, text string")
    docs = benchmark.selectExpr("item_id AS doc_id", "concat('before it ', text) AS text")
    results = []
    for sizes in ((15, 15), (22, 29)):
        monkeypatch.setattr(decontaminate, "MAP_BITS", sizes)
        results.append(sorted(decontaminate.matches(docs, benchmark).collect()))
    assert results[0] == results[1] and len(results[0]) == 300
    assert not decontaminate.window_map(windows.limit(0)).any()


def _map_of(windows, monkeypatch, sizes):
    monkeypatch.setattr(decontaminate, "MAP_BITS", sizes)
    return decontaminate.window_map(windows)


def test_flow_uses_cheap_words_first():
    given = mixing.min_cost_flow({("a",): 10, ("a", "b"): 10, ("b",): 10}, {"a": 15, "b": 15})
    assert given == {("a",): 10, ("a", "b"): 10, ("b",): 10}
    given = mixing.min_cost_flow({("a",): 10, ("b",): 10}, {"a": 25, "b": 5})
    assert given == {("a",): 25, ("b",): 5}


def test_targets_stop_at_three_times():
    t = mixing.targets({"a": 100, "b": 1, "c": 100, None: 10})
    assert t["b"] == 3 and abs(sum(t.values()) - 211) < 1e-9 and t[None] <= 30


def test_fingerprints_brute_force(spark):
    docs = common.documents(spark, SF001)
    got = {r.doc_id: r for r in fingerprint.document_fingerprints(docs).collect()}
    text = {r.doc_id: r.text or "" for r in docs.collect()}
    ids = sorted(text, reverse=True)
    for i, d in enumerate(ids):
        n, k = len(text[d]), len(text[d]) // 3
        edited = text[d][:n - k] + text[ids[(i + 1) % len(ids)]][:k]
        assert got[d].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest() and got[d].n_chars == n
        a, b = (set(filter(None, f.split(","))) for f in (got[d].fingerprint, got[d].edited_fingerprint))
        assert abs(got[d].near_edited - (len(a & b) / len(a | b) if a | b else 1.0)) < 1e-9


def test_next_document_across_ranges_and_rows_without_an_id(spark, monkeypatch):
    monkeypatch.setattr(fingerprint, "ROWS_PER_RANGE", 20)
    rows = [(None if i % 3 == 0 else i // 2, f"text {i} " * (1 + i % 9)) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "xxhash64(text) AS h")
    order = sorted(docs.collect(), key=lambda r: (r.doc_id is None, -(r.doc_id or 0), -r.h))
    want = []
    for i, r in enumerate(order):
        n, k = len(r.text), len(r.text) // 3
        edited = r.text[:n - k] + order[(i + 1) % len(order)].text[:k]
        want.append((r.doc_id or -1, hashlib.sha256(edited.encode()).hexdigest()))
    got = [(-1 if r.doc_id is None else r.doc_id, r.edited_sha256) for r in fingerprint.document_fingerprints(docs).collect()]
    assert sorted(got) == sorted((-1 if o.doc_id is None else o.doc_id, w[1]) for o, w in zip(order, want))


def test_sketch_error(spark):
    docs = common.documents(spark, SF01)
    text = {r.doc_id: r.text or "" for r in docs.collect()}
    ids = sorted(text, reverse=True)

    def shingles(t):
        w = [x for x in re.split("[\x20\x09-\x0d]+", t.lower()) if x]
        return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    errors, shares = {}, {}
    for r in fingerprint.document_fingerprints(docs).collect():
        t, following = text[r.doc_id], text[ids[(ids.index(r.doc_id) + 1) % len(ids)]]
        k = len(t) // 3
        a, b = shingles(t), shingles(t[:len(t) - k] + following[:k])
        size = next((n for n in (50, 200) if len(a) < n), 0)
        errors.setdefault(size, []).append(abs(r.near_edited - (len(a & b) / len(a | b) if a | b else 1.0)))
        shares.setdefault(size, []).append(abs(r.kept_in_edited - (len(a & b) / len(a) if a else float(not b))))
    mean = {k: (round(float(np.mean(v)), 3), round(float(np.mean(shares[k])), 3), len(v)) for k, v in errors.items()}
    print(mean)
    assert mean[0][0] < 0.03 and mean[200][0] < 0.07 and mean[50][0] < 0.12


def test_sketches_merge(spark):
    df = spark.createDataFrame([(1, "a b c d e f g h " * 3), (1, "some other words that go on and on " * 9)], "k int, text string")
    s = fingerprint.with_sketch(df, "text", "sketch")
    both = fingerprint.merged(s, ["k"]).first().sketch
    rows = [set(r.sketch) for r in s.collect()]
    assert set(both) <= rows[0] | rows[1] and all(h < fingerprint._BELOW for h in both)


@pytest.fixture(scope="module")
def license_model(spark):
    return licenses.train(common.documents(spark, SF01))


NOTICES = {
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
           "conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "MIT": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files '
           '(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish.',
    "GPL-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
               "the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "Apache-2.0": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
}
ORDINARY = [
    "the company said all rights reserved for tables at the inn", "A driver's license is required under the law of the land.",
    "We released the bird under the old bridge.", "The license plate was version 2 of the design.", "Permission to leave early was granted by the teacher.",
    "The public domain of the village lies beyond the mill.", "He reserved all the rights he had to the table near the window.",
    "The general public likes free software and free lunches.", "Source and binary stars are different forms of light.",
    "In January 2004 the apache helicopter flew over the common ground.",
]


def test_wrapped_notices_and_ordinary_sentences(spark, license_model):
    import textwrap
    rows = [(f"{f}{w}", "Some words of a readme come first.\n\n" + "\n".join(("# " if w == 60 else "") + x for x in textwrap.wrap(t, w)) + "\n\nThe end")
            for f, t in NOTICES.items() for w in (40, 60, 76, 10_000)]
    ids = {i: f for i, (f, _) in enumerate(rows)}
    rows = [(i, t) for i, (_, t) in enumerate(rows)] + [(100 + i, t) for i, t in enumerate(ORDINARY)]
    rows += [(200, "All rights reserved."), (201, "Title of it\nAll rights reserved.\nMore text here"), (200, "All rights reserved."), (None, "Released under the MIT License."),
             (300, None), (301, "")]
    got = licenses.license_scan(spark.createDataFrame(rows, "doc_id long, text string"), license_model).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            assert r.families == "MIT"
        elif r.doc_id in ids:
            assert r.families == ids[r.doc_id].rstrip("0123456789") or ids[r.doc_id].startswith(r.families) and r.families, (ids[r.doc_id], r)
        else:
            assert r.families == ("Proprietary" if r.doc_id in (200, 201) else ""), r
    assert [r.n_paragraphs for r in got if r.doc_id in (300, 301)] == [0, 0]


def test_segments_equal_plain_words(spark):
    texts = ["One two. Three\nfour; five\n\nsix 7.8 nine!", "a" * 5, " ... ", "w " * 300]
    got = licenses.segments(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    hashes = spark.createDataFrame([(t,) for t in texts], "text string").select("text", *licenses.text_hashes()).collect()
    for t in texts:
        words = [licenses.STOP, *licenses.word_list(t)]
        parts = sorted((r.part, r.words) for r in got if (t, r.t, r.u) in {tuple(h) for h in hashes})
        want = [(at, words[at:at + 64]) for at in range(0, max(0, len(words) - 17) + 1, 48)] if len(words) > 1 else []
        assert parts == want


def test_license_probabilities_are_calibrated(license_model):
    rows = licenses.training_rows([])[1::7]
    p, right = [], []
    for words, family in rows:
        z = np.array(license_model["bias"]) + sum((np.array(license_model["weights"][g]) for g in licenses.features(words) if g in license_model["weights"]), np.zeros(len(license_model["bias"])))
        q = licenses._softmax(z[None, :])[0]
        p.append(q.max())
        right.append(license_model["labels"][int(q.argmax())] == family)
    assert abs(np.mean(p) - np.mean(right)) < 0.05


def test_ledger_deletes_and_revises(spark):
    schema = "doc_id long, text string, lang string, source string"
    frame = lambda rows: spark.createDataFrame(rows, schema)
    ledger = tokens.Ledger(spark, common.scratch_path(spark, "ledger"))
    ledger.commit("1", inserts=frame([(1, "a b c", "en", "x"), (2, "d e", "en", "x"), (3, None, None, None)]))
    ledger.commit("2", deletes=spark.createDataFrame([(1,), (1,), (9,)], "doc_id long"),
                  revisions=frame([(2, "d e f g", "fr", "y"), (8, "unknown", "en", "x")]))
    for _ in range(2):
        ledger.commit("2", deletes=spark.createDataFrame([(2,)], "doc_id long"))
    got = {(r.source, r.lang): (r.docs, r.tokens, r.chars) for r in ledger.rollup().collect()}
    direct = tokens.counted(frame([(2, "d e f g", "fr", "y")])).first()
    assert got == {("y", "fr"): (1, direct.tokens, 7), (None, None): (1, 0, 0)}


def test_ledger_brute_force(spark):
    schema = "doc_id long, text string, lang string, source string"
    rng = np.random.default_rng(12)
    count = {v: (lambda t, own=tokens._encoding(tokens.TOKENIZER_DIR, v): len(own.encode_ordinary(t or ""))) for v in tokens.VERSIONS}
    text = lambda: None if rng.random() < 0.1 else " ".join(rng.choice(["red", "blue", "größe", "x1"], rng.integers(0, 6)))
    row = lambda i: (i, text(), str(rng.choice(["en", "fr"])), str(rng.choice(["s", "t"])))
    ledger = tokens.Ledger(spark, common.scratch_path(spark, "ledger"), tokens.VERSIONS)
    held: list = []
    for b in range(5):
        ids = lambda n: [int(x) if x < 12 else None for x in rng.integers(0, 13, n)]
        inserts, deletes, revisions = [row(i) for i in ids(6)], ids(4), [row(i) for i in ids(4)]
        known = {r[0] for r in held if r[0] is not None}
        gone = {i for i in deletes if i is not None}
        last = {}
        for r in sorted((r for r in revisions if r[0] is not None), key=lambda r: (r[3], r[2], r[1] is not None, r[1] or "")):
            last[r[0]] = r
        held = [r for r in held if r[0] is None or r[0] not in gone | last.keys()] + [r for i, r in last.items() if i in known - gone] + inserts
        frames = {"inserts": spark.createDataFrame(inserts, schema), "deletes": spark.createDataFrame([(i,) for i in deletes], "doc_id long"),
                  "revisions": spark.createDataFrame(revisions, schema)}
        assert ledger.commit(str(b), **frames) and not ledger.commit(str(b), **frames)
        want = {}
        for i, t, lang, source in held:
            for v in tokens.VERSIONS:
                d, n, c = want.get((source, lang, v), (0, 0, 0))
                want[source, lang, v] = (d + 1, n + count[v](t), c + len(t or ""))
        assert {(r.source, r.lang, r.tokenizer): (r.docs, r.tokens, r.chars) for r in ledger.rollup().collect()} == want


def test_token_query_counts_documents_and_characters(spark):
    got = {(r.source, r.lang, r.tokenizer): (r.docs, r.chars) for r in entry.queries()["op1_token_counts"](spark, SF001).collect()}
    want = duckdb.connect().execute(f"""SELECT source, lang, count(*), sum(CASE WHEN doc_id % 10 = 1
        THEN length(coalesce(text, '')) - length(coalesce(text, '')) // 2 ELSE length(coalesce(text, '')) END)
        FROM '{SF001}/documents.parquet' WHERE doc_id % 10 NOT IN (3, 7) GROUP BY ALL""").fetchall()
    assert got == {(s, x, v): (n, c) for s, x, n, c in want for v in tokens.VERSIONS}


def test_clashing_labels_have_no_say(spark):
    docs = spark.createDataFrame([(i, "calm words here" if i % 2 else "vile grobnik here") for i in range(60)], "doc_id long, text string")
    marks = [(i, 1 - i % 2) for i in range(60)] + [(i, i % 2) for i in range(60)]
    for parts in (1, 5):
        model = toxicity.train(docs, spark.createDataFrame(marks, "doc_id long, toxic int").repartition(parts))
        assert model["entries"] == {}
    sample = toxicity.labelled_sample(docs, spark.createDataFrame(marks[:61], "doc_id long, toxic int"))
    assert 0 not in {r.doc_id for r in sample.collect()} and sample.count() > 30


def test_letters_beyond_the_first_plane(spark):
    from boutique.llm import langid
    rows = [(i, "the calm river and the old mill" if i % 2 else "la rivière calme et le vieux moulin", "en" if i % 2 else "fr") for i in range(60)]
    rows += [(100, "\U0001F600\U0001F680", None), (101, "\U00020000\U00020001", None), (102, "12 !", None)]
    got = {r.doc_id: r.lang_pred for r in langid.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert got[100] == got[102] == "und" and got[101] in ("en", "fr")


def test_every_language_is_learned(spark, monkeypatch):
    from boutique.llm import langid
    monkeypatch.setattr(langid, "TOTAL", 150)
    monkeypatch.setattr(langid, "TOTAL_LANDMARKS", 60)
    monkeypatch.setattr(langid, "TRAIN_ROWS", 64)
    rng = np.random.default_rng(13)
    alphabet = "abcdefghijklmnopqrstuvwxyz"
    rows = []
    for k in range(50):
        words = ["".join(rng.choice(list(alphabet), 6)) for _ in range(12)]
        rows += [(100 * k + i, " ".join(rng.choice(words, 10)), f"x{k}") for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert (got.lang == got.lang_pred).mean() > 0.8 and got.lang_pred.nunique() > 40


def test_flow_only_where_sources_overlap():
    many = {(f"s{i}",): 10 for i in range(200_000)}
    given = mixing.routed(many | {("a", "b"): 10, ("a",): 5, (): 7}, {f"s{i}": i % 40 for i in range(200_000)} | {"a": 10, "b": 5})
    assert all(given[f"s{i}",] == min(i % 40, 30) for i in range(0, 200_000, 997))
    assert given["a", "b"] + given["a",] == 15 and given[()] == 0


def test_token_pieces_add_up():
    text = "some words 123, and more words! " * 50
    own = tokens._encoding(tokens.TOKENIZER_DIR, tokens.VERSION)
    assert sum(len(own.encode_ordinary(p)) for p in tokens.pieces(text, 40)) == len(own.encode_ordinary(text))


@pytest.fixture(scope="module")
def page_model():
    return extract.trained()


ONE = "Bees visit the lime trees in June, and the honey of that month is pale."
TWO = "The keeper opens each hive once a week. A weak swarm is fed with sugar, a strong one is left alone."
LINKS = '<ul><li><a href="/a">Clover</a></li><li><a href="/b">Lime tree</a></li><li><a href="/c">Wax moth</a></li></ul>'
LISTED = ["Clover", "Lime tree", "Wax moth"]


@pytest.mark.parametrize("html, blocks", [
    (f'<nav>{LINKS}</nav><article><h1>Bees</h1><p>{ONE}</p>{LINKS}<p>{TWO}</p></article>', ["Bees", ONE, *LISTED, TWO]),
    (f'<nav>{LINKS}</nav><div id="content"><h1>Bees</h1><p>{ONE}</p><p>{TWO}</p><h2>See also</h2>{LINKS}</div>',
     ["Bees", ONE, TWO, "See also", *LISTED]),
    (f'<article><h1>Bees</h1><section id="results"><h2>Results</h2><p>{ONE}</p></section>'
     f'<section id="discussion"><h2>Discussion</h2><p>{TWO}</p><p>{ONE}</p></section></article>',
     ["Bees", "Results", ONE, "Discussion", TWO, ONE]),
    (f'<article><h1>Bees</h1><p>{ONE}</p><p>{TWO}</p></article><section id="discussion"><h3>2 replies</h3>'
     '<div class="reply"><b>Jo</b><p>Thank you for this page.</p></div><div class="reply"><p>Mine sting.</p></div></section>',
     ["Bees", ONE, TWO]),
    (f'<table><tr><td colspan="2"><b>Village site</b></td></tr><tr><td><a href="/">Start</a> <a href="/n">News</a> '
     f'<a href="/k">Contact</a></td><td><h1>Bees</h1><p>{ONE}</p><p>{TWO}</p></td></tr><tr><td colspan="2">Copyright 2004</td></tr></table>',
     ["Bees", ONE, TWO]),
    (f'<article><h1>Bees</h1><p>{ONE}</p><table><tr><td>Hives</td><td>12</td></tr><tr><td>Honey</td><td>40 kg</td></tr></table><p>{TWO}</p></article>',
     ["Bees", ONE, "Hives", "12", "Honey", "40 kg", TWO]),
    (f'<div class="header">Bee Blog</div><div class="post"><h2>Bees</h2><p>{ONE}</p><p>{TWO}</p></div>', ["Bees", ONE, TWO]),
], ids="links see_also sections replies layout_table data_table header".split())
def test_what_belongs_to_an_article(page_model, html, blocks):
    page = f"<html><head><title>t</title></head><body>{html}</body></html>"
    assert extract.main_texts([page], page_model)[0].split("\n\n") == blocks


def test_extraction_of_unseen_layouts(page_model):
    model = page_model
    pages = extract.labelled_pages(120, seed=77)
    trees = [extract.parse(p) for p in pages]
    p, _ = extract.Batch(trees, model["index"]).run(model)
    y = np.concatenate([t.label for t in trees])
    runs = np.concatenate([[x is not None for x in t.text] for t in trees])
    assert ((p >= 0.5) == y)[runs].mean() > 0.98


def test_marginals_equal_enumeration():
    model = extract.train(extract.labelled_pages(20), steps=20)
    tree = extract.parse("<div><p>One two.</p><nav><a href=x>Home</a></nav></div>")
    b = extract.Batch([tree], model["index"])
    p, _ = b.run(model)
    n, total, on = len(b.parent), 0.0, np.zeros(len(b.parent))
    unary = np.bincount(b.owner, model["weight"][b.ids], n)
    for bits in range(2 ** n):
        y = [(bits >> i) & 1 for i in range(n)]
        w = np.exp(sum(unary[i] * y[i] for i in range(n)) + sum(model["edge"][b.kind[i]][y[b.parent[i]], y[i]] for i in range(1, n)))
        total += w
        on += w * np.array(y)
    assert np.allclose(p, on / total)


def test_broken_markup_keeps_the_rest_of_the_page():
    def texts(html):
        return [t for t in extract.parse(html).text if t is not None]
    assert texts("<p>a</p><![x[ y ]]><p>b</p>") == ["a", "b"]
    assert texts("<p>if x <![0] y></p><p>b</p>") == ["if x", "b"]
    assert texts("<p>a</p><![x") == ["a", "<![x"]
    assert texts(f"<p>a &#{'9' * 5000}; c</p><p>b</p>") == ["a \ufffd c", "b"]
    assert texts("<html><head><title>t</title><meta x><body><p>a</p>") == ["a"]
    assert texts("<head><title>t</title><link x>\n<p>a</p>") == ["a"]
    assert texts("<head><title>t</title> a<p>b</p>") == ["a", "b"]
    assert texts("<head><title>t<body><p>a</p>") == ["a"]
    assert texts("<head><title>t</head><p>a</p>") == ["a"]
    assert texts("<head><title>t</title><style>p{}</style></head><p>a</p>") == ["a"]
    for tag in ("noscript", "svg", "iframe", "template"):
        assert texts(f"<div><{tag}><g>x</div><p>a</p>") == ["a"]
        assert texts(f"<div><{tag}>x<{tag}>y</{tag}>z</{tag}></div><p>a</p>") == ["a"]
    assert texts("<div><svg><path d=1><p>a</p><p>b</p></div>") == ["a", "b"]
    assert texts("<svg><foreignObject><p>x</p></foreignObject></svg><p>a</p>") == ["a"]
    assert texts("<p>so <math><mi>x</mi><mo>=</mo></math> and <canvas>c</canvas> or <object>o</object></p>") == ["so x= and c or o"]
    assert texts("<div><object>o</div><p>a</p>") == ["o", "a"]
