"""The network of the secret scan learns from every document."""

import numpy as np

from boutique.llm import secrets


def _documents(spark, n=160):
    rows = [(None if i % 9 == 0 else i, f"{t[:s]}{t[s:e]}{t[e:]} password={'ab1' * 3}{i:04d}") for i, (t, s, e, _) in enumerate(secrets.generated(n, seed=5))]
    return spark.createDataFrame([*rows, rows[3], (7, None)], "doc_id long, text string")


def _windows(docs):
    (batch,) = [b for b in docs.select("text").na.drop().coalesce(1).toArrow().combine_chunks().to_batches()]
    (out,) = secrets._training_rows([batch])
    return set(zip(out.column("codes").to_pylist(), out.column("label").to_pylist()))


def test_every_window_trains_or_validates(spark, monkeypatch):
    docs = _documents(spark)
    monkeypatch.setattr(secrets, "START_ROWS", 20)
    monkeypatch.setattr(secrets, "SHARD_ROWS", 64)
    started, validated, passed = [], [], []
    train, average = secrets.train_network, secrets._averaged
    monkeypatch.setattr(secrets, "train_network", lambda x, y: started.append(len(x)) or train(x, y, epochs=1))
    monkeypatch.setattr(secrets, "_averaged", lambda rows: passed.append((len(rows), sum(r["n"] for r in rows))) or average(rows))
    monkeypatch.setattr(secrets, "fit_logistic", lambda z, y, ridge: validated.append(len(z)) or np.array([1.0, 0.0]))
    secrets.train(docs)
    every = _windows(docs)
    assert len(every) > 160
    assert started[0] + passed[0][1] + validated[0] == len(every) + 4000
    assert len(passed) == secrets.PASSES and len(set(passed)) == 1 and passed[0][0] > 1


def test_few_windows_need_no_shards_and_layout_does_not_matter(spark, monkeypatch):
    docs = _documents(spark, 40)
    monkeypatch.setattr(secrets, "train_network", lambda x, y, f=secrets.train_network: f(x, y, epochs=1))
    one = secrets.train(docs.repartition(1))
    monkeypatch.setattr(secrets, "_averaged", None)  # not called
    other = secrets.train(docs.repartition(5))
    assert np.array_equal(one["conv"], other["conv"]) and one["threshold"] == other["threshold"]
