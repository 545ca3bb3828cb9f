"""Secret scans: fixed patterns, and a character convolutional network over
every other candidate with its context.

Base findings follow three patterns (assignments, access keys, hex strings) and
are always reported; they are cut out of the text's runs of token characters
(letters, digits, ``+ / _ = -``). What is left of a run is a candidate if it has at least
``LONG`` characters, or at least ``SHORT`` with a digit, a sign or a capital after a small
letter; shorter ones and plain words are none. A candidate of any length is scored whole, in windows.

The network (one convolution of width five over character classes; the maximum and
the mean of each filter inside the candidate; one logistic unit) is written in numpy and trained on
labelled findings: the values of base findings of the corpus in their context, and made keys
of common forms in the contexts that keys have, against the corpus' other candidates and made
ordinary ones. Its outputs are calibrated by a logistic fit on validation rows, and the
threshold is the highest that keeps ``RECALL`` of the validation secrets, whatever that is.

Training reads every document. Each different window of a finding or another candidate trains
the network or, a quarter by hash, validates it: the first ``START_ROWS`` of either kind by hash
start it together with the made rows, all others train it further in shards, whose networks are
averaged after each pass. Calibration and threshold count every validation window. Null texts
count as empty. Repeated rows, and rows without an id, are documents of their own.
"""

from __future__ import annotations

import hashlib
import pickle
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boutique.llm.toxicity import fit_logistic

#: Windows of either kind that start the network; windows of a shard and passes over the shards.
START_ROWS = 4000
SHARD_ROWS, PASSES = 8192, 3
#: Logits of the validation windows in shards are counted in steps of this.
LOGIT_STEP = 2.0 ** -16
RECALL = 0.97
SHORT, LONG = 8, 16
BEFORE, INSIDE, AFTER = 24, 48, 8
WIDTH, FILTERS = 5, 16
MIN_GROUP = {"assign": 8, "access": 16, "hex": 32}
KINDS = ("assign", "access", "hex", "net")

ASSIGN = re.compile(r"""(?ai:(?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
#: Runs of 32 and more: shorter runs fail anyway, and runs don't overlap.
HEX = re.compile(r"[0-9a-f]{32,}")
RUN = re.compile(r"[A-Za-z0-9+/_=-]{8,}")
_MARKED = re.compile(r"[^A-Za-z]|[a-z][A-Z]")


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the base findings, by start, then kind."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= MIN_GROUP["assign"]]
    out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_GROUP["access"]]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return [(s, KINDS[k], e) for s, k, e in sorted(out)]


def candidates(text: str, taken: list[tuple[int, str, int]]) -> list[tuple[int, int]]:
    """Spans of the runs, without the base findings, that the network judges."""
    out = []
    for m in RUN.finditer(text):
        at, end = m.span()
        cuts = [(a, b) for a, _, b in taken if a < end and b > at]
        for a, b in [*sorted(cuts), (end, end)]:
            if a - at >= LONG or a - at >= SHORT and _MARKED.search(text, at, a):
                out.append((at, a))
            at = max(at, b)
    return out


def _classes() -> np.ndarray:
    """Character class of each code below 128: single letters and digits of a
    hexadecimal number, other letters in groups, signs one by one."""
    table = np.zeros(129, np.int64)
    for c in range(128):
        ch = chr(c)
        if ch in "0123456789":
            table[c] = 1 + c % 2
        elif "a" <= ch <= "f":
            table[c] = 3
        elif "A" <= ch <= "F":
            table[c] = 4
        elif ch in "aeiouy":
            table[c] = 5
        elif ch.islower():
            table[c] = 6 + c % 3
        elif ch.isupper():
            table[c] = 9 + c % 2
        elif ch in "+/=_-.:\"' \n":
            table[c] = 11 + "+/=_-.:\"' \n".index(ch)
        elif ch.isspace():
            table[c] = 11 + 9
        else:
            table[c] = 22
    table[128] = 23
    return table


N_CLASSES = 24
#: Each class is doubled: inside the candidate and in its context.
CHANNELS = 2 * N_CLASSES


_CLASS_CACHE: dict = {}
LENGTH = BEFORE + INSIDE + AFTER


def windows(text: str, found: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Class codes (windows, LENGTH) of candidates with their context, and the
    candidate of each; a long one gives several overlapping windows."""
    table = _CLASS_CACHE.setdefault("table", _classes())
    starts = [(i, at, min(e, at + INSIDE)) for i, (s, e) in enumerate(found)
              for at in range(s, max(e - WIDTH, s + 1), INSIDE - WIDTH)]
    owner, at, stop = (np.array(x, np.int64) for x in zip(*starts)) if starts else (np.zeros(0, np.int64),) * 3
    chars = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    place = at[:, None] - BEFORE + np.arange(LENGTH)[None, :]
    known = (place >= 0) & (place < len(chars))
    codes = np.where(known, np.minimum(chars[np.clip(place, 0, max(len(chars) - 1, 0))], 128), 32) if len(chars) else place * 0 + 32
    k = table[codes]
    k[(place >= at[:, None]) & (place < stop[:, None])] += N_CLASSES
    return k, owner


def _convolve(x: np.ndarray, net: dict):
    """Pooled responses of (rows, LENGTH) class codes: the maximum and the mean of each
    filter over the places inside the candidate; and what back-propagation needs."""
    z = np.zeros((len(x), LENGTH - WIDTH + 1, FILTERS), np.float32)
    for i in range(WIDTH):
        z += net["conv"][i][x[:, i:LENGTH - WIDTH + 1 + i]]
    z = np.maximum(z + net["bias"], 0)
    inside = (x[:, WIDTH // 2:LENGTH - WIDTH // 2] >= N_CLASSES).astype(np.float32)
    share = inside / np.maximum(inside.sum(axis=1, keepdims=True), 1)
    place = z.argmax(axis=1)
    top = np.take_along_axis(z, place[:, None, :], axis=1)[:, 0]
    return np.concatenate([top, (z * share[:, :, None]).sum(axis=1)], axis=1), place, z, share


def forward(x: np.ndarray, net: dict) -> np.ndarray:
    return _convolve(x, net)[0] @ net["out"] + net["out_bias"]


def _descend(net: dict, square: dict, x: np.ndarray, y: np.ndarray, weight: np.ndarray, step: float) -> None:
    """One step down the gradient of the weighted logistic loss."""
    pooled, place, z, share = _convolve(x, net)
    p = 1 / (1 + np.exp(-np.clip(pooled @ net["out"] + net["out_bias"], -30, 30)))
    d = (weight * (p - y) / len(x)).astype(np.float32)
    back = (d[:, None] * net["out"][None, FILTERS:])[:, None, :] * share[:, :, None]
    first = np.take_along_axis(back, place[:, None, :], axis=1) + (d[:, None] * net["out"][None, :FILTERS])[:, None, :]
    np.put_along_axis(back, place[:, None, :], first, axis=1)
    back *= z > 0
    grad = {"out": pooled.T @ d + 1e-4 * net["out"], "out_bias": d.sum(), "bias": back.sum(axis=(0, 1)),
            "conv": np.zeros_like(net["conv"])}
    flat = back.reshape(-1, FILTERS)
    for i in range(WIDTH):
        code = x[:, i:LENGTH - WIDTH + 1 + i].reshape(-1)
        by = np.argsort(code, kind="stable")
        start = np.flatnonzero(np.diff(code[by], prepend=-1))
        grad["conv"][i][code[by][start]] = np.add.reduceat(flat[by], start, axis=0)
    for k, g in grad.items():  # root-mean-square scaled steps
        square[k] = 0.9 * square[k] + 0.1 * np.square(g)
        net[k] = (net[k] - step * g / (np.sqrt(square[k]) + 1e-6)).astype(np.float32)


def _balanced(y: np.ndarray) -> np.ndarray:
    return np.where(y == 1, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9)).astype(np.float32)


def train_network(x: np.ndarray, y: np.ndarray, epochs: int = 24, seed: int = 7) -> tuple[dict, dict]:
    """The network, and the mean squares of its gradients."""
    rng = np.random.default_rng(seed)
    net = {"conv": rng.normal(0, 0.3, (WIDTH, CHANNELS, FILTERS)).astype(np.float32),
           "bias": np.zeros(FILTERS, np.float32),
           "out": rng.normal(0, 0.3, 2 * FILTERS).astype(np.float32), "out_bias": np.float32(0)}
    square = {k: np.zeros_like(np.asarray(v)) for k, v in net.items()}
    weight = _balanced(y)
    for epoch in range(epochs):
        order = rng.permutation(len(x))
        step = 0.01 if epoch < epochs * 2 // 3 else 0.002
        for at in range(0, len(x), 64):
            rows = order[at:at + 64]
            _descend(net, square, x[rows], y[rows], weight[rows], step)
    return net, square


_LOWER, _UPPER, _DIGIT = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
_ANY, _HEXES = _LOWER + _UPPER + _DIGIT, "0123456789abcdef"
_SYLLABLES = ["er", "on", "the", "ing", "ver", "la", "de", "mente", "ch", "ou", "tion", "re", "au", "schaft", "keit", "ly", "st", "an",
              "ci", "os", "ter", "ent", "ble", "pro", "con", "ge", "un", "eau", "ique"]


def _forms(rng):
    """Makers of keys seen in training, of keys held back from it, and of ordinary tokens."""
    pick = lambda a, k: "".join(rng.choice(list(a), k))
    some = lambda a, b: int(rng.integers(a, b))
    word = lambda: "".join(rng.choice(_SYLLABLES, some(1, 5)))
    seen = [
        lambda: "ghp_" + pick(_ANY, 36), lambda: "sk_live_" + pick(_ANY, some(10, 25)),
        lambda: "xoxb-" + pick(_DIGIT, 11) + "-" + pick(_ANY, 24), lambda: "AIza" + pick(_ANY + "_-", 35),
        lambda: "eyJ" + pick(_ANY, 30), lambda: pick(_ANY + "+/", 40), lambda: pick(_UPPER + _DIGIT, some(16, 25)),
        lambda: pick(_ANY, some(10, 33)), lambda: pick(_LOWER + _DIGIT, some(10, 29)), lambda: pick(_LOWER, some(20, 33)),
        lambda: pick(_HEXES, some(16, 31)),
    ]
    unseen = [
        lambda: "npm_" + pick(_ANY, 36), lambda: "glpat-" + pick(_ANY, 20), lambda: pick(_LOWER + _UPPER, some(20, 33)),
        lambda: word()[:4] + pick(_DIGIT, 1) + pick(_ANY, 6) + pick(_DIGIT, 1), lambda: "whsec_" + pick(_ANY, 32),
    ]
    plain = [
        lambda: "-".join(pick(_DIGIT, 4) for _ in range(4)), lambda: "_".join(word() for _ in range(some(2, 6))) + "_" + pick(_DIGIT, some(1, 3)),
        lambda: "/" + "/".join(word() for _ in range(some(2, 5))) + "/" + pick(_DIGIT, some(1, 6)), lambda: "".join(word() for _ in range(5)),
        lambda: word() * some(2, 5) + pick(_DIGIT, some(1, 5)), lambda: f"20{pick(_DIGIT, 2)}-0{some(1, 10)}-{some(10, 29)}",
        lambda: pick(_HEXES, 8) + "-" + pick(_HEXES, 4) + "-4" + pick(_HEXES, 3) + "-a" + pick(_HEXES, 3) + "-" + pick(_HEXES, 12),
        lambda: "x" * some(8, 20) + pick(_DIGIT, some(0, 6)), lambda: "=" * some(8, 24) + word(),
        lambda: "-".join(word() for _ in range(some(2, 7))), lambda: pick(_DIGIT, some(8, 17)), lambda: "555-" + pick(_DIGIT, 4) + "-" + pick(_DIGIT, 4),
        lambda: word() + "".join(word().capitalize() for _ in range(some(1, 4))), lambda: (word() + word() + word() + word()).capitalize(),
        lambda: word() + "//" + word() + "/" + word(), lambda: "v" + pick(_DIGIT, 1) + "-" + word() + "-build" + pick(_DIGIT, 3),
        lambda: word() + pick(_DIGIT, 4), lambda: "20" + pick(_DIGIT, 6) + "T" + pick(_DIGIT, 6) + "Z",
    ]
    return seen, unseen, plain, word


def generated(n: int, seed: int = 11, held_back: bool = False) -> list[tuple[str, int, int, int]]:
    """(text, start, end, label): made keys of common forms in common contexts, and
    ordinary tokens in prose; with ``held_back`` keys of forms that training doesn't have."""
    rng = np.random.default_rng(seed)
    seen, unseen, plain, word = _forms(rng)
    around = [("key: ", ""), ("export KEY=", ""), ("Authorization: Bearer ", ""), ("auth ", ""), ("", ""), ("credentials ", ""),
              ("postgres://user:", "@host/db"), ("https://bot:", "@git.example"), ("--password ", " --host"), ("pwd is ", "."), ('"', '"'), ("(", ")")]
    calm = [("", ""), ("", ","), ("", "."), ("see ", ""), ("(", ")"), ("file ", ""), ("https://", ""), ("id: ", ""), ("call ", ""), ("# ", "")]
    out = []
    while len(out) < n:
        label = len(out) % 2
        makers, contexts = (unseen if held_back else seen, around) if label else (plain, calm)
        token = makers[int(rng.integers(len(makers)))]()
        left, right = contexts[int(rng.integers(len(contexts)))]
        lead = " ".join(word() for _ in range(4)) + " " + left
        text = f"{lead}{token}{right} {word()} {word()}"
        # As at scan time: only what is a candidate, as it is cut there.
        found = [c for c in candidates(text, base_spans(text)) if c[0] < len(lead) + len(token) and c[1] > len(lead)]
        if found:
            out.append((text, *max(found, key=lambda c: c[1] - c[0]), label))
    return out


def _training_rows(batches):
    """First windows of the values of base findings and of other candidates."""
    for batch in batches:
        codes, labels = [], []
        for t in batch.column("text"):
            text = t.as_py() or ""
            base = base_spans(text)
            values = [(m.start(1), m.end(1)) for m in ASSIGN.finditer(text) if len(m[1]) >= MIN_GROUP["assign"]]
            values += [(s, e) for s, k, e in base if k != "assign"]
            for some, label in ((values, 1), (candidates(text, base), 0)):
                if some:
                    k, owner = windows(text, some)
                    first = np.flatnonzero(np.diff(owner, prepend=-1))
                    codes += [w.astype(np.int8).tobytes() for w in k[first]]
                    labels += [label] * len(first)
        yield pa.RecordBatch.from_arrays([pa.array(codes, pa.binary()), pa.array(labels, pa.int32())],
                                         names=["codes", "label"])


def _validates(codes: bytes) -> bool:
    """Whether a window (class codes as bytes) validates the network instead of training it."""
    return hashlib.md5(np.frombuffer(codes, np.int8).astype(np.int64).tobytes()).digest()[0] % 4 == 0


def _folded(batches):
    for batch in batches:
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([_validates(c) for c in batch.column("codes").to_pylist()], pa.bool_())],
                                         names=[*batch.schema.names, "fold"])


def _matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.int8).reshape(-1, LENGTH).astype(np.int64)


def _shard_pass(net: dict, square: dict, x: np.ndarray, y: np.ndarray, share: float, number: int):
    """A pass over one shard's windows, from the common network: each step takes some of them and as
    many of the start's rows (x, y), so neither drowns the other. ``share`` of all shards' windows are findings."""
    held, weight = x.astype(np.int8), _balanced(y)

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("codes", "ascending"), ("label", "ascending")])
        shard, codes = table.column("shard")[0].as_py(), _matrix(table.column("codes"))
        label = table.column("label").to_numpy().astype(float)
        own_weight = np.where(label == 1, 0.5 / max(share, 1e-9), 0.5 / max(1 - share, 1e-9)) if 0 < share < 1 else np.ones(len(label))
        own, squares, rng = dict(net), dict(square), np.random.default_rng([number, shard])
        order = rng.permutation(len(codes))
        for at in range(0, len(order), 32):
            some, more = order[at:at + 32], rng.integers(0, len(held), 32)
            _descend(own, squares, np.concatenate((codes[some], held[more].astype(np.int64))), np.concatenate((label[some], y[more])),
                     np.concatenate((own_weight[some], weight[more])), 0.002)
        return pa.table({"shard": pa.array([shard], pa.int64()), "n": pa.array([len(codes)], pa.int64()),
                         "state": pa.array([pickle.dumps((own, squares))], pa.binary())})
    return run


def _averaged(rows: list) -> list[dict]:
    """The states of the shards, each by its number of windows."""
    total = sum(r["n"] for r in rows)
    parts = [(r["n"] / total, pickle.loads(bytes(r["state"]))) for r in sorted(rows, key=lambda r: r["shard"])]
    return [{k: sum(w * np.asarray(p[i][k], float) for w, p in parts).astype(np.float32) for k in parts[0][1][i]} for i in (0, 1)]


def _logits(net: dict):
    """(z, label) of each validation window, z in whole steps."""
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column("codes"))
                z = np.concatenate([forward(x[at:at + 512], net) for at in range(0, len(x), 512)])
                yield pa.RecordBatch.from_arrays([pa.array(np.floor(z / LOGIT_STEP).astype(np.int64)), batch.column("label")], names=["z", "label"])
    return run


def train(docs: DataFrame) -> dict:
    rows = (docs.where(F.col("text").isNotNull()).select("text").mapInArrow(_training_rows, "codes binary, label int")
            .distinct().withColumn("h", F.xxhash64("codes")).checkpoint(eager=True))
    x, y, later = [], [], F.lit(False)
    for label in (1, 0):
        first = rows.where(F.col("label") == label).orderBy("h", "codes").limit(START_ROWS).collect()
        x += [np.frombuffer(bytes(r["codes"]), np.int8).astype(np.int64) for r in first]
        y += [label] * len(first)
        if len(first) == START_ROWS:
            h, codes = F.lit(first[-1]["h"]), F.lit(bytes(first[-1]["codes"]))
            later |= (F.col("label") == label) & ((F.col("h") > h) | (F.col("h") == h) & (F.col("codes") > codes))
    for text, s, e, label in generated(4000):
        x.append(windows(text, [(s, e)])[0][0])
        y.append(label)
    x, y = np.array(x, np.int64), np.array(y, float)
    fold = np.array([hashlib.md5(row.tobytes()).digest()[0] % 4 == 0 for row in x])
    net, square = train_network(x[~fold], y[~fold])
    z, of = forward(x[fold], net), y[fold]
    rest = rows.where(later).mapInArrow(_folded, "codes binary, label int, h long, fold boolean").checkpoint(eager=True)
    trains = rest.where(~F.col("fold"))
    n, found = trains.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    if n:
        shards = trains.withColumn("shard", F.pmod("h", F.lit(-(-n // SHARD_ROWS)))).select("shard", "codes", "label")
        for number in range(PASSES):
            work = _shard_pass(net, square, x[~fold], y[~fold], found / n, number)
            net, square = _averaged(shards.groupBy("shard").applyInArrow(work, "shard long, n long, state binary").collect())
        z = forward(x[fold], net)
    more = rest.where("fold").select("codes", "label").mapInArrow(_logits(net), "z long, label int").groupBy("z", "label").count().collect()
    if more:
        times = [r["count"] for r in more]
        z = np.concatenate((z, np.repeat([r["z"] * LOGIT_STEP for r in more], times)))
        of = np.concatenate((of, np.repeat([float(r["label"]) for r in more], times)))
    net["scale"] = [float(v) for v in fit_logistic(z[:, None], of, ridge=1e-3)]
    found = np.sort(probability(z, net)[of == 1])
    net["threshold"] = float(found[int((1 - RECALL) * len(found))])
    return net


def probability(z: np.ndarray, net: dict) -> np.ndarray:
    a, b = net["scale"]
    return 1 / (1 + np.exp(-np.clip(a * z + b, -30, 30)))


def text_spans(text: str, net: dict) -> list[tuple[int, str, int]]:
    """All findings of one text, by start, then kind."""
    base = base_spans(text)
    extra = []
    own = candidates(text, base)
    if own:
        best = np.full(len(own), -np.inf)
        for low in range(0, len(own), 512):
            k, owner = windows(text, own[low:low + 512])
            for at in range(0, len(k), 512):
                np.maximum.at(best, low + owner[at:at + 512], forward(k[at:at + 512], net))
        good = probability(best, net) >= net["threshold"]
        extra = [(s, "net", e) for (s, e), g in zip(own, good) if g]
    return sorted(base + extra, key=lambda x: (x[0], KINDS.index(x[1]), x[2]))


def _digest(spans: list[tuple[int, str, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, k, e in spans)


def _scan(net: dict):
    def run(batches):
        for batch in batches:
            cols: list[list] = [[], [], [], [], []]
            for t in batch.column("text"):
                spans = text_spans(t.as_py() or "", net)
                base = [x for x in spans if x[1] != "net"]
                for k, kind in enumerate(KINDS[:3]):
                    cols[k].append(sum(x[1] == kind for x in base))
                cols[3].append(hashlib.sha256(_digest(base).encode()).hexdigest())
                cols[4].append(_digest(spans))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(c, pa.int64()) for c in cols[:3]],
                 pa.array(cols[3], pa.string()), pa.array(cols[4], pa.string())],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])
    return run


def scan(docs: DataFrame) -> DataFrame:
    """Findings of every document."""
    net = train(docs)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _scan(net), "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def redacted(text: str, net: dict) -> str:
    """``text`` with each finding (overlapping ones as one) replaced."""
    out, at, last = [], 0, 0
    for s, _, e in text_spans(text, net):
        if s >= last:
            out += [text[at:s], "[secret]"]
        at = last = max(last, e)
    return "".join(out) + text[at:]


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with the findings in ``text`` replaced and ``n_chars`` (if there
    is one) corrected. Other columns stay."""
    net = train(docs)
    columns = docs.columns
    own = docs.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(columns)])
    at = columns.index("text")

    def run(batches):
        for batch in batches:
            texts = [None if t.as_py() is None else redacted(t.as_py(), net) for t in batch.column(at)]
            arrays = [pa.array(texts, pa.string()) if i == at else c for i, c in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays(arrays, names=batch.schema.names)

    done = own.mapInArrow(run, own.schema)
    out = done.select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(columns)])
    if "n_chars" in columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars"))
                             .otherwise(F.length("text")).cast(kind))
    return out.select(*columns)
