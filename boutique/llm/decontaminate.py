"""Benchmark decontamination by template canonicalisation.

Texts become tokens (runs of letters, digits and non-ASCII bytes, A-Z in lower
case). Numbers, names and units become typed placeholders: a number is a token
that starts with a digit (a decimal or grouped number is one) or a number word, a
unit is a unit word right after a number, a name is a capitalised word. One that
begins a sentence may be either, so its windows are hashed both ways. Windows of
``WINDOW`` tokens are hashed and joined by equality with the windows of the
benchmark, so a question with other numbers, names or units still meets its
template. A template needs at least ``MIN_LITERALS`` ordinary words; the exact
words of a window are hashed too and need none. For every document, item and
alignment the placeholder values are then compared: one value of the item must
stand for one value of the document. Windows that disagree end a run; the longest
consistent run, or the windows that agree with the commonest values, mark the
document if they cover ``ENOUGH`` tokens or half of the item.

Items of 4 to 7 tokens are matched as one window of their own length, and only where
it stands for itself in the document: between sentence ends, line ends, quotation marks, brackets or
the ends of the text. The same few words inside a longer sentence are ordinary
language. Shorter items say too little and match nothing. Documents send only windows that may be in
the benchmark: those whose bit is set in a map, which is all that is broadcast. It has
``BITS_PER_WINDOW`` bits for each benchmark window, between 512 KB and 64 MB (reached at 34 million
windows); a fuller map lets more windows through to the join and changes no result. Null and empty texts match nothing; rows with the same id are
marked together; rows without an id are never marked.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boutique.llm.common import (ascii_lower, blocks, mix64, row_groups, run_hashes, signed, spans,
                                 string_bytes, written)

WINDOW = 8
SHORTEST = 4
MIN_LITERALS = 5
ENOUGH = 13
#: Bits of the map for a benchmark window, and the exponents of its smallest and largest size.
BITS_PER_WINDOW = 16
MAP_BITS = (22, 29)
#: Bits of a page, in which the map comes to the driver.
PAGE = 1 << 15

# Words that are numbers, and words that are units after a number.
NUMBER_WORDS = """zero two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen
seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million
billion""".split()
UNITS = """mm cm dm m km in ft yd mi inch inches foot feet yard yards mile miles meter meters metre metres
kilometer kilometers kilometre kilometres mg g kg t lb lbs oz gram grams kilogram kilograms ton tons tonne tonnes
pound pounds ounce ounces ml cl l liter liters litre litres gallon gallons cup cups s sec secs second seconds
min mins minute minutes h hr hrs hour hours day days week weeks month months year years usd eur gbp dollar dollars
euro euros cent cents percent degrees c f k hz khz mhz ghz w kw mw v kv a b kb mb gb tb mph kmh""".split()

_TYPES = np.array([0, 0x6E756D, 0x756E6974, 0x6E616D65], np.uint64)
#: OPENER: a capitalised word that begins a sentence.
WORD, NUMBER, UNIT, NAME, OPENER = range(5)
_READINGS = np.array([[WORD, NUMBER, UNIT, NAME, WORD], [WORD, NUMBER, UNIT, NAME, NAME]], np.int8)
_CACHE: dict = {}


def _tables() -> dict:
    if not _CACHE:
        inside = np.zeros(256, bool)
        inside[48:58] = inside[65:91] = inside[97:123] = True
        inside[128:] = True
        ends = np.zeros(256, np.int64)
        ends[[ord(c) for c in ".!?\n:;"]] = 1
        edges = ends.copy()
        edges[[ord(c) for c in "\"()[]{}<>|*#"]] = 1

        def known(words):
            h = []
            for w in words:
                data = np.frombuffer(w.encode(), np.uint8)
                h.append(run_hashes(data, np.ones(len(data), bool), np.array([0]), np.array([len(data)]))[0])
            return np.sort(np.array(h, np.uint64))

        _CACHE.update(inside=inside, ends=ends, edges=edges, numbers=known(NUMBER_WORDS), units=known(UNITS),
                      types=mix64(_TYPES))
    return _CACHE


def _member(x: np.ndarray, sorted_values: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(sorted_values, x), len(sorted_values) - 1)
    return sorted_values[at] == x


def tokens(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start byte, value hash and type of the tokens of a byte string that may
    hold several texts with boundaries marked by a newline, and whether an edge
    (a sentence end, line end, quotation mark or bracket) comes before the token."""
    t = _tables()
    inside = t["inside"][data]
    starts, ends = spans(inside)
    if not len(starts):
        return starts, np.zeros(0, np.uint64), np.zeros(0, np.int8), np.zeros(0, bool)
    folded = ascii_lower()[data]
    values = run_hashes(folded, inside, starts, ends)
    first = data[starts]
    digit = (first >= 48) & (first <= 57)
    kind = np.where(digit | _member(values, t["numbers"]), NUMBER, WORD).astype(np.int8)
    # A point or comma between two digit tokens joins them to one number.
    gap = starts[1:] - ends[:-1]
    sign = data[np.minimum(ends[:-1], len(data) - 1)]
    glued = np.concatenate(([False], digit[1:] & digit[:-1] & (gap == 1) & ((sign == 46) | (sign == 44))))
    # Capitalised words, and whether they come after the end of a sentence.
    stops = np.concatenate(([0], np.cumsum(t["ends"][data])))
    fresh = np.concatenate(([True], stops[starts[1:]] > stops[ends[:-1]]))
    marks = np.concatenate(([0], np.cumsum(t["edges"][data])))
    edge = np.concatenate((marks[starts[:1]] > 0, marks[starts[1:]] > marks[ends[:-1]]))
    second = data[np.minimum(starts + 1, len(data) - 1)]
    capital = (first >= 65) & (first <= 90) & (ends - starts > 1) & (((second >= 97) & (second <= 122)) | (second >= 128))
    named = capital & (kind == WORD)
    kind[named] = np.where(fresh[named], OPENER, NAME)
    after_number = np.concatenate(([False], kind[:-1] == NUMBER))
    kind[after_number & ((kind == WORD) | (kind == OPENER)) & _member(values, t["units"])] = UNIT
    if glued.any():
        head = np.flatnonzero(~glued)
        group = np.cumsum(~glued) - 1
        merged = np.zeros(len(head), np.uint64)
        place = np.arange(len(glued)) - head[group]
        np.add.at(merged, group, values * (place.astype(np.uint64) * np.uint64(2) + np.uint64(1)))
        return starts[head], merged, kind[head], edge[head]
    return starts, values, kind, edge


def text_tokens(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Values, types and edges of one text of any length."""
    t = _tables()
    word = np.ones(256, bool)
    word[[0x20, *range(0x09, 0x0E)]] = False
    values, kinds, edges = [], [], []
    open_edge = True  # an edge since the last token; the text begins with one
    for a, b in blocks(data, word):
        starts, v, k, e = tokens(data[a:b])
        if len(starts):
            e[0] |= open_edge
            tail = data[a + starts[-1]:b]
            # A token holds no edge but the point between its digits, after which it goes on.
            last = np.flatnonzero(t["inside"][tail])[-1]
            open_edge = bool(t["edges"][tail[last + 1:]].any())
        else:
            open_edge |= bool(t["edges"][data[a:b]].any())
        values.append(v)
        kinds.append(k)
        edges.append(e)
    if not values:
        return np.zeros(0, np.uint64), np.zeros(0, np.int8), np.zeros(0, bool)
    return np.concatenate(values), np.concatenate(kinds), np.concatenate(edges)


def each_text(column: pa.Array):
    """Values, types and edges of the tokens of each text."""
    data, offsets = string_bytes(column)
    for a, b in row_groups(offsets):
        if b == a + 1:
            yield text_tokens(data[offsets[a]:offsets[b]])
            continue
        # A newline between texts keeps them apart.
        parts = []
        for i in range(a, b):
            parts += [data[offsets[i]:offsets[i + 1]], np.array([10], np.uint8)]
        joined = np.concatenate(parts)
        bounds = np.concatenate(([0], np.cumsum(np.diff(offsets[a:b + 1]) + 1)))
        starts, values, kinds, edges = tokens(joined)
        edges[:1] = True
        at = np.searchsorted(starts, bounds)
        for i in range(b - a):
            yield values[at[i]:at[i + 1]], kinds[at[i]:at[i + 1]], edges[at[i]:at[i + 1]]


def template_windows(values: np.ndarray, kinds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the template of each window, and whether it has enough words."""
    n = len(values) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, bool)
    parts = np.where(kinds == WORD, values, _tables()["types"][kinds])
    total, factor = np.zeros(n, np.uint64), 1
    for i in range(size):
        factor = factor * 0xD6E8FEB86659FD93 % (1 << 64)
        total += parts[i:i + n] * np.uint64(factor)
    literal = np.concatenate(([0], np.cumsum(kinds == WORD)))
    enough = literal[size:] - literal[:-size] >= min(MIN_LITERALS, size - 1)
    return mix64(total + np.uint64(size)), enough


def _slots(values, kinds, at, size):
    """Values of the placeholders of a window, their types mixed in."""
    k = kinds[at:at + size]
    where = np.flatnonzero(k != WORD)
    return signed(mix64(values[at:at + size][where] + k[where].astype(np.uint64)))


def readings(values, kinds, size):
    """(place, hash, kinds) arrays of the windows to compare: the template with
    sentence openers as words and as names, and the exact words. A hash that an
    earlier reading gave the same window isn't repeated."""
    plain, named = _READINGS[0][kinds], _READINGS[1][kinds]
    seen = []
    for k, exact in ((plain, False), (named, False), (np.zeros_like(kinds), True)):
        h, enough = template_windows(values, k, size)
        use = np.ones(len(h), bool) if exact else enough.copy()
        for earlier, used in seen:
            use &= ~(used & (earlier == h))
        seen.append((h, use))
        yield np.flatnonzero(use), h, k


def stands_alone(places: np.ndarray, edges: np.ndarray, size: int) -> np.ndarray:
    """The windows that have an edge, or an end of the text, on both sides."""
    after = np.append(edges, True)
    return places[edges[places] & after[places + size]]


def _benchmark_windows(batches):
    for batch in batches:
        rows = [[], [], [], [], [], []]
        for item, (values, kinds, _) in zip(batch.column("item_id").to_pylist(), each_text(batch.column("text"))):
            size = min(WINDOW, len(values))
            if item is None or size < SHORTEST:
                continue
            for places, h, k in readings(values, kinds, size):
                # The exact words keep the placeholders: each stands for itself.
                k = k if k.any() else _READINGS[0][kinds]
                for at in places:
                    for c, v in zip(rows, (item, len(values), size, int(at), int(signed(h[at:at + 1])[0]),
                                           _slots(values, k, at, size))):
                        c.append(v)
        longs = pa.int64()
        yield pa.RecordBatch.from_arrays(
            [*[pa.array(c, longs) for c in rows[:5]], pa.array(rows[5], pa.list_(longs))],
            names=["item_id", "item_tokens", "size", "item_at", "h", "item_slots"])


def _page(table: pa.Table) -> pa.Table:
    bits = np.zeros(PAGE, np.uint8)
    bits[table.column("bit").to_numpy() % PAGE] = 1
    return pa.table({"page": table.column("page")[:1], "bits": pa.array([np.packbits(bits, bitorder="little").tobytes()])})


def window_map(windows: DataFrame) -> np.ndarray:
    """A map of the leading bits of the hashes ``h``, eight to a byte."""
    n = windows.count()
    exponent = min(max((BITS_PER_WINDOW * n).bit_length(), MAP_BITS[0]), MAP_BITS[1])
    pages = (windows.select(F.shiftrightunsigned("h", 64 - exponent).alias("bit")).distinct()
             .withColumn("page", F.floor(F.col("bit") / PAGE)).groupBy("page").applyInArrow(_page, "page long, bits binary"))
    out = np.zeros(1 << (exponent - 3), np.uint8)
    for r in pages.toLocalIterator():
        out[r["page"] * (PAGE >> 3):(r["page"] + 1) * (PAGE >> 3)] = np.frombuffer(r["bits"], np.uint8)
    return out


def may_hold(bitmap: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Which of the hashes have their bit set in the map."""
    bit = h >> np.uint64(64 - (len(bitmap).bit_length() + 2))
    return ((bitmap[(bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1).astype(bool)


def _document_windows(bitmap: np.ndarray, sizes: list[int]):
    def run(batches):
        for batch in batches:
            ids, ats, hs, slots = [], [], [], []
            for doc, (values, kinds, edges) in zip(batch.column("doc_id").to_pylist(), each_text(batch.column("text"))):
                for size in sizes:
                    if len(values) < size:
                        continue
                    for places, h, k in readings(values, kinds, size):
                        if size < WINDOW:
                            places = stands_alone(places, edges, size)
                        places = places[may_hold(bitmap, h[places])]
                        for at in places:
                            ids.append(doc)
                            ats.append(int(at))
                            slots.append(_slots(values, k, at, size))
                        hs.append(signed(h[places]))
            longs = pa.int64()
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, longs), pa.array(ats, longs),
                 pa.array(np.concatenate(hs) if hs else np.zeros(0, np.int64), longs), pa.array(slots, pa.list_(longs))],
                names=["doc_id", "at", "h", "slots"])
    return run


def _span(places: list[int], size: int) -> int:
    """Tokens under the union of windows: each adds the distance to the next, at most its size."""
    return sum(min(b - a, size) for a, b in zip(places, places[1:])) + size if places else 0


def consistent_cover(windows: list[tuple[int, list[int], list[int]]], size: int) -> int:
    """Most tokens under windows (place, item values, document values) of one
    alignment in which an item value stands for one document value."""
    best: dict[int, list[tuple[int, int]]] = {}
    for at, a, b in windows:
        pairs = sorted(set(zip(a, b)))
        if at not in best or (len(pairs), pairs) < (len(best[at]), best[at]):
            best[at] = pairs  # the reading with the fewest placeholders
    rows = [(at, pairs) for at, pairs in sorted(best.items()) if len({a for a, _ in pairs}) == len(pairs)]
    # The windows that agree with the commonest value of each item value.
    votes = Counter(p for _, pairs in rows for p in pairs)
    chosen: dict[int, int] = {}
    for (a, b), _ in sorted(votes.items(), key=lambda v: (-v[1], v[0])):
        chosen.setdefault(a, b)
    covered = _span([at for at, pairs in rows if all(chosen[a] == b for a, b in pairs)], size)
    # The longest run: from the left, a window leaves as long as its values clash with the newest.
    value: dict[int, int] = {}
    uses: Counter = Counter()
    first = total = 0
    for k, (at, pairs) in enumerate(rows):
        total += min(at - rows[k - 1][0], size) if k > first else size
        for a, b in pairs:
            while uses[a] and value[a] != b:
                for x, _ in rows[first][1]:
                    uses[x] -= 1
                first += 1
                total = total - min(rows[first][0] - rows[first - 1][0], size)
        for a, b in pairs:
            value[a] = b
            uses[a] += 1
        covered = max(covered, total)
    return covered


def _covers(batches):
    """The cover of each alignment that marks its document."""
    for batch in batches:
        sizes, totals = batch.column("size").to_pylist(), batch.column("item_tokens").to_pylist()
        rows, covers = [], []
        for i, windows in enumerate(batch.column("windows")):
            covered = consistent_cover([(w["item_at"], w["item_slots"], w["slots"]) for w in windows.as_py()], sizes[i])
            if covered >= ENOUGH or 2 * covered >= totals[i]:
                rows.append(i)
                covers.append(covered)
        take = pa.array(rows, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id").take(take), batch.column("item_id").take(take), pa.array(covers, pa.int64()),
             batch.column("item_tokens").take(take)], names=["doc_id", "item_id", "covered", "item_tokens"])


def matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, covered, item_tokens of the alignments that mark a document."""
    windows = written(benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").mapInArrow(
        _benchmark_windows, "item_id long, item_tokens long, size long, item_at long, h long, item_slots array<long>"), "windows")
    sizes = sorted(r["size"] for r in windows.select("size").distinct().collect())
    found = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _document_windows(window_map(windows), sizes), "doc_id long, at long, h long, slots array<long>")
    # A window without placeholders met its exact words.
    exact = F.size("slots") == 0
    aligned = (found.join(windows, "h").where(exact | (F.size("slots") == F.size("item_slots")))
               .withColumn("slots", F.when(exact, F.col("item_slots")).otherwise(F.col("slots")))
               .groupBy("doc_id", "item_id", "item_tokens", "size", (F.col("at") - F.col("item_at")).alias("shift"))
               .agg(F.collect_set(F.struct("item_at", "item_slots", "slots")).alias("windows"))
               .select("doc_id", "item_id", "item_tokens", "size", "windows"))
    return (aligned.mapInArrow(_covers, "doc_id long, item_id long, covered long, item_tokens long")
            .groupBy("doc_id", "item_id").agg(F.max("covered").alias("covered"), F.max("item_tokens").alias("item_tokens")))


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, contaminated, n_items, covered (tokens under the largest match)
    and items (ids, joined by commas) of every row."""
    by_doc = matches(docs, benchmark).groupBy("doc_id").agg(
        F.count("*").alias("n_items"), F.max("covered").alias("covered"),
        F.array_join(F.transform(F.array_sort(F.collect_set("item_id")), lambda x: x.cast("string")), ",").alias("items"))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id")).join(by_doc, "doc_id", "left").select(
        "doc_id", F.col("n_items").isNotNull().alias("contaminated"), F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("covered", F.lit(0)).cast("long").alias("covered"), F.coalesce("items", F.lit("")).alias("items"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    bad = matches(docs, benchmark).select("doc_id").distinct()
    return docs.join(bad, "doc_id", "left_anti").select(*docs.columns)
