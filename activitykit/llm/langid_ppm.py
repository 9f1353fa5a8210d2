"""Language identification by prediction by partial matching (PPM).

For each language a variable-order context tree over bytes is learned: for every context of up to
``order`` bytes how often each byte followed it. The code length of a byte is taken at the longest
context in which the language has seen it; each longer context that was seen, but not with this
byte, costs its escape probability (distinct followers / (count + distinct followers)), and a byte
never seen at all costs a uniform 1/256 after the escapes. The statistics are frozen before any
text is scored; a text's language is the one with the shortest exact code length of its
ASCII-lower-cased UTF-8 bytes, and the score is the posterior under equal priors of code lengths
a byte, so it lies in (0, 1].

The trees are learned from a bounded sample: of each language the ``rows_per_language`` training
rows with the smallest hash, each over its whole text. Their windows are counted in Spark and only
the sums a language come to the driver, so the model, which is broadcast, grows with the different
windows of these rows and not with their length. Every document is scored, over its whole text.

A byte's cost depends on the last ``order + 1`` bytes alone, so the trees are stored as hash tables
of the windows that occur in any language, a row of costs (one a language) each, and a text is
scored window by window in numpy.

Edge cases: null or letterless texts are ``und`` with score 0; with no training rows every text
is; ties go to the language first by code point; null langs and null doc_ids are scored, but null
langs never learned from; repeated rows are scored alike; an empty table gives none.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from activitykit.llm.common import slices

ORDER = 3
ROWS_PER_LANGUAGE = 400
CHUNK = 1 << 20
RESULT = "doc_id long, held_out boolean, lang_pred string, score double"
LETTER = re.compile(r"[^\W\d_]")


Counts = list[tuple[np.ndarray, np.ndarray]]  # by context length: windows, sorted, and how often each occurs


def training_sample(docs: DataFrame, is_training: Column, rows_per_language: int = ROWS_PER_LANGUAGE, order: int = ORDER) -> dict[str, Counts]:
    """Window counts of at most ``rows_per_language`` rows a language, by hash of doc_id and text."""
    rows = docs.filter(is_training & F.col("lang").isNotNull() & (F.length("text") > 0)).withColumn("h", F.xxhash64("doc_id", "text"))
    ranked = rows.select("lang", "h")
    # the least rows of each hash range first, so that no task ranks a whole language
    for part in ([F.pmod("h", F.lit(64))], []):
        by = Window.partitionBy("lang", *part).orderBy("h")
        ranked = ranked.withColumn("n", F.row_number().over(by)).filter(F.col("n") <= rows_per_language).drop("n")
    # a language's greatest hash, and how many rows of that hash (repeats of one row) are in the sample
    last = ranked.groupBy("lang", "h").count().groupBy("lang").agg(F.max(F.struct("h", "count")).alias("last")).collect()
    if not last:
        return {}
    cut, copies = (F.create_map(*[F.lit(x) for r in last for x in (r.lang, r["last"][k])]) for k in range(2))
    taken = rows.select("lang", "text", "h").filter(F.col("h") <= cut[F.col("lang")]).groupBy("lang", "h").agg(F.min("text").alias("text"), F.count("*").alias("n"))
    taken = taken.select("lang", "text", F.when(F.col("h") == cut[F.col("lang")], copies[F.col("lang")]).otherwise(F.col("n")).alias("n"))
    counted = taken.mapInArrow(_counter(order), "lang string, k int, window long, n long").groupBy("lang", "k", "window").agg(F.sum("n").alias("n")).toArrow()
    out = {}
    for r in sorted(last, key=lambda r: r.lang):
        own = counted.filter(pc.equal(counted["lang"], r.lang))
        k, windows, n = (own[name].to_numpy() for name in ("k", "window", "n"))
        windows = windows.view(np.uint64)
        rank = np.lexsort((windows, k))
        ends = np.searchsorted(k[rank], np.arange(order + 2))
        out[r.lang] = [(windows[rank[a:b]], n[rank[a:b]]) for a, b in zip(ends, ends[1:])]
    return out


def _counter(order: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            langs, times = np.array(part.column("lang").to_pylist(), object), part.column("n").to_pylist()
            texts = part.column("text").to_pylist()
            for lang in dict.fromkeys(langs):
                rows = np.flatnonzero(langs == lang)
                for n in sorted({times[r] for r in rows}):  # rows taken several times apart
                    for k, (windows, counts) in enumerate(_counted([texts[r].encode() for r in rows if times[r] == n], order)):
                        columns = [pa.repeat(pa.scalar(lang), len(windows)), pa.repeat(pa.scalar(k, pa.int32()), len(windows)), pa.array(windows.view(np.int64)), pa.array(counts * n)]
                        yield pa.RecordBatch.from_arrays(columns, ["lang", "k", "window", "n"])

    return run


def _counted(texts: list[bytes], order: int, chunk: int = CHUNK) -> Counts:
    """Window counts of whole texts, lower-cased; about ``chunk`` bytes are held as windows at a time."""
    out = []
    for k in range(order + 1):
        sums = (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        held, size = [], 0
        for text in texts:
            data = np.frombuffer(text.lower(), np.uint8)
            for at in range(0, len(data), chunk):
                held.append(_windows(data[max(0, at - k) : at + chunk], k + 1)[k:])
                size += len(held[-1])
                if size >= chunk:
                    sums, held, size = _added(sums, held), [], 0
        out.append(_added(sums, held))
    return out


def _added(sums: tuple[np.ndarray, np.ndarray], held: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    if not held:
        return sums
    more, counts = np.unique(np.concatenate(held), return_counts=True)
    windows, at = np.unique(np.concatenate([sums[0], more]), return_inverse=True)
    return windows, np.bincount(at, np.concatenate([sums[1], counts]), len(windows)).astype(np.int64)


def _windows(data: np.ndarray, width: int) -> np.ndarray:
    """The last ``width`` bytes up to each position as one number (zeros before the start)."""
    out = np.zeros(len(data), np.uint64)
    for back in range(min(width, len(data))):
        out[back:] |= data[: len(data) - back].astype(np.uint64) << np.uint64(8 * back)
    return out


class _Table:
    """Open addressing: window -> row of costs."""

    def __init__(self, keys: np.ndarray, costs: np.ndarray):
        self.shift = np.uint64(64 - max(4, int(np.ceil(np.log2(max(len(keys), 1) * 4)))))
        size = 1 << (64 - int(self.shift))
        self.keys = np.full(size, np.iinfo(np.uint64).max, np.uint64)
        self.rows = np.full(size, -1, np.int32)
        self.costs = costs
        slot, todo = self._slot(keys), np.arange(len(keys))
        while len(todo):
            free = self.rows[slot[todo]] < 0
            self.rows[slot[todo[free]]] = todo[free]  # of several, the last stays
            mine = self.rows[slot[todo]] == todo
            self.keys[slot[todo[mine]]] = keys[todo[mine]]
            todo = todo[~mine]
            slot[todo] = (slot[todo] + 1) % size

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Row of each key, -1 where absent."""
        slot = self._slot(keys)
        row = self.rows[slot]
        found = np.where(self.keys[slot] == keys, row, -1)
        todo = np.flatnonzero((row >= 0) & (found < 0))
        while len(todo):
            slot[todo] = (slot[todo] + 1) % len(self.keys)
            row = self.rows[slot[todo]]
            hit = (row >= 0) & (self.keys[slot[todo]] == keys[todo])
            found[todo[hit]] = row[hit]
            todo = todo[(row >= 0) & ~hit]
        return found


class PpmModel:
    """Frozen trees of all languages. ``costs`` of a window are in bits, one column a language."""

    def __init__(self, sample: dict[str, Counts] | list[tuple[str, bytes]], order: int = ORDER):
        """``sample``: counts as of ``training_sample``, or texts with their languages."""
        if not isinstance(sample, dict):
            sample = {lang: _counted([t for g, t in sample if g == lang], order) for lang in {lang for lang, _ in sample}}
        self.langs = sorted(sample)
        self.order = order
        self.tables: list[_Table] = []  # by context length: cost of a window seen in any language
        self.escapes: list[_Table] = []  # by context length: cost of leaving a context
        floor = np.full((256, len(self.langs)), 8.0)
        lower = None
        for k in range(order + 1):
            counts = [sample[lang][k] for lang in self.langs]
            every = np.unique(np.concatenate([w for w, _ in counts])) if counts else np.zeros(0, np.uint64)
            contexts = np.unique(every >> np.uint64(8))
            escape = np.zeros((len(contexts), len(self.langs)))
            cost = np.zeros((len(every), len(self.langs)))
            below = floor[(every & np.uint64(255)).astype(np.int64)] if lower is None else lower(every & np.uint64((1 << (8 * k)) - 1))
            for c, (windows, n) in enumerate(counts):
                at = np.searchsorted(contexts, windows >> np.uint64(8))
                total = np.bincount(at, n, len(contexts))
                kinds = np.bincount(at, minlength=len(contexts))
                met = total > 0
                escape[met, c] = -np.log2(kinds[met] / (total[met] + kinds[met]))
                cost[:, c] = below[:, c] + escape[np.searchsorted(contexts, every >> np.uint64(8)), c]
                cost[np.searchsorted(every, windows), c] = -np.log2(n / (total[at] + kinds[at]))
            self.tables.append(_Table(every, cost))
            self.escapes.append(_Table(contexts, escape))
            lower = lambda w, k=k: self.costs(w, k)

    def costs(self, windows: np.ndarray, k: int) -> np.ndarray:
        """Bits of each window's last byte after its first ``k`` bytes."""
        table = self.tables[k]
        row = table.find(windows)
        out = table.costs[row] if len(table.costs) else np.zeros((len(row), len(self.langs)))
        missing = np.flatnonzero(row < 0)
        if len(missing):
            w = windows[missing]
            if k:
                out[missing] = self.costs(w & np.uint64((1 << (8 * k)) - 1), k - 1)
            else:
                out[missing] = 8.0
            escape = self.escapes[k].find(w >> np.uint64(8))
            known = escape >= 0
            out[missing[known]] += self.escapes[k].costs[escape[known]]
        return out

    def code_lengths(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Bits of each text (rows) in each language; ``starts`` as in ``words_of``, over joined bytes."""
        bits = np.zeros((len(starts) - 1, len(self.langs)))
        place = np.arange(len(data)) - np.repeat(starts[:-1], np.diff(starts))
        windows = _windows(data, self.order + 1)
        cost = np.zeros((len(data), len(self.langs)))
        full = place >= self.order
        cost[full] = self.costs(windows[full], self.order)
        for k in range(self.order):  # the first bytes have shorter contexts
            at = np.flatnonzero(place == k)
            cost[at] = self.costs(windows[at] & np.uint64((1 << (8 * (k + 1))) - 1), k)
        filled = np.flatnonzero(np.diff(starts))
        if len(filled):
            bits[filled] = np.add.reduceat(cost, starts[filled], axis=0)
        return bits


def identify(docs: DataFrame, model: PpmModel, held_out: Column) -> DataFrame:
    """``RESULT`` of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(cloudpickle.dumps(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frozen = pickle.loads(shared.value)
        for part in slices(batches):
            texts = part.column("text").to_pylist()
            lettered = np.array([bool(t and LETTER.search(t)) for t in texts]) & bool(frozen.langs)
            raw = [t.encode().lower() if ok else b"" for t, ok in zip(texts, lettered)]
            starts = np.r_[0, np.cumsum([len(r) for r in raw])]
            pred, score = np.full(len(texts), "und", object), np.zeros(len(texts))
            if lettered.any():
                data = np.frombuffer(b"".join(raw), np.uint8)
                bits = _in_chunks(frozen, data, starts)[lettered]
                rate = bits / np.diff(starts)[lettered][:, None]
                weight = np.exp2(rate.min(axis=1, keepdims=True) - rate)
                pred[lettered] = np.array(frozen.langs, object)[bits.argmin(axis=1)]
                score[lettered] = 1.0 / weight.sum(axis=1)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("held_out"), pa.array(pred, pa.string()), pa.array(score)], ["doc_id", "held_out", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"), "text").mapInArrow(run, RESULT)


def _in_chunks(model: PpmModel, data: np.ndarray, starts: np.ndarray, chunk: int = 1 << 20) -> np.ndarray:
    """Code lengths, about ``chunk`` bytes at a time; a longer text is read in pieces that keep their context."""
    out = np.zeros((len(starts) - 1, len(model.langs)))
    first = 0
    while first < len(starts) - 1:
        last = max(first + 1, int(np.searchsorted(starts, starts[first] + chunk, side="right")) - 1)
        if starts[last] - starts[first] <= chunk or not model.langs:
            out[first:last] = model.code_lengths(data[starts[first] : starts[last]], starts[first : last + 1] - starts[first])
        else:
            a, b = int(starts[first]), int(starts[first + 1])
            out[first] = model.code_lengths(data[a : a + chunk], np.array([0, chunk]))[0]
            for at in range(a + chunk, b, chunk):
                piece = data[at - model.order : min(b, at + chunk)]
                out[first] += model.costs(_windows(piece, model.order + 1)[model.order :], model.order).sum(axis=0)
        first = last
    return out
