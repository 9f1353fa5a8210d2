"""Suffix-array dedup: byte strings that occur more than once, by longest-previous-factor arrays.

Texts are UTF-8 bytes; a match is ``least`` bytes that start at two places of the table. Every
match is found; with ``keep_first`` the first copy (by doc_id, then place) stays.

One suffix array over the table would be one task's work, so windows (``least`` bytes at a place)
are brought together by content first. The anchor of a window is its ``gram``-byte gram with the
smallest hash; equal windows have equal anchors at the same place in them. The windows of a text
fall into ranges that share an anchor, about one for each hundred bytes, and one row a range
(anchor hash, digest of the range's bytes) is what is grouped:

- ranges whose anchor is alone in the table hold no match and go;
- ranges with equal bytes match as a whole, which settles the inside of long copies;
- where one anchor has different ranges (the ends of copies), one range of each digest goes to a
  suffix array: a task sorts the suffixes at the window starts by their first ``least`` bytes
  (prefix doubling), and for each, the previous and next smaller place in suffix order give the
  longest previous factor. A factor of ``least`` bytes is a later copy, its source the earlier one.

An anchor with more than ``crowd`` different ranges is not gathered: its windows are grouped by
digest, with partial aggregation, which finds the same matches.

Edge cases: null texts have no bytes and are no text to remove from; texts shorter than ``least``
are kept whole; a null doc_id ranks last; repeated rows are copies of each other and are cut
alike (with ``keep_first`` too: rows with the same doc_id and text cannot be ranked, so all of
them stay or go); an empty table gives none; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from activitykit.llm.common import SLICE_BYTES, mix64, slices
from activitykit.runtime import scratch_path

MIN_BYTES = 400
GRAM = 192
CROWD = 4096
SORT_BYTES = 1 << 18
BASE = np.uint64(0xD6E8FEB86659FD93)  # odd, so it has an inverse modulo 2^64
ABSENT = np.iinfo(np.uint64).max


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE^i and BASE^-i modulo 2^64 for i below n."""
    inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
    up, down = np.full(n, BASE, np.uint64), np.full(n, inverse, np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def gram_hashes(data: np.ndarray, width: int, powers: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """A 64-bit hash of the ``width`` bytes from each position (the last ``width - 1`` have none)."""
    n = len(data)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[0][:n], dtype=np.uint64, out=total[1:])
    return mix64((total[width:] - total[:-width]) * powers[1][: n - width + 1])


def _sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (np.minimum or np.maximum) over each run of ``width`` values."""
    n = len(values)
    pad = (-n) % width
    rows = np.r_[values, np.full(pad, values[-1])].reshape(-1, width)
    ahead = pick.accumulate(rows, axis=1).ravel()
    back = pick.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return pick(back[: n - width + 1], ahead[width - 1 : n])


def anchored_ranges(data: np.ndarray, starts: np.ndarray, powers: tuple[np.ndarray, np.ndarray], least: int = MIN_BYTES, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Runs of window starts that share their anchor: (text, first start, last start, anchor place, anchor hash).

    A window is ``least`` bytes of one text; its anchor is the leftmost of the grams with the
    smallest hash in it. Equal windows have equal anchors at the same place in them. Positions
    are in ``data``; ``starts`` are the texts' bounds, one entry more than texts.
    """
    if len(data) < least:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.int64, np.uint64))
    width = least - gram + 1
    h = gram_hashes(data, gram, powers)
    low = _sliding(h, width, np.minimum)
    # a gram is an anchor if one of the windows over it has its hash as the smallest
    high = _sliding(np.r_[np.zeros(width - 1, np.uint64), low, np.zeros(width - 1, np.uint64)], width, np.maximum)
    anchors = np.flatnonzero(high == h)
    # the anchor can only change where the smallest hash does, past an anchor, or at a text's start
    change = np.flatnonzero(low[1:] != low[:-1]) + 1
    events = np.unique(np.r_[0, change, anchors + 1, starts[:-1]])
    events = events[events < len(low)]
    text = np.searchsorted(starts, events, side="right") - 1
    last_start = starts[text + 1] - least
    inside = events <= last_start
    events, text, last_start = events[inside], text[inside], last_start[inside]
    values, rank = np.unique(h[anchors], return_inverse=True)
    key = np.sort(rank * len(data) + anchors)
    own = key[np.searchsorted(key, np.searchsorted(values, low[events]) * len(data) + events)] % len(data)
    following = np.r_[events[1:], len(data)]
    same_text = np.r_[text[1:] == text[:-1], False] if len(text) else np.zeros(0, bool)
    end = np.where(same_text, following - 1, last_start)
    first = np.ones(len(events), bool)
    first[1:] = (own[1:] != own[:-1]) | (text[1:] != text[:-1])
    lead = np.flatnonzero(first)
    final = np.r_[lead[1:] - 1, len(events) - 1] if len(lead) else lead
    return text[lead], events[lead], end[final], own[lead], h[own[lead]]


def _joined(texts: list[str | None]) -> tuple[bytes, np.ndarray]:
    raw = [(t or "").encode() for t in texts]
    return b"".join(raw), np.r_[0, np.cumsum([len(r) for r in raw])].astype(np.int64)


def ranges(docs: DataFrame, least: int = MIN_BYTES, gram: int = GRAM) -> DataFrame:
    """(doc_id, sig, lo, hi, own, anchor, seg): window starts lo..hi of a text, their anchor, and a digest of their bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = _powers(2 * SLICE_BYTES)
        for part in slices(batches):
            raw, starts = _joined(part.column("text").to_pylist())
            for first in range(0, max(1, len(raw) - least + 1), SLICE_BYTES) if part.num_rows == 1 else (0,):
                # the windows that start in one slice of a long text; several texts fit one slice
                piece = raw[first : first + SLICE_BYTES + least - 1] if part.num_rows == 1 else raw
                bounds = np.array([0, len(piece)]) if part.num_rows == 1 else starts
                text, lo, hi, own, anchor = anchored_ranges(np.frombuffer(piece, np.uint8), bounds, powers, least, gram)
                seg = [xxhash.xxh3_64_intdigest(piece[a : b + least], o - a) for a, b, o in zip(lo.tolist(), hi.tolist(), own.tolist())]
                base = bounds[text] - first
                places = [pa.array(x - base) for x in (lo, hi, own)]
                digests = [pa.array(x.view(np.int64)) for x in (anchor, np.array(seg, np.uint64))]
                at = pa.array(text)
                yield pa.RecordBatch.from_arrays([part.column("doc_id").take(at), part.column("sig").take(at), *places, *digests], ["doc_id", "sig", "lo", "hi", "own", "anchor", "seg"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return _signed(docs).filter(F.length("text") * 4 >= least).mapInArrow(run, f"doc_id {kind}, sig long, lo long, hi long, own long, anchor long, seg long")


def _signed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.xxhash64("text").alias("sig"), "text")


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _place(prefix: str = "") -> list:
    return [F.col(f"{prefix}doc_id").isNull().alias("last"), F.col(f"{prefix}doc_id").alias("doc_id"), F.col(f"{prefix}sig").alias("sig"), F.col(f"{prefix}lo").alias("lo")]


def _with_bytes(found: DataFrame, docs: DataFrame, least: int) -> DataFrame:
    """``found`` (doc_id, sig, lo, hi, ...) plus the bytes lo..hi+least of that text.

    A text's ranges are gathered into one array, so the text is met once, not once a range; they are
    handed on ``SLICE_BYTES`` at a time.
    """
    held_names = found.columns
    names = [c for c in held_names if c not in ("doc_id", "sig")]
    marks = found.groupBy(F.col("doc_id").alias("_id"), F.col("sig").alias("_sig")).agg(F.collect_list(F.struct(*names)).alias("_ranges"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            for row, text in enumerate(part.column("text").to_pylist()):
                raw = text.encode()
                every = pa.RecordBatch.from_struct_array(part.column("_ranges").slice(row, 1).flatten())
                lows, highs = every.column("lo").to_numpy(), every.column("hi").to_numpy() + least
                ends, first = np.cumsum(highs - lows), 0
                while first < len(ends):
                    last = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + SLICE_BYTES, side="right")))
                    data = [raw[a:b] for a, b in zip(lows[first:last].tolist(), highs[first:last].tolist())]
                    own = pa.array(np.full(last - first, row))
                    held = every.slice(first, last - first)
                    columns = {c: held.column(c) for c in names} | {c: part.column(c).take(own) for c in ("doc_id", "sig")}
                    yield pa.RecordBatch.from_arrays([*(columns[c] for c in held_names), pa.array(data, pa.binary())], [*held_names, "data"])
                    first = last

    both = _signed(docs).join(marks, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("sig") == F.col("_sig")))
    schema = found.schema.simpleString()[7:-1] + ",data:binary"
    return both.select("doc_id", "sig", "text", "_ranges").mapInArrow(run, schema)


def suffix_ranks(data: np.ndarray, least: int) -> np.ndarray:
    """Rank of each suffix by its first ``least`` bytes (prefix doubling; zeros after the end)."""
    n = len(data)
    padded = np.r_[data, np.zeros(8, np.uint8)]
    key = np.zeros(n, np.uint64)
    for k in range(8):
        key = (key << np.uint64(8)) | padded[k : n + k].astype(np.uint64)
    rank, width = _dense(key), 8
    while width < least:
        step = min(width, least - width)
        after = np.zeros(n, np.int64)
        after[: n - step] = rank[step:] + 1
        rank, width = _dense(rank * (n + 2) + after), width + step
    return rank


def _dense(key: np.ndarray) -> np.ndarray:
    order = np.argsort(key)
    rank = np.zeros(len(key), np.int64)
    rank[order[1:]] = np.cumsum(key[order[1:]] != key[order[:-1]])
    return rank


def smaller_neighbours(places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the previous and of the next smaller value of each entry (-1: none)."""
    n = len(places)
    before, after, stack = np.full(n, -1), np.full(n, -1), []
    for i, p in enumerate(places.tolist()):
        while stack and stack[-1][0] > p:
            after[stack.pop()[1]] = i
        if stack:
            before[i] = stack[-1][1]
        stack.append((p, i))
    return before, after


def previous_factors(data: np.ndarray, windows: np.ndarray, places: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(has an earlier copy, has a copy at all) of the windows at ``windows``, which stand at ``places`` of the table."""
    rank = suffix_ranks(data, least)[windows]
    order = np.lexsort((places, rank))
    same = rank[order[1:]] == rank[order[:-1]]
    shared = np.r_[False, same] | np.r_[same, False]
    # suffixes that differ within ``least`` bytes from both neighbours have no long factor
    order = order[shared]
    later, copied = np.zeros(len(windows), bool), np.zeros(len(windows), bool)
    before, after = smaller_neighbours(places[order])
    for earlier in (before, after):
        has = np.flatnonzero(earlier >= 0)
        has = has[rank[order[has]] == rank[order[earlier[has]]]]
        later[order[has]] = True
        copied[order[has]] = True
        copied[order[earlier[has]]] = True
    return later, copied


def _runs(flags: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.r_[0, flags.astype(np.int8), 0]))
    return list(zip(edges[::2].tolist(), (edges[1::2] - 1).tolist()))


def _match_ranges(rows: pd.DataFrame, least: int) -> list[tuple[int, int, int, int, bool]]:
    """(anchor, seg, from, to, later) of the matching windows of whole anchors, offsets from each range's lo."""
    rows = rows.drop_duplicates(["anchor", "seg"])
    table = rows.assign(none=rows["doc_id"].isna()).sort_values(["none", "doc_id", "sig", "lo"], ignore_index=True)
    sizes = table["data"].map(len).to_numpy(np.int64)
    starts = np.r_[0, np.cumsum(sizes)]
    counts = sizes - least + 1
    owner = np.repeat(np.arange(len(table)), counts)
    windows = starts[owner] + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    later, copied = previous_factors(np.frombuffer(b"".join(table["data"]), np.uint8), windows, windows, least)
    bounds = np.r_[0, np.cumsum(counts)]
    out = []
    for k, (anchor, seg) in enumerate(zip(table["anchor"].tolist(), table["seg"].tolist())):
        own = slice(bounds[k], bounds[k + 1])
        if copied[own].any():
            out += [(anchor, seg, a, b, True) for a, b in _runs(later[own])]
            out += [(anchor, seg, a, b, False) for a, b in _runs(copied[own] & ~later[own])]
    return out


MATCHES = "anchor long, seg long, frm long, upto long, later boolean"


def _gathered(found: DataFrame, least: int) -> DataFrame:
    """Matches by suffix arrays over whole anchors, several anchors a sort."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        size = 0

        def flush(rows: pd.DataFrame) -> pd.DataFrame:
            return pd.DataFrame(_match_ranges(rows, least), columns=["anchor", "seg", "frm", "upto", "later"])

        for batch in batches:
            for _, rows in batch.groupby("anchor", sort=False):
                if size > SORT_BYTES and rows["anchor"].iat[0] != held[-1]["anchor"].iat[0]:
                    yield flush(pd.concat(held))
                    held, size = [], 0
                held.append(rows)
                size += int(rows["data"].map(len).sum())
        if held:
            yield flush(pd.concat(held))

    return found.repartition("anchor").sortWithinPartitions("anchor", "seg").mapInPandas(run, MATCHES)


def _counted(found: DataFrame, least: int) -> DataFrame:
    """The same matches for anchors with very many ranges: windows grouped by digest, nothing gathered."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                at = range(len(row.data) - least + 1)
                digests = [xxhash.xxh3_128_digest(row.data[k : k + least]) for k in at]
                out = pd.DataFrame({"anchor": row.anchor, "seg": row.seg, "at": at, "digest": digests})
                yield out.assign(doc_id=row.doc_id, sig=row.sig, lo=row.lo)

    kind = found.schema["doc_id"].dataType.simpleString()
    every = found.mapInPandas(run, f"anchor long, seg long, at long, digest binary, doc_id {kind}, sig long, lo long")
    place = F.struct(*_place())
    shared = every.groupBy("anchor", "digest").agg(F.min(place).alias("first"), F.min("seg").alias("s1"), F.max("seg").alias("s2")).filter("s1 <> s2")
    return every.join(shared.select("anchor", "digest", "first"), ["anchor", "digest"]).select("anchor", "seg", F.col("at").alias("frm"), F.col("at").alias("upto"), (place > F.col("first")).alias("later")).distinct()


def matches(docs: DataFrame, least: int = MIN_BYTES, gram: int = GRAM, crowd: int = CROWD) -> DataFrame:
    """(doc_id, sig, start, end, later): byte spans that occur more than once; ``later``: an earlier copy exists."""
    every = ranges(docs, least, gram)
    shared = every.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"), F.min("seg").alias("s1"), F.max("seg").alias("s2")).filter("n > 1")
    # written first, so that both sides of the join are shuffled and a frequent anchor can be split
    shared = _written(shared.select("anchor", (F.col("s1") != F.col("s2")).alias("mixed")), "suffix-anchors")
    found = _written(every.join(shared, "anchor"), "suffix-ranges")
    first = found.groupBy("anchor", "seg").agg(F.min(F.struct(*_place(), "hi")).alias("rep"), F.count(F.lit(1)).alias("n"), F.first("mixed").alias("mixed"))
    first = _written(first, "suffix-first")
    kinds = first.filter("mixed").groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds"))
    open_ = first.filter("mixed").join(kinds, "anchor").select("anchor", "seg", "kinds", "rep.doc_id", "rep.sig", "rep.lo", "rep.hi")
    texts = _written(_with_bytes(open_, docs, least), "suffix-bytes")
    ends = _written(_gathered(texts.filter(F.col("kinds") <= crowd), least).unionByName(_counted(texts.filter(F.col("kinds") > crowd), least)), "suffix-matches")
    whole = found.join(first.filter("n > 1").select("anchor", "seg", "rep"), ["anchor", "seg"])
    whole = whole.select("doc_id", "sig", F.col("lo").alias("start"), (F.col("hi") + least).alias("end"), (F.struct(*_place()) > F.struct("rep.last", "rep.doc_id", "rep.sig", "rep.lo")).alias("later"))
    parts = found.filter("mixed").join(ends, ["anchor", "seg"])
    parts = parts.select("doc_id", "sig", (F.col("lo") + F.col("frm")).alias("start"), (F.col("lo") + F.col("upto") + least).alias("end"), "later")
    return whole.unionByName(parts)


def clean(docs: DataFrame, least: int = MIN_BYTES, gram: int = GRAM, keep_first: bool = True, crowd: int = CROWD) -> DataFrame:
    """(doc_id, n_bytes, spans, kept) per row: the maximal removed byte spans, and the bytes that stay."""
    found = matches(docs, least, gram, crowd)
    if keep_first:
        found = found.filter("later")
    spans = found.groupBy(F.col("doc_id").alias("_id"), F.col("sig").alias("_sig")).agg(F.collect_set(F.struct("start", "end")).alias("_spans"))
    both = _signed(docs).join(spans, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("sig") == F.col("_sig")), "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            sizes, spans, kept = [], [], []
            for text, marks in zip(part.column("text").to_pylist(), part.column("_spans").to_pylist()):
                raw = (text or "").encode()
                joined: list[dict] = []
                for a, b in sorted((m["start"], m["end"]) for m in marks or ()):
                    if joined and a <= joined[-1]["end"]:
                        joined[-1]["end"] = max(b, joined[-1]["end"])
                    else:
                        joined.append({"start": a, "end": b})
                cuts = [0, *(x for m in joined for x in (m["start"], m["end"])), len(raw)]
                sizes.append(len(raw))
                spans.append(joined)
                kept.append(b"".join(raw[a:b] for a, b in zip(cuts[::2], cuts[1::2])))
            arrays = [pa.array(sizes, pa.int64()), pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *arrays], ["doc_id", "n_bytes", "spans", "kept"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return both.select("doc_id", "text", "_spans").mapInArrow(run, f"doc_id {kind}, n_bytes long, spans array<struct<start:long,end:long>>, kept binary")
