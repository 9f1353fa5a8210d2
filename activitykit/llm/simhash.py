"""SimHash near-duplicates by a segment-popcount embedding.

Fingerprint: ASCII lower case, words, ``shingle``-word shingles (space-joined, repeats count),
XXH64 with seed 42; a bit is 1 if set in over half the shingle hashes; no words: zero.

Links: each distinct fingerprint becomes a vector of ``SEGMENTS`` popcounts, one for each 2-bit
segment. Changing one bit moves one coordinate by one, so the Manhattan distance of two vectors
never exceeds the Hamming distance: it is a lower bound. Vectors within ``bits`` differ on at most
``bits`` of the grid's axes (runs of coordinates) and agree on all others, so a range join on the
grid is an equality join on every choice of the remaining axes. Inside a cell the Manhattan
distance is tested first, then the exact Hamming distance.

Only distinct fingerprints enter a cell, so copies cost nothing. A cell with more than
``cell_rows`` fingerprints is dealt out again on finer axes (same pigeonhole, on the coordinates
left open) before any task reads it; cells that stay crowded, as where thousands of fingerprints
share one popcount vector, are dealt on by runs of the raw bits that differ inside them (same
pigeonhole on bits, until no more than ``bits`` differ: all are linked then). A task emits a spanning forest of each cell's links, never
all pairs; the forests are joined into components by star contractions.

Edge cases: null or empty texts have fingerprint zero and link like any other; rows with a null
doc_id get a fingerprint and the smallest doc_id of their component (null if there is none);
repeated rows each get a result row; an empty table gives none; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from activitykit.llm.common import cut_lineage, free_name, mix64, slices, texts_of, words_of
from activitykit.llm.components import components

SEED = 42
SEGMENTS = 32
CELL_ROWS = 4096
CHUNK = 1 << 18


def _fingerprints(texts: pa.Array, shingle: int) -> np.ndarray:
    words, starts = words_of(pc.ascii_lower(texts))
    lengths = pc.binary_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    data = pc.binary_join(pa.LargeListArray.from_arrays([0, len(words)], words), pa.scalar(" ", pa.large_string()))[0].as_buffer().to_pybytes()
    at = np.zeros(len(words) + 1, np.int64)
    np.cumsum(lengths + 1, out=at[1:])
    counts = np.diff(starts)
    span = np.minimum(counts, shingle)
    n_shingles = np.where(counts > 0, counts - span + 1, 0)
    out = np.zeros((len(counts), 64), np.int64)
    for t in np.flatnonzero(n_shingles):
        for lo in range(0, int(n_shingles[t]), CHUNK):
            first = starts[t] + lo
            n = min(CHUNK, int(n_shingles[t]) - lo)
            begin = at[first : first + n].tolist()
            end = (at[first + span[t] : first + span[t] + n] - 1).tolist()
            h = np.array([xxhash.xxh64_intdigest(data[a:b], SEED) for a, b in zip(begin, end)], np.uint64)
            out[t] += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    bits = out * 2 > n_shingles[:, None]
    return np.packbits(bits, axis=1, bitorder="little").view(np.int64).ravel()


def fingerprints(docs: DataFrame, shingle: int = 3, digest: bool = False) -> DataFrame:
    """(doc_id, fp): the signed 64-bit fingerprint of every row; with ``digest`` also the text's hash."""
    more = ["digest"] if digest else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(_fingerprints(texts_of(part), shingle)), *[part.column(c) for c in more]], ["doc_id", "fp", *more])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("digest"))
    return rows.select("doc_id", "text", *more).mapInArrow(run, "doc_id long, fp long" + ", digest long" * digest)


def _popcounts(fp: np.ndarray) -> np.ndarray:
    pairs = np.unpackbits(fp.astype(np.int64).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return pairs.reshape(-1, SEGMENTS, 2).sum(axis=2, dtype=np.uint8)


def _cells(vectors: np.ndarray, bits: int) -> Iterator[tuple[list[int], np.ndarray]]:
    """For each choice of the axes two near vectors agree on: the other coordinates, and each row's cell.

    ``2 * bits`` axes; ``bits`` of them may differ, so near vectors agree on ``bits`` at least.
    """
    width = vectors.shape[1]
    axes = [list(a) for a in np.array_split(np.arange(width), min(width, max(2 * bits, 1)))]
    for choice, same in enumerate(combinations(range(len(axes)), max(len(axes) - bits, 0))):
        fixed = [i for a in same for i in axes[a]]
        rest = [i for i in range(width) if i not in set(fixed)]
        packed = np.ascontiguousarray(vectors[:, fixed])
        yield rest, np.array([xxhash.xxh64_intdigest(row.tobytes(), choice) for row in packed], np.uint64)


def _deal(fps: DataFrame, bits: int) -> DataFrame:
    """(cell, fp): each fingerprint in its cell of each axis choice."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            fp = batch["fp"].to_numpy(np.int64)
            for k, (_, cell) in enumerate(_cells(_popcounts(fp), bits)):
                yield pd.DataFrame({"cell": cell.view(np.int64), "choice": np.int32(k), "fp": fp})

    return fps.mapInPandas(run, "cell long, choice int, fp long")


def _deal_finer(cells: DataFrame, bits: int) -> DataFrame:
    """The rows of crowded cells, dealt again by the coordinates their cell leaves open."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for choice, rows in batch.groupby("choice"):
                fp = rows["fp"].to_numpy(np.int64)
                vectors = _popcounts(fp)
                open_at = [rest for rest, _ in _cells(vectors[:0], bits)][choice]
                outer = rows["cell"].to_numpy(np.int64).view(np.uint64)
                for _, cell in _cells(vectors[:, open_at], bits):
                    yield pd.DataFrame({"cell": mix64(cell ^ outer).view(np.int64), "fp": fp})

    return cells.mapInPandas(run, "cell long, fp long")


def _deal_raw(cells: DataFrame, bits: int) -> DataFrame:
    """The rows of cells that popcounts cannot split, dealt by runs of the raw bits their cell leaves open (``mask``).

    The open bits are cut into ``bits + 1`` runs; two fingerprints of a cell that differ in ``bits`` bits
    or fewer agree in one run whole, and meet in its cell, which leaves the other runs open. Bits that are
    alike in the whole cell may be left out of ``mask``.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for mask, rows in batch.groupby("mask"):
                open_bits = [b for b in range(64) if int(mask) >> b & 1]
                fp, outer = rows["fp"].to_numpy(np.int64), rows["cell"].to_numpy(np.int64).view(np.uint64)
                for k, part in enumerate(np.array_split(np.array(open_bits, np.uint64), bits + 1)):
                    taken = np.uint64(sum(1 << int(b) for b in part))
                    value = mix64((fp.view(np.uint64) & taken) + np.uint64(k + 1))
                    left = np.uint64(int(mask) & (2**64 - 1)) & ~taken
                    yield pd.DataFrame({"cell": mix64(outer ^ value).view(np.int64), "mask": np.array(left).view(np.int64), "fp": fp})

    return cells.mapInPandas(run, "cell long, mask long, fp long")


def _forest(fp: np.ndarray, bits: int) -> list[tuple[int, int]]:
    """Links of a cell, one fewer than the members of each linked set."""
    parent = np.arange(len(fp))

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    vectors, raw, links = _popcounts(fp).astype(np.int8), fp.view(np.uint64), []
    for i in range(len(fp) - 1):
        near = np.flatnonzero(np.abs(vectors[i + 1 :] - vectors[i]).sum(axis=1) <= bits) + i + 1
        near = near[np.bitwise_count(raw[near] ^ raw[i]) <= bits]
        for j in near.tolist():
            a, b = find(i), find(j)
            if a != b:
                parent[max(a, b)] = min(a, b)
                links.append((int(fp[i]), int(fp[j])))
    return links


def _links(cells: DataFrame, bits: int) -> DataFrame:
    """(u, v): verified links inside the cells. Cells are met one after another in sorted partitions."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = pd.DataFrame({"cell": [], "fp": []}, dtype=np.int64)
        last = iter([None])
        for batch in (b for part in (batches, last) for b in part):
            if batch is not None:
                held = pd.concat([held, batch], ignore_index=True)
                if held.empty:
                    continue
            cell, fp = held["cell"].to_numpy(np.int64), held["fp"].to_numpy(np.int64)
            cuts = np.r_[0, np.flatnonzero(np.diff(cell)) + 1, len(cell)] if len(cell) else np.array([0, 0])
            whole = len(cuts) - 1 if batch is None else len(cuts) - 2  # the last cell may go on in the next batch
            found = []
            for a, b in zip(cuts[:whole], cuts[1 : whole + 1]):
                if b - a > 1:
                    found += _forest(np.unique(fp[a:b]), bits)
            held = held.iloc[cuts[whole] :]
            if found:
                yield pd.DataFrame(found, columns=["u", "v"])

    return cells.repartition("cell").sortWithinPartitions("cell").mapInPandas(run, "u long, v long")


def fingerprint_links(fps: DataFrame, bits: int = 3, cell_rows: int = CELL_ROWS) -> DataFrame:
    """(u, v) of distinct fingerprints ``fps(fp)``: links that connect all within ``bits`` bits."""
    if bits == 0:
        return fps.select(F.col("fp").alias("u"), F.col("fp").alias("v")).filter("false")
    dealt = cut_lineage(_deal(fps, bits))
    sizes = dealt.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = dealt.join(sizes, "cell")
    ready = shared.filter(F.col("n") <= cell_rows).select("cell", "fp")
    fine = _deal_finer(shared.filter(F.col("n") > cell_rows).select("cell", "choice", "fp"), bits).withColumn("mask", F.lit(-1).cast("long"))
    while True:
        fine = cut_lineage(fine)
        # only bits that differ inside a cell are dealt by, so each run splits it; with no more than ``bits`` of them all its rows are linked
        sizes = fine.groupBy("cell", "mask").agg(F.count(F.lit(1)).alias("n"), F.expr("bit_or(fp) ^ bit_and(fp)").alias("open"))
        crowded = cut_lineage(sizes.filter((F.col("n") > cell_rows) & (F.bit_count("open") > bits)).select("cell", "mask", "open"))
        if crowded.isEmpty():
            return _links(ready.unionByName(fine.select("cell", "fp")), bits).distinct()
        ready = ready.unionByName(fine.join(crowded, ["cell", "mask"], "left_anti").select("cell", "fp"))
        fine = _deal_raw(fine.join(crowded, ["cell", "mask"]).select("cell", F.col("open").alias("mask"), "fp"), bits)


def near_duplicates(docs: DataFrame, shingle: int = 3, bits: int = 3, cell_rows: int = CELL_ROWS) -> DataFrame:
    """(doc_id, fp, component_id) per row: the smallest doc_id reachable over links, itself included."""
    prints = cut_lineage(fingerprints(docs, shingle))
    distinct = cut_lineage(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = components(fingerprint_links(distinct.select("fp"), bits, cell_rows), "fp")
    rooted = distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return prints.join(rooted.join(least, "root").select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, shingle: int = 3, bits: int = 3) -> DataFrame:
    """The rows of ``docs`` with one of each component: its smallest doc_id (null last), then fingerprint, then text hash.

    Rows are told apart by doc_id and text, so a doc_id may name several texts; of rows alike in both one stays.
    """
    prints = cut_lineage(fingerprints(docs, shingle, digest=True))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "digest")).alias("first")
    distinct = cut_lineage(prints.groupBy("fp").agg(first))
    rooted = distinct.join(components(fingerprint_links(distinct.select("fp"), bits), "fp"), "fp", "left")
    best = F.min(F.struct("first.unnamed", "first.doc_id", "fp", "first.digest")).alias("best")
    best = rooted.groupBy(F.coalesce("root", "fp").alias("root")).agg(best).select("best.*")
    # null-safe keys as plain columns, so that the join and the aggregate share one shuffle
    keys = [free_name(c, docs.columns) for c in ("_unnamed", "_id", "_digest")]
    keep = best.select(F.col("unnamed").alias(keys[0]), F.coalesce("doc_id", F.lit(0)).alias(keys[1]), F.col("digest").alias(keys[2]))
    doc_id = F.col("doc_id").cast("long")
    rows = docs.withColumns({keys[0]: doc_id.isNull(), keys[1]: F.coalesce(doc_id, F.lit(0)), keys[2]: F.xxhash64("text")})
    order = F.xxhash64(*[c for c, kind in docs.dtypes if "map<" not in kind and kind != "variant"])
    row = F.min_by(F.struct(*docs.columns), order).alias("row")
    return rows.join(keep, keys, "left_semi").groupBy(*keys).agg(row).select("row.*")
