"""Best-fit packing of tokenised documents into sequences, improved by swap-based local search.

A document is its byte-level BPE ids and an end id. Longer ones are cut into ``capacity``-token
pieces, the first of which may be shorter. Pieces are dealt into groups of about ``group_rows``;
in a group best-fit decreasing is followed by a local search between underfull bins that moves a
piece, exchanges one for one, or two for one, whenever the fuller bin of the two gets fuller (the
sum of squared fills rises), until bins are empty or nothing helps. The pieces of bins that stay
underfull are dealt again and packed in a second round over all groups' leftovers.

Tokens: white space that stands alone between two words is a token boundary, so a text is the
concatenation of its words' ids; each task keeps the ids of the words it has met. Texts with runs
of white space are encoded whole. Both use the vocabulary's rank file; texts that hold the
vocabulary's special string go to the JSON tokenizer, which makes it one id.

Edge cases: a null or empty text is the end id alone; null doc_ids and repeated rows are packed
like any other row (each row is its own document); an empty table gives none; other columns are
ignored.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from activitykit.llm.common import cut_lineage, slices

CAPACITY = 1024
END_ID = 2
GROUP_ROWS = 4096
VOCABULARY = "byte_bpe_50k"
SPECIAL = "<|endoftext|>"
BARE = "\x01"  # marks a word without a space before it
CACHE_WORDS = 300_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def id_bytes(vocabulary: str = VOCABULARY) -> Callable[[list[str]], list[bytes]]:
    """Encodes texts into little-endian unsigned 32-bit ids. ``vocabulary``: a name of the installed files, or a path without ending."""
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    def path(ending: str) -> str:
        return vocabulary + ending if "/" in vocabulary else public_tokenizers.path(vocabulary + ending)

    with open(path(".tiktoken"), "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    coder = tiktoken.Encoding("bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    widths = np.zeros(max(ranks.values()) + 1, np.int64)
    for token, rank in ranks.items():
        widths[rank] = len(token)
    whole_tokenizer = []
    known: dict[str, bytes | None] = {}

    def whole(text: str) -> bytes:
        if SPECIAL in text:
            if not whole_tokenizer:
                whole_tokenizer.append(Tokenizer.from_file(path(".json")))
            return np.array(whole_tokenizer[0].encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return np.array(coder.encode_ordinary(text), "<u4").tobytes()

    def learn(words: set[str]) -> None:
        spaced = []
        for w in words:
            bare = w[1:] if w.startswith(BARE) else None
            if w == "\n":
                known[w] = whole(w)
            elif not (w if bare is None else bare) or w.strip() != w or (bare is not None and bare.strip() != bare):
                known[w] = None  # white space meets white space here: not a boundary
            elif bare is not None:
                known[w] = whole(bare)
            else:
                spaced.append(w)
        if spaced:
            ids = np.array(coder.encode_ordinary(" " + " ".join(spaced)), "<u4")
            ends = np.cumsum([len(w.encode()) + 1 for w in spaced])
            cuts = 4 * (np.searchsorted(np.cumsum(widths[ids]), ends) + 1)
            data = ids.tobytes()
            known.update(zip(spaced, (data[a:b] for a, b in zip([0, *cuts[:-1].tolist()], cuts.tolist()))))

    def encode(texts: list[str]) -> list[bytes]:
        if len(known) > CACHE_WORDS:
            known.clear()
        split = [None if not t or BARE in t or SPECIAL in t else (BARE + t.replace("\n", " \n " + BARE)).split(" ") for t in texts]
        new = {w for words in split if words for w in words if w not in known}
        if new:
            learn(new)
        out = []
        for text, words in zip(texts, split):
            try:
                out.append(whole(text) if words is None else b"".join(map(known.__getitem__, words)))
            except TypeError:  # a word was None
                out.append(whole(text))
        return out

    return encode


def pieces(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every row's pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = id_bytes(vocabulary)
        end = np.array([END_ID], "<u4").tobytes()
        for part in slices(batches):
            rows = []
            for doc, ids in zip(part.column("doc_id").to_pylist(), encode([t or "" for t in part.column("text").to_pylist()])):
                ids += end
                n = len(ids) // 4
                first = (n - 1) % capacity + 1
                cuts = [0, *range(first, n + 1, capacity)]
                rows += [(doc, k, a, b - a, zlib.crc32(ids[4 * a : 4 * b])) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
            names = [c.split()[0] for c in PIECES.split(", ")]
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows), types)], names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, PIECES)


def best_fit(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Best-fit decreasing: each piece into the bin it leaves least room in."""
    bins: list[list[int]] = []
    with_room: dict[int, list[int]] = {}
    rooms = 0  # bit r is set if some bin has r left
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        fitting = rooms >> n
        if fitting:
            room = n + (fitting & -fitting).bit_length() - 1
            b = with_room[room].pop()
            if not with_room[room]:
                rooms &= ~(1 << room)
            bins[b].append(i)
        else:
            room, b = capacity, len(bins)
            bins.append([i])
        left = room - n
        if left:
            with_room.setdefault(left, []).append(b)
            rooms |= 1 << left
    return bins


def _best_exchange(giver: list[int], taker: list[int], room: int, lengths: np.ndarray) -> tuple[list[int], list[int]] | None:
    """What to move from giver to taker and what back, to fill most of the taker's room: a move, a swap, or two for one."""
    g, t = lengths[giver], np.r_[0, lengths[taker]]  # 0: nothing goes back
    one = g[:, None] - t[None, :]
    best = np.where((one > 0) & (one <= room), one, 0)
    top = int(best.argmax())
    gain, pick = int(best.flat[top]), ([giver[top // len(t)]], top % len(t))
    if gain < room and len(giver) > 1 and len(taker):
        i, j = np.triu_indices(len(giver), 1)
        two = (g[i] + g[j])[:, None] - t[None, 1:]
        best = np.where((two > 0) & (two <= room), two, 0)
        top = int(best.argmax())
        if int(best.flat[top]) > gain:
            k = top // (len(t) - 1)
            gain, pick = int(best.flat[top]), ([giver[i[k]], giver[j[k]]], top % (len(t) - 1) + 1)
    if not gain:
        return None
    return pick[0], [taker[pick[1] - 1]] if pick[1] else []


def local_search(bins: list[list[int]], lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Raises the sum of squared fills of underfull bins by exchanges; bins that become empty go.

    Only as many of the emptiest bins give as could still be saved, and a sweep that empties none
    is the last, so the work is bounded by the underfull bins times those that could go.
    """
    fill = [int(lengths[b].sum()) for b in bins]
    least, count = -(-sum(fill) // capacity), len(bins)
    emptied = True
    while emptied and count > least:
        emptied = False
        under = sorted((k for k in range(len(bins)) if 0 < fill[k] < capacity), key=lambda k: fill[k])
        for at, giver in enumerate(under[: count - least + 1]):
            for taker in under[at + 1 :]:
                while 0 < fill[giver] <= fill[taker] < capacity:
                    found = _best_exchange(bins[giver], bins[taker], capacity - fill[taker], lengths)
                    if not found:
                        break
                    there, back = found
                    bins[giver] = [i for i in bins[giver] if i not in there] + back
                    bins[taker] = [i for i in bins[taker] if i not in back] + there
                    change = int(lengths[there].sum() - lengths[back].sum())
                    fill[giver] -= change
                    fill[taker] += change
            if not fill[giver]:
                count -= 1
                emptied = True
    return [b for b in bins if b]


def _packer(capacity: int, names: list[str]):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("uid", ignore_index=True)
        lengths = rows["length"].to_numpy(np.int64)
        bins = local_search(best_fit(lengths, capacity), lengths, capacity)
        at = np.concatenate([np.array(b) for b in bins])
        inner = np.repeat(np.arange(len(bins)), [len(b) for b in bins])
        before = np.cumsum(lengths[at]) - lengths[at]
        starts = np.r_[0, np.cumsum([lengths[b].sum() for b in bins])]
        out = rows.iloc[at].reset_index(drop=True)
        out["sequence_id"] = out["grp"] * (1 << 32) + inner
        out["offset"] = before - starts[inner]
        out["fill"] = np.diff(starts)[inner]
        return out[names]

    return run


def _pack_groups(rows: DataFrame, capacity: int, group_rows: int) -> DataFrame:
    """``rows`` (with uid) plus sequence_id, offset and fill; groups of about ``group_rows`` pieces."""
    groups = max(1, -(-rows.count() // group_rows))
    schema = rows.schema.simpleString()[7:-1] + ",sequence_id:bigint,offset:bigint,fill:bigint"
    names = [*rows.columns, "sequence_id", "offset", "fill"]
    dealt = rows.withColumn("grp", F.pmod(F.xxhash64("uid"), F.lit(groups)).cast("long"))
    return dealt.groupBy("grp").applyInPandas(_packer(capacity, names), schema)


def pack(cut: DataFrame, capacity: int = CAPACITY, group_rows: int = GROUP_ROWS) -> DataFrame:
    """``cut`` (pieces with a length) plus sequence_id and offset."""
    rows = cut_lineage(cut.withColumn("uid", F.monotonically_increasing_id()))
    first = cut_lineage(_pack_groups(rows, capacity, group_rows))
    rest = _pack_groups(first.filter(F.col("fill") < capacity).select(rows.columns), capacity, group_rows)
    rest = rest.withColumn("sequence_id", -F.col("sequence_id") - 1)
    return first.filter(F.col("fill") >= capacity).unionByName(rest).select(*cut.columns, "sequence_id", "offset")


def packed_documents(docs: DataFrame, capacity: int = CAPACITY, group_rows: int = GROUP_ROWS, vocabulary: str = VOCABULARY) -> DataFrame:
    return pack(pieces(docs, capacity, vocabulary), capacity, group_rows)
