"""SentencePiece encoding and decoding by vectorised merge rounds.

A BPE model of whole pieces with byte fallback, no character normalisation and a dummy prefix.
A text is its words, each led by the space mark U+2581. A task encodes a distinct word once and
keeps at most ``CACHE_WORDS`` words of ``CACHE_IDS`` ids, and those of one slice.

*Units.* All words' characters lie in one flat array. Between two characters that stand side by
side in no piece no merge can ever reach across, so words are cut there; what remains are the units.
*Rounds.* ``rank[i]`` is the rank of the piece that symbols i and i+1 of one unit make (highest
score first, equal scores share a rank). Each round takes the least rank of every unit (a segmented
minimum) and merges its occurrences, leftmost first where they overlap, in all units at once. Then
the arrays are compacted, the ranks beside a merge are looked up again, and units without a pair
leave. One merge after another, as the library does it, could differ only where a merge makes a
pair of the same or a lesser rank, which would come before the occurrences to the right; so a
unit's merges of a round end with the first that makes one.
*Long units.* The few units that still have pairs after ``ROUNDS`` rounds (runs of thousands of
spaces, whose pieces share one score) are finished pair by pair with a heap.

Characters that no piece holds become the byte pieces of their UTF-8 form. Decoding joins the
pieces, bytes as bytes, turns marks into spaces and drops the one the dummy prefix added.

Edge cases: a null or empty text has no ids and decodes to the empty text; a text is whole, texts
over ``PART`` characters being encoded part by part, cut at single spaces (bounded memory; a text
without such a space stays one part); repeated rows, null doc_ids and ties change nothing, each row
stands alone; an empty table gives none; other columns pass through ``encoded`` and ``decoded``
whatever their names (the result column replaces one of the same name).
"""

from __future__ import annotations

import heapq
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructType

from activitykit.llm.common import MIX, slices

MODEL = "piece_bpe_32k.model"
MARK = "▁"
ROUNDS = 256
PART = 1 << 21
CACHE_WORDS = 300_000
CACHE_IDS = 4_000_000
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6  # piece types of the model format
NONE = np.int64(1) << 40  # the rank of a pair that makes no piece


def ragged(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The runs ``values[s : s + n]`` one after another."""
    total = int(lengths.sum())
    if not total:
        return values[:0]
    at = np.repeat(starts - np.cumsum(lengths) + lengths, lengths)
    at += np.arange(total)
    return values[at]


class Codec:
    """Encodes and decodes with the model at ``path`` (a name of the installed files, or a path)."""

    def __init__(self, path: str = MODEL):
        from sentencepiece import sentencepiece_model_pb2 as proto

        if "/" not in path:
            import public_tokenizers

            path = public_tokenizers.path(path)
        model = proto.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        spec, train = model.normalizer_spec, model.trainer_spec
        plain = not spec.precompiled_charsmap and spec.add_dummy_prefix and spec.escape_whitespaces and not spec.remove_extra_whitespaces
        known = {NORMAL, UNKNOWN, CONTROL, BYTE}
        if train.model_type != 2 or not train.byte_fallback or train.treat_whitespace_as_suffix or not plain or any(p.type not in known for p in model.pieces):
            raise ValueError("only BPE models with byte fallback, a dummy prefix and no normalisation")
        self.size = size = len(model.pieces)
        normal = {p.piece: i for i, p in enumerate(model.pieces) if p.type == NORMAL}
        scores = np.array([p.score for p in model.pieces])
        self.rank_of = np.unique(-scores, return_inverse=True)[1].astype(np.int64)
        self.symbol = np.arange(0x110000, dtype=np.int64) + size  # symbols from ``size`` on: characters without a piece
        beside, pairs = set(), []
        for piece, i in normal.items():
            if len(piece) == 1:
                self.symbol[ord(piece)] = i
            beside.update(zip(piece, piece[1:]))
            pairs += [(self._part(piece[:k], normal), self._part(piece[k:], normal), i) for k in range(1, len(piece))]
        pairs = np.array([p for p in pairs if p[0] is not None and p[1] is not None], np.int64).reshape(-1, 3)
        self.span = np.int64(size + 0x110000)
        keys = pairs[:, 0] * self.span + pairs[:, 1]
        self.table = dict(zip(keys.tolist(), pairs[:, 2].tolist()))
        self._hash(keys, pairs[:, 2])
        self.beside = np.sort(np.array([(ord(a) << 21) | ord(b) for a, b in beside], np.int64))
        bytes_of = {int(p.piece[3:5], 16): i for i, p in enumerate(model.pieces) if p.type == BYTE}
        self.byte_ids = np.array([bytes_of[b] for b in range(256)], np.int32)
        shown = [self._shown(p, train.unk_surface) for p in model.pieces]
        self.shown_sizes = np.array([len(s) for s in shown], np.int64)
        self.shown_starts = np.cumsum(self.shown_sizes) - self.shown_sizes
        self.shown = np.frombuffer(b"".join(shown), np.uint8)
        self.marked = np.array([p.piece.startswith(MARK) for p in model.pieces])
        self.silent = np.array([p.type == CONTROL for p in model.pieces])
        self._forget()

    def _part(self, text: str, normal: dict[str, int]) -> int | None:
        """The symbol of a half of a piece: a piece, or a character without one."""
        return normal.get(text, self.size + ord(text) if len(text) == 1 else None)

    @staticmethod
    def _shown(piece, unk_surface: str) -> bytes:
        if piece.type == BYTE:
            return bytes([int(piece.piece[3:5], 16)])
        if piece.type == CONTROL:
            return b""
        if piece.type == UNKNOWN:
            return unk_surface.encode()
        return piece.piece.replace(MARK, " ").encode()

    def _hash(self, keys: np.ndarray, makes: np.ndarray) -> None:
        """An open-addressed table of the pairs, at most an eighth full; ``probes``: the longest chain."""
        self.bits = max(10, int(len(keys)).bit_length() + 3)
        self.slot_keys, self.slot_makes = np.full(1 << self.bits, -1, np.int64), np.zeros(1 << self.bits, np.int64)
        self.probes, left, at = 0, np.arange(len(keys)), self._slot(keys)
        while len(left):
            self.probes += 1
            free = self.slot_keys[at] < 0
            self.slot_keys[at[free]] = keys[left[free]]
            placed = self.slot_keys[at] == keys[left]  # the last one written to a slot has it
            self.slot_makes[at[placed]] = makes[left[placed]]
            left, at = left[~placed], (at[~placed] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * MIX) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _merged(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(piece, rank) of each pair; rank ``NONE`` where it makes none."""
        keys = left * self.span + right
        at = self._slot(keys)
        held = self.slot_keys[at]
        made = np.where(held == keys, self.slot_makes[at], -1)
        further = np.flatnonzero((held != keys) & (held >= 0))
        for _ in range(1, self.probes):
            if not len(further):
                break
            at[further] = (at[further] + 1) & ((1 << self.bits) - 1)
            held = self.slot_keys[at[further]]
            hit = held == keys[further]
            made[further[hit]] = self.slot_makes[at[further[hit]]]
            further = further[~hit & (held >= 0)]
        return made, np.where(made < 0, NONE, self.rank_of[made])

    def _units(self, chars: np.ndarray, word: np.ndarray) -> np.ndarray:
        """The unit of each character: words cut between characters no piece holds side by side."""
        joined = np.zeros(len(chars), bool)
        if len(chars) > 1 and len(self.beside):
            keys = (chars[:-1].astype(np.int64) << 21) | chars[1:]
            at = np.minimum(np.searchsorted(self.beside, keys), len(self.beside) - 1)
            joined[1:] = (self.beside[at] == keys) & (word[1:] == word[:-1])
        return np.cumsum(~joined) - 1

    def _rounds(self, sym: np.ndarray, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(symbols, unit) after all merges, units in order."""
        done_sym, done_unit = [], []
        made, rank = np.zeros(len(sym), np.int64), np.full(len(sym), NONE)
        if len(sym) > 1:
            made[:-1], rank[:-1] = self._merged(sym[:-1], sym[1:])
            rank[:-1][unit[:-1] != unit[1:]] = NONE
        for _ in range(ROUNDS):
            if not len(sym):
                break
            starts = np.flatnonzero(np.r_[True, unit[1:] != unit[:-1]])
            sizes = np.diff(np.r_[starts, len(sym)])
            least = np.minimum.reduceat(rank, starts)
            live = np.repeat(least < NONE, sizes)
            if not live.all():
                done_sym.append(sym[~live])
                done_unit.append(unit[~live])
                sym, unit, made, rank = sym[live], unit[live], made[live], rank[live]
                sizes, least = sizes[least < NONE], least[least < NONE]
                if not len(sym):
                    break
            wanted = np.repeat(least, sizes)
            at = np.flatnonzero(rank == wanted)
            # of overlapping occurrences every second one goes, from the left
            first = np.r_[True, np.diff(at) > 1]
            place = np.arange(len(at)) - np.flatnonzero(first)[np.cumsum(first) - 1]
            at = at[place % 2 == 0]
            new, limit = made[at], wanted[at]
            right, left = np.minimum(at + 2, len(sym) - 1), np.maximum(at - 1, 0)
            early = (at + 2 < len(sym)) & (unit[right] == unit[at]) & (self._merged(new, sym[right])[1] <= limit)
            before = np.where(np.r_[False, at[1:] - at[:-1] == 2], np.r_[new[:1], new[:-1]], sym[left])
            early |= (at > 0) & (unit[left] == unit[at]) & (self._merged(before, new)[1] <= limit)
            if early.any():  # a unit's merges after its first such one wait for a later round
                own = unit[at]
                head = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
                seen = np.cumsum(early) - early  # before this one
                ok = seen == np.repeat(seen[head], np.diff(np.r_[head, len(at)]))
                at, new = at[ok], new[ok]
            sym[at] = new
            keep = np.ones(len(sym), bool)
            keep[at + 1] = False
            sym, unit, made, rank = sym[keep], unit[keep], made[keep], rank[keep]
            at = at - np.arange(len(at))
            beside = np.zeros(len(sym), bool)
            beside[at] = True
            beside[at[at > 0] - 1] = True
            again = np.flatnonzero(beside)
            last = again == len(sym) - 1
            nxt = np.where(last, again, again + 1)
            made[again], found = self._merged(sym[again], sym[nxt])
            rank[again] = np.where(last | (unit[again] != unit[nxt]), NONE, found)
        if len(sym):  # the long units
            starts = np.flatnonzero(np.r_[True, unit[1:] != unit[:-1]])
            for a, b in zip(starts, [*starts[1:], len(sym)]):
                left = self._one_by_one(sym[a:b].tolist())
                done_sym.append(np.array(left, np.int64))
                done_unit.append(np.full(len(left), unit[a]))
        if not done_sym:
            return sym, unit
        sym, unit = np.concatenate(done_sym), np.concatenate(done_unit)
        order = np.argsort(unit, kind="stable")
        return sym[order], unit[order]

    def _one_by_one(self, sym: list[int]) -> list[int]:
        """The same merges in turn, least (rank, place) first."""
        table = self.table
        span, before, after = int(self.span), list(range(-1, len(sym) - 1)), list(range(1, len(sym) + 1))
        heap: list[tuple[int, int, int, int]] = []

        def offer(i: int, j: int) -> None:
            if 0 <= i and j < len(sym) and (made := table.get(sym[i] * span + sym[j])) is not None:
                heapq.heappush(heap, (int(self.rank_of[made]), i, j, made))

        for i in range(len(sym) - 1):
            offer(i, i + 1)
        while heap:
            _, i, j, made = heapq.heappop(heap)
            if sym[i] < 0 or after[i] != j or j >= len(sym) or table.get(sym[i] * span + sym[j]) != made:
                continue
            sym[i], sym[j] = made, -1
            after[i] = after[j]
            if after[j] < len(sym):
                before[after[j]] = i
            offer(before[i], i)
            offer(i, after[i])
        return [s for s in sym if s >= 0]

    def _words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words one after another, how many each has)."""
        chars = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.int64)
        word = np.repeat(np.arange(len(words)), np.fromiter(map(len, words), np.int64, len(words)))
        unit = self._units(chars, word)
        word_of_unit = word[np.flatnonzero(np.r_[True, unit[1:] != unit[:-1]])] if len(unit) else word
        sym, unit = self._rounds(self.symbol[chars], unit)
        owner = word_of_unit[unit] if len(unit) else unit
        odd = np.flatnonzero(sym >= self.size)
        sizes = np.ones(len(sym), np.int64)
        if len(odd):  # byte fallback
            distinct, which = np.unique(sym[odd], return_inverse=True)
            forms = [self.byte_ids[np.frombuffer(chr(c - self.size).encode(), np.uint8)] for c in distinct.tolist()]
            lengths = np.array([len(f) for f in forms])
            table = np.r_[np.arange(self.size, dtype=np.int32), np.concatenate(forms)]
            starts = self.size + np.cumsum(lengths) - lengths
            sizes[odd] = lengths[which]
            sym = sym.copy()
            sym[odd] = starts[which]
            ids = ragged(table, sym, sizes)
        else:
            ids = sym.astype(np.int32)
        return ids, np.bincount(owner, weights=sizes, minlength=len(words)).astype(np.int64)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after another, how many each has)."""
        if len(self.words) > CACHE_WORDS or len(self.word_ids) > CACHE_IDS:
            self._forget()
        words, known = self.words, len(self.words)
        codes, counts = [], []
        for text in texts:
            if not text:
                mine = []
            elif text[0] == " " or "  " in text or MARK in text:  # marks meet marks here
                mine = [MARK + text.replace(" ", MARK)]
            else:
                mine = [MARK + w for w in text.split(" ")]
            counts.append(len(mine))
            codes += [words.setdefault(w, len(words)) for w in mine]
        if len(words) > known:
            ids, sizes = self._words(list(itertools.islice(words, known, None)))
            self.word_ids, self.word_sizes = np.r_[self.word_ids, ids], np.r_[self.word_sizes, sizes]
        ids, sizes = self.word_ids, self.word_sizes
        starts = np.cumsum(sizes) - sizes
        codes = np.array(codes, np.int64)
        owner = np.repeat(np.arange(len(texts)), counts)
        return ragged(ids, starts[codes], sizes[codes]), np.bincount(owner, weights=sizes[codes], minlength=len(texts)).astype(np.int64)

    def _forget(self) -> None:
        self.words: dict[str, int] = {}
        self.word_ids, self.word_sizes = np.zeros(0, np.int32), np.zeros(0, np.int64)

    def encode_one(self, text: str) -> Iterator[np.ndarray]:
        """The ids of a text of any length, part by part."""
        at = 0
        while len(text) - at > PART:
            cut = at + PART
            while 0 <= (cut := text.find(" ", cut)) and not (text[cut - 1] not in (" ", MARK) and text[cut + 1 : cut + 2] not in ("", " ", MARK)):
                cut += 1
            if cut < 0:
                break
            yield self.encode([text[at:cut]])[0]
            at = cut + 1  # the space is the mark that leads the next part
        yield self.encode([text[at:]])[0]

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        """The texts of ids that lie one after another, ``counts`` of them a text."""
        ids = np.asarray(ids, np.int64)
        owner = np.repeat(np.arange(len(counts)), counts)
        spoken = ~self.silent[ids]
        first = np.full(len(counts), len(ids))
        np.minimum.at(first, owner[spoken], np.flatnonzero(spoken))
        cut = np.zeros(len(ids), np.int64)
        led = first[first < len(ids)]
        led = led[self.marked[ids[led]]]
        cut[led] = 1  # the mark of the dummy prefix
        sizes = self.shown_sizes[ids] - cut
        data = ragged(self.shown, self.shown_starts[ids] + cut, sizes).tobytes()
        ends = np.cumsum(np.bincount(owner, weights=sizes, minlength=len(counts)).astype(np.int64)).tolist()
        return [_utf8(data[a:b]) for a, b in zip([0, *ends[:-1]], ends)]


def _utf8(data: bytes) -> str:
    """The text; a byte that belongs to no whole character becomes U+FFFD."""
    try:
        return data.decode()
    except UnicodeDecodeError:
        return data.decode(errors="surrogateescape").encode("utf-16-le", "surrogatepass").decode("utf-16-le", "surrogatepass").translate({c: 0xFFFD for c in range(0xDC80, 0xDD00)})


def _with(part: pa.RecordBatch, name: str, values: pa.Array, schema: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([values if c == name else part.column(c) for c in schema], schema)


def _schema(df: DataFrame, name: str, kind) -> StructType:
    kept = [f for f in df.schema.fields if f.name != name]
    return StructType(kept).add(name, kind)


def encoded(docs: DataFrame, model: str = MODEL, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with the ids of every row's whole text in the array column ``ids``."""
    schema = _schema(docs, ids, ArrayType(IntegerType(), False))
    names = schema.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(model)
        for part in slices(batches, text):
            texts = [t or "" for t in part.column(text).to_pylist()]
            if max(map(len, texts)) > PART:
                runs = [np.concatenate(list(codec.encode_one(t))) for t in texts]
                flat, counts = np.concatenate(runs), np.array([len(r) for r in runs])
            else:
                flat, counts = codec.encode(texts)
            starts = pa.array(np.r_[0, np.cumsum(counts)], pa.int32())
            yield _with(part, ids, pa.ListArray.from_arrays(starts, pa.array(flat, pa.int32())), names)

    return docs.mapInArrow(run, schema)


def decoded(docs: DataFrame, model: str = MODEL, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``docs`` with the text that the ids of every row stand for (null ids: the empty text)."""
    schema = _schema(docs, text, StringType())
    names = schema.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(model)
        for batch in batches:
            sizes = pc.fill_null(pc.list_value_length(batch.column(ids)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            ends, first = np.cumsum(sizes), 0
            while first < batch.num_rows:  # bounded slices, as of texts
                base = ends[first - 1] if first else 0
                last = max(first + 1, int(np.searchsorted(ends, base + PART // 4, side="right")))
                part = batch.take(pa.array(np.arange(first, last)))
                flat = pc.list_flatten(part.column(ids)).to_numpy(zero_copy_only=False)
                yield _with(part, text, pa.array(codec.decode(flat, sizes[first:last]), pa.string()), names)
                first = last
            pa.default_memory_pool().release_unused()

    return docs.mapInArrow(run, schema)
