"""Language-model scoring with Elias-Fano n-gram tries (unigrams and bigrams).

Tokens are ASCII-lower-cased words and one end a text; the end is also the context of a text's
first word. The model is p(w | u) = a(u, w) + l(u) * p(w): absolute discounting
a = max(c(uw) - D, 0) / c(u), l = D * (successors of u) / c(u), over the add-one unigram p.

The model grows with the corpus, so no task holds it whole. Words are dealt into shards by hash,
and a shard's trie has what its words' contexts need: the sorted words, monotone pointers to each
one's successors, and the successors, coded relative to their context so that the whole level is
one monotone sequence. Both sequences are Elias-Fano coded and lie with the 8-bit codes of a and l
in one memory map. A query (u, w) is a successor search for w inside u's range.

A frequent context does not lie in one shard: contexts of at least ``shard_bytes / 16`` tokens are cut
by successor hash into parts of about that many tokens, each dealt like a word of its own. A part takes
the whole context's total from a small aggregate, and the parts' numbers of successors are summed where
a block is scored, so the codes are those of the undivided context.

1. Texts are tokenised once into blocks of about ``block_tokens`` tokens (a written table).
2. Each block sends each shard its distinct words and bigrams there with their training counts:
   one row a block and shard, so repeated words, lines or passages are summed before the shuffle.
3. A shard adds the counts up, builds its trie and answers each block with one byte a bigram.
4. A block puts the answers together with its tokens and sums each text's log10 probabilities.

Every n-gram counts; nothing is pruned or sampled. Words are named by 64-bit hashes, successors
within a context by 40 bits of them.

Edge cases: null and empty texts are the end token alone; with no training rows all counts are 0
and scores use the unigram p; rows with a null doc_id are scored (and train, if ``is_training``
says so); repeated rows train once each and are scored alike; an empty table gives none; other
columns are ignored.
"""

from __future__ import annotations

import mmap
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from activitykit.llm.common import MIX, coded, mix64, plain, slices, texts_of, words_of
from activitykit.runtime import scratch_path

DISCOUNT = 0.75
BLOCK_TOKENS = 1 << 20
SHARD_BYTES = 16 << 20
LEAST_SHARDS = 48
WORD_BITS = np.uint64(40)
WORD_MASK = np.uint64((1 << 40) - 1)
STEPS, STEP = 255, 8.0 / 255  # 8-bit codes: log10 from 0 down to -8
END = np.uint64(xxhash.xxh3_64_intdigest(b""))
BLOCK = "block long, doc_id array<long>, held_out array<boolean>, n_tokens array<long>, codes binary, words binary"
SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def quantised(p: np.ndarray) -> np.ndarray:
    """Codes 1..255 of probabilities above 0, 0 for 0."""
    with np.errstate(divide="ignore"):
        code = STEPS - np.rint(-np.log10(p) / STEP)
    return np.where(p > 0, np.clip(code, 1, STEPS), 0).astype(np.uint8)


def restored(code: np.ndarray) -> np.ndarray:
    return np.where(code > 0, np.power(10.0, (code.astype(np.float64) - STEPS) * STEP), 0.0)


class Hot:
    """The contexts cut into parts: ``words`` (sorted), how many ``parts`` each, its training ``total``, and
    its first part's place in ``names``, the hashes under which the parts are dealt."""

    def __init__(self, words: np.ndarray, parts: np.ndarray, total: np.ndarray):
        self.words, self.parts, self.total = words, parts, total
        self.first = np.cumsum(parts) - parts
        number = (np.arange(parts.sum()) - np.repeat(self.first, parts) + 1).astype(np.uint64)
        self.names = mix64(np.repeat(words, parts) + number * MIX)
        self.order = np.argsort(self.names)

    def place(self, words: np.ndarray) -> np.ndarray:
        """Place of each word among ``words``, -1 where it is not cut."""
        return _place(self.words, words)

    def totals(self, names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the ``names`` are parts, and the whole contexts' totals of those."""
        at = _place(self.names[self.order], names)
        part = at >= 0
        return part, np.repeat(self.total, self.parts)[self.order][at[part]]


def _place(table: np.ndarray, values: np.ndarray) -> np.ndarray:
    at = np.searchsorted(table, values)
    found = at < len(table)
    found[found] = table[at[found]] == values[found]
    return np.where(found, at, -1)


class EliasFano:
    """A monotone sequence in about 2 + log2(universe / n) bits a value, kept in a memory map."""

    def __init__(self, values: np.ndarray, universe: int):
        n = len(values)
        self.n, self.low_bits = n, max(0, int(universe // max(n, 1)).bit_length() - 1)
        low, high = values & np.uint64((1 << self.low_bits) - 1), (values >> np.uint64(self.low_bits)).astype(np.int64)
        self.buckets = int(universe >> self.low_bits) + 1
        ones = np.zeros(-(-(n + self.buckets + 1) // 64) * 64, bool)
        ones[high + np.arange(n)] = True
        self.high = _mapped(np.packbits(ones, bitorder="little").view(np.uint64))
        ones_in = np.bitwise_count(self.high).astype(np.int64)
        self.before = {1: np.r_[0, np.cumsum(ones_in)], 0: np.r_[0, np.cumsum(64 - ones_in)]}
        self.low = _mapped(_pack(low, self.low_bits))

    def _select(self, bit: int, k: np.ndarray) -> np.ndarray:
        """Position of the k-th (from 0) bit of this kind: its word from the directory, then halving."""
        word = np.searchsorted(self.before[bit], k, side="right") - 1
        bits = self.high[word] if bit else ~self.high[word]
        left = k - self.before[bit][word]
        place = word * 64
        for half in (32, 16, 8, 4, 2, 1):
            count = np.bitwise_count(bits & np.uint64((1 << half) - 1)).astype(np.int64)
            up = left >= count
            left -= np.where(up, count, 0)
            place += np.where(up, half, 0)
            bits = np.where(up, bits >> np.uint64(half), bits)
        return place

    def _bucket_start(self, bucket: np.ndarray) -> np.ndarray:
        """How many values lie in smaller buckets: the place after the (bucket - 1)-th zero, less the zeros."""
        k = np.maximum(bucket - 1, 0)
        return np.where(bucket > 0, self._select(0, k) - k, 0)

    def get(self, at: np.ndarray) -> np.ndarray:
        high = (self._select(1, at.copy()) - at).astype(np.uint64)
        return (high << np.uint64(self.low_bits)) | _unpack(self.low, at, self.low_bits)

    def find(self, x: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Place of each value between its ``first`` and ``last``, -1 where absent: the first not smaller, if equal."""
        bucket = (x >> np.uint64(self.low_bits)).astype(np.int64)
        at, end = np.maximum(self._bucket_start(bucket), first), np.minimum(self._bucket_start(bucket + 1), last)
        low = x & np.uint64((1 << self.low_bits) - 1)
        stop, todo = end.copy(), np.flatnonzero(at < end)
        while len(todo):  # halving: a crowded bucket of a frequent context takes a few steps more
            middle = (at[todo] + end[todo]) >> 1
            less = _unpack(self.low, middle, self.low_bits) < low[todo]
            at[todo] = np.where(less, middle + 1, at[todo])
            end[todo] = np.where(less, end[todo], middle)
            todo = todo[at[todo] < end[todo]]
        out, inside = np.full(len(x), -1, np.int64), np.flatnonzero(at < stop)
        equal = inside[_unpack(self.low, at[inside], self.low_bits) == low[inside]]
        out[equal] = at[equal]
        return out


def _mapped(data: np.ndarray) -> np.ndarray:
    held = mmap.mmap(-1, max(data.nbytes, 1))
    held[: data.nbytes] = data.tobytes()
    return np.frombuffer(held, data.dtype, len(data))


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    out = np.zeros(len(values) * width // 64 + 2, np.uint64)
    if not width:
        return out
    at = np.arange(len(values)) * width
    word, shift = at >> 6, (at & 63).astype(np.uint64)
    np.bitwise_or.at(out, word, values << shift)
    over = shift + np.uint64(width) > np.uint64(64)
    np.bitwise_or.at(out, word[over] + 1, values[over] >> (np.uint64(64) - shift[over]))
    return out


def _unpack(data: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    if not width:
        return np.zeros(len(at), np.uint64)
    bit = at * width
    word, shift = bit >> 6, (bit & 63).astype(np.uint64)
    high = np.where(shift > 0, data[word + 1] << ((np.uint64(64) - shift) & np.uint64(63)), np.uint64(0))
    return ((data[word] >> shift) | high) & np.uint64((1 << width) - 1)


def _left(kinds: np.ndarray, total: np.ndarray, discount: float) -> np.ndarray:
    """Codes of l."""
    return quantised(np.where(total > 0, discount * kinds / np.maximum(total, 1), 1.0))


class Trie:
    """One shard: words, pointers to their successors, successors, and codes of a and l."""

    def __init__(self, words: np.ndarray, pairs: np.ndarray, counts: np.ndarray, discount: float, hot: Hot):
        """``words`` sorted; ``pairs``: (place of u) << 40 | w, sorted, with training ``counts`` above 0."""
        self.words = words
        context = (pairs >> WORD_BITS).astype(np.int64)
        kinds = np.bincount(context, minlength=len(words))
        total = np.bincount(context, counts, len(words))
        self.part, whole = hot.totals(words)
        total[self.part] = whole
        self.kinds = kinds
        self.pointers = EliasFano(np.cumsum(kinds).astype(np.uint64), max(len(pairs), 1))
        self.successors = EliasFano(pairs, max(len(words), 1) << int(WORD_BITS))
        self.gain = quantised((counts - discount) / np.maximum(total[context], 1))
        self.rest = _left(kinds, total, discount)

    def search(self, contexts: np.ndarray, words: np.ndarray) -> np.ndarray:
        """Codes of a for successors (40-bit hashes) of the words at places ``contexts``; 0: unseen."""
        out = np.zeros(len(words), np.uint8)
        if not len(self.gain):
            return out
        # queries come by context, so each context's range is looked up once
        starts = np.flatnonzero(np.r_[True, contexts[1:] != contexts[:-1]]) if len(contexts) else contexts
        times = np.diff(np.r_[starts, len(contexts)])
        own = contexts[starts]
        last = self.pointers.get(own).astype(np.int64)
        first = np.where(own > 0, self.pointers.get(np.maximum(own - 1, 0)).astype(np.int64), 0)
        first, last = np.repeat(first, times), np.repeat(last, times)
        asked = np.flatnonzero(first < last)
        at = self.successors.find((contexts[asked].astype(np.uint64) << WORD_BITS) | words[asked], first[asked], last[asked])
        out[asked[at >= 0]] = self.gain[at[at >= 0]]
        return out


def blocks(docs: DataFrame, held_out: Column, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Tokenised texts, about ``block_tokens`` tokens a row: codes index the block's word hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        number, size = TaskContext.get().partitionId() << 32, 0

        def flush() -> pa.RecordBatch:
            every = np.concatenate([h for *_, h in held])
            codes, words = pd.factorize(every)
            order = np.argsort(-np.bincount(codes), kind="stable")  # frequent words get small codes, which pack well
            words, codes = words[order], np.argsort(order)[codes]
            docs, out, counts = ([x for part in held for x in part[i]] for i in range(3))
            row = [[number], [docs], [out], [counts], [_planes(codes)], [words.tobytes()]]
            types = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int64()), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, types)], ["block", "doc_id", "held_out", "n_tokens", "codes", "words"])

        for part in slices(batches):
            words, starts = words_of(pc.ascii_lower(texts_of(part)))
            codes, table = coded(words)
            named = np.fromiter(map(xxhash.xxh3_64_intdigest, plain(table)), np.uint64, len(table))
            hashes = np.insert(named[codes] if len(codes) else np.zeros(0, np.uint64), starts[1:], END)
            held.append((part.column("doc_id").to_pylist(), part.column("held_out").to_pylist(), (np.diff(starts) + 1).tolist(), hashes))
            size += len(hashes)
            if size >= block_tokens:
                yield flush()
                held, size, number = [], 0, number + 1
        if held:
            yield flush()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"), "text").mapInArrow(run, BLOCK)


def _planes(codes: np.ndarray) -> bytes:
    """32-bit codes byte plane by byte plane: the upper planes are mostly zero."""
    return np.ascontiguousarray(codes.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _codes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int32)


def _tokens(row) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a block: word hashes, each token's code, its context's code, and whether its text trains."""
    words, codes = np.frombuffer(row.words, np.uint64), _codes(row.codes)
    counts = np.asarray(row.n_tokens, np.int64)
    before = np.r_[codes[:0], np.zeros(1, np.int32), codes[:-1]]
    before[np.cumsum(counts) - counts] = np.flatnonzero(words == END)[0]
    return words, codes, before, np.repeat(~np.asarray(row.held_out, bool), counts)


def _counted(least: int):
    """Per block: its words with at least ``least`` tokens, and how many."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                words = np.frombuffer(row.words, np.uint64)
                n = np.bincount(_codes(row.codes), minlength=len(words))
                yield pd.DataFrame({"word": words[n >= least].view(np.int64), "n": n[n >= least]})

    return run


def _context_totals(hot: np.ndarray):
    """Per block: how many training tokens follow each of the ``hot`` words."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                words, _, before, trains = _tokens(row)
                n = np.bincount(before, trains, len(words)).astype(np.int64)
                own = np.flatnonzero(_place(hot, words) >= 0)
                yield pd.DataFrame({"word": words[own].view(np.int64), "n": n[own]})

    return run


def hot_contexts(told: DataFrame, part_tokens: int) -> Hot:
    """All words of ``part_tokens`` tokens or more, and perhaps some of half as many."""
    number = max(told.count(), 1)
    # what a word has in blocks that hold fewer of it than this comes to less than half of part_tokens
    least = max(1, part_tokens // (2 * number))
    sums = told.select("codes", "words").mapInPandas(_counted(least), "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    found = sums.filter(F.col("n") > (part_tokens - 1) // 2).toPandas()
    words = found["word"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(words)
    words, parts = words[order], -(-found["n"].to_numpy(np.int64)[order] // part_tokens) + 1
    if not len(words):
        return Hot(words, parts, parts)
    totals = told.select("held_out", "n_tokens", "codes", "words").mapInPandas(_context_totals(words), "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).toPandas()
    total = np.zeros(len(words), np.int64)
    total[_place(words, totals["word"].to_numpy(np.int64).view(np.uint64))] = totals["n"]
    return Hot(words, parts, total)


def _bigrams(row, shards: int, hot: Hot) -> tuple[np.ndarray, ...]:
    """A block's words and parts of hot words by shard, and its distinct bigrams by (shard of u, u); ``of``: each token's bigram."""
    words, codes, before, trains = _tokens(row)
    at = hot.place(words)
    own = np.flatnonzero(at >= 0)
    cut = hot.parts[at[own]]
    starts = np.cumsum(cut) - cut  # of each hot word, among the block's parts
    parts = hot.names[np.repeat(hot.first[at[own]] - starts, cut) + np.arange(cut.sum())]
    context = before
    if len(own):
        first, many, mixed = np.full(len(words), -1), np.ones(len(words), np.uint64), mix64(words & WORD_MASK)
        first[own], many[own] = len(words) + starts, cut
        tokens = np.flatnonzero(first[before] >= 0).astype(np.int32)
        context = before.copy()
        context[tokens] = first[before[tokens]] + (mixed[codes[tokens]] % many[before[tokens]]).astype(np.int64)
    every = np.concatenate([words, parts])
    shard = (every % np.uint64(shards)).astype(np.int64)
    order = np.lexsort((every, shard))
    place = np.empty(len(every), np.int64)
    place[order] = np.arange(len(every))
    named = place[context]
    named *= len(every)
    named += place[codes]
    del context
    pairs, of = np.unique(named, return_inverse=True)
    del named
    trained = np.bincount(of, trains, len(pairs)).astype(np.int64)
    seen = np.zeros(len(every), np.int64)
    seen[place[: len(words)]] = np.bincount(codes, trains, len(words))
    cuts = place[own], place[len(words) :], starts, hot.total[at[own]]
    return every[order], shard[order], seen, pairs // len(every), pairs % len(every), trained, cuts, of, place, codes, before


def _messages(shards: int, hot: Hot):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                words, shard, seen, first, second, trained = _bigrams(row, shards, hot)[:6]
                cuts = np.searchsorted(shard, np.arange(shards + 1))
                ends = np.searchsorted(first, cuts)
                low = words & WORD_MASK
                out = []
                for s in range(shards):
                    a, b, c, d = cuts[s], cuts[s + 1], ends[s], ends[s + 1]
                    follow = low[second[c:d]]
                    out.append((s, row.block, words[a:b].tobytes(), _small(seen[a:b]), _small(np.bincount(first[c:d] - a, minlength=b - a)), _five(follow), _small(trained[c:d])))
                del words, shard, seen, first, second, trained, low
                yield pd.DataFrame(out, columns=["shard", "block", "words", "seen", "kinds", "follow", "trained"])
            pa.default_memory_pool().release_unused()

    return run


def _small(counts: np.ndarray) -> bytes:
    """Counts as bytes where all are under 256, else as 64-bit numbers."""
    fits = not len(counts) or counts.max() < 256
    return (b"1" if fits else b"8") + counts.astype(np.uint8 if fits else np.int64).tobytes()


def _counts(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint8 if data[:1] == b"1" else np.int64, offset=1).astype(np.int64)


def _five(values: np.ndarray) -> bytes:
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5].tobytes()


def _hashes(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 5, 8), np.uint8)
    out[:, :5] = np.frombuffer(data, np.uint8).reshape(-1, 5)
    return out.view("<u8").ravel()


def _shard(discount: float, hot: Hot):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        named = [np.frombuffer(w, np.uint64) for w in rows["words"]]
        words = np.unique(np.concatenate(named))
        seen = np.zeros(len(words), np.int64)
        asked, trained = [], []
        for own, row in zip(named, rows.itertuples()):
            at = np.searchsorted(words, own)
            seen[at] += _counts(row.seen)
            asked.append((np.repeat(at, _counts(row.kinds)).astype(np.uint64) << WORD_BITS) | _hashes(row.follow))
            trained.append(_counts(row.trained))
        pairs, counts = np.concatenate(asked), np.concatenate(trained)
        met = counts > 0
        known, of = np.unique(pairs[met], return_inverse=True)
        trie = Trie(words, known, np.bincount(of, counts[met], len(known)), discount, hot)
        out = []
        for own, mine, row in zip(named, asked, rows.itertuples()):
            at = np.searchsorted(words, own)
            codes = trie.search((mine >> WORD_BITS).astype(np.int64), mine & WORD_MASK)
            out.append((row.block, row.shard, _small(seen[at]), trie.rest[at].tobytes(), codes.tobytes(), _small(trie.kinds[at[trie.part[at]]]), int(seen.sum()), int((seen > 0).sum())))
        return pd.DataFrame(out, columns=["block", "shard", "seen", "rest", "gain", "kinds", "n", "v"])

    return run


def _scorer(shards: int, discount: float, hot: Hot):
    def run(block: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        answers = answers.sort_values("shard")
        row = next(block.itertuples())
        *_, (cut, parts, starts, total), of, place, codes, before = _bigrams(row, shards, hot)
        seen = np.concatenate([_counts(x) for x in answers["seen"]])
        rest = restored(np.frombuffer(b"".join(answers["rest"]), np.uint8))
        if len(cut):  # the parts' successors come in the order of their places
            kinds = np.zeros(len(rest), np.int64)
            kinds[np.sort(parts)] = np.concatenate([_counts(x) for x in answers["kinds"]])
            rest[cut] = restored(_left(np.add.reduceat(kinds[parts], starts), total, discount))
        gain = restored(np.frombuffer(b"".join(answers["gain"]), np.uint8))
        n, v = int(answers["n"].sum()), int(answers["v"].sum())
        unigram = (seen + 1) / (n + v + 1)
        base = np.log10(unigram)[place[codes]]
        score = np.log10(gain[of] + rest[place[before]] * unigram[place[codes]])
        counts = np.asarray(row.n_tokens, np.int64)
        starts = np.cumsum(counts) - counts
        return pd.DataFrame(
            {
                "doc_id": pd.array(row.doc_id, dtype="Int64"),
                "held_out": np.asarray(row.held_out, bool),
                "n_tokens": counts,
                "n_known": np.add.reduceat((seen[place[codes]] > 0).astype(np.int64), starts),
                "train_tokens": n,
                "base_score": np.add.reduceat(base, starts),
                "score": np.add.reduceat(score, starts),
            }
        )

    return run


def score(docs: DataFrame, held_out: Column, discount: float = DISCOUNT, block_tokens: int = BLOCK_TOKENS, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """``SCORED`` of every row, learning from those that are not held out."""
    spark = docs.sparkSession
    path = scratch_path(spark, "lm-blocks")
    blocks(docs, held_out, block_tokens).write.option("compression", "zstd").parquet(path)
    told = spark.read.parquet(path)
    size = told.agg(F.sum(F.length("codes"))).first()[0] or 0
    shards = max(LEAST_SHARDS, -(-size // shard_bytes))
    hot = hot_contexts(told, max(1, shard_bytes // 16))
    sent = told.mapInPandas(_messages(shards, hot), "shard int, block long, words binary, seen binary, kinds binary, follow binary, trained binary")
    answers = sent.groupBy("shard").applyInPandas(_shard(discount, hot), "block long, shard int, seen binary, rest binary, gain binary, kinds binary, n long, v long")
    return told.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(_scorer(shards, discount, hot), SCORED)
