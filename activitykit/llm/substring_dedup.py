"""Substring dedup by hashing clauses, lines or paragraphs.

A text's units are the parts between its separators: of ``unit="clause"`` line breaks, white space
after one of ``.!?,;:``, and the place after a full-width mark; of ``"line"`` line breaks; of
``"paragraph"`` runs of two or more line breaks. A unit is normalised (A-Z to lower case, runs of
white space made one space, trimmed) and named by 96 bits of its XXH3 digest. Units without a word
are layout: never compared, never the cause of a removal.

Over the whole table the occurrence ranked first, by (doc_id, place in the text), stays; the others
are later ones. What goes are runs of later units, one after another in a text, of at least
``min_words`` words together: a copied passage is cut whole, from its first whole unit to its last,
even where it starts and ends inside a line; a short stock line that many documents share stays. A
removed span ends before the separator after its last unit, so lines stay apart.

Within a text the first of equal units is known without the table, so a text sends each distinct
unit once. Digests are counted with map-side partial aggregation; only those of two or more rows are
joined back to the units, so a unit in a third of all documents is one row of that table and its
occurrences are split by the adaptive skew join.

Edge cases: a null text has no units and stays null; an empty text stays empty; texts of any length
are compared whole; rows that share a doc_id are of one rank: none is later than another, and equal
rows get the same result; a null doc_id ranks after all others, and rows without one are of one
rank; an empty table gives none; other columns pass through ``clean`` untouched, whatever their
names, but for those named as its own counts, which it replaces.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from activitykit.llm.common import cut_lineage, free_name, slices

MIN_WORDS = 25
WS = r"[\x20\x09-\x0d]"
SEPARATOR = {
    "clause": rf"(?<=[.!?,;:]){WS}+|\n|(?<=[。！？；，、：]){WS}*",
    "line": r"\n",
    "paragraph": r"\n{2,}",
}
COUNTS = "n_units long, n_removed long, removed_spans string, text string"


def _digest(words: list[bytes]) -> bytes:
    return xxhash.xxh3_128_digest(b" ".join(words))[:12]


def units(docs: DataFrame, unit: str = "clause") -> DataFrame:
    """(doc_id, sig, h1, h2) of each text's distinct units; ``sig`` spreads the rows without a doc_id."""
    cut = re.compile(SEPARATOR[unit])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            digests, counts = [], []
            for text in part.column("text").to_pylist():
                words = [u.split() for u in map(str.encode, cut.split(_lower(text)))] if text else ()
                own = {_digest(w) for w in words if w}
                digests += own
                counts.append(len(own))
            flat = np.frombuffer(b"".join(digests), np.dtype([("h1", "<i8"), ("h2", "<i4")]))
            at = pa.array(np.repeat(np.arange(part.num_rows), counts))
            arrays = [part.column("doc_id").take(at), part.column("sig").take(at), pa.array(flat["h1"].copy()), pa.array(flat["h2"].copy())]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "sig", "h1", "h2"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", _sig(), "text").mapInArrow(run, f"doc_id {kind}, sig long, h1 long, h2 int")


def _sig():
    return F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(F.lit(0)).cast("long").alias("sig")


def _lower(text: str) -> str:
    return text.encode().lower().decode()  # of bytes, so A-Z alone


def later_units(docs: DataFrame, unit: str = "clause") -> DataFrame:
    """(doc_id, sig, later): 64 bits of the digests of each text's units that a row of smaller rank holds."""
    every = units(docs, unit)
    shared = every.groupBy("h1", "h2").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1 AND first IS NOT NULL").drop("n")
    shared = cut_lineage(shared)  # both sides of the join are then shuffled, and a frequent unit can be split
    later = every.join(shared, ["h1", "h2"]).filter("doc_id IS NULL OR doc_id > first")
    return later.groupBy("doc_id", "sig").agg(F.collect_set("h1").alias("later"))


def clean(docs: DataFrame, unit: str = "clause", min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with ``text`` reduced to what stays, plus n_units, n_removed (units) and removed_spans.

    ``removed_spans``: ``start:end`` code-point offsets in the original text, joined by commas.
    """
    sig, gone_at = free_name("_sig", docs.columns), free_name("_later", docs.columns)
    later = later_units(docs, unit).withColumnRenamed("later", gone_at)
    held = [c for c in docs.columns if c not in ("n_units", "n_removed", "removed_spans")]
    same = F.col("d.doc_id").eqNullSafe(F.col("g.doc_id")) & (F.col(f"d.{sig}") == F.col("g.sig"))
    both = docs.select(*[F.col(f"`{c}`") for c in held], _sig().alias(sig)).alias("d").join(later.alias("g"), same, "left")
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*[F.col(f"`{c}`") for c in held]).schema if f.name != "text"] + [COUNTS])
    rows = both.select(*[F.col(f"d.`{c}`") for c in held], f"g.{gone_at}").mapInArrow(_rewriter(SEPARATOR[unit], min_words, held, gone_at), schema)
    return rows.select(*[F.col(f"`{c}`") for c in held], "n_units", "n_removed", "removed_spans")


def _rewriter(separator: str, min_words: int, held: list[str], gone_at: str):
    cut = re.compile(f"({separator})")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            rows = [rewrite(t, g, cut, min_words) for t, g in zip(part.column("text").to_pylist(), part.column(gone_at).to_pylist())]
            n_units, n_removed, spans, texts = ([r[i] for r in rows] for i in range(4))
            names = [c for c in held if c != "text"]
            yield pa.RecordBatch.from_arrays(
                [part.column(c) for c in names] + [pa.array(n_units, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(spans, pa.string()), pa.array(texts, pa.string())],
                [*names, "n_units", "n_removed", "removed_spans", "text"],
            )

    return run


def rewrite(text: str | None, later: list[int] | None, cut: re.Pattern, min_words: int) -> tuple[int, int, str, str | None]:
    """(units, removed units, spans, text that stays) of a text, given the units that an earlier row holds."""
    if not text:
        return 0, 0, "", text
    earlier, own = set(later or ()), set()
    n_units, at, run, runs = 0, 0, None, []  # a run: [start, end, units, words]
    for k, part in enumerate(cut.split(text)):
        end = at + len(part)
        words = part.encode().lower().split() if not k % 2 else None
        if words:
            n_units += 1
            digest = _digest(words)
            if digest in own or int.from_bytes(digest[:8], "little", signed=True) in earlier:
                if run is None:
                    runs.append(run := [at, end, 0, 0])
                run[1], run[2], run[3] = end, run[2] + 1, run[3] + len(words)
            else:
                run = None
                own.add(digest)
        at = end
    runs = [r for r in runs if r[3] >= min_words]
    cuts = [0, *(x for r in runs for x in r[:2]), len(text)]
    kept = "".join([text[a:b] for a, b in zip(cuts[::2], cuts[1::2])])
    return n_units, sum(r[2] for r in runs), ",".join(f"{r[0]}:{r[1]}" for r in runs), kept


CLEAN_SQL = r"""
WITH cut AS (
  SELECT doc_id, text, regexp_extract_all(text, '[^\n]*?(?:[.!?,;:][\x20\x09-\x0D]+|[。！？；，、：][\x20\x09-\x0D]*|\n|$)') AS parts
  FROM documents WHERE text IS NOT NULL),
tokens AS (SELECT doc_id, unnest(parts) AS part, generate_subscripts(parts, 1) AS pos FROM cut),
placed AS (
  SELECT doc_id, pos, part, translate(trim(regexp_replace(part, '[\x20\x09-\x0D]+', ' ', 'g')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS plain,
         CAST(coalesce(sum(length(part)) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS beg
  FROM tokens),
units AS (
  SELECT doc_id, pos, beg, beg + length(regexp_replace(part, CASE WHEN regexp_matches(part, '[.!?,;:。！？；，、：][\x20\x09-\x0D]*$') THEN '[\x20\x09-\x0D]+$' ELSE '\n$' END, '')) AS til,
         len(string_split(plain, ' ')) AS words, row_number() OVER (PARTITION BY plain ORDER BY doc_id, pos) > 1 AS later
  FROM placed WHERE plain <> ''),
marked AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pos) - row_number() OVER (PARTITION BY doc_id, later ORDER BY pos) AS run FROM units),
spans AS (
  SELECT doc_id, min(beg) AS a, max(til) AS b, count(*) AS n FROM marked WHERE later GROUP BY doc_id, run HAVING sum(words) >= 25),
chained AS (SELECT *, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS before FROM spans),
gone AS (
  SELECT c.doc_id, sum(n) AS n_removed, string_agg(a || ':' || b, ',' ORDER BY a) AS removed_spans,
         string_agg(substring(d.text, CAST(before + 1 AS BIGINT), CAST(a - before AS BIGINT)), '' ORDER BY a) || substring(any_value(d.text), CAST(max(b) + 1 AS BIGINT)) AS text
  FROM chained c JOIN documents d USING (doc_id) GROUP BY c.doc_id),
counts AS (SELECT doc_id, count(*) AS n_units FROM units GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_units, 0) AS n_units, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(removed_spans, '') AS removed_spans, coalesce(g.text, d.text) AS text
FROM documents d LEFT JOIN counts USING (doc_id) LEFT JOIN gone g USING (doc_id)
"""
