"""Benchmark decontamination with Wu-Manber multi-pattern search over words.

Patterns are the benchmark's windows as word numbers.  A shift table over
blocks of two words says how far a search may jump, blocks that end a pattern
have shift 0, and their bucket of patterns (keyed by the suffix block and
checked by the prefix block) is compared word by word.
"""

from __future__ import annotations

import hashlib
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gazette.llm.common import batch, bounded_batches, id_and_text, staged, table

WINDOW = 10
#: Bytes of benchmark text that one pass searches for (under 1 million windows); a larger benchmark takes several passes.
PASS_BYTES = 4 << 20
#: A-Z in lower case, a-z, 0-9 and everything beyond ASCII stay, the rest separates words.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
#: Places of a shift table for each window, so that few blocks of other texts meet a place that is taken.
PLACES = 8
LANE = 256


def words_of(text: bytes | str | None) -> list[bytes]:
    if isinstance(text, str):
        text = text.encode("utf-8", "surrogatepass")
    return (text or b"").translate(FOLD).split()


class Patterns:
    """All windows of some items.  Word number 0 is any word that no item has."""

    def __init__(self, items: list[tuple[object, str | None]], window: int = WINDOW):
        self.numbers: dict[bytes, int] = {}
        self.items: list[str] = []
        by_length: dict[int, dict[bytes, set[int]]] = {}
        for item, text in items:
            words = words_of(text)
            if not words:
                continue
            self.items.append(str(item))
            ids = np.array([self.numbers.setdefault(w, len(self.numbers) + 1) for w in words], np.int64)
            m = min(window, len(words))
            windows = by_length.setdefault(m, {})
            for i in range(len(ids) - m + 1):
                windows.setdefault(ids[i:i + m].tobytes(), set()).add(len(self.items) - 1)
        self.searches = [WuManber(m, windows) for m, windows in sorted(by_length.items())]

    def number(self, words: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
        """Word numbers of some texts in a row, a 0 after each text, and each text's end."""
        get = self.numbers.get
        size = sum(map(len, words)) + len(words)
        flat = np.fromiter(chain.from_iterable(chain((get(w, 0) for w in ws), (0,)) for ws in words), np.int64, size)
        return flat, np.cumsum([len(ws) + 1 for ws in words])

    def find(self, words: list[list[bytes]]) -> list[tuple[list[tuple[int, int]], set[int]]]:
        """For each text, the covered spans (merged, in words) and the items found."""
        flat, ends = self.number(words)
        spans: list[list[tuple[int, int]]] = [[] for _ in words]
        items: list[set[int]] = [set() for _ in words]
        for search in self.searches:
            begins, found = search.find(flat)
            row = np.searchsorted(ends, begins, side="right")
            for d, at, hit in zip(row.tolist(), begins.tolist(), found):
                first = at - (int(ends[d - 1]) if d else 0)
                spans[d].append((first, first + search.length))
                items[d] |= hit
        return [(merge(s), i) for s, i in zip(spans, items)]


class WuManber:
    def __init__(self, length: int, windows: dict[bytes, set[int]]):
        self.length, self.block = length, min(2, length)
        self.windows = windows
        patterns = np.array([np.frombuffer(w, np.int64) for w in windows])
        self.bits = max(12, (PLACES * len(windows)).bit_length())
        self.shift = np.full(1 << self.bits, length - self.block + 1, np.uint8 if length < 256 else np.int64)
        self.prefix = np.zeros(1 << self.bits, bool)
        self.bucket: dict[int, list[bytes]] = {}
        for end in range(self.block - 1, length):
            np.minimum.at(self.shift, self.hash(patterns, end), self.shift.dtype.type(length - 1 - end))
        self.prefix[self.hash(patterns, self.block - 1)] = True
        for h, w in zip(self.hash(patterns, length - 1).tolist(), windows):
            self.bucket.setdefault(h, []).append(w)

    def hash(self, words: np.ndarray, end) -> np.ndarray:
        """Table place of the block that ends at ``end``."""
        last = words[..., end].astype(np.uint64)
        if self.block == 2:
            last = words[..., end - 1].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + last * np.uint64(0xC2B2AE3D27D4EB4F)
        else:
            last = last * np.uint64(0x9E3779B97F4A7C15)
        return (last >> np.uint64(64 - self.bits)).astype(np.int64)

    def candidates(self, flat: np.ndarray) -> np.ndarray:
        """Window ends whose block has shift 0.  The row is searched in lanes
        of LANE words at once, each jumping by its own shifts."""
        first = np.arange(self.length - 1, len(flat), LANE)
        if not len(first):
            return first
        at, stop, out = first.copy(), np.minimum(first + LANE, len(flat)), []
        while len(at):
            jump = self.shift[self.hash(flat, at)]
            out.append(at[jump == 0])
            at = at + np.maximum(jump, 1)
            live = at < stop
            at, stop = at[live], stop[live]
        return np.concatenate(out)

    def find(self, flat: np.ndarray) -> tuple[np.ndarray, list[set[int]]]:
        ends = self.candidates(flat)
        ends = ends[self.prefix[self.hash(flat, ends - self.length + self.block)]]
        begins, found = [], []
        for end, h in zip(ends.tolist(), self.hash(flat, ends).tolist()):
            own = flat[end - self.length + 1:end + 1].tobytes()
            for w in self.bucket.get(h, ()):
                if w == own:
                    begins.append(end - self.length + 1)
                    found.append(self.windows[w])
        return np.array(begins, np.int64), found


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def digest(items) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()


def passes(benchmark: DataFrame, item_col: str, text_col: str, pass_bytes: int) -> list[DataFrame]:
    """The benchmark, in parts of about ``pass_bytes``, so what the driver and a task hold stays bounded."""
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).cast("string").alias("text"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-size // pass_bytes))
    return [items] if n == 1 else [items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == i) for i in range(n)]


def _patterns(items: DataFrame, window: int) -> Patterns:
    return Patterns([(r.item, r.text) for r in items.collect()], window)


FOUND = "n_words long, spans array<struct<a:long,b:long>>, items array<string>"


def find_items(docs: DataFrame, items: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    bounded_batches(docs.sparkSession)
    rows = id_and_text(docs, id_col, text_col).withColumn("_row", F.xxhash64("_text"))
    patterns = _patterns(items, window)
    types = [pa.int64(), pa.int64(), pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())])), pa.list_(pa.string())]

    def run(batches):
        for b in batches:
            words = [words_of(t) for t in b.column(1).cast(pa.binary()).to_pylist()]
            got = patterns.find(words)
            schema = pa.schema([("_id", b.column(0).type), *zip(("_row", "n_words", "spans", "items"), types)])
            yield batch(schema, b.column(0), b.column(2), [len(w) for w in words], [[{"a": x, "b": y} for x, y in s] for s, _ in got],
                        [sorted(patterns.items[i] for i in f) for _, f in got])

    return rows.mapInArrow(run, f"_id {rows.schema['_id'].dataType.simpleString()}, _row long, {FOUND}")


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", window: int = WINDOW, pass_bytes: int = PASS_BYTES) -> DataFrame:
    """One row per document: n_words, n_hit, spans, n_items, items_sha256, contaminated.

    A null text has no words, a null or wordless item no window; equal items
    and item ids count once by id; equal documents are judged each for itself;
    other columns are ignored; empty tables give no rows or no hits.  A
    text is held whole, however long.  The benchmark, not the documents, is
    what driver and tasks hold, ``pass_bytes`` at a time: of several passes each
    is written before the next is read; they are joined by document, where equal
    rows have equal results.
    """
    parts = passes(benchmark, item_col, item_text_col, pass_bytes)
    found = [find_items(docs, p, id_col, text_col, window) if len(parts) == 1 else
             staged(find_items(docs, p, id_col, text_col, window), "benchmark-pass") for p in parts]
    got = found[0].drop("_row")
    if len(found) > 1:
        again = found[1]
        for f in found[2:]:
            again = again.unionByName(f)
        more = again.groupBy("_id", "_row").agg(F.max("n_words").alias("_n"), F.flatten(F.collect_set("spans")).alias("_spans"),
                                                F.flatten(F.collect_set("items")).alias("_items"))
        left = found[0]
        got = left.join(more, left["_id"].eqNullSafe(more["_id"]) & left["_row"].eqNullSafe(more["_row"])).select(
            left["_id"], left["n_words"], F.array_union(left["spans"], more["_spans"]).alias("spans"),
            F.array_union(left["items"], more["_items"]).alias("items"))

    def finish(batches):
        types = [pa.int64(), pa.int64(), pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())])), pa.int64(), pa.string(), pa.bool_()]
        for b in batches:
            spans = [merge([(s["a"], s["b"]) for s in x]) for x in b.column(2).to_pylist()]
            items = [set(x) for x in b.column(3).to_pylist()]
            hit = [sum(y - x for x, y in s) for s in spans]
            schema = pa.schema([("_id", b.column(0).type), *zip(("n_words", "n_hit", "spans", "n_items", "items_sha256", "contaminated"), types)])
            yield batch(schema, b.column(0), b.column(1), hit, [[{"a": x, "b": y} for x, y in s] for s in spans], [len(i) for i in items],
                        [digest(i) for i in items], [h > 0 for h in hit])

    kind = docs.schema[id_col].dataType.simpleString()
    out = f"_id {kind}, n_words long, n_hit long, spans array<struct<a:long,b:long>>, n_items long, items_sha256 string, contaminated boolean"
    return got.mapInArrow(finish, out).withColumnRenamed("_id", id_col)


def keep_clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
               window: int = WINDOW, pass_bytes: int = PASS_BYTES) -> DataFrame:
    """The documents (all their columns) without a hit.  One pass is a filter
    without a shuffle; of several, each writes the hashes of the texts it hits
    before the next is read, and an anti-join drops these texts."""
    bounded_batches(docs.sparkSession)
    at = docs.columns.index(text_col)
    parts = passes(benchmark, item_col, item_text_col, pass_bytes)

    def clean(batches, at, patterns, want):
        for b in batches:
            words = [words_of(t) for t in b.column(at).cast(pa.string()).cast(pa.binary()).to_pylist()]
            yield b.filter(pa.array([bool(spans) != want for spans, _ in patterns.find(words)], pa.bool_()))

    if len(parts) == 1:
        patterns = _patterns(parts[0], window)
        return docs.mapInArrow(lambda batches: clean(batches, at, patterns, True), docs.schema)
    named = docs.toDF(*[f"c{k}" for k in range(len(docs.columns))])
    texts = named.select(F.col(f"c{at}").cast("string").alias("text"))
    hit = []
    for part in parts:
        patterns = _patterns(part, window)
        found = texts.mapInArrow(lambda batches, patterns=patterns: clean(batches, 0, patterns, False), "text string")
        hit.append(staged(found.select(F.sha2("text", 256).alias("hit")).distinct(), "benchmark-pass"))
    every = hit[0]
    for h in hit[1:]:
        every = every.unionByName(h)
    return named.join(every, F.sha2(F.col(f"c{at}").cast("string"), 256) == F.col("hit"), "left_anti").toDF(*docs.columns)


def op10_decontamination(spark, sf_dir: str) -> DataFrame:
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


OP10_SQL = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), patterns AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS m, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS p
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 8, 2))) AS i FROM items WHERE len(w) > 0)
), lengths AS (SELECT DISTINCT m FROM patterns),
starts AS (
  SELECT doc_id, m, i, array_to_string(w[i:i + m - 1], ' ') AS p
  FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM words, lengths WHERE len(w) >= m)
), found AS (
  SELECT doc_id, i, m, item_id FROM starts JOIN patterns USING (m, p)
), hit AS (
  SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + m)) AS j FROM (SELECT DISTINCT doc_id, i, m FROM found)) GROUP BY 1
), named AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(s, ',' ORDER BY s)) AS items_sha256
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM found) GROUP BY 1
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""
