"""Substring deduplication with compressed FM-indexes.

A window of ``window`` consecutive words is repeated if its word sequence
starts anywhere else.  Windows are dealt to shards by content, so that all
occurrences of a window are in one shard and shards never need each other:

1. A window's key is the least hash of its ``gram``-word pieces (its
   minimizer).  Keys of one occurrence in the whole corpus are dropped: their
   windows can't be repeated.  Consecutive windows with one key are a segment.
2. Segments of repeated keys are fetched as texts, equal ones once, with a
   mark that they stand in more than one place.
3. Each shard builds an FM-index (suffix array, Burrows-Wheeler transform,
   wavelet matrix with rank directories, marks in suffix order) over its
   distinct segments.  All of them stream through it: backward search counts
   the places of a match, a marked suffix twice, which gives how far a match
   that occurs twice reaches, hence the windows above the threshold.
4. The intervals of each distinct segment go back to all its places.

A key with very many segments (the rim of a passage that stands everywhere)
is dealt once more, by the content of each single window.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gazette.llm.common import batch, bounded_batches, hashed_words, partitions, raw, staged, table

WINDOW, GRAM = 35, 16
#: Occurrences from which a key is dealt by single windows; words in one index.
HOT_KEY, INDEX_WORDS = 3000, 500_000
MULTIPLIER, MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


# --- keys -------------------------------------------------------------------

def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def slide(x: np.ndarray, width: int, of) -> np.ndarray:
    """``of`` (minimum or maximum) over every ``width`` consecutive values, by doubling."""
    size = 1
    while size * 2 <= width:
        x = of(x[:-size], x[size:])
        size *= 2
    rest = width - size
    return of(x[:len(x) - rest], x[rest:]) if rest else x


def runs(h: np.ndarray, counts: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, ...]:
    """The segments of some texts, whose word hashes stand in a row: text, key,
    content hash, first and last window (from the text's start), and whether
    the key's piece occurs more than once in the segment."""
    none = (np.zeros(0, np.int64),) * 5 + (np.zeros(0, bool),)
    if len(h) < window:
        return none
    total, size, piece, done, rest = h, 1, None, 0, gram
    while rest:  # polynomial hashes of gram words by doubling
        if rest & 1:
            n = len(h) - done - size + 1
            piece = total if piece is None else piece[:n] * power_of(size) + total[done:done + n]
            done += size
        rest >>= 1
        if rest:
            total = total[:-size] * power_of(size) + total[size:]
            size *= 2
    piece = piece ^ (piece >> np.uint64(31))
    piece = piece * MIX
    piece ^= piece >> np.uint64(29)
    wide = window - gram + 1
    low = slide(piece, wide, np.minimum)
    end = np.cumsum(counts)
    text = np.repeat(np.arange(len(counts)), counts)
    at = np.arange(len(low))
    valid = end[text[:len(low)]] - at >= window
    edge = valid & np.append(True, (low[1:] != low[:-1]) | ~valid[:-1] | (text[1:len(low)] != text[:len(low) - 1]))
    a = np.flatnonzero(edge)
    if not len(a):
        return none
    stop = np.flatnonzero(valid & np.append((low[1:] != low[:-1]) | ~valid[1:] | (text[1:len(low)] != text[:len(low) - 1]), True))
    # content hash of words a .. stop + window - 1, from running sums
    weighted = np.append(np.uint64(0), np.cumsum(h * powers(int(MULTIPLIER), len(h)), dtype=np.uint64))
    inverse = powers(pow(int(MULTIPLIER), -1, 1 << 64), len(h))
    content = (weighted[stop + window] - weighted[a]) * inverse[a]
    content = (content ^ (content >> np.uint64(32))) * MIX + (stop - a).astype(np.uint64)
    # a piece is its segment's key wherever it equals the key
    owner = np.cumsum(edge) - 1
    first = np.flatnonzero(valid)
    same = piece[first] == low[first]
    twice = np.bincount(owner[first][same], minlength=len(a))
    for j in range(1, wide):  # pieces behind the last window's start
        twice += piece[stop + j] == low[a]
    begin = (end - counts)[text[a]]
    return text[a], low[a].view(np.int64), content.view(np.int64), a - begin, stop - begin, twice > 1


def power_of(n: int) -> np.uint64:
    return np.uint64(pow(int(MULTIPLIER), n, 1 << 64))


# --- index ------------------------------------------------------------------

class Bits:
    """Bits packed in 64-bit words, with the ones before each word."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        words = np.zeros(len(bits) // 64 + 1, "<u8")
        words.view(np.uint8)[:len(packed)] = packed
        self.words = words.astype(np.uint64)
        self.before = np.cumsum(np.bitwise_count(words), dtype=np.int64) - np.bitwise_count(words)

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones before each place i."""
        word = i >> 6
        return self.before[word] + np.bitwise_count(self.words[word] & ((np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)))


class WaveletMatrix:
    """Bit planes of a sequence."""

    def __init__(self, sequence: np.ndarray, symbols: int):
        self.levels = max(1, int(symbols - 1).bit_length())
        self.planes = []
        for level in range(self.levels - 1, -1, -1):
            bits = (sequence >> level) & 1 > 0
            self.planes.append((level, Bits(bits), len(sequence) - int(bits.sum())))
            sequence = np.concatenate([sequence[~bits], sequence[bits]])

    def descend(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Place that position i of the top plane has for each symbol below the last plane."""
        for level, bits, zeros in self.planes:
            ones = bits.rank(i)
            i = np.where((symbol >> level) & 1 > 0, zeros + ones, i - ones)
        return i


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Order of all suffixes; zeros are separators, each unlike any other."""
    n = len(text)
    zero = text == 0
    rank = np.where(zero, np.cumsum(zero) - 1, text.astype(np.int64) + int(zero.sum()))
    rank = np.unique(rank, return_inverse=True)[1].astype(np.int64)
    h = 1
    while True:
        pair = rank * (n + 1)
        pair[:-h or None] += rank[h:] + 1
        order = np.argsort(pair, kind="stable")
        ordered = pair[order]
        step = np.append(0, ordered[1:] != ordered[:-1]).cumsum()
        rank = np.empty(n, np.int64)
        rank[order] = step
        if step[-1] == n - 1 or h >= n:
            return order
        h *= 2


class FmIndex:
    """Compressed index of some unlike word sequences (numbers from 1 on);
    ``again`` marks those that stand in more than one place.  The sequences
    themselves are kept as the queries that stream through it."""

    def __init__(self, sequences: list[np.ndarray], again: np.ndarray):
        sizes = np.array([len(s) + 1 for s in sequences])
        self.first = np.cumsum(sizes) - sizes
        self.text = np.zeros(int(sizes.sum()), np.int32)
        for at, s in zip(self.first, sequences):
            self.text[at:at + len(s)] = s
        symbols = int(self.text.max()) + 1
        order = suffix_array(self.text)
        self.below = np.append(0, np.cumsum(np.bincount(self.text, minlength=symbols)))
        self.wavelet = WaveletMatrix(self.text[order - 1], symbols)  # -1: the last separator
        self.marks = Bits(np.repeat(again, sizes)[order])
        self.base = self.below[:-1] - self.wavelet.descend(np.arange(symbols), np.zeros(symbols, np.int64))

    def reach(self, end: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """Backward search from each end down to each stop, all at once: the
        place of the word whose addition leaves one occurrence, or stop - 1."""
        out = stop - 1
        lane, at = np.arange(len(end)), end.copy()
        lo, hi = np.zeros(len(end), np.int64), np.full(len(end), len(self.text))
        while len(lane):
            c = self.text[at]
            both = self.wavelet.descend(np.concatenate([c, c]), np.concatenate([lo, hi]))
            base = self.base[c]
            lo, hi = both[:len(c)] + base, both[len(c):] + base
            once = hi - lo + self.marks.rank(hi) - self.marks.rank(lo) < 2
            out[lane[once]] = at[once]
            live = ~once & (at > stop[lane])
            lane, at, lo, hi = lane[live], at[live] - 1, lo[live], hi[live]
        return out

    def repeated(self, which: np.ndarray, window: int) -> list[list[tuple[int, int]]]:
        """For each of these sequences, the word intervals of the windows that
        occur at least twice in the index.

        The undecided windows lo..hi shrink from both sides: a search from the
        first window's end that stops at j rules out windows lo..j; if it
        succeeds, one from the last window's end confirms those after its stop.
        """
        size = np.append(self.first[1:], len(self.text))[which] - self.first[which] - 1
        found: list[list[tuple[int, int]]] = [[] for _ in which]
        lane, begin = np.arange(len(which)), self.first[which]
        lo, hi = begin.copy(), begin + size - window
        lane = lane[hi >= lo]
        while len(lane):
            stop = self.reach(lo[lane] + window - 1, lo[lane])
            no = stop >= lo[lane]
            lo[lane[no]] = stop[no] + 1
            yes = lane[~no]
            stop = self.reach(hi[yes] + window - 1, lo[yes])
            for i, j in zip(yes.tolist(), stop.tolist()):
                if j < hi[i]:
                    found[i].append((int(j + 1 - begin[i]), int(hi[i] + window - begin[i])))
                    hi[i] = j
                else:
                    hi[i] -= 1
                if lo[i] <= hi[i]:  # the first window is known to be repeated
                    found[i].append((int(lo[i] - begin[i]), int(lo[i] + window - begin[i])))
                    lo[i] += 1
            lane = lane[lo[lane] <= hi[lane]]
        return found


def merge(spans) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def shard_spans(segments: list[tuple[bytes, bool]], window: int) -> list[list[tuple[int, int]]]:
    """Repeated intervals of each distinct segment (its text, whether it occurs
    more than once as a whole), by an index over all of them."""
    numbers: dict[bytes, int] = {}
    coded = [np.array([numbers.setdefault(w, len(numbers) + 1) for w in text.split(b" ")]) for text, _ in segments]
    index = FmIndex(coded, np.array([again for _, again in segments], bool))
    return [merge(spans) for spans in index.repeated(np.arange(len(segments)), window)]


# --- Spark ------------------------------------------------------------------

def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """docs with ``__row``, a 64-bit hash that names a row's id and text.  Equal
    rows share it: they have equal results, and each counts as a place."""
    return docs.withColumn("__row", F.xxhash64(F.col(id_col).cast("string"), F.col(id_col).isNull(), F.col(text_col).cast("string")))


def together(key: np.ndarray, content: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by key and content, and where in it a new key and a new content begin."""
    order = np.lexsort((content, key))
    k, c = key[order], content[order]
    new_key = np.append(True, k[1:] != k[:-1]) if len(k) else np.zeros(0, bool)
    return order, new_key, new_key | np.append(True, c[1:] != c[:-1]) if len(k) else new_key


BLOBS = (("key", np.int64), ("content", np.int64), ("row", np.int64), ("a", np.int32), ("b", np.int32), ("flag", np.uint8),
         ("skey", np.int64), ("scontent", np.int64), ("srow", np.int64), ("sa", np.int32), ("sb", np.int32))
SEGMENT = "__row long, a int, b int, key long, content long, hot boolean, again boolean, need boolean, place boolean"
AGAIN, TWICE = 1, 2


def sort_out(rows: DataFrame, window: int, gram: int, n_parts: int, hot_key: int) -> DataFrame:
    """Segments (row, a, b, key, content, hot, again, need, place) that repeat
    or may hold repeated windows; key and content name equal ones.  ``need``:
    the one of them that goes to the index, ``again`` if it stands elsewhere
    too; ``place``: a row for each place.  A segment leaves its task in blocks
    by bucket, equal ones once, so a passage that stands everywhere is
    compared as a row for each task."""
    buckets = 8 * n_parts
    block = pa.schema([("bucket", pa.int32()), *((n, pa.binary()) for n, _ in BLOBS)])
    result = pa.schema([("__row", pa.int64()), ("a", pa.int32()), ("b", pa.int32()), ("key", pa.int64()), ("content", pa.int64()),
                        *((n, pa.bool_()) for n in ("hot", "again", "need", "place"))])

    def emit(batches):
        held: list[tuple] = []
        size = 0

        def close():
            row, key, content, a, b, twice = (np.concatenate(x) for x in zip(*held))
            held.clear()
            order, _, new = together(key, content)
            of = np.cumsum(new) - 1
            many = np.bincount(of) > 1
            first = order[new]
            flag = (many * AGAIN + twice[first] * TWICE).astype(np.uint8)
            sent = [x[first] for x in (key, content, row, a.astype(np.int32), b.astype(np.int32))] + [flag]
            again = order[many[of]]
            done = [x[again] for x in (key, content, row, a.astype(np.int32), b.astype(np.int32))]
            out = []
            for columns, place in ((sent, (key[first].view(np.uint64) >> np.uint64(20)).astype(np.int64) % buckets), (done, row[again] % buckets)):
                turn = np.argsort(place, kind="stable")
                cut = np.searchsorted(place[turn], np.arange(buckets + 1))
                out.append(([x[turn] for x in columns], cut))
            (sent, x), (done, y) = out
            rows = [(i, *(c[x[i]:x[i + 1]].tobytes() for c in sent), *(c[y[i]:y[i + 1]].tobytes() for c in done))
                    for i in range(buckets) if x[i] < x[i + 1] or y[i] < y[i + 1]]
            return batch(block, *zip(*rows))

        for x in batches:
            got = runs(*hashed_words(raw(x.column(1))), window, gram)
            if len(got[0]):
                held.append((x.column(0).to_numpy()[got[0]], *got[1:]))
                size += len(got[0])
            if size >= 400_000:
                yield close()
                size = 0
        if size:
            yield close()

    def gather(batches):
        parts: dict[int, list[tuple]] = {}
        for x in batches:
            for i, *blobs in zip(*(c.to_pylist() for c in x.columns)):
                parts.setdefault(i, []).append(blobs)
        while parts:
            _, blobs = parts.popitem()
            key, content, row, a, b, flag, *done = (np.frombuffer(b"".join(y), t) for y, (_, t) in zip(zip(*blobs), BLOBS))
            order, new_key, new = together(key, content)
            key, content, row, a, b, flag = key[order], content[order], row[order], a[order], b[order], flag[order]
            segment, name = np.cumsum(new) - 1, np.cumsum(new_key) - 1
            local = flag & AGAIN > 0
            start = np.flatnonzero(new)
            many = (np.bincount(segment, minlength=len(start)) > 1) | local[start] if len(start) else np.zeros(0, bool)
            if len(start):
                many |= np.logical_or.reduceat(local, start)
            own_key = name[start]
            single = ~many
            kinds = np.bincount(own_key, minlength=1)
            # a single segment is searched if its key has another, or occurs in it twice
            need = many | single & ((kinds[own_key] > 1) | (flag[start] & TWICE > 0))
            hot = np.bincount(own_key, need, len(kinds)) >= hot_key
            pick = start[need]
            whole = np.flatnonzero(many[segment] & ~local)
            n, w, d = len(pick), len(whole), len(done[0])
            yield batch(result, *(np.concatenate([x[pick], x[whole], y]) for x, y in zip((row, a, b, key, content), (*done[2:], *done[:2]))),
                        np.concatenate([hot[own_key[need]], np.zeros(w + d, bool)]), np.concatenate([many[need], np.ones(w + d, bool)]),
                        np.concatenate([np.ones(n, bool), np.zeros(w + d, bool)]), np.concatenate([single[need], np.ones(w + d, bool)]))

    sent = rows.select("__row", "__text").mapInArrow(emit, "bucket int, " + ", ".join(f"{n} binary" for n, _ in BLOBS))
    return sent.repartition(n_parts, "bucket").mapInArrow(gather, SEGMENT)


def search_shards(texts: DataFrame, window: int, n_parts: int, index_words: int) -> DataFrame:
    """(key, content, f, t): repeated intervals of segments (shard, key,
    content, a, again, text; the text's first word is the segment's a-th), by
    an index over a shard's distinct texts."""
    schema = pa.schema([("key", pa.int64()), ("content", pa.int64()), ("f", pa.int64()), ("t", pa.int64())])

    def search(batches):
        held: list[tuple] = []
        words = 0

        def close():
            # equal windows of a hot key may come from several segments
            place: dict[bytes, int] = {}
            texts: list[list] = []
            for *_, again, text in held:
                i = place.setdefault(text, len(texts))
                if i == len(texts):
                    texts.append([text, again])
                else:
                    texts[i][1] = True
            spans = shard_spans([tuple(x) for x in texts], window)
            out = [(key, content, a + f, a + t) for _, key, content, a, _, text in held for f, t in spans[place[text]]]
            held.clear()
            return batch(schema, *zip(*out)) if out else None

        for x in batches:
            for r in zip(*(c.to_pylist() for c in x.columns)):
                if words >= index_words and held[-1][0] != r[0]:
                    if (out := close()) is not None:
                        yield out
                    words = 0
                held.append(r)
                words += r[-1].count(b" ") + 1
        if held and (out := close()) is not None:
            yield out

    dealt = texts.repartition(n_parts, "shard").sortWithinPartitions("shard")
    return dealt.select("shard", "key", "content", "a", "again", "text").mapInArrow(search, "key long, content long, f long, t long")


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM,
                   hot_key: int = HOT_KEY, index_words: int = INDEX_WORDS) -> DataFrame:
    """(__row, __spans): the word intervals of each text that repeated windows
    cover; one row for each text that has any."""
    spark = docs.sparkSession
    bounded_batches(spark)
    n_parts = partitions(spark)
    rows = keyed(docs, id_col, text_col).select("__row", F.col(text_col).cast("string").alias("__text"))
    found = staged(sort_out(rows, window, gram, n_parts, hot_key), "segments")
    asked = found.filter("need").groupBy("__row").agg(F.collect_set(F.struct("a", "b", "key", "content", "hot", "again")).alias("__runs"))
    schema = pa.schema([("shard", pa.int64()), ("key", pa.int64()), ("content", pa.int64()), ("a", pa.int64()), ("again", pa.bool_()), ("text", pa.binary())])

    def fetch(batches):
        import xxhash

        last = None
        for x in batches:
            out = []
            for row, text, parts in zip(x.column(0).to_pylist(), raw(x.column(1)), x.column(2).to_pylist()):
                if row == last:  # an equal row; its segments are marked
                    continue
                last, words = row, text.split()
                for p in parts:
                    name = p["key"], p["content"]
                    if p["hot"]:
                        for i in range(p["a"], p["b"] + 1):
                            part = b" ".join(words[i:i + window])
                            out.append((xxhash.xxh3_64_intdigest(part) - 2**63, *name, i - p["a"], p["again"], part))
                    else:
                        out.append((p["key"], *name, 0, p["again"], b" ".join(words[p["a"]:p["b"] + window])))
                if len(out) >= 20_000:
                    yield batch(schema, *zip(*out))
                    out = []
            if out:
                yield batch(schema, *zip(*out))

    one = rows.join(asked, "__row").select("__row", "__text", "__runs")
    texts = one.mapInArrow(fetch, "shard long, key long, content long, a long, again boolean, text binary")
    searched = search_shards(texts, window, n_parts, index_words).groupBy("key", "content").agg(F.collect_set(F.struct("f", "t")).alias("spans"))
    placed = found.filter("place").select("__row", "a", "key", "content").join(searched, ["key", "content"])
    moved = placed.select("__row", F.explode(F.transform("spans", lambda s: F.struct((s["f"] + F.col("a")).alias("f"), (s["t"] + F.col("a")).alias("t")))).alias("s"))
    return moved.groupBy("__row").agg(F.collect_list("s").alias("__spans"))


def cut_words(text: bytes | None, spans) -> tuple[list[bytes], int, int]:
    """(words left, words, words removed)."""
    words = (text or b"").split()
    gone = merge((s["f"], s["t"]) for s in spans or ())
    if not gone:
        return words, len(words), 0
    left, at = [], 0
    for a, b in gone:
        left += words[at:a]
        at = b
    left += words[at:]
    return left, len(words), len(words) - len(left)


def dedup_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, **limits) -> DataFrame:
    """One row per document: id, n_words, n_removed, kept_text.

    A null text has no words; fewer words than a window are never removed.
    Equal rows are different places, so their windows are repeated; a null id
    stays null; extra columns are ignored; an empty table gives an empty result.
    """
    spans = repeated_spans(docs, id_col, text_col, window, **limits)
    rows = keyed(docs, id_col, text_col).select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"), "__row")
    joined = rows.join(spans, "__row", "left").select("_id", "_text", "__spans")

    def run(batches):
        for b in batches:
            got = [cut_words(t, s) for t, s in zip(b.column(1).cast(pa.binary()).to_pylist(), b.column(2).to_pylist())]
            schema = pa.schema([("_id", b.column(0).type), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_text", pa.binary())])
            yield batch(schema, b.column(0), [n for _, n, _ in got], [r for _, _, r in got], [b" ".join(w) for w, _, _ in got])

    kind = rows.schema["_id"].dataType.simpleString()
    return joined.mapInArrow(run, f"_id {kind}, n_words long, n_removed long, kept_text binary").withColumnRenamed("_id", id_col)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chars_col: str | None = "n_chars", window: int = WINDOW, **limits) -> DataFrame:
    """The documents (all their columns) without the words that repeated
    windows cover.  A text that loses words becomes its kept words joined by
    one space, with ``chars_col`` its length; a document that loses all its
    words goes; others stay as they are."""
    at = docs.columns.index(text_col)
    chars = docs.columns.index(chars_col) if chars_col in docs.columns else None
    given, id_col, text_col = docs.columns, f"c{docs.columns.index(id_col)}", f"c{at}"
    docs = docs.toDF(*[f"c{k}" for k in range(len(given))])     # names of our own can't clash with the input's
    names = docs.columns
    spans = repeated_spans(docs, id_col, text_col, window, **limits)
    joined = keyed(docs, id_col, text_col).join(spans, "__row", "left").select(*names, "__spans")

    def run(batches):
        for b in batches:
            spans = b.column(len(names)).to_pylist()
            columns = b.columns[:len(names)]
            texts, sizes = columns[at].to_pylist(), columns[chars].to_pylist() if chars is not None else None
            keep = []
            for i, s in enumerate(spans):
                if s:
                    words, _, _ = cut_words(texts[i].encode("utf-8", "replace"), s)
                    texts[i] = b" ".join(words).decode("utf-8", "replace")
                    if sizes is not None:
                        sizes[i] = len(texts[i])
                keep.append(not s or bool(texts[i]))
            columns[at] = pa.array(texts, columns[at].type)
            if sizes is not None:
                columns[chars] = pa.array(sizes, columns[chars].type)
            yield pa.RecordBatch.from_arrays(columns, names=list(names)).filter(pa.array(keep, pa.bool_()))

    return joined.mapInArrow(run, docs.schema).toDF(*given)


def op2_substring_dedup(spark, sf_dir: str) -> DataFrame:
    d = dedup_report(table(spark, sf_dir, "documents"))
    return d.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


OP2_SQL = r"""
WITH words AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + 34], ' ')) AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM words WHERE len(w) >= 35)
), twice AS (SELECT s FROM windows GROUP BY 1 HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS j FROM windows SEMI JOIN twice USING (s)),
lost AS (SELECT doc_id, list(j) AS js, count(*) AS n_removed FROM gone GROUP BY 1),
every AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS j FROM words),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY j) AS t FROM every ANTI JOIN gone USING (doc_id, j) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM words LEFT JOIN lost USING (doc_id) LEFT JOIN kept USING (doc_id)
"""
