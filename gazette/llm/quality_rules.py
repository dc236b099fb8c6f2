"""Quality rules by compression bands.

zstandard ratios (compressed bytes / bytes) of the whole text and of its
fixed chunks must lie inside limits that depend on the text's length:
repetitive text falls below, encoded or random text rises above.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gazette.llm.common import batch, bounded_batches, id_and_text

#: (length in bytes below which it holds, least ratio, greatest ratio).  Short
#: frames carry overhead and little context, long ones compress better.
BANDS = (
    (64, 0.60, 2.50),
    (128, 0.45, 1.40),
    (256, 0.38, 1.10),
    (512, 0.38, 0.95),
    (1024, 0.36, 0.85),
    (4096, 0.34, 0.78),
    (16384, 0.30, 0.74),
    (65536, 0.26, 0.72),
    (None, 0.20, 0.72),
)
CHUNK = 1024
CHUNK_BAND = (0.30, 0.80)
#: Share of chunks outside the band from which the text is rejected.
CHUNK_SHARE = 0.20
SPACES, SYMBOLS = b" \t\n\r\x0b\x0c", b"#*$%&|<>"
RESULT = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, ratio double, n_chunks long, n_chunks_out long, kept boolean"


def repeat_words(words: list[bytes], width: int = 5) -> int:
    """Words inside ``width``-word windows that occur at least twice."""
    n = len(words) - width + 1
    if n < 2 or len(set(zip(*(words[i:] for i in range(width))))) == n:
        return 0
    seen = Counter(zip(*(words[i:] for i in range(width))))
    total = last = 0
    for i, w in enumerate(zip(*(words[i:] for i in range(width)))):
        if seen[w] > 1:
            total += i + width - max(i, last)
            last = i + width
    return total


def duplicate_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split(b"\n") if x.strip()]
    return len(lines) - len(set(lines))


def band_verdict(text: bytes, compress, bands=BANDS, chunk: int = CHUNK, chunk_band=CHUNK_BAND,
                 chunk_share: float = CHUNK_SHARE) -> tuple[float, int, int, bool]:
    """(ratio, chunks, chunks outside the band, passes) of one text.

    Chunks cover every byte: the full ones and, where bytes are left, a last
    one of the same size that ends at the text's end.  A text shorter than a
    chunk is one chunk, held against the limits of its own length.  An empty
    text has ratio 0 and fails."""
    if not text:
        return 0.0, 0, 0, False
    ratio = len(compress(text)) / len(text)
    low, high = next((lo, hi) for limit, lo, hi in bands if limit is None or len(text) < limit)
    fits = low <= ratio <= high
    if len(text) <= chunk:
        if len(text) == chunk:
            fits &= chunk_band[0] <= ratio <= chunk_band[1]
        return ratio, 1, int(not fits), fits
    view = memoryview(text)
    starts = [*range(0, len(text) - chunk + 1, chunk), *([len(text) - chunk] if len(text) % chunk else [])]
    out = sum(not chunk_band[0] <= len(compress(view[i:i + chunk])) / chunk <= chunk_band[1] for i in starts)
    return ratio, len(starts), out, fits and out <= chunk_share * len(starts)


def judge(text: bytes | None, compress, min_words: int, repeat_pct: int, **bands) -> tuple:
    text = text or b""
    words = text.split()
    n, repeated = len(words), repeat_words(words)
    spaces = len(text) - len(text.translate(None, SPACES))
    failed = n < min_words or 100 * repeated > repeat_pct * n
    ratio, chunks, out, fits = band_verdict(text, compress, **bands)
    points = len(text) if text.isascii() else len(text.decode("utf-8", "replace"))
    return (n, points - spaces, len(text) - len(text.translate(None, SYMBOLS)), duplicate_lines(text),
            repeated, failed, ratio, chunks, out, fits and not failed)


def _judge_all(min_words: int, repeat_pct: int, **bands):
    import zstandard

    compress = zstandard.ZstdCompressor(level=3).compress
    return lambda texts: [judge(t, compress, min_words, repeat_pct, **bands) for t in texts]


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 10,
                  repeat_pct: int = 20, **bands) -> DataFrame:
    """One row per document: counts, base rules, ratios and the verdict.

    Null text counts as empty: no words, so it fails.  Repeated rows and equal
    ids are judged row by row; a null id stays null; an empty table gives an
    empty result; other columns of the input are ignored.  Narrow: one scan, no
    shuffle, a task holds one bounded batch of texts.
    """
    bounded_batches(docs.sparkSession)
    rows = id_and_text(docs, id_col, text_col)
    id_type = rows.schema["_id"].dataType.simpleString()

    def run(batches):
        verdicts = _judge_all(min_words, repeat_pct, **bands)
        types = [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.int64(), pa.int64(), pa.bool_()]
        names = [x.split()[0] for x in RESULT.split(", ")]
        for b in batches:
            got = verdicts(b.column(1).cast(pa.binary()).to_pylist())
            schema = pa.schema([("_id", b.column(0).type), *zip(names, types)])
            yield batch(schema, b.column(0), *(zip(*got) if got else [[] for _ in names]))

    return rows.mapInArrow(run, f"_id {id_type}, {RESULT}").withColumnRenamed("_id", id_col)


def keep_good(docs: DataFrame, text_col: str = "text", min_words: int = 10, repeat_pct: int = 20, **bands) -> DataFrame:
    """The documents (all their columns) that pass; a filter inside the scan's
    tasks, so nothing is joined and clashing names don't matter."""
    bounded_batches(docs.sparkSession)
    at = docs.columns.index(text_col)

    def run(batches):
        verdicts = _judge_all(min_words, repeat_pct, **bands)
        for b in batches:
            texts = b.column(at).cast(pa.string()).cast(pa.binary()).to_pylist()
            yield b.filter(pa.array([v[-1] for v in verdicts(texts)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op9_quality_rules(spark, sf_dir: str) -> DataFrame:
    from gazette.llm.common import table

    d = quality_rules(table(spark, sf_dir, "documents"))
    return d.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
                    F.round("ratio", 9).alias("ratio"), "n_chunks", "n_chunks_out")
