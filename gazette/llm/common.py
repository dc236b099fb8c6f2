"""Shared helpers: bounded Arrow batches, byte words, cached tokenizing, scratch tables."""

from __future__ import annotations

import json
import os
import tempfile
import uuid
import zipfile
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gazette.session import scratch_path

#: End-of-document token id of every token stream written here.
END_ID = 1
TOKENIZER_FILE = "word_bpe_49k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per application, so they need
    no installation of it.  Spark serves the file from the driver."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    out = os.path.join(tempfile.mkdtemp(prefix="gazette-ship-"), "gazette.zip")
    with zipfile.ZipFile(out, "w") as z:
        for folder, _, names in os.walk(os.path.join(root, "gazette")):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, root))
    sc.addPyFile(out)
    _SHIPPED.add(sc.applicationId)


def bounded_batches(spark: SparkSession, rows: int = 1000, size: str = "8m") -> None:
    """Bound the Arrow batches that Python workers hold: by rows and, where
    this Spark version knows the setting, by bytes.  A value that the user
    set to less stays.  Also ships the package: every operator with Python
    tasks calls this."""
    ship(spark)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key, "10000"))
    if now <= 0 or now > rows:
        spark.conf.set(key, str(rows))
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(key, None)
    in_bytes = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    if now is not None and not 0 < in_bytes(now) <= in_bytes(size):
        spark.conf.set(key, size)


def partitions(spark: SparkSession, factor: int = 1) -> int:
    """Number of shuffle partitions that the session asks for, times factor."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")) * factor)


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below the shared checkpoint folder.  The local fallback
    counts in local mode only (``scratch_path`` refuses it on a cluster)."""
    return scratch_path(spark, f"llm-{name}-{uuid.uuid4().hex}", fallback="/tmp/gazette-llm-checkpoints")


def staged(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back: a lineage
    cut that survives lost executors and is computed once.  ``by``: a column
    with few values, each of which gets a folder of its own."""
    path = scratch(df.sparkSession, name)
    (df.write.partitionBy(by) if by else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def id_and_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the two columns an operator needs, under names of its own, so
    extra columns of the input can't clash with the output's."""
    return docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))


def raw(column: pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of a string column."""
    return column.cast(pa.binary()).to_pylist()


def batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, type=f.type) for c, f in zip(columns, schema)], schema=schema)


def tokenizer_path(name: str = TOKENIZER_FILE) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


SPACE, ALNUM, STOP, OTHER = range(4)
BYTE_KIND = np.full(256, OTHER, np.uint8)
BYTE_KIND[list(b" \t\n\r\x0b\x0c")] = SPACE
BYTE_KIND[list(b"abcdefghijklmnopqrstuvwxyz0123456789")] = ALNUM
BYTE_KIND[list(b".,")] = STOP


def distinct_words(texts: list[bytes | None]) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The words of some texts in a row, A-Z in lower case, coded by their
    distinct values, and each text's number of words.  Words are parted by
    ASCII white space; a stop or comma after a letter or digit is a new word."""
    sizes = np.fromiter((len(t or b"") for t in texts), np.int64, len(texts))
    data = np.frombuffer(b"".join(t or b"" for t in texts).lower(), np.uint8)
    kind = BYTE_KIND[data]
    end = np.cumsum(sizes)
    word = kind != SPACE
    begins = word.copy()
    begins[1:] &= (kind[:-1] == SPACE) | (kind[1:] == STOP) & (kind[:-1] == ALNUM)
    edge = (end - sizes)[sizes > 0]
    begins[edge] = word[edge]
    first = np.flatnonzero(begins)
    offsets = np.append(np.cumsum(word)[first] - 1, word.sum()).astype(np.int64)
    every = pa.Array.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(data[word])])
    return every.dictionary_encode(), np.diff(np.searchsorted(first, end), prepend=0)


def hashed_words(texts: list[bytes | None], fold: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of some texts in a row, and each text's number
    of words; ``fold`` puts A-Z in lower case."""
    import xxhash

    words = [((t or b"").lower() if fold else t or b"").split() for t in texts]
    counts = np.fromiter(map(len, words), np.int64, len(words))
    return np.fromiter(map(xxhash.xxh3_64_intdigest, chain.from_iterable(words)), np.uint64, int(counts.sum())), counts


class WordTokenizer:
    """Token ids of whole texts, as one library call would give them, with one
    call per distinct word.

    The vocabulary drops white space, folds case and never joins characters
    across white space, so a text's ids are those of its words, one after the
    other; a letter or digit and a stop or comma after it never join either.
    Words are cached up to ``max_words`` words or ``max_ids`` ids (then the cache
    starts anew), longer ones than ``max_bytes`` are encoded each time.  Words
    that the normalizer would not change, or the splitter not split, go to copies
    of the tokenizer without these steps.  A text that holds one of the
    vocabulary's added tokens, such as ``<|endoftext|>``, goes to the unchanged
    tokenizer as a whole, which gives these tokens their own ids.
    """

    def __init__(self, path: str, max_words: int = 250_000, max_bytes: int = 48, max_ids: int = 4_000_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tok, self.plain = Tokenizer.from_file(path), Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            bare = json.load(f) | {"normalizer": None}
        self.added = [t["content"].encode() for t in bare["added_tokens"]]
        steps = [x for x in bare["pre_tokenizer"]["pretokenizers"] if x["type"] != "Split"]
        self.bare = Tokenizer.from_str(json.dumps(bare))
        self.letters = Tokenizer.from_str(json.dumps(bare | {"pre_tokenizer": {"type": "Sequence", "pretokenizers": steps}}))
        for t in (self.tok, self.bare, self.letters):
            t.encode_special_tokens = True
        self.max_words, self.max_bytes, self.max_ids = max_words, max_bytes, max_ids
        self._reset()

    def _reset(self) -> None:
        self.codes: dict[bytes, int] = {}
        self.flat = np.empty(1 << 16, np.uint32)
        self.begin = np.zeros(1 << 14, np.int64)
        self.size = np.zeros(1 << 14, np.int64)
        self.used = self.count = 0

    def _add(self, words: list[bytes]) -> None:
        texts = b"\n".join(words).decode("utf-8", "replace").split("\n")
        letters, plain, other = [], [], []
        for w, s in zip(words, texts):
            if s.isalpha() and (s.isascii() or max(s) < "\u0250" and s == s.lower()):
                letters.append((w, s))  # lower case up to U+024F has a fixed normal form
            elif s.isascii():
                plain.append((w, s))
            else:
                other.append((w, s))
        for tok, part in ((self.letters, letters), (self.bare, plain), (self.tok, other)):
            if not part:
                continue
            got = tok.encode([s for _, s in part], is_pretokenized=True, add_special_tokens=False)
            n = np.bincount(np.array(got.word_ids, np.int64), minlength=len(part))
            total = len(got.ids)
            while self.used + total > len(self.flat):
                self.flat = np.resize(self.flat, 2 * len(self.flat))
            while self.count + len(part) > len(self.begin):
                self.begin, self.size = np.resize(self.begin, 2 * len(self.begin)), np.resize(self.size, 2 * len(self.size))
            self.flat[self.used:self.used + total] = got.ids
            self.begin[self.count:self.count + len(part)] = self.used + np.cumsum(n) - n
            self.size[self.count:self.count + len(part)] = n
            self.codes.update(zip([w for w, _ in part], range(self.count, self.count + len(part))))
            self.used, self.count = self.used + total, self.count + len(part)

    def encode(self, texts: list[bytes | None], end_id: int | None = END_ID) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and each text's number of ids
        (null counts as empty; ``end_id`` follows every text)."""
        own = {i for i, t in enumerate(texts) if t and any(a in t for a in self.added)}
        if not own:
            return self._by_words(texts, end_id)
        ids, lengths = self._by_words([None if i in own else t for i, t in enumerate(texts)], end_id)
        parts = np.split(ids, np.cumsum(lengths)[:-1])
        for i in own:
            whole = self.plain.encode(texts[i].decode("utf-8", "replace"), add_special_tokens=False).ids
            parts[i] = np.concatenate([np.array(whole, np.uint32), parts[i]])
        return np.concatenate(parts), np.fromiter(map(len, parts), np.int64, len(parts))

    def _by_words(self, texts: list[bytes | None], end_id: int | None) -> tuple[np.ndarray, np.ndarray]:
        if self.count > self.max_words or self.used > self.max_ids:
            self._reset()
        every, per_doc = distinct_words(texts)
        distinct = every.dictionary.to_pylist()
        codes = self.codes
        own = np.fromiter(map(codes.get, distinct, repeat(-1)), np.int64, len(distinct))
        absent = np.flatnonzero(own < 0)
        missing = [distinct[i] for i in absent.tolist()]
        if missing:
            self._add(missing)
            own[absent] = np.fromiter(map(codes.__getitem__, missing), np.int64, len(missing))
        flat = own[every.indices.to_numpy()]
        sizes = self.size[flat]
        ends = np.cumsum(sizes)
        index = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(self.begin[flat] - (ends - sizes), sizes)
        ids = self.flat[index]
        word_end = np.cumsum(per_doc)
        upto = np.concatenate([[0], ends])[word_end]
        lengths = np.diff(upto, prepend=0)
        if end_id is not None:
            ids = np.insert(ids, upto, end_id)
            lengths = lengths + 1
        for w in missing:
            if len(w) > self.max_bytes:
                del codes[w]
        return ids.astype(np.uint32, copy=False), lengths


_TOKENIZERS: dict[str, WordTokenizer] = {}


def word_tokenizer(path: str) -> WordTokenizer:
    """One tokenizer and word cache for each Python worker."""
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordTokenizer(path)
    return _TOKENIZERS[path]
