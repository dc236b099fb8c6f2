"""Token ids in patched frame-of-reference blocks.

A token file is a Parquet file of segments; a segment's payload is one binary
image: header, document table, index of block starts, blocks.  A block holds
BLOCK ids: the block's minimum is subtracted, the differences are packed at
the width that holds ``percentile`` of them, and those that don't fit follow
in an exception list (position, difference).  Integers are little-endian.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gazette.llm.common import (END_ID, batch, bounded_batches, id_and_text, partitions, raw, scratch, table, tokenizer_path,
                                word_tokenizer)

MAGIC = b"PFR1"
HEAD = struct.Struct("<4sIIQI")  # magic, block size, documents, ids, blocks
BLOCK = 512
PERCENTILE = 90
BLOCK_HEAD = np.dtype([("low", "<u4"), ("width", "u1"), ("pad", "u1"), ("exceptions", "<u2")])


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """(rows, n) unsigned differences, n a multiple of 64 -> (rows, n * width / 8) bytes."""
    rows, n = values.shape
    lanes = np.ascontiguousarray(values.reshape(rows * (n // 64), 64).T.astype(np.uint64))
    out = np.zeros((width, lanes.shape[1]), np.uint64)
    for i in range(64):
        word, shift = divmod(i * width, 64)
        out[word] |= lanes[i] << np.uint64(shift)
        if shift + width > 64:
            out[word + 1] |= lanes[i] >> np.uint64(64 - shift)
    return np.ascontiguousarray(out.T).astype("<u8").view(np.uint8).reshape(rows, n * width // 8)


def _unpack(data: np.ndarray, width: int, n: int) -> np.ndarray:
    rows = data.shape[0]
    words = np.ascontiguousarray(np.ascontiguousarray(data).view("<u8").reshape(rows * (n // 64), width).T)
    out = np.empty((64, words.shape[1]), np.uint32)
    mask = np.uint64((1 << width) - 1)
    for i in range(64):
        word, shift = divmod(i * width, 64)
        got = words[word] >> np.uint64(shift)
        if shift + width > 64:
            got = got | words[word + 1] << np.uint64(64 - shift)
        out[i] = got & mask
    return np.ascontiguousarray(out.T).reshape(rows, n)


def encode_blocks(ids: np.ndarray, block: int = BLOCK, percentile: int = PERCENTILE) -> tuple[np.ndarray, bytes]:
    """(start of each block, bytes of all blocks)."""
    n = -(-len(ids) // block)
    if not n:
        return np.zeros(0, np.uint32), b""
    cells = np.full(n * block, ids[-1], np.uint32)
    cells[:len(ids)] = ids
    cells = cells.reshape(n, block)
    low = cells.min(axis=1)
    diff = cells - low[:, None]
    at = min(block - 1, block * percentile // 100)
    top = np.partition(diff, at, axis=1)[:, at]
    width = np.where(top > 0, np.floor(np.log2(np.maximum(top, 1).astype(np.float64))).astype(np.int64) + 1, 0)
    over = (diff.astype(np.uint64) >> width.astype(np.uint64)[:, None]) > 0
    head = np.zeros(n, BLOCK_HEAD)
    head["low"], head["width"], head["exceptions"] = low, width, over.sum(axis=1)
    parts: list[list[bytes]] = [[b""] * 3 for _ in range(n)]
    for w in np.unique(width):
        rows = np.flatnonzero(width == w)
        if w:
            packed = _pack(np.where(over[rows], 0, diff[rows]), int(w))
            for r, p in zip(rows, packed):
                parts[r][0] = p.tobytes()
    row, pos = np.nonzero(over)
    far = diff[row, pos].astype("<u4")
    pos = pos.astype("<u2")
    cut = np.concatenate([[0], np.cumsum(head["exceptions"].astype(np.int64))])
    for r in np.flatnonzero(head["exceptions"]):
        parts[r][1], parts[r][2] = pos[cut[r]:cut[r + 1]].tobytes(), far[cut[r]:cut[r + 1]].tobytes()
    out = [head[r].tobytes() + b"".join(p) for r, p in enumerate(parts)]
    sizes = np.fromiter(map(len, out), np.int64, n)
    return (np.cumsum(sizes) - sizes).astype(np.uint32), b"".join(out)


def decode_blocks(starts: np.ndarray, data: np.ndarray, block: int) -> np.ndarray:
    """(blocks, block) ids of the blocks that begin at ``starts``."""
    if not len(starts):
        return np.zeros((0, block), np.uint32)
    starts = starts.astype(np.int64)
    head = data[starts[:, None] + np.arange(BLOCK_HEAD.itemsize)].view(BLOCK_HEAD)[:, 0]
    width = head["width"].astype(np.int64)
    out = np.zeros((len(starts), block), np.uint32)
    body = starts + BLOCK_HEAD.itemsize
    for w in np.unique(width):
        if w:
            rows = np.flatnonzero(width == w)
            size = block * int(w) // 8
            out[rows] = _unpack(data[body[rows, None] + np.arange(size)], int(w), block)
    for r in np.flatnonzero(head["exceptions"]):
        n, at = int(head["exceptions"][r]), int(body[r] + block * width[r] // 8)
        pos = data[at:at + 2 * n].view("<u2")
        out[r, pos] = np.ascontiguousarray(data[at + 2 * n:at + 6 * n]).view("<u4")
    return out + head["low"][:, None]


def encode_segment(doc_ids: list, lengths: np.ndarray, ids: np.ndarray, block: int = BLOCK, percentile: int = PERCENTILE) -> bytes:
    """Binary image of some documents: header; per document a null flag, its
    id (long) and its number of ids (unsigned int); block starts; blocks."""
    starts, blocks = encode_blocks(ids, block, percentile)
    null = np.array([d is None for d in doc_ids], np.uint8)
    own = np.array([d or 0 for d in doc_ids], "<i8")
    return b"".join([HEAD.pack(MAGIC, block, len(doc_ids), len(ids), len(starts)), null.tobytes(), own.tobytes(),
                     lengths.astype("<u4").tobytes(), starts.astype("<u4").tobytes(), blocks])


class Segment:
    """Reader of one image; ``ids(i, j)`` unpacks only the blocks that it touches."""

    def __init__(self, image: bytes):
        magic, self.block, docs, self.n_ids, blocks = HEAD.unpack_from(image)
        if magic != MAGIC:
            raise ValueError("not a token segment")
        at = HEAD.size
        null = np.frombuffer(image, np.uint8, docs, at)
        own = np.frombuffer(image, "<i8", docs, at + docs)
        self.doc_ids = [None if z else int(d) for z, d in zip(null, own)]
        self.lengths = np.frombuffer(image, "<u4", docs, at + 9 * docs).astype(np.int64)
        self.starts = np.frombuffer(image, "<u4", blocks, at + 13 * docs)
        self.data = np.frombuffer(image, np.uint8, offset=at + 13 * docs + 4 * blocks)

    def ids(self, begin: int = 0, end: int | None = None) -> np.ndarray:
        end = self.n_ids if end is None else min(end, self.n_ids)
        if end <= begin:
            return np.zeros(0, np.uint32)
        first = begin // self.block
        cells = decode_blocks(self.starts[first:-(-end // self.block)], self.data, self.block).reshape(-1)
        return cells[begin - first * self.block:end - first * self.block]


def write_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None,
                 end_id: int = END_ID, n_files: int | None = None, segment_ids: int = 1 << 20) -> None:
    """Encode every whole text and write token files in ascending id order.

    The documents are range-partitioned by id (nulls first, equal ids in any
    order), so each task writes one file; a segment closes at ``segment_ids``
    ids, at a document's end.  Null text is empty: the document holds only
    ``end_id``.  Spark's commit protocol leaves one attempt's file per task.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    tokenizer = tokenizer or tokenizer_path()
    rows = id_and_text(docs, id_col, text_col).select(F.col("_id").cast("long").alias("_id"), "_text")
    rows = rows.repartitionByRange(n_files or partitions(spark), "_id").sortWithinPartitions("_id")
    schema = pa.schema([("file_no", pa.int32()), ("segment_no", pa.int32()), ("n_docs", pa.int64()), ("n_ids", pa.int64()),
                        ("payload", pa.binary())])

    def run(batches):
        from pyspark import TaskContext

        part, no, tok = TaskContext.get().partitionId(), 0, word_tokenizer(tokenizer)
        held: tuple[list, list, list] = ([], [], [])

        def close():
            nonlocal no
            ids, lengths = np.concatenate(held[2]), np.concatenate(held[1])
            out = batch(schema, [part], [no], [len(held[0])], [len(ids)], [encode_segment(held[0], lengths, ids)])
            no += 1
            for x in held:
                x.clear()
            return out

        size = 0
        for b in batches:
            if not b.num_rows:
                continue
            ids, lengths = tok.encode(raw(b.column(1)), end_id)
            held[0].extend(b.column(0).to_pylist())
            held[1].append(lengths)
            held[2].append(ids)
            size += len(ids)
            if size >= segment_ids:
                yield close()
                size = 0
        if held[0]:
            yield close()

    rows.mapInArrow(run, "file_no int, segment_no int, n_docs long, n_ids long, payload binary").write.parquet(path)


def read_tokens(spark, path: str) -> DataFrame:
    """Documents of token files: doc_id, start (ids of all documents before
    it), n_tokens, ids_crc32, decoded from the blocks.  Offsets come from the
    files' totals: one row per file, summed once, never a row per document."""
    segments = spark.read.parquet(path)
    schema = pa.schema([("file_no", pa.int32()), ("segment_no", pa.int32()), ("doc_id", pa.int64()), ("local_start", pa.int64()),
                        ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def run(batches):
        for b in batches:
            for part, no, image in zip(*(b.column(i).to_pylist() for i in range(3))):
                s = Segment(image)
                ids = np.ascontiguousarray(s.ids(), "<u4")
                ends = np.cumsum(s.lengths)
                crc = [zlib.crc32(ids[e - n:e]) for e, n in zip(ends.tolist(), s.lengths.tolist())]
                k = len(crc)
                yield batch(schema, [part] * k, [no] * k, s.doc_ids, ends - s.lengths, s.lengths, crc)

    docs = segments.select("file_no", "segment_no", "payload").mapInArrow(
        run, "file_no int, segment_no int, doc_id long, local_start long, n_tokens long, ids_crc32 long")
    before = Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("file_no").orderBy("segment_no").rowsBetween(Window.unboundedPreceding, -1)
    files = segments.groupBy("file_no").agg(F.sum("n_ids").alias("n")).select("file_no", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_file"))
    places = segments.select("file_no", "segment_no", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)).alias("_seg")).join(files, "file_no")
    return docs.join(places, ["file_no", "segment_no"]).select(
        "doc_id", (F.col("_file") + F.col("_seg") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32")


def op8_token_binary(spark, sf_dir: str) -> DataFrame:
    path = scratch(spark, "tokens")
    write_tokens(table(spark, sf_dir, "documents"), path)
    return read_tokens(spark, path)
