"""Sequence packing as a cutting-stock problem solved by column generation.

Documents are cut into full sequences and one remainder.  Remainders are
planned in steps of ``grid`` tokens, short ones ``grid`` of a kind at a time: as
many pieces of one length as a step has tokens fill whole steps exactly.  The
histogram (at most ``capacity / grid`` bins, whatever the corpus) goes to the driver, where a linear program over filling patterns is solved: the
simplex basis gives prices, an unbounded knapsack over the prices gives the
pattern with the lowest reduced cost, until none improves.  The patterns'
counts are rounded down, what is left is filled by a bounded knapsack.  The
plan (a few thousand rows, bounded by the bins) goes to the tasks, where each
document's rank within its bin says which sequence and slot it takes.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gazette.llm.common import END_ID, batch, bounded_batches, id_and_text, raw, staged, table, tokenizer_path, word_tokenizer

CAPACITY = 2048
#: Remainders are planned in steps of GRID tokens, those of up to EXACT tokens in groups of GRID equal ones.
GRID, EXACT = 8, 64


def solve_patterns(demand: np.ndarray, cells: int, tolerance: float = 5e-4) -> tuple[np.ndarray, np.ndarray]:
    """Cutting stock: ``demand[i]`` pieces of size i + 1, stock of ``cells``.

    Returns (patterns, counts): patterns[:, j] pieces of each size, used
    counts[j] times (fractional), an LP optimum within ``tolerance`` of the
    bound that the prices prove.
    """
    sizes = np.flatnonzero(demand) + 1
    n = len(sizes)
    if not n:
        return np.zeros((len(demand), 0)), np.zeros(0)
    need = demand[sizes - 1].astype(np.float64)
    patterns = np.diag((cells // sizes).astype(np.float64))
    inverse = np.diag(1.0 / np.diag(patterns))
    counts = inverse @ need
    for _ in range(20 * n + 200):
        prices = inverse.sum(axis=0)
        value, column = price_column(prices, sizes, cells)
        if value <= 1 + tolerance:
            break
        step = inverse @ column
        with np.errstate(divide="ignore", invalid="ignore"):
            ratio = np.where(step > 1e-9, np.maximum(counts, 0) / step, np.inf)
        out = int(np.argmin(ratio))
        if not np.isfinite(ratio[out]):
            break
        counts = counts - ratio[out] * step
        counts[out] = ratio[out]
        pivot = inverse[out] / step[out]
        inverse -= np.outer(step, pivot)
        inverse[out] = pivot
        patterns[:, out] = column
    full = np.zeros((len(demand), n))
    full[sizes - 1] = patterns
    return full, np.maximum(counts, 0)


def price_column(prices: np.ndarray, sizes: np.ndarray, cells: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack: the most valuable pattern, by dynamic programming over the capacity."""
    best, took = np.zeros(cells + 1), np.full(cells + 1, -1)
    upto = np.searchsorted(sizes, np.arange(cells + 1), side="right")
    for c in range(1, cells + 1):
        k = upto[c]
        best[c] = best[c - 1]
        if k:
            values = best[c - sizes[:k]] + prices[:k]
            i = int(values.argmax())
            if values[i] > best[c] + 1e-12:
                best[c], took[c] = values[i], i
    column, c = np.zeros(len(sizes)), cells
    while c > 0:
        if took[c] < 0:
            c -= 1
        else:
            column[took[c]] += 1
            c -= sizes[took[c]]
    return float(best[cells]), column


def fill_rest(rest: np.ndarray, cells: int) -> list[np.ndarray]:
    """Patterns for the pieces that rounding leaves: each takes the largest
    piece, then the fullest set of the others (bounded knapsack)."""
    rest, out = rest.astype(np.int64).copy(), []
    while rest.sum():
        pattern = np.zeros(len(rest), np.int64)
        top = int(np.flatnonzero(rest)[-1])
        pattern[top] = 1
        rest[top] -= 1
        room = cells - (top + 1)
        reach = np.zeros(room + 1, bool)
        reach[0] = True
        came = np.full(room + 1, -1)
        for i in np.flatnonzero(rest[:room])[::-1]:
            for _ in range(min(int(rest[i]), room // (i + 1))):
                new = np.zeros_like(reach)
                new[i + 1:] = reach[:room - i]
                new &= ~reach
                if not new.any():
                    break
                came[new] = i
                reach |= new
            if reach[room]:
                break
        # ``came`` holds the piece that first reached a total; pieces along a path come in
        # falling size, each added on top of a state that existed before it
        c = int(np.flatnonzero(reach)[-1])
        while c > 0:
            i = int(came[c])
            pattern[i] += 1
            c -= i + 1
        rest -= np.minimum(pattern - (np.arange(len(rest)) == top), rest)
        out.append(pattern)
    return out


def plan(demand: np.ndarray, cells: int) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Rows (bin, first rank, first sequence, pieces a sequence, first slot)
    sorted by bin and rank, and the number of sequences.  Ranks of a bin are
    dealt to the patterns one after the other."""
    patterns, counts = solve_patterns(demand, cells)
    whole = np.floor(counts + 1e-7).astype(np.int64)
    used = (patterns @ whole).astype(np.int64)
    for j in np.argsort(whole):  # rounding noise must never use more pieces than there are
        while (used > demand).any() and whole[j] and (patterns[:, j] * (used > demand)).any():
            whole[j] -= 1
            used = (patterns @ whole).astype(np.int64)
    groups = [(patterns[:, j].astype(np.int64), int(whole[j])) for j in np.flatnonzero(whole)]
    groups += [(p, 1) for p in fill_rest(demand - used, cells)]
    rank, rows, sequence = np.zeros(len(demand), np.int64), [], 0
    for pattern, times in groups:
        slot = 0
        for i in np.flatnonzero(pattern)[::-1]:
            rows.append((int(i), int(rank[i]), sequence, int(pattern[i]), slot))
            slot += int(pattern[i])
            rank[i] += pattern[i] * times
        sequence += times
    return sorted(rows), sequence


def exact_length(capacity: int, grid: int) -> int:
    """Greatest length that is planned in groups (a group has as many steps as
    a piece has tokens, and fits a sequence)."""
    return min(EXACT, capacity // grid) if grid > 1 else 0


def units(counts: np.ndarray, cells: int, grid: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What is planned for pieces counted by bin: (demand by size in steps,
    first rank of each short length's groups, first rank of what its groups
    leave).  A size's ranks go to its own bin first, then to groups, then to
    short pieces left over, in order of length."""
    short = counts[cells:]
    groups, left = short // grid, short % grid
    size = -(-np.arange(1, len(short) + 1) // grid) - 1
    demand = counts[:cells].copy()
    group_at = demand[:len(short)].copy()
    demand[:len(short)] += groups
    left_at = np.zeros(len(short), np.int64)
    for k, n in enumerate(left):
        left_at[k] = demand[size[k]]
        demand[size[k]] += n
    return demand, group_at, left_at


PIECE = "_id long, start long, length long, ids_crc32 long, doc_tokens long, part int, bin int, place long"


def cut(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None, end_id: int = END_ID,
        capacity: int = CAPACITY, grid: int = GRID) -> DataFrame:
    """Pieces of every document: full sequences (bin -1) and one remainder
    (bin = its length in steps of ``grid``, less 1; a short one's is the number
    of steps plus its length, less 1), with its place among the task's pieces of
    that bin."""
    bounded_batches(docs.sparkSession)
    tokenizer = tokenizer or tokenizer_path()
    rows = id_and_text(docs, id_col, text_col).select(F.col("_id").cast("long").alias("_id"), "_text")
    schema = pa.schema([("_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()),
                        ("part", pa.int32()), ("bin", pa.int32()), ("place", pa.int64())])

    def run(batches):
        from pyspark import TaskContext

        part, tok = TaskContext.get().partitionId(), word_tokenizer(tokenizer)
        cells, exact = capacity // grid, exact_length(capacity, grid)
        places = np.zeros(cells + exact + 1, np.int64)
        for b in batches:
            if not b.num_rows:
                continue
            ids, lengths = tok.encode(raw(b.column(1)), end_id)
            ids = np.ascontiguousarray(ids, "<u4")
            k = -(-lengths // capacity)
            row = np.repeat(np.arange(len(lengths)), k)
            nth = np.arange(len(row)) - np.repeat(np.cumsum(k) - k, k)
            start = nth * capacity
            length = np.minimum(lengths[row] - start, capacity)
            at = (np.cumsum(lengths) - lengths)[row] + start
            crc = [zlib.crc32(ids[a:a + n]) for a, n in zip(at.tolist(), length.tolist())]
            bins = np.where(length == capacity, -1, np.where(length <= exact, cells + length, -(-length // grid)) - 1)
            order = np.argsort(bins, kind="stable")
            found, first, n = np.unique(bins[order], return_index=True, return_counts=True)
            place = np.empty(len(bins), np.int64)
            place[order] = np.arange(len(bins)) - np.repeat(first, n) + np.repeat(places[found], n)
            places[found] += n
            yield batch(schema, b.column(0).take(pa.array(row)), start, length, crc, lengths[row], np.full(len(row), part, np.int32), bins.astype(np.int32), place)

    return rows.mapInArrow(run, PIECE)


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None, end_id: int = END_ID,
         capacity: int = CAPACITY, grid: int = GRID) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset, n_pieces.

    A null text is empty and gives one piece that holds ``end_id``; repeated
    rows and equal or null ids are packed each for itself; other columns of the
    input are ignored; an empty table gives an empty result.

    Texts are read and encoded once, the pieces (without ids) are staged.  A
    piece's rank is its place in its task plus the counts of earlier tasks, so
    a bin that holds a third of all pieces needs no task of its own.
    """
    if capacity % grid:
        raise ValueError("grid must divide capacity")
    pieces = staged(cut(docs, id_col, text_col, tokenizer, end_id, capacity, grid), "pieces")
    counts = pieces.groupBy("part", "bin").agg(F.count("*").alias("n"))
    cells, exact = capacity // grid, exact_length(capacity, grid)
    by_bin = np.zeros(cells + exact, np.int64)
    full = 0
    for r in counts.groupBy("bin").agg(F.sum("n").alias("n")).collect():  # at most cells + EXACT + 1 rows
        if r.bin < 0:
            full = r.n
        else:
            by_bin[r.bin] = r.n
    demand, group_at, left_at = units(by_bin, cells, grid)
    grouped = by_bin[cells:] // grid * grid
    # the last bin (capacity - grid, capacity) fills a sequence alone
    rows, _ = plan(demand, cells)
    bins, first, sequence, per, slot = (np.array(x, np.int64) for x in zip(*rows)) if rows else (np.zeros(0, np.int64),) * 5
    key = bins << 44 | first

    earlier = Window.partitionBy("bin").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("part", "bin", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    ranked = pieces.join(offsets, ["part", "bin"]).select(*[c.split()[0] for c in PIECE.split(", ")[:5]], "bin", (F.col("place") + F.col("before")).alias("rank"))
    whole = ranked.filter("bin < 0").select("_id", "start", "length", "ids_crc32", "doc_tokens", F.col("rank").alias("sequence_id"),
                                            F.lit(0).cast("long").alias("offset"), F.lit(1).cast("long").alias("n_pieces"))
    names = ["_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "slot"]
    schema = pa.schema([(n, pa.int64()) for n in names])

    def assign(batches):
        for b in batches:
            bin_, rank = b.column(5).to_numpy(zero_copy_only=False).astype(np.int64), b.column(6).to_numpy(zero_copy_only=False).astype(np.int64)
            inner, short = np.zeros(len(rank), np.int64), np.flatnonzero(bin_ >= cells)
            if len(short):      # the rank and size of the group that holds a piece, and its place there
                n, r = bin_[short] - cells, rank[short]
                in_group = r < grouped[n]
                inner[short] = np.where(in_group, r % grid, 0)
                rank[short] = np.where(in_group, group_at[n] + r // grid, left_at[n] + r - grouped[n])
                bin_[short] = np.where(in_group, n, n // grid)
            i = np.searchsorted(key, bin_ << 44 | rank, side="right") - 1
            k = rank - first[i]
            yield batch(schema, *(b.column(j) for j in range(5)), full + sequence[i] + k // per[i], (slot[i] + k % per[i]) * grid + inner)

    rest = ranked.filter("bin >= 0").mapInArrow(assign, ", ".join(f"{n} long" for n in names))
    inside = Window.partitionBy("sequence_id")
    rest = rest.select("_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id",
                       F.coalesce(F.sum("length").over(inside.orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("offset"),
                       F.count("*").over(inside).alias("n_pieces"))
    return whole.unionByName(rest).withColumnRenamed("_id", id_col)


def op1_packing(spark, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
