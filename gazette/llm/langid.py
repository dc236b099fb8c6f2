"""Language identification with a byte convolutional network.

Bytes are embedded, filters of several widths slide over a fixed-length
window, each filter keeps its maximum, and a softmax gives the language.  The
network is trained in numpy on a bounded sample of labelled documents and
applied to every window of every text; a text's score is the mean over its
windows, weighted by their bytes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gazette.llm.common import batch, bounded_batches, id_and_text, table

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 8
EMBEDDING = 8
#: Labelled documents for each language that training reads, with all their windows.
SAMPLE_DOCS = 400
UNKNOWN = "und"
#: A-Z and a-z are one; byte 0 pads.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def windows(text: bytes, size: int = WINDOW, overlap: int = max(WIDTHS) - 1) -> tuple[np.ndarray, np.ndarray]:
    """(windows, size) bytes that cover the whole text, and each window's real bytes."""
    data = np.frombuffer(text.translate(FOLD), np.uint8)
    step = size - overlap
    n = max(1, -(-(len(data) - overlap) // step))
    cells = np.zeros((n - 1) * step + size, np.uint8)
    cells[:len(data)] = data
    view = np.lib.stride_tricks.as_strided(cells, (n, size), (step, 1))
    return view, np.minimum(size, len(data) - np.arange(n) * step)


class ByteNet:
    def __init__(self, classes: list[str], seed: int = 7, widths=WIDTHS, filters: int = FILTERS, embedding: int = EMBEDDING):
        rng = np.random.default_rng(seed)
        self.classes, self.widths = classes, tuple(widths)
        self.p = {"e": rng.normal(0, 0.5, (256, embedding)), "out": rng.normal(0, 0.3, (len(self.widths) * filters, len(classes))), "bias": np.zeros(len(classes))}
        for w in self.widths:
            self.p[f"w{w}"] = rng.normal(0, (w * embedding) ** -0.5, (w, embedding, filters))
            self.p[f"b{w}"] = np.zeros(filters)
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}
        self._tables = None

    def tables(self) -> dict[int, list[np.ndarray]]:
        """Embedding times filter, for each byte and filter position."""
        if self._tables is None:
            e = self.p["e"].copy()
            e[0] = 0
            self._tables = {w: [np.ascontiguousarray(e @ self.p[f"w{w}"][j]) for j in range(w)] for w in self.widths}
        return self._tables

    def features(self, cells: np.ndarray, where: bool = False):
        cells = cells.astype(np.intp)
        out, at = [], []
        for w, parts in self.tables().items():
            length = cells.shape[1] - w + 1
            total = parts[0].take(cells[:, :length], axis=0)
            for j in range(1, w):
                total += parts[j].take(cells[:, j:j + length], axis=0)
            if where:
                at.append(total.argmax(axis=1))
            out.append(np.maximum(total.max(axis=1) + self.p[f"b{w}"], 0))
        return (np.concatenate(out, axis=1), at) if where else np.concatenate(out, axis=1)

    def probabilities(self, cells: np.ndarray, block: int = 256) -> np.ndarray:
        """Softmax of each window, in blocks that stay in the cache."""
        got = [softmax(self.features(cells[i:i + block]) @ self.p["out"] + self.p["bias"]) for i in range(0, len(cells), block)]
        return np.concatenate(got) if got else np.zeros((0, len(self.classes)), np.float32)

    def gradient(self, cells: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None) -> dict[str, np.ndarray]:
        x, at = self.features(cells, where=True)
        p = softmax(x @ self.p["out"] + self.p["bias"])
        p[np.arange(len(y)), y] -= 1
        p *= (1.0 if weight is None else weight[:, None]) / len(y)
        g = {k: np.zeros_like(v) for k, v in self.p.items()}
        g["out"], g["bias"] = x.T @ p, p.sum(axis=0)
        dx = (p @ self.p["out"].T) * (x > 0)
        f, rows = dx.shape[1] // len(self.widths), np.arange(len(y))[:, None]
        for k, w in enumerate(self.widths):
            d = dx[:, k * f:(k + 1) * f]
            g[f"b{w}"] = d.sum(axis=0)
            for j in range(w):  # only the byte at each maximum takes part
                byte = cells[rows, at[k] + j]
                real = d * (byte > 0)
                g[f"w{w}"][j] = np.einsum("nfe,nf->ef", self.p["e"][byte], real)
                np.add.at(g["e"], byte, real[:, :, None] * self.p[f"w{w}"][j].T[None])
        return g

    def train(self, cells: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, epochs: int = 4, size: int = 64, rate: float = 0.01, seed: int = 11) -> None:
        rng = np.random.default_rng(seed)
        m, v, t = ({k: np.zeros_like(x) for k, x in self.p.items()} for _ in range(2)), None, 0
        m, v = m
        for _ in range(epochs):
            order = rng.permutation(len(y))
            for i in range(0, len(y), size):
                pick, t = order[i:i + size], t + 1
                for k, g in self.gradient(cells[pick], y[pick], None if weight is None else weight[pick]).items():
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.99 * v[k] + 0.01 * g * g
                    self.p[k] -= rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.99**t)) + 1e-7)
                self._tables = None


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fold_of(id_col: str, n: int) -> Column:
    """crc32 of the id as text, modulo n; a null id is in no fold."""
    return F.crc32(F.col(id_col).cast("string")) % n


def sample_windows(docs: DataFrame, id_col: str, text_col: str, label_col: str, per_label: int, size: int = WINDOW) -> tuple[np.ndarray, list[str], np.ndarray]:
    """All windows of up to ``per_label`` documents of each label, chosen by a
    hash of the id.  Ids are ranked without their texts; only the chosen ids are
    joined, and of an id's several rows the smallest text is read, so no more
    than labels x per_label documents reach the driver.  Returns the windows,
    their labels, and weights by which the windows of a document sum to one."""
    ids = docs.select(F.col(id_col).alias("_id"), F.col(label_col).cast("string").alias("_label")).distinct()
    order = Window.partitionBy("_label").orderBy(F.xxhash64("_id"), "_id")
    chosen = ids.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= per_label).select("_id", "_label")
    texts = id_and_text(docs, id_col, text_col).join(F.broadcast(chosen), "_id").groupBy("_id", "_label").agg(F.min("_text").alias("_text"))
    schema = pa.schema([("label", pa.string()), ("cells", pa.binary()), ("weight", pa.float64())])

    def run(batches):
        for b in batches:
            for label, text in zip(b.column(1).to_pylist(), b.column(2).cast(pa.binary()).to_pylist()):
                cells, real = windows(text or b"", size)
                out = [c.tobytes() for c, n in zip(cells, real) if n > 0]
                yield batch(schema, [label] * len(out), out, [1 / len(out)] * len(out) if out else [])

    rows = sorted((r.label, bytes(r.cells), r.weight) for r in texts.mapInArrow(run, "label string, cells binary, weight double").collect())
    cells = np.frombuffer(b"".join(c for _, c, _ in rows), np.uint8).reshape(-1, size)
    return cells, [x for x, _, _ in rows], np.array([w for _, _, w in rows])


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_label: int = SAMPLE_DOCS) -> ByteNet | None:
    """A trained network; None if no row has both a text and a label."""
    bounded_batches(labelled.sparkSession)
    known = labelled.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    cells, labels, weight = sample_windows(known, id_col, text_col, lang_col, per_label)
    if not labels:
        return None
    net = ByteNet(sorted(set(labels)))
    net.train(cells, np.array([net.classes.index(x) for x in labels]), weight / weight.mean())
    return net


def predict(docs: DataFrame, net: ByteNet | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, lang_pred, score.  ``und`` with score 0 if
    the text is null or has no letter, or nothing could be learned.  Rows are
    judged one by one, so ids may be null or repeat; extra columns are ignored."""
    bounded_batches(docs.sparkSession)
    rows = id_and_text(docs, id_col, text_col)

    def run(batches):
        import regex

        letter = regex.compile(r"\p{L}").search
        for b in batches:
            texts = b.column(1).to_pylist()
            real = [i for i, t in enumerate(texts) if t and net and letter(t)]
            langs, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
            for lo, hi in groups([len(texts[i]) for i in real]):
                got = [windows(texts[i].encode("utf-8", "replace")) for i in real[lo:hi]]
                p = net.probabilities(np.concatenate([c for c, _ in got])) * np.concatenate([n for _, n in got])[:, None]
                first = np.cumsum([0] + [len(c) for c, _ in got[:-1]])
                mean = np.add.reduceat(p, first, axis=0) / np.add.reduceat(np.concatenate([n for _, n in got]), first)[:, None]
                for i, m in zip(real[lo:hi], mean):
                    langs[i], scores[i] = net.classes[int(m.argmax())], min(1.0, float(m.max()))
            yield batch(pa.schema([("_id", b.column(0).type), ("lang_pred", pa.string()), ("score", pa.float64())]), b.column(0), langs, scores)

    kind = rows.schema["_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"_id {kind}, lang_pred string, score double").withColumnRenamed("_id", id_col)


def groups(sizes: list[int], most: int = 1 << 20):
    """Consecutive (from, to) ranges of about ``most`` in sum."""
    lo = total = 0
    for i, n in enumerate(sizes):
        total += n
        if total >= most:
            yield lo, i + 1
            lo, total = i + 1, 0
    if lo < len(sizes):
        yield lo, len(sizes)


def op3_language_id(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = F.coalesce(fold_of("doc_id", 4) == 2, F.lit(False))
    net = fit(docs.filter(~held))
    return predict(docs, net).select("doc_id", held.alias("held_out"), "lang_pred", "score")
