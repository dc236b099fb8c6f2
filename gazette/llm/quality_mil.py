"""Quality classifier by attention-based multiple-instance learning.

A document is a bag of passages.  Each passage is encoded from its byte
histogram and bigram statistics, gated attention weighs the passages, and the
weighted sum gives the document's score.  Only document labels are needed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gazette.llm.common import batch, bounded_batches, id_and_text, table
from gazette.llm.langid import fold_of, groups

PASSAGE = 512
HIDDEN, ATTENTION = 24, 12
#: Labelled documents of each label that training reads, with all their passages.
SAMPLE_DOCS = 1500
THRESHOLD = 0.3
BIGRAMS = 1024
FEATURES = 256 + 4


def passages(texts: list[bytes], size: int = PASSAGE) -> tuple[np.ndarray, np.ndarray]:
    """(features of every passage, first passage of each text).  Passages cut
    the whole text, an empty text has one empty passage."""
    length = np.fromiter(map(len, texts), np.int64, len(texts))
    count = np.maximum(1, -(-length // size))
    first = np.cumsum(count) - count
    data = np.frombuffer(b"".join(texts), np.uint8).astype(np.int64)
    inside = np.arange(len(data)) - np.repeat(np.cumsum(length) - length, length)
    owner = np.repeat(first, length) + inside // size
    n = int(count.sum())
    bytes_ = np.bincount(owner * 256 + data, minlength=n * 256).reshape(n, 256).astype(np.float32)
    total = np.maximum(bytes_.sum(axis=1, keepdims=True), 1)
    pair = (owner[1:] == owner[:-1]) if len(data) else np.zeros(0, bool)
    mixed = (data[:-1] * 167 + data[1:] * 31)[pair] % BIGRAMS if len(data) else np.zeros(0, np.int64)
    grams = np.bincount(owner[1:][pair] * BIGRAMS + mixed, minlength=n * BIGRAMS).reshape(n, BIGRAMS).astype(np.float32) if len(data) else np.zeros((n, BIGRAMS), np.float32)
    share = grams / np.maximum(grams.sum(axis=1, keepdims=True), 1)
    extra = np.stack([(grams > 0).sum(axis=1) / total[:, 0], (share * share).sum(axis=1), share.max(axis=1), np.log1p(total[:, 0]) / 7], axis=1)
    return np.concatenate([np.sqrt(bytes_ / total), extra], axis=1).astype(np.float32), first


class AttentionMil:
    def __init__(self, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.mean, self.scale = np.zeros(FEATURES, np.float32), np.ones(FEATURES, np.float32)
        shapes = {"w": (FEATURES, HIDDEN), "b": (HIDDEN,), "v": (HIDDEN, ATTENTION), "u": (HIDDEN, ATTENTION), "a": (ATTENTION,), "out": (HIDDEN,), "bias": (1,)}
        self.p = {k: (rng.normal(0, s[0] ** -0.5, s) if len(s) > 1 or k in ("a", "out") else np.zeros(s)).astype(np.float32) for k, s in shapes.items()}

    def forward(self, x: np.ndarray, first: np.ndarray) -> dict:
        p, f = self.p, {}
        f["x"] = np.clip((x - self.mean) / self.scale, -6, 6)
        f["h"] = np.tanh(f["x"] @ p["w"] + p["b"])
        f["t"], f["s"] = np.tanh(f["h"] @ p["v"]), sigmoid(f["h"] @ p["u"])
        raw = (f["t"] * f["s"]) @ p["a"]
        f["of"] = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(x))))
        e = np.exp(raw - np.maximum.reduceat(raw, first)[f["of"]])
        f["alpha"] = e / np.add.reduceat(e, first)[f["of"]]
        f["z"] = np.add.reduceat(f["alpha"][:, None] * f["h"], first, axis=0)
        f["score"] = sigmoid(f["z"] @ p["out"] + p["bias"][0])
        return f

    def scores(self, x: np.ndarray, first: np.ndarray) -> np.ndarray:
        return self.forward(x, first)["score"]

    def gradient(self, x, first, y, weight) -> dict[str, np.ndarray]:
        p, f = self.p, self.forward(x, first)
        d = (f["score"] - y) * weight / weight.sum()
        g = {"out": f["z"].T @ d, "bias": np.array([d.sum()])}
        dz = (d[:, None] * p["out"])[f["of"]]
        each = (dz * f["h"]).sum(axis=1)
        dr = f["alpha"] * (each - np.add.reduceat(f["alpha"] * each, first)[f["of"]])
        g["a"] = (f["t"] * f["s"]).T @ dr
        dts = dr[:, None] * p["a"]
        dt, ds = dts * f["s"] * (1 - f["t"] ** 2), dts * f["t"] * f["s"] * (1 - f["s"])
        g["v"], g["u"] = f["h"].T @ dt, f["h"].T @ ds
        dh = (f["alpha"][:, None] * dz + dt @ p["v"].T + ds @ p["u"].T) * (1 - f["h"] ** 2)
        g["w"], g["b"] = f["x"].T @ dh, dh.sum(axis=0)
        return {k: v + (1e-4 * p[k] if v.ndim > 1 else 0) for k, v in g.items()}

    def train(self, bags: list[np.ndarray], y: np.ndarray, weight: np.ndarray, epochs: int = 25, size: int = 64, rate: float = 0.005, seed: int = 3) -> None:
        every = np.concatenate(bags)
        self.mean, self.scale = every.mean(axis=0), every.std(axis=0) + 0.01
        rng, t = np.random.default_rng(seed), 0
        m, v = ({k: np.zeros_like(x) for k, x in self.p.items()} for _ in range(2))
        for _ in range(epochs):
            order = rng.permutation(len(y))
            for i in range(0, len(y), size):
                pick, t = order[i:i + size], t + 1
                sizes = [len(bags[j]) for j in pick]
                x, first = np.concatenate([bags[j] for j in pick]), np.cumsum([0, *sizes[:-1]])
                for k, g in self.gradient(x, first, y[pick], weight[pick]).items():
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.99 * v[k] + 0.01 * g * g
                    self.p[k] = (self.p[k] - rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.99**t)) + 1e-7)).astype(np.float32)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
        per_label: int = SAMPLE_DOCS) -> AttentionMil | None:
    """A trained model, or None without labelled texts of both kinds.

    All labels are counted, so that a sample of equal size for each label is
    weighted back to their true shares and the score stays a probability.
    Labels other than 0 and 1 don't count; of an id's several labels the
    greatest is read, of its several texts the smallest.  Documents are chosen
    by a hash of the id: a cut taken from the counts leaves a few thousand ids
    to rank, and no more than two times ``per_label`` documents are collected.
    """
    bounded_batches(docs.sparkSession)
    known = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_y")).filter("_y in (0, 1) and _id is not null")
    share = {r["_y"]: r["n"] for r in known.groupBy("_y").agg(F.count("*").alias("n")).collect()}
    if len(share) < 2:
        return None
    hashed = F.pmod(F.xxhash64("_id"), F.lit(1 << 40)) / (1 << 40)
    near = F.coalesce(*[F.when(F.col("_y") == y, F.lit(min(1.0, (2 * per_label + 100) / n))) for y, n in share.items()])
    order = Window.partitionBy("_y").orderBy(F.xxhash64("_id"), "_id")
    chosen = (known.filter(hashed < near).groupBy("_id").agg(F.max("_y").alias("_y"))
              .withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= per_label).select("_id", "_y"))
    texts = id_and_text(docs, id_col, text_col).join(F.broadcast(chosen), "_id").groupBy("_id", "_y").agg(F.min("_text").alias("_text"))
    rows = sorted((r["_y"], bytes(r["_text"] or b"")) for r in texts.select("_y", F.col("_text").cast("binary").alias("_text")).collect())
    if len({y for y, _ in rows}) < 2:
        return None
    bags = [passages([text])[0] for _, text in rows]
    y = np.array([r[0] for r in rows], np.float32)
    got = {k: (y == k).sum() for k in (0, 1)}
    weight = np.array([share[int(k)] / got[int(k)] for k in y], np.float32)
    model = AttentionMil()
    model.train(bags, y, weight / weight.mean())
    return model


def score(docs: DataFrame, model: AttentionMil | None, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: id, score, predicted.  A null text counts as
    empty and is scored as such; without a model the score is 0.5.  Rows are
    scored one by one; extra columns are ignored."""
    bounded_batches(docs.sparkSession)
    rows = id_and_text(docs, id_col, text_col)

    def run(batches):
        for b in batches:
            texts = [t or b"" for t in b.column(1).cast(pa.binary()).to_pylist()]
            got = [model.scores(*passages(texts[lo:hi])) if model else np.full(hi - lo, 0.5) for lo, hi in groups([len(t) + PASSAGE for t in texts])]
            s = np.concatenate(got).astype(np.float64) if got else np.zeros(0)
            yield batch(pa.schema([("_id", b.column(0).type), ("score", pa.float64()), ("predicted", pa.int32())]), b.column(0), s, (s >= threshold).astype(np.int32))

    kind = rows.schema["_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"_id {kind}, score double, predicted int").withColumnRenamed("_id", id_col)


def op6_quality_mil(spark, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held = F.coalesce(fold_of("doc_id", 5) == 0, F.lit(False))
    model = fit(docs, labels.filter(~held))
    return score(docs, model).select("doc_id", held.alias("held_out"), "score", "predicted")
