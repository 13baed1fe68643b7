"""Quality classifier by attention over a document's passages.

A document is a bag of passages of ``PASSAGE`` words; each is encoded by what its
words look like. A hidden layer, gated attention (tanh times sigmoid) and a
weighted mean of the passages give the document's score, learned from document
labels alone. Only texts are inputs.

The classifier is fitted on the driver on at most ``train_rows`` labelled rows, taken
by the hash of their ids; every row is scored, in bounded slices of text.

Defined results: a null or empty text is one passage without words and gets a score
too; each input row gives one row; rows without label or without id aren't learned
from; of contradicting labels of one id each counts; of rows that repeat a labelled
id one is learned from; extra columns stay beside the score, but for one of its name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .common import bound_batches, slices, split_words

PASSAGE = 64
FEATURES = 14


def passages(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages (passages x FEATURES), and each text's first passage (with the end)."""
    words, bounds = split_words(texts)
    sizes = np.diff(bounds)
    counts = np.maximum(1, -(-sizes // PASSAGE))
    firsts = np.concatenate([[0], np.cumsum(counts)])
    out = np.zeros((int(firsts[-1]), FEATURES), np.float32)
    if not len(words):
        return out, firsts
    coded = words.dictionary_encode()
    code, kinds = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary
    low, up = pc.utf8_lower(kinds), pc.utf8_upper(kinds)
    flag = lambda x: x.to_numpy(zero_copy_only=False).astype(np.float32)
    has = lambda pattern: flag(pc.match_substring_regex(kinds, pattern))
    length = flag(pc.utf8_length(kinds))
    letters = flag(pc.utf8_length(pc.replace_substring_regex(kinds, r"[^\pL]+", "")))
    per_kind = np.stack([
        np.log1p(length), flag(pc.and_(pc.equal(kinds, up), pc.not_equal(kinds, low))), has(r"[!?]$"), has(r"[#$%&*@^~=<>\\]"), has(r"\|"), has(r"[0-9]"),
        has(r"[.,;:]$"), letters / np.maximum(1, length), flag(pc.and_(pc.not_equal(kinds, low), pc.not_equal(kinds, up))), (length > 24).astype(np.float32),
    ], 1)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(code)) - bounds[:-1][owner]
    passage = firsts[:-1][owner] + place // PASSAGE
    starts = np.flatnonzero(np.concatenate([[True], passage[1:] != passage[:-1]]))
    n = np.diff(np.concatenate([starts, [len(code)]])).astype(np.float32)
    rows = passage[starts]
    out[rows, :10] = np.add.reduceat(per_kind[code], starts, 0) / n[:, None]
    for column, back in ((10, 1), (11, 2)):
        same = np.zeros(len(code), np.float32)
        same[back:] = (code[back:] == code[:-back]) & (owner[back:] == owner[:-back])
        out[rows, column] = np.add.reduceat(same, starts) / n
    pairs = np.sort(passage * len(kinds) + code)
    distinct = pairs[np.concatenate([[True], pairs[1:] != pairs[:-1]])] // len(kinds)
    out[rows, 12] = np.bincount(distinct, minlength=len(out))[rows] / n
    out[rows, 13] = np.log1p(n)
    return out, firsts


class Attention:
    """h = tanh(W x + b); a = softmax(w . (tanh(V h) * sigmoid(U h))); score = sigmoid(c . sum(a h) + d)."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, weights: dict[str, np.ndarray]):
        self.mean, self.scale, self.w = mean, scale, weights

    def forward(self, x: np.ndarray, firsts: np.ndarray) -> dict[str, np.ndarray]:
        w, starts = self.w, firsts[:-1]
        owner = np.repeat(np.arange(len(starts)), np.diff(firsts))
        x = (x - self.mean) / self.scale
        h = np.tanh(x @ w["W"] + w["b"])
        t, s = np.tanh(h @ w["V"]), 1 / (1 + np.exp(-(h @ w["U"])))
        e = (t * s) @ w["w"]
        e = np.exp(e - np.maximum.reduceat(e, starts)[owner])
        a = e / np.add.reduceat(e, starts)[owner]
        z = np.add.reduceat(a[:, None] * h, starts, 0)
        p = 1 / (1 + np.exp(-np.clip(z @ w["c"] + w["d"], -30, 30)))
        return {"x": x, "h": h, "t": t, "s": s, "a": a, "z": z, "p": p, "owner": owner}

    def gradients(self, f: dict[str, np.ndarray], y: np.ndarray, starts: np.ndarray) -> dict[str, np.ndarray]:
        w, o = self.w, f["owner"]
        dp = (f["p"] - y) / len(y)
        dz = dp[:, None] * w["c"]
        dh = f["a"][:, None] * dz[o]
        da = (f["h"] * dz[o]).sum(1)
        de = f["a"] * (da - np.add.reduceat(f["a"] * da, starts)[o])
        dg = de[:, None] * w["w"]
        dt, ds = dg * f["s"] * (1 - f["t"] ** 2), dg * f["t"] * f["s"] * (1 - f["s"])
        dh += dt @ w["V"].T + ds @ w["U"].T
        du = dh * (1 - f["h"] ** 2)
        return {"W": f["x"].T @ du, "b": du.sum(0), "V": f["h"].T @ dt, "U": f["h"].T @ ds, "w": (f["t"] * f["s"]).T @ de, "c": f["z"].T @ dp, "d": dp.sum(keepdims=True)}


def fit(x: np.ndarray, firsts: np.ndarray, y: np.ndarray, hidden: int = 16, steps: int = 400, rate: float = 0.02, decay: float = 1e-4, seed: int = 1) -> Attention:
    """Full-batch Adam; the same rows in the same order give the same weights."""
    rnd = np.random.default_rng(seed)
    mean, scale = x.mean(0) if len(x) else np.zeros(FEATURES), (x.std(0) if len(x) else np.zeros(FEATURES)) + 0.05
    shape = {"W": (FEATURES, hidden), "b": (hidden,), "V": (hidden, 8), "U": (hidden, 8), "w": (8,), "c": (hidden,), "d": (1,)}
    weights = {k: rnd.normal(0, 0.3, s) * (k not in "bd") for k, s in shape.items()}
    model = Attention(mean.astype(np.float64), scale.astype(np.float64), weights)
    if not len(y):
        return model
    m, v = ({k: np.zeros(s) for k, s in shape.items()} for _ in range(2))
    for step in range(1, steps + 1):
        grads = model.gradients(model.forward(x, firsts), y, firsts[:-1])
        for k, g in grads.items():
            g = g + decay * weights[k]
            m[k], v[k] = 0.9 * m[k] + 0.1 * g, 0.999 * v[k] + 0.001 * g * g
            weights[k] -= rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    return model


def train(docs: DataFrame, labels: DataFrame, train_rows: int = 6_000, train_passages: int = 512, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", learnable: Column | None = None) -> Attention:
    """Fits on at most ``train_rows`` labelled rows for which ``learnable`` (a condition on the column id) holds.

    Of rows that repeat an id and label, one is learned from; of a text of more than
    ``train_passages`` passages, so many at even distances: both bound what the driver gets.
    """
    known = bound_batches(labels).select(F.col(id_col).alias("id"), F.col(label_col).cast("double").alias("y")).where("y IS NOT NULL AND id IS NOT NULL")
    if learnable is not None:
        known = known.where(learnable)
    chosen = known.distinct().orderBy(F.xxhash64("id"), "id", "y").limit(train_rows)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "id")  # bounded by train_rows

    def bag(x: np.ndarray) -> bytes:
        return (x if len(x) <= train_passages else x[np.linspace(0, len(x) - 1, train_passages).astype(np.int64)]).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            x, firsts = passages(batch.column(2))
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.string()), batch.column(1), pa.array([bag(x[a:b]) for a, b in zip(firsts[:-1], firsts[1:], strict=True)], pa.binary())], names=["id", "y", "x"])

    # Of an id's rows a task sends one on, so a repeated id is no load.
    once = texts.select("id", "y", "text").mapInArrow(run, "id string, y double, x binary").groupBy("id", "y").agg(F.min("x").alias("x"))
    rows = sorted(once.collect(), key=lambda r: (r.id, r.y, r.x))
    parts = [np.frombuffer(r.x, np.float32).reshape(-1, FEATURES) for r in rows]
    x = np.concatenate(parts).astype(np.float64) if parts else np.zeros((0, FEATURES))
    return fit(x, np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64), np.array([r.y for r in rows]))


def score(docs: DataFrame, model: Attention, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with a column ``score_col`` (0 to 1, higher: label 1 likelier), in place of one of that name."""
    docs = docs.drop(score_col)
    shared = bound_batches(docs).sparkSession.sparkContext.broadcast(model)
    schema = StructType([*docs.schema.fields, StructField(score_col, DoubleType())])
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col):
            x, firsts = passages(batch.column(at))
            p = shared.value.forward(x.astype(np.float64), firsts)["p"]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(p)], names=[*batch.schema.names, score_col])

    return docs.mapInArrow(run, schema)


def held_out(id_: Column, folds: int = 5) -> Column:
    """Whether crc32 of the id as text leaves no remainder."""
    return F.coalesce(F.pmod(F.crc32(id_.cast("string").cast("binary")), F.lit(folds)) == 0, F.lit(False))
