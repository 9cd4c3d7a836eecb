"""Toxicity scores from subword-bag embeddings averaged into a linear softmax.

A text is the bag of the byte n-grams of its words, with marks at both ends of a
word, hashed into buckets.  Each bucket has an embedding; the mean over the bag
goes into a softmax over the two labels.  Embeddings and softmax are trained
jointly with Adam in numpy, on a bounded sample of labelled documents.  A misspelt
or inflected word shares most n-grams with known ones, so it needs no entry.

The mean of embeddings meets a linear layer, so for scoring each bucket is folded
into one number; that table goes to the tasks, which score whole texts in blocks
of vectorised lookups.  Map-only.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import pick, text_blocks

SIZES = (3, 4, 5, 6)
BITS = 18
DIM = 8
#: Bound of the training sample: so many documents of label 1, and twice as many of label 0.
MOST_ROWS = 1500
#: Buckets of fewer training texts than this are left at zero: they would only be learnt by heart.
MIN_BAGS = 3
EPOCHS = 10
BATCH = 64
RATE = 0.02
#: Embeddings are means over hundreds of n-grams; the softmax sees them so many times larger.
GAIN = 20.0
BLOCK_BYTES = 1_000_000
FOLDS = 5

#: Letters, digits and UTF-8's upper half, A-Z in lower case; 0 parts words.
_CHAR = np.array([b | 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 0 for b in range(256)], np.uint8)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def ngrams(chars: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each size: places where an n-gram of one word begins, and its bucket.

    The first and last place of an n-gram may be the gap before or after the word.
    """
    inner = chars != 0
    packed = chars.astype(np.uint64)
    wide, whole = packed.copy(), None
    for n in range(2, max(SIZES) + 1):
        wide = wide[:-1] | (packed[n - 1 :] << np.uint64(8 * (n - 1)))
        if n > 2:
            # all places but the ends stand within a word
            whole = inner[1:-1].copy() if whole is None else whole[:-1] & inner[n - 2 : len(chars) - 1]
        if n in SIZES:
            at = np.flatnonzero(whole)
            h = (wide[at] ^ np.uint64(n << 56)) * _MIX
            yield at, (h >> np.uint64(64 - BITS)).astype(np.int32)


def _block(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Characters of a block, each text between gaps, and where each text begins."""
    raw = np.frombuffer(b"\n" + b"\n\n".join(texts) + b"\n", np.uint8)
    return _CHAR[raw], np.cumsum([0, *(len(t) + 2 for t in texts)])[:-1]


def bag(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of one text and their counts, scaled down to 16 bits where a count needs more."""
    chars, _ = _block([text])
    if len(chars) < max(SIZES):
        chars = np.concatenate([chars, np.zeros(max(SIZES), np.uint8)])
    buckets, counts = np.unique(np.concatenate([b for _, b in ngrams(chars)]), return_counts=True)
    return buckets, (counts >> max(0, int(counts.max(initial=1)).bit_length() - 16)).astype(np.uint16)


def shares(counts: np.ndarray) -> np.ndarray:
    return (counts / max(1, int(counts.sum()))).astype(np.float32)


@dataclass
class Model:
    """Folded model: a weight for each bucket, and a bias."""

    weights: np.ndarray
    bias: float

    def scores(self, texts: list[bytes]) -> np.ndarray:
        chars, starts = _block(texts)
        chars = np.concatenate([chars, np.zeros(max(SIZES), np.uint8)])
        total, count = np.zeros(len(texts)), np.zeros(len(texts))
        for at, buckets in ngrams(chars):
            # sums between the places where texts begin
            cut = np.searchsorted(at, starts)
            sums = np.concatenate([[0.0], np.cumsum(self.weights[buckets], dtype=np.float64)])
            ends = np.append(cut[1:], len(at))
            total += sums[ends] - sums[cut]
            count += ends - cut
        return 1 / (1 + np.exp(-(self.bias + GAIN * total / np.maximum(count, 1))))


def train(bags: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, prior: float, seed: int = 7) -> Model:
    """Joint training of bucket embeddings and softmax; classes weigh as in ``prior``."""
    rng = np.random.default_rng(seed)
    emb = np.zeros((1 << BITS, DIM), np.float32)  # a bucket that training does not meet says nothing
    soft = (rng.standard_normal((DIM, 2)) * 0.5).astype(np.float32)
    bias = np.zeros(2, np.float32)
    moments = [np.zeros_like(emb), np.zeros_like(emb), np.zeros_like(soft), np.zeros_like(soft), np.zeros_like(bias), np.zeros_like(bias)]
    share = max(float(labels.mean()), 1e-6)
    weight = np.where(labels == 1, prior / share, (1 - prior) / max(1 - share, 1e-6)).astype(np.float32)
    weight /= weight.mean()
    step = 0
    for epoch in range(EPOCHS):
        order = rng.permutation(len(bags))
        rate = RATE * (1 - epoch / EPOCHS)
        for i in range(0, len(order), BATCH):
            rows = order[i : i + BATCH]
            sizes = np.array([len(bags[r][0]) for r in rows])
            buckets = np.concatenate([bags[r][0] for r in rows])
            shares = np.concatenate([bags[r][1] for r in rows])
            owner = np.repeat(np.arange(len(rows)), sizes)
            filled = np.flatnonzero(sizes)
            mean = np.zeros((len(rows), DIM), np.float32)
            if len(buckets):
                offsets = (np.cumsum(sizes) - sizes)[filled]
                mean[filled] = GAIN * np.add.reduceat(emb[buckets] * shares[:, None], offsets, axis=0)
            logits = mean @ soft + bias
            logits -= logits.max(axis=1, keepdims=True)
            p = np.exp(logits)
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(rows)), labels[rows]] -= 1
            p *= (weight[rows] / len(rows))[:, None]
            d_mean = GAIN * p @ soft.T
            touched, inverse = np.unique(buckets, return_inverse=True)
            d_emb = np.empty((len(touched), DIM), np.float32)
            values = d_mean[owner] * shares[:, None]
            for d in range(DIM):
                d_emb[:, d] = np.bincount(inverse, values[:, d], len(touched))
            step += 1
            fix = np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
            for k, (param, grad, at) in enumerate(((emb, d_emb, touched), (soft, mean.T @ p, slice(None)), (bias, p.sum(axis=0), slice(None)))):
                m, v = moments[2 * k], moments[2 * k + 1]
                m[at] = 0.9 * m[at] + 0.1 * grad
                v[at] = 0.999 * v[at] + 0.001 * grad * grad
                param[at] -= rate * fix * m[at] / (np.sqrt(v[at]) + 1e-8)
    contrast = soft[:, 1] - soft[:, 0]
    return Model((emb @ contrast).astype(np.float32), float(bias[1] - bias[0]))


def held_out(doc_id: Column, folds: int = FOLDS) -> Column:
    """Rows whose labels are never learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == 0, F.lit(False))


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [bag(t) for t in batch.column(1).cast(pa.binary()).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array([b for b, _ in rows], pa.list_(pa.int32())),
                pa.array([c.view(np.int16) for _, c in rows], pa.list_(pa.int16())),
            ],
            ["label", "buckets", "counts"],
        )


def fit(docs: DataFrame, labels: DataFrame, most: int = MOST_ROWS) -> Model:
    """Train on ``most`` labelled documents of label 1 and twice that of label 0 at most, picked by a hash of doc_id.

    ``docs``: (doc_id, text).  Held-out rows are left out.  Without labels of both
    kinds the model is flat: every score is the share of label 1, or 0.
    """
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("label"))
    n = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}  # two rows
    prior = n.get(1, 0) / max(1, sum(n.values()))
    flat = Model(np.zeros(1 << BITS, np.float32), float(np.log(max(prior, 1e-3) / max(1 - prior, 1e-3))))
    if len(n) < 2:
        return flat
    sample = None
    for label in (0, 1):
        part = known.where(F.col("label") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most * (2 - label))
        sample = part if sample is None else sample.unionAll(part)
    # the sample has at most 3 * most ids; of a repeated one a row is taken, whatever order they come in
    rows = docs.join(F.broadcast(sample), "doc_id").groupBy("doc_id")
    rows = rows.agg(F.min_by(F.struct("label", "text"), F.xxhash64("text")).alias("row")).select("row.label", "row.text")
    got = rows.mapInArrow(_bags, "label int, buckets array<int>, counts array<smallint>").toArrow()
    if not got.num_rows:
        return flat
    y = got.column("label").to_numpy().astype(np.int64)
    met = np.zeros(1 << BITS, np.int32)
    for batch in got.to_batches():
        met += np.bincount(batch.column(1).flatten().to_numpy(), minlength=1 << BITS).astype(np.int32)
    bags = []
    for batch in got.to_batches():
        (b, starts), (c, _) = ((x.values.to_numpy(), x.offsets.to_numpy()) for x in (batch.column(1), batch.column(2)))
        for i, j in zip(starts, starts[1:], strict=False):
            known = met[b[i:j]] >= MIN_BAGS
            bags.append((b[i:j][known], shares(c[i:j].view(np.uint16))[known]))
    del got
    keys = np.array([int(b[:8].sum()) * 1009 + len(b) for b, _ in bags])
    order = np.lexsort((y, keys))  # whatever order the rows came in
    return train([bags[i] for i in order], y[order], prior)


def _scored(batches: Iterator[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        parts = [model.value.scores(texts) for _, _, texts in text_blocks(batch.column(1), BLOCK_BYTES)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(np.concatenate(parts) if parts else np.zeros(0))], ["doc_id", "score"]
        )


def toxicity(
    docs: DataFrame, labels: DataFrame, most: int = MOST_ROWS, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``.

    Scores use the text alone.  A null or empty text has the score of the bias.
    Repeated rows give a row each; a null doc_id is carried and not held out;
    further columns are ignored.  Empty ``docs`` give an empty result, and without
    labels of both kinds all scores are alike.
    """
    source = pick(docs, id_col, text_col)
    model = docs.sparkSession.sparkContext.broadcast(fit(source, labels, most))  # 1 MB whatever the data
    scored = source.mapInArrow(lambda b: _scored(b, model), "doc_id long, score double")
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
