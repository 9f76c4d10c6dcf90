"""Quality classifier on learned subword embeddings.

The words of a text and all its runs of 3 to 5 bytes are hashed into buckets (a word that only repeats the one
before it is the word "again"); every bucket has a learned vector, a text is the average of its vectors, and a softmax over the average gives the score. Vectors and
output weights are learned together by stochastic gradient descent in numpy, in one task on a bounded random
sample of the labelled rows (``sample_rows`` for each label). For scoring, the product of vectors and output
weights is one number a bucket, so the model that goes to all tasks is a fixed table of ``buckets`` numbers.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from campuswatt.llm import text as X

BUCKETS, DIM = 1 << 17, 16
GRAMS = (3, 4, 5)
SAMPLE_ROWS = 2000
EPOCHS, RATE = 6, 1.0
_AGAIN = np.uint64(0xA6A1)


def features(data, offsets, buckets):
    """Bucket numbers of all words and byte runs of each text: numbers, and where each text's begin."""
    starts, ends, counts = X.spans(data, offsets)
    words, of = X.hashes(data, starts, ends), np.repeat(np.arange(len(counts)), counts)
    again = np.zeros(len(words), dtype=bool)
    again[1:] = (words[1:] == words[:-1]) & (of[1:] == of[:-1])
    words[again] = _AGAIN
    found = [(words % np.uint64(buckets), of)]
    text = np.repeat(np.arange(len(counts)), np.diff(offsets))
    run = X._BYTE[data]
    for n in range(2, max(GRAMS) + 1):
        run = X.mix(run[:-1] * X._STEP + X._BYTE[data[n - 1:]]) if len(run) > 1 else run[:0]
        if n in GRAMS and len(run):
            inside = text[:len(run)] == text[n - 1:]
            found.append((run[inside] % np.uint64(buckets), text[:len(run)][inside]))
    of = np.concatenate([t for _, t in found])
    order = np.argsort(of, kind="stable")
    return np.concatenate([b for b, _ in found])[order].astype(np.int64), np.searchsorted(of[order], np.arange(len(counts) + 1))


class Model:
    def __init__(self, weights, bias):
        self.weights, self.bias = weights, bias      # one number a bucket: its vector times the output weights

    def scores(self, data, offsets):
        """Probability of label 1 of each text; a text without features has the bias alone."""
        found, first = features(data, offsets, len(self.weights))
        summed = np.concatenate([[0.0], np.cumsum(self.weights[found], dtype=np.float64)])
        count = np.diff(first)
        return 1 / (1 + np.exp(-(self.bias + (summed[first[1:]] - summed[first[:-1]]) / np.maximum(count, 1))))


def train(bags, labels, buckets=BUCKETS, dim=DIM, epochs=EPOCHS, rate=RATE, seed=11):
    """Learn from bags (bucket numbers, shares) and labels 0/1."""
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / dim, 1 / dim, (buckets, dim)).astype(np.float32)
    out, bias = np.zeros((dim, 2), dtype=np.float32), np.zeros(2, dtype=np.float32)
    steps, done = max(1, epochs * len(bags)), 0
    for _ in range(epochs):
        for i in rng.permutation(len(bags)):
            ids, share = bags[i]
            step = np.float32(rate * (1 - done / steps))
            done += 1
            hidden = share @ vectors[ids]
            logits = hidden @ out + bias
            p = np.exp(logits - logits.max())
            error = p / p.sum()
            error[labels[i]] -= 1
            back = out @ error
            out -= step * np.outer(hidden, error)
            bias -= step * error * np.float32(0.1)
            # a share is small, so the step of a vector is scaled up to its part in the average
            vectors[ids] -= (step * 20 * np.sqrt(share / len(share)))[:, None] * back[None, :]
    return Model((vectors @ (out[:, 1] - out[:, 0])).astype(np.float32), float(bias[1] - bias[0]))


def held_out(doc_id):
    """Rows that training never sees."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def fit(docs, labels, doc_id="doc_id", text="text", label="quality", sample_rows=SAMPLE_ROWS, buckets=BUCKETS, **how):
    """Train on about ``sample_rows`` random rows of each label among those that are not held out.

    A doc_id with several labels counts with the smallest; rows without label or text match teach nothing.
    Without labelled rows the score is 1/2.
    """
    known = (labels.filter(F.col(label).isin(0, 1) & ~held_out(doc_id)).groupBy(F.col(doc_id).alias("_id"))
             .agg(F.min(label).cast("int").alias("label")).filter("_id IS NOT NULL"))
    share = {r.label: min(1.0, sample_rows / r["count"]) for r in known.groupBy("label").count().collect()}    # two rows
    picked = known.filter(" OR ".join([f"(label = {k} AND pmod(xxhash64(_id), {1 << 20}) < {v * (1 << 20)})" for k, v in share.items()]) or "false")
    rows = (docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("text")).join(F.broadcast(picked), "_id")
            .select("label", "text", "_id"))    # about 2 x sample_rows ids, whatever the corpus

    def bag(batches):
        for batch in batches:
            ids, shares = [], []
            for _, offsets, data in X.chunks(batch.column(1)):
                found, first = features(data, offsets, buckets)
                for lo, hi in zip(first[:-1].tolist(), first[1:].tolist()):
                    own, n = np.unique(found[lo:hi], return_counts=True)
                    ids.append(own.astype("<i4").tobytes())
                    shares.append((n / max(hi - lo, 1)).astype("<f4").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(ids, pa.binary()), pa.array(shares, pa.binary())],
                                             names=["label", "id", "ids", "shares"])

    def learn(table):
        table = table.sort_by("id")
        bags = [(np.frombuffer(i, "<i4"), np.frombuffer(s, "<f4")) for i, s in zip(table.column("ids").to_pylist(), table.column("shares").to_pylist())]
        model = train(bags, table.column("label").to_pylist(), buckets, **how)
        return pa.Table.from_arrays([pa.array([model.weights.tobytes()]), pa.array([model.bias])], names=["weights", "bias"])

    kind = picked.schema["_id"].dataType.simpleString()
    bags = rows.mapInArrow(bag, f"label int, id {kind}, ids binary, shares binary")
    found = bags.groupBy(F.lit(0).alias("all")).applyInArrow(learn, "weights binary, bias double").collect()    # one row, a number a bucket
    if not found:
        return Model(np.zeros(buckets, dtype=np.float32), 0.0)
    return Model(np.frombuffer(found[0].weights, "<f4"), found[0].bias)


def score(docs, model, doc_id="doc_id", text="text"):
    """doc_id, held_out, score and predicted of every row; a null text is empty."""
    kind = docs.schema[doc_id].dataType.simpleString()
    sent = docs.sparkSession.sparkContext.broadcast(model)     # a number a bucket, whatever the corpus

    def run(batches):
        for batch in batches:
            for first, offsets, data in X.chunks(batch.column(2)):
                p = sent.value.scores(data, offsets)
                rows = batch.slice(first, len(p))
                yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.array(p), pa.array((p >= 0.5).astype(np.int32))],
                                                 names=["doc_id", "held_out", "score", "predicted"])

    return (docs.select(F.col(doc_id).alias("doc_id"), held_out(doc_id).alias("held_out"), F.col(text).alias("text"))
            .mapInArrow(run, f"doc_id {kind}, held_out boolean, score double, predicted int"))
