"""Quality classifier with supervised subword embeddings.

A document is the average of learned vectors of its hashed features: its words, the character 3- and
4-grams of its words (with word edges), and its pairs of neighbouring words. A linear layer with softmax
gives the probability of label 1. Vectors and layer are trained by stochastic gradient descent in numpy,
one document a step, with a falling rate.

Training uses at most ``SAMPLE`` labelled documents, the ones with the smallest hash of their id (a
documented bound; the model is fixed in size and the sample fits the driver). Scoring takes every text
whole. As the layer is linear, each hashed feature contributes one number; a word's own and character
features are summed once per distinct word of a batch.

An empty or null text has no feature: score 0.5, predicted 0. So has every text if no label of both
kinds was learned from. Labels are read from training documents only; a null quality, a null id or an
id without a document is skipped, an id labelled twice counts by its smallest label. Equal rows get
equal scores; extra columns are ignored."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delivery_lake.llm.common import as_bytes, doc_texts, held_out, remainder, slices

#: Most labelled documents in training.
SAMPLE = 3000
#: Hash buckets, vector size, passes, first rate, seed.
BUCKETS, DIMENSIONS, EPOCHS, RATE, SEED = 1 << 17, 16, 12, 0.4, 11
#: Score from which a document is predicted 1.
THRESHOLD = 0.7
#: Text bytes scored together.
CHUNK = 4 << 20

_PAIR = np.uint64(0x9E3779B97F4A7C15)
_GRAM = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)


def word_buckets(words: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Features of some words, in three lists of (bucket, number of the word): the words themselves,
    their character 3-grams and their 4-grams, word edges included."""
    own = np.array([zlib.crc32(w, 1) % BUCKETS for w in words], np.int64)
    data = np.frombuffer(b"<" + b"><".join(words) + b">", np.uint8).astype(np.uint32)
    word = np.repeat(np.arange(len(words)), [len(w) + 2 for w in words])
    three = data[:-2] | data[1:-1] << np.uint32(8) | data[2:] << np.uint32(16)
    four = three[:-1] | data[3:] << np.uint32(24)
    shift = np.uint32(32 - BUCKETS.bit_length() + 1)
    out = [(own, np.arange(len(words)))]
    for gram, size, odd in ((three, 3, _GRAM[0]), (four, 4, _GRAM[1])):
        inside = word[: len(gram)] == word[size - 1:]
        mixed = gram[inside] * odd
        out.append((((mixed ^ mixed >> np.uint32(15)) * _GRAM[2] >> shift).astype(np.int64), word[: len(gram)][inside]))
    return out


class _Words(dict):
    """Word -> local number; new words get the next one."""

    def __missing__(self, word):
        self[word] = n = len(self)
        return n


def numbered(texts: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Distinct words, number of each word of the texts, bounds of the texts."""
    known = _Words()
    ids, sizes = [np.zeros(0, np.int64)], [0]
    for t in texts:
        words = t.split()
        ids.append(np.fromiter(map(known.__getitem__, words), np.int64, len(words)))
        sizes.append(len(words))
    return list(known), np.concatenate(ids), np.cumsum(sizes)


def pair_buckets(words: list[bytes], ids: np.ndarray) -> np.ndarray:
    """Bucket of each word with the next one (the last entry is of no use)."""
    own = np.array([zlib.crc32(w, 2) for w in words], np.uint64)[ids] if len(ids) else np.zeros(0, np.uint64)
    mixed = (own * _PAIR + np.append(own[1:], own[:1])) * _PAIR
    return ((mixed >> np.uint64(33)) % np.uint64(BUCKETS)).astype(np.int64)


def features(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a text's features and how often each occurs."""
    words, ids, _ = numbered([text])
    if not words:
        return np.zeros(0, np.int32), np.zeros(0, np.float32)
    count = np.bincount(ids, minlength=len(words))
    own = word_buckets(words)
    bucket = np.concatenate([*[b for b, _ in own], pair_buckets(words, ids)[:-1]])
    weight = np.concatenate([*[count[w] for _, w in own], np.ones(len(ids) - 1, np.int64)])
    at, inverse = np.unique(bucket, return_inverse=True)
    return at.astype(np.int32), np.bincount(inverse, weight).astype(np.float32)


def train(examples: list[tuple[np.ndarray, np.ndarray, int]], epochs: int = EPOCHS, rate: float = RATE, seed: int = SEED) -> np.ndarray:
    """Stochastic gradient descent on (buckets, counts, label); returns what each bucket adds to the
    difference of the two outputs."""
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (BUCKETS, DIMENSIONS)).astype(np.float32)
    layer = np.zeros((DIMENSIONS, 2), np.float32)
    examples = [(at, w / w.sum(), y) for at, w, y in examples if len(at)]
    if len({y for *_, y in examples}) < 2:
        return np.zeros(BUCKETS)
    total, step = epochs * len(examples), 0
    for _ in range(epochs):
        for k in rng.permutation(len(examples)):
            at, w, y = examples[k]
            hidden = w @ vectors[at]
            out = hidden @ layer
            p = np.exp(out - out.max())
            p /= p.sum()
            p[y] -= 1  # gradient of the loss by the outputs
            now = rate * (1 - step / total)
            back = layer @ p
            layer -= now * np.outer(hidden, p)
            vectors[at] -= (now * len(at) ** 0.5) * np.outer(w, back)
            step += 1
    return (vectors @ (layer[:, 1] - layer[:, 0])).astype(np.float64)


def scores(texts: list[bytes], weight: np.ndarray) -> np.ndarray:
    """Probability of label 1 for each text; 0.5 without a word."""
    words, ids, bounds = numbered(texts)
    if not len(ids):
        return np.full(len(texts), 0.5)
    own = word_buckets(words)
    size = sum(np.bincount(w, minlength=len(words)) for _, w in own)
    per_word = sum(np.bincount(w, weight[b], len(words)) for b, w in own)
    doc = np.repeat(np.arange(len(texts)), np.diff(bounds))
    inside = np.append(doc[1:] == doc[:-1], False)
    value = per_word[ids] + np.where(inside, weight[pair_buckets(words, ids)], 0.0)
    total = np.bincount(doc, value, len(texts))
    count = np.bincount(doc, size[ids] + inside, len(texts))
    return 1 / (1 + np.exp(-total / np.maximum(count, 1)))


def _parts(texts: list[bytes]):
    i = 0
    while i < len(texts):
        j, size = i, 0
        while j < len(texts) and (j == i or size + len(texts[j]) <= CHUNK):
            size += len(texts[j])
            j += 1
        yield texts[i:j]
        i = j


def fit(docs: DataFrame, labels: DataFrame, training: Column, sample: int = SAMPLE) -> np.ndarray:
    """Feature weights learned from a bounded sample of the labelled training documents."""
    spark = docs.sparkSession
    marked = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    marked = marked.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & training)
    marked = marked.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    chosen = marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    chosen = spark.createDataFrame([(r["doc_id"], r["quality"]) for r in chosen.collect()], "doc_id long, quality int")
    # At most ``sample`` ids and labels: a bounded broadcast. One text an id, that of the least hash: an id
    # that is repeated counts once, and the driver gets ``sample`` examples at most.
    rows = doc_texts(docs).join(F.broadcast(chosen), "doc_id")
    rows = rows.groupBy("doc_id", "quality").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text"))["text"].alias("text"))

    def run(batches: Iterator):
        import pyarrow as pa

        for batch in batches:
            for part in slices(batch):
                found = [features(t) for t in as_bytes(part.column("text"))]
                yield pa.RecordBatch.from_pydict({
                    "doc_id": part.column("doc_id"), "quality": part.column("quality"),
                    "at": pa.array([a.tobytes() for a, _ in found], pa.binary()), "n": pa.array([n.tobytes() for _, n in found], pa.binary())})

    found = rows.mapInArrow(run, "doc_id long, quality int, at binary, n binary").toLocalIterator()
    examples = sorted(((r["doc_id"], bytes(r["at"]), bytes(r["n"]), r["quality"]) for r in found), key=lambda r: r[:2])
    return train([(np.frombuffer(a, np.int32), np.frombuffer(n, np.float32), y) for _, a, n, y in examples])


def score(docs: DataFrame, weight: np.ndarray) -> DataFrame:
    """``doc_id, score`` for every row."""
    held = docs.sparkSession.sparkContext.broadcast(weight)  # BUCKETS numbers, whatever the data

    def run(batches: Iterator):
        import pyarrow as pa

        for batch in batches:
            for part in slices(batch, 1024):
                p = np.concatenate([scores(t, held.value) for t in _parts(as_bytes(part.column("text")))])
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(p)], names=["doc_id", "score"])

    return doc_texts(docs).mapInArrow(run, "doc_id long, score double")


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Contract columns of the registered query."""
    weight = fit(docs, labels, remainder("doc_id", 4) != 2)
    return score(docs, weight).select("doc_id", held_out("doc_id", 4).alias("held_out"), "score",
                                      (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
