"""Language identification with hyperdimensional profiles.

Each letter has a random vector of +1 and -1 drawn from a generator keyed by the letter. A trigram's
vector binds its letters: the first letter's vector rotated twice, times the second's rotated once,
times the third's. A document's vector bundles (adds) the vectors of its trigrams; a language's
prototype bundles all its training documents. A document gets the language whose prototype has the
highest cosine.

Letters are lower-cased; everything else counts as one space, so trigrams know word edges. A trigram
needs a letter in its middle. Training sums trigram counts per language on Spark, so what reaches the
driver is one vector per language.

Learned only from the text and language of training documents with both. A text that is null or has no
letter gets ``und`` with score 0, as does every text if nothing was learned. Ties go to the language
first in order. Equal rows get equal results; extra columns are ignored by ``predict`` and kept by
``keep_identified``. A null doc_id is kept (it is never trained on by the registered query). A text is
never cut; letters of any script are drawn when first met."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delivery_lake.llm.common import as_row, from_row, held_out, mix64, modest_batches, remainder, row_column, slices

#: Dimensions of the vectors, seed of the letters' vectors.
DIMENSIONS = 512
SEED = 20240607
#: Most trigram vectors a task keeps; beyond, it starts again (a cache, not a limit on trigrams).
CACHE = 30_000
#: Most documents, characters and count cells in one numpy step.
ROWS, CHARS, CELLS = 128, 1 << 18, 1 << 20
#: A document whose best cosine is below this is rejected by the filter.
LEAST_SCORE = 0.1


@lru_cache(maxsize=1)
def is_letter() -> np.ndarray:
    """For every code point, whether it is a letter."""
    return np.array([chr(i).isalpha() for i in range(0x110000)])


class Trigrams:
    """Trigram counts of texts, and the trigrams' vectors."""

    def __init__(self, dimensions: int = DIMENSIONS, seed: int = SEED):
        self.dimensions, self.seed = dimensions, seed
        self.letters = is_letter()
        self.points = np.zeros(0, np.int64)  # letters met so far, sorted
        self.letter_vectors = np.zeros((0, dimensions), np.float32)
        self.clear()

    def clear(self) -> None:
        self.known = np.zeros(0, np.uint64)  # trigrams, sorted
        self.vectors = np.zeros((0, self.dimensions), np.float32)

    def drawn(self, points: np.ndarray) -> np.ndarray:
        """Vectors of letters: 64 dimensions from each number of a generator keyed by seed and letter."""
        words = np.arange(-(-self.dimensions // 64), dtype=np.uint64)
        key = mix64(points.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(self.seed))
        drawn = mix64(key[:, None] + words * np.uint64(0xC2B2AE3D27D4EB4F))
        bits = np.unpackbits(drawn.view(np.uint8), axis=1, bitorder="little")[:, :self.dimensions]
        return bits.astype(np.float32) * 2 - 1

    def letter(self, point: int) -> np.ndarray:
        return self.drawn(np.array([point]))[0]

    def _places(self, points: np.ndarray) -> np.ndarray:
        """Rows of ``letter_vectors`` for letters; new ones are drawn."""
        new = np.setdiff1d(points, self.points)
        if len(new) and len(self.points) + len(new) > CACHE:  # a cache as well
            self.points, self.letter_vectors, new = np.zeros(0, np.int64), np.zeros((0, self.dimensions), np.float32), np.unique(points)
        if len(new):
            both = np.concatenate((self.points, new))
            order = np.argsort(both)
            self.letter_vectors = np.concatenate((self.letter_vectors, self.drawn(new)))[order]
            self.points = both[order]
        return np.searchsorted(self.points, points)

    def bound(self, grams: np.ndarray) -> np.ndarray:
        """Vectors of some trigrams (three code points of 21 bits in one number)."""
        mask = np.uint64((1 << 21) - 1)
        three = [(grams >> np.uint64(s) & mask).astype(np.int64) for s in (42, 21, 0)]
        letters, number = np.unique(np.concatenate(three), return_inverse=True)
        at = self._places(letters)
        vectors = self.letter_vectors[at]
        x, y, z = number.reshape(3, -1)
        out = np.roll(vectors, 2, axis=1)[x]
        out *= np.roll(vectors, 1, axis=1)[y]
        out *= vectors[z]
        return out

    def learn(self, grams: np.ndarray) -> None:
        if len(self.known) + len(grams) > CACHE:
            self.clear()
        new = np.setdiff1d(grams, self.known)
        known = np.concatenate((self.known, new))
        order = np.argsort(known)
        self.vectors = np.concatenate((self.vectors, self.bound(new)))[order]
        self.known = known[order]

    def grams(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Trigrams of the texts one after the other, and the number of the text each is in."""
        low = [f" {t.lower()} " for t in texts]
        points = np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), np.uint32)
        points = np.where(self.letters[points], points, 32).astype(np.uint64)
        doc = np.repeat(np.arange(len(low)), [len(t) for t in low])
        middle = (points[1:-1] != 32) & (doc[1:-1] == doc[:-2]) & (doc[1:-1] == doc[2:])
        code = (points[:-2] << np.uint64(42)) | (points[1:-1] << np.uint64(21)) | points[2:]
        return code[middle], doc[1:-1][middle]

    def numbered(self, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct trigrams and the number of each given one, by a table over the letters in use."""
        used = np.zeros(1 << 21, bool)
        mask = np.uint64((1 << 21) - 1)
        three = [(code >> np.uint64(s) & mask).astype(np.int64) for s in (42, 21, 0)]
        for x in three:
            used[x] = True
        letters = np.flatnonzero(used)
        k = len(letters)
        if k > 200:  # many scripts at once: sort instead of a table
            return np.unique(code, return_inverse=True)
        small = np.zeros(1 << 21, np.int64)
        small[letters] = np.arange(k)
        cell = (small[three[0]] * k + small[three[1]]) * k + small[three[2]]
        there = np.zeros(k ** 3, bool)
        there[cell] = True
        cells = np.flatnonzero(there)
        number = np.cumsum(there) - 1
        point = letters.astype(np.uint64)
        grams = (point[cells // (k * k)] << np.uint64(42)) | (point[cells // k % k] << np.uint64(21)) | point[cells % k]
        return grams, number[cell]

    def documents(self, texts: list[str]) -> np.ndarray:
        """The bundled vector of each text (zero without a letter)."""
        code, doc = self.grams(texts)
        out = np.zeros((len(texts), self.dimensions), np.float32)
        if not len(code):
            return out
        grams, number = self.numbered(code)
        for a in range(0, len(grams), CACHE // 2):  # one turn but for texts of very many trigrams
            own = grams[a:a + CACHE // 2]
            at = self._rows(own)
            here = (number >= a) & (number < a + len(own)) if len(grams) > len(own) else slice(None)
            each = max(1, CELLS // len(own))
            d, g = doc[here], number[here] - a
            for i in range(0, len(texts), each):
                j = min(len(texts), i + each)
                lo, hi = np.searchsorted(d, [i, j])
                counts = np.bincount((d[lo:hi] - i) * len(own) + g[lo:hi], minlength=(j - i) * len(own))
                out[i:j] += counts.reshape(j - i, len(own)).astype(np.float32) @ self.vectors[at]
        return out

    def _rows(self, grams: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.known, grams)
        if len(self.known) == 0 or not (self.known[np.minimum(at, len(self.known) - 1)] == grams).all():
            self.learn(grams)
            at = np.searchsorted(self.known, grams)
        return at


def steps(texts: list[str]) -> Iterator[slice]:
    """Slices of at most ROWS texts with about CHARS characters."""
    i = 0
    while i < len(texts):
        j, size = i, 0
        while j < len(texts) and j - i < ROWS and (j == i or size + len(texts[j]) <= CHARS):
            size += len(texts[j])
            j += 1
        yield slice(i, j)
        i = j


def train(docs: DataFrame, training: Column, dimensions: int = DIMENSIONS, seed: int = SEED) -> tuple[list[str], np.ndarray]:
    """Languages, in order, and their unit prototype vectors, from the rows where ``training`` holds."""
    rows = modest_batches(docs).where(training & F.col("lang").isNotNull() & F.col("text").isNotNull()).select(
        F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))

    def run(batches):
        import pyarrow as pa

        model = Trigrams(dimensions, seed)
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for part in slices(batch):
                texts, langs = part.column("text").to_pylist(), part.column("lang").to_pylist()
                for s in steps(texts):
                    for lang, v in zip(langs[s], model.documents(texts[s])):
                        if lang not in sums:
                            sums[lang] = np.zeros(dimensions)
                        sums[lang] += v
                if len(sums) > 1000:
                    yield pa.RecordBatch.from_pydict({"lang": list(sums), "v": list(sums.values())})
                    sums = {}
        if sums:
            yield pa.RecordBatch.from_pydict({"lang": list(sums), "v": list(sums.values())})

    # A few rows per task: one per language. Vectors are added value by value.
    partial = rows.mapInArrow(run, "lang string, v array<double>")
    summed = partial.select("lang", F.posexplode("v")).groupBy("lang", "pos").agg(F.sum("col").alias("col"))
    vectors: dict[str, np.ndarray] = {}
    for r in summed.collect():  # languages times dimensions
        vectors.setdefault(r["lang"], np.zeros(dimensions))[r["pos"]] = r["col"]
    langs = sorted(x for x, v in vectors.items() if v.any())
    if not langs:
        return [], np.zeros((0, dimensions))
    return langs, np.stack([vectors[x] / np.linalg.norm(vectors[x]) for x in langs])


def _predicted(docs: DataFrame, langs: list[str], prototypes: np.ndarray, keep: list[str], seed: int = SEED) -> DataFrame:
    """``row`` (the columns ``keep`` and the text), ``lang_pred``, ``score``."""
    rows = as_row(docs, list(dict.fromkeys([*keep, "text"])))
    schema = rows.withColumns({"lang_pred": F.lit(""), "score": F.lit(0.0)}).schema

    def run(batches):
        import pyarrow as pa

        model = Trigrams(prototypes.shape[1], seed)
        for batch in batches:
            for part in slices(batch):
                texts = [t or "" for t in row_column(part, "text").to_pylist()]
                pred, score = [], []
                for s in steps(texts):
                    v = model.documents(texts[s])
                    size = np.sqrt((v.astype(np.float64) ** 2).sum(axis=1))
                    for x, n in zip(v.astype(np.float64) @ prototypes.T, size.tolist()):
                        k = int(x.argmax()) if len(langs) and n else -1
                        pred.append(langs[k] if k >= 0 else "und")
                        score.append(min(1.0, max(0.0, float(x[k]) / n)) if k >= 0 else 0.0)
                yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(pred, pa.string()), pa.array(score, pa.float64())],
                                                 names=["row", "lang_pred", "score"])

    return rows.mapInArrow(run, schema)


def predict(docs: DataFrame, langs: list[str], prototypes: np.ndarray, keep: list[str] | None = None, seed: int = SEED) -> DataFrame:
    """The columns ``keep`` (all by default) with ``lang_pred`` and ``score`` (cosine, 0 to 1)."""
    keep = docs.columns if keep is None else keep
    found = _predicted(docs, langs, prototypes, keep, seed)
    return found.select(*[F.col(f"row.`{c}`").cast(docs.schema[c].dataType).alias(c) for c in keep], "lang_pred", "score")


def training_rows(doc_id: str = "doc_id") -> Column:
    """Documents to learn from: a known remainder that is not 2."""
    return remainder(doc_id, 4) != 2


def keep_identified(docs: DataFrame, least_score: float = LEAST_SCORE) -> DataFrame:
    """The documents, all columns, without those whose language is not recognised: no letter, or a best
    cosine under ``least_score``."""
    langs, prototypes = train(docs, training_rows())
    found = _predicted(docs, langs, prototypes, docs.columns)
    kept = found.where((F.col("lang_pred") != "und") & (F.col("score") >= least_score))
    return kept.select(*from_row(kept, docs))


def digest(docs: DataFrame) -> DataFrame:
    """Contract columns of the registered query."""
    langs, prototypes = train(docs, training_rows())
    found = predict(docs, langs, prototypes, ["doc_id"])
    return found.select("doc_id", held_out("doc_id", 4).alias("held_out"), "lang_pred", "score")
