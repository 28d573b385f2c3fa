"""Benchmark decontamination by an FM-index per training shard.

Each task collects the words of its documents into shards of bounded size. A shard is indexed: suffix
array by prefix doubling, Burrows-Wheeler transform, wavelet matrix over the transform for symbol
ranks, and suffix positions sampled every few symbols. The test phrases are searched backwards
through the wavelet ranks, all phrases of one length at once; every occurrence is located by walking
to the nearest sampled position; the covered words are merged to removal spans.

The alphabet is the words of the benchmark. A word outside it can be part of no phrase, so it ends a
stretch of text, as the end of a document does, and a stretch shorter than the shortest phrase holds
none: only the other stretches get rows in the index. Work is proportional to the text; no shuffle.

The phrases are broadcast. Their size is checked first: a benchmark larger than ``PHRASE_WORDS`` is
dealt into several groups of items, held one at a time, and the documents pass through one search per
group, written with their hits in between: no broadcast outgrows that bound, no phrase is left out. A
text is never cut: a task needs some 30 times the bytes of its longest text.

A null text or one without words has no hit; a null item or one without words has no phrase; an item
shorter than the phrase length is one phrase. Equal rows are searched separately with equal results.
Item ids that occur twice count once. Extra columns are dropped by ``find_hits`` and kept by
``remove_hits``. A null doc_id is kept; a null item_id is searched and reported as null-free text ''."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delivery_lake.llm.common import as_bytes, as_row, doc_texts, from_row, row_column, written

#: Words of a phrase.
PHRASE = 10
#: Symbols of one shard's index, text bytes that a task holds for it at most.
SHARD_SYMBOLS = 1 << 20
SHARD_BYTES = 12 << 20
#: Most benchmark words in one broadcast.
PHRASE_WORDS = 2_000_000
#: Every so many symbols a suffix position is kept.
SAMPLE = 8
#: Most occurrences located at once.
LOCATE = 1 << 20

#: Byte map: A-Z to lower case, other ASCII but letters and digits to a space; the rest is word.
TABLE = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")

_HITS = "spans array<struct<start:int,end:int>>, items array<string>"


def words_of(text: bytes) -> list[bytes]:
    return text.translate(TABLE).split()


class Phrases:
    """Distinct phrases of some benchmark items, as arrays by length."""

    def __init__(self, items: list[tuple[str, bytes]], length: int = PHRASE):
        ids: dict[bytes, int] = {}
        owners: dict[int, dict[tuple, set]] = defaultdict(lambda: defaultdict(set))
        for item, text in items:
            w = [ids.setdefault(x, len(ids) + 1) for x in words_of(text)]
            n = min(length, len(w))
            for i in range(len(w) - n + 1 if n else 0):
                owners[n][tuple(w[i:i + n])].add(item)
        self.words = ids
        self.by_length = {n: np.array(list(p), np.int64).reshape(-1, n) for n, p in owners.items()}
        self.owners = {n: [sorted(s) for s in p.values()] for n, p in owners.items()}
        self.least = min(self.by_length, default=0)


class FMIndex:
    """FM-index of one shard: symbols 1..sigma, 0 ends every stretch."""

    def __init__(self, text: np.ndarray, sigma: int):
        n = len(text)
        self.n = n
        sa = _suffix_array(text)
        bwt = text[sa - 1]  # at 0 this is the last symbol, an end
        counts = np.bincount(text, minlength=sigma + 2)
        self.first = np.concatenate(([0], np.cumsum(counts)))[: sigma + 2]
        self.levels = []
        level = bwt
        for b in range(max(1, int(sigma).bit_length()) - 1, -1, -1):
            bit = (level >> b) & 1
            zeros = np.concatenate(([0], np.cumsum(1 - bit, dtype=np.int64))).astype(np.int32)
            self.levels.append((b, zeros, int(zeros[-1])))
            level = np.concatenate((level[bit == 0], level[bit == 1]))
        self.bwt = bwt
        self.origin = self._descend(np.arange(sigma + 1), np.zeros(sigma + 1, np.int64))
        self.sampled = (sa % SAMPLE == 0) | (bwt == 0)
        self.sample_at = np.cumsum(self.sampled) - 1
        self.samples = sa[self.sampled]

    def _descend(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        for b, zeros, total in self.levels:
            z = zeros[at]
            at = np.where((symbols >> b) & 1, total + at - z, z)
        return at

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before row ``at`` of the transform."""
        return self._descend(symbols, at) - self.origin[symbols]

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(phrase number, first row, end row) of the phrases that occur; one phrase a row."""
        which = np.arange(len(phrases))
        lo = np.zeros(len(phrases), np.int64)
        hi = np.full(len(phrases), self.n, np.int64)
        for k in range(phrases.shape[1] - 1, -1, -1):
            c = phrases[which, k]
            lo, hi = self.first[c] + self.rank(c, lo), self.first[c] + self.rank(c, hi)
            live = lo < hi
            which, lo, hi = which[live], lo[live], hi[live]
        return which, lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text position of each row of the suffix array."""
        out = np.empty(len(rows), np.int64)
        left = np.arange(len(rows))
        steps = 0
        while len(left):
            done = self.sampled[rows]
            out[left[done]] = self.samples[self.sample_at[rows[done]]] + steps
            left, rows = left[~done], rows[~done]
            c = self.bwt[rows]
            rows = self.first[c] + self.rank(c, rows)
            steps += 1
        return out


def _suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffixes in order by prefix doubling; every end symbol (0) is smaller than the next one."""
    n = len(text)
    ends = text == 0
    rank = np.where(ends, np.cumsum(ends) - 1, text + int(ends.sum())).astype(np.int64)
    step = 1
    while True:
        ahead = np.zeros(n, np.int64)
        ahead[:-step] = rank[step:] + 1
        ahead[ends] = 0
        key = rank * (int(rank.max()) + 2) + ahead
        order = np.argsort(key)
        ordered = key[order]
        new = np.concatenate(([0], np.cumsum(ordered[1:] != ordered[:-1])))
        rank[order] = new
        if new[-1] == n - 1 or step >= n:
            return order
        step *= 2


class _Shard:
    """Documents of one shard: stretches of known words, then their hits."""

    def __init__(self, phrases: Phrases):
        self.phrases = phrases
        self.parts: list[np.ndarray] = []
        self.places: list[tuple[int, int, int]] = []  # document, first word, symbols before
        self.symbols = 0
        self.bytes = 0
        self.n_words: list[int] = []

    def add(self, text: bytes) -> None:
        words = words_of(text)
        doc = len(self.n_words)
        self.n_words.append(len(words))
        self.bytes += len(text)
        least = self.phrases.least
        if not least or len(words) < least:
            return
        ids = np.fromiter(map(self.phrases.words.get, words, _zeros()), np.int64, len(words))
        cut = np.flatnonzero(ids == 0)
        starts = np.concatenate(([0], cut + 1))
        ends = np.concatenate((cut, [len(ids)]))
        long = ends - starts >= least
        for a, b in zip(starts[long].tolist(), ends[long].tolist()):
            self.places.append((doc, a, self.symbols))
            self.parts += [ids[a:b], _END]
            self.symbols += b - a + 1

    def hits(self) -> tuple[list, list]:
        """Merged spans (word numbers, end exclusive) and item ids, for each document."""
        spans: list = [[] for _ in self.n_words]
        items: list = [set() for _ in self.n_words]
        if not self.places:
            return spans, items
        text = np.concatenate(self.parts)
        index = FMIndex(text, len(self.phrases.words))
        place = np.array(self.places, np.int64)
        cover = np.zeros(len(text) + 1, np.int32)
        for n, phrases in self.phrases.by_length.items():
            which, lo, hi = index.search(phrases)
            for i, j in _groups(hi - lo, LOCATE):
                size = (hi - lo)[i:j]
                rows = np.repeat(lo[i:j] - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(size.sum())
                at = index.locate(rows)
                np.add.at(cover, at, 1)
                np.add.at(cover, at + n, -1)
                doc = place[np.searchsorted(place[:, 2], at, side="right") - 1, 0]
                pairs = np.unique(doc * len(phrases) + np.repeat(which[i:j], size))
                for d, p in zip((pairs // len(phrases)).tolist(), (pairs % len(phrases)).tolist()):
                    items[d].update(self.phrases.owners[n][p])
        hit = np.cumsum(cover[:-1]) > 0
        edge = np.flatnonzero(np.diff(np.concatenate(([0], hit.view(np.int8), [0]))))
        starts, ends = edge[::2], edge[1::2]
        at = np.searchsorted(place[:, 2], starts, side="right") - 1
        for d, a, b in zip(place[at, 0].tolist(), (place[at, 1] + starts - place[at, 2]).tolist(), (place[at, 1] + ends - place[at, 2]).tolist()):
            spans[d].append((a, b))
        return spans, items


_END = np.zeros(1, np.int64)


def _zeros():
    while True:
        yield 0


def _groups(sizes: np.ndarray, most: int):
    """Ranges of consecutive phrases with about ``most`` occurrences each."""
    total = np.concatenate(([0], np.cumsum(sizes)))
    i = 0
    while i < len(sizes):
        j = max(i + 1, int(np.searchsorted(total, total[i] + most, side="right")) - 1)
        yield i, j
        i = j


def _merge(old: list, new: list) -> list:
    out: list = []
    for a, b in sorted([*old, *new]):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _search(phrases, batches: Iterator):
    """Add the hits of some phrases to rows (.., text, .., n_words, spans, items)."""
    import pyarrow as pa

    phrases = phrases.value
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def done(held, shard):
        spans, items = shard.hits()
        k = 0
        for batch in held:
            n = batch.num_rows
            had = zip(batch.column("spans").to_pylist(), batch.column("items").to_pylist())
            both = [(_merge([(s["start"], s["end"]) for s in a], x), sorted(set(b) | y)) for (a, b), x, y in zip(had, spans[k:k + n], items[k:k + n])]
            put = {"n_words": pa.array(shard.n_words[k:k + n], pa.int64()),
                   "spans": pa.array([[{"start": a, "end": b} for a, b in x] for x, _ in both], span),
                   "items": pa.array([y for _, y in both], pa.list_(pa.string()))}
            yield pa.RecordBatch.from_arrays([put.get(c, batch.column(c)) for c in batch.schema.names], names=batch.schema.names)
            k += n

    held, shard = [], _Shard(phrases)
    for batch in batches:
        for i in range(0, batch.num_rows, 128):
            part = batch.slice(i, 128)
            for text in as_bytes(row_column(part, "text")):
                shard.add(text)
            held.append(part)
            if shard.symbols >= SHARD_SYMBOLS or shard.bytes >= SHARD_BYTES:
                yield from done(held, shard)
                held, shard = [], _Shard(phrases)
    if held:
        yield from done(held, shard)


def phrase_groups(benchmark: DataFrame, length: int = PHRASE, most_words: int = PHRASE_WORDS) -> Iterator[Phrases]:
    """The benchmark's phrases in groups of items, each of about ``most_words`` (a lone larger item is a
    group of its own), one after the other: the driver holds one. Equal rows are one item; the items are
    written with their groups, so each group is read by itself."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
                             F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).distinct()
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    groups = max(1, -(-int(chars) // (4 * most_words)))
    if groups > 1:
        items = written(items.withColumn("group", F.pmod(F.xxhash64("item", "text"), F.lit(groups))), "phrases")
    for g in range(groups):
        rows = (items.where(F.col("group") == g) if groups > 1 else items).toLocalIterator()
        yield Phrases(sorted((r["item"], r["text"].encode()) for r in rows), length)


def search(docs: DataFrame, benchmark: DataFrame, length: int = PHRASE, most_words: int = PHRASE_WORDS) -> DataFrame:
    """All columns of ``docs`` (``text``, or ``row`` with a field of this name) with n_words, spans, items.

    Between groups of phrases the rows with their hits so far are written to the shared folder, so a task
    holds one group too; the benchmark usually is one group, and nothing is written."""
    out = docs.withColumns({"n_words": F.lit(0).cast("long"), "spans": F.expr("cast(array() as array<struct<start:int,end:int>>)"),
                            "items": F.expr("cast(array() as array<string>)")})
    held = None
    for phrases in phrase_groups(benchmark, length, most_words):
        if held is not None:
            out = written(out, "hits")
            held.unpersist()
        held = docs.sparkSession.sparkContext.broadcast(phrases)
        out = out.mapInArrow(lambda batches, held=held: _search(held, batches), out.schema)
    return out


def find_hits(docs: DataFrame, benchmark: DataFrame, length: int = PHRASE, most_words: int = PHRASE_WORDS) -> DataFrame:
    """``doc_id, n_words, spans, items`` for every row: merged spans of hit words (word numbers, end
    exclusive) and the ids, as text, of the items with a phrase in the document."""
    return search(doc_texts(docs), benchmark, length, most_words).drop("text")


def without_words(text: str, spans: list) -> str:
    """The text without the words of the spans and what stands between words of one span."""
    data = text.encode()
    places = [m.span() for m in WORD.finditer(data)]
    out, at = [], 0
    for s in spans:
        a, b = places[s["start"]][0], places[s["end"] - 1][1]
        out.append(data[at:a])
        at = b
    return b"".join([*out, data[at:]]).decode()


def remove_hits(docs: DataFrame, benchmark: DataFrame, length: int = PHRASE) -> DataFrame:
    """The documents, all columns, with the removal spans cut from ``text``; ``n_chars`` follows where
    it exists. No row is dropped; texts without a hit are unchanged, null texts stay null."""
    import pyarrow as pa

    packed = as_row(docs)

    def cut(batches):
        for batch in batches:
            texts, spans = row_column(batch, "text").to_pylist(), batch.column("spans").to_pylist()
            new = [without_words(t, s) if s else t for t, s in zip(texts, spans)]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(new, pa.string())], names=["row", "new"])

    found = search(packed, benchmark, length).select("row", "spans")
    out = found.mapInArrow(cut, packed.withColumn("new", F.lit(None).cast("string")).schema)
    new = {"text": F.col("new")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.col("new").isNull(), F.col("row.n_chars")).otherwise(F.length("new"))
    return out.select(*from_row(out, docs, **new))


def digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Contract columns of the registered query."""
    hits = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return find_hits(docs, benchmark).select(
        "doc_id", "n_words", hits.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("items")), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"))
