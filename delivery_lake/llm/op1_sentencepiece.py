"""SentencePiece encoding and decoding with seeded merge-dropout.

The pieces and their scores come from a SentencePiece BPE model; nothing is trained. A text is cut where
a space mark follows another character and around line breaks, as no piece of such a model spans these
places, and each segment is merged by itself: an agenda holds the neighbouring pairs that form a piece, the best score first,
then the leftmost. With dropout, each candidate taken from the agenda is skipped if a keyed hash of
(seed, document id, the segment's place in the document, place in the segment, piece) falls below the
rate: every occurrence is segmented by itself, and the same input always gives the same segmentation, on
any executor. Without dropout the result is that of the SentencePiece library.

What a segment becomes depends only on which of its candidates are skipped. So a task keeps, for the
segments it has met repeatedly, the candidates that are taken with none skipped; an occurrence tests its
own hashes along them, and is merged by itself only where one is skipped. Nothing is shared between
occurrences but this.

Bytes fall back for characters without a piece. A space mark that is part of the
text itself is written as bytes, so decoding gives back exactly the text, whatever it holds.

A null text has null ids; an empty one has none. A null doc_id counts as id 0. Equal rows
get equal ids. Extra columns are ignored by ``digest`` and kept by ``encode``."""

from __future__ import annotations

import hashlib
import heapq
import re
import struct
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delivery_lake.llm.common import as_row, doc_texts, modest_batches, row_column, slices

#: Model file, dropout rate, seed.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
DROPOUT, SEED = 0.1, 20240801
#: Segments whose merge paths a task keeps about (a cache: cleared when full, not a limit on segments).
CACHE = 250_000

MARK = "▁"
#: A mark of the text itself as a segment (no other segment ends in a mark after another character).
OWN_MARK = "\0" + MARK
SEGMENT = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
SEGMENT_OF_LINE = re.compile(f"\n|{MARK}*[^{MARK}\n]+|{MARK}+")
#: Segments up to this length are merged many at once, one agenda step of each per numpy step; longer
#: ones, and those with characters of no piece, one by one with a heap.
SHORT = 48
#: Segments merged together have about one length, and are so many that their tables (a column each, a
#: row for each place) stay small.
LENGTHS, COLUMNS = (6, 9, 12, 16, 24, SHORT), 1 << 14
#: Rank of a pair that is no candidate.
NO_PAIR = 0x7FFFFFFF
#: Characters whose segments are looked up together.
GROUP = 1 << 20
_PAIR = 0x9E3779B97F4A7C15


class Pieces:
    """The pieces of a model and both directions between text and ids."""

    def __init__(self, model: bytes):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.size = sp.get_piece_size()
        self.piece = [sp.id_to_piece(i) for i in range(self.size)]
        self.score = [sp.get_score(i) for i in range(self.size)]
        self.byte = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        plain = [i for i in range(self.size) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.id = {self.piece[i]: i for i in plain}
        self.rank = {self.piece[i]: -self.score[i] for i in plain}
        # What each id decodes to, as bytes.
        self.out = [self.piece[i].replace(MARK, " ").encode() for i in range(self.size)]
        for b, i in enumerate(self.byte):
            self.out[i] = bytes([b])
        self._forget()
        chars = sorted({c for p in self.id for c in p})
        self.segment = SEGMENT if "\n" in chars else SEGMENT_OF_LINE
        self._prepare(chars)

    def _forget(self) -> None:
        """Empties the cache of merge paths: each has the candidates that are taken where none is skipped
        (place and piece in one number, from ``start`` on) and the ids that result."""
        self.roots: dict[str, int] = {}
        self.ids_of: list[bytes] = []
        self.start, self.count = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.taken = np.zeros(0, np.uint64)

    def _prepare(self, chars: list[str]) -> None:
        """Tables for merging many segments: symbols are pieces, and characters that only occur in
        pieces; each pair that forms a piece is in a hash table."""
        symbol = self.id | {c: self.size + k for k, c in enumerate(c for c in chars if c not in self.id)}
        self.symbol_of = np.full(0x110000, -1, np.int32)
        for c in chars:
            self.symbol_of[ord(c)] = symbol[c]
        pairs = {(symbol[p[:k]] << 32) | symbol[p[k:]]: i for p, i in self.id.items() for k in range(1, len(p))
                 if p[:k] in symbol and p[k:] in symbol}
        self.bits = max(10, (4 * len(pairs)).bit_length())
        self.keys, self.merged = np.zeros(1 << self.bits, np.uint64), np.full(1 << self.bits, -1, np.int32)
        for key, i in pairs.items():
            at = ((key ^ (key >> 17)) * _PAIR & 0xFFFFFFFFFFFFFFFF) >> (64 - self.bits)
            while self.merged[at] >= 0:
                at = (at + 1) & ((1 << self.bits) - 1)
            self.keys[at], self.merged[at] = key, i
        # equal scores have one rank; a place in a segment fits in the six bits below; the last entry: no piece
        order = {r: k << 6 for k, r in enumerate(sorted(set(self.rank.values())))}
        self.ranks = np.full(self.size + 1, NO_PAIR, np.int32)
        for p, i in self.id.items():
            self.ranks[i] = order[self.rank[p]]

    def _find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Piece that two symbols form, -1 for none."""
        key = (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)
        at = ((key ^ (key >> np.uint64(17))) * np.uint64(_PAIR) >> np.uint64(64 - self.bits)).astype(np.int64)
        out = np.where(self.keys[at] == key, self.merged[at], -1)
        todo = np.flatnonzero((out < 0) & (self.merged[at] >= 0))  # another pair is there
        key, at = key[todo], at[todo]
        while len(todo):
            at = (at + 1) & ((1 << self.bits) - 1)
            out[todo] = np.where(self.keys[at] == key, self.merged[at], -1)
            more = (out[todo] < 0) & (self.merged[at] >= 0)
            todo, key, at = todo[more], key[more], at[more]
        return out

    def segments(self, text: str) -> list[str]:
        """The marked text in segments: each begins with marks, if any, and has no mark after another
        character. A mark in front stands for the added leading space."""
        if not text:
            return []
        if MARK in text:
            return self._odd_segments(text)
        if "  " in text or text[0] == " " or self.segment is SEGMENT:
            return self.segment.findall(MARK + text.replace(" ", MARK))
        # One space between words: the same segments, without a pattern.
        return list(filter(None, (MARK + text.replace(" ", " " + MARK)).replace("\n", " \n ").split(" ")))

    def _odd_segments(self, text: str) -> list[str]:
        """As ``segments`` for a text with marks of its own: each becomes a segment apart."""
        out: list[str] = []
        for i, part in enumerate(text.split(MARK)):
            if i:
                out.append(OWN_MARK)
            out += self.segment.findall((MARK if i == 0 else "") + part.replace(" ", MARK))
        return out

    def merge(self, segment: str, dropout: float = 0.0, seed: int = 0, doc_id: int = 0, place: int = 0) -> tuple[int, ...]:
        """Ids of one segment, the one at ``place`` in a document, by agenda merging."""
        limit = int(dropout * 4294967296)
        return self._merge_one(segment, limit, _key_of(seed, doc_id, place) if limit else 0)

    def _merge_one(self, segment: str, limit: int, key: int, trace: list | None = None) -> tuple[int, ...]:
        if segment == OWN_MARK:
            return tuple(self.byte[b] for b in MARK.encode())
        ids = self.id
        out: list[int] = []
        for s in self._merge_heap(segment, limit, key, trace):
            i = ids.get(s)
            if i is None:
                out += [self.byte[b] for b in s.encode("utf-8", "surrogatepass")]
            else:
                out.append(i)
        return tuple(out)

    def _merge_heap(self, segment: str, limit: int, key: int, trace: list | None) -> list[str]:
        """Symbols of a segment. The candidates that are merged are added to ``trace``."""
        rank = self.rank
        symbols = list(segment)
        n = len(symbols)
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        agenda = [(rank[x], i, i + 1, x) for i in range(n - 1) if (x := symbols[i] + symbols[i + 1]) in rank]
        heapq.heapify(agenda)
        while agenda:
            _, i, j, new = heapq.heappop(agenda)
            if after[i] != j or not symbols[i] or symbols[i] + symbols[j] != new:
                continue  # one side has been merged meanwhile
            if limit and _skipped(key, i, self.id[new], limit):
                continue
            if trace is not None:
                trace.append((i << 16) ^ self.id[new])
            symbols[i], symbols[j] = new, ""
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (x := new + symbols[k]) in rank:
                    heapq.heappush(agenda, (rank[x], i, k, x))
            h = before[i]
            if h >= 0 and (x := symbols[h] + new) in rank:
                heapq.heappush(agenda, (rank[x], h, i, x))
        return [s for s in symbols if s]

    def merge_many(self, wanted: list[tuple], dropout: float, seed: int) -> list[bytes]:
        """``merge`` of many (segment, doc_id) or (segment, doc_id, place), ids as little-endian 32-bit
        numbers."""
        limit = int(dropout * 4294967296)
        keys = np.array([_key_of(seed, *w[1:]) if limit else 0 for w in wanted], np.uint64)
        return self._merge_many([w[0] for w in wanted], limit, keys)[0]

    def _merge_many(self, segments: list[str], limit: int, keys: np.ndarray, trace: bool = False):
        """Ids of many segments. With ``trace`` the candidates that are merged, by segment, and the starts
        and numbers of each segment's are given as well."""
        out: list = [b""] * len(segments)
        size = np.fromiter(map(len, segments), np.int64, len(segments))
        single = np.flatnonzero(size > SHORT).tolist()
        taken_of, taken = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
        for low, high in zip((0, *LENGTHS), LENGTHS):
            alike = np.flatnonzero((size > low) & (size <= high))
            for begin in range(0, len(alike), COLUMNS):
                number = alike[begin:begin + COLUMNS]
                points = np.frombuffer("".join([segments[k] for k in number.tolist()]).encode("utf-32-le", "surrogatepass"), np.uint32)
                symbol = self.symbol_of[points].astype(np.int64)
                odd = np.bincount(np.repeat(np.arange(len(number)), size[number])[symbol < 0], minlength=len(number)) > 0
                if odd.any():
                    single += number[odd].tolist()
                    symbol = symbol[np.repeat(~odd, size[number])]
                    number = number[~odd]
                if not len(number):
                    continue
                left, count, column, candidate = self._merge_table(symbol, size[number], limit, keys[number], trace)
                ids, bounds = left.astype("<i4").tobytes(), np.cumsum(4 * count).tolist()
                for k, i, j in zip(number.tolist(), [0, *bounds], bounds):
                    out[k] = ids[i:j]
                taken_of.append(number[column])
                taken.append(candidate)
        for k in single:
            path: list[int] = []
            out[k] = np.array(self._merge_one(segments[k], limit, int(keys[k]), path), "<i4").tobytes()
            taken_of.append(np.full(len(path), k))
            taken.append(np.array(path, np.uint64))
        if not trace:
            return out, None, None, None
        taken_of = np.concatenate(taken_of)
        count = np.bincount(taken_of, minlength=len(segments))
        return out, np.concatenate(taken)[np.argsort(taken_of, kind="stable")], np.cumsum(count) - count, count

    def _merge_table(self, symbol: np.ndarray, size: np.ndarray, limit: int, keys: np.ndarray, trace: bool):
        """Symbols left of some short segments and their numbers, given the symbols of their characters.

        A segment is a column, a symbol is in the row of its first place, with the rows of the symbols before
        and after it and the rank of the pair with the latter (a skipped pair has none). A step merges each
        column's pair of the least rank, the leftmost of equals. One more row stands for what is beyond a
        segment's ends. With ``trace``, the column and number of each merge are given as well."""
        n, rows = len(size), int(size.max())
        column = np.repeat(np.arange(n), size)
        row = np.arange(len(column)) - np.repeat(np.cumsum(size) - size, size)
        symbols = np.full((rows + 1) * n, -1, np.int64)
        symbols[row * n + column] = symbol
        after, before = np.repeat(np.arange(1, rows + 2), n), np.repeat(np.arange(-1, rows), n)
        after[(size - 1) * n + np.arange(n)] = before[:n] = rows
        piece, rank = np.full((rows + 1) * n, -1, np.int32), np.full((rows + 1) * n, NO_PAIR, np.int32)
        merged_in, merged = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]

        def pair(row, column, left, right):
            new = self._find(left, right)
            value = self.ranks[new] | row  # no piece: all bits are set already
            if limit:
                value[_keyed(keys[column], (row.astype(np.uint64) << np.uint64(16)) ^ new.astype(np.uint64)) < limit] = NO_PAIR
            piece[row * n + column], rank[row * n + column] = new, value

        inner = np.flatnonzero(column[1:] == column[:-1])
        pair(row[inner], column[inner], symbol[inner], symbol[inner + 1])
        while True:
            least = rank[:rows * n].reshape(rows, n).min(axis=0)
            column = np.flatnonzero(least != NO_PAIR)
            if not len(column):
                break
            row = (least[column] & 63).astype(np.int64)
            at = row * n + column
            new = piece[at].astype(np.int64)
            if trace:
                merged_in.append(column)
                merged.append((row.astype(np.uint64) << np.uint64(16)) ^ new.astype(np.uint64))
            gone = after[at] * n + column
            right, left = after[gone], before[at]
            symbols[at], symbols[gone], rank[gone] = new, -1, NO_PAIR
            after[at], before[right * n + column] = right, row
            pair(np.concatenate((row, left)), np.concatenate((column, column)),
                 np.concatenate((new, symbols[left * n + column])), np.concatenate((symbols[right * n + column], new)))
        table = symbols[:rows * n].reshape(rows, n).T
        held = table >= 0
        return table[held], held.sum(axis=1), np.concatenate(merged_in), np.concatenate(merged)

    def _paths_of(self, segments: list[str], limit: int) -> np.ndarray:
        """Number of the kept path of each segment, -1 for none. Paths of segments that are there twice or
        more are added; long ones hardly ever are without a skip."""
        find = lambda some: np.fromiter(map(self.roots.get, some, repeat(-1)), np.int64, len(some))
        path = find(segments)
        unknown = np.flatnonzero(path < 0)
        missing = [segments[k] for k in unknown.tolist()]
        new = [s for s, n in Counter(missing).items() if n > 1 and (not limit or len(s) <= SHORT)]
        if self.ids_of and len(self.ids_of) + len(new) > CACHE:
            self._forget()
            return self._paths_of(segments, limit)
        if new:
            ids, taken, start, count = self._merge_many(new, 0, np.zeros(len(new), np.uint64), trace=True)
            self.roots.update(zip(new, range(len(self.ids_of), len(self.ids_of) + len(new))))
            self.ids_of += ids
            self.start = np.concatenate((self.start, start + len(self.taken)))
            self.count = np.concatenate((self.count, count))
            self.taken = np.concatenate((self.taken, taken))
            path[unknown] = find(missing)
        return path

    def encode_many(self, texts: list[str], docs: list[int], dropout: float = DROPOUT, seed: int = SEED) -> list[np.ndarray]:
        """Ids of some texts, as arrays of 32-bit numbers."""
        limit = int(dropout * 4294967296)
        split = [self.segments(t) for t in texts]
        flat = [s for x in split for s in x]
        path = self._paths_of(flat, limit)
        keys = np.zeros(len(flat), np.uint64)
        if limit and flat:
            keys = np.concatenate([occurrence_keys(d, len(x), seed) for d, x in zip(docs, split)])
            known = np.flatnonzero(path >= 0)
            size, start = self.count[path[known]], self.start[path[known]]
            of = np.repeat(known, size)
            candidate = self.taken[np.arange(len(of)) + np.repeat(start - np.cumsum(size) + size, size)]
            path[of[_keyed(keys[of], candidate) < limit]] = -1  # one is skipped
        alone = np.flatnonzero(path < 0)
        ids = list(map([*self.ids_of, b""].__getitem__, path.tolist()))
        for k, x in zip(alone.tolist(), self._merge_many([flat[k] for k in alone.tolist()], limit, keys[alone])[0]):
            ids[k] = x
        out, i = [], 0
        for x in split:
            out.append(np.frombuffer(b"".join(ids[i:i + len(x)]), "<i4"))
            i += len(x)
        return out

    def encode(self, text: str, doc_id: int = 0, dropout: float = DROPOUT, seed: int = SEED) -> list[int]:
        """Ids of a text."""
        return self.encode_many([text], [doc_id], dropout, seed)[0].tolist()

    def decode(self, ids) -> str:
        """The text of some ids, without the added leading space."""
        out = self.out
        data = b"".join([out[i] for i in ids])
        return (data[1:] if data[:1] == b" " else data).decode("utf-8", "surrogatepass")


def _key_of(seed: int, doc_id: int, place: int = 0) -> int:
    """Key of the candidates of one occurrence: the segment at a place in a document."""
    return int(occurrence_keys(doc_id, place + 1, seed)[place])


def _keyed(key, candidate):
    """32-bit hash of candidate merges under their keys (arrays of 64-bit numbers)."""
    x = (key ^ candidate) * np.uint64(0x9E3779B97F4A7C15)
    return ((x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(32)


def _skipped(key: int, place: int, piece: int, limit: int) -> bool:
    """Whether one candidate is skipped: ``_keyed`` in plain numbers."""
    x = (key ^ (place << 16) ^ piece) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF
    return ((x ^ (x >> 29)) * 0xBF58476D1CE4E5B9 & 0xFFFFFFFFFFFFFFFF) >> 32 < limit


@lru_cache(maxsize=2)
def pieces_of(model: bytes) -> Pieces:
    """The pieces of a model, kept by a worker process from task to task."""
    return Pieces(model)


def occurrence_keys(doc_id: int, n: int, seed: int) -> np.ndarray:
    """64-bit key of each of the n segments of a document."""
    key = int.from_bytes(hashlib.blake2b(struct.pack("<qq", seed, doc_id), digest_size=8).digest(), "little")
    x = np.arange(n, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(key)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def load_model(path: str = MODEL) -> bytes:
    """The model file's bytes, read on the driver (half a megabyte) and sent along with the tasks."""
    with open(path, "rb") as f:
        return f.read()


def groups(texts: list) -> Iterator[tuple[int, int]]:
    """Numbers of consecutive texts of about GROUP characters together."""
    i = 0
    while i < len(texts):
        j, size = i, 0
        while j < len(texts) and (j == i or size + len(texts[j] or "") <= GROUP):
            size += len(texts[j] or "")
            j += 1
        yield i, j
        i = j


def _run(held, dropout: float, seed: int, emit):
    def run(batches: Iterator):
        pieces = pieces_of(held.value)
        for batch in batches:
            for part in slices(batch, 512):
                docs, texts = row_column(part, "doc_id").to_pylist(), row_column(part, "text").to_pylist()
                ids: list = []
                for i, j in groups(texts):
                    ids += pieces.encode_many([t or "" for t in texts[i:j]], [d or 0 for d in docs[i:j]], dropout, seed)
                yield emit(part, pieces, texts, [None if t is None else x for t, x in zip(texts, ids)])
    return run


def encode(docs: DataFrame, model: str = MODEL, dropout: float = DROPOUT, seed: int = SEED) -> DataFrame:
    """All columns of the documents with ``token_ids`` (array of int), ``n_tokens`` and ``lossless`` (the
    ids decode to the text; true for a null text) added. An input column with one of these names is
    replaced."""
    held = docs.sparkSession.sparkContext.broadcast(load_model(model))
    columns = [c for c in docs.columns if c not in ("token_ids", "n_tokens", "lossless")]
    rows = as_row(docs, columns)
    schema = rows.withColumns({"token_ids": F.lit(None).cast("array<int>"), "lossless": F.lit(True)}).schema

    def emit(part, pieces, texts, ids):
        import pyarrow as pa

        same = [t is None or pieces.decode(x.tolist()) == t for t, x in zip(texts, ids)]
        return pa.RecordBatch.from_arrays([part.column("row"), pa.array(ids, pa.list_(pa.int32())), pa.array(same, pa.bool_())],
                                          names=["row", "token_ids", "lossless"])

    out = rows.mapInArrow(_run(held, dropout, seed, emit), schema)
    return out.select(*[F.col(f"row.`{c}`").cast(docs.schema[c].dataType).alias(c) for c in columns], "token_ids",
                      F.coalesce(F.size("token_ids"), F.lit(0)).cast("long").alias("n_tokens"), "lossless")


def decode(tokens: DataFrame, model: str = MODEL) -> DataFrame:
    """``doc_id, text`` from ``doc_id, token_ids``; null ids give a null text."""
    held = tokens.sparkSession.sparkContext.broadcast(load_model(model))

    def run(batches: Iterator):
        import pyarrow as pa

        pieces = pieces_of(held.value)
        for batch in batches:
            for part in slices(batch, 64):
                texts = [None if x is None else pieces.decode(x) for x in part.column("token_ids").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return modest_batches(tokens.select(F.col("doc_id").cast("long").alias("doc_id"), "token_ids")).mapInArrow(run, "doc_id long, text string")


def digest(docs: DataFrame, model: str = MODEL, dropout: float = DROPOUT, seed: int = SEED) -> DataFrame:
    """``doc_id, n_chars, n_tokens, ids_sha256`` (of the ids as little-endian 32-bit numbers),
    ``decoded_sha256`` (of the decoded text) and ``lossless`` (decoding gives the text back)."""
    held = docs.sparkSession.sparkContext.broadcast(load_model(model))

    def emit(part, pieces, texts, ids):
        import pyarrow as pa

        texts = [t or "" for t in texts]
        ids = [np.zeros(0, "<i4") if x is None else x for x in ids]
        decoded = [pieces.decode(x.tolist()) for x in ids]
        sha = lambda b: hashlib.sha256(b).hexdigest()
        return pa.RecordBatch.from_pydict({
            "doc_id": part.column("doc_id"), "n_chars": pa.array([len(t) for t in texts], pa.int64()),
            "n_tokens": pa.array([len(x) for x in ids], pa.int64()),
            "ids_sha256": [sha(x.tobytes()) for x in ids],
            "decoded_sha256": [sha(d.encode("utf-8", "surrogatepass")) for d in decoded],
            "lossless": pa.array([d == t for d, t in zip(decoded, texts)], pa.bool_())})

    return doc_texts(docs).mapInArrow(_run(held, dropout, seed, emit),
                                      "doc_id long, n_chars long, n_tokens long, ids_sha256 string, decoded_sha256 string, lossless boolean")
