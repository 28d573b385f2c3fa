"""Substring dedup by recompression.

The words of every document are recompressed in rounds: maximal runs of one symbol become one symbol,
then pairs of a left and a right symbol (told apart by a hash bit of the symbol) become one symbol. A
name is a hash of what it stands for, so equal substrings get the same interior symbols in every task.
For each symbol the stretch of words that decides it (its context) is known. A window of 13 words is
represented by a symbol of the highest round that has one whose context lies inside the window: any
two equal windows have the same one.

Spark rounds then name globally:

1. Each block of documents sends the symbols that represent its windows; those in more than one
   document come back. A window whose symbol does not recur cannot recur.
2. The windows left are named by 128 bits of their word sequence, which verifies them: each block sends
   its distinct ones with its smallest document id, and gets back those that a smaller id has.
3. Each block removes the words of those windows from its documents.

Symbols and windows are collapsed per block before they are shuffled, so a passage in a third of all
documents is one entry per block. Nothing is capped or sampled; texts are shuffled once.

A null or blank text has no words. A document with a null id keeps all its words and removes none
elsewhere. Equal rows, and rows that repeat an id, do not remove each other's words. Extra columns are
ignored. A text is never cut: a task needs about 20 times the bytes of its longest text."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delivery_lake.llm.blocks import ROW, Layout, Recurring, block_docs, by_part, in_blocks, parts_of, recurring, rows_table
from delivery_lake.llm.common import mix64

#: Words of a window.
WINDOW = 13
#: Words handled by numpy at once (bounds the scratch space).
CHUNK = 1 << 18

_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


class _Words(dict):
    """Word -> local number; new words get the next one."""

    def __missing__(self, word):
        self[word] = n = len(self)
        return n


def word_names(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Two 64-bit names for every word of the texts, one after the other, and the texts' bounds."""
    import xxhash

    known = _Words()
    ids, sizes = [], [0]
    for text in texts:
        words = text.split()
        ids.append(np.fromiter(map(known.__getitem__, words), np.int64, len(words)))
        sizes.append(len(words))
    digest = xxhash.xxh3_128_digest
    names = np.frombuffer(b"".join(map(digest, known)), np.uint64).reshape(-1, 2)
    at = np.concatenate(ids) if ids else np.zeros(0, np.int64)
    return names[at, 0], names[at, 1], np.cumsum(sizes)


def chunks(bounds: np.ndarray, most: int = CHUNK):
    """Ranges of consecutive documents with about ``most`` words each."""
    i, n = 0, len(bounds) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(bounds, bounds[i] + most, side="right")) - 1)
        yield i, j
        i = j


def window_mask(bounds: np.ndarray, length: int) -> np.ndarray:
    """Positions at which a window fits into its document."""
    n = int(bounds[-1])
    end = np.repeat(bounds[1:], np.diff(bounds))
    return np.arange(n) + length <= end


def rounds(names: np.ndarray, bounds: np.ndarray, window: int = WINDOW) -> list[tuple]:
    """Recompression rounds: (symbols, context starts, context ends), words as places.

    Whether a symbol is where it is depends on the words of its context only. A document's edge counts
    as a word outside the document, so what an edge decides is in no window's reach."""
    sym = names
    cs = np.arange(len(names))
    ce = cs + 1
    first = np.zeros(len(names), bool)
    first[bounds[:-1][np.diff(bounds) > 0]] = True  # the symbol begins a document
    out = [(sym, cs, ce)]
    level = 0
    while (ce - cs <= window).any():
        level += 1
        salt = np.uint64(2 * level + 1)
        # Runs. The symbols on both sides decide where a run ends.
        start = np.flatnonzero(np.concatenate(([True], (sym[1:] != sym[:-1]) | first[1:])))
        size = np.diff(np.append(start, len(sym)))
        end = start + size
        last = np.append(first[1:], True)
        a = np.minimum(np.minimum.reduceat(cs, start), np.where(first[start], cs[start] - 1, cs[np.maximum(start - 1, 0)]))
        b = np.maximum(np.maximum.reduceat(ce, start), np.where(last[end - 1], ce[end - 1] + 1, ce[np.minimum(end, len(sym) - 1)]))
        one = sym[start]
        sym = np.where(size > 1, mix64(one * _M1 + size.astype(np.uint64) * salt), one)
        cs, ce, first = a, b, first[start]
        # Pairs of a left and a right symbol. A symbol that stays alone depends on its neighbour.
        left = mix64(sym ^ salt) >> np.uint64(63) == 0
        last = np.append(first[1:], True)
        joins = left & ~last & ~np.append(left[1:], True)
        second = np.concatenate(([False], joins[:-1]))
        next_cs, next_ce = np.append(cs[1:], 0), np.append(ce[1:], 0)
        prev_cs = np.concatenate(([0], cs[:-1]))
        b = np.where(left, np.maximum(ce, np.where(last, ce + 1, next_ce)), ce)
        a = np.where(left, np.where(joins, np.minimum(cs, next_cs), cs), np.minimum(cs, np.where(first, cs - 1, prev_cs)))
        sym = np.where(joins, mix64(sym * _M1 + np.append(sym[1:], sym[:1]) * _M2 + salt), sym)
        keep = ~second
        sym, cs, ce, first = sym[keep], a[keep], b[keep], first[keep]
        out.append((sym, cs, ce))
    return out


class Hashes:
    """Hash of any stretch of words, from running sums of names times powers (mod 2**64)."""

    def __init__(self, names: np.ndarray, base: int):
        def powers(b: int) -> np.ndarray:
            steps = np.full(len(names) + 1, b, np.uint64)
            steps[0] = 1
            return np.cumprod(steps)

        self.inverse = powers(pow(base, -1, 1 << 64))
        self.sums = np.zeros(len(names) + 1, np.uint64)
        np.cumsum(names * powers(base)[:-1], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix64((self.sums[end] - self.sums[start]) * self.inverse[start] + (end - start).astype(np.uint64))


_NO_HASH = np.uint64(0xFFFFFFFFFFFFFFFF)
_B1, _B2 = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95


def settled(names: np.ndarray, bounds: np.ndarray, window: int = WINDOW):
    """From the highest round down: (windows settled by it, hash of the symbol that represents each).

    A window is settled by the highest round that has a symbol whose context lies in it. Of all such
    symbols of this round the one with the smallest hash represents it, the same wherever the window
    stands; a symbol is hashed with the words of its context."""
    open_ = window_mask(bounds, window)
    if not open_.any():
        return
    hashes = Hashes(names, _B1)
    n = len(names)
    for sym, cs, ce in reversed(rounds(names, bounds, window)):
        fits = (ce - cs <= window) & (cs >= 0) & (ce <= n)
        sym, cs, ce = sym[fits], cs[fits], ce[fits]
        lo, hi = np.maximum(ce - window, 0), cs + 1  # the windows that hold the context
        count = np.concatenate(([0], np.cumsum(open_)))
        used = count[hi] > count[lo]
        sym, cs, ce, lo, hi = sym[used], cs[used], ce[used], lo[used], hi[used]
        if not len(sym):
            continue
        name = mix64(sym ^ hashes.of(cs, ce))
        best = np.full(n, _NO_HASH)
        for k in range(int((hi - lo).max())):
            some = lo + k < hi
            np.minimum.at(best, lo[some] + k, name[some])
        at = np.flatnonzero(open_ & (best != _NO_HASH))
        yield at, best[at]
        open_[at] = False
        if not open_.any():
            return


def covered(lo: np.ndarray, hi: np.ndarray, n: int) -> np.ndarray:
    """Places in any of the ranges."""
    cover = np.bincount(lo, minlength=n + 1)[: n + 1] - np.bincount(hi, minlength=n + 1)[: n + 1]
    return np.cumsum(cover)[:n] > 0


def representing(texts: list[bytes], window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the symbols that represent windows, and the number of the text each is in."""
    names, _, bounds = word_names(texts)
    value, doc = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for i, j in chunks(bounds):
        own = bounds[i:j + 1] - bounds[i]
        for at, h in settled(names[bounds[i]:bounds[j]], own, window):
            d = np.searchsorted(own, at, side="right") - 1 + i
            new = np.concatenate(([True], (h[1:] != h[:-1]) | (d[1:] != d[:-1])))  # neighbours mostly share one
            value.append(h[new])
            doc.append(d[new])
    return np.concatenate(value), np.concatenate(doc)


def windows(names: np.ndarray, names2: np.ndarray, at: np.ndarray, window: int) -> np.ndarray:
    """128-bit names (two columns) of the windows at some places."""
    return np.stack((Hashes(names, _B1).of(at, at + window), Hashes(names2, _B2).of(at, at + window)), axis=1)


def candidate_windows(texts: list[bytes], recurs: Recurring, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Names of the windows whose representing symbol recurs, and the texts they are in."""
    names, names2, bounds = word_names(texts)
    found, doc = [np.zeros((0, 2), np.uint64)], [np.zeros(0, np.int64)]
    for i, j in chunks(bounds):
        own = bounds[i:j + 1] - bounds[i]
        part = slice(bounds[i], bounds[j])
        at = np.sort(np.concatenate([np.zeros(0, np.int64), *[w[recurs.has(h)] for w, h in settled(names[part], own, window)]]))
        found.append(windows(names[part], names2[part], at, window))
        doc.append(np.searchsorted(own, at, side="right") - 1 + i)
    return np.concatenate(found), np.concatenate(doc)


def _number(ids: list, docs: np.ndarray) -> np.ndarray:
    return np.array([0 if i is None else i for i in ids], np.int64)[docs]


def window_rows(block: int, name: np.ndarray, own: np.ndarray, parts: int) -> list[tuple]:
    """What a block sends of its windows (``own``: the id of the document each is in): a row a part, with
    the distinct names, the smallest id of each and whether several ids have it."""
    part, _ = parts_of(name[:, 0], parts)
    order = np.lexsort((own, name[:, 1], name[:, 0], part))
    name, own, part = name[order], own[order], part[order]
    new = np.flatnonzero(np.concatenate(([True], (name[1:] != name[:-1]).any(axis=1)))) if len(name) else np.zeros(0, np.int64)
    least = own[new]
    several = own[np.append(new[1:], len(own)) - 1] != least if len(new) else np.zeros(0, bool)
    name, part = name[new], part[new]
    return [(1, p, block, name[s].tobytes(), least[s].tobytes() + np.packbits(several[s]).tobytes()) for p, s in by_part(part)]


def dedup_substrings(docs: DataFrame, window: int = WINDOW, layout: Layout | None = None) -> DataFrame:
    """``doc_id, n_words, spans, kept`` for every row: merged spans of removed words (word numbers, end
    exclusive) and the text of the words kept, joined by one space."""
    layout = layout or Layout(docs)
    parts = layout.parts
    texts = in_blocks(docs, layout)

    def with_id(ids, data):
        """Texts that can recur: those of documents with an id."""
        return [t if i is not None else b"" for i, t in zip(ids, data)]

    def send(table, sent):
        if not table.num_rows or not sent.num_rows:
            return rows_table([])
        ids, data = block_docs(table)
        block = table["block"][0].as_py()
        name, doc = candidate_windows(with_id(ids, data), Recurring(sent, parts), window)
        return rows_table(window_rows(block, name, _number(ids, doc), parts))

    def decide(table):
        part = table["part"][0].as_py()
        names, least, several, block = [], [], [], []
        for b, d, m in zip(table["block"].to_pylist(), table["data"].to_pylist(), table["more"].to_pylist()):
            n = len(d) // 16
            names.append(np.frombuffer(d, np.uint64).reshape(-1, 2))
            least.append(np.frombuffer(m, np.int64, n))
            several.append(np.unpackbits(np.frombuffer(m, np.uint8, offset=8 * n), count=n).astype(bool))
            block.append(np.full(n, b, np.int32))
        names, least, several, block = map(np.concatenate, (names, least, several, block))
        order = np.lexsort((names[:, 1], names[:, 0]))
        new = np.concatenate(([True], (names[order][1:] != names[order][:-1]).any(axis=1)))
        start = np.flatnonzero(new)
        overall = np.empty(len(least), np.int64)
        overall[order] = np.minimum.reduceat(least[order], start)[np.cumsum(new) - 1]
        back = (overall < least) | several
        names, overall, block = names[back], overall[back], block[back]
        order = np.argsort(block, kind="stable")
        names, overall, block = names[order], overall[order], block[order]
        return rows_table([(1, part, b, names[s].tobytes(), overall[s].tobytes()) for b, s in by_part(block)])

    def remove(table, sent):
        return _removed(table, sent, window, with_id)

    found = recurring(texts, layout, lambda ids, data: representing(with_id(ids, data), window))
    sent = texts.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(send, ROW)
    decided = sent.groupBy("part").applyInArrow(decide, ROW)
    return texts.groupBy("block").cogroup(decided.groupBy("block")).applyInArrow(
        remove, "doc_id long, n_words long, spans array<struct<start:int,end:int>>, kept string")


def _removed(table, sent, window, with_id):
    import pyarrow as pa

    ids, data = block_docs(table) if table.num_rows else ([], [])
    known = [np.frombuffer(d, np.uint64).reshape(-1, 2) for d in sent["data"].to_pylist()] if sent.num_rows else []
    limit = [np.frombuffer(m, np.int64) for m in sent["more"].to_pylist()] if sent.num_rows else []
    known, limit = (np.concatenate(known), np.concatenate(limit)) if known else (np.zeros((0, 2), np.uint64), np.zeros(0, np.int64))
    order = np.lexsort((known[:, 1], known[:, 0]))
    known, limit = known[order], limit[order]
    spans: list[list] = [[] for _ in data]
    if len(known):
        names, names2, bounds = word_names(with_id(ids, data))
        for i, j in chunks(bounds):
            own = bounds[i:j + 1] - bounds[i]
            part = slice(bounds[i], bounds[j])
            at = np.flatnonzero(window_mask(own, window))
            doc = np.searchsorted(own, at, side="right") - 1
            name = windows(names[part], names2[part], at, window)
            gone = at[_decided(name, known, limit, _number(ids, doc + i))]
            if not len(gone):
                continue
            hit = covered(gone, gone + window, int(own[-1]))
            # Spans end with their document: windows never leave it, but spans of neighbours may touch.
            edge = hit.copy()
            edge[1:] &= ~hit[:-1]
            starts_doc = np.zeros(len(hit), bool)
            starts_doc[own[:-1][np.diff(own) > 0]] = True
            start = np.flatnonzero(edge | (hit & starts_doc))
            stop = np.flatnonzero(hit & ~np.append(hit[1:] & ~starts_doc[1:], False)) + 1
            d = np.searchsorted(own, start, side="right") - 1
            for k, a, b in zip((d + i).tolist(), (start - own[d]).tolist(), (stop - own[d]).tolist()):
                spans[k].append((a, b))
    n_words, kept = [], []
    for text, gone in zip(data, spans):
        words = text.split()
        n_words.append(len(words))
        if gone:
            left = [(0, gone[0][0]), *((x[1], y[0]) for x, y in zip(gone, gone[1:])), (gone[-1][1], len(words))]
            words = [w for a, b in left for w in words[a:b]]
        kept.append(b" ".join(words))
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    return pa.table({"doc_id": pa.array(ids, pa.int64()), "n_words": pa.array(n_words, pa.int64()),
                     "spans": pa.array([[{"start": a, "end": b} for a, b in s] for s in spans], span),
                     "kept": pa.array(kept, pa.binary()).cast(pa.string())})


def _decided(name: np.ndarray, known: np.ndarray, limit: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Windows that a smaller id than their own has."""
    first = known[:, 0]
    at = np.searchsorted(first, name[:, 0])
    out = np.zeros(len(name), bool)
    live = np.arange(len(name))
    while len(live):  # more than one turn only where first halves collide
        live = live[at[live] < len(first)]
        live = live[first[at[live]] == name[live, 0]]
        out[live] |= (known[at[live], 1] == name[live, 1]) & (limit[at[live]] < own[live])
        at[live] += 1
    return out


def digest(docs: DataFrame) -> DataFrame:
    """Contract columns of the registered query."""
    gone = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return dedup_substrings(docs).select("doc_id", "n_words", gone.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))
