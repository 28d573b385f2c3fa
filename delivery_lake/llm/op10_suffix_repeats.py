"""Suffix-array dedup: maximal repeats from the common-prefix interval tree.

Texts are byte strings. Every window of 50 bytes belongs to its minimizer, the smallest-hashed 16-byte
string in it (leftmost of equals); consecutive windows with one minimizer form a stretch of at most 84
bytes. Equal windows have equal minimizers, so dealing stretches out by minimizer brings all
occurrences of every 50-byte string into one part.

1. Blocks of documents send their minimizer hashes and in how many different stretches each is; those
   in more than one document come back (only their stretches can hold a string that repeats between
   documents). A minimizer with more than SPREAD different stretches, as of a line that many documents
   share with different text around it, is too much for one part: its windows are dealt out one by
   one, by a hash of their own 50 bytes. Those hashes are counted first, and only windows whose hash
   recurs between documents are sent.
2. Blocks send their distinct stretches with their smallest document id. A part builds an enhanced
   suffix array over its distinct stretches: the suffixes with at least 50 bytes left, in order, and
   the lengths of the common prefixes of neighbours. A stack scan walks the intervals of the
   common-prefix tree with prefixes of 50 bytes or more; an interval whose occurrences have different
   bytes on the left (or a stretch's start) is a maximal repeat group, with all its occurrences. An
   interval with one byte on the left is part of a longer group and is passed over. Windows that were
   dealt out by themselves are all of one length, so a distinct one is a group.
3. Each group's smallest document id goes back to the blocks that hold an occurrence in a larger one,
   which remove the bytes.

A block sends each distinct stretch once, so a passage in a third of all documents is one entry per
block. The removed bytes are those of all windows that a smaller document id has, however the windows
are dealt out. Nothing is capped or sampled; the texts are shuffled once.

Matches never cross documents. A null text is empty. A document with a null id keeps all its bytes and
removes none elsewhere. Equal rows, and rows that repeat an id, do not remove each other's bytes. Extra
columns are ignored. A text is never cut: a task needs about 45 times the bytes of its longest text."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delivery_lake.llm.blocks import (
    ROW, Layout, Recurring, block_docs, hash_rows, in_blocks, keys_of, member, parts_of, recurring, recurring_rows, rows_table,
)
from delivery_lake.llm.common import mix64

#: Bytes of a repeat at least; bytes of the minimizing strings.
LENGTH = 50
GRAM = 16
#: Text bytes handled by numpy at once (bounds the scratch space and fits the processor's cache).
CHUNK = 1 << 17
#: Rows of the suffix array that are held at once.
RANGE = 1 << 16
#: Different stretches of a minimizer, summed over blocks, up to which they go to one part.
SPREAD = 1 << 12

_M1 = np.uint64(0x9E3779B97F4A7C15)


def stretches(data: np.ndarray, bounds: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """(start, end, minimizer hash) of the stretches of all texts in ``data`` (bytes one after the
    other, ``bounds`` between them). A stretch covers the windows of one minimizer occurrence."""
    n = len(data)
    none = np.zeros(0, np.int64)
    if n < length:
        return none, none, np.zeros(0, np.uint64)
    eight = np.ndarray((n - 7,), "<u8", data.tobytes(), strides=(1,)).astype(np.uint64)
    half = gram // 2
    two = eight if half == 8 else eight & np.uint64((1 << (8 * half)) - 1)
    m = n - gram + 1
    h = mix64(two[:m] * _M1 + mix64(two[half:half + m]))
    # Smallest (hash, place) in each window of grams, by doubling.
    key = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(m, dtype=np.uint64)
    width, span = length - gram + 1, 1
    while 2 * span <= width:
        key = np.minimum(key[:-span], key[span:])
        span *= 2
    if span < width:
        key = np.minimum(key[:len(key) - (width - span)], key[width - span:])
    place = (key & np.uint64(0xFFFFFFFF)).astype(np.int64)
    end = np.repeat(bounds[1:], np.diff(bounds))[:len(place)]
    valid = np.arange(len(place)) + length <= end
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[:len(place)]
    new = valid.copy()
    new[1:] &= ~(valid[:-1] & (place[1:] == place[:-1]) & (doc[1:] == doc[:-1]))
    first = np.flatnonzero(new)
    stop = valid.copy()
    stop[:-1] &= new[1:] | ~valid[1:]
    last = np.flatnonzero(stop)
    return first, last + length, h[place[first]]


def _chunks(texts: list[bytes]):
    """Numbers of consecutive texts of about CHUNK bytes together."""
    i = 0
    while i < len(texts):
        j, size = i, 0
        while j < len(texts) and (j == i or size + len(texts[j]) <= CHUNK):
            size += len(texts[j])
            j += 1
        yield i, j
        i = j


def block_stretches(texts: list[bytes], length: int, gram: int):
    """For runs of texts: (first text, joined bytes, bounds, starts, ends, hashes)."""
    for i, j in _chunks(texts):
        joined = b"".join(texts[i:j])
        bounds = np.cumsum([0, *map(len, texts[i:j])])
        yield i, joined, bounds, *stretches(np.frombuffer(joined, np.uint8), bounds, length, gram)


def window_hashes(joined: bytes, at: np.ndarray, length: int) -> np.ndarray:
    """64-bit hashes of the windows of ``length`` bytes (8 at least) that start at ``at``."""
    h = np.zeros(len(at), np.uint64)
    if len(at):
        eight = np.ndarray((len(joined) - 7,), "<u8", joined, strides=(1,))
        for k in (*range(0, length - 8, 8), length - 8):
            h = mix64(h * _M1 + eight[at + k])
    return h


def windows(start: np.ndarray, end: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all windows of some stretches, and the number of the stretch each is of."""
    count = end - length + 1 - start
    of = np.repeat(np.arange(len(start)), count)
    return np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count) + start[of], of


class SuffixArray:
    """A range of the enhanced suffix array of distinct stretches: rows in order, with the stretch and
    place of each suffix, the common prefix with the row before, and the byte on the left."""

    def __init__(self, pad: np.ndarray, size: np.ndarray, text: np.ndarray, offset: np.ndarray):
        width = pad.shape[1] // 2
        view = np.lib.stride_tricks.sliding_window_view(pad, width, axis=1)
        suffix = np.ascontiguousarray(view[text, offset])
        order = np.argsort(suffix.view(f"V{width}").ravel(), kind="stable")
        self.text, self.offset = text[order], offset[order]
        suffix = suffix[order]
        rest = size[self.text] - self.offset
        differ = suffix[1:] != suffix[:-1]
        lcp = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
        self.lcp = np.minimum(lcp, np.minimum(rest[1:], rest[:-1]))
        self.left = np.where(self.offset > 0, pad[self.text, np.maximum(self.offset - 1, 0)].astype(np.int16), -1)

    @staticmethod
    def ranges(texts: list[bytes], length: int, most: int):
        """The array over all suffixes of ``length`` bytes or more, in ranges of about ``most`` rows, cut
        where the first eight bytes change (so no repeat is cut; equal beginnings stay together)."""
        size = np.array([len(t) for t in texts])
        width = int(size.max()) + 1
        pad = np.zeros((len(texts), 2 * width), np.uint8)  # a stretch and zeros, to read suffixes from
        start = np.concatenate(([0], np.cumsum(size)[:-1]))
        row = np.repeat(np.arange(len(texts), dtype=np.int32), size)
        pad[row, np.arange(len(row)) - np.repeat(start, size)] = np.frombuffer(b"".join(texts), np.uint8)
        del row
        count = size - length + 1
        text = np.repeat(np.arange(len(texts), dtype=np.int32), count)
        offset = (np.arange(len(text)) - np.repeat(np.concatenate(([0], np.cumsum(count)[:-1])), count)).astype(np.int32)
        head = np.zeros(len(text), np.uint64)
        for k in range(8):
            head = (head << np.uint64(8)) | pad[text, offset + k]
        order = np.argsort(head)
        text, offset, head = text[order], offset[order], head[order]
        cuts = np.concatenate(([0], np.flatnonzero(head[1:] != head[:-1]) + 1, [len(head)]))
        i = 0
        while i < len(cuts) - 1:
            j = max(i + 1, int(np.searchsorted(cuts, cuts[i] + most, side="right")) - 1)
            yield SuffixArray(pad, size, text[cuts[i]:cuts[j]], offset[cuts[i]:cuts[j]])
            i = j

    def maximal_repeats(self, length: int):
        """(first row, end row, prefix length) of the intervals that are maximal repeats."""
        same = (self.left[1:] == self.left[:-1]) & (self.left[1:] >= 0)
        changes = np.concatenate(([0], np.cumsum(~same)))  # rows a..b have one byte on the left if equal
        deep = self.lcp >= length
        edge = np.flatnonzero(np.diff(np.concatenate(([0], deep.view(np.int8), [0]))))
        begin, stop = edge[::2], edge[1::2]  # lcp entries of a tree below the common root
        if not len(begin):
            return
        lcp = self.lcp.tolist()
        for a, b in zip(begin.tolist(), stop.tolist()):
            stack = [(lcp[a], a)]  # prefix length, first row
            for k in range(a + 1, b + 1):
                depth = lcp[k] if k < b else 0
                first = k
                while stack and stack[-1][0] > depth:
                    n, first = stack.pop()
                    if changes[k] != changes[first]:
                        yield first, k + 1, n
                if depth >= length and (not stack or stack[-1][0] < depth):
                    stack.append((depth, first))


def dedup_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, layout: Layout | None = None) -> DataFrame:
    """``doc_id, n_bytes, spans, kept`` for every row: maximal runs of removed bytes (end exclusive) and
    the remaining bytes."""
    layout = layout or Layout(docs)
    parts = layout.parts
    texts = in_blocks(docs, layout)

    def with_id(ids, data):
        return [t if i is not None else b"" for i, t in zip(ids, data)]

    def hashes(ids, data):
        value, doc, content = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
        for i, joined, bounds, start, end, h in block_stretches(with_id(ids, data), length, gram):
            value.append(h)
            doc.append(np.searchsorted(bounds, start, side="right") - 1 + i)
            # The first and the last window cover the stretch.
            content.append(mix64(window_hashes(joined, start, length) * _M1 + window_hashes(joined, end - length, length)) + (end - start).astype(np.uint64))
        return np.concatenate(value), np.concatenate(doc), np.concatenate(content)

    def send(table, sent):
        if not table.num_rows or not sent.num_rows:
            return rows_table([])
        ids, data = block_docs(table)
        block = table["block"][0].as_py()
        recurs = Recurring(sent, parts)
        held: dict[int, dict[bytes, list]] = {}
        value, of = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for i, joined, bounds, start, end, h in block_stretches(with_id(ids, data), length, gram):
            key = keys_of(h, parts)
            doc = np.searchsorted(bounds, start, side="right") - 1 + i
            hot = member(key, recurs.hot)
            if hot.any():
                at, k = windows(start[hot], end[hot], length)
                value.append(window_hashes(joined, at, length))
                of.append(doc[hot][k])
            live = member(key, recurs.keys) & ~hot
            hold(held, ids, joined, (key[live] >> np.uint64(32)).tolist(), start[live].tolist(), end[live].tolist(), doc[live].tolist())
        rows = packed_rows(1, block, held) + hash_rows(2, block, parts, np.concatenate(value), np.concatenate(of))
        if len(recurs.hot):  # comes back with the windows' hashes
            rows.append((4, block % parts, block, recurs.hot.tobytes(), b""))
        return rows_table(rows)

    def count_windows(table):
        back = [(4, p, b, d, b"") for k, p, b, d in zip(*(table[c].to_pylist() for c in ("kind", "part", "block", "data"))) if k == 4]
        return rows_table(recurring_rows(2, table) + back)

    def send_windows(table, sent):
        kinds = sent["kind"].to_pylist() if sent.num_rows else []
        if not table.num_rows or 2 not in kinds:
            return rows_table([])
        ids, data = block_docs(table)
        recurs = Recurring(sent, parts, 2)
        grams = np.sort(np.concatenate([np.frombuffer(d, np.uint64) for k, d in zip(kinds, sent["data"].to_pylist()) if k == 4]))
        held: dict[int, dict[bytes, list]] = {}
        for i, joined, bounds, start, end, h in block_stretches(with_id(ids, data), length, gram):
            hot = member(keys_of(h, parts), grams)
            at, _ = windows(start[hot], end[hot], length)
            key = keys_of(window_hashes(joined, at, length), parts)
            live = member(key, recurs.keys)
            at, doc = at[live], np.searchsorted(bounds, at[live], side="right") - 1 + i
            hold(held, ids, joined, (key[live] >> np.uint64(32)).tolist(), at.tolist(), (at + length).tolist(), doc.tolist())
        return rows_table(packed_rows(3, table["block"][0].as_py(), held))

    def hold(held, ids, joined, part, start, end, doc):
        for p, a, b, d in zip(part, start, end, doc):
            seen = held.setdefault(p, {}).setdefault(joined[a:b], [ids[d], ids[d]])
            if ids[d] > seen[1]:  # documents come in the order of their ids
                seen[1] = ids[d]

    def packed_rows(kind, block, held):
        return [(kind, p, block, *_packed(list(x), list(x.values()))) for p, x in sorted(held.items())]

    def decide(table):
        part = table["part"][0].as_py()
        kinds = table["kind"].to_pylist()
        number: dict[bytes, int] = {}
        least: list[int] = []
        held = []
        for kind, block, d, m in zip(kinds, table["block"].to_pylist(), table["data"].to_pylist(), table["more"].to_pylist()):
            if kind not in (1, 3):
                continue
            own, (low, high) = _unpacked(d, m)
            at = [number.setdefault(t, len(number)) for t in own]
            least += [1 << 62] * (len(number) - len(least))
            for k, v in zip(at, low.tolist()):
                if v < least[k]:
                    least[k] = v
            held.append((block, at, high))
        if not held:
            return rows_table([])
        kind = 3 if 3 in kinds else 1
        if kind == 3:
            groups = [[(0, length, m)] for m in least]
        else:
            groups = repeat_groups(list(number), np.array(least, np.int64), length)
        names, out = list(number), []
        for block, at, high in held:
            rows = [(t, a, b, m) for t, h in zip(at, high.tolist()) for a, b, m in groups[t] if m < h]
            if rows:
                out.append((kind, part, block, *_packed([names[t] for t, *_ in rows], [r[1:] for r in rows])))
        return rows_table(out)

    def remove(table, sent):
        return _removed(table, sent, length, gram, parts, with_id)

    found = recurring(texts, layout, hashes, SPREAD)
    sent = texts.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(send, ROW)
    decided = sent.groupBy("part").applyInArrow(decide, ROW)
    counted = sent.groupBy("part").applyInArrow(count_windows, ROW)
    alone = texts.groupBy("block").cogroup(counted.groupBy("block")).applyInArrow(send_windows, ROW)
    decided = decided.union(alone.groupBy("part").applyInArrow(decide, ROW))
    return texts.groupBy("block").cogroup(decided.groupBy("block")).applyInArrow(
        remove, "doc_id long, n_bytes long, spans array<struct<start:int,end:int>>, kept binary")


def repeat_groups(texts: list[bytes], least: np.ndarray, length: int = LENGTH) -> list[list[tuple[int, int, int]]]:
    """For each distinct stretch: (from, to, smallest id that has these bytes) of its occurrences in
    maximal repeat groups. Copies of a whole stretch are a group as well."""
    out = [[(0, len(t), m)] for t, m in zip(texts, least.tolist())]
    if len(texts) < 2:
        return out
    for sa in SuffixArray.ranges(texts, length, RANGE):
        text, offset, low = sa.text.tolist(), sa.offset.tolist(), least[sa.text].tolist()
        for first, end, n in sa.maximal_repeats(length):
            m = min(low[first:end])
            for r in range(first, end):
                if low[r] > m:
                    out[text[r]].append((offset[r], offset[r] + n, m))
    return out


def _packed(texts: list[bytes], numbers: list) -> tuple[bytes, bytes]:
    """Byte strings of under 64 KB, compressed, and a tuple of numbers for each."""
    import pyarrow as pa

    size = np.array([len(t) for t in texts], np.uint16)
    data = size.tobytes() + b"".join(texts)
    head = np.array([len(texts), len(data)], np.uint32).tobytes()
    return head + pa.Codec("zstd", 1).compress(data, asbytes=True), np.array(numbers, np.int64).T.tobytes()


def _unpacked(data: bytes, numbers: bytes) -> tuple[list[bytes], np.ndarray]:
    import pyarrow as pa

    n, size = np.frombuffer(data, np.uint32, 2).tolist()
    data = pa.Codec("zstd", 1).decompress(data[8:], size, asbytes=True)
    at = np.cumsum(np.concatenate(([2 * n], np.frombuffer(data, np.uint16, n)))).tolist()
    return [data[a:b] for a, b in zip(at, at[1:])], np.frombuffer(numbers, np.int64).reshape(-1, n)


def _removed(table, sent, length, gram, parts, with_id):
    import pyarrow as pa

    ids, data = block_docs(table) if table.num_rows else ([], [])
    groups: dict[bytes, list] = {}
    alone: dict[bytes, list] = {}  # windows that were dealt out by themselves
    for k, d, m in zip(*(sent[c].to_pylist() for c in ("kind", "data", "more"))) if sent.num_rows else ():
        own, numbers = _unpacked(d, m)
        for t, x in zip(own, numbers.T.tolist()):
            (alone if k == 3 else groups).setdefault(t, []).append(x)
    grams, known = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    if alone:
        grams = np.unique(np.concatenate([h for *_, h in block_stretches(list(alone), length, gram)]))
        joined = b"".join(alone)
        known = np.sort(window_hashes(joined, np.arange(0, len(joined), length), length))
    spans: list[list] = [[] for _ in data]
    if groups or alone:
        for i, joined, bounds, start, end, h in block_stretches(with_id(ids, data), length, gram):
            places = [(groups, start, end)] if groups else []
            hot = member(h, grams)
            if hot.any():
                at, _ = windows(start[hot], end[hot], length)
                at = at[member(window_hashes(joined, at, length), known)]
                places.append((alone, at, at + length))
            for among, start, end in places:
                for a, b in zip(start.tolist(), end.tolist()):
                    found = among.get(joined[a:b])
                    if found:
                        k = int(np.searchsorted(bounds, a, side="right")) - 1
                        at = a - int(bounds[k])
                        spans[i + k] += [(at + x, at + y) for x, y, m in found if m < ids[i + k]]
    kept = []
    for k, text in enumerate(data):
        merged: list = []
        for a, b in sorted(spans[k]):
            if merged and a <= merged[-1][1]:
                merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
            else:
                merged.append((a, b))
        spans[k] = merged
        edges = [0, *(x for s in merged for x in s), len(text)]
        kept.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2])) if merged else text)
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    return pa.table({"doc_id": pa.array(ids, pa.int64()), "n_bytes": pa.array([len(t) for t in data], pa.int64()),
                     "spans": pa.array([[{"start": a, "end": b} for a, b in s] for s in spans], span),
                     "kept": pa.array(kept, pa.binary())})


def digest(docs: DataFrame) -> DataFrame:
    """Contract columns of the registered query."""
    gone = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return dedup_repeats(docs).select("doc_id", "n_bytes", gone.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                                      F.sha2("kept", 256).alias("kept_sha256"))
