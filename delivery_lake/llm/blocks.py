"""Which hashes recur between documents, found block by block.

Documents are dealt into blocks by a hash of their id. Each block sends the distinct 32-bit hashes of
something it contains, dealt into parts by further hash bits: one row per block and part, so a hash
that a third of all documents share is one entry per block (pre-aggregated, no hot key). A part
returns to each block the hashes that more than one document has. The answer may hold a chance
collision; it only selects what is then compared exactly.

All steps of a query read the same exchange of the documents (Spark reuses it), so the texts are
shuffled once."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delivery_lake.llm.common import BLOCK_BYTES, PART_BYTES, as_bytes, count_for, doc_texts, mix64

ROW = "kind int, part int, block int, data binary, more binary"


class Layout:
    """Numbers of blocks and parts for an input."""

    def __init__(self, docs: DataFrame, block_bytes: int = BLOCK_BYTES, part_bytes: int = PART_BYTES):
        self.blocks = count_for(docs, block_bytes, 16)
        self.parts = count_for(docs, part_bytes, 16)


def in_blocks(docs: DataFrame, layout: Layout) -> DataFrame:
    """``doc_id, text, block``; documents without an id are in blocks like others."""
    return doc_texts(docs).withColumn("block", F.pmod(F.xxhash64("doc_id", F.when(F.col("doc_id").isNull(), F.col("text"))), F.lit(layout.blocks)).cast("int"))


def block_docs(table) -> tuple[list, list[bytes]]:
    """Ids (None where null) and texts of a block, in the order of ids and texts: the same each time."""
    rows = sorted(zip(table["doc_id"].to_pylist(), as_bytes(table["text"])), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    return [r[0] for r in rows], [r[1] for r in rows]


def rows_table(rows: list[tuple]):
    """Arrow table of ``ROW`` from (kind, part, block, data, more)."""
    import pyarrow as pa

    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
    columns = list(zip(*rows)) if rows else [[]] * 5
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=["kind", "part", "block", "data", "more"])


def parts_of(hashes: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Part number and 32-bit rest of 64-bit hashes, from bits of their own: hashes that were chosen for
    being small are dealt out as evenly as others."""
    own = mix64(hashes ^ np.uint64(0x5851F42D4C957F2D))
    return ((own >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64), own.astype(np.uint32)


def by_part(part: np.ndarray):
    """(part, slice) of an array that is sorted by part: one slice a part."""
    step = np.diff(part)
    if (step < 0).any():
        raise ValueError("by_part needs parts in order")
    at = np.flatnonzero(step) + 1
    bounds = [0, *at.tolist(), len(part)]
    return [(int(part[a]), slice(a, b)) for a, b in zip(bounds, bounds[1:]) if b > a]


def hash_rows(kind: int, block: int, parts: int, value: np.ndarray, doc: np.ndarray, content: np.ndarray | None = None) -> list[tuple]:
    """What a block sends of its hashes (``doc``: the document of each): a row a part, with the distinct
    ones and whether several documents have them. With ``content`` (hashes of what was hashed, and its
    surroundings), also how many different ones there are, as a power of two that is not below."""
    part, rest = parts_of(value, parts)
    key = (part.astype(np.uint64) << np.uint64(32)) | rest
    order = np.argsort(key, kind="stable")
    key, doc = key[order], doc[order]
    new = np.concatenate(([True], key[1:] != key[:-1])) if len(key) else np.zeros(0, bool)
    start = np.flatnonzero(new)
    several = np.minimum.reduceat(doc, start) != np.maximum.reduceat(doc, start) if len(start) else np.zeros(0, bool)
    power = np.zeros(0, np.uint8)
    if content is not None and len(start):
        size = np.diff(np.append(start, len(key)))
        group = np.repeat(np.arange(len(start)), size)
        many = np.repeat(size > 1, size)
        group, content = group[many], content[order][many]
        order = np.lexsort((content, group))
        group, content = group[order], content[order]
        first = np.ones(len(group), bool)
        first[1:] = (group[1:] != group[:-1]) | (content[1:] != content[:-1])
        different = np.maximum(np.bincount(group[first], minlength=len(start)), 1)
        power = np.ceil(np.log2(different)).astype(np.uint8)
    key = key[start]
    rest = key.astype(np.uint32)
    return [(kind, p, block, rest[s].tobytes(), np.packbits(several[s]).tobytes() + power[s].tobytes())
            for p, s in by_part((key >> np.uint64(32)).astype(np.int64))]


def recurring_rows(kind: int, table, spread: int = 0) -> list[tuple]:
    """What a part returns for the rows of ``hash_rows``: to each block its hashes that more than one
    document has; with ``spread``, also which of them have more different contents than that."""
    rows = [r for r in zip(*(table[c].to_pylist() for c in ("kind", "part", "block", "data", "more"))) if r[0] == kind]
    if not rows:
        return []
    sent = [np.frombuffer(r[3], np.uint32) for r in rows]
    several = [np.unpackbits(np.frombuffer(r[4], np.uint8), count=len(d)).astype(bool) for r, d in zip(rows, sent)]
    every = np.sort(np.concatenate([*sent, *[d[m] for d, m in zip(sent, several)]]))  # twice where a block has several
    common = np.unique(every[1:][every[1:] == every[:-1]])
    live = [member(d, common) for d in sent]
    found = [d[m] for d, m in zip(sent, live)]
    hot = np.zeros(0, np.uint32)
    if spread and len(common):
        power = np.concatenate([np.frombuffer(r[4], np.uint8)[-(-len(d) // 8):][m] for r, d, m in zip(rows, sent, live)])
        different = np.bincount(np.searchsorted(common, np.concatenate(found)), weights=2.0 ** power, minlength=len(common))
        hot = common[different > spread]
    return [(kind, r[1], r[2], d.tobytes(), np.packbits(member(d, hot)).tobytes() if spread else b"") for r, d in zip(rows, found) if len(d)]


def recurring(texts: DataFrame, layout: Layout, hashes: Callable[[list, list[bytes]], tuple[np.ndarray, ...]], spread: int = 0) -> DataFrame:
    """Rows of ``ROW`` with kind 0 for each block: the recurring hashes, one row a part.

    ``hashes(ids, texts)`` gives 64-bit hashes and the number of the document each is in; for ``spread``,
    also hashes of the contents that may be too many for one part."""
    parts = layout.parts

    def send(table):
        ids, data = block_docs(table)
        return rows_table(hash_rows(0, table["block"][0].as_py(), parts, *hashes(ids, data)))

    def count(table):
        return rows_table(recurring_rows(0, table, spread))

    return texts.groupBy("block").applyInArrow(send, ROW).groupBy("part").applyInArrow(count, ROW)


def member(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Which values are in a sorted array."""
    if not len(ordered):
        return np.zeros(len(values), bool)
    at = np.searchsorted(ordered, values)
    at[at == len(ordered)] = 0
    return ordered[at] == values


class Recurring:
    """The recurring hashes that a block got back, and those among them with too many contents."""

    def __init__(self, table, parts: int, kind: int = 0):
        self.parts = parts
        keys, hot = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
        for k, p, d, m in zip(*(table[c].to_pylist() for c in ("kind", "part", "data", "more"))):
            if k == kind:
                keys.append((np.uint64(p) << np.uint64(32)) | np.frombuffer(d, np.uint32))
                if m:
                    hot.append(keys[-1][np.unpackbits(np.frombuffer(m, np.uint8), count=len(keys[-1])).astype(bool)])
        self.keys, self.hot = np.sort(np.concatenate(keys)), np.sort(np.concatenate(hot))

    def has(self, hashes: np.ndarray) -> np.ndarray:
        return member(keys_of(hashes, self.parts), self.keys)


def keys_of(hashes: np.ndarray, parts: int) -> np.ndarray:
    """Part and 32-bit rest of hashes in one number."""
    part, rest = parts_of(hashes, parts)
    return (part.astype(np.uint64) << np.uint64(32)) | rest
