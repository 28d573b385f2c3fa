"""SimHash near-duplicates by tiled exact comparison.

Every text gets a 64-bit fingerprint of its 3-word shingles. Equal fingerprints collapse to one node
(carrying the smallest doc_id), so a group of copies, however large, is one node. The distinct
fingerprints are sorted into tiles by population count; two tiles are compared only if their counts
are within the radius, as each differing bit changes the count by one. Inside a pair of tiles the same
test is made on the counts of the four 16-bit quarters, and what is left is compared exactly with
numpy exclusive-or and bit counts. A pair of tiles returns a spanning forest of the links found in it,
never all pairs, so a dense group costs as many rows as it has nodes. The forest's components are
joined over all tiles by alternating large-star and small-star rounds on Spark, each written to the
shared folder.

Every row gets a component, however many links it has: nothing is capped. The comparison stays
quadratic in the number of distinct fingerprints, as the method is; the count tests leave a few
hundredths of the pairs, each taking about a nanosecond.

A null text or one without words has fingerprint zero and is linked like any other; fewer than three
words are one shingle. A row with a null doc_id has a fingerprint and the component of its fingerprint,
but is no node itself (null component if no document with an id shares the fingerprint). Equal rows
give equal rows. Extra columns are ignored by ``near_duplicates`` and kept by ``keep_one``."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delivery_lake.llm.common import as_bytes, doc_texts, slices, written

#: Contract values: words of a shingle, hash seed, most differing bits of a link.
SHINGLE = 3
SEED = 42
RADIUS = 3
#: Most fingerprints in one tile.
TILE = 1 << 16
#: Most pairs compared in one numpy step.
STEP = 1 << 20


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """SimHash of a text: a bit is set if it is set in over half of the shingles' XXH64."""
    import xxhash

    words = text.lower().split()  # bytes: A-Z and the white space \x20 \x09-\x0D only
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    starts = [0, *accumulate(len(w) + 1 for w in words)]
    digest = xxhash.xxh64_intdigest
    n = len(words) - shingle + 1
    hashes = np.fromiter((digest(joined[a:b - 1], SEED) for a, b in zip(starts, starts[shingle:])), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for i in range(0, n, 1 << 16):  # very long texts: bounded scratch space
        bits = np.unpackbits(hashes[i:i + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(ones * 2 > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, text_hash, fp`` (the 64 bits as a long) for every row."""
    def run(batches: Iterator):
        import pyarrow as pa

        for batch in batches:
            for part in slices(batch):
                fp = np.array([fingerprint(t, shingle) for t in as_bytes(part.column("text"))], np.uint64)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("text_hash"), pa.array(fp.view(np.int64))],
                                                 names=["doc_id", "text_hash", "fp"])

    return doc_texts(docs).withColumn("text_hash", F.xxhash64("text")).mapInArrow(run, "doc_id long, text_hash long, fp long")


def quarter_counts(fp: np.ndarray) -> np.ndarray:
    """Population counts of the four 16-bit quarters, one row a fingerprint."""
    return np.bitwise_count(fp.view(np.uint16).reshape(-1, 4)).astype(np.int16)


class _Forest:
    """Union-find that remembers which nodes were joined."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        a, b = self.root[a], self.root[b]
        while True:
            differ = a != b
            if not differ.any():
                return
            low, high = np.minimum(a[differ], b[differ]), np.maximum(a[differ], b[differ])
            np.minimum.at(self.root, high, low)
            while True:  # shorten all paths
                up = self.root[self.root]
                if (up == self.root).all():
                    break
                self.root = up
            a, b = self.root[high], self.root[low]


def tile_links(a: np.ndarray, b: np.ndarray | None, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest of the links within one tile (``b`` None) or between two: (node, its root),
    nodes numbered along ``a`` then ``b``."""
    same = b is None
    other = a if same else b
    forest = _Forest(len(a) + (0 if same else len(other)))
    shift = 0 if same else len(a)
    cells = quarter_counts(other)
    order = np.lexsort(cells.T)
    cell, first = np.unique(cells[order], axis=0, return_index=True)
    key_order = np.lexsort(cell.T)
    cell, first = cell[key_order], first[key_order]
    last = np.append(first[1:], len(other))
    own = quarter_counts(a)
    rows_by_cell = np.lexsort(own.T)
    own_cell, own_first = np.unique(own[rows_by_cell], axis=0, return_index=True)
    own_order = np.lexsort(own_cell.T)
    own_cell, own_first = own_cell[own_order], own_first[own_order]
    own_last = np.append(own_first[1:], len(a))
    for c, i, j in zip(own_cell, own_first, own_last):
        near = np.flatnonzero(np.abs(cell - c).sum(axis=1) <= radius)
        if not len(near):
            continue
        candidates = order[np.concatenate([np.arange(first[k], last[k]) for k in near])]
        rows = rows_by_cell[i:j]
        each = max(1, STEP // len(candidates))
        for k in range(0, len(rows), each):
            block = rows[k:k + each]
            bits = np.bitwise_count(a[block][:, None] ^ other[candidates][None, :])
            x, y = np.nonzero(bits <= radius)
            x, y = block[x], candidates[y]
            if same:
                x, y = x[x < y], y[x < y]
            if len(x):
                forest.join(x, y + shift)
    nodes = np.flatnonzero(forest.root != np.arange(len(forest.root)))
    return nodes, forest.root[nodes]


def links(nodes: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Forest links (u, v) between the distinct fingerprints of ``nodes`` (column ``fp``).

    Tiles are numbered by population count, so the tiles that a tile is compared with are a range of
    numbers: each tile is sent once for each of them, and the pairs of tiles are listed nowhere."""
    spark = nodes.sparkSession
    nodes = nodes.select("fp", F.bit_count("fp").cast("int").alias("pop"))
    sizes = {r["pop"]: r["count"] for r in nodes.groupBy("pop").count().collect()}  # 65 rows at most
    if not sizes:
        return spark.createDataFrame([], "u long, v long")
    layout, first = [], 0
    for pop in sorted(sizes):
        layout.append((pop, first, -(-sizes[pop] // tile)))
        first += layout[-1][2]
    ranged = [(pop, at, n, min(a for q, a, _ in layout if q >= pop - radius), max(a + m - 1 for q, a, m in layout if q <= pop + radius))
              for pop, at, n in layout]
    tiles = F.broadcast(spark.createDataFrame(ranged, "pop int, tile0 int, tiles int, low int, high int"))
    number = (F.col("tile0") + F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int")).alias("tile")
    # A tile holds about TILE nodes by construction, so its list is bounded; a pair of tiles is one group.
    packed = nodes.join(tiles, "pop").select(number, "low", "high", "fp").groupBy("tile", "low", "high").agg(F.collect_list("fp").alias("fps"))
    dealt = packed.select("tile", "fps", F.explode(F.sequence("low", "high")).alias("other")).select(
        F.least("tile", "other").alias("one"), F.greatest("tile", "other").alias("two"), "fps",
        (F.col("tile") > F.col("other")).cast("int").alias("side"), (F.col("tile") == F.col("other")).alias("alone"))

    def compare(table):
        import pyarrow as pa

        sides = {s: np.asarray(f.values) for s, f in zip(table["side"].to_pylist(), table["fps"])}
        if len(sides) == 1 and not table["alone"][0].as_py():  # the other tile got no row
            return pa.table({"u": pa.array([], pa.int64()), "v": pa.array([], pa.int64())})
        one, two = sides[0], sides.get(1)
        node, root = tile_links(one.view(np.uint64), None if two is None else two.view(np.uint64), radius)
        ids = one if two is None else np.concatenate((one, two))
        return pa.table({"u": pa.array(ids[node]), "v": pa.array(ids[root])})

    return dealt.groupBy("one", "two").applyInArrow(compare, "u long, v long")


def components(edges: DataFrame) -> DataFrame:
    """``id, component`` for each end of the links: the smallest id reachable. Alternates large-star
    (every larger neighbour to the smallest one) and small-star until no link changes."""
    edges = written(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), "links")
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = written(large, "large-star")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
        small = written(small.where("u <> v").distinct(), "small-star")
        if edges.exceptAll(small).isEmpty() and small.exceptAll(edges).isEmpty():
            return small.select(F.col("u").alias("id"), F.col("v").alias("component"))
        edges = small


def near_duplicates(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE, tile: int = TILE) -> DataFrame:
    """``doc_id, text_hash, fp, component_id, root`` for every row (``root``: a fingerprint that names the
    component, null where no document with an id has the row's fingerprint)."""
    prints = written(fingerprints(docs, shingle), "fingerprints")
    nodes = written(prints.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("id")), "nodes")
    found = components(links(nodes, radius, tile)).withColumnsRenamed({"id": "fp", "component": "root"})
    rooted = nodes.join(found, "fp", "left").select("fp", "id", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("id").alias("component_id"))
    named = rooted.join(least, "root").select("fp", "component_id", "root")
    return prints.join(named, "fp", "left").select("doc_id", "text_hash", "fp", "component_id", "root")


def keep_one(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE) -> DataFrame:
    """The documents, all columns, with one row of each component of linked fingerprints: that of the
    smallest doc_id and, where rows repeat it, text hash. Rows with one doc_id whose texts are in
    different components each stay. Rows without a doc_id stay."""
    columns = docs.columns
    found = near_duplicates(docs, radius, shingle).where("doc_id is not null")
    best = found.groupBy("root").agg(F.min(F.struct("doc_id", "text_hash")).alias("best"))
    keep = best.select(F.col("best.doc_id").alias("kept_id"), F.col("best.text_hash").alias("kept_hash"))
    row = F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row")
    have = docs.where(F.col("doc_id").isNotNull()).select(
        row, F.col("doc_id").cast("long").alias("kept_id"), F.xxhash64(F.col("text").cast("string")).alias("kept_hash"))
    kept = have.join(keep, ["kept_id", "kept_hash"], "left_semi").dropDuplicates(["kept_id", "kept_hash"])
    kept = kept.select(*[F.col(f"row.`{c}`").alias(c) for c in columns])
    return kept.unionByName(docs.where(F.col("doc_id").isNull()))


def digest(docs: DataFrame) -> DataFrame:
    """Contract columns of the registered query."""
    return near_duplicates(docs).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
