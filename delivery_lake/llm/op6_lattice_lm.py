"""Language-model scoring with a subword lattice.

The pieces of an existing vocabulary are the edges of a lattice over each word: every way to cut the
word into pieces is a path, weighted by the product of the pieces' probabilities. A log-space forward
recursion adds up all paths, giving the word's marginal probability; a document's probability is the
product over its words and the end of the text.

The vocabulary's own scores (merge ranks) give the first probabilities. Expectation-maximisation over
the counts of all training words then fits them: expected piece counts by forward and backward
recursion, added up on Spark. The vocabulary itself is not changed.

Counting words does not shuffle texts. Tasks turn documents into blocks: the block's distinct words,
each with its training count, and the documents as word numbers. A part gathers one hash range of the
words of all blocks, knows their total counts and lattice scores, and answers every block. So the
vocabulary is in no single task or broadcast, and a frequent word is one entry per block.

A null text is empty: its only token is the end. A null doc_id is never held out and not learned from.
With nothing to learn from, counts are zero and the first probabilities hold. Equal rows get equal
scores, and each counts in training. Extra columns are ignored."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delivery_lake.llm.blocks import by_part, parts_of
from delivery_lake.llm.common import PART_BYTES, as_bytes, count_for, doc_texts, mix64, remainder, slices, written
from delivery_lake.llm.op1_sentencepiece import MODEL, load_model

#: Contract: documents with this remainder of crc32 by FOLDS are held out.
FOLDS, HELD_OUT = 7, 2
#: Text bytes of a block.
BLOCK_TEXT = 6 << 20
#: Steps of expectation-maximisation; pseudo-count that the first probabilities keep.
STEPS, KEEP = 2, 32_000.0
MARK = "▁"
#: Words of one usual length handled at once.
BATCH = 1 << 13
#: Words longer than this are taken one by one where fewer than ROWS have about their length, and their
#: edges for a STRETCH of places at a time: bounded scratch space, a few microseconds a character.
LONG, ROWS, STRETCH = 64, 64, 1 << 14

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BLOCKS = "kind int, part int, block long, first long, data binary, more binary, extra binary"


class Lattice:
    """Pieces with log probabilities (natural), and recursions over words."""

    def __init__(self, pieces: list[str], byte: list[int], plain: list[int]):
        self.pieces = pieces
        self.byte = byte
        self.ids = {pieces[i]: i for i in plain}
        self.longest = max(map(len, self.ids), default=1)
        # Hash table of the pieces, open addressing.
        self.bits = 20
        self.keys = np.zeros(1 << self.bits, np.uint64)
        self.values = np.full(1 << self.bits, -1, np.int32)
        self.chain = 1
        for piece, i in self.ids.items():
            h = 0
            for c in piece:
                h = (h * int(_BASE) + ord(c) + 1) & 0xFFFFFFFFFFFFFFFF
            key = int(mix64(np.array([h], np.uint64))[0])
            at, steps = key >> (64 - self.bits), 1
            while self.values[at] >= 0:
                at, steps = (at + 1) & ((1 << self.bits) - 1), steps + 1
            self.keys[at], self.values[at] = key, i
            self.chain = max(self.chain, steps)
        self.alone = np.full(0x110000, -1, np.int32)  # id of a one-character piece
        for piece, i in self.ids.items():
            if len(piece) == 1:
                self.alone[ord(piece)] = i

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Piece of each substring hash, -1 for none."""
        key = mix64(hashes)
        at = (key >> np.uint64(64 - self.bits)).astype(np.int64)
        out = np.where(self.keys[at] == key, self.values[at], -1)
        for _ in range(self.chain - 1):
            at = (at + 1) & ((1 << self.bits) - 1)
            out = np.where(self.keys[at] == key, self.values[at], out)
        return out

    def first(self, scores: list[float]) -> np.ndarray:
        """First log probabilities: by the vocabulary's own order of scores, as one over the rank. Byte
        pieces share what a character without a piece would get."""
        p = np.zeros(len(self.pieces))
        order = sorted(self.ids.values(), key=lambda i: (-scores[i], i))
        p[order] = 1 / (np.arange(len(order)) + 2.0)
        p[self.byte] = 0.5 / (len(order) + 2.0)
        with np.errstate(divide="ignore"):
            return np.log(p / p.sum())

    def powers(self) -> list[np.uint64]:
        out = [np.uint64(1)]
        for _ in range(self.longest):
            out.append(np.uint64(int(out[-1]) * int(_BASE) & 0xFFFFFFFFFFFFFFFF))
        return out

    def edges(self, chars: np.ndarray):
        """For words of about one length (one a row, code points, zeros behind the end): (start, length,
        piece ids) of the edges; length 1 also stands for a character without a piece (-1)."""
        n, size = chars.shape
        sums = [np.zeros(n, np.uint64)]
        for k in range(size):
            sums.append(sums[-1] * _BASE + chars[:, k].astype(np.uint64) + np.uint64(1))
        power = self.powers()
        for i in range(size):
            for k in range(1, min(self.longest, size - i) + 1):
                yield i, k, (self.alone[chars[:, i]] if k == 1 else self.find(sums[i + k] - sums[i] * power[k]))

    def fallback(self, points: np.ndarray, logp: np.ndarray) -> np.ndarray:
        """Log probability of characters by their bytes."""
        return np.array([sum(logp[self.byte[b]] for b in chr(c).encode("utf-8", "surrogatepass")) for c in points.tolist()])

    def _weights(self, chars: np.ndarray, sizes: np.ndarray, logp: np.ndarray) -> list:
        out = []
        for i, k, piece in self.edges(chars):
            inside = i + k <= sizes
            piece = np.where(inside, piece, -1)
            w = np.where(piece >= 0, logp[piece], -np.inf)
            if k == 1 and (none := (piece < 0) & inside).any():
                w[none] = self.fallback(chars[none, i], logp)
            elif k > 1 and not (piece >= 0).any():
                continue
            out.append((i, k, piece, w))
        return out

    def forward(self, chars: np.ndarray, sizes: np.ndarray, logp: np.ndarray) -> np.ndarray:
        """Log marginal probability of each word."""
        if self.is_long(chars):
            return np.array([self._long_forward(c[:n], logp)[-1] for c, n in zip(chars, sizes.tolist())])
        alpha = np.stack(self._forward(self._weights(chars, sizes, logp), chars.shape))
        return alpha[sizes, np.arange(len(sizes))]

    @staticmethod
    def _forward(edges: list, shape: tuple) -> list:
        alpha = [np.zeros(shape[0])] + [np.full(shape[0], -np.inf) for _ in range(shape[1])]
        for i, k, _, w in edges:  # in the order of their starts
            alpha[i + k] = np.logaddexp(alpha[i + k], alpha[i] + w)
        return alpha

    def expected(self, chars: np.ndarray, sizes: np.ndarray, counts: np.ndarray, logp: np.ndarray, total: np.ndarray) -> None:
        """Add the expected piece counts of the words, each taken ``counts`` times, to ``total``."""
        if self.is_long(chars):
            for c, size, n in zip(chars, sizes.tolist(), counts.tolist()):
                self._long_expected(c[:size], n, logp, total)
            return
        edges = self._weights(chars, sizes, logp)
        alpha = self._forward(edges, chars.shape)
        n, size = chars.shape
        whole = np.stack(alpha)[sizes, np.arange(n)]
        beta = [np.where(sizes == i, 0.0, -np.inf) for i in range(size + 1)]
        for i, k, _, w in reversed(edges):
            beta[i] = np.logaddexp(beta[i], w + beta[i + k])
        for i, k, piece, w in edges:
            p = counts * np.exp(alpha[i] + w + beta[i + k] - whole)
            here = piece >= 0
            total += np.bincount(piece[here], p[here], len(total))
            lost = ~here & (i < sizes)
            for c, x in zip(chars[lost, i].tolist(), p[lost].tolist()) if k == 1 and lost.any() else ():
                for b in chr(c).encode("utf-8", "surrogatepass"):
                    total[self.byte[b]] += x

    # Long words one by one: the edges of a stretch of places at once, the recursion place by place.

    @staticmethod
    def is_long(chars: np.ndarray) -> bool:
        """Whether words are better taken one by one than place by place for all of them."""
        return chars.shape[1] > LONG and chars.shape[0] < ROWS

    def _stretches(self, chars: np.ndarray, logp: np.ndarray, backwards: bool = False):
        """(first end, edges) of stretches of at most STRETCH ends: the edges' starts, ends, pieces and
        weights by end, as arrays."""
        size, power = len(chars), self.powers()
        firsts = range(0, size, STRETCH)
        for first in reversed(firsts) if backwards else firsts:
            last = min(first + STRETCH, size)  # ends first + 1 to last
            low = max(0, first + 1 - self.longest)
            own = chars[low:last]
            steps = np.full(len(own) + 1, _BASE, np.uint64)
            steps[0] = 1
            steps = np.cumprod(steps)
            back = np.full(len(own) + 1, np.uint64(pow(int(_BASE), -1, 1 << 64)), np.uint64)
            back[0] = 1
            back = np.cumprod(back)
            # sums[j] = sum over i < j of (c + 1) * base^(j - 1 - i), as for short words
            sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((own.astype(np.uint64) + np.uint64(1)) * back[:-1]))) * steps * np.uint64(pow(int(_BASE), -1, 1 << 64))
            starts, ends, pieces = [], [], []
            for k in range(1, min(self.longest, last) + 1):
                at = np.arange(max(first + 1 - k, 0), last - k + 1)
                piece = self.alone[chars[at]] if k == 1 else self.find(sums[at - low + k] - sums[at - low] * power[k])
                here = np.flatnonzero(piece >= 0) if k > 1 else np.arange(len(at))
                starts.append(at[here])
                ends.append(at[here] + k)
                pieces.append(piece[here])
            start, end, piece = map(np.concatenate, (starts, ends, pieces))
            order = np.lexsort((start, end))
            start, end, piece = start[order], end[order], piece[order]
            w = np.where(piece >= 0, logp[piece], 0.0)
            none = piece < 0
            if none.any():
                points, number = np.unique(chars[start[none]], return_inverse=True)
                w[none] = self.fallback(points, logp)[number]
            yield first, start, end, piece, w

    def _long_forward(self, chars: np.ndarray, logp: np.ndarray, keep: bool = False) -> np.ndarray:
        """Log probability of every beginning (with ``keep``), else of the last ones, of a word."""
        size = len(chars)
        every = np.zeros(size + 1) if keep else None
        last = [0.0]  # of the ends before a stretch, as many as a piece is long
        exp, log = math.exp, math.log
        for first, start, end, _, w in self._stretches(chars, logp):
            low = first - len(last) + 1
            alpha = [*last, *[-math.inf] * (min(first + STRETCH, size) - first)]
            cut = np.flatnonzero(np.diff(end)) + 1
            start, w, bounds = start.tolist(), w.tolist(), [0, *cut.tolist(), len(end)]
            for place, (a, b) in enumerate(zip(bounds, bounds[1:]), first + 1):
                x = [alpha[start[e] - low] + w[e] for e in range(a, b)]
                top = max(x)
                alpha[place - low] = top + log(sum([exp(v - top) for v in x])) if b > a + 1 and top > -math.inf else top
            if keep:
                every[low:low + len(alpha)] = alpha
            last = alpha[-self.longest:]
        return every if keep else np.array(last)

    def _long_expected(self, chars: np.ndarray, count: float, logp: np.ndarray, total: np.ndarray) -> None:
        alpha = self._long_forward(chars, logp, keep=True)
        size = len(chars)
        beta = np.full(size + 1, -np.inf)
        beta[size] = 0.0
        exp, log = math.exp, math.log
        for first, start, end, piece, w in self._stretches(chars, logp, backwards=True):
            # An end's value is whole when its stretch begins: what it gets comes from later ends only.
            low = int(start.min())
            own = beta[low:min(first + STRETCH, size) + 1].tolist()
            s, v = start.tolist(), w.tolist()
            place = end.tolist()
            for e in range(len(s) - 1, -1, -1):
                x, y = own[s[e] - low], v[e] + own[place[e] - low]
                if y > -math.inf:
                    own[s[e] - low] = y if x == -math.inf else max(x, y) + log(1 + exp(-abs(x - y)))
            beta[low:low + len(own)] = own
            p = count * np.exp(alpha[start] + w + beta[end] - alpha[size])
            here = piece >= 0
            total += np.bincount(piece[here], p[here], len(total))
            for c, x in zip(chars[start[~here]].tolist(), p[~here].tolist()):
                for b in chr(c).encode("utf-8", "surrogatepass"):
                    total[self.byte[b]] += x

    def groups(self, words: list[bytes]):
        """(numbers of words, their characters as rows, their lengths): words of one length, or of about
        one where few have it."""
        marked = [MARK + w.decode("utf-8", "replace") for w in words]
        size = np.array([len(w) for w in marked], np.int64)
        order = np.argsort(size, kind="stable")
        lengths, first = np.unique(size[order], return_index=True)
        bounds = [*first.tolist(), len(order)]
        k = 0
        while k < len(lengths):
            j = k + 1
            # As many lengths as make ROWS words, within a fourth of the shortest.
            while j < len(lengths) and bounds[j] - bounds[k] < ROWS and lengths[j] * 4 <= lengths[k] * 5 + 4:
                j += 1
            group, widest = order[bounds[k]:bounds[j]], int(lengths[j - 1])
            each = max(1, BATCH * 16 // (widest + 1))
            for a in range(0, len(group), each):
                part = group[a:a + each]
                joined = "".join([marked[x].ljust(widest, "\0") for x in part.tolist()]).encode("utf-32-le", "surrogatepass")
                yield part, np.frombuffer(joined, np.uint32).reshape(len(part), widest), size[part]
            k = j

    def score(self, words: list[bytes], logp: np.ndarray) -> np.ndarray:
        """Log marginal probability of each word, its mark included."""
        out = np.zeros(len(words))
        for part, chars, sizes in self.groups(words):
            out[part] = self.forward(chars, sizes, logp)
        return out


@lru_cache(maxsize=2)
def lattice_of(model: bytes) -> tuple[Lattice, list[float]]:
    """Lattice and scores of a model's vocabulary, kept by a worker process from task to task."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_proto=model)
    size = sp.get_piece_size()
    plain = [i for i in range(size) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
    byte = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
    return Lattice([sp.id_to_piece(i) for i in range(size)], byte, plain), [sp.get_score(i) for i in range(size)]


class _Words(dict):
    """Word -> local number; new words get the next one."""

    def __missing__(self, word):
        self[word] = n = len(self)
        return n


def _word_hashes(words: list[bytes]) -> np.ndarray:
    import xxhash

    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def word_blocks(docs: DataFrame, parts: int) -> DataFrame:
    """Blocks of documents. Kind 0, one row a block: data = ids (long), more = fold, tokens (int) of each
    document and whether the id is null, extra = word numbers (int). Kind 1, one row a block and part:
    first = number of its first word, data = the words, more = their training counts."""
    def run(batches: Iterator):
        import pyarrow as pa
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32

        def block(rows: list):
            known = _Words()
            ids = [np.fromiter(map(known.__getitem__, w), np.int64, len(w)) for _, _, w in rows]
            fold = np.array([f for _, f, _ in rows], np.int32)
            size = np.array([len(x) for x in ids], np.int32)
            every = np.concatenate([np.zeros(0, np.int64), *ids])
            learned = np.repeat((fold >= 0) & (fold != HELD_OUT), size)
            words = list(known)
            count = np.bincount(every[learned], minlength=len(words))
            part, _ = parts_of(_word_hashes(words), parts)
            order = np.argsort(part, kind="stable")
            new = np.empty(len(words), np.int64)
            new[order] = np.arange(len(words))
            doc = np.array([0 if d is None else d for d, _, _ in rows], np.int64)
            null = np.array([d is None for d, _, _ in rows], np.int32)
            out = [(0, -1, number, 0, doc.tobytes(), np.stack((fold, size, null)).tobytes(), new[every].astype(np.uint32).tobytes())]
            order = order.tolist()
            for p, s in by_part(part[order]):
                own = order[s]
                out.append((1, p, number, s.start, b" ".join([words[k] for k in own]), count[own].astype(np.int64).tobytes(), b""))
            columns = list(zip(*out))
            types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["kind", "part", "block", "first", "data", "more", "extra"])

        rows, size = [], 0
        for batch in batches:
            for s in slices(batch, 64):
                for d, f, t in zip(s.column("doc_id").to_pylist(), s.column("fold").to_pylist(), as_bytes(s.column("text"))):
                    rows.append((d, f, t.lower().split()))
                    size += len(t)
                    if size >= BLOCK_TEXT:
                        yield block(rows)
                        rows, size, number = [], 0, number + 1
        if rows:
            yield block(rows)

    texts = doc_texts(docs).withColumn("fold", F.coalesce(remainder("doc_id", FOLDS), F.lit(-1)).cast("int"))
    return texts.mapInArrow(run, _BLOCKS)


def vocabulary(blocks: DataFrame) -> DataFrame:
    """One row a part: its distinct words, their training counts, the number known and the sum."""
    def run(table):
        import pyarrow as pa

        total: dict[bytes, int] = {}
        for d, m in zip(table["data"].to_pylist(), table["more"].to_pylist()):
            for w, c in zip(d.split(b" "), np.frombuffer(m, np.int64).tolist()):
                total[w] = total.get(w, 0) + c
        counts = np.array(list(total.values()), np.int64)
        return pa.table({"part": pa.array([table["part"][0].as_py()], pa.int32()), "words": pa.array([b" ".join(total)], pa.binary()),
                         "counts": pa.array([counts.tobytes()], pa.binary()), "known": pa.array([int((counts > 0).sum())], pa.int64()),
                         "tokens": pa.array([int(counts.sum())], pa.int64())})

    return blocks.where("kind = 1").select("part", "data", "more").groupBy("part").applyInArrow(run, "part int, words binary, counts binary, known long, tokens long")


def piece_counts(words: DataFrame, model: bytes, logp: np.ndarray) -> np.ndarray:
    """Expected counts of the pieces over all training words."""
    held = words.sparkSession.sparkContext.broadcast((model, logp))  # the vocabulary: fixed size

    def run(batches: Iterator):
        import pyarrow as pa

        model, logp = held.value
        lattice, _ = lattice_of(model)
        total = np.zeros(len(logp))
        for batch in batches:
            for d, c in zip(batch.column("words").to_pylist(), batch.column("counts").to_pylist()):
                own, counts = d.split(b" "), np.frombuffer(c, np.int64)
                seen = np.flatnonzero(counts > 0)
                own, counts = [own[k] for k in seen.tolist()], counts[seen].astype(float)
                for part, chars, sizes in lattice.groups(own) if own else ():
                    lattice.expected(chars, sizes, counts[part], logp, total)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at])], names=["piece", "n"])

    out = np.zeros(len(logp))
    for r in words.select("words", "counts").mapInArrow(run, "piece long, n double").groupBy("piece").agg(F.sum("n").alias("n")).collect():
        out[r["piece"]] = r["n"]  # at most one row per piece of the vocabulary
    return out


def fit(words: DataFrame, model: bytes, steps: int = STEPS) -> np.ndarray:
    """Log probabilities of the pieces after some steps of expectation-maximisation."""
    lattice, scores = lattice_of(model)
    first = np.exp(lattice.first(scores))
    p = first
    for _ in range(steps):
        with np.errstate(divide="ignore"):
            p = piece_counts(words, model, np.log(p)) + KEEP * first
        p /= p.sum()
    with np.errstate(divide="ignore"):
        return np.log(p)


def score_documents(docs: DataFrame, model_path: str = MODEL, steps: int = STEPS) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for every row."""
    model = load_model(model_path)
    parts = count_for(docs, PART_BYTES, 16)
    blocks = written(word_blocks(docs, parts), "word-blocks")
    words = written(vocabulary(blocks), "vocabulary")
    learned = F.col("fold").isNotNull() & (F.col("fold") != HELD_OUT)
    ends = docs.select(remainder("doc_id", FOLDS).alias("fold")).where(learned).count()
    sums = words.agg(F.sum("known").alias("known"), F.sum("tokens").alias("tokens")).first()
    tokens = int(sums["tokens"] or 0) + ends
    distinct = int(sums["known"] or 0) + (ends > 0)
    logp = fit(words, model, steps)
    held = docs.sparkSession.sparkContext.broadcast((model, logp))
    base = math.log10(tokens + distinct + 1)
    end = (ends + 1) / (tokens + 2)
    end_base, end_score, go_on = math.log10(ends + 1), math.log10(end), math.log10(1 - end)
    end_known = int(ends > 0)

    def answer(table, known):
        """For each block's words of a part: training counts and log10 lattice probabilities."""
        import pyarrow as pa

        model, logp = held.value
        lattice, _ = lattice_of(model)
        own = known["words"][0].as_py().split(b" ")
        count = np.frombuffer(known["counts"][0].as_py(), np.int64)
        value = lattice.score(own, logp) / math.log(10)
        number = {w: k for k, w in enumerate(own)}
        at = [np.array([number[w] for w in d.split(b" ")], np.int64) for d in table["data"].to_pylist()]
        return pa.table({"block": table["block"], "first": table["first"], "data": pa.array([count[k].tobytes() for k in at], pa.binary()),
                         "more": pa.array([value[k].tobytes() for k in at], pa.binary())})

    def total(table, answers):
        import pyarrow as pa

        first = answers["first"].to_pylist()
        counts = [np.frombuffer(d, np.int64) for d in answers["data"].to_pylist()]
        values = [np.frombuffer(m, np.float64) for m in answers["more"].to_pylist()]
        size = max([0, *(a + len(c) for a, c in zip(first, counts))])
        count, value = np.zeros(size, np.int64), np.zeros(size)
        for a, c, v in zip(first, counts, values):
            count[a:a + len(c)], value[a:a + len(c)] = c, v
        bases, seen = np.log10(count + 1.0), count > 0
        out: list[list] = [[] for _ in range(6)]
        for d, m, e in zip(table["data"].to_pylist(), table["more"].to_pylist(), table["extra"].to_pylist()):
            doc = np.frombuffer(d, np.int64)
            fold, n, null = np.frombuffer(m, np.int32).reshape(3, -1)
            ids = np.frombuffer(e, np.uint32)
            who = np.repeat(np.arange(len(doc)), n)
            out[0] += [None if x else i for i, x in zip(doc.tolist(), null.tolist())]
            out[1] += (fold == HELD_OUT).tolist()
            out[2] += (n + 1).tolist()
            out[3] += (np.bincount(who, seen[ids], len(doc)).astype(np.int64) + end_known).tolist()
            out[4] += (np.bincount(who, bases[ids], len(doc)) + end_base - (n + 1) * base).tolist()
            out[5] += (np.bincount(who, value[ids], len(doc)) + n * go_on + end_score).tolist()
        types = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
        return pa.table([pa.array(c, t) for c, t in zip(out, types)], names=["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"])

    asked = blocks.where("kind = 1").select("part", "block", "first", "data")
    answers = asked.groupBy("part").cogroup(words.select("part", "words", "counts").groupBy("part")).applyInArrow(
        answer, "block long, first long, data binary, more binary")
    rows = blocks.where("kind = 0").select("block", "data", "more", "extra")
    scored = rows.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        total, "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return scored.withColumn("train_tokens", F.lit(tokens).cast("long")).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def digest(docs: DataFrame) -> DataFrame:
    """Contract columns of the registered query."""
    return score_documents(docs)
