"""Secret scan: fixed patterns and sliding-window Shannon entropy.

``scan_secrets(docs)`` returns one row per input row with the spans found in the whole text.

Pattern spans (``assign``, ``access``, ``hex``) are the leftmost non-overlapping matches of each kind;
matches that are too short are dropped after matching, as they still use up their characters.

Entropy spans (``entropy_hex``, ``entropy_b64``) come from candidate strings, the maximal runs of a
character class. A window of fixed width slides over the candidate; its Shannon entropy is kept up to
date from the counts of the two characters that leave and enter. Windows at or above the class's
threshold are merged to spans. A span must mix kinds of characters (lower case, upper case, digits): two
of them, and all three in candidates of under 24 characters, which have a shorter window. An allow list
suppresses candidates that look random but are not secrets (UUIDs, ordered alphabets, numbers, and runs of
letters with the case pattern of words) and spans inside a pattern span. Random letters of one case only
are not told from words and have no span, nor have candidates of under 16 characters.

Offsets are code points, the end exclusive. Null text counts as empty and has no span; a null doc_id
is kept as it is; equal rows are scanned separately and give equal results. Extra columns are ignored
by ``scan_secrets`` and kept by ``redact_secrets``."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delivery_lake.llm.common import doc_texts, modest_batches, slices

#: The pattern of each kind and the least length of what must match.
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")
KINDS = ("assign", "access", "hex", "entropy_hex", "entropy_b64")
#: Every assignment has one of these in it, in some case (checked before the slower pattern runs).
KEYWORDS = ("passw", "secret", "token", "api")

#: Character classes of candidate strings: kind, pattern of a maximal run, window width, least entropy in
#: bits, least kinds of characters (lower case, upper case, digits) in a span. Short candidates must have all.
CLASSES = (
    ("entropy_hex", re.compile(r"(?<![0-9A-Fa-f])[0-9A-Fa-f]{32,}(?![0-9A-Fa-f])"), 32, 3.0, 2),
    ("entropy_b64", re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{24,}"), 24, 3.9, 2),
    ("entropy_b64", re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,23}(?![A-Za-z0-9+/_=-])"), 16, 3.5, 3),
)
KINDS_OF_CHARACTERS = tuple(re.compile(p) for p in ("[a-z]", "[A-Z]", "[0-9]"))
#: Allow list: candidates that match one of these whole are no secrets.
ALLOWED = [
    re.compile(r"[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}"),  # UUID
    re.compile(r"[=_+/-]+"),  # rules and separators
    re.compile(r"[0-9]+([-/_][0-9]+)*"),  # numbers, dates, phone numbers
]
#: Allow list: letters only, perhaps joined by hyphens, underscores or slashes, are words if their case
#: changes at no more than this share of places (it does at half of them in random letters).
LETTERS = re.compile(r"[A-Za-z]+([-_/][A-Za-z]+)*[-_/]?")
CASE_CHANGE = re.compile("(?<=[a-z])[A-Z]|(?<=[A-Z])[a-z]")
MOST_CHANGES = 0.3
#: Allow list: ordered alphabets; a candidate that is made of pieces of these is no secret.
ORDERED = ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789")

_SCHEMA = "doc_id long, spans array<struct<kind:int,start:int,end:int>>"


def entropy_windows(s: str, width: int, threshold: float) -> list[tuple[int, int]]:
    """Merged [start, end) of the windows of ``width`` characters whose Shannon entropy reaches
    ``threshold`` bits. The sum of n log n over the counts is updated per step, never recomputed."""
    if len(s) < width:
        return []
    n_log_n = [0.0] + [n * math.log2(n) for n in range(1, width + 1)]
    limit = width * (math.log2(width) - threshold) + 1e-9  # entropy >= threshold <=> sum <= limit
    counts: dict[str, int] = {}
    total = 0.0
    found: list[list[int]] = []
    for i, c in enumerate(s):
        n = counts.get(c, 0)
        counts[c] = n + 1
        total += n_log_n[n + 1] - n_log_n[n] if n < width else 0.0
        if i >= width:
            old = s[i - width]
            m = counts[old]
            counts[old] = m - 1
            total += n_log_n[m - 1] - n_log_n[min(m, width)]
        if i >= width - 1 and total <= limit:
            start = i - width + 1
            if found and start <= found[-1][1]:
                found[-1][1] = i + 1
            else:
                found.append([start, i + 1])
    return [(a, b) for a, b in found]


def allowed(s: str) -> bool:
    """Whether the allow list suppresses this candidate string."""
    if any(p.fullmatch(s) for p in ALLOWED):
        return True
    if LETTERS.fullmatch(s) and len(CASE_CHANGE.findall(s)) <= MOST_CHANGES * len(s):
        return True
    steps = sum(1 for a, b in zip(s, s[1:]) if any(a + b in o for o in ORDERED))
    return steps >= 0.8 * (len(s) - 1)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the pattern matches that are long enough."""
    out = []
    low = text.lower()
    if ("=" in text or ":" in text) and any(k in low for k in KEYWORDS):
        out += [(0, m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        out += [(1, m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    out += [(2, m.start(), m.end()) for m in HEX.finditer(text)]
    return out


def find_spans(text: str) -> list[tuple[int, int, int]]:
    """All spans of one text by start, then kind as listed in ``KINDS``."""
    out = base_spans(text)
    base = sorted((a, b) for _, a, b in out)
    for name, pattern, width, threshold, least_kinds in CLASSES:
        for m in pattern.finditer(text):
            if allowed(m[0]):
                continue
            for a, b in entropy_windows(m[0], width, threshold):
                a, b = a + m.start(), b + m.start()
                kinds = sum(1 for p in KINDS_OF_CHARACTERS if p.search(text, a, b))
                if kinds >= least_kinds and not any(x <= a and b <= y for x, y in base):
                    out.append((KINDS.index(name), a, b))
    return sorted(out, key=lambda x: (x[1], x[0], x[2]))


def _scan(batches: Iterator):
    import pyarrow as pa

    kind = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))
    for batch in batches:
        for part in slices(batch):
            spans = [[{"kind": k, "start": a, "end": b} for k, a, b in find_spans(t or "")] for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(spans, kind)], names=["doc_id", "spans"])


def scan_secrets(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``spans`` (array of kind index into ``KINDS``, start, end) for every row."""
    return doc_texts(docs).mapInArrow(_scan, _SCHEMA)


def masked(text: str, mark: str = "[SECRET]") -> str:
    """The text with every (merged) span replaced by ``mark``."""
    out, at, end = [], 0, -1
    for _, a, b in find_spans(text):
        if a < end:
            end = max(end, b)
            continue
        if end >= 0:
            out.append(mark)
            at = end
        out.append(text[at:a])
        end = b
    if end < 0:
        return text
    return "".join([*out, mark, text[end:]])


def redact_secrets(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """The documents, all columns, with the spans of ``text`` masked; ``n_chars`` follows where it
    exists. Null texts stay null; rows are never dropped."""
    import pyarrow as pa

    columns = docs.columns

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                new = [None if t is None else masked(t, mark) for t in part.column("text").to_pylist()]
                i = part.schema.get_field_index("text")
                yield part.set_column(i, part.schema.field(i), pa.array(new, part.schema.field(i).type))

    out = modest_batches(docs).mapInArrow(run, docs.schema)
    if "n_chars" in columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(kind)))
    return out.select(*columns)


def joined(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))))


def digest(docs: DataFrame) -> DataFrame:
    """Contract columns of the registered query."""
    found = scan_secrets(docs)
    of = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    return found.select("doc_id", of(0).alias("n_assign"), of(1).alias("n_access"), of(2).alias("n_hex"),
                        F.sha2(joined(F.filter("spans", lambda s: s["kind"] < 3)), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"),
                        F.size(F.filter("spans", lambda s: s["kind"] > 2)).cast("long").alias("n_entropy"))
