"""Spelling groups against a plain version: counts, near words, forms and roots."""

import random
import re
import zlib
from collections import Counter

import pytest

from delivery_lake.llm import op11_spelling as spelling

SCHEMA = "doc_id long, text string, word string, n string, form string, size string, gram string"


def brute(rows, least_chars=6, least_count=5, factor=5, one_in=199):
    count = Counter()
    for doc_id, text in rows:
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for run in re.findall("[A-Za-zÀ-ÿ]+", lower):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % one_in == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= least_chars:
                count[run] += 1
    words = {w: n for w, n in count.items() if n >= least_count}
    letters = {c for w in words for c in w}

    def near(w):
        out = {w[:i] + w[i + 1:] for i in range(len(w))}
        out |= {w[:i] + c + w[i + 1:] for i in range(len(w)) for c in letters}
        out |= {w[:i] + c + w[i:] for i in range(len(w) + 1) for c in letters}
        return [x for x in out - {w} if x in words]

    form = {}
    around = {w: near(w) for w in words}
    for w, n in words.items():
        best = min(around[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best and words[best] >= factor * n else None
    out = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(around[w]), words.get(form[w])))
    return sorted(out)


def make_rows():
    rng = random.Random(11)
    stems = ["straße", "naïvely", "ÜBERMUT", "internet", "planning", "planing", "banana", "bananas", "aaaaaa", "aaaaaaa", "colour", "color",
             "×÷×÷×÷", "Éclair", "éclairs", "abcdef", "abcdeg", "bbcdef", "zabcdef", "abcdefz", "abxcdef"]
    typos = []
    for s in stems:
        for _ in range(6):
            i = rng.randrange(len(s))
            typos += [s[:i] + s[i + 1:], s[:i] + rng.choice("abcé") + s[i:], s[:i] + rng.choice("xyzü") + s[i + 1:]]
    # a chain: each five times as frequent as the one before it, one edit apart
    chain = [("chainaa", 3200), ("chainab", 640), ("chainbb", 128), ("chaibbb", 25), ("chabbbb", 5)]
    texts = [" ".join(rng.choices(stems, k=rng.randint(0, 60)) + rng.choices(typos, k=rng.randint(0, 30))) for _ in range(160)]
    texts += [" ".join([w] * n) for w, n in chain]
    texts += ["", " \n", None, "x" * 9000, "1234 !?", "Internet,internet;INTERNET-internet_internet9internet", texts[0], texts[1]]
    rows = [(i * 3, t) for i, t in enumerate(texts)]
    return rows + [rows[0], rows[0], (None, texts[3]), (None, None), (5, texts[4])]


@pytest.fixture(scope="module")
def rows():
    return make_rows()


def frame(spark, rows):
    return spark.createDataFrame([r + ("w", "n", "f", "s", "g") for r in rows], SCHEMA).repartition(3)


def test_spelling_groups_equal_brute_force(spark, rows):
    want = brute(rows)
    assert sum(w[1] is not None for w in want) > 5 and max(w[4] for w in want) >= 3
    got = sorted(tuple(r) for r in spelling.digest(frame(spark, rows)).collect())
    assert got == want


def test_damage_and_chains(spark, rows):
    want = brute(rows, one_in=7)
    got = sorted(tuple(r) for r in spelling.spelling_groups(frame(spark, rows), one_in=7).collect())
    assert got == want
    chain = {w[0]: w[2] for w in brute(rows) if w[0].startswith("cha")}
    assert chain["chabbbb"] == "chainaa" and chain["chainaa"] == "chainaa"


def test_every_single_edit_is_found(spark):
    """All edits of words of even and odd length, at every place."""
    words = set()
    for w in ("abcdef", "abcdefg", "aaaaaaaa", "xyxyxyxyx"):
        words.add(w)
        for i in range(len(w) + 1):
            words |= {w[:i] + c + w[i:] for c in "az"} | {w[:i] + w[i + 1:]} | {w[:i] + "q" + w[i + 1:]}
    words = sorted(w for w in words if len(w) >= 6)
    rows = [(i, " ".join([w] * 5)) for i, w in enumerate(words)]
    want = brute(rows, one_in=1 << 40)
    got = sorted(tuple(r) for r in spelling.spelling_groups(frame(spark, rows), one_in=1 << 40).collect())
    assert got == want


def test_candidates_are_not_rows_of_their_own(spark, rows):
    """The join verifies its candidates itself; nothing is joined without a key."""
    words = spelling.frequent_words(frame(spark, rows))
    plan = spelling.near_words(words)._jdf.queryExecution().executedPlan().toString()
    assert "levenshtein" in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_empty_tables(spark):
    assert spelling.digest(frame(spark, []).limit(0)).count() == 0
    assert spelling.digest(spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")).count() == 0
