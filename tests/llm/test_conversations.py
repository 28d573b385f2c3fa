"""Conversation repair against a plain version: a search over all repairs, states kept instead of tables."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from delivery_lake.llm import op12_conversations as conversations

SCHEMA = "conv_id long, turn long, role string, text string, dropped string, kind string, copy string, audit string"


def damaged(rows):
    out = []
    for conv_id, turn, role, text in rows:
        s = lambda x: " " if x is None else x
        kind = zlib.crc32(f"{s(conv_id)}:{s(turn)}".encode()) % 20
        role, text = s(role), s(text)
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out += [(conv_id, turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def repaired(turns):
    """(cost, audit, lines) of the cheapest repair with the least audit: all repairs, by their last letter."""
    best = {"": (0, "", ())}
    after = {"": "u", "s": "u", "a": "u", "u": "a"}
    name = {"u": "user", "a": "assistant"}

    def settle(states):
        while True:  # insertions, until nothing gets better
            changed = False
            for s, (c, a, lines) in list(states.items()):
                t = after[s]
                new = (c + 5, a + "I", (*lines, name[t] + ":"))
                if t not in states or new[:2] < states[t][:2]:
                    states[t], changed = new, True
            if not changed:
                return states

    best = settle(best)
    for role, text, forced, truncated in turns:
        new = {}

        def offer(s, x):
            if s not in new or x[:2] < new[s][:2]:
                new[s] = x

        for s, (c, a, lines) in best.items():
            offer(s, (c + 2, a + "D", lines))
            if not forced:
                e = 5 if truncated else 0
                t = after[s]
                offer(t, (c + 1 + e, a + "R", (*lines, f"{name[t]}:{text}")))
                if role[:1] == t or (s == "" and role[:1] == "s"):
                    offer(role[:1], (c + e, a + "K", (*lines, f"{role}:{text}")))
        best = settle(new)
    return min((best[s] for s in ("", "a") if s in best), key=lambda x: x[:2])


def brute(rows, hurt=True):
    groups = defaultdict(list)
    for r in rows:
        groups[r[0]]
    for r in damaged(rows) if hurt else [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]:
        groups[r[0]].append(r)
    out = []
    for conv_id, found in groups.items():
        found.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
        seen, turns, count = set(), [], dict.fromkeys("bdt", 0)
        for _, _, role, text in found:
            body = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = "b" if not body else "d" if (role, text) in seen else "t" if body[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                count[fault] += 1
            turns.append((role, text, fault in ("b", "d"), fault == "t"))
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(found, found[1:]))
        numbers = [r[1] for r in found if r[1] is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        cost, audit, lines = repaired(turns)
        out.append((conv_id, gaps, count["b"], count["d"], count["t"], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=repr)


def make_rows():
    rng = random.Random(12)
    rows = []
    for conv in range(400):
        turn = rng.randint(-3, 3)
        for i in range(rng.randint(0, 12) if conv % 50 else 90):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "u", "a", "", "Sys", None] if conv % 3 else ["user", "assistant"])
            if conv % 2 and role in ("user", "assistant"):
                role = "assistant" if i % 2 else "user"
            text = rng.choice(["Yes.", "Yes.", f"Line {i}.", "no end", f"Was {conv}?\n ", " \t\x0b", "", None, "\xa0", "Ünï!", f"x{rng.random()}."])
            rows.append((conv if conv != 7 else None, turn if rng.random() > 0.05 else None, role, text))
            turn += rng.choice([0, 1, 1, 1, 1, 2])
    rng.shuffle(rows)
    return rows + rows[:5] + [(1000, 1, "user", "a " * 200000 + "."), (1000, 2, "assistant", "b!")]


@pytest.fixture(scope="module")
def rows():
    return make_rows()


def frame(spark, rows):
    return spark.createDataFrame([r + ("d", "k", "c", "a") for r in rows], SCHEMA).repartition(3)


def test_repair_equals_search_over_all_repairs(spark, rows):
    got = sorted((tuple(r) for r in conversations.digest(frame(spark, rows)).collect()), key=repr)
    want = brute(rows)
    assert got == want
    # a deletion always mends what an insertion could, for less: insertions occur inside pieces only
    assert {a for w in want for a in w[7]} == set("DKR") and sum(w[7] == "" for w in want) >= 1


@pytest.mark.parametrize("piece", [1, 2, 3, 7])
def test_pieces_give_the_result_of_one_table(rows, piece, monkeypatch):
    monkeypatch.setattr(conversations, "PIECE", piece)
    groups = defaultdict(list)
    for r in damaged(rows):
        groups[r[0]].append(r)
    want = {w[0]: w for w in brute(rows)}
    for conv_id, found in groups.items():
        found.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
        now = conversations.Conversation(conv_id)
        for _, turn, role, text in found:
            now.add(turn, role, text)
        assert now.result() == want[conv_id]


def test_table_inside_its_bands_is_exact():
    """Every cell within the bound has its true cost; every length's audit is the least of all of its cost."""
    rng = random.Random(3)
    for _ in range(150):
        seen = set()
        piece = [conversations.Turn(rng.choice(["user", "assistant", "system", "tool"]), rng.choice(["a.", "b.", "c.", "d", "", f"{i}."]), seen) for i in range(rng.randint(0, 7))]
        bound = conversations.incumbent(piece, "", "a")
        table = conversations.Table(piece, "a", bound)
        n = len(piece)

        def true(i, left, memo={}):
            key = (id(piece), i, left)
            if key in memo:
                return memo[key]
            best = [] if n - i or left else [(0, "")]
            if i < n:
                c, a = true(i + 1, left)
                best.append((c + 2, "D" + a))
            if left:
                c, a = true(i, left - 1)
                best.append((c + 5, "I" + a))
            if i < n and left and not piece[i].forced:
                c, a = true(i + 1, left - 1)
                keep = piece[i].initial == table.letter(left)
                best.append((c + piece[i].extra + (0 if keep else 1), ("K" if keep else "R") + a))
            memo[key] = min(best)
            return memo[key]

        for i in range(n + 1):
            for left in range(table.width):
                c, a = true(i, left, {})
                if c <= bound:
                    assert table.cost[i, left] == c and table.audit(i, left) == a
                else:
                    assert table.cost[i, left] > bound


def test_a_long_conversation(spark):
    rng = random.Random(5)
    rows = [(1, i, rng.choice(["user", "assistant"]), rng.choice(["a.", f"{i}.", f"{i}!", f"{i}?", "end"])) for i in range(1500)]
    got = [tuple(r) for r in conversations.digest(frame(spark, rows)).collect()]
    assert got == brute(rows)


def test_repaired_turns_hash_to_the_digest(spark, rows):
    hurt = conversations.damage(frame(spark, rows))
    groups = defaultdict(list)
    for r in conversations.repaired_turns(hurt).collect():
        groups[r.conv_id].append(r)
    want = {r.conv_id: r for r in conversations.repair(hurt).collect()}
    assert set(groups) == {c for c, r in want.items() if set(r.audit) - {"D"}}
    for conv_id, r in want.items():
        found = sorted(groups[conv_id], key=lambda t: t.place)
        assert [t.place for t in found] == list(range(len(found))) and "".join(t.edit for t in found) == r.audit.replace("D", "")
        assert hashlib.sha256("\n".join(f"{t.role}:{t.text}" for t in found).encode()).hexdigest() == r.repaired_sha256
        assert re.fullmatch("(s?(ua)+)?", "".join(t.role[:1] for t in found))


def test_undamaged_and_empty_tables(spark, rows):
    got = sorted((tuple(r) for r in conversations.repair(conversations.turns(frame(spark, rows))).collect()), key=repr)
    assert got == brute(rows, hurt=False)
    empty = frame(spark, rows).limit(0)
    assert conversations.digest(empty).count() == 0 and conversations.repaired_turns(conversations.damage(empty)).count() == 0
