"""Conversation repair against the best of all edits, turn by turn."""

import hashlib
import random
from functools import lru_cache

import pytest

from millrace.llm import conversation
from millrace.llm.conversation import repair, repair_conversations, wagner_fischer

BLANK = " \t\n\x0b\x0c\r"


def brute_repair(codes):
    """(cost, audit, target) by trying every edit at every turn, in the grammar's own states."""
    @lru_cache(None)
    def best(i, place, inserted):
        out = [(0, "", "")] if i == len(codes) and place in (0, 2) else []

        def add(cost, edit, letter, rest):
            if rest is not None:
                out.append((cost + rest[0], edit + rest[1], letter + rest[2]))

        if i < len(codes):
            add(4, "D", "", best(i + 1, place, 0))
            if codes[i] != "#":
                cut = 3 if codes[i].isupper() or codes[i] == "!" else 0
                for t in {0: "su", 1: "u", 2: "u", 3: "a"}[place]:
                    rest = best(i + 1, {"s": 1, "u": 3, "a": 2}[t], 0)
                    if codes[i].lower() == t:
                        add(cut, "K", t, rest)
                    elif t != "s":
                        add(3 + cut, "R", t, rest)
        if inserted < 3:
            add(3, "I", "a" if place == 3 else "u", best(i, 2 if place == 3 else 3, inserted + 1))
        return min(out) if out else None

    for i in range(len(codes), -1, -100):  # from the end, so that recursion stays shallow
        for place in range(4):
            best(i, place, 0)
    return best(0, 0, 0)


def brute_report(turns):
    """What the contract says of (turn, role, text) rows of one conversation, in order."""
    seen, faults = set(), []
    for _, role, text in turns:
        bare = text.strip(BLANK)
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
        seen.add((role, text))
        faults.append(fault)
    codes = ""
    for (_, role, _), fault in zip(turns, faults):
        letter = role[0] if role and role[0] in "sua" else "?"
        codes += "#" if fault in ("blank", "duplicate") else (letter.upper() if letter != "?" else "!") if fault else letter
    cost, audit, target = brute_repair(codes)
    out, rows, letters = [], iter(turns), iter(target)
    for edit in audit:
        if edit == "I":
            out.append({"u": "user", "a": "assistant"}[next(letters)] + ":")
            continue
        _, role, text = next(rows)
        if edit == "D":
            continue
        letter = next(letters)
        out.append(f"{role if edit == 'K' else {'u': 'user', 'a': 'assistant'}[letter]}:{text}")
    numbers = {t for t, _, _ in turns if t is not None}
    pairs = [(a[:1] + b[:1]) for (_, a, _), (_, b, _) in zip(turns, turns[1:])]
    return (max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest())


def brute_table(rows, ids):
    """Reports of (conv, turn, role, text) rows."""
    by_id = {c: [] for c in ids}
    for conv, turn, role, text in rows:
        by_id[conv].append((turn, " " if role is None else role, " " if text is None else text))
    order = lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode())
    return {c: brute_report(sorted(turns, key=order)) for c, turns in by_id.items()}


def as_dict(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


def test_repair_of_random_codes():
    rnd = random.Random(3)
    for _ in range(1500):
        codes = "".join(rnd.choice("suaSUA?!#uauauaua") for _ in range(rnd.choice([0, 1, 2, 3, 4, 5, 8, 15, 16, 17, 33, 50])))
        assert repair(codes) == brute_repair(codes)[:2]


def test_band_leaves_out_nothing_within_the_limit():
    rnd = random.Random(4)
    for _ in range(500):
        codes = "".join(rnd.choice("suaUA#") for _ in range(rnd.randint(0, 9)))
        target = ("s" if rnd.random() < 0.3 else "") + "ua" * rnd.randint(0, 5)
        whole = wagner_fischer(codes, target, 1 << 40)
        if whole is None:
            continue
        for limit in range(whole[0], whole[0] + 8):
            assert wagner_fischer(codes, target, limit) == whole
        assert wagner_fischer(codes, target, whole[0] - 1) is None


def random_rows(rnd, sizes):
    rows = []
    for conv, n in sizes.items():
        for turn in range(n):
            text = rnd.choice(["fine.", "ok!", "cut", "", " ", None, f"text {turn}.", f"long {turn}", "É?", "tail. \n"])
            role = rnd.choice(["user", "assistant", "user", "assistant", "system", "tool", "User", "", None])
            for _ in range(1 + (rnd.random() < 0.1)):
                rows.append((conv, rnd.choice([turn, turn, turn, None, turn + 3]), role, text))
    rnd.shuffle(rows)
    return rows


SCHEMA = "conv_id bigint, turn bigint, role string, text string"


@pytest.mark.parametrize("whole", [4096, 30])
def test_both_ways_agree_with_brute_force(llm, whole):
    rnd = random.Random(whole)
    rows = random_rows(rnd, {**{c: rnd.randint(1, 9) for c in range(40)}, 100: 90, 101: 300, None: 50})
    df = llm.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA + ", conv string, cost int").repartition(5)
    ids = llm.createDataFrame([(c,) for c in [*range(45), 100, 101, None]], "conv_id bigint")
    got = as_dict(repair_conversations(df, ids, whole=whole))
    assert got == brute_table(rows, [*range(45), 100, 101, None])


def test_one_conversation_holds_nearly_all(llm):
    rnd = random.Random(9)
    rows = random_rows(rnd, {1: 1500, 2: 3}) + [(1, 7, "user", "again and again.")] * 500
    out = repair_conversations(llm.createDataFrame(rows, SCHEMA).repartition(8), whole=200, with_text=True)
    want = brute_table(rows, [1, 2])
    assert {r.conv_id: tuple(x for x in r[1:8]) + (r.repaired_sha256,) for r in out.collect()} == want
    assert all(hashlib.sha256(r.repaired.encode()).hexdigest() == r.repaired_sha256 for r in out.collect())


def test_nothing_and_long_texts(llm):
    none = llm.createDataFrame([], SCHEMA)
    assert repair_conversations(none).count() == 0
    ids = llm.createDataFrame([(5,), (5,), (None,)], "conv_id bigint")
    blank = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert as_dict(repair_conversations(none, ids)) == {5: blank, None: blank}
    rows = [(1, 0, "user", "word " * 200000 + "."), (1, 1, "assistant", "x" * 10 ** 6)]
    assert as_dict(repair_conversations(llm.createDataFrame(rows, SCHEMA))) == brute_table(rows, [1])
    assert conversation.text_fault("a.\r\n") == ""
