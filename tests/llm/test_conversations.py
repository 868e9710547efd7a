"""Repair of conversations against a search through all edits."""

import collections
import hashlib
import itertools
import random
import re
import zlib

import pytest

from kilnwork.llm import conversation_repair as repair

VISIBLE = re.compile(r"[^\x20\x09-\x0D]")


def brute_repair(rows):
    """Least (cost, edits, turns) over all edits of ``(role, text, fault)`` rows, by comparing whole edit strings."""
    best = {}

    def go(i, state, inserts):
        if (i, state, inserts) in best:
            return best[i, state, inserts]
        found = []
        if i == len(rows) and state in (0, 3):
            found.append((0, "", ()))
        if inserts < 3:
            who, after = [("user", 2), ("user", 2), ("assistant", 3), ("user", 2)][state]
            c, a, t = go(i, after, inserts + 1)
            found.append((c + 2, "I" + a, ((who, ""), *t)))
        if i < len(rows):
            role, text, fault = rows[i]
            c, a, t = go(i + 1, state, 0)
            found.append((c + 3, "D" + a, t))
            if fault not in ("blank", "duplicate"):
                extra = fault == "truncated"
                after = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}.get((state, role[:1]))
                if after is not None:
                    c, a, t = go(i + 1, after, 0)
                    found.append((c + extra, "K" + a, ((role, text), *t)))
                who, after = [("user", 2), ("user", 2), ("assistant", 3), ("user", 2)][state]
                c, a, t = go(i + 1, after, 0)
                found.append((c + 2 + extra, "R" + a, ((who, text), *t)))
        best[i, state, inserts] = min(found) if found else (10**9, "", ())
        return best[i, state, inserts]

    return go(0, 0, 0)


def brute(rows):
    """What the query returns, from ``(conv_id, turn, role, text)`` rows."""
    held = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        held[conv]
        role, text = (" " if x is None else x for x in (role, text))
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        held[conv] += [(turn is not None, turn or 0, "user" if fault == 4 else role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1)
    out = []
    for conv, own in held.items():
        own.sort()
        seen, marked = set(), []
        for _, _, role, text in own:
            shown = VISIBLE.findall(text)
            fault = "blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else ""
            seen.add((role, text))
            marked.append((role, text, fault))
        turns = {t for known, t, _, _ in own if known}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(marked))
        cost, audit, done = brute_repair(marked)
        faults = collections.Counter(f for _, _, f in marked)
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in done).encode()).hexdigest()
        out.append((conv, gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit, digest))
    return sorted(out, key=repr)


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def check(spark, rows):
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "conv_id long, turn long, role string, text string, letters string, audit string")
    got = repair.digests(repair.damaged(df.repartition(5)), df)
    assert got.columns == COLUMNS
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows)


@pytest.mark.parametrize("alphabet", ["suaoSUAOx", "uax", "sUo", "saU"])
def test_automaton_finds_the_least_edits(alphabet):
    forms = ["".join(p) for n in range(6) for p in itertools.product(alphabet, repeat=n)][:4000]
    r = random.Random(1)
    forms += ["".join(r.choices(alphabet, k=r.randrange(6, 14))) for _ in range(300)]
    automaton = repair.Automaton()
    for form in sorted(forms, key=lambda f: f[::-1]):
        rows = [(f.lower(), "", "truncated" if f.isupper() else "duplicate" if f == "x" else "") for f in form]
        assert automaton.repair(form) == brute_repair(rows)[:2], form
    different = {f[i:] for f in forms for i in range(len(f))}
    assert automaton.made == len(different)


def test_repair_of_random_conversations(spark):
    r = random.Random(2)
    texts = ["Hello.", "Hello", "Why?", "", " \t", "One! two ", "é。", "Ends. \n", "\x0bx\x0c"]
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", "System"]
    rows = [(c, t, r.choice(roles), r.choice(texts)) for c in range(150) for t in range(r.randrange(1, 12))]
    check(spark, rows)


def test_repair_of_odd_rows(spark):
    rows = [(None, None, None, None), (None, 1, "user", "Hi."), (1, None, "user", "A."), (1, None, "assistant", "B."), (1, 5, "user", "A."), (1, -3, "user", None)]
    rows += [(2, 1, "user", "Same.")] * 5 + [(2, 2, "user", "Same.")] * 3 + [(3, 1, "", ""), (4, 7, "assistant", "long " * 50_000 + ".")]
    rows += [(c, 0, "user", "Only.") for c in range(10, 80)]  # some lose their only row
    check(spark, rows)
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert repair.digests(repair.damaged(empty), empty).count() == 0 and repair.repair(empty).count() == 0


def test_repair_of_a_long_conversation(spark):
    r = random.Random(3)
    rows = [(1, t, r.choice(["user", "assistant"]), r.choice(["Yes.", "No", f"Turn {t}."])) for t in range(3000)]
    rows += [(c, 0, "user", "Hello.") for c in range(2, 200)]
    import sys

    limit = sys.getrecursionlimit()
    sys.setrecursionlimit(100_000)
    try:
        check(spark, rows)
    finally:
        sys.setrecursionlimit(limit)


def test_repaired_turns(spark):
    rows = [(1, 1, "assistant", "Late"), (1, 2, "system", "Rules."), (1, 3, "user", "Q?"), (1, 4, "user", "Q?"), (2, 1, "user", "Q?"), (2, 2, "assistant", " ")]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    got = collections.defaultdict(list)
    for x in repair.repair(df).orderBy("conv_id", "position").collect():
        got[x.conv_id].append((x.position, x.edit, x.role, x.text))
    for conv in (1, 2):
        seen, marked = set(), []
        for _, _, role, text in [x for x in rows if x[0] == conv]:
            fault = "blank" if not VISIBLE.search(text) else "duplicate" if (role, text) in seen else "truncated" if text[-1] not in ".!?" else ""
            seen.add((role, text))
            marked.append((role, text, fault))
        _, audit, done = brute_repair(marked)
        assert [(p, r, t) for p, _, r, t in got[conv]] == [(i, r, t) for i, (r, t) in enumerate(done)]
        assert "".join(e for _, e, _, _ in got[conv]) == audit.replace("D", "")
