"""Conversation repair against every repair by brute force."""

import hashlib
import itertools
import re
import zlib

import numpy as np
import pytest

from tidemark.llm import repair

SHAPE = "conv_id long, turn long, role string, text string, copies int"


def damage(rows):
    out = []
    for c, t, role, text in rows:
        said = [" " if x is None else str(x) for x in (c, t)]
        lot = zlib.crc32(":".join(said).encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if lot == 1:
            text = ""
        elif lot == 2:
            text = re.sub("[.!?]", "", text)
        elif lot == 4:
            role = "user"
        out += [(c, t, role, text)] * (0 if lot == 0 else 2 if lot == 3 else 1)
    return out


def faults_of(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        body = re.sub(r"[\x20\x09-\x0D]", "", text)
        out.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows, most=4):
    """Smallest (cost, audit) with its lines by trying every edit of every row with up to two inserts at each place."""
    faults = faults_of(rows)
    best = None
    gaps = [((), (), 0)] + [(("I",) * k, p, 5 * k) for k in (1, 2) for p in itertools.product(("user", "assistant"), repeat=k)]

    def go(i, cost, audit, lines):
        nonlocal best
        if best is not None and cost > best[0]:
            return
        for letters, roles, c in gaps:
            here = lines + [f"{r}:" for r in roles]
            text = audit + "".join(letters)
            if i == len(rows):
                if re.fullmatch("(s?(ua)+)?", "".join(x[0] for x in here)) and (best is None or (cost + c, text) < best[:2]):
                    best = (cost + c, text, here)
                continue
            _, _, role, body = rows[i]
            go(i + 1, cost + c + 2, text + "D", here)
            if faults[i] in ("blank", "duplicate"):
                continue
            stay = 5 if faults[i] == "truncated" else 0
            go(i + 1, cost + c + stay, text + "K", here + [f"{role}:{body}"] if role else here + ["?"])
            for r in ("user", "assistant"):
                go(i + 1, cost + c + stay + 1, text + "R", here + [f"{r}:{body}"])

    go(0, 0, "", [])
    return best


def wanted(rows, ids):
    out = {}
    hurt = damage(rows)
    for c in ids:
        mine = sorted((r for r in hurt if r[0] == c), key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        turns = {r[1] for r in mine if r[1] is not None}
        faults = faults_of(mine)
        pairs = [a[2][:1] + b[2][:1] for a, b in zip(mine, mine[1:])]
        cost, audit, lines = cheapest(mine)
        out[c] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *[faults.count(f) for f in ("blank", "duplicate", "truncated")],
                  sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


NAMES = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def test_the_query_equals_brute_force(spark, tmp_path):
    rng = np.random.default_rng(3)
    texts = ["Yes.", "No!", "Why?", "and so", "", " \t", None, "Yes.", "Öl. ", "end.\n", "x "]
    roles = ["user", "assistant", "system", "tool", "", None, "user", "assistant", "user", "assistant"]
    rows = [(c, t if rng.random() > 0.1 else None, roles[rng.integers(len(roles))], texts[rng.integers(len(texts))])
            for c in [*range(1, 120), None] for t in range(rng.integers(0, 6))]
    # words in order that one or no damage has hit, and repeated rows
    rows += [(200 + k, t, r, f"{t}.") for k in range(40) for t, r in enumerate(["system", "user", "assistant", "user", "assistant"])]
    rows += [(300, 1, "user", "Hi.")] * 4 + [(None, None, None, None)] * 3 + [(301, 0, "user", "Q?"), (301, 5, "assistant", "A.")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS place", "'x' AS code", "2 AS copies")
    df.repartition(5).write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r["conv_id"]: tuple(r[n] for n in NAMES) for r in repair.op11_lightest_derivation(spark, str(tmp_path)).collect()}
    want = wanted(rows, {r[0] for r in rows})
    assert got == want


def run(codes, block):
    agenda = repair.Agenda(block)
    for code, copies in codes:
        agenda.add(code, copies)
    return agenda.goal()


def test_blocks_of_any_size_give_the_same_repair():
    rng = np.random.default_rng(5)
    for n in [0, 1, 2, 5, 9, 30, 30, 30, 60, 200]:
        for _ in range(12):
            weights = rng.dirichlet(np.ones(16) * 0.4)
            codes = [(int(c), 1 + int(rng.random() < 0.1) * 3) for c in rng.choice(16, n, p=weights)]
            whole = run(codes, 10**9)
            assert len(whole[1]) - whole[1].count("I") == sum(c for _, c in codes)
            assert [run(codes, b) for b in (1, 2, 3, 7, 64)] == [whole] * 5


def test_a_long_conversation_streams():
    rng = np.random.default_rng(6)
    codes = [(int(c), 1) for c in rng.choice([4, 8, 4, 8, 0, 12, 7], 60_000)]
    cost, audit = run(codes, repair.BLOCK)
    assert len(audit) - audit.count("I") == 60_000 and cost > 0


def test_short_audits_compare_like_the_audits():
    rng = np.random.default_rng(8)
    for _ in range(300):
        audits = ["".join(rng.choice(list("DIK"), rng.integers(0, 6))) for _ in range(4)]
        audits.append(audits[0] + "I")
        names = repair.shortened(audits)
        for x, y in itertools.product(audits, repeat=2):
            for p, q in itertools.product(["", "D", "I", "K", "II", "ID"], repeat=2):
                if x + p != y + q:
                    assert (x + p < y + q) == (names[x] + p < names[y] + q)


def test_rows_come_back_and_empty_tables_give_none(spark):
    rows = [(1, 0, "user", "Hi.", 1), (1, 1, "user", "Hi.", 1), (1, 2, "bot", "Yes.", 1), (2, 0, "assistant", "A.", 1), (2, 1, "user", "B.", 1), (2, 2, "assistant", "C.", 1)]
    made = repair.Repair(spark.createDataFrame(rows, SHAPE))
    got = [tuple(r) for r in made.repaired().orderBy("conv_id", "position").collect()]
    assert got == [(1, 0, "user", "Hi.", "K"), (1, 1, "assistant", "Yes.", "R"), (2, 0, "user", "B.", "K"), (2, 1, "assistant", "C.", "K")]
    assert [(r.cost, r.audit) for r in made.faults().orderBy("conv_id").collect()] == [(3, "KDR"), (2, "DKK")]
    none = repair.Repair(spark.createDataFrame([], SHAPE))
    assert none.digests().count() == none.repaired().count() == none.faults().count() == 0


@pytest.mark.parametrize("roles, want", [("uaua", (0, "KKKK")), ("s", (2, "D")), ("", (0, "")), ("uu", (1, "KR")), ("a", (2, "D")), ("suuaa", (2, "KKRRK"))])
def test_worked_examples(roles, want):
    codes = [({"s": 0, "u": 1, "a": 2}[r] * 4, 1) for r in roles]
    assert run(codes, 4) == want
