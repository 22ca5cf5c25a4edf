import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest

from ridemart.llm import conversation_repair as C

SF = "/root/testdata/sf0.01"
SPACES = " \t\n\x0b\x0c\r"


def brute_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        p = [" " if x is None else str(x) for x in (conv, turn, role, text)]
        fate = zlib.crc32(f"{p[0]}:{p[1]}".encode()) % 20
        role, text = p[2], p[3]
        if fate == 0:
            continue
        if fate == 1:
            text = ""
        if fate == 2:
            text = re.sub("[.!?]", "", text)
        if fate == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (2 if fate == 3 else 1)
    return out


def brute_faults(rows):
    out = []
    for k, (role, text) in enumerate(rows):
        solid = [c for c in text if c not in SPACES]
        out.append("blank" if not solid else "duplicate" if (role, text) in rows[:k] else "truncated" if solid[-1] not in ".!?" else "")
    return out


GRAMMAR = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def brute_best(rows):
    """(cost, edits, messages): all edit strings compared, by plain recursion over rows and grammar."""
    found = brute_faults(rows)

    @lru_cache(None)
    def best(i, last, run):
        options = []
        if i == len(rows) and last in ("", "a"):
            options.append((0, "", ()))
        if run < 3:
            for role in ("user", "assistant"):
                if (last, role[0]) in GRAMMAR:
                    c, e, m = best(i, role[0], run + 1)
                    options.append((c + 3, "I" + e, ((role, ""),) + m))
        if i < len(rows):
            role, text = rows[i]
            c, e, m = best(i + 1, last, 0)
            options.append((c + 4, "D" + e, m))
            if found[i] in ("", "truncated"):
                extra = 3 if found[i] else 0
                if (last, role[:1]) in GRAMMAR:
                    c, e, m = best(i + 1, role[:1], 0)
                    options.append((c + extra, "K" + e, ((role, text),) + m))
                for to in ("user", "assistant"):
                    if (last, to[0]) in GRAMMAR:
                        c, e, m = best(i + 1, to[0], 0)
                        options.append((c + 3 + extra, "R" + e, ((to, text),) + m))
        return min(options, key=lambda o: o[:2], default=(10 ** 9, "", ()))
    return best(0, "", 0)


def brute(original):
    convs = {}
    for r in brute_damage(original):
        convs.setdefault(r[0], []).append(r)
    out = []
    for conv in {r[0] for r in original}:
        rows = sorted(convs.get(conv, []), key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        msgs = [(r[2], r[3]) for r in rows]
        turns = {r[1] for r in rows if r[1] is not None}
        f = brute_faults(msgs)
        cost, audit, fixed = brute_best(msgs)
        out.append((conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, f.count("blank"), f.count("duplicate"), f.count("truncated"),
                    sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(msgs, msgs[1:])), cost, audit,
                    hashlib.sha256("\n".join(f"{r}:{t}" for r, t in fixed).encode()).hexdigest()))
    return sorted(out, key=str)


def run(spark, rows):
    df = spark.createDataFrame([(*r, 1, "x", True) for r in rows], "conv_id long, turn long, role string, text string, fate int, copy string, alive boolean").repartition(3)
    return sorted((tuple(r) for r in C.repair_report(C.repair(C.damage(df))).collect()), key=str)


def test_edges(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "assistant", "Yes."), (2, None, None, None), (2, None, "user", "a"), (2, 5, "user", "a"), (2, 9, "tool", "b."),
            (None, 1, "user", "q?"), (None, 2, "assistant", "a."), (None, 1, "user", "q?"), (3, 0, "", ""), (4, 0, "system", "s."), (4, 0, "system", "s."),
            (5, 3, "assistant", "only."), (6, 0, "user", " \t.\n"), (7, 0, "user", "é. "), (8, 0, "assistant", "x" * 300_000 + "!"), (8, 1, "user", "y" * 300_000)]
    rows += [(9 + k, t, "user", "one.") for k in range(40) for t in range(k % 4)]
    assert run(spark, rows) == brute(rows)
    dropped = next(i for i in range(10_000, 20_000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    assert run(spark, [(dropped, 0, "user", "gone")]) == [(dropped, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    assert run(spark, []) == []


@pytest.mark.parametrize("seed,block", [(0, 16), (1, 1), (2, 2), (3, 5), (4, 64)])
def test_auction_equals_recursion(seed, block):
    rng = random.Random(seed)
    cfg = C.RepairConfig(block=block)
    for _ in range(150):
        n = rng.choice([0, 1, 2, 3, 5, 9, 30])
        rows = [(rng.choice(["user", "assistant", "system", "user", "assistant", "tool", ""]), rng.choice(["a.", "b", "", "c!", "d?", "e", "f.", "g.", "h."])) for _ in range(n)]
        found = C.faults(rows)
        assert found == brute_faults(rows)
        cost, audit = C.cheapest([r[:1] for r, _ in rows], found, cfg)
        assert (cost, audit, tuple(C.apply_edits(rows, audit))) == brute_best(rows)


def test_prices_are_an_optimal_dual():
    rows = [("user", "a."), ("user", "b."), ("assistant", "c"), ("system", "d."), ("assistant", "")]
    cfg = C.RepairConfig()
    arcs = [C.row_arcs(r[:1], f, cfg) for r, f in zip([r for r, _ in rows], C.faults(rows))]
    block = C.Block(arcs, [0, None, None, 0], cfg)
    cost = block.auction(0)
    assert all(block.price[i] <= c + block.price[j] for i, out in enumerate(block.arcs) for _, c, j in out)
    assert cost == block.price[0] - block.price[block.end] > 0


def test_long_conversation_is_linear():
    import time

    rng = random.Random(5)
    rows = [(rng.choice(["user", "assistant", "system"]), f"{k}" + rng.choice([".", "", "!"])) for k in range(20_000)]
    rows[7_000:9_000] = [("system", "same.")] * 2_000
    t = time.perf_counter()
    cost, audit = C.cheapest([r[:1] for r, _ in rows], C.faults(rows))
    assert time.perf_counter() - t < 60 and cost > 0
    assert len(audit) - audit.count("I") == 20_000


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert run(spark, rows) == brute(rows)
