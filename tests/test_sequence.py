"""The segmented scan against plain loops, however the partitions cut the keys."""
import random

import pytest

from sessionary.operators.sequence import Scan, carry_states, segmented_scan

SCAN = Scan(
    lags={"lag1": ("v", 1), "lag3": ("v", 3)}, leads={"lead1": ("v", 1), "lead2": ("s", 2)},
    class_lags={"same": ("v", "kind")}, breaks={"gap": ("t", 5), "step": ("bucket", 0)},
    numbers={"n_gap": "gap"},
    sums={"all": ("x", None), "in_gap": ("x", "gap"), "in_step": ("x", "step")},
    ends={"gap_end": "gap", "step_end": "step"})
NAMES = [*SCAN.lags, *SCAN.leads, *SCAN.class_lags, *SCAN.numbers, *SCAN.sums, *SCAN.ends]
SCHEMA = "k long, t long, id long, v int, s string, kind string, bucket long, x long"


def made(seed, n, keys):
    """Rows of a few keys, the first of which owns a third of them."""
    rng, rows = random.Random(seed), []
    for i in range(n):
        key = 0 if rng.random() < 0.34 else rng.randrange(keys)
        t = rng.randrange(n)
        rows.append((key, t, i, rng.choice([None, *range(9)]), rng.choice("abc"),
                     rng.choice(["p", "q", "r", None]), t // 7, rng.choice([None, 0, 1, 5])))
    return rows


def plain(rows):
    out = {}
    for key in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == key), key=lambda r: r[1:3])
        brk = {"gap": [k > 0 and own[k][1] - own[k - 1][1] > 5 for k in range(len(own))],
               "step": [k > 0 and own[k][6] > own[k - 1][6] for k in range(len(own))]}
        for k, r in enumerate(own):
            start = {b: max([0, *(j for j in range(k + 1) if f[j])]) for b, f in brk.items()}
            before = [o for o in own[:k] if o[5] is not None and o[5] == r[5]]
            total = lambda a: sum(o[7] or 0 for o in own[a:k + 1])
            ends = lambda b: k + 1 == len(own) or brk[b][k + 1]
            out[r[2]] = (
                own[k - 1][3] if k else None, own[k - 3][3] if k > 2 else None,
                own[k + 1][3] if k + 1 < len(own) else None, own[k + 2][4] if k + 2 < len(own) else None,
                before[-1][3] if before else None, sum(brk["gap"][:k + 1]), total(0),
                total(start["gap"]), total(start["step"]), ends("gap"), ends("step"))
    return out


@pytest.mark.parametrize("parts", [1, 3, 40])
@pytest.mark.parametrize("keys", [1, 6])
def test_scan_equals_loops(spark, parts, keys):
    rows = made(parts * 10 + keys, 160, keys)
    df = segmented_scan(spark.createDataFrame(rows, SCHEMA), ["k"], ["t", "id"], SCAN, parts)
    got = {r["id"]: tuple(r[n] for n in NAMES) for r in df.collect()}
    want = plain(rows)
    # rows without a class follow no row of their class
    none = {r[2] for r in rows if r[5] is None}
    same = NAMES.index("same")
    for k in none:
        got[k] = got[k][:same] + (None,) + got[k][same + 1:]
    assert got == want


def test_empty_and_two_keys(spark):
    assert segmented_scan(spark.createDataFrame([], SCHEMA), ["k"], ["t", "id"], SCAN).count() == 0
    rows = [(k % 3, k, k, k, "a", "p", 0, 1) for k in range(30)]
    df = segmented_scan(spark.createDataFrame(rows, SCHEMA), ["s", "k"], ["t", "id"], SCAN, 9)
    got = {r["id"]: tuple(r[n] for n in NAMES) for r in df.collect()}
    assert got == plain(rows)


def test_a_sum_alone_over_partitions(spark):
    rows = [(k % 2, k, k, k, "a", "p", 0, 1) for k in range(50)]
    df = segmented_scan(spark.createDataFrame(rows, SCHEMA), ["k"], ["t"], Scan(sums={"sum": ("x", None)}), 13)
    assert {r["id"]: r["sum"] for r in df.collect()} == {k: k // 2 + 1 for k in range(50)}


def test_carry_over_several_partitions_of_one_key():
    """A key over many one-row partitions: sums go on until a break restarts them."""
    scan = Scan(lags={"a": ("t", 2)}, breaks={"gap": ("t", 5)}, numbers={"n": "gap"},
                sums={"s": ("x", "gap")})
    times = [0, 3, 20, 21]
    records = [(p, {"keys": ((7,), (7,)), "whole": True, "begin": [(t,)], "end": [(t,)],
                    "numbers": {"gap": 0}, "sums": {"s": 1}, "classes": {}})
               for p, t in enumerate(times)]
    states = carry_states(records, scan)
    assert [s["state"] and s["state"]["sums"]["s"] for s in states] == [None, 1, 2, 1]
    assert [s["state"] and s["state"]["numbers"]["gap"] for s in states] == [None, 0, 0, 1]
    assert states[3]["state"]["end"] == [(20,), (3,)]
    assert [s["broken"]["gap"] for s in states] == [False, False, True, False]
    assert [s["broken_after"]["gap"] for s in states] == [False, True, False, True]
