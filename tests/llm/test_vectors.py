"""Hard negatives against brute force; whitening against exact fractions."""

import math
import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from rankloom.llm import hard_negatives as hn
from rankloom.llm import vectors, whitening
from rankloom.scratch import Scratch

SCHEMA = "vec_id long, embedding array<float>, label int"


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema).repartition(5)


def near_rows(n=420, dims=12, seed=5):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(3)]
    rows = [(i, [c + rng.gauss(0, 0.5) for c in centres[i % 3]], rng.choice([0, 0, 0, 1, 2])) for i in range(n)]
    hot = rows[20][1]
    rows += [(1000 + i, hot, i % 2) for i in range(150)]  # a third of all rows are one vector
    rows += [rows[20], rows[20], (20, hot, 1)]  # repeated rows, one id with two labels
    rows += [(None, hot, 0), (None, hot, 1), (2000, None, 1), (2010, [1.0, None], 1), (2020, [math.nan] * dims, 0), (2030, [math.inf] + [0.0] * (dims - 1), 0), (2040, hot, None), (2050, [], 0), (2060, [0.0] * dims, 1), (2070, hot[:4], 1)]
    return rows


def plain_negatives(rows, divisor, k=5, k2=5, least=80):
    vs = []
    dims = max((len(v) for _, v, _ in rows if v is not None), default=0)
    for i, v, label in rows:
        if v is not None and label is not None and all(c is not None and math.isfinite(c) for c in v):
            x = [math.floor(256 * float(np.float32(c))) for c in v]
            vs.append((i, x + [0] * (dims - len(x)), label))
    by = lambda s: (-s[0], s[1] is None, s[1] or 0)
    out = []
    for n, (i, x, label) in enumerate(vs):
        if i is None or i % divisor:
            continue
        scored = [(sum(a * b for a, b in zip(x, y)), j, other) for m, (j, y, other) in enumerate(vs) if m != n]
        for ps, p, _ in sorted((s for s in scored if s[2] == label), key=by)[:k]:
            inside = sorted((s for s in scored if s[2] != label and 100 * s[0] >= least * ps and s[0] <= ps), key=by)[:k2]
            out += [(i, p, r, j, ps, s) for r, (s, j, _) in enumerate(inside, 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("few, bits, anchors", [(32, 10, 512), (0, 3, 7)], ids=["usual", "every-digit"])
def test_hard_negatives_against_brute_force(spark, few, bits, anchors):
    rows = near_rows()
    df = frame(spark, rows)
    for c in ("ab", "a", "w", "lo", "s", "n", "block", "score", "rank", "matrix"):
        df = df.withColumn(c, F.lit(1))
    got = sorted((tuple(r) for r in hn.hard_negatives(df, 10, block_anchors=anchors, bits=bits, few=few).collect()), key=str)
    assert got == plain_negatives(rows, 10)


def test_hard_negatives_windows_and_empty(spark):
    assert hn.hard_negatives(frame(spark, []), 10).count() == 0
    assert hn.hard_negatives(frame(spark, [(1, [1.0], 0)]), 10).count() == 0
    assert hn.hard_negatives(frame(spark, [(10, None, 0), (20, [1.0], None)]), 10).count() == 0
    # The positive looks away: no score can lie in its window.
    assert hn.hard_negatives(frame(spark, [(10, [1.0], 0), (11, [-1.0], 0), (12, [1.0], 1)]), 10).count() == 0
    # Both ends of a window belong to it.
    edge = [(10, [1.0], 0), (11, [1.0], 0), (12, [1.0], 1), (13, [0.80078125], 1), (14, [0.796875], 1), (15, [1.00390625], 1)]
    got = [(r["negative_id"], r["rank"]) for r in hn.hard_negatives(frame(spark, edge), 10).orderBy("rank").collect()]
    assert got == [(12, 1), (13, 2)] == [(r[3], r[2]) for r in plain_negatives(edge, 10)]


def test_scores_beyond_doubles_are_exact_or_an_error(spark):
    big = float(2**21)
    rows = [(10, [big, 1.0], 0), (11, [big, 2.0], 0), (12, [big, 1.00390625], 1), (13, [big, 1.0], 1)]
    assert sorted((tuple(r) for r in hn.hard_negatives(frame(spark, rows), 10).collect()), key=str) == plain_negatives(rows, 10)
    with pytest.raises(Exception, match="too large"):
        hn.hard_negatives(frame(spark, [(10, [1e15], 0), (11, [1e15], 0)]), 10).collect()


def exact_whitening(rows, offset=10**6):
    dims = max(len(v) for _, v in rows if v is not None)
    vs = [(i, [float(np.float32(c)) for c in v] + [0.0] * (dims - len(v))) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x = [[math.floor(64 * c) + offset for c in v] for _, v in vs]
    n = len(x)
    sums = [sum(r[j] for r in x) for j in range(dims)]
    cov = np.array([[float(sum(Fraction(r[i] * n - sums[i], n) * Fraction(r[j] * n - sums[j], n) for r in x) / n) for j in range(dims)] for i in range(dims)])
    dev = {}
    for (i, _), r in zip(vs, x):
        dev.setdefault(i, []).append(sum((n * r[j] - sums[j]) ** 2 for j in range(dims)))
    return vs, np.array(x), sums, cov, dev


def vector_rows():
    rng = random.Random(9)
    rows = [(i, [rng.gauss(0, 1 + j) for j in range(6)]) for i in range(300)]
    rows += [rows[0], rows[0], (None, rows[5][1]), (900, None), (901, [1.0, None]), (902, [math.nan] * 6), (903, [math.inf] * 6), (904, []), (905, [3.0, 2.0])]
    return rows


def test_whitening_against_fractions(spark):
    rows = vector_rows()
    df = frame(spark, rows, "vec_id long, embedding array<float>")
    for c in ("n", "block", "part", "component", "label", "matrix"):
        df = df.withColumn(c, F.lit("x"))
    got = whitening.whiten(df, components=4).collect()
    vs, x, sums, cov, dev = exact_whitening(rows)
    n = len(x)
    assert len(got) == 4 * n and {r["n"] for r in got} == {n}
    for i, want in dev.items():
        mine = [r for r in got if r["vec_id"] == i and r["component"] == 1]
        assert sorted(r["deviation"] for r in mine) == sorted(want) == sorted(int(r["deviation_exact"]) for r in mine)
    values, axes = np.linalg.eigh(cov)
    order = np.argsort(-values)[:4]
    z = ((x * n - np.array(sums)) / n) @ axes[:, order] / np.sqrt(values[order])
    for k in range(4):
        own = {}
        for r in got:
            if r["component"] == k + 1:
                own.setdefault(r["vec_id"], []).append(r["whitened"])
        want = {}
        for (i, _), value in zip(vs, z[:, k]):
            want.setdefault(i, []).append(value)
        sign = 1 if np.sign(own[7][0]) == np.sign(want[7][0]) else -1
        assert all(np.allclose(sorted(own[i]), sorted(sign * v for v in want[i]), atol=1e-9) for i in want)
        assert abs(next(r["explained"] for r in got if r["component"] == k + 1) - values[order[k]] / np.trace(cov)) < 1e-12
    assert len({r["identity_error"] for r in got}) == 1 and got[0]["identity_error"] < 1e-9


def test_whitening_same_bits_however_dealt(spark):
    rows = vector_rows()
    runs = [sorted((str(r[0]), r[1], r[4], r[5]) for r in whitening.whiten(frame(spark, rows, "vec_id long, embedding array<float>").repartition(p)).collect()) for p in (1, 9)]
    assert runs[0] == runs[1]


def test_whitening_ranks_and_empty(spark):
    schema = "vec_id long, embedding array<float>"
    assert whitening.whiten(frame(spark, [], schema)).count() == 0
    assert whitening.whiten(frame(spark, [(1, None)], schema)).count() == 0
    assert whitening.whiten(frame(spark, [(1, [1.0, 2.0])] * 3, schema)).count() == 0
    line = [(i, [float(i), 2.0 * i, 5.0]) for i in range(10)]
    got = whitening.whiten(frame(spark, line, schema)).collect()
    assert len(got) == 10 and {r["component"] for r in got} == {1} and abs(got[0]["explained"] - 1) < 1e-12


def test_exact_sums_of_large_entries(spark):
    rng = np.random.default_rng(3)
    d = rng.integers(-(2**50), 2**50, (40, 3))
    assert (vectors.exact_gram(d) == d.astype(object).T @ d.astype(object)).all()
    big = np.array([2**62 - 1, 5], np.int64)
    assert list(vectors.exact_add(big, big)) == [2**63 - 2, 10]
    rows = [(i, [float(np.float32(2.0 ** (30 + i % 5))), float(i)]) for i in range(30)]
    got = whitening.whiten(frame(spark, rows, "vec_id long, embedding array<float>")).collect()
    *_, dev = exact_whitening(rows)
    for r in got:
        want = dev[r["vec_id"]][0]
        assert int(r["deviation_exact"]) == want and r["deviation"] == (want if want < 2**63 else None)


def test_blocks_bear_wide_vectors(spark):
    wide = frame(spark, [(i, [float(i)] * 700_000) for i in range(3)], "vec_id long, embedding array<float>")
    packed, dims = vectors.blocks(Scratch(spark, "test-blocks"), wide, 1, needs_label=False)
    assert dims == 700_000 and sorted(r["n"] for r in packed.select("n").collect()) == [1, 1, 1]
