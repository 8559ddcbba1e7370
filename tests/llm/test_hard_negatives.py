"""Hard negatives: intervals hold, and the result is that of brute force."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pytest

from rookery.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, scale=256, every=100, k=5, low=80, high=100):
    usable = {}
    for i, v, label in rows:
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            usable[(i, label, tuple(v))] = [math.floor(scale * float(np.float32(x))) for x in v]
    out = []
    clip = lambda s: min(max(s, -(1 << 63)), (1 << 63) - 1)
    for (anchor, label, _), a in usable.items():
        if anchor % every:
            continue
        scored = [(-clip(sum(x * y for x, y in zip(a, b))), i, other) for (i, other, _), b in usable.items() if i != anchor]
        for p, positive, _ in sorted(s for s in scored if s[2] == label)[:k]:
            found = sorted(s for s in scored if s[2] != label and low * -p <= 100 * -s[0] <= high * -p)[:k]
            out += [(anchor, positive, n + 1, i, -p, -s) for n, (s, i, _) in enumerate(found)]
    return sorted(out)


def vectors(seed, n, width=24):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 1, (3, width))
    return [(i, [float(x) for x in centres[i % 3] + rng.normal(0, 1, width)], int(rng.integers(0, 4)) % 3) for i in range(n)]


AWKWARD = [
    (5001, None, 1), (5002, [1.0, None], 1), (5003, [float("nan")] * 24, 0), (5004, [float("inf")] * 24, 0),
    (None, [1.0] * 24, 1), (5005, [1.0] * 24, None), (5006, [], 1), (5007, [2.0], 2), (5100, [], 0), (5200, [0.0] * 24, 1),
]


@pytest.mark.parametrize("sizes", [{}, {"slice_rows": 2048, "anchor_rows": 2, "levels": 1}])
def test_hard_negatives(spark, sizes):
    rows = vectors(1, 420)
    # Ties, copies of an anchor under its own and other ids, and one vector for a third of the rows.
    rows += [(1000 + i, rows[0][1], i % 2) for i in range(40)] + [(2000 + i, rows[7][1], 1) for i in range(200)]
    rows += [rows[0], rows[0], rows[5], (0, rows[3][1], 2), (100, rows[100][1], (rows[100][2] + 1) % 3), *AWKWARD]
    got = hn.hard_negatives(spark.createDataFrame(rows, SCHEMA).repartition(4), **sizes)
    assert sorted(map(tuple, got.collect())) == brute(rows)
    assert len(brute(rows)) > 60


def test_other_settings_and_clashing_names(spark):
    rows = vectors(2, 200, 70)
    names = "key long, vec array<float>, kind int, vec_id string, label string, v string, own string, slice int, block int"
    df = spark.createDataFrame([(*r, "a", "b", "c", "d", 1, 2) for r in rows], names)
    got = hn.hard_negatives(
        df, every=40, positive_rows=3, negative_rows=4, low=50, high=90, scale=64, id_col="key", vector_col="vec", label_col="kind"
    )
    assert len(got.collect()) > 0
    want = brute_with(rows, scale=64, every=40, low=50, high=90)
    assert sorted(map(tuple, got.collect())) == want


def brute_with(rows, scale, every, low, high):
    whole = {i: ([math.floor(scale * float(np.float32(x))) for x in v], label) for i, v, label in rows}
    out = []
    for anchor, (a, label) in whole.items():
        if anchor % every:
            continue
        scored = [(-sum(x * y for x, y in zip(a, b)), i, other) for i, (b, other) in whole.items() if i != anchor]
        for p, positive, _ in sorted(s for s in scored if s[2] == label)[:3]:
            found = sorted(s for s in scored if s[2] != label and low * -p <= 100 * -s[0] <= high * -p)[:4]
            out += [(anchor, positive, n + 1, i, -p, -s) for n, (s, i, _) in enumerate(found)]
    return sorted(out)


def test_huge_numbers(spark):
    rows = [(i, [x * (1.0 + i / 64) for x in v], label) for i, v, label in vectors(3, 60)]
    rows = [(i, [x * 2.0**50 for x in v], label) for i, v, label in rows] + [(300, [3.0e38] * 24, 1)]
    got = hn.hard_negatives(spark.createDataFrame(rows, SCHEMA), every=20)
    want = brute(rows, every=20)
    # A score beyond a long counts as the nearest one.
    assert sorted(map(tuple, got.collect())) == want and want


def test_no_rows(spark):
    assert hn.hard_negatives(spark.createDataFrame([], SCHEMA)).count() == 0
    assert hn.hard_negatives(spark.createDataFrame(AWKWARD[:6], SCHEMA)).count() == 0


def candidates(x, levels=hn.LEVELS):
    codes, aligned, rest = hn.codes_of(x, hn.code_bits(x.shape[1]), levels)
    n = len(x)
    table = pa.table({
        "vec_id": np.arange(n), "label": np.zeros(n, np.int64), "v": pa.array(list(x)),
        "codes": [c.tobytes() for c in codes], "aligned": pa.array(list(aligned)), "rest": rest,
    })
    return hn.Candidates.of(table, x.shape[1], levels)


@pytest.mark.parametrize("width", [3, 64, 130])
def test_intervals_hold_the_scores_and_shrink(width):
    rng = np.random.default_rng(width)
    x = np.floor(rng.normal(0, 40, (500, width)))
    x[7], x[8], x[9] = 0, x[10], -x[10]
    c = candidates(x)
    for q in (x[0], x[10], np.zeros(width), rng.normal(0, 1, width)):
        widths = []
        levels = c.narrowed(hn.Query(q, c.bits, hn.PLANES), np.arange(500))
        low, high = next(levels)
        while True:
            true = c.x @ q
            assert (low <= true).all() and (true <= high).all()
            widths.append((high - low).mean())
            try:
                low, high = levels.send(np.ones(500, bool))
            except StopIteration:
                break
        assert len(widths) == hn.LEVELS and widths == sorted(widths, reverse=True)


def test_rotation_keeps_inner_products():
    x = np.random.default_rng(4).normal(0, 1, (30, 50))
    y = hn.rotated(x, 64)
    assert np.allclose(x @ x.T, y @ y.T)


def test_most_rows_are_left_out_before_they_are_scored():
    """Vectors without any structure, the hardest case: of 20,000 rows four fifths go by their codes."""
    x = np.random.default_rng(5).normal(0, 32, (20_000, 64)).round()
    c = candidates(x)
    c.labels = np.arange(20_000) % 10
    c.labels.sort()
    left = []
    for a in range(0, 20_000, 2500):
        ids, scores = hn.positives(c, a, c.labels[a], c.x[a], 5)
        left.append(len(hn.contenders(c, a, c.labels[a], c.x[a], hn._windows(scores, 80, 100), 5)))
    assert np.mean(left) < 0.25 * 20_000
