import math
import random
from fractions import Fraction

import numpy as np
import pytest

from ledger.llm import queries, whitening

SCHEMA = "vec_id long, embedding array<float>, label int, x string, id string, n string"


def polynomial(m):
    """Coefficients of det(x - m), lowest first, by traces of powers in fractions."""
    d, c, b = len(m), [Fraction(1)], [[Fraction(int(i == j)) for j in range(len(m))] for i in range(len(m))]
    for k in range(1, d + 1):
        b = [[sum(m[i][t] * b[t][j] for t in range(d)) for j in range(d)] for i in range(d)]
        c.append(-sum(b[i][i] for i in range(d)) / k)
        for i in range(d):
            b[i][i] += c[-1]
    return [int(v) for v in reversed(c)]


def gram(rng, d, rank, most):
    a = [[rng.randint(-most, most) for _ in range(d)] for _ in range(rank)]
    return [[sum(r[i] * r[j] for r in a) for j in range(d)] for i in range(d)]


def test_polynomial_is_exact(spark):
    rng = random.Random(1)
    cases = [gram(rng, d, r, 10 ** rng.randint(1, 9)) for d, r in ((1, 1), (2, 1), (3, 3), (5, 2), (8, 9), (11, 11))]
    cases += [[[7 * (i == j) for j in range(4)] for i in range(4)], [[0, 0], [0, 0]]]
    for m in cases:
        assert whitening.characteristic_polynomial(spark, m) == polynomial(m)


def test_roots_are_counted_with_multiplicity():
    roots = [0, 0, 3, 3, 3, 10, 1000]
    poly = [1]
    for r in roots:
        poly = [a - r * b for a, b in zip([0, *poly], [*poly, 0])]
    for t in (0, 2, 3, 5, 10, 999, 1000):
        assert whitening.changes_right_of(poly, t, 0) == sum(r > t for r in roots)
        assert whitening.changes_right_of(poly, (t << 5) - 1, 5) == sum(r > t - 1 / 32 for r in roots)
    for k, r in enumerate(sorted(roots, reverse=True), 1):
        low, high = whitening.root_interval(poly, k, 2000, 40)
        assert (low, high) == (0, 0) if not r else low < r << 40 <= high == low + 1


def test_gram_of_any_size_is_exact():
    rng = np.random.default_rng(2)
    for most in (1, 300, 1 << 20, 1 << 47):
        z = rng.integers(-most, most, (700, 5), endpoint=True)
        want = [[sum(int(a) * int(b) for a, b in zip(z[:, i], z[:, j])) for j in range(5)] for i in range(5)]
        assert whitening.exact_gram(z).tolist() == want
    assert not whitening.exact_gram(np.zeros((3, 2), np.int64)).any()


def run(spark, tmp_path, rows):
    where = f"{tmp_path}/{random.random()}"
    spark.createDataFrame(rows, SCHEMA).repartition(4).write.parquet(f"{where}/embeddings.parquet")
    return queries.op12_embedding_whitening(spark, where).collect()


def fits(rows):
    return [(i, v) for i, v, *_ in rows if v and all(c is not None and math.isfinite(c) for c in v)]


def check(got, rows, d):
    kept = [(i, v) for i, v in fits(rows) if len(v) == d]
    x = [[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for _, v in kept]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    far = sorted((i if i is not None else -1, sum((n * a - s) ** 2 for a, s in zip(v, sums))) for (i, _), v in zip(kept, x))
    z = np.array(x, float) - np.array([s / n for s in sums])
    v = z.T @ z / n
    e, axes = np.linalg.eigh(v)
    e, axes = e[::-1], axes[:, ::-1]
    some = int((e > 1e-9 * max(e.max(), 1)).sum())
    some = min(some, whitening.COMPONENTS)
    by_row = {}
    for r in got:
        by_row.setdefault((r.vec_id, r.deviation), []).append(r)
        assert r.n == n and abs(r.explained - e[r.component - 1] / np.trace(v)) <= 1e-9 and r.identity_error < 1e-6
    assert sorted({r.component for r in got}) == list(range(1, some + 1)) and len(got) == n * some
    assert sorted((k[0] if k[0] is not None else -1, k[1]) for k, rs in by_row.items() for _ in range(len(rs) // some)) == far
    return z, e, axes, some


def test_equals_floating_point_whitening(spark, tmp_path):
    rng = np.random.default_rng(3)
    rows = [(i, (rng.normal(size=9) * np.linspace(0.3, 3, 9)).tolist(), 1, "a", "b", "c") for i in range(300)]
    rows += [(300, None, 1, "a", "b", "c"), (301, [1.0, None] + [0.0] * 7, 1, "a", "b", "c"), (302, [float("nan")] * 9, 1, "a", "b", "c"),
             (303, [float("inf")] + [0.0] * 8, 1, "a", "b", "c"), (304, [], 1, "a", "b", "c"), (305, [1.0, 2.0], 1, "a", "b", "c")]
    rows += [(None, [0.5] * 9, None, None, None, None), rows[0], rows[0]]
    got = run(spark, tmp_path, rows)
    z, e, axes, _ = check(got, rows, 9)
    own = np.array([[r.whitened for r in sorted((r for r in got if r.vec_id == i), key=lambda r: r.component)] for i in range(1, 300)])
    want = z[1:300] @ axes / np.sqrt(e)
    assert np.abs(np.abs(own) - np.abs(want)).max() < 1e-8


def test_few_dimensions_vary_and_equal_eigenvalues(spark, tmp_path):
    """Two dimensions of the same spread, a copy of one of them and a constant."""
    points = [(a, b) for a in (-1.0, 1.0) for b in (-1.0, 1.0)] * 5
    rows = [(i, [a, b, 3.0, 0.0], 0, "a", "b", "c") for i, (a, b) in enumerate(points)]
    assert {round(r.explained, 12) for r in run(spark, tmp_path, rows)} == {0.5}
    rows = [(i, [a, b, a, 3.0], 0, "a", "b", "c") for i, (a, b) in enumerate(points)]
    check(run(spark, tmp_path, rows), rows, 4)


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0], 0, "a", "b", "c")], [(i, [1.0, 2.0], 0, "a", "b", "c") for i in range(5)], [(1, None, 0, "a", "b", "c"), (2, [], 0, "a", "b", "c")]])
def test_nothing_varies(spark, tmp_path, rows):
    assert run(spark, tmp_path, rows) == []


def test_given_table(spark):
    got = queries.op12_embedding_whitening(spark, "/root/testdata/sf0.001")
    assert got.count() == 500 * 32 and got.select("identity_error").first()[0] < 1e-9
