"""Whitening, near-dedup and hard negatives of embeddings against brute force."""

import math
import random
from fractions import Fraction

import numpy as np
import pytest

from sluice.llm import hard_negatives as hard
from sluice.llm import polynomial
from sluice.llm import vector_dedup as dedup
from sluice.llm import whitening

ODD = [None, [], [0.1, None, 0.2, 0.3], [float("nan"), 0.0, 0.0, 0.0], [float("inf"), 0.0, 0.0, 0.0], [0.0] * 4]
SCHEMA = "vec_id long, embedding array<double>, label int, n string, x string, node long"


def frame(spark, rows):
    """Rows (id, vector, label) with clashing columns beside them."""
    return spark.createDataFrame([(*r, "n", "x", 7) for r in rows], SCHEMA)


def fine(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


# -- polynomials --------------------------------------------------------------------------


def test_polynomial_of_a_matrix_with_zero_columns_equals_exact_elimination(spark):
    rng = random.Random(4)
    m = [[0] * 6 for _ in range(6)]
    for i in range(6):
        for j in range(i, 6):
            m[i][j] = m[j][i] = rng.choice([0, 0, 3, -70_000_000_000])
        m[i][i] = 10**14
    poly = whitening.characteristic_polynomial(spark, m)

    def determinant(at):
        a = [[Fraction(at * (i == j) - m[i][j]) for j in range(6)] for i in range(6)]
        out = Fraction(1)
        for i in range(6):
            p = next((r for r in range(i, 6) if a[r][i]), None)
            if p is None:
                return Fraction(0)
            if p != i:
                a[i], a[p], out = a[p], a[i], -out
            out *= a[i][i]
            for r in range(i + 1, 6):
                f = a[r][i] / a[i][i]
                a[r] = [x - f * y for x, y in zip(a[r], a[i])]
        return out

    for at in (0, 1, -5, 10**14, 123456789):
        assert sum(c * at**k for k, c in enumerate(poly)) == determinant(at)


def test_roots_are_counted_and_refined_with_multiplicity():
    poly = [1]
    roots = [0, 2, 2, 2, 3, 7, 7, 10**9]
    for r in roots:
        poly = [a - r * b for a, b in zip([0, *poly], [*poly, 0])]
    assert [polynomial.roots_above(poly, at, 1) for at in (-1, 0, 3, 4, 5, 13, 14)] == [8, 7, 7, 4, 4, 3, 1]
    found = polynomial.largest_roots(poly, 2 * 10**9, 7, 64)
    assert [n for *_, n in found] == [1, 2, 1, 3]
    assert [abs(Fraction(a, 1 << s) - r) < Fraction(1, 1 << 30) for (a, s, _), r in zip(found, (10**9, 7, 3, 2))] == [True] * 4
    assert polynomial.is_prime(2**31 - 1) and not polynomial.is_prime(46337 * 46337)


# -- whitening ----------------------------------------------------------------------------


def check_whitening(rows, got, k):
    x = {i: [math.floor(256 * c) for c in v] for i, v, _ in rows if fine(v)}
    width = max(map(len, x.values()))
    x = {i: tuple(v + [0] * (width - len(v))) for i, v in x.items()}
    fit = np.array(sorted(set(x.values())), float)
    n, sums = len(fit), fit.sum(axis=0)
    values, vectors = np.linalg.eigh((fit - sums / n).T @ (fit - sums / n) / n)
    for r in got:
        y = n * np.array(x[r.vec_id], object) - sums.astype(np.int64).astype(object)
        assert (r.n, r.deviation) == (n, int((y * y).sum()))
        value, vector = values[-r.component], vectors[:, -r.component]
        assert abs(abs(r.whitened) - abs((np.array(x[r.vec_id]) - sums / n) @ vector) / math.sqrt(value)) < 1e-7
        assert math.isclose(r.explained, value / values.sum(), rel_tol=1e-9)
        assert r.identity_error < 1e-9
    assert len(got) == k * len(x)


def test_whitening_equals_brute_force(spark):
    rng = np.random.default_rng(5)
    rows = [(i, (rng.normal(size=4) * [1, 2, 0.3, 0.1]).tolist(), 0) for i in range(60)]
    rows += [(100 + i, rows[0][1], 0) for i in range(40)] + [(200 + i, v, None) for i, v in enumerate(ODD)]
    got = whitening.whitened(frame(spark, rows)).collect()
    check_whitening(rows, got, 4)
    # One sign per component: equal vectors get equal results.
    same = {(r.component, r.whitened) for r in got if r.vec_id == 0 or 100 <= r.vec_id < 200}
    assert len(same) == 4


def test_whitening_of_low_rank_wide_and_empty_tables(spark):
    # Two directions only.
    rows = [(i, [float(i), float(i * i), 0.0, 2.0 * i], 0) for i in range(9)]
    check_whitening(rows, whitening.whitened(frame(spark, rows)).collect(), 2)
    assert whitening.whitened(frame(spark, rows[:1])).collect() == []
    assert whitening.whitened(frame(spark, [])).collect() == []
    # Beyond doubles' exact range; a deviation that fits no long is NULL.
    got = whitening.whitened(frame(spark, [(0, [1e30], 0), (1, [-1e12], 0), (2, [1.0], 0)])).collect()
    assert [r.component for r in got] == [1, 1, 1] and {r.deviation for r in got} == {None}
    assert abs(sum(r.whitened for r in got)) < 1e-9 and abs(sum(r.whitened**2 for r in got) - 3) < 1e-9


def test_equal_eigenvalues_give_an_orthonormal_basis(spark):
    rows = [(2 * i + s, [(1.0 if s else -1.0) * (i == j) for j in range(5)], 0) for i in range(5) for s in (0, 1)]
    got = whitening.whitened(frame(spark, rows)).collect()
    assert len(got) == 40 and {round(r.explained, 12) for r in got} == {0.2}
    assert max(r.identity_error for r in got) < 1e-9


# -- near-dedup ---------------------------------------------------------------------------


def plain_links(rows):
    part = [(n, i, np.array(v), label) for n, (i, v, label) in enumerate(rows) if fine(v) and label is not None and any(v)]
    links, root = [0] * len(rows), list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for at, (n, _, a, label) in enumerate(part):
        for m, _, b, other in part[:at]:
            width = max(len(a), len(b))
            a2, b2 = (np.pad(v, (0, width - len(v))) for v in (a, b))
            if label == other and a2 @ b2 / math.sqrt((a2 @ a2) * (b2 @ b2)) >= 0.98:
                links[n] += 1
                links[m] += 1
                x, y = find(n), find(m)
                root[max(x, y)] = min(x, y)
    out = []
    for n, (i, *_) in enumerate(rows):
        ids = [j for m, (j, *_) in enumerate(rows) if find(m) == find(n) and j is not None]
        low = min(ids, default=None)
        out.append((i is None, i or 0, links[n], low is None, low or 0, i == low))
    return sorted(out)


def as_rows(df):
    return sorted((r.vec_id is None, r.vec_id or 0, r.n_links, r.component_id is None, r.component_id or 0, r.kept) for r in df.collect())


@pytest.mark.parametrize("block", [dedup.BLOCK, 16])
def test_dedup_equals_brute_force(spark, monkeypatch, block):
    """A hot group of near copies and of equal vectors, chains, other labels, odd rows."""
    monkeypatch.setattr(dedup, "BLOCK", block)
    rng = np.random.default_rng(6)
    rows, base = [], rng.normal(size=(12, 20))
    for i in range(150):
        v = base[i % 12 if i % 3 else 0] + rng.normal(size=20) * rng.choice([0.02, 0.1, 0.2])
        rows.append((i, v.tolist(), int(i % 4 == 0)))
    rows += [(200 + i, rows[3][1], 0) for i in range(30)] + [(300, rows[3][1], None), (5, rows[8][1], 0), (None, rows[3][1], 0), (None, rows[7][1], 9)]
    rows += [(400 + i, v, 0) for i, v in enumerate(ODD)] + [(500, rows[3][1] + [0.0], 0), (501, [2 * x for x in rows[3][1]], 0), (502, [-x for x in rows[3][1]], 0)]
    rng.shuffle(rows)
    rows = [tuple(r) for r in rows]
    assert as_rows(dedup.vector_dedup(frame(spark, rows))) == plain_links(rows)


def test_no_pair_is_lost_by_probes_or_codes():
    """Every pair above the threshold passes the filters, in random data with few lists."""
    rng = np.random.default_rng(7)
    x = rng.normal(size=(600, 24))
    x = np.concatenate([x, x + rng.normal(size=x.shape) * 0.17])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    index = dedup.Index(x[::3], 40, 0.98)
    at, codes, s, e = index.place(x)
    probes = index.probes(x, at)
    pairs = np.argwhere(np.triu(x @ x.T >= 0.98, 1))
    assert len(pairs) > 300
    for a, b in pairs:
        lo, hi = (a, b) if at[a] <= at[b] else (b, a)
        assert at[lo] == at[hi] or probes[lo, at[hi]]
        assert index.bounds(x[lo : lo + 1], at[hi], codes[hi : hi + 1], s[hi : hi + 1], e[hi : hi + 1])[0, 0] >= 0.98 - dedup.SLACK
    assert probes.mean() < 0.6


def test_dedup_of_empty_table_and_large_values(spark):
    assert dedup.vector_dedup(frame(spark, [])).collect() == []
    rows = [(1, [1e300, 1e300], 0), (2, [1e-300, 1e-300], 0), (3, None, 0)]
    assert as_rows(dedup.vector_dedup(frame(spark, rows))) == [(False, 1, 1, False, 1, True), (False, 2, 1, False, 1, False), (False, 3, 0, False, 3, True)]


# -- hard negatives -----------------------------------------------------------------------


def plain_negatives(rows, every, k=5):
    part = [(i, [math.floor(256 * c) for c in v], label) for i, v, label in rows if fine(v) and label is not None and i is not None]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for i, a, label in sorted({(i, tuple(v), label) for i, v, label in part if i % every == 0}):
        scored = [(-dot(a, v), j, other) for j, v, other in part if j != i]
        for p, j, _ in sorted(s for s in scored if s[2] == label)[:k]:
            ok = sorted(s for s in scored if s[2] != label and 80 * -p <= 100 * -s[0] <= 100 * -p)[:k]
            out += [(i, j, n + 1, m, -p, -s) for n, (s, m, _) in enumerate(ok)]
    return sorted(out)


@pytest.mark.parametrize("block,leaf", [(4096, 256), (64, 4)])
def test_hard_negatives_equal_brute_force(spark, block, leaf):
    rng = random.Random(8)
    # Few values, so scores tie often; a third of the rows are equal.
    rows = [(i, [rng.choice([-0.25, 0.0, 0.5, 0.75]) for _ in range(4)], rng.randrange(3)) for i in range(240)]
    rows += [(i, [0.5, 0.5, -0.25, 0.75], i % 2) for i in range(240, 360)] + [(360 + i, v, 1) for i, v in enumerate(ODD)]
    rows += [(400, [1.0, 1.0], 2), (410, [0.5] * 4, None), (None, [0.5] * 4, 1), (20, [0.5] * 4, 1)]
    df = frame(spark, rows)
    got = hard.hard_negatives(df, df.filter("vec_id % 10 = 0"), block_rows=block, leaf_rows=leaf)
    assert sorted(map(tuple, got.collect())) == plain_negatives(rows, 10)


def test_hard_negatives_beyond_doubles_and_empty_table(spark):
    assert hard.hard_negatives(frame(spark, []), frame(spark, [])).collect() == []
    rows = [(0, [4e6, 1.0], 0), (1, [4e6, 3.0], 0), (2, [4e6, 2.0], 1), (3, [-4e6, 2.0], 1), (4, [4e6, 3.0], 1)]
    df = frame(spark, rows)
    got = hard.hard_negatives(df, df.filter("vec_id = 0"))
    assert sorted(map(tuple, got.collect())) == plain_negatives(rows, 10) != []


def test_bounds_hold_every_score_and_boxes_are_pruned():
    rng = np.random.default_rng(9)
    x = np.floor(rng.normal(size=(2000, 3)) * 256)
    forest = hard.Forest(np.arange(2000), np.zeros(2000, np.int64), x, 32)
    anchor = np.floor(rng.normal(size=(1, 3)) * 256)
    low, high, exact = forest.bounds(anchor)
    search = hard.Search(forest, -1, anchor[0], low[0], high[0], exact)
    best = search.best([forest.roots[0]], 5)
    scores = x @ anchor[0]
    order = np.lexsort((np.arange(2000), -scores))[:5]
    assert best == [(-int(scores[i]), int(i)) for i in order]
    leaves = [n for n, c in enumerate(forest.children) if c is None]
    assert exact and len(search.opened) < len(leaves) / 4
    for n in leaves:
        s = forest.leaf_x[n] @ anchor[0]
        assert low[0, n] <= s.min() and s.max() <= high[0, n]
