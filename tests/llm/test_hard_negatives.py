import math
import random

import duckdb
import numpy as np
import pytest

from poolwright.llm import hard_negatives as m

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, anchor=lambda i: i % 100 == 0, move=True):
    """All pairs, sorted; rows that take part are distinct."""
    kept = []
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        if move and i % 7 == 0:
            label = (label + 1) % 10
        kept.append((i, label, tuple(math.floor(256 * x) for x in v)))
    kept = sorted(set(kept))
    out = []
    for a, la, qa in kept:
        if not anchor(a):
            continue
        dot = lambda q: sum(x * y for x, y in zip(qa, q))
        scored = sorted((-dot(q), i, label) for i, label, q in kept)
        positives = [(i, -s) for s, i, label in scored if label == la and i != a][:5]
        for p, ps in positives:
            window = [(i, -s) for s, i, label in scored if label != la and 80 * ps <= -100 * s <= 100 * ps][:5]
            out += [(a, p, r, i, ps, s) for r, (i, s) in enumerate(window, 1)]
    return sorted(out)


def vectors(seed, n, width=24, labels=4):
    """Unit vectors around a few centres, as single floats."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, width))
    rows = []
    for i in range(n):
        v = centres[rng.integers(6)] * rng.uniform(0, 1.5) + rng.normal(size=width)
        v = (v / np.linalg.norm(v)).astype(np.float32)
        rows.append((i, v.tolist(), int(rng.integers(labels))))
    return rows


def test_pairs_above_equal_all_products():
    rng = np.random.default_rng(1)
    for trial in range(60):
        d, n, k = int(rng.integers(1, 40)), int(rng.integers(0, 60)), int(rng.integers(0, 12))
        a, x = np.floor(rng.normal(size=(k, d)) * 100), np.floor(rng.normal(size=(n, d)) * 100 * rng.uniform(0, 1, size=(n, 1)))
        low = np.floor(rng.uniform(-1, 1) * 1e4 * d + rng.normal(size=k) * 1000) if trial % 5 else np.full(k, -np.inf)
        allowed = rng.random((k, n)) < 0.7
        full = a @ x.T
        wanted = {(i, j, int(full[i, j])) for i in range(k) for j in range(n) if allowed[i, j] and full[i, j] >= low[i]}
        got = m.pairs_above(a, x, low, allowed)
        assert set(zip(*(g.tolist() for g in got))) == wanted
        assert set(zip(*(g.tolist() for g in m._large_pairs(a, x, low, allowed)))) == wanted


def test_high_thresholds_leave_dimensions_out(monkeypatch):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(500, 64)) * np.exp(-np.arange(64) / 8)
    x = np.floor(x / np.linalg.norm(x, axis=1, keepdims=True) * 256)
    seen = []
    real = np.einsum
    monkeypatch.setattr(m.np, "einsum", lambda how, a, b: seen.append(len(a)) or real(how, a, b))
    got = m.pairs_above(x[:20], x, np.full(20, 0.9 * 65536), np.ones((20, 500), bool))
    # few pairs were completed, and none was lost
    assert 0 < sum(seen) < 0.1 * 20 * 500
    assert len(got[0]) == (x[:20] @ x.T >= 0.9 * 65536).sum()


def test_mining_equals_brute_force_and_sql(spark):
    rows = vectors(3, 900)
    rng = random.Random(4)
    # ties: equal vectors under other ids and labels
    rows += [(900 + k, rows[rng.randrange(900)][1], rng.randrange(4)) for k in range(150)]
    got = m.mine_embeddings(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(map(tuple, got)) == brute(rows) and len(got) > 100
    con = duckdb.connect()
    con.execute("CREATE TABLE embeddings (vec_id BIGINT, embedding FLOAT[], label INTEGER)")
    con.executemany("INSERT INTO embeddings VALUES (?, ?, ?)", rows)
    assert sorted(con.execute(m.EMBEDDINGS_SQL).fetchall()) == brute(rows)


def test_blocks_rounds_and_anchors_read_again(spark, monkeypatch):
    monkeypatch.setattr(m, "ROWS", 50)
    monkeypatch.setattr(m, "ANCHORS", 3)
    monkeypatch.setattr(m, "KEPT", 4)
    rows = vectors(5, 400, labels=2)
    got = m.mine(spark.createDataFrame(rows, SCHEMA), m.F.col("vec_id") % 20 == 0).collect()
    assert sorted(map(tuple, got)) == brute(rows, lambda i: i % 20 == 0, move=False)


def test_hard_rows(spark):
    rows = vectors(6, 60, width=5)
    rows += [rows[10], (0, rows[5][1], 3), (None, rows[1][1], 1), (61, None, 1), (62, rows[2][1], None), (63, [0.1, None], 2), (64, [float("nan")] * 5, 2), (65, [float("inf")] * 5, 1)]
    rows += [(66, [], 1), (67, [0.5, 0.25], 2), (68, [0.0] * 5, 1), (100, [-0.5] * 5, 1), (200, [], 1), (300, [0.0] * 5, 2)]
    wide = spark.createDataFrame([(*r, "x", 1.0) for r in rows], SCHEMA + ", score string, rank double")
    assert sorted(map(tuple, m.mine_embeddings(wide).collect())) == brute(rows)
    assert m.mine_embeddings(spark.createDataFrame([], SCHEMA)).collect() == []
    assert m.mine_embeddings(spark.createDataFrame([(1, [0.5], 1), (2, [0.25], 2)], SCHEMA)).collect() == []


@pytest.mark.parametrize("size", [1e6, 1e12])
def test_large_components_stay_exact(spark, size):
    rng = np.random.default_rng(7)
    rows = [(100 * (i < 3) * i + i * (i >= 3), (rng.normal(size=4) * size).tolist(), int(i % 2)) for i in range(30)]
    got = sorted(map(tuple, m.mine_embeddings(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()))
    wanted = brute(rows)
    if size < 1e9:
        assert got == wanted
    else:  # scores that a long cannot hold are the largest long
        assert all(abs(r[4]) <= m.LONG and abs(r[5]) <= m.LONG for r in got)
