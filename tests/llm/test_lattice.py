import numpy as np

from recordloom.llm import lattice

SCHEMA = "vec_id long, embedding array<float>, label int, id long, n long, e string"


def brute(rows):
    def ok(r):
        return r[2] is not None and r[1] is not None and all(v is not None and np.isfinite(v) for v in r[1]) and any(v != 0 for v in r[1])

    vs = [np.array(r[1], float) if ok(r) else None for r in rows]
    link = lambda i, j: i != j and vs[i] is not None and vs[j] is not None and rows[i][2] == rows[j][2] and len(vs[i]) == len(vs[j]) and vs[i] @ vs[j] / np.linalg.norm(vs[i]) / np.linalg.norm(vs[j]) >= 0.98
    out = []
    near = [[j for j in range(len(rows)) if link(i, j)] for i in range(len(rows))]
    for i, r in enumerate(rows):
        seen, wait = {i}, [i]
        while wait:
            for j in near[wait.pop()]:
                if j not in seen:
                    seen.add(j)
                    wait.append(j)
        low = min(rows[j][0] for j in seen)
        out.append((r[0], len(near[i]), low, low == r[0]))
    return sorted(out)


def test_decoding_gives_the_nearest_point():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 8)) * 2
    p = lattice.decode(x)
    assert len({tuple(r) for r in lattice.ROOTS}) == 240
    other = ((x[:, None] - (p[:, None] + lattice.ROOTS[None])) ** 2).sum(2)
    assert (((x - p) ** 2).sum(1) <= other.min(1) + 1e-9).all()
    assert np.allclose((p.sum(1) % 2), 0) and np.allclose(((2 * p) % 1), 0)


def test_is_brute_force(spark, monkeypatch):
    monkeypatch.setattr(lattice, "SIDE", 16)
    rng = np.random.default_rng(3)
    rows = []
    for g in range(40):
        base = rng.normal(size=24)
        for _ in range(int(rng.integers(1, 6)) if g else 60):
            v = base + rng.normal(size=24) * rng.choice([0.0, 0.05, 0.12])
            rows.append((len(rows), [float(np.float32(x)) for x in v], int(g % 3)))
    rows += [(len(rows) + k, v, label) for k, (v, label) in enumerate([(None, 1), ([0.0] * 24, 1), ([float("nan")] * 24, 1), ([None] * 24, 1), (rows[0][1], None), (rows[0][1][:8], 0), ([], 0), (rows[0][1], 0)])]
    df = spark.createDataFrame([(*r, 1, 1, "e") for r in rows], SCHEMA)
    assert sorted(map(tuple, lattice.near_duplicates(df).collect())) == brute(rows)
    assert lattice.near_duplicates(df.limit(0)).count() == 0


def test_recall_at_the_limit():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(4000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    v = rng.normal(size=x.shape)
    v -= (v * x).sum(1, keepdims=True) * x
    y = 0.98 * x + np.sqrt(1 - 0.98**2) * v / np.linalg.norm(v, axis=1, keepdims=True)
    label = np.zeros(len(x), np.int64)
    met = [bool(set(a) & set(b)) for a, b in zip(lattice.cells(x, label).tolist(), lattice.cells(y, label).tolist(), strict=True)]
    assert np.mean(met) > 0.999
