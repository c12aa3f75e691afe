"""Vector codes and whitening against plain versions in whole numbers and dense eigenvectors."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldlens.llm import codes, whitening


def _plain_codes(rows):
    """The codes by direct comparison; rows are (vec_id, vector, label) without unusable ones."""
    x = np.floor(4096 * np.array([v for _, v, _ in rows])).astype(np.int64)
    parts = x.reshape(len(x), 8, -1)
    first = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, x[i].tolist()))[:16]
    books = [parts[first, p].copy() for p in range(8)]

    def assign(p):
        d = ((parts[:, p, None, :] - books[p][None]) ** 2).sum(2)
        return d.argmin(1), d.min(1)

    for _ in range(6):
        for p in range(8):
            of = assign(p)[0]
            for e in range(len(books[p])):
                if (of == e).any():
                    books[p][e] = parts[of == e, p].sum(0) // (of == e).sum()
    found = [assign(p) for p in range(8)]
    code = ["".join(f"{found[p][0][i]:02x}" for p in range(8)) for i in range(len(rows))]
    error = sum(d for _, d in found)
    labels = {}
    for (_, _, label), e in zip(rows, error.tolist()):
        labels[label] = labels.get(label, 0) + e
    digest = hashlib.sha256(",".join(str(c) for b in books for c in b.ravel().tolist()).encode()).hexdigest()
    return sorted(((r[0], code[i], int(error[i]), labels[r[2]], digest) for i, r in enumerate(rows)), key=repr)


def _codes(df):
    return sorted((tuple(r) for r in codes.compress(df).select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()), key=repr)


SCHEMA = "vec_id long, embedding array<double>, label int"


@pytest.mark.parametrize("dim", [8, 16, 64])
def test_codes(frame, dim):
    rng = np.random.default_rng(dim)
    rows = [(i, v, int(i) % 3 if i % 5 else None) for i, v in enumerate((rng.standard_normal((300, dim)) * rng.choice([0.01, 1, 30])).tolist())]
    rows += rows[:7] + [(None, rows[0][1], 1)]
    assert _codes(frame(rows, SCHEMA).repartition(5)) == _plain_codes(rows)


def test_bounds_drop_no_nearest_entry():
    rng = np.random.default_rng(3)
    for width, scale in ((8, 5), (8, 1 << 20), (1, 9), (6, 100), (12, 3)):
        x, book = rng.integers(-scale, scale, (500, width)), rng.integers(-scale, scale, (16, width))
        book[5] = book[2]  # a tie
        best, distance = codes.nearest_entries(x, book)
        all_ = ((x[:, None] - book[None]) ** 2).sum(2)
        assert (best == all_.argmin(1)).all() and (distance == all_.min(1)).all()


def test_codes_edges(frame):
    v = [0.5] * 8
    rows = [(1, v, 1), (1, v, 1), (2, None, 1), (3, [float("nan"), *v[1:]], 1), (4, [None, *v[1:]], 1), (5, [float("inf"), *v[1:]], 2), (6, v[:5], 2), (7, [1e300, *v[1:]], None), (8, [-2.0, *v[1:]], None), (9, [], 4)]
    df = frame(rows, SCHEMA).withColumns({c: F.lit("clash") for c in ("x", "n", "code", "error", "of", "given", "v")})
    got = {r["vec_id"]: r for r in codes.compress(df).collect()}
    assert set(got) == {1, 7, 8} and got[1]["error"] == 0 and all(len(r["code"]) == 16 for r in got.values())
    assert codes.compress(df.limit(0)).count() == 0 and codes.compress(df.where("vec_id = 6")).count() == 0


def _dense(vectors):
    x = np.floor(1024 * np.array(vectors)).astype(np.int64) + 100_000
    n, total = len(x), x.sum(0)
    centred = x - total / n
    values, found = np.linalg.eigh(centred.T @ centred / n)
    return x, n, total, centred, values[::-1], found[:, ::-1]


@pytest.mark.parametrize(("dim", "scales", "widest"), [(24, np.linspace(1, 1.2, 24), 512), (64, np.r_[[50, 40, 30, 20, 15, 12, 10, 8], np.ones(56)], 16), (5, np.arange(1, 6), 512)])
def test_whitening(frame, monkeypatch, dim, scales, widest):
    """A flat spectrum (the block widens to all dimensions), a steep one (the block stays narrow) and few dimensions."""
    monkeypatch.setattr(whitening, "WIDEST", widest)
    vectors = (np.random.default_rng(dim).standard_normal((1500, dim)) * scales).tolist()
    out = whitening.whiten(frame([(i, v) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>").repartition(3)).toPandas()
    x, n, total, centred, values, found = _dense(vectors)
    k = min(8, dim)
    assert len(out) == n * k and set(out.n) == {n} and out.identity_error.nunique() == 1 and out.identity_error[0] < 1e-9
    w = out.pivot(index="vec_id", columns="component", values="whitened").to_numpy()
    want = centred @ found[:, :k] / np.sqrt(values[:k])
    want *= np.sign((w * want).sum(0))
    assert np.abs(w - want).max() < 1e-7
    assert out.groupby("component").explained.first().to_numpy() == pytest.approx(values[:k] / values.sum(), rel=1e-9)
    assert out.drop_duplicates("vec_id").set_index("vec_id").deviation.loc[range(n)].tolist() == ((n * x - total) ** 2).sum(1).tolist()


def test_whitening_edges(frame):
    v = [1.0, 2.0, 3.0]
    rows = [(1, v), (1, v), (2, None), (3, [float("nan"), 1.0, 1.0]), (4, [None, 1.0, 1.0]), (5, [1.0]), (None, [4.0, 2.0, 3.0]), (6, [0.0, 2.0, 3.5])]
    df = frame(rows, "vec_id long, embedding array<double>").withColumns({c: F.lit("clash") for c in ("x", "n", "component", "v", "given")})
    out = whitening.whiten(df).collect()
    assert {r["component"] for r in out} == {1, 2} and len(out) == 8 and {r["n"] for r in out} == {4}  # the second dimension never varies
    assert whitening.whiten(df.where("vec_id = 1")).count() == 0 and whitening.whiten(df.limit(0)).count() == 0
    huge = frame([(1, [1e300, 0.0]), (2, [0.0, 1.0]), (3, [-1e9, 2.0])], "vec_id long, embedding array<double>")
    rows = {r["vec_id"]: r["deviation"] for r in whitening.whiten(huge).collect()}
    assert rows[1] is None and len(rows) == 3
