"""SimHash components against brute force."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from fieldlens.llm import components, simhash

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu".split()


def _fingerprint(text):
    low = "".join(c.lower() if c.isascii() else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(w[i : i + 4]) for i in range(len(w) - 3)] if len(w) >= 4 else [" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in shingles]
    return sum((2 * sum(x >> b & 1 for x in h) > len(h)) << b for b in range(64))


def _components(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def _expected(rows, budget=4):
    prints = [(i, _fingerprint(t)) for i, t in rows]
    distinct = sorted({f for _, f in prints})
    u = np.array(distinct, np.uint64)
    links = [(distinct[i], distinct[j]) for i in range(len(u)) for j in (np.flatnonzero(np.bitwise_count(u[i + 1 :] ^ u[i]) <= budget) + i + 1).tolist()]
    of = _components(distinct, links)
    least = {}
    for i, f in prints:
        if i is not None:
            least[of[f]] = min(least.get(of[f], i), i)
    return sorted(((i, f"{f:016x}", least.get(of[f])) for i, f in prints), key=repr)


def _got(df, **options):
    return sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in simhash.near_fingerprints(df, **options).collect()), key=repr)


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert _got(docs) == _expected([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_edges(frame):
    long = " ".join(WORDS[i * i % 12] for i in range(400_000))  # 2 MB
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "one"), (4, "one"), (5, "ONE"), (6, "Ä ÖÜ ☃ 😀 x y"), (None, "no id at all here"), (None, None), (7, long), (8, long + " more"), (9, "a\x0bb\x0cc d  e")]
    df = frame(rows, "doc_id long, text string").withColumns({c: F.lit("clash") for c in ("f", "label", "node", "whole", "fingerprint")})
    got = _got(df)
    assert got == _expected(rows)
    by = {(i, f): c for i, f, c in got}
    assert by[1, "0" * 16] == by[None, "0" * 16] == 1
    assert simhash.near_fingerprints(df.limit(0)).count() == 0


def test_half_of_the_hashes_is_not_over_half():
    text = "a b c d e"  # two shingles: a bit of one alone is half
    h = [xxhash.xxh64_intdigest(s, 42) for s in (b"a b c d", b"b c d e")]
    assert int(simhash.fingerprints(pa.array([text]))[0]) == h[0] & h[1]


@pytest.mark.parametrize(("budget", "leaf_rows"), [(4, 1 << 13), (4, 60), (1, 60), (6, 100), (0, 60)])
def test_links_of_crowds_and_lone_words(frame, budget, leaf_rows):
    """A ball of words around one, and others; walked in one group and through deeper node tables."""
    rng = random.Random(1)
    base, words = rng.getrandbits(64), {0, (1 << 64) - 1}
    for i in range(700):
        w = base if i % 3 else rng.getrandbits(64)
        for _ in range(rng.randrange(0, 9)):
            w ^= 1 << rng.randrange(64)
        words.add(w)
    u = np.array(sorted(words), np.uint64)
    signed = u.view(np.int64).tolist()
    links = [(signed[i], signed[j]) for i in range(len(u)) for j in (np.flatnonzero(np.bitwise_count(u[i + 1 :] ^ u[i]) <= budget) + i + 1).tolist()]
    crowds = simhash._crowds(frame([(f,) for f in signed], "f long"), budget).collect()
    start = [(r["f"], r["label"]) for r in crowds]
    found = [(r["a"], r["b"]) for r in simhash.hamming_links(frame(start, "f long, label long"), budget, leaf_rows).collect()]
    assert _components(signed, found + start) == _components(signed, links)
    assert len(found) <= 64 * len(start)  # links that join something new, not all pairs


def test_allowance_meets_every_difference():
    """For any difference within the budget, one turn keeps to the allowance at every depth."""
    rng = random.Random(2)
    for budget in (1, 4, 6):
        for _ in range(500):
            bits = [0] * 64
            for at in rng.sample(range(64), rng.randrange(budget + 1)):
                bits[at] = 1
            turned = [bits[16 * t :] + bits[: 16 * t] for t in range(4)]
            assert any(all(sum(b[:d]) <= simhash.allowance(d, budget) for d in range(65)) for b in turned)


@pytest.mark.parametrize("per_part", [100_000, 0])
def test_components(frame, monkeypatch, per_part):
    """Chains, stars and random graphs, in one partition and dealt by node; nulls, loops and repeated edges."""
    monkeypatch.setattr(components, "EDGES_PER_PART", per_part)
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(100, 140)] + [(500, i) for i in range(501, 560)] + [(rng.randrange(1000, 1200), rng.randrange(1000, 1200)) for _ in range(120)] + [(-5, 7), (-5, 7), (7, -5), (9, 9), (None, 3), (3, None)]
    rng.shuffle(edges)
    got = {r["node"]: r["label"] for r in components.components(frame(edges, "a long, b long")).collect()}
    real = [(a, b) for a, b in edges if a is not None and b is not None and a != b]
    assert got == _components({x for e in real for x in e}, real)
    assert components.components(frame([], "a long, b long")).count() == 0
