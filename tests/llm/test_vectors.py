"""Hard negatives and vector codes against brute force and on odd rows."""

import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from locus.llm.hard_negatives import mine_hard_negatives, residue_base, residue_scores, residues
from locus.llm.vector_codes import EqualAverageIndex, compress_vectors

SCHEMA = "vec_id long, embedding array<float>, label int"
INF, NAN = float("inf"), float("nan")


def table(spark, rows):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, SCHEMA)
    return df.withColumns({c: F.lit("clash") for c in ("id", "key", "vec", "rank", "score", "code", "error", "g", "top")})


def random_rows(seed, n, dim=8, labels=3):
    rng = np.random.default_rng(seed)
    vecs = rng.normal(size=(n, dim)).astype(np.float32)
    vecs[rng.random(n) < 0.3] = vecs[0]  # many alike
    return [(int(i), vecs[i].tolist(), int(rng.integers(labels))) for i in range(n)]


def usable(rows, label=True):
    return [r for r in rows if r[1] is not None and all(x is not None and np.isfinite(x) for x in r[1])
            and (not label or (r[0] is not None and r[2] is not None))]


def brute_negatives(rows, every, n_pos, n_neg):
    kept = usable(rows)
    width = max((len(r[1]) for r in kept), default=0)
    ints = {id(r): [int(np.floor(256 * float(x))) for x in r[1]] + [0] * (width - len(r[1])) for r in kept}
    out = set()
    for a in kept:
        if a[0] % every:
            continue

        def ranked(choose):
            found = {(-sum(x * y for x, y in zip(ints[id(a)], ints[id(b)])), b[0]) for b in kept if choose(b)}
            return sorted(found)

        for s, p in ranked(lambda b: b[2] == a[2] and b[0] != a[0])[:n_pos]:
            negatives = [(t, n) for t, n in ranked(lambda b: b[2] != a[2]) if 30 * -s <= 100 * -t <= 90 * -s]
            out |= {(a[0], p, k + 1, n, -s, -t) for k, (t, n) in enumerate(negatives[:n_neg])}
    return out


@settings(max_examples=30, deadline=None)
@given(st.integers(0, 2**32), st.sampled_from([1, 3, 64, 1500]), st.sampled_from([1.0, 1e3, 1e7]))
def test_residue_scores_are_exact(seed, dim, size):
    rng = np.random.default_rng(seed)
    a, b = (np.floor(rng.normal(size=(n, dim)) * size) for n in (7, 9))
    want = np.array([[sum(int(x) * int(y) for x, y in zip(u, v)) for v in b] for u in a])
    base = residue_base(int(np.abs(want).max()) + 1)
    assert (residue_scores(residues(a, base), residues(b, base), base) == want).all()


def test_scores_beyond_64_bits_raise(spark):
    with pytest.raises(OverflowError):
        residue_base(2**61)
    with pytest.raises(OverflowError):
        mine_hard_negatives(table(spark, [(0, [1e30], 1), (1, [1e30], 1)]))


@pytest.mark.parametrize("seed,group_bytes", [(1, 16_000_000), (2, 1024)])
def test_negatives_equal_brute_force(spark, seed, group_bytes):
    rows = random_rows(seed, 150) + [(3, [0.5] * 8, 0), (3, [0.5] * 8, 0), (10, [0.25] * 8, 1)]
    got = mine_hard_negatives(table(spark, rows), anchor_every=10, n_positives=3, n_negatives=4,
                              group_bytes=group_bytes, slice_rows=40).collect()
    assert len(got) == len({tuple(r) for r in got})
    assert {tuple(r) for r in got} == brute_negatives(rows, 10, 3, 4)
    assert got


def test_negatives_of_odd_rows(spark):
    odd = [(None, [1.0, 2.0], 1), (0, None, 1), (0, [1.0, None], 1), (0, [INF, 1.0], 1), (0, [NAN, 1.0], 1),
           (0, [1.0, 1.0], None), (100, [], 1), (200, [1.0], 1), (1, [1.0, 1.0, 1.0], 1), (2, [0.5], 2), (3, [-1.0], 1)]
    got = {tuple(r) for r in mine_hard_negatives(table(spark, odd)).collect()}
    assert got == brute_negatives(odd, 100, 5, 10) and got
    assert mine_hard_negatives(table(spark, [])).collect() == []


def brute_codes(rows, parts=4, entries=256, rounds=4, scale=1024):
    kept = usable(rows, label=False)
    longest = max((len(r[1]) for r in kept), default=0)
    dim = -(-longest // parts)
    ints = [[int(np.floor(scale * float(x))) for x in r[1]] + [0] * (dim * parts - len(r[1])) for r in kept]
    order = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0] or 0, kept[i][1]))[:entries]
    books = [[ints[i][p * dim : (p + 1) * dim] for i in order] for p in range(parts)]

    def assign(x, p):
        part = x[p * dim : (p + 1) * dim]
        return min((sum((u - v) ** 2 for u, v in zip(part, e)), i) for i, e in enumerate(books[p]))

    for _ in range(rounds):
        codes = [[assign(x, p)[1] for p in range(parts)] for x in ints]
        for p in range(parts):
            for e in range(len(books[p])):
                mine = [x[p * dim : (p + 1) * dim] for x, c in zip(ints, codes) if c[p] == e]
                if mine:
                    books[p][e] = [sum(col) // len(mine) for col in zip(*mine)]
    final = [[assign(x, p) for p in range(parts)] for x in ints]
    errors = [sum(d for d, _ in f) for f in final]
    totals = {}
    for r, e in zip(kept, errors):
        totals[r[2]] = totals.get(r[2], 0) + e
    text = ",".join(str(x) for book in books for entry in book for x in entry)
    digest = hashlib.sha256(text.encode()).hexdigest()
    return sorted((repr(r[0]), "".join(f"{i:02x}" for _, i in f), e, totals[r[2]], digest)
                  for r, f, e in zip(kept, final, errors))


@pytest.mark.parametrize("seed,n,entries", [(1, 60, 8), (2, 20, 256), (3, 300, 16)])
def test_codes_equal_brute_force(spark, seed, n, entries):
    rows = random_rows(seed, n) + [(None, [0.5] * 8, None), (3, [0.25] * 7, None), (3, [0.25] * 7, 1), (7, [], 2)]
    got = compress_vectors(table(spark, rows), entries=entries).collect()
    assert sorted((repr(r[0]), *r[1:]) for r in got) == brute_codes(rows, entries=entries)


def test_codes_of_odd_tables(spark):
    assert compress_vectors(table(spark, [])).collect() == []
    assert compress_vectors(table(spark, [(1, None, 1), (2, [NAN], 1), (3, [None], 2)])).collect() == []
    only_empty = [(1, [], 1), (2, [], None)]
    assert sorted(tuple(r)[:4] for r in compress_vectors(table(spark, only_empty)).collect()) == [
        (1, "00000000", 0, 0), (2, "00000000", 0, 0)]
    with pytest.raises(OverflowError):
        compress_vectors(table(spark, [(1, [1e30], 1)]))


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 2**32), st.sampled_from([(3, 1), (3, 4), (200, 16), (1, 16)]), st.sampled_from([1, 2, 5, 256]))
def test_equal_average_search_finds_the_nearest(seed, shape, entries):
    rng = np.random.default_rng(seed)
    size, dim = shape
    book, parts = rng.integers(-size, size, (entries, dim)), rng.integers(-2 * size, 2 * size, (50, dim))
    dist = ((parts[:, None] - book[None]) ** 2).sum(axis=2)
    code, best = EqualAverageIndex(book).nearest(parts)
    assert (code == dist.argmin(axis=1)).all() and (best == dist.min(axis=1)).all()
