import random

import numpy as np
import pyarrow as pa
import pytest
from edge_rows import EDGE

from locus.llm import jaccard_join
from locus.llm.components import connected_components
from locus.llm.jaccard_join import Scheme, jaccard_components, signatures
from locus.llm.shingles import shingle_sets


def brute(rows):
    sets, low = {}, {}
    for i, t in rows:
        w = bytes(t or "", "utf8").lower().split()
        sets.setdefault(i, []).append(
            {tuple(w[j : j + 5]) for j in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} if w else set())
    ids = [i for i in sets if i is not None]
    low = {i: i for i in ids}

    def find(i):
        while low[i] != i:
            i = low[i]
        return i

    for n, a in enumerate(ids):
        for b in ids[:n]:
            if any(x and y and 100 * len(x & y) >= 75 * len(x | y) for x in sets[a] for y in sets[b]):
                x, y = sorted((find(a), find(b)))
                low[y] = x
    return sorted(((i, len(s), None if i is None else find(i)) for i, all_ in sets.items() for s in all_), key=str)


def varied(seed, groups=6, size=14):
    """Chains of near copies around the threshold, shared passages, short texts."""
    rng, rows, at = random.Random(seed), [], 0
    passage = " ".join(f"p{i}" for i in range(40))
    for g in range(groups):
        base = [f"g{g}w{i}" for i in range(rng.choice([4, 5, 6, 9, 30, 80, 150]))]
        for _ in range(size):
            base = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 40))):
                base[rng.randrange(len(base))] = f"x{rng.randrange(10**6)}"
            text = " ".join(base) + (" " + passage if rng.random() < 0.3 else "")
            rows.append((at, text))
            at += rng.randint(1, 3)
    return rows


@pytest.mark.parametrize("seed,dense", [(1, 64), (2, 3)])
def test_components_match_all_pairs(frame, seed, dense):
    rows = varied(seed) + ([(10**6 + (i or 0) if i is not None else None, t) for i, t in EDGE] if seed == 1 else [])
    got = jaccard_components(frame(rows), dense_from=dense, block=8, flush=3000).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows)


def test_empty(frame):
    assert jaccard_components(frame(EDGE).limit(0)).count() == 0


@pytest.mark.parametrize("num,den", [(75, 100), (9, 10), (3, 5), (1, 1)])
def test_linked_sets_share_a_signature(num, den):
    rng, scheme, seen = np.random.default_rng(num), Scheme(num, den), 0
    for _ in range(1500):
        n = int(rng.choice([1, 2, 3, 4, 5, 7, 8, 9, 15, 16, 31, 33, 64, 127, 128, 129, 400]))
        pool = rng.integers(0, 2**64, size=3 * n + 3, dtype=np.uint64)
        common = int(rng.integers(max(1, n * num // den), n + 1))
        extra = int(rng.integers(0, max(1, n * (den - num) // num) + 1))
        a, b = np.unique(pool[:n]), np.unique(np.append(pool[:common], pool[n : n + extra]))
        both = len(np.intersect1d(a, b))
        if den * both >= num * (len(a) + len(b) - both):
            seen += 1
            assert len(np.intersect1d(signatures(a, scheme), signatures(b, scheme)))
    assert seen > 100


def test_shingles_by_hand():
    texts = [None, "", "a", "A", "a b c d", "a b c d e", "a b c d e a b c d e a", "a\x0bb\x0cc\td\ne", "x " + "y" * 500 + " a b c"]
    sizes = [len(s) for s in shingle_sets(pa.array(texts), chunk_bytes=8)]
    assert sizes == [0, 0, 1, 1, 1, 1, 5, 1, 1]
    one, two, six, eight = (list(shingle_sets(pa.array(texts)))[i] for i in (2, 3, 5, 7))
    assert (one == two).all() and (six == eight).all()


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 40)] + [(300, 299)]
    got = {tuple(r) for r in connected_components(spark.createDataFrame(links, "u long, v long")).collect()}
    want = {(i, 0) for i in range(61)} | {(100 + i, 100) for i in range(40)} | {(299, 299), (300, 299)}
    assert got == want


def _entry(kind, part, sig, owners, dense):
    sigs = np.full(len(owners) if kind == 1 else 1, sig, dtype=np.uint64)
    return (kind, part, None, None, None, None, None, sigs.tobytes(), np.array(owners, np.int64).tobytes(), dense)


def test_a_hot_signature_is_given_out_in_lots(monkeypatch):
    """Sparse entries and dense lists of one signature: no batch and nothing held grows with them."""
    monkeypatch.setattr(jaccard_join, "LOT", 100, raising=False)
    monkeypatch.setattr(jaccard_join, "CHUNK", 16, raising=False)
    taken, rng = [], random.Random(5)
    ids = list(range(3000))
    rng.shuffle(ids)

    def batches():
        for at in range(0, 3000, 10):
            taken.append(at)
            mine = sorted(ids[at : at + 10])
            rows = [_entry(1, 7, 99, mine, False)] if at % 20 else [
                _entry(1, 7, 99, mine[:1], True), _entry(2, 7, 99, mine, True)]
            yield jaccard_join._batch(rows, jaccard_join._SIGNED)

    got = jaccard_join._collide(8, 50)(batches())
    low, listed, early = {}, set(), 0
    for batch in got:
        assert batch.num_rows <= 200
        early += bool(batch.num_rows) and len(taken) < 300
        for r in batch.to_pylist():
            if r["kind"] == 1:
                low.setdefault(r["b"], r["a"])
            else:
                assert r["bucket"] == 99 and len(r["members"]) <= 16
                listed.update(r["members"])
    assert early > 10 and listed == set(ids)
    for i in ids:
        while i in low:
            i = low[i]
        assert i == 0


@pytest.mark.parametrize("room", [1, 200])
def test_little_room_changes_no_component(frame, room):
    rows = varied(3)
    got = jaccard_components(frame(rows), dense_from=4, block=8, flush=3000, room=room).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows)


def test_lists_of_a_signature_go_to_many_parts():
    docs = pa.RecordBatch.from_arrays(
        [pa.array(range(400)), pa.array([" ".join(f"w{j}" for j in range(60)) + f" x{i}" for i in range(400)])],
        names=["doc", "text"])
    parts = {}
    for batch in jaccard_join._sign(75, 100, 5, 64, 500, 4)(iter([docs])):
        for r in batch.to_pylist():
            if r["kind"] == 2:
                parts.setdefault(r["sigs"], set()).add(r["part"])
    assert max(map(len, parts.values())) > 5


@pytest.mark.parametrize("n", [33, 49, 50])
def test_every_member_of_a_dense_list_is_paired(monkeypatch, n):
    """4096 * j + 1 members leave no list of one (here with lists of 16)."""
    monkeypatch.setattr(jaccard_join, "CHUNK", 16)
    docs = pa.RecordBatch.from_arrays(
        [pa.array(range(n)), pa.array([" ".join(f"w{j}" for j in range(60)) + f" x{i}" for i in range(n)])],
        names=["doc", "text"])
    members = {}
    for batch in jaccard_join._sign(75, 100, 5, 4, 10**6, 4)(iter([docs])):
        for r in batch.to_pylist():
            if r["kind"] == 2:
                members.setdefault(r["sigs"], []).append(np.frombuffer(r["owners"], np.int64).tolist())
    full = [lists for lists in members.values() if len(set().union(*lists)) == n]
    assert full
    for lists in full:
        assert all(1 < len(m) <= 16 and m[0] == 0 for m in lists)


def test_an_id_with_several_texts_has_the_links_of_all(frame):
    a, b = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(300))
    c = " ".join(f"c{i}" for i in range(80))
    # 1, 2 and 5 by equal texts; 8 and 3 by near copies of 5's and 7's larger texts
    rows = [(1, a), (2, b), (5, a), (5, b), (5, ""), (3, c + " end"), (7, "short"), (7, c), (7, b + " end"),
            (8, "x " + c), (9, "short"), (6, "apart")]
    got = jaccard_components(frame(rows)).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows)
    assert {r["component_id"] for r in got if r["doc_id"] in (1, 2, 5, 3, 7, 8, 9)} == {1}


@pytest.mark.parametrize("seed", [4, 5])
def test_repeated_ids_match_all_pairs(frame, seed):
    rows = [(i % 37, t) for i, t in varied(seed, groups=12, size=6)]
    got = jaccard_components(frame(rows), dense_from=4, block=8, flush=3000).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows)


def test_a_group_has_tasks_for_its_work(spark):
    """600 full buckets of one group, three buckets of another, 3000 small ones of a third."""
    rows = [(i, 1, 2000) for i in range(600)] + [(1000 + i, 7, 2000) for i in range(3)] + [(2000, 8, 5000)]
    rows += [(3000 + i, 9, 30) for i in range(3000)]
    got = jaccard_join.dealt_by_work(spark.createDataFrame(rows, "bucket long, c0 long, m long"), 2048).collect()
    tasks, most = {}, {}
    for r in got:
        tasks.setdefault(r["c0"], set()).add(r["near"])
        most[r["c0"], r["near"]] = most.get((r["c0"], r["near"]), 0) + 1
    assert len(got) == 3604 and len(tasks[1]) > 10 and len(tasks[7]) == 1 and len(tasks[9]) > 8
    assert max(n for (c, _), n in most.items() if c == 9) * 30 < 5 * 2048
    assert max(n for (c, _), n in most.items() if c == 1) < 100
    assert {r["bucket"]: r["blocks"] for r in got}[2000] == 3
