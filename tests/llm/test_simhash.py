"""SimHash components against brute force, and the bit-sliced comparison."""

import re

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from locus.llm.common import documents, materialize
from locus.llm.simhash_dedup import BitPlanes, fingerprint_links, simhash_components
from edge_rows import EDGE

SF = "/root/testdata/sf0.001"


def brute_fingerprint(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, radius=3):
    """(id, fingerprint) rows -> sorted (id, hex, component)."""
    low = list(range(len(prints)))

    def top(i):
        while low[i] != i:
            i = low[i]
        return i

    for i, (_, p) in enumerate(prints):
        for j in range(i):
            if bin(p ^ prints[j][1]).count("1") <= radius:
                low[top(i)] = top(j)
    ids = {}
    for i, (d, _) in enumerate(prints):
        if d is not None:
            ids[top(i)] = min(d, ids.get(top(i), d))
    return sorted(((d, f"{p:016x}", ids.get(top(i))) for i, (d, p) in enumerate(prints)), key=repr)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_documents_equal_brute_force(spark):
    docs = documents(spark, SF)
    want = brute_components([(r.doc_id, brute_fingerprint(r.text)) for r in docs.collect()])
    assert result(simhash_components(docs)) == want


def test_odd_rows(spark, frame):
    near = [(20 + i, " ".join(f"w{j}" for j in range(400) if j != i)) for i in range(12)]
    rows = [*EDGE, *near, (40, "x" * 2_000_000), (41, "Long " * 200_000 + "end"), (42, "퟿ é \U0001f600 z"),
            (43, "one two"), (44, "ONE\x0btwo"), (45, "one two")]
    got = result(simhash_components(frame(rows), block=4))
    assert got == brute_components([(d, brute_fingerprint(t)) for d, t in rows])
    parts = {r[0]: r[2] for r in got}
    assert parts[1] == parts[2] == parts[3] == 1 and parts[44] == 43 and parts[45] == 45
    assert simhash_components(frame([(1, "a")]).limit(0)).collect() == []


def test_xxhash_is_sparks_own(spark):
    """With one shingle the fingerprint is its hash."""
    df = spark.createDataFrame([(1, "alpha beta gamma"), (2, "ü")], "doc_id long, text string")
    got = simhash_components(df).join(df, "doc_id").select(
        "fingerprint", F.lpad(F.lower(F.hex(F.xxhash64("text"))), 16, "0")).collect()
    assert all(a == b for a, b in got)


@pytest.mark.parametrize("block", [8, 64, 2048])
def test_no_link_is_lost_in_large_buckets(spark, block):
    """Fingerprints around few centres: buckets of hundreds, dealt to sub-blocks."""
    rng = np.random.default_rng(block)
    centres = rng.integers(0, 2**64, 3, dtype=np.uint64)
    prints = centres[rng.integers(0, 3, 500)]
    for _ in range(5):
        prints = prints ^ (np.uint64(1) << rng.integers(0, 64, 500).astype(np.uint64))
    prints = np.unique(np.concatenate([prints, rng.integers(0, 2**64, 100, dtype=np.uint64)]))
    nodes = materialize(spark.createDataFrame([(int(p),) for p in prints.view(np.int64)], "fp long"), "nodes")
    low = {int(p): int(p) for p in prints.view(np.int64)}

    def top(x):
        while low[x] != x:
            x = low[x]
        return x

    for r in fingerprint_links(nodes, block=block).collect():
        low[top(r.u)] = top(r.v)
    got = {}
    for p in low:
        got.setdefault(top(p), set()).add(p)
    want = {}
    for d, _, c in brute_components([(i, int(p)) for i, p in enumerate(prints)]):
        want.setdefault(c, set()).add(int(prints.view(np.int64)[d]))
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


@settings(max_examples=30, deadline=None)
@given(st.integers(0, 2**32), st.integers(1, 200), st.integers(1, 80), st.integers(0, 9))
def test_bit_sliced_distances(seed, members, queries, radius):
    rng = np.random.default_rng(seed)
    centre = rng.integers(0, 2**64, dtype=np.uint64)
    flips = rng.integers(0, 2**64, (members + queries, 3), dtype=np.uint64)
    all_ = centre ^ (flips[:, 0] & flips[:, 1] & flips[:, 2])
    a, b = all_[:members], all_[members:]
    q, m = BitPlanes(a).within(b, radius)
    want = np.argwhere(np.bitwise_count(b[:, None] ^ a[None, :]) <= radius)
    assert sorted(zip(q.tolist(), m.tolist())) == [tuple(x) for x in want.tolist()]
