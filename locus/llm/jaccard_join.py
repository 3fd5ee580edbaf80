"""N-gram Jaccard join by PartEnum signatures, and its connected components.

Texts become sets of word shingles (``shingles.py``). Two sets are linked when
``den * |intersection| >= num * |union|``, so sets of n and m shingles differ
in at most ``(den - num) * (n + m) / (den + num)`` elements, the pair's k.

Signatures. Sizes fall into bands [2**b, 2**(b + 1) - 1]. The feature domain
is cut by hash into the band's number of partitions, a little over the
band's largest k, and the subsets of partitions that are enumerated are the
single ones: of more partitions than k, one at least has the same content in
both sets. A set that may have partners in the next band is signed there as
well. Three refinements keep this exact and small:

* an empty partition says nothing, so only filled ones are signed; a set with
  no more filled partitions than its k is signed under twice the partitions
  too, and again, until it has more. If one of two sets has enough they share
  a signature there; if neither has, both go on to the finer partitions;
* at most k partitions that one set fills are lost to the other, so of the
  filled partitions any k + 1 that come first in an order of all signatures
  suffice on both sides (the prefix principle). The order puts partitions with
  more elements first: a passage that many texts share seldom fills one alone;
* sets equal in content are signed once per task, and stand for one class.

Candidates. Signatures travel packed, dealt by value. Sets that share one
(a bucket) are paired with the bucket's smallest id. Of these pairs each set's
smallest partner is verified first; the links give components, and of the
other pairs only those across components are verified. Buckets that then still
hold several components have their remaining pairs compared, in blocks. Size
and a 128-cell histogram of the hashes (a finer one besides for large sets), whose distance bounds the
number of differing elements from below, come before every verification. So no link is lost, and a large group of
near copies costs as many comparisons as it has members. A signature that
many sets of one task share travels once for that task, and its members go
as a list to the second comparison.

Verification recomputes the shingle sets of the candidates' whole texts; a
set's partners meet it in portions of ``portion``, so no set's partners
gather in one task.

Defined results: null, empty and wordless texts have an empty set and link
with nothing; a row with a null id links with nothing and its component is
null; rows that repeat an id count as one document for links (those of all its
texts) and each give a row; other columns are ignored; an empty table gives an
empty result. Shingles are told apart by 64-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locus.llm.common import attach_salted, lean, materialize, remove, shuffle_partitions, written
from locus.llm.components import connected_components
from locus.llm.shingles import mix, shingle_sets

_U = np.uint64
#: Cells of a set's histogram, and how many of them make one coarse cell; sets
#: of BIG or more have a finer histogram of FINE cells besides.
CELLS, COARSE, BIG, FINE = 128, 8, 512, 2048


class Scheme:
    """Sizes of bands and bounds for a threshold num / den above one half (up
    to there a set may be outnumbered by what it lacks, and k reaches n)."""

    def __init__(self, num: int, den: int):
        if not den < 2 * num <= 2 * den:
            raise ValueError("the threshold must be above 1/2 and at most 1")
        self.num, self.den = num, den

    def k(self, n: int, m: int) -> int:
        """Most elements that linked sets of n and m can differ in."""
        return (self.den - self.num) * (n + m) // (self.den + self.num)

    def largest_partner(self, n: int) -> int:
        return n * self.den // self.num

    def bands(self, n: int) -> list[tuple[int, int]]:
        """(band's upper size, k of this set) for the bands to sign in."""
        top = (1 << n.bit_length()) - 1
        most = self.largest_partner(n)
        out = [(top, self.k(n, min(most, top)))]
        while most > top:
            top = 2 * top + 1
            out.append((top, self.k(n, min(most, top))))
        return out

    def partitions(self, top: int) -> int:
        """A little over the band's largest k; a few more fill enough partitions."""
        return self.k(top, top) * 23 // 20 + 2


def signatures(features: np.ndarray, scheme: Scheme) -> np.ndarray:
    """All signatures of one set (sorted distinct uint64 features)."""
    out = []
    content = mix(features + _U(0x5851F42D4C957F2D))
    low = features & _U(0xFFFFFFFF)
    for top, k in scheme.bands(len(features)):
        parts = scheme.partitions(top)
        while True:
            part = ((low * _U(parts)) >> _U(32)).astype(np.int64)
            sums = np.zeros(parts, dtype=_U)
            np.add.at(sums, part, content)
            counts = np.bincount(part, minlength=parts)
            filled = np.flatnonzero(counts)
            seed = _U((top * 0x9E3779B97F4A7C15 + parts * 0xD6E8FEB86659FD93) % (1 << 64))
            sig = mix(sums[filled] + mix(filled.astype(_U) + seed))
            good = len(filled) > k
            if len(sig) > k + 1:
                # equal signatures have equal counts, so this is one order for all sets
                few = (255 - np.minimum(counts[filled], 255)).astype(_U)
                sig = sig[np.argpartition((few << _U(56)) | (sig >> _U(8)), k)[: k + 1]]
            out.append(sig)
            if good:
                break
            parts *= 2
    return np.concatenate(out)


def histogram(features: np.ndarray, cells: int = CELLS) -> bytes:
    """How many features fall into each of the cells, at most 255."""
    bits = _U(64 - (cells.bit_length() - 1))
    counts = np.bincount((features >> bits).astype(np.int64), minlength=cells)
    return np.minimum(counts, 255).astype(np.uint8).tobytes()


# -- signing ------------------------------------------------------------------

#: Members of a list row, and entries or pairs of a batch.
CHUNK, LOT = 4096, 1 << 18

SIGNED = ("kind int, part int, doc long, n long, digest binary, cells binary, fine binary, "
          "sigs binary, owners binary, dense boolean")
_SIGNED = [("kind", pa.int32()), ("part", pa.int32()), ("doc", pa.int64()), ("n", pa.int64()),
           ("digest", pa.binary()), ("cells", pa.binary()), ("fine", pa.binary()), ("sigs", pa.binary()),
           ("owners", pa.binary()), ("dense", pa.bool_())]


def _batch(rows: list[tuple], fields: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(cols, fields)],
                                      names=[f for f, _ in fields])


def _part_of(sigs: np.ndarray, parts: int) -> np.ndarray:
    return (((sigs >> _U(32)) * _U(parts)) >> _U(32)).astype(np.int64)


def _runs(sigs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, length) of the runs of two or more in sorted values."""
    if len(sigs) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    starts = np.flatnonzero(np.concatenate([[True], sigs[1:] != sigs[:-1]]))
    lens = np.diff(np.append(starts, len(sigs)))
    many = lens > 1
    return starts[many], lens[many]


def _chunks(members: np.ndarray) -> Iterator[np.ndarray]:
    """Sorted distinct members in lists that all start with the first of them,
    so that each member is paired; one member alone gives none."""
    for at in range(1, len(members), CHUNK - 1):
        yield np.append(members[:1], members[at : at + CHUNK - 1])


def _sign(num: int, den: int, width: int, parts: int, flush: int, dense_from: int):
    """Per document a light row (kind 0); packed signatures by part (kind 1).
    A signature that ``dense_from`` or more sets of a flush share: one entry,
    dealt by the signature, and its members as a list (kind 2), dealt by
    signature and last member."""
    scheme = Scheme(num, den)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        sigs: list[np.ndarray] = []
        docs: list[int] = []
        held = 0

        def packed() -> pa.RecordBatch:
            nonlocal held
            values = np.concatenate(sigs)
            owner = np.repeat(np.array(docs, dtype=np.int64), [len(s) for s in sigs])
            order = np.argsort(values, kind="stable")
            values, owner = values[order], owner[order]
            rows, keep = [], np.ones(len(values), bool)
            thick = np.zeros(len(values), bool)
            for start, n in zip(*_runs(values)):
                if n < dense_from:
                    continue
                members = np.unique(owner[start : start + n])
                sig = values[start : start + 1]
                for chunk in _chunks(members):
                    # lists need not meet: one signature's are spread over all parts
                    spread = mix(sig + mix(chunk[-1:].astype(_U)))
                    rows.append((2, int(_part_of(spread, parts)[0]), None, None, None, None, None, sig.tobytes(),
                                 chunk.tobytes(), True))
                owner[start] = members[0]
                keep[start + 1 : start + n] = False
                thick[start] = True
            values, owner, thick = values[keep], owner[keep], thick[keep]
            part = _part_of(values, parts)
            for dense in (False, True):
                pick = thick == dense
                v, o, p = values[pick], owner[pick], part[pick]
                cuts = np.flatnonzero(np.diff(p)) + 1
                for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(p)]):
                    if b > a:
                        rows.append((1, int(p[a]), None, None, None, None, None, v[a:b].tobytes(), o[a:b].tobytes(),
                                     dense))
            sigs.clear()
            docs.clear()
            seen.clear()
            held = 0
            return _batch(rows, _SIGNED)

        for batch in batches:
            light = []
            for doc, features in zip(batch.column(0).to_pylist(), shingle_sets(batch.column(1), width)):
                n = len(features)
                digest = hashlib.blake2b(features.tobytes(), digest_size=16).digest() if n else None
                light.append((0, hash(doc) % parts if doc is not None else 0, doc, n, digest,
                              histogram(features) if n else None, histogram(features, FINE) if n >= BIG else None,
                              None, None, None))
                if n and doc is not None and digest not in seen:
                    seen.add(digest)
                    sigs.append(signatures(features, scheme))
                    docs.append(doc)
                    held += len(sigs[-1])
                if held >= flush:
                    yield packed()
            yield _batch(light, _SIGNED)
        if docs:
            yield packed()

    return run


# -- buckets ------------------------------------------------------------------

FOUND = ("kind int, doc long, n long, digest binary, cells binary, fine binary, "
         "a long, b long, bucket long, members array<long>")
_FOUND = [("kind", pa.int32()), ("doc", pa.int64()), ("n", pa.int64()), ("digest", pa.binary()),
          ("cells", pa.binary()), ("fine", pa.binary()), ("a", pa.int64()), ("b", pa.int64()), ("bucket", pa.int64()),
          ("members", pa.list_(pa.int64()))]


def _list_key(members: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(members.tobytes(), digest_size=8).digest(), "little", signed=True)


def _found(rows: int, **cols: pa.Array) -> pa.RecordBatch:
    """A batch of FOUND whose other columns are null."""
    return pa.RecordBatch.from_arrays([cols[f] if f in cols else pa.nulls(rows, t) for f, t in _FOUND],
                                      names=[f for f, _ in _FOUND])


def _lists_batch(keys: list[int], lists: list[np.ndarray]) -> pa.RecordBatch:
    offsets = np.concatenate([[0], np.cumsum([len(m) for m in lists])]).astype(np.int32)
    return _found(len(keys), kind=pa.array(np.full(len(keys), 2, np.int32)), bucket=pa.array(keys, pa.int64()),
                  members=pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(lists))))


def _pairs_batches(pairs: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    both = np.unique(np.concatenate(pairs), axis=0)
    for at in range(0, len(both), LOT):
        a, b = both[at : at + LOT].T
        yield _found(len(a), kind=pa.array(np.full(len(a), 1, np.int32)), a=pa.array(a), b=pa.array(b))


class _Out:
    """Pairs (first, other) and rows of member lists, given out when a lot is full."""

    def __init__(self):
        self.pairs: list[np.ndarray] = []
        self.keys: list[int] = []
        self.lists: list[np.ndarray] = []
        self.n_pairs = self.n_listed = 0

    def add(self, members: np.ndarray, key: int | None) -> None:
        """A bucket (sorted distinct members); with a key also its list."""
        self.pairs.append(np.stack([np.full(len(members) - 1, members[0]), members[1:]], axis=1))
        self.n_pairs += len(members) - 1
        if key is not None:
            self.keys.append(key)
            self.lists.append(members)
            self.n_listed += len(members)

    def given(self, at_least: int | None = None) -> Iterator[pa.RecordBatch]:
        at_least = at_least or LOT
        if self.pairs and self.n_pairs >= at_least:
            yield from _pairs_batches(self.pairs)
            self.pairs, self.n_pairs = [], 0
        if self.keys and self.n_listed >= at_least:
            yield _lists_batch(self.keys, self.lists)
            self.keys, self.lists, self.n_listed = [], [], 0


def _collide(dense_from: int, room: int):
    """Light rows pass (kind 0); pairs (smallest, other) of each bucket (kind
    1); member lists of buckets of three or more (kind 2). Rows come in order
    of part. Of a part only the entries are held; dense lists pass as they
    come, wherever they are dealt. Whenever ``room`` entries are held, a
    signature with ``dense_from`` of them or more gives its pairs and its list
    and keeps one entry, a dense one, so what is held grows with the
    signatures of a part, not with a signature's members. Lists of equal
    members are one, but a signature with dense entries keeps its own lists,
    under its value: they meet again by it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sigs: list[np.ndarray] = []
        owners: list[np.ndarray] = []
        dense: list[np.ndarray] = []
        out = _Out()
        now, held, limit = None, 0, room

        def in_order() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            values, owner, thick = np.concatenate(sigs), np.concatenate(owners), np.concatenate(dense)
            for lot in (sigs, owners, dense):
                lot.clear()
            order = np.lexsort((owner, values))
            return values[order], owner[order], thick[order]

        def listed(sig: np.ndarray, members: np.ndarray) -> Iterator[pa.RecordBatch]:
            """A dense signature's members, in rows that share their first."""
            for chunk in _chunks(members):
                out.add(chunk, int(sig.view(np.int64)))
                yield from out.given()

        def thinned() -> Iterator[pa.RecordBatch]:
            nonlocal held, limit
            values, owner, thick = in_order()
            keep = np.ones(len(values), bool)
            starts, lens = _runs(values)
            for start, n in zip(starts[lens >= dense_from], lens[lens >= dense_from]):
                yield from listed(values[start], np.unique(owner[start : start + n]))
                keep[start + 1 : start + n] = False
                thick[start] = True
            sigs.append(values[keep])
            owners.append(owner[keep])
            dense.append(thick[keep])
            held = len(sigs[0])
            limit = max(room, 2 * held)

        def bucketed() -> Iterator[pa.RecordBatch]:
            nonlocal held, limit
            done: set[int] = set()
            if sigs:
                values, owner, thick = in_order()
                for start, n in zip(*_runs(values)):
                    members = owner[start : start + n]
                    if n > 2 or members[0] == members[1]:
                        members = np.unique(members)
                    if len(members) < 2:
                        continue
                    if thick[start : start + n].any() or len(members) > CHUNK:
                        yield from listed(values[start], members)
                        continue
                    key = _list_key(members) if len(members) > 2 else None
                    out.add(members, None if key in done else key)
                    if key is not None:
                        done.add(key)
                    yield from out.given()
            yield from out.given(1)
            held, limit = 0, room

        for batch in batches:
            kinds = batch.column(0).to_numpy()
            light = batch.filter(pa.array(kinds == 0))
            if light.num_rows:
                yield _found(light.num_rows, **{f: light.column(f) for f in
                                                ("kind", "doc", "n", "digest", "cells", "fine")})
            some = batch.filter(pa.array(kinds != 0))
            kinds, parts = some.column(0).to_numpy(), some.column(1).to_numpy()
            packed, own, is_dense = (some.column(f) for f in ("sigs", "owners", "dense"))
            for i in range(some.num_rows):
                sig = np.frombuffer(packed[i].as_py(), dtype=_U)
                members = np.frombuffer(own[i].as_py(), dtype=np.int64)
                if kinds[i] == 2:
                    out.add(members, int(sig.view(np.int64)[0]))
                    yield from out.given()
                    continue
                if parts[i] != now:
                    yield from bucketed()
                    now = parts[i]
                sigs.append(sig)
                owners.append(members)
                dense.append(np.full(len(sig), is_dense[i].as_py()))
                held += len(sig)
                if held >= limit:
                    yield from thinned()
        yield from bucketed()

    return run


# -- verification -------------------------------------------------------------

def verified(pairs: DataFrame, texts: DataFrame, num: int, den: int, width: int,
             portion: int = 256) -> DataFrame:
    """The pairs (u, v) whose texts' sets are linked, as a written table.
    ``texts``: (doc, text)."""
    parts = shuffle_partitions(pairs.sparkSession)
    fans = pairs.groupBy("u").agg(F.ceil(F.count(F.lit(1)) / portion).cast("int").alias("portions"))
    dealt = attach_salted(pairs, fans, ["u"], F.col("v")).select(
        "u", "v", F.pmod(F.xxhash64("v"), F.col("portions")).cast("int").alias("portion"))
    dealt, path = written(dealt, "jaccard-dealt")
    none = F.lit(None).cast("long")
    asked = dealt.select("u", "portion").distinct().select("u", "portion", none.alias("v"), F.col("u").alias("doc"))
    asked = asked.unionByName(dealt.withColumn("doc", F.col("v")))
    told = asked.join(texts, "doc").select("u", "portion", "v", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            out = []
            us, ps, vs = (batch.column(i).to_pylist() for i in range(3))
            for u, p, v, features in zip(us, ps, vs, shingle_sets(batch.column(3), width)):
                if (u, p) != now:
                    now, held = (u, p), []
                if v is None:  # a repeated id brings each of its sets
                    held.append(features)
                elif any(_linked(x, features, num, den) for x in held):
                    out.append((u, v))
            yield _batch(out, [("u", pa.int64()), ("v", pa.int64())])

    meet = told.repartition(parts, "u", "portion").sortWithinPartitions(
        "u", "portion", F.col("v").asc_nulls_first())
    links = materialize(meet.mapInArrow(lean(run), "u long, v long").distinct(), "jaccard-links")
    remove(pairs.sparkSession, path)
    return links


def _linked(x: np.ndarray, y: np.ndarray, num: int, den: int) -> bool:
    if not len(x) or not len(y):
        return False
    at = np.searchsorted(x, y)
    at[at == len(x)] = 0
    common = int((x[at] == y).sum())
    return den * common >= num * (len(x) + len(y) - common)


def _may_link(n: np.ndarray, m: np.ndarray, x: np.ndarray, y: np.ndarray, num: int, den: int) -> np.ndarray:
    """Whether sizes n, m and histograms x, y leave room for a link. A full
    cell may hide more, so it counts for nothing."""
    gap = np.abs(x - y)
    gap[(x == 255) | (y == 255)] = 0
    sizes = (den * np.minimum(n, m) >= num * np.maximum(n, m))
    return sizes & (gap.sum(axis=1, dtype=np.int64) * (den + num) <= (den - num) * (n + m))


def _coarse(cells: np.ndarray) -> np.ndarray:
    """Sums of neighbouring cells; one that holds a full cell says nothing (255)."""
    grouped = cells.reshape(len(cells), -1, COARSE)
    return np.where((grouped == 255).any(axis=2), 255, np.minimum(grouped.sum(axis=2), 255)).astype(np.int16)


def _cells(column, width: int = CELLS) -> np.ndarray:
    return np.frombuffer(b"".join(column), dtype=np.uint8).reshape(-1, width).astype(np.int16)


def plausible(pairs: DataFrame, sized: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (u, v) that sizes and histograms don't rule out. An id with
    several sets has a row in ``sized`` for each; one that leaves room is enough."""
    one, two = (sized.select(F.col("doc").alias(x), F.col("n").alias(f"n{x}"), F.col("cells").alias(f"c{x}"),
                             F.col("fine").alias(f"f{x}")) for x in ("u", "v"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            u, v, nu, nv = (batch.column(i).to_numpy() for i in range(4))
            cu, cv, fu, fv = (batch.column(i).to_pylist() for i in range(4, 8))
            keep = _may_link(nu, nv, _cells(cu), _cells(cv), num, den)
            big = np.flatnonzero(keep & np.array([a is not None and b is not None for a, b in zip(fu, fv)]))
            for at in range(0, len(big), 1024):
                some = big[at : at + 1024]
                keep[some] = _may_link(nu[some], nv[some], _cells((fu[i] for i in some), FINE),
                                       _cells((fv[i] for i in some), FINE), num, den)
            yield pa.RecordBatch.from_arrays([pa.array(u[keep]), pa.array(v[keep])], names=["u", "v"])

    both = pairs.join(one, "u").join(two, "v").select("u", "v", "nu", "nv", "cu", "cv", "fu", "fv")
    return both.mapInArrow(lean(run), "u long, v long").distinct()


def _across(num: int, den: int):
    """Pairs across components in the rows (bucket, i, j, side, doc, comp, n,
    cells, fine) of a block pair that size and histograms don't rule out."""

    def pairs_of(rows: list[tuple]) -> list[np.ndarray]:
        side, doc, comp, n = (np.array([r[i] for r in rows], dtype=np.int64) for i in (3, 4, 5, 6))
        cells = _cells(r[7] for r in rows)
        diagonal = rows[0][1] == rows[0][2]
        left = np.arange(len(rows)) if diagonal else np.flatnonzero(side == 0)
        right = left if diagonal else np.flatnonzero(side == 1)
        right = right[np.argsort(n[right], kind="stable")]
        sizes, rough, found = n[right], _coarse(cells), []
        has_fine = np.array([r[8] is not None for r in rows])
        place = np.cumsum(has_fine) - 1
        fine = _cells((r[8] for r in rows if r[8] is not None), FINE)
        for i in left:
            lo = np.searchsorted(sizes, -(-n[i] * num // den), side="left")
            hi = np.searchsorted(sizes, n[i] * den // num, side="right")
            other = right[lo:hi]
            other = other[comp[other] != comp[i]]
            if diagonal:
                other = other[doc[other] > doc[i]]
            if not len(other):
                continue
            for level in (rough, cells):
                if len(other):
                    other = other[_may_link(n[other], n[i], level[other], level[i][None, :], num, den)]
            if len(other) and has_fine[i]:
                keep = np.ones(len(other), bool)
                big = np.flatnonzero(has_fine[other])
                keep[big] = _may_link(n[other[big]], n[i], fine[place[other[big]]], fine[place[i]][None, :], num, den)
                other = other[keep]
            if len(other):
                found.append(np.stack([np.minimum(doc[i], doc[other]), np.maximum(doc[i], doc[other])], axis=1))
        return found

    def batch_of(found: list[np.ndarray]) -> pa.RecordBatch:
        pairs = np.unique(np.concatenate(found), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows, found = None, [], []
        for batch in batches:
            for row in zip(*[batch.column(i).to_pylist() for i in range(batch.num_columns)]):
                if row[:3] != now:
                    found += pairs_of(rows) if rows else []
                    if sum(map(len, found)) >= 1_000_000:
                        found = [np.unique(np.concatenate(found), axis=0)]
                        if len(found[0]) >= 500_000:
                            yield batch_of(found)
                            found = []
                    now, rows = row[:3], []
                rows.append(row)
        found += pairs_of(rows) if rows else []
        if found:
            yield batch_of(found)

    return run


def dealt_by_work(open_: DataFrame, block: int, blocks_per_task: int = 4) -> DataFrame:
    """Open buckets (bucket, c0, m members) with their number of ``blocks`` and
    ``near``, the task of their group (smallest component c0). Buckets of one
    group meet in few tasks, where a pair that many of them hold is made once,
    but in as many as their work takes: ``blocks_per_task`` full blocks each, by
    comparisons or, where buckets are small, by rows."""
    size = F.least(F.col("m"), F.lit(block)).cast("double")
    work = open_.groupBy("c0").agg(F.ceil(F.greatest(
        F.sum(size * size) / (float(block) * block), F.sum(size) / float(block)) / blocks_per_task).cast("int").alias("tasks"))
    return attach_salted(open_, work, ["c0"], F.col("bucket")).select(
        "bucket", "c0", F.ceil(F.col("m") / block).cast("int").alias("blocks"),
        F.pmod(F.xxhash64("bucket"), F.col("tasks")).cast("int").alias("near"))


# -- the join -----------------------------------------------------------------

def jaccard_components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", num: int = 75,
                       den: int = 100, width: int = 5, flush: int = 500_000, dense_from: int = 64,
                       block: int = 2048, room: int = 1_000_000) -> DataFrame:
    """One row per input row: id, n_shingles, component_id (the smallest id
    that links lead to). Tables in between go as soon as nothing reads them."""
    spark = df.sparkSession
    folders: dict[str, str] = {}

    def table(frame: DataFrame, name: str) -> DataFrame:
        out, folders[name] = written(frame, f"jaccard-{name}")
        return out

    def drop(*names: str) -> None:
        for name in names:
            remove(spark, folders.pop(name))

    p = shuffle_partitions(spark)
    rows = df.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    signed = rows.mapInArrow(lean(_sign(num, den, width, 4 * p, flush, dense_from)), SIGNED)
    found = table(signed.repartition(p, "part").sortWithinPartitions("part").mapInArrow(
        lean(_collide(dense_from, room)), FOUND), "found")
    light = found.where("kind = 0").select("doc", "n", "digest", "cells", "fine")

    # classes of equal sets: every member but the first points at it; an id with
    # several sets stays itself and is linked to the first of each one's class
    filled = light.where("n > 0 and doc is not null")
    classes = filled.groupBy("digest").agg(F.min("doc").alias("rep"), F.count(F.lit(1)).alias("size")).where("size > 1")
    classes = table(classes, "classes")
    sets = filled.select("doc", "digest")
    by_doc = attach_salted(sets, classes, ["digest"], F.col("doc")).groupBy("doc").agg(
        (F.min("digest") != F.max("digest")).alias("several"), F.min("rep").alias("rep"))
    by_doc = materialize(by_doc.where("several or rep <> doc"), "jaccard-same")
    same = by_doc.where("not several").select("doc", "rep")
    own = attach_salted(sets.join(by_doc.where("several"), "doc", "left_semi"), classes, ["digest"], F.col("doc"))
    own = materialize(own.where("rep <> doc").select(F.col("doc").alias("u"), F.col("rep").alias("v")), "jaccard-own")

    def to_rep(frame: DataFrame, col: str) -> DataFrame:
        named = same.select(F.col("doc").alias(col), F.col("rep").alias("_rep"))
        return frame.join(named, col, "left").withColumn(col, F.coalesce("_rep", col)).drop("_rep")

    pairs = to_rep(to_rep(found.where("kind = 1").select("a", "b"), "a"), "b")
    pairs = table(pairs.where("a <> b").select(
        F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct(), "pairs")
    lists = found.where("kind = 2").select("bucket", F.explode("members").alias("doc"))
    lists = table(to_rep(lists, "doc").distinct(), "lists")
    wanted = pairs.select(F.col("u").alias("doc")).union(pairs.select("v")).distinct()
    texts = table(rows.join(wanted, "doc", "left_semi"), "texts")
    sized = table(filled.join(wanted, "doc", "left_semi").dropDuplicates(["doc", "digest"]).drop(
        "digest"), "sizes")
    light = materialize(light.select("doc", "n"), "jaccard-docs")
    drop("found", "classes")

    def linked_among(some: DataFrame) -> DataFrame:
        links = verified(table(plausible(some, sized, num, den), "plausible"), texts, num, den, width)
        drop("plausible")
        return links

    # every document against its smallest candidate first: of a group of near
    # copies that leaves few pairs across components
    first = table(pairs.groupBy("v").agg(F.min("u").alias("u")).select("u", "v"), "first")
    links = linked_among(first).union(own)
    comps = materialize(connected_components(links), "jaccard-components")
    rest = pairs.join(first, ["u", "v"], "left_anti")
    for end in ("u", "v"):
        named = comps.select(F.col("node").alias(end), F.col("component").alias(f"c_{end}"))
        rest = rest.join(named, end, "left").withColumn(f"c_{end}", F.coalesce(f"c_{end}", end))
    more = linked_among(rest.where("c_u <> c_v").select("u", "v"))
    drop("first")
    if not more.isEmpty():
        links = links.union(more)
        comps = materialize(connected_components(links), "jaccard-components")

    # buckets that still hold several components: all their pairs that may link
    lists = lists.join(comps.withColumnRenamed("node", "doc"), "doc", "left").withColumn(
        "comp", F.coalesce("component", "doc")).drop("component")
    open_ = lists.groupBy("bucket").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1"),
                                        F.count(F.lit(1)).alias("m")).where("c0 <> c1")
    open_ = dealt_by_work(table(open_, "open"), block)
    held = attach_salted(lists, open_, ["bucket"], F.col("doc")).where("blocks is not null")
    held = held.join(sized, "doc").withColumn("mine", F.pmod(F.xxhash64("doc"), F.col("blocks")).cast("int"))
    held = held.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    held = held.select(
        "c0", "near", "bucket", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"),
        (F.col("mine") > F.col("other")).cast("int").alias("side"), "doc", "comp", "n", "cells", "fine")
    dealt = held.repartition(p, "c0", "near", "i", "j").drop("c0", "near")
    more = dealt.sortWithinPartitions("bucket", "i", "j").mapInArrow(
        lean(_across(num, den)), "u long, v long").distinct()
    more = table(more.join(pairs, ["u", "v"], "left_anti"), "more")
    drop("pairs", "lists", "open", "sizes")
    if not more.isEmpty():
        links = links.union(verified(more, texts, num, den, width))
        comps = materialize(connected_components(links), "jaccard-components")
    drop("more", "texts")

    ends = light.join(same, "doc", "left").withColumn("rep", F.coalesce("rep", "doc"))
    ends = ends.join(comps.select(F.col("node").alias("rep"), "component"), "rep", "left")
    return ends.select(F.col("doc").alias(id_col), F.col("n").alias("n_shingles"),
                       F.coalesce("component", "rep").alias("component_id"))
