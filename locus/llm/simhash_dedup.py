"""SimHash near-duplicates, fingerprints compared bit-sliced.

A document's fingerprint has a bit set where over half of its 3-word shingles'
hashes (repeats included) have it. Equal fingerprints become one node first.
Two nodes within ``radius`` bits agree on at least ``cuts - radius`` of
``cuts`` equal cuts of the fingerprint, so every pair meets under one of the
tables (choices of that many cuts): no link is lost. A bucket with more than
``block`` members is dealt to sub-blocks by a hash and every pair of
sub-blocks is a group of its own, so no task holds a whole bucket.

Inside a task groups are compared by bit planes: plane ``b`` holds bit ``b`` of
64 members a word, and a query's xor with it tells for 64 pairs at once whether
they differ there. Carry-save counters of bit width enough for the radius, and
an overflow plane, add these up; words whose 64 pairs all exceed the radius are
abandoned on the way. Small groups are joined to one comparison, which finds
true links only. A group gives a spanning forest of its links, not the pairs.

Defined results: a null, empty or white text has fingerprint zero and links
like any other; a text with fewer words than a shingle is one shingle. Links
are between texts: rows that repeat an id with other texts are not linked by
the id. A null id is smaller than none: the component of rows linked with null
ids only is null. An empty table gives an empty result. Other columns are not
looked at.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locus.llm.common import attach_salted, materialize, shuffle_partitions
from locus.llm.components import connected_components

BITS = 64
_ONES = np.uint64(2**64 - 1)
#: Hashes whose bits are counted at once; queries and planes compared at once.
_COUNTED, _QUERIES = 1 << 14, 1024


def shingle_hashes(text: str | None, width: int, seed: int) -> np.ndarray:
    """XXH64 of every shingle of the A-Z lower-cased words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    joined = b" ".join(words)
    if len(words) <= width:
        return np.array([xxhash.xxh64_intdigest(joined, seed)] if words else [], dtype=np.uint64)
    ends = np.cumsum([len(w) + 1 for w in words]).tolist()
    starts, digest = [0, *ends[:-1]], xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[a : b - 1], seed) for a, b in zip(starts, ends[width - 1 :])),
                       dtype=np.uint64, count=len(words) - width + 1)


def fingerprint(hashes: np.ndarray) -> int:
    """Bits that over half of the hashes have."""
    counts = np.zeros(BITS, dtype=np.int64)
    for i in range(0, len(hashes), _COUNTED):
        part = hashes[i : i + _COUNTED].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def _fingerprints(width: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(shingle_hashes(t.as_py(), width, seed)) for t in batch["text"]]
            yield pa.RecordBatch.from_arrays(
                [batch["id"], pa.array(np.array(prints, dtype=np.uint64).view(np.int64))], names=["id", "fp"])

    return run


class BitPlanes:
    """Members' fingerprints stored vertically: a row of words per bit."""

    def __init__(self, members: np.ndarray):
        self.size = len(members)
        bits = np.unpackbits(members.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        padded = np.zeros((-(-self.size // 64) * 64, BITS), dtype=np.uint8)
        padded[: self.size] = bits
        self.planes = np.ascontiguousarray(np.packbits(padded.T, axis=1, bitorder="little")).view("<u8")
        filled = np.zeros(len(padded), dtype=np.uint8)
        filled[: self.size] = 1
        self.empty = ~np.packbits(filled, bitorder="little").view("<u8")

    def within(self, queries: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, member) index pairs that differ in at most ``radius`` bits."""
        found = [self._within(queries[i : i + _QUERIES], radius, i) for i in range(0, len(queries), _QUERIES)]
        return tuple(np.concatenate(x) for x in zip(*found))

    def _within(self, queries: np.ndarray, radius: int, first: int) -> tuple[np.ndarray, np.ndarray]:
        words = len(self.empty)
        query = np.repeat(np.arange(len(queries)), words)
        word = np.tile(np.arange(words), len(queries))
        over = self.empty[word]  # lanes beyond the radius, places without a member
        counters = [np.zeros(len(word), dtype=np.uint64) for _ in range(radius.bit_length())]
        for bit in range(BITS):
            asked = np.where((queries >> np.uint64(bit)) & np.uint64(1), _ONES, np.uint64(0))
            carry = self.planes[bit][word] ^ asked[query]
            for k, counter in enumerate(counters):  # carry-save addition of one bit
                counters[k], carry = counter ^ carry, counter & carry
            over = over | carry
            if bit % 8 == 7:  # abandon words whose lanes all exceed
                live = self._beyond(counters, over, radius) != _ONES
                if not live.all():
                    query, word, over = query[live], word[live], over[live]
                    counters = [c[live] for c in counters]
        close = ~self._beyond(counters, over, radius)
        lanes = np.unpackbits(close.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        cell, lane = np.nonzero(lanes)
        return query[cell] + first, word[cell] * 64 + lane

    @staticmethod
    def _beyond(counters: list[np.ndarray], over: np.ndarray, radius: int) -> np.ndarray:
        """Lanes whose count exceeds the radius: overflowed, or greater by its bits."""
        greater, equal = np.zeros_like(over), np.full_like(over, _ONES)
        for k in reversed(range(len(counters))):
            if radius >> k & 1:
                equal = equal & counters[k]
            else:
                greater = greater | (equal & counters[k])
                equal = equal & ~counters[k]
        return over | greater


def _forest(a: np.ndarray, b: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """A star per component of the links a-b of ``size`` members: (member, its lowest)."""
    low = np.arange(size)
    while True:
        before = low.copy()
        np.minimum.at(low, a, low[b])
        np.minimum.at(low, b, low[a])
        low = low[low]
        if (low == before).all():
            break
    member = np.flatnonzero(low != np.arange(size))
    return member, low[member]


def _compare(radius: int, together: int):
    """Rows come by group; a group's members of side 1 are asked of side 0 (of
    themselves, when the group has no side 1)."""

    def links(left: np.ndarray, right: np.ndarray | None) -> Iterator[pa.RecordBatch]:
        if right is None or not len(right):
            nodes = np.unique(left)
            q, m = BitPlanes(nodes).within(nodes, radius)
        elif not len(left):
            return
        else:
            nodes = np.concatenate([left, right])
            q, m = BitPlanes(left).within(right, radius)
            q = q + len(left)
        member, root = _forest(q, m, len(nodes))
        if len(member):
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes[member].view(np.int64)), pa.array(nodes[root].view(np.int64))], names=["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []  # whole small groups, compared as one
        count = 0
        group, sides = None, ([], [])

        def end_of_group() -> Iterator[pa.RecordBatch]:
            nonlocal held, count
            left, right = (np.concatenate(s) if s else np.zeros(0, dtype=np.uint64) for s in sides)
            if len(right) or len(left) > together:
                yield from links(left, right)
                return
            held.append(left)
            count += len(left)
            if count > together:
                yield from links(np.concatenate(held), None)
                held, count = [], 0

        for batch in batches:
            keys = [batch[c].to_numpy() for c in ("t", "key", "i", "j")]
            side, fp = batch["side"].to_numpy(), batch["fp"].to_numpy().view(np.uint64)
            changes = np.zeros(max(len(fp) - 1, 0), bool)
            for k in (*keys, side):
                changes |= k[1:] != k[:-1]
            edges = [0, *(np.flatnonzero(changes) + 1).tolist(), len(fp)] if len(fp) else []
            for a, b in zip(edges[:-1], edges[1:]):
                name = tuple(k[a] for k in keys)
                if name != group:
                    if group is not None:
                        yield from end_of_group()
                    group, sides = name, ([], [])
                sides[side[a]].append(fp[a:b])
        if group is not None:
            yield from end_of_group()
        if held:
            yield from links(np.concatenate(held), None)

    return run


def _tables(radius: int, cuts: int) -> list[int]:
    """Masks of the bits that two nodes within the radius agree on in one table at least."""
    edge = [round(BITS * i / cuts) for i in range(cuts + 1)]
    masks = [(1 << b) - (1 << a) for a, b in zip(edge[:-1], edge[1:])]
    signed = [sum(c) for c in itertools.combinations(masks, cuts - radius)]
    return [m - 2**64 if m >= 2**63 else m for m in signed]


def fingerprint_links(nodes: DataFrame, radius: int = 3, cuts: int = 5, block: int = 2048) -> DataFrame:
    """(u, v): links that connect what is within ``radius`` bits. ``nodes``: fp, distinct, written."""
    tables = F.array(*[F.struct(F.lit(t).alias("t"), F.lit(m).alias("mask"))
                       for t, m in enumerate(_tables(radius, cuts))])
    keyed = nodes.select("fp", F.explode(tables).alias("m")).select(
        "fp", "m.t", F.col("fp").bitwiseAND(F.col("m.mask")).alias("key"))
    sizes = keyed.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(
        "t", "key", F.ceil(F.col("n") / F.lit(block)).cast("int").alias("blocks"))
    members = attach_salted(keyed, sizes, ["t", "key"], F.col("fp")).where("blocks is not null").withColumn(
        "own", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    pairs = members.select("t", "key", "fp", "own", other).select(
        "t", "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
        (F.col("own") > F.col("other")).cast("int").alias("side"), "fp")
    dealt = pairs.repartition(shuffle_partitions(nodes.sparkSession), "t", "key", "i", "j").sortWithinPartitions(
        "t", "key", "i", "j", "side")
    return dealt.mapInArrow(_compare(radius, block), "u long, v long")


def simhash_components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3,
                       seed: int = 42, radius: int = 3, cuts: int = 5, block: int = 2048,
                       salts: int = 16) -> DataFrame:
    """One row per input row: id, fingerprint (16 hex digits), component_id
    (smallest id reachable by links of at most ``radius`` differing bits)."""
    docs = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")).mapInArrow(
        _fingerprints(width, seed), f"id {df.schema[id_col].dataType.simpleString()}, fp long")
    docs = materialize(docs, "fingerprints")
    nodes = materialize(docs.groupBy("fp").agg(F.min("id").alias("id")), "nodes")
    parts = connected_components(fingerprint_links(nodes.select("fp"), radius, cuts, block))
    labelled = nodes.join(parts.select(F.col("node").alias("fp"), "component"), "fp", "left").select(
        "fp", "id", F.coalesce("component", "fp").alias("component"))
    lows = labelled.groupBy("component").agg(F.min("id").alias("component_id"))
    named = attach_salted(labelled, lows, ["component"], F.col("fp"), salts).select("fp", "component_id")
    return attach_salted(docs, named, ["fp"], F.struct("id"), salts).select(
        F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
