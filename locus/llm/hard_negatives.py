"""Hard-negative mining with exact integer scores by residue number systems.

Vectors are quantised to integers. A tile of scores (anchors x rows) is one
float32 matrix product per small prime: components are taken modulo the prime,
centred, and a product over at most ``2**24 / (p/2)**2`` dimensions is exact in
float32. Chinese remaindering (mixed radix digits) gives the signed integer
score, with as many primes as the largest possible score needs.

The anchors meet all rows in blocks. Anchors are dealt to groups of bounded
bytes and rows to ``spread`` slices by their row number, so neither a hot label
nor a repeated id makes a hot task; a cell is one group against one slice. In
a cell's task the group is held and the slice streams past it, and per slot
only the best candidates so far are kept, so memory does not grow with the
data. Two passes: the positives of each anchor (only rows of its label are
multiplied), then for each positive the negatives inside its score window.

Defined results: rows with a null id, a null label, a null vector or a null,
NaN or infinite component take no part. Vectors of unequal lengths are filled
up with zeros; an empty vector scores 0 with all. Repeats of an anchor row (id,
label and vector alike) are one anchor, and rows alike in id, label and score
are one candidate. Rows with the anchor's own id are not its positives. Ties go
to the smaller id. A positive with a negative score has an empty window. An
anchor without positives, and an empty table, give no rows. Scores that may
leave 64 bits raise OverflowError. Other columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from locus.llm.common import materialize, shuffle_partitions
from locus.llm.vectors import as_doubles, is_finite, matrix

_CELL = "g int, c int, side int, key long, id long, label long, vec array<double>, pos array<long>, top array<long>"
_FOUND = "key long, id long, pos long, top long, other long, score long"
#: Anchors and rows of one tile.
_TILE_A, _TILE_B = 256, 2048


def primes_below(limit: int) -> list[int]:
    return [p for p in range(limit - 1, 2, -1) if all(p % q for q in range(2, math.isqrt(p) + 1))]


def residue_base(bound: int) -> list[int]:
    """The primes whose product exceeds all scores of size ``bound``, signs included."""
    base, product = [], 1
    for p in primes_below(256):
        if product > 2 * bound:
            break
        base.append(p)
        product *= p
    if product <= 2 * bound or product >= 2**62:
        raise OverflowError(f"scores of up to {bound} leave 64 bits")
    return base


def residues(ints: np.ndarray, base: list[int]) -> list[np.ndarray]:
    """Centred residues, one float32 matrix a prime (``ints``: whole doubles)."""
    out = []
    for p in base:
        r = np.fmod(ints, p)
        out.append((r - p * np.rint(r / p)).astype(np.float32))
    return out


def residue_scores(a: list[np.ndarray], b: list[np.ndarray], base: list[int]) -> np.ndarray:
    """Exact inner products of all rows of ``a`` with all rows of ``b``."""
    total, radix, done = None, 1, []
    for i, p in enumerate(base):
        step = (2**24 - 1) // (p // 2) ** 2
        r = np.zeros((len(a[i]), len(b[i])), dtype=np.int64)
        for d in range(0, a[i].shape[1], step):
            r += np.rint(a[i][:, d : d + step] @ b[i][:, d : d + step].T).astype(np.int64)
        r %= p
        if total is None:
            total = r
        else:  # the next mixed radix digit
            total = total + radix * ((r - total) * pow(radix, -1, p) % p)
        done.append(p)
        radix *= p
    return np.where(total > radix // 2, total - radix, total)


class _Best:
    """Per slot the ``k`` best (score, other) seen: higher scores, then smaller ids."""

    def __init__(self, slots: int, k: int, low: np.ndarray):
        self.k, self.least = k, low.copy()
        self.slot, self.score, self.other = (np.zeros(0, dtype=np.int64) for _ in range(3))
        self.slots = slots

    def offer(self, slot: np.ndarray, score: np.ndarray, other: np.ndarray) -> None:
        if not len(slot):
            return
        slot, score, other = (np.concatenate(x) for x in (
            (self.slot, slot), (self.score, score), (self.other, other)))
        order = np.lexsort((other, -score, slot))
        slot, score, other = slot[order], score[order], other[order]
        new = np.ones(len(slot), bool)
        new[1:] = (slot[1:] != slot[:-1]) | (score[1:] != score[:-1]) | (other[1:] != other[:-1])
        slot, score, other = slot[new], score[new], other[new]
        first = np.searchsorted(slot, slot)  # where the slot's run starts
        rank = np.arange(len(slot)) - first
        stay = rank < self.k
        last = rank == self.k - 1  # a full slot takes nothing below its last
        self.least[slot[last]] = np.maximum(self.least[slot[last]], score[last])
        self.slot, self.score, self.other = slot[stay], score[stay], other[stay]


class _Cell:
    """One group of anchors, the rows of a slice streaming past."""

    def __init__(self, anchors: pa.RecordBatch, width: int, base: list[int], scale: float,
                 windows: tuple[int, int] | None, k: int):
        self.base, self.width, self.scale, self.windows = base, width, scale, windows
        order = np.argsort(anchors["label"].to_numpy(), kind="stable")
        anchors = anchors.take(pa.array(order))
        self.key, self.id, self.label = (anchors[c].to_numpy() for c in ("key", "id", "label"))
        self.vec = residues(np.floor(matrix(anchors["vec"], width) * scale), base)
        if windows is None:  # one slot an anchor
            self.anchor = np.arange(len(self.key))
            self.pos = self.top = np.zeros(len(self.key), dtype=np.int64)
            low, self.high = np.full(len(self.key), -(2**62)), np.full(len(self.key), 2**62)
        else:  # one slot a positive
            ends = np.asarray(anchors["pos"].offsets, dtype=np.int64)
            self.anchor = np.repeat(np.arange(len(self.key)), np.diff(ends))
            self.pos = np.asarray(anchors["pos"].flatten(), dtype=np.int64)
            self.top = np.asarray(anchors["top"].flatten(), dtype=np.int64)
            low, self.high = -(-windows[0] * self.top // 100), windows[1] * self.top // 100
        self.best = _Best(len(self.anchor), k, low)

    def rows(self, batch: pa.RecordBatch) -> None:
        label, ids = batch["label"].to_numpy(), batch["id"].to_numpy()
        vec = residues(np.floor(matrix(batch["vec"], self.width) * self.scale), self.base)
        if self.windows is not None:
            self._blocks(0, len(self.key), label, ids, vec, np.arange(len(ids)))
            return
        order = np.argsort(label, kind="stable")
        values, begins = np.unique(label[order], return_index=True)
        for value, part in zip(values, np.split(order, begins[1:])):
            a, b = np.searchsorted(self.label, value), np.searchsorted(self.label, value, side="right")
            self._blocks(int(a), int(b), label, ids, vec, part)

    def _blocks(self, first: int, last: int, label, ids, vec, which) -> None:
        for a in range(first, last, _TILE_A):
            b = min(a + _TILE_A, last)
            s0, s1 = np.searchsorted(self.anchor, a), np.searchsorted(self.anchor, b)
            if s0 == s1:
                continue
            left = [v[a:b] for v in self.vec]
            for i in range(0, len(which), _TILE_B):
                part = which[i : i + _TILE_B]
                scores = residue_scores(left, [v[part] for v in vec], self.base)
                self._select(slice(s0, s1), a, scores, label[part], ids[part])

    def _select(self, slots: slice, a: int, scores, label, ids) -> None:
        anchor = self.anchor[slots]
        own = scores[anchor - a]
        fit = (own >= self.best.least[slots][:, None]) & (own <= self.high[slots][:, None])
        if self.windows is None:
            fit &= ids[None, :] != self.id[anchor][:, None]
        else:
            fit &= label[None, :] != self.label[anchor][:, None]
        s, r = np.nonzero(fit)
        self.best.offer(s + slots.start, own[s, r], ids[r])

    def result(self) -> pa.RecordBatch:
        b = self.best
        anchor = self.anchor[b.slot]
        columns = (self.key[anchor], self.id[anchor], self.pos[b.slot], self.top[b.slot], b.other, b.score)
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns],
                                          names=["key", "id", "pos", "top", "other", "score"])


def _search(width: int, base: list[int], scale: float, windows, k: int):
    """Cells arrive one after the other, the anchors of each before its rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, held, cell = None, [], None
        for batch in batches:
            g, c, side = (batch[n].to_numpy() for n in ("g", "c", "side"))
            cuts = np.flatnonzero((g[1:] != g[:-1]) | (c[1:] != c[:-1]) | (side[1:] != side[:-1])) + 1
            edges = [0, *cuts.tolist(), len(g)] if len(g) else []
            for a, b in zip(edges[:-1], edges[1:]):
                part = batch.slice(a, b - a)
                if (g[a], c[a]) != place:
                    if cell is not None:
                        yield cell.result()
                    place, held, cell = (g[a], c[a]), [], None
                if side[a] == 0:
                    held.append(part)
                    continue
                if cell is None:
                    if not held:
                        continue  # no anchor in this group
                    anchors = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                    held, cell = [], _Cell(anchors, width, base, scale, windows, k)
                cell.rows(part)
        if cell is not None:
            yield cell.result()

    return run


def _ranked(found: DataFrame, by: list[str], k: int) -> DataFrame:
    w = Window.partitionBy(*by).orderBy(F.col("score").desc(), F.col("other").asc())
    return found.dropDuplicates([*by, "other", "score"]).withColumn("rank", F.row_number().over(w)).where(
        F.col("rank") <= k)


def mine_hard_negatives(
    df: DataFrame,
    id_col: str = "vec_id",
    label_col: str = "label",
    vector_col: str = "embedding",
    label: Column | None = None,
    scale: int = 256,
    anchor_every: int = 100,
    n_positives: int = 5,
    n_negatives: int = 10,
    window: tuple[int, int] = (30, 90),
    group_bytes: int = 16_000_000,
    slice_rows: int = 1 << 24,
    least_rows: int = 4096,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are rows whose id divides by ``anchor_every``; their positives the
    first ``n_positives`` other rows of their label; negatives the first
    ``n_negatives`` rows of another label whose score is between ``window``
    percent of the positive's. ``label`` may replace the label column by an
    expression (an integer)."""
    spark = df.sparkSession
    label = F.col(f"`{label_col}`") if label is None else label
    kept = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), label.cast("long").alias("label"),
                     as_doubles(vector_col).alias("vec"))
    kept = kept.where(F.col("id").isNotNull() & F.col("label").isNotNull() & is_finite(F.col("vec")))
    rows = materialize(kept.withColumn("key", F.monotonically_increasing_id()), "vectors")
    is_anchor = F.col("id") % F.lit(anchor_every) == 0
    anchors = materialize(rows.where(is_anchor).dropDuplicates(["id", "label", "vec"]), "anchors")

    size = F.aggregate("vec", F.lit(0.0), lambda t, x: t + (F.abs(x) * F.lit(float(scale)) + 1) ** 2)
    n, width, most = rows.agg(F.count(F.lit(1)), F.max(F.size("vec")), F.max(size)).first()
    n_anchors = anchors.count()
    width = width or 0
    base = residue_base(math.ceil((most or 1.0) * 1.000001))
    groups = max(1, math.ceil(n_anchors * max(width, 1) * 8 / group_bytes))
    tasks = shuffle_partitions(spark)
    # slices for every task, but none of a few rows: each gives candidates of its own
    spread = max(1, min(math.ceil(tasks / groups), math.ceil(n / least_rows)), math.ceil(n / slice_rows))
    nothing = F.lit(None).cast("array<long>")
    slices = rows.select(
        F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("g"),
        F.pmod(F.xxhash64("key"), F.lit(spread)).cast("int").alias("c"), F.lit(1).alias("side"),
        "key", "id", "label", "vec", nothing.alias("pos"), nothing.alias("top"))

    def pass_over(some: DataFrame, windows, k: int) -> DataFrame:
        held = some.select(
            F.pmod(F.xxhash64("key"), F.lit(groups)).cast("int").alias("g"),
            F.explode(F.sequence(F.lit(0), F.lit(spread - 1))).alias("c"), F.lit(0).alias("side"),
            "key", "id", "label", "vec", "pos", "top")
        cells = held.unionByName(slices).repartition(tasks, "g", "c").sortWithinPartitions("g", "c", "side")
        return cells.mapInArrow(_search(width, base, float(scale), windows, k), _FOUND)

    near = _ranked(pass_over(anchors.withColumn("pos", nothing).withColumn("top", nothing), None, n_positives),
                   ["key"], n_positives)
    lists = near.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("rank", "other", "score"))).alias("near"))
    slots = materialize(anchors.join(lists, "key").withColumn("pos", F.col("near.other")).withColumn(
        "top", F.col("near.score")).drop("near"), "positives")
    found = _ranked(pass_over(slots, window, n_negatives), ["key", "pos", "top"], n_negatives)
    return found.select(
        F.col("id").alias("anchor_id"), F.col("pos").alias("positive_id"), "rank",
        F.col("other").alias("negative_id"), F.col("top").alias("positive_score"),
        F.col("score").alias("negative_score"))
