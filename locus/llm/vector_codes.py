"""Vector compression by product codes, with equal-average search.

Vectors are quantised to integers and cut into equal parts. Every part
position has a codebook; a part's code is its nearest entry. The search sorts a
codebook by component sum: by Cauchy-Schwarz the squared distance of two parts
is at least the squared gap of their sums over the dimension. From a part's own
sum the search expands outward on both sides and a side ends when that bound
strictly exceeds the best distance so far, so entries at equal distance are
still seen and the lower index wins.

Each round every task assigns its parts and emits one row per used (part,
entry) with component sums and a count; Spark adds them up, and only the
codebooks (parts x entries x components) come to the driver and go out again
with the next round's tasks. Rounds run on a written table.

Defined results: rows with a null vector or a null, NaN or infinite component
are dropped; null ids and null labels stay (a null id comes last when the first
codebooks are chosen, null labels are one label). Rows that repeat an id count
each; ties among the first rows go by id and then by vector. Vectors of unequal
lengths are filled up with zeros to the longest, and further to a multiple of
the number of parts; vectors without components have code 00.. and error 0.
With fewer rows than entries the codebooks have as many entries as rows. An
empty table gives an empty result. Distances that may leave 64 bits raise
OverflowError. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locus.llm.common import attach_salted, materialize
from locus.llm.vectors import as_doubles, is_finite, matrix

#: Entries looked at per side and step of the outward search.
_STEP = 4
_LARGEST = np.iinfo(np.int64).max


class EqualAverageIndex:
    """A codebook (entries x components, integers) ordered by component sum."""

    def __init__(self, entries: np.ndarray):
        sums = entries.sum(axis=1)
        self.order = np.argsort(sums, kind="stable")
        self.sums, self.entries = sums[self.order], entries[self.order]
        self.dim = entries.shape[1]

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index, squared distance) of every part's nearest entry, ties to the lower index."""
        n = len(parts)
        best = np.full(n, _LARGEST)
        code = np.zeros(n, dtype=np.int64)
        if self.dim == 0:
            return code, np.zeros(n, dtype=np.int64)
        sums = parts.sum(axis=1)
        start = np.searchsorted(self.sums, sums)
        sides = {1: (np.arange(n), start), -1: (np.arange(n), start - 1)}
        while any(len(rows) for rows, _ in sides.values()):
            for direction, (rows, at) in sides.items():
                open_ = (at >= 0) & (at < len(self.sums))
                rows, at = rows[open_], at[open_]
                gap = self.sums[at] - sums[rows]
                open_ = gap * gap <= self._reach(best[rows])
                rows, at = rows[open_], at[open_]
                for _ in range(_STEP):  # entries past the bound may be looked at: they cannot win
                    inside = (at >= 0) & (at < len(self.sums))
                    self._offer(parts, rows[inside], at[inside], best, code)
                    at = at + direction
                sides[direction] = rows, at
        return code, best

    def _offer(self, parts: np.ndarray, rows: np.ndarray, at: np.ndarray, best: np.ndarray, code: np.ndarray) -> None:
        diff = parts[rows] - self.entries[at]
        dist = np.einsum("ij,ij->i", diff, diff)
        index = self.order[at]
        better = (dist < best[rows]) | ((dist == best[rows]) & (index < code[rows]))
        best[rows[better]], code[rows[better]] = dist[better], index[better]

    def _reach(self, best: np.ndarray) -> np.ndarray:
        """The largest squared sum gap that may still win: best x dimension."""
        return np.where(best > _LARGEST // self.dim, _LARGEST, np.minimum(best, _LARGEST // self.dim) * self.dim)


def _assign(ints: np.ndarray, indexes: list[EqualAverageIndex]) -> tuple[np.ndarray, np.ndarray]:
    """Codes and squared distances, rows x parts."""
    dim = indexes[0].dim
    found = [index.nearest(ints[:, p * dim : (p + 1) * dim]) for p, index in enumerate(indexes)]
    return np.stack([c for c, _ in found], axis=1), np.stack([d for _, d in found], axis=1)


def _integers(vectors: pa.Array, width: int, scale: float) -> np.ndarray:
    return np.floor(matrix(vectors, width) * scale).astype(np.int64)


def _totals(width: int, scale: float, books: np.ndarray):
    """Per task and used entry: count and component sums."""
    n_parts, n_entries, dim = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        indexes = [EqualAverageIndex(b) for b in books]
        counts = np.zeros((n_parts, n_entries), dtype=np.int64)
        sums = np.zeros(books.shape, dtype=np.int64)
        for batch in batches:
            ints = _integers(batch["vec"], width, scale)
            codes, _ = _assign(ints, indexes)
            for p in range(n_parts):
                counts[p] += np.bincount(codes[:, p], minlength=n_entries)
                np.add.at(sums[p], codes[:, p], ints[:, p * dim : (p + 1) * dim])
        part, entry = np.nonzero(counts)
        if len(part):
            yield pa.RecordBatch.from_arrays(
                [pa.array(part.astype(np.int32)), pa.array(entry.astype(np.int32)), pa.array(counts[part, entry]),
                 pa.array(list(sums[part, entry]), pa.list_(pa.int64()))], names=["part", "entry", "n", "sums"])

    return run


def _encode(width: int, scale: float, books: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        indexes = [EqualAverageIndex(b) for b in books]
        for batch in batches:
            codes, dist = _assign(_integers(batch["vec"], width, scale), indexes)
            text = pa.array([row.tobytes().hex() for row in codes.astype(np.uint8)], pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch["id"], batch["label"], text, pa.array(dist.sum(axis=1))],
                names=["id", "label", "code", "error"])

    return run


def _first_books(rows: DataFrame, entries: int, parts: int, width: int, scale: float) -> np.ndarray:
    """The parts of the first rows by id (``entries`` of them come to the driver)."""
    first = rows.orderBy(F.col("id").asc_nulls_last(), "vec").limit(entries).select("vec").toArrow()
    ints = _integers(first["vec"].combine_chunks(), width, scale)
    return np.stack(np.split(ints, parts, axis=1))


def _trained(rows: DataFrame, books: np.ndarray, rounds: int, width: int, scale: float) -> np.ndarray:
    dim = books.shape[2]
    for _ in range(rounds):
        partial = rows.select("vec").mapInArrow(
            _totals(width, scale, books), "part int, entry int, n long, sums array<long>")
        totals = partial.groupBy("part", "entry").agg(
            F.sum("n").alias("n"), F.array(*[F.sum(F.col("sums")[i]) for i in range(dim)]).cast("array<long>").alias("sums"))
        books = books.copy()
        for r in totals.collect():  # at most parts x entries rows
            books[r["part"], r["entry"]] = [s // r["n"] for s in r["sums"]]
    return books


def fingerprint(books: np.ndarray) -> str:
    """SHA-256 of all components by part, entry and position, comma-joined."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compress_vectors(df: DataFrame, id_col: str = "vec_id", label_col: str = "label",
                     vector_col: str = "embedding", scale: int = 1024, parts: int = 4, entries: int = 256,
                     rounds: int = 4) -> DataFrame:
    """Per kept row: id, code (two hex digits a part), error, label_error
    (errors summed over the label), codebooks_sha256. At most 256 entries."""
    if not 1 <= entries <= 256:
        raise ValueError("a code of two hex digits needs 1 to 256 entries")
    kept = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").alias("label"),
                     as_doubles(vector_col).alias("vec"))
    rows = materialize(kept.where(is_finite(F.col("vec"))), "vectors")
    largest = F.aggregate("vec", F.lit(0.0), lambda t, x: F.greatest(t, F.abs(x)))
    longest, most = rows.agg(F.max(F.size("vec")), F.max(largest)).first()
    width = parts * math.ceil((longest or 0) / parts)
    if (2 * ((most or 0.0) * scale + 1) * max(width, 1)) ** 2 >= 2**62:
        raise OverflowError("squared distances leave 64 bits")
    scale = float(scale)
    books = _trained(rows, _first_books(rows, entries, parts, width, scale), rounds, width, scale)
    coded = rows.mapInArrow(_encode(width, scale, books),
                            f"id {df.schema[id_col].dataType.simpleString()}, "
                            f"label {df.schema[label_col].dataType.simpleString()}, code string, error long")
    coded = materialize(coded.withColumn("unlabelled", F.col("label").isNull()), "codes")
    # a null label meets null labels: its value is that of any, told apart by the flag
    key = coded.select("id", "code", "error", "unlabelled", F.xxhash64("label").alias("hash"), "label")
    sums = key.groupBy("unlabelled", "hash", "label").agg(F.sum("error").alias("label_error"))
    sums = sums.groupBy("unlabelled", "hash").agg(
        F.collect_list(F.struct("label", "label_error")).alias("labels"))  # more than one only when hashes clash
    joined = attach_salted(key, sums, ["unlabelled", "hash"], F.struct("id", "code"))
    total = F.filter("labels", lambda x: x["label"].eqNullSafe(F.col("label")))[0]["label_error"]
    return joined.select(F.col("id").alias(id_col), "code", "error", total.alias("label_error"),
                         F.lit(fingerprint(books)).alias("codebooks_sha256"))
