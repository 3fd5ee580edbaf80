"""Word shingle sets of text batches, as sorted arrays of 64-bit hashes (numpy)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

_U = np.uint64
_P = _U(0x9E3779B97F4A7C15)
_COEFFICIENTS = np.array([0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93,
                          0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3,
                          0x589965CC75374CC3, 0x1D8E4E27C47D124F], dtype=_U)
#: Bytes of a word that are hashed column by column; longer words go one at a time.
_LONG = 48
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser, a bijection of 64-bit integers."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _word_hashes(data: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    order = np.argsort(-lens, kind="stable")
    at, n = starts[order], lens[order]
    h = np.zeros(len(n), dtype=_U)
    short = int(np.searchsorted(-n, -_LONG, side="left"))  # words before it are longer
    for i in range(short):
        h[i] = xxhash.xxh64_intdigest(data[at[i] : at[i] + n[i]].tobytes())
    for j in range(min(_LONG, int(n[short]) if short < len(n) else 0)):
        end = int(np.searchsorted(-n, -j, side="left"))
        part = slice(short, end)
        h[part] = h[part] * _P + data[at[part] + j] + _U(1)
    out = np.empty_like(h)
    out[order] = mix(h + n.astype(_U) * _COEFFICIENTS[7])
    return out


def shingle_sets(texts: pa.Array, width: int = 5, chunk_bytes: int = 4_000_000) -> Iterator[np.ndarray]:
    """Per text the sorted distinct hashes of its ``width``-word shingles.

    Words are runs without ASCII white space, A-Z lower-cased. A text of fewer
    words is one shingle; one without words (or null) has none."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    whole = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)
    first = 0
    while first < len(texts):
        last = int(np.searchsorted(offsets, offsets[first] + chunk_bytes, side="right")) - 1
        last = min(max(last, first + 1), len(texts))
        yield from _sets(whole, offsets[first : last + 1], width)
        first = last


def _sets(whole: np.ndarray, offsets: np.ndarray, width: int) -> Iterator[np.ndarray]:
    data = _LOWER[whole[offsets[0] : offsets[-1]]]
    ends_of_docs = offsets[1:] - offsets[0]
    inside = ~_IS_SPACE[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edge = ends_of_docs[:-1]
    edge = edge[edge < len(data)]
    begins[edge] = inside[edge]  # a word ends with its text
    finishes = inside.copy()
    finishes[:-1] &= ~inside[1:]
    finishes[edge[edge > 0] - 1] = inside[edge[edge > 0] - 1]
    starts = np.flatnonzero(begins)
    lens = np.flatnonzero(finishes) + 1 - starts
    words = _word_hashes(data, starts, lens)
    cut = np.searchsorted(starts, np.concatenate([[0], ends_of_docs]))
    size = len(words)
    sums = np.zeros(size, dtype=_U)
    for j in range(width):
        sums[: max(size - j, 0)] += words[j:] * _COEFFICIENTS[j]
    hashes = mix(sums)
    for a, b in zip(cut[:-1].tolist(), cut[1:].tolist()):
        if b - a >= width:
            yield np.unique(hashes[a : b - width + 1])
        elif b > a:
            few = (words[a:b] * _COEFFICIENTS[: b - a]).sum(dtype=_U) + _U(b - a)
            yield mix(np.array([few], dtype=_U))
        else:
            yield np.zeros(0, dtype=_U)
