"""Cost-balanced packing of tokenised documents into fixed-length sequences.

A document is its token ids plus one end id. Its attention cost is estimated
as ``linear * n + quadratic * n**2`` for every piece of ``n`` ids (attention
stays inside a piece). Full sequences are cut off long documents first; the
remainders are packed: a pack has just as many sequences as its ids need, and
the remainders, in descending order, each go to the sequence of lowest cost
that has room for them. What then fits nowhere whole is cut into the room that
is left. The last, partly filled sequence of a pack is cut into lengths that
are powers of two, so no sequence is padded.

Each task tokenises and packs its own rows in one pass, ``pack_docs``
remainders at a time: no shuffle, no group that grows with the data. Sequence
ids are unique by (task's partition, sequence in it), and a task that runs
again makes the same ones. Memory is bounded by one Arrow batch, one slice and
one pack; nothing but the vocabulary stays in a worker after its task.

Tokenising: at a single space between two non-space characters this
tokenizer's pattern always starts a new word, so texts are cut there and each
distinct word of a slice of texts is encoded once. Words are encoded in lines
of many, which costs half of encoding each by itself; an id that begins with a
space begins a word. Equality with encoding whole texts is tested.

Defined results: null and empty texts are the end id alone; repeated rows and
repeated or null ids are packed each; extra columns are ignored; an empty
table gives no rows.
"""

from __future__ import annotations

import functools
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locus.llm.common import lean

VOCABULARY = "byte_bpe_50k.json"
BETWEEN_WORDS = re.compile(r"(?<=\S) (?=\S)")
#: How a byte-level vocabulary writes a space.
SPACE_TOKEN = "\u0120"
SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long")


def _spaced(words: pa.Array, also: pa.Array) -> np.ndarray:
    """Which words have space at an end, or are marked in ``also``."""
    return pc.or_(pc.not_equal(pc.utf8_trim_whitespace(words), words), also).to_numpy(zero_copy_only=False).copy()


class Encoder:
    """Batches of texts to ids, each distinct word of a slice of them being encoded once."""

    def __init__(self, vocabulary: str, slice_texts: int = 4096, slice_bytes: int = 16 << 20, line_words: int = 512):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(public_tokenizers.path(vocabulary))
        self.slice_texts, self.slice_bytes, self.line_words = slice_texts, slice_bytes, line_words
        self.after_space = np.zeros(max(self.tokenizer.get_vocab().values()) + 1, bool)
        self.after_space[[i for token, i in self.tokenizer.get_vocab().items() if token.startswith(SPACE_TOKEN)]] = True

    def _encode(self, texts: list[str], at_once: int) -> Iterator[np.ndarray]:
        for at in range(0, len(texts), at_once):
            for e in self.tokenizer.encode_batch_fast(texts[at : at + at_once], add_special_tokens=False):
                yield np.array(e.ids, "<u4")

    def _pool(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of distinct words that follow a space, and where each word's
        begin and how many they are. Words go to the tokenizer in lines; each begins
        at an id that begins with a space. Those with space of their own go alone."""
        alone = _spaced(words, pc.match_substring(words, " "))
        plain = words.filter(pa.array(~alone))
        cuts = pa.array([*range(0, len(plain), self.line_words), len(plain)], pa.int32())
        space = pa.scalar(" ", pa.large_string())
        lines = pc.binary_join(pa.ListArray.from_arrays(cuts, plain), space).to_pylist() if len(plain) else []
        found = list(self._encode([" " + x for x in lines], 32))
        ids = np.concatenate([np.zeros(0, "<u4"), *found])
        begins = np.flatnonzero(self.after_space[ids])
        if len(begins) != len(plain):  # the vocabulary has no such ids
            alone[:], ids, begins = True, ids[:0], begins[:0]
        rest = list(self._encode([" " + x for x in words.filter(pa.array(alone)).to_pylist()], 1024))
        starts, lens = np.empty(len(words), np.int64), np.empty(len(words), np.int64)
        starts[~alone], lens[~alone] = begins, np.diff(np.append(begins, len(ids)))
        lens[alone] = [len(x) for x in rest]
        starts[alone] = len(ids) + np.cumsum(lens[alone]) - lens[alone]
        return np.concatenate([ids, *rest]), starts, lens

    def __call__(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text (nulls: none), as uint32 arrays. ``slice_texts``
        texts of ``slice_bytes`` together (or one) are held in pieces at a time,
        however large a batch is."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
        at = 0
        while at < len(texts):
            full = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + self.slice_bytes, "right"))
            n = min(max(full - at, 1), self.slice_texts)
            yield from self._of_slice(texts.slice(at, n))
            at += n

    def _of_slice(self, texts: pa.Array) -> Iterator[np.ndarray]:
        pieces = pc.split_pattern(texts, " ")
        words = pieces.flatten()
        bounds = np.concatenate([[0], np.cumsum(pc.list_value_length(pieces).to_numpy(zero_copy_only=False))])
        # a piece with space at an end: the text is cut between words only, by the slower way
        odd = _spaced(words, pc.equal(pc.binary_length(words), 0))
        odd_before = np.concatenate([[0], np.cumsum(odd)])
        is_odd = odd_before[bounds[1:]] > odd_before[bounds[:-1]]
        if is_odd.any():
            cut = [BETWEEN_WORDS.split(x) for x in texts.filter(pa.array(is_odd)).to_pylist()]
            n = np.diff(bounds)
            kept = pa.array(np.repeat(~is_odd, n))
            # the other texts' words first, then theirs; begins and ends say where a text's words are
            words = pa.concat_arrays([words.filter(kept), pa.array([w for x in cut for w in x], pa.large_string())])
            n = np.concatenate([n[~is_odd], np.array([len(x) for x in cut], n.dtype)])
            order = np.argsort(np.concatenate([np.flatnonzero(~is_odd), np.flatnonzero(is_odd)]))
            begins, ends = (np.cumsum(n) - n)[order], np.cumsum(n)[order]
        else:
            begins, ends = bounds[:-1], bounds[1:]
        coded = words.dictionary_encode()
        codes = coded.indices.to_numpy(zero_copy_only=False)
        pool, starts, lens = self._pool(coded.dictionary)
        # the first word of a text has no space before it
        distinct, slots = np.unique(codes[begins], return_inverse=True)
        firsts = list(self._encode(coded.dictionary.take(pa.array(distinct)).to_pylist(), 1024))
        for begin, end, slot in zip(begins.tolist(), ends.tolist(), slots.tolist()):
            own = codes[begin + 1 : end]
            n = lens[own]
            at = np.repeat(starts[own] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            yield np.concatenate([firsts[slot], pool[at]])


@functools.lru_cache(maxsize=1)
def encoder(vocabulary: str) -> Encoder:
    """One encoder per Python worker; it holds the vocabulary, and no words."""
    return Encoder(vocabulary)


def descending_powers(n: int) -> list[int]:
    """The powers of two that add up to n, largest first."""
    return [1 << b for b in reversed(range(n.bit_length())) if n >> b & 1]


def pack(lengths: list[int], capacity: int, linear: float, quadratic: float) -> list[list[tuple[int, int, int]]]:
    """Sequences of (document, start in it, length) for documents below ``capacity``."""
    total = sum(lengths)
    whole, last = divmod(total, capacity)
    room = np.full(whole, capacity, dtype=np.int64)
    cost = np.zeros(whole)
    out: list[list[tuple[int, int, int]]] = [[] for _ in range(whole)]
    left = []
    for doc in sorted(range(len(lengths)), key=lambda d: (-lengths[d], d)):
        n = lengths[doc]
        fits = np.where(room >= n, cost, np.inf)
        at = int(fits.argmin()) if whole else 0
        if not whole or fits[at] == np.inf:
            left.append(doc)
            continue
        out[at].append((doc, 0, n))
        room[at] -= n
        cost[at] += linear * n + quadratic * n * n
    gaps = [(out[i], int(room[i])) for i in np.argsort(cost, kind="stable") if room[i]]
    for size in descending_powers(last):
        out.append([])
        gaps.append((out[-1], size))
    gaps.reverse()
    for doc in left:
        start = 0
        while start < lengths[doc]:
            target, free = gaps.pop()
            take = min(free, lengths[doc] - start)
            target.append((doc, start, take))
            start += take
            if take < free:
                gaps.append((target, free - take))
    return out


def pack_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = 1024,
                   end_id: int = 0, linear: float = 1.0, quadratic: float = 1.0 / 1024,
                   pack_docs: int = 4096, vocabulary: str = VOCABULARY) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary)
        next_id = TaskContext.get().partitionId() << 40
        pieces: list[tuple] = []
        waiting: list[tuple] = []  # id, start, ids of the remainder, tokens of the document

        def flush_pack() -> None:
            nonlocal next_id
            for sequence in pack([len(w[2]) // 4 for w in waiting], capacity, linear, quadratic):
                offset = 0
                for doc, start, n in sequence:
                    doc_id, base, ids, tokens = waiting[doc]
                    crc = zlib.crc32(ids[4 * start : 4 * (start + n)])
                    pieces.append((doc_id, base + start, n, crc, tokens, next_id, offset))
                    offset += n
                next_id += 1
            waiting.clear()

        def emit() -> pa.RecordBatch:
            names = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
            cols = list(zip(*pieces)) or [()] * len(names)
            pieces.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=list(names))

        for batch in batches:
            for doc_id, found in zip(batch.column(0).to_pylist(), encode(batch.column(1))):
                ids = np.append(found, np.uint32(end_id)).tobytes()
                tokens = len(ids) // 4
                cut = tokens - tokens % capacity
                for start in range(0, cut, capacity):
                    crc = zlib.crc32(ids[4 * start : 4 * (start + capacity)])
                    pieces.append((doc_id, start, capacity, crc, tokens, next_id, 0))
                    next_id += 1
                if cut < tokens:
                    waiting.append((doc_id, cut, ids[4 * cut :], tokens))
                if len(waiting) >= pack_docs:
                    flush_pack()
                if len(pieces) >= 50_000:
                    yield emit()
        flush_pack()
        yield emit()

    return rows.mapInArrow(lean(run), SCHEMA)
