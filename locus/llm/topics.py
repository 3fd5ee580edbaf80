"""Topics of texts: clusters of hashed token counts.

A text's features are the square roots of its counts of token ids, hashed into
``FEATURES`` places, less the mean of its language, scaled to length one; so
topics are what texts of one language differ by, and are no second language
label. Spherical k-means finds ``topics`` centres on all texts: the first one
is drawn by the rows' draws, each further one with a chance in proportion to
its distance from those before, and the centres then move until none moves by
``tolerance``. Every text belongs to the centre with the largest product; ties
go to the lower number.

Scale: texts are encoded once; their features (``2 * FEATURES`` bytes a text)
are written, once more in blocks of ``BLOCK`` texts of a language, and every
round is one pass over the blocks, of which each task gives one vector a
centre; no row of a text is made again in a round. Sums are of whole numbers, so they do not depend on how
the rows are dealt. The driver holds the centres and the means of languages
with at least ``LANG_TEXTS`` texts and a ``1 / LANGUAGES`` share of them, which
go out with the tasks. Texts of other languages are compared with the mean of
all.

Defined results: a null or empty text has no topic (``none``) and one token,
the end id; without any text to learn from no text has a topic; equal texts of
one language have equal topics; repeated rows count each; long texts are
encoded whole.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from locus.llm.common import give_back, lean, remove, written
from locus.llm.packing import VOCABULARY, encoder

FEATURES = 256
LANG_TEXTS = 20
LANGUAGES = 200
#: Features are kept, and points summed, as whole numbers of these parts of one.
KEPT, SUMMED = 1 << 15, 1 << 24
#: Texts in a block, and at most together in a block and those summed with it.
BLOCK, ROWS = 64, 1024


def features(ids: np.ndarray) -> np.ndarray:
    """Square roots of hashed token counts, of length one (no ids: zero), in parts of ``KEPT``."""
    places = (ids.astype(np.uint32) * np.uint32(2654435761)) >> np.uint32(24)  # the top 8 bits: FEATURES places
    counts = np.sqrt(np.bincount(places, minlength=FEATURES).astype(np.float32))
    return np.rint(counts * (KEPT / max(float(np.sqrt((counts * counts).sum())), 1e-9))).astype(np.uint16)


@dataclass(frozen=True)
class Topics:
    centres: np.ndarray
    means: dict[str, np.ndarray]
    mean: np.ndarray

    def less_mean(self, langs: list[str], found: np.ndarray, counts: np.ndarray | int = 1) -> np.ndarray:
        """Features (a row each) less the means of their languages, each of which
        holds for as many rows in turn as ``counts`` says."""
        means = np.stack([self.means.get(x, self.mean) for x in langs])
        return found * np.float32(1 / KEPT) - np.repeat(means, counts, axis=0)

    def of(self, langs: list[str], found: np.ndarray) -> np.ndarray:
        return (self.less_mean(langs, found) @ self.centres.T).argmax(axis=1) if len(langs) else np.empty(0, int)


def with_features(rows: DataFrame, text_col: str, vocabulary: str = VOCABULARY) -> DataFrame:
    """``rows`` without the text, with ``tokens`` and the ``features`` of texts
    that have ids and no ``topic`` yet."""
    others = [c for c in rows.columns if c not in (text_col, "topic")]
    source = rows.select(*others, "topic", text_col)
    schema = T.StructType([*[f for f in source.schema if f.name != text_col], T.StructField("tokens", T.LongType()),
                           T.StructField("features", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary)
        for batch in batches:
            given = batch.column(len(others)).is_null().to_pylist()
            tokens, found = [], []
            for unknown, ids in zip(given, encode(batch.column(len(others) + 1))):
                tokens.append(len(ids) + 1)
                found.append(features(ids).tobytes() if unknown and len(ids) else None)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in range(len(others) + 1)], pa.array(tokens, pa.int64()),
                 pa.array(found, pa.binary())], names=[*others, "topic", "tokens", "features"])

    return source.mapInArrow(lean(run), schema)


def _slices(batches: Iterator[pa.RecordBatch], rows: int = ROWS) -> Iterator[pa.RecordBatch]:
    """The batches in slices whose points, as floats, stay small and near the processor."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _matrix(found: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(found), np.uint16).reshape(-1, FEATURES)


def _blocked(rows: DataFrame) -> DataFrame:
    """``rows`` (lang, draw, features) as blocks (lang, draws, features), one
    value for ``BLOCK`` texts of a language, or for those that a task has over."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[str, tuple[list[float], list[bytes]]] = {}
        held = 0

        def made(blocks: list[tuple[str, list[float], list[bytes]]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([x for x, _, _ in blocks], pa.string()),
                 pa.array([np.array(d).tobytes() for _, d, _ in blocks], pa.binary()),
                 pa.array([b"".join(f) for _, _, f in blocks], pa.binary())], names=["lang", "draws", "features"])

        for batch in _slices(batches):
            full = []
            for lang, draw, found in zip(*[c.to_pylist() for c in batch.columns]):
                draws, texts = waiting.setdefault(lang, ([], []))
                draws.append(draw)
                texts.append(found)
                if len(texts) == BLOCK:
                    full.append((lang, *waiting.pop(lang)))
            held += batch.num_rows - BLOCK * len(full)
            if held > 64 * ROWS:  # many languages of few texts
                full += [(lang, *found) for lang, found in waiting.items()]
                waiting, held = {}, 0
            if full:
                yield made(full)
        yield made([(lang, *found) for lang, found in waiting.items()])

    return rows.mapInArrow(lean(run), "lang string, draws binary, features binary")


def _several(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[str], np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks of up to ``ROWS`` texts together: languages, how many texts in turn
    each stands for, and the texts' draws and features."""
    for batch in batches:
        langs, draws, found = (c.to_pylist() for c in batch.columns)
        counts = np.array([len(d) // 8 for d in draws], int)
        part = (np.cumsum(counts) - 1) // (ROWS - BLOCK + 1)
        for at in np.split(np.arange(len(langs)), np.flatnonzero(np.diff(part)) + 1) if len(langs) else ():
            of = slice(at[0], at[-1] + 1)
            yield langs[of], counts[of], np.frombuffer(b"".join(draws[of])), _matrix(found[of])


def _summed(blocks: DataFrame, of: Callable[[list[str], np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]],
            groups: int) -> np.ndarray:
    """Sums by group over all ``blocks``. ``of`` gives the groups of some rows
    (-1: none) and what to sum, whole numbers; each task sums its own rows first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((groups, FEATURES))
        for langs, counts, _, found in _several(batches):
            group, values = of(langs, counts, found)
            sums += (group == np.arange(groups)[:, None]).astype(np.float64) @ values  # whole numbers below 2**53: exact
        there = np.flatnonzero(sums.any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(there, pa.int32()), pa.array(list(sums[there].astype(np.int64)), pa.list_(pa.int64()))],
            names=["group", "sums"])

    parts = blocks.mapInArrow(lean(run), "group int, sums array<long>")
    out = np.zeros((groups, FEATURES))
    for g, place, total in parts.select("group", F.posexplode("sums").alias("place", "part")).groupBy(
            "group", "place").agg(F.sum("part")).collect():  # groups x FEATURES numbers
        out[g, place] = total
    return out


def _points(model: Topics, langs: list[str], counts: np.ndarray, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of length one, and which rows differ from their language's mean."""
    points = model.less_mean(langs, found, counts)
    norms = np.sqrt((points * points).sum(axis=1))
    return points / np.maximum(norms, 1e-6)[:, None], norms > 1e-6


def _uniform(draws: np.ndarray, step: int) -> np.ndarray:
    """Numbers in (0, 1) of draws in [0, 1), others in each step."""
    z = (draws * (1 << 52)).astype(np.uint64) + np.uint64((step + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (((z ^ (z >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) + 0.5) / (1 << 53)


def _drawn(blocks: DataFrame, model: Topics, step: int) -> np.ndarray | None:
    """One of all points, drawn with a chance in proportion to its distance
    from the centres (none yet: with equal chances): the first of a race in
    which a row's time is exponential with that rate."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = None
        for langs, counts, draws, found in _several(batches):
            points, differs = _points(model, langs, counts, found)
            far = 1 - (points @ model.centres.T).max(axis=1) if len(model.centres) else np.ones(len(points))
            time = np.full(len(points), np.inf)
            runs = np.flatnonzero(differs & (far > 1e-5))
            time[runs] = -np.log(_uniform(draws[runs], step)) / far[runs]
            for i in np.flatnonzero(time == time.min()) if len(runs) else ():  # rows alike in id and text: by the point
                own = (float(time[i]), points[i].tolist())
                best = own if best is None else min(best, own)
        yield pa.RecordBatch.from_arrays(
            [pa.array([best[0]] if best else [], pa.float64()), pa.array([best[1]] if best else [], pa.list_(pa.float32()))],
            names=["time", "point"])

    first = blocks.mapInArrow(lean(run), "time double, point array<float>").orderBy("time", "point").first()
    return np.array(first["point"], np.float32) if first is not None else None


def fit_topics(rows: DataFrame, lang_col: str, draw_col: str, topics: int = 8, rounds: int = 50,
               tolerance: float = 1e-3) -> Topics | None:
    """Learned from all of ``rows`` (written, from ``with_features``) with features.
    ``draw_col`` holds numbers in [0, 1) that choose the first centres."""
    rows = rows.where(F.col("features").isNotNull()).select(
        F.col(lang_col).alias("lang"), F.col(draw_col).alias("draw"), "features")
    langs = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    n = langs.agg(F.sum("n")).first()[0]
    if not n:
        return None
    counts = dict(langs.where(F.col("n") >= max(LANG_TEXTS, n / LANGUAGES)).collect())  # at most LANGUAGES
    number = {x: i for i, x in enumerate(sorted(counts))}

    blocks, path = written(_blocked(rows), "topic-blocks")
    model = _fitted(blocks, counts, number, n, topics, rounds, tolerance)
    remove(rows.sparkSession, path)
    return model


def _fitted(blocks: DataFrame, counts: dict[str, int], number: dict[str, int], n: int, topics: int, rounds: int,
            tolerance: float) -> Topics:
    """The centres of all ``blocks`` (``n`` texts); ``counts`` and ``number``
    are of the languages with a mean of their own."""
    def by_lang(langs: list[str], held: np.ndarray, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return np.repeat(np.array([number.get(x, len(number)) for x in langs], int), held), found.astype(np.float64)

    sums = _summed(blocks, by_lang, len(number) + 1)
    mean = (sums.sum(axis=0) / (n * KEPT)).astype(np.float32)
    means = {x: (sums[i] / (counts[x] * KEPT)).astype(np.float32) for x, i in number.items()}
    model = Topics(np.empty((0, FEATURES), np.float32), means, mean)
    while len(model.centres) < topics:
        point = _drawn(blocks, model, len(model.centres))
        if point is None:
            break  # fewer different points than topics
        model = Topics(np.vstack([model.centres, point]), means, mean)
    if not len(model.centres):
        return Topics(np.zeros((1, FEATURES), np.float32), means, mean)
    for _ in range(rounds):
        centres = model.centres

        def nearest(langs: list[str], held: np.ndarray, found: np.ndarray,
                    model: Topics = model) -> tuple[np.ndarray, np.ndarray]:
            points, differs = _points(model, langs, held, found)
            return np.where(differs, (points @ model.centres.T).argmax(axis=1), -1), np.rint(points.astype(np.float64) * SUMMED)

        sums = _summed(blocks, nearest, len(centres))
        norms = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
        moved = np.where(norms > 0, sums / np.maximum(norms, 1), centres).astype(np.float32)
        model = Topics(moved, means, mean)
        if np.abs(moved - centres).max() <= tolerance:
            break
    return model


def with_topic(rows: DataFrame, model: Topics | None, lang_col: str, none: str = "(none)") -> DataFrame:
    """``rows`` of ``with_features`` without the features and, where ``topic`` is null, with the topic."""
    others = [c for c in rows.columns if c not in ("features", "topic")]
    source = rows.select(*others, "topic", "features")
    schema = T.StructType([f for f in source.schema if f.name != "features"])
    lang_at = others.index(lang_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            topics = _topics_of(model, batch.column(lang_at), batch.column(len(others)),
                                batch.column(len(others) + 1).to_pylist(), none)
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(len(others))], topics],
                                             names=[*others, "topic"])

    return source.mapInArrow(lean(run), schema)


def _topics_of(model: Topics | None, langs: pa.Array, given: pa.Array, found: list[bytes | None], none: str) -> pa.Array:
    out = [none if x is None else x for x in given.to_pylist()]
    at = [i for i, x in enumerate(found) if x is not None] if model is not None else []
    if at:
        langs = langs.to_pylist()
        for some in (at[i : i + ROWS] for i in range(0, len(at), ROWS)):
            for i, topic in zip(some, model.of([langs[i] for i in some], _matrix([found[i] for i in some]))):
                out[i] = f"topic-{topic}"
    return pa.array(out, pa.string())


def topic_column(model: Topics | None, text: Column, lang: Column, topic: Column, vocabulary: str = VOCABULARY,
                 none: str = "(none)") -> Column:
    """The topic that ``with_topic`` gives, of a text itself: only text, language
    and given topic go to Python."""
    def run(texts: pa.Array, langs: pa.Array, given: pa.Array) -> pa.Array:
        found = [features(ids).tobytes() if x is None and len(ids) else None
                 for x, ids in zip(given.to_pylist(), encoder(vocabulary)(texts))]
        give_back()
        return _topics_of(model, langs, given, found, none)

    return F.arrow_udf(run, "string")(text, lang, topic)
