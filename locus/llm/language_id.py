"""Language identification by compression with per-language dictionaries.

Fit: for every language a raw-content zstandard dictionary is made from a
bounded sample of labelled texts (``texts_per_lang`` texts of the language in
the order of a hash of the id, the first ``chars_per_text`` characters of each, at most
``dictionary_bytes`` bytes; both bounds only concern the fit). Predict: the
whole lower-cased text is cut into blocks of ``block_bytes``; every block is compressed
with every dictionary, the sizes are summed per language and the smallest sum
wins. Blocks keep the dictionary in reach in a long text and bound memory.

``score`` is the margin: how much smaller the best sum is than the runner-up,
as a share of the latter. ``rejected`` says that the margin is narrow: it is
below ``min_margin``, or nothing could be predicted.

Defined results: null, empty and letterless texts get ``und`` with score 0
and are rejected; equal sums go to the alphabetically first language with
score 0; with no labelled text at all every row is ``und``; with only one
language everything with a letter gets it with score 1. Null ids count as
not held out. Repeated rows are predicted each; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locus.llm.common import lean

UNKNOWN = "und"
#: Calibrated on labelled training rows; see README.
MIN_MARGIN = 0.002


def is_held_out(id_col: str = "doc_id") -> Column:
    """One row in five, by the CRC-32 of the id's text."""
    remainder = F.crc32(F.col(id_col).cast("string").cast("binary")) % 5
    return F.coalesce(remainder == 0, F.lit(False))


def fit_dictionaries(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang",
                     id_col: str = "doc_id", texts_per_lang: int = 600, chars_per_text: int = 400,
                     dictionary_bytes: int = 112_640, full_langs: int = 256) -> dict[str, bytes]:
    """Raw dictionary content per language, from a bounded sample of rows.

    Counts per language give a hash threshold that lets about
    ``texts_per_lang`` rows of each language pass, so no language's rows
    gather anywhere. Every language is learned; beyond ``full_langs`` of them
    each has fewer texts and a smaller dictionary, so that about 1.5 *
    full_langs * texts_per_lang * chars_per_text characters reach the driver
    (a text of each language at least)."""
    usable = labelled.where(F.col(lang_col).isNotNull() & (F.trim(F.coalesce(text_col, F.lit(""))) != "")).select(
        F.col(id_col).alias("_id"), F.col(lang_col).alias("_lang"), F.col(text_col).alias("_text"))
    counts = usable.groupBy("_lang").agg(F.count(F.lit(1)).alias("n")).collect()
    if not counts:
        return {}
    if len(counts) > full_langs:
        texts_per_lang = max(1, texts_per_lang * full_langs // len(counts))
        dictionary_bytes = max(64, dictionary_bytes * full_langs // len(counts))
    # a threshold for few texts could let none of a language pass
    share = {r["_lang"]: max(1.5 * texts_per_lang, 20.0) / r["n"] for r in counts}
    order = F.pmod(F.xxhash64("_id", F.lit("fit")), F.lit(1 << 40)) / float(1 << 40)
    limit = F.create_map(*[x for k, v in share.items() for x in (F.lit(k), F.lit(v))])
    sample = (
        usable.withColumn("_at", order).where(F.col("_at") < limit[F.col("_lang")])
        .select("_lang", "_at", "_id", F.substring("_text", 1, chars_per_text).alias("_sample"))
        .groupBy("_lang").agg(F.slice(F.sort_array(F.collect_list(F.struct("_at", "_id", "_sample"))),
                                      1, texts_per_lang).alias("_texts")))
    out = {}
    for row in sample.collect():
        content = "\n".join(t["_sample"] for t in row["_texts"]).lower().encode()
        out[row["_lang"]] = content[:dictionary_bytes]
    return out


class Classifier:
    """Compresses text with every language's dictionary."""

    def __init__(self, dictionaries: dict[str, bytes], block_bytes: int, level: int):
        self.langs = sorted(dictionaries)
        self.block_bytes = block_bytes
        self.coders = []
        for lang in self.langs:
            d = zstandard.ZstdCompressionDict(dictionaries[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=level)
            self.coders.append(zstandard.ZstdCompressor(
                level=level, dict_data=d, write_checksum=False, write_content_size=False, write_dict_id=False))

    def sizes(self, text: str) -> list[int]:
        data = memoryview(text.lower().encode("utf-8", "replace"))
        step = self.block_bytes
        blocks = [data[i : i + step] for i in range(0, len(data), step)]
        return [sum(len(c.compress(b)) for b in blocks) for c in self.coders]

    def predict(self, text: str | None) -> tuple[str, float]:
        if text is None or not self.langs or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0
        if len(self.langs) == 1:
            return self.langs[0], 1.0
        ranked = sorted(zip(self.sizes(text), self.langs))
        best, second = ranked[0], ranked[1]
        return best[1], (second[0] - best[0]) / second[0]


def predict_language(df: DataFrame, dictionaries: dict[str, bytes], text_col: str = "text",
                     min_margin: float = MIN_MARGIN, block_bytes: int = 2_048, level: int = 5,
                     names: tuple[str, str, str] = ("lang_pred", "score", "rejected")) -> DataFrame:
    """``df`` with the prediction, its score and whether it is rejected as
    ``names`` (existing columns of these names are replaced). Only
    ``text_col`` is looked at."""
    out_cols = [c for c in df.columns if c not in names]
    kept = df.select(*[F.col(f"`{c}`") for c in out_cols])
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)
    # a text that is kept goes to Python once
    text_at = out_cols.index(text_col) if text_col in out_cols else len(out_cols)
    source = kept if text_col in out_cols else df.select(*[F.col(f"`{c}`") for c in out_cols], F.col(text_col).alias("__text"))
    pred, score, rejected = names
    small = 512  # rows that are predicted at a time

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Classifier(dictionaries, block_bytes, level)
        for batch in batches:
            for at in range(0, batch.num_rows, small):
                part = batch.slice(at, small)
                found = [model.predict(t.as_py()) for t in part.column(text_at)]
                cols = [part.column(i) for i in range(len(out_cols))]
                yield pa.RecordBatch.from_arrays(
                    [*cols, pa.array([l for l, _ in found], pa.string()),
                     pa.array([s for _, s in found], pa.float64()),
                     pa.array([l == UNKNOWN or s < min_margin for l, s in found], pa.bool_())],
                    names=[*out_cols, *names])

    return source.mapInArrow(lean(run), f"{schema}, `{pred}` string, `{score}` double, `{rejected}` boolean")


def keep_identified(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    lang_col: str = "lang") -> DataFrame:
    """The rows whose language is told apart, with their columns as they were."""
    dictionaries = fit_dictionaries(df.where(~is_held_out(id_col)), text_col, lang_col, id_col)
    names = ("__lang_pred", "__score", "__rejected")
    found = predict_language(df, dictionaries, text_col, names=names)
    return found.where("not __rejected").select(*[F.col(f"`{c}`") for c in df.columns])


def identify(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             lang_col: str = "lang") -> DataFrame:
    """Fit on the rows that are not held out, predict every row."""
    dictionaries = fit_dictionaries(df.where(~is_held_out(id_col)), text_col, lang_col, id_col)
    rows = df.select(F.col(id_col), is_held_out(id_col).alias("held_out"), F.col(text_col))
    return predict_language(rows, dictionaries, text_col).drop(text_col)
