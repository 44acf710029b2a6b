"""Language identification by compression.

Each language gets a zstandard raw-content dictionary of its own text. A text is encoded
in pieces of ``PIECE`` characters with every dictionary (longer pieces would feed on
themselves rather than on the dictionary); all pieces count, whole texts are read, and the language
with the fewest bytes wins. A margin under ``min_margin`` of the smallest size is a rejection: ``rejected`` is
true and the score is low, the nearest language is still named.

The dictionaries are the only bound: ``PIECES_PER_LANGUAGE`` pieces of ``PIECE`` characters, one from each of the documents with the
smallest hashes; documents of ``SHORT`` characters and more come first, so shorter ones teach a language that lacks those. Null texts and texts without letters are ``und`` with score 0. With nothing to learn from every
text is ``und``. Null languages are not learned; ties go to the first language by name. Repeated
rows are judged alike and fill one place of a dictionary; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PIECE, PIECES_PER_LANGUAGE, LEVEL = 1200, 100, 3
MIN_MARGIN = 0.02
#: Texts of fewer characters are learned from only as far as longer ones don't fill a language's dictionary.
SHORT = 40


def learn_dictionaries(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> dict[str, bytes]:
    """Raw-content dictionary per language."""
    rows = docs.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    rows = rows.where("length(text) > 0 and lang is not null")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("short", "h"))
    # the limit is pushed below the shuffle, so a language sends a few rows of each partition
    start = F.expr(f"1 + pmod(h, greatest(1, length(text) - {PIECE}))").cast("int")
    rows = rows.select("lang", F.xxhash64("text").alias("h"), "text").select("lang", "h", (F.length("text") < SHORT).alias("short"), F.col("text").substr(start, F.lit(PIECE)).alias("piece"))
    kept = rows.withColumn("rank", rank).where(F.col("rank") <= PIECES_PER_LANGUAGE).select("lang", "piece", "rank").collect()
    out: dict[str, list[str]] = {}
    for r in sorted(kept, key=lambda r: (r["lang"], r["rank"])):
        out.setdefault(r["lang"], []).append(r["piece"])
    return {lang: "\n".join(dict.fromkeys(p)).encode("utf-8", "surrogatepass") for lang, p in out.items()}


def _classify(dictionaries: dict[str, bytes], min_margin: float):
    names = sorted(dictionaries)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoders = []
        for name in names:
            d = zstandard.ZstdCompressionDict(dictionaries[name], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=LEVEL)
            encoders.append(zstandard.ZstdCompressor(dict_data=d, level=LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False))
        for pdf in batches:
            langs, scores, rejected = [], [], []
            for text in pdf["text"]:
                if not names or not text or not any(map(str.isalpha, text)):
                    langs.append("und"), scores.append(0.0), rejected.append(True)
                    continue
                pieces = [text[i : i + PIECE].encode("utf-8", "surrogatepass") for i in range(0, len(text), PIECE)]
                sizes = np.array([sum(len(e.compress(p)) for p in pieces) for e in encoders], dtype=np.float64)
                best = int(sizes.argmin())
                second = np.partition(sizes, 1)[1] if len(sizes) > 1 else sizes[best] * 2
                margin = (second - sizes[best]) / sizes[best]
                langs.append(names[best])
                scores.append(float(1 - np.exp(-margin / (2 * min_margin))))
                rejected.append(bool(margin < min_margin))
            yield pd.DataFrame({"id": pdf["id"], "lang_pred": langs, "score": scores, "rejected": rejected})

    return run


def identify(docs: DataFrame, dictionaries: dict[str, bytes], min_margin: float = MIN_MARGIN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ``lang_pred``, ``score`` (0 to 1, from the margin) and ``rejected``."""
    kind = dict(docs.dtypes)[id_col]
    thin = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return thin.mapInPandas(_classify(dictionaries, min_margin), f"id {kind}, lang_pred string, score double, rejected boolean").withColumnRenamed("id", id_col)
