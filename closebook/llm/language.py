"""Operator 10: language identification by compression.

A language is known by a raw-content dictionary for zstandard: pieces of
documents in that language. Text is cut into chunks, each chunk is compressed
with each language's dictionary, and the language with the smallest total wins;
a narrow margin over the second marks the answer as rejected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from .sampling import id_fold, sample_by_class

CHUNK = 4096  # bytes compressed at once; a longer text would be its own dictionary
DOCUMENTS, PIECE = 48, 2048  # documents a language, and bytes that the dictionary takes of each, chunk by chunk
LEVEL = 5  # lower levels search the dictionary too coarsely
MARGIN = 0.02  # relative lead over the second language below which the answer is rejected
SHARPNESS = 60.0
SCHEMA = "lang_pred string, score double, rejected boolean"


def normal(text: str) -> bytes:
    return text.lower().encode("utf-8", "replace")


def fit(docs: DataFrame, documents: int = DOCUMENTS, id_col: str = "doc_id", text_col: str = "text",
        lang_col: str = "lang") -> dict[str, bytes]:
    """{language: dictionary} from at most ``documents`` documents of each language, chosen by a hash of the id.

    Dictionaries hold at most ``documents * PIECE`` bytes (96 KB): of a longer
    document the piece that lies in its middle. This bounded sample is all that
    reaches the driver. Rows without language, id or letters are not learned.
    """
    usable = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).filter(
        F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").rlike(r"\p{L}"))
    middle = F.substring(F.col("text"), F.greatest(F.lit(1), ((F.length("text") - PIECE) / 2).cast("int")), F.lit(PIECE))
    sample = sample_by_class(usable, "lang", F.col("doc_id"), documents).select("lang", "turn", middle.alias("piece"))
    found: dict[str, list[tuple[int, bytes]]] = {}
    for row in sample.toLocalIterator():
        found.setdefault(row.lang, []).append((row.turn, normal(row.piece)[:PIECE]))
    return {lang: b"\n".join(p for _, p in sorted(pieces)) for lang, pieces in sorted(found.items())}


def classify(texts: list[str | None], languages: list[str], compressors: list) -> Iterator[tuple[str, float, bool]]:
    """(language, score, rejected) of each text; ``und`` without letters."""
    for text in texts:
        if not text or not any(map(str.isalpha, text)) or not languages:
            yield "und", 0.0, True
            continue
        raw = normal(text)
        chunks = [raw[i:i + CHUNK] for i in range(0, len(raw), CHUNK)]
        sizes = np.array([sum(len(c.compress(x)) for x in chunks) for c in compressors], float)
        order = np.argsort(sizes, kind="stable")
        lead = (sizes[order[1]] - sizes[order[0]]) / sizes[order[1]] if len(sizes) > 1 else 1.0
        score = 1 / np.exp(-SHARPNESS * (sizes / sizes[order[0]] - 1)).sum()
        yield languages[order[0]], float(score), bool(lead < MARGIN)


def predictor(model: dict[str, bytes]):
    """A column function of the text: struct of lang_pred, score, rejected."""
    @pandas_udf(SCHEMA)
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        import zstandard as zstd
        compressors = []
        for data in model.values():
            entry = zstd.ZstdCompressionDict(data, dict_type=zstd.DICT_TYPE_RAWCONTENT)
            entry.precompute_compress(level=LEVEL)
            compressors.append(zstd.ZstdCompressor(dict_data=entry, write_content_size=False))
        for texts in batches:
            yield pd.DataFrame(list(classify(texts, list(model), compressors)), columns=["lang_pred", "score", "rejected"])

    return predict


def identify(docs: DataFrame, folds: int = 5, held: int = 0, id_col: str = "doc_id", text_col: str = "text",
             lang_col: str = "lang") -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected of every row of ``docs``.

    Learns from rows whose crc32(id as text) modulo ``folds`` is not ``held``
    (a null id counts as held out). Whole texts are compressed, chunk by chunk.
    Null texts and texts without a letter: ``und`` with score 0; so is
    everything when no language was learned. ``score`` is the winner's share of
    the weights ``exp(-60 * excess)`` of each language's relative excess size.
    Languages of equal size: the first in code-point order. Repeated rows get a
    row each; an empty table gives an empty result. Other columns are not read.
    """
    held_out = F.coalesce(id_fold(id_col, folds) == held, F.lit(True))
    model = fit(docs.filter(~held_out), id_col=id_col, text_col=text_col, lang_col=lang_col)
    found = docs.select(F.col(id_col).alias("doc_id"), held_out.alias("held_out"), predictor(model)(F.col(text_col)).alias("p"))
    return found.select("doc_id", "held_out", "p.lang_pred", "p.score", "p.rejected")
