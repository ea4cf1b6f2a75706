"""Operator 4: quality classifier, a generalised additive model with pairwise interactions.

Shape features of the whole text are binned; boosting goes round the features,
each step fitting a shallow tree on the bins of one feature (later of one pair
of features), whose leaves add to that feature's lookup table. A score is a sum
of table entries at a text's bins.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import ArrayType, DoubleType

from .sampling import id_fold, sample_by_class

MAX_ROWS = 8000  # labelled rows of each label that the fit may take
BINS, PAIR_BINS, PAIRS = 32, 8, 8
ROUNDS, PAIR_ROUNDS, RATE, SMOOTH = 60, 30, 0.15, 5.0

_KIND = np.zeros(256, np.int64)  # classes of bytes
_KIND[[*range(97, 123)]] = 1
_KIND[[*range(65, 91)]] = 2
_KIND[[*range(48, 58)]] = 3
_KIND[[9, 10, 13, 32]] = 4
_KIND[[*b".,;:'\"()-?"]] = 5
_KIND[[*b"#$%&*@^~|<>{}[]\\/+=_`"]] = 6
_KIND[[*b"!"]] = 7
_KIND[128:] = 8

FEATURES = ["log_bytes", "lower", "upper", "digit", "space", "mark", "symbol", "shout", "beyond_ascii", "entropy",
            "log_words", "word_length", "longest_word", "distinct_words", "top_word", "short_words", "capital_words",
            "line_length", "distinct_lines", "closed_lines", "distinct_pairs", "compressed", "symbol_words", "words_a_line"]


def features(text: str | None) -> list[float]:
    """The shape of one whole text; null as empty."""
    text = text or ""
    raw = text.encode("utf-8", "replace")
    size = max(1, len(raw))
    histogram = np.bincount(np.frombuffer(raw, np.uint8), minlength=256) if raw else np.zeros(256)
    kinds = np.bincount(_KIND, weights=histogram, minlength=9) / size
    share = histogram[histogram > 0] / size
    words = text.split()
    n = max(1, len(words))
    counts = Counter(words)
    lines = [x for x in text.split("\n") if x.strip()]
    m = max(1, len(lines))
    return [np.log1p(len(raw)), *kinds[1:], -(share * np.log2(share)).sum(), np.log1p(len(words)),
            sum(map(len, words)) / n, np.log1p(max(map(len, words), default=0)), len(counts) / n,
            max(counts.values(), default=0) / n, sum(len(w) <= 2 for w in words) / n,
            sum(w[0].isupper() for w in words) / n, np.log1p(len(text) / m), len(set(lines)) / m,
            sum(x.rstrip()[-1] in ".!?" for x in lines) / m, len(set(zip(words, words[1:]))) / n,
            len(zlib.compress(raw, 1)) / size, sum(not w[-1].isalnum() and w[-1] not in ".,;:!?)\"'" for w in words) / n,
            np.log1p(n / m)]


@dataclass
class AdditiveModel:
    edges: list[np.ndarray] = field(default_factory=list)  # borders of each feature's bins
    tables: list[np.ndarray] = field(default_factory=list)  # entry of each bin
    pairs: list[tuple[int, int]] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)  # each feature's bin -> its bin in pairs
    pair_tables: list[np.ndarray] = field(default_factory=list)
    base: float = 0.0

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], "right") for j, e in enumerate(self.edges)], 1)

    def margin(self, b: np.ndarray) -> np.ndarray:
        out = np.full(len(b), self.base)
        for j, table in enumerate(self.tables):
            out += table[b[:, j]]
        for (i, j), table in zip(self.pairs, self.pair_tables):
            out += table[self.coarse[i][b[:, i]], self.coarse[j][b[:, j]]]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1."""
        if not self.edges:
            return np.full(len(x), 1 / (1 + np.exp(-self.base)))
        return 1 / (1 + np.exp(-np.clip(self.margin(self.bins(x)), -30, 30)))


def _shallow_tree(gradient: np.ndarray, weight: np.ndarray, leaves: int = 3) -> np.ndarray:
    """Leaf values over ordered bins: the best cuts one after the other, ``leaves`` leaves at most."""
    parts = [(0, len(gradient))]
    g, h = np.concatenate(([0], np.cumsum(gradient))), np.concatenate(([0], np.cumsum(weight)))
    gain = lambda a, b: (g[b] - g[a]) ** 2 / (h[b] - h[a] + SMOOTH)
    while len(parts) < leaves:
        best = max(((gain(a, c) + gain(c, b) - gain(a, b), a, c, b) for a, b in parts for c in range(a + 1, b)), default=(0,))
        if best[0] <= 1e-9:
            break
        _, a, c, b = best
        parts.remove((a, b))
        parts += [(a, c), (c, b)]
    out = np.zeros(len(gradient))
    for a, b in parts:
        out[a:b] = (g[b] - g[a]) / (h[b] - h[a] + SMOOTH)
    return out


def _quadrants(gradient: np.ndarray, weight: np.ndarray) -> tuple[float, np.ndarray]:
    """The best tree with one cut on each axis: gain and leaf values of a pair's table."""
    g, h = (np.pad(x.cumsum(0).cumsum(1), ((1, 0), (1, 0))) for x in (gradient, weight))
    n, m = gradient.shape
    best, out = 0.0, np.zeros((n, m))
    total = g[n, m] ** 2 / (h[n, m] + SMOOTH)
    for i in range(1, n):
        for j in range(1, m):
            sums = [(x[i, j], x[i, m] - x[i, j], x[n, j] - x[i, j], x[n, m] - x[i, m] - x[n, j] + x[i, j]) for x in (g, h)]
            values = [a / (b + SMOOTH) for a, b in zip(*sums)]
            gain = sum(a * v for a, v in zip(sums[0], values)) - total
            if gain > best:
                best = gain
                out[:i, :j], out[:i, j:], out[i:, :j], out[i:, j:] = values
    return best, out


def train(x: np.ndarray, y: np.ndarray) -> AdditiveModel:
    """Fit on rows ``x`` with labels 0 and 1. Without rows or with one label only the model is a constant."""
    model = AdditiveModel()
    if not len(y) or y.min() == y.max():
        model.base = 0.0 if not len(y) else 4.0 * (2 * float(y[0]) - 1)
        return model
    model.edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
    b = model.bins(x)
    counts = [len(e) + 1 for e in model.edges]
    model.tables = [np.zeros(n) for n in counts]
    share = y.mean()
    model.base = float(np.log(share / (1 - share)))
    margin = np.full(len(y), model.base)
    step = lambda: (y - (p := 1 / (1 + np.exp(-margin))), p * (1 - p))
    for _ in range(ROUNDS):
        for j, n in enumerate(counts):
            gradient, weight = step()
            leaf = RATE * _shallow_tree(np.bincount(b[:, j], gradient, n), np.bincount(b[:, j], weight, n))
            model.tables[j] += leaf
            margin += leaf[b[:, j]]
    model.coarse = [np.minimum(np.arange(n) * PAIR_BINS // n, PAIR_BINS - 1) for n in counts]
    small = [c[b[:, j]] for j, c in enumerate(model.coarse)]
    cell = lambda i, j, v: np.bincount(small[i] * PAIR_BINS + small[j], v, PAIR_BINS ** 2).reshape(PAIR_BINS, PAIR_BINS)
    gradient, weight = step()
    gains = sorted(((_quadrants(cell(i, j, gradient), cell(i, j, weight))[0], i, j)
                    for i in range(len(counts)) for j in range(i)), reverse=True)
    model.pairs = [(i, j) for gain, i, j in gains[:PAIRS] if gain > 0]
    model.pair_tables = [np.zeros((PAIR_BINS, PAIR_BINS)) for _ in model.pairs]
    for _ in range(PAIR_ROUNDS):
        for (i, j), table in zip(model.pairs, model.pair_tables):
            gradient, weight = step()
            leaf = RATE * _quadrants(cell(i, j, gradient), cell(i, j, weight))[1]
            table += leaf
            margin += leaf[small[i], small[j]]
    return model


@pandas_udf(ArrayType(DoubleType()))
def feature_column(texts: pd.Series) -> pd.Series:
    return pd.Series([features(t) for t in texts])


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, folds: int = 3, held: int = 1) -> AdditiveModel:
    """Learn ``labels.quality`` from at most ``max_rows`` rows of each label, chosen by a hash of the id.

    Rows whose crc32(doc_id as text) modulo ``folds`` is ``held`` and rows
    without id or label are not learned. Of the rows of a sampled document the
    one with the smallest text hash counts. Only the sample's features reach the
    driver; features are computed for the sample alone. The sample's ids (two
    times ``max_rows`` at most) are broadcast, so only its texts are dealt.
    """
    known = labels.select("doc_id", "quality").filter(
        F.col("quality").isin(0, 1) & F.coalesce(id_fold("doc_id", folds) != held, F.lit(False)))
    sample = sample_by_class(known, "quality", F.col("doc_id"), max_rows).select("doc_id", "quality")
    first = (docs.select("doc_id", "text").join(F.broadcast(sample.select("doc_id").distinct()), "doc_id", "left_semi").groupBy("doc_id")
             .agg(F.min(F.struct(F.xxhash64("text").alias("order"), "text")).alias("first")).select("doc_id", "first.text"))
    rows = first.join(sample, "doc_id").select(
        "doc_id", "quality", feature_column("text").alias("x")).toPandas().sort_values(["doc_id", "quality"], kind="stable")
    x = np.array(rows["x"].tolist(), float).reshape(len(rows), len(FEATURES))
    return train(x, rows["quality"].to_numpy(float))


def scorer(model: AdditiveModel):
    """A column function of the text: the score."""
    @pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            x = np.array([features(t) for t in texts], float).reshape(len(texts), len(FEATURES))
            yield pd.Series(model.score(x))

    return score


def classify(docs: DataFrame, labels: DataFrame, folds: int = 3, held: int = 1) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of ``docs``.

    ``score``: 0 to 1, higher where label 1 is likelier, from the whole text
    alone; null and empty texts get the score of the empty text's features.
    ``predicted``: 1 from a score of 0.5 on. ``held_out``: crc32(doc_id as
    text) modulo ``folds`` is ``held`` (a null id: true). Labels without a
    document, with null or other values are not used; repeated labels count as
    often as they stand. Without labels every score is 0.5. Repeated rows get a
    row each; an empty table gives an empty result. Other columns are not read.
    """
    score = scorer(fit(docs, labels, folds=folds, held=held))
    return docs.select(
        "doc_id", F.coalesce(id_fold("doc_id", folds) == held, F.lit(True)).alias("held_out"),
        score("text").alias("score")).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def remove_low_quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """``docs`` (doc_id, text and any other columns) without the rows that score below ``threshold``."""
    return docs.filter(scorer(fit(docs, labels))(F.col("text")) >= threshold)
