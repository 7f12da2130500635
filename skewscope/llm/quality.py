"""Quality classifier: generalised additive model with pairwise interactions.

``fit`` learns, by cyclic gradient boosting, one lookup table per binned text feature and one
per chosen feature pair: each step fits a shallow tree (depth 2 on one feature's bins, one cut
per axis for a pair) to the current gradients and adds it to that table. ``score_column`` adds the looked-up
bins of a whole Arrow batch at once. Labels come from at most ``max_rows`` labelled rows
(``SAMPLE_ROWS``, those with the least hash of doc_id); every document is scored.

Defined results: null and empty texts are scored like any other (all features 0); without
labels every score is 0.5, with one class it is the smoothed share of that class; repeated
rows get equal scores; labels rows with a null doc_id or quality are left out; when a doc_id
has several labels the largest counts.
"""

from __future__ import annotations

import math
import operator
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skewscope.llm.common import read

SAMPLE_ROWS = 20_000
MAX_BINS = 32
FEATURES = ("log_bytes", "log_words", "upper", "digit", "space", "newline", "stop", "comma", "bang", "bar",
            "symbol", "quote", "high", "word_len", "distinct_words", "same_as_previous", "distinct_pairs",
            "repeated_lines", "words_per_line", "alpha_words", "long_words", "capital_words", "ends_in_stop")
_ALPHA = re.compile(r"[^\W\d_]+[.,;:!?]?")


def text_features(text: str) -> list[float]:
    """The FEATURES of one whole text; work is linear in its length."""
    raw = text.encode("utf-8", "replace")
    n = len(raw)
    words = text.split()
    w = len(words)
    if not w:
        return [math.log1p(n)] + [0.0] * (len(FEATURES) - 1)
    hist = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    upper, lower = int(hist[65:91].sum()), int(hist[97:123].sum())
    lines = text.split("\n")
    marks = {c: int(hist[ord(c)]) / n for c in " \n.,!|"}
    symbols = (int(hist[33:48].sum() + hist[58:65].sum() + hist[91:97].sum() + hist[123:127].sum()) / n
               - marks["."] - marks[","] - marks["!"] - marks["|"])
    return [
        math.log1p(n), math.log1p(w), upper / max(1, upper + lower), int(hist[48:58].sum()) / n, marks[" "],
        marks["\n"], marks["."], marks[","], marks["!"], marks["|"], symbols, int(hist[34] + hist[39]) / n,
        int(hist[128:].sum()) / n, sum(map(len, words)) / w, len(set(words)) / w,
        sum(map(operator.eq, words, words[1:])) / w, len(set(zip(words, words[1:]))) / max(1, w - 1),
        1 - len(set(lines)) / len(lines), w / len(lines),
        sum(map(bool, map(_ALPHA.fullmatch, words))) / w, sum(len(x) > 12 for x in words) / w,
        sum(map(str.istitle, words)) / w, float(text.rstrip()[-1:] in ".!?"),
    ]


def feature_matrix(texts) -> np.ndarray:
    rows = [text_features(t or "") for t in texts]
    return np.array(rows, np.float64).reshape(len(rows), len(FEATURES))


@dataclass
class AdditiveModel:
    intercept: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, k], side="right") for k, e in enumerate(self.edges)], axis=1)

    def scores(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.intercept)
        if self.tables and len(x):
            b = self.bins(x)
            for k, t in enumerate(self.tables):
                total += t[b[:, k]]
            for (i, j), t in zip(self.pairs, self.pair_tables):
                total += t[b[:, i], b[:, j]]
        return 1.0 / (1.0 + np.exp(-np.clip(total, -30, 30)))


def _gain(g, h, reg):
    return g * g / (h + reg)


def _split(g: np.ndarray, h: np.ndarray, reg: float, least: float) -> int:
    """The cut of a run of bins with the largest gain, or 0."""
    if len(g) < 2:
        return 0
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gr, hr = g.sum() - gl, h.sum() - hl
    gain = _gain(gl, hl, reg) + _gain(gr, hr, reg) - _gain(g.sum(), h.sum(), reg)
    gain[(hl < least) | (hr < least)] = -1
    k = int(np.argmax(gain))
    return k + 1 if gain[k] > 1e-9 else 0


def _tree(g: np.ndarray, h: np.ndarray, depth: int, reg: float, least: float, out: np.ndarray) -> None:
    """Write the leaf values of a shallow tree over ordered bins into ``out``."""
    cut = _split(g, h, reg, least) if depth else 0
    if cut:
        _tree(g[:cut], h[:cut], depth - 1, reg, least, out[:cut])
        _tree(g[cut:], h[cut:], depth - 1, reg, least, out[cut:])
    else:
        out[:] = g.sum() / (h.sum() + reg)


def _quadrants(g: np.ndarray, h: np.ndarray, reg: float) -> tuple[float, np.ndarray]:
    """Best pair of cuts of a two-way table: its gain and the four leaf values."""
    cg, ch = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    tg, th = cg[-1, -1], ch[-1, -1]
    total = np.zeros_like(cg)
    parts = []
    for c, t in ((cg, tg), (ch, th)):
        row, col = c[:, -1:], c[-1:, :]
        parts.append((c, row - c, col - c, t - row - col + c))
    for a, b in zip(*parts):
        total += _gain(a, b, reg)
    total[-1, :] = total[:, -1] = -1
    i, j = np.unravel_index(int(np.argmax(total)), total.shape)
    leaf = np.zeros_like(g)
    for rows, cols in (((0, i + 1), (0, j + 1)), ((0, i + 1), (j + 1, None)), ((i + 1, None), (0, j + 1)),
                       ((i + 1, None), (j + 1, None))):
        s = (slice(*rows), slice(*cols))
        leaf[s] = g[s].sum() / (h[s].sum() + reg)
    return float(total[i, j] - _gain(tg, th, reg)), leaf


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 150, pair_rounds: int = 60, n_pairs: int = 8,
        rate: float = 0.15, reg: float = 1.0, least: float = 2.0) -> AdditiveModel:
    """Boost the tables on a bounded sample (x: rows by FEATURES, y: 0/1)."""
    pos = float(y.sum())
    base = math.log((pos + 1) / (len(y) - pos + 1))
    if len(y) == 0 or pos in (0.0, float(len(y))):
        return AdditiveModel(base)
    edges = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, MAX_BINS + 1)[1:-1])) for k in range(x.shape[1])]
    m = AdditiveModel(base, edges, [np.zeros(len(e) + 1) for e in edges])
    b = m.bins(x)
    total = np.full(len(y), base)

    def slopes():
        p = 1 / (1 + np.exp(-total))
        return y - p, np.maximum(p * (1 - p), 1e-6)

    for _ in range(rounds):
        for k, t in enumerate(m.tables):
            g, h = slopes()
            step = np.zeros_like(t)
            _tree(np.bincount(b[:, k], g, len(t)), np.bincount(b[:, k], h, len(t)), 2, reg, least, step)
            t += rate * step
            total += rate * step[b[:, k]]

    def table(i, j, v):
        shape = (len(m.tables[i]), len(m.tables[j]))
        return np.bincount(b[:, i] * shape[1] + b[:, j], v, shape[0] * shape[1]).reshape(shape)

    g, h = slopes()
    found = []
    for i in range(len(edges)):
        for j in range(i + 1, len(edges)):
            if len(edges[i]) and len(edges[j]):
                found.append((_quadrants(table(i, j, g), table(i, j, h), reg)[0], i, j))
    m.pairs = [(i, j) for _, i, j in sorted(found, reverse=True)[:n_pairs]]
    m.pair_tables = [np.zeros((len(m.tables[i]), len(m.tables[j]))) for i, j in m.pairs]
    for _ in range(pair_rounds):
        for (i, j), t in zip(m.pairs, m.pair_tables):
            g, h = slopes()
            _, leaf = _quadrants(table(i, j, g), table(i, j, h), reg)
            t += rate * leaf
            total += rate * leaf[b[:, i], b[:, j]]
    return m


def held_out(doc_id) -> F.Column:
    """True for rows that never train: crc32(doc_id as text) mod 3 is 1 (null: false)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def labelled_sample(labels: DataFrame, max_rows: int = SAMPLE_ROWS) -> DataFrame:
    """At most ``max_rows`` labelled doc_ids outside the held-out third (least hashes first)."""
    rows = (labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out(F.col("doc_id")))
            .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("quality").cast("int").alias("y")))
    n = rows.count()
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    if n > 2 * max_rows:  # few more rows than the bound meet in the final sort
        rows = rows.where(draw < int((1 << 30) * 1.5 * max_rows / n))
    return rows.orderBy(draw, "doc_id").limit(max_rows)


def train(docs: DataFrame, labels: DataFrame, max_rows: int = SAMPLE_ROWS) -> AdditiveModel:
    """Fit on the features of the sampled labelled documents; only those numbers reach the driver."""
    sample = labelled_sample(labels, max_rows)
    known = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
             .join(F.broadcast(sample), "doc_id"))  # at most max_rows rows

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            x = feature_matrix(pdf["text"])
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "y": pdf["y"], "x": list(x)})

    got = (known.mapInPandas(rows, "doc_id long, y int, x array<double>")
           .groupBy("doc_id", "y").agg(F.min("x").alias("x")).collect())
    got.sort(key=lambda r: r["doc_id"])
    x = np.array([r["x"] for r in got], np.float64).reshape(len(got), len(FEATURES))
    return fit(x, np.array([r["y"] for r in got], np.float64))


def score_column(model: AdditiveModel):
    """Pandas UDF: score of a text column."""
    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(model.scores(feature_matrix(texts)))
    return score(F.col("text"))


def score_documents(docs: DataFrame, labels: DataFrame, max_rows: int = SAMPLE_ROWS) -> DataFrame:
    """All columns of ``docs`` plus ``_llm_score``."""
    return docs.withColumn("_llm_score", score_column(train(docs, labels, max_rows)))


def op10_quality_gam(spark, sf_dir: str) -> DataFrame:
    scored = score_documents(read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "labels"))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("_llm_score").alias("score"),
                         (F.col("_llm_score") >= 0.5).cast("int").alias("predicted"))


def quality_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the classifier accepts (score of at least 0.5), with their own columns."""
    scored = score_documents(docs, read(spark, sf_dir, "labels"))
    return scored.where(F.col("_llm_score") >= 0.5).drop("_llm_score")
