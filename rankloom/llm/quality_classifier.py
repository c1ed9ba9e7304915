"""Quality classifier: a generalised additive model with pairwise interactions.

Features of a text are counts and ratios of its bytes, words and lines, worked out for many texts at once. Training is
cyclic: round after round, each feature in turn fits a shallow tree over its bins to the gradient of the log loss and
adds a fraction of it to that feature's lookup table; then the pairs whose coarse grid explains most of what is left
get tables of two features, boosted the same way. A score adds one entry per table, as array indexing over a batch.

The model is fitted on the driver from at most `max_rows` labelled rows (a parameter; those of least hash of doc_id,
so the choice is the same at any size); every document is scored. Tables have a fixed size and are sent with the task.

Defined cases: null text is empty; an empty text has a score like any other. Labels that are null are not used.
Without labels, or with one class only, every score is the smoothed share of label 1. Repeated rows are each scored;
a doc_id with several labels teaches each of them. Empty tables give no rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import bytes_ops
from .columns import pick
from ..shipping import map_arrow

FEATURES = (
    "log_words", "word_length", "upper", "symbols", "bangs", "bars", "digits", "stops", "lines", "high_bytes",
    "distinct_words", "repeated_lines", "symbol_words", "top_word", "other_ascii", "longest_word",
)
MAX_ROWS = 20_000
CUT = 0.7


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """float32, one row per text."""
    n = len(offsets) - 1
    sizes = np.diff(offsets)
    row = np.repeat(np.arange(n), sizes)
    counts = np.bincount(row * 256 + data, minlength=n * 256).reshape(n, 256).astype(np.float64)
    starts, ends, before = bytes_ops.words(data, offsets)
    n_words = np.diff(before)
    w = np.maximum(n_words, 1)
    total = np.maximum(sizes, 1)
    of = lambda chars: counts[:, [ord(c) for c in chars]].sum(1)
    upper, lower, digits = counts[:, 65:91].sum(1), counts[:, 97:123].sum(1), counts[:, 48:58].sum(1)
    high, control = counts[:, 128:].sum(1), counts[:, :33].sum(1)
    symbols, stops = of("#*$%&|<>"), of(".,;:?")
    hashed = bytes_ops.RangeHash(data)
    word_row = np.repeat(np.arange(n), n_words)
    # Distinct words and the share of the most common one, from sorted (row, hash) pairs.
    distinct, top = np.zeros(n), np.zeros(n)
    longest = np.zeros(n)
    if len(starts):
        h = hashed(starts, ends)
        order = np.lexsort((h, word_row))
        hs, rs = h[order], word_row[order]
        new = np.r_[True, (hs[1:] != hs[:-1]) | (rs[1:] != rs[:-1])]
        at = np.flatnonzero(new)
        run = np.diff(np.r_[at, len(hs)])
        distinct = np.bincount(rs[at], minlength=n).astype(np.float64)
        np.maximum.at(top, rs[at], run)
        np.maximum.at(longest, word_row, ends - starts)
    last = data[ends - 1] if len(ends) else data[:0]
    marked = np.isin(last, np.frombuffer(b"#*$%&|<>!", np.uint8))
    symbol_words = np.bincount(word_row[marked], minlength=n)
    # Lines: pieces between newlines and row ends that hold a word.
    cuts = np.unique(np.concatenate([offsets, np.flatnonzero(data == 10) + 1]))
    a, b = cuts[:-1], cuts[1:]
    ended = (b > 0) & (data[np.maximum(b - 1, 0)] == 10) if len(data) else np.zeros(len(a), bool)
    b = b - ended
    filled = np.searchsorted(starts, b) > np.searchsorted(starts, a)
    a, b = a[filled], b[filled]
    line_row = np.searchsorted(offsets, a, "right") - 1
    repeated = np.zeros(n)
    n_lines = np.bincount(line_row, minlength=n)
    if len(a):
        h = hashed(a, b)
        order = np.lexsort((h, line_row))
        same = (h[order][1:] == h[order][:-1]) & (line_row[order][1:] == line_row[order][:-1])
        repeated = np.bincount(line_row[order][1:][same], minlength=n)
    out = np.stack(
        [
            np.log1p(n_words), np.bincount(word_row, ends - starts, n) / w, upper / np.maximum(upper + lower, 1), symbols / w, of("!") / w, of("|") / w, digits / total,
            stops / w, n_lines / w, high / total, distinct / w, repeated / np.maximum(n_lines, 1), symbol_words / w, top / w,
            (total - upper - lower - digits - high - control - symbols - stops - of("!")) / total, longest,
        ],
        1,
    )
    return out.astype(np.float32)


@dataclass
class Model:
    """edges[f]: bin limits; tables[f]: addend of each bin; pairs: (f, g, table of coarse bins)."""

    base: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    coarse: list[np.ndarray]
    pairs: list[tuple[int, int, np.ndarray]]

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.base)
        for f, (e, t) in enumerate(zip(self.edges, self.tables)):
            z += t[np.searchsorted(e, x[:, f], "right")]
        for f, g, t in self.pairs:
            z += t[np.searchsorted(self.coarse[f], x[:, f], "right"), np.searchsorted(self.coarse[g], x[:, g], "right")]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _edges(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1]).astype(np.float32)) if len(x) else np.zeros(0, np.float32)


def _best_cut(g: np.ndarray, h: np.ndarray, penalty: float) -> tuple[float, int]:
    """Gain and place of the best cut of bins in two."""
    cg, ch = np.cumsum(g), np.cumsum(h)
    left = cg[:-1] ** 2 / (ch[:-1] + penalty)
    right = (cg[-1] - cg[:-1]) ** 2 / (ch[-1] - ch[:-1] + penalty)
    gain = left + right - cg[-1] ** 2 / (ch[-1] + penalty)
    k = int(np.argmax(gain))
    return float(gain[k]), k + 1


def _tree(g: np.ndarray, h: np.ndarray, penalty: float, leaves: int = 3) -> np.ndarray:
    """A tree of a few leaves over ordered bins, as the value of each bin."""
    parts = [(0, len(g))]
    while len(parts) < leaves:
        best = max(((*_best_cut(g[a:b], h[a:b], penalty), k) for k, (a, b) in enumerate(parts) if b - a > 1), default=None)
        if best is None or best[0] <= 1e-12:
            break
        _, cut, k = best
        a, b = parts[k]
        parts[k : k + 1] = [(a, a + cut), (a + cut, b)]
    out = np.zeros(len(g))
    for a, b in parts:
        out[a:b] = g[a:b].sum() / (h[a:b].sum() + penalty)
    return out


def fit(x: np.ndarray, y: np.ndarray, bins: int = 64, rounds: int = 200, rate: float = 0.1, penalty: float = 2.0, n_pairs: int = 5, coarse_bins: int = 8) -> Model:
    n, m = x.shape if len(x) else (0, len(FEATURES))
    share = (y.sum() + 1) / (n + 2)
    base = float(np.log(share / (1 - share)))
    edges = [_edges(x[:, f], bins) if n else np.zeros(0, np.float32) for f in range(m)]
    coarse = [_edges(x[:, f], coarse_bins) if n else np.zeros(0, np.float32) for f in range(m)]
    tables = [np.zeros(len(e) + 1) for e in edges]
    model = Model(base, edges, tables, coarse, [])
    if n == 0 or y.min() == y.max():
        return model
    at = [np.searchsorted(e, x[:, f], "right") for f, e in enumerate(edges)]
    z = np.full(n, base)
    for _ in range(rounds):
        for f in range(m):
            p = 1 / (1 + np.exp(-z))
            size = len(tables[f])
            if size == 1:
                continue
            step = rate * _tree(np.bincount(at[f], y - p, size), np.bincount(at[f], p * (1 - p), size), penalty)
            tables[f] += step
            z += step[at[f]]
    c = [np.searchsorted(e, x[:, f], "right") for f, e in enumerate(coarse)]
    p = 1 / (1 + np.exp(-z))

    def grid(f: int, g: int) -> tuple[np.ndarray, np.ndarray]:
        k, size = c[f] * (len(coarse[g]) + 1) + c[g], (len(coarse[f]) + 1) * (len(coarse[g]) + 1)
        shape = (len(coarse[f]) + 1, len(coarse[g]) + 1)
        return np.bincount(k, y - p, size).reshape(shape), np.bincount(k, p * (1 - p), size).reshape(shape)

    def gain(f: int, g: int) -> float:
        a, b = grid(f, g)
        return float((a**2 / (b + penalty)).sum() - (a.sum(1) ** 2 / (b.sum(1) + penalty)).sum() - (a.sum(0) ** 2 / (b.sum(0) + penalty)).sum())

    chosen = sorted(((gain(f, g), f, g) for f in range(m) for g in range(f) if len(coarse[f]) and len(coarse[g])), reverse=True)[:n_pairs]
    pairs = [(f, g, np.zeros((len(coarse[f]) + 1, len(coarse[g]) + 1))) for _, f, g in chosen]
    for _ in range(rounds // 4):
        for f, g, t in pairs:
            p = 1 / (1 + np.exp(-z))
            a, b = grid(f, g)
            # A tree of depth two: the better axis is cut first, then each side along the other.
            (gain_f, cut_f), (gain_g, cut_g) = (_best_cut(a.sum(k), b.sum(k), penalty) for k in (1, 0))
            step = np.zeros_like(t)
            sides = [(slice(None, cut_f), slice(None)), (slice(cut_f, None), slice(None))] if gain_f >= gain_g else [(slice(None), slice(None, cut_g)), (slice(None), slice(cut_g, None))]
            for s in sides:
                along = 0 if gain_f >= gain_g else 1
                fitted = _tree(a[s].sum(along), b[s].sum(along), penalty, 2)
                step[s] = fitted[None, :] if along == 0 else fitted[:, None]
            t += rate * step
            z += rate * step[c[f], c[g]]
    model.pairs = pairs
    return model


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _featured(documents: DataFrame) -> DataFrame:
    """doc_id, quality and h as they are, x (array of floats) for the text."""
    kind = documents.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _batch_features(batch.column("text"))
            values = pa.FixedSizeListArray.from_arrays(pa.array(x.reshape(-1)), len(FEATURES)).cast(pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "quality", "h")), values], names=["doc_id", "quality", "h", "x"])

    return map_arrow(documents.select("doc_id", "quality", "h", "text"), run, f"doc_id {kind}, quality int, h bigint, x array<float>")


def _batch_features(column: pa.Array) -> np.ndarray:
    parts = [features(data, offsets) for _, data, offsets in bytes_ops.slices(column)]
    return np.concatenate(parts) if parts else np.zeros((0, len(FEATURES)), np.float32)


def train(documents: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, **settings) -> Model:
    """A model of the labelled rows of least hash, max_rows at most. Labels up to a hash that leaves a little more than
    max_rows go to the documents (2 max_rows at most, 20 bytes each), so features are made of these texts only."""
    known = pick(labels, "doc_id", "quality").filter("quality is not null").filter(~held_out(F.col("doc_id")))
    known = known.select("doc_id", F.col("quality").cast("int").alias("quality"), F.xxhash64("doc_id").alias("h"))
    n = known.count()
    if n > 2 * max_rows:
        known = known.filter(F.col("h") <= int(-(2**63) + 2**64 * (1.2 * max_rows / n)))
    rows = _featured(pick(documents, "doc_id", "text").join(F.broadcast(known), "doc_id"))
    rows = rows.orderBy("h", "doc_id", "quality").limit(max_rows).toPandas()
    x = np.array(rows["x"].tolist(), np.float32).reshape(len(rows), len(FEATURES))
    return fit(x, rows["quality"].to_numpy(np.float64), **settings)


def _scores(frame: DataFrame, model: Model, text: str) -> DataFrame:
    """frame with a score of its column of text."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _batch_features(batch.column(text))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(model.score(x))], names=[*batch.schema.names, "score_"])

    return map_arrow(frame, run, f"{fields}, score_ double")


def score_documents(documents: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted for every row."""
    scored = _scores(pick(documents, "doc_id", "text"), train(documents, labels, max_rows), "text")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("score_").alias("score"), (F.col("score_") >= CUT).cast("int").alias("predicted"))


def keep_good(documents: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, cut: float = CUT) -> DataFrame:
    """Rows of documents whose score reaches cut, with the same columns."""
    model = train(documents, labels, max_rows)
    plain = documents.toDF(*[f"k_{i}" for i in range(len(documents.columns))])
    lower = [c.lower() for c in documents.columns]
    scored = _scores(plain, model, f"k_{lower.index('text')}").filter(F.col("score_") >= cut).drop("score_")
    return scored.toDF(*documents.columns)


def op4_quality_classifier(spark, sf_dir: str) -> DataFrame:
    return score_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
