"""Quality classifier: histogram gradient-boosted trees (operator 6).

Document statistics are taken from whole texts in Arrow batches. The trees are
fitted on a bounded sample of labelled rows (``max_rows``, the rows with the
smallest id hash): features are cut into at most 64 bins, split gains come from
the bins' gradient sums, and trees grow level by level. The fitted trees are
flattened into arrays (feature, threshold, left child, leaf value) that every
batch walks at once with numpy.

Defined results: a null text is an empty text and is scored; missing or unknown
labels teach nothing; with no or one class among the labels the score is the
share of label 1 (0.5 if there is none); repeated rows are each scored; an empty
table gives an empty result. Labels, language, source and id never enter a score.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.tables import Scratch, bound_batches

FEATURES = (
    "log_bytes", "log_words", "log_lines", "word_bytes", "upper", "lower", "digit", "space", "high", "comma", "stop",
    "other_punct", "top_punct", "unique_words", "repeated_next", "top_word", "shouted", "symbol_end", "symbol_words",
    "line_words", "unique_lines", "short_words", "byte_entropy", "capital_first",
)

_KIND = np.zeros(256, dtype=np.int64)  # 0 other ASCII, then the classes below
_KIND[ord("A") : ord("Z") + 1], _KIND[ord("a") : ord("z") + 1], _KIND[ord("0") : ord("9") + 1] = 1, 2, 3
_KIND[[0x20, *range(0x09, 0x0E)]], _KIND[0x80:] = 4, 5
_PUNCT = np.array([b for b in range(33, 127) if not chr(b).isalnum()])
_LETTERS = frozenset(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")
_ENDS = frozenset(b".,;:!?)\"'")


def statistics(raw: bytes) -> list[float]:
    """The values of FEATURES for one whole text."""
    n = len(raw)
    if not n:
        return [0.0] * len(FEATURES)
    counts = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    kinds = np.bincount(_KIND, weights=counts, minlength=6) / n
    punct = counts[_PUNCT] / n
    p = counts[counts > 0] / n
    words, lines = raw.split(), raw.split(b"\n")
    m = len(words)
    if m:
        tally: dict[bytes, int] = {}
        for w in words:
            tally[w] = tally.get(w, 0) + 1
        shouted = odd_end = symbols = short = capital = 0
        for w, k in tally.items():  # distinct words only
            first, last = w[0], w[-1]
            shouted += k * (w.isupper() and len(w) > 1)
            odd_end += k * (last < 128 and last not in _LETTERS and last not in _ENDS)
            symbols += k * (first < 128 and first not in _LETTERS)
            short += k * (len(w) <= 2)
            capital += k * (65 <= first <= 90)
        word_part = [
            len(tally) / m, sum(map(eq, words, words[1:])) / m, max(tally.values()) / m,
            shouted / m, odd_end / m, symbols / m, m / len(lines), len(set(lines)) / len(lines), short / m,
        ]
        capital /= m
    else:
        word_part, capital = [0.0] * 9, 0.0
    return [
        float(np.log1p(n)), float(np.log1p(m)), float(np.log1p(len(lines))), n / (m + 1),
        kinds[1], kinds[2], kinds[3], kinds[4], kinds[5],
        counts[ord(",")] / n, counts[ord(".")] / n, punct.sum() - (counts[ord(",")] + counts[ord(".")]) / n, punct.max(),
        *word_part[:6], *word_part[6:], float(-(p * np.log2(p)).sum()), capital,
    ]


def _statistics_of(texts: pa.Array) -> np.ndarray:
    raw = (t.as_buffer() for t in texts)
    return np.array([statistics(b.to_pybytes() if b is not None else b"") for b in raw], dtype=np.float64).reshape(
        len(texts), len(FEATURES)
    )


class Trees:
    """Flattened trees: node i of a tree goes to left[i] if x <= threshold[i], else to left[i] + 1."""

    def __init__(self, base: float, depth: int) -> None:
        self.base, self.depth = base, depth
        self.roots: list[int] = []
        self.feature, self.threshold, self.left, self.value = (np.zeros(0, dtype=t) for t in (np.int64, float, np.int64, float))

    def add(self, feature: list[int], threshold: list[float], left: list[int], value: list[float]) -> None:
        first = len(self.feature)
        self.roots.append(first)
        # A leaf points at itself: its threshold is infinite, so every row stays.
        to = [x + first if x >= 0 else i + first for i, x in enumerate(left)]
        self.feature = np.append(self.feature, np.array(feature, dtype=np.int64))
        self.threshold = np.append(self.threshold, threshold)
        self.left = np.append(self.left, np.array(to, dtype=np.int64))
        self.value = np.append(self.value, value)

    def score(self, x: np.ndarray) -> np.ndarray:
        out, rows = np.full(len(x), self.base), np.arange(len(x))
        for root in self.roots:
            at = np.full(len(x), root)
            for _ in range(self.depth):
                at = self.left[at] + (x[rows, self.feature[at]] > self.threshold[at])
            out += self.value[at]
        return 1 / (1 + np.exp(-out))


def fit_trees(
    x: np.ndarray, y: np.ndarray, *, n_trees: int = 80, depth: int = 4, bins: int = 64, rate: float = 0.15, least: int = 20, ridge: float = 1.0
) -> Trees:
    """Boosted trees on the log-loss from histograms of gradients."""
    share = float(y.mean()) if len(y) else 0.5
    base = float(np.log((share + 1e-6) / (1 - share + 1e-6)))
    trees = Trees(base, depth)
    if len(y) < 2 * least or share in (0.0, 1.0):
        return trees
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], axis=1)
    out = np.full(len(y), base)
    flat = binned + np.arange(x.shape[1]) * bins
    for _ in range(n_trees):
        p = 1 / (1 + np.exp(-out))
        g, h = p - y, p * (1 - p)
        node = np.zeros(len(y), dtype=np.int64)
        feature, threshold, left, value = [0], [np.inf], [-1], [0.0]
        frontier = [0]
        for level in range(depth + 1):
            grown = []
            for i in frontier:
                rows = np.flatnonzero(node == i)
                sg, sh = g[rows].sum(), h[rows].sum()
                value[i] = -rate * sg / (sh + ridge)
                if level == depth or len(rows) < 2 * least:
                    continue
                at = flat[rows].ravel()
                k = x.shape[1]
                size = k * bins
                gs, hs, ns = (
                    np.cumsum(np.bincount(at, weights=np.repeat(v, k), minlength=size).reshape(k, bins), axis=1)
                    for v in (g[rows], h[rows], np.ones(len(rows)))
                )
                gain = gs**2 / (hs + ridge) + (sg - gs) ** 2 / (sh - hs + ridge) - sg**2 / (sh + ridge)
                gain[(ns < least) | (len(rows) - ns < least)] = -np.inf
                f, b = divmod(int(gain.argmax()), bins)
                if not gain[f, b] > 1e-6 or b >= len(cuts[f]):
                    continue
                child = len(feature)
                feature[i], threshold[i], left[i] = f, float(cuts[f][b]), child
                for _ in range(2):
                    feature.append(0), threshold.append(np.inf), left.append(-1), value.append(0.0)
                node[rows] = child + (binned[rows, f] > b)
                grown += [child, child + 1]
            frontier = grown
        trees.add(feature, threshold, left, value)
        out += np.array(value)[node]
    return trees


def document_statistics(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, stats): one row per row of ``docs``."""

    bound_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = _statistics_of(batch.column(1))
            stats = pa.ListArray.from_arrays(
                pa.array(np.arange(len(values) + 1) * len(FEATURES), type=pa.int32()), pa.array(values.ravel(), type=pa.float64())
            )
            yield pa.RecordBatch.from_arrays([batch.column(0), stats], ["doc_id", "stats"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, stats array<double>")


def is_held_out(id_column: F.Column) -> F.Column:
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit_on(stats: DataFrame, labels: DataFrame, *, max_rows: int = 20_000) -> Trees:
    """Fits on at most ``max_rows`` labelled rows that are not held out."""
    marks = labels.where(F.col("quality").isin(0, 1) & ~is_held_out(F.col("doc_id"))).select("doc_id", "quality")
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40))
    taught = stats.join(marks, "doc_id").select(place.alias("place"), "doc_id", "quality", "stats")
    # Each task sends the driver its share of the sample only, however many tasks there are.
    share = 1.5 * max_rows / max(1, taught.count())
    taught = taught.where(F.col("place") < int(min(1.0, share) * (1 << 40)))
    rows = taught.orderBy("place", "doc_id", "quality").limit(max_rows).select("quality", "stats").toPandas()
    x = np.array(rows["stats"].tolist(), dtype=np.float64).reshape(len(rows), len(FEATURES))
    return fit_trees(x, rows["quality"].to_numpy(dtype=np.float64))


def score_statistics(stats: DataFrame, trees: Trees) -> DataFrame:
    """(doc_id, score) from (doc_id, stats)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(1)
            x = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(trees.score(x))], ["doc_id", "score"])

    return stats.mapInArrow(run, "doc_id long, score double")


def classify(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", max_rows: int = 20_000) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``."""
    scratch = Scratch(docs.sparkSession, "quality")
    stats = scratch.write(document_statistics(docs, id_col=id_col, text_col=text_col), "statistics")
    scored = score_statistics(stats, fit_on(stats, labels, max_rows=max_rows))
    return scored.select(
        "doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def keep_good(docs: DataFrame, labels: DataFrame, *, text_col: str = "text", max_rows: int = 20_000) -> DataFrame:
    """The rows of ``docs`` that the classifier predicts to be good.

    The whole rows pass through the scoring batches, so no join on ids is needed.
    """
    marked = labels.where(F.col("quality").isin(0, 1) & ~is_held_out(F.col("doc_id"))).select("doc_id").distinct()
    scratch = Scratch(docs.sparkSession, "quality")
    # Only labels of rows that are here count for the share; the ids alone are compared.
    marked = scratch.write(marked.join(docs.select("doc_id").distinct(), "doc_id", "left_semi"), "marked")
    # Texts stay where they are: at most 2 * max_rows ids are sent to them.
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40))
    share = 2.0 * max_rows / max(1, marked.count())
    ids = marked.where(place < int(min(1.0, share) * (1 << 40))).orderBy(place, "doc_id").limit(2 * max_rows)
    ids = scratch.write(ids, "ids")
    scratch.drop(marked)
    known = docs.join(F.broadcast(ids), "doc_id", "left_semi")
    taught = scratch.write(document_statistics(known, text_col=text_col), "taught")
    trees = fit_on(taught, labels, max_rows=max_rows)
    scratch.drop(taught)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                yield batch.filter(pa.array(trees.score(_statistics_of(batch.column(at))) >= 0.5))

    return docs.mapInArrow(run, docs.schema)
