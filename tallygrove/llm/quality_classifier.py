"""Quality classifier: regularised quadratic discriminant over document statistics.

The statistics of a text are transformed towards normal shape.  Sums of the
labelled rows, gathered by Spark, give a mean and a covariance per class.  Each
covariance is shrunk towards the pooled one and towards a multiple of the unit
matrix; its Cholesky factor is computed once and travels with the model.  The
log-density difference of the classes, by Mahalanobis distances, is mapped to
a score between 0 and 1.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallygrove.llm.shared import in_pieces, map_texts, row_key, staged, text_of, type_of, without

ACCEPT = 0.7
# Shrinkage of a class covariance: towards the pooled one, then towards the unit matrix.
TO_POOLED, TO_UNIT = 0.02, 0.005

FEATURES = (
    "log_words", "log_word_bytes", "letters", "capitals", "digits", "symbols", "marks",
    "stops", "log_line_words", "variety", "most_common", "doubled", "byte_entropy",
    "spread_of_lengths", "short_words",
)

_CLASS = np.zeros((8, 256))
for _row, _bytes in enumerate(
    (
        b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ" + bytes(range(128, 256)),
        b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
        b"0123456789",
        b"#*$%&|<>=~^_@\\{}[]",
        b"!?\"'():;-/+`",
        b".,",
        b" \t\n\r\x0b\x0c",
        b"abcdefghijklmnopqrstuvwxyz",
    )
):
    _CLASS[_row, list(_bytes)] = 1


# Every statistic is taken as if so many typical words were added, so that a short
# text is not odd for being short.  The typical values are round figures.
ADDED_WORDS = 20.0
_ADDED_BYTES, _WORD_BYTES, _LINE_WORDS, _ENTROPY, _SPREAD = 5 * ADDED_WORDS, 5.0, 30.0, 2.9, 3.0


def _share(part: float, whole: float, typical: float, added: float) -> float:
    """Arc-sine root of a share, after ``added`` of the typical share; 1 at most.

    Marks are counted against words, so a part may exceed its whole.
    """
    return float(np.arcsin(np.sqrt(min(1.0, (part + added * typical) / (whole + added)))))


def statistics(text: str | None) -> list[float]:
    """The transformed statistics of a text; all finite, also for an empty one."""
    data = (text or "").encode("utf-8", "surrogatepass")
    bytes_ = np.bincount(np.frombuffer(data, dtype=np.uint8), minlength=256)
    letters, capitals, digits, symbols, marks, stops, spaces, small = _CLASS @ bytes_
    solid = len(data) - spaces
    words = data.split()
    n = len(words)
    lines = sum(1 for x in data.split(b"\n") if x.strip())
    places: dict[bytes, int] = {}
    codes = np.fromiter((places.setdefault(w, len(places)) for w in words), np.int64, n)
    most = np.bincount(codes).max() if n else 0
    doubled = np.count_nonzero(codes[1:] == codes[:-1])
    sizes = np.fromiter(map(len, words), np.float64, n)
    share = bytes_[bytes_ > 0] / max(1, len(data))
    entropy = -(share * np.log(share)).sum() * len(data) + _ADDED_BYTES * _ENTROPY
    spread = (sizes.std() * n if n else 0.0) + ADDED_WORDS * _SPREAD
    total = n + ADDED_WORDS
    return [
        float(np.log1p(n)),
        float(np.log1p((solid + ADDED_WORDS * _WORD_BYTES) / total)),
        _share(letters, solid, 0.95, _ADDED_BYTES),
        _share(capitals, capitals + small, 0.05, _ADDED_BYTES),
        _share(digits, solid, 0.01, _ADDED_BYTES),
        _share(symbols, solid, 0.005, _ADDED_BYTES),
        _share(marks, solid, 0.005, _ADDED_BYTES),
        _share(stops, n, 0.15, ADDED_WORDS),
        float(np.log1p(total / (max(1, lines) + ADDED_WORDS / _LINE_WORDS))),
        float(np.log1p(len(places) + ADDED_WORDS) / np.log1p(total)),
        _share(most, n, 0.06, ADDED_WORDS),
        _share(doubled, n, 0.005, ADDED_WORDS),
        float(entropy / (len(data) + _ADDED_BYTES)),
        float(np.log1p(spread / total)),
        _share(np.count_nonzero(sizes <= 3), n, 0.35, ADDED_WORDS),
    ]


@dataclass(frozen=True)
class Model:
    """Means, Cholesky factors and log determinants per class, and the map to a score.

    Without labels of both kinds there is nothing to compare; ``constant`` is
    then the score of every text.
    """

    means: np.ndarray
    factors: np.ndarray
    log_dets: np.ndarray
    slope: float = 1.0
    offset: float = 0.0
    constant: float | None = None

    def difference(self, x: np.ndarray) -> np.ndarray:
        """Log density as accepted less log density as rejected, per row."""
        parts = []
        for mean, factor, log_det in zip(self.means, self.factors, self.log_dets, strict=True):
            z = np.linalg.solve(factor, (x - mean).T)
            parts.append(-0.5 * ((z * z).sum(axis=0) + log_det))
        return parts[1] - parts[0]

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        raw = self.slope * np.arcsinh(self.difference(x)) + self.offset
        return 1.0 / (1.0 + np.exp(-raw))


def shrunk(sums: dict[int, tuple[float, np.ndarray, np.ndarray]]) -> Model:
    """The model of {class: (rows, sums, sums of products)}, without the map to a score."""
    width = len(FEATURES)
    covers, means, rows = [], [], []
    for c in (0, 1):
        n, total, products = sums[c]
        mean = total / n
        covers.append(products / n - np.outer(mean, mean))
        means.append(mean)
        rows.append(n)
    pooled = (covers[0] * rows[0] + covers[1] * rows[1]) / sum(rows)
    scale = np.sqrt(np.maximum(np.diag(pooled), 1e-6))
    factors = []
    for cover in covers:
        mixed = ((1 - TO_POOLED) * cover + TO_POOLED * pooled) / np.outer(scale, scale)
        level = max(np.trace(mixed) / width, 1e-3)
        mixed = (1 - TO_UNIT) * mixed + TO_UNIT * level * np.eye(width)
        factors.append(np.linalg.cholesky(mixed * np.outer(scale, scale)))
    dets = [2 * np.log(np.diag(f)).sum() for f in factors]
    return Model(np.array(means), np.array(factors), np.array(dets))


def calibrated(x: np.ndarray, label: np.ndarray, weight: np.ndarray, ridge: float = 1e-4) -> tuple[float, float]:
    """Slope and offset of a ridge logistic regression of weighted labels on one value.

    Both classes weigh the same, so that a rare class is not lost.
    """
    weight = weight / np.where(label == 1, weight[label == 1].sum(), weight[label == 0].sum())
    beta = np.zeros(2)
    design = np.column_stack([x, np.ones(len(x))])
    for _ in range(100):
        p = 1.0 / (1.0 + np.exp(-np.clip(design @ beta, -40, 40)))
        slope = design.T @ (weight * (p - label)) + ridge * beta
        curve = (design * (weight * p * (1 - p))[:, None]).T @ design + ridge * np.eye(2)
        step = np.linalg.solve(curve, slope)
        beta -= step * min(1.0, 4.0 / max(1e-12, np.abs(step).max()))
        if np.abs(step).max() < 1e-10:
            break
    return float(beta[0]), float(beta[1])


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``key``, ``id`` and ``x`` (the statistics) of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in in_pieces(batches, 2):
            flat = np.array([statistics(t) for t in piece.column(2).to_pylist()]).ravel()
            ends = pa.array(np.arange(piece.num_rows + 1, dtype=np.int32) * len(FEATURES))
            lists = pa.ListArray.from_arrays(ends, pa.array(flat, pa.float64()))
            yield pa.RecordBatch.from_arrays([piece.column(0), piece.column(1), lists], ["key", "id", "x"])

    rows = docs.select(
        row_key(docs, id_col, text_col).alias("key"), docs[id_col].alias("id"), text_of(docs, text_col).alias("text")
    )
    return map_texts(rows, run, f"key string, id {type_of(docs, id_col)}, x array<double>")


def _matrix(lists: pa.Array) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))


def _sums(labelled: DataFrame) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
    """Per class: rows, sums and sums of products of the statistics, added up by Spark."""
    width = len(FEATURES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds, totals = [], []
        for batch in batches:
            label, x = batch.column(0).to_numpy(zero_copy_only=False), _matrix(batch.column(1))
            for c in (0, 1):
                own = x[label == c]
                kinds.append(c)
                totals.append(np.concatenate([[len(own)], own.sum(axis=0), (own.T @ own).ravel()]).tolist())
        yield pa.RecordBatch.from_arrays(
            [pa.array(kinds, pa.int32()), pa.array(totals, pa.list_(pa.float64()))], ["label", "totals"]
        )

    parts = labelled.select("label", "x").mapInArrow(run, "label int, totals array<double>")
    added = parts.select("label", F.posexplode("totals").alias("at", "part")).groupBy("label", "at").agg(F.sum("part").alias("total"))
    vectors = {c: np.zeros(1 + width + width * width) for c in (0, 1)}
    for row in added.collect():  # as many rows as the model has numbers
        vectors[row.label][row.at] = row.total
    return {c: (v[0], v[1 : 1 + width], v[1 + width :].reshape(width, width)) for c, v in vectors.items()}


def _bins(labelled: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Labelled rows counted by the hundredths of the difference's inverse hyperbolic sine."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins = np.round(np.arcsinh(model.difference(_matrix(batch.column(1)))) * 100).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bins)], ["label", "bin"])

    counted = labelled.select("label", "x").mapInArrow(run, "label int, bin bigint").groupBy("label", "bin").count()
    rows = counted.collect()  # a few thousand bins at most
    return tuple(np.array([f(r) for r in rows], dtype=float) for f in (lambda r: r.bin / 100, lambda r: r.label, lambda r: r["count"]))


def fit(labelled: DataFrame) -> Model:
    """The model of rows with ``label`` (0 or 1) and ``x``; all rows count."""
    sums = _sums(labelled)
    if min(n for n, *_ in sums.values()) < 1:
        model = Model(np.empty(0), np.empty(0), np.empty(0))
        return Model(model.means, model.factors, model.log_dets, constant=float(sums[1][0] >= sums[0][0]))
    model = shrunk(sums)
    slope, offset = calibrated(*_bins(labelled, model))
    return Model(model.means, model.factors, model.log_dets, slope, offset)


def held_out(id_column: Column) -> Column:
    """Rows that never teach: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def classify(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
) -> DataFrame:
    """One row per document: key, id, held_out, score, predicted.

    The labels are joined by id; null labels and labels other than 0 and 1
    teach nothing, and of several for one id the least counts.  Rows with a
    null id are scored but teach nothing.  Null and empty texts are scored by
    the statistics of an empty text.  With labels of one kind only, or none,
    all scores are that kind, or 1.  Scores depend on the text alone.
    """
    stats = staged(features(docs, id_col, text_col), "features")
    wanted = labels.filter(labels[label_col].isin(0, 1))
    wanted = wanted.groupBy(wanted[id_col].alias("of")).agg(F.min(label_col).cast("int").alias("label"))
    taught = stats.filter(~held_out(F.col("id"))).join(wanted, F.col("id") == F.col("of"))
    model = fit(staged(taught.select("label", "x"), "labelled"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = pa.array(model.score(_matrix(batch.column(2))))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), scores], ["key", "id", "score"])

    scored = stats.mapInArrow(run, f"key string, id {type_of(docs, id_col)}, score double")
    return scored.select(
        "key", "id", held_out(F.col("id")).alias("held_out"), "score",
        (F.col("score") >= ACCEPT).cast("int").alias("predicted"),
    )


def keep_accepted(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality"
) -> DataFrame:
    """The documents without those that the classifier rejects; columns and texts stay."""
    verdicts = classify(docs, labels, id_col, text_col, label_col)
    return without(docs, verdicts.filter("predicted = 0").select("key"), id_col, text_col)
