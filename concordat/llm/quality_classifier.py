"""Quality classifier: regularised quadratic discriminant over document statistics."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from concordat.llm.shared import saved

FEATURES = (
    "words", "symbols", "marks", "capitals", "bars", "word_length", "variety", "duplicate_lines", "digits", "line_words", "stops", "odd_words",
)
#: Weight of the shared diagonal in a class covariance, and the variance every direction has at least.
SHRINKAGE, FLOOR = 0.15, 0.02
#: Log-density differences are divided by this before they become a probability.
TEMPERATURE = 4.0
ACCEPT = 0.7

_SYMBOLS, _MARKS, _STOPS = (np.frombuffer(x, np.uint8) for x in (b"#*$%&|<>", b"!?", b".,;:"))
_DIGITS, _CAPITALS, _SMALL = np.arange(48, 58), np.arange(65, 91), np.arange(97, 123)


def statistics_of(text: str | None) -> list[float]:
    """Transformed statistics of one whole text; a null text counts as empty."""
    data = (text or "").encode()
    seen = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    words = data.split()
    n, letters = max(1, len(words)), max(1, seen[_CAPITALS].sum() + seen[_SMALL].sum())
    lines = [x for x in data.split(b"\n") if x.strip()]
    share = lambda x, of: float(np.log1p(100.0 * x / of))
    distinct = set(words)
    return [
        float(np.log1p(len(words))),
        share(seen[_SYMBOLS].sum(), n),
        share(seen[_MARKS].sum(), n),
        share(seen[_CAPITALS].sum(), letters),
        share(seen[124], n),
        float(np.log1p(sum(map(len, words)) / n)),
        float(np.log1p(len(distinct)) / np.log1p(n)),
        share(len(lines) - len(set(lines)), max(1, len(lines))),
        share(seen[_DIGITS].sum(), n),
        float(np.log1p(len(words) / max(1, len(lines)))),
        share(seen[_STOPS].sum(), n),
        share(sum(not w[:1].isalpha() and w[0] < 128 for w in words), n),
    ]


def featured(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``features`` of every document; texts are read whole and not passed on."""
    kind = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("features", T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [statistics_of(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.list_(pa.float64()))], ["doc_id", "features"])

    return docs.select("doc_id", "text").mapInArrow(run, kind)


@dataclass
class Discriminant:
    """Class means, log priors and Cholesky factors of the class covariances, in standard units."""

    centre: np.ndarray
    scale: np.ndarray
    means: np.ndarray
    factors: np.ndarray
    offsets: np.ndarray

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        """Log-density difference of class 1 and class 0, priors included, for rows of features."""
        z = (x - self.centre) / self.scale
        density = []
        for mean, factor, offset in zip(self.means, self.factors, self.offsets, strict=True):
            y = np.linalg.solve(factor, (z - mean).T)
            density.append(offset - 0.5 * (y * y).sum(axis=0))
        return density[1] - density[0]

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.log_odds(x) / TEMPERATURE, -500, 500)))


def solve(moments: dict[int, tuple[float, np.ndarray, np.ndarray]]) -> Discriminant:
    """Fit from each class's count, sum and sum of outer products.

    A class covariance is shrunk towards the diagonal of the pooled one, which keeps its Cholesky
    factor well conditioned.  A class without rows takes the other's place, so that the score is 1/2.
    """
    d = len(FEATURES)
    n = np.array([moments.get(c, (0, 0, 0))[0] for c in (0, 1)], float)
    if not n.all():
        one = (1.0, np.zeros(d), np.eye(d)) if not n.any() else moments[int(n[1] > 0)]
        moments, n = {0: one, 1: one}, np.array([one[0], one[0]], float)
    mean = np.stack([moments[c][1] / n[c] for c in (0, 1)])
    cov = np.stack([moments[c][2] / n[c] - np.outer(mean[c], mean[c]) for c in (0, 1)])
    total = n.sum()
    centre = (n[:, None] * mean).sum(axis=0) / total
    spread = sum(n[c] * (np.diag(cov[c]) + (mean[c] - centre) ** 2) for c in (0, 1)) / total
    scale = np.sqrt(np.maximum(spread, 1e-6))
    cov = cov / np.outer(scale, scale)
    pooled = (n[:, None, None] * cov).sum(axis=0) / total
    factors, offsets = [], []
    for c in (0, 1):
        shrunk = (1 - SHRINKAGE) * cov[c] + SHRINKAGE * np.diag(np.diag(pooled)) + FLOOR * np.eye(d)
        factor = np.linalg.cholesky(shrunk)
        factors.append(factor)
        offsets.append(np.log(n[c] / total) - np.log(np.diag(factor)).sum())
    return Discriminant(centre, scale, (mean - centre) / scale, np.stack(factors), np.array(offsets))


def fit(examples: DataFrame) -> Discriminant:
    """Fit on all rows of ``features`` and ``label`` (0 or 1; others are left out).

    Tasks sum counts, features and outer products by label; the driver gets one row of fixed size
    for each task and label and adds them up.
    """
    d = len(FEATURES)
    kind = "label int, n double, sums array<double>, products array<double>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {c: [0.0, np.zeros(d), np.zeros((d, d))] for c in (0, 1)}
        for batch in batches:
            x = np.asarray(batch.column("features").flatten()).reshape(-1, d)
            label = np.asarray(batch.column("label"))
            for c, t in total.items():
                mine = x[label == c]
                t[0], t[1], t[2] = t[0] + len(mine), t[1] + mine.sum(axis=0), t[2] + mine.T @ mine
        columns = [[c for c in total], [t[0] for t in total.values()], [t[1] for t in total.values()], [t[2].ravel() for t in total.values()]]
        kinds = [pa.int32(), pa.float64(), pa.list_(pa.float64()), pa.list_(pa.float64())]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["label", "n", "sums", "products"])

    known = examples.where(F.col("label").isin(0, 1) & F.col("features").isNotNull()).select("features", F.col("label").cast("int"))
    parts = known.mapInArrow(run, kind)
    add = lambda name, size: F.array(*[F.sum(F.get(name, F.lit(i))) for i in range(size)]).alias(name)
    rows = parts.groupBy("label").agg(F.sum("n").alias("n"), add("sums", d), add("products", d * d)).where("n > 0").collect()
    return solve({r["label"]: (r["n"], np.array(r["sums"]), np.array(r["products"]).reshape(d, d)) for r in rows})


def held_out(doc_id: Column) -> Column:
    """Rows that no label is learnt from: the CRC-32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learn(features: DataFrame, labels: DataFrame) -> Discriminant:
    """Fit on the labelled documents that are not held out.

    A document labelled several times counts once for each label; null labels and ids are left out.
    """
    known = labels.select(F.col("doc_id").alias("labelled_id"), F.col("quality").alias("label")).where(~held_out(F.col("labelled_id")))
    return fit(features.join(known, features["doc_id"] == known["labelled_id"]).select("features", "label"))


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Score every document; returns ``doc_id``, ``held_out``, ``score`` and ``predicted``.

    The score, from 0 to 1, says how likely label 1 is by the text alone.  Null and empty texts are
    scored as texts without words.  A null id is not held out and has no label.  Repeated rows are
    scored one by one.  Without labels every score is one half.  Other columns are not looked at.
    """
    features = saved(featured(docs))
    model = learn(features, labels)
    kind = T.StructType([features.schema["doc_id"], T.StructField("held_out", T.BooleanType()), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.asarray(batch.column("features").flatten()).reshape(-1, len(FEATURES))
            found = pa.array(model.score(x) if len(x) else [], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), found], kind.names)

    scored = features.withColumn("held_out", held_out(F.col("doc_id"))).mapInArrow(run, kind)
    return scored.withColumn("predicted", (F.col("score") >= ACCEPT).cast("int"))


def keep(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text is not rejected, with all their columns as they are."""
    model = learn(saved(featured(docs)), labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [statistics_of(t) for t in batch.column("text").to_pylist()]
            good = model.score(np.array(found)) >= ACCEPT if found else np.zeros(0, bool)
            yield batch.filter(pa.array(good, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
