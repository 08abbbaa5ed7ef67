"""Compression classifier of text quality.

Two zstandard dictionaries are built, one from texts labelled good and one from texts labelled bad. A text that
resembles the good ones compresses better with the good dictionary. The difference of both compressed sizes,
per byte of text, becomes a score between 0 and 1 by a logistic curve fitted on other labelled texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from .common import as_bytes, crc_remainder, small_batches

#: Labelled texts of each class that a fit uses at most (half for the dictionaries, half for the curve), and their
#: bytes at most. They are whole texts, chosen by a hash of the id.
SAMPLE_PER_CLASS = 3000
SAMPLE_BYTES = 24 << 20
DICTIONARY_BYTES = 112 << 10
#: Texts are compressed in pieces of this size, so that in a long text the dictionary still counts.
PIECE_BYTES = 2048
LEVEL = 3
_RIDGE = 1e-3


@dataclass(frozen=True)
class QualityModel:
    good: bytes
    bad: bytes
    #: Intercept, then one weight for each value of ``_features``.
    weights: tuple[float, ...]
    level: int = LEVEL
    piece: int = PIECE_BYTES


def _coder(dictionary: bytes, level: int) -> zstandard.ZstdCompressor:
    shared = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_AUTO)
    shared.precompute_compress(level=level)
    return zstandard.ZstdCompressor(
        dict_data=shared, write_checksum=False, write_content_size=False, write_dict_id=False
    )


def _size(coder: zstandard.ZstdCompressor, text: bytes, piece: int) -> int:
    return sum(len(coder.compress(text[i : i + piece])) for i in range(0, len(text), piece))


def _features(texts: Iterator[bytes], model: QualityModel) -> np.ndarray:
    """Per text: the difference of the normalised sizes (bad less good), and the size with the better dictionary."""
    good, bad = _coder(model.good, model.level), _coder(model.bad, model.level)
    rows = []
    for text in texts:
        n = max(len(text), 1)
        g, b = _size(good, text, model.piece), _size(bad, text, model.piece)
        rows.append(((b - g) / n, min(b, g) / n))
    return np.array(rows, np.float64).reshape(-1, 2)


def _curve(features: np.ndarray, weights) -> np.ndarray:
    z = np.clip(weights[0] + features @ np.asarray(weights[1:]), -30, 30)
    return 1 / (1 + np.exp(-z))


def _fit_curve(features: np.ndarray, y: np.ndarray) -> tuple[float, ...]:
    """Logistic regression by Newton steps with a slight ridge, on standardised features."""
    mean, sd = features.mean(0), np.maximum(features.std(0), 1e-9)
    x = np.column_stack([np.ones(len(y)), (features - mean) / sd])
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + _RIDGE * len(y) * np.eye(len(w))
        step = np.linalg.solve(h, x.T @ (y - p) - _RIDGE * len(y) * w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return (float(w[0] - (w[1:] * mean / sd).sum()), *map(float, w[1:] / sd))


def _dictionary(texts: list[bytes], size: int) -> bytes:
    pieces = [t[i : i + PIECE_BYTES] for t in texts for i in range(0, len(t), PIECE_BYTES)]
    try:
        return zstandard.train_dictionary(size, pieces).as_bytes()
    except zstandard.ZstdError:  # too little text to train on: its own bytes are the dictionary
        return b"".join(texts)[-size:] or b" "


def sample_labelled(documents: DataFrame, labels: DataFrame, per_class: int, max_bytes: int) -> dict[int, list[bytes]]:
    """At most ``per_class`` whole texts of each class in the order of a hash, as far as ``max_bytes`` goes.

    The ids are drawn from the labels; the documents are then read without a shuffle. Of a text that is longer than
    what is left, only the size comes to the driver. Columns other than ``doc_id``, ``text`` and ``quality`` are not read.
    """
    documents = documents.select("doc_id", "text").where("text IS NOT NULL")
    order = F.xxhash64("doc_id", F.lit("quality"))
    known = labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").groupBy("doc_id").agg(F.max("quality").alias("y"))
    drawn = known.select("doc_id", "y", order.alias("o"))
    drawn = drawn.where("y = 0").orderBy("o", "doc_id").limit(per_class).unionAll(
        drawn.where("y = 1").orderBy("o", "doc_id").limit(per_class)
    )
    drawn = documents.sparkSession.createDataFrame([tuple(r) for r in drawn.collect()], "doc_id long, y int, o long")
    of = documents.join(F.broadcast(drawn), "doc_id").groupBy("doc_id", "y", "o")
    left, ids = {0: max_bytes, 1: max_bytes}, []
    for row in of.agg(F.max(F.octet_length("text")).alias("n")).orderBy("o", "doc_id").collect():
        if row.n <= left[row.y]:
            left[row.y] -= row.n
            ids.append((row.doc_id,))
    chosen = F.broadcast(documents.sparkSession.createDataFrame(ids, "doc_id long"))
    texts: dict[int, list[bytes]] = {0: [], 1: []}
    kept = documents.join(chosen, "doc_id", "left_semi").join(F.broadcast(drawn), "doc_id")
    for row in kept.groupBy("doc_id", "y", "o").agg(F.max("text").alias("text")).orderBy("o", "doc_id").collect():
        texts[row.y].append(row.text.encode())
    return texts


def fit_quality(
    documents: DataFrame,
    labels: DataFrame,
    per_class: int = SAMPLE_PER_CLASS,
    max_bytes: int = SAMPLE_BYTES,
    dictionary_bytes: int = DICTIONARY_BYTES,
) -> QualityModel:
    """A model from documents (``doc_id``, ``text``) and ``labels`` (``doc_id``, ``quality``) of some of them.

    Only labels of documents that may be learnt from are to be given. Rows without a text, an id or a label teach
    nothing; of repeated rows one counts. With one class only, every text gets that class; without labels, 0.5.
    """
    sample = sample_labelled(documents, labels, per_class, max_bytes)
    halves = {k: (v[::2], v[1::2] or v) for k, v in sample.items()}
    model = QualityModel(_dictionary(halves[1][0], dictionary_bytes), _dictionary(halves[0][0], dictionary_bytes), ())
    if not sample[1] or not sample[0]:
        return QualityModel(model.good, model.bad, (5.0 * (bool(sample[1]) - bool(sample[0])), 0.0, 0.0))
    features = _features(iter(halves[1][1] + halves[0][1]), model)
    y = np.array([1.0] * len(halves[1][1]) + [0.0] * len(halves[0][1]))
    return QualityModel(model.good, model.bad, _fit_curve(features, y))


def quality_of(model: QualityModel, text: str = "text") -> Column:
    """The score of each whole text; a null text scores as an empty one does."""

    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array(_curve(_features(as_bytes(batch), model), model.weights))

    return F.arrow_udf(scored, "double", F.ArrowUDFType.SCALAR_ITER)(F.col(f"`{text}`"))


def score_quality(documents: DataFrame, model: QualityModel, text: str = "text", score: str = "score") -> DataFrame:
    """All columns of ``documents`` and the score of each whole text; a null text scores as an empty one does.

    The text is the only input of the score. ``score`` replaces a column of that name.
    """
    small_batches(documents.sparkSession)
    return documents.withColumn(score, quality_of(model, text))


def training_labels(labels: DataFrame) -> DataFrame:
    """The labels that may be learnt from; those of the other third are for measuring."""
    return labels.where(crc_remainder("doc_id", 3) != 1)


def keep_good(documents: DataFrame, labels: DataFrame, least: float = 0.5) -> DataFrame:
    """The documents whose score is ``least`` or more, with the columns they came with, of any name.

    Null and empty texts have one score, and stay or go together; each of several equal rows is a row of its own. Without
    labels every score is 0.5.
    """
    model = fit_quality(documents, training_labels(labels))
    small_batches(documents.sparkSession)
    return documents.where(quality_of(model) >= least)

