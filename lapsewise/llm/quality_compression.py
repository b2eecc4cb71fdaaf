"""Quality classifier by compression.

One zstandard dictionary is built from text labelled good and one from text
labelled bad.  A text is cut into pieces short enough for a dictionary to
matter, every piece is compressed with either, and the difference of the two
sizes over the length of the text becomes a probability by logistic
calibration on labelled texts that neither dictionary has seen.

Learning takes a bounded sample of labelled rows (``per_class`` texts a class for
the dictionaries, ``calibration`` a class for the calibration; of a longer text
``sample_bytes`` bytes from a seeded place on); scoring takes every piece of every text.

Defined results: a null or empty text has the score of a text like the average
one; without labels of both classes every score is the smoothed share of good
labels (0.5 with none); rows that repeat are scored alike; columns other than
doc_id and text are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapsewise.llm.common import excerpt, held_out, labelled_sample, map_arrow, seeded, text_bytes, texts


@dataclass(frozen=True)
class CompressionModel:
    """Dictionaries and calibration; ``score = sigmoid(slope * x + intercept)``.

    ``x`` is the size difference per byte, with ``pseudo`` bytes of average text
    (``mean``) added, which draws very short texts to the average.
    """

    good: bytes = b""
    bad: bytes = b""
    raw: bool = False
    piece: int = 512
    level: int = 3
    pseudo: int = 256
    mean: float = 0.0
    slope: float = 0.0
    intercept: float = 0.0

    def compressors(self) -> tuple[zstandard.ZstdCompressor, ...]:
        kind = zstandard.DICT_TYPE_RAWCONTENT if self.raw else zstandard.DICT_TYPE_FULLDICT
        made = []
        for data in (self.good, self.bad):
            known = zstandard.ZstdCompressionDict(data, dict_type=kind)
            known.precompute_compress(level=self.level)
            made.append(
                zstandard.ZstdCompressor(
                    level=self.level,
                    dict_data=known,
                    write_content_size=False,
                    write_checksum=False,
                    write_dict_id=False,
                )
            )
        return tuple(made)

    def differences(self, data: list[bytes]) -> np.ndarray:
        if not self.good:
            return np.zeros(len(data))
        good, bad = self.compressors()
        return np.array([self._difference(t, good, bad) for t in data], dtype=float)

    def _difference(self, text: bytes, good, bad) -> float:
        saved = 0
        for at in range(0, len(text), self.piece):
            part = text[at : at + self.piece]
            saved += len(bad.compress(part)) - len(good.compress(part))
        return (saved + self.pseudo * self.mean) / (len(text) + self.pseudo)

    def scores(self, data: list[bytes]) -> np.ndarray:
        z = self.slope * self.differences(data) + self.intercept
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def _dictionary(data: list[bytes], piece: int, size: int) -> tuple[bytes, bool]:
    """Trained dictionary, or raw text where there is too little to train on."""
    parts = [t[at : at + piece] for t in data for at in range(0, len(t), piece)]
    try:
        return zstandard.train_dictionary(size, parts).as_bytes(), False
    except zstandard.ZstdError:
        return b"".join(parts)[:size], True


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> tuple[float, float]:
    """Slope and intercept by Newton's method, each class weighing by its rows."""
    scale = x.std() or 1.0
    design = np.column_stack([x / scale, np.ones_like(x)])
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -500, 500)))
        gradient = design.T @ (p - y) + ridge * w
        hessian = (design * (p * (1 - p))[:, None]).T @ design + ridge * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return w[0] / scale, w[1]


def fit(
    documents: DataFrame,
    labels: DataFrame,
    per_class: int = 1200,
    calibration: int = 1500,
    sample_bytes: int = 20_000,
    dictionary_bytes: int = 110 * 1024,
    seed: int = 2,
) -> CompressionModel:
    """Learns from at most ``2 * (per_class + calibration)`` texts, of each ``sample_bytes`` bytes at most."""
    # Only labels of documents with a text are ranked, so that none takes a place for nothing.
    written = documents.where(F.octet_length("text") > 0).select("doc_id")
    sample = labelled_sample(labels.join(written, "doc_id", "left_semi"), "quality", per_class + calibration, seed)
    rows = (
        documents.select("doc_id", text_bytes())
        .where(F.octet_length("text") > 0)
        .join(F.broadcast(sample), "doc_id")
        .groupBy("doc_id", "label")
        .agg(F.min(excerpt(F.col("text"), F.octet_length("text"), sample_bytes, "doc_id", seed)).alias("text"))
        .orderBy(seeded("doc_id", seed), "doc_id")
        .collect()
    )
    shares = {
        r["label"]: r["n"]
        for r in labels.where(F.col("quality").isin(0, 1) & ~held_out())
        .groupBy(F.col("quality").cast("int").alias("label"))
        .agg(F.count(F.lit(1)).alias("n"))
        .collect()
    }
    prior = (shares.get(1, 0) + 1) / (sum(shares.values()) + 2)
    odds = float(np.log(prior / (1 - prior)))
    by = {c: [bytes(r["text"]) for r in rows if r["label"] == c] for c in (0, 1)}
    seen = {c: min(per_class, -(-len(t) // 2)) for c, t in by.items()}
    if min(len(t) - seen[c] for c, t in by.items()) < 1:
        return CompressionModel(intercept=odds)

    model = CompressionModel()
    (good, raw_good), (bad, raw_bad) = (
        _dictionary(by[c][: seen[c]], model.piece, dictionary_bytes) for c in (1, 0)
    )
    if raw_good != raw_bad:  # the two are only comparable if of one kind
        good, bad = (b"".join(by[c][: seen[c]])[:dictionary_bytes] for c in (1, 0))
    plain = CompressionModel(good, bad, raw_good or raw_bad, pseudo=0)
    data = [t for c in (0, 1) for t in by[c][seen[c] :]]
    y = np.repeat([0.0, 1.0], [len(by[c]) - seen[c] for c in (0, 1)])
    lengths = np.array([len(t) for t in data], dtype=float)
    saved = plain.differences(data) * lengths
    # Totals over what the classes weigh in the corpus, not in the sample.
    weight = np.where(y == 1, prior / y.mean(), (1 - prior) / (1 - y.mean()))
    mean = float((weight * saved).sum() / (weight * lengths).sum())
    x = (saved + model.pseudo * mean) / (lengths + model.pseudo)
    slope, intercept = _logistic(x, y)
    intercept += odds - float(np.log(y.mean() / (1 - y.mean())))
    return CompressionModel(
        good, bad, plain.raw, mean=mean, slope=float(slope), intercept=float(intercept)
    )


def score_quality(documents: DataFrame, model: CompressionModel, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score and predicted (1 from ``threshold`` on) of every row."""

    def rows(batch: pa.RecordBatch) -> dict:
        scores = model.scores(texts(batch))
        return {
            "doc_id": batch.column("doc_id"),
            "held_out": batch.column("held_out"),
            "score": pa.array(scores, pa.float64()),
            "predicted": pa.array((scores >= threshold).astype(np.int32), pa.int32()),
        }

    return map_arrow(
        documents.select("doc_id", held_out().alias("held_out"), text_bytes()),
        rows,
        "doc_id long, held_out boolean, score double, predicted int",
    )
