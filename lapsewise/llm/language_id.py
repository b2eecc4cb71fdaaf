"""Language identification with string kernels.

The blended-spectrum presence kernel of two texts counts the character n-grams of
length 1 to ``SPECTRUM`` that both hold, over the geometric mean of how many each
holds.  A bounded sample of landmark texts gives Nystroem features; kernel ridge
regression, one language against the rest, is solved in them.  Features and
regression fold into one matrix, so that a batch of texts is scored by two matrix
products: presences by landmarks, then kernel values by weights.

Letters are folded to lower case and every other character to a space, so that
digits, marks and punctuation have no say.  n-grams are told apart by a 64-bit
code hashed to ``1 << BITS`` buckets; those of no landmark only count for the length.

Learning takes every language (or the ``max_languages`` most frequent) and of each at most
``per_language`` texts with letters, ``max_texts`` in all but one of each language at least; of a
longer text it takes ``sample_chars`` characters from a seeded place on, or from the first letter
if there is none in them.  Prediction takes every character of every text.

Defined results: ``und`` with score 0 for a text that is null or has no letters, and
for every text when there is nothing to learn from; a text with letters that shares no n-gram
with a landmark has score 0 and the first language by name; rows that repeat are predicted
alike; columns other than doc_id, text and (when learning) lang are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapsewise.llm.common import excerpt, forget_others, held_out, map_arrow, on_workers, released, sampled, seeded, slices
from lapsewise.sources import stage

SPECTRUM = 3
BITS = 17
SPACE = 32
UNKNOWN = "und"
BATCH = 128
#: Landmarks of all languages together; one of each at least.
MOST_LANDMARKS = 1000
LETTER = r"\p{L}"


@cache
def _folds() -> np.ndarray:
    """Code point to folded letter; a space for what is no letter."""
    table = np.full(0x110000, SPACE, np.uint32)
    for point in range(0x110000):
        char = chr(point)
        if char.isalpha():
            low = char.lower()
            table[point] = ord(low) if len(low) == 1 else point
    return table


def presence(text: str) -> np.ndarray | None:
    """Which n-gram buckets the text holds; None when it has no letters."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    letters = _folds()[points].astype(np.uint64)
    if not (letters != SPACE).any():
        return None
    held = np.zeros(1 << BITS, bool)
    code = np.zeros(len(letters), np.uint64)
    for n in range(SPECTRUM):
        code = (code[: len(letters) - n] << np.uint64(21)) | letters[n:]
        if not len(code):
            break
        # Multiplicative hashing; the top bits depend on every bit of the code.
        mixed = (code ^ (code >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
        held[mixed >> np.uint64(64 - BITS)] = True
    return held


@dataclass(frozen=True)
class KernelModel:
    """``weights`` maps kernel values with the landmarks to one output a language."""

    languages: tuple[str, ...]
    columns: np.ndarray  # buckets that some landmark holds
    landmarks: np.ndarray  # (columns, landmarks), scaled by the landmarks' norms
    weights: np.ndarray  # (landmarks, languages)

    def outputs(self, held: list[np.ndarray]) -> np.ndarray:
        rows = np.stack([h[self.columns] for h in held]).astype(np.float32)
        norms = np.sqrt([np.count_nonzero(h) for h in held])
        return (rows @ self.landmarks / norms[:, None]) @ self.weights

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and score of each text; the score is the regression's estimate, held to 0..1."""
        names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
        if not self.languages:
            return names, scores
        for at in range(0, len(texts), BATCH):
            known = [(i, h) for i, t in enumerate(texts[at : at + BATCH], at) if t and (h := presence(t)) is not None]
            if not known:
                continue
            out = self.outputs([h for _, h in known])
            best = out.argmax(axis=1)
            for (i, _), which, value in zip(known, best, out.max(axis=1)):
                names[i], scores[i] = self.languages[which], min(1.0, max(0.0, float(value)))
        return names, scores


#: Of no language: every text is unknown.
NOTHING = KernelModel((), np.zeros(0, int), np.zeros((0, 0)), np.zeros((0, 0)))


def _kernel(texts: list[str], columns: np.ndarray, scaled: np.ndarray) -> np.ndarray:
    """Kernel values (texts, landmarks), in batches that bound the presences held."""
    parts = []
    for at in range(0, len(texts), BATCH):
        held = [presence(t) for t in texts[at : at + BATCH]]
        norms = np.sqrt([np.count_nonzero(h) for h in held])
        parts.append(np.stack([h[columns] for h in held]).astype(np.float32) @ scaled / norms[:, None])
    return np.concatenate(parts)


def _solve(texts: list[str], target: np.ndarray, landmarks: np.ndarray, ridge: float):
    """Columns, scaled landmark matrix and weights of the Nystroem ridge regression."""
    marks = np.stack([presence(texts[i]) for i in landmarks])
    columns = np.flatnonzero(marks.any(axis=0))
    scaled = (marks[:, columns] / np.sqrt(marks.sum(axis=1))[:, None]).T.astype(np.float32)
    kernel = _kernel(texts, columns, scaled)
    values, vectors = np.linalg.eigh(kernel[landmarks].astype(np.float64))
    kept = values > 1e-6 * values.max()
    whiten = vectors[:, kept] / np.sqrt(values[kept])
    features = kernel @ whiten
    gram = features.T @ features + ridge * np.eye(features.shape[1])
    return columns, scaled, whiten @ np.linalg.solve(gram, features.T @ target)


def fit(
    documents: DataFrame,
    per_language: int = 400,
    landmarks: int = 50,
    sample_chars: int = 10_000,
    max_languages: int | None = None,
    max_texts: int = 4000,
    ridge: float = 0.1,
    seed: int = 3,
) -> KernelModel:
    """Learns the languages, or the ``max_languages`` most frequent, from at most ``max_texts`` texts
    (or one a language), ``per_language`` of a language at most, ``landmarks`` of which are landmarks."""
    usable = F.col("lang").isNotNull() & ~held_out() & F.col("text").rlike(LETTER)
    pool = stage(documents.where(usable).select("doc_id", "lang"), "language-ids")
    counts = pool.groupBy("lang").count().orderBy(F.desc("count"), "lang")
    frequent = (counts if max_languages is None else counts.limit(max_languages)).collect()
    if not frequent:
        return NOTHING
    per_language = max(1, min(per_language, max_texts // len(frequent)))
    # Ids are ranked alone; texts follow for the few that are chosen.
    learned = pool if max_languages is None else pool.where(F.col("lang").isin([r["lang"] for r in frequent]))
    chosen = sampled(learned, "lang", "doc_id", per_language, seed).distinct()
    text = F.col("text")
    part = excerpt(text, F.length(text), sample_chars, "doc_id", seed)
    lettered = F.substr(text, F.regexp_instr(text, F.lit(LETTER)), F.lit(sample_chars))
    rows = (
        documents.select("doc_id", "lang", "text")
        .join(F.broadcast(chosen), ["doc_id", "lang"])
        .where(text.rlike(LETTER))
        .groupBy("doc_id", "lang")
        .agg(F.min(F.when(part.rlike(LETTER), part).otherwise(lettered)).alias("text"))
        .orderBy(seeded("doc_id", seed), "doc_id", "lang")
        .collect()
    )
    known = [(r["lang"], r["text"]) for r in rows if presence(r["text"]) is not None]
    languages = tuple(sorted({name for name, _ in known}))
    if not languages:
        return NOTHING
    names = np.array([languages.index(name) for name, _ in known])
    marks = min(landmarks, max(1, MOST_LANDMARKS // len(languages)))
    first = np.concatenate([np.flatnonzero(names == i)[:marks] for i in range(len(languages))])
    target = np.eye(len(languages))[names]
    columns, scaled, weights = _solve([t for _, t in known], target, first, ridge)
    return KernelModel(languages, columns, scaled, weights)


def predict_language(documents: DataFrame, model: KernelModel) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row."""

    def rows(batch: pa.RecordBatch) -> dict:
        names, scores = model.predict(batch.column("text").to_pylist())
        return {
            "doc_id": batch.column("doc_id"),
            "held_out": batch.column("held_out"),
            "lang_pred": pa.array(names, pa.string()),
            "score": pa.array(scores, pa.float64()),
        }

    return map_arrow(
        documents.select("doc_id", held_out().alias("held_out"), F.col("text").cast("string").alias("text")),
        rows,
        "doc_id long, held_out boolean, lang_pred string, score double",
    )


def keep_known(documents: DataFrame, model: KernelModel) -> DataFrame:
    """The whole rows whose text has a language; those that would be ``und`` go.

    Where there was nothing to learn from, all texts with letters stay.
    """

    def known(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            found: list[bool] = []
            for batch in slices([pa.RecordBatch.from_arrays([column], ["text"])]):
                part = batch.column("text").to_pylist()
                if model.languages:
                    found += [name != UNKNOWN for name in model.predict(part)[0]]
                else:
                    found += [bool(t) and any(c.isalpha() for c in t) for t in part]
            yield pa.array(found, pa.bool_())

    # Only texts go to the workers; rows wait in the JVM for what they say.
    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        forget_others()
        return released(known(columns))

    return on_workers(documents).where(F.arrow_udf(run, "boolean")(F.col("text").cast("string")))
