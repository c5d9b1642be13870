"""Language ID by the nearest of several centroids per language.

A text is a vector of hashed letter n-grams, weighted by log(1 + count) and inverse
document frequency and normalised. Each language has several centroids, found by
spherical k-means; a text takes the language of the centroid of largest cosine. It is
rejected if it is further from that centroid than the radius of its language, or if it has
no letters. Short texts are far from any centroid, so there is a radius per band of text
length (distinct n-grams, by powers of two). It is learned from the distances that training
texts, and pieces of them of a few words, keep from centroids of the other half of them.

Document frequencies cover all labelled rows and are summed per task before the one
exchange. Centroids are fitted on at most ``SAMPLE`` rows per language, those with the
smallest hashes. What reaches the driver is the model: ``DIMENSIONS`` frequencies and
``CLUSTERS`` vectors per language. Prediction is a narrow stage.

Defined cases: texts that are null or have no letter are ``und`` with score 0 and are
rejected; rows without a language or text do not train; one language alone is learned as
one; a language of one row rejects nothing with letters; without any labelled row every text is ``und``; ties go to the language first in
order; repeated rows get the same answer; other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from homestrata.llm.batches import let_go

DIMENSIONS = 8192
GRAMS = (1, 2, 3)
CLUSTERS = 4
SAMPLE = 1500
ROUNDS = 8
LEAST_SHARE = 0.02
UNKNOWN = "und"

# A text is too far if its cosine is under this share of what all but one in a hundred
# training texts of its language and band reach.
NEAR_SHARE, NEAR_QUANTILE = 0.6, 0.01
PIECES = (1, 2, 4, 8, 16, 32)  # words
BANDS = DIMENSIONS.bit_length() + 1

_BLOCK = 64
_LETTERS = bytes(b if chr(b).isalpha() and b < 128 or b >= 128 else 32 for b in range(256))


@dataclass
class Model:
    """``weights``: inverse document frequency; ``centroids``: one row each; ``radii``: one row each, by band."""

    labels: list[str]
    weights: np.ndarray
    centroids: np.ndarray
    radii: np.ndarray


def _has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def _counts(texts: list[str]) -> np.ndarray:
    """Row per text: counts of hashed n-grams of letters, other characters as blanks."""
    parts = [b" " + t.lower().encode("utf-8", "surrogatepass").translate(_LETTERS) + b" " for t in texts]
    data = np.frombuffer(b"".join(parts), np.uint8).astype(np.uint32)
    owner = np.repeat(np.arange(len(texts)), [len(p) for p in parts])
    out = np.zeros(len(texts) * DIMENSIONS, np.int64)
    blank = data == 32
    for n in GRAMS:
        m = len(data) - n + 1
        if m <= 0:
            continue
        code = np.zeros(m, np.uint32)
        ok = np.zeros(m, bool)
        for k in range(n):
            code = code * np.uint32(257) + data[k : k + m]
            ok |= ~blank[k : k + m]
        ok &= owner[:m] == owner[n - 1 :]
        if n == 3:
            ok &= ~(blank[:m] & blank[1 : 1 + m]) & ~(blank[1 : 1 + m] & blank[2:])
        code = (code[ok] + np.uint32(n)) * np.uint32(2654435761)
        place = owner[:m][ok] * DIMENSIONS + (code >> np.uint32(19)).astype(np.int64)
        out += np.bincount(place, minlength=len(out))
    return out.reshape(len(texts), DIMENSIONS)


def vectors(texts: list[str], weights: np.ndarray) -> np.ndarray:
    """Normalised TF-IDF rows."""
    rows = np.log1p(_counts(texts).astype(np.float32)) * weights
    norms = np.sqrt((rows * rows).sum(1, keepdims=True))
    return rows / np.maximum(norms, 1e-12)


def _blocks(texts: list[str]) -> Iterator[tuple[int, list[str]]]:
    """Runs of texts, bounded in number and in characters."""
    at, held, total = 0, [], 0
    for i, text in enumerate(texts):
        held.append(text)
        total += len(text)
        if len(held) == _BLOCK or total > 1 << 18:
            yield at, held
            at, held, total = i + 1, [], 0
    if held:
        yield at, held


def document_frequencies(rows: DataFrame, text_col: str) -> DataFrame:
    """(gram, docs) over all rows; gram -1 counts the rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, n = np.zeros(DIMENSIONS, np.int64), 0
        for batch in batches:
            texts = [t for t in batch.column(0).to_pylist() if t is not None]
            for _, block in _blocks(texts):
                seen += (_counts(block) > 0).sum(0)
                n += len(block)
        at = np.flatnonzero(seen)
        grams, docs = np.append(at, -1), np.append(seen[at], n)
        let_go()
        yield pa.record_batch([pa.array(grams, pa.int64()), pa.array(docs, pa.int64())], names=["gram", "docs"])

    parts = rows.select(F.col(text_col).cast("string")).mapInArrow(run, "gram bigint, docs bigint")
    return parts.groupBy("gram").agg(F.sum("docs").alias("docs"))


def _cluster(rows: np.ndarray) -> np.ndarray:
    """Centroids by spherical k-means from evenly spaced rows.

    Centroids that hold less than ``LEAST_SHARE`` of the rows are stray texts and go.
    """
    centroids = rows[np.linspace(0, len(rows) - 1, min(CLUSTERS, len(rows))).astype(int)]
    for _ in range(ROUNDS):
        own = np.argmax(rows @ centroids.T, 1)
        sums = np.stack([rows[own == k].sum(0) if (own == k).any() else centroids[k] for k in range(len(centroids))])
        centroids = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    held = np.bincount(np.argmax(rows @ centroids.T, 1), minlength=len(centroids))
    return centroids[held >= min(held.max(), LEAST_SHARE * len(rows))]


def _bands(rows: np.ndarray) -> np.ndarray:
    """Band of each row by how many n-grams it has."""
    return np.frexp(np.count_nonzero(rows, axis=1))[1]


def _pieces(texts: list[str]) -> list[str]:
    """A run of words of each length from every text that has more, at places that differ from text to text."""
    out = []
    for i, text in enumerate(texts):
        words = text.split()
        for n in PIECES:
            if len(words) > n:
                at = (i * 7919) % (len(words) - n + 1)
                out.append(" ".join(words[at : at + n]))
    return [t for t in out if _has_letter(t)]


def _radii(texts: list[str], rows: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Radius per band, from cosines of each half of the texts to the centroids of the other half."""
    bands, cosines = [], []
    for k in (0, 1) if len(texts) > 1 else ():
        middle = _cluster(rows[1 - k :: 2]).T
        bands.append(_bands(rows[k::2]))
        cosines.append((rows[k::2] @ middle).max(1))
        for _, block in _blocks(_pieces(texts[k::2])):
            found = vectors(block, weights)
            bands.append(_bands(found))
            cosines.append((found @ middle).max(1))
    radii, least = np.ones(BANDS), 0.0
    band, cosine = (np.concatenate(x) if x else np.zeros(0) for x in (bands, cosines))
    for b in range(BANDS):  # a band without texts is as the one below
        if (band == b).any():
            least = NEAR_SHARE * np.quantile(cosine[band == b], NEAR_QUANTILE)
        radii[b] = 1 - least
    return radii


def fit(labelled: DataFrame, text_col: str, label_col: str, sample: int = SAMPLE) -> Model:
    """Learn from rows that have a text and a label."""
    rows = labelled.where(F.col(text_col).isNotNull() & F.col(label_col).isNotNull()).select(
        F.col(text_col).cast("string").alias("text"), F.col(label_col).cast("string").alias("label")
    )
    seen = {r.gram: r.docs for r in document_frequencies(rows, "text").collect()}
    total = seen.pop(-1, 0)
    weights = np.full(DIMENSIONS, np.log(1 + total) + 0.05, np.float32)  # what no text has counts most
    for gram, docs in seen.items():
        weights[gram] = np.log((1 + total) / (1 + docs)) + 0.05
    sizes = {r.label: r.n for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if not total or not sizes:
        return Model([], weights, np.zeros((0, DIMENSIONS), np.float32), np.zeros((0, BANDS)))
    # a share of each language that is sure to hold its smallest hashes, then exactly those
    share = F.lit(0.0)
    for label, n in sizes.items():
        share = F.when(F.col("label") == label, min(1.0, (2 * sample + 100) / n)).otherwise(share)
    few = rows.withColumn("h", F.xxhash64("text")).where((F.pmod("h", F.lit(1 << 20)) / (1 << 20)) <= share)
    rank = F.row_number().over(Window.partitionBy("label").orderBy(F.pmod("h", F.lit(1 << 20)), "h", "text"))
    few = few.withColumn("rank", rank).where(F.col("rank") <= sample).select("label", "text")

    def centroids(part: pd.DataFrame) -> pd.DataFrame:
        texts = [t for t in part["text"] if _has_letter(t)]
        empty = pd.DataFrame({"label": [], "radii": [], "vector": []})
        if not texts:
            return empty
        texts.sort()
        found = np.concatenate([vectors(block, weights) for _, block in _blocks(texts)])
        middle, radii = _cluster(found), _radii(texts, found, weights)
        return pd.DataFrame(
            {
                "label": part["label"].iloc[0],
                "radii": [radii] * len(middle),
                "vector": [m.astype(np.float32) for m in middle],
            }
        )

    learned = few.groupBy("label").applyInPandas(centroids, "label string, radii array<double>, vector array<float>")
    model = sorted(learned.collect(), key=lambda r: r.label)
    if not model:
        return Model([], weights, np.zeros((0, DIMENSIONS), np.float32), np.zeros((0, BANDS)))
    return Model(
        [r.label for r in model],
        weights,
        np.array([r.vector for r in model], np.float32),
        np.array([r.radii for r in model]),
    )


def predict(model: Model, text: Column) -> Column:
    """struct(lang, score, rejected) of a text column."""

    @F.pandas_udf("lang string, score double, rejected boolean")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        labels, middle = np.array([*model.labels, UNKNOWN], object), model.centroids.T.copy()
        for series in batches:
            best = np.full(len(series), len(labels) - 1)
            score, rejected = np.zeros(len(series)), np.ones(len(series), bool)
            use = [i for i, t in enumerate(series) if t is not None and _has_letter(t)] if len(labels) > 1 else []
            for at, block in _blocks([series.iloc[i] for i in use]):
                place = np.array(use[at : at + len(block)])
                found = vectors(block, model.weights)
                cosine = found @ middle
                best[place] = np.argmax(cosine, 1)
                score[place] = np.clip(cosine.max(1), 0, 1)
                rejected[place] = 1 - cosine.max(1) > model.radii[best[place], _bands(found)]
            yield pd.DataFrame({"lang": labels[best], "score": score, "rejected": rejected})
        let_go()

    return run(text.cast("string"))
