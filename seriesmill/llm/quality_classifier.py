"""Quality score by supervised subword embeddings.

Words, pairs of neighbouring words and the 3- and 4-byte parts of words are hashed to rows of a table of
learned vectors. A document is the mean of its features' vectors, and a softmax over two classes follows;
numpy's stochastic gradient descent learns both. As all of it but the softmax is linear, a feature counts
with one number when documents are scored: its vector times the difference of the class weights.

Learning uses a sample of labelled rows, bounded by TRAIN_ROWS; scoring covers every row and whole texts.

Defined cases: null and empty texts have no features and get the score of the bias alone. Labels that are
null, or of a doc_id without a document, aren't used; of several labels of a doc_id the mean counts, from
one half as good. With no labels at all every score is 0.5. Rows with a null doc_id are scored and are not
held out. Other columns are not read, and an empty table gives an empty result.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesmill.llm.common import arrow_rows, documents_only
from seriesmill.llm.hashing import MIX, Text

BUCKETS = 1 << 17
DIMENSIONS = 8
#: Labelled rows that the classifier learns from, at most: those with the least hashes of their ids.
TRAIN_ROWS = 2500
EPOCHS, RATE, SEED = 12, 40.0, 3
#: Words this far back count as repeated.
BACK = 3
#: Bytes of a text that are looked at together.
CHUNK = 1 << 20
#: Bytes of a word that no chunk cuts.
LONGEST_WORD = 1 << 20
_SPACE = re.compile(rb"[\x20\x09-\x0D]")

def _buckets(hashes: np.ndarray, kind: int) -> np.ndarray:
    spread = (hashes + np.uint64(kind)) * MIX
    spread ^= spread >> np.uint64(29)
    spread *= MIX
    return (spread >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64)


def _chunk_features(raw: bytes, before: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Features of whole words that follow those of ``before``, and the last words for the next chunk."""
    text = Text(raw)
    if not len(text.starts):
        return [], before
    words, first = np.concatenate([before, text.words()]), len(before)
    made = [_buckets(words[first:], 1)]
    second = max(first, 1)
    if len(words) > second:
        made.append(_buckets(words[second - 1 : -1] * np.uint64(31) ^ words[second:], 2))
    for back in range(1, BACK + 1):
        later = max(first, back)
        again = np.count_nonzero(words[later:] == words[later - back : len(words) - back]) if len(words) > later else 0
        made.append(_buckets(np.full(again, back, np.uint64), 3))
    spaces = np.concatenate([[0], np.cumsum(text.space)])
    for size in (3, 4):
        if len(raw) >= size:
            at = np.flatnonzero(spaces[size:] == spaces[:-size])
            made.append(_buckets(text.parts(at, at + size), 4 + size))
    return made, words[-BACK:]


def features(text: str | None) -> np.ndarray:
    """Rows of the vector table, one for each feature of the whole text.

    Long texts go in chunks that end behind a space; pairs and repeats of words reach over their bounds.
    So chunks change nothing, unless a word has more than LONGEST_WORD bytes: it may count as several.
    """
    raw = (text or "").encode("utf-8", "surrogatepass")
    made: list[np.ndarray] = []
    last, at = np.empty(0, np.uint64), 0
    while at < len(raw):
        space = _SPACE.search(raw, at + CHUNK, at + CHUNK + LONGEST_WORD)
        end = space.end() if space else at + CHUNK + LONGEST_WORD
        parts, last = _chunk_features(raw[at:end], last)
        made += parts
        at = end
    return np.concatenate(made) if made else np.empty(0, np.int64)


@dataclass(frozen=True)
class Model:
    """What each feature adds to the log odds, before the mean is taken, and the bias."""

    weights: np.ndarray
    bias: float

    def score(self, text: str | None) -> float:
        found = features(text)
        odds = self.bias + (float(self.weights[found].mean()) if len(found) else 0.0)
        return float(1 / (1 + np.exp(-np.clip(odds, -500, 500))))


def train(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray) -> Model:
    """Stochastic gradient descent over (features, counts) and labels 0 or 1, in a fixed random order."""
    if not len(labels):
        return Model(np.zeros(BUCKETS, np.float32), 0.0)
    draw = np.random.default_rng(SEED)
    vectors = draw.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (BUCKETS, DIMENSIONS)).astype(np.float32)
    classes = np.zeros((2, DIMENSIONS), np.float32)
    bias = np.log(np.bincount(labels, minlength=2) + 1).astype(np.float32)
    shares = [(c / max(1, c.sum())).astype(np.float32) for _, c in rows]
    steps, done = EPOCHS * len(rows), 0
    for _ in range(EPOCHS):
        for i in draw.permutation(len(rows)):
            rate = RATE * (1 - done / steps)
            done += 1
            at, share = rows[i][0], shares[i]
            mean = share @ vectors[at]
            logits = classes @ mean + bias
            odds = np.exp(logits - logits.max())
            error = odds / odds.sum()
            error[labels[i]] -= 1
            back = error @ classes
            classes -= 0.05 * rate * np.outer(error, mean)
            bias -= 0.002 * rate * error
            vectors[at] -= rate * share[:, None] * back
    return Model((vectors @ (classes[1] - classes[0])).astype(np.float32), float(bias[1] - bias[0]))


def held_out(id_column: str) -> Column:
    """Rows that nothing is learned from."""
    return F.coalesce(F.crc32(F.col(f"`{id_column}`").cast("string")) % 3 == 1, F.lit(False))


def _counted(batch: pa.RecordBatch) -> pa.RecordBatch:
    found = [np.unique(features(t), return_counts=True) for t in batch.column("text").to_pylist()]
    return pa.RecordBatch.from_arrays(
        [
            batch.column("id"),
            batch.column("good"),
            pa.array([f.astype("<u4").tobytes() for f, _ in found], pa.binary()),
            pa.array([c.astype("<u4").tobytes() for _, c in found], pa.binary()),
        ],
        names=["id", "good", "features", "counts"],
    )


def fit(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text", label: str = "quality") -> Model:
    """The model learned from labelled rows that are not held out, TRAIN_ROWS at most."""
    known = documents_only(labels, id_column, label).toDF("id", "label")
    known = known.where(F.col("label").isNotNull() & F.col("id").isNotNull() & ~held_out("id"))
    known = known.groupBy("id").agg((F.avg("label") >= 0.5).cast("int").alias("good"))
    chosen = known.orderBy(F.xxhash64("id"), "id").limit(TRAIN_ROWS)
    rows = documents_only(docs, id_column, text).toDF("id", "text").join(F.broadcast(chosen), "id")
    made = arrow_rows(rows.select("id", "good", "text"), _counted, "id long, good int, features binary, counts binary")
    sample = sorted(made.toArrow().to_pylist(), key=lambda r: (r["id"], r["features"]))
    return train(
        [(np.frombuffer(r["features"], "<u4").astype(np.int64), np.frombuffer(r["counts"], "<u4")) for r in sample],
        np.array([r["good"] for r in sample], np.int64),
    )


def scores(docs: DataFrame, model: Model, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) for every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = documents_only(docs, id_column, text).toDF("id", "text")
    kind = rows.schema["id"].dataType.simpleString()

    def score(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = [shared.value.score(t) for t in batch.column("text").to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column("id"), pa.array(made, pa.float64())], names=["id", "score"])

    made = arrow_rows(rows, score, f"id {kind}, score double")
    return made.select(
        F.col("id").alias(id_column), held_out("id").alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
