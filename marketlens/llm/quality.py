"""Quality classifier: n-gram indicators scaled by class log-count ratios, and a linear hinge-loss model on top.

Naive Bayes gives each n-gram the logarithm of how much more often the one class has it; documents are then vectors of
these ratios at the n-grams they contain, of length 1, and a support vector machine is fitted to them by dual coordinate
descent. Margins become scores from 0 to 1 by a logistic curve, fitted on rows the machine has not seen.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.llm.common import map_rows
from marketlens.llm.hashing import mixed, word_hashes

#: Number of buckets that n-grams are hashed to.
SIZE = 1 << 18

_SPACES = bytes(32 if b in b"\t\n\v\f\r " else b for b in range(256))
#: Bits: lower-case letter or non-ASCII, upper-case letter, digit, other character.
_CLASS = np.array(
    [
        1 if b >= 128 or 97 <= b <= 122 else 2 if 65 <= b <= 90 else 4 if 48 <= b <= 57 else 8 if b > 32 else 0
        for b in range(256)
    ],
    np.uint8,
)


def ngrams(text: str | None) -> np.ndarray:
    """Sorted buckets of the n-grams in a text: words, pairs of words, and up to three word shapes in a row.

    Words are runs without white space, as written. A word's shape has its kinds of characters, its length on a
    logarithmic scale, and whether it repeats the word before.
    """
    raw = (text or "").encode("utf-8", "surrogatepass").translate(_SPACES).split()
    if not raw:
        return np.empty(0, np.int64)
    words = word_hashes(raw)
    sizes = np.fromiter(map(len, raw), np.int64, len(raw))
    kinds = np.bitwise_or.reduceat(_CLASS[np.frombuffer(b"".join(raw), np.uint8)], np.cumsum(sizes) - sizes)
    again = np.append(False, words[1:] == words[:-1])
    shapes = (kinds.astype(np.uint64) << np.uint64(8)) | (np.log2(sizes).astype(np.uint64) << np.uint64(1)) | again
    shapes = mixed(shapes + np.uint64(1))
    found = [words, shapes]
    for k, values in ((2, words), (2, shapes), (3, shapes)):
        if len(values) >= k:
            run = values[: len(values) - k + 1].copy()
            for shift in range(1, k):
                run = mixed(run + values[shift : len(values) - k + 1 + shift] + np.uint64(k))
            found.append(run)
    return np.unique(np.concatenate(found) & np.uint64(SIZE - 1)).astype(np.int64)


@dataclass(frozen=True)
class Model:
    """Squared ratio and weighted ratio of each bucket, the bias, and slope and height of the logistic curve."""

    squares: np.ndarray
    weights: np.ndarray
    bias: float
    slope: float
    height: float

    def margin(self, found: np.ndarray) -> float:
        norm = float(np.sqrt(self.squares[found].sum()))
        return float(self.weights[found].sum()) / norm + self.bias if norm else self.bias

    def score(self, text: str | None) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * self.margin(ngrams(text)) + self.height, -500, 500))))


def _ratios(rows: list[np.ndarray], positive: np.ndarray) -> np.ndarray:
    counts = np.ones((2, SIZE))  # one more than seen, so that no n-gram rules a class out
    for found, label in zip(rows, positive):
        counts[int(label), found] += 1
    return np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())


def _descend(rows: list[np.ndarray], positive: np.ndarray, ratios: np.ndarray, cost: float, rounds: int) -> np.ndarray:
    """Weights of the hinge-loss model, the bias last, by dual coordinate descent; both classes weigh the same."""
    n, weights, duals = len(rows), np.zeros(SIZE + 1), np.zeros(len(rows))
    signs = np.where(positive, 1.0, -1.0)
    shares = np.where(positive, positive.sum(), n - positive.sum())
    most = cost * n / (2 * shares)
    vectors = []
    for found in rows:
        values = ratios[found]
        norm = np.sqrt((values**2).sum())
        vectors.append((np.append(found, SIZE), np.append(values / norm if norm else values, 1.0)))
    lengths = [float((values**2).sum()) for _, values in vectors]
    order = np.random.default_rng(0)
    for _ in range(rounds):
        for k in order.permutation(n):
            found, values = vectors[k]
            slope = signs[k] * float(weights[found] @ values) - 1
            dual = min(max(duals[k] - slope / lengths[k], 0.0), most[k])
            if dual != duals[k]:
                weights[found] += (dual - duals[k]) * signs[k] * values
                duals[k] = dual
    return weights


def _curve(margins: np.ndarray, positive: np.ndarray) -> tuple[float, float]:
    """Slope and height of the logistic curve through the margins, by Newton's steps; a little pull towards (2, 0)."""
    x = np.stack([margins, np.ones_like(margins)], axis=1)
    start = now = np.array([2.0, 0.0])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ now, -30, 30)))
        slope = x.T @ (p - positive) + 0.1 * (now - start)
        now = now - np.linalg.solve((x.T * (p * (1 - p))) @ x + 0.1 * np.eye(2), slope)
    return (float(now[0]), float(now[1])) if now[0] > 0 else (2.0, 0.0)


def _fit(rows: list[np.ndarray], positive: np.ndarray, cost: float, rounds: int) -> Model:
    """Every fifth row is kept for the curve."""
    if positive.all() or not positive.any():
        chance = np.log((positive.sum() + 1) / ((~positive).sum() + 1))
        return Model(np.zeros(SIZE), np.zeros(SIZE), 0.0, 1.0, float(chance))
    late = np.arange(len(rows)) % 5 == 4
    known = [found for found, out in zip(rows, late) if not out]
    if len(set(positive[~late])) < 2:
        late, known = np.zeros(len(rows), bool), rows
    ratios = _ratios(known, positive[~late])
    weights = _descend(known, positive[~late], ratios, cost, rounds)
    model = Model(ratios**2, weights[:-1] * ratios, float(weights[-1]), 2.0, 0.0)
    tried = late if late.any() else ~late
    margins = np.array([model.margin(found) for found, out in zip(rows, tried) if out])
    return Model(model.squares, model.weights, model.bias, *_curve(margins, positive[tried]))


def held_out(doc_id: Column | str, folds: int = 5) -> Column:
    """Whether a document belongs to the part that labels are never learnt from; a row without id does not."""
    text = (F.col(doc_id) if isinstance(doc_id, str) else doc_id).cast("string")
    return F.coalesce(F.crc32(text) % folds == 0, F.lit(False))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    rows: int = 10_000,
    cost: float = 1.0,
    rounds: int = 15,
    doc_id: str = "doc_id",
    text: str = "text",
) -> Model:
    """A model of `label` (1 or 0), learnt from labelled documents that are not `held_out`.

    It is fitted on a bounded sample: the `rows` labelled ids with the smallest hash, the same at every run. Only their
    texts are read into n-grams, and one task fits them. Labels that are null or contradict each other are ignored,
    repeated ones count once, as do repeated documents. Without labels of both classes every text gets the same score.
    """
    known = labels.select(F.col(doc_id).alias("doc_id"), F.col(label).cast("int").alias("label")).dropna()
    known = known.filter(~held_out("doc_id")).groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("most"))
    known = known.filter("label = most").select("doc_id", "label").orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    sample = texts.join(F.broadcast(known), "doc_id")  # at most `rows` rows

    def found(batch: pa.RecordBatch) -> dict[str, list]:
        own = [ngrams(text) for text in batch.column("text").to_pylist()]
        return {"doc_id": batch.column("doc_id"), "label": batch.column("label"), "found": own}

    kind = docs.schema[doc_id].dataType.simpleString()
    gathered = map_rows(sample, found, f"doc_id {kind}, label int, found array<int>").repartition(1).sortWithinPartitions("doc_id")

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, values, rows = set(), [], []
        for batch in batches:
            own = batch.column("found")
            for k, doc_id in enumerate(batch.column("doc_id").to_pylist()):
                if doc_id not in ids:
                    ids.add(doc_id)
                    rows.append(own[k].values.to_numpy())
                    values.append(batch.column("label")[k].as_py() > 0)
        model = _fit(rows, np.array(values, bool), cost, rounds)
        fields = [[model.squares], [model.weights], [model.bias], [model.slope], [model.height]]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in fields], ["squares", "weights", "bias", "slope", "height"])

    schema = "squares array<double>, weights array<double>, bias double, slope double, height double"
    row = gathered.mapInArrow(learn, schema).first()
    if row is None:
        return _fit([], np.empty(0, bool), cost, rounds)
    return Model(np.array(row["squares"]), np.array(row["weights"]), row["bias"], row["slope"], row["height"])


def scored(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score) of every row from its whole text alone; null and empty texts get the score of no n-grams."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batch: pa.RecordBatch) -> dict[str, list]:
        return {
            "doc_id": batch.column("doc_id"),
            "score": [shared.value.score(text) for text in batch.column("text").to_pylist()],
        }

    return map_rows(rows, score, f"doc_id {docs.schema[doc_id].dataType.simpleString()}, score double")


def accepted(docs: DataFrame, model: Model, least: float = 0.3, text: str = "text") -> DataFrame:
    """The rows of `docs`, all columns, whose text scores at least `least`. Empty tables stay empty."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = [shared.value.score(value) >= least for value in batch.column(text).to_pylist()]
            yield batch.filter(pa.array(good, pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
