"""A quality classifier of supervised subword embeddings.

Hashed words and byte n-grams have learned vectors; a text is the mean of its vectors, and a softmax
over two classes reads it. All is trained by stochastic gradient descent in numpy on a bounded
sample. As the output is linear in the mean, scoring needs one number a feature: the difference of
the two classes' outputs for its vector.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorloom.llm import features
from sensorloom.llm.common import release, slices
from sensorloom.session import ship

ORDERS = (2, 3)
DIMENSIONS = 12
SCALE = 64.0
#: Labelled rows of each class that the model is fitted on, about, at most.
ROWS_PER_CLASS = 1500
EPOCHS = 12
#: A text with at least this probability of class 1 is predicted as 1.
THRESHOLD = 0.3


@dataclass
class QualityModel:
    vectors: np.ndarray
    output: np.ndarray  # a column for each class
    bias: np.ndarray

    def folded(self) -> tuple[np.ndarray, float]:
        return (self.vectors @ (self.output[:, 1:] - self.output[:, :1])) * SCALE, float(self.bias[1] - self.bias[0])


def _features(texts: pa.Array):
    return features.parts(texts, ORDERS, features.AS_IS, True)


def fit(labels: np.ndarray, rows: list, epochs: int = EPOCHS) -> QualityModel:
    """Softmax over the mean vector; each class weighs as much as it has rows."""
    rng = np.random.default_rng(11)
    vectors = rng.normal(0, 0.1, (1 << features.BITS, DIMENSIONS)).astype(np.float32)
    output = rng.normal(0, 0.3, (DIMENSIONS, 2)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    labels = labels.astype(int)
    step = features.adam([vectors, output, bias], 0.01)
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for i in range(0, len(order), 64):
            at = order[i : i + 64]
            x = features.dense(rows, at) * SCALE
            mean = x @ vectors
            z = mean @ output + bias
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(at)), labels[at]] -= 1
            g = p / len(at)
            step([x.T @ (g @ output.T) + 1e-5 * vectors, mean.T @ g + 1e-4 * output, g.sum(axis=0)])
    return QualityModel(vectors, output, bias)


def train(docs: DataFrame, labels: DataFrame, text: str = "text", id: str = "doc_id", label: str = "quality", most: int = ROWS_PER_CLASS) -> QualityModel:
    """Fit on at most about ``most`` labelled rows of each class; labels other than 0 and 1, ids and null texts teach nothing."""
    ship(docs.sparkSession)
    usable = labels.where(F.col(label).isin(0, 1) & F.col(id).isNotNull()).select(id, F.col(label).cast("int").alias("_label"))
    # The bound holds for what is broadcast, too: 2 * most rows of two numbers.
    chosen = F.broadcast(features.bounded_sample(usable, "_label", id, most).limit(4 * most))
    sample = docs.select(id, text).join(chosen, id).where(F.col(text).isNotNull())
    return fit(*features.training_set(sample, "_label", text, _features))


def score(docs: DataFrame, model: QualityModel, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """All rows and columns with ``score`` (probability of class 1) and ``predicted`` (1 from ``threshold`` on).

    A null or empty text has no features and gets the score of the bias alone. A model without
    training rows scores near one half. Columns called like the new ones are replaced.
    """
    spark = docs.sparkSession
    ship(spark)
    sent = spark.sparkContext.broadcast(model.folded())

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        weights, bias = sent.value
        for texts in batches:
            table = pa.RecordBatch.from_arrays([texts], ["t"])
            z = [features.means(_features(s.column(0)), weights)[:, 0] + bias for s in slices(table, 0, 1 << 20)]
            yield pa.array(1 / (1 + np.exp(-np.clip(np.concatenate([np.zeros(0), *z]), -500, 500))))
        release()

    names = [c for c in docs.columns if c.lower() not in ("score", "predicted")]
    scored = docs.select(*names, F.arrow_udf(run, "double")(F.col(text)).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
