"""Language identification by error-correcting output codes.

Every language has a codeword. One binary classifier a bit (logistic regression on hashed byte
n-grams of the lower-cased text) predicts the bits; the language whose codeword has the smallest
sum of logistic losses wins. A text between two codewords is flagged as ambiguous.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorloom.llm import features
from sensorloom.llm.common import free_name, release, slices
from sensorloom.session import ship

ORDERS = (1, 2, 3, 4)
#: Shares of n-grams are small numbers; this brings them near one.
SCALE = 64.0
#: Rows a language that the classifiers are fitted on, about, at most.
ROWS_PER_LANGUAGE = 800
EPOCHS = 12
#: Below this probability of the nearest codeword a text is ambiguous.
AMBIGUOUS = 0.6
UNKNOWN = "und"
RESULT = "lang_pred string, score double, ambiguous boolean"


@dataclass
class LanguageModel:
    languages: list[str]
    codes: np.ndarray  # a row of +1 and -1 for each language
    weights: np.ndarray  # a column for each bit
    bias: np.ndarray


def codewords(k: int) -> np.ndarray:
    """k rows of +1 and -1: all different splits up to 5 languages, else the best of random codes by least distance."""
    if k <= 5:
        bits = np.arange(1, max(2, 1 << max(0, k - 1)))
        rows = [np.ones(len(bits))] + [np.where(bits >> i & 1, -1.0, 1.0) for i in range(max(0, k - 1))]
        return np.array(rows[:k])
    rng, n, best = np.random.default_rng(17), int(np.ceil(10 * np.log2(k))), None
    for _ in range(200):
        m = rng.choice([-1.0, 1.0], (k, n))
        m[0, np.abs(m.sum(axis=0)) == k] *= -1
        least = ((n - m @ m.T) / 2 + np.eye(k) * n).min()
        if best is None or least > best[0]:
            best = (least, m)
    return best[1]


def _features(texts: pa.Array):
    return features.parts(texts, ORDERS, features.LETTERS, False)


def fit(labels: np.ndarray, rows: list, epochs: int = EPOCHS) -> LanguageModel:
    """One logistic regression for each bit of the codewords, on the driver; the sample is bounded."""
    languages = sorted(set(labels))
    codes = codewords(len(languages))
    target = codes[np.searchsorted(languages, labels)] if languages else np.zeros((0, 1))
    weights, bias = np.zeros((1 << features.BITS, codes.shape[1] if languages else 1), np.float32), np.zeros(codes.shape[1] if languages else 1, np.float32)
    step, rng = features.adam([weights, bias], 0.05), np.random.default_rng(3)
    for _ in range(epochs if len(languages) > 1 else 0):
        order = rng.permutation(len(rows))
        for i in range(0, len(order), 64):
            at = order[i : i + 64]
            x, t = features.dense(rows, at) * SCALE, target[at]
            z = x @ weights + bias
            g = (-t / (1 + np.exp(np.clip(t * z, -30, 30))) / len(at)).astype(np.float32)
            step([x.T @ g + 1e-4 * weights, g.sum(axis=0)])
    return LanguageModel(languages, codes, weights, bias)


def train(rows: DataFrame, text: str = "text", lang: str = "lang", id: str = "doc_id", most: int = ROWS_PER_LANGUAGE) -> LanguageModel:
    """Fit on at most about ``most`` labelled rows of each language; rows without text or language teach nothing."""
    ship(rows.sparkSession)
    usable = rows.where(F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}")).select(lang, text, id)
    return fit(*features.training_set(features.bounded_sample(usable, lang, id, most), lang, text, _features))


def losses(model: LanguageModel, z: np.ndarray) -> np.ndarray:
    """Loss-weighted distance of each text's bit scores from each codeword."""
    return np.logaddexp(0.0, -z[:, None, :] * model.codes[None]).sum(axis=2)


def predict(model: LanguageModel, texts: pa.Array, no_letter: np.ndarray) -> pa.StructArray:
    if not model.languages:
        no_letter = np.ones(len(texts), bool)
    loss = losses(model, features.means(_features(texts), model.weights) * SCALE + model.bias) if model.languages else np.zeros((len(texts), 1))
    weight = np.exp(loss.min(axis=1, keepdims=True) - loss)
    best, score = loss.argmin(axis=1), 1.0 / weight.sum(axis=1)
    names = [UNKNOWN if none else model.languages[b] for b, none in zip(best, no_letter)]
    score = np.where(no_letter, 0.0, score)
    return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(score), pa.array(score < AMBIGUOUS)], ["lang_pred", "score", "ambiguous"])


def identify(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """All rows and columns with ``lang_pred``, ``score`` and ``ambiguous`` added.

    A text that is null or has no letter is ``und`` with score 0, and ambiguous; so is every text if
    no language was learned. With one learned language every other text gets it with score 1. Columns
    of ``docs`` called like the three new ones are replaced. An empty table stays empty.
    """
    spark = docs.sparkSession
    ship(spark)
    sent = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, letters in batches:
            table = pa.RecordBatch.from_arrays([texts, letters], ["t", "l"])
            done = [predict(sent.value, s.column(0), ~s.column(1).to_numpy(zero_copy_only=False)) for s in slices(table, 0, 1 << 20)]
            yield pa.concat_arrays(done) if done else pa.array([], pa.struct([("lang_pred", pa.string()), ("score", pa.float64()), ("ambiguous", pa.bool_())]))
        release()

    found = F.arrow_udf(run, RESULT)(F.col(text), F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)))
    names = [c for c in docs.columns if c.lower() not in ("lang_pred", "score", "ambiguous")]
    result = free_name(docs, "found")
    return docs.select(*names, found.alias(result)).select(*names, f"{result}.*")
