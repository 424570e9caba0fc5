"""Language of documents by sparse multinomial logistic regression on character n-grams.

Features are TF-IDF values of hashed 1- to 3-grams of lower-case letters, where every run of
other signs is one gap. Document frequencies cover all rows that may be learned from. The
weights are fitted on a bounded sample of them by follow-the-regularised-leader with
elastic-net penalties, which leaves most weights at zero; one part of the sample is set aside
to fit a temperature, by which scores become probabilities.
"""

from __future__ import annotations

import math
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .batches import small_batches

ORDERS = (1, 2, 3)
BITS = 17
FEATURES = 1 << BITS
#: documents of each language that the weights are fitted on, at most
SAMPLE_PER_LANGUAGE = 1_000
#: every so many-th document of the sample fits the temperature instead
CALIBRATION_PART = 5
UNKNOWN = "und"
CHUNK = 1 << 20  # characters looked at together


@dataclass(frozen=True)
class Ftrl:
    """Step size, its offset, both penalties, and passes over the sample."""

    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.01
    passes: int = 3


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # (FEATURES, languages): weight times IDF and scale
    bias: np.ndarray
    temperature: float


class Grams:
    """Feature numbers of texts; long texts in slices that overlap by what a gram needs."""

    SCALE = 100.0  # of a term frequency

    def __init__(self) -> None:
        # letter or gap, in lower case; signs beyond 16 bits count by their category alone
        table = np.zeros(1 << 16, np.uint32)
        for c in range(1 << 16):
            s = chr(c)
            if s.isalpha():
                low = s.lower()
                table[c] = ord(low) if len(low) == 1 else c
        self.table = table

    def _letters(self, text: str) -> np.ndarray:
        """Code points of letters, zeros for all others."""
        cp = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        out = self.table[np.minimum(cp, 0xFFFF)]
        for i in np.flatnonzero(cp > 0xFFFF):
            out[i] = cp[i] if unicodedata.category(chr(cp[i]))[0] == "L" else 0
        return out

    def of(self, text: str | None) -> Iterator[np.ndarray]:
        """Feature numbers of all grams with a letter, in parts."""
        text = text or ""
        # one zero stands for each run of others, and at both ends
        tail, known = np.zeros(1, np.uint32), 0
        for at in range(0, max(1, len(text)), CHUNK):
            ends = [np.zeros(1, np.uint32)] if at + CHUNK >= len(text) else []
            c = np.concatenate([tail, self._letters(text[at : at + CHUNK]), *ends])
            c = c[np.concatenate([[True], (c[1:] != 0) | (c[:-1] != 0)])]
            parts = []
            for n in ORDERS:
                if len(c) < n:
                    continue
                h = np.full(len(c) - n + 1, n, np.uint32)
                any_letter = np.zeros(len(h), bool)
                for k in range(n):
                    x = c[k : len(c) - n + 1 + k]
                    h = (h ^ x) * np.uint32(0x9E3779B1)
                    h ^= h >> np.uint32(15)
                    any_letter |= x != 0
                # those that the slice before has had
                any_letter[: max(0, known - n + 1)] = False
                parts.append((h * np.uint32(0x85EBCA6B) >> np.uint32(32 - BITS))[any_letter])
            if parts:
                yield np.concatenate(parts)
            tail = c[-(max(ORDERS) - 1) :]
            known = len(tail)


def _document_frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    grams, df, n = Grams(), np.zeros(FEATURES + 1, np.int64), 0
    for batch in batches:
        for text in batch.column(0):
            seen = np.zeros(FEATURES, bool)
            for ids in grams.of(text.as_py()):
                seen[ids] = True
            df[:FEATURES] += seen
            n += 1
    df[FEATURES] = n  # the number of documents goes along as one more feature
    found = np.flatnonzero(df)
    yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(df[found])], ["feature", "df"])


def _profiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Term frequencies of whole texts: at most FEATURES numbers each."""
    grams = Grams()
    for batch in batches:
        for lang, text, order in zip(*[batch.column(k).to_pylist() for k in range(3)], strict=True):
            count = np.zeros(FEATURES, np.int64)
            for ids in grams.of(text):
                count += np.bincount(ids, minlength=FEATURES)
            at = np.flatnonzero(count)
            tf = (count[at] / max(1, count.sum())).astype(np.float32)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang]),
                    pa.array([order]),
                    pa.array([at.astype(np.int32).tobytes()]),
                    pa.array([tf.tobytes()]),
                ],
                ["lang", "nth", "features", "tf"],
            )


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def _fit_weights(rows: list[tuple[np.ndarray, np.ndarray, int]], k: int, how: Ftrl) -> tuple[np.ndarray, np.ndarray]:
    """Weights (FEATURES, k) and bias of the classes; rows: (features, values, class)."""
    z, n = np.zeros((FEATURES + 1, k)), np.zeros((FEATURES + 1, k))

    def weights(at) -> np.ndarray:
        shrunk = np.sign(z[at]) * np.maximum(np.abs(z[at]) - how.l1, 0)
        return -shrunk / ((how.beta + np.sqrt(n[at])) / how.alpha + how.l2)

    order = np.random.default_rng(11)
    for _ in range(how.passes):
        for i in order.permutation(len(rows)):
            at, x, y = rows[i]
            at, x = np.append(at, FEATURES), np.append(x, 1.0)
            w = weights(at)
            p = _softmax(x @ w)
            p[y] -= 1
            g = x[:, None] * p
            old = n[at]
            n[at] = old + g * g
            z[at] += g - (np.sqrt(n[at]) - np.sqrt(old)) / how.alpha * w
    w = weights(slice(None))
    return w[:FEATURES], w[FEATURES]


def _fit_temperature(scores: np.ndarray, classes: np.ndarray) -> float:
    """The temperature under which the true classes are likeliest, by golden section on its logarithm."""
    if not len(classes):
        return 1.0

    def loss(t: float) -> float:
        p = _softmax(scores / math.exp(t))
        return -float(np.log(p[np.arange(len(classes)), classes] + 1e-12).mean())

    lo, hi, cut = math.log(0.05), math.log(20.0), (math.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = hi - cut * (hi - lo), lo + cut * (hi - lo)
        lo, hi = (lo, b) if loss(a) <= loss(b) else (a, hi)
    return math.exp((lo + hi) / 2)


def held_out(id_col: Column) -> Column:
    """Rows that nothing is learned from; a null id counts as the empty text."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def fit(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    sample_per_language: int = SAMPLE_PER_LANGUAGE,
    how: Ftrl = Ftrl(),
) -> Model | None:
    """A model of the languages in ``lang_col``; None if no row may be learned from.

    Learns from rows that are not held out and have a text and a language, equal rows once. Ids that
    repeat or are missing are told apart by their texts.
    """
    small_batches(docs.sparkSession)
    rows = docs.filter(~held_out(F.col(id_col)) & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(text_col).alias("text"),
        F.col(lang_col).alias("lang"),
        F.xxhash64(F.col(id_col), F.col(text_col)).alias("place"),
    )
    counts = rows.select("text").mapInArrow(_document_frequencies, "feature long, df long")
    table = counts.groupBy("feature").agg(F.sum("df").alias("df")).collect()  # FEATURES + 1 rows at most
    df = np.zeros(FEATURES + 1)
    for r in table:
        df[r.feature] = r.df
    idf = np.log((1 + df[FEATURES]) / (1 + df[:FEATURES])) + 1

    # places are hashes, hence even: those below a share of them hold the first few of each language
    sizes = rows.groupBy("lang").agg(F.count("*").alias("n"))
    bound = F.lit(-(2.0**63)) + F.least(F.lit(1.0), 4.0 * sample_per_language / F.col("n")) * F.lit(2.0**64)
    # one row for each language, of which the model has a column of weights each
    first = rows.select("lang", "place").join(F.broadcast(sizes), "lang").filter(F.col("place").cast("double") <= bound)
    by_place = Window.partitionBy("lang").orderBy("place")
    chosen = (
        first.select("lang", "place")
        .distinct()
        .withColumn("nth", F.row_number().over(by_place).cast("long"))
        .filter(F.col("nth") <= sample_per_language)
    )
    # equal rows have one place, and are learned from once
    texts = rows.join(F.broadcast(chosen), ["lang", "place"]).groupBy("lang", "nth").agg(F.first("text").alias("text"))
    sample = texts.select("lang", "text", "nth").mapInArrow(
        _profiles, "lang string, nth long, features binary, tf binary"
    )
    sample = sorted(sample.collect(), key=lambda r: (r.lang, r.nth, r.features))
    if not sample:
        return None
    languages = sorted({r.lang for r in sample})
    train, aside = [], []
    for r in sample:
        at = np.frombuffer(r.features, np.int32)
        x = np.frombuffer(r.tf, np.float32) * idf[at] * Grams.SCALE
        (aside if r.nth % CALIBRATION_PART == 0 else train).append((at, x, languages.index(r.lang)))
    w, b = _fit_weights(train, len(languages), how)
    scores = np.array([x @ w[at] + b for at, x, _ in aside]).reshape(-1, len(languages))
    temperature = _fit_temperature(scores, np.array([y for _, _, y in aside], int))
    return Model(languages, (w * idf[:, None] * Grams.SCALE).astype(np.float32), b, temperature)


class Predictor:
    def __init__(self, model: Model | None) -> None:
        self.model, self.grams = model, Grams()

    def of(self, text: str | None) -> tuple[str, float]:
        """Language and probability; ``und`` and 0 without a letter or a model."""
        if self.model is None:
            return UNKNOWN, 0.0
        total, n = np.zeros(len(self.model.languages)), 0
        for ids in self.grams.of(text):
            total += self.model.weights[ids].sum(0, dtype=np.float64)
            n += len(ids)
        if n == 0:
            return UNKNOWN, 0.0
        p = _softmax((total / n + self.model.bias) / self.model.temperature)
        best = int(p.argmax())
        return self.model.languages[best], float(p[best])


def predict(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, held_out, lang_pred, score) for every row of ``docs``, from its text alone.

    Texts that are null or have no letter are ``und`` with score 0, as all are without a
    model. Equal texts get equal results; repeated and null ids change nothing. Languages of
    equal score: the first by name. An empty table gives an empty table; other columns are
    not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predictor = Predictor(model)
        for batch in batches:
            found = [predictor.of(t.as_py()) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([f[0] for f in found], pa.string()),
                    pa.array([f[1] for f in found], pa.float64()),
                ],
                ["id", "held_out", "lang_pred", "score"],
            )

    small_batches(docs.sparkSession)
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"), held_out(F.col(id_col)).alias("held_out"), F.col(text_col).alias("text")
    )
    out = rows.mapInArrow(run, "id long, held_out boolean, lang_pred string, score double")
    return out.withColumnRenamed("id", id_col)


#: with four languages, a probability of 0.35
MARGIN = 2 / 15


def drop_unidentified(
    docs: DataFrame, model: Model | None, text_col: str = "text", margin: float = MARGIN
) -> DataFrame:
    """The rows of ``docs`` whose language is known well enough, all columns.

    A guess among n languages has a probability of 1/n; what is asked for lies above it by
    ``margin`` of what is left to certainty. Without a model, or a letter, no row stays.
    """
    small_batches(docs.sparkSession)
    guess = 1 / len(model.languages) if model else 1.0
    least_score = guess + margin * (1 - guess)
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predictor = Predictor(model)
        for batch in batches:
            found = [predictor.of(t.as_py()) for t in batch.column(place)]
            keep = [lang != UNKNOWN and score >= least_score for lang, score in found]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
