"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Features are hashed n-grams of one to three letters, their counts damped by a logarithm, weighed by inverse document
frequency and scaled to length one. Weights are trained by follow-the-regularised-leader (McMahan et al. 2013) with L1 and
L2 penalties, so most are exactly zero. A temperature fitted on rows kept back makes the probabilities honest.

Languages and document frequencies are counted over all learning rows. The weights are fitted on about ``max_rows`` of them,
as many of each language as there are, up to its share; they are drawn by a hash, each different row once. One task holds the features of
those rows, and of short passages of the ones kept back for the temperature; the driver gets the weights.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from onomast.llm.common import lean, settle

#: Hash buckets of the n-grams.
BUCKETS = 1 << 15
#: Bound of the rows on which the weights are fitted.
MAX_ROWS = 5000
#: Rows of each language at least, as far as there are any.
LEAST_ROWS = 50
#: Rows that a language learns from at least before any is kept back; times that the rows of a language are shown in a round.
FIRST_ROWS, VISITS = 5, 10
UNKNOWN = "und"
_LETTER = np.array([chr(i).isalpha() if not 0xD800 <= i < 0xE000 else False for i in range(1 << 16)])
_STEP = 1 << 20


def code_points(text: str | None) -> np.ndarray:
    """Lower-case letters of a text as code points, each stretch of anything else as one zero; empty without a letter."""
    raw = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), "<u4")
    letter = _LETTER[np.minimum(raw, 0xFFFF)]
    high = np.flatnonzero(raw > 0xFFFF)
    letter[high] = [chr(c).isalpha() for c in raw[high].tolist()]
    if not letter.any():
        return raw[:0]
    x = np.where(letter, raw, 0).astype(np.uint32)
    x = np.concatenate(([np.uint32(0)], x, [np.uint32(0)]))
    return x[np.concatenate(([True], (x[1:] != 0) | (x[:-1] != 0)))]


def counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the text's n-grams, rising, and how often each occurs."""
    x = code_points(text)
    if not len(x):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    total = np.zeros(BUCKETS, np.int64)
    for at in range(0, len(x), _STEP):
        h = x[at : at + _STEP + 2] * np.uint32(0x9E3779B1) + np.uint32(0x85EBCA6B)
        own = len(x[at : at + _STEP])
        g = h.copy()
        for n in range(3):
            if n:
                g = (g[:-1] ^ (g[:-1] >> np.uint32(15))) * np.uint32(0x2C1B3C6D) + h[n:]
            total += np.bincount(((g ^ (g >> np.uint32(13))) * np.uint32(0x297A2D39) >> np.uint32(17))[:own], minlength=BUCKETS)
    nz = np.flatnonzero(total)
    return nz, total[nz]


def weigh(nz: np.ndarray, n: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = (1 + np.log(n)) * idf[nz]
    return v / (np.sqrt((v * v).sum()) or 1.0)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray  # buckets x languages
    bias: np.ndarray
    temperature: float

    def predict(self, text: str | None) -> tuple[str, float]:
        nz, n = counts(text)
        if not len(nz) or not self.languages:
            return UNKNOWN, 0.0
        p = softmax((weigh(nz, n, self.idf) @ self.weights[nz] + self.bias) / self.temperature)
        best = int(p.argmax())
        return self.languages[best], float(p[best])


def ftrl(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, k: int, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 0.01, epochs: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Weights and bias by FTRL-proximal over the rows, epoch after epoch in a fixed shuffled order."""
    z, n = np.zeros((BUCKETS + 1, k)), np.zeros((BUCKETS + 1, k))

    def solve(z: np.ndarray, n: np.ndarray) -> np.ndarray:
        return np.where(np.abs(z) > l1, -(z - np.sign(z) * l1) / ((beta + np.sqrt(n)) / alpha + l2), 0.0)

    order = np.random.default_rng(0)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            nz, v = rows[i]
            nz, v = np.append(nz, BUCKETS), np.append(v, 1.0)
            w = solve(z[nz], n[nz])
            p = softmax(v @ w)
            p[labels[i]] -= 1
            g = v[:, None] * p
            z[nz] += g - (np.sqrt(n[nz] + g * g) - np.sqrt(n[nz])) / alpha * w
            n[nz] += g * g
    w = solve(z, n)
    return w[:-1], w[-1]


def temperature(scores: np.ndarray, labels: np.ndarray) -> float:
    """The divisor of the scores under which the labels are likeliest, by golden-section search over its logarithm."""
    if not len(labels):
        return 1.0
    loss = lambda t: -np.log(softmax(scores / np.exp(t))[np.arange(len(labels)), labels] + 1e-12).mean()
    lo, hi, r = np.log(0.05), np.log(20.0), (5**0.5 - 1) / 2
    for _ in range(40):
        a, b = hi - r * (hi - lo), lo + r * (hi - lo)
        lo, hi = (lo, b) if loss(a) < loss(b) else (a, hi)
    return float(np.exp((lo + hi) / 2))


def passage(text: str | None, number: int) -> str:
    """One to four words of a text, from a place that the number decides."""
    words = (text or "").split()
    at, n = number // 5 % max(1, len(words)), 1 + number // 7 % 4
    return " ".join(words[at : at + n])


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves 2 when divided by 4; false for null."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


_SAMPLE = pa.schema([("lang", pa.string()), ("place", pa.int64()), ("kind", pa.int32()), ("bucket", pa.list_(pa.int32())), ("n", pa.list_(pa.int32()))])


def trained(sample: pa.Table, idf: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray, float]:
    """Languages, weights, bias and temperature from the features of the sample.

    Kinds of rows: 0 to learn from, 1 kept back for the temperature, 2 a short passage of one kept back. A language with fewer than
    ``FIRST_ROWS`` of kind 0 keeps none back, and one with fewer than ``VISITS`` of them is shown these more often.
    """
    sample = sample.sort_by([("place", "ascending"), ("lang", "ascending"), ("kind", "ascending")])
    own = sample["lang"].to_pylist()
    languages = sorted(set(own))
    if not languages:
        return [], np.zeros((BUCKETS, 0)), np.zeros(0), 1.0
    labels = np.array([languages.index(x) for x in own], np.int64)
    kinds = sample["kind"].to_numpy().copy()
    few = np.bincount(labels[kinds == 0], minlength=len(languages))[labels] < FIRST_ROWS
    kinds[few & (kinds == 2)] = -1
    kinds[few & (kinds == 1)] = 0
    rows = [(x, weigh(x, n, idf)) for x, n in ((np.asarray(a.as_py(), np.int64), np.asarray(b.as_py(), np.int64)) for a, b in zip(sample["bucket"], sample["n"], strict=True))]
    learn = np.flatnonzero(kinds == 0)
    shown = np.repeat(learn, np.maximum(1, -(-VISITS // np.bincount(labels[learn], minlength=len(languages))[labels[learn]])))
    weights, bias = ftrl([rows[i] for i in shown], labels[shown], len(languages))
    told = np.flatnonzero([k > 0 and len(r[0]) > 0 for r, k in zip(rows, kinds, strict=True)])
    scores = np.array([rows[i][1] @ weights[rows[i][0]] + bias for i in told]).reshape(-1, len(languages))
    return languages, weights, bias, temperature(scores, labels[told])


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", max_rows: int = MAX_ROWS) -> Model:
    """Learn from text and language of rows that are not held out and have an id and a language.

    Every language of those rows is learned, from all its rows where it has few. Rows repeated whole count in the statistics
    each, and are learned from once (languages with few rows are shown theirs more often). Without such rows the model knows no
    language. The temperature is fitted on rows kept back, of languages that have enough, and on short passages of them, where the
    model errs.
    """
    learn = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    each = {r.lang: r.n for r in learn.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row a language
    total, fair = sum(each.values()), max(LEAST_ROWS, max_rows // max(1, len(each)))

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(BUCKETS, np.int64)
        for b in batches:
            for t in b.column(0):
                df[counts(t.as_py())[0]] += 1
        nz = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(nz), pa.array(df[nz])], ["bucket", "n"])

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, place = b.column(0).to_pylist(), b.column(2).to_pylist()
            back = [p % 5 == 4 for p in place]
            short = [i for i, x in enumerate(back) if x]
            found = [counts(t) for t in texts] + [counts(passage(texts[i], place[i])) for i in short]
            own = pa.array([*range(len(texts)), *short], pa.int64())
            kind = pa.array([int(x) for x in back] + [2] * len(short), pa.int32())
            yield pa.RecordBatch.from_arrays([b.column(1).take(own), b.column(2).take(own), kind, *(pa.array([x[k].astype(np.int32) for x in found], pa.list_(pa.int32())) for k in (0, 1))], ["lang", "place", "kind", "bucket", "n"])

    df = learn.select("text").mapInArrow(lean(frequencies), "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    idf = np.full(BUCKETS, np.log(1.0 + total) + 1)
    idf[df["bucket"].to_numpy()] = np.log((1.0 + total) / (1 + df["n"].to_numpy())) + 1
    place = F.xxhash64("doc_id", "text")
    share = F.element_at(F.create_map(*[F.lit(x) for lang, n in each.items() for x in (lang, min(1.0, fair / n))]), F.col("lang")) if each else F.lit(0.0)
    drawn = learn.where(F.pmod(place, F.lit(1 << 30)) < share * (1 << 30)).select("text", "lang", F.pmod(place, F.lit(1 << 62)).alias("place")).dropDuplicates(["lang", "place"])
    sample = drawn.mapInArrow(lean(features), "lang string, place bigint, kind int, bucket array<int>, n array<int>")
    shared = docs.sparkSession.sparkContext.broadcast(idf)

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages, weights, bias, divisor = trained(pa.Table.from_batches(list(batches), _SAMPLE), shared.value)
        yield pa.RecordBatch.from_arrays([pa.array([languages], pa.list_(pa.string())), pa.array([weights.astype(np.float32).tobytes()]), pa.array([bias.astype(np.float64).tobytes()]), pa.array([divisor])], ["languages", "weights", "bias", "divisor"])

    # the rows are bounded (``max_rows``): one task holds their features and the driver the weights only
    found = sample.repartition(1).mapInArrow(lean(train), "languages array<string>, weights binary, bias binary, divisor double").first()
    languages = list(found.languages) if found else []
    weights = np.frombuffer(found.weights if found else b"", np.float32).reshape(BUCKETS, len(languages))
    return Model(languages, idf.astype(np.float32), weights, np.frombuffer(found.bias if found else b"", np.float64), found.divisor if found else 1.0)


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred and score of every row; ``und`` and 0 where the text is null or has no letter.

    Whole texts are read, whatever their length. Repeated rows give equal results; rows with a null id are judged too.
    Other columns play no part. An empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # buckets x languages numbers, whatever the data

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predict = shared.value.predict
        for b in batches:
            found = [predict(t.as_py()) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([x for x, _ in found], pa.string()), pa.array([x for _, x in found], pa.float64())], ["doc_id", "lang_pred", "score"])

    ids = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return ids.mapInArrow(run, f"doc_id {dict(ids.dtypes)['doc_id']}, lang_pred string, score double")


def accepted(docs: DataFrame, model: Model, least: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose language is known with a probability of at least ``least``.

    Rows whose text is null or has no letter go, and all rows where the model knows no language. Repeated rows and rows without
    an id are judged each. An empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts):
        settle()
        return texts.map(lambda t: shared.value.predict(t)[1])

    return docs.where(score(F.col(text_col)) >= least)
