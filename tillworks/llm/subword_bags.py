"""Toxicity by bags of subwords: every character n-gram has a vector, a text is the mean of its vectors.

A linear softmax reads the mean. Vectors and softmax are trained together, so n-grams that
toxic words share move together, and a misspelling that was never seen lies near the words it is made
of. Words are what lies between ASCII characters other than letters and digits, in lower case; n-grams
are of 3 to 6 UTF-8 bytes, of which a space may be the first or last, and are hashed to rows of the
table of vectors. An n-gram weighs the root of its count, so a word that fills a text doesn't speak for
all of it, and the mean is over the weights and a constant, so a text of few words is close to no text.

As the softmax is linear in the mean, a text's logit is the mean over its n-grams of one number for each
row of the table. Scoring looks that number up and needs no vectors.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


SIZES = (3, 4, 5, 6)
#: Bytes of text that are hashed at a time; a longer word is cut there.
SEGMENT = 1 << 20
_SPACES = bytes(c if chr(c).isalnum() or c >= 128 else 32 for c in range(256))


def _cut(text: str | None) -> Iterator[bytes]:
    """The text in lower case with a space for all that ends words, in segments cut at spaces."""
    raw = (text or "").lower().encode().translate(_SPACES)
    at = 0
    while at < len(raw):
        end = min(at + SEGMENT, len(raw))
        if end < len(raw):
            space = raw.rfind(b" ", at, end)
            end = space if space > at else end
        yield raw[at:end]
        at = end


def _grams(raw: bytes, rows: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each size the places of the n-grams in a text and their rows in the table."""
    codes = np.frombuffer(raw, np.uint8)
    spaces = np.cumsum(codes == 32, dtype=np.int32)
    wide, packed, shift = codes.astype(np.uint64), None, np.uint64(64 - (rows - 1).bit_length())
    for n in range(1, max(SIZES) + 1):
        count = len(codes) - n + 1
        if count <= 0:
            return
        packed = wide.copy() if packed is None else packed[:count] | (wide[n - 1 :] << np.uint64(8 * n - 8))
        if n in SIZES:
            # No space but at the ends, and not both ends of one character.
            inner = spaces[n - 2 : n - 2 + count] - spaces[:count]
            places = np.flatnonzero(inner == 0)
            # Multiplied twice with a shift between: the high bits then depend on all bytes.
            h = packed[places] * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(32)
            yield places, ((h * np.uint64(0xD6E8FEB86659FD93)) >> shift).astype(np.int32)


def bag(text: str | None, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the n-grams of a whole text, ascending, and the root of how often each occurs."""
    counts = np.zeros(rows, np.int64)
    for segment in _cut(text):
        for _, found in _grams(b" " + segment + b" ", rows):
            counts += np.bincount(found, minlength=rows)
    used = np.flatnonzero(counts)
    return used.astype(np.int32), np.sqrt(counts[used]).astype(np.float32)


@dataclass(frozen=True)
class Model:
    """Vectors of the n-grams and the softmax over both classes.

    `smoothing` is what the weights of a text are added to before they are divided by; `shift` makes up
    for a sample in which the share of toxic texts is another one than among all labelled texts.
    """

    vectors: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    smoothing: float = 50.0
    shift: float = 0.0

    def numbers(self) -> np.ndarray:
        """Each n-gram's part in the difference of the two logits."""
        return (self.vectors @ (self.weights[1] - self.weights[0])).astype(np.float32)

    def offset(self) -> float:
        return float(self.bias[1] - self.bias[0]) + self.shift

    def vector(self, text: str) -> np.ndarray:
        """The mean of the vectors of a text or word."""
        used, weight = bag(text, len(self.vectors))
        return weight @ self.vectors[used] / max(float(weight.sum()), 1.0)


def train(
    bags: list[tuple[np.ndarray, np.ndarray]], toxic: np.ndarray, rows: int, dim: int = 8, steps: int = 430,
    batch: int = 256, rate: float = 0.05, decay: float = 2e-6, smoothing: float = 50.0, seed: int = 7,
) -> Model:
    """Vectors and softmax by `steps` steps of Adam on the mean log loss of small batches, with weight decay.

    The gradient of a vector is the softmax's weights times a number for each n-gram and class, so a
    step costs a gather and a bincount over the batch's n-grams, whatever the dimension. The bias is
    that of the classes' shares, so a text without n-grams is as likely toxic as any. The same bags in the same
    order give the same model.
    """
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / dim, 1 / dim, (rows, dim))
    weights, bias = rng.normal(0, 0.1, (2, dim)), np.array([0.0, _logit(float(np.mean(toxic)))])
    parameters = [vectors, weights]
    first, second = [np.zeros_like(p) for p in parameters], [np.zeros_like(p) for p in parameters]
    totals = np.array([b[1].sum(dtype=float) + smoothing for b in bags])
    left = np.empty(0, np.int64)
    for done in range(steps):
        left = left if len(left) else rng.permutation(len(bags))
        chosen, left = left[:batch], left[batch:]
        used = np.concatenate([bags[k][0] for k in chosen])
        of = np.repeat(np.arange(len(chosen)), [len(bags[k][0]) for k in chosen])
        share = np.concatenate([bags[k][1] for k in chosen]) / totals[chosen][of]
        by_row = vectors @ weights.T
        logits = np.stack([np.bincount(of, by_row[used, c] * share, len(chosen)) for c in (0, 1)], 1) + bias
        logits -= logits.max(1, keepdims=True)
        wrong = np.exp(logits)
        wrong /= wrong.sum(1, keepdims=True)
        wrong[np.arange(len(chosen)), toxic[chosen]] -= 1
        wrong /= len(chosen)
        pull = np.stack([np.bincount(used, wrong[of, c] * share, rows) for c in (0, 1)], 1)
        gradients = (pull @ weights + decay * vectors, pull.T @ vectors + decay * weights)
        t = done + 1
        step = rate * (1 - done / steps) * np.sqrt(1 - 0.999**t) / (1 - 0.9**t)
        for p, g, m, v in zip(parameters, gradients, first, second):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= step * m / (np.sqrt(v) + 1e-8)
    return Model(vectors.astype(np.float32), weights, bias, smoothing)


def _logit(share: float) -> float:
    share = min(max(share, 1e-6), 1 - 1e-6)
    return float(np.log(share / (1 - share)))


_BAG = T.StructType([T.StructField("used", T.ArrayType(T.IntegerType())), T.StructField("weight", T.ArrayType(T.FloatType()))])


def _bags(rows: int):
    @F.arrow_udf(_BAG)
    def bags(texts: pa.Array) -> pa.Array:
        found = [bag(x.as_py(), rows) for x in texts]
        ends = pa.array(np.cumsum([0] + [len(used) for used, _ in found]), pa.int32())
        lists = [pa.ListArray.from_arrays(ends, pa.array(np.concatenate([b[k] for b in found]) if found else [], t)) for k, t in ((0, pa.int32()), (1, pa.float32()))]
        return pa.StructArray.from_arrays(lists, ["used", "weight"])

    return bags


def fit(
    docs: DataFrame, labels: DataFrame, most_toxic: int = 2000, most_clean: int = 6000, rows: int = 1 << 16, dim: int = 8,
) -> Model:
    """A model fitted on labelled documents: at most `most_toxic` with toxic = 1, `most_clean` with 0.

    That sample, of the doc_ids with the smallest hashes, is the bound on what is trained on; scoring
    knows no bound. Bags are made where the documents lie; one task then trains on them, with `rows`
    numbers a document at most. Labels without id or class don't count; an id with both classes is toxic. Of
    several documents with one id the smallest text counts. Without labels of both
    classes the model has nothing to tell texts apart by, and gives all of them the share of toxic labels.
    """
    known = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    counts = known.agg(F.count("*").alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic")).first()
    share = counts["toxic"] / counts["n"] if counts["n"] else 0.0
    if not 0 < share < 1:
        return Model(np.zeros((rows, dim), np.float32), np.zeros((2, dim)), np.zeros(2), shift=_logit(share))
    order = [F.xxhash64("doc_id"), "doc_id"]
    chosen = [known.filter(F.col("toxic") == c).orderBy(*order).limit(n) for c, n in ((1, most_toxic), (0, most_clean))]
    # Some thousand rows, as the two limits say.
    sample = F.broadcast(chosen[0].unionByName(chosen[1]).withColumnRenamed("doc_id", "id"))
    texts = docs.select("doc_id", "text").join(sample, F.col("doc_id") == F.col("id")).groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    bags = texts.select("doc_id", "toxic", _bags(rows)("text").alias("bag")).select("doc_id", "toxic", "bag.used", "bag.weight")

    def learn(batches):
        found, toxic = [], []
        for batch in batches:
            toxic += batch.column("toxic").to_pylist()
            lists = batch.column("used"), batch.column("weight")
            found += [tuple(column[k].values.to_numpy() for column in lists) for k in range(batch.num_rows)]
        if not found:
            return
        m = train(found, np.array(toxic, np.int64), rows, dim)
        out = [m.vectors.astype("<f4").tobytes(), m.weights.astype("<f8").tobytes(), m.bias.astype("<f8").tobytes(), float(np.mean(toxic))]
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in out], ["vectors", "weights", "bias", "share"])

    schema = "vectors binary, weights binary, bias binary, share double"
    learnt = bags.repartition(1).sortWithinPartitions("doc_id").mapInArrow(learn, schema).collect()
    if not learnt or not 0 < learnt[0]["share"] < 1:
        return Model(np.zeros((rows, dim), np.float32), np.zeros((2, dim)), np.zeros(2), shift=_logit(share))
    (got,) = learnt
    return Model(
        np.frombuffer(got["vectors"], "<f4").reshape(rows, dim),
        np.frombuffer(got["weights"], "<f8").reshape(2, dim),
        np.frombuffer(got["bias"], "<f8"),
        shift=_logit(share) - _logit(got["share"]),
    )


def toxicity(model: Model, text: str = "text") -> Column:
    """The probability that a text is toxic. A null or empty text has the share of toxic labels.

    Whole texts count, however long: they are hashed in segments of 1 MB, and a text takes `rows`
    numbers besides.
    """
    rows, numbers, offset, smoothing = len(model.vectors), model.numbers(), model.offset(), model.smoothing

    @F.arrow_udf(T.DoubleType())
    def score(texts: pa.Array) -> pa.Array:
        logits = np.empty(len(texts))
        for k, x in enumerate(texts):
            used, weight = bag(x.as_py(), rows)
            logits[k] = float(numbers[used] @ weight) / (float(weight.sum()) + smoothing) + offset
        return pa.array(1 / (1 + np.exp(-np.clip(logits, -700, 700))))

    return score(F.col(text))


def score(docs: DataFrame, model: Model, at_least: float = 0.3) -> DataFrame:
    """All rows of docs with score, from 0 to 1, and predicted, 1 where the score is `at_least` or more.

    Every row has its own score, repeated rows and ids included; an empty table stays empty. Columns
    other than text play no part, and result columns replace those of the same name.
    """
    kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("score", "predicted")]
    scored = docs.select(*kept, toxicity(model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= at_least).cast("int"))
