"""Quality rules with compression bands.

Prose of a given length compresses by a ratio that varies little. Text far above its band repeats
itself; text far below is noise. The ratio is zstandard's, over the whole text and over chunks of a
fixed size, so a repetitive half of a long text shows too. Limits depend on the length: a short
text compresses less than a long one of the same kind. They are fitted on all documents labelled good.
"""

import math
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillworks.llm.columns import fresh, once
from tillworks.llm.memory import give_back

FEATURES = T.StructType(
    [T.StructField(n, T.LongType()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_bytes")]
    + [T.StructField("ratio", T.DoubleType()), T.StructField("chunk_ratios", T.ArrayType(T.DoubleType()))]
)
#: Limits on the ratio without any labelled good document to fit on: from this many bytes on, at least, at most.
WIDE = ((0, 0.4, 3.0), (256, 0.7, 4.0), (1024, 0.9, 5.0), (4096, 1.0, 6.5), (16384, 1.1, 8.0))
#: Two classes to each doubling of the length; texts of 2^24 bytes and more share the last one.
CLASSES = 48


@dataclass(frozen=True)
class Bands:
    """Limits on the ratio by length class and for chunks; which share of chunks may lie outside."""

    whole: dict[int, tuple[float, float]] = field(default_factory=dict)
    chunk: tuple[float, float] = (0.9, 6.5)
    chunk_bytes: int = 4096
    level: int = 3
    outside: float = 0.25

    def limits(self, length_class: int) -> tuple[float, float]:
        if length_class in self.whole:
            return self.whole[length_class]
        at_least = 2 ** (length_class / 2)
        return next((lo, hi) for start, lo, hi in reversed(WIDE) if at_least >= start or start == 0)


def _repeated_words(words: list[bytes]) -> int:
    """Words in windows of five words that occur twice or more."""
    windows = list(zip(words, words[1:], words[2:], words[3:], words[4:]))
    if len(set(windows)) == len(windows):
        return 0
    seen, twice = set(), set()
    for w in windows:
        (twice if w in seen else seen).add(w)
    n, covered = 0, 0  # words before `covered` are counted or ruled out
    for i, w in enumerate(windows):
        if w in twice:
            n += i + 5 - max(i, covered)
            covered = i + 5
    return n


def _features(text: str, compress, chunk_bytes: int) -> dict:
    raw = text.encode()
    words = raw.split()  # at the ASCII white space alone
    lines = [x for x in raw.split(b"\n") if x and not x.isspace()]
    starts = [*range(0, len(raw) - chunk_bytes + 1, chunk_bytes)] if len(raw) >= chunk_bytes else []
    if starts and starts[-1] + chunk_bytes < len(raw):
        starts.append(len(raw) - chunk_bytes)
    return {
        "n_words": len(words),
        "word_chars": len(text) - sum(map(raw.count, (b" ", b"\t", b"\n", b"\v", b"\f", b"\r"))),
        "n_symbols": sum(map(raw.count, (b"#", b"*", b"$", b"%", b"&", b"|", b"<", b">"))),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": _repeated_words(words),
        "n_bytes": len(raw),
        "ratio": len(raw) / len(compress(raw)) if raw else 0.0,
        "chunk_ratios": [chunk_bytes / len(compress(raw[i : i + chunk_bytes])) for i in starts],
    }


def features(text: Column, chunk_bytes: int = 4096, level: int = 3) -> Column:
    """The counts and ratios of a text as a struct; a null text counts as empty, with ratio 0.

    Words are runs without ASCII white space. Chunks cover the whole text: the last one overlaps
    the one before where the length is no multiple of the size. A text shorter than one chunk has
    none.
    """

    @F.arrow_udf(FEATURES)
    def measure(texts: pa.Array) -> pa.Array:
        import zstandard

        compress = zstandard.ZstdCompressor(level=level).compress
        names = [f.name for f in T_ARROW][:-1]
        columns, ratios, ends = {n: [] for n in names}, [], [0]
        for x in texts:
            found = _features(x.as_py() or "", compress, chunk_bytes)
            for n in names:
                columns[n].append(found[n])
            ratios += found["chunk_ratios"]
            ends.append(len(ratios))
        chunks = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ratios, pa.float64()))
        arrays = [pa.array(columns[n], T_ARROW.field(n).type) for n in names]
        give_back()
        return pa.StructArray.from_arrays([*arrays, chunks], [*names, "chunk_ratios"])

    return once(measure)(text)


T_ARROW = pa.struct(
    [pa.field(n, pa.int64()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_bytes")]
    + [pa.field("ratio", pa.float64()), pa.field("chunk_ratios", pa.list_(pa.float64()))]
)


def base_failed(f: Column) -> Column:
    """Too few words, or more than a fifth of them in repeated windows."""
    return (f["n_words"] < 10) | (100 * f["n_repeat_words"] > 20 * f["n_words"])


def length_class(n_bytes: Column) -> Column:
    return F.least(F.floor(2 * F.log2(F.greatest(n_bytes, F.lit(1)))), F.lit(CLASSES)).cast("int")


def in_bands(f: Column, bands: Bands) -> Column:
    """Whether the whole text and enough of its chunks lie within their limits."""
    limits = [bands.limits(k) for k in range(CLASSES + 1)]
    at = length_class(f["n_bytes"]) + 1
    low = F.element_at(F.array(*[F.lit(lo) for lo, _ in limits]), at)
    high = F.element_at(F.array(*[F.lit(hi) for _, hi in limits]), at)
    lo, hi = bands.chunk
    odd = F.size(F.filter(f["chunk_ratios"], lambda r: (r < lo) | (r > hi)))
    return f["ratio"].between(low, high) & (odd <= bands.outside * F.size(f["chunk_ratios"]))


def fit_bands(docs: DataFrame, labels: DataFrame, weight: float = 50.0, spread: float = 4.0, chunk_bytes: int = 4096) -> Bands:
    """Limits around the ratios of all documents labelled good (quality = 1).

    Every length class gets mean +- spread * deviation, shrunk towards its neighbours by count, see
    `shrunk`. The deviation counts as a fiftieth of the mean at least, so many copies of one text
    can't close the band. Chunks have the texts of their own length for neighbours. Without any good
    document there is nothing to fit, and the wide limits stay. Documents that fail the base rules
    don't count.
    """
    good = labels.filter(F.col("quality") == 1).select(F.col("doc_id").alias("_id")).filter(F.col("_id").isNotNull()).distinct()
    f = docs.select("doc_id", features(F.col("text"), chunk_bytes).alias("f"))
    # Both levels in one list: class -1 holds the chunks, as their number, sum and sum of squares.
    add = lambda of: F.aggregate("f.chunk_ratios", F.lit(0.0), lambda x, r: x + of(r))
    row = lambda k, n, s, q: F.struct(k.cast("int").alias("k"), n.cast("long").alias("n"), s.alias("s"), q.alias("q"))
    ratio, chunks = F.col("f.ratio"), F.size("f.chunk_ratios")
    both = F.array(
        row(length_class(F.col("f.n_bytes")), F.lit(1), ratio, ratio * ratio),
        row(F.lit(-1), chunks, add(lambda r: r), add(lambda r: r * r)),
    )
    # The texts are measured where they lie, and only the ratios are dealt out. An inner join, as a
    # semi join would be moved below the features. Labels grow with the documents: no broadcast.
    narrow = f.select("doc_id", F.when(~base_failed(F.col("f")), both).alias("both"))
    ratios = narrow.join(good.hint("merge"), F.col("doc_id") == F.col("_id")).select(F.explode("both").alias("x"))
    rows = ratios.groupBy("x.k").agg(F.sum("x.n").alias("n"), F.sum("x.s").alias("s"), F.sum("x.q").alias("q")).collect()
    # At most a row for each class.
    found = {r["k"]: (r["n"], r["s"] / r["n"], max(r["q"] / r["n"] - (r["s"] / r["n"]) ** 2, 0.0)) for r in rows if r["n"]}
    own_chunks = found.pop(-1, None)
    if not found:
        return Bands(chunk_bytes=chunk_bytes)
    whole = {k: shrunk(found.get(k), _neighbours(found, k), weight, spread) for k in range(CLASSES + 1)}
    at = min(int(2 * math.log2(max(chunk_bytes, 1))), CLASSES)
    chunk = shrunk(own_chunks, _neighbours(found, at, own=True), weight, spread)
    return Bands(whole=whole, chunk=chunk, chunk_bytes=chunk_bytes)


def _pooled(parts: list[tuple[float, float, float]]) -> tuple[float, float, float]:
    """Count, mean and variance of several (count, mean, variance) together."""
    n = sum(p[0] for p in parts)
    mean = sum(p[0] * p[1] for p in parts) / n
    return n, mean, sum(p[0] * (p[2] + (p[1] - mean) ** 2) for p in parts) / n


def _neighbours(found: dict, k: int, own: bool = False) -> tuple[float, float, float] | None:
    """The other classes together; each doubling of the distance in length halves their count."""
    parts = [(n * 2 ** (-abs(j - k) / 2), m, v) for j, (n, m, v) in found.items() if own or j != k]
    return _pooled(parts) if parts else None


def shrunk(own: tuple | None, near: tuple | None, weight: float, spread: float) -> tuple[float, float]:
    """Limits from a class's own (count, mean, variance) and its neighbours', continuous in the counts.

    The neighbours count as `weight` documents at most, so a class of many keeps its own mean and
    deviation and one of none takes theirs. Limits widen by sqrt(1 + weight / documents), since the
    mean and deviation of few are uncertain.
    """
    support = (own[0] if own else 0) + (near[0] if near else 0)
    parts = [own] if own else []
    if near:
        parts.append((weight * near[0] / (weight + near[0]), near[1], near[2]))
    _, mean, variance = _pooled(parts)
    wide = spread * max(math.sqrt(variance), mean / 50) * math.sqrt(1 + weight / support)
    return mean - wide, mean + wide


def judge(docs: DataFrame, bands: Bands | None = None) -> DataFrame:
    """Per document: its counts, ratio, whether it fails the base rules and whether it is kept.

    One row for each input row, repeated rows and ids included; columns other than doc_id and text
    play no part. A null or empty text has no words and fails. An empty table gives an empty one.
    """
    bands = bands or Bands()
    f = F.col("f")
    measured = docs.select("doc_id", features(F.col("text"), bands.chunk_bytes, bands.level).alias("f"))
    failed = base_failed(f)
    return measured.select(
        "doc_id",
        *[f[n].alias(n) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        failed.alias("base_failed"),
        (~failed & in_bands(f, bands)).alias("kept"),
        f["n_bytes"].alias("n_bytes"),
        f["ratio"].alias("ratio"),
    )


def keep(docs: DataFrame, bands: Bands | None = None) -> DataFrame:
    """The rows of docs that pass, with all their columns."""
    bands = bands or Bands()
    name = fresh(docs, "f")
    measured = docs.withColumn(name, features(F.col("text"), bands.chunk_bytes, bands.level))
    f = F.col(name)
    return measured.filter(~base_failed(f) & in_bands(f, bands)).drop(name)
