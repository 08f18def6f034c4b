"""Scores by the difference of two language models' cross-entropy.

A target model is counted over the documents that are labelled good, a background model over all
documents. Both are byte n-gram models over one vocabulary, the 256 byte values, with the same
smoothing: an order-4 count backs off to an order-2 and that to an order-1 estimate. A document's score
is the mean over its bytes of the target's loss less the background's, so how hard a text is in itself
cancels out, and a low score means that it resembles the target.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillworks.session import saved

#: Bytes of an n-gram.
ORDER = 4
_PAD = bytes(ORDER - 1)  # a document starts after zero bytes
_STEP = 1 << 20  # bytes worked on at once
_HELD = 1 << 21  # distinct n-grams that a counting task holds before it passes them on
#: Bytes of text after which a block is closed; bounds the n-grams that a scoring task holds.
BLOCK_BYTES = 8 << 20
_PART = 20_000  # n-grams of a dictionary in one row
_TASK = 1 << 20  # blocks that a task may write


def grams(raw: np.ndarray) -> np.ndarray:
    """Each n-gram as a number, its first byte highest; raw begins with the padding."""
    a = raw.astype(np.uint32)
    return a[:-3] << np.uint32(24) | a[1:-2] << np.uint32(16) | a[2:-1] << np.uint32(8) | a[3:]


def steps(texts: list[bytes]):
    """Padded pieces of the texts, each at most _STEP new bytes of one text or a run of short texts.

    Yields the piece, and for each n-gram of it the text it belongs to, or -1 where it spans two.
    """
    held, owners, size = [], [], 0
    for i, t in enumerate(texts):
        for at in range(0, len(t), _STEP):
            part = t[at : at + _STEP]
            lead = _PAD if at == 0 else t[at - len(_PAD) : at]
            if size + len(part) > _STEP and held:
                yield _piece(held, owners)
                held, owners, size = [], [], 0
            held.append(lead + part)
            owners.append(i)
            size += len(part)
    if held:
        yield _piece(held, owners)


def _piece(held: list[bytes], owners: list[int]) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(b"".join(held), np.uint8)
    owner = np.repeat(np.array(owners), [len(h) for h in held])
    ends = np.cumsum([len(h) for h in held])
    owner = owner[len(_PAD) :].copy()
    for e in ends[:-1]:
        owner[e - len(_PAD) : e] = -1  # the n-gram ends in the next piece's padding
    return raw, owner


def _merged(parts: list[tuple[np.ndarray, ...]]) -> list[tuple[np.ndarray, ...]]:
    """One (gram, target, background) of many, each n-gram once."""
    gram, where = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    counts = [np.bincount(where, np.concatenate([p[k] for p in parts]), len(gram)).astype(np.int64) for k in (1, 2)]
    return [(gram, *counts)]


def _counts(docs: DataFrame) -> DataFrame:
    """(gram, target, background): exact counts over all documents, where docs has text and good."""
    names = ["gram", "target", "background"]

    def rows(parts):
        for gram, target, background in parts:
            for i in range(0, len(gram), 100_000):
                at = slice(i, i + 100_000)
                yield pa.RecordBatch.from_arrays([pa.array(gram[at].view(np.int32)), pa.array(target[at]), pa.array(background[at])], names)

    def count(batches):
        parts, size = [], 0
        for batch in batches:
            texts = [(t.as_py() or "").encode() for t in batch.column(0)]
            good = np.array([bool(g.as_py()) for g in batch.column(1)])
            for raw, owner in steps(texts):
                real = owner >= 0
                gram, where = np.unique(grams(raw)[real], return_inverse=True)
                target = np.bincount(where, good[owner[real]], len(gram)).astype(np.int64)
                parts.append((gram, target, np.bincount(where, minlength=len(gram))))
                size += len(gram)
                if size >= _HELD:
                    parts = _merged(parts)
                    size = len(parts[0][0])
                    if size >= _HELD // 2:
                        yield from rows(parts)
                        parts, size = [], 0
        yield from rows(_merged(parts) if parts else [])

    counted = docs.mapInArrow(count, "gram int, target long, background long")
    return counted.groupBy("gram").agg(F.sum("target").alias("target"), F.sum("background").alias("background"))


@dataclass(frozen=True)
class Models:
    """Exact counts of the two models.

    `gram` has (gram, target, background), `context` (context, context_target, context_background),
    both as written tables; `two` has the counts of byte pairs, rows are target and background.
    """

    gram: DataFrame
    context: DataFrame
    two: np.ndarray
    weight: float

    def backed_off(self) -> np.ndarray:
        """Order-2 probabilities of byte pairs under either model, to which an order-4 count backs off."""
        out = np.empty((2, 1 << 16))
        for m in range(2):
            pairs = self.two[m].reshape(256, 256)
            one = pairs.sum(axis=0) + 1.0
            before = pairs.sum(axis=1)
            out[m] = ((pairs + self.weight * (one / one.sum())[None, :]) / (before[:, None] + self.weight)).ravel()
        return out

    def losses(self, keyed: DataFrame) -> DataFrame:
        """(block, gram, target, background): losses in nats of each n-gram of keyed (block, gram)."""
        context = F.shiftrightunsigned("gram", 8).alias("context")
        counted = keyed.select("block", "gram", context).join(self.context, "context", "left").join(self.gram, "gram", "left")
        counts = ["target", "background", "context_target", "context_background"]
        counted = counted.select("block", "gram", *[F.coalesce(c, F.lit(0)).alias(c) for c in counts])
        p2, weight = self.backed_off(), self.weight  # 2 * 65,536 numbers whatever the input

        def measure(batches):
            for batch in batches:
                two = np.asarray(batch.column(1)).view(np.uint32) & np.uint32(0xFFFF)
                n = [np.asarray(batch.column(k)) for k in range(2, 6)]
                loss = [-np.log((n[m] + weight * p2[m][two]) / (n[2 + m] + weight)) for m in range(2)]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *map(pa.array, loss)], ["block", "gram", "target", "background"])

        return counted.mapInArrow(measure, "block long, gram int, target double, background double")


def fit(docs: DataFrame, good: DataFrame, weight: float = 16.0) -> Models:
    """Count both models over all of docs; `good` has the doc_id of the target's documents.

    Every document counts for the background, each good one for the target too. Every n-gram that
    occurs has a row of its own in the counts; the driver sees those of byte pairs alone.
    """
    ids = good.select("doc_id").filter(F.col("doc_id").isNotNull()).distinct().withColumn("good", F.lit(True))
    # Labels grow with the documents, so they are never broadcast, however few they are.
    flagged = docs.select("doc_id", "text").join(ids.hint("merge"), "doc_id", "left").select("text", F.coalesce("good", F.lit(False)).alias("good"))
    gram = saved(_counts(flagged))
    sums = [F.sum("target").alias("target"), F.sum("background").alias("background")]
    context = gram.groupBy(F.shiftrightunsigned("gram", 8).alias("context")).agg(*sums)
    context = saved(context.toDF("context", "context_target", "context_background"))
    table = gram.groupBy(F.col("gram").bitwiseAND(0xFFFF).alias("two")).agg(*sums).toArrow()
    two = np.zeros((2, 1 << 16))
    at = np.asarray(table.column("two"))
    two[0, at], two[1, at] = np.asarray(table.column("target")), np.asarray(table.column("background"))
    return Models(gram, context, two, weight)


def _blocks(docs: DataFrame, block_bytes: int) -> DataFrame:
    """Written table of blocks: rows of packed documents (ids, sizes, texts), and rows of the block's n-grams.

    A block is named by the task that wrote it: the table is only read after.
    """
    fields = [
        T.StructField("block", T.LongType()),
        T.StructField("ids", T.ArrayType(docs.schema["doc_id"].dataType)),
        T.StructField("sizes", T.ArrayType(T.LongType())),
        T.StructField("texts", T.BinaryType()),
        T.StructField("keys", T.ArrayType(T.IntegerType())),
    ]
    names = [f.name for f in fields]

    def gather(batches):
        import zstandard
        from pyspark import TaskContext

        compress = zstandard.ZstdCompressor(level=3).compress
        block, size, found = TaskContext.get().partitionId() * _TASK, 0, []
        ids, texts, held = [], [], 0

        def pack():
            kinds = [pa.list_(kind), pa.list_(pa.int64()), pa.binary()]
            cells = [ids, [len(t) for t in texts], compress(b"".join(texts))]
            found.extend(np.unique(grams(raw)[owner >= 0]) for raw, owner in steps(texts))
            return pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), *[pa.array([c], k) for c, k in zip(cells, kinds)], pa.nulls(1, pa.list_(pa.int32()))], names)

        def close():
            keys = np.unique(np.concatenate(found)).view(np.int32) if found else np.zeros(0, np.int32)
            for i in range(0, len(keys), _PART):
                nulls = [pa.nulls(1, t) for t in (pa.list_(kind), pa.list_(pa.int64()), pa.binary())]
                yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), *nulls, pa.array([keys[i : i + _PART]], pa.list_(pa.int32()))], names)

        for batch in batches:
            kind = batch.column(0).type
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                raw = (t.as_py() or "").encode()
                ids.append(i)
                texts.append(raw)
                held += len(raw)
                size += len(raw)
                if held >= _STEP or len(ids) >= 10_000:
                    yield pack()
                    ids, texts, held = [], [], 0
                    if len(found) > 4:
                        found = [np.unique(np.concatenate(found))]
                if size >= block_bytes:
                    if ids:
                        yield pack()
                    yield from close()
                    block, size, found, ids, texts, held = block + 1, 0, [], [], [], 0
        if ids:
            yield pack()
        yield from close()

    return saved(docs.select("doc_id", "text").mapInArrow(gather, T.StructType(fields)))


def score(docs: DataFrame, models: Models, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per input row: doc_id, n_bytes, mean losses under both models and their difference `score`.

    Whole texts are scored. Each block's distinct n-grams are joined to the counts, and their losses
    come back to the block; a task holds those of one block. A null or empty text has no losses and
    no score. Repeated rows stay apart; columns other than doc_id and text play no part; an empty
    table gives an empty one.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    blocks = _blocks(docs, block_bytes)
    packed = blocks.filter(F.col("texts").isNotNull()).select("block", "ids", "sizes", "texts")
    keyed = blocks.filter(F.col("keys").isNotNull()).select("block", F.explode("keys").alias("gram"))

    def measure(left: pa.Table, right: pa.Table) -> pa.Table:
        import zstandard

        decompress = zstandard.ZstdDecompressor().decompress
        gram = np.asarray(right.column("gram")).view(np.uint32)
        order = np.argsort(gram)
        gram = gram[order]
        both = [np.asarray(right.column(c))[order] for c in ("target", "background")]
        sizes, losses = [np.zeros(0, np.int64)], [np.zeros((2, 0))]
        for size, packed in zip(left.column("sizes"), left.column("texts")):
            size, whole = np.array(size.as_py(), np.int64), decompress(packed.as_py())
            ends = np.cumsum(size)
            texts = [whole[e - n : e] for e, n in zip(ends.tolist(), size.tolist())]
            loss = np.zeros((2, len(texts)))
            for raw, owner in steps(texts):
                real = owner >= 0
                at = np.searchsorted(gram, grams(raw)[real])
                for m in range(2):
                    loss[m] += np.bincount(owner[real], both[m][at], len(texts))
            sizes.append(size)
            losses.append(loss)
        n, loss = np.concatenate(sizes), np.concatenate(losses, axis=1)
        empty = n == 0
        target, background = (x / np.maximum(n, 1) for x in loss)
        ids = pa.concat_arrays([c.flatten() for c in left.column("ids").chunks])
        columns = [pa.array(n)] + [pa.array(x, mask=empty) for x in (target, background, target - background)]
        return pa.table([ids, *columns], ["doc_id", "n_bytes", "target_loss", "background_loss", "score"])

    schema = f"doc_id {kind}, n_bytes long, target_loss double, background_loss double, score double"
    return packed.groupBy("block").cogroup(models.losses(keyed).groupBy("block")).applyInArrow(measure, schema)
