"""Joins of many small keys by way of blocks.

A row for each document and key would be most of the corpus again. Documents are therefore gathered
into blocks of bounded text, and a block has a dictionary of its distinct keys. Only the
dictionaries are dealt by key, one row for each block and key, so that a key's value is worked out once; the
values come back to the block, where each document holds places in the dictionary and how often it
uses them.
"""

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillworks.session import saved

#: Characters of text after which a block is closed.
BLOCK_CHARS = 32_000_000
#: Keys of a dictionary in one row.
_PART = 20_000
_TASK = 1 << 20  # blocks that a task may write


def pack(places: np.ndarray, times: np.ndarray, compress) -> bytes:
    """Ascending places and how often each is used, as compressed byte planes."""
    both = np.concatenate([np.diff(places, prepend=0), times]).astype("<u4")
    return compress(both.view(np.uint8).reshape(-1, 4).T.tobytes())


def unpack(packed: bytes, decompress) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(decompress(packed), np.uint8).reshape(4, -1).T.copy().view("<u4").ravel().astype(np.int64)
    half = len(both) // 2
    return np.cumsum(both[:half]), both[half:]


def uses(docs: DataFrame, key_type: T.DataType, new_block: Callable, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Written table of every document's keys as places in its block's dictionary, and of the dictionaries.

    new_block() returns (take, keys): take(text) gives the places of a text's keys in the block's
    dictionary as an array with repeats, keys() the dictionary so far. Rows of documents have
    doc_id, n_bytes and packed; rows of dictionaries have keys, in parts of bounded length, and the
    place of the first one. A block is named by the task that wrote it: the table is only read after.
    """
    fields = [
        T.StructField("block", T.LongType()),
        T.StructField("doc_id", docs.schema["doc_id"].dataType),
        T.StructField("n_bytes", T.LongType()),
        T.StructField("packed", T.BinaryType()),
        T.StructField("first", T.IntegerType()),
        T.StructField("keys", T.ArrayType(key_type)),
    ]
    names = [f.name for f in fields]
    keys_type = pa.list_(pa.string() if isinstance(key_type, T.StringType) else pa.int64())

    def gather(batches):
        import zstandard
        from pyspark import TaskContext

        compress = zstandard.ZstdCompressor(level=3).compress
        block, chars, take, dictionary = TaskContext.get().partitionId() * _TASK, 0, None, None

        def close():
            keys = dictionary()
            for i in range(0, len(keys), _PART):
                nulls = [pa.nulls(1, t) for t in (id_type, pa.int64(), pa.binary())]
                ends = [pa.array([i], pa.int32()), pa.array([keys[i : i + _PART]], keys_type)]
                yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), *nulls, *ends], names)

        for batch in batches:
            id_type, row = batch.column(0).type, 0
            while row < batch.num_rows:
                if dictionary is None:
                    take, dictionary = new_block()
                size, packed, begin = [], [], row
                while row < batch.num_rows and chars < block_chars:
                    text = batch.column(1)[row].as_py() or ""
                    size.append(len(text.encode()))
                    packed.append(pack(*np.unique(take(text), return_counts=True), compress))
                    chars += len(text)
                    row += 1
                n = row - begin
                columns = [pa.array([block] * n, pa.int64()), batch.column(0).slice(begin, n), pa.array(size, pa.int64())]
                columns += [pa.array(packed, pa.binary()), pa.nulls(n, pa.int32()), pa.nulls(n, keys_type)]
                yield pa.RecordBatch.from_arrays(columns, names)
                if chars >= block_chars:
                    yield from close()
                    block, chars, dictionary = block + 1, 0, None
        if dictionary is not None:
            yield from close()

    return saved(docs.select("doc_id", "text").mapInArrow(gather, T.StructType(fields)))


def values(used: DataFrame, value_of: Callable) -> DataFrame:
    """(block, places, values) for parts of each block's dictionary.

    All rows of a key meet in one task, at most one for each block, and lie together there, so
    value_of()(key) is called once for each distinct key of the corpus.
    """
    parts = used.filter(F.col("keys").isNotNull())
    each = parts.select("block", "first", F.posexplode("keys").alias("i", "key"))
    dealt = each.select("key", "block", (F.col("first") + F.col("i")).alias("place")).repartition("key").sortWithinPartitions("key")

    def evaluate(batches):
        of, last, value = value_of(), None, 0
        for batch in batches:
            out = np.empty(batch.num_rows, np.int32)
            for i, key in enumerate(batch.column(0).to_pylist()):
                if key != last:
                    last, value = key, of(key)
                out[i] = value
            block, place = np.asarray(batch.column(1)), np.asarray(batch.column(2))
            order = np.lexsort((place, block))
            block, place, out = block[order], place[order], out[order]
            cuts = np.flatnonzero(np.diff(block)) + 1
            heads = block[np.concatenate([[0], cuts])] if len(block) else block
            lists = [pa.array(np.split(x, cuts) if len(x) else [], pa.list_(pa.int32())) for x in (place, out)]
            yield pa.RecordBatch.from_arrays([pa.array(heads, pa.int64()), *lists], ["block", "places", "values"])

    return dealt.mapInArrow(evaluate, "block long, places array<int>, values array<int>")


def totals(used: DataFrame, found: DataFrame) -> DataFrame:
    """Per document: doc_id, n_bytes and `total`, the sum over its keys of times used * value.

    A task holds a block's documents and values, whose number the block's size bounds. A document
    without keys has total 0.
    """
    docs = used.filter(F.col("packed").isNotNull()).select("block", "doc_id", "n_bytes", "packed")
    kind = docs.schema["doc_id"].dataType.simpleString()

    def add(left: pa.Table, right: pa.Table) -> pa.Table:
        import zstandard

        decompress = zstandard.ZstdDecompressor().decompress
        places, numbers = ([np.asarray(x.values) for x in right.column(c)] for c in ("places", "values"))
        table = np.zeros(sum(map(len, places)), np.int64)
        for p, v in zip(places, numbers):
            table[p] = v
        sums = []
        for packed in left.column("packed"):
            at, times = unpack(packed.as_py(), decompress)
            sums.append(int(table[at] @ times) if len(at) else 0)
        return pa.table({"doc_id": left.column("doc_id"), "n_bytes": left.column("n_bytes"), "total": pa.array(sums, pa.int64())})

    together = docs.groupBy("block").cogroup(found.groupBy("block"))
    return together.applyInArrow(add, f"doc_id {kind}, n_bytes long, total long")
