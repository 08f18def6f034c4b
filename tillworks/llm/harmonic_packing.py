"""Harmonic packing of token sequences.

A piece of length l belongs to class k = capacity // l: its length lies in (capacity / (k + 1),
capacity / k], so k pieces of a class always fit a bin, and a bin of class k is closed once it
holds k. No bin needs to know another: each worker fills the bins of its own pieces, and only the
last bin of a class at a worker may hold fewer. Pieces shorter than `least` share a class with all
lengths up to the next power of two, so that few classes stay open.

Documents may be cut, so they are cut where classes fill exactly: whole bins first, then halves,
quarters and so on of the capacity, down to `least`, then what is left. A last bin of such a
class is split into runs of 1, 2, 4, ... pieces, whose total is a power of two and needs no padding.
"""

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillworks.llm.library_ids import MEMO_ENTRIES, library_encoder
from tillworks.llm.memory import give_back
from tillworks.session import saved

CAPACITY = 2048
LEAST = 16


def cut_lengths(n: int, capacity: int = CAPACITY, least: int = LEAST) -> list[int]:
    """Lengths of the pieces of a document of n tokens: capacity / 2^j, largest first, then the rest."""
    out, size = [], capacity
    while size >= least and n:
        out += [size] * (n // size)
        n %= size
        size //= 2
    return out + [n] * (n > 0)


def cut_pieces(
    docs: DataFrame, path: str, end_id: int, capacity: int = CAPACITY, least: int = LEAST, keep_ids: bool = False,
    memo_entries: int = MEMO_ENTRIES, keep_encoder: bool = True,
) -> DataFrame:
    """Pieces of every document: doc_id, start, length, ids_crc32, doc_tokens and the worker that cut them.

    Ids are those of the tokenizer file at `path`, then `end_id`; a null or empty text has the end id
    alone. Each input row is a document of its own, also where ids repeat. With keep_ids the ids
    themselves follow. The crc is that of the ids as little-endian unsigned 32-bit integers.
    """
    id_type = docs.schema["doc_id"].dataType
    fields = [T.StructField("doc_id", id_type)]
    fields += [T.StructField(n, T.LongType()) for n in ("start", "length", "ids_crc32", "doc_tokens")]
    fields += [T.StructField("ids", T.ArrayType(T.IntegerType()))] * keep_ids

    def cut(batches):
        encoder, end = library_encoder(path, memo_entries), int(end_id).to_bytes(4, "little")
        if not keep_encoder:
            encoder.without_cache()
        for batch in batches:
            row, start, length, crc, total, ids = [], [], [], [], [], []
            for i, text in enumerate(batch.column(1)):
                raw, at = encoder.encode(text.as_py() or "") + end, 0
                for n in cut_lengths(len(raw) // 4, capacity, least):
                    part = raw[4 * at : 4 * (at + n)]
                    row.append(i)
                    start.append(at)
                    length.append(n)
                    crc.append(zlib.crc32(part))
                    total.append(len(raw) // 4)
                    if keep_ids:
                        ids.append(np.frombuffer(part, "<i4"))
                    at += n
            columns = [batch.column(0).take(pa.array(row, pa.int64()))]
            columns += [pa.array(x, pa.int64()) for x in (start, length, crc, total)]
            columns += [pa.array(ids, pa.list_(pa.int32()))] * keep_ids
            yield pa.RecordBatch.from_arrays(columns, [f.name for f in fields])
        if not keep_encoder:
            del encoder
            library_encoder.cache_clear()
            give_back(generation=2)  # the encoder and its memos refer to each other

    return docs.select("doc_id", "text").mapInArrow(cut, T.StructType(fields)).withColumn("worker", F.spark_partition_id())


def pack(pieces: DataFrame, order: list[Column], capacity: int = CAPACITY, least: int = LEAST) -> DataFrame:
    """Adds sequence_id and offset to pieces with the columns `length` and `worker`.

    Lengths lie between 1 and the capacity. `order` ranks the pieces of a worker; pieces that are
    equal under it must be interchangeable. A task holds the pieces of a worker and class at most,
    so their number is bounded by what that worker has cut. sequence_id is unique over all workers.
    """
    at = Window.partitionBy("worker", "_class")
    length = F.col("length")
    shared = F.lit(capacity) / F.pow(F.lit(2), F.ceil(F.log2(length)))
    k = F.when(length >= least, F.lit(capacity) / length).otherwise(shared)
    ranked = (
        pieces.withColumn("_class", F.floor(k).cast("int"))
        .withColumn("_rank", (F.row_number().over(at.orderBy(*order)) - 1).cast("long"))
        .withColumn("_left", F.count("*").over(at) % F.col("_class"))
        .withColumn("_even", F.min("length").over(at) * F.col("_class") == capacity)
    )
    place = F.col("_rank") % F.col("_class")
    last = F.col("_rank") - place + F.col("_class") > F.count("*").over(at)
    # The highest bit in which the place and the number of pieces left differ names the run.
    run = F.when(last & F.col("_even"), F.floor(F.log2(place.bitwiseXOR(F.col("_left")).cast("double"))) + 1).otherwise(0)
    binned = ranked.withColumn("_bin", F.floor(F.col("_rank") / F.col("_class")) * 64 + run)
    before = Window.partitionBy("worker", "_class", "_bin").orderBy("_rank").rowsBetween(Window.unboundedPreceding, -1)
    head = F.col("worker").cast("long") * capacity + F.col("_class") - 1
    return (
        binned.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)).cast("long"))
        .withColumn("sequence_id", head * F.lit(2**26) + F.col("_bin"))
        .drop("worker", "_class", "_rank", "_left", "_even", "_bin")
    )


def pack_documents(
    docs: DataFrame, path: str, end_id: int, capacity: int = CAPACITY, least: int = LEAST, keep_ids: bool = False,
    memo_entries: int = MEMO_ENTRIES, keep_encoder: bool = True,
) -> DataFrame:
    """Every document's pieces with their sequence and place in it.

    The pieces are written once: a worker is the task that wrote them, so a recomputed task can't
    deal them anew. An empty table has no pieces. memo_entries trades a worker's memory for time;
    without keep_encoder a worker forgets tokenizer and memo at the end of a task.
    """
    pieces = saved(cut_pieces(docs, path, end_id, capacity, least, keep_ids, memo_entries, keep_encoder))
    order = [F.col(c) for c in ("doc_id", "start", "length", "doc_tokens", "ids_crc32")]
    return pack(pieces, order, capacity, least)


def sequences(packed: DataFrame, capacity: int = CAPACITY, pad_id: int = 0) -> DataFrame:
    """The sequences themselves from pieces with ids: sequence_id, n_tokens and padded ids.

    A sequence whose length is a power of two stays as it is; the others are padded to the capacity.
    """
    parts = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("p"))
    ids = F.flatten(F.col("p.ids"))
    n = F.size("ids")
    room = F.when(F.bit_count(n) == 1, 0).otherwise(F.lit(capacity) - n)
    filled = F.concat("ids", F.array_repeat(F.lit(pad_id), room.cast("int")))
    return parts.select("sequence_id", ids.alias("ids")).select("sequence_id", n.cast("long").alias("n_tokens"), filled.alias("ids"))


def padding(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """One row: sequences, tokens and tokens with padding."""
    used = packed.groupBy("sequence_id").agg(F.sum("length").alias("n"))
    room = F.when(F.bit_count("n") == 1, F.col("n")).otherwise(F.lit(capacity))
    total = lambda c, name: F.coalesce(F.sum(c), F.lit(0)).alias(name)
    return used.agg(F.count("*").alias("sequences"), total(F.col("n"), "tokens"), total(room, "padded"))
