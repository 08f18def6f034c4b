"""Token files in Simple-8b: whole 64-bit words, each a selector and as many ids as its width lets in.

A file is a row of segments. A segment holds whole documents and is read without its neighbours:

    header    10 unsigned 64-bit integers: magic, size in bytes, part, number in the part, documents,
              ids, blocks, words, exceptions, ids in a block
    doc ids   one signed 64-bit integer for each document
    lengths   one unsigned 64-bit integer for each document: its ids, with the top bit set if the
              document's id is null
    blocks    one unsigned 64-bit integer for each block: where its words begin
    words     selector in the top 4 bits, ids from the lowest bit on
    exceptions ids of more than 60 bits, which an escape word refers to by place
    end       seven zero bytes and a line feed, so that the next segment is aligned too

Blocks hold a fixed number of ids, so any of them can be decoded alone and all of them at once.
"""

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillworks.llm.library_ids import library_encoder
from tillworks.operators.ordering import sum_before
from tillworks.session import saved

MAGIC = int.from_bytes(b"S8BTOKEN", "little")
#: Fixed values of the format: ids in a word and bits of each, by selector. Selector 0 is a run of
#: zeros, selector 1 an escape.
COUNTS = np.array([240, 1, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
WIDTHS = np.array([0, 60, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
ESCAPE = 1
BLOCK = 1024
#: A segment is closed once it holds so many ids.
SEGMENT_IDS = 1 << 20
_HEADER = 10
_NULL = np.uint64(1 << 63)
_WIDE = int(COUNTS.max())
_PLAIN = [s for s in range(16) if s != ESCAPE]  # from the narrowest to the widest
_LIMITS = np.array([1 << int(WIDTHS[s]) for s in _PLAIN], np.uint64)
#: Place in _PLAIN of the narrowest width that holds an id, for ids of 16 bits; _PLAIN's length means an escape.
_NEED = np.searchsorted(_LIMITS, np.arange(1 << 16, dtype=np.uint64), side="right").astype(np.uint8)


def _selectors(values: np.ndarray) -> np.ndarray:
    """The selector of a word that begins at each place, an escape included; ids beyond the end count as zeros.

    One byte an id stands for the width it needs. The widest need of the next 1, 2, 4, ... ids comes by
    doubling, and that of any number of them from two such runs that overlap.
    """
    need = _NEED[np.minimum(values, np.uint64(len(_NEED) - 1)).astype(np.intp)]
    large = np.flatnonzero(values >= len(_NEED))
    need[large] = np.searchsorted(_LIMITS, values[large], side="right")
    size = len(need)
    widest = [np.concatenate([need, np.zeros(_WIDE, np.uint8)])]
    while 2 ** len(widest) <= _WIDE:
        run, half = widest[-1], 2 ** (len(widest) - 1)
        widest.append(np.maximum(run[:-half], run[half:]))
    best = np.zeros(size, np.uint8)
    for at, s in enumerate(_PLAIN):
        count = int(COUNTS[s])
        run = widest[count.bit_length() - 1]
        rest = count - (1 << count.bit_length() - 1)
        fits = np.maximum(run[:size], run[rest : rest + size]) <= at
        np.maximum(best, fits.view(np.uint8) * np.uint8(len(_PLAIN) - at), out=best)
    return np.array([ESCAPE, *reversed(_PLAIN)], np.uint8)[best]


def pack_words(ids: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words, where each block's words begin, and the exceptions of an array of unsigned integers.

    Each word takes as many ids as fit, the choice being made for all places of all blocks at once.
    """
    n, ids = len(ids), ids.astype(np.uint64)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    blocks, row = -(-n // block), block + _WIDE
    padded = np.zeros((blocks, row), np.uint64)
    flat = np.zeros(blocks * block, np.uint64)
    flat[:n] = ids
    padded[:, :block] = flat.reshape(blocks, block)
    values = padded.ravel()
    chosen = _selectors(values).reshape(blocks, row)

    inside = np.minimum(block, n - np.arange(blocks) * block)
    lanes, steps, at = np.arange(blocks), [], np.zeros(blocks, np.int64)
    while (at < inside).any():
        steps.append(np.where(at < inside, at, -1))
        at = at + COUNTS[chosen[lanes, at]] * (at < inside)
    starts = np.stack(steps, axis=1)
    used = starts >= 0
    begin = np.concatenate([[0], np.cumsum(used.sum(axis=1))[:-1]]).astype(np.uint64)
    where = (lanes[:, None] * row + starts)[used]
    selectors = chosen.ravel()[where]
    words = selectors.astype(np.uint64) << np.uint64(60)
    for s in np.unique(selectors):
        mine = np.flatnonzero(selectors == s)
        if s == ESCAPE:
            words[mine] |= np.arange(len(mine), dtype=np.uint64)
        elif WIDTHS[s]:
            first, word = where[mine], words[mine]
            for j in range(COUNTS[s]):
                word |= values[first + j] << np.uint64(j * WIDTHS[s])
            words[mine] = word
    return words, begin, values[where[selectors == ESCAPE]]


def unpack_words(words: np.ndarray, begin: np.ndarray, exceptions: np.ndarray, n: int, block: int = BLOCK) -> np.ndarray:
    """The n ids of all blocks, decoded selector by selector."""
    if not n:
        return np.zeros(0, np.uint64)
    blocks, row = len(begin), block + _WIDE
    selectors = (words >> np.uint64(60)).astype(np.int64)
    counts = COUNTS[selectors]
    ends = np.cumsum(counts)
    of = np.repeat(np.arange(blocks), np.diff(np.append(begin, len(words)).astype(np.int64)))
    first = (ends - counts)[begin.astype(np.int64)]
    where = of * row + (ends - counts) - first[of]
    out = np.zeros(blocks * row, np.uint64)
    for s in np.unique(selectors):
        mine = np.flatnonzero(selectors == s)
        if s == ESCAPE:
            out[where[mine]] = exceptions[(words[mine] & np.uint64((1 << 60) - 1)).astype(np.int64)]
        elif WIDTHS[s]:
            j = np.arange(COUNTS[s])
            part = words[mine][:, None] >> (j * WIDTHS[s]).astype(np.uint64)
            out[where[mine][:, None] + j] = part & np.uint64((1 << int(WIDTHS[s])) - 1)
    return out.reshape(blocks, row)[:, :block].ravel()[:n]


def segment(part: int, number: int, doc_ids: list, documents: list[bytes]) -> bytes:
    """A segment of documents given as little-endian unsigned 32-bit ids. Ends before the line feed."""
    ids = np.frombuffer(b"".join(documents), "<u4")
    words, begin, exceptions = pack_words(ids)
    lengths = np.array([len(d) // 4 for d in documents], np.uint64)
    lengths |= np.array([_NULL if i is None else 0 for i in doc_ids], np.uint64)
    known = np.array([0 if i is None else i for i in doc_ids], np.int64).view(np.uint64)
    body = [known, lengths, begin, words, exceptions]
    size = 8 * (_HEADER + sum(map(len, body)) + 1)
    head = [MAGIC, size, part, number, len(doc_ids), len(ids), len(begin), len(words), len(exceptions), BLOCK]
    return np.concatenate([np.array(head, np.uint64), *body]).astype("<u8").tobytes() + bytes(7)


def read_segments(content: bytes):
    """(part, number, doc ids, lengths, ids) of each segment of a file."""
    at = 0
    while at < len(content):
        head = np.frombuffer(content, "<u8", _HEADER, at).astype(np.int64).tolist()
        magic, size, part, number, docs, n, blocks, words, exceptions, block = head
        if magic != MAGIC or size > len(content) - at or content[at + size - 1 : at + size] != b"\n":
            raise ValueError(f"no segment at byte {at}")
        body = np.frombuffer(content, "<u8", (size - 8) // 8 - _HEADER, at + 8 * _HEADER)
        known, lengths, begin, packed, odd = np.split(body, np.cumsum([docs, docs, blocks, words]))
        null = lengths >= _NULL
        doc_ids = [None if x else i for i, x in zip(known.view(np.int64).tolist(), null.tolist())]
        yield part, number, doc_ids, (lengths & ~_NULL).astype(np.int64), unpack_words(packed, begin, odd, n, block)
        at += size


def write_files(docs: DataFrame, folder: str, path: str, end_id: int) -> None:
    """Write the ids of all documents, each followed by end_id, in ascending order of doc_id.

    doc_id is an integer; null comes first. Rows with equal ids keep the order of the input's scan,
    which also splits a hot id among tasks. A null or empty text has the end id alone. The files are
    committed by Spark's own text writer, so a lost executor leaves no half-written file behind, and
    any file system that Spark can write will do.
    """
    if not isinstance(docs.schema["doc_id"].dataType, (T.LongType, T.IntegerType, T.ShortType, T.ByteType)):
        raise TypeError("doc_id must be an integer")

    def encode(batches):
        from pyspark import TaskContext

        part, number = TaskContext.get().partitionId(), 0
        encoder, end = library_encoder(path), int(end_id).to_bytes(4, "little")
        ids, texts, held = [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                raw = encoder.encode(text.as_py() or "") + end
                ids.append(doc_id.as_py())
                texts.append(raw)
                held += len(raw) // 4
                if held >= SEGMENT_IDS:
                    yield _one(segment(part, number, ids, texts))
                    ids, texts, held, number = [], [], 0, number + 1
        if ids:
            yield _one(segment(part, number, ids, texts))

    order = [F.col("doc_id"), F.col("_at")]
    placed = docs.select("doc_id", "text").withColumn("_at", F.monotonically_increasing_id())
    dealt = placed.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    segments = dealt.mapInArrow(encode, "segment binary")
    # The writer's string is a row of bytes; its line feed ends the segment.
    segments.select(F.col("segment").cast("string")).write.mode("overwrite").option("compression", "none").text(folder)


def _one(value: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([value], pa.binary())], ["segment"])


def read_files(docs_like: DataFrame, folder: str, keep_ids: bool = False) -> DataFrame:
    """Per document of the files: doc_id, part, number, n_tokens, ids_crc32, ids before it in its segment.

    The crc is that of its ids as little-endian unsigned 32-bit integers. doc_id has the type that it
    has in docs_like. With keep_ids the ids follow.
    """
    spark = docs_like.sparkSession
    kind = docs_like.schema["doc_id"].dataType.simpleString()

    def decode(batches):
        for batch in batches:
            for content in batch.column(0):
                for part, number, doc_ids, lengths, ids in read_segments(content.as_buffer()):
                    raw, ends = ids.astype("<u4"), np.cumsum(lengths)
                    parts = np.split(raw, ends[:-1])
                    n = len(doc_ids)
                    columns = [
                        pa.array(doc_ids, pa.int64()),
                        pa.array([part] * n, pa.int32()),
                        pa.array([number] * n, pa.int32()),
                        pa.array(lengths, pa.int64()),
                        pa.array([zlib.crc32(p.tobytes()) for p in parts], pa.int64()),
                        pa.array(ends - lengths, pa.int64()),
                    ]
                    columns += [pa.array(parts, pa.list_(pa.uint32())).cast(pa.list_(pa.int64()))] * keep_ids
                    yield pa.RecordBatch.from_arrays(columns, names)

    names = ["doc_id", "part", "number", "n_tokens", "ids_crc32", "before"] + ["ids"] * keep_ids
    schema = "doc_id long, part int, number int, n_tokens long, ids_crc32 long, before long" + ", ids array<long>" * keep_ids
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).select("content")
    return files.mapInArrow(decode, schema).withColumn("doc_id", F.col("doc_id").cast(kind))


def index(docs_like: DataFrame, folder: str) -> DataFrame:
    """Per document of the files: doc_id, start (the ids of all documents before it), n_tokens, ids_crc32."""
    rows = saved(read_files(docs_like, folder))
    totals = rows.groupBy("part", "number").agg(F.sum("n_tokens").alias("n"))
    base = sum_before(totals, [F.col("part"), F.col("number")], F.col("n"), "base").drop("n")
    return rows.join(base, ["part", "number"]).select("doc_id", (F.col("base") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")
