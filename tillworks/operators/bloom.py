"""Bloom filters as tables: rows that can't be in a set are dropped before they are shuffled."""

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillworks.session import saved

#: A filter has at most 2^26 bits, in 2^20 words, so it can be broadcast whatever the set's size.
MOST_BITS = 26
BITS_PER_KEY = 10


@dataclass(frozen=True)
class Bloom:
    """Words (word, bits) of a filter with 2^size bits, two of which are set for each key."""

    words: DataFrame
    size: int


def _places(key: Column, size: int) -> tuple[Column, Column]:
    """Two bits of a key, from the lower and the upper half of one hash."""
    h, mask = F.xxhash64(key), F.lit((1 << size) - 1)
    return h.bitwiseAND(mask), F.shiftrightunsigned(h, 32).bitwiseAND(mask)


def bloom_of(keys: DataFrame, key: Column, count: int) -> Bloom:
    """The filter of a set of about `count` keys, written to the shared folder."""
    size = min(max(math.ceil(math.log2(BITS_PER_KEY * max(count, 1))), 10), MOST_BITS)
    places = keys.select(F.explode(F.array(*_places(key, size))).alias("place"))
    bit = F.expr("shiftleft(1L, CAST(place & 63 AS INT))")
    words = places.groupBy(F.shiftright("place", 6).alias("word")).agg(F.bit_or(bit).alias("bits"))
    return Bloom(saved(words), size)


def split_by(rows: DataFrame, key: Column, bloom: Bloom) -> tuple[DataFrame, DataFrame]:
    """maybe_in, and the other rows: those whose key is surely not in the set. A null key is in one of the two."""
    marked, hits = rows, F.lit(True)
    for i, place in enumerate(_places(key, bloom.size)):
        words = F.broadcast(bloom.words.select(F.col("word").alias(f"_word{i}"), F.col("bits").alias(f"_bits{i}")))
        marked = marked.join(words, F.shiftright(place, 6) == F.col(f"_word{i}"), "left")
        bit = F.getbit(F.col(f"_bits{i}"), place.bitwiseAND(F.lit(63)).cast("int"))
        hits = hits & F.coalesce(bit == 1, F.lit(False))
    return maybe_in(rows, key, bloom), marked.filter(~hits).select(*rows.columns)


def maybe_in(rows: DataFrame, key: Column, bloom: Bloom) -> DataFrame:
    """The rows whose key may be in the set: all that are, and about one in thirty of the others.

    With more keys than the largest filter has room for the others pass more often; none is lost.
    """
    for place in _places(key, bloom.size):
        word, bit = F.shiftright(place, 6), place.bitwiseAND(F.lit(63)).cast("int")
        words = F.broadcast(bloom.words)
        rows = rows.join(words, (word == words["word"]) & (F.getbit(words["bits"], bit) == 1), "left_semi")
    return rows
