"""Runs of repeated words, found online by catchers over dyadic blocks.

A run is a stretch of words with smallest period p that is at least two periods long and that no
neighbouring word extends. Words are read one at a time. Every completed block of 2, 4, 8, ... words
is a catcher: it waits for its own words to come again at a distance that suits its size. Its last
two words are its key, so an appended word wakes only the catchers whose key it completes; these
compare the block with the latest words. A match is a stretch that repeats at that distance. It
is followed word by word; once it is as long as its distance, its words end a square, and squares of one
period at successive words are one run.

Why no run is missed: in a run of period p and at least `min_length` words, at least
max(p, min_length - p) successive words come again p words later. Among these lies a whole block of L
words, where L is 2 for p under 7 and else the largest power of two with 2 * L - 1 <= p. Why
none is found with a multiple of its period: the block of the smaller period comes again first, and
a match inside an open stretch whose period divides the distance is that stretch itself.
"""

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillworks.llm.columns import fresh

_RUN = T.StructType([T.StructField(n, T.LongType(), False) for n in ("start", "length", "period")])
FOUND = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("runs", T.ArrayType(_RUN, False)),
        T.StructField("collapsed", T.StringType()),
    ]
)


class RunCatcher:
    """The runs of a sequence of hashable words that grows at its end.

    `append` takes O(log n) catcher checks a word at most. `min_length` is the least number of words of a run,
    5 or more.
    """

    def __init__(self, min_length: int = 12):
        if min_length < 5:
            raise ValueError("min_length must be 5 or more")
        self.min_length = min_length
        self._ids: dict = {}
        self._words: list[int] = []
        self._waiting: dict[int, list[tuple[int, int]]] = {}  # last two words -> (block's last place, size)
        self._open: list[tuple[int, int]] = []  # (period, start) of stretches that reach the last word
        self._closed: list[tuple[int, int, int]] = []

    def append(self, word) -> list[tuple[int, int]]:
        """Add a word; the (start, period) of all squares that end with it and lie in one stretch."""
        self.extend((word,))
        n = len(self._words)
        return [(n - 2 * p, p) for p, start in self._open if n - start >= 2 * p]

    def extend(self, words: Iterable) -> None:
        ids, seen, waiting = self._ids, self._words, self._waiting
        i = len(seen)
        before = seen[-1] if seen else -1
        for word in words:
            w = ids.setdefault(word, len(ids))
            seen.append(w)
            if self._open:
                self._advance(i, w)
            key = before << 32 | w
            if key in waiting:
                self._wake(key, i)
            if i & 1:
                # Blocks of 2, 4, 8, ... words that end here, as far as the number of words is divisible.
                blocks = waiting.setdefault(key, [])
                size, count = 2, i + 1
                while not count & (size - 1):
                    blocks.append((i, size))
                    size *= 2
            before = w
            i += 1

    def _advance(self, i: int, w: int) -> None:
        """Compare the new word with the one a period before, for every open stretch."""
        seen = self._words
        for period, start in self._open:
            if seen[i - period] != w:
                break
        else:
            return
        still = []
        for period, start in self._open:
            if seen[i - period] == w:
                still.append((period, start))
            elif self._long_enough(i - start, period):
                self._closed.append((start, i - start, period))
        self._open = still

    def _long_enough(self, length: int, period: int) -> bool:
        return length >= 2 * period and length >= self.min_length

    def _wake(self, key: int, i: int) -> None:
        """Compare the blocks that end in these two words with the latest words, nearest blocks first."""
        seen = self._words
        live = []
        for block in reversed(self._waiting[key]):
            end, size = block
            distance = i - end
            if distance > 4 * size - 2:
                continue  # its distances are past
            live.append(block)
            if distance < (2 * size - 1 if size > 2 else 1):
                continue
            first = end + 1 - size
            if any(distance % p == 0 and start <= first for p, start in self._open):
                continue
            if seen[first] != seen[first + distance] or seen[first : end + 1] != seen[first + distance : i + 1]:
                continue
            while first and seen[first - 1] == seen[first - 1 + distance]:
                first -= 1
            self._open.append((distance, first))
        live.reverse()
        self._waiting[key] = live

    def runs(self) -> list[tuple[int, int, int]]:
        """(start, length, period) of all runs so far, by start, then period."""
        n = len(self._words)
        open_now = [(start, n - start, p) for p, start in self._open if self._long_enough(n - start, p)]
        return sorted([*self._closed, *open_now], key=lambda r: (r[0], r[2]))


def runs_of(words: Iterable, min_length: int = 12) -> list[tuple[int, int, int]]:
    catcher = RunCatcher(min_length)
    catcher.extend(words)
    return catcher.runs()


def collapsed(words: list, runs: list[tuple[int, int, int]]) -> list:
    """The words without those that a run holds after its first period."""
    kept, at, end = [], 0, 0
    for first, last in sorted((start + period, start + length) for start, length, period in runs):
        if first > end:
            kept += words[at:first]
        at = end = max(end, last)
    return kept + words[at:] if runs else words


def find_runs(docs: DataFrame, min_length: int = 12) -> DataFrame:
    """All rows and columns of docs, with n_words, runs and collapsed.

    Words are what lies between ASCII white space. runs is an array of (start, length, period) in words
    from 0, by start, then period; collapsed has the words left when every run keeps only its
    first period, joined by one space. A null, empty or blank text has no words, no runs and an empty
    collapsed text. Repeated rows and ids are each worked out by themselves, an empty table stays
    empty. Result columns replace input columns of the same name. A text is one task's work and takes
    memory in proportion to its words, whatever its runs; there is no limit on length or period.
    """

    @F.arrow_udf(FOUND)
    def find(texts: pa.Array) -> pa.Array:
        n_words, per_text, found, left = [], [0], [], []
        for text in texts:
            words = (text.as_py() or "").encode().split()
            runs = runs_of(words, min_length)
            n_words.append(len(words))
            found += runs
            per_text.append(len(found))
            left.append(b" ".join(collapsed(words, runs)))
        flat = np.array(found, np.int64).reshape(-1, 3)
        items = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], fields=list(_ARROW_RUN))
        runs = pa.ListArray.from_arrays(pa.array(per_text, pa.int32()), items, type=pa.list_(pa.field("element", _ARROW_RUN, False)))
        return pa.StructArray.from_arrays([pa.array(n_words, pa.int64()), runs, pa.array(left, pa.binary()).cast(pa.string())], ["n_words", "runs", "collapsed"])

    name = fresh(docs, "found")
    taken = {c.lower() for c in FOUND.names}
    kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in taken]
    return docs.select(*kept, find(F.col("text")).alias(name)).select(
        *kept, *[F.col(name)[c].alias(c) for c in FOUND.names]
    )


_ARROW_RUN = pa.struct([pa.field(n, pa.int64(), False) for n in ("start", "length", "period")])


def longest(runs: str = "runs") -> Column:
    """The longest run of an array; of equally long ones the first to start, then the shortest period."""
    # The array is in that order already, so the first of the greatest length is the one.
    none = F.lit(None).cast(_RUN)
    return F.aggregate(runs, none, lambda best, r: F.when(best.isNull() | (r["length"] > best["length"]), r).otherwise(best))
