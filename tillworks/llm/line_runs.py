"""Removal of repeated runs of lines with a suffix array over line ids.

Every document is a sequence of line ids. Prefix doubling ranks all suffixes by their first 1, 2, 4,
... lines: a rank of twice the depth is the rank of the pair (rank here, rank so many lines on).
Suffixes of equal rank form an interval of the array whose longest common prefix is the depth at
least. A line that occurs once in the corpus ends every repeated run, so only repeated lines take
part.

A run counts if it has `min_words` words. Whether a longer run is repeated shows in its shortest
stretches of that many words, so doubling stops at the depth of the longest such stretch, and the
union of repeated stretches is the union of the maximal repeated runs. Stretches are taken forward from
each line and backward from each line, which leaves no end of a run out.
"""

import itertools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillworks.llm.columns import fresh, once
from tillworks.llm.memory import give_back
from tillworks.operators.ordering import sum_before
from tillworks.session import saved

MIN_WORDS = 10
_LINE = "array<struct<h1:long,h2:long,line:int,ahead:int,behind:int>>"


def stretches(words: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """For each line, how many lines from it on, and back from it, first have `least` words; 0 where none do."""
    total = np.concatenate([[0], np.cumsum(words)])
    n = np.arange(len(words))
    stop = np.searchsorted(total, total[:-1] + least)
    ahead = np.where(stop <= len(words), stop - n, 0)
    start = np.searchsorted(total, total[1:] - least, side="right") - 1
    behind = np.where(total[1:] >= least, n + 1 - start, 0)
    return ahead, behind


def line_ids(text: Column, least: int) -> Column:
    """The lines that have a word: a 128-bit id, the line's place, and its stretches. Null for a null text."""

    @F.arrow_udf(_LINE)
    def ids(texts: pa.Array) -> pa.Array:
        import xxhash

        per_text, known, digests, numbers = [0], [], [], []
        for t in texts:
            known.append(t.is_valid)
            if t.is_valid:
                lines = t.as_py().encode().split(b"\n")
                words = np.fromiter((len(x.split()) for x in lines), np.int64, len(lines))
                at = np.flatnonzero(words)
                digests.append(b"".join([xxhash.xxh3_128_digest(lines[i]) for i in at.tolist()]))
                numbers.append(np.stack([at, *stretches(words[at], least)]).astype(np.int32))
                per_text.append(per_text[-1] + len(at))
            else:
                per_text.append(per_text[-1])
        ids = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
        rest = np.concatenate([np.empty((3, 0), np.int32), *numbers], axis=1)
        fields = [*ids.T, *rest]
        items = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(x)) for x in fields], fields=list(_ARROW_LINE.value_type))
        lists = pa.ListArray.from_arrays(pa.array(per_text, pa.int32()), items, type=_ARROW_LINE)
        give_back()
        return lists if all(known) else pc.if_else(pa.array(known), lists, pa.scalar(None, _ARROW_LINE))

    return ids(text)


_ARROW_LINE = pa.list_(
    pa.struct([("h1", pa.int64()), ("h2", pa.int64()), ("line", pa.int32()), ("ahead", pa.int32()), ("behind", pa.int32())])
)


def _ranks(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Adds the rank of the keys among the keys that occur twice or more; rows whose keys occur once get none.

    Keys are counted with partial aggregation and ranked in their global order by ranges, so neither
    a very common key nor the whole table meets in one task.
    """
    twice = rows.filter(F.col(keys[-1]).isNotNull()).groupBy(*keys).agg(F.count("*").alias("_n")).filter("_n > 1")
    ranked = sum_before(twice, [F.col(k) for k in keys], F.col("_n"), name).drop("_n")
    return rows.join(ranked, keys, "left")


def repeated_lines(docs: DataFrame, uid: str, min_words: int = MIN_WORDS) -> DataFrame:
    """(uid, lines): the places of lines of each document that belong to a later copy of a run.

    `uid` numbers the rows of docs, which must be a written table. Copies are ordered by doc_id,
    null last, then uid, then place; the first one stays.
    """
    lines = docs.select(F.col(uid).alias("uid"), "doc_id", F.posexplode(line_ids(F.col("text"), min_words)).alias("at", "x"))
    lines = saved(lines.select("uid", "doc_id", "at", "x.*"))
    ranks = _ranks(lines, ["h1", "h2"], "r0").filter("r0 is not null").drop("h1", "h2")
    ranks = saved(ranks)
    depth, level = 1, 0
    by_doc = Window.partitionBy("uid").orderBy("at")
    while depth * 2 <= min_words:
        ahead = F.max(f"r{level}").over(by_doc.rangeBetween(depth, depth))
        ranks = saved(_ranks(ranks.withColumn("_next", ahead), [f"r{level}", "_next"], f"r{level + 1}").drop("_next"))
        depth, level = depth * 2, level + 1

    # A stretch of n lines is named by the ranks of its first and its last 2^k lines.
    place = ranks.select("uid", "at", F.array(*[F.col(f"r{k}") for k in range(level + 1)]).alias("r"))
    n, k = F.col("n"), F.floor(F.log2(F.col("n"))).cast("int")
    starts = ranks.filter("ahead > 0").select("uid", "doc_id", "at", F.col("ahead").alias("n"))
    ends = ranks.filter("behind > 0").select("uid", "doc_id", (F.col("at") - F.col("behind") + 1).alias("at"), F.col("behind").alias("n"))
    named = (
        starts.union(ends)
        .distinct()
        .withColumn("tail", (F.col("at") + n - F.pow(F.lit(2), k)).cast("int"))
        .join(place, ["uid", "at"])
        .withColumn("a", F.get("r", k))
        .drop("r")
        .join(place.withColumnRenamed("at", "tail"), ["uid", "tail"])
        .withColumn("b", F.get("r", k))
        .filter("a is not null and b is not null")
        .select("uid", "at", "n", "a", "b", F.struct(F.col("doc_id").isNull(), "doc_id", "uid", "at").alias("order"))
    )
    named = saved(named)
    first = named.groupBy("n", "a", "b").agg(F.min("order").alias("first"))
    later = named.join(first, ["n", "a", "b"]).filter(F.col("order") > F.col("first"))
    gone = later.select("uid", F.explode(F.sequence(F.col("at"), F.col("at") + n - 1)).alias("at")).distinct()
    return gone.join(ranks.select("uid", "at", "line"), ["uid", "at"]).groupBy("uid").agg(F.collect_list("line").alias("lines"))


def without_lines(text: Column, lines: Column) -> Column:
    """The text without the lines at the given places; unchanged where there are none."""

    @F.arrow_udf(T.StringType())
    def cut(texts: pa.Array, places: pa.Array) -> pa.Array:
        out = []
        for t, p in zip(texts, places):
            t = t.as_py()
            if t is not None and p.is_valid:
                gone = set(p.as_py())
                t = "\n".join(itertools.compress(parts := t.split("\n"), [i not in gone for i in range(len(parts))]))
            out.append(t)
        left = pa.array(out, pa.string())
        del out
        give_back()
        return left

    return once(cut)(text, lines)


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS, drop_emptied: bool = False) -> DataFrame:
    """The rows of docs with all their columns, without later copies of repeated runs of lines.

    Lines are equal if their text is; they are separated by line feeds. Lines without a word are
    neither compared nor removed. A null text stays null. Rows that are equal are copies of each
    other: all but the first lose their repeated lines. With drop_emptied, rows that have lost lines and
    have no word left go too.
    """
    uid, lines = fresh(docs, "uid"), fresh(docs, "lines")
    # Row numbers hold only if the rows are never dealt anew: the table is written first.
    numbered = saved(docs.withColumn(uid, F.monotonically_increasing_id()))
    gone = repeated_lines(numbered, uid, min_words).select(F.col("uid").alias(uid), F.col("lines").alias(lines))
    cut = numbered.join(gone, uid, "left").withColumn("text", without_lines(F.col("text"), F.col(lines)))
    if drop_emptied:
        cut = cut.filter(F.col(lines).isNull() | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    return cut.drop(uid, lines).select(*docs.columns)


def removed_counts(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Per input row: doc_id, n_lines with a word before, n_removed of them, and the text that is left."""
    uid = "uid"
    numbered = saved(docs.select("doc_id", "text").withColumn(uid, F.monotonically_increasing_id()))
    gone = repeated_lines(numbered, uid, min_words)
    joined = numbered.join(gone, uid, "left")
    with_word = F.size(F.filter(F.split(F.coalesce("text", F.lit("")), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    return joined.select(
        "doc_id",
        with_word.cast("long").alias("n_lines"),
        F.when(F.col("lines").isNull(), 0).otherwise(F.size("lines")).cast("long").alias("n_removed"),
        without_lines(F.col("text"), F.col("lines")).alias("text"),
    )
