"""Near duplicates by min-max hashing.

Under each random permutation of the shingles a document keeps the smallest and the largest value.
Two documents agree in either with a probability equal to their Jaccard similarity, so one hash
evaluation gives two signature values. Bands of several values are the keys of candidate buckets.

Copies of one set of shingles are one node from the start. Within a bucket nobody is paired with
everybody: the members are compared with the bucket's hub, the member that shares most buckets with
others. Only members that this leaves outside the hub's component are compared with the rest of the
hub's group, in blocks of bounded size. Every candidate pair is thus compared on full sets or
already lies in one component, and the number of rows stays near linear.
"""

import functools
import hashlib
import random

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillworks.llm.columns import fresh, once
from tillworks.llm.components import components
from tillworks.llm.memory import give_back
from tillworks.session import saved

#: 144 hash evaluations give 288 values; a pair at similarity 0.8 should miss all buckets once in
#: 2 million, (1 - 0.8^6)^48, if its values were independent.
BANDS, ROWS = 48, 6
#: Members of a block; a task compares one block with another.
BLOCK = 256
_MASK = (1 << 64) - 1


@functools.lru_cache(maxsize=4)
def _permutations(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = random.Random(20240229)
    a = np.array([rng.getrandbits(64) | 1 for _ in range(n)], np.uint64)
    b = np.array([rng.getrandbits(64) for _ in range(n)], np.uint64)
    return a[:, None], b[:, None]


class _WordHash(dict):
    """64-bit hashes of words, forgotten all at once when there are too many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 200_000:
            self.clear()
        h = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        if len(word) <= 64:
            self[word] = h
        return h


def shingle_words(text: str) -> list[bytes]:
    """Words without ASCII white space, with A-Z in lower case."""
    return text.encode().lower().split()


def shingle_hashes(words: list[bytes], size: int, hashes: dict) -> np.ndarray:
    """The distinct shingles of `size` words as sorted 64-bit hashes; fewer words are one shingle."""
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    size = min(size, len(words))
    out = np.full(len(words) - size + 1, 0x9E3779B97F4A7C15 + size & _MASK, np.uint64)
    for i in range(size):
        out = (out ^ h[i : i + len(out)]) * np.uint64(0xFF51AFD7ED558CCD)
        out ^= out >> np.uint64(32)
    return np.unique(out)


def signature(shingles: np.ndarray, n: int) -> np.ndarray:
    """Smallest and largest value under each of n permutations: 2 n values."""
    a, b = _permutations(n)
    low = np.full(n, _MASK, np.uint64)
    high = np.zeros(n, np.uint64)
    for i in range(0, len(shingles), 2048):
        v = a * shingles[None, i : i + 2048] + b
        np.minimum(low, v.min(axis=1), out=low)
        np.maximum(high, v.max(axis=1), out=high)
    return np.concatenate([low, high])


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A key for each band; values of one permutation fall into different bands."""
    # The largest values stand a whole number of rows behind the smallest: each of their rows is rolled.
    parts = [np.roll(p, r if r >= rows / 2 else 0) for r, p in enumerate(sig[: bands * rows].reshape(rows, bands))]
    key = np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for r in range(rows):
        key = (key ^ parts[r]) * np.uint64(0xC4CEB9FE1A85EC53)
        key ^= key >> np.uint64(29)
    return key.view(np.int64)


def set_digest(text: Column, size: int) -> Column:
    """The digest of a text's set of shingles; null where it has no words."""

    @F.arrow_udf("binary")
    def digest(texts: pa.Array) -> pa.Array:
        hashes = _WordHash()
        found = pa.array([_digest(shingle_hashes(shingle_words(t.as_py() or ""), size, hashes)) for t in texts], pa.binary())
        del hashes
        give_back()
        return found

    return once(digest)(text)


def _digest(shingles: np.ndarray) -> bytes | None:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest() if len(shingles) else None


def signatures(docs: DataFrame, size: int, bands: int, rows: int, id_column: str = "doc_id") -> DataFrame:
    """doc_id, n_shingles, node (a digest of the set; null for an empty one) and its band keys."""
    kind = docs.schema[id_column].dataType.simpleString()

    def sign(batches):
        hashes = _WordHash()
        for batch in batches:
            n, node, keys = [], [], []
            for text in batch.column(1):
                s = shingle_hashes(shingle_words(text.as_py() or ""), size, hashes)
                n.append(len(s))
                node.append(_digest(s))
                keys.append(band_keys(signature(s, -(-bands * rows // 2)), bands, rows) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(node, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                [id_column, "n_shingles", "node", "bands"],
            )
            give_back()

    return docs.select(id_column, "text").mapInArrow(sign, f"`{id_column}` {kind}, n_shingles long, node binary, bands array<long>")


def _runs(batches, key_columns):
    """Record batches sorted by key, as one table for each run of equal keys."""
    held, key = [], None
    for batch in batches:
        keys = list(zip(*[batch.column(i).to_pylist() for i in key_columns]))
        start = 0
        for i in range(1, len(keys) + 1):
            if i < len(keys) and keys[i] == keys[start]:
                continue
            if held and keys[start] != key:
                yield pa.Table.from_batches(held)
                held = []
            key = keys[start]
            held.append(batch.slice(start, i - start))
            start = i
    if held:
        yield pa.Table.from_batches(held)


def _find(parent: dict, x):
    while parent.setdefault(x, x) != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def _shingle_set(text: str, size: int) -> set:
    w = shingle_words(text)
    size = min(size, len(w))
    return set(zip(*[w[i:] for i in range(size)])) if w else set()


def _links_of(run: pa.Table, size: int, percent: int):
    """Links between left and right rows of one task's run that join different components."""
    sides, nodes, comps, texts = (run.column(c).to_pylist() for c in ("side", "node", "comp", "text"))
    ids: dict = {}
    sets, parent = [], {}
    for text in texts:
        sets.append(np.fromiter((ids.setdefault(s, len(ids)) for s in _shingle_set(text, size)), np.int64))
    right = [i for i, side in enumerate(sides) if side]
    left = [i for i, side in enumerate(sides) if not side]
    if not left or not right:
        return
    lengths = np.array([len(sets[i]) for i in right])
    flat, owner = np.concatenate([sets[i] for i in right]), np.repeat(np.arange(len(right)), lengths)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    starts = np.searchsorted(flat, np.arange(len(ids) + 1))
    for i in left:
        begin, n = starts[sets[i]], starts[sets[i] + 1] - starts[sets[i]]
        at = np.repeat(begin - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        both = np.bincount(owner[at], minlength=len(right))
        for j in np.flatnonzero(100 * both >= percent * (len(sets[i]) + lengths - both)):
            r = right[j]
            x, y = _find(parent, comps[i]), _find(parent, comps[r])
            if x != y:
                parent[x] = y
                yield nodes[i], nodes[r]


def _links(tasks: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Compare the left rows (side 0) with the right rows (side 1) of each task (group, i, j) on full sets."""
    rows = tasks.join(texts, "node").select("group", "i", "j", "side", "node", "comp", "text")
    dealt = rows.repartition("group", "i", "j").sortWithinPartitions("group", "i", "j")

    def compare(batches):
        for run in _runs(batches, (0, 1, 2)):
            found = list(_links_of(run, size, percent))
            if found:
                a, b = zip(*found)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])
        give_back()

    return dealt.mapInArrow(compare, "a binary, b binary")


def _blocks(n, block: int):
    return F.ceil(n / block).cast("int")


def link(docs: DataFrame, size: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS, block: int = BLOCK) -> DataFrame:
    """Per input row: doc_id, n_shingles, digest, node and component_id, the smallest doc_id of its component.

    Two documents are linked where 100 * |intersection| >= percent * |union| of their shingle sets,
    confirmed on the full sets. `node` names the row's component: null for a text without words,
    which is linked with nothing and is its own component. Rows with equal sets are linked whatever
    their ids; a null doc_id counts only where a component has no other. Columns other than doc_id
    and text play no part.
    """
    signed = saved(signatures(docs, size, bands, rows))
    has = F.col("node").isNotNull()
    nodes = saved(
        signed.filter(has).groupBy("node").agg(F.min("doc_id").alias("least"), F.count("*").alias("copies"), F.any_value("bands").alias("bands"))
    )
    keyed = nodes.select("node", F.explode("bands").alias("key"))
    shared = keyed.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    members = saved(keyed.join(shared, "key"))
    score = members.groupBy("node").agg(F.sum("n").alias("score"))
    scored = members.select("key", "node").join(score, "node")
    hubs = scored.groupBy("key").agg(F.max(F.struct("score", "node")).alias("h")).select("key", F.col("h.node").alias("hub"))
    pairs = saved(members.select("key", "node").join(hubs, "key").filter("node <> hub").select("hub", "node").distinct())

    # One text for each node that is compared. Rows of one node have equal sets, so any of them will do.
    wanted = saved(pairs.select(F.explode(F.array("hub", "node")).alias("node")).distinct())
    one = signed.filter(has).join(wanted, "node").groupBy("node").agg(F.min("doc_id").alias("_id"))
    # A doc_id may belong to several rows: the row's own node decides.
    texts = saved(_texts_of(docs, one, size))

    size_of = pairs.groupBy("hub").agg(F.count("*").alias("n"))
    first = pairs.join(size_of, "hub").withColumn("j", F.pmod(F.xxhash64("node"), _blocks(F.col("n"), block)).cast("int"))
    zero = F.lit(0)
    tasks = first.select(F.col("hub").alias("group"), zero.alias("i"), "j", F.lit(1).alias("side"), "node", F.col("node").alias("comp")).union(
        size_of.select(
            F.col("hub").alias("group"), zero.alias("i"), F.explode(F.sequence(zero, _blocks(F.col("n"), block) - 1)).alias("j"),
            zero.alias("side"), F.col("hub").alias("node"), F.col("hub").alias("comp"),
        )
    )
    near = saved(_links(tasks, texts, size, percent))
    comps = saved(components(near))

    # Members that are not in their hub's component meet the other members of its group.
    root = lambda c: comps.select(F.col("node").alias(c), F.col("root").alias(f"{c}_root"))
    placed = (
        pairs.join(root("node"), "node", "left")
        .join(root("hub"), "hub", "left")
        .select("hub", "node", F.coalesce("node_root", "node").alias("comp"), F.coalesce("hub_root", "hub").alias("hub_comp"))
        .withColumn("out", F.col("comp") != F.col("hub_comp"))
    )
    placed = saved(placed)
    open_groups = placed.groupBy("hub").agg(F.count("*").alias("n"), F.count_if("out").alias("n_out")).filter("n > 1 and n_out > 0")
    dealt = placed.join(open_groups, "hub").select(
        F.col("hub").alias("group"), "node", "comp", "out", _blocks(F.col("n"), block).alias("nj"), _blocks(F.col("n_out"), block).alias("ni")
    )
    of = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(zero, F.col(n) - 1))
    tasks = dealt.filter("out").select("group", of("ni").alias("i"), every("nj").alias("j"), zero.alias("side"), "node", "comp").union(
        dealt.select("group", every("ni").alias("i"), of("nj").alias("j"), F.lit(1).alias("side"), "node", "comp")
    )
    more = saved(_links(tasks, texts, size, percent))
    roots = saved(components(near.union(more)))

    least = (
        nodes.filter("copies > 1").select("node").union(roots.select("node")).distinct()
        .join(nodes.select("node", "least"), "node")
        .join(roots, "node", "left")
        .select("node", F.coalesce("root", "node").alias("root"), "least")
    )
    of_root = least.groupBy("root").agg(F.min("least").alias("component_id"))
    known = saved(least.join(of_root, "root").select("node", "root", "component_id"))
    out = signed.select("doc_id", "n_shingles", "node").join(known, "node", "left")
    return out.select(
        "doc_id",
        "n_shingles",
        F.col("node").alias("digest"),
        F.coalesce("root", "node").alias("node"),
        F.coalesce("component_id", "doc_id").alias("component_id"),
    )


def _texts_of(docs: DataFrame, one: DataFrame, size: int) -> DataFrame:
    """(node, text) for the wanted (node, _id): the text of a row whose set is that node's."""
    rows = docs.select("doc_id", "text").join(one, docs["doc_id"].eqNullSafe(one["_id"])).select("node", "text")

    matching = rows.withColumn("digest", set_digest(F.col("text"), size)).filter("digest = node")
    return matching.groupBy("node").agg(F.min("text").alias("text"))


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id and whether the row's id is its component's."""
    linked = link(docs, size, percent)
    return linked.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def keep_one(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of docs without near duplicates: of each component one row with its smallest id stays.

    All columns are kept. Texts without words stay. Equal rows are one document.
    """
    name, key, found = fresh(docs, "digest"), fresh(docs, "winner_id"), fresh(docs, "winner_digest")
    linked = link(docs, size, percent).filter(F.col("node").isNotNull())
    best = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "digest")).alias("w")
    winners = linked.groupBy("node").agg(best).select(F.col("w.doc_id").alias(key), F.col("w.digest").alias(found))
    digested = docs.withColumn(name, set_digest(F.col("text"), size))
    same = F.col("doc_id").eqNullSafe(F.col(key)) & (F.col(name) == F.col(found))
    first = digested.join(winners, same).drop(key, found).dropDuplicates(["doc_id", name])
    return first.union(digested.filter(F.col(name).isNull())).drop(name)
