"""Approximate nearest neighbours with robust-pruned graphs.

Vectors are dealt into shards of bounded size. Each shard builds a directed graph: a greedy search
for a new vector proposes neighbours, and pruning keeps a candidate only if no kept neighbour is
closer to it, by a relaxed factor, than the vector itself; so edges point in different directions
and a search needs few steps. A query runs a beam search in every shard; the shards' best are then
measured exactly and merged.

Equal vectors would crowd out all other edges. A distinct vector is therefore one node, which
carries the few smallest ids that an answer can need.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillworks.session import saved

#: Vectors of a shard, edges of a node, length of the beam, and how far pruning is relaxed.
SHARD, DEGREE, BEAM, RELAXED = 4096, 32, 64, 1.2
_ENTRIES = 8


def _top(score: np.ndarray, n: int) -> np.ndarray:
    """Places of the n largest of each row, largest first."""
    n = min(n, score.shape[1])
    part = np.argpartition(-score, n - 1, axis=1)[:, :n]
    return np.take_along_axis(part, np.argsort(-np.take_along_axis(score, part, 1), axis=1, kind="stable"), 1)


def search(unit: np.ndarray, edges: np.ndarray, entries: np.ndarray, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """Beam search of all queries at once: the nodes visited last in the beam, nearest first, and their cosines.

    A beam holds the `beam` nearest nodes seen. In each step every query expands its nearest nodes
    that are not expanded yet; a query whose beam is all expanded is done. -1 fills what is missing.
    """
    q, wide = len(queries), min(beam, len(unit))
    seen = np.zeros((q, len(unit) + 1), bool)
    seen[:, len(unit)] = True  # missing edges point here
    start = np.unique(entries)
    node = np.tile(start, (q, 1))
    seen[:, start] = True
    score = queries @ unit[start].T
    node = np.pad(node, ((0, 0), (0, max(0, wide - node.shape[1]))), constant_values=-1)
    score = np.pad(score, ((0, 0), (0, max(0, wide - score.shape[1]))), constant_values=-np.inf)
    expanded = node < 0
    active = np.arange(q)
    while len(active):
        best = np.where(expanded[active], -np.inf, score[active])
        at = _top(best, 2)
        open_ = np.take_along_axis(best, at, 1) > -np.inf
        going = open_.any(axis=1)
        active, at, open_ = active[going], at[going], open_[going]
        if not len(active):
            break
        chosen = np.take_along_axis(node[active], at, 1)
        new = np.where(open_[:, :, None], edges[np.where(open_, chosen, 0)], len(unit)).reshape(len(active), -1)
        marks = expanded[active]
        np.put_along_axis(marks, at, marks[np.arange(len(active))[:, None], at] | open_, 1)
        expanded[active] = marks
        new = np.where(seen[active[:, None], new], len(unit), new)
        # The same node may be offered twice in one step.
        new = np.sort(new, axis=1)
        new[:, 1:][new[:, 1:] == new[:, :-1]] = len(unit)
        seen[active[:, None], new] = True
        fresh = new < len(unit)
        close = np.full(new.shape, -np.inf, np.float32)
        row, column = np.nonzero(fresh)
        close[row, column] = np.einsum("ij,ij->i", queries[active[row]], unit[new[row, column]])
        all_score = np.concatenate([score[active], close], axis=1)
        all_node = np.concatenate([node[active], np.where(fresh, new, -1)], axis=1)
        all_done = np.concatenate([expanded[active], ~fresh], axis=1)
        keep = _top(all_score, node.shape[1])
        score[active] = np.take_along_axis(all_score, keep, 1)
        node[active] = np.take_along_axis(all_node, keep, 1)
        expanded[active] = np.take_along_axis(all_done, keep, 1)
    order = np.argsort(-score, axis=1, kind="stable")
    return np.take_along_axis(node, order, 1), np.take_along_axis(score, order, 1)


def _prune(unit: np.ndarray, at: int, candidates: np.ndarray, degree: int, relaxed: float) -> np.ndarray:
    """Diverse neighbours of a node: nearest first, without those that a kept one is relaxed-closer to."""
    candidates = np.unique(candidates)
    candidates = candidates[(candidates >= 0) & (candidates != at) & (candidates < len(unit))]
    distance = 1 - unit[candidates] @ unit[at]
    order = np.argsort(distance, kind="stable")
    candidates, distance = candidates[order], distance[order]
    between = 1 - unit[candidates] @ unit[candidates].T
    kept, left = [], np.ones(len(candidates), bool)
    for i in range(len(candidates)):
        if left[i]:
            kept.append(i)
            if len(kept) == degree:
                break
            left &= relaxed * between[i] > distance
    return candidates[kept]


def build(unit: np.ndarray, degree: int = DEGREE, beam: int = BEAM, relaxed: float = RELAXED) -> tuple[np.ndarray, np.ndarray]:
    """(edges, entries) of a shard's graph over unit vectors; missing edges are len(unit).

    Nodes are inserted in batches that double up to a fiftieth of the shard: a batch searches the graph
    as it is, is pruned, and adds edges back. Entries are spread over the shard, so that a
    cluster that no edge leads to yet is still found.
    """
    n = len(unit)
    edges = np.full((n, degree), n, np.int32)
    order = np.random.default_rng(7).permutation(n)
    entries = order[:_ENTRIES]

    def link(node, found):
        kept = _prune(unit, node, np.concatenate([found, edges[node]]), degree, relaxed)
        edges[node] = n
        edges[node, : len(kept)] = kept
        return kept

    for node in entries:
        link(node, entries)
    done = len(entries)
    while done < n:
        batch = order[done : done + max(1, min(done, n // 50 + 1))]
        found, _ = search(unit, edges, entries, unit[batch], beam)
        back: dict[int, list[int]] = {}
        for node, near in zip(batch.tolist(), found):
            for other in link(node, near).tolist():
                back.setdefault(other, []).append(node)
        for other, new in back.items():
            free = np.flatnonzero(edges[other] == n)
            new = [x for x in new if x not in edges[other]]
            if len(new) <= len(free):
                edges[other, free[: len(new)]] = new
            else:
                link(other, np.array(new, np.int64))
        done += len(batch)
    return edges, entries


def _unit(matrix: np.ndarray) -> np.ndarray:
    return (matrix / np.linalg.norm(matrix, axis=1, keepdims=True)).astype(np.float32)


def usable(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """Rows whose vector is neither null nor all zero and has finite components only."""
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.filter(v.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(v, lambda x: x != 0))


def cosine(a: Column, b: Column) -> Column:
    """Cosine in double precision."""
    double = "array<double>"
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda i, j: i * j), F.lit(0.0), lambda s, t: s + t)
    x, y = a.cast(double), b.cast(double)
    return dot(x, y) / (F.sqrt(dot(x, x)) * F.sqrt(dot(y, y)))


def build_index(vectors: DataFrame, k: int = 5, shard: int = SHARD, degree: int = DEGREE, beam: int = BEAM) -> DataFrame:
    """Written table of all shards' graphs: shard, place, embedding, ids, edges, entry.

    Every usable row of vectors (vec_id, embedding of one length) is in it: a node is a distinct
    vector and carries the k + 1 smallest of its ids, as many as an answer of k can need.
    """
    rows = usable(vectors.select("vec_id", "embedding")).filter(F.col("vec_id").isNotNull()).distinct()
    smallest = Window.partitionBy("embedding").orderBy("vec_id")
    few = rows.withColumn("_n", F.row_number().over(smallest)).filter(F.col("_n") <= k + 1)
    nodes = saved(few.groupBy("embedding").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")))
    shards = max(1, -(-nodes.count() // shard))
    dealt = nodes.withColumn("shard", F.pmod(F.xxhash64("embedding"), F.lit(shards)).cast("int"))

    def graph(table: pa.Table) -> pa.Table:
        matrix = np.array(table.column("embedding").to_pylist(), np.float64).reshape(table.num_rows, -1)
        order = np.lexsort(matrix.T)  # a recomputed task builds the same graph
        edges, entries = build(_unit(matrix[order]), degree, beam)
        first = np.isin(np.arange(len(order)), entries)
        sorted_ = table.take(pa.array(order))
        return pa.table(
            {
                "shard": sorted_.column("shard"),
                "place": pa.array(np.arange(len(order)), pa.int32()),
                "embedding": sorted_.column("embedding"),
                "ids": sorted_.column("ids"),
                "edges": pa.array(list(edges), pa.list_(pa.int32())),
                "entry": pa.array(first),
            }
        )

    kinds = {f.name: f.dataType.simpleString() for f in nodes.schema.fields}
    schema = f"shard int, place int, embedding {kinds['embedding']}, ids {kinds['ids']}, edges array<int>, entry boolean"
    return saved(dealt.groupBy("shard").applyInArrow(graph, schema))


def nearest(index: DataFrame, queries: DataFrame, k: int = 5, beam: int = BEAM, block: int = 8192) -> DataFrame:
    """The k nearest found for each query: query_id, rank, vec_id, score.

    A row is no candidate for a query of its own id. Nearest means the largest cosine, computed
    exactly for the candidates found; ties go to the smaller vec_id. Queries with an unusable vector or
    a null vec_id take no part; of rows with equal id and vector one counts. Fewer candidates than k
    are all returned. Other columns play no part. Queries are dealt into blocks of about `block`
    vectors, and each block searches every shard in a task of its own, so a task's size has a bound.
    """
    asked = usable(queries.select(F.col("vec_id").alias("query_id"), "embedding")).filter(F.col("query_id").isNotNull())
    asked = saved(asked.distinct())
    distinct = saved(asked.select("embedding").distinct())  # queries with equal vectors are searched once
    blocks = max(1, -(-distinct.count() // block))
    last = index.agg(F.coalesce(F.max("shard"), F.lit(-1))).first()[0]
    every_shard = F.explode(F.sequence(F.lit(0), F.lit(last)) if last >= 0 else F.array().cast("array<int>"))
    each_block = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    graph = index.select("shard", each_block, "place", "embedding", "ids", "edges", "entry")
    # One row for each query and shard: that every shard is asked is the method.
    asks = distinct.withColumn("block", F.pmod(F.xxhash64("embedding", F.lit(1)), F.lit(blocks)).cast("int")).withColumn("shard", every_shard)
    null = lambda c: F.lit(None).cast(index.schema[c].dataType).alias(c)
    sides = graph.union(asks.select("shard", "block", null("place"), "embedding", null("ids"), null("edges"), null("entry")))
    kind, id_kind = (index.schema[c].dataType.simpleString() for c in ("embedding", "ids"))

    def find(table: pa.Table) -> pa.Table:
        place = np.array(table.column("place").fill_null(-1))
        matrix = np.array(table.column("embedding").to_pylist(), np.float64).reshape(len(place), -1)
        asking, own = np.flatnonzero(place < 0), np.flatnonzero(place >= 0)
        own = own[np.argsort(place[own])]
        take, found = [], []
        if len(asking) and len(own):
            edges = np.array(table.column("edges").take(pa.array(own)).to_pylist(), np.int64)
            entries = np.flatnonzero(np.array(table.column("entry").take(pa.array(own))))
            unit = _unit(matrix[own])
            for i in range(0, len(asking), 1024):
                part = asking[i : i + 1024]
                near, _ = search(unit, edges, entries, _unit(matrix[part]), beam)
                for a, row in zip(part.tolist(), near[:, : k + 1]):
                    for b in row[row >= 0].tolist():
                        take.append(a)
                        found.append(int(own[b]))
        vectors, ids = table.column("embedding"), table.column("ids")
        take, found = pa.array(take, pa.int64()), pa.array(found, pa.int64())
        return pa.table({"q": vectors.take(take), "v": vectors.take(found), "ids": ids.take(found)})

    pairs = sides.groupBy("shard", "block").applyInArrow(find, f"q {kind}, v {kind}, ids {id_kind}")
    scored = pairs.withColumn("score", cosine(F.col("q"), F.col("v"))).select("q", F.explode("ids").alias("vec_id"), "score")
    best = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    # One more than k for a query that finds itself.
    top = scored.withColumn("_n", F.row_number().over(best)).filter(F.col("_n") <= k + 1).drop("_n")
    own_order = Window.partitionBy("query_id", "embedding").orderBy(F.desc("score"), "vec_id")
    answers = asked.join(top, asked["embedding"] == top["q"]).filter("query_id <> vec_id")
    ranked = answers.withColumn("rank", F.row_number().over(own_order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
