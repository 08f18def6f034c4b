"""The prefix tree of conversations, by collapsing whole sequences.

Conversations with the same turns are one weighted sequence with the list of conversations that end
there. A sequence that is a proper prefix of another is no leaf: an anti-join against the parents of all
turns tells. Nodes are the distinct prefixes of the sequences, each with the sum of its sequences'
weights. Everything is joins and groupings of narrow rows (ids, hashes, lengths); texts are read once.

A prefix is named by its depth and 128 bits: the exclusive or of a hash of every turn together with its
place. That can be totalled over range partitions, so a conversation of any length spreads over tasks.

Subtree sums need no walk over the tree. The sum over a subtree of (n_convs - 1) * bytes is, over the
sequences that pass its top, weight times the bytes from there to the sequence's end, less the bytes
of the distinct nodes below. Each node is owned by the sequence with its smallest conversation; a
sequence owns its path from some depth on, so its share of the distinct bytes is the smaller of what is
left of it and what it owns.
"""

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillworks.llm.scans import join_hot, plus, scan_by_key, xor
from tillworks.session import saved

NODE = ["depth", "px", "py"]
_ID_BLOCK = 1 << 16


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, place, turn_id, n_bytes) of every turn, places from 0 in the order of turn, null first.

    Turns with the same number are ordered by the md5 of role and text, their turn_id. Null role and text
    are empty. Rows without a conv_id belong to no conversation and are left out.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    named = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    turns = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.unhex(F.md5(named.cast("binary"))).alias("turn_id"),
        F.octet_length(text).cast("long").alias("n_bytes"),
    )
    order = [F.asc_nulls_first("turn"), F.asc("turn_id")]
    numbered = scan_by_key(turns, "conv_id", order, n=(F.lit(1), F.sum, plus))
    return numbered.select("conv_id", (F.col("n") - 1).alias("place"), "turn_id", "n_bytes")


def forked(turns: DataFrame, base: Column, reach: int, shared: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first turns are those of another one: (conversations, their turns).

    base and shared are columns over conv_id: the conversation to take turns from, at most
    `reach` below or above, and how many, at most `most`. The first `shared` turns of base (all if it has
    fewer, none if it doesn't exist) are followed by a conversation's own turns after its first `shared`.
    The first result has every conv_id, also those left without a turn. `turns` is read several times.
    """
    convs = saved(turns.groupBy("conv_id").agg(F.count("*").alias("n_own")))
    wanted = convs.select("conv_id", base.alias("base"), shared.alias("shared"), "n_own")
    lengths = convs.select(F.col("conv_id").alias("base"), F.col("n_own").alias("n_base"))
    taken = F.least("shared", F.coalesce("n_base", F.lit(0)))
    info = saved(wanted.join(lengths, "base", "left").select("conv_id", "base", "n_own", "shared", taken.alias("taken")))

    # A base turn goes to the few conversations near it that take it.
    near = F.explode(F.sequence(F.col("conv_id") - reach, F.col("conv_id") + reach))
    heads = turns.filter(F.col("place") < most).select(F.col("conv_id").alias("from"), near.alias("conv_id"), "place", "turn_id", "n_bytes")
    heads = heads.filter((base == F.col("from")) & (F.col("place") < shared)).join(info.select("conv_id"), "conv_id", "left_semi")
    tails = join_hot(turns.filter(F.col("place") >= shared), info.select("conv_id", "n_own", "shared", "taken"), ["conv_id"], "n_own")
    tails = tails.withColumn("place", F.col("taken") + F.col("place") - F.col("shared"))
    columns = ["conv_id", "place", "turn_id", "n_bytes"]
    return info.select("conv_id"), heads.select(*columns).unionByName(tails.select(*columns))


def prefixes(turns: DataFrame) -> DataFrame:
    """The prefix that ends with each turn: its name, its parent's, and the bytes of its last turn and of all."""
    hashed = turns.select(
        "conv_id",
        (F.col("place") + 1).alias("depth"),
        F.xxhash64("place", "turn_id").alias("x"),
        F.xxhash64(F.lit("y"), F.col("turn_id"), F.col("place")).alias("y"),
        "n_bytes",
    )
    named = scan_by_key(
        hashed, "conv_id", [F.asc("depth")],
        px=(F.col("x"), F.bit_xor, xor), py=(F.col("y"), F.bit_xor, xor), until=(F.col("n_bytes"), F.sum, plus),
    )
    parent = [F.col(p).bitwiseXOR(F.col(x)).alias(q) for p, x, q in (("px", "x", "qx"), ("py", "y", "qy"))]
    return named.select("conv_id", *NODE, *parent, "n_bytes", "until")


def trie(conversations: DataFrame, turns: DataFrame) -> DataFrame:
    """One row for each distinct sequence of first turns, from the root without a turn.

    conversations has every conv_id once, turns (conv_id, place, turn_id, n_bytes) with places from 0
    without gaps. Per node: conv_id, the smallest conversation that starts with it; depth; parent_conv_id,
    its parent's (null at the root); n_convs; n_children; n_leaves, the childless nodes of its subtree;
    saved_tokens, the sum over its subtree of (n_convs - 1) times the bytes of the node's last text;
    ends_sha256, of the ids of the conversations that end here, ascending and comma-joined. A node's
    last turn is turn `depth - 1` of conversation conv_id. No conversation, no node.
    """
    paths = saved(prefixes(turns))
    zero = F.lit(0).cast("long")
    last = paths.groupBy("conv_id").agg(F.max(F.struct(*NODE, "until")).alias("last"))
    ended = conversations.select("conv_id").join(last, "conv_id", "left")
    ended = saved(ended.select("conv_id", *[F.coalesce(F.col("last")[c], zero).alias(c) for c in [*NODE, "until"]]))

    # Identical conversations are one sequence; those that end at another one's parent are no leaves.
    parents = paths.select((F.col("depth") - 1).alias("depth"), F.col("qx").alias("px"), F.col("qy").alias("py")).distinct()
    sequences = ended.groupBy(*NODE).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("weight"), F.max("until").alias("total"))
    sequences = saved(sequences)
    leaves = sequences.join(parents, NODE, "left_anti").select("conv_id", F.lit(1).cast("long").alias("leaf"))
    shown = saved(
        sequences.join(leaves, "conv_id", "left").select(
            "conv_id", F.col("depth").alias("n_turns"), "weight", "total", F.coalesce("leaf", zero).alias("leaf")
        )
    )

    # The path of each sequence, as that of its smallest conversation.
    lengths = ended.select("conv_id", F.col("depth").alias("n_turns"))
    chosen = saved(lengths.join(shown.drop("n_turns"), "conv_id", "left"))
    steps = join_hot(paths, chosen, ["conv_id"], "n_turns").filter(F.col("weight").isNotNull())
    roots = shown.select("conv_id", *[zero.alias(c) for c in [*NODE, "qx", "qy", "n_bytes", "until"]], "weight", "total", "leaf")
    left = F.col("total") - F.col("until") + F.col("n_bytes")
    steps = saved(steps.select(*roots.columns).unionByName(roots).withColumn("left", left))

    nodes = saved(
        steps.groupBy(*NODE).agg(
            F.min("conv_id").alias("conv_id"),
            F.sum("weight").alias("n_convs"),
            F.sum("leaf").alias("n_leaves"),
            F.min("qx").alias("qx"),
            F.min("qy").alias("qy"),
            F.sum(F.col("weight") * F.col("left")).alias("all_bytes"),
            F.count("*").alias("n_steps"),
        )
    )
    owners = nodes.select(*NODE, F.col("conv_id").alias("owner"), "n_steps")
    owned = join_hot(steps, owners, NODE, "n_steps").filter("owner = conv_id").groupBy("conv_id").agg(F.max("left").alias("owned"))
    shares = saved(shown.select("conv_id", "n_turns").join(owned, "conv_id", "left").fillna(0, ["owned"]))
    # A sequence has a step for each turn and one at the root.
    shares = shares.withColumn("n_turns", F.col("n_turns") + 1)
    distinct_bytes = (
        join_hot(steps, shares, ["conv_id"], "n_turns").groupBy(*NODE).agg(F.sum(F.least("left", "owned")).alias("distinct_bytes"))
    )

    child_of = nodes.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("qx").alias("px"), F.col("qy").alias("py"))
    children = child_of.agg(F.count("*").alias("n_children"))
    complete = saved(
        nodes.join(distinct_bytes, NODE)
        .join(children, NODE, "left")
        .join(ends(ended), NODE, "left")
        .select(
            "conv_id", *NODE, "qx", "qy", "n_convs", F.coalesce("n_children", zero).alias("n_children"), "n_leaves",
            (F.col("all_bytes") - F.col("distinct_bytes")).alias("saved_tokens"),
            F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
        )
    )
    above = ["up", "qx", "qy"]
    tops = complete.filter("n_children > 0").select(
        F.col("depth").alias("up"), F.col("px").alias("qx"), F.col("py").alias("qy"),
        F.col("conv_id").alias("parent_conv_id"), F.col("n_children").alias("n_below"),
    )
    return join_hot(complete.withColumn("up", F.col("depth") - 1), tops, above, "n_below", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
    )


def ends(ended: DataFrame) -> DataFrame:
    """ends_sha256 of every node at which conversations end.

    The ids of a node are joined in blocks of neighbouring numbers, one short text each, and a node's
    blocks are hashed in order as they stream past: SHA-256 takes its bytes one after the other, so
    this is the one part of a hot node that no further task can share, and it holds a block at a time.
    """
    block = F.floor(F.col("conv_id") / _ID_BLOCK).alias("block")
    joined = F.array_join(F.array_sort(F.collect_list("conv_id")).cast("array<string>"), ",")
    blocks = ended.groupBy(*NODE, block).agg(joined.alias("ids"))
    names = [*NODE, "ends_sha256"]
    schema = T.StructType([T.StructField(c, T.LongType()) for c in NODE] + [T.StructField("ends_sha256", T.StringType())])

    def stream(batches):
        node, digest = None, None
        for batch in batches:
            done = []
            columns = [batch.column(c).to_pylist() for c in (*NODE, "ids")]
            for depth, px, py, ids in zip(*columns):
                if (depth, px, py) == node:
                    digest.update(b",")
                else:
                    if node is not None:
                        done.append((*node, digest.hexdigest()))
                    node, digest = (depth, px, py), hashlib.sha256()
                digest.update(ids.encode())
            yield _rows(done)
        if node is not None:
            yield _rows([(*node, digest.hexdigest())])

    def _rows(rows):
        columns = list(zip(*rows)) or [()] * 4
        types = [pa.int64()] * 3 + [pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    return blocks.repartition(*NODE).sortWithinPartitions(*NODE, "block").mapInArrow(stream, schema)


def with_last_turns(nodes: DataFrame, turns: DataFrame) -> DataFrame:
    """Nodes with the columns of their last turn, from turns (conv_id, place, ...); null at the root."""
    return nodes.join(turns.withColumn("depth", F.col("place") + 1).drop("place"), ["conv_id", "depth"], "left")
