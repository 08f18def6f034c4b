"""The prefix tree of conversations, running totals and hot joins against brute force."""

import hashlib
import random
import zlib

import duckdb
import pytest
from llm_data import TESTDATA
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillworks.llm import conversation_trie, queries
from tillworks.llm.scans import join_hot, plus, scan_by_key, xor

SF = str(TESTDATA / "sf0.001")
TURNS = T.StructType(
    [T.StructField(c, t) for c, t in (("conv_id", T.LongType()), ("turn", T.LongType()), ("role", T.StringType()), ("text", T.StringType()))]
)


def slow_trie(rows):
    """The contract, node by node."""
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    key = lambda x: (x[0], x[1], hashlib.md5(f"{len(x[2].encode())}:{x[2]}{x[3]}".encode()).digest())
    own = {c: [x[2:] for x in sorted(turns, key=key)] for c, turns in own.items()}
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        rebuilt[c] = tuple(own.get(c - c % 5, [])[:h] + turns[h:])
    members = {}
    for c, s in rebuilt.items():
        for d in range(len(s) + 1):
            members.setdefault(s[:d], []).append(c)
    result = []
    for k, of in members.items():
        below = [m for m in members if m[: len(k)] == k]
        children = [m for m in below if len(m) == len(k) + 1]
        leaves = [m for m in below if not any(len(o) == len(m) + 1 and o[: len(m)] == m for o in below)]
        saved = sum((len(members[m]) - 1) * len(m[-1][1].encode()) for m in below if m)
        ended = ",".join(str(c) for c in sorted(of) if rebuilt[c] == k)
        parent = min(members[k[:-1]]) if k else None
        result.append((min(of), len(k), parent, len(of), len(children), len(leaves), saved, hashlib.sha256(ended.encode()).hexdigest()))
    return sorted(result, key=repr)


def found(spark, rows, tmp_path, partitions=3):
    path = str(tmp_path / "conversations.parquet")
    spark.createDataFrame(rows, TURNS).repartition(partitions).withColumn("px", F.lit("clash")).withColumn("N", F.lit(1)).write.mode("overwrite").parquet(path)
    return sorted((tuple(r) for r in queries.op12_conversation_trie(spark, str(tmp_path)).collect()), key=repr)


def test_trie_of_odd_conversations(spark, tmp_path):
    rows = [
        (None, 1, "user", "no conversation"),
        (0, None, None, None), (0, None, "user", "né"), (0, 3, "user", "b"), (0, 3, "user", "b"), (0, 3, "user", "a"),
        (1, 0, "user", ""), (2, 7, "", "x"), (3, 0, None, "x"), (4, 0, "x", ""),
        (12, 0, "user", "its base does not exist"), (13, 0, "user", "nor does this one's"),
    ]
    rnd = random.Random(3)
    for c in rnd.sample(range(20, 120), 60):
        rows += [(c, t, rnd.choice(["user", "assistant"]), rnd.choice(["a", "b", "long " * 9])) for t in range(rnd.randint(1, 6))]
    # A third of the conversations are copies of one, and one has a third of all turns.
    rows += [(c, t, "user", "copy") for c in range(200, 235) for t in range(2)]
    rows += [(301, t, "user", f"t{t % 7}") for t in range(150)]
    assert found(spark, rows, tmp_path) == slow_trie(rows)


def test_no_conversations(spark, tmp_path):
    assert found(spark, [], tmp_path, 1) == []
    assert found(spark, [(None, 1, "user", "x")], tmp_path, 1) == []


def test_query_equals_its_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM '{SF}/conversations.parquet'")
    got = queries.op12_conversation_trie(spark, SF)
    want = con.sql(queries.ORACLE_SQL["op12_conversation_trie"]).fetchall()
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def test_last_turns(spark):
    turns = spark.createDataFrame([(1, 0, "a"), (1, 1, "b")], "conv_id long, place long, text string")
    nodes = spark.createDataFrame([(1, 0), (1, 1), (1, 2)], "conv_id long, depth long")
    rows = conversation_trie.with_last_turns(nodes, turns).orderBy("depth").collect()
    assert [r.text for r in rows] == [None, "a", "b"]


@pytest.mark.parametrize("partitions", [1, 7])
def test_running_totals_of_a_key_that_spans_partitions(spark, partitions):
    rnd = random.Random(partitions)
    rows = [(1 if rnd.random() < 0.6 else rnd.randint(2, 40), i, rnd.getrandbits(60)) for i in range(3000)]
    df = spark.createDataFrame(rows, "k long, i long, v long")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        got = scan_by_key(df, "k", [F.asc("i")], n=(F.lit(1), F.sum, plus), x=(F.col("v"), F.bit_xor, xor)).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    n, x, want = {}, {}, []
    for k, i, v in rows:
        n[k], x[k] = n.get(k, 0) + 1, x.get(k, 0) ^ v
        want.append((k, i, v, n[k], x[k]))
    assert sorted(map(tuple, got)) == sorted(want)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_join_with_hot_keys(spark, how):
    rows = spark.createDataFrame([(1, i) for i in range(3000)] + [(i, 0) for i in range(2, 1500)] + [(None, 7)], "k long, v long")
    table = spark.createDataFrame([(i, 3000 if i == 1 else 1, str(i)) for i in range(1, 1400)], "k long, n long, name string")
    got = join_hot(rows, table, ["k"], "n", how).select("k", "v", "name")
    want = rows.join(table, ["k"], how).select("k", "v", "name")
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
