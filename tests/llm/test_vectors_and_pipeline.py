"""Nearest neighbours against brute force, and the pipeline stage by stage."""

import numpy as np
import pyarrow as pa
import pytest
from llm_data import ODD, TESTDATA, documents  # noqa: F401
from pyspark.sql import functions as F

import corpus_pipeline
from tillworks.llm import harmonic_packing, line_runs, minmax_dedup, quality_bands, robust_graph


def exact(rows, queries, k):
    """Ids by largest cosine, ties to the smaller one."""
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v is not None and None not in v and np.isfinite(v).all() and np.any(v)]
    out = {}
    for q, v in good:
        if q in queries:
            s = [(-round(float(v @ w) / float(np.linalg.norm(v) * np.linalg.norm(w)), 12), i) for i, w in good if i != q]
            out[q] = [i for _, i in sorted(set(s))[:k]]
    return out


def test_few_rows_with_ties_copies_and_unusable_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 2.0]), (4, [0.0, 0.0]), (5, None), (6, [nan, 1.0]), (7, [inf, 1.0]), (8, [None, 1.0])]
    rows += [(None, [1.0, 1.0]), (9, [1.0, 0.0]), (9, [1.0, 0.0]), (10, [-1.0, 0.5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("rank", F.lit("x"))
    got = {}
    for r in robust_graph.nearest(robust_graph.build_index(df, 3), df, 3).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    assert got == exact(rows, {1, 2, 3, 4, 5, 6, 7, 8, 9, 10}, 3)
    none = df.filter("false")
    assert robust_graph.nearest(robust_graph.build_index(none), df).count() == 0
    assert robust_graph.nearest(robust_graph.build_index(df), none).count() == 0


def test_recall_over_several_shards_with_a_hot_vector(spark):
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(12, 24))
    rows = [(i, (centres[i % 12] + rng.normal(size=24)).astype(np.float32).tolist()) for i in range(1200)]
    rows += [(i, rows[0][1]) for i in range(1200, 1500)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    queries = set(range(0, 1500, 20))
    index = robust_graph.build_index(df, 5, shard=300)
    assert index.select("shard").distinct().count() > 3 and index.count() == 1200
    got, scores = {}, {}
    for r in robust_graph.nearest(index, df.filter("vec_id % 20 = 0"), 5, block=16).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
        scores[r["query_id"], r["vec_id"]] = r["score"]
    want = exact(rows, queries, 5)
    assert sum(len(set(got[q]) & set(want[q])) for q in queries) >= 0.95 * 5 * len(queries)
    assert got[0] == [1200, 1201, 1202, 1203, 1204] and abs(scores[0, 1200] - 1) < 1e-12


@pytest.mark.skipif(not (TESTDATA / "sf0.001").is_dir(), reason="no test tables")
def test_query_recall(spark):
    from tillworks.llm import queries as q

    sf = str(TESTDATA / "sf0.001")
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    queries = {i for i, _ in rows if i % 50 == 0}
    got = {}
    for r in q.op2_robust_graph(spark, sf).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    want = exact(rows, queries, 5)
    assert sum(len(got[i] & set(want[i])) for i in queries) >= 0.9 * 5 * len(queries)


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    """A folder whose documents are the odd rows and some prose."""
    folder = tmp_path_factory.mktemp("sf")
    shared = "a passage of many words that several documents hold as a line of their own"
    own = lambda i: " ".join(f"word{(i * 7919 + j * 104729) % 9973}" for j in range(60))
    rows = [(100 + i, f"{own(i)}\n{shared}\nmail me{i}@example.com now") for i in range(6)] + [(200, own(3) + " end"), (201, "menu | " * 100)]
    from llm_data import DOCS

    data = [(i, t, None, "s", None if t is None else len(t)) for i, t in ODD + rows]
    df = spark.createDataFrame(data, DOCS)
    df.withColumn("uid", F.lit(1)).withColumn("digest", F.lit("d")).withColumn("lines", F.lit(2)).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(100, 1, 0), (None, 1, None)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return str(folder)


def test_stages_follow_each_other(spark, sf_dir, tmp_path):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "near_dedup", "personal_data", "packing"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    after = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf_dir)
        if name != "packing":
            assert out.dtypes == docs.dtypes
        out.write.parquet(f"{tmp_path}/{name}")
        docs = after[name] = spark.read.parquet(f"{tmp_path}/{name}")
    texts = {n: {r["doc_id"]: r["text"] for r in d.collect()} for n, d in after.items() if n != "packing"}
    assert not {1, 2, 3, 4, 9, 201} & set(texts["quality_rules"]) and {5, 100, 200} <= set(texts["quality_rules"])
    assert "a passage" in texts["line_dedup"][100] and "a passage" not in texts["line_dedup"][101]
    assert after["line_dedup"].filter("doc_id = 5").count() == 1 and 6 not in texts["line_dedup"]
    assert 103 in texts["near_dedup"] and 200 not in texts["near_dedup"]
    assert all("[EMAIL]" in texts["personal_data"][100 + i] and "@" not in texts["personal_data"][100 + i] for i in range(6))
    assert after["personal_data"].filter("n_chars <> length(text)").count() == 0
    whole = corpus_pipeline.run(spark, sf_dir)
    assert sorted(map(repr, whole.select("doc_id", "start", "length", "ids_crc32").collect())) == sorted(
        map(repr, after["packing"].select("doc_id", "start", "length", "ids_crc32").collect())
    )


def test_stages_take_empty_tables(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").filter("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, sf_dir).count() == 0


def test_no_task_pairs_all_rows(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for df in (minmax_dedup.near_duplicates(docs), line_runs.removed_counts(docs), harmonic_packing.pack_documents(docs, corpus_pipeline.public_tokenizers.path("byte_bpe_50k.json"), 1)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_small_batches_bound_text_a_task_holds(spark):
    from tillworks.llm.memory import small_batches

    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.getAll.get(key)
    sizes = lambda batches: (pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["n"]) for b in batches)
    texts = spark.range(200, numPartitions=1).selectExpr("repeat('x', 100000) AS text")
    try:
        spark.conf.unset(key)
        small_batches(spark, "1m")
        assert texts.mapInArrow(sizes, "n long").agg(F.max("n")).first()[0] < 2 << 20
        spark.conf.set(key, "8m")
        small_batches(spark, "1m")
        assert spark.conf.get(key) == "8m"  # a bound of the session's own stays
    finally:
        spark.conf.unset(key)
        if before is not None:
            spark.conf.set(key, before)


def test_tasks_of_a_stage_run_a_python_function_once(spark, monkeypatch):
    def steps(plan):
        """Python functions that one task runs, at most: an executor keeps a worker for each of them."""
        below = plan.children()
        return max([0, *(steps(below.apply(i)) for i in range(below.size()))]) + (plan.nodeName() in ("ArrowEvalPython", "MapInArrow"))

    def noted(df):
        found.append(steps(df._jdf.queryExecution().optimizedPlan()))
        return collect(df)

    lines = [f"line {i} has words enough that a run of lines counts as repeated" for i in range(4)]
    rows = [(i, "\n".join([*lines, f"its own number is {i}"])) for i in range(4)] + [(4, None), (None, "a null id"), (0, "\n".join(lines))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_chars", F.length("text"))
    labels = spark.createDataFrame([(0, 1), (1, 1), (2, 0), (None, 1)], "doc_id long, quality int")
    found, collect = [], type(docs).collect
    monkeypatch.setattr(type(docs), "collect", noted)
    bands = quality_bands.fit_bands(docs, labels)
    assert found == [1]
    cut = corpus_pipeline._measured(line_runs.dedup_lines(docs, drop_emptied=True), docs)
    stages = {"quality_rules": quality_bands.keep(docs, bands), "line_dedup": cut, "near_dedup": minmax_dedup.keep_one(docs)}
    assert {k: steps(df._jdf.queryExecution().optimizedPlan()) for k, df in stages.items()} == dict.fromkeys(stages, 1)
    assert sorted(r["text"] or "" for r in cut.collect()) == ["", "a null id", *sorted([rows[0][1], *(f"its own number is {i}" for i in (1, 2, 3))])]


def test_packing_leaves_nothing_in_a_worker(spark):
    def held(batches):
        """MB of this task's worker."""
        for _ in batches:
            with open("/proc/self/smaps_rollup") as f:
                kb = next(int(line.split()[1]) for line in f if line.startswith("Anonymous:"))
            yield pa.RecordBatch.from_arrays([pa.array([kb // 1024])], ["mb"])

    words = F.concat_ws(" ", F.transform(F.sequence(F.lit(1), F.lit(12_000)), lambda x: F.md5(F.concat(x.cast("string"), F.lit("of"), F.col("doc_id")))))
    path = corpus_pipeline.public_tokenizers.path("byte_bpe_50k.json")

    def after(tasks):
        docs = spark.range(tasks, numPartitions=tasks).select(F.col("id").alias("doc_id"), F.translate(words, "0123456789", "ghijklmnop").alias("text"))
        harmonic_packing.cut_pieces(docs, path, end_id=1, memo_entries=6_000, keep_encoder=False).write.format("noop").mode("overwrite").save()
        return spark.range(32, numPartitions=32).mapInArrow(held, "mb long").agg(F.max("mb")).first()[0]

    cores = spark.sparkContext.defaultParallelism
    few = after(2 * cores)
    assert after(10 * cores) < few + 20
