"""The registered queries of the training-text operators, each over its whole table."""

import uuid
from collections.abc import Callable

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillworks.llm import conversation_trie, harmonic_packing, line_runs, minmax_dedup, ngram_difference, periodic_runs, pii_crf, prefix_bpe, quality_bands, robust_graph, run_sql, simple8b, subword_bags, token_counts, trie_sql
from tillworks.llm.memory import small_batches
from tillworks.session import saved, shared_dir

BPE_JSON = "byte_bpe_50k.json"
TOKEN_LIMIT = 1024
BPE_RANKS = "byte_bpe_50k.tiktoken"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_prefix_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)  # the batch, its ids and its decoded bytes stand in the worker and the JVM at once
    docs = _table(spark, sf_dir, "documents")
    done = prefix_bpe.round_trip(docs, public_tokenizers.path(BPE_RANKS), public_tokenizers.PATTERN)
    return done.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op2_robust_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    index = robust_graph.build_index(vectors, k=5)
    return robust_graph.nearest(index, vectors.filter(F.col("vec_id") % 50 == 0), k=5)


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.count(_table(spark, sf_dir, "documents"), public_tokenizers.path(BPE_JSON))
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op4_pii_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_crf.find_personal(_table(spark, sf_dir, "documents"))


def op5_ngram_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    return ngram_difference.score(docs, ngram_difference.fit(docs, labels.filter("quality = 1")))


def op6_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    packed = harmonic_packing.pack_documents(docs, public_tokenizers.path(BPE_JSON), end_id=1)
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op7_simple8b(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    folder = f"{shared_dir(spark)}/tillworks/{spark.sparkContext.applicationId}/tokens/{uuid.uuid4().hex}"
    simple8b.write_files(docs, folder, public_tokenizers.path(BPE_JSON), end_id=0)
    return simple8b.index(docs, folder)


def op8_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = line_runs.removed_counts(_table(spark, sf_dir, "documents"))
    return counted.select("doc_id", "n_lines", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op9_minmax_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minmax_dedup.near_duplicates(_table(spark, sf_dir, "documents"), size=2)


def op10_compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    bands = quality_bands.fit_bands(docs, _table(spark, sf_dir, "labels"))
    return quality_bands.judge(docs, bands)


def _repeated(text: str | None, h: int) -> str | None:
    """The text; or, where the last digit of h is 0, its words with a stretch of them repeated to the end.

    From word a on, word i becomes word a + (i - a) % p.
    """
    words = (text or "").encode().split() if h % 10 == 0 else []
    if not words:
        return text
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    stretch = words[a : a + p]
    return b" ".join(words[:a] + (stretch * ((n - a) // p + 1))[: n - a]).decode()


@F.arrow_udf(T.StringType())
def _with_repeats(texts: pa.Array, hashes: pa.Array) -> pa.Array:
    # A row without an id has no hash, and keeps its text.
    return pa.array([_repeated(x.as_py(), 1 if h.as_py() is None else h.as_py()) for x, h in zip(texts, hashes)], pa.string())


def op11_run_catchers(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    docs = _table(spark, sf_dir, "documents").select("doc_id", _with_repeats("text", h).alias("text"))
    found = periodic_runs.find_runs(docs)
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    sha = lambda text: F.sha2(text.cast("binary"), 256)
    longest = periodic_runs.longest("runs")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[longest[c].alias(c) for c in ("start", "length", "period")],
        F.floor(1000 * longest["length"] / longest["period"]).cast("long").alias("exponent_milli"),
        sha(F.array_join(lines, "")).alias("runs_sha256"),
        sha(F.col("collapsed")).alias("collapsed_sha256"),
        "n_words",
    )


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = saved(conversation_trie.numbered_turns(_table(spark, sf_dir, "conversations")))
    c = F.col("conv_id")
    shared = F.crc32(c.cast("string").cast("binary")) % 9
    conversations, rebuilt = conversation_trie.forked(turns, base=c - c % 5, reach=4, shared=shared, most=8)
    return conversation_trie.trie(conversations, rebuilt)


def op13_subword_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    model = subword_bags.fit(docs, labels.filter(~held_out))
    scored = subword_bags.score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_prefix_bpe, op2_robust_graph, op3_token_counts, op4_pii_crf, op5_ngram_difference, op6_harmonic_packing, op7_simple8b, op8_line_runs, op9_minmax_dedup, op10_compression_bands, op11_run_catchers, op12_conversation_trie, op13_subword_toxicity)
}

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: SQL counterparts by query, where SQL can express the result; the others need a library, a model or
#: a graph search.
ORACLE_SQL: dict[str, str] = {
    "op11_run_catchers": run_sql.RUNS,
    "op12_conversation_trie": trie_sql.TRIE,
    "op9_minmax_dedup": f"""WITH RECURSIVE words AS (
        SELECT doc_id, regexp_extract_all(
            translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[^\\x20\\x09-\\x0D]+') AS w
        FROM documents
    ),
    sets AS (
        SELECT doc_id, CASE WHEN len(w) < 2 THEN w ELSE list_distinct(
            list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s
        FROM words
    ),
    shingles AS (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets),
    links AS (
        SELECT a.doc_id AS x, b.doc_id AS y FROM shingles a JOIN shingles b USING (shingle)
        WHERE a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id, a.n, b.n
        HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
    ),
    reached AS (
        SELECT doc_id, doc_id AS other FROM sets
        UNION
        SELECT r.doc_id, l.y FROM reached r JOIN links l ON l.x = r.other
    ),
    roots AS (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id)
    SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
    FROM sets JOIN roots USING (doc_id)""",
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE_SQL)
