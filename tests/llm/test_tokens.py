"""Encoding, counting, packing and token files against the libraries themselves."""

import hashlib
import random
import time
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_data import ODD, TESTDATA, documents  # noqa: F401
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tillworks.llm import block_join, harmonic_packing, library_ids, prefix_bpe, simple8b, token_counts

JSON = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
VOCABULARY = prefix_bpe.vocabulary(RANKS, public_tokenizers.PATTERN)
TIKTOKEN = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=VOCABULARY.ranks, special_tokens={})
LIBRARY = Tokenizer.from_file(JSON)
TEXT = st.text(st.sampled_from(list("abcdeTHE  \n\t'sdtre019äß漢😀_-=+!.\x1c᠎ ")), max_size=60)


def library(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@settings(max_examples=400, deadline=None)
@given(TEXT)
def test_encoders_equal_the_libraries(text):
    assert np.frombuffer(library_ids.library_encoder(JSON).encode(text), "<u4").tolist() == library(text)
    ids = np.frombuffer(VOCABULARY.encode(text), "<u4").tolist()
    assert ids == TIKTOKEN.encode_ordinary(text)
    assert VOCABULARY.decode(ids) == text.encode()


@pytest.mark.parametrize("text", ["a<|endoftext|> b", "<|endoftext|>", "x <|endoftext|><|endoftext|>\n y"])
def test_special_strings(text):
    assert np.frombuffer(library_ids.library_encoder(JSON).encode(text), "<u4").tolist() == library(text)


@pytest.mark.parametrize("text", ["a" * 3000, " " * 2000, "ab" * 1500, "\n \n" * 500])
def test_long_pieces(text):
    assert np.frombuffer(VOCABULARY.encode(text), "<u4").tolist() == TIKTOKEN.encode_ordinary(text)


def test_two_tokens_may_stand_together_where_merging_gives_them():
    rng = random.Random(5)
    for _ in range(3000):
        a, b = rng.randrange(2000), rng.randrange(2000)
        both = prefix_bpe.merged(VOCABULARY.token[a] + VOCABULARY.token[b], VOCABULARY.ranks)
        assert VOCABULARY.may_follow(a, b) == (both == [VOCABULARY.token[a], VOCABULARY.token[b]])


@settings(max_examples=200, deadline=None)
@given(TEXT, st.lists(st.tuples(st.floats(0, 1), st.integers(0, 6), TEXT.map(lambda t: t[:5])), max_size=4))
def test_edits_equal_encoding_anew(text, edits):
    held = prefix_bpe.EncodedText(VOCABULARY, text)
    for at, length, new in edits:
        start = int(at * len(held.text))
        held.replace(start, min(start + length, len(held.text)), new)
        assert held.ids() == TIKTOKEN.encode_ordinary(held.text)
    held.append(" more'")
    held.append("s")
    assert held.ids() == TIKTOKEN.encode_ordinary(held.text)


def test_edit_column(spark):
    rows = [("ab cd", [(2, 3, "x"), (9, 9, "!")]), (None, None), ("abc", [(0, 0, None)])]
    df = spark.createDataFrame(rows, "text string, edits array<struct<start:int,stop:int,new:string>>")
    got = [r[0] for r in df.select(prefix_bpe.edit(F.col("text"), F.col("edits"), RANKS, public_tokenizers.PATTERN)).collect()]
    assert got == [TIKTOKEN.encode_ordinary(t) for t in ("abxcd!", "", "abc")]


def test_round_trip_of_odd_rows(documents):
    rows = prefix_bpe.round_trip(documents(*ODD), RANKS, public_tokenizers.PATTERN).collect()
    got = sorted((repr(r["doc_id"]), r["ids"], bytes(r["decoded"])) for r in rows)
    assert got == sorted((repr(i), TIKTOKEN.encode_ordinary(t or ""), (t or "").encode()) for i, t in ODD)


def test_round_trip_takes_one_python_worker_a_task(documents):
    both = prefix_bpe.round_trip(documents(*ODD), RANKS, public_tokenizers.PATTERN)
    assert both._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1


def test_columns_equal_the_round_trip(documents):
    docs = documents(*ODD)
    ids = docs.select("doc_id", prefix_bpe.encode(F.col("text"), RANKS, public_tokenizers.PATTERN).alias("ids"))
    apart = ids.select("doc_id", "ids", prefix_bpe.decode(F.col("ids"), RANKS, public_tokenizers.PATTERN).alias("decoded"))
    both = prefix_bpe.round_trip(docs, RANKS, public_tokenizers.PATTERN)
    assert both.columns == apart.columns
    assert sorted(map(repr, both.collect())) == sorted(map(repr, apart.collect()))


def test_op1_bounds_the_text_that_a_worker_holds(documents, spark, tmp_path):
    from tillworks.llm import queries as q

    documents(*ODD).write.parquet(str(tmp_path / "documents.parquet"))
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.getAll.get(key)
    try:
        spark.conf.unset(key)
        rows = q.op1_prefix_bpe(spark, str(tmp_path)).collect()
        assert spark.conf.get(key) == "4m"
    finally:
        spark.conf.unset(key)
        if before is not None:
            spark.conf.set(key, before)
    sha = lambda raw: hashlib.sha256(raw).hexdigest()
    ids = [TIKTOKEN.encode_ordinary(t or "") for _, t in ODD]
    want = [(i, len(x), sha(" ".join(map(str, x)).encode()), sha((t or "").encode())) for (i, t), x in zip(ODD, ids)]
    assert sorted(map(repr, map(tuple, rows))) == sorted(map(repr, want))


@pytest.mark.parametrize("block_chars", [40, block_join.BLOCK_CHARS])
def test_counts_of_odd_rows(documents, block_chars):
    got = sorted((repr(r[0]), r[1], r[2]) for r in token_counts.count(documents(*ODD), JSON, block_chars).collect())
    assert got == sorted((repr(i), len((t or "").encode()), len(library(t))) for i, t in ODD)


def test_empty_tables(documents, spark, tmp_path):
    none = documents((1, "x")).filter("false")
    assert prefix_bpe.round_trip(none, RANKS, public_tokenizers.PATTERN).count() == 0
    assert token_counts.count(none, JSON).count() == 0
    assert harmonic_packing.pack_documents(none, JSON, 1).count() == 0
    simple8b.write_files(none, str(tmp_path / "none"), JSON, 0)
    assert simple8b.index(none, str(tmp_path / "none")).count() == 0


@given(st.integers(0, 10_000), st.sampled_from([(2048, 16), (64, 1), (64, 64), (1024, 8)]))
def test_cuts(n, sizes):
    capacity, least = sizes
    cut = harmonic_packing.cut_lengths(n, capacity, least)
    assert sum(cut) == n and all(0 < c <= capacity for c in cut)
    assert all(c & (c - 1) == 0 for c in cut[:-1]) and sum(c < least for c in cut) <= 1


def check_packed(rows, docs, capacity, end):
    """Every id of every row lies in one piece, and sequences have no gaps and fit."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault((repr(r["doc_id"]), r["doc_tokens"]), []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= capacity
    want = []
    for i, t in docs:
        ids, at = [*library(t), end], 0
        for n in harmonic_packing.cut_lengths(len(ids), capacity):
            want.append((repr(i), at, n, crc(ids[at : at + n]), len(ids)))
            at += n
    assert sorted(want) == sorted((repr(r["doc_id"]), r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in rows)
    return by_sequence


def test_packing_of_odd_rows(documents):
    packed = harmonic_packing.pack_documents(documents(*ODD), JSON, 1, capacity=64)
    check_packed(packed.collect(), ODD, 64, 1)


def test_classes_hold_a_fixed_number(spark):
    """Workers fill their own bins: two halves, three thirds; a short last bin of halving sizes is a power of two."""
    rows = [(w, i, n) for w in (0, 1) for i, n in enumerate([32] * 5 + [21] * 4 + [16] * 7 + [64] * 2)]
    pieces = spark.createDataFrame(rows, "worker int, doc_id long, length long")
    bins = {}
    for r in harmonic_packing.pack(pieces, [F.col("doc_id")], capacity=64).collect():
        bins.setdefault(r["sequence_id"], []).append(r["length"])
    assert sorted(map(tuple, bins.values())) == sorted(2 * [(32, 32), (32, 32), (32,), (21, 21, 21), (21,), (16,) * 4, (16,) * 2, (16,), (64,), (64,)])


def test_sequences_and_padding(documents):
    packed = harmonic_packing.pack_documents(documents("one two three", "four five"), JSON, 1, capacity=64, keep_ids=True).cache()
    rows = harmonic_packing.sequences(packed, 64, pad_id=9).collect()
    assert all(len(r["ids"]) == 64 or r["n_tokens"] & (r["n_tokens"] - 1) == 0 for r in rows)
    assert harmonic_packing.padding(packed, 64).first()["tokens"] == len(library("one two three") + library("four five")) + 2


@settings(deadline=None)
@given(st.lists(st.integers(0, 2**63) | st.integers(0, 3) | st.integers(0, 50_000) | st.just(0), max_size=3000), st.sampled_from([64, 1024]))
def test_words_round_trip(ids, block):
    ids = np.array(ids, np.uint64)
    assert (simple8b.unpack_words(*simple8b.pack_words(ids, block), len(ids), block) == ids).all()


def test_selectors_take_as_many_as_fit():
    words, begin, odd = simple8b.pack_words(np.array([1] * 60 + [5] * 20 + [1 << 61], np.uint64))
    assert (words >> np.uint64(60)).tolist() == [2, 4, 1] and begin.tolist() == [0] and odd.tolist() == [1 << 61]


def by_running_minima(values):
    """Selectors of words at each place, from the next place with an id that is too wide for each width."""
    plain = [s for s in range(16) if s != simple8b.ESCAPE]
    need = np.searchsorted(np.array([1 << int(simple8b.WIDTHS[s]) for s in plain], np.uint64), values, side="right")
    place, chosen = np.arange(len(values)), np.full(len(values), 15, np.uint8)
    for at in range(len(plain) - 2, -1, -1):
        first = np.minimum.accumulate(np.where(need > at, place, np.iinfo(np.int64).max)[::-1])[::-1]
        chosen[first - place >= simple8b.COUNTS[plain[at]]] = plain[at]
    chosen[need == len(plain)] = simple8b.ESCAPE
    return chosen


@settings(deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1) | st.integers(0, 70_000) | st.integers(0, 3) | st.just(0), min_size=1, max_size=1500), st.integers(0, 300))
def test_selectors_are_those_of_running_minima(ids, zeros):
    ids = np.array(ids[: len(ids) // 2] + [0] * zeros + ids[len(ids) // 2 :], np.uint64)
    assert (simple8b._selectors(ids) == by_running_minima(ids)).all()


def test_packing_takes_less_than_running_minima_alone():
    ids = np.random.default_rng(7).zipf(1.2, 1 << 19).astype(np.uint64) % np.uint64(50_257)

    def seconds(work):
        began = time.process_time()
        work()
        return time.process_time() - began

    both = [(seconds(lambda: simple8b.pack_words(ids)), seconds(lambda: by_running_minima(ids))) for _ in range(5)]
    assert min(x for x, _ in both) < min(x for _, x in both)


def test_segments_follow_each_other():
    parts = [simple8b.segment(3, n, ids, [np.array(d, "<u4").tobytes() for d in docs]) + b"\n" for n, (ids, docs) in enumerate([([7, None], [[1, 2], []]), ([-5], [[3]])])]
    got = [(p, n, i, lengths.tolist(), ids.tolist()) for p, n, i, lengths, ids in simple8b.read_segments(b"".join(parts))]
    assert got == [(3, 0, [7, None], [2, 0], [1, 2]), (3, 1, [-5], [1], [3])]
    with pytest.raises(ValueError):
        list(simple8b.read_segments(parts[0][:-8]))


def test_files_of_odd_rows(documents, tmp_path):
    docs = documents(*ODD).repartition(3)
    simple8b.write_files(docs, str(tmp_path / "tokens"), JSON, 0)
    rows = sorted(simple8b.index(docs, str(tmp_path / "tokens")).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in rows] == sorted((i for i, _ in ODD), key=lambda i: -1 if i is None else i)
    at = 0
    for r in rows:
        assert r["start"] == at
        at += r["n_tokens"]
    want = sorted((repr(i), len(library(t)) + 1, crc([*library(t), 0])) for i, t in ODD)
    assert sorted((repr(r["doc_id"]), r["n_tokens"], r["ids_crc32"]) for r in rows) == want


def test_files_need_integer_ids(spark, tmp_path):
    with pytest.raises(TypeError):
        simple8b.write_files(spark.createDataFrame([("a", "b")], "doc_id string, text string"), str(tmp_path), JSON, 0)


@pytest.mark.skipif(not (TESTDATA / "sf0.001").is_dir(), reason="no test tables")
def test_queries_over_the_smallest_tables(spark):
    from tillworks.llm import queries as q

    sf = str(TESTDATA / "sf0.001")
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    ids = {i: library(t) for i, t in texts.items()}
    assert {r["doc_id"]: (r["n_tokens"], r["over_limit"]) for r in q.op3_token_counts(spark, sf).collect()} == {i: (len(x), len(x) > 1024) for i, x in ids.items()}
    assert {r["doc_id"]: r["n_tokens"] for r in q.op1_prefix_bpe(spark, sf).collect()} == {i: len(TIKTOKEN.encode_ordinary(t)) for i, t in texts.items()}
    check_packed(q.op6_harmonic_packing(spark, sf).collect(), sorted(texts.items()), 2048, 1)
    got = {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in q.op7_simple8b(spark, sf).collect()}
    at = 0
    for i in sorted(ids):
        assert got[i] == (at, len(ids[i]) + 1, crc([*ids[i], 0]))
        at += len(ids[i]) + 1


@pytest.mark.parametrize("text", ["one two  three\n four's 5 x" * 40, "a" * 500, "a " * 250, " " * 300 + "b" * 300, "é 漢字 x  y" * 40])
def test_texts_are_split_at_any_length(monkeypatch, text):
    monkeypatch.setattr(library_ids, "_AT_ONCE", 7)
    assert "".join(library_ids.stretches(text)) == text
    assert np.frombuffer(library_ids.library_encoder(JSON).encode(text), "<u4").tolist() == library(text)
    assert np.frombuffer(VOCABULARY.encode(text), "<u4").tolist() == TIKTOKEN.encode_ordinary(text)
