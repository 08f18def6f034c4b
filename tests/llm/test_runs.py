"""Runs of repeated words against brute force."""

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_data import ODD, TESTDATA, documents  # noqa: F401
from pyspark.sql import functions as F

from tillworks.llm import queries
from tillworks.llm.periodic_runs import RunCatcher, collapsed, find_runs, longest, runs_of

SF = str(TESTDATA / "sf0.001")


def slow_runs(words, min_length=12):
    """Stretches of equal words at every distance; of equal stretches the one of smallest period."""
    n, found = len(words), {}
    for p in range(1, n):
        i = 0
        while i + p < n:
            start = i
            while i + p < n and words[i] == words[i + p]:
                i += 1
            length = i - start + p
            if i > start and length >= max(min_length, 2 * p):
                found.setdefault((start, length), p)
            i += i == start
    return sorted(((s, length, p) for (s, length), p in found.items()), key=lambda r: (r[0], r[2]))


@st.composite
def repetitive(draw):
    words = draw(st.lists(st.integers(0, draw(st.sampled_from([0, 1, 2, 5, 30]))), max_size=90))
    for _ in range(draw(st.integers(0, 3)) if words else 0):
        start = draw(st.integers(0, len(words) - 1))
        period, end = draw(st.integers(1, 20)), draw(st.integers(start, len(words)))
        for i in range(min(start + period, end), end):
            words[i] = words[i - period]
    return words


@settings(max_examples=600, deadline=None)
@given(repetitive(), st.sampled_from([5, 8, 12, 30]))
def test_runs_of_random_sequences(words, min_length):
    assert runs_of(words, min_length) == slow_runs(words, min_length)


@settings(max_examples=100, deadline=None)
@given(repetitive())
def test_word_by_word_is_the_same_and_reports_squares(words):
    catcher = RunCatcher()
    for n, word in enumerate(words, 1):
        for start, period in catcher.append(word):
            assert start + 2 * period == n
            assert words[start : start + period] == words[start + period : n]
        assert catcher.runs() == slow_runs(words[:n])


def test_squares_of_a_run_are_reported_from_its_second_period_on():
    catcher = RunCatcher()
    ends = [n for n, word in enumerate("a b c d e f g".split() * 3) if (n - 13, 7) in catcher.append(word)]
    assert ends == list(range(13, 21))


@pytest.mark.parametrize("words", [["x"] * 20_000, [i % 997 for i in range(50_000)], [i % 7 for i in range(9)] * 2000])
def test_long_runs(words):
    (run,) = runs_of(words)
    assert run[:2] == (0, len(words))
    assert collapsed(words, [run]) == words[: run[2]]


def test_two_runs_that_overlap_and_words_dropped_once():
    words = "q a b a b a b a b a b a b a c c c c c c c c c c c c z".split()
    runs = runs_of(words)
    assert runs == slow_runs(words) == [(1, 13, 2), (14, 12, 1)]
    assert collapsed(words, runs) == "q a b c z".split()


def test_min_length_is_checked():
    with pytest.raises(ValueError):
        RunCatcher(4)


def test_odd_rows_and_extra_columns(spark, documents):
    docs = documents(*ODD).withColumn("Runs", F.lit("theirs")).withColumn("found", F.lit(1))
    rows = find_runs(docs).collect()
    assert len(rows) == len(ODD)
    assert {"doc_id", "text", "found", "n_words", "runs", "collapsed"} <= set(rows[0].asDict())
    want = {i: (t or "") for i, t in ODD if i is not None}
    for r in rows:
        if r.doc_id is not None:
            words = want[r.doc_id].encode().split()
            runs = [(0, 5000, 1)] if r.doc_id == 9 else slow_runs(words)
            assert r.n_words == len(words) and [tuple(x) for x in r.runs] == runs
            assert r.collapsed == b" ".join(collapsed(words, runs)).decode()
    assert find_runs(docs.limit(0)).count() == 0


def test_longest_run_prefers_the_first_start(spark):
    df = spark.sql("SELECT array(named_struct('start', 1L, 'length', 12L, 'period', 2L), named_struct('start', 3L, 'length', 14L, 'period', 5L), named_struct('start', 3L, 'length', 14L, 'period', 6L)) AS runs")
    assert tuple(df.select(longest("runs").alias("r")).first().r) == (3, 14, 5)


def test_query_equals_its_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    got = queries.op11_run_catchers(spark, SF)
    want = con.sql(queries.ORACLE_SQL["op11_run_catchers"]).select(", ".join(f'"{c}"' for c in got.columns)).fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert any(r[1] for r in want)
