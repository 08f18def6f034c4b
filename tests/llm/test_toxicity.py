"""Subword bags against slow versions, and the classifier on held-out texts."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_data import ODD, TESTDATA, documents  # noqa: F401
from pyspark.sql import functions as F

from tillworks.llm import queries, subword_bags
from tillworks.llm.subword_bags import Model, bag, fit, score, train

ROWS = 1 << 12
PLAIN = "the of and a to in is that it was for on are with as they at be this from have or by one had not but what all were when we there can an your which their said if do".split()
RUDE = ["idiot", "moron", "stupid", "loser"]


def slow_row(gram: bytes, rows: int) -> int:
    h = int.from_bytes(gram, "little") * 0x9E3779B97F4A7C15 % 2**64
    h ^= h >> 32
    return (h * 0xD6E8FEB86659FD93 % 2**64) >> (64 - (rows - 1).bit_length())


def slow_bag(text, rows):
    raw = bytes(c if chr(c).isalnum() or c >= 128 else 32 for c in (text or "").lower().encode())
    counts = Counter()
    for word in raw.split(b" "):
        word = b" " + word + b" "
        for n in subword_bags.SIZES if len(word) > 2 else ():
            counts.update(slow_row(word[i : i + n], rows) for i in range(len(word) - n + 1))
    return sorted(counts.items())


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["Idiot", "a", "é", "漢字", "😀", "x1", " ", "\n", "!!", "-", "long" * 3, "\x1c"]), max_size=30).map("".join))
def test_bag_of_a_text(text):
    used, weight = bag(text, ROWS)
    want = slow_bag(text, ROWS)
    assert list(used) == [r for r, _ in want]
    assert np.allclose(weight**2, [c for _, c in want])


def test_bag_of_a_text_of_several_segments(monkeypatch):
    text = " ".join(random.Random(1).choices(PLAIN, k=3000))
    whole = bag(text, ROWS)
    monkeypatch.setattr(subword_bags, "SEGMENT", 100)
    assert all(np.array_equal(a, b) for a, b in zip(bag(text, ROWS), whole))
    assert bag("x" * 1000, ROWS)[0].size  # a word longer than a segment is cut


def test_gradients_fit_the_loss():
    """One step without decay moves every parameter against its numerical gradient."""
    bags = [(np.array([0, 1, 3], np.int32), np.array([1, 2, 1], np.float32)), (np.array([1, 2], np.int32), np.array([1, 1], np.float32))]
    toxic = np.array([1, 0])

    def loss(m):
        logits = np.stack([w @ m.vectors[u].astype(float) / (w.sum() + m.smoothing) @ m.weights.T + m.bias for u, w in bags])
        return -np.mean(logits[[0, 1], toxic] - np.log(np.exp(logits).sum(1)))

    start = train(bags, toxic, 4, dim=2, steps=1, rate=0.0, decay=0.0, smoothing=0.0)
    after = train(bags, toxic, 4, dim=2, steps=1, rate=1e-4, decay=0.0, smoothing=0.0)
    for name in ("vectors", "weights"):
        base = getattr(start, name).astype(float)
        for k in np.ndindex(base.shape):
            moved = {n: getattr(start, n).astype(float).copy() for n in ("vectors", "weights", "bias")}
            moved[name][k] += 1e-5
            slope = loss(Model(**moved, smoothing=0.0)) - loss(start)
            if abs(slope) > 1e-9:
                assert np.sign(getattr(after, name).astype(float)[k] - base[k]) == -np.sign(slope)


def corpus(n, seed, rude=RUDE):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        words, toxic = rnd.choices(PLAIN, k=rnd.randint(20, 120)), int(i % 4 == 0)
        for _ in range(3 * toxic):
            words[rnd.randrange(len(words))] = rnd.choice(rude)
        rows.append((i, " ".join(words), toxic))
    return rows


@pytest.fixture(scope="module")
def fitted(spark, documents):
    rows = corpus(400, 1)
    labels = spark.createDataFrame([(i, t) for i, _, t in rows] + [(None, 1), (7, None)], "doc_id long, toxic long")
    return fit(documents(*[r[:2] for r in rows]), labels)


def test_held_out_texts_and_unseen_spellings(spark, documents, fitted):
    for rude, least in ((RUDE, 0.98), (["idiots", "morons", "stupidd", "losers"], 0.95)):
        rows = corpus(200, 2, rude)
        got = {r.doc_id: r for r in score(documents(*[r[:2] for r in rows]), fitted).collect()}
        assert np.mean([got[i].predicted == t for i, _, t in rows]) >= least
        assert all((got[i].score >= 0.3) == (got[i].predicted == 1) and 0 <= got[i].score <= 1 for i, _, _ in rows)
    near = lambda a, b: fitted.vector(a) @ fitted.vector(b) / np.linalg.norm(fitted.vector(a)) / np.linalg.norm(fitted.vector(b))
    assert near("idiot", "idi0t") > near("idiot", "there")


def test_odd_rows_extra_columns_and_empty_tables(spark, documents, fitted):
    docs = documents(*ODD).withColumn("Score", F.lit("theirs")).withColumn("toxic", F.lit(9))
    rows = score(docs, fitted).collect()
    assert len(rows) == len(ODD) and {"lang", "toxic", "score", "predicted"} <= set(rows[0].asDict())
    empty = {r.score for r in rows if not (r.text or "").strip()}
    assert list(empty) == [pytest.approx(0.25, abs=0.01)]  # as one in four was
    assert len({r.score for r in rows if r.doc_id in (5, 6)}) == 1
    assert score(docs.limit(0), fitted).count() == 0
    none = fit(docs.limit(0), spark.createDataFrame([], "doc_id long, toxic long"))
    assert {r.predicted for r in score(docs, none).collect()} == {0}


@pytest.mark.parametrize("toxic, predicted", [(0, 0), (1, 1)])
def test_labels_of_one_class(spark, documents, toxic, predicted):
    labels = spark.createDataFrame([(i, toxic) for i in range(5)], "doc_id long, toxic long")
    model = fit(documents(*[r[:2] for r in corpus(5, 1)]), labels)
    assert {r.predicted for r in score(documents("x", None), model).collect()} == {predicted}


def test_repeated_ids_and_conflicting_labels_train_once(spark, documents, fitted):
    rows = corpus(400, 1)
    labels = spark.createDataFrame([(i, t) for i, _, t in rows] * 2 + [(0, 0)], "doc_id long, toxic long")
    again = fit(documents(*[r[:2] for r in rows] * 2), labels)
    assert np.array_equal(again.vectors, fitted.vectors)


def test_query_learns_only_from_its_share_of_labels(spark, tmp_path, documents):
    sf = str(TESTDATA / "sf0.001")
    got = {r.doc_id: r for r in queries.op13_subword_toxicity(spark, sf).collect()}
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    assert len(got) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in got.items())
    # Held-out labels turned round change nothing.
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic"))).write.parquet(str(tmp_path / "labels.parquet"))
    assert all(r.score == got[r.doc_id].score for r in queries.op13_subword_toxicity(spark, str(tmp_path)).collect())
