"""A maker of documents, and rows that every operator has to take."""

from pathlib import Path

import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


@pytest.fixture(scope="session")
def documents(spark):
    """Documents from (doc_id, text) pairs, or from texts alone."""

    def make(*rows):
        pairs = [r if isinstance(r, tuple) else (i, r) for i, r in enumerate(rows)]
        return spark.createDataFrame([(i, t, None, "s", None if t is None else len(t)) for i, t in pairs], DOCS)

    return make


TESTDATA = Path("/root/testdata")

#: Null, empty, blank and odd texts, ties and repeated rows; every operator gets these.
ODD = [
    (None, None),
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, "word"),
    (5, "the same text twice, the same text twice, and some more words to make it long enough"),
    (5, "the same text twice, the same text twice, and some more words to make it long enough"),
    (6, "the same text twice, the same text twice, and some more words to make it long enough"),
    (7, "<|endoftext|> in a text   with  spaces <|endoftext|>"),
    (8, "漢字 and 😀 emoji\r\nline two\x1c᠎ x"),
    (None, "a row without an id but with a text of more than ten words in it, really"),
    (9, "long " * 5000),
]
