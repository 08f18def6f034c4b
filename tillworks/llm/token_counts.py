"""Token counts without token ids.

A tokenizer treats each pre-token by itself, so its pieces are counted once for each distinct
pre-token of the corpus. A document's count is the sum over its pre-tokens of how often it has each
times that number.
"""

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tillworks.llm import block_join
from tillworks.llm.library_ids import library_encoder, words


def _new_block(path: str):
    """Places of pre-tokens in a dictionary that starts empty."""
    encoder = library_encoder(path)
    if not encoder.by_parts:
        raise ValueError("pre-tokens are independent only under plain byte-level splitting")
    places: dict[str, int] = {}

    class Parts(dict):
        def __init__(self, lead: str):
            self.lead = lead

        def __missing__(self, word: str) -> bytes:
            found = [places.setdefault(p, len(places)) for p in encoder.pieces(self.lead + word)]
            value = np.array(found, "<i4").tobytes()
            if len(word) <= 48:
                self[word] = value
            return value

    first, later = Parts(""), Parts(" ")

    def take(text: str) -> np.ndarray:
        out = []
        for part, special in encoder.segments(text):
            if special:
                out.append(np.array([places.setdefault(part, len(places))], "<i4").tobytes())
            elif part:
                head, *rest = words(part)
                out.append(first[head])
                out.extend(map(later.__getitem__, rest))
        return np.frombuffer(b"".join(out), "<i4")

    return take, lambda: list(places)


def count(docs: DataFrame, path: str, block_chars: int = block_join.BLOCK_CHARS) -> DataFrame:
    """Per input row: doc_id, n_bytes in UTF-8 and n_tokens by the tokenizer file at `path`.

    Special strings inside a text are single tokens, as the library has it by default; no other
    special tokens are counted. A null or empty text has none. Repeated rows stay apart; columns
    other than doc_id and text play no part; an empty table gives an empty one.
    """

    used = block_join.uses(docs, T.StringType(), lambda: _new_block(path), block_chars)
    counted = block_join.values(used, lambda: library_encoder(path).count_piece)
    return block_join.totals(used, counted).withColumnRenamed("total", "n_tokens")
