"""Byte-pair encoding by dynamic programming over prefixes.

The encoding of every prefix of a piece is the encoding of a shorter prefix plus one token, and
only one token can be that last one: among the tokens that end there, the one that the last token of
the shorter prefix is allowed to stand before. So one token for each byte is all that needs
storing. Bytes that are appended only extend the table, and after an edit the table stays valid up
to the edit.

Two tokens may stand side by side where the merges that made them leave the border alone. Each token
is made by a tree of merges; while the pieces along the border grow, in the order of the ranks, no
pair across the border may come up for merging before one of its parts is merged away.
"""

import base64
import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillworks.llm.library_ids import Memo, stretches
from tillworks.llm.memory import give_back

_NEVER = 1 << 62


def merged(piece: bytes, ranks: dict[bytes, int], below: int = _NEVER) -> list[bytes]:
    """Byte-pair merging by definition, with merges of a rank under `below`: for tables and tests."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        rank, at = min((ranks.get(parts[i] + parts[i + 1], _NEVER), i) for i in range(len(parts) - 1))
        if rank >= below:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return parts


class Vocabulary:
    """Ranks of a tiktoken file, with what the prefix table needs."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import ahocorasick
        import regex

        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("every byte must be a token")
        self.ranks = ranks
        self.token = {i: t for t, i in ranks.items()}
        self.pattern = regex.compile(pattern)
        self.longest = max(map(len, ranks))
        self._ending = ahocorasick.Automaton()
        for t, i in ranks.items():
            self._ending.add_word(t.decode("latin-1"), (i, len(t)))
        self._ending.make_automaton()
        self._parts: dict[int, tuple[int, int] | None] = {}
        self._valid: dict[int, bool] = {}
        self._piece = Memo(self._encode_piece)

    def parts(self, token: int) -> tuple[int, int] | None:
        """The two tokens that a token is merged from; None for a single byte or one that no merge makes."""
        if token not in self._parts:
            two = merged(self.token[token], self.ranks, token)
            self._parts[token] = (self.ranks[two[0]], self.ranks[two[1]]) if len(two) == 2 else None
        return self._parts[token]

    def made(self, token: int) -> bool:
        """Whether merging the token's bytes gives the token."""
        return len(self.token[token]) == 1 or self.parts(token) is not None

    def _border(self, token: int, side: int) -> list[int]:
        """The tokens along one border (0: left, 1: right), from a single byte to the token itself."""
        out = [token]
        while len(self.token[out[-1]]) > 1:
            out.append(self.parts(out[-1])[side])
        return out[::-1]

    def may_follow(self, a: int, b: int) -> bool:
        """Whether the bytes of a and b together are encoded as these two tokens."""
        key = a << 32 | b
        if key not in self._valid:
            if len(self._valid) >= 300_000:
                self._valid.clear()
            self._valid[key] = self.made(a) and self.made(b) and self._apart(self._border(a, 1), self._border(b, 0))
        return self._valid[key]

    def _apart(self, left: list[int], right: list[int]) -> bool:
        i = j = 0
        while True:
            # A part is merged away at the rank of what it becomes; of equal ranks the left merge is first.
            left_until = left[i + 1] if i + 1 < len(left) else _NEVER
            right_until = right[j + 1] if j + 1 < len(right) else _NEVER
            across = self.ranks.get(self.token[left[i]] + self.token[right[j]], _NEVER)
            if across < left_until and across <= right_until and across < _NEVER:
                return False
            if left_until == right_until == _NEVER:
                return True
            if left_until <= right_until:
                i += 1
            else:
                j += 1

    def _encode_piece(self, piece: str) -> bytes:
        return np.array(PrefixTable(self, piece.encode()).ids(), "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        """All ids of a text as little-endian unsigned 32-bit integers."""
        return b"".join([b"".join(map(self._piece.__getitem__, self.pattern.findall(x))) for x in stretches(text)])

    def decode(self, ids) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))


class PrefixTable:
    """The last token of every prefix of one piece's bytes."""

    def __init__(self, vocabulary: Vocabulary, piece: bytes = b""):
        self.vocabulary, self.piece, self.last = vocabulary, b"", []
        self.append(piece)

    def append(self, more: bytes) -> None:
        """Extend the piece; nothing that is known changes."""
        v, last, known = self.vocabulary, self.last, len(self.piece)
        # Tokens that end in the new bytes may begin in the old ones.
        self.piece += more
        reach = max(0, known - v.longest)
        valid, may_follow = v._valid, v.may_follow
        for end, (token, n) in v._ending.iter(self.piece[reach:].decode("latin-1")):
            end += reach
            if end < len(last):
                continue
            before = end - n
            if before < 0:
                if v.made(token):
                    last.append(token)
                continue
            follows = valid.get(last[before] << 32 | token)
            if may_follow(last[before], token) if follows is None else follows:
                last.append(token)

    def replace(self, start: int, stop: int, new: bytes) -> None:
        """Put other bytes in place of piece[start:stop]; the table stays up to start."""
        rest = self.piece[stop:]
        self.piece, self.last = self.piece[:start], self.last[:start]
        self.append(new + rest)

    def ids(self) -> list[int]:
        whole = self.vocabulary.ranks.get(self.piece)
        if whole is not None:  # a piece that is a token is that token, whatever merges would give
            return [whole]
        out, at = [], len(self.piece)
        while at:
            out.append(self.last[at - 1])
            at -= len(self.vocabulary.token[out[-1]])
        return out[::-1]


class EncodedText:
    """A text with the prefix tables of its pieces, kept exact while it is edited.

    A piece depends on its own characters and a few behind it, so splitting starts again a little
    before an edit and stops as soon as it meets an old border behind it.
    """

    #: The pattern looks at most so many characters past the end of a piece.
    AHEAD = 3

    def __init__(self, vocabulary: Vocabulary, text: str = ""):
        self.vocabulary, self.text = vocabulary, text
        self.tables = [(m.start(), PrefixTable(vocabulary, m.group().encode())) for m in vocabulary.pattern.finditer(text)]

    def append(self, more: str) -> None:
        self.replace(len(self.text), len(self.text), more)

    def replace(self, start: int, stop: int, new: str) -> None:
        text = self.text[:start] + new + self.text[stop:]
        ends = [s for s, _ in self.tables[1:]] + [len(self.text)]
        kept = 0
        while kept < len(self.tables) and ends[kept] + self.AHEAD <= start:
            kept += 1
        shift = len(new) - (stop - start)
        old = {s + shift: i for i, (s, _) in enumerate(self.tables) if s >= stop}
        tables = self.tables[:kept]
        at, reused = (ends[kept - 1] if kept else 0), None
        if kept < len(self.tables) and self.tables[kept][0] < stop:
            reused = self.tables[kept][1]
        for m in self.vocabulary.pattern.finditer(text, at):
            if m.start() >= start + len(new) and m.start() in old:
                tables += [(s + shift, t) for s, t in self.tables[old[m.start()] :]]
                break
            raw = m.group().encode()
            if reused is not None:  # the first piece that changes keeps its table up to the change
                same = next((i for i, (x, y) in enumerate(zip(reused.piece, raw)) if x != y), min(len(reused.piece), len(raw)))
                reused.replace(same, len(reused.piece), raw[same:])
                table, reused = reused, None
            else:
                table = PrefixTable(self.vocabulary, raw)
            tables.append((m.start(), table))
        self.text, self.tables = text, tables

    def ids(self) -> list[int]:
        return [i for _, t in self.tables for i in t.ids()]


@functools.lru_cache(maxsize=1)
def vocabulary(path: str, pattern: str) -> Vocabulary:
    """One vocabulary in each Python worker; the file has a token in base 64 and its rank on each line."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, filter(bytes.strip, lines))}
    return Vocabulary(ranks, pattern)


def _encoded(v: Vocabulary, texts: pa.Array) -> pa.Array:
    raw = [v.encode(t.as_py() or "") for t in texts]
    offsets = np.cumsum([0] + [len(r) // 4 for r in raw]).astype("<i4")
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(raw), "<i4")))


def _decoded(v: Vocabulary, lists: pa.Array) -> pa.Array:
    # One row at a time: a list of all rows' ids would be far larger than the ids.
    return pa.array([v.decode(x.values.to_numpy().tolist()) if x.is_valid else None for x in lists], pa.binary())


def encode(text: Column, path: str, pattern: str) -> Column:
    """The ids of a text as an array; a null text counts as empty and has none."""

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def ids(texts: pa.Array) -> pa.Array:
        return _encoded(vocabulary(path, pattern), texts)

    # Else two uses of the column would be two runs of the function.
    return ids.asNondeterministic()(text)


def decode(ids: Column, path: str, pattern: str) -> Column:
    """The bytes that an array of ids stands for; null for null. An unknown id is an error."""

    @F.arrow_udf(T.BinaryType())
    def joined(lists: pa.Array) -> pa.Array:
        return _decoded(vocabulary(path, pattern), lists)

    return joined(ids)


def encode_decode(text: Column, path: str, pattern: str) -> Column:
    """encode() and decode() of what it gives, as a struct of ids and decoded.

    One Python worker does both, so a task has one vocabulary and one memo; the two columns one after
    the other would keep two workers a task, and in time each would hold both.
    """

    @F.arrow_udf(T.StructType().add("ids", T.ArrayType(T.IntegerType())).add("decoded", T.BinaryType()))
    def both(texts: pa.Array) -> pa.Array:
        v = vocabulary(path, pattern)
        ids = _encoded(v, texts)
        out = pa.StructArray.from_arrays([ids, _decoded(v, ids)], ["ids", "decoded"])
        give_back()
        return out

    return both.asNondeterministic()(text)


def edit(text: Column, edits: Column, path: str, pattern: str) -> Column:
    """The ids of a text after edits, an array of (start, stop, new) structs applied in turn.

    start and stop are places in the text as the edits before have left it, in characters, cut to its
    length; an append starts at the end. Only the surroundings of each edit are encoded again. A null
    text counts as empty, a null array as no edits.
    """

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def ids(texts: pa.Array, changes: pa.Array) -> pa.Array:
        v = vocabulary(path, pattern)
        out = []
        for t, steps in zip(texts.to_pylist(), changes.to_pylist()):
            held = EncodedText(v, t or "")
            for s in steps or []:
                start = min(max(s["start"], 0), len(held.text))
                held.replace(start, min(max(s["stop"], start), len(held.text)), s["new"] or "")
            out.append(held.ids())
        return pa.array(out, pa.list_(pa.int32()))

    return ids(text, edits)


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Per input row: doc_id, ids and the bytes decoded from them.

    Other columns play no part; repeated rows stay apart and an empty table stays empty.
    """
    done = docs.select("doc_id", encode_decode(F.col("text"), path, pattern).alias("done"))
    return done.select("doc_id", "done.ids", "done.decoded")
