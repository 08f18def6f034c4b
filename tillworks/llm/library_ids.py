"""Token ids of whole texts as the tokenizers library gives them, with work shared between words.

The library spends most of its time on words it has seen before. A text of plain characters is
therefore split into pre-tokens by one pattern, each distinct pre-token is encoded by the library once and
remembered in a bounded memo, so ids are the library's own while repeated ones cost one dictionary lookup.
Any other text is cut before every single space that a visible character follows: a byte-level
tokenizer always starts a new piece there, and neither side depends on the other. Its parts are
split by the library, and remembered too.
"""

import functools
import os
import re

import numpy as np

#: White space by any of the Unicode versions in use; a space before one of these is never a cut.
_SPACE = r"\s\x1c-\x1f\x85᠎​"
_ODD = re.compile(f" (?:[{_SPACE}]|$)")
_CUT = re.compile(f" (?=[^{_SPACE}])")

#: Texts of these characters alone are split here as the library would; all others by the library.
_LETTER = "A-Za-zªµºÀ-ÖØ-öø-ÿ"
_PLAIN = re.compile(f"[\\t\\n\\r -~{_LETTER}]*")
_PIECES = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTER}]+| ?[0-9]+| ?[^\t\n\r 0-9{_LETTER}]+|[\t\n\r ]+(?![^\t\n\r ])|[\t\n\r ]+"
)
#: Distinct pieces remembered in each of two generations, and the longest one kept.
MEMO_ENTRIES = 250_000
MEMO_LENGTH = 48
#: Characters that are split at a time.
_AT_ONCE = 1 << 20


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if it is visible, else the next from 256 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    return {b: chr(b) for b in visible} | {b: chr(256 + i) for i, b in enumerate(hidden)}


_LETTERS = _byte_letters()


class Memo(dict):
    """A dictionary that computes missing values and forgets what two generations have not asked for."""

    def __init__(self, compute, entries: int = MEMO_ENTRIES, longest: int = MEMO_LENGTH):
        super().__init__()
        self._compute, self._entries, self._longest = compute, entries, longest
        self._old: dict = {}

    def __missing__(self, key):
        value = self._old.get(key)
        if value is None:
            value = self._compute(key)
        if len(key) <= self._longest:
            if len(self) >= self._entries:
                self._old = dict(self)
                self.clear()
            self[key] = value
        return value


def words(text: str) -> list[str]:
    """The text cut before each single space that a visible character follows; that space is left out."""
    return _CUT.split(text) if _ODD.search(text) else text.split(" ")


def stretches(text: str):
    """The text in stretches of bounded length, cut before a single space that a visible character follows."""
    at = 0
    while len(text) - at > _AT_ONCE:
        cut = _CUT.search(text, at + _AT_ONCE)
        # A second space before the cut would belong to the same run of them.
        while cut and text[cut.start() - 1].isspace():
            cut = _CUT.search(text, cut.end())
        if cut is None:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:]


class LibraryEncoder:
    """Encodes with one tokenizer file; ids come as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str, entries: int = MEMO_ENTRIES):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder()
        self._special = {t.content: i for i, t in added.items()}
        self._split = re.compile("|".join(map(re.escape, sorted(self._special, key=len, reverse=True))) or r"(?!)")
        self._pre, self._model = self.tokenizer.pre_tokenizer, self.tokenizer.model
        # Parts are independent only under plain byte-level splitting.
        self.by_parts = (
            self.tokenizer.normalizer is None
            and type(self._pre).__name__ == "ByteLevel"
            and not self._pre.add_prefix_space
            and self._pre.use_regex
            and not any(t.lstrip or t.rstrip or t.single_word or t.normalized for t in added.values())
        )
        self._piece = Memo(self._encode_piece, entries=entries)
        self._later = Memo(lambda word: self._encode_part(" " + word), entries=entries // 5)

    def without_cache(self) -> None:
        """Turn the library's own cache of words off; the memo has them.

        A thread keeps that cache when its tokenizer is gone, so a worker that loads a tokenizer for each
        task would gather one cache after the other.
        """
        resize = getattr(self._model, "_resize_cache", None)
        if resize is not None:
            resize(0)

    def _encode_piece(self, piece: str) -> bytes:
        letters = piece.encode().decode("latin-1").translate(_LETTERS)
        return b"".join([t.id.to_bytes(4, "little") for t in self._model.tokenize(letters)])

    def pieces(self, part: str) -> list[str]:
        """The pre-tokens of a part that is no special token."""
        if _PLAIN.fullmatch(part):
            return _PIECES.findall(part)
        return [part[a:b] for _, (a, b) in self._pre.pre_tokenize_str(part)]

    def _encode_part(self, part: str) -> bytes:
        return b"".join([self._piece[p] for p in self.pieces(part)])

    def _encode_plain(self, text: str) -> bytes:
        if _PLAIN.fullmatch(text):
            return b"".join([b"".join(map(self._piece.__getitem__, _PIECES.findall(x))) for x in stretches(text)])
        parts = words(text)
        return self._encode_part(parts[0]) + b"".join(map(self._later.__getitem__, parts[1:]))

    def encode(self, text: str) -> bytes:
        """All ids of a text, without special tokens of the library's own adding."""
        if not text:
            return b""
        if not self.by_parts:
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
            return np.array(ids, "<u4").tobytes()
        out = []
        for part, special in self.segments(text):
            out.append(np.array([self._special[part]], "<u4").tobytes() if special else self._encode_plain(part))
        return b"".join(out)

    def segments(self, text: str):
        """The text cut at special strings: each part and whether it is one."""
        at = 0
        for found in self._split.finditer(text):
            if found.start() > at:
                yield text[at : found.start()], False
            yield found.group(), True
            at = found.end()
        if at < len(text):
            yield text[at:], False

    def count_piece(self, piece: str) -> int:
        """Tokens of one pre-token or special string."""
        if piece in self._special:
            return 1
        return len(self._model.tokenize(piece.encode().decode("latin-1").translate(_LETTERS)))


@functools.lru_cache(maxsize=1)
def library_encoder(path: str, entries: int = MEMO_ENTRIES) -> LibraryEncoder:
    """One encoder in each Python worker, kept from task to task; it remembers 2 * entries pieces at most."""
    return LibraryEncoder(path, entries)
