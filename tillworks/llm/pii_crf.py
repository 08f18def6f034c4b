"""Personal data: fixed patterns, extended by a skip-chain conditional random field.

The patterns find the base spans. A document's further candidates, words with a digit or an at sign,
are the variables of a random field together with the words of the base spans, which are observed.
Chain edges join candidates that stand together; skip edges join words that repeat or resemble each
other anywhere in the document, such as a number written once with and once without its country
code. Every such word is joined to the observed ones themselves, so an entity keeps its label
throughout, however often it repeats; message passing goes on until the labels settle.

Potentials are counted over all documents, with the base spans as labels: how often words of a shape
have a label, which labels stand together, and how often similar words agree.
"""

import re
from collections import Counter, defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillworks.llm.memory import give_back


KINDS = ("email", "ip", "card", "phone")
LABELS = ("none", *KINDS)
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_ANY = re.compile("[0-9@]")
# The part from the at sign on; what stands before it is taken by walking back, so that a long run
# of letters is looked at once. Possessive loops and the look-behind keep the others linear too.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_EDGE = "\"'()[]{}<>.,;:!?"


def luhn(digits: str) -> bool:
    twice = [2 * int(d) for d in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(d - 9 * (d > 9) for d in twice)) % 10 == 0


def _emails(text: str):
    end = before = 0  # after the last match; after the last at sign
    for m in _DOMAIN.finditer(text):
        at = m.start()
        floor = max(end, text.rfind("@", before, at) + 1, before)
        local = text[floor:at]
        n = len(local) - len(local.rstrip(_LOCAL))
        if n:
            yield at - n, m.end()
            end = m.end()
        before = at + 1


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the patterns, by kind as listed and start; places in code points."""
    if not _ANY.search(text):
        return []
    out = [("email", a, b) for a, b in _emails(text)] if "@" in text else []
    small = lambda part: len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or "0") <= 255
    out += [("ip", m.start(), m.end()) for m in _IP.finditer(text) if all(map(small, m.groups()))]
    for m in _CARD.finditer(text):
        if 16 <= m.end() - m.start() <= 37:
            digits = m.group().replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= sum(c.isdigit() for c in m.group()) <= 15:
                out.append(("phone", m.start(), m.end()))
    return out


@dataclass
class Field:
    """The variables and edges of one document."""

    spans: list[tuple[int, int]]
    shapes: list[tuple]
    labels: list[int]  # of base spans; 0 where there is none
    chain: list[tuple[int, int]]
    skip: list[tuple[int, int]]
    like: list[tuple[int, int]] | tuple = ()  # each word and the latest one like it; only counted


def _shape(word: str) -> tuple:
    digits = sum(c in "0123456789" for c in word)
    letters = sum(c.isalpha() for c in word)
    few = lambda n, *steps: sum(n >= s for s in steps)
    plain = word.replace("-", "")
    card = 16 <= len(plain) <= 19 and plain.isascii() and plain.isdigit()
    return (
        few(word.count("@"), 1, 2),
        few(digits, 1, 2, 4, 7, 10, 16, 20),
        few(letters, 1, 4),
        few(word.count("."), 1, 3, 4),
        word[:1] == "+",
        "-" in word or "(" in word,
        card and luhn(plain),
    )


def _keys(word: str) -> list[tuple[str, str]]:
    """What a word can be recognised by elsewhere."""
    low = word.lower()
    out = [("word", low)]
    if low.count("@") == 1 and low.index("@") >= 3:
        out.append(("local", low[: low.index("@")]))
    digits = "".join(c for c in low if c in "0123456789")
    if len(digits) >= 7 and len(digits) >= len(low) / 2:
        out.append(("digits", digits[-7:]))
    return out


def field(text: str, base: list[tuple[str, int, int]]) -> Field:
    """Variables in text order, with at most two skip edges a word, so edges stay linear in them."""
    out = Field([], [], [], [], [], [])
    keys: list[list[tuple[str, str]]] = []
    marked = sorted((a, b, LABELS.index(k)) for k, a, b in base)
    seen: dict[tuple[str, str], int] = {}
    at = 0
    for m in _WORD.finditer(text):
        word = m.group()
        if not _ANY.search(word):
            continue
        start = m.start() + len(word) - len(word.lstrip(_EDGE))
        end = m.end() - (len(word) - len(word.rstrip(_EDGE)))
        if start >= end:
            continue
        while at < len(marked) and marked[at][1] <= start:
            at += 1
        inside = [x for x in marked[at : at + 4] if x[0] < end and x[1] > start]
        i = len(out.spans)
        if i and len(text[out.spans[-1][1] : start].split(None, 2)) <= 1 and start - out.spans[-1][1] <= 24:
            out.chain.append((i - 1, i))
        word = text[start:end]
        keys.append(_keys(word))
        for key in keys[i]:
            j = seen.get(key)
            if j is not None and (j, i) not in out.like[-2:]:
                out.like.append((j, i))
            seen[key] = i
        out.spans.append((start, end))
        out.shapes.append(_shape(word))
        out.labels.append(inside[0][2] if inside else 0)
    out.skip += _skip_edges(keys, out.labels)
    return out


def _skip_edges(keys: list[list[tuple[str, str]]], labels: list[int]) -> list[tuple[int, int]]:
    """Each unmarked word with the marked words of its kin next before and after it.

    Kin are the words that share keys, by way of others too. In a chain of unmarked repeats each
    would add its own bias and only the first would meet the evidence. Kin without a marked word
    are joined one to the next.
    """
    parent: dict[tuple[str, str], tuple[str, str]] = {}

    def root(key):
        while parent.setdefault(key, key) != key:
            parent[key] = parent[parent[key]]
            key = parent[key]
        return key

    for own in keys:
        for key in own[1:]:
            parent[root(key)] = root(own[0])
    kin = [root(own[0]) for own in keys]
    known = {k for k, y in zip(kin, labels) if y}
    out = []
    for order in (range(len(kin)), range(len(kin) - 1, -1, -1)):
        last: dict[tuple[str, str], int] = {}
        for i in order:
            k = kin[i]
            if not labels[i] and k in last and (k in known or last[k] < i):
                out.append((last[k], i))
            if labels[i] or k not in known:
                last[k] = i
    return out


@dataclass(frozen=True)
class Model:
    """Log potentials: of labels by shape, of neighbouring labels, and of similar words' agreement."""

    shapes: dict
    other: np.ndarray
    chain: np.ndarray
    agree: float


def _statistics(docs: DataFrame) -> DataFrame:
    """Counts of (what, shape or label, label) over all documents, pre-aggregated in each batch."""

    def collect(batches):
        for batch in batches:
            n: Counter = Counter()
            for t in batch.column(0):
                text = t.as_py() or ""
                base = base_spans(text)
                if not base and not _ANY.search(text):
                    continue
                f = field(text, base)
                n.update(("shape", repr(s), y) for s, y in zip(f.shapes, f.labels))
                n.update(("chain", LABELS[f.labels[i]], f.labels[j]) for i, j in f.chain)
                n.update(("skip", LABELS[f.labels[i]], f.labels[j]) for i, j in f.like if f.labels[i] or f.labels[j])
            rows = [(*k, v) for k, v in n.items()]
            what, a, b, v = zip(*rows) if rows else ((), (), (), ())
            arrays = [pa.array(what, pa.string()), pa.array(a, pa.string()), pa.array(b, pa.int32()), pa.array(v, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, ["what", "a", "b", "n"])

    counted = docs.select("text").mapInArrow(collect, "what string, a string, b int, n long")
    return counted.groupBy("what", "a", "b").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, missed: float = 0.1, agreeing: int = 50) -> Model:
    """Potentials from all documents.

    A share `missed` of the words that no pattern marks counts as missed personal data, so that a
    similar marked word can outweigh a shape. `agreeing` pairs of similar words are counted in beside
    the documents' own, with one that disagrees. Neighbours are weak evidence: their potentials stay
    within 1, so that a number beside a phone number is none for that reason alone. The driver sees a count for each shape and label:
    a shape is a combination of seven small numbers, 4,608 at most.
    """
    shapes: dict = defaultdict(lambda: np.zeros(len(LABELS)))
    chain, same, different = np.ones((len(LABELS), len(LABELS))), agreeing, 1
    for r in _statistics(docs).collect():
        if r["what"] == "shape":
            shapes[r["a"]][r["b"]] += r["n"]
        elif r["what"] == "chain":
            chain[LABELS.index(r["a"]), r["b"]] += r["n"]
            chain[r["b"], LABELS.index(r["a"])] += r["n"]
        elif LABELS[r["b"]] == r["a"]:
            same += r["n"]
        else:
            different += r["n"]
    spread = np.full(len(LABELS), missed / len(KINDS))
    spread[0] = 1 - missed

    def log_share(n: np.ndarray) -> np.ndarray:
        # Marked words keep their counts; the unmarked ones are spread.
        n = np.where(np.arange(len(LABELS)) > 0, n, 0) + n[0] * spread + spread
        return np.log(n / n.sum())

    sides = chain.sum(axis=1) / chain.sum()
    return Model(
        {s: log_share(n) for s, n in shapes.items()},
        log_share(np.zeros(len(LABELS))),
        np.clip(np.log(chain / chain.sum()) - np.log(np.outer(sides, sides)), -1, 1),
        float(np.log(same / different) + np.log(len(LABELS) - 1)),
    )


def marginals(f: Field, model: Model, rounds: int = 2000, damping: float = 0.5, settled: float = 1e-6) -> np.ndarray:
    """Label probabilities of all variables by loopy message passing; base labels are held.

    Messages are passed until none changes by more than `settled`; `rounds` only ends those that
    swing for ever.
    """
    n, k = len(f.spans), len(LABELS)
    node = np.array([model.shapes.get(repr(s), model.other) for s in f.shapes]).reshape(n, k)
    held = np.array(f.labels, int)
    marked = np.flatnonzero(held)
    node[marked] = -1e3
    node[marked, held[marked]] = 0
    pairs = f.chain + f.skip
    if pairs:
        a, b = np.array(pairs).T
        potential = np.concatenate([np.repeat(model.chain[None], len(f.chain), 0), np.repeat(model.agree * np.eye(k)[None], len(f.skip), 0)])
        source, target = np.concatenate([a, b]), np.concatenate([b, a])
        potential = np.concatenate([potential, potential.transpose(0, 2, 1)])
        m, half = np.zeros((len(source), k)), len(pairs)
        back = np.concatenate([np.arange(half, 2 * half), np.arange(half)])
        for _ in range(rounds):
            total = node.copy()
            np.add.at(total, target, m)
            x = (total[source] - m[back])[:, :, None] + potential
            top = x.max(axis=1)
            new = top + np.log(np.exp(x - top[:, None]).sum(axis=1))
            new = damping * m + (1 - damping) * (new - new.max(axis=1, keepdims=True))
            moved = np.abs(new - m).max()
            m = new
            if moved < settled:
                break
        np.add.at(node, target, m)
    p = np.exp(node - node.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def added_spans(text: str, base: list[tuple[str, int, int]], model: Model) -> list[tuple[str, int, int]]:
    """Spans of words that the field labels and no base span touches."""
    if not _ANY.search(text):
        return []
    f = field(text, base)
    if all(f.labels) or not f.spans:
        return []
    best = marginals(f, model).argmax(axis=1)
    return [(LABELS[y], a, b) for (a, b), y, held in zip(f.spans, best.tolist(), f.labels) if y and not held]


_SPANS = "array<struct<kind:string,start:long,end:long>>"
SPANS = f"struct<base:{_SPANS},added:{_SPANS},every:{_SPANS}>"


def spans(text: Column, model: Model) -> Column:
    """Base spans, added ones and both together, by kind and start; a null text counts as empty."""

    @F.arrow_udf(SPANS)
    def find(texts: pa.Array) -> pa.Array:
        rows = []
        for t in texts:
            text = t.as_py() or ""
            base = base_spans(text)
            more = added_spans(text, base, model)
            every = sorted(base + more, key=lambda x: (KINDS.index(x[0]), x[1]))
            named = (("base", base), ("added", more), ("every", every))
            rows.append({n: [{"kind": k, "start": a, "end": b} for k, a, b in x] for n, x in named})
        found = pa.array(rows, _ARROW_SPANS)
        del rows
        give_back()
        return found

    return find(text)


_SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
_ARROW_SPANS = pa.struct([("base", _SPAN), ("added", _SPAN), ("every", _SPAN)])


def _joined(spans_: Column) -> Column:
    return F.array_join(F.transform(spans_, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def find_personal(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """Per input row: doc_id, numbers of base spans by kind, a digest of them, all spans, and n_added.

    Spans are kind:start:end, by kind and start, joined by commas; none give an empty string. Numbers
    are of base spans. Repeated rows stay apart; columns other than doc_id and text play no part.
    """
    model = model or fit(docs)
    found = docs.select("doc_id", spans(F.col("text"), model).alias("s"))
    base = lambda kind: F.size(F.filter("s.base", lambda x: x["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *[base(k).alias(f"n_{k}") for k in KINDS],
        F.sha2(_joined(F.col("s.base")).cast("binary"), 256).alias("base_sha256"),
        _joined(F.col("s.every")).alias("spans"),
        F.size("s.added").cast("long").alias("n_added"),
    )


def redact(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """The rows of docs with all their columns, each span of a text replaced by its kind: [EMAIL].

    Overlapping spans are replaced together under the kind of the one that starts first; a null
    text stays null.
    """
    model = model or fit(docs)

    @F.arrow_udf(T.StringType())
    def cover(texts: pa.Array) -> pa.Array:
        out = []
        for t in texts:
            text = t.as_py()
            if text is not None and _ANY.search(text):
                base = base_spans(text)
                parts, at = [], 0
                for a, b, k in sorted((a, b, k) for k, a, b in base + added_spans(text, base, model)):
                    if a >= at:
                        parts += [text[at:a], f"[{k.upper()}]"]
                    at = max(at, b)
                text = "".join([*parts, text[at:]])
            out.append(text)
        covered = pa.array(out, pa.string())
        del out
        give_back()
        return covered

    return docs.withColumn("text", cover(F.col("text")))
