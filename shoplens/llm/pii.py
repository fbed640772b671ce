"""Personal data by patterns and a skip-chain conditional random field.

The four base patterns give spans that always stay.  Beside them, every run of
text that could be personal data is a *mention*, and a random field labels the
mentions of a document jointly: unary potentials from the mention's shape and
context, chain potentials between neighbours, and skip potentials between
distant mentions that repeat or resemble each other (same digits, same mailbox).
Loopy message passing carries what is known of one mention to the others, so a
number written in full once is also found where it is written in part.  Base
spans are evidence: their labels are fixed.

The potentials are learned from a bounded sample of ``max_docs`` texts (the
smallest by a hash of their id, among those with digits or an at sign): base spans
are hidden, by writing them in part elsewhere in their text, beside decoys of the
same shape, and unary, chain and skip weights are fitted together to tell them.
No potential is bounded or set by hand.  Each mention links to the last one with
the same key only, so the work grows with the mentions, not with their pairs.

Defined cases: a null or empty text has no spans; null ids and repeated rows
give a row each.  Only the named columns are read.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.llm.common import in_pieces, let_go, text_or_empty
from shoplens.session import ship_package

KINDS = ("email", "ip", "card", "phone")
LABELS = ("none", *KINDS)

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_NUMBER = re.compile(r"[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_ANY = re.compile(r"[0-9@]")
_AT = re.compile(r"(?:@|\s?(?:\[at\]|\(at\))\s?)(?:[A-Za-z0-9]|[.-]+(?=[A-Za-z0-9]))+")
_DIGITS = re.compile(r"[+(]?[0-9](?:[\x20().-]{0,2}[0-9]){6,}")
#: Digits that a mention may have: no kind allows more.
MOST_DIGITS = 19
_LOCAL = set("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

Span = tuple[int, int, int]  # start, kind, end


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        x = int(d) * (1 + k % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """Matches of the four patterns, leftmost and non-overlapping within each kind.

    The email and address patterns are matched from their fixed parts (the at
    sign; maximal dotted runs), which gives the same matches in linear time.
    """
    out: list[Span] = []
    if not _ANY.search(text):
        return out
    end = 0
    for m in _DOMAIN.finditer(text) if "@" in text else ():
        start = m.start()
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < m.start():
            out.append((start, 0, m.end()))
            end = m.end()
    for m in _DOTTED.finditer(text):
        if m[0].count(".") >= 3:
            parts = [(p.start(), p.end()) for p in _NUMBER.finditer(text, m.start(), m.end())]
            for k in range(0, len(parts) - 3, 4):
                if all(e - s <= 3 + _zeros(text, s, e) and int(text[max(s, e - 4):e]) <= 255 for s, e in parts[k:k + 4]):
                    out.append((parts[k][0], 1, parts[k + 3][1]))
    for m in _CARD.finditer(text):
        if len(m[0]) >= 12:
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text) if "+" in text else ():
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def _zeros(text: str, start: int, end: int) -> int:
    run = text[start:end]
    return len(run) - len(run.lstrip("0"))


# --- mentions and their links ---------------------------------------------

@dataclass
class Mention:
    start: int
    end: int
    label: int  # of the base span it is, else 0
    fixed: bool
    text: str


def mentions(text: str, base: list[Span]) -> list[Mention]:
    """Base spans, and other candidates that overlap none of them."""
    out = [Mention(s, e, 1 + k, True, text[s:e]) for s, k, e in base]
    edges = sorted((s, e) for s, _, e in base)
    at, reach = 0, 0
    for start, end in candidates(text):
        while at < len(edges) and edges[at][0] < end:
            reach = max(reach, edges[at][1])
            at += 1
        if reach <= start:
            out.append(Mention(start, end, 0, False, text[start:end]))
    return sorted(out, key=lambda x: (x.start, x.label))


def candidates(text: str) -> Iterator[tuple[int, int]]:
    """Mailboxes and long numbers from left to right, none overlapping.

    Mailboxes are found by their at sign, and the part before it by walking
    back, so each character is looked at a bounded number of times.
    """
    at, number = 0, _DIGITS.search(text)
    for m in _AT.finditer(text):
        start = m.start()
        while start > at and text[start - 1] in _LOCAL:
            start -= 1
        while number and number.start() < start:
            if number.start() >= at:
                if sum(c.isdigit() for c in number[0]) <= MOST_DIGITS:
                    yield number.span()
                at = number.end()
                start = max(start, at)
            number = _DIGITS.search(text, at if number.start() < at else number.end())
        if m.start() >= at:
            yield start, m.end()
            at = m.end()
        if number and number.start() < at:
            number = _DIGITS.search(text, at)
    while number:
        if sum(c.isdigit() for c in number[0]) <= MOST_DIGITS:
            yield number.span()
        number = _DIGITS.search(text, number.end())


def keys(m: Mention) -> list[str]:
    """What makes two mentions alike: the same seven last digits, the same mailbox."""
    digits = re.sub(r"[^0-9]", "", m.text)
    found = []
    if "@" in m.text or "at]" in m.text or "at)" in m.text:
        found.append("@" + re.split(r"\s?(?:@|\[at\]|\(at\))\s?", m.text.lower())[0])
    elif len(digits) >= 7:
        found.append("#" + digits[-7:])
    return found


def links(found: list[Mention]) -> list[tuple[int, int]]:
    last: dict[str, int] = {}
    out = []
    for k, m in enumerate(found):
        for key in keys(m):
            if key in last:
                out.append((last[key], k))
            last[key] = k
    return out


def features(m: Mention, text: str) -> list[float]:
    t = m.text
    digits = sum(c.isdigit() for c in t)
    before, after = text[max(0, m.start - 1):m.start], text[m.end:m.end + 1]
    return [1.0, "@" in t, "." in t.partition("@")[2], t.count(".") == 3 and digits + 3 == len(t), t[0] == "+", "(" in t,
            "-" in t or " " in t, digits / 20, 7 <= digits <= 8, 9 <= digits <= 11, digits in (15, 16), digits > 16,
            digits == len(t), digits >= 12 and luhn(re.sub(r"[^0-9]", "", t)), before.isspace() or not before, after.isspace() or not after]


# --- model ----------------------------------------------------------------

@dataclass
class Field:
    unary: list[list[float]]  # weights by feature and label
    chain: float
    skip: float
    rounds: int = 10
    sure: float = 0.8


def part_of(span: str, kind: int) -> str:
    """A way to write a base span in part, which the patterns do not see."""
    if KINDS[kind] == "email":
        local, _, domain = span.partition("@")
        return f"{local}@{domain.partition('.')[0]}"
    digits = [m.start() for m in re.finditer("[0-9]", span)]
    start = max(0, len(digits) - 8) if KINDS[kind] == "card" else span.index(".") + 1 if KINDS[kind] == "ip" else digits[1]
    return span[digits[start] if KINDS[kind] == "card" else start:].lstrip(" .-)")


def decoy_of(part: str) -> str:
    """Something of the same shape that nothing else in its document resembles."""
    local, at, domain = part.partition("@")
    swap = str.maketrans("0123456789", "3579146802")
    return f"{local[::-1]}x@{domain}" if at else local.translate(swap)


def examples(text: str) -> tuple[list[Mention], list[int | None], list[list[float]], list[bool]]:
    """The mentions of a text as training data, their labels (None: not known) and
    features, and whether the label is certain.

    Each base span is hidden once: written in part, at a place given by its hash,
    where only its likeness to the whole one tells what it is.  A decoy of the same
    shape stands beside it and is none.  Other mentions are none too, as far as the
    patterns can tell, but for those that resemble a base span: these are not known.
    """
    found = mentions(text, base_spans(text))
    known: dict[int, int | None] = {id(m): m.label for m in found}
    shapes = {id(m): features(m, text) for m in found}
    before = {id(m) for m in found}
    for m in [m for m in found if m.fixed]:
        part = part_of(m.text, m.label - 1)
        for piece, label in ((part, m.label), (decoy_of(part), 0)):
            if list(candidates(piece)) != [(0, len(piece))] or base_spans(piece):
                continue
            extra = Mention(1, 1 + len(piece), 0, False, piece)
            known[id(extra)], shapes[id(extra)] = label, features(extra, f" {piece} ")
            found.insert(zlib.crc32(piece.encode()) % (len(found) + 1), extra)
    certain = {id(m) for m in found if m.fixed or id(m) not in before}
    told = {k for k, label in known.items() if label}
    for a, b in links(found):
        for x, y in ((found[a], found[b]), (found[b], found[a])):
            if id(x) in told and id(y) not in told:
                known[id(y)] = None
    return found, [known[id(m)] for m in found], [shapes[id(m)] for m in found], [id(m) in certain for m in found]


def fit_field(texts: list[str], steps: int = 1_500, rate: float = 0.5, decay: float = 0.0005) -> Field:
    """All potentials together, by the pseudo-likelihood of the known labels of ``examples``.

    A mention's label is predicted from its features and from the number of chain and
    skip neighbours of each label; the weights of these two counts are the potentials.
    """
    import numpy as np

    k = len(LABELS)
    rows, marks, firm, beside, alike = [], [], [], [], []
    for text in texts:
        found, labels, shapes, certain = examples(text)
        counts = {"chain": np.zeros((len(found), k)), "skip": np.zeros((len(found), k))}
        for kind, pairs in (("chain", [(i, i + 1) for i in range(len(found) - 1)]), ("skip", links(found))):
            for a, b in pairs:
                for i, j in ((a, b), (b, a)):
                    if labels[j] is not None:
                        counts[kind][i, labels[j]] += 1
        use = [i for i, label in enumerate(labels) if label is not None]
        rows += [shapes[i] for i in use]
        marks += [labels[i] for i in use]
        firm += [certain[i] for i in use]
        beside.append(counts["chain"][use])
        alike.append(counts["skip"][use])
    w = np.zeros((len(features(Mention(0, 1, 0, False, "0"), "0")), k))
    chain = skip = 0.0
    if not rows:
        w[0, 0] = 2.0
        return Field(w.tolist(), chain, skip)
    x, y = np.array(rows, dtype=float), np.eye(k)[marks]
    near, like = np.concatenate(beside), np.concatenate(alike)
    # What no pattern matches is none but softly: the patterns miss some of the truth.
    y[~np.array(firm)] = 0.9 * y[~np.array(firm)] + 0.1 / k
    for _ in range(steps):
        z = x @ w + chain * near + skip * like
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        w -= rate * (x.T @ (p - y) / len(x) + decay * w)
        chain -= rate * (float((near * (p - y)).sum()) / len(x) + decay * chain)
        skip -= rate * (float((like * (p - y)).sum()) / len(x) + decay * skip)
    return Field(w.tolist(), chain, skip)


def marginals(found: list[Mention], text: str, field: Field) -> list[list[float]]:
    """Label probabilities by loopy sum-product; fixed labels are evidence."""
    import numpy as np

    n, k = len(found), len(LABELS)
    z = np.array([features(m, text) for m in found], dtype=float) @ np.array(field.unary)
    for i, m in enumerate(found):
        if m.fixed:
            z[i] = -50.0
            z[i, m.label] = 0.0
    # Two edges between the same mentions are one with both potentials.
    joined: dict[tuple[int, int], float] = {}
    for a, b, strength in [(a, a + 1, field.chain) for a in range(n - 1)] + [(a, b, field.skip) for a, b in links(found)]:
        joined[a, b] = joined.get((a, b), 0.0) + strength
    edges = [(a, b, strength) for (a, b), strength in joined.items()]
    if edges:
        src = np.array([e[0] for e in edges] + [e[1] for e in edges])
        dst = np.array([e[1] for e in edges] + [e[0] for e in edges])
        same = np.exp(np.array([e[2] for e in edges] * 2))[:, None]
        back = np.concatenate([np.arange(len(edges)) + len(edges), np.arange(len(edges))])
        message = np.full((len(src), k), math.log(1 / k))
        for _ in range(field.rounds):
            belief = z.copy()
            np.add.at(belief, dst, message)
            out = belief[src] - message[back]
            out = np.exp(out - out.max(axis=1, keepdims=True))
            sent = out.sum(axis=1, keepdims=True) + (same - 1) * out
            new = np.log(sent / sent.sum(axis=1, keepdims=True))
            message = 0.5 * message + 0.5 * new
        np.add.at(z, dst, message)
    p = np.exp(z - z.max(axis=1, keepdims=True))
    return (p / p.sum(axis=1, keepdims=True)).tolist()


def find(text: str, field: Field) -> tuple[list[Span], list[Span]]:
    """Base spans, and all spans."""
    base = base_spans(text)
    if not _ANY.search(text):
        return base, base
    found = mentions(text, base)
    if all(m.fixed for m in found):
        return base, base
    extra = []
    for m, p in zip(found, marginals(found, text, field)):
        best = max(range(1, len(LABELS)), key=p.__getitem__)
        if not m.fixed and p[best] >= field.sure:
            extra.append((m.start, best - 1, m.end))
    return base, sorted(base + extra)


def spelt(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def redact(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind; overlapping spans go as one."""
    out, at = [], 0
    for s, k, e in spans:
        if s >= at:
            out += [text[at:s], f"[{KINDS[k].upper()}]"]
        at = max(at, e)
    return "".join([*out, text[at:]])


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_docs: int = 1_000) -> Field:
    """Fits the field on at most ``max_docs`` texts; those are all the driver sees."""
    ship_package(docs.sparkSession)
    some = docs.filter(F.rlike(F.col(text_col), F.lit("[0-9@]"))).select(F.xxhash64(F.col(id_col), F.col(text_col)).alias("h"), F.col(text_col).alias("t"))
    # Hashes are evenly spread: of a large table only the texts with the smallest
    # ones, a few more than wanted, are sent on by the tasks.
    n = some.count()
    lowest = -(1 << 63) + int((1 << 64) * min(1.0, 3 * max_docs / max(n, 1)))
    few = lambda rows: rows.dropDuplicates(["h"]).orderBy("h").limit(max_docs).collect()
    got = few(some.filter(F.col("h") <= F.lit(min(lowest, (1 << 63) - 1))))
    if len(got) < max_docs and n > 3 * max_docs:  # hardly any different texts
        got = few(some)
    return fit_field([r["t"] for r in got])


def finder(field: Field, with_text: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Batches whose first column is the text -> the other columns and the results."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        empty = hashlib.sha256(b"").hexdigest()
        for batch in in_pieces(stream):
            texts = batch.column(0).to_pylist()
            found = [find(t, field) for t in texts]
            columns = list(batch.columns[1:])
            names = list(batch.schema.names[1:])
            if with_text:
                columns.append(pa.array([redact(t, spans) for t, (_, spans) in zip(texts, found)], pa.string()))
                names.append("redacted")
            else:
                for k, kind in enumerate(KINDS):
                    columns.append(pa.array([sum(x[1] == k for x in base) for base, _ in found], pa.int64()))
                    names.append(f"n_{kind}")
                columns.append(pa.array([hashlib.sha256(spelt(b).encode()).hexdigest() if b else empty for b, _ in found]))
                columns.append(pa.array([spelt(spans) for _, spans in found], pa.string()))
                columns.append(pa.array([len(s) - len(b) for b, s in found], pa.int64()))
                names += ["base_sha256", "spans", "n_added"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def spans(docs: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added); the counts are of base spans."""
    d = docs.select(text_or_empty(text_col).alias("text"), F.col(id_col).cast("long").alias("doc_id"))
    return d.mapInArrow(finder(field, False), "doc_id long, n_email long, n_ip long, n_card long, n_phone long, "
                                              "base_sha256 string, spans string, n_added long")


def redacted(docs: DataFrame, field: Field, text_col: str = "text") -> DataFrame:
    """``docs`` with every span in the text replaced by its kind; a null text stays null."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    d = docs.select(text_or_empty(text_col).alias("text"), *[F.col(f"`{c}`").alias(n) for c, n in zip(docs.columns, names)])
    kinds = ", ".join(f"{n} {f.dataType.simpleString()}" for n, f in zip(names, docs.schema.fields))
    out = d.mapInArrow(finder(field, True), f"{kinds}, redacted string")
    return out.select(*[(F.when(F.col(n).isNotNull(), F.col("redacted")) if c == text_col else F.col(n)).alias(c)
                        for c, n in zip(docs.columns, names)])
