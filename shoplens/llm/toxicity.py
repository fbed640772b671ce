"""Toxicity classifier with counterfactual regularisation.

A text is the set of its lower-cased words, and of each word's prefixes of
four to seven letters (abuse is often spelt with changing endings).  A
logistic regression is fitted on a bounded sample of the labelled rows outside
the held-out fold.  Every sampled text that names a group is also copied with
its identity terms swapped for others, and the squared change of the score
between the two is part of the loss, so that the terms themselves carry no
weight and neutral mentions are not flagged.

The sample is ``max_toxic`` + ``max_clean`` ids, the smallest by a hash of the
id, and one text of each (of differing texts that of the least hash); it bounds what the driver holds.  A class above its bound is sampled at a
lower rate, so each row weighs as the labelled rows it stands for: the bias and
the choice of features follow the class shares of all labels outside the
held-out fold, whatever the bounds.  Scoring runs over every whole text.

Defined cases: a null or empty text scores as a text without words; rows with
a null id are scored and count as not held out; null labels are left out, and
so are those of an id that is labelled both ways;
without usable labels of both classes the score is the share of toxic rows (0
if there are none).  Only the named columns are read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.llm.common import let_go, text_or_empty
from shoplens.session import ship_package

# Identity terms (fixed values): groups that a text may mention neutrally.
IDENTITY = {
    "en": ["women", "men", "muslims", "christians", "jews", "hindus", "atheists", "immigrants", "refugees", "gays",
           "lesbians", "asians", "africans", "europeans", "americans", "mexicans", "disabled", "elderly"],
    "fr": ["femmes", "hommes", "musulmans", "juifs", "immigrés", "réfugiés", "homosexuels", "asiatiques", "africains", "handicapés"],
    "de": ["frauen", "männer", "muslime", "christen", "juden", "einwanderer", "flüchtlinge", "homosexuelle", "asiaten", "afrikaner"],
    "es": ["mujeres", "hombres", "musulmanes", "cristianos", "judíos", "inmigrantes", "refugiados", "homosexuales", "asiáticos", "africanos"],
}
TERMS = {t: [x for x in group if x != t] for group in IDENTITY.values() for t in group}

DIM = 1 << 18
PREFIXES = range(4, 8)
_WORD = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class Fit:
    max_toxic: int = 2_000
    max_clean: int = 4_000
    min_lean: float = 4.5
    l2: float = 1.0
    counterfactual: float = 5.0
    rounds: int = 120


def features_of(word: str) -> list[int]:
    """Hashed features of a word: itself and its prefixes."""
    out = [zlib.crc32(word.encode("utf-8", "surrogatepass")) % DIM]
    out += [zlib.crc32(("^" + word[:k]).encode("utf-8", "surrogatepass")) % DIM for k in PREFIXES if len(word) >= k]
    return out


class WordSets:
    """Distinct words of a text; a bounded cache cuts blank-free runs into words."""

    def __init__(self, limit: int = 200_000):
        self.known: dict[str, tuple[str, ...]] = {}
        self.limit = limit

    def words(self, text: str) -> set[str]:
        if len(self.known) > self.limit:
            self.known.clear()
        out: set[str] = set()
        for run in set(text.lower().split()):
            got = self.known.get(run)
            if got is None:
                got = tuple(_WORD.findall(run))
                if len(run) <= 64:
                    self.known[run] = got
            out.update(got)
        return out


def swapped(words: set[str], salt: int) -> set[str] | None:
    """The words with every identity term exchanged; None if there is none."""
    named = [w for w in words if w in TERMS]
    if not named:
        return None
    return (words - set(named)) | {TERMS[w][(zlib.crc32(w.encode()) + salt) % len(TERMS[w])] for w in named}


def feature_ids(words: set[str]) -> bytes:
    import numpy as np

    return np.unique(np.array([i for w in words for i in features_of(w)], dtype="<u4")).tobytes()


def sample_features(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, toxic) -> (toxic, features, features after swapping or null)."""
    let_go()
    sets = WordSets()
    for batch in stream:
        rows = []
        for text, toxic, salt in zip(*(c.to_pylist() for c in batch.columns)):
            words = sets.words(text)
            other = swapped(words, salt)
            rows.append((toxic, feature_ids(words), None if other is None else feature_ids(other)))
        if rows:
            columns = list(zip(*rows))
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.binary()),
                                              pa.array(columns[2], pa.binary())], names=["toxic", "features", "swapped"])


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def known_labels(labels: DataFrame) -> DataFrame:
    """(lid, toxic) of the usable labels outside the held-out fold; an id with both labels has none."""
    return (labels.select(F.col("doc_id").alias("lid"), F.col("toxic").cast("int").alias("toxic"))
            .filter(F.col("lid").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("lid")))
            .groupBy("lid").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("_most"))
            .filter(F.col("toxic") == F.col("_most")).drop("_most"))


def row_weights(labels: DataFrame, fit: Fit) -> tuple[float, float]:
    """Labels that a sampled clean and a sampled toxic row stand for."""
    n = {r["toxic"]: r["count"] for r in known_labels(labels).groupBy("toxic").count().collect()}
    return max(1.0, n.get(0, 0) / max(fit.max_clean, 1)), max(1.0, n.get(1, 0) / max(fit.max_toxic, 1))


def training_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, fit: Fit) -> DataFrame:
    """Features of the sampled rows.  Ids are chosen from the labels alone, at
    most ``max_toxic + max_clean`` of them, and that bounded set goes to the texts.
    One row of each id is left before anything is collected."""
    ship_package(docs.sparkSession)
    known = known_labels(labels).withColumn("order", F.xxhash64("lid"))
    pick = lambda c, n: known.filter(F.col("toxic") == c).orderBy("order", "lid").limit(n)
    chosen = pick(1, fit.max_toxic).unionByName(pick(0, fit.max_clean))
    rows = (docs.select(F.col(id_col).alias("did"), text_or_empty(text_col).alias("text"))
            .join(F.broadcast(chosen), F.col("did") == F.col("lid"))
            .groupBy("lid").agg(F.min(F.struct(F.xxhash64("text").alias("key"), "text", "toxic",
                                               F.pmod("order", F.lit(997)).cast("int").alias("salt"))).alias("one"))
            .select("one.text", "one.toxic", "one.salt"))
    return rows.mapInArrow(sample_features, "toxic int, features binary, swapped binary")


def fit_weights(rows: list, fit: Fit, stands_for: tuple[float, float] = (1.0, 1.0)) -> tuple[dict[int, float], float]:
    """Weights by feature and the bias, from (toxic, features, swapped) rows;
    ``stands_for`` has the weight of a clean and of a toxic row."""
    import numpy as np

    # Equal rows count once: a sample full of copies teaches nothing more.
    rows = sorted({(r[0], bytes(r[1]), None if r[2] is None else bytes(r[2])) for r in rows}, key=lambda r: (r[0], r[1], r[2] or b""))
    y = np.array([r[0] for r in rows], dtype=float)
    if not len(y) or y.min() == y.max():
        share = float(y.mean()) if len(y) else 0.0
        return {}, (30.0 if share == 1.0 else -30.0)

    def sparse(parts: list[bytes]) -> tuple:
        at = [np.frombuffer(p, dtype="<u4") for p in parts]
        return np.repeat(np.arange(len(at)), [len(a) for a in at]), (np.concatenate(at) if at else np.zeros(0, "<u4"))

    row, col = sparse([r[1] for r in rows])
    u = np.where(y == 1, stands_for[1], stands_for[0])
    u /= u.mean()
    seen = np.bincount(col, u[row], DIM)
    toxic = np.bincount(col, (u * y)[row], DIM)
    # Only features that lean to one class far beyond chance: a text has
    # hundreds of words and nearly all of them say nothing.
    share = (u * y).mean()
    lean = (toxic - seen * share) / np.sqrt(np.maximum(seen, 1) * share * (1 - share))
    used = np.flatnonzero((seen >= 3 - 1e-9) & (np.abs(lean) >= fit.min_lean))
    place = np.full(DIM, -1)
    place[used] = np.arange(len(used))

    def kept(row, col):
        ok = place[col] >= 0
        return row[ok], place[col[ok]]

    row, col = kept(row, col)
    pairs = [(r[1], r[2]) for r in rows if r[2] is not None]
    prow, pcol = kept(*sparse([a for a, _ in pairs]))
    srow, scol = kept(*sparse([b for _, b in pairs]))
    n, d = len(y), len(used)
    w, b = np.zeros(d), float(np.log(share / (1 - share)))
    m, v, mb, vb = np.zeros(d), np.zeros(d), 0.0, 0.0
    for t in range(1, fit.rounds + 1):
        z = np.bincount(row, w[col], n) + b
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        g = u * (p - y) / n
        grad = np.bincount(col, g[row], d) + fit.l2 * w / n
        if pairs:
            change = np.bincount(prow, w[pcol], len(pairs)) - np.bincount(srow, w[scol], len(pairs))
            change = change * (2 * fit.counterfactual / len(pairs))
            grad += np.bincount(pcol, change[prow], d) - np.bincount(scol, change[srow], d)
        gb = g.sum()
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        rate = 0.05
        w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-6)
        b -= rate * (mb / (1 - 0.9**t)) / (np.sqrt(vb / (1 - 0.99**t)) + 1e-6)
    return {int(i): float(x) for i, x in zip(used, w) if abs(x) > 1e-4}, float(b)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", fit: Fit = Fit()) -> tuple[dict[int, float], float]:
    return fit_weights(training_sample(docs, labels, id_col, text_col, fit).collect(), fit, row_weights(labels, fit))


def scorer(weights: dict[int, float], bias: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Batches whose first column is the text -> the other columns and the score."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import math

        let_go()
        sets = WordSets()
        parts: dict[str, tuple[int, ...]] = {}
        for batch in stream:
            scores = []
            for text in batch.column(0).to_pylist():
                active: set[int] = set()
                if len(parts) > 200_000:
                    parts.clear()
                for w in sets.words(text):
                    got = parts.get(w)
                    if got is None:
                        got = tuple(i for i in features_of(w) if i in weights)
                        if len(w) <= 64:
                            parts[w] = got
                    if got:
                        active.update(got)
                z = bias + math.fsum(weights[i] for i in active)
                scores.append(1 / (1 + math.exp(-max(-30.0, min(30.0, z)))))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(scores, pa.float64())],
                                             names=[*batch.schema.names[1:], "score"])

    return run


def score(docs: DataFrame, model: tuple[dict[int, float], float], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row."""
    d = docs.select(text_or_empty(text_col).alias("text"), F.col(id_col).cast("long").alias("doc_id"),
                    held_out(F.col(id_col)).alias("held_out"))
    out = d.mapInArrow(scorer(*model), "doc_id long, held_out boolean, score double")
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def drop_toxic(docs: DataFrame, model: tuple[dict[int, float], float], text_col: str = "text", limit: float = 0.5) -> DataFrame:
    """``docs`` without the rows scored at or above ``limit``; columns unchanged."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    d = docs.select(text_or_empty(text_col).alias("text"), *[F.col(f"`{c}`").alias(n) for c, n in zip(docs.columns, names)])
    kinds = ", ".join(f"{n} {f.dataType.simpleString()}" for n, f in zip(names, docs.schema.fields))
    out = d.mapInArrow(scorer(*model), f"{kinds}, score double").filter(F.col("score") < limit)
    return out.select(*[F.col(n).alias(c) for c, n in zip(docs.columns, names)])
