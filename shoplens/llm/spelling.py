"""Spelling variant grouping by finite-state composition.

The vocabulary is an acceptor A.  Pairs of words one edit apart are the pairs
that A o T o A accepts, T being the transducer of exactly one edit.  A common
part before and after the edit decides where a pair is looked for: an edit
position lies in one window of the shorter word, and both words agree
outside it.  So words with equal (length, window, part before, part after) are
one initial state of the composed machine, and Spark deals the initial states out
to tasks.  Per run of initial states a task builds the minimised acceptor of what
stands inside the windows (states shared by all of them), composes it with T and
itself on the fly, keeps the product states from which both sides can end
together, and enumerates what they accept.

Windows are the halves of a word.  Initial states with more than
``GROUP_ROWS`` words are taken apart again by windows half as wide, until a window
is one position wide; then a state cannot hold more words than one letter in and
out of place gives.  So no group grows with the vocabulary and none is cut.  An edit of a run of equal
letters counts at its first place, so each pair is found once.

Defined cases: a null text has no words; a null id is the empty id; rows with
equal id and text count each; an empty table gives an empty one; words may have
any length; among near words with equal counts the smaller in code-point order is the
form.  Other columns of the table are never read, so their names cannot clash.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.llm.common import stored
from shoplens.session import ship_package

RUN = re.compile("[A-Za-zÀ-ÿ]+")
#: Words in one initial state, and rows whose initial states share an acceptor.
GROUP_ROWS = 20_000
#: Distinct words (and their characters) that a task counts before it passes them on.
COUNTED, COUNTED_CHARS = 200_000, 20_000_000
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def lower_ascii(run: str) -> str:
    return run.lower() if run.isascii() else run.translate(_LOWER)


def text_words(doc_id: object, text: str, every: int) -> Iterator[tuple[str, int]]:
    """(word, occurrences) of a text.  Every ``every``-th (id, run) by checksum
    loses one letter; 0 turns that off."""
    seed = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    runs = Counter(RUN.findall(text) if len(text) < 1_000_000 else (m.group() for m in RUN.finditer(text)))
    for run, k in runs.items():
        word = lower_ascii(run)
        if every:
            h = zlib.crc32(word.encode(), seed)
            if h % every == 0:
                i = h % len(word)
                word = word[:i] + word[i + 1:]
        yield word, k


def vocabulary(docs: DataFrame, id_col: str, text_col: str, min_length: int, min_count: int, every: int) -> DataFrame:
    """(word, n) of the words long and frequent enough.  Counts are summed in the
    task first, so a frequent word is a few rows in the shuffle."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, int] = {}
        chars = 0

        def flush() -> pa.RecordBatch:
            return pa.record_batch({"word": pa.array(list(counts), pa.string()), "n": pa.array(list(counts.values()), pa.int64())})

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    for word, k in text_words(doc_id, text or "", every):
                        if len(word) >= min_length:
                            if word in counts:
                                counts[word] += k
                            else:
                                counts[word] = k
                                chars += len(word)
                    if len(counts) > COUNTED or chars > COUNTED_CHARS:
                        yield flush()
                        counts.clear()
                        chars = 0
        yield flush()

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(count, "word string, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


def whole(words: DataFrame) -> DataFrame:
    """Rows (key, role, content, last, ahead, word, n): the window is the whole word.

    The key starts with m, the length of the shorter word of a pair, so a word
    stands once as that (role 0) and once as the longer one (role 1).
    """
    r = words.withColumn("role", F.explode(F.array(F.lit(0), F.lit(1))))
    return r.select((F.length("word") - F.col("role")).cast("string").alias("key"), "role", F.col("word").alias("content"),
                    F.lit(True).alias("last"), F.lit("").alias("ahead"), "word", "n")


def halves(rows: DataFrame) -> DataFrame:
    """Each window cut in two: what is left of it, or right of it, joins the key.

    A window of c positions has contents of c letters (role 0) and c + 1 (role
    1).  The right half of the last window also has the place behind the word.
    """
    cut = "cast((length(content) - role) / 2 as int)"
    left = F.struct(F.expr(f"concat(key, ' <', substr(content, {cut} + role + 1))").alias("key"),
                    F.expr(f"substr(content, 1, {cut} + role)").alias("content"), F.lit(False).alias("last"), F.col("ahead"))
    right = F.struct(F.expr(f"concat(key, ' >', substr(content, 1, {cut}))").alias("key"),
                     F.expr(f"substr(content, {cut} + 1)").alias("content"), F.col("last"),
                     F.expr(f"substr(content, {cut}, 1)").alias("ahead"))
    return (rows.withColumn("_h", F.explode(F.array(left, right)))
            .select("_h.key", "role", "_h.content", "_h.last", "_h.ahead", "word", "n"))


class Acceptor:
    """Minimal acyclic acceptors that share their states."""

    def __init__(self) -> None:
        self.arcs: list[dict[str, int]] = []
        self.final: list[bool] = []
        self.known: dict[tuple, int] = {}
        self._live: dict[tuple[int, int], bool] = {}

    def state(self, final: bool, arcs: dict[str, int]) -> int:
        """The one state with this right language."""
        mark = (final, *arcs.items())
        at = self.known.get(mark)
        if at is None:
            at = self.known[mark] = len(self.arcs)
            self.arcs.append(arcs)
            self.final.append(final)
        return at

    def add(self, words: Iterable[str]) -> int:
        """Initial state that accepts exactly ``words``, which come sorted."""
        path: list[list] = [[False, {}]]  # states that may still grow: [final, arcs]
        last = ""
        for word in words:
            same = 0
            for a, b in zip(last, word):
                if a != b:
                    break
                same += 1
            while len(path) > same + 1:
                done = path.pop()
                path[-1][1][last[len(path) - 1]] = self.state(*done)
            path.extend([False, {}] for _ in range(len(word) - same))
            path[-1][0] = True
            last = word
        while len(path) > 1:
            done = path.pop()
            path[-1][1][last[len(path) - 1]] = self.state(*done)
        return self.state(*path[0])

    def live(self, p: int, q: int) -> bool:
        """Do the two states accept a common string?"""
        known = self._live
        todo = [(p, q)]
        while todo:
            pair = todo[-1]
            if pair in known:
                todo.pop()
                continue
            a, b = pair
            if a == b or self.final[a] and self.final[b]:
                known[pair] = True
                continue
            x, y = self.arcs[a], self.arcs[b]
            below = [(x[c], y[c]) for c in x if c in y]
            open_ = [s for s in below if s not in known]
            if any(known.get(s) for s in below) or not open_:
                known[pair] = any(known.get(s) for s in below)
            else:
                todo.extend(open_)
        return known[p, q]

    def common(self, p: int, q: int) -> Iterator[str]:
        """What both states accept."""
        todo = [(p, q, "")]
        while todo:
            a, b, head = todo.pop()
            if not self.live(a, b):
                continue
            if self.final[a] and self.final[b]:
                yield head
            x, y = self.arcs[a], self.arcs[b]
            todo.extend((x[c], y[c], head + c) for c in x if c in y)

    def replaced(self, start: int) -> Iterator[tuple[str, str]]:
        """Pairs accepted from (start, start) by replacing one letter, each once."""
        todo = [(start, "")]
        while todo:
            p, head = todo.pop()
            arcs = list(self.arcs[p].items())
            for k, (a, x) in enumerate(arcs):
                todo.append((x, head + a))
                for b, y in arcs[k + 1:]:
                    if self.live(x, y):
                        for tail in self.common(x, y):
                            yield head + a + tail, head + b + tail

    def inserted(self, short: int, long: int, ahead: str, at_end: bool) -> Iterator[tuple[str, str]]:
        """Pairs accepted from (short, long) by inserting one letter, each once:
        never right behind the same letter, and after the last one only ``at_end``."""
        todo = [(short, long, "", ahead)]
        while todo:
            p, q, head, before = todo.pop()
            x, y = self.arcs[p], self.arcs[q]
            if x or at_end:
                for b, r in y.items():
                    if b != before and self.live(p, r):
                        for tail in self.common(p, r):
                            yield head + tail, head + b + tail
            todo.extend((x[c], y[c], head + c, c) for c in x if c in y)


def composed(groups: list[list[tuple]]) -> Iterator[tuple[str, int, str, int]]:
    """(word, n, word, n) of the pairs of each group: rows (role, content, last, ahead, word, n), sorted."""
    machine = Acceptor()
    starts = []
    for rows in groups:
        sides = [[r for r in rows if r[0] == role] for role in (0, 1)]
        starts.append([machine.add(r[1] for r in side) for side in sides])
    for rows, (short, long) in zip(groups, starts):
        names = [{r[1]: r[4:] for r in rows if r[0] == role} for role in (0, 1)]
        for a, b in machine.replaced(short):
            yield *names[0][a], *names[0][b]
        for a, b in machine.inserted(short, long, rows[0][3], rows[0][2]):
            yield *names[0][a], *names[1][b]


def near_pairs(words: DataFrame, group_rows: int = GROUP_ROWS) -> DataFrame:
    """(a, a_n, b, b_n): each unordered pair of ``words`` (word, n) one edit apart, once."""
    spark = words.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def compose(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(groups: list[list[tuple]]) -> Iterator[pa.RecordBatch]:
            rows = list(composed(groups))
            for at in range(0, len(rows), 50_000):
                a, an, b, bn = zip(*rows[at:at + 50_000])
                yield pa.record_batch({"a": pa.array(a, pa.string()), "a_n": pa.array(an, pa.int64()),
                                       "b": pa.array(b, pa.string()), "b_n": pa.array(bn, pa.int64())})

        groups, held, key, rows = [], 0, None, []
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for k, *row in zip(*columns):
                if k != key:
                    if len(rows) > 1:  # a word on its own has no partner here
                        groups.append(rows)
                        held += len(rows)
                    if held >= group_rows:
                        yield from out(groups)
                        groups, held = [], 0
                    key, rows = k, []
                rows.append(tuple(row))
        yield from out(groups + [rows] * (len(rows) > 1))

    found, left = None, halves(whole(words))
    while True:
        hot = (left.groupBy("key").agg(F.count("*").alias("_n"), F.max(F.length("content") - F.col("role")).alias("_c"))
               .filter((F.col("_n") > group_rows) & (F.col("_c") > 1)).select("key"))
        hot = stored(hot, "spelling-hot")
        done = hot.isEmpty()
        rows = left if done else left.join(hot, "key", "left_anti")
        rows = rows.repartition(parts, "key").sortWithinPartitions("key", "role", "content")
        pairs = rows.select("key", "role", "content", "last", "ahead", "word", "n").mapInArrow(
            compose, "a string, a_n long, b string, b_n long")
        found = pairs if found is None else found.unionByName(pairs)
        if done:
            return found
        left = stored(halves(left.join(hot, "key", "left_semi")), "spelling-windows")


def best_near(pairs: DataFrame) -> DataFrame:
    """(word, n_near, form, form_n): number of near words and the most frequent one."""
    ways = pairs.select(F.col("a").alias("word"), F.col("b").alias("v"), F.col("b_n").alias("v_n")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("v"), F.col("a_n").alias("v_n")))
    best = F.min(F.struct((-F.col("v_n")).alias("m"), F.col("v").alias("v")))
    return (ways.groupBy("word").agg(F.count("*").alias("n_near"), best.alias("_b"))
            .select("word", "n_near", F.col("_b.v").alias("form"), (-F.col("_b.m")).alias("form_n")))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of words with a form: forms followed to the last one.

    Counts at least double from form to form, so 2**6 steps reach any end: six
    rounds in which every word takes its target's target.
    """
    reach = stored(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    for _ in range(6):
        onward = reach.select(F.col("word").alias("_w"), F.col("root").alias("_r"))
        step = reach.join(onward, reach.root == F.col("_w"), "left")
        if step.filter(F.col("_r").isNotNull()).isEmpty():
            break
        reach = stored(step.select("word", F.coalesce("_r", "root").alias("root")), "spelling-roots")
    return reach


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 5, min_count: int = 3,
             ratio: int = 2, every: int = 97, group_rows: int = GROUP_ROWS) -> DataFrame:
    """One row per word: word, n, n_near, form, form_n, root.

    ``form`` is the near word of largest n if that is at least ``ratio`` (2 or more) times n.
    """
    ship_package(docs.sparkSession)
    if ratio < 2:
        raise ValueError("ratio must be 2 or more, so that forms lead to an end")
    words = stored(vocabulary(docs, id_col, text_col, min_length, min_count, every), "vocabulary")
    near = stored(best_near(near_pairs(words, group_rows)), "spelling-near")
    has: Column = F.col("form_n") >= ratio * F.col("n")
    rows = stored(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(has, F.col("form")).alias("form"), F.when(has, F.col("form_n")).alias("form_n")), "spelling-forms")
    last = roots(rows.filter("form is not null"))
    return rows.join(last, "word", "left").withColumn("root", F.coalesce("root", "word"))
