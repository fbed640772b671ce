"""Quality rules with cross-document line frequency (DataFrame functions only).

A line is hashed after normalising (lower case, white space runs to one
space, trimmed).  For each host the number of distinct documents that hold a
line is counted; lines above the limit are boilerplate and are removed, and a
document that keeps too little of itself is rejected.

Two documents count as one when all their normalised lines are the same: by the
hash of the whole normalised text.  So a group of thousands of copies does not
turn its own text into boilerplate, and no line, however widespread, makes two
different documents one.  Near copies are different documents.

Defined cases: a null text is the empty text (no words: base rule fails, not
kept); a null host is a host of its own; a null doc_id is one document;
repeated rows are judged each on its own, and count once.  Columns that are
not named in the call are never read, so their names cannot clash.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.llm.common import stored, text_or_empty, with_maybe

SYMBOLS = "#*$%&|<>"
WINDOW = 5


@dataclass(frozen=True)
class LineLimits:
    """A line goes when it is in more than ``max(min_docs, max_share * documents
    of the host)`` distinct documents; a document goes when less than
    ``min_left`` of the characters of its normalised lines stay."""

    min_docs: int = 20
    max_share: float = 0.05
    min_left: float = 0.3


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, "[ \\t-\\r]+"), "")


def lines_of(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda x: F.rlike(x, F.lit("[^ \\t-\\r]")))


def normal_line(line: Column) -> Column:
    single = F.when(F.rlike(line, F.lit("[\\t-\\r]|  ")), F.regexp_replace(line, "[ \\t-\\r]+", " ")).otherwise(line)
    return F.lower(F.trim(single))


def with_repeated_words(docs: DataFrame) -> DataFrame:
    """Adds n_repeat_words: words inside five-word windows found twice or more.

    Windows are compared by 64-bit hash within one text (two different windows
    of a text of 20,000 words meet with probability 1e-11).  Each step is a
    column of its own, so nothing inside a lambda is worked out per element;
    single elements are taken by position because slice() copies its array.
    """
    h, win, order = F.col("_h"), F.col("_wh"), F.col("_ord")
    d = docs.withColumn("_h", F.transform("_words", lambda x: F.xxhash64(x)))
    d = d.withColumn("_wh", F.when(F.size(h) >= WINDOW, F.transform(
        F.slice(h, 1, F.greatest(F.size(h) - (WINDOW - 1), F.lit(1))),
        lambda x, i: F.xxhash64(x, *[F.get(h, i + k) for k in range(1, WINDOW)]))))
    repeats = F.coalesce(F.size(F.array_distinct(win)) < F.size(win), F.lit(False))
    d = d.withColumn("_ord", F.when(repeats, F.sort_array(F.transform(
        win, lambda x, i: F.struct(x.alias("w"), i.alias("i"))))))

    def twin(e: Column, k: Column) -> Column:
        return F.when(((k > 0) & F.get(order, k - 1)["w"].eqNullSafe(e["w"]))
                      | F.get(order, k + 1)["w"].eqNullSafe(e["w"]), e["i"])

    d = d.withColumn("_st", F.sort_array(F.filter(F.transform(order, twin), lambda i: i.isNotNull())))
    st = F.col("_st")
    covered = F.aggregate(
        F.transform(st, lambda p, k: F.least(F.coalesce(F.get(st, k + 1) - p, F.lit(WINDOW)), F.lit(WINDOW))),
        F.lit(0).cast("long"), lambda a, b: a + b)
    return d.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long"))).drop("_h", "_wh", "_ord", "_st")


def measures(docs: DataFrame) -> DataFrame:
    """Per row: base measures, hash of the normalised text, and (hash, characters) of each line."""
    t = F.col("_text")
    m = with_repeated_words(docs.withColumn("_words", words_of(t)).withColumn("_lines", lines_of(t)))
    m = m.withColumn("_per", F.transform(F.transform("_lines", normal_line), lambda y: F.struct(
        F.xxhash64(y).alias("h"), F.length(y).alias("c"))))
    return m.select(
        "_id", "_host", "_key", "_carry",
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace(t, f"[^{SYMBOLS}]+", "")).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words", F.xxhash64("_per.h").alias("_doc"), "_per")


def frequent_lines(m: DataFrame, limits: LineLimits) -> DataFrame:
    """(host, line hash) of lines in too many distinct documents of the host.

    Both counts go through a distinct of (host, line, document) first, which
    spreads a hot host or line over all tasks; the counts themselves are
    combined on the map side.
    """
    hosts = m.select("_host", "_doc").distinct().groupBy("_host").agg(F.count("*").alias("_docs"))
    lines = (m.select("_host", "_doc", F.explode(F.array_distinct("_per.h")).alias("_lh")).distinct()
             .groupBy("_host", "_lh").agg(F.count("*").alias("_n"))
             .filter(F.col("_n") > limits.min_docs))
    return (lines.alias("l").join(hosts.alias("h"), F.col("l._host").eqNullSafe(F.col("h._host")))
            .filter(F.col("_n") > F.lit(limits.max_share) * F.col("_docs"))
            .select("l._host", "_lh"))


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
                  limits: LineLimits = LineLimits(), carry: list[str] | None = None) -> DataFrame:
    """One row per document row: the ``carry`` columns (default the id), the base
    measures, base_failed, n_removed_lines, removed (hashes of the lines to go),
    _key (hash of the text) and kept.

    The measures are written once to the shared folder (some hundred bytes a
    document) and every count reads them from there.
    """
    d = docs.select(F.col(id_col).alias("_id"), F.col(host_col).alias("_host"),
                    text_or_empty(text_col).alias("_text"), F.xxhash64(text_or_empty(text_col)).alias("_key"),
                    F.struct(*[F.col(c) for c in carry or [id_col]]).alias("_carry"))
    m = stored(measures(d), "line-measures")
    bad = frequent_lines(m, limits)
    held = m.select("_id", "_host", F.explode(F.array_distinct("_per.h")).alias("_lh"))
    removed = (held.alias("d").join(bad.alias("b"), F.col("d._host").eqNullSafe(F.col("b._host"))
                                    & (F.col("d._lh") == F.col("b._lh")), "left_semi")
               .groupBy("_id", "_host").agg(F.collect_set("_lh").alias("_gone")))
    j = (m.alias("m").join(removed.alias("r"), F.col("m._id").eqNullSafe(F.col("r._id"))
                           & F.col("m._host").eqNullSafe(F.col("r._host")), "left")
         .select("m.*", F.coalesce("r._gone", F.array().cast("array<bigint>")).alias("_gone")))
    j = j.withColumn("_out", F.filter("_per", lambda p: F.array_contains("_gone", p["h"])))
    total = lambda lines: F.aggregate(lines, F.lit(0).cast("long"), lambda a, p: a + p["c"])
    depleted = (F.size("_out") > 0) & (total("_per") - total("_out") < F.lit(limits.min_left) * total("_per"))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return j.select("_carry.*", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    failed.alias("base_failed"), F.size("_out").cast("long").alias("n_removed_lines"),
                    (~failed & ~depleted).alias("kept"), F.col("_gone").alias("removed"), "_key")


def clean_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
                    limits: LineLimits = LineLimits()) -> DataFrame:
    """``docs`` without rejected rows and without boilerplate lines in the texts.

    Verdicts are those of the rows that change: rejected, or holding a removed
    line.  Rows equal in id, host and text share one.
    """
    v = quality_rules(docs, id_col, text_col, host_col, limits, carry=[id_col, host_col])
    v = stored(v.filter(~F.col("kept") | (F.size("removed") > 0))
               .select(F.xxhash64(id_col, host_col, "_key").alias("_vh"), F.col(id_col).alias("_vid"), F.col(host_col).alias("_vhost"),
                       F.col("_key").alias("_vkey"), F.col("kept").alias("_vkept"), F.col("removed").alias("_vgone"))
               .dropDuplicates(["_vid", "_vhost", "_vkey"]), "line-verdicts")
    # The row travels as one struct, so no name of it can meet another.  Only
    # rows that may have a verdict are shuffled.
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), text_or_empty(text_col).alias("text"))
    row = row.withColumn("_key", F.xxhash64("text")).withColumn("_h", F.xxhash64(f"row.{id_col}", f"row.{host_col}", "_key"))
    row = with_maybe(row, "_h", v, "_vh", "_maybe")
    j = row.filter("_maybe").join(v, F.col(f"row.{id_col}").eqNullSafe(F.col("_vid")) & F.col(f"row.{host_col}").eqNullSafe(F.col("_vhost"))
                                  & (F.col("_key") == F.col("_vkey")), "left").filter(F.coalesce("_vkept", F.lit(True)))
    stay = F.filter(F.split("text", "\n"), lambda x: ~F.array_contains("_vgone", F.xxhash64(normal_line(x))))
    cleaned = F.when(F.size("_vgone") > 0, F.array_join(stay, "\n")).otherwise(F.col(f"row.{text_col}"))
    changed = j.select(*[(cleaned if c == text_col else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
    return row.filter("not _maybe").select("row.*").unionByName(changed)
