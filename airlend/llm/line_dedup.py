"""Deletes runs of lines that have occurred before, found by fingerprints of windows of lines.

Lines are compared without white space at their ends; lines without words take no part. From each line on, and
back from it, a window takes lines until it has `min_words` words; a line that has them alone is a window, and
so is that line with the next. The fingerprint of a window is its least line hash and a hash of all of them in
order, so windows with one fingerprint have equal lines. Each window is joined with the first place of its
fingerprint, in the order of doc_id, text hash and line; those at later places are deleted, with the blank
lines in them. The first of equal lines stays.

This deletes every maximal run of at least `min_words` words that occurred before, whatever else its lines
occur in: the run's windows have all been met, and each two neighbours in it share one of them, the one from
the first on, the one back from the second, or the one from the run's start on.

Everything is expressed in DataFrame functions. A window that many documents share is one row of the join's
smaller side, and its own rows are spread by Spark's skew handling; only first places are paired, never all.

Null texts are handled as empty and stay null. Documents of one doc_id follow each other in the order of a hash
of their text; rows that repeat both are one document and lose the same lines. All columns are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airlend.llm.common import keyed, stage, unpacked, with_keys

#: Words that a repeated run must have.
MIN_WORDS = 50

_BLANK = " \t\r\f\x0b"


def line_lists(docs: DataFrame) -> DataFrame:
    """dk, th, lines: for each document its lines with words, as (i: line number, h: hash, w: words)."""
    trimmed = F.transform(F.split("text", "\n"), lambda line, i: F.struct(i.alias("i"), F.btrim(line, F.lit(_BLANK)).alias("t")))
    full = F.filter(trimmed, lambda x: x["t"] != "")
    lines = F.transform(
        full,
        lambda x: F.struct(
            x["i"].alias("i"),
            F.conv(F.substring(F.md5(x["t"].cast("binary")), 1, 15), 16, 10).cast("long").alias("h"),
            F.size(F.split(x["t"], f"[{_BLANK}]+")).alias("w"),
        ),
    )
    return keyed(docs).select("dk", "th", lines.alias("lines")).dropDuplicates(["dk", "th"])


def fingerprints(lists: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """dk, th, lo, hi (line numbers), least and hashes: each window and its fingerprint."""
    rows = lists.select("dk", "th", F.explode("lines").alias("x")).select("dk", "th", "x.i", "x.h", "x.w")
    doc = Window.partitionBy("dk", "th")
    upto = doc.orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumns({"upto": F.sum("w").over(upto), "total": F.sum("w").over(doc)})
    rows = rows.withColumn("before", F.col("upto") - F.col("w"))
    ahead = doc.orderBy("before").rangeBetween(0, min_words - 1)
    behind = doc.orderBy("upto").rangeBetween(1 - min_words, 0)
    rows = rows.withColumns(
        {
            "following": F.collect_list("h").over(ahead),
            "last": F.max("i").over(ahead),
            "next": F.lead(F.struct("i", "h")).over(doc.orderBy("before")),
        }
    )
    rows = rows.withColumns({"preceding": F.collect_list("h").over(behind), "first": F.min("i").over(behind)})

    def window(lo: Column, hi: Column, lines: Column) -> Column:
        return F.struct(lo.alias("lo"), hi.alias("hi"), F.array_min(lines).alias("least"), F.xxhash64(lines).alias("hashes"))

    i, h, alone = F.col("i"), F.col("h"), F.col("w") >= min_words
    found = F.array(
        F.when(alone, window(i, i, F.array(h))),
        F.when(alone & F.col("next").isNotNull(), window(i, F.col("next.i"), F.array(h, F.col("next.h")))),
        F.when(~alone & (F.col("total") - F.col("before") >= min_words), window(i, F.col("last"), F.col("following"))),
        F.when(~alone & (F.col("upto") >= min_words), window(F.col("first"), i, F.col("preceding"))),
    )
    return rows.select("dk", "th", F.explode(F.array_compact(found)).alias("x")).select("dk", "th", "x.*")


def repeated_runs(lists: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """dk, th, runs: line numbers (lo, hi) of the runs to delete."""
    prints = stage(fingerprints(lists, min_words), "windows")
    place, key = F.struct("dk", "th", "lo"), ["least", "hashes"]
    firsts = prints.groupBy(*key).agg(F.min(place).alias("source"), F.count("*").alias("n")).where("n > 1").drop("n")
    again = prints.join(firsts, key).where(place > F.col("source"))
    again = again.groupBy("dk", "th", "lo").agg(F.max("hi").alias("hi"))
    # Windows that overlap become one run.
    doc = Window.partitionBy("dk", "th").orderBy("lo")
    apart = F.col("lo") > F.coalesce(F.max("hi").over(doc.rowsBetween(Window.unboundedPreceding, -1)), F.lit(-1))
    upto = doc.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    runs = again.withColumn("apart", apart.cast("int")).withColumn("island", F.sum("apart").over(upto))
    runs = runs.groupBy("dk", "th", "island").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    return runs.groupBy("dk", "th").agg(F.collect_list(F.struct("lo", "hi")).alias("runs"))


def deduplicate_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The documents with text cut, and n_lines (before) and n_removed; these replace columns of those names."""
    runs = repeated_runs(line_lists(docs), min_words)
    rows = with_keys(docs).join(runs, ["dk", "th"], "left")
    lines = F.split(F.col("row.text").cast("string"), "\n")
    kept = F.filter(lines, lambda line, i: ~F.exists("runs", lambda run: (run["lo"] <= i) & (i <= run["hi"])))
    rows = rows.withColumn("lines", lines).withColumn("kept", F.when(F.col("runs").isNotNull(), kept))
    kept, whole = F.col("kept"), F.col("row.text").cast("string")
    return unpacked(
        rows,
        text=F.when(kept.isNull(), whole).otherwise(F.array_join(kept, "\n")),
        n_lines=F.coalesce(F.size("lines"), F.lit(0)).cast("long"),
        n_removed=F.coalesce(F.size("lines") - F.size("kept"), F.lit(0)).cast("long"),
    )
