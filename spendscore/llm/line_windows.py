"""Line dedup by overlapping windows of three lines, on built-in expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendscore.llm.common import removed, unused, written_at
from spendscore.llm.filters import split_by_keys

#: Characters that do not count at either end of a line.
BLANK = " \t\r"


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _windows(text: Column, size: int) -> Column:
    """(k, from, to, h1, h2) of every window of ``size`` lines that are not blank."""
    full = F.filter(
        F.transform(_lines(text), lambda line, i: F.struct(i.alias("i"), F.trim(line, F.lit(BLANK)).alias("line"))),
        lambda x: x["line"] != "",
    )

    def window(k: Column) -> Column:
        own = [F.get(F.col("_full"), k + j)["line"] for j in range(size)]
        return F.struct(
            k.alias("k"),
            F.get(F.col("_full"), k)["i"].alias("from"),
            F.get(F.col("_full"), k + (size - 1))["i"].alias("to"),
            F.xxhash64(*own).alias("h1"),
            F.xxhash64(F.lit(1), *own).alias("h2"),
        )

    starts = F.when(F.size("_full") >= size, F.sequence(F.lit(0), F.size("_full") - size)).otherwise(
        F.array().cast("array<int>")
    )
    return full, F.transform(starts, window)


def line_windows(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3,
    counts: tuple[str, str] = ("n_lines", "n_cut"),
) -> DataFrame:
    """``docs`` with later occurrences of repeated line windows cut out of the text.

    A window is ``size`` consecutive lines that are not blank, compared without blanks at
    their ends. Its first occurrence over all documents, by id and position, stays. The
    lines of all its other occurrences go, together with blank lines between them;
    overlapping occurrences are merged, so that a passage of any length goes whole.
    Of every line at least one copy remains.

    All columns stay; the number of lines and of lines cut (long) are added under the names
    ``counts``, replacing columns of such names.

    * NULL text stays NULL with 0 lines; an empty text has one line, which is blank.
    * Texts with fewer than ``size`` full lines are left as they are.
    * Rows with equal id and text are one document and treated alike. Rows without id
      come before all others.
    * An empty table gives no rows.
    """
    spark = docs.sparkSession
    of_doc, of_mark, of_cuts = unused(docs, "__cut_doc", "__cut_mark", "__cuts")
    key = docs.select(F.col(id_col).alias("doc"), F.xxhash64(F.col(text_col)).alias("mark"), F.col(text_col).alias("text"))
    full, found = _windows(F.col("text"), size)
    windows, windows_at = written_at(
        key.where("text IS NOT NULL").withColumn("_full", full)
        .select("doc", "mark", F.explode(found).alias("w")).select("doc", "mark", "w.*"),
        "windows",
    )
    repeated, repeated_at = written_at(
        windows.groupBy("h1", "h2")
        .agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("doc", "mark", "k")).alias("first"))
        .where("n > 1").drop("n"),
        "repeated",
    )
    later = windows.join(repeated, ["h1", "h2"]).where(F.struct("doc", "mark", "k") > F.col("first"))
    cuts, _ = written_at(
        later.groupBy(F.col("doc").alias(of_doc), F.col("mark").alias(of_mark))
        .agg(F.array_distinct(F.flatten(F.collect_set(F.sequence("from", "to")))).alias(of_cuts)),
        "cuts",
    )
    removed(spark, windows_at, repeated_at)
    rest = docs.drop(*counts)
    text = F.col(text_col)
    lines = _lines(text)
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(of_cuts))
    key = F.xxhash64(of_doc, of_mark)
    touched, whole = split_by_keys(rest, cuts, F.xxhash64(F.col(id_col), F.xxhash64(text)), key)
    changed = (
        touched.join(cuts, F.col(id_col).eqNullSafe(F.col(of_doc)) & (F.xxhash64(text) == F.col(of_mark)), "left")
        .withColumn(counts[0], F.coalesce(F.when(text.isNotNull(), F.size(lines)), F.lit(0)).cast("long"))
        .withColumn(counts[1], F.coalesce(F.when(F.col(of_cuts).isNotNull(), F.size(of_cuts)), F.lit(0)).cast("long"))
        .withColumn(text_col, F.when(F.col(of_cuts).isNull(), text).otherwise(
            F.array_join(F.transform(left, lambda i: F.get(lines, i)), "\n")))
        .drop(of_doc, of_mark, of_cuts)
    )
    same = whole.withColumns({
        counts[0]: F.coalesce(F.when(text.isNotNull(), F.size(lines)), F.lit(0)).cast("long"), counts[1]: F.lit(0).cast("long")})
    return changed.unionByName(same)
