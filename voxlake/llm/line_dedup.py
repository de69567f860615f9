"""Line deduplication by overlapping windows of three lines. DataFrame operations only.

Every run of `window` consecutive lines is hashed (64 and 32 bits together). A window that occurs more than once in the
whole table keeps its first occurrence, by document id and then by position; the lines that any later occurrence covers
are removed. One aggregate with map-side combining counts each window and finds its first place; the table of repeated
windows is then joined back to all windows, sent to all executors where it is short, so a passage that a third of all
documents share costs one row per occurrence, no pairs, and no task of its own.

Defined results: lines are split at \\n and compared as they are; windows of blank lines only never count; a document
of fewer than `window` lines, or with null text, is left as it is; ids may be of any type with an order; rows with the
same id and text get the same result (the first of them in order is kept by all of them); a null id sorts first; the
lines of a very long text are one row's array; other columns pass through, but for n_lines and n_removed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxlake.llm.common import few_files, materialise, row_key, small_side


def windows(docs: DataFrame, window: int, id_col: str, text_col: str) -> DataFrame:
    """(sid, key, at, h, g): hashes of each window of lines and where it starts."""
    lines = docs.select(F.col(id_col).alias("sid"), row_key(id_col, text_col).alias("key"), F.split(F.col(text_col), "\n", -1).alias("ls")).filter(F.size("ls") >= window)
    hashed = lines.select("sid", "key", F.transform("ls", lambda x: F.struct(F.xxhash64(x).alias("h"), F.hash(x).alias("g"), F.length(F.trim(x)).alias("n"))).alias("ls"))
    starts = F.sequence(F.lit(0), F.size("ls") - window)

    def joined(i):
        parts = [F.get(F.col("ls"), i + k) for k in range(window)]
        return F.struct(i.alias("at"), F.xxhash64(*[p["h"] for p in parts]).alias("h"), F.hash(*[p["g"] for p in parts]).alias("g"), sum((p["n"] for p in parts), F.lit(0)).alias("n"))

    return hashed.select("sid", "key", F.explode(F.transform(starts, joined)).alias("w")).select("sid", "key", "w.*").filter(F.col("n") > 0).drop("n")


def later_windows(docs: DataFrame, window: int, id_col: str, text_col: str) -> DataFrame:
    """(sid, key, at) of every occurrence after the first of a repeated window."""
    rows = windows(docs, window, id_col, text_col)
    place = F.struct(F.col("sid").isNotNull().alias("there"), "sid", "key", "at")
    repeated = rows.groupBy("h", "g").agg(F.count("*").alias("n"), F.min(place).alias("first")).filter(F.col("n") > 1).select("h", "g", F.col("first.key").alias("first_key"), F.col("first.at").alias("first_at"))
    repeated = small_side(materialise(few_files(repeated), "repeated"))
    # a row's key is made of its id and text, so key and place tell an occurrence
    return rows.join(repeated, ["h", "g"]).filter((F.col("key") != F.col("first_key")) | (F.col("at") != F.col("first_at"))).select("sid", "key", "at")


def dedup_lines(docs: DataFrame, *, window: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with the text without repeated passages, and the counts n_lines and n_removed."""
    later = later_windows(docs, window, id_col, text_col)
    covered = (
        later.groupBy("sid", "key").agg(F.sort_array(F.collect_set("at")).alias("at"))
        .select(F.col("sid").alias("__cut_sid"), F.col("key").alias("__cut_key"), F.array_distinct(F.flatten(F.transform("at", lambda a: F.sequence(a, a + (window - 1))))).alias("__cut"))
    )
    covered = materialise(few_files(covered), "covered")
    # the texts are only shuffled where the list of documents to cut is long
    covered = small_side(covered, covered.agg(F.sum(1 + F.size("__cut") / 20)).first()[0] or 0)
    keep = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    base = docs.select(*keep).withColumn("__cut_row", row_key(id_col, text_col))
    joined = base.join(covered, base[id_col].eqNullSafe(F.col("__cut_sid")) & (F.col("__cut_row") == F.col("__cut_key")), "left")
    lines = F.split(F.col(text_col), "\n", -1)
    left = F.concat_ws("\n", F.transform(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), "__cut"), lambda i: F.get(lines, i)))
    return joined.select(
        *[(F.when(F.col("__cut").isNull(), F.col(text_col)).otherwise(left).alias(c) if c == text_col else F.col(c)) for c in keep],
        F.coalesce(F.size(lines), F.lit(0)).cast("long").alias("n_lines"),
        F.when(F.col("__cut").isNull(), F.lit(0)).otherwise(F.size("__cut")).cast("long").alias("n_removed"),
    )
