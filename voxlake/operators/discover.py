"""What a file of unknown layout holds: its delimiter, its width and what its columns are."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from voxlake.functions.text import DIACRITICS, SCRIPT, path_name

DELIMITERS = ("|", "\t", ";", ",")
#: Rows that column roles are read from.
ROLE_ROWS = 200


def split_rows(lines: DataFrame, delimiters=DELIMITERS) -> DataFrame:
    """(file, delim, ord, line_no, cells, width) for each candidate delimiter; blank rows go. Quoted cells are taken as csv
    does: with quotes, the csv reader's rule in a pandas function; without, a plain split."""
    quoted = lines.filter(F.col("line").contains('"'))
    plain = lines.filter(~F.coalesce(F.col("line").contains('"'), F.lit(False)))

    def read(batches):
        import csv

        import pandas as pd

        for pdf in batches:
            rows = []
            for file, no, line in zip(pdf["file"], pdf["line_no"], pdf["line"], strict=True):
                for k, d in enumerate(delimiters):
                    try:
                        rows.append((file, d, k, no, next(csv.reader([line], delimiter=d), [])))
                    except csv.Error:
                        continue
            yield pd.DataFrame(rows, columns=["file", "delim", "ord", "line_no", "cells"])

    schema = "file string, delim string, ord int, line_no long, cells array<string>"
    by_hand = quoted.select("file", F.col("line_no").cast("long").alias("line_no"), "line").mapInPandas(read, schema)
    cut = F.explode(F.array(*[F.struct(F.lit(d).alias("delim"), F.lit(k).alias("ord"), F.split("line", "\\" + d if d in "|\t" and d == "|" else d, -1).alias("cells")) for k, d in enumerate(delimiters)]))
    by_split = plain.select("file", F.col("line_no").cast("long").alias("line_no"), cut.alias("c")).select("file", "c.delim", "c.ord", "line_no", "c.cells")
    rows = by_split.unionByName(by_hand)
    return rows.filter(F.exists("cells", lambda x: F.trim(x) != "")).withColumn("width", F.size("cells"))


def modal_width(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, width, n, rows): the commonest width, the one seen first of equals."""
    each = rows.groupBy(*keys, "width").agg(F.count("*").alias("n"), F.min("line_no").alias("first_seen"))
    w = W.partitionBy(*keys).orderBy(F.desc("n"), "first_seen")
    return each.withColumn("rows", F.sum("n").over(W.partitionBy(*keys))).withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn", "first_seen")


def column_roles(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, width, id_col, script_col, roman_col) from the first rows of each file; files without script are left out."""
    head = rows.withColumn("_rn", F.row_number().over(W.partitionBy(*keys).orderBy("line_no"))).filter(F.col("_rn") <= ROLE_ROWS)
    cells = head.select(*keys, "width", F.posexplode("cells").alias("i", "cell"))
    hits = cells.groupBy(*keys, "width", "i").agg(F.count_if(F.col("cell").rlike(SCRIPT)).alias("script"), F.count_if(~F.col("cell").rlike(SCRIPT) & F.col("cell").rlike(DIACRITICS)).alias("roman"))
    top = hits.groupBy(*keys, "width").agg(F.max(F.struct("script", -F.col("i"))).alias("s"), F.max(F.struct("roman", -F.col("i"))).alias("r"))
    script_col, roman_col = -F.col("s.col2"), -F.col("r.col2")
    found = top.filter("s.script > 0").select(*keys, "width", script_col.alias("script_col"), F.when((F.col("r.roman") > 0) & (roman_col != script_col), roman_col).alias("roman_col"))
    others = F.filter(F.sequence(F.lit(0), F.col("width") - 1), lambda i: (i != F.col("script_col")) & ~i.eqNullSafe(F.col("roman_col")))
    return found.withColumn("id_col", F.coalesce(F.get(others, F.lit(0)), F.lit(0)))


def sniff(lines: DataFrame) -> DataFrame:
    """(file, delim, width, share, id_col, script_col, roman_col): the delimiter that separates script from romanised text
    best, then by the share of rows of one width, then by width; the first candidate of equals."""
    rows = split_rows(lines)
    common = modal_width(rows, ["file", "delim", "ord"]).filter("width >= 2")
    good = rows.join(common.select("file", "delim", "width"), ["file", "delim", "width"])
    scored = column_roles(good, ["file", "delim", "ord"]).join(common, ["file", "delim", "ord", "width"]).withColumn("share", F.col("n") / F.col("rows"))
    w = W.partitionBy("file").orderBy(F.desc(F.col("roman_col").isNotNull().cast("int")), F.desc("share"), F.desc("width"), "ord")
    return scored.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").select("file", "delim", "width", "share", "id_col", "script_col", "roman_col")


def discovered_rows(lines: DataFrame) -> DataFrame:
    """(file, line_no, clip_id, script, roman) by each file's own layout; roman is null where the file has none."""
    layout = sniff(lines)
    rows = split_rows(lines).join(F.broadcast(layout.select("file", "delim", "width", "id_col", "script_col", "roman_col")), ["file", "delim", "width"])
    cell = lambda c: F.trim(F.get("cells", F.col(c).cast("int")))
    return rows.select("file", "line_no", cell("id_col").alias("clip_id"), cell("script_col").alias("script"), F.when(F.col("roman_col").isNotNull(), cell("roman_col")).alias("roman"))


def speaker_dirs(dirs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(name, path): for each wanted name the shallowest directory (then by path) whose own name holds it and that has wavs.
    dirs: path, depth, has_wav; the list of wanted names is the small side."""
    met = dirs.filter("has_wav").join(F.broadcast(wanted), F.lower(path_name(F.col("path"))).contains(F.lower(F.col("name"))))
    return met.groupBy("name").agg(F.min(F.struct("depth", "path")).alias("best")).select("name", "best.path")


def missing_speakers(wanted: DataFrame, found: DataFrame) -> DataFrame:
    return wanted.join(found, "name", "left_anti")


def wavs_by_stem(wavs: DataFrame) -> DataFrame:
    """One wav for each stem, the last by path."""
    from voxlake.functions.text import path_stem

    return wavs.withColumn("clip_id", path_stem(F.col("path"))).groupBy("clip_id").agg(F.max("path").alias("wav"))
