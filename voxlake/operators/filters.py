"""Filter cascades: every row gets the reason of the first test it fails, or none."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxlake.functions.numbers import general
from voxlake.functions.text import fold_roman, fold_script, has_digits, has_script, strip, unmapped


def first_reason(tests: list[tuple[str, Column]]) -> Column:
    """The name of the first test that holds (null counts as not holding); null if none does."""
    out = F.lit(None).cast("string")
    for name, test in reversed(tests):
        out = F.when(F.coalesce(test, F.lit(False)), F.lit(name)).otherwise(out)
    return out


def manifest_reason(*, quality: str = "all", allow_unsnapped: bool = False, least: float = 1.0, most: float = 11.6, max_chars: int = 250) -> Column:
    """Over a manifest of strings; missing quality means hifi and missing snapped means True."""
    length, text = F.col("duration").try_cast("double"), strip(F.coalesce(F.col("text"), F.lit("")))
    tests = [] if quality == "all" else [(f"quality!={quality}", F.coalesce(F.col("quality"), F.lit("hifi")) != quality)]
    if not allow_unsnapped:
        tests.append(("unsnapped", F.coalesce(F.col("snapped").cast("string"), F.lit("True")) != "True"))
    return first_reason(
        [*tests, ("bad_duration", length.isNull()), (f"longer_than_{general(most)}s", length > most), (f"shorter_than_{general(least)}s", length < least), ("empty_text", text == ""), (f"text_over_{max_chars}_chars", F.char_length(text) > max_chars)]
    )


def corpus_reason(wanted_speaker: str | None, *, least: float = 1.0, most: float = 11.6, max_chars: int = 250) -> Column:
    """Over metadata rows joined to wav headers: speaker, wav (null: missing), seconds (null: unreadable), text."""
    tests = [(f"speaker!={wanted_speaker}", F.col("speaker") != wanted_speaker)] if wanted_speaker else []
    return first_reason(
        [*tests, ("missing_wav", F.col("wav").isNull()), ("unreadable_wav", F.col("seconds").isNull()), (f"longer_than_{general(most)}s", F.col("seconds") > most), (f"shorter_than_{general(least)}s", F.col("seconds") < least), ("empty_text", F.coalesce(F.col("text"), F.lit("")) == ""), (f"text_over_{max_chars}_chars", F.char_length("text") > max_chars)]
    )


def speaker_text(roman: Column, script: Column) -> Column:
    """The romanised column folded, or the script where there is none."""
    return F.when(roman.isNull(), fold_script(script)).otherwise(fold_roman(roman))


def speaker_reason(*, keep_digits: bool = False, least: float = 1.0, most: float = 11.6, max_chars: int = 250) -> Column:
    """Over discovered rows: clip_id, script, roman (null: the file has no such column), wav, seconds."""
    roman = F.coalesce(F.col("roman"), F.lit(""))
    text = speaker_text(F.col("roman"), F.col("script"))
    tests = [("header_or_malformed", (F.coalesce(F.col("clip_id"), F.lit("")) == "") | ~F.coalesce(has_script(F.col("script")), F.lit(False))), ("missing_wav", F.col("wav").isNull())]
    if not keep_digits:
        tests.append(("contains_digits", has_digits(roman) | has_digits(F.col("script"))))
    return first_reason(
        [*tests, ("unreadable_wav", F.col("seconds").isNull()), (f"longer_than_{general(most)}s", F.col("seconds") > most), (f"shorter_than_{general(least)}s", F.col("seconds") < least), ("unmapped_characters", F.col("roman").isNotNull() & (F.size(unmapped(roman)) > 0)), ("empty_after_fold", text == ""), (f"text_over_{max_chars}_chars", F.char_length(text) > max_chars)]
    )


def kept(df: DataFrame, reason: Column) -> DataFrame:
    return df.filter(reason.isNull())


def drop_counts(df: DataFrame, reason: Column, seq: str) -> DataFrame:
    """(drop_reason, n) with the commonest first, and of equals the one seen first."""
    return df.withColumn("drop_reason", reason).filter("drop_reason IS NOT NULL").groupBy("drop_reason").agg(F.count("*").alias("n"), F.min(seq).alias("first_seen")).orderBy(F.desc("n"), "first_seen").select("drop_reason", "n")


def unmapped_counts(df: DataFrame, text: Column) -> DataFrame:
    return df.select(F.explode(unmapped(text)).alias("ch")).groupBy("ch").agg(F.count("*").alias("n"))


AUDIO = r"(?i)\.(mp3|ogg|flac|wav|m4a)$"


def best_source_files(files: DataFrame, ident: str = "identifier") -> DataFrame:
    """Of an item's files: audio only, originals if there are any, and of each stem the largest (the first of equals)."""
    from pyspark.sql import Window as W

    from voxlake.functions.text import path_stem

    rows = files.filter(F.col("name").rlike(AUDIO)).withColumn("size_n", F.coalesce(F.col("size").try_cast("long"), F.lit(0)))
    rows = rows.withColumn("some_original", F.max((F.col("source") == "original").cast("int")).over(W.partitionBy(ident))).filter((F.col("some_original") == 0) | (F.col("source") == "original"))
    rows = rows.withColumn("stem", path_stem(F.col("name")))
    kept = [c for c in rows.columns if c not in (ident, "stem", "some_original", "size_n")]
    first = F.min_by(F.struct(*kept), F.struct(-F.col("size_n"), F.col("seq")))
    return rows.groupBy(ident, "stem").agg(first.alias("_first")).select(ident, "stem", "_first.*")
