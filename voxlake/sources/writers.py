"""Writers: manifests, training metadata, JSON reports, review pages, clips and state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxlake.functions.text import html_escape


def write_manifest(clips: DataFrame, path: str, key: str = "episode") -> None:
    """One Parquet partition for each episode; only the partitions in `clips` are replaced."""
    clips.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(key).parquet(path)


def export_csv(df: DataFrame, path: str, sep: str = ",") -> None:
    """CSV with a header and minimal quoting (a folder of part files)."""
    df.write.mode("overwrite").option("header", True).option("sep", sep).option("escape", '"').csv(path)


def export_manifest(df: DataFrame, path: str, sep: str = ",") -> None:
    """The same as a folder of part files that each begin with a UTF-8 byte order mark, as spreadsheets want it: the mark is
    the first character of the header line that every part has."""
    first, *rest = df.columns
    quoted = lambda c: F.when(F.col(c).cast("string").rlike(f'[{sep}"\r\n]'), F.concat(F.lit('"'), F.replace(F.col(c).cast("string"), F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(F.coalesce(F.col(c).cast("string"), F.lit("")))
    line = F.concat_ws(sep, *[quoted(c) for c in df.columns]).alias("value")
    marked = f"\ufeff{sep.join([first, *rest])}"

    def headed(batches):
        import pyarrow as pa

        yield pa.RecordBatch.from_arrays([pa.array([marked])], names=["value"])
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0)], names=["value"])

    df.select(line).mapInArrow(headed, "value string").write.mode("overwrite").text(path)


def rebuild_aggregate(manifests: DataFrame, path: str) -> None:
    """The combined manifest, made anew from what lies on disk; running it twice changes nothing."""
    manifests.write.mode("overwrite").parquet(path)


def training_metadata(clips: DataFrame, path: str) -> None:
    """audio_file, text and speaker_name, separated by pipes, quoted where needed."""
    export_csv(clips.select("audio_file", "text", "speaker_name"), path, "|")


def unquoted_metadata(clips: DataFrame, path: str) -> None:
    """The same without quoting. Rows that hold a pipe or a line end would break the file and are refused."""
    bad = clips.filter(F.concat_ws("", "audio_file", "text", "speaker_name").rlike(r"[|\r\n]"))
    if not bad.isEmpty():
        raise ValueError(f"{bad.count()} rows hold a pipe or a line end")
    clips.select(F.concat_ws("|", "audio_file", "text", "speaker_name").alias("value")).write.mode("overwrite").text(path)


def json_report(df: DataFrame) -> DataFrame:
    """(value): every row as a JSON object."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("value"))


def prepare_report(clips: DataFrame, reasons: DataFrame) -> DataFrame:
    """One row (value): speakers with clips and hours, totals, durations, and drop counts as one JSON object. Where clips has
    them: train and eval clips (is_eval), sample rates of the source (sample_rate) and text sources (text_source)."""
    one = lambda df, c, name: df.agg(F.map_from_entries(F.sort_array(F.collect_list(c))).alias(name))  # noqa: E731  one entry for each speaker, rate, source or reason
    counted = lambda c: clips.groupBy(F.col(c).cast("string").alias("k")).agg(F.count("*").alias("n")).filter("k IS NOT NULL")
    speakers = one(clips.groupBy("speaker").agg(F.count("*").alias("clips"), F.round(F.sum("duration") / 3600, 2).alias("hours")), F.struct("speaker", F.struct("clips", "hours")), "speakers")
    parts = [speakers, one(reasons, F.struct("drop_reason", "n"), "dropped")]
    for column, name in (("sample_rate", "source_sample_rates"), ("text_source", "text_sources")):
        if column in clips.columns:
            parts.append(one(counted(column), F.struct("k", "n"), name))
    totals = [F.count("*").alias("clips"), F.round(F.sum("duration") / 3600, 2).alias("total_hours"), F.round(F.median("duration"), 2).alias("duration_median_s"), F.round(F.max("duration"), 2).alias("duration_max_s")]
    if "is_eval" in clips.columns:
        totals += [F.count_if(~F.col("is_eval")).alias("train_clips"), F.count_if("is_eval").alias("eval_clips")]
    joined = clips.agg(*totals)
    for part in parts:  # all of one row
        joined = joined.crossJoin(F.broadcast(part))
    return joined.select(F.to_json(F.struct(*joined.columns)).alias("value"))


def markdown_table(df: DataFrame, limit: int = 1000) -> str:
    """A small result as a Markdown table; refuses more than `limit` rows."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} rows")
    cell = lambda v: "n/a" if v is None else f"{v:.4g}" if isinstance(v, float) else str(v).replace("|", "\\|")
    return "\n".join(["| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns), *("| " + " | ".join(map(cell, r)) + " |" for r in rows)])


def review_rows(clips: DataFrame, audio: DataFrame) -> DataFrame:
    """(episode, clip_id, html): one table row for each exported clip with its sound, keyed by clip id; clips that are not
    snapped are marked. audio: clip_id, content."""
    joined = clips.join(audio, "clip_id")
    mark = F.when(F.col("snapped"), F.lit("")).otherwise(F.lit(' class="unsnapped"'))
    times = F.format_string("%.2f-%.2f", F.col("start"), F.col("end"))
    sound = F.concat(F.lit('<audio controls src="data:audio/wav;base64,'), F.base64("content"), F.lit('"></audio>'))
    return joined.select("episode", "clip_id", F.concat(F.lit("<tr"), mark, F.lit("><td>"), html_escape(F.col("clip_id")), F.lit("</td><td>"), times, F.lit("</td><td>"), html_escape(F.col("text")), F.lit("</td><td>"), sound, F.lit("</td></tr>")).alias("html"))


def write_review(rows: DataFrame, path: str) -> None:
    """Review rows as text, one folder for each episode, in clip order."""
    ordered = rows.repartition("episode").sortWithinPartitions("episode", "clip_id")
    ordered.select("episode", F.col("html").alias("value")).write.mode("overwrite").partitionBy("episode").text(path)


def panel_items(items: DataFrame, audio: DataFrame) -> DataFrame:
    """(part, item, html): a listening form for each item with its sound embedded and fields for both ratings or a transcript."""
    sound = F.concat(F.lit('<audio controls src="data:audio/wav;base64,'), F.base64("content"), F.lit('"></audio>'))
    name = lambda f: F.concat(F.lit(f'<input name="{f}-'), F.col("part"), F.lit("-"), F.col("item").cast("string"), F.lit('">'))
    fields = F.when(F.col("part") == "MOS", F.concat(name("intelligibility"), name("naturalness"))).otherwise(name("transcript"))
    return items.join(audio, "clip_id").select("part", "item", F.concat(F.lit("<section>"), sound, fields, F.lit("</section>")).alias("html"))


def panel_page(sections: list[str], rater_fields: tuple[str, ...] = ("rater", "group")) -> str:
    """A listening form for one rater: sections of panel_items (a panel is a short list) with a button that hands the
    answers out as CSV, one row for each field."""
    who = "".join(f'<label>{f} <input id="{f}"></label>' for f in rater_fields)
    script = (
        "function save(){var q=function(x){return '\"'+String(x).replace(/\"/g,'\"\"')+'\"'},own=["
        + ",".join(f"document.getElementById('{f}').value" for f in rater_fields)
        + "],out=[" + ",".join(f"'{f}'" for f in rater_fields) + ",'field','part','item','value'].join(',');"
        "document.querySelectorAll('section input').forEach(function(i){var n=i.name.split('-');out+='\\n'+own.concat([n[0],n[1],n[2],i.value]).map(q).join(',')});"
        "var a=document.createElement('a');a.href=URL.createObjectURL(new Blob(['\\ufeff'+out],{type:'text/csv'}));a.download='answers.csv';a.click()}"
    )
    return f'<!doctype html><meta charset="utf-8"><body>{who}{"".join(sections)}<button onclick="save()">Save</button><script>{script}</script></body>'


def wide_answers(answers: DataFrame) -> DataFrame:
    """Rows of a panel's CSV (rater, group, field, part, item, value) as one response for each item."""
    one = lambda f: F.max(F.when(F.col("field") == f, F.col("value"))).alias(f)
    return answers.groupBy("rater", "group", "part", "item").agg(one("intelligibility"), one("naturalness"), one("transcript"))


def cut_clips(clips: DataFrame, audio: DataFrame, key: str = "episode") -> DataFrame:
    """(key, clip_id, content): each clip's wav bytes from its episode's samples; several clips share one decoded episode."""

    def work(batches):
        import io
        import wave

        import numpy as np
        import pandas as pd

        for pdf in batches:
            out = []
            for k, name, a, b, samples, rate in zip(pdf[key], pdf["clip_id"], pdf["a"], pdf["b"], pdf["samples"], pdf["rate"], strict=True):
                part = np.asarray(samples, np.float32)[int(a * rate) : int(b * rate)]
                buffer = io.BytesIO()
                with wave.open(buffer, "wb") as w:
                    w.setnchannels(1)
                    w.setsampwidth(2)
                    w.setframerate(int(rate))
                    w.writeframes((np.clip(part, -1, 1) * 32767).astype("<i2").tobytes())
                out.append((k, name, buffer.getvalue()))
            yield pd.DataFrame(out, columns=[key, "clip_id", "content"])

    # only the clip's own samples are sent to Python
    start, stop = F.floor(F.col("a") * F.col("rate")).cast("int"), F.floor(F.col("b") * F.col("rate")).cast("int")
    rows = clips.join(audio.select(key, "samples", "rate"), key).select(key, "clip_id", F.lit(0.0).alias("a"), ((stop - start) / F.col("rate")).alias("b"), F.slice("samples", start + 1, stop - start).alias("samples"), "rate")
    return rows.mapInPandas(work, f"{key} string, clip_id string, content binary")


def append_result(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def write_cache(replies: DataFrame, path: str) -> None:
    """Replies keyed by episode and chunk. The partitions of the episodes in `replies` are replaced, so a run that is repeated
    leaves one reply to each chunk; replies must hold all of an episode's."""
    replies.select("episode", "chunk", "reply").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("episode").parquet(path)


def completion(episodes: DataFrame, failed_chunks: DataFrame, key: str = "episode") -> DataFrame:
    """(key, complete): an episode is complete if none of its chunks failed."""
    return episodes.select(key).distinct().join(failed_chunks.select(key).distinct().withColumn("_failed", F.lit(True)), key, "left").select(key, F.col("_failed").isNull().alias("complete"))


def stop_status(lines: DataFrame, reason: str, wall_h: float, budget_h: float, tail: int = 40) -> DataFrame:
    """(log_id, value): why a run stopped, with its last lines, as one JSON object."""
    from pyspark.sql import Window as W

    last = lines.withColumn("_rn", F.row_number().over(W.partitionBy("log_id").orderBy(F.desc("line_no")))).filter(F.col("_rn") <= tail)
    block = last.groupBy("log_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("line_no", "line"))), lambda x: x["line"]).alias("log_tail"))
    return block.select("log_id", F.to_json(F.struct(F.lit(reason).alias("reason"), F.lit(wall_h).alias("wall_h"), F.lit(budget_h).alias("budget_h"), "log_tail")).alias("value"))
