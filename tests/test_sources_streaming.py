from __future__ import annotations

import io
import json
import wave

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxlake.sources import readers as S
from voxlake.sources import writers as K


def write(path, text, encoding="utf-8"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding=encoding)


def test_manifests(spark, tmp_path):
    write(tmp_path / "a/manifest.csv", 'clip_id,text,duration\na__0000,"x, ""y""\nz",3.5\n', "utf-8-sig")
    df = S.read_manifest(spark, str(tmp_path))
    assert [(r.clip_id, r.text, r.quality, r.snapped) for r in df.collect()] == [("a__0000", 'x, "y"\nz', "hifi", "True")]
    write(tmp_path / "all_manifests.csv", "clip_id,quality\nb,lofi\n", "utf-8-sig")
    assert [(r.clip_id, r.quality) for r in S.read_manifest(spark, str(tmp_path)).collect()] == [("b", "lofi")]
    both = S.read_manifests(spark, [str(tmp_path / "a/manifest.csv"), str(tmp_path / "missing.csv"), str(tmp_path / "all_manifests.csv")])
    assert both.count() == 2 and set(both.columns) == {"clip_id", "text", "duration", "quality"}


def test_pipe_rows_have_no_quoting(spark, tmp_path):
    write(tmp_path / "m.csv", 'id1|"kama|කම|sp|extra\nshort|row\nid2|x|ග|sp\n')
    assert [r.roman for r in S.read_pipe_rows(spark, str(tmp_path / "m.csv")).collect()] == ['"kama', "x"]


def test_json_and_cache(spark, tmp_path):
    write(tmp_path / "c/chunk_0001_0.0-300.0.json", "[1]")
    write(tmp_path / "c/chunk_0002_300.0-600.0.json", "[1")
    assert [(r.chunk, r.reply) for r in S.read_chunk_cache(spark, str(tmp_path / "c")).collect()] == [(1, "[1]")]
    assert S.read_json_document(spark, str(tmp_path / "none.json")).count() == 0
    write(tmp_path / "held.json", json.dumps([{"clip_id": "a", "duration": 1.5}]))
    assert S.read_json_array(spark, str(tmp_path / "held.json"), "clip_id string, duration double").first().duration == 1.5


def test_log_lines_keep_their_order(spark, tmp_path):
    write(tmp_path / "train.log", "one\r\ntwo\n\nthree")
    assert [(r.line_no, r.line) for r in S.read_logs(spark, str(tmp_path / "train.log")).orderBy("line_no").collect()] == [(0, "one"), (1, "two"), (2, ""), (3, "three")]


def wav(samples: np.ndarray, rate: int = 16000) -> bytes:
    buffer = io.BytesIO()
    with wave.open(buffer, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(2)
        w.setframerate(rate)
        w.writeframes((samples * 32767).astype("<i2").tobytes())
    return buffer.getvalue()


def test_audio(spark, tmp_path):
    (tmp_path / "in/deep").mkdir(parents=True)
    (tmp_path / "in/deep/x.wav").write_bytes(wav(np.linspace(-0.5, 0.5, 24000)))
    (tmp_path / "in/bad.wav").write_bytes(b"RIFFnothing")
    heads = {r.clip_id: (r.frames, r.seconds) for r in S.wav_headers(spark, str(tmp_path / "in")).collect()}
    assert heads == {"x": (24000, 1.5), "bad": (None, None)}
    audio = S.cached_audio(spark, str(tmp_path / "in"), str(tmp_path / "cache"))
    one = audio.filter("samples IS NOT NULL").withColumn("episode", F.lit("e"))
    assert one.count() == 1 and abs(one.first().samples[0] + 0.5) < 1e-3
    clips = spark.createDataFrame([("e", "e__0000", 0.25, 0.75, True, "a < b")], "episode string, clip_id string, a double, b double, snapped boolean, text string")
    cut = K.cut_clips(clips, one)
    with wave.open(io.BytesIO(cut.first().content)) as w:
        assert (w.getnframes(), w.getframerate()) == (8000, 16000)
    rows = K.review_rows(clips.withColumnRenamed("a", "start").withColumnRenamed("b", "end"), cut.drop("episode")).first().html
    assert "a &lt; b" in rows and "base64," in rows and "unsnapped" not in rows
    files = S.list_files(spark, str(tmp_path / "in"))
    assert files.count() == 2 and S.default_audio(files).first().path.endswith("bad.wav")


def test_training_metadata(spark, tmp_path):
    good = spark.createDataFrame([("a.wav", 'say "x"', "s")], "audio_file string, text string, speaker_name string")
    K.unquoted_metadata(good, str(tmp_path / "plain"))
    assert spark.read.text(str(tmp_path / "plain")).first().value == 'a.wav|say "x"|s'
    with pytest.raises(ValueError, match="pipe"):
        K.unquoted_metadata(good.withColumn("text", F.lit("a|b")), str(tmp_path / "bad"))
    K.training_metadata(good.withColumn("text", F.lit("a|b")), str(tmp_path / "quoted"))
    assert spark.read.option("header", True).option("sep", "|").csv(str(tmp_path / "quoted")).first().text == "a|b"


def test_reports(spark, tmp_path):
    clips = spark.createDataFrame([("a", 1800.0), ("a", 1800.0), ("b", 3600.0)], "speaker string, duration double")
    reasons = spark.createDataFrame([("empty_text", 2)], "drop_reason string, n long")
    report = json.loads(K.prepare_report(clips, reasons).first().value)
    assert report["speakers"] == {"a": {"clips": 2, "hours": 1.0}, "b": {"clips": 1, "hours": 1.0}} and report["dropped"] == {"empty_text": 2} and report["duration_median_s"] == 1800.0
    assert K.markdown_table(spark.createDataFrame([("x", 1.5, None)], "a string, b double, c string")) == "| a | b | c |\n|---|---|---|\n| x | 1.5 | n/a |"
    episodes, failed = spark.createDataFrame([("e",), ("f",)], "episode string"), spark.createDataFrame([("f", 3)], "episode string, chunk int")
    assert {r.episode: r.complete for r in K.completion(episodes, failed).collect()} == {"e": True, "f": False}
    status = K.stop_status(spark.createDataFrame([("l", i, f"line {i}") for i in range(50)], "log_id string, line_no int, line string"), "nan", 1.0, 8.5).first().value
    assert json.loads(status)["log_tail"] == [f"line {i}" for i in range(10, 50)]


def test_episode_partitions_are_replaced(spark, tmp_path):
    frame = lambda e, n: spark.createDataFrame([(e, i) for i in range(n)], "episode string, i int")
    K.write_manifest(frame("a", 2).union(frame("b", 1)), str(tmp_path / "m"))
    K.write_manifest(frame("a", 5), str(tmp_path / "m"))
    assert {r.episode: r["count"] for r in spark.read.parquet(str(tmp_path / "m")).groupBy("episode").count().collect()} == {"a": 5, "b": 1}


def test_token_gate(spark, tmp_path):
    from tokenizers import Tokenizer
    from tokenizers.models import WordLevel
    from tokenizers.pre_tokenizers import Whitespace

    from voxlake.sources.tokenizer import token_counts, token_gate

    t = Tokenizer(WordLevel({"[UNK]": 0, "a": 1, "b": 2}, unk_token="[UNK]"))
    t.pre_tokenizer = Whitespace()
    t.save(str(tmp_path / "v.json"))
    rows = token_counts(spark.createDataFrame([(i, "a " * i) for i in range(1, 40)] + [(99, "a zzz")], "id int, t string"), "t", str(tmp_path / "v.json"))
    gate = token_gate(rows).first()
    lengths = sorted([*range(1, 40), 2])
    assert (gate.unknown, gate.ok, gate.tokens, gate.median, gate.p95, gate.longest) == (1, False, sum(lengths), lengths[20], lengths[38], 39)


def test_guard_over_a_growing_log(spark, tmp_path):
    from voxlake.streaming.guard import diverging, log_stream

    def step(n, *values):
        write(tmp_path / f"logs/run1/part{n}.log", "\n".join(f"| > loss_mel_ce: {v} (0)" for v in values))

    def drain():
        q = diverging(log_stream(spark, str(tmp_path / "logs")), order="file").writeStream.outputMode("update").foreachBatch(lambda df, _: seen.extend(map(tuple, df.collect()))).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
        q.awaitTermination(60)

    seen: list = []
    step(0, "4.1", "nan")
    drain()
    step(1, "nan", "nan")
    drain()
    step(2, "3.9")
    drain()
    assert seen == [("run1", 2, False), ("run1", 4, True), ("run1", 5, False)]


def test_panel_page_and_its_answers(spark):
    items = spark.createDataFrame([("MOS", 1, "c1"), ("SUS", 2, "c1")], "part string, item int, clip_id string")
    audio = spark.createDataFrame([("c1", bytearray(b"xyz"))], "clip_id string, content binary")
    rows = K.panel_items(items, audio).orderBy("item").collect()
    assert 'name="naturalness-MOS-1"' in rows[0].html and 'name="transcript-SUS-2"' in rows[1].html and "base64,eHl6" in rows[0].html
    page = K.panel_page([r.html for r in rows])
    assert page.count("<section>") == 2 and "answers.csv" in page and "\n" not in page
    said = spark.createDataFrame([("r", "g", "intelligibility", "MOS", "1", "4"), ("r", "g", "naturalness", "MOS", "1", "5"), ("r", "g", "transcript", "SUS", "2", "a b")], "rater string, `group` string, field string, part string, item string, value string")
    assert [tuple(r)[2:] for r in K.wide_answers(said).orderBy("item").collect()] == [("MOS", "1", "4", "5", None), ("SUS", "2", None, None, "a b")]


def test_manifest_parts_begin_with_a_mark(spark, tmp_path):
    rows = spark.createDataFrame([("a", 'he said "x", then', 1.5), ("b", None, None)], "clip_id string, text string, duration double").coalesce(1)
    K.export_manifest(rows, str(tmp_path / "m"))
    part = next((tmp_path / "m").glob("part-*")).read_bytes().decode("utf-8-sig")
    assert part.splitlines() == ["clip_id,text,duration", 'a,"he said ""x"", then",1.5', "b,,"]
    assert next((tmp_path / "m").glob("part-*")).read_bytes().startswith(b"\xef\xbb\xbf")


def test_caches_keep_episodes_and_cuts_apart(spark, tmp_path):
    for episode, text in (("e", "[1]"), ("f", "[2]"), ("g", "[2")):
        write(tmp_path / f"c/{episode}/chunk_0001.json", text)
    assert sorted((r.episode, r.chunk, r.reply) for r in S.read_chunk_cache(spark, str(tmp_path / "c")).collect()) == [("e", 1, "[1]"), ("f", 1, "[2]")]
    assert [(r.episode, r.chunk) for r in S.broken_chunks(spark, str(tmp_path / "c")).collect()] == [("g", 1)]
    (tmp_path / "in").mkdir()
    (tmp_path / "in/x.wav").write_bytes(wav(np.linspace(-0.5, 0.5, 16000)))
    root, cache = str(tmp_path / "in"), str(tmp_path / "cache")
    assert [len(r.samples) for r in S.cached_audio(spark, root, cache).collect()] == [16000]
    assert [len(r.samples) for r in S.cached_audio(spark, root, cache, offset=0.25, duration=0.5).collect()] == [8000]
    (tmp_path / "in/y.wav").write_bytes(wav(np.zeros(8000)))
    assert sorted(len(r.samples) for r in S.cached_audio(spark, root, cache).collect()) == [8000, 16000]


def test_report_counts_splits_rates_and_sources(spark):
    clips = spark.createDataFrame([("a", 2.0, False, 16000, "roman"), ("a", 3.0, True, 16000, "script"), ("b", 4.0, False, None, "roman")], "speaker string, duration double, is_eval boolean, sample_rate int, text_source string")
    report = json.loads(K.prepare_report(clips, spark.createDataFrame([], "drop_reason string, n long")).first().value)
    assert (report["train_clips"], report["eval_clips"]) == (2, 1) and report["source_sample_rates"] == {"16000": 2} and report["text_sources"] == {"roman": 2, "script": 1} and report["dropped"] == {}
