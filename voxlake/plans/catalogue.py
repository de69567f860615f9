"""Queries over the driver's tables, one or more for each operator. plans/oracle.py has the same as SQL.

Events stand in for speech: a user is an episode, an event a region or a proposed sentence whose start is the event's time
in seconds and whose length follows its value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from voxlake import reach_workers
from voxlake.functions import numbers as N
from voxlake.functions import text as T
from voxlake.operators import discover, filters, gates, intervals, logs, metrics, panel, split, state
from voxlake.sources import writers
from voxlake.sources.scratch import scratch_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reach_workers(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spans(spark: SparkSession, sf_dir: str, stretch: float = 1.0) -> DataFrame:
    """Events as spans: user_id, event_id, event_type, start, end."""
    s = N.epoch_seconds(F.col("ts"))
    return table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", s.alias("start"), (s + F.col("value") * stretch).alias("end"))


def r6(c):
    return F.round(c, 6)


# ---- intervals ----


def chunk_regions(spark, d):
    return intervals.chunk_regions(spans(spark, d), ["user_id"], target=86_400.0)


def region_chunk_overlap(spark, d):
    chunks = intervals.chunk_regions(spans(spark, d), ["user_id"], target=86_400.0)
    met = intervals.regions_in_chunks(chunks, spans(spark, d, 600.0), ["user_id"])
    return met.groupBy("user_id", "chunk").agg(F.count("*").alias("n_regions"), r6(F.min("start")).alias("first_start"), r6(F.max("end")).alias("last_end"))


def trim_overlap(spark, d):
    return intervals.trim_overlap(spans(spark, d, 600.0), ["user_id"], tie=["event_id"]).select("event_id", "user_id", r6("start").alias("start"), r6("end").alias("end"), "trimmed")


def dedupe_spans(spark, d):
    return intervals.dedupe_spans(spans(spark, d), ["user_id"], tie=["event_id"], places=-5).select("event_id", "user_id")


def snap_regions(spark, d):
    rows = spans(spark, d, 2000.0)
    said = rows.filter("event_type IN ('click', 'signup')").select("user_id", "start", "end", F.lpad(F.col("event_id").cast("string"), 12, "0").alias("text"))
    heard = rows.filter("event_type IN ('view', 'error')").select("user_id", "start", "end")
    return intervals.snap(said, heard, ["user_id"]).select("user_id", "text", r6("start").alias("start"), r6("end").alias("end"), "snapped", "n_regions")


def merge_short(spark, d):
    rows = spans(spark, d, 200.0).withColumnRenamed("event_type", "text").withColumn("snapped", F.col("text") != "error")
    out = intervals.merge_short(rows, ["user_id"], least=20_000.0, most=100_000.0, gap=50_000.0)
    return out.select("user_id", "seq", r6("start").alias("start"), r6("end").alias("end"), "text", "snapped")


def pad_neighbours(spark, d):
    rows = intervals.trim_overlap(spans(spark, d, 600.0), ["user_id"], tie=["event_id"])
    total = F.max("end").over(W.partitionBy("user_id"))
    padded = intervals.pad_clips(rows.withColumn("total", total), ["user_id"], F.col("total") - 500.0, pad=300.0, least=900.0, tie=["event_id"])
    return padded.select("event_id", "user_id", F.col("clip_index").cast("long").alias("clip_index"), T.clip_id(F.concat(F.lit("user"), F.col("user_id").cast("string")), F.col("clip_index")).alias("clip_id"), r6("a").alias("a"), r6("b").alias("b"))


def pad_fold(spark, d):
    rows = intervals.trim_overlap(spans(spark, d, 600.0), ["user_id"], tie=["event_id"])
    rows = rows.withColumn("total", F.max("end").over(W.partitionBy("user_id")) - 500.0)
    out = intervals.pad_clips_fold(rows, ["user_id"], "total", id_col="event_id", pad=300.0, least=20_000.0)
    return out.select("event_id", "user_id", F.col("clip_index").cast("long").alias("clip_index"), r6("a").alias("a"), r6("b").alias("b"))


def exact_rounds(spark, d):
    return table(spark, d, "events").select("event_id", N.exact_round(2)(F.col("value").cast("double")).alias("rounded"))


def overlap_check(spark, d):
    return intervals.overlap_violations(spans(spark, d, 600.0), ["user_id"], tie=["event_id"]).groupBy("user_id").agg(F.count("*").alias("violations"))


def length_band(spark, d):
    return spans(spark, d).filter(intervals.in_band(F.col("start"), F.col("end"))).groupBy("user_id").agg(F.count("*").alias("n"))


def coverage(spark, d):
    clips = intervals.trim_overlap(spans(spark, d, 60.0), ["user_id"], tie=["event_id"]).withColumn("snapped", F.col("event_type") != "error")
    sources = spans(spark, d, 60.0).groupBy("user_id").agg((F.max("end") - F.min("start")).alias("source_seconds"))
    out = intervals.coverage(clips, sources, ["user_id"])
    return out.select("user_id", "n_clips", "unsnapped", r6("minutes").alias("minutes"), r6("coverage").alias("coverage"))


# ---- filters and files ----


def manifest(spark, d):
    """Documents as a clip manifest of strings."""
    docs, marks = table(spark, d, "documents"), table(spark, d, "labels").select("doc_id", "quality")
    rows = docs.join(marks, "doc_id", "left")
    return rows.select("doc_id", "text", F.when(F.col("doc_id") % 97 == 0, "n/a").otherwise((F.col("n_chars") / 100.0).cast("string")).alias("duration"), F.when(F.col("quality") == 0, "False").when(F.col("quality") == 1, "True").alias("snapped"), F.when(F.col("lang") == "es", "lofi").when(F.col("lang") == "en", "hifi").alias("quality"))


def drop_reasons(spark, d):
    return manifest(spark, d).select("doc_id", filters.manifest_reason(quality="hifi", least=2.0, most=30.0, max_chars=2500).alias("drop_reason"))


def drop_counts(spark, d):
    return filters.drop_counts(manifest(spark, d), filters.manifest_reason(least=2.0, most=30.0, max_chars=2500), "doc_id")


def corpus_cascade(spark, d):
    marks = table(spark, d, "labels").select("doc_id", F.col("toxic").alias("mark"))
    rows = table(spark, d, "documents").join(marks, "doc_id", "left").select("doc_id", F.col("lang").alias("speaker"), F.when(F.col("mark").isNotNull(), F.col("doc_id").cast("string")).alias("wav"), F.when(F.col("mark") == 0, F.col("n_chars") / 100.0).alias("seconds"), "text")
    return rows.select("doc_id", filters.corpus_reason("en", least=1.0, most=20.0, max_chars=1500).alias("drop_reason"))


def speaker_cascade(spark, d):
    rows = speaker_rows(spark, d)
    return rows.select("doc_id", filters.speaker_reason(least=1.0, most=40.0, max_chars=2000).alias("drop_reason"))


def speaker_rows(spark, d):
    """Documents as metadata with a script column: Latin capitals become letters of the script."""
    script = F.translate(F.col("text"), "ADEIOT", "අදඑඉඔට")
    return table(spark, d, "documents").select("doc_id", F.col("doc_id").cast("string").alias("clip_id"), script.alias("script"), F.when(F.col("lang") != "de", F.col("text")).alias("roman"), F.when(F.col("doc_id") % 11 != 0, F.lit("x.wav")).alias("wav"), (F.col("n_chars") / 100.0).alias("seconds"))


def source_files(spark, d):
    """Documents as the files of an item: a source is the item, two languages share each stem."""
    stem = F.concat(F.lit("Part "), (F.col("doc_id") % 7).cast("string"))
    return table(spark, d, "documents").select(F.col("source").alias("identifier"), F.concat(F.lit("a.b/"), stem, F.when(F.col("lang") == "fr", ".txt").when(F.col("lang") == "de", ".OGG").otherwise(".mp3")).alias("name"), F.when(F.col("doc_id") % 5 == 0, "original").otherwise("derivative").alias("source"), F.when(F.col("doc_id") % 13 == 0, None).otherwise(F.col("n_chars").cast("string")).alias("size"), F.col("doc_id").alias("seq"))


def best_source_files(spark, d):
    return filters.best_source_files(source_files(spark, d)).select("identifier", "stem", "name", "source", "seq")


def originals_else_all(spark, d):
    rows = table(spark, d, "events").withColumn("some", F.max((F.col("event_type") == "purchase").cast("int")).over(W.partitionBy("user_id")))
    return rows.filter("some = 0 OR event_type = 'purchase'").groupBy("user_id").agg(F.count("*").alias("n"), r6(F.sum("value")).alias("total"))


def file_stems(spark, d):
    name = F.concat(F.lit("/data/"), F.col("lang"), F.lit("/Épisode "), F.col("source"), F.lit(" -- "), F.col("doc_id").cast("string"), F.lit(".v1.mp3"))
    rows = table(spark, d, "documents").select("doc_id", name.alias("path"))
    return rows.select("doc_id", T.path_stem(F.col("path")).alias("stem"), T.episode_stem(F.col("path")).alias("episode"), T.episode_of_clip(T.clip_id(T.episode_stem(F.col("path")), F.col("doc_id") % 100)).alias("of_clip"))


# ---- joins ----


def wav_join(spark, d):
    wavs = table(spark, d, "labels").select(F.concat(F.lit("/w/"), (F.col("doc_id") % 500).cast("string"), F.lit("/"), F.col("doc_id").cast("string"), F.lit(".wav")).alias("path"))
    joined = table(spark, d, "documents").select("doc_id", F.col("doc_id").cast("string").alias("clip_id")).join(discover.wavs_by_stem(wavs), "clip_id", "left")
    return joined.select("doc_id", "wav", F.col("wav").isNull().alias("missing"))


def key_join(spark, d):
    lines, parts = table(spark, d, "lineitem"), table(spark, d, "part").select("p_partkey", "p_brand")
    return lines.join(parts, lines.l_partkey == parts.p_partkey).groupBy("p_brand").agg(F.count("*").alias("n"), r6(F.avg("l_quantity")).alias("mean_quantity"))


def speaker_dirs(spark, d):
    dirs = table(spark, d, "pages").select(F.concat(F.lit("/src/"), F.regexp_replace("url", "^[a-z]+://|[?#].*$", "")).alias("path"))
    dirs = dirs.withColumn("path", F.regexp_replace("path", "/+$", "")).distinct().withColumn("depth", F.size(F.split("path", "/"))).withColumn("has_wav", F.length("path") % 3 != 0)
    wanted = spark.createDataFrame([(str(k),) for k in range(10, 100, 7)], "name string")
    return discover.speaker_dirs(dirs, wanted)


def missing_names(spark, d):
    wanted = table(spark, d, "customer").select(F.col("c_custkey").alias("name"))
    return discover.missing_speakers(wanted, table(spark, d, "orders").filter("o_totalprice > 450000").select(F.col("o_custkey").alias("name")))


def resume_antijoin(spark, d):
    return state.open_work(table(spark, d, "documents").select("doc_id", "lang", "source"), table(spark, d, "labels"), ["doc_id"])


def cache_fill(spark, d):
    chunks = table(spark, d, "events").select("user_id", "event_id")
    cache = table(spark, d, "events").filter("event_id % 3 = 0").select("user_id", "event_id", F.when(F.col("event_id") % 2 == 0, F.col("props")).otherwise(F.lit("{broken")).alias("reply"))
    filled = state.fill_cache(chunks, cache, ["user_id", "event_id"], lambda miss: miss.withColumn("reply", F.lit("[]")))
    return filled.groupBy("user_id").agg(F.count("*").alias("n"), F.count_if(F.col("reply") == "[]").alias("called"))


def episode_state(spark, d):
    plan = table(spark, d, "customer").select(F.col("c_custkey").alias("episode"), (F.col("c_acctbal") / 3).alias("length"))
    orders = table(spark, d, "orders")
    markers = orders.filter("o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("episode"))
    manifests = orders.filter("o_orderstatus = 'O'").select(F.col("o_custkey").alias("episode"))
    return state.episode_state(plan, markers, manifests, orders.select(F.col("o_custkey").alias("episode"))).select("episode", "n_cached", "status")


def plan_estimate(spark, d):
    units = table(spark, d, "documents").select("doc_id", F.when(F.col("doc_id") % 17 != 0, F.col("n_chars").cast("string")).otherwise("unknown").alias("length"))
    return state.plan_estimate(units, table(spark, d, "labels"), ["doc_id"]).select("total", "skipped", r6("hours").alias("hours"), "requests")


def adopt_first(spark, d):
    found = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("episode"), F.concat(F.lit("/out/"), F.lpad(F.col("l_orderkey").cast("string"), 9, "0")).alias("path")).distinct()
    present = table(spark, d, "supplier").filter("s_acctbal < 0").select(F.col("s_suppkey").alias("episode"))
    return state.adopt(found, present)


def schema_union(spark, d):
    docs = table(spark, d, "documents")
    first = docs.filter("doc_id % 2 = 0").select("doc_id", F.col("lang").alias("quality"))
    second = docs.filter("doc_id % 2 = 1").select("doc_id", F.col("source").alias("snapped"))
    return state.union_manifests([first, second])


def manifest_summary(spark, d):
    out = state.manifest_summary(state.union_manifests([manifest(spark, d)]))
    return out.select("clips", r6("hours").alias("hours"), r6("hifi_hours").alias("hifi_hours"), r6("lofi_hours").alias("lofi_hours"), "unsnapped")


def conditioning_clip(spark, d):
    rows = table(spark, d, "labels").join(table(spark, d, "documents").select("doc_id", "source"), "doc_id").select("doc_id", "source")
    return split.conditioning_clip(rows, "source", "doc_id", order=(F.col("doc_id") * 7919) % 10007)


def scored_transcripts(spark, d):
    """Documents as references of a listening panel; every third rater heard one wrong word, every fifth said nothing."""
    docs = table(spark, d, "documents").filter("text IS NOT NULL")
    key = docs.select(F.lit("SUS").alias("part"), F.col("doc_id").alias("item"), F.col("text").alias("sinhala"))
    heard = F.when(F.col("doc_id") % 5 == 0, "").when(F.col("doc_id") % 3 == 0, "0").otherwise(F.col("text"))
    responses = docs.select(F.lit("SUS").alias("part"), F.col("doc_id").cast("string").alias("item"), heard.alias("transcript"))
    return panel.scored_transcripts(responses, key).select(F.col("item").cast("long").alias("doc_id"), r6("accuracy").alias("accuracy"))


def kept_durations(spark, d):
    """Marked documents as kept clips; a manifest with a row for each line of an order's, the last counts."""
    kept = table(spark, d, "labels").filter("quality = 1").select(F.col("doc_id").alias("clip_id"))
    manifest = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("clip_id"), F.col("l_extendedprice").alias("duration"), F.struct("l_linenumber", "l_extendedprice").alias("seq"))
    return panel.manifest_durations(kept, manifest)


def failover_pairs(spark, d):
    keys, models = table(spark, d, "nation").select("n_nationkey"), table(spark, d, "region").select("r_regionkey")
    pairs = keys.crossJoin(F.broadcast(models))  # a plan of a few pairs
    return pairs.select("n_nationkey", "r_regionkey", F.row_number().over(W.orderBy("n_nationkey", "r_regionkey")).cast("long").alias("turn"))


# ---- aggregates ----


def stat_blocks(spark, d):
    rows = table(spark, d, "lineitem").select("l_returnflag", F.when(F.col("l_discount") > 0.01, F.col("l_extendedprice")).alias("price"), F.lit(False).alias("failed"))
    return metrics.summarise(rows, "l_returnflag", ["price"], places=6).select("name", *[F.col(f"price.{x}").alias(x) for x in ("n", "mean", "median", "std", "min", "max")])


def failure_rate(spark, d):
    ratio = N.ratio(F.col("l_extendedprice"), F.col("l_quantity") * 1000)
    rows = table(spark, d, "lineitem").withColumn("failed", N.failed(F.when(F.col("l_linenumber") != 3, ratio)))
    return panel.pooled(rows, "l_returnflag", F.count("*").alias("clips"), r6(F.sum(F.coalesce(F.col("failed").cast("int"), F.lit(0))) / F.greatest(F.count("*"), F.lit(1))).alias("failure_rate"))


def index_percentiles(spark, d):
    return metrics.percentiles(table(spark, d, "documents"), ["lang"], "n_chars", {"median": metrics.upper_median, "p95": metrics.p95_of_n, "p95_last": metrics.p95_of_last})


def speaker_hours(spark, d):
    return metrics.hours_by(table(spark, d, "documents"), "source", "n_chars").withColumn("hours", r6("hours"))


def cer_gaps(spark, d):
    """Two prices of a line as the error rates of real and synthetic speech."""
    rows = table(spark, d, "lineitem").select("l_returnflag", F.col("l_discount").alias("real"), F.when(F.col("l_linenumber") != 2, F.col("l_tax")).alias("synthetic"))
    rows = rows.withColumn("gap", metrics.cer_gap(rows, "real", "synthetic")).withColumn("failed", F.col("gap") > 0.02)
    return metrics.summarise(rows, "l_returnflag", ["gap"], places=6).select("name", "clips", r6("failure_rate").alias("failure_rate"), "gap.n", "gap.mean", "gap.std")


def training_plan(spark, d):
    rows = table(spark, d, "documents").groupBy("lang").agg(F.count("*").alias("n"))
    out = rows.select("lang", *metrics.training_plan(rows=F.col("n"), batch=4, accumulate=2, epochs=40, seconds_per_step=F.lit(1.42), session_hours=0.5))
    return out.select("lang", F.col("steps_per_epoch").cast("long").alias("steps_per_epoch"), r6("total_hours").alias("total_hours"), F.col("sessions").cast("long").alias("sessions"))


def episode_counts(spark, d):
    orders = table(spark, d, "orders")
    return state.episode_counts(orders.select(F.col("o_custkey").alias("episode")), orders.filter("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("episode")))


def gates_overall(spark, d):
    return gates.overall(gates.compare(run_metrics(spark, d, 0), run_metrics(spark, d, 1), gates.gate_table(spark))).select("compared", "failed", "passed")


def pooled_ratings(spark, d):
    rows = table(spark, d, "labels").join(table(spark, d, "documents").select("doc_id", "lang"), "doc_id")
    out = panel.pooled(rows, "lang", *panel.rating_block(F.col("quality") * 4 + 1))
    return out.select("lang", "n", r6("mean").alias("mean"), r6("percent").alias("percent"), r6("sd").alias("sd"))


def rater_groups(spark, d):
    rows = table(spark, d, "events").select(F.col("user_id").alias("rater"), F.col("event_type").alias("group"), F.col("event_id").alias("seq"))
    return panel.rater_groups(rows)


def disagreement_topk(spark, d):
    return panel.disagreement(table(spark, d, "lineitem"), "l_partkey", "l_quantity").select("l_partkey", "n", r6("sd").alias("sd"))


def least_intelligible(spark, d):
    return panel.least_intelligible(table(spark, d, "lineitem"), "l_suppkey", "l_quantity").select("l_suppkey", r6("mean").alias("mean"))


def ordered_distinct(spark, d):
    return split.ordered_distinct(table(spark, d, "events"), "user_id", "event_id")


def character_counts(spark, d):
    return T.character_counts(table(spark, d, "documents"), F.lower("text"))


def unmapped_chars(spark, d):
    return filters.unmapped_counts(table(spark, d, "documents"), F.col("text"))


def modal_width(spark, d):
    rows = lines(spark, d).filter("line <> ''").select("file", F.lit(",").alias("delim"), "line_no", F.size(F.split("line", ",")).alias("width"))
    return discover.modal_width(rows, ["file", "delim"]).select("file", F.col("width").cast("long").alias("width"), "n", "rows")


def epoch_plan(spark, d):
    rows = table(spark, d, "documents").groupBy("lang").agg(F.count("*").alias("n"))
    return rows.select("lang", metrics.steps_per_epoch(F.col("n"), 4, 2).cast("long").alias("steps"))


def first_rates(spark, d):
    rows = table(spark, d, "documents").select("doc_id", F.element_at(F.array(*[F.lit(x) for x in (16000, 22050, 44100)]), (F.col("n_chars") % 3 + 1).cast("int")).cast("long").alias("sample_rate"))
    return metrics.first_rates(rows, "doc_id")


def speaker_overview(spark, d):
    docs = table(spark, d, "documents")
    scores = docs.groupBy(F.col("source").alias("speaker")).agg(r6(F.avg("n_chars")).alias("score"))
    hours = docs.filter("lang = 'en'").groupBy(F.col("source").alias("speaker")).agg(r6(F.sum("n_chars") / 3600).alias("hours"))
    sources = docs.filter("lang = 'de' AND doc_id % 2 = 0").groupBy(F.col("source").alias("speaker")).agg(F.lit("script").alias("text_source"))
    return metrics.speaker_overview(scores, hours, sources)


def slim_tensors(spark, d):
    rows = table(spark, d, "part").select(F.concat(F.when(F.col("p_size") % 3 == 0, "net.gpt.").when(F.col("p_size") % 3 == 1, "net.dvae.").otherwise("opt."), F.col("p_partkey").cast("string")).alias("name"), F.when(F.col("p_partkey") % 2 == 0, "float32").otherwise("int64").alias("dtype"), F.col("p_size").cast("long").alias("n"))
    return metrics.slim_tensors(rows, r"^net\.gpt\.", r"net\.").groupBy("kept", "dtype").agg(F.count("*").alias("n"), F.sum("bytes_before").alias("bytes_before"), F.sum("bytes_after").alias("bytes_after"), F.min("name").alias("first_name"))


# ---- order, samples ----


def train_eval_split(spark, d):
    out = split.train_eval_split(table(spark, d, "documents"), ["lang"], "doc_id", eval_size=40, order=(F.col("doc_id") * 7919) % 10007)
    return out.select("doc_id", "lang", "is_eval")


def seeded_split(spark, d):
    out = split.train_eval_split(table(spark, d, "documents"), ["lang"], "doc_id", eval_size=40, seed=1234)
    return out.groupBy("lang").agg(F.count("*").alias("n"), F.count_if("is_eval").alias("n_eval"))


def terciles(spark, d):
    rows = table(spark, d, "documents").select("doc_id", "lang", T.word_count(F.col("text")).alias("n_words"))
    return split.thirds(rows, F.col("n_words"), ["doc_id"], ["lang"]).select("doc_id", F.col("n_words").cast("long").alias("n_words"), F.col("third").cast("long").alias("third"))


def first_per_group(spark, d):
    return split.first_per_group(table(spark, d, "documents").select("doc_id", "source"), ["source"], ["doc_id"], 3)


def interleave_pairs(spark, d):
    out = split.mixed_sentences(table(spark, d, "benchmark"), "item_id", "text", least=5, most=60, order=F.col("item_id"))
    return out.select(F.col("n_words").cast("long").alias("n_words"), "a_id", "b_id", "sentence")


def longest_text(spark, d):
    return split.longest_per_group(table(spark, d, "documents"), ["source"], "text", "doc_id").select("source", "doc_id", F.char_length("text").cast("long").alias("n"))


# ---- text ----


def fold_roman(spark, d):
    return table(spark, d, "documents").select("doc_id", T.fold_roman(F.col("text")).alias("folded"))


def normalise_text(spark, d):
    return table(spark, d, "documents").select("doc_id", T.spoken(F.col("text")).alias("spoken"))


#: Latin letters and the letters of the script that stand for them in fold_script.
AS_SCRIPT = ("bcdfghjklmnpqrstvwyz", "බචදෆගහජකලමනපඛරසතවඹයශ", "aeiouáéèíóúü", "අාෙිොුැේීෛෝූෑ")


def fold_script(spark, d):
    c1, c2, v1, v2 = AS_SCRIPT
    script = F.translate(F.lower("text"), c1 + v1 + ",.", c2 + v2 + "්ං")
    return table(spark, d, "documents").select("doc_id", T.fold(script).alias("folded"))


def whole_turn_pairs(spark, d):
    """Each turn with the next one of its conversation, both as they stand."""
    w = W.partitionBy("conv_id").orderBy("turn")
    return table(spark, d, "conversations").select("conv_id", "turn", "text", F.lead("text").over(w).alias("following")).filter("following IS NOT NULL")


def cer_turns(spark, d):
    return whole_turn_pairs(spark, d).select("conv_id", "turn", r6(T.character_error_rate(F.col("text"), F.col("following"))).alias("cer"))


def word_accuracy_turns(spark, d):
    return whole_turn_pairs(spark, d).select("conv_id", "turn", r6(T.word_accuracy(F.col("text"), F.col("following"))).alias("accuracy"))


def escaped_html(spark, d):
    # Spark breaks base64 into lines of 76 characters
    encoded = F.translate(F.base64(F.encode("url", "UTF-8")), "\r\n", "")
    return table(spark, d, "pages").select("page_id", T.html_escape(F.col("html")).alias("escaped"), encoded.alias("encoded"))


# ---- discovery, logs ----


def lines(spark, d):
    rows = table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("file"), F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))
    return rows.select("file", F.col("line_no").cast("long").alias("line_no"), "line")


def delimiter_sniff(spark, d):
    script = F.translate(F.col("line"), "ETOA", "එටඔඅ")
    rows = lines(spark, d).withColumn("line", F.translate(script, '"', "'"))
    out = discover.sniff(rows)
    return out.select("file", "delim", F.col("width").cast("long").alias("width"), r6("share").alias("share"), *[F.col(c).cast("long").alias(c) for c in ("id_col", "script_col", "roman_col")])


def event_log(spark, d):
    """Events as a trainer's log: one log for each user."""
    line = (
        F.when(F.col("event_type") == "signup", F.format_string(" --> TIME: %s -- STEP: %d/879 -- GLOBAL_STEP: %d", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.col("event_id") % 879, F.col("event_id")))
        .when(F.col("event_type") == "error", F.lit(" > EVALUATION "))
        .when(F.col("event_type") == "purchase", F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("   | > avg_loss_mel_ce:\x1b[92m "), F.col("value").cast("string"), F.lit(" \x1b[0m(-0.1)"))).otherwise(F.concat(F.lit(" > EPOCH: "), (F.col("event_id") % 40).cast("string"), F.lit("/40"))))
        .when(F.col("event_type") == "view", F.when(F.col("event_id") % 7 == 0, F.lit("   | > loss_mel_ce: nan  (nan)")).otherwise(F.concat(F.lit("   | > loss_mel_ce: "), F.col("value").cast("string"), F.lit("  (1.0)"))))
        .otherwise(F.concat(F.lit(" > BEST MODEL : run/best_model_"), F.col("event_id").cast("string"), F.lit(".pth")))
    )
    return table(spark, d, "events").select(F.col("user_id").alias("log_id"), F.col("event_id").alias("line_no"), line.alias("line"))


def log_series(spark, d):
    return logs.curve_points(event_log(spark, d)).select("log_id", "line_no", "series", "step", "value")


def log_verdicts(spark, d):
    points = logs.curve_points(event_log(spark, d)).filter("series = 'eval'")
    out = logs.verdicts(points, ["log_id"], "line_no", "value")
    return out.select("log_id", "points", "best", "last", F.col("after").cast("long").alias("after"), "verdict")


def log_divergence(spark, d):
    return logs.divergence(event_log(spark, d), need=1)


def log_summary(spark, d):
    out = logs.run_summary(event_log(spark, d))
    return out.select("log_id", r6("wall_h").alias("wall_h"), r6("sec_per_step").alias("sec_per_step"), "last_step", F.col("epoch_reached").cast("long").alias("epoch_reached"), F.col("epoch_total").cast("long").alias("epoch_total"))


def log_lines_shown(spark, d):
    return logs.worth_showing(event_log(spark, d), limit=3).select("log_id", "line_no", "line")


def rolling_mean(spark, d):
    return logs.rolling_mean(table(spark, d, "events"), ["user_id"], "event_id", "value", 5).select("event_id", r6("smooth").alias("smooth"))


def best_checkpoints(spark, d):
    name = F.when((F.col("o_orderstatus") == "F") & (F.col("o_orderkey") % 3 == 0), F.concat(F.lit("best_model_"), F.col("o_orderkey").cast("string"), F.lit(".pth"))).otherwise(F.concat(F.lit("checkpoint_"), F.col("o_orderkey").cast("string"), F.lit(".pth")))
    files = table(spark, d, "orders").select(F.col("o_custkey").alias("run"), F.concat(F.lit("/r/"), name).alias("path"))
    return logs.best_checkpoints(files)


def finite_numbers(spark, d):
    written = F.element_at(F.array(F.col("value").cast("string"), F.lit("nan"), F.lit("-inf"), F.lit("1.5f"), F.lit(".5"), F.lit("-3e5"), F.lit("")), (F.col("event_id") % 7 + 1).cast("int"))
    return table(spark, d, "events").select("event_id", N.is_finite(written).alias("finite"), N.digits_only(F.regexp_extract(written, r"(\d+)", 1)).cast("long").alias("whole"))


# ---- gates, findings ----


def run_metrics(spark, d, parity: int):
    rows = table(spark, d, "lineitem").filter(F.col("l_linenumber") % 2 == parity)
    parts = rows.groupBy(F.col("l_suppkey").alias("seed")).agg(
        F.avg("l_extendedprice").alias("mcd_db"), F.avg("l_quantity").alias("f0_rmse_cents"), F.avg("l_discount").alias("f0_corr"), F.avg("l_tax").alias("secs"), F.avg(F.col("l_quantity") / 25).alias("duration_ratio"), F.count("*").cast("double").alias("rtf")
    )
    return parts.unpivot(["seed"], ["mcd_db", "f0_rmse_cents", "f0_corr", "secs", "duration_ratio", "rtf"], "metric", "value")


def regression_gates(spark, d):
    out = gates.compare(run_metrics(spark, d, 0), run_metrics(spark, d, 1), gates.gate_table(spark))
    return out.select("metric", r6("baseline").alias("baseline"), r6("candidate").alias("candidate"), r6("allowed").alias("allowed"), r6("worse_by").alias("worse_by"), "ok")


def findings(spark, d):
    docs = table(spark, d, "documents")
    speakers = docs.groupBy(F.col("lang").alias("speaker")).agg((F.sum("n_chars") / 36000).alias("hours"), F.avg(F.col("n_chars") / 10000.0).alias("f0_corr"))
    speakers = speakers.withColumn("text_source", F.when(F.col("speaker") == "de", "script").otherwise("roman"))
    run = docs.agg(F.lit("improving").alias("verdict"), F.max("doc_id").alias("best_step"), F.lit(2.27).alias("wall_h"), F.lit(8.5).alias("budget_h"), F.lit("process_exit").alias("reason"), F.lit(1.42).alias("sec_per_step"), F.lit(879).alias("steps_per_epoch"), F.lit(40).alias("epoch_total"))
    measured = docs.agg((F.count_if(F.col("n_chars") > 2000) / F.count("*")).alias("failure_rate"), F.lit(0.9).alias("duration_ratio"))
    return gates.findings(speakers=speakers, run=run, metrics=measured).select(F.col("seq").cast("long").alias("seq"), "severity", "title")


# ---- vectors, JSON, time ----


def cosine_prev(spark, d):
    w = W.partitionBy("label").orderBy("vec_id")
    rows = table(spark, d, "embeddings").withColumn("prev", F.lag("embedding").over(w)).filter("prev IS NOT NULL")
    return rows.select("vec_id", F.round(N.cosine(F.col("embedding"), F.col("prev")), 5).alias("cosine"))


def pitch_stats(spark, d):
    w = W.partitionBy("user_id").orderBy("event_id")
    rows = table(spark, d, "events").withColumn("b", F.lead("value").over(w)).filter("b IS NOT NULL AND value > 0 AND b > 0")
    out = rows.groupBy("user_id").agg(F.count("*").alias("n"), N.root_mean_square(N.cents(F.col("value"), F.col("b"))).alias("rmse"), N.safe_corr(F.log("value"), F.log("b")).alias("corr"))
    return out.select("user_id", "n", F.round("rmse", 4).alias("rmse"), F.round("corr", 6).alias("corr"))


def json_items(spark, d):
    """Replies with text around a list of items, some of them broken."""
    k = F.get_json_object("props", "$.k").cast("int")
    item = F.format_string('{"start_sec": %d, "end_sec": "%d", "text": " item %d "}', k % 50, k, F.col("event_id"))
    reply = F.when(F.col("event_id") % 5 == 0, F.lit("no list here")).when(F.col("event_id") % 5 == 1, F.concat(F.lit("Sure: ["), item, F.lit(', {"start_sec": "x"}, 7] done'))).otherwise(F.concat(F.lit("["), item, F.lit("]")))
    rows = table(spark, d, "events").select("event_id", reply.alias("reply"))
    out = intervals.valid_items(rows, ["event_id"], "reply", F.lit(10.0), F.lit(80.0))
    return out.select("event_id", F.col("seq").cast("long").alias("seq"), "start", "end", "text")


def quota_errors(spark, d):
    delay = (F.col("event_id") % 60).cast("string")
    body = F.concat(F.lit('{"error": {"details": [{"violations": [{"quotaId": "'), F.when(F.col("event_id") % 3 == 0, "RequestsPerDay").otherwise("RequestsPerMinute"), F.lit('"}]}, {"retryDelay": "'), delay, F.lit('s"}]}}'))
    return table(spark, d, "events").select("event_id", N.retry_delay(body).alias("delay"), N.is_daily_quota(body).alias("daily"))


def next_reset(spark, d):
    now = F.col("ts").cast("timestamp")
    seconds = (F.unix_micros(N.next_reset(now)) - F.unix_micros(now)) / 1e6
    return table(spark, d, "events").select("event_id", r6(seconds).alias("seconds_left"))


def quality_tags(spark, d):
    rate = F.element_at(F.array(*[F.lit(x) for x in (8000, 16000, 22050, 24000, 44100)]), (F.col("doc_id") % 5 + 1).cast("int"))
    rows = table(spark, d, "documents").select(rate.alias("rate"), "n_chars")
    return rows.groupBy(N.quality_tag(F.col("rate")).alias("quality"), N.output_rate(F.col("rate")).cast("long").alias("output_rate")).agg(F.count("*").alias("n"), F.sum("n_chars").alias("chars"))


def metric_unwrap(spark, d):
    block = F.when(F.col("event_id") % 3 == 0, F.format_string('{"secs": {"n": 3, "mean": %s}}', F.col("value").cast("string"))).when(F.col("event_id") % 3 == 1, F.format_string('{"secs": %s}', F.col("value").cast("string"))).otherwise(F.lit('{"rtf": 1}'))
    return table(spark, d, "events").select("event_id", N.metric_mean(block, "secs").alias("secs"))


def dtw_distance(spark, d):
    w = W.partitionBy("label").orderBy("vec_id")
    rows = table(spark, d, "embeddings").withColumn("prev", F.lag("embedding").over(w)).filter("prev IS NOT NULL")
    return metrics.dtw_distances(rows, "vec_id", "embedding", "prev", 8).select("vec_id", F.round("dtw", 4).alias("dtw"))


def clip_signals(spark, d):
    """Per-clip distortion and pitch of tones whose pitch follows the vectors' first numbers."""
    tone = lambda f: F.transform(F.sequence(F.lit(0), F.lit(5999)), lambda i: F.sin(2 * 3.141592653589793 * f * i / 16000).cast("float"))
    e = F.col("embedding")
    rows = table(spark, d, "embeddings").select(F.col("vec_id").cast("string").alias("clip_id"), tone(200 + 100 * e[0]).alias("ref"), tone(260 + 100 * e[0]).alias("syn"))
    out = metrics.clip_metrics(rows, 16_000)
    return out.select("clip_id", F.round("mcd_db", 2).alias("mcd_db"), F.round("f0_rmse_cents", 0).alias("cents"), F.round("f0_corr", 2).alias("f0_corr"), "voiced_frames", F.round("duration_ratio", 6).alias("duration_ratio"))


def distortion_landmarks(spark, d):
    """Distortion of a tone against itself, louder, higher and as noise-like steps: landmarks that scores are read against."""
    from pyspark.sql.types import ArrayType, FloatType

    t = F.transform(F.sequence(F.lit(0), F.lit(7999)), lambda i: F.sin(2 * 3.141592653589793 * 220 * i / 16000))
    high = F.transform(F.sequence(F.lit(0), F.lit(7999)), lambda i: F.sin(2 * 3.141592653589793 * 330 * i / 16000))
    rough = F.transform(F.sequence(F.lit(0), F.lit(7999)), lambda i: F.pmod(F.xxhash64(i), F.lit(2001)) / 1000.0 - 1)
    as_signal = lambda c: c.cast(ArrayType(FloatType()))
    pairs = [("same", t, t), ("louder", t, F.transform(t, lambda x: x * 0.5)), ("higher", t, high), ("noise", t, rough)]
    rows = table(spark, d, "region").limit(1).select(F.explode(F.array(*[F.struct(F.lit(n).alias("pair"), as_signal(a).alias("ref"), as_signal(b).alias("syn")) for n, a, b in pairs])).alias("p")).select("p.*")
    return metrics.calibration(rows, 16_000).select("pair", F.round("mcd_db", 3).alias("mcd_db"))


def manifest_round_trip(spark, d):
    """Documents written as a quoted CSV and read back."""
    folder = scratch_folder(spark, "manifest")
    writers.export_csv(table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("clip_id"), F.regexp_replace("text", r"[\r\n]+", " ").alias("text"), "lang"), folder)
    back = spark.read.schema("clip_id string, text string, lang string").option("header", True).option("escape", '"').csv(folder)
    return back.select(F.col("clip_id").cast("long").alias("doc_id"), "lang", F.coalesce(F.char_length("text"), F.lit(0)).cast("long").alias("n"))


def cache_round_trip(spark, d):
    """Replies written twice by episode and chunk: a repeated run leaves one of each."""
    folder = scratch_folder(spark, "cache")
    replies = table(spark, d, "events").filter("user_id % 50 = 1").select(F.col("user_id").alias("episode"), F.col("event_id").alias("chunk"), F.col("props").alias("reply"))
    for _ in range(2):
        writers.write_cache(replies, folder)
    return spark.read.parquet(folder).groupBy("episode").agg(F.count("*").alias("n"), F.max("chunk").alias("last_chunk")).select(F.col("episode").cast("long").alias("episode"), "n", "last_chunk")


def report_round_trip(spark, d):
    """Each source's report as a JSON line, written as text and read back."""
    folder = scratch_folder(spark, "reports")
    rows = table(spark, d, "documents").groupBy("source").agg(F.count("*").alias("clips"), F.sum("n_chars").alias("chars"))
    writers.json_report(rows).write.text(folder)
    return spark.read.schema("source string, clips long, chars long").json(folder)


def stream_divergence(spark, d):
    """The events' log as a stream: all that is there is read (availableNow), and the guard says which logs are lost."""
    from voxlake.streaming.guard import diverging

    lines, marks, out = (scratch_folder(spark, x) for x in ("lines", "marks", "out"))
    event_log(spark, d).withColumn("log_id", F.col("log_id").cast("string")).write.parquet(lines)
    stream = spark.readStream.schema("log_id string, line_no long, line string").parquet(lines)

    def keep(batch, number):
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    said = diverging(stream, need=1, order="line_no")
    said.writeStream.outputMode("update").option("checkpointLocation", marks).trigger(availableNow=True).foreachBatch(keep).start().awaitTermination()
    told = spark.read.schema("log_id string, seen long, diverged boolean, batch int").parquet(out)
    last = told.groupBy("log_id").agg(F.max_by(F.struct("seen", "diverged"), "batch").alias("s"))
    return last.select(F.col("log_id").cast("long").alias("log_id"), "s.seen", "s.diverged")


def streaming_counts(spark, d):
    from voxlake.streaming.guard import event_rates

    out = event_rates(table(spark, d, "events"))
    return out.select(N.epoch_seconds(F.col("window.start")).cast("long").alias("window_start"), "event_type", "n", r6("total").alias("total"))


QUERIES = {
    f.__name__: f
    for f in (
        chunk_regions, region_chunk_overlap, trim_overlap, dedupe_spans, snap_regions, merge_short, pad_neighbours, pad_fold, exact_rounds, overlap_check, length_band, coverage,
        drop_reasons, drop_counts, corpus_cascade, speaker_cascade, best_source_files, originals_else_all, file_stems,
        wav_join, key_join, speaker_dirs, missing_names, resume_antijoin, cache_fill, episode_state, plan_estimate, adopt_first, schema_union, manifest_summary, conditioning_clip, scored_transcripts, kept_durations, episode_counts, failover_pairs,
        stat_blocks, failure_rate, index_percentiles, speaker_hours, cer_gaps, training_plan, gates_overall, pooled_ratings, rater_groups, disagreement_topk, least_intelligible, ordered_distinct, character_counts, unmapped_chars, modal_width, epoch_plan, first_rates, speaker_overview, slim_tensors,
        train_eval_split, seeded_split, terciles, first_per_group, interleave_pairs, longest_text,
        fold_roman, normalise_text, fold_script, cer_turns, word_accuracy_turns, escaped_html,
        delimiter_sniff, log_series, log_verdicts, log_divergence, log_summary, log_lines_shown, rolling_mean, best_checkpoints, finite_numbers,
        regression_gates, findings, cosine_prev, pitch_stats, json_items, quota_errors, next_reset, quality_tags, metric_unwrap, dtw_distance, clip_signals, distortion_landmarks, manifest_round_trip, cache_round_trip, report_round_trip, stream_divergence, streaming_counts,
    )
}
