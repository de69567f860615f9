from __future__ import annotations

from pyspark.sql import functions as F

from voxlake.operators import discover as D
from voxlake.operators import filters as P
from voxlake.operators import split as S


def test_first_failing_test_names_the_reason(spark):
    rows = [("a", "5", "text", "True", "hifi"), ("b", "5", "text", "False", None), ("c", "x", "text", None, None), ("d", "11.7", "t", None, None), ("e", "0.5", "t", None, None), ("f", "5", " \t", None, None), ("g", "5", "t" * 300, None, None), ("h", "99", "", "False", "lofi"), ("i", "nan", "t", None, None)]
    df = spark.createDataFrame(rows, "clip_id string, duration string, text string, snapped string, quality string")
    got = {r.clip_id: r.why for r in df.select("clip_id", P.manifest_reason(quality="hifi").alias("why")).collect()}
    assert got == {"a": None, "b": "unsnapped", "c": "bad_duration", "d": "longer_than_11.6s", "e": "shorter_than_1s", "f": "empty_text", "g": "text_over_250_chars", "h": "quality!=hifi", "i": "longer_than_11.6s"}
    assert P.kept(df, P.manifest_reason(quality="hifi")).count() == 1


def test_drop_counts_put_the_first_seen_of_equals_first(spark):
    df = spark.createDataFrame([(0, "x"), (1, "y"), (2, "y"), (3, "x"), (4, "z"), (5, None)], "seq int, r string")
    assert [tuple(r) for r in P.drop_counts(df, F.col("r"), "seq").collect()] == [("x", 2), ("y", 2), ("z", 1)]


def test_speaker_cascade(spark):
    rows = [("1", "කම", "kama", "w", 2.0), ("", "කම", "x", "w", 2.0), ("2", "latin", "x", "w", 2.0), ("3", "කම", "x", None, 2.0), ("4", "කම 5", "x", "w", 2.0), ("5", "කම", "x", "w", None), ("6", "කම", "vaṟa", "w", 2.0), ("7", "කම", "***", "w", 2.0), ("8", "කම", None, "w", 2.0), ("9", "කම", "x", "w", 12.0)]
    df = spark.createDataFrame(rows, "clip_id string, script string, roman string, wav string, seconds double")
    got = [r.why for r in df.select(P.speaker_reason().alias("why")).collect()]
    assert got == [None, "header_or_malformed", "header_or_malformed", "missing_wav", "contains_digits", "unreadable_wav", "unmapped_characters", "empty_after_fold", None, "longer_than_11.6s"]
    text = df.filter("clip_id IN ('1', '8')").select(P.speaker_text(F.col("roman"), F.col("script")).alias("t")).collect()
    assert [r.t for r in text] == ["kama", "kama"]


def test_source_files(spark):
    rows = [("i", "a.mp3", "derivative", "9", 0), ("i", "a.wav", "original", "5", 1), ("i", "a.flac", "original", "5", 2), ("i", "b.txt", "original", "5", 3), ("j", "x.ogg", "derivative", None, 4), ("j", "x.mp3", "derivative", "bad", 5)]
    df = spark.createDataFrame(rows, "identifier string, name string, source string, size string, seq int")
    assert sorted(r.seq for r in P.best_source_files(df).collect()) == [1, 4]


def lines(spark, files: dict[str, str]):
    return spark.createDataFrame([(f, i, x) for f, t in files.items() for i, x in enumerate(t.split("\n"))], "file string, line_no long, line string")


def test_layout_is_read_from_the_content(spark):
    files = {
        "comma_trap": "id|script|roman\nx1|කම, ගම|kamā, ga\nx2|බල, දෙ|balā, de",
        "script_only": "a;කම\nb;ගම\n\nc;බල",
        "swapped": "ṭika\tකම\tn1\nñoka\tගම\tn2",
        "quoted": 'q1,"කම, ගම",kamā\nq2,"බල",balā',
        "no_script": "a|b\nc|d",
    }
    got = {r.file: (r.delim, r.width, r.id_col, r.script_col, r.roman_col) for r in D.sniff(lines(spark, files)).collect()}
    assert got == {"comma_trap": ("|", 3, 0, 1, 2), "script_only": (";", 2, 0, 1, None), "swapped": ("\t", 3, 2, 1, 0), "quoted": (",", 3, 0, 1, 2)}
    rows = sorted((r.file, r.clip_id, r.script, r.roman) for r in D.discovered_rows(lines(spark, files)).filter("file = 'quoted'").collect())
    assert rows == [("quoted", "q1", "කම, ගම", "kamā"), ("quoted", "q2", "බල", "balā")]


def test_shallowest_directory_wins(spark):
    dirs = spark.createDataFrame([("/d/x/Amara_2", 3, True), ("/d/amara", 2, True), ("/d/amara_b", 2, False), ("/nila/a", 2, True)], "path string, depth int, has_wav boolean")
    wanted = spark.createDataFrame([("Amara",), ("nila",)], "name string")
    found = D.speaker_dirs(dirs, wanted)
    assert [tuple(r) for r in found.collect()] == [("Amara", "/d/amara")]
    assert [r.name for r in D.missing_speakers(wanted, found).collect()] == ["nila"]


def test_split_sizes_and_repeatability(spark):
    df = spark.createDataFrame([(i, "a" if i < 95 else "b") for i in range(100)], "id long, g string")
    one, two = (S.train_eval_split(df.repartition(n), ["g"], "id", eval_size=5, seed=9).filter("is_eval") for n in (1, 4))
    assert sorted(r.id for r in one.collect()) == sorted(r.id for r in two.collect())
    assert {r.g: r["count"] for r in one.groupBy("g").count().collect()} == {"a": 5}


def test_thirds_leave_the_rest_to_the_last(spark):
    sizes = lambda n: [r["count"] for r in S.thirds(spark.range(n), F.col("id"), ["id"]).groupBy("third").count().orderBy("third").collect()]
    assert sizes(11) == [3, 3, 5] and sizes(3) == [1, 1, 1] and sizes(2) == [1, 1]
    assert S.balanced_sample(spark.range(30), F.col("id"), "id", per_third=4, limit=10, seed=1).count() == 10


def test_mixed_sentences(spark):
    df = spark.createDataFrame([(0, "a b c d e"), (1, "v w x y z."), (2, "one two three four five"), (3, "too short")], "id long, t string")
    got = [tuple(r) for r in S.mixed_sentences(df, "id", "t", order=F.col("id")).collect()]
    assert got == [(5, 0, 1, "a w c y e.")]


def test_other_clip_of_the_speaker(spark):
    df = spark.createDataFrame([(i, "a") for i in range(4)] + [(9, "b")], "clip long, sp string")
    got = {r.clip: r.conditioning for r in S.conditioning_clip(df, "sp", "clip", seed=1).collect()}
    assert got[9] is None and all(got[i] is not None and got[i] != i for i in range(4))
