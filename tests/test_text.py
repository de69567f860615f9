from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from voxlake.functions import numbers as N
from voxlake.functions import text as T


def one(spark, values, f, kind="string"):
    df = spark.createDataFrame([(i, *(v if isinstance(v, tuple) else (v,))) for i, v in enumerate(values)], f"i int, a {kind}" + (f", b {kind}" if isinstance(values[0], tuple) else ""))
    return [r.x for r in df.select("i", (f(F.col("a"), F.col("b")) if isinstance(values[0], tuple) else f(F.col("a"))).alias("x")).orderBy("i").collect()]


def spoken(x: str) -> str:
    x = x.lower().replace(T.JOINER, "")
    x = "".join("'" if c in T.QUOTES else c for c in x)
    return " ".join("".join(c for c in x if c in T.SPOKEN).split())


def by_pass(x: str) -> str:
    x = "".join("'" if c in T.QUOTES else c for c in x.lower().replace(T.JOINER, ""))
    return spoken(re.sub("|".join(sorted(map(re.escape, T.ROMAN), key=len, reverse=True)), lambda m: T.ROMAN[m[0]], x))


def by_letter(x: str) -> str:
    x, out, i = x.replace(T.JOINER, ""), [], 0
    while i < len(x):
        c, following = x[i], x[i + 1 : i + 2]
        if c in T.CONSONANTS:
            out.append(T.CONSONANTS[c] + (T.SIGNS.get(following, "") if following in T.SIGNS else "" if following == T.VIRAMA else "a"))
            i += following != "" and (following in T.SIGNS or following == T.VIRAMA)
        elif c in T.VOWELS:
            out.append(T.VOWELS[c])
        elif c in (T.ANUSVARA, T.VISARGA):
            out.append("ng" if c == T.ANUSVARA else "h")
        elif c not in T.SIGNS and c != T.VIRAMA:
            out.append(c)
        i += 1
    return spoken("".join(out))


def test_stops_and_aspirates(spark):
    assert one(spark, ["t", "th", "ṭ", "ṭh"], T.fold_roman) == ["th", "th", "t", "t"]
    assert one(spark, ["a\tb", " A  b ", "“x”"], T.spoken) == ["ab", "a b", "'x'"]


def test_roman_fold_equals_one_pass(spark):
    rng = random.Random(1)
    parts = [*T.ROMAN, "a", "h", "ṭ", "T", "Kh", " ", "‘", T.JOINER, "ṟ", "9"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 14))) for _ in range(400)]
    assert one(spark, texts, T.fold_roman) == [by_pass(t) for t in texts]


def test_script_fold_equals_letter_loop(spark):
    rng = random.Random(2)
    parts = [*T.CONSONANTS, *T.VOWELS, *T.SIGNS, T.VIRAMA, T.VIRAMA, T.ANUSVARA, T.VISARGA, T.JOINER, " ", ".", "x"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 16))) for _ in range(400)] + ["ක්ෂ", "ශ්‍රී ලංකාව"]
    assert one(spark, texts, T.fold_script) == [by_letter(t) for t in texts]
    assert one(spark, ["ක", "ka"], T.fold) == ["ka", "ka"]


def test_unmapped_letters_are_reported(spark):
    assert one(spark, ["vaṟdanak ā", "plain"], T.unmapped) == [["ṟ"], []]


def distance(a, b) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_error_rates(spark):
    rng = random.Random(3)
    pairs = [(" ".join(rng.choices("abcd", k=rng.randint(0, 7))), " ".join(rng.choices("abcde", k=rng.randint(0, 7)))) for _ in range(150)] + [("", ""), ("", "x"), ("é a", "e  a")]
    want = [1.0 if not a and b else 0.0 if not a else distance(a, b) / len(a) for a, b in ((" ".join(x.split()), " ".join(y.split())) for x, y in pairs)]
    assert one(spark, pairs, T.character_error_rate) == pytest.approx(want)
    accuracy = [0.0 if not x.split() else max(0.0, 1 - distance(x.split(), y.split()) / len(x.split())) for x, y in pairs]
    assert one(spark, pairs, T.word_accuracy) == pytest.approx(accuracy)


def test_stems(spark):
    paths = ["/a/Some Serial 140113.mp3", "x.tar.gz", ".hidden", "/a.b/é -- 1!.wav"]
    assert one(spark, paths, T.path_stem) == ["Some Serial 140113", "x.tar", ".hidden", "é -- 1!"]
    assert one(spark, paths, T.episode_stem) == ["Some_Serial_140113", "x_tar", "hidden", "é_1"]
    assert one(spark, ["a__b__0001"], T.episode_of_clip) == ["a__b"]


def test_words_and_stop(spark):
    assert one(spark, [" a  b c\t", "", "   "], T.words) == [["a", "b", "c"], [], []]
    assert one(spark, ["a b", "a b .,", "a.", "a. "], T.with_full_stop) == ["a b.", "a b.", "a.", "a. "]


def test_finite_numbers(spark):
    assert one(spark, ["1.5e-07", "-3e5", ".5", "nan", "\x1b[92m", "", "inf", "1.5f"], N.is_finite) == [True] * 3 + [False] * 5


def test_rounding_is_half_even_on_binary(spark):
    df = spark.createDataFrame([(1.005,), (2.675,), (0.5,), (None,)], "x double")
    assert [r.y for r in df.select(N.exact_round(2)("x").alias("y")).collect()] == [1.0, 2.67, 0.5, None]


def test_json_and_quota(spark):
    body = '{"error": {"details": [{"violations": [{"quotaId": "GenerateRequestsPerDayPerProject"}]}, {"retryDelay": "30s"}]}}'
    assert one(spark, [body, "{}", "junk"], N.retry_delay) == [30.0, None, None]
    assert one(spark, [body, "{}", "junk"], N.is_daily_quota) == [True, False, False]
    assert one(spark, ['{"secs": {"mean": 0.7, "n": 3}}', '{"secs": 0.5}', "{}"], lambda c: N.metric_mean(c, "secs")) == [0.7, 0.5, None]
    assert one(spark, ["[1,2]", "x [3] y", '{"a": 1}', None], N.json_list) == [["1", "2"], ["3"], [], []]


def test_cents_and_constant_correlation(spark):
    df = spark.createDataFrame([(200.0, 260.0)] * 3, "a double, b double")
    row = df.agg(N.root_mean_square(N.cents(F.col("a"), F.col("b"))).alias("c"), N.safe_corr(F.col("a"), F.col("b")).alias("r")).first()
    assert row.c == pytest.approx(454.2139, abs=1e-4) and row.r is None


def test_reset_and_chunks(spark):
    df = spark.sql("SELECT timestamp'2024-01-10 05:00:00' AS t UNION ALL SELECT timestamp'2024-07-10 20:00:00'")
    assert sorted(str(r.x) for r in df.select(N.next_reset(F.col("t")).alias("x")).collect()) == ["2024-01-10 08:00:00", "2024-07-11 07:00:00"]
    assert one(spark, [0.0, 450.0, 750.0, 1500.0], N.expected_chunks, "double") == [1, 2, 2, 5]


def test_edits_and_names(spark):
    df = spark.createDataFrame([("abc", "abd"), ("xbc", "xbd"), ("a", "a")], "l string, r string")
    assert [tuple(r) for r in T.common_edits(df, "l", "r").collect()] == [("replace", "c", "d", 2)]
    assert [r.x for r in spark.createDataFrame([("é",), ("",)], "a string").select(T.character_name()("a").alias("x")).collect()] == ["LATIN SMALL LETTER E WITH ACUTE", "?"]


def test_whole_turns_are_compared(spark, tmp_path):
    """The queries of whole turns against brute force: beyond 200 characters, beyond 12 words, letters outside ASCII."""
    from voxlake.plans.catalogue import QUERIES

    rng = random.Random(5)
    same = " ".join(rng.choices(["tala", "mire", "kosu"], k=60))
    texts = [same + " one two", same + " three four five", "é ජ à", "è ජ", "", " a  b ", " ".join(rng.choices(["à", "b", "ජල"], k=300)), " ".join(rng.choices(["à", "b", "ජල"], k=250))]
    spark.createDataFrame([(1, i, "user", t) for i, t in enumerate(texts)], "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    got = [{r.turn: r[2] for r in QUERIES[q](spark, str(tmp_path)).collect()} for q in ("cer_turns", "word_accuracy_turns")]
    for i, (a, b) in enumerate(zip(texts, texts[1:])):
        x, y = " ".join(a.split()), " ".join(b.split())
        assert got[0][i] == pytest.approx((1.0 if y else 0.0) if not x else distance(x, y) / len(x), abs=1e-6)
        assert got[1][i] == pytest.approx(0.0 if not x else max(0.0, 1 - distance(a.split(), b.split()) / len(a.split())), abs=1e-6)
    assert len(got[0]) == len(got[1]) == len(texts) - 1
