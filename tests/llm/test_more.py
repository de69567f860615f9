"""Plain versions of single steps, and defined odd cases of the operators."""

from __future__ import annotations

import math
import random
from bisect import bisect_right
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxlake.llm import common, decontaminate, langid, line_dedup, near_dup, packing, quality, token_output, tokens


@pytest.fixture(scope="module")
def vocabulary():
    return pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")


def plain_neighbours(docs, query_terms, seed):
    """Documents by BM25 score for the seed's heaviest terms, from the formula."""
    n, mean = len(docs), sum(map(len, docs)) / len(docs)
    tf = [Counter(d.tolist()) for d in docs]
    df = Counter(t for c in tf for t in c)

    def weight(t, d):
        idf = max(math.log((n - df[t] + 0.5) / (df[t] + 0.5)), 0)
        return idf * tf[d][t] * (packing.K1 + 1) / (tf[d][t] + packing.K1 * (1 - packing.B + packing.B * len(docs[d]) / mean))

    terms = [t for t in sorted(tf[seed], key=lambda t: (-weight(t, seed), t))[:query_terms] if weight(t, seed) > 0]
    score = {d: sum(weight(t, d) for t in terms if t in tf[d]) for d in range(n)}
    return {d: s for d, s in score.items() if s > 0}


def test_retrieval_equals_plain_bm25():
    rng = random.Random(5)
    docs = [np.array([int(rng.paretovariate(0.7)) % 300 for _ in range(rng.randrange(1, 60))], np.int32) for _ in range(80)]
    docs += [docs[3], docs[3]]
    index = packing.Index(docs, 12)
    for seed in range(len(docs)):
        want, got = plain_neighbours(docs, 12, seed), index.neighbours(seed).tolist()
        assert set(got) == set(want)
        assert all(want[a] >= want[b] - 1e-9 for a, b in zip(got[:-1], got[1:], strict=True))
        # copies have equal scores and go by place
        assert [d for d in got if d in (3, 80, 81)] == [d for d in (3, 80, 81) if d in want]


def test_windows_take_all_neighbours_that_fit():
    """Many neighbours that are too long come first; the short one behind them is still found."""
    long = [np.array([7, 7, 7, 7, *range(100 + 90 * k, 190 + 90 * k)], np.int32) for k in range(40)]
    docs = [np.array([7, 7, 7, *range(5000, 5040)], np.int32), *long, np.array([7, 9], np.int32), *[np.array([10_000 + k], np.int32) for k in range(60)]]
    first = packing.pack(docs, 64, 24)
    window = next(pieces for pieces in first if pieces[0] == (0, 0, 43))
    assert (41, 0, 2) in window


def test_packing_odd_cases(spark, vocabulary):
    rows = [(1, "same words here"), (1, "same words here"), (1, None), (None, "same words here"), (2, ""), (3, "x " * 3000), (3, "same words here")]
    df = spark.createDataFrame([(*r, "e") for r in rows], "doc_id long, text string, length string")
    plain = tokens.Encoder(vocabulary, 0)
    size = Counter()
    for (i, _), ids in zip(rows, plain([t for _, t in rows]), strict=True):
        size[i] += len(ids) + 1
    runs = [packing.pack_documents(df, vocabulary, window=256).collect() for _ in range(2)]
    assert sorted(map(str, runs[0])) == sorted(map(str, runs[1]))
    got = Counter()
    for r in runs[0]:
        got[r.doc_id] += r.length
    assert got == size


def test_scores_equal_sums_from_the_tables(spark, documents, corpus):
    rng = np.random.default_rng(2)
    x = rng.normal(0, 1, (400, 4))
    model = quality.fit(x, ((x[:, 0] > 0) ^ (x[:, 1] > 0.3)).astype(float), rounds=30, pair_rounds=20)

    def by_hand(row):
        bins = [bisect_right(e.tolist(), v) for e, v in zip(model.edges, row, strict=True)]
        total = model.intercept + sum(t[b] for t, b in zip(model.tables, bins, strict=True)) + sum(t[bins[j]][bins[k]] for (j, k), t in zip(model.pairs, model.pair_tables, strict=True))
        return 1 / (1 + math.exp(-max(-30, min(30, total))))

    assert np.allclose(model.score(x), [by_hand(r) for r in x], atol=1e-12)
    labels = spark.createDataFrame([(i, int(len(t or "") > 60)) for i, t in corpus], "doc_id long, quality int")
    model = quality.train(documents, labels)
    got = {r.doc_id: r.score for r in quality.quality_scores(documents, model).collect()}
    for i, t in corpus:
        raw = np.frombuffer((t or "").encode(), np.uint8)
        assert abs(got[i] - by_hand(quality.features(raw, np.array([0, len(raw)]))[0])) < 1e-9


def test_ranges_of_tokens_skip_row_groups(spark, tmp_path, vocabulary):
    import pyarrow.parquet as pq

    rows = [(i, " ".join(f"w{i}x{k}" for k in range(200))) for i in range(300)]
    path = str(tmp_path / "tokens")
    token_output.write_tokens(spark.createDataFrame(rows, "doc_id long, text string"), path, vocabulary, end_id=2, row_group_bytes=1 << 14)
    part = token_output.read_tokens(spark, path, 100, 109)
    plain = dict(zip(range(300), tokens.Encoder(vocabulary, 0)([t for _, t in rows]), strict=True))
    assert {r.doc_id: r.ids for r in part.collect()} == {i: [*plain[i].tolist(), 2] for i in range(100, 110)}
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(doc_id,100)" in plan and "LessThanOrEqual(doc_id,109)" in plan
    assert "ids" not in token_output.read_tokens(spark, path, 5, columns=("doc_id", "n_tokens"))._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[1]
    groups = [m.row_group(g).column(0).statistics for f in (tmp_path / "tokens").glob("part-*.parquet") for m in [pq.ParquetFile(f).metadata] for g in range(m.num_row_groups)]
    assert len(groups) >= 3 and sum(s.max >= 100 and s.min <= 109 for s in groups) < len(groups)


def test_line_dedup_takes_text_ids(spark):
    rows = [("b", "a\nb\nc\nz"), ("a", "a\nb\nc"), (None, "q\nr\ns"), ("c", "q\nr\ns"), ("a", "a\nb\nc")]
    got = sorted((str(r.id), r.n_removed, r.text) for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "id string, text string"), id_col="id").collect())
    assert got == [("None", 0, "q\nr\ns"), ("a", 0, "a\nb\nc"), ("a", 0, "a\nb\nc"), ("b", 3, "z"), ("c", 3, "")]


def test_hot_passages_are_in_no_shuffled_join(spark):
    rows = [(i, f"x{i}\na\nb\nc\ny{i}") for i in range(2000)]
    out = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(7))
    assert {r.n_removed: r.n for r in out.groupBy("n_removed").agg(F.count("*").alias("n")).collect()} == {0: 1, 3: 1999}


def test_long_items_and_passed_columns(spark):
    """An item of thousands of words, and columns of docs that stay, but for those that are added."""
    words = [f"w{k}" for k in range(5000)]
    items = spark.createDataFrame([(1, " ".join(words)), (2, "short one")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "x " + " ".join(words[2000:2015]) + " y", "keep", 7), (2, None, "k", 8)], "doc_id long, text string, extra string, n_words int")
    got = {r.doc_id: r for r in decontaminate.contamination(docs, items).collect()}
    assert (got[1].n_words, got[1].n_hit, got[1].extra) == (17, 15, "keep") and (got[2].n_words, got[2].n_hit) == (0, 0)


def test_languages_of_few_long_texts_are_learnt(spark):
    rng = random.Random(1)
    letters = {"aa": "abcdefgh", "bb": "stuvwxyz"}
    say = lambda lang, n: " ".join("".join(rng.choice(letters[lang]) for _ in range(5)) for _ in range(n))
    rows = [(i, say("aa", 60), "aa") for i in range(300)] + [(1000 + i, say("bb", 40_000), "bb") for i in range(3)] + [(2000, "abc", "aa"), (2000, "abc", "aa")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    models = langid.train(df, sample_chars=60_000)
    said = {r.doc_id: r.lang_pred for r in langid.identify(df.select("doc_id", "text"), models, reject=False).collect()}
    assert models.langs == ["aa", "bb"] and all(said[1000 + i] == "bb" for i in range(3)) and said[5] == said[2000] == "aa"
    tied = langid.train(spark.createDataFrame([(i, "xyz xyz", lang) for i, lang in enumerate(["b", "a"] * 20)], "doc_id long, text string, lang string"))
    assert langid.identify(spark.createDataFrame([("xyz",)], "text string"), tied, reject=False).first().lang_pred == "a"


def test_a_shared_folder_is_needed_off_one_process():
    conf = SimpleNamespace(get=lambda *a: None)
    spark = SimpleNamespace(sparkContext=SimpleNamespace(getConf=lambda: conf, master="spark://host:7077"), conf=conf)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        common.shared_dir(spark)


def test_one_scratch_table_is_left(spark, documents):
    mark = common.scratch_mark()
    near_dup.near_duplicates(documents).count()
    assert common.scratch_mark() == mark + 1
