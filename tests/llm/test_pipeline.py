"""The pipeline against a plain version on a small table, and the opN queries against DuckDB."""

from __future__ import annotations

import os

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from tests.llm.test_dedup import contaminated, near_groups, removed_lines
from tests.llm.test_models import check_pieces
from voxlake.llm import quality, tokens
from voxlake.llm.common import materialise
from voxlake.llm.queries import ORACLE, QUERIES, hashed_id, quality_model, table, vocabulary

DATA = "/root/testdata/sf0.001"
TABLES = "documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def sf_dir(spark, documents, corpus, tmp_path_factory):
    """The small corpus with labels and a benchmark, as a folder of tables."""
    path = str(tmp_path_factory.mktemp("sf"))
    shouted = spark.createDataFrame([(1000 + i, " ".join(w.upper() + "!!" for w in (t or "x").split()[: 20 + i]) or "!!", "en", "s", 5) for i, (_, t) in enumerate(corpus)], documents.schema)
    documents.filter("doc_id <> 12").unionByName(shouted).write.parquet(f"{path}/documents.parquet")
    marks = [(i, 1, 0) for i, _ in corpus] + [(1000 + i, 0, 0) for i, _ in corpus]
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    words = next(t for i, t in corpus if i == 15).split()
    spark.createDataFrame([(1, " ".join(words[:14])), (2, "zz yy")], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_pipeline_equals_a_plain_version(spark, sf_dir):
    pytest.importorskip("public_tokenizers")
    docs = table(spark, sf_dir, "documents")
    model = quality_model(spark, docs, sf_dir)
    rows = [(r.doc_id, r.text) for r in docs.collect()]

    def score(t):
        raw = np.frombuffer((t or "").encode(), np.uint8)
        return model.score(quality.features(raw, np.array([0, len(raw)])))[0]

    kept = [(i, t) for i, t in rows if score(t) >= 0.5]
    assert 0 < len(kept) < len(rows)
    cut = removed_lines(kept)
    kept = [(i, t) for i, (t, n, gone) in sorted(cut.items()) if not (gone and gone == n)]
    groups = near_groups(kept)
    kept = [(i, t) for i, t in kept if groups[i][2]]
    hits = contaminated(kept, [(r.item_id, r.text) for r in table(spark, sf_dir, "benchmark").collect()])
    assert any(h[4] for h in hits.values())
    kept = [(i, t) for i, t in kept if not hits[i][4]]
    ids = tokens.Encoder(vocabulary("word_bpe_49k.json"), 0)([t for _, t in kept])
    want = {i: [*x.tolist(), 2] for (i, _), x in zip(kept, ids, strict=True)}
    check_pieces(corpus_pipeline.run(spark, sf_dir).collect(), want, 4096)


def test_stages_keep_the_columns(spark, sf_dir):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "line_dedup", "near_dup", "decontaminate", "packing"]
    docs = table(spark, sf_dir, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = materialise(stage(spark, docs, sf_dir), name)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        assert stage(spark, docs.limit(0), sf_dir).count() == 0
    cut = {r.doc_id: r for r in corpus_pipeline.line_dedup(spark, docs, sf_dir).collect()}
    before = {r.doc_id: r for r in docs.collect()}
    changed = [i for i, r in cut.items() if r.text != before[i].text]
    assert changed and all(cut[i].n_chars == len(cut[i].text) for i in changed)


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables")
@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    df = QUERIES[name](spark, DATA)
    said = con.execute(ORACLE[name])
    columns = [c[0] for c in said.description]
    order = [columns.index(c) for c in df.columns]
    assert sorted(columns) == sorted(df.columns)
    assert sorted(map(str, (tuple(r) for r in df.collect()))) == sorted(str(tuple(r[i] for i in order)) for r in said.fetchall())


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables")
def test_whole_tables_come_out(spark):
    n = {t: table(spark, DATA, t).count() for t in TABLES}
    size = {"op1_language_id": n["documents"], "op8_quality": n["documents"], "op9_html_text": n["pages"], "op7_token_output": n["documents"]}
    for name, rows in size.items():
        assert QUERIES[name](spark, DATA).count() == rows
    vectors = table(spark, DATA, "embeddings")
    assert QUERIES["op2_image_copies"](spark, DATA).count() == n["embeddings"] + vectors.filter("vec_id % 20 = 0").count()


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no tables")
def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.01"
    said = QUERIES["op1_language_id"](spark, d).filter("held_out").join(table(spark, d, "documents").select("doc_id", "lang"), "doc_id").toPandas()
    assert len(said) > 100 and (said.lang == said.lang_pred).mean() >= 0.98
    marked = QUERIES["op8_quality"](spark, d).filter("held_out").join(table(spark, d, "labels"), "doc_id").toPandas()
    assert len(marked) > 50 and (marked.quality == marked.predicted).mean() >= 0.95
    assert hashed_id(3) is not None


def test_copies_share_a_component(spark):
    d = "/root/testdata/sf0.01"
    if not os.path.isdir(d):
        pytest.skip("no tables")
    component = {r.image_id: r.component_id for r in QUERIES["op2_image_copies"](spark, d).collect()}
    copies = [i for i in component if i < 0]
    assert copies and sum(component[i] == component[-1 - i] for i in copies) >= 0.9 * len(copies)
