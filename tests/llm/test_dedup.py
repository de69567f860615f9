"""Near-duplicates, line dedup and decontamination against brute force, and their defined odd cases."""

from __future__ import annotations

import hashlib
import pathlib
import random
import re

import pytest
from pyspark.sql import functions as F

from voxlake.llm import common, decontaminate, graph, line_dedup, near_dup, shingles

ASCII_LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingle_set(text):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", (text or "").translate(ASCII_LOWER)) if x]
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def near_groups(rows, threshold=85):
    sets = {i: shingle_set(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= threshold * (len(sets[a]) + len(sets[b]) - both):
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


def test_near_duplicates_equal_brute_force(documents, corpus):
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dup.near_duplicates(documents).collect()}
    want = near_groups(corpus)
    assert got == want and any(not w[2] for w in want.values())


@pytest.mark.parametrize("seed", range(2))
def test_large_groups_of_variants_lose_no_link(spark, seed):
    """Chains and stars around the threshold, in one large group."""
    rng = random.Random(seed)
    base = [f"w{i}" for i in range(120)]
    rows, texts = [], []
    for k in range(150):
        w = list(base)
        for _ in range(rng.choice([0, 1, 1, 2, 2, 3, 4, 5])):
            w[rng.randrange(120)] = f"x{rng.randrange(40)}"
        texts.append(" ".join(w[: rng.choice([120, 120, 115, 104])]))
    rows = list(enumerate(texts))
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == near_groups(rows)


def test_two_thousand_variants_around_the_threshold(spark):
    """One text with one to three words replaced: pairs at 0.80 to 0.90, with the text itself and without it."""
    rng = random.Random(3)
    base = [f"w{i}" for i in range(100)]
    texts = []
    for _ in range(2000):
        w = list(base)
        for at in rng.sample(range(100), rng.choice([1, 1, 2, 2, 2, 3])):
            w[at] = f"x{rng.randrange(10**6)}"
        texts.append(" ".join(w))
    rows = list(enumerate(texts))
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = near_groups(rows)
    assert got == want and 20 < sum(w[2] for w in want.values()) < 1900


@pytest.mark.parametrize("sizes", [(60, 80), (70, 70)])
def test_repeated_ids_link_all_their_texts(spark, sizes):
    """Rows (1, A), (1, B), (2, near A), (3, near B), with sets of unequal and of equal sizes."""
    a, b = (" ".join(f"{c}{i}" for i in range(n)) for c, n in zip("ab", sizes, strict=True))
    rows = [(1, a), (1, b), (2, a + " more"), (3, b + " more"), (4, "something else"), (1, a), (5, a)]
    got = {(r.doc_id, r.component_id, r.kept) for r in near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(1, 1, True), (2, 1, False), (3, 1, False), (5, 1, False), (4, 4, True)}


def test_lists_of_unrelated_groups(spark, monkeypatch):
    """Groups that share some postings only, so that members far from a hub go on to the next one, and to the last join."""
    rng = random.Random(8)
    shared = [f"s{i}" for i in range(40)]
    rows = []
    for g in range(12):
        own = [f"g{g}_{i}" for i in range(45)]
        for _ in range(6):
            w = shared + own
            w[rng.randrange(85)] = f"x{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = near_groups(rows)
    for rounds in (1, 4):
        monkeypatch.setattr(near_dup, "ROUNDS", rounds)
        monkeypatch.setattr(near_dup, "NEAR", 30)
        assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dup.near_duplicates(df).collect()} == want


def test_near_duplicate_odd_cases(spark):
    df = spark.createDataFrame([(None, "a b c d e f", "x"), (5, "a b c d e f", None), (5, "q", "y"), (6, "Q", "z"), (7, None, None)], "doc_id long, text string, component_id string")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_dup.near_duplicates(df).collect()), key=str)
    # the null id comes before all others; id 5 links its two texts' classes
    assert got == sorted([(None, 2, None, True), (5, 2, None, False), (5, 1, None, False), (6, 1, None, False), (7, 0, 7, True)], key=str)
    assert near_dup.near_duplicates(df.limit(0)).count() == 0
    left = near_dup.drop_near_duplicates(df)
    assert left.columns == df.columns and sorted(r.doc_id for r in left.filter("doc_id IS NOT NULL").collect()) == [7]


def test_shingle_hashes_follow_the_words():
    import numpy as np

    texts = ["a b c d e", "A  B\tc\nd e", "b a c d e", "", "x", "X ", "a b c d e f"]
    raw = [t.encode() for t in texts]
    offsets = np.cumsum([0, *map(len, raw)])
    sets = [tuple(s) for s in shingles.shingle_sets(np.frombuffer(b"".join(raw), np.uint8), offsets)]
    assert sets[0] == sets[1] != sets[2] and sets[3] == () and sets[4] == sets[5] and len(sets[6]) == 2 and set(sets[0]) < set(sets[6])


def test_components(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(i, i + 1) for i in range(300, 340)]
    root = {}

    def find(i):
        root.setdefault(i, i)
        while root[i] != i:
            i = root[i]
        return i

    for a, b in edges:
        if a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: find(i) for i in root}


def removed_lines(rows, window=3):
    """(text without later occurrences of repeated windows, lines, lines removed) by document."""
    seen, out = set(), {}
    cut: dict = {}
    for i, t in sorted(rows, key=lambda r: r[0]):
        ls = t.split("\n") if t is not None else []
        cut[i] = set()
        for k in range(len(ls) - window + 1):
            w = tuple(ls[k : k + window])
            if not any(x.strip(" ") for x in w):
                continue
            if w in seen:
                cut[i] |= set(range(k, k + window))
            seen.add(w)
        out[i] = (None if t is None else "\n".join(x for k, x in enumerate(ls) if k not in cut[i]), len(ls), len(cut[i]))
    return out


def test_line_dedup_equals_brute_force(documents, corpus):
    got = {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in line_dedup.dedup_lines(documents.select("doc_id", "text")).collect()}
    want = removed_lines(corpus)
    assert got == want and sum(w[2] for w in want.values()) > 50


def test_line_dedup_odd_cases(spark, monkeypatch):
    rows = [(1, "a\nb\nc\nx"), (2, "y\na\nb\nc"), (3, "a\nb\nc\na\nb\nc"), (4, "\n\n\n\n"), (5, "a\nb"), (6, None), (7, "")]
    df = spark.createDataFrame([(*r, "keep", i) for i, r in enumerate(rows)], "doc_id long, text string, n_lines string, extra int")
    got = {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in line_dedup.dedup_lines(df).collect()}
    assert got == removed_lines(rows) and got[3][0] == "" and got[2][0] == "y"
    assert line_dedup.dedup_lines(df).columns == ["doc_id", "text", "extra", "n_lines", "n_removed"]
    assert line_dedup.dedup_lines(df.limit(0)).count() == 0
    again = spark.createDataFrame([(None, "a\nb\nc"), (1, "a\nb\nc"), (1, "a\nb\nc"), (2, "a\nb\nc")], "doc_id long, text string")
    assert sorted((r.doc_id is None, r.n_removed) for r in line_dedup.dedup_lines(again).collect()) == [(False, 3), (False, 3), (False, 3), (True, 0)]
    monkeypatch.setattr(common, "BROADCAST_ROWS", 0)  # the way for long lists
    assert {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in line_dedup.dedup_lines(df).collect()} == removed_lines(rows)


def test_line_dedup_writes_few_scratch_files(spark):
    """One file for each of many shuffle partitions starts several processes for each on a local file system."""
    rows = [(i, f"x{i}\n" + "\n".join(f"{i % 300} {k}" for k in range(4))) for i in range(900)]
    set_before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    mark = common.scratch_mark()
    try:
        spark.conf.set("spark.sql.shuffle.partitions", 96)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        got = {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    finally:
        for k, v in set_before.items():
            spark.conf.set(k, v)
    assert got == removed_lines(rows)
    written = [len(list(pathlib.Path(f.removeprefix("file://")).rglob("part-*.parquet"))) for f in common._written[mark:]]
    assert len(written) == 2 and max(written) <= max(6, spark.sparkContext.defaultParallelism)


def bench_words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(ASCII_LOWER))


def contaminated(docs, items, window=10):
    out = {}
    for i, t in docs:
        w, hit, found = bench_words(t), set(), set()
        for item, it in items:
            b = bench_words(it)
            n = min(window, len(b))
            for s in range(len(b) - n + 1 if n else 0):
                for k in range(len(w) - n + 1):
                    if w[k : k + n] == b[s : s + n]:
                        hit |= set(range(k, k + n))
                        found.add(str(item))
        out[i] = (len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit))
    return out


@pytest.fixture(scope="module")
def planted(corpus):
    rng = random.Random(6)
    items = []
    for k in range(25):
        w = bench_words(rng.choice([t for _, t in corpus if t and len(t) > 80]))
        a = rng.randrange(max(1, len(w) - 14))
        items.append((100 + k, " ".join(w[a : a + rng.choice([3, 9, 10, 11, 14])]).upper() + "!"))
    return [*items, (1, None), (2, "..."), (3, "never-seen words zzz qqq"), (4, "w w w w w w w w w w w"), (100, "one two")]


def digest(df):
    return {r.doc_id: (r.n_words, r.n_hit, r.n_items, hashlib.sha256(",".join(r["items"]).encode()).hexdigest(), r.contaminated) for r in df.collect()}


def test_decontamination_equals_brute_force(spark, documents, corpus, planted, monkeypatch):
    items = spark.createDataFrame(planted, "item_id long, text string")
    docs = [(i, t) for i, t in corpus]
    want = contaminated(docs, planted)
    assert digest(decontaminate.contamination(documents, items)) == want and sum(w[4] for w in want.values()) > 10
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(common, "BROADCAST_ROWS", 0)
    assert digest(decontaminate.contamination(documents, items)) == want


def test_decontamination_odd_cases(spark):
    items = spark.createDataFrame([(None, "aa bb"), (7, "cc")], "item_id long, text string")
    docs = spark.createDataFrame([(None, "x AA-bb y", 1), (1, None, 2), (1, "cc", 3), (2, "", 4)], "doc_id long, text string, n_hit int")
    got = sorted((str(r.doc_id), r.n_words, r.n_hit, r.n_items) for r in decontaminate.contamination(docs, items).collect())
    assert got == [("1", 0, 0, 0), ("1", 1, 1, 1), ("2", 0, 0, 0), ("None", 4, 2, 0)]
    assert decontaminate.contamination(docs.limit(0), items).count() == 0
    assert not decontaminate.contamination(docs, items.limit(0)).filter("contaminated").count()


def test_proximity(spark):
    items = spark.createDataFrame([(1, "alpha beta gamma the")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "gamma x alpha y the beta"), (2, "alpha " + "x " * 20 + "beta gamma the"), (3, "the the")], "doc_id long, text string")
    got = decontaminate.proximity_matches(docs, items, terms=3, span=6).collect()
    assert [(r.id, r.item, r.first) for r in got] == [(1, 1, 0)]


def test_plans_stay_native(documents, spark):
    items = spark.createDataFrame([(1, "ta ko mi")], "item_id long, text string")
    for df in (decontaminate.contamination(documents, items), line_dedup.dedup_lines(documents)):
        assert not re.search("Python|Pandas|Arrow", df._jdf.queryExecution().executedPlan().toString())


def test_scratch_goes_to_the_shared_folder(spark):
    path = common.scratch_path(spark, "t")
    assert path.startswith(common.shared_dir(spark)) and common.materialise(spark.range(3), "t").count() == 3
    assert F.lit(1) is not None


def test_any_extra_column_passes_through(spark):
    """Names that the operators use inside, as columns of the table."""
    from voxlake.llm import langid, quality

    extra = "id key h g at w n y cut cut_row hit_id hit_row gone_id label_id entropy low node component token words sid first last"
    rows = [(i, t) for i, t in enumerate(["a b c d e f\nx\ny", "a b c d e f\nx\ny", "q\nr\ns", None])]
    df = spark.createDataFrame([(i, t, *(f"{c}{i}" for c in extra.split())) for i, t in rows], "doc_id long, text string, " + ", ".join(f"{c} string" for c in extra.split()))
    items = spark.createDataFrame([(1, "q r")], "item_id long, text string")
    labels = spark.createDataFrame([(0, 1), (2, 0)], "doc_id long, quality int")
    model = quality.train(df, labels)
    models = langid.train(df.withColumn("lang", F.lit("xx")))
    for out in (line_dedup.dedup_lines(df), decontaminate.contamination(df, items), near_dup.drop_near_duplicates(df), quality.quality_scores(df, model), langid.identify(df, models)):
        for r in out.collect():
            assert all(r[c] == f"{c}{r.doc_id}" for c in extra.split())
