"""Language ID, quality, packing, token output, chat and page text: brute force, round trips and held-out accuracy."""

from __future__ import annotations

import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from voxlake.llm import chat, common, html, image_copies, langid, packing, quality, template, token_output, tokens

LANGS = {"xx": ("ka ko ki sha tor", "kasho torki shako"), "yy": ("ñu lé mo vöt", "moñu vötlé lému")}


def sentence(rng, lang, n):
    parts = LANGS[lang][0].split()
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randint(1, 3))) for _ in range(n))


def labelled(spark, n=160):
    rng = random.Random(8)
    rows = [(i, sentence(rng, lang, rng.randint(8, 60)).capitalize(), lang) for i in range(n) for lang in [("xx", "yy")[i % 2]]]
    return spark.createDataFrame([*rows, (900, None, "xx"), (901, "123 !?", "xx"), (902, "", None), (903, "shakotor kiko", None)], "doc_id long, text string, lang string")


def test_language_of_held_out_texts(spark):
    df = labelled(spark)
    models = langid.train(df.filter("doc_id % 4 <> 2"))
    got = {r.doc_id: r for r in langid.identify(df, models, reject=False).collect()}
    held = [i for i in range(160) if i % 4 == 2]
    assert all(got[i].lang_pred == ("xx", "yy")[i % 2] for i in range(160)) and held and all(0 <= r.score <= 1 for r in got.values())
    assert [(got[i].lang_pred, got[i].score) for i in (900, 901, 902)] == [("und", 0.0)] * 3 and got[903].lang_pred == "xx"
    strange = spark.createDataFrame([(1, "ωψφ χξ ωωψ ζζξ"), (2, "moñu vötlé")], "doc_id long, text string")
    said = {r.doc_id: r.lang_pred for r in langid.identify(strange, models).collect()}
    assert said == {1: "und", 2: "yy"}
    assert langid.identify(df.limit(0), models).count() == 0
    assert langid.train(df.filter("lang IS NULL")) is None and {r.lang_pred for r in langid.identify(df, None).collect()} == {"und"}


def kneser_ney(counts: dict[str, int], order: int):
    """The model by definition, over dictionaries: (n-gram -> probability by order, context -> back-off weight by order)."""
    marked = {f"^{w}$": c for w, c in counts.items()}
    raw: list[dict] = []
    for n in range(1, order + 1):
        d: dict = {}
        for w, c in marked.items():
            for i in range(max(n - 1, 1), len(w)):
                g = w[i - n + 1 : i + 1]
                d[g] = d.get(g, 0) + c
        raw.append(d)
    probs, weights, below = [], [], None
    for n in range(1, order + 1):
        d = dict(raw[n - 1])
        if n < order:
            for g in d:
                if not (n > 1 and g[0] == "^"):
                    d[g] = max(1, sum(1 for x in raw[n] if x[1:] == g))
        one, two = (sum(1 for v in d.values() if v == k) for k in (1, 2))
        discount = one / (one + 2 * two) if one and two else 0.5
        total, kinds = {}, {}
        for g, v in d.items():
            total[g[:-1]] = total.get(g[:-1], 0) + v
            kinds[g[:-1]] = kinds.get(g[:-1], 0) + 1
        weights.append({h: discount * kinds[h] / total[h] for h in total})
        below = {g: max(v - discount, 0) / total[g[:-1]] + weights[-1][g[:-1]] * (1 / (len(d) + 1) if n == 1 else probs[-1][g[1:]]) for g, v in d.items()}
        probs.append(below)
    return probs, weights


def test_kneser_ney_by_definition():
    rng = random.Random(3)
    counts = {w: rng.randint(1, 4) for w in sentence(rng, "xx", 60).split() + sentence(rng, "yy", 20).split()}
    for order in (2, 4):
        probs, weights = kneser_ney(counts, order)
        models = langid.Models.merge({"xx": langid.fit_language(counts, order)}, order)
        for n in range(1, order + 1):
            assert np.allclose(sorted(np.exp(models.levels[n - 1][1][:, 0])), sorted(probs[n - 1].values()), rtol=1e-4)
        for word in ["kasho", "zz", "toka", "ñ", "moñukakakashotor"]:
            w, total = f"^{word}$", 0.0
            for i in range(1, len(w)):
                p = 1 / (len(probs[0]) + 1)
                for n in range(1, min(order, i + 1) + 1):
                    g, h = w[i - n + 1 : i + 1], w[i - n + 1 : i]
                    p = probs[n - 1].get(g, weights[n - 1].get(h, 1.0) * p)
                total += math.log(p)
            assert models.score([word])[0][0, 0] == pytest.approx(total, rel=1e-3)


def quality_rows(spark, n=400):
    rng = random.Random(9)
    rows, marks = [], []
    for i in range(n):
        good = i % 4 != 0
        words = [sentence(rng, "xx", 1) for _ in range(rng.randint(3, 120))]
        text = " ".join(words) if good else " ".join(w.upper() + "!!" for w in words) if i % 8 else " | ".join(words)
        rows.append((i, text + "."))
        marks.append((i, int(good), 0))
    return spark.createDataFrame([*rows, (900, None), (901, "")], "doc_id long, text string"), spark.createDataFrame([*marks, (900, None, 1), (5000, 1, 0), (1, 1, 0)], "doc_id long, quality int, toxic int")


def test_quality_of_held_out_texts(spark):
    docs, labels = quality_rows(spark)
    model = quality.train(docs, labels, allowed=labels["doc_id"] % 3 != 1)
    got = {r.doc_id: r.score for r in quality.quality_scores(docs.withColumn("score", docs.doc_id), model).collect()}
    right = [(got[i] >= 0.5) == (i % 4 != 0) for i in range(400) if i % 3 == 1]
    assert sum(right) >= 0.98 * len(right) and all(0 <= s <= 1 for s in got.values()) and got[900] == got[901]
    nothing = quality.train(docs, labels.limit(0))
    assert {r.score for r in quality.quality_scores(docs, nothing).collect()} == {0.5}
    one_kind = quality.train(docs, labels.filter("quality = 1"))
    assert len({r.score for r in quality.quality_scores(docs, one_kind).collect()}) == 1
    assert quality.quality_scores(docs.limit(0), model).count() == 0


def test_additive_model_learns_an_interaction():
    rng = np.random.default_rng(1)
    x = rng.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    plain, pairs = quality.fit(x, y, rounds=20, pairs=0), quality.fit(x, y, rounds=20, pairs=1, pair_rounds=80)
    right = lambda m: ((m.score(x) > 0.5) == y).mean()
    assert right(plain) < 0.65 and right(pairs) > 0.95 and pairs.pairs == [(0, 1)]


def test_features_do_not_depend_on_neighbours():
    texts = ["A b!", "", "ünï cödé | x\nx x", "z" * 300, " "]
    raw = [t.encode() for t in texts]
    together = quality.features(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    for t, row in zip(raw, together, strict=True):
        alone = quality.features(np.frombuffer(t, np.uint8), np.array([0, len(t)]))[0]
        assert np.allclose(alone, row) or not t.strip()


@pytest.fixture(scope="module")
def vocabularies():
    return pytest.importorskip("public_tokenizers").path


TEXTS = st.text(st.sampled_from("ab's tmdrevlABÉé×½²  \n\t12!.,中İ\x00\x1c\x85\xa0|<>") | st.characters(codec="utf-8"), max_size=60)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
@pytest.mark.parametrize("slots", [1 << 10, 64])
def test_fast_encoder_equals_the_library(vocabularies, name, slots):
    fast, plain = tokens.Encoder(vocabularies(name), slots), tokens.Encoder(vocabularies(name), 0)
    assert fast.by_word is not None and plain.by_word is None

    @settings(max_examples=150, deadline=None)
    @given(st.lists(TEXTS, max_size=8))
    def same(texts):
        for a, b in zip(fast(texts), plain(texts), strict=True):
            assert a.tolist() == b.tolist()

    same()
    odd = ["<|endoftext|> a", "x<|startoftext|>", None, "", "'s", "it's we'll 're'd", "\n\n a  \n", "a\tb  c "]
    assert [x.tolist() for x in fast(odd)] == [x.tolist() for x in plain(odd)]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_long_texts_are_cut_where_it_makes_no_difference(vocabularies, name, monkeypatch):
    monkeypatch.setattr(tokens, "BATCH", 40)
    rng = random.Random(2)
    texts = ["".join(rng.choices(["word ", "it's ", "  ", "\n", "a b", "12 ", "!! x", "É"], k=rng.randint(1, 120))) for _ in range(60)]
    fast, plain = tokens.Encoder(vocabularies(name)), tokens.Encoder(vocabularies(name), 0)
    assert [x.tolist() for x in fast(texts)] == [x.tolist() for x in plain(texts)]


def test_long_texts_are_hashed_in_blocks(monkeypatch):
    from voxlake.llm import shingles

    raw = [("ab cde f\n" * 50 + "x" * 90 + " tail").encode(), b"", b"one two"]
    data, offsets = np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])
    whole = shingles.word_hashes(data, offsets)
    monkeypatch.setattr(shingles, "BLOCK", 16)
    parts = shingles.word_hashes(data, offsets)
    assert all((a == b).all() for a, b in zip(whole, parts, strict=True))


def test_token_files_round_trip(spark, documents, corpus, vocabularies, tmp_path, monkeypatch):
    monkeypatch.setattr(token_output, "FILE_BYTES", 20_000)
    path, vocabulary = str(tmp_path / "tokens"), vocabularies("byte_bpe_50k.json")
    token_output.write_tokens(documents, path, vocabulary, end_id=2, row_group_bytes=1 << 16)
    plain, start = tokens.Encoder(vocabulary, 0), 0
    want = {}
    for (i, _), ids in zip(corpus, plain([t for _, t in corpus]), strict=True):
        ids = [*ids.tolist(), 2]
        want[i] = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in token_output.read_back(spark, path).collect()} == want
    import pyarrow.parquet as pq

    files = sorted((tmp_path / "tokens").glob("part-*.parquet"))
    assert len(files) > 1
    meta = pq.ParquetFile(files[0]).metadata.row_group(0)
    by_name = {meta.column(k).path_in_schema: meta.column(k) for k in range(meta.num_columns)}
    ids = next(c for p, c in by_name.items() if p.startswith("ids"))
    assert any("DICTIONARY" in e for e in ids.encodings) and "DELTA_BINARY_PACKED" in by_name["doc_id"].encodings and by_name["doc_id"].has_offset_index
    empty = str(tmp_path / "none")
    token_output.write_tokens(documents.limit(0), empty, vocabulary, end_id=2)
    assert token_output.read_back(spark, empty).count() == 0


def check_pieces(rows, docs, window):
    by_doc: dict = {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        assert r.doc_tokens == len(docs[r.doc_id]) and r.ids_crc32 == zlib.crc32(np.array(docs[r.doc_id][r.start : r.start + r.length], "<u4").tobytes())
    assert by_doc.keys() == docs.keys()
    for i, own in by_doc.items():
        own.sort(key=lambda r: r.start)
        assert [r.start for r in own] == [sum(x.length for x in own[:k]) for k in range(len(own))] and sum(r.length for r in own) == len(docs[i])
    sequences: dict = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append(r)
    for own in sequences.values():
        own.sort(key=lambda r: r.offset)
        total = sum(r.length for r in own)
        assert [r.offset for r in own] == [sum(x.length for x in own[:k]) for k in range(len(own))] and (total == window or total & (total - 1) == 0 and total < window)


def test_packing_places_every_token_once(spark, documents, corpus, vocabularies):
    vocabulary = vocabularies("word_bpe_49k.json")
    plain = tokens.Encoder(vocabulary, 0)
    docs = {i: [*x.tolist(), 2] for (i, _), x in zip(corpus, plain([t for _, t in corpus]), strict=True)}
    for shard in (2_000, 1 << 20):
        rows = packing.pack_documents(documents, vocabulary, window=512, shard_bytes=shard, with_ids=True).collect()
        check_pieces(rows, docs, 512)
        assert all(r.ids == docs[r.doc_id][r.start : r.start + r.length] for r in rows)
    assert packing.pack_documents(documents.limit(0), vocabulary).count() == 0


def test_neighbours_share_words():
    rng = np.random.default_rng(3)
    docs = [np.concatenate([rng.integers(0, 40, 20), 1000 + k % 6 * 50 + rng.integers(0, 50, 60)]).astype(np.int32) for k in range(60)]
    index = packing.Index(docs, 24)
    for seed in range(12):
        near = [d for d in index.neighbours(seed) if d != seed][:5]
        assert all(d % 6 == seed % 6 for d in near)
    sequences = packing.pack(docs, 400, 24)
    same = [len({d % 6 for d, _, _ in s}) == 1 for s in sequences[:8]]
    assert sum(same) >= 6


def turns_of(rows):
    out: dict = {}
    for c, t, r, x in rows:
        out.setdefault(c, []).append((t if t is not None else -1, r or "", x or ""))
    return {c: [(r, x) for _, r, x in sorted(v)] for c, v in out.items()}


def test_chat_round_trip(spark):
    said = "\\### Assistant: </turn> ok"
    rows = [(1, 0, "system", ""), (1, 1, "user", said), (1, 2, "assistant", said), (2, 0, "assistant", "a\n</turn>\n### user: x</turn>\n"), (2, 0, "assistant", "b"), (None, None, None, None), (3, 5, "we:ird\\ ro</turn>le", "é中" * 70000), (3, 6, "assistant", "\\" * 9 + "#####")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, part string")
    formatted = chat.format_conversations(df)
    want = {}
    for c, own in turns_of(rows).items():
        loss = "".join(x for r, x in own if r == "assistant")
        want[c] = (len(own), hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in own).encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    for ordered in (True, False):
        got = {r.conv_id: r for r in chat.read_conversations(formatted, ordered=ordered).collect()}
        assert {c: tuple(r)[1:5] for c, r in got.items()} == want
    sizes = {c: sum(14 + len(chat.guard_role(r)) + len(chat.guard(x)) for r, x in own) for c, own in turns_of(rows).items()}
    assert {c: r.formatted_chars for c, r in got.items()} == sizes
    assert chat.read_conversations(chat.format_conversations(df.limit(0))).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.text(st.sampled_from("\\#</turn>: \nab"), max_size=20), st.text(st.sampled_from("\\#</turn>: \nab"), max_size=40), st.booleans()), max_size=5), st.integers(1, 50))
def test_any_text_comes_back(turns, limit):
    messages = [{"role": "assistant" if m else r, "text": x} for r, x, m in turns]
    reader, got = chat.Reader(), []
    for text, spans in chat.parts(chat.chat_template().render({"messages": messages}), limit):
        got += reader.feed(text, spans)
    reader.close()
    assert got == [(m["role"], m["text"], m["text"] if m["role"] == "assistant" else "") for m in messages]


def render(source, **context):
    return "".join(t for t, _ in template.compile_template(source).render(context))


def test_template_language():
    assert render("{{ 'a' ~ 1 + 2 | length if false else x.y['z'] }}", x={"y": {"z": "ok"}}) == "ok"
    assert render("{% for m in ms %}{{ loop.index }}{{ m }}{% if not loop.last %}, {% endif %}{% endfor %}", ms=iter("abc")) == "1a, 2b, 3c"
    assert render("{% if x %}{{ 1 | length }}{% endif %}ok", x=0) == "ok"
    assert render("a {%- if x == 1 -%} b {%- elif x %} c {%- else %} d{% endif %}", x=2) == "a c"
    assert render("{% set n = 'v' | upper %}{{ n }}{# nothing #}{{ none }}{{ missing }}") == "V"
    folded = template.compile_template("{{ 'a' ~ 'b' }}{% if 1 == 2 %}x{% else %}c{% endif %}{{ y }}").tree
    assert folded[0] == template.Text("abc") and len(folded) == 2
    marked = list(template.compile_template("x{% generation %}{{ t }}{% endgeneration %}y").render({"t": "T"}))
    assert marked == [("x", False), ("T", True), ("y", False)]


@pytest.mark.parametrize("source", ["{{ x.__class__.__mro__ }}", "{{ x() }}", "{% if x %}", "{% import os %}", "{{ a | nofilter }}", "{{ 1 + }}", "{{ 'a }}", "{% endfor %}", "{{ x.real }}"])
def test_templates_reach_nothing_else(source):
    with pytest.raises(template.TemplateError):
        list(template.compile_template(source).render({"x": 1}))


PAGE = (
    "<!doctype html><html><head><title>T</title><style>p{}</style><script>var a='<p>no</p>';</script></head><body class='page'><header class='site-header'>Site</header><nav>menu</nav>"
    "<div class='cookie-notice'>We use</div><div id=content><h1>Title %d</h1><p>One &amp; two&nbsp;%d <b>bo</b>ld<br>x &lt;y&gt;<p>Open\n\n paragraph %d<ul><li>a %d<li>b %d</ul><form>f</form></div>"
    "<aside>s</aside><section id=comments><p>hi</p></section><p>Always the same</p><footer>f</footer></body></html>"
)


def test_page_text(spark):
    pages = [(i, "http://Host.example/%d" % i, PAGE % (i, i, i, i, i)) for i in range(6)]
    pages += [(10, "http://other/", "<body><article><h1>A</h1><p>b</p><div class='ad'>no</div><section class='reader-comments'>c</section></article><p>out</p>"), (11, None, None), (12, "x", ""), (13, "http://other/", "plain &copy; text &amp"), (0, "http://Host.example/0", PAGE % (0, 0, 0, 0, 0))]
    df = spark.createDataFrame([(*p, "t") for p in pages], "page_id long, url string, html string, text string")
    got = {r.page_id: r.text for r in html.main_text(df).collect()}
    for i in range(6):
        assert got[i] == f"Title {i} One & two {i} bold x <y> Open paragraph {i} a {i} b {i}"
    assert got[10] == "A b" and got[11] == got[12] == "" and got[13] == "plain © text &"
    assert html.main_text(df).count() == len(pages) and html.main_text(df.limit(0)).count() == 0


def test_runs_of_letters_have_no_inner_edges(monkeypatch):
    """A run of 500 letters is learned and scored as one word; only beyond LONGEST is it cut, alike on both sides."""
    import pyarrow as pa

    rng = np.random.default_rng(3)
    run = "".join(rng.choice(list("abcdefg"), 500))
    fit = lambda t: langid._fit_group([pa.scalar("x")], pa.table({"text": [t]}), 3)["parts"].to_pylist()
    as_bytes = lambda levels: [[np.ascontiguousarray(x).tobytes() for level in levels for x in level]]
    assert fit(run) == as_bytes(langid.fit_language({run: 1}, 3)) != fit(f"{run[:64]} {run[64:]}")
    models = langid.Models.merge({"x": langid.fit_language({run: 1, "abc": 2}, 3), "y": langid.fit_language({"gfe": 3, "abab": 1}, 3)}, 3)
    total, sizes = models.score([run])
    monkeypatch.setattr(langid, "TOGETHER", 100)
    assert np.allclose(langid.Scorer(models)([run, f"{run} abc", run])[0], -total[0] / sizes[0])
    monkeypatch.setattr(langid, "LONGEST", 64)
    assert fit(run) == fit(" ".join(run[i : i + 64] for i in range(0, 500, 64)))


def page_texts(spark, pages):
    df = spark.createDataFrame([(i, u, h) for i, (u, h) in enumerate(pages)], "page_id long, url string, html string")
    return [r.text for r in html.main_text(df).orderBy("page_id").collect()]


def test_template_inside_article(spark):
    """Constant blocks without a telling class, at the end and amid the paragraphs."""
    pages = [("http://h/", f"<body><article><h1>T{i}</h1>" + "".join(f"<p>w{i} {j}</p>" for j in range(i)) + "<p>Read more of us</p>" + "".join(f"<p>v{i} {j}</p>" for j in range(3)) + "<p>Tell a friend</p></article></body>") for i in range(8)]
    for i, text in enumerate(page_texts(spark, pages)):
        assert text == " ".join([f"T{i}", *[f"w{i} {j}" for j in range(i)], *[f"v{i} {j}" for j in range(3)]])


def test_template_of_small_hosts_and_layouts(spark):
    """Hosts of three pages always have a wrapper; a host's layouts each have their own."""
    pages = [(f"http://h{k}/", f"<body><div id=c><p>a{k} {i}</p></div><p>Same {k}</p></body>") for k in range(12) for i in range(3)]
    pages += [(None, f"<body><div id=x{k}><p>b{k} {i}</p><p>Foot {k}</p></div></body>") for k in range(3) for i in range(12)]
    want = [f"a{k} {i}" for k in range(12) for i in range(3)] + [f"b{k} {i}" for k in range(3) for i in range(12)]
    assert page_texts(spark, pages) == want


def test_template_after_long_lists(spark):
    """Constant blocks after more than 60 children, more than 2000 of them, are found."""
    pages = [("http://h/", "<body><div id=c>" + "".join(f"<p>p{i} {j}</p>" for j in range(70 + i)) + "".join(f"<div>Foot {j}</div>" for j in range(2100)) + "</div></body>") for i in range(4)]
    assert page_texts(spark, pages) == [" ".join(f"p{i} {j}" for j in range(70 + i)) for i in range(4)]


def test_broken_pages():
    deep = "<div>" * 20_000 + "<p>in" + "</div>" * 20_000 + "<p>out"
    assert html.extract(deep) == "in out"
    assert html.extract('<p>a<a href="x>b</a> c <b>d') == "ab c d"
    assert html.extract("<p " * 3000 + '"' * 5001).startswith("<p <p") and html.extract("<!-- open <p>x") == "" and html.extract("a < b > c") == "a < b > c"
    assert html.induce([deep, deep + "x", deep + "y"]) is not None


def plain_matching(a, b):
    if a.tag != b.tag or a.mark != b.mark:
        return 0
    xs, ys = ([c for c in n.children if isinstance(c, html.Node)] for n in (a, b))

    def best(i, j):
        return 0 if not i or not j else max(best(i - 1, j), best(i, j - 1), best(i - 1, j - 1) + plain_matching(xs[i - 1], ys[j - 1]))

    return 1 + best(len(xs), len(ys))


def test_tree_matching():
    rng = random.Random(5)

    def tree(depth):
        return html.Node(rng.choice("abc"), "", False, [tree(depth - 1) for _ in range(rng.randint(0, 3))] if depth else [])

    for _ in range(60):
        a, b = tree(2), tree(2)
        found: list = []
        assert html.matching(a, b, found) == plain_matching(a, b) == len(found)


def test_image_copies(spark):
    rng = np.random.default_rng(12)
    base = [image_copies._box(rng.normal(128, 300, (80, 96)), 2).clip(0, 255).round() for _ in range(12)]
    rows = [(i, image_copies.encode_pgm(b)) for i, b in enumerate(base)]
    rows += [(100 + i, image_copies.encode_pgm(np.rot90(base[i][6:74, 8:90], i % 4) * 0.7 + 20 + rng.normal(0, 1.5, np.rot90(base[i][6:74, 8:90], i % 4).shape))) for i in range(8)]
    rows += [(200, rows[3][1]), (201, None), (202, b"junk"), (203, image_copies.encode_pgm(np.full((60, 60), 9.0))), (204, b""), (None, rows[5][1])]
    df = spark.createDataFrame(rows, "image_id long, image binary")
    got = [tuple(r) for r in image_copies.image_copies(df).collect()]
    component = {r[0]: r[2] for r in got if r[0] is not None}
    assert all(component[100 + i] == component[i] for i in range(8)) and len({component[i] for i in range(12)}) == 12
    assert component[200] == 3 and component[201] == component[204] == 201 and component[202] == 202 and component[203] == 203
    assert [r[1] for r in got if r[0] is None] == [None] and component[5] is None
    assert image_copies.image_copies(df.limit(0)).count() == 0


def test_png_is_read():
    import struct

    pixels = np.random.default_rng(1).integers(0, 256, (9, 11, 3), np.uint8)
    chunk = lambda k, d: struct.pack(">I", len(d)) + k + d + struct.pack(">I", zlib.crc32(k + d))
    lines, above = [], np.zeros((11, 3), np.int64)
    for y, row in enumerate(pixels.astype(np.int64)):
        left, corner = (np.vstack([np.zeros((1, 3), np.int64), r[:-1]]) for r in (row, above))
        kind = y % 5
        if kind == 4:
            p = left + above - corner
            a, b, c = abs(p - left), abs(p - above), abs(p - corner)
            guess = np.where((a <= b) & (a <= c), left, np.where(b <= c, above, corner))
        else:
            guess = [0 * row, left, above, (left + above) >> 1][kind]
        lines.append(bytes([kind]) + ((row - guess) & 255).astype(np.uint8).tobytes())
        above = row
    raw = b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", 11, 9, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(b"".join(lines))) + chunk(b"IEND", b"")
    assert np.allclose(image_copies.decode(raw), pixels.mean(axis=2), atol=1e-4)
    assert image_copies.decode(raw[:40]) is None


def test_batches_are_only_made_smaller(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, 50)
    common.bounded_batches(spark, 512)
    assert spark.conf.get(key) == "50"
    spark.conf.set(key, before)
