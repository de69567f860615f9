from __future__ import annotations

import random

import pytest

WORDS = [a + b for a in ("ta", "ko", "mi", "re", "su", "la", "no", "pe") for b in ("", "n", "ra", "ki", "s", "mo", "li", "du", "e", "th")]


@pytest.fixture(scope="session")
def corpus():
    """Small texts with copies, near copies, shared passages, blanks, nulls and odd characters: (doc_id, text)."""
    rng = random.Random(11)
    line = lambda n: " ".join(rng.choice(WORDS) for _ in range(n)).capitalize() + "."
    texts: list = [None, "", "   \n\t ", "One", "one TWO three four", "é É ß 中文 \x00 end", "a b c d e", "a b c d f"]
    base = ["\n".join(line(rng.randint(5, 14)) for _ in range(rng.randint(1, 9))) for _ in range(40)]
    texts += base
    passage = "\n".join(line(20) for _ in range(4))
    for t in base[:12]:
        texts.append(t)
        w = t.split(" ")
        for _ in range(rng.randint(1, 4)):
            w[rng.randrange(len(w))] = rng.choice(WORDS)
        texts += [" ".join(w), t.upper(), t + "\n" + passage, passage + "\n" + t + "\n" + passage]
    long = " ".join(rng.choice(WORDS) for _ in range(4000))
    texts += [long, long + " extra", "w " * 3000]
    return list(enumerate(texts))


@pytest.fixture(scope="session")
def documents(spark, corpus):
    rows = [(i, t, ("en", "fr", None)[i % 3], f"src{i % 4}", len(t or "")) for i, t in corpus]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).cache()
