"""Benchmark decontamination by a distributed positional inverted index. DataFrame operations only.

Test items are cut into windows of `window` consecutive words (an item with fewer words is one window). Each window is
looked up by its rarest word, by counts over the whole training table: the index holds a posting (term, document,
position, words around it) for every occurrence of those words. Around a posting, document and item are compared word
by word, left and right of the shared term (the offset-adjusted intersection); a run that spans a window is an exact
match, and its words are hit. A window with a word that never occurs in the training table is dropped at once.

Proximity matches (`proximity_matches`) intersect postings of an item's rarest words within a span of positions.

Defined results: null text has no words; empty tables give empty results or no hits; items with the same id count as
one item; rows that share doc_id and text get the same result; null ids are kept (null equals null in joins); other
columns are ignored. Very long texts are one row, as everywhere in Spark.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from voxlake.llm.common import BROADCAST_ROWS, materialise, row_key, small_side

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What separates words: all ASCII but digits and lower-case letters.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Lower-cased (A-Z only) words of a text; null has none."""
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.array_remove(F.split(lowered, SEPARATORS, -1), "")


def item_texts(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per item text that has words: item, part (tells an item's text from all others), ws, n."""
    return (
        items.select(F.col(id_col).alias("item"), F.col(text_col).alias("t")).distinct()
        .select("item", F.xxhash64("item", "t").alias("part"), words_of(F.col("t")).alias("ws"))
        .filter(F.size("ws") > 0).withColumn("n", F.size("ws"))
    )


def item_words(texts: DataFrame) -> DataFrame:
    """One row per item text and word: item, part, n, at, word."""
    return texts.select("item", "part", "n", F.posexplode("ws").alias("at", "word"))


def around(words: str, at: str, reach: int) -> tuple[Column, Column]:
    """Up to `reach` words before (nearest first) and after position `at` of an array."""
    ws, p = F.col(words), F.col(at)
    before = F.reverse(F.slice(ws, F.greatest(p - reach, F.lit(0)) + 1, F.least(p, F.lit(reach))))
    return before, F.slice(ws, p + 2, F.lit(reach))


def common_prefix(a: Column, b: Column) -> Column:
    same = F.zip_with(a, b, lambda x, y: x.eqNullSafe(y))
    first = F.array_position(same, False)
    return F.when(first == 0, F.size(same)).otherwise(first - 1).cast("int")


def term_counts(docs: DataFrame, terms: DataFrame, text_col: str) -> DataFrame:
    """Occurrences in the training table of each of `terms` (column word)."""
    rows = terms.count()
    # the outer form: the other one makes Spark split every text twice, for a filter on its size
    found = docs.select(F.explode_outer(words_of(F.col(text_col))).alias("word")).withColumn("w", F.xxhash64("word"))
    small = terms.select(F.col("word").alias("term"), F.xxhash64("word").alias("h"))
    return (
        found.join(small_side(small, rows), (F.col("w") == F.col("h")) & (F.col("word") == F.col("term")))
        .groupBy("term").agg(F.count("*").alias("cnt"))
    )


def anchors(texts: DataFrame, items: DataFrame, counts: DataFrame, window: int) -> DataFrame:
    """Positions of item words that are the rarest of some window all of whose words occur in the training table."""
    known = items.join(counts, items.word == counts.term, "left").withColumn("cnt", F.coalesce("cnt", F.lit(0)))
    ahead = W.partitionBy("item", "part").orderBy("at").rowsBetween(0, window - 1)
    rarest = known.withColumn("best", F.min(F.struct("cnt", "at")).over(ahead))
    chosen = (
        rarest.filter((F.col("at") <= F.greatest(F.col("n") - window, F.lit(0))) & (F.col("best.cnt") > 0))
        .groupBy("part").agg(F.collect_set("best.at").alias("ats"))
    )
    # the words of a text meet its positions once, and are cut before the rows are spread
    placed = texts.join(chosen, "part").select("item", "ws", "n", F.explode("ats").alias("at"))
    left, right = around("ws", "at", window - 1)
    return placed.select(
        "item", F.element_at("ws", F.col("at") + 1).alias("term"), F.least("n", F.lit(window)).alias("need"),
        left.alias("item_left"), right.alias("item_right"),
    ).withColumn("h", F.xxhash64("term"))


def postings(docs: DataFrame, terms: DataFrame, *, reach: int, id_col: str, text_col: str) -> DataFrame:
    """The positional index for `terms` (distinct, column term), stored: term, h, id, key, q (position), before, after.

    The word array of a document stays inside one generated loop and never goes into the exploded rows: with a
    broadcast term list the words around a posting are cut out right behind the look-up, and with a shuffled one the
    positions go back to their document and are cut out there.
    """
    rows = terms.count()
    small = terms.select("term", F.xxhash64("term").alias("h"))
    tokens = docs.select(F.col(id_col).alias("id"), row_key(id_col, text_col).alias("key"), words_of(F.col(text_col)).alias("words"))
    if rows <= BROADCAST_ROWS:
        posted = tokens.select("id", "key", "words", F.posexplode_outer("words").alias("q", "word")).withColumn("w", F.xxhash64("word"))
        met = posted.join(F.broadcast(small), (F.col("w") == F.col("h")) & (F.col("word") == F.col("term")))
        before, after = around("words", "q", reach)
        return materialise(met.select("term", "h", "id", "key", "q", before.alias("before"), after.alias("after")), "postings")
    posted = tokens.select("id", "key", F.posexplode_outer("words").alias("q", "word"))
    met = posted.join(small, F.col("word") == F.col("term")).groupBy(F.col("id").alias("at_id"), F.col("key").alias("at_key")).agg(F.collect_list(F.struct("term", "h", "q")).alias("ps"))

    def cut(p):
        before = F.reverse(F.slice("words", F.greatest(p["q"] - reach, F.lit(0)) + 1, F.least(p["q"], F.lit(reach))))
        return F.struct(p["term"].alias("term"), p["h"].alias("h"), p["q"].alias("q"), before.alias("before"), F.slice("words", p["q"] + 2, F.lit(reach)).alias("after"))

    back = tokens.join(met, F.col("id").eqNullSafe(F.col("at_id")) & (F.col("key") == F.col("at_key")))
    found = back.select("id", "key", F.explode(F.transform("ps", cut)).alias("p")).select("p.term", "p.h", "id", "key", "p.q", "p.before", "p.after")
    return materialise(found, "postings")


def phrase_matches(docs: DataFrame, items: DataFrame, *, window: int = 10, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """Exact matches: id, key, item, and first and last hit word position, one row per run of matching words."""
    texts = materialise(item_texts(items, item_id, item_text), "item_texts")
    rows = item_words(texts)
    counts = materialise(term_counts(docs, materialise(rows.select("word").distinct(), "terms"), text_col), "term_counts")
    wanted = materialise(anchors(texts, rows, counts, window), "anchors")
    index = postings(docs, wanted.select("term").distinct(), reach=window - 1, id_col=id_col, text_col=text_col)
    hits = index.join(small_side(wanted), ["h", "term"])
    runs = hits.select(
        "id", "key", "item", "need", "q",
        common_prefix(F.col("before"), F.col("item_left")).alias("l"), common_prefix(F.col("after"), F.col("item_right")).alias("r"),
    )
    # the words around an item's position end with the item, so a run never goes beyond it
    return (
        runs.filter(F.col("l") + F.col("r") + 1 >= F.col("need"))
        .select("id", "key", "item", (F.col("q") - F.col("l")).alias("first"), (F.col("q") + F.col("r")).alias("last"))
    )


def contamination(docs: DataFrame, items: DataFrame, *, window: int = 10, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """Per document: its columns, n_words, n_hit, items (sorted ids as strings), n_items, contaminated."""
    found = materialise(
        phrase_matches(docs, items, window=window, id_col=id_col, text_col=text_col, item_id=item_id, item_text=item_text).distinct(), "matches"
    )
    seen = W.partitionBy("id", "key").orderBy("first", "last").rowsBetween(W.unboundedPreceding, -1)
    union = (
        found.select("id", "key", "first", "last").distinct()
        .withColumn("upto", F.coalesce(F.max("last").over(seen), F.lit(-1)))
        .groupBy("id", "key").agg(F.sum(F.greatest(F.lit(0), F.col("last") - F.greatest(F.col("upto") + 1, F.col("first")) + 1)).alias("n_hit"))
    )
    named = found.groupBy("id", "key").agg(F.sort_array(F.collect_set(F.col("item").cast("string"))).alias("items"))
    hit = union.join(named, union.id.eqNullSafe(named.id) & (union.key == named.key)).select(
        union.id.alias("__hit_id"), union.key.alias("__hit_key"), F.col("n_hit").alias("__n_hit"), F.col("items").alias("__items"))
    hit = small_side(materialise(hit, "hits"))
    keep = [c for c in docs.columns if c not in ("n_words", "n_hit", "items", "n_items", "contaminated")]
    base = docs.select(*keep, F.size(words_of(F.col(text_col))).cast("long").alias("__n_words"), row_key(id_col, text_col).alias("__hit_row"))
    joined = base.join(hit, F.col(id_col).eqNullSafe(F.col("__hit_id")) & (F.col("__hit_row") == F.col("__hit_key")), "left")
    return joined.select(
        *keep, F.col("__n_words").alias("n_words"), F.coalesce("__n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("__items", F.array().cast("array<string>")).alias("items"),
        F.coalesce(F.size("__items"), F.lit(0)).cast("long").alias("n_items"), F.col("__n_hit").isNotNull().alias("contaminated"),
    )


def proximity_matches(docs: DataFrame, items: DataFrame, *, terms: int = 3, span: int = 10, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(id, item, first) where the `terms` rarest distinct words of an item stand, in any order, within `span` words
    that begin at position `first` with one of them. Items with fewer distinct words, or whose words do not occur, give none."""
    rows = item_words(item_texts(items, item_id, item_text))
    counts = materialise(term_counts(docs, materialise(rows.select("word").distinct(), "terms"), text_col), "term_counts")
    rank = W.partitionBy("item", "part").orderBy("cnt", "term")
    rare = (
        rows.select("item", "part", "word").distinct().join(counts, F.col("word") == F.col("term"))
        .withColumn("rn", F.row_number().over(rank)).filter(F.col("rn") <= terms).select("item", "part", "term")
    )
    # an item's terms together with their number: a window, for a join would need null-safe keys
    rare = rare.withColumn("m", F.count("*").over(W.partitionBy("item", "part"))).filter(F.col("m") == terms)
    wanted = materialise(rare.select("item", "part", "term"), "rare_terms")
    posted = docs.select(F.col(id_col).alias("id"), row_key(id_col, text_col).alias("key"), F.posexplode(words_of(F.col(text_col))).alias("q", "word"))
    hits = posted.join(small_side(wanted), F.col("word") == F.col("term"))
    ahead = W.partitionBy("id", "key", "item", "part").orderBy("q").rangeBetween(0, span - 1)
    return (
        hits.withColumn("met", F.size(F.collect_set("term").over(ahead))).filter(F.col("met") == terms)
        .select("id", "item", F.col("q").alias("first")).distinct()
    )
