"""Near-duplicate documents by a signature-coordinate inverted join over MinHash.

1. Every text becomes the set of its distinct 5-word shingles and a signature of 48 coordinates. Documents with equal
   sets are one class from here on, so exact copies cost one row however many they are. A class has a key of its own,
   made from its set, and one of its rows stands for it.
2. Each class is posted under its (coordinate, value) pairs. Pairs met by one class only cannot collide and go; a class
   left with fewer than `matches` postings goes too.
3. A shingle that only one of the remaining classes has is in no intersection. A class of whose shingles more than
   100 - threshold per cent are such goes, which loses no link and takes heavily edited copies out of the lists.
4. Prefix: two classes with at least `matches` collisions share one of the m - matches + 1 rarest of the m postings of
   each; only these are joined. A pair at the threshold of 0.85 agrees in 40.8 of 48 coordinates on average and in fewer
   than 26 with a probability of about 1e-7, which is what the join may lose.
5. Skip: every posting list joins its members to one hub, the class whose postings are the most common ones. Collisions
   of a member and its hub are counted; 26 or more go to the exact check, and what it confirms is merged into components.
6. A pair of one list that is no pair with the hub is found through what sets it apart from the hub. Coordinates in which
   two signatures differ are a metric, so a linked pair is near the hub (NEAR collisions) on both sides, or far from it on
   both: the far members go on as a list of their own, with the next hub. Of two sets A and B near a hub H,
   |A & B| = (|A| + |B| - |A ^ H| - |B ^ H|) / 2 + |(A ^ H) & (B ^ H)|, so a link asks for a known number of shared
   differences, and at least one if A or B is not linked with H. Differences are posted, those that cannot be shared go,
   the rest is cut to a prefix by that number, and again a list joins its members to one hub, merges, and in the end joins
   the pairs of different components that agree in enough differences. So the members of one large group meet only with
   evidence that rules out most pairs, and components grow in between.
7. Candidates are confirmed on the full shingle sets: 100 * intersection >= threshold * union.

Defined results: words are split at ASCII white space and A-Z is lower-cased; a text of 1 to 4 words is one shingle; no
words or null text: an empty set, linked with nothing; ids are whole numbers; rows that share a doc_id (or all with a null
one) count as one node whose sets are all linked; very long texts are hashed in blocks, and a set is one row; other
columns pass through unless they clash with those returned.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from voxlake.llm.common import bounded_batches, materialise, scratch_mark, settled, small_side, spans, text_buffer
from voxlake.llm.graph import by_hub, contracted, hub_rows, in_blocks, within_lists
from voxlake.llm.shingles import mix, shingle_sets, signatures

LOWEST = -(2**63)


def _signed(batches, width: int, coordinates: int):
    for batch in batches:
        data, offsets = text_buffer(batch.column(1))
        n, s1, s2, sig = [], [], [], []
        for a, b in spans(offsets):
            sets = shingle_sets(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], width)
            full = [x for x in sets if len(x)]
            rows = iter(signatures(full, coordinates).view(np.int64)) if full else iter(())
            for x in sets:
                n.append(len(x))
                s1.append(x.sum(dtype=np.uint64))
                s2.append(mix(x ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64))
                sig.append(next(rows) if len(x) else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), pa.array(n, pa.int64()), *(pa.array(np.array(x, np.uint64).view(np.int64)) for x in (s1, s2)), pa.array(sig, pa.list_(pa.int64()))],
            names=["doc_id", "row", "n_shingles", "s1", "s2", "sig"],
        )


def signed(rows: DataFrame, width: int, coordinates: int) -> DataFrame:
    """Per row (doc_id, text, row): its id and key, size of its set, two sums that identify the set, and the signature."""
    bounded_batches(rows.sparkSession)
    return rows.select("doc_id", "text", "row").mapInArrow(lambda it: _signed(it, width, coordinates), "doc_id long, row long, n_shingles long, s1 long, s2 long, sig array<long>")


def _with_sets(batches, width: int):
    for batch in batches:
        data, offsets = text_buffer(batch.column(1))
        for a, b in spans(offsets):
            sets = shingle_sets(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], width)
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array([x.tobytes() for x in sets], pa.binary())], names=["node", "payload"])


def _shared_postings(reps: DataFrame) -> DataFrame:
    """(node, df, token) of the postings that at least two classes have."""
    posted = reps.select("node", F.explode("sig").alias("token"))
    met = posted.groupBy("token").agg(F.count("*").alias("df")).filter("df > 1")
    return posted.join(met, "token")


def candidates(reps: DataFrame, matches: int) -> DataFrame:
    """Classes with enough postings that can collide."""
    return _shared_postings(reps).groupBy("node").agg(F.count("*").alias("m")).filter(F.col("m") >= matches).select("node")


def prefixes(reps: DataFrame, matches: int) -> DataFrame:
    """(node, token, common): the rarest postings of each class, without those that cannot collide, and how common all are."""
    return (
        _shared_postings(reps).groupBy("node").agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("ts"), F.sum("df").alias("common"))
        .filter(F.size("ts") >= matches)
        .select("node", "common", F.explode(F.slice("ts", 1, F.size("ts") - matches + 1)).alias("t")).select("node", "t.token", "common")
    )


def _exploded(batches):
    for batch in batches:
        raw = [np.frombuffer(x.as_buffer(), np.int64) for x in batch.column(1)]
        nodes = np.repeat(batch.column(0).to_numpy(), [len(x) for x in raw])
        yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(np.concatenate(raw) if raw else np.zeros(0, np.int64))], names=["node", "shingle"])


def linkable(sets: DataFrame, threshold: int) -> DataFrame:
    """(node): sets of which enough elements are in some other set too."""
    alone = exploded(sets).groupBy("shingle").agg(F.count("*").alias("c"), F.min("node").alias("node")).filter("c = 1")
    lost = alone.groupBy("node").agg(F.count("*").alias("u"))
    n = (F.length("payload") / 8).cast("long")
    return sets.select("node", n.alias("n")).join(lost, "node", "left").filter(100 * (F.col("n") - F.coalesce("u", F.lit(0))) >= threshold * F.col("n")).select("node")


def exploded(sets: DataFrame) -> DataFrame:
    return sets.select("node", "payload").mapInArrow(_exploded, "node long, shingle long")


def _confirm(batches, threshold: int):
    """Rows come sorted by hub and block, the hub's own row first; yields confirmed links."""
    key = hub = None
    for batch in batches:
        u, v, own, raw = [], [], batch.column(2).to_numpy(zero_copy_only=False), batch.column(4)
        a, blocks, b = batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(3).to_numpy()
        for i in range(batch.num_rows):
            x = np.frombuffer(raw[i].as_buffer(), np.uint64)
            if own[i] == 0:
                key, hub = (a[i], blocks[i]), x.copy()
            elif key == (a[i], blocks[i]):
                small, large = (x, hub) if len(x) < len(hub) else (hub, x)
                if 100 * len(small) < threshold * len(large):
                    continue
                at = np.searchsorted(large, small)
                both = int((large[np.minimum(at, len(large) - 1)] == small).sum())
                if 100 * both >= threshold * (len(x) + len(hub) - both):
                    u.append(a[i])
                    v.append(b[i])
        yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])


def collisions(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """pairs (hub, node) with block, both sizes, and agree: in how many coordinates the signatures agree."""
    dealt = in_blocks(pairs)
    hubs = hub_rows(dealt, reps.select("node", F.col("sig").alias("hub_sig"), F.col("n").alias("hub_n")))
    both = dealt.join(reps.select("node", "sig", "n"), "node").join(hubs, ["hub", "block"])
    agree = F.aggregate(F.zip_with("sig", "hub_sig", lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x)
    return both.select("hub", "block", "node", "n", "hub_n", agree.alias("agree"))


def _sizes_fit(a, b, threshold: int):
    return 100 * F.least(a, b) >= threshold * F.greatest(a, b)


def _differences(batches):
    """Rows come sorted by hub and block, the hub's own row first; yields what each partner's set and the hub's do not share."""
    hub = None
    for batch in batches:
        own, raw = batch.column(2).to_numpy(zero_copy_only=False), batch.column(4)
        a, b = batch.column(0).to_numpy(), batch.column(3).to_numpy()
        held, size = [], 0
        for i in range(batch.num_rows):
            x = np.frombuffer(raw[i].as_buffer(), np.int64)
            if own[i] == 0:
                hub = x.copy()
                continue
            apart = np.setxor1d(x, hub, assume_unique=True)
            held.append((a[i], b[i], apart, len(x)))
            size += len(apart)
            if size >= 1 << 17:
                yield _difference_rows(held)
                held, size = [], 0
        yield _difference_rows(held)


def _difference_rows(held: list) -> pa.RecordBatch:
    count = [len(x) for _, _, x, _ in held]
    one = lambda values: pa.array(np.repeat(np.array(values, np.int64), count))
    x = np.concatenate([x for _, _, x, _ in held]) if held else np.zeros(0, np.int64)
    return pa.RecordBatch.from_arrays([one([h[0] for h in held]), one([h[1] for h in held]), pa.array(x), one(count), one([h[3] for h in held])], names=["hub", "node", "x", "d", "n"])


def shared_differences(groups: DataFrame, comp: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """(hub, x, node, outer, need, rest): the differences to the hub by which a member (hub, node) of a group can be linked with
    another one; outer: not in the hub's component; need: what it asks of a partner; rest: how many of its differences,
    from x on by rarity, can still be shared. A pair has a link only if they share x with
    2 * (100 + threshold) * min(rest) >= need + need.
    """
    own, hub_own = comp.select("node", "component"), comp.select(F.col("node").alias("hub"), F.col("component").alias("hub_component"))
    members = groups.select("hub", "node").distinct().join(own, "node").join(hub_own, "hub").withColumn("outer", F.col("component") != F.col("hub_component"))
    mixed = members.groupBy("hub").agg(F.count("*").alias("of"), F.max("outer").alias("any")).filter("any AND of > 1").select("hub")
    members = materialise(members.join(small_side(materialise(mixed, "mixed")), "hub", "left_semi").select("hub", "node", "outer"), "members")
    raw = by_hub(in_blocks(members.select("hub", "node")), sets).mapInArrow(_differences, "hub long, node long, x long, d long, n long")
    raw = materialise(raw.join(members, ["hub", "node"]).withColumn("need", (100 + threshold) * F.col("d") - (100 - threshold) * F.col("n")).select("hub", "node", "x", "outer", "need"), "differences")
    met = raw.groupBy("hub", "x").agg(F.count("*").alias("df"), F.max("outer").alias("any")).filter("df > 1 AND any").select("hub", "x", "df")
    kept = materialise(raw.join(met, ["hub", "x"]), "kept")
    by_rarity = W.partitionBy("hub", "node").orderBy(F.desc("df"), F.desc("x"))
    kept = kept.withColumn("rest", F.row_number().over(by_rarity)).select("hub", "x", "node", "outer", "need", "rest")
    least = raw.groupBy("hub").agg(F.min("need").alias("low"), F.min(F.when(F.col("outer"), F.col("need"))).alias("low_outer"))
    partner = F.when(F.col("outer"), F.col("low")).otherwise(F.col("low_outer"))
    return kept.join(small_side(materialise(least, "least")), "hub").filter(2 * (100 + threshold) * F.col("rest") >= F.col("need") + partner).select("hub", "x", "node", "outer", "need", "rest")


#: Collisions with a hub from which on a member's differences to it are looked at.
NEAR = 15
#: Rounds over the posting lists' far members, and over the lists of differences, before the pairs left are joined.
ROUNDS, DIFFERENCE_ROUNDS = 4, 1
#: So few far postings are joined at once.
FEW = 1_000


def linked(reps: DataFrame, texts: Callable[[DataFrame], DataFrame], *, width: int, matches: int, coordinates: int, threshold: int) -> DataFrame:
    """(node, component) of the classes that can be linked. reps: (node, n, sig); texts: (node, text) of a list of nodes."""
    first = materialise(candidates(reps, matches), "candidates")
    sets = materialise(texts(first).mapInArrow(lambda it: _with_sets(it, width), "node long, payload binary"), "sets")
    left = materialise(linkable(sets, threshold), "linkable")
    some = materialise(reps.join(small_side(left), "node", "left_semi"), "left_over")
    posts = materialise(prefixes(some, matches), "prefixes")
    comp = posts.select("node", F.col("node").alias("component")).distinct()
    comp = materialise(comp, "components")

    def merge(counted: DataFrame) -> None:
        """Confirm counted pairs (see collisions) and merge what is linked."""
        nonlocal comp
        good = counted.filter((F.col("agree") >= matches) & _sizes_fit(F.col("n"), F.col("hub_n"), threshold)).select("hub", "block", "node")
        found = materialise(by_hub(good, sets).mapInArrow(lambda it: _confirm(it, threshold), "u long, v long"), "links")
        comp = contracted(comp, found)

    lists, groups = posts, None
    for turn in range(ROUNDS):
        members = lists.join(comp, "node")
        order = F.struct(-F.col("common"), F.xxhash64("node")) if turn == 0 else F.struct(F.xxhash64("node", F.lit(turn)))
        hubs = members.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.min_by("node", order).alias("hub")).filter("lo <> hi").select("token", "hub")
        met = materialise(members.join(small_side(materialise(hubs, "hubs")), "token").filter("node <> hub").select("token", "hub", "node", "common"), "met")
        pairs = materialise(met.select("hub", "node").distinct(), "pairs")
        counted = materialise(collisions(pairs, some), "collisions")
        if counted.isEmpty():
            break
        merge(counted)
        near = counted.filter(F.col("agree") >= NEAR).select("hub", "node")
        groups = near if groups is None else groups.union(near)
        if counted.filter(F.col("agree") < NEAR).isEmpty():
            lists = None
            break
        placed = met.join(counted.select("hub", "node", "agree"), ["hub", "node"])
        goes_on = placed.groupBy("token").agg(F.min("agree").alias("least")).filter(F.col("least") < NEAR).select("token")
        lists = materialise(placed.filter(F.col("agree") < NEAR + coordinates - matches).join(small_side(materialise(goes_on, "goes_on")), "token", "left_semi").select("token", "node", "common"), "lists")
        if lists.count() <= FEW:
            break
    if groups is None:
        return comp
    if lists is not None:
        pairs = materialise(within_lists(lists.join(comp, "node"), ["token"]).distinct(), "pairs")
        if not pairs.isEmpty():
            merge(collisions(pairs, some))
    posts = materialise(shared_differences(groups, comp, sets, threshold), "shared_differences")
    enough = 2 * (100 + threshold) * F.least("rest", "hub_rest") >= F.col("need") + F.col("hub_need")
    for turn in range(DIFFERENCE_ROUNDS if not posts.isEmpty() else 0):
        members = posts.withColumnRenamed("hub", "group").join(comp, "node")
        order = F.struct(F.col("need") if turn == 0 else F.lit(0), F.xxhash64("node", F.lit(turn)))
        hubs = members.groupBy("group", "x").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.min_by(F.struct(F.col("node").alias("hub"), F.col("component").alias("hub_component"), F.col("need").alias("hub_need"), F.col("rest").alias("hub_rest")), order).alias("h")).filter("lo <> hi").select("group", "x", "h.*")
        pairs = members.join(small_side(materialise(hubs, "hubs")), ["group", "x"]).filter((F.col("component") != F.col("hub_component")) & enough).select(F.least("hub", "node").alias("hub"), F.greatest("hub", "node").alias("node"))
        pairs = materialise(pairs.distinct(), "pairs")
        if not pairs.isEmpty():
            merge(materialise(collisions(pairs, some), "collisions"))
        if turn == DIFFERENCE_ROUNDS - 1:
            members = posts.withColumnRenamed("hub", "group").join(comp, "node")
            pairs = materialise(within_lists(members, ["group", "x"], ["outer", "need", "rest"], (F.col("outer") | F.col("hub_outer")) & enough).distinct(), "pairs")
            if not pairs.isEmpty():
                merge(materialise(collisions(pairs, some), "collisions"))
    return comp


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = 5, threshold: int = 85, coordinates: int = 48, matches: int = 26) -> DataFrame:
    """docs' ids with n_shingles, component_id (the least id reachable over links) and kept (first of its component)."""
    mark = scratch_mark()
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    doc_node = F.coalesce("doc_id", F.lit(LOWEST)).alias("doc_node")
    base = base.withColumn("row", F.xxhash64(doc_node, "text"))
    key = F.when(F.col("n_shingles") > 0, F.xxhash64("n_shingles", "s1", "s2")).alias("node")
    rows = materialise(signed(base, width, coordinates).select("doc_id", doc_node, "row", "n_shingles", key, "sig"), "signatures")
    full = rows.filter("node IS NOT NULL")
    # the least row of a class stands for it
    own = F.struct("doc_node", "row")
    classes = full.groupBy("node").agg(F.min(own).alias("own"), F.min_by(F.struct(F.col("n_shingles").alias("n"), "sig"), own).alias("c"), F.count("*").alias("rows"))
    classes = materialise(classes.select("node", "own.*", "c.*", "rows"), "classes")
    # rows of a repeated id: they link their classes, and a class may be there twice with one row key
    ids = materialise(full.groupBy("doc_node").agg(F.min("node").alias("u"), F.max("node").alias("hi"), F.count("*").alias("k")).filter("k > 1"), "ids")
    repeated = not ids.isEmpty()

    def texts(nodes: DataFrame) -> DataFrame:
        # the texts are only shuffled where many classes are candidates
        wanted = small_side(materialise(classes.join(small_side(nodes), "node", "left_semi").select("node", "doc_node", "row"), "wanted"))
        found = base.select(doc_node, "row", "text").join(wanted, ["doc_node", "row"]).select("node", "text")
        return found.groupBy("node").agg(F.any_value("text").alias("text")) if repeated else found

    comp = linked(classes.select("node", "n", "sig"), texts, width=width, matches=matches, coordinates=coordinates, threshold=threshold)
    comp = classes.select("node", "doc_node", "rows").join(comp, "node", "left").select("node", "doc_node", "rows", F.coalesce("component", "node").alias("component"))
    if repeated:
        several = full.select("doc_node", "node").distinct().join(small_side(ids.filter("u <> hi").select("doc_node", "u")), "doc_node").select("u", F.col("node").alias("v")).filter("u <> v")
        comp = contracted(materialise(comp, "components"), materialise(several, "several"))
    comp = materialise(comp, "components")
    # rows whose class has no other row and is alone in its component are their own first, and need no look-up
    lowest = comp.groupBy("component").agg(F.min("doc_node").alias("found"), F.sum("rows").alias("of")).filter("of > 1").select("component", "found")
    named = materialise(comp.join(small_side(materialise(lowest, "lowest")), "component").select("node", "found"), "named")
    out = rows.select("doc_id", "doc_node", "n_shingles", "node").join(small_side(named), "node", "left").withColumn("component", F.coalesce("found", "doc_node"))
    out = out.select("doc_id", "n_shingles", F.when(F.col("component") != LOWEST, F.col("component")).alias("component_id"), (F.col("component") == F.col("doc_node")).alias("kept"))
    return settled(out, "near_duplicates", mark)


def drop_near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", **options) -> DataFrame:
    """docs without the rows that are not the first of their group."""
    gone = near_duplicates(docs, id_col=id_col, **options).filter("NOT kept AND doc_id IS NOT NULL").select(F.col("doc_id").alias("__gone_id")).distinct()
    gone = small_side(materialise(gone, "gone"))
    return docs.join(gone, F.col(id_col).cast("long") == F.col("__gone_id"), "left_anti")
