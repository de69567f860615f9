"""Language identification with interpolated Kneser-Ney character models.

Each language gets a model of orders 1 to `order` over the letters of lower-cased words (`^word$`). Highest-order counts
are raw, lower ones count distinct left neighbours, every order is discounted and interpolated with the next lower one.
The n-grams of all languages stand in one sorted array of 64-bit hashes for each order, with a row of log probabilities
(one for each language) beside every hash; a look-up is a binary search. A text's cross-entropy in a language is the sum
over its words divided by their letters (and word ends); the language with the lowest one wins. Temperature of the
posterior and the rejection threshold are calibrated on sample texts that the models were not fitted on.

Models are fitted on a bounded sample: of each language, whole texts of about `sample_chars` characters, chosen by a
hash of id and text. Every whole text is then scored, each distinct word once for each worker's cache.

Runs of letters, in scripts without blanks whole clauses, are words of any length up to LONGEST letters; a longer run is
learned and scored in parts of that length.

Defined results: a text that is null or has no letter gets `und` and score 0; with no learned language every text does;
ties go to the language that sorts first; repeated rows are rows of their own, in the sample too; other columns pass through.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from voxlake.llm.common import bounded_batches
from voxlake.llm.shingles import mix

WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")
UNDETERMINED = "und"
#: Words that a worker keeps scores of; older ones are forgotten together.
CACHED_WORDS = 300_000
#: Characters of those words; letters that are scored together, and of a word: only a run of more letters is cut in parts.
CACHED_CHARS, TOGETHER, LONGEST = 1 << 23, 1 << 18, 1 << 16
_EDGE = np.uint64(0x110001), np.uint64(0x110002)


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


def grams(words: list[str], order: int):
    """For each order n: (hash of every n-gram, of its context, of its suffix, word of each, does it begin the word)."""
    sizes = np.array([len(w) + 2 for w in words], np.int64)
    first = np.concatenate(([0], np.cumsum(sizes)))
    codes = np.empty(first[-1], np.uint64)
    inner = np.ones(first[-1], bool)
    inner[first[:-1]] = inner[first[1:] - 1] = False
    codes[first[:-1]], codes[first[1:] - 1] = _EDGE
    codes[inner] = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    owner = np.repeat(np.arange(len(words)), sizes)
    place = np.arange(len(codes)) - first[owner]
    letter = mix(codes + np.uint64(0x1234567))
    runs = np.zeros(len(codes), np.uint64)  # hash of the n-gram that ends here
    out = []
    for n in range(1, order + 1):
        suffix, before = runs, np.zeros(len(codes), np.uint64)
        before[1:] = runs[:-1]
        runs = np.where(place >= n - 1, mix(before * np.uint64(0x9E3779B97F4A7C15) + letter + np.uint64(n)), np.uint64(0))
        # the word's first mark is never predicted, only seen in contexts
        at = np.flatnonzero((place >= max(1, n - 1)))
        out.append((runs[at], before[at], suffix[at], owner[at], place[at] == n - 1))
    return out


def fit_language(counts: dict[str, int], order: int = 5) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For each order: n-gram hashes and log probabilities, context hashes and log back-off weights."""
    words = sorted(counts)
    weight = np.array([counts[w] for w in words], float)
    each = grams(words, order)
    levels, below_hash, below_p = [], None, None
    for n, (whole, context, suffix, owner, begins) in enumerate(each, 1):
        keys, at, back = np.unique(whole, return_index=True, return_inverse=True)
        raw = np.bincount(back, weight[owner])
        if n < order:
            longer, _, tail, _, _ = each[n]
            _, once = np.unique(longer, return_index=True)
            more, spread = np.unique(tail[once], return_counts=True)
            place = np.minimum(np.searchsorted(more, keys), max(len(more) - 1, 0))
            continued = np.where(more[place] == keys, spread[place], 0) if len(more) else np.zeros(len(keys))
            raw = np.where(begins[at] & (n > 1), raw, np.maximum(continued, 1))
        once, twice = (raw == 1).sum(), (raw == 2).sum()
        discount = once / (once + 2 * twice) if once and twice else 0.5
        contexts, of = np.unique(context[at], return_inverse=True)
        total, kinds = np.bincount(of, raw), np.bincount(of)
        backoff = discount * kinds / total
        if n == 1:
            lower = np.full(len(keys), 1.0 / (len(keys) + 1))
        else:
            lower = below_p[np.searchsorted(below_hash, suffix[at])]
        p = np.maximum(raw - discount, 0) / total[of] + backoff[of] * lower
        levels.append((keys, np.log(p), contexts, np.log(backoff)))
        below_hash, below_p = keys, p
    return levels


@dataclass
class Models:
    """The languages' models, merged: for each order sorted hashes with one column of values for each language."""

    langs: list[str]
    order: int
    levels: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]
    floor: np.ndarray
    temperature: float = 12.0
    threshold: float = float("inf")

    @classmethod
    def merge(cls, fitted: dict[str, list], order: int) -> Models:
        langs = sorted(fitted)
        levels = []
        for n in range(order):
            found = []
            for which, missing in ((0, np.nan), (2, 0.0)):
                keys = np.unique(np.concatenate([fitted[x][n][which] for x in langs]))
                values = np.full((len(keys), len(langs)), missing, np.float32)
                for k, x in enumerate(langs):
                    values[np.searchsorted(keys, fitted[x][n][which]), k] = fitted[x][n][which + 1]
                found += [keys, values]
            levels.append(tuple(found))
        floor = np.array([-np.log(len(fitted[x][0][0]) + 1.0) for x in langs])
        return cls(langs, order, levels, floor)

    def score(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(sum of log probabilities for each word and language, letters and word ends of each word)."""
        total, sizes = np.zeros((len(words), len(self.langs))), np.array([len(w) + 1.0 for w in words])
        if not words:
            return total, sizes
        each = grams(words, self.order)
        # all positions of order 1, in order; higher orders exist at some of them
        first, _, _, owner, _ = each[0]
        lp = np.repeat(self.floor[None], len(first), 0)
        where = np.concatenate([np.arange(1, len(w) + 2) for w in words])
        for n, (whole, context, _, _, _) in enumerate(each, 1):
            at = np.arange(len(first)) if n == 1 else np.flatnonzero(where >= n - 1)
            keys, values, contexts, backoff = self.levels[n - 1]
            c = np.minimum(np.searchsorted(contexts, context), len(contexts) - 1)
            known = contexts[c] == context
            now = lp[at]
            now[known] += backoff[c[known]]
            k = np.minimum(np.searchsorted(keys, whole), len(keys) - 1)
            hit = keys[k] == whole
            seen = values[k[hit]]
            now[hit] = np.where(np.isnan(seen), now[hit], seen)
            lp[at] = now
        for j in range(len(self.langs)):
            total[:, j] = np.bincount(owner, lp[:, j], len(words))
        return total, sizes


class Scorer:
    """Cross-entropies of texts, with the scores of words seen before."""

    def __init__(self, models: Models):
        self.models, self.known, self.held = models, {}, 0
        self.table, self.sizes = np.zeros((0, len(models.langs))), np.zeros(0)

    def __call__(self, texts: list[str | None]) -> np.ndarray:
        """One row for each text; nan where it has no letter."""
        found = [words_of(t) for t in texts]
        flat = [w[i : i + LONGEST] for ws in found for w in ws for i in range(0, len(w), LONGEST)] if any(len(w) > LONGEST for ws in found for w in ws) else [w for ws in found for w in ws]
        count = [sum(-(-len(w) // LONGEST) for w in ws) for ws in found]
        if len(self.known) > CACHED_WORDS or self.held > CACHED_CHARS:
            self.__init__(self.models)
        fresh = [w for w in dict.fromkeys(flat) if w not in self.known]
        ends = np.cumsum([len(w) + 2 for w in fresh])
        a = 0
        while a < len(fresh):
            before = ends[a - 1] if a else 0
            b = max(a + 1, int(np.searchsorted(ends, before + TOGETHER, "right")))
            part, a = fresh[a:b], b
            self.held += int(ends[b - 1] - before)
            total, sizes = self.models.score(part)
            self.known.update(zip(part, range(len(self.known), len(self.known) + len(part)), strict=True))
            self.table, self.sizes = np.concatenate([self.table, total]), np.concatenate([self.sizes, sizes])
        index = np.fromiter(map(self.known.__getitem__, flat), np.int64, len(flat))
        out = np.full((len(texts), len(self.models.langs)), np.nan)
        full = [i for i, n in enumerate(count) if n]
        if full:
            starts = np.concatenate(([0], np.cumsum([count[i] for i in full])))[:-1]
            out[full] = -np.add.reduceat(self.table[index], starts, axis=0) / np.add.reduceat(self.sizes[index], starts)[:, None]
        return out


#: Characters of a text that the sample takes together.
BLOCK_CHARS = 20_000


def posterior(entropy: np.ndarray, temperature: float) -> np.ndarray:
    x = -(entropy - np.nanmin(entropy, axis=1, keepdims=True)) * temperature
    e = np.exp(np.nan_to_num(x, nan=-np.inf))
    return e / np.maximum(e.sum(1, keepdims=True), 1e-300)


def _fit_group(key, batch: pa.Table, order: int) -> pa.Table:
    from collections import Counter

    counts: Counter = Counter()
    for t in batch["text"].to_pylist():
        counts.update(w[i : i + LONGEST] for w in words_of(t) for i in range(0, len(w), LONGEST))
    levels = fit_language(counts, order) if counts else []
    parts = [np.ascontiguousarray(x).tobytes() for level in levels for x in level]
    return pa.table({"lang": [key[0].as_py()], "parts": pa.array([parts], pa.list_(pa.binary()))})


def train(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", order: int = 5, sample_chars: int = 1_500_000, reject_share: float = 0.001) -> Models | None:
    """Models of all non-null languages of docs; None if there is no text to learn from."""
    spark = docs.sparkSession
    bounded_batches(spark)
    known = docs.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"), F.xxhash64(id_col, text_col).alias("h")).filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = known.groupBy("lang").agg(F.sum(F.length("text")).alias("n")).withColumn("share", F.least(F.lit(1.0), F.lit(float(sample_chars)) / F.greatest("n", F.lit(1))))
    # one row for each language; a tenth of the sample is kept for calibration
    # blocks of long texts are drawn, so that a language of a few very long texts gets its share as well
    blocks = F.transform(F.sequence(F.lit(0), F.greatest(F.ceil(F.length("text") / BLOCK_CHARS), F.lit(1)) - 1), lambda i: F.struct(F.xxhash64("h", i).alias("h"), F.substring("text", i * BLOCK_CHARS + 1, F.lit(BLOCK_CHARS)).alias("text")))
    parts = known.select("lang", F.explode(blocks).alias("b")).select("lang", "b.*")
    picked = parts.join(F.broadcast(sizes), "lang").filter(F.shiftrightunsigned("h", 11) < (F.col("share") * float(2**53)).cast("long"))
    held = F.pmod(F.shiftright("h", 24), F.lit(10)) == 0
    fitted = picked.filter(~held | (F.col("n") < 20_000)).groupBy("lang").applyInArrow(lambda key, part: _fit_group(key, part, order), "lang string, parts array<binary>").collect()
    by_lang = {}
    for row in fitted:
        if row.parts:
            kinds = (np.uint64, np.float64) * 2
            raw = [np.frombuffer(bytes(x), kinds[i % 4]) for i, x in enumerate(row.parts)]
            by_lang[row.lang] = [tuple(raw[i : i + 4]) for i in range(0, len(raw), 4)]
    if not by_lang:
        return None
    models = Models.merge(by_lang, order)
    # at most 200 calibration texts of each language
    rows = picked.filter(held).select("lang", "h", "text").groupBy("lang", F.pmod("h", F.lit(200)).alias("slot")).agg(F.min(F.struct("h", "text")).alias("t")).select("lang", "t.text")
    calibrate(models, entropies(rows, models).toArrow(), reject_share)
    return models


def calibrate(models: Models, rows: pa.Table, reject_share: float) -> None:
    own = [models.langs.index(x) if x in models.langs else -1 for x in rows["lang"].to_pylist()]
    entropy = np.array([[np.nan] * len(models.langs) if x is None else x for x in rows["__entropy"].to_pylist()], float).reshape(-1, len(models.langs))
    fine = [i for i, k in enumerate(own) if k >= 0 and not np.isnan(entropy[i]).any()]
    if not fine:
        return
    entropy, own = entropy[fine], np.array([own[i] for i in fine])
    loss = {t: -np.log(np.maximum(posterior(entropy, t)[np.arange(len(own)), own], 1e-9)).mean() for t in (2, 4, 8, 16, 32, 64)}
    models.temperature = float(min(loss, key=loss.get))
    models.threshold = float(np.quantile(entropy[np.arange(len(own)), own], 1 - reject_share) * 1.25)


def entropies(docs: DataFrame, models: Models, text_col: str = "text") -> DataFrame:
    """docs with the column __entropy: one value for each of models.langs, null where the text has no letter."""
    bounded_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(models)
    keep = [c for c in docs.columns if c != "__entropy"]
    at, schema = keep.index(text_col), docs.select(*keep).schema.add("__entropy", ArrayType(DoubleType()))

    def scored(batches):
        scorer = Scorer(sent.value)
        for batch in batches:
            rows = [None if np.isnan(x).any() else x for x in scorer(batch.column(at).to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rows, pa.list_(pa.float64()))], names=[*keep, "__entropy"])

    return docs.select(*keep).mapInArrow(scored, schema)


def identify(docs: DataFrame, models: Models | None, *, text_col: str = "text", reject: bool = True) -> DataFrame:
    """docs with lang_pred, score (posterior of the best language), bits (its cross-entropy) and rejected.

    With `reject`, a text whose best cross-entropy lies above the calibrated threshold gets `und` as well.
    """
    added = ("lang_pred", "score", "bits", "rejected")
    keep = [c for c in docs.columns if c not in added]
    if models is None:
        return docs.select(*keep, F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(None).cast("double").alias("bits"), F.lit(True).alias("rejected"))
    e = F.col("__entropy")
    best = F.array_min(e)
    weights = F.aggregate(e, F.lit(0.0), lambda s, x: s + F.exp((F.element_at("__low", 1) - x) * models.temperature))
    out = entropies(docs.select(*keep), models, text_col).withColumn("__low", F.array(best))
    rejected = e.isNull() | (best > models.threshold)
    langs = F.array(*[F.lit(x) for x in models.langs])
    name = F.element_at(langs, F.array_position(e, F.element_at("__low", 1)).cast("int"))
    return out.select(
        *keep, F.when(rejected if reject else e.isNull(), UNDETERMINED).otherwise(name).alias("lang_pred"),
        F.when(e.isNull(), 0.0).otherwise(1 / weights).alias("score"), (best / np.log(2)).alias("bits"), rejected.alias("rejected"),
    )
