"""Lexical retrieval packing: windows are filled with documents that share the seed's words.

Documents are dealt and sorted by a word of theirs (the one whose hash is least, of all between blanks with five bytes or more),
so documents that share many words tend to lie side by side; a word that very many documents have is split by id. Runs
of about `shard_bytes` of text are the shards. Each shard gets an inverted index over token ids with BM25 weights; an
unused document becomes the seed of a window, its `query_terms` heaviest terms are looked up, and the best unused
neighbours that fit go in, best first. What is left of the window takes the head of the best remaining neighbour, whose
tail becomes the next seed. Only the last window of a shard can stay open: it is split into sequences whose lengths are
powers of two, which need no padding.

Documents longer than a window first give off whole windows. Every token stands in exactly one piece.

Defined results: null and empty texts have the end id alone; rows of a repeated id are packed one by one; an empty table
gives no pieces; equal scores go by place in the shard; a very long text is one row; other columns are ignored. Sequence ids hold the task, the shard and a counter, so a task that is run
again on another executor gives the same ones.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxlake.llm.common import bounded_batches
from voxlake.llm.token_output import checksum
from voxlake.llm.tokens import encoder

K1, B = 1.2, 0.75


class Index:
    """BM25 postings of one shard: for each term, documents and weights."""

    def __init__(self, docs: list[np.ndarray], query_terms: int):
        self.n, self.query_terms = len(docs), query_terms
        sizes = np.array([len(d) for d in docs], np.int64)
        owner = np.repeat(np.arange(self.n, dtype=np.int64), sizes)
        flat = np.concatenate(docs) if docs else np.zeros(0, np.int32)
        vocab = int(flat.max()) + 1 if len(flat) else 1
        pair, tf = np.unique(flat.astype(np.int64) * self.n + owner, return_counts=True)
        term, self.docs = pair // max(self.n, 1), (pair % max(self.n, 1)).astype(np.int32)
        self.first = np.searchsorted(term, np.arange(vocab + 1))
        df = np.diff(self.first)
        # terms in half of the documents or more weigh nothing
        idf = np.maximum(np.log((self.n - df + 0.5) / (df + 0.5)), 0)
        norm = K1 * (1 - B + B * sizes[self.docs] / max(sizes.mean() if self.n else 1, 1))
        self.weight = idf[term] * tf * (K1 + 1) / (tf + norm)
        # each document's heaviest terms: sorted by document, then weight
        order = np.lexsort((-self.weight, self.docs))
        self.own = term[order]
        self.own_first = np.searchsorted(self.docs[order], np.arange(self.n + 1))
        self.own_weight = self.weight[order]

    def neighbours(self, seed: int) -> np.ndarray:
        """Documents with a positive score, best first, ties by position; the seed itself is among them."""
        a, b = self.own_first[seed], self.own_first[seed + 1]
        terms = self.own[a : min(b, a + self.query_terms)][self.own_weight[a : min(b, a + self.query_terms)] > 0]
        if not len(terms):
            return np.zeros(0, np.int64)
        parts = [slice(self.first[t], self.first[t + 1]) for t in terms]
        score = np.bincount(np.concatenate([self.docs[p] for p in parts]), np.concatenate([self.weight[p] for p in parts]), self.n)
        found = np.flatnonzero(score)
        return found[np.lexsort((found, -score[found]))]


def pack(docs: list[np.ndarray], window: int, query_terms: int) -> list[list[tuple[int, int, int]]]:
    """Sequences of pieces (document, start, length) over all tokens of docs."""
    out, left = [], np.zeros(len(docs), np.int64)  # left: tokens before this are placed
    for d, ids in enumerate(docs):
        while len(ids) - left[d] >= window:
            out.append([(d, int(left[d]), window)])
            left[d] += window
    size = np.array([len(x) for x in docs], np.int64)
    rest = size - left
    index = Index([x[left[d] :] for d, x in enumerate(docs)], query_terms)
    used = rest == 0
    following = 0
    carry = -1
    while True:
        if carry >= 0:
            seed, carry = carry, -1
        else:
            while following < len(docs) and used[following]:
                following += 1
            if following == len(docs):
                return out
            seed = following
        pieces, room = [(seed, int(left[seed]), int(rest[seed]))], window - int(rest[seed])
        used[seed] = True
        if room:
            near = index.neighbours(seed)
            near = left_over = near[~used[near]]
            while room:
                fits = rest[left_over] <= room
                at = int(fits.argmax()) if len(fits) else 0
                if not len(fits) or not fits[at]:
                    break
                d, left_over = int(left_over[at]), left_over[at + 1 :]
                pieces.append((d, int(left[d]), int(rest[d])))
                used[d] = True
                room -= int(rest[d])
            near = near[~used[near]]
            first_long = int(near[0]) if room and len(near) else -1
            # without neighbours that fit: documents in order, and the head of one that does not fit
            at = following
            while room and first_long < 0 and at < len(docs):
                if not used[at]:
                    if rest[at] <= room:
                        pieces.append((at, int(left[at]), int(rest[at])))
                        used[at] = True
                        room -= int(rest[at])
                    else:
                        first_long = at
                at += 1
            if room and first_long >= 0:
                d = first_long
                pieces.append((d, int(left[d]), room))
                left[d] += room
                rest[d] -= room
                room, carry = 0, d
        if room:
            out += powers(pieces)
        else:
            out.append(pieces)


def powers(pieces: list[tuple[int, int, int]]) -> list[list[tuple[int, int, int]]]:
    """An open window as sequences whose lengths are the powers of two of its size."""
    total, out, pieces = sum(n for _, _, n in pieces), [], list(pieces)
    for bit in reversed(range(total.bit_length())):
        room = total & (1 << bit)
        now = []
        while room:
            d, a, n = pieces.pop(0)
            take = min(n, room)
            now.append((d, a, take))
            room -= take
            if take < n:
                pieces.insert(0, (d, a + take, n - take))
        if now:
            out.append(now)
    return out


def pack_documents(docs: DataFrame, vocabulary: str, *, end_id: int = 2, window: int = 4096, query_terms: int = 24, shard_bytes: int = 4 << 20, id_col: str = "doc_id", text_col: str = "text", slots: int = 1 << 20, with_ids: bool = False) -> DataFrame:
    """One row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids)."""
    bounded_batches(docs.sparkSession, 256)
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long" + ", ids array<int>" * with_ids
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * with_ids

    def packed(batches):
        encode, base, sequence = encoder(vocabulary, slots), TaskContext.get().partitionId() << 36, 0
        tail = np.array([end_id], np.int32)
        names_of, ids, held = [], [], 0

        def shard():
            nonlocal sequence
            rows = []
            for pieces in pack(ids, window, query_terms):
                offset = 0
                for d, a, n in pieces:
                    own = ids[d][a : a + n]
                    rows.append((names_of[d], a, n, checksum(own), len(ids[d]), base + sequence, offset) + ((own,) if with_ids else ()))
                    offset += n
                sequence += 1
            columns = list(zip(*rows, strict=True)) or [[] for _ in names]
            types = [pa.int64()] * 7 + [pa.list_(pa.int32())] * with_ids
            for at in range(0, max(len(rows), 1), 4096):
                yield pa.RecordBatch.from_arrays([pa.array(c[at : at + 4096], t) for c, t in zip(columns, types, strict=True)], names=names)

        for batch in batches:
            texts = batch.column(1).to_pylist()
            names_of += batch.column(0).to_pylist()
            ids += [np.concatenate([x, tail]) for x in encode(texts)]
            held += sum(map(len, filter(None, texts)))
            if held >= shard_bytes:
                yield from shard()
                names_of, ids, held = [], [], 0
        if ids:
            yield from shard()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return dealt(rows).select("doc_id", "text").mapInArrow(packed, schema)


def dealt(rows: DataFrame) -> DataFrame:
    """rows (doc_id, text) in ranges of a word of theirs, sorted; equal rows are interchangeable."""
    words = F.filter(F.split("text", " "), lambda w: F.octet_length(w) > 4)
    key = F.coalesce(F.array_min(F.transform(words, lambda w: F.xxhash64(w))), F.xxhash64("doc_id"))
    keyed = rows.withColumn("word", key).withColumn("tie", F.xxhash64("doc_id", "text"))
    return keyed.repartitionByRange("word", "tie").sortWithinPartitions("word", "tie")
