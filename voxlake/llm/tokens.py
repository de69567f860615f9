"""Whole texts to token ids with the tokenizers library, fast for texts whose words repeat.

A pre-tokenizer cuts a text into pieces that are encoded on their own, so a piece's ids never depend on its neighbours.
For the two vocabularies whose rule is known here, texts of Latin-1 characters are cut by the same rule over whole
batches with array operations, every piece is looked up by hash and length in a table of fixed size, and those not found
are encoded by the library and entered. All other texts go to the library whole: those with other characters, with a
special token's string, or with a control character that two libraries may class differently. `Encoder(...,
slots=0)` always does the latter.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np

from voxlake.llm.shingles import mix

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Patterns of the two public pre-tokenizers (fixed values).
BYTE_LEVEL_TYPE = {"type": "ByteLevel", "use_regex": True, "add_prefix_space": False}
WORD_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Bytes of Latin-1 that are left to the library: our separator 0, control separators, next line, no-break space.
_DOUBTFUL = bytes([0, *range(0x1C, 0x20), 0x85, 0xA0])
END, SPACE, LETTER, NUMBER, OTHER = range(5)


def _classes() -> np.ndarray:
    import unicodedata

    out = np.full(256, OTHER, np.uint8)
    for b in range(256):
        kind = unicodedata.category(chr(b))[0]
        out[b] = LETTER if kind == "L" else NUMBER if kind == "N" else OTHER
    out[[9, 10, 11, 12, 13, 32, 0x85, 0xA0]] = SPACE
    out[0] = END
    return out


CLASS = _classes()
_LOWER = np.array([ord(chr(b).lower()) if ord(chr(b).lower()) < 256 else b for b in range(256)], np.uint8)
_draw = np.random.default_rng(41)
_VALUE = _draw.integers(1, 2**63, 256, dtype=np.uint64)
_STEP = np.uint64(0xD1342543DE82EF95)
_BACK = np.uint64(pow(int(_STEP), -1, 2**64))
_powers: list[np.ndarray] = []


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) <= n:
        size = max(n + 1, BATCH + 1)
        _powers[:] = [np.cumprod(np.concatenate(([np.uint64(1)], np.full(size, s, np.uint64))), dtype=np.uint64) for s in (_STEP, _BACK)]
    return _powers[0], _powers[1]


def cut(data: np.ndarray, by_word: bool) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the pieces of Latin-1 texts, each followed by a zero byte.

    by_word: white space goes and every number character is a piece; else white space is kept, a blank before a run
    belongs to it, and the last white space before a run stands alone.
    """
    kind = CLASS[data]
    edge = kind[1:] != kind[:-1]
    if by_word:
        edge |= kind[1:] == NUMBER
    a = np.concatenate(([0], np.flatnonzero(edge) + 1)) if len(data) else np.zeros(0, np.int64)
    b = np.append(a[1:], len(data))
    k = kind[a] if len(a) else np.zeros(0, np.uint8)
    start, end = a.copy(), b.copy()
    joined = np.zeros(len(a), bool)  # a blank belongs to the run
    if not by_word and len(a):
        before_blank = np.concatenate(([False], (k[:-1] == SPACE) & (data[b[:-1] - 1] == 32))) & (k != END)
        joined = before_blank
        start = a - joined
    # contractions: an apostrophe alone in its run, without a blank, takes one or two letters from the next run
    mark = np.flatnonzero((k[:-1] == OTHER) & (b[:-1] - a[:-1] == 1) & (data[a[:-1]] == 39) & ~joined[:-1] & (k[1:] == LETTER)) if len(a) > 1 else []
    if len(mark):
        c1 = data[a[mark + 1]]
        two = b[mark + 1] - a[mark + 1] >= 2
        c2 = data[np.minimum(a[mark + 1] + 1, len(data) - 1)]
        take = np.where(np.isin(c1, np.frombuffer(b"stmd", np.uint8)), 1, 0)
        pair = two & (((c1 == 114) | (c1 == 118)) & (c2 == 101) | (c1 == 108) & (c2 == 108))
        take = np.where((take == 0) & pair, 2, take)
        end[mark] += take
        start[mark + 1] += take
    if by_word:
        keep = ((k == LETTER) | (k == NUMBER) | (k == OTHER)) & (end > start)
        return start[keep], end[keep]
    if not len(a):
        return start, end
    # white space: what a following run took is gone; before a run without a blank, the last character stands alone
    space = k == SPACE
    follows = np.append(k[1:], END)
    taken = np.append(joined[1:], False)
    end = np.where(space & taken, end - 1, end)
    split = space & ~taken & (follows != END) & (end - start > 1)
    end2 = end.copy()
    end = np.where(split, end - 1, end)
    keep = (k != END) & (end > start)
    start, first, end = start[keep], split[keep], end[keep]
    if first.any():
        at = np.flatnonzero(first) + 1
        lone = end2[keep][first]
        start, end = np.insert(start, at, lone - 1), np.insert(end, at, lone)
    return start, end


#: Bytes that are cut and looked up together.
BATCH = 1 << 19
#: A blank between two letters: both rules begin a new piece there, whatever stands around.
_SAFE = re.compile(rb"(?<=[A-Za-z]) (?=[A-Za-z])")


def _pieces(raw: bytes):
    """A long text in parts of about BATCH bytes that are encoded on their own."""
    while len(raw) > 2 * BATCH and (m := _SAFE.search(raw, BATCH)):
        yield raw[: m.start()]
        raw = raw[m.start() :]
    yield raw


class Encoder:
    """texts -> list of id arrays (int32), without special tokens added."""

    def __init__(self, path: str, slots: int = 1 << 20):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        pre, norm = spec.get("pre_tokenizer") or {}, spec.get("normalizer")
        inner = pre.get("pretokenizers", [])
        self.by_word = None
        if slots and all(pre.get(k) == v for k, v in BYTE_LEVEL_TYPE.items()) and norm is None:
            self.by_word = False
        elif slots and [p.get("type") for p in inner] == ["Split", "ByteLevel"] and inner[0]["pattern"] == {"Regex": WORD_LEVEL} and [n.get("type") for n in (norm or {}).get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]:
            self.by_word = True
        self.slots = slots
        self._empty()

    def _empty(self) -> None:
        self.keys, self.sizes = np.zeros(self.slots, np.uint64), np.zeros(self.slots, np.int32)
        self.first, self.count = np.zeros(self.slots, np.int64), np.zeros(self.slots, np.int32)
        self.ids, self.held = np.zeros(1 << 16, np.int32), 0

    def _latin(self, text: str) -> bytes | None:
        try:
            raw = text.encode("latin-1")
        except UnicodeEncodeError:
            return None
        return raw if len(raw.translate(None, _DOUBTFUL)) == len(raw) and not any(s in text for s in self.special) else None

    def _slots_of(self, keys: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Where each key stands: in one of its two slots, or -1."""
        bits = np.uint64(64 - self.slots.bit_length() + 1)
        one = (keys >> bits).astype(np.int64)
        two = ((keys * np.uint64(0x9E3779B97F4A7C15)) >> bits).astype(np.int64)
        at = np.where((self.keys[one] == keys) & (self.sizes[one] == sizes), one, -1)
        rest = np.flatnonzero(at < 0)
        other = two[rest]
        at[rest] = np.where((self.keys[other] == keys[rest]) & (self.sizes[other] == sizes[rest]), other, -1)
        return at

    def _encode(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each piece where its ids begin and how many, and the store of ids."""
        sizes = (end - start).astype(np.int32)
        at = self._slots_of(keys, sizes)
        first, count = self.first[at], self.count[at]
        lost = np.flatnonzero(at < 0)
        if len(lost):
            _, lead, back = np.unique(keys[lost], return_index=True, return_inverse=True)
            new = lost[lead]
            raw = data.tobytes()
            found = [e.ids for e in self.tokenizer.encode_batch_fast([raw[a:b].decode("latin-1") for a, b in zip(start[new].tolist(), end[new].tolist(), strict=True)], add_special_tokens=False)]
            n = np.fromiter(map(len, found), np.int32, len(found))
            flat = np.fromiter((x for own in found for x in own), np.int32, int(n.sum()))
            if self.held + len(flat) > len(self.ids):
                self.ids = np.concatenate([self.ids[: self.held], np.zeros(max(len(flat), self.held), np.int32)])
            begin = self.held + np.concatenate(([0], np.cumsum(n, dtype=np.int64)))[:-1]
            self.ids[self.held : self.held + len(flat)] = flat
            self.held += len(flat)
            first[lost], count[lost] = begin[back], n[back]
            bits = np.uint64(64 - self.slots.bit_length() + 1)
            one, two = (keys[new] >> bits).astype(np.int64), ((keys[new] * np.uint64(0x9E3779B97F4A7C15)) >> bits).astype(np.int64)
            slot = np.where(self.count[one] == 0, one, two)  # the second slot's older entry gives way
            # two new pieces may want one slot: the last one written has it, so all columns are written by it
            winner = np.unique(slot[::-1], return_index=True)[1]
            chosen = len(slot) - 1 - winner
            s = slot[chosen]
            self.keys[s], self.sizes[s], self.first[s], self.count[s] = keys[new][chosen], sizes[new][chosen], begin[chosen], n[chosen]
        return first, count, self.ids

    def _batch(self, raws: list[bytes]) -> list[np.ndarray]:
        data = np.frombuffer(b"\0".join(raws) + b"\0", np.uint8)
        if self.by_word:
            data = _LOWER[data]
        start, end = cut(data, bool(self.by_word))
        up, down = _power(len(data))
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_VALUE[data] * up[: len(data)], out=sums[1:])
        keys = mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))
        first, count, ids = self._encode(data, start, end, keys)
        total = np.concatenate(([0], np.cumsum(count, dtype=np.int64)))
        flat = ids[np.arange(total[-1]) + np.repeat(first - total[:-1], count)]
        stops = np.cumsum([len(r) + 1 for r in raws])
        cuts = total[np.searchsorted(start, stops)]
        if self.held > 4 * self.slots + (1 << 16):
            self._empty()
        return np.split(flat, cuts[:-1])

    def __call__(self, texts: list[str | None]) -> list[np.ndarray]:
        out: list = [np.zeros(0, np.int32)] * len(texts)
        whole, at, raws, held = [], [], [], 0
        parts: dict[int, list[np.ndarray]] = {}

        def flush() -> None:
            for j, ids in zip(at, self._batch(raws), strict=True):
                parts.setdefault(j, []).append(ids)
            at.clear()
            raws.clear()

        for i, t in enumerate(texts):
            if not t:
                continue
            raw = self._latin(t) if self.by_word is not None else None
            if raw is None:
                whole.append(i)
                continue
            for piece in _pieces(raw):
                at.append(i)
                raws.append(piece)
                held += len(piece)
                if held > BATCH:
                    flush()
                    held = 0
        if raws:
            flush()
        for i, own in parts.items():
            out[i] = own[0] if len(own) == 1 else np.concatenate(own)
        if whole:
            for i, e in zip(whole, self.tokenizer.encode_batch_fast([texts[i] for i in whole], add_special_tokens=False), strict=True):
                out[i] = np.array(e.ids, np.int32)
        return out


_encoders: dict[tuple[str, int], Encoder] = {}


def encoder(path: str, slots: int = 1 << 20) -> Encoder:
    """One encoder for each vocabulary and Python worker."""
    if (path, slots) not in _encoders:
        _encoders[path, slots] = Encoder(path, slots)
    return _encoders[path, slots]
