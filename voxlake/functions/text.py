"""Text functions as Column expressions: normalisation, transliteration, edit distances, stems and word handling."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- Fixed values: what the target voice can speak, and how letters are written in it. ----
ROMAN = {
    "kh": "k", "gh": "g", "jh": "j", "ph": "p", "bh": "b", "ch": "ch", "ṭh": "t", "ḍh": "d",
    "ṭ": "t", "ḍ": "d", "th": "th", "t": "th", "dh": "dh", "d": "dh", "c": "ch",
    "ā": "aa", "ī": "ii", "ū": "uu", "ē": "ee", "ō": "oo", "æ": "ae", "ǣ": "aae", "ṛ": "ru", "ṝ": "ruu",
    "ñ": "ny", "ṅ": "ng", "ṁ": "ng", "ṉ": "n", "ṇ": "n", "ś": "sh", "ş": "sh", "ḷ": "l", "ḥ": "h",
}
CONSONANTS = {
    "ක": "k", "ඛ": "k", "ග": "g", "ඝ": "g", "ඞ": "ng", "ඟ": "ng", "ච": "ch", "ඡ": "ch", "ජ": "j", "ඣ": "j", "ඤ": "ny", "ඥ": "gn",
    "ට": "t", "ඨ": "t", "ඩ": "d", "ඪ": "d", "ණ": "n", "ඬ": "nd", "ත": "th", "ථ": "th", "ද": "dh", "ධ": "dh", "න": "n", "ඳ": "ndh",
    "ප": "p", "ඵ": "p", "බ": "b", "භ": "b", "ම": "m", "ඹ": "mb", "ය": "y", "ර": "r", "ල": "l", "ව": "v", "ශ": "sh", "ෂ": "sh", "ස": "s", "හ": "h", "ළ": "l", "ෆ": "f",
}
VOWELS = {"අ": "a", "ආ": "aa", "ඇ": "ae", "ඈ": "aae", "ඉ": "i", "ඊ": "ii", "උ": "u", "ඌ": "uu", "ඍ": "ru", "එ": "e", "ඒ": "ee", "ඓ": "ai", "ඔ": "o", "ඕ": "oo", "ඖ": "au"}
SIGNS = {"ා": "aa", "ැ": "ae", "ෑ": "aae", "ි": "i", "ී": "ii", "ු": "u", "ූ": "uu", "ෘ": "ru", "ෲ": "ruu", "ෙ": "e", "ේ": "ee", "ෛ": "ai", "ො": "o", "ෝ": "oo", "ෞ": "au"}
VIRAMA, ANUSVARA, VISARGA, JOINER = "්", "ං", "ඃ", "‍"
QUOTES = "‘’“”\""
SPOKEN = "abcdefghijklmnopqrstuvwxyz .,?!'-:;"
SCRIPT = r"[඀-෿]"
DIACRITICS = "(?iu)[āīūēōæǣñśşḍḥḷṁṅṇṉṛṝṭ]"
DIGITS = r"[0-9෦-෯]"
# -------------------------------------------------------------------------------------------


def strip(c: Column) -> Column:
    """Without white space of any kind at both ends (Spark's trim knows blanks only)."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def single_spaced(c: Column) -> Column:
    return strip(F.regexp_replace(c, r"(?U)\s+", " "))


def words(c: Column) -> Column:
    """Words between white space; an empty array for a text without any."""
    return F.array_remove(F.split(single_spaced(c), " "), "")


def word_count(c: Column) -> Column:
    return F.size(words(c))


def spoken(c: Column) -> Column:
    """Lower case, one kind of quote, only characters that can be spoken, single blanks. Tabs and line ends are deleted."""
    c = F.translate(F.replace(F.lower(c), F.lit(JOINER), F.lit("")), QUOTES, "'" * len(QUOTES))
    return F.trim(F.regexp_replace(F.regexp_replace(c, r"[^a-z .,?!'\-:;]", ""), " +", " "))


class Fold:
    """The folds of one text. Column expressions need a pass of its own for every ending of the alphabet (18 passes, and
    fourteen times as long); here a text is translated once."""

    def __init__(self):
        unaspirated = "".join(k[0] for k, v in ROMAN.items() if len(k) == 2 and len(v) == 1)
        aspirated = "".join(k for k, v in ROMAN.items() if len(k) == 1 and k.isascii() and v == k + "h")
        letters, signs = "".join(CONSONANTS), "".join(SIGNS)
        self.is_script = re.compile(SCRIPT)
        self.lose, self.gain = re.compile(f"([{unaspirated}])h"), re.compile(f"[{aspirated}](?!h)")
        self.stray, self.bare = re.compile(f"(?<![{letters}])[{VIRAMA}{signs}]"), re.compile(f"([{letters}])(?![{VIRAMA}{signs}])")
        self.roman = str.maketrans({k: v for k, v in ROMAN.items() if len(k) == 1 and not k.isascii()})
        self.letters = str.maketrans({**CONSONANTS, **VOWELS, **SIGNS, ANUSVARA: "ng", VISARGA: "h", VIRAMA: ""})
        self.quotes = str.maketrans({**dict.fromkeys(QUOTES, "'"), JOINER: ""})
        self.silent, self.blanks = re.compile(f"[^{re.escape(SPOKEN)}]"), re.compile(" +")

    def spoken(self, text: str) -> str:
        return self.blanks.sub(" ", self.silent.sub("", text.lower().translate(self.quotes))).strip(" ")

    def fold_roman(self, text: str) -> str:
        text = text.lower().translate(self.quotes)
        return self.spoken(self.gain.sub(r"\g<0>h", self.lose.sub(r"\1", text)).translate(self.roman))

    def fold_script(self, text: str) -> str:
        text = self.stray.sub("", text.replace(JOINER, ""))
        return self.spoken(self.bare.sub(r"\1a", text).translate(self.letters))

    def fold(self, text: str) -> str:
        return self.fold_script(text) if self.is_script.search(text) else self.fold_roman(text)


def _folded(c: Column, kind: str) -> Column:
    from pyspark.sql.functions import pandas_udf

    @pandas_udf("string")
    def folded(texts: pd.Series) -> pd.Series:
        one = getattr(Fold(), kind)
        return pd.Series([one(x) if isinstance(x, str) else None for x in texts], dtype=object)

    return folded(c)


def fold_roman(c: Column) -> Column:
    """Romanised text in plain letters, as one left-to-right pass over ROMAN with the longest key first would write it:
    aspirates lose their h, plain dentals and c get one, then the letters with marks are spelled out."""
    return _folded(c, "fold_roman")


def fold_script(c: Column) -> Column:
    """Script in the same plain letters: a consonant carries `a` unless a sign or the virama follows; signs that follow no
    consonant go."""
    return _folded(c, "fold_script")


def fold(c: Column) -> Column:
    """The fold of the alphabet that the text is written in."""
    return _folded(c, "fold")


def unmapped(c: Column, known: str | None = None) -> Column:
    """Non-ASCII characters that the fold has no rule for, in order."""
    known = known if known is not None else "".join(dict.fromkeys(ch for k in ROMAN for ch in k if ord(ch) > 127)) + "‘’“”" + JOINER
    return F.regexp_extract_all(F.lower(c), F.lit(f"[^\\x00-\\x7F{known}]"), F.lit(0))


def character_counts(df, c: Column):
    """(ch, n): how often each character occurs."""
    return df.select(F.explode(F.split(c, "")).alias("ch")).filter("ch <> ''").groupBy("ch").agg(F.count("*").alias("n"))


def strip_ansi(c: Column) -> Column:
    return F.regexp_replace(c, r"\x1b\[[0-9;?]*[a-zA-Z]", "")


def path_name(c: Column) -> Column:
    return F.regexp_extract(c, r"([^/]*)/*$", 1)


def path_stem(c: Column) -> Column:
    """Last component without its last suffix; a leading dot is no suffix."""
    return F.regexp_replace(path_name(c), r"(?<=.)\.[^.]*$", "")


def episode_stem(c: Column) -> Column:
    """A file's stem as a folder name: runs of other characters than letters, digits and _ become _."""
    return F.regexp_replace(F.regexp_replace(path_stem(c), r"(?U)\W+", "_"), "^_+|_+$", "")


def episode_of_clip(c: Column) -> Column:
    """What stands before the last double underscore of a clip id."""
    return F.regexp_extract(c, r"(?s)^(.*)__", 1)


def clip_id(stem: Column, index: Column) -> Column:
    return F.concat(stem, F.lit("__"), F.lpad(index.cast("string"), 4, "0"))


def character_error_rate(ref: Column, hyp: Column) -> Column:
    """Edit distance over the reference's length, both single-spaced; an empty reference: 1 if anything was heard."""
    a, b = single_spaced(ref), single_spaced(hyp)
    return F.when(F.char_length(a) == 0, F.when(F.char_length(b) > 0, 1.0).otherwise(0.0)).otherwise(F.levenshtein(a, b) / F.char_length(a))


def token_distance(a: Column, b: Column) -> Column:
    """Edit distance of two arrays of strings of any length; null if one is null."""
    from pyspark.sql.functions import pandas_udf

    @pandas_udf("int")
    def distance(xs: pd.Series, ys: pd.Series) -> pd.Series:
        import numpy as np

        def one(x, y):
            if x is None or y is None:
                return None
            number: dict = {}
            x, y = ([number.setdefault(w, len(number)) for w in ws] for ws in (x, y))
            y, ramp = np.array(y, np.int64), np.arange(len(y) + 1)
            row = ramp
            # a row of the table at once: the best without a step along the row, then the cheapest such step
            for i, w in enumerate(x, 1):
                new = np.empty_like(row)
                new[0] = i
                np.minimum(row[1:] + 1, row[:-1] + (y != w), out=new[1:])
                row = np.minimum.accumulate(new - ramp) + ramp
            return int(row[-1])

        return pd.Series([one(x, y) for x, y in zip(xs, ys, strict=True)], dtype="Int32")

    return distance(a, b)


def word_accuracy(ref: Column, hyp: Column) -> Column:
    """1 minus the word error rate, not below 0; 0 for an empty reference."""
    a, b = words(ref), words(hyp)
    return F.when(F.size(a) == 0, 0.0).otherwise(F.greatest(F.lit(0.0), 1.0 - token_distance(a, b) / F.size(a)))


def interleave(a: Column, b: Column) -> Column:
    """Even places from a, odd ones from b (arrays of one length)."""
    return F.transform(a, lambda x, i: F.when(i % 2 == 0, x).otherwise(F.get(b, i)))


def with_full_stop(c: Column) -> Column:
    """A sentence that ends in one full stop."""
    right = F.regexp_replace(c, r"(?U)\s+$", "")
    return F.when(right.endswith("."), c).otherwise(F.concat(F.regexp_replace(right, "[ .,]+$", ""), F.lit(".")))


def html_escape(c: Column) -> Column:
    for k, v in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        c = F.replace(c, F.lit(k), F.lit(v))
    return c


def has_script(c: Column) -> Column:
    return c.rlike(SCRIPT)


def has_diacritics(c: Column) -> Column:
    return c.rlike(DIACRITICS)


def has_digits(c: Column) -> Column:
    return c.rlike(DIGITS)


def character_name():
    """Pandas UDF: the Unicode name of the first character, `?` if it has none."""
    from pyspark.sql.functions import pandas_udf

    @pandas_udf("string")
    def name(s: pd.Series) -> pd.Series:
        import unicodedata

        return s.map(lambda x: unicodedata.name(x[0], "?") if x else "?")

    return name


def common_edits(df, left: str, right: str, most: int = 6):
    """(op, a, b, n): the commonest edits between two columns' texts."""

    def edits(batches):
        import difflib

        for pdf in batches:
            rows = []
            for a, b in zip(pdf["a"], pdf["b"], strict=True):
                for op, i, j, k, m in difflib.SequenceMatcher(None, a or "", b or "", autojunk=False).get_opcodes():
                    if op != "equal":
                        rows.append((op, (a or "")[i:j], (b or "")[k:m]))
            yield pd.DataFrame(rows, columns=["op", "a", "b"])

    found = df.select(F.col(left).alias("a"), F.col(right).alias("b")).mapInPandas(edits, "op string, a string, b string")
    return found.groupBy("op", "a", "b").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "op", "a", "b").limit(most)
