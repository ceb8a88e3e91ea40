"""Scalar text functions as column expressions. All give null for null unless said otherwise."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, functions as F

# Typographic signs and their ASCII forms (fixed values); letters with marks fall to their base letter by rule.
ASCII_SIGNS = {
    "‘": "'", "’": "'", "‚": "'", "“": '"', "”": '"', "„": '"', "–": "-", "—": "-", "‐": "-", "‑": "-", "−": "-", "…": "...", "•": "*",
    " ": " ", " ": " ", " ": " ", "​": "", "﻿": "", "�": "", "×": "x", "÷": "/", "±": "+/-", "≤": "<=", "≥": ">=",
    "≠": "!=", "°": " degrees", "µ": "u", "μ": "u", "½": "1/2", "¼": "1/4", "¾": "3/4", "™": "(TM)", "®": "(R)", "©": "(C)", "ß": "ss", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE", "ø": "o", "Ø": "O", "ł": "l", "Ł": "L",
}
_TRANSLATE = str.maketrans(ASCII_SIGNS)


def flatten_lines(c: Column) -> Column:
    """Line ends unified, runs of line breaks as one blank, runs of blanks as one, trimmed."""
    s = F.regexp_replace(F.regexp_replace(c, r"\r\n?", "\n"), r"\n+", " ")
    return F.trim(F.regexp_replace(s, " {2,}", " "))


def to_ascii(c: Column) -> Column:
    """Signs by table, letters with marks by their base letter, everything else beyond ASCII dropped."""

    @F.pandas_udf("string")
    def fold(s: pd.Series) -> pd.Series:
        def one(t):
            if t is None or t.isascii():
                return t
            return unicodedata.normalize("NFKD", t.translate(_TRANSLATE)).encode("ascii", "ignore").decode()

        return s.map(one)

    # Only texts with other letters travel to Python.
    return F.when(c.rlike(r"[^\x00-\x7F]"), fold(c)).otherwise(c)


def nfc(c: Column) -> Column:
    """Unicode normal form C."""

    @F.pandas_udf("string")
    def norm(s: pd.Series) -> pd.Series:
        return s.map(lambda t: None if t is None else unicodedata.normalize("NFC", t))

    return F.when(c.rlike(r"[^\x00-\x7F]"), norm(c)).otherwise(c)


def sanitize(c: Column) -> Column:
    """Empty for null; trimmed, lines flattened, ASCII."""
    return F.coalesce(to_ascii(flatten_lines(F.trim(c))), F.lit(""))


def is_number(c: Column) -> Column:
    return F.coalesce(F.trim(c).rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), F.lit(False))


def value_type(c: Column, char_limit: int = 10, compat: bool = False) -> Column:
    """null, int, float, str<limit> (shorter than the limit) or str; compat swaps int and float."""
    whole = F.trim(c).rlike(r"^[+-]?\d+(\.0+)?$")
    first, second = ("float", "int") if compat else ("int", "float")
    return F.when(c.isNull(), "null").when(is_number(c), F.when(whole, first).otherwise(second)).when(F.length(c) < char_limit, f"str{char_limit}").otherwise("str")


def norm_name(c: Column) -> Column:
    """Lower case, leading article off, blanks single."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(F.trim(c)), r"\s+", " "), r"^(the|a|an) ", ""))


def slug(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(F.trim(c)), r"[^a-z0-9]+", "_"), r"^_+|_+$", "")


def cut_delimiters(c: Column) -> Column:
    """Without blanks and delimiters at either end."""
    return F.regexp_replace(c, r"^[\s\-–—:;,./|]+|[\s\-–—:;,./|]+$", "")


def word_count(c: Column) -> Column:
    return F.size(F.filter(F.split(c, r"\s+"), lambda w: w != ""))


LETTERS = r"\p{L}\p{N}"


def tokens(c: Column) -> Column:
    """Runs of letters and digits in lower case."""
    return F.transform(F.regexp_extract_all(c, F.lit(f"[{LETTERS}]+"), F.lit(0)), F.lower)


def pieces(c: Column) -> Column:
    """One piece of the text for each of its ``tokens``: the token as written, with the signs before it."""
    return F.regexp_extract_all(c, F.lit(f"[^{LETTERS}]*[{LETTERS}]+"), F.lit(0))


def verbatim(pieces: Column, start: Column, k) -> Column:
    """The text from token ``start`` on, k tokens long, exactly as written."""
    return F.regexp_replace(F.array_join(F.slice(pieces, start + 1, k), ""), f"^[^{LETTERS}]+", "")


def contains_word(text: Column, word: Column) -> Column:
    """Whether word occurs in text between word boundaries (literal, case-sensitive)."""
    return F.instr(F.concat(F.lit(" "), F.regexp_replace(text, r"[^A-Za-z0-9_]", " "), F.lit(" ")), F.concat(F.lit(" "), word, F.lit(" "))) > 0


CONTRACTIONS = {"can't": "cannot", "won't": "will not", "n't": " not", "'re": " are", "'ve": " have", "'ll": " will", "'m": " am"}


def expand_contractions(c: Column) -> Column:
    for short, long in CONTRACTIONS.items():
        c = F.regexp_replace(c, rf"(?i){short}\b", long)
    return c
