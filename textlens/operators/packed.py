"""Several values packed in one cell into one row per value, guided by a dictionary of known values.

Cells are cut at separators (comma, semicolon, bar, line break, tab; for single-word values every
white space). Quotes protect separators, and so does the dictionary: an Aho-Corasick automaton finds
the known whole values in the cell, and dynamic programming picks the cover of the cell's pieces with
the best score, where a known value that spans a separator stays whole. Only known values with a separator
can decide anything, so only they are looked up: single words never hold one and need no dictionary.

Dictionaries may be far larger than a worker's memory: a value is a candidate for a cell if its first two
pieces stand side by side there, found by one equi-join on the hash of such pairs (a cell sends as many rows as
it has pieces). Each Arrow batch builds its automaton from its cells' candidates and sees which of them
really occur.

Nulls, empty and blank cells give no rows. Empty pieces take no position. Repeated values stay.
Repeated rows (equal in all columns read) count once. Very long cells are handled whole.
"""

from __future__ import annotations

import re

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame, functions as F

SEPARATORS = ",;|\n\r\t"
_QUOTES = "\"'"
_CLOSERS = {"[": "]", "(": ")", "{": "}"}


def _norm(text: str) -> str:
    return " ".join(text.lower().split())


def _unquote(piece: str) -> str:
    """Without the quotes or square brackets around it; a doubled or escaped quote inside stands for one."""
    p = piece.strip()
    if len(p) >= 2 and p[0] == p[-1] and p[0] in _QUOTES:
        q = p[0]
        return re.sub(rf"\\({q})|{q}({q})", lambda m: q, p[1:-1]).strip()
    if len(p) >= 2 and p[0] == "[" and p[-1] == "]" and not set(p[1:-1]) & {"[", "]"}:
        return _unquote(p[1:-1])
    return p


def _unwrap(cell: str, words: bool) -> str:
    """Without the brackets around the whole cell, and for single words without quotes around it."""
    c = cell.strip()
    while len(c) >= 2:
        if c[0] in _CLOSERS and c[-1] == _CLOSERS[c[0]] and (words or c[0] == "[") and not set(c[1:-1]) & {c[0], c[-1]}:
            c = c[1:-1].strip()
        elif words and c[0] == c[-1] and c[0] in _QUOTES and c[0] not in c[1:-1]:
            c = c[1:-1].strip()
        else:
            break
    return c


def pieces(cell: str, words: bool = False) -> list[str]:
    """The cell cut at every separator outside quotes, with the separators at the odd places.

    A quote opens only at the start of a piece and closes only before a separator or the end, so the
    apostrophe of "patient's" is no quote; if no quote closes, the opening one is ordinary text.
    """
    out, n, i, start = [], len(cell), 0, 0
    is_sep = (lambda ch: ch in SEPARATORS or ch.isspace()) if words else (lambda ch: ch in SEPARATORS)
    fresh = True
    while i < n:
        ch = cell[i]
        if fresh and ch in _QUOTES:
            j = i + 1
            while j < n:
                if cell[j] == "\\" and j + 1 < n:
                    j += 2
                    continue
                if cell[j] == ch:
                    if j + 1 < n and cell[j + 1] == ch and ch == '"':
                        j += 2
                        continue
                    k = j + 1
                    while k < n and cell[k] == " ":
                        k += 1
                    if k == n or is_sep(cell[k]) or (words and k > j + 1):
                        break
                j += 1
            if j < n:
                i, fresh = j + 1, False
                continue
        if is_sep(ch):
            out += [cell[start:i], ch]
            i = start = i + 1
            fresh = True
            continue
        fresh = fresh and ch == " "
        i += 1
    out.append(cell[start:])
    return out


def neighbours(text: str | None) -> list[str]:
    """The pairs of pieces that stand side by side, normalised."""
    if text is None:
        return []
    p = [x for x in (_norm(_unquote(x)) for x in pieces(text)[::2]) if x]
    return sorted({f"{a}\n{b}" for a, b in zip(p, p[1:])})


def automaton(values) -> ahocorasick.Automaton | None:
    a = ahocorasick.Automaton()
    for v in values:
        if v:
            a.add_word(v, v)
    if not len(a):
        return None
    a.make_automaton()
    return a


def segment(cell: str | None, known: ahocorasick.Automaton | None, words: bool = False) -> list[str]:
    """The values of a cell in order: the best cover of its pieces by known values and single pieces."""
    if cell is None or not cell.strip():
        return []
    p = pieces(_unwrap(cell, words), words)
    whole: dict[int, list[int]] = {}  # last piece -> first pieces of known values that end there
    if known is not None:
        # places of the pieces in the normalised text that the automaton reads
        line, begin, end = "", {}, {}
        for i, raw in enumerate(p):
            if i % 2:
                line += raw.strip() or ("" if line.endswith(" ") else " ")
                continue
            x = _norm(raw)
            if raw[:1].isspace() and line and not line.endswith(" "):
                line += " "
            if x:
                begin[len(line)] = i
                line += x
                end[len(line)] = i
                if raw[-1:].isspace():
                    line += " "
        for stop, value in known.iter(line):
            b, a = end.get(stop + 1), begin.get(stop + 1 - len(value))
            if a is not None and b is not None and a < b:
                whole.setdefault(b, []).append(a)
    # best[i]: (score, back) of a cover of the pieces before i; known values 3 a piece less 1, others 1 a piece
    best: list[tuple[float, int]] = [(0.0, -1)]
    for i in range(0, len(p), 2):
        score, back = best[i // 2][0] + 1.0, i
        for a in whole.get(i, ()):
            s = best[a // 2][0] + 3.0 * ((i - a) // 2 + 1) - 1.0
            if s > score:
                score, back = s, a
        best.append((score, back))
    out, i = [], len(p) - 1
    while i >= 0:
        a = best[i // 2 + 1][1]
        out.append("".join(p[a : i + 1]))
        i = a - 2
    return [v for v in (_unquote(x) for x in reversed(out)) if v]


def split_packed(df: DataFrame, row_id: str, packed: str, dictionary: DataFrame | None, words: bool = False) -> DataFrame:
    """(row_id, pos, item) of the cells in column ``packed``.

    dictionary: a DataFrame whose column ``value`` holds known whole values, of any size, or None.
    words: values are single words, so every white space separates and a dictionary has nothing to protect.
    """
    cells = df.select(F.col(row_id).alias("row_id"), F.col(packed).alias("cell")).where("cell is not null").distinct()
    if dictionary is not None and not words:

        @F.pandas_udf("string")
        def head(s: pd.Series) -> pd.Series:
            return s.map(lambda v: "\n".join([x for x in (_norm(_unquote(x)) for x in pieces(v)[::2]) if x][:2]))

        @F.pandas_udf("array<string>")
        def pairs(s: pd.Series) -> pd.Series:
            return s.map(lambda c: neighbours(_unwrap(c, words)))

        norm = F.lower(F.trim(F.regexp_replace("value", r"(?U)\s+", " ")))
        entries = dictionary.where(F.col("value").rlike(f"[{SEPARATORS}]")).select(norm.alias("value")).distinct()
        entries = entries.select("value", head("value").alias("pair")).where("pair like '%\n%'")
        wanted = cells.where(F.col("cell").rlike(f"[{SEPARATORS}]")).select("row_id", "cell", F.explode(pairs("cell")).alias("pair"))
        hits = wanted.join(entries, "pair").groupBy("row_id", "cell").agg(F.collect_set("value").alias("known"))
        cells = cells.join(hits, ["row_id", "cell"], "left")
    else:
        cells = cells.withColumn("known", F.lit(None).cast("array<string>"))

    def gathered(batches):
        rows: list[tuple] = []
        for pdf in batches:
            auto = automaton({v for ks in pdf["known"] if ks is not None for v in ks})
            for row_id, cell in zip(pdf["row_id"], pdf["cell"]):
                rows += [(row_id, i, v) for i, v in enumerate(segment(cell, auto, words), 1)]
                if len(rows) > 20_000:
                    yield pd.DataFrame(rows, columns=["row_id", "pos", "item"])
                    rows = []
        yield pd.DataFrame(rows, columns=["row_id", "pos", "item"])

    kind = df.schema[row_id].dataType.simpleString()
    return cells.mapInPandas(gathered, f"row_id {kind}, pos int, item string")
