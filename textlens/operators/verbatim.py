"""Verbatim forms of a phrase: overlapping fragments, common cores, templates, differences.

The forms of one phrase are few and short; each phrase is one group of distinct forms (never of
occurrences), handled in ``applyInPandas``.
"""

from __future__ import annotations

import difflib
import re
from collections import defaultdict

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from textlens.session import written


def joints(fragments: list[str], least: int) -> list[tuple[int, int, int]]:
    """(length, i, j) of the widest overlap of each pair: an end of fragment i that begins fragment j.

    Fragments are indexed by their first ``least`` letters, so only ends that begin like one are compared.
    """
    heads = defaultdict(list)
    for j, f in enumerate(fragments):
        if len(f) >= least:
            heads[f[:least]].append(j)
    out = []
    for i, f in enumerate(fragments):
        met = set()
        for at in range(len(f) - least + 1):  # the widest overlap of a pair comes first
            for j in heads.get(f[at : at + least], ()):
                n = len(f) - at
                if j != i and j not in met and n <= len(fragments[j]) and fragments[j].startswith(f[at:]):
                    met.add(j)
                    out.append((n, i, j))
    return out


def _low(s: str) -> str:
    """Lower case, letter for letter."""
    return s.lower() if len(s.lower()) == len(s) else "".join(c.lower() if len(c.lower()) == 1 else c for c in s)


def assembled(fragments: list[str], least: int = 10) -> list[tuple[str, list[int]]]:
    """(text, fragments it is made of): distinct fragments joined where they overlap by ``least`` letters or more, case aside.

    The widest joint goes first (ties by place); an end and a beginning are used once, and no ring closes. What is
    left alone stays. One sort of the joints, no repeated passes: joining uses up two ends and makes no new ones.
    """
    after: dict[int, tuple[int, int]] = {}
    has_before, chain = set(), list(range(len(fragments)))

    def head(i: int) -> int:
        while chain[i] != i:
            chain[i] = chain[chain[i]]
            i = chain[i]
        return i

    for n, i, j in sorted(joints([_low(f) for f in fragments], least), key=lambda x: (-x[0], x[1], x[2])):
        if i not in after and j not in has_before and head(i) != head(j):
            after[i] = j, n
            has_before.add(j)
            chain[head(j)] = head(i)
    out = []
    for i, text in enumerate(fragments):
        if i in has_before:
            continue
        parts, at = [i], i
        while at in after:
            at, n = after[at]
            text += fragments[at][n:]
            parts.append(at)
        out.append((text, parts))
    return out


def common_core(strings: list[str]) -> str:
    """Longest substring (case aside) of all strings, in the first one's case; the leftmost of equals."""
    if not strings:
        return ""
    first, low = strings[0], [s.lower() for s in strings]
    lo, hi, best = 0, min(map(len, low)), ""
    while lo <= hi:  # if a length works, every shorter one does
        n = (lo + hi) // 2
        at = next((i for i in range(len(first) - n + 1) if all(low[0][i : i + n] in s for s in low[1:])), None)
        if at is None:
            hi = n - 1
        else:
            best, lo = first[at : at + n], n + 1
    return best


def slot(variants: list[str]) -> str:
    """Regex group of the variants of a slot, longest first; optional if one is empty."""
    some = sorted({v for v in variants if v}, key=lambda v: (-len(v), v))
    if not some:
        return ""
    return "(" + "|".join(map(re.escape, some)) + ")" + ("?" if any(not v for v in variants) else "")


def template(forms: list[str], least_core: int = 10) -> dict:
    """core, prefix and suffix slots and the regex of a phrase's forms; a short core gives the longest form."""
    core = common_core(forms)
    if len(core) < least_core:
        core = max(forms, key=lambda f: (len(f), f))
        return {"core": core, "prefix_slot": "", "suffix_slot": "", "regex": re.escape(core)}
    cut = [(f[: _low(f).find(core.lower())], f[_low(f).find(core.lower()) + len(core) :]) for f in forms]
    pre, post = slot([a for a, _ in cut]), slot([b for _, b in cut])
    return {"core": core, "prefix_slot": pre, "suffix_slot": post, "regex": pre + re.escape(core) + post}


def infix(forms: list[str]) -> tuple[str, str, str]:
    """(common beginning, slot of what differs, common end) of the forms, case aside; the beginning is found first."""
    if not forms:
        return "", "", ""
    first, low = forms[0], [_low(f) for f in forms]
    n = 0
    while n < min(map(len, low)) and len({x[n] for x in low}) == 1:
        n += 1
    m = 0
    while m < min(map(len, low)) - n and len({x[len(x) - 1 - m] for x in low}) == 1:
        m += 1
    return first[:n], slot([f[n : len(f) - m] for f in forms]), first[len(first) - m :] if m else ""


def difference(form: str, longest: str) -> tuple[str, str, str]:
    """(missing prefix, missing suffix, summary) of a form against the longest one."""
    at = longest.lower().find(form.lower())
    if at >= 0:
        return longest[:at], longest[at + len(form) :], "contained"
    same = sum(b.size for b in difflib.SequenceMatcher(None, longest.lower(), form.lower(), autojunk=False).get_matching_blocks())
    return "", "", f"shares {same} of {len(longest)}"


def templates(forms: DataFrame, least_core: int = 10) -> DataFrame:
    """(phrase_id, n_forms, core, prefix_slot, suffix_slot, regex) from (phrase_id, verbatim_text)."""

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        names = sorted(pdf["verbatim_text"])
        return pd.DataFrame([{"phrase_id": pdf["phrase_id"].iloc[0], "n_forms": len(names), **template(names, least_core)}])

    rows = forms.select("phrase_id", "verbatim_text").where("phrase_id is not null and verbatim_text is not null").distinct()
    return rows.groupBy("phrase_id").applyInPandas(lambda pdf: one(pdf), "phrase_id string, n_forms int, core string, prefix_slot string, suffix_slot string, regex string")


def differences(forms: DataFrame) -> DataFrame:
    """(phrase_id, verbatim_text, prefix_diff, suffix_diff, summary) against the phrase's longest form."""

    @F.pandas_udf("struct<prefix_diff:string,suffix_diff:string,summary:string>")
    def diff(form: pd.Series, longest: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([difference(f, g) for f, g in zip(form, longest)], columns=["prefix_diff", "suffix_diff", "summary"])

    rows = forms.select("phrase_id", "verbatim_text").where("phrase_id is not null and verbatim_text is not null").distinct()
    longest = rows.groupBy("phrase_id").agg(F.max(F.struct(F.length("verbatim_text").alias("n"), "verbatim_text")).alias("m")).select("phrase_id", F.col("m.verbatim_text").alias("longest"))
    return rows.join(longest, "phrase_id").select("phrase_id", "verbatim_text", diff("verbatim_text", "longest").alias("d")).select("phrase_id", "verbatim_text", "d.*")


def within_words(short: str, long: str) -> bool:
    """Whether short occurs in long between word boundaries."""
    at = long.find(short)
    while at >= 0:
        end = at + len(short)
        if (at == 0 or not (long[at - 1].isalnum() and short[0].isalnum())) and (end == len(long) or not (long[end].isalnum() and short[-1].isalnum())):
            return True
        at = long.find(short, at + 1)
    return False


def refined(forms: list[tuple[str, int, frozenset]], least: int = 10, truncated: int = 20) -> list[tuple[str, int, frozenset]]:
    """(form, count, records) in four stages, letter case aside; forms of a longer text meet only it and shorter ones.

    1. Forms of the same records are assembled where they overlap; counts add, the first form's case stays.
    2. A form between word boundaries of a longer one that shares a record goes.
    3. One without a common record joins the longest form that holds it.
    4. A form of ``truncated`` letters or more that begins or ends a longer one, cut within a word, joins it.
    """
    by_ids = defaultdict(list)
    for f, n, ids in forms:
        by_ids[ids].append((f, n))
    level: dict[str, list] = {}
    for ids, some in by_ids.items():
        some.sort(key=lambda x: (-len(x[0]), x[0]))
        lower, keep, count = {}, [], []
        for f, n in some:  # spellings that differ in case only are one
            if _low(f) in lower:
                count[lower[_low(f)]] += n
            else:
                lower[_low(f)] = len(keep)
                keep.append(f)
                count.append(n)
        for text, parts in assembled(keep, least):
            entry = level.setdefault(text, [0, set()])
            entry[0] += sum(count[j] for j in parts)
            entry[1] |= ids
    order = sorted(level, key=lambda f: (-len(f), f))
    kept: list[str] = []
    for f in order:
        low = _low(f)
        holders = [g for g in kept if len(g) > len(f) and within_words(low, _low(g))]
        if any(level[g][1] & level[f][1] for g in holders):
            continue
        kept.append(f)
    out: list[str] = []
    for f in kept:
        low = _low(f)
        into = next((g for g in out if len(g) > len(f) and within_words(low, _low(g))), None)
        if into is None and len(f) >= truncated:
            into = next((g for g in out if len(g) > len(f) and (_low(g).startswith(low) or _low(g).endswith(low))), None)
        if into is None:
            out.append(f)
        else:
            level[into][0] += level[f][0]
            level[into][1] |= level[f][1]
    return [(f, level[f][0], frozenset(level[f][1])) for f in out]


def refine(forms: DataFrame, least: int = 10, truncated: int = 20) -> DataFrame:
    """(phrase_id, form, n, n_ids): the verbatim forms of each phrase after the four stages of ``refined``.

    forms: (phrase_id, verbatim_text, tinyId), one row an occurrence. Record sets are never gathered: the
    stages compare them by digest and by the distinct forms that share a record. A phrase's distinct forms (never its
    occurrences) meet in one task.
    """
    rows = forms.where("phrase_id is not null and verbatim_text is not null and tinyId is not null")
    rows = rows.select("phrase_id", F.trim(F.regexp_replace("verbatim_text", r"\s+", " ")).alias("form"), "tinyId").where("form <> ''")
    per = rows.groupBy("phrase_id", "form", "tinyId").agg(F.count("*").alias("c"))
    # forms of one phrase with equal records have one class; classes that share a record are linked
    digest = per.groupBy("phrase_id", "form").agg(F.sum("c").alias("n"), F.count("*").alias("n_ids"), F.sum(F.xxhash64("tinyId").cast("decimal(38,0)")).alias("a"), F.sum(F.xxhash64("tinyId", F.lit(7)).cast("decimal(38,0)")).alias("b"))
    digest = written(digest.withColumn("ids", F.xxhash64("n_ids", "a", "b")), "forms")
    held = per.join(digest.select("phrase_id", "form", "ids"), ["phrase_id", "form"]).select("phrase_id", "tinyId", "ids").distinct()
    shares = held.groupBy("phrase_id", "tinyId").agg(F.array_sort(F.collect_set("ids")).alias("s")).groupBy("phrase_id", "s").agg(F.count("*").alias("w"))

    def one(key, pdf: pd.DataFrame, sets: pd.DataFrame) -> pd.DataFrame:
        # a record class is written as the set of distinct "which forms does a record hold" rows, weighted by records
        weight, of = [], defaultdict(set)
        for i, (s, w) in enumerate(zip(sets["s"], sets["w"])):
            weight.append(int(w))
            for c in s:
                of[c].add(i)
        got = refined([(f, int(n), frozenset(of[c])) for f, n, c in zip(pdf["form"], pdf["n"], pdf["ids"])], least, truncated)
        return pd.DataFrame({"phrase_id": key[0], "form": [f for f, _, _ in got], "n": [n for _, n, _ in got], "n_ids": [sum(weight[i] for i in s) for _, _, s in got]})

    return digest.groupBy("phrase_id").cogroup(shares.groupBy("phrase_id")).applyInPandas(one, "phrase_id string, form string, n bigint, n_ids bigint")
