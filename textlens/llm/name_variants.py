"""Spellings of names typed by people, linked to one entity by merge-and-rematch resolution (problem 1).

A name is read into a profile: topic, target group, edition, author spellings, acronyms (initials). Which
words are idle and which are topics is learned from the names themselves, by ``learn``:

* A word is idle (an aspect, a co-author, a short form of one) if names are seen with and without it, all
  other words, group and edition being equal: in ``IDLE`` of its contexts or more. Contexts that hold no rarer
  word do not count: a lead author is not idle because nameless scales exist. Idle words are left out.
* Of the others, words in ``TOPIC`` of all names or more are topics and must agree; the rest are the telling
  words, whose joined letters are the spelling that is compared.

Both measures are shares, so a name is read alike at every size of the collection. Mistyped and shortened
words are read as the nearest known word. Fixed are only words of naming itself: kinds of instrument, target
groups, edition words and numerals. Profiles of equal reading are one.

Profiles of the same topic, group and edition match if two of their spellings are within ``DISTANCE`` edits
(transpositions count one), or within ``FAR`` edits if there is a topic and an acronym and the first letter
agree as well. Matched profiles merge: spellings and acronyms unite. The first rule asks about single
spellings, which merging does not change, so it is settled in one pass over the deletion variants (up to two
letters left out) that profiles share. The second also hangs on what has gathered, so the richer profiles
are blocked anew, by acronym and first letter, until a round merges nothing; blocks without a richer profile
are not compared again. In a block every pair is compared that is not united yet, cheaply by letters first
(in numpy beyond ``CROWDED`` spellings). What neither rule can change again is left alone, so the end is that of
matching everything in every round. Merging is by connected components over profile numbers (label propagation
with pointer jumping, written out between steps), never on the driver.

Nulls and blank names have no links. Names whose telling words have fewer than four letters match equal
spellings only (case, white space and punctuation aside). Repeated rows count once; very long names are read
whole. Empty tables give an empty table. Extra columns are not read. A collection too small to teach which
words are idle or topics reads all words as telling; ``Lexicon`` may be given instead.
"""

from __future__ import annotations

import re
import unicodedata
from collections import defaultdict
from dataclasses import dataclass
from functools import lru_cache
from itertools import count

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from textlens.session import discard, table, written

DISTANCE, FAR, CROWDED = 2, 4, 64
# A word is idle from this share of its contexts, a topic from this share of all names; both want some names to judge by.
IDLE, TOPIC, LEAST_CONTEXTS, LEAST_TOPIC = 0.01, 0.005, 8, 20
# Words in fewer of the contexts than one in RARE are not judged: that bounds the lexicon the workers get.
RARE = 5_000

# Words of naming and their usual short forms (fixed values).
KINDS = {
    "scale": "sc scl scales", "index": "idx indx", "inventory": "inv invent", "questionnaire": "questionaire quest qnr q'naire",
    "survey": "srv survy", "interview": "interv intvw", "checklist": "chklist check_list", "battery": "batt bttry",
    "schedule": "sched schd", "form": "frm rf ratingform", "rating": "rtg", "tool": "", "test": "tests", "measure": "measures", "instrument": "", "assessment": "assess",
}
GROUPS = {
    "adolescent": "adolescents adol teen teens teenager teenagers youth youths", "child": "children childs childrens paediatric pediatric kids", "infant": "infants baby babies",
    "adult": "adults adlt adlts", "elderly": "geriatric seniors", "teacher": "teachers tchr", "parent": "parents", "caregiver": "caregivers carer carers care_giver", "clinician": "clinicians clin",
    "student": "students", "patient": "patients", "nurse": "nurses",
}
ORDINALS = {"first": 1, "second": 2, "third": 3, "fourth": 4, "fifth": 5, "sixth": 6, "1st": 1, "2nd": 2, "3rd": 3, "4th": 4, "5th": 5, "6th": 6}
ROMAN = {"i": 1, "ii": 2, "iii": 3, "iv": 4, "v": 5, "vi": 6}
EDITION_WORDS = set("ed edition version ver v edn rev vers".split())
CONNECTIVES = set("the of for on by and et al a an in to with s".split())


def edits(a: str, b: str, most: int) -> int:
    """Optimal-string-alignment distance, or most + 1 beyond most; only a band of width ``most`` is filled."""
    n, m, far = len(a), len(b), most + 1
    if abs(n - m) > most:
        return far
    if a == b:
        return 0
    before: list[int] = []
    last = [j if j <= most else far for j in range(m + 1)]
    for i in range(1, n + 1):
        low, high = max(1, i - most), min(m, i + most)
        row = [far] * (m + 1)
        row[0] = i if i <= most else far
        x, best = a[i - 1], row[0]
        for j in range(low, high + 1):
            y = b[j - 1]
            d = last[j - 1] if x == y else min(last[j - 1], last[j], row[j - 1]) + 1
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y and before[j - 2] + 1 < d:
                d = before[j - 2] + 1
            row[j] = d
            if d < best:
                best = d
        if best > most:
            return far
        before, last = last, row
    return min(last[m], far)


def _known(kinds: dict, groups: dict) -> dict[str, tuple[str, str]]:
    out = {}
    for role, entries in (("kind", kinds), ("group", groups)):
        for word, short in entries.items():
            for w in (word, *short.split()):
                out[w.replace("_", " ")] = role, word
    return out


class Reader:
    """Reads a name's words, group, edition and acronyms; kinds and groups in a usual form are set aside."""

    def __init__(self, kinds: dict | None = None, groups: dict | None = None):
        self.words = _known(kinds or KINDS, groups or GROUPS)

    def read(self, name: str | None, acronym: str | None = None) -> dict:
        """words (in order), grp, edition, acronyms, plain (for equality)."""
        s = unicodedata.normalize("NFKC", name or "").replace("’", "'").replace("\u00ad", "").lower().strip()
        acronyms = set()
        if acronym and (letters := re.sub(r"[^a-z]", "", acronym.lower().split("-")[0])):
            acronyms.add(letters)
        s = re.sub(r"'s\b", "", s).replace("s' ", "s ")
        plain = " ".join(re.findall(r"[^\W_]+", s))
        if m := re.match(r"^([a-z]{2,8})((?:[ -](?:v\.? ?\d|\d\w*(?: ed(?:ition)?\.?)?|[ivx]+|version \d|\w+ edition))?)\s+(?:[-–—/:]|by)\s+", s):
            if m[1] not in self.words and len(m[1]) <= 7:
                acronyms.add(m[1])
                s = m[2] + " " + s[m.end() :]
        if m := re.search(r"\(([a-z]{2,8})(?:-(?:i{1,4}|iv|v|vi|\d))?\)\s*$", s):
            if m[1] not in self.words and len(m[1]) <= 7 and re.search(r"[^\W_]{3}", s[: m.start()]) and (m[1] in acronyms or "-" in m[0] or len(m[1]) <= 6):
                acronyms.add(m[1])
                s = s[: m.start()]
        found = re.findall(r"q'naire|[^\W\d_]+|\d+(?:st|nd|rd|th)?", s)
        words, groups, edition, i = [], [], None, 0
        while i < len(found):
            w, two = found[i], " ".join(found[i : i + 2])
            i += 1
            if " " in two and two in self.words:
                role, i = self.words[two], i + 1
            elif w in ORDINALS or w.isdigit():
                edition = ORDINALS.get(w) or int(w[:9])
                continue
            elif w == "v" and i < len(found) and found[i].isdigit():
                continue
            elif w in ROMAN:
                edition = ROMAN[w]
                continue
            elif w in EDITION_WORDS or w in CONNECTIVES:
                continue
            else:
                role = self.words.get(w)
            if role is None:
                if w not in acronyms:
                    words.append(w)
            elif role[0] == "group":
                groups.append(role[1])
        return {"words": words, "grp": groups[0] if groups else "", "edition": edition or 0, "acronyms": sorted(acronyms), "plain": plain}


@dataclass(frozen=True)
class Lexicon:
    """What the names taught: topics must agree, idle words tell nothing."""

    topics: frozenset[str] = frozenset()
    idle: frozenset[str] = frozenset()
    short: tuple[tuple[str, str], ...] = ()  # (short form, topic)


class Speller:
    """Reads words with a lexicon: exact, as the nearest known word, or as a shortened one."""

    def __init__(self, lexicon: Lexicon, kinds: dict | None = None, groups: dict | None = None):
        self.words = {w: ("idle", w) for w in lexicon.idle} | {w: ("topic", w) for w in lexicon.topics} | _known(kinds or KINDS, groups or GROUPS)
        self.words |= {w: ("topic", t) for w, t in lexicon.short}
        self.near: dict[str, list[str]] = defaultdict(list)
        self.heads: dict[str, list[str]] = defaultdict(list)
        for w in sorted(self.words):
            if len(w) >= 4 and " " not in w:
                for k in self._cuts(w):
                    self.near[k].append(w)
                for n in range(4, len(w) - 1 if self.words[w][0] != "topic" else 0):  # half of a name may begin like a topic
                    self.heads[w[:n]].append(w)
        self.seen: dict[str, tuple[str, str] | None] = {}

    @staticmethod
    def _cuts(w: str) -> set[str]:
        out, level = {w}, {w}
        for _ in range(1 if len(w) < 7 else 2):
            level = {x[:i] + x[i + 1 :] for x in level for i in range(len(x))}
            out |= level
        return out

    def role(self, w: str) -> tuple[str, str] | None:
        if w in self.words:
            return self.words[w]
        if w not in self.seen:
            best = None
            if 4 <= len(w) <= 40:
                for known in {k for c in self._cuts(w) for k in self.near.get(c, ())}:
                    most = 1 if len(known) < 8 else 2
                    if (len(w) > 4 or len(known) > 4) and (d := edits(w, known, most)) <= most and (best is None or (d, known) < best):
                        best = d, known
                if best is None and len({self.words[k] if self.words[k][0] != "idle" else "idle" for k in self.heads.get(w, ())}) == 1:
                    best = 0, self.heads[w][0]
            self.seen[w] = best and self.words[best[1]]
        return self.seen[w]

    def settle(self, words: list[str], grp: str) -> tuple[str, str, list[str]]:
        """(topic, group, spellings of the telling words: in order and, if that differs, in alphabetical order)."""
        topics, telling, idle = set(), [], []
        for w in words:
            role = self.role(w)
            if role is None:
                telling.append(w)
            elif role[0] == "topic":
                topics.add(role[1])
            elif role[0] == "idle":
                idle.append(w)
            elif role[0] == "group":
                grp = grp or role[1]
        if sum(map(len, telling)) < 4:
            telling += sorted(idle)
        return " ".join(sorted(topics)), grp, list(dict.fromkeys(sound("".join(t)) for t in (telling, sorted(telling))))


def sound(s: str) -> str:
    """One spelling for letters that sound alike, and for doubled letters."""
    s = re.sub(r"h$", "", s.replace("ph", "f").translate(str.maketrans("cywz", "kivs")))
    return re.sub(r"(.)\1", r"\1", s)


LONG = 24


def deletions(s: str) -> set[str]:
    """Keys that two spellings within DISTANCE edits share: s with up to DISTANCE letters left out.

    Long spellings (over LONG letters) give pieces instead: cut in DISTANCE + 1 pieces, one is untouched
    by DISTANCE edits and has moved by that many places at most.
    """
    if len(s) > LONG - DISTANCE:
        k, keys = DISTANCE + 1, set()
        for total in range(len(s) - DISTANCE, len(s) + DISTANCE + 1):
            for j in range(k):
                start, end = j * total // k, (j + 1) * total // k
                keys |= {f"{total}:{j}:{s[start + d : end + d]}" for d in range(-DISTANCE, DISTANCE + 1) if start + d >= 0 and end + d <= len(s)}
        if len(s) > LONG:
            return keys
    else:
        keys = set()
    out = {s}
    level = {s}
    for _ in range(DISTANCE if len(s) >= 6 else 1):  # shorter ones match within one edit
        level = {w[:i] + w[i + 1 :] for w in level for i in range(len(w))}
        out |= level
    return out | keys


def same(a_names, b_names, a_acronyms, b_acronyms, topic: str) -> bool:
    shared = bool(topic) and any(x in set(b_acronyms) for x in a_acronyms if len(x) >= 3)
    for x in a_names:
        for y in b_names:
            near = DISTANCE if min(len(x), len(y)) >= 6 else 1
            if edits(x, y, near) <= near:
                return True
            if shared and x[:1] == y[:1] and min(len(x), len(y)) >= 6 and edits(x, y, FAR) <= FAR:
                return True
    return False


def learn(parsed: DataFrame) -> Lexicon:
    """The lexicon of names read by ``Reader`` (columns words, grp, edition), from counts over all of them.

    The words returned are bounded by RARE and 1 / TOPIC times the words of a name, whatever the number of names.
    """
    read = parsed.select(F.array_sort(F.array_distinct("words")).alias("t"), "grp", "edition").where("size(t) > 0").distinct()
    place = lambda t: F.xxhash64(F.concat_ws(" ", t), "grp", "edition")
    seen = read.select(place(F.col("t")).alias("place")).distinct()
    total = read.count()
    each = read.withColumn("w", F.explode("t")).where("length(w) >= 2")
    often = written(each.groupBy("w").agg(F.count("*").alias("df")), "words")
    # a context speaks about a word only if it still holds a rarer one: what is left must tell whose name it is
    told = each.join(often, "w").groupBy("t", "grp", "edition").agg(F.collect_list(F.struct("w", "df")).alias("d"))
    told = told.withColumn("x", F.explode("d")).where(F.exists("d", lambda y: y["df"] < F.col("x.df")))
    contexts = told.select("x.w", place(F.array_remove("t", F.col("x.w"))).alias("place")).distinct()
    judged = contexts.join(seen.withColumn("without", F.lit(1)), "place", "left").groupBy("w").agg(F.count("*").alias("n"), F.sum("without").alias("k"))
    known = {r.w: (r.n, r.k or 0) for r in judged.where(F.col("n") >= max(LEAST_CONTEXTS, total / RARE)).collect()}
    idle = {w for w, (n, k) in known.items() if k >= IDLE * n}
    topics = {r.w for r in often.where(F.col("df") >= max(LEAST_TOPIC, TOPIC * total)).where("length(w) >= 4").select("w").collect()} - idle
    discard(often)
    heads = lambda w, words: min((v for v in words if len(v) > len(w) + 1 and v.startswith(w)), default=None)
    cut = {w for w in {*topics, *known} - idle if len(w) >= 4 and heads(w, idle)}
    topics -= cut
    short = {w: t for w in {*topics, *known} - idle - cut if len(w) >= 4 and (t := heads(w, topics))}
    return Lexicon(frozenset(topics - short.keys()), frozenset(idle | cut), tuple(sorted(short.items())))


def profiles(names: DataFrame, lexicon: Lexicon | None = None) -> DataFrame:
    """(id, pid, topic, grp, edition, spellings, acronyms) from rows (id, name, acronym); the lexicon is learned if not given."""
    reader = Reader()

    @F.pandas_udf("struct<words:array<string>,grp:string,edition:int,acronyms:array<string>,plain:string>")
    def read(name: pd.Series, acronym: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([reader.read(n, a) for n, a in zip(name, acronym)], columns=["words", "grp", "edition", "acronyms", "plain"])

    texts = names.select("name", F.coalesce("acronym", F.lit("")).alias("acronym")).where("name is not null").distinct()
    written_ = written(texts.select("name", "acronym", read("name", "acronym").alias("r")).select("name", "acronym", "r.*"), "names-read")
    parsed = written_.where("plain <> ''")  # read once, not under the filter as well
    known, speller = lexicon or learn(parsed), {}

    @F.pandas_udf("struct<topic:string,grp:string,spellings:array<string>>")
    def settled(words: pd.Series, grp: pd.Series) -> pd.DataFrame:
        if not speller:  # once for each task
            speller[0] = Speller(known)
        return pd.DataFrame([speller[0].settle(list(w), g) for w, g in zip(words, grp)], columns=["topic", "grp", "spellings"])

    named = parsed.withColumn("s", settled("words", "grp")).select("name", "acronym", "edition", "acronyms", "plain", "s.*")
    told = F.length(F.get("spellings", F.lit(0))) >= 4
    identity = F.md5(F.when(told, F.concat_ws("|", F.lit("p"), "topic", "grp", "edition", F.get("spellings", F.lit(0)))).otherwise(F.concat_ws("|", F.lit("t"), "plain")))
    with_pid = named.select("name", "acronym", identity.alias("pid"), "topic", "grp", "edition", F.when(told, F.col("spellings")).alias("spellings"), "acronyms")
    ids = names.where("name is not null").select("id", "name", F.coalesce("acronym", F.lit("")).alias("acronym"))
    out = written(ids.join(with_pid, ["name", "acronym"]).select("id", "pid", "topic", "grp", "edition", "spellings", "acronyms"), "name-profiles")
    discard(written_)
    return out


def components(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """(pid, root): the smallest node of each connected component; nodes: pid. edges: a, b."""
    both = written(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    last, labels = None, written(nodes.select("pid", F.col("pid").alias("root")), "labels")
    while True:
        near = both.join(labels, F.col("b") == F.col("pid")).groupBy("a").agg(F.min("root").alias("m"))
        step = labels.join(near, labels.pid == near.a, "left").select("pid", F.col("root").alias("old"), F.least("root", F.coalesce("m", "root")).alias("root"))
        up = step.select(F.col("pid").alias("root"), F.col("root").alias("above"))
        new = written(step.join(up, "root", "left").select("pid", "old", F.least("root", F.coalesce("above", "root")).alias("root")), "labels")
        discard(last or labels)
        last, labels = new, new.select("pid", "root")
        if new.where("root <> old").isEmpty():
            discard(both)
            labels._written_at = new._written_at
            return labels


def bag(s: str) -> int:
    """64 bits that stand for the letters of s. Letters left out by an edit clear one bit at most, so those of x that y lacks count no more than the edits."""
    once = twice = 0
    for c in s:
        bit = 1 << ord(c) % 32
        if once & bit:
            twice |= bit
        once |= bit
    return once | twice << 32


def _near(x: str, y: str) -> bool:
    near = DISTANCE if min(len(x), len(y)) >= 6 else 1
    return edits(x, y, near) <= near


def _far(x: str, y: str) -> bool:
    return edits(x, y, FAR) <= FAR


def linked(rule, most: int):
    """For ``mapInPandas`` over rows (key, n, place, names) in order of key: (a, b) unites n and the smallest n of the task it belongs with.

    Two n belong together if they share key and place and any two of their names keep the rule. Every pair
    is compared, except those that are united already and those whose letters (``bag``) differ too much.
    """

    def run(frames):
        root: dict[int, int] = {}
        test = lru_cache(1 << 16)(rule)  # a pair that shares many keys is compared once

        def find(n: int) -> int:
            while (up := root.get(n, n)) != n:
                root[n] = root.get(up, up)
                n = up
            return n

        def unite(i: int, j: int, ns, names, places) -> None:
            if (a := find(ns[i])) != (b := find(ns[j])) and places[i] == places[j] and test(names[i], names[j]):
                root[max(a, b)] = min(a, b)

        def group(ns, places, lists) -> None:
            if len(ns) < 2:
                return
            rows = [(n, p, x) for n, p, names in zip(ns, places, lists) for x in names]
            ns, places, names = zip(*rows)
            bags = [bag(x) for x in names]
            if len(rows) <= CROWDED:
                for i, x in enumerate(bags):
                    for j in range(i + 1, len(bags)):
                        if (x & ~bags[j]).bit_count() <= most and (bags[j] & ~x).bit_count() <= most:
                            unite(i, j, ns, names, places)
                return
            every = np.array(bags, "uint64")
            for i, x in enumerate(every[:-1]):
                rest = every[i + 1 :]
                for j in np.flatnonzero((np.bitwise_count(x & ~rest) <= most) & (np.bitwise_count(~x & rest) <= most)):
                    unite(i, i + 1 + int(j), ns, names, places)

        last, open_ = None, ([], [], [])  # a key may go on in the next batch
        for pdf in frames:
            if not len(pdf):
                continue
            keys, columns = pdf["key"].to_numpy(), [pdf[c].tolist() for c in ("n", "place", "names")]
            starts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
            for at, end in zip(starts, starts[1:]):
                if last is None or keys[at] != last:
                    group(*open_)
                    last, open_ = keys[at], ([], [], [])
                for kept, column in zip(open_, columns):
                    kept += column[at:end]
        group(*open_)
        pairs = [(n, find(n)) for n in list(root) if root[n] != n]
        for i in range(0, len(pairs), 10_000):
            yield pd.DataFrame(pairs[i : i + 10_000], columns=["a", "b"])

    return run


def resolve(members: DataFrame) -> DataFrame:
    """(id, entity) from ``profiles`` rows: near spellings unite once, then profiles of one acronym in rounds until a round merges nothing."""
    unite = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_set(c))))
    first = members.groupBy("pid").agg(F.first("topic").alias("topic"), F.first("grp").alias("grp"), F.first("edition").alias("edition"), unite("spellings").alias("names"), unite("acronyms").alias("acronyms"))
    # numbers are a quarter as long as the identities, which only the result needs
    current = written(first.withColumn("n", F.monotonically_increasing_id()).withColumn("fresh", F.lit(True)), "profiles")
    owner = written(current.select("n", "pid", F.col("n").alias("now")), "owners")
    current_is, current = current, current.drop("pid")
    place, by_key = F.concat_ws("|", "topic", "grp", "edition"), Window.partitionBy("key")

    @F.pandas_udf("array<string>")
    def keys(names: pd.Series) -> pd.Series:
        return pd.Series([list(set().union(*map(deletions, n))) for n in names], dtype="object")

    def by_spelling() -> DataFrame:
        told = current.where("size(names) > 0").select("n", place.alias("place"), "names")
        made = told.select("n", "place", F.explode(keys("names")).alias("k")).select("n", F.xxhash64("place", "k").alias("key"))
        shared = made.withColumn("c", F.count("*").over(by_key)).where("c > 1").select("key", "n")
        # the planner takes the keys for as few as the profiles they are made from, and would broadcast them
        rows = shared.join(told.hint("merge"), "n").select("key", "n", "place", "names").repartition("key").sortWithinPartitions("key")
        return rows.mapInPandas(linked(_near, DISTANCE), "a bigint, b bigint")

    def by_acronym(again: bool) -> DataFrame:
        told = current.where("topic <> '' and size(names) > 0 and size(acronyms) > 0").select("n", "fresh", place.alias("place"), F.explode("acronyms").alias("acronym"), "names").where("length(acronym) >= 3")
        each = told.withColumn("name", F.explode("names")).where("length(name) >= 6")
        each = each.select("n", "fresh", F.concat_ws("|", "place", "acronym", F.substring("name", 1, 1)).alias("place"), F.array("name").alias("names")).withColumn("key", F.xxhash64("place"))
        moved = F.max("fresh").over(by_key) if again else F.lit(True)
        moved = each.withColumn("moved", moved & (F.min("n").over(by_key) < F.max("n").over(by_key))).where("moved")
        return moved.select("key", "n", "place", "names").sortWithinPartitions("key").mapInPandas(linked(_far, FAR), "a bigint, b bigint")

    for i in count():
        edges = written(by_acronym(again=i > 1) if i else by_spelling(), "matches")
        if edges.isEmpty():
            discard(edges)
            if i:
                break
            continue
        ends = edges.select(F.col("a").alias("pid")).unionByName(edges.select(F.col("b").alias("pid"))).distinct()
        roots = components(edges, ends)
        rooted = lambda df, c: df.join(roots.withColumnRenamed("pid", c), c, "left").withColumn("root", F.coalesce("root", c))
        merged = rooted(current, "n").groupBy("root").agg(
            F.first("topic").alias("topic"), F.first("grp").alias("grp"), F.first("edition").alias("edition"), unite("names").alias("names"), unite("acronyms").alias("acronyms"), (F.count("*") > 1).alias("fresh"),
        )
        before = current_is, owner, edges, roots
        current = current_is = written(merged.withColumnRenamed("root", "n"), "profiles")
        owner = written(rooted(owner, "now").select("n", "pid", F.col("root").alias("now")), "owners")
        discard(*before)
    discard(current_is)
    named = owner.join(owner.groupBy("now").agg(F.min("pid").alias("entity")), "now").select("pid", "entity")
    return members.select("id", "pid").distinct().join(named, "pid").select("id", "entity")


def instrument_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = table(spark, sf_dir, "variant_info").select(F.col("variant_id").alias("id"), F.col("variant_name").alias("name"), F.lit(None).cast("string").alias("acronym"))
    m = table(spark, sf_dir, "instrument_match").select(F.col("match_id").alias("id"), F.col("instrument_name").alias("name"), "acronym")
    return v.unionByName(m).where("id is not null").distinct()


def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve(profiles(instrument_names(spark, sf_dir)))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = entities(spark, sf_dir).distinct()
    a, b = (e.select("entity", F.col("id").alias(c)) for c in ("left_id", "right_id"))
    return a.join(b, "entity").where("left_id < right_id").select("left_id", "right_id").distinct()


def p1_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each name: its entity and how many names the entity has."""
    e = entities(spark, sf_dir).distinct()
    return e.join(e.groupBy("entity").agg(F.count("*").alias("n_names")), "entity").select("id", "entity", "n_names")


QUERIES = {"p1_found": p1_found, "p1_entities": p1_entities}
