"""Markup residue (HTML, Markdown, wiki, LaTeX; escaped or cut off) into clean structured text (problem 6).

``lex`` turns a text into a stream of structural tokens and text slots. Tokens whose meaning a markup
language fixes (``<h2>``, ``<li>``, ``\\section``, fences) carry it; signs that mean different things in
different languages stay bare: a line that begins with one or two ``#`` (heading here, numbered item
there) and a line that begins with a bullet or number.

For the texts of one host (the publisher or field they come from) the streams are aligned, as in union-free
wrapper induction: runs of lines with one sign become repeated groups (their items aligned with each
other), tandem repeats become repeated groups, a mismatch between the wrapper so far and the next stream
becomes an optional group, differing texts become slots. The result is one regular expression without
unions per host, ``Tok | Slot | Opt(...) | Plus(...) | Run(...)``, that accepts all streams of the host.

Texts are read through their host's wrapper: each token binds a node, and the node's class gives the
token's meaning (``classes``). A sign bound in a Run is a list item; ``#`` bound alone is a heading if it
stands apart from other lines, else it is what the host uses it for: an item if its wrapper has a Run of the
sign, a heading if not; a bullet that alone begins a text is an item only if the host's wrapper has a Run
of bullets that begins a text. Elements and clean text come from these meanings. A stream that no wrapper has
seen is read through the wrapper aligned with it. Streams of more than ``LONG_STREAM`` nodes are not aligned node by
node (which is quadratic): they are read through their own wrapper with the host's uses, and give the host what they
teach about signs (``taught``). No meaning hangs on more: a class is settled by the tag, the stream's own Runs and the uses.

Wrappers fold in a tree over distinct streams only, so neither a hot host nor many equal texts meet in
one task.

Null and blank texts hold no markup. A text without markup gives no row. Plain uses of the same signs
(prices, comparisons, arithmetic, names with underscores, ranges in braces) are no markup. Texts are
read whole; a token left open by a cut-off end counts as the element it began. Repeated rows count once.
"""

from __future__ import annotations

import html
import json
import re

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from textlens.operators import nested
from textlens.session import discard, table, written

ROLES = {"h": "heading", "list": "list", "item": "list", "code": "code", "formula": "formula"}
_TAGS = "a|abbr|b|big|blockquote|body|br|caption|center|cite|code|dd|del|div|dl|dt|em|font|h[1-6]|head|hr|html|i|img|ins|kbd|label|li|math|nowiki|ol|p|pre|q|ref|s|samp|script|small|source|span|strike|strong|style|sub|sup|syntaxhighlight|table|tbody|td|tfoot|th|thead|tr|tt|u|ul|var"
_OPEN_END = r"(?:>|$)"
_REGION = re.compile(
    rf"""(?P<comment><!--.*?(?:-->|$))
    |(?P<pre><(?P<ptag>pre|syntaxhighlight|source)\b[^>]*{_OPEN_END}(?P<pbody>.*?)(?:</(?P=ptag)\s*{_OPEN_END}|\Z))
    |(?P<math><math\b[^>]*{_OPEN_END}(?P<mbody>.*?)(?:</math\s*{_OPEN_END}|\Z))
    |(?P<fence>^[ \t]*(?P<f>`{{3,}}|~{{3,}})[^\n]*(?:\n|\Z)(?P<fbody>.*?)(?:^[ \t]*(?P=f)[ \t]*$|\Z))
    |(?P<verb>\\begin\{{(?P<vtag>verbatim|lstlisting|minted|alltt)\*?\}}(?P<vbody>.*?)(?:\\end\{{(?P=vtag)\*?\}}|\Z))
    |(?P<env>\\begin\{{(?P<etag>equation|align|gather|displaymath|math|eqnarray|multline)\*?\}}(?P<ebody>.*?)(?:\\end\{{(?P=etag)\*?\}}|\Z))
    |(?P<dd>\$\$(?P<dbody>[^$]*?[\\^_=+][^$]*?)(?:\$\$|\Z))
    |(?P<br>\\\[(?P<brbody>.+?)(?:\\\]|\Z))
    |(?P<pa>\\\((?P<pabody>.+?)(?:\\\)|\Z))
    |(?P<d>(?<![\\\w$])\$(?P<body>(?=[^\s$])(?:[^$\n]*[^\s$])?)\$(?![\d\w]))
    |(?P<dcut>(?<![\\\w$])\$(?=[^\s$])[^$\n]*\\[a-z]+[^$]*\Z)""",
    re.S | re.M | re.X | re.I,
)
_BLOCK = re.compile(
    r"""(?P<wh>^(?P<eq>={2,6})[ \t]*(?P<wtext>[^=\n][^\n]*?)[ \t]*(?P=eq)[ \t]*$)
    |(?P<setext>^(?P<stext>[^\s=\-#>*+][^\n]*)\n(?:={3,}|-{3,})[ \t]*$)
    |(?P<atx>^(?P<hashes>\#{1,6})[ \t]+(?P<atext>\S[^\n]*)$)
    |(?P<rule>^[ \t]*(?:-{3,}|\*{3,}|_{3,})[ \t]*$)
    |(?P<item>^[ \t]*(?:[-+*•][ \t]+(?=\S)|\d{1,3}[.)][ \t]+(?=\S)|\*{1,3}(?=[^\s*])(?=[^*\n]*[A-Za-z][^*\n]*$)|\#{1,3}(?=[^\s#])(?=[^\n]*[A-Za-z])))
    |(?P<quote>^>[ \t]+(?=\S))""",
    re.M | re.X,
)
_INLINE = re.compile(
    rf"""(?P<tag></?(?P<name>{_TAGS})(?=[\s/>]|\Z)[^<>]*(?:>|\Z))
    |(?P<image>!\[[^\]\n]*\]\([^)\n]*(?:\)|\Z))
    |(?P<link>\[[^\]\n]*\]\((?=[^)\s]*[./\#])[^)\n]*(?:\)|\Z))
    |(?P<wlink>\[\[[^\[\]\n]+(?:\]\]|\Z))
    |(?P<template>\{{\{{\s*[A-Za-z][^{{}}\n]*(?:\}}\}}|\Z))
    |(?P<quotes>'{{2,5}}(?=[^\s'])(?P<qtext>[^\n]*?[^\s'])'{{2,5}})
    |(?P<sec>\\(?:sub)*(?:section|chapter|part|paragraph)\*?\{{(?P<sectext>[^}}\n]*)(?:\}}|\Z|$))
    |(?P<lbegin>\\(?P<be>begin|end)\{{(?P<ltag>itemize|enumerate|description)\}}?)
    |(?P<litem>\\item\b(?:\[[^\]\n]*\])?[ \t]*)
    |(?P<lmath>\\(?:frac|sum|int|prod|sqrt|leq|geq|cdot|times|alpha|beta|sigma|mu|infty)\b)
    |(?P<command>\\(?:begin|end|emph|text[a-z]{{2}}|ref|label|cite|footnote|noindent|underline|url|href|par|newline|linebreak|hspace|vspace|caption|item|quad)\b\*?(?:\{{[^{{}}\n]*\}}?)*)
    |(?P<thin>\\[,;:!](?=[a-zA-Z%])|``(?=[^`\n]+''))
    |(?P<strong>(?<![*\w])(?P<st>\*{{2,3}})(?=[^\s*])[^*\n]*[^\s*](?P=st)(?![*\w])|(?<![_\w])__(?=[^\s_])[^\n]*?[^\s_]__(?![_\w]))
    |(?P<em>(?<![*\w])\*(?=[^\s*])[^*\n]*[^\s*]\*(?![*\w])|(?<![_\w])_(?=[^\s_])[^_\n]*[^\s_]_(?![_\w]))
    |(?P<strike>~~(?=[^\s~])[^~\n]*[^\s~]~~)
    |(?P<tick>(?<!`)`(?=[^\s`])[^`\n]*`(?!`))
    |(?P<entity>&(?:nbsp|amp|lt|gt|quot|apos|\#\d{{1,6}}|\#x[0-9a-fA-F]{{1,6}}|[a-z]{{2,8}});)
    |(?P<tablerow>^\|[^\n]*\|[ \t]*$)""",
    re.X | re.M | re.I,
)
_ESCAPED = re.compile(rf"&(?:amp;)*lt;(?:/?(?:{_TAGS})(?=[\s/]|&|\Z)|!--)", re.I)
_CUT_TAG = re.compile(rf"</?(?:{_TAGS})?\Z|<!-?-?\Z|\\begin\{{?\w*\Z|\\[a-z]{{2,}}\Z|\[\[[^\]]*\Z|\{{\{{[^}}]*\Z", re.I)

_ELLIPSIS = re.compile(r"(?:\.\.\.|…)\s*\Z")

# Every text whose stream is more than one slot holds one of these; the JVM leaves the others out.
MAY = r"[<&`~\\$=#*+•_\[{|>!]|''|---|(?m:^[ \t]*(?:-[ \t]|\d{1,3}[.)][ \t]))"

Token = tuple[str, str]


def unescape(text: str) -> str:
    """Text whose tags are written as entities, once or twice, with the tags restored."""
    for _ in range(3):
        if not _ESCAPED.search(text):
            break
        text = html.unescape(text)
    return text


def _slot(out: list[Token], text: str) -> None:
    if text.strip():
        if out and out[-1][0] == "#":
            out[-1] = ("#", out[-1][1] + text)
        else:
            out.append(("#", text))


def _inline(text: str, out: list[Token]) -> None:
    at = 0
    for m in _INLINE.finditer(text):
        _slot(out, text[at : m.start()])
        at, kind = m.end(), m.lastgroup
        got = lambda g: m[g] is not None
        if got("tag"):
            name, closing = m["name"].lower(), m["tag"].startswith("</")
            if re.fullmatch("h[1-6]", name):
                tag = "h"
            else:
                tag = {"ul": "list", "ol": "list", "dl": "list", "li": "item", "dd": "item", "dt": "item", "code": "codespan"}.get(name, name)
            out.append((("/" if closing else "") + tag, ""))
        elif got("sec"):
            out += [("h", ""), ("#", m["sectext"]), ("/h", "")]
        elif got("lbegin"):
            out.append(("list" if m["be"] == "begin" else "/list", ""))
        elif got("litem"):
            out.append(("item", ""))
        elif got("lmath"):
            out.append(("formula", m["lmath"]))
        elif got("entity"):
            out.append(("entity", ""))
            _slot(out, html.unescape(m["entity"]))
        else:
            kind = next(k for k in ("image", "link", "wlink", "template", "quotes", "command", "thin", "strong", "em", "strike", "tick", "tablerow") if got(k))
            out.append((kind, ""))
            inner = {"quotes": "qtext"}.get(kind)
            _slot(out, m[inner] if inner else re.sub(r"^[!*_~`\[{]+|\([^)]*\)$|[*_~`\]}]+$|\\[a-z]+\*?\{?", "", m[kind]))
    _slot(out, text[at:])


def _blocks(text: str, out: list[Token]) -> None:
    found = [m for m in _BLOCK.finditer(text)]
    lines = lambda m: (text[: m.start()].rstrip(" \t"), text[m.end() :])
    at = 0
    for m in found:
        before, after = lines(m)
        alone = (not before.strip() or before.endswith("\n\n")) and (not after.strip() or re.match(r"[ \t]*\n[ \t]*\n", after))
        _inline(text[at : m.start()], out)
        at = m.end()
        if m["wh"] is not None or m["setext"] is not None or (m["atx"] is not None and len(m["hashes"]) > 2):
            out.append(("h", ""))
            _inline(m["wtext"] or m["stext"] or m["atext"], out)
            out.append(("/h", ""))
        elif m["atx"] is not None:
            out.append(("hash" if alone else "hashrun", m["hashes"]))
            _inline(m["atext"], out)
            if alone:
                out.append(("/hash", ""))
        elif m["item"] is not None:
            out.append(("bullet", m["item"]))
        elif m["rule"] is not None:
            out.append(("rule", ""))
        else:
            out.append(("quote", ""))
    _inline(text[at:], out)


def lex(text: str | None) -> list[Token]:
    """(tag, text) tokens; tag '#' is a slot. A text without markup is one slot."""
    if text is None or not text.strip():
        return []
    source, out, at = _ELLIPSIS.sub("", unescape(text)), [], 0
    for m in _REGION.finditer(source):
        body = m["body"]
        if m["d"] is not None and not re.search(r"[\\^_=<>]|^[a-zA-Z]$|[a-z]\s*[+*/-]\s*\w", body):
            continue
        _blocks(source[at : m.start()], out)
        at = m.end()
        if m["comment"] is not None:
            out.append(("comment", ""))
        elif any(m[k] is not None for k in ("pre", "fence", "verb")):
            code = next(x for x in (m["pbody"], m["fbody"], m["vbody"]) if x is not None)
            out += [("code", ""), ("#", html.unescape(re.sub(r"</?code[^>]*>", "", code))), ("/code", "")]
        else:
            out += [("formula", ""), ("#", next((m[k] for k in ("mbody", "ebody", "dbody", "brbody", "pabody", "body") if m[k] is not None), "")), ("/formula", "")]
    rest = source[at:]
    if (cut := _CUT_TAG.search(rest)) and cut.end() > cut.start():
        _blocks(rest[: cut.start()], out)
        out.append(("cut", ""))
    else:
        _blocks(rest, out)
    return out


def elements(meanings) -> list[str]:
    """Which elements the meanings of a stream's tokens mark; 'other' if it holds other markup only, none if no markup."""
    marks = {m for m in meanings if m not in ("#", "text")}
    return sorted(marks - {"other"}) or (["other"] if marks else [])


_BEFORE = {
    "code": "\n\n```\n", "/code": "\n```\n\n", "formula": " $", "/formula": "$ ", "/h": "\n\n", "/hash": "\n\n", "br": "\n", "/p": "\n\n", "/div": "\n",
    "/list": "\n", "/tr": "\n", "/td": " ", "list": "\n", "p": "\n\n",
}


def render(tokens: list[Token], meanings) -> str:
    """The text without markup; headings as '# ', items as '- ', code fenced, formulas in '$'."""
    out = []
    for (tag, t), meaning in zip(tokens, meanings):
        if tag == "#":
            out.append(t)
        elif meaning == "text":  # a sign that is no markup here
            out.append(t)
        elif meaning == "heading" and not tag.startswith("/"):
            out.append("\n\n# ")
        elif tag in ("item", "bullet", "hashrun", "hash"):
            out.append("\n- ")
        else:
            out.append(_BEFORE.get(tag, ""))
    joined = "".join(out)
    if "<" in joined:
        joined = re.sub(r"</?m[a-z]+\b[^>]*>", "", joined)
    return re.sub(r"\n{3,}", "\n\n", re.sub(r"[ \t]+(?=\n)|(?<=\n)[ \t]+(?=[#$-])", "", joined)).strip()


def clean(text: str | None, wrapper: list | None = None) -> str | None:
    """The clean text of one text, read through a wrapper, by default the one that only this text makes."""
    if text is None:
        return None
    tokens = lex(text)
    tags = [t for t, _ in tokens]
    return render(tokens, read(compiled(wrapper if wrapper is not None else wrap(tags)), tags))


# ---- wrappers: nested lists ["t", tag] | ["s"] | ["?", nodes] | ["+", nodes] | ["++", nodes] | ["^"]
# "++" (Run) is twice or more, "^" remembers that a Run began a text

SIGNS = ("bullet", "hashrun")
MOST_PERIOD, LONG_STREAM = 24, 400


def _key(node) -> str:
    """Nodes align if their keys agree: groups stand for their first token, runs only for runs."""
    run = ""
    if node[0] == "^":
        return "^"
    while node[0] in ("?", "+", "++"):
        run = "++" if node[0] == "++" else run
        node = node[1][0]
    return run + (node[1] if node[0] == "t" else "^" if node[0] == "^" else "#")


def collapse(nodes: list) -> list:
    """Tandem repeats (of up to MOST_PERIOD tokens) as repeated groups, shortest period first."""
    changed = True
    while changed:
        changed = False
        for period in range(1, min(MOST_PERIOD, len(nodes) // 2) + 1):
            i, out = 0, []
            while i < len(nodes):
                unit = nodes[i : i + period]
                k = 1
                while len(unit) == period and nodes[i + k * period : i + (k + 1) * period] == unit:
                    k += 1
                if k > 1:
                    out.append(unit[0] if period == 1 and unit[0][0] in ("+", "++") else ["+", unit])
                    i += k * period
                    changed = True
                else:
                    out.append(nodes[i])
                    i += 1
            nodes = out
            if changed:
                break
    return nodes


def runs(tags) -> list:
    """Nodes of a stream, lines with one sign that follow each other as a Run of their aligned items."""
    node = lambda t: ["s"] if t == "#" else ["t", t]
    blocks = {"h", "hash", "code", "list", "p", "div", "table", "quote", "rule", "formula"}
    out, i = [], 0
    while i < len(tags):
        sign = tags[i]
        if sign not in SIGNS:
            out.append(node(sign))
            i += 1
            continue
        items, at = [], i
        while at < len(tags) and tags[at] == sign:
            end = at + 1
            while end < len(tags) and tags[end] not in SIGNS and tags[end] not in blocks:
                end += 1
            follows = end < len(tags) and tags[end] == sign
            if not follows:  # the last item ends with its first slot; what comes behind is no item
                end = at + 2 if at + 1 < len(tags) and tags[at + 1] == "#" else at + 1
            items.append([node(t) for t in tags[at:end]])
            at = end
        if len(items) == 1:
            out += items[0]
        else:
            body = items[0]
            for x in items[1:]:
                body = align(body, x)
            out += ([["^"]] if not out else []) + [["++", body]]
        i = at
    return out


def wrap(tags) -> list:
    """The wrapper of one stream."""
    return collapse(runs(list(tags)))


def _join(a, b):
    """One node for two aligned nodes."""
    optional = a[0] == "?" or b[0] == "?"
    x, y = (n[1] if n[0] == "?" else [n] for n in (a, b))
    if len(x) == 1 and len(y) == 1:
        if x[0][0] == "++" and y[0][0] == "++":
            nodes = [["++", align(x[0][1], y[0][1])]]
        else:
            repeated = x[0][0] == "+" or y[0][0] == "+"
            p, q = (n[1] if n[0] == "+" else [n] for n in (x[0], y[0]))
            body = p if p == q else align(p, q)
            merged = ["+", body] if repeated else body[0] if len(body) == 1 else None
            nodes = [merged] if merged else body
    else:
        nodes = align(x, y)
    return ["?", nodes] if optional else nodes[0] if len(nodes) == 1 else ["+", nodes]


def align(a: list, b: list) -> list:
    """The wrapper of two wrappers: a longest common subsequence stays, what only one holds is optional."""
    if a == b:
        return a
    if len(a) == 1 and len(b) == 1 and a[0][0] in "ts" and b[0][0] in "ts":
        return [["?", a], ["?", b]]
    n, m = len(a), len(b)
    ka, kb = [_key(x) for x in a], [_key(x) for x in b]
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        row, below, k = best[i], best[i + 1], ka[i]
        for j in range(m - 1, -1, -1):
            row[j] = below[j + 1] + 1 if k == kb[j] else max(below[j], row[j + 1])
    out, i, j = [], 0, 0
    opt = lambda x: x if x[0] == "?" else ["?", [x]]
    while i < n or j < m:
        if i < n and j < m and ka[i] == kb[j]:
            out.append(_join(a[i], b[j]))
            i, j = i + 1, j + 1
        elif j == m or (i < n and best[i + 1][j] >= best[i][j + 1]):
            out.append(opt(a[i]))
            i += 1
        else:
            out.append(opt(b[j]))
            j += 1
    return out


class Automaton:
    """The wrapper's position automaton: state k means token k was read, -1 none; and the class of each token."""

    def __init__(self, wrapper: list, uses: frozenset[str] = frozenset()):
        self.kinds: list[str] = []
        self.in_run: list[bool] = []
        self.follow: dict[int, dict[int, None]] = {}
        self.wrapper, self.first = wrapper, False
        self.known: dict[tuple, tuple] = {}
        self.final = self._build(wrapper, {-1: None}, False)
        self.steps: dict[int, dict[str, list[int]]] = {}
        for state, after in self.follow.items():
            for k in after:
                self.steps.setdefault(state, {}).setdefault(self.kinds[k], []).append(k)
        runs_ = {k for k, (t, r) in enumerate(zip(self.kinds, self.in_run)) if r and t in SIGNS}
        self.uses = uses | {self.kinds[k] for k in runs_} | ({"first"} if self.first else set())
        self.classes = [self._class(k) for k in range(len(self.kinds))]

    def _build(self, nodes, starts: dict[int, None], run: bool) -> dict[int, None]:
        """States reachable after nodes, from starts; both in order of preference."""
        for node in nodes:
            if node[0] == "^":
                self.first = True
            elif node[0] in "ts":
                self.kinds.append("#" if node[0] == "s" else node[1])
                self.in_run.append(run)
                k = len(self.kinds) - 1
                for s in starts:
                    self.follow.setdefault(s, {})[k] = None
                starts = {k: None}
            elif node[0] == "?":
                starts = self._build(node[1], starts, run) | starts
            else:
                if node[0] == "++":
                    starts, run_ = self._build(node[1], starts, True), True
                else:
                    run_ = run
                first = len(self.kinds)
                ends = self._build(node[1], starts, run_)
                entry = {k: None for s in starts for k in self.follow.get(s, ()) if k >= first}
                for e in ends:
                    self.follow.setdefault(e, {}).update(entry)
                starts = ends
        return starts

    def _class(self, k: int) -> str:
        tag = self.kinds[k]
        if tag == "#":
            return "#"
        if tag in SIGNS:
            if self.in_run[k]:
                return "list"
            return ("list" if tag in self.uses else "heading") if tag == "hashrun" else "list"
        name = tag.lstrip("/")
        return "heading" if name == "hash" else ROLES.get(name, "other")

    def _step(self, states: tuple[int, ...], tag: str) -> tuple[tuple[int, ...], tuple[int, ...]]:
        """(states after the tag, for each the place of the state it comes from), in order of preference; known steps are kept."""
        known = self.known.get((states, tag))
        if known is None:
            found: dict[int, int] = {}
            for i, s in enumerate(states):
                for k in self.steps.get(s, {}).get(tag, ()):
                    found.setdefault(k, i)
            known = self.known[states, tag] = tuple(found), tuple(found.values())
        return known

    def path(self, tags) -> list[int] | None:
        """The token of the wrapper that each token of the stream binds; None if the wrapper does not accept the stream."""
        states, layers = (-1,), []
        for t in tags:
            states, back = self._step(states, t)
            if not states:
                return None
            layers.append((states, back))
        at = next((i for i, s in enumerate(states) if s in self.final), None)
        if at is None:
            return None
        out = []
        for states, back in reversed(layers):
            out.append(states[at])
            at = back[at]
        return out[::-1]


def compiled(wrapper: list) -> Automaton:
    return Automaton(wrapper)


def read(automaton: Automaton, tags) -> list[str]:
    """The meaning of each token of a stream: the class of the node it binds."""
    tags = list(tags)
    path = automaton.path(tags)
    if path is None:  # not seen before, or too long to be aligned
        own = wrap(tags)
        automaton = Automaton(own if len(own) > LONG_STREAM else align(automaton.wrapper, own), frozenset(automaton.uses))
        path = automaton.path(tags)
        if path is None:
            automaton = Automaton(own, frozenset(automaton.uses))
            path = automaton.path(tags)
    out = [automaton.classes[k] for k in path]
    if tags[:1] == ["bullet"] and not automaton.in_run[path[0]] and "first" not in automaton.uses:
        out[0] = "text"
    return out


def taught(wrapper: list) -> list:
    """The uses a wrapper teaches, as a short wrapper that can stand for it in the host's: its Runs of signs, and whether one begins a text."""
    uses = compiled(wrapper).uses
    return [["^"]] * ("first" in uses) + [["?", [["++", [["t", sign]]]]] for sign in SIGNS if sign in uses]


def wrappers(streams: DataFrame, together: int = 128) -> DataFrame:
    """(host, wrapper) from rows (host, tags): distinct streams fold in a tree, about ``together`` at a time, like ones first."""

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        made = None
        for w in sorted(pdf["w"]):
            w = json.loads(w)
            made = w if made is None else align(made, w)
        return pd.DataFrame({"host": [pdf["host"].iloc[0]], "w": [json.dumps(made)]})

    @F.pandas_udf("string")
    def wrapped(tags: pd.Series) -> pd.Series:
        return tags.map(lambda t: json.dumps(w if len(w := wrap(t)) <= LONG_STREAM else taught(w)))

    each = written(streams.select("host", wrapped("tags").alias("w")).distinct(), "wrappers")
    while True:
        n, hosts = each.agg(F.count("*"), F.countDistinct("host")).first()
        if n <= hosts:
            return each.withColumnRenamed("w", "wrapper")
        # neighbours in order share their beginnings, so their wrapper stays short
        near = each.repartitionByRange(-(-n // together), "host", "w").withColumn("part", F.spark_partition_id())
        folded = written(near.groupBy("host", "part").applyInPandas(lambda pdf: fold(pdf), "host string, w string"), "wrappers")
        discard(each)
        each = folded


def read_texts(texts: DataFrame, more: list[str]) -> DataFrame:
    """(src, rec_key, idx, more, meanings) from rows (src, rec_key, idx, host, text): every token of every text read through its host's wrapper.

    Texts without markup have null meanings; without ``more`` those without any sign of it are left out.
    """

    @F.pandas_udf("array<string>")
    def tags(s: pd.Series) -> pd.Series:
        return s.map(lambda t: [x for x, _ in lex(t)])

    kept = [c for c in more if c != "text"]
    rows = texts.where("text is not null").select("src", "rec_key", "idx", *kept, F.coalesce("host", F.lit("")).alias("host"), "text")
    may, rest = rows.where(F.col("text").rlike(MAY)), rows.where(~F.col("text").rlike(MAY))
    # written before the filter, which would else be pushed below a distinct and lex every text twice
    may = written(may.withColumn("tags", tags("text")).drop(*([] if "text" in more else ["text"])), "markup-streams")
    shapes = may.where(F.exists("tags", lambda t: t != "#")).select("host", "tags").distinct()

    @F.pandas_udf("array<string>")
    def meanings(wrapper: pd.Series, tags: pd.Series) -> pd.Series:
        known: dict[str, Automaton] = {}
        out = []
        for w, t in zip(wrapper, tags):
            if w not in known:
                known[w] = compiled(json.loads(w))
            out.append(read(known[w], t))
        return pd.Series(out)

    by_shape = shapes.join(wrappers(shapes), "host").select("host", "tags", meanings("wrapper", "tags").alias("meanings"))
    read_ = may.join(by_shape, ["host", "tags"], "left").select("src", "rec_key", "idx", *more, "meanings")
    return read_.unionByName(rest.select("src", "rec_key", "idx", *more, F.lit(None).cast("array<string>").alias("meanings"))) if more else read_


def marked_texts(texts: DataFrame) -> DataFrame:
    """(src, rec_key, idx, elements) from rows (src, rec_key, idx, host, text) that hold markup."""

    @F.pandas_udf("array<string>")
    def found(s: pd.Series) -> pd.Series:
        return s.map(elements)

    some = read_texts(texts, []).where("meanings is not null")
    return some.select("src", "rec_key", "idx", found("meanings").alias("elements")).where("size(elements) > 0")


def corpus_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(src, rec_key, idx, host, text) of cde_item.definitions and substitute_patterns.example_context."""
    items = nested.latest_version(table(spark, sf_dir, "cde_item").select("tinyId", "x__v", "stewardOrg", "definitions"), "tinyId", "x__v")
    a = items.select(F.lit("cde_item").alias("src"), F.col("tinyId").alias("rec_key"), F.col("stewardOrg.name").alias("host"), F.posexplode("definitions").alias("idx", "d"))
    a = a.select("src", "rec_key", "idx", "host", F.col("d.definition").alias("text"))
    s = table(spark, sf_dir, "substitute_patterns")
    b = s.select(F.lit("substitute_patterns").alias("src"), F.col("row_id").cast("string").alias("rec_key"), F.lit(0).alias("idx"), F.regexp_extract("example_context", r"^\[[^\]]*\]", 0).alias("host"), F.regexp_replace("example_context", r"^\[(def|des [A-Z])\] ?\n?", "").alias("text"))
    return a.unionByName(b).where("text is not null").distinct()


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marked_texts(corpus_texts(spark, sf_dir)).select("src", "rec_key", "idx", F.explode("elements").alias("element")).distinct()


def p6_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(src, rec_key, idx, clean_text) of all texts."""

    @F.pandas_udf("string")
    def cleaned(text: pd.Series, meanings: pd.Series) -> pd.Series:
        return pd.Series([render(tokens := lex(t), m if m is not None else ["#"] * len(tokens)) for t, m in zip(text, meanings)], dtype="object")

    some = corpus_texts(spark, sf_dir).select("src", "rec_key", "idx", "host", "text")
    return read_texts(some, ["text"]).select("src", "rec_key", "idx", cleaned("text", "meanings").alias("clean_text"))


QUERIES = {"p6_found": p6_found, "p6_clean": p6_clean}
