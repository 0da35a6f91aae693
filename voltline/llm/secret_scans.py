"""Secret scans by assignment-aware lexing.

Beside the fixed patterns (assign, access, hex), a small lexer reads source and configuration syntax around each
``=``, ``:``, ``:=`` or ``=>``: the name on the left (bare, dotted, quoted, or the key of a subscript), the value on the
right (a quoted or triple-quoted literal, a bare literal, names, or pieces joined with ``+``). A setter's first
argument is a value of the setter's name. A key whose value is nested under it by indentation lends its name to the
keys below. A name in a value, or interpolated in a literal (``${NAME}``, ``{NAME}``, ``%(NAME)s``), stands for that
name's own value: the last one given before, else the first one given later, through chains of any length. A literal
is a secret when the score of its target names and its own shape reaches ``THRESHOLD``. All work is per text, linear
in its length; no shuffle.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter

from pyspark.sql import DataFrame, SparkSession

from voltline.llm.common import map_texts, rewrite_texts, table
from voltline.llm.spans import Span, digest, joined

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
KINDS = {"assign": 0, "access": 1, "hex": 2, "literal": 3}

#: Words of a target name that make its literals sensitive, with their weights.
NAME_WEIGHTS = {
    "password": 1.0, "passwd": 1.0, "pwd": 0.9, "passphrase": 1.0, "secret": 0.9, "token": 0.8, "apikey": 1.0, "credential": 0.9,
    "credentials": 0.9, "auth": 0.5, "bearer": 0.8, "private": 0.4, "access": 0.4, "api": 0.4, "key": 0.5, "signing": 0.4, "client": 0.2,
}
THRESHOLD = 1.2

_OPERATOR = re.compile(r""":=|=>|(?<![=!<>:])=(?![=>])|:(?![:=/])|\((?=[\x20\t]*[rRbBuU]?["'])""")
_START = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz_$")
_INNER = _START | frozenset("0123456789.-")
_PIECE = re.compile(
    r"""[\x20\t]*(?:(?:[rRbBuUfF]{1,2}(?=["']))?(?:\"{3}(?P<long>(?:[^\\]|\\.)*?)\"{3}|'{3}(?P<long1>(?:[^\\]|\\.)*?)'{3}"""
    r"""|"(?P<double>(?:[^"\\\n]|\\.)*)"|'(?P<single>(?:[^'\\\n]|\\.)*)'|`(?P<tick>[^`\n]*)`)"""
    r"""|(?P<ref>[A-Za-z_$][A-Za-z0-9_$.]*)(?![^\s,;)}\]+])|(?P<bare>[^\s"'`,;(){}\[\]]+))""", re.S)
#: A call that gives its receiver a value.
_SETTER = re.compile(r"(?:.*\.)?(?:[sS]et|[wW]ith|[uU]se|[pP]ut|[aA]dd|[sS]tore|[uU]pdate)(?![a-z])")
_INTERPOLATED = re.compile(r"\$\{([A-Za-z_][A-Za-z0-9_.]*)\}|(?<![${])\{([A-Za-z_][A-Za-z0-9_.]*)\}|%\(([A-Za-z_][A-Za-z0-9_.]*)\)s")
#: What may stand between a key and the lines nested under it.
_NESTS = re.compile(r"[\x20\t]*[{|>]?[+-]?[\x20\t]*(?:#[^\n]*)?\r?(?:\n|\Z)")
_PLUS = re.compile(r"[\x20\t]*\+[\x20\t\r\n]*")  # a value goes on in the next line after a plus
_PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
#: Longer than any word of ``_WORDS``: ends of two values that can hold one across their joint.
EDGE = 16
_WORDS = re.compile(r"(?i)example|changeme|change_me|placeholder|your[_-]|dummy|xxxx|\*\*\*")
_WHOLE = re.compile(r"(?i)^<.*>$|^\$\{?|^%\(|^none$|^null$|^true$|^false$")


def base_spans(text: str) -> list[Span]:
    """The fixed patterns' matches by start, then kind."""
    out = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    if "AKIA" in text:
        out += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    out += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[1], KINDS[s[0]]))


def name_score(name: str) -> float:
    """Summed weight of the distinct sensitive words of a target name."""
    return sum(NAME_WEIGHTS.get(p, 0.0) for p in {p.lower() for p in _PARTS.findall(name)})


def literal_score(value: str) -> float:
    """Evidence of the literal's own shape that it is a secret; placeholders and phrases count against it."""
    if len(value) < 6 or _WORDS.search(value) or _WHOLE.search(value):
        return -2.0
    return _shape_score(Counter(value), len(value))


def _shape_score(counts: Counter, n: int) -> float:
    entropy = -sum(c / n * math.log2(c / n) for c in counts.values())
    mixed = any(c.isdigit() for c in counts) and any(c.isalpha() for c in counts)
    return 0.2 * (n >= 8) + 0.2 * (n >= 16) + 0.3 * mixed + 0.3 * (entropy > 3.0) - 0.8 * any(c.isspace() for c in counts)


class Value:
    """Pieces joined into one value: literals' spans and other values, shared and never copied.

    What its score needs of the joined text is kept: length, counts of characters, both ends, and whether a
    placeholder word is inside. So a value of any number of pieces costs as much as its own pieces."""

    def __init__(self, text: str, parts: list):
        self.parts, self.n, self.counts, self.head, self.tail, self.inside = parts, 0, Counter(), "", "", False
        for p in parts:
            if isinstance(p, Value):
                n, counts, head, tail, inside = p.n, p.counts, p.head, p.tail, p.inside
            else:
                t = text[p[0] : p[1]]
                n, counts, head, tail, inside = len(t), Counter(t), t[:EDGE], t[-EDGE:], bool(_WORDS.search(t))
            self.inside = self.inside or inside or bool(_WORDS.search(self.tail + head))
            self.head = (self.head + head)[:EDGE] if self.n < EDGE else self.head
            self.tail = (self.tail + tail)[-EDGE:]
            self.n += n
            self.counts.update(counts)

    def score(self) -> float:
        """``literal_score`` of the joined text."""
        ends = self.head if self.n <= EDGE else self.head + self.tail[-min(EDGE, self.n - EDGE) :]
        return -2.0 if self.n < 6 or self.inside or _WHOLE.search(ends) else _shape_score(self.counts, self.n)


def target(text: str, at: int) -> tuple[int, str] | None:
    """(start, name) of what stands on the left of an operator at ``at``; the whole name, however long."""
    i = at
    while i and text[i - 1] in " \t":
        i -= 1
    if i and text[i - 1] == "?":
        i -= 1
        while i and text[i - 1] == " ":
            i -= 1
    subscript = i > 2 and text[i - 1] == "]" and text[i - 2] in "\"'"
    end = i - 2 if subscript else i - 1 if i and text[i - 1] in "\"'`" else i
    start = end
    while start and text[start - 1] in _INNER:
        start -= 1
    if subscript and text[max(0, start - 2) : start] not in ("[" + text[i - 2],):
        return None
    while start < end and text[start] not in _START:
        start += 1
    return (start, text[start:end]) if start < end else None


#: A piece of a value: a literal's span, or a name with the span that stands for it when nothing is known of it.
Piece = tuple[int, int, str | None]


def assignments(text: str) -> list[tuple[str, str, list[Piece]]]:
    """(name, its path through the keys it is nested under, pieces) of each assignment in order; the name is empty for a call's argument."""
    out = []
    keys: list[tuple[int, str]] = []  # (indent, name) of the keys that the current line is under
    line = 0
    for op in _OPERATOR.finditer(text):
        found = target(text, op.start())
        call = op.group() == "("
        if not found or (call and not _SETTER.match(found[1])):
            continue
        start, name = found
        line = max(line, text.rfind("\n", line, start) + 1)
        lead = text[line : min(start, line + 256)]
        indent = len(lead) - len(lead.lstrip(" \t"))
        while keys and keys[-1][0] >= indent:
            keys.pop()
        pieces: list[Piece] = []
        at, quoted = op.end(), False
        while p := _PIECE.match(text, at):
            kind = p.lastgroup
            s, e = p.span(kind)
            if kind == "ref":
                pieces.append((s, e, p.group(kind)))
            else:
                within = [] if kind == "bare" else [(m.span(), next(g for g in m.groups() if g)) for m in _INTERPOLATED.finditer(text, s, e)]
                if [w for w, _ in within] != [(s, e)]:  # one name alone is no literal
                    pieces.append((s, e, None))
                pieces += [(0, 0, ref) for _, ref in within]
                quoted = quoted or kind != "bare" or any(c.isdigit() for c in text[s : min(e, s + 64)])
            plus = None if call else _PLUS.match(text, p.end())
            if not plus:
                break
            at = plus.end()
        if op.group() == ":" and _NESTS.match(text, op.end()):
            keys.append((indent, name))
        elif pieces:
            path = ".".join([k for _, k in keys] + [name]) if quoted else name
            out.append(("" if call else name.rsplit(".", 1)[-1], path, pieces))
    return out


def values(text: str, given: list[tuple[str, str, list[Piece]]]) -> list[Value]:
    """The value of each assignment; a name in it is the last assignment to that name before it, else the first after it."""
    places: dict[str, list[int]] = {}
    for i, (name, _, _) in enumerate(given):
        if name:
            places.setdefault(name, []).append(i)

    def source(i: int, ref: str) -> int | None:
        known = places.get(ref.rsplit(".", 1)[-1], [])
        k = bisect_left(known, i)
        if k:
            return known[k - 1]
        return next((j for j in known[k : k + 2] if j != i), None)

    parts = [[(s, e) if ref is None else (source(i, ref), (s, e)) for s, e, ref in pieces] for i, (_, _, pieces) in enumerate(given)]
    done: list[Value | None] = [None] * len(given)
    begun = [False] * len(given)
    for first in range(len(given)):
        todo = [first]
        while todo:  # sources before what is made of them; a name that leads back to itself adds nothing
            i = todo[-1]
            if done[i] is not None:
                todo.pop()
                continue
            wait = [] if begun[i] else [p[0] for p in parts[i] if isinstance(p[1], tuple) and p[0] is not None and done[p[0]] is None and not begun[p[0]]]
            begun[i] = True
            if wait:
                todo += wait
                continue
            made: list = []
            for p in parts[i]:
                if not isinstance(p[1], tuple):
                    made.append(p)
                elif p[0] is None:
                    if len(parts[i]) == 1 and p[1][1] > p[1][0]:
                        made.append(p[1])
                elif done[p[0]] is not None:
                    made.append(done[p[0]])
            # a plain name has one value; another name's value is shared, so chains stay linear
            done[i] = made[0] if len(made) == 1 and isinstance(made[0], Value) else Value(text, made)
            todo.pop()
    return done


def lexed_secrets(text: str) -> list[tuple[int, int]]:
    """Spans of literals that reach a sensitive name, directly or through other names."""
    if "=" not in text and ":" not in text and "(" not in text:
        return []
    given = assignments(text)
    reached: set[int] = set()  # values whose literals are found already
    found: set[tuple[int, int]] = set()
    for (_, path, _), value in zip(given, values(text, given)):
        weight = name_score(path)
        if weight and weight + value.score() >= THRESHOLD:
            todo = [value]
            while todo:
                v = todo.pop()
                if id(v) not in reached:
                    reached.add(id(v))
                    todo += [p for p in v.parts if isinstance(p, Value)]
                    found.update(p for p in v.parts if not isinstance(p, Value))
    return sorted(found)


def scan(text: str) -> tuple[list[Span], list[Span]]:
    """(base spans, all spans): lexed literals outside the base spans are added as kind ``literal``."""
    base = base_spans(text)
    added, i, reach = [], 0, -1
    for s, e in lexed_secrets(text):
        while i < len(base) and base[i][1] <= s:
            reach = max(reach, base[i][2])
            i += 1
        if e > reach and e > s:
            added.append(("literal", s, e))
    return base, sorted(base + added, key=lambda x: (x[1], KINDS[x[0]]))


FIELDS = {"n_assign": "long", "n_access": "long", "n_hex": "long", "n_literal": "long", "base_sha256": "string", "spans": "string"}


def _scan_block(texts: list[str]) -> dict[str, list]:
    out: dict[str, list] = {k: [] for k in FIELDS}
    for t in texts:
        base, spans = scan(t)
        n = Counter(s[0] for s in spans)
        for k in KINDS:
            out[f"n_{k}"].append(n[k])
        out["base_sha256"].append(digest(base))
        out["spans"].append(joined(spans))
    return out


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row with its spans, in code points of the whole text, of any length. Null and empty texts have
    none; equal rows (repeats) give equal rows; an empty table gives none; other columns are not read."""
    return map_texts(docs, id_col, text_col, _scan_block, FIELDS)


def mask(text: str) -> str:
    """The text with every span's characters replaced: ``[SECRET]`` for each united run of spans."""
    _, spans = scan(text)
    out, at = [], 0
    for _, s, e in spans:
        if s >= at:
            out += [text[at:s], "[SECRET]"]
        at = max(at, e)
    return "".join([*out, text[at:]])


def mask_secrets(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with secrets masked in ``text_col``; all columns and rows stay, null texts stay null."""
    return rewrite_texts(docs, text_col, mask)


def op7_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``secret_spans`` of every whole text of ``documents``."""
    return secret_spans(table(spark, sf_dir, "documents"))
