"""Personal data: fixed patterns, and a skip-chain conditional random field that adds what they miss.

The field's nodes are the tokens with a digit or an ``@`` (a token without either can only be outside: its potential
for every kind is 0, so it parts the chain). Neighbouring nodes share a transition potential; distant tokens that are
equal or similar (same letters and digits, or the same mailbox name) are all linked to their first occurrence and share
an agreement potential, so evidence of any of them is two steps from every other. Loopy message passing runs over all
texts of a block at once, each until its own messages settle, so a repeated token takes one label through its document.
The word before a token is a hashed feature: which words are cues is learned from the corpus, in any language. Weights are fitted by pseudo-likelihood on a bounded sample of documents: tokens under a
fixed pattern take its kind, tokens whose match only failed its check (Luhn, part or digit count) stay unlabelled,
all others are outside. The work is per text: no shuffle; the weights are a fixed-size table.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltline.llm.common import map_texts, table
from voltline.llm.sampling import bounded_sample, within_budget
from voltline.llm.spans import Span, digest, joined
from voltline.session import materialize

KINDS = ("email", "ip", "card", "phone")
ORDER = {k: i for i, k in enumerate(KINDS)}

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]")
_NODE = re.compile(r"[0-9@][^\x20\x09-\x0D]*")
_SPACES = re.compile(r"[\x20\x09-\x0D]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (d * 2 - 9 if d > 4 else d * 2)
    return total % 10 == 0


def _emails(text: str) -> list[Span]:
    """Each ``@`` with the longest run of mailbox characters before it and a dotted domain after it."""
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and _LOCAL.match(text, start - 1):
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append(("email", start, m.end()))
            end = m.end()
        at = text.find("@", max(at + 1, end))
    return out


def matches(text: str) -> tuple[list[Span], list[Span]]:
    """(base spans by kind, then start; matches that failed their check)."""
    good, failed = _emails(text), []
    if not _DIGITS.search(text):
        return good, failed
    for m in _IP.finditer(text) if "." in text else ():
        ok = all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split("."))
        (good if ok else failed).append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m.group().replace(" ", "").replace("-", "")
            if len(digits) >= 13:
                (good if len(digits) <= 19 and luhn(digits) else failed).append(("card", m.start(), m.end()))
    for m in _PHONE.finditer(text) if "+" in text else ():
        n = len(_DIGITS.findall(m.group()))
        (good if 9 <= n <= 15 else failed).append(("phone", m.start(), m.end()))
    return good, failed


# --- nodes and features ----------------------------------------------------------------------

OUT = 0
N_LABELS = 1 + len(KINDS)
BUCKETS = 1 << 14
#: Characters before a token in which the word before it is looked for: a window of a feature, not of the search.
CUE_CHARS = 64


@dataclass
class Nodes:
    start: np.ndarray
    end: np.ndarray
    feature: np.ndarray  # nodes x N_FEATURES buckets
    chain: np.ndarray  # edges x 2: next to each other
    skip: np.ndarray  # edges x 2: equal or similar, the first occurrence to each other one


N_FEATURES = 6


def _bucket(kind: str, value: str) -> int:
    return zlib.crc32(f"{kind}={value}".encode("utf-8", "ignore")) % BUCKETS


def _shape(token: str) -> str:
    """Character classes, runs collapsed; the edges' punctuation and the middle of a long shape left out."""
    t = token.strip(".,;:!?#*$%&\"'|<>")
    s = re.sub(r"[0-9]+", "9", re.sub(r"[^\W\d_]+", "a", t))
    return s if len(s) <= 24 else s[:12] + "~" + s[-12:]


def nodes_of(text: str) -> Nodes:
    spans, last = [], 0
    for m in _NODE.finditer(text):
        s = m.start()
        while s > last and not _SPACES.match(text, s - 1):
            s -= 1
        spans.append((s, m.end()))
        last = m.end()
    feats, chain, skip = [], [], []
    seen: dict[str, int] = {}
    shapes = [_shape(text[s:e]) for s, e in spans]
    for i, (s, e) in enumerate(spans):
        token = text[s:e]
        digits = sum(c.isdigit() for c in token)
        before = text[max(0, s - CUE_CHARS) : s].split()
        cue = re.sub(r"\W", "", before[-1]).lower() if before else ""
        near = bool(i) and text[spans[i - 1][1] : s].isspace() and "\n" not in text[spans[i - 1][1] : s]
        after = i + 1 < len(spans) and text[e : spans[i + 1][0]].isspace() and "\n" not in text[e : spans[i + 1][0]]
        # the bucket of each feature; shapes of neighbours count where no other token lies between
        feats.append([
            _bucket("shape", shapes[i]), _bucket("digits", str(min(digits, 24))), _bucket("both", f"{shapes[i]}/{min(digits, 24)}"),
            _bucket("cue", cue), _bucket("before", shapes[i - 1] if near else ""), _bucket("after", shapes[i + 1] if after else ""),
        ])
        if near:
            chain.append((i - 1, i))
        key = re.sub(r"[\W_]+", "", token.split("@")[0]).lower() or token
        first = seen.setdefault(key, i)
        if first != i and (first, i) not in chain[-1:]:
            skip.append((first, i))
    pairs = lambda p: np.array(p, np.int64).reshape(-1, 2)
    return Nodes(pairs(spans)[:, 0], pairs(spans)[:, 1], np.array(feats, np.int64).reshape(-1, N_FEATURES), pairs(chain), pairs(skip))


def node_labels(nodes: Nodes, good: list[Span], failed: list[Span]) -> np.ndarray:
    """Kind of each node that a span overlaps, -1 under a failed match, else ``OUT``."""
    y = np.zeros(len(nodes.start), np.int64)
    for spans, value in ((failed, lambda k: -1), (good, lambda k: 1 + ORDER[k])):
        for k, s, e in spans:
            a, b = np.searchsorted(nodes.end, s, "right"), np.searchsorted(nodes.start, e, "left")
            y[a:b] = value(k)
    return y


# --- the field -------------------------------------------------------------------------------


@dataclass(frozen=True)
class FieldConfig:
    sample_rows: int = 20_000
    sample_chars: int = 60_000_000  # characters of all sampled texts together; rows are taken by hash, never by size
    steps: int = 150
    rate: float = 0.1
    decay: float = 1e-4
    rounds: int = 200  # of message passing at most; a text is done when its messages have settled
    damping: float = 0.3
    accept: float = 0.8  # least marginal of an added span


@dataclass
class Field:
    unary: np.ndarray  # BUCKETS x N_LABELS
    move: np.ndarray  # N_LABELS x N_LABELS
    agree: float
    cfg: FieldConfig

    def marginals(self, feature: np.ndarray, chain: np.ndarray, skip: np.ndarray, off: np.ndarray | None = None) -> np.ndarray:
        """Label marginals by loopy sum-product over chain and skip edges.

        ``off``: first node of each text, then the number of nodes. A text's messages stop when all of them have settled,
        whatever those of other texts do."""
        n = len(feature)
        off = np.array([0, n]) if off is None else off
        phi = self.unary[feature].sum(1)
        edges = np.concatenate([chain, skip])
        if not len(edges):
            return _softmax(phi)
        pair = np.concatenate([np.broadcast_to(self.move, (len(chain), N_LABELS, N_LABELS)), np.broadcast_to(self.agree * np.eye(N_LABELS), (len(skip), N_LABELS, N_LABELS))])
        a, b = edges.T
        ab, ba = np.zeros((len(edges), N_LABELS)), np.zeros((len(edges), N_LABELS))

        def belief() -> np.ndarray:
            m = phi.copy()
            for k in range(N_LABELS):
                m[:, k] += np.bincount(b, ab[:, k], n) + np.bincount(a, ba[:, k], n)
            return m

        text = np.searchsorted(off, a, "right") - 1
        live = np.arange(len(edges))
        for _ in range(self.cfg.rounds):
            m = belief()
            i, j, p = a[live], b[live], pair[live]
            new_ab = _logsum((m[i] - ba[live])[:, :, None] + p, 1)
            new_ba = _logsum((m[j] - ab[live])[:, None, :] + p, 2)
            new_ab -= new_ab.max(1, keepdims=True)
            new_ba -= new_ba.max(1, keepdims=True)
            moved = np.maximum(np.abs(new_ab - ab[live]).max(1), np.abs(new_ba - ba[live]).max(1))
            ab[live] += (1 - self.cfg.damping) * (new_ab - ab[live])
            ba[live] += (1 - self.cfg.damping) * (new_ba - ba[live])
            most = np.zeros(len(off))
            np.maximum.at(most, text[live], moved)
            live = live[most[text[live]] >= 1e-4]
            if not len(live):
                break
        return _softmax(belief())


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis)) + top.squeeze(axis)


def _softmax(z: np.ndarray) -> np.ndarray:
    p = np.exp(z - z.max(1, keepdims=True)) if len(z) else z
    return p / p.sum(1, keepdims=True)


def fit(feature: np.ndarray, y: np.ndarray, chain: np.ndarray, skip: np.ndarray, cfg: FieldConfig = FieldConfig()) -> Field:
    """Pseudo-likelihood: each labelled node given its features and its labelled neighbours' labels."""
    f = Field(np.zeros((BUCKETS, N_LABELS)), np.zeros((N_LABELS, N_LABELS)), 0.0, cfg)
    known = np.flatnonzero(y >= 0)
    if not len(known) or not (y > 0).any():
        f.unary[:, OUT] = 1.0  # nothing to learn from: everything is outside
        return f
    hot = np.zeros((len(y), N_LABELS))
    hot[known, y[known]] = 1
    chain = chain[(y[chain] >= 0).all(1)] if len(chain) else chain
    skip = skip[(y[skip] >= 0).all(1)] if len(skip) else skip
    agree = np.zeros_like(hot)
    np.add.at(agree, skip[:, 0], hot[skip[:, 1]])
    np.add.at(agree, skip[:, 1], hot[skip[:, 0]])
    state = [np.zeros_like(f.unary), np.zeros_like(f.unary), np.zeros_like(f.move), np.zeros_like(f.move), 0.0, 0.0]
    for step in range(1, cfg.steps + 1):
        z = f.unary[feature].sum(1) + f.agree * agree
        np.add.at(z, chain[:, 0], f.move.T[y[chain[:, 1]]])
        np.add.at(z, chain[:, 1], f.move[y[chain[:, 0]]])
        g = (hot - _softmax(z)) / len(known)
        g[y < 0] = 0
        gu = np.stack([np.bincount(feature.ravel(), np.repeat(g[:, k], N_FEATURES), BUCKETS) for k in range(N_LABELS)], 1) - cfg.decay * f.unary
        gm = hot[chain[:, 0]].T @ g[chain[:, 1]] + g[chain[:, 0]].T @ hot[chain[:, 1]] - cfg.decay * f.move
        ga = float((g * agree).sum()) - cfg.decay * f.agree
        moves = []
        for v, k in ((gu, 0), (gm, 2), (ga, 4)):  # Adam
            state[k] = 0.9 * state[k] + 0.1 * v
            state[k + 1] = 0.999 * state[k + 1] + 0.001 * v * v
            moves.append(cfg.rate * (state[k] / (1 - 0.9**step)) / (np.sqrt(state[k + 1] / (1 - 0.999**step)) + 1e-8))
        f.unary += moves[0]
        f.move += moves[1]
        f.agree = max(0.0, f.agree + float(moves[2]))
    return f


def _together(parts: list[Nodes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(features, chain, skip, offsets) of several texts' nodes as one field."""
    off = np.concatenate([[0], np.cumsum([len(p.start) for p in parts])]).astype(np.int64)
    cat = lambda xs, w: np.concatenate([np.zeros((0, w), np.int64), *xs])
    return cat([p.feature for p in parts], N_FEATURES), cat([p.chain + o for p, o in zip(parts, off)], 2), cat([p.skip + o for p, o in zip(parts, off)], 2), off


def find(texts: list[str], field: Field) -> list[tuple[list[Span], list[Span]]]:
    """(base spans, added spans) of each text."""
    base = [matches(t)[0] for t in texts]
    parts = [nodes_of(t) for t in texts]
    feature, chain, skip, off = _together(parts)
    p = field.marginals(feature, chain, skip, off)
    label = np.where(p.max(1, initial=0) >= field.cfg.accept, p.argmax(1), OUT) if len(p) else np.zeros(0, np.int64)
    out = []
    for text, b, nodes, o, stop in zip(texts, base, parts, off, off[1:]):
        added: list[Span] = []
        if (label[o:stop] > 0).any():
            taken = node_labels(nodes, b, []) > 0
            for i in np.flatnonzero((label[o:stop] > 0) & ~taken).tolist():
                kind = KINDS[label[o + i] - 1]
                s, e = _trimmed(text, int(nodes.start[i]), int(nodes.end[i]))
                if added and added[-1][0] == kind and _one_number(text, kind, added[-1][1], added[-1][2], s, e):
                    added[-1] = (kind, added[-1][1], e)
                elif s < e:
                    added.append((kind, s, e))
        out.append((b, added))
    return out


def _one_number(text: str, kind: str, first: int, end: int, start: int, stop: int) -> bool:
    """Whether two spans of a card or phone are pieces of one number."""
    most = {"card": 19, "phone": 15}.get(kind, 0)
    return start - end <= 3 and not text[end:start].strip(" ()-.") and len(_DIGITS.findall(text[first:stop])) <= most


def _trimmed(text: str, s: int, e: int) -> tuple[int, int]:
    while s < e and not (text[s].isalnum() or text[s] in "+("):
        s += 1
    while e > s and not text[e - 1].isalnum():
        e -= 1
    return s, e


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", cfg: FieldConfig = FieldConfig()) -> Field:
    """Field fitted on a sample of rows (by hash of the id) bounded in rows and characters; texts without nodes teach nothing."""

    def run(texts: list[str]) -> dict[str, list]:
        rows = []
        for t in texts:
            n = nodes_of(t)
            rows.append([node_labels(n, *matches(t)).tolist(), n.feature.ravel().tolist(), n.chain.ravel().tolist(), n.skip.ravel().tolist()])
        return {k: [r[i] for r in rows] for i, k in enumerate(("y", "feature", "chain", "skip"))}

    fields = dict.fromkeys(("y", "feature", "chain", "skip"), "array<int>")
    sample = bounded_sample(docs.select(F.col(id_col).alias("_key"), F.col(text_col).cast("string").alias("_text")), "_key", cfg.sample_rows)
    sample = within_budget(materialize(sample, "personal-sample"), "_key", "_text", cfg.sample_chars)
    got = map_texts(sample, "_key", "_text", run, fields).where("size(y) > 0").drop("_key").limit(cfg.sample_rows).collect()
    got = sorted(tuple(map(tuple, r)) for r in got)  # the fit doesn't depend on the order of tasks
    arrays = [Nodes(np.array(r[0]), np.array(r[0]), np.array(r[1], np.int64).reshape(-1, N_FEATURES), np.array(r[2], np.int64).reshape(-1, 2), np.array(r[3], np.int64).reshape(-1, 2)) for r in got]
    feature, chain, skip, _ = _together(arrays)
    return fit(feature, np.concatenate([np.zeros(0, np.int64), *(a.start for a in arrays)]).astype(np.int64), chain, skip, cfg)


FIELDS = {"n_email": "long", "n_ip": "long", "n_card": "long", "n_phone": "long", "base_sha256": "string", "spans": "string", "n_added": "long"}


def personal_spans(docs: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: counts and digest of the base spans, and all spans by kind, then start.

    Null and empty texts have no spans; repeated rows give repeated rows; texts of any length are searched whole; of
    labels that tie, the first of ``KINDS`` is taken; an empty table gives none."""

    def run(texts: list[str]) -> dict[str, list]:
        out: dict[str, list] = {k: [] for k in FIELDS}
        for base, added in find(texts, field):
            n = Counter(s[0] for s in base)
            for k in KINDS:
                out[f"n_{k}"].append(n[k])
            out["base_sha256"].append(digest(base))
            out["spans"].append(joined(sorted(base + added, key=lambda s: (ORDER[s[0]], s[1]))))
            out["n_added"].append(len(added))
        return out

    return map_texts(docs, id_col, text_col, run, FIELDS)


def op1_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``personal_spans`` of every whole text of ``documents``, by a field fitted on a sample of them."""
    docs = table(spark, sf_dir, "documents")
    return personal_spans(docs, train(docs))
