"""Quality classifier: a linear-chain conditional random field over the lines of a document.

Each non-blank line has shape features (letters, capitals, digits, symbols, bars, lengths, repetition) beside those
of the line before and after it. The chain labels every line bad or good; its weights and transitions are fitted
by gradient ascent on the log-likelihood of a sample of labelled documents, bounded in rows and characters, whose lines
take the document's label. A document's quality is the length-weighted mean of its lines' forward-backward marginals, calibrated by a
logistic curve on the same sample. Scoring is one map over the rows: no shuffle; the model is a few hundred numbers.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltline.llm.common import crc_mod, keep_texts, map_texts, table
from voltline.llm.sampling import bounded_sample, within_budget
from voltline.llm.textarrays import mix, segment_hashes, words_of
from voltline.session import materialize


@dataclass(frozen=True)
class CrfConfig:
    sample_rows: int = 6000  # labelled documents to fit on
    sample_chars: int = 24_000_000  # characters of all sampled texts together; rows are taken by hash, never by size
    steps: int = 250
    rate: float = 0.05
    decay: float = 1e-3


def _set(chars: bytes) -> np.ndarray:
    m = np.zeros(256, bool)
    m[list(chars)] = True
    return m


_CLASSES = {
    "upper": _set(bytes(range(65, 91))), "lower": _set(bytes([*range(97, 123), *range(195, 256)])), "digit": _set(b"0123456789"),
    "symbol": _set(b"#*$%&<>@^~=+\\/{}[]_"), "bar": _set(b"|"), "bang": _set(b"!?"), "stop": _set(b"."), "comma": _set(b",;:"), "space": _set(b" \t\r\v\f"),
}
N_OWN = 16


@dataclass
class Lines:
    doc: np.ndarray
    size: np.ndarray  # bytes
    own: np.ndarray  # lines x N_OWN
    n_docs: int

    def offsets(self) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(np.bincount(self.doc, minlength=self.n_docs))])

    def features(self) -> np.ndarray:
        """Own features, those of the neighbours (0 beyond the ends) and a constant."""
        x, n = self.own, len(self.doc)
        before, after = np.zeros_like(x), np.zeros_like(x)
        if n > 1:
            same = (self.doc[1:] == self.doc[:-1])[:, None]
            before[1:], after[:-1] = x[:-1] * same, x[1:] * same
        return np.concatenate([x, before, after, np.ones((n, 1))], 1)


def lines_of(texts: list[str]) -> Lines:
    """Lines (cut at \\n) that hold more than white space."""
    w = words_of(texts)
    buf, bounds = w.buf, w.bounds
    stop = np.flatnonzero(buf == 10)
    start = np.concatenate([[0], stop[:-1] + 1])

    def count(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(mask, dtype=np.int32)])
        return (total[stop] - total[start]).astype(float)

    n = {k: count(m[buf]) for k, m in _CLASSES.items()}
    size = (stop - start).astype(float)
    space = _CLASSES["space"][buf] | (buf == 10)
    word_starts = ~space & np.concatenate([[True], space[:-1]])
    words = count(word_starts)
    word_ends = ~space & np.concatenate([space[1:], [True]])
    odd_ends = count(word_ends & (_CLASSES["symbol"] | _CLASSES["bang"])[buf])
    # words of a line that stood in it before, and those that repeat the word just before
    line_of = np.searchsorted(stop, w.start)
    said, follows = np.zeros(len(stop)), np.zeros(len(stop))
    if len(w.hash):
        _, new = np.unique(mix(w.hash + mix(line_of.astype(np.uint64))), return_index=True)
        said = words - np.bincount(line_of[new], minlength=len(stop))
        twin = np.flatnonzero((w.hash[1:] == w.hash[:-1]) & (line_of[1:] == line_of[:-1])) + 1
        follows = np.bincount(line_of[twin], minlength=len(stop)).astype(float)
    keep = words > 0
    said, follows = said[keep], follows[keep]
    start, stop, size, words, odd_ends = start[keep], stop[keep], size[keep], words[keep], odd_ends[keep]
    n = {k: v[keep] for k, v in n.items()}
    doc = np.searchsorted(bounds, start, "right") - 1
    again = np.zeros(len(doc))
    if len(doc):
        key = mix(segment_hashes(buf, start, stop) + mix(doc.astype(np.uint64)))
        _, first = np.unique(key, return_index=True)
        again[:] = 1.0
        again[first] = 0.0
    chars = np.maximum(1.0, size - n["space"])
    letters = np.maximum(1.0, n["upper"] + n["lower"])
    own = np.stack([
        np.minimum(n["upper"] / letters, 1), n["lower"] / chars, n["digit"] / chars, n["symbol"] / chars * 4, np.minimum(n["bar"] / words, 1), np.minimum(n["bang"] / words, 1),
        np.minimum(n["stop"] / words, 1), np.minimum(n["comma"] / words, 1), odd_ends / words, again, said / words, np.minimum(follows / words * 4, 1),
        np.log1p(words) / 5, np.minimum(chars / words, 20) / 10, (words < 4).astype(float), np.minimum(np.log1p(size) / 10, 2),
    ], 1) if len(doc) else np.zeros((0, N_OWN))
    return Lines(doc, size, own, len(texts))


@dataclass
class ChainModel:
    weight: np.ndarray = field(default_factory=lambda: np.zeros(3 * N_OWN + 1))  # log odds of good
    move: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    scale: float = 1.0
    shift: float = 0.0
    empty: float = 0.5  # score of a text without a line

    def scores(self, texts: list[str]) -> np.ndarray:
        lines = lines_of(texts)
        off = lines.offsets()
        good = marginals(lines.features() @ self.weight, self.move, off)[0]
        mass = np.bincount(lines.doc, lines.size, lines.n_docs)
        mean = np.bincount(lines.doc, lines.size * good, lines.n_docs) / np.maximum(mass, 1)
        p = _sigmoid(self.scale * _logit(mean) + self.shift)
        return np.where(np.diff(off) > 0, p, self.empty)


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _logit(p):
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p) - np.log1p(-p)


def marginals(odds: np.ndarray, move: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward-backward over all chains at once: (P(good) of each line, expected transitions, log Z of each chain).

    ``odds``: log odds of good by line; chain i holds lines off[i]:off[i+1]. Messages are normalised at each step.
    """
    count = np.diff(off)
    chains = np.argsort(-count, kind="stable")
    chains = chains[count[chains] > 0]
    top = int(count.max(initial=0))
    alive = np.searchsorted(-count[chains], -np.arange(top), "left")  # chains longer than t
    e = np.exp(move)
    node = np.stack([np.ones_like(odds), np.exp(np.clip(odds, -30, 30))], 1)
    fwd, bwd = np.empty_like(node), np.ones_like(node)
    log_z = np.zeros(len(count))
    first = off[:-1][chains]
    for t in range(top):
        k = alive[t]
        at = first[:k] + t
        m = node[at] if t == 0 else node[at] * (fwd[at - 1] @ e)
        s = m.sum(1)
        fwd[at] = m / s[:, None]
        log_z[chains[:k]] += np.log(s)
    pairs = np.zeros((2, 2))
    for t in range(top - 2, -1, -1):
        k = alive[t + 1]
        at = first[:k] + t
        ahead = node[at + 1] * bwd[at + 1]
        both = fwd[at][:, :, None] * e[None] * ahead[:, None, :]
        both /= both.sum((1, 2), keepdims=True)
        pairs += both.sum(0)
        b = ahead @ e.T
        bwd[at] = b / b.sum(1, keepdims=True)
    p = fwd * bwd
    return (p[:, 1] / p.sum(1) if len(p) else np.zeros(0)), pairs, log_z


def fit(own: list[np.ndarray], size: list[np.ndarray], label: np.ndarray, cfg: CrfConfig = CrfConfig()) -> ChainModel:
    """``own``/``size``: line features and bytes of each labelled document. Both labels weigh the same in the chain;
    the calibration restores their shares."""
    m = ChainModel()
    if not len(label):
        return m
    m.empty = float(np.clip(label.mean(), 0.01, 0.99))
    use = [i for i, x in enumerate(own) if len(x)]
    if not use or len(set(label[use].tolist())) < 2:
        m.shift = float(_logit(m.empty))
        m.scale = 0.0
        return m
    y_doc = label[use]
    n = np.array([len(own[i]) for i in use])
    off = np.concatenate([[0], np.cumsum(n)])
    doc = np.repeat(np.arange(len(use)), n)
    lines = Lines(doc, np.concatenate([size[i] for i in use]), np.concatenate([own[i] for i in use]), len(use))
    x, y = lines.features(), y_doc[doc].astype(float)
    share = np.bincount(y_doc, minlength=2) / len(y_doc)
    # groups by label and length weigh chains; one pass of forward-backward per label keeps the weights apart
    parts = [np.flatnonzero(y_doc == k) for k in (0, 1)]
    rows = [np.concatenate([np.arange(off[d], off[d + 1]) for d in p]) for p in parts]
    offs = [np.concatenate([[0], np.cumsum(n[p])]) for p in parts]
    w, mv = m.weight, m.move
    state = [np.zeros_like(w), np.zeros_like(w), np.zeros_like(mv), np.zeros_like(mv)]
    for step in range(1, cfg.steps + 1):
        gw, gm = -cfg.decay * w, -cfg.decay * mv
        for k in (0, 1):
            xs = x[rows[k]]
            p, pairs, _ = marginals(xs @ w, mv, offs[k])
            weight = 0.5 / share[k] / len(y_doc)
            gw = gw + weight * (xs.T @ (k - p))
            seen = np.zeros((2, 2))
            seen[k, k] = float((n[parts[k]] - 1).sum())
            gm = gm + weight * (seen - pairs)
        for v, g, a, b in ((w, gw, 0, 1), (mv, gm, 2, 3)):  # Adam
            state[a] = 0.9 * state[a] + 0.1 * g
            state[b] = 0.999 * state[b] + 0.001 * g * g
            v += cfg.rate * (state[a] / (1 - 0.9**step)) / (np.sqrt(state[b] / (1 - 0.999**step)) + 1e-8)
        np.clip(mv, -2, 2, out=mv)
    good = marginals(x @ w, mv, off)[0]
    z = _logit(np.bincount(doc, lines.size * good) / np.bincount(doc, lines.size))
    a, b = 1.0, 0.0
    for _ in range(500):
        g = y_doc - _sigmoid(a * z + b)
        a, b = a + 0.05 * float((g * z).mean()), b + 0.2 * float(g.mean())
    m.scale, m.shift = a, b
    return m


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", cfg: CrfConfig = CrfConfig()) -> ChainModel:
    """Model from the rows of ``docs`` whose id has a label; null labels are left out, and of several the least counts."""
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_key")).agg(F.min(label_col).cast("int").alias("_label"))
    chosen = bounded_sample(known, "_key", cfg.sample_rows)  # at most sample_rows small rows
    rows = docs.select(F.col(id_col).alias("_key"), F.col(text_col).cast("string").alias("_text")).join(F.broadcast(chosen), "_key")
    rows = within_budget(materialize(rows, "quality-sample"), "_key", "_text", cfg.sample_chars)

    def run(texts: list[str]) -> dict[str, list]:
        lines = lines_of(texts)
        off = lines.offsets().tolist()
        # as the bytes of float arrays
        return {"own": [lines.own[a:b].astype("<f4").tobytes() for a, b in zip(off, off[1:])], "size": [lines.size[a:b].astype("<f4").tobytes() for a, b in zip(off, off[1:])]}

    got = map_texts(rows, "_label", "_text", run, {"own": "binary", "size": "binary"}).limit(cfg.sample_rows).collect()
    got = sorted((r[0], bytes(r[1]), bytes(r[2])) for r in got)  # the fit doesn't depend on the order of tasks
    own = [np.frombuffer(r[1], "<f4").astype(float).reshape(-1, N_OWN) for r in got]
    size = [np.frombuffer(r[2], "<f4").astype(float) for r in got]
    return fit(own, size, np.array([r[0] for r in got], int), cfg)


def score(docs: DataFrame, model: ChainModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``score`` in 0..1, ``predicted``. Null, empty and blank texts take the sample's share
    of good documents as score; equal rows (repeats) give equal rows; texts of any length are scored whole; an empty
    table gives no rows."""

    def run(texts: list[str]) -> dict[str, np.ndarray]:
        p = model.scores(texts)
        return {"score": p, "predicted": (p >= 0.5).astype(np.int32)}

    return map_texts(docs, id_col, text_col, run, {"score": "double", "predicted": "int"})


def keep_good(docs: DataFrame, model: ChainModel, text_col: str = "text", least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score at least ``least``, all columns unchanged."""
    return keep_texts(docs, text_col, lambda t: model.scores(t) >= least)


def trained_on(spark: SparkSession, docs: DataFrame, sf_dir: str) -> ChainModel:
    """The model of the labelled rows of ``docs`` outside the held-out third."""
    return train(docs.select("doc_id", "text"), table(spark, sf_dir, "labels").where(crc_mod("doc_id", 3) != 1))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``score`` of every whole text of ``documents``, by a model of the labelled rows outside the held-out third."""
    docs = table(spark, sf_dir, "documents")
    scored = score(docs, trained_on(spark, docs, sf_dir))
    return scored.select("doc_id", (crc_mod("doc_id", 3) == 1).alias("held_out"), "score", "predicted")
