"""Language identification: averaged hashed subword embeddings, a linear softmax, calibrated rejection.

Subwords are byte n-grams (n = 2..4) of the lower-cased letters, every other run of characters being one space.
Training runs in numpy by stochastic gradient descent on hashed n-gram counts of a bounded sample of labelled
rows (``TrainConfig.sample_rows``, taken by hash of the id over the whole table, and ``lang_rows`` of each language
besides, so that rare ones are learned). A text's score needs only the
product of embeddings and output weights (buckets x languages), which ships with the tasks: its size is fixed.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltline.llm.common import crc_mod, map_texts, table
from voltline.llm.sampling import bounded_sample_of_each


@dataclass(frozen=True)
class TrainConfig:
    sample_rows: int = 4000
    lang_rows: int = 50  # of each language at least, or all it has
    buckets: int = 1 << 15
    dim: int = 16
    epochs: int = 4
    batch: int = 32
    rate: float = 0.5
    precision: float = 0.99  # of the texts that the calibrated rejection accepts
    seed: int = 7


ORDERS = (2, 3, 4)
_KEEP = np.zeros(256, bool)
_KEEP[[*range(97, 123), *range(128, 256)]] = True


def subwords(texts: list[str], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(text index, bucket) of each n-gram. Characters that are no letters part words."""
    raw = ["".join(c if c.isalpha() else " " for c in t.lower()) if not t.isascii() else t.lower() for t in texts]
    data = [r.encode("utf-8", "ignore") for r in raw]
    buf = np.frombuffer(b"".join(b" %b " % d for d in data), np.uint8)
    owner = np.repeat(np.arange(len(texts)), [len(d) + 2 for d in data])
    b = np.where(_KEEP[buf], buf, np.uint8(32)).astype(np.uint32)
    space = b == 32
    again = np.zeros(len(b), bool)  # one space at most between words
    again[1:] = space[1:] & space[:-1] & (owner[1:] == owner[:-1])
    b, space, owner = b[~again], space[~again], owner[~again]
    docs, grams = [], []
    h = b * np.uint32(0x01000193)
    for n in range(2, max(ORDERS) + 1):
        h = (h[: len(b) - n + 1] ^ b[n - 1 :]) * np.uint32(0x01000193) if len(b) >= n else h[:0]
        if n in ORDERS and len(h):
            ok = owner[: len(h)] == owner[n - 1 :]
            for j in range(1, n - 1):  # no space inside: subwords of one word and its edges
                ok &= ~space[j : j + len(h)]
            v = h[ok]
            v = (v ^ (v >> np.uint32(15))) * np.uint32(0x85EBCA6B)
            docs.append(owner[: len(h)][ok])
            grams.append((v >> np.uint32(16) ^ v) & np.uint32(buckets - 1))
    return (np.concatenate(docs), np.concatenate(grams)) if docs else (np.empty(0, np.int64), np.empty(0, np.uint32))


@dataclass
class LanguageModel:
    langs: list[str]
    table: np.ndarray  # buckets x languages, float32
    bias: np.ndarray
    temperature: float = 1.0
    accept: float = 0.0  # least score of the calibrated acceptance

    def probabilities(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(texts x languages, number of subwords)."""
        doc, gram = subwords(texts, len(self.table))
        n = np.bincount(doc, minlength=len(texts))
        z = np.stack([np.bincount(doc, self.table[gram, k], len(texts)) for k in range(len(self.langs))], 1)
        z = (z / np.maximum(n, 1)[:, None] + self.bias) / self.temperature
        p = np.exp(z - z.max(1, keepdims=True))
        return p / p.sum(1, keepdims=True), n


def fit(rows: list[tuple[str, np.ndarray, np.ndarray]], cfg: TrainConfig = TrainConfig()) -> LanguageModel:
    """``rows``: (language, buckets, counts) of each training text. One fifth is kept for calibration."""
    rows = [r for r in rows if len(r[1])]
    langs = sorted({r[0] for r in rows})
    if not langs:
        return LanguageModel(["und"], np.zeros((cfg.buckets, 1), np.float32), np.zeros(1))
    rng = np.random.default_rng(cfg.seed)
    y = np.array([langs.index(r[0]) for r in rows])
    weight = len(rows) / (len(langs) * np.bincount(y, minlength=len(langs)))
    emb = rng.normal(0, 0.1, (cfg.buckets, cfg.dim))
    out, bias = rng.normal(0, 0.1, (cfg.dim, len(langs))), np.zeros(len(langs))
    order = rng.permutation(len(rows))
    held, train = (order[: len(rows) // 5], order[len(rows) // 5 :]) if len(rows) >= 20 else (order, order)
    alone = ~np.isin(y[held], y[train])  # a language that only held rows have is learned from them
    held, train = held[~alone], np.concatenate([train, held[alone]])
    held = held if len(held) else train.copy()
    total = cfg.epochs * max(1, len(train) // cfg.batch + 1)
    step = 0
    for _ in range(cfg.epochs):
        rng.shuffle(train)
        for i in range(0, len(train), cfg.batch):
            part = train[i : i + cfg.batch]
            rate, step = cfg.rate * (1 - step / (total + 1)), step + 1
            idx = np.concatenate([rows[j][1] for j in part])
            freq = np.concatenate([rows[j][2] / rows[j][2].sum() for j in part])
            seg = np.repeat(np.arange(len(part)), [len(rows[j][1]) for j in part])
            x = np.stack([np.bincount(seg, freq * emb[idx, d], len(part)) for d in range(cfg.dim)], 1)
            z = x @ out + bias
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(part)), y[part]] -= 1
            g = p * weight[y[part]][:, None]
            gx = g @ out.T
            out -= rate * x.T @ g
            bias -= rate * g.mean(0)
            scale = 20.0 * rate * freq  # a subword's share of a text is small
            for d in range(cfg.dim):
                emb[:, d] -= np.bincount(idx, scale * gx[seg, d], cfg.buckets)
    m = LanguageModel(langs, (emb @ out).astype(np.float32), bias)
    z = np.stack([(rows[j][2][:, None] * m.table[rows[j][1]]).sum(0) / rows[j][2].sum() + bias for j in held])
    best = np.inf
    for t in np.geomspace(0.05, 20, 60):
        s = z / t - (z / t).max(1, keepdims=True)
        loss = -(s[np.arange(len(held)), y[held]] - np.log(np.exp(s).sum(1))).mean()
        if loss < best:
            best, m.temperature = loss, float(t)
    s = np.exp(z / m.temperature - (z / m.temperature).max(1, keepdims=True))
    s /= s.sum(1, keepdims=True)
    by = np.argsort(-s.max(1))
    right = (s.argmax(1) == y[held])[by]
    good = np.flatnonzero(np.cumsum(right) / np.arange(1, len(by) + 1) >= cfg.precision)
    m.accept = float(s.max(1)[by][good[-1]]) if len(good) else 1.0
    return m


def _counts(texts: list[str], buckets: int) -> dict[str, list]:
    doc, gram = subwords(texts, buckets)
    cuts = np.searchsorted(doc, np.arange(len(texts) + 1)) if np.all(doc[1:] >= doc[:-1]) else None
    if cuts is None:
        by = np.argsort(doc, kind="stable")
        doc, gram = doc[by], gram[by]
        cuts = np.searchsorted(doc, np.arange(len(texts) + 1))
    pairs = [np.unique(gram[a:b], return_counts=True) for a, b in zip(cuts[:-1], cuts[1:])]
    return {"bucket": [p[0].astype(np.int32) for p in pairs], "count": [p[1].astype(np.int64) for p in pairs]}


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", cfg: TrainConfig = TrainConfig()) -> LanguageModel:
    """Model from the labelled rows of ``docs`` (null labels are left out)."""
    rows = docs.where(F.col(lang_col).isNotNull()).select(F.col(id_col).alias("_key"), F.col(lang_col).alias("_lang"), F.col(text_col).alias("_text"))
    sample, most = bounded_sample_of_each(rows, "_key", cfg.sample_rows, "_lang", cfg.lang_rows)
    buckets = cfg.buckets
    counted = map_texts(sample, "_lang", "_text", lambda t: _counts(t, buckets), {"bucket": "array<int>", "count": "array<long>"})
    got = sorted(((r[0], np.array(r[1], np.int64), np.array(r[2], float)) for r in counted.limit(most).collect()), key=lambda r: (r[0], len(r[1]), r[1].tobytes(), r[2].tobytes()))
    return fit(got, cfg)


def predict(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``lang_pred`` (``und`` for texts without a letter, null or empty), ``score``, ``accepted``.

    Of languages that tie, the first by name is taken; equal rows (repeats) give equal rows; texts of any length are read
    whole; an empty table gives no rows."""

    def run(texts: list[str]) -> dict[str, list]:
        p, n = model.probabilities(texts)
        top = p.argmax(1)
        letters = np.array([k > 0 or any(c.isalpha() for c in t) for k, t in zip(n.tolist(), texts)], bool)
        score = np.where(letters, p[np.arange(len(texts)), top], 0.0)
        return {"lang_pred": [model.langs[k] if ok else "und" for k, ok in zip(top.tolist(), letters.tolist())], "score": score, "accepted": letters & (score >= model.accept)}

    return map_texts(docs, id_col, text_col, run, {"lang_pred": "string", "score": "double", "accepted": "boolean"})


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``predict`` of every whole text of ``documents``, by a model of the rows outside the held-out quarter."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = train(docs.where(crc_mod("doc_id", 4) != 2))
    return predict(docs, model).select("doc_id", (crc_mod("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score", "accepted")
