"""Toxicity: a convolutional text classifier over hashed word embeddings, with thresholds calibrated by language.

A word's embedding is the concatenation of four rows, one of each of four tables: two are found by two parts of the
word's hash, so that a word that meets another in one table differs from it in the other, two by the hashes of its
stem, its first 4 and 6 bytes, so that endings not seen in training still count. Filters of several widths slide over the words, each filter's greatest response is kept, and a linear layer gives the log odds. All of it is trained in numpy
on a bounded sample of labelled documents; gradients reach only the windows that the pooling chose. A first coordinate
of the embeddings starts at the log odds of the label among the documents that hold the word. Words of fewer than
``least_docs`` sampled documents stay at zero, and so do words that training never saw.

A document of any length is one maximum over its windows, so its score does not depend on the texts beside it. The
language, for the threshold alone, is read off the text's function words; the language column is no input. Scoring is
one map over the rows: no shuffle. The model, about 6 MB whatever the corpus, ships with the tasks.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltline.llm.common import crc_mod, map_texts, table
from voltline.llm.sampling import bounded_sample_of_each, within_budget
from voltline.llm.textarrays import segment_hashes
from voltline.session import materialize


@dataclass(frozen=True)
class ConvConfig:
    sample_rows: int = 4000  # labelled documents of least key hash
    label_rows: int = 2000  # and so many of each label at least, or all it has
    sample_chars: int = 20_000_000  # characters of all sampled texts together, half for each label
    buckets: int = 1 << 16  # rows of each table
    dim: int = 6  # of a row; an embedding has one row of each table
    widths: tuple[int, ...] = (1, 2, 3)
    filters: int = 6  # of each width
    least_docs: int = 3
    epochs: int = 8
    batch: int = 40
    rate: float = 0.02
    decay: float = 1e-4
    language_rows: int = 10  # held documents of each label that a language's own threshold takes
    seed: int = 11


#: Fixed function words by which a text's language is told for its threshold.
FUNCTION_WORDS = {
    "en": "the of and to in is that for it with as was on are by this be at from",
    "de": "der die das und ist nicht ein eine mit von zu den dem im auf für sich des als auch",
    "fr": "le la les des et est un une dans que pour qui pas sur au du par ne se ce",
    "es": "el la los las de que y en un una por con para del no al lo como más su",
    "it": "il lo la gli le di che e un una per con non del della sono da nel si",
    "pt": "o a os as de que e em um uma por com para do da no na não se mais",
    "nl": "de het een en van is dat niet in op te met voor zijn aan er ook door",
}
_WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


#: Bytes of a word's two stems.
STEMS = (4, 6)
TABLES = 2 + len(STEMS)


@dataclass
class Tokens:
    """Hashes of the words of several texts and of their stems; text i has words off[i]:off[i+1]."""

    hash: np.ndarray
    stems: list[np.ndarray]
    off: np.ndarray

    def buckets(self, n: int) -> np.ndarray:
        """Row numbers in each table, one line a word."""
        mask = np.uint64(n - 1)
        return np.stack([h & mask for h in (self.hash, self.hash >> np.uint64(32), *self.stems)], 1).astype(np.int32)


def tokens_of(texts: list[str]) -> Tokens:
    """Words are runs of ASCII letters, lower-cased, and of characters beyond ASCII."""
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    buf = np.frombuffer((b" ".join(raw) + b" ").translate(_WORD_BYTES), np.uint8)
    edge = np.flatnonzero(np.diff(np.concatenate([[True], buf == 32]).astype(np.int8)))
    start, end = edge[::2], edge[1::2]
    ends = np.cumsum([len(r) + 1 for r in raw]) if raw else np.zeros(0, np.int64)
    stems = [segment_hashes(buf, start, np.minimum(end, start + k)) for k in STEMS]
    return Tokens(segment_hashes(buf, start, end), stems, np.concatenate([[0], np.searchsorted(start, ends)]).astype(np.int64))


def _function_hashes() -> tuple[np.ndarray, np.ndarray]:
    """(hash, languages that have the word as bits), by hash."""
    held: dict[int, int] = {}
    for k, words in enumerate(FUNCTION_WORDS.values()):
        for h in tokens_of([words]).hash.tolist():
            held[h] = held.get(h, 0) | 1 << k
    keys = np.array(sorted(held), np.uint64)
    return keys, np.array([held[int(k)] for k in keys], np.int64)


def languages(tokens: Tokens) -> list[str]:
    """Language with the most function words in each text; the first listed of equals; ``other`` without any."""
    keys, bits = _function_hashes()
    at = np.minimum(np.searchsorted(keys, tokens.hash), len(keys) - 1)
    got = np.where(keys[at] == tokens.hash, bits[at], 0)
    counts = np.stack([_segment_sum((got >> k) & 1, tokens.off) for k in range(len(FUNCTION_WORDS))], 1)
    names = list(FUNCTION_WORDS)
    return [names[k] if m else "other" for k, m in zip(counts.argmax(1).tolist(), counts.max(1).tolist())]


def _segment_sum(x: np.ndarray, off: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(x)])
    return total[off[1:]] - total[off[:-1]]


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class ConvModel:
    emb: np.ndarray  # tables x (buckets + 1) x dim; the last row, zero, stands beyond a text's end
    filters: list[np.ndarray]  # for each width: width x (tables x dim) x filters
    bias: list[np.ndarray]
    out: np.ndarray
    base: float
    scale: float = 1.0
    threshold: dict[str, float] = field(default_factory=dict)  # log odds by language; "" for the others
    constant: float | None = None  # the score of every text where the labels could teach nothing

    @property
    def n_buckets(self) -> int:
        return self.emb.shape[1] - 1

    def responses(self) -> list[list[np.ndarray]]:
        """For each width and place of a window: the tables times the filters, so that scoring only looks up and adds."""
        d = self.emb.shape[2]
        return [[np.stack([self.emb[t] @ w[o, t * d : (t + 1) * d] for t in range(TABLES)]).astype(np.float32) for o in range(len(w))] for w in self.filters]

    def odds(self, words: np.ndarray, off: np.ndarray, responses: list[list[np.ndarray]] | None = None) -> np.ndarray:
        """Log odds of each text, given its words' rows in the tables; one without a word has the base alone."""
        responses = responses or self.responses()
        n = len(off) - 1
        z = np.full(n, self.base)
        some = np.flatnonzero(np.diff(off))
        if not len(some):
            return z
        at = 0
        for width, b, tables in zip((len(w) for w in self.filters), self.bias, responses):
            r = np.zeros((len(words), len(b)), np.float32)
            last = np.repeat(off[1:], np.diff(off))  # end of each word's text
            for o in range(width):
                place = np.arange(len(words)) + o
                inside = place < last
                row = np.where(inside[:, None], words[np.minimum(place, len(words) - 1)], self.n_buckets)
                for t in range(TABLES):
                    r += tables[o][t][row[:, t]]
            pooled = np.maximum.reduceat(r, off[:-1][some], axis=0).astype(float)
            a = np.maximum(pooled + b, 0)
            z[some] += (a * self.out[at : at + len(b)]).sum(1)
            at += len(b)
        return z

    def scores(self, texts: list[str], responses: list[list[np.ndarray]] | None = None) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        tokens = tokens_of(texts)
        cut = np.array([self.threshold.get(lang, self.threshold[""]) for lang in languages(tokens)])
        return _sigmoid(self.scale * (self.odds(tokens.buckets(self.n_buckets), tokens.off, responses) - cut))


def _first_embeddings(words: list[np.ndarray], y: np.ndarray, cfg: ConvConfig, rng) -> tuple[np.ndarray, np.ndarray]:
    """Embeddings to start from, and which rows are trained."""
    emb = np.zeros((TABLES, cfg.buckets + 1, cfg.dim))
    used = np.zeros((TABLES, cfg.buckets + 1), bool)
    for t in range(TABLES):
        seen = np.zeros((2, cfg.buckets))
        for w, k in zip(words, y):
            seen[k, np.unique(w[:, t])] += 1
        both = seen.sum(0)
        odds = np.log((seen[1] + 0.5) / (np.sum(y == 1) + 1)) - np.log((seen[0] + 0.5) / (np.sum(y == 0) + 1))
        used[t, :-1] = both >= cfg.least_docs
        emb[t, :-1] = rng.normal(0, 0.1, (cfg.buckets, cfg.dim))
        emb[t, :-1, 0] = np.clip(odds * both / (both + 5), -3, 3) / 3
    emb[~used] = 0
    return emb, used


def gradients(m: ConvModel, words: list[np.ndarray], y: np.ndarray, weight: np.ndarray):
    """Loss and its gradients over one batch: (loss, filters, bias, out, base, (table rows, their gradients))."""
    widest = max(len(w) for w in m.filters)
    pad = np.full((widest - 1, TABLES), m.n_buckets, np.int32)
    rows = np.concatenate([x for w in words for x in (w, pad)] + [pad, pad[:1]])
    n = np.array([len(w) for w in words])
    first = np.concatenate([[0], np.cumsum(n + widest - 1)])[:-1]
    x = np.concatenate([m.emb[t][rows[:, t]] for t in range(TABLES)], 1)
    some = np.flatnonzero(n)
    pooled, chosen = [], []
    for w, b in zip(m.filters, m.bias):
        r = sum(x[o : len(x) - widest + 1 + o] @ w[o] for o in range(len(w)))
        top = np.zeros((len(words), len(b)), np.int64)
        for i in some:
            top[i] = first[i] + r[first[i] : first[i] + n[i]].argmax(0)
        chosen.append(top)
        pooled.append(np.where(n[:, None] > 0, np.maximum(np.take_along_axis(r, top, 0) + b, 0), 0))
    a = np.concatenate(pooled, 1)
    z = a @ m.out + m.base
    loss = (weight * np.logaddexp(0, np.where(y == 1, -z, z))).sum()
    g = weight * (_sigmoid(z) - y)
    da = g[:, None] * m.out * (a > 0)
    d_filters, d_bias, at, d_rows, d_emb = [], [], 0, [], []
    for w, b, top in zip(m.filters, m.bias, chosen):
        own = da[:, at : at + len(b)]
        at += len(b)
        d_bias.append(own.sum(0))
        dw = np.zeros_like(w)
        for o in range(len(w)):
            dw[o] = np.einsum("ifd,if->df", x[top + o], own)
            d_rows.append(rows[top + o].reshape(-1, TABLES))
            d_emb.append((own[:, :, None] * w[o].T[None]).reshape(-1, w.shape[1]))
        d_filters.append(dw)
    return loss, d_filters, d_bias, a.T @ g, g.sum(), (np.concatenate(d_rows), np.concatenate(d_emb))


def fit(words: list[np.ndarray], langs: list[str], y: np.ndarray, natural: tuple[int, int], cfg: ConvConfig = ConvConfig()) -> ConvModel:
    """``words``: rows in the tables of each text's words; ``natural``: documents of label 0 and 1 among all labelled ones.

    Both labels weigh the same in training; the thresholds, set on a held fifth, restore their natural shares."""
    rng = np.random.default_rng(cfg.seed)
    n_out = len(cfg.widths) * cfg.filters
    filters = [rng.normal(0, 0.1, (w, TABLES * cfg.dim, cfg.filters)) for w in cfg.widths]
    for w in filters:
        w[0, :: cfg.dim] += 0.5  # the first word of a window by its log odds
    m = ConvModel(np.zeros((TABLES, cfg.buckets + 1, cfg.dim)), filters, [np.full(cfg.filters, -0.3) for _ in cfg.widths], np.full(n_out, 0.3), -1.0, threshold={"": 0.0})
    if len(set(y.tolist())) < 2:
        m.constant = float(y[0]) if len(y) else 0.0
        return m
    held, train = [], []
    for k in (0, 1):  # a fifth of each label
        own = rng.permutation(np.flatnonzero(y == k))
        cut = len(own) // 5
        held += own[:cut].tolist()
        train += own[cut:].tolist()
    held, train = np.array(held or train), np.array(train)
    m.emb, used = _first_embeddings([words[i] for i in train], y[train], cfg, rng)
    each = 0.5 / np.maximum(np.bincount(y[train], minlength=2), 1) * len(train)
    dense = [*m.filters, *m.bias, m.out]
    moments = [(np.zeros_like(v), np.zeros_like(v)) for v in dense]
    squares, step, base_step = np.full(m.emb.shape[:2], 1e-4), 0, 1e-4
    for _ in range(cfg.epochs):
        rng.shuffle(train)
        for i in range(0, len(train), cfg.batch):
            part = train[i : i + cfg.batch]
            step += 1
            _, df, db, do, dbase, (rows, de) = gradients(m, [words[j] for j in part], y[part], each[y[part]] / len(part))
            for v, g, (a, b) in zip(dense, [*df, *db, do], moments):
                g = g + cfg.decay * v
                a += 0.1 * (g - a)
                b += 0.001 * (g * g - b)
                v -= cfg.rate * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-8)
            base_step += dbase * dbase
            m.base -= 0.1 * dbase / np.sqrt(base_step)
            for t in range(TABLES):
                mine = de[:, t * cfg.dim : (t + 1) * cfg.dim]
                row, back = np.unique(rows[:, t], return_inverse=True)
                g = np.zeros((len(row), cfg.dim))
                np.add.at(g, back, mine)
                g[~used[t][row]] = 0
                squares[t, row] += (g * g).mean(1)
                m.emb[t, row] -= cfg.rate * g / np.sqrt(squares[t, row])[:, None]
    m.emb = m.emb.astype(np.float32).astype(float)
    _calibrate(m, [words[i] for i in held], [langs[i] for i in held], y[held], natural, cfg)
    m.emb = m.emb.astype(np.float32)
    return m


def cut_of(z: np.ndarray, y: np.ndarray, weight: np.ndarray) -> float:
    """The cut with the least weighted errors (label 1 from the cut on), in the middle of the widest gap that has it."""
    by = np.argsort(z, kind="stable")
    z, up = z[by], np.where(y == 1, weight, -weight)[by]
    wrong = np.sum(weight[y == 0]) + np.concatenate([[0], np.cumsum(up)])  # cut before the i-th
    edge = np.concatenate([[z[0] - 2], z, [z[-1] + 2]])
    gap = np.diff(edge)
    best = np.flatnonzero((wrong <= wrong[gap > 0].min() + 1e-12) & (gap > 0))
    i = best[gap[best].argmax()]
    return float((edge[i] + edge[i + 1]) / 2)


def _calibrate(m: ConvModel, words: list[np.ndarray], langs: list[str], y: np.ndarray, natural: tuple[int, int], cfg: ConvConfig) -> None:
    off = np.concatenate([[0], np.cumsum([len(w) for w in words])])
    z = m.odds(np.concatenate(words), off)
    weight = (np.array(natural) / np.maximum(np.bincount(y, minlength=2), 1))[y]
    langs = np.array(langs)
    m.threshold = {"": cut_of(z, y, weight)}
    for lang in sorted(set(langs.tolist())):
        own = langs == lang
        if np.bincount(y[own], minlength=2).min() >= cfg.language_rows:
            m.threshold[lang] = cut_of(z[own], y[own], weight[own])
    far = z - np.array([m.threshold.get(k, m.threshold[""]) for k in langs])
    loss = lambda s: -(weight * np.log(_sigmoid(np.where(y == 1, far, -far) * s) + 1e-12)).sum()
    m.scale = float(min(np.geomspace(0.2, 5, 30), key=loss))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", cfg: ConvConfig = ConvConfig()) -> ConvModel:
    """Model from the rows of ``docs`` whose id has a label; null labels are left out, and of several the greatest counts.

    Without rows of both labels every text has a constant score: the only label seen, or 0."""
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_key")).agg(F.max(label_col).cast("int").alias("_label"))
    known = known.where(F.col("_label").isin(0, 1))
    shares = {r[0]: r[1] for r in known.groupBy("_label").count().collect()}
    chosen, most = bounded_sample_of_each(known, "_key", cfg.sample_rows, "_label", cfg.label_rows)
    rows = docs.select(F.col(id_col).alias("_key"), F.col(text_col).cast("string").alias("_text")).join(F.broadcast(chosen), "_key")
    rows = within_budget(materialize(rows, "toxicity-sample"), "_key", "_text", cfg.sample_chars, "_label")
    buckets = cfg.buckets

    def run(texts: list[str]) -> dict[str, list]:
        tokens = tokens_of(texts)
        words = tokens.buckets(buckets).astype("<i4")
        return {"words": [words[a:b].tobytes() for a, b in zip(tokens.off, tokens.off[1:])], "lang": languages(tokens)}

    got = map_texts(rows, "_label", "_text", run, {"words": "binary", "lang": "string"}).limit(most).collect()
    got = sorted((r[0], bytes(r[1]), r[2]) for r in got)  # the fit doesn't depend on the order of tasks
    words = [np.frombuffer(r[1], "<i4").reshape(-1, TABLES) for r in got]
    return fit(words, [r[2] for r in got], np.array([r[0] for r in got], int), (shares.get(0, 0), shares.get(1, 0)), cfg)


def score(docs: DataFrame, model: ConvModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``score`` in 0..1, ``predicted`` (1 from 0.5 on, which is the language's threshold).

    Null, empty and wordless texts score as no window at all; repeated rows and ids give repeated rows; a text of any
    length is read whole; an empty table gives no rows. Further columns are not read."""
    held: list = []

    def run(texts: list[str]) -> dict[str, np.ndarray]:
        if not held:
            held.append(model.responses())  # once a task
        p = model.scores(texts, held[0])
        return {"score": p, "predicted": (p >= 0.5).astype(np.int32)}

    return map_texts(docs, id_col, text_col, run, {"score": "double", "predicted": "int"})


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text of ``documents``, by a model of the labelled rows whose crc32 of the id leaves no remainder of 0 by 5."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, table(spark, sf_dir, "labels").where(crc_mod("doc_id", 5) != 0))
    return score(docs, model).select("doc_id", (crc_mod("doc_id", 5) == 0).alias("held_out"), "score", "predicted")
