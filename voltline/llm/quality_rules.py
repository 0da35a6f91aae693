"""Quality rules by suffix-array repetition (numpy inside Spark tasks).

Each task sorts the word suffixes of its texts by prefix doubling (only suffixes that still tie are sorted again),
reads the longest common prefix of neighbours from the doubling ranks, and takes for each position the depth of
its deepest LCP interval: the longest substring starting there that occurs twice. The spans of these maximal
repeats are united; a text fails when the united spans cover too much of it or one repeat is too long.
Work is per text, so there is no shuffle and no state between texts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from voltline.llm.common import keep_texts, map_texts, table
from voltline.llm.textarrays import mix, segment_hashes, words_of


@dataclass(frozen=True)
class RepetitionLimits:
    min_repeat: int = 10  # words of a repeat whose span counts as covered
    max_covered: float = 0.4  # covered words / all words
    max_longest: float = 0.25  # longest repeat / all words ...
    long_repeat: int = 40  # ... when it has more words than this
    min_words: int = 50  # base rule: fewer words fail
    max_window_share: float = 0.5  # base rule: share of words in repeated 3-word windows


SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
FIELDS = {
    "n_words": "long", "word_chars": "long", "n_symbols": "long", "n_dup_lines": "long", "n_repeat_words": "long",
    "base_failed": "boolean", "kept": "boolean", "covered_words": "long", "longest_repeat": "long", "repeat_spans": "string",
}


def _dense(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rank of each key, as the place of its first equal in sorted order; the sorted order)."""
    order = np.argsort(keys, kind="stable")
    s = keys[order]
    first = np.concatenate([[True], s[1:] != s[:-1]])
    at = np.maximum.accumulate(np.where(first, np.arange(len(s)), 0))
    rank = np.empty(len(s), np.int64)
    rank[order] = at
    return rank, order


def doubling_ranks(symbols: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """(suffix array, ranks by the first 2^k symbols for k = 0, 1, ...).

    ``left``: symbols from each position to the end of its text; texts must not share symbols.
    """
    n = len(symbols)
    rank, order = _dense(symbols)
    levels, k = [rank.astype(np.int32)], 1
    while True:
        size = np.bincount(rank, minlength=n)
        active = order[size[rank[order]] > 1]  # in rank order
        if not len(active):
            return order, levels
        nxt = np.where(left[active] > k, rank[np.minimum(active + k, n - 1)] + 1, 0)
        key = rank[active] * (n + 1) + nxt
        by = np.argsort(key, kind="stable")
        moved, key = active[by], key[by]
        old = rank[moved]
        at = np.arange(len(moved))
        run = np.maximum.accumulate(np.where(np.concatenate([[True], old[1:] != old[:-1]]), at, 0))
        group = np.maximum.accumulate(np.where(np.concatenate([[True], key[1:] != key[:-1]]), at, 0))
        rank, order = rank.copy(), order.copy()
        order[old + at - run] = moved
        rank[moved] = old + group - run
        levels.append(rank.astype(np.int32))
        k *= 2


def longest_repeats(symbols: np.ndarray, left: np.ndarray) -> np.ndarray:
    """For each position, the length of the longest substring starting there that starts elsewhere in its text too."""
    n = len(symbols)
    if n < 2:
        return np.zeros(n, np.int64)
    order, levels = doubling_ranks(symbols, left)
    a, b = order[:-1], order[1:]
    lcp = np.zeros(n - 1, np.int64)
    for k in range(len(levels) - 1, -1, -1):
        r = np.append(levels.pop(), np.int32(-1))
        same = r[np.minimum(a + lcp, n)] == r[np.minimum(b + lcp, n)]
        lcp += same.astype(np.int64) << k
    best = np.zeros(n, np.int64)
    best[order] = np.maximum(np.append(lcp, 0), np.append(0, lcp))
    return best


def _united(starts: np.ndarray, lengths: np.ndarray, n: int) -> np.ndarray:
    """Whether each of n positions lies in a span."""
    d = np.bincount(starts, minlength=n + 1) - np.bincount(starts + lengths, minlength=n + 1)
    return np.cumsum(d[:n]) > 0


def measure(texts: list[str], lim: RepetitionLimits) -> dict[str, list]:
    """The base counts and the repetition verdict of each text."""
    w = words_of(texts)
    n, docs = len(w.hash), w.n_docs
    counts, off = w.count(), w.offsets()
    left = off[1:][w.doc] - np.arange(n)
    newline = w.buf == 10
    space = (w.buf == 32) | ((w.buf >= 9) & (w.buf <= 13))
    word_chars = w.per_doc(~space & ((w.buf & 0xC0) != 0x80))
    n_symbols = w.per_doc(SYMBOLS[w.buf])
    # lines with a word, equal to an earlier one of the same text
    stops = np.flatnonzero(newline)
    begins = np.concatenate([[0], stops[:-1] + 1])
    filled = np.concatenate([[0], np.cumsum(~space)])
    has = filled[stops] > filled[begins]
    begins, stops = begins[has], stops[has]
    line_doc = np.searchsorted(w.bounds, begins, "right") - 1
    line_key = mix(segment_hashes(w.buf, begins, stops) + mix(line_doc.astype(np.uint64)))
    n_dup = np.zeros(docs, np.int64)
    if len(line_key):
        _, first = np.unique(line_key, return_index=True)
        n_dup = np.bincount(line_doc, minlength=docs) - np.bincount(line_doc[first], minlength=docs)
    # words as symbols of their text
    symbols = mix(w.hash + mix(w.doc.astype(np.uint64)))
    in_window = np.zeros(n, bool)
    triple = np.flatnonzero(left >= 3)
    if len(triple):
        key = mix(symbols[triple]) + np.uint64(3) * mix(symbols[triple + 1] + np.uint64(1)) + np.uint64(7) * mix(symbols[triple + 2] + np.uint64(2))
        _, inv, cnt = np.unique(key, return_inverse=True, return_counts=True)
        twice = triple[cnt[inv] > 1]
        for j in range(3):
            in_window[twice + j] = True
    n_repeat = np.bincount(w.doc[in_window], minlength=docs)
    best = longest_repeats(symbols, left)
    longest = np.zeros(docs, np.int64)
    np.maximum.at(longest, w.doc, best)
    long_at = np.flatnonzero(best >= lim.min_repeat)
    cover = _united(long_at, best[long_at], n)
    covered = np.bincount(w.doc[cover], minlength=docs)
    edges = np.flatnonzero(np.diff(np.concatenate([[0], cover.astype(np.int8), [0]])))
    spans: list[list[str]] = [[] for _ in texts]
    for s, e in zip(edges[::2].tolist(), edges[1::2].tolist()):
        while s < e:  # spans of neighbouring texts may touch
            d = int(w.doc[s])
            stop = min(e, int(off[d + 1]))
            spans[d].append(f"{s - off[d]}:{stop - off[d]}")
            s = stop
    base_failed = (counts < lim.min_words) | (n_repeat > lim.max_window_share * counts)
    bad = (covered > lim.max_covered * counts) | ((longest > lim.long_repeat) & (longest > lim.max_longest * counts))
    return {
        "n_words": counts, "word_chars": word_chars, "n_symbols": n_symbols, "n_dup_lines": n_dup, "n_repeat_words": n_repeat,
        "base_failed": base_failed, "kept": ~base_failed & ~bad, "covered_words": covered, "longest_repeat": longest,
        "repeat_spans": [",".join(s) for s in spans],
    }


def repetition_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limits: RepetitionLimits = RepetitionLimits()) -> DataFrame:
    """One row per input row: base counts, united repeat spans (word offsets, end exclusive), ``kept``.

    Null and empty texts have no words and so fail the base rule; repeated rows and null ids each give their own
    row; an empty table gives an empty result. Texts of any length are judged whole.
    """
    return map_texts(docs, id_col, text_col, lambda t: measure(t, limits), FIELDS)


def keep_regular(docs: DataFrame, text_col: str = "text", limits: RepetitionLimits = RepetitionLimits()) -> DataFrame:
    """The rows of ``docs`` that the rules keep, all columns unchanged."""
    return keep_texts(docs, text_col, lambda t: measure(t, limits)["kept"])


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``repetition_rules`` of every whole text of ``documents``, with the production limits."""
    return repetition_rules(table(spark, sf_dir, "documents"))
