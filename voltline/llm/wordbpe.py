"""Token ids of whole texts by a word-end BPE vocabulary, encoded once per distinct word.

The vocabulary's rules work between ASCII white space only, so a text's ids are its words' ids in a row. Words of
plain Latin letters, digits and ASCII signs go through one merge call for all new words of a block; every other
word goes through the tokenizer itself, word by word. Seen words are kept in a table of bounded size.
"""

from __future__ import annotations

import json
import re
from functools import cache

import numpy as np
import tiktoken
from tokenizers import Tokenizer

#: Words that a Python worker keeps with their ids.
CACHE_WORDS = 400_000
_PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
_PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-z0-9ß-öø-ÿ]+")
#: What the quick way relies on; with other settings every word takes the tokenizer's own way.
_EXPECTED = {
    "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}],
    "split": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+",
}
_END = "</w>"


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies write for bytes: printable ones for themselves, the rest from U+0100 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class _Kept(dict):
    """Ids of words; a word beyond the kept ones is looked up in ``extra``."""

    extra: dict[bytes, bytes] = {}

    def __missing__(self, word: bytes) -> bytes:
        return self.extra[word]


class WordEncoder:
    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.kept = _Kept()
        self.merge, self.ids = self._merger(spec)

    def _merger(self, spec: dict) -> tuple[tiktoken.Encoding | None, np.ndarray]:
        """The merges as byte ranks; the word end is byte 0, which joins the last byte before any other merge."""
        model = spec["model"]
        known = (
            model.get("end_of_word_suffix") == _END and (spec.get("normalizer") or {}).get("normalizers") == _EXPECTED["normalizers"]
            and ((spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0].get("pattern") == {"Regex": _EXPECTED["split"]}
        )
        if not known:
            return None, np.empty(0, np.uint32)
        letters = byte_letters()

        def raw(token: str) -> bytes:
            body = token.removesuffix(_END)
            return bytes(letters[c] for c in body) + b"\0" * (body != token)

        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        tokens = [*letters, *(c + _END for c in letters), *(a + b for a, b in pairs)]
        ranks: dict[bytes, int] = {}
        for i, t in enumerate(tokens):
            ranks.setdefault(raw(t), i)
        if len(ranks) != len(tokens) or any(t not in model["vocab"] for t in tokens):
            return None, np.empty(0, np.uint32)
        ids = np.array([model["vocab"][t] for t in tokens], np.uint32)
        self.newline = ranks[b"\n"]
        return tiktoken.Encoding("words", pat_str=r"[^\x00\n]+\x00|\n", mergeable_ranks=ranks, special_tokens={}), ids

    def _encode(self, words: list[bytes]) -> dict[bytes, bytes]:
        out: dict[bytes, bytes] = {}
        quick, slow = [], []
        for w in words:
            t = w.decode()
            (quick if self.merge and _PLAIN.fullmatch(t) and "<|" not in t else slow).append((w, t))
        if quick:
            marked = _PARTS.sub("\\g<0>\0", "\n".join(t for _, t in quick).lower())
            ranks = np.array(self.merge.encode_ordinary(marked), np.int64)
            cuts = np.flatnonzero(ranks == self.newline)
            raw = self.ids[ranks].astype("<u4").tobytes()
            starts, ends = [0, *(4 * (cuts + 1)).tolist()], [*(4 * cuts).tolist(), len(raw)]
            out.update((w, raw[s:e]) for (w, _), s, e in zip(quick, starts, ends))
        if slow:
            got = self.tokenizer.encode_batch_fast([t for _, t in slow], add_special_tokens=False)
            out.update((w, np.array(g.ids, "<u4").tobytes()) for (w, _), g in zip(slow, got))
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit numbers."""
        split = [t.encode().split() for t in texts]
        new = self._encode([w for w in set().union(*split) if w not in self.kept])
        room = CACHE_WORDS - len(self.kept)
        if len(new) <= room:
            self.kept.update(new)
            self.kept.extra = {}
        else:
            self.kept.extra = new
        return [b"".join(map(self.kept.__getitem__, ws)) for ws in split]


@cache
def encoder(path: str | None = None) -> WordEncoder:
    """One encoder for each Python worker."""
    return WordEncoder(path or default_path())
