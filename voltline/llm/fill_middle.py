"""Fill-in-the-middle: a document becomes prefix, suffix and middle around two cuts drawn from its id.

The places where a text may be cut (code points, words or lines) are kept as a compressed set of byte offsets: chunks
of 65,536 offsets, each a sorted array, a bitmap or a list of runs, whichever is smallest, with the cumulative
cardinality in front of each chunk. The k-th place is found by a search over the cumulative counts and a local select
in one container, so both cuts come from the offsets alone and the text is copied once, as bytes. One map over the
rows, no shuffle; memory is bounded by the batch and the longest text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltline.llm.common import ARROW, table
from voltline.session import ship_package

CHUNK = 1 << 16
#: Bytes of a bitmap container; an array takes two for each offset, a run container four for each run.
_BITMAP_BYTES = CHUNK // 8


class ArrayContainer:
    def __init__(self, low: np.ndarray):
        self.low = low.astype(np.uint16)

    def select(self, k: int) -> int:
        return int(self.low[k])


class RunContainer:
    """Runs of consecutive offsets: first offset and number of offsets before each."""

    def __init__(self, low: np.ndarray, first: np.ndarray):
        self.start = low[first].astype(np.uint16)
        self.before = first.astype(np.uint32)

    def select(self, k: int) -> int:
        run = int(np.searchsorted(self.before, k, "right")) - 1
        return int(self.start[run]) + k - int(self.before[run])


class BitmapContainer:
    """1,024 words of 64 bits with the number of set bits before each."""

    def __init__(self, low: np.ndarray):
        bits = np.zeros(CHUNK, np.uint8)
        bits[low] = 1
        self.words = np.packbits(bits, bitorder="little").view("<u8")
        counts = np.bitwise_count(self.words).astype(np.uint32)
        self.before = np.cumsum(counts) - counts

    def select(self, k: int) -> int:
        at = int(np.searchsorted(self.before, k, "right")) - 1
        word = int(self.words[at])
        for _ in range(k - int(self.before[at])):
            word &= word - 1  # drop the lowest set bit
        return at * 64 + (word & -word).bit_length() - 1


def container(low: np.ndarray):
    """The smallest of the three forms for the sorted offsets ``low`` of one chunk."""
    first = np.flatnonzero(np.diff(low, prepend=-2) != 1)
    if 4 * len(first) <= min(2 * len(low), _BITMAP_BYTES):
        return RunContainer(low, first)
    return ArrayContainer(low) if 2 * len(low) <= _BITMAP_BYTES else BitmapContainer(low)


class BoundarySet:
    """Sorted distinct offsets with select; ``offsets`` is read chunk by chunk and not kept."""

    def __init__(self, offsets: np.ndarray):
        offsets = np.asarray(offsets, np.int64)
        edge = np.flatnonzero(np.diff(offsets >> 16, prepend=-1))
        self.keys = offsets[edge] >> 16
        self.before = edge.astype(np.int64)
        self.size = len(offsets)
        self.containers = [container(part & (CHUNK - 1)) for part in np.split(offsets, edge[1:])] if self.size else []

    def select(self, k: int) -> int:
        """The k-th offset, from 0."""
        if not 0 <= k < self.size:
            raise IndexError(k)
        at = int(np.searchsorted(self.before, k, "right")) - 1
        return int(self.keys[at]) * CHUNK + self.containers[at].select(k - int(self.before[at]))


_SPACES = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])


def boundaries(data: bytes, unit: str = "char") -> BoundarySet:
    """Byte offsets where UTF-8 ``data`` may be cut, its end included: starts of code points, words or lines (n + 1 places for n units).

    A word is a run without white space together with the space behind it; space at the start joins the first word.
    """
    buf = np.frombuffer(data, np.uint8)
    if unit == "char":
        start = (buf & 0xC0) != 0x80
    elif unit == "word":
        space = _SPACES[buf]
        start = ~space & np.concatenate([[True], space[:-1]])[: len(buf)]
    elif unit == "line":
        start = np.concatenate([[False], buf[:-1] == 10])[: len(buf)]
    else:
        raise ValueError("unit must be 'char', 'word' or 'line'")
    if len(buf) and unit != "char":
        first = np.flatnonzero(start)
        start = start.copy()
        if len(first) and unit == "word":
            start[first[0]] = False
        start[0] = True
    return BoundarySet(np.append(np.flatnonzero(start), len(buf)))


@dataclass(frozen=True)
class MiddleConfig:
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"
    unit: str = "char"
    rate: int = 90  # of 100 documents that are transformed
    spm_rate: int = 20  # of 100 transformed ones that put the suffix first
    salt: str = "1:"  # goes before the decimal id into the hash that draws the cuts

    @property
    def marks(self) -> tuple[bytes, bytes, bytes]:
        return self.prefix.encode(), self.suffix.encode(), self.middle.encode()


def draws(doc_id: int | None, cfg: MiddleConfig = MiddleConfig()) -> tuple[int, int, int, int]:
    """The first four 32-bit numbers of the id's hash; a null id counts as no digits."""
    digest = hashlib.sha256(f"{cfg.salt}{'' if doc_id is None else doc_id}".encode()).digest()
    return tuple(int.from_bytes(digest[i : i + 4], "big") for i in (0, 4, 8, 12))


def transform(doc_id: int | None, data: bytes, cfg: MiddleConfig = MiddleConfig()) -> tuple[int, str, int | None, int | None, bytes]:
    """(units, form, units of the prefix, units of the middle, output). A text that is empty or holds a mark stays plain."""
    h1, h2, h3, h4 = draws(doc_id, cfg)
    places = boundaries(data, cfg.unit)
    n = places.size - 1
    pre, suf, mid = cfg.marks
    if not data or any(m in data for m in cfg.marks) or h3 % 100 >= cfg.rate:
        return n, "plain", None, None, data
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    i, j = places.select(a), places.select(b)
    if h4 % 100 < cfg.spm_rate:
        return n, "spm", a, b - a, b"".join([suf, data[j:], pre, data[:i], mid, data[i:j]])
    return n, "psm", a, b - a, b"".join([pre, data[:i], suf, data[j:], mid, data[i:j]])


def restore(output: bytes, form: str, cfg: MiddleConfig = MiddleConfig()) -> bytes:
    """The text that ``transform`` was given, from its output and form alone."""
    if form == "plain":
        return output
    pre, suf, mid = cfg.marks
    lead, second = (suf, pre) if form == "spm" else (pre, suf)
    first, rest = output[len(lead) :].split(second, 1)
    last, middle = rest.split(mid, 1)
    return last + middle + first if form == "spm" else first + middle + last


FIELDS = {"n": "long", "form": "string", "prefix_units": "long", "middle_units": "long", "output": "binary", "restored": "binary"}


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", cfg: MiddleConfig = MiddleConfig(), digests: bool = False) -> DataFrame:
    """One row per input row: units ``n``, ``form`` (plain, psm, spm), ``prefix_units``, ``middle_units`` (null if plain), ``output``.

    A null text counts as empty and stays plain; a null id draws from no digits. Rows of the same id and text (repeats)
    give equal rows, rows of one id draw the same numbers. Any length of text is cut whole; an empty table gives no
    rows. Further columns are not read, so their names may clash. With ``digests`` the output and the text restored
    from it are given as SHA-256 instead, so that no text leaves the task.
    """
    ship_package(docs.sparkSession)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    src = docs.select(F.col(id_col).alias("_id"), text.alias("_text"))
    fields = {k: v for k, v in FIELDS.items() if k not in ("output", "restored")}
    fields |= {"output_sha256": "string", "restored_sha256": "string"} if digests else {"output": "binary"}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for i, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                *facts, out = transform(i, data, cfg)
                if digests:
                    rows.append((*facts, hashlib.sha256(out).hexdigest(), hashlib.sha256(restore(out, facts[1], cfg)).hexdigest()))
                else:
                    rows.append((*facts, out))
            cols = [pa.array([r[k] for r in rows], ARROW[t]) for k, t in enumerate(fields.values())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *cols], names=[id_col, *fields])

    schema = ", ".join(f"`{k}` {v}" for k, v in [(id_col, src.schema["_id"].dataType.simpleString()), *fields.items()])
    out = src.mapInArrow(run, schema)
    return out if digests else out.withColumn("output", F.col("output").cast("string"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text of ``documents`` with production marks and rates; one row per document, as ``fill_in_middle`` states."""
    rows = fill_in_middle(table(spark, sf_dir, "documents"), digests=True)
    return rows.select("doc_id", "n", "form", F.col("prefix_units").alias("prefix_chars"), F.col("middle_units").alias("middle_chars"), "output_sha256", "restored_sha256")


def oracle(cfg: MiddleConfig = MiddleConfig()) -> str:
    """DuckDB SQL of ``op12_fill_in_middle``."""
    p, s, m = cfg.prefix, cfg.suffix, cfg.middle
    draw = ", ".join(f"CAST('0x' || substr(h, {8 * k + 1}, 8) AS BIGINT) AS h{k + 1}" for k in range(4))
    holds = " OR ".join(f"contains(t, '{x}')" for x in (p, s, m))
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256('{cfg.salt}' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
     r AS (SELECT doc_id, t, n, {draw} FROM d),
     c AS (SELECT doc_id, t, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
                  CASE WHEN t = '' OR {holds} OR h3 % 100 >= {cfg.rate} THEN 'plain' WHEN h4 % 100 < {cfg.spm_rate} THEN 'spm' ELSE 'psm' END AS form FROM r),
     x AS (SELECT doc_id, t, n, form, a, b, substr(t, 1, a) AS pre, substr(t, a + 1, b - a) AS mid, substr(t, b + 1) AS suf FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'spm' THEN '{s}' || suf || '{p}' || pre || '{m}' || mid ELSE '{p}' || pre || '{s}' || suf || '{m}' || mid END) AS output_sha256,
       sha256(t) AS restored_sha256 FROM x"""
