"""Archives pruned by name, members streamed in chunks of lines."""

import io
import os
import random
import re
import tempfile
import zipfile

from pyspark.sql import functions as F

from voltline.functions.text import drop_invalid_utf8
from voltline.sources import members as M
from voltline.sources.archives import archive_paths, member_lines, expand_archives, read_archives


def _zip(entries):
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for name, data in entries:
            z.writestr(name, data)
    return buf.getvalue()


def _drop(files):
    d = tempfile.mkdtemp(prefix="run-")
    for name, data in files.items():
        os.makedirs(os.path.dirname(f"{d}/{name}"), exist_ok=True)
        with open(f"{d}/{name}", "wb") as f:
            f.write(data)
    return d


def test_lines_of_a_stream_against_a_split(monkeypatch):
    rng = random.Random(4)
    for piece in (1, 2, 7, 1 << 20):
        monkeypatch.setattr(M, "_PIECE", piece)
        for _ in range(400):
            data = "".join(rng.choice(["a", "bc", "\n", "\r", "\r\n", "é"]) for _ in range(rng.choice([0, 1, 3, 12]))).encode()
            want = re.split(rb"\r\n|\r|\n", re.sub(rb"(\r\n|\r|\n)\Z", b"", data))
            got = list(M.line_chunks(io.BytesIO(data), rng.choice([1, 4, 100])))
            assert [x for c in got for x in c] == want, data


def test_chunks_hold_the_same_lines_as_whole_members(spark):
    deep = _zip([("in/a.csv", "1\r\n2\n3"), ("more.zip", _zip([("b.CSV", "x\n" * 500), ("skip.txt", "no")]))])
    d = _drop({"one.zip": _zip([("a.csv", "1\n2\n"), ("empty.csv", ""), ("dir/", ""), ("z.zip", deep), ("c.csv", b"\xff\xfe,1\rlast")]),
               "sub/%23 two.ZIP": _zip([(f"m{i}.csv", f"{i}\n" * i) for i in range(40)]), "none.zip": _zip([])})
    key = lambda df: sorted((r.source_file[len(d):], r.file_name, r.block_start + r.line_id, r.value) for r in df.collect())
    whole = key(member_lines(expand_archives(read_archives(spark, d))))  # invalid bytes are dropped there already
    for chunk, bundle in ((1 << 20, 1 << 26), (8, 30)):
        chunks = M.member_chunks(archive_paths(spark, d), chunk_bytes=chunk, bundle_bytes=bundle)
        assert key(M.chunk_lines(chunks).withColumn("value", drop_invalid_utf8("value"))) == whole
        assert M.failed_chunks(chunks).count() == 0
    last = M.chunk_lines(M.member_chunks(archive_paths(spark, d), chunk_bytes=4)).filter("file_name = 'c.csv'").orderBy("block_start", "line_id")
    assert [bytes(r[0]) for r in last.select(F.col("value").cast("binary")).collect()] == [b"\xff\xfe,1", b"last"]


def test_damage_gives_an_error_and_no_lines(spark):
    good = _zip([("a.csv", "1\n2\n"), ("big.csv", "".join(f"{i},{i * i}\n" for i in range(20_000)))])
    with zipfile.ZipFile(io.BytesIO(good)) as z:
        at = z.getinfo("big.csv").header_offset
    hurt = bytearray(good)
    hurt[at + 20_000] ^= 0xFF
    d = _drop({"hurt.zip": bytes(hurt), "no.zip": b"not a zip", "in.zip": _zip([("x.zip", b"junk"), ("ok.csv", "7")])})
    from voltline.session import materialize

    chunks = materialize(M.member_chunks(archive_paths(spark, d), chunk_bytes=1000), "chunks")
    assert {r.file_name: r.value for r in M.chunk_lines(chunks).filter("line_id = 0 and block_start = 0").collect()} == {"a.csv": "1", "ok.csv": "7"}
    bad = {(r.file_name, r.reason.split(":")[0]) for r in M.failed_chunks(chunks).collect()}
    assert bad == {("big.csv", "bad member"), ("no.zip", "bad archive"), ("x.zip", "bad archive")}


def test_a_member_beyond_the_bound_is_streamed_with_flat_memory():
    import tracemalloc

    d = _drop({"big.zip": _zip([("big.csv", b"D,A,B,1,0123456789\n" * 4_000_000)])})  # 76 MB unpacked
    tracemalloc.start()
    n = most = 0
    with M._open(f"{d}/big.zip") as f, zipfile.ZipFile(f) as zf:
        for _, _, first, lines, error in M._walk(zf, M._files(zf), "", 1, ".csv", 1 << 20):
            assert error is None and first == n
            n += len(lines)
            most = max(most, tracemalloc.get_traced_memory()[1])
    tracemalloc.stop()
    assert n == 4_000_000 and most < 24 << 20


def rows_read(df):
    """Rows that the file scans of an executed frame gave."""
    df.collect()
    todo, total = [df._jdf.queryExecution().executedPlan()], 0
    while todo:
        node = todo.pop()
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
            continue
        if node.getClass().getSimpleName() == "FileSourceScanExec":
            total += node.metrics().apply("numOutputRows").value()
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return total


def test_archives_outside_the_window_are_never_read(spark):
    from voltline.plans.acquire import extract_folder, extract_window

    d = _drop({f"PUBLIC_DVD_X_{2020 + i // 12}{i % 12 + 1:02d}010000.zip": _zip([("a.csv", str(i))]) for i in range(60)} | {"LATEST %23.zip": _zip([("a.csv", "u")])})
    got = extract_folder(spark, d, 2023, 2023, [2, 3])
    assert sorted(bytes(r.content) for r in got.collect()) == [b"37", b"38", b"u"]
    assert rows_read(read_archives(spark, d, file_filter=extract_window(2023, 2023, [2, 3]))) == 3
    assert rows_read(read_archives(spark, d)) == 61
    assert archive_paths(spark, d, file_filter=extract_window(2023, 2023, [2, 3])).count() == 3
