import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from voltline.session import local_session

    s = local_session(master="local[4]", shuffle_partitions=4)
    yield s


def lines_frame(spark, files: dict[str, str]):
    """Lines frame from {file_name: text} (universal newlines, order kept)."""
    rows = []
    for name, text in files.items():
        for i, line in enumerate(text.splitlines()):
            rows.append((f"inbox/{name}", name, 0, i, line))
    return spark.createDataFrame(rows, "source_file string, file_name string, block_start bigint, line_id bigint, value string")


@pytest.fixture
def make_lines(spark):
    return lambda files: lines_frame(spark, files)
