from __future__ import annotations

import struct
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from lakeward.session import build_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "lakeward-tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def rows_of(df):
    """Rows as sorted tuples, for comparisons that ignore order."""
    return sorted((tuple(r) for r in df.collect()), key=repr)


def dbf_bytes(fields, records, deleted=(), encoding="latin-1"):
    """A dBASE table: fields are (name, type, width), records lists of text."""
    width = 1 + sum(w for _, _, w in fields)
    head = struct.pack("<BBBBIHH20x", 3, 124, 1, 1, len(records), 33 + 32 * len(fields), width)
    for name, kind, size in fields:
        head += name.encode(encoding).ljust(11, b"\x00")[:11] + kind.encode() + bytes(4) + bytes([size, 0]) + bytes(14)
    body = b""
    for i, record in enumerate(records):
        body += b"*" if i in deleted else b" "
        for (_, _, size), cell in zip(fields, record):
            body += cell.encode(encoding).ljust(size)[:size]
    return head + b"\r" + body + b"\x1a"


def plan_of(df) -> str:
    return df._jdf.queryExecution().toString()
