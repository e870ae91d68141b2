"""Files of the data's own store, opened by tasks: first lines, and files to read at any place.

Tasks open paths through Arrow's file systems. A store that only Spark can open is told by
``Unreadable``; callers then let Spark read.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle

# Tasks get the code of this module with the plan, so workers need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK_BYTES = 16 << 10


class Unreadable(Exception):
    """No file system for the path outside Spark."""


def open_path(path: str) -> pa.NativeFile:
    """The file of a plain path, or of a path as Spark lists it, its characters not escaped."""
    found = re.match(r"([A-Za-z][A-Za-z0-9+.-]*):(//[^/]*)?(/.*)$", path)
    try:
        if not found or found[1].lower() == "file":
            return fs.LocalFileSystem().open_input_file(found[3] if found else path)
        store, root = fs.FileSystem.from_uri(f"{found[1]}:{found[2] or '//'}/")
        return store.open_input_file(root.rstrip("/") + found[3])
    except FileNotFoundError:
        raise
    except (OSError, ImportError, pa.ArrowException) as error:
        raise Unreadable(path) from error


def first_line(stream: BinaryIO, block_bytes: int = BLOCK_BYTES) -> str | None:
    """The first line that is not blank, as Spark takes it for a header; no more than a block is read behind it."""
    held = b""
    while True:
        block = stream.read(block_bytes)
        *lines, held = re.split(rb"\r\n|\n|\r", held + block)
        if not block:
            lines.append(held)
        for line in lines:
            text = line.decode("utf-8", "replace").removeprefix("﻿")
            if text.strip():
                return text
        if not block:
            return None


def add_first_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with ``one``, the path of a file, and ``wanted``: fills in ``header`` and ``readable``."""
    for batch in batches:
        headers, readable = [], []
        for path, wanted in zip(batch.column("one").to_pylist(), batch.column("wanted").to_pylist(), strict=True):
            header, known = None, True
            if wanted:
                try:
                    with open_path(path) as file:
                        header = first_line(file)
                except Unreadable:
                    known = False
            headers.append(header)
            readable.append(known)
        for name, values, kind in (("header", headers, pa.string()), ("readable", readable, pa.bool_())):
            batch = batch.set_column(batch.schema.get_field_index(name), name, pa.array(values, kind))
        yield batch
