"""Files by path or URI, read as streams by one task each."""

from __future__ import annotations

import gzip
import io
from typing import IO


def open_binary(path: str) -> IO[bytes]:
    """A readable stream; names that end in .gz, .bam or .bgz are inflated."""
    if "://" in path and not path.startswith("file://"):
        from pyarrow import fs

        store, inner = fs.FileSystem.from_uri(path)
        raw: IO[bytes] = io.BufferedReader(store.open_input_stream(inner, compression=None))  # type: ignore[arg-type]
    else:
        raw = open(path.removeprefix("file://").removeprefix("file:"), "rb")  # noqa: SIM115
    return gzip.open(raw) if path.endswith((".gz", ".bam", ".bgz")) else raw  # type: ignore[return-value]
