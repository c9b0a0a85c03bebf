"""Numpy arrays as files in the shared folder, memory-mapped by the workers that read them."""

from __future__ import annotations

import os
import tempfile
import uuid
from urllib.parse import unquote, urlparse

import numpy as np

_open: dict[str, np.ndarray] = {}
#: Fetched copies of files in a store that cannot be mapped: at most so many bytes at a time in one worker.
MOST_FETCHED = 1 << 30
_fetched: dict[str, int] = {}


def _local(uri: str) -> str | None:
    parts = urlparse(uri)
    return unquote(parts.path) if parts.scheme == "file" else uri if not parts.scheme else None


def _system(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def save(uri: str, array: np.ndarray) -> None:
    """Write the array's bytes under a new name, then rename it: a task that runs twice leaves one whole file."""
    path, data = _local(uri), np.ascontiguousarray(array)
    if path is not None:
        os.makedirs(os.path.dirname(path), exist_ok=True)
        spare = f"{path}.{uuid.uuid4().hex}"
        data.tofile(spare)
        os.replace(spare, path)
        return
    system, path = _system(uri)
    spare = f"{path}.{uuid.uuid4().hex}"
    system.create_dir(os.path.dirname(path), recursive=True)
    with system.open_output_stream(spare) as out:
        out.write(memoryview(data).cast("B"))
    system.move(spare, path)


def mapped(uri: str, dtype) -> np.ndarray:
    """The array of a file that `save` has written, memory-mapped and kept open.

    Where the shared folder is mounted (file://), the file itself is mapped. From any other store it is first copied to
    a nameless file of this worker, which the system removes when it is closed.
    """
    if uri in _open:
        return _open[uri]
    path = _local(uri)
    if path is not None:
        found = np.memmap(path, dtype, "r") if os.path.getsize(path) else np.zeros(0, dtype)
    else:
        system, inner = _system(uri)
        spool, size = tempfile.TemporaryFile(), 0  # noqa: SIM115
        with system.open_input_stream(inner) as source:
            while part := source.read(1 << 22):
                size += spool.write(part)
        spool.flush()
        while _fetched and sum(_fetched.values()) + size > MOST_FETCHED:
            oldest = next(iter(_fetched))
            del _open[oldest], _fetched[oldest]
        _fetched[uri] = size
        found = np.memmap(spool, dtype, "r") if size else np.zeros(0, dtype)
    _open[uri] = found
    return found
