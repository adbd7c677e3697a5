"""Files that tasks write to and read from the shared folder, whatever store it is in."""

from __future__ import annotations

import os
import tempfile
import uuid

import numpy as np
from pyarrow import fs


def store(uri: str):
    """File system and path of a URI or an absolute path, through Arrow's file systems."""
    return fs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri}") if not uri.startswith("file:/") else (
        fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/"))


def unique_name(folder: str, name: str) -> str:
    """A path no other attempt of the same task uses: what a lost attempt leaves is never read."""
    return f"{folder}/{name}-{uuid.uuid4().hex[:12]}"


def write_arrays(uri: str, *arrays: np.ndarray) -> None:
    """The arrays one after the other as raw little-endian values."""
    system, path = store(uri)
    system.create_dir(path.rpartition("/")[0], recursive=True)
    with system.open_output_stream(path, compression=None) as out:
        for a in arrays:
            out.write(np.ascontiguousarray(a).data.cast("B") if a.nbytes else b"")


_MAPPED: dict[str, np.ndarray] = {}


def mapped_bytes(uri: str) -> np.ndarray:
    """The file's bytes, memory-mapped once per worker. A file in a remote store is first copied to a
    temporary file without a name, which goes when the worker ends."""
    if uri not in _MAPPED:
        system, path = store(uri)
        if isinstance(system, fs.LocalFileSystem):
            _MAPPED[uri] = np.memmap(path, np.uint8, "r") if os.path.getsize(path) else np.zeros(0, np.uint8)
        else:
            with tempfile.TemporaryFile() as copy, system.open_input_stream(path, compression=None) as source:
                while chunk := source.read(8 << 20):
                    copy.write(chunk)
                copy.flush()
                _MAPPED[uri] = np.memmap(copy, np.uint8, "r") if copy.tell() else np.zeros(0, np.uint8)
    return _MAPPED[uri]


def mapped_arrays(uri: str, n: int, *kinds: str) -> list[np.ndarray]:
    """Views of the arrays of ``n`` values each that ``write_arrays`` wrote."""
    raw, out, at = mapped_bytes(uri), [], 0
    for kind in kinds:
        size = n * np.dtype(kind).itemsize
        out.append(raw[at: at + size].view(kind))
        at += size
    return out
