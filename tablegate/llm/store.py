"""Arrays in a folder that driver and executors share, memory-mapped where they are read."""

from __future__ import annotations

import os
import tempfile
import uuid
from urllib.parse import urlsplit

import numpy as np


def _local(uri: str) -> str | None:
    parts = urlsplit(uri)
    return parts.path if parts.scheme in ("", "file") else None


def write_array(folder: str, name: str, values: np.ndarray) -> None:
    """Writes whole or not at all: a task that is run again replaces its file."""
    path = _local(folder)
    data = np.ascontiguousarray(values)
    if path is None:
        from pyarrow.fs import FileSystem

        system, base = FileSystem.from_uri(folder)
        with system.open_output_stream(f"{base}/{name}") as out:
            out.write(data)
        return
    os.makedirs(path, exist_ok=True)
    part = f"{path}/.{name}-{uuid.uuid4().hex}"
    data.tofile(part)
    os.replace(part, f"{path}/{name}")


def open_array(folder: str, name: str, kind: str) -> np.ndarray:
    """The array as a read-only memory map.

    Where the folder is no mounted one, the file is copied to an unnamed local one, which
    is gone with the process.
    """
    path = _local(folder)
    if path is not None:
        size = os.path.getsize(f"{path}/{name}")
        return np.memmap(f"{path}/{name}", kind, "r") if size else np.zeros(0, kind)
    from pyarrow.fs import FileSystem

    system, base = FileSystem.from_uri(folder)
    with tempfile.TemporaryFile() as copy, system.open_input_stream(f"{base}/{name}") as source:
        while block := source.read(1 << 24):
            copy.write(block)
        copy.flush()
        size = copy.tell()
        return np.memmap(copy, kind, "r") if size else np.zeros(0, kind)


# Counts are small but for a few: one byte each, and the others beside them.
_MORE = 255


def write_counts(folder: str, name: str, values: np.ndarray) -> None:
    """Counts as bytes, with the places and values of those that need more."""
    values = np.asarray(values, np.int64)
    large = np.flatnonzero(values >= _MORE)
    write_array(folder, name, np.minimum(values, _MORE).astype(np.uint8))
    write_array(folder, f"{name}-large", np.stack([large, values[large]]).astype("<i8"))


class Counts:
    """Memory-mapped counts of :func:`write_counts`."""

    def __init__(self, folder: str, name: str):
        self.bytes = open_array(folder, name, "u1")
        self.places, self.values = open_array(folder, f"{name}-large", "<i8").reshape(2, -1)

    def __len__(self) -> int:
        return len(self.bytes)

    def __getitem__(self, at: np.ndarray) -> np.ndarray:
        out = self.bytes[at].astype(np.int64)
        more = np.flatnonzero(out == _MORE)
        if len(more):
            out[more] = self.values[np.searchsorted(self.places, at[more])]
        return out

    def all(self) -> np.ndarray:
        out = self.bytes.astype(np.int64)
        out[self.places] = self.values
        return out
