"""Files that tasks write to and read from the shared folder, named by URI."""

from __future__ import annotations

import uuid
from contextlib import contextmanager


def _of(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


@contextmanager
def writer(uri: str):
    """A binary stream to `uri`. The file appears under its name when it is whole, so a lost or repeated task leaves none in part."""
    system, path = _of(uri)
    system.create_dir(path.rsplit("/", 1)[0], recursive=True)
    part = f"{path}.{uuid.uuid4().hex}.part"
    with system.open_output_stream(part, compression=None) as out:
        yield out
    system.move(part, path)


def read(uri: str) -> bytes:
    """The bytes as they are stored, whatever the name ends in."""
    system, path = _of(uri)
    with system.open_input_stream(path, compression=None) as f:
        return f.read()


@contextmanager
def opened(uri: str):
    """A random-access stream."""
    system, path = _of(uri)
    with system.open_input_file(path) as f:
        yield f
