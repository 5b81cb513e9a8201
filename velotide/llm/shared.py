"""Files that tasks write and read in the folder the whole cluster shares."""

from __future__ import annotations

import uuid

import pyarrow.fs as pafs


def located(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a local path or a file:, hdfs:, s3: or gs: address."""
    return pafs.FileSystem.from_uri(uri)


def create_folder(uri: str) -> None:
    fs, path = located(uri)
    fs.create_dir(path, recursive=True)


def new_name(folder: str, stem: str, suffix: str) -> str:
    """A name no other attempt of the same task uses.

    A task that is run again, or twice at once, writes a file of its own.  Only
    the names in the table of finished tasks count, so nothing is overwritten
    and half-written files are never read.
    """
    return f"{folder.rstrip('/')}/{stem}-{uuid.uuid4().hex}{suffix}"


def write_bytes(uri: str, data: bytes) -> None:
    fs, path = located(uri)
    with fs.open_output_stream(path, compression=None) as out:
        out.write(data)


def open_sink(uri: str):
    fs, path = located(uri)
    return fs.open_output_stream(path, compression=None, buffer_size=1 << 20)


def open_source(uri: str):
    """A seekable file; reads fetch only what they ask for."""
    fs, path = located(uri)
    return fs.open_input_file(path)
