"""Opening files in the shared folder from inside tasks, on any file system."""

from __future__ import annotations

import re

import pyarrow as pa
from pyarrow import fs


def located(uri: str) -> tuple[fs.FileSystem, str]:
    if not re.match(r"[a-zA-Z][a-zA-Z0-9+.-]*:", uri):
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))


def make_folder(uri: str) -> None:
    system, path = located(uri)
    system.create_dir(path, recursive=True)


def open_output(uri: str) -> pa.NativeFile:
    system, path = located(uri)
    return system.open_output_stream(path)


def open_input(uri: str) -> pa.NativeFile:
    system, path = located(uri)
    return system.open_input_file(path)


def rename(old: str, new: str) -> None:
    system, path = located(old)
    system.move(path, located(new)[1])
