"""Binary files in the shared folder, from inside tasks."""

from __future__ import annotations

import os
import uuid

from pyarrow import fs


def place(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it. ``file:`` and bare paths are the shared mount."""
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if "://" not in uri:
        return fs.LocalFileSystem(), os.path.abspath(uri)
    return fs.FileSystem.from_uri(uri)


class Replacing:
    """A file that appears under its name only when complete, so that a lost or repeated task leaves no half file."""

    def __init__(self, folder: str, name: str):
        self.fs, root = place(folder)
        self.fs.create_dir(root, recursive=True)
        self.final, self.temp = f"{root}/{name}", f"{root}/.{name}.{uuid.uuid4().hex}"

    def __enter__(self):
        self.out = self.fs.open_output_stream(self.temp)
        return self.out

    def __exit__(self, kind, value, trace):
        self.out.close()
        if kind is None:
            self.fs.move(self.temp, self.final)
        else:
            self.fs.delete_file(self.temp)


def opened(uri: str):
    """A file for random reads."""
    file_system, path = place(uri)
    return file_system.open_input_file(path)
