"""Plain binary files in the shared folder, on any store Arrow can reach."""

from __future__ import annotations

import uuid

from pyarrow import fs as pafs


def store(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a URI or of a local path."""
    return pafs.FileSystem.from_uri(path if "://" in path else "file://" + path)


class AtomicFile:
    """Write under a private name; only a finished file gets the real one.

    A task that is tried again, or runs twice, replaces the file with the same
    bytes.
    """

    def __init__(self, folder: str, name: str):
        self.fs, root = store(folder)
        self.fs.create_dir(root, recursive=True)
        self.final = f"{root}/{name}"
        self.private = f"{root}/.{name}.{uuid.uuid4().hex}"
        self.out = self.fs.open_output_stream(self.private)
        self.at = 0

    def write(self, data: bytes) -> int:
        """Append and return the offset at which ``data`` starts."""
        start, self.at = self.at, self.at + len(data)
        self.out.write(data)
        return start

    def close(self) -> None:
        self.out.close()
        self.fs.move(self.private, self.final)
