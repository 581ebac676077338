"""Files in the folder that all executors share, by any address that pyarrow.fs can open."""

from __future__ import annotations

import uuid

from pyarrow import fs


def open_file(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


class Publish:
    """An output stream that gets its name when it is closed without an error."""

    def __init__(self, uri: str):
        self.fs, self.path = open_file(uri)
        self.draft = f"{self.path}.{uuid.uuid4().hex}.draft"

    def __enter__(self):
        self.fs.create_dir(self.path.rpartition("/")[0], recursive=True)
        self.stream = self.fs.open_output_stream(self.draft, compression=None)
        return self.stream

    def __exit__(self, kind, *_):
        self.stream.close()
        if kind is None:
            self.fs.move(self.draft, self.path)
        else:
            self.fs.delete_file(self.draft)
