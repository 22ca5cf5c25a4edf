"""Binary files in the shared folder, by URI, from inside tasks."""

from __future__ import annotations

import uuid

from pyarrow import fs


def write_file(folder: str, name: str, parts: list[bytes], suffix: str = "") -> str:
    """Write a new file (a fresh name per attempt, so a retried task never touches another's) and return its URI."""
    system, path = fs.FileSystem.from_uri(folder)
    system.create_dir(path, recursive=True)
    name = f"{name}-{uuid.uuid4().hex}{suffix}"
    with system.open_output_stream(f"{path}/{name}", compression=None) as out:
        for part in parts:
            out.write(part)
    return f"{folder}/{name}"


def read_file(uri: str) -> bytes:
    system, path = fs.FileSystem.from_uri(uri)
    with system.open_input_file(path) as source:
        return source.read()
