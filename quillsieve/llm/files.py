"""Files that tasks write and read by themselves, in any file system Arrow knows."""

from __future__ import annotations

import uuid

from pyarrow import fs
from pyspark import TaskContext


def opened(folder: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder given as a path or a URI."""
    return fs.FileSystem.from_uri(folder)


def attempt_name(kind: str, suffix: str) -> tuple[int, str]:
    """Partition number and a file name that no other attempt of any task uses.

    A lost or repeated attempt leaves a file that no index lists, so it is never read.
    """
    context = TaskContext.get()
    number = context.partitionId() if context else 0
    return number, f"{kind}-{number:06d}-{uuid.uuid4().hex}{suffix}"
