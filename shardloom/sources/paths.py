"""One place that maps a destination URL to a file system usable inside Python tasks."""

from __future__ import annotations

import os
from urllib.parse import unquote, urlparse

from pyarrow import fs as pafs


def resolve(url: str) -> tuple[pafs.FileSystem, str]:
    """``(file system, path)`` for a plain path or a ``file:``/``hdfs:``/``s3a:``/``gs:`` URL."""
    parsed = urlparse(url)
    if parsed.scheme in ("", "file"):
        local = unquote(parsed.path) if parsed.scheme else url
        return pafs.LocalFileSystem(), os.path.abspath(local)
    if parsed.scheme == "s3a":
        url = "s3" + url[len("s3a"):]
    return pafs.FileSystem.from_uri(url)


def exists(url: str) -> bool:
    fs, path = resolve(url)
    return fs.get_file_info(path).type != pafs.FileType.NotFound
