"""Arrow file systems for Hadoop paths, used inside tasks."""

from __future__ import annotations

import re

#: Hadoop's names of file systems that Arrow knows by another.
SCHEMES = {"s3a": "s3", "s3n": "s3", "abfss": "abfs"}


def filesystem(uri: str):
    """The Arrow file system of a Hadoop path, and the path in it."""
    from pyarrow import fs

    if local := re.match(r"(?:file:)?/+(.*)", uri):
        return fs.LocalFileSystem(), "/" + local[1]
    scheme, colon, rest = uri.partition("://")
    return fs.FileSystem.from_uri(SCHEMES.get(scheme, scheme) + colon + rest)
