"""Small files by path or URI (local, hdfs, s3, gs): parameters, contracts, artefact checks."""

from __future__ import annotations

import re
from collections.abc import Callable
from pathlib import Path
from urllib.parse import quote

import pyarrow.fs as pafs


def plain(uri: str) -> str:
    """A local path without its file: prefix; other URIs as they are."""
    return re.sub(r"^file:/+", "/", uri)


#: Names that Hadoop has for stores that pyarrow knows by another one.
_SCHEMES = {"s3a": "s3", "s3n": "s3", "gcs": "gs"}
_FACTORIES: dict[str, Callable[[str], tuple[pafs.FileSystem, str]]] = {}


def register_filesystem(scheme: str, factory: Callable[[str], tuple[pafs.FileSystem, str]]) -> None:
    """Use `factory(uri) -> (file system, path)` for a scheme, for stores that need settings or that pyarrow does not know."""
    _FACTORIES[scheme] = factory


def locate(uri: str | Path) -> tuple[pafs.FileSystem, str]:
    where = plain(str(uri))
    if "://" in where:
        scheme, rest = where.split("://", 1)
        if scheme in _FACTORIES:
            return _FACTORIES[scheme](where)
        where = f"{_SCHEMES.get(scheme, scheme)}://{rest}"
        return pafs.FileSystem.from_uri(quote(where, safe=":/@=?&"))
    return pafs.LocalFileSystem(), where


def exists(uri: str | Path) -> bool:
    system, path = locate(uri)
    return system.get_file_info(path).type != pafs.FileType.NotFound


def read_text(uri: str | Path) -> str:
    system, path = locate(uri)
    with system.open_input_stream(path) as stream:
        return stream.read().decode("utf-8")


def write_text(uri: str | Path, text: str) -> None:
    system, path = locate(uri)
    if isinstance(system, pafs.LocalFileSystem):  # other stores make the folders themselves
        system.create_dir(str(Path(path).parent), recursive=True)
    with system.open_output_stream(path) as stream:
        stream.write(text.encode("utf-8"))
