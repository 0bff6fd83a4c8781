"""Stores that tasks open by themselves: local and mounted folders, HDFS and object stores, by their URI."""

from __future__ import annotations

from urllib.parse import quote

from pyarrow import fs


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a URI or an absolute path, and the path in it."""
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(quote(uri, safe=":/?&=@%+")) if "://" in uri else (fs.LocalFileSystem(), uri)


def files_below(uri: str, ending: str) -> list[tuple[str, int]]:
    """(URI, size) of the files below a folder whose names end so, or of the file itself."""
    store, path = opened(uri)
    one = store.get_file_info(path)
    found = [one] if one.type == fs.FileType.File else store.get_file_info(fs.FileSelector(path, recursive=True))
    head = uri[: len(uri) - len(path)] if uri.endswith(path) else ""
    return sorted((head + f.path, f.size) for f in found if f.type == fs.FileType.File and f.path.endswith(ending))
