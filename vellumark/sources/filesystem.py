"""Opening and listing files from tasks, on any file system Arrow knows."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyarrow import fs

LISTING_BATCH = 10_000


def open_file_system(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a Hadoop style URI."""
    if uri.startswith("file:") or "://" not in uri:
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


def publish(system: fs.FileSystem, part: str, target: str) -> None:
    """Give a finished file its name; one that is there already, from a repeated task, stays."""
    try:
        system.move(part, target)
    except OSError:
        if system.get_file_info(target).type != fs.FileType.File:
            raise
        if system.get_file_info(part).type == fs.FileType.File:
            system.delete_file(part)


def list_folder(uri: str) -> Iterator[pd.DataFrame]:
    """name, path, size, modified of the files directly in a folder, empty ones included."""
    uri = uri.rstrip("/")
    system, root = open_file_system(uri)
    prefix = uri.replace("s3a://", "s3://", 1).removesuffix(root) if "://" in uri else ""
    found = [
        f for f in system.get_file_info(fs.FileSelector(root))
        if f.type == fs.FileType.File and not f.base_name.startswith(("_", "."))
    ]
    for at in range(0, len(found), LISTING_BATCH):
        some = found[at : at + LISTING_BATCH]
        yield _rows([prefix + f.path for f in some], some)


def _rows(paths: list[str], found: list[fs.FileInfo]) -> pd.DataFrame:
    return pd.DataFrame(
        {
            "name": [f.base_name for f in found],
            "path": paths,
            "size": pd.Series([f.size for f in found], dtype="int64"),
            "modified": pd.to_datetime([f.mtime_ns // 1000 for f in found], unit="us", utc=True).as_unit("us"),
        }
    )


def stat_paths(paths: list[str]) -> pd.DataFrame:
    """name, path, size, modified of the paths that are files."""
    kept, infos = [], []
    for path in paths:
        system, inner = open_file_system(path)
        info = system.get_file_info(inner)
        if info.type == fs.FileType.File:
            kept.append(path)
            infos.append(info)
    return _rows(kept, infos)
