"""Where a batch is: its pictures and its root, from a folder that is either, and the batch that is current."""

from __future__ import annotations

import os

import pyarrow.fs
from pyspark.sql import SparkSession

from siftstone.sources.pictures import filesystem
from siftstone.sources.readers import path_list


def _is_folder(path: str) -> bool:
    fs, at = filesystem(path)
    return fs.get_file_info(at).type == pyarrow.fs.FileType.Directory


def resolve(folder: str) -> tuple[str, str]:
    """(folder of the pictures, root of the batch). A root has a folder "images"; a folder named "images" or "pass" lies in its root; any other is both."""
    path = folder.rstrip("/")
    if not _is_folder(path):
        raise NotADirectoryError(folder)
    above, _, name = path.rpartition("/")
    if name.lower() in ("images", "pass"):
        return path, above or "/"
    return (f"{path}/images", path) if _is_folder(f"{path}/images") else (path, path)


def current(spark: SparkSession, listed: str | None = None, variable: str | None = None, default: str | None = None) -> str | None:
    """The batch that an environment variable names, else the first line of a small file, else the default; only folders that are there count, but for the default."""
    named = os.environ.get(variable, "").strip() if variable else ""
    if named and _is_folder(named):
        return named
    if listed:
        fs, at = filesystem(listed)
        if fs.get_file_info(at).type == pyarrow.fs.FileType.File:
            first = path_list(spark, listed).limit(1).collect()
            if first and _is_folder(first[0].path):
                return first[0].path
    return default
