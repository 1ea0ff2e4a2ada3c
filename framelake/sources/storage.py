"""Files on every file system that pyarrow opens: plain paths and file:, hdfs, s3 (s3a too), gs, abfs."""

from __future__ import annotations

import fnmatch
import os
import re
import shutil
import tempfile
import uuid
from functools import lru_cache

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession

#: Names that Hadoop's connectors have for a scheme (fixed values).
SCHEMES = {"s3a": "s3", "s3n": "s3"}
#: File systems whose files come to be as a whole when they are closed.
WHOLE = ("s3", "gcs", "abfs")


@lru_cache(maxsize=64)
def _system(root: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(root)


def located(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path within it."""
    m = re.match(r"([a-zA-Z][a-zA-Z0-9+.-]*)://([^/]*)(.*)", uri)
    if not m or m[1] == "file":
        return fs.LocalFileSystem(), os.path.abspath(m[3] if m else uri.removeprefix("file:"))
    system, root = _system(f"{SCHEMES.get(m[1], m[1])}://{m[2]}/")
    return system, root.rstrip("/") + m[3]


def local(uri: str) -> bool:
    return isinstance(located(uri)[0], fs.LocalFileSystem)


def joined(folder: str, name: str) -> str:
    return f"{folder.rstrip('/')}/{name}"


def exists(uri: str) -> bool:
    system, path = located(uri)
    return system.get_file_info(path).type == fs.FileType.File


def is_folder(uri: str) -> bool:
    system, path = located(uri)
    return system.get_file_info(path).type == fs.FileType.Directory


def listed(pattern: str) -> list[str]:
    """The files that a pattern names, sorted; *, ? and [] stand for characters of one name."""
    return [path for path, _, _ in described(pattern)]


def described(pattern: str) -> list[tuple[str, int, int]]:
    """The same with when each was last changed, in nanoseconds, and its size, as the listing tells them."""
    system, path = located(pattern)
    names = path.split("/")
    wild = next((i for i, n in enumerate(names) if re.search(r"[*?\[]", n)), None)
    if wild is None:
        return [(pattern, changed(pattern), size(pattern))] if exists(pattern) else []
    root = "" if isinstance(system, fs.LocalFileSystem) else pattern.removesuffix(path)
    found = system.get_file_info(fs.FileSelector("/".join(names[:wild]) or "/", recursive=wild < len(names) - 1, allow_not_found=True))
    own = ((x, x.path.split("/")) for x in found if x.type == fs.FileType.File)
    return sorted((root + x.path, x.mtime_ns or 0, x.size or 0) for x, parts in own if len(parts) == len(names) and all(map(fnmatch.fnmatchcase, parts, names)))


def folders(uri: str) -> list[str]:
    """The names of a folder's folders but those that Spark's readers pass over."""
    system, path = located(uri)
    found = system.get_file_info(fs.FileSelector(path, allow_not_found=True))
    return sorted(x.base_name for x in found if x.type == fs.FileType.Directory and not x.base_name.startswith(("_", ".")))


def names(folder: str, ending: str) -> list[str]:
    """The names of a folder's files of an ending but those that Spark's readers pass over."""
    system, path = located(folder)
    found = system.get_file_info(fs.FileSelector(path, allow_not_found=True))
    return [x.base_name for x in found if x.type == fs.FileType.File and x.base_name.endswith(ending) and not x.base_name.startswith(("_", "."))]


def opened(uri: str) -> pa.NativeFile:
    """A file for reads at any place."""
    system, path = located(uri)
    return system.open_input_file(path)


def replaced(uri: str, data: bytes) -> None:
    """A file that is there as a whole or not at all, so that a task that is tried again leaves no half one."""
    system, path = located(uri)
    folder, _, _ = path.rpartition("/")
    whole = system.type_name in WHOLE
    if not whole:
        system.create_dir(folder, recursive=True)
    part = path if whole else f"{path}.{uuid.uuid4().hex}"
    with system.open_output_stream(part) as f:
        f.write(data)
    if whole:
        return
    if system.type_name == "hdfs" and system.get_file_info(path).type == fs.FileType.File:
        system.delete_file(path)  # a rename there goes to no name that is taken
    system.move(part, path)


def copied(source: str, to: str) -> bool:
    """Copies a file, with its times where both are local; whether it was there."""
    if not exists(source):
        return False
    (a, old), (b, new) = located(source), located(to)
    if isinstance(a, fs.LocalFileSystem) and isinstance(b, fs.LocalFileSystem):
        os.makedirs(os.path.dirname(new), exist_ok=True)
        shutil.copy2(old, new)
    else:
        if b.type_name not in WHOLE:
            b.create_dir(new.rpartition("/")[0], recursive=True)
        fs.copy_files(old, new, a, b)
    return True


def size(uri: str) -> int:
    system, path = located(uri)
    return system.get_file_info(path).size


def moved(staged: str, to: str, size: int) -> None:
    """Moves a file to its name, replacing what is there; a move that was done before is passed over."""
    (system, old), (_, new) = located(staged), located(to)
    if system.get_file_info(old).type != fs.FileType.File:
        there = system.get_file_info(new)
        if there.type == fs.FileType.File and there.size == size:
            return
        raise FileNotFoundError(staged)
    if system.type_name not in WHOLE:
        system.create_dir(new.rpartition("/")[0], recursive=True)
    if system.type_name == "hdfs" and system.get_file_info(new).type == fs.FileType.File:
        system.delete_file(new)  # a rename there goes to no name that is taken
    system.move(old, new)


def removed(folder: str) -> None:
    """Takes a folder away, if it is there."""
    system, path = located(folder)
    if system.get_file_info(path).type == fs.FileType.Directory:
        system.delete_dir(path)


def removed_file(uri: str) -> None:
    system, path = located(uri)
    if system.get_file_info(path).type == fs.FileType.File:
        system.delete_file(path)


def changed(uri: str) -> int:
    """When a file was last changed, in nanoseconds."""
    system, path = located(uri)
    return system.get_file_info(path).mtime_ns or 0


def shared(spark: SparkSession) -> str:
    """The folder that all machines share, from spark.checkpoint.dir; one is made only where none is set and there are no other machines."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="framelake-"))
        found = spark.sparkContext.getCheckpointDir()
    return found.rstrip("/")


def fresh(spark: SparkSession, what: str) -> str:
    """A path in the shared folder that no other call gets."""
    return f"{shared(spark)}/{what}-{uuid.uuid4().hex}"
