"""Small files on whatever storage a path names: a local or mounted folder, HDFS or an object store, from the driver and from workers alike."""

from __future__ import annotations

import hashlib
import json
import os
import uuid

from pyarrow import fs


def _at(path: str | os.PathLike) -> tuple[fs.FileSystem, str]:
    """The file system of a path and the path in it; a path without scheme is local."""
    text = os.fspath(path)
    return fs.FileSystem.from_uri(text) if "://" in text or text.startswith("file:") else (fs.LocalFileSystem(), os.path.abspath(text))


def exists(path: str | os.PathLike) -> bool:
    system, at = _at(path)
    return system.get_file_info(at).type != fs.FileType.NotFound


def size(path: str | os.PathLike) -> int:
    system, at = _at(path)
    return system.get_file_info(at).size


def read_text(path: str | os.PathLike) -> str:
    system, at = _at(path)
    with system.open_input_stream(at, compression=None) as f:
        return f.read().decode("utf-8")


def write_text(text: str, path: str | os.PathLike) -> None:
    """Whole or not at all: written beside the target and moved over it."""
    system, at = _at(path)
    folder, name = at.rsplit("/", 1)
    system.create_dir(folder, recursive=True)
    scratch = f"{folder}/.{name}.{uuid.uuid4().hex}.tmp"
    with system.open_output_stream(scratch, compression=None) as out:
        out.write(text.encode("utf-8"))
    system.move(scratch, at)


def write_json(value: object, path: str | os.PathLike) -> None:
    write_text(json.dumps(value, indent=2, ensure_ascii=False) + "\n", path)


def move(source: str | os.PathLike, target: str | os.PathLike) -> None:
    system, at = _at(source)
    system.move(at, _at(target)[1])


def remove(path: str | os.PathLike) -> None:
    """A file or a folder with all it holds; nothing if there is none."""
    system, at = _at(path)
    kind = system.get_file_info(at).type
    if kind == fs.FileType.Directory:
        system.delete_dir(at)
    elif kind != fs.FileType.NotFound:
        system.delete_file(at)


def make_folder(path: str | os.PathLike) -> None:
    system, at = _at(path)
    system.create_dir(at, recursive=True)


def files_below(path: str | os.PathLike, suffix: str = "") -> list[tuple[str, int]]:
    """(path from the folder, size) of the files below a folder, sorted; none if there is no folder."""
    system, at = _at(path)
    found = system.get_file_info(fs.FileSelector(at, recursive=True, allow_not_found=True))
    return sorted((f.path[len(at.rstrip("/")) + 1 :], f.size) for f in found if f.type == fs.FileType.File and f.path.endswith(suffix))


def checksum(path: str | os.PathLike) -> str:
    """SHA-256 of a file, read in pieces."""
    system, at = _at(path)
    digest = hashlib.sha256()
    with system.open_input_stream(at, compression=None) as f:
        while block := f.read(1 << 20):
            digest.update(block)
    return digest.hexdigest()
