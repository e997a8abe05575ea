"""Binary files in folders that all executors share, for sources and sinks that are not Spark's own."""

from __future__ import annotations

import contextlib
import mmap
import os
from collections.abc import Iterator
from typing import IO
from urllib.parse import unquote, urlsplit


def local(path: str) -> str | None:
    """The path of a folder or file that is mounted, or none where it is in another store."""
    parts = urlsplit(path)
    if parts.scheme == "file":
        return unquote(parts.path)
    return path if not parts.scheme else None


def _store(path: str):
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(path)


@contextlib.contextmanager
def replaced(path: str) -> Iterator[IO[bytes]]:
    """A new file that takes its name only when it is complete; what was there before is replaced."""
    made, at = f"{path}.{os.urandom(8).hex()}.part", local(path)
    if at is None:
        fs, inner = _store(path)
        made = inner + made.removeprefix(path)
        with fs.open_output_stream(made) as out:
            yield out
        fs.move(made, inner)
        return
    made = local(made)
    os.makedirs(os.path.dirname(at), exist_ok=True)
    try:
        with open(made, "wb") as out:
            yield out
            out.flush()
            os.fsync(out.fileno())
        os.replace(made, at)
    except BaseException:
        with contextlib.suppress(OSError):
            os.unlink(made)
        raise


def whole(path: str) -> memoryview:
    """A file's bytes: mapped into memory where the folder is mounted, else read."""
    at = local(path)
    if at is None:
        fs, inner = _store(path)
        with fs.open_input_file(inner) as f:
            return memoryview(f.read_buffer())
    with open(at, "rb") as f:
        if not os.fstat(f.fileno()).st_size:
            return memoryview(b"")
        return memoryview(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ))


def exists(path: str) -> bool:
    at = local(path)
    if at is not None:
        return os.path.exists(at)
    from pyarrow.fs import FileType

    fs, inner = _store(path)
    return fs.get_file_info(inner).type != FileType.NotFound


def removed(path: str) -> None:
    """Remove a file, if it is there."""
    at = local(path)
    if at is not None:
        with contextlib.suppress(FileNotFoundError):
            os.unlink(at)
        return
    fs, inner = _store(path)
    with contextlib.suppress(FileNotFoundError):
        fs.delete_file(inner)


def children(path: str) -> list[tuple[str, bool, int]]:
    """Name, whether it is a folder, and bytes of everything straight in a folder; nothing where there is none."""
    at = local(path)
    if at is not None:
        with contextlib.suppress(FileNotFoundError, NotADirectoryError), os.scandir(at) as found:
            return sorted((x.name, x.is_dir(), x.stat().st_size) for x in found if x.is_dir() or x.is_file())
        return []
    from pyarrow.fs import FileSelector, FileType

    fs, inner = _store(path)
    return sorted((x.base_name, x.type == FileType.Directory, x.size or 0) for x in fs.get_file_info(FileSelector(inner, allow_not_found=True)))


def opened(path: str) -> IO[bytes]:
    """A file to seek and read in."""
    at = local(path)
    if at is not None:
        return open(at, "rb", buffering=1 << 16)
    fs, inner = _store(path)
    return fs.open_input_file(inner)


def moved(old: str, new: str) -> None:
    """Give a file another name in the same store; what had that name is replaced."""
    at = local(new)
    if at is not None:
        os.makedirs(os.path.dirname(at), exist_ok=True)
        os.replace(local(old), at)
        return
    fs, inner = _store(new)
    fs.move(_store(old)[1], inner)
