"""Files as files: listing, opening and copying, on any file system pyarrow can reach."""

from __future__ import annotations

import io
import os
import re
import uuid
from collections.abc import Iterator
from pathlib import Path
from typing import IO, NamedTuple
from weakref import WeakKeyDictionary

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.paths import HIDDEN_PATTERN


# looking these up takes several calls to the JVM
_handles: WeakKeyDictionary = WeakKeyDictionary()


def hadoop(uri: str):
    """(Hadoop file system, path) of a location, with the session's settings: what Spark itself reads and writes by."""
    context = SparkSession.active().sparkContext
    if context not in _handles:
        _handles[context] = context._jvm.org.apache.hadoop.fs.Path, context._jsc.hadoopConfiguration()
    new_path, settings = _handles[context]
    path = new_path(uri)
    return path.getFileSystem(settings), path


def qualify(uri: str) -> str:
    """The location with its scheme, so that it means the same file in a task as on the driver."""
    fs, path = hadoop(uri)
    return fs.makeQualified(path).toString()


def local_path(uri: str) -> str | None:
    """Path of a location on the driver's own file system, None for any other."""
    full = qualify(uri)
    return "/" + full.removeprefix("file:").lstrip("/") if full.startswith("file:") else None


def exists(uri: str) -> bool:
    fs, path = hadoop(uri)
    return fs.exists(path)


def make_dir(uri: str) -> None:
    fs, path = hadoop(uri)
    fs.mkdirs(path)


def delete_dir(uri: str) -> None:
    fs, path = hadoop(uri)
    fs.delete(path, True)


def sub_dirs(uri: str) -> list[str]:
    fs, path = hadoop(uri)
    return sorted(s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory()) if fs.exists(path) else []


def fingerprint(uri: str) -> tuple[int, int]:
    """(files, bytes) below a folder, (0, 0) if it does not exist."""
    fs, path = hadoop(uri)
    if not fs.exists(path):
        return 0, 0
    summary = fs.getContentSummary(path)
    return summary.getFileCount(), summary.getLength()


def open_file(uri: str, mode: str = "rb") -> IO[bytes]:
    """A binary stream on the driver; files that are not local pass through memory as a whole."""
    local = local_path(uri)
    if local is not None:
        if "r" not in mode:
            Path(local).parent.mkdir(parents=True, exist_ok=True)
        return open(local, "rb" if "r" in mode else "wb")  # noqa: SIM115
    fs, path = hadoop(uri)
    if "r" not in mode:
        return _Upload(fs, path)
    stream = fs.open(path)
    try:
        return io.BytesIO(SparkSession.active().sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
    finally:
        stream.close()


class _Upload(io.BytesIO):
    """Written to its Hadoop path when closed."""

    def __init__(self, fs, path):
        super().__init__()
        self._target = fs, path

    def close(self) -> None:
        if not self.closed:
            fs, path = self._target
            out = fs.create(path, True)
            out.write(self.getvalue())
            out.close()
        super().close()


def write_bytes(uri: str, data: bytes) -> None:
    with open_file(uri, "wb") as out:
        out.write(data)


def publish(uri: str, data: bytes) -> None:
    """Write a file that readers of its folder see whole or not at all: under a hidden name first, then renamed."""
    folder, _, name = uri.rpartition("/")
    hidden = f"{folder}/_{name}"
    write_bytes(hidden, data)
    rename(hidden, uri)


def create_new(uri: str, data: bytes) -> bool:
    """Create a file, whole at once, unless there is one of that name; whether it was created. Of several writers one succeeds.

    The content is written under a hidden name and linked (on the driver's disk) or renamed to the name, neither of which
    replaces a file that is there. The file system must not replace files on rename, as HDFS does not.
    """
    folder, _, name = uri.rpartition("/")
    hidden = f"{folder}/_{uuid.uuid4().hex}-{name}"
    write_bytes(hidden, data)
    local = local_path(uri)
    if local is None:
        fs, source = hadoop(hidden)
        target = hadoop(uri)[1]
        if not fs.exists(target) and fs.rename(source, target):
            return True
        fs.delete(source, False)
        return False
    try:
        os.link(local_path(hidden), local)
    except FileExistsError:
        return False
    finally:
        os.unlink(local_path(hidden))
    return True


def rename(source: str, target: str) -> None:
    fs, path = hadoop(source)
    if not fs.rename(path, hadoop(target)[1]):
        raise OSError(f"{source} could not be renamed to {target}")


def names(uri: str) -> list[str]:
    """Names of the files and folders in a folder that are not hidden, sorted; none if it does not exist."""
    fs, path = hadoop(uri)
    if not fs.exists(path):
        return []
    return sorted(n for n in (s.getPath().getName() for s in fs.listStatus(path)) if n[0] not in "._")


def read_bytes(uri: str) -> bytes:
    with open_file(uri) as source:
        return source.read()


def resolve(uri: str) -> tuple[pafs.FileSystem, str]:
    """(pyarrow file system, path) of a qualified location, for use in tasks."""
    if uri.startswith("file:"):
        uri = "/" + uri.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", uri))


def list_frame(spark: SparkSession, root: str) -> DataFrame:
    """Files below ``root`` that Spark reads as data: path (relative), physical, length, modified.

    The metadata columns of the binary source are used; no file is opened.
    """
    base = qualify(root).rstrip("/")
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    return listed.select(
        F.substr("path", F.lit(len(base) + 2)).alias("path"),
        F.col("path").alias("physical"),
        "length",
        F.col("modificationTime").alias("modified"),
    )


def copy_files(pairs: DataFrame, workers: int | None = None) -> DataFrame:
    """Copy every pair (source, target) in Spark tasks; returns (target, length) once evaluated.

    Files are streamed one by one inside a task. Copying is safe to repeat, so a retried task only overwrites
    what it wrote before.
    """
    if workers:
        pairs = pairs.repartition(workers)

    def copy(batches):
        for batch in batches:
            sizes = []
            for source, target in zip(batch["source"], batch["target"], strict=True):
                from_fs, from_path = resolve(source)
                to_fs, to_path = resolve(target)
                to_fs.create_dir(to_path.rsplit("/", 1)[0], recursive=True)
                with from_fs.open_input_stream(from_path) as src, to_fs.open_output_stream(to_path) as dst:
                    while chunk := src.read(1 << 22):
                        dst.write(chunk)
                sizes.append(to_fs.get_file_info(to_path).size)
            yield batch[["target"]].assign(length=sizes)

    return pairs.select("source", "target").mapInPandas(copy, "target string, length bigint")


class FileStatus(NamedTuple):
    path: str
    size: int
    modified: int


class FileSystem:
    """Files of one transform input or output, by logical path.

    An input lists its manifest and opens the files where they lie; an output lists and writes a folder.
    """

    def __init__(self, folder: str | None = None, manifest: DataFrame | None = None):
        self._folder = folder.rstrip("/") if folder else None
        self._manifest = manifest

    def _entries(self) -> Iterator[FileStatus]:
        if self._manifest is not None:
            millis = F.unix_millis("modified").alias("modified")
            for row in self._manifest.select("path", "length", millis).orderBy("path").toLocalIterator():
                yield FileStatus(row["path"], row["length"], row["modified"])
            return
        fs, path = hadoop(self._folder)
        if not fs.exists(path):
            return
        base, found, files = fs.makeQualified(path).toString(), [], fs.listFiles(path, True)
        while files.hasNext():
            status = files.next()
            name = status.getPath().toString()[len(base) :].lstrip("/")
            found.append(FileStatus(name, status.getLen(), status.getModificationTime()))
        yield from sorted(found)

    def ls(self, glob: str | None = None, regex: str = ".*", show_hidden: bool = False) -> Iterator[FileStatus]:
        """Files matching a glob (``**`` spans folders) and, from its start, a regular expression."""
        pattern, hidden, wanted = re.compile(regex), re.compile(HIDDEN_PATTERN), glob and re.compile(glob_to_regex(glob))
        for entry in self._entries():
            if not show_hidden and hidden.search(entry.path):
                continue
            if wanted and not wanted.match(entry.path):
                continue
            if pattern.match(entry.path):
                yield entry

    def files(self, glob: str | None = None, regex: str = ".*", show_hidden: bool = False) -> DataFrame:
        """The same listing as a frame, for inputs: filters run on the manifest."""
        from tidemark.functions import is_hidden, matches_regex

        rows = self._manifest.where(matches_regex(F.col("path"), regex))
        if not show_hidden:
            rows = rows.where(~is_hidden(F.col("path")))
        return rows if glob is None else rows.where(F.col("path").rlike(glob_to_regex(glob)))

    def open(self, path: str, mode: str = "r", **kwargs) -> IO:
        if self._manifest is not None:
            if "w" in mode or "a" in mode:
                raise PermissionError("the files of an input are read-only")
            row = self._manifest.where(F.col("path") == path).select("physical").first()
            if row is None:
                raise FileNotFoundError(path)
            uri = row["physical"]
        else:
            uri = f"{self._folder}/{path}"
        stream = open_file(uri, mode)
        return stream if "b" in mode else io.TextIOWrapper(stream, encoding=kwargs.get("encoding", "utf-8"))


def glob_to_regex(glob: str) -> str:
    """Regular expression of a glob: ``**/`` spans any folders (also none), ``*`` and ``?`` stay in a name."""
    out, i = "", 0
    while i < len(glob):
        if glob.startswith("**/", i):
            out, i = out + "(?:.*/)?", i + 3
        elif glob.startswith("**", i):
            out, i = out + ".*", i + 2
        elif glob[i] == "*":
            out, i = out + "[^/]*", i + 1
        elif glob[i] == "?":
            out, i = out + "[^/]", i + 1
        else:
            out, i = out + re.escape(glob[i]), i + 1
    return f"^{out}$"
