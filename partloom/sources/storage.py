"""Directories and files, through the Hadoop FileSystem the session is configured with."""

from __future__ import annotations

import logging
import re
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from functools import lru_cache

from py4j.protocol import Py4JJavaError
from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from partloom.errors import ConfigError, StorageError

log = logging.getLogger(__name__)

# Calls to a catalog or an object store wait on the network, hence more threads than cores.
_WAITING_CALLS = 32


def normalise(uri: str) -> str:
    return uri if uri.endswith("/") else uri + "/"


def shared_folder(spark: SparkSession) -> str:
    """The folder that every node can reach, as the cluster names it."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        raise ConfigError("spark.checkpoint.dir is not set: name an output folder")
    uri = qualified(spark, folder)
    if uri.startswith("file:") and not _is_one_machine(spark):
        log.warning("spark.checkpoint.dir is %s: every node must reach it under that path, as a shared mount", uri)
    return uri


def _is_one_machine(spark: SparkSession) -> bool:
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


@lru_cache(maxsize=1)
def _path_class(jvm):
    # Each part of a Java package name costs a call to the JVM.
    return jvm.org.apache.hadoop.fs.Path


def _open(spark: SparkSession, uri: str):
    path = _path_class(spark.sparkContext._jvm)(uri)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def _hidden(name: str) -> bool:
    # The names Spark's file sources skip.
    return name.startswith(".") or (name.startswith("_") and "=" not in name)


def has_objects(spark: SparkSession, uri: str | None) -> bool:
    """Whether a data file lies anywhere under ``uri``; a view has no location."""
    if uri is None:
        return False
    fs, path = _open(spark, uri)
    if not fs.exists(path):
        return False
    root = fs.makeQualified(path).toString()
    files = fs.listFiles(path, True)
    while files.hasNext():
        inside = files.next().getPath().toString()[len(root):].strip("/")
        if not any(_hidden(name) for name in inside.split("/")):
            return True
    return False


def is_vacant(spark: SparkSession, uri: str) -> bool:
    """Whether nothing at all, not even a marker file, lies under ``uri``."""
    fs, path = _open(spark, uri)
    return not fs.exists(path) or not fs.listStatusIterator(path).hasNext()


def only_file(spark: SparkSession, uri: str) -> str:
    """The URI of the one file that ``uri`` names; folders, patterns and absent files are refused."""
    fs, path = _open(spark, uri)
    found = fs.globStatus(path)
    if found is None or len(found) != 1 or not found[0].isFile():
        raise ConfigError(f"{uri} is not one file")
    return found[0].getPath().toString()


def newest_file(spark: SparkSession, uri: str, after_millis: int) -> bool:
    """Whether a file below ``uri`` was written after that time.

    The cluster lists the files, in tasks where directories are many, and looks at none of them; what comes
    here is an answer. Markers in the directory itself count as well: a write without rows may leave nothing else.
    """
    fs, path = _open(spark, uri)
    if not fs.exists(path):
        return False
    markers = fs.globStatus(_path_class(spark.sparkContext._jvm)(path, "{_,.}*"))
    if any(not m.isDirectory() and m.getModificationTime() > after_millis for m in markers or ()):
        return True
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(fs.makeQualified(path).toString())
    return not files.where(F.col("modificationTime") > F.timestamp_millis(F.lit(after_millis))).select("path").isEmpty()


def create_new(spark: SparkSession, uri: str, text: str) -> bool:
    """Write a file that must not be there yet, in one step; False where it is.

    Hadoop's view of a local disk looks first and opens then, so there the file is opened by Java itself.
    """
    fs, path = _open(spark, uri)
    jvm = spark.sparkContext._jvm
    for _ in range(20):
        fs.mkdirs(path.getParent())
        try:
            if fs.getUri().getScheme() == "file":
                options = spark.sparkContext._gateway.new_array(jvm.java.nio.file.OpenOption, 2)
                options[0], options[1] = jvm.java.nio.file.StandardOpenOption.CREATE_NEW, jvm.java.nio.file.StandardOpenOption.WRITE
                jvm.java.nio.file.Files.write(jvm.java.io.File(path.toUri().getPath()).toPath(), text.encode(), options)
            else:
                stream = fs.create(path, False)
                stream.write(text.encode())
                stream.close()
            return True
        except Py4JJavaError as error:
            kind = error.java_exception.getClass().getName()
            if kind.endswith("FileAlreadyExistsException") or fs.exists(path):
                return False
            # Another call tidied the directory away before the file was in it.
            if not kind.endswith(("NoSuchFileException", "FileNotFoundException")):
                raise StorageError(f"{uri} could not be created") from error
    raise StorageError(f"{uri} could not be created")


def read_text(spark: SparkSession, uri: str) -> str | None:
    """What a small file holds; None where there is none."""
    fs, path = _open(spark, uri)
    if not fs.exists(path):
        return None
    stream = fs.open(path)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def exists(spark: SparkSession, uri: str) -> bool:
    fs, path = _open(spark, uri)
    return fs.exists(path)


def names_in(spark: SparkSession, uri: str) -> list[str]:
    fs, path = _open(spark, uri)
    try:
        return [status.getPath().getName() for status in fs.listStatus(path)] if fs.exists(path) else []
    except Py4JJavaError:
        if fs.exists(path):
            raise
        return []  # gone since


def touch(spark: SparkSession, uri: str, millis: int) -> None:
    fs, path = _open(spark, uri)
    fs.setTimes(path, millis, -1)


def modified_millis(spark: SparkSession, uri: str) -> int:
    fs, path = _open(spark, uri)
    return fs.getFileStatus(path).getModificationTime()


def missing_above(spark: SparkSession, uri: str) -> list[str]:
    """The directories over ``uri`` that are not there, the innermost first."""
    fs, path = _open(spark, uri)
    missing, above = [], path.getParent()
    while above is not None and not fs.exists(above):
        missing.append(above.toString())
        above = above.getParent()
    return missing


def delete_if_empty(spark: SparkSession, uris: Iterable[str]) -> None:
    """Take these directories away as far as nothing is in them."""
    for uri in uris:
        fs, path = _open(spark, uri)
        try:
            if not fs.exists(path):
                continue
            if fs.listStatusIterator(path).hasNext():
                return
            fs.delete(path, False)
        except Py4JJavaError:  # something came in, or another call took it away, meanwhile
            return


def move(spark: SparkSession, source: str, target: str) -> None:
    fs, path = _open(spark, source)
    goal = _open(spark, target)[1]
    fs.mkdirs(goal.getParent())
    _rename(fs, path, goal)


def aside_of(spark: SparkSession, uri: str) -> str:
    """A name beside ``uri`` for what it holds while it is replaced."""
    return _beside(spark, uri, "_replaced")


def same_place(spark: SparkSession, left: str, right: str) -> bool:
    return qualified(spark, left) == qualified(spark, right)


def holds(spark: SparkSession, outer: str, inner: str) -> bool:
    """Whether ``inner`` is ``outer`` or lies below it."""
    return qualified(spark, inner).startswith(qualified(spark, outer))


def overlapping(spark: SparkSession, places: Iterable[str], others: Iterable[str]) -> list[str]:
    """Which of ``places`` are, hold or lie within one of ``others``."""
    taken = {full_name(spark, other) for other in others}
    above = {prefix for other in taken for prefix in _prefixes(other)}
    return [place for place in places if (full := full_name(spark, place)) in above or taken.intersection(_prefixes(full))]


def _prefixes(uri: str) -> list[str]:
    """The directory and all that hold it, each ending in a slash."""
    return [uri[: i + 1] for i, c in enumerate(uri) if c == "/" and i and uri[i - 1] not in ":/"]


# A path that names its scheme, and the host if it has one.
_IN_FULL = re.compile(r"([a-z][a-z0-9+.-]*:)(//[^/]+|//(?=/))?(/.*)")


def full_name(spark: SparkSession, uri: str) -> str:
    """As ``qualified``; a name that is in full already takes no call to the file system."""
    told = _IN_FULL.fullmatch(uri)
    if not told or "//" in told[3] or (told[1] != "file:" and not told[2]):
        return qualified(spark, uri)
    host = "" if told[2] in (None, "//") else told[2]
    return normalise(f"{told[1]}{host}{told[3]}")


def qualified(spark: SparkSession, uri: str) -> str:
    """``uri`` in full, ending in a slash, as equal directories are spelled alike."""
    fs, path = _open(spark, uri)
    return normalise(fs.makeQualified(path).toString())


def delete_tree(spark: SparkSession, uri: str | None) -> None:
    if uri is None:
        return
    fs, path = _open(spark, uri)
    if fs.exists(path) and not fs.delete(path, True):
        raise StorageError(f"{uri} could not be deleted")


def staging_beside(spark: SparkSession, uri: str) -> str:
    """A fresh directory next to ``uri`` that readers of its parent skip."""
    return _beside(spark, uri, "_staging")


def _beside(spark: SparkSession, uri: str, prefix: str) -> str:
    _, path = _open(spark, uri)
    return f"{path.getParent().toString().rstrip('/')}/{prefix}-{uuid.uuid4().hex}/"


class Swap:
    """The directory ``staged`` (or none) at ``target`` in place of what is there.

    The old directory is set aside as ``_replaced-…``; ``undo`` brings it back, ``finish`` deletes it. On HDFS and
    local disks these are metadata operations however large the data; on object stores the connector copies
    the objects. The caller holds the directory's lease (``plans.journal``).
    """

    def __init__(self, spark: SparkSession, staged: str | None, target: str, aside: str | None = None):
        self._fs, self._target = _open(spark, target)
        self._staged = _open(spark, staged)[1] if staged else None
        self._aside = _open(spark, aside or aside_of(spark, target))[1]
        self._replaces = self._moved = False

    def place(self) -> None:
        if self._fs.exists(self._target):
            _rename(self._fs, self._target, self._aside)
            self._replaces = True
        else:
            self._fs.mkdirs(self._target.getParent())
        try:
            if self._staged is not None:
                _rename(self._fs, self._staged, self._target)
                self._moved = True
        except BaseException:
            self.undo()
            raise

    def undo(self) -> None:
        if self._moved:
            _rename(self._fs, self._target, self._staged)
        elif self._fs.exists(self._target):
            self._fs.delete(self._target, True)  # what came there meanwhile
        if self._replaces:
            _rename(self._fs, self._aside, self._target)

    def finish(self) -> None:
        if self._replaces:
            self._fs.delete(self._aside, True)


@contextmanager
def swapped(spark: SparkSession, staged: str | None, target: str, aside: str | None = None):
    """A ``Swap`` that stays if the block ends well."""
    swap = Swap(spark, staged, target, aside)
    swap.place()
    try:
        yield
    except BaseException:
        swap.undo()
        raise
    swap.finish()


def make_directory(spark: SparkSession, uri: str) -> None:
    fs, path = _open(spark, uri)
    fs.mkdirs(path)


def parent_of(spark: SparkSession, uri: str) -> str:
    return normalise(_open(spark, uri)[1].getParent().toString())


def fresh_below(uri: str) -> str:
    """A new directory in ``uri`` that counts as data."""
    return f"{normalise(uri)}_run={uuid.uuid4().hex}/"


def delete_beside(spark: SparkSession, kept: str) -> None:
    """Delete what lies next to ``kept`` in its directory."""
    fs, path = _open(spark, kept)
    name = path.getName()
    for status in fs.listStatus(path.getParent()):
        if status.getPath().getName() != name:
            fs.delete(status.getPath(), True)


def _rename(fs, source, target) -> None:
    problem = f"{source.toString()} could not be moved to {target.toString()}"
    # Moving onto an existing directory would put the source inside it.
    if fs.exists(target):
        raise StorageError(f"{problem}, which is there already")
    try:
        moved = fs.rename(source, target)
    except Py4JJavaError as error:
        raise StorageError(problem) from error
    if not moved:
        raise StorageError(problem)


def for_each(spark: SparkSession, call: Callable, items: Iterable, at_once: int = _WAITING_CALLS) -> list:
    """``call`` on every item, many waiting at once; the results in order."""
    items = list(items)
    workers = min(at_once, len(items))
    if workers < 2:
        return [call(item) for item in items]

    def share(first: int) -> list:
        return [call(item) for item in items[first::workers]]

    results = [None] * len(items)
    with ThreadPoolExecutor(workers) as pool:
        shares = [pool.submit(inheriting(spark, share), first) for first in range(workers)]
        for first, done in enumerate(shares):
            results[first::workers] = done.result()
    return results


def inheriting(spark: SparkSession, call: Callable) -> Callable:
    """``call`` for one other thread, with a copy of this thread's job properties and tags.

    Threads must not share a copy: they would overwrite each other's properties.
    """
    wrap = inheritable_thread_target(spark)
    # Spark hands its argument back where threads are not tied to the JVM's.
    return call if wrap is spark else wrap(call)
