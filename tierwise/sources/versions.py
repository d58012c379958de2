"""Published table sets: immutable versions and one atomic pointer.

A set of tables lives under one root folder::

    root/_versions/<id>/...   the files of one version, never changed
    root/_pointer/<number>    which tables are published: JSON {name: path below root}

A writer fills a fresh version folder, may look at it, and publishes it: the
pointer is written in full under a temporary name and renamed, without
overwriting, to the next number.  Readers take the highest number.  So the
whole set changes at one instant, a reader never finds a table missing or half
written, and of two publishers at the same moment one comes first and the
other takes the next number.  :data:`KEEP` versions stay for readers that have
opened one; older ones are removed.

On an object store without atomic renames use catalog tables instead
(:func:`tierwise.sources.sinks.publish_view`).
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

KEEP = 2
_VERSIONS, _POINTER = "_versions", "_pointer"


def filesystem(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = filesystem(spark, path)
    return fs.exists(p)


def state(spark: SparkSession, path: str) -> tuple:
    """What a file or folder of files holds, as far as the file system knows:
    path, size and time of every file."""
    fs, p = filesystem(spark, path)
    return tuple(sorted((s.getPath().toString(), s.getLen(), s.getModificationTime()) for s in fs.listStatus(p)))


def delete(spark: SparkSession, path: str) -> None:
    fs, p = filesystem(spark, path)
    fs.delete(p, True)


def read_file(spark: SparkSession, path: str) -> str:
    """A small file's text."""
    fs, p = filesystem(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_file(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file; it must not exist."""
    fs, p = filesystem(spark, path)
    out = fs.create(p, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def rename_new(spark: SparkSession, src: str, dst: str) -> bool:
    """Rename a file; False if ``dst`` exists (never overwrites).

    Hadoop looks for ``dst`` first and then renames, so on a local disk the later
    of two writers can overwrite the earlier one's file; a hard link cannot."""
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    fs, target = filesystem(spark, dst)
    if fs.getUri().getScheme() == "file":
        local = [jvm.java.io.File(jvm.org.apache.hadoop.fs.Path(p).toUri().getPath()).toPath() for p in (dst, src)]
        try:
            jvm.java.nio.file.Files.createLink(*local)
        except Exception:  # noqa: BLE001 - py4j wraps every Java exception alike
            if fs.exists(target):
                return False               # else: a disk without links
        else:
            delete(spark, src)
            return True
    hadoop = jvm.org.apache.hadoop.fs
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    context = hadoop.FileContext.getFileContext(filesystem(spark, dst)[0].getUri(), conf)
    try:
        context.rename(hadoop.Path(src), hadoop.Path(dst), gateway.new_array(hadoop.Options.Rename, 0))
    except Exception as e:  # noqa: BLE001 - py4j wraps every Java exception alike
        if exists(spark, dst):
            return False
        raise OSError(f"cannot rename {src} to {dst}") from e
    return True


def _numbers(spark: SparkSession, root: str) -> list[int]:
    fs, p = filesystem(spark, f"{root}/{_POINTER}")
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return sorted(int(n) for n in names if n.isdigit())


def fresh(root: str) -> str:
    """The folder of a new, unpublished version."""
    return f"{root.rstrip('/')}/{_VERSIONS}/{uuid.uuid4().hex[:12]}"


def publish(spark: SparkSession, root: str, tables: dict[str, str]) -> int:
    """Publish the tables (name -> path below ``root``) as the whole set and
    return the pointer's number; then drop versions that are out of date."""
    root = root.rstrip("/")
    for path in tables.values():
        if not path.startswith(root + "/"):
            raise ValueError(f"{path} is not below {root}")
    body = json.dumps({n: p[len(root) + 1:] for n, p in tables.items()}, sort_keys=True)
    draft = f"{root}/{_POINTER}/_{uuid.uuid4().hex}"
    write_file(spark, draft, body)
    while True:
        number = (_numbers(spark, root) or [0])[-1] + 1
        if rename_new(spark, draft, f"{root}/{_POINTER}/{number}"):
            break
    _drop_old(spark, root)
    return number


def current(spark: SparkSession, root: str) -> dict[str, str] | None:
    """The published tables (name -> path), None if nothing is published."""
    root = root.rstrip("/")
    while numbers := _numbers(spark, root):
        try:
            body = read_file(spark, f"{root}/{_POINTER}/{numbers[-1]}")
        except Exception:  # noqa: BLE001 - out of date since it was listed
            if _numbers(spark, root)[-1:] == numbers[-1:]:
                raise
            continue
        return {n: f"{root}/{p}" for n, p in json.loads(body).items()}
    return None


def _version_of(path: str) -> str:
    return path.split(f"{_VERSIONS}/", 1)[1].split("/", 1)[0]


def _drop_old(spark: SparkSession, root: str) -> None:
    """Remove pointers and versions before the last KEEP; a version that was
    never published stays (its writer may still be at work, or its checks
    failed and someone wants to see it)."""
    numbers = _numbers(spark, root)
    old, kept = numbers[:-KEEP], set()
    for n in numbers[-KEEP:]:
        kept |= {_version_of(p) for p in json.loads(read_file(spark, f"{root}/{_POINTER}/{n}")).values()}
    for n in old:
        gone = {_version_of(p) for p in json.loads(read_file(spark, f"{root}/{_POINTER}/{n}")).values()}
        for version in gone - kept:
            delete(spark, f"{root}/{_VERSIONS}/{version}")
        delete(spark, f"{root}/{_POINTER}/{n}")
