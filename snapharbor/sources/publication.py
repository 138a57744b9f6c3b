"""Publication of a complete set of relations as Parquet.

A set is written to a folder of its own; creating one empty marker file then commits
it. Readers take the newest marker, so they see the old set or the new one, never a
mix, on file systems with or without an atomic folder rename.

Sets are numbered, and a number is claimed by a file that only one writer can create. A claim
is made when the set is complete, so the claim decides: whoever finds one without its marker
creates the marker. A writer whose set was computed from another one finds that number taken,
learns that its set is out of date and computes it again (``update_set``).
"""

from __future__ import annotations

import random
import time
import uuid
from collections.abc import Callable
from functools import partial

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

from snapharbor.session import run_together
from snapharbor.spec import PUBLISHED_RELATIONS

MARKER = "_COMMITTED-"
CLAIM = "_CLAIM-"
ANY = object()
SET_PREFIX = "set-"
# A set without a marker may still be in the making for this long.
LEASE_SECONDS = 7 * 24 * 3600


class IncompletePublicationError(ValueError):
    """The set to publish lacks relations."""


class SetConflictError(RuntimeError):
    """Another writer has published since the set to publish was computed."""


def set_path(root: str, name: str) -> str:
    return f"{root}/{SET_PREFIX}{name}"


def relation_path(folder: str, relation: str) -> str:
    return f"{folder}/analytics_{relation}"


def publish_precheck(
    tables: dict[str, DataFrame], required: tuple[str, ...] = PUBLISHED_RELATIONS
) -> None:
    missing = sorted(set(required) - set(tables))
    if missing:
        raise IncompletePublicationError(
            "cannot publish an incomplete set; missing: " + ", ".join(missing)
        )


def write_zstd_parquet(df: DataFrame, folder: str, relation: str) -> str:
    path = relation_path(folder, relation)
    df.write.mode("errorifexists").option("compression", "zstd").parquet(path)
    return path


def publish_set(
    tables: dict[str, DataFrame],
    root: str,
    required: tuple[str, ...] = PUBLISHED_RELATIONS,
    check: Callable[[dict[str, DataFrame]], object] | None = None,
    expected: str | object | None = ANY,
) -> list[str]:
    """Publish all required relations or leave the published set as it was.

    ``check`` sees the written relations before they are committed and refuses them by
    raising. Tests then read stored columns and compute no relation again. ``expected`` is the
    current set that the tables were computed from (None: there was none); if another one has
    been published since, nothing is, and SetConflictError says so. Without it the set takes
    the place of whatever is current.
    """
    publish_precheck(tables, required)
    spark = next(iter(tables.values())).sparkSession
    previous = current_set(spark, root) if expected is ANY else expected
    name = f"{_number(previous) + 1:010d}-{uuid.uuid4().hex}"
    claim = None
    try:
        paths = run_together(
            [partial(write_zstd_parquet, tables[r], set_path(root, name), r) for r in sorted(required)]
        )
        if check is not None:
            check({r: spark.read.parquet(p) for r, p in zip(sorted(required), paths)})
        if expected is not ANY:
            name, claim = _claim(spark, root, name, expected, len(required))
            paths = [relation_path(set_path(root, name), r) for r in sorted(required)]
        _commit(spark, root, name, paths)
    except BaseException as error:
        committed = _committed(spark, root)
        if name in committed:  # another writer has finished it
            raise
        if claim is not None:
            _delete(spark, claim)
        _delete(spark, set_path(root, name))
        if expected is not ANY and isinstance(error, Exception) and max(committed, default=None) != expected:
            # what was read here may have been swept since
            raise SetConflictError(f"{root} has been published since {expected}") from error
        raise
    sweep_published(spark, root, oldest_kept=min(n for n in (name, previous) if n))
    return paths


def update_set(
    spark: SparkSession,
    root: str,
    required: tuple[str, ...],
    change: Callable[[dict[str, DataFrame] | None], dict[str, DataFrame]],
    attempts: int = 50,
) -> list[str]:
    """Publish ``change(current relations)``, computed again whenever another writer was faster.

    Of several writers at once one succeeds in each round, so none waits for more rounds than
    there are writers.
    """
    for attempt in range(attempts):
        current = current_set(spark, root)
        before = None
        if current is not None:
            folder = set_path(root, current)
            before = {r: spark.read.parquet(relation_path(folder, r)) for r in required}
        try:
            return publish_set(change(before), root, required, expected=current)
        except SetConflictError:
            if attempt == attempts - 1:
                raise
            time.sleep(random.random() * min(2.0, 0.05 * 2**attempt))
    raise ValueError("attempts must be positive")


def current_set(spark: SparkSession, root: str) -> str | None:
    """Name of the published set, None before the first publication."""
    return max(_committed(spark, root), default=None)


def scan_published(spark: SparkSession, root: str, relation: str) -> DataFrame:
    name = current_set(spark, root)
    if name is None:
        raise FileNotFoundError(f"nothing is published under {root}")
    return spark.read.parquet(relation_path(set_path(root, name), relation))


def sweep_published(
    spark: SparkSession, root: str, oldest_kept: str, lease_seconds: float = LEASE_SECONDS
) -> None:
    """Remove committed sets older than ``oldest_kept``, and uncommitted ones past their lease.

    Another writer's set stays, whether it was committed after this one or is still
    being written. Markers go first, so that no reader follows one to a set that is being
    removed; the set before the current one is kept for readers that have opened it.
    """
    names = _names(spark, root)
    committed = {n.removeprefix(MARKER) for n in names if n.startswith(MARKER)}
    for name in sorted(n for n in committed if n < oldest_kept):
        _delete(spark, f"{root}/{MARKER}{name}")
        _delete(spark, set_path(root, name))
    for name in names:
        if name.startswith(CLAIM) and int(name.removeprefix(CLAIM)[:10]) < _number(oldest_kept):
            _delete(spark, f"{root}/{name}")
        if name.startswith(SET_PREFIX) and name.removeprefix(SET_PREFIX) not in committed:
            if _age(spark, f"{root}/{name}") > lease_seconds:
                _delete(spark, f"{root}/{name}")


def clear_published(spark: SparkSession, root: str) -> None:
    """Remove all sets, half-written ones included: nothing is published any more."""
    for prefix in (MARKER, CLAIM, SET_PREFIX):
        for name in _names(spark, root):
            if name.startswith(prefix):
                _delete(spark, f"{root}/{name}")


def _commit(spark: SparkSession, root: str, name: str, paths: list[str]) -> None:
    """Create the marker of a set whose relations are all there."""
    for path in paths:
        fs, done = _fs(spark, f"{path}/_SUCCESS")
        if not fs.exists(done):
            raise IncompletePublicationError(f"{path} is gone or was not written to its end")
    fs, marker = _fs(spark, f"{root}/{MARKER}{name}")
    fs.createNewFile(marker)  # another writer may have been faster


def _claim(spark: SparkSession, root: str, name: str, expected: str | None, relations: int) -> tuple[str, str]:
    """Take the number behind the expected set for a set that is complete: (its name, the claim).

    A number that another writer has claimed is lost: its set is committed if that writer has
    not done so yet. A claim whose set is gone was given up; then the next number decides.
    """
    number = _number(expected) + 1
    while True:
        if any(_number(n) > _number(expected) for n in _committed(spark, root)):
            raise SetConflictError(f"{root} has been published since {expected}")
        mine = f"{number:010d}-{name.split('-', 1)[1]}"
        if mine != name:
            fs, source = _fs(spark, set_path(root, name))
            fs.rename(source, spark._jvm.org.apache.hadoop.fs.Path(set_path(root, mine)))
            name = mine
        claim = f"{root}/{CLAIM}{number:010d}"
        if create_once(spark, claim, name):
            # a claim of a number that was swept meanwhile decides nothing
            if any(_number(n) > _number(expected) for n in _committed(spark, root) if n != name):
                _delete(spark, claim)
                continue
            return name, claim
        other = read_text(spark, claim)
        folder = set_path(root, other) if other else None
        done = [n for n in _names(spark, folder)] if folder else []
        if other is not None and len(done) == relations:
            try:
                _commit(spark, root, other, [f"{folder}/{n}" for n in done])
            except (IncompletePublicationError, Py4JJavaError):
                pass  # given up or committed meanwhile: look again
        elif other is not None:
            number += 1


def create_once(spark: SparkSession, location: str, content: str) -> bool:
    """Create a small file with its content unless it exists; one of several writers succeeds.

    The content is written beside it and moved in one step. A move never replaces a file on
    HDFS and its kin; on a local disk, where it would, a link does not.
    """
    side = f"{location}.{uuid.uuid4().hex}"
    fs, temporary = _fs(spark, side)
    out = fs.create(temporary, False)
    out.write(bytearray(content.encode()))
    out.close()
    _, target = _fs(spark, location)
    try:
        if fs.getUri().getScheme() != "file":
            return not fs.exists(target) and fs.rename(temporary, target)
        files, paths = spark._jvm.java.nio.file.Files, spark._jvm.java.io.File
        local = [paths(p.toUri().getPath() or str(p)).toPath() for p in (target, temporary)]
        try:
            files.createLink(*local)
        except Py4JJavaError as error:
            if "FileAlreadyExistsException" in str(error.java_exception):
                return False
            raise
        return True
    finally:
        _delete(spark, side)
        _delete(spark, f"{side.rsplit('/', 1)[0]}/.{side.rsplit('/', 1)[1]}.crc")


def read_text(spark: SparkSession, location: str) -> str | None:
    """Content of a small file, None if it is gone."""
    fs, path = _fs(spark, location)
    try:
        stream = fs.open(path)
    except Py4JJavaError as error:
        if "FileNotFoundException" in str(error.java_exception):
            return None
        raise
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _age(spark: SparkSession, location: str, levels: int = 4) -> float:
    """Seconds since a folder was last written to.

    A task that ends moves its output into a folder three levels below a relation, so the
    levels down to that one are looked at.
    """

    def last(path, below: int) -> int:
        found = 0
        for child in fs.listStatus(path):
            found = max(found, child.getModificationTime())
            if below and child.isDirectory():
                found = max(found, last(child.getPath(), below - 1))
        return found

    fs, top = _fs(spark, location)
    try:
        written = max(fs.getFileStatus(top).getModificationTime(), last(top, levels))
    except Py4JJavaError as error:
        if "FileNotFoundException" in str(error.java_exception):
            return 0.0  # another writer is moving or removing it just now
        raise
    return time.time() - written / 1000


def _number(name: str | None) -> int:
    return int(name.split("-")[0]) if name else 0


def _committed(spark: SparkSession, root: str) -> set[str]:
    return {n.removeprefix(MARKER) for n in _names(spark, root) if n.startswith(MARKER)}


def _names(spark: SparkSession, root: str) -> list[str]:
    fs, path = _fs(spark, root)
    return [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []


def _fs(spark: SparkSession, location: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(location)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def _delete(spark: SparkSession, location: str) -> None:
    fs, path = _fs(spark, location)
    if fs.exists(path):
        fs.delete(path, True)
