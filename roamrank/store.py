"""Versions of a stored model, and the pointer to the one that counts.

Every run writes a folder of its own, under a lease: a small file that says that it is
being written. Only when all of it is there, a file is replaced that names it, so a
reader sees one run's tables or another's, never both. The pointer only moves forward:
a run that began before the one it names is complete, but too late. What is deleted is
neither named nor leased, nor younger than the lease's time.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import SparkSession

from roamrank.workspace import file_system

POINTER = "current"
# A run that takes longer than this is thought to have ended without a word.
LEASE_SECONDS = 7 * 24 * 3600


def new_version(path: str) -> str:
    """A folder under ``path`` that nothing else uses; later ones sort after earlier ones."""
    return f"{path.rstrip('/')}/{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


def lease(spark: SparkSession, version: str) -> None:
    """Say that ``version`` is being written, so that no other run deletes it."""
    _write(spark, _lease_of(version), "")


def release(spark: SparkSession, version: str) -> None:
    """The run that writes or reads ``version`` has ended."""
    place, system = file_system(spark, _lease_of(version))
    system.delete(place, False)


def _lease_of(version: str) -> str:
    folder, _, name = version.rstrip("/").rpartition("/")
    return f"{folder}/.lease-{name}"


def _write(spark: SparkSession, path: str, text: str):
    place, system = file_system(spark, path)
    out = system.create(place, True)
    out.write(bytearray(text, "ascii"))
    out.close()
    return place, system


def point(spark: SparkSession, path: str, version: str) -> bool:
    """Make ``version`` the one that is read, in one step, unless that is a later one already.

    Says whether it is read now. Old versions go, but for the one before and leased ones.
    """
    name = version.rstrip("/").rpartition("/")[2]
    # One run at a time compares and sets; who finds the lock taken waits for it.
    lock = _lock(spark, path)
    try:
        before = current(spark, path, must=False)
        before = before.rpartition("/")[2] if before else None
        newer = before is None or before <= name
        if newer:
            _replace(spark, path, name)
        _tidy(spark, path, name, {name, before} if newer else {before})
    finally:
        place, system = lock
        system.delete(place, False)
    return newer


def _lock(spark: SparkSession, path: str, wait: float = 60.0):
    """A file that only one run can create; one left by a run that died goes after a while."""
    place, system = file_system(spark, f"{path.rstrip('/')}/.lock")
    until = time.monotonic() + wait
    while True:
        try:
            system.create(place, False).close()
            return place, system
        except Exception:
            if not system.exists(place):
                continue
            if time.monotonic() > until:
                system.delete(place, False)
            time.sleep(0.1)


def _replace(spark: SparkSession, path: str, name: str) -> None:
    jvm = spark._jvm
    place, system = _write(spark, f"{path.rstrip('/')}/.{POINTER}-{uuid.uuid4().hex}", name)
    target, _ = file_system(spark, f"{path.rstrip('/')}/{POINTER}")
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(system.getUri(), spark._jsc.hadoopConfiguration())
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    context.rename(system.makeQualified(place), system.makeQualified(target), how)


def _tidy(spark: SparkSession, path: str, name: str, kept: set) -> None:
    """Delete versions that are older than ``name``, not kept, and not being written."""
    folder, system = file_system(spark, path)
    found = {status.getPath().getName(): status for status in system.listStatus(folder)}
    for own, status in found.items():
        begun = own.partition("-")[0]
        if not (status.isDirectory() and begun.isdigit()) or own in kept or own >= name:
            continue
        leased = f".lease-{own}"
        if leased in found:
            if time.time() - int(begun) / 1e9 < LEASE_SECONDS:
                continue
            system.delete(found[leased].getPath(), False)
        system.delete(status.getPath(), True)


def current(spark: SparkSession, path: str, must: bool = True) -> str | None:
    """The folder of the version that counts."""
    pointer = f"{path.rstrip('/')}/{POINTER}"
    place, system = file_system(spark, pointer)
    if not must and not system.exists(place):
        return None
    return f"{path.rstrip('/')}/{spark.read.text(pointer).first()[0]}"
