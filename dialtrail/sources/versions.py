"""Folders that are replaced as a whole or not at all.

What is kept at a path lies in folders of their own under ``versions``, one for
each write, and a line in ``manifest`` is added once all of a folder is there.
Readers follow the manifest, so a write that breaks off leaves what was there
before. The last line counts; of two writers at the same moment one wins, and
either's version is whole. A version whose folder has since lost files is passed
over for the one before. Nothing is deleted: ``old_versions`` names the folders
that a caller may remove.
"""

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST = "sequence bigint, token string, files bigint, built_from string"


@dataclass(frozen=True)
class Version:
    sequence: int
    token: str  # the name of its folder
    path: str
    built_from: str | None


def folder_of(path: str, token: str) -> str:
    return f"{path.rstrip('/')}/versions/{token}"


def n_files(spark: SparkSession, folder: str) -> int | None:
    """Data files in a folder and those below it; none if it is not there."""
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    try:
        return len(listing.load(folder).inputFiles())
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def _manifest(spark: SparkSession, path: str) -> DataFrame | None:
    folder = f"{path.rstrip('/')}/manifest"
    if n_files(spark, folder) is None:
        return None
    lines = spark.read.schema(MANIFEST).option("mode", "DROPMALFORMED").json(folder)
    return lines.filter(F.col("sequence").isNotNull() & F.col("token").isNotNull())


def versions(spark: SparkSession, path: str) -> list[Version]:
    """All versions that are whole, the newest first (a line per write is read)."""
    manifest = _manifest(spark, path)
    if manifest is None:
        return []
    lines = manifest.orderBy(F.desc("sequence"), F.desc("token")).collect()
    return [
        Version(line.sequence, line.token, folder_of(path, line.token), line.built_from)
        for line in lines
        if n_files(spark, folder_of(path, line.token)) == line.files
    ]


def current(spark: SparkSession, path: str) -> Version | None:
    """The newest version that is whole."""
    manifest = _manifest(spark, path)
    if manifest is None:
        return None
    newest_first = manifest.orderBy(F.desc("sequence"), F.desc("token"))
    for line in newest_first.toLocalIterator():
        folder = folder_of(path, line.token)
        if n_files(spark, folder) == line.files:
            return Version(line.sequence, line.token, folder, line.built_from)
    return None


def old_versions(spark: SparkSession, path: str) -> list[str]:
    """Folders of all whole versions but the newest."""
    return [version.path for version in versions(spark, path)[1:]]


def commit(
    spark: SparkSession,
    path: str,
    write: Callable[[str], None],
    built_from: str | None = None,
) -> Version:
    """Have ``write`` fill a new folder, then make that the current version."""
    token = uuid.uuid4().hex
    folder = folder_of(path, token)
    write(folder)
    files = n_files(spark, folder)
    manifest = _manifest(spark, path)
    last = None if manifest is None else manifest.agg(F.max("sequence")).first()[0]
    line = Version((last or 0) + 1, token, folder, built_from)
    spark.sql(
        "SELECT CAST(:sequence AS bigint) sequence, :token token, CAST(:files AS bigint) files, "
        "CAST(:built_from AS string) built_from",
        {"sequence": line.sequence, "token": token, "files": files, "built_from": built_from},
    ).write.mode("append").json(f"{path.rstrip('/')}/manifest")
    return line
