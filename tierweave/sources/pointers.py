"""Pointers to published versions: numbered files that are created once and never replaced."""

from __future__ import annotations

import json
import os
import uuid
from dataclasses import asdict, dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "number long, version string, buckets int, folders map<string,string>, watermark string"


class VersionTaken(RuntimeError):
    """Another writer has published the version number first."""


@dataclass(frozen=True)
class Pointer:
    """A version: its number and name, where its buckets lie, and the latest arrival it has seen."""

    number: int
    version: str | None
    buckets: int | None = None
    folders: dict[str, str] | None = None
    watermark: str | None = None


def pointers(spark: SparkSession, path: str) -> DataFrame:
    """All published versions."""
    try:
        return spark.read.schema(SCHEMA).json(f"{path}/_current")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], SCHEMA)


def latest(spark: SparkSession, path: str) -> Pointer:
    """The version of the highest number; number 0 where none is published."""
    row = pointers(spark, path).agg(F.max_by(F.struct("*"), "number").alias("p")).first()["p"]
    return Pointer(**row.asDict()) if row else Pointer(0, None)


def publish(spark: SparkSession, path: str, pointer: Pointer) -> Pointer:
    """Create the pointer of a number, or raise ``VersionTaken`` if it exists.

    The file is written aside and then takes its name in one step that fails if the name is taken:
    a hard link on local and mounted folders, elsewhere the file system's rename without overwrite
    (one step on HDFS; object stores need a client that offers it).
    """
    fs = spark._jvm.org.apache.hadoop.fs
    conf = spark._jsc.hadoopConfiguration()
    folder = fs.Path(f"{path}/_current")
    system = folder.getFileSystem(conf)
    system.mkdirs(folder)
    name = f"part-{pointer.number:012d}.json"
    draft, final = fs.Path(folder, f".draft-{uuid.uuid4().hex}"), fs.Path(folder, name)
    out = system.create(draft, False)
    try:
        out.write(bytearray((json.dumps(asdict(pointer)) + "\n").encode()))
    finally:
        out.close()
    try:
        if system.getScheme() == "file":
            os.link(draft.toUri().getPath(), final.toUri().getPath())
        else:
            none = spark._sc._gateway.new_array(getattr(fs, "Options$Rename"), 0)
            fs.FileContext.getFileContext(system.getUri(), conf).rename(draft, final, none)
    except FileExistsError as taken:
        raise VersionTaken(f"version {pointer.number} of {path} is published already") from taken
    except Py4JJavaError as failed:
        if "FileAlreadyExistsException" not in failed.java_exception.getClass().getName():
            raise
        raise VersionTaken(f"version {pointer.number} of {path} is published already") from failed
    finally:
        system.delete(draft, False)
    return pointer
