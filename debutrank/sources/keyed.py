"""Tables that are changed by key: hash buckets of the key, and versions that only one writer can publish.

A version is a small file that names, for every bucket, the folder with its rows. A change reads the
buckets of the keys it touches, writes these anew beside the old ones and publishes the next
version; all other buckets keep their files. A version is published by renaming a file to a name that
must be free: of two writers that started from one version the second is refused, reads what the first has
published and does its change again, so neither is lost. Readers see one version or the next, also while
a change is written and after a writer was lost half-way. (Overwriting partitions in place
would be shorter, but a reader could see half of it, and so would everyone after a lost driver.)
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

BUCKETS = 64
KEPT_VERSIONS = 2  # older ones are dropped by ``clean``
_BUCKET = "_bucket"


class Version(NamedTuple):
    """What a version file says."""

    number: int
    key: list[str]
    buckets: int
    schema: StructType
    folders: dict[int, str]  # of the buckets that have rows, below the table

    def to_json(self) -> str:
        named = {str(b): f for b, f in sorted(self.folders.items())}
        return json.dumps(self._asdict() | {"schema": self.schema.jsonValue(), "folders": named})


class Taken(Exception):
    """Another writer has published the version."""


def _hadoop(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def _version_files(spark: SparkSession, path: str) -> list[str]:
    _, files, folder = _hadoop(spark, f"{path}/_versions")
    if not files.exists(folder):
        return []
    names = [str(s.getPath().getName()) for s in files.listStatus(folder)]
    return sorted(n for n in names if n.endswith(".json") and not n.startswith("."))


def _load(spark: SparkSession, path: str, name: str) -> Version:
    jvm, files, file = _hadoop(spark, f"{path}/_versions/{name}")
    stream = files.open(file)
    try:
        said = json.loads(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
    said["schema"] = StructType.fromJson(said["schema"])
    said["folders"] = {int(b): f for b, f in said["folders"].items()}
    return Version(**said)


def version(spark: SparkSession, path: str) -> Version:
    """The newest version of a table."""
    names = _version_files(spark, path)
    if not names:
        raise FileNotFoundError(f"no table in {path}")
    return _load(spark, path, names[-1])


def _publish(spark: SparkSession, path: str, new: Version) -> None:
    """Make a version visible, or raise ``Taken`` if that number is there already."""
    jvm, files, draft = _hadoop(spark, f"{path}/_versions/.{uuid.uuid4().hex}")
    stream = files.create(draft, False)
    try:
        stream.write(bytearray(new.to_json().encode()))
    finally:
        stream.close()
    target = jvm.org.apache.hadoop.fs.Path(f"{path}/_versions/{new.number:08}.json")
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        draft.toUri(), spark.sparkContext._jsc.hadoopConfiguration()
    )
    # Without options a rename fails if the target exists.
    options = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(draft, target, options)
    except Py4JJavaError as refused:
        files.delete(draft, False)
        if "FileAlreadyExistsException" in refused.java_exception.toString():
            raise Taken(f"version {new.number} of {path}") from refused
        raise


def bucket_of(key: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")


def _write(rows: DataFrame, path: str, name: str, key: Sequence[str], buckets: int) -> dict[int, str]:
    """Rows in a new folder, a sub-folder per bucket; the buckets that have rows and their folders."""
    spark = rows.sparkSession
    dealt = rows.withColumn(_BUCKET, bucket_of(key, buckets))
    # A bucket is a hash range of the key, so a hot key is one row and buckets are alike; adaptive
    # execution splits or joins them by size.
    dealt.repartition(_BUCKET).sortWithinPartitions(_BUCKET, *key).write.partitionBy(_BUCKET).parquet(f"{path}/{name}")
    _, files, folder = _hadoop(spark, f"{path}/{name}")
    found = [str(s.getPath().getName()) for s in files.listStatus(folder)]
    return {int(f.split("=")[1]): f"{name}/{f}" for f in found if f.startswith(f"{_BUCKET}=")}


def _new_name() -> str:
    return f"data/{uuid.uuid4().hex}"


def _drop(spark: SparkSession, place: str) -> None:
    _, files, folder = _hadoop(spark, place)
    files.delete(folder, True)


def create(rows: DataFrame, path: str, key: Sequence[str], buckets: int = BUCKETS) -> Version:
    """A new table of rows with unique keys; ``Taken`` if there is one already."""
    spark = rows.sparkSession
    if _version_files(spark, path):
        raise Taken(f"a table in {path}")
    new = Version(0, list(key), buckets, rows.schema, _write(rows, path, _new_name(), key, buckets))
    _publish(spark, path, new)
    return new


def read(spark: SparkSession, path: str, of: Version | None = None, only: Sequence[int] | None = None) -> DataFrame:
    """The rows of the newest version, or of the given one; ``only`` some buckets of it."""
    of = of or version(spark, path)
    folders = [f"{path}/{f}" for b, f in of.folders.items() if only is None or b in only]
    if not folders:
        return spark.createDataFrame([], of.schema)
    return spark.read.schema(of.schema).parquet(*folders)


def change(
    spark: SparkSession, path: str, touched: DataFrame, make: Callable[[DataFrame], DataFrame], attempts: int = 20
) -> Version:
    """Replace the rows of the touched buckets by what ``make`` makes of them.

    ``touched`` has the key columns of all rows that ``make`` may add, change or drop (repeats are fine); ``make`` gets
    the present rows of their buckets and returns these buckets' rows. It is called again, on the newer
    rows, where another writer was first. A change that touches nothing publishes nothing.
    """
    for _ in range(attempts):
        old = version(spark, path)
        hit = touched.select(bucket_of(old.key, old.buckets).alias("b")).distinct().collect()
        buckets = {r.b for r in hit}
        if not buckets:
            return old
        rows = make(read(spark, path, old, sorted(buckets))).select(*old.schema.names)
        name = _new_name()
        written = _write(rows, path, name, old.key, old.buckets)
        if set(written) - buckets:
            _drop(spark, f"{path}/{name}")
            raise ValueError("a change has made rows of keys that it does not touch")
        kept = {b: f for b, f in old.folders.items() if b not in buckets}
        new = old._replace(number=old.number + 1, folders=kept | written)
        try:
            _publish(spark, path, new)
        except Taken:
            _drop(spark, f"{path}/{name}")
            continue
        return new
    raise Taken(f"{attempts} attempts to change {path}")


def clean(spark: SparkSession, path: str, keep: int = KEPT_VERSIONS) -> None:
    """Drop all but the newest versions, and the folders that only these have named.

    Folders that no version names are left alone: a writer may be about to publish them.
    """
    names = _version_files(spark, path)
    old, kept = names[:-keep], names[-keep:]
    needed = {f for n in kept for f in _load(spark, path, n).folders.values()}
    for name in old:
        for folder in set(_load(spark, path, name).folders.values()) - needed:
            _drop(spark, f"{path}/{folder}")
        _drop(spark, f"{path}/_versions/{name}")
