"""Full override (K1): replace a target by a new snapshot without ever
writing over the data being read.

Two forms:

* ``override_partitions`` - many connections in one table partitioned by
  ``connection_id``: dynamic partition overwrite replaces exactly the
  connections present in the new data and leaves the others untouched;
  connections named as ``replaced`` whose snapshot is empty lose their rows.
* ``write_version`` / ``current_version`` - one target kept as immutable
  version directories ``<target>/version=<n>``; a reader takes the newest
  version whose ``_SUCCESS`` marker exists, so a failed write is never seen
  and the previous version stays readable while the new one is written.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

VERSION_PREFIX = "version="


def override_partitions(df: DataFrame, target: str, partition_cols: list[str],
                        fmt: str = "parquet", options: dict | None = None, replaced=()) -> str:
    """``replaced``: values of the first partition column that are overridden
    even when ``df`` has no row of them (an iterable; taken one at a time)."""
    spark = df.sparkSession
    column = partition_cols[0]
    fs, root, jvm = _hadoop_fs(spark, target)
    before = {}
    for value in replaced:
        place = jvm.org.apache.hadoop.fs.Path(root, f"{column}={_escaped(jvm, value)}")
        if fs.exists(place):
            before[value] = (place, {f.getPath().getName() for f in fs.listStatus(place)})
    (df.write.mode("overwrite").options(**(options or {})).option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_cols).format(fmt).save(target))
    for place, names in before.values():
        # a partition that was written anew has other files (names carry the write's id)
        if fs.exists(place) and {f.getPath().getName() for f in fs.listStatus(place)} == names:
            fs.delete(place, True)
    return target


def _escaped(jvm, value: str) -> str:
    return jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(str(value))


# Fixed value: the characters that partition directories hold as %XX.
_HIDDEN = re.compile(r"""[\x00-\x1f"#%'*/:=?\\\x7f{\[\]^]""")


def escaped(value: str) -> str:
    """A value as the part of a directory name that a partition holds."""
    return _HIDDEN.sub(lambda m: f"%{ord(m[0]):02X}", value)


def _hadoop_fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf), p, jvm


def _versions(spark: SparkSession, target: str) -> list[int]:
    """Every version directory, complete or not, ascending (one listing)."""
    fs, root, _ = _hadoop_fs(spark, target)
    if not fs.exists(root):
        return []
    names = [st.getPath().getName() for st in fs.listStatus(root) if st.isDirectory()]
    return sorted(int(n[len(VERSION_PREFIX):]) for n in names if n.startswith(VERSION_PREFIX))


def _complete(spark: SparkSession, target: str, version: int) -> bool:
    fs, root, jvm = _hadoop_fs(spark, target)
    return fs.exists(jvm.org.apache.hadoop.fs.Path(root, f"{VERSION_PREFIX}{version}/_SUCCESS"))


def list_versions(spark: SparkSession, target: str) -> list[int]:
    """Complete versions (``_SUCCESS`` present), ascending."""
    return [v for v in _versions(spark, target) if _complete(spark, target, v)]


def remove_old_versions(spark: SparkSession, target: str, keep: int = 2) -> int:
    """Delete all complete versions but the newest ``keep`` (at least one);
    returns how many. For a time when nothing reads an older version."""
    fs, root, jvm = _hadoop_fs(spark, target)
    old = list_versions(spark, target)[:-max(keep, 1)]
    for v in old:
        fs.delete(jvm.org.apache.hadoop.fs.Path(root, f"{VERSION_PREFIX}{v}"), True)
    return len(old)


def write_version(df: DataFrame, target: str, fmt: str = "parquet", version: int | None = None) -> str:
    """Write ``df`` as the next version of ``target`` (or as the given
    ``version``, replacing an incomplete attempt at it); return its path."""
    if version is None:
        version = max(_versions(df.sparkSession, target), default=0) + 1
        mode = "errorifexists"
    else:
        mode = "overwrite"
    path = f"{target.rstrip('/')}/{VERSION_PREFIX}{version}"
    df.write.mode(mode).format(fmt).save(path)
    return path


def current_version(spark: SparkSession, target: str) -> str | None:
    newest = next((v for v in reversed(_versions(spark, target)) if _complete(spark, target, v)), None)
    return None if newest is None else f"{target.rstrip('/')}/{VERSION_PREFIX}{newest}"


def read_current(spark: SparkSession, target: str, fmt: str = "parquet") -> DataFrame:
    path = current_version(spark, target)
    if path is None:
        raise FileNotFoundError(f"no complete version under {target}")
    return spark.read.format(fmt).load(path)
