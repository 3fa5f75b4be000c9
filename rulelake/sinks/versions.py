"""Versioned tables: several tables that change together.

A folder holds

- ``data/<write>/<table>/bucket=<n>`` (``bucket_`` beside a column of that name): Parquet files of one write, never
  changed afterwards;
- ``versions/v=<number>``: one line of JSON naming, for every table, its
  schema and the writes its buckets are in.

The line is written last, so it is the commit of all tables of a version: a
run that dies before it leaves files that no version names, and readers go on
with the version before. A later version names the unchanged buckets of the
earlier one again, so an update writes only the buckets it changes.

Rows of a keyed table are dealt over ``buckets`` by the hash of the key; choose
so many that a bucket stays below about 1 GB. A table without a key is one
bucket of as many files as Spark writes. The line grows with buckets times
writes, never with rows.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Collection, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

BUCKETS = 64


@dataclass(frozen=True)
class Table:
    """What a version says about one table: ``writes`` maps a write to the buckets read from it."""
    schema: str
    key: list[str]
    buckets: int
    writes: dict[str, list[int]]

    def struct(self) -> StructType:
        return StructType.fromJson(json.loads(self.schema))


@dataclass(frozen=True)
class Version:
    base: str
    number: int
    tables: dict[str, Table] = field(default_factory=dict)


def bucket_of(key: Sequence[str], buckets: int) -> Column:
    """The bucket of a row; null keys have one too."""
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")


def _folder(columns: Sequence[str]) -> str:
    """The name of the bucket folders, which no column of the table has."""
    name, taken = "bucket", {c.lower() for c in columns}
    while name in taken:
        name += "_"
    return name


def newest(spark: SparkSession, base: str, below: int | None = None) -> Version | None:
    """The newest complete version (below a number), None where there is none.

    Only file names are listed; of the lines, the newest is read. A line that
    is cut off is not a version.
    """
    try:
        files = spark.read.option("recursiveFileLookup", "true").text(f"{base}/versions").inputFiles()
    except AnalysisException:
        return None
    numbers = {int(m.group(1)) for m in (re.search(r"/v=(-?\d+)/[^/]*$", f) for f in files) if m}
    for number in sorted(numbers, reverse=True):
        if below is None or number < below:
            version = _read_line(spark, base, number)
            if version is not None:
                return version
    return None


def _read_line(spark: SparkSession, base: str, number: int) -> Version | None:
    row = spark.read.option("wholetext", "true").text(f"{base}/versions/v={number}").first()
    try:
        line = json.loads(row["value"]) if row else {}
    except ValueError:
        return None
    if line.get("number") != number:
        return None
    return Version(base, number, {name: Table(**t) for name, t in line["tables"].items()})


def read(spark: SparkSession, version: Version, name: str, buckets: Collection[int] | None = None) -> DataFrame:
    """A table of a version, or some of its buckets (a table without rows has its columns)."""
    table = version.tables[name]
    folder = _folder(table.struct().names)
    paths = [f"{version.base}/data/{write}/{name}/{folder}={b}" for write, held in table.writes.items()
             for b in held if buckets is None or b in buckets]
    if not paths:
        return spark.createDataFrame([], table.struct())
    return spark.read.schema(table.struct()).parquet(*paths)


def write_table(spark: SparkSession, base: str, name: str, df: DataFrame, key: Sequence[str] = (),
                buckets: int = BUCKETS) -> Table:
    """Write a table's rows under a write of their own; no version names them yet."""
    write = uuid.uuid4().hex
    path = f"{base}/data/{write}/{name}"
    key, folder = list(key), _folder(df.columns)
    if key:
        dealt = df.withColumn(folder, bucket_of(key, buckets)).repartition(folder)
    else:
        buckets, dealt = 1, df.withColumn(folder, F.lit(0))
    dealt.write.partitionBy(folder).parquet(path)
    held: list[int] = []
    try:  # the names of the buckets, from the folder
        files = spark.read.schema(df.schema).option("recursiveFileLookup", "true").parquet(path).inputFiles()
        held = sorted({int(m.group(1)) for m in (re.search(rf"/{folder}=(\d+)/[^/]*$", f) for f in files) if m})
    except AnalysisException:
        pass
    return Table(df.schema.json(), key, buckets, {write: held} if held else {})


def replaced(old: Table, new: Table, buckets: Collection[int]) -> Table:
    """``old`` with these buckets taken from ``new`` (gone where ``new`` has no rows in them)."""
    writes = {w: [b for b in held if b not in buckets] for w, held in old.writes.items()}
    writes = {w: held for w, held in writes.items() if held} | new.writes
    return Table(new.schema, old.key, old.buckets, writes)


def appended(old: Table, new: Table) -> Table:
    """The rows of both."""
    return Table(new.schema, old.key, old.buckets, old.writes | new.writes)


def commit(spark: SparkSession, base: str, number: int, tables: dict[str, Table]) -> Version:
    """Name the tables of a version: from here on readers see all of them together."""
    line = json.dumps({"tables": {n: t.__dict__ for n, t in tables.items()}, "number": number})
    spark.createDataFrame([(line,)], "value string").coalesce(1).write.mode("overwrite").text(
        f"{base}/versions/v={number}")
    return Version(base, number, tables)


def write_version(spark: SparkSession, base: str, tables: dict[str, DataFrame],
                  keys: dict[str, Sequence[str]] | None = None, buckets: int = BUCKETS) -> Version:
    """K1: all tables of a run as the next version. Tables that an earlier
    version has and this run does not write stay as they are."""
    before = newest(spark, base)
    written = {name: write_table(spark, base, name, df, (keys or {}).get(name, ()), buckets)
               for name, df in tables.items()}
    return commit(spark, base, before.number + 1 if before else 0, (before.tables if before else {}) | written)


def read_version(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    """The tables of the newest complete version (none: an empty dictionary, the run starts afresh)."""
    version = newest(spark, base)
    return {name: read(spark, version, name) for name in version.tables} if version else {}
