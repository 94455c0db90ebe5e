"""Person and embedding caches."""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from twinfold.functions import vocabulary as V

PERSON = T.StructType(
    [
        T.StructField("iri", T.StringType(), False),
        T.StructField("name", T.StringType(), False),
        *(T.StructField(c, T.StringType()) for c in V.SCALARS),
        *(T.StructField(c, T.ArrayType(T.StringType())) for c in V.LISTS),
        T.StructField("properties", T.MapType(T.StringType(), T.ArrayType(T.StringType()))),
    ]
)
EMBEDDING = "key string, vector array<float>"


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def read_persons(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines; a missing path is empty, blank lines are skipped, an invalid line is an error."""
    if not exists(spark, path):
        return spark.createDataFrame([], PERSON)
    return spark.read.schema(PERSON).option("mode", "FAILFAST").json(path)


def write_persons(persons: DataFrame, path: str) -> None:
    persons.select(PERSON.names).write.mode("overwrite").json(path)


class EmbeddingCache:
    """key, vector of embedded texts in a folder: base-<number>-<buckets>, a table bucketed and sorted by unique keys, and
    new, what was appended since. Joins on key read the base as it lies, without a shuffle; new alone is dealt out, and
    once it holds a quarter as many rows as the base, both become the next base. Of two bases the greater number counts,
    so a compaction that dies leaves the older one; one writer at a time."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        self.spark, self.buckets = spark, buckets
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        self.fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
        self.path = str(self.fs.makeQualified(p).toString())  # a table's relative place would be the warehouse's

    @property
    def appended(self) -> str:
        return f"{self.path}/new"

    def _bases(self) -> list[str]:
        """Names of the finished bases, oldest first."""
        if not exists(self.spark, self.path):
            return []
        names = [str(f.getPath().getName()) for f in self.fs.listStatus(self.spark._jvm.org.apache.hadoop.fs.Path(self.path))]
        return sorted(n for n in names if n.startswith("base-") and exists(self.spark, f"{self.path}/{n}/_SUCCESS"))

    def base(self) -> DataFrame:
        if not (found := self._bases()):
            return self.spark.createDataFrame([], EMBEDDING)
        place, buckets = f"{self.path}/{found[-1]}", int(found[-1].split("-")[2])
        name = f"twinfold_cache_{hashlib.md5(place.encode()).hexdigest()}"
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({EMBEDDING}) USING parquet CLUSTERED BY (key) SORTED BY (key) INTO {buckets} BUCKETS LOCATION '{place}'")
        return self.spark.table(name)

    def new(self) -> DataFrame:
        """A task that ran twice may have appended twice, so one row of a key counts."""
        if not exists(self.spark, self.appended):
            return self.spark.createDataFrame([], EMBEDDING)
        return self.spark.read.schema(EMBEDDING).parquet(self.appended).dropDuplicates(["key"])

    def rows(self) -> DataFrame:
        return self.base().unionByName(self.new())

    def missing(self, keys: DataFrame) -> DataFrame:
        """The rows of keys (key, ...) that the cache lacks."""
        return keys.join(self.base().select("key"), "key", "left_anti").join(self.new().select("key"), "key", "left_anti")

    def vectors(self, keys: DataFrame) -> DataFrame:
        """keys with their vectors."""
        return keys.join(self.base(), "key").unionByName(keys.join(self.new(), "key"))

    def compact(self, share: float = 0.25) -> None:
        """Make the next base if new holds at least `share` as many rows as the base."""
        n = self.new().count()
        if not n or n < share * self.base().count():
            return
        found = self._bases()
        number = int(found[-1].split("-")[1]) + 1 if found else 1
        place, name = f"{self.path}/base-{number:06}-{self.buckets}", f"twinfold_compact_{uuid.uuid4().hex}"
        new = self.new().join(self.base().select("key"), "key", "left_anti")
        self.base().unionByName(new).repartition(self.buckets, "key").write.bucketBy(self.buckets, "key").sortBy("key").option("path", place).mode("overwrite").saveAsTable(name)
        self.spark.sql(f"DROP TABLE {name}")  # of the catalog alone: its place was given
        for old in [*found, "new"]:
            self.fs.delete(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{old}"), True)


def persons_from(spark: SparkSession, cache_path: str, fetch, use_cache: bool = True) -> DataFrame:
    """The cached persons if the cache is used and has any; else fetch()'s, saved to the cache and read back."""
    if use_cache:
        cached = read_persons(spark, cache_path)
        if not cached.isEmpty():
            return cached
    write_persons(fetch(), cache_path)
    return read_persons(spark, cache_path)
