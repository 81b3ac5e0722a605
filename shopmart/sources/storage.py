"""Writing tables: databases, replace, view and keyed append."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from shopmart.session import cut_lineage, shuffles_freed

LAYERS = ("bronze", "silver", "gold")


def create_layers(spark: SparkSession) -> None:
    for layer in LAYERS:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def replace_table(
    df: DataFrame, name: str, bucket_by: str | None = None, buckets: int = 0, path: str | None = None
) -> DataFrame:
    """Create or replace a table; bucketing saves later shuffles on that key.

    Rows are brought together by bucket before writing, so there is one file
    per bucket and not one per bucket and task. One value of the key must fit
    into one task.
    """
    if bucket_by:
        df = df.repartition(buckets, bucket_by)
    writer = df.write.mode("overwrite").format("parquet")
    if bucket_by:
        writer = writer.bucketBy(buckets, bucket_by).sortBy(bucket_by)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def materialize(
    df: DataFrame, name: str, as_view: bool = False, bucket_by: str | None = None, buckets: int = 0
) -> DataFrame:
    """A model's result as stored table or, for cheap models, as view."""
    if as_view:
        df.createOrReplaceTempView(name.replace(".", "_"))
        return df
    return replace_table(df, name, bucket_by if buckets else None, buckets)


# ---------------------------------------------------------------- keyed append

# Columns that a keyed table has besides its own.
MONTH, DIGEST = "load_month", "load_digest"
NO_MONTH = "none"


class LoadRunning(RuntimeError):
    """Another load writes to the table."""


class KeyedTable:
    """Rows with unique keys, appended load by load.

    Rows lie in folders by the month of `moment`, a column that does not change
    for a key, so a load meets the stored rows of its own months only. Beside the
    rows there is a list of the loads that are done, and a lock while one runs.
    """

    def __init__(self, spark: SparkSession, path: str, schema: StructType, keys: Sequence[str], moment: str | None = None):
        self.spark, self.path, self.keys, self.moment = spark, path, list(keys), moment
        self.schema = schema
        self._files = spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    def _stored(self) -> DataFrame:
        kept = [*self.schema.fields, StructField(DIGEST, LongType()), StructField(MONTH, StringType())]
        if not self._files.exists(self._at("rows")):
            return self.spark.createDataFrame([], StructType(kept))
        return self.spark.read.schema(StructType(kept)).parquet(f"{self.path}/rows")

    def rows(self) -> DataFrame:
        return self._stored().drop(MONTH, DIGEST)

    def is_done(self, load: str) -> bool:
        return self._files.exists(self._at(f"loads/{load}"))

    @contextmanager
    def _locked(self) -> Iterator[None]:
        """Only one load at a time; a lock that a lost driver left must be removed by hand."""
        lock = self._at("lock")
        try:
            self._files.create(lock, False).close()
        except Exception as error:
            if self._files.exists(lock):
                raise LoadRunning(f"{self.path} is being loaded") from error
            raise
        try:
            yield
        finally:
            self._files.delete(lock, False)

    def winners(self, df: DataFrame, newest: Sequence[str] = ()) -> DataFrame:
        """One row per key: the greatest by `newest`, then by a hash of the row, so always the same one.

        Keys are counted first; whole rows are grouped only where a digest repeats.
        """
        rows = self._marked(df)
        counted = rows.groupBy(DIGEST, *self.keys).agg(F.count("*").alias("n"))
        repeated = cut_lineage(counted.where("n > 1").select(DIGEST).distinct())
        chosen = self._greatest(rows.join(repeated, DIGEST, "left_semi"), df.columns, newest)
        return rows.join(repeated, DIGEST, "left_anti").select(rows.columns).unionByName(chosen)

    def _marked(self, df: DataFrame) -> DataFrame:
        month = F.date_format(self.moment, "'m'yyyy-MM") if self.moment else F.lit(None).cast("string")
        return df.select("*", F.xxhash64(*self.keys).alias(DIGEST), F.coalesce(month, F.lit(NO_MONTH)).alias(MONTH))

    def _greatest(self, rows: DataFrame, columns: Sequence[str], newest: Sequence[str]) -> DataFrame:
        order = F.struct(*newest, F.xxhash64(*columns))
        winner = F.max_by(F.struct(*columns, DIGEST, MONTH), order).alias("winner")
        return rows.groupBy(DIGEST, *self.keys).agg(winner).select("winner.*")

    def unknown(self, batch: DataFrame, months: Sequence[str]) -> DataFrame:
        """Rows of the batch whose keys are not stored; only the given months are read.

        Most keys are told new by the digests alone. The keys themselves are
        compared, null with null, for the others. Whole rows meet nothing but
        the keys that were found.
        """
        stored = self._stored().where(F.col(MONTH).isin(*months))
        maybe = batch.select(MONTH, DIGEST, *self.keys).join(stored.select(MONTH, DIGEST).distinct(), [MONTH, DIGEST], "left_semi")
        known = stored.select(F.col(DIGEST).alias("stored_digest"), *[F.col(k).alias(f"stored_{k}") for k in self.keys])
        found = maybe.join(known, self._same(maybe, known), "left_semi")
        found = found.select(F.col(DIGEST).alias("stored_digest"), *[F.col(k).alias(f"stored_{k}") for k in self.keys])
        return batch.join(found, self._same(batch, found), "left_anti")

    def _same(self, batch: DataFrame, stored: DataFrame) -> Column:
        same = batch[DIGEST] == stored["stored_digest"]
        for k in self.keys:
            same &= batch[k].eqNullSafe(stored[f"stored_{k}"])
        return same

    def load(self, df: DataFrame, load: str, newest: Sequence[str] = ()) -> None:
        """Appends the rows with keys that are not stored yet; a load that is done is not looked at again.

        What is new is found by the keys alone. Whole rows of months that have new keys meet these once, and not at all
        where every key is new and comes once. A load that broke off may be repeated: what it has written is known by
        its keys.
        """
        if self.is_done(load):
            return
        with self._locked():
            rows = self._marked(df)
            counted = rows.groupBy(DIGEST, *self.keys).agg(F.count("*").alias("n"), F.collect_set(MONTH).alias("months"))
            keys = cut_lineage(counted.select(F.explode("months").alias(MONTH), DIGEST, *self.keys, "n"))
            months = [r[0] for r in keys.select(MONTH).distinct().collect()]  # as many as the calendar has
            fresh = cut_lineage(self.unknown(keys, months)) if self._files.exists(self._at("rows")) else keys
            found = fresh.groupBy(MONTH).agg(F.count("*"), F.max("n")).collect()
            if found:
                asked = [r[0] for r in found]
                rows = rows.where(F.col(MONTH).isin(*asked))
                if keys.where(F.col(MONTH).isin(*asked)).count() > sum(r[1] for r in found) or max(r[2] for r in found) > 1:
                    rows = cut_lineage(self._of_keys(rows, fresh, df.columns, newest))
                # A large month is written by several tasks, small ones by one.
                with shuffles_freed(self.spark):
                    rows.hint("rebalance", MONTH).write.mode("append").partitionBy(MONTH).parquet(f"{self.path}/rows")
            self._files.create(self._at(f"loads/{load}"), True).close()

    def _of_keys(self, rows: DataFrame, keys: DataFrame, columns: Sequence[str], newest: Sequence[str]) -> DataFrame:
        """The rows of the given keys, of several the greatest; `n` tells which keys have several."""
        names = {DIGEST: "stored_digest", **{k: f"stored_{k}" for k in self.keys}}
        asked = keys.select("n", F.col(MONTH).alias("asked_month"), *[F.col(c).alias(name) for c, name in names.items()])
        met = rows.join(asked, self._same(rows, asked) & (rows[MONTH] == asked["asked_month"])).select(*rows.columns, "n")
        chosen = self._greatest(met.where("n > 1"), columns, newest)
        return met.where("n = 1").select(*rows.columns).unionByName(chosen)


def append_new(
    df: DataFrame,
    path: str,
    keys: list[str],
    moment: str | None = None,
    load: str | None = None,
    newest: Sequence[str] = (),
) -> DataFrame:
    """Append one row per key that is not stored yet and return the stored table.

    A first run writes everything. Null is a key like any other. Of several
    rows of a batch with one key the greatest by `newest` is stored. Rows of one
    key must have the same month of `moment`. A batch with the name of an
    earlier `load` adds nothing.
    """
    table = KeyedTable(df.sparkSession, path, df.schema, keys, moment)
    table.load(df, load or uuid4().hex, newest)
    return table.rows()
