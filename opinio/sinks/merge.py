"""K1 / K5 against a stored table: keyed, idempotent loads by copy on write.

A stored table is Parquet in ``parts`` folders by a hash of its key, so a key has one place. A load
reads only the parts that its keys touch, merges them into a staged copy in the shared folder and
replaces those parts by dynamic partition overwrite; all other files stay as they are. A log
beside the table names the loads that ended: running one of them again does nothing. A load
that broke off is simply run again, since merging the same rows twice changes nothing.

A load that never changes stored rows copies none either: it reads the stored keys, and adds files
with the rows of new keys to their parts.

One writer at a time; ``parts`` belongs to the table and must not change between its loads.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from ..plans.scratch import materialise

PARTS = 64
LOG_SCHEMA = "load_id string, incoming_rows long, touched_parts int"


def _read(spark: SparkSession, path: str, schema) -> DataFrame | None:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            return None
        raise


def loads(spark: SparkSession, path: str) -> DataFrame:
    """The loads of a stored table that ended: ``(load_id, incoming_rows, touched_parts)``."""
    log = _read(spark, path.rstrip("/") + "-loads", LOG_SCHEMA)
    return spark.createDataFrame([], LOG_SCHEMA) if log is None else log


def read_stored(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The rows of a stored table."""
    stored = _read(spark, path, StructType([*schema.fields]).add("_part", IntegerType()))
    return spark.createDataFrame([], schema) if stored is None else stored.drop("_part")


def _same_key(a: DataFrame, b: DataFrame, keys: list[str]):
    """Equal keys; nulls are equal to each other."""
    same = F.lit(True)
    for k in [*keys, "_part"]:
        same = same & a[k].eqNullSafe(b[f"_of_{k}"])
    return same


def _append_new(new: DataFrame, path: str, keys: list[str], schema: StructType, touched: list[int]) -> None:
    """Add the rows of ``new`` (a written table) whose keys are not stored. Contents are read and written once;
    only keys are compared."""
    spark, key, values = new.sparkSession, [*keys, "_part"], [c for c in schema.names if c not in keys]
    named = lambda df, *more: df.select(*[F.col(c).alias(f"_of_{c}") for c in key], *more)
    come = new.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
    repeated = come.where("_n > 1")
    stored = _read(spark, path, StructType([*schema.fields]).add("_part", IntegerType()))
    if stored is not None:
        held = named(stored.where(F.col("_part").isin(touched)).select(*key))
        come = materialise(come.join(held, _same_key(come, held, keys), "left_anti"), "merge-new-keys")
        n = come.count()
        if not n:
            return
        repeated = come.where("_n > 1")
        if n < new.count() or not repeated.isEmpty():
            fresh = named(come)
            new = new.join(fresh, _same_key(new, fresh, keys), "left_semi")
    if not repeated.isEmpty():
        again = named(repeated)
        value = F.struct(*values) if values else F.lit(0)
        one = (new.join(again, _same_key(new, again, keys), "left_semi").groupBy(*key).agg(F.max(value).alias("value"))
               .select(*[F.col(c) if c in keys else F.col(f"value.{c}").alias(c) for c in schema.names], "_part"))
        new = new.join(again, _same_key(new, again, keys), "left_anti").unionByName(one)
    new.repartition("_part").write.mode("append").partitionBy("_part").parquet(path)


def merge_into(incoming: DataFrame, path: str, keys: list[str], load_id: str, first_wins: tuple[str, ...] = (),
               update: bool = True, parts: int = PARTS) -> bool:
    """Merge ``incoming`` into the stored table at ``path``; False if ``load_id`` already ended.

    A key that is stored takes the incoming values, but for the columns ``first_wins``, which keep
    the stored ones (K5); with ``update=False`` stored rows stay as they are and only new keys are
    added (K1). Null keys are equal to each other. Of several incoming rows of a key, the one with the
    greatest values in column order counts.
    """
    spark = incoming.sparkSession
    if not loads(spark, path).where(F.col("load_id") == load_id).isEmpty():
        return False
    schema, values = incoming.schema, [c for c in incoming.columns if c not in keys]
    part = F.pmod(F.xxhash64(*keys), F.lit(parts)).cast("int")
    new = materialise(incoming.withColumn("_part", part), "merge-incoming")
    touched = sorted(r["_part"] for r in new.select("_part").distinct().collect())          # at most ``parts`` numbers
    rows = new.count()
    if touched and not update:
        _append_new(new, path, keys, schema, touched)
    elif touched:
        both = new.withColumn("_new", F.lit(1))
        stored = _read(spark, path, StructType([*schema.fields]).add("_part", IntegerType()))
        if stored is not None:
            both = both.unionByName(stored.where(F.col("_part").isin(touched)).withColumn("_new", F.lit(0)))
        value = F.struct(*values)
        age = F.col("_new") if update else -F.col("_new")
        merged = both.groupBy(*keys, "_part").agg(
            F.max_by(value, F.struct(age.alias("age"), value.alias("value"))).alias("last"),
            F.max_by(value, F.struct((-F.col("_new")).alias("age"), value.alias("value"))).alias("first"))
        merged = merged.select(*[F.col(c) if c in keys else F.col(f"{'first' if c in first_wins else 'last'}.{c}").alias(c)
                                 for c in incoming.columns], "_part")
        staged = materialise(merged, "merge-staged")            # the parts it replaces are read before
        (staged.repartition("_part").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("_part").parquet(path))
    spark.createDataFrame([(load_id, rows, len(touched))], LOG_SCHEMA).coalesce(1).write.mode("append").parquet(path.rstrip("/") + "-loads")
    return True
