"""What the operators share: text columns, the cluster's shared folder, size-checked joins."""

from __future__ import annotations

import atexit
import contextlib
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A word is a run of anything but these six characters.
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
#: A side of a join is broadcast only when it has been counted and stays below this.
BROADCAST_BYTES = 16 << 20


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def text_of(name: str = "text") -> Column:
    """The text column with null as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def lower_az(text: Column) -> Column:
    """Lower-case A-Z only; other letters stay."""
    return F.translate(text, UPPER, LOWER)


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where it is unset, as in tests, one of our own if everything runs on this machine."""
    sc = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not found:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="sparkweft-")
        atexit.register(shutil.rmtree, found, ignore_errors=True)
        sc.setCheckpointDir(found)
        found = sc.getCheckpointDir()
    return found.rstrip("/")


def shared_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder below shared_root(); the driver removes it when the application ends."""
    path = qualified(spark, f"{shared_root(spark)}/sparkweft/{label}-{uuid.uuid4().hex}")
    local = local_path(path)
    if local:
        os.makedirs(local, exist_ok=True)
        atexit.register(shutil.rmtree, local, ignore_errors=True)
    return path


def qualified(spark: SparkSession, path: str) -> str:
    """path with the scheme of the file system it belongs to; without one it is of the session's default file system."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    plain = jvm.org.apache.hadoop.fs.Path(path)
    return plain.getFileSystem(conf).makeQualified(plain).toString()


def local_path(uri: str) -> str | None:
    """The path that open() takes if the folder is mounted on every machine (file:), else None."""
    return "/" + uri[5:].lstrip("/") if uri.startswith("file:") else None


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write df once into the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = shared_folder(spark, label)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def shuffles_given_back(spark: SparkSession) -> Iterator[None]:
    """What is planned and run inside gives its shuffle files back when its action ends, instead of when the driver happens to collect its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def unused(taken: list[str], *wanted: str) -> list[str]:
    """wanted, each with underscores put before it until no column of `taken` has that name (in any case of letters)."""
    names = {c.lower() for c in taken}
    out = []
    for name in wanted:
        while name.lower() in names:
            name = "_" + name
        out.append(name)
        names.add(name.lower())
    return out


#: What a hot key's rows are spread over.
_SPREAD = 4096


def join_weighted(rows: DataFrame, table: DataFrame, key: str, weight: str, spread_by: Column) -> DataFrame:
    """rows that have a match, with the columns of table (one row a key, weight: how many of rows have it), joined by key.

    Keys that hold a thousandth of all rows or more are a thousand at the most: they are broadcast, and their rows are
    spread by spread_by where the others are shuffled to their keys, so no task gets all rows of a key. rows is read once.
    """
    total = table.agg(F.sum(weight)).first()[0] or 0
    values = [c for c in table.columns if c != key]
    hot_names, (slot,) = unused([*rows.columns, *table.columns], *(f"_hot_{c}" for c in values)), unused([*rows.columns, *table.columns], "_slot")
    hot = table.filter(F.col(weight) * 1000 >= total).withColumnsRenamed(dict(zip(values, hot_names, strict=True)))
    cold = table.filter(F.col(weight) * 1000 < total).withColumn(slot, F.lit(0))
    is_hot = F.col(hot_names[values.index(weight)]).isNotNull()
    joined = rows.join(F.broadcast(hot), key, "left").withColumn(slot, F.when(is_hot, F.pmod(spread_by, F.lit(_SPREAD)).cast("int") + 1).otherwise(0)).join(cold, [key, slot], "left")
    both = {c: F.coalesce(F.col(c), F.col(h)) for c, h in zip(values, hot_names, strict=True)}
    return joined.withColumns(both).filter(F.col(weight).isNotNull()).drop(slot, *hot_names)


def drop_rows(docs: DataFrame, dropped: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without the rows named in `dropped` (id, fingerprint of the text; see row_key).

    `dropped` is written once and counted. Below BROADCAST_BYTES it is broadcast, so that whole texts
    need no shuffle; beyond it the anti-join is a shuffle join that Spark may split where it is skewed.
    Nulls in the id match nulls. Columns of docs may have any names.
    """
    gone_id, gone_text, row_id, row_text = unused(docs.columns, "_gone_id", "_gone_text", "_row_id", "_row_text")
    gone = materialise(dropped.select(F.col("key_id").alias(gone_id), F.col("key_text").alias(gone_text)).distinct(), "dropped")
    small = gone.count() * 48 < BROADCAST_BYTES
    keyed = docs.select("*", *(c.alias(n) for c, n in zip(row_key(id_col, text_col), (row_id, row_text), strict=True)))
    same = F.col(row_id).eqNullSafe(F.col(gone_id)) & (F.col(row_text) == F.col(gone_text))
    return keyed.join(F.broadcast(gone) if small else gone, same, "left_anti").drop(row_id, row_text)


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one row of those that repeat an id and a text, whatever their other columns.

    Repeated keys are found from ids and hashes alone; only their rows are grouped (whole texts compared), after
    combining within tasks. Without any, docs comes back as it is.
    """
    keys = docs.select(*row_key(id_col, text_col)).groupBy("key_id", "key_text").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    repeated = materialise(keys, "repeated")
    if repeated.isEmpty():
        return docs
    names = unused(docs.columns, "_key", "_norm", "_row")
    key, norm, row = names
    rest = drop_rows(docs, repeated, id_col, text_col)
    small = repeated.count() * 48 < BROADCAST_BYTES
    keyed = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias(row), F.struct(*row_key(id_col, text_col)).alias(key), text_of(text_col).alias(norm))
    ours = keyed.join(F.broadcast(repeated) if small else repeated, F.col(f"{key}.key_id").eqNullSafe(F.col("key_id")) & (F.col(f"{key}.key_text") == F.col("key_text")), "left_semi")
    return rest.unionByName(ours.groupBy(key, norm).agg(F.first(row).alias(row)).select(f"{row}.*"))


def row_key(id_col: str = "doc_id", text_col: str = "text") -> tuple[Column, Column]:
    """What identifies a row for drop_rows: its id and a 64-bit hash of its text."""
    return F.col(id_col).alias("key_id"), F.xxhash64(text_of(text_col)).alias("key_text")
