"""Keyed tables on parquet, kept by collection: upsert, replace, clear, append, reference checks.

Parquet has no MERGE, so a write computes the new content of the collections concerned, writes it to new folders and
then points the table at them: `<table>/CURRENT` names the folders of each collection and is replaced in one step, so
readers see the old or the new content and a failed write leaves the old one. Other collections are neither read nor
written. Folders that a write replaces stay for `retain` seconds, so frames that were read before still run; a write
that finds the pointer changed since it began fails instead of losing the other's work.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkweft.schemas import TABLES


def last_of_each(rows: DataFrame, keys: list[str], seq: str | None = None) -> DataFrame:
    """Of rows with equal keys the one with the largest seq (by default the last one read)."""
    order = "_seq" if seq is None else seq
    d = rows.withColumn("_seq", F.monotonically_increasing_id()) if seq is None else rows
    w = Window.partitionBy(*keys).orderBy(F.col(order).desc())
    out = d.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")
    return out.drop("_seq") if seq is None else out


def upserted(old: DataFrame, new: DataFrame, keys: list[str], seq: str | None = None) -> DataFrame:
    """old with new's rows put in place of those with equal keys, or added."""
    fresh = last_of_each(new, keys, seq)
    fresh = fresh.drop(seq) if seq and seq not in old.columns else fresh
    return old.join(fresh.select(*keys), keys, "left_anti").unionByName(fresh)


def replaced(old: DataFrame, new: DataFrame, keys: list[str], replaced_keys: DataFrame | None = None) -> DataFrame:
    """old without any row of the replaced keys (those of new, if not given), and new's rows."""
    gone = (new if replaced_keys is None else replaced_keys).select(*keys).distinct()
    return old.join(gone, keys, "left_anti").unionByName(new)


def orphans(rows: DataFrame, parents: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys have no parent."""
    return rows.join(parents.select(*keys).distinct(), keys, "left_anti")


def without(rows: DataFrame, column: str, value: str) -> DataFrame:
    """rows that have another value (a key column: rows with null go)."""
    return rows.filter(F.col(column) != value)


def newest(rows: DataFrame, stamp: str, ident: str, limit: int) -> DataFrame:
    """The `limit` latest rows, ties by id."""
    return rows.orderBy(F.col(stamp).desc(), ident).limit(limit)


def with_children(parents: DataFrame, children: DataFrame, keys: list[str]) -> DataFrame:
    """A row for each child of a parent, with the columns of both."""
    return parents.join(children, keys)


def grouped(rows: DataFrame, keys: list[str], ident: str) -> DataFrame:
    """keys, n (rows of the group) and first_id (its smallest id)."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min(ident).alias("first_id"))


class Conflict(RuntimeError):
    """Another write came between."""


class Warehouse:
    """The tables of schemas.TABLES below one folder that all executors reach (any file system Spark can write)."""

    def __init__(self, spark: SparkSession, path: str, retain: float = 24 * 3600):
        self.spark, self.path, self.retain = spark, path.rstrip("/"), retain
        self._fs = spark._jvm.org.apache.hadoop.fs.Path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _hadoop(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.path, *parts]))

    def ensure_layout(self) -> None:
        for name in TABLES:
            self._fs.mkdirs(self._hadoop(name))

    def _pointer(self, name: str) -> dict:
        """version (counts writes), folders of each collection, and retired: folders no longer named, with the time they went."""
        if not self._fs.exists(self._hadoop(name, "CURRENT")):
            return {"version": 0, "folders": {}, "retired": []}
        return json.loads(self.spark.read.text(f"{self.path}/{name}/CURRENT", wholetext=True).first()[0])

    def read(self, name: str, collections: list[str] | None = None) -> DataFrame:
        """The table, or what it has of some collections: other folders are not even listed."""
        return self._frame(name, self._pointer(name)["folders"], collections)

    def _frame(self, name: str, folders: dict[str, list[str]], collections: list[str] | None = None) -> DataFrame:
        found = [f"{self.path}/{name}/{f}" for c, some in sorted(folders.items()) if collections is None or c in collections for f in some]
        schema = TABLES[name].schema
        return self.spark.read.schema(schema).parquet(*found) if found else self.spark.createDataFrame([], schema)

    def _written(self, name: str, rows: DataFrame, collections: list[str]) -> dict[str, list[str]]:
        """rows in new folders, one for each collection that has any."""
        folder = f"v-{uuid.uuid4().hex}"
        numbers = self.spark.createDataFrame(list(enumerate(collections)), "_n int, _c string")  # one row a collection
        numbered = rows.select(*(F.col(f.name).cast(f.dataType) for f in TABLES[name].schema)).join(F.broadcast(numbers), F.col("collection") == F.col("_c")).drop("_c")
        numbered.write.mode("errorifexists").partitionBy("_n").parquet(f"{self.path}/{name}/{folder}")
        return {c: [f"{folder}/_n={k}"] for k, c in enumerate(collections) if self._fs.exists(self._hadoop(name, folder, f"_n={k}"))}

    def _point(self, name: str, before: dict, folders: dict[str, list[str]]) -> None:
        """Names the new folders in one step, and deletes what was retired long enough ago."""
        now = time.time()
        gone = {f for some in before["folders"].values() for f in some} - {f for some in folders.values() for f in some}
        retired = [*before["retired"], *([f, now] for f in sorted(gone))]
        old = [f for f, since in retired if now - since >= self.retain]
        after = {"version": before["version"] + 1, "folders": folders, "retired": [x for x in retired if x[0] not in old]}
        staged, pointer = self._hadoop(name, f"NEXT-{uuid.uuid4().hex}"), self._hadoop(name, "CURRENT")
        out = self._fs.create(staged, True)
        out.write(bytearray(json.dumps(after).encode()))
        out.close()
        if self._pointer(name)["version"] != before["version"]:
            self._fs.delete(staged, False)
            raise Conflict(f"{name} was written by another process; read it again")
        context = self.spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(staged.toUri(), self.spark._jsc.hadoopConfiguration())
        options = self.spark._jvm.java.lang.reflect.Array.newInstance(self.spark._jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename"), 1)
        options[0] = getattr(self.spark._jvm, "org.apache.hadoop.fs.Options$Rename").OVERWRITE
        context.rename(staged, pointer, options)
        for f in old:
            self._fs.delete(self._hadoop(name, f), True)

    @staticmethod
    def _collections(rows: DataFrame) -> list[str]:
        """The collections of rows: a table has few of them."""
        found = [r[0] for r in rows.select("collection").distinct().collect()]
        if None in found:
            raise ValueError("a row without a collection")
        return sorted(found)

    def _rewrite(self, name: str, collections: list[str], change: Callable[[DataFrame], DataFrame]) -> None:
        """Puts change(old content) in place of what the table has of these collections."""
        before = self._pointer(name)
        new = self._written(name, change(self._frame(name, before["folders"], collections)), collections)
        self._point(name, before, {**{c: f for c, f in before["folders"].items() if c not in collections}, **new})

    def write(self, name: str, rows: DataFrame) -> None:
        """rows in place of the whole table."""
        before = self._pointer(name)
        self._point(name, before, self._written(name, rows, self._collections(rows)))

    def append(self, name: str, rows: DataFrame) -> None:
        """rows besides what the table has, as further folders: nothing is read or rewritten."""
        before = self._pointer(name)
        new = self._written(name, rows, self._collections(rows))
        self._point(name, before, {c: before["folders"].get(c, []) + new.get(c, []) for c in {**before["folders"], **new}})

    def upsert(self, name: str, rows: DataFrame, seq: str | None = None) -> None:
        rows = rows.select(*TABLES[name].schema.names, *([seq] if seq else []))
        self._rewrite(name, self._collections(rows), lambda old: upserted(old, rows, list(TABLES[name].keys), seq))

    def replace_sections(self, urls: DataFrame, sections: DataFrame) -> None:
        """Sections of the pages in urls (collection, canonical_url); chunks of sections that go, go too."""
        touched = sorted({*self._collections(urls), *self._collections(sections)})
        self._rewrite("sections", touched, lambda old: replaced(old, sections.select(*TABLES["sections"].schema.names), ["collection", "canonical_url"], urls))
        kept = self.read("sections", touched).select("collection", "section_id")
        self._rewrite("chunks", touched, lambda old: old.join(kept, ["collection", "section_id"], "left_semi"))
        left = self.read("chunks", touched).select("collection", "chunk_id")
        self._rewrite("postings", touched, lambda old: old.join(left, ["collection", "chunk_id"], "left_semi").sortWithinPartitions("term"))

    def replace_chunks(self, urls: DataFrame, chunks: DataFrame, embeddings: DataFrame | None = None) -> None:
        """Chunks of the pages in urls; embeddings (chunk_id, embedding) are joined, null where there is none."""
        rows = (chunks if embeddings is None else chunks.drop("embedding").join(embeddings, "chunk_id", "left")).select(*TABLES["chunks"].schema.names)
        touched = sorted({*self._collections(urls), *self._collections(rows)})
        self._rewrite("chunks", touched, lambda old: replaced(old, rows, ["collection", "canonical_url"], urls))

    def replace_postings(self, urls: DataFrame, postings: DataFrame) -> None:
        """Postings of the chunks of the pages in urls. Files are sorted by term, so that a filter on terms skips most of them."""
        touched = sorted({*self._collections(urls), *self._collections(postings)})
        new = postings.select(*TABLES["postings"].schema.names)
        self._rewrite("postings", touched, lambda old: replaced(old, new, ["collection", "canonical_url"], urls).sortWithinPartitions("term"))

    def index_of(self, collection: str) -> DataFrame | None:
        """The stored postings of a collection, None if it has none."""
        return self.read("postings", [collection]) if self._pointer("postings")["folders"].get(collection) else None

    def append_trace(self, traces: DataFrame) -> None:
        self.append("retrieval_traces", traces)

    def clear_collection(self, collection: str) -> None:
        """All rows of a collection but its crawl runs."""
        self._drop(collection, [name for name in TABLES if name != "crawl_runs"])

    def clear_collection_content(self, collection: str) -> None:
        """Documents, sections and chunks of a collection, before it is indexed anew; nodes and traces stay."""
        self._drop(collection, ["postings", "chunks", "sections", "raw_documents"])

    def _drop(self, collection: str, names: list[str]) -> None:
        """Only pointers change: no table is read or written."""
        for name in names:
            before = self._pointer(name)
            if collection in before["folders"]:
                self._point(name, before, {c: f for c, f in before["folders"].items() if c != collection})

    def broken_references(self) -> dict[str, int]:
        """Rows without the row they refer to, by table and reference."""
        return {f"{name}->{other}": orphans(self.read(name), self.read(other), list(keys)).count() for name, t in TABLES.items() for other, keys in t.references}

    def chunks_of_url(self, collection: str, url: str) -> DataFrame:
        return self.read("chunks", [collection]).filter(F.col("canonical_url") == url).orderBy("order_in_section", "section_id")

    def recent_documents(self, collection: str, limit: int = 20) -> DataFrame:
        rows = self.read("raw_documents", [collection]).select("canonical_url", "title", "http_status", "content_hash", "fetched_at")
        return newest(rows, "fetched_at", "canonical_url", limit)

    def nodes_by(self, collection: str, wanted: DataFrame, key: str = "canonical_url") -> DataFrame:
        """Nodes of many URLs or ids at once (wanted: a frame with the key)."""
        rows = self.read("discovered_nodes", [collection])
        return rows.join(wanted.select(key).distinct(), key, "left_semi").select("node_id", "canonical_url", "title", "parent_node_id", "parent_canonical_url", "toc_level", "toc_order")
