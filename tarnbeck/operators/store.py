"""A vector store over parquet: collections as directories, results as long tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnbeck.operators.merge import insert_absent
from tarnbeck.operators.predicates import metadata_filter
from tarnbeck.operators.retrieval import top_k_per_query
from tarnbeck.sources import versions

SCHEMA = "id string, text string, embedding array<float>, metadata map<string,string>"


class VectorStore:
    """Items (id, text, embedding, metadata) of named collections under one root.

    A write makes a new version beside the old one and renames a pointer over, so a reader meets the one or the other.
    """

    def __init__(self, spark: SparkSession, root: str, size: int) -> None:
        self.spark, self.root, self.size = spark, root.rstrip("/"), size

    def _fs(self, path: str):
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def has(self, name: str) -> bool:
        return versions.current(self.spark, f"{self.root}/{name}") is not None

    def all(self, name: str) -> DataFrame:
        at = versions.current(self.spark, f"{self.root}/{name}")
        return self.spark.read.schema(SCHEMA).parquet(at) if at else self.spark.createDataFrame([], SCHEMA)

    def _replace(self, name: str, rows: DataFrame) -> None:
        versions.publish(rows, f"{self.root}/{name}")

    def _fit(self, rows: DataFrame) -> DataFrame:
        """Vectors of another length are an error, as a column check within the plan."""
        fine = F.size("embedding") == self.size
        return rows.select("id", "text", F.when(fine, F.col("embedding").cast("array<float>")).otherwise(F.raise_error(F.lit("vector length"))).alias("embedding"), "metadata")

    def insert(self, name: str, rows: DataFrame) -> None:
        """Rows whose id is new; others stay as they are."""
        self._replace(name, insert_absent(self.all(name), self._fit(rows), ["id"]))

    def insert_batches(self, name: str, rows: DataFrame, spill: str, batches: int = 10) -> int:
        """insert, in batches dealt by id; the rows of a batch that fails go to the folder `spill` as JSON. How many failed."""
        failed = 0
        for k in range(batches):
            some = rows.where(F.pmod(F.xxhash64("id"), F.lit(batches)) == k)
            try:
                self.insert(name, some)
            except Exception:  # whatever the rows or the store raise, the other batches go on
                some.write.mode("append").json(spill)
                failed += 1
        return failed

    def upsert(self, name: str, rows: DataFrame) -> None:
        """Whole items replaced by id; of rows with one id, one."""
        new = self._fit(rows).dropDuplicates(["id"])
        self._replace(name, self.all(name).join(new.select("id"), "id", "left_anti").unionByName(new))

    def get(self, name: str, ids: list[str] | None = None) -> DataFrame:
        return self.all(name) if ids is None else self.all(name).where(F.col("id").isin(ids))

    def query(self, name: str, spec: dict, limit: int | None = None) -> DataFrame:
        found = self.all(name).where(metadata_filter(spec, self._field))
        return found if limit is None else found.orderBy("id").limit(limit)

    @staticmethod
    def _field(key: str) -> Column:
        return F.col("metadata").getItem(key)

    def search(self, name: str, queries: DataFrame, k: int, spec: dict | None = None) -> DataFrame:
        """(qid, id, score, rank), filtered before scoring."""
        items = self.all(name)
        return top_k_per_query(items.where(metadata_filter(spec, self._field)) if spec else items, queries, k)

    def delete(self, name: str, ids: list[str] | None = None, spec: dict | None = None) -> None:
        gone = F.col("id").isin(ids) if ids is not None else metadata_filter(spec or {}, self._field)
        self._replace(name, self.all(name).where(~F.coalesce(gone, F.lit(False))))

    def drop(self, name: str) -> None:
        fs, p = self._fs(f"{self.root}/{name}")
        fs.delete(p, True)

    def reset(self) -> None:
        fs, p = self._fs(self.root)
        fs.delete(p, True)


def attach(items: DataFrame, documents: DataFrame, collections: DataFrame, readable: DataFrame) -> DataFrame:
    """Items (item, type, ref) of a turn -> (item, source_id, text): whole texts of "text" items, files and notes by id, collections' documents once; what the user may not read gives nothing.

    documents (id, text), collections (collection, id), readable (id).
    """
    plain = items.where("type = 'text'").select("item", F.col("item").cast("string").alias("source_id"), F.col("ref").alias("text"))
    named = items.where("type IN ('file', 'note')").select("item", F.col("ref").alias("id"))
    whole = items.where("type = 'collection'").select("item", F.col("ref").alias("collection")).join(collections, "collection").select("item", "id")
    wanted = named.unionByName(whole).groupBy("id").agg(F.min("item").alias("item")).join(readable, "id", "left_semi")
    return plain.unionByName(wanted.join(documents, "id").select("item", F.col("id").alias("source_id"), "text"))
