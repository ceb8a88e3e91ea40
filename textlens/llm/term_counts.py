"""How often every term occurs and in how many records, kept up to date by signed deltas (problem 5).

A change set gives, for the records that were added, changed or deleted, their rows before and after
(before is empty for added records, after for deleted ones). Only these rows are aggregated: first to
the pairs (record, term), then to one signed row per term, ``d_occurrences`` and ``d_records``
(``signed_delta``). For a change set that only adds rows, ``added`` takes as rows of before just those with
a pair (record, term) of the new rows, since no other can change what the delta holds.

``TermStore`` keeps the counts in a folder, partitioned by term bucket. A delta reads and rewrites the
buckets it touches and no others; a manifest names the current files of each bucket and is replaced last,
so a lost job leaves the state before it, and the next process finds the state after it.

Rows equal in record, term and the given place columns count once (re-delivered rows). Rows with a null
record or text, and texts without any letter or digit at all (empty after cleaning), do not count.
Terms whose counts fall to zero leave the table. Empty input gives an empty table. A hot term or record
is combined map-side before each shuffle.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from textlens.session import discard, scratch, table, written

COUNTS = "term string, n_occurrences bigint, n_records bigint"


def clean_term(text: Column) -> Column:
    """Lower case, white space runs as one blank, white space and punctuation cut off both ends."""
    t = F.regexp_replace(F.lower(text), r"(?U)\s+", " ")
    return F.regexp_replace(t, r"(?U)^[\s\p{Punct}]+|[\s\p{Punct}]+$", "")


def term_rows(df: DataFrame, record: str, text: str, place: list[str], *more: str) -> DataFrame:
    """(record, term, place, more): place is a hash of the columns that tell one occurrence from another."""
    rows = df.select(F.col(record).alias("record"), clean_term(F.col(text)).alias("term"), F.xxhash64(*place).alias("place"), *more)
    return rows.where("record is not null and term is not null and term <> ''")


def signed_delta(before: DataFrame, after: DataFrame) -> DataFrame:
    """(term, d_occurrences, d_records) from the rows of the changed records before and after."""
    rows = before.withColumn("was", F.lit(1)).withColumn("is", F.lit(0)).unionByName(after.withColumn("was", F.lit(0)).withColumn("is", F.lit(1)))
    places = rows.groupBy("record", "term", "place").agg(F.max("was").alias("was"), F.max("is").alias("is"))
    pairs = places.groupBy("record", "term").agg(F.sum("was").alias("was"), F.sum("is").alias("is"))
    return (
        pairs.groupBy("term")
        .agg(F.sum(F.col("is") - F.col("was")).alias("d_occurrences"), F.sum(F.expr("int(`is` > 0) - int(was > 0)")).alias("d_records"))
        .where("d_occurrences <> 0 or d_records <> 0")
    )


def added(held: DataFrame | None, new: DataFrame) -> DataFrame:
    """(term, d_occurrences, d_records) of new rows beside the rows held; both from ``term_rows``."""
    if held is None:
        places = new.select("record", "term", "place").distinct()
        pairs = places.groupBy("record", "term").agg(F.count("*").alias("n"))
        return pairs.groupBy("term").agg(F.sum("n").alias("d_occurrences"), F.count("*").alias("d_records"))
    new = new.select("record", "term", "place")
    before = held.select("record", "term", "place").join(new.select("record", "term").distinct(), ["record", "term"], "left_semi")
    places = before.withColumn("was", F.lit(1)).unionByName(new.withColumn("was", F.lit(0))).groupBy("record", "term", "place").agg(F.max("was").alias("was"))
    pairs = places.groupBy("record", "term").agg(F.sum("was").alias("was"), F.count("*").alias("is"))
    return (
        pairs.groupBy("term")
        .agg(F.sum(F.col("is") - F.col("was")).alias("d_occurrences"), F.sum(F.expr("int(was = 0)")).cast("bigint").alias("d_records"))
        .where("d_occurrences <> 0 or d_records <> 0")
    )


def merge(counts: DataFrame | None, *deltas: DataFrame) -> DataFrame:
    """Counts with signed deltas added; COUNTS columns."""
    parts = [d.select("term", F.col("d_occurrences").alias("n_occurrences"), F.col("d_records").alias("n_records")) for d in deltas]
    all_rows = counts.select("term", "n_occurrences", "n_records") if counts is not None else parts.pop(0)
    for p in parts:
        all_rows = all_rows.unionByName(p)
    return all_rows.groupBy("term").agg(F.sum("n_occurrences").alias("n_occurrences"), F.sum("n_records").alias("n_records")).where("n_records > 0")


def marked(counts: DataFrame, total_records: int, rare: int = 2, common: float = 0.2) -> DataFrame:
    """counts with ``mark``: rare (in at most ``rare`` records), common (in more than that share), else null."""
    return counts.withColumn("mark", F.when(F.col("n_records") <= rare, "rare").when(F.col("n_records") > common * total_records, "common"))


class TermStore:
    """Counts in a folder, partitioned by term bucket.

    ``buckets`` is fixed when the store is made (terms are spread by hash, so none is hot); choose it so that
    a bucket fits a task.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 32):
        self.spark, self.path = spark, path.rstrip("/")
        hadoop = spark._jvm.org.apache.hadoop.fs
        self._at = lambda *parts: hadoop.Path("/".join([self.path, *parts]))
        self._fs = self._at().getFileSystem(spark._jsc.hadoopConfiguration())
        self.buckets = self._manifest().get("buckets", buckets)

    def _manifest(self) -> dict:
        found = []
        if self._fs.exists(self._at("manifests")):
            found = sorted(f.getPath().getName() for f in self._fs.listStatus(self._at("manifests")))
        if not found:
            return {}
        return json.loads("".join(r.value for r in self.spark.read.text(f"{self.path}/manifests/{found[-1]}").collect()))

    def files(self) -> dict[int, str]:
        """The current folder of each bucket that has terms, below the store's path."""
        return {int(b): f for b, f in self._manifest().get("files", {}).items()}

    def _read(self, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], COUNTS)
        return self.spark.read.schema(COUNTS).parquet(*[f"{self.path}/{f}" for f in folders])

    def read(self) -> DataFrame:
        return self._read(list(self.files().values()))

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64("term"), F.lit(self.buckets)).cast("int")

    def apply(self, delta: DataFrame) -> None:
        """Merge a signed delta; only the buckets of its terms are read and written."""
        delta = written(delta.select("term", "d_occurrences", "d_records"), "delta")
        touched = [r.b for r in delta.select(self._bucket().alias("b")).distinct().collect()]  # at most one row a bucket
        if not touched:
            discard(delta)
            return
        state, files = self._manifest(), self.files()
        version, name = state.get("version", 0) + 1, f"v{state.get('version', 0) + 1:09}-{uuid.uuid4().hex[:8]}"
        merged = merge(self._read([files[b] for b in touched if b in files]), delta).withColumn("bucket", self._bucket())
        merged.repartition(min(len(touched), self.buckets), "bucket").sortWithinPartitions("bucket", "term").write.partitionBy("bucket").parquet(f"{self.path}/{name}")
        made = {int(f.getPath().getName().split("=")[1]) for f in self._fs.listStatus(self._at(name)) if f.isDirectory()}
        old = [files.pop(b) for b in touched if b in files]
        files |= {b: f"{name}/bucket={b}" for b in made}
        self._publish({"version": version, "buckets": self.buckets, "files": files})
        for f in old:  # nobody who reads the manifest from now on needs these
            self._fs.delete(self._at(f), True)
        discard(delta)

    def _publish(self, state: dict) -> None:
        hidden, name = self._at("manifests", f".{uuid.uuid4().hex}"), f"{state['version']:09}.json"
        out = self._fs.create(hidden, True)
        out.write(bytearray(json.dumps(state).encode()))
        out.close()
        if not self._fs.rename(hidden, self._at("manifests", name)):
            raise OSError(f"another writer published {name}")
        for f in self._fs.listStatus(self._at("manifests")):
            if f.getPath().getName() != name and not f.getPath().getName().startswith("."):
                self._fs.delete(f.getPath(), False)


PLACE = ["phrase_id", "field_path", "token_start", "token_end"]


def occurrence_counts(spark: SparkSession, sf_dir: str, late_days: int = 7) -> tuple[DataFrame, int]:
    """Counts of occurrences.verbatim_text from a store that takes two change sets: the rows on time, then the late ones."""
    occ = table(spark, sf_dir, "occurrences")
    late = F.coalesce(F.col("loaded_at") > F.col("mined_at") + F.expr(f"INTERVAL {late_days} DAYS"), F.lit(False))
    on_time, after = (term_rows(occ.where(w), "tinyId", "verbatim_text", PLACE) for w in (~late, late))
    store = TermStore(spark, scratch(spark, "term-counts"))
    store.apply(added(None, on_time))
    store.apply(added(on_time, after))
    return store.read(), occ.select("tinyId").where("tinyId is not null").distinct().count()


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts, total = occurrence_counts(spark, sf_dir)
    return marked(counts, total).where("mark is not null").select("term", "mark")


def p5_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts, total = occurrence_counts(spark, sf_dir)
    return marked(counts, total).select("term", "n_occurrences", "n_records", "mark")


_SQL_COUNTS = r"""
WITH r AS (
  SELECT DISTINCT tinyId, phrase_id, field_path, token_start, token_end,
    regexp_replace(regexp_replace(lower(verbatim_text), '[\s\x{00A0}]+', ' ', 'g'), '^[\s[:punct:]]+|[\s[:punct:]]+$', '', 'g') AS term
  FROM occurrences WHERE tinyId IS NOT NULL AND verbatim_text IS NOT NULL),
c AS (SELECT term, count(*) AS n_occurrences, count(DISTINCT tinyId) AS n_records FROM r WHERE term <> '' GROUP BY term)
SELECT term, n_occurrences, n_records,
  CASE WHEN n_records <= 2 THEN 'rare'
       WHEN n_records > 0.2 * (SELECT count(DISTINCT tinyId) FROM occurrences) THEN 'common' END AS mark
FROM c"""

QUERIES = {"p5_found": p5_found, "p5_counts": p5_counts}
ORACLES = {"p5_counts": _SQL_COUNTS, "p5_found": f"SELECT term, mark FROM ({_SQL_COUNTS}) WHERE mark IS NOT NULL"}
