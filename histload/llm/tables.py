"""Written intermediate tables and connected components."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from histload.sources.workspace import work_folder


#: Links that one task joins into components; more are joined in rounds.
ONE_TASK = 100_000
#: Rows of a written table for which one more task writes the tables made from it.
TASK_ROWS = 20_000


def stored(df: DataFrame, name: str, tasks: int | None = None) -> DataFrame:
    """The rows of ``df``, written once to the shared folder and read from there.

    Cuts the lineage: what is lost with an executor is read again, not computed again. At most ``tasks`` tasks
    write, one file each, so that a small table is not spread over as many files as there are shuffle partitions.
    """
    if tasks:
        df = df.coalesce(tasks)
    spark = df.sparkSession
    path = f"{work_folder(spark)}/{name}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def tasks_after(written: DataFrame) -> int:
    """How many tasks may write what is made from a written table; its rows are counted in the files' footers."""
    return 1 + written.count() // TASK_ROWS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _in_one_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parent: dict[int, int] = {}

    def find(v: int) -> int:
        while parent.setdefault(v, v) != v:
            parent[v] = v = parent[parent[v]]
        return v

    for batch in batches:
        for v, u in zip(batch.column("v").to_pylist(), batch.column("u").to_pylist()):
            v, u = find(v), find(u)
            parent[max(v, u)] = min(v, u)
    yield pa.RecordBatch.from_arrays([pa.array(list(parent), pa.int64()), pa.array([find(v) for v in list(parent)], pa.int64())], ["v", "label"])


def components(links: DataFrame, one_task: int = ONE_TASK, tasks: int | None = None) -> DataFrame:
    """Of undirected ``links`` (a, b), each vertex that has a link and the smallest vertex it reaches: (v, label).

    Up to ``one_task`` distinct links are joined by one task. With more, two steps alternate until nothing
    changes: each vertex tells its larger neighbours the smallest one it knows, then the smaller ones. The number
    of rounds grows with the logarithm of the longest path. A hub's links are rows, never one list; its lookup has
    one row on one side, so that a skewed join can be split. ``tasks`` goes to `stored`.
    """

    def written(edges: DataFrame) -> tuple[DataFrame, dict]:
        seen = Observation()
        edges = edges.distinct().observe(seen, F.count("*").alias("n"), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)")).alias("of"))
        return stored(edges, "links", tasks), seen.get

    edges, state = written(links.where("a <> b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")))
    if state["n"] <= one_task:
        return edges.coalesce(1).mapInArrow(_in_one_task, "v long, label long")
    before = None
    while state != before:
        both = edges.select("v", "u").union(edges.select("u", "v"))
        least = both.groupBy("v").agg(F.least("v", F.min("u")).alias("m"))
        up = both.join(least, "v").where("u > v").select(F.col("u").alias("v"), F.col("m").alias("u"))
        least = up.groupBy("v").agg(F.min("u").alias("m"))
        down = up.join(least, "v")
        down = down.where("u <> m").select(F.col("u").alias("v"), F.col("m").alias("u")).union(down.select("v", F.col("m").alias("u")))
        before, (edges, state) = state, written(down)
    return edges.select("v", F.col("u").alias("label")).union(edges.select("u", "u").distinct())
