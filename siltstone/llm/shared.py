"""Tables written to the folder that all executors share, and connected components.

A written table cuts the lineage: what comes after it survives the loss of an
executor without starting over, and its file sizes tell the planner whether a
side is small enough to broadcast.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the word rule, as the inside of a character class.
WHITE = r"\x20\x09-\x0D"


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir.

    Where it is unset, a local session gets a temporary folder of its own; a
    cluster session is refused, as a machine's own folder is not shared.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if "-cluster" in spark.sparkContext.master:
            raise ValueError("set spark.checkpoint.dir: the executors have folders of their own")
        folder = spark.sparkContext.getCheckpointDir()
        if not folder:
            spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="shared-"))
            folder = spark.sparkContext.getCheckpointDir()
    return folder.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


class Written:
    """A table in the shared folder: `df` reads it, `drop()` deletes its files."""

    def __init__(self, df: DataFrame, name: str):
        self.spark = df.sparkSession
        self.path = new_path(self.spark, name)
        df.write.option("compression", "zstd").parquet(self.path)
        self.df = self.spark.read.schema(df.schema).parquet(self.path)

    def drop(self) -> None:
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def written(df: DataFrame, name: str) -> DataFrame:
    """`df`, written to the shared folder and read back."""
    return Written(df, name).df


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of `edges` (a, b): root is the smallest node reachable.

    Rounds of contraction: each node takes its smallest neighbour, chains of such
    steps are followed to their end, and the edges between the ends make up the
    next, smaller graph. Every step is an aggregate with partial sums or an
    equi-join that adaptive execution can split, so a node with very many links
    does not meet in one task. The driver sees counts only.
    """
    spark = edges.sparkSession
    links = Written(
        edges.filter("a <> b").selectExpr("least(a, b) AS a", "greatest(a, b) AS b").distinct(), "links"
    )
    roots: Written | None = None
    while not links.df.isEmpty():
        both = links.df.select("a", "b").unionAll(links.df.selectExpr("b AS a", "a AS b"))
        step = Written(
            both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")).selectExpr("node", "least(node, low) AS root"),
            "step",
        )
        step = _follow(step)
        to = step.df.selectExpr("node AS at", "root AS to")
        if roots is None:
            merged = Written(step.df, "roots")
        else:
            # A root of an earlier round that has no links left keeps its label.
            merged = Written(
                roots.df.join(to, roots.df["root"] == to["at"], "left").selectExpr("node", "coalesce(to, root) AS root"),
                "roots",
            )
            roots.drop()
        roots = merged
        first = links.df.join(to, links.df["a"] == to["at"]).select(F.col("to").alias("a"), "b")
        second = first.join(to, first["b"] == to["at"]).selectExpr("a", "to AS b").filter("a <> b")
        smaller = Written(second.selectExpr("least(a, b) AS a", "greatest(a, b) AS b").distinct(), "links")
        links.drop()
        step.drop()
        links = smaller
    if roots is None:
        return spark.createDataFrame([], "node bigint, root bigint")
    links.drop()
    return roots.df


def _follow(step: Written) -> Written:
    """Replaces each root by the root's own root until none changes; doubles the reach each time."""
    while True:
        up = step.df.selectExpr("node AS at", "root AS higher")
        jumped = Written(
            step.df.join(up, step.df["root"] == up["at"], "left").selectExpr(
                "node", "coalesce(higher, root) AS root", "coalesce(higher, root) <> root AS moved"
            ),
            "step",
        )
        done = jumped.df.filter("moved").isEmpty()
        step.drop()
        step = jumped
        if done:
            return step
