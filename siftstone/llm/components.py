"""Connected components of a link table by repeated contraction.

Each round every node moves to the neighbour (or itself) of least random rank and the links are
rewritten between the nodes that remain. In the first round a node's rank is its value, since links often
come as stars about their least node; then ranks are drawn anew each round, so a constant share of the
nodes goes in every round whatever the shape of the graph. A round's tables are written to the shared
folder, which cuts the lineage, keeps both sides of the following joins plain exchanges, so that Spark
can split a hub's partition, and lets small tables be read again in few tasks.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftstone.llm.common import drop_folder, durable, shared_folder


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node that has a link; component is the least node of its class.

    links: two integer columns; self-links, repeats, either direction and nulls are allowed
    (a null end links nothing). An empty link table gives an empty result.
    """
    spark = links.sparkSession
    folder = f"{shared_folder(spark)}/components-{uuid.uuid4().hex}"

    def written(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{name}")

    edges = written(
        links.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
        .filter("a IS NOT NULL AND b IS NOT NULL AND a <> b")
        .distinct(),
        "edges-0",
    )
    maps: list[DataFrame] = []
    while not edges.isEmpty():
        n = len(maps)

        def ranked(v: str, n: int = n) -> Column:
            return F.struct((F.xxhash64(F.lit(n), F.col(v)) if n else F.col(v).cast("long")).alias("r"), F.col(v).alias("v"))

        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
        to = written(
            both.groupBy("u").agg(F.min(ranked("v")).alias("x")).select("u", F.least(F.col("x"), ranked("u")).getField("v").alias("m")),
            f"map-{n}",
        )
        maps.append(to)
        edges = written(
            edges.join(to.withColumnsRenamed({"u": "a", "m": "ma"}), "a")
            .join(to.withColumnsRenamed({"u": "b", "m": "mb"}), "b")
            .filter("ma <> mb")
            .select(F.least("ma", "mb").alias("a"), F.greatest("ma", "mb").alias("b"))
            .distinct(),
            f"edges-{n + 1}",
        )
    if not maps:
        found = durable(edges.select(F.col("a").alias("node"), F.col("a").alias("component")))
        drop_folder(spark, folder)
        return found
    found = maps[0].select(F.col("u").alias("node"), F.col("m").alias("at"))
    for to in maps[1:]:
        found = found.join(to.withColumnRenamed("u", "at"), "at", "left").select("node", F.coalesce("m", "at").alias("at"))
    found = durable(found)
    drop_folder(spark, folder)
    least = durable(found.groupBy("at").agg(F.min("node").alias("component")))
    return found.join(least, "at").select("node", F.least("node", "component").alias("component"))
