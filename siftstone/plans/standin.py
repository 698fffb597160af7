"""Items for the engine from the provided tables: there are no pictures, so features follow formulas of the id.

The same definitions stand in SQL, for the queries' counterparts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftstone.operators.similarity import pack_bits

#: Lines planted at the head of documents whose id leaves the given remainder by 31.
PHRASES = (
    "visit https://acme.example/x", "https://acme.com/x free shipping", "19@mail5.example.com", "info@acme.com", "call 800-555-1234",
    "tel: 123-456-7890", "price $12.50", "$0100120", "Special Price today", "fast shipping worldwide", "worldwide shipping", "Genuine eBay parts",
    "shutterstock", "sample copyright", "authorized dealer", "https://acme.com authorized dealer", "warehouse 12", "MFG.CO", "overall width 12 mm",
    "现货供应", "微信号 abc", "ACME", "hot sale 50 EUR", "whatsapp me", "+86 13812345678 now", "only $3 left", "dealmed rf-performance", "20 USD",
    "buy now, click here", "qq: 123456",
)
K = 31


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread_out(rows: DataFrame) -> DataFrame:
    """Rows of a table of fewer splits than there are cores are dealt out; larger tables stay as they are read."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores) if rows.rdd.getNumPartitions() < cores else rows


def lines(docs: DataFrame) -> DataFrame:
    """(doc_id, lines, md5): the document's lines behind its planted one."""
    planted = F.try_element_at(F.array(*[F.lit(p) for p in PHRASES]), (F.pmod("doc_id", F.lit(K)) + 1).cast("int"))
    conf = lambda i: (F.pmod(F.col("doc_id") * 7 + (i + 1) * 13, F.lit(50)) + 50) / F.lit(100.0)
    own = F.transform(F.split(F.coalesce("text", F.lit("")), "\n"), lambda t, i: F.struct(t.alias("text"), conf(i).alias("conf")))
    head = F.when(planted.isNotNull(), F.array(F.struct(planted.alias("text"), F.lit(0.9).alias("conf")))).otherwise(F.expr("CAST(array() AS array<struct<text:string,conf:double>>)"))
    return docs.select("doc_id", F.concat(head, own).alias("lines"), F.md5("text").alias("md5"))


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("doc_id")
    docs = spread_out(table(spark, sf_dir, "documents"))
    with_lines = lines(docs)
    name = F.concat(F.lit("img_"), d.cast("string"), F.lit(".jpg"))
    return with_lines.select(
        "doc_id", name.alias("filename"), F.concat(F.lit("/batch/images/"), name).alias("path"), (d % 97 != 0).alias("ok"),
        (60 + d * 37 % 900).cast("int").alias("w"), (60 + d * 53 % 900).cast("int").alias("h"),
        ((d * 17 % 2000) / F.lit(100.0)).alias("lum_std"), ((80 + d * 13 % 21) / F.lit(100.0)).alias("uniform_pct"), (1 + d * 7 % 16).cast("int").alias("ncolors16"),
        F.when(d % 41 == 0, F.array(F.lit("code"))).otherwise(F.expr("CAST(array() AS array<string>)")).alias("qr"), "lines", "md5",
        F.when(d % 7 != 0, (d * 31 % 1000) / F.lit(1000.0)).alias("prob"),
    )


def hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(vec_id, phash) of embeddings, which have 64 values as a picture's low frequencies have."""
    return table(spark, sf_dir, "embeddings").select("vec_id", pack_bits(F.col("embedding").cast("array<double>")).alias("phash"))


def grey(x: Column) -> Column:
    """The grey value of a component before it is bounded, in single precision as SQL computes it from the table's type."""
    return (128 + 64 * x.cast("float")).cast("float")


def planted_library(found: DataFrame) -> DataFrame:
    """Hashes of every tenth vector with none, one or two of their bits flipped."""
    flip = F.when(F.col("vec_id") % 30 == 10, 1).when(F.col("vec_id") % 30 == 20, 3).otherwise(0).cast("long")
    return found.filter("vec_id % 10 = 0").select(F.col("phash").bitwiseXOR(flip).alias("hash"))


def _q(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


#: Usable normalized lines (doc_id, rn, line, raw), and the items' features.
SQL = f"""
phr(k, phrase) AS (VALUES {', '.join(f'({i}, {_q(p)})' for i, p in enumerate(PHRASES))}),
own AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS raw, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
alls AS (
  SELECT doc_id, 0 AS pos, phrase AS raw, 0.9::DOUBLE AS conf FROM documents JOIN phr ON doc_id % {K} = k
  UNION ALL SELECT doc_id, pos, raw, ((doc_id * 7 + pos * 13) % 50 + 50) / 100.0::DOUBLE FROM own),
lin AS (
  SELECT doc_id, rn, raw, lower(regexp_replace(raw, '^\\s+|\\s+$', '', 'g')) AS line
  FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS rn FROM alls) WHERE rn <= 60 AND conf >= 0.55),
item AS (
  SELECT doc_id, 'img_' || doc_id || '.jpg' AS filename, doc_id % 97 <> 0 AS ok, 60 + doc_id * 37 % 900 AS w, 60 + doc_id * 53 % 900 AS h,
    (doc_id * 17 % 2000) / 100.0::DOUBLE AS lum_std, (80 + doc_id * 13 % 21) / 100.0::DOUBLE AS uniform_pct, 1 + doc_id * 7 % 16 AS ncolors16,
    doc_id % 41 = 0 AS has_qr, md5(text) AS md5, CASE WHEN doc_id % 7 <> 0 THEN (doc_id * 31 % 1000) / 1000.0::DOUBLE END AS prob
  FROM documents)"""
