"""Registered queries over training, capped checks and moves of files, on the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftstone.operators import cachelog, learning, moves, sampling, training
from siftstone.plans.registry import _LIBRARY
from siftstone.plans.standin import hashes, planted_library, table
from siftstone.sources import pictures
from siftstone.sources.scratch import new_folder

QUERIES: dict = {}
ORACLE: dict = {}


def _add(name: str, query, sql: str) -> None:
    QUERIES[name], ORACLE[name] = query, sql


def _pictures(s: SparkSession, d: str) -> DataFrame:
    """Vectors as pictures of 8 x 8 whose wanted class is whether their label is 5 or more."""
    return table(s, d, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("features"), (F.col("label") >= 5).cast("int").alias("label"))


def m4_a11_training(s: SparkSession, d: str) -> DataFrame:
    """Validation figures of four epochs, the last two by a run that took up where one of two epochs had ended."""
    folder, rows = new_folder(s, "training"), _pictures(s, d)
    training.train(rows, folder, 2)
    figures = training.metrics(training.train(rows, folder, 4))
    return figures.select("epoch", "n_valid", *[F.round(c, 9).alias(c) for c in ("precision", "recall", "f1", "accuracy", "valid_loss")])


QUERIES["m4_a11_training"] = m4_a11_training

_WEIGHTS = [(i * 7 % 13 - 6) / 10 for i in range(64)]
_add(
    "m2_scores", lambda s, d: training.scored(_pictures(s, d), [*_WEIGHTS, 0.05]).select(F.col("id").alias("vec_id"), F.round("prob", 9).alias("prob")),
    "SELECT vec_id, round(1 / (1 + exp(-(0.05::DOUBLE + list_sum([embedding[i]::DOUBLE * ((i - 1) * 7 % 13 - 6) / 10 FOR i IN range(1, 65)])))), 9) AS prob FROM embeddings",
)


def _checked(s: SparkSession, d: str) -> DataFrame:
    texts = table(s, d, "documents").select("doc_id", "text")
    passes = lambda rows: rows.join(texts, "doc_id").filter(F.right(F.md5("text"), F.lit(1)) < "a").drop("text")
    return sampling.cap_checked(table(s, d, "labels").filter("quality = 0").select("doc_id").distinct(), 20, "doc_id", passes)


_add(
    "o8_m5_capped_after_check", _checked,
    "SELECT doc_id FROM (SELECT DISTINCT doc_id FROM labels WHERE quality = 0) JOIN documents USING (doc_id) WHERE right(md5(text), 1) < 'a' ORDER BY md5('42:' || doc_id), doc_id LIMIT 20",
)


def _moved(s: SparkSession, d: str) -> tuple[str, str]:
    """(root, journal) after a run that a fault ended midway, and the run that did the rest."""
    root, journal, i = new_folder(s, "files"), new_folder(s, "journal"), F.col("doc_id")
    name = F.concat(F.lit("f"), i.cast("string"), F.lit(".webp"))
    files = table(s, d, "documents").select(i, F.concat(F.lit("in/"), name).alias("path"), F.repeat(F.lit("x"), (1 + i % 9).cast("int")).alias("content"))
    pictures.write_files(files, root).write.format("noop").mode("overwrite").save()
    gone = table(s, d, "documents").filter("doc_id % 3 = 0").select(F.concat(F.lit("in/none"), i.cast("string")).alias("src"), F.concat(F.lit("out/none"), i.cast("string")).alias("dst"))
    plan = files.filter("doc_id % 3 = 0").select(F.col("path").alias("src"), F.concat(F.lit("out/"), (i % 7).cast("string"), F.lit("/"), name).alias("dst")).unionByName(gone)
    moves.intend(plan, root, journal)

    def fault(src: str) -> None:
        if src.endswith("5.webp"):
            raise RuntimeError("lost")

    try:
        moves.carry_out(s, root, journal, fault)
    except Exception as e:  # Spark's own, with the task's inside
        if "lost" not in str(e):
            raise
    moves.intend(plan, root, journal)  # the journal stands
    moves.carry_out(s, root, journal)
    return root, journal


def _listed(s: SparkSession, root: str) -> DataFrame:
    return pictures.names(s, root, skipped=()).select(F.regexp_extract("path", r"files-[0-9a-f]{32}/(.*)$", 1).alias("file"), F.col("length").alias("bytes"))


_add("k9_moved_files", lambda s, d: _listed(s, _moved(s, d)[0]), "SELECT CASE WHEN doc_id % 3 = 0 THEN 'out/' || doc_id % 7 || '/' ELSE 'in/' END || 'f' || doc_id || '.webp' AS file, 1 + doc_id % 9 AS bytes FROM documents")


def _log(s: SparkSession, d: str) -> DataFrame:
    _, journal = _moved(s, d)
    return s.read.parquet(f"{journal}/done").select("src", "outcome")


_add("k8_k9_move_log", _log, "SELECT 'in/f' || doc_id || '.webp' AS src, 'moved' AS outcome FROM documents WHERE doc_id % 3 = 0 UNION ALL SELECT 'in/none' || doc_id, 'missing' FROM documents WHERE doc_id % 3 = 0")


def _back(s: SparkSession, d: str) -> DataFrame:
    root, journal = _moved(s, d)
    moves.take_back(s, root, journal, new_folder(s, "journal"))
    return _listed(s, root)


_add("k19_taken_back", _back, "SELECT 'in/f' || doc_id || '.webp' AS file, 1 + doc_id % 9 AS bytes FROM documents")


def _cached(s: SparkSession, d: str) -> DataFrame:
    """Values of all documents' keys from a log of two appends, the second with newer values for some."""
    path, i = new_folder(s, "cache"), F.col("doc_id")
    rows = table(s, d, "documents").select(i, F.concat(F.lit("/p/"), i.cast("string")).alias("path"))
    cachelog.append(rows.filter("doc_id % 3 < 2").withColumn("lines", F.lit("first")), path)
    cachelog.append(rows.filter("doc_id % 5 = 0").withColumn("lines", F.lit("second")), path)
    found, _ = cachelog.lookup(rows, path)
    absent = cachelog.missing(rows, path).select("path", F.lit(None).cast("string").alias("lines"))
    return found.unionByName(absent)


_add("k10_j2_cache_log", _cached, "SELECT '/p/' || doc_id AS path, CASE WHEN doc_id % 5 = 0 THEN 'second' WHEN doc_id % 3 < 2 THEN 'first' END AS lines FROM documents")


def _learned(s: SparkSession, d: str) -> DataFrame:
    """Vectors' verdicts after the loop: every fourth is moved to begin with, people moved every third, the text of three in five says something."""
    i, found = F.col("vec_id"), hashes(s, d)
    items = found.select(i, F.when(i % 4 == 0, "MOVE").otherwise("KEEP").alias("decision"), "phash", (i % 5 < 3).alias("said"))
    out, _, _ = learning.learn(items, found.filter("vec_id % 3 = 0"), planted_library(found), key="vec_id")
    return out.select("vec_id", "decision", F.col("learned_in").isNotNull().alias("learned"))


_add(
    "m7_learning_loop", _learned,
    f"WITH {_LIBRARY}, own AS (SELECT DISTINCT u::HUGEINT AS l FROM hh WHERE vec_id % 4 <> 0 AND vec_id % 3 = 0 AND vec_id % 5 < 3 AND u::HUGEINT NOT IN (SELECT l FROM lib)), "
    "hit AS (SELECT DISTINCT vec_id FROM hh, own WHERE vec_id % 4 <> 0 AND bit_count(xor(u::HUGEINT, l)) <= 1) "
    "SELECT vec_id, CASE WHEN vec_id % 4 = 0 OR vec_id IN (SELECT vec_id FROM hit) THEN 'MOVE' ELSE 'KEEP' END AS decision, vec_id IN (SELECT vec_id FROM hit) AS learned FROM hh",
)
