"""Registered queries over files: each writes files made from the tables to the shared folder, reads them back by the
library's readers or passes them through its sinks, and stands beside SQL over the tables themselves."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftstone.functions import lexicon as L
from siftstone.operators import decide as D
from siftstone.operators import evaluate as E
from siftstone.operators import offline as O
from siftstone.operators import pixels as P
from siftstone.operators import rows as R
from siftstone.operators import sampling as S
from siftstone.operators import similarity as H
from siftstone.plans import registry as Q
from siftstone.plans.standin import grey, hashes, items, table
from siftstone.sources import pictures, readers, sinks
from siftstone.sources.scratch import new_folder, once

QUERIES: dict = {}
ORACLE: dict = {}


def _add(name: str, query, sql: str) -> None:
    QUERIES[name], ORACLE[name] = query, sql


def _name():
    return F.concat(F.lit("img_"), F.col("doc_id").cast("string"), F.lit(".jpg"))


def _text(rows: DataFrame, line, name: str = "lines") -> str:
    """A folder of text files with a line for each row, in order of doc_id."""
    folder = new_folder(rows.sparkSession, name)
    rows.sort("doc_id").select(line.alias("value")).coalesce(1).write.text(folder)
    return folder


def _docs(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "documents").select("doc_id", "source")


# ---- listings: a file for each document

FOLDERS = ("", "sub/", "ERR/", "sub/Output/", "sub/deep/", "a.b/")
ENDINGS = (".webp", ".JPG", ".txt", ".png", ".PNG.bak", ".gif", ".jpeg", ".avif", ".bmp", ".tar.webp")
_SQL_FILES = (
    f"f AS (SELECT doc_id, {list(FOLDERS)}[doc_id % {len(FOLDERS)} + 1] AS folder, {list(ENDINGS)}[doc_id // 3 % {len(ENDINGS)} + 1] AS ending, doc_id % 40 AS bytes FROM documents), "
    "n AS (SELECT *, 'f' || doc_id || ending AS name, lower(regexp_extract(ending, '[.][^.]*$')) AS last FROM f)"
)


def _written(s: SparkSession, rows: DataFrame) -> str:
    """A folder of the files (path, content) of rows."""
    folder = new_folder(s, "listing")
    pictures.write_files(rows, folder).write.format("noop").mode("overwrite").save()
    return folder


def _files(s: SparkSession, d: str) -> DataFrame:
    i, pick = F.col("doc_id"), lambda names, at: F.element_at(F.array(*map(F.lit, names)), (at % len(names) + 1).cast("int"))
    name = F.concat(pick(FOLDERS, i), F.lit("f"), i.cast("string"), pick(ENDINGS, F.floor(i / 3)))
    return table(s, d, "documents").select(name.alias("path"), F.repeat(F.lit("x"), (i % 40).cast("int")).alias("content"))


def _listing(recursive: bool, extensions=L.IMAGE_EXTENSIONS, skipped=L.SKIPPED_FOLDERS):
    def query(s: SparkSession, d: str) -> DataFrame:
        found = readers.images(s, _written(s, _files(s, d)), recursive, extensions, skipped)
        return found.select(F.regexp_extract("path", r"listing-[0-9a-f]{32}/(.*)$", 1).alias("file"), "filename", "bytes")

    return query


def _expected(recursive: bool, extensions=L.IMAGE_EXTENSIONS, skipped=L.SKIPPED_FOLDERS, shown: str = "folder || name AS file, name AS filename, bytes") -> str:
    inside = "true" if recursive else "folder = ''"
    clear = f"len(list_intersect(string_split(lower(rtrim(folder, '/')), '/'), {list(skipped)})) = 0" if skipped else "true"
    return f"WITH {_SQL_FILES} SELECT {shown} FROM n WHERE list_contains({list(extensions)}, last) AND {inside} AND {clear}"


for _n, _with in {
    "s1_s2_images": (True,), "s1b_flat_images": (False,), "s13_flat_photos": (False, L.PHOTO_EXTENSIONS), "s15_flat_webp": (False, (".webp",)), "s18_all_photos": (True, L.PHOTO_EXTENSIONS, ()),
}.items():
    _add(_n, _listing(*_with), _expected(*_with))
_add("s21_images_count", lambda s, d: _listing(False, L.PHOTO_EXTENSIONS)(s, d).agg(F.count("*").alias("n")), _expected(False, L.PHOTO_EXTENSIONS, shown="count(*) AS n"))


def _names(s: SparkSession, d: str) -> DataFrame:
    rows, i = table(s, d, "documents"), F.col("doc_id")
    one = lambda cond, form: _written(s, rows.filter(cond).select(F.format_string(form, i, (i % 7)).alias("path"), F.lit("").alias("content")))
    # Two folders that have names in common but for their case.
    return readers.reference_names(s, one("doc_id % 3 < 2", "Ref_%d_%d.JPG"), one("doc_id % 3 > 0", "x/ref_%d_%d.jpg"))


_add("s11_u8_reference_names", _names, "SELECT DISTINCT 'ref_' || doc_id || '_' || doc_id % 7 || '.jpg' AS filename FROM documents")


def _newest(s: SparkSession, d: str) -> DataFrame:
    import time

    docs = table(s, d, "documents")
    log = docs.select(F.format_string("run_%d.log", "doc_id").alias("path"), F.col("text").alias("content"))
    folder = _written(s, log)
    time.sleep(1.1)  # file systems may keep whole seconds
    last = docs.agg(F.format_string("run_%d.log", F.min("doc_id")).alias("path"), F.concat(F.lit("all "), F.count("*").cast("string")).alias("content"))
    pictures.write_files(last, folder).write.format("noop").mode("overwrite").save()
    return readers.newest(s, f"{folder}/run_*.log", 12).select("tail")


_add("s22_o10_latest_log", _newest, "SELECT right('all ' || count(*), 12) AS tail FROM documents")

# ---- lists and logs


def _index(s: SparkSession, d: str) -> DataFrame:
    i = F.col("doc_id")
    line = F.when(i % 5 == 0, F.concat(F.lit("/lone/"), _name())).when(i % 5 == 1, F.lit("  ")).otherwise(F.concat(_name(), F.lit("\t/orig/"), i.cast("string"), F.lit("\textra")))
    again = _docs(s, d).filter(i % 10 == 2).select((i + 100_000_000).alias("doc_id"), i.alias("o"))
    rows = _docs(s, d).select(i, line.alias("l")).unionByName(again.select("doc_id", F.concat(F.lit("img_"), F.col("o").cast("string"), F.lit(".jpg\t/later/x")).alias("l")))
    return readers.index(s, _text(rows, F.col("l")))


_add(
    "s3_index", _index,
    "SELECT 'img_' || doc_id || '.jpg' AS filename, CASE WHEN doc_id % 5 = 0 THEN '/lone/img_' || doc_id || '.jpg' WHEN doc_id % 10 = 2 THEN '/later/x' ELSE '/orig/' || doc_id END AS orig_path FROM documents WHERE doc_id % 5 <> 1",
)


def _verdicts(s: SparkSession, d: str) -> DataFrame:
    i = F.col("doc_id")
    said = F.when(i % 4 == 0, "确认移动").when(i % 4 == 1, "保留").when(i % 4 == 2, "移动或保留").otherwise("?")
    rows = _docs(s, d).select(i, F.concat(F.lit(" "), _name(), F.lit(" ,"), said).alias("l"))
    head = s.createDataFrame([(-1, "﻿文件名,用户决定")], "doc_id long, l string")
    return readers.user_verdicts(s, _text(rows.unionByName(head), F.col("l")))


_add("s4_user_verdicts", _verdicts, "SELECT 'img_' || doc_id || '.jpg' AS filename, CASE WHEN doc_id % 4 = 1 THEN 'KEEP' ELSE 'MOVE' END AS want FROM documents WHERE doc_id % 4 <> 3")

LOG = "`文件名` string, `_path` string, v long"


def _log_lines(s: SparkSession, d: str) -> DataFrame:
    """A log with repeats by path and by name, rows with neither, blank and bad lines."""
    i = F.col("doc_id")
    row = F.to_json(F.struct(F.when(i % 3 > 0, F.concat(F.lit("n"), (i % 50).cast("string"))).alias("文件名"), F.when(i % 3 == 1, F.concat(F.lit("/p/"), (i % 40).cast("string"))).otherwise("").alias("_path"), i.alias("v")))
    return _docs(s, d).select(i, F.when(i % 17 == 5, "").when(i % 17 == 6, '{"v": broken').otherwise(row).alias("l"))


def _row_log(s: SparkSession, d: str) -> DataFrame:
    rows = readers.row_log(s, _text(_log_lines(s, d), F.col("l")), LOG)
    return rows.select("v", F.col("place.keyed").alias("keyed"), F.when(F.col("_path") != "", F.col("_path")).otherwise(F.col("文件名")).alias("k"))


_KEYED = """
r AS (SELECT doc_id AS v, CASE WHEN doc_id % 3 > 0 THEN 'n' || doc_id % 50 END AS name, CASE WHEN doc_id % 3 = 1 THEN '/p/' || doc_id % 40 END AS path FROM documents WHERE doc_id % 17 NOT IN (5, 6)),
k AS (SELECT *, coalesce(path, name) AS k FROM r)"""
_add("s5_row_log", _row_log, f"WITH {_KEYED} SELECT v, 0 AS keyed, k FROM k WHERE k IS NULL UNION ALL SELECT max(v), 1, k FROM k WHERE k IS NOT NULL GROUP BY k")
_add(
    "k20_rebuilt_summary",
    lambda s, d: _rebuilt(s, d),
    f"WITH {_KEYED}, l AS (SELECT v FROM k WHERE k IS NULL UNION ALL SELECT max(v) FROM k WHERE k IS NOT NULL GROUP BY k) "
    "SELECT count(*) AS total, count(*) FILTER (v % 4 = 0) AS moved, count(*) FILTER (v % 4 > 1) AS keep, count(*) FILTER (v % 4 = 1) AS review FROM l",
)


def _rebuilt(s: SparkSession, d: str) -> DataFrame:
    i = F.col("v")
    rows = readers.row_log(s, _text(_log_lines(s, d), F.col("l")), LOG)
    decided = rows.withColumn("decision", F.when(i % 4 == 0, "MOVE").when(i % 4 == 1, "REVIEW").otherwise("KEEP")).withColumn("rule", F.lit("x"))
    return sinks.summary_row(decided).select("total", "moved", "keep", "review")


def _cache(s: SparkSession, d: str, broken: bool, bad: str) -> DataFrame:
    i = F.col("doc_id")
    pairs = F.concat(F.lit('", "lines": [["  hot sale ", 0.9], ["", 0.8], ["w'), (i % 7).cast("string"), F.lit('", 0.5], ["bad"]]}'))
    line = F.concat(F.lit('{"path": "/p/'), i.cast("string"), pairs)
    rows = _docs(s, d).select(i, F.when((i % 100 == 7) & F.lit(broken), "{oops").otherwise(line).alias("l"))
    return readers.cached_lines(s, _text(rows, F.col("l")), bad).select("path", F.array_join(F.transform("lines", lambda x: x["text"]), "|").alias("texts"))


_CACHED = "SELECT '/p/' || doc_id AS path, 'hot sale|w' || doc_id % 7 AS texts FROM documents"
_add("s6_p18_cache", lambda s, d: _cache(s, d, False, "EMPTY"), _CACHED)
_add("s6_broken_cache", lambda s, d: _cache(s, d, True, "EMPTY"), _CACHED + " WHERE false")
_add("s8_offline_cache", lambda s, d: _cache(s, d, True, "DROPMALFORMED"), _CACHED + " WHERE doc_id % 100 <> 7")
_add("s14_learning_cache", lambda s, d: _cache(s, d, False, "FAILFAST"), _CACHED)


def _scores(s: SparkSession, d: str) -> DataFrame:
    i = F.col("doc_id")
    folder = new_folder(s, "scores")
    for k in (0, 1):  # appended by two runs; later lines win within a file
        rows = _docs(s, d).filter(i % 2 == k).select(F.concat(F.lit("/p/"), (i % 200).cast("string")).alias("path"), (i / F.lit(1e6)).alias("prob")).sort("prob").coalesce(1)
        sinks.append_rows(rows, folder)
    return readers.json_lines(s, folder, "path string, prob double", "path")


_add("s7_k13_scores", _scores, "SELECT '/p/' || doc_id % 200 AS path, max(doc_id) / 1e6 AS prob FROM documents GROUP BY 1")


def _shards(s: SparkSession, d: str) -> DataFrame:
    i = F.col("doc_id")
    folder = new_folder(s, "shards")
    for k in range(3):
        rows = _docs(s, d).filter(i % 3 == k).select(F.concat(F.lit("f"), (i % 100).cast("string")).alias("_k"), F.lit(f"s{k}").alias("decision"), i.alias("v")).sort("v").coalesce(1)
        rows.write.json(f"{folder}/offline_rerun_shard_{k}.jsonl")
    return readers.json_lines(s, f"{folder}/offline_rerun_shard_*.jsonl", "_k string, decision string, v long", "_k")


_add(
    "s10_u7_shards", _shards,
    "SELECT _k, arg_max(decision, doc_id % 3 * 1e9 + doc_id) AS decision, arg_max(doc_id, doc_id % 3 * 1e9 + doc_id) AS v FROM (SELECT 'f' || doc_id % 100 AS _k, 's' || doc_id % 3 AS decision, doc_id FROM documents) GROUP BY _k",
)
_add(
    "s9_rows_by_name", lambda s, d: readers.json_lines(s, _text(_log_lines(s, d), F.col("l")), LOG, "文件名").select(F.col("文件名").alias("name"), "v"),
    f"WITH {_KEYED} SELECT name, max(v) AS v FROM r WHERE name IS NOT NULL GROUP BY name",
)
_add(
    "s16_k17_u9_library", lambda s, d: _library(s, d),
    f"WITH {Q._BITS} SELECT DISTINCT CAST(u AS DECIMAL(38,0))::VARCHAR AS u FROM hh WHERE vec_id % 10 = 0 UNION SELECT DISTINCT CAST(u AS DECIMAL(38,0))::VARCHAR FROM hh WHERE vec_id % 15 = 0",
)


def _library(s: SparkSession, d: str) -> DataFrame:
    h = hashes(s, d)
    pick = lambda n: h.filter(F.col("vec_id") % n == 0).select(F.col("phash").alias("hash"))
    first, second = new_folder(s, "library"), new_folder(s, "library")
    sinks.save_library(pick(10), first)
    sinks.save_library(O.add_to_library(readers.library(s, first), pick(15)), second)
    return readers.library(s, second).select(H.unsigned(F.col("hash")).cast("string").alias("u"))


def _broken_library(s: SparkSession, d: str) -> DataFrame:
    broken = _text(_docs(s, d).limit(1), F.lit("[1, 2"))
    return readers.library(s, broken).agg(F.count("*").alias("n")).unionByName(readers.path_set(s, broken).agg(F.count("*").alias("n")))


_add("s16_s17_broken", _broken_library, "SELECT 0::BIGINT AS n UNION ALL SELECT 0")
_add(
    "s17_checkpoint_set", lambda s, d: readers.path_set(s, _text(_docs(s, d).agg(F.min("doc_id").alias("doc_id"), F.to_json(F.array_sort(F.collect_list(F.concat(F.lit("/p/"), (F.col("doc_id") % 50).cast("string"))))).alias("l")), F.col("l"))),
    "SELECT DISTINCT '/p/' || doc_id % 50 AS path FROM documents",
)
_add(
    "s19_path_list",
    lambda s, d: readers.path_list(s, _text(_docs(s, d), F.when(F.col("doc_id") % 6 == 0, " ").otherwise(F.concat(F.lit(" /p/"), F.col("doc_id").cast("string")))), _docs(s, d).filter("doc_id % 2 = 0").select(F.concat(F.lit("/p/"), F.col("doc_id").cast("string")).alias("path"))),
    "SELECT '/p/' || doc_id AS path FROM documents WHERE doc_id % 6 <> 0 AND doc_id % 2 = 0",
)


def _log_of_moves(s: SparkSession, d: str) -> DataFrame:
    i = F.col("doc_id")
    folder = new_folder(s, "moves")
    moves = _docs(s, d).select(i, F.lit("2026-01-01T00:00:00").alias("time"), F.concat(F.lit("/src/"), i.cast("string")).alias("src"), F.concat(F.lit("/err/"), i.cast("string")).alias("dst"))
    sinks.append_rows(moves.sort("doc_id").drop("doc_id").coalesce(1), folder)
    log = readers._numbered(readers.json_lines(s, folder, "time string, src string, dst string", bad="FAILFAST"))
    there = _docs(s, d).filter("doc_id % 3 > 0").select(F.concat(F.lit("/err/"), i.cast("string")).alias("path")).unionByName(_docs(s, d).filter("doc_id % 4 = 0").select(F.concat(F.lit("/src/"), i.cast("string")).alias("path")))
    return sinks.undo_plan(log, there).select("time", "src", "dst")


_add(
    "k7_s20_k19_f24_undo", _log_of_moves,
    "SELECT '2026-01-01T00:00:00' AS time, '/src/' || doc_id AS src, '/err/' || doc_id AS dst FROM documents WHERE doc_id % 3 > 0 AND doc_id % 4 <> 0",
)

# ---- reports, from verdicts that were judged once

_PRESENT = "SELECT doc_id FROM documents WHERE doc_id % 5 > 0"


def _final(s: SparkSession, d: str) -> DataFrame:
    return once(Q.final(s, d).withColumn("orig_path", F.concat(F.lit("/o/"), F.col("doc_id").cast("string"))))


def _report(s: SparkSession, d: str) -> str:
    folder = new_folder(s, "report")
    sinks.write_report(_final(s, d), folder, "2026-01-01T00:00:00")
    return folder


_LABEL = "CASE rule " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in L.RULES.items()) + " END"
_add(
    "k1_s12_report", lambda s, d: readers.report(s, _report(s, d) + "/report.csv").select(F.col("文件名").alias("name"), F.col("决策").alias("decision"), F.col("规则").alias("rule"), F.col("得分").alias("score"), F.col("指纹").alias("fp")),
    f"WITH {Q._DECIDED} SELECT filename AS name, decision, {_LABEL} AS rule, CASE score WHEN 1 THEN '1.0' WHEN 0.5 THEN '0.5' ELSE '0.0' END AS score, substr(md5, 1, 16) AS fp FROM final",
)
_add(
    "k2_a16_summary", lambda s, d: s.read.json(_report(s, d) + "/summary.json").select("generated_at", "dry_run", *[F.col(f"summary.{k}").cast("long").alias(k) for k in ("total", "moved", "keep", "review", "errors", "ocr_count", "dedup_changed", "user_override")]),
    f"WITH {Q._DECIDED} SELECT '2026-01-01T00:00:00' AS generated_at, true AS dry_run, count(*) AS total, count(*) FILTER (decision = 'MOVE') AS moved, count(*) FILTER (decision = 'KEEP') AS keep, count(*) FILTER (decision = 'REVIEW') AS review, "
    "0::BIGINT AS errors, 0::BIGINT AS ocr_count, count(*) FILTER (changed) AS dedup_changed, count(*) FILTER (overridden) AS user_override FROM final",
)
_add("k3_review", lambda s, d: readers.report(s, _report(s, d) + "/review.csv").select(F.col("文件名").alias("name"), F.col("路径").alias("path")), f"WITH {Q._DECIDED} SELECT filename AS name, '/o/' || doc_id AS path FROM final WHERE decision = 'REVIEW'")
_add("k4_move_plan", lambda s, d: readers.path_list(s, _report(s, d) + "/move_plan.txt"), f"WITH {Q._DECIDED} SELECT '/o/' || doc_id AS path FROM final WHERE decision = 'MOVE'")
_add(
    "k8_move_phase", lambda s, d: sinks.move_summary(_final(s, d), table(s, d, "documents").filter("doc_id % 5 > 0").select(F.concat(F.lit("/batch/images/"), _name()).alias("path"))),
    f"WITH {Q._DECIDED} SELECT count(*) FILTER (doc_id % 5 > 0) AS moved, count(*) FILTER (doc_id % 5 = 0) AS skipped_missing FROM final WHERE decision = 'MOVE'",
)


def _plan(s: SparkSession, d: str) -> DataFrame:
    rows = table(s, d, "documents").select(F.concat("source", F.lit(".webp")).alias("filename"), F.format_string("/p/%012d", "doc_id").alias("path"), F.lit("MOVE").alias("decision"))
    present = rows.filter("path NOT LIKE '%7'").select("path")
    taken = table(s, d, "documents").select(F.explode(F.array(F.concat("source", F.lit(".webp")), F.concat("source", F.lit("_2.webp")))).alias("filename")).distinct()
    return sinks.move_plan(rows, present, "t", taken).select("src", "dst", "missing")


_add(
    "k6_move_names", _plan,
    "SELECT src, source || '_' || CASE WHEN n = 0 THEN 1 ELSE n + 2 END || '.webp' AS dst, src LIKE '%7' AS missing FROM (SELECT source, '/p/' || lpad(doc_id::VARCHAR, 12, '0') AS src, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS n FROM documents)",
)
_add(
    "k12_mismatches", lambda s, d: sinks.mismatches(Q.outcomes(s, d)).toDF("name", "kind", "rule"),
    f"WITH {Q._DECIDED} SELECT filename AS name, CASE outcome WHEN 'FP' THEN '{L.MISMATCH['FP']}' ELSE '{L.MISMATCH['FN']}' END AS kind, {_LABEL} AS rule FROM outcome WHERE outcome IN ('FP', 'FN')",
)
_add(
    "k22_r4_quarantine", lambda s, d: sinks.quarantined(table(s, d, "events").select(F.concat(F.lit("/p/"), (F.col("user_id") % 997).cast("string")).alias("path")).filter(F.col("path").endswith("3")), 5),
    "SELECT path FROM (SELECT '/p/' || user_id % 997 AS path FROM events) WHERE path LIKE '%3' GROUP BY path HAVING count(*) >= 5",
)
_add(
    "s23_u6_report_merge", lambda s, d: _merged(s, d),
    "SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'new' ELSE 'old' END AS v FROM documents WHERE doc_id % 3 = 0 OR doc_id % 2 = 0",
)


def _merged(s: SparkSession, d: str) -> DataFrame:
    folder = new_folder(s, "previous")
    rows = _docs(s, d).select("doc_id")
    rows.filter("doc_id % 2 = 0").withColumn("v", F.lit("old")).write.json(folder)
    old = readers.json_lines(s, folder, "doc_id long, v string")
    return R.upsert(old, rows.filter("doc_id % 3 = 0").withColumn("v", F.lit("new")), "doc_id")


_add(
    "f20_failed", lambda s, d: D.rescue(once(Q.decided(s, d).drop("lines", "analysis")).withColumn("error", F.when(F.col("doc_id") % 29 == 1, "boom"))).select("doc_id", "decision", "rule", F.try_element_at("evidence", F.lit(1)).startswith("异常").alias("said")),
    f"WITH {Q._DECIDED} SELECT doc_id, CASE WHEN doc_id % 29 = 1 THEN 'MOVE' ELSE decision END AS decision, CASE WHEN doc_id % 29 = 1 THEN 'failed' ELSE rule END AS rule, CASE WHEN doc_id % 29 = 1 THEN true WHEN rule = 'none' THEN NULL ELSE false END AS said FROM decided",
)

# ---- judging again from caches

_FOLDERS = ("/b/ERR", "/b/auto", "/b/images")


def _present(s: SparkSession, d: str) -> DataFrame:
    i = F.col("doc_id")
    place = F.when(i % 6 == 0, F.concat(F.lit("/batch/images/"), _name())).when(i % 6 == 1, F.concat(F.lit("/b/auto/"), _name())).when(i % 6 == 2, F.concat(F.lit("/b/images/"), _name()))
    return _docs(s, d).select(place.alias("path")).filter("path IS NOT NULL")


def _rows_as_text(s: SparkSession, d: str) -> DataFrame:
    i = items(s, d)
    number = lambda c: F.col(c).cast("string")
    return i.select(
        "doc_id", "filename", "path", F.when(F.col("ok"), number("w")).otherwise("").alias("w"), number("h").alias("h"), number("lum_std").alias("lum_std"),
        F.when(F.col("doc_id") % 11 == 0, "n/a").otherwise(number("uniform_pct")).alias("uniform_pct"), number("ncolors16").alias("ncolors16"), F.lit("").alias("blur_var"),
        F.coalesce(F.try_element_at("qr", F.lit(1)), F.lit("")).alias("qr"), "lines", "prob",
    )


def _judged(s: SparkSession, d: str) -> DataFrame:
    rows = _rows_as_text(s, d)
    scores = _present(s, d).withColumn("doc_id", F.regexp_extract("path", r"img_(\d+)", 1).cast("long")).join(rows.select("doc_id", "prob"), "doc_id").filter("prob IS NOT NULL").select("path", "prob").distinct()
    return once(O.judge(O.features(rows), rows.select("path", "lines"), scores, _present(s, d), _FOLDERS))


def _judged_against(s: SparkSession, d: str) -> DataFrame:
    return O.against(_judged(s, d), Q.human(s, d).select(F.lower("filename").alias("filename")))


_AGAIN = Q._DECIDED.replace("(80 + doc_id * 13 % 21) / 100.0::DOUBLE AS uniform_pct", "CASE WHEN doc_id % 11 <> 0 THEN (80 + doc_id * 13 % 21) / 100.0::DOUBLE END AS uniform_pct").replace(
    "(lum_std < 7.0 AND uniform_pct >= 0.90)", "coalesce(lum_std < 7.0 AND uniform_pct >= 0.90, false)"
)
_AGAIN += """,
seen AS (SELECT doc_id, filename, CASE WHEN doc_id % 6 < 3 THEN prob END AS p, decision, rule FROM decided),
again AS (
  SELECT doc_id, filename, CASE WHEN decision = 'MOVE' THEN decision WHEN p >= 0.3 THEN 'MOVE' WHEN p >= 0.15 THEN 'REVIEW' ELSE decision END AS decision,
    CASE WHEN decision = 'MOVE' THEN rule WHEN p >= 0.3 THEN 'model' WHEN p >= 0.15 THEN 'review' ELSE rule END AS rule, CASE WHEN decision <> 'MOVE' THEN round(p, 4) END AS wm_prob FROM seen),
vs AS (SELECT a.*, CASE WHEN decision = 'MOVE' AND name IS NOT NULL THEN 'TP' WHEN decision = 'MOVE' THEN 'FP' WHEN name IS NOT NULL THEN 'FN' ELSE 'TN' END AS outcome FROM again a LEFT JOIN human ON name = filename)"""
_add("f22_j5_j6_judge_again", lambda s, d: _judged(s, d).select("filename", "decision", "rule", "wm_prob"), f"WITH {_AGAIN} SELECT filename, decision, rule, wm_prob FROM again")
_add(
    "p17_features", lambda s, d: O.features(_rows_as_text(s, d)).select("filename", "ok", "w", "h", "lum_std", "uniform_pct", F.size("qr").cast("long").alias("n_qr"), "error"),
    "SELECT 'img_' || doc_id || '.jpg' AS filename, doc_id % 97 <> 0 AS ok, CASE WHEN doc_id % 97 <> 0 THEN (60 + doc_id * 37 % 900)::INTEGER END AS w, CASE WHEN doc_id % 97 <> 0 THEN (60 + doc_id * 53 % 900)::INTEGER END AS h, "
    "(doc_id * 17 % 2000) / 100.0::DOUBLE AS lum_std, CASE WHEN doc_id % 11 <> 0 THEN (80 + doc_id * 13 % 21) / 100.0::DOUBLE END AS uniform_pct, CASE WHEN doc_id % 41 = 0 THEN 1 ELSE 0 END::BIGINT AS n_qr, CASE WHEN doc_id % 97 = 0 THEN '无尺寸' END AS error FROM documents",
)
_add("j13_against", lambda s, d: _judged_against(s, d).select("filename", "outcome"), f"WITH {_AGAIN} SELECT filename, outcome FROM vs")
_add("a7_missed_by_verdict", lambda s, d: O.missed_by_decision(_judged_against(s, d)), f"WITH {_AGAIN} SELECT decision, count(*) AS n FROM vs WHERE outcome = 'FN' GROUP BY decision")
_add("o5_missed_sample", lambda s, d: O.missed_sample(_judged_against(s, d)).select("filename", "decision", "rule"), f"WITH {_AGAIN} SELECT filename, decision, rule FROM vs WHERE outcome = 'FN' ORDER BY filename LIMIT 40")
_add(
    "k14_offline_report", lambda s, d: O.report_lines(_judged_against(s, d)).select("part", "line"),
    f"""WITH {_AGAIN}, c AS (SELECT count(*) FILTER (outcome = 'TP') AS tp, count(*) FILTER (outcome = 'FP') AS fp, count(*) FILTER (outcome = 'FN') AS fn FROM vs),
m AS (SELECT *, CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp)::DOUBLE END AS p, CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn)::DOUBLE END AS r FROM c)
SELECT 'figures' AS part, format('TP {{}} | FP {{}} | FN {{}} | precision {{:.3f}} | recall {{:.3f}} | F1 {{:.3f}}', tp, fp, fn, p, r, CASE WHEN p + r = 0 THEN 0 ELSE 2 * p * r / (p + r) END) AS line FROM m
UNION ALL (SELECT 'false moves', rule || ': ' || count(*) FROM vs WHERE outcome = 'FP' GROUP BY rule ORDER BY count(*) DESC, rule LIMIT 14)
UNION ALL SELECT 'missed by verdict', decision || ': ' || count(*) FROM vs WHERE outcome = 'FN' GROUP BY decision
UNION ALL SELECT 'missed by score', b || ': ' || count(*) FROM (SELECT CASE WHEN wm_prob IS NULL THEN 'none' WHEN wm_prob < 0.15 THEN '<0.15' WHEN wm_prob < 0.2 THEN '0.15-0.2' ELSE '>=0.2' END AS b FROM vs WHERE outcome = 'FN') GROUP BY b""",
)


def _cache_join(s: SparkSession, d: str) -> DataFrame:
    rows = _docs(s, d).withColumn("path", F.concat(F.lit("/p/"), F.col("doc_id").cast("string")))
    cache = rows.filter("doc_id % 3 = 0").select("path", F.lit("cached").alias("lines"))
    made = lambda missing: missing.select("path", F.when(F.col("doc_id") % 2 == 0, "made").otherwise("").alias("lines"))
    found, whole = O.with_cache(rows, cache, made)
    return found.join(whole.select("path", F.lit(True).alias("kept")), "path", "left").select("path", "lines", "kept")


_add("j4_r7_cache", _cache_join, "SELECT '/p/' || doc_id AS path, CASE WHEN doc_id % 3 = 0 THEN 'cached' WHEN doc_id % 2 = 0 THEN 'made' ELSE '' END AS lines, true AS kept FROM documents")

# ---- what is learned

_ours = lambda s, d: table(s, d, "labels").filter("toxic = 1").select(F.concat(F.lit("f"), F.col("doc_id").cast("string")).alias("filename")).distinct()
_human = lambda s, d: table(s, d, "labels").filter("quality = 0").select(F.concat(F.lit("f"), F.col("doc_id").cast("string")).alias("filename")).distinct()
_add("k15_hard_negatives", lambda s, d: O.hard_negatives(_ours(s, d), _human(s, d), "/ours"), "SELECT '/ours/f' || doc_id AS path FROM labels WHERE toxic = 1 EXCEPT SELECT '/ours/f' || doc_id FROM labels WHERE quality = 0")
_add(
    "a14_k16_retrospect",
    lambda s, d: E.retrospect(E.compared(_ours(s, d), _human(s, d))).withColumn("false_share", F.round("false_share", 9)),
    "WITH o AS (SELECT DISTINCT doc_id FROM labels WHERE toxic = 1), h AS (SELECT DISTINCT doc_id FROM labels WHERE quality = 0), n AS (SELECT (SELECT count(*) FROM o) AS ours, (SELECT count(*) FROM h) AS human, (SELECT count(*) FROM o JOIN h USING (doc_id)) AS both) "
    'SELECT ours, human, "both", round(CASE WHEN ours = 0 THEN 0 ELSE (ours - "both") / ours::DOUBLE END, 9) AS false_share FROM n',
)
_add("a12_class_balance", lambda s, d: E.class_balance(table(s, d, "labels"), "quality"), "SELECT quality, count(*) AS n FROM labels GROUP BY quality")
_path = lambda s, d, cond, folder: table(s, d, "labels").filter(cond).select(F.concat(F.lit(f"/{folder}/f"), F.col("doc_id").cast("string")).alias("path"))
_add(
    "m6_u4_u5_j10_training_set",
    lambda s, d: O.training_set([_path(s, d, "toxic = 1", "a"), _path(s, d, "toxic = 1 AND doc_id % 2 = 0", "b")], [_path(s, d, "quality = 1", "n")], [_path(s, d, "doc_id % 3 = 0", "images")], _human(s, d)),
    "WITH pos AS (SELECT doc_id, '/a/f' || doc_id AS path FROM labels WHERE toxic = 1 UNION ALL SELECT doc_id, '/b/f' || doc_id FROM labels WHERE toxic = 1 AND doc_id % 2 = 0), "
    "neg AS (SELECT doc_id, '/n/f' || doc_id AS path FROM labels WHERE quality = 1 UNION ALL SELECT doc_id, '/images/f' || doc_id FROM labels WHERE doc_id % 3 = 0 AND doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 0)) "
    "SELECT path, 1 AS label FROM pos UNION ALL SELECT path, 0 FROM neg WHERE doc_id NOT IN (SELECT doc_id FROM pos)",
)
_add(
    "j11_m7_learned",
    lambda s, d: O.learned(_human(s, d).subtract(_ours(s, d)), items(s, d).select(F.concat(F.lit("/b/images/f"), F.col("doc_id").cast("string")).alias("path"), "lines"), "/b/images"),
    f"WITH {Q._DECIDED} SELECT DISTINCT 'f' || l.doc_id AS filename, CASE WHEN coalesce(urls OR promo_weak OR contact_weak, false) THEN 'add_hash' ELSE 'model_miss' END AS action "
    "FROM labels l LEFT JOIN sig ON sig.doc_id = l.doc_id WHERE quality = 0 AND l.doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)",
)
_add("o12_shuffled", lambda s, d: S.sample(_docs(s, d).select("doc_id"), 1 << 30, "doc_id", 7).limit(25), "SELECT doc_id FROM documents ORDER BY md5('7:' || doc_id), doc_id LIMIT 25")
_add("o1_o6_order", lambda s, d: R.newest_first(_docs(s, d).select(_name().alias("path"))).limit(30), "SELECT 'img_' || doc_id || '.jpg' AS path FROM documents ORDER BY path DESC LIMIT 30")
_add(
    "a15_progress", lambda s, d: E.progress_blocks(_docs(s, d), "doc_id"),
    "SELECT CAST(floor(doc_id / 500) * 500 AS BIGINT) AS block, count(*) AS n FROM documents GROUP BY 1",
)
_add("t30_paths", lambda s, d: _docs(s, d).select("doc_id", R.basename(F.concat(F.lit("/a.b/C/"), _name())).alias("base"), readers.extension(_name()).alias("ext")), "SELECT doc_id, 'img_' || doc_id || '.jpg' AS base, '.jpg' AS ext FROM documents")
_add(
    "t31_t32_json_times", lambda s, d: table(s, d, "events").select("event_id", readers.json_field("props", "k", "bigint").alias("k"), readers.iso_time("ts").alias("at")),
    "SELECT event_id, (props->>'$.k')::BIGINT AS k, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS at FROM events",
)

# ---- pixels: the 64 values of a vector as a picture of 8 x 8 grey values

_GREY = "SELECT vec_id, [CAST(floor(greatest(0, least(255, 128 + 64 * x))) AS DOUBLE) FOR x IN embedding] AS g FROM embeddings"


def _stats(s: SparkSession, d: str) -> DataFrame:
    values = F.transform("embedding", lambda x: F.floor(F.greatest(F.lit(0.0), F.least(F.lit(255.0), grey(x)))).cast("double"))
    return P.grey_statistics(table(s, d, "embeddings").select("vec_id", values.alias("pixels"), F.lit(8).alias("w"), F.lit(8).alias("h")))


_add(
    "p4_p7_grey", lambda s, d: _stats(s, d).select("vec_id", F.round("lum_mean", 6).alias("lum_mean"), F.round("lum_std", 6).alias("lum_std"), "uniform_pct"),
    f"WITH p AS ({_GREY}), u AS (SELECT vec_id, unnest(g) AS v FROM p), m AS (SELECT vec_id, avg(v) AS mean, stddev_pop(v) AS std FROM u GROUP BY vec_id) "
    "SELECT m.vec_id, round(any_value(mean), 6) AS lum_mean, round(any_value(std), 6) AS lum_std, avg(CASE WHEN abs(v - mean) < 6 THEN 1.0::DOUBLE ELSE 0 END) AS uniform_pct FROM u JOIN m ON m.vec_id = u.vec_id GROUP BY m.vec_id",
)
_at = lambda y, x: f"g[({y}) * 8 + ({x}) + 1]"
_GY = f"CASE WHEN y = 0 THEN {_at('1', 'x')} - {_at('0', 'x')} WHEN y = 7 THEN {_at('7', 'x')} - {_at('6', 'x')} ELSE ({_at('y + 1', 'x')} - {_at('y - 1', 'x')}) / 2 END"
_GX = f"CASE WHEN x = 0 THEN {_at('y', '1')} - {_at('y', '0')} WHEN x = 7 THEN {_at('y', '7')} - {_at('y', '6')} ELSE ({_at('y', 'x + 1')} - {_at('y', 'x - 1')}) / 2 END"
_add(
    "p5_edges", lambda s, d: _stats(s, d).select("vec_id", F.round("edge_mean", 6).alias("edge_mean")),
    f"WITH p AS ({_GREY}), c AS (SELECT vec_id, g, y, x FROM p, range(8) a(y), range(8) b(x)) SELECT vec_id, round(avg(sqrt(power({_GX}, 2) + power({_GY}, 2))), 6) AS edge_mean FROM c GROUP BY vec_id",
)
_mirror = lambda i: f"CASE WHEN {i} < 0 THEN 1 WHEN {i} > 7 THEN 6 ELSE {i} END"
_add(
    "p8_blur", lambda s, d: _stats(s, d).select("vec_id", F.round("blur_var", 6).alias("blur_var")),
    f"WITH p AS ({_GREY}), c AS (SELECT vec_id, {_at(_mirror('(y - 1)'), 'x')} + {_at(_mirror('(y + 1)'), 'x')} + {_at('y', _mirror('(x - 1)'))} + {_at('y', _mirror('(x + 1)'))} - 4 * {_at('y', 'x')} AS l "
    "FROM p, range(8) a(y), range(8) b(x)) SELECT vec_id, round(var_pop(l), 6) AS blur_var FROM c GROUP BY vec_id",
)

# ---- logs that grow, lists for training


def _appended(s: SparkSession, d: str) -> DataFrame:
    """A row log written by three runs; the last row of a path counts."""
    folder, i = new_folder(s, "log"), F.col("doc_id")
    rows = _docs(s, d).select(F.concat(F.lit("/p/"), (i % 300).cast("string")).alias("_path"), _name().alias("文件名"), i.alias("v"))
    edges = [None, *(rows.agg(F.expr("percentile_approx(v, array(0.3, 0.6), 10000)").alias("q")).first().q or [0, 0]), None]
    for low, high in zip(edges, edges[1:], strict=False):
        part = rows if low is None else rows.filter(F.col("v") > low)
        part = part if high is None else part.filter(F.col("v") <= high)
        # A run writes its rows in order, in files whose names come after those of earlier runs.
        sinks.append_rows(part.coalesce(1).sortWithinPartitions("v"), f"{folder}/run={len(str(low or '')):03d}-{low or 0:020d}")
    return readers.row_log(s, f"{folder}/*", "_path string, `文件名` string, v long").select(F.col("_path").alias("path"), "v")


_add("k5_row_log_appended", _appended, "SELECT '/p/' || doc_id % 300 AS path, max(doc_id) AS v FROM documents GROUP BY 1")


def _lists(s: SparkSession, d: str) -> DataFrame:
    """Training lists written and read back."""
    folder, labels = new_folder(s, "lists"), table(s, d, "labels")
    at = F.concat(F.lit("/b/"), F.col("doc_id").cast("string"), F.lit(".jpg"))
    for name, cond in (("pos", "toxic = 1"), ("neg", "toxic = 0")):
        sinks.write_paths(labels.filter(cond).select(at.alias("path")).unionByName(labels.filter(cond).select(at.alias("path"))), f"{folder}/{name}")
    read = lambda name, y: readers.path_list(s, f"{folder}/{name}").withColumn("label", F.lit(y))
    return read("pos", 1).unionByName(read("neg", 0))


_add("k21_training_lists", _lists, "SELECT DISTINCT '/b/' || doc_id || '.jpg' AS path, toxic AS label FROM labels WHERE toxic IN (0, 1)")
