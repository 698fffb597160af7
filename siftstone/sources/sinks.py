"""Writers of reports, plans and logs. Moving files is planned as rows; acting on a plan is the caller's."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftstone.functions import lexicon as L
from siftstone.operators.decide import label
from siftstone.operators.evaluate import summary
from siftstone.operators.rows import clash_names
from siftstone.operators.similarity import unsigned


def report_rows(decided: DataFrame) -> DataFrame:
    """The report's columns under their display names; fields that the rows lack are empty."""
    def shown(field: str):
        if field == "evidence":
            return F.array_join("evidence", "; ")
        if field == "rule":
            return F.coalesce(label(F.col("rule")), F.col("rule"))
        if field == "qr" and "qr" in decided.columns:
            return F.substring(F.array_join("qr", ";"), 1, 200)
        if field == "fingerprint" and "md5" in decided.columns:
            return F.substring("md5", 1, 16)
        if field == "ocr_text" and "analysis" in decided.columns:
            return F.substring(F.array_join(F.col("analysis")["texts"], " | "), 1, 800)
        return F.col(field).cast("string") if field in decided.columns else F.lit("")

    return decided.select(*[F.coalesce(shown(k), F.lit("")).alias(v) for k, v in L.REPORT_COLUMNS.items()])


def summary_row(decided: DataFrame, dry_run: bool = True, errors: int = 0, ocr_count: int = 0) -> DataFrame:
    """One row: total, moved, keep, review, errors, ocr_count, dedup_changed, user_override, dry_run, by_rule (by display name)."""
    shown = decided.withColumn("rule", F.coalesce(label(F.col("rule")), F.col("rule")))
    count = lambda c: F.coalesce(F.sum(F.col(c).cast("long")), F.lit(0)) if c in decided.columns else F.lit(0).cast("long")
    flags = decided.agg(count("changed").alias("dedup_changed"), count("overridden").alias("user_override"))
    return summary(shown).crossJoin(flags).select(  # one row and one row
        "total", "moved", "keep", "review", F.lit(errors).alias("errors"), F.lit(ocr_count).alias("ocr_count"), "dedup_changed", "user_override", F.lit(dry_run).alias("dry_run"), "by_rule"
    )


def write_report(decided: DataFrame, folder: str, generated_at: str, dry_run: bool = True) -> None:
    """report.csv, report.json (rows), summary.json (one row), review.csv and move_plan.txt as folders of part files. decided is read five times."""
    rows = report_rows(decided)
    rows.write.mode("overwrite").option("header", True).csv(f"{folder}/report.csv")
    rows.write.mode("overwrite").json(f"{folder}/report.json")
    made = summary_row(decided, dry_run)
    made.select(F.lit(generated_at).alias("generated_at"), F.lit(dry_run).alias("dry_run"), F.struct(*made.columns).alias("summary")).write.mode("overwrite").json(f"{folder}/summary.json")
    rows.filter(F.col("决策") == "REVIEW").select("文件名", F.col("原始路径").alias("路径"), "证据").write.mode("overwrite").option("header", True).csv(f"{folder}/review.csv")
    rows.filter(F.col("决策") == "MOVE").select("原始路径").write.mode("overwrite").text(f"{folder}/move_plan.txt")


def append_rows(rows: DataFrame, path: str) -> None:
    """Appends to a log of JSON lines: report rows, moves, scores, shard results."""
    rows.write.mode("append").json(path)


def move_summary(decided: DataFrame, present: DataFrame) -> DataFrame:
    """(moved, skipped_missing): MOVE rows whose file is there, and those whose file is gone."""
    d = decided.filter("decision = 'MOVE'").join(present.select("path").distinct().withColumn("_here", F.lit(True)), "path", "left")
    return d.agg(F.count("_here").alias("moved"), F.count_if(F.col("_here").isNull()).alias("skipped_missing"))


def mismatches(outcomes: DataFrame) -> DataFrame:
    """The rows of the mismatch report."""
    kind = F.when(F.col("outcome") == "FP", L.MISMATCH["FP"]).otherwise(L.MISMATCH["FN"])
    return outcomes.filter("outcome IN ('FP', 'FN')").select(F.lower("filename").alias("文件名"), kind.alias("类型"), F.coalesce(label(F.col("rule")), F.col("rule")).alias("我们的规则"))


def save_library(library: DataFrame, path: str) -> None:
    """One JSON array of unsigned 64-bit numbers, each once; a library is small (one row here)."""
    listed = library.filter("hash IS NOT NULL").select("hash").distinct().agg(F.array_sort(F.collect_list(unsigned(F.col("hash")).cast("string"))).alias("h"))
    listed.select(F.concat(F.lit("["), F.array_join("h", ", "), F.lit("]"))).coalesce(1).write.mode("overwrite").text(path)


def quarantined(failures: DataFrame, tries: int = 2) -> DataFrame:
    """(path): files that failed so many times."""
    return failures.groupBy("path").agg(F.count("*").alias("n")).filter(F.col("n") >= tries).select("path")


def move_plan(decided: DataFrame, present: DataFrame, run_ts: str, taken: DataFrame | None = None) -> DataFrame:
    """(time, src, dst, missing): MOVE rows, those whose file is gone marked, with names that clash neither with each other nor with those taken."""
    rows = decided.filter("decision = 'MOVE'").join(present.select("path").distinct().withColumn("_here", F.lit(True)), "path", "left")
    return clash_names(rows, taken=taken).select(F.lit(run_ts).alias("time"), F.col("path").alias("src"), F.col("target").alias("dst"), F.col("_here").isNull().alias("missing"))


def undo_plan(log: DataFrame, present: DataFrame, seq: str = "seq") -> DataFrame:
    """Moves to take back, last first: the target is there and the source's place is free."""
    here = present.select("path").distinct()
    back = log.join(here.withColumnRenamed("path", "dst"), "dst", "left_semi").join(here.withColumnRenamed("path", "src"), "src", "left_anti")
    return back.orderBy(F.desc(seq))


def write_paths(rows: DataFrame, path: str, column: str = "path") -> None:
    """A list of paths, one a line, each once and in order, as `readers.path_list` reads it; null and blank paths are left out."""
    listed = rows.filter(F.trim(column) != "").select(F.col(column).alias("value")).distinct()
    listed.repartitionByRange("value").sortWithinPartitions("value").write.mode("overwrite").text(path)
