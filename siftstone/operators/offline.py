"""Judging again from reports and caches, merging what comes of it, and what is learned from disagreement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftstone.functions import lexicon as L
from siftstone.operators import decide as D
from siftstone.operators import evaluate as E
from siftstone.sources.scratch import once

LINES = "CAST(array() AS array<struct<text:string,conf:double>>)"


def features(rows: DataFrame) -> DataFrame:
    """Features from a report's rows, whose fields are strings: without a width and a height an item isn't readable; a bad number is absent."""
    number = lambda c, kind: F.when(F.trim(F.col(c)) != "", F.trim(F.col(c)).try_cast(kind))
    w, h = number("w", "int"), number("h", "int")
    known = F.coalesce((w != 0) & (h != 0), F.lit(False))
    return rows.select(
        "filename", "path", known.alias("ok"), F.when(known, w).alias("w"), F.when(known, h).alias("h"), F.when(~known, F.lit("无尺寸")).alias("error"),
        number("lum_std", "double").alias("lum_std"), number("uniform_pct", "double").alias("uniform_pct"), number("ncolors16", "int").alias("ncolors16"),
        number("blur_var", "double").alias("blur_var"), F.when(F.col("qr") != "", F.array("qr")).otherwise(F.expr("CAST(array() AS array<string>)")).alias("qr"),
    )


def with_cache(items: DataFrame, cache: DataFrame, make=None, key: str = "path", value: str = "lines") -> tuple[DataFrame, DataFrame]:
    """(items with a cached value, the cache with what was missing).

    make(missing items) gives (key, value) of items that the cache lacks, failures included (as a null or
    empty value, so that they aren't tried again); without it they have a null.
    """
    known = cache.select(key, value)
    if make is None:
        return items.join(known, key, "left"), known
    missing = items.join(known.select(key), key, "left_anti")
    whole = known.unionByName(make(missing).select(key, value))
    return items.join(whole, key, "left"), whole


def first_present(items: DataFrame, present: DataFrame, candidates: list[Column]) -> DataFrame:
    """Adds found: the first of the candidate paths that stands in present, null if none does."""
    tried = items.withColumn("_id", F.monotonically_increasing_id())
    each = tried.select("filename", "path", F.posexplode(F.array(*candidates)).alias("_rank", "_candidate"))
    there = each.join(present.select(F.col("path").alias("_candidate")).distinct(), "_candidate", "left_semi")
    best = there.groupBy("filename", "path").agg(F.min_by("_candidate", "_rank").alias("found"))
    return items.join(best, ["filename", "path"], "left")


def judge(items: DataFrame, lines: DataFrame, scores: DataFrame, present: DataFrame, folders: tuple[str, ...]) -> DataFrame:
    """(filename, decision, rule, wm_prob, ocr): items judged from cached lines and scores, without library, duplicates and user verdicts.

    An item's score is found under its path or under its name in one of the folders, the first that is there.
    """
    read, _ = with_cache(items, lines)
    decided = once(D.decide(read.withColumn("lines", F.coalesce("lines", F.expr(LINES)))).drop("lines"))  # read twice below
    places = [F.col("path"), *[F.concat(F.lit(f"{f}/"), F.col("filename")) for f in folders]]
    known = first_present(decided.filter("decision <> 'MOVE'").select("filename", "path"), present, places)
    prob = known.join(scores.select(F.col("path").alias("found"), "prob"), "found").select("filename", "path", "prob")
    d = D.refine_by_model(decided.join(prob, ["filename", "path"], "left"))
    shown = F.substring(F.array_join(F.slice(F.filter(F.col("analysis")["texts"], lambda t: t != ""), 1, 12), " | "), 1, 150)
    shown = F.when(F.col("rule").isin("model") | ((F.col("rule") == "review") & (F.col("score") == 0.5) & (F.size("evidence") == 1) & F.col("evidence")[0].startswith(L.EVIDENCE["model_some"])), F.lit("")).otherwise(shown)
    return d.select("filename", "decision", "rule", "wm_prob", shown.alias("ocr"))


def against(judged: DataFrame, human: DataFrame) -> DataFrame:
    """Adds outcome: TP, FP, FN or TN by whether the name, as it is written, is among the human's."""
    known = human.select("filename").distinct().withColumn("_bad", F.lit(True))
    bad, moved = F.coalesce("_bad", F.lit(False)), F.col("decision") == "MOVE"
    return judged.join(known, "filename", "left").withColumn("outcome", F.when(moved & bad, "TP").when(moved, "FP").when(bad, "FN").otherwise("TN")).drop("_bad")


def missed_by_decision(outcomes: DataFrame) -> DataFrame:
    return outcomes.filter("outcome = 'FN'").groupBy("decision").agg(F.count("*").alias("n"))


def missed_sample(outcomes: DataFrame, n: int = 40) -> DataFrame:
    """The first missed items by name."""
    return outcomes.filter("outcome = 'FN'").select("filename", "decision", "rule", "wm_prob", F.substring("ocr", 1, 100).alias("ocr")).orderBy("filename").limit(n)


def report_lines(outcomes: DataFrame, most: int = 14) -> DataFrame:
    """(part, place, line) of the text report: figures, false moves by rule, missed items by verdict and by score."""
    m = E.metrics(outcomes)
    head = m.select(
        F.lit("figures").alias("part"), F.lit(0).cast("long").alias("place"),
        F.format_string("TP %d | FP %d | FN %d | precision %.3f | recall %.3f | F1 %.3f", "tp", "fp", "fn", "precision", "recall", "f1").alias("line"),
    )
    wrong = outcomes.filter("outcome = 'FP'").groupBy("rule").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "rule").limit(most)
    parts = [(wrong, "rule", "false moves"), (missed_by_decision(outcomes), "decision", "missed by verdict"), (E.missed_by_score(outcomes, "wm_prob"), "bucket", "missed by score")]
    for rows, key, name in parts:
        head = head.unionByName(rows.select(F.lit(name).alias("part"), (-F.col("n")).alias("place"), F.format_string("%s: %d", key, "n").alias("line")))
    return head


def hard_negatives(ours: DataFrame, human: DataFrame, folder: str) -> DataFrame:
    """(path): names that we moved and people did not, below our folder."""
    return ours.select("filename").subtract(human.select("filename")).select(F.concat(F.lit(f"{folder}/"), "filename").alias("path"))


def learned(missed: DataFrame, lines: DataFrame, folder: str) -> DataFrame:
    """Missed names with action: those whose cached lines say something go to the library; the model missed the others."""
    wanted = missed.select("filename", F.concat(F.lit(f"{folder}/"), "filename").alias("path"))
    d = D.decide(
        wanted.join(lines, "path", "left").select(
            "filename", F.coalesce("lines", F.expr(LINES)).alias("lines"), F.lit(True).alias("ok"), F.lit(800).alias("w"), F.lit(800).alias("h"), F.lit(None).cast("double").alias("lum_std"),
            F.lit(None).cast("double").alias("uniform_pct"), F.lit(16).alias("ncolors16"), F.expr("CAST(array() AS array<string>)").alias("qr"),
        )
    )
    return E.triage(d).select("filename", "action")


def training_set(positives: list[DataFrame], negatives: list[DataFrame], images: list[DataFrame], human: DataFrame) -> DataFrame:
    """(path, label): positives of all folders, repeats included; negatives of lists, and of folders those that no person moved, without names of positives."""
    name = F.element_at(F.split("path", "/"), -1)
    pos = positives[0].select("path")
    for p in positives[1:]:
        pos = pos.unionByName(p.select("path"))
    neg = negatives[0].select("path")
    for n in negatives[1:]:
        neg = neg.unionByName(n.select("path"))
    for i in images:
        kept = i.select("path").withColumn("filename", name).join(human.select("filename").distinct(), "filename", "left_anti")
        neg = neg.unionByName(kept.select("path"))
    names = pos.select(name.alias("filename")).distinct()
    neg = neg.withColumn("filename", name).join(names, "filename", "left_anti").select("path")
    return pos.withColumn("label", F.lit(1)).unionByName(neg.withColumn("label", F.lit(0)))


def add_to_library(library: DataFrame, hashes: DataFrame) -> DataFrame:
    """(hash): the library with further hashes, each once; null hashes are left out."""
    return library.select("hash").unionByName(hashes.select("hash")).filter("hash IS NOT NULL").distinct()
