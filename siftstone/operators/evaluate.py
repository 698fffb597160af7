"""Agreement with human labels, distributions, and sets for learning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ratio(a: Column, b: Column) -> Column:
    """a / b; zero where b is zero."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def classified(decided: DataFrame, reference: DataFrame) -> DataFrame:
    """Adds outcome TP, FP, FN or TN. reference: one lower-case filename a row."""
    known = reference.select(F.lower("filename").alias("_name")).distinct().withColumn("_bad", F.lit(True))
    d = decided.withColumn("_name", F.lower("filename")).join(known, "_name", "left")
    bad, moved = F.coalesce("_bad", F.lit(False)), F.col("decision") == "MOVE"
    return d.withColumn("outcome", F.when(moved & bad, "TP").when(moved, "FP").when(bad, "FN").otherwise("TN")).drop("_bad", "_name")


def confusion(outcomes: DataFrame) -> DataFrame:
    return outcomes.agg(*[F.count_if(F.col("outcome") == k.upper()).alias(k) for k in ("tp", "fp", "fn", "tn")])


def metrics(outcomes: DataFrame) -> DataFrame:
    c = confusion(outcomes)
    precision, recall = ratio(F.col("tp"), F.col("tp") + F.col("fp")), ratio(F.col("tp"), F.col("tp") + F.col("fn"))
    c = c.withColumn("precision", precision).withColumn("recall", recall)
    return c.withColumn("f1", ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))).withColumn(
        "agreement", ratio(F.col("tp") + F.col("tn"), F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn"))
    )


def summary(decided: DataFrame) -> DataFrame:
    """One row: totals and the map of moves by rule."""
    total = decided.agg(F.count("*").alias("total"), *[F.count_if(F.col("decision") == k.upper()).alias(n) for k, n in (("move", "moved"), ("keep", "keep"), ("review", "review"))])
    rules = moves_by_rule(decided).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("rule", "n")))).alias("by_rule"))  # a row for each rule
    return total.crossJoin(rules)  # one row and one row


def moves_by_rule(decided: DataFrame) -> DataFrame:
    return decided.filter("decision = 'MOVE'").groupBy("rule").agg(F.count("*").alias("n"))


def missed_by_score(outcomes: DataFrame, prob: str = "prob") -> DataFrame:
    p = F.col(prob)
    bucket = F.when(p.isNull(), "none").when(p < 0.15, "<0.15").when(p < 0.2, "0.15-0.2").otherwise(">=0.2")
    return outcomes.filter("outcome = 'FN'").groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n"))


def triage(missed: DataFrame) -> DataFrame:
    """What to learn from a missed item: its hash if the text says something, else it is the model's miss."""
    a = F.col("analysis")
    said = (F.size(a["urls"]) > 0) | (F.size(a["promo_weak"]) > 0) | (F.size(a["contact_weak"]) > 0)
    return missed.withColumn("action", F.when(said, "add_hash").otherwise("model_miss"))


def false_moves_by_rule(outcomes: DataFrame) -> DataFrame:
    """(rule, n) of moves that people did not make."""
    return outcomes.filter("outcome = 'FP'").groupBy("rule").agg(F.count("*").alias("n"))


def compared(ours: DataFrame, theirs: DataFrame, name: str = "filename") -> DataFrame:
    """(name, side): each name of either table once, as "both", "ours" or "theirs". Null names are left out."""
    side = lambda rows, flag: rows.select(F.lower(name).alias(name)).filter(F.col(name).isNotNull()).distinct().withColumn(flag, F.lit(True))
    whole = side(ours, "_a").join(side(theirs, "_b"), name, "full")
    return whole.select(name, F.when(F.col("_a") & F.col("_b"), "both").when(F.col("_a"), "ours").otherwise("theirs").alias("side"))


def retrospect(sides: DataFrame) -> DataFrame:
    """One row from `compared`: ours, human, both, and the share of ours that people did not move."""
    count = lambda *s: F.count_if(F.col("side").isin(*s))
    n = sides.agg(count("both", "ours").alias("ours"), count("both", "theirs").alias("human"), count("both").alias("both"))
    return n.withColumn("false_share", ratio(F.col("ours") - F.col("both"), F.col("ours")))


def class_balance(rows: DataFrame, label: str) -> DataFrame:
    """(label, n); null is a class of its own."""
    return rows.groupBy(label).agg(F.count("*").alias("n"))


def status(rows: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """One row: total, done, pct (whole percent, 0 of nothing)."""
    known = done.select(key).distinct().withColumn("_done", F.lit(1))
    n = rows.join(known, key, "left").agg(F.count("*").alias("total"), F.count("_done").alias("done"))
    return n.withColumn("pct", F.coalesce(F.round(100 * F.try_divide("done", "total")), F.lit(0.0)))


def progress_blocks(rows: DataFrame, place: str, size: int = 500) -> DataFrame:
    """(block, n): rows done in each block of `size` places, known by its first place."""
    return rows.select((F.floor(F.col(place) / size) * size).alias("block")).groupBy("block").agg(F.count("*").alias("n"))
