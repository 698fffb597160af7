"""Ordered verdicts MOVE, REVIEW and KEEP, and their later refinements."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftstone.functions import lexicon as L
from siftstone.functions.text import ALL, NO_STRINGS, analyzed


def some(array: Column) -> Column:
    return F.size(array) > 0


def blurred(blur: Column, enabled: bool, severe_moves: bool) -> tuple[Column, Column]:
    """(moves, evidence) of the sharpness rule, which is off by default."""
    off = F.lit(enabled) & blur.isNotNull()
    severe, slight = off & (blur < L.BLUR_SEVERE), off & (blur < L.BLUR_SLIGHT)
    return severe & F.lit(severe_moves), F.when(severe, F.concat(F.lit(L.EVIDENCE["severe_blur"]), F.format_string("%.1f", blur))).when(slight, F.concat(F.lit(L.EVIDENCE["slight_blur"]), F.format_string("%.1f", blur)))


def listed(values: Column) -> Column:
    """A list of strings as reports show it: quoted, in brackets."""
    escaped = lambda x: F.replace(x, F.lit("\\"), F.lit("\\\\"))
    double = lambda x: F.contains(x, F.lit("'")) & ~F.contains(x, F.lit('"'))
    quoted = lambda x: F.when(double(x), F.concat(F.lit('"'), escaped(x), F.lit('"'))).otherwise(F.concat(F.lit("'"), F.replace(escaped(x), F.lit("'"), F.lit("\\'")), F.lit("'")))
    return F.concat(F.lit("["), F.array_join(F.transform(values, quoted), ", "), F.lit("]"))


def decide(items: DataFrame, review_moves: bool = False, blur_rule: bool = False, severe_moves: bool = False) -> DataFrame:
    """Adds analysis, rule, decision, evidence and score. review_moves: doubts move, under a rule of their own.

    items: ok, w, h, lum_std, uniform_pct, ncolors16, qr, lines and, if it has it, blur_var. The first rule that
    holds wins. An unknown ok counts as unreadable.
    """
    d = analyzed(items)
    a = lambda k: F.col(f"_a_{k}")
    side, area = F.least("w", "h"), F.col("w").cast("long") * F.col("h")
    std, uniform = F.col("lum_std"), F.col("uniform_pct")
    blank = F.coalesce((std < L.BLANK_STD) & (uniform >= L.BLANK_UNIFORM), F.lit(False))
    near_blank = F.coalesce((std < L.NEAR_STD) & (uniform >= L.NEAR_UNIFORM), F.lit(False))
    blur_moves, blur_says = blurred(F.col("blur_var") if "blur_var" in items.columns else F.lit(None).cast("double"), blur_rule, severe_moves)
    marketing = some(a("promos")) | some(a("promo_weak")) | some(a("ecommerce")) | some(a("prices")) | some(a("contacts")) | some(a("watermarks"))
    url = some(a("urls"))
    length = F.aggregate(a("texts"), F.lit(0), lambda n, t: n + F.length(t))
    logo = F.coalesce(F.col("ncolors16") <= L.LOGO_COLOURS, F.lit(False)) & some(a("texts")) & (length <= L.LOGO_LENGTH)
    rule = (
        F.when(~F.coalesce("ok", F.lit(False)), "corrupt")
        .when((side < L.TINY_SIDE) | (area < L.TINY_AREA), "tiny")
        .when(blank, "blank")
        .when(blur_moves, "blur")
        .when(url & marketing, "url")
        .when(~url & some(a("contacts")), "contact")
        .when(~url & some(a("prices")), "price")
        .when(~url & some(a("promos")), "promo")
        .when(~url & some(a("ecommerce")), "ecommerce")
        .when(~url & some(a("watermarks")), "watermark")
        .when(~url & some(a("marketing_overlay")), "overlay")
        .when(logo, "logo")
    )
    says = lambda k, x: F.concat(F.lit(L.EVIDENCE[k]), x)
    first = lambda k, source: says(k, listed(F.slice(a(source), 1, 3)))
    sized = F.format_string("%dx%d", "w", "h")
    doubts = F.array_distinct(
        F.array_compact(
            F.array(
                F.when(F.coalesce(F.size("qr") > 0, F.lit(False)), says("qr", F.substring(F.try_element_at("qr", F.lit(1)), 1, 40))),
                F.when(side < L.SMALL_SIDE, says("small", sized)),
                F.when(near_blank, says("near_blank", F.format_string("std=%.2f", std))),
                blur_says,
                F.when(some(a("watermark_weak")), first("watermark_weak", "watermark_weak")),
                F.when(some(a("marketing_weak")), first("marketing_weak", "marketing_weak")),
            )
        )
    )
    m = F.col("_move")
    error = F.coalesce(F.col("error") if "error" in items.columns else F.lit(None).cast("string"), F.lit("None"))
    why = F.when(m == "corrupt", says("corrupt", error)).when(m == "tiny", says("tiny", sized))
    why = why.when(m == "blank", says("blank", F.format_string("std=%.2f uniform=%.2f%%", std, uniform * 100)))
    why = why.when(m == "logo", F.concat(says("logo", F.col("ncolors16").cast("string")), F.lit("）")))
    for k, source in (("url", "urls"), ("contact", "contacts"), ("price", "prices"), ("promo", "promos"), ("ecommerce", "ecommerce"), ("watermark", "watermarks"), ("overlay", "marketing_overlay")):
        why = why.when(m == k, first(k, source))
    d = d.withColumn("_move", rule).withColumn("_doubts", doubts)
    moved = F.col("_move").isNotNull()
    doubtful = some(F.col("_doubts"))
    return d.select(
        *items.columns, F.struct(*[a(k).alias(k) for k in ALL]).alias("analysis"),
        F.when(moved, "MOVE").when(doubtful, "MOVE" if review_moves else "REVIEW").otherwise("KEEP").alias("decision"),
        F.when(moved, F.col("_move")).when(doubtful, "unsure" if review_moves else "review").otherwise("none").alias("rule"),
        F.when(m == "blur", F.col("_doubts")).when(moved, F.array(why)).when(doubtful, F.col("_doubts")).otherwise(F.expr(NO_STRINGS)).alias("evidence"),
        F.when(moved, 1.0).when(doubtful, 1.0 if review_moves else 0.5).otherwise(0.0).alias("score"),
    )


def _replace(d: DataFrame, when: Column, decision: str, rule: str, evidence: Column, score: float) -> DataFrame:
    return d.withColumns(
        {
            "evidence": F.when(when, F.array(evidence)).otherwise(F.col("evidence")),
            "score": F.when(when, score).otherwise(F.col("score")),
            "rule": F.when(when, rule).otherwise(F.col("rule")),
            "decision": F.when(when, decision).otherwise(F.col("decision")),
        }
    )


def refine_by_model(decided: DataFrame, prob: str = "prob") -> DataFrame:
    """A high score moves, a middling one asks for review or adds to the evidence; unrounded scores are compared."""
    p = F.col(prob)
    open_ = F.col("decision") != "MOVE"
    high, low = F.coalesce(p >= L.MODEL_MOVE, F.lit(False)) & open_, F.coalesce((p >= L.MODEL_REVIEW) & (p < L.MODEL_MOVE), F.lit(False)) & open_
    said = lambda k: F.concat(F.lit(L.EVIDENCE[k]), F.format_string("%.2f)", p))
    d = decided.withColumn("_high", high).withColumn("_new", low & (F.col("decision") == "KEEP")).withColumn("_more", low & (F.col("decision") == "REVIEW"))
    d = d.withColumn("evidence", F.when(F.col("_more"), F.concat("evidence", F.array(said("model_some")))).otherwise(F.col("evidence")))
    d = _replace(d, F.col("_high"), "MOVE", "model", said("model_high"), 1.0)
    d = _replace(d, F.col("_new"), "REVIEW", "review", said("model_some"), 0.5)
    return d.withColumn("wm_prob", F.when(open_ | F.col("_high"), F.round(p, 4))).drop("_high", "_new", "_more")


def refine_by_library(decided: DataFrame, hit: str = "library_hit", similarity: str = "library_similarity") -> DataFrame:
    """A near picture in the library moves what has not moved yet; the model's score goes with the old verdict."""
    when = F.coalesce(F.col(hit), F.lit(False)) & (F.col("decision") != "MOVE")
    d = decided.withColumn("_w", when)
    if "wm_prob" in d.columns:
        d = d.withColumn("wm_prob", F.when(~F.col("_w"), F.col("wm_prob")))
    return _replace(d, F.col("_w"), "MOVE", "library", F.concat(F.lit(L.EVIDENCE["library"]), F.format_string("%.2f%%", F.col(similarity) * 100)), 1.0).drop("_w")


def rescue(decided: DataFrame, error: str = "error") -> DataFrame:
    """Items whose analysis failed move, with the error as evidence and no size."""
    failed = F.col(error).isNotNull()
    d = _replace(decided.withColumn("_w", failed), F.col("_w"), "MOVE", "failed", F.concat(F.lit(L.EVIDENCE["failed"]), F.col(error)), 1.0)
    return (d.withColumn("bytes", F.when(F.col("_w"), F.lit(0).cast("long")).otherwise(F.col("bytes"))) if "bytes" in d.columns else d).drop("_w")


def override(decided: DataFrame, wishes: DataFrame) -> DataFrame:
    """User verdicts (filename, want) replace others; after duplicates are settled. wishes: one row for each filename."""
    d = decided.join(wishes, "filename", "left").withColumn("_w", F.coalesce(F.col("want") != F.col("decision"), F.lit(False)))
    w, moves = F.col("_w"), F.col("want") == "MOVE"
    return d.withColumns(
        {
            "rule": F.when(w, F.when(moves, "user_move").otherwise("user_keep")).otherwise(F.col("rule")),
            "evidence": F.when(w, F.array(F.lit(L.EVIDENCE["user"]))).otherwise(F.col("evidence")),
            "score": F.when(w, F.when(moves, 1.0).otherwise(0.0)).otherwise(F.col("score")),
            "decision": F.when(w, F.col("want")).otherwise(F.col("decision")),
            "overridden": w,
        }
    ).drop("want", "_w")


def label(rule: Column) -> Column:
    """The display text of a rule."""
    return F.element_at(F.create_map(*[F.lit(x) for kv in L.RULES.items() for x in kv]), rule)
