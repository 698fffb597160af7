"""Registered queries of the engine and their SQL. Keys begin with the operator they show."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftstone.functions import lexicon as L
from siftstone.functions import text as T
from siftstone.operators import decide as D
from siftstone.operators import evaluate as E
from siftstone.operators import rows as R
from siftstone.operators import sampling as S
from siftstone.operators import similarity as H
from siftstone.plans.standin import SQL, hashes, items, lines, planted_library, spread_out, table
from siftstone.sources.scratch import once

QUERIES: dict = {}
ORACLE: dict = {}


def _add(name: str, query, sql: str | None = None) -> None:
    QUERIES[name] = query
    if sql is not None:
        ORACLE[name] = sql


# ---- signals in text: distinct hits, in order, of each document that has any


def _signal(name: str, expression, hits: str) -> None:
    """hits: SQL for the list of hits in a line."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepared = lines(spread_out(table(spark, sf_dir, "documents"))).withColumn("n", T.normalized(F.col("lines"))).withColumn("w", T.joined(F.col("n")))
        found = prepared.select("doc_id", expression(T.Lines(F.col("n"), F.col("w"), T.heads(F.col("w")))).alias("x"))
        return found.filter(F.size("x") > 0).select("doc_id", F.array_join("x", "|").alias("hits"))

    _add(name, query, f"WITH {SQL}, {_ordered('m', hits)} SELECT doc_id, string_agg(x, '|' ORDER BY place) AS hits FROM m GROUP BY doc_id")


def _ordered(name: str, hits: str) -> str:
    """SQL for name(doc_id, x, place): distinct hits with the place of the first."""
    return (
        f"{name}_all AS (SELECT doc_id, rn, unnest(h) AS x, generate_subscripts(h, 1) AS i FROM (SELECT doc_id, rn, {hits} AS h FROM lin)), "
        f"{name} AS (SELECT doc_id, x, min(rn * 100000 + i) AS place FROM {name}_all WHERE x IS NOT NULL GROUP BY doc_id, x)"
    )


def _quoted(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def _re2(pattern: str) -> str:
    return _quoted(pattern.replace(r"[\w\-]", r"[\p{L}\p{N}_\-]").replace(r"[\w.+-]", r"[\p{L}\p{N}_.+-]").replace(r"[\w-]", r"[\p{L}\p{N}_-]"))


_SPACE = "regexp_replace(m, '^\\s+|\\s+$', '', 'g')"


def _found(patterns, flags: str = "") -> str:
    """All whole matches."""
    each = [f"regexp_extract_all(line, {_re2(flags + p)})" for p in patterns]
    return each[0] if len(each) == 1 else "flatten([" + ", ".join(each) + "])"


def _cut(matches: str) -> str:
    """Stripped, at most 80 characters of each."""
    return f"list_transform({matches}, lambda m: substr({_SPACE}, 1, 80))"


def _all(patterns) -> str:
    return _cut(_found(patterns))


def _words(words) -> str:
    def one(w: str) -> str:
        return f"contains(line, {_quoted(w)})" if T.has_cjk(w) else f"regexp_matches(line, {_quoted('(^|[^a-z0-9])' + re.escape(w).replace(chr(92) + ' ', ' ') + '([^a-z0-9]|$)')})"

    return "list_filter([" + ", ".join(f"CASE WHEN {one(w)} THEN {_quoted(w)} END" for w in words) + "], lambda x: x IS NOT NULL)"


_DIGITS = "regexp_replace(m, '[^\\p{Nd}]', '', 'g')"
_REAL = (
    f"length({_DIGITS}) >= 7 AND {_DIGITS} NOT IN ('1234567890', '0123456789', '9876543210', '0987654321') AND len(list_distinct(string_split({_DIGITS}, ''))) > 2"
    f" AND NOT contains('0123456789', {_DIGITS}) AND NOT contains('9876543210', {_DIGITS})"
)
_COMPANY = "regexp_extract(regexp_replace(" + _SPACE + ", '[/.]+$', ''), '^(.*)\\.[^.]*$', 1) IN (" + ", ".join(_quoted(x) for x in L.COMPANY_LABELS) + ")"


def _numbers(patterns) -> str:
    return _cut(f"list_filter({_found(patterns)}, lambda m: {_REAL})")


_URLS = _cut(f"list_filter({_found(L.URL_PATTERNS)}, lambda m: NOT {_COMPANY})")
_EMAILS = _all(L.EMAIL_PATTERNS)
_CONTACTS = f"flatten([{_EMAILS}, {_numbers(L.PHONE_PATTERNS)}, {_numbers(L.US_PHONE_PATTERNS)}, {_all(L.QQ_PATTERNS)}, {_words(L.CONTACT_KEYWORDS)}])"
_PRICES = _cut(f"list_filter({_found(L.PRICE_PATTERNS, '(?i)')}, lambda m: NOT (length({_DIGITS}) > 6 AND NOT contains(m, '.')))")
_PHRASES = "flatten([" + ", ".join(f"regexp_extract_all(line, {_quoted('(?:^|[^a-z0-9])(' + p + ')(?:[^a-z0-9]|$)')}, 1)" for p in L.PROMO_PHRASES) + "])"
_IGNORED = "regexp_matches(line, " + _quoted("|".join(L.PROMO_IGNORE_PHRASES)) + ")"
_HITS = {
    "urls": _URLS, "contacts": _CONTACTS, "contact_weak": f"list_concat({_numbers(L.PHONE_WEAK_PATTERNS)}, {_words(L.CONTACT_WEAK_KEYWORDS)})", "prices": _PRICES,
    "promos": f"list_concat({_PHRASES}, {_words(L.PROMO_KEYWORDS)})", "promo_weak": f"CASE WHEN {_IGNORED} THEN [] ELSE {_words(L.PROMO_WEAK_KEYWORDS)} END",
    "ecommerce": _words(L.PLATFORM_KEYWORDS), "watermarks": _words(L.MARK_KEYWORDS), "watermark_weak": _words(L.MARK_WEAK_KEYWORDS),
    "marketing_overlay": _all(L.OVERLAY_PATTERNS), "marketing_weak": _all(L.OVERLAY_WEAK_PATTERNS), "keep_terms": _words(L.KEEP_LEXICON),
}

_signal("t4_urls", T.urls, _URLS)
_signal("t6_emails", T.emails, _EMAILS)
_signal("t7_phones", T.phones, _numbers(L.PHONE_PATTERNS))
_signal("t8_weak_phones", T.weak_phones, _numbers(L.PHONE_WEAK_PATTERNS))
_signal("t9_us_phones", T.us_phones, _numbers(L.US_PHONE_PATTERNS))
_signal("t11_qq_numbers", T.qq_numbers, _all(L.QQ_PATTERNS))
_signal("t12_prices", T.prices, _PRICES)
_signal("t14_promo_phrases", T.promo_phrases, _PHRASES)
_signal("t15_overlays", T.overlays, _HITS["marketing_overlay"])
_signal("t16_weak_overlays", T.overlays_weak, _HITS["marketing_weak"])
_signal("t18_contacts", T.contacts, _CONTACTS)
_signal("t19_weak_contacts", T.contact_weak, _HITS["contact_weak"])
_signal("t20_promos", T.promos, _HITS["promos"])
_signal("t21_weak_promos", T.promo_weak, _HITS["promo_weak"])
for _k, _f, _w in (("t22_platforms", "ecommerce", L.PLATFORM_KEYWORDS), ("t23_marks", "watermarks", L.MARK_KEYWORDS), ("t24_weak_marks", "watermark_weak", L.MARK_WEAK_KEYWORDS), ("t25_keep_terms", "keep_terms", L.KEEP_LEXICON)):
    _signal(_k, T.words_of(_w), _HITS[_f])

_add(
    "t1_usable_lines",
    lambda s, d: lines(spread_out(table(s, d, "documents"))).select("doc_id", F.size(T.usable(F.col("lines"))).cast("long").alias("n")),
    f"WITH {SQL} SELECT d.doc_id, count(lin.doc_id) AS n FROM documents d LEFT JOIN lin ON lin.doc_id = d.doc_id GROUP BY d.doc_id",
)
_add(
    "t3_texts",
    lambda s, d: lines(spread_out(table(s, d, "documents"))).select("doc_id", F.array_join(T.texts(F.col("lines")), " | ").alias("shown")),
    f"WITH {SQL} SELECT d.doc_id, coalesce(string_agg(substr(raw, 1, 120), ' | ' ORDER BY rn), '') AS shown FROM documents d LEFT JOIN lin ON lin.doc_id = d.doc_id GROUP BY d.doc_id",
)
_add(
    "t27_analysis",
    lambda s, d: T.analyzed(lines(spread_out(table(s, d, "documents")))).select("doc_id", *[F.size(f"_a_{k}").cast("long").alias(k) for k in T.ALL]),
    f"WITH {SQL}, " + ", ".join(f"n_{k} AS (SELECT doc_id, count(DISTINCT x) AS n FROM (SELECT doc_id, unnest({v}) AS x FROM lin) GROUP BY doc_id)" for k, v in _HITS.items())
    + ", n_texts AS (SELECT doc_id, count(*) AS n FROM lin GROUP BY doc_id) SELECT d.doc_id, " + ", ".join(f"coalesce(n_{k}.n, 0) AS {k}" for k in [*_HITS, "texts"])
    + " FROM documents d " + " ".join(f"LEFT JOIN n_{k} ON n_{k}.doc_id = d.doc_id" for k in [*_HITS, "texts"]),
)

# ---- hashes

_BITS = """hh AS (SELECT vec_id, list_sum([CASE WHEN embedding[i] > med THEN (1::HUGEINT << (64 - i)::HUGEINT) ELSE 0::HUGEINT END FOR i IN range(1, 65)]) AS u FROM (
  SELECT vec_id, embedding, (list_sort(embedding)[32]::DOUBLE + list_sort(embedding)[33]::DOUBLE) / 2 AS med FROM embeddings))"""
_LIBRARY = f"""{_BITS}, lib AS (SELECT DISTINCT xor(u::HUGEINT, CASE vec_id % 30 WHEN 10 THEN 1 WHEN 20 THEN 3 ELSE 0 END::HUGEINT) AS l FROM hh WHERE vec_id % 10 = 0),
libhit AS (SELECT vec_id, 1 - min(bit_count(xor(u::HUGEINT, l))) / 64.0::DOUBLE AS near FROM hh, lib WHERE bit_count(xor(u::HUGEINT, l)) <= 1 GROUP BY vec_id)"""

# ---- verdicts

_ANY = {k: f"len({v}) > 0" for k, v in _HITS.items()}
_DECIDED = f"""{SQL},
{_LIBRARY},
sig AS (SELECT doc_id, {', '.join(f'bool_or({v}) AS {k}' for k, v in _ANY.items())}, sum(length(substr(raw, 1, 120))) AS chars FROM lin GROUP BY doc_id),
ruled AS (
  SELECT i.*, promo_weak, contact_weak, urls, CASE
    WHEN NOT ok THEN 'corrupt' WHEN least(w, h) < 80 OR w * h < 8000 THEN 'tiny' WHEN lum_std < 5.0 AND uniform_pct >= 0.97 THEN 'blank'
    WHEN urls AND (promos OR promo_weak OR ecommerce OR prices OR contacts OR watermarks) THEN 'url'
    WHEN NOT coalesce(urls, false) AND contacts THEN 'contact' WHEN NOT coalesce(urls, false) AND prices THEN 'price' WHEN NOT coalesce(urls, false) AND promos THEN 'promo'
    WHEN NOT coalesce(urls, false) AND ecommerce THEN 'ecommerce' WHEN NOT coalesce(urls, false) AND watermarks THEN 'watermark'
    WHEN NOT coalesce(urls, false) AND marketing_overlay THEN 'overlay' WHEN ncolors16 <= 4 AND chars <= 60 THEN 'logo' END AS move,
    has_qr OR least(w, h) < 150 OR (lum_std < 7.0 AND uniform_pct >= 0.90) OR coalesce(watermark_weak, false) OR coalesce(marketing_weak, false) AS doubt
  FROM item i LEFT JOIN sig ON sig.doc_id = i.doc_id),
decided AS (
  SELECT *, CASE WHEN move IS NOT NULL THEN 'MOVE' WHEN doubt THEN 'REVIEW' ELSE 'KEEP' END AS decision,
    CASE WHEN move IS NOT NULL THEN move WHEN doubt THEN 'review' ELSE 'none' END AS rule,
    CASE WHEN move IS NOT NULL THEN 1.0::DOUBLE WHEN doubt THEN 0.5 ELSE 0.0 END AS score FROM ruled),
refined AS (
  SELECT doc_id, filename, md5, prob, promo_weak, contact_weak, urls, CASE WHEN decision = 'MOVE' THEN decision WHEN prob >= 0.3 THEN 'MOVE' WHEN prob >= 0.15 THEN 'REVIEW' ELSE decision END AS decision,
    CASE WHEN decision = 'MOVE' THEN rule WHEN prob >= 0.3 THEN 'model' WHEN prob >= 0.15 THEN 'review' ELSE rule END AS rule,
    CASE WHEN decision = 'MOVE' THEN score WHEN prob >= 0.3 THEN 1.0 WHEN prob >= 0.15 THEN 0.5 ELSE score END AS score FROM decided),
libbed AS (
  SELECT refined.* REPLACE (CASE WHEN decision <> 'MOVE' AND near IS NOT NULL THEN 'MOVE' ELSE decision END AS decision,
    CASE WHEN decision <> 'MOVE' AND near IS NOT NULL THEN 'library' ELSE rule END AS rule, CASE WHEN decision <> 'MOVE' AND near IS NOT NULL THEN 1.0 ELSE score END AS score) FROM refined LEFT JOIN libhit ON vec_id = doc_id),
grouped AS (SELECT md5 AS g, bool_or(decision = 'MOVE') AS any_move, count(*) AS n FROM libbed WHERE md5 IS NOT NULL GROUP BY md5),
spread AS (
  SELECT l.* REPLACE (CASE WHEN any_move AND n > 1 THEN 'MOVE' ELSE decision END AS decision, CASE WHEN any_move AND n > 1 AND decision <> 'MOVE' THEN 'duplicate' ELSE rule END AS rule,
    CASE WHEN any_move AND n > 1 THEN 1.0 ELSE score END AS score), coalesce(any_move AND n > 1 AND decision <> 'MOVE', false) AS changed FROM libbed l LEFT JOIN grouped ON g = md5),
final AS (
  SELECT s.* REPLACE (coalesce(want, decision) AS decision, CASE WHEN want <> decision THEN CASE want WHEN 'MOVE' THEN 'user_move' ELSE 'user_keep' END ELSE rule END AS rule,
    CASE WHEN want <> decision THEN CASE want WHEN 'MOVE' THEN 1.0 ELSE 0.0 END ELSE score END AS score), coalesce(want <> decision, false) AS overridden
  FROM (SELECT *, CASE WHEN doc_id % 50 = 3 THEN 'MOVE' WHEN doc_id % 50 = 13 THEN 'KEEP' END AS want FROM spread) s),
human AS (SELECT DISTINCT 'img_' || doc_id || '.jpg' AS name FROM labels WHERE quality = 0 OR toxic = 1),
outcome AS (
  SELECT f.*, CASE WHEN decision = 'MOVE' AND name IS NOT NULL THEN 'TP' WHEN decision = 'MOVE' THEN 'FP' WHEN name IS NOT NULL THEN 'FN' ELSE 'TN' END AS outcome
  FROM final f LEFT JOIN human ON name = filename)"""


def decided(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.decide(items(spark, sf_dir))


def refined(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.refine_by_model(decided(spark, sf_dir))


def libbed(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = hashes(spark, sf_dir)
    near = H.match_library(h, planted_library(h), "vec_id").withColumnRenamed("vec_id", "doc_id")
    d = refined(spark, sf_dir).join(near, "doc_id", "left").withColumn("library_hit", F.col("library_similarity").isNotNull())
    return D.refine_by_library(d)


def spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.propagate(once(libbed(spark, sf_dir).drop("lines", "qr")))


def wishes(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("doc_id")
    want = F.when(d % 50 == 3, "MOVE").when(d % 50 == 13, "KEEP")
    return table(spark, sf_dir, "documents").select(F.concat(F.lit("img_"), d.cast("string"), F.lit(".jpg")).alias("filename"), want.alias("want")).filter("want IS NOT NULL").distinct()


def final(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.override(spread(spark, sf_dir), wishes(spark, sf_dir))


def human(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").filter("quality = 0 OR toxic = 1").select(F.concat(F.lit("IMG_"), F.col("doc_id").cast("string"), F.lit(".jpg")).alias("filename")).distinct()


def outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.classified(final(spark, sf_dir), human(spark, sf_dir))


_THREE = ["doc_id", "decision", "rule", "score"]
_pick = lambda f, *c: lambda s, d: f(s, d).select(*c)
_add("f1_f16_decide", _pick(decided, *_THREE), f"WITH {_DECIDED} SELECT doc_id, decision, rule, score FROM decided")
_add("f17_f18_model", _pick(refined, *_THREE), f"WITH {_DECIDED} SELECT doc_id, decision, rule, score FROM refined")
_add("f19_library", _pick(libbed, *_THREE), f"WITH {_DECIDED} SELECT doc_id, decision, rule, score FROM libbed")
_add("w1_a6_propagate", _pick(spread, *_THREE, "changed"), f"WITH {_DECIDED} SELECT doc_id, decision, rule, score, changed FROM spread")
_add("j3_override", _pick(final, *_THREE, "overridden"), f"WITH {_DECIDED} SELECT doc_id, decision, rule, score, overridden FROM final")
_add("p16_labels", lambda s, d: final(s, d).select("doc_id", D.label(F.col("rule")).alias("label")), f"WITH {_DECIDED} SELECT doc_id, CASE rule " + " ".join(f"WHEN {_quoted(k)} THEN {_quoted(v)}" for k, v in L.RULES.items()) + " END AS label FROM final")
_add("f15_review_moves", lambda s, d: D.decide(items(s, d), review_moves=True).select(*_THREE), f"WITH {_DECIDED} SELECT doc_id, CASE decision WHEN 'REVIEW' THEN 'MOVE' ELSE decision END AS decision, CASE decision WHEN 'REVIEW' THEN 'unsure' ELSE rule END AS rule, CASE decision WHEN 'REVIEW' THEN 1.0 ELSE score END AS score FROM decided")
_REPR = """CASE WHEN contains(x, '''') AND NOT contains(x, '"') THEN '"' || x || '"' ELSE '''' || x || '''' END"""
_FIRSTS = {"url": "urls", "contact": "contacts", "price": "prices", "promo": "promos", "ecommerce": "ecommerce", "watermark": "watermarks", "overlay": "marketing_overlay"}
_add(
    "t28_evidence",
    lambda s, d: once(decided(s, d).drop("lines", "analysis")).filter(F.col("rule").isin(*_FIRSTS, "tiny", "logo")).select("doc_id", F.array_join("evidence", "; ").alias("evidence")),
    f"WITH {_DECIDED}, " + ", ".join(_ordered(f"o_{k}", _HITS[v]) for k, v in _FIRSTS.items())
    + ", said AS (" + " UNION ALL ".join(f"SELECT doc_id, '{k}' AS rule, {_quoted(L.EVIDENCE[k])} || '[' || string_agg({_REPR}, ', ' ORDER BY place) || ']' AS evidence FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY place) AS r FROM o_{k}) WHERE r <= 3 GROUP BY doc_id" for k, v in _FIRSTS.items())
    + ") SELECT d.doc_id, CASE d.rule WHEN 'tiny' THEN " + _quoted(L.EVIDENCE["tiny"]) + " || w || 'x' || h WHEN 'logo' THEN " + _quoted(L.EVIDENCE["logo"]) + " || ncolors16 || '）' ELSE evidence END AS evidence "
    "FROM decided d LEFT JOIN said ON said.doc_id = d.doc_id AND said.rule = d.rule WHERE d.rule IN ('tiny', 'logo', " + ", ".join(f"'{k}'" for k in _FIRSTS) + ")",
)
_add("a1_counts", lambda s, d: E.summary(final(s, d)).drop("by_rule"), f"WITH {_DECIDED} SELECT count(*) AS total, count(*) FILTER (decision = 'MOVE') AS moved, count(*) FILTER (decision = 'KEEP') AS keep, count(*) FILTER (decision = 'REVIEW') AS review FROM final")
_add("a2_o4_moves_by_rule", lambda s, d: E.moves_by_rule(final(s, d)), f"WITH {_DECIDED} SELECT rule, count(*) AS n FROM final WHERE decision = 'MOVE' GROUP BY rule")
_add("o4_top_rules", lambda s, d: E.moves_by_rule(final(s, d)).orderBy(F.desc("n"), "rule").limit(3), f"WITH {_DECIDED} SELECT rule, count(*) AS n FROM final WHERE decision = 'MOVE' GROUP BY rule ORDER BY n DESC, rule LIMIT 3")
_add("j8_outcomes", _pick(outcomes, "doc_id", "outcome"), f"WITH {_DECIDED} SELECT doc_id, outcome FROM outcome")
_add("a3_confusion", lambda s, d: E.confusion(outcomes(s, d)), f"WITH {_DECIDED} SELECT count(*) FILTER (outcome = 'TP') AS tp, count(*) FILTER (outcome = 'FP') AS fp, count(*) FILTER (outcome = 'FN') AS fn, count(*) FILTER (outcome = 'TN') AS tn FROM outcome")
_add(
    "a4_metrics",
    lambda s, d: E.metrics(outcomes(s, d)).select(*[F.round(k, 9).alias(k) for k in ("precision", "recall", "f1", "agreement")]),
    f"""WITH {_DECIDED}, c AS (SELECT count(*) FILTER (outcome = 'TP')::DOUBLE AS tp, count(*) FILTER (outcome = 'FP')::DOUBLE AS fp, count(*) FILTER (outcome = 'FN')::DOUBLE AS fn, count(*)::DOUBLE AS n, count(*) FILTER (outcome = 'TN')::DOUBLE AS tn FROM outcome),
p AS (SELECT *, CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END AS pr, CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END AS re FROM c)
SELECT round(pr, 9) AS precision, round(re, 9) AS recall, round(CASE WHEN pr + re = 0 THEN 0 ELSE 2 * pr * re / (pr + re) END, 9) AS f1, round(CASE WHEN n = 0 THEN 0 ELSE (tp + tn) / n END, 9) AS agreement FROM p""",
)
_add("a5_false_moves_by_rule", lambda s, d: E.false_moves_by_rule(outcomes(s, d)), f"WITH {_DECIDED} SELECT rule, count(*) AS n FROM outcome WHERE outcome = 'FP' GROUP BY rule")
_add("a7_missed_by_score", lambda s, d: E.missed_by_score(outcomes(s, d)), f"WITH {_DECIDED} SELECT CASE WHEN prob IS NULL THEN 'none' WHEN prob < 0.15 THEN '<0.15' WHEN prob < 0.2 THEN '0.15-0.2' ELSE '>=0.2' END AS bucket, count(*) AS n FROM outcome WHERE outcome = 'FN' GROUP BY 1")
_add("f23_triage", lambda s, d: E.triage(outcomes(s, d).filter("outcome = 'FN'")).select("doc_id", "action"), f"WITH {_DECIDED} SELECT doc_id, CASE WHEN urls OR promo_weak OR contact_weak THEN 'add_hash' ELSE 'model_miss' END AS action FROM outcome WHERE outcome = 'FN'")
_side = lambda which: lambda s, d: E.compared(final(s, d).filter("decision = 'MOVE'"), human(s, d)).filter(F.col("side") == which).select("filename")
_add("u1_both", _side("both"), f"WITH {_DECIDED} SELECT filename FROM final WHERE decision = 'MOVE' INTERSECT SELECT name FROM human")
_add("u2_only_ours", _side("ours"), f"WITH {_DECIDED} SELECT filename FROM final WHERE decision = 'MOVE' EXCEPT SELECT name FROM human")
_add("u3_only_theirs", _side("theirs"), f"WITH {_DECIDED} SELECT name AS filename FROM human EXCEPT SELECT filename FROM final WHERE decision = 'MOVE'")

# ---- hashes

_add("p14_phash", lambda s, d: hashes(s, d).select("vec_id", H.unsigned(F.col("phash")).cast("string").alias("u")), f"WITH {_BITS} SELECT vec_id, CAST(u AS DECIMAL(38,0))::VARCHAR AS u FROM hh")
_add(
    "j7_library_match",
    lambda s, d: H.match_library(hashes(s, d), planted_library(hashes(s, d)), "vec_id"),
    f"WITH {_LIBRARY} SELECT vec_id, near AS library_similarity FROM libhit",
)

_add(
    "a9_best_match",
    lambda s, d: H.best_match(hashes(s, d), planted_library(hashes(s, d)), "vec_id"),
    f"WITH {_LIBRARY} SELECT vec_id, 1 - min(bit_count(xor(u::HUGEINT, l))) / 64.0::DOUBLE AS best_similarity FROM hh, lib GROUP BY vec_id",
)

# ---- logs, sets, samples

_add(
    "a8_keep_last",
    lambda s, d: R.keep_last(table(s, d, "events").select("user_id", "event_id", "event_type", "value"), "user_id", "event_id"),
    "SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type, arg_max(value, event_id) AS value, min(event_id) AS _first FROM events WHERE user_id IS NOT NULL GROUP BY user_id",
)
_halves = lambda s, d: (table(s, d, "events").filter(f"event_id % 2 = {k}").groupBy("user_id").agg(F.max("event_id").alias("event_id")) for k in (0, 1))
_add(
    "u6_upsert",
    lambda s, d: R.upsert(*_halves(s, d), "user_id"),
    "WITH o AS (SELECT user_id, max(event_id) AS event_id FROM events WHERE event_id % 2 = 0 GROUP BY 1), n AS (SELECT user_id, max(event_id) AS event_id FROM events WHERE event_id % 2 = 1 GROUP BY 1) "
    "SELECT * FROM o WHERE user_id NOT IN (SELECT user_id FROM n) UNION ALL SELECT * FROM n",
)
_add(
    "j2_unseen",
    lambda s, d: R.unseen(table(s, d, "documents").select("doc_id"), table(s, d, "labels"), "doc_id"),
    "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
)
_add(
    "j1_index",
    lambda s, d: R.with_original(items(s, d), table(s, d, "labels").select(F.concat(F.lit("img_"), F.col("doc_id").cast("string"), F.lit(".jpg")).alias("filename"), F.concat(F.lit("/orig/"), F.col("doc_id").cast("string")).alias("orig_path")).distinct()).select("doc_id", "orig_path"),
    "SELECT d.doc_id, CASE WHEN l.doc_id IS NOT NULL THEN '/orig/' || d.doc_id ELSE '/batch/images/img_' || d.doc_id || '.jpg' END AS orig_path FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l ON l.doc_id = d.doc_id",
)
_add("j12_present", lambda s, d: R.present(final(s, d).filter("decision = 'MOVE'"), table(s, d, "labels"), "doc_id").select("doc_id"), f"WITH {_DECIDED} SELECT doc_id FROM final WHERE decision = 'MOVE' AND doc_id IN (SELECT doc_id FROM labels)")
_add(
    "w2_clash_names",
    lambda s, d: R.clash_names(table(s, d, "documents").select(F.concat("source", F.lit(".webp")).alias("filename"), F.format_string("/p/%012d", "doc_id").alias("path"))).select("path", "target"),
    "SELECT path, CASE n WHEN 0 THEN source || '.webp' ELSE source || '_' || n || '.webp' END AS target FROM (SELECT source, '/p/' || lpad(doc_id::VARCHAR, 12, '0') AS path, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS n FROM documents)",
)
_add("o3_sample", lambda s, d: S.sample(table(s, d, "documents").select("doc_id"), 50, "doc_id"), "SELECT doc_id FROM documents ORDER BY md5('42:' || doc_id), doc_id LIMIT 50")
_add("o2_first", lambda s, d: S.first(table(s, d, "documents").select("doc_id"), 20, "doc_id"), "SELECT doc_id FROM documents ORDER BY doc_id LIMIT 20")
_add(
    "o8_class_caps",
    lambda s, d: S.cap_per_class(table(s, d, "labels").select("doc_id", "quality"), "quality", {0: 30, 1: 60}, "doc_id"),
    "SELECT doc_id, quality FROM (SELECT *, row_number() OVER (PARTITION BY quality ORDER BY md5('42:' || doc_id), doc_id) AS r FROM labels) WHERE r <= CASE quality WHEN 0 THEN 30 ELSE 60 END",
)
_add(
    "o7_split",
    lambda s, d: S.split(table(s, d, "documents").select("doc_id"), 0.15, "doc_id"),
    "SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) <= (SELECT greatest(1, floor(0.15 * count(*))) FROM documents) THEN 'valid' ELSE 'train' END AS part FROM documents",
)
_add(
    "o9_shards",
    lambda s, d: S.shards(table(s, d, "documents").select("doc_id"), 7, "doc_id"),
    "SELECT doc_id, CAST(floor((row_number() OVER (ORDER BY doc_id) - 1) / ceil((SELECT count(*) FROM documents) / 7.0)) AS INTEGER) AS shard FROM documents",
)
_add(
    "m6_training_set",
    lambda s, d: table(s, d, "labels").filter("toxic = 1").select("doc_id", F.lit(1).alias("label")).unionByName(
        table(s, d, "labels").filter("quality = 1").select("doc_id", F.lit(0).alias("label")).join(table(s, d, "labels").filter("toxic = 1").select("doc_id"), "doc_id", "left_anti")
    ),
    "SELECT doc_id, 1 AS label FROM labels WHERE toxic = 1 UNION ALL SELECT doc_id, 0 FROM labels WHERE quality = 1 AND doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)",
)
_add("p13_fingerprint", lambda s, d: R.fingerprinted(table(s, d, "documents"), "text", 16).select("doc_id", "fingerprint"), "SELECT doc_id, substr(md5(text), 1, 16) AS fingerprint FROM documents")
_add("a13_duplicate_groups", lambda s, d: R.duplicate_groups(R.fingerprinted(table(s, d, "documents"), "text").withColumnRenamed("fingerprint", "md5")), "SELECT md5(text) AS md5, count(*) AS n FROM documents GROUP BY 1 HAVING count(*) > 1")
_add(
    "p19_status",
    lambda s, d: E.status(table(s, d, "documents"), table(s, d, "labels"), "doc_id"),
    "SELECT count(*) AS total, count(l.doc_id) AS done, CASE WHEN count(*) = 0 THEN 0 ELSE round(100.0::DOUBLE * count(l.doc_id) / count(*)) END AS pct FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l ON l.doc_id = d.doc_id",
)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents by verdict and rule after all refinements."""
    return final(spark, sf_dir).groupBy("decision", "rule").agg(F.count("*").alias("n"))


_add("flagship", flagship, f"WITH {_DECIDED} SELECT decision, rule, count(*) AS n FROM final GROUP BY decision, rule")
