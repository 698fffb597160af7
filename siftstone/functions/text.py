"""Signals in recognized text lines, as column expressions over array<struct<text, conf>>.

Everything is one projection: no explode, no shuffle, no Python. Java's (?U) gives patterns the Unicode
reading of \\w, \\s and \\b.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftstone.functions import lexicon as L

NO_STRINGS = "CAST(array() AS array<string>)"


def strip(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def usable(lines: Column) -> Column:
    """The first lines, then those of enough confidence."""
    return F.filter(F.slice(F.coalesce(lines, F.expr("CAST(array() AS array<struct<text:string,conf:double>>)")), 1, L.LINES), lambda x: x["conf"] >= L.CONFIDENCE)


def normal(text: Column) -> Column:
    return F.lower(strip(F.coalesce(text, F.lit(""))))


def texts(lines: Column) -> Column:
    return F.transform(usable(lines), lambda x: F.substring(x["text"], 1, 120))


def _matches(line: Column, patterns: tuple[str, ...], flags: str = "(?U)") -> Column:
    found = [F.regexp_extract_all(line, F.lit(flags + p), F.lit(0)) for p in patterns]
    return found[0] if len(found) == 1 else F.concat(*found)


def _shown(matches: Column) -> Column:
    """As reports have them: stripped, at most 80 characters of each. What a match is, its whole text decides before."""
    return F.transform(matches, lambda m: F.substring(strip(m), 1, 80))


def _hits(line: Column, patterns: tuple[str, ...], flags: str = "(?U)") -> Column:
    return _shown(_matches(line, patterns, flags))


@dataclass(frozen=True)
class Lines:
    """Usable lines made normal, and all of them as one text, by which most items are passed over at once.

    heads: those heads of known words that the text holds; see `heads`.
    """

    normal: Column
    whole: Column
    heads: Column


def normalized(lines: Column) -> Column:
    return F.transform(usable(lines), lambda x: normal(x["text"]))


def of(lines: Column) -> Lines:
    n = normalized(lines)
    return Lines(n, joined(n), heads(joined(n)))


def joined(normalized: Column) -> Column:
    return F.array_join(normalized, "\n")


def _per_line(lines: Lines, needed: Needed | None, of_line, words: tuple[str, ...] = ()) -> Column:
    """Ordered distinct hits over the lines: of_line(line, the words that the whole text holds).

    needed: what a text with a hit of a pattern holds. A text without it and without a word is passed over by plain
    searches, without a pattern. Words are searched for only where the text holds their heads.
    """
    none = F.expr(NO_STRINGS)
    found = lambda b, h: F.array_distinct(F.flatten(F.transform(b["n"], lambda x: of_line(x, h))))
    table = F.array(*[F.struct(F.lit(w).alias("w"), F.lit(keyword_pattern(w)).alias("p"), F.lit(head(w)).alias("h")) for w in words])

    def of_text(b: Column) -> Column:
        if not words:
            return F.when(needed(b["w"]), found(b, F.lit(0))).otherwise(none)
        some = lambda h: (F.size(h) > 0) | needed(b["w"]) if needed else F.size(h) > 0
        held = F.filter(table, lambda k: F.array_contains(b["h"], k["h"]) & F.contains(b["w"], k["w"]))
        return _bound(held, lambda h: F.when(some(h), found(b, h)).otherwise(none))

    return _bound(F.struct(lines.normal.alias("n"), lines.whole.alias("w"), *([lines.heads.alias("h")] if words else [])), of_text)


def _bound(value: Column, f: Callable[[Column], Column]) -> Column:
    """f of a value that is computed once, however often f reads it: an array of one binds it."""
    return F.element_at(F.transform(F.array(value), f), 1)


def _where(needed: Needed, line: Column, hits: Column) -> Column:
    """Hits of patterns in a line, which are tried only where it holds what they need."""
    return F.when(needed(line), hits).otherwise(F.expr(NO_STRINGS))


def head(word: str) -> str:
    """What a text holds by itself wherever the word stands in it: a CJK character, else its first run of letters and digits."""
    return re.search("[一-鿿]" if has_cjk(word) else "[a-z0-9]+", word)[0]


def heads(whole: Column) -> Column:
    """The heads of all known words that a normal text holds: one pass over the text, whatever the number of words."""
    known = {head(w) for ws in WORDS for w in ws}
    those = lambda found, cjk: F.array_intersect(found, F.array(*[F.lit(h) for h in sorted(known) if has_cjk(h) == cjk]))
    return _bound(whole, lambda w: F.concat(those(F.split(w, "[^a-z0-9]+"), False), those(F.split(F.regexp_replace(w, "[^一-鿿]+", ""), ""), True)))


WORDS = (L.CONTACT_KEYWORDS, L.CONTACT_WEAK_KEYWORDS, L.PROMO_KEYWORDS, L.PROMO_WEAK_KEYWORDS, L.PLATFORM_KEYWORDS, L.MARK_KEYWORDS, L.MARK_WEAK_KEYWORDS, L.KEEP_LEXICON)


def has_cjk(word: str) -> bool:
    return re.search("[一-鿿]", word) is not None


def keyword_pattern(word: str) -> str:
    return re.escape(word) if has_cjk(word) else f"(?<![a-z0-9]){re.escape(word)}(?![a-z0-9])"


def keywords(line: Column, held: Column) -> Column:
    """Those of the words that stand in the line, in list order."""
    return F.transform(F.filter(held, lambda k: F.contains(line, k["w"]) & F.regexp_like(line, k["p"])), lambda k: k["w"])


def digits(text: Column) -> Column:
    """Decimal digits of any script."""
    return F.regexp_replace(text, r"(?U)\D", "")


def placeholder(text: Column) -> Column:
    """Template numbers: short, known, of two digits at most, or counting up or down by one."""
    d = digits(text)
    steps = F.contains(F.lit("0123456789"), d) | F.contains(F.lit("9876543210"), d)
    return (F.length(d) < 7) | d.isin(*L.PLACEHOLDER_DIGITS) | (F.size(F.array_distinct(F.split(d, ""))) <= 2) | steps


def company_abbreviation(text: Column) -> Column:
    return F.regexp_extract(F.regexp_replace(F.lower(text), r"[/.]+$", ""), r"(?s)^(.*)\.[^.]*$", 1).isin(*L.COMPANY_LABELS)


def part_number(text: Column) -> Column:
    return (F.length(digits(text)) > 6) & ~F.contains(text, F.lit("."))


Needed = Callable[[Column], Column]


def _one_of(*needles: str, pattern: str | None = None) -> Needed:
    """Whether a text holds one of the needles or a match of the pattern."""

    def needed(text: Column) -> Column:
        return reduce(or_, [F.contains(text, F.lit(x)) for x in needles] + ([F.regexp_like(text, F.lit(pattern))] if pattern else []))

    return needed


#: What every match of the patterns holds.
IN_URL = _one_of("http", "www.", pattern=r"\.(?:com|cn|net|org|io|co|cc|biz|info|shop|store|online|xyz|top|vip|club|site|me|us)")
IN_EMAIL = _one_of("@")
IN_PHONE = _one_of("+", "tel", "phone", "mobile", "电话", "手机", "contact")
IN_QQ = _one_of("qq", "扣扣")
# Long s stands for s where case is ignored.
IN_PRICE = _one_of("$", "￥", "¥", "usd", "eur", "gbp", "rmb", "cny", "price", "ſ")
IN_PROMO = _one_of("free", "special", "hot", "best")
IN_OVERLAY = _one_of("faster", "fastdelivery", "warehouses", "seller", "dealer", "stockist", "uploaded", "genuine", "question", "fitment")
IN_OVERLAY_WEAK = _one_of("warehouse", "catalog")
IN_NUMBER = _one_of(pattern=r"(?U)\d\d\d")
IN_CONTACT = lambda text: IN_EMAIL(text) | IN_PHONE(text) | IN_QQ(text) | IN_NUMBER(text)


def _numbers(line: Column, patterns: tuple[str, ...]) -> Column:
    return _shown(F.filter(_matches(line, patterns), lambda m: ~placeholder(m)))


def _urls(x: Column) -> Column:
    return _where(IN_URL, x, _shown(F.filter(_matches(x, L.URL_PATTERNS), lambda m: ~company_abbreviation(strip(m)))))


def _emails(x: Column) -> Column:
    return _where(IN_EMAIL, x, _hits(x, L.EMAIL_PATTERNS))


def _phones(x: Column) -> Column:
    return _where(IN_PHONE, x, _numbers(x, L.PHONE_PATTERNS))


def _us_phones(x: Column) -> Column:
    return _where(IN_NUMBER, x, _numbers(x, L.US_PHONE_PATTERNS))


def _weak_phones(x: Column) -> Column:
    return _where(IN_NUMBER, x, _numbers(x, L.PHONE_WEAK_PATTERNS))


def _qq_numbers(x: Column) -> Column:
    return _where(IN_QQ, x, _hits(x, L.QQ_PATTERNS))


def _promo_phrases(x: Column) -> Column:
    return _where(IN_PROMO, x, _hits(x, GUARDED))


def urls(lines: Lines) -> Column:
    return _per_line(lines, IN_URL, lambda x, _: _urls(x))


def emails(lines: Lines) -> Column:
    return _per_line(lines, IN_EMAIL, lambda x, _: _emails(x))


def phones(lines: Lines) -> Column:
    return _per_line(lines, IN_PHONE, lambda x, _: _phones(x))


def us_phones(lines: Lines) -> Column:
    return _per_line(lines, IN_NUMBER, lambda x, _: _us_phones(x))


def weak_phones(lines: Lines) -> Column:
    return _per_line(lines, IN_NUMBER, lambda x, _: _weak_phones(x))


def qq_numbers(lines: Lines) -> Column:
    return _per_line(lines, IN_QQ, lambda x, _: _qq_numbers(x))


def contacts(lines: Lines) -> Column:
    """E-mail, strong and US telephone, QQ numbers, then contact words, line by line."""
    return _per_line(lines, IN_CONTACT, lambda x, held: F.concat(_emails(x), _phones(x), _us_phones(x), _qq_numbers(x), keywords(x, held)), L.CONTACT_KEYWORDS)


def contact_weak(lines: Lines) -> Column:
    return _per_line(lines, IN_NUMBER, lambda x, held: F.concat(_weak_phones(x), keywords(x, held)), L.CONTACT_WEAK_KEYWORDS)


def prices(lines: Lines) -> Column:
    return _per_line(lines, IN_PRICE, lambda x, _: _where(IN_PRICE, x, _shown(F.filter(_matches(x, L.PRICE_PATTERNS, "(?iU)"), lambda m: ~part_number(m)))))


#: Promotional phrases with what may stand beside them.
GUARDED = tuple(f"(?<![a-z0-9]){p}(?![a-z0-9])" for p in L.PROMO_PHRASES)


def promo_phrases(lines: Lines) -> Column:
    return _per_line(lines, IN_PROMO, lambda x, _: _promo_phrases(x))


def promos(lines: Lines) -> Column:
    return _per_line(lines, IN_PROMO, lambda x, held: F.concat(_promo_phrases(x), keywords(x, held)), L.PROMO_KEYWORDS)


def promo_weak(lines: Lines) -> Column:
    ignored = "|".join(re.escape(p) for p in L.PROMO_IGNORE_PHRASES)
    return _per_line(lines, None, lambda x, held: F.when(F.regexp_like(x, F.lit(ignored)), F.expr(NO_STRINGS)).otherwise(keywords(x, held)), L.PROMO_WEAK_KEYWORDS)


def overlays(lines: Lines) -> Column:
    return _per_line(lines, IN_OVERLAY, lambda x, _: _where(IN_OVERLAY, x, _hits(x, L.OVERLAY_PATTERNS)))


def overlays_weak(lines: Lines) -> Column:
    return _per_line(lines, IN_OVERLAY_WEAK, lambda x, _: _where(IN_OVERLAY_WEAK, x, _hits(x, L.OVERLAY_WEAK_PATTERNS)))


def words_of(words: tuple[str, ...]):
    return lambda lines: _per_line(lines, None, keywords, words)


SIGNALS = {
    "urls": urls, "contacts": contacts, "contact_weak": contact_weak, "prices": prices, "promos": promos, "promo_weak": promo_weak,
    "ecommerce": words_of(L.PLATFORM_KEYWORDS), "watermarks": words_of(L.MARK_KEYWORDS), "watermark_weak": words_of(L.MARK_WEAK_KEYWORDS),
    "marketing_overlay": overlays, "marketing_weak": overlays_weak, "keep_terms": words_of(L.KEEP_LEXICON),
}


def analyzed(items: DataFrame, lines: str = "lines", prefix: str = "_a_") -> DataFrame:
    """items with a column for each of the thirteen lists, and the names of what was needed for them.

    Columns of their own, not one expression: Catalyst then keeps each step in a projection that runs once.
    """
    n, w, h = f"{prefix}normal", f"{prefix}whole", f"{prefix}heads"
    d = items.withColumn(n, normalized(F.col(lines))).withColumn(w, joined(F.col(n))).withColumn(h, heads(F.col(w)))
    text = Lines(F.col(n), F.col(w), F.col(h))
    return d.withColumns({f"{prefix}{k}": f(text) for k, f in SIGNALS.items()} | {f"{prefix}texts": texts(F.col(lines))}).drop(n, w, h)


ALL = (*SIGNALS, "texts")
