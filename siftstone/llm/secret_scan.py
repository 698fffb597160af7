"""Secret scanning: candidates by pattern, false positives removed by a random forest.

DataFrame and SQL functions only. A text is cut at the matches of a pattern, so that each candidate has
its place from the match itself and its neighbouring words from the pieces beside it; the work is linear in the
text and its candidates. The forest, trained from labelled findings, sees length, character transitions
(how usual each step from one character to the next is among dictionary words, and how often the kind
of character changes), dictionary coverage, the document's path and the neighbouring words. Its trees are
written as one SQL expression that runs inside the array of a document's candidates, so a scan moves no
text between tasks. The dictionary and its transitions are counted over all documents.
"""

from __future__ import annotations

import re

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftstone.llm.common import unused

#: A long run with a digit, with all its dotted parts, or the value of an assignment to a name that holds a telling word.
RUN = r"(?<![A-Za-z0-9+/_@-])(?=[A-Za-z+/_-]*+(?:\.[A-Za-z+/_-]++)*+\.?[0-9])[A-Za-z0-9+/_-]{16,}+(?:\.[A-Za-z0-9+/_-]++)*+={0,2}+(?![A-Za-z0-9+/_=@-])"
ASSIGNED = r"((?i)(?:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key)[\w-]*[\"']?\s{0,3}[:=]\s{0,3}[\"']?)([^\s\"',;]{8,})"
#: Noncharacters that mark where a candidate begins and ends; in a text they count as U+FFFD.
MARKS = "\ufdd0\ufdd1"
#: How each pattern's matches are marked.
KINDS = ((RUN, f"{MARKS[0]}$0{MARKS[1]}"), (ASSIGNED, f"$1{MARKS[0]}$2{MARKS[1]}"))
TELLING = "(?i)(pass|pwd|secret|token|key|auth|bearer|credential)"
HARMLESS = "(?i)(commit|sha|md5|hash|checksum|digest|uuid|guid|version|build|order|phone|page|item|path|file|url|http|image|id)"
PLACEHOLDER = r"(?i)(example|sample|dummy|your[_-]|placeholder|changeme|x{4,}|0{6,}|1234567)"
TRYOUT = "(?i)(test|example|sample|fixture|mock|doc)"
FEATURES = ("len", "digits", "uppers", "runs", "usual", "covered", "variety", "hexed", "telling", "harmless", "assigned", "placeholder", "prefixed", "tryout")
WORDS = 512  # of the dictionary: the most frequent ones of all documents
ITEMS = 8  # blank-separated items beside a candidate in which three neighbouring words are looked for
STRETCH = 256


def dictionary(docs: DataFrame, text: str = "text", size: int = WORDS) -> list[str]:
    """The `size` most frequent lower-case words of 4 to 10 letters in all documents, ties in order of the alphabet."""
    words = docs.select(F.explode(F.regexp_extract_all(F.lower(text), F.lit(r"\b[a-z]{4,10}\b"), F.lit(0))).alias("w"))
    top = words.groupBy("w").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "w").limit(size).collect()
    return [r["w"] for r in top]


def _transitions(words: list[str]) -> Column:
    """A map from each pair of letters that the words hold to its share among the pairs of its first letter."""
    pairs: dict[str, int] = {}
    first: dict[str, int] = {}
    for w in words:
        for a, b in zip(w, w[1:], strict=False):
            pairs[a + b] = pairs.get(a + b, 0) + 1
            first[a] = first.get(a, 0) + 1
    flat = [F.lit(x) for k in sorted(pairs) for x in (k, round(pairs[k] / first[k[0]], 6))]
    return F.create_map(*flat) if flat else F.expr("CAST(map() AS map<string,double>)")


def described(candidate: Column, before: Column, after: Column, path: Column, words: list[str]) -> Column:
    """Struct of the forest's features."""
    n = F.greatest(F.length(candidate), F.lit(1)).cast("double")
    low = F.lower(candidate)
    share = lambda pattern: (n - F.length(F.regexp_replace(candidate, pattern, ""))) / n
    usual = _transitions(words)
    steps = F.transform(F.sequence(F.lit(1), F.greatest(F.length(candidate) - 1, F.lit(1))), lambda i: F.coalesce(F.element_at(usual, F.substring(low, i, F.lit(2))), F.lit(0.0)))
    covered = F.aggregate(F.array(*[F.lit(w) for w in words]) if words else F.expr("CAST(array() AS array<string>)"), F.lit(0), lambda a, w: a + F.when(F.contains(low, w), F.length(w)).otherwise(0))
    near = F.concat(before, F.lit(" "), after)
    flag = lambda x, pattern: F.when(F.regexp_like(x, F.lit(pattern)), 1.0).otherwise(0.0)
    values = (
        n, share("[0-9]"), share("[A-Z]"),
        F.size(F.regexp_extract_all(candidate, F.lit("[a-z]+|[A-Z]+|[0-9]+|[^A-Za-z0-9]+"), F.lit(0))) / n,
        F.aggregate(steps, F.lit(0.0), lambda a, x: a + x) / n, F.least(covered / n, F.lit(1.0)),
        F.size(F.array_distinct(F.split(candidate, ""))) / n, flag(candidate, "^[0-9a-f]{32,}$"), flag(before, TELLING), flag(near, HARMLESS),
        flag(before, "[=:]\\s*[\"']?$"), flag(candidate, PLACEHOLDER), flag(candidate, "^[A-Za-z]{2,4}[A-Z_-]"), flag(path, TRYOUT),
    )
    return F.struct(*[v.cast("double").alias(k) for k, v in zip(FEATURES, values, strict=True)])


def labelled_findings(spark: SparkSession, n: int = 6000, seed: int = 3) -> DataFrame:
    """(candidate, before, after, path, label): findings of known kinds written by rule, labelled by kind.

    Real reviewed findings can take their place in `train`.
    """
    hexes, base62, upper32 = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    syllables = "ther ing tion and ent ver ment able con pro ist ous ter ation ure al est ma ri lo".split()

    def some(alphabet: str, length: str, salt: int) -> str:
        return f"array_join(transform(sequence(1, {length}), i -> substring('{alphabet}', cast(1 + pmod(xxhash64(id, i, {seed}, {salt}), {len(alphabet)}) as int), 1)), '')"

    def pick(options: list[str], salt: int) -> str:
        return "element_at(array(" + ",".join("'" + o.replace("'", "\\'") + "'" for o in options) + f"), cast(1 + pmod(xxhash64(id, {seed}, {salt}), {len(options)}) as int))"

    def number(low: int, high: int, salt: int) -> str:
        return f"cast({low} + pmod(xxhash64(id, {seed}, {salt}), {high - low + 1}) as int)"

    word = " || ".join(pick(syllables, 40 + k) for k in range(4))
    keep = ["token = \"", "api_key: ", "password=", "secret = '", "access_key = \"", "Authorization: Bearer ", "auth token "]
    plain = ["the ", "of and ", "in this ", "see ", "und der ", "que la ", "", "was. "]
    kinds = [
        (1, f"'AKIA' || {some(upper32, '16', 1)}", pick([*plain, *plain, "aws key ", "access_key="], 2)),
        (1, some(hexes, "40", 3), pick(keep, 4)),
        (1, some(base62, number(20, 48, 5), 6), pick(keep, 7)),
        (1, f"{pick(['ghp_', 'sk_live_', 'xoxb-', 'glpat-', 'npm_'], 8)} || {some(base62, number(24, 36, 9), 10)}", pick([*plain, *keep], 11)),
        (1, some(base62 + "+/", "40", 12), pick(keep, 13)),
        (0, some(hexes, "40", 14), pick(["commit ", "sha1 ", "git checkout ", "build hash: "], 15)),
        (0, some(hexes, "32", 16), pick(["md5: ", "checksum ", "digest=", "file "], 17)),
        (0, "concat_ws('-', " + ", ".join(some(hexes, k, 18 + i) for i, k in enumerate(("8", "4", "4", "4", "12"))) + ")", pick(["id ", "uuid: ", "request ", *plain], 24)),
        (0, f"{word} || {some('0123456789', number(1, 4, 25), 26)}", pick([*plain, "page ", "item "], 27)),
        (0, some("0123456789", number(16, 24, 28), 29), pick([*plain, "phone ", "order "], 30)),
        (0, some("0123456789", number(12, 24, 60), 61), pick(["token ", "key ", "the password ", "pass ", "token id ", "secret number ", *plain], 62)),
        (0, f"{pick(['your_api_key_here_', 'EXAMPLEKEY', 'xxxxxxxxxxxxxxxx', 'changeme_changeme_', 'sample-token-'], 31)} || {some('0123456789', '6', 32)}", pick([*keep, *plain], 33)),
        (0, f"{pick(syllables, 34)} || '/' || {word} || '/' || {pick(syllables, 35)} || {some('0123456789', '3', 36)}", pick(["path ", "see ", "url=", "in "], 37)),
    ]
    case = lambda k: "CASE " + " ".join(f"WHEN pmod(id, {len(kinds)}) = {i} THEN {x[k]}" for i, x in enumerate(kinds)) + " END"
    return spark.range(0, n, 1, 2).selectExpr(
        f"{case(1)} AS candidate", f"{pick(plain, 50)} || {case(2)} AS before", f"{pick(plain, 51)} AS after",
        f"{pick(['src', 'app/main', 'docs/example', 'tests/fixture', 'web'], 52)} AS path", f"CAST({case(0)} AS double) AS label",
    )


def train(findings: DataFrame, words: list[str], trees: int = 20, depth: int = 6, seed: int = 7):
    """The forest as a function from a feature struct to the share of trees that say "secret"."""
    rows = findings.select(described(F.col("candidate"), F.col("before"), F.col("after"), F.col("path"), words).alias("f"), "label").select("f.*", "label")
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows)
    model = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed).fit(vectors.select("features", "label"))
    parsed = [_tree(t.toDebugString.splitlines()[1:]) for t in model.trees]
    return lambda f: sum((_expression(t, f) for t in parsed), F.lit(0.0)) / F.lit(float(len(parsed)))


def _tree(lines: list[str]):
    """(feature, threshold, low, high) or a prediction, from a tree's listing."""
    at = iter([x.strip() for x in lines if x.strip()])

    def node():
        line = next(at)
        if m := re.match(r"Predict: ([-\d.Ee]+)", line):
            return float(m[1])
        m = re.match(r"If \(feature (\d+) <= ([-\d.Ee]+)\)", line)
        low = node()
        next(at)  # the Else line
        return int(m[1]), float(m[2]), low, node()

    return node()


def _expression(tree, f: Column) -> Column:
    if isinstance(tree, float):
        return F.lit(tree)
    feature, threshold, low, high = tree
    return F.when(f[FEATURES[feature]] <= threshold, _expression(low, f)).otherwise(_expression(high, f))


def _let(value: Column, f) -> Column:
    """f(value), with the value worked out once."""
    return F.element_at(F.transform(F.array(value), f), 1)


def _pieces(text: Column, pattern: str, marked: str) -> Column:
    """The text cut before and behind each match: plain, candidate, plain, and so on."""
    return F.split(F.regexp_replace(F.translate(text, MARKS, "\ufffd\ufffd"), pattern, marked), f"[{MARKS}]", -1)


def _starts(lengths: Column) -> Column:
    """Where each piece begins, from 1: sums over stretches of pieces and then within each, so that no long array is copied again and again."""

    def summed(start: Column, some: Column) -> Column:
        return F.slice(F.aggregate(some, F.array(start), lambda a, n: F.concat(a, F.array(F.element_at(a, -1) + n))), 1, F.size(some))

    stretches = _let(lengths, lambda all_: F.transform(F.sequence(F.lit(0), F.floor((F.size(all_) - 1) / STRETCH).cast("int")), lambda j: F.slice(all_, j * STRETCH + 1, F.lit(STRETCH))))
    offsets = lambda s: summed(F.lit(1), F.transform(s, lambda x: F.aggregate(x, F.lit(0), lambda a, n: a + n)))
    return _let(stretches, lambda s: F.flatten(F.zip_with(offsets(s), s, summed)))


def _candidates(pieces: Column) -> Column:
    """Array of (pos, candidate, before, after), in order of place; null if there is none."""
    blank = lambda x: F.translate(x, "\t\n\x0b\f\r", "     ")

    def parts(p: Column) -> Column:
        return F.struct(
            p.alias("all"), _starts(F.transform(p, lambda x: F.length(x))).alias("starts"),
            F.transform(p, lambda x: F.substring_index(blank(x), " ", -ITEMS)).alias("tails"), F.transform(p, lambda x: F.substring_index(blank(x), " ", ITEMS)).alias("heads"),
        )

    def one(s: Column, j: Column) -> Column:
        i = j * 2
        # Of the pieces beside it, as many as three words can need when candidates stand close together.
        before = F.concat(*[F.when(i > k, F.element_at(s["tails"], F.greatest(i - k, F.lit(1)))).otherwise("") for k in range(7, 0, -1)])
        after = F.concat(*[F.coalesce(F.try_element_at(s["heads"], i + k), F.lit("")) for k in range(1, 8)])
        left, right = F.split(F.substring_index(before, " ", -ITEMS), " +"), F.split(F.substring_index(after, " ", ITEMS), " +")
        return F.struct(
            F.element_at(s["starts"], i).alias("pos"), F.element_at(s["all"], i).alias("candidate"),
            _let(left, lambda w: F.array_join(F.slice(w, F.greatest(F.size(w) - 3, F.lit(1)), 4), " ")).alias("before"),  # three words, and what stands directly before
            F.array_join(F.slice(right, 1, 4), " ").alias("after"),
        )

    each = lambda p: _let(parts(p), lambda s: F.transform(F.sequence(F.lit(1), F.floor(F.size(s["all"]) / 2).cast("int")), lambda j: one(s, j)))
    return _let(pieces, lambda p: F.when(F.size(p) > 1, each(p)))


def _place(docs: DataFrame, path: str) -> Column:
    return F.coalesce(F.col(path), F.lit("")) if path in docs.columns else F.lit("")


def found(docs: DataFrame, forest, words: list[str], name: str, text: str = "text", path: str = "source") -> DataFrame:
    """docs with a column `name`: array of (pos from 1, candidate, score), in order of place; a match of both patterns stands once."""
    (f,) = unused([*docs.columns, name], "_f")
    where = _place(docs, path)
    none = F.expr("CAST(array() AS array<struct<pos:int,candidate:string,before:string,after:string>>)")
    both = F.concat(*[F.coalesce(_candidates(_pieces(F.coalesce(F.col(text), F.lit("")), *kind)), none) for kind in KINDS])

    def once(all_: Column) -> Column:
        """Equal ones stand side by side."""
        last = lambda i: F.element_at(all_, F.greatest(i, F.lit(1)))
        return F.filter(all_, lambda x, i: (i == 0) | (last(i)["pos"] != x["pos"]) | (last(i)["candidate"] != x["candidate"]))

    single = _let(F.array_sort(both), once)
    featured = docs.withColumn(f, F.transform(single, lambda x: F.struct(x["pos"].alias("pos"), x["candidate"].alias("candidate"), described(x["candidate"], x["before"], x["after"], where, words).alias("f"))))
    scores = F.transform(f, lambda x: F.struct(x["pos"].alias("pos"), x["candidate"].alias("candidate"), forest(x["f"]).alias("score")))
    return featured.withColumn(name, scores).select(*docs.columns, name)


def prepared(docs: DataFrame, text: str = "text", findings: DataFrame | None = None):
    """(forest, dictionary) for a table of documents."""
    words = dictionary(docs, text)
    return train(labelled_findings(docs.sparkSession) if findings is None else findings, words), words


def scan(docs: DataFrame, findings: DataFrame | None = None, threshold: float = 0.5, doc_id: str = "doc_id", text: str = "text", path: str = "source") -> DataFrame:
    """(doc_id, pos, length, candidate, score, is_secret) of every candidate; pos counts code points from 1.

    A null or empty text has none; repeated rows give repeated findings; an empty table gives an empty
    result. A missing path column, or a null path, counts as an empty path. Extra columns are left aside.
    """
    forest, words = prepared(docs, text, findings)
    (name,) = unused(docs.columns, "_found")
    got = found(docs, forest, words, name, text, path).select(F.col(doc_id).alias("doc_id"), F.explode(name).alias("x"))
    return got.select("doc_id", F.col("x.pos").alias("pos"), F.length("x.candidate").alias("length"), F.col("x.candidate").alias("candidate"), F.col("x.score").alias("score"), (F.col("x.score") >= threshold).alias("is_secret"))


def redact(docs: DataFrame, mark: str = "[SECRET]", findings: DataFrame | None = None, threshold: float = 0.5, text: str = "text", path: str = "source") -> DataFrame:
    """The documents, all columns kept, with every secret in the text replaced by the mark; other texts are unchanged.

    Only the places where a candidate was found are replaced: first values of assignments, then, in what that
    leaves, long runs. The same characters elsewhere, as in another word, stay. A null or empty text stays as it
    is, texts of any length are read whole, repeated rows are treated alike; an empty table gives an empty result.
    """
    forest, words = prepared(docs, text, findings)
    c, f = unused(docs.columns, "_pieces", "_places")
    out, where = docs, _place(docs, path)
    for kind in reversed(KINDS):
        cut = out.withColumn(c, _pieces(F.col(text), *kind)).withColumn(f, _candidates(F.col(c)))
        secret = cut.withColumn(f, F.transform(f, lambda x: _let(described(x["candidate"], x["before"], x["after"], where, words), lambda v: forest(v) >= threshold)))
        joined = F.array_join(F.transform(c, lambda x, i: F.when((i % 2 == 1) & F.try_element_at(F.col(f), F.greatest(F.floor((i + 1) / 2), F.lit(1)).cast("int")), F.lit(mark)).otherwise(x)), "")
        out = secret.withColumn(text, F.when(F.exists(f, lambda x: x), joined).otherwise(F.col(text))).select(*docs.columns)
    return out
