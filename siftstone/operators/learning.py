"""The learning loop: what people moved and the engine did not goes to the library, and only what that reaches is judged again."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftstone.operators.rows import unseen
from siftstone.operators.sampling import sample
from siftstone.operators.similarity import match_library
from siftstone.sources.scratch import once


def learn(items: DataFrame, human: DataFrame, library: DataFrame, per_pass: int | None = None, key: str = "filename", hash_: str = "phash", said: str = "said", most: int = 1) -> tuple[DataFrame, DataFrame, int]:
    """(items with learned_in, the library with what was added, number of passes) once a pass adds nothing.

    items: (key, decision, hash, said, ...); a missed item is one that people moved (its key is in human) and the
    decision isn't MOVE. Those whose text says something (`said`) give their hash to the library, in each pass
    all of them or `per_pass` of least hash order, so that one hash may serve others near it. Items
    within `most` bits of a new hash become MOVE, with learned_in the pass; no other item is judged again, since
    nothing else about it has changed. Items without a hash are never reached; keys are one a row.
    """
    names = human.select(key).distinct()
    moved = items.filter("decision = 'MOVE'").withColumn("learned_in", F.lit(None).cast("int"))
    left = once(unseen(items, moved, key))
    known, done, n = once(library.select("hash").filter("hash IS NOT NULL").distinct()), [moved], 0
    while True:
        missed = left.join(names, key, "left_semi").filter(F.col(said) & F.col(hash_).isNotNull())
        new = unseen(missed.select(F.col(hash_).alias("hash")).distinct(), known, "hash")
        new = once(new if per_pass is None else sample(new, per_pass, "hash"))
        if new.isEmpty():
            break
        n += 1
        known = once(known.unionByName(new))
        reached = once(match_library(left, new, key, hash_, most).select(key))
        done.append(left.join(reached, key, "left_semi").withColumns({"decision": F.lit("MOVE"), "learned_in": F.lit(n)}))
        left = once(unseen(left, reached, key))
    out = left.withColumn("learned_in", F.lit(None).cast("int"))
    for d in done:
        out = out.unionByName(d)
    return out, known, n
