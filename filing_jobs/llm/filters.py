"""Audit of five quality filters: what each removes, alone and after others, in every order.

A document's failed conditions are five bits, so everything that orders and coalitions of filters do follows from
one small table: documents of each part by those bits. From it come the removals of all 32 coalitions; differences of
coalitions are the counts of a step, and the Shapley values solve the least squares of the coalitions' removals,
weighted by the Shapley kernel and constrained to add up to the whole, in rationals.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from fractions import Fraction
from itertools import permutations
from math import comb, factorial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filing_jobs.llm.common import picked, stored

#: The filters by letter; the k-th one is bit k of a mask.
FILTERS = "ABCDE"
WHOLE = (1 << len(FILTERS)) - 1
REPEATED = 1 << FILTERS.index("E")
CAPITALS, MARKS, INNER = bytes(range(65, 91)), b"#$%&*|", bytes(range(0x80, 0xC0))
FAILED = "id long, part string, mask int, d1 long, d2 long"


def mask_of(text: bytes) -> int:
    """Bits of the conditions A to D that a text fails. ``bytes.split`` splits at exactly \\x20 and \\x09-\\x0D."""
    words = text.split()
    n = len(words)
    points = len(text) if text.isascii() else len(text.translate(None, INNER))
    few, same = n < 100, 100 * len(set(words)) < 80 * n
    loud = 100 * (len(text) - len(text.translate(None, CAPITALS))) > 10 * points
    marked = len(text.translate(None, MARKS)) < len(text)
    return few | same << 1 | loud << 2 | marked << 3


def failures(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """(id, part, mask, d1, d2) of every row: failed conditions A to D, and 128 bits of the text's SHA-256 to know equal texts by.

    Null text counts as empty, a null part as the empty string.
    """
    names = [x.split()[0] for x in FAILED.split(", ")]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            masks, digests = [], []
            for value in batch["text"]:
                text = value.as_py()
                masks.append(mask_of(text))
                digests.append(hashlib.sha256(text).digest()[:16])
            halves = [[int.from_bytes(d[k : k + 8], "little", signed=True) for d in digests] for k in (0, 8)]
            yield pa.RecordBatch.from_arrays([batch["id"], batch["part"], pa.array(masks, pa.int32()), *(pa.array(h, pa.int64()) for h in halves)], names)

    rows = picked(docs, id=id_col, text=text_col, part=part_col)
    return rows.select(F.col("id").cast("long").alias("id"), F.coalesce("part", F.lit("")).alias("part"), F.coalesce("text", F.lit("")).cast("binary").alias("text")).mapInArrow(run, FAILED)


def masks(failed: DataFrame, labels: DataFrame, *, id_col: str = "doc_id") -> DataFrame:
    """(part, mask, n, good, toxic): documents of each part by all five conditions, and how many of them are labelled so.

    E fails where a smaller id has the same text anywhere in the table. A row without id fails no E and makes none
    fail; rows of one id don't make each other fail. Rows are counted by (text, part, labels) before texts meet, so a
    text that a third of all rows repeat is a few rows; of each group only the rows with its smallest id may pass.
    An id with several labels is good or toxic if one of them says so.
    """
    each = failed.groupBy("id", "part", "mask", "d1", "d2").agg(F.count("*").alias("n"))
    marks = picked(labels, id=id_col, quality="quality", toxic="toxic").groupBy("id").agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("bad"))
    each = each.join(marks, "id", "left").withColumns({c: F.coalesce(c, F.lit(False)) for c in ("good", "bad")})
    named = F.sum(F.when(F.col("id").isNotNull(), F.col("n")).otherwise(0))
    kinds = each.groupBy("d1", "d2", "part", "mask", "good", "bad").agg(F.sum("n").alias("n"), named.alias("named"), F.min("id").alias("first"), F.min_by("n", "id").alias("at_first"))
    kinds = stored(kinds, "texts-by-part")
    least = kinds.groupBy("d1", "d2").agg(F.min("first").alias("least"))
    repeats = F.col("named") - F.when(F.col("first") == F.col("least"), F.col("at_first")).otherwise(0)
    both = F.array(F.struct(F.col("mask"), (F.col("n") - repeats).alias("n")), F.struct(F.col("mask").bitwiseOR(F.lit(REPEATED)).alias("mask"), repeats.alias("n")))
    rows = kinds.join(least, ["d1", "d2"]).select("part", "good", "bad", F.inline(both)).where("n > 0")
    count = lambda c: F.sum(F.when(F.col(c), F.col("n")).otherwise(0)).alias(c)
    return rows.groupBy("part", "mask").agg(F.sum("n").alias("n"), count("good"), count("bad")).withColumnRenamed("bad", "toxic")


def coalitions(counted: DataFrame) -> DataFrame:
    """(part, coalition, removed, good, toxic): what each of the 32 sets of filters removes; 32 rows of each part."""
    rows = counted.withColumn("coalition", F.explode(F.sequence(F.lit(0), F.lit(WHOLE))))
    hit = F.col("mask").bitwiseAND(F.col("coalition")) != 0
    total = lambda c, name: F.sum(F.when(hit, F.col(c)).otherwise(0)).alias(name)
    return rows.groupBy("part", "coalition").agg(total("n", "removed"), total("good", "good"), total("toxic", "toxic"), F.sum("n").alias("documents"))


def solved(matrix: list[list[Fraction]], right: list[list[Fraction]]) -> list[list[Fraction]]:
    """The solutions of matrix * x = each column of ``right``, by elimination in rationals."""
    n = len(matrix)
    rows = [[*a, *b] for a, b in zip(matrix, right, strict=True)]
    for k in range(n):
        at = next(i for i in range(k, n) if rows[i][k])
        rows[k], rows[at] = rows[at], rows[k]
        rows[k] = [x / rows[k][k] for x in rows[k]]
        for i in range(n):
            if i != k and rows[i][k]:
                rows[i] = [x - rows[i][k] * y for x, y in zip(rows[i], rows[k], strict=True)]
    return [r[n:] for r in rows]


def shapley_weights(n: int) -> list[list[int]]:
    """weights[f][S]: n! times the Shapley value of player f is the sum of weights[f][S] * v(S) over coalitions S.

    The values minimise sum over S of k(S) * (v(S) - sum of its players' values)^2, where they add up to v of
    all; k(S) = (n-1) / (C(n,s) * s * (n-s)). Its normal equations with a multiplier for the constraint are solved
    once, with each coalition's removals as an unknown on the right, so they hold for all parts.
    """
    whole = (1 << n) - 1
    inside = lambda s: [s >> f & 1 for f in range(n)]
    kernel = {s: Fraction(n - 1, comb(n, s.bit_count()) * s.bit_count() * (n - s.bit_count())) for s in range(1, whole)}
    matrix = [[Fraction(0)] * (n + 1) for _ in range(n + 1)]
    right = [[Fraction(0)] * (whole + 1) for _ in range(n + 1)]
    for s, k in kernel.items():
        z = inside(s)
        for f in range(n):
            right[f][s] = k * z[f]
            for g in range(n):
                matrix[f][g] += k * z[f] * z[g]
    for f in range(n):
        matrix[f][n] = matrix[n][f] = Fraction(1)
    right[n][whole] = Fraction(1)
    values = solved(matrix, right)[:n]
    scaled = [[x * factorial(n) for x in row] for row in values]
    if any(x.denominator != 1 for row in scaled for x in row):
        raise ArithmeticError("the sum over all orders is a whole number")
    return [[int(x) for x in row] for row in scaled]


def audit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """One row per part, order of the filters and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    Null text counts as empty, a null part as the empty string, repeated rows each count; documents without labels are
    neither good nor toxic; an empty table has no parts and no rows. The work after the table of masks is 600 rows of
    each part, whatever the documents.
    """
    counted = masks(failures(docs, id_col=id_col, text_col=text_col, part_col=part_col), labels, id_col=id_col)
    table = coalitions(counted).groupBy("part").agg(F.array_sort(F.collect_list(F.struct("coalition", "removed", "good", "toxic"))).alias("v"), F.max("documents").alias("documents"))
    n, whole = len(FILTERS), F.lit(WHOLE)
    shares = [sum((F.lit(w) * F.get("v", F.lit(s))["removed"] for s, w in enumerate(weights) if w), F.lit(0)) for weights in shapley_weights(n)]
    orders = F.lit(["".join(p) for p in permutations(FILTERS)])
    rows = table.withColumn("shares", F.array(*shares)).withColumn("filter_order", F.explode(orders)).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(n))))
    place = lambda k: F.ascii(F.substring("filter_order", k, F.lit(1))) - F.ascii(F.lit(FILTERS[0]))
    bit = lambda k: F.expr(f"shiftleft(1, ascii(substring(filter_order, {k}, 1)) - ascii('{FILTERS[0]}'))")
    before = sum((F.when(F.col("step") > k, bit(k)).otherwise(0) for k in range(1, n)), F.lit(0))
    rows = rows.withColumns({"before": before.cast("int"), "own": bit("step"), "place": place(F.col("step"))})
    value = lambda coalition, what: F.get("v", coalition)[what]
    after = F.col("before").bitwiseOR(F.col("own"))
    gained = lambda what: value(after, what) - value(F.col("before"), what)
    return rows.select(
        "part", "filter_order", F.col("step").cast("int").alias("step"), (F.col("documents") - value(after, "removed")).alias("kept"), gained("removed").alias("removed"), (value(F.col("own"), "removed") - gained("removed")).alias("redundant"),
        (value(whole, "removed") - value(whole.bitwiseXOR(F.col("own")), "removed")).alias("unique_fails"), gained("good").alias("good_lost"), gained("toxic").alias("toxic_lost"), F.get("shares", F.col("place")).cast("long").alias("shapley"),
    )
