"""Probable renames: unknown paths against the dictionary's paths, by five rules in a cascade.

Rules compare distinct leaf names through equi-joins (leaf, plain words, last characters, rare pairs of
characters) and automata of names. Ties go to the smallest path.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filing_jobs.functions.scalars import bigrams, leaf_of, parent_of, part_score, plain_words, schedule_of
from filing_jobs.sources.io import Dict
from filing_jobs.store import stored

RULES = ("leaf", "words", "part", "similar", "parent")
#: Fixed values. A rule counts below this score of the rules before it.
GATES = (2.0, 0.8, 0.7, 0.6, 0.5)
#: Names that a cell of the containment grid runs through its automaton, and names of that automaton.
TEXTS, PARTS = 100_000, 50_000


def dictionary_leaves(d: Dict) -> DataFrame:
    """(leaf, schedule, candidate): of each leaf and schedule the smallest path."""
    x = F.col("xpath")
    return d.xpath_index.select(leaf_of(x).alias("leaf"), schedule_of(x).alias("c_schedule"), x).groupBy("leaf", "c_schedule").agg(F.min("xpath").alias("candidate"))


def best(rows: DataFrame, name: str) -> DataFrame:
    """(xpath, name: struct(score, match, reason)): the highest score, then the smallest path."""
    top = F.min_by(F.struct("score", F.col("candidate").alias("match"), "reason"), F.struct(-F.col("score"), "candidate"))
    return rows.groupBy("xpath").agg(top.alias(name))


def by_leaf(unknown: DataFrame, leaves: DataFrame) -> DataFrame:
    """FUZ-1. The same leaf: 0.9 in the same schedule, else 0.7."""
    rows = unknown.join(leaves, F.col("element_name") == F.col("leaf"))
    same = F.col("schedule") == F.col("c_schedule")
    rows = rows.withColumn("score", F.when(same, 0.9).otherwise(0.7)).withColumn("reason", F.when(same, "exact leaf name, same schedule, different path").otherwise("exact leaf name in different schedule"))
    return best(rows, "leaf")


def by_words(unknown: DataFrame, leaves: DataFrame) -> DataFrame:
    """FUZ-2. The same words written out: 0.85 or 0.65 by the schedule of the leaf's smallest path."""
    firsts = leaves.groupBy("leaf").agg(F.min_by(F.struct("candidate", "c_schedule"), "candidate").alias("f")).select(plain_words(F.col("leaf")).alias("words"), "f.*")
    rows = unknown.withColumn("own_words", plain_words(F.col("element_name"))).join(firsts, F.col("own_words") == F.col("words"))
    same = F.col("schedule") == F.col("c_schedule")
    rows = rows.withColumn("score", F.when(same, 0.85).otherwise(0.65)).withColumn("reason", F.when(same, "abbreviation match, same schedule").otherwise("abbreviation match, different schedule"))
    return best(rows, "words")


def holding(left: DataFrame, right: DataFrame) -> DataFrame:
    """(l, r): names of ``left`` and ``right`` (column name, in lower case, distinct) of which one holds the other.

    Two grids of blocks of at most about TEXTS and PARTS names, one for each direction: each cell builds an automaton of
    its parts and runs its texts through it, so what a task holds is bounded, and a piece that many names share is no join key.
    """
    names = stored(left.select(F.lit(0).alias("side"), "name").unionByName(right.select(F.lit(1).alias("side"), "name")), "names")
    sizes = {r["side"]: r["n"] for r in names.groupBy("side").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return left.sparkSession.createDataFrame([], "l string, r string")
    blocks = lambda side, most: -(-sizes[side] // most)
    block = lambda n: F.pmod(F.xxhash64("name"), F.lit(n)).cast("int")
    cells, first = None, {}
    for side, start in ((0, 0), (1, blocks(0, TEXTS) * blocks(1, PARTS))):
        down, across = blocks(side, TEXTS), blocks(1 - side, PARTS)
        texts = names.where(F.col("side") == side).select("name", F.lit(True).alias("is_text"), block(down).alias("d"), F.explode(F.sequence(F.lit(0), F.lit(across - 1))).alias("a"))
        parts = names.where(F.col("side") != side).select("name", F.lit(False).alias("is_text"), F.explode(F.sequence(F.lit(0), F.lit(down - 1))).alias("d"), block(across).alias("a"))
        own = texts.unionByName(parts).select((F.lit(start) + F.col("d") * across + F.col("a")).alias("cell"), "is_text", "name")
        cells, first[side] = own if cells is None else cells.unionByName(own), start
        total = start + down * across
    turned = first[1]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ahocorasick

        cell, automaton = None, None
        for batch in batches:
            found: list[tuple[str, str]] = []
            for at, is_text, name in zip(batch["cell"].to_pylist(), batch["is_text"].to_pylist(), batch["name"].to_pylist(), strict=True):
                if at != cell:
                    cell, automaton = at, ahocorasick.Automaton()
                if not is_text:  # parts come first
                    automaton.add_word(name, name)
                elif len(automaton):
                    if automaton.kind != ahocorasick.AHOCORASICK:
                        automaton.make_automaton()
                    found += ((part, name) if at >= turned else (name, part) for part in {part for _, part in automaton.iter(name)})
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.string()), pa.array([y for _, y in found], pa.string())], ["l", "r"])

    dealt = cells.repartitionById(total, F.col("cell")).sortWithinPartitions("cell", "is_text")
    return dealt.mapInArrow(run, "l string, r string").distinct()


def by_part(unknown: DataFrame, leaves: DataFrame) -> DataFrame:
    """FUZ-3. One name holds the other, or the last eight characters are equal."""
    low = lambda c: F.lower(F.col(c))
    left, right = unknown.select("element_name").distinct(), leaves.select("leaf").distinct()
    names = [rows.select(low(c).alias("name")).where(F.length("name") > 5).distinct() for rows, c in ((left, "element_name"), (right, "leaf"))]
    held = holding(*names)
    ends = left.join(right, F.right(low("element_name"), F.lit(8)) == F.right(low("leaf"), F.lit(8)))
    pairs = ends.unionByName(left.withColumn("l", low("element_name")).join(held, "l").join(right.withColumn("r", low("leaf")), "r").select("element_name", "leaf")).distinct()
    firsts = leaves.groupBy("leaf").agg(F.min("candidate").alias("candidate"), F.collect_set("c_schedule").alias("schedules"))
    rows = unknown.join(pairs, "element_name").join(firsts, "leaf").withColumn("score", part_score(F.col("element_name"), F.col("leaf"), F.array_contains("schedules", F.col("schedule"))))
    x, y = low("element_name"), low("leaf")
    holds = (F.length(x) > 5) & (F.length(y) > 5)
    reason = F.when(holds & y.contains(x), F.format_string("'%s' is substring of '%s'", "element_name", "leaf")).when(holds & x.contains(y), F.format_string("'%s' is substring of '%s'", "leaf", "element_name")).otherwise(F.format_string("shared suffix '%s'", F.right(F.col("element_name"), F.lit(8))))
    return best(rows.where("score > 0").withColumn("reason", reason), "part")


def tokens(names: DataFrame) -> DataFrame:
    """(name, tokens): the pairs of characters of each distinct name, the rarest among all names first."""
    pairs = names.select("name").distinct().withColumn("pair", F.explode(bigrams(F.col("name"))))
    order = pairs.groupBy("pair").agg(F.concat(F.lpad(F.count("*").cast("string"), 12, "0"), F.first("pair")).alias("token"))
    return pairs.join(order, "pair").groupBy("name").agg(F.array_sort(F.collect_list("token")).alias("tokens"))


def alike(left: DataFrame, right: DataFrame, keys: list[str], least: tuple[int, int], known: DataFrame) -> DataFrame:
    """(keys, left, right, both, n, m): names of ``left`` and ``right`` (columns keys and name) with a Dice similarity of ``least`` or more.

    ``known``: the ``tokens`` of all names, in any one order of rarity.

    A similarity of a / b takes a * (n + m) / (2 * b) shared pairs, and neither name has more than (2 * b - a) / a times the
    other's. So a name and one that is no smaller share a pair among the first n - a * n / b + 1 rarest pairs of the
    smaller one and the first m - a * m / (2 * b - a) + 1 of the other: only those are join keys. Each two names meet at
    the rarest pair that both have.
    """
    a, b = least

    def prefixes(rows: DataFrame, name: str, size: str) -> DataFrame:
        n = F.size("tokens")
        longest = n - F.ceil(n * a / (2 * b - a)) + 1
        out = rows.join(known, "name").withColumn(size, n).withColumn("head", F.slice("tokens", 1, longest.cast("int")))
        return out.select(*keys, F.col("name").alias(name), size, F.col("tokens").alias(f"{name}_tokens"), F.posexplode("head").alias(f"{name}_at", "token"))

    met = prefixes(left, "left", "n").join(prefixes(right, "right", "m"), [*keys, "token"])
    short = lambda size: F.col(size) - F.ceil(F.col(size) * a / b)
    close = (F.col("n") * (2 * b - a) >= F.col("m") * a) & (F.col("m") * (2 * b - a) >= F.col("n") * a)
    near = F.when(F.col("n") <= F.col("m"), F.col("left_at") <= short("n")).otherwise(F.col("right_at") <= short("m"))
    room = (F.lit(1) + F.least(F.col("n") - F.col("left_at"), F.col("m") - F.col("right_at")) - 1) * 2 * b >= (F.col("n") + F.col("m")) * a
    common = F.array_intersect("left_tokens", "right_tokens")
    found = met.where(close & near & room).withColumn("common", common)
    found = found.where((F.size("common") * 2 * b >= (F.col("n") + F.col("m")) * a) & (F.array_min("common") == F.col("token")))
    return found.select(*keys, "left", "right", F.size("common").alias("both"), "n", "m")


def by_similarity(unknown: DataFrame, leaves: DataFrame, known: DataFrame) -> DataFrame:
    """FUZ-4. Pairs of characters alike by 0.6 or more, within the same schedule."""
    mine = unknown.select("schedule", F.col("element_name").alias("name")).distinct()
    theirs = leaves.select(F.col("c_schedule").alias("schedule"), F.col("leaf").alias("name"), "candidate")
    found = alike(mine, theirs.select("schedule", "name").distinct(), ["schedule"], (3, 5), known).withColumn("score", 2.0 * F.col("both") / (F.col("n") + F.col("m")))
    scored = found.join(theirs.withColumnRenamed("name", "right"), ["schedule", "right"]).select("schedule", F.col("left").alias("element_name"), "candidate", "score")
    return best(unknown.join(scored, ["schedule", "element_name"]).withColumn("reason", F.lit("name similarity")), "similar")


def by_parent(unknown: DataFrame, d: Dict, unused: DataFrame, known: DataFrame) -> DataFrame:
    """FUZ-5. The parent is in the dictionary and has unused fields: the most similar one, else the one with the smallest path.

    Below a similarity of 0.3 all are alike, so only similar names meet; the rest takes one path of each parent.
    """
    parents = unknown.join(d.xpath_index.select(F.col("xpath").alias("parent_xpath")).distinct(), "parent_xpath", "left_semi")
    free = d.field_xpaths.join(unused, "canonical_name", "left_semi").select(F.col("xpath").alias("candidate")).distinct()
    free = free.select("candidate", parent_of(F.col("candidate")).alias("parent_xpath"), leaf_of(F.col("candidate")).alias("name"))
    names = parents.select("parent_xpath", F.col("element_name").alias("name")).distinct()
    found = alike(names, free.select("parent_xpath", "name").distinct(), ["parent_xpath"], (3, 10), known).withColumn("dice", 2.0 * F.col("both") / (F.col("n") + F.col("m")))
    near = found.where("dice > 0.3").join(free.withColumnRenamed("name", "right"), ["parent_xpath", "right"])
    near = near.select("parent_xpath", F.col("left").alias("element_name"), "candidate", F.greatest(F.lit(0.5), "dice").alias("score"))
    first = free.groupBy("parent_xpath").agg(F.min("candidate").alias("candidate")).withColumn("score", F.lit(0.45))
    columns = ["xpath", "candidate", "score"]
    rows = parents.join(near, ["parent_xpath", "element_name"]).select(columns).unionByName(parents.join(first, "parent_xpath").select(columns))
    return best(rows.withColumn("reason", F.lit("same parent, unused field")), "parent")


def cascade(now: Column, names: tuple[str, ...]) -> Column:
    """FUZ-6. A later rule counts only below its gate, and only with a higher score."""
    for name in names:
        own = F.col(name)
        now = F.when((now["score"] < GATES[RULES.index(name)]) & own.isNotNull() & (own["score"] > now["score"]), own).otherwise(now)
    return now


def match_unknowns(unknown: DataFrame, d: Dict, unused: DataFrame) -> DataFrame:
    """FUZ-1 to 7. (xpath, match, score, reason) of the unknown paths that have a probable match (0.45 or more), best first."""
    leaves = stored(dictionary_leaves(d), "leaves")
    names = unknown.select("element_name").union(leaves.select("leaf")).union(d.field_xpaths.select(leaf_of(F.col("xpath"))))
    known = stored(tokens(names.toDF("name")), "name-tokens")
    nothing = F.struct(F.lit(0.0).alias("score"), F.lit("").alias("match"), F.lit("").alias("reason"))
    rows = unknown.select("xpath", "element_name", "schedule", "parent_xpath").withColumn("b", nothing)
    steps = [("leaf", "words"), ("part",), ("similar",), ("parent",)]
    for names in steps:  # the dearer rules see only what is still below their gate
        below = rows.where(F.col("b.score") < max(GATES[RULES.index(n)] for n in names)).drop("b")
        rules = {"leaf": lambda x: by_leaf(x, leaves), "words": lambda x: by_words(x, leaves), "part": lambda x: by_part(x, leaves), "similar": lambda x: by_similarity(x, leaves, known), "parent": lambda x: by_parent(x, d, unused, known)}
        joined = rows
        for name in names:
            joined = joined.join(rules[name](below), "xpath", "left")
        rows = stored(joined.withColumn("b", cascade(F.col("b"), names)).drop(*names), "matches")
    found = rows.where("b.score >= 0.45")
    return found.select("xpath", "b.match", F.round("b.score", 3).alias("score"), "b.reason").orderBy(F.desc("score"), "xpath")
