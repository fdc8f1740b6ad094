"""Exact Jaccard join of word-shingle sets: size-banded tiles, bitmap signatures, sorted arrays.

Equal sets form a class with one node. A node enters the tiles of its rarest shingles: as many that
two sets which link share one of them (prefix filter). Frequent shingles come last in that order;
which are frequent is a matter of speed only, any order gives the same links.

1. In each tile, neighbours in order of size are candidate pairs; those that link give components.
2. In tiles that still hold several components, cut into size bands and blocks, all pairs of
   different components are candidates.

Each candidate pair passes two tests: the bit counts of the signatures bound the overlap from above,
and the intersection of the sorted arrays gives it exactly. In the second step tiles with the same
smallest node, their home, lie together with one copy of their nodes' bitmaps, so that only pairs that
the bit counts allow leave a tile. A home with very many rows is cut by its nodes: each pair of parts is
a task of its own, so that every pair of nodes still meets in one place only.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from filing_jobs.llm.common import bounding_count, picked, stored
from filing_jobs.llm.components import components

WORDS = 5
#: Link when PERCENT * union <= 100 * intersection.
PERCENT = 75
#: So many of the most frequent shingles are known as such; none that fewer sets than this hold.
FREQUENT, RARE = 1 << 20, 8
#: Shingles counted at a time for that, and the least number among them that is reported.
FLUSH, LOCAL = 1 << 22, 2
#: Rows of a tile's block.
BLOCK = 2048
#: Rows of a home that lie in one task; so many homes at most are split (others hold fewer rows than one of SPLIT parts of all).
HOME, SPLIT = 1 << 14, 1 << 16
#: Names that a task remembers at most; they only save work.
REMEMBER = 1_000_000
#: Bits of the filter that thins out the texts to be read again (8 MB whatever the input).
FILTER_BITS = 1 << 26
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """An even spread of 64-bit values (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, n: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the n-word shingles; ASCII lower case, split at ASCII white space.

    Fewer words than n count as one shingle; no words give an empty set.
    """
    words = text.encode().lower().split() if text else []
    if not words:
        return np.zeros(0, "u8")
    h = np.array(list(map(xxhash.xxh3_64_intdigest, words)), "u8")
    width = min(n, len(h))
    value = h[: len(h) - width + 1].copy()
    for k in range(1, width):
        value = value * MULTIPLIER + h[k : len(h) - width + 1 + k]
    return np.unique(mixed(value + np.uint64(width)))


def node_of(own: np.ndarray) -> int:
    """A signed 64-bit name of the set."""
    total = mixed(own ^ MULTIPLIER).sum(dtype="u8") + np.uint64(len(own))
    return int(mixed(np.array([total], "u8")).view("i8")[0])


def bitmap_of(own: np.ndarray) -> bytes:
    """Parity bits of the hashes, four to eight for each; a signature folds to a shorter one by exclusive or.

    With so few collisions the bound rejects nearly all pairs that are not close to the threshold.
    """
    bits = 1 << max(6, (4 * len(own) - 1).bit_length())
    odd = np.bincount((own & np.uint64(bits - 1)).astype("i8"), minlength=bits) & 1
    return np.packbits(odd.astype("u1"), bitorder="little").tobytes()


def differing_bits(a: bytes, b: bytes) -> int:
    """A lower bound of the symmetric difference."""
    x, y = np.frombuffer(a, "u8"), np.frombuffer(b, "u8")
    while len(x) > len(y):
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    while len(y) > len(x):
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


def may_link(total, differing, percent: int = PERCENT):
    """Whether overlap <= (|x| + |y| - differing) / 2 still allows a link."""
    return (100 + percent) * (total - differing) >= 2 * percent * total


def prefix_length(n: int, percent: int = PERCENT) -> int:
    """Two linked sets share one of so many first elements, in whatever common order."""
    return n - -(-percent * n // 100) + 1


def batches_of(df: DataFrame, function: Callable, schema: str) -> DataFrame:
    """mapInArrow with ``function(id array, set)`` results; texts become shingle sets one by one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            yield from function((batch["id"], (shingles(t) for t in batch["t"].to_pylist())) for batch in batches)

    return df.mapInArrow(run, schema)


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view("i8"), pa.int64())


def read_texts(rows: DataFrame) -> DataFrame:
    """(id, n, node, bitmap, token, c): a row for every document, and others for shingles that many sets of a task hold.

    Documents have no token; node and bitmap are null for empty sets. The others have only the shingle
    and how many sets hold it; equal sets of a task count once.
    """
    names = ["id", "n", "node", "bitmap", "token", "c"]

    def run(batches):
        held, size = [], 0
        seen: set[int] = set()

        def out(kind: pa.DataType) -> pa.RecordBatch:
            values, counts = np.unique(np.concatenate(held), return_counts=True)
            chosen = counts >= LOCAL
            k = int(chosen.sum())
            return pa.RecordBatch.from_arrays([pa.nulls(k, kind), pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()), pa.nulls(k, pa.binary()), signed(values[chosen]), pa.array(counts[chosen], pa.int64())], names)

        for ids, sets in batches:
            n, nodes, bits = [], [], []
            for own in sets:
                node = node_of(own) if len(own) else None
                n.append(len(own))
                nodes.append(node)
                bits.append(bitmap_of(own) if len(own) else None)
                if node is not None and node not in seen:
                    if len(seen) > REMEMBER:
                        seen.clear()
                    seen.add(node)
                    held.append(own)
                    size += len(own)
                    if size >= FLUSH:
                        yield out(ids.type)
                        held, size = [], 0
            k = len(n)
            yield pa.RecordBatch.from_arrays([ids, pa.array(n, pa.int64()), pa.array(nodes, pa.int64()), pa.array(bits, pa.binary()), pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64())], names)
        if held:
            yield out(ids.type)

    return batches_of(rows, run, f"id {rows.schema['id'].dataType.simpleString()}, n long, node long, bitmap binary, token long, c long")


def frequent(counted: DataFrame) -> np.ndarray:
    """(2, n) array: the sorted frequent shingles and their counts of (token, c); at most FREQUENT of them."""
    summed = stored(counted.groupBy("token").agg(F.sum("c").alias("c")).where(F.col("c") >= RARE), "frequent")
    found = summed.where(F.col("c") >= bounding_count(summed, FREQUENT)).toArrow()
    token, c = found["token"].to_numpy().view("u8"), found["c"].to_numpy().astype("u8")
    order = np.argsort(token)
    return np.stack([token[order], c[order]])


def tile_rows(rows: DataFrame, common: np.ndarray, percent: int) -> DataFrame:
    """(token, node, n): each set's prefix, once per task for equal sets."""
    shared = rows.sparkSession.sparkContext.broadcast(common)

    def run(batches):
        often, counts = shared.value
        seen: set[int] = set()
        for _, sets in batches:
            tokens, nodes, sizes, lengths = [], [], [], []
            for own in sets:
                node = node_of(own) if len(own) else None
                if node is None or node in seen:
                    continue
                if len(seen) > REMEMBER:
                    seen.clear()
                seen.add(node)
                first = own[: prefix_length(len(own), percent)]
                if len(often):
                    at = np.minimum(np.searchsorted(often, own), len(often) - 1)
                    weight = np.where(often[at] == own, counts[at], np.uint64(0))
                    if weight.any():
                        first = own[np.lexsort((own, weight))[: len(first)]]
                tokens.append(first)
                nodes.append(node)
                sizes.append(len(own))
                lengths.append(len(first))
            if tokens:
                yield pa.RecordBatch.from_arrays([signed(np.concatenate(tokens)), pa.array(np.repeat(np.array(nodes, "i8"), lengths)), pa.array(np.repeat(np.array(sizes, "i8"), lengths))], ["token", "node", "n"])

    return batches_of(rows, run, "token long, node long, n long")


def tested(pairs: DataFrame, known: DataFrame, rows: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that link: first by the bitmaps, then by the sets, which are made anew from the texts.

    ``known``: (node, id, n, bitmap) of every class, id being one document of it.
    """
    of = known.select("node", "n", "bitmap")

    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch["a_bits"].to_pylist(), batch["b_bits"].to_pylist()
            total = batch["total"].to_numpy(zero_copy_only=False)
            differing = np.fromiter(map(differing_bits, a, b), "i8", len(a))
            yield batch.select(["a", "b"]).filter(pa.array(may_link(total, differing, percent)))

    sized = pairs.join(of.toDF("a", "a_n", "a_bits"), "a").join(of.toDF("b", "b_n", "b_bits"), "b")
    close = stored(sized.select("a", "b", "a_bits", "b_bits", (F.col("a_n") + F.col("b_n")).alias("total")).mapInArrow(bound, "a long, b long"), "close-pairs")

    needed = close.select(F.col("a").alias("node")).distinct().union(close.select("b").distinct()).distinct().join(known.select("node", "id"), "node")
    place = F.pmod(F.xxhash64("id"), F.lit(FILTER_BITS))
    bits = needed.groupBy(F.bitmap_bucket_number(place + 1).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place + 1)).alias("bits")).collect()
    table = np.zeros(FILTER_BITS, bool)
    for row in bits:  # at most FILTER_BITS / 32768 rows
        own = np.unpackbits(np.frombuffer(row["bits"], "u1"), bitorder="little").astype(bool)
        start = (row["bucket"] - 1) * 32768
        table[start : start + len(own)] = own
    shared = rows.sparkSession.sparkContext.broadcast(np.packbits(table))

    def thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            held = shared.value
            for batch in batches:
                at = batch["place"].to_numpy(zero_copy_only=False)
                hit = pa.array((held[at >> 3] >> (7 - (at & 7)) & 1).astype(bool))
                ids, own = batch["id"].filter(hit), [shingles(t) for t in batch["t"].filter(hit).to_pylist()]
                node = [node_of(x) if len(x) else None for x in own]
                yield pa.RecordBatch.from_arrays([ids, pa.array(node, pa.int64()), pa.array([x.tobytes() for x in own], pa.binary())], ["id", "node", "items"])

    kind = rows.schema["id"].dataType.simpleString()
    again = rows.where("id is not null").select("id", "t", place.alias("place")).mapInArrow(thin, f"id {kind}, node long, items binary")
    # an id may have several texts
    sets = stored(again.join(needed, ["id", "node"]).groupBy("node").agg(F.first("items").alias("items")), "sets")

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch["x"], batch["y"], strict=True):
                x, y = np.frombuffer(x.as_py(), "u8"), np.frombuffer(y.as_py(), "u8")
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return close.join(sets.toDF("a", "x"), "a").join(sets.toDF("b", "y"), "b").mapInArrow(exact, "a long, b long")


def folded(bits: bytes, words: int) -> np.ndarray:
    own = np.frombuffer(bits, "u8")
    while len(own) > words:
        own = own[: len(own) // 2] ^ own[len(own) // 2 :]
    return own


TILE = ("home", "p_i", "p_j", "kind", "token", "band", "i", "j")


def in_parts(cells: DataFrame) -> DataFrame:
    """The rows of tiles with ``part``, ``p_i`` and ``p_j``: a home of more than HOME rows is cut by its nodes, and each row goes to every pair of parts that has its own."""
    held = stored(cells.groupBy("home").agg(F.count("*").alias("c")).where(F.col("c") > HOME), "homes")
    # at most SPLIT homes reach this count
    least = max(HOME, bounding_count(held, SPLIT))
    hot = held.where(F.col("c") >= least).select("home", F.ceil(2 * F.col("c") / F.lit(least)).cast("long").alias("parts"))
    cut = cells.join(F.broadcast(hot), "home", "left").withColumn("parts", F.coalesce("parts", F.lit(1).cast("long")))
    cut = cut.withColumn("part", F.pmod(F.xxhash64("node", F.lit(1)), F.col("parts"))).withColumn("meets", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    return cut.withColumns({"p_i": F.least("part", "meets"), "p_j": F.greatest("part", "meets")}).drop("parts", "meets")


def tile_pairs(tiles: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components that the bit counts allow, from rows sorted by TILE.

    A pair may come more than once. A home's rows of kind 0 give the bitmaps of its nodes, those of kind 1 are the rows of its tiles.
    """
    names = (*TILE, "node", "n", "component", "guest", "block", "part")

    def pairs(col: list[np.ndarray], bits: dict[int, bytes]) -> Iterator[tuple[int, int]]:
        _, p_i, p_j, _, _, _, i, j, node, n, component, guest, block, part = col
        step, matrix = max(1, (1 << 18) // len(n)), None
        for k in range(0, len(n), step):
            one = (slice(k, k + step), None)
            ok = (component[one] != component) & ~(guest[one] & guest) & (100 * np.minimum(n[one], n) >= percent * np.maximum(n[one], n))
            if i[0] != j[0]:
                ok &= block[one] != block
            if p_i[0] != p_j[0]:
                ok &= part[one] != part
            x, y = np.nonzero(ok)
            x, y = x[x + k < y] + k, y[x + k < y]
            if len(x) and matrix is None:
                own = [bits[v] for v in node.tolist()]
                words = min(map(len, own)) // 8
                matrix = np.stack([folded(b, words) for b in own])
            for at in range(0, len(x), 1 << 16):
                p, q = x[at : at + (1 << 16)], y[at : at + (1 << 16)]
                close = may_link(n[p] + n[q], np.bitwise_count(matrix[p] ^ matrix[q]).sum(axis=1, dtype="i8"), percent)
                yield from zip(node[p[close]].tolist(), node[q[close]].tolist(), strict=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[list[np.ndarray], list] | None = None
        home, bits = None, {}
        sent: set[tuple[int, int]] = set()

        def out(col: list[np.ndarray], maps: list, starts: np.ndarray) -> pa.RecordBatch:
            nonlocal home, bits
            found = []
            for a, b in zip(starts[:-1], starts[1:], strict=True):
                if tuple(c[a] for c in col[:3]) != home:
                    home, bits = tuple(c[a] for c in col[:3]), {}
                    sent.clear()
                if col[3][a] == 0:
                    bits.update(zip(col[8][a:b].tolist(), maps[a:b], strict=True))
                elif b - a > 1:
                    for x, y in pairs([c[a:b] for c in col], bits):
                        pair = (min(x, y), max(x, y))
                        if pair not in sent:  # it may meet in many tiles of one home
                            if len(sent) > REMEMBER:
                                sent.clear()
                            sent.add(pair)
                            found.append(pair)
            at = np.array(found, "i8").reshape(-1, 2)
            return pa.RecordBatch.from_arrays([pa.array(at[:, 0]), pa.array(at[:, 1])], ["a", "b"])

        for batch in batches:
            col, maps = [batch[c].to_numpy(zero_copy_only=False) for c in names], batch["bitmap"].to_pylist()
            if held is not None:  # the last tile may go on
                col, maps = [np.concatenate(x) for x in zip(held[0], col, strict=True)], held[1] + maps
            if not maps:
                continue
            key = np.stack(col[: len(TILE)])
            starts = np.flatnonzero(np.concatenate([[True], (key[:, 1:] != key[:, :-1]).any(axis=0)]))
            yield out(col, maps, starts)
            held = [c[starts[-1] :] for c in col], maps[starts[-1] :]
        if held is not None:
            yield out(*held, np.array([0, len(held[1])]))

    return tiles.mapInArrow(run, "a long, b long")


def join(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """(id, n_shingles, component_id) of every row: components of documents whose sets link.

    Two documents link when 100 * intersection >= ``percent`` * union of their sets of distinct 5-word
    shingles. Null and empty texts have no shingles and link with nothing: their component is their own
    id. Repeated rows stay and share their class. Sets and shingles are told apart by 64-bit hashes.
    A component's id is the smallest id in it; null ids don't count: a row without id shares the component
    of rows with an id and an equal set, but links with no other set.
    """
    rows = picked(df, id=id_col, t=text_col)
    read = stored(read_texts(rows), "classes")
    documents = read.where("token is null").select("id", "n", "node", "bitmap")
    common = frequent(read.where("token is not null").select("token", "c"))
    known = stored(documents.where("node is not null").groupBy("node").agg(F.min("id").alias("id"), F.first("n").alias("n"), F.first("bitmap").alias("bitmap")).where("id is not null"), "known")

    each = Window.partitionBy("token")
    before = F.lag(F.struct("node", "n")).over(each.orderBy("n", "node"))
    # every node of a row with an id is in known
    beside = tile_rows(rows.where("id is not null"), common, percent).withColumns({"p": before, "least": F.min("node").over(each), "most": F.max("node").over(each)})
    shared = stored(beside.where("least != most and (p is null or p.node != node)").selectExpr("token", "node", "n", "p.node as p", "p.n as p_n"), "tiles")
    chain = shared.where(f"p is not null and 100 * p_n >= {percent} * n").select(F.least("p", "node").alias("a"), F.greatest("p", "node").alias("b")).distinct()
    first = stored(chain, "chain")
    links = stored(tested(first, known, rows, percent), "links")
    named = shared.select("token", "node", "n")
    if links.isEmpty():
        named = named.withColumn("component", F.col("node"))
    else:
        named = named.join(components(links), "node", "left").withColumn("component", F.coalesce("component", "node"))

    # all windows are inside a token, so its rows are shuffled once
    several = lambda w: {"size": F.count("*").over(w), "least": F.min("component").over(w), "most": F.max("component").over(w)}
    band = F.floor(F.log(F.col("n").cast("double")) / F.lit(math.log(1.01 * 100 / percent))).cast("long")
    # two nodes alone in a tile were neighbours; one component needs no more links
    open_ = named.withColumns(several(each)).where("size > 2 and least != most")
    banded = open_.withColumn("own", band).withColumn("band", F.explode(F.array(F.col("own"), F.col("own") - 1))).withColumns(several(Window.partitionBy("token", "band"))).where("least != most")
    blocks = F.ceil(F.col("size") / F.lit(BLOCK)).cast("long")
    cells = banded.withColumn("block", F.pmod(F.xxhash64("node"), blocks)).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    cells = cells.select("token", "band", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", (F.col("own") != F.col("band")).alias("guest"), "node", "n", "component")
    cells = stored(cells.withColumn("home", F.min("node").over(Window.partitionBy("token", "band", "i", "j"))).withColumn("kind", F.lit(1)), "cells")
    cells = in_parts(cells)
    maps = cells.select("home", "p_i", "p_j", "node").distinct().join(known.select("node", "bitmap"), "node").withColumn("kind", F.lit(0))
    zero = {c: F.lit(0).cast("long") for c in ("token", "band", "i", "j", "n", "component", "block", "part")}
    tiles = cells.withColumn("bitmap", F.lit(None).cast("binary")).unionByName(maps.withColumns(zero | {"guest": F.lit(False)}))
    tiles = tiles.repartition("home", "p_i", "p_j").sortWithinPartitions(*TILE)
    second = stored(tile_pairs(tiles, percent).distinct().join(first, ["a", "b"], "left_anti"), "more-pairs")
    if not second.isEmpty():
        links = stored(links.union(tested(second, known, rows, percent)), "links")

    if links.isEmpty():
        return with_ids(documents, known.select("node", F.col("id").alias("component_id")), id_col)
    found = components(links).join(known.select("node", "id"), "node")
    smallest = found.groupBy("component").agg(F.min("id").alias("component_id"))
    linked = found.join(smallest, "component").select("node", "component_id")
    alone = known.select("node", "id").join(linked, "node", "left").select("node", F.coalesce("component_id", "id").alias("component_id"))
    return with_ids(documents, alone, id_col)


def with_ids(documents: DataFrame, component: DataFrame, id_col: str) -> DataFrame:
    """Every document with its class's component; those without a class are their own."""
    classed = documents.where("node is not null").select("id", "n", "node").join(component, "node", "left")
    alone = documents.where("node is null").select("id", "n", F.lit(None).cast(documents.schema["id"].dataType).alias("component_id"))
    both = classed.select("id", "n", "component_id").unionByName(alone)
    return both.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id"))


def keep_first(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """The rows of ``df`` that are the first of their component: one document of each group stays, with all columns.

    Of rows that repeat the smallest id one stays (the least text). Rows with a null id stay.
    """
    found = join(df, id_col=id_col, text_col=text_col, percent=percent)
    go = found.where(F.col(f"`{id_col}`") != F.col("component_id")).select(F.col(f"`{id_col}`").alias("go_id")).distinct()
    kept = df.join(go, F.col(f"`{id_col}`") == F.col("go_id"), "left_anti")
    again = found.where(F.col(f"`{id_col}`") == F.col("component_id")).groupBy(F.col(f"`{id_col}`").alias("again_id")).count().where("count > 1").select("again_id")
    single = kept.join(again, F.col(f"`{id_col}`") == F.col("again_id"), "left_anti")
    first = F.row_number().over(Window.partitionBy(f"`{id_col}`").orderBy(f"`{text_col}`"))
    repeated = kept.join(again, F.col(f"`{id_col}`") == F.col("again_id"), "left_semi").withColumn("kept first", first).where("`kept first` = 1").drop("kept first")
    return single.unionByName(repeated)
