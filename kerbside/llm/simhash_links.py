"""SimHash near-duplicates: vantage-point trees over fingerprints, in shards.

Two 64-bit fingerprints that differ in at most four bits agree well in some
block of bits: cut into three blocks, at least one differs in one bit or none.
For every block (or choice of ``take`` of more blocks) one forest is kept, whose
metric is the Hamming distance on the chosen bits; a pair within four bits lies
there within ``radius``: 1 for one of three blocks.

The top of each tree is fitted on a bounded sample and deals all fingerprints
to shards: at a node with vantage point v and split m, a point goes to the
inner side if d(point, v) <= m. A query goes to every side that its ball can
reach by the triangle inequality, d - radius <= m or d + radius > m, and so
visits the shards that overlap its boundary too. In a shard the tree goes on
in memory, with the same bounds, down to small leaves, where full distances
are compared; points that are equal in the chosen bits are split further by the
distance on all 64, with a radius of four. Any two linked fingerprints meet in a
leaf of some tree.

A leaf emits links that span its connected points, never all pairs, so large
groups of near copies stay linear. Components are then found by alternating
large and small stars on written tables.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import is_marked, marked, materialize, shuffle_partitions, text_of

MAX_BITS = 4
BLOCKS, TAKE = 3, 1
SHINGLE = 4
SEED = 42
# Fingerprints that the tops of the trees are fitted on.
SAMPLE_ROWS = 16_384
SHARD_POINTS = 20_000
LEAF_POINTS = 128
_BATCH = 1 << 16
_ALL = np.uint64((1 << 64) - 1)

_digest = partial(xxhash.xxh64_intdigest, seed=SEED)


# --- fingerprints ------------------------------------------------------------


def simhash(text: str) -> int:
    """Bits that are set in over half of the hashes of the text's shingles."""
    found = text.encode("utf-8", "surrogatepass").lower().split()  # ASCII rules for bytes
    if not found:
        return 0
    if len(found) < SHINGLE:
        return _digest(b" ".join(found))
    shingles = map(b" ".join, zip(*[found[k:] for k in range(SHINGLE)], strict=False))
    n = len(found) - SHINGLE + 1
    hashes = np.fromiter(map(_digest, shingles), np.uint64, n)
    counts = np.zeros(64, np.int64)
    for at in range(0, n, _BATCH):
        part = np.ascontiguousarray(hashes[at : at + _BATCH]).view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * counts > n, bitorder="little")
    return int(bits.view(np.uint64)[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``fp``, the fingerprint as a signed long."""

    @F.pandas_udf("long")
    def fingerprint(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([simhash(t) for t in texts], np.uint64).view(np.int64))

    return docs.select("doc_id", fingerprint(text_of()).alias("fp"))


# --- trees -------------------------------------------------------------------


def block_masks(blocks: int = BLOCKS, take: int = TAKE) -> tuple[list[int], int]:
    """Masks of every choice of ``take`` blocks, and the radius that a link has there."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    each = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:], strict=False)]
    low, rest = divmod(MAX_BITS, blocks)
    radius = take * low + max(0, take - (blocks - rest))
    return [sum(c) for c in combinations(each, take)], radius


def _distance(points: np.ndarray, to: np.uint64, mask: np.uint64) -> np.ndarray:
    return np.bitwise_count((points ^ to) & mask).astype(np.int16)


def _split(points: np.ndarray, mask: np.uint64) -> tuple[np.uint64, int] | None:
    """Of a few vantage points the one that halves the points best, and its distance.

    None where every one leaves less than a sixteenth on a side.
    """
    best, least = None, len(points) // 16
    for k in range(4):
        vantage = points[len(points) * (2 * k + 1) // 8]
        d = _distance(points, vantage, mask)
        middle = int(np.median(d))
        for m in (middle, middle - 1):
            inner = int((d <= m).sum())
            if min(inner, len(points) - inner) > least:
                best, least = (vantage, m), min(inner, len(points) - inner)
    return best


def _top(points: np.ndarray, mask: np.uint64, depth: int):
    """Nested (vantage, split, inner, outer); None is a shard."""
    if depth == 0 or len(points) < 8 or (found := _split(points, mask)) is None:
        return None
    vantage, middle = found
    inner = _distance(points, vantage, mask) <= middle
    return vantage, middle, _top(points[inner], mask, depth - 1), _top(points[~inner], mask, depth - 1)


def _route(node, points, rows, home, mask, radius, path, out) -> None:
    """Append (path of shard, rows, whether at home) for all shards that rows go to."""
    if not len(rows):
        return
    if node is None:
        out.append((path, rows, home))
        return
    vantage, middle, inner, outer = node
    d = _distance(points[rows], vantage, mask)
    near, far = d <= middle, d > middle
    for side, here, reach in ((inner, near, d - radius <= middle), (outer, far, d + radius > middle)):
        step = 2 * path + (side is outer)
        _route(side, points, rows[reach], home[reach] & here[reach], mask, radius, step, out)


def _gathered(batches: Iterator[pd.DataFrame]) -> Iterator[np.ndarray]:
    """Fingerprints of many small batches together: each node then costs once per block."""
    held, n = [], 0
    for batch in batches:
        held.append(batch["fp"].to_numpy(np.int64))
        n += len(batch)
        if n >= _BATCH:
            yield np.concatenate(held).view(np.uint64)
            held, n = [], 0
    if n:
        yield np.concatenate(held).view(np.uint64)


def _deal(trees: list, masks: list[int], radius: int):
    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for points in _gathered(batches):
            every, home = np.arange(len(points)), np.ones(len(points), bool)
            for k, (tree, mask) in enumerate(zip(trees, masks, strict=True)):
                out: list = []
                _route(tree, points, every, home, np.uint64(mask), radius, 1, out)
                for path, rows, own in out:
                    yield pd.DataFrame(
                        {"tree": k, "shard": path, "fp": points[rows].view(np.int64), "home": own}
                    )

    return deal


def _span(points: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links that connect what is within MAX_BITS; each point is expanded once."""
    links, left = [], points
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            at = queue.pop()
            near = np.bitwise_count(left ^ at) <= MAX_BITS
            if near.any():
                found, left = left[near], left[~near]
                links.append((np.full(len(found), at), found))
                queue.extend(found)
    return links


def _leaf(points: np.ndarray, queries: np.ndarray, links: list) -> None:
    if len(points) * len(queries) <= 4 * LEAF_POINTS**2:
        near = np.bitwise_count(queries[:, None] ^ points[None, :]) <= MAX_BITS
        i, j = np.nonzero(near)
        some = queries[i] < points[j]
        both = np.nonzero(queries[i] > points[j])[0] if len(queries) > len(points) else []
        if some.sum() + len(both) <= 4 * (len(points) + len(queries)):
            links.append((queries[i][some], points[j][some]))
            links.append((queries[i][both], points[j][both])) if len(both) else None
            return
    links.extend(_span(np.unique(np.concatenate([points, queries]))))


def _search(points: np.ndarray, queries: np.ndarray, mask: np.uint64, radius: int, links: list) -> None:
    """Links between points and queries that lie within ``radius`` under ``mask``."""
    if not len(points) or not len(queries):
        return
    found = _split(points, mask) if len(points) > LEAF_POINTS else None
    if found is None:
        if len(points) > LEAF_POINTS and mask != _ALL:
            _search(points, queries, _ALL, MAX_BITS, links)
        else:
            _leaf(points, queries, links)
        return
    vantage, middle = found
    inner = _distance(points, vantage, mask) <= middle
    d = _distance(queries, vantage, mask)
    _search(points[inner], queries[d - radius <= middle], mask, radius, links)
    _search(points[~inner], queries[d + radius > middle], mask, radius, links)


def _link(masks: list[int], radius: int):
    def link(rows: pd.DataFrame) -> pd.DataFrame:
        values = np.unique(rows["fp"].to_numpy(np.int64).view(np.uint64))
        own = rows.loc[rows["home"], "fp"].to_numpy(np.int64).view(np.uint64)
        links: list = []
        _search(np.unique(own), values, np.uint64(masks[rows["tree"].iloc[0]]), radius, links)
        pairs = [np.concatenate(side).view(np.int64) for side in zip(*links, strict=True)] if links else [[], []]
        return pd.DataFrame({"a": pairs[0], "b": pairs[1]}, dtype="int64").drop_duplicates()

    return link


def links(distinct: DataFrame, *, blocks: int = BLOCKS, take: int = TAKE) -> DataFrame:
    """Pairs ``a, b`` that connect all distinct ``fp`` within MAX_BITS of each other.

    Every pair differs in at most MAX_BITS bits, and whatever is linked is
    connected by them; large groups get spanning links instead of all pairs.
    ``distinct`` should be a written table: it is read three times.
    """
    spark = distinct.sparkSession
    masks, radius = block_masks(blocks, take)
    n = distinct.count()
    sample = distinct.select("fp").sample(min(1.0, SAMPLE_ROWS / max(n, 1)), seed=SEED)
    points = sample.limit(2 * SAMPLE_ROWS).toPandas()["fp"].to_numpy(np.int64).view(np.uint64)
    want = max(n / SHARD_POINTS, 2 * shuffle_partitions(spark) / len(masks), 1)
    trees = [_top(points, np.uint64(m), math.ceil(math.log2(want))) for m in masks]
    dealt = distinct.select("fp").mapInPandas(
        _deal(trees, masks, radius), "tree int, shard long, fp long, home boolean"
    )
    found = dealt.groupBy("tree", "shard").applyInPandas(_link(masks, radius), "a long, b long")
    return found.where("a != b").distinct()


# --- components --------------------------------------------------------------


def _mark(edges: DataFrame) -> tuple:
    got = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
    return tuple(got)


def components(pairs: DataFrame) -> DataFrame:
    """``u, v``: each linked node but the least of its component, and that least node.

    Alternates large stars (a node's larger neighbours join its least neighbour)
    and small stars (its smaller neighbours do) until nothing changes. The least
    neighbours are written before they are joined, so that a node with very many
    neighbours is a skewed join between two shuffles, which Spark can split.
    """
    edges = pairs.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    edges = materialize(edges.where("u != v").distinct(), "links")
    mark = _mark(edges)
    while mark[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        least = materialize(least, "links-least")
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialize(large.distinct(), "links-large")
        down = materialize(large.groupBy("u").agg(F.min("v").alias("m")), "links-least")
        moved = large.join(down, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = moved.where("u != v").unionByName(down.select("u", F.col("m").alias("v")))
        edges = materialize(small.distinct(), "links")
        before, mark = mark, _mark(edges)
        if mark == before:
            break
    return edges


def near_duplicates(docs: DataFrame, *, blocks: int = BLOCKS, take: int = TAKE) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row of ``docs``.

    The component is the least id among all documents that links reach. Null
    text is empty and has fingerprint zero, which links like any other; equal
    texts have equal fingerprints and are one node; rows without an id never
    name a component, and get null where a component has no other rows; other
    columns are ignored.
    """
    rows = materialize(fingerprints(docs), "simhash")
    distinct = rows.groupBy("fp").agg(F.min("doc_id").alias("least_id"))
    distinct = materialize(distinct, "simhash-distinct")
    stars = components(links(distinct, blocks=blocks, take=take))
    named = distinct.join(stars.select(F.col("u").alias("fp"), "v"), "fp", "left")
    named = named.select("fp", "least_id", F.coalesce("v", "fp").alias("v"))
    least = named.groupBy("v").agg(F.min("least_id").alias("component_id"))
    least = materialize(least, "simhash-least")
    by_fp = materialize(named.select("fp", "v").join(least, "v").select("fp", "component_id"), "simhash-groups")
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return rows.join(by_fp, "fp").select("doc_id", digits, "component_id")


def one_of_each(docs: DataFrame, *, blocks: int = BLOCKS, take: int = TAKE) -> DataFrame:
    """Of each component of linked fingerprints one row, the first by id.

    Rows are judged one by one, not by id: of rows that share an id those of other
    components are not touched, and of several in one component one stays. Rows
    without an id come after all others. Rows without words are one component.
    """
    row = "simhash__row"
    rows = materialize(docs.withColumn(row, F.monotonically_increasing_id()), "simhash-rows")
    named = rows.select(F.col(row).alias("doc_id"), "text")
    groups = near_duplicates(named, blocks=blocks, take=take)
    groups = groups.select(F.col("doc_id").alias(row), "component_id")
    groups = materialize(groups.join(rows.select(row, "doc_id"), row), "simhash-members")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", row)
    first = groups.groupBy("component_id").agg(F.min(order).alias("first"))
    first = materialize(first.select("component_id", F.col(f"first.{row}").alias("first")), "simhash-first")
    gone = groups.join(first, "component_id").where(F.col(row) != F.col("first"))
    gone = materialize(gone.select(row, F.xxhash64(row).alias("hash")), "simhash-gone")
    # Only rows that the bitmap cannot tell to stay are shuffled with their texts.
    may_go = is_marked(*marked(gone, "hash"))(F.xxhash64(row))
    kept = rows.where(may_go).join(gone, row, "left_anti").unionByName(rows.where(~may_go))
    return kept.select(*docs.columns)
