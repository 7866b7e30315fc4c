"""Operator 12, Jaccard join of word n-gram sets by vertical partitioning.

A document is the set of its shingles. All shingles stand in one global order,
rare ones first, which pivots cut into fragments; so every set falls into
segments, one for each fragment. Partial overlaps are counted in each fragment
on its own and summed per pair.

Pairs that cannot link are never counted. All bounds follow from one fact: two
sets that link share at least ``similarity`` of either one's shingles.

1. Equal sets are one node. A node's head is the share of its shingles with the
   smallest hashes; a node with too few shingles in its head that also stand in
   the head of another node has no link at all.
2. For the others all shingles are counted; nodes with too few that others have
   too go, and as counts fall thereby, this is done twice.
3. In the global order two sets that link share a shingle among the first ones
   of each. Stars over these shingles give groups; links stay within a group.
4. A group is cut into parts of bounded size by length band and hash, and pairs of
   parts are cells. Where a group has several parts, all its nodes are first held
   against one of them, its hub, and parts that wholly link to the hub need not
   be held against each other. A cell counts partial overlaps in each fragment
   as a product of 0/1 matrices; one row for each cell and fragment carries
   them to where they are summed, and a spanning forest of the links goes on.
5. Components of the links give every document its smallest reachable id.

Cases: null and empty texts and texts without words have no shingles and link
with nothing; a text shorter than a shingle has one, of all its words; rows that
repeat an id are one document whose links are those of all its texts; rows with a
null id take part, and their component is the smallest id that they reach, or
null; an empty table gives an empty result; other columns are not passed on.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import NON_SPACE, Words, broadcast_if_few, map_arrow, map_batches, materialise, mix, signed, words_of
from .near_dedup import bags, components_of

PART_ROWS = 256  # sets of a part
PART_SHINGLES = 4_000_000  # shingles of a part, unless a single set has more
PEELINGS = 2


# ------------------------------------------------------------------ sets
def _share(n, percent: int):
    """``percent`` of n, rounded up to a whole number."""
    return (n * percent + 99) // 100


def _share_col(n: Column, percent: int) -> Column:
    return ((n * percent + 99 - (n * percent + 99) % 100) / 100).cast("long")


def set_keys(w: Words, row: np.ndarray, h: np.ndarray, n: np.ndarray, salt: int) -> list[np.ndarray]:
    """Two independent hashes of each row's set of shingles."""
    out = []
    for k in (2 * salt + 1, 2 * salt + 2):
        turned = mix(h ^ np.uint64(k * 0x9E3779B97F4A7C15 % 2**64))
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(turned, dtype=np.uint64)])
        first = np.searchsorted(row, np.arange(w.rows + 1))
        out.append(mix(total[first[1:]] - total[first[:-1]] + n.astype(np.uint64)))
    return out


def _lists(values: np.ndarray, sizes: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(signed(values)))


def _sets(texts: pa.Array, shingle: int, salt: int) -> Iterator[tuple[Words, np.ndarray, np.ndarray, np.ndarray, list[np.ndarray], np.ndarray]]:
    """(words, row, hash, set sizes, keys, first row of its set) for runs of rows."""
    for w in words_of(texts, NON_SPACE):
        row, h, _ = bags(w, shingle)  # by row, then by hash
        n = np.bincount(row, minlength=w.rows)
        keys = set_keys(w, row, h, n, salt)
        first = np.zeros(w.rows, bool)
        first[np.unique(keys[0], return_index=True)[1]] = True
        yield w, row, h, n, keys, first & (n > 0)


def profiles(docs: DataFrame, id_col: str, text_col: str, shingle: int, percent: int, head_percent: int, salt: int) -> DataFrame:
    """(id, n, node, other, head) of every row; head is empty where the same
    batch has given that of an equal set already."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for w, row, h, n, keys, first in _sets(batch.column(1), shingle, salt):
            size = np.where(first, n - _share(n, percent) + _share(n, head_percent), 0)
            place = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            none = pa.array(n == 0)
            node, other = (pa.array(signed(k), mask=none.to_numpy(zero_copy_only=False)) for k in keys)
            head = _lists(h[place < size[row]], size)
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(w.first_row, w.rows), pa.array(n.astype(np.int64)), node, other, head], names=["id", "n", "node", "other", "head"])

    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return map_batches(source, run, f"id {dict(docs.dtypes)[id_col]}, n long, node long, other long, head array<long>")


def whole_sets(docs: DataFrame, text_col: str, nodes: DataFrame, shingle: int, salt: int) -> DataFrame:
    """(node, n, items) of the wanted ``nodes``: all shingles of each."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for w, row, h, n, keys, first in _sets(batch.column(0), shingle, salt):
            yield pa.RecordBatch.from_arrays([pa.array(signed(keys[0][first])), pa.array(n[first].astype(np.int64)), _lists(h[first[row]], n[first])], names=["node", "n", "items"])

    found = map_batches(docs.select(text_col), run, "node long, n long, items array<long>").join(nodes, "node", "left_semi")
    return found.groupBy("node").agg(F.first("n").alias("n"), F.first("items").alias("items"))


def viable_heads(rows: DataFrame, percent: int, head_percent: int) -> DataFrame:
    """(node): those whose head shares enough shingles with other heads. A head
    holds the first (head share) of what a set has in common with any partner;
    the shortest partner asks for least."""
    given = rows.where(F.size("head") > 0)
    heads = given.select("node", F.explode("head").alias("h"))
    shared = heads.groupBy("h").agg(F.min("node").alias("_lo"), F.max("node").alias("_hi")).where("_lo <> _hi").select("h")
    hits = heads.join(shared, "h", "left_semi").groupBy("node").agg(F.count(F.lit(1)).alias("hits"))
    copies = given.groupBy("node").agg(F.count(F.lit(1)).alias("copies"), F.first("n").alias("n"))  # each gave the same head
    least = _share_col(_share_col(F.col("n"), percent), head_percent)
    return hits.join(copies, "node").where(F.col("hits") >= least * F.col("copies")).select("node")


def peeled(sets: DataFrame, item: str, percent: int) -> DataFrame:
    """(node, n, items) of the sets that may link: items are (df, h) of the
    shingles that other sets have too, in the global order."""
    rows = sets.select("node", "n", F.explode("items").alias("x")).select("node", "n", F.col(item).alias("h"))
    shared = rows.groupBy("h").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    met = rows.join(shared, "h").groupBy("node").agg(F.first("n").alias("n"), F.sort_array(F.collect_list(F.struct("df", "h"))).alias("items"))  # within one document
    return met.where(F.size("items") * 100 >= F.col("n") * percent)


def groups(sets: DataFrame, percent: int) -> DataFrame:
    """(node, group): sets that may link share a shingle among their first ones."""
    first = F.col("n") - _share_col(F.col("n"), percent) + 1 - (F.col("n") - F.size("items"))
    lead = sets.select("node", F.explode(F.slice("items", F.lit(1), first.cast("int"))).alias("x")).select("node", F.col("x.h").alias("h"))
    hubs = lead.groupBy("h").agg(F.min("node").alias("hub"), F.max("node").alias("_last")).where("hub <> _last").select("h", "hub")
    stars = lead.join(hubs, "h").where("node <> hub").select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct()
    return components_of(stars).select(F.col("id").alias("node"), F.col("class").alias("group"))


# ------------------------------------------------------------------ cells
def pivots_of(sets: DataFrame, fragments: int) -> list[float]:
    """Places in the global order that cut all shingles into even fragments."""
    x = sets.select(F.explode("items").alias("x"))
    cuts = [k / fragments for k in range(1, fragments)]
    return x.agg(F.percentile_approx(_place(F.col("x")), cuts, 1000).alias("p")).toArrow().column("p")[0].as_py() or []


def _place(x: Column) -> Column:
    """The place of a shingle in the global order: by frequency, then by hash."""
    return x["df"].cast("double") + x["h"].cast("double") / 2.0**64 + 0.5


def _segments(items: Column, pivots: list[float]) -> Column:
    """The hashes of each fragment, as an array of arrays."""
    edges = [-math.inf, *pivots, math.inf]

    def within(low: float, high: float) -> Column:
        return F.transform(F.filter(items, lambda x: (_place(x) > low) & (_place(x) <= high)), lambda x: x["h"])

    return F.array(*[within(low, high) for low, high in zip(edges, edges[1:])])


def blocks_of(members: DataFrame, pivots: list[float]) -> DataFrame:
    """(part, fragment, meta, docs) from (part, node, n, items): ``meta`` has
    (node, n, m) of all sets of the part, ``docs`` the segments of this fragment."""
    meta = members.groupBy("part").agg(F.sort_array(F.collect_list(F.struct("node", "n", F.size("items").cast("long").alias("m")))).alias("meta"))  # at most a part
    pieces = members.select("part", "node", F.posexplode(_segments(F.col("items"), pivots)).alias("fragment", "hs")).where(F.size("hs") > 0)
    docs = pieces.groupBy("part", "fragment").agg(F.collect_list(F.struct("node", "hs")).alias("docs"))
    return docs.join(meta, "part")


def _fields(cell: pa.ListScalar, *kinds: int) -> list[np.ndarray]:
    values = cell.values
    return [values.field(k).to_numpy(zero_copy_only=False) for k in kinds]


def _segment_rows(cell: pa.ListScalar, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place of the set in its part, hash) of all shingles of a block."""
    docs = cell.values
    hs = docs.field(1)
    n = np.diff(hs.offsets.to_numpy())
    return np.repeat(np.searchsorted(nodes, docs.field(0).to_numpy()), n), hs.flatten().to_numpy()


def overlaps(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], rows: int, columns: int, run: int = 4096) -> np.ndarray:
    """How many hashes each row of ``a`` and each row of ``b`` share, by products of 0/1 matrices."""
    both = np.intersect1d(a[1], b[1])
    out = np.zeros((rows, columns), np.float32)  # whole numbers below 2**24
    for at in range(0, len(both), run):
        some = both[at : at + run]
        sides = []
        for (row, h), n in ((a, rows), (b, columns)):
            k = np.minimum(np.searchsorted(some, h), len(some) - 1)
            hit = some[k] == h
            m = np.zeros((n, len(some)), np.float32)
            m[row[hit], k[hit]] = 1
            sides.append(m)
        out += sides[0] @ sides[1].T
    return out


def partial_overlaps(cells: DataFrame, blocks: DataFrame, percent: int) -> DataFrame:
    """(cell, a_meta, b_meta, pairs, counts): for each cell and fragment the
    shared shingles of those pairs that may link by their sizes."""
    kind = "array<struct<node:long,n:long,m:long>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at_of = {c: batch.column(c) for c in batch.schema.names}
            pairs, counts = [], []
            for at in range(batch.num_rows):
                (a_node, a_n, a_m), (b_node, b_n, b_m) = (_fields(at_of[c][at], 0, 1, 2) for c in ("a_meta", "b_meta"))
                same = at_of["pa"][at].as_py() == at_of["pb"][at].as_py()
                a = _segment_rows(at_of["a_docs"][at], a_node)
                b = a if same else _segment_rows(at_of["b_docs"][at], b_node)
                shared = overlaps(a, b, len(a_node), len(b_node))
                may = np.minimum(a_m[:, None], b_m[None, :]) * (100 + percent) >= percent * (a_n[:, None] + b_n[None, :])
                if same:
                    may = np.triu(may, 1)
                pair = np.flatnonzero((shared * may).ravel())
                pairs.append(pair)
                counts.append(shared.ravel()[pair])
            sizes = [len(p) for p in pairs]
            offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
            flat = [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([*x, np.zeros(0)]).astype(np.int32))) for x in (pairs, counts)]
            yield pa.RecordBatch.from_arrays([at_of["cell"], at_of["a_meta"], at_of["b_meta"], *flat], names=["cell", "a_meta", "b_meta", "pairs", "counts"])

    a = blocks.select(F.col("part").alias("pa"), "fragment", F.col("meta").alias("a_meta"), F.col("docs").alias("a_docs"))
    b = blocks.select(F.col("part").alias("pb"), "fragment", F.col("meta").alias("b_meta"), F.col("docs").alias("b_docs"))
    met = cells.join(a, "pa").join(b, ["pb", "fragment"])
    return map_arrow(met.select("cell", "pa", "pb", "a_meta", "b_meta", "a_docs", "b_docs"), run, f"cell long, a_meta {kind}, b_meta {kind}, pairs array<int>, counts array<int>").where(F.size("pairs") > 0)


def forest(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """The smallest place that each of n places reaches over the links (i, j)."""
    label = np.arange(n)
    while True:
        before = label.copy()
        low = np.minimum(label[i], label[j])
        np.minimum.at(label, i, low)
        np.minimum.at(label, j, low)
        label = label[label]
        if (label == before).all():
            return label


def summed_links(partial: DataFrame, percent: int) -> DataFrame:
    """(a, b): a spanning forest of each cell's links, from its partial overlaps."""

    def links(parts: list[tuple]) -> pa.RecordBatch:
        (a_node, a_n), (b_node, b_n) = parts[0][0], parts[0][1]
        total = np.zeros(len(a_node) * len(b_node), np.int64)
        for _, _, pair, count in parts:
            total[pair] += count
        size = (a_n[:, None] + b_n[None, :]).ravel()
        i, j = np.divmod(np.flatnonzero((total > 0) & (100 * total >= percent * (size - total))), len(b_node))
        node, at = np.unique(np.concatenate([a_node, b_node]), return_inverse=True)
        label = forest(at[i], at[len(a_node) + j], len(node))
        other = np.flatnonzero(label != np.arange(len(node)))
        return pa.RecordBatch.from_arrays([pa.array(node[other]), pa.array(node[label[other]])], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts = None, []
        for batch in batches:
            cell = batch.column("cell").to_pylist()
            for at in range(batch.num_rows):
                if cell[at] != now:
                    if parts:
                        yield links(parts)
                    now, parts = cell[at], []
                sides = [_fields(batch.column(c)[at], 0, 1) for c in ("a_meta", "b_meta")]
                parts.append((*sides, *(batch.column(c)[at].values.to_numpy() for c in ("pairs", "counts"))))
        if parts:
            yield links(parts)

    return map_arrow(partial.repartition("cell").sortWithinPartitions("cell"), run, "a long, b long")


def _links(members: DataFrame, cells: DataFrame, pivots: list[float], percent: int) -> DataFrame:
    """Links of ``cells`` (pa, pb) between the parts of ``members`` (part, node, n, items)."""
    blocks = materialise(blocks_of(members, pivots), "fragment-blocks")
    numbered = materialise(cells.select("pa", "pb", F.monotonically_increasing_id().alias("cell")), "cells")
    return materialise(summed_links(partial_overlaps(numbered, blocks, percent), percent), "ngram-links")


def links_of(sets: DataFrame, percent: int, fragments: int, part_rows: int = PART_ROWS, part_shingles: int = PART_SHINGLES) -> DataFrame:
    """(a, b): links that connect all sets (node, n, items) that links connect."""
    members = materialise(sets.join(groups(sets, percent), "node"), "groups")
    pivots = pivots_of(members, fragments)
    held = F.greatest(F.lit(1), F.least(F.lit(part_rows), F.floor(F.lit(part_shingles) / F.col("longest"))))
    size = members.groupBy("group").agg(F.count(F.lit(1)).alias("sets"), F.max("n").alias("longest"))
    size = size.select("group", F.ceil(F.col("sets") / held).cast("long").alias("parts"))
    members = members.join(size, "group")
    band = F.floor(F.log(F.col("n").cast("double")) / math.log(1.05 * 100 / percent)).cast("int")  # linked sets lie in one band or two adjacent ones
    members = members.withColumns({"band": F.when(F.col("parts") > 1, band).otherwise(0), "slot": F.pmod(F.xxhash64("node"), F.col("parts"))})
    members = materialise(members, "group-members")
    place = ["group", "settled", "band", "slot"]

    # groups of several parts: all their sets against one
    large = members.where("parts > 1").withColumn("settled", F.lit(0))
    found = None
    hubs = large.groupBy("group").agg(F.min(F.struct((1 - F.size("items") / F.col("n")).alias("own"), "node")).alias("hub")).select("group", F.col("hub.node").alias("hub"))
    hubs = materialise(hubs, "hubs")
    if hubs.limit(1).count():
        parts = materialise(large.select(*place).distinct().withColumn("part", F.monotonically_increasing_id()), "parts")
        alone = large.join(hubs.select(F.col("hub").alias("node")), "node", "left_semi").withColumn("part", -1 - F.monotonically_increasing_id())
        alone = materialise(alone.select("group", "part", "node", "n", "items"), "hub-sets")
        cells = alone.select("group", F.col("part").alias("pa")).join(parts.select("group", F.col("part").alias("pb")), "group")
        both = large.join(parts, place).select("part", "node", "n", "items").unionByName(alone.drop("group"))
        found = _links(both, cells, pivots, percent)
        near = found.select(F.col("a").alias("node")).unionByName(found.select(F.col("b").alias("node"))).distinct()
        members = members.join(near.withColumn("settled", F.lit(1)), "node", "left").withColumn("settled", F.coalesce("settled", F.lit(0)))
    else:
        members = members.withColumn("settled", F.lit(0))

    members = materialise(members, "settled-members")
    parts = materialise(members.select(*place).distinct().withColumn("part", F.monotonically_increasing_id()), "parts")
    a, b = (parts.select("group", *[F.col(c).alias(f"{s}_{c}") for c in ("settled", "band", "part")]) for s in "ab")
    wanted = (F.col("a_part") <= F.col("b_part")) & (F.abs(F.col("a_band") - F.col("b_band")) <= 1) & (F.col("a_settled") + F.col("b_settled") < 2)
    cells = a.join(b, "group").where(wanted).select(F.col("a_part").alias("pa"), F.col("b_part").alias("pb"))
    links = _links(members.join(parts, place).select("part", "node", "n", "items"), cells, pivots, percent)
    return links if found is None else links.unionByName(found)


# ------------------------------------------------------------------ operator
def ngram_join(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 5,
    percent: int = 80,
    fragments: int = 8,
    head_percent: int = 10,
    broadcast_rows: int = 500_000,
    **limits: int,
) -> DataFrame:
    """(id, ``n_shingles``, ``component_id``) of every row of ``docs``.

    Rows link when their sets' Jaccard similarity is at least ``percent``."""
    salt = 0
    while True:
        rows = materialise(profiles(docs, id_col, text_col, shingle, percent, head_percent, salt), "set-profiles")
        nodes = rows.where(F.col("node").isNotNull()).groupBy("node").agg(F.min("id").alias("least"), F.min("other").alias("_lo"), F.max("other").alias("_hi"))
        nodes = materialise(nodes, "set-nodes")
        if not nodes.where("_lo <> _hi").limit(1).count():
            break
        salt += 1  # two sets have one key

    wanted = broadcast_if_few(viable_heads(rows, percent, head_percent), "viable-sets", broadcast_rows)
    sets = materialise(whole_sets(docs, text_col, wanted, shingle, salt), "whole-sets")
    for k in range(PEELINGS):
        sets = materialise(peeled(sets, "x.h" if k else "x", percent), "peeled-sets")
    links = links_of(sets, percent, fragments, **limits)

    # texts of one id hang together
    several = rows.where(F.col("id").isNotNull() & F.col("node").isNotNull()).groupBy("id").agg(F.min("node").alias("b"), F.max("node").alias("_last")).where("b <> _last")
    same = rows.join(several.select("id", "b"), "id").select(F.col("node").alias("a"), "b").where("a <> b")
    classes = components_of(links.unionByName(same))
    near = nodes.join(classes.select(F.col("id").alias("node"), "class"), "node", "left").select("node", "least", F.coalesce("class", "node").alias("class"))
    least = near.groupBy("class").agg(F.min("least").alias("component_id"))
    named = near.join(least, "class").where(~F.col("component_id").eqNullSafe(F.col("least"))).select("node", F.col("component_id").alias("_named"))  # the others are their own
    out = rows.join(nodes.select("node", "least"), "node", "left").join(named, "node", "left")
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("_named", "least", "id").alias("component_id"))
