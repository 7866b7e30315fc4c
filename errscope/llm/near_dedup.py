"""Operator 10, near-duplicates by BagMinHash signatures.

A text is the bag of its shingles (runs of ``shingle`` words, with counts as
weights). BagMinHash runs a Poisson process for every shingle over its weight,
cut into dyadic strips (0,1], (1,2], (2,4], ...: points of a strip come in
order of time, each with a level in the strip and a component of the signature;
a point counts where its level lies below the weight. A component is the first
point that hits it, so two signatures agree in a component with the weighted
Jaccard similarity of the bags. Points later than the latest component cannot
matter, so a process stops there and a text costs about its shingles plus a
number of points that depends on the signature only.

Equal texts (same words) are one node from the start, and only one row of them
goes on. Nodes that rows of one id stand for are linked. Bands of components that agree make buckets. In a bucket each text
is compared with one other, its hub, not with all. Buckets whose texts then
still belong to different classes go into further rounds: a text leaves a bucket
when the shingles that it alone has rule out a link to any text there, the most
central texts become hubs, and their number grows until every pair of a bucket
is in one class, compared or ruled out. Before texts are compared, sketches of
their signatures are: pairs whose sketches differ by five standard deviations
more than a link allows go no further (fewer links are lost that way than by the
bands themselves, which miss five in a million at the least similarity).
Pairs are verified by the exact overlap of their bags. Classes are the connected
components of verified pairs.

Cases: null or empty text and texts without words are classes of their own; a
text shorter than a shingle has one shingle of all its words; rows that repeat
an id are one document, whose links are those of all its texts; rows with a null id take part under no id and are classes
of their own; an empty table gives an empty result; other columns are not passed
on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import ALNUM, Words, broadcast_if_few, map_arrow, map_batches, materialise, mix, signed, words_of

_STEP = np.uint64(0x9E3779B97F4A7C15)


# ------------------------------------------------------------------ bags
def shingles(w: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of all shingles of the rows of a slice."""
    n = np.diff(w.bounds)
    row = w.row_of_word()
    place = np.arange(len(w.hash)) - np.repeat(w.bounds[:-1], n)
    starts = np.flatnonzero((place + size <= n[row]) | (place == 0))
    length = np.minimum(size, n[row[starts]])
    out = np.zeros(len(starts), np.uint64)
    for k in range(size):
        use = length > k
        at = starts[use] + k
        out[use] = mix(out[use] * _STEP + w.hash[at] + np.uint64(k))
    return row[starts], out


def bags(w: Words, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, hash, count) of the distinct shingles of each row."""
    row, h = shingles(w, size)
    order = np.lexsort((h, row))
    row, h = row[order], h[order]
    if not len(row):
        return row, h, np.zeros(0, np.int64)
    new = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (h[1:] != h[:-1])]))
    return row[new], h[new], np.diff(np.append(new, len(row)))


def text_keys(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Two independent hashes of each row's sequence of words."""
    n = np.diff(w.bounds)
    place = (np.arange(len(w.hash)) - np.repeat(w.bounds[:-1], n)).astype(np.uint64)
    out = []
    for salt in (np.uint64(0x51), np.uint64(0xA7)):
        term = mix(w.hash + (place + np.uint64(1)) * _STEP * salt)
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(term, dtype=np.uint64)])
        out.append(mix(total[w.bounds[1:]] - total[w.bounds[:-1]] + n.astype(np.uint64)))
    return out[0], out[1]


# ------------------------------------------------------------------ signatures
def _uniform(h: np.ndarray) -> np.ndarray:
    """Hashes as numbers in (0, 1)."""
    return ((h >> np.uint64(11)).astype(np.float64) + 0.5) * (1.0 / (1 << 53))


def _strips(row: np.ndarray, h: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, seed, lower edge, width, weight) of every strip that a shingle's weight reaches."""
    out = [[row], [mix(h ^ np.uint64(0x1234567))], [np.zeros(len(row))], [np.ones(len(row))], [count.astype(np.float64)]]
    low, level = 1, 1
    more = np.flatnonzero(count > low)
    while len(more):
        for part, value in zip(out, (row[more], mix(h[more] + np.uint64(level * int(_STEP) & 0xFFFFFFFFFFFFFFFF)), np.full(len(more), float(low)), np.full(len(more), float(low)), count[more].astype(np.float64))):
            part.append(value)
        low, level = low * 2, level + 1
        more = more[count[more] > low]
    return tuple(np.concatenate(x) for x in out)


def signatures(rows: int, row: np.ndarray, h: np.ndarray, count: np.ndarray, components: int) -> np.ndarray:
    """BagMinHash signatures (rows x components of times; infinity for empty bags)."""
    best = np.full((rows, components), np.inf)
    weight = np.bincount(row, weights=count, minlength=rows)
    some = np.flatnonzero(weight > 0)
    limit = np.zeros(rows)  # no point after this time matters to the row
    limit[some] = (np.log(components) + 3) / weight[some]
    pending = some
    strip_row, seed, low, width, reach = _strips(row, h, count)
    while len(pending):
        open_rows = np.zeros(rows, bool)
        open_rows[pending] = True
        own = np.flatnonzero(open_rows[strip_row])
        r, state, lo, wide, top = strip_row[own], seed[own], low[own], width[own], reach[own]
        time = np.zeros(len(own))
        best[pending] = np.inf
        drawn = 0
        while len(r):
            block = 1 if len(r) > 4096 else 32  # points drawn at once
            turn = np.arange(drawn + 1, drawn + block + 1, dtype=np.uint64) * _STEP
            drawn += block
            point = mix(state[:, None] + turn)
            gap = -np.log(_uniform(point)) / (components * wide)[:, None]
            gap[:, 0] += time
            times = np.cumsum(gap, axis=1)
            e, k = np.nonzero(times <= limit[r][:, None])
            draw = mix(point[e, k] ^ np.uint64(0xC2B2AE3D27D4EB4F))
            level = lo[e] + np.ceil(_uniform(mix(draw + _STEP)) * wide[e])  # discretised to whole weights
            hit = level <= top[e]
            np.minimum.at(best, (r[e[hit]], (draw[hit] % np.uint64(components)).astype(np.int64)), times[e[hit], k[hit]])
            time = times[:, -1]
            go = time <= limit[r]
            r, state, lo, wide, top, time = r[go], state[go], lo[go], wide[go], top[go], time[go]
        late = ~np.isfinite(best[pending]).all(axis=1)
        pending = pending[late]
        limit[pending] *= 2
    return best


def band_keys(best: np.ndarray, bands: int) -> np.ndarray:
    """(rows x bands) hashes of runs of components."""
    rows, components = best.shape
    bits = best.view(np.uint64).reshape(rows, bands, components // bands)
    key = np.full((rows, bands), np.uint64(7))
    for k in range(bits.shape[2]):
        key = mix(key * _STEP + bits[:, :, k])
    return key + np.arange(bands, dtype=np.uint64) * _STEP


SKETCH_BITS = 3  # of each component


def sketches(best: np.ndarray) -> np.ndarray:
    """(rows x words) bit planes of the components: components that agree have
    equal bits in all planes, others in one of eight cases."""
    rows, components = best.shape
    h = mix(best.view(np.uint64) + _STEP)
    width = -(-components // 64) * 64
    planes = []
    for bit in range(SKETCH_BITS):
        one = np.zeros((rows, width), np.uint8)
        one[:, :components] = (h >> np.uint64(7 + bit)) & np.uint64(1)
        planes.append(np.packbits(one, axis=1).view(np.uint64))
    return np.concatenate(planes, axis=1)


def most_differences(components: int, similarity: float, deviations: float = 5.0) -> int:
    """How many components of two sketches differ at most, but for five standard
    deviations of chance, when the bags are as similar as that."""
    p = (1 - similarity) * (1 - 0.5**SKETCH_BITS)
    return int(np.ceil(components * p + deviations * np.sqrt(components * p * (1 - p))))


def _differences(a: str, b: str, components: int):
    """Column: the number of components in which two sketch columns differ."""
    words = -(-components // 64)
    total = None
    for w in range(words):
        planes = [f"({a}[{w + k * words}] ^ {b}[{w + k * words}])" for k in range(SKETCH_BITS)]
        part = F.expr(f"bit_count({' | '.join(planes)})")
        total = part if total is None else total + part
    return total


def signed_rows(docs: DataFrame, id_col: str, text_col: str, shingle: int, bands: int, band_size: int) -> DataFrame:
    """(id, hi, lo, weight, bands, sketch) of every row; bands is empty without words."""
    id_type = dict(docs.dtypes)[id_col]
    components = bands * band_size

    def run(batch: pa.RecordBatch):
        for w in words_of(batch.column(1), ALNUM):
            row, h, count = bags(w, shingle)
            keys = np.zeros((w.rows, bands), np.uint64)
            planes = np.zeros((w.rows, SKETCH_BITS * -(-components // 64)), np.uint64)
            cut = 512  # rows whose points are drawn together
            for at in range(0, w.rows, cut):
                a, b = np.searchsorted(row, [at, at + cut])
                n = min(cut, w.rows - at)
                best = signatures(n, row[a:b] - at, h[a:b], count[a:b], components)
                keys[at : at + n], planes[at : at + n] = band_keys(best, bands), sketches(best)
            hi, lo = text_keys(w)
            full = np.diff(w.bounds) > 0
            offsets = np.concatenate([[0], np.cumsum(np.where(full, bands, 0))]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(signed(keys[full].ravel())))
            weight = np.bincount(row, weights=count, minlength=w.rows).astype(np.int64)
            sketch = pa.ListArray.from_arrays(pa.array(np.arange(0, planes.size + 1, planes.shape[1], dtype=np.int32)), pa.array(signed(planes.ravel())))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(w.first_row, w.rows), pa.array(signed(hi)), pa.array(signed(lo)), pa.array(weight), lists, sketch],
                names=["id", "hi", "lo", "weight", "bands", "sketch"],
            )

    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return map_batches(source, run, f"id {id_type}, hi long, lo long, weight long, bands array<long>, sketch array<long>")


# ------------------------------------------------------------------ verification
def _overlap(left: pa.Array, right: pa.Array, shingle: int) -> np.ndarray:
    """Weighted Jaccard similarity of the bags of paired texts."""
    n = len(left)
    parts = []
    for column in (left, right):
        got = [(r + w.first_row, h, c) for w in words_of(column, ALNUM) for r, h, c in [bags(w, shingle)]]
        parts.append([np.concatenate(x) for x in zip(*got)])
    total = sum(np.bincount(r, weights=c, minlength=n) for r, _, c in parts)
    row = np.concatenate([p[0] for p in parts])
    h = np.concatenate([p[1] for p in parts])
    c = np.concatenate([p[2] for p in parts])
    order = np.lexsort((h, row))
    row, h, c = row[order], h[order], c[order]
    same = np.flatnonzero((row[1:] == row[:-1]) & (h[1:] == h[:-1]))
    shared = np.bincount(row[same], weights=np.minimum(c[same], c[same + 1]), minlength=n)
    return np.where(total > shared, shared / np.maximum(total - shared, 1), 1.0)


def verified(pairs: DataFrame, texts: DataFrame, shingle: int, similarity: float, batch_rows: int = 64) -> DataFrame:
    """Those (a, b) of ``pairs`` whose bags overlap enough. ``texts``: (id, text)."""

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for at in range(0, batch.num_rows, batch_rows):
                part = batch.slice(at, batch_rows)
                good = _overlap(part.column(2), part.column(3), shingle) >= similarity
                yield pa.RecordBatch.from_arrays([part.column(0).filter(pa.array(good)), part.column(1).filter(pa.array(good))], names=["a", "b"])

    met = (
        pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a")
        .join(texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b")
        .select("a", "b", "text_a", "text_b")
    )
    id_type = dict(pairs.dtypes)["a"]
    return map_arrow(met, run, f"a {id_type}, b {id_type}")


# ------------------------------------------------------------------ components
def components_of(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(id, class): connected components of (a, b), named by their smallest id.

    Every node points to the smallest id it knows; each round passes the
    pointers of both ends of an edge on and then follows them one step."""
    edges = materialise(edges.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("other")).where("node <> other").distinct(), "edges")
    both = edges.unionByName(edges.select(F.col("other").alias("node"), F.col("node").alias("other")))
    labels = materialise(both.groupBy(F.col("node").alias("id")).agg(F.least(F.min("other"), F.min("node")).alias("class")), "labels")
    for _ in range(max_rounds):
        near = both.join(labels.select(F.col("id").alias("other"), "class"), "other").groupBy(F.col("node").alias("id")).agg(F.min("class").alias("near"))
        passed = labels.join(near, "id").select("id", F.least("class", "near").alias("step"), F.col("class").alias("before"))
        up = labels.select(F.col("id").alias("step"), F.col("class").alias("up"))
        after = materialise(passed.join(up, "step", "left").select("id", F.least("step", F.coalesce("up", "step")).alias("class"), "before"), "labels")
        changed = after.where(F.col("class") != F.col("before")).limit(1).count()
        labels = after.select("id", "class")
        if not changed:
            return labels
    raise RuntimeError("connected components did not settle")


# ------------------------------------------------------------------ operator
def _with_classes(members: DataFrame, classes: DataFrame) -> DataFrame:
    return members.drop("class").join(classes, "id", "left").withColumn("class", F.coalesce("class", "id"))


def _mixed(members: DataFrame) -> DataFrame:
    """Members of buckets that hold more than one class."""
    keys = members.groupBy("key").agg(F.min("class").alias("_lo"), F.max("class").alias("_hi")).where("_lo <> _hi").select("key")
    return members.join(keys, "key", "left_semi")


def _own_weight(texts: DataFrame, ids: DataFrame, shingle: int) -> DataFrame:
    """(id, own): the weight of shingles that no other of these texts has."""

    def run(batch: pa.RecordBatch):
        for w in words_of(batch.column(1), ALNUM):
            row, h, count = bags(w, shingle)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row + w.first_row)), pa.array(signed(h)), pa.array(count.astype(np.int64))], names=["id", "h", "n"])

    some = texts.join(ids, "id", "left_semi").select("id", "text")
    bag = map_batches(some, run, f"id {dict(texts.dtypes)['id']}, h long, n long")
    alone = bag.groupBy("h").agg(F.count(F.lit(1)).alias("texts"), F.min("id").alias("id"), F.sum("n").alias("n")).where("texts = 1")
    return alone.groupBy("id").agg(F.sum("n").alias("own"))


def _may_link(weight, common, other_weight, share: float):
    """Bags of similarity s share at least s / (1 + s) of their weights' sum,
    and a text shares no more than its weight without what it has alone."""
    return common >= share * (weight + other_weight) - 1e-6


def _viable(members: DataFrame, share: float) -> DataFrame:
    """Members that may link to the lightest text of their bucket. Who may not
    links to none of its texts, whatever their number."""
    least = members.groupBy("key").agg(F.min("weight").alias("_least"))
    return members.join(least, "key").where(_may_link(F.col("weight"), F.col("common"), F.col("_least"), share)).drop("_least")


def _pairs_of_round(members: DataFrame, before: int, hubs: int, share: float, components: int, differ: int) -> DataFrame:
    """(a, b, a > b): members of a bucket with its hubs, the most central texts
    (least weight of their own, ties to the smaller id) from place ``before`` + 1
    to ``hubs``, that are more central, of another class and may link by weights
    and, in later rounds, by sketches. Every pair has one place where it is
    looked at: the first bucket that it shares, with its more central text as hub."""
    facts = ["id", "weight", "common", "class", *[c for c in ("sketch", "bands") if c in members.columns]]
    members = members.withColumn("far", 1 - F.col("common") / F.col("weight"))
    order = F.struct("far", *facts)
    if hubs == 1:
        hub = members.groupBy("key").agg(F.min(order).alias("hub"))
    else:
        first = W.partitionBy("key").orderBy("hub")
        hub = members.select("key", order.alias("hub")).withColumn("_n", F.row_number().over(first)).where((F.col("_n") <= hubs) & (F.col("_n") > before))
    hub = hub.select("key", *[F.col(f"hub.{c}").alias(f"hub_{c}") for c in ("far", *facts)])
    wanted = (F.col("class") != F.col("hub_class")) & (F.struct("far", "id") > F.struct("hub_far", "hub_id"))
    wanted = wanted & _may_link(F.col("weight"), F.col("common"), F.col("hub_weight"), share)
    wanted = wanted & _may_link(F.col("hub_weight"), F.col("hub_common"), F.col("weight"), share)
    if "bands" in members.columns:
        earlier = F.slice("bands", 1, F.array_position("bands", F.col("key")).cast("int") - 1)
        wanted = wanted & (_differences("sketch", "hub_sketch", components) <= differ) & ~F.arrays_overlap(earlier, "hub_bands")
    met = members.join(hub, "key").where(wanted)
    return met.select(F.greatest("id", "hub_id").alias("a"), F.least("id", "hub_id").alias("b")).distinct()


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 5,
    similarity: float = 0.8,
    bands: int = 40,
    band_size: int = 6,
    hub_growth: int = 32,
    broadcast_rows: int = 500_000,
) -> DataFrame:
    """(id, ``class_id``, ``class_size``, ``kept``) of every document.

    ``class_id`` is the smallest id of the class; that document is kept."""
    rows = materialise(signed_rows(docs, id_col, text_col, shingle, bands, band_size), "signatures")
    usable = rows.where(F.col("id").isNotNull() & (F.size("bands") > 0))
    exact = usable.groupBy("hi", "lo").agg(F.min("id").alias("rep"), F.first("weight").alias("weight"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch"))
    exact = materialise(exact.withColumn("node", F.monotonically_increasing_id()), "exact-classes")

    banded = exact.select(F.col("node").alias("id"), "weight", F.explode("bands").alias("key"))
    shared_keys = banded.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    members = banded.join(shared_keys, "key", "left_semi").withColumns({"class": F.col("id"), "common": F.col("weight")})
    members = materialise(members, "buckets")
    wanted = exact.select("rep", "hi", "lo", "node").join(members.select(F.col("id").alias("node")).distinct(), "node", "left_semi")
    texts = materialise(_texts_of(docs, id_col, text_col, wanted, broadcast_rows), "bucket-texts")
    same = _nodes_of_one_id(usable, exact)

    share, differ = similarity / (1 + similarity), most_differences(bands * band_size, similarity)
    edges, tested, classes = same, None, None
    before, hubs, largest = 0, 1, 1
    while True:
        wanted = _pairs_of_round(members, before, hubs, share, bands * band_size, differ)
        if tested is not None:
            wanted = wanted.join(tested, ["a", "b"], "left_anti")
        wanted = materialise(wanted, "pairs")
        good = materialise(verified(wanted, texts, shingle, similarity), "links")
        edges = edges.unionByName(good)
        tested = wanted if tested is None else tested.unionByName(wanted)
        if classes is None or good.limit(1).count():
            classes = components_of(edges)
        if hubs == 1:
            members = materialise(_mixed(_with_classes(members, classes)), "mixed-buckets")
            own = _own_weight(texts, members.select("id").distinct(), shingle)
            members = members.join(own, "id", "left").withColumn("common", F.col("weight") - F.coalesce("own", F.lit(0))).drop("own")
            facts = exact.select(F.col("node").alias("id"), "sketch", "bands")
            open_members = materialise(_viable(members, share).join(facts, "id"), "open-buckets")
            sizes = open_members.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
            largest = sizes.agg(F.max("n")).toArrow().column(0)[0].as_py() or 0
            hubs = 0  # the first round took ids as centres, so its hubs count no more
        if hubs >= largest:  # every pair of a bucket is in one class, was compared or cannot link
            break
        before, hubs = hubs, max(hub_growth, hubs * hub_growth)
        members = _with_classes(open_members, classes)
    named = exact.select("hi", "lo", "rep", "node").join(classes.withColumnRenamed("id", "node"), "node", "left").withColumn("class", F.coalesce("class", "node"))
    least = named.groupBy("class").agg(F.min("rep").alias("class_id"))
    label = named.join(least, "class").select("hi", "lo", "class_id")
    alone = rows.where(F.col("id").isNull() | (F.size("bands") == 0)).select("id", F.col("id").alias("class_id"))
    labelled = usable.join(label, ["hi", "lo"]).groupBy("id").agg(F.min("class_id").alias("class_id")).unionByName(alone)
    sizes = labelled.where(F.col("class_id").isNotNull()).groupBy("class_id").agg(F.count(F.lit(1)).alias("class_size"))
    out = labelled.join(sizes.where("class_size > 1"), "class_id", "left")
    return out.select(F.col("id").alias(id_col), "class_id", F.coalesce("class_size", F.lit(1).cast("long")).alias("class_size"), F.col("id").eqNullSafe(F.col("class_id")).alias("kept"))


def _texts_of(docs: DataFrame, id_col: str, text_col: str, wanted: DataFrame, broadcast_rows: int) -> DataFrame:
    """(id, text): a text for each node of ``wanted`` (rep, hi, lo, node)."""
    few = broadcast_if_few(wanted, "bucket-nodes", broadcast_rows)
    found = docs.select(F.col(id_col).alias("rep"), F.col(text_col).alias("text")).join(few.select("rep"), "rep", "left_semi")

    def run(batch: pa.RecordBatch):
        for w in words_of(batch.column(0), ALNUM):
            hi, lo = text_keys(w)
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(w.first_row, w.rows), pa.array(signed(hi)), pa.array(signed(lo))], names=["text", "hi", "lo"])

    keyed = map_batches(found.select("text"), run, "text string, hi long, lo long")
    return keyed.join(few.select("hi", "lo", F.col("node").alias("id")), ["hi", "lo"]).select("id", "text").dropDuplicates(["id"])


def _nodes_of_one_id(usable: DataFrame, exact: DataFrame) -> DataFrame:
    """(a, b): links between the nodes that rows of one id stand for."""
    key = F.struct("hi", "lo")
    several = usable.groupBy("id").agg(F.min(key).alias("first"), F.max(key).alias("last")).where("first <> last")
    met = usable.join(materialise(several.select("id", "first"), "ids-of-several-texts"), "id").select("hi", "lo", "first").distinct()
    node = exact.select("hi", "lo", F.col("node").alias("a"))
    first = exact.select(F.struct("hi", "lo").alias("first"), F.col("node").alias("b"))
    return materialise(met.join(node, ["hi", "lo"]).join(first, "first").where("a <> b").select("a", "b"), "links-of-one-id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", broadcast_rows: int = 500_000, **settings) -> DataFrame:
    """The documents that stay: one of each class of near-duplicates, and one
    row of those that repeat an id. Rows with a null id all stay."""
    found = near_duplicates(docs, id_col, text_col, broadcast_rows=broadcast_rows, **settings)
    gone = broadcast_if_few(found.where(~F.col("kept")).select(id_col), "near-copies", broadcast_rows)
    left = docs.join(gone, id_col, "left_anti").select(*docs.columns)
    repeated = docs.where(F.col(id_col).isNotNull()).groupBy(id_col).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(id_col)
    repeated = broadcast_if_few(repeated, "repeated-ids", broadcast_rows)
    if not repeated.limit(1).count():
        return left
    once = left.join(repeated, id_col, "left_semi").dropDuplicates([id_col])
    return left.join(repeated, id_col, "left_anti").unionByName(once).select(*docs.columns)
