"""Operator 8, approximate nearest neighbours by adaptive dimension scan.

Vectors are rotated by a random orthogonal matrix and assigned to the lists of
a coarse index (centroids fitted on a bounded sample; every row is indexed).
A query probes its nearest lists. Within a list candidates are compared block
of columns by block of columns: the partial squared distance over the columns
seen so far, scaled to all columns, is tested against the distance of the k-th
best candidate; candidates that are farther beyond the test's margin are
abandoned. Largest inner product becomes smallest distance by one further
column that lifts all vectors to the same length.

Lists are cut into salted parts of bounded size, and parts are spread over
shards; a query goes once to each shard that holds some of its lists. How many lists a query probes is calibrated: for a
bounded number of sample queries the true neighbours are found by a scan of all
rows, and the smallest number of probes with the wanted recall is taken.

Cases: vectors that are null, empty, zero, of another width than most or that
hold null or non-finite components take no part; ties go to the smaller id;
rows that repeat an id are candidates one by one; fewer candidates than k give
all of them; an empty table gives an empty result; other columns are not passed
on.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import arrow_rows, materialise

_FIELDS = "query_id long, vec_id long, score double"


def usable_vectors(rows: DataFrame, id_col: str, vec_col: str, is_query: Column) -> DataFrame:
    """(id, vec, is_query, key1, key2) of rows that take part; the keys tell equal vectors."""
    kind = dict(rows.dtypes)[vec_col]
    vec = F.col(vec_col) if kind in ("array<float>", "array<double>") else F.col(vec_col).cast("array<double>")
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    whole = (
        rows.where(vec.isNotNull() & (F.size(vec) > 0) & finite & F.exists(vec, lambda x: x != 0) & F.col(id_col).isNotNull())
        .select(F.col(id_col).cast("long").alias("id"), vec.alias("vec"), F.coalesce(is_query, F.lit(False)).alias("is_query"))
        .withColumns({"key1": F.xxhash64("vec"), "key2": F.xxhash64(F.lit(1), "vec")})
    )
    width = whole.groupBy(F.size("vec").alias("w")).count().orderBy(F.desc("count"), "w").limit(1).toArrow()
    if not width.num_rows:
        return whole
    return whole.where(F.size("vec") == width.column("w")[0].as_py())


def _kmeans(sample: np.ndarray, k: int, rounds: int = 8, seed: int = 17) -> np.ndarray:
    rng = np.random.default_rng(seed)
    centre = sample[rng.choice(len(sample), k, replace=False)]
    for _ in range(rounds):
        near = np.argmin((centre**2).sum(1) - 2 * sample @ centre.T, axis=1)
        total = np.zeros_like(centre)
        np.add.at(total, near, sample)
        count = np.bincount(near, minlength=k)
        empty = count == 0
        centre = np.where(empty[:, None], sample[rng.choice(len(sample), k)], total / np.maximum(count, 1)[:, None])
    return centre


@dataclass
class Index:
    """Rotation, lift and centroids; ``probes`` lists are searched."""

    longest: float  # squared length that all vectors are lifted to
    rotation: np.ndarray
    centroids: np.ndarray
    probes: int

    def lifted(self, x: np.ndarray, query: bool) -> np.ndarray:
        """Vectors with the further column (0 for queries, which have unit length), rotated."""
        if query:
            x = x / np.sqrt((x**2).sum(1, keepdims=True))
            extra = np.zeros((len(x), 1))
        else:
            extra = np.sqrt(np.maximum(0, self.longest - (x**2).sum(1, keepdims=True)))
            x, extra = x / np.sqrt(self.longest), extra / np.sqrt(self.longest)
        return np.hstack([x, extra]) @ self.rotation

    def nearest_lists(self, rotated: np.ndarray, n: int) -> np.ndarray:
        far = (self.centroids**2).sum(1) - 2 * rotated @ self.centroids.T
        return np.argsort(far, axis=1, kind="stable")[:, :n]


def fit_index(vectors: DataFrame, sample_rows: int, list_rows: int, max_lists: int, seed: int = 29) -> tuple[Index, int] | None:
    """Centroids from the ``sample_rows`` rows with the smallest id hashes."""
    stats = vectors.agg(F.count(F.lit(1)), F.max(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))), F.max(F.size("vec"))).toArrow().to_pylist()[0]
    n, longest, width = stats.values()
    if not n:
        return None
    picked = vectors.orderBy(F.xxhash64("id"), "id").limit(min(sample_rows, n))
    sample = np.array(arrow_rows(picked.select("vec"), sample_rows, "index sample").column("vec").to_pylist(), dtype=np.float64)
    rng = np.random.default_rng(seed)
    rotation = np.linalg.qr(rng.normal(size=(width + 1, width + 1)))[0]
    index = Index(longest, rotation, np.zeros((1, width + 1)), 1)
    lists = int(min(max_lists, max(1, np.sqrt(n)), max(1, n // list_rows), len(sample)))
    index.centroids = _kmeans(index.lifted(sample, False), lists)
    index.probes = lists
    return index, n


def _trim(query: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k largest scores of each query, ties to the smaller id."""
    order = np.lexsort((ids, -score, query))
    first = np.flatnonzero(np.concatenate([[True], np.diff(query[order]) != 0])) if len(order) else np.zeros(0, int)
    rank = np.arange(len(order)) - np.repeat(first, np.diff(np.append(first, len(order))))
    return order[rank < k]


def adaptive_scan(queries: np.ndarray, rows: np.ndarray, bound: np.ndarray, block: int, margin: float) -> tuple[np.ndarray, np.ndarray]:
    """(query, row) pairs that survive the scan of one list.

    ``bound`` is each query's squared distance to beat. After each block of
    columns the partial distance, scaled to all columns, is tested against the
    bound with a margin that shrinks as more columns are seen. While most pairs
    are alive the block is a matrix product; later single pairs are gathered."""
    width = rows.shape[1]
    partial = np.zeros((len(queries), len(rows)))
    alive = np.ones(partial.shape, bool)
    seen = 0
    while seen < width and alive.mean() > 0.25:
        a, b = queries[:, seen : seen + block], rows[:, seen : seen + block]
        partial += (a**2).sum(1)[:, None] + (b**2).sum(1)[None, :] - 2 * a @ b.T
        seen = min(seen + block, width)
        alive &= partial * (width / seen) <= _limit(bound, seen, width, margin)[:, None]
    q, r = np.nonzero(alive)
    partial = partial[q, r]
    while seen < width:
        partial = partial + ((queries[q, seen : seen + block] - rows[r, seen : seen + block]) ** 2).sum(1)
        seen = min(seen + block, width)
        keep = partial * (width / seen) <= _limit(bound, seen, width, margin)[q]
        q, r, partial = q[keep], r[keep], partial[keep]
    return q, r


def _limit(bound: np.ndarray, seen: int, width: int, margin: float) -> np.ndarray:
    return bound * ((1 + margin / np.sqrt(seen)) ** 2 if seen < width else 1) + 1e-9


SLICE = 256  # queries that are held against a shard at once
PAIRS = 500_000  # of which so many pairs of a list at once


def _scores(asked: np.ndarray, rows: np.ndarray, q: np.ndarray, r: np.ndarray, step: int = 16_384) -> np.ndarray:
    """Inner products of single pairs, in slices."""
    out = np.empty(len(q))
    for at in range(0, len(q), step):
        out[at : at + step] = np.einsum("ij,ij->i", asked[q[at : at + step]], rows[r[at : at + step]])
    return out


class _Shard:
    """The rows of the lists of one shard, which queries pass by in slices."""

    def __init__(self, idx: Index, ids: np.ndarray, lists: np.ndarray, rows: np.ndarray, k: int, block: int, margin: float):
        self.idx, self.ids, self.rows, self.k, self.block, self.margin = idx, ids, rows, k, block, margin
        self.rotated = idx.lifted(rows, False)
        order = np.argsort(lists, kind="stable")
        self.members = {int(lists[some[0]]): some for some in np.split(order, np.flatnonzero(np.diff(lists[order])) + 1)}

    def search(self, asked: np.ndarray, probes: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, row, score): the k best rows of each query in the lists that it probes."""
        k, rotated_queries = self.k, self.idx.lifted(asked, True)
        prober = np.repeat(np.arange(len(probes)), [len(x) for x in probes])
        probed = np.concatenate(probes)
        scale = np.sqrt((asked**2).sum(1) * self.idx.longest)
        bound = np.full(len(asked), np.inf)
        best_q, best_r, best_s = np.zeros(0, int), np.zeros(0, int), np.zeros(0)
        for one in sorted(self.members):
            who, members = prober[probed == one], self.members[one]
            for some in np.array_split(who, min(len(who), -(-len(who) * len(members) // PAIRS)) or 1):
                if not len(some):
                    continue
                q, r = adaptive_scan(rotated_queries[some], self.rotated[members], bound[some], self.block, self.margin)
                q, r = some[q], members[r]
                score = _scores(asked, self.rows, q, r)
                best_q, best_r, best_s = np.append(best_q, q), np.append(best_r, r), np.append(best_s, score)
                keep = _trim(best_q, self.ids[best_r], best_s, k)
                best_q, best_r, best_s = best_q[keep], best_r[keep], best_s[keep]
                last = np.flatnonzero(np.bincount(best_q, minlength=len(asked)) == k)
                worst = np.full(len(asked), np.inf)
                np.minimum.at(worst, best_q, best_s)
                bound[last] = np.maximum(0, 2 - 2 * worst[last] / scale[last])
        return best_q, best_r, best_s


def _search(index, k: int, block: int, margin: float):
    """Function of batches (shard, side, id, vec, lists) sorted by shard and side: the rows
    of a shard's lists (side 0), then the queries that probe some of them. A task holds
    the rows of one shard and a slice of its queries, however many queries there are."""

    def run(batches):
        now, rows, shard = None, [], None
        for batch in batches:
            number, side = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            cuts = np.flatnonzero((np.diff(number) != 0) | (np.diff(side) != 0)) + 1
            for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(number)]):
                if hi == lo:
                    continue
                if number[lo] != now:
                    now, rows, shard = number[lo], [], None
                if side[lo] == 0:
                    some = batch.slice(lo, hi - lo)
                    rows.append((some.column(2).to_numpy(), some.column(4).flatten().to_numpy(), _rows_of(some.column(3))))
                    continue
                if not rows:
                    continue
                if shard is None:
                    shard, rows = _Shard(index.value, *(np.concatenate(c) for c in zip(*rows)), k, block, margin), [None]
                for at in range(lo, hi, SLICE):
                    some = batch.slice(at, min(SLICE, hi - at))
                    probes = np.split(some.column(4).flatten().to_numpy(), np.cumsum(some.column(4).value_lengths().to_numpy())[:-1])
                    q, r, score = shard.search(_rows_of(some.column(3)), probes)
                    yield pa.RecordBatch.from_arrays([pa.array(some.column(2).to_numpy()[q]), pa.array(shard.ids[r]), pa.array(score)], names=["query_id", "vec_id", "score"])

    return run


def nearest(pairs: DataFrame, k: int) -> DataFrame:
    """The k best rows of each query with their rank."""
    best = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return pairs.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def exact_search(vectors: DataFrame, queries: np.ndarray, query_ids: np.ndarray, k: int) -> DataFrame:
    """(query_id, vec_id, score): true neighbours of a bounded set of queries,
    by a scan of all rows that keeps the best k of each batch."""
    shared = vectors.sparkSession.sparkContext.broadcast((queries, query_ids))

    def run(batches):
        asked, names = shared.value
        for batch in batches:
            ids, x = batch.column(0).to_numpy(), _rows_of(batch.column(1))
            score = x @ asked.T
            r, q = np.nonzero(ids[:, None] != names[None, :])
            best = _trim(q, ids[r], score[r, q], k)
            yield pa.RecordBatch.from_arrays([pa.array(names[q[best]]), pa.array(ids[r[best]]), pa.array(score[r[best], q[best]])], names=["query_id", "vec_id", "score"])

    return vectors.select("id", "vec").mapInArrow(run, _FIELDS)


def _sliced(batches, rows: int):
    """The batches in slices of at most ``rows`` rows, as what is made of a row may be long."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _rows_of(column: pa.Array) -> np.ndarray:
    """A list column of equal lengths as a matrix."""
    return np.asarray(column.flatten(), dtype=np.float64).reshape(len(column), -1)


def calibrate(index: Index, vectors: DataFrame, queries: DataFrame, k: int, recall: float, sample_queries: int) -> float:
    """Set ``probes`` to the fewest lists that hold the wanted share of true
    neighbours of the sample queries. Returns that share."""
    picked = arrow_rows(queries.orderBy(F.xxhash64("id"), "id").limit(sample_queries).select("id", "vec"), sample_queries, "calibration queries")
    if not picked.num_rows:
        return 1.0
    asked, names = np.array(picked.column("vec").to_pylist(), dtype=np.float64), picked.column("id").to_numpy()
    truth = nearest(exact_search(vectors, asked, names, k), k).join(vectors.select(F.col("id").alias("vec_id"), "vec").dropDuplicates(["vec_id"]), "vec_id")
    truth = arrow_rows(truth.select("query_id", "vec"), sample_queries * k, "true neighbours")
    if not truth.num_rows:
        return 1.0
    lists = index.nearest_lists(index.lifted(np.array(truth.column("vec").to_pylist(), dtype=np.float64), False), 1)[:, 0]
    probed = index.nearest_lists(index.lifted(asked, True), len(index.centroids))
    place = {name: {c: i for i, c in enumerate(order)} for name, order in zip(names, probed)}
    needed = np.sort([place[q][c] + 1 for q, c in zip(truth.column("query_id").to_numpy(), lists)])
    index.probes = int(needed[min(len(needed), int(np.ceil(recall * len(needed)))) - 1])
    return float((needed <= index.probes).mean())


def _shard(lists, parts, shards: int):
    """Where part ``parts`` of a list is searched; for numbers, arrays and columns."""
    return (lists * 1_000_003 + parts * 7_919) % shards


def _members(vectors: DataFrame, index: Index) -> DataFrame:
    """(list, id, vec): every row with its list."""
    shared = vectors.sparkSession.sparkContext.broadcast(index)

    def run(batches):
        for batch in _sliced(batches, 1024):
            lists = shared.value.nearest_lists(shared.value.lifted(_rows_of(batch.column(1)), False), 1)[:, 0]
            yield pa.RecordBatch.from_arrays([pa.array(lists.astype(np.int32)), batch.column(0), batch.column(1)], names=["list", "id", "vec"])

    source = vectors.select("id", "vec")
    return source.mapInArrow(run, f"list int, id long, vec {dict(source.dtypes)['vec']}")


def _probes(queries: DataFrame, index: Index, sizes: np.ndarray, part_rows: int, shards: int, least: int) -> DataFrame:
    """(shard, id, vec, lists): every query once for each shard that holds some
    of its lists. A query probes further lists until they hold ``least`` rows."""
    shared = queries.sparkSession.sparkContext.broadcast((index, sizes))

    def run(batches):
        idx, sizes = shared.value
        parts = -(-sizes // part_rows)
        for batch in _sliced(batches, SLICE):
            lists = idx.nearest_lists(idx.lifted(_rows_of(batch.column(1)), True), len(sizes))
            row, shard, own = [], [], []
            for i, order in enumerate(lists):
                probed = order[: max(idx.probes, int(np.searchsorted(np.cumsum(sizes[order]), least)) + 1)]
                one = np.repeat(probed, parts[probed])
                part = np.concatenate([np.arange(n) for n in parts[probed]])
                at = _shard(one, part, shards)
                by_shard = np.argsort(at, kind="stable")
                for group in np.split(by_shard, np.flatnonzero(np.diff(at[by_shard])) + 1):
                    row.append(i)
                    shard.append(int(at[group[0]]))
                    own.append(np.unique(one[group]).astype(np.int32))
            take = pa.array(row, pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(shard, pa.int32()), batch.column(0).take(take), batch.column(1).take(take), pa.array(own, pa.list_(pa.int32()))], names=["shard", "id", "vec", "lists"])

    source = queries.select("id", "vec")
    return source.mapInArrow(run, f"shard int, id long, vec {dict(source.dtypes)['vec']}, lists array<int>")


def ann_search(
    rows: DataFrame,
    is_query: Column,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    k: int = 20,
    recall: float = 0.98,
    sample_rows: int = 20_000,
    sample_queries: int = 128,
    list_rows: int = 64,
    max_lists: int = 1024,
    part_rows: int = 4096,
    shard_rows: int = 8192,
    least_shards: int = 16,
    block: int = 16,
    margin: float = 2.1,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows of largest inner product
    found for each row where ``is_query`` (over ``id_col``) holds.

    Of equal vectors only the k + 1 with the smallest ids can be in any answer,
    so the others are not compared; equal query vectors are searched once."""
    spark = rows.sparkSession
    vectors = materialise(usable_vectors(rows, id_col, vec_col, is_query), "vectors")
    same = ["key1", "key2"]
    copies = W.partitionBy(*same).orderBy("id")
    useful = vectors.withColumn("copy", F.row_number().over(copies)).where(F.col("copy") <= k + 1).select("id", "vec")
    fitted = fit_index(vectors, sample_rows, list_rows, max_lists)
    if fitted is None:
        return nearest(spark.createDataFrame([], _FIELDS), k)
    index, n = fitted
    asked = vectors.where("is_query")
    calibrate(index, vectors, asked, k, recall, sample_queries)

    listed = materialise(_members(useful, index), "vector-lists")
    counted = arrow_rows(listed.groupBy("list").agg(F.count(F.lit(1)).alias("n")), max_lists, "lists")
    sizes = np.zeros(len(index.centroids), np.int64)
    sizes[counted.column("list").to_numpy()] = counted.column("n").to_numpy()
    shards = max(least_shards, -(-n // shard_rows))

    parts_of = F.element_at(F.array(*[F.lit(int(x)) for x in -(-sizes // part_rows)]), F.col("list") + 1)
    part = F.pmod(F.xxhash64("id"), parts_of)
    members = listed.withColumn("shard", _shard(F.col("list").cast("long"), part, shards).cast("int"))
    distinct = asked.groupBy(*same).agg(F.min("id").alias("id"), F.first("vec").alias("vec"))
    distinct = materialise(distinct, "query-vectors")
    probes = _probes(distinct, index, sizes, part_rows, shards, 4 * (k + 1))
    side = lambda df, n, lists: df.select("shard", F.lit(n).alias("side"), "id", "vec", lists)
    passing = side(members, 0, F.array("list").alias("lists")).unionByName(side(probes, 1, F.col("lists")))
    passing = passing.repartition(min(2 * shards, 4096), "shard").sortWithinPartitions("shard", "side")
    found = passing.mapInArrow(_search(spark.sparkContext.broadcast(index), k + 1, block, margin), _FIELDS)
    found = nearest(found, k + 1).withColumnRenamed("query_id", "searched").drop("rank")

    # every query row takes the answer of its vector, without itself
    who = asked.select(F.col("id").alias("query_id"), *same).distinct().join(distinct.select(F.col("id").alias("searched"), *same), same)
    answers = who.join(found, "searched").where(F.col("vec_id") != F.col("query_id"))
    return nearest(answers.select("query_id", "vec_id", "score"), k)
