"""Embedding near-duplicates by E8 lattice hashing.

Vectors of one label and dimension are normalised, projected at random onto two
blocks of eight dimensions in each of ``TABLES`` tables, and each block is
decoded to its E8 lattice point and, as a probe, to the next nearest one. The
four combinations are a vector's cells of a table; two vectors that share any
cell are compared by cosine in double precision. At the limit of 0.98 a pair
misses every table once in 25,000 times, and random pairs share a cell once in
two million, whatever the corpus holds, so candidates stay few.

Equal vectors are one class. Cells give links that span the connected parts
(never all pairs of a cell); a vector's links, which join vectors of one part
only, are then counted exactly within each part, block against block.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.llm.buckets import links, spread
from recordloom.llm.tables import table
from recordloom.operators.graph import connected_components
from recordloom.operators.joins import hot_join
from recordloom.plans.lineage import cut

COSINE, TABLES, BLOCKS, SCALE, SEED = 0.98, 12, 2, 1.2, 8
#: Vectors of a part that are compared at a time with as many others.
SIDE = 1024


def _roots() -> np.ndarray:
    """The 240 shortest vectors of E8, by their rule."""
    whole = [np.bincount(ij, s, 8) for ij in itertools.combinations(range(8), 2) for s in itertools.product((1.0, -1.0), repeat=2)]
    half = [np.array(s) for s in itertools.product((0.5, -0.5), repeat=8) if sum(v < 0 for v in s) % 2 == 0]
    return np.array(whole + half)


ROOTS = _roots()


def _even(x: np.ndarray) -> np.ndarray:
    """The nearest whole points with an even sum."""
    near = np.rint(x)
    off = x - near
    odd = np.flatnonzero(near.sum(1) % 2)
    worst = np.abs(off[odd]).argmax(1)
    near[odd, worst] += np.where(off[odd, worst] >= 0, 1.0, -1.0)
    return near


def decode(x: np.ndarray) -> np.ndarray:
    """The nearest E8 point of each row."""
    a, b = _even(x), _even(x - 0.5) + 0.5
    return np.where((((x - a) ** 2).sum(1) <= ((x - b) ** 2).sum(1))[:, None], a, b)


def probe(x: np.ndarray, point: np.ndarray) -> np.ndarray:
    """The next nearest E8 point, one of the 240 around ``point``."""
    return point + ROOTS[((x - point) @ ROOTS.T).argmax(1)]


def cells(vectors: np.ndarray, labels: np.ndarray, tables: int = TABLES) -> np.ndarray:
    """Keys of the rows' cells, as an array of rows by cells."""
    dim = vectors.shape[1]
    rng = np.random.default_rng([SEED, dim])
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    mark = labels.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    out = []
    for _ in range(tables):
        sides = []
        for _ in range(BLOCKS):
            x = unit @ rng.normal(size=(dim, 8)) / SCALE
            mix = rng.integers(0, 2**63, 8, dtype=np.int64).view(np.uint64) | np.uint64(1)
            near = decode(x)
            sides.append([(np.rint(2 * p).astype(np.int64).view(np.uint64) * mix).sum(1) for p in (near, probe(x, near))])
        salt = rng.integers(0, 2**63, dtype=np.int64).view(np.uint64)
        for choice in itertools.product(*sides):
            key = sum(choice) + mark + salt
            out.append((key ^ (key >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9))
    return np.stack(out, 1).view(np.int64)


def _keyed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 2000):
            part = batch.slice(at, 2000)
            ids, labels = part.column(0).to_numpy(), part.column(1).to_numpy()
            rows = [np.frombuffer(v.as_buffer(), np.float64) for v in part.column(2)]
            dims = np.array([len(r) for r in rows])
            for d in np.unique(dims):
                at_d = np.flatnonzero(dims == d)
                keys = cells(np.stack([rows[i] for i in at_d]), labels[at_d])
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(np.repeat(ids[at_d], keys.shape[1]))], names=["key", "id"])


def _shared(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of sorted (key, id) rows, those whose key another row has; the first and last row may have theirs in another range and stay."""
    last: tuple[int, int] | None = None
    match = True
    for batch in batches:
        keys, ids = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        if not len(keys):
            continue
        if last is not None:
            keys, ids = np.concatenate([[last[0]], keys]), np.concatenate([[last[1]], ids])
        same = keys[1:] == keys[:-1]
        keep = np.concatenate([[match], same]) | np.concatenate([same, [False]])
        # The last row waits for what follows it; that it has been matched already is remembered.
        yield pa.RecordBatch.from_arrays([pa.array(keys[:-1][keep[:-1]]), pa.array(ids[:-1][keep[:-1]])], names=["key", "id"])
        last, match = (int(keys[-1]), int(ids[-1])), bool(keep[-1])
    if last is not None:
        yield pa.RecordBatch.from_arrays([pa.array([last[0]], pa.int64()), pa.array([last[1]], pa.int64())], names=["key", "id"])


def _matrix(payload) -> np.ndarray:
    rows = [np.frombuffer(v.as_buffer(), np.float64) for v in payload]
    dim = len(rows[0])
    x = np.stack([r if len(r) == dim else np.zeros(dim) for r in rows])  # another dimension can share a key by chance alone
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)


def _linker(cosine: float):
    def link(ids, payload):
        x = _matrix(payload)
        return spread(ids, lambda i, others: x[others] @ x[i] >= cosine)

    return link


def _counter(cosine: float):
    """Sums of linked weights, for rows (key, side, id, weight, payload) sorted by key; a key has one side or two."""

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        side, ids, weight = (batch.column(i).to_numpy() for i in (1, 2, 3))
        x = _matrix(batch.column(4))
        first = side == side.min()
        if first.all():
            near = x @ x.T >= cosine
            np.fill_diagonal(near, False)
            n = near @ weight
        else:
            near = x[first] @ x[~first].T >= cosine
            n = np.empty(len(ids), np.int64)
            n[first], n[~first] = near @ weight[~first], near.T @ weight[first]
        return pa.RecordBatch.from_arrays([pa.array(ids), pa.array(n, pa.int64())], names=["id", "n"])

    def run(batches):
        held = None
        for batch in batches:
            whole = batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            keys = whole.column(0).to_numpy()
            if not len(keys):
                continue
            at = [0, *(np.flatnonzero(np.diff(keys)) + 1).tolist(), len(keys)]
            for s, e in itertools.pairwise(at[:-1]):
                yield count(whole.slice(s, e - s))
            held = whole.slice(at[-2])
        if held is not None and held.num_rows:
            yield count(held)

    return run


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, label: str = "label") -> DataFrame:
    """Every row's vec_id, n_links, component_id and kept.

    Vectors link at a cosine of ``cosine`` or more if their labels are equal
    and not null and their dimensions are equal. Null and zero vectors, and
    those with null or non-finite components, link with nothing, nor does a
    row without a vec_id. Repeated rows are vectors of their own that link
    with each other. component_id is the smallest vec_id reachable; kept says
    that it is the row's own. Extra columns are ignored.
    """
    fit = F.forall("e", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists("e", lambda v: v != 0)
    source = vectors.select("vec_id", F.col(label).cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("e"))
    marked = source.withColumn("id", F.when(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(fit, F.lit(False)), F.xxhash64("label", "e")))
    kinds = marked.filter("id is not null").groupBy("id").agg(F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("n"), F.first("label").alias("label"), F.first("e").alias("e"))

    @F.pandas_udf("binary")
    def packed(e):
        return e.map(lambda v: np.asarray(v, np.float64).tobytes())

    classes = cut(kinds.withColumn("payload", packed("e")).drop("e"))
    keyed = classes.select("id", "label", "payload").mapInArrow(_keyed, "key long, id long")
    shared = keyed.repartitionByRange("key", "id").sortWithinPartitions("key").mapInArrow(_shared, "key long, id long")
    members = shared.join(classes.select("id", "payload"), "id").select("key", "id", "payload")
    parts = cut(connected_components(links(members, _linker(cosine))).withColumnRenamed("node", "id"))
    whole = cut(parts.join(classes.select("id", "first"), "id").groupBy("component").agg(F.min("first").alias("low"), F.count(F.lit(1)).alias("size")))
    named = hot_join(parts, whole.withColumn("blocks", F.ceil(F.col("size") / SIDE).cast("long")), "component", "size")
    inside = named.join(classes.select("id", "n", "payload"), "id").withColumn("i", F.pmod(F.xxhash64("id"), "blocks"))
    against = inside.withColumn("j", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    pairs = against.select(F.xxhash64("component", F.least("i", "j"), F.greatest("i", "j")).alias("key"), F.col("i").alias("side"), "id", F.col("n").alias("weight"), "payload")
    counted = pairs.repartition("key").sortWithinPartitions("key").mapInArrow(_counter(cosine), "id long, n long").groupBy("id").agg(F.sum("n").alias("links"))
    linked = named.select("id", "low").join(counted, "id", "left")
    of = cut(classes.join(linked, "id", "left").select("id", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("low", "first").alias("component_id"), "n"))
    joined = hot_join(marked.filter("id is not null").select("vec_id", "id"), of, "id", "n").select("vec_id", "n_links", "component_id")
    alone = marked.filter("id is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return joined.unionByName(alone).select("vec_id", "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))


def op3_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))


ORACLE = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.98
), r AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a
), c AS (SELECT a AS vec_id, min(b) AS component_id FROM r GROUP BY a), n AS (SELECT a AS vec_id, count(*) AS n_links FROM l GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept FROM c LEFT JOIN n USING (vec_id)
"""
