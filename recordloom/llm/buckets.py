"""Spanning links inside buckets that are streamed in sorted order.

Rows that share a key form a bucket. Rows are dealt by ranges of key and id, so
that a bucket of any size is spread over tasks. A task reads its buckets one
after the other and gives, for each bucket, only links that span its connected
parts: a bucket of g members yields fewer than g links, never its pairs. A
bucket beyond ``CAP`` members isn't gathered: its rows pass through unseen, and
so do those of a range's first and last bucket, which another range may go on
with. A second round compares them block by block, each pair of blocks a bucket
of its own, so the whole bucket is compared, by as many tasks as it has pairs
of blocks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordloom.operators.joins import small
from recordloom.plans.lineage import cut

#: Members that a task holds at a time.
CAP = 65_536

#: Given the members' ids and payloads (or None), the linked members as two arrays of ids.
Linker = Callable[[np.ndarray, "pa.Array | None"], tuple[np.ndarray, np.ndarray]]


def spread(ids: np.ndarray, near: Callable[[int, np.ndarray], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Links that span the parts of a bucket.

    ``near(i, others)`` says which positions ``others`` link with position i.
    A part's links all lead to its smallest id. Members that a part has claimed
    aren't compared with each other, so a bucket of near copies takes about one
    pass.
    """
    left, a, b = np.argsort(ids, kind="stable"), [], []
    while len(left) > 1:
        start, left = left[0], left[1:]
        wait = [start]
        while wait and len(left):
            hit = near(wait.pop(), left)
            if hit.any():
                new = left[hit]
                left = left[~hit]
                wait.extend(new.tolist())
                a.append(np.full(len(new), ids[start]))
                b.append(ids[new])
    none = np.empty(0, np.int64)
    return (np.concatenate(a), np.concatenate(b)) if a else (none, none)


def _stream(linker: Linker, cap: float, payload: bool, ranged: bool = False):
    """Reads buckets in order; ``ranged`` passes on the first and the last one, which may be parts of larger ones."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("key", pa.int64()), *([("payload", pa.binary())] if payload else [])])

    def out(a, b=None, key=None, load=None) -> pa.RecordBatch:
        n = len(a)
        cols = [pa.array(a, pa.int64()), pa.nulls(n, pa.int64()) if b is None else pa.array(b, pa.int64()), pa.nulls(n, pa.int64()) if key is None else pa.array(key, pa.int64())]
        if payload:
            cols.append(pa.nulls(n, pa.binary()) if load is None else load)
        return pa.RecordBatch.from_arrays(cols, schema=schema)

    def pick(load, at: slice):
        return None if load is None else load.slice(at.start, at.stop - at.start)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None  # of the bucket that the last batch ended in
        hot, begun = None, not ranged
        for batch in _and_end(batches):
            if batch is None:
                keys, ids, load = np.empty(0, np.int64), np.empty(0, np.int64), None
            else:
                keys, ids = batch.column(0).to_numpy(), batch.column(1).to_numpy()
                load = _flat(batch.column(2)) if payload else None
                if not len(keys):
                    continue
            if not begun and len(keys):
                hot, begun = int(keys[0]), True
            if hot is not None and len(keys):
                n = int(np.searchsorted(keys, hot, "right"))
                if n:
                    yield out(ids[:n], key=keys[:n], load=pick(load, slice(0, n)))
                keys, ids, load = keys[n:], ids[n:], pick(load, slice(n, len(ids)))
                if not len(keys):
                    continue
                hot = None
            if held is not None:
                keys, ids = np.concatenate([held[0], keys]), np.concatenate([held[1], ids])
                load = (held[2] if load is None else pa.concat_arrays([held[2], load])) if payload else None
                held = None
            if not len(keys):
                break
            cuts = np.flatnonzero(np.diff(keys)) + 1
            starts, ends = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(keys)]])
            if batch is not None:
                last = slice(int(starts[-1]), int(ends[-1]))
                starts, ends = starts[:-1], ends[:-1]
                if last.stop - last.start > cap:
                    hot = int(keys[last.start])
                    yield out(ids[last], key=keys[last], load=pick(load, last))
                else:
                    held = keys[last], ids[last], pick(load, last)
            elif ranged:
                yield out(ids, key=keys, load=load)
                break
            a, b = [], []
            for s, e in zip(*((x[ends - starts > 1]).tolist() for x in (starts, ends)), strict=True):
                if e - s > cap:
                    yield out(ids[s:e], key=keys[s:e], load=pick(load, slice(s, e)))
                    continue
                x, y = linker(ids[s:e], pick(load, slice(s, e)))
                if len(x):
                    a.append(x)
                    b.append(y)
            if a:
                yield out(np.concatenate(a), np.concatenate(b))

    return run


def _and_end(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def _flat(column: pa.Array) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def links(members: DataFrame, linker: Linker, cap: int = CAP) -> DataFrame:
    """Rows (a, b) of linked ids, for members (key long, id long[, payload binary]).

    Together with other buckets' links they span every connected part; they
    aren't all pairs. Keys and ids aren't null. No members: no rows.
    """
    payload = "payload" in members.columns
    names = ["key", "id", *(["payload"] if payload else [])]
    schema = "a long, b long, key long" + ", payload binary" * payload
    near = lambda m: m.select(*names).sortWithinPartitions("key")
    first = cut(near(members.repartitionByRange("key", "id")).mapInArrow(_stream(linker, cap, payload, True), schema))
    found = first.filter("key is null").select("a", "b")
    hot = first.filter("key is not null")
    many = cut(hot.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("key", F.ceil(F.col("n") * 2 / cap).cast("long").alias("blocks")))
    if many.isEmpty():
        return found
    mine = hot.join(small(many), "key").withColumn("i", F.pmod(F.xxhash64("a"), "blocks"))
    pairs = mine.withColumn("j", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    again = pairs.select(
        F.xxhash64("key", F.least("i", "j"), F.greatest("i", "j")).alias("key"),
        F.col("a").alias("id"), *(["payload"] if payload else []),
    )
    rest = near(again.repartition("key")).mapInArrow(_stream(linker, float("inf"), payload), schema)
    return found.unionByName(cut(rest.select("a", "b")))
