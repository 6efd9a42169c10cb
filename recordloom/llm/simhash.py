"""SimHash near-duplicates through a byte-position inverted index.

A fingerprint has eight bytes. Two that differ in at most four bits agree in at
least four of the eight byte positions: the guaranteed minimum. A list of one
positional byte would hold 1/256 of all fingerprints, so its pairs grow with the
square of the corpus. The index is therefore posted by the lists' intersections:
each distinct fingerprint stands under all 70 choices of four (position, byte)
entries, and a list of 32 bits stays short. Within a list the positional bytes
that a pair shares are tallied, pairs that reach the minimum are retained, and
those are verified by their differing bits. No pair below the minimum meets, and
none that reaches it is missed.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordloom.llm.buckets import links, spread
from recordloom.llm.tables import map_texts, table
from recordloom.operators.graph import connected_components
from recordloom.operators.joins import hot_join
from recordloom.plans.lineage import cut

WORDS, BITS, SEED = 4, 4, 42
#: Shingles hashed at a time.
BLOCK = 20_000


def fingerprint(text: str | None, words: int = WORDS, seed: int = SEED) -> int:
    """The 64-bit fingerprint of a whole text, as a signed number; 0 without words."""
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    n = max(1, len(w) - words + 1)
    counts = np.zeros(64, np.int64)
    digest = xxhash.xxh64_digest
    for at in range(0, n, BLOCK):
        part = w[at:at + BLOCK + words - 1]
        shingles = zip(*(part[i:] for i in range(words)), strict=False) if len(w) >= words else [part]
        bits = np.frombuffer(b"".join([digest(b" ".join(s), seed) for s in shingles]), np.uint8)
        counts += np.unpackbits(bits).reshape(-1, 64).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > n).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, words: int = WORDS, seed: int = SEED) -> DataFrame:
    """Every row's doc_id and ``fp`` (long)."""

    def make():
        return lambda text: (fingerprint(text, words, seed),)

    return map_texts(docs, make, [("fp", T.LongType())])


def _postings(bits: int):
    """Rows (key, id) of the index, for batches of distinct fingerprints.

    At most ``bits`` differing bytes leave 8 - ``bits`` equal; every choice of
    so many positions is one family of keys.
    """
    families = list(combinations(range(8), 8 - bits))
    seen = np.array([sum(255 << 8 * p for p in f) for f in families], np.uint64)
    salt = np.array([(i * 0x9E3779B97F4A7C15) % 2**64 for i in range(1, len(families) + 1)], np.uint64)

    def run(batches):
        for batch in batches:
            f = batch.column(0).to_numpy().view(np.uint64)
            for at in range(0, len(f), 4000):
                part = f[at:at + 4000]
                key = (part[:, None] & seen) ^ salt
                # One-to-one in the kept bytes within a family; families are told apart by their salt.
                key = (key ^ (key >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.ravel().view(np.int64)), pa.array(np.repeat(part, len(families)).view(np.int64))], names=["key", "id"]
                )

    return run


def shared_bytes(one: np.uint64, others: np.ndarray) -> np.ndarray:
    """The tally: in how many of the eight positions each of ``others`` has the same byte as ``one``."""
    return (np.ascontiguousarray(one ^ others).view(np.uint8).reshape(-1, 8) == 0).sum(1)


def _linker(bits: int):
    def link(ids: np.ndarray, _) -> tuple[np.ndarray, np.ndarray]:
        f = ids.view(np.uint64)
        if len(f) == 2:
            # The most frequent list by far; more than ``bits`` differing bytes are more than ``bits`` differing bits.
            return (ids[:1], ids[1:]) if int(f[0] ^ f[1]).bit_count() <= bits else (ids[:0], ids[:0])

        def near(i: int, others: np.ndarray) -> np.ndarray:
            retained = shared_bytes(f[i], f[others]) >= 8 - bits
            retained[retained] = np.bitwise_count(f[others[retained]] ^ f[i]) <= bits
            return retained

        return spread(ids, near)

    return link


def near_duplicates(docs: DataFrame, bits: int = BITS, words: int = WORDS, seed: int = SEED) -> DataFrame:
    """Every row's doc_id, fingerprint (16 hex digits) and component_id.

    Fingerprints link at ``bits`` or fewer differing bits (at most 6);
    component_id is the smallest doc_id reachable. A null or wordless text has
    fingerprint zero and links like any other. Equal fingerprints are one
    class, so exact copies cost one row in the index. Repeated rows are each
    returned; a null doc_id is never a component's smallest unless all are
    null. Texts of any length count whole, an empty table gives an empty one,
    and extra columns are ignored.
    """
    fps = cut(fingerprints(docs, words, seed))
    classes = fps.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n"))
    posted = classes.select("fp").mapInArrow(_postings(bits), "key long, id long")
    parts = cut(connected_components(links(posted, _linker(bits))))
    named = parts.join(classes, parts["node"] == classes["fp"]).select("component", "first")
    low = cut(named.groupBy("component").agg(F.min("first").alias("low"), F.count(F.lit(1)).alias("size")))
    lowest = hot_join(parts, low, "component", "size").select(F.col("node").alias("fp"), "low")
    of = cut(classes.join(lowest, "fp", "left").select("fp", F.coalesce("low", "first").alias("component_id"), "n"))
    # Fingerprints that many rows hold, and components of many, are joined where they stand.
    return hot_join(fps, of, "fp", "n").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
