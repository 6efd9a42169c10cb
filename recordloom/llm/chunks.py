"""Substring dedup by content-defined chunks of a gear rolling hash, held against each other window by window.

A repeated passage is ``WORDS`` words or more that stand byte by byte in another
document too. A gear hash rolls over the words: each step shifts it and adds the
next word's number, so that it depends on the last words alone. Each window of
so many words takes as its seed the smallest gear value within it, the last of
equal ones, and windows in a row that take one seed are a chunk: chunks vary in
length, begin and end where the content says, and an insertion shifts none but
those around it. What a window takes depends on its own bytes alone, so a window
that two documents share lies in chunks of one seed in both, whatever stands
around it and however periodic it is: no passage is missed.

Chunks are deduplicated by seed and digest, 128 bits together. Seeds that only
one document holds drop out. Where all holders of a seed hold the same chunk,
its windows are shared; else the windows of the differing chunks are compared by
digest, once a chunk, so that a passage ends where it truly does.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recordloom.llm.tables import table
from recordloom.plans.lineage import cut

WORDS = 51
_MIX = np.random.default_rng(20_240_301).integers(0, 2**64, 256, dtype=np.uint64)
_BASE = 0xD6E8FEB86659FD93
_POWERS = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def gear(symbols: np.ndarray, reach: int) -> np.ndarray:
    """The rolling hash at each word: every step shifts it by 64 / ``reach`` bits, so it holds the last ``reach`` words (a power of two)."""
    h, step = symbols, 1
    while step < reach:
        older = h[:-step] << np.uint64(64 // reach * step)
        h = h.copy()
        h[step:] += older
        step *= 2
    return h


def gram(words: int) -> int:
    """The length of a seed in words: at most a third of the passage's, so that few seeds are taken and few of them meet by chance."""
    return 1 << max(1, words // 3).bit_length() - 1


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the hash's base and of its inverse."""
    global _POWERS
    if len(_POWERS[0]) < n:
        size = 1 << (n - 1).bit_length()
        inverse = pow(_BASE, -1, 2**64)
        _POWERS = tuple(np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(size - 1, v, np.uint64))]) for v in (_BASE, inverse))
    return _POWERS[0][:n], _POWERS[1][:n]


def units(data: np.ndarray, words: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first, last, seed, starts, stops): runs of windows that take the same seed.

    Window i holds the words i to i + words - 1; ``starts`` and ``stops`` are the
    words' bounds in bytes. Unit j is the windows first[j] to last[j].
    """
    space = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.diff(np.concatenate([[True], space, [True]]).astype(np.int8))
    starts, stops = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    n = len(starts) - words + 1
    if n < 1:
        none = np.empty(0, np.int64)
        return none, none, np.empty(0, np.uint64), starts, stops
    up, down = _powers(len(data))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_MIX[data] * up)])
    k = gram(words)
    word = (sums[stops] - sums[starts]) * down[starts]
    word = (word ^ (word >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    g = gear(word ^ (word >> np.uint64(32)), k)[k - 1:]
    g = (g ^ (g >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    g ^= g >> np.uint64(32)
    # The smallest of the words - k + 1 values from each on, the last of equal ones.
    low, at, width = g, np.arange(len(g)), 1
    while width < words - k + 1:
        step = min(width, words - k + 1 - width)
        later = low[step:] <= low[:-step]
        low, at = np.where(later, low[step:], low[:-step]), np.where(later, at[step:], at[:-step])
        width += step
    fresh = np.flatnonzero(at[1:] != at[:-1]) + 1
    first, last = np.concatenate([[0], fresh]), np.concatenate([fresh, [n]]) - 1
    return first, last, g[at[first]], starts, stops


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).filter("doc_id IS NOT NULL AND length(text) > 0")


def unit_rows(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """Rows (doc_id, start, end, word, n, seed, digest) of each text's units: bytes, first word and number of words."""
    source = _texts(docs)
    kind = source.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            made, held = [], 0
            for i, text in enumerate(batch.column(1)):
                raw = text.as_buffer()
                first, last, seed, starts, stops = units(np.frombuffer(raw, np.uint8), words)
                s, e = starts[first], stops[last + words - 1]
                view, hashed = memoryview(raw), xxhash.xxh3_64_intdigest
                digest = np.fromiter((hashed(view[a:b]) for a, b in zip(s.tolist(), e.tolist(), strict=True)), np.uint64, len(s))
                made.append((np.full(len(s), i), s, e, first, last - first + words, seed, digest))
                held += len(s)
                if held > 100_000 or i == batch.num_rows - 1:
                    ids, *spans, seeds, digests = (np.concatenate(c) for c in zip(*made, strict=True))
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array(ids)), *(pa.array(c, pa.int32()) for c in spans), pa.array(seeds.view(np.int64)), pa.array(digests.view(np.int64))],
                        names=["doc_id", "start", "end", "word", "n", "seed", "digest"],
                    )
                    made, held = [], 0

    return source.mapInArrow(run, f"doc_id {kind}, start int, end int, word int, n int, seed long, digest long")


def window_rows(docs: DataFrame, wanted: DataFrame, words: int = WORDS) -> DataFrame:
    """Rows (seed, digest, first, last, start, end, word, window) of the windows of the chunks that ``wanted`` (doc_id, units) names.

    ``units`` holds (seed, digest, last) of chunks that the document is the first
    to hold; start, end and word count from the chunk's start.
    """
    source = _texts(docs).join(wanted, "doc_id").select("doc_id", "text", F.col("units.seed").alias("seeds"), F.col("units.digest").alias("digests"), F.col("units.last").alias("lasts"))
    kind = source.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for whole in batches:
            for batch in (whole.slice(at, 100) for at in range(0, whole.num_rows, 100)):
                from_row, lasts, made = [], [], []
                offset = 0
                for i in range(batch.num_rows):
                    raw = batch.column(1)[i].as_buffer()
                    names = list(zip(batch.column(2)[i].as_py(), batch.column(3)[i].as_py(), strict=True))
                    place = {d: offset + j for j, d in enumerate(names)}
                    offset += len(names)
                    lasts.append(batch.column(4)[i].values)
                    first, last, seed, starts, stops = units(np.frombuffer(raw, np.uint8), words)
                    view, hashed = memoryview(raw), xxhash.xxh3_64_intdigest
                    for a, b, sown in zip(first.tolist(), last.tolist(), seed.view(np.int64).tolist(), strict=True):
                        s = int(starts[a])
                        digest = _signed(hashed(view[s:int(stops[b + words - 1])]))
                        where = place.pop((sown, digest), None)
                        if where is None:
                            continue
                        for w in range(a, b + 1):
                            x, y = int(starts[w]), int(stops[w + words - 1])
                            from_row.append((i, where))
                            made.append((sown, digest, x - s, y - s, w - a, _signed(hashed(view[x:y]))))
                if made:
                    sown, digest, start, end, word, window = zip(*made, strict=True)
                    row, where = zip(*from_row, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(sown, pa.int64()), pa.array(digest, pa.int64()), batch.column(0).take(pa.array(row)), pa.concat_arrays(lasts).take(pa.array(where)), pa.array(start, pa.int32()), pa.array(end, pa.int32()), pa.array(word, pa.int32()), pa.array(window, pa.int64())],
                        names=["seed", "digest", "first", "last", "start", "end", "word", "window"],
                    )

    return source.mapInArrow(run, f"seed long, digest long, first {kind}, last {kind}, start int, end int, word int, window long")


def _signed(h: int) -> int:
    return h - 2**64 if h >= 2**63 else h


def repeated_spans(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """Rows (doc_id, start, end, words, first_doc_id, kept, drop) of passages that repeat across documents.

    A span is a longest run of overlapping windows of ``words`` words each of
    which stands in another document too, so it begins and ends with the first
    and last whole word that do; offsets are UTF-8 bytes. first_doc_id is the
    smallest doc_id that holds one of its windows. ``drop`` (an array of start
    and end) is what windows cover that a smaller doc_id holds; ``kept`` says
    that there is none. Of every word of a passage one copy stays: what a
    document drops stands in a smaller one, and the smallest drops nothing.

    Texts repeated under one doc_id count as one document, and rows without a
    doc_id, which no other can name, have no spans; nor have null and empty
    texts, texts of fewer words, and an empty table. Texts are read whole,
    however long. Extra columns are ignored.
    """
    # Nothing below counts rows, so what texts under one doc_id repeat needs no distinct.
    every = unit_rows(docs, words)
    seeds = cut(every.groupBy("seed").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), (F.min("digest") < F.max("digest")).alias("several")).filter("lo < hi").select("seed", "lo", "several"))
    hit = cut(every.join(seeds, "seed").select("doc_id", "start", "end", "word", "n", "seed", "digest", "lo", "several"))
    # All that hold the seed hold it in the same chunk: every window of it is shared.
    whole = hit.filter("not several").select("doc_id", "start", "end", "word", "n", F.col("lo").alias("first"))
    # Else the first holder of each chunk shows its windows, to be compared with those of other chunks.
    holders = hit.filter("several").groupBy("seed", "digest").agg(F.min("doc_id").alias("doc_id"), F.max("doc_id").alias("last"))
    windows = cut(window_rows(docs, holders.groupBy("doc_id").agg(F.collect_list(F.struct("seed", "digest", "last")).alias("units")), words))
    shared = cut(windows.groupBy("seed", "window").agg(F.min("first").alias("lo"), F.max("last").alias("hi")).filter("lo < hi").select("seed", "window", "lo"))
    # A chunk's windows all hold its seed and so overlap: those of one first holder make one stretch.
    part = cut(windows.join(shared, ["seed", "window"]).groupBy("seed", "digest", F.col("lo").alias("first")).agg(F.min("start").alias("from"), F.max("end").alias("to"), F.min("word").alias("skip"), (F.max("word") + words).alias("until")))
    parts = hit.filter("several").join(part, ["seed", "digest"]).select("doc_id", (F.col("start") + F.col("from")).alias("start"), (F.col("start") + F.col("to")).alias("end"), (F.col("word") + F.col("skip")).alias("word"), (F.col("until") - F.col("skip")).alias("n"), "first")
    order = Window.partitionBy("doc_id").orderBy("start", "end")
    before, upto = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(Window.unboundedPreceding, 0)
    other = F.col("first") != F.col("doc_id")
    marked = whole.unionByName(parts).withColumn("other", other)
    marked = marked.withColumn("fresh", F.coalesce((F.max("end").over(before) < F.col("start")).cast("int"), F.lit(1)))
    marked = marked.withColumn("cut", F.when(F.col("other"), F.coalesce((F.max(F.when(F.col("other"), F.col("end"))).over(before) < F.col("start")).cast("int"), F.lit(1))).otherwise(0))
    runs = marked.withColumn("run", F.sum("fresh").over(upto)).withColumn("piece", F.sum("cut").over(upto))
    pieces = runs.groupBy("doc_id", "run", "piece", "other").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.min("word").alias("word"), F.max(F.col("word") + F.col("n")).alias("until"), F.min("first").alias("first"))
    spans = pieces.groupBy("doc_id", "run").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), (F.max("until") - F.min("word")).cast("long").alias("words"), F.min("first").alias("first_doc_id"),
        F.array_sort(F.collect_list(F.when(F.col("other"), F.struct("start", "end")))).alias("drop"),
    )
    return spans.select("doc_id", "start", "end", "words", "first_doc_id", (F.size("drop") == 0).alias("kept"), "drop")


def by_document(spans: DataFrame) -> DataFrame:
    """One row per document with spans: their number, words and bytes, the spans to drop, and the documents that came first."""
    return spans.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n_spans"), F.sum("words").alias("n_words"), F.sum(F.col("end") - F.col("start")).cast("long").alias("n_bytes"),
        F.sum(F.aggregate("drop", F.lit(0).cast("long"), lambda acc, x: acc + x["end"] - x["start"])).alias("n_bytes_dropped"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "end"))), lambda x: F.concat_ws(":", x["start"], x["end"])), ",").alias("spans"),
        F.array_sort(F.collect_set("first_doc_id")).alias("first_doc_ids"),
    )


def deduplicate(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """``docs`` with every repeated passage cut from all texts but the first that holds it.

    Columns stay as they are; other rows' texts are untouched. A document's own
    part of a passage stays where only the rest came first elsewhere.
    """
    drop = repeated_spans(docs, words).filter("not kept").groupBy(F.col("doc_id").alias("__doc")).agg(F.array_sort(F.flatten(F.collect_list("drop"))).alias("__drop"))

    @F.pandas_udf("string")
    def without(text, spans):
        def one(t, s):
            if t is None or s is None:
                return t
            raw, out, at = t.encode(), [], 0
            for x in s:
                out.append(raw[at:x["start"]])
                at = x["end"]
            return b"".join([*out, raw[at:]]).decode("utf-8", "ignore")

        return text.combine(spans, one)

    named = docs.columns
    return docs.join(drop, F.col("doc_id") == F.col("__doc"), "left").withColumn("text", without("text", "__drop")).select(*named)


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return by_document(repeated_spans(table(spark, sf_dir, "documents")))
