r"""Cross-tokenizer alignment: which tokens of two tokenizers stand for the same bytes, and how often in a corpus.

Both tokenizers split one line of bytes. Where tokens of both end, the line is
cut into groups; a token of one links to each token of the other whose bytes
overlap its own. A link's pair of ids is packed into one 64-bit key.

1. Each task encodes its documents and keeps every document's distinct keys,
   with how often each occurs, packed into a few bytes a key (``aligned``).
2. Tasks count their own keys with np.unique; the partial counts are dealt by
   ranges of keys, sorted, and equal neighbours are summed, so the counts are
   sorted shards whose ranges follow one another (``pair_counts``).
3. The shards' files are sent to each executor once, which lays them end to end
   in a file that its workers map into memory; a document's keys are looked up
   with np.searchsorted (``looked_up``). No more than one row a pair of ids can
   be there, so the shards are bounded by the vocabularies, however large the corpus.

Texts are encoded once: what step 1 makes is written to the shared folder.
"""

from __future__ import annotations

import fcntl
import hashlib
import json
import os
import re
import uuid
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import zstandard
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordloom.llm.tables import map_texts, table
from recordloom.plans.lineage import checkpoint_folder, cut

VOCABULARY_A, VOCABULARY_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: A task's partial counts are given on when so many different keys, or raw ones, have come together.
HELD_KEYS = 2_000_000
_ID_BITS = 32
#: Beyond these characters versions of Unicode may differ, so the vocabulary's own library splits texts that hold any.
_BEYOND = re.compile("[^\x00-ɏ]")


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: its own where it prints, else the next from U+0100."""
    prints = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return {chr(b if b in prints else next(spare)): b for b in range(256)}


class ByteLevel:
    """Tokenizer A: a byte-level BPE in the format of the tokenizers library."""

    def __init__(self, path: str) -> None:
        self.path, self.full = path, None
        with open(path, encoding="utf-8") as f:
            told = json.load(f)
        letters = byte_letters()
        vocabulary, merges = told["model"]["vocab"], [m.split(" ") if isinstance(m, str) else m for m in told["model"]["merges"]]
        special = {t["content"] for t in told.get("added_tokens", ())}
        plain = {t: i for t, i in vocabulary.items() if t not in special}
        self.bytes = [b""] * (1 + max(chain(vocabulary.values(), (t["id"] for t in told.get("added_tokens", ())))))
        for t, i in plain.items():
            self.bytes[i] = bytes(letters[c] for c in t)
        # Ids in the order of the merges are ranks, which the faster library takes; both then give the same ids.
        pre = told.get("pre_tokenizer") or {}
        ranked = not told.get("normalizer") and pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space") and all(vocabulary.get(x + y) == 256 + k for k, (x, y) in enumerate(merges))
        if ranked:
            import tiktoken

            self.fast = tiktoken.Encoding("a", pat_str=public_tokenizers.PATTERN, mergeable_ranks={self.bytes[i]: i for i in plain.values()}, special_tokens={})
        else:
            self.fast = None

    def encode(self, text: str) -> list[int]:
        if self.fast and not _BEYOND.search(text):
            return self.fast.encode_ordinary(text)
        if self.full is None:
            os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
            from tokenizers import Tokenizer

            self.full = Tokenizer.from_file(self.path)
            self.full.encode_special_tokens = True
        return self.full.encode(text, add_special_tokens=False).ids


class Pieces:
    """Tokenizer B: a sentencepiece model, which itself puts a space before a text."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        named = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.bytes = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(named)]

    def encode(self, text: str) -> list[int]:
        return self.model.encode(text, num_threads=1)


class Aligner:
    """Groups and links of one text at a time."""

    def __init__(self, path_a: str, path_b: str) -> None:
        self.both = ByteLevel(path_a), Pieces(path_b)
        self.lengths = [np.array([len(b) for b in t.bytes], np.int64) for t in self.both]
        said = lambda n, behind: np.array([f"{i}{behind}" for i in range(n)], object)
        self.within = [said(len(t.bytes), ",") for t in self.both]
        self.ending = [said(len(t.bytes), end) for t, end in zip(self.both, "|;", strict=True)]

    def tokens(self, text: str | None) -> list[np.ndarray] | None:
        """The ids of both, or None where either's bytes aren't those of the text behind a space."""
        if not text:
            return None
        try:
            whole = b" " + text.encode()
        except UnicodeEncodeError:
            return None
        ids = [self.both[0].encode(" " + text), self.both[1].encode(text)]
        if any(b"".join(map(t.bytes.__getitem__, i)) != whole for t, i in zip(self.both, ids, strict=True)):
            return None
        return [np.array(i, np.int64) for i in ids]

    def align(self, text: str | None) -> tuple[int, int, int, int, str, np.ndarray, np.ndarray]:
        """(n_a, n_b, n_groups, n_links, groups, keys, times): distinct keys in order, and how many links have each."""
        ids = self.tokens(text)
        if ids is None:
            return 0, 0, 0, 0, "", np.empty(0, np.int64), np.empty(0, np.int64)
        ends = [n[i].cumsum() for n, i in zip(self.lengths, ids, strict=True)]
        cuts = np.intersect1d(*ends, assume_unique=True)
        groups = [np.searchsorted(cuts, e) for e in ends]
        upto = [np.searchsorted(e, cuts) + 1 for e in ends]
        before = np.concatenate(([0], upto[1][:-1])), upto[0]
        pieces = np.empty(len(ids[0]) + len(ids[1]), object)
        for i, e, g, add, within, ending in zip(ids, ends, groups, before, self.within, self.ending, strict=True):
            pieces[np.arange(len(i)) + add[g]] = np.where(e == cuts[g], ending[i], within[i])
        either = np.union1d(*ends)
        a, b = (i[np.searchsorted(e, either)] for i, e in zip(ids, ends, strict=True))
        keys, times = np.unique(a << _ID_BITS | b, return_counts=True)
        return len(ids[0]), len(ids[1]), len(cuts), len(either), "".join(pieces.tolist())[:-1], keys, times


@lru_cache(maxsize=1)
def _aligner(path_a: str | None, path_b: str | None) -> Aligner:
    """One for a worker process, for all its tasks."""
    return Aligner(path_a or public_tokenizers.path(VOCABULARY_A), path_b or public_tokenizers.path(VOCABULARY_B))


def _pack(numbers: np.ndarray) -> bytes:
    """Whole numbers with bytes of one weight side by side, compressed: most of those bytes are zero or repeat."""
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(numbers.astype("<i8").view(np.uint8).reshape(-1, 8).T).tobytes())


def _unpack(packed: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8).reshape(8, -1).T).reshape(-1).view("<i8")


def aligned(docs: DataFrame, path_a: str | None = None, path_b: str | None = None, keep: tuple[str, ...] = ("doc_id",), whole_groups: bool = True) -> DataFrame:
    """Every row with n_a, n_b, n_groups, n_links, groups, keys and times, the last two packed.

    ``groups`` says the ids of both in order, as in ``a1,a2|b1;a3|b2,b3``; with
    ``whole_groups`` false it is its SHA-256 instead. Null and empty texts, and
    those that either tokenizer changes, have no tokens: zeros and an empty
    string. Texts of any length count whole, repeated rows are each returned,
    extra columns are ignored and an empty table gives an empty one. The paths
    name files that every executor can open (default: the installed ones).
    """

    def make():
        own = _aligner(path_a, path_b)

        def one(text: str | None):
            n_a, n_b, n_groups, n_links, groups, keys, times = own.align(text)
            said = groups if whole_groups or not groups else hashlib.sha256(groups.encode()).hexdigest()
            return n_a, n_b, n_groups, n_links, said, _pack(keys), _pack(times)

        return one

    fields = [(n, T.LongType()) for n in ("n_a", "n_b", "n_groups", "n_links")] + [("groups", T.StringType()), ("keys", T.BinaryType()), ("times", T.BinaryType())]
    return map_texts(docs, make, fields, keep=keep, batch_rows=50)


def _partial(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's own counts of its documents' distinct keys."""
    raw: list[np.ndarray] = []
    keys, counts, n = np.empty(0, np.int64), np.empty(0, np.int64), 0

    def merged() -> tuple[np.ndarray, np.ndarray]:
        new, times = np.unique(np.concatenate(raw), return_counts=True) if raw else (keys[:0], counts[:0])
        every, at = np.unique(np.concatenate((keys, new)), return_inverse=True)
        summed = np.zeros(len(every), np.int64)
        np.add.at(summed, at, np.concatenate((counts, times)))
        return every, summed

    for batch in batches:
        for packed in batch.column(0):
            raw.append(_unpack(packed.as_py()))
            n += len(raw[-1])
            if n >= HELD_KEYS:
                keys, counts = merged()
                raw, n = [], 0
                if len(keys) >= HELD_KEYS:
                    yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], names=["key", "n"])
                    keys, counts = keys[:0], counts[:0]
    keys, counts = merged()
    if len(keys):
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], names=["key", "n"])


def _run_sums(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of equal neighbours among sorted rows (key, n); the last of a batch waits for the next."""
    last: tuple[int, int] | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        k, n = (batch.column(i).to_numpy() for i in (0, 1))
        if last is not None:
            k, n = np.concatenate(([last[0]], k)), np.concatenate(([last[1]], n))
        starts = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1])))
        sums = np.add.reduceat(n, starts)
        last = int(k[starts[-1]]), int(sums[-1])
        if len(starts) > 1:
            yield pa.RecordBatch.from_arrays([pa.array(k[starts[:-1]]), pa.array(sums[:-1])], names=["key", "n"])
    if last is not None:
        yield pa.RecordBatch.from_arrays([pa.array([last[0]], pa.int64()), pa.array([last[1]], pa.int64())], names=["key", "n"])


def pair_counts(links: DataFrame) -> DataFrame:
    """(key, n): in how many rows of ``links`` (a column ``keys``) each key is, in sorted partitions whose ranges follow one another."""
    partial = cut(links.select("keys").mapInArrow(_partial, "key long, n long"))
    return partial.repartitionByRange("key").sortWithinPartitions("key").mapInArrow(_run_sums, "key long, n long")


class Shards:
    """Sorted counts, mapped into memory from a file of this executor's own."""

    def __init__(self, name: str, files: list[str]) -> None:
        folder = SparkFiles.getRootDirectory()
        at = [os.path.join(folder, f"{name}.{c}") for c in ("keys", "n")]
        with open(os.path.join(folder, f"{name}.lock"), "w") as lock:
            fcntl.flock(lock, fcntl.LOCK_EX)
            if not os.path.exists(at[1]):
                with open(at[0], "wb") as keys, open(at[1] + ".part", "wb") as counts:
                    for f in files:
                        for batch in pq.ParquetFile(SparkFiles.get(f)).iter_batches(1 << 18):
                            keys.write(batch.column(0).to_numpy().tobytes())
                            counts.write(batch.column(1).to_numpy().tobytes())
                os.replace(at[1] + ".part", at[1])
        self.keys, self.n = (np.memmap(p, "<i8", "r") if os.path.getsize(p) else np.empty(0, np.int64) for p in at)

    def of(self, keys: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.keys, keys)
        if len(keys) and (at.max() >= len(self.keys) or (self.keys[at] != keys).any()):
            raise KeyError("a link that wasn't counted")
        return self.n[at]


@lru_cache(maxsize=2)
def _shards(name: str, files: tuple[str, ...]) -> Shards:
    return Shards(name, list(files))


def _sent(spark: SparkSession, folder: str) -> tuple[str, ...]:
    """Names of a written table's files, in the order of their ranges, once every executor is told to fetch them."""
    at = spark._jvm.org.apache.hadoop.fs.Path(folder)
    found = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(at)
    paths = sorted((p.getPath() for p in found), key=lambda p: p.getName())
    files = [p for p in paths if p.getName().startswith("part-")]
    for p in files:
        spark.sparkContext.addFile(p.toString())
    return tuple(p.getName() for p in files)


def looked_up(links: DataFrame, counts_at: str) -> DataFrame:
    """``links`` with n_best and count_sum in place of its packed columns, by the written counts at a folder.

    n_best counts the links whose pair is in as many documents as any pair of
    their first id; count_sum sums those numbers over all links.
    """
    spark = links.sparkSession
    counts, files = spark.read.parquet(counts_at), _sent(spark, counts_at)
    name = f"counts-{uuid.uuid5(uuid.NAMESPACE_URL, counts_at).hex}"
    # No more rows than the first vocabulary has ids.
    top = counts.groupBy(F.shiftright("key", _ID_BITS).alias("a")).agg(F.max("n").alias("n")).collect()
    best = np.zeros(1 + max((r["a"] for r in top), default=0), np.int64)
    for r in top:
        best[r["a"]] = r["n"]
    kept = [c for c in links.columns if c not in ("keys", "times")]
    schema = T.StructType([*(links.schema[c] for c in kept), T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _shards(name, files)
        for whole in batches:
            for at in range(0, whole.num_rows, 200):
                batch = whole.slice(at, 200)
                keys, times = ([_unpack(x.as_py()) for x in batch.column(batch.schema.get_field_index(c))] for c in ("keys", "times"))
                ends = np.cumsum([0, *map(len, keys)])
                k, t = np.concatenate(keys), np.concatenate(times)
                n = held.of(k)
                sums = lambda x: np.concatenate(([0], x.cumsum()))
                made = [np.diff(sums(x)[ends]) for x in (t * (n == best[k >> _ID_BITS]), t * n)]
                yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(c)) for c in kept), *map(pa.array, made)], names=schema.names)

    return links.mapInArrow(run, schema)


def with_counts(links: DataFrame, folder: str) -> DataFrame:
    """``looked_up`` by the counts of ``links`` themselves, which are read twice; both lie in ``folder``, which all executors share."""
    spark = links.sparkSession
    links.write.parquet(f"{folder}/links")
    links = spark.read.parquet(f"{folder}/links")
    pair_counts(links).write.parquet(f"{folder}/counts")
    return looked_up(links, f"{folder}/counts")


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    checkpoint_folder(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/alignment-{uuid.uuid4().hex}"
    found = with_counts(aligned(table(spark, sf_dir, "documents"), whole_groups=False), folder)
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", F.col("groups").alias("groups_sha256"))
