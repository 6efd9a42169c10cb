"""Byte-level BPE encoding and decoding by a hierarchical-bitmap rank queue.

A pre-token's adjacent pairs wait in one bucket per merge rank. Two levels of
bitmaps say which buckets hold anything, and find-first-set gives the lowest
rank, so a pre-token of n bytes takes n merges of near-constant cost whatever
its length. Buckets hold positions of a linked list, leftmost first; an entry
whose pair has changed since is stale and is skipped when it comes up.
"""

from __future__ import annotations

import base64
import hashlib
import re
from functools import lru_cache
from heapq import heappop, heappush
from itertools import chain, islice

import public_tokenizers
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordloom.llm.tables import map_texts, table

VOCABULARY = "byte_bpe_50k.tiktoken"
#: Pre-tokens up to this length are remembered: the last so many, and as many before them.
CACHED_CHARS, CACHED_PIECES = 48, 300_000
#: Pre-tokens handled at a time, so that a text of any length needs little memory.
BLOCK = 100_000
_WORD = 256


def merge(piece: bytes, ranks: dict[bytes, int]) -> tuple[int, ...]:
    """Ids of one pre-token: always the lowest rank next, leftmost first."""
    whole = ranks.get(piece)
    if whole is not None:
        return (whole,)
    n = len(piece)
    if n < 2:
        return tuple(ranks[piece[i:i + 1]] for i in range(n))
    end = list(range(1, n + 1))
    after, before = end.copy(), list(range(-1, n - 1))
    get = ranks.get
    pair = [get(piece[i:i + 2], -1) for i in range(n - 1)]
    pair.append(-1)
    buckets: dict[int, list[int]] = {}
    words = [0] * (len(ranks) // _WORD + 1)
    summary = 0
    for i, r in enumerate(pair):
        if r >= 0:
            if r in buckets:
                buckets[r].append(i)
            else:
                buckets[r] = [i]
                w = r // _WORD
                words[w] |= 1 << r % _WORD
                summary |= 1 << w
    while summary:
        w = (summary & -summary).bit_length() - 1
        bits = words[w]
        r = w * _WORD + (bits & -bits).bit_length() - 1
        bucket = buckets[r]
        at = heappop(bucket)
        if not bucket:
            del buckets[r]
            words[w] = bits = bits & (bits - 1)
            if not bits:
                summary &= summary - 1
        if pair[at] != r:
            continue
        gone = after[at]
        end[at], after[at], pair[gone] = end[gone], after[gone], -1
        if after[at] < n:
            before[after[at]] = at
        for left in (before[at], at):
            if left < 0:
                continue
            right = after[left]
            new = get(piece[left:end[right]], -1) if right < n else -1
            if new == pair[left]:
                continue
            pair[left] = new
            if new >= 0:
                if new in buckets:
                    heappush(buckets[new], left)
                else:
                    buckets[new] = [left]
                    w = new // _WORD
                    words[w] |= 1 << new % _WORD
                    summary |= 1 << w
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i:end[i]]])
        i = after[i]
    return tuple(out)


@lru_cache(maxsize=2)
def vocabulary(path: str) -> tuple[dict[bytes, int], list[bytes]]:
    """Ranks by bytes, and bytes by rank."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    by_rank = [b""] * (max(ranks.values()) + 1)
    for piece, r in ranks.items():
        by_rank[r] = piece
    return ranks, by_rank


#: The letters and numbers below U+0250; the standard matcher splits texts of these alone as the full pattern would.
_LETTERS, _NUMBERS, _SPACES = "A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f", "0-9\u00b2\u00b3\u00b9\u00bc-\u00be", "\t-\r\x20\x85\xa0"
_BEYOND = re.compile("[^\x00-\u024f]")
_LATIN = re.compile(
    f" ?[{_LETTERS}]+|'s|'t|'re|'ve|'m|'ll|'d| ?[{_NUMBERS}]+| ?[^{_SPACES}{_LETTERS}{_NUMBERS}]+|[{_SPACES}]+(?![^{_SPACES}])|[{_SPACES}]+"
)


class Codec:
    """Encoder and decoder for one rank file and one splitting pattern."""

    def __init__(self, path: str, pattern: str) -> None:
        self.ranks, self.by_rank = vocabulary(path)
        self.split = regex.compile(pattern)
        self.latin = pattern == public_tokenizers.PATTERN
        self.known: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}

    def _piece(self, piece: str) -> tuple[int, ...]:
        ids = self.older.get(piece) or merge(piece.encode(), self.ranks)
        if len(piece) <= CACHED_CHARS:
            if len(self.known) >= CACHED_PIECES:
                self.older, self.known = self.known, {}
            self.known[piece] = ids
        return ids

    def blocks(self, text: str):
        """The ids of a text, a block of pre-tokens at a time."""
        split = _LATIN if self.latin and not _BEYOND.search(text) else self.split
        pieces = (m[0] for m in split.finditer(text)) if len(text) > 1_000_000 else iter(split.findall(text))
        make = self._piece
        while block := list(islice(pieces, BLOCK)):
            known = self.known.get
            yield list(chain.from_iterable([known(p) or make(p) for p in block]))

    def encode(self, text: str | None) -> list[int]:
        return list(chain.from_iterable(self.blocks(text or "")))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.by_rank.__getitem__, ids))


@lru_cache(maxsize=2)
def _codec(path: str | None, pattern: str | None) -> Codec:
    """One for a worker process, so that its memory serves the tasks that follow."""
    return Codec(path or public_tokenizers.path(VOCABULARY), pattern or public_tokenizers.PATTERN)


def encode(docs: DataFrame, path: str | None = None, pattern: str | None = None, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Every row with ``ids`` (array of int): its whole text's tokens.

    A null or empty text has no ids. ``path`` names a rank file that every
    executor can open (default: the installed one).
    """

    def make():
        codec = _codec(path, pattern)
        return lambda text: (codec.encode(text),)

    return map_texts(docs, make, [("ids", T.ArrayType(T.IntegerType()))], keep=keep, batch_rows=50)


def decode(encoded: DataFrame, path: str | None = None, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Every row of ``ids`` with ``bytes``, what they stand for; null ids stand for nothing."""

    @F.pandas_udf(T.BinaryType())
    def back(ids):
        codec = _codec(path, None)
        return ids.map(lambda x: b"" if x is None else codec.decode(x))

    return encoded.select(*keep, back("ids").alias("bytes"))


def digests(docs: DataFrame, path: str | None = None, pattern: str | None = None, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Encode, decode the ids again, and describe both by digests.

    Adds n_tokens, ids_sha256 (of decimal ids joined by one space) and
    decoded_sha256 (of the decoded bytes). Null counts as empty. Rows that
    repeat are each returned; an empty table gives an empty one, texts of any
    length count whole, and extra columns are ignored.
    """

    def make():
        codec = _codec(path, pattern)
        decimal = [str(i) for i in range(len(codec.by_rank))]

        def one(text: str | None) -> tuple[int, str, str]:
            n, said, decoded = 0, hashlib.sha256(), hashlib.sha256()
            for ids in codec.blocks(text or ""):
                said.update(((" " if n else "") + " ".join(map(decimal.__getitem__, ids))).encode())
                decoded.update(codec.decode(ids))
                n += len(ids)
            return n, said.hexdigest(), decoded.hexdigest()

        return one

    fields = [("n_tokens", T.LongType()), ("ids_sha256", T.StringType()), ("decoded_sha256", T.StringType())]
    return map_texts(docs, make, fields, keep=keep)


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"))
