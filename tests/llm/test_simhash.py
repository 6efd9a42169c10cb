import random
import re

import numpy as np
import xxhash

from recordloom.llm import buckets, simhash
from recordloom.operators.graph import connected_components
from tests.llm import cases


def brute_print(text):
    low = re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode())
    w = [x for x in re.split(rb"[\x20\x09-\x0d]+", low) if x]
    hashes = [xxhash.xxh64_intdigest(b" ".join(w[k:k + 4]), 42) for k in range(max(1, len(w) - 3))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def parts(items, linked):
    parent = {x: x for x in items}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(items):
        for b in items[:i]:
            if linked(a, b):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {x: find(x) for x in items}


def test_cases(spark):
    rows = cases.rows()
    got = sorted((tuple(r) for r in simhash.near_duplicates(cases.documents(spark)).collect()), key=str)
    prints = [brute_print(r[1]) for r in rows]
    comp = parts(sorted(set(prints)), lambda a, b: (a ^ b).bit_count() <= 4)
    low = {}
    for r, f in zip(rows, prints, strict=True):
        if r[0] is not None:
            low[comp[f]] = min(low.get(comp[f], r[0]), r[0])
    assert got == sorted(((r[0], f"{f:016x}", low.get(comp[f])) for r, f in zip(rows, prints, strict=True)), key=str)
    assert simhash.near_duplicates(cases.nothing(spark)).count() == 0


def test_links_span_every_part_at_any_cap(spark):
    rng = random.Random(1)
    near = []
    for _ in range(12):
        f = rng.getrandbits(64)
        for _ in range(rng.randint(1, 30)):
            near.append(f)
            for _ in range(rng.randint(0, 4)):
                f ^= 1 << rng.randrange(64)
    prints = sorted({int(np.uint64(x).astype(np.int64)) for x in near} | {int(np.uint64(rng.getrandbits(64)).astype(np.int64)) for _ in range(200)})
    wanted = parts(prints, lambda a, b: ((a ^ b) & (2**64 - 1)).bit_count() <= 4)
    posted = spark.createDataFrame([(x,) for x in prints], "fp long").mapInArrow(simhash._postings(4), "key long, id long")
    one_key = spark.createDataFrame([(7, x) for x in prints], "key long, id long")
    for members, cap in ((posted, buckets.CAP), (one_key, buckets.CAP), (one_key, 20)):
        got = {r["node"]: r["component"] for r in connected_components(buckets.links(members, simhash._linker(4), cap)).collect()}
        assert {x: got.get(x, x) for x in prints} == wanted
