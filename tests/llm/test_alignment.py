import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

import __spark_entry__ as entry
from recordloom.llm import alignment
from tests.llm import cases

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(public_tokenizers.path(alignment.VOCABULARY_A))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(alignment.VOCABULARY_B))


def letters():
    """Bytes of the letters, as published with the first byte-level vocabulary."""
    seen = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    of, n = {chr(b): b for b in seen}, 0
    for b in range(256):
        if b not in seen:
            of[chr(256 + n)] = b
            n += 1
    return of


def spans(libraries, text):
    """Ids of both with their byte ranges, or None."""
    if not text:
        return None
    a, b = libraries
    of, out = letters(), []
    said = a.encode(" " + text, add_special_tokens=False)
    names = [(i, bytes(of[c] for c in t)) for i, t in zip(said.ids, said.tokens, strict=True)], [(i, bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()) for i in b.encode(text) for p in [b.id_to_piece(i)]]
    for tokens in names:
        if b"".join(x for _, x in tokens) != (" " + text).encode():
            return None
        at, ranges = 0, []
        for i, x in tokens:
            ranges.append((i, at, at + len(x)))
            at += len(x)
        out.append(ranges)
    return out


def brute(libraries, rows):
    linked, said = [], []
    for _, text in rows:
        both = spans(libraries, text)
        links, groups = [], []
        if both:
            links = [(i, j) for i, s, e in both[0] for j, t, f in both[1] if s < f and t < e]
            cuts = sorted({e for *_, e in both[0]} & {e for *_, e in both[1]})
            for before, end in zip([0, *cuts], cuts, strict=False):
                groups.append("|".join(",".join(str(i) for i, s, e in tokens if s >= before and e <= end) for tokens in both))
        linked.append(links)
        said.append((both, groups))
    n = Counter(k for links in linked for k in set(links))
    best = {}
    for (a, _), c in n.items():
        best[a] = max(c, best.get(a, 0))
    return [
        (d, *map(len, both or ((), ())), len(groups), len(links), sum(n[k] == best[k[0]] for k in links), sum(n[k] for k in links), hashlib.sha256(";".join(groups).encode()).hexdigest() if both else "")
        for (d, _), links, (both, groups) in zip(rows, linked, said, strict=True)
    ]


def odd_texts():
    rng = random.Random(2)
    alphabet = "aeb  \n\tthe ing é ü 漢字 😀 ▁   0123 'll <s> <0x41> <|endoftext|> </s> ̀ ‍ Ａ"
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(150)] + ["the cat " * 30, "▁", " ", "  two", "\x00", "ﬁ", "a" * 3000, "İstanbul ǅ ȺȾ"]


def test_odd_texts_equal_brute_force(spark, libraries, tmp_path):
    rows = list(enumerate(odd_texts())) + [(7, None), (None, "the cat"), (None, "the cat"), (1000, "the cat sat on the mat. " * 8)]
    docs = spark.createDataFrame([(*r, 1, "z") for r in rows], "doc_id long, text string, n_a int, keys string")
    made = alignment.with_counts(alignment.aligned(docs), str(tmp_path / "x")).collect()
    want = brute(libraries, rows)
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest() if s else ""
    assert sorted(((*(r[c] for c in COLUMNS[:-1]), digest(r["groups"])) for r in made), key=str) == sorted(want, key=str)


def test_both_ways_of_encoding_agree(libraries):
    own = alignment.ByteLevel(public_tokenizers.path(alignment.VOCABULARY_A))
    assert own.fast is not None
    for text in [*odd_texts(), *(t[1] for t in cases.rows()), "'ll've we're 12³½ \x85\x1f\x0b ªº×÷"]:
        assert own.encode(" " + (text or "")) == libraries[0].encode(" " + (text or ""), add_special_tokens=False).ids


def test_query_is_brute_force_on_whole_texts(spark, libraries):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").limit(40).collect()
    rows = [(r["doc_id"], r["text"][:3000]) for r in docs]
    got = alignment.aligned(spark.createDataFrame(rows, "doc_id long, text string"), whole_groups=False).collect()
    want = {r[0]: r for r in brute(libraries, rows)}
    assert all((r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["groups"]) == (*want[r["doc_id"]][1:5], want[r["doc_id"]][7]) for r in got)
    made = entry.queries()["op13_alignment"](spark, SF)
    assert made.columns == COLUMNS and made.count() == 200
    links = {r["doc_id"]: r for r in alignment.aligned(spark.read.parquet(f"{SF}/documents.parquet")).collect()}
    keys = {d: (alignment._unpack(r["keys"]), alignment._unpack(r["times"])) for d, r in links.items()}
    n = Counter(k for ks, _ in keys.values() for k in ks.tolist())
    best = {}
    for k, c in n.items():
        best[k >> 32] = max(c, best.get(k >> 32, 0))
    for r in made.collect():
        ks, ts = keys[r["doc_id"]]
        assert r["count_sum"] == sum(n[k] * t for k, t in zip(ks.tolist(), ts.tolist(), strict=True))
        assert r["n_best"] == sum(t for k, t in zip(ks.tolist(), ts.tolist(), strict=True) if n[k] == best[k >> 32])


def test_no_rows(spark, tmp_path):
    assert alignment.with_counts(alignment.aligned(cases.nothing(spark)), str(tmp_path / "x")).collect() == []
    blank = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    got = alignment.with_counts(alignment.aligned(blank), str(tmp_path / "y")).collect()
    assert {tuple(r[c] for c in ("n_a", "n_links", "n_best", "count_sum", "groups")) for r in got} == {(0, 0, 0, 0, "")}


def test_counts_are_whole_whatever_is_held(spark, monkeypatch):
    rng = np.random.default_rng(1)
    docs = [np.unique(rng.integers(0, 300, 80)) for _ in range(200)]
    want = Counter(k for d in docs for k in d.tolist())
    monkeypatch.setattr(alignment, "HELD_KEYS", 100)
    batch = lambda part: pa.RecordBatch.from_arrays([pa.array([alignment._pack(d) for d in part], pa.binary())], names=["keys"])
    partial = [r for b in alignment._partial([batch(docs[:3]), batch(docs[3:])]) for r in zip(*(c.to_pylist() for c in b.columns), strict=True)]
    rows = sorted(partial)
    assert len(rows) > len(want)
    cut = [rows[i:i + 37] for i in range(0, len(rows), 37)]
    batches = [pa.RecordBatch.from_arrays([pa.array([k for k, _ in c], pa.int64()), pa.array([n for _, n in c], pa.int64())], names=["key", "n"]) for c in cut]
    got = [r for b in alignment._run_sums(batches) for r in zip(*(c.to_pylist() for c in b.columns), strict=True)]
    assert got == sorted(want.items())
    df = spark.createDataFrame([(bytearray(alignment._pack(d)),) for d in docs], "keys binary").repartition(6)
    parts = alignment.pair_counts(df).rdd.glom().collect()
    assert [(r["key"], r["n"]) for p in parts for r in p] == sorted(want.items())


def test_numbers_pack_and_unpack():
    for x in ([], [0], [-1, 1 << 62, 5], list(range(1000))):
        assert alignment._unpack(alignment._pack(np.array(x, np.int64))).tolist() == x
