import bisect
import hashlib
import re

import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline as pipeline
from recordloom.llm import bpe, secrets, toxicity, winnow
from tests.llm import cases
from tests.llm.test_simhash import brute_print, parts

SF = "/root/testdata/sf0.001"


def test_stages_call_the_asked_operators():
    assert [n for n, _ in pipeline.STAGES] == ["toxicity", "simhash", "decontamination", "secrets", "bpe"]


def test_each_stage_works_on_what_its_predecessor_kept(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    kept = docs.count()
    for k, (name, stage) in enumerate(pipeline.STAGES):
        made = stage(spark, docs, SF)
        if name == "bpe":
            assert made.count() == kept
            break
        assert made.columns == list(pipeline.COLUMNS)
        made.write.parquet(at := str(tmp_path / str(k)))
        docs = spark.read.parquet(at)
        n = docs.count()
        assert n <= kept and n > 0.5 * kept
        if name == "secrets":
            assert n == kept and docs.filter("text rlike '[0-9a-f]{16,}'").count() == 0
        if name == "decontamination":
            assert winnow.decontaminate(docs, bench).filter("contaminated").count() == 0
        kept = n
    assert pipeline.run(spark, SF).count() == kept


@pytest.mark.parametrize("empty", [False, True])
def test_stages_stand_odd_rows(spark, empty):
    """Nulls, empty and very long texts, repeats, clashing columns; and a table without rows."""
    docs = cases.nothing(spark) if empty else cases.documents(spark)
    n = docs.count()
    left = {name: stage(spark, docs, SF) for name, stage in pipeline.STAGES}
    assert all(left[k].columns == list(pipeline.COLUMNS) for k in left if k != "bpe")
    # No text of these is toxic, a passage of the benchmark or the key to anything.
    assert all(left[k].count() == n for k in left if k != "simhash")
    ids = [r["doc_id"] for r in left["simhash"].collect()]
    assert len(ids) == len(set(ids)) and (set(ids) - {9} == (set() if empty else {0, 3, 4, 6, 7, 8}))
    codes = {r["doc_id"]: r["n_tokens"] for r in left["bpe"].collect()}
    assert empty or (codes[0], codes[1]) == (0, 0) and codes[6] > 30_000
    texts = {r["doc_id"]: r["text"] for r in left["secrets"].collect()}
    assert empty or texts[0] is None and texts[1] == ""


def test_null_and_shared_ids_lose_no_clean_document(spark):
    prose = lambda k: " ".join(f"w{k}x{i}" for i in range(40))
    planted = spark.read.parquet(f"{SF}/benchmark.parquet").filter("length(text) > 100").orderBy("item_id").first()["text"]
    rows = [(None, prose(1)), (None, prose(2)), (7, prose(3)), (7, prose(4)), (1, prose(4)), (8, prose(5)), (8, prose(5)), (None, prose(6)), (None, prose(6)), (None, planted), (9, planted[::-1]), (9, planted + " ")]
    docs = spark.createDataFrame([(*r, None, None, None) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    near = pipeline.drop_near_duplicates(spark, docs, SF)
    got = [(r["doc_id"], r["text"]) for r in near.collect()]
    clean = {(None, prose(1)), (None, prose(2)), (7, prose(3)), (1, prose(4)), (8, prose(5)), (None, prose(6)), (9, planted[::-1])}
    assert len(got) == 8 and set(got) == clean | {(9, planted + " ")}
    left = pipeline.drop_contaminated(spark, docs, SF).collect()
    assert {r["text"] for r in left} == {prose(k) for k in range(1, 7)} | {planted[::-1]} and len(left) == 10


def walked(model, text):
    """A text's toxicity, one tree after the other, node by node."""
    trees = model.trees
    bins = [sum(float(v) >= edge for edge in edges) for v, edges in zip(model.read(text), trees.edges, strict=True)]
    total = trees.start
    for tree in trees.trees:
        node = tree[0]
        while node[0] is not None:
            node = tree[node[2] if bins[node[0]] <= node[1] else node[3]]
        total += node[1]
    at, rate = (list(map(float, k)) for k in trees.knots)
    k = bisect.bisect_right(at, total)
    if k in (0, len(at)):
        return rate[max(k - 1, 0)]
    return rate[k - 1] + (rate[k] - rate[k - 1]) * (total - at[k - 1]) / (at[k] - at[k - 1])


def words_of(text):
    low = re.sub(r"[A-Z]", lambda m: m[0].lower(), text or "")
    return [w for w in re.split(r"[\x00-\x2f\x3a-\x60\x7b-\x7f]+", low) if w]


def windows_of(words, size):
    return {" ".join(words[i:i + size]) for i in range(len(words) - size + 1)}


def test_run_equals_a_run_by_brute_force(spark):
    """Every stage again, row by row in plain Python: scores above one half go, then all but the first of each group of near
    fingerprints, then texts with a window of an item; found secrets are marked, and what is left is encoded by tiktoken."""
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()]
    model = toxicity.model_of(spark, SF)
    frame = lambda some: spark.createDataFrame(some, "doc_id long, text string")
    toxic = {d for d, t in rows if walked(model, t) >= 0.5}
    rows = [r for r in rows if r[0] not in toxic]
    prints = {d: brute_print(t) for d, t in rows}
    group = parts(sorted(set(prints.values())), lambda a, b: (a ^ b).bit_count() <= 4)
    first = {}
    for d, _ in rows:
        first.setdefault(group[prints[d]], d)
    rows = [(d, t) for d, t in rows if first[group[prints[d]]] == d]
    sizes = {}
    for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect():
        w = words_of(r["text"])
        if w:
            sizes.setdefault(min(10, len(w)), set()).update(windows_of(w, min(10, len(w))))
    rows = [(d, t) for d, t in rows if not any(windows_of(words_of(t), n) & said for n, said in sizes.items())]
    found = {r["doc_id"]: r["spans"] for r in secrets.scan(frame(rows)).collect()}

    def marked(text, spans):
        out, at = [], 0
        for start, end in sorted(tuple(map(int, s.split(":")[1:])) for s in spans.split(",") if s):
            if start >= at:
                out += [text[at:start], "[SECRET]"]
            at = max(at, end)
        return "".join([*out, text[at:]])

    codec = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe._codec(None, None).ranks, special_tokens={})
    sha = lambda b: hashlib.sha256(b).hexdigest()
    wanted = set()
    for d, t in rows:
        text = marked(t or "", found[d])
        ids = codec.encode_ordinary(text)
        wanted.add((d, len(ids), sha(" ".join(map(str, ids)).encode()), sha(text.encode())))
    got = {(r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in pipeline.run(spark, SF).collect()}
    assert got == wanted and toxic and len(got) > 100
