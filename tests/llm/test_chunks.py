import random
import re

import numpy as np

from recordloom.llm import chunks
from tests.llm import cases


def seeds_of(text, words=51):
    return chunks.units(np.frombuffer(text.encode(), np.uint8), words)


def test_the_gear_hash_holds_the_last_words_alone():
    x = np.random.default_rng(1).integers(0, 2**63, 200).astype(np.uint64)
    h = chunks.gear(x, 16)
    assert h.tolist() == [sum(int(x[i - k]) << 4 * k for k in range(min(16, i + 1))) % 2**64 for i in range(len(x))]


def test_chunks_are_runs_of_windows_with_one_seed():
    rng = random.Random(4)
    text = " ".join(rng.choice("abcdefghij") * rng.randint(1, 3) for _ in range(900))
    first, last, seed, starts, stops = seeds_of(text, 20)
    assert first[0] == 0 and (first[1:] == last[:-1] + 1).all() and last[-1] == 900 - 20
    alone = [seeds_of(text[starts[i]:stops[i + 19]], 20)[2] for i in range(900 - 20 + 1)]
    assert all(len(s) == 1 for s in alone)  # a window takes the same seed wherever it stands
    assert [int(s[0]) for s in alone] == [int(seed[np.searchsorted(last, i)]) for i in range(900 - 20 + 1)]


def test_insertions_shift_no_distant_chunk():
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 8))) for _ in range(600)]
    a, b = (set(seeds_of(" ".join(w))[2].tolist()) for w in (words, [*words[:300], "inserted", *words[300:]]))
    assert len(a & b) > 0.8 * len(a)
    assert len(seeds_of("")[2]) == 0 and len(seeds_of("the " * 1000)[2]) > 0


def planted():
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9)))
    fresh = lambda n: " ".join(word() for _ in range(n))
    passage = [fresh(52) for _ in range(20)]
    docs = [(i, f"{fresh(rng.randint(20, 90))} {passage[i % 20]} {fresh(rng.randint(20, 90))}") for i in range(40)]
    return docs + [(100 + i, fresh(150)) for i in range(40)] + [(200, "x " + fresh(3)), (201, None), (202, "")]


def test_planted_passages_and_nothing_else(spark):
    docs = planted()
    found = {r["doc_id"]: r for r in chunks.by_document(chunks.repeated_spans(spark.createDataFrame(docs, "doc_id long, text string"))).collect()}
    assert set(found) == set(range(40))
    assert all(found[i]["first_doc_ids"] == [i % 20] for i in range(40))
    assert all((found[i]["n_bytes_dropped"] == 0) == (i < 20) for i in range(40))


def test_odd_rows_are_brute_force(spark):
    docs = [(r[0], r[1]) for r in cases.rows() if r[0] is not None]
    for words in (1, 4, 51):
        found = {tuple(r) for r in chunks.repeated_spans(cases.documents(spark), words).select("doc_id", "start", "end", "words", "first_doc_id", "kept").collect()}
        assert found == windows_by_brute_force(list({d: (d, t) for d, t in docs}.values()), words)
    assert chunks.repeated_spans(cases.nothing(spark)).count() == 0


def test_every_dropped_word_stands_in_a_smaller_document(spark):
    """Documents of overlapping passages: P1; P1 P2; P1 P2; P2; and random mixtures of them."""
    rng = random.Random(21)
    fresh = lambda n: [f"{rng.choice('abcdefgh')}{rng.randint(0, 10**6)}" for _ in range(n)]
    p = [fresh(70) for _ in range(8)]
    docs = [(1, fresh(5) + p[0]), (2, fresh(5) + p[0] + p[1] + fresh(5)), (3, p[0] + p[1]), (4, fresh(9) + p[1])]
    for i in range(5, 40):
        mix = [x for _ in range(rng.randint(1, 4)) for x in (lambda q: q[rng.randint(0, 20):rng.randint(50, 70)])(rng.choice(p)) + (fresh(3) if rng.random() < 0.5 else [])]
        docs.append((i, mix))
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in docs], "doc_id long, text string")
    out = {r["doc_id"]: r["text"].split() for r in chunks.deduplicate(df).collect()}
    seen = set()
    for i, w in docs:
        assert set(out[i]) >= {x for x in w if x not in seen}, i
        seen |= set(w)
    assert {x for w in out.values() for x in w} == seen and sum(map(len, out.values())) < 0.7 * sum(len(w) for _, w in docs)
    found = {r["doc_id"]: r for r in chunks.repeated_spans(df).filter("doc_id < 5").collect()}
    assert [found[i]["kept"] for i in (1, 2, 3, 4)] == [True, False, False, False] and " ".join(p[1]) in " ".join(out[2])


def test_deduplicated_texts_keep_one_copy(spark):
    docs = planted()
    df = spark.createDataFrame([(d, t, "keep") for d, t in docs], "doc_id long, text string, words string")
    out = {r["doc_id"]: r for r in chunks.deduplicate(df).collect()}
    assert len(out) == len(docs) and {r["words"] for r in out.values()} == {"keep"}
    before = dict(docs)
    assert all(out[i]["text"] == before[i] for i in before if not 20 <= i < 40)
    assert all(len(out[i]["text"]) < len(before[i]) - 150 for i in range(20, 40))


def windows_by_brute_force(docs, words):
    """Spans of words whose windows of so many words another document holds, and their first holder."""
    own, held = {}, {}
    for d, t in docs:
        raw = (t or "").encode()
        at = [(m.start(), m.end()) for m in re.finditer(rb"[^ \t-\r]+", raw)]
        own[d] = [(at[i][0], at[i + words - 1][1]) for i in range(len(at) - words + 1)]
        for a, b in own[d]:
            held.setdefault(raw[a:b], set()).add(d)
    found = set()
    for d, t in docs:
        spans = []
        for a, b in own[d]:
            who = held[(t or "").encode()[a:b]]
            if len(who) > 1:
                if spans and a <= spans[-1][1]:
                    spans[-1] = (spans[-1][0], b, min(spans[-1][2], min(who)))
                else:
                    spans.append((a, b, min(who)))
        # A window that came first elsewhere is dropped, so a span is kept if none of its windows did.
        found |= {(d, a, b, len((t or "").encode()[a:b].split()), f, f == d and all(min(held[(t or "").encode()[x:y]]) == d for x, y in own[d] if a <= x and y <= b)) for a, b, f in spans}
    return found


def edges():
    """Passages of 50 and of 51 words, short words, periods, overlaps, and one within larger ones."""
    rng = random.Random(11)
    fresh = lambda n: " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9))) for _ in range(n))
    tiny = " ".join(rng.choice("abcdefgh") for _ in range(51))
    p, q, r = fresh(51), fresh(50), fresh(140)
    w = r.split()
    texts = [f"{fresh(9)} {x} {fresh(30)}" for x in (tiny, tiny, p, p, q, q, "the " * 60 + "end", "the " * 75 + "end", "Dieerauchbe " * 300, "Dieerauchbe " * 400)]
    texts += [r, f"{fresh(5)} {' '.join(w[:60])} {fresh(70)} {' '.join(w[60:])}", f"{fresh(3)} {' '.join(w[20:75])}", f"{' '.join(w[70:130])}\n{fresh(4)}", f"{' '.join(w[:40])} {fresh(2)} {' '.join(w[40:80])}", "ä ö ü " * 30, "x ä ö ü " + "ä ö ü " * 30, "\n" + p + "\t", None, " "]
    return list(enumerate(texts))


def test_spans_reach_the_true_ends(spark):
    docs = edges()
    for words in (51, 7, 1):
        found = {tuple(x) for x in chunks.repeated_spans(spark.createDataFrame(docs, "doc_id long, text string"), words).select("doc_id", "start", "end", "words", "first_doc_id", "kept").collect()}
        assert found == windows_by_brute_force(docs, words)
    ids = {r["doc_id"] for r in chunks.repeated_spans(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert {0, 1, 2, 3, 6, 7, 8, 9} <= ids and not {4, 5} & ids
