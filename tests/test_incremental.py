import random

import pytest
from pyspark.sql import functions as F

from recordloom.operators import incremental
from recordloom.plans import table_queries

SCHEMA = "record long, aliases array<string>"


def whole(rows):
    """Union-find over all rows: record -> smallest record that it reaches."""
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for r, names in rows:
        find(r)
        for n in names or ():
            if n is not None:
                a, b = sorted((find(r), find(n)), key=lambda v: (isinstance(v, str), v))
                parent[b] = a
    return {r: find(r) for r, _ in rows}


@pytest.mark.parametrize("seed", [1, 2])
def test_batches_give_the_components_of_the_whole(spark, tmp_path, seed, monkeypatch):
    monkeypatch.setattr(incremental, "BUCKETS", 4)
    rng = random.Random(seed)
    store, rows = incremental.Components(spark, f"file://{tmp_path}/s"), []
    for batch in range(3):
        new = [(rng.randrange(400), [rng.choice([None, *(f"x{i}" for i in range(160))]) for _ in range(rng.randint(0, 2))]) for _ in range(70)] + [(1000 + batch, None)]
        rows += new
        df = spark.createDataFrame(new, SCHEMA)
        assert store.add(df, batch)
        assert not store.add(df, batch)
        assert {r["record"]: r["component"] for r in store.labels().collect()} == whole(rows)


def test_untouched_buckets_are_not_read_and_broken_batches_are_taken_again(spark, tmp_path):
    store = incremental.Components(spark, f"file://{tmp_path}/s")
    store.add(spark.createDataFrame([(i, [f"a{i}", f"b{i // 2}"]) for i in range(400)], SCHEMA), 0)
    read = store._read("aliases", "alias string, component long", [3])
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "bucket" in plan.split("PartitionFilters")[1][:200]
    assert 0 < len(read.inputFiles()) <= incremental.BUCKETS and 0 < read.count() < 40
    # Rows of a batch that has no roots yet don't count, and are written over.
    store._write(spark.createDataFrame([("zz", 5)], "alias string, component long"), "aliases", "alias", 1)
    store._write(spark.createDataFrame([(77777, 5)], "record long, component long"), "records", "record", 1)
    assert store.labels().filter("record = 77777").count() == 0
    store.add(spark.createDataFrame([(900, ["b1", "b7"])], SCHEMA), 1)
    got = {r["record"]: r["component"] for r in store.labels().collect()}
    assert {got[i] for i in (2, 3, 14, 15, 900)} == {2} and got[4] == 4 and 77777 not in got
    assert store.roots().filter(F.col("component") == 14).first()["root"] == 2


def test_a_stream_keeps_the_store(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(incremental, "BUCKETS", 4)
    store = incremental.Components(spark, f"file://{tmp_path}/s")
    for n in range(3):
        spark.createDataFrame([(10 * n + i, [f"k{i}"]) for i in range(3)], SCHEMA).coalesce(1).write.mode("append").json(f"{tmp_path}/in")
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(f"{tmp_path}/in")
    assert incremental.add_stream(stream, store, f"{tmp_path}/at").trigger(availableNow=True).start().awaitTermination(200)
    assert {r["record"]: r["component"] for r in store.labels().collect()} == {10 * n + i: i for n in range(3) for i in range(3)}


def test_held_aliases_are_not_written_again(spark, tmp_path):
    store = incremental.Components(spark, f"file://{tmp_path}/s", buckets=4)
    store.add(spark.createDataFrame([(5, ["a", "b"]), (7, ["c"])], SCHEMA), 0)
    store.add(spark.createDataFrame([(6, ["a", "c", "d"]), (1, ["c"])], SCHEMA), 1)
    assert sorted(r["alias"] for r in store._read("aliases", "alias string, component long").collect()) == ["a", "b", "c", "d"]
    # What was held goes by its newest name all the same.
    store.add(spark.createDataFrame([(9, ["b"])], SCHEMA), 2)
    assert {r["record"]: r["component"] for r in store.labels().collect()} == dict.fromkeys((1, 5, 6, 7, 9), 1)


def test_the_query_reads_each_text_once_and_keeps_no_long_alias(spark):
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def seen(x):
        read.add(1)
        return x

    words = " ".join(f"word{i}" for i in range(400))
    texts = [("One title\nx", 10), ("one TITLE\ny", 900), (words, 3000), (words.upper(), 700), (words + " more", 3000), (None, None), ("One title\nx", 2500)]
    docs = spark.createDataFrame([(i, s, "en", "s", n) for i, (s, n) in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long").withColumn("text", seen("text"))
    got = {r["doc_id"]: r["component"] for r in table_queries.incremental_components(lambda name: docs).collect()}
    assert got == {0: 0, 1: 0, 2: 2, 3: 2, 4: 4, 5: 5, 6: 0}
    assert read.value == len(texts)
    assert table_queries._document_aliases(lambda name: docs).select(F.explode("aliases").alias("a")).agg(F.max(F.length("a"))).first()[0] <= 80
