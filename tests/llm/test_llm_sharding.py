import zlib
from collections import Counter, defaultdict

import pytest

from stratiform.llm import sharding

DOCS = (
    [(i, "text %d " % i * (i % 50)) for i in range(3000)]
    + [(10_000 + i, "same text again and again") for i in range(1500)]
    + [(7, "a repeated row")] * 800
    + [(20_000, None), (20_001, ""), (None, "no id"), (20_002, "long " * 20_000)]
)


@pytest.mark.parametrize("max_rows, max_bytes", [(500_000, 1 << 30), (40, 1 << 30), (500_000, 3000)])
def test_shards_are_near_equal_and_slots_gapless(spark, max_rows, max_bytes):
    docs = spark.createDataFrame([(d, t, "clash") for d, t in DOCS], "doc_id long, text string, shard string").repartition(5)
    rows = sharding.shard_documents(docs, n_shards=8, keep=["doc_id", "shard"], max_rows=max_rows, max_bytes=max_bytes).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(d for d, _ in DOCS)
    expected = Counter((d, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t in DOCS)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == expected
    slots, sizes = defaultdict(list), Counter()
    for r in rows:
        slots[r["shard"]].append(r["slot"])
        sizes[r["shard"]] += r["size"]
    assert sorted(slots) == list(range(8))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    largest = max(size for _, size, _ in expected)
    fair = sum(sizes.values()) / 8
    assert all(abs(n - fair) <= largest for n in sizes.values())
    assert {(r["law"], r["grown_shard"]) for r in rows} == {("bytes", None)}


def test_all_columns_are_kept(spark):
    docs = spark.createDataFrame([(1, "a", "en"), (2, None, "de")], "doc_id long, text string, lang string")
    found = sharding.shard_documents(docs, n_shards=2)
    assert found.columns == ["doc_id", "text", "lang", *sharding.DERIVED]
    assert sorted((r["doc_id"], r["text"] or "", r["lang"], r["shard"]) for r in found.collect())[0][:3] == (1, "a", "en")


def test_one_shard_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string")
    assert sorted(r["slot"] for r in sharding.shard_documents(docs, n_shards=1).collect()) == [0, 1]
    assert sharding.shard_documents(docs.limit(0)).count() == 0


def test_slots_hold_however_the_table_is_read(spark, tmp_path):
    """Kept texts are read more than once; other splits of the files must give the same shards and slots."""
    docs = spark.createDataFrame(DOCS, "doc_id long, text string").where("doc_id <> 7")
    docs.repartition(3).write.parquet(f"{tmp_path}/docs")
    found = []
    for split in ("128m", "4k"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        sharded = sharding.shard_documents(spark.read.parquet(f"{tmp_path}/docs"), n_shards=8, max_rows=40)
        found.append(sorted((r["doc_id"] or 0, r["shard"], r["slot"]) for r in sharded.collect()))
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert found[0] == found[1]
