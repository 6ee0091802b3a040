import zlib

from helpers import SF, documents, texts
from mishap.llm.sharding import op1_sharding, shard_by_bytes


def brute(rows, shards):
    rows = sorted((i is not None, i or 0, len((t or "").encode()) + 1, -1 if t is None else zlib.crc32(t.encode()))
                  for i, t in rows)
    total, before, out, slots = sum(r[2] for r in rows), 0, [], {}
    for named, i, size, crc in rows:
        shard = before * shards // total
        slots[shard] = slots.get(shard, -1) + 1
        out.append((i if named else None, size, None if crc < 0 else crc, shard, slots[shard]))
        before += size
    return sorted(out, key=repr)


def test_query_equals_brute_force(spark):
    got = op1_sharding(spark, SF)
    assert got.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    rows = got.collect()
    assert sorted([(r[0], r[1], r[2], r[4], r[5]) for r in rows], key=repr) == brute(documents(), 16)
    assert {r.law for r in rows} == {"bytes"} and {r.grown_shard for r in rows} == {None}


def test_nulls_ties_repeats_and_clashing_columns(spark):
    rows = [(1, "abc"), (1, "abc"), (2, None), (None, "x"), (None, None), (3, ""), (4, "é" * 5000), (5, "abc")] + [(7, "same")] * 40
    frame = texts(spark, [(*r, 0, 0) for r in rows], ", size long, shard int")
    got = [tuple(r) for r in shard_by_bytes(frame, 5).collect()]
    assert sorted(got, key=repr) == brute(rows, 5)


def test_empty_table(spark):
    assert shard_by_bytes(texts(spark, [])).count() == 0
