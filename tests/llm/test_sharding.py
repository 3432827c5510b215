import zlib

from pyspark.sql import functions as F

from sluice.llm.sharding import byte_size, find_splitters, shard_documents, sort_key, splitters_below


def rows_of(df):
    return sorted(df.collect(), key=lambda r: (r.shard, r.slot))


def check(rows, shards, slack):
    total = sum(r.size for r in rows)
    by = {s: [r for r in rows if r.shard == s] for s in range(shards)}
    for s, got in by.items():
        assert [r.slot for r in got] == list(range(len(got)))
        assert abs(sum(r.size for r in got) - total / shards) <= slack
    for r in rows:
        assert r.size == len((r.text or "").encode()) + 16
        assert r.text_crc32 == zlib.crc32((r.text or "").encode())


def test_shards_have_equal_bytes_and_gapless_slots(docs, prose):
    d = docs([(i, prose(i, 1 + i % 30)) for i in range(800)] + [(9000, None), (9001, ""), (9002, "é" * 50)])
    rows = rows_of(shard_documents(d, shards=8))
    assert len(rows) == 803
    check(rows, 8, 400)


def test_hot_text_and_hot_null_ids_are_split(docs, prose):
    d = docs([(i, "same text again" if i % 3 == 0 else prose(i, 8)) for i in range(900)])
    rows = rows_of(shard_documents(d, shards=10))
    check(rows, 10, 150)
    assert len({r.shard for r in rows if r.text == "same text again"}) >= 2


def test_pieces_give_the_same_shards_and_order(docs, prose):
    d = docs([(i, "hot" if i % 3 == 0 else prose(i, 1 + i % 9)) for i in range(600)])
    whole = {r.doc_id: (r.shard, r.slot) for r in shard_documents(d, shards=6).collect()}
    pieces = {r.doc_id: (r.shard, r.slot) for r in shard_documents(d, shards=6, rows_per_piece=7).collect()}
    assert {k: v[1] for k, v in whole.items()}.keys() == pieces.keys()
    assert whole == pieces


def test_tolerance_bounds_the_error(docs, prose):
    d = docs([(i, prose(i, 1 + i % 30)) for i in range(500)])
    keyed = d.select(sort_key(F.col("doc_id"), F.col("text")).alias("key"), byte_size(F.col("text")).alias("size")).collect()
    df = d.select(sort_key(F.col("doc_id"), F.col("text")).alias("key"), byte_size(F.col("text")).alias("size"))
    total = sum(r["size"] for r in keyed)
    for tolerance in (0, 2000):
        bounds = find_splitters(df, 5, total, tolerance)
        assert bounds == sorted(bounds) and len(bounds) == 4
        for j, b in enumerate(bounds, 1):
            upto = sum(r["size"] for r in keyed if r.key <= b)
            assert upto >= j * total / 5 and upto - j * total / 5 <= max(tolerance, max(r["size"] for r in keyed))


def test_repeated_rows_extra_columns_and_empty(docs):
    d = docs([(1, "x")] * 5 + [(None, None)] * 3, shard="a", slot="b", size="c")
    got = shard_documents(d, shards=3)
    rows = got.collect()
    assert len(rows) == 8 and len({(r.shard, r.slot) for r in rows}) == 8
    assert sorted(got.columns) == sorted(["doc_id", "text", "lang", "source", "shard", "slot", "size", "text_crc32"])
    assert shard_documents(docs([]), shards=4).count() == 0


def test_plan_has_no_python_and_one_exchange(docs, prose, capsys):
    shard_documents(docs([(i, prose(i, 5)) for i in range(20)])).explain()
    out = capsys.readouterr().out
    assert "Python" not in out and "Arrow" not in out and out.count("Exchange hashpartitioning") == 1


def test_equal_rows_are_split_over_shards(docs, prose):
    d = docs([(7, "one row again and again") if i < 400 else (i, prose(i, 1 + i % 12)) for i in range(1000)])
    rows = rows_of(shard_documents(d, shards=40))
    assert len(rows) == 1000
    check(rows, 40, max(r.size for r in rows))
    # the same cut into pieces: same sizes, same numbers per shard, gapless slots
    small = rows_of(shard_documents(d.repartition(7), shards=40, rows_per_piece=3))
    assert sorted((r.doc_id, r.size, r.shard) for r in rows) == sorted((r.doc_id, r.size, r.shard) for r in small)
    check(small, 40, max(r.size for r in rows))


def test_only_equal_rows(docs):
    rows = rows_of(shard_documents(docs([(None, None)] * 100, lang="x"), shards=7))
    check(rows, 7, 16)
    assert all(r.lang == "x" and r.doc_id is None for r in rows)


def test_pieces_follow_the_bytes(docs, prose):
    d = docs([(i, prose(i, 40 + i % 60)) for i in range(400)])
    whole = {r.doc_id: (r.shard, r.slot) for r in shard_documents(d, shards=5).collect()}
    assert {r.doc_id: (r.shard, r.slot) for r in shard_documents(d, shards=5, bytes_per_piece=900).collect()} == whole


def test_splitters_are_looked_up_by_prefix(spark):
    import hashlib

    keys = [hashlib.md5(str(i).encode()).hexdigest() for i in range(2000)]
    bounds = sorted(keys[::3] + ["0" * 32, "f" * 32])
    got = spark.createDataFrame([(k,) for k in keys + bounds], "k string").select("k", splitters_below(bounds, F.col("k")).alias("n")).collect()
    assert all(r.n == sum(b < r.k for b in bounds) for r in got)
