"""The pipeline, stage by stage, against brute force on whole tables."""

import inspect
from collections import Counter

import pytest

pytest.importorskip("sluice.llm")

import corpus_pipeline as pipeline
from sluice.llm import langid
from sluice.llm.common import table
from test_contamination import brute as brute_leaks
from test_mixing import waterfill
from test_neardup import brute as brute_groups
from test_sharding import check

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    docs = table(spark, SF, "documents")
    out = [docs]
    for _, stage in pipeline.STAGES:
        out.append(pipeline.stored(stage(spark, out[-1], SF)))
    return out


def ids(df):
    return Counter(r.doc_id for r in df.select("doc_id").collect())


def test_five_stages_of_three_arguments():
    assert len(pipeline.STAGES) == 5
    assert all(len(inspect.signature(f).parameters) == 3 for _, f in pipeline.STAGES)


def test_all_but_the_last_return_the_columns_of_documents(stages):
    assert all(s.columns == stages[0].columns for s in stages[:5])
    assert stages[5].columns[:5] == stages[0].columns


def test_language_stage_drops_the_rejected(spark, stages):
    rejected = {r.doc_id for r in langid.identify_languages(stages[0]).where("rejected").collect()}
    assert ids(stages[1]) == Counter({i: n for i, n in ids(stages[0]).items() if i not in rejected})
    assert stages[1].count() >= 0.99 * stages[0].count()


def test_one_of_each_group_stays(stages):
    rows = [(r.doc_id, r.text) for r in stages[1].select("doc_id", "text").collect()]
    groups = brute_groups(rows, 5, 80)
    assert ids(stages[2]) == Counter(i for i, (_, c) in groups.items() if i == c)


def test_contaminated_documents_go(spark, stages):
    rows = [(r.doc_id, r.text) for r in stages[2].select("doc_id", "text").collect()]
    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    leaked = {d for d, _ in brute_leaks(rows, items)}
    assert leaked and ids(stages[3]) == Counter(i for i, _ in rows if i not in leaked)


def test_sources_come_near_their_targets(stages):
    size = {}
    before = {r.doc_id: (r.source, len([w for w in r.text.encode().split()])) for r in stages[3].collect()}
    for s, n in before.values():
        size[s] = size.get(s, 0) + n
    target = waterfill(size, (5, 2, 1), 3)
    taken, copies = Counter(), ids(stages[4])
    assert max(copies.values()) <= 3
    for i, n in copies.items():
        taken[before[i][0]] += n * before[i][1]
    for s in target:
        assert abs(taken[s] - target[s]) <= 0.05 * target[s] + 20


def test_shards_hold_everything(stages):
    rows = stages[5].collect()
    assert Counter(r.doc_id for r in rows) == ids(stages[4])
    check(rows, 40, 2 * max(r.size for r in rows))


def test_run_gives_the_same(spark, stages):
    got = Counter((r.doc_id, r.shard, r.slot) for r in pipeline.run(spark, SF).collect())
    want = Counter((r.doc_id, r.shard, r.slot) for r in stages[5].collect())
    assert {(i, s): 0 for i, s, _ in got} == {(i, s): 0 for i, s, _ in want} and len(got) == len(want)


def test_edge_rows_pass_through_all_stages(spark, docs, stages):
    base = stages[0].limit(150)
    extra = spark.createDataFrame(
        [(None, "the and of to", "en", None, None), (900001, None, None, "src1", None), (900002, "", "en", None, 0), (900003, "x", "en", "new", 1)] + [(900004, "twice the same row", "en", "src2", 1)] * 3,
        base.schema,
    )
    own = {"size": 1, "copies": 2, "shard": 3, "copy": 4, "target": 5, "source_size": 6, "__size": 7, "slot": 8}
    d = base.unionByName(extra).selectExpr("*", *[f"{v} as {k}" for k, v in own.items()])
    for n, (_, stage) in enumerate(pipeline.STAGES):
        d = pipeline.stored(stage(spark, d, SF))
        if n < 4:
            # every stage but the last keeps the columns and the values they came with
            assert d.columns == [*base.columns, *own]
            assert all(r[k] == v for r in d.collect() for k, v in own.items())
    got = ids(d)
    assert 900001 not in got and 900002 not in got  # no letter: in no language
    empty = stages[0].limit(0)
    for _, stage in pipeline.STAGES:
        empty = pipeline.stored(stage(spark, empty, SF))
    assert empty.count() == 0
