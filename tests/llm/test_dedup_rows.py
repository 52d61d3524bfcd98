import collections

import corpus_pipeline
from tests.llm import edge

#: 20 words each, so that rows of one text are one class and rows of different texts are not.
TEXTS = {k: " ".join(f"{k}{i}" for i in range(20)) for k in "abcd"}
ROWS = [(1, "a"), (2, "a"), (1, "b"), (None, "b"), (None, "c"), (None, "c"), (None, "c"), (5, "d"), (5, "d"), (None, "d"),
        (None, None), (None, None)]


def test_one_row_of_each_group_stays_in_both_stages(spark):
    rows = [(i, TEXTS.get(t), k) for k, (i, t) in enumerate(ROWS)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, place int").repartition(3)
    for name, stage in corpus_pipeline.STAGES[1:3]:
        kept = stage(spark, docs, "")
        assert kept.columns == docs.columns and kept.dtypes == docs.dtypes
        got = [tuple(r) for r in kept.collect()]
        assert set(got) <= set(rows), name
        texts = collections.Counter(t for _, t, _ in got)
        assert texts == {t: 1 for t in [*TEXTS.values(), None]}, name
        ids = {t: i for i, t, _ in got}
        if name == "exact_dedup":
            assert [ids[TEXTS[k]] for k in "abcd"] == [2, 1, None, 5]
        else:
            assert [ids[TEXTS[k]] for k in "abcd"] == [1, None, None, None]    # null ids are smallest


def test_edge_rows(spark):
    docs = edge.documents(spark)
    exact, near = (stage(spark, docs, "") for _, stage in corpus_pipeline.STAGES[1:3])
    assert sorted(str(r["doc_id"]) for r in exact.collect()) == sorted(map(str, [2, 4, 6, 6, None, 7, 8, 9, 10]))
    assert near.count() == len(edge.ROWS) - 5 and near.dtypes == docs.dtypes
