"""The stages one after the other, each against brute force on what the one before kept."""

from __future__ import annotations

import corpus_pipeline
from girolens.llm import bpe
from tests.llm.test_documents import jaccard_components, removed, rows


def test_stages(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = [docs]
    assert len(corpus_pipeline.STAGES) == 5
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, kept[-1], folder).write.parquet(str(tmp_path / str(k)))
        kept.append(spark.read.parquet(str(tmp_path / str(k))))
        if k < 4:
            assert kept[-1].columns == docs.columns
    tables = [dict(rows(t, "doc_id", "text")) for t in kept[:5]]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    gone = set(tables[0]) - set(tables[1])
    assert sum(labels[d] == 0 for d in gone if d in labels) >= 0.8 * sum(q == 0 for q in labels.values())
    assert sum(labels[d] == 1 for d in gone if d in labels) <= 0.05 * len(labels)
    _, home = jaccard_components(tables[1].items(), 5, 80)
    assert set(tables[2]) == {d for d in home if home[d] == d} and all(tables[2][d] == tables[1][d] for d in tables[2])
    want = removed(tables[2].items())
    assert tables[3] == {d: want[d][4].decode("utf-8", "ignore") for d in tables[2]}
    items = [r.text for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    leaks = {d for d, t in tables[3].items() if any(i in t for i in items)}
    assert leaks <= set(tables[3]) - set(tables[4]) and len(tables[3]) - len(tables[4]) <= 2 * len(leaks) + 2
    coder = bpe.codec("byte_bpe_50k.tiktoken")
    got = dict(rows(kept[5], "doc_id", "n_tokens"))
    assert got == {d: len(coder._coder.encode_ordinary(t)) for d, t in tables[4].items()}
    again = corpus_pipeline.run(spark, folder)
    assert sorted(rows(again, *kept[5].columns)) == sorted(rows(kept[5], *kept[5].columns))


def test_stages_on_nulls_ties_clashing_columns_and_empty_tables(spark, folder, docs, tmp_path):
    """Every stage keeps the columns and takes the rows of the one before; an empty table goes through all of them."""
    for name, start in (("rows", docs), ("none", docs.limit(0))):
        now = start
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            stage(spark, now, folder).write.parquet(f"{tmp_path}/{name}{k}")
            after = spark.read.parquet(f"{tmp_path}/{name}{k}")
            assert k == 4 or after.columns == docs.columns
            assert after.count() <= now.count()
            ids = {r[0] for r in rows(now, "doc_id")}
            assert {r[0] for r in rows(after, "doc_id")} <= ids
            if name == "none":
                assert after.count() == 0
            now = after
