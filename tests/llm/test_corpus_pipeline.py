"""The corpus pipeline against its stages done by brute force."""

import re

import numpy as np

import corpus_pipeline
from catalytics.llm import quality, secrets
from test_operators import brute_components, rows_of


def test_pipeline_rows(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    table = quality.fit(docs).posterior()
    rows = []
    for doc, text in rows_of(docs):
        s = quality.statistics(text)
        if s["n_words"] >= 50 and 100 * s["n_repeat_words"] <= 50 * s["n_words"] and table[quality.pattern(s)] >= 0.5:
            rows.append((doc, text))
    best = {}
    for doc, text in sorted(rows, key=lambda r: (-len(r[1]), r[0])):
        best.setdefault(re.sub(r"[\x20\x09-\x0D]", "", text), doc)
    rows = [r for r in rows if r[0] in set(best.values())]
    ids = {doc for doc, _, component in brute_components(rows) if doc == component}
    out = corpus_pipeline.run(spark, folder).toPandas()
    assert set(out.doc_id) == ids
    for doc, mine in out.groupby("doc_id"):
        assert sum(mine.length) == mine.doc_tokens.iloc[0] == len(np.concatenate(list(mine.ids)))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, folder).columns == docs.columns, name
    assert secrets.MASK
