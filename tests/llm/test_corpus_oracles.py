import oracle
import pytest

import corpus_pipeline
from starloom.llm import common, queries
from starloom.llm.oracles import ORACLES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ORACLES)
def test_query_matches_oracle(spark, name):
    assert oracle.differences(oracle.connect(SF), queries.QUERIES[name](spark, SF), ORACLES[name]) == []


def test_pipeline_keeps_columns_and_acts(spark):
    """Each stage on what the one before kept; the last one's ids are those of the mixed texts."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    first, counts = docs, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = common.written(stage(spark, docs, SF), "test")
        assert docs.dtypes == first.dtypes, name
        counts.append(docs.count())
    assert counts[0] > counts[1] >= counts[2] == counts[3] and counts[4] > 0
    out = corpus_pipeline.tokens(spark, docs, SF)
    assert out.count() == counts[4]
    again = corpus_pipeline.run(spark, SF)
    digest = lambda df: sorted(map(tuple, df.select("doc_id", "n_tokens", "round_trip").collect()))
    assert digest(again) == digest(out)
