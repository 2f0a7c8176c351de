"""Queries that read chunks or scores more than once have them written first."""

import pytest

from adlattice.plans import text_queries

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["replaced_chunks", "supporting_chunk_ids"])
def test_texts_are_not_cut_again(spark, name):
    plan = text_queries.QUERIES[name](spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract_all" not in plan


def test_listings_are_scored_once_before_the_order_by_ranges(spark, monkeypatch):
    given, normalise = [], text_queries.nightly.normalise_scores
    monkeypatch.setattr(text_queries.nightly, "normalise_scores", lambda scores: given.append(scores) or normalise(scores))
    assert text_queries.nightly_scores(spark, FOLDER).count() > 0
    assert "Aggregate" not in given[0]._jdf.queryExecution().optimizedPlan().toString()
