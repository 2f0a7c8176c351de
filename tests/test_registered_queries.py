"""Every registered query against its SQL on the small tables."""

import pytest

from adlattice.plans import registry, vector_queries
from tests.oracle import compare, duck

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return duck(FOLDER)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, connection, name):
    result = registry.QUERIES[name](spark, FOLDER)
    if name in registry.ORACLE:
        same, message = compare(result, registry.ORACLE[name], connection)
        assert same, message
    else:
        assert result.count() > 0
    spark.catalog.clearCache()


def test_names_match():
    assert set(registry.ORACLE) <= set(registry.QUERIES)


FIRST_CHUNKS = "SELECT ad_id AS query_id, embedding AS q FROM chunks WHERE chunk_order = 0"


def test_similar_listings_are_the_exact_ones(spark, connection):
    """Against all chunks, not against the cells that the query probes."""
    exact = f"""{vector_queries._BASE}, {vector_queries._distances(queries=FIRST_CHUNKS)},
        hits AS {vector_queries._top(12, rank='hit')},
        grouped AS (SELECT query_id, ad_id, greatest(0.0, 1.0 - min(distance) / 2.0) AS s FROM hits GROUP BY ALL),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, ad_id) AS r FROM grouped WHERE s >= 0.55)
        SELECT query_id, ad_id, round(s, 6) AS similarity_score, row_number() OVER (PARTITION BY query_id ORDER BY r) AS rank
        FROM ranked WHERE r <= 6 AND ad_id <> query_id QUALIFY rank <= 5"""
    same, message = compare(vector_queries.similar_listings(spark, FOLDER), exact, connection)
    assert same, message


def test_ann_topk_recall_over_its_own_queries(spark, connection):
    asked = f"""SELECT CAST(label AS BIGINT) AS query_id, centroid AS q FROM centroids
        UNION ALL SELECT query_id + 1000, q FROM ({FIRST_CHUNKS})"""
    near = connection.execute(f"""{vector_queries._BASE}, {vector_queries._distances(queries=asked)}
        SELECT query_id, chunk_id FROM {vector_queries._top(20)}""").fetchall()
    found = {(r["query_id"], r["chunk_id"]) for r in vector_queries.ann_topk(spark, FOLDER).collect()}
    assert len(found & set(near)) / len(near) >= 0.9
