import os

import duckdb
import pytest

import __spark_entry__ as entry
from tools.check_oracles import canonical
from verification.fixtures import TABLES

SMALL = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="needs the given tables")
SAMPLE = [
    "crawl_plan", "harvest_links", "frontier_topk", "page_extract", "trail_page_texts", "document_rules", "track_resample_coarse",
    "track_grade", "radius_candidates", "match_best_low_stop", "score_ridge", "state_upsert", "upsert_trails", "failed_spike",
]


def test_every_check_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_sql(spark, name):
    db = duckdb.connect()
    for t in TABLES:
        db.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    assert canonical(entry.queries()[name](spark, SMALL).toPandas()) == canonical(db.sql(entry.oracle_sql()[name]).df())
