"""Every query with a SQL text is run on the smallest tables and compared with it row by row."""

import math
import os

import pytest

import __spark_entry__ as entry_points

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
# A spread over all parts of the catalog; the whole catalog is compared by the driver at a larger size.
SAMPLE = [
    "src_glob_econ", "src_explode_cube", "src_term_structure", "sink_upsert_predictions", "sink_get_or_create_dim",
    "prep_default_fill", "proj_forecast_date", "win_lead_label_12", "win_current_previous_event", "agg_data_profile",
    "agg_class_weights", "join_merge_predictions", "join_calendar_spine", "split_expanding_kfold", "split_window_guards",
    "met_ovo", "met_12m_series", "met_series_by_econ", "met_quality_table", "bt_relational_core", "attr_feature_stability",
    "attr_rank_evolution", "stream_completeness", "stream_daily_drop",
]

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="tables are not here")


@pytest.fixture(scope="module")
def database():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for name in TABLES.split():
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return int(value) if isinstance(value, bool) else value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((v is None, str(type(v)) if v is None else "", 0 if v is None else v) for v in r))


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_sql(spark, database, name):
    df = entry_points.queries()[name](spark, FOLDER)
    relation = database.sql(entry_points.oracle_sql()[name])
    assert sorted(df.columns) == sorted(relation.columns)
    assert _rows(df.columns, df.collect()) == _rows(relation.columns, relation.fetchall())


def test_entry_and_catalog(spark):
    assert entry_points.entry(spark).count() > 0
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
    assert len(entry_points.queries()) > 115
