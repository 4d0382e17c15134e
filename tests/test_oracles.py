"""Registered queries against their SQL in DuckDB, on the smallest tables."""

import datetime
import decimal
import glob
import math
import os

import duckdb
import pytest

from tarnlake.plans.all import ORACLE_SQL, QUERIES

#: One or more of every family; the driver compares all of them.
NAMES = ["rd_rate", "rd_gate", "rd_ladder", "rd_events", "rd_signals", "cg_gap", "dm_patient_360", "dm_dim_date", "mt_kpi_tiles", "mt_separates", "dq_quarantine", "dq_gate_row", "dq_reconcile", "pv_deid_patient", "pv_complementary", "pv_secondary_interval", "pv_kanon", "dr_report", "ml_evaluate", "tx_score", "wn_nonoverlap_greedy", "ag_rollup", "fn_date", "st_except_all",
         "src_schema_evolve", "sm_incremental_files", "src_json_bundle", "snk_replace_where", "src_before_copy", "src_profile", "pv_tag_drift", "dq_contract", "dq_result_match", "dq_fingerprint",
         "tx_answer_key", "tx_detect_pattern", "tx_detect_tokens", "tx_parse_replies", "udf_spans_for", "rt_window_scores", "rt_decide", "rt_replay", "rt_champion_meta", "dr_report_years", "ml_batch_score",
         "ml_features", "ml_population", "dm_facts", "dm_patient", "mt_findings", "pv_publish_guard", "pv_publish_model", "pv_publish_retrain", "so_order_nulls", "ag_quantile", "ag_average_precision",
         "tx_patient_spans", "pv_deid_note", "udf_deid_text", "rt_history_report", "ml_window_probe", "ml_verdict", "ml_cluster_bootstrap", "ml_cut_bootstrap", "rt_ranking_guard", "mt_eval_report", "snk_materialized_view", "dm_fact_star"]


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}") + 0.0
    if isinstance(v, decimal.Decimal):
        return float(f"{float(v):.12g}") + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v.replace(tzinfo=None) if isinstance(v, datetime.datetime) else v


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for f in glob.glob(f"{sf}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_its_sql(spark, sf, duck, name):
    got = QUERIES[name](spark, sf)
    columns = sorted(got.columns)
    ran = duck.execute(ORACLE_SQL[name])
    names = [c[0] for c in ran.description]
    assert sorted(names) == columns
    want = sorted(repr(tuple(plain(r[names.index(c)]) for c in columns)) for r in ran.fetchall())
    assert sorted(repr(tuple(plain(r[c]) for c in columns)) for r in got.collect()) == want
