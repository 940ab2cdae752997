"""Queries against their SQL on the smallest tables: one or two per family; tools/check_queries.py runs all."""

import duckdb
import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
NAMES = [
    "e01_flagship_label_rates", "d04_match_single", "d08_match_multiclass", "e17_f1_optimal_by_label", "e19_average_precision", "d07_match_required_fields",
    "a01_csv_cell_recovery", "a10_upsert_dataset", "b08_field_filters", "c05_tested_by_all", "e08_averages", "e09_regression", "e27_stratify_equal_height",
    "e32_performance_delta", "f06_carry_forward", "g03_top_k_per_query", "h02_version_diff", "i01_word_error_rate", "i07_bleu", "d24_missed_speech", "d22_keypoint_results",
    "e41_threshold_at_fmr", "k05_user_aggregate",
]


def canon(v):
    if v is None or v != v:
        return "~"
    return repr(round(float(v), 5) + 0.0) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)


@pytest.mark.parametrize("name", NAMES)
def test__query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    df = entry.queries()[name](spark, FOLDER)
    cols = sorted(df.columns)
    cur = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    want = sorted(tuple(canon(dict(zip(names, r))[c]) for c in cols) for r in cur.fetchall())
    assert sorted(tuple(canon(r[c]) for c in cols) for r in df.collect()) == want


def test__entry_and_registry(spark):
    assert entry.entry(spark).columns == ["label", "tp", "fp", "fn", "precision", "recall", "f1"]
    assert set(entry.oracle_sql()) <= set(entry.queries())
