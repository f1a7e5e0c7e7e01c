"""The registered queries: names, columns, and SQL where there is some, on the smallest tables."""

import os

import pytest

from quadrille.llm import queries as llm

DATA = "/root/testdata/sf0.001"
COLUMNS = {
    1: {"doc_id", "n_words", "n_removed", "kept_sha256"},
    2: {"page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"},
    3: {"doc_id", "class_id"},
    4: {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"},
    5: {"query_id", "rank", "vec_id", "score"},
    6: {"page_id", "host", "path", "rule", "verdict"},
    7: {"doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"},
    8: {"doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"},
    9: {"doc_id", "held_out", "score", "predicted"},
    10: {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"},
}

OPERATORS = [n for n in llm.queries() if n.startswith("op") and n[2].isdigit()]
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables")


def test_one_query_for_each_operator():
    assert [int(n[2:].split("_")[0]) for n in OPERATORS] == list(range(1, 11))


@pytest.mark.parametrize("name", OPERATORS)
def test_rows_and_columns(spark, name):
    got = llm.queries()[name](spark, DATA)
    assert COLUMNS[int(name[2:].split("_")[0])] <= set(got.columns)
    n = got.count()
    docs = spark.read.parquet(f"{DATA}/documents.parquet").count()
    pages = spark.read.parquet(f"{DATA}/pages.parquet").count()
    number = int(name[2:].split("_")[0])
    assert n >= docs if number == 4 else n == (pages if number in (2, 6) else docs) or number == 5 and n % 10 == 0


@pytest.mark.parametrize("name", list(llm.oracle_sql()))
def test_query_equals_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    got = llm.queries()[name](spark, DATA)
    columns = sorted(got.columns)
    want = con.sql(llm.oracle_sql()[name]).select(", ".join(columns)).fetchall()
    assert sorted(map(repr, (tuple(r[c] for c in columns) for r in got.collect()))) == sorted(map(repr, want))
