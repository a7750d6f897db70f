"""Registered queries: contract columns on the smallest tables, and their SQL counterparts."""

import pytest

from checks import compare
from duologue.llm import queries

FOLDER = "/root/testdata/sf0.001"
COLUMNS = {
    "op1": "page_id bigint, host string, path string, rule string, verdict string",
    "op2": "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string",
    "op3": "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double",
    "op4": "query_id bigint, rank int, vec_id bigint, score bigint",
    "op5": "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean",
    "op6": "doc_id bigint, fingerprint string, component_id bigint",
    "op7": "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint",
    "op8": "doc_id bigint, size bigint, source_size bigint, target double, taken bigint",
    "op9": "doc_id bigint, held_out boolean, lang_pred string, score double",
    "op10": "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint",
    "op11": "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint",
    "op12": "lang string, rank bigint, phrase string, a bigint, l bigint, r bigint, n bigint, score bigint",
    "op13": "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string",
}


@pytest.mark.parametrize("name", list(queries.queries()))
def test_columns_and_rows(spark, name):
    df = queries.queries()[name](spark, FOLDER)
    kinds = dict(df.dtypes)
    for column in COLUMNS[name.split("_")[0]].split(", "):
        c, kind = column.split()
        assert kinds[c] == kind, c
    rows = df.collect()
    table = {"op1": "pages", "op7": "pages"}.get(name.split("_")[0], "documents")
    if name.startswith(("op4", "op12")):
        assert len(rows) > 0
    elif name.startswith("op13"):
        assert len(rows) == spark.read.parquet(f"{FOLDER}/conversations.parquet").select("conv_id").distinct().count()
    elif name.startswith(("op10", "op11")):
        assert {r.doc_id for r in rows} == {r.doc_id for r in spark.read.parquet(f"{FOLDER}/{table}.parquet").select("doc_id").collect()}
    else:
        assert len(rows) == spark.read.parquet(f"{FOLDER}/{table}.parquet").count()


@pytest.mark.parametrize("name", list(queries.oracle_sql()))
def test_sql(spark, name):
    result = compare.connect(FOLDER).execute(queries.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    df = queries.queries()[name](spark, FOLDER)
    assert sorted(columns) == sorted(df.columns)
    assert compare.rows(df.columns, df.collect()) == compare.rows(columns, result.fetchall())
