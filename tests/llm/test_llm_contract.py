"""The registered queries of the package, and what they say of the driver's tables."""

import os
import zlib

import pytest

import __spark_entry__ as contract

SF_DIR = "/root/testdata/sf0.001"
COLUMNS = {
    "op1": ["query_id", "rank", "vec_id", "score"],
    "op2": ["page_id", "host", "path", "rule", "verdict"],
    "op3": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op4": ["doc_id", "held_out", "score", "predicted"],
    "op5": ["doc_id", "held_out", "lang_pred", "score"],
    "op6": ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
    "op7": ["doc_id", "class_id", "n_links"],
    "op8": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
    "op9": ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
    "op10": ["doc_id", "held_out", "score", "predicted"],
    "op11": ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"],
    "op12": ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
    "op13": ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"],
}
NAMES = {name.split("_")[0]: name for name in contract.queries() if name.startswith("op") and name[2].isdigit()}


def test_one_query_per_operator():
    assert set(NAMES) == set(COLUMNS) and "pipeline" in contract.queries()


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="needs the driver's tables")
@pytest.mark.parametrize("op", COLUMNS)
def test_query_has_its_columns_and_a_row_per_row(spark, op):
    frame = contract.queries()[NAMES[op]](spark, SF_DIR)
    assert set(COLUMNS[op]) <= set(frame.columns)
    rows = frame.collect()
    if op in ("op1", "op6", "op12"):
        assert rows
        return
    table, key = {"op2": ("pages", "page_id"), "op13": ("embeddings", "vec_id")}.get(op, ("documents", "doc_id"))
    assert sorted(r[key] for r in rows) == sorted(r[0] for r in spark.read.parquet(f"{SF_DIR}/{table}.parquet").select(key).collect())
    folds = {"op4": (5, 0), "op5": (4, 2), "op9": (5, 1), "op10": (5, 0)}
    if op in folds:
        folds, out = folds[op]
        assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % folds == out) for r in rows)
