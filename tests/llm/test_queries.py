"""Every query that has SQL equals it on the smallest tables; the others have their columns."""

import pytest

from compare import connect, spark_side, sql_side
from refinery.llm.queries import QUERIES
from refinery.llm.sql import SQL

SF_DIR = "/root/testdata/sf0.001"
COLUMNS = {
    "op1": "page_id host path rule verdict score",
    "op2": "doc_id held_out score predicted",
    "op3": "doc_id held_out lang_pred score",
    "op4": "conv_id n_turns turns_sha256 loss_chars loss_sha256 formatted_chars",
    "op5": "doc_id piece start length ids_crc32 sequence_id offset",
    "op6": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op7": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op8": "doc_id n_shingles component_id kept",
    "op9": "vec_id n_links component_id kept",
    "op10": "page_id url text n_chars",
    "op11": "part filter_order step kept removed redundant unique_fails good_lost toxic_lost shapley",
    "op12": "doc_id n_words n_hit n_items items_sha256 contaminated",
    "op13": "doc_id n form prefix_chars middle_chars output_sha256 restored_sha256",
}


def test_one_query_for_each_operator():
    assert sorted(name.split("_")[0] for name in QUERIES) == sorted(COLUMNS)
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    found = QUERIES[name](spark, SF_DIR)
    assert " ".join(found.columns) == COLUMNS[name.split("_")[0]]
    if name in SQL:
        assert spark_side(found) == sql_side(connect(SF_DIR), SQL[name])
    else:
        assert found.count() > 0
