"""Physical-plan checks: the scale properties the design relies on."""

import contextlib
import io
import re

from conftest import SF001
import __spark_entry__ as E
from tabfold.operators import folds as K
from tabfold.sources.tables import read_table

Q = E.queries()


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def read_schemas(p: str) -> list[str]:
    return re.findall(r"ReadSchema: (struct<[^\n]*>)", p)


def test_kfold_is_narrow(spark):
    p = plan(K.kfold(read_table(spark, SF001, "orders"), "o_orderkey", 5))
    assert "Exchange" not in p


def test_projection_pruned_to_used_columns(spark):
    p = plan(Q["q_ordinal_encode"](spark, SF001))
    assert read_schemas(p) == ["struct<o_orderkey:bigint,o_orderpriority:string>"]
    p = plan(Q["q_products_ratios"](spark, SF001))
    (rs,) = read_schemas(p)
    assert "l_shipdate" not in rs and "l_returnflag" not in rs


def test_aggregations_combine_before_shuffle(spark):
    for name in ("q_value_counts", "q_round_even", "q_missing_profile", "q_fold_sizes"):
        p = plan(Q[name](spark, SF001))
        assert "partial_" in p, name


def test_stratified_folds_shuffle_data_once(spark):
    o = read_table(spark, SF001, "orders").select("o_orderkey", "o_orderstatus")
    p = plan(K.stratified_kfold(o, "o_orderkey", "o_orderstatus", 5))
    big = [m for m in re.findall(r"hashpartitioning\(([^)]*)\)", p) if "_salt" in m]
    assert big, p
    # the numbering window is partitioned by (class, salt), never by class alone
    assert re.search(r"row_number\(\) windowspecdefinition\(_lab#\d+, _salt#\d+", p)


def test_coefficients_are_broadcast(spark):
    from tabfold.plans.q_flagship import oof_linear
    p = plan(oof_linear(spark, SF001))
    assert "BroadcastHashJoin" in p or "BroadcastExchange" in p


def test_text_cleaning_has_no_python_udf(spark):
    p = plan(Q["q_clean_text"](spark, SF001))
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p and "PythonUDF" not in p


def test_size_for_input(spark):
    from tabfold.session import input_bytes, size_for_input
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        n = input_bytes(spark, [f"{SF001}/lineitem.parquet"])
        assert n > 0
        assert size_for_input(spark, 100 * (1 << 40)) == 100 * 4 * 1024     # 100 TiB / 256 MiB
        assert size_for_input(spark, n) == 200
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
