import pytest
from oracle import SF, same

from framelake.plans import workloads

ORACLES = workloads.oracle_sql()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    same(workloads.queries()[name](spark, SF), ORACLES[name])


def test_manifest_document_keeps_nested_nulls(spark):
    got = [r["json"] for r in workloads.manifest_json(spark, SF).collect()]
    assert got and all('"dictionary":"DICT_4X4_250"' in j and "mask_dir" not in j and "sharpness" not in j for j in got)
    assert any('"camera":{"focal_length_35mm":null,"width_px":640' in j for j in got)


@pytest.mark.parametrize("parts", ["1", "17"])
def test_partitions_do_not_matter(spark, parts):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        same(workloads.selection_manifest(spark, SF), ORACLES["selection_manifest"])
        same(workloads.tracking_fold(spark, SF), ORACLES["tracking_fold"])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_entry_runs(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
