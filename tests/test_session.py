import pytest
from helpers import settings

from bankmart.session import SPLIT_BYTES, folder_bytes, size_for, sizes

TB = 1024**4
INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


@pytest.mark.parametrize(
    "size, split, partitions",
    [
        (0, SPLIT_BYTES, 1),
        (SPLIT_BYTES + 1, SPLIT_BYTES, 2),
        (TB, SPLIT_BYTES, 8192),
        (100 * TB, -(-100 * TB // 100_000), 50_000),
    ],
)
def test_sizes(size, split, partitions):
    assert sizes(size) == (split, partitions)


def test_settings_are_only_raised(spark):
    with settings(spark, spark_sql_files_maxPartitionBytes=spark.conf.get("spark.sql.files.maxPartitionBytes")):
        size_for(spark, 1000)
        assert spark.conf.get(INITIAL, None) is None
        size_for(spark, 100 * TB)
        assert spark.conf.get(INITIAL) == "50000"
        spark.conf.unset(INITIAL)


def test_folder_bytes(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x").write_text("12345")
    (tmp_path / "y").write_text("123")
    assert folder_bytes(spark, str(tmp_path)) == 8
