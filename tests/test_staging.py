from pathlib import Path
from types import SimpleNamespace

import pytest

from quillmill import staging


def test_clear_staging(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(staging, "staging_root", lambda session: str(tmp_path))
    table, rows = staging.stage_counted(spark.range(7), "numbers")
    assert (rows, table.count()) == (7, 7)
    staging.clear_staging(spark)
    assert not list(Path(tmp_path).rglob("*.parquet"))


def test_size_shuffles(spark):
    spark.conf.unset(staging.INITIAL_PARTITIONS)
    try:
        staging.size_shuffles(spark, 100)
        assert spark.conf.get(staging.INITIAL_PARTITIONS, None) is None
        staging.size_shuffles(spark, 10 * 2**40)
        assert spark.conf.get(staging.INITIAL_PARTITIONS, None) == "163840"
        staging.size_shuffles(spark, 20 * 2**40)
        assert spark.conf.get(staging.INITIAL_PARTITIONS, None) == "327680"
        staging.size_shuffles(spark, 100)
        assert spark.conf.get(staging.INITIAL_PARTITIONS, None) is None
        spark.conf.set(staging.INITIAL_PARTITIONS, "11")
        staging.size_shuffles(spark, 20 * 2**40)
        assert spark.conf.get(staging.INITIAL_PARTITIONS, None) == "11"
    finally:
        spark.conf.unset(staging.INITIAL_PARTITIONS)


def test_a_cluster_needs_a_shared_folder():
    context = SimpleNamespace(master="spark://host:7077", getConf=lambda: SimpleNamespace(get=lambda name: None), getCheckpointDir=lambda: None)
    session = SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda name, default: default))
    with pytest.raises(ValueError, match="checkpoint"):
        staging.staging_root(session)
