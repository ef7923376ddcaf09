from types import SimpleNamespace

import pytest

from palisade import session


def stub(master, setting=None):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: setting if key == "spark.checkpoint.dir" else default),
        sparkContext=SimpleNamespace(master=master, applicationId=f"app-{master}"),
    )


def test_the_configured_folder_is_used_everywhere():
    for master in ("local[2]", "yarn"):
        spark = stub(master, "/shared/checkpoints/")
        assert session.shared_folder(spark) == "/shared/checkpoints/"
        assert session.scratch_path(spark, "t").startswith("/shared/checkpoints/palisade/t-")


def test_the_warehouse_stands_in_for_written_results():
    for master in ("local[2]", "yarn"):
        assert session.shared_folder(stub(master)) is None
    spark = stub("yarn")
    spark.conf.get = lambda key, default: "/warehouse" if key == "spark.sql.warehouse.dir" else default
    assert session.scratch_path(spark, "t").startswith("/warehouse/palisade/t-")
    with pytest.raises(ValueError):
        session.scratch_path(stub("yarn"), "t")


def test_tables_without_a_shared_folder_are_persisted(spark, monkeypatch):
    monkeypatch.setattr(session, "shared_folder", lambda _: None)
    df = session.cut_lineage(spark.range(10))
    assert df.storageLevel.useMemory and df.count() == 10
    df.unpersist()
    assert session.use_checkpoints(spark) is False


def test_lookup_size_is_checked(spark):
    small, fits = session.settle_small(spark.range(5), 5)
    large, fits_too = session.settle_small(spark.range(6), 5)
    assert fits and not fits_too and small.count() == 5 and large.count() == 6
