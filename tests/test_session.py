import pytest

from quarry import session


@pytest.mark.parametrize("master", ["spark://host:7077", "yarn", "local-cluster[2,1,1024]", "k8s://x"])
def test_a_cluster_without_a_shared_folder_raises(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session._local_folder(master)


def test_dropped_tables_leave_nothing(spark):
    kept, gone = (session.materialize(spark.range(10), n) for n in ("kept", "gone"))
    assert session.path_exists(spark, kept._scratch) and kept.count() == 10
    session.forget(gone)
    assert not session.path_exists(spark, gone._scratch)
    assert kept._scratch in session._scratch and gone._scratch not in session._scratch
    session.forget(kept)
    assert not session.path_exists(spark, kept._scratch)
