import os

from linkweave.session import discard, is_local_master, materialize


def test_only_local_masters_may_lack_a_shared_folder():
    assert is_local_master("local") and is_local_master("local[*]") and is_local_master("local[4, 2]")
    assert not any(map(is_local_master, ("local-cluster[2,1,1024]", "yarn", "spark://h:7077", "k8s://x")))


def test_discard_removes_a_written_table(spark):
    out = materialize(spark.range(10), "t")
    folder = out.written_path.removeprefix("file:")
    assert os.path.isdir(folder)
    discard(out)
    assert not os.path.exists(folder)
