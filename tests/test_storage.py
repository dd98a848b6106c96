import pytest

from rowgate import storage


def test_folders_must_be_shared():
    assert storage.checked_dir("local[4]", None) is None
    assert storage.checked_dir("local[4]", "file:/tmp/x") == "file:/tmp/x"
    assert storage.checked_dir("spark://h:7077", "hdfs://h/x") == "hdfs://h/x"
    for master, root in (("spark://h:7077", None), ("yarn", None), ("yarn", "file:///x"), ("local-cluster[2,1,1024]", None)):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            storage.checked_dir(master, root)


def test_scope_removes_what_it_wrote(spark):
    with storage.scope(spark):
        inside = storage.cut(spark.range(5))
        files = inside.inputFiles()
        assert inside.count() == 5
    outside = storage.cut(spark.range(5))
    assert outside.count() == 5
    where = spark._jvm.org.apache.hadoop.fs.Path(files[0])
    assert not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)
