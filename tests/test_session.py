import pytest

from candlewright import session as N


class Bare:
    """Just the two attributes the lookup reads."""

    def __init__(self, master, root=None):
        self.sparkContext = type("Context", (), {"master": master})()
        self.conf = type("Conf", (), {"get": staticmethod(lambda key, default=None: root)})()


def test_the_shared_folder_comes_from_the_session(spark):
    assert N.shared_root(Bare("yarn", "hdfs://shared/cp/")) == "hdfs://shared/cp"
    assert N.shared_root(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    first, second = N.run_folder(spark, "x"), N.run_folder(spark, "x")
    assert first != second and first.startswith(N.shared_root(spark))


def test_no_machine_local_folder_on_a_cluster():
    with pytest.raises(ValueError):
        N.shared_root(Bare("spark://host:7077"))
    assert N.shared_root(Bare("local[2]")) == N.shared_root(Bare("local[2]"))


def test_stream_session_follows_the_cores(spark):
    own = N.stream_session(spark)
    assert own.conf.get("spark.sql.shuffle.partitions") == str(spark.sparkContext.defaultParallelism)
    assert own.conf.get("spark.sql.session.timeZone") == "UTC" and own.sparkContext.applicationId == spark.sparkContext.applicationId
    assert N.shared_root(own) == N.shared_root(spark)
