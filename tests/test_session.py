"""Work folders come from spark.checkpoint.dir; a temp folder only when unset."""

import pytest

from flowdex import session
from flowdex.functions.text import render_email_content


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _NoContextSession:
    def __init__(self, values):
        self.conf = _Conf(values)

    @property
    def sparkContext(self):
        raise RuntimeError("no SparkContext on this client")


def test_checkpoint_root_prefers_cluster_setting():
    assert session.checkpoint_root(_NoContextSession({"spark.checkpoint.dir": "hdfs://nn/ckpt/"})) == "hdfs://nn/ckpt"


def test_checkpoint_root_falls_back_to_one_temp_folder_on_a_local_master():
    a = session.checkpoint_root(_NoContextSession({"spark.master": "local[2]"}))
    b = session.checkpoint_root(_NoContextSession({"spark.master": "local"}))
    assert a == b and "flowdex-ckpt-" in a


@pytest.mark.parametrize("conf", [{}, {"spark.master": "yarn"}, {"spark.master": "local-cluster[2,1,1024]"}])
def test_checkpoint_root_refuses_local_folder_unless_known_local(conf):
    with pytest.raises(RuntimeError):
        session.checkpoint_root(_NoContextSession(conf))


def test_named_dirs_are_stable(spark):
    assert session.named_dir(spark, "app", "state") == session.named_dir(spark, "app", "state")
    assert session.named_dir(spark, "app", "state").startswith(session.checkpoint_root(spark))


def test_work_dirs_are_fresh(spark):
    one, two = session.work_dir(spark, "x"), session.work_dir(spark, "x")
    assert one != two and one.startswith(session.checkpoint_root(spark))
    assert spark.conf.get("spark.sql.mapKeyDedupPolicy") == "LAST_WIN"


def test_email_content_rendering(spark):
    df = spark.createDataFrame([("body", "TEXT/PLAIN")], "c string, t string")
    assert df.select(render_email_content("c", "t")).first()[0] == "EmailContent(body (...),TEXT/PLAIN)"


def test_document_operators_refuse_another_map_policy(spark):
    from flowdex.operators.documents import prepare_documents
    df = spark.createDataFrame([('{"a":"1","a":"2"}',)], "value string")
    assert prepare_documents(df).first()["doc"] == {"a": "2"}
    spark.conf.set("spark.sql.mapKeyDedupPolicy", "EXCEPTION")
    try:
        with pytest.raises(RuntimeError):
            prepare_documents(df)
        assert spark.conf.get("spark.sql.mapKeyDedupPolicy") == "EXCEPTION"
    finally:
        session.configure(spark)
