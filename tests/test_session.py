import pytest

from eventmere import session
from eventmere.sources import paths


def test_shared_folder_is_the_one_the_session_names(spark):
    assert paths.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert paths.fresh_folder(spark, "x") != paths.fresh_folder(spark, "x")


class Unset:
    """A session that names no folder."""

    class conf:
        @staticmethod
        def get(key, default):
            return default

    class sparkContext:
        master = "spark://host:7077"
        applicationId = "app-1"


def test_a_cluster_must_name_a_shared_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        paths.shared_folder(Unset)


def test_scale_settings_keep_adaptive_plans_on():
    assert session.SCALE_SETTINGS["spark.sql.adaptive.enabled"] == "true"
    assert session.SCALE_SETTINGS["spark.sql.adaptive.skewJoin.enabled"] == "true"
    assert session.RESULT_SETTINGS["spark.sql.session.timeZone"] == "UTC"
