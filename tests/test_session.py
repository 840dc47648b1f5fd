from __future__ import annotations

import subprocess
import sys
import textwrap

import pytest

from feedmart.session import reused, work_dir


def test_shared_folder_comes_from_the_session(tmp_path):
    """In a session of its own, since the setting cannot change later."""
    code = f"""
        from pyspark.sql import SparkSession
        from feedmart.session import work_dir
        spark = (SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false")
                 .config("spark.checkpoint.dir", "{tmp_path}").getOrCreate())
        one, two = work_dir(spark, "a"), work_dir(spark, "a")
        assert one.startswith("{tmp_path}/a-") and one != two, one
    """
    subprocess.run([sys.executable, "-c", textwrap.dedent(code)], check=True, timeout=120)


def test_a_cluster_must_name_its_folder():
    class Conf:
        def get(self, name, default):
            return default

    class Context:
        master = "spark://host:7077"

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError):
        work_dir(Session(), "a")


def test_reused_frames_are_let_go(spark):
    df = spark.range(3)
    with pytest.raises(RuntimeError):
        with reused(df) as kept:
            assert kept.is_cached
            raise RuntimeError
    assert not df.is_cached
