"""The checkpoint folder where the platform names none, names one, or sets one on the context."""
import os
import subprocess
import sys
import tempfile
import textwrap

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def run(code, **conf):
    """``code`` in a process of its own, with an empty Spark conf folder."""
    env = {k: v for k, v in os.environ.items() if k != "SPARK_CONF_DIR"}
    env |= {"SPARK_CONF_DIR": tempfile.mkdtemp(prefix="pasture-conf-"), "PYTHONPATH": ROOT}
    r = subprocess.run([sys.executable, "-c", textwrap.dedent(code)], env=env, capture_output=True, text=True, timeout=300)
    assert r.returncode == 0, r.stderr[-2000:]
    return r.stdout.strip().splitlines()


def test_folder_is_made_kept_and_qualified():
    out = run("""
        from pasture.session import build_session, ensure_checkpoint_dir
        s = build_session("local[1]", shuffle_partitions=1)
        a, b = ensure_checkpoint_dir(s), ensure_checkpoint_dir(s)
        assert s.conf.get("spark.checkpoint.dir", None) is None
        print(a == b, a.startswith("file:///"), s.range(3).checkpoint().count())
    """)
    assert out[-1] == "True True 3"


def test_folder_of_the_context_is_used():
    out = run("""
        import tempfile
        from pyspark.sql import SparkSession
        from pasture.session import ensure_checkpoint_dir
        s = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
        d = tempfile.mkdtemp()
        s.sparkContext.setCheckpointDir(d)
        print(d in ensure_checkpoint_dir(s), "://" in ensure_checkpoint_dir(s))
    """)
    assert out[-1] == "True True"


def test_named_folder_wins_and_clusters_must_name_one():
    out = run("""
        from unittest.mock import MagicMock
        import pytest
        from pyspark.sql import SparkSession
        from pasture.session import ensure_checkpoint_dir
        s = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", "/tmp/named").getOrCreate()
        print(ensure_checkpoint_dir(s))
        far = MagicMock()
        far.conf.get.return_value = None
        far.sparkContext.getCheckpointDir.return_value = None
        far.sparkContext.master = "local-cluster[2,1,1024]"
        with pytest.raises(RuntimeError):
            ensure_checkpoint_dir(far)
    """)
    assert out[-1] == "file:///tmp/named"
