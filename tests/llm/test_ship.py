"""Python code reaches executors that do not have the package."""

import subprocess
import sys
import textwrap
from pathlib import Path

ROOT = Path(__file__).resolve().parents[2]


def test_a_session_started_elsewhere(tmp_path):
    code = textwrap.dedent(f"""
        import sys
        sys.path.insert(0, {str(ROOT)!r})
        import __spark_entry__ as e
        from wardstream.session import local_session
        spark = local_session("elsewhere", 2, "1g")
        n = e.queries()["op10_piece_transducer"](spark, "/root/testdata/sf0.001").count()
        print("ROWS", n)
        spark.stop()
    """)
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert "ROWS 200" in done.stdout, done.stderr[-2000:]


def test_the_library_stands_without_this_subpackage(tmp_path):
    """A copy without the optional folders still offers its own queries."""
    import shutil

    for name in ("wardstream", "__spark_entry__.py"):
        source = ROOT / name
        if source.is_dir():
            shutil.copytree(source, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
        else:
            shutil.copy(source, tmp_path / name)
    code = "import __spark_entry__ as e; print('N', len(e.queries()), len(e.oracle_sql()), any(k.startswith('op') for k in e.queries()))"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120, env={"PATH": "/usr/bin:/bin"})
    assert done.stdout.startswith("N ") and "False" in done.stdout, done.stderr[-2000:]
