import subprocess
import sys

import __spark_entry__ as entry


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() >= 0
    assert "visit_occurrence_id" in df.columns and "Mean_value" in df.columns


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) >= 100


def test_other_queries_load_without_a_text_dependency():
    """A package that only the text subpackage needs is hidden in a fresh interpreter."""
    code = ("import sys; sys.modules['tokenizers'] = sys.modules['public_tokenizers'] = sys.modules['xxhash'] = None\n"
            "import __spark_entry__ as e; q = e.queries(); assert len(q) > 100 and not any(k.startswith('op') for k in q)\n"
            "assert set(e.oracle_sql()) <= set(q)")
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=entry.__file__.rsplit("/", 1)[0])
    assert done.returncode == 0, done.stderr
