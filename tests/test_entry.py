import subprocess
import sys
import textwrap

import __spark_entry__ as entry


def test_queries_have_their_sql():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).columns[0] == "title"


def test_imports_without_the_llm_package():
    code = """
        import importlib.abc, sys
        class Gone(importlib.abc.MetaPathFinder):
            def find_spec(self, name, path=None, target=None):
                if name.startswith(("cuewright.llm", "corpus_pipeline")):
                    raise ModuleNotFoundError(name)
        sys.meta_path.insert(0, Gone())
        import __spark_entry__ as e
        assert "qa_summary" in e.queries() and not any(q.startswith("op") for q in e.queries())
        assert "pipeline" not in e.queries() and e.oracle_sql()
    """
    subprocess.run([sys.executable, "-c", textwrap.dedent(code)], check=True)
