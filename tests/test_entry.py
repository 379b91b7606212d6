"""The driver contract: every query of the core has its SQL, and none needs what only the optional subpackage needs."""

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent


def counted(hidden: str) -> int:
    code = (f"import sys; sys.path.insert(0, {str(ROOT)!r}); sys.modules[{hidden!r}] = None\n"
            "import __spark_entry__ as E\nprint(len(E.queries()), set(E._own_queries()) == set(E._own_oracle_sql()))")
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True).stdout.split()
    assert out[1] == "True"
    return int(out[0])


def test_core_queries_without_the_subpackage_or_a_library_of_it():
    core = counted("tidemark.llm")
    assert core >= 65
    assert counted("tiktoken") == core and counted("xxhash") == core
