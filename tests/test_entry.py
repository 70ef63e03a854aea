"""The entry module works with and without the training-data operators."""
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]


@pytest.mark.parametrize("missing", ["docnorm.llm", "corpus_pipeline"])
def test_entry_imports_without_optional_parts(missing):
    code = (f"import sys; sys.modules['{missing}'] = None; import __spark_entry__ as e; "
            "print(len(e.queries()), any(n.startswith('op1_') for n in e.queries()))")
    out = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120, check=True)
    count, present = out.stdout.split()
    assert int(count) >= 112 and present == "False"


def test_other_import_errors_are_not_hidden():
    code = "import sys; sys.modules['xxhash'] = None; import __spark_entry__"
    out = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120, check=False)
    assert (out.returncode != 0) == (ROOT / "docnorm/llm").is_dir()
