"""Every operator has its query, and the rest of the library works without this subpackage."""
import ast
from pathlib import Path

import __spark_entry__ as entry

ROOT = Path(__file__).resolve().parents[2]


def test_one_query_for_each_operator():
    names = [n for n in entry.queries() if n.startswith("op") and n[2].isdigit()]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in entry.queries()
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_nothing_else_imports_it():
    for p in (ROOT / "halocline").rglob("*.py"):
        if "llm" not in p.parts:
            for node in ast.walk(ast.parse(p.read_text())):
                name = getattr(node, "module", None) or ",".join(a.name for a in getattr(node, "names", []) if hasattr(a, "name"))
                assert "halocline.llm" not in (name or "")
