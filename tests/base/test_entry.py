"""The package stands without its optional part."""

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[2]


def test_nothing_but_the_entry_knows_the_optional_part():
    for path in (ROOT / "onomast").rglob("*.py"):
        if "llm" not in path.relative_to(ROOT).parts:
            assert "onomast.llm" not in path.read_text(encoding="utf-8"), path


def test_entry_imports_without_it(tmp_path):
    for name in ("onomast", "__spark_entry__.py"):
        source = ROOT / name
        if source.is_dir():
            for p in source.rglob("*.py"):
                rel = p.relative_to(ROOT)
                if "llm" not in rel.parts:
                    (tmp_path / rel).parent.mkdir(parents=True, exist_ok=True)
                    (tmp_path / rel).write_text(p.read_text(encoding="utf-8"), encoding="utf-8")
        else:
            (tmp_path / name).write_text(source.read_text(encoding="utf-8"), encoding="utf-8")
    code = "import __spark_entry__ as e; q = e.queries(); assert q and not any(n.startswith('op') for n in q); assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={"PATH": "/usr/bin:/bin", "HOME": str(tmp_path)})
