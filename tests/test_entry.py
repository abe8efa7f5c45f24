import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent
BLOCK = """
import sys
class Gone:
    def find_spec(self, name, path=None, target=None):
        if name.split('.')[:2] == ['passledger', 'llm'] or name == 'corpus_pipeline':
            raise ModuleNotFoundError(f'No module named {name!r}', name=name)
sys.meta_path.insert(0, Gone())
import __spark_entry__ as e
assert e.queries() and not [n for n in e.queries() if n[:2] == 'op' and n[2:3].isdigit()] and 'pipeline' not in e.queries()
assert set(e.oracle_sql()) <= set(e.queries())
"""


def test_entry_works_without_the_training_text_subpackage():
    subprocess.run([sys.executable, "-c", BLOCK], cwd=ROOT, check=True)


def test_nothing_else_imports_it():
    for path in (ROOT / "passledger").rglob("*.py"):
        if "llm" not in path.relative_to(ROOT).parts:
            assert "passledger.llm" not in path.read_text()
