"""The driver's entry module works with and without the optional part."""
import subprocess
import sys
import os

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_imports_without_the_optional_part():
    code = ("import sys; sys.modules['chirpwave.llm'] = None; sys.modules['corpus_pipeline'] = None\n"
            "import __spark_entry__ as e; q = e.queries(); assert 'trending_topics' in q and len(q) == len(e.oracle_sql()); print(len(q))")
    out = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True)
    assert out.returncode == 0 and int(out.stdout) >= 34, out.stderr


def test_a_fault_inside_the_optional_part_is_not_hidden():
    code = "import sys; sys.modules['xxhash'] = None\nimport __spark_entry__"
    out = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True)
    if os.path.isdir(os.path.join(ROOT, "chirpwave", "llm")):
        assert out.returncode != 0 and "xxhash" in out.stderr


def test_nothing_else_imports_the_optional_part():
    for folder, _, names in os.walk(os.path.join(ROOT, "chirpwave")):
        if os.path.basename(folder) == "llm":
            continue
        for name in names:
            if name.endswith(".py"):
                text = open(os.path.join(folder, name), encoding="utf-8").read()
                assert "chirpwave.llm" not in text and "from .llm" not in text and "corpus_pipeline" not in text, name
