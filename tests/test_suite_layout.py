"""The suite itself: every module can be imported under its own name."""

import re
from collections import Counter
from pathlib import Path

HERE = Path(__file__).resolve().parent


def test_no_two_modules_share_a_name():
    names = Counter(p.stem for p in HERE.rglob("*.py") if p.name != "conftest.py")
    assert [n for n, times in names.items() if times > 1] == []


def test_nothing_imports_from_a_conftest():
    pattern = re.compile(r"^\s*(from|import) conftest\b", re.M)
    assert [p.name for p in HERE.rglob("*.py") if pattern.search(p.read_text())] == []
