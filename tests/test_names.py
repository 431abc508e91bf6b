"""No module gives one name to two functions: the second would hide the first."""

import ast
import collections
import pathlib

import pytest

ROOT = pathlib.Path(__file__).resolve().parent.parent
FILES = [f for f in sorted([*ROOT.glob("*.py"), *ROOT.glob("footfall/**/*.py"), *ROOT.glob("tests/**/*.py")])]


@pytest.mark.parametrize("file", FILES, ids=lambda f: str(f.relative_to(ROOT)))
def test_names_are_given_once(file):
    names = [n.name for n in ast.parse(file.read_text()).body if isinstance(n, (ast.FunctionDef, ast.ClassDef))]
    assert [n for n, times in collections.Counter(names).items() if times > 1] == []
