"""The module of registered queries itself."""

from __future__ import annotations

import ast
from collections import Counter
from pathlib import Path

from headway.plans import queries as registered


def test_no_function_of_the_module_is_defined_twice():
    body = ast.parse(Path(registered.__file__).read_text()).body
    defined = Counter(node.name for node in body if isinstance(node, ast.FunctionDef))
    assert [name for name, times in defined.items() if times > 1] == []
