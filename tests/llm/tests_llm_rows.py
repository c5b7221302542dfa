"""The rows of conftest.py for the tests that compute their own answers."""

import importlib.util
from pathlib import Path

_spec = importlib.util.spec_from_file_location("llm_rows", Path(__file__).with_name("conftest.py"))
_module = importlib.util.module_from_spec(_spec)
_spec.loader.exec_module(_module)
edge_rows, words, SCHEMA = _module.edge_rows, _module.words, _module.SCHEMA
