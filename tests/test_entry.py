"""The entry point without the training-data operators."""

import sys

import __spark_entry__ as entry


def test_core_queries_survive_a_missing_library(monkeypatch):
    core = {k for k in entry.queries() if not k.startswith(tuple(f"op{n}_" for n in range(1, 14))) and k != "pipeline"}
    for name in [m for m in sys.modules if m == "corpus_pipeline" or m.startswith("leadmill.llm")]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "public_tokenizers", None)        # import raises ImportError
    assert set(entry.queries()) == core
    assert set(entry.oracle_sql()) <= core
