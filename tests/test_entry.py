"""The driver's entry without the corpus operators."""

import importlib
import sys

import __spark_entry__ as entry


def test_entry_without_the_corpus_operators(monkeypatch):
    real = importlib.import_module

    def missing(name, *args):
        if name.startswith(("telesift.llm", "corpus_pipeline")):
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)
        return real(name, *args)

    monkeypatch.setattr(entry.importlib, "import_module", missing)
    names = entry.queries()
    assert "search_traces_by_matches" in names and "pipeline" not in names
    assert set(entry.oracle_sql()) <= set(names)


def test_other_import_errors_are_not_swallowed(monkeypatch):
    def broken(name, *args):
        if name == "telesift.llm.queries":
            raise ModuleNotFoundError("No module named 'tokenizers'", name="tokenizers")
        return sys.modules.get(name) or __import__(name)

    monkeypatch.setattr(entry.importlib, "import_module", broken)
    try:
        entry._corpus()
    except ModuleNotFoundError as error:
        assert error.name == "tokenizers"
    else:
        raise AssertionError("a missing dependency went unseen")
