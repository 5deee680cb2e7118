"""Evidence analytics on Spark. The names below are the package's public ones; each is imported when it is first used."""

from importlib import import_module

_HOME = {
    "Collection": "plans.collection", "Integrated": "plans.integration", "Options": "plans.stages", "Semantic": "plans.stages",
    "ConfigError": "config", "CheckError": "operators.checks", "ReaderError": "plans.models",
    "ChatBackend": "operators.readers", "ReaderBackend": "operators.readers", "HttpBackend": "operators.readers", "ScriptedBackend": "operators.readers",
    "CommandReader": "plans.models", "FallbackReader": "plans.models", "DeckSource": "sources.ooxml",
    "loaded": "config", "discover": "sources.files", "deck_elements": "sources.ooxml",
    "collect": "plans.collection", "to_blocks": "plans.collection", "organise": "plans.stages", "integrate": "plans.integration",
    "run": "plans.batch", "again": "plans.batch", "reader_of": "plans.pictures", "Reading": "plans.collection", "Run": "plans.runs", "decks": "sources.ooxml", "ImageReader": "operators.readers",
    "fail_closed": "operators.checks", "request_numbers": "functions.requests", "register": "functions.udfs",
}
__all__ = sorted(_HOME)
__version__ = "0.2.0"


def __getattr__(name: str):
    if name not in _HOME:
        raise AttributeError(name)
    return getattr(import_module(f"evispark.{_HOME[name]}"), name)
