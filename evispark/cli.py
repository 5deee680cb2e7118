"""Command line: python -m evispark.cli {parse,organise,publish,batch,republish,query} ..."""

from __future__ import annotations

import argparse
from collections.abc import Callable

from evispark import config
from evispark.operators import readers
from evispark.plans import batch, collection, integration
from evispark.session import session
from evispark.sources import files


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="evispark")
    p.add_argument("--master")
    sub = p.add_subparsers(dest="command", required=True)
    for name, words in (("parse", "decks to elements as Parquet"), ("organise", "decks to blocks, ledger and decisions"), ("publish", "decks to a site of Markdown pages"), ("batch", "all of it")):
        s = sub.add_parser(name, help=words)
        s.add_argument("input", help="a folder of decks, or one deck")
        s.add_argument("output")
        s.add_argument("--config", help="settings in YAML; with a model's address topics, entities and relationships are integrated")
    r = sub.add_parser("republish", help="a site from the pages of an earlier batch, without models")
    r.add_argument("input")
    r.add_argument("output")
    q = sub.add_parser("query", help="a registered query over a folder of tables")
    q.add_argument("name")
    q.add_argument("tables")
    q.add_argument("--rows", type=int, default=20)
    return p


def backend_of(api: dict) -> Callable[[], readers.ChatBackend]:
    """Makes the configured model's client, in each task. The key goes with it to executors."""
    key = config.secret(api)
    return lambda: readers.HttpBackend(api["base_url"], api["model"], api["timeout_seconds"], key=key)


def main(argv: list[str] | None = None, backend: Callable[[], readers.ChatBackend] | None = None, reader: Callable[[], readers.ReaderBackend] | None = None) -> int:
    """Run a command. backend, reader: a model and a reader of pictures in place of the configured ones."""
    args = parser().parse_args(argv)
    spark = session(master=args.master)
    if args.command == "query":
        from evispark.queries import QUERIES

        QUERIES[args.name](spark, args.tables).show(args.rows, truncate=80)
        return 0
    if args.command == "parse":
        collection.read(spark, args.input)[2].write.mode("errorifexists").parquet(args.output)
        return 0
    if args.command == "republish":
        batch.again(spark, args.input, args.output)
        return 0
    settings = config.loaded(args.config) if args.config else config.parsed({"version": 2})
    if backend is None and settings["llm_api"]["base_url"]:
        backend = backend_of(settings["llm_api"])
    if args.command == "batch":
        batch.run(spark, args.input, args.output, settings, backend, reader)
        return 0
    files.separate(spark, args.input, args.output)
    found = batch.collected(spark, args.input, settings, reader)
    if args.command == "organise":
        collection.export(found, args.output)
    else:
        whole = integration.integrate(found, backend, batch.options_of(settings)) if backend is not None else None
        batch.site(found, whole, None, args.output)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
