"""Decks to a site in one call: parse, decide, integrate, document, check, publish; and a site again from a run's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from evispark.operators import checks, readers
from evispark.plans import collection, integration, pictures, publish, runs, semantic, stages
from evispark.session import cut
from evispark.sources import files


def options_of(settings: dict) -> stages.Options:
    own, wiki = settings["semantic"], settings["wiki"]
    return stages.Options(own["prompt_chars"], settings["llm_api"]["max_tokens"], own["repairs"], wiki["max_entities"], own["max_topics"], wiki["max_relationships"])


def collected(spark: SparkSession, source: str, settings: dict, reader: Callable[[], readers.ReaderBackend] | None = None, store: str | None = None) -> collection.Collection:
    """The decks below a folder, or one deck, as the settings have it read. `store` keeps what pictures were read as."""
    reader = reader or pictures.reader_of(settings)
    own = settings["extraction"]
    reading = collection.Reading(own["include_images"] or reader is not None, own["strict"], settings["ocr"]["policy"], reader, store)
    return collection.collect(spark, source, complete=settings["semantic"]["policy"] == "complete", reading=reading)


def site(found: collection.Collection, whole: integration.Integrated | None, documents: dict[str, DataFrame] | None, target: str) -> None:
    """Check a collection, its integration and its documents against each other and publish their site with the decks' pictures."""
    assets, wrong = publish.asset_files(found.assets)
    paths = assets.select("path")
    pages = cut(collection.site(found) if whole is None else integration.site(found, whole))
    broken = [found.violations, wrong, semantic.evidence_violations(found, pages)]
    if documents is not None:
        broken.append(semantic.violations(documents, found))
    if whole is None:
        broken.append(integration.page_violations(pages, paths))
    else:
        sources = whole.facts.select("source_id").distinct()
        broken += [integration.violations(pages, whole, paths), integration.artifact_violations(whole, sources), semantic.lineage(whole, found)]
    publish.publish(pages, target, checks.union(broken), assets)


def run(spark: SparkSession, source: str, target: str, settings: dict, backend: Callable[[], readers.ChatBackend] | None = None, reader: Callable[[], readers.ReaderBackend] | None = None) -> None:
    """All of it, below a folder: tables/ holds the run's stages, its state and the answers of readers, site/ the site.

    A run that ended early goes on with the first stage that isn't complete. Without a model the site has evidence and sources."""
    files.separate(spark, source, target)
    with runs.Run(spark, f"{target}/tables") as own:

        def parsed() -> dict[str, DataFrame]:
            c = collected(spark, source, settings, reader, f"{target}/tables/answers")
            checks.fail_closed(c.violations)
            return collection.tables(c)

        found = collection.restored(own.stage("parsed", parsed))
        whole = None
        if backend is not None:
            whole = integration.restored(own.stage("integrated", lambda: integration.tables(integration.integrate(found, backend, options_of(settings)))))
        documents = own.stage("semantic", lambda: semantic.tables(found, whole.dossiers if whole else None))
        own.at = "site"
        site(found, whole, documents, f"{target}/site")


def again(spark: SparkSession, source: str, target: str) -> None:
    """The site of an earlier run from its tables, verified file by file and against each other, without any model."""
    found = collection.restored(runs.loaded(spark, f"{source}/tables/parsed"))
    kept = f"{source}/tables/integrated"
    whole = integration.restored(runs.loaded(spark, kept)) if runs.exists(spark, kept) else None
    site(found, whole, runs.loaded(spark, f"{source}/tables/semantic"), target)
