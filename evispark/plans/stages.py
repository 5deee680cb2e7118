"""The way from blocks to a site, as functions of DataFrames: decide, gather topics, resolve entities and edges, publish."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evispark.functions.udfs import call
from evispark.operators import checks, decisions, graph, readers, topics
from evispark.session import cut


@dataclass(frozen=True)
class Options:
    """Limits of a run; every one is checked when it is made."""

    prompt_chars: int = 36_000
    output_tokens: int = 4_096
    repairs: int = 2
    most_entities: int = 256
    most_topics: int = 64
    most_relationships: int = 512

    def __post_init__(self):
        for name, least in (("prompt_chars", 512), ("output_tokens", 64), ("repairs", 0), ("most_entities", 1), ("most_topics", 1), ("most_relationships", 1)):
            if getattr(self, name) < least:
                raise ValueError(f"{name} must be at least {least}")


@dataclass(frozen=True)
class Semantic:
    """What is decided about a collection's blocks."""

    ledger: DataFrame
    inventory: DataFrame
    duplicates: DataFrame
    decisions: DataFrame


def organise(blocks: DataFrame, selected: DataFrame, complete: bool = False) -> Semantic:
    """Ledger, duplicates and decisions of blocks, with a selection that a model or a rule has made."""
    ledger = decisions.request_ledger(blocks)
    protected = ledger.select("source_id", "citation").distinct()
    copies = decisions.exact_duplicates(blocks, protected)
    return Semantic(ledger, decisions.inventory(ledger), copies, decisions.decisions(blocks, selected, protected, copies, complete))


def kept_blocks(blocks: DataFrame, decided: DataFrame) -> DataFrame:
    return blocks.join(decided.where("disposition = 'keep'").select("source_id", "citation"), ["source_id", "citation"], "left_semi")


def omitted_blocks(blocks: DataFrame, decided: DataFrame) -> DataFrame:
    return blocks.join(decided.where("disposition = 'keep'").select("source_id", "citation"), ["source_id", "citation"], "left_anti")


def complete_decisions(blocks: DataFrame, decided: DataFrame) -> DataFrame:
    """Violations unless every block has exactly one decision."""
    return checks.union([checks.duplicates(decided, ["source_id", "citation"], "decided-twice"), checks.missing(blocks, decided, ["source_id", "citation"], "undecided"), checks.missing(decided, blocks, ["source_id", "citation"], "unknown-citation")])


ANSWER = "struct<entities:array<struct<name:string,type:string,description:string,citations:array<string>>>,relationships:array<struct<predicate:string,subject:string,subject_type:string,object:string,object_type:string,assertion:string,description:string,citations:array<string>>>,topics:array<struct<title:string,description:string,citations:array<string>>>>"


# Own wording of the instructions; the evidence follows them.
DISCOVER_TASK = "List topics, entities and relationships as JSON, each with citations from the evidence."
DOMAIN_TASK = "List as JSON the samples, lots, devices, materials, tests, failures and causes as entities, and their relationships with predicate, subject, object and the assertion that the evidence makes, each with citations."
ENTITIES_TASK = "List as JSON the entities alone that the evidence names, each with citations."


def discover(chunks: DataFrame, backend, options: Options, key: str = "chunk_id", text: str = "text", task: str = DISCOVER_TASK) -> DataFrame:
    """(key, entities, relationships, topics) that a model finds in each chunk; answers that are no JSON give nulls."""
    prompts = chunks.select(F.col(key), F.concat(F.lit(task + "\n\n"), F.col(text)).alias("prompt"))
    answers = readers.complete(prompts, backend, key, max_tokens=options.output_tokens)
    return answers.select(key, F.from_json(call("lenient_json", "answer"), ANSWER).alias("a")).select(key, "a.*")


def grounded_candidates(found: DataFrame, chunks: DataFrame, key: str = "chunk_id", text: str = "text", citations: str = "citations") -> DataFrame:
    """(ord, name, type, description, citation): entities whose name stands in their chunk, with the citations it allows;
    names that are request numbers belong to the code, not to the model."""
    rows = found.select(key, F.posexplode("entities").alias("place", "e")).join(chunks.select(key, text, F.col(citations).alias("allowed")), key)
    seen = rows.where(F.contains(call("search_form", text), call("search_form", F.col("e.name"))) & (F.size(call("request_numbers", F.col("e.name"))) == 0))
    cited = seen.select(F.struct(F.col(key), "place").alias("ord"), call("clean_label", "e.name").alias("name"), F.coalesce("e.type", F.lit("other")).alias("type"), F.col("e.description").alias("description"), F.explode(F.array_intersect(F.array_distinct(F.col("e.citations")), F.col("allowed"))).alias("citation"))
    return cited


def entity_only_retry(found: DataFrame) -> bool:
    """Is a second pass for entities alone needed, since the first found none at all?"""
    return found.where(F.size("entities") > 0).isEmpty()


def integrate(candidates: DataFrame, options: Options) -> tuple[DataFrame, DataFrame]:
    """(entities, warnings): entities with ids, sorted by type and name, the first most_entities of them; a warning for each one
    that fell to the limit."""
    merged = graph.merge_entities(candidates, call("search_form", "name"))
    named = cut(merged.withColumn("id", graph.entity_id(F.col("type"), F.col("key"), call("page_slug", "name"))))
    return within(named, ["type", "key"], options.most_entities, "entity-over-limit", F.col("name"))


def within(rows: DataFrame, order: list[str], most: int, code: str, detail) -> tuple[DataFrame, DataFrame]:
    """The first `most` rows by order (their ids are distinct), and a warning for each of the others."""
    kept = cut(rows.orderBy(*order).limit(most))
    return kept, checks.rows(rows.join(kept.select("id"), "id", "left_anti"), code, F.col("id"), detail, "warning")


def fallback_pages(topics_left: DataFrame, blocks: DataFrame) -> DataFrame:
    """(topic_id, body): evidence word for word where no answer passed. topics_left: (topic_id, source_id, citation)."""
    quoted = F.concat(F.lit("> "), F.regexp_replace("content", "\n", "\n> "), F.lit("\n\n"), F.col("citation"))
    rows = topics_left.join(blocks, ["source_id", "citation"]).withColumn("q", quoted)
    return rows.groupBy("topic_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("rank", "q"))), lambda s: s["q"]), "\n\n").alias("body"))


def covered_topics(blocks: DataFrame, merged: DataFrame, most: int) -> DataFrame:
    """Topics under the limit, and evidence that none of them cites put into topics of its slides; then the limit again."""
    lost = topics.uncovered(blocks, merged.select("source_id", "citations"))
    extra = topics.slide_topics(blocks.join(lost.select("source_id", "citation"), ["source_id", "citation"], "left_semi"), "Evidence from slide")
    extra = extra.select("source_id", call("topic_key", "title").alias("key"), "title", "citations", (F.lit(1 << 40) + F.col("slide_number")).alias("first"))
    both = merged.select("source_id", "key", "title", "citations", "first").union(extra)
    joined = both.groupBy("source_id", "key").agg(F.min_by("title", "first").alias("title"), F.array_distinct(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("first", "citations"))), lambda s: s["citations"]))).alias("citations"), F.min("first").alias("first"))
    return topics.with_overflow(joined, ["source_id"], most)
