"""From decided blocks to an integrated site: a model's topics, entities and relationships over packed evidence, resolved,
written as pages that are checked line by line, and linked with each other."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from evispark.functions import columns as C
from evispark.functions.udfs import call
from evispark.operators import artifacts, checks, chunks, graph, links, topics
from evispark.plans import collection, models, publish, stages
from evispark.session import cut

#: Characters of an evidence element besides its title and content.
WRAP = 160
#: What a prompt holds besides evidence.
PROMPT = 1_800
#: Entities that a chunk may give in a pass for entities alone.
MOST_RETRIED = 16


@dataclass(frozen=True)
class Integrated:
    """facts: source map of kept blocks; entities and edges of the graph; topics (topic_id, slug, title, body, generation);
    members (topic_id, source_id, citation); dossiers (source_id, body); warnings."""

    facts: DataFrame
    entities: DataFrame
    edges: DataFrame
    topics: DataFrame
    members: DataFrame
    dossiers: DataFrame
    warnings: DataFrame


def evidence_parts(rows: DataFrame, group: str, budget: int) -> DataFrame:
    """(group, part, text, citations): evidence elements packed in order under the budget.

    rows: (group, place long, citation, title, content); place is unique in its group and below 2**40. Contents over the room
    of an element come in fragments, each with its citation. A part's text is bounded by the budget; elements keep whole.
    """
    room = F.greatest(F.lit(128), F.lit(budget - WRAP) - F.length("citation") - F.length("title")).cast("int")
    title = F.left(F.coalesce("title", F.lit("")), F.lit(200))
    pieces = rows.select(group, "place", "citation", title.alias("title"), F.coalesce("content", F.lit("")).alias("content")).withColumn("room", room)
    pieces = pieces.select(group, "place", "citation", "title", F.posexplode(call("fragments", "content", "room")).alias("at", "piece"))
    element = F.concat(F.lit('<evidence citation="'), "citation", F.lit('">\n'), F.when(F.col("title") != "", F.concat("title", F.lit("\n"))).otherwise(""), "piece", F.lit("\n</evidence>"))
    pieces = pieces.select(group, (F.col("place") * (1 << 20) + F.col("at")).alias("place"), "citation", element.alias("content"))
    placed = chunks.chunk_blocks(pieces, budget, group, "place").where("fragment = 1").select(group, "place", F.col("chunk").alias("part"))
    whole = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("place", "content"))), lambda x: x["content"]), "\n\n")
    return pieces.join(placed, [group, "place"]).groupBy(group, "part").agg(whole.alias("text"), topics.ordered(F.col("citation"), F.col("place")).alias("citations"))


def with_dossiers(parts: DataFrame, dossiers: DataFrame, budget: int) -> DataFrame:
    """Parts (source_id, part, text, citations) with whole blocks of the source's dossier that cite their evidence in front, the
    first ones that the rest of the budget holds. dossiers: (source_id, body) with qualified citations."""
    said = dossiers.select("source_id", F.posexplode(call("cited_blocks", "body")).alias("at", "b"))
    said = said.select("source_id", "at", F.col("b.block").alias("block"), F.explode("b.citations").alias("citation"))
    key = ["source_id", "part"]
    near = parts.select(*key, F.length("text").alias("taken"), F.explode("citations").alias("citation")).join(said, ["source_id", "citation"]).select(*key, "taken", "at", "block").distinct()
    used = F.sum(F.length("block") + 2).over(Window.partitionBy(*key).orderBy("at"))
    kept = near.withColumn("used", used).where(F.col("used") - 2 <= budget - F.col("taken") - 90)
    front = kept.groupBy(*key).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", "block"))), lambda x: x["block"]), "\n\n").alias("front"))
    text = F.concat(F.lit("## Dossier\n\n"), F.coalesce("front", F.lit("(none)")), F.lit("\n\n## Evidence\n\n"), "text")
    return parts.join(front, key, "left").select(*key, text.alias("text"), "citations")


def dossiers(kept: DataFrame, backend: Callable, options: stages.Options) -> tuple[DataFrame, DataFrame]:
    """(source_id, body) of every source's topics as the model writes them, and warnings; citations are qualified.

    kept: blocks. Evidence that no topic cites goes into topics of its slides, so that nothing kept is lost."""
    rows = kept.select("source_id", F.col("rank").alias("place"), "citation", F.col("slide_title").alias("title"), "content")
    parts = cut(evidence_parts(rows, "source_id", max(512, options.prompt_chars - PROMPT)).withColumn("chunk_id", F.concat_ws("#", "source_id", F.lpad(F.col("part").cast("string"), 9, "0"))))
    none = parts.select("source_id", F.lit("").alias("ord"), F.lit("").alias("title"), F.lit("").alias("description"), F.lit("").alias("citation")).limit(0)
    found, warnings = models.topics(parts, backend, none)
    merged = topics.merge_topics(found.withColumn("rank", F.col("ord")), ["source_id"], call("topic_key", "title")).select("source_id", "key", "title", "citations", "first")
    order = F.dense_rank().over(Window.partitionBy("source_id").orderBy("first", "key")).cast("long")
    whole = stages.covered_topics(kept, merged.withColumn("first", order), options.most_topics)
    cited = whole.select("source_id", F.format_string("%s#%06d", "source_id", "slot").alias("topic_id"), "slot", F.col("title").alias("topic"), F.explode("citations").alias("citation"))
    evidence = cited.join(rows, ["source_id", "citation"])
    asked = evidence_parts(evidence, "topic_id", max(512, options.prompt_chars - PROMPT))
    names = cited.select("topic_id", "source_id", "slot", F.col("topic").alias("title")).distinct()
    quoted = F.concat(F.lit("- "), F.array_join("citations", " "))
    written = models.pages(asked.join(names, "topic_id").select("topic_id", "part", "title", F.col("text").alias("evidence"), "citations", quoted.alias("verbatim")), backend, options.prompt_chars, options.repairs)
    page = F.concat(F.lit("## "), "title", F.lit("\n\n"), "body")
    bodies = written.join(names, "topic_id").groupBy("source_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("slot", page.alias("page")))), lambda x: x["page"]), "\n\n").alias("body"))
    return bodies.select("source_id", C.qualified(F.col("source_id"), F.col("body")).alias("body")), warnings


def candidates(parts: DataFrame, passes: list[DataFrame], backend: Callable, options: stages.Options) -> DataFrame:
    """Grounded entities of all passes in their order; where they all found none, those of a pass for entities alone."""
    lists = [stages.grounded_candidates(found, parts) for found in passes]
    if all(stages.entity_only_retry(found) for found in passes):
        alone = cut(stages.discover(parts, backend, options, task=stages.ENTITIES_TASK))
        lists = [stages.grounded_candidates(alone.withColumn("entities", F.slice("entities", 1, MOST_RETRIED)), parts)]
    return topics.all_candidates(*lists).withColumn("ord", F.struct("pass_no", "ord"))


def edges(passes: list[DataFrame], parts: DataFrame, entities: DataFrame, facts: DataFrame, options: stages.Options) -> tuple[DataFrame, DataFrame]:
    """Relationships of all passes between entities and requests, the first most_relationships by id, and a warning for each of
    the others."""
    said = None
    for n, found in enumerate(passes):
        own = found.join(parts.select("chunk_id", "source_id"), "chunk_id").select("chunk_id", "source_id", F.posexplode("relationships").alias("at", "r"))
        own = own.select(F.format_string("%d-%s-%06d", F.lit(n), "chunk_id", "at").alias("ord"), "source_id", "r.*")
        said = own if said is None else said.unionByName(own)
    pairs = facts.select("source_id", F.col("qualified_citation").alias("citation"), F.posexplode("request_values").alias("at", "value")).withColumn("key", call("request_key", "value"))
    requests = pairs.groupBy("source_id", "citation").agg(F.transform(F.sort_array(F.collect_list(F.struct("at", "key", "value"))), lambda x: F.struct(x["key"].alias("key"), x["value"].alias("value"))).alias("requests"))
    none = F.array().cast("array<struct<key:string,value:string>>")
    evidence = facts.select("source_id", F.col("qualified_citation").alias("citation"), "numbers", "identifiers").join(requests, ["source_id", "citation"], "left").withColumn("requests", F.coalesce("requests", none))
    each = entities.select(F.col("id").alias("entity_id"), "type", F.array("key").alias("keys"), F.explode("citations").alias("citation")).withColumn("source_id", C.citation_parts(F.col("citation"))["source"])
    by_source = each.groupBy("entity_id", "type", "keys", "source_id").agg(F.collect_set("citation").alias("citations"))
    found = cut(graph.resolve_edges(said, by_source, evidence))
    return stages.within(found, ["id"], options.most_relationships, "relationship-over-limit", F.col("assertion"))


def grounded_topics(found: DataFrame, facts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Topics (ord, title, source_id, citation) whose title claims no number that their evidence lacks, and a warning for each of
    the others, whose evidence goes to its source's own topic if no other topic has it."""
    listed = found.groupBy("ord", "title", "source_id").agg(F.collect_set("citation").alias("citations")).withColumn("topic_id", F.concat_ws("#", "ord", "source_id"))
    evidence = facts.select("source_id", F.col("qualified_citation").alias("citation"), "numbers")
    good = cut(topics.grounded_titles(listed, evidence).select("ord", "source_id"))
    return found.join(good, ["ord", "source_id"], "left_semi"), checks.rows(listed.join(good, ["ord", "source_id"], "left_anti"), "title-ungrounded", F.col("topic_id"), F.col("title"), "warning")


def topic_members(found: DataFrame, facts: DataFrame, names: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """Topics (topic_id, slug, title) and members (topic_id, source_id, citation) from (ord, title, source_id, citation).

    Titles of one key unite over all sources. Beyond `most` topics the later ones' evidence forms one. A source without any
    topic gets its own, named as it is; so every source has a page, and these come on top of `most`. A topic that cites no
    request of a source gains the source's evidence with requests. Topics stay rows of citations, however large they are.
    """
    keyed = cut(found.withColumn("key", call("topic_key", "title")).where("key <> ''"))
    heads = keyed.groupBy("key").agg(F.min(F.struct("ord", "title")).alias("h")).select("key", "h.ord", "h.title")
    first = cut(heads.orderBy("ord", "key").limit(most + 1))
    if first.count() > most:
        first = cut(first.orderBy("ord", "key").limit(most - 1))
    kept = keyed.join(F.broadcast(first.select("key", F.lit(True).alias("own"))), "key", "left")  # at most `most` rows
    over = F.coalesce("own", F.lit(False))
    members = kept.select(F.when(over, F.concat(F.lit("topic-"), "key")).otherwise("overflow").alias("topic_id"), "source_id", "citation").distinct()
    bare = names.join(members.select("source_id").distinct(), "source_id", "left_anti")
    more = facts.join(bare, "source_id").select(F.concat(F.lit("source-"), "source_id").alias("topic_id"), "source_id", F.col("qualified_citation").alias("citation"))
    has = facts.select("source_id", F.col("qualified_citation").alias("citation"), (F.size("request_values") > 0).alias("has_request"))
    members = cut(topics.expand_citations(members.union(more), has))
    rest = members.where("topic_id = 'overflow'").select(F.lit("overflow").alias("topic_id"), F.lit("2").alias("ord"), F.lit("Further evidence").alias("title")).limit(1)
    named = first.select(F.concat(F.lit("topic-"), "key").alias("topic_id"), F.concat(F.lit("1-"), "ord").alias("ord"), "title").union(rest)
    named = named.union(bare.select(F.concat(F.lit("source-"), "source_id"), F.concat(F.lit("3-"), "source_id"), "title"))
    return cut(links.numbered_slugs(named.withColumn("base", call("topic_slug", "title")), "base", "ord").select("topic_id", "slug", "title")), members


def topic_bodies(named: DataFrame, members: DataFrame, kept: DataFrame, facts: DataFrame, backend: Callable, options: stages.Options) -> DataFrame:
    """(topic_id, body, generation): pages over their evidence in parts, each with a list of the sources behind it.

    Evidence over a prompt is written part by part. The list has a source's evidence with requests, else its first. A page that
    fails the checks with its list is the list of all its evidence."""
    known = facts.select("source_id", F.col("qualified_citation").alias("citation"), "numbers", F.col("request_values").alias("requests"))
    own = kept.select("source_id", C.qualified(F.col("source_id"), F.col("citation")).alias("citation"), "rank", F.col("slide_title").alias("title"), "content")
    cited = cut(members.join(own, ["source_id", "citation"]).join(known, ["source_id", "citation"]).withColumn("place", F.row_number().over(Window.partitionBy("topic_id").orderBy("source_id", "rank")).cast("long")))
    parts = evidence_parts(cited.select("topic_id", "place", "citation", "title", "content"), "topic_id", max(512, options.prompt_chars - PROMPT))
    fact = F.struct("citation", "numbers", "requests")
    line = F.concat_ws(" ", F.lit("-"), F.when(F.size("requests") > 0, F.array_join("requests", ", ")), "citation")
    of_part = parts.select("topic_id", "part", F.posexplode("citations").alias("at", "citation")).join(cited.select("topic_id", "citation", "numbers", "requests"), ["topic_id", "citation"])
    of_part = of_part.groupBy("topic_id", "part").agg(F.collect_list(fact).alias("facts"), F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", line.alias("l")))), lambda x: x["l"]), "\n").alias("verbatim"))
    asked = parts.join(of_part, ["topic_id", "part"]).join(named.select("topic_id", "title"), "topic_id").select("topic_id", "part", "title", F.col("text").alias("evidence"), "citations", "verbatim", "facts")
    written = models.pages(asked, backend, options.prompt_chars, options.repairs, models.integrated_check)
    asks, at = F.size("requests") > 0, F.struct("place", "citation")
    shown = cited.groupBy("topic_id", "source_id").agg(F.sort_array(F.collect_list(F.when(asks, at))).alias("with"), F.min(at).alias("first"))
    shown = shown.select("topic_id", "source_id", F.explode(F.when(F.size("with") > 0, F.col("with")).otherwise(F.array("first"))).alias("c"))
    listed = shown.groupBy("topic_id").agg(publish.lines(F.concat(F.lit("`"), "source_id", F.lit("` "), "c.citation"), F.col("c.place")).alias("sources"))
    everything = cited.groupBy("topic_id").agg(F.collect_list(fact).alias("facts"), F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("place", line.alias("l")))), lambda x: x["l"]), "\n").alias("verbatim"))
    whole = cut(written.join(listed, "topic_id").join(everything, "topic_id").withColumn("answer", F.concat("body", F.lit("\n\n## Sources\n\n"), "sources")))
    # a source's id in the list is no claim, so the body is checked and the list is ours
    bad = F.size(call("integrated_check", "body", F.to_json("facts"), F.array_distinct(F.flatten("facts.requests")))) > 0
    return cut(whole.withColumn("bad", bad & (F.col("generation") == "model")).select("topic_id", F.when(F.col("bad"), F.col("verbatim")).otherwise(F.col("answer")).alias("body"), F.when(F.col("bad"), "verbatim_fallback").otherwise(F.col("generation")).alias("generation")))


def integrate(c: collection.Collection, backend: Callable, options: stages.Options = stages.Options()) -> Integrated:
    """All model stages over a collection. backend: makes a ChatBackend where it is called, in each task."""
    kept = cut(stages.kept_blocks(c.blocks, c.semantic.decisions))
    facts = cut(artifacts.source_map(kept, c.semantic.ledger))
    written, warnings = dossiers(kept, backend, options)
    written = cut(written)
    rows = kept.select("source_id", F.col("rank").alias("place"), C.qualified(F.col("source_id"), F.col("citation")).alias("citation"), F.col("slide_title").alias("title"), "content")
    budget = max(2_000, options.prompt_chars - PROMPT)
    parts = with_dossiers(evidence_parts(rows, "source_id", max(1_000, budget * 2 // 3)), written, budget)
    parts = cut(parts.withColumn("chunk_id", F.concat_ws("#", "source_id", F.lpad(F.col("part").cast("string"), 9, "0"))))
    passes = [cut(stages.discover(parts, backend, options, task=task)) for task in (stages.DISCOVER_TASK, stages.DOMAIN_TASK)]
    entities, cut_entities = stages.integrate(candidates(parts, passes, backend, options), options)
    related, cut_edges = edges(passes, parts, entities, facts, options)
    titled = passes[0].join(parts.select("chunk_id", F.col("citations").alias("allowed")), "chunk_id").select("chunk_id", F.posexplode("topics").alias("at", "t"), "allowed")
    titled = titled.select(F.format_string("%s-%06d", "chunk_id", "at").alias("ord"), F.col("t.title").alias("title"), F.explode(F.array_intersect("t.citations", "allowed")).alias("citation")).withColumn("source_id", C.citation_parts(F.col("citation"))["source"])
    titled, bare_titles = grounded_topics(cut(titled), facts)
    names = c.sources.select("source_id", C.file_stem(F.element_at("paths", 1)).alias("title")).join(facts.select("source_id").distinct(), "source_id", "left_semi")
    named, members = topic_members(titled, facts, names, options.most_topics)
    bodies = topic_bodies(named, members, kept, facts, backend, options)
    cuts = cut_entities.unionByName(cut_edges).unionByName(bare_titles)
    return Integrated(facts, entities, related, named.join(bodies, "topic_id"), members, written, cut(warnings.unionByName(cuts)))


def with_lists(rows: DataFrame, key: str, cited: DataFrame, carried: DataFrame) -> DataFrame:
    """Rows with the sorted lists of what stands behind them, for their pages: source_ids and requests. cited: (key, citation,
    source_id); carried: (citation, value)."""
    sources = cited.groupBy(key).agg(F.sort_array(F.collect_set("source_id")).alias("source_ids"))
    requests = cited.select(key, "citation").join(carried.select("citation", "value"), "citation").groupBy(key).agg(F.sort_array(F.collect_set("value")).alias("requests"))
    return rows.join(sources, key, "left").join(requests, key, "left")


def site(c: collection.Collection, found: Integrated) -> DataFrame:
    """(path, body): evidence, sources, entities with their relationships, topics with related entities, requests and an index
    over all of them. Citations are links to evidence pages."""
    evidence = collection.evidence_pages(c.blocks)
    names = c.sources.select("source_id", C.file_stem(F.element_at("paths", 1)).alias("title"))
    cited = found.facts.select("source_id", F.col("qualified_citation").alias("citation"), F.struct("slide_number", "element_id").alias("rank"))
    sources = publish.dossiers(names.join(found.dossiers, "source_id", "left"), c.semantic.inventory, cited)
    values = found.facts.select(F.explode("request_values").alias("value")).distinct()
    slugs = cut(links.unique_slugs(values, call("path_slug", "value")))
    nodes = found.entities.select(F.concat(F.lit("entity:"), "id").alias("node"), publish.wiki_link("entities", F.col("id"), F.col("name")).alias("link"))
    nodes = nodes.union(slugs.select(F.concat(F.lit("pr:"), "value"), publish.wiki_link("requests", F.col("slug"), F.col("value"))))
    of_entity = found.entities.select("id", "name", F.explode("citations").alias("citation")).withColumn("source_id", C.citation_parts(F.col("citation"))["source"])
    shared = graph.shared_sources(found.members.select(F.col("topic_id").alias("id"), "source_id").distinct(), of_entity.select("id", "source_id").distinct())
    related = shared.join(found.topics.select(F.col("topic_id").alias("page_id"), "slug"), "page_id").join(found.entities.select(F.col("id").alias("entity_id"), "name"), "entity_id").select("slug", F.col("entity_id").alias("id"), "name")
    carried = found.facts.select(F.col("qualified_citation").alias("citation"), "source_id", F.explode("request_values").alias("value"))
    entities = publish.entity_pages(with_lists(found.entities, "id", of_entity, carried), found.edges, nodes)
    topic_pages = publish.topic_pages(with_lists(found.topics, "topic_id", found.members, carried), related)
    by_topic = found.members.select("topic_id", "citation").join(carried, "citation").select("value", "topic_id").distinct().join(found.topics, "topic_id").select("value", F.col("slug").alias("id"), "title")
    by_entity = of_entity.select("id", "name", "citation").join(carried.select("citation", "value"), "citation").select("value", "id", F.col("name").alias("title")).distinct()
    by_source = carried.select("value", "source_id").distinct().join(names, "source_id").select("value", F.col("source_id").alias("id"), "title")
    requests = publish.request_pages(slugs, by_source, by_topic, by_entity, found.edges, nodes)
    index = publish.index_pages("Evidence", {"Sources": names.select(F.col("source_id").alias("id"), "title"), "Topics": found.topics.select(F.col("slug").alias("id"), "title"), "Entities": found.entities.select("id", F.col("name").alias("title")), "Requests": slugs.select(F.col("slug").alias("id"), F.col("value").alias("title"))})
    linked = sources.union(entities).union(topic_pages).union(requests).select("path", call("evidence_links", "body").alias("body"))
    return evidence.union(linked).union(index)


def violations(pages: DataFrame, found: Integrated, files: DataFrame | None = None) -> DataFrame:
    """What stops a site: links to nothing, images, raw citations, pages without front matter, edges with unknown ends, dangerous
    markup. files: (path) of what else the site holds."""
    ends = found.edges.select("id", F.explode(F.array("subject", "object")).alias("node"), "citations").where("node like 'entity:%'").select("id", F.substring("node", 8, 1 << 30).alias("entity"), "citations")
    ends = ends.join(found.entities.select(F.col("id").alias("entity"), F.col("citations").alias("theirs")), "entity", "left")
    lineage = checks.bad_values(ends, "edge-lineage", F.col("id"), ~F.coalesce(F.arrays_overlap("citations", "theirs"), F.lit(False)), F.col("entity"))
    return page_violations(pages, files).unionByName(lineage)


def page_violations(pages: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """violations() of pages alone."""
    made = pages.where(~F.startswith("path", F.lit(links.EVIDENCE)))
    lost = links.tree_violations(pages, files).select("check_code", F.lit("error").alias("severity"), F.col("path").alias("key"), F.concat_ws("#", "target", "fragment").alias("detail"))
    return checks.union([lost, artifacts.front_matter(made), checks.text_checks(made, F.col("path"), F.col("body"))])


def tables(found: Integrated) -> dict[str, DataFrame]:
    """What a run keeps of an integration; restored() takes it up again."""
    return {"source_map": found.facts, "entities": found.entities, "relationships": found.edges, "topics": found.topics, "topic_citations": found.members, "dossiers": found.dossiers, "warnings": found.warnings}


def restored(kept: dict[str, DataFrame]) -> Integrated:
    return Integrated(*(kept[name] for name in ("source_map", "entities", "relationships", "topics", "topic_citations", "dossiers", "warnings")))


def artifact_violations(found: Integrated, known_sources: DataFrame) -> DataFrame:
    """The cross-checks of a loaded integration before it is published: entities, relationships, topics and coverage against the
    source map and each other."""
    carried = found.facts.select(F.col("qualified_citation").alias("citation"), "source_id")
    of = lambda df: df.select("id", F.explode("citations").alias("citation")).join(carried, "citation").groupBy("id").agg(F.sort_array(F.collect_set("source_id")).alias("source_ids"))
    entities = found.entities.join(of(found.entities), "id", "left").withColumn("source_ids", F.coalesce("source_ids", F.array().cast("array<string>")))
    node = lambda c: F.when(F.startswith(c, F.lit("entity:")), F.substring(c, 8, 1 << 30))
    ends = found.edges.select("id", F.explode(F.array("subject", "object")).alias("end"), "citations")
    lost = ends.withColumn("entity", node(F.col("end"))).where("entity is not null").join(entities.select(F.col("id").alias("entity"), F.col("citations").alias("theirs")), "entity", "left")
    requests = found.facts.select(F.explode("request_values").alias("value")).distinct()
    unknown = ends.where(F.startswith("end", F.lit("pr:"))).join(requests.select(F.concat(F.lit("pr:"), "value").alias("end")), "end", "left_anti")
    cited = found.members.join(carried, ["citation", "source_id"], "left_anti")
    covered = known_sources.join(found.members.select("source_id").distinct(), "source_id", "left_anti")
    return checks.union([
        artifacts.source_map_rows(found.facts),
        artifacts.edge_requests(found.edges, found.facts),
        checks.bad_values(found.entities, "no-name", F.col("id"), F.trim("name") == ""),
        checks.bad_values(found.entities, "alias-is-name", F.col("id"), F.array_contains("aliases", F.col("name"))),
        checks.bad_values(found.topics, "no-title", F.col("topic_id"), F.trim("title") == ""),
        checks.missing(found.topics.select("topic_id"), found.members, ["topic_id"], "topic-without-evidence"),
        artifacts.entities(entities, known_sources, found.facts),
        checks.duplicates(found.edges, ["id"], "duplicate-id"),
        checks.bad_values(found.edges, "self-loop", F.col("id"), F.col("subject") == F.col("object")),
        checks.rows(lost.where("theirs is null"), "unknown-endpoint", F.col("id"), F.col("end")),
        checks.bad_values(lost, "no-shared-citation", F.col("id"), ~F.arrays_overlap("citations", "theirs"), F.col("end")),
        checks.rows(unknown, "unknown-endpoint", F.col("id"), F.col("end")),
        checks.duplicates(found.topics, ["slug"], "duplicate-slug"),
        checks.missing(found.members.select("topic_id").distinct(), found.topics, ["topic_id"], "unknown-topic"),
        checks.rows(cited, "unknown-citation", F.col("topic_id"), F.col("citation")),
        checks.rows(covered, "uncovered-source", F.col("source_id")),
    ])
