"""Knowledge graph: entities, aliases, relationships, incidence, lineage checks and vocabularies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evispark.functions import patterns
from evispark.functions.udfs import call
from evispark.operators.topics import crossed, ordered
from evispark.session import cut

# Predicates, and the kinds of objects that each prefers (none: any kind).
OBJECT_KINDS = {
    "has_sample": ("sample",),
    "has_lot": ("lot",),
    "targets_device": ("device", "product"),
    "uses_package": ("package", "product"),
    "uses_material": ("material",),
    "underwent_test": ("test_method",),
    "uses_condition": ("test_condition",),
    "uses_equipment": ("equipment", "system"),
    "observed_failure": ("failure_mode",),
    "observed_defect": ("defect",),
    "suspected_cause": ("material", "process", "defect", "failure_mode", "concept"),
    "concluded_cause": ("material", "process", "defect", "failure_mode", "concept"),
    "recommends_action": ("corrective_action", "process"),
    "compared_with": (),
    "related_to": (),
}
# Kinds of entities of the domain, which win over general ones, and the general ones.
DOMAIN_KINDS = ("sample", "lot", "device", "package", "material", "process", "test_method", "test_condition", "equipment", "failure_mode", "defect", "standard", "corrective_action")
GENERAL_KINDS = ("person", "organization", "product", "system", "project", "location", "concept", "metric", "other")


def predicate_kinds(spark) -> DataFrame:
    """(predicate, kinds) rows: a dimension of as many rows as there are predicates."""
    return spark.createDataFrame([(p, list(kinds)) for p, kinds in OBJECT_KINDS.items()], "predicate string, kinds array<string>")


def contained(texts: DataFrame, names: DataFrame) -> DataFrame:
    """(text_id, name_id): names that a text holds as a run of its words, case apart. texts: (text_id, text); names:
    (name_id, name).

    Instead of testing each name in each text, each name's longest word meets the words of texts in an equi-join, and only
    those pairs are tested, so the work grows with what they share.
    """
    spaced = lambda c: F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(c), r"[\x20\x09-\x0D]+", " ")), F.lit(" "))
    words = lambda c: F.filter(F.split(c, " "), lambda w: w != "")
    longest = F.array_max(F.transform(words(F.col("n")), lambda w: F.struct(F.length(w).alias("size"), w.alias("word"))))["word"]
    keyed = names.select("name_id", spaced(F.col("name")).alias("n")).where(F.trim("n") != "").withColumn("word", longest)
    clean = texts.select("text_id", spaced(F.col("text")).alias("t"))
    near = clean.select("text_id", F.explode(F.array_distinct(words(F.col("t")))).alias("word")).join(keyed, "word").select("text_id", "name_id", "n")
    return near.join(clean, "text_id").where(F.contains("t", "n")).select("text_id", "name_id").distinct()


def entity_id(kind: Column, name: Column, slug: Column) -> Column:
    """Slug and eight hex digits of the digest of kind and name."""
    return F.concat(slug, F.lit("-"), F.substring(F.sha2(F.concat(kind, F.lit("\x00"), name), 256), 1, 8))


def merge_entities(candidates: DataFrame, key: Column, domain: tuple[str, ...] = DOMAIN_KINDS) -> DataFrame:
    """(key, type, name, description, aliases, citations) from candidates (ord, name, type, description, citation).

    Candidates of one key and type unite in their order; of one key's types a domain type wins, then the first by name; the
    others' citations and aliases go to it.
    """
    keyed = candidates.withColumn("key", key).where("key <> ''")
    typed = keyed.withColumn("pref", F.struct((~F.col("type").isin(*domain)).alias("other"), F.col("type").alias("type")))
    best = cut(typed.groupBy("key").agg(F.min("pref").alias("best")))  # so that the join deals out both sides and can split a hot key
    head = F.min(F.struct((F.col("type") != F.col("best.type")).alias("not_best"), F.col("ord").alias("ord"), F.col("name").alias("name"), F.col("description").alias("description")))
    out = typed.join(best, "key").groupBy("key", F.col("best.type").alias("type")).agg(head.alias("h"), ordered(F.col("name"), F.col("ord")).alias("names"), ordered(F.col("citation"), F.col("ord")).alias("citations"))
    return out.select("key", "type", F.col("h.name").alias("name"), F.col("h.description").alias("description"), F.array_except("names", F.array("h.name")).alias("aliases"), "citations")


def resolve_aliases(mentions: DataFrame, entities: DataFrame) -> DataFrame:
    """(mention_id, entity_id): mentions whose key is an entity's name or alias, in the same source and with a shared
    citation; only where exactly one entity remains.

    mentions: (mention_id, key, source_id, citations); entities: (entity_id, keys, source_id, citations).
    """
    names = named_once(entities.select("entity_id", F.explode("keys").alias("key"), "source_id", F.explode("citations").alias("citation")), ["key", "source_id", "citation"])
    cited = mentions.select("mention_id", "key", "source_id", F.explode("citations").alias("citation")).distinct()
    one = cited.join(names, ["key", "source_id", "citation"]).groupBy("mention_id").agg(F.min("least").alias("entity_id"), F.max("most").alias("most"))
    return one.where("entity_id = most").select("mention_id", "entity_id")


def named_once(names: DataFrame, place: list[str]) -> DataFrame:
    """(place, least, most): the smallest and largest entity_id of a name in a citation. They are one where one entity has it,
    and that is all that is asked of many; so a name meets a mention as one row, however many have it."""
    return names.groupBy(*place).agg(F.min("entity_id").alias("least"), F.max("entity_id").alias("most"))


def relationship_id(predicate: Column, subject: Column, obj: Column, assertion: Column) -> Column:
    return F.concat(F.lit("rel-"), F.substring(F.sha2(F.concat_ws("\x1f", predicate, subject, obj, assertion), 256), 1, 20))


def merge_edges(candidates: DataFrame) -> DataFrame:
    """(id, predicate, subject, object, description, citations) from candidates (ord, predicate, subject, object,
    assertion, description, citation): one identity, one edge; the first description wins. Loops drop out. Only what is left
    of each identity is digested."""
    identity = ["predicate", "subject", "object", "assertion"]
    merged = candidates.where("subject <> object").groupBy(*identity).agg(F.min(F.struct("ord", "description")).alias("h"), ordered(F.col("citation"), F.col("ord")).alias("citations"))
    return merged.select(relationship_id(*map(F.col, identity)).alias("id"), "predicate", "subject", "object", F.col("h.description").alias("description"), "citations")


def resolve_edges(found: DataFrame, entities: DataFrame, evidence: DataFrame, key=None, request=None, numbers=None, unapproved=None) -> DataFrame:
    """Edges (id, predicate, subject, object, assertion, description, citations, requests) from a model's relationships.

    found: (ord, source_id, predicate, subject, subject_type, object, object_type, assertion, description, citations);
    entities: (entity_id, type, keys, source_id, citations), a row for each source; evidence: (source_id, citation, numbers,
    requests, identifiers if there are any), where requests are (key, value) pairs.

    A relationship stays if its predicate is known, a citation of it is evidence of its source, both ends resolve, its
    assertion and description, read as lines that rest on its citations, have no number, identifier or request number that
    these lack, and a request number belongs to it. An end is a request number of its citations,
    else the one entity of that name with a citation in common; of several the type that is asked for decides, for objects
    the kinds that the predicate prefers. Requests are those of the ends, else those of the citations. Relationships of one
    predicate, assertion and ends unite; the first one's words stay. Loops and relationships without assertion drop out.
    """
    key = key or (lambda c: call("search_form", c))
    request = request or (lambda c: call("request_key", c))
    numbers = numbers or (lambda c: call("claim_numbers", c))
    unapproved = unapproved or (lambda line, values, spelled: call("unapproved_requests", line, values, spelled))
    evidence = evidence if "identifiers" in evidence.columns else evidence.withColumn("identifiers", F.array().cast("array<string>"))
    spark = found.sparkSession
    said = found.withColumn("predicate", F.lower(F.trim("predicate"))).where(F.trim(F.coalesce("assertion", F.lit(""))) != "")
    said = said.join(F.broadcast(predicate_kinds(spark)), "predicate").withColumn("description", F.when(F.trim(F.coalesce("description", F.lit(""))) != "", F.col("description")).otherwise(F.col("assertion")))
    cited = said.select("ord", "source_id", F.posexplode(F.array_distinct("citations")).alias("at", "citation")).join(evidence, ["source_id", "citation"])
    cited = cut(cited)  # it is read for the citations and for the lines
    flat = lambda c: F.array_distinct(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("at", c))), lambda x: x[c])))
    own = cited.groupBy("ord").agg(F.transform(F.sort_array(F.collect_list(F.struct("at", "citation"))), lambda x: x["citation"]).alias("citations"), flat("requests").alias("requests"))
    lost = ungrounded_lines(said, cited, numbers, unapproved)
    said = cut(said.drop("citations").join(own, "ord").join(lost, "ord", "left_anti"))
    end = lambda role: F.struct(F.lit(role).alias("role"), F.col(role).alias("name"), F.col(f"{role}_type").alias("asked"))
    ends = said.select("ord", "source_id", "citations", "kinds", "requests", F.explode(F.array(end("subject"), end("object"))).alias("e")).select("*", "e.*").drop("e")
    of_request = F.filter("requests", lambda r: r["key"] == F.col("request_key"))
    ends = cut(ends.withColumn("request_key", request(F.col("name"))).withColumn("request", F.get(F.transform(of_request, lambda r: r["value"]), 0)).withColumn("key", key(F.col("name"))).drop("request_key", "requests"))
    names = named_once(entities.select("entity_id", "type", F.explode("keys").alias("key"), "source_id", F.explode("citations").alias("citation")), ["source_id", "key", "citation", "type"])
    cited_ends = ends.where("request is null").withColumn("citation", F.explode("citations"))
    hits = cited_ends.join(names, ["source_id", "key", "citation"])
    asked, liked = F.col("asked").isNotNull(), (F.col("role") == "object") & F.array_contains("kinds", F.col("type"))
    hits = hits.where(~asked | (F.col("asked") == F.col("type"))).withColumn("liked", ~asked & liked)
    least, most = (lambda flag: F.min(F.when(flag, F.col("least")))), (lambda flag: F.max(F.when(flag, F.col("most"))))
    one = lambda flag: F.when(least(flag) == most(flag), least(flag))
    best = hits.groupBy("ord", "role").agg(F.when(F.count_if("liked") > 0, one(F.col("liked"))).otherwise(one(F.lit(True))).alias("entity"))
    solved = ends.select("ord", "role", "request").join(best, ["ord", "role"], "left")
    node = F.coalesce(F.concat(F.lit("pr:"), F.col("request")), F.concat(F.lit("entity:"), F.col("entity")))
    pick = lambda role, c: F.max(F.when(F.col("role") == role, c))
    pairs = solved.groupBy("ord").agg(pick("subject", node).alias("subject"), pick("object", node).alias("object"), F.array_compact(F.array(pick("subject", F.col("request")), pick("object", F.col("request")))).alias("named")).where("subject <> object")
    out = said.drop("subject", "object").join(pairs, "ord").withColumn("requests", F.when(F.size("named") > 0, F.array_distinct("named")).otherwise(F.transform("requests", lambda r: r["value"]))).where(F.size("requests") > 0)
    out = out.withColumn("id", relationship_id(F.col("predicate"), F.col("subject"), F.col("object"), key(F.col("assertion"))))
    gather = lambda c: F.array_distinct(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("ord", c))), lambda x: x[c])))
    merged = out.groupBy("id", "predicate", "subject", "object").agg(F.min(F.struct("ord", "assertion", "description")).alias("h"), gather("citations").alias("citations"), gather("requests").alias("requests"))
    return merged.select("id", "predicate", "subject", "object", "h.assertion", "h.description", "citations", "requests")


def ungrounded_lines(said: DataFrame, cited: DataFrame, numbers, unapproved) -> DataFrame:
    """(ord): relationships (ord, assertion, description) of which a text, read as a line that rests on citations, claims what
    these don't have: a number, a request number spelled otherwise, or one with another prefix that no identifier explains.

    A line rests on the qualified citations in it, which must be the relationship's own, else on all of these. cited: (ord,
    citation, numbers, requests as (key, value) pairs, identifiers), a row for each citation."""
    lines = said.select("ord", F.posexplode(F.array("assertion", "description")).alias("line_no", "line")).withColumn("own", F.array_distinct(F.regexp_extract_all("line", F.lit(f"({patterns.QUALIFIED_CITATION})"), 1)))
    meets = lines.join(cited, "ord").where((F.size("own") == 0) | F.array_contains("own", F.col("citation")))
    flat = lambda c: F.array_distinct(F.flatten(F.collect_list(c)))
    known = meets.groupBy("ord", "line_no").agg(flat(F.col("numbers")).alias("known"), flat(F.transform("requests", lambda r: r["value"])).alias("values"), flat(F.col("identifiers")).alias("identifiers"), F.collect_set("citation").alias("found"))
    both = lines.join(known, ["ord", "line_no"], "left")
    none = F.array().cast("array<string>")
    both = both.select("ord", "line", "own", *(F.coalesce(c, none).alias(c) for c in ("known", "values", "identifiers", "found")))
    lost = both.withColumn("numbers", numbers(F.col("line"))).withColumn("changed", unapproved(F.col("line"), F.col("values"), F.array_join("identifiers", " ")))
    return lost.where((F.size(F.array_except("numbers", "known")) > 0) | (F.size("changed") > 0) | (F.size(F.array_except("own", "found")) > 0)).select("ord").distinct()


def incidence(edges: DataFrame) -> DataFrame:
    """(node, direction, predicate, other): every edge from both of its ends."""
    out = edges.select(F.col("subject").alias("node"), F.lit("out").alias("direction"), "predicate", F.col("object").alias("other"))
    return out.union(edges.select(F.col("object").alias("node"), F.lit("in").alias("direction"), "predicate", F.col("subject").alias("other")))


def edge_violations(edges: DataFrame, entities: DataFrame) -> DataFrame:
    """(check_code, id): edges with an unknown end, a loop, or no citation shared with an end.

    edges: (id, subject, object, citations); entities: (id, citations)."""
    known = entities.select(F.col("id").alias("node"), F.col("citations").alias("theirs"))
    end = lambda node, loop: F.struct(node.alias("node"), loop.alias("loop"))
    whole = F.when(F.col("subject") == F.col("object"), end(F.lit(None), F.lit(True)))
    parts = F.array_compact(F.array(*(end(F.col(c), F.lit(False)) for c in ("subject", "object")), whole))
    ends = edges.select("id", F.inline(parts), "citations").join(known, "node", "left")  # loops go with the ends, so that edges are made once
    codes = F.when(F.col("loop"), "self-loop").when(F.col("theirs").isNull(), "unknown-endpoint").when(~F.arrays_overlap("citations", "theirs"), "no-shared-citation")
    found = ends.select(codes.alias("check_code"), "id").where("check_code is not null").groupBy("check_code", "id").count()
    times = F.when(F.col("check_code") == "self-loop", F.col("count").cast("int")).otherwise(1)
    return found.select("check_code", "id", F.explode(F.array_repeat(F.lit(0), times))).select("check_code", "id")


def shared_sources(pages: DataFrame, entities: DataFrame) -> DataFrame:
    """(page_id, entity_id) that list a source in common. Inputs: (id, source_id) rows.

    Rows of the same sources are a class. Classes meet on sources and are made distinct; as each page and each entity is in one
    class, so are the pairs then, without a shuffle of them."""

    def classes(rows: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
        listed = rows.where("source_id is not null").groupBy(F.col("id").alias(f"{name}_id")).agg(F.array_sort(F.collect_set("source_id")).alias("_sources"))
        listed = cut(listed.withColumn(f"_{name}", F.sha2(F.to_json("_sources"), 256)))
        return listed.drop("_sources"), listed.dropDuplicates([f"_{name}"]).select(f"_{name}", F.explode("_sources").alias("source_id"))

    (page_of, page_class), (entity_of, entity_class) = classes(pages, "page"), classes(entities, "entity")
    met = page_class.join(entity_class, "source_id").select("_page", "_entity").distinct()
    return crossed(page_of.join(met, "_page").select("page_id", "_entity"), entity_of, "_entity").select("page_id", "entity_id")
