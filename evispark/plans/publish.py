"""Publisher: pages as a table (path, body), rendered by joins and ordered aggregates, checked, then written and renamed."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evispark.functions import columns as C
from evispark.functions.udfs import call
from evispark.operators import chunks, graph
from evispark.operators.checks import bad_values, fail_closed
from evispark.session import cut


def lines(column: Column, order: Column, prefix: str = "- ") -> Column:
    """Distinct lines of a group in order, as a list."""
    return F.array_join(F.transform(F.sort_array(F.collect_set(F.struct(order.alias("o"), column.alias("v")))), lambda s: F.concat(F.lit(prefix), s["v"])), "\n")


def listed(df: DataFrame, column: str) -> Column:
    """A list column where there is one, else an empty list."""
    none = F.array().cast("array<string>")
    return F.coalesce(F.col(column), none) if column in df.columns else none


def page(title: Column, description: Column, tags: Column, body: Column, aliases: Column | None = None, requests: Column | None = None, sources: Column | None = None) -> Column:
    """A Markdown page with front matter of all seven keys, a heading and a body."""
    lists = lambda c: F.to_json(F.array().cast("array<string>") if c is None else c)
    head = C.front_matter({"title": C.json_text(title), "description": C.json_text(C.description(description)), "aliases": lists(aliases), "tags": F.to_json(tags), "pr_numbers": lists(requests), "source_ids": lists(sources), "draft": F.lit("false")})
    return F.concat(head, F.lit("\n# "), title, F.lit("\n\n"), body, F.lit("\n"))


def label(column: Column) -> Column:
    """Text as the words of a wiki link, which may hold no brackets or bars."""
    return F.trim(F.regexp_replace(F.coalesce(column, F.lit("")), r"[\[\]|\s]+", " "))


def wiki_link(folder: str, name: Column, title: Column) -> Column:
    return F.concat(F.lit(f"[[{folder}/"), name, F.lit("|"), label(title), F.lit("]]"))


def relationship_lines(edges: DataFrame, nodes: DataFrame, prefix: str) -> DataFrame:
    """(node, related): the relationships of each node whose id begins with prefix, as lines; node comes without it."""
    named = nodes.select(F.col("node").alias("other"), "link")
    near = graph.incidence(edges).where(F.startswith("node", F.lit(prefix))).join(named, "other").withColumn("line", F.concat(F.when(F.col("direction") == "out", "→ ").otherwise("← "), F.col("predicate"), F.lit(" "), F.col("link")))
    return near.groupBy(F.substring("node", len(prefix) + 1, 1 << 30).alias("node")).agg(lines(F.col("line"), F.struct("direction", "predicate", "link")).alias("related"))


def entity_pages(entities: DataFrame, edges: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    """(path, body) for each entity (id, name, type, description, aliases, citations), with its relationships.

    nodes: (node, link) of everything that an edge may end at, where an entity's node is entity:id; without it the ends are
    ids of entities."""
    prefix = "entity:" if nodes is not None else ""
    if nodes is None:
        nodes = entities.select(F.col("id").alias("node"), wiki_link("entities", F.col("id"), F.col("name")).alias("link"))
    related = relationship_lines(edges, nodes, prefix).withColumnRenamed("node", "id")
    section = lambda head, text: F.when(F.coalesce(text, F.lit("")) != "", F.concat(F.lit(f"## {head}\n\n"), text))
    bullets = lambda c: F.array_join(F.transform(c, lambda x: F.concat(F.lit("- "), x)), "\n")
    body = F.concat_ws("\n\n", F.col("description"), section("Aliases", bullets("aliases")), section("Evidence", bullets("citations")), section("Relationships", F.col("related")))
    return entities.join(related, "id", "left").select(F.concat(F.lit("entities/"), "id", F.lit(".md")).alias("path"), page(F.col("name"), F.col("description"), F.array("type"), body, F.col("aliases"), listed(entities, "requests"), listed(entities, "source_ids")).alias("body"))


def request_pages(values: DataFrame, sources: DataFrame, topics: DataFrame, entities: DataFrame, edges: DataFrame | None = None, nodes: DataFrame | None = None) -> DataFrame:
    """(path, body) for each request number: the sources, topics and entities that carry it, and its relationships.

    values: (value, slug); the next three: (value, id, title); edges and nodes as for entity_pages, where a request's node is
    pr:value."""
    out = values
    for name, df in (("Sources", sources), ("Topics", topics), ("Entities", entities)):
        link = wiki_link(name.lower(), F.col("id"), F.col("title"))
        ids = [F.sort_array(F.collect_set("id")).alias("source_ids")] * (name == "Sources")
        out = out.join(df.groupBy("value").agg(F.concat(F.lit(f"## {name}\n\n"), lines(link, F.col("title"))).alias(name), *ids), "value", "left")
    sections = ["Sources", "Topics", "Entities"]
    if edges is not None:
        near = relationship_lines(edges, nodes, "pr:").select(F.col("node").alias("value"), F.concat(F.lit("## Relationships\n\n"), F.col("related")).alias("Relationships"))
        out, sections = out.join(near, "value", "left"), [*sections, "Relationships"]
    body = F.concat_ws("\n\n", *sections)
    return out.select(F.concat(F.lit("requests/"), "slug", F.lit(".md")).alias("path"), page(F.col("value"), F.col("value"), F.array(F.lit("request")), body, None, F.array("value"), listed(out, "source_ids")).alias("body"))


def topic_pages(topics: DataFrame, related: DataFrame) -> DataFrame:
    """(path, body) of topics (slug, title, body) with the entities that share a source. related: (slug, id, name)."""
    links = related.groupBy("slug").agg(lines(wiki_link("entities", F.col("id"), F.col("name")), F.col("id")).alias("related"))
    body = F.concat_ws("\n\n", "body", F.concat(F.lit("## Related entities\n\n"), F.col("related")))
    return topics.join(links, "slug", "left").select(F.concat(F.lit("topics/"), "slug", F.lit(".md")).alias("path"), page(F.col("title"), F.col("title"), F.array(F.lit("topic")), body, None, listed(topics, "requests"), listed(topics, "source_ids")).alias("body"))


def index_page(title: str, sections: dict[str, DataFrame]) -> DataFrame:
    """One page that lists (id, title) rows of every section, sorted without regard to case."""
    return index_pages(title, sections, most=None)


#: Titles of an index page at most.
INDEX_LINES = 1_000


def index_pages(title: str, sections: dict[str, DataFrame], most: int | None = INDEX_LINES) -> DataFrame:
    """(path, body): the index of (id, title) rows of every section, sorted without regard to case. Sections of more than `most`
    rows lie on pages of their own, range by range, and the index lists these pages by their first and last titles; so do
    pages of pages, until no page has more lines."""
    rows = None
    for n, (name, df) in enumerate(sections.items()):
        own = df.select(F.lit(n).alias("n"), F.lit(name).alias("group"), call("stable_key", "title").alias("k"), wiki_link(name.lower(), F.col("id"), F.col("title")).alias("link"), label(F.col("title")).alias("first"), label(F.col("title")).alias("last"))
        rows = own if rows is None else rows.union(own)
    pages, level = None, 0
    while most is not None and rows.groupBy("group").count().where(F.col("count") > most).limit(1).count():
        large = cut(rows.groupBy("group").count().where(F.col("count") > most).select("group"))  # as many as sections at most
        split = chunks.running(rows.join(large, "group", "left_semi"), ["k", "link"], F.lit(1).cast("long")).withColumn("no", F.expr(f"before div {most}L") + 1)
        ends = lambda f, c: f(F.col(c), F.struct("k", "link"))
        lists = cut(split.groupBy("n", "group", "no").agg(lines(F.col("link"), F.struct("k", "link")).alias("list"), F.min("k").alias("k"), ends(F.min_by, "first").alias("first"), ends(F.max_by, "last").alias("last")))
        name = F.concat(F.lower("group"), F.lit(f"-{level}-"), F.lpad(F.col("no").cast("string"), 9, "0"))
        head = F.concat("group", F.lit(": "), "first", F.lit(" – "), "last")
        own = lists.select(F.concat(F.lit("index/"), name, F.lit(".md")).alias("path"), page(head, head, F.array(F.lit("index")), F.col("list")).alias("body"))
        pages = own if pages is None else pages.union(own)
        above = lists.select("n", "group", "k", wiki_link("index", name, F.concat("first", F.lit(" – "), "last")).alias("link"), "first", "last")
        rows, level = cut(rows.join(large, "group", "left_anti").select(above.columns).union(above)), level + 1
    one = rows.groupBy("n", "group").agg(lines(F.col("link"), F.struct("k", "link")).alias("list")).select("n", F.concat(F.lit("## "), "group", F.lit("\n\n"), "list").alias("s"))
    top = one.agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("n", "s"))), lambda x: x["s"]), "\n\n").alias("body")).select(F.lit("index.md").alias("path"), page(F.lit(title), F.lit(title), F.array(F.lit("index")), F.col("body")).alias("body"))
    return top if pages is None else top.union(pages)


def dossiers(sources: DataFrame, ledger_values: DataFrame, evidence: DataFrame) -> DataFrame:
    """(path, body) of a page for each source (source_id, title, body): its requests, text and evidence list.

    ledger_values: (source_id, values); evidence: (source_id, citation, rank)."""
    cited = evidence.groupBy("source_id").agg(lines(F.col("citation"), F.col("rank")).alias("cited"))
    out = sources.join(ledger_values, "source_id", "left").join(cited, "source_id", "left")
    requests = F.array_join(F.transform("values", lambda v: F.concat(F.lit("- "), v)), "\n")
    body = F.concat_ws("\n\n", F.when(F.size("values") > 0, F.concat(F.lit("## Requests\n\n"), requests)), F.col("body"), F.concat(F.lit("## Evidence\n\n"), "cited"))
    return out.select(F.concat(F.lit("sources/"), "source_id", F.lit(".md")).alias("path"), page(F.col("title"), F.col("title"), F.array(F.lit("source")), body, None, listed(out, "values"), F.array("source_id")).alias("body"))


def manifest(files: DataFrame) -> DataFrame:
    """(path, sha256, bytes) of files (path, body)."""
    return files.select("path", C.sha256(F.col("body")).alias("sha256"), F.octet_length(F.encode("body", "UTF-8")).cast("long").alias("bytes"))


def asset_files(assets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Files (path, content) and violations of assets (source_id, path, content, sha256): each lies once under its source and
    digest, whatever it was called. What isn't the declared bytes is a violation and no file.

    Digests are taken first, so that equal contents meet only once for each of a source's digests and suffixes."""
    suffix = F.regexp_extract(F.lower("path"), r"(\.[a-z0-9]{1,10})$", 1)
    named = assets.withColumn("digest", F.sha2("content", 256)).withColumn("suffix", F.when(suffix == "", ".bin").otherwise(suffix))
    wrong = named.where(~F.coalesce(F.col("sha256") == F.col("digest"), F.lit(False)))
    place = F.concat_ws("/", F.lit("assets"), "source_id", F.concat("digest", "suffix"))
    good = named.where("sha256 = digest").select(place.alias("path"), "content").dropDuplicates(["path"])
    return good, bad_values(wrong, "asset-digest", F.concat_ws("/", "source_id", "path"), F.lit(True), F.col("digest"))


def publish(files: DataFrame, target: str, violations: DataFrame | None = None, assets: DataFrame | None = None) -> None:
    """Write pages (path, body), body a text or bytes, and assets (path, content) at their paths below a new folder: checks first,
    then a staging folder, then one rename.

    Tasks write their own pages, so a large site stays distributed; a task that runs again writes the same pages again. Only
    the rename is the driver's. The target must not exist.
    """
    if violations is not None:
        fail_closed(violations)
    spark = files.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    place = lambda p: jvm.org.apache.hadoop.fs.Path(p)
    fs = place(target).getFileSystem(conf)
    if fs.exists(place(target)):
        raise FileExistsError(target)
    stage = f"{target.rstrip('/')}.{uuid.uuid4().hex}.incomplete"
    root = re.sub("^file:/+", "file:///", fs.makeQualified(place(stage)).toString())

    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow.fs import FileSystem

        store, base = FileSystem.from_uri(root)
        for frame in frames:
            for path, body in zip(frame.path, frame.body, strict=True):
                if ".." in path.split("/") or path.startswith("/"):
                    raise ValueError(f"{path} leaves the site")
                store.create_dir(f"{base}/{path}".rpartition("/")[0])
                with store.open_output_stream(f"{base}/{path}") as out:
                    out.write(body.encode() if isinstance(body, str) else bytes(body))
            yield pd.DataFrame({"n": [len(frame)]})

    fs.mkdirs(place(stage))
    files.select("path", "body").mapInPandas(write, "n long").agg(F.sum("n")).collect()
    if assets is not None:
        assets.select("path", F.col("content").alias("body")).mapInPandas(write, "n long").agg(F.sum("n")).collect()
    if not fs.rename(place(stage), place(target)):
        raise OSError(f"cannot rename to {target}")

