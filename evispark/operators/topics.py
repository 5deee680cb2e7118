"""Topics: per slide, merged by title, with an overflow bucket, uncovered evidence, expansion and lineage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evispark.functions.udfs import call
from evispark.session import dealt


def ordered(values: Column, order: Column) -> Column:
    """Distinct values of a group in the order of their first place (the ordered distinct of the engine)."""
    return F.array_distinct(F.transform(F.sort_array(F.collect_list(F.struct(order.alias("o"), values.alias("v")))), lambda s: s["v"]))


def slide_topics(blocks: DataFrame, prefix: str = "Slide") -> DataFrame:
    """(source_id, slide_number, title, citations): a topic for each slide; the first title wins."""
    named = F.min(F.when(F.coalesce("slide_title", F.lit("")) != "", F.struct("rank", "slide_title")))
    out = blocks.groupBy("source_id", "slide_number").agg(named.alias("t"), ordered(F.col("citation"), F.col("rank")).alias("citations"))
    return out.select("source_id", "slide_number", F.coalesce("t.slide_title", F.concat(F.lit(f"{prefix} "), F.col("slide_number").cast("string"))).alias("title"), "citations")


def merge_topics(candidates: DataFrame, scope: list[str], key: Column) -> DataFrame:
    """Topics (scope, key, title, description, citations, first) from candidates (scope, ord, title, description, citation,
    rank): the first title and description win, citations are united by rank. Blank keys drop out."""
    keyed = candidates.withColumn("key", key).where("key <> ''")
    head = F.min(F.struct("ord", "title", "description"))
    out = keyed.groupBy(*scope, "key").agg(head.alias("h"), ordered(F.col("citation"), F.col("rank")).alias("citations"))
    return out.select(*scope, "key", F.col("h.title").alias("title"), F.col("h.description").alias("description"), "citations", F.col("h.ord").alias("first"))


def with_overflow(topics: DataFrame, scope: list[str], most: int, title: str = "Further evidence") -> DataFrame:
    """At most `most` topics in each scope: with more, the first most - 1 stay and one topic gathers the others' citations.

    topics: (scope, key, title, citations, first). Citations of the overflow come in topic order.
    """
    w = Window.partitionBy(*scope)
    ranked = topics.withColumn("n", F.count("*").over(w)).withColumn("place", F.row_number().over(w.orderBy("first", "key")))
    over = (F.col("n") > most) & (F.col("place") >= most)
    put = ranked.withColumn("slot", F.when(over, F.lit(most)).otherwise(F.col("place"))).withColumn("over", over)
    return put.groupBy(*scope, "slot").agg(F.when(F.max("over"), F.lit(title)).otherwise(F.min_by("title", "place")).alias("title"), F.array_distinct(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("place", "citations"))), lambda s: s["citations"]))).alias("citations"))


def uncovered(blocks: DataFrame, topics: DataFrame) -> DataFrame:
    """Blocks that no topic cites, as (source_id, citation, slide_number, rank). topics: (source_id, citations)."""
    cited = topics.select("source_id", F.explode("citations").alias("citation")).distinct()
    return blocks.join(cited, ["source_id", "citation"], "left_anti").select("source_id", "citation", "slide_number", "rank")


# Pairs for which another cell is made, cells of a key at most, rows that are gathered at most, about, and rows of a
# list on the left and right. Parquet packs dictionary indices by eights, in runs of 504 and in pages of 20,000 rows: a right list
# of so many repeats byte by byte in a page and compresses to little.
CELL_PAIRS, CELLS, PART, LEFTS, RIGHTS = 4_000_000, 64, 8064, 128, 504


def crossed(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Each row of left with each row of right of its key, for keys that many rows share. Rows are distinct on either side. The
    pairs are made where they are read.

    A key's rows travel as lists, right ones dealt among cells, left ones copied to each of them (and the other way, if right
    rows are too few), as many cells as its pairs are worth: no key is one task's, and rare ones are not copied. Two lists meet at a
    time, each left row with the whole right list, so that written pairs take little disk."""
    n = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counted = lambda df, name: df.groupBy(key).agg(F.count("*").alias(name))
    cells = F.least(F.ceil(F.col("_lefts").cast("double") * F.col("_rights") / CELL_PAIRS), F.lit(CELLS)).cast("int")
    sizes = counted(left, "_lefts").join(counted(right, "_rights"), key).withColumn("_across", F.least(cells, F.ceil(F.col("_rights") / RIGHTS)).cast("int"))
    sizes = sizes.withColumn("_down", F.ceil(cells / F.col("_across")).cast("int"))

    def lists(df: DataFrame, rows: str, dealt: str, most: int) -> DataFrame:
        """Lists of most rows, of fewer by eights at the end of a part, and of the less than eight that remain."""
        columns = [c for c in df.columns if c != key]
        part = F.pmod(F.xxhash64(*columns), F.col(dealt) * F.ceil(F.col(rows) / F.col(dealt) / PART)).alias("_part")
        parts = df.join(sizes, key).groupBy(key, "_across", "_down", part).agg(F.collect_list(F.struct(*columns)).alias(rows))
        whole = F.size(rows) - F.size(rows) % 8
        starts = F.array_union(F.sequence(F.lit(0), whole, F.lit(most)), F.array(whole))
        return parts.withColumn(rows, F.explode(F.transform(starts, lambda i: F.slice(rows, i + 1, F.when(i < whole, F.least(i + most, whole)).otherwise(F.size(rows)) - i))))

    each = lambda count: F.explode(F.sequence(F.lit(0), F.col(count) - 1))
    own = lambda count: (F.col("_part") % F.col(count)).cast("int")
    lefts = lists(left, "_lefts", "_down", LEFTS).select(key, each("_across").alias("_cell"), own("_down").alias("_deal"), "_lefts")
    rights = lists(right, "_rights", "_across", RIGHTS).select(key, own("_across").alias("_cell"), each("_down").alias("_deal"), "_rights")
    on = [key, "_cell", "_deal"]
    met = lefts.repartition(n, *on).join(rights.repartition(n, *on), on).select(key, "_lefts", "_rights")
    met = met.coalesce(1 << 20)  # joins nothing: generated code would hold all pairs of a left list at once, so it ends here
    pairs = met.select(key, F.explode("_lefts").alias("_left"), "_rights").select(key, "_left", F.explode("_rights").alias("_right"))
    field = lambda side, c: F.col(c) if c == key else F.col(f"{side}.{c}").alias(c)
    return pairs.select(*(field("_left", c) for c in left.columns), *(field("_right", c) for c in right.columns if c != key))


def expand_citations(topics: DataFrame, blocks: DataFrame) -> DataFrame:
    """Topics (topic_id, source_id, citation) whose seed has no request number in a source gain that source's citations
    which have one. blocks: (source_id, citation, has_request).

    What a topic gains it doesn't have, else it would not be bare, and each side is distinct; so the gained rows need no
    shuffle. Only citations that are null meet no block and may be there already."""
    seeds = topics.join(blocks, ["source_id", "citation"], "left")
    bare = seeds.groupBy("topic_id", "source_id").agg(F.max(F.coalesce("has_request", F.lit(False))).alias("any")).where("not any").select("topic_id", "source_id")
    lent = blocks.where("has_request").select("source_id", "citation").distinct()
    columns = ["topic_id", "source_id", "citation"]
    own = topics.select(*columns).union(bare.join(lent.where("citation is null"), "source_id").select(*columns)).distinct()
    return own.union(crossed(bare, lent.where("citation is not null"), "source_id").select(*columns))


def lineage(records: DataFrame, by_citation: DataFrame, by_source: DataFrame, fallback: bool = True, n: int | None = None) -> DataFrame:
    """(record_id, source_id, value): request numbers of a record's cited blocks, for each source; with fallback a source
    none of whose cited blocks has any lends all its numbers.

    records: (record_id, source_id, citation); by_citation: (source_id, citation, value); by_source: (source_id, value).
    n: among how many tasks each step deals its rows (`session.tasks`), else Spark's setting.
    """
    block, pair = ["source_id", "citation"], ["record_id", "source_id"]
    cited, known = dealt(records, n, *block), dealt(by_citation, n, *block)
    own = dealt(cited.join(known, block).select(*pair, "value"), n, *pair).distinct()
    if not fallback:
        return own
    held = cited.join(known.select(*block, F.lit(True).alias("held")), block, "left").select(*pair, "held")
    bare = dealt(held, n, *pair).groupBy(*pair).agg(F.max("held").alias("held"))
    bare = bare.where("held is null or record_id is null").select(*pair)  # a null equals no record that has its own
    return own.union(dealt(bare, n, "source_id").join(dealt(by_source, n, "source_id"), "source_id").select(*pair, "value").distinct())


def coverage(sources: DataFrame, pages: DataFrame, entities: DataFrame) -> DataFrame:
    """(source_id, page_ids, entity_ids, covered): which pages and entities list a source. Inputs: (id, source_id) rows."""
    ids = lambda df, name: df.groupBy("source_id").agg(F.sort_array(F.collect_set("id")).alias(name))
    none = F.array().cast("array<string>")
    out = sources.select("source_id").distinct().join(ids(pages, "page_ids"), "source_id", "left").join(ids(entities, "entity_ids"), "source_id", "left")
    return out.select("source_id", F.coalesce("page_ids", none).alias("page_ids"), F.coalesce("entity_ids", none).alias("entity_ids"), F.col("page_ids").isNotNull().alias("covered"))


def reconcile(left: DataFrame, right: DataFrame, key: list[str]) -> DataFrame:
    """(key, side): what one side lacks; nothing where both have it."""
    a, b = left.select(*key).distinct().withColumn("in_left", F.lit(True)), right.select(*key).distinct().withColumn("in_right", F.lit(True))
    both = a.join(b, key, "full_outer").where("in_left is null or in_right is null")
    return both.select(*key, F.when(F.col("in_left").isNull(), "extra").otherwise("missing").alias("side"))


def grounded_titles(topics: DataFrame, evidence: DataFrame, numbers=None) -> DataFrame:
    """Topics (topic_id, source_id, title, citations) whose title has no number that their cited evidence lacks.

    evidence: (source_id, citation, numbers). Topics without a citation that is evidence drop out.
    """
    numbers = numbers or (lambda c: call("prose_numbers", c))
    cited = topics.select("topic_id", "source_id", F.explode(F.array_distinct("citations")).alias("citation")).join(evidence, ["source_id", "citation"])
    known = cited.groupBy("topic_id").agg(F.array_distinct(F.flatten(F.collect_list("numbers"))).alias("known"))
    return topics.join(known, "topic_id").where(F.size(F.array_except(numbers(F.col("title")), "known")) == 0).drop("known")


def allowed_citations(evidence: DataFrame, group: str, most: int | None = None) -> DataFrame:
    """(group, citations): a chunk's citations in the order in which a model sees them: those with request numbers, then those
    with numbers or identifiers, then by name; the first `most` of them. evidence: (group, citation, requests, tokens)."""
    order = F.struct((F.size("requests") == 0).alias("r"), (F.size("tokens") == 0).alias("t"), "citation")
    listed = F.transform(F.array_sort(F.collect_set(order)), lambda x: x["citation"])
    return evidence.groupBy(group).agg((listed if most is None else F.slice(listed, 1, most)).alias("citations"))


def all_candidates(*lists: DataFrame) -> DataFrame:
    """Candidates of several passes (general, domain, entities alone) in one, missing fields null; `pass_no` keeps their order."""
    out = None
    for n, df in enumerate(lists):
        own = df.withColumn("pass_no", F.lit(n))
        out = own if out is None else out.unionByName(own, allowMissingColumns=True)
    return out
