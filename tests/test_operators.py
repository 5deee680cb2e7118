"""Operators against DuckDB on the registered queries, and small cases that the tables don't hold."""

import hashlib
import io
import json
import re
import zipfile

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from evispark import queries as engine
from evispark import session as settings
from evispark.functions import columns as C
from evispark.functions import html, patterns, text
from evispark.functions.udfs import call
from evispark.operators import blocks, checks, chunks, decisions, graph, links, readers, topics
from evispark.plans import publish, stages
from evispark.sources import files, ooxml

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(x):
    if hasattr(x, "asDict"):
        return plain(x.asDict())
    if isinstance(x, dict):
        return tuple(sorted((k, plain(v)) for k, v in x.items()))
    return tuple(map(plain, x)) if isinstance(x, (list, tuple)) else x


@pytest.mark.parametrize("name", sorted(engine.QUERIES))
def test_query(spark, duck, name):
    df = engine.QUERIES[name](spark, SF)
    rows = df.collect()
    assert len(set(df.columns)) == len(df.columns)
    if name in engine.SQL:
        r = duck.execute(engine.SQL[name])
        cols = [c[0] for c in r.description]
        assert sorted(cols) == sorted(df.columns)
        want = sorted((plain(tuple(x[cols.index(c)] for c in df.columns)) for x in r.fetchall()), key=repr)
        assert sorted((plain(tuple(x)) for x in rows), key=repr) == want


@pytest.mark.parametrize("name", ["fallback_lineage", "manifest_reconcile"])
def test_more_rows_more_tasks(spark, duck, monkeypatch, name):
    """Rows are dealt among tasks by their number, not among a fixed number of them, and stay the same."""
    monkeypatch.setattr(settings, "TASK_ROWS", 400, raising=False)
    df = engine.QUERIES[name](spark, SF)
    assert max(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()) < 400
    test_query(spark, duck, name)


@pytest.mark.parametrize("name", ["fallback_lineage", "manifest_reconcile"])
def test_many_rows_are_not_put_together(spark, duck, monkeypatch, name):
    """Partitions that Spark's setting names stay apart, though few bytes lie in them."""
    monkeypatch.setattr(settings, "TASK_ROWS", 2000, raising=False)
    df = engine.QUERIES[name](spark, SF)
    assert sum(r["count"] > 0 for r in df.groupBy(F.spark_partition_id()).count().collect()) >= 4
    assert max(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()) < 1000
    test_query(spark, duck, name)


def test_lineage(spark):
    """Own numbers of a record and source, in several tasks or one; a source without lends all of its own; nulls equal nothing."""
    records = spark.createDataFrame([(1, "s", "a"), (1, "s", "b"), (2, "s", "b"), (2, "t", "a"), (3, "u", "a"), (None, "s", "a"), (4, None, "a"), (5, "s", None)], "record_id long, source_id string, citation string")
    known = spark.createDataFrame([("s", "a", "7"), ("s", "a", "7"), ("s", "a", "8"), (None, "a", "9"), ("s", None, "9"), ("u", "a", None)], "source_id string, citation string, value string")
    lent = spark.createDataFrame([("s", "7"), ("s", "6"), ("s", "6"), ("u", "6"), (None, "6")], "source_id string, value string")
    own = [(1, "s", "7"), (1, "s", "8"), (3, "u", None), (None, "s", "7"), (None, "s", "8")]
    both = [*own, *((r, "s", v) for r in (2, 5, None) for v in "67")]
    for n in (None, 3):
        assert sorted(map(tuple, topics.lineage(records, known, lent, fallback=False, n=n).collect()), key=repr) == sorted(own, key=repr)
        assert sorted(map(tuple, topics.lineage(records, known, lent, n=n).collect()), key=repr) == sorted(both, key=repr)


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_whole_sources_span_decks(spark, tmp_path):
    """A copy whose original has an id in another thousand is a copy all the same; topics, ids and chunks go on too."""
    spark.createDataFrame([(5, "a b", "en", "s"), (1005, "a  b", "en", "s"), (2005, "c", "en", "t")], "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1005, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    run = lambda name: engine.QUERIES[name](spark, str(tmp_path)).collect()
    assert [tuple(r) for r in run("dup_map")] == [("s", "[slide-1006#doc-1005]", "[slide-6#doc-5]")]
    assert {(r.citation, r.disposition) for r in run("keep_decisions")} == {("[slide-6#doc-5]", "keep"), ("[slide-1006#doc-1005]", "duplicate"), ("[slide-2006#doc-2005]", "keep")}
    assert {(r.source_id, len(r.citations)) for r in run("topic_merge")} == {("s", 1), ("t", 1)}
    assert {(r.source_id, r["rank"], r.chunk) for r in run("chunk_pack")} == {("s", 5, 1), ("s", 1005, 1), ("t", 2005, 1)}
    assert {r.source_id for r in run("unique_element_ids")} == {"s", "t"}


def test_every_document_seeds_a_topic(spark, tmp_path):
    ids = [3, 4, 5, 1005, 1007, 2007]
    spark.createDataFrame([(i, "x", "en", "t" if i == 5 else "s") for i in ids], "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    want = {(i, "t" if i == 5 else "s", f"c{i}") for i in ids} | {(i, "s", f"c{j}") for i in (4, 1007) for j in (3, 1005, 2007)}
    got = [tuple(r) for r in engine.QUERIES["topic_expand"](spark, str(tmp_path)).collect()]
    assert len(got) == len(want) and set(got) == want


def test_nations_are_shared_by_many(spark, tmp_path):
    customers, suppliers = [(i, i % 2) for i in range(1, 13)], [(1, 0), (12, 0), (22, 0), (3, 1), (2505, 1)]
    spark.createDataFrame(customers, "c_custkey long, c_nationkey int").write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame([(k, n, f"S{k}") for k, n in suppliers], "s_suppkey long, s_nationkey int, s_name string").write.parquet(f"{tmp_path}/supplier.parquet")
    pairs = sorted((c, s) for c, n in customers for s, m in suppliers if n == m)
    assert sorted(map(tuple, engine.QUERIES["shared_sources"](spark, str(tmp_path)).collect())) == pairs
    met = {c: [s for s, m in suppliers if n == m and c % 10 == s % 10] for c, n in customers}
    got = dict(map(tuple, engine.QUERIES["alias_resolve"](spark, str(tmp_path)).collect()))
    assert got == {c: s[0] for c, s in met.items() if len(s) == 1} and 2505 in got.values() and 2 not in got


def test_gained_citations_are_not_shuffled(spark):
    """Only small tables are dealt out, the pairs aren't made distinct; citations that are null come once."""
    t = spark.createDataFrame([(i, "s", f"c{i}") for i in range(6)] + [(7, "s", None), (7, "s", None), (8, "t", None), (9, None, "c1")], "topic_id long, source_id string, citation string")
    b = spark.createDataFrame([("s", f"c{i}", i % 3 == 0) for i in range(6)] + [("s", None, True), ("s", "c3", None), ("s", "c3", True)], "source_id string, citation string, has_request boolean")
    got = topics.expand_citations(t, b)
    gained = {(i, "s", c) for i in (1, 2, 4, 5, 7) for c in ("c0", "c3", None)}
    want = {tuple(r) for r in t.collect()} | gained
    rows = [tuple(r) for r in got.collect()]
    assert set(rows) == want and len(rows) == len(want)
    assert got._jdf.queryExecution().optimizedPlan().toString().startswith("Union")  # an Aggregate over all pairs before


def test_pairs_of_a_wide_source_take_little_disk(spark, tmp_path):
    """Pairs come list by list, so that Parquet packs them: 0.38 bytes a pair here before, 0.16 now."""
    t = spark.range(400).select(F.col("id").alias("topic_id"), F.lit("s").alias("source_id"))
    c = spark.range(20000).select(F.lit("s").alias("source_id"), F.concat(F.lit("c"), F.col("id").cast("string")).alias("citation"))
    topics.crossed(t, c, "source_id").write.parquet(f"{tmp_path}/pairs")
    got = spark.read.parquet(f"{tmp_path}/pairs")
    assert got.count() == got.distinct().count() == 400 * 20000
    assert sum(p.stat().st_size for p in tmp_path.glob("pairs/*.parquet")) < 0.25 * 400 * 20000


@pytest.mark.parametrize(("lefts", "rights"), [(700, 9), (9, 700), (137, 1050), (1, 1), (8, 504), (0, 5)])
def test_crossed_makes_each_pair_once(spark, monkeypatch, lefts, rights):
    """Many cells, also where the right side has fewer lists than cells; a key on one side, a null key and rare keys as well."""
    for name, value in {"CELL_PAIRS": 500, "CELLS": 7, "PART": 40, "LEFTS": 16, "RIGHTS": 24}.items():
        monkeypatch.setattr(topics, name, value, raising=False)
    left = [("hot", i, None if i == 3 else -i) for i in range(lefts)] + [("rare", 1, 2), ("left", 1, 2), (None, 1, 2)]
    right = [("hot", f"c{i}" if i else None) for i in range(rights)] + [("rare", "r"), ("right", "r"), (None, "r")]
    a, b = spark.createDataFrame(left, "k string, i long, j long"), spark.createDataFrame(right, "k string, c string")
    got = sorted(map(tuple, topics.crossed(a, b, "k").select("k", "i", "j", "c").collect()), key=repr)
    assert got == sorted(((*x, y[1]) for x in left for y in right if x[0] == y[0] and x[0]), key=repr)


def test_shared_sources_of_many_lists(spark):
    """Pairs that meet on several sources come once, without distinct over pairs."""
    p = spark.createDataFrame([(1, "a"), (1, "b"), (2, "b"), (2, "b"), (3, "a"), (3, "b"), (4, None), (5, "z")], "id long, source_id string")
    e = spark.createDataFrame([(10, "a"), (10, "b"), (11, "b"), (12, "a"), (12, "q"), (13, None), (None, "b")], "id long, source_id string")
    got = graph.shared_sources(p, e)
    want = {(x.id, y.id) for x in p.collect() for y in e.collect() if x.source_id is not None and x.source_id == y.source_id}
    rows = [tuple(r) for r in got.collect()]
    assert set(rows) == want and len(rows) == len(want)
    assert got._jdf.queryExecution().optimizedPlan().toString().startswith("Project")  # an Aggregate over all pairs before


def _joined_rows(spark, run) -> int:
    """The most rows that a join made while run() ran, as Spark counts them."""
    store, bus = spark._jsparkSession.sharedState().statusStore(), spark.sparkContext._jsc.sc().listenerBus()
    bus.waitUntilEmpty(30_000)
    before, most = store.executionsList().size(), 0
    run()
    bus.waitUntilEmpty(30_000)
    done = store.executionsList()
    for i in range(before, done.size()):
        number = done.apply(i).executionId()
        values, nodes = store.executionMetrics(number), store.planGraph(number).allNodes()
        for n in (nodes.apply(k) for k in range(nodes.size())):
            counts = [n.metrics().apply(k) for k in range(n.metrics().size())] if "Join" in n.name() else []
            most = max([most, *(int(values.apply(m.accumulatorId()).replace(",", "")) for m in counts if m.name() == "number of output rows" and values.contains(m.accumulatorId()))])
    return most


def test_names_of_many_meet_a_mention_once(spark):
    """A name that 300 entities share with a citation makes a row for each mention, not 300; one entity's name resolves."""
    m = spark.range(300).selectExpr("id as mention_id", "if(id < 299, 'a', 'b') as key", "'s' as source_id", "array('c', 'd') as citations")
    e = spark.range(300).selectExpr("id as entity_id", "if(id < 299, array('a'), array('b', 'b')) as keys", "'s' as source_id", "array('c', 'd') as citations")
    out = []
    assert _joined_rows(spark, lambda: out.extend(graph.resolve_aliases(m, e).collect())) <= 600
    assert [tuple(r) for r in out] == [(299, 299)]


def test_ends_of_many_meet_a_relationship_once(spark):
    """Of an item that 300 parts are, one is a material; so that one is the object of uses_material, and none of related_to."""
    found = spark.range(300).selectExpr("id as ord", "'s' as source_id", "if(id % 2 = 0, 'uses_material', 'related_to') as predicate", "'PR-1' as subject", "cast(null as string) as subject_type", "'item' as object", "cast(null as string) as object_type", "'It holds' as assertion", "'' as description", "array('c') as citations")
    e = spark.range(300).selectExpr("concat('p', id) as entity_id", "if(id = 7, 'material', if(id % 2 = 0, 'lot', 'other')) as type", "array('item') as keys", "'s' as source_id", "array('c') as citations")
    evidence = spark.sql("select 's' as source_id, 'c' as citation, array('1') as numbers, array(named_struct('key', '1', 'value', 'PR-1')) as requests")
    out = []
    assert _joined_rows(spark, lambda: out.extend(graph.resolve_edges(found, e, evidence).collect())) <= 900
    assert [(r.predicate, r.subject, r.object) for r in out] == [("uses_material", "pr:PR-1", "entity:p7")]


def test_a_citation_of_many_facts_meets_claims_alone(spark):
    lines = spark.range(100).selectExpr("cast(id as string) as page_id", "1 as line_no", "concat('It has ', id, ' [slide-1#a]') as line")
    facts = spark.range(1000).selectExpr("'[slide-1#a]' as citation", "cast(id % 50 as string) as number")
    out = []
    assert _joined_rows(spark, lambda: out.extend(checks.line_grounding(lines, facts).collect())) <= 100
    assert sorted(int(r.detail) for r in out) == list(range(50, 100))


def test_python_batches_are_bounded_by_bytes(spark):
    """A batch of long texts is small, though it may hold 10,000 rows; what the user set stays."""
    import pandas as pd

    from evispark import session

    key = "spark.sql.execution.arrow.maxBytesPerBatch"

    @F.pandas_udf("long")
    def held(text: pd.Series) -> pd.Series:
        return pd.Series([text.str.len().sum()] * len(text))

    spark.conf.unset(key)
    call("collapse_text", F.lit("a"))
    long = spark.range(0, 200, 1, 1).select(F.repeat(F.lit("x"), 100_000).alias("text"))
    assert long.select(held("text").alias("n")).agg(F.max("n")).first()[0] <= session.ARROW_BYTES + 100_000
    spark.conf.set(key, "123456")
    readers.read_payloads(spark.createDataFrame([("{}",)], "payload string"))
    assert spark.conf.get(key) == "123456"
    spark.conf.unset(key)


def test_plain_markup_is_split_as_the_parser_does(monkeypatch):
    import random

    bits = ["<table>", "<TR>", "</td>", "<p>", "<td >", "<br>", "<script>", "</script>", "<td a=1>", "&amp;", "&", "<", ">", "a", " b ", "\n", "\u00a0", "\u2028", "\x1f", "<!-- c -->", "<ſub>", "</table>"]
    dealt = random.Random(5)
    cases = ["".join(dealt.choices(bits, k=dealt.randint(0, 8))) for _ in range(20_000)] + ["", None, "<td>1</td><td> 2\n3 </td>"]
    fast = [html.html_text(c) for c in cases]
    used = sum(html._PLAIN.fullmatch(c or "") is not None for c in cases)
    monkeypatch.setattr(html, "_PLAIN", re.compile("(?!)"))
    assert fast == [html.html_text(c) for c in cases] and used > 500


def test_edges_are_made_once_for_ends_and_loops(spark):
    e = spark.createDataFrame([("a", "x", "x", ["c"]), ("a", "x", "x", ["c"]), ("b", "x", "y", ["d"]), ("c", "x", None, ["c"])], "id string, subject string, object string, citations array<string>")
    known = spark.createDataFrame([("x", ["c"])], "id string, citations array<string>")
    found = graph.edge_violations(e, known)
    assert sorted(map(tuple, found.collect())) == [("no-shared-citation", "b"), ("self-loop", "a"), ("self-loop", "a"), ("unknown-endpoint", "b"), ("unknown-endpoint", "c")]
    assert found._jdf.queryExecution().optimizedPlan().toString().count("subject#") and "Union" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_decision_precedence(spark):
    b = spark.createDataFrame([("s", f"c{i}", i, "", "text", "text", t) for i, t in enumerate(["PR-1 x", "g  h", "g h", "PR-1 x", "k"])], "source_id string, citation string, rank int, slide_title string, kind string, content_format string, content string").withColumn("slide_number", F.lit(1)).withColumn("element_id", F.col("citation"))
    out = stages.organise(b, spark.createDataFrame([("s", "c2")], "source_id string, citation string"))
    got = {r.citation: (r.disposition, r.reason_code, r.duplicate_of) for r in out.decisions.collect()}
    assert got == {"c0": ("keep", "protected", None), "c1": ("keep", "selected", None), "c2": ("duplicate", "exact_duplicate", "c1"), "c3": ("keep", "protected", None), "c4": ("omit", "out_of_scope", None)}
    assert [r["values"] for r in out.inventory.collect()] == [["PR-1"]]
    assert stages.complete_decisions(b, out.decisions).count() == 0
    whole = decisions.decisions(b, out.decisions.limit(0).select("source_id", "citation"), out.decisions.limit(0).select("source_id", "citation"), out.duplicates.limit(0))
    assert whole.where("disposition = 'keep'").count() == 5


def test_source_ids_grow(spark):
    same, other = "ab" * 8, "cd" * 24
    digests = [same + "00" + other, same + "01" + other, "ff" * 32, "ff" * 32]
    rows = decisions.source_ids(spark.createDataFrame([(d,) for d in digests], "sha256 string")).collect()
    assert sorted(r.source_id for r in rows) == sorted({f"deck-{d[:18]}" for d in digests})
    assert {r.source_id for r in decisions.source_ids(spark.createDataFrame([(d,) for d in digests[1:]], "sha256 string")).collect()} == {f"deck-{d[:16]}" for d in digests[1:]}


def test_number_tokens_by_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = sorted({(r.doc_id, n) for r in rows for n in re.findall(patterns.RAW_NUMBER, r.text or "")})
    assert sorted(map(tuple, engine.QUERIES["number_tokens"](spark, SF).collect())) == want
    assert re.findall(patterns.RAW_NUMBER, "AB12 1,2,3 1,234 +5% 12.5x") == ["1", "2", "3", "1,234", "+5%", "12"]


def test_kernels_over_whole_tables(spark):
    """Queries without SQL against plain Python over all rows."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    run = lambda name: sorted(map(tuple, engine.QUERIES[name](spark, SF).collect()))
    assert run("prose_number_tokens") == sorted((r.doc_id, n) for r in docs for n in text.prose_numbers(r.text))
    assert run("identifier_tokens") == sorted((r.doc_id, n) for r in docs for n in text.identifiers(r.text))
    got = engine.QUERIES["fragment_split"](spark, SF).collect()
    pieces = {}
    for r in sorted(got, key=lambda r: r.position):
        pieces.setdefault(r.doc_id, []).append(r.fragment)
    assert {d: "".join(p).replace("\n", "") for d, p in pieces.items()} == {r.doc_id: (r.text or "").replace("\n", "") for r in docs} and all(len(r.fragment) <= 500 for r in got)


def test_chunks_by_brute_force(spark):
    """Greedy packing over the whole table, in plain Python."""
    rows = sorted((r.source, r.doc_id, r.text or "") for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    want, state = [], {}
    for source, doc, body in rows:
        for i, part in enumerate(text.split_text(body, 2000 - 60 - 32), 1):
            chunk, used = state.get(source, (1, 0))
            size = 60 + len(part)
            if used and used + 2 + size > 2000:
                chunk, used = chunk + 1, 0
            state[source] = chunk, used + size + (2 if used else 0)
            want.append((source, doc, i, chunk))
    assert sorted(tuple(r) for r in engine.QUERIES["chunk_pack"](spark, SF).collect()) == sorted(want) and max(w[3] for w in want) > 5


def greedy(sizes, budget):
    chunk, used = 0, None
    for size in sizes:
        if used is None or used + 2 + size > budget:
            chunk, used = chunk + 1, size
        else:
            used += 2 + size
        yield chunk


def test_chunks_of_one_source_over_tasks(spark, monkeypatch):
    """One source of 100,000 rows: bins of 3,000 characters and parts of four bins make several rounds; small and empty
    sources, a null source, fragments over the budget, a tail that ends in a bin without any start."""
    import random

    monkeypatch.setattr(chunks, "BIN", 3000)
    monkeypatch.setattr(chunks, "FAN", 4)
    rng = random.Random(4)
    sizes = {"hot": [rng.randrange(9) for _ in range(100_000)], "one": [3], "none": [], None: [0, 0, 290, 1, 400, 7], "full": [100] * 500, "tail": [290] * 11 + [1, 1]}
    for k in range(30):
        sizes[f"s{k}"] = [rng.choice([0, 1, 50, 299, 300, 301, 900]) for _ in range(rng.randrange(200))]
    rows = [(g, i, "x" * n) for g, own in sizes.items() for i, n in enumerate(own)]
    rng.shuffle(rows)
    got = chunks.chunk_blocks(spark.createDataFrame(rows, "source_id string, rank long, content string"), 300).collect()
    want = []
    for g, own in sizes.items():
        parts = [(i, k, len(p)) for i, n in enumerate(own) for k, p in enumerate(text.split_text("x" * n, 268), 1)]
        want += [(g, i, k, c) for (i, k, _), c in zip(parts, greedy([n for *_, n in parts], 300), strict=True)]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr) and max(w[3] for w in want) > 1000


def test_html_to_text_by_brute_force(spark):
    pages = {r.page_id: html.plain_text(r.html) for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    assert {r.page_id: r.text for r in engine.QUERIES["html_to_text"](spark, SF).collect()} == pages


def test_edges_resolve(spark):
    found = spark.createDataFrame([
        (1, "s", "has_lot", "PR-7", None, "Lot A", None, "PR-7 has lot A", None, ["c1", "c9"]),  # a request as an end
        (2, "s", "HAS_LOT", "Box", None, "twin", None, "box holds the twin", "d", ["c1"]),  # the lot, not the box
        (3, "s", "related_to", "Box", None, "twin", None, "which twin?", "d", ["c1"]),  # two of the name
        (4, "s", "related_to", "Box", None, "twin", "product", "the product", "d", ["c1"]),  # asked for by kind
        (5, "s", "has_lot", "Box", None, "Lot A", None, "it holds 9", "d", ["c1"]),  # 9 stands nowhere
        (6, "s", "has_lot", "Box", None, "Lot A", None, "", "d", ["c1"]),
        (7, "s", "owns", "Box", None, "Lot A", None, "owns", "d", ["c1"]),
        (8, "s", "related_to", "Box", None, "box", None, "itself", "d", ["c1"]),
        (9, "s", "has_lot", "Box", None, "twin", None, "Box holds  the TWIN", "e", ["c2"]),  # the same edge again
        (10, "t", "has_lot", "Box", None, "Lot A", None, "other source", "d", ["c1"]),
    ], "ord int, source_id string, predicate string, subject string, subject_type string, object string, object_type string, assertion string, description string, citations array<string>")
    entities = spark.createDataFrame([("e1", "product", ["box"], "s", ["c1", "c2"]), ("e2", "lot", ["twin"], "s", ["c1", "c2"]), ("e3", "product", ["twin"], "s", ["c1"]), ("e4", "lot", ["lot a"], "s", ["c1"])], "entity_id string, type string, keys array<string>, source_id string, citations array<string>")
    evidence = spark.createDataFrame([("s", "c1", ["7"], [("7", "PR-7")]), ("s", "c2", [], [("8", "PR-8")])], "source_id string, citation string, numbers array<string>, requests array<struct<key:string,value:string>>")
    got = {(r.predicate, r.subject, r.object): (r.description, r.citations, r.requests) for r in graph.resolve_edges(found, entities, evidence).collect()}
    assert got == {
        ("has_lot", "pr:PR-7", "entity:e4"): ("PR-7 has lot A", ["c1"], ["PR-7"]),
        ("has_lot", "entity:e1", "entity:e2"): ("d", ["c1", "c2"], ["PR-7", "PR-8"]),
        ("related_to", "entity:e1", "entity:e3"): ("d", ["c1"], ["PR-7"]),
    }


def test_unique_ids_probe_later_ids(spark):
    df = spark.createDataFrame([(1, i, n) for i, n in enumerate(["a", "a--2", "a", "a"])], "slide int, ord int, base string")
    got = [r.unique_id for r in blocks.unique_ids(df, ["slide"], "base", "ord").orderBy("ord").collect()]
    assert got == ["a", "a--2", "a--3", "a--4"]


def test_grounding_and_fail_closed(spark):
    p = spark.createDataFrame([("p", "300 [slide-1#a]", ["[slide-1#a]"], "100 200")], "page_id string, body string, citations array<string>, evidence string")
    found = checks.grounding(p)
    assert [(r.check_code, r.detail) for r in found.collect()] == [("number", "300")]
    with pytest.raises(checks.CheckError):
        checks.fail_closed(found)
    lines = spark.createDataFrame([("p", 1, "40 and 50 [slide-1#a]")], "page_id string, line_no int, line string")
    facts = spark.createDataFrame([("[slide-1#a]", "40"), ("[slide-2#b]", "50")], "citation string, number string")
    assert [r.detail for r in checks.line_grounding(lines, facts).collect()] == ["50"]


def test_table_and_raster_checks(spark):
    cell = "array<struct<row:int,column:int,row_span:int,column_span:int,is_merge_origin:boolean>>"
    t = spark.createDataFrame([("t", 2, 2, [(0, 0, 1, 3, True), (5, 0, 1, 1, None), (1, 1, 1, 1, False)])], f"table_id string, rows int, columns int, cells {cell}")
    assert sorted((r.check_code, r.key) for r in checks.table_checks(t).collect()) == [("invalid-table-cell", "t/1"), ("invalid-table-span", "t/0")]
    e = spark.createDataFrame([(1, "p", "image", "native", None), (1, "t", "table", "ocr", "p")], "slide_number int, element_id string, kind string, source string, parent_id string")
    assert [r.key for r in checks.raster_tables(e).collect()] == ["1/t"]


def test_tree_violations(spark):
    pages = spark.createDataFrame([("a.md", "# Top\n[[b#Sec]] [[b#nope]] [[lost]]"), ("b.md", "<a id='Sec'></a>")], "path string, body string")
    assert sorted((r.check_code, r.target, r.fragment) for r in links.tree_violations(pages).collect()) == [("dangling-fragment", "b", "nope"), ("dangling-link", "lost", None)]


def test_every_kind_of_link(spark):
    """Standard, reference, HTML and wiki links; files, fragments, absolute paths, schemes, pictures and raw citations."""
    bodies = {
        "a/one.md": "# Top\n[x](two.md) [y](../b/three.md#Sec) [z](three.md) [[b/Three#sec]] [[/b/three.md]] [w](#top) [v](#none) [web](https://x) [m](mailto:y)",
        "a/two.md": "[r]: ../assets/p%20q.png\n[q]: ../../out.md\n<a href='one.md#top'>t</a> <a href=\"one.md#gone\">u</a> [s](<one.md>) [k](javascript:x) [n](/root.md) [e](one.md?x&amp;y)",
        "b/three.md": "<a id='Sec'></a>\n![p](../assets/p.png) [[gone]] [[#Sec]] [[#lost]]",
        "b/four.md": "says [slide-1#a] and <img src='x'>",
        "evidence/s-0001.md": "says [slide-1#a]",
    }
    pages = spark.createDataFrame(list(bodies.items()), "path string, body string")
    got = sorted((r.check_code, r.path, r.target, r.fragment) for r in links.tree_violations(pages, spark.createDataFrame([("assets/p q.png",)], "path string")).fillna("").collect())
    assert got == [
        ("dangling-fragment", "a/one.md", "", "none"), ("dangling-fragment", "a/one.md", "b/Three", "sec"), ("dangling-fragment", "a/two.md", "one.md", "gone"), ("dangling-fragment", "b/three.md", "", "lost"),
        ("dangling-link", "a/one.md", "three.md", ""), ("dangling-link", "b/three.md", "gone", ""),
        ("image-markup", "b/four.md", "", ""), ("image-markup", "b/three.md", "", ""), ("raw-citation", "b/four.md", "", ""),
        ("unsafe-link", "a/two.md", "../../out.md", ""), ("unsafe-link", "a/two.md", "/root.md", ""), ("unsafe-link", "a/two.md", "javascript:x", ""),
    ]


def test_lines_of_relationships(spark):
    """A relationship's texts as lines on its citations: numbers, request numbers and changed ones; citations in the text narrow."""
    q = lambda n: f"[@s/slide-{n}#e]"
    said = [(1, "It holds 40", "d"), (2, "It holds 41", "d"), (3, "d", "Of PR-7"), (4, "d", "Of PR-8"), (5, "PX-7 broke", "d"), (6, f"It holds 41 {q(2)}", "d"), (7, f"It holds 40 {q(2)}", "d"), (8, f"It {q(9)}", "d"), (9, "PX-9 broke", "d")]
    own = {6: [1, 2], 7: [1, 2], 9: [3]}
    facts = {1: (["40", "7"], [("7", "PR-7")], []), 2: (["41", "8"], [("8", "PR-8")], []), 3: (["9"], [("9", "PR-9")], ["PX-9"])}
    cited = [(o, q(n), *facts[n]) for o, *_ in said for n in own.get(o, [1])]
    got = graph.ungrounded_lines(spark.createDataFrame(said, "ord int, assertion string, description string"), spark.createDataFrame(cited, "ord int, citation string, numbers array<string>, requests array<struct<key:string,value:string>>, identifiers array<string>"), lambda c: call("claim_numbers", c), lambda *c: call("unapproved_requests", *c))
    assert sorted(r.ord for r in got.collect()) == [2, 4, 5, 7, 8]


def test_index_in_shards(spark):
    """100,000 titles: pages of pages, no page of more lines than the limit, every title once."""
    titles = spark.range(100_000).select(F.col("id").cast("string"), F.concat(F.lit("Title "), (F.col("id") * 7919 % 100_003).cast("string")).alias("title"))
    few = spark.createDataFrame([("x", "Only")], "id string, title string")
    pages = publish.index_pages("Site", {"Topics": titles, "Sources": few}, 200).collect()
    lines = {p.path: [x for x in p.body.split("\n") if x.startswith("- ")] for p in pages}
    assert max(map(len, lines.values())) <= 201 and sum(x.startswith("- [[topics/") for own in lines.values() for x in own) == 100_000
    assert {re.match(r"- \[\[(index/[^|]+)", x)[1] + ".md" for own in lines.values() for x in own if x.startswith("- [[index/")} == set(lines) - {"index.md"}
    assert "- [[sources/x|Only]]" in lines["index.md"] and all(p.body.startswith("---\ntitle:") for p in pages)
    keys = [[text.stable_key(re.search(r"\|(.*)\]\]", x)[1]) for x in lines[p]] for p in sorted(lines) if p.startswith("index/topics-0")]
    assert [k for own in keys for k in own] == sorted(k for own in keys for k in own)


def test_model_loop_with_repairs(spark):
    prompts = spark.createDataFrame([(1, "good"), (2, "bad"), (3, "hopeless")], "id int, prompt string")
    make = lambda: readers.ScriptedBackend([("hopeless", "no"), ("Correct these", "fixed"), ("good", "fixed")], "wrong")
    wrong = lambda a: a.where("answer <> 'fixed'").select("id", F.lit("not fixed").alias("error"))
    good, left = readers.repaired(prompts, make, wrong, 1)
    assert sorted(r.id for r in good.collect()) == [1, 2] and [r.id for r in left.collect()] == [3]


def test_discovery_to_entities(spark):
    chunks = spark.createDataFrame([("k1", "Alpha test of lot. PR-5", ["[slide-1#a]"])], "chunk_id string, text string, citations array<string>")
    answer = '{"entities":[{"name":"alpha  TEST","type":"test","citations":["[slide-1#a]","[slide-9#z]"]},{"name":"Beta","citations":["[slide-1#a]"]},{"name":"PR-5","citations":["[slide-1#a]"]}]}'
    found = stages.discover(chunks, lambda: readers.ScriptedBackend([("Alpha", answer)]), stages.Options())
    got = stages.integrate(stages.grounded_candidates(found, chunks), stages.Options())[0].collect()
    assert [(r.key, r.type, r.citations) for r in got] == [("alpha test", "test", ["[slide-1#a]"])]
    with pytest.raises(ValueError):
        stages.Options(prompt_chars=10)


def test_publish(spark, tmp_path):
    entities = spark.createDataFrame([("e1", "Alpha", "test", "d", ["A"], ["c"]), ("e2", "Beta", "lot", "d", [], ["c"])], "id string, name string, type string, description string, aliases array<string>, citations array<string>")
    edges = spark.createDataFrame([("e1", "uses", "e2")], "subject string, predicate string, object string")
    pages = publish.entity_pages(entities, edges)
    one = pages.where("path = 'entities/e1.md'").first().body
    assert "→ uses [[entities/e2|Beta]]" in one and one.startswith("---\ntitle: \"Alpha\"")
    target = str(tmp_path / "site")
    publish.publish(pages, target)
    assert sorted(p.relative_to(target).as_posix() for p in (tmp_path / "site").rglob("*.md")) == ["entities/e1.md", "entities/e2.md"]
    assert (tmp_path / "site/entities/e1.md").read_text() == one and [p.name for p in tmp_path.iterdir()] == ["site"]
    with pytest.raises(FileExistsError):
        publish.publish(pages, target)
    assert publish.index_page("Site", {"Entities": entities.select("id", F.col("name").alias("title"))}).first().body.count("[[entities/") == 2


def test_scalar_columns(spark):
    one = spark.range(1).select(
        C.emu_to_pixels(F.lit(-10), F.lit(50), F.lit(1020), F.lit(760), F.lit(1000), F.lit(800), F.lit(4000), F.lit(3200)).alias("px"),
        C.clean_box(F.array(F.lit(1.0), F.lit(2.0), F.lit(0.0), F.lit(5.0))).alias("bad"),
        C.grid_to_pixels(F.array(F.lit(-5), F.lit(0), F.lit(500), F.lit(1200)), F.lit(200), F.lit(100)).alias("grid"),
        C.media_type(F.unhex(F.lit("89504E470D0A1A0A")), F.lit("x")).alias("kind"),
        C.pipe_table(F.array(F.array(F.lit("a|b")), F.array(F.lit("c\nd")))).alias("table"),
        C.safe_stem(F.lit("con.x")).alias("stem"),
        C.citation_parts(F.lit("[@s/slide-007#e]")).alias("c"),
        call("request_key", F.lit("pr 12")).alias("key"),
    ).first()
    assert tuple(one.px) == (0, 200, 4000, 3200) and one.bad is None and one.grid == [0.0, 0.0, 100.0, 100.0]
    assert one.kind == "image/png" and one.table == "| a\\|b |\n| --- |\n| c<br>d |" and one.stem == "_con.x"
    assert tuple(one.c) == ("s", 7, "e") and one.key == "12"


def test_coverage_fills_uncovered_topics(spark):
    b = spark.createDataFrame([("s", i, f"c{i}", i, "") for i in range(4)], "source_id string, slide_number int, citation string, rank int, slide_title string")
    merged = spark.createDataFrame([("s", "t", "T", ["c0"], 0)], "source_id string, key string, title string, citations array<string>, first long")
    got = stages.covered_topics(b, merged, 2)
    assert sorted(c for r in got.collect() for c in r.citations) == ["c0", "c1", "c2", "c3"] and got.count() == 2
    assert topics.reconcile(b, b, ["citation"]).count() == 0
    assert graph.predicate_kinds(spark).where("array_contains(kinds, 'lot')").first().predicate == "has_lot"


PNG = b"\x89PNG\r\n\x1a\n\x00\x00\x00\rIHDR" + (200).to_bytes(4, "big") + (100).to_bytes(4, "big") + b"\x08\x06\x00\x00\x00rest"


def deck_bytes(external=False, title="Title", picture=None, more=""):
    ns = 'xmlns:a="http://schemas.openxmlformats.org/drawingml/2006/main" xmlns:p="http://schemas.openxmlformats.org/presentationml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    box = lambda x, y, w, h, extra="": f'<a:xfrm{extra}><a:off x="{x}" y="{y}"/><a:ext cx="{w}" cy="{h}"/></a:xfrm>'
    text = lambda i, t, x: f'<p:sp><p:nvSpPr><p:cNvPr id="{i}" name="n{i}"/></p:nvSpPr><p:spPr>{box(x, 10, 100, 50)}</p:spPr><p:txBody><a:p><a:r><a:t>{t}</a:t></a:r></a:p></p:txBody></p:sp>'
    group = f'<p:grpSp><p:nvGrpSpPr><p:cNvPr id="9" name="g"/></p:nvGrpSpPr><p:grpSpPr><a:xfrm><a:off x="1000" y="1000"/><a:ext cx="200" cy="200"/><a:chOff x="0" y="0"/><a:chExt cx="100" cy="100"/></a:xfrm></p:grpSpPr>{text(3, "in group", 10)}</p:grpSp>'
    table = '<p:graphicFrame><p:nvGraphicFramePr><p:cNvPr id="5" name="t"/></p:nvGraphicFramePr><p:xfrm><a:off x="0" y="0"/><a:ext cx="10" cy="10"/></p:xfrm><a:graphic><a:graphicData uri="http://schemas.openxmlformats.org/drawingml/2006/table"><a:tbl><a:tblGrid><a:gridCol w="5"/><a:gridCol w="5"/></a:tblGrid><a:tr><a:tc gridSpan="2"><a:txBody><a:p><a:r><a:t>head</a:t></a:r></a:p></a:txBody></a:tc><a:tc hMerge="1"/></a:tr></a:tbl></a:graphicData></a:graphic></p:graphicFrame>'
    fill = '<p:blipFill><a:blip r:embed="r7"/><a:srcRect l="50000"/></p:blipFill>' if picture else ""
    pic = f'<p:pic><p:nvPicPr><p:cNvPr id="7" name="pic"/><p:nvPr/></p:nvPicPr>{fill}<p:spPr>{box(1000, 2000, 5000, 4000) if picture else box(1, 1, 2, 2)}</p:spPr></p:pic>'
    rel = '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="r1" Type="http://x/slide" Target="slides/slide1.xml"/></Relationships>'
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("[Content_Types].xml", "<Types/>")
        z.writestr("ppt/presentation.xml", f'<p:presentation {ns}><p:sldIdLst><p:sldId id="256" r:id="r1"/></p:sldIdLst><p:sldSz cx="12192000" cy="6858000"/></p:presentation>')
        z.writestr("ppt/_rels/presentation.xml.rels", rel)
        z.writestr("ppt/slides/slide1.xml", f"<p:sld {ns}><p:cSld><p:spTree>{text(2, title, 5)}{group}{table}{pic}{more}</p:spTree></p:cSld></p:sld>")
        if picture:
            z.writestr("ppt/media/image1.PNG", picture)
            z.writestr("ppt/slides/_rels/slide1.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="r7" Type="http://x/image" Target="../media/image1.PNG"/><Relationship Id="r8" Type="http://x/hyperlink" Target="http://there" TargetMode="External"/></Relationships>')
        if external:
            z.writestr("ppt/slides/_rels/slide1.xml.rels", rel.replace("r1", "r2").replace('/slide"', '/image"').replace('Target="slides/slide1.xml"', 'Target="http://far" TargetMode="External"'))
    return out.getvalue()


def test_deck_source(spark, tmp_path):
    (tmp_path / "a.pptx").write_bytes(deck_bytes())
    (tmp_path / "~$a.pptx").write_bytes(b"lock")
    spark.dataSource.register(ooxml.DeckSource)
    rows = spark.read.format("deck").option("path", str(tmp_path)).load().orderBy("z_index").collect()
    assert [(r.kind, r.text) for r in rows] == [("text", "Title"), ("group", ""), ("text", "in group"), ("table", "")]
    assert (rows[2].x, rows[2].y, rows[2].width, rows[2].height) == (1020, 1020, 200, 100) and rows[2].parent_id == rows[1].element_id
    assert '"column_span": 2' in rows[3].table_json and rows[0].slide_width == 12192000
    found = files.discover(spark, str(tmp_path))
    assert found.count() == 1 and files.limits(found).count() == 0
    assert ooxml.deck_elements(found, images=True).where("kind = 'image'").count() == 1


def test_deck_parts_that_break(spark, tmp_path):
    """A broken shape, slide or deck is a row; the others are read. Strict reading stops."""
    far = '<p:graphicFrame><p:nvGraphicFramePr><p:cNvPr id="8" name="bad"/></p:nvGraphicFramePr><a:graphic><a:graphicData uri="x/table"><a:tbl><a:tblGrid/><a:tr><a:tc/><a:tc/></a:tr></a:tbl></a:graphicData></a:graphic></p:graphicFrame>'
    rows = list(ooxml.deck(deck_bytes(more=far)))
    assert [r["kind"] for r in rows] == ["text", "group", "text", "table", "error"] and rows[-1]["element_id"] == "s0001-p5-id8" and "IndexError" in rows[-1]["error"]
    with pytest.raises(ooxml.DeckError):
        list(ooxml.deck(deck_bytes(more=far), strict=True))
    assert [r["element_id"] for r in ooxml.deck(b"none")] == ["deck"] and list(ooxml.media(b"none")) == []
    (tmp_path / "a.pptx").write_bytes(deck_bytes(more=far))
    (tmp_path / "b.pptx").write_bytes(b"PK none")
    (tmp_path / "~$a.pptx").write_bytes(b"lock")
    got = ooxml.decks(spark, str(tmp_path))
    assert sorted(r.element_id for r in got.where("kind = 'error'").collect()) == ["deck", "s0001-p5-id8"] and got.count() == 6


def test_deck_runs_cells_and_media():
    words = '<p:sp><p:nvSpPr><p:cNvPr id="9" name="w"/></p:nvSpPr><p:txBody><a:p><a:pPr lvl="1" algn="ctr"><a:buChar char="*"/></a:pPr><a:r><a:rPr sz="1800" b="1" i="0" u="none"><a:latin typeface="Serif"/><a:hlinkClick r:id="r8"/></a:rPr><a:t>one</a:t></a:r><a:br/><a:r><a:t>two</a:t></a:r></a:p><a:p/></p:txBody></p:sp>'
    grid = '<p:graphicFrame><p:nvGraphicFramePr><p:cNvPr id="10" name="g"/></p:nvGraphicFramePr><p:xfrm><a:off x="100" y="200"/><a:ext cx="600" cy="80"/></p:xfrm><a:graphic><a:graphicData uri="x/table"><a:tbl><a:tblGrid><a:gridCol w="10"/><a:gridCol w="20"/></a:tblGrid><a:tr h="30"><a:tc/><a:tc rowSpan="2"/></a:tr><a:tr h="10"><a:tc/><a:tc vMerge="1"/></a:tr></a:tbl></a:graphicData></a:graphic></p:graphicFrame>'
    by = {r["name"]: r for r in ooxml.deck(deck_bytes(picture=PNG, more=words + grid), images=True)}
    first, second = json.loads(by["w"]["paragraphs_json"])
    assert first == {"text": "one\ntwo", "level": 1, "alignment": "ctr", "bullet": {"kind": "character", "value": "*"}, "runs": [{"text": "one", "font_name": "Serif", "font_size_pt": 18.0, "bold": True, "italic": False, "underline": False, "hyperlink": "http://there"}, {"text": "two"}]}
    assert second == {"text": "", "level": 0, "runs": []}
    assert [c["bbox"] for c in json.loads(by["g"]["table_json"])["cells"]] == [[100, 200, 200, 60], [300, 200, 400, 80], [100, 260, 200, 20]]
    assert by["pic"]["media_part"] == "ppt/media/image1.PNG" and by["pic"]["media_sha256"] == hashlib.sha256(PNG).hexdigest() and by["pic"]["crop"] == [0.5, 0, 0, 0]
    assert list(ooxml.media(deck_bytes(picture=PNG))) == [("ppt/media/image1.PNG", hashlib.sha256(PNG).hexdigest(), PNG)]


def test_archive_checks(spark, tmp_path):
    (tmp_path / "ok.pptx").write_bytes(deck_bytes())
    (tmp_path / "far.pptx").write_bytes(deck_bytes(external=True))
    (tmp_path / "bad.pptx").write_bytes(b"nothing")
    with zipfile.ZipFile(tmp_path / "evil.pptx", "w") as z:
        z.writestr("../up", "x")
    got = {(r.check_code, r.key.rsplit("/", 1)[-1]) for r in files.archive_violations(files.discover(spark, str(tmp_path))).collect()}
    assert got == {("not-an-archive", "bad.pptx"), ("external-resource", "far.pptx"), ("unsafe-member", "evil.pptx"), ("missing-part", "evil.pptx")}


def test_json_lines(spark, tmp_path):
    (tmp_path / "p.jsonl").write_text('{"citation":"c","slide_number":1}\nbroken\n{"slide_number":2}\n')
    good, bad = files.json_lines(spark, str(tmp_path / "p.jsonl"), "citation string, slide_number int", ("citation",))
    assert good.count() == 2 and sorted(r.check_code for r in bad.collect()) == ["corrupt-line", "missing-citation"]
