"""Configuration, artifact invariants, model stages and the way from decks to a site."""

from hashlib import sha256

import evispark
import pytest
from pyspark.sql import functions as F

from evispark import cli, config
from evispark.functions import columns as C
from evispark.operators import artifacts, checks, geometry, links, readers
from evispark.plans import collection, integration, models, pictures, publish, runs, semantic, stages
from evispark.sources import files
from test_operators import PNG, deck_bytes


def test_config(tmp_path, monkeypatch):
    f = tmp_path / "c.yml"
    f.write_text("version: 2\noutput:\n  directory: out\nllm_api:\n  base_url: http://localhost:1\n  api_key_env: SOME_KEY\n")
    monkeypatch.setenv("SOME_KEY", "s")
    c = config.loaded(str(f))
    assert c["output"]["directory"] == str(tmp_path / "out") and c["render"]["dpi"] == 300 and config.secret(c["llm_api"]) == "s"
    for bad in ("a: &x 1\nb: *x", "output: {naming: other}", "output: {directory: a, directory: b}", "render: {dpi: 10}", "what: 1", "version: 9", "semantic: {}", "render: {dpi: true}", "llm_api: {base_url: 'http://far.example'}", "llm_api: {base_url: 'https://u:p@localhost'}"):
        f.write_text(bad)
        with pytest.raises(config.ConfigError):
            config.loaded(str(f))
    assert config.local_device(" CUDA:0 ") == "gpu:0"
    with pytest.raises(config.ConfigError):
        config.local_device("tpu")


def test_readers_in_turn():
    class Bad:
        def read(self, image, task, context):
            raise OSError("down")

    class Empty:
        def read(self, image, task, context):
            return {}

    class Good:
        def read(self, image, task, context):
            return {"text": task}

    assert models.FallbackReader(Bad(), Empty(), Good()).read(b"", "table", "") == {"text": "table"}
    with pytest.raises(models.ReaderError):
        models.FallbackReader(Bad(), Empty()).read(b"", "x", "")
    assert models.CommandReader(("cat", "{image}")).read(b'{"text": "a"}', "text", "") == {"text": "a"}
    with pytest.raises(models.ReaderError):
        models.CommandReader(("false",)).read(b"", "text", "")
    assert models.read_prompt("table", "ko", "z" * 9000).count("z") == 2000


def test_read_elements(spark):
    class Reader:
        def read(self, image, task, context):
            if not image:
                raise models.ReaderError("transient", "no image")
            return {"blocks": [{"kind": "text", "text": image.decode()}, {"kind": "text", "text": task}]}

    t = spark.createDataFrame([("e1", bytearray(b"one"), "chart", "", 3), ("e2", bytearray(b""), "text", "", 4)], "element_id string, image binary, task string, context string, z_index int")
    got = models.read_elements(t, Reader)
    assert {(r.element_id, r.error_kind) for r in got.collect()} == {("e1", None), ("e2", "transient")}
    assert [(r.element_id, r.text, r.z_index) for r in models.read_children(t, got).orderBy("element_id").collect()] == [("e1-r0", "one", 4), ("e1-r1", "chart", 5)]


def test_topics_and_pages(spark):
    chunks = spark.createDataFrame([("k", "s", "Sales 40", ["[slide-1#a]"]), ("m", "t", "none", ["[slide-1#b]"])], "chunk_id string, source_id string, text string, citations array<string>")
    backend = lambda: readers.ScriptedBackend([("Sales", '{"topics":[{"title":"Sales","description":"d","citations":["[slide-1#a]","[slide-9#z]"]}]}')])
    fallback = spark.createDataFrame([("t", "o", "Slide 1", "", "[slide-1#b]")], "source_id string, ord string, title string, description string, citation string")
    found, warnings = models.topics(chunks, backend, fallback)
    assert sorted((r.source_id, r.title, r.citation) for r in found.collect()) == [("s", "Sales", "[slide-1#a]"), ("t", "Slide 1", "[slide-1#b]")]
    assert [r.detail for r in warnings.where("check_code = 'unknown-citation'").collect()] == ["[slide-9#z]"]
    parts = spark.createDataFrame([("t1", 1, "Sales", "sold 40", ["[slide-1#a]"], "> sold 40\n\n[slide-1#a]"), ("t2", 1, "Other", "made 7", ["[slide-2#b]"], "> made 7\n\n[slide-2#b]")], "topic_id string, part int, title string, evidence string, citations array<string>, verbatim string")
    writer = lambda: readers.ScriptedBackend([("Sales", "# Sales\nThey sold 40 [slide-1#a]")], "it is 300")
    got = {r.topic_id: (r.body, r.generation) for r in models.pages(parts, writer, 1000, 1).collect()}
    assert got == {"t1": ("They sold 40 [slide-1#a]", "model"), "t2": ("> made 7\n\n[slide-2#b]", "verbatim_fallback")}
    assert models.request_json(readers.ScriptedBackend([("no JSON", '{"a":1}')], "hm"), "x") == '{"a":1}'


def test_pages_are_reduced_by_levels(spark):
    """Twelve parts: pairs are joined on two levels, then the whole; what fails its check stays as its parts; one without any
    pair that fits is put end to end."""
    row = lambda topic, n, size: (topic, n, topic, f"{topic} {n} 40", [f"[slide-{n}#a]"], f"> {size}")
    parts = spark.createDataFrame([*(row("deep", n, 450) for n in range(1, 13)), *(row("flat", n, 900) for n in range(1, 4)), *(row("wrong", n, 450) for n in range(1, 4)), row("one", 1, 450)], "topic_id string, part int, title string, evidence string, citations array<string>, verbatim string")

    def backend():
        import re

        def joined(prompt):
            cited = list(dict.fromkeys(re.findall(r"\[slide-\d+#a\]", prompt)))
            number = "999" if "wrong" in prompt else "40"
            depth = max([0, *map(len, re.findall(r"J(j*)", prompt))])
            return "\n".join([f"J{'j' * (depth + 1)} {'y' * 240} {cited[0]}", *(f"It is {number} {c}" for c in cited[1:])])

        def page(prompt):
            n, topic = re.search(r"(\w+) (\d+) 40", prompt)[2], re.search(r"(\w+) (\d+) 40", prompt)[1]
            return f"{topic} has 40 {'x' * (880 if topic == 'flat' else 420)} [slide-{n}#a]"

        return readers.ScriptedBackend([("Join these parts", joined), ("Write Markdown", page)])

    got = {r.topic_id: (r.body, r.generation) for r in models.pages(parts, backend, 1000, 0).collect()}
    assert {g for _, g in got.values()} == {"model"} and all(got["deep"][0].count(f"[slide-{n}#a]") == 1 for n in range(1, 13))
    assert got["deep"][0].startswith("Jjjj ") and len(got["deep"][0]) < 700  # a level of pairs, one of pairs of these, the whole
    assert got["flat"][0].count("flat has 40") == 3 and got["wrong"][0].count("wrong has 40") == 3 and got["one"][0].count("\n") == 0


def test_events_once_over_batches(spark, tmp_path):
    """Three batches, the later ones with far older events: without a watermark none is lost and each comes once."""
    from evispark.session import scratch
    from evispark.streaming import ingest

    rows = [[(1, "2024-05-01"), (2, "2024-05-02")], [(1, "2024-05-01"), (3, "2020-01-01")], [(3, "2020-01-01"), (4, "2019-01-01"), (2, "2024-05-02")]]
    for n, own in enumerate(rows):
        spark.createDataFrame(own, "event_id long, ts string").withColumn("ts", F.to_timestamp("ts")).coalesce(1).write.parquet(str(tmp_path / "in" / f"events{n}.parquet"))
    stream = spark.readStream.schema("event_id long, ts timestamp").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in" / "*"))
    out = scratch(spark, "events")
    query = ingest.run_once(ingest.once(stream, ["event_id"]), f"{out}/rows", f"{out}/marks")
    assert len(query.recentProgress) >= 3
    assert sorted(r.event_id for r in spark.read.parquet(f"{out}/rows").collect()) == [1, 2, 3, 4]


def test_quality_of_elements(spark):
    """Numbers read from a picture against native ones in its place, a table read from a picture, a box beyond its slide, a cell
    beyond its grid; equal slide numbers of other decks don't meet."""
    grid = '{"rows": 1, "columns": 1, "cells": [{"row": 1, "column": 0, "row_span": 1, "column_span": 1, "is_merge_origin": true}]}'
    rows = [("s", 1, "a", "text", 0, 0, 10, 10, "has 40", None, None, None), ("s", 1, "p", "image", 0, 0, 10, 10, "", None, None, None), ("s", 1, "p-ocr001", "ocr_text", 1, 1, 8, 8, "has 41", "p", "vlm", None), ("s", 1, "p-ocr002", "ocr_table", 50, 50, 1, 1, "", "p", "vlm", None), ("t", 1, "b", "text", 0, 0, 10, 10, "has 7", None, None, None), ("t", 1, "c", "table", 99, 0, 10, 1, "", None, None, grid), ("t", 1, "x", "error", 0, 0, 0, 0, None, None, None, None)]
    e = spark.createDataFrame(rows, "source_id string, slide_number int, element_id string, kind string, x long, y long, width long, height long, text string, parent_id string, source string, table_json string").withColumns({"slide_width": F.lit(100), "slide_height": F.lit(100)})
    got = collection.quality(e)
    assert sorted((r.check_code, r.key) for r in got.collect()) == [("element-outside-slide", "t/1/c"), ("invalid-table-cell", "t/1/c/0"), ("numeric-conflict", "s/1/a/p-ocr001"), ("raster-table-boundary-unverified", "s/1/p-ocr002")]
    assert {(r.severity, r.n) for r in collection.qa_summary(got).collect()} == {("warning", 1), ("error", 1)}


def test_changed_inputs(spark, tmp_path):
    for name in ("a", "b", "c"):
        (tmp_path / f"{name}.pptx").write_bytes(name.encode() * 3)
    found = spark.createDataFrame(files.discover(spark, str(tmp_path)).drop("content").collect())
    assert files.changed(spark, str(tmp_path), found).count() == 0
    (tmp_path / "a.pptx").write_bytes(b"other")
    (tmp_path / "b.pptx").unlink()
    (tmp_path / "d.pptx").write_bytes(b"new")
    assert sorted((r.check_code, r.key[-6:]) for r in files.changed(spark, str(tmp_path), found).collect()) == [("input-changed", "a.pptx"), ("input-gone", "b.pptx"), ("input-new", "d.pptx")]


def test_what_falls_to_limits_is_told(spark):
    c = spark.createDataFrame([(n, f"N{n}", "lot", "d", "c") for n in range(5)], "ord int, name string, type string, description string, citation string")
    kept, told = stages.integrate(c, stages.Options(most_entities=2))
    assert [r.name for r in kept.orderBy("key").collect()] == ["N0", "N1"] and sorted(r.detail for r in told.collect()) == ["N2", "N3", "N4"] and {r.severity for r in told.collect()} == {"warning"}
    found = spark.createDataFrame([("1", "In 40 days", "s", "c1"), ("2", "In 41 days", "s", "c1")], "ord string, title string, source_id string, citation string")
    good, bare = integration.grounded_topics(found, spark.createDataFrame([("s", "c1", ["40"])], "source_id string, qualified_citation string, numbers array<string>"))
    assert [r.ord for r in good.collect()] == ["1"] and [r.detail for r in bare.collect()] == ["In 41 days"]


def test_deck_to_site(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for name in ("a.pptx", "copy.pptx"):
        (folder / name).write_bytes(deck_bytes())
    c = collection.collect(spark, str(folder))
    assert c.violations.count() == 0 and c.sources.count() == 1 and c.sources.first().n == 2
    kept = {r.content for r in c.blocks.collect()}
    assert "Title" in kept and "in group" in kept and any("colspan" in x for x in kept)
    assert c.semantic.decisions.where("disposition = 'keep'").count() == c.blocks.count()
    collection.export(c, str(tmp_path / "out"))
    assert collection.is_complete(spark, str(tmp_path / "out"))
    pages = collection.site(c)
    assert {r.path.split("/")[0] for r in pages.collect()} == {"evidence", "sources", "index.md"}
    assert artifacts.front_matter(pages.where("path like 'sources/%'")).count() == 0
    assert collection.topic_tables(c).count() == 1
    assert publish.manifest(pages).count() == 3
    assert cli.parser().parse_args(["batch", "i", "o"]).command == "batch"


def test_decks_to_integrated_site(spark, tmp_path):
    """The whole way through the command line with a scripted model: pages at their paths, every link resolves."""
    folder = tmp_path / "in"
    folder.mkdir()
    for name, words in (("a", "PR-77 Lot AB-1 uses copper foil 40"), ("b", "Copper foil of PR-78 broke"), ("c", "Nothing to say")):
        (folder / f"{name}.pptx").write_bytes(deck_bytes(title=words))

    def backend():
        import json
        import re

        def cited(prompt, word):
            spans = re.findall(r'<evidence citation="([^"]+)">\n(.*?)\n</evidence>', prompt, re.S)
            return [c for c, text in spans if word in text.lower()]

        def discovered(prompt):
            foil, lot = cited(prompt, "copper foil"), cited(prompt, "lot ab-1")
            entities = [{"name": "Copper  foil", "type": "material", "citations": foil}] * bool(foil) + [{"name": "Lot AB-1", "type": "lot", "citations": lot}] * bool(lot) + [{"name": "Ghost", "citations": foil}]
            edges = [{"predicate": "uses_material", "subject": "Lot AB-1", "object": "copper foil", "assertion": "Lot AB-1 uses copper foil", "citations": lot}, {"predicate": "has_lot", "subject": "PR-77", "object": "Lot AB-1", "assertion": "PR-77 has Lot AB-1", "citations": lot}, {"predicate": "has_lot", "subject": "PR-78", "object": "Lot AB-1", "assertion": "PR-78 has Lot AB-1", "citations": lot}, {"predicate": "likes", "subject": "Lot AB-1", "object": "copper foil", "assertion": "no", "citations": lot}]
            return json.dumps({"entities": entities, "relationships": edges, "topics": [{"title": "Index", "description": "d", "citations": foil + ["[@ghost/slide-1#a]"]}]})

        def page(prompt):
            return "\n".join(f"It stands there. {c}" for c in cited(prompt, "")) if "@" in prompt else "it is 999"

        return readers.ScriptedBackend([("Name the topics", "{}"), ("as JSON", discovered), ("Write Markdown", page)])

    out = tmp_path / "out"
    assert cli.main(["batch", str(folder), str(out)], backend) == 0
    at = lambda name: spark.read.parquet(str(out / "tables/integrated" / f"{name}.parquet"))
    assert [r.status for r in runs.states(spark, str(out / "tables")).orderBy("at").collect()] == ["running", "success"]
    assert sorted((r.name, r.type) for r in at("entities").collect()) == [("Copper foil", "material"), ("Lot AB-1", "lot")]
    edge = at("relationships").orderBy("predicate").collect()
    assert [(r.predicate, r.subject.split(":")[0], r.requests) for r in edge] == [("has_lot", "pr", ["PR-77"]), ("uses_material", "entity", ["PR-77"])]
    pages = {p.relative_to(out / "site").as_posix(): p.read_text() for p in (out / "site").rglob("*.md")}
    assert {p.split("/")[0] for p in pages} == {"evidence", "sources", "entities", "topics", "requests", "index.md"}
    assert set(p for p in pages if p.startswith("topics/")) == {"topics/index-2.md", "topics/c.md"}
    topic = pages["topics/index-2.md"]
    assert "## Related entities" in topic and "[[entities/copper-foil-" in topic and "[[evidence/" in topic and "[@" not in topic
    lot = next(body for p, body in pages.items() if p.startswith("entities/lot-ab-1"))
    assert "→ uses_material [[entities/copper-foil-" in lot
    request = next(body for p, body in pages.items() if p.startswith("requests/") and "PR-77" in body)
    assert all(f"## {part}" in request for part in ("Topics", "Entities", "Sources", "Relationships")) and "→ has_lot [[entities/lot-ab-1" in request
    assert 'pr_numbers: ["PR-77"]' in request and 'pr_numbers: ["PR-77"]' in lot and 'pr_numbers: ["PR-77","PR-78"]' in topic
    assert all(p.split("---\n")[1].count("\n") == 7 and "draft: false\n" in p for path, p in pages.items() if not path.startswith("evidence/"))
    modes = {r.slug: r.generation for r in at("topics").collect()}
    assert modes == {"index-2": "model", "c": "model"}
    assert links.tree_violations(spark.createDataFrame(list(pages.items()), "path string, body string")).count() == 0
    assert cli.main(["republish", str(out), str(tmp_path / "again")]) == 0
    assert {p.relative_to(tmp_path / "again").as_posix(): p.read_text() for p in (tmp_path / "again").rglob("*.md")} == pages
    with pytest.raises(FileExistsError):
        cli.main(["republish", str(out), str(tmp_path / "again")])


def eyes(folder):
    """A reader of pictures that keeps a file for each question, and is down while a file says so."""

    class Reader:
        def read(self, image, task, context):
            import hashlib
            import os
            import uuid

            open(f"{folder}/{hashlib.sha256(image).hexdigest()}-{uuid.uuid4().hex}", "w").close()
            if os.path.exists(f"{folder}/down"):
                raise OSError("down")
            return {"blocks": [{"kind": "Text", "text": "Seen PR-5", "bbox": [100, 0, 150, 50], "confidence": 0.5}, {"kind": "table", "html": "<table><tr><td>7</td></tr></table>"}]}

    return Reader


def test_pictures_to_blocks_of_a_site(spark, tmp_path):
    """Pictures of three decks, two of them equal: each is read once, a failed run asks again for what has no answer alone; what
    is read is in the site with its place, and evidence pages link the pictures' files."""
    (tmp_path / "in").mkdir()
    (tmp_path / "asked").mkdir()
    other = PNG + b"2"
    for name, picture in (("a", PNG), ("b", PNG), ("c", other)):
        (tmp_path / "in" / f"{name}.pptx").write_bytes(deck_bytes(title=f"Deck {name}", picture=picture))
    reader = eyes(str(tmp_path / "asked"))
    (tmp_path / "asked" / "down").touch()
    reading = collection.Reading(True, reader=reader, store=str(tmp_path / "answers"))
    first = collection.collect(spark, str(tmp_path / "in"), reading=reading)
    assert sorted(r.check_code for r in first.warnings.collect()) == ["picture-unread"] * 2 and first.violations.count() == 0
    assert first.blocks.where("kind like 'ocr%'").count() == 0 and len(list((tmp_path / "asked").iterdir())) == 3
    (tmp_path / "asked" / "down").unlink()
    out = tmp_path / "out"
    (out / "tables").mkdir(parents=True)
    (tmp_path / "answers").rename(out / "tables" / "answers")
    assert cli.main(["batch", str(tmp_path / "in"), str(out)], reader=reader) == 0
    asked = [p.name[:64] for p in (tmp_path / "asked").iterdir()]
    assert sorted(asked) == sorted([sha256(PNG).hexdigest(), sha256(other).hexdigest()] * 2)
    blocks = spark.read.parquet(str(out / "tables/parsed/provenance.parquet")).collect()
    seen = [r for r in blocks if r.kind == "ocr_text"]
    assert len(seen) == 3 and {r.content for r in seen} == {"Seen PR-5"} and all(r.element_id.endswith("-ocr001") for r in seen)
    assert {r.content for r in blocks if r.kind == "ocr_table"} == {"<table><tr><td>7</td></tr></table>"}
    pages = {p.relative_to(out / "site").as_posix(): p for p in (out / "site").rglob("*") if p.is_file() and not p.name.endswith(".crc")}
    assets = {p: f.read_bytes() for p, f in pages.items() if p.startswith("assets/")}
    assert sorted(assets.values()) == sorted([PNG, PNG, other]) and all(p.endswith(f"{sha256(b).hexdigest()}.png") for p, b in assets.items())
    evidence = [f.read_text() for p, f in pages.items() if p.startswith("evidence/")]
    assert all("[pic](../assets/" in e and "![" not in e and "Seen PR-5" in e for e in evidence) and len(evidence) == 3
    again = len(list((tmp_path / "asked").iterdir()))
    second = collection.collect(spark, str(tmp_path / "in"), reading=collection.Reading(True, reader=reader, store=str(out / "tables" / "answers")))
    assert second.blocks.where("kind = 'ocr_text'").count() == 3 and len(list((tmp_path / "asked").iterdir())) == again


def test_places_of_what_was_read(spark):
    """Boxes in pixels of the whole picture, of which the crop shows the right half, on the shape's place."""
    elements = spark.createDataFrame([("s", "e", 1, "pic", False, 1000, 2000, 5000, 4000, 3, [0.5, 0.0, 0.0, 0.0], "image", "d")], "source_id string, element_id string, slide_number int, name string, hidden boolean, x long, y long, width long, height long, z_index int, crop array<double>, kind string, media_sha256 string")
    asked = pictures.targets(elements)
    payload = '{"blocks": [{"kind": "text", "text": "a", "bbox": [100, 0, 150, 50]}, {"kind": "A b", "text": "c", "bbox": [0, 0, 10, 10]}, {"kind": "text", "text": "d"}]}'
    answers = spark.createDataFrame([("d", "document", payload, 200, 100, None, None, 1)], pictures.ANSWERS)
    got = {r.element_id: (r.kind, r.x, r.y, r.width, r.height, r.z_index, r.parent_id) for r in pictures.children(elements, asked, answers).collect()}
    assert got == {"e-ocr001": ("ocr_text", 1000, 2000, 2500, 2000, 4, "e"), "e-ocr002": ("ocr_a_b", 1000, 2000, 5000, 4000, 5, "e"), "e-ocr003": ("ocr_text", 1000, 2000, 5000, 4000, 6, "e")}
    assert pictures.targets(elements, "never").count() == 0


def test_image_reader():
    sent, waits = [], []

    def transport(url, body, timeout, key):
        sent.append((url, body))
        if len(sent) == 1:
            raise OSError("down")
        return {"choices": [{"message": {"content": "no JSON" if len(sent) == 2 else 'Here: {"text": "x"}'}}]}

    reader = readers.ImageReader("http://localhost:1", "m", transport=transport, sleep=waits.append)
    assert reader.read(PNG, "table", "ctx") == {"text": "x"} and waits == [0.5, 1.0] and sent[0][0].endswith("/v1/chat/completions")
    parts = sent[0][1]["messages"][0]["content"]
    assert parts[1]["image_url"]["url"].startswith("data:image/png;base64,") and "ctx" in parts[0]["text"] and "HTML" in parts[0]["text"]

    class Refused(OSError):
        code = 401

    def refuse(*_):
        raise Refused

    with pytest.raises(models.ReaderError) as e:
        readers.ImageReader("http://localhost:1", "m", transport=refuse).read(b"", "text", "")
    assert e.value.kind == "execution"
    settings = config.parsed({"version": 2, "ocr": {"backend": "openai-vlm"}, "vlm_api": {"base_url": "http://localhost:1", "model": "m"}})
    assert pictures.reader_of(settings)().model == "m" and pictures.reader_of(config.parsed({"version": 2})) is None
    assert pictures.reader_of(config.parsed({"ocr": {"backend": "command", "argv": ["cat", "{image}"]}}))().argv == ("cat", "{image}")
    for bad in ({"backend": "other"}, {"backend": "command"}, {"backend": "openai_vlm"}):
        with pytest.raises(config.ConfigError):
            pictures.reader_of(config.parsed({"ocr": bad}))


def test_image_sizes():
    from evispark.functions.images import image_size, image_type

    jpeg = b"\xff\xd8\xff\xe0\x00\x04xx\xff\xc0\x00\x0b\x08" + (30).to_bytes(2, "big") + (40).to_bytes(2, "big") + b"\x01"
    assert image_size(PNG) == [200, 100] and image_size(jpeg) == [40, 30] and image_size(b"GIF89a" + b"\x05\x00\x06\x00") == [5, 6]
    assert image_size(b"BM" + bytes(16) + (7).to_bytes(4, "little") + (-8).to_bytes(4, "little", signed=True)) == [7, 8]
    assert [image_size(x) for x in (None, b"", b"\xff\xd8\xff", PNG[:18], b"text")] == [None] * 5
    assert image_type(b"RIFF0000WEBP") == "image/webp" and image_type(b"") == "application/octet-stream"


def test_batch_that_dies_goes_on(spark, tmp_path, monkeypatch):
    """A batch is killed between its stages: the lock goes, the record says where, the next run begins with the first stage that
    isn't complete. Changed bytes stop a republish."""
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.pptx").write_bytes(deck_bytes(title="PR-1 is here"))
    out = tmp_path / "out"
    args = ["batch", str(tmp_path / "in"), str(out)]
    real = integration.integrate

    def die(*_):
        raise KeyboardInterrupt

    monkeypatch.setattr(integration, "integrate", die)
    backend = lambda: readers.ScriptedBackend([])
    with pytest.raises(KeyboardInterrupt):
        cli.main(args, backend)
    last = runs.states(spark, str(out / "tables")).orderBy(F.desc("at")).first()
    assert (last.status, last.stage, last.error) == ("failed", "integrated", "KeyboardInterrupt") and not (out / "tables/run.lock").exists()
    monkeypatch.setattr(integration, "integrate", real)
    monkeypatch.setattr(collection, "collect", die)  # the first stage is complete and isn't run again
    assert cli.main(args, backend) == 0
    assert [r.status for r in runs.states(spark, str(out / "tables")).orderBy("at").collect()] == ["running", "failed", "running", "success"]
    assert cli.main(["republish", str(out), str(tmp_path / "again")]) == 0
    own = lambda d: {p.relative_to(d).as_posix(): p.read_bytes() for p in d.rglob("*.md")}
    assert own(tmp_path / "again") == own(out / "site")
    one = next((out / "tables/integrated/topics.parquet").glob("part-*"))
    data = bytearray(one.read_bytes())
    data[len(data) // 2] ^= 1
    one.write_bytes(data)
    for crc in one.parent.glob(".*.crc"):
        crc.unlink()
    with pytest.raises(checks.CheckError):
        cli.main(["republish", str(out), str(tmp_path / "third")])
    assert not (tmp_path / "third").exists()


def test_documents_against_their_sources(spark, tmp_path):
    """One deck as input, no model: its document holds request numbers and kept blocks; each kind of change is found."""
    (tmp_path / "a.pptx").write_bytes(deck_bytes(title="PR-1 is here"))
    c = collection.collect(spark, str(tmp_path / "a.pptx"), complete=True)
    kept = {name: df.cache() for name, df in semantic.tables(c).items()}
    assert semantic.violations(kept, c).count() == 0
    doc = kept["documents"].first()
    assert doc.body.startswith("## Requests\n\n- PR-1\n\n<table") and "PR-1 is here\nin group" in doc.body and kept["document_citations"].count() == c.blocks.count()
    codes = lambda **other: {r.check_code for r in semantic.violations(kept | other, c).collect()}
    d, cited, numbers = kept["documents"], kept["document_citations"], kept["document_requests"]
    assert codes(documents=d.withColumn("body", F.lit("none"))) == {"document-digest", "request-lost"}
    assert codes(documents=d.union(d)) == {"duplicate-document"} and codes(documents=d.limit(0)) == {"no-document"}
    assert codes(documents=d.withColumn("source_id", F.lit("x"))) >= {"document-identity", "unknown-source", "no-document"}
    assert codes(document_citations=cited.limit(1)) == {"kept-not-cited"} and codes(document_citations=cited.union(cited.limit(1))) == {"cited-twice"}
    assert codes(document_citations=cited.withColumn("place", F.col("place") + 1)) == {"citation-order"}
    assert codes(document_citations=cited.union(cited.limit(1).withColumn("citation", F.lit("[slide-9#q]")))) == {"citation-not-kept", "unknown-citation"}
    assert codes(document_requests=numbers.limit(0)) == {"request-missing"} and codes(document_requests=numbers.withColumn("value", F.lit("PR-9"))) == {"request-lost", "request-unknown", "request-missing"}
    pages = collection.site(c)
    assert semantic.evidence_violations(c, pages).count() == 0
    worse = pages.withColumn("body", F.regexp_replace("body", "PR-1 is here", "PR-2 is here"))
    assert {r.check_code for r in semantic.evidence_violations(c, worse).collect()} == {"evidence-changed"}
    assert {r.check_code for r in semantic.evidence_violations(c, pages.where("path not like 'evidence%'")).collect()} == {"anchor-missing"}


def test_shape_of_front_matter(spark):
    good = ['title: "T"', 'description: ""', "aliases: []", 'tags: ["a"]', "pr_numbers: []", 'source_ids: ["s","t"]', "draft: false"]
    heads = {"good": good, "order": [good[1], good[0], *good[2:]], "lacks": good[:-1], "more": [*good, "x: 1"], "list": [*good[:2], 'aliases: ["a","a"]', *good[3:]], "text": ["title: T", *good[1:]], "empty": ['title: ""', *good[1:]], "long": [good[0], f'description: "{"x" * 501}"', *good[2:]], "draft": [*good[:-1], "draft: true"], "null": [*good[:3], "tags: [null]", *good[4:]], "line": ['title: "a\\nb"', *good[1:]]}
    pages = [(k, "---\n" + "\n".join(v) + "\n---\n\n# T\n") for k, v in heads.items()] + [("none", "# T\n---\n")]
    got = {(r.key, r.check_code) for r in artifacts.front_matter(spark.createDataFrame(pages, "path string, body string")).collect()}
    assert got == {("none", "no-front-matter"), ("order", "front-matter-keys"), ("more", "front-matter-keys"), ("lacks", "front-matter-draft"), ("list", "front-matter-aliases-value"), ("text", "front-matter-title-value"), ("empty", "front-matter-title-value"), ("long", "front-matter-description-value"), ("draft", "front-matter-draft-value"), ("null", "front-matter-tags-value"), ("line", "front-matter-title-value")}


def test_requests_of_edges(spark):
    map_ = spark.createDataFrame([("[@s/slide-1#a]", ["PR-1"]), ("[@s/slide-2#b]", [])], "qualified_citation string, request_values array<string>")
    one, two = "[@s/slide-1#a]", "[@s/slide-2#b]"
    edges = spark.createDataFrame([("good", "pr:PR-1", "entity:e", [one, two], ["PR-1"]), ("borrowed", "entity:e", "entity:f", [two], ["PR-1"]), ("end", "pr:PR-2", "entity:e", [one], ["PR-1"]), ("none", "entity:e", "entity:f", [one], [])], "id string, subject string, object string, citations array<string>, requests array<string>")
    assert {(r.key, r.check_code) for r in artifacts.edge_requests(edges, map_).collect()} == {("borrowed", "request-not-cited"), ("end", "end-not-a-request"), ("none", "no-request")}


def test_commit_and_load(spark, tmp_path):
    rows, none = spark.range(10).repartition(3), spark.range(0)
    for kind in ("parquet", "json"):
        target = str(tmp_path / kind)
        runs.commit({"rows": rows, "none": none}, target, kind)
        assert runs.violations(spark, target, kind).count() == 0 and [p.name for p in tmp_path.iterdir() if "incomplete" in p.name] == []
        with pytest.raises(FileExistsError):
            runs.commit({"rows": rows}, target, kind)
        folder = tmp_path / kind / f"rows.{kind}"
        listed = sorted(folder.glob("part-*"))
        listed[0].rename(folder / "part-new")
        for crc in folder.glob(".*.crc"):
            crc.unlink()
        assert {r.check_code for r in runs.violations(spark, target, kind).collect()} >= {"file-missing", "file-unknown"}
    assert {r.check_code for r in runs.violations(spark, str(tmp_path)).collect()} == {"no-manifest"}


def test_reconciled_manifest(spark):
    told = spark.createDataFrame([(1, "t", f, 1, "x", 5) for f in "abcdd"], runs.MANIFEST)
    found = spark.createDataFrame([("t", "a", 1, "x"), ("t", "b", 1, "y"), ("t", "d", 1, "x"), ("t", "e", 1, "x")], "name string, file string, bytes long, sha256 string")
    rows = spark.createDataFrame([("t", "a", 4), ("t", "b", 5), ("t", "d", 5)], "name string, file string, rows long")
    assert sorted((r.check_code, r.key) for r in runs.reconciled(told, found, rows).collect()) == [("file-changed", "t/b"), ("file-missing", "t/c"), ("file-unknown", "t/e"), ("listed-twice", "t/d"), ("row-count", "t/a")]


def test_reconciled_files_meet_once(spark):
    """A file can be wrong in several ways, a name that is null is no other's, and the files are joined once for all checks."""
    told = spark.createDataFrame([(1, "t", "a", 1, "x", 5), (1, None, "b", 1, "x", 5), (1, "t", "c", 1, None, 0), (1, "u", "d", 2, "x", None)], runs.MANIFEST)
    found = spark.createDataFrame([("t", "a", 2, "x"), (None, "b", 1, "x"), ("t", "c", 1, "y"), ("u", "d", 1, "x")], "name string, file string, bytes long, sha256 string")
    rows = spark.createDataFrame([("t", "a", 4), ("u", "d", 4)], "name string, file string, rows long")
    got = runs.reconciled(told, found, rows)
    assert sorted(map(tuple, got.collect())) == sorted([("file-changed", "error", "t/a", "x"), ("row-count", "error", "t/a", "4"), ("file-missing", "error", "b", None), ("file-unknown", "error", "b", None), ("file-changed", "error", "u/d", "x")])
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Join FullOuter") == 1


def test_run_lock(spark, tmp_path):
    folder = str(tmp_path / "run")
    with runs.Run(spark, folder) as run:
        with pytest.raises(runs.RunLocked):
            runs.Run(spark, folder).__enter__()
        assert run.stage("one", lambda: {"t": spark.range(3)})["t"].count() == 3
        assert run.stage("one", lambda: 1 / 0)["t"].count() == 3
    import json
    import socket
    import subprocess

    gone = subprocess.Popen(["true"])
    gone.wait()
    (tmp_path / "run" / "run.lock").write_text(json.dumps({"host": socket.gethostname(), "pid": gone.pid}))
    with runs.Run(spark, folder):  # whoever held it is gone
        pass
    (tmp_path / "run" / "run.lock").write_text(json.dumps({"host": "elsewhere", "pid": gone.pid}))
    with pytest.raises(runs.RunLocked):
        runs.Run(spark, folder).__enter__()


def test_evidence_is_packed_whole(spark):
    rows = spark.createDataFrame([("s", n, f"[@s/slide-1#e{n}]", "head", "x" * size) for n, size in enumerate((10, 900, 5, 40))] + [("t", 1, "[@t/slide-1#a]", None, None)], "source_id string, place long, citation string, title string, content string")
    got = {(r.source_id, r.part): r for r in integration.evidence_parts(rows, "source_id", 500).collect()}
    assert all(len(r.text) <= 500 and r.text.count("<evidence") == r.text.count("</evidence>") for r in got.values())
    assert sum(r.text.count("x") for r in got.values()) == 955 and got["t", 1].text == '<evidence citation="[@t/slide-1#a]">\n\n</evidence>'
    assert [c for k in sorted(got) if k[0] == "s" for c in got[k].citations if c.endswith(("e0]", "e3]"))] == ["[@s/slide-1#e0]", "[@s/slide-1#e3]"]
    said = spark.createDataFrame([("s", "One.\n[@s/slide-1#e0]\n\nTwo [@s/slide-1#e9]\n\nThree [@s/slide-1#e3]\nrest")], "source_id string, body string")
    parts = integration.evidence_parts(rows, "source_id", 5000)
    front = {r.source_id: r.text.split("## Evidence")[0] for r in integration.with_dossiers(parts, said, 5000).collect()}
    assert front == {"s": "## Dossier\n\nOne.\n[@s/slide-1#e0]\n\nThree [@s/slide-1#e3]\n\n", "t": "## Dossier\n\n(none)\n\n"}
    size = len(parts.where("source_id = 's'").first().text) + len("One.\n[@s/slide-1#e0]") + 90
    for budget, want in ((size, "One.\n[@s/slide-1#e0]"), (size - 1, "(none)")):
        got = integration.with_dossiers(parts.where("source_id = 's'"), said, budget).first().text
        assert got.split("\n\n## Evidence")[0] == f"## Dossier\n\n{want}"
    assert integration.evidence_parts(rows.limit(0), "source_id", 500).count() == 0


def test_topics_over_all_sources(spark):
    found = spark.createDataFrame([("1", "Alpha", "s", "c1"), ("2", "alpha!", "t", "c2"), ("3", "Beta", "s", "c3"), ("4", "Gamma", "s", "c1"), ("5", "--", "s", "c1")], "ord string, title string, source_id string, citation string")
    facts = spark.createDataFrame([("s", "c1", []), ("s", "c3", ["PR-1"]), ("t", "c2", []), ("u", "c4", [])], "source_id string, qualified_citation string, request_values array<string>")
    names = spark.createDataFrame([("s", "S"), ("t", "T"), ("u", "U")], "source_id string, title string")
    named, members = integration.topic_members(found, facts, names, 2)
    assert {r.topic_id: r.slug for r in named.collect()} == {"topic-alpha": "alpha", "overflow": "further-evidence", "source-u": "u"}
    got = {}
    for r in members.collect():
        got.setdefault(r.topic_id, set()).add(r.citation)
    assert got == {"topic-alpha": {"c1", "c2", "c3"}, "overflow": {"c1", "c3"}, "source-u": {"c4"}}
    named, members = integration.topic_members(found, facts, names, 64)
    assert named.count() == 4 and members.where("topic_id = 'overflow'").count() == 0


def test_placed_blocks():
    got = readers.placed_blocks('a <b>b</b>\n<img src="images/bbox_100_0_500_2000.jpg"/> c<table><tr><td>1</td></tr></table><img src=\'images/bbox_0_0_1000_1000.jpg\'>', "chart", 200, 50)
    assert [(b["kind"], b["bbox"], b["ord"]) for b in got] == [("chart", None, 0), ("image", [20.0, 0.0, 100.0, 50.0], 1), ("chart", None, 2), ("table", None, 3), ("image", [0.0, 0.0, 200.0, 50.0], 4)]
    assert got[0]["text"].strip() == "a b" and got[0]["markdown"] == "a <b>b</b>"
    assert readers.placed_blocks(None, "table", 1, 1) == [] and readers.placed_blocks("x", "document", 1, 1)[0]["kind"] == "text"


def test_assets_by_digest(spark, tmp_path):
    one, two = b"\x00one", b"two"
    rows = [("s", "a/X.PNG", one, sha256(one).hexdigest()), ("s", "b/y.png", one, sha256(one).hexdigest()), ("t", "noend", two, sha256(two).hexdigest()), ("t", "bad.gif", two, "0"), ("t", "none.gif", two, None), ("t", "null.gif", None, "0")]
    assets = spark.createDataFrame([(a, b, None if c is None else bytearray(c), d) for a, b, c, d in rows], "source_id string, path string, content binary, sha256 string")
    kept, broken = publish.asset_files(assets)
    assert sorted(r.key for r in broken.collect()) == ["t/bad.gif", "t/none.gif", "t/null.gif"]
    publish.publish(kept.withColumnRenamed("content", "body"), str(tmp_path / "site"))
    assert {p.relative_to(tmp_path / "site").as_posix(): p.read_bytes() for p in (tmp_path / "site").rglob("*") if p.is_file() and not p.name.endswith(".crc")} == {f"assets/s/{sha256(one).hexdigest()}.png": one, f"assets/t/{sha256(two).hexdigest()}.bin": two}


def test_inputs_and_outputs_are_apart(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "link").symlink_to(tmp_path / "in")
    files.separate(spark, str(tmp_path / "in"), str(tmp_path / "input"))
    for source, target in (("in", "in"), ("in", "in/out"), ("in/x/..", "in/out"), ("in/deep", "in"), ("link", "out")):
        with pytest.raises(ValueError):
            files.separate(spark, str(tmp_path / source), str(tmp_path / target))


def test_documents_and_model_images(spark):
    blocks = spark.createDataFrame([("s", "c1", 1), ("s", "c2", 2)], "source_id string, citation string, slide_number int")
    docs = spark.createDataFrame([("d", "s", ["c1", "c2", "c2", "c9"]), ("e", "t", ["c1"]), ("f", "s", [])], "document_id string, source_id string, citations array<string>")
    got = artifacts.documents(docs, blocks, spark.createDataFrame([("s", 1)], "source_id string, slide_number int"))
    assert sorted((r.check_code, r.key, r.detail) for r in got.collect()) == [("slide-page-missing", "d", "c2"), ("unknown-citation", "d", "c9"), ("unknown-citation", "e", "c1")]
    crops = spark.createDataFrame([(10, 20, 40, 30)], "left int, top int, right int, bottom int")
    assert geometry.model_images(crops, 5).select("model_width", "model_height", "model_left", "model_top").first() == (40, 20, 5, 15)
    with pytest.raises(ValueError):
        geometry.model_images(crops, -1)


def test_public_names():
    assert all(getattr(evispark, name) is not None for name in evispark.__all__) and evispark.integrate is integration.integrate
    with pytest.raises(AttributeError):
        evispark.nothing


def test_numbered_slugs(spark):
    values = spark.createDataFrame([("a", "Lot"), ("b", "lot"), ("c", "lot-2"), ("d", "index"), ("e", "con"), ("f", "x-1")], "ord string, base string")
    got = {r.ord: r.slug for r in links.numbered_slugs(values, "base", "ord").collect()}
    assert got == {"a": "lot", "b": "lot-2", "c": "lot-2-2", "d": "index-2", "e": "con-2", "f": "x-1"}
    assert links.numbered_slugs(values.limit(0), "base", "ord").count() == 0


def test_artifact_invariants(spark):
    b = spark.createDataFrame([("s", 1, "", "[slide-1#a]", "a", "Lot AB-1 has 40 PR-7"), ("s", 2, "", "[slide-9#b]", "b", "x")], "source_id string, slide_number int, slide_title string, citation string, element_id string, content string").withColumn("content_sha256", F.when(F.col("element_id") == "a", C.sha256(F.col("content"))).otherwise("0"))
    assert sorted(r.check_code for r in artifacts.provenance(b).collect()) == ["citation-mismatch", "content-digest"]
    ledger = spark.createDataFrame([("s", "[slide-1#a]", 0, "PR-7")], "source_id string, citation string, position int, value string")
    m = artifacts.source_map(b, ledger)
    one = m.where("element_id = 'a'").first()
    assert one.request_values == ["PR-7"] and "40" in one.numbers and one.qualified_citation == "[@s/slide-1#a]"
    assert artifacts.lineage(m, b, ledger).count() == 0
    assert artifacts.lineage(m.limit(1), b, ledger).count() == 1
    e = spark.createDataFrame([("e", ["A", "A"], ["[@s/slide-1#a]", "[@s/slide-5#q]"], ["t"]), ("Bad Id", [], [], ["s"])], "id string, aliases array<string>, citations array<string>, source_ids array<string>")
    got = {r.check_code for r in artifacts.entities(e, spark.createDataFrame([("s",)], "source_id string"), m).collect()}
    assert got == {"repeated-alias", "unknown-citation", "unknown-source", "source-lineage", "unsafe-id", "no-citation"}
    p = spark.createDataFrame([("p", "x [@s/slide-1#a] [[entities/zz|Z]] <script>", ["[@s/slide-1#a]"], ["e"], ["s"])], "id string, body_markdown string, citations array<string>, entity_ids array<string>, source_ids array<string>")
    assert {r.check_code for r in artifacts.pages(p, e, m).collect()} == {"undeclared-entity", "dangerous-html"}
    r = spark.createDataFrame([("r1", "e", "e", ["[@s/slide-1#a]"], ["s"]), ("r2", "e", "ghost", ["z"], ["t"])], "id string, subject string, object string, citations array<string>, source_ids array<string>")
    assert {(x.check_code, x.key) for x in artifacts.relationships(r, e).collect()} == {("self-loop", "r1"), ("source-not-shared", "r1"), ("unknown-endpoint", "r2"), ("no-shared-citation", "r2")}
    cov = spark.createDataFrame([("s", ["p"], ["e"], True)], "source_id string, page_ids array<string>, entity_ids array<string>, covered boolean")
    assert {x.check_code for x in artifacts.coverage(cov, spark.createDataFrame([("s",), ("u",)], "source_id string"), p, e).collect()} >= {"uncovered-source"}
