"""Model stages over evidence: topic discovery, grounded pages by map and reduce, fallback chains of readers."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evispark.functions.text import lenient_json, without_fence
from evispark.functions.udfs import call
from evispark.operators import readers
from evispark.operators.checks import rows
from evispark.operators.readers import ReaderError
from evispark.session import cut

# Own wording of the instructions; a page's evidence follows them.
TOPIC_TASK = "Name the topics of this evidence as JSON: {\"topics\": [{\"title\": ..., \"description\": ..., \"citations\": [...]}]}."
PAGE_TASK = "Write Markdown about the topic. Every line that states something ends with the citations it rests on; use no other numbers than the evidence."
MERGE_TASK = "Join these parts to one page. Keep every citation; add nothing."
READ_TASKS = {"table": "Read the table as HTML.", "chart": "Read axes, series and values.", "formula": "Read the formula as LaTeX.", "text": "Read the text.", "document": "Read all text in reading order."}


def read_prompt(task: str, language: str | None = None, context: str | None = None, most: int = 2000) -> str:
    """Instruction for a reader of images, with language and a bounded context."""
    parts = [READ_TASKS.get(task, READ_TASKS["document"])]
    if language:
        parts.append(f"Language: {language}.")
    if context:
        parts.append(f"Context: {context[:most]}")
    return "\n".join(parts)


def topics(chunks: DataFrame, backend: Callable, fallback: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(topics, warnings): topics (source_id, ord, title, description, citation) that a model names in chunks (chunk_id,
    source_id, text, citations); unknown citations are warnings; sources without any topic take those of `fallback`."""
    prompts = chunks.select("chunk_id", F.concat(F.lit(TOPIC_TASK + "\n\n"), "text").alias("prompt"))
    answers = cut(readers.complete(prompts, backend, "chunk_id"))  # read twice, asked once
    schema = "struct<topics:array<struct<title:string,description:string,citations:array<string>>>>"
    found = answers.select("chunk_id", F.posexplode(F.from_json(call("lenient_json", "answer"), schema)["topics"]).alias("place", "t"))
    joined = found.join(chunks.select("chunk_id", "source_id", F.col("citations").alias("allowed")), "chunk_id")
    cited = joined.select("source_id", F.struct("chunk_id", "place").alias("o"), F.col("t.title").alias("title"), F.col("t.description").alias("description"), F.explode("t.citations").alias("citation"), "allowed")
    known = F.array_contains("allowed", F.col("citation"))
    warnings = rows(cited.where(~known), "unknown-citation", F.col("title"), F.col("citation"), "warning").unionByName(rows(answers.where("error is not null"), "model-error", F.col("chunk_id"), F.col("error"), "warning"))
    good = cited.where(known).select("source_id", F.to_json("o").alias("ord"), "title", "description", "citation")
    return good.unionByName(fallback.join(good.select("source_id").distinct(), "source_id", "left_anti").select(*good.columns)), warnings


def local_check() -> Column:
    """Errors of an answer with local citations."""
    return call("grounding_errors", "answer", "citations", "evidence")


def integrated_check() -> Column:
    """Errors of an answer with qualified citations: each line's numbers and requests belong to its citations."""
    return call("integrated_check", "answer", F.to_json("facts"), F.array_distinct(F.flatten("facts.requests")))


def pages(parts: DataFrame, backend: Callable, limit: int, repairs: int = 2, check: Callable[[], Column] = local_check) -> DataFrame:
    """(topic_id, body, generation) from parts (topic_id, part, title, evidence, citations, verbatim, facts if checked).

    Every part is written and checked, and asked for again with its errors; what never passes is its evidence word for word.
    Then parts are reduced level by level: a topic whose parts fit the limit together is joined by the model in one piece; of
    others, neighbours that fit are joined two by two, which halves their number, until the topic fits or nothing more can be
    joined. Every joined text is checked like a part; one that fails stays as its parts, one after another.
    """
    keyed = cut(parts.withColumn("id", F.concat_ws("#", "topic_id", F.col("part").cast("string"))))  # every round reads it
    prompts = keyed.select("id", F.concat(F.lit(PAGE_TASK + "\nTopic: "), "title", F.lit("\n\n"), "evidence").alias("prompt"))
    carried = ["citations", "evidence", *["facts"] * ("facts" in parts.columns)]
    good, _ = readers.repaired(prompts, backend, _errors(keyed, "id", carried, check), repairs, "id")
    none = F.col("answer").isNull()
    rows = cut(keyed.join(good, "id", "left").select("topic_id", F.col("part").cast("long").alias("part"), F.when(none, F.col("verbatim")).otherwise(call("without_top_heading", "answer")).alias("body"), none.alias("fell_back"), *carried))
    out = None
    while True:
        whole = cut(_put_together(rows, ["topic_id"], carried))
        fits = (F.col("n") > 1) & ~F.col("fell_back") & (F.length("body") <= limit)
        ready = _merged(whole.where((F.col("n") == 1) | F.col("fell_back") | fits), fits, ["topic_id"], backend, carried, check)
        out = ready if out is None else out.union(ready)
        large = whole.where((F.col("n") > 1) & ~F.col("fell_back") & (F.length("body") > limit)).select("topic_id")
        if large.isEmpty():
            break
        paired = rows.join(large, "topic_id", "left_semi").withColumn("at", F.col("part")).withColumn("part", F.expr("(part + 1) div 2"))
        pairs = _put_together(paired, ["topic_id", "part"], carried)
        joined = cut(_merged(cut(pairs), (F.col("n") > 1) & (F.length("body") <= limit), ["topic_id", "part"], backend, carried, check))
        moving = joined.where("changed").select("topic_id").distinct()
        stuck = _put_together(joined.join(moving, "topic_id", "left_anti"), ["topic_id"], carried).withColumn("changed", F.lit(False))
        out = out.union(stuck.select(out.columns))
        rows = joined.join(moving, "topic_id", "left_semi").select(rows.columns)
    return out.select("topic_id", "body", F.when(F.col("fell_back"), "verbatim_fallback").otherwise("model").alias("generation"))


def _errors(known: DataFrame, key: str, carried: list[str], check: Callable[[], Column]) -> Callable[[DataFrame], DataFrame]:
    facts = known.select(key, *carried)
    return lambda answers: answers.join(facts, key).select(key, F.explode(check()).alias("error"))


def _put_together(rows: DataFrame, key: list[str], carried: list[str]) -> DataFrame:
    """Parts of a key one after another, with all that they rest on: as many rows as a topic's evidence has chunks at most."""
    in_order = lambda c: F.transform(F.sort_array(F.collect_list(F.struct("at", c))), lambda x: x[c])
    lists = {"citations": F.array_distinct(F.flatten(F.collect_list("citations"))), "evidence": F.array_join(in_order("evidence"), "\n"), "facts": F.array_distinct(F.flatten(F.collect_list("facts"))) if "facts" in carried else None}
    return rows.withColumn("at", F.col("at") if "at" in rows.columns else F.col("part")).groupBy(*key).agg(F.array_join(in_order("body"), "\n\n").alias("body"), F.max("fell_back").alias("fell_back"), *(lists[c].alias(c) for c in carried), F.count("*").alias("n"))


def _merged(whole: DataFrame, fits: Column, key: list[str], backend: Callable, carried: list[str], check: Callable[[], Column]) -> DataFrame:
    """Rows with the model's joined text where they fit and it passes, and whether that is so (changed)."""
    keyed = whole.withColumn("id", F.concat_ws("#", *(F.col(c).cast("string") for c in key)))
    asked = cut(keyed.where(fits))
    merged, _ = readers.repaired(asked.select("id", F.concat(F.lit(MERGE_TASK + "\n\n"), "body").alias("prompt")), backend, _errors(asked, "id", carried, check), 0, "id")
    return keyed.join(merged, "id", "left").select(*key, F.coalesce("answer", "body").alias("body"), "fell_back", *carried, F.col("answer").isNotNull().alias("changed"))


def request_json(backend: readers.ChatBackend, prompt: str, repairs: int = 2) -> str | None:
    """JSON from a model, asked again where the answer is none; null after the last try."""
    messages = [{"role": "user", "content": prompt}]
    for _ in range(repairs + 1):
        answer = backend.complete(messages, max_tokens=4096, temperature=0.0)
        if (found := lenient_json(answer)) is not None:
            return found
        messages += [{"role": "assistant", "content": answer}, {"role": "user", "content": "That is no JSON object. Answer with one."}]
    return None


class FallbackReader:
    """Readers in turn: an error or an empty result goes to the next; the last error stands."""

    def __init__(self, *readers_: readers.ReaderBackend):
        self.readers = readers_

    def read(self, image: bytes, task: str, context: str) -> dict:
        last: Exception = ReaderError("configuration", "no reader")
        for r in self.readers:
            try:
                out = r.read(image, task, context)
                if out.get("blocks") or out.get("markdown") or out.get("text"):
                    return out
                last = ReaderError("execution", "empty result")
            except Exception as e:  # noqa: BLE001
                last = e
        raise last


class CommandReader:
    """A program that reads an image file and prints JSON or text; {image}, {task} and {context} in its arguments."""

    def __init__(self, argv: tuple[str, ...], timeout: float = 300.0, env: tuple[str, ...] = ("PATH", "HOME", "LANG")):
        self.argv, self.timeout, self.env = argv, timeout, env

    def read(self, image: bytes, task: str, context: str) -> dict:
        import json
        import os
        import subprocess
        import tempfile

        with tempfile.NamedTemporaryFile(suffix=".png") as f:  # the program is on this machine, and so is its input
            f.write(image)
            f.flush()
            argv = [a.format(image=f.name, task=task, context=context) for a in self.argv]
            done = subprocess.run(argv, capture_output=True, text=True, timeout=self.timeout, env={k: os.environ[k] for k in self.env if k in os.environ})
        if done.returncode:
            raise ReaderError("execution", done.stderr[-500:])
        try:
            found = json.loads(done.stdout)
            return found if isinstance(found, dict) else {"text": done.stdout}
        except ValueError:
            return {"text": without_fence(done.stdout)}


def read_elements(targets: DataFrame, reader: Callable[[], readers.ReaderBackend], key: str = "element_id", carry: dict[str, str] | None = None) -> DataFrame:
    """(key, payload, error_kind, error, *carry): one reader for each partition; targets: (key, image, task, context, *carry),
    where carry names further columns and their types."""
    carry = carry or {}

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import json

        own = reader()
        for pdf in frames:
            out = []
            for image, task, context in zip(pdf["image"], pdf["task"], pdf["context"], strict=True):
                try:
                    out.append((json.dumps(own.read(image, task, context)), None, None))
                except Exception as e:  # noqa: BLE001
                    out.append((None, getattr(e, "kind", "execution"), str(e)[:500]))
            yield pd.DataFrame({key: pdf[key], **{c: [x[i] for x in out] for i, c in enumerate(("payload", "error_kind", "error"))}, **{c: pdf[c] for c in carry}})

    kind = dict(targets.dtypes)[key]
    return targets.select(key, "image", "task", "context", *carry).mapInPandas(run, f"{key} {kind}, payload string, error_kind string, error string" + "".join(f", {c} {t}" for c, t in carry.items()))


def read_children(targets: DataFrame, results: DataFrame, key: str = "element_id") -> DataFrame:
    """Blocks of readers as child elements: (parent_id, element_id, kind, text, html, z_index, source, confidence)."""
    found = readers.read_payloads(results.where("payload is not null").select(key, "payload")).join(targets.select(key, "z_index"), key)
    return found.select(F.col(key).alias("parent_id"), F.concat(key, F.lit("-r"), F.col("ord").cast("string")).alias(key), "kind", "text", "html", (F.col("z_index") + F.col("ord") + 1).alias("z_index"), F.lit("ocr").alias("source"), "confidence", "bbox")
