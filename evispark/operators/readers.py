"""Results of text readers and models: payloads to blocks, answers to rows, backends behind narrow protocols."""

from __future__ import annotations

import ast
import json
import re
import time
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evispark.functions.html import cell_tokens_table, clean_table, html_text, plain_text
from evispark.functions.images import image_type
from evispark.functions.text import lenient_json
from evispark.session import cut, tune

BLOCKS = "array<struct<kind:string,text:string,markdown:string,html:string,bbox:array<double>,confidence:double,ord:int>>"


class ChatBackend(Protocol):
    def complete(self, messages: list[dict[str, str]], *, max_tokens: int, temperature: float) -> str: ...


class ReaderBackend(Protocol):
    def read(self, image: bytes, task: str, context: str) -> dict: ...


class ScriptedBackend:
    """Deterministic answers: the first rule whose marker stands in the prompt, a function of the prompt or a fixed text."""

    def __init__(self, rules: list[tuple[str, str | Callable[[str], str]]], default: str = "{}"):
        self.rules, self.default = rules, default

    def complete(self, messages: list[dict[str, str]], *, max_tokens: int = 4096, temperature: float = 0.0) -> str:
        prompt = "\n".join(m["content"] for m in messages)
        for marker, answer in self.rules:
            if marker in prompt:
                return answer(prompt) if callable(answer) else answer
        return self.default


class HttpBackend:
    """Chat completions over HTTP; transient errors are tried again after 0.5, 1, 2, 4 seconds."""

    def __init__(self, base_url: str, model: str, timeout: float = 180.0, retries: int = 2, key: str | None = None, transport: Callable | None = None):
        self.url, self.model, self.timeout, self.retries, self.key, self.transport = chat_url(base_url), model, timeout, retries, key, transport or _post

    def complete(self, messages: list[dict[str, str]], *, max_tokens: int = 4096, temperature: float = 0.0) -> str:
        body = {"model": self.model, "messages": messages, "max_tokens": max_tokens, "temperature": temperature}
        answer = retried(lambda: self.transport(self.url, body, self.timeout, self.key), self.retries)
        content = answer["choices"][0]["message"]["content"]
        return content if isinstance(content, str) else "".join(p.get("text", "") for p in content if isinstance(p, dict))


class ReaderError(RuntimeError):
    """Kinds of trouble with readers: configuration, execution, transient, parse."""

    def __init__(self, kind: str, message: str):
        super().__init__(message)
        self.kind = kind


# Own wording of what a model that sees a picture is told; {task} is the picture's task.
SEE_TASK = "Read this picture, a {task}, word for word; add, correct and shorten nothing. Answer with one JSON object: text, markdown, html, confidence, blocks. A block has kind, text, markdown, html, bbox ([x1, y1, x2, y2] in pixels or null), confidence (0 to 1 or null) and order."
TASK_WORDS = {
    "table": "It is one table: give it as HTML with empty cells, rowspan and colspan.",
    "chart": "Give labels, axes and values, then a description in Markdown that infers nothing.",
    "formula": "Give the formula as LaTeX, and the words beside it as they are.",
    "text": "Give every character that is visible.",
    "document": "Keep the reading order; what stands apart is a block of its own.",
}
# HTTP states after which a request may be made again, besides those from 500 on.
PASSING = (408, 409, 425, 429)


class ImageReader:
    """A chat model that sees pictures: the bytes go as a data URL, the answer is a JSON object. Answers that are none, and
    passing errors of the server, are asked for again after 0.5, 1, 2, 4 seconds."""

    def __init__(self, base_url: str, model: str, timeout: float = 120.0, max_tokens: int = 8192, retries: int = 2, key: str | None = None, transport: Callable | None = None, sleep: Callable = time.sleep):
        self.url, self.model, self.timeout, self.max_tokens = chat_url(base_url), model, timeout, max_tokens
        self.retries, self.key, self.transport, self.sleep = retries, key, transport or _post, sleep

    def body(self, image: bytes, task: str, context: str) -> dict:
        import base64

        words = " ".join([SEE_TASK.format(task=task), TASK_WORDS.get(task, TASK_WORDS["document"]), f"Context, which is not part of the picture: {context}" if context else ""]).strip()
        url = f"data:{image_type(image)};base64,{base64.b64encode(image).decode()}"
        content = [{"type": "text", "text": words}, {"type": "image_url", "image_url": {"url": url, "detail": "high"}}]
        return {"model": self.model, "messages": [{"role": "user", "content": content}], "max_tokens": self.max_tokens, "temperature": 0.0}

    def read(self, image: bytes, task: str, context: str) -> dict:
        body = self.body(bytes(image), task, context)

        def once() -> dict:
            try:
                answer = self.transport(self.url, body, self.timeout, self.key)
                said = answer["choices"][0]["message"]["content"]
            except OSError as e:  # the server's states are among these
                state = getattr(e, "code", None)
                if state is None or state in PASSING or state >= 500:
                    raise
                raise ReaderError("execution", f"state {state}") from e
            except (KeyError, IndexError, TypeError, ValueError) as e:
                raise TimeoutError("no answer of a model") from e
            found = lenient_json(said if isinstance(said, str) else "\n".join(p.get("text", "") for p in said if isinstance(p, dict)))
            if found is None:
                raise TimeoutError("no JSON object")
            return json.loads(found)

        try:
            return retried(once, self.retries, sleep=self.sleep)
        except OSError as e:
            raise ReaderError("transient", str(e)) from e


def _post(url: str, body: dict, timeout: float, key: str | None) -> dict:
    from urllib.request import Request, urlopen

    head = {"Content-Type": "application/json"} | ({"Authorization": f"Bearer {key}"} if key else {})
    with urlopen(Request(url, json.dumps(body).encode(), head), timeout=timeout) as r:
        return json.load(r)


def chat_url(base: str) -> str:
    base = base.rstrip("/")
    end = "/chat/completions"
    return base if base.endswith(end) else base + ("" if base.endswith("/v1") else "/v1") + end


def retried(call: Callable, retries: int, transient: tuple = (OSError, TimeoutError), first: float = 0.5, most: float = 4.0, sleep: Callable = time.sleep):
    """call(), again after a transient error; the last error stands."""
    for n in range(retries + 1):
        try:
            return call()
        except transient:
            if n == retries:
                raise
            sleep(min(first * 2**n, most))


def complete(prompts: DataFrame, backend: Callable[[], ChatBackend], key: str = "id", prompt: str = "prompt", system: str = "", max_tokens: int = 4096) -> DataFrame:
    """(key, answer, error) of every prompt: one backend for each partition, made there; an error is a row, not a failure."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = backend()
        for pdf in frames:
            answers, errors = [], []
            for text in pdf[prompt]:
                messages = [{"role": "system", "content": system}] * bool(system) + [{"role": "user", "content": text}]
                try:
                    answers.append(model.complete(messages, max_tokens=max_tokens, temperature=0.0))
                    errors.append(None)
                except Exception as e:  # noqa: BLE001
                    answers.append(None)
                    errors.append(f"{type(e).__name__}: {e}"[:500])
            yield pd.DataFrame({key: pdf[key], "answer": answers, "error": errors})

    kind = dict(prompts.dtypes)[key]
    return prompts.select(key, prompt).mapInPandas(run, f"{key} {kind}, answer string, error string")


def repaired(prompts: DataFrame, backend: Callable[[], ChatBackend], errors_of: Callable[[DataFrame], DataFrame], rounds: int = 2, key: str = "id", prompt: str = "prompt") -> tuple[DataFrame, DataFrame]:
    """(accepted answers, prompts given up): answers with errors go back with the errors listed, `rounds` times at most.

    errors_of: (key, answer) -> (key, error) rows. What is given up needs a fallback page from the evidence itself.
    """
    kept, open_prompts = None, prompts.select(key, prompt)
    for n in range(rounds + 1):
        answers = cut(complete(open_prompts, backend, key, prompt).select(key, "answer").where("answer is not null"))  # a model is asked once
        bad = errors_of(answers).groupBy(key).agg(F.array_join(F.sort_array(F.collect_list("error")), "\n").alias("why"))
        good = answers.join(bad, key, "left_anti")
        kept = good if kept is None else kept.union(good)
        failed = open_prompts.join(good.select(key), key, "left_anti")
        if n == rounds or failed.isEmpty():
            return kept, failed
        open_prompts = failed.join(bad, key, "left").select(key, F.concat(prompt, F.lit("\n\nCorrect these errors:\n"), F.coalesce("why", F.lit("no answer"))).alias(prompt))
    return kept, open_prompts


# ---- payloads of readers


def clean_box(value) -> list[float] | None:
    """Four numbers in order from corners, points or a mapping; else none."""
    if value is None:
        return None
    if isinstance(value, dict):
        value = [value.get(k) for k in ("x1", "y1", "x2", "y2")] if "x1" in value else [value.get("left"), value.get("top"), value.get("right"), value.get("bottom")]
    if isinstance(value, (list, tuple)) and value and isinstance(value[0], (list, tuple)):
        value = [min(p[0] for p in value), min(p[1] for p in value), max(p[0] for p in value), max(p[1] for p in value)]
    try:
        x = [float(v) for v in value]
    except (TypeError, ValueError):
        return None
    return x if len(x) == 4 and all(abs(v) < 1e300 for v in x) and x[0] <= x[2] and x[1] <= x[3] else None


def clean_confidence(value) -> float | None:
    if value is None:
        return None
    try:
        return x if 0 <= (x := float(value)) <= 1 else None
    except (TypeError, ValueError):
        return None


def block(kind: str, text: str = "", markdown: str = "", html: str = "", bbox=None, confidence=None, order: int = 0) -> dict:
    return {"kind": kind, "text": text, "markdown": markdown, "html": html, "bbox": clean_box(bbox), "confidence": clean_confidence(confidence), "ord": order}


_TABLE = re.compile(r"<table\b.*?</table\s*>", re.S | re.I)


def markdown_blocks(text: str | None) -> list[dict]:
    """Text and HTML tables in turn; neighbouring tables stay apart."""
    text, out, at = text or "", [], 0
    for m in [*_TABLE.finditer(text), None]:
        part = text[at : m.start() if m else len(text)].strip()
        if part:
            out.append(block("text", part, part, order=len(out)))
        if m:
            out.append(block("table", html_text(m[0]), m[0], m[0], order=len(out)))
            at = m.end()
    return out


# Fixed value: a picture's place in an answer, in thousandths of the image that was read.
_PLACED = re.compile(r"""(?i)<img\s+src=["']images/bbox_(\d+)_(\d+)_(\d+)_(\d+)\.jpg["']\s*/?>""")


def placed_blocks(text: str | None, task: str | None, width: int, height: int) -> list[dict]:
    """Text, HTML tables and placed pictures of an answer in turn; places come as pixels of an image of width and height, held
    inside it. Text is of the task's kind where that is a kind of text."""
    kind = task if task in ("text", "chart", "formula") else "text"
    found = []
    for part in markdown_blocks(text):
        if part["kind"] == "table":
            found.append(part)
            continue
        at = 0
        for m in [*_PLACED.finditer(part["text"]), None]:
            words = part["text"][at : m.start() if m else None].strip()
            if words:
                found.append(block(kind, plain_text(words), words))
            if m:
                at = m.end()
                box = [min(int(n) * side / 1000, float(side)) for n, side in zip(m.groups(), (width, height) * 2, strict=True)]
                found.append(block("image", "", m[0], m[0], box))
    return [{**b, "ord": n} for n, b in enumerate(found)]


def literal_blocks(raw: str | None) -> list[dict]:
    """Blocks from a list of mappings, written as JSON or as Python literals."""
    for parse in (json.loads, ast.literal_eval):
        try:
            items = parse((raw or "").strip())
            break
        except (ValueError, SyntaxError):
            items = []
    out = []
    for item in items if isinstance(items, list) else []:
        if isinstance(item, dict):
            kind = str(item.get("label") or item.get("type") or "text").lower()
            body = str(item.get("content") or item.get("text") or "")
            html = clean_table(body) if "<table" in body else cell_tokens_table(body) if "<fcel>" in body else ""
            out.append(block("table" if html or kind == "table" else kind, html_text(html) if html else body, body, html, item.get("bbox"), item.get("confidence"), len(out)))
    return out


def payload_blocks(payload: str | None) -> list[dict]:
    """Blocks of a reader's JSON: vendor lists, plain blocks, or Markdown alone; confidences from detector boxes."""
    try:
        data = json.loads(payload or "{}")
    except ValueError:
        return markdown_blocks(payload)
    data = data.get("res", data) if isinstance(data, dict) else {}
    items = data.get("parsing_res_list") or data.get("blocks") or []
    if not items:
        return markdown_blocks(data.get("markdown") or data.get("html") or data.get("text"))
    boxes = [(b.get("label", ""), clean_box(b.get("coordinate") or b.get("bbox")), clean_confidence(b.get("score"))) for b in (data.get("layout_det_res") or {}).get("boxes", [])]
    out = []
    for item in items:
        kind = str(item.get("block_label") or item.get("kind") or "text").lower()
        body = str(item.get("block_content") or item.get("markdown") or item.get("text") or "")
        box = clean_box(item.get("block_bbox") or item.get("bbox"))
        html = body if "<table" in body.lower() else str(item.get("html") or "")
        score = clean_confidence(item.get("confidence"))
        if score is None and box:
            fits = [(_iou(box, b) + 0.05 * (label.lower() == kind), -i, s) for i, (label, b, s) in enumerate(boxes) if b]
            score = max(fits)[2] if fits and max(fits)[0] >= 0.5 else None
        out.append(block("table" if html else kind, html_text(html) if html else body, body, html, box, score, len(out)))
    return out


def _iou(a: list[float], b: list[float]) -> float:
    w, h = min(a[2], b[2]) - max(a[0], b[0]), min(a[3], b[3]) - max(a[1], b[1])
    both = max(w, 0) * max(h, 0)
    union = (a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - both
    return both / union if union else 0.0


def read_payloads(df: DataFrame, payload: str = "payload") -> DataFrame:
    """All columns but the payload, and a row for each of its blocks."""
    from evispark.functions.udfs import arrow

    tune(df.sparkSession)
    keep = [c for c in df.columns if c != payload]
    return df.select(*keep, F.inline(arrow(payload_blocks, BLOCKS)(payload)))
