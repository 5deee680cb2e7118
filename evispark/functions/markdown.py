"""Markdown kernels: claim lines, grounding, anchors, links, images, tables, and pieces of a page."""

from __future__ import annotations

import json
import posixpath
import re
from html import unescape
from urllib.parse import quote, unquote

from evispark.functions import patterns
from evispark.functions.html import span_table
from evispark.functions.requests import request_numbers, unapproved_requests
from evispark.functions.text import claim_numbers, local_citations, path_slug, prose_numbers, qualified_citations

_FENCE = re.compile(r"^\s*(```|~~~)")
_HEADING = re.compile(r"^ {0,3}(#{1,6})\s+(.*?)\s*#*\s*$")
_EXPLICIT = re.compile(r"""<[a-z]+[^>]*\b(?:id|name)\s*=\s*["']([^"']+)["']""", re.I)
_WIKILINK = re.compile(r"\[\[([^\[\]]+)\]\]")
_LINK = re.compile(r"(?<!!)\[((?:\\.|[^\]])*)\]\(\s*(<[^>\n]*>|[^)\s]+)([^)\n]*)\)")
_REFERENCE = re.compile(r"(?m)^( {0,3}\[[^\]\n]+\]:\s*)(\S+)(.*)$")
_HREF = re.compile(r"""(<a\b[^>]*\bhref\s*=\s*)(["'])([^"']*)\2""", re.I)
_EXTERNAL = re.compile(r"^(?:https?:|mailto:|data:)", re.I)


def escape_cell(value: str | None) -> str:
    return (value or "").replace("\\", "\\\\").replace("|", "\\|").replace("\n", "<br>")


def pipe_table(rows: list[list[str]]) -> str:
    line = lambda row: "| " + " | ".join(map(escape_cell, row)) + " |"
    return "\n".join([line(rows[0]), "| " + " | ".join("---" for _ in rows[0]) + " |", *map(line, rows[1:])]) if rows else ""


def table_markup(raw: str | None) -> str | None:
    """A table (JSON of rows, columns and origin cells) as a pipe table, or as HTML where a cell spans others."""
    if not raw:
        return None
    t = json.loads(raw)
    if t["rows"] <= 0 or t["columns"] <= 0:
        return ""
    if any(c["row_span"] > 1 or c["column_span"] > 1 for c in t["cells"]):
        return span_table(t["rows"], t["columns"], t["cells"])
    text = {(c["row"], c["column"]): c["text"] for c in t["cells"]}
    return pipe_table([[text.get((y, x)) or "" for x in range(t["columns"])] for y in range(t["rows"])])


def states(text: str) -> list[tuple[str, bool, bool]]:
    """(line, inside a code fence or one itself, inside an HTML comment) for every line."""
    out, fenced, comment = [], False, False
    for line in text.splitlines():
        mark = bool(_FENCE.match(line)) and not comment
        inside = fenced or mark
        fenced ^= mark
        opens = not inside and line.lstrip().startswith("<!--")
        out.append((line, inside, comment or opens))
        if comment or opens:
            comment = "-->" not in line
    return out


def is_claim(line: str) -> bool:
    """Lines that state something: not blank, no heading, rule, table delimiter or anchor."""
    line = line.strip()
    if not line or line[0] == "#" or line in ("---", "***", "___"):
        return False
    if re.fullmatch(r"\|?[\s:|-]+\|?", line):
        return False
    return not (line.startswith("<a ") and line.endswith(">"))


def grounding_errors(text: str | None, allowed: list[str] | None, evidence: str | None) -> list[str]:
    """What breaks the citation contract of a page: codes with the detail after a colon, none if all is well."""
    text, allowed = text or "", set(allowed or [])
    cited = local_citations(text)
    errors = [f"unknown-citation:{c}" for c in cited if c not in allowed]
    if not cited:
        errors.append("no-citation:")
    if re.search(patterns.MARKDOWN_IMAGE, text) or re.search(patterns.HTML_IMAGE, text) or "![[" in text:
        errors.append("image:")
    known = set(prose_numbers(evidence))
    errors += [f"number:{n}" for n in prose_numbers(text) if n not in known]
    errors += [f"uncited-line:{i}" for i, (line, _, comment) in enumerate(states(text), 1) if not comment and is_claim(line) and not local_citations(line)]
    return errors


def integrated_errors(text: str | None, facts: dict[str, dict] | None, accepted: list[str] | None) -> list[str]:
    """The contract of integrated pages. facts: of each allowed qualified citation its numbers and request numbers.

    Every line's numbers and requests must belong to the citations on that line; code lines need no citation."""
    text, facts = text or "", facts or {}
    cited = qualified_citations(text)
    errors = [f"unknown-citation:{c}" for c in cited if c not in facts]
    if not cited:
        errors.append("no-citation:")
    if "[[" in text or "]]" in text:
        errors.append("wikilink:")
    if re.search(patterns.MARKDOWN_IMAGE, text) or re.search(patterns.HTML_IMAGE, text):
        errors.append("image:")
    known = {n for f in facts.values() for n in f.get("numbers") or []}
    errors += [f"number:{n}" for n in claim_numbers(text) if n not in known]
    errors += [f"request:{r}" for r in unapproved_requests(text, accepted)]
    for i, (line, fenced, comment) in enumerate(states(text), 1):
        own = [facts[c] for c in qualified_citations(line) if c in facts]
        if not fenced and not comment and is_claim(line) and not own:
            errors.append(f"uncited-line:{i}")
        errors += [f"borrowed-number:{i}:{n}" for n in claim_numbers(line) if n in known and own and not any(n in (f.get("numbers") or []) for f in own)]
        errors += [f"borrowed-request:{i}:{r}" for r in request_numbers(line) if own and not any(r in (f.get("requests") or []) for f in own)]
    return errors


def excerpt(text: str | None, allowed: list[str] | None) -> str:
    """Blocks of lines that end in a line with a qualified citation; those whose last line cites an allowed one stay."""
    allowed, kept, held = set(allowed or []), [], []
    for line in (text or "").splitlines():
        held.append(line)
        cited = qualified_citations(line)
        if cited:
            if allowed.intersection(cited):
                kept += held
            held = []
    return "\n".join(kept).strip()


def cited_blocks(text: str | None) -> list[dict]:
    """(block, citations): runs of lines that end in a line with qualified citations; a rest without any is no block."""
    out, held = [], []
    for line in (text or "").splitlines():
        held.append(line)
        if cited := qualified_citations(line):
            out.append({"block": "\n".join(held).strip(), "citations": cited})
            held = []
    return out


def integrated_check(text: str | None, facts: str | None, accepted: list[str] | None) -> list[str]:
    """integrated_errors with the facts as JSON: an array of citation, numbers and requests."""
    return integrated_errors(text, {f["citation"]: f for f in json.loads(facts or "[]")}, accepted)


def evidence_links(text: str | None) -> str:
    """Qualified citations as links to their block on the evidence page of their slide."""

    def link(m: re.Match) -> str:
        source, slide = m[1], int(m[2])
        return f"[[evidence/{source}-{slide:04d}#{quote(m[3], safe='-._~')}|{source} slide {slide}]]"

    return re.sub(patterns.QUALIFIED_CITATION, link, text or "")


def anchors(text: str | None) -> list[str]:
    """Explicit ids and heading slugs outside fences; a slug that comes again gets -1, -2, ..."""
    out, seen = [], {}
    for line, fenced, _ in states(text or ""):
        if fenced:
            continue
        out += _EXPLICIT.findall(line)
        m = _HEADING.match(line)
        if m:
            slug = path_slug(re.sub(r"<[^>]+>|[`*_]", "", m[2]))
            n = seen.get(slug, 0)
            seen[slug] = n + 1
            out.append(f"{slug}-{n}" if n else slug)
    return list(dict.fromkeys(out))


def links(text: str | None) -> list[dict]:
    """(kind, target, fragment) of wiki, Markdown, reference and HTML links; external ones are marked so."""
    found = [("wiki", m[1].split("|")[0]) for m in _WIKILINK.finditer(text or "")]
    found += [("markdown", m[2].strip("<>")) for m in _LINK.finditer(text or "")]
    found += [("reference", m[2].strip("<>")) for m in _REFERENCE.finditer(text or "")]
    found += [("html", m[3]) for m in _HREF.finditer(text or "")]
    out = []
    for kind, target in found:
        path, _, fragment = target.partition("#")
        out.append({"kind": "external" if _EXTERNAL.match(target) else kind, "target": unquote(path.strip()), "fragment": unquote(fragment) or None})
    return out


def placed_links(text: str | None, page: str | None) -> list[dict]:
    """links(), each with its place: the path in the site that a relative one means, seen from its page. What is absolute, of
    another scheme, or leaves the site is unsafe."""
    out = []
    for link in links(text):
        kind, target, place = link["kind"], unescape(link["target"]), None
        if kind not in ("wiki", "external") and target:
            place = posixpath.normpath(posixpath.join(posixpath.dirname(page or ""), target.split("?")[0]))
            if target.startswith(("/", "\\")) or re.match(r"^[A-Za-z][A-Za-z0-9+.-]*:", target) or place.startswith(".."):
                kind, place = "unsafe", None
        out.append({"kind": kind, "target": target, "fragment": link["fragment"], "place": place})
    return out


def without_images(text: str | None) -> str:
    """Inline, reference and embedded images go; their words stay as plain text."""
    text = re.sub(r"!\[\[[^\]]*\]\]", "", text or "")
    text = re.sub(r"(?<!\\)!\[((?:\\.|[^\]])*)\](?:\([^\n)]*\)|\[[^\]\n]*\])", r"\1", text)
    return re.sub(r"(?i)<\s*/?\s*(?:img|picture|source|svg)\b[^>]*>", "", text)


def relative_link(source: str, target: str) -> str:
    return posixpath.relpath(target, posixpath.dirname(source) or ".")


def moved_links(text: str | None, source: str | None, output: str | None) -> str:
    """Local link targets of a file that moves from one path to another; other schemes than web and mail lose their link."""

    def target(old: str) -> str | None:
        if old.startswith("#") or re.match(r"(?i)^(?:https?|mailto):", old):
            return old
        if re.match(r"^[a-zA-Z][a-zA-Z0-9+.-]*:", old):
            return None
        path, mark, fragment = old.partition("#")
        place = posixpath.normpath(posixpath.join(posixpath.dirname(source or ""), path))
        return None if place.startswith("..") else relative_link(output or "", place) + mark + fragment

    def inline(m):
        new = target(m[2].strip("<>"))
        return m[1] if new is None else f"[{m[1]}]({new}{m[3]})"

    text = _LINK.sub(inline, text or "")
    text = _REFERENCE.sub(lambda m: "" if (new := target(m[2].strip("<>"))) is None else f"{m[1]}{new}{m[3]}", text)
    return _HREF.sub(lambda m: f"{m[1]}{m[2]}{target(m[3]) or '#'}{m[2]}", text)


def citation_link(citation: str | None, page: str | None, label: str | None = None) -> str | None:
    """Wiki link from a qualified citation to its evidence page."""
    m = re.fullmatch(patterns.QUALIFIED_CITATION, citation or "")
    return m and f"[[{page or m[1]}#{quote(f'slide-{m[2]}-{m[3]}', safe='-._~')}|{label or f'{m[1]} slide {int(m[2])}'}]]"


def linked_citations(text: str | None, targets: dict[str, str] | None, source: str | None = None, drop_unknown: bool = False) -> str:
    """Citations replaced by their links; local ones belong to `source`; unknown ones stay or go."""

    def swap(m, key):
        return (targets or {}).get(key, "" if drop_unknown else m[0])

    text = re.sub(patterns.QUALIFIED_CITATION, lambda m: swap(m, m[0]), text or "")
    return re.sub(patterns.LOCAL_CITATION, lambda m: swap(m, f"[@{source}/slide-{int(m[1])}#{m[2]}]" if source else m[0]), text)


def prepared(text: str | None) -> str:
    """Input Markdown without byte order mark, carriage returns and front matter."""
    text = (text or "").removeprefix("\ufeff").replace("\r\n", "\n").replace("\r", "\n")
    return re.sub(r"\A---\n.*?\n---\n", "", text, flags=re.S)


def evidence_block(text: str | None, anchor: str | None) -> str | None:
    """What stands between an anchor's opening and closing comments."""
    m = re.search(rf"<!-- BEGIN (?:BLOCK|TABLE) {re.escape(anchor or '')} -->\n(.*?)\n?<!-- END (?:BLOCK|TABLE) {re.escape(anchor or '')} -->", text or "", re.S)
    return m and m[1]
