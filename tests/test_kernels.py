"""Text, request, HTML and Markdown kernels on small cases."""

import json

import pytest

from evispark.functions import html, markdown, requests, text
from evispark.operators import readers


def test_normalise_text():
    assert text.normalise_text("é \r\nb\t\rc\n\n") == "é\nb\nc"
    assert text.normalise_text(None) == ""


@pytest.mark.parametrize("raw, want", [("1,200.50", "1200.5"), ("+3", "3"), ("-0", "0"), ("12.00%", "12%"), ("7％", "7%"), ("1.0", "1")])
def test_canonical_number(raw, want):
    assert text.canonical_number(raw) == want


def test_number_grammars():
    assert text.prose_numbers("1. item 40 [slide-3#e9] −5 and 3.5x [a](b9) <i7>") == ["-5", "3.5", "40"]
    assert text.claim_numbers("A1 has 2 of 1,000 (3%) [@src/slide-7#e8] 4x") == ["1000", "2", "3%"]


def test_identifiers_keep_the_first_spelling():
    assert text.identifiers("LOT NO.\nLot No. ABC123 lot no. x") == ["LOT NO."]
    assert text.identifiers("AB-12 ab-12 Ab-12 CD_3") == ["AB-12", "CD_3"]


def test_slugs():
    assert text.topic_slug("  Größe & Maß!! ") == "grösse-mass"
    assert text.page_slug("con") == "page-con" and text.page_slug("한글").startswith("page-")
    assert text.path_slug("COM1.txt") == "item-com1.txt"
    assert text.topic_key("A-b Ⅷ c!") == "abviiic"


def test_split_text():
    assert text.split_text("ab\ncd\nefghijk\nl\n", 5) == ["ab", "cd", "efghi", "jk", "l"]
    long = "x" * 11 + "\nshort\n"
    parts = text.split_text(long, 5)
    assert all(len(p) <= 5 for p in parts) and "".join(parts) == long.replace("\n", "")
    assert text.split_text("", 5) == [""]


def test_lenient_json():
    assert json.loads(text.lenient_json('Sure:\n```json\n{"b": 1, "a": [2]}\n```')) == {"a": [2], "b": 1}
    assert json.loads(text.lenient_json('well {"a": {"b": 2}} so')) == {"a": {"b": 2}}
    assert text.lenient_json("none") is None


def test_repeats():
    assert text.repeats_at_end("start " + "ab" * 60) and not text.repeats_at_end("plain words only")
    # int(4 * (1 + 3 / period)) copies are still none too many: 16 of one character, 10 of two
    assert [text.repeats_at_end("x" + u * n) for u, n in (("a", 16), ("a", 17), ("ab", 10), ("ab", 11))] == [False, True, False, True]
    tail = "y" * 9000 + "end."
    assert text.cut_repeats(tail) == tail
    assert text.cut_repeats("h" * 10 + "abc" * 4000).count("abc") == 1


def test_requests_in_text_lists_and_tables():
    assert requests.request_numbers("PR-00123 and PR 00456, also PR No.: A-77") == ["PR-00123", "PR 00456", "A-77"]
    assert requests.request_numbers("의뢰번호\nEF236_1\nEF236_2\n\nend") == ["EF236_1", "EF236_2"]
    table = "| name | 의뢰번호 |\n| --- | --- |\n| a | EF236_123_4321 |\n| b | EF236_123_9876 |"
    assert requests.request_numbers(table) == ["EF236_123_4321", "EF236_123_9876"]
    spans = "<table><tr><td rowspan=3>의뢰번호</td><td>lot</td></tr><tr><td>L1</td></tr></table>"
    assert requests.request_numbers(spans) == []
    grown = "<table><tr><th>의뢰번호</th><th>Lot</th></tr><tr><td rowspan='2'>EF236_123_4321</td><td>L-1</td></tr><tr><td>L-2</td></tr></table>"
    assert requests.request_numbers(grown) == ["EF236_123_4321"]
    assert requests.request_numbers(None) == [] and requests.request_numbers("no numbers at all") == []


def test_request_keys_and_changes():
    assert requests.request_key("pr 00-123") == requests.request_key("PR_00123") == "00123"
    assert requests.request_key("PR-") is None and requests.request_key("PR-a") is None
    assert requests.changed_requests("PQ-123; PR-123", ["PR-123"]) == ["PQ-123"]
    assert requests.changed_requests("PQ-123", ["PR-123"], "PQ-123; there") == []
    assert requests.unapproved_requests("PR-9 and PR-8", ["PR-9"]) == ["PR-8"]


def test_html_tables():
    rows = html.table_rows("<table><tr><td colspan=2>a</td><td>b</td></tr><tr><td rowspan=2>c</td><td>d</td><td>e</td></tr><tr><td>f</td></tr></table>")
    assert rows == [[["a", "a", "b"], ["c", "d", "e"], ["c", "f"]]]
    assert html.clean_table("<table onclick=x><tr><td colspan='3' style='a'>x<script>bad</script></td></table>") == '<table><tr><td colspan="3">x</td></tr></table>'
    assert html.cell_tokens_table("<lcel><ecel>no<nl><fcel>x < y<ucel><xcel><nl>") == "<table><tr><td></td><td></td></tr><tr><td>x &lt; y</td></tr></table>".replace("<td></td></tr>", '<td rowspan="2"></td></tr>', 1)
    assert html.cell_tokens_table("<fcel>a<lcel><nl><fcel>b<fcel>c<nl>") == '<table><tr><td colspan="2">a</td></tr><tr><td>b</td><td>c</td></tr></table>'
    assert "<script" not in html.plain_text("<p>a</p><script>x</script>b") and html.plain_text("<p>a</p>b") == "a\nb"
    spanned = html.span_table(2, 2, [{"row": 0, "column": 0, "text": "a<", "row_span": 1, "column_span": 2}])
    assert 'colspan="2">a&lt;' in spanned and spanned.count("<td") == 2


def test_grounding():
    ok = "# T\nSales were 40 [slide-1#a]\n---\n<!-- note\n5 -->\n"
    assert markdown.grounding_errors(ok, ["[slide-1#a]"], "40") == []
    bad = markdown.grounding_errors("300 in total [slide-1#b]\nnothing cited ![x](y)", ["[slide-1#a]"], "100 200")
    assert {e.split(":")[0] for e in bad} == {"unknown-citation", "image", "number", "uncited-line"}
    facts = {"[@s/slide-1#a]": {"numbers": ["1", "40"], "requests": ["PR-1"]}, "[@s/slide-2#b]": {"numbers": ["50"], "requests": []}}
    assert markdown.integrated_errors("PR-1 has 40 [@s/slide-1#a]", facts, ["PR-1"]) == []
    assert markdown.integrated_errors("it has 40 [@s/slide-2#b]", facts, ["PR-1"]) == ["borrowed-number:1:40"]


def test_pages_and_links():
    assert markdown.anchors("# A b\n# A b\n```\n# no\n```\n<a id='x'></a>") == ["a-b", "a-b-1", "x"]
    found = markdown.links("[[p#s|t]] [a](b.md#c)\n[r]: http://x\n<a href='q.html'>")
    assert [(x["kind"], x["target"], x["fragment"]) for x in found] == [("wiki", "p", "s"), ("markdown", "b.md", "c"), ("external", "http://x", None), ("html", "q.html", None)]
    assert markdown.moved_links("[a](img/x.md#s) [b](http://c) [d](ftp://e)", "src/p.md", "out/deep/p.md") == "[a](../../src/img/x.md#s) [b](http://c) d"
    assert markdown.without_images("a ![b](c) <img src=x> d") == "a b  d"
    assert markdown.excerpt("x\ny [@s/slide-1#a]\nz [@s/slide-2#b]\ntail", ["[@s/slide-2#b]"]) == "z [@s/slide-2#b]"
    assert markdown.citation_link("[@s/slide-03#e é]", "p") is None
    assert markdown.citation_link("[@s/slide-03#é]", "p") == "[[p#slide-03-%C3%A9|s slide 3]]"
    assert markdown.prepared("﻿---\na: b\n---\nx\r\ny") == "x\ny"


def test_reader_payloads():
    vendor = {"res": {"parsing_res_list": [{"block_label": "table", "block_content": "<table><tr><td>a</td></tr></table>", "block_bbox": [0, 0, 90, 100]}, {"block_label": "table", "block_content": "<table></table>", "block_bbox": [94, 0, 190, 100]}], "layout_det_res": {"boxes": [{"label": "table", "coordinate": [0, 0, 90, 100], "score": 0.93}, {"label": "table", "coordinate": [94, 0, 190, 100], "score": 0.88}]}}}
    got = readers.payload_blocks(json.dumps(vendor))
    assert [(b["kind"], b["confidence"]) for b in got] == [("table", 0.93), ("table", 0.88)]
    two = readers.payload_blocks(json.dumps({"markdown": "t\n<table><tr><td>1</td></tr></table>\nu\n<table></table>"}))
    assert [b["kind"] for b in two] == ["text", "table", "text", "table"]
    assert [b["kind"] for b in readers.literal_blocks("[{'label': 'text', 'content': 'x', 'bbox': [1, 2, 3, 4]}]")] == ["text"]
    assert readers.clean_box([[0, 1], [5, 1], [5, 9], [0, 9]]) == [0, 1, 5, 9] and readers.clean_box([3, 0, 1, 1]) is None
    assert readers.clean_confidence("0.5") == 0.5 and readers.clean_confidence(2) is None


def test_retries_and_urls():
    calls, slept = [], []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise OSError
        return "ok"

    assert readers.retried(flaky, 2, sleep=slept.append) == "ok" and slept == [0.5, 1.0]
    with pytest.raises(OSError):
        readers.retried(lambda: (_ for _ in ()).throw(OSError()), 1, sleep=slept.append)
    assert readers.chat_url("http://h") == "http://h/v1/chat/completions" == readers.chat_url("http://h/v1/")
