"""Substring dedup, suffix-array dedup, Jaccard join, packing and the codec against brute force, with awkward rows."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from evispark.llm import jaccard, packing, piece_codec, substring, suffixes
from evispark.llm.components import components
from evispark.llm.textkit import leftmost_minimum


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def removed_anywhere(rows, width):
    seen = Counter(tuple(w[i : i + width]) for _, t in rows for w in [words(t)] for i in range(len(w) - width + 1))
    for d, t in rows:
        w = words(t)
        gone = [False] * len(w)
        for i in range(len(w) - width + 1):
            if seen[tuple(w[i : i + width])] > 1:
                gone[i : i + width] = [True] * width
        kept = [x for x, g in zip(w, gone, strict=True) if not g]
        yield d, len(w), len(w) - len(kept), hashlib.sha256(" ".join(kept).encode()).hexdigest()


def test_leftmost_minimum():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 5, 200).astype(np.uint64)
    for width in (1, 2, 3, 28, 43):
        assert leftmost_minimum(x, width).tolist() == [i + int(np.argmin(x[i : i + width])) for i in range(len(x) - width + 1)]


def test_substring_dedup(make_docs, texts):
    got = substring.repeat_digests(make_docs(texts)).collect()
    assert sorted(map(tuple, got)) == sorted(removed_anywhere(list(enumerate(texts)), 35))
    again = substring.repeat_digests(make_docs([texts[9], texts[9]], [1, 1])).collect()
    assert sorted(map(tuple, again)) == sorted(removed_anywhere([(1, texts[9])] * 2, 35))


def test_substring_dedup_of_rows_that_repeat(make_docs, texts):
    """A third of all rows is one row: each gets the text's runs once, not once for every repeat."""
    rows = [(None, texts[9])] * 300 + list(enumerate(texts))
    docs = make_docs([t for _, t in rows], [d for d, _ in rows])
    got = substring.repeat_digests(docs).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(removed_anywhere(rows, 35), key=repr)
    from evispark.llm import spans

    def finish(batch, texts):
        return [batch.column(0), pa.array([0 if r is None else len(r) for r in batch.column(2).to_pylist()])]

    own = spans.keyed(docs.where("doc_id is null"), "doc_id", "text")
    sizes = {r.n for r in spans.without(own, substring.repeated_runs(own, 35), 35, finish, "doc_id long, n long").collect()}
    few = spans.keyed(docs.where("doc_id is null").limit(2), "doc_id", "text")
    assert sizes == {r.n for r in spans.without(few, substring.repeated_runs(few, 35), 35, finish, "doc_id long, n long").collect()}


def test_suffix_array_dedup(make_docs, texts):
    seen, want = set(), []
    for d, t in enumerate(texts):
        w = words(t)
        gone = [False] * len(w)
        for i in range(len(w) - 49):
            x = tuple(w[i : i + 50])
            if x in seen:
                gone[i : i + 50] = [True] * 50
            seen.add(x)
        want.append((d, len(w), sum(gone), None if t is None else [x for x, g in zip(w, gone, strict=True) if not g]))
    got = suffixes.remove_later_copies(make_docs(texts)).collect()
    assert sorted((r.doc_id, r.n_words, r.n_removed, None if r.text is None else words(r.text)) for r in got) == want
    untouched = {r.doc_id: r.text for r in got if r.n_removed == 0}
    assert all(texts[d] == t for d, t in untouched.items())


def shingles(text):
    w = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def test_jaccard_components(make_docs, texts):
    sets = [shingles(t) for t in texts]
    up = list(range(len(texts)))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((top(a), top(b)))
                up[y] = x
    got = jaccard.linked(make_docs(texts)).collect()
    assert sorted(map(tuple, got)) == [(d, len(sets[d]), top(d)) for d in range(len(texts))]


def test_count_tree_loses_no_pair():
    rng = np.random.default_rng(3)
    sizes = rng.integers(1, 60, 300)
    sets = [rng.integers(0, 90, n) for n in sizes]
    sizes = np.array([len(set(s.tolist())) for s in sets])
    counts = np.array([np.bincount(np.unique(s) % jaccard.GROUPS, minlength=jaccard.GROUPS) for s in sets]).astype(np.uint8)
    tree = jaccard.CountTree(counts, sizes, Fraction(1, 2))
    for q in range(0, 300, 7):
        found = set(tree.search(counts[q], int(sizes[q]))[0].tolist())
        mine = set(sets[q].tolist())
        assert {i for i, s in enumerate(sets) if 2 * len(mine & set(s.tolist())) >= len(mine | set(s.tolist()))} <= found


def test_empty_tables(make_docs):
    none = make_docs([])
    assert substring.repeat_digests(none).count() == suffixes.remove_later_copies(none).count() == jaccard.linked(none).count() == 0
    assert packing.best_fit(none, public_tokenizers.path("word_bpe_49k.json")).count() == 0
    assert piece_codec.codec_digests(none, public_tokenizers.path("piece_bpe_32k.model")).count() == 0


def test_null_ids(make_docs, texts):
    docs = make_docs([texts[9], texts[9], None], [None, 7, None])
    got = {(r.doc_id, r.n_shingles > 0, r.component_id) for r in jaccard.linked(docs).collect()}
    assert got == {(None, True, 7), (7, True, 7), (None, False, None)}
    assert sorted(r.n_removed for r in suffixes.remove_later_copies(docs).collect()) == [0, 0, len(words(texts[9])) if len(words(texts[9])) >= 50 else 0]


def test_codec_is_exact(make_docs, texts):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    odd = [*texts, " a", "a ", "a  b", "▁", "\n", "   ", "x\x00y", "é́", "😀 😀", "12 345", " " * 70 + "the", "tab\tthe", "</s> <s>"]
    for r in piece_codec.codec_rows(make_docs(odd), path).collect():
        ids = model.encode(odd[r.doc_id] or "", add_bos=True, add_eos=True)
        assert r.ids == ids and r.decoded == model.decode(ids)
    for r in piece_codec.codec_digests(make_docs(odd), path).collect():
        ids = np.array(model.encode(odd[r.doc_id] or "", add_bos=True, add_eos=True), dtype="<u4")
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(model.decode(ids.tolist()).encode()).hexdigest()


def test_long_texts_and_repeated_rows(make_docs, texts):
    """Texts of 20,000 words, twice under one id and once under none, through the operators that no SQL holds against others."""
    import sentencepiece
    from tokenizers import Tokenizer

    plain = " ".join(t for t in texts if t).split()
    long = "  ".join(plain[(i * 7919) % len(plain)] + ("\n" if i % 50 == 0 else "") for i in range(20_000))
    rows = [(1, long), (1, long), (None, long), (2, "short"), (2, "short"), (None, None), (3, long[: len(long) // 2])]
    docs = make_docs([t for _, t in rows], [d for d, _ in rows])
    path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    want = []
    for d, t in rows:
        ids = np.array(model.encode(t or "", add_bos=True, add_eos=True), dtype="<u4")
        want.append((d, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(model.decode(ids.tolist()).encode()).hexdigest()))
    assert sorted(map(tuple, piece_codec.codec_digests(docs, path).collect()), key=repr) == sorted(want, key=repr)
    path = public_tokenizers.path("word_bpe_49k.json")
    words_model = Tokenizer.from_file(path)
    pieces = Counter()
    for d, t in rows:
        ids = np.array([*words_model.encode(t or "", add_special_tokens=False).ids, 0], dtype="<u4")
        pieces.update((d, k, a, len(ids[a : a + 2048]), zlib.crc32(ids[a : a + 2048].tobytes())) for k, a in enumerate(range(0, len(ids), 2048)))
    got = packing.best_fit(docs, path, 2048).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == pieces
    taken = defaultdict(list)
    for r in got:
        taken[r.sequence_id].append((r.offset, r.length))
    assert all(sum(n for _, n in own) <= 2048 and [a for a, _ in sorted(own)] == [sum(n for _, n in sorted(own)[:i]) for i in range(len(own))] for own in taken.values())
    assert sorted(map(tuple, substring.repeat_digests(docs).collect()), key=repr) == sorted(removed_anywhere(rows, 35), key=repr)


def test_ties_in_packing(spark):
    """Pieces that are equal in size and order are packed each, wherever they fall."""
    rows = spark.createDataFrame([(1, 700)] * 60 + [(1, 600)] * 60, "doc_id long, length long").repartition(5)
    got = packing.pack(rows, 2000, ["doc_id"]).collect()
    taken = defaultdict(int)
    for r in got:
        taken[r.sequence_id] += r.length
    assert len(got) == 120 and max(taken.values()) <= 2000 and sum(taken.values()) == 78_000 and len({(r.sequence_id, r.offset) for r in got}) == 120


def test_packing_deals_gaps_over_tasks(spark, monkeypatch):
    """Many gaps and a few small pieces: gaps are dealt out like pieces, and those that hold no piece wait."""
    monkeypatch.setattr(packing, "SHARE", 1000)
    sizes = [1900] * 6000 + [2048] * 50 + [70] * 20 + [600] * 5 + [1] * 3
    pieces = spark.createDataFrame([(i, n) for i, n in enumerate(sizes)], "doc_id long, length long")
    seen = []
    plain = packing._dealt

    def dealt(own, gaps, number, order):
        out = plain(own, gaps, number, order)
        seen.append([r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()])
        return out

    monkeypatch.setattr(packing, "_dealt", dealt)
    rows = packing.pack(pieces, 2048, ["doc_id"]).collect()
    assert len(rows) == len(sizes) and max(map(max, seen)) <= 1002 and len(max(seen, key=sum)) >= 6
    taken = defaultdict(list)
    for r in rows:
        taken[r.sequence_id].append((r.offset, r.length))
    for parts in taken.values():
        ends = [a + n for a, n in sorted(parts)]
        assert [0, *ends[:-1]] == [a for a, _ in sorted(parts)] and ends[-1] <= 2048
    assert len(taken) == 6050 + 2  # the 600s fill two sequences, all other small ones lie in gaps


@pytest.mark.parametrize("capacity", [64, 2048])
def test_packing_round_trip(make_docs, texts, capacity):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    model = Tokenizer.from_file(path)
    odd = [*texts, "<|endoftext|>", "<|ENDOFTEXT|> a<|startoftext|>b", "it's 'll 're.'s", "Kelvin K İ ς Σ"]
    want, total = {}, 0
    for d, t in enumerate(odd):
        ids = np.array([*model.encode(t or "", add_special_tokens=False).ids, 0], dtype="<u4")
        total += len(ids)
        for piece, a in enumerate(range(0, len(ids), capacity)):
            part = ids[a : a + capacity]
            want[d, piece] = a, len(part), zlib.crc32(part.tobytes())
    rows = packing.best_fit(make_docs(odd), path, capacity).collect()
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows} == want and len(rows) == len(want)
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for own in bins.values():
        at = 0
        for off, n in sorted(own):
            assert off == at
            at += n
        assert at <= capacity
    best = len(list(best_fit_decreasing([v[1] for v in want.values()], capacity)))
    assert -(-total // capacity) <= len(bins) <= best + 1


def best_fit_decreasing(sizes, capacity):
    gaps = []
    for s in sorted(sizes, reverse=True):
        fit = [g for g in gaps if g >= s]
        if fit:
            gaps.remove(min(fit))
            gaps.append(min(fit) - s)
        else:
            gaps.append(capacity - s)
    return gaps


def test_components_of_paths(spark):
    edges = [(i, i + 1) for i in range(0, 60) if i % 20 != 19] + [(5, 5), (None, 3), (3, None), (7, 6)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "x long, y long")).collect()))
    assert got == {i: i // 20 * 20 for i in range(60)}
    assert components(spark.createDataFrame([], "x long, y long")).count() == 0
