"""Importance resampling, the Merkle manifest and sharding against brute force, with awkward rows."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from evispark.llm import manifest, resampling, sharding

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def runs(text, n=2):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    return len(w), [" ".join(w[i : i + k]) for k in range(1, n + 1) for i in range(len(w) - k + 1)]


def test_crc_of_any_words():
    rng = random.Random(1)
    words = [bytes(rng.randrange(256) for _ in range(rng.choice([0, 1, 3, 63, 64, 65, 200, 1000]))) for _ in range(300)]
    ends = np.cumsum([len(w) for w in words])
    data, start = np.frombuffer(b"".join(words), np.uint8), ends - [len(w) for w in words]
    crc = resampling.word_crcs(data, start, ends)
    assert crc.tolist() == [zlib.crc32(w) for w in words]
    joined = resampling.appended(crc[:-1], (ends - start)[1:], crc[1:])
    assert joined.tolist() == [zlib.crc32(a + b) for a, b in zip(words, words[1:])]
    assert resampling.word_crcs(data[:0], start[:0], ends[:0]).tolist() == [] and zlib.crc32(b" ") == 0xE96CCF45


def brute_importance(rows, target, seed, percent, least, buckets):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = Counter(bucket(f) for _, x in rows for f in runs(x)[1]), Counter(bucket(f) for x in target for f in runs(x)[1])
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (s.total() + buckets) / ((s[b] + 1) * (t.total() + buckets))))
    out = []
    for d, x in rows:
        n, own = runs(x)
        weight = sum(gain(bucket(f)) for f in own) // len(own) if own else 0
        h = int(sha256(f"{seed}:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        out.append((d, n, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    ranks = defaultdict(list)
    for i, r in enumerate(able):
        ranks[r].append(i + 1 if i < percent * len(able) // 100 else None)
    return sorted(((*r, ranks[r].pop() if r in ranks else None) for r in out), key=repr)


@pytest.mark.parametrize("chunk_words", [7, 4096])
def test_importance_resampling(spark, make_docs, texts, chunk_words):
    """Long texts in chunks, repeated rows and ids, null ids; the same results whatever the chunks."""
    rows = list(enumerate(texts)) + [(3, texts[3]), (3, texts[3]), (None, texts[5]), (None, texts[5]), (7, "other words " * 30), (None, None)]
    target = ["abc def gh", None, texts[4], ""]
    docs = make_docs([x for _, x in rows], [d for d, _ in rows])
    got = resampling.importance(docs, spark.createDataFrame([(x, 1) for x in target], "text string, key int"), 7, 50, 20, 2, 500, chunk_words)
    assert sorted(((r.doc_id, r.n_words, r.n_features, r.weight, r.score, r["rank"]) for r in got.collect()), key=repr) == brute_importance(rows, target, 7, 50, 20, 500)
    ids = {r.doc_id for r in got.where("rank is not null").collect()}
    assert {r.doc_id for r in resampling.drawn(docs, got).collect()} == ids


def test_longer_runs_over_chunks(make_docs, texts):
    rows = resampling.counted(make_docs(texts), 3, 97, 5).groupBy("doc_id").agg(F.sum("n_features").alias("n"), F.flatten(F.collect_list("buckets")).alias("b"), F.flatten(F.collect_list("counts")).alias("c"), F.count("*").alias("chunks"))
    for r in rows.collect():
        want = Counter(zlib.crc32(f.encode()) % 97 for f in runs(texts[r.doc_id], 3)[1])
        have = Counter()
        for b, c in zip(r.b, r.c, strict=True):
            have[b] += c
        assert have == want and r.n == want.total() and r.chunks == max(1, -(-runs(texts[r.doc_id])[0] // 5))


def test_importance_of_nothing(spark, make_docs):
    empty = make_docs([])
    assert resampling.importance(empty, empty).count() == 0
    only = resampling.importance(make_docs(["one two"]), empty, least_words=1, percent=100).collect()
    assert [(r.doc_id, r.n_features, r["rank"]) for r in only] == [(0, 3, 1)]


def digest(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def brute_proofs(leaves, fanout):
    """(root, siblings of each leaf with the place among them) of one tree."""
    paths, at, nodes = [[] for _ in leaves], list(range(len(leaves))), list(leaves)
    while len(nodes) > 1:
        for p, i in zip(paths, at, strict=True):
            low = i - i % fanout
            p.append((nodes[low:i], nodes[i + 1 : low + fanout]))
        nodes, at = [digest(*nodes[i : i + fanout]) for i in range(0, len(nodes), fanout)], [i // fanout for i in at]
    return nodes[0], paths


def brute_manifest(rows, fanout=16):
    trees = defaultdict(list)
    for r in rows:
        own = [r["doc_id"], r["source"], r["lang"], r["n_chars"], r["text"]]
        other = [*own[:4], None if own[4] is None else own[4].translate(LOWER)]
        tampered = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0
        leaf = digest(*map(field, own))
        trees[r["source"]].append((r["doc_id"], leaf, digest(*map(field, other)) if tampered else leaf))
    names = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    own = {}
    for x in names:
        trees[x].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        own[x] = brute_proofs([r[1] for r in trees[x]], fanout)
    root, tops = brute_proofs([own[x][0] for x in names], fanout)
    for x, top in zip(names, tops, strict=True):
        for (d, leaf, claim), path in zip(trees[x], own[x][1], strict=True):
            node = claim
            for before, after in path + top:
                node = digest(*before, node, *after)
            yield d, leaf, own[x][0], root, digest(*(h for before, after in path + top for h in before + after)), node, node == root


DOCS = "doc_id long, source string, lang string, n_chars long, text string, tree string, block int, rank int, digest string, ord int"


@pytest.mark.parametrize("levels", [1, 3])
def test_merkle_manifest(spark, levels):
    """Trees of 1 to 300 leaves (blocks of one level make five rounds), null and repeated ids, sources with awkward names."""
    rng = random.Random(2)
    rows = []
    for source, n in (("a", 300), (None, 17), ("", 16), ("é", 1), ("b", 4), ("Z", 33), *((f"s{i}", 1) for i in range(20))):
        rows += [{"doc_id": rng.choice([None, rng.randrange(200), len(rows)]), "source": source, "lang": rng.choice([None, "", "de"]), "n_chars": rng.choice([None, 5]), "text": rng.choice([None, "", "Große WÖRTER", "x" * 3000])} for _ in range(n)]
    rows += rows[:40]
    docs = spark.createDataFrame([(*r.values(), "t", 1, 2, "d", 3) for r in rows], DOCS).repartition(7)
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for fanout in (16, 3) if levels == 1 else (16,):
        made = manifest.manifest(docs, fanout=fanout, levels=levels, claims={"text": F.when(F.coalesce(crc % 5 == 0, F.lit(False)), lower).otherwise(F.col("text"))})
        got = manifest.verified(made).select("doc_id", "leaf", "subroot", "root", F.sha2("siblings", 256), "folded_root", "verified")
        want = sorted(brute_manifest(rows, fanout), key=repr)
        assert sorted(map(tuple, got.collect()), key=repr) == want
        assert {r[-1] for r in want} == {True, False}
    assert manifest.verified(manifest.manifest(docs.limit(0))).count() == 0


def test_climb_aligned_blocks():
    leaves = np.frombuffer("".join(digest(str(i)) for i in range(37)).encode(), np.uint8).reshape(-1, 64)
    assert [len(x) for x in manifest.climb(leaves, 16, None)] == [37, 3, 1] and [len(x) for x in manifest.climb(leaves[:1], 16, None)] == [1]
    assert [len(x) for x in manifest.climb(leaves[:1], 16, 3)] == [1, 1, 1, 1]


@pytest.mark.parametrize("law", sharding.LAWS)
def test_sharding(spark, make_docs, law, tmp_path):
    rng = random.Random(3)
    rows = [(rng.choice([None, i]), rng.choice([None, "", "same", "ä" * rng.randrange(200)])) for i in range(900)] + [(5, "hot copy")] * 500
    docs = make_docs([x for _, x in rows], [d for d, _ in rows])
    out = sharding.sharded(docs, 8, law, bucket_bytes=5_000)
    got = out.collect()
    assert Counter((r.doc.doc_id, r.doc.text, r.doc.lang) for r in got) == Counter((d, x, "en") for d, x in rows)
    assert all(r.size == len((r.doc.text or "").encode()) + 1 and r.law == law for r in got)
    slots, sizes = defaultdict(list), Counter()
    for r in got:
        slots[r.shard].append(r.slot)
        sizes[r.shard] += r.size
    assert set(slots) <= set(range(8)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    if law == "rows":
        assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    if law == "bytes":
        assert max(sizes.values()) - min(sizes.values()) <= 2 * max(r.size for r in got)
    if law == "key":
        assert len({(r.doc.doc_id, r.shard) for r in got}) == len({r.doc.doc_id for r in got})
        assert {r.grown_shard for r in got if r.grown_shard != r.shard} == {8}
        nine = sharding.sharded(docs, 9, law, bucket_bytes=5_000)
        assert {r.doc.doc_id: r.shard for r in nine.collect()} == {r.doc.doc_id: r.grown_shard for r in got}
    else:
        assert {r.grown_shard for r in got} == {None}
        again = sharding.sharded(docs, 8, law, bucket_bytes=5_000).select("shard", "slot", "doc.doc_id", "doc.text")
        assert set(map(tuple, again.collect())) == {(r.shard, r.slot, r.doc.doc_id, r.doc.text) for r in got}
        # a random order: neighbours in the input are far apart, copies spread over all shards
        copies = Counter(r.shard for r in got if r.doc.text == "hot copy")
        assert len(copies) == 8 and max(copies.values()) < 120
    sharding.write_shards(out, str(tmp_path / law))
    back = spark.read.parquet(str(tmp_path / law)).select("shard", "slot", "doc.doc_id", "doc.text")
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(((r.shard, r.slot, r.doc.doc_id, r.doc.text) for r in got), key=repr)
    assert sharding.sharded(docs.limit(0), 8, law).count() == 0


def test_fisher_yates_is_even(spark, make_docs):
    """Over many seeds a row stands about as often in each quarter of the order."""
    docs = make_docs([str(i) for i in range(40)]).coalesce(1)
    at = Counter()
    for seed in range(12):
        n = {r.doc.doc_id: (r.slot * 4 + r.shard) for r in sharding.sharded(docs, 4, "rows", seed).collect()}
        at.update((d < 20, x // 20) for d, x in n.items())
    assert all(80 <= at[k] <= 160 for k in at) and len(at) == 4
    with pytest.raises(ValueError):
        sharding.sharded(docs, 8, "other")
