"""Embedding near-dedup, top-k, licences, classifiers and the pipeline."""

import math
import random

import numpy as np
import public_tokenizers  # noqa: F401
import pytest

import corpus_pipeline
from evispark.llm import embeddings, learning, licenses, quality, topk, toxicity

SF = "/root/testdata/sf0.001"


def vectors(spark):
    rng = np.random.default_rng(1)
    rows, base = [], rng.standard_normal((40, 8))
    for i, v in enumerate(base):
        for _ in range(i % 5):
            rows.append((v + rng.normal(0, 0.12, 8)).tolist())
        rows.append(v.tolist())
    rows += [rows[0], rows[0], None, [0.0] * 8, [float("nan")] * 8, [1.0, None] * 4, [float("inf")] * 8, [1.0, 2.0], [2.0, 4.0], []]
    out = [(i, r, i % 2 if i % 11 else None, 5) for i, r in enumerate(rows)] + [(0, rows[0], None, 5), (None, rows[1], 1, 5)]
    return out, spark.createDataFrame(out, "vec_id long, embedding array<float>, label int, node long")


def test_near_duplicates(spark):
    rows, df = vectors(spark)
    f32 = [None if v is None or any(x is None or not math.isfinite(x) for x in v) else np.array(v, np.float32).astype(float) for _, v, *_ in rows]
    n = len(rows)
    ok = [v is not None and len(v) and v.any() and rows[i][2] is not None and rows[i][0] is not None for i, v in enumerate(f32)]
    near = [[j for j in range(n) if i != j and ok[i] and ok[j] and rows[i][2] == rows[j][2] and len(f32[i]) == len(f32[j]) and f32[i] @ f32[j] >= 0.93 * np.linalg.norm(f32[i]) * np.linalg.norm(f32[j])] for i in range(n)]
    comp = {i: rows[i][0] for i in range(n) if rows[i][0] is not None}
    for _ in range(n):
        for i in comp:
            for j in near[i]:
                comp[i] = comp[j] = min(comp[i], comp[j])
    want = sorted((rows[i][0], len(near[i]), comp[i], comp[i] == rows[i][0]) for i in comp)
    got = [tuple(r) for r in embeddings.near_duplicates(df).collect()]
    assert sorted(r for r in got if r[0] is not None) == want
    assert [r for r in got if r[0] is None] == [(None, 0, None, True)]
    assert embeddings.near_duplicates(df.limit(0)).count() == 0


def test_vectors_of_one_id(spark):
    """Rows that repeat an id with other vectors are apart."""
    rows = [(1, [1.0, 0.0], 1), (1, [0.0, 1.0], 1), (2, [1.0, 0.01], 1), (3, [0.01, 1.0], 1), (4, [-1.0, 0.0], 1), (4, [-1.0, 0.0], 1)]
    got = embeddings.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()
    assert sorted(map(tuple, got)) == [(1, 1, 1, True), (1, 1, 1, True), (2, 1, 1, False), (3, 1, 1, False), (4, 0, 4, True), (4, 0, 4, True)]


def test_recall(spark):
    """Every link of a table with many of them, against all cosines of a label."""
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r.vec_id, np.array(r.embedding, float), r.label) for r in table.where("embedding is not null and label is not null").collect()]
    want = {}
    for label in {r[2] for r in rows}:
        ids, x = [r[0] for r in rows if r[2] == label], np.array([r[1] for r in rows if r[2] == label])
        x /= np.linalg.norm(x, axis=1)[:, None]
        near = x @ x.T >= 0.93
        want |= dict(zip(ids, (near.sum(1) - 1).tolist(), strict=True))
    got = {r.vec_id: r.n_links for r in embeddings.near_duplicates(table).collect()}
    assert all(got[i] <= n for i, n in want.items()) and sum(got.values()) >= 0.999 * sum(want.values())


def test_large_bucket_tiles(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "TILE", 16)
    rng = np.random.default_rng(2)
    rows = [(i, (np.ones(8) + rng.normal(0, 0.02, 8)).tolist(), 1) for i in range(150)]
    got = embeddings.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()
    assert {(r.n_links, r.component_id, r.kept) for r in got} == {(149, 0, True), (149, 0, False)}


@pytest.mark.parametrize("scale", [256.0, 1e9, 1e17])
def test_top_k(spark, scale):
    from pyspark.sql import functions as F

    rows, df = vectors(spark)
    fine = sorted({(i, tuple(math.floor(float(np.float32(x)) * scale) for x in v)) for i, v, *_ in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)})
    want = []
    for q, a in fine:
        if q % 10 == 0:
            scored = sorted((-max(-(2**63) + 1, min(2**63 - 1, sum(x * y for x, y in zip(a, b, strict=True)))), i) for i, b in fine if i != q and len(a) == len(b))
            want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:5])]
    got = [tuple(r) for r in topk.exact_top_k(df, F.col("vec_id") % 10 == 0, 5, scale).collect()]
    assert sorted(got) == sorted(want)
    assert topk.exact_top_k(df.limit(0), F.lit(True)).count() == 0


def test_license_scan(spark, make_docs):
    known = licenses.known_table(spark)
    mit = "MIT Licence\n\nCopyright (c) 2020 Somebody\n(c) 2021 Else\n" + licenses.MIT.replace('"', "“")
    texts = [mit, "x\nRELEASED under the MIT License!\nreleased under the mit licence", "", None, "Copyright 2020 A", "All rights reserved.\r\nAll rights reserved.", "text"]
    got = {r.doc_id: (r.license_id, r.n_license_lines, r.line_licenses) for r in licenses.scan(make_docs(texts), known).collect()}
    assert got == {0: ("MIT", 0, ""), 1: (None, 2, "MIT"), 2: (None, 0, ""), 3: (None, 0, ""), 4: (None, 0, ""), 5: (None, 2, "LicenseRef-all-rights-reserved"), 6: (None, 0, "")}
    again = licenses.scan(make_docs([texts[1], texts[1]], [1, 1]), known).collect()
    assert [r.n_license_lines for r in again] == [2, 2]
    assert licenses.scan(make_docs([]), known).count() == 0


def test_more_licences(spark, make_docs):
    """Short licences and GNU notices in one paragraph and in narrow lines, with notices; whole texts of a Debian system's folder."""
    import textwrap
    from pathlib import Path

    short = {"Zlib": licenses.ZLIB, "Unlicense": licenses.UNLICENSE.format(address="https://unlicense.org"), "BSL-1.0": licenses.BOOST, "AGPL-3.0-or-later": licenses.GNU_NOTICE.format(name="Affero", version=3, address="https://www.gnu.org/licenses/"), "GPL-2.0-or-later": licenses.GNU_NOTICE.format(name="", version=2, address="http://www.gnu.org/licenses/")}
    folder = Path("/usr/share/common-licenses")
    names = {"Artistic": "Artistic-1.0-Perl", "BSD": "BSD-3-Clause", "GFDL-1.2": "GFDL-1.2-only", "GFDL-1.3": "GFDL-1.3-only", "GPL-1": "GPL-1.0-only", "LGPL-2": "LGPL-2.0-only", "MPL-1.1": "MPL-1.1", "GPL-3": "GPL-3.0-only", "Apache-2.0": "Apache-2.0"}
    texts = [(n, form) for n, t in short.items() for form in (" ".join(t.split()), "Copyright (c) 2001 A. Body\n\n" + "\n".join(textwrap.wrap(" ".join(t.split()), 80)))]
    texts += [(spdx, (folder / file).read_text()) for file, spdx in names.items() if (folder / file).exists()]
    got = {r.doc_id: r.license_id for r in licenses.scan(make_docs([t for _, t in texts]), licenses.known_table(spark)).collect()}
    assert [got[i] for i in range(len(texts))] == [n for n, _ in texts]


def test_licenses_in_any_wrapping(spark, make_docs):
    import textwrap

    mit = " ".join(licenses.MIT.split())
    texts = ["MIT License\n\nCopyright (c) 2022 A\n\n" + "\n".join(textwrap.wrap(mit, n)) for n in (40, 72, 78, 79, 80, 100, 10**6)]
    texts += ["Copyright The B Authors. All rights reserved.\n" + "\n".join(textwrap.wrap(licenses.BSD_3, n)) for n in (60, 75, 80)]
    got = [r.license_id for r in sorted(licenses.scan(make_docs(texts), licenses.known_table(spark)).collect(), key=lambda r: r.doc_id)]
    assert got == ["MIT"] * 7 + ["BSD-3-Clause"] * 3
    kept = lambda line: bool(licenses.canonical_lines(line)[0])
    assert all(map(kept, ("COPYRIGHT HOLDERS BE LIABLE", "(c) You must retain", "copyright notice that is", "copyrighted by")))
    assert not any(map(kept, ("Copyright 2020 A", "Copyright (C) A", "  © A", "(c) 2021 A", "Copyright A Inc.", "Copyright: A")))
    assert {"Apache-2.0", "GPL-2.0-only", "GPL-3.0-only", "MPL-2.0"} <= {name for name, _ in licenses.LONG_TEXTS}


def held_out(spark, scored, label):
    rows = scored.join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").where("held_out").select("score", label).collect()
    return np.array([r.score for r in rows]), np.array([r[label] for r in rows])


@pytest.mark.parametrize("scores, label", [(quality.quality_scores, "quality"), (toxicity.toxicity_scores, "toxic")])
def test_classifiers(spark, make_docs, texts, scores, label):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    scored = scores(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), labels)
    rows = scored.join(labels, "doc_id").where("held_out").select("score", label, "predicted").collect()
    right = np.mean([r.predicted == r[label] for r in rows])
    assert right >= (0.95 if label == "quality" else 0.9)  # there are 37 toxic documents to learn from
    # awkward rows, clashing columns, no usable labels
    none = scores(make_docs(texts, [None, *range(1, len(texts))]), labels.limit(0)).collect()
    assert len(none) == len(texts) and all(abs(r.score - 0.5) < 0.01 for r in none)
    assert scores(make_docs([]), labels).count() == 0
    twice = scores(make_docs(["a b", "a b", None, ""], [1, 1, 2, 3]), labels.union(labels)).collect()
    assert len(twice) == 4 and all(0 <= r.score <= 1 for r in twice)


def test_isotonic_is_monotone():
    rng = random.Random(4)
    total = np.array([rng.randint(0, 5) for _ in range(200)], float)
    hits = np.array([rng.uniform(0, t) for t in total])
    out = learning.isotonic(hits, total)
    assert (np.diff(out) >= -1e-12).all() and out.min() >= 0 and out.max() <= 1


def test_quality_by_brute_force(spark, texts):
    """Statistics by plain Python; features, normal equations and pooled blocks by single-machine algebra."""
    from evispark.llm.textkit import text_bytes
    import pyarrow as pa

    some = [t for t in texts if t] + ["A. B, C! x", "ÄÖ|| 12 #### aa aa aa"]
    got = quality.statistics(*text_bytes(pa.array(some)))
    for row, t in zip(got, some, strict=True):
        data, words = t.encode(), [w for w in t.encode().split()]
        for i, own in enumerate(quality.CLASSES):
            assert row[i] == pytest.approx(sum(b in own for b in data) / len(data))
        if words:
            assert row[quality.N_CLASSES] == pytest.approx(math.log1p(len(words)) / 10)
            assert row[quality.N_CLASSES + 1] == pytest.approx(np.mean([len(w) for w in words]) / 10)
            assert row[quality.N_CLASSES + 2] == pytest.approx(np.mean([a == b for a, b in zip([None, *words], words)]))  # noqa: B905
            assert row[quality.N_CLASSES + 3] == pytest.approx(1 - len(set(words)) / len(words))

    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    stats = quality.statistic_rows(docs)
    from pyspark.sql import functions as F

    apart = F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(quality.CALIBRATION_PART)) == 0
    rows = stats.join(labels, "doc_id").withColumn("apart", apart).withColumn("held", learning.fold(5) == 0).collect()
    part = lambda flag: [r for r in rows if not r.held and r["apart"] == flag]
    x, y = np.array([r.stats for r in part(False)]), np.array([r.quality for r in part(False)], float)
    model = quality.FourierRidge()
    mean, scale = x.mean(0), x.std(0) + 1e-6
    expand = lambda v: np.array([[math.sqrt(2 / quality.FEATURES) * math.cos(c) for c in np.clip((u - mean) / scale, -5, 5) / math.sqrt(quality.N_STATS) @ model.normal + model.phase] + [1.0] for u in v])
    z = expand(x)
    penalty = np.diag([quality.RIDGE * len(x)] * quality.FEATURES + [quality.RIDGE * len(x) * 1e-9])
    weights = np.linalg.solve(z.T @ z + penalty, z.T @ y)
    bins = lambda v: np.clip((v + 0.5) / 2 * learning.BINS, 0, learning.BINS - 1)
    hits, total = np.zeros(learning.BINS), np.zeros(learning.BINS)
    for r, value in zip(part(True), expand(np.array([r.stats for r in part(True)])) @ weights, strict=True):
        hits[int(bins(value))] += r.quality
        total[int(bins(value))] += 1
    rates = pooled(hits, total)
    raw = expand(np.array([r.stats for r in rows])) @ weights
    want = {r.doc_id: (1 - 1e-3) * np.interp(bins(v), np.arange(learning.BINS), rates) + 1e-3 * bins(v) / learning.BINS for r, v in zip(rows, raw, strict=True)}
    scored = {r.doc_id: r.score for r in quality.quality_scores(docs, labels).collect()}
    assert np.allclose([scored[d] for d in want], list(want.values()), atol=0.02) and np.corrcoef([scored[d] for d in want], list(want.values()))[0, 1] > 0.9999


def pooled(hits, total):
    """Isotonic rates as the largest least mean over all intervals around a bin (the min-max formula), linear in between."""
    at = np.flatnonzero(total)
    h, t = np.concatenate([[0], np.cumsum(hits[at])]), np.concatenate([[0], np.cumsum(total[at])])
    n = len(at)
    value = [max(min((h[b + 1] - h[a]) / (t[b + 1] - t[a]) for b in range(i, n)) for a in range(i + 1)) for i in range(n)]
    return np.interp(np.arange(len(total)), at, value)


def test_kneser_ney_by_brute_force(spark, make_docs):
    """Every word's ratio from counts in plain dictionaries."""
    from collections import Counter

    texts = ["you idiot clown", "idiot idiots, go", "nice day now", "a nice clown day", "unlabelled words here", "day"]
    label = {0: 1.0, 1: 1.0, 2: 0.0, 3: 0.0}
    found = toxicity.count_grams(toxicity.count_words(make_docs(texts), label)).toArrow()
    arrays = {c: found[c].to_numpy() for c in found.column_names}
    model = toxicity.KneserNeyRatio(**{c: a.view(np.uint64) if c in ("key", "context", "suffix") else a for c, a in arrays.items()})
    words = [set(w.strip(toxicity.TRIM) for w in t.lower().split()) for t in texts]
    weight = {w: [sum(w in ws and label.get(i) == v for i, ws in enumerate(words)) for v in (1.0, 0.0)] for w in set().union(*words)}
    types, seen, used = Counter(), [Counter(), Counter()], set()
    cells = lambda w: ["<", *w, ">"]
    for w, c in weight.items():
        x = cells(w)
        for e in range(1, len(x)):
            for k in range(min(e, toxicity.ORDER - 1) + 1):
                g = tuple(x[e - k : e + 1])
                types[g] += 1
                if sum(c):
                    used.add(g[:-1])
                if k == min(e, toxicity.ORDER - 1):
                    for s, n in zip(seen, c, strict=True):
                        s[g] += n
    total, kinds = Counter(), Counter()
    for g, n in types.items():
        total[g[:-1]] += n
        kinds[g[:-1]] += 1
    d = toxicity.DISCOUNT

    def shared(g):
        lower = 1 / (total[()] + 200) if len(g) == 1 else shared(g[1:])
        return max(types[g] - d, 0) / total[g[:-1]] + d * kinds[g[:-1]] / total[g[:-1]] * lower

    def log_p(s, g, known):
        own = [n for h, n in s.items() if h[:-1] == g[:-1]]
        n, t = sum(own), sum(x > 0 for x in own)
        free = d * t / n if n else 1.0
        return math.log(max(s[g] - d, 0) / max(n, 1) + free * (shared(g[1:]) if len(g) > 1 else 1 / (total[()] + 200))) if known else math.log(free)

    def ratio(w):
        x, out = cells(w), 0.0
        for e in range(1, len(x)):
            g = tuple(x[e - min(e, toxicity.ORDER - 1) : e + 1])
            if seen[0][g] + seen[1][g] or g[:-1] in used:
                known = seen[0][g] + seen[1][g] > 0
                out += log_p(seen[0], g, known) - log_p(seen[1], g, known)
        return out

    tried = [*weight, "clowns", "idiotic", "dayly", "zzz", "x"]
    assert np.allclose(model.words(tried), [ratio(w) for w in tried], atol=1e-4)
    assert ratio("idiot") > 1 > -0.5 > ratio("nice")


def test_pipeline(spark):
    """Every stage against what its operator says about the stage's own input, the last three against plain Python."""
    from test_text_operators import shingles, words

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF).cache()
        before, after = {r.doc_id: r.text for r in docs.collect()}, out.collect()
        if n < 4:
            assert out.columns == columns
            assert {r.doc_id for r in after} <= set(before)
        if n in (0, 1):
            scored = (toxicity.toxicity_scores if n == 0 else quality.quality_scores)(docs, spark.read.parquet(f"{SF}/labels.parquet"))
            assert {r.doc_id for r in after} == {r.doc_id for r in scored.where(f"predicted = {n}").collect()}
            assert len(after) >= 0.5 * len(before)
        if n == 2:
            up = {d: d for d in before}
            sets = {d: shingles(t) for d, t in before.items()}
            for d in sorted(before):
                for e in sorted(before):
                    both = len(sets[d] & sets[e])
                    if e < d and both and 100 * both >= 80 * len(sets[d] | sets[e]):
                        low, high = sorted((up[d], up[e]))
                        up = {k: low if v == high else v for k, v in up.items()}
            assert {r.doc_id: r.text for r in after} == {d: t for d, t in before.items() if up[d] == d}
        if n == 3:
            seen, want = set(), {}
            for d in sorted(before):
                w, gone = words(before[d]), set()
                for i in range(len(w) - 49):
                    if (x := tuple(w[i : i + 50])) in seen:
                        gone.update(range(i, i + 50))
                    seen.add(x)
                want[d] = [x for i, x in enumerate(w) if i not in gone]
            assert {r.doc_id: words(r.text) for r in after} == want and all(r.n_chars == len(r.text) for r in after if len(want[r.doc_id]) != len(words(before[r.doc_id])))
        if n == 4:
            assert {r.doc_id for r in after} == set(before)
            full = {}
            for r in after:
                full.setdefault(r.sequence_id, []).append((r.offset, r.length))
            assert all(sum(n for _, n in own) <= 2048 and [a for a, _ in sorted(own)] == [sum(n for _, n in sorted(own)[:i]) for i in range(len(own))] for own in full.values())
        docs = out


def test_pipeline_ids_repeat(spark, monkeypatch):
    """Rows with null and repeated ids: each is judged by its own text and keeps it."""
    rng = random.Random(9)
    long = [" ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(200)) for _ in range(4)]
    words = [x.split() for x in long]
    table = lambda rows: spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    key = lambda out: sorted(((r.doc_id, r.text) for r in out.collect()), key=repr)

    # the near copies of text 0 are one component, also with null and equal ids; so are equal rows
    near = " ".join([*words[0][:-1], "z"])
    rows = [(None, long[0]), (7, long[0]), (7, near), (7, long[0]), (7, long[1]), (None, long[2]), (None, long[2]), (8, None), (8, None), (None, "")]
    got = key(corpus_pipeline.near_duplicate_stage(spark, table(rows), SF))
    assert len(got) == 6 and [x for x in got if x[1] in (long[0], near)][0][0] == 7
    assert [x for x in got if x[1] not in (long[0], near)] == sorted([(7, long[1]), (None, long[2]), (8, None), (8, None), (None, "")], key=repr)

    # later copies of one passage in rows of one id; an uncut row of this id keeps its text
    passage = words[0][:80]
    rows = [(1, long[0])] + [(i, " ".join([*words[n][:60], *passage])) for i, n in ((None, 1), (None, 2), (5, 1), (5, 3))] + [(5, "x y"), (None, None)]
    seen = list(corpus_pipeline.repeated_passage_stage(spark, table(rows), SF).collect())
    assert sorted(map(repr, (r.doc_id for r in seen))) == sorted(repr(i) for i, _ in rows)
    kept = {(r.doc_id, r.text) for r in seen}
    assert (5, "x y") in kept and (None, None) in kept and len(kept) == len(rows)

    # a bad row goes although another row of its id passes
    rows = [(3, "good"), (3, "bad"), (None, "good"), (None, "bad"), (4, None), (4, "bad")]
    want = sorted([x for x in rows if x[1] != "bad"], key=repr)
    for module, name, stage, flag in ((toxicity, "toxicity_scores", corpus_pipeline.toxicity_stage, 1), (quality, "quality_scores", corpus_pipeline.quality_stage, 0)):
        true = getattr(module, name)

        def judged(docs, labels, key=False, true=true, flag=flag):
            from pyspark.sql import functions as F

            scored = true(docs, labels, key=key)
            bad = docs.where("text = 'bad'").select(corpus_pipeline.shared.row_key("doc_id", "text").alias("k")).distinct().withColumn("bad", F.lit(True))
            return scored.join(bad, "k", "left").withColumn("predicted", F.when(F.col("bad"), flag).otherwise(1 - flag))

        monkeypatch.setattr(module, name, judged)
        assert key(stage(spark, table(rows), SF)) == want
