"""Operators over the whole corpus: 4, 5, 7, 8, 9, components, and the pipeline."""

import hashlib
import random
import zlib

import duckdb
import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from isoforge.llm import exact_dedup, jaccard_join, packing, registry, source_mixing, substring_dedup, token_counts, toxicity
from isoforge.llm.components import components
from tests.llm.conftest import CLASHES, ODD
from tests.llm.helpers import exact_groups, near_components, substrings


def frame(spark, docs):
    return spark.createDataFrame(docs, "doc_id long, text string")


def edited(n, seed, length=120):
    rng = random.Random(seed)
    bases = ["".join(rng.choice("abcdefgh") + " " for _ in range(length)) for _ in range(4)]
    docs = []
    for i in range(n):
        w = rng.choice(bases).split()
        for _ in range(rng.randrange(0, 5)):
            w[rng.randrange(len(w))] = rng.choice("abcdefghXYZ")
        docs.append((i, "\n".join(w[: rng.choice([length, length - 1, length - 9, 4])])))
    return docs + [(1000, None), (1001, "  "), (1002, "a b"), (1003, "A B"), (3, "a b"), docs[0]]


# 9: exact dedup


def test_exact(spark, sf_dir, small):
    got = exact_dedup.op9_exact_dedup(spark, sf_dir).collect()
    assert sorted((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == exact_groups(small)
    assert all(r.kept == (r.doc_id == r.keep_id) for r in got)


@pytest.mark.parametrize("weak", [None, lambda t: F.lit("same"), lambda t: F.substring(F.md5(t), 1, 1)])
def test_exact_with_colliding_hashes(odd, weak):
    kw = {"hash128": weak} if weak else {}
    got = exact_dedup.exact_dedup(odd, keep="smallest", **kw).collect()
    assert sorted((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == exact_groups(ODD, largest=False)
    kept = sorted(r.doc_id for r in got if r.kept)
    assert kept == [1, 3, 4, 6, 7, 8]


def test_exact_repeats_and_nulls(spark, nothing):
    docs = [(1, "a"), (1, "a"), (None, "b"), (None, "b"), (2, None), (None, "")]
    got = exact_dedup.exact_dedup(frame(spark, docs), keep="largest").collect()
    assert len(got) == 6 and sum(r.kept for r in got) == 3
    assert exact_dedup.exact_dedup(nothing).count() == 0
    left = exact_dedup.drop_copies(frame(spark, docs), keep="largest")
    assert left.count() == 3 and left.columns == ["doc_id", "text"]


# 8: substrings


def test_substrings(spark, sf_dir, small):
    got = sorted((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup.op8_substring_dedup(spark, sf_dir).collect())
    assert got == substrings(small, 50)
    assert any(r[2] for r in got)


@pytest.mark.parametrize("limit", [substring_dedup.MAX_GROUP, 3, 0])
def test_substrings_random(spark, limit):
    rng = random.Random(2)
    docs = [(rng.randrange(40), "".join(rng.choice(["a ", "b ", "c\n", "d\t"]) for _ in range(rng.randrange(0, 60)))) for _ in range(60)]
    docs += [(5, None), (6, ""), *docs[:8]]
    got = substring_dedup.substring_dedup(frame(spark, docs), window=6, gram=3, max_group=limit).collect()
    assert sorted((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got) == substrings(docs, 6)


def test_least_documents_in_runs():
    strings = [b"a b c d e", b"x b c d y", b"a b c d e f"]
    got = substring_dedup.least_documents(strings, np.array([5, 3, 4]), 3)
    assert got == [[(0, 1, 4), (1, 2, 3), (2, 3, 4)], [(0, 3, 3)], [(0, 1, 4), (1, 2, 3), (2, 4, 4)]]


def test_substrings_odd(odd, nothing, spark):
    got = substring_dedup.substring_dedup(odd, window=3, gram=2).collect()
    assert sorted((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got) == substrings(ODD, 3)
    assert substring_dedup.substring_dedup(nothing).count() == 0
    null = substring_dedup.substring_dedup(frame(spark, [(None, "a b c d"), (9, "a b c d")]), window=3, gram=2).collect()
    assert {(r.doc_id, r.n_removed) for r in null} == {(None, 4), (9, 0)}


# 5: near copies


@pytest.mark.parametrize("steer", [{}, {"LOOKED": 9}, {"FEW": 2, "LOOKED": 2}, {"SHARED": 1}, {"SHARED": 3, "PAIRED": 0}, {"SHARED": 40}])
@pytest.mark.parametrize("length", [12, 60, 160])
def test_candidates_hold_every_link_whatever_steers_them(monkeypatch, steer, length):
    for name, value in steer.items():
        monkeypatch.setattr(jaccard_join, name, value)
    known = jaccard_join.WordHashes()
    sets = {}
    for _, t in edited(160, length, length):
        s = jaccard_join.text_set((t or "").encode(), known)
        if len(s):
            sets[jaccard_join.digests(s)[0]] = s
    token, node, n, p = [], [], [], []
    for k, s in sets.items():
        first = s[: len(s) - (4 * len(s) + 4) // 5 + jaccard_join.SHARED]
        token += first.tolist()
        node += [k] * len(first)
        n += [len(s)] * len(first)
        p += range(len(first))
    got = jaccard_join.candidates(np.array(token, np.uint64), np.array(node), np.array(n), np.array(p))
    root = {k: k for k in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, na, b, nb, star, times in zip(*(x.tolist() for x in got), strict=True):
        if star or times >= min(jaccard_join.SHARED, (4 * (na + nb) + 8) // 9):
            root[find(a)] = find(b)
    links = 0
    for a, x in sets.items():
        for b, y in sets.items():
            o = len(np.intersect1d(x, y))
            if a < b and 100 * o >= 80 * (len(x) + len(y) - o):
                links += 1
                assert find(a) == find(b)
    assert links > 3


@pytest.mark.parametrize("limit", [1, 60, 10**6])
def test_buckets_change_no_result(spark, monkeypatch, limit):
    monkeypatch.setattr(jaccard_join, "BUCKET_ENTRIES", limit)
    docs = edited(150, 13, 40)
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.jaccard_join(frame(spark, docs)).collect())
    assert got == near_components(docs)


@pytest.mark.parametrize("limits", [{}, {"max_members": 3}, {"max_shingles": 300}])
def test_jaccard_matches_brute_force(spark, limits):
    docs = edited(260, 11)
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.jaccard_join(frame(spark, docs), **limits).collect())
    assert got == near_components(docs)


def test_jaccard_on_table(spark, sf_dir, small):
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.op5_jaccard_join(spark, sf_dir).collect())
    assert got == near_components(small)


def test_link_sets():
    rng = np.random.default_rng(3)
    draw = lambda n: rng.integers(0, 1 << 62, n, dtype=np.uint64)
    for _ in range(25):
        bases = [np.unique(draw(rng.integers(5, 80))) for _ in range(3)]
        sets = []
        for _ in range(rng.integers(2, 50)):
            s = bases[rng.integers(3)]
            s = np.delete(s, rng.integers(0, len(s), int(rng.integers(0, max(1, len(s) // 4)))))
            sets.append(np.unique(np.concatenate([s, draw(int(rng.integers(0, 6)))])))
        sets = [s for s in sets if len(s)]
        got, m = jaccard_join.link_sets(sets), len(sets)
        label = list(range(m))
        for i in range(m):
            for j in range(i):
                o = len(np.intersect1d(sets[i], sets[j]))
                if 100 * o >= 80 * (len(sets[i]) + len(sets[j]) - o):
                    old, new = label[i], label[j]
                    label = [new if x == old else x for x in label]
        assert len(set(zip(label, got.tolist(), strict=True))) == len(set(label)) == len(set(got.tolist()))


def test_jaccard_odd(spark, odd, nothing):
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.jaccard_join(odd).collect())
    assert got == near_components(ODD)
    assert jaccard_join.jaccard_join(nothing).count() == 0
    rows = frame(spark, [(None, "a b c d e f"), (9, "a b c d e f"), (None, "z"), (None, "z"), (None, None), (None, "q r s t u v")])
    got = jaccard_join.jaccard_join(rows).collect()
    # a copy of a document with an id belongs to it; other rows without an id stay apart
    assert sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0) for r in got) == [(0, 0, 0), (0, 1, 0), (0, 1, 0), (0, 2, 0), (0, 2, 9), (9, 2, 9)]
    assert sorted((r.doc_id or 0, r.text or "") for r in jaccard_join.drop_near_copies(rows).collect()) == [(0, ""), (0, "q r s t u v"), (0, "z"), (0, "z"), (9, "a b c d e f")]


@pytest.mark.parametrize("block", [1, 7, 2000])
def test_star_pairs_match_brute_force(spark, block):
    rng = random.Random(block)
    stars = [(100 * c, 100 * c + i, rng.randrange(20, 30), rng.randrange(10, 21), rng.randrange(5), rng.randrange(5)) for c in range(3) for i in range(1, 40)]
    got = jaccard_join.star_pairs(spark.createDataFrame(stars, "a long, b long, nb int, o int, r long, rc long"), block).collect()
    want = set()
    for c, x, nx, ox, rx, rc in stars:
        for c2, z, nz, oz, rz, _ in stars:
            if c == c2 and rx != rc and rx != rz and 5 * min(nx, nz) >= 4 * max(nx, nz) and 9 * (min(ox, oz) + min(nx - ox, nz - oz)) >= 4 * (nx + nz):
                want.add((min((x, nx), (z, nz)), max((x, nx), (z, nz))))
    assert {((r.a, r.na), (r.b, r.nb)) for r in got} == want and len(got) == len(want) > 50


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 150), (150, 120), (7, 7), (200, 300), (300, 200)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, 150: 100, 120: 100, 300: 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# 4: packing


def check_packing(rows, docs, capacity=1024):
    path = token_counts.tokenizer_path("byte_bpe_50k.json")
    ids = {}
    for d, t in docs:
        ids.setdefault(d, np.array([*token_counts.tokenizer(path).encode(t or "", add_special_tokens=False).ids, 2], "<u4"))
    by_doc, by_bin = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_bin.setdefault(r.sequence_id, []).append(r)
    for d, own in by_doc.items():
        copies = sum(x == d for x, _ in docs)
        for r in own:
            assert zlib.crc32(ids[d][r.start : r.start + r.length].tobytes()) == r.ids_crc32
        assert sum(r.length for r in own) == copies * len(ids[d])
        if copies == 1:
            own.sort(key=lambda r: r.piece)
            assert [r.start for r in own] == [sum(x.length for x in own[:i]) for i in range(len(own))]
            assert len(own) == max(1, -(-len(ids[d]) // capacity))
    for own in by_bin.values():
        own.sort(key=lambda r: r.offset)
        assert [r.offset for r in own] == [sum(x.length for x in own[:i]) for i in range(len(own))] and sum(r.length for r in own) <= capacity
    return len(by_bin), sum(r.length for r in rows) / capacity


def test_packing(spark, sf_dir, small):
    bins, least = check_packing(packing.op4_packing(spark, sf_dir).collect(), small)
    assert bins <= 1.02 * least + 2


@pytest.mark.parametrize("fan", [2, 32])
def test_packing_merges_tasks(spark, small, fan):
    path = token_counts.tokenizer_path("byte_bpe_50k.json")
    rows = packing.pack(frame(spark, small).repartition(9), path, fan=fan).collect()
    bins, least = check_packing(rows, small)
    assert bins <= 1.03 * least + 2


def test_packing_odd(odd, nothing):
    path = token_counts.tokenizer_path("byte_bpe_50k.json")
    rows = packing.pack(odd, path).collect()
    check_packing(rows, ODD)
    assert {r.length for r in rows if r.doc_id in (1, 2)} == {1}
    assert packing.pack(nothing, path).count() == 0


def test_long_texts_pack_like_whole_ones(spark, small, monkeypatch):
    path = token_counts.tokenizer_path("byte_bpe_50k.json")
    texts = [t.encode() for _, t in small[:40]] + ["\n".join(t for _, t in small[:9]).encode(), None, b""]
    whole = [x.tolist() for x in packing.encode(texts, path)]
    monkeypatch.setattr(packing, "LONG_CHARS", 500)
    assert [x.tolist() for x in packing.encode(texts, path)] == whole
    t = token_counts.tokenizer(path)
    assert whole == [[*t.encode((x or b"").decode(), add_special_tokens=False).ids, 2] for x in texts]


def plain_best_fit(sizes, capacity):
    """Best-fit decreasing by a look at every bin."""
    bins = []
    for x in sorted(sizes, reverse=True):
        fits = [(left, i) for i, left in enumerate(bins) if left >= x]
        if fits:
            bins[min(fits)[1]] -= x
        else:
            bins.append(capacity - x)
    return len(bins)


@pytest.mark.parametrize("max_group", [packing.MAX_GROUP, 40])
def test_merging_nears_one_global_best_fit(spark, small, max_group):
    """Sequences of 16 tasks packed alone, merged, and of one best-fit over all pieces."""
    path = token_counts.tokenizer_path("byte_bpe_50k.json")
    docs = frame(spark, small * 2).repartition(16)
    rows = packing.pack(docs, path, fan=4, max_group=max_group).collect()
    merged = len({r.sequence_id for r in rows})
    best = plain_best_fit([r.length for r in rows], 1024)
    alone = packing.pieces(docs, path, "doc_id", "text", 1024, 2, packing.SLACK).select("bin").distinct().count()
    print(f"tasks alone {alone}, merged {merged}, one best-fit {best}")
    assert best <= merged <= 1.05 * best and merged < alone


def test_bins_that_never_fit_stay_apart(spark):
    path = token_counts.tokenizer_path("byte_bpe_50k.json")
    rows = packing.pack(frame(spark, [(i, "oak " * 599) for i in range(64)]).repartition(8), path, fan=2, max_group=5).collect()
    assert len({r.sequence_id for r in rows}) == 64


def test_best_fit():
    sizes = np.random.default_rng(1).integers(1, 1025, 3000)
    bins, at, fills = packing.best_fit(sizes)
    assert fills.max() <= 1024 and np.array_equal(np.bincount(bins, sizes), fills) and len(fills) <= 1.02 * sizes.sum() / 1024
    assert len(packing.best_fit(np.zeros(0, np.int64))[2]) == 0


# 7: mixing


@pytest.mark.parametrize("name", list(registry.oracle_sql()))
def test_query_matches_sql(spark, sf_dir, name):
    df = registry.queries()[name](spark, sf_dir)
    c = duckdb.connect()
    c.execute(f"create view documents as select * from '{sf_dir}/documents.parquet'")
    said = c.sql(registry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(said.columns)
    order = [said.columns.index(x) for x in sorted(said.columns)]
    assert sorted(tuple(r[x] for x in sorted(df.columns)) for r in df.collect()) == sorted(tuple(r[i] for i in order) for r in said.fetchall())


def test_raking_meets_targets(spark):
    rows = [(s, lang, t, float(w)) for i, s in enumerate("abcd") for j, lang in enumerate("xy") for k, t in enumerate("pq") for w in [1000 * (i + 1) * (j + 1) + 37 * k]]
    cells = spark.createDataFrame(rows, "source string, lang string, topic string, tokens double")
    got = source_mixing.rake(cells, {"source": 0.0, "lang": 0.0, "topic": 0.0}, keep_fraction=0.2, sweeps=30).collect()
    for d in ("source", "lang", "topic"):
        sums = {}
        for r in got:
            sums[r[d]] = sums.get(r[d], 0) + r.tokens * r.keep_probability
        assert max(sums.values()) == pytest.approx(min(sums.values()), rel=1e-3)
    assert sum(r.tokens * r.keep_probability for r in got) == pytest.approx(0.2 * sum(r.tokens for r in got), rel=1e-6)


def bounded_raking(cells, targets, budget, sweeps):
    """Plain version: cells (values..., tokens); targets: for each place of the values, value -> tokens."""
    m = [budget * c[-1] / sum(c[-1] for c in cells) for c in cells]
    for _ in range(sweeps):
        for k, target in enumerate(targets):
            sums = {}
            for c, x in zip(cells, m, strict=True):
                sums[c[k]] = sums.get(c[k], 0.0) + x
            m = [min(c[-1], x * target[c[k]] / sums[c[k]]) if sums[c[k]] else 0.0 for c, x in zip(cells, m, strict=True)]
    return m


def test_mixing_to_given_weights(spark):
    rng = random.Random(3)
    docs = [(i, "x" * rng.randrange(40, 400), rng.choice("aaab"), rng.choice(["en", "en", "de"]), rng.choice("pqr")) for i in range(900)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string, lang string, kind string")
    weights = {"source": {"a": 1, "b": 1}, "lang": {"en": 2, "de": 1}, "topic": {"p": 5, "q": 1}}
    got = source_mixing.mix_sources(df, topic="kind", weights=weights, keep_fraction=0.3, sweeps=40).collect()
    cells = {}
    for r in got:
        assert r.tokens == -(-len(docs[r.doc_id][1]) // 4) and r.topic == docs[r.doc_id][4]
        cells[r.source, r.lang, r.topic] = cells.get((r.source, r.lang, r.topic), 0) + r.tokens
    budget = 0.3 * sum(cells.values())
    have = lambda k, v: sum(t for c, t in cells.items() if c[k] == v)
    share = lambda w: {v: budget * x / sum(w.values()) for v, x in w.items()}
    targets = [share(weights["source"]), share(weights["lang"]), {**share(weights["topic"]), "r": 0.0}]
    for k, t in enumerate(targets):
        over = {v for v in t if t[v] > have(k, v)}
        left = budget - sum(have(k, v) for v in over)
        free = sum(t[v] for v in t if v not in over)
        targets[k] = {v: have(k, v) if v in over else min(have(k, v), t[v] * left / free) for v in t}
    keys = list(cells)
    want = dict(zip(keys, bounded_raking([(*c, cells[c]) for c in keys], targets, budget, 40), strict=True))
    for r in got:
        assert r.keep_probability == pytest.approx(want[r.source, r.lang, r.topic] / cells[r.source, r.lang, r.topic], abs=1e-9)
    report = source_mixing.reached(df, topic="kind", weights=weights, keep_fraction=0.3, sweeps=40).collect()
    assert len(report) == 7 and all(abs(r.reached - (r.allowed + r.residual)) < 1e-12 for r in report)
    assert {r.value: round(r.asked, 4) for r in report if r.dim == "topic"} == {"p": 0.8333, "q": 0.1667, "r": 0.0}


def test_bounded_targets_are_met_and_reported(spark):
    sf = "/root/testdata/sf0.01"
    report = source_mixing.reached(spark.read.parquet(f"{sf}/documents.parquet")).collect()
    for d in source_mixing.DIMS:
        assert sum(r.reached for r in report if r.dim == d) == pytest.approx(1, abs=0.01)
    assert max(abs(r.residual) for r in report) < 0.01


def test_mixing_odd(odd, nothing):
    got = source_mixing.mix_sources(odd).collect()
    assert len(got) == len(ODD) and all(0 <= r.keep_probability <= 1 for r in got)
    assert {r.source for r in got} == {source_mixing.NONE} and next(r for r in got if r.doc_id == 1).tokens == 0
    assert source_mixing.mix_sources(nothing).count() == 0
    back = source_mixing.sample_documents(odd)
    assert back.columns == odd.columns and back.count() == sum(r.sampled for r in got)


def test_mixing_is_native(spark, sf_dir):
    plan = source_mixing.op7_source_mixing(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))


# pipeline


def plain_mixing(docs):
    """Ids that are sampled: (doc_id, text, source, lang) by the production settings, in plain Python."""
    m = source_mixing

    def topic(t):
        if t is None:
            return m.NONE
        return next((name for mark, name in ((" | ", "table"), ("!! ", "shouting"), ("%%% ", "symbols"), ("&&& ", "symbols"), ("\n", "prose")) if mark in t), "snippet")

    cells, cell_of = {}, []
    for _, t, source, lang in docs:
        c = (source or m.NONE, lang or m.NONE, topic(t))
        cell_of.append(c)
        cells[c] = cells.get(c, 0) + -(-len((t or "").encode()) // m.TOKEN_BYTES)
    everything = sum(cells.values())
    budget = m.KEEP_FRACTION * everything
    targets = []
    for k, d in enumerate(m.DIMS):
        have = {}
        for c, n in cells.items():
            have[c[k]] = have.get(c[k], 0) + n
        weight = {v: (n / everything) ** m.TEMPER[d] for v, n in have.items()}
        want = {v: budget * w / sum(weight.values()) for v, w in weight.items()}
        scale = 1.0
        for _ in range(m.CAP_ROUNDS):
            full = {v for v in want if want[v] * scale >= have[v]}
            free = sum(want[v] for v in want if v not in full)
            scale = max(scale, (budget - sum(have[v] for v in full)) / free) if free else scale
        targets.append({v: min(have[v], want[v] * scale) for v in want})
    keys = list(cells)
    kept = dict(zip(keys, bounded_raking([(*c, cells[c]) for c in keys], targets, budget, m.SWEEPS), strict=True))
    draw = lambda d: int(hashlib.md5(str(d).encode()).hexdigest()[:13], 16) / 2**52
    return {d for (d, *_), c in zip(docs, cell_of, strict=True) if cells[c] and draw(d) < kept[c] / cells[c]}


def test_pipeline(spark, small):
    """Every stage against a plain version, on what the one before kept."""
    import corpus_pipeline

    sf = "/root/testdata/sf0.01"
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "exact_dedup", "jaccard_join", "source_mixing", "packing"]
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    before = [(r.doc_id, r.text, r.source, r.lang) for r in docs.collect()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf).cache()
        assert docs.columns == columns
        rows = [(r.doc_id, r.text, r.source, r.lang) for r in docs.collect()]
        got = sorted(r[0] for r in rows)
        if name == "toxicity":
            labels = {r["doc_id"]: r["toxic"] for r in pq.read_table(f"{sf}/labels.parquet").to_pylist() if r["toxic"] is not None}
            text = {d: t for d, t, *_ in before}
            learned = [d for d in labels if zlib.crc32(str(d).encode()) % 4 != 2 and text.get(d) is not None]
            order = {r.doc_id: (r.k, str(r.doc_id)) for r in spark.createDataFrame([(d,) for d in learned], "doc_id long").select("doc_id", F.xxhash64(F.col("doc_id"), F.lit(7)).alias("k")).collect()}
            model = toxicity.fit([(text[d].encode(), labels[d]) for d in sorted(learned, key=order.get)], sum(labels[d] > 0 for d in labels if zlib.crc32(str(d).encode()) % 4 != 2) / sum(zlib.crc32(str(d).encode()) % 4 != 2 for d in labels))
            want = [d for d, t, *_ in before if toxicity.score_texts([(t or "").encode()], model)[0] < 0.3]
        if name == "exact_dedup":
            want = [d for d, keep, *_ in exact_groups([r[:2] for r in before]) if d == keep]
        if name == "jaccard_join":
            want = [d for d, _, c in near_components([r[:2] for r in before]) if d == c]
        if name == "source_mixing":
            want = plain_mixing(before)
        assert got == sorted(want), name
        assert set(rows) <= set(before)  # rows come through as they are
        before = rows
        counts.append(len(rows))
    assert counts == sorted(counts, reverse=True) and counts[-1] > 0.5 * counts[0]
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf).collect()
    bins, least = check_packing(packed, [r[:2] for r in before])
    assert bins <= 1.02 * least + 2 and {r.doc_id for r in packed} == {r[0] for r in before}
    whole = corpus_pipeline.run(spark, sf).collect()
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in whole) == sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed)
    assert "pipeline" in registry.queries()


def test_every_operator_is_registered():
    numbers = sorted(int(n[2:].split("_")[0]) for n in registry.queries() if n.startswith("op"))
    assert numbers == list(range(1, 11))
    assert set(registry.oracle_sql()) <= set(registry.queries())


@pytest.mark.parametrize("number", range(5))
def test_stages_on_odd_tables(spark, odd, nothing, number):
    import corpus_pipeline

    name, stage = corpus_pipeline.STAGES[number]
    sf = "/root/testdata/sf0.001"
    got = stage(spark, odd, sf)
    rows = got.collect()
    ids = {r.doc_id for r in rows}
    if number < 4:
        assert got.columns == odd.columns
        assert all(r[c] == c for r in rows for c in CLASHES)  # no column of the caller's is written over
    if name == "toxicity":
        assert len(rows) == len(ODD)  # nothing here is toxic
    if name == "exact_dedup":
        assert sorted(r.doc_id for r in rows) == [3, 2, 5, 6, 7, 8] or sorted(r.doc_id for r in rows) == [2, 3, 5, 6, 7, 8]
    if name == "jaccard_join":
        assert ids == {1, 2, 3, 4, 6, 7, 8}
    if name == "packing":
        assert ids == {d for d, _ in ODD}
    assert stage(spark, nothing, sf).count() == 0


def test_groups_join_spreads_hot_keys(spark):
    from isoforge.llm.skew import join_groups

    rows = spark.range(3000).select(F.col("id"), F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"))
    groups = rows.groupBy("k").agg(F.count(F.lit(1)).alias("size"), F.min("id").alias("least"))
    got = {r.id: (r.size, r.least) for r in join_groups(rows, groups, ["k"], "size").collect()}
    assert got == {i: (1000, 0) if i % 3 == 0 else (1, i) for i in range(3000)}
    assert join_groups(rows.limit(0), groups.limit(0), ["k"], "size").count() == 0
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        plan = join_groups(rows, groups, ["k"], "size")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # the rows are dealt out by the key and the number that spreads hot ones
    assert any("hashpartitioning(k#" in line and "__spread#" in line for line in plan.split("\n"))
