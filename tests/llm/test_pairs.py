"""Similarity joins and passage removal against brute force."""

import hashlib
import random

import numpy as np
import pytest
from llm.helpers import WORD, Groups, edge_docs, given, no_docs, prose, thue_morse

from callgrid.llm.graph import components
from callgrid.llm.grid_order_join import similar_vectors
from callgrid.llm.jaccard_join import Scheme, jaccard_components, linked_pairs, local_roots, spanning_links
from callgrid.llm.suffix_dedup import equal_groups, remove_repeats
from callgrid.llm.tables import KeyFilter

LOW = {i: i + 32 for i in range(65, 91)}


def shingles(text, k):
    w = WORD.findall(text.translate(LOW))
    return frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def jaccard_truth(rows, k, percent):
    sets = [shingles(t, k) for _, t in rows]
    groups = Groups()
    for i, a in enumerate(sets):
        groups.find(i)
        for j in range(i):
            both = len(a & sets[j])
            if a and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                groups.join(i, j)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        if not sets[i]:
            out.append((doc_id, 0, doc_id))
            continue
        ids = [rows[j][0] for j in range(len(rows)) if sets[j] and groups.find(j) == groups.find(i)]
        out.append((doc_id, len(sets[i]), min((x for x in ids if x is not None), default=None)))
    return sorted(out, key=repr)


def near_copies(spark, seed):
    r = random.Random(seed)
    rows = []
    for family in range(12):
        words = prose(r.choice([4, 12, 40, 150]), seed * 100 + family).split(" ")
        for _ in range(r.randint(1, 9)):
            w = list(words)
            for _ in range(r.randint(0, 4)):
                w[r.randrange(len(w))] = r.choice(["new", "word", "here"])
            rows.append((len(rows), " ".join(w)))
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(4)


@pytest.mark.parametrize("k,percent", [(3, 90), (5, 80), (1, 60)])
def test_jaccard_edges(spark, k, percent):
    docs = edge_docs(spark)
    got = jaccard_components(docs, k, percent).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got), key=repr) == jaccard_truth(given(docs), k, percent)


@pytest.mark.parametrize("seed", [1, 2])
def test_jaccard_near_copies_in_small_blocks(spark, seed):
    docs = near_copies(spark, seed)
    got = jaccard_components(docs, 2, 70, block_tokens=5000).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got), key=repr) == jaccard_truth(given(docs), 2, 70)


@pytest.mark.parametrize("expected", [100, 10**6, 10**11])
@pytest.mark.parametrize("percent", [60, 80, 90])
def test_linked_sets_share_a_signature(expected, percent):
    """Whatever the allocation, and it is another one for other sizes of corpus."""
    r = np.random.default_rng(5)
    common = np.sort(r.integers(0, 1 << 64, 500, dtype=np.uint64))
    scheme = Scheme(percent, expected, common)
    assert percent < 80 or scheme.rare_segments(scheme.band(300)) and not scheme.rare_segments(scheme.band(4))
    for _ in range(400):
        n = int(r.integers(1, 400))
        a = r.integers(0, 1 << 64, n, dtype=np.uint64)
        a[: int(r.integers(0, n + 1)) if r.random() < 0.6 else 0] = 0
        a = np.concatenate([a[a > 0], r.choice(common, (a == 0).sum())])
        r.shuffle(a)
        change = int(r.integers(0, n * (100 - percent) // 100 + 1))
        b = np.concatenate([a[change:], r.integers(0, 1 << 64, int(r.integers(0, change + 1)), dtype=np.uint64)])
        both = len(np.intersect1d(a, b))
        if 100 * both >= percent * (len(set(a) | set(b))):
            assert np.intersect1d(scheme.signatures(np.unique(a)), scheme.signatures(np.unique(b))).size


def test_jaccard_of_words_built_to_have_equal_polynomial_hashes(spark):
    docs = spark.createDataFrame(list(enumerate(thue_morse(1024))), "doc_id long, text string")
    got = jaccard_components(docs, 3, 90).select("doc_id", "component_id").collect()
    assert sorted(map(tuple, got)) == [(0, 0), (1, 1)]


def test_allocation_follows_cost():
    assert Scheme(90, 10**3).allocation(12)[1] == 0
    assert any(Scheme(80, 10**12).allocation(b)[1] > 0 for b in range(5, 30))


def test_jaccard_empty(spark):
    assert jaccard_components(no_docs(spark)).collect() == []


def test_a_set_of_a_large_family_goes_to_few_tasks(spark, monkeypatch):
    import callgrid.llm.jaccard_join as j

    tables = {}
    monkeypatch.setattr(j, "written", lambda df, name, *args, write=j.written: tables.setdefault(name, write(df, name, *args)))
    r, rows = random.Random(4), []
    for i in range(400):
        words = prose(40, 21).split(" ")
        words[r.randrange(40)] = f"own{i}"
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = jaccard_components(docs, 3, 80, block_tokens=4000).select("doc_id", "n_shingles", "component_id").collect()
    assert tables["members"].selectExpr("max(block) + 1", "count(*)").first() == (16, 400)
    assert sorted(map(tuple, got), key=repr) == jaccard_truth(rows, 3, 80)


@pytest.mark.parametrize("copies", [3, 30])
@pytest.mark.parametrize("percent", [60, 80])
def test_links_within_and_across_blocks(copies, percent):
    """Few and many links in a block, against all pairs at once."""
    r = np.random.default_rng(copies)
    for _ in range(8):
        sets = []
        for _ in range(int(r.integers(1, 20))):
            base = r.integers(0, 1 << 64, int(r.integers(1, 200)), dtype=np.uint64)
            for _ in range(int(r.integers(1, copies))):
                s = base.copy()
                change = int(r.integers(0, len(s) // 5 + 1))
                s[:change] = r.integers(0, 1 << 64, change, dtype=np.uint64)
                r.shuffle(s)
                sets.append(np.unique(s[int(r.integers(0, len(s) // 10 + 1)) :]))
        sets = [sets[i] for i in r.permutation(len(sets))]
        linked, m, step = linked_pairs(sets, percent), len(sets) // 2, int(r.integers(3, 70))

        def groups(*links, n=len(sets)):
            found = np.eye(n, dtype=bool)
            for i, j in (pair for pairs in links for pair in pairs):
                found[i, j] = found[j, i] = True
            return local_roots(found).tolist()

        everything = np.argwhere(linked).tolist()
        assert groups(spanning_links(sets, None, percent, step)) == groups(everything)
        across = spanning_links(sets[:m], sets[m:], percent, step)
        between = [(i, j) for i, j in everything if i < m <= j]
        assert groups(across, between) == groups(across) and groups(across, everything) == groups(everything)


@pytest.mark.parametrize("most", [1 << 20, 16])
def test_key_filter(spark, monkeypatch, most):
    monkeypatch.setattr(KeyFilter, "MOST_WORDS", most)
    rows = spark.range(-3000, 3000).selectExpr("nullif(id, 7) as k", "id as filter_word")
    keys = rows.where("k is null or k % 10 = 0").select("k")
    near, far = KeyFilter(keys).split(rows, "k")
    near, far = near.collect(), far.collect()
    assert len(near) + len(far) == 6000 and {r.k for r in near} >= {r.k for r in keys.collect()}
    assert len(near) < 1000 or most == 16
    near, far = KeyFilter(keys.limit(0)).split(rows, "k")
    assert near.count() == 0 and far.count() == 6000


def test_texts_without_a_match_do_not_move(spark, monkeypatch):
    shares = []

    def split(self, rows, key, whole=KeyFilter.split):
        near, far = whole(self, rows, key)
        if "text" in rows.columns:
            shares.append(near.count() / rows.count())
        return near, far

    monkeypatch.setattr(KeyFilter, "split", split)
    rows = [(i, prose(60, 1000 + i, words=4000)) for i in range(300)]
    rows += [(300, rows[5][1]), (301, rows[6][1] + " end")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    jaccard_components(docs, 3, 80).collect()
    assert len(shares) == 1 and 0 < shares[0] < 0.1
    remove_repeats(docs).collect()
    assert len(shares) == 4 and max(shares) < 0.1 and min(shares) > 0


def removal_truth(rows, length):
    """Rows equal in doc_id and text are one document."""
    out, seen = {}, set()
    order = sorted(set(rows), key=lambda r: (-1 if r[0] is None else r[0]))
    found = {}
    for doc_id, text in order:
        data = text.encode()
        for p in range(len(data) - length + 1):
            s = data[p : p + length]
            place = (-1 if doc_id is None else doc_id, p)
            found[s] = min(found.get(s, place), place)
    for doc_id, text in order:
        data = text.encode()
        gone = bytearray(len(data))
        for p in range(len(data) - length + 1):
            if found[data[p : p + length]] < (-1 if doc_id is None else doc_id, p):
                gone[p : p + length] = b"\1" * length
        kept = bytes(c for c, g in zip(data, gone, strict=True) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out[doc_id, text] = (len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest(), kept)
    return out, seen


@pytest.mark.parametrize("length", [100, 41])
def test_repeats_edges(spark, length):
    docs = edge_docs(spark)
    truth, _ = removal_truth(given(docs), length)
    want = sorted(((i, *truth[i, t]) for i, t in given(docs)), key=repr)
    found = remove_repeats(docs, length)
    assert found.columns == [c for c in docs.columns if c != "text"] + ["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
    got = found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept").collect()
    assert sorted(((*r[:5], bytes(r[5])) for r in got), key=repr) == want


def test_repeats_empty(spark):
    assert remove_repeats(no_docs(spark)).collect() == []


def test_long_text_in_parts(spark, monkeypatch):
    import callgrid.llm.suffix_dedup as s

    monkeypatch.setattr(s, "PIECE_BYTES", 700)
    text = prose(900, 8)
    buf = np.frombuffer((text + text[300:1500]).encode(), np.uint8)
    one = s.anchors(buf, np.array([0, len(buf)]), 100)
    monkeypatch.setattr(s, "PIECE_BYTES", 1 << 20)
    whole = s.anchors(buf, np.array([0, len(buf)]), 100)
    # parts only split runs; every start keeps its anchor
    assert {(p, h) for a, b, p, h in zip(*one[1:], strict=True) for _ in range(a, b + 1)} == {(p, h) for a, b, p, h in zip(*whole[1:], strict=True) for _ in range(a, b + 1)}


def test_deep_shallow_groups():
    from callgrid.llm.suffix_dedup import _big_endian_words

    r = random.Random(3)
    base = [bytes(r.choice(b"ab") for _ in range(100)) for _ in range(6)]
    strings = []
    for _ in range(400):
        s = bytearray(r.choice(base))
        for _ in range(r.randint(0, 2)):
            s[r.randrange(100)] = r.choice(b"abc")
        strings.append(bytes(s))
    buf = np.frombuffer(b"".join(strings), np.uint8)
    label = equal_groups(_big_endian_words(buf), np.arange(400) * 100, np.zeros(400, np.uint64), 100)
    for i in range(400):
        assert (label[i] >= 0) == (strings.count(strings[i]) > 1)
        for j in range(i):
            if label[i] >= 0 and label[j] >= 0:
                assert (label[i] == label[j]) == (strings[i] == strings[j])


def vectors(spark, seed=0):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(6, 16))
    rows = [(i, (centres[i % 6] + r.normal(size=16) * 0.12).tolist()) for i in range(150)]
    rows += [(200 + i, rows[3][1]) for i in range(4)]  # equal
    rows += [(300, (np.array(rows[3][1]) * 7).tolist())]  # scaled
    rows += [(301, None), (302, []), (303, [0.0] * 16), (304, [float("nan")] * 16), (305, [1.0, None] * 8), (306, [float("inf")] + [1.0] * 15)]
    rows += [(307, [1.0, 2.0]), (308, [1.0, 2.0]), (None, rows[5][1]), (5, rows[5][1]), (5, rows[6][1])]
    rows = [(*row, "x", 1) for row in rows]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, first string, h1 int").repartition(3)


@pytest.mark.parametrize("interval", [4096, 16])
def test_similar_vectors(spark, interval):
    frame = vectors(spark)
    rows = [(r[0], r[1]) for r in frame.collect()]
    valid = [x is not None and len(x) and all(v is not None and np.isfinite(v) for v in x) and any(x) for _, x in rows]
    unit = [np.array(x, np.float64) / np.linalg.norm(np.array(x, np.float64)) if ok else None for (_, x), ok in zip(rows, valid, strict=True)]
    groups, links = Groups(), [0] * len(rows)
    for i, a in enumerate(unit):
        groups.find(i)
        for j, b in enumerate(unit):
            if i != j and a is not None and b is not None and len(a) == len(b) and a @ b >= 0.95 - 1e-15:
                links[i] += 1
                groups.join(i, j)
    want = []
    for i, (vec_id, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if groups.find(j) == groups.find(i) and rows[j][0] is not None]
        component = min(ids, default=None) if valid[i] else vec_id
        want.append((vec_id, links[i], component, vec_id == component))
    got = similar_vectors(frame, 0.95, dims=4, interval=interval).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_similar_vectors_in_doubles_as_in_floats(spark):
    frame = vectors(spark)
    wide = frame.withColumn("embedding", frame["embedding"].cast("array<double>"))
    assert sorted(map(tuple, similar_vectors(wide, dims=4).collect()), key=repr) == sorted(map(tuple, similar_vectors(frame, dims=4).collect()), key=repr)


def test_pairs_of_intervals_are_read_where_they_lie(spark, monkeypatch):
    """No interval is dealt out again for the pairs it is in."""
    import callgrid.llm.grid_order_join as g

    plans = {}

    def written(df, name, *args, write=g.written, **more):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return write(df, name, *args, **more)

    monkeypatch.setattr(g, "written", written)
    monkeypatch.setattr(g, "VECTORS_A_FILE", 20, raising=False)
    frame = vectors(spark)
    got = sorted(map(tuple, similar_vectors(frame, 0.95, dims=4, interval=8).collect()), key=repr)
    assert "CartesianProduct" in plans["found"] and "REPARTITION" not in plans["found"]
    monkeypatch.undo()
    assert got == sorted(map(tuple, similar_vectors(frame, 0.95, dims=4).collect()), key=repr)


@pytest.mark.parametrize("spread", [0.02, 0.09, 0.12])
def test_pairs_of_two_intervals(monkeypatch, spread):
    """Blocks with few and with many links, against all pairs at once."""
    import pyarrow as pa

    import callgrid.llm.grid_order_join as g

    monkeypatch.setattr(g, "NEAR_BLOCK", 32)
    monkeypatch.setattr(g, "BLOCK", 8)
    r = np.random.default_rng(3)
    dim, dims = 40, 4
    x = r.normal(size=(9, dim))[r.integers(0, 9, 150)] / dim**0.5 + r.normal(size=(150, dim)) * spread / dim**0.5 * r.choice([1, 30], (150, 1))
    axes = {dim: g._axes(list(x), dims)}
    u, n = g.unit(x), r.integers(1, 5, 150)
    for ids, more in ((np.arange(90), np.arange(90, 150)), (np.arange(90), np.arange(90))):
        same = ids is more or ids[-1] == more[-1]
        side = lambda i: [a.astype(t).tobytes() for a, t in ((x[i], "<f8"), (i, "<i8"), (-i, "<i8"), (n[i], "<i8"))]
        row = dict(zip(["dim", "a", "vectors", "h1", "h2", "n", "b", "vectors2", "h12", "h22", "n2"], [dim, 0, *side(ids), 0 if same else 1, *side(more)], strict=True))
        [got] = g._join_intervals([pa.RecordBatch.from_pylist([row])], axes, dims, 0.95, 0.1 + 1e-9, "<f8")
        links, groups, want = u[ids] @ u[more].T >= 0.95, Groups(), Groups()
        if same:
            np.fill_diagonal(links, False)
        count = dict(zip(ids.tolist(), (links @ n[more]).tolist(), strict=True))
        if not same:
            count |= dict(zip(more.tolist(), (n[ids] @ links).tolist(), strict=True))
        assert {h: c for h, c in count.items() if c} == dict(zip(got["h1"].to_pylist(), got["links"].to_pylist(), strict=True))
        for i, j in np.argwhere(links).tolist():
            want.join(int(ids[i]), int(more[j]))
        for i, j in zip(got["h1"].to_pylist(), got["root_h1"].to_pylist(), strict=True):
            groups.join(i, j)
        assert all((groups.find(i) == groups.find(j)) == (want.find(i) == want.find(j)) for i in range(150) for j in range(i))
        assert links.any()


def test_similar_vectors_empty(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert similar_vectors(empty).collect() == []
    only = spark.createDataFrame([(1, None), (2, [0.0])], "vec_id long, embedding array<float>")
    assert sorted(map(tuple, similar_vectors(only).collect())) == [(1, 0, 1, True), (2, 0, 2, True)]


def test_components(spark):
    r = random.Random(1)
    edges = [(i, i + 1) for i in range(0, 60)] + [(r.randrange(100, 160), r.randrange(100, 160)) for _ in range(40)] + [(7, 7), (None, 3)]
    groups = Groups()
    for a, b in edges:
        if a is not None and a != b:
            groups.join(a, b)
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert sorted(map(tuple, got)) == sorted((x, groups.find(x)) for x in groups.up)
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
