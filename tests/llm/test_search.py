"""Dual-tree search and collocations against plain restatements."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from llm.helpers import LOWER_CASE, edge_docs, edge_texts, no_docs, prose

from callgrid.llm import collocations as phrases, dual_tree_search as dual
from callgrid.llm.dual_tree_search import Items, best_documents

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall((text or "").translate(LOWER_CASE))


def best_truth(docs, items, k):
    """(item, rank, doc_id, score) for lists of (id, text); items are told apart by their place."""
    counts = [Counter(terms(t)) for _, t in docs]
    n = [sum(c.values()) for c in counts]
    documents, length = sum(x > 0 for x in n), sum(n)
    df = Counter(t for c in counts for t in c)
    out = []
    for i, (_, text) in enumerate(items):
        scored = []
        for (doc_id, _), c, size in zip(docs, counts, n, strict=True):
            m = 100 - 90 + (90 * size * documents) // max(1, length)
            score = sum(
                math.floor(1000 * math.log((2 * documents + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                for t in set(terms(text))
                if c[t]
            )
            if score > 0:
                scored.append((-score, doc_id is not None, doc_id or 0))
        out += [(i, r, d if known else None, -s) for r, (s, known, d) in enumerate(sorted(scored)[:k], 1)]
    return out


@pytest.mark.parametrize("block", [4096, 3])
def test_best_documents_of_edge_cases(spark, monkeypatch, block):
    monkeypatch.setattr(dual, "BLOCK_ITEMS", block)
    docs = edge_docs(spark)
    items = [(i, t) for i, t in enumerate(edge_texts())] + [(3, "more words"), (None, "more words at"), (90, "no such term"), (91, "more words at MORE")]
    given = spark.createDataFrame([(i, t, 1, "x") for i, t in [*items, items[-1]]], "item_id long, text string, term int, score string")
    got = best_documents(docs, given, 4)
    assert got.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    want = best_truth([(r["doc_id"], r["text"]) for r in docs.collect()], items, 4)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(((items[i][0], *rest) for i, *rest in want), key=repr)


def test_best_documents_of_nothing(spark):
    items = spark.createDataFrame([(1, "a b"), (2, None), (3, "")], "item_id long, text string")
    assert best_documents(no_docs(spark), items).collect() == []
    assert best_documents(edge_docs(spark), items.where("text is null")).collect() == []
    assert best_documents(edge_docs(spark), items.limit(0)).collect() == []


def searched(monkeypatch, seed, exact=dual.EXACT):
    """Rows found in small trees, the truth, and the share of pairs of documents and items that were scored."""
    monkeypatch.setattr(dual, "DOC_LEVELS", (64, 16, 4))
    monkeypatch.setattr(dual, "DOCS_AT_ONCE", 32)
    monkeypatch.setattr(dual, "CELLS", 500)
    monkeypatch.setattr(dual, "EXACT", exact)
    r = random.Random(seed)
    texts = [prose(r.randint(0, 60), seed * 1000 + i, 300) for i in range(150)]
    asked = [t[r.randrange(1 + len(t) // 2) :][:80] for t in texts[:30]]
    texts += [asked[i % 10] + " " + prose(5, i, 300) for i in range(50)] + texts[:20]
    rows = [(5 * i % 997, t) for i, t in enumerate(texts)]
    items = Items(list(enumerate(asked)))
    docs = pa.record_batch({"doc_id": [i for i, _ in rows], "text": [t for _, t in rows]})
    vectors = pa.Table.from_batches(dual._vectors(iter([docs]), items.terms)).to_pylist()
    having = {t: sum(v["having"][t] for v in vectors if v["having"]) for t in range(len(items.terms))}
    items.weigh(having, vectors[-1]["documents"], vectors[-1]["length"])
    kept = [v for v in vectors if v["terms"]]
    kinds = {"doc_id": pa.int64(), "n": pa.int64(), "terms": pa.list_(pa.int32()), "tfs": pa.list_(pa.int32())}
    batch = pa.record_batch({c: pa.array([v[c] for v in kept], t) for c, t in kinds.items()})
    scored = []
    score = dual._score
    monkeypatch.setattr(dual, "_score", lambda i, tree, alive, best: (scored.append(int(alive.sum()) * 4), score(i, tree, alive, best)))

    def run(floors, promising):
        return pa.Table.from_batches(dual._search(iter([batch]), items, 5, floors, promising)).to_pylist()

    first = run(np.zeros(30, np.int64), True)
    floors = np.zeros(30, np.int64)
    for i in range(30):
        own = sorted((f["score"] for f in first if f["item"] == i), reverse=True)
        floors[i] = own[4] if len(own) == 5 else 0
    scored.clear()
    found = run(floors, False)
    got = sorted((int(items.order[f["item"]]), f["doc_id"], f["score"]) for f in found)
    want = sorted((i, d, s) for i, _, d, s in best_truth(rows, list(enumerate(asked)), 5))
    return got, want, sum(scored) / (len(kept) * 30)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_trees_of_several_levels(monkeypatch, seed):
    got, want, share = searched(monkeypatch, seed)
    assert got == want
    assert share < 0.7, "bounds drop pairs before they are scored"


def test_sums_beyond_exact_doubles(monkeypatch):
    got, want, _ = searched(monkeypatch, 4, exact=1)
    assert got == want


PIECE, PLAIN_WORD = re.compile(r"[.,;:!?\x0A-\x0D]"), re.compile(r"[^\x20\x09]+")


def collocations_truth(rows, least, percent, top):
    """Rows (lang, rank, phrase, a, l, r, n, score) for rows (lang, text)."""
    n, f = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in PIECE.split((text or "").translate(LOWER_CASE)):
            w = PLAIN_WORD.findall(piece)
            n[lang] += len(w)
            f.update((lang, *w[i : i + k]) for k in (1, 2, 3, 4) for i in range(len(w) - k + 1))
    candidates = {p: a for p, a in f.items() if len(p) > 2 and a >= least}
    inside = set()
    for p, a in candidates.items():
        for i in range(1, len(p)):
            for j in range(i + 2, len(p) + 1):
                part = (p[0], *p[i:j])
                if len(part) < len(p) and 100 * a >= percent * f[part]:
                    inside.add(part)
    by_lang = {}
    for p, a in candidates.items():
        if p in inside:
            continue
        cuts = [(2000000 * a // (f[p[: 1 + k]] + f[(p[0], *p[1 + k :])]), k) for k in range(1, len(p) - 1)]
        score, k = min(cuts)
        row = (-score, -a, " ".join(p[1:]).encode(), f[p[: 1 + k]], f[(p[0], *p[1 + k :])])
        by_lang.setdefault(p[0], []).append(row)
    return sorted(
        (lang, rank, phrase.decode(), -a, left, right, n[lang], -score)
        for lang, own in by_lang.items()
        for rank, (score, a, phrase, left, right) in enumerate(sorted(own)[:top], 1)
    )


def spoken(seed):
    r = random.Random(seed)
    words = ["a", "b", "aa", "B", "\x01", "a\x01", "\0", "é", "\U0001f600", "long-word-of-some-length", "x'y", "\x1c"]
    gaps = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r", "\x0b", "!?"]
    rows = []
    for _ in range(60):
        text = "".join(r.choice(words[: r.choice([3, 12])]) + r.choice(gaps) for _ in range(r.randint(0, 60)))
        rows.append((r.choice([None, "und", "en", "fr", ""]), text))
    return rows + [("en", None), (None, "")] + rows[:10]


@pytest.mark.parametrize("least,percent,top,a_range", [(2, 80, 2000, 7), (3, 60, 5, 20_000), (1, 100, 40, 30), (9, 80, 2000, 3)])
def test_collocations(spark, monkeypatch, least, percent, top, a_range):
    monkeypatch.setattr(phrases, "PHRASES_A_RANGE", a_range)
    rows = spoken(least)
    docs = spark.createDataFrame([(lang, t, 1, "x", 2) for lang, t in rows], "lang string, text string, n int, key string, part int").repartition(4)
    got = phrases.collocations(docs, least, percent, top)
    names = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert got.columns == names and all(t == "bigint" for c, t in got.dtypes if c not in ("lang", "phrase"))
    assert sorted(map(tuple, got.collect())) == collocations_truth(rows, least, percent, top)


def test_collocations_of_edge_cases(spark):
    docs = edge_docs(spark)
    want = collocations_truth([(r["lang"], r["text"]) for r in docs.collect()], 4, 80, 300)
    assert sorted(map(tuple, phrases.collocations(docs, 4, 80, 300).collect())) == want
    assert phrases.collocations(no_docs(spark)).collect() == []


def test_scores_of_large_counts(spark):
    a, left, right = 6 * 10**12, 7 * 10**12, 9 * 10**18
    given = [("en", ["c", "b", "a"], a, [left, right], [left, a])]
    df = spark.createDataFrame(given, "lang string, key array<string>, f long, other array<long>, chain array<long>")
    r = phrases.lowest_cuts(df).first()
    assert (r["phrase"], r["l"], r["r"], r["score"]) == ("a b c", right, left, 2_000_000 * a // (right + left))


def test_hash_counts_add_up(monkeypatch):
    """Small buffers hand counts on early; sums per hash stay the same, and what is frequent passes."""
    monkeypatch.setattr(phrases, "HASHES_AT_ONCE", 50)
    monkeypatch.setattr(phrases, "TEXT_BYTES", 200)
    rows = [(lang or "", 7, t or "") for lang, t in spoken(1)]
    texts = pa.record_batch({"lang": [r[0] for r in rows], "lang_hash": pa.array([r[1] for r in rows], pa.int64()), "text": [r[2] for r in rows]})
    f = Counter()
    for _, _, text in rows:
        for piece in PIECE.split(text.translate(LOWER_CASE)):
            w = PLAIN_WORD.findall(piece)
            f.update(tuple(w[i : i + k]) for k in (1, 2, 3, 4) for i in range(len(w) - k + 1))
    filters = []
    for order in range(1, 5):
        packed = pa.Table.from_batches(phrases._hash_counts(iter([texts]), filters, 3, 40)).to_pylist()
        counts = Counter()
        for p in packed:
            for h, n in zip(*map(np.ndarray.tolist, phrases.unpack_counts(p["entries"])), strict=True):
                counts[h] += n
        assert sorted(n for n in counts.values() if n >= 5) == sorted(n for p, n in f.items() if len(p) == order and n >= 5)
        ordered = pa.Table.from_pylist(sorted(packed, key=lambda p: p["bucket"]), pa.schema([("bucket", pa.int32()), ("entries", pa.binary())]))
        bits = pa.Table.from_batches(phrases._frequent_bits(iter(ordered.to_batches()), 5, 20, 40))
        filters.append(phrases.Filter(20))
        filters[-1].set(bits["word"].to_numpy(), bits["bits"].to_numpy().view(np.uint64))
