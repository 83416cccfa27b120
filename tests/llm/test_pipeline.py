"""The pipeline, stage by stage, on documents with every awkward case."""

import corpus_pipeline as p
from llm.helpers import edge_docs, no_docs, prose
from llm.test_pairs import jaccard_truth, removal_truth, shingles


def test_stages(spark):
    docs = edge_docs(spark).select(*p.COLUMNS)
    for _, stage in p.STAGES[:4]:
        out = stage(spark, docs, "")
        assert out.columns == p.COLUMNS
        assert stage(spark, no_docs(spark).select(*p.COLUMNS), "").collect() == []
    # n-gram Jaccard join: one row of each group
    rows = [(r["doc_id"], r["text"] or "") for r in docs.collect()]
    kept = p.jaccard(spark, docs, "").collect()
    truth = jaccard_truth(rows, 5, 80)
    want = {(i, c) for i, n, c in truth if n and i == c}
    assert {r["doc_id"] for r in kept} >= {i for i, _ in want}
    assert len([r for r in kept if r["text"] and r["text"].strip()]) >= len(want)
    # suffix-array dedup: what is left of each text
    left = {(r["doc_id"], r["text"], r["n_chars"]) for r in p.suffix_dedup(spark, docs, "").collect()}
    found, _ = removal_truth(rows, 100)
    for (i, text), (_, removed, _, _, data) in found.items():
        data = data.decode(errors="ignore")
        if not removed:
            assert (i, text) in {(a, b) for a, b, _ in left}
        elif data.strip(" "):
            assert (i, data, len(data)) in left


def test_jaccard_stage_keeps_the_rows_that_stand_for_their_groups(spark):
    a, own = prose(80, 11), prose(80, 12)
    more = [(5, a), (None, a + " end"), (9, a + " last"), (9, own), (None, prose(50, 13)), (None, " "), (None, ""), (None, "")]
    more += [(20, prose(30, 14)), (20, prose(30, 14).upper()), (21, prose(30, 14) + " x")]
    more = spark.createDataFrame([(i, t, "en", "s0", len(t)) for i, t in more], edge_docs(spark).select(*p.COLUMNS).schema)
    docs = edge_docs(spark).select(*p.COLUMNS).unionByName(more)
    rows = [(r["doc_id"], r["text"] or "") for r in docs.collect()]
    kept = sorted(((r["doc_id"], r["text"] or "") for r in p.jaccard(spark, docs, "").collect()), key=repr)
    of = lambda i, t: (i, frozenset(shingles(t, 5)) or t)
    want = set()
    for j, row in enumerate(rows):  # this row's component, told from the others by an id below all
        sets = [r if k != j else (-1, r[1]) for k, r in enumerate(rows)]
        linked = {i for i, n, c in jaccard_truth(sets, 5, 80) if n and c == -1 and i not in (-1, None)} if shingles(row[1], 5) else set()
        if not shingles(row[1], 5) or min({*linked, *([row[0]] if row[0] is not None else [])}, default=None) == row[0]:
            want.add(of(*row))
    assert sorted((of(*r) for r in kept), key=repr) == sorted(want, key=repr)
    assert (9, own) in kept and (9, a + " last") not in kept and (None, a + " end") not in kept


def test_run_packs_what_is_left(spark):
    import __spark_entry__ as e

    rows = e.queries()["pipeline"](spark, "/root/testdata/sf0.001").collect()
    assert rows and {len(r["ids"]) // 4 for r in rows if r["length"] == len(r["ids"]) // 4}
    spans = {}
    for r in rows:
        spans.setdefault((r["doc_id"], r["doc_tokens"]), []).append((r["start"], r["length"]))
    for (_, n), pieces in spans.items():
        assert sum(k for _, k in pieces) % n == 0
