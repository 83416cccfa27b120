"""Quality rules: distance of a document's histograms from those of the languages in the corpus.

Each language has two references, summed up over all its documents: shares of character classes, and shares of its common
words (those with a share of at least 1/1000) and the rest. A document is measured against every language by
Jensen-Shannon distance (base 2, 0 to 1) and judged by the nearest one. Short documents are only judged where their length
carries the measure: a distance that chance alone explains at that length is not held against them. For words that is
found by drawing texts of that length from the reference.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .textbytes import IS_SPACE, LOWER, U, mixed, pieces, run_hashes, words

COMMON = 1 / 1000
DRAWS = 400
ROWS_AT_ONCE = 512
# Classes of characters by first byte; continuation bytes belong to no character of their own.
CLASSES = 12
CLASS = np.full(256, 5, np.int64)  # other ASCII
CLASS[97:123], CLASS[65:91], CLASS[48:58] = 0, 1, 2
CLASS[[32, 9, 11, 12, 13]], CLASS[10] = 3, 4
CLASS[[ord(c) for c in ".,;:!?'\"-()"]] = 6
CLASS[[ord(c) for c in "#*$%&|<>"]] = 7
CLASS[128:192], CLASS[192:224], CLASS[224:240], CLASS[240:] = -1, 8, 9, 10
CLASS[[*range(0, 9), *range(14, 32), 127]] = 11
COUNTED = CLASS >= 0
IS_SYMBOL = np.zeros(256, bool)
IS_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True


def _per_row(mask: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """How many marked bytes each row has."""
    total = np.concatenate([[0], np.cumsum(mask)])
    return total[bounds[1:]] - total[bounds[:-1]]


def _class_counts(buf: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    kind = CLASS[buf]
    seen = kind >= 0
    return np.bincount(row[seen] * CLASSES + kind[seen], minlength=(len(bounds) - 1) * CLASSES).reshape(-1, CLASSES)


def _repeated(names: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each name: whether its row has it twice or more, and whether an earlier one in the row equals it."""
    key = mixed(names ^ mixed(row.astype(U)))
    order = np.argsort(key, kind="stable")
    same = np.zeros(len(key), bool)
    same[1:] = key[order][1:] == key[order][:-1]
    earlier, more = np.zeros(len(key), bool), np.zeros(len(key), bool)
    earlier[order] = same
    more[order] = same
    more[order[:-1]] |= same[1:]
    return more, earlier


def base_measures(buf: np.ndarray, bounds: np.ndarray) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of each row."""
    starts, ends, per_row = words(buf, bounds)
    n_words = np.diff(per_row)
    out = {"n_words": n_words, "word_chars": _per_row(COUNTED[buf] & ~IS_SPACE[buf], bounds)}
    out["n_symbols"] = _per_row(IS_SYMBOL[buf], bounds)
    # lines: between line feeds and row ends
    rows = np.arange(len(n_words))
    line_start = np.unique(np.concatenate([bounds[:-1], np.flatnonzero(buf == 10) + 1]))
    line_start = line_start[line_start < len(buf)]
    dup_lines = np.zeros(len(n_words), np.int64)
    if len(line_start):
        line_end = np.append(line_start[1:], len(buf))
        names = run_hashes(buf, line_start, line_end - (buf[line_end - 1] == 10))
        first = np.searchsorted(starts, line_start)
        with_word = np.append(first[1:], len(starts)) > first
        row = np.searchsorted(bounds, line_start, "right") - 1
        _, earlier = _repeated(names[with_word], row[with_word])
        dup_lines = np.bincount(row[with_word][earlier], minlength=len(n_words))
    out["n_dup_lines"] = dup_lines
    covered = np.zeros(len(starts) + 3, bool)
    if len(starts) > 2:
        h = run_hashes(buf, starts, ends)
        row = np.repeat(rows, n_words)
        at = np.flatnonzero(row[:-2] == row[2:])
        three = mixed(mixed(mixed(h[:-2]) + h[1:-1]) + h[2:])[at]
        at = at[_repeated(three, row[at])[0]]
        for j in range(3):
            covered[at + j] = True
    total = np.concatenate([[0], np.cumsum(covered)])
    out["n_repeat_words"] = total[per_row[1:]] - total[per_row[:-1]]
    return out


def _language_words(batches: Iterator[pa.RecordBatch]):
    """(rows' language numbers, names, class counts, hashes of lower-cased words, their language numbers)."""
    for rows, buf, bounds in pieces(batches, "text"):
        codes = rows.column("lang").dictionary_encode()
        of = codes.indices.to_numpy(zero_copy_only=False)
        low = LOWER[buf]
        starts, ends, per_row = words(low, bounds)
        yield of, codes.dictionary.to_pylist(), _class_counts(buf, bounds), run_hashes(low, starts, ends), np.repeat(of, np.diff(per_row))


def references(docs: DataFrame) -> dict[str, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """language -> (class shares, sorted hashes of common words, their shares), over all documents with a language.

    Words that may be common are found first: a word with a share of 1/1000 overall has half of that somewhere, and sums over
    where it has leave at most 2000 words a language. Those are then counted exactly.
    """
    known = docs.where("lang is not null and text is not null").select("lang", "text")

    def likely(batches):
        classes: dict[str, np.ndarray] = {}
        total: dict[str, int] = {}
        often: dict[tuple, list[int]] = {}
        for of, names, counts, h, lang in _language_words(batches):
            for i, name in enumerate(names):
                classes[name] = classes.get(name, 0) + counts[of == i].sum(axis=0)
                own, n = np.unique(h[lang == i], return_counts=True)
                size = int(n.sum())
                total[name] = total.get(name, 0) + size
                heavy = np.flatnonzero(n >= COMMON / 2 * size)
                for k, m in zip(own[heavy].view(np.int64).tolist(), n[heavy].tolist(), strict=True):
                    entry = often.setdefault((name, k), [0, 0])
                    entry[0] += m
                    entry[1] += size
        out = [(k, "c", i, int(n), 0) for k, c in classes.items() for i, n in enumerate(c)]
        out += [(k, "t", 0, n, 0) for k, n in total.items()]
        out += [(k, "w", h, n, size) for (k, h), (n, size) in often.items()]
        columns = list(zip(*out, strict=True)) if out else [[]] * 5
        kinds = (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64())
        names = ["lang", "kind", "key", "n", "seen"]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    schema = "lang string, kind string, key long, n long, seen long"
    found = known.mapInArrow(likely, schema).groupBy("lang", "kind", "key").agg(F.sum("n").alias("n"), F.sum("seen").alias("seen"))
    found = found.withColumn("words", F.max(F.when(F.col("kind") == "t", F.col("n"))).over(_by_language()))
    kept = found.where(f"kind <> 'w' or n + {COMMON / 2} * (words - seen) >= {COMMON} * words").collect()
    classes: dict[str, np.ndarray] = {}
    total: dict[str, int] = {}
    maybe: dict[str, list[int]] = {}
    for r in kept:
        if r["kind"] == "c":
            classes.setdefault(r["lang"], np.zeros(CLASSES))[r["key"]] = r["n"]
        elif r["kind"] == "t":
            total[r["lang"]] = r["n"]
        else:
            maybe.setdefault(r["lang"], []).append(r["key"])
    names = sorted(classes)
    table = {k: np.sort(np.array(maybe.get(k, []), np.int64).view(U)) for k in names}

    def exact(batches):
        sums = {k: np.zeros(len(table[k]) + 1, np.int64) for k in names}
        for _, langs, _, h, lang in _language_words(batches):
            for i, name in enumerate(langs):
                sums[name] += np.bincount(_places(table[name], h[lang == i]), minlength=len(table[name]) + 1)
        rows = [(k, i, int(n)) for k in names for i, n in enumerate(sums[k][:-1])]
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 3
        kinds = (pa.string(), pa.int32(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["lang", "i", "n"])

    counted = known.mapInArrow(exact, "lang string, i int, n long").groupBy("lang", "i").agg(F.sum("n").alias("n")).collect()
    sums = {k: np.zeros(len(table[k])) for k in names}
    for r in counted:
        sums[r["lang"]][r["i"]] = r["n"]
    out = {}
    for k in names:
        if classes[k].sum() and total.get(k):
            common = sums[k] >= COMMON * total[k]
            out[k] = (classes[k] / classes[k].sum(), table[k][common], sums[k][common] / total[k])
    return out


def _by_language():
    from pyspark.sql import Window

    return Window.partitionBy("lang")


def _places(table: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Index of each hash in a sorted table, or its length."""
    at = np.searchsorted(table, h)
    if not len(table):
        return at
    return np.where(table[np.minimum(at, len(table) - 1)] == h, at, len(table))


def _with_rest(common: np.ndarray) -> np.ndarray:
    """Shares of the common words and of all others together."""
    return np.append(common, max(0.0, 1 - common.sum()))


def js_distance(counts: np.ndarray, reference: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance of each row of counts from the reference; 1 for rows of zeros."""
    n = counts.sum(axis=1, keepdims=True)
    p = counts / np.maximum(n, 1)
    m = (p + reference) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        a = np.where(p > 0, p * np.log2(p / m), 0).sum(axis=1)
        b = np.where(reference > 0, reference * np.log2(reference / m), 0).sum(axis=1)
    return np.where(n[:, 0] > 0, np.sqrt(np.maximum(0, (a + b) / 2)), 1.0)


def sampled_divergence(reference: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(lengths, mean, standard deviation) of the squared distance that texts of words drawn from the reference have from it."""
    r = np.random.default_rng(0)
    lengths = np.unique(np.round(2 ** np.arange(0, 16.5, 0.5)).astype(np.int64))
    found = [js_distance(r.multinomial(n, reference / reference.sum(), size=DRAWS), reference) ** 2 for n in lengths.tolist()]
    return lengths, np.array([x.mean() for x in found]), np.array([x.std() for x in found])


def divergence_by_chance(sampled: tuple[np.ndarray, np.ndarray, np.ndarray], n: np.ndarray, spread: float) -> np.ndarray:
    """Mean plus `spread` standard deviations at each length; beyond the longest drawn both fall with the length."""
    lengths, mean, deviation = sampled
    n = np.maximum(n, 1)
    bound = np.maximum(mean + spread * deviation, 1e-300)
    return np.exp(np.interp(np.log(n), np.log(lengths), np.log(bound))) * np.minimum(1, lengths[-1] / n)


def judged_documents(
    docs: DataFrame,
    min_words: int = 50,
    repeat_percent: int = 50,
    class_limit: float = 0.25,
    word_limit: float = 0.15,
    chance: float = 1.0,
    spread: float = 3.0,
) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, class_distance, word_distance,
    kept) for each row of `docs` (doc_id, text, lang, other columns).

    A document fails at the base if it has fewer than `min_words` words, or more than `repeat_percent` of them stand in
    three-word windows the text has twice. Else it is kept unless its class distance exceeds `class_limit` or its word
    distance `word_limit`, both without what sampling alone brings, `chance` times. From class distances that takes the root
    of (bins / (8 ln 2 * length)), as texts have many more characters than there are classes. From squared word distances,
    to which sampling adds, it takes the mean and `spread` standard deviations of texts as long, drawn from the reference.
    Distances are those to the nearest language. Null texts have no words. Without any language in the corpus the base
    alone decides.
    """
    known = references(docs)
    sampled = {k: sampled_divergence(_with_rest(common)) for k, (_, _, common) in known.items()}
    schema = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, class_distance double, word_distance double, kept boolean"

    def judge(batches):
        for rows, buf, bounds in pieces(batches, "text"):
            base = base_measures(buf, bounds)
            n_words, n = base["n_words"], rows.num_rows
            failed = (n_words < min_words) | (100 * base["n_repeat_words"] > repeat_percent * n_words)
            classes = _class_counts(buf, bounds)
            low = LOWER[buf]
            starts, ends, per_row = words(low, bounds)
            h = run_hashes(low, starts, ends)
            far_class, far_word = np.full(n, np.inf), np.full(n, np.inf)
            length = np.maximum(classes.sum(axis=1), 1)
            for name, (shares, table, common) in known.items():
                reference = _with_rest(common)
                place, bins = _places(table, h), len(table) + 1
                near = np.empty(n)
                for a in range(0, n, ROWS_AT_ONCE):
                    b = min(n, a + ROWS_AT_ONCE)
                    row = np.repeat(np.arange(b - a), n_words[a:b])
                    counts = np.bincount(row * bins + place[per_row[a] : per_row[b]], minlength=(b - a) * bins)
                    near[a:b] = js_distance(counts.reshape(b - a, bins), reference)
                near = np.sqrt(np.maximum(0, near**2 - chance * divergence_by_chance(sampled[name], n_words, spread)))
                far_word = np.minimum(far_word, near)
                far_class = np.minimum(far_class, js_distance(classes, shares) - chance * np.sqrt(CLASSES / (8 * np.log(2) * length)))
            good = ~failed & ((far_class <= class_limit) & (far_word <= word_limit) | (not known))
            values = [base[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
            columns = [rows.column("doc_id"), *(pa.array(v, pa.int64()) for v in values), pa.array(failed)]
            columns += [pa.array(np.where(np.isinf(x), 0.0, np.maximum(x, 0))) for x in (far_class, far_word)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(good)], names=[x.split()[0] for x in schema.split(", ")])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(judge, schema)
