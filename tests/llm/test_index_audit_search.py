"""The cuckoo-filter index, the divergence audit and ranked search against brute force."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from rowforge.llm import divergence, exactdedup, queries, ranked

SCHEMA = "doc_id long, text string, lang string, source string, key string, n long, term string, shard long"
TEXTS = ["", None, "Same Text", "same text", "SAME TEXT", "other", "Ünd", "ünd", "ÜND", "x " * 40_000, "X " * 40_000, "\n", " "]


def frame(spark, rows):
    """Documents with columns whose names the operators use themselves."""
    return spark.createDataFrame([(*r, "k", 7, "t", 3) for r in rows], SCHEMA)


def low(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


# exact duplicates


def brute_groups(rows):
    classes = {}
    for doc_id, text in rows:
        classes.setdefault(low(text), []).append(doc_id)
    out = []
    for text, ids in classes.items():
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        sha = hashlib.sha256(text.encode()).hexdigest()
        first = True
        for i in sorted(ids, key=lambda i: i != keep):
            out.append((i, keep, len(ids), i == keep and first, sha))
            first = False
    return sorted(out, key=repr)


def answers(index):
    return sorted((tuple(r) for r in exactdedup.groups(index).collect()), key=repr)


def shuffled(n, seed=1):
    rng = random.Random(seed)
    rows = [(k, rng.choice(TEXTS)) for k in range(n)]
    rows += [(5, "Same text"), (5, "same TEXT"), (5, "another"), (None, "other"), (None, "null only"), (None, "NULL only")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("key_bytes", "sent"), [(32, exactdedup.SENT), (1, 0)])
def test_groups_match_brute_force_also_with_clashing_digests(spark, monkeypatch, key_bytes, sent):
    monkeypatch.setattr(exactdedup, "SENT", sent)
    rows = shuffled(80) + [(1000 + k, f"own text {k % 400}") for k in range(600)]
    docs = frame(spark, [(i, t, "en", "s") for i, t in rows])
    index = exactdedup.insert(exactdedup.create(spark, docs, 4000, per_shard=500, key_bytes=key_bytes), docs, log2=4)
    assert answers(index) == brute_groups(rows)


def test_filters_grow_from_stored_keys_over_inserts_and_deletes(spark):
    first = [(k, f"text {k}") for k in range(300)]
    second = [(k, f"TEXT {k % 800}") for k in range(300, 900)]
    load = lambda rows: frame(spark, [(i, t, "en", "s") for i, t in rows])
    index = exactdedup.create(spark, load(first), 1, per_shard=1000)
    index = exactdedup.insert(index, load(first), log2=5)
    small = index.filters.agg(F.max("log2")).first()[0]
    index = exactdedup.insert(index, load(second), log2=5)
    assert index.filters.agg(F.max("log2")).first()[0] > small >= 5
    assert answers(index) == brute_groups(first + second)
    gone = [(k, f"Text {k % 800}") for k in range(350, 700)]
    index = exactdedup.delete(index, load([*gone, (1, "not that text"), (77777, "text 3")]))
    left = [r for r in first + second if (r[0], low(r[1])) not in {(i, low(t)) for i, t in gone}]
    assert answers(index) == brute_groups(left)
    live = {low(t) for _, t in left}
    assert index.filters.agg(F.sum("live")).first()[0] == len(live)
    asked = load([(k, f"teXt {k}") for k in range(420)])
    assert {tuple(r) for r in exactdedup.contains(index, asked).collect()} == {(k, f"text {k}" in live) for k in range(420)}
    index = exactdedup.reshard(index, 7)
    assert answers(index) == brute_groups(left)
    assert index.filters.count() == 7 and index.filters.agg(F.sum("live")).first()[0] == len(live)
    index = exactdedup.insert(index, load(gone))
    assert answers(index) == brute_groups(left + gone)


def test_cuckoo_filter_forgets_only_what_it_was_told():
    keys = [hashlib.sha256(str(k).encode()).digest() for k in range(3000)]
    known = exactdedup.CuckooFilter.of(keys[:2000], 4)
    assert known.live == 2000 and len(known.slots) < 3 * 2000 * exactdedup.SLOTS
    assert all(k in known for k in keys[:2000])
    assert sum(k in known for k in keys[2000:]) < 10
    assert all(known.remove(k) for k in keys[:1000])
    again = exactdedup.CuckooFilter(known.log2, known.slots.tobytes(), known.live)
    assert all(k in again for k in keys[1000:2000]) and sum(k in again for k in keys[:1000]) < 10
    assert again.live == 1000 and sum(1 for s in again.slots if s) == 1000


def test_exact_duplicates_of_nothing(spark):
    assert exactdedup.exact_duplicates(frame(spark, [])).collect() == []
    assert exactdedup.contains(exactdedup.create(spark, frame(spark, []), 0), frame(spark, [(1, "a", "", "")])).collect() == [(1, False)]


# divergence


def brute_divergence(rows, min_docs, top=50):
    terms = lambda t: re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low(t))
    rows = [(low_none(lang), low_none(source), Counter(terms(text))) for text, lang, source in rows]
    out = []
    for lang in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == lang]
        df = Counter(t for _, _, c in mine for t in c)
        kept = sorted(t for t, n in df.items() if n >= min_docs)
        counts = {s: Counter() for _, s, _ in mine}
        for _, s, c in mine:
            counts[s].update({t: n for t, n in c.items() if t in set(kept)})
        price = lambda c: {t: 1 + 10**9 * (c[t] + 5) // (sum(c.values()) + 5 * len(kept)) for t in kept}
        p = {s: price(c) for s, c in counts.items()}
        q = price(sum(counts.values(), Counter()))
        for s in counts:
            pairs = [(o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in counts if o != s]
            words = [(t, p[s][t] - q[t]) for t in kept if counts[s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", words, top)):
                best = sorted(found, key=lambda x: (-x[1], x[0].encode()))[:most]
                out += [(lang, s, part, item, value, rank) for rank, (item, value) in enumerate(best, 1)]
    return sorted(out)


def low_none(x):
    return x if x is not None else ""


def audited(spark, rows, min_docs):
    docs = frame(spark, [(k, *r) for k, r in enumerate(rows)])
    return sorted(tuple(r) for r in divergence.divergence(docs, min_docs=min_docs).collect())


def prose(seed, n, many=60):
    rng = np.random.default_rng(seed)
    words = ["".join(x) for x in itertools.product("bdk", "aeé", ("st", "n", "ra", "ß"), ("", "o"))]
    return " ".join(words[min(int(x), many)] for x in rng.exponential(12, n))


@pytest.mark.parametrize("groups", [divergence.GROUPS, 2])
def test_divergence_matches_brute_force(spark, monkeypatch, groups):
    monkeypatch.setattr(divergence, "GROUPS", groups)
    monkeypatch.setattr(divergence, "FLUSH", 50)
    rows = [(prose(k, 5 + k % 40), "en" if k % 3 else "fr", f"site{k % 7}") for k in range(200)]
    rows += [(None, "en", None), ("", None, "site1"), ("A b-A 9b", None, None), ("lone", "xx", "only"), ("", "xx", "two"), ("one1two", "en", "bare")]
    rows += [rows[0]] * 3
    assert audited(spark, rows, 4) == brute_divergence(rows, 4)


def test_divergence_without_rows_or_terms(spark):
    assert audited(spark, [], 1) == []
    assert audited(spark, [("", "en", "a"), (None, "en", "b")], 1) == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]


def test_joint_tables_count_every_term_once(spark):
    rows = [(prose(k, 30), "en", f"site{k % 3}") for k in range(60)]
    levels = divergence.Levels(frame(spark, [(k, *r) for k, r in enumerate(rows)]), 2)
    tables = divergence.joint_tables(levels)
    kept = levels.terms.count()
    assert [r[0] for r in tables.groupBy("source", "other").agg(F.sum("terms")).select(F.col("sum(terms)")).collect()] == [kept] * 6
    counts = {(r.source, bytes(r.term)): r.n for r in levels.cells.collect()}
    names = [bytes(r.term) for r in levels.terms.collect()]
    expect = Counter((a, counts.get((a, t), 0), b, counts.get((b, t), 0)) for t in names for a, b in itertools.permutations(["site0", "site1", "site2"], 2))
    assert {(r.source, r.level, r.other, r.other_level): r.terms for r in tables.collect()} == expect


# ranked search


def brute_ranks(docs, items, k):
    terms = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low(t))
    bags = [(i, Counter(terms(t))) for i, t in docs]
    n_docs, total = sum(bool(c) for _, c in bags), sum(sum(c.values()) for _, c in bags)
    df = Counter(t for _, c in bags for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c in bags:
            score, n = 0, sum(c.values())
            for t in set(terms(text)) & set(c):
                m = 10 + (90 * n * n_docs) // total
                score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, rank, i, -score) for rank, (score, _, _, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out)


def searched(spark, docs, items, k=10, **more):
    left = frame(spark, [(i, t, "en", "s") for i, t in docs])
    right = spark.createDataFrame([(i, t, 1, 2, "z") for i, t in items], "item_id long, text string, doc_id long, score long, _n string")
    return sorted(tuple(r) for r in ranked.ranked_search(left, right, k, **more).collect())


def library(n=300):
    docs = [(k, prose(k, 3 + (7 * k) % 60)) for k in range(n)]
    docs += [(n, None), (n + 1, ""), (n + 2, "..."), (n + 3, docs[4][1]), (n + 4, docs[4][1].upper()), (n + 3, docs[4][1]), (n + 5, "bast " * 30_000)]
    items = [(k, prose(5000 + k, 12)) for k in range(20)] + [(90, docs[4][1]), (91, None), (92, "unknown words"), (93, ""), (94, "bast")]
    return docs, items


@pytest.mark.parametrize("k", [1, 10, 500])
def test_ranks_match_brute_force(spark, k):
    docs, items = library()
    assert searched(spark, docs, items, k) == brute_ranks(docs, items, k)


def test_ranks_in_blocks_and_slices(spark, monkeypatch):
    monkeypatch.setattr(ranked, "EXPANDED", 50)
    docs, items = library(120)
    assert searched(spark, docs, items, block_pairs=60) == brute_ranks(docs, items, 10)


def test_ranks_of_nothing(spark):
    assert searched(spark, [], [(1, "a")]) == [] == searched(spark, [(1, "a")], [])
    assert searched(spark, [(1, None), (2, "")], [(1, "a")]) == []


def test_null_ids_come_last_among_equals(spark):
    docs = [(None, "rare word"), (9, "rare word"), (3, "rare word"), *((k, "plain") for k in range(20, 40))]
    assert [r[2] for r in searched(spark, docs, [(1, "rare")])] == [3, 9, None]


def test_accumulators_stop(spark):
    """Documents that hold only an item's frequent terms get no accumulator once ten hold its rare ones."""
    docs = [(k, "alpha beta gamma delta common") for k in range(12)] + [(k, f"common filler{k} other{k}") for k in range(12, 400)]
    block = spark.createDataFrame([(1, [b"alpha", b"beta", b"common", b"delta", b"gamma"])], "_uid long, _terms array<binary>")
    seen = []
    keep = ranked.written
    try:
        ranked.written = lambda df, name: seen.append((name, keep(df, name))) or seen[-1][1]
        ranked._search_block(frame(spark, [(i, t, "en", "s") for i, t in docs]), block, 10).collect()
    finally:
        ranked.written = keep
    last = seen[-1][1]
    assert last.agg(F.sum(F.size("items"))).first()[0] == 12


@pytest.mark.parametrize("name", ["op11_exact_dedup", "op12_source_divergence", "op13_ranked_search"])
def test_queries_equal_their_sql(spark, sf_dir, name):
    import oracle

    assert oracle.difference(queries.QUERIES[name](spark, sf_dir), oracle.connect(sf_dir), queries.ORACLES[name]) is None
