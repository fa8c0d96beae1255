from __future__ import annotations

import datetime as dt
import hashlib
import itertools
import os
import re
import subprocess
import sys
import time
import zlib
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from rowforge.llm import ann, chat, decontaminate, html_text, langid, linededup, neardup, packing, pii, toxicity

WORDS = [f"{a}{b}{c}" for a, b, c in itertools.product("bdklmr", "aeiou", ("st", "n", "ra", "p"))]


def prose(seed: int, n: int) -> list[str]:
    return np.random.default_rng(seed).choice(WORDS, n).tolist()


def documents(spark, texts):
    rows = [(k, t, "en", f"site{k % 3}", len(t or ""), "x") for k, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, key string")


# near duplicates


def brute_components(texts, top=75):
    def shingles(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", t.translate({c: c + 32 for c in range(65, 91)})) if t else []
        return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()

    sets = [shingles(t) for t in texts]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(range(len(texts)), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= top * len(sets[a] | sets[b]):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return [(k, len(s), find(k), find(k) == k) for k, s in enumerate(sets)]


def test_near_duplicates_match_brute_force(spark):
    texts = [None, "", "  \n", "one two", "One  TWO", "one two three"]
    for seed in range(12):
        words = prose(seed, 60 + 7 * seed)
        texts.append(" ".join(words))
        for k in range(1, 6):
            changed = list(words)
            for at in np.random.default_rng(100 * seed + k).integers(0, len(words), k):
                changed[at] = "other"
            texts += [" ".join(changed), " ".join(changed)]
    out = neardup.near_duplicates(documents(spark, texts))
    assert sorted(tuple(r) for r in out.collect()) == brute_components(texts)


def test_near_duplicates_of_nothing(spark):
    assert neardup.near_duplicates(documents(spark, ["x"]).limit(0)).collect() == []


def near_copies(size: int, share: float, words: int = 120) -> list[str]:
    """Copies of one text with this share of its words replaced, each in places of its own."""
    base = prose(4, words)
    out = []
    for k in range(size):
        rng = np.random.default_rng(1000 + k)
        changed = list(base)
        for at in rng.choice(words, round(share * words), replace=False):
            changed[at] = f"w{rng.integers(10**6)}"
        out.append(" ".join(changed))
    return out


@pytest.mark.parametrize("share", [0.017, 0.03, 0.05])
def test_a_group_of_near_copies_matches_brute_force(spark, share):
    """Links of all, some and few pairs of a group; what is apart after the rounds is compared in full."""
    texts = near_copies(60, share) + near_copies(20, 0.0) + [" ".join(prose(9, 50))]
    out = neardup.near_duplicates(documents(spark, texts))
    assert sorted(tuple(r) for r in out.collect()) == brute_components(texts)


def test_confirmed_pairs_grow_with_a_group_and_not_with_its_square(spark, monkeypatch):
    """Two words of 160 replaced: most pairs reach the threshold."""
    keep = neardup.written
    confirmed = {}
    for size in (500, 1000, 2000):
        seen = confirmed.setdefault(size, [])  # all pairs written: proposed, nearest, still apart

        def written(df, name, seen=seen):
            out = keep(df, name)
            seen.extend([out.count()] * (name in ("nearest", "pairs")))
            return out

        monkeypatch.setattr(neardup, "written", written)
        out = neardup.near_duplicates(documents(spark, near_copies(size, 0.0125, 160)))
        assert out.agg(F.countDistinct("component_id")).first()[0] == 1
    counts = {size: sum(n) for size, n in confirmed.items()}
    assert all(n < 120 * size for size, n in counts.items()) and counts[2000] < 6 * counts[500], counts


def test_ids_that_repeat_and_texts_that_differ(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (2, "A b  c d e f"), (3, "x"), (3, "y"), (None, "x"), (4, None), (5, " "), (6, "\u00c9 x"), (7, "\u00e9 x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'k' AS key", "1 AS cls", "2 AS band")
    out = sorted(tuple(r) for r in neardup.near_duplicates(docs).collect())
    assert out == [(1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False), (3, 1, 3, True), (3, 1, 3, True), (4, 0, 4, True), (5, 0, 5, True), (6, 1, 6, True), (7, 1, 7, True)]


def test_odd_sketch_distance_follows_difference():
    a = np.arange(1, 1001, dtype=np.uint64) * np.uint64(7919)
    sketch = neardup.odd_sketch(neardup.minima(neardup._mix(a)))
    near = neardup.odd_sketch(neardup.minima(neardup._mix(a[:900])))
    far = neardup.odd_sketch(neardup.minima(neardup._mix(a[:200])))
    bits = [int(np.unpackbits(sketch ^ x).sum()) for x in (near, far)]
    assert bits[0] < neardup.sketch_distance(0.75) < bits[1]


# packing


def test_packing_keeps_every_piece_in_place(spark):
    lengths = np.random.default_rng(5).integers(1, 101, 700).tolist() + [100] * 90 + [50] * 40
    rows = [(k, 0, n) for k, n in enumerate(lengths)]
    out = packing.assign(spark.createDataFrame(rows, "doc_id long, piece int, length long"), 100).collect()
    assert sorted((r.doc_id, r.length) for r in out) == sorted((k, n) for k, _, n in rows)
    for _, own in itertools.groupby(sorted(out, key=lambda r: (r.sequence_id, r.offset)), key=lambda r: r.sequence_id):
        at = 0
        for r in own:
            assert r.offset == at
            at += r.length
        assert at <= 100
    used = len({r.sequence_id for r in out})
    assert used <= 1.02 * -(-sum(lengths) // 100) + 1


def test_pieces_round_trip(spark):
    from tokenizers import Tokenizer

    from rowforge.llm.queries import tokenizer_path

    texts = [None, "", "Über den Wald", " ".join(prose(1, 900)), "<|endoftext|>"]
    own = Tokenizer.from_file(tokenizer_path())
    found: dict[int, list[int]] = {}
    for r in sorted(packing.pieces(documents(spark, texts), tokenizer_path(), 64).collect()):
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert r.start == len(found.get(r.doc_id, [])) and r.length == len(ids) <= 64
        found.setdefault(r.doc_id, []).extend(ids)
    assert found == {k: own.encode(t or "", add_special_tokens=False).ids + [0] for k, t in enumerate(texts)}


def test_pieces_of_texts_in_several_runs(spark):
    """Texts are encoded in runs of a bounded number of characters; each keeps its own ids."""
    from rowforge.llm.queries import tokenizer_path

    words = prose(3, 400)
    texts = [" ".join(words[k:] * (1500 if k % 3 == 0 else 1)) for k in range(7)] + [None, "x" * 5]
    found: dict[int, bytes] = {}
    for r in sorted(packing.pieces(documents(spark, texts).coalesce(1), tokenizer_path(), 2048).collect()):
        found[r.doc_id] = found.get(r.doc_id, b"") + r.ids
    alone: dict[int, bytes] = {}
    for r in sorted(packing.pieces(documents(spark, texts).repartition(9, "doc_id"), tokenizer_path(), 2048, by_words=False).collect()):
        alone[r.doc_id] = alone.get(r.doc_id, b"") + r.ids
    assert sum(len(t or "") for t in texts) > 3 << 20 and found == alone and len(found) == 9


# line dedup


def test_boilerplate_leaves_and_copies_stay(spark):
    body = [" ".join(prose(k, 30)) for k in range(6)]
    rows = [(k, f"All rights reserved\n{body[k]}\n\n", f"s{k}") for k in range(5)]
    rows += [(10 + k, body[5], f"s{k}") for k in range(5)] + [(20, None, "s1"), (21, "", None), (22, "All rights reserved", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = {r.doc_id: r for r in linededup.remove_boilerplate(docs, 4).collect()}
    assert all(out[k].text == f"{body[k]}\n\n" and out[k].n_removed == 1 for k in range(5))
    assert all(out[10 + k].text == body[5] for k in range(5))
    assert (out[20].text, out[21].text, out[22].text) == (None, "", "All rights reserved")


def test_wide_lines_leave_documents_with_little_of_their_own(spark):
    wide = " ".join(prose(1, 60))
    rows = [(k, f"{wide}\nown {k}", f"s{k}") for k in range(5)] + [(9, wide, "s1"), (10, None, "s1")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = {r.doc_id: (r.text, r.n_removed) for r in linededup.remove_boilerplate(docs, 4, None).collect()}
    assert out == {**{k: (f"own {k}", 1) for k in range(5)}, 9: (wide, 0), 10: (None, 0)}


def test_pipeline_removes_wide_lines_beyond_half(spark):
    import corpus_pipeline

    wide = " ".join(prose(1, 60))
    docs = documents(spark, [f"{wide}\nown {k}" for k in range(9)]).withColumn("source", F.concat(F.lit("s"), F.col("doc_id")))
    assert {r.text for r in corpus_pipeline.drop_boilerplate_lines(spark, docs, "").collect()} == {f"own {k}" for k in range(9)}


def test_whole_pipeline_against_brute_force(spark, tmp_path):
    import corpus_pipeline
    from rowforge.llm.queries import tokenizer_path
    from tokenizers import Tokenizer

    footer = " ".join(prose(4242, 12))
    items = [prose(900 + k, 24) for k in range(4)]
    texts, toxic = [], set()
    for k in range(300):
        words = prose(k, 60)
        if k % 5 == 1:
            words[7] = "gravolix"
            toxic.add(k)
        texts.append(" ".join(words))
    clean = [k for k in range(300) if k not in toxic]
    for k in clean[:20]:
        texts[k] += "\n" + footer
    leaks = {k: items[n] for n, k in enumerate(clean[30:34])}
    for k, item in leaks.items():
        texts[k] = " ".join([texts[k], *item, *prose(5000 + k, 60)])
    copies = [texts[k].upper() if n % 2 else texts[k] + " end" for n, k in enumerate(clean[50:60])]
    texts += [*copies, None, ""]
    docs = documents(spark, texts).withColumn("source", F.concat(F.lit("s"), F.col("doc_id"))).drop("key")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    labels = [(k, 3, int(k in toxic)) for k in range(300)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(items)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))

    left = {k: t and t.removesuffix("\n" + footer) for k, t in enumerate(texts) if k not in toxic}
    ids = list(left)
    firsts = [ids[k] for k, _, _, kept in brute_components([left[k] for k in ids]) if kept]
    encoder = Tokenizer.from_file(tokenizer_path())
    want = {k: len(encoder.encode(left[k] or "", add_special_tokens=False).ids) + 1 for k in firsts if k not in leaks}
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id: r.length for r in got} == want and len(got) == len(want)
    for _, rows in itertools.groupby(sorted(got, key=lambda r: (r.sequence_id, r.offset)), key=lambda r: r.sequence_id):
        at = 0
        for r in rows:
            assert r.offset == at
            at += r.length
        assert at <= 2048


# decontamination


def test_leaks_and_paraphrases(spark):
    items = [prose(900 + k, 24) for k in range(8)]
    texts, truth = [None, ""], set()
    for k in range(60):
        words = prose(k, 150)
        if k < 8:
            words[k * 9 : k * 9] = items[k]
            truth.add((k + 2, k))
        elif k < 16:
            loose = [w for n, w in enumerate(items[k - 8]) if n % 8]  # every eighth word gone
            words[40:40] = loose
            truth.add((k + 2, k - 8))
        texts.append(" ".join(words))
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(items)] + [(90, None), (91, "")], "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in decontaminate.leaks(documents(spark, texts), bench).collect()}
    assert found == truth


def test_paraphrases_with_their_answer(spark):
    rng = np.random.default_rng(8)
    texts, items, truth = [], [], set()
    for k in range(100):
        share, size = (0.5, 0.55, 0.6, 0.7)[k % 4], 20 + k % 40
        item = prose(3000 + k, size)
        own = np.sort(rng.choice(size - 5, -int(-share * size // 1) - 5, replace=False)).tolist()
        held = {*own, *range(size - 5, size)}
        # every other one loses its words, the others have them replaced
        loose = [w if n in held else f"x{k}{n}" for n, w in enumerate(item) if n in held or k % 2]
        words = prose(k, 200)
        words[90:90] = loose
        items.append((k, " ".join(item)))
        texts.append(" ".join(words))
        truth.add((k, k))
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in decontaminate.leaks(documents(spark, texts), bench).collect()} == truth


def test_leaks_in_a_table_of_one_document_and_of_long_items(spark):
    item, long = prose(1, 24), [f"w{k % 7}{k}" for k in range(1500)]
    loose = [w for n, w in enumerate(item) if n % 8]
    bench = spark.createDataFrame([(1, " ".join(item[:8])), (2, " ".join(item)), (3, " ".join(long))], "item_id long, text string")
    found = [decontaminate.leaks(documents(spark, [" ".join(prose(2, 40) + x + prose(3, 40))]), bench) for x in (item[:8], loose, [w for n, w in enumerate(long) if n % 5])]
    assert [{r.item_id for r in f.collect()} for f in found] == [{1}, {1, 2}, {3}]


def test_common_subsequence_by_dynamic_programme():
    rng = np.random.default_rng(2)
    for _ in range(50):
        a, b = rng.integers(0, 5, 12).tolist(), rng.integers(0, 5, 15).tolist()
        t = np.zeros((13, 16), int)
        for i, j in itertools.product(range(12), range(15)):
            t[i + 1, j + 1] = t[i, j] + 1 if a[i] == b[j] else max(t[i, j + 1], t[i + 1, j])
        assert decontaminate.common_in_order(a, b) == t[12, 15]


def test_windows_without_the_words_are_not_aligned(monkeypatch):
    item = list(range(20))
    assert decontaminate.matches(item, item, 0.75, 5) == 1.0
    assert decontaminate.matches(item, [*range(5, 10), 99, *range(10, 20)], 0.75, 5) == 0.75
    assert decontaminate.matches(item, [*range(10, 20), 99], 0.75, 5) == 0.5

    def never(item, window):
        raise AssertionError("aligned")

    monkeypatch.setattr(decontaminate, "common_in_order", never)
    # half of the words without the answer, and the answer without half of the words, many times each
    assert decontaminate.matches(item, list(range(10)) * 4, 0.75, 5) == 0.0
    assert decontaminate.matches(item, list(range(15, 20)) * 8, 0.75, 5) == 0.0


def test_sums_over_passages_are_those_word_by_word():
    rng = np.random.default_rng(4)
    ids = np.minimum(rng.zipf(1.4, 3000), 400).astype(np.uint16)
    owner, y = np.sort(rng.integers(0, 1100, 3000)), rng.standard_normal((1100, 3)).astype(np.float32)
    total, plain = np.zeros((401, 3)), np.zeros((401, 3))
    decontaminate._add_passages(total, ids, owner, y)
    np.add.at(plain, ids, y[owner])
    assert np.allclose(total, plain, atol=1e-3)


def test_items_are_found_in_every_text_of_a_run(spark):
    items = [prose(s, 30) for s in (70, 71)]
    # short, empty and long texts side by side; the item at the beginning, at the end, and cut between two texts
    texts = [" ".join(x) for x in (items[0], prose(72, 3), [], items[1] + prose(73, 900), prose(74, 21_000) + items[0], prose(75, 200) + items[1][:16], items[1][16:] + prose(76, 200))]
    bench = spark.createDataFrame([(k, " ".join(x)) for k, x in enumerate(items)], "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in decontaminate.leaks(documents(spark, texts).coalesce(1), bench).collect()}
    assert found == {(0, 0), (3, 1), (4, 0)}


# nearest neighbours


def test_nearest_recall_and_ties(spark):
    rng = np.random.default_rng(1)
    m = rng.standard_normal((1500, 24)).astype(np.float32)
    m[700:760] = m[3]
    rows = [(k, v.tolist()) for k, v in enumerate(m)] + [(5000, None), (5050, [0.0] * 24), (5100, [float("nan")] * 24), (5150, [1.0])]
    out = ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    unit = m.astype(float) / np.linalg.norm(m.astype(float), axis=1, keepdims=True)
    hit = total = 0
    for q in range(0, 1500, 50):
        score = unit @ unit[q]
        score[q] = -9
        best = np.lexsort((np.arange(1500), -np.round(score, 12)))[:5]
        got = sorted((r for r in out if r.query_id == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in got] == [1, 2, 3, 4, 5]
        assert all(abs(r.score - score[r.vec_id]) < 1e-9 for r in got)
        hit, total = hit + len({r.vec_id for r in got} & set(best.tolist())), total + 5
    assert hit / total >= 0.9 and {r.query_id for r in out} == set(range(0, 1500, 50))
    assert [r.vec_id for r in sorted((r for r in out if r.query_id == 700), key=lambda r: r["rank"])] == [3, 701, 702, 703, 704]


def test_vectors_of_any_size_and_length(spark):
    small = [[1e-200, 2e-200], [1e-200, 2.1e-200], [1e300, -1e300], [5e-324, 1.0], [3.0, 0.5]]
    rows = [(k, v) for k, v in enumerate(small)] + [(50, [1.0, 2.0, 3.0]), (51, [1.0, 2.0, 3.5]), (100, [7.0]), (150, [float("inf"), 1.0]), (200, [])]
    out = ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in out}
    assert [got[0, k][0] for k in range(1, 5)] == [1, 3, 4, 2] and len(got) == 5
    assert got[50, 1][0] == 51 and abs(got[50, 1][1] - 15.5 / (14 * 17.25) ** 0.5) < 1e-12
    assert abs(got[0, 3][1] - 4 / (5 * 9.25) ** 0.5) < 1e-12


# pages


PAGE = """<html><head><title>t</title></head><body><header>Site</header><nav><ul><li>Home</ul></nav>
<div class="cookie-notice">We use cookies</div><article><h1>A &amp; B</h1><p>One<br>two <b>three</b><p>Four
<div class="ad">Buy</div><form>x</form></article><section id="comments"><p>first!</p></section><aside>s</aside><footer>f</footer>
<script>var t="</p><article>";</script></body></html>"""


def test_marked_pages_and_host_repeats(spark):
    own = [" ".join(prose(k, 25)) for k in range(4)]
    menu = "Start News Sport Weather Travel Money Video"
    rows = [(k, "https://h.example/x", f"<div>{menu}</div><div>{own[k]}</div><div>{menu.lower()} end of page</div>") for k in range(3)]
    rows += [(9, "https://h.example/a", PAGE), (10, None, None), (11, "u", ""), (12, "https://other.example/", f"<p>{own[3]}</p>"), (12, "https://other.example/", f"<p>{own[3]}</p>")]
    out = html_text.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    text = {r.page_id: r.text for r in out}
    assert len(out) == 8 and all(r.n_chars == len(r.text) for r in out)
    assert [text[k] for k in range(3)] == own[:3]
    assert text[9] == "A & B\n\nOne two three\n\nFour"
    assert (text[10], text[11], text[12]) == ("", "", own[3])


def test_footers_longer_than_the_articles_leave(spark):
    own, legal = [" ".join(prose(50 + k, 25)) for k in range(4)], " ".join(prose(77, 120))
    rows = [(k, "https://h.example/x", f"<div>{own[k]}</div><div>{legal}</div>") for k in range(4)]
    # the same article read again on another day
    rows.append((9, "https://h.example/y", f"<div>Read on Monday</div><div>{own[3]}</div><div>{legal}</div>"))
    text = {r.page_id: r.text for r in html_text.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert text == {**dict(enumerate(own)), 9: f"Read on Monday\n\n{own[3]}"}


def test_pages_with_an_article_take_part_in_the_search_for_repeats(spark):
    own = [" ".join(prose(200 + k, 40)) for k in range(9)]
    line, plug, foot = " ".join(prose(300, 9)), " ".join(prose(301, 12)), " ".join(prose(302, 20))
    page = lambda *inner: "<article>" + "".join(f"<p>{x}</p>" for x in inner) + f"</article><div>{foot}</div>"
    # a plug in all articles leaves, a line in three of seven stays; no suffix of the page without an article repeats but the articles' rest
    rows = [(k, "https://h.example/x", page(own[k], *([line] if k < 3 else []), plug)) for k in range(7)]
    rows.append((7, "https://h.example/list", f"<div>{own[7]}</div><div>{foot}</div>"))
    # copies of one article under six dates, and a plug in too few articles
    rows += [(20 + k, "https://copies.example/", page(f"Day {k}", own[8], line)) for k in range(6)]
    rows += [(30 + k, "https://few.example/", page(own[k], plug)) for k in range(4)]
    rows += [(40 + k, "https://near.example/", page(f"{own[8]} {k}", line, own[7], plug)) for k in range(6)]
    text = {r.page_id: r.text for r in html_text.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    wanted = {k: "\n\n".join([own[k], *([line] if k < 3 else [])]) for k in range(7)}
    wanted |= {7: own[7]} | {20 + k: "\n\n".join([f"Day {k}", own[8], line]) for k in range(6)}
    wanted |= {30 + k: f"{own[k]}\n\n{plug}" for k in range(4)} | {40 + k: "\n\n".join([f"{own[8]} {k}", line, own[7], plug]) for k in range(6)}
    assert text == wanted


def test_marked_names_leave_the_article():
    text = lambda page: " ".join(b for b, m in zip(*html_text.blocks(page), strict=True) if m)
    assert text('<div class="site-header">S</div><article><header class="entry-header"><h1>A</h1></header><div class="post-header"><h2>B</h2></div><p>C</article>') == "A B C"
    assert text('<article><p class="notice">Buy<p>One</p><p>Two</p></article>') == "One Two"
    assert text('<article><p class="notice">Buy<p>One<p>Two</p></article><p class="ad">x') == "One Two"
    assert text('<main><ul><li>a<li class="share">Buy <b>now<ul><li>in</li></ul><li>b</ul><p>c</p></main>') == "a b c"
    assert text('<main><ul><li class="share">Buy</ul><p>c</p></main>') == "c"
    assert text('<main><table><tr><td class="ad">Buy<td>x<tr><td>y</table><dl><dt>t<dd class="ad">Buy</dl>z</main>') == "x y t z"
    assert text('<article><p>Four <div class="ad">Buy</p><div>in</div></div> five</article>') == "Four five"


def test_names_that_only_look_like_furniture():
    text = lambda page: " ".join(b for b, m in zip(*html_text.blocks(page), strict=True) if m)
    assert text('<article>A<div class="market-share">B</div><div class="social-history">C</div><section class="search">D</section></article>') == "A B C D"
    assert text('<article>A<div class="share-buttons">B</div><div class="social">C</div><div id="related-posts">D</div><p class="x ad-slot">E</p></article>') == "A"
    assert text('<article>A<article class="comment">B<p>C</article><p>D</article>') == "A D"
    assert text('<article class="teaser">A</article><main><p>B</main><article class="related-post">C</article>') == "B"
    page = '<article class="teaser">A b c</article><div>The text</div>'
    assert html_text.blocks(page) == (["The text"], [False])
    # inline elements left out, with others of their name within
    assert text('<article>A <span class="ad">x <span>y</span> z</span> B<span class="ad"/> C <b>D</article>') == "A B C D"


@pytest.mark.parametrize("page", ["<article>" + "<span>x" * 20000 + "</b>" * 20000 + "<p>y</p>" * 20000, "<p><span class=ad>x" * 20000, "<div class=ad>" + "<div>" * 20000 + "</section></b>" * 20000])
def test_unclosed_elements_take_linear_time(page):
    start = time.process_time()
    html_text.blocks(page)
    assert time.process_time() - start < 3


# language


def test_languages(spark):
    kinds = {"aa": "bdklaeou", "bb": "rstnvimu", "cc": "çñéßüzyx"}
    rows = []
    for k in range(180):
        name = list(kinds)[k % 3]
        rng = np.random.default_rng(k)
        rows.append((k, " ".join("".join(rng.choice(list(kinds[name]), rng.integers(2, 8))) for _ in range(rng.integers(15, 400))), name))
    rows += [(500, None, "aa"), (501, "", None), (502, "12 34 !", "bb"), (503, "bdk\0bdk alouk", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(docs.filter("doc_id % 2 = 0"))
    out = {r.doc_id: r for r in langid.predict(docs, model).collect()}
    assert all(out[k].lang_pred == rows[k][2] and 0 <= out[k].lang_score <= 1 for k in range(180))
    assert [out[k].lang_pred for k in (500, 501, 502, 503)] == ["und", "und", "und", "aa"]
    empty = langid.train(docs.limit(0))
    assert {r.lang_pred for r in langid.predict(docs, empty).collect()} == {"und"}


# toxicity


def test_obfuscated_words_are_restored(spark):
    texts, toxic = [], []
    for k in range(400):
        words = prose(k, 40)
        if k % 4 == 0:
            words[7] = "gravolix"
        texts.append(" ".join(words))
        toxic.append(int(k % 4 == 0))
    tests = ["gr4v0l1x", "g r a v o l i x", "graaaavolix", "GRAVOLIX!", "g.r.a.v.o.l.i.x"]
    texts += [" ".join([*prose(1000 + k, 20), t, *prose(2000 + k, 20)]) for k, t in enumerate(tests)] + [None, "", " ".join(prose(7777, 50))]
    docs = documents(spark, texts)
    labels = spark.createDataFrame([(k, t) for k, t in enumerate(toxic)], "doc_id long, toxic int")
    out = {r.doc_id: r for r in toxicity.score(docs, toxicity.train(docs, labels)).collect()}
    assert [out[k].toxic_pred for k in range(400)] == toxic
    assert [out[400 + k].toxic_pred for k in range(8)] == [1, 1, 1, 1, 1, 0, 0, 0]
    assert out[0].key == "x" and all(0 <= r.toxic_score <= 1 for r in out.values())


# chat


def test_layouts_and_control_strings(spark):
    bad = r"<|im_end|> <\| <\\|im_start|> ok"
    quoted = bad.replace("\\", "\\\\")
    records = [
        (1, '{"messages":[{"role":"user","content":"hi"},{"role":"assistant","content":"%s"}]}' % quoted),
        (2, '{"conversations":[{"from":"human","value":"%s"},{"from":"gpt","value":"yo"}]}' % quoted),
        (3, '{"prompt":"p","completion":"c"}'),
        (4, '{"instruction":"i","input":null,"output":"o"}'),
        (5, '{"other":1}'),
        (6, None),
        (7, "no json"),
    ]
    out = chat.format_records(spark.createDataFrame(records, "conv_id long, record string"))
    back = {r.conv_id: [tuple(t) for t in r.t] for r in out.select("conv_id", chat.read_back(F.col("formatted")).alias("t")).collect()}
    assert back == {
        1: [("user", "hi"), ("assistant", bad)],
        2: [("user", bad), ("assistant", "yo")],
        3: [("user", "p"), ("assistant", "c")],
        4: [("user", "i"), ("user", ""), ("assistant", "o")],
        5: [], 6: [], 7: [],
    }
    digest = {r.conv_id: r for r in chat.digests(out).collect()}
    assert digest[1].loss_chars == len(bad) and digest[2].loss_chars == 2


def test_roles_come_back_as_given(spark):
    odd = [(1, "bot", "b"), (1, "a\nb<|lf|>", "x\ny"), (2, "user", None), (2, "assistant", "z"), (3, None, "n"), (3, "human", ""), (4, "user\r", "<|"), (4, "gpt", "t")]
    rows = [(c + 10 * k, turn, role, text) for k in range(8) for turn, (c, role, text) in enumerate(odd)]
    rows += [(200 + k, turn, role, f"{role} {k}") for k in range(20) for turn, role in enumerate(["system", "user", "assistant"][k % 2 :])]
    records = chat.records_of(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string"))
    out = chat.format_records(records, ready="turns")
    assert out.select("fingerprint").distinct().count() == 5
    back = {r.conv_id: [tuple(t) for t in r.t] for r in out.select("conv_id", chat.read_back(F.col("formatted")).alias("t")).collect()}
    want = {}
    for conv, _, role, text in rows:
        want.setdefault(conv, []).append((role or "user", text or ""))
    assert back == want
    assert {r.conv_id: r.loss_chars for r in chat.digests(out).collect()} == {c: sum(len(x) for r, x in said if r == "assistant") for c, said in want.items()}


def test_conversations_too_long_for_a_record_keep_their_turns(spark, monkeypatch):
    rows = [(1, 0, "user", "long " * 30), (1, 1, "assistant", None), (2, 0, "user", "s")]
    conversations = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    monkeypatch.setattr(chat, "LIMIT", 100)
    out = chat.format_records(chat.records_of(conversations), ready="turns")
    back = {r.conv_id: (r.record is None, [tuple(t) for t in r.t]) for r in out.select("conv_id", "record", chat.read_back(F.col("formatted")).alias("t")).collect()}
    assert back == {1: (True, [("user", "long " * 30), ("assistant", "")]), 2: (False, [("user", "s")])}


def test_columns_of_the_same_name_do_not_clash(spark):
    records = spark.createDataFrame([(1, '{"prompt":"p","completion":"c"}', "x", "y")], "conv_id long, record string, formatted string, _turns string")
    row = chat.format_records(records).collect()[0]
    assert row["_turns"] == "y" and row.formatted.startswith("<|im_start|>user\np")


def test_records_too_long_to_parse_fail(spark, monkeypatch):
    monkeypatch.setattr(chat, "LIMIT", 30)
    fine = spark.createDataFrame([(1, "no json"), (2, '{"prompt":"p","completion":"a longer one"}')], "conv_id long, record string")
    assert len(chat.format_records(fine).collect()) == 2
    with pytest.raises(Exception, match="longer than a variant"):
        chat.format_records(spark.createDataFrame([(1, "x" * 31)], "conv_id long, record string")).collect()


# pseudonyms


@pytest.mark.parametrize("kind", ["card", "mail"])
def test_pseudonyms_keep_format_and_links(spark, kind):
    first = {"card": "4111 1111 1111 1111", "mail": "ann.lee7@mail.example"}[kind]
    second = {"card": "4111-1111-1111-1111", "mail": "Ann.Lee7@mail.example"}[kind]
    docs = documents(spark, [f"a {first} b", f"c {second}.", None, "", "plain words"])
    out = {r.doc_id: r.text for r in pii.pseudonymise(docs, "k").collect()}
    one, two = out[0][2:-2], out[1][2:-1]
    assert one != first and len(one) == len(first)
    assert "".join(filter(str.isalnum, one)) == "".join(filter(str.isalnum, two))
    assert (out[2], out[3], out[4]) == (None, "", "plain words")
    if kind == "card":
        d = [int(c) for c in reversed(one) if c.isdigit()]
        assert (sum(d[::2]) + sum(x * 2 % 10 + x // 5 for x in d[1::2])) % 10 == 0


def plain_feistel(left, right, sizes, key, kind):
    for k in range(8):
        def noise(other, size):
            mark = f"{key}:{kind}:{k}:{sizes[0]}:{sizes[1]}:{other}"
            return int(hashlib.sha256(mark.encode()).hexdigest()[:14], 16) % size  # noqa: B023

        if k % 2 == 0:
            left = (left + noise(right, sizes[0])) % sizes[0]
        else:
            right = (right + noise(left, sizes[1])) % sizes[1]
    return left, right


def plain_pseudonym(kind, found, key):
    number = re.sub(r"\D", "", found)
    if kind == "phone":
        new = iter(number[:-10] + "%05d%05d" % plain_feistel(int(number[-10:-5]), int(number[-5:]), (10**5, 10**5), key, kind))
        return re.sub(r"\d", lambda _: next(new), found)
    if kind == "social":
        group, serial = plain_feistel(int(found[4:6]) - 1, int(found[7:]) - 1, (99, 9999), key, kind)
        return f"{found[:3]}-{group + 1:02d}-{serial + 1:04d}"
    if kind == "address":
        a, b, c, d = map(int, found.split("."))
        one, two = plain_feistel(a * 256 + b, c * 256 + d, (65536, 65536), key, kind)
        return f"{one // 256}.{one % 256}.{two // 256}.{two % 256}"
    day = dt.date.fromisoformat(found) if found[4] == "-" else dt.date(int(found[6:]), int(found[3:5]), int(found[:2]))
    place = (day - dt.date(1900, 1, 1)).days
    one, two = plain_feistel(place // 229, place % 229, (319, 229), key, kind)
    new = dt.date(1900, 1, 1) + dt.timedelta(one * 229 + two)
    return new.isoformat() if found[4] == "-" else new.strftime(f"%d{found[2]}%m{found[5]}%Y")


def test_every_kind_equals_a_plain_feistel_network(spark):
    given = [
        ("phone", "415 555 2671"), ("phone", "(415) 555-2671"), ("phone", "+44 415-555-2671"), ("social", "123-45-6789"), ("social", "899-01-0001"),
        ("address", "10.20.30.40"), ("address", "255.255.255.255"), ("address", "0.0.0.0"), ("date", "2021-03-04"), ("date", "04/03/2021"), ("date", "04.03.2021"), ("date", "1900-01-01"), ("date", "2099-12-31"),
    ]
    kept = ["2021-02-30", "31.02.2021", "256.1.1.1", "000-12-3456", "4111 1111 1111 1112", None, ""]
    docs = documents(spark, [f"x {v} y" for _, v in given] + kept).withColumn("_found", F.lit("mine"))
    out = {r.doc_id: r for r in pii.pseudonymise(docs, "k").collect()}
    assert [out[k].text for k in range(len(given))] == [f"x {plain_pseudonym(kind, v, 'k')} y" for kind, v in given]
    assert [out[len(given) + k].text for k in range(len(kept))] == kept
    assert {r["_found"] for r in out.values()} == {"mine"} and out[0].n_candidates == 1


def test_cards_beside_other_numbers_keep_their_link(spark):
    shapes = ["{}", "{} 123", "{} 12/27", "7 {}", "12 {} 123", "1234 {}", "{} {}", "{} 2024-05-01", "{} 555-123-4567", "{} 1234567@x.example"]
    texts = [x.replace("{}", c) for x in shapes for c in ("4111111111111111", "4111 1111 1111 1111")] + ["41111111 11111111 123", "3782 822463 10005 1234", "1 2 3 4 5 6"]
    out = [r.text for r in pii.pseudonymise(documents(spark, texts), "k").orderBy("doc_id").collect()]
    new = {"4111111111111111": out[0], "4111 1111 1111 1111": out[1]}
    assert new["4111 1111 1111 1111"].replace(" ", "") == out[0] != "4111111111111111"
    for before, after in zip(texts[:-3], out, strict=False):
        for c in new:
            before = before.replace(c, new[c])
        kept = len(before) if before[-1] != "1" and before[-4:] != "4567" and "@" not in before else len(out[0])
        assert after[:kept] == before[:kept] and len(after) == len(before)
        assert before.endswith(("123", "12/27")) or kept == len(before) or after != before
    assert out[-3] == f"{out[0][:8]} {out[0][8:]} 123" and out[-2].endswith(" 1234") and out[-2] != texts[-2] and out[-1] == texts[-1]


def test_feistel_permutes_its_domain(spark):
    n = spark.range(319 * 229).select(pii.feistel(F.floor(F.col("id") / 229), F.col("id") % 229, F.lit(319), F.lit(229), "k", "date").alias("x"))
    assert n.distinct().count() == 319 * 229
    assert n.filter("x.l not between 0 and 318 or x.r not between 0 and 228").isEmpty()


def test_crc_of_pieces(spark):
    ids = np.arange(5, dtype="<u4").tobytes()
    assert spark.range(1).select(F.crc32(F.lit(ids))).first()[0] == zlib.crc32(ids)


def test_names_of_one_letter_are_keyed(spark):
    mails = [f"{c}@one.example" for c in "abcxyz019"]
    docs = spark.createDataFrame([(k, f"write to {m} now") for k, m in enumerate(mails)], "doc_id long, text string")
    found = {key: [r.text.split()[2] for r in pii.pseudonymise(docs, key).orderBy("doc_id").collect()] for key in ("one", "two", "three", "four")}
    for out in found.values():
        assert all(a != b and re.fullmatch(r"[a-z0-9]@one\.example", a) for a, b in zip(out, mails, strict=True))
        assert len(set(out)) == len(mails)
    assert len({tuple(out) for out in found.values()}) > 1


APART = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
from rowforge.llm import langid, toxicity
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
rows = [(k, ("the cat and the dog " if k % 2 else "le chat et le chien ") * 5 + "abcdefghij"[k // 20] * (1 + k % 20) + (" vilest" if k % 5 == 0 else ""), "en" if k % 2 else "fr") for k in range(200)]
docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
model = langid.train(docs)
right = langid.predict(docs.select("doc_id", "text", "lang"), model).filter("lang = lang_pred").count()
labels = spark.createDataFrame([(k, int(k % 5 == 0)) for k in range(200)], "doc_id long, toxic int")
caught = toxicity.score(docs, toxicity.train(docs, labels)).filter("toxic_pred = 1").count()
print("RESULT", right, caught)
"""


def test_workers_need_no_copy_of_the_package(tmp_path):
    """Workers get PYTHONPATH and the working directory from the driver, but not its sys.path."""
    env = {k: v for k, v in os.environ.items() if k not in ("PYTHONPATH", "PYSPARK_PYTHON")} | {"PYSPARK_PYTHON": sys.executable}
    root = str(Path(__file__).resolve().parents[2])
    ended = subprocess.run([sys.executable, "-c", APART.format(root=root)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "RESULT 200 40" in ended.stdout, ended.stderr[-3000:]


def test_operators_hold_few_texts_of_a_large_batch(spark):
    """What is made of one Arrow batch of all texts comes back in small batches."""
    import pyarrow as pa

    class Rows:
        """Stands for a frame and its session; the function of a pass is taken from it."""

        def __init__(self):
            self.columns, self.sparkSession, self.sparkContext = ["doc_id", "text"], self, self
            self.schema = documents(spark, []).select("doc_id", "text").schema

        def select(self, *columns):
            return self

        def broadcast(self, value):
            return type("Sent", (), {"value": value})

        def mapInArrow(self, function, schema):  # noqa: N802
            return function

    batch = pa.RecordBatch.from_arrays([pa.array(range(5000), pa.int64()), pa.array(["a bad word"] * 5000)], ["doc_id", "text"])
    model = toxicity.ToxicityModel(toxicity.CharModel(np.ones(1 << toxicity.TRI_BITS, np.int64), np.ones(1 << toxicity.BI_BITS, np.int64)), {"bad": 0.9}, 0.1)
    for function in (toxicity.score(Rows(), model), decontaminate._hashes):
        out = list(function(iter([batch])))
        assert sum(b.num_rows for b in out) == 5000 and max(b.num_rows for b in out) <= 1024
    assert [x for b in toxicity.score(Rows(), model)(iter([batch])) for x in b.column(3).to_pylist()] == [1] * 5000


def test_the_character_model_remembers_a_bounded_number_of_costs():
    model = toxicity.CharModel(np.ones(1 << toxicity.TRI_BITS, np.int64), np.ones(1 << toxicity.BI_BITS, np.int64))
    costs = [model.cost("a", chr(0x4E00 + k % 500), chr(0x4E00 + k // 500)) for k in range(201_000)]
    assert len(model.memo) <= 200_000 and costs[0] == model.cost("a", chr(0x4E00), chr(0x4E00))
