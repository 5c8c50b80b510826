"""Substring dedup, n-gram join, winnowing and components against brute force."""

import random

import numpy as np
import pytest
from conftest import SF_MID
from fixtures_llm import DOCS, edge_docs, edge_rows, id_text, same

from panelcast.llm import exchange, graph, ngram_join, substring_dedup, winnowing
from panelcast.llm.words import ALNUM, VISIBLE, doc_windows, window_hashes, word_hashes

ITEMS = [(1, "alpha Beta"), (2, None), (3, ""), (None, "eta zeta"), (4, "日本"), (2, "two words"), (2, "two words")]


def test_word_hashes_do_not_depend_on_slices(monkeypatch):
    from panelcast.llm import words
    texts = [t.encode() for t in ("a bb  ccc", "", "bb a", "x " * 5000, "\n ccc\t")]
    h, n = word_hashes(texts)
    monkeypatch.setattr(words, "SLICE", 16)
    h2, n2 = word_hashes(texts)
    assert n.tolist() == [3, 0, 2, 5000, 1] == n2.tolist() and (h == h2).all()
    assert h[0] == h[4] and h[1] == h[3] and h[2] == h[-1] and len(set(h[:3].tolist())) == 3
    assert word_hashes([b"A-b"], ALNUM, lower=True)[0].tolist() == word_hashes([b"a b"], ALNUM)[0].tolist()


def test_windows_are_position_free_and_stay_in_documents():
    w, n = word_hashes([b"q a b c", b"a b c z a b c", b"a b"], VISIBLE)
    h, d = doc_windows(w, n, 3, short=True)
    assert d.tolist() == [0, 0, 1, 1, 1, 1, 1, 2]
    assert h[1] == h[2] == h[6] and len(set(h.tolist())) == 6
    assert (window_hashes(w, 3, chunk=2) == window_hashes(w, 3)).all()


def test_packed_hashes_round_trip():
    for n in (1, 3, 256, 1000, 70_000):
        edges, width = exchange.part_edges(n)
        h = np.array([int(edges[-1]), (1 << 64) - 1], dtype=np.uint64)
        assert (exchange.read_hashes(exchange.pack_hashes(h - edges[-1], width), width) + edges[-1] == h).all()


@pytest.mark.parametrize("block", [exchange.BLOCK, 200])
def test_substring_dedup_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(exchange, "BLOCK", block)
    rows = edge_rows()
    got = substring_dedup.digest(substring_dedup.remove_repeated(edge_docs(spark)))
    assert same(got.collect(), substring_dedup.brute_force(id_text(rows)))


def test_substring_dedup_of_no_rows(spark):
    out = substring_dedup.digest(substring_dedup.remove_repeated(spark.createDataFrame([], DOCS)))
    assert out.columns == ["doc_id", "n_words", "n_removed", "kept_sha256"] and out.count() == 0


def test_removed_intervals_are_maximal(spark):
    text = " ".join(str(i) for i in range(100))
    docs = spark.createDataFrame([(1, text), (2, "x " + text + " y")], "doc_id long, text string")
    got = {r.doc_id: [tuple(s) for s in r.removed] for r in substring_dedup.remove_repeated(docs).collect()}
    assert got == {1: [(0, 100)], 2: [(1, 101)]}


def _link_rows() -> list[tuple]:
    """Chains, near copies and look-alikes around the 75 percent line."""
    rng = random.Random(3)
    rows = []
    for _ in range(12):
        words = [f"w{rng.randrange(10_000)}" for _ in range(rng.choice([6, 12, 40, 120]))]
        for _ in range(rng.choice([1, 2, 9])):
            rows.append((len(rows), " ".join(words)))
            words = list(words)
            words[rng.randrange(len(words))] = f"n{len(rows)}"
            if rng.random() < 0.3:
                words += ["tail", f"t{len(rows)}"]
    return rows


@pytest.mark.parametrize("group_bytes,n_parts", [(ngram_join.GROUP, None), (600, 3)])
def test_ngram_join_equals_brute_force(spark, group_bytes, n_parts):
    rows = _link_rows() + [(10_000 + i if i is not None else None, t) for i, t in id_text(edge_rows())]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = ngram_join.near_duplicates(docs, group_bytes=group_bytes, n_parts=n_parts).drop("text_hash")
    assert same(got.collect(), ngram_join.brute_force(rows))


def test_ngram_join_on_the_mid_fixture(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    got = ngram_join.near_duplicates(docs).drop("text_hash").collect()
    assert same(got, ngram_join.brute_force([(r.doc_id, r.text) for r in docs.collect()]))


def expected_first(rows: list[tuple]) -> list[tuple]:
    """(id, text) of the rows that stay: one of each linked group, and those without words."""
    ids = [(i, t) for i, (_, t) in enumerate(rows)]
    stay, groups = [], {}
    for (n, t), (_, size, c) in zip(ids, ngram_join.brute_force(ids), strict=True):
        if size:
            groups.setdefault(c, set()).add(rows[n])
        else:
            stay.append(rows[n])
    for g in groups.values():
        least = min((i for i, _ in g if i is not None), default=None)
        stay.append((least, {t for i, t in g if i == least}))
    return stay


def check_first(got: list[tuple], rows: list[tuple]) -> None:
    want = expected_first(rows)
    assert len(got) == len(want)
    left = list(want)
    for i, t in got:
        hit = next(w for w in left if w[0] == i and (t in w[1] if isinstance(w[1], set) else t == w[1]))
        left.remove(hit)
    assert not left


def test_keep_first_keeps_one_of_each_group_and_all_columns(spark):
    docs = edge_docs(spark)
    out = ngram_join.keep_first(docs)
    assert out.columns == docs.columns and out.dtypes == docs.dtypes
    check_first([(r.doc_id, r.text) for r in out.collect()], id_text(edge_rows()))
    assert ngram_join.keep_first(spark.createDataFrame([], DOCS)).count() == 0


def test_keep_first_keeps_one_of_equal_rows_shared_ids_and_rows_without_id(spark):
    t = " ".join(f"w{i}" for i in range(60))
    near, other = t + " x", " ".join(f"v{i}" for i in range(30))
    rows = ([(1, t)] * 300 + [(2, t), (None, t), (None, near)]          # equal rows and copies without id
            + [(7, other), (7, other + " y"), (7, "alone in its group with words enough")]   # one id, three texts
            + [(None, "no id at all but the same words")] * 3 + [(None, None), (3, ""), (3, ""), (4, " ")])
    docs = spark.createDataFrame([(i, x, n % 3) for n, (i, x) in enumerate(rows)], "doc_id long, text string, the_id int").repartition(5)
    out = ngram_join.keep_first(docs)
    got = [(r.doc_id, r.text) for r in out.collect()]
    assert out.columns == docs.columns
    check_first(got, rows)
    assert got.count((1, t)) == 1 and sum(i == 7 for i, _ in got) == 2 and sum(i is None for i, _ in got) == 2
    equal = out.where("doc_id = 1").first()
    assert equal.the_id == 0                        # of equal rows the smallest in all columns


def test_trie_probe_equals_pairwise_overlaps():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 60, rng.integers(3, 30))) for _ in range(80)]
    sets += [s[:-1] for s in sets[:20] if len(s) > 1] + [sets[0], sets[1]]
    sizes = np.array([len(s) + rng.integers(0, 3) for s in sets])
    trie, mask = ngram_join.Trie(sets, sizes), np.zeros(60, dtype=bool)
    for i, s in enumerate(sets):
        want = [j for j, t in enumerate(sets)
                if 175 * len(np.intersect1d(s, t)) >= 75 * (sizes[i] + sizes[j])]
        assert sorted(trie.probe(s, int(sizes[i]), mask, 75).tolist()) == want
    assert not mask.any()


def test_components_of_chains_stars_and_loops(spark):
    rng = random.Random(2)
    chain = list(range(40))
    rng.shuffle(chain)
    links = [(chain[i], chain[i + 1]) for i in range(39)] + [(100, 100 + i) for i in range(1, 50)] + [(200, 200), (None, 5), (7, 7)]
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(40), 0), **dict.fromkeys(range(100, 150), 100)}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("block_bytes", [winnowing.BLOCK, 12])
def test_winnowing_equals_brute_force(spark, block_bytes):
    texts = [t for _, t in id_text(edge_rows())]
    items = [*ITEMS, (50, " ".join((texts[9] or "").split()[3:40])), (51, " ".join((texts[12] or "").split()[500:513])),
             (52, " ".join((texts[12] or "").split()[600:613]) + " end")]
    got = winnowing.digest(winnowing.contamination(edge_docs(spark), spark.createDataFrame(items, "item_id long, text string"),
                                                   block_bytes=block_bytes))
    assert same(got.collect(), winnowing.brute_force(id_text(edge_rows()), items))


def test_every_span_of_the_width_shares_a_fingerprint():
    rng = np.random.default_rng(4)
    span = rng.integers(0, 1 << 62, 13).astype(np.uint64)
    for _ in range(50):
        a = np.concatenate([rng.integers(0, 1 << 62, rng.integers(0, 30)).astype(np.uint64), span,
                            rng.integers(0, 1 << 62, rng.integers(0, 30)).astype(np.uint64)])
        b = np.concatenate([rng.integers(0, 1 << 62, rng.integers(0, 9)).astype(np.uint64), span])
        fa, fb = (set(winnowing.fingerprints(x, np.array([len(x)]), 13, 7)[0].tolist()) for x in (a, b))
        assert fa & fb


def test_decontaminate_keeps_the_rest_and_all_columns(spark):
    docs = edge_docs(spark)
    text = next(t for _, t in id_text(edge_rows())[9:10])
    items = spark.createDataFrame([(1, text)], "item_id long, text string")
    for block in (winnowing.BLOCK, 10):
        out = winnowing.decontaminate(docs, items, block_bytes=block)
        bad = {i for i, *_, c in winnowing.brute_force(id_text(edge_rows()), [(1, text)]) if c}
        assert out.dtypes == docs.dtypes and {r.doc_id for r in out.collect()} == {r[0] for r in edge_rows()} - bad
    none = spark.createDataFrame([], "item_id long, text string")
    assert winnowing.decontaminate(docs, none).count() == docs.count()
    assert winnowing.contamination(spark.createDataFrame([], DOCS), items).count() == 0
