"""Signature search, periodic runs and byte-level BPE."""

import hashlib
import random

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from conftest import SF_SMALL
from fixtures_llm import DOCS, edge_docs, edge_rows, id_text, same
from pyspark.sql import functions as F

from panelcast.llm import byte_bpe, periodic_runs, signature_search
from panelcast.llm.oracles import SQL
from panelcast.llm.queries import QUERIES

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def by_duckdb(name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    found = con.execute(SQL[name])
    return [c[0] for c in found.description], found.fetchall()


@pytest.mark.parametrize("name", ["op11_signature_search", "op12_periodic_runs"])
def test_query_equals_sql(spark, name):
    columns, rows = by_duckdb(name)
    assert same(QUERIES[name](spark, SF_SMALL).select(*columns).collect(), rows)


# --- signature search ------------------------------------------------------------------

def items(spark):
    texts = {r[0]: r[1] for r in edge_rows() if r[0] is not None}
    rows = [(1, texts[9], "x"), (2, texts[12][:3000], "x"), (3, None, "x"), (4, "", "x"), (5, "word unknownword", "x"),
            (6, "ALPHA beta alpha", "x"), (None, "x1 gamma", "x"), (6, "ALPHA beta alpha", "x")]
    return rows, spark.createDataFrame(rows, "item_id long, text string, term string").repartition(2)


def expected_search(docs, asked, **kw):
    return signature_search.brute_force(docs, asked, **kw)


def test_search_of_awkward_rows(spark):
    rows, queries = items(spark)
    got = signature_search.search(edge_docs(spark), queries).collect()
    assert same(got, expected_search(id_text(edge_rows()), [r[:2] for r in rows]))


def test_search_blocks_of_items_and_shuffled_scoring(spark, monkeypatch):
    monkeypatch.setattr(signature_search, "BROADCAST_PAIRS", 0)
    rows, queries = items(spark)
    got = signature_search.search(edge_docs(spark), queries, k=3, query_rows=40).collect()
    assert same(got, expected_search(id_text(edge_rows()), [r[:2] for r in rows], k=3))


def test_search_many_equal_documents(spark):
    """A third of all rows are one text; equal scores go by id."""
    texts = ["alpha beta gamma delta"] * 200 + [f"alpha word{i} beta" for i in range(400)]
    docs = [(1000 - i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    asked = [(1, "gamma delta"), (2, "alpha"), (3, "word7 beta")]
    got = signature_search.search(df, spark.createDataFrame(asked, "item_id long, text string")).collect()
    assert same(got, expected_search(docs, asked))


def test_search_of_empty_tables(spark):
    docs, none = edge_docs(spark), edge_docs(spark).where("false")
    queries = items(spark)[1]
    for d, q in ((none, queries), (docs, queries.where("false")), (docs.where("text is null"), queries)):
        assert signature_search.search(d, q).collect() == []


def test_bounds_are_never_below_the_score():
    rng = random.Random(4)
    docs = [[f"t{min(rng.randrange(60), rng.randrange(60))}" for _ in range(rng.choice([3, 40, 700]))] for _ in range(70)]
    blocks = signature_search._Blocks()
    made = []
    n_terms = sum(map(len, docs))
    hashes = signature_search._Hashes()
    from collections import Counter
    for i, d in enumerate(docs):
        c = Counter(w.encode() for w in d)
        made += blocks.add(i, len(d), np.array([hashes[t] for t in c], dtype=np.uint64), np.array(list(c.values())))
    made += blocks.rest()
    query = signature_search.Query([(0, b"t1", 500), (0, b"t30", 7000), (0, b"t59", 9000), (1, b"absent", 9000), (1, b"t2", 10)],
                                   len(docs), n_terms)
    seen = 0
    for b in made:
        bounds = query.bounds(b["bits"], np.array(b["lengths"]))
        for column, i in enumerate(b["ids"]):
            found = Counter(w.encode() for w in docs[i])
            for k, item in enumerate(query.items):
                exact = query.score(item, found, len(docs[i]))
                assert bounds[k, column] >= exact
                assert bounds[k, column] <= 2 * exact + 10_000_000_000
            seen += 1
    assert seen == len(docs)


# --- periodic runs -----------------------------------------------------------------------

def awkward_sequence(rng):
    kind = rng.randrange(4)
    if kind == 0:
        return [rng.randrange(2) for _ in range(rng.randrange(1, 120))]
    if kind == 1:
        a, b = [0], [0, 1]
        while len(b) < 130:
            a, b = b, b + a
        return b[:130]
    out = []
    if kind == 2:                                   # runs inside longer runs, cut at any phase
        root = list(range(rng.randrange(1, 6)))
        for _ in range(rng.randrange(2, 6)):
            out += (root * 60)[rng.randrange(len(root)):][:rng.randrange(6, 60)]
        return out[:200]
    for _ in range(6):
        piece = [rng.randrange(rng.choice([2, 3, 100])) for _ in range(rng.randrange(1, 50))]
        out += (piece * rng.randrange(1, 5))[:rng.randrange(1, 120)]
    return out[:200]


def test_runs_equal_definition():
    rng = random.Random(9)
    for _ in range(250):
        words = awkward_sequence(rng)
        assert periodic_runs.find_runs(words) == periodic_runs.brute_force(words), words


def test_runs_of_long_periods():
    rng = random.Random(2)
    for q, extra in ((700, 0), (1_500, 37), (5_000, 4_999)):
        root = [rng.randrange(10**6) for _ in range(q)]
        words = [-1, *(root * 3)[:2 * q + extra], -2]
        assert (1, 2 * q + extra, q) in periodic_runs.find_runs(words)
    assert periodic_runs.find_runs([7] * 50_000) == [(0, 50_000, 1)]


def expected_runs(doc_id, text, plant=True):
    words = (text or "").encode().split()
    order = periodic_runs.planted(len(words), doc_id) if plant else None
    words = words if order is None else [words[i] for i in order]
    runs = periodic_runs.find_runs([sorted(set(words)).index(w) for w in words]) if len(words) > 2_000 else periodic_runs.brute_force(words)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
    sha = lambda x: hashlib.sha256(x).hexdigest()
    return (doc_id, len(runs), *(best or (None, None, None)), 1000 * best[1] // best[2] if best else None,
            sha("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()),
            sha(b" ".join(w for i, w in enumerate(words) if i not in gone)))


def test_runs_of_awkward_rows(spark):
    got = periodic_runs.digest(periodic_runs.runs(edge_docs(spark), plant=True)).collect()
    assert same(got, [expected_runs(*r) for r in id_text(edge_rows())])
    plain = periodic_runs.digest(periodic_runs.runs(edge_docs(spark))).collect()
    assert same(plain, [expected_runs(*r, plant=False) for r in id_text(edge_rows())])
    assert periodic_runs.runs(edge_docs(spark).where("false")).collect() == []


def test_runs_end_at_document_borders(spark):
    df = spark.createDataFrame([(i, "a b c d e f g h") for i in range(20)], "doc_id long, text string").coalesce(1)
    assert periodic_runs.runs(df).where("n_runs > 0").count() == 0


# --- byte-level BPE ----------------------------------------------------------------------

@pytest.fixture(scope="module")
def encoder():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.load_ranks(RANKS), special_tokens={})


def plain_merge(ranks, data):
    """Smallest rank first, leftmost first, by a scan for every merge."""
    parts = [data[i:i + 1] for i in range(len(data))]
    while True:
        found = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
        if not found:
            return [ranks[p] for p in parts]
        _, i = min(found)
        parts[i:i + 2] = [parts[i] + parts[i + 1]]


def test_merges_of_any_ranks_equal_a_plain_scan():
    """Vocabularies that no training would make: a merge may free a smaller rank."""
    rng = random.Random(1)
    for _ in range(300):
        tokens = {bytes([b]) for b in b"abc"}
        while len(tokens) < 30:
            tokens.add(bytes(rng.choice(b"abc") for _ in range(rng.randrange(2, 6))))
        order = sorted(tokens)
        rng.shuffle(order)
        ranks = {t: i * 37 for i, t in enumerate(order)}
        codec = byte_bpe.Codec(ranks, r"\S+|\s+")
        for _ in range(10):
            data = bytes(rng.choice(b"abc") for _ in range(rng.randrange(1, 60)))
            assert codec.merge(data) == ([ranks[data]] if data in ranks else plain_merge(ranks, data))


def test_pre_tokens_share_one_queue(monkeypatch, encoder):
    """What some texts bring anew is merged in one go, with the ids of a plain scan."""
    rng = random.Random(3)
    for _ in range(40):
        order = sorted({bytes(rng.choice(b"abc") for _ in range(rng.randrange(2, 6))) for _ in range(30)} | {b"a", b"b", b"c"})
        rng.shuffle(order)
        ranks = {t: i * 37 for i, t in enumerate(order)}
        data = [bytes(rng.choice(b"abc") for _ in range(rng.randrange(1, 40))) for _ in range(60)]
        got = byte_bpe.Codec(ranks, r"\S+|\s+").merge_all(data)
        assert [np.frombuffer(g, dtype="<i4").tolist() for g in got] == [[ranks[d]] if d in ranks else plain_merge(ranks, d) for d in data]
    codec = byte_bpe.Codec(byte_bpe.load_ranks(RANKS), public_tokenizers.PATTERN)
    calls, merged = [], codec._merged
    monkeypatch.setattr(codec, "_merged", lambda data: calls.append(len(data)) or merged(data))
    texts = [" ".join("".join(rng.choice("abcdefgh.é") for _ in range(rng.randrange(1, 15))) for _ in range(40)) for _ in range(50)]
    texts += ["", "odd  blanks ", texts[0]]
    assert [np.frombuffer(g, dtype="<i4").tolist() for g in codec.encode_all(texts)] == [encoder.encode_ordinary(t) for t in texts]
    assert len(calls) == 1


def test_ids_equal_the_library(encoder):
    codec = byte_bpe.Codec(byte_bpe.load_ranks(RANKS), public_tokenizers.PATTERN)
    rng = random.Random(6)
    parts = ["a", "b", " ", "  ", "\n", "\t", "é", "日", "'s", "'ll", "1", "23", ".", ",", "\x1c", "\x85", "　", "Word", "the",
             "\r\n", "😀", "​", "²", "!!", "͸", chr(0x558), chr(0x323B0), chr(0x11DE0)]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(0, 40))) for _ in range(3_000)]
    texts += ["a" * 20_000, "ab" * 9_000, "日本語" * 3_000, "!?" * 6_000, "".join(rng.choice("abcdefgh") for _ in range(30_000))]
    texts += ["".join(" " + chr(c) + "a" + chr(c) for c in range(at, at + 500)) for at in range(0x500, 0x3000, 500)]
    for t in texts:
        ids = np.frombuffer(codec.encode(t), dtype="<i4")
        assert ids.tolist() == encoder.encode_ordinary(t), repr(t[:80])
        assert codec.decode(ids) == t.encode()


def expected_ids(encoder, doc_id, text):
    ids = encoder.encode_ordinary(text or "")
    sha = lambda x: hashlib.sha256(x).hexdigest()
    return doc_id, len(ids), sha(",".join(map(str, ids)).encode()), sha((text or "").encode())


def encoded(docs):
    return byte_bpe.encode(docs, RANKS, public_tokenizers.PATTERN)


def test_bpe_of_awkward_rows(spark, encoder):
    got = byte_bpe.digest(byte_bpe.decode(encoded(edge_docs(spark)), RANKS)).collect()
    assert same(got, [expected_ids(encoder, *r) for r in id_text(edge_rows())])
    assert encoded(spark.createDataFrame([], DOCS)).collect() == []
    null = encoded(edge_docs(spark)).withColumn("ids", F.lit(None).cast("array<int>"))
    assert byte_bpe.decode(null, RANKS).where("decoded is not null").count() == 0


def test_bpe_forgets_what_is_not_used(monkeypatch, encoder):
    monkeypatch.setattr(byte_bpe, "CACHE", 5)
    codec = byte_bpe.Codec(byte_bpe.load_ranks(RANKS), public_tokenizers.PATTERN)
    rng = random.Random(8)
    for _ in range(200):
        t = " ".join(rng.choice(["one", "two", "three", "four", "fivefold", "sixty", "se,ven", "eight\nnine"]) for _ in range(30))
        assert np.frombuffer(codec.encode(t), dtype="<i4").tolist() == encoder.encode_ordinary(t)
    assert max(len(c.young) + len(c.old) for c in (codec.piece, codec.after_blank)) <= 10


def test_bpe_query(spark, encoder):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    assert same(QUERIES["op13_byte_bpe"](spark, SF_SMALL).collect(), [expected_ids(encoder, *r) for r in docs])
