"""Quality rules, line dedup, chat, WARC, packing and the two classifiers."""

import gzip
import io
import math
import random
from collections import defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
from conftest import SF_MID, SF_SMALL
from fixtures_llm import DOCS, edge_docs, edge_rows, edge_texts, id_text, same
from pyspark.sql import functions as F

from panelcast.llm import chat, language_id, line_dedup, outliers, packing, quality_cnn, warc
from panelcast.llm.oracles import SQL
from panelcast.llm.queries import QUERIES

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


# --- quality rules -----------------------------------------------------------

def mcd_reference(rows):
    """The estimate of ``outliers`` in NumPy: rows of (lang, source, vector)
    of base-passed documents; returns the distance of each (None: no cell)."""
    groups, pools = defaultdict(list), defaultdict(list)
    for i, (lang, source, _) in enumerate(rows):
        groups[lang, source].append(i)
    for (lang, _), own in groups.items():
        if len(own) < outliers.LEAST:
            pools[lang] += own
    cells = [own for own in groups.values() if len(own) >= outliers.LEAST]
    cells += [own for own in pools.values() if len(own) >= outliers.LEAST]
    cells.append([i for own in pools.values() if len(own) < outliers.LEAST for i in own])
    floor = np.diag((np.array(outliers.FLOORS) * outliers.UNIT) ** 2)
    out: list = [None] * len(rows)

    def estimate(x):
        return x.mean(axis=0), np.cov(x.T, bias=True) + floor

    def squared(x, e):
        z = np.linalg.solve(np.linalg.cholesky(e[1]), (x - e[0]).T)
        return (z * z).sum(axis=0)

    state = []
    for own in cells:
        if len(own) >= outliers.LEAST:
            x = np.array([rows[i][2] for i in own], dtype=float)
            order = np.sort(x, axis=0)
            low, mid, high = (order[math.ceil(q * len(x)) - 1] for q in (0.25, 0.5, 0.75))
            state.append((own, x, [(mid, np.diag(((high - low) / 1.349) ** 2) + floor), estimate(x)]))
    mark = lambda: round(sum(np.linalg.slogdet(e[1])[1] / 2 for *_, starts in state for e in starts), 4)
    marks = set()
    while mark() not in marks and len(marks) < outliers.STEPS:
        marks.add(mark())
        for _, x, starts in state:
            for s in range(2):
                bins = np.floor(32 * np.log2(squared(x, starts[s]) + 1e-3))
                starts[s] = estimate(x[bins <= np.sort(bins)[math.ceil(outliers.SUBSET * len(x)) - 1]])
    for own, x, starts in state:
        best = min(starts, key=lambda e: np.linalg.slogdet(e[1])[1])
        near = x[squared(x, best) <= outliers._consistency() * outliers.chi_square(0.975, outliers.P)]
        for i, d in zip(own, squared(x, estimate(near)), strict=True):
            out[i] = d
    return out


def vector(words, chars, symbols, lines, dup, repeat):
    share = lambda a, b: math.asin(math.sqrt(min(1.0, a / b))) if b else 0.0
    # half away from zero, as SQL rounds
    return [math.floor(v * outliers.UNIT + 0.5) for v in (
        math.log1p(words), math.log(chars / words), share(symbols, chars), share(dup, lines), share(repeat, words))]


def expected_quality(docs):
    """doc index -> (base, base_failed, kept) by brute force."""
    out, rows, at = [], [], []
    for i, d in enumerate(docs):
        base = outliers.brute_force_base(d["text"])
        failed = base[0] < outliers.MIN_WORDS or 100 * base[4] > outliers.REPEAT_PERCENT * base[0]
        out.append([base, failed, not failed])
        if not failed:
            lines = sum(bool(x.strip(" \t\n\x0b\f\r")) for x in d["text"].split("\n"))
            rows.append((d["lang"], d["source"], vector(*base[:3], lines, *base[3:])))
            at.append(i)
    limit = outliers.chi_square(outliers.CUTOFF, outliers.P)
    for i, d2 in zip(at, mcd_reference(rows), strict=True):
        out[i][2] = d2 is None or d2 <= limit
    return out


def test_chi_square_quantiles():
    for p, k, want in ((0.5, 2, 1.386294), (0.95, 1, 3.841459), (0.975, 5, 12.832502), (0.99, 3, 11.344867)):
        assert outliers.chi_square(p, k) == pytest.approx(want, abs=1e-5)


def test_quality_equals_brute_force_on_the_mid_fixture(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    rows = [r.asDict() for r in docs.collect()]
    want = {r["doc_id"]: w for r, w in zip(rows, expected_quality(rows), strict=True)}
    got = outliers.quality(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        base, failed, kept = want[r.doc_id]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == base
        assert (r.base_failed, r.kept) == (failed, kept)


def test_quality_catches_junk_and_keeps_clean_text(spark):
    docs, labels = (spark.read.parquet(f"{SF_MID}/{t}.parquet") for t in ("documents", "labels"))
    r = outliers.quality(docs).join(labels, "doc_id").where("n_words >= 20").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("k")).collect()
    share = {x.quality: x.k for x in r}
    assert share[1] > 0.99 and share[0] < 0.1


def test_quality_of_edge_rows(spark):
    docs = edge_docs(spark)
    got = outliers.quality(docs).collect()
    assert len(got) == len(edge_rows())
    want = defaultdict(set)
    for i, t in id_text(edge_rows()):
        want[i].add(outliers.brute_force_base(t))
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) in want[r.doc_id]
        assert not (r.base_failed and r.kept)
    kept = outliers.keep_good(docs)
    assert kept.dtypes == docs.dtypes
    assert kept.count() == sum(r.kept for r in got)
    empty = spark.createDataFrame([], DOCS)
    assert outliers.quality(empty).count() == 0 and outliers.keep_good(empty).count() == 0


# --- line dedup ---------------------------------------------------------------

def test_line_dedup_equals_brute_force(spark):
    pages = [(i, "big" if i % 3 else "small" if i % 2 else None,
              f"nav\n own {i} \n\n{'foot' if i % 5 else 'rare'}\n nav ") for i in range(60)] + [(99, "big", None), (98, "big", ""), (97, "one", "nav")]
    df = spark.createDataFrame(pages, "id long, h string, t string")
    got = line_dedup.mark(df, "id", F.col("h"), F.col("t")).select("id", "host", "n_lines", "n_dropped", "kept").collect()
    want = line_dedup.brute_force(pages)
    assert same(got, want) and any(w[3] for w in want)


def test_line_dedup_of_documents_keeps_columns(spark):
    docs = edge_docs(spark)
    out = line_dedup.drop_boilerplate(docs, min_pages=5, ratio=0.2)
    assert out.dtypes == docs.dtypes and out.count() == docs.count()
    want = line_dedup.brute_force([(r[0], r[3], r[1]) for r in edge_rows()], min_pages=5)
    assert same([(r.doc_id, r.text) for r in out.collect()], [(w[0], w[4]) for w in want])
    assert line_dedup.drop_boilerplate(spark.createDataFrame([], DOCS)).count() == 0


def test_hosts_and_visible_lines(spark):
    rows = spark.createDataFrame([("HTTP://u@A.b:8/x", "<p>a<script>x</p></script>b<!-- <b> -->c"), (None, None), ("nothing", "")], "u string, h string")
    got = rows.select(line_dedup.host(F.col("u")), line_dedup.visible_lines(F.col("h"))).collect()
    assert [tuple(r) for r in got] == [("a.b", "\na\nb\nc"), (None, None), (None, "")]


# --- chat -----------------------------------------------------------------------

TURNS = [(1, 2, "bob", "hi <|x"), (1, 1, "system", "be nice"), (1, 3, "a|\"b", None), (1, 3, "bob", "again"), (1, 4, None, "who"),
         (1, 4, None, "who"), (2, 1, "system", "alone"), (None, 1, "bob", "no conversation"), (3, None, "bob", "null turn"), (3, 0, " ", "x")]


def test_rotation_masks_the_speaker(spark):
    turns = spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string")
    got = {(r.conv_id, r.perspective): r for r in chat.rotate(turns).collect()}
    assert set(got) == {(1, "bob"), (1, 'a|"b'), (None, "bob"), (3, "bob")}
    r = got[1, "bob"]
    assert r.rendered.startswith("<|system|>\nbe nice<|end|>\n<|assistant|>\nhi < |x<|end|>\n")
    assert [r.rendered[a:b] for a, b in r.mask] == ["hi < |x<|end|>", "again<|end|>"]
    assert r.rendered.count('<|user name="unknown"|>') == 2 and '<|user name="a\\x7c\\"b"|>' in r.rendered
    assert chat.rotate(turns.limit(0)).count() == 0


def test_long_conversations_and_parts(spark):
    rows = [(7, i // 2, "ab"[i % 2], f"t{i}") for i in range(40)] + [(8, 1, "a", "x")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    key = lambda df: sorted(map(str, df.collect()))
    whole, split = chat.rotate(turns, turns_per_part=16), chat.rotate(turns, turns_per_part=16, long=10)
    assert key(whole) == key(split)
    parts = sorted((r for r in split.collect() if r.conv_id == 7 and r.perspective == "a"), key=lambda r: r.part)
    assert [r.n_turns for r in parts] == [16, 16, 8]
    assert "".join(r.rendered for r in parts).count("<|assistant|>") == 20


# --- WARC -------------------------------------------------------------------------

def test_warc_round_trip(spark, tmp_dir):
    big = "é" * 200_000
    pages = [(5, "http://x/a b", "y" * 100), (3, None, "y" * 100), (4, "u", "y" * 100), (1, "u", "z" * 99), (2, "u", "z" * 99),
             (9, "u", None), (8, "u", ""), (7, "u\r\nEvil: 1", big), (None, "u", big), (3, None, "y" * 100)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3)
    manifest = warc.write_archives(df, f"{tmp_dir}/warc", roll=50_000)
    records = warc.read_archives(manifest)
    back = records.collect()
    assert len(back) == len(pages) and all(r.problem is None and r.digest_ok is (None if r.record_type == "revisit" else True) for r in back)
    assert all(r.digest_ok for r in warc.verified(records.drop("payload")).collect())
    kinds = sorted((r.page_id or 0, r.record_type, r.refers_to) for r in back)
    assert kinds == [(0, "revisit", 7), (1, "response", None), (2, "response", None), (3, "response", None), (3, "response", None),
                     (4, "revisit", 3), (5, "revisit", 3), (7, "response", None), (8, "response", None), (9, "response", None)]
    payload = {r.page_id: r.payload for r in back if r.record_type == "response"}
    assert payload[7].decode() == big and payload[8] == payload[9] == b"" and payload[1] == b"z" * 99
    assert {r.payload_bytes for r in back if r.page_id in (4, 5)} == {100}
    assert warc.read_archives(warc.write_archives(df.limit(0), f"{tmp_dir}/none")).count() == 0


def test_every_record_is_a_gzip_member_and_damage_is_reported():
    data = [warc.record(i, "u", b"p" * i * 70_000, warc.hashlib.sha256(b"p" * i * 70_000).hexdigest(), None) for i in range(3)]
    for d in data:
        assert gzip.decompress(d).startswith(b"WARC/1.1\r\n")
    assert [len(b) for _, b in warc.Records(io.BytesIO(b"".join(data)))] == [len(gzip.decompress(d).partition(b"\r\n\r\n")[2]) - 4 for d in data]
    for broken in (b"".join(data)[:-9], data[0] + gzip.compress(b"HTTP/1.1 200\r\n\r\n"), data[0] + gzip.compress(b"WARC/1.1\r\nContent-Length: 9\r\n\r\nabc")):
        with pytest.raises(ValueError):
            list(warc.Records(io.BytesIO(broken)))


def test_revisits_are_held_against_their_responses(spark):
    rows = [(1, "response", 200, "d1", True, None), (2, "revisit", 200, "d1", None, 1), (3, "revisit", 200, "d1", None, 9),      # 9: missing
            (4, "revisit", 200, "d2", None, 1), (5, "revisit", 201, "d1", None, 1), (6, "response", 300, "d3", False, None),
            (7, "revisit", 300, "d3", None, 6), (8, "revisit", 200, "d1", None, None), (None, None, None, None, None, None)]
    rows += [(100 + i, "revisit", 200, "d1", None, 1) for i in range(300)]                                                      # a hot response
    df = spark.createDataFrame(rows, "page_id long, record_type string, payload_bytes long, payload_digest string, digest_ok boolean, "
                                     "refers_to long").selectExpr("*", "'u' AS url", "'a' AS archive", "CAST(NULL AS STRING) AS problem").checkpoint()
    got = {r.page_id: r.digest_ok for r in warc.verified(df).collect()}
    assert {k: got[k] for k in (1, 2, 3, 4, 5, 6, 7, 8, None)} == {1: True, 2: True, 3: False, 4: False, 5: False, 6: False, 7: False, 8: False, None: None}
    assert all(got[100 + i] for i in range(300)) and len(got) == len(rows)


@pytest.mark.parametrize("kind", ["flipped", "cut", "framing", "garbage"])
def test_reading_goes_on_after_damage(spark, tmp_dir, kind):
    rng = random.Random(5)
    payloads = [bytes(rng.randrange(256) for _ in range(30_000 if i == 2 else 300)) for i in range(6)]
    data = [warc.record(i, "u", p, warc.hashlib.sha256(p).hexdigest(), None) for i, p in enumerate(payloads)]
    if kind == "flipped":
        data[2] = data[2][:400] + bytes(200) + data[2][600:]
    elif kind == "cut":
        data[2] = data[2][:9_000]
    elif kind == "framing":
        data[2] = gzip.compress(b"WARC/1.1\r\nContent-Length: 9\r\n\r\nabc")
    else:
        data[2] = b"not a member at all " * 7_000
    path = f"{tmp_dir}/damaged.warc.gz"
    with open(path, "wb") as f:
        f.write(b"".join(data))
    got = warc.read_archives(spark.createDataFrame([(f"file://{path}",)], "archive string")).collect()
    sound = [r for r in got if r.problem is None]
    # damage may look sound but for its digest; the others are all there
    assert {r.page_id for r in sound if r.digest_ok} == {0, 1, 3, 4, 5}
    assert len(got) in (6, 7) and sum(r.problem is not None for r in got) <= 1
    assert all(r.payload == payloads[r.page_id] for r in sound if r.digest_ok)


# --- packing -----------------------------------------------------------------------

def check_packing(pieces, texts, tokenizer, tiers=packing.TIERS):
    """Every id lies in one piece, sequences are gapless; returns padding."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
    for doc_id, want in texts.items():
        own = sorted(by_doc[doc_id], key=lambda p: p.start)
        ids = np.concatenate([np.frombuffer(p.ids, dtype="<u4") for p in own]).tolist()
        assert ids == tokenizer.encode(want or "", add_special_tokens=False).ids + [1]
        assert [p.start for p in own] == np.cumsum([0, *(p.length for p in own)])[:-1].tolist()
        assert {p.doc_tokens for p in own} == {len(ids)}
    padding = 0
    for own in by_sequence.values():
        own = sorted(own, key=lambda p: p.offset)
        assert [p.offset for p in own] == np.cumsum([0, *(p.length for p in own)])[:-1].tolist()
        size = sum(p.length for p in own)
        assert size <= tiers[0] and {p.sequence_tokens for p in own} == {size}
        padding += 0 if size in tiers else tiers[0] - size
    return padding


def test_packing_round_trip(spark):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(TOKENIZER)
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").unionByName(
        spark.createDataFrame([(10_000 + i, x) for i, x in enumerate(edge_texts())], "doc_id long, text string"), allowMissingColumns=True).repartition(2)
    texts = {r.doc_id: r.text for r in docs.collect()}
    for pool in (packing.POOL, 8):
        pieces = packing.pack(docs, TOKENIZER, pool=pool).collect()
        assert check_packing(pieces, texts, t) <= 2 * 2048
    groups = defaultdict(dict)
    for p in pieces:
        groups[p.step_group][p.sequence_id] = p.sequence_tokens
    for g in groups.values():
        assert len(set(g.values())) == 1 and sum(g.values()) <= packing.STEP
    assert packing.pack(docs.limit(0), TOKENIZER).count() == 0


def test_word_tokenizer_equals_the_tokenizer():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(TOKENIZER)
    texts = ["a\n\nb", "a\n\n\nb", "a\n", "a\n\n", "\n", "\n\n", "\na b\n c", "a\n.b", "a  b", "a \n b", " lead", "trail ", "\n\n x\t\t y", "it's they'll 12 345  ", "", "日本 語  x", "a\x1c b", "\n \n", " ", "　 a",
             "<|endoftext|> x", "x\r\n y 'S", *(x or "" for x in edge_texts())]
    for got, text in zip(packing.WordTokenizer(TOKENIZER).encode(texts), texts, strict=True):
        assert np.frombuffer(got, dtype="<u4").tolist() == t.encode(text, add_special_tokens=False).ids, text


# --- classifiers ----------------------------------------------------------------------

def naive_phrases(text, reference):
    n = i = 0
    while i < len(text):
        k = 1
        while i + k < len(text) and text[i:i + k + 1] in reference:
            k += 1
        n, i = n + 1, i + (k if text[i:i + k] in reference else 1)
    return n


def test_phrases_equal_a_naive_parse():
    rng = np.random.default_rng(3)
    make = lambda n: "".join(map(chr, 97 + rng.integers(0, 4, n)))
    reference, texts = make(300), [make(n) for n in (0, 1, 7, 60, 200)] + ["zz"]
    symbol = {c: i + 1 for i, c in enumerate("abcdz")}
    table = language_id.transition_table(language_id.Automaton([symbol[c] for c in reference]).edges())
    codes = np.array([symbol[c] for t in texts for c in t], dtype=np.uint8)
    got = language_id.count_phrases(codes, np.array([len(t) for t in texts]), [table], lanes=3)
    assert got[:, 0].tolist() == [naive_phrases(t, reference) for t in texts]


def test_symbols():
    codes, counts = language_id.Alphabet(["a", "b"]).symbols(["..A,, b!", "", "12", "ab"])
    assert codes.tolist() == [1, 0, 2, 1, 2] and counts.tolist() == [3, 0, 0, 2]


def test_language_identification(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    held = language_id.remainder("doc_id", 4) == 2
    got = language_id.identify(docs, held).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert np.mean([r.lang == r.lang_pred for r in got]) > 0.97 and all(0 <= r.score <= 1 for r in got)
    odd = language_id.identify(edge_docs(spark), held).collect()
    assert len(odd) == len(edge_rows())
    assert {r.lang_pred for r in odd if r.doc_id in (0, 1, 2, 14)} == {"und"}
    unlabelled = language_id.identify(docs.withColumn("lang", F.lit(None).cast("string")).limit(5), held).collect()
    assert {(r.lang_pred, r.score) for r in unlabelled} == {("und", 0.0)}
    assert language_id.identify(spark.createDataFrame([], DOCS), held).count() == 0


def test_every_label_is_learned(spark, monkeypatch):
    """130 languages, each with words of its own: all are found, in one block
    of automata or in many."""
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(7))
    names = [f"l{i:03d}" for i in range(130)]
    words = {n: [word() for _ in range(12)] for n in names}
    docs = [(4 * i + j, " ".join(rng.choices(words[n], k=20)), n) for i, n in enumerate(names) for j in range(4)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    results = []
    for block in (16, 200):
        monkeypatch.setattr(language_id, "BLOCK", block)
        results.append(sorted(map(tuple, language_id.identify(df, F.col("doc_id") % 4 == 2).collect())))
    assert results[0] == results[1]
    lang = {i: n for i, _, n in docs}
    assert all(r[2] == lang[r[0]] for r in results[0])


def test_network_gradients_equal_differences():
    rng = np.random.default_rng(2)
    chunks = rng.integers(32, 127, (7, quality_cnn.SPAN))
    owner, label = np.array([0, 0, 0, 1, 1, 2, 2]), np.array([0.0, 1.0, 1.0])
    net = quality_cnn.Network()

    def loss():
        p = net.probability(net.combine(net.pooled(chunks), owner))
        return -np.mean(label * np.log(p) + (1 - label) * np.log(1 - p))
    for x, g in zip(net.weights(), net.gradients(chunks, owner, label), strict=True):
        i = np.unravel_index(np.abs(g).argmax(), g.shape)
        old = x[i]
        x[i] = old + 1e-3
        up = loss()
        x[i] = old - 1e-3
        down = loss()
        x[i] = old
        assert (up - down) / 2e-3 == pytest.approx(float(g[i]), rel=0.05, abs=1e-4)


def test_quality_network_on_held_out_documents(spark):
    docs, labels = (spark.read.parquet(f"{SF_MID}/{t}.parquet") for t in ("documents", "labels"))
    held = language_id.remainder("doc_id", 3) == 1
    got = quality_cnn.classify(docs, labels, held).collect()
    truth = {r.doc_id: r.quality for r in labels.collect()}
    ok = [r.predicted == truth[r.doc_id] for r in got if r.held_out and r.doc_id in truth]
    assert len(got) == 1000 and np.mean(ok) > 0.93 and all(0 <= r.score <= 1 for r in got)
    odd = edge_docs(spark)
    assert {r.score for r in quality_cnn.classify(odd, labels.limit(0), held).collect()} == {0.5}
    one = spark.createDataFrame([(3, 1), (4, 1), (4, 1), (None, 0), (6, None)], "doc_id long, quality int")
    assert {r.score for r in quality_cnn.classify(odd, one, F.lit(False)).collect()} == {0.8}
    assert quality_cnn.classify(spark.createDataFrame([], DOCS), labels, held).count() == 0


def test_scores_do_not_depend_on_the_batch():
    net = quality_cnn.Network()
    texts = [b"", b"x", b"abc " * 400, bytes(range(256)) * 5]
    alone = [quality_cnn.score_texts(net, [t])[0] for t in texts]
    assert quality_cnn.score_texts(net, texts, group=2) == pytest.approx(alone, abs=1e-6)


# --- queries and pipeline ------------------------------------------------------------------

@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "conversations", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    q = duck.execute(SQL[name])
    columns = [c[0] for c in q.description]
    assert sorted(columns) == sorted(df.columns)
    assert same(df.select(*columns).collect(), q.fetchall())


def test_pipeline_equals_brute_force(spark):
    import corpus_pipeline

    from panelcast.llm import ngram_join, winnowing
    docs = [r.asDict() for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    docs = [d for d, (_, _, kept) in zip(docs, expected_quality(docs), strict=True) if kept]
    lines = line_dedup.brute_force([(d["doc_id"], d["source"], d["text"]) for d in docs])
    rows = [(i, t) for i, _, _, _, t in lines]
    rows = [x for x, (i, _, c) in zip(rows, ngram_join.brute_force(rows), strict=True) if i == c]
    rows = [x for x, w in zip(rows, winnowing.brute_force(rows, items), strict=True) if not w[5]]
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(TOKENIZER)
    got = corpus_pipeline.run(spark, SF_SMALL).collect()
    tokens = defaultdict(int)
    for p in got:
        tokens[p.doc_id] += p.length
    assert tokens == {i: len(t.encode(x, add_special_tokens=False).ids) + 1 for i, x in rows}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "near_duplicates", "decontamination", "packing"]


def test_pipeline_stages_take_edge_rows(spark):
    import corpus_pipeline
    docs = edge_docs(spark).drop("kept")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF_SMALL)
        assert out.dtypes == docs.dtypes and 0 < out.count() <= docs.count()
        assert stage(spark, docs.limit(0), SF_SMALL).count() == 0


def test_pipeline_drops_lines_repeated_in_a_source(spark):
    """A line on 8 % of a source's documents goes; a chance repeat in a small
    source and one on 3 % of a large one stay."""
    import corpus_pipeline
    text = lambda i: "\n".join([f"own {i}", *(["follow us"] if i % 25 < 2 else []), *(["by chance"] if i % 100 < 3 else []), f"end {i}"])
    docs = [(i, text(i), "en", "large") for i in range(400)] + [(1000 + i, f"own {i}\nfour times", "en", "small") for i in range(4)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string")
    got = dict(corpus_pipeline.STAGES)["line_dedup"](spark, df, SF_SMALL).collect()
    want = [(i, t.replace("follow us\n", "")) for i, t, _, _ in docs]
    assert same([(r.doc_id, r.text) for r in got], want) and sum("follow us" in d[1] for d in docs) == 32
    pages = [(i, s, t) for i, t, _, s in docs]
    found = line_dedup.brute_force(pages, corpus_pipeline.LINE_RATIO, corpus_pipeline.LINE_COPIES, 1)
    assert same([(w[0], w[4]) for w in found], want)


def test_words_are_remembered_without_end_marks(monkeypatch):
    """Ids are the library's with any mark, in one group or many, and when words are forgotten."""
    monkeypatch.setattr(packing, "CACHE", 20)
    tokenizer = packing.WordTokenizer(TOKENIZER)
    tokenizer.encode(["house, house. house"])
    assert "house" in tokenizer.words and not {"house,", "house."} & set(tokenizer.words)
    rng = random.Random(4)
    parts = ["house", "it's", "a", "", "7", "é", "don'", "x's", "Ä", "\nThe", "..", "<|endoftext|"]
    for _ in range(60):
        texts = [" ".join(rng.choice(parts) + rng.choice(["", *packing.MARKS, "'", ".,", "!?", "-", "²"]) for _ in range(12)) for _ in range(9)]
        for got, text in zip(tokenizer.encode(texts), texts, strict=True):
            assert np.frombuffer(got, dtype="<u4").tolist() == tokenizer.tokenizer.encode(text, add_special_tokens=False).ids, repr(text)
