"""The training-data operators against brute force, exact round trips and held-out accuracy."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from keystrata.llm import attribution, chat, decontaminate, langid, linededup, mixing, packing, queries, setsketch, tokenizing, topk, toxicity
from keystrata.llm.common import spread
from keystrata.llm.components import components
from tests.test_queries import FOLDER, connection, same

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def docs_of(spark, texts, source="s"):
    return spark.createDataFrame([(i, t, "en", source, len(t or "")) for i, t in enumerate(texts)], DOCS)


def odd_docs(spark):
    """Nulls in every column, empty and long texts, repeated rows, a clashing extra column."""
    rows = [(None, "some words here", None, None, None), (1, None, None, "a", None), (2, "", "en", "a", 0), (3, "x " * 50_000, "en", "b", 1), (4, "same text of five words", "en", "b", 1), (4, "same text of five words", "en", "b", 1), (5, " é\x0b\n", "fr", None, 4)]
    return spark.createDataFrame(rows, DOCS).withColumn("size", F.lit("clash")).withColumn("score", F.lit("clash"))


@pytest.mark.parametrize("name", list(queries.oracle_sql()))
def test_sql(spark, name):
    same(queries.queries()[name](spark, FOLDER), connection(), queries.oracle_sql()[name])


def test_top_k_is_exact_with_ties_and_odd_vectors(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.integers(-2, 3, 4).astype(float).tolist()) for i in range(300)]
    rows += [(300, None), (301, [1.0, None, 0.0, 0.0]), (302, [float("nan")] * 4), (None, [1.0] * 4), (400, [1.0, 2.0]), (0, rows[0][1])]
    v = topk.integers(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    got = topk.top_k(v, v.where("id % 100 = 0"), 5, pivots=6).collect()
    blocked = topk.top_k(v, v.where("id % 10 = 0"), 5, pivots=6, query_block=4)
    assert sorted(map(tuple, blocked.where("query_id % 100 = 0").collect())) == sorted(map(tuple, got))
    assert blocked.select("query_id").distinct().count() == 30
    good = [(i, np.floor(np.array(x) * 1024).astype(int)) for i, x in rows if i is not None and x is not None and all(c is not None and np.isfinite(c) for c in x)]
    for q in {0, 100, 200, 400}:
        own = next(x for i, x in good if i == q)
        best = sorted(((-int(own @ x), i) for i, x in good if i != q and len(x) == len(own)))[:5]
        assert [(-r.score, r.vec_id) for r in sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])] == best
    assert topk.top_k(v.where("false"), v.where("false")).count() == 0


def test_packing_round_trip_and_best_fit(spark):
    sizes = [5, 9, 3, 7, 1, 10, 2]
    rows = packing.pack(sizes, 10)
    assert sorted(i for r in rows for i in r) == list(range(7))
    assert all(sum(sizes[i] for i in r) <= 10 for r in rows)
    assert len(rows) == 4

    def slow(sizes, length):
        free, out = [], []
        for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
            fit = [f for f in free if f >= sizes[i]]
            if fit:
                free.remove(min(fit))
                free.append(min(fit) - sizes[i])
            else:
                out.append(i)
                free.append(length - sizes[i])
        return len(out)

    random.seed(3)
    for _ in range(30):
        many = [random.randint(1, 40) for _ in range(60)]
        assert len(packing.pack(many, 40)) == slow(many, 40)
    docs = odd_docs(spark)
    out = packing.packed(docs, length=64, window=500)
    got = {}
    for r in packing.segments(out).collect():
        got.setdefault(r.doc_id, []).append((r.piece, r.ids))
    for doc_id, text in ((None, "some words here"), (3, "x " * 50_000)):
        ids = [t for _, p in sorted(got[doc_id]) for t in p]
        assert tokenizing.encoding().decode(ids) == text
    assert len(got[4]) == 2 and 1 not in got and 2 not in got
    assert all(r.cu_seqlens[-1] == r.n_tokens <= 64 and len(r.ids) == 128 for r in out.collect())
    assert packing.packed(docs.where("false")).count() == 0


def test_packing_tells_rows_of_one_id_apart(spark):
    """Two long texts of one id, and the whole and partial copies of a mix, are rebuilt each."""

    def rebuilt(docs):
        got = {}
        for r in packing.segments(packing.packed(docs, length=16, window=400)).collect():
            got.setdefault((r.text, r.doc_id), []).append((r.piece, r.ids))
        assert all([p for p, _ in sorted(x)] == list(range(len(x))) for x in got.values())
        return sorted((i, tokenizing.encoding().decode([t for _, p in sorted(x) for t in p])) for (_, i), x in got.items())

    rows = [(1, " ".join(f"a{i}" for i in range(90))), (1, " ".join(f"b{i}" for i in range(70))), (2, "short"), (2, "short")]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], DOCS).coalesce(1)
    assert rebuilt(docs) == sorted(rows)
    mix = mixing.copies(mixing.mixed(docs)).select("doc_id", "text")
    assert rebuilt(mix) == sorted((r.doc_id, r.text) for r in mix.collect())


def test_token_counts_match_brute_force(spark):
    """Each token, placed by decoding its bytes alone, against the sections of its characters."""
    rng = random.Random(7)
    pieces = ["word", " and", "\n", "é", "🙂", "ß", "\n\n", "  ", "日本", ".", " x"]
    texts = ["".join(rng.choices(pieces, k=rng.randint(1, 60))) for _ in range(80)]
    words = {v: k for k, v in tokenizing.ranks().items()}
    for rule in ("most", "first"):
        got = {r.doc_id: r for r in attribution.token_counts(docs_of(spark, texts), rule=rule).collect()}
        for n, text in enumerate(texts):
            owner = [i for i, c in enumerate(text) for _ in c.encode()]
            lines = [text.count("\n", 0, i) for i in range(len(text))]
            counts, at, crossing = [0] * (max(lines) + 1), 0, 0
            for t in tokenizing.encode(text).tolist():
                chars = sorted(set(owner[at : at + len(words[t])]))
                at += len(words[t])
                held = [lines[c] for c in chars]
                crossing += len(set(held)) > 1
                counts[held[0] if rule == "first" else max(sorted(set(held)), key=held.count)] += 1
            assert (got[n].section_tokens, got[n].n_crossing, got[n].n_tokens) == (counts, crossing, sum(counts))


def test_token_counts_add_up(spark):
    text = "Ünïcode — first line\nsecond 🙂 line\n\nlast"
    got = {r.doc_id: r for r in attribution.token_counts(docs_of(spark, [text, None, "", "one"])).collect()}
    assert sum(got[0].section_tokens) == got[0].n_tokens == len(tokenizing.encode(text)) and got[0].n_sections == 4
    assert got[1].n_sections == got[2].n_tokens == 0 and got[3].section_tokens == [1]
    first, last, ends = np.array([0, 3]), np.array([3, 9]), np.array([4, 9])
    assert attribution.allocate(first, last, ends, "most")[0].tolist() == [1, 1]
    assert attribution.allocate(first, last, ends, "first")[0].tolist() == [2, 0]
    assert attribution.allocate(np.array([2]), np.array([6]), ends, "most") == (pytest.approx([1, 0]), 1)
    assert attribution.token_counts(odd_docs(spark)).count() == 7


def slow_distance(pattern, text):
    row = [0] * (len(text) + 1)
    for i, a in enumerate(pattern, 1):
        before, row[0] = row[0], i
        for j, b in enumerate(text, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (a != b))
    return min(row)


def test_decontamination_matches_brute_force(spark):
    random.seed(5)
    letters = lambda n: "".join(random.choice("abcd ") for _ in range(n))
    for _ in range(60):
        p, t = letters(random.randint(1, 80)), letters(random.randint(0, 90))
        assert decontaminate.myers(p, t) == slow_distance(p, t)
    items = [(i, letters(60)) for i in range(4)] + [(9, None), (10, "  ")]
    texts = [letters(200) for _ in range(4)]
    texts.append(letters(40) + items[0][1][:20] + "x" + items[0][1][21:] + letters(30))
    texts.append(letters(9) + items[1][1].upper() + letters(9) + items[2][1][3:] + letters(50))
    texts += [None, ""]
    table = spark.createDataFrame(items, "item_id long, text string")
    for block in (2_000_000, 100):
        got = {r.doc_id: dict(zip(r.item_ids, r.distances)) for r in decontaminate.matches(docs_of(spark, texts), table, 0.05, block).collect()}
        for i, t in enumerate(texts):
            want = {k: slow_distance(decontaminate.normal(x), decontaminate.normal(t)) for k, x in items[:4]}
            assert got[i] == {k: v for k, v in want.items() if v <= int(len(decontaminate.normal(items[k][1])) * 0.05)}
    _, blocks = decontaminate._blocks(table.where("item_id < 9").unionByName(spark.createDataFrame([(1, letters(300)), (1, letters(30))], "item_id long, text string")), 100)
    assert len(blocks) > 3
    for block in (2_000_000, 100):
        kept = decontaminate.matches(odd_docs(spark), table, block_chars=block, columns=("doc_id", "text"), clean_only=True)
        assert kept.count() == 7
        clean = decontaminate.matches(docs_of(spark, texts), table, 0.05, block, clean_only=True)
        assert sorted(r.doc_id for r in clean.collect()) == [0, 1, 2, 3, 6, 7]


def test_language_fuses_evidence(spark):
    got = langid.identify(spark.read.parquet(f"{FOLDER}/pages.parquet"), spark.read.parquet(f"{FOLDER}/documents.parquet"))
    truth = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang")
    right = got.where("kind = 'document'").join(truth, "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert right > 0.95 and got.count() == 250
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").dropDuplicates(["text"])
    unseen = docs.where("doc_id % 5 = 0 and text is not null").select("doc_id", F.col("lang").alias("truth"))
    masked = docs.withColumn("lang", F.when(F.col("doc_id") % 5 != 0, F.col("lang")))
    held = langid.identify(spark.read.parquet(f"{FOLDER}/pages.parquet"), masked).where("kind = 'document'").join(unseen, "doc_id")
    assert held.count() > 20 and held.agg(F.avg((F.col("truth") == F.col("lang_pred")).cast("double"))).first()[0] > 0.9
    pages = spark.createDataFrame([(None, None, None), (1, "http://h.example.de/x", ""), (2, "odd", "<html lang=EN>")], "page_id long, url string, html string")
    assert langid.identify(pages, odd_docs(spark)).count() == 10
    assert langid.identify(pages.where("false"), odd_docs(spark).where("false")).count() == 0


def test_language_knows_a_rare_one(spark):
    """A language far rarer than one sampled document is a candidate, whatever the input's size."""
    rng = random.Random(4)
    words = {"en": "the of and house water with from tree over under".split(), "de": "der und haus wasser mit von baum unter nicht auch".split(), "fi": "talo vesi kanssa puu alla mutta joka ovat yksi sitten".split()}
    made = [(i if i % 7 else None, " ".join(rng.choices(words[lang], k=40)), lang, lang, 1) for i, lang in enumerate(["en", "de"] * 1_500 + ["fi"] * 8)]
    made += [(9, "seltene worte", "xx", "x", 1)] * 4
    docs = spark.createDataFrame(made, DOCS)
    pages = spark.createDataFrame([(1, "http://h.example/x", f"<p>{made[3001][1]}</p>")], "page_id long, url string, html string")
    names, table = langid.learn(docs, sample_rows=150)
    assert names == ["de", "en", "fi"] and (table[:, :-1].max(1) > table[:, :-1].min(1) + 1).all()
    got = langid.identify(pages, docs, sample_rows=150)
    assert got.where("kind = 'page'").first().lang_pred == "fi"
    assert got.where("host = 'source:fi' and lang_pred = 'fi'").count() == 8
    assert got.where("host = 'source:en' and lang_pred = 'en'").count() == 1_500


EVIDENCE = "kind string, doc_id long, page_id long, declared string, suffix string, host string, text_ll array<double>, p array<double>"


@pytest.mark.parametrize("bytes_sent", [32 << 20, 0])
def test_language_fusion_matches_brute_force(spark, monkeypatch, bytes_sent):
    """Sums by host, parents, suffix and declaration, and their fusion, one row after another."""
    rng = random.Random(5)
    sites = ["a.x.org", "b.x.org", "x.org", "deep.a.x.org", "only.de", "10.0.0.1", "localhost", "source:s", None, "y.co.fr"]
    rows = []
    for i in range(120):
        h = rng.choice(sites)
        ll = [rng.uniform(-4, 0) for _ in range(3)]
        total = sum(map(math.exp, ll))
        suffix = h.rsplit(".", 1)[1] if h and "." in h and not h[-1].isdigit() else None
        rows.append(("page", None, i, rng.choice(["en", "de", "xx", None]), suffix, h, ll, [math.exp(x) / total for x in ll]))
    monkeypatch.setattr(langid, "HOSTS_BYTES", bytes_sent)
    monkeypatch.setattr(langid, "spread", lambda *a, **k: spread(*a, **k, least=8, hot_keys=10))
    got = {r.page_id: r for r in langid.fused(spark.createDataFrame(rows, EVIDENCE), ["aa", "bb", "cc"], 4.0).collect()}

    def held(p):
        return [round(x * 1_000_000) / 1_000_000 for x in p]

    def within(h, node):
        return h is not None and (h == node or (h.endswith("." + node) and node.count(".") and not node[-1].isdigit()))

    def likelihood(column, value, i):
        if value is None:
            return 0.0
        known = [r for r in rows if r[column] is not None]
        return math.log((sum(held(r[7])[i] for r in known if r[column] == value) + 1) / (sum(held(r[7])[i] for r in known) + len({r[column] for r in known})))

    base = [(sum(held(r[7])[i] for r in rows) + 1) / (len(rows) + 3) for i in range(3)]
    for _, _, n, declared, suffix, h, ll, p in rows:
        nodes = [] if h is None else [h] if not suffix else [".".join(h.split(".")[k:]) for k in range(max(1, len(h.split(".")) - 1))]
        groups = [[r for r in rows if within(r[5], node)] for node in nodes]
        groups = [g for k, g in enumerate(groups) if k == 0 or len(g) > len(groups[k - 1])]
        score = []
        for i in range(3):
            prior = base[i]
            for g in reversed(groups):
                prior = (max(sum(held(r[7])[i] for r in g) - p[i], 0) + 4 * prior) / (len(g) - 1 + 4)
            score.append(ll[i] + likelihood(3, declared, i) + likelihood(4, suffix, i) + math.log(prior))
        best = max(range(3), key=lambda i: score[i])
        assert got[n].lang_pred == ["aa", "bb", "cc"][best]
        assert got[n].confidence == pytest.approx(1 / sum(math.exp(x - score[best]) for x in score), rel=1e-6)


def test_language_of_sibling_hosts(spark):
    """A host with one row learns from others of its domain."""
    sure, open_ = [-0.001, -7.0], [-0.7, -0.69]
    rows = [("page", None, i, None, None, f"h{i}.x.org", sure, [0.999, 0.001]) for i in range(20)]
    rows += [("page", None, 100, None, None, "new.x.org", open_, [0.4975, 0.5025]), ("page", None, 101, None, None, "new.y.org", open_, [0.4975, 0.5025])]
    rows += [("page", None, 200 + i, None, None, f"g{i}.z{i}.org", sure[::-1], [0.001, 0.999]) for i in range(40)]
    got = {r.page_id: r.lang_pred for r in langid.fused(spark.createDataFrame(rows, EVIDENCE), ["aa", "bb"]).collect()}
    assert (got[100], got[101]) == ("aa", "bb")


def test_toxicity_learns_a_pair(spark):
    row, term, label = [], [], []
    for i in range(400):
        own = [t for t in (0, 1) if i >> t & 1]
        row += [i] * len(own)
        term += own
        label.append(float(len(own) == 2))
    bias, weight, latent = toxicity.fit(np.array(row), np.array(term), np.array(label), 2, steps=400)
    assert latent[0] @ latent[1] > 0.3
    single = toxicity._margins(np.array(row), np.array(term), 400, bias, weight, latent)[0]
    assert ((single > 0) == np.array(label, bool)).all()
    rng = random.Random(2)
    words = [f"w{i}" for i in range(300)]
    texts = [" ".join(rng.choices(words, k=30)) + (" vile" if i % 4 == 0 else "") for i in range(400)]
    docs = docs_of(spark, texts)
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(200)] + [(None, 1), (7, None)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    got = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    assert all((got[i] >= 0.5) == (i % 4 == 0) for i in range(200, 400))
    assert all(0 <= r.score <= 1 for r in toxicity.score(odd_docs(spark).drop("score"), model).collect())
    assert toxicity.score(docs, toxicity.train(docs, labels.where("false"))).agg(F.max("score")).first()[0] < 0.01
    assert toxicity.train(docs.where("false"), labels).bias <= 0


def test_toxicity_trains_pairs_that_say_nothing_alone(spark):
    """Toxic if exactly one of two common words is there: neither word has a split of its own."""
    rng = random.Random(6)
    words, rows = [f"w{i}" for i in range(300)], []
    for i in range(2_600):
        own = rng.choices(words, k=30)
        a, b = rng.random() < 0.5, rng.random() < 0.5
        own += ["red"] * a + ["blue"] * b
        rng.shuffle(own)
        rows.append((i, " ".join(own), int(a != b)))
    table = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    # labels of one id: the majority; documents of one id: one of them
    labels = table.where("doc_id < 2000").select("doc_id", "toxic")
    labels = labels.unionByName(labels.where("doc_id < 50")).unionByName(labels.where("doc_id < 50").withColumn("toxic", 1 - F.col("toxic")))
    model = toxicity.train(table.select("doc_id", "text"), labels)
    got = {r.doc_id: r.score for r in toxicity.score(table, model).collect()}
    right = [(got[i] >= 0.5) == bool(y) for i, _, y in rows if i >= 2_000]
    assert sum(right) / len(right) > 0.95


def test_toxicity_query_on_held_out_documents(spark):
    folder = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in queries.op6_toxicity(spark, folder).collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and r.predicted == int(r.score >= 0.5) for i, r in got.items())
    held = [(got[r.doc_id].predicted, r.toxic) for r in spark.read.parquet(f"{folder}/labels.parquet").collect() if got[r.doc_id].held_out]
    assert sum(p == t for p, t in held) / len(held) > 0.9


def test_toxicity_sample_is_bounded(spark):
    docs = docs_of(spark, [f"some words {'vile' if i % 2 else 'kind'} here" for i in range(500)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(500)], "doc_id long, toxic int")
    for model in (toxicity.train(docs, labels, sample_rows=60), toxicity.train(docs, labels, sample_pairs=300)):
        assert toxicity.score(docs, model).where("score >= 0.5").count() == 250


def brute_classes(texts, width):
    sets = []
    for t in texts:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set())
    part = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * len(sets[i] | sets[j]):
                a, b = part[i], part[j]
                part = [min(a, b) if p in (a, b) else p for p in part]
    return part, [len(s) for s in sets]


@pytest.mark.parametrize("small", [32, 4])
def test_near_duplicates_match_brute_force(spark, monkeypatch, small):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(500)]
    base = rng.choices(words, k=120)
    texts = [" ".join(rng.choices(words, k=rng.randint(1, 60))) for _ in range(30)]
    for _ in range(60):
        own = list(base)
        for _ in range(rng.randint(0, 10)):
            own[rng.randrange(120)] = rng.choice(words)
        texts.append(" ".join(own))
    texts += ["", None, " \t", "Solo", "solo", "a B", "A b", texts[0]]
    monkeypatch.setattr(setsketch, "SMALL", small)
    monkeypatch.setattr(setsketch, "TILE", 16)
    monkeypatch.setattr(setsketch, "SET_TILE", 8)
    got = {r.id: r for r in setsketch.near_duplicates(docs_of(spark, texts), width=2).collect()}
    part, sizes = brute_classes(texts, 2)
    assert [got[i].component_id for i in range(len(texts))] == part
    assert [got[i].n_shingles for i in range(len(texts))] == sizes


def test_near_duplicates_of_shared_ids(spark):
    """Rows of one id are one document; each of their texts keeps its own links."""
    a, b = ([f"{c}{i}" for i in range(60)] for c in "ab")
    near = lambda x: " ".join([*x[:-1], "other"])
    rows = [(1, " ".join(a)), (1, " ".join(b)), (2, near(b)), (3, near(a)), (5, "x y z"), (5, "p q r"), (7, "x y z"), (6, "p q r"), (9, "else where now"), (None, "else where now")]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], DOCS)
    got = setsketch.near_duplicates(docs, width=2).collect()
    assert sorted((r.id or 0, r.component_id, r.kept) for r in got) == [(0, 9, False), (1, 1, True), (1, 1, True), (2, 1, False), (3, 1, False), (5, 5, True), (5, 5, True), (6, 5, False), (7, 5, False), (9, 9, True)]
    assert len({r.group for r in got}) == 5
    kept = corpus_pipeline.near_duplicates(spark, docs, FOLDER)
    assert sorted(r.doc_id for r in kept.collect()) == [1, 1, 5, 5, 9]


def test_likelihood_margin_loses_no_link_at_the_threshold():
    rng = np.random.default_rng(3)
    for size, both in ((9, 8), (90, 80)):
        n, x, y = 4_000, [], []
        for _ in range(n):
            names = rng.integers(0, 1 << 63, 2 * size - both).astype(np.uint64)
            x.append(names[:size])
            y.append(names[size - both :])
        first = np.arange(n + 1) * size
        kx, ky = (setsketch.registers(np.concatenate(z), first, 160) for z in (x, y))
        sizes = np.full(n, float(size))
        assert setsketch.reaches(kx, ky, sizes, sizes, 0.6).all()


def test_spread_join_of_a_hot_key(spark):
    many = spark.range(3_000).select(F.when(F.col("id") < 2_000, 1).otherwise(F.col("id") % 50).alias("k"), "id")
    many = many.unionByName(spark.sql("select cast(null as long) as k, id from range(5)"))
    one = spark.sql("select id as k, concat('v', id) as v from range(60) where id <> 7")
    for how in ("inner", "left"):
        got = spread(many, one, "k", F.col("id"), how=how, least=10, hot_keys=20)
        assert sorted(map(str, got.select("k", "id", "v").collect())) == sorted(map(str, many.join(one, "k", how).select("k", "id", "v").collect()))


def test_near_duplicates_of_odd_rows(spark):
    got = setsketch.near_duplicates(odd_docs(spark)).collect()
    assert len(got) == 7 and all(r.component_id == r.id for r in got)
    assert setsketch.near_duplicates(odd_docs(spark).where("false")).count() == 0


def test_sketches_merge_and_estimate():
    a, b = np.arange(1, 1001, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15), np.arange(101, 1101, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    k = [setsketch.registers(x, np.array([0, len(x)]), 512)[0] for x in (a, b, np.union1d(a, b))]
    assert (np.maximum(k[0], k[1]) == k[2]).all()
    one = np.array([1000.0])
    assert abs(setsketch.likeliest(k[0][None], k[1][None], one, one)[0] - 900 / 1100) < 0.06


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(40)] + [(100 + rng.randrange(20), 100 + rng.randrange(20)) for _ in range(15)] + [(7, 7), (None, 3)]
    part = {}
    for a, b in edges:
        if a is not None and a != b:
            x, y = part.get(a, a), part.get(b, b)
            for n in {a, b} | {k for k, v in part.items() if v in (x, y)}:
                part[n] = min(x, y)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == part


def test_components_of_a_hub(spark):
    edges = [(5, i) for i in range(6, 1500)] + [(3, 1400)] + [(i, 4000) for i in range(2000, 3000)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 3 for i in [3, *range(5, 1500)]} | {i: 2000 for i in [*range(2000, 3000), 4000]}


def test_chat_reads_back_tricky_turns(spark):
    said = ["&lt;| & <|im_end|>", None, "a\nb", "<|im_start|>user\n", "&amp;amp;"]
    rows = [(1, 0, "system", "be <|good|>")] + [(1, i + 1, ("user", "assistant")[i % 2], said[i % 5]) for i in range(60)] + [(2, 0, "system", "alone"), (None, 0, None, "x"), (3, None, "assistant", "y"), (3, None, "assistant", "y"), (4, 0, "odd\nrole", "z" * 9000), (4, 1, "assistant", "long " * 3000), (4, 2, "assistant", "end")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("window", F.lit("clash"))
    out = chat.windows(turns, budget=80, history=20)
    assert out.where("conv_id = 1").count() > 3
    assert all(r.text.startswith("<|im_start|>system\n") for r in out.where("conv_id = 1").collect())
    got = {r.conv_id: r for r in chat.digest(out).collect()}
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        whole = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own)
        loss = "".join(r[3] or "" for r in own if r[2] == "assistant")
        assert got[conv].turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
        assert (got[conv].loss_sha256, got[conv].loss_chars) == (hashlib.sha256(loss.encode()).hexdigest(), len(loss))
    assert chat.digest(chat.windows(turns.where("false"))).count() == 0


def write(role, text):
    clean = lambda x: x.replace("&", "&amp;").replace("<|", "&lt;|")
    return "<|im_start|>" + clean(role).replace("\n", "&#10;") + "\n" + clean(text) + "<|im_end|>\n"


def plain_windows(turns, budget, history):
    """Texts of the windows of one conversation, one turn after another."""
    cost = lambda t: -(-len(write(*t)) // 4)
    turns = [t[2:] for t in sorted(((t is not None, t or 0, r or "", x or "") for t, r, x in turns))]
    system = [t for t in turns[:1] if t[0] == "system"]
    rest, room = turns[len(system) :], sum(map(cost, system))
    avail = max(1, budget - history - room)
    wide = max(1, avail - max((cost(t) for t in rest if 2 * cost(t) <= avail), default=0))
    groups, end, base, slot = [], 0, 0, None
    for t in rest:
        begin, end = end, end + cost(t)
        big = 2 * cost(t) > avail
        if big or slot is None or (end - base - 1) // wide != slot:
            groups.append([])
        groups[-1].append((begin, end, t))
        slot = None if big else (end - base - 1) // wide
        base = end if big else base
    out = []
    for i, group in enumerate(groups or [[]]):
        again = [g for g in groups[i - 1] if groups[i - 1][-1][1] - g[0] <= history] if i else []
        if room + sum(cost(g[2]) for g in again + group) > budget:
            again = []
        out.append("".join(write(*t) for t in system + [g[2] for g in again + group]))
    return out


def test_chat_windows_keep_their_budget_and_fill_it(spark):
    rng = random.Random(12)
    tricky = ["&", "<|im_end|>", "word ", "é", "&lt;|", "\n"]
    rows = [(c, i, "system" if i == 0 and c % 2 else rng.choice(["user", "assistant", "r" * 300, "a&b<|"]), "".join(rng.choices(tricky, k=rng.choice([0, 3, 40, 200, 900])))) for c in range(12) for i in range(60)]
    plain = [(c, i, ("user", "assistant")[i % 2], "word " * rng.randint(5, 60)) for c in range(100, 104) for i in range(120)]
    turns = spark.createDataFrame(rows + plain, "conv_id long, turn long, role string, text string")
    budget, history = 512, 64
    found = chat.windows(turns, budget, history).collect()
    cost = lambda text: -(-len(text) // 4)
    for r in found:
        parts = ["<|im_start|>" + p for p in r.text.split("<|im_start|>")[1:]]
        lead = sum(cost(p) for p in parts[:1] if p.startswith("<|im_start|>system\n"))
        alone = r.n_turns - r.n_repeated == 1 or (lead and r.n_turns <= 2)
        assert sum(map(cost, parts)) <= budget or (alone and r.n_repeated <= (lead > 0))
    whole = chat.windows(turns.where("conv_id >= 100")).collect()
    filled = [cost(r.text) / 1_024 for r in whole if r.window < max(x.window for x in whole if x.conv_id == r.conv_id)]
    assert len(filled) > 12 and sum(filled) / len(filled) > 0.8
    for conv in (0, 1, 100):
        own = [r.text for r in sorted((r for r in found if r.conv_id == conv), key=lambda r: r.window)]
        assert own == plain_windows([r[1:] for r in rows + plain if r[0] == conv], budget, history)


def test_chat_takes_a_column_of_token_counts(spark):
    turns = spark.createDataFrame([(1, i, "user", "x", 100 if i < 8 else None) for i in range(40)], "conv_id long, turn long, role string, text string, tokens long")
    sizes = [r.n_turns - r.n_repeated for r in sorted(chat.windows(turns, 450, 0, tokens="tokens").collect(), key=lambda r: r.window)]
    assert sizes[:2] == [3, 3] and sum(sizes) == 40 and sizes[2] > 20


def test_chat_splits_a_long_conversation(spark):
    rng = random.Random(4)
    long_role = "r" * 70
    rows = [(7, 0, "system", "be & good")] + [(7, i // 2 + 1, rng.choice(["user", "assistant", long_role + "a", long_role]), "w" * rng.randint(0, 300) + str(rng.randint(0, 9))) for i in range(1500)]
    rows += [(8, None, "user", f"same beginning of a text that is longer than the sixty-four letters cut {i}") for i in range(300)]
    rows += [(9, None, "user", "all alike")] * 50 + [(10, 0, "system", "alone"), (11, 0, "user", "x"), (11, 1, "system", "not first")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    parts, merge = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        cells = chat._cells(turns, chat.token_cost, None)
        assert cells.where("conv_id = 7").select("cell").distinct().count() > 4
        got = {}
        for r in sorted(chat.windows(turns, 400, 60).collect(), key=lambda r: r.window):
            got.setdefault(r.conv_id, []).append(r.text)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", merge)
    for conv in (7, 8, 9, 10, 11):
        assert got[conv] == plain_windows([r[1:] for r in rows if r[0] == conv], 400, 60)


def test_line_dedup_of_odd_pages(spark):
    menu = "<nav>Menu</nav><script>x</script>"
    rows = [(i, "http://u@Site.example:80/x", f"<p>{menu}<b>own</b> {i}</p>") for i in range(10)] + [(10, None, "<p>Menu</p>"), (11, "odd", None), (12, "http://site.example/", "<p>other</p>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit("clash"))
    got = {r.page_id: r for r in linededup.without_boilerplate(pages).collect()}
    assert got[3].text == "own 3" and got[3].n_dropped == 1 and got[3].host_pages == 11
    assert got[10].text == "Menu" and got[11].n_lines == 0 and got[12].n_dropped == 0
    assert linededup.without_boilerplate(pages.where("false")).count() == 0


@pytest.mark.parametrize("bytes_sent", [32 << 20, 0])
def test_line_dedup_matches_brute_force_on_small_hosts(spark, monkeypatch, bytes_sent):
    """Hosts of one to nine pages; the lists sent or joined, with a hot host."""
    rng = random.Random(3)
    rows = []
    for n in [*range(1, 10), 40]:
        for _ in range(n):
            own = [rng.choice(["Menu", "Imprint", "News", "Shop", f"own {len(rows)}"]) for _ in range(rng.randint(0, 5))]
            rows.append((len(rows), f"https://h{n}.example/x", own))
    monkeypatch.setattr(linededup, "LISTS_BYTES", bytes_sent)
    monkeypatch.setattr(linededup, "spread", lambda *a, **k: spread(*a, **k, least=8, hot_keys=10))
    pages = spark.createDataFrame([(i, u, "".join(f"<p>{x}</p>" for x in own)) for i, u, own in rows], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in linededup.without_boilerplate(pages).collect()}
    for i, url, own in rows:
        site = [set(x) for _, u, x in rows if u == url]
        often = {line for line in own if (k := sum(line in s for s in site)) > 1 and k > 0.2 * len(site)}
        assert got[i] == "\n".join(x for x in own if x not in often)


def test_mix_meets_targets(spark):
    rng = random.Random(9)
    rows = [(i, " ".join(["w"] * rng.randint(0, 40)), "en", rng.choice(["a", "b", "c", None]), 0) for i in range(800)]
    docs = spark.createDataFrame(rows, DOCS)
    got = mixing.mixed(docs).groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target"), F.first("source_size").alias("n"), F.max(F.col("taken") - 2 * F.col("size")).alias("over")).collect()
    assert all(abs(r.taken - r.target) <= 1 and r.over <= 0 and r.target <= 2 * r.n + 1e-6 for r in got)
    assert abs(sum(r.target for r in got) - 1.5 * sum(r.n for r in got)) < 1e-6
    mix = mixing.copies(mixing.mixed(docs))
    assert mix.select(mixing.word_count(F.col("text")).alias("n")).agg(F.sum("n")).first()[0] == sum(r.taken for r in got)
    odd = mixing.mixed(odd_docs(spark))
    assert odd.count() == 7 and dict(odd.dtypes)["size"] == "bigint" and odd.where("score = 'clash'").count() == 7
    assert mixing.mixed(docs.where("false")).count() == 0
    names = ["n", "a", "c", "target", "begin", "cell", "source_size", "taken", "key", "weight", "level", "total", "absent", "name", "held", "words"]
    clash = docs
    for name in names:
        clash = clash.withColumn(name, F.lit("clash"))
    columns = ["doc_id", "size", "source_size", "target", "taken"]
    assert sorted(map(tuple, mixing.mixed(clash).select(*columns).collect())) == sorted(map(tuple, mixing.mixed(docs).select(*columns).collect()))
    assert mixing.copies(mixing.mixed(clash)).count() == mix.count()
    assert mixing.mixed(docs, columns=("doc_id",)).columns == columns


def test_mix_moves_no_texts_and_deals_many_sources_alike(spark, monkeypatch):
    rng = random.Random(10)
    rows = [(i // 2, " ".join(["w"] * rng.randint(0, 30)), "en", rng.choice(["a", "a", "b", None]), 0) for i in range(3_000)]
    docs = spark.createDataFrame(rows + rows[:40], DOCS)
    whole = mixing.mixed(docs)
    plan = whole._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan and "Window" not in plan
    # a source at a time by hand: keys in order, whole epochs first
    sizes = {}
    for r in whole.select("source", "size", "target", "taken", mixing.sampling_key(F.col("doc_id"), mixing.plausibility(F.col("text"), F.col("size"))).alias("key"), "doc_id").collect():
        sizes.setdefault(r.source, []).append((r.key, str(r.doc_id), r.size, r.taken, r.target))
    for own in sizes.values():
        total, target = sum(r[2] for r in own), own[0][4]
        left, want = round(target - target // total * total), []
        for r in sorted(own):
            part = min(r[2], max(0, left))
            want.append((*r[:3], int(target // total) * r[2] + part))
            left -= part
        # rows alike in key, id and size may be taken in any order
        assert sorted(want) == sorted(r[:4] for r in own)
    monkeypatch.setattr(mixing, "SOURCES_BYTES", -1)
    assert sorted(map(str, mixing.mixed(docs).collect())) == sorted(map(str, whole.collect()))


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, FOLDER)
        assert i == 4 or docs.columns == columns
    assert docs.count() > 0
    odd = odd_docs(spark)
    assert corpus_pipeline.near_duplicates(spark, odd, FOLDER).count() == 6
    assert corpus_pipeline.mixture(spark, odd.where("false"), FOLDER).count() == 0
