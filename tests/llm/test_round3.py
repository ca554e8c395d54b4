"""Operators 11 to 13 against brute force, and inputs made to break hashes, patterns, sums and learning."""

from __future__ import annotations

import datetime as dt
import hashlib
import math
import random
import time
import zlib
from pathlib import Path

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from keystrata.llm import clickdedup, exact, langid, linededup, negatives, setsketch, simhash, topk, toxicity
from tests.llm.test_operators import WORD, docs_of, odd_docs

EPOCH = dt.datetime(1970, 1, 1)


# --- operator 11


def brute_fingerprint(text, width=3):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    parts = [" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))] if words else []
    hashes = [xxhash.xxh64(p.encode(), seed=42).intdigest() for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fingerprints, radius):
    """Smallest reachable position by plain search over all pairs."""
    f, label = np.array(fingerprints, np.uint64), np.arange(len(fingerprints))
    for i in range(len(f)):
        near = np.unique(label[np.bitwise_count(f ^ f[i]) <= radius])
        label[np.isin(label, near)] = near.min()
    return label


@pytest.mark.parametrize("parts", [4, 8])
def test_simhash_matches_brute_force(spark, monkeypatch, parts):
    monkeypatch.setattr(simhash, "TILE", 16)
    rng = random.Random(1)
    base = [" ".join(rng.choices("abcdefghij KLM é 日本".split() + [f"w{i}" for i in range(30)], k=rng.randint(0, 60))) for _ in range(60)]
    texts = base + [t.upper() for t in base[:10]] + [t + " tail" for t in base] + [None, "", " \x0b\n", "one", "One", "two words"]
    got = {r.id: r for r in simhash.near_duplicates(docs_of(spark, texts), parts=parts).collect()}
    f = [brute_fingerprint(t) for t in texts]
    assert [got[i].fingerprint for i in range(len(texts))] == [f"{x:016x}" for x in f]
    assert [got[i].component_id for i in range(len(texts))] == brute_components(f, 2).tolist()


@pytest.mark.parametrize("parts", [1, 4, 16])
def test_tiles_meet_all_pairs_within_the_radius(spark, monkeypatch, parts):
    """A chain, a dense ball and far ones, in tiles of several chunks."""
    monkeypatch.setattr(simhash, "TILE", 8)
    rng = np.random.default_rng(2)
    centre = int(rng.integers(1 << 63))
    ball = [centre ^ (1 << i) for i in range(0, 40)] + [centre]
    chain = [int(rng.integers(1 << 62))]
    for i in range(20):
        chain.append(chain[-1] ^ (1 << (3 * i % 64)) ^ (1 << ((3 * i + 1) % 64)))
    f = sorted({*ball, *chain, *map(int, rng.integers(0, 1 << 63, 150)), 0, (1 << 64) - 1, 3})
    df = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in f], "f long").repartition(5)
    links = simhash.links(df, 2, parts).collect()
    place = {x: i for i, x in enumerate(f)}
    label = np.arange(len(f))
    for r in links:
        a, b = place[r.a % (1 << 64)], place[r.b % (1 << 64)]
        assert bin(f[a] ^ f[b]).count("1") <= 2
        label[label == max(label[a], label[b])] = min(label[a], label[b])
    assert (label == brute_components(f, 2)).all()


def test_simhash_links_are_true_links(spark):
    texts = [f"alpha beta gamma delta {i % 7} epsilon zeta eta theta iota kappa" for i in range(40)]
    classes = simhash.fingerprints(docs_of(spark, texts)).select("f").distinct()
    for r in simhash.links(classes, 30).collect():
        assert bin((r.a ^ r.b) % (1 << 64)).count("1") <= 30


@pytest.mark.parametrize("radius", [12, 20])
def test_simhash_of_a_wide_radius(spark, monkeypatch, radius):
    """As many parts as leave few steps; the components are those of all pairs."""
    monkeypatch.setattr(simhash, "TILE", 16)
    assert all(simhash.n_steps(p, r) == len(simhash.steps(p, r)) for p, r in [(1, 30), (2, 9), (4, 2), (4, 3), (8, 2), (16, 2)])
    rng = random.Random(3)
    f = sorted({rng.getrandbits(64) & rng.getrandbits(64) for _ in range(150)})
    df = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in f], "f long")
    place, label = {x: i for i, x in enumerate(f)}, np.arange(len(f))
    for r in simhash.links(df, radius).collect():
        a, b = place[r.a % (1 << 64)], place[r.b % (1 << 64)]
        assert bin(f[a] ^ f[b]).count("1") <= radius
        label[label == max(label[a], label[b])] = min(label[a], label[b])
    assert (label == brute_components(f, radius)).all()
    assert len(set(label)) < len(f)


def test_simhash_of_odd_rows(spark):
    got = [(r.id, r.component_id) for r in simhash.near_duplicates(odd_docs(spark)).collect()]
    assert sorted(got, key=str) == sorted([(None, None), (1, 1), (2, 1), (3, 3), (4, 4), (4, 4), (5, got[[g[0] for g in got].index(5)][1])], key=str)
    both = spark.createDataFrame([(1, "a b c d"), (1, "e f g h"), (2, "e f g h"), (3, "a b c d")], "doc_id long, text string")
    assert {r.component_id for r in simhash.near_duplicates(both).collect()} == {1}
    assert simhash.near_duplicates(docs_of(spark, [])).count() == 0


# --- operator 12


def brute_negatives(rows, anchors, positives=5, negatives_=10):
    out = []
    for a in anchors:
        score = {id(r): sum(int(p) * int(q) for p, q in zip(a[2], r[2], strict=True)) for r in rows if len(r[2]) == len(a[2])}
        fit = sorted((r for r in rows if id(r) in score), key=lambda r: (-score[id(r)], r[0]))
        for p in [r for r in fit if r[1] == a[1] and r[0] != a[0]][:positives]:
            s = score[id(p)]
            within = [r for r in fit if r[1] != a[1] and 30 * s <= 100 * score[id(r)] <= 90 * s][:negatives_]
            out += [(a[0], p[0], i, r[0], s, score[id(r)]) for i, r in enumerate(within, 1)]
    return sorted(out)


@pytest.mark.parametrize("block", [3, 16_384])
def test_hard_negatives_match_brute_force(spark, block):
    rng = np.random.default_rng(3)
    rows = [(i, int(rng.integers(3)), rng.integers(-3, 6, 4).astype(float).tolist()) for i in range(400)]
    rows += [(1000 + i, 1, rows[0][2]) for i in range(40)] + [(2000 + i, 2, rows[100][2]) for i in range(40)]  # ties
    rows += [(3000, 1, [1.0, 2.0]), (3010, 1, [3.0, 1.0]), (3001, 0, [2.0, 1.0]), (5, 1, rows[5][2])]
    odd = [(None, 1, [1.0] * 4), (4000, None, [1.0] * 4), (4010, 1, None), (4020, 1, [1.0, None, 0.0, 0.0]), (4030, 1, [float("inf")] * 4)]
    df = negatives.labelled(spark.createDataFrame(rows + odd, "vec_id long, label int, embedding array<double>").repartition(7), F.col("label"), scale=2)
    got = negatives.mine(df, df.where("id % 50 = 0"), anchor_block=block)
    whole = [(i, y, np.floor(np.array(v) * 2)) for i, y, v in rows]
    want = brute_negatives(whole, [r for r in whole if r[0] % 50 == 0])
    assert sorted(map(tuple, got.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())) == want
    assert len(want) > 100
    assert negatives.mine(df, df.where("false")).count() == 0


def test_products_are_exact():
    rng = np.random.default_rng(4)
    left, right = rng.integers(-(2**20), 2**20, (3, 5)).astype(float), rng.integers(-(2**20), 2**20, (6, 5)).astype(float)
    right[2] *= 2.0**20
    want = [[sum(int(p) * int(q) for p, q in zip(a, b, strict=True)) for b in right] for a in left]
    assert exact.products(left, right).tolist() == want
    assert exact.products(left, right[:0]).shape == (3, 0)
    with pytest.raises(OverflowError):
        exact.products(np.full((1, 1), 2.0**40), np.full((1, 1), 2.0**40))


def test_top_k_takes_large_components(spark):
    rng = np.random.default_rng(5)
    rows = [(i, (rng.normal(0, 1, 3) * 10.0 ** rng.integers(0, 5)).tolist()) for i in range(200)] + [(500, [3e5, 0.25, 0.0]), (501, [1e6, 0.0, -3.0])]
    v = topk.integers(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    got = topk.top_k(v, v.where("id % 100 = 0"), 5, pivots=4).collect()
    whole = {i: [math.floor(1024 * c) for c in x] for i, x in rows}
    for q in (0, 100, 500):
        best = sorted((-sum(a * b for a, b in zip(whole[q], x, strict=True)), i) for i, x in whole.items() if i != q)[:5]
        assert [(-r.score, r.vec_id) for r in sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])] == best


# --- operator 13


def micros(x):
    return (x - EPOCH) // dt.timedelta(microseconds=1)


def brute_windows(rows, batches=8):
    """Batches and windows row by row."""
    text, copies = lambda x: "" if x is None else str(x), []
    for r in rows:
        if r.click_id is None or r.click_id < 0 or r.arrived_at is None:
            continue
        for j in range(r.click_id % 3 + 1):
            c = zlib.crc32(f"{r.click_id}:{j}".encode())
            hour = micros(r.arrived_at) // 3_600_000_000 + 6 * j * (c % 10)
            value = "" if r.value is None else str(math.floor(100 * r.value + 0.5))
            content = "|".join([text(r.client_id), text(r.kind), value, "" if r.ts is None else str(micros(r.ts)), text(r.props), str(c % 3)])
            copies.append((r.click_id, hour, hour + c // 10 % 200, hashlib.sha256(content.encode()).hexdigest()))
    low, high = min(c[2] for c in copies), max(c[2] for c in copies)
    dealt = [[] for _ in range(batches)]
    for c in copies:
        dealt[(c[2] - low) * batches // (high - low + 1)].append(c)
    latest, held, out = None, {}, []
    for b, batch in enumerate(dealt):
        for i, hour, _, h in sorted(batch, key=lambda c: (c[0], c[1], c[3])):
            if b and latest is not None and hour < latest - 96:
                continue
            w = held.get(i)
            if w and hour <= w[0] + 24:
                w[1] += 1
                if h != w[4]:
                    w[2] += 1
                    w[3] += zlib.crc32(h.encode())
                continue
            if w:
                out.append((i, w[0], b, *w[1:]))
            held[i] = [hour, 0, 0, 0, h]
        latest = max([c[1] for c in batch] + ([] if latest is None else [latest]), default=None)
        for i in [i for i, w in held.items() if b == batches - 1 or w[0] + 24 < latest - 96]:
            w = held.pop(i)
            out.append((i, w[0], b, *w[1:]))
    return sorted(out)


def test_click_windows_match_brute_force(spark):
    """Many repeats in a hot id, exact and conflicting copies, late rows, an empty batch, odd rows; several buckets."""
    rng = random.Random(6)
    rows = []
    for n in range(900):
        i = 2 if n % 3 == 0 else rng.randrange(120)
        at = dt.datetime(2024, 1, 1) + dt.timedelta(minutes=rng.choice([rng.randrange(60 * 24 * 20), 60 * 24 * 60 + rng.randrange(60 * 24 * 30)]))
        row = (i, at - dt.timedelta(seconds=5), at, rng.choice([1, None]), rng.choice(["a|b", None, ""]), rng.choice([1.005, None, -2.5]), rng.choice(["{}", None, "é"]))
        rows += [row] * rng.choice([1, 1, 3])
    rows += [(None, None, rows[0][2], 1, "k", 1.0, "p"), (7, None, None, 1, "k", 1.0, "p"), (-1, None, rows[0][2], 1, "k", 1.0, "p")]
    df = spark.createDataFrame(rows, "click_id long, ts timestamp_ntz, arrived_at timestamp_ntz, client_id long, kind string, value double, props string").withColumn("hour", F.lit("clash"))
    got = clickdedup.expiring_windows(clickdedup.copies(df), bucket_rows=40).cache()
    want = brute_windows(df.collect())
    assert sorted(map(tuple, got.select("click_id", "start_hour", "closed_batch", "n_repeats", "n_conflicts", "conflict_crc", "hash").collect())) == want
    assert len({w[2] for w in want}) < 8 and any(w[4] for w in want)
    empty = clickdedup.expiring_windows(clickdedup.copies(df.where("click_id is null")))
    assert empty.count() == 0 and sorted(empty.columns) == sorted(got.columns)


def test_click_batches_take_one_step_each(spark):
    """Windows of buckets without a click in the last batch close in it, not in a step after it."""
    rows = [(i, None, dt.datetime(2024, 1, 1) + dt.timedelta(hours=3 * i), 1, "k", 1.0, "p") for i in range(300)]
    df = spark.createDataFrame(rows, "click_id long, ts timestamp_ntz, arrived_at timestamp_ntz, client_id long, kind string, value double, props string")
    got = clickdedup.expiring_windows(clickdedup.copies(df), bucket_rows=1)
    assert {int(f.split("/step=")[1].split("/")[0]) for f in got.inputFiles()} == set(range(8))
    assert sorted(map(tuple, got.select("click_id", "start_hour", "closed_batch", "n_repeats", "n_conflicts", "conflict_crc", "hash").collect())) == brute_windows(df.collect())


def test_click_state_opens_no_native_store(spark):
    """The state is in plain files of the checkpoint, also when there are enough of them to be merged."""
    rows = [(i % 90, None, dt.datetime(2024, 1, 1) + dt.timedelta(hours=i), 1, "k", float(i % 4), "p") for i in range(900)]
    df = spark.createDataFrame(rows, "click_id long, ts timestamp_ntz, arrived_at timestamp_ntz, client_id long, kind string, value double, props string")
    got = clickdedup.expiring_windows(clickdedup.copies(df), batches=14, bucket_rows=20)
    folder = Path(got.inputFiles()[0].removeprefix("file://").split("/closed/")[0])
    kinds = {f.suffix for f in (folder / "checkpoint/state/0").glob("[0-9]*/[0-9]*")}
    assert kinds - {".crc"} == {".delta", ".snapshot"}  # RocksDB's are .changelog and .zip
    assert sorted(map(tuple, got.select("click_id", "start_hour", "closed_batch", "n_repeats", "n_conflicts", "conflict_crc", "hash").collect())) == brute_windows(df.collect(), 14)


# --- what was broken before


def test_words_that_collide_as_polynomials_are_told_apart(spark):
    word = "a"
    for _ in range(9):
        word += word.translate(str.maketrans("ab", "ba"))
    other = word.translate(str.maketrans("ab", "ba"))
    got = {r.id: r.component_id for r in setsketch.near_duplicates(docs_of(spark, [f"{word} one", f"{other} one", f"{word} ONE"]), width=2).collect()}
    assert got == {0: 0, 1: 1, 2: 0}


@pytest.mark.parametrize("piece", ["<script ", "<!--", "<style>", "<p ", "< ", "</script "])
def test_broken_markup_takes_linear_time(spark, piece):
    page = "<p>first line</p>" + piece * (1_000_000 // len(piece))
    df = spark.createDataFrame([(page,)], "html string")
    began = time.perf_counter()
    n = df.select(F.size(linededup.lines(F.col("html"))), F.length(F.regexp_replace("html", langid.TAGS, " "))).first()[0]
    assert n >= 1 and time.perf_counter() - began < 5


def test_unclosed_markup_goes_to_the_end(spark):
    df = spark.createDataFrame([("<p>a</p><!-- b <p>c</p>",), ("a<script>b</script >c<script>d",), ("1 < 2 <b>and</b> 3",)], "html string")
    assert [r[0] for r in df.select(linededup.lines(F.col("html"))).collect()] == [["a"], ["a", "c"], ["1 < 2 and 3"]]


def xor_texts(pairs, n, seed):
    """Bag of words of common ones, and of a pair's words perhaps; toxic if just one of these is there."""
    rng = np.random.default_rng(seed)
    texts, labels = [], []
    for _ in range(n):
        k, a, b = rng.integers(pairs), rng.random() < 0.5, rng.random() < 0.5
        words = [f"c{i}" for i in rng.choice(400, 20, replace=False)] + [f"l{k}"] * a + [f"r{k}"] * b
        texts.append(" ".join(words))
        labels.append(int(a != b))
    return texts, labels


@pytest.mark.parametrize(("pairs", "share"), [(1, 0.95), (80, 0.65)])
def test_toxicity_finds_pairs(spark, pairs, share):
    """All of one; most of 80, each seen in 188 texts (0.50 where none is found)."""
    texts, labels = xor_texts(pairs, 20_000, 3)
    docs = docs_of(spark, texts).select("doc_id", "text")
    model = toxicity.train(docs, spark.createDataFrame([(i, 1, y) for i, y in enumerate(labels[:15_000])], "doc_id long, quality int, toxic int"))
    got = {r.doc_id: r.score >= 0.5 for r in toxicity.score(docs.where("doc_id >= 15000"), model).collect()}
    assert np.mean([got[i] == bool(labels[i]) for i in range(15_000, 20_000)]) > share


def test_margins_are_sums_over_all_pairs():
    rng = np.random.default_rng(7)
    weight, latent = rng.normal(size=6), rng.normal(size=(6, 3))
    rows = [[0, 2, 5], [], [1], [0, 1, 2, 3, 4, 5]]
    row, term = (np.array(x) for x in zip(*((i, t) for i, ts in enumerate(rows) for t in ts), strict=True))
    got = toxicity._margins(row, term, len(rows), 0.5, weight, latent)[0]
    want = [0.5 + sum(weight[t] for t in ts) + sum(latent[a] @ latent[b] for a in ts for b in ts if a < b) for ts in rows]
    assert got == pytest.approx(want)
