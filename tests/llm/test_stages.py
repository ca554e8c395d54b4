"""Each pipeline stage and query over odd rows, empty tables and clashing columns."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from keystrata.llm import decontaminate, mixing, packing, queries, tokenizing, toxicity
from tests.llm.test_operators import DOCS, FOLDER, WORD, brute_classes, odd_docs, slow_distance

TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations", "clicks")


def folder_of(spark, at, change):
    """Copies of the smallest tables, each changed by change(name, table)."""
    for name in TABLES:
        change(name, spark.read.parquet(f"{FOLDER}/{name}.parquet")).write.parquet(f"{at}/{name}.parquet")
    return str(at)


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    return folder_of(spark, tmp_path_factory.mktemp("empty"), lambda name, t: t.where("false"))


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    """A row of nulls, a repeated row and extra columns named like the operators' own."""

    def change(name, t):
        nulls = t.limit(1).select(*(F.lit(None).cast(f.dataType).alias(f.name) for f in t.schema))
        rows = t.limit(20)
        extra = [c for c in ("id", "score", "size", "band", "taken", "key", "n", "row", "line", "toxic_") if c not in t.columns]
        return rows.unionByName(rows.limit(2)).unionByName(nulls).select("*", *(F.lit("clash").alias(c) for c in extra))

    return folder_of(spark, tmp_path_factory.mktemp("odd"), change)


@pytest.mark.parametrize("name", list(queries.queries()))
def test_query_of_empty_tables(spark, empty, name):
    assert queries.queries()[name](spark, empty).count() == (1 if name == "op8_chat" else 0)


@pytest.mark.parametrize("name", list(queries.queries()))
def test_query_of_odd_tables(spark, odd, name):
    found = queries.queries()[name](spark, odd)
    n = found.count()
    if name in ("op4_decontaminate", "op6_toxicity", "op7_near_duplicates", "op10_mixing", "op11_simhash"):
        assert n == spark.read.parquet(f"{odd}/documents.parquet").count()
    assert n > 0 or name == "op12_hard_negatives"  # the one anchor of these rows has no window that holds any


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stage_of_odd_and_empty_rows(spark, empty, odd, name, stage):
    docs = odd_docs(spark)
    for given in (empty, odd):
        found = stage(spark, docs, given)
        assert name == "token_ids" or found.columns == list(corpus_pipeline.COLUMNS)
        assert found.count() > 0
    assert stage(spark, docs.where("false"), odd).count() == 0
    assert stage(spark, spark.createDataFrame([], DOCS), empty).count() == 0


def test_pipeline_of_empty_and_odd_tables(spark, empty, odd):
    assert corpus_pipeline.run(spark, empty).count() == 0
    assert corpus_pipeline.run(spark, odd).count() > 0


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    """Documents with toxic ones, near copies and a benchmark passage; and their tables."""
    rng, at = random.Random(11), tmp_path_factory.mktemp("planted")
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(rng.choices(words, k=rng.randint(20, 60))) for _ in range(120)]
    texts = [f"{t} vile {t[:20]}" if i % 6 == 0 else t for i, t in enumerate(texts)]
    for i in range(1, 40, 3):
        own = texts[i].split()
        own[-1] = "other"
        texts.append(" ".join(own))
    texts += [texts[2], texts[2].upper()]
    item = " ".join(rng.choices(words, k=12))
    texts += [f"{texts[4]} {item} end", f"start {item[:9]}z{item[10:]} {texts[5]}", None, "", "  "]
    docs = spark.createDataFrame([(i, t, "en", "ab"[i % 2], len(t or "")) for i, t in enumerate(texts)], DOCS)
    spark.createDataFrame([(i, int(i % 6 == 0)) for i in range(0, 120)], "doc_id long, toxic int").write.parquet(f"{at}/labels.parquet")
    spark.createDataFrame([(7, item)], "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    return docs, str(at), texts, item


def kept(stage, spark, planted):
    return sorted(r.doc_id for r in stage(spark, planted[0], planted[1]).collect())


def test_stage_toxicity_drops_what_scores_high(spark, planted):
    docs, at, texts, _ = planted
    model = toxicity.train(docs, spark.read.parquet(f"{at}/labels.parquet"))
    scored = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    got = kept(corpus_pipeline.toxic, spark, planted)
    assert got == [i for i in range(len(texts)) if scored[i] < 0.5]
    assert not any(i in got for i in range(0, 120, 6)) and len(got) > 110


def test_stage_near_duplicates_matches_brute_force(spark, planted):
    part, _ = brute_classes(planted[2], 5)
    assert kept(corpus_pipeline.near_duplicates, spark, planted) == [i for i, p in enumerate(part) if i == p]
    assert len(set(part)) < len(part) - 8


def test_stage_decontamination_matches_brute_force(spark, planted):
    _, _, texts, item = planted
    budget = int(len(decontaminate.normal(item)) * 0.05)
    clean = [i for i, t in enumerate(texts) if slow_distance(decontaminate.normal(item), decontaminate.normal(t)) > budget]
    assert kept(corpus_pipeline.decontaminated, spark, planted) == clean and len(clean) == len(texts) - 2


def test_stage_mixing_takes_what_is_planned(spark, planted):
    docs, at, texts, _ = planted
    plan = {r.doc_id: r for r in mixing.mixed(docs).collect()}
    got: dict = {}
    for r in corpus_pipeline.mixture(spark, docs, at).collect():
        assert r.n_chars == len(r.text) and texts[r.doc_id].startswith(r.text)
        got.setdefault(r.doc_id, []).append(len(WORD.findall(r.text)))
    for i, r in plan.items():
        whole, part = divmod(r.taken, r["size"]) if r["size"] else (0, 0)
        assert sorted(got.get(i, [])) == sorted([r["size"]] * whole + [part] * (part > 0))


def test_stage_token_ids_round_trip(spark, planted):
    docs, at, texts, _ = planted
    pieces: dict = {}
    for r in packing.segments(corpus_pipeline.tokens(spark, docs, at)).collect():
        pieces.setdefault((r.doc_id, r.text), []).append((r.piece, r.ids))
    back = {i: tokenizing.encoding().decode([t for _, p in sorted(x) for t in p]) for (i, _), x in pieces.items()}
    assert back == {i: t for i, t in enumerate(texts) if t}
