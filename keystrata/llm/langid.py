"""Language identification (operator 5): Bayesian fusion of four kinds of evidence.

1. Text: log likelihoods of hashed byte trigrams under each language, learnt from a bounded
   sample of documents with a known language, dealt evenly over the languages; trigrams overlap,
   so a text counts as at most `strength` independent observations.
2. Declared markup language (html lang) and 3. address suffix: P(value | language), estimated
   by grouped sums of the text posteriors over all rows, so a site-wide wrong declaration is
   learnt to be weak evidence.
4. Host prior: the share of languages on the row's host without the row itself, smoothed towards
   that of its parent domain, this towards the next, label by label, and the last of two labels
   towards the whole input's. A parent with no rows besides its child's adds no level, so nothing
   counts twice; nor is the bare suffix a level, as it is evidence of its own.

The four are added in the log domain and normalised. Documents take part beside pages with
their source as host, and neither declaration nor suffix. All sums are grouped aggregations with
partial sums before the shuffle. What a host and its suffix say is one row a host; that table is
sent if its measured size is under `HOSTS_BYTES`, else joined with the rows of hot hosts dealt over
several tasks. Declarations are two or three letters, so their table has a bound.

Edge cases: null and empty texts have no text evidence; an unknown or null declaration, suffix
or host adds nothing; a host in numbers or of over 253 characters has no parents; languages are those with `least_docs` documents in the whole table, ties go
to the first by name; without any language the result has null language. Repeated rows count each;
null ids are kept; empty tables give empty results; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import buffers, cut, release, runs, spread
from .linededup import HIDDEN, host

BITS = 14
LEAST_SAMPLE = 25
HOSTS_BYTES = 32 << 20
_CODE = np.zeros(256, np.uint32)
_CODE[97:123] = np.arange(1, 27)
_CODE[65:91] = np.arange(1, 27)
_CODE[128:] = np.arange(27, 155)
#: Markup and entities; what isn't closed goes to the end of the page.
TAGS = HIDDEN + r"|<[^<>]*>|&[a-z#0-9]+;"


def trigrams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each byte trigram of letters, by position; 2**BITS where there is none. And the counts per row."""
    n = len(data)
    code = _CODE[data]
    key = np.full(n, 1 << BITS, np.int64)
    if n >= 3:
        raw = (code[:-2] * np.uint32(24_036_583) + code[1:-1] * np.uint32(155)) + code[2:]
        mixed = (raw * np.uint32(2_654_435_761)) >> np.uint32(32 - BITS)
        able = (code[:-2] + code[1:-1] > 0) & (code[1:-1] + code[2:] > 0)
        key[:-2] = np.where(able, mixed, 1 << BITS)
        for back in (1, 2):  # none crosses rows
            at = offsets[1:] - back
            key[at[at >= 0]] = 1 << BITS
    seen = np.concatenate([[0], np.cumsum(key < 1 << BITS)])
    return key, np.diff(seen[offsets])


def _even(counts: list[int], total: int) -> float:
    """The most rows of each group so that about total rows are taken in all; what small groups leave goes to the others."""
    left, groups = total, len(counts)
    for c in sorted(counts):
        if c * groups > left:
            return left / groups
        left, groups = left - c, groups - 1
    return float("inf")


def learn(docs: DataFrame, sample_rows: int = 8_000, least_docs: int = 5) -> tuple[list[str], np.ndarray]:
    """Languages and their trigrams' log probabilities.

    The languages are those of least_docs documents in the whole table; about sample_rows
    documents are learnt from, dealt evenly over the languages (LEAST_SAMPLE each at least).
    """
    # by id and text: null and repeated ids don't go together
    known = docs.where("lang is not null and text is not null").select("lang", "text", F.xxhash64("doc_id", "text", F.lit(9)).alias("at"))
    counts = known.groupBy("lang").agg(F.count("*").alias("n"), F.approx_count_distinct("at").alias("kinds")).where(F.col("n") >= least_docs).collect()
    names = sorted(r.lang for r in counts)
    if not names:
        return [], np.zeros((0, (1 << BITS) + 1))
    most = max(LEAST_SAMPLE, _even([r.kinds for r in counts], sample_rows))
    below = [(r.lang, int(min(1.0, most / max(1, r.kinds)) * (2**64 - 2**12)) - 2**63) for r in counts]
    # one row a language, of which the driver holds the table anyway
    taken = F.broadcast(docs.sparkSession.createDataFrame(below, "lang string, below long"))
    sample = known.join(taken, "lang").where((F.col("at") < F.col("below")) | (F.col("below") >= 2**63 - 2**12)).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally: dict[str, np.ndarray] = {}
        for b in batches:
            data, at = buffers(b.column("text"))
            lang = np.array(b.column("lang").to_pylist(), object)
            for i, j in runs(at):
                key, _ = trigrams(data[at[i] : at[j]], at[i : j + 1] - at[i])
                for name in set(lang[i:j]):
                    own = np.repeat(lang[i:j] == name, np.diff(at[i : j + 1]))
                    t = tally.setdefault(name, np.zeros(1 << BITS, np.int64))
                    t += np.bincount(key[own], minlength=(1 << BITS) + 1)[:-1]
        for name, t in tally.items():
            at = np.flatnonzero(t)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at)), pa.array(at), pa.array(t[at])], ["lang", "bucket", "n"])

    rows = sample.mapInArrow(count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    lang, bucket, n = np.array(rows.column("lang").to_pylist(), object), np.asarray(rows.column("bucket"), np.int64), np.asarray(rows.column("n"), np.int64)
    table = np.zeros((len(names), (1 << BITS) + 1))
    for k, name in enumerate(names):
        own = lang == name
        counts = np.full(1 << BITS, 0.1)
        counts[bucket[own]] += n[own]
        table[k, :-1] = np.log(counts / counts.sum())
    return names, table


def text_evidence(rows: DataFrame, table: np.ndarray, strength: float, markup: bool) -> DataFrame:
    """rows with the log likelihoods `text_ll` of their text, and these as shares `p`, in its place."""
    shared = rows.sparkSession.sparkContext.broadcast(table.astype(np.float32))
    if markup:
        rows = rows.withColumn("text", F.regexp_replace("text", TAGS, " "))
    rest = [c for c in rows.columns if c != "text"]
    schema = rows.select(*rest).schema.add("text_ll", T.ArrayType(T.DoubleType())).add("p", T.ArrayType(T.DoubleType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = shared.value
        for b in batches:
            data, at = buffers(b.column("text"))
            out = np.zeros((b.num_rows, len(scores)))
            for i, j in runs(at):
                own = at[i : j + 1] - at[i]
                key, n = trigrams(data[at[i] : at[j]], own)
                full = np.flatnonzero(np.diff(own))
                if not len(full):
                    continue
                weight = np.minimum(n / 3, strength) / np.maximum(n, 1)
                for k in range(len(scores)):
                    sums = np.zeros(j - i)
                    sums[full] = np.add.reduceat(scores[k][key], own[:-1][full], dtype=np.float64)
                    out[i:j, k] = sums * weight
            p = np.exp(out - out.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            lists = pa.list_(pa.float64())
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in rest), pa.array(list(out), lists), pa.array(list(p), lists)], [*rest, "text_ll", "p"])

    return rows.mapInArrow(run, schema)


def _summed(n: int) -> list[Column]:
    # rounded, so that the order of a sum can't change a result
    return [F.sum(F.round(F.col("p")[i] * 1_000_000).cast("long")).alias(f"s{i}") for i in range(n)]


def _array(n: int) -> Column:
    return F.array(*(F.col(f"s{i}") / 1_000_000.0 for i in range(n)))


def levels(host: Column) -> Column:
    """A host and its parent domains of two labels at least, from narrow to wide."""
    labels = F.split(host, r"\.")
    n = F.size(labels)
    parents = F.transform(F.sequence(F.lit(0), F.greatest(n - 2, F.lit(0))), lambda i: F.array_join(F.slice(labels, i + 1, n - i), "."))
    plain = host.startswith("source:") | (F.char_length(host) > 253) | ~host.rlike(r"\.[a-z][a-z0-9-]*$")
    return F.when(plain, F.array(host)).otherwise(parents)


def likelihoods(sums: DataFrame, column: str, n: int) -> DataFrame:
    """column and log P(value | language), smoothed, of every value, as `ll`; sums: column, s0, s1, ..."""
    whole = sums.agg(*(F.sum(f"s{i}").alias(f"s{i}") for i in range(n)), F.count("*").alias("k")).first()
    return sums.select(column, F.array(*(F.ln((F.col(f"s{i}") / 1_000_000.0 + 1.0) / F.lit((whole[f"s{i}"] or 0) / 1_000_000.0 + whole.k)) for i in range(n))).alias("ll"))


def host_facts(rows: DataFrame, n: int) -> tuple[DataFrame, int]:
    """One row a host: host, rows, chain (row count and language sums of each level, narrow to wide) and by_suffix; and the bytes of all."""
    hosts = cut(rows.where("host is not null").groupBy("host", "suffix").agg(*_summed(n), F.count("*").alias("rows")))
    steps = hosts.select("host", "rows", *(f"s{i}" for i in range(n)), F.posexplode(levels(F.col("host"))).alias("level", "node"))
    nodes = steps.groupBy("node").agg(*(F.sum(f"s{i}").alias(f"s{i}") for i in range(n)), F.sum("rows").alias("rows")).select("node", F.struct("rows", _array(n).alias("sums")).alias("held"))
    placed = cut(steps.select("host", "level", "node"))
    chain = spread(placed, nodes, "node", F.col("host")).groupBy("host").agg(F.array_sort(F.collect_list(F.struct("level", "held"))).alias("chain"))
    chain = chain.select("host", F.filter("chain", lambda x, i: (i == 0) | (x["held"]["rows"] > F.get(F.col("chain"), i - 1)["held"]["rows"])).alias("chain"))
    by_suffix = cut(hosts.where("suffix is not null").groupBy("suffix").agg(*(F.sum(f"s{i}").alias(f"s{i}") for i in range(n))))
    named = spread(hosts.select("host", "rows", "suffix"), likelihoods(by_suffix, "suffix", n).withColumnRenamed("ll", "by_suffix"), "suffix", F.col("host"), how="left")
    facts = cut(named.join(chain, "host").select("host", "rows", F.transform("chain", lambda x: x["held"]).alias("chain"), "by_suffix"))
    size = facts.agg(F.sum(F.octet_length("host") + 64 + F.size("chain") * (40 + 8 * n) + 8 * n)).first()[0] or 0
    release(hosts, placed, by_suffix)
    return facts, size


def identify(pages: DataFrame, docs: DataFrame, strength: float = 60.0, host_weight: float = 4.0, sample_rows: int = 8_000) -> DataFrame:
    """kind ('page' or 'document'), doc_id, page_id, lang_pred, confidence, text_lang, declared, suffix, host."""
    names, table = learn(docs, sample_rows)
    if not names:
        names, table = [""], np.zeros((1, (1 << BITS) + 1))
    declared = F.lower(F.regexp_extract(F.coalesce(F.col("html"), F.lit("")), r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z]{2,3})", 1))
    site = host(F.col("url"))
    # the last label, unless the host is an address in numbers
    suffix = F.nullif(F.regexp_extract(F.coalesce(site, F.lit("")), r"\.([a-z][a-z0-9-]*)$", 1), F.lit(""))
    none = F.lit(None)
    web = pages.select(F.lit("page").alias("kind"), none.cast("long").alias("doc_id"), F.col("page_id").cast("long").alias("page_id"), F.nullif(declared, F.lit("")).alias("declared"), suffix.alias("suffix"), site.alias("host"), F.col("html").alias("text"))
    own = docs.select(F.lit("document").alias("kind"), F.col("doc_id").cast("long").alias("doc_id"), none.cast("long").alias("page_id"), none.cast("string").alias("declared"), none.cast("string").alias("suffix"), F.concat(F.lit("source:"), F.col("source")).alias("host"), "text")
    return fused(cut(text_evidence(web, table, strength, True).unionByName(text_evidence(own, table, strength, False))), names, host_weight)


def fused(rows: DataFrame, names: list[str], host_weight: float = 4.0) -> DataFrame:
    """The language of each row of text evidence (text_ll, p), given declared, suffix and host; names: the languages in order."""
    n = len(names)
    whole = rows.agg(*_summed(n), F.count("*").alias("rows")).first()
    base = [((whole[f"s{i}"] or 0) / 1_000_000 + 1) / (whole.rows + n) for i in range(n)]
    facts, size = host_facts(rows, n)
    # two or three letters: 18,252 rows at most
    by_markup = likelihoods(rows.where("declared is not null").groupBy("declared").agg(*_summed(n)), "declared", n).withColumnRenamed("ll", "by_markup")
    if size <= HOSTS_BYTES:
        joined = rows.join(F.broadcast(facts.drop("rows")), "host", "left")
    else:
        joined = spread(rows, facts.drop("rows"), "host", F.monotonically_increasing_id(), facts.select("host", F.col("rows").alias("n")), whole.rows, how="left")
    joined = joined.join(F.broadcast(by_markup), "declared", "left")

    def prior(i: int) -> Column:
        """Without the row itself; from the widest level to the host."""
        here = F.col("p")[i]
        return F.aggregate(F.reverse(F.coalesce("chain", F.array().cast(facts.schema["chain"].dataType))), F.lit(base[i]), lambda wide, x: (F.greatest(x["sums"][i] - here, F.lit(0.0)) + host_weight * wide) / (x["rows"] - 1 + host_weight))

    def most(prefix: str) -> Column:
        return F.greatest(*(F.col(f"{prefix}{i}") for i in range(n))) if n > 1 else F.col(f"{prefix}0")

    def label(prefix: str) -> Column:
        return F.nullif(F.coalesce(*(F.when(F.col(f"{prefix}{i}") == F.col(f"{prefix}m"), names[i]) for i in range(n))), F.lit(""))

    zero = F.lit(0.0)
    logs = joined.select("kind", "doc_id", "page_id", "declared", "suffix", "host", *(F.col("text_ll")[i].alias(f"t{i}") for i in range(n)), *((F.col("text_ll")[i] + F.coalesce(F.col("by_markup")[i], zero) + F.coalesce(F.col("by_suffix")[i], zero) + F.ln(prior(i))).alias(f"a{i}") for i in range(n)))
    logs = logs.withColumn("am", most("a")).withColumn("tm", most("t")).withColumn("share", sum((F.exp(F.col(f"a{i}") - F.col("am")) for i in range(n)), zero))
    return logs.select("kind", "doc_id", "page_id", label("a").alias("lang_pred"), (1 / F.col("share")).alias("confidence"), F.when(F.col("t0") != F.col(f"t{n - 1}"), label("t")).alias("text_lang"), "declared", "suffix", "host")
