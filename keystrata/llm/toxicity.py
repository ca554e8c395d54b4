"""Toxicity (operator 6): a factorization machine over hashed terms.

Terms are the words of a text (white-space separated, A-Z lower-cased, edge punctuation cut)
and their leading 5 to 8 bytes, hashed to 2**20 buckets and counted as present or absent. The
machine adds a linear weight per term and the inner products of latent vectors of all pairs of
terms that occur together, so an insult beside a group mention can weigh more than both alone.

Training uses a bounded sample of the labelled documents (at most `sample_rows`, those of smallest
hash of doc_id, and at most `sample_pairs` distinct terms of documents in all), on the driver, in
three steps. First a machine over all terms that two sampled documents share is trained by
stochastic gradients, so a term can be found that says nothing alone. Then terms are chosen:
the `terms_kept` whose own split by label is least likely by chance, and those whose
latent vectors the first machine grew most, as such and weighed by how often they are seen: none, `pairs_first` of either, four times as many and so on up to all, as long as that
does better on a quarter of the sample. Last a machine over the chosen terms is fitted on the whole
sample, with the ridge that did best. Scoring is one narrow pass over
whole texts without a shuffle.

Edge cases: null and empty texts score the model's bias; labels that are null or have no
document take no part; of labels that share a doc_id the majority counts (toxic if even), of documents that
do one text is learnt from (that of smallest hash); with no labels, or labels of one kind only,
every score is that kind's share (0 without labels). Rows with null doc_id are scored and never
learnt from. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import _SPACE, _VALUES, _power_table, buffers, mix64, runs

BITS = 20
PREFIXES = (5, 6, 7, 8)
#: Pairs of a text and a term that a step of fit holds parameters of at once.
PAIRS_HELD = 1 << 16
_MARK = np.zeros(256, bool)
_MARK[[*b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"]] = True
_OUT = _SPACE | _MARK


def terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and row of each word and word prefix; repeated ones are repeated."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    letter = ~_OUT[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    begins, ends = letter.copy(), letter.copy()
    begins[1:] &= ~letter[:-1] | edge[1:-1]
    ends[:-1] &= ~letter[1:] | edge[1:-1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    row = np.searchsorted(offsets, start, side="right") - 1
    power, inverse = _power_table(n)
    total = np.zeros(n + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(_VALUES[data] * power[:n], out=total[1:])
        parts, rows = [mix64((total[end] - total[start]) * inverse[start])], [row]
        for k in PREFIXES:
            long = np.flatnonzero(end - start > k)
            s = start[long]
            parts.append(mix64((total[s + k] - total[s]) * inverse[s] + np.uint64(k)))
            rows.append(row[long])
    return (np.concatenate(parts) >> np.uint64(64 - BITS)).astype(np.int64), np.concatenate(rows)


def present(data: np.ndarray, offsets: np.ndarray, slot: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, term) pairs in row order; slot maps buckets to chosen terms, -1 for none."""
    bucket, row = terms(data, offsets)
    if slot is not None:
        bucket = slot[bucket]
        row, bucket = row[bucket >= 0], bucket[bucket >= 0]
    key = np.unique((row << BITS) | bucket)
    return key >> BITS, key & ((1 << BITS) - 1)


@dataclass
class Model:
    """bias, linear weights and latent vectors; slot[bucket] is the term's place or -1."""

    slot: np.ndarray
    bias: float
    weight: np.ndarray
    latent: np.ndarray

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        row, term = present(data, offsets, self.slot)
        return _sigmoid(_margins(row, term, len(offsets) - 1, self.bias, self.weight, self.latent)[0])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _margins(row, term, rows, bias, weight, latent):
    sums = np.stack([np.bincount(row, latent[term, f], rows) for f in range(latent.shape[1])], 1) if len(row) else np.zeros((rows, latent.shape[1]))
    squares = np.bincount(row, (latent[term] ** 2).sum(1), rows) if len(row) else np.zeros(rows)
    linear = np.bincount(row, weight[term], rows) if len(row) else np.zeros(rows)
    return bias + linear + 0.5 * ((sums**2).sum(1) - squares), sums


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of the runs of values (along their last axis) that begin at first (and end at the next); 0 for empty runs."""
    filled = np.flatnonzero(np.diff(first))
    out = np.zeros((*values.shape[:-1], len(first) - 1), values.dtype)
    if len(filled):
        out[..., filled] = np.add.reduceat(values, first[filled], axis=-1)
    return out


def _gaps(held: np.ndarray, first: np.ndarray, bias: float, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Score minus label of each row, and its latent sums; held: the parameters (first axis) of each pair, rows in order."""
    sums, squares = _sums(held, first), _sums((held[1:] ** 2).sum(0), first)
    margin = bias + sums[0] + 0.5 * ((sums[1:] ** 2).sum(0) - squares)
    return (_sigmoid(margin) - label).astype(np.float32), sums


def explore(row: np.ndarray, term: np.ndarray, label: np.ndarray, size: int, factors: int = 4, epochs: int = 4, batch: int = 512, rate: float = 0.05, ridge: float = 1e-4, seed: int = 7) -> np.ndarray:
    """Parameters (size x (1 + factors)) of a machine over all terms, by adaptive stochastic gradients; rows in order."""
    n, rng = len(label), np.random.default_rng(seed)
    first = np.searchsorted(row, np.arange(n + 1))
    bias = float(np.log((label.sum() + 1) / (n - label.sum() + 1)))
    params = np.concatenate([np.zeros((size, 1)), rng.normal(0, 0.05, (size, factors))], 1).astype(np.float32)
    past = np.full(params.shape, 1e-6, np.float32)
    for _ in range(epochs):
        for a in range(0, n, batch):
            b = min(n, a + batch)
            at = slice(first[a], first[b])
            own, place = np.unique(term[at], return_inverse=True)
            held = params[own][place]
            gap, sums = _gaps(held.T, first[a : b + 1] - first[a], bias, label[a:b])
            r = row[at] - a
            pull = gap[r]
            each = np.concatenate([pull[:, None], pull[:, None] * (sums.T[r, 1:] - held[:, 1:])], 1)
            grad = np.stack([np.bincount(place, each[:, f], len(own)) for f in range(1 + factors)], 1).astype(np.float32) / (b - a) + ridge * params[own]
            past[own] += grad**2
            params[own] -= rate * grad / np.sqrt(past[own])
            bias -= rate * float(gap.mean())
    return params


def fit(row: np.ndarray, term: np.ndarray, label: np.ndarray, size: int, factors: int = 6, steps: int = 200, ridge: float = 2e-4, seed: int = 7) -> tuple[float, np.ndarray, np.ndarray]:
    """Adam on the mean log loss of all given rows; (row, term) pairs of presence, rows in order."""
    n, rate = len(label), 0.05
    first = np.searchsorted(row, np.arange(n + 1))
    by_term = np.argsort(term, kind="stable")
    term_first, row_of = np.searchsorted(term[by_term], np.arange(size + 1)), row[by_term]
    # some pairs at a time: memory doesn't grow with a step's pairs
    row_runs, term_runs = list(runs(first, PAIRS_HELD)), list(runs(term_first, PAIRS_HELD))
    gaps, pull, pulled = np.zeros(n, np.float32), np.zeros((1 + factors, n), np.float32), np.zeros((1 + factors, size), np.float32)
    bias = float(np.log((label.sum() + 1) / (n - label.sum() + 1)))
    # parameters lie along the first axis, so that gathering and summing run over contiguous numbers
    params = np.ascontiguousarray(np.concatenate([np.zeros((size, 1)), np.random.default_rng(seed).normal(0, 0.02, (size, factors))], 1).T, np.float32)
    one, two, b_one, b_two = np.zeros_like(params), np.zeros_like(params), 0.0, 0.0
    for step in range(1, steps + 1):
        for a, b in row_runs:
            gap, sums = _gaps(params.take(term[first[a] : first[b]], 1), first[a : b + 1] - first[a], bias, label[a:b])
            gaps[a:b] = gap
            pull[0, a:b] = gap / n
            pull[1:, a:b] = pull[0, a:b] * sums[1:]
        mean = float(gaps.mean())
        # the sum of gap * (row's sum - own vector) over a term's rows
        for a, b in term_runs:
            pulled[:, a:b] = _sums(pull.take(row_of[term_first[a] : term_first[b]], 1), term_first[a : b + 1] - term_first[a])
        pulled[1:] -= pulled[:1] * params[1:]
        grad = pulled + ridge * params
        one += 0.1 * (grad - one)
        two += 0.001 * (grad * grad - two)
        params -= rate * (one / (1 - 0.9**step)) / (np.sqrt(two / (1 - 0.999**step)) + 1e-8)
        b_one += 0.1 * (mean - b_one)
        b_two += 0.001 * (mean * mean - b_two)
        bias -= rate * (b_one / (1 - 0.9**step)) / (np.sqrt(b_two / (1 - 0.999**step)) + 1e-8)
    return bias, params[0].astype(float), params[1:].T.astype(float)


def _loss(margin: np.ndarray, label: np.ndarray) -> float:
    p = np.clip(_sigmoid(margin), 1e-6, 1 - 1e-6)
    return float(-(label * np.log(p) + (1 - label) * np.log(1 - p)).mean())


def learn(row: np.ndarray, bucket: np.ndarray, label: np.ndarray, terms_kept: int = 2_048, pairs_first: int = 128, least: float = 12.0, ridges: tuple[float, ...] = (2e-4, 3e-3)) -> Model:
    """The machine of a sample in memory: distinct (row, bucket) pairs, rows in order, and both kinds of labels.

    To spare memory, bucket (int32) is overwritten. pairs_first: the least number of terms tried besides those
    that split the labels alone; four times as many are tried as long as one of the last two steps did better.
    """
    seen = np.bincount(bucket, minlength=1 << BITS)
    slot = np.where(seen >= 2, np.cumsum(seen >= 2) - 1, -1).astype(np.int32)
    names = np.flatnonzero(seen >= 2)
    size, seen, n = len(names), seen[names], len(label)
    np.take(slot, bucket, out=bucket, mode="clip")
    shared = bucket >= 0
    row, term = row[shared], bucket[shared]
    explored = explore(row, term, label, size)
    grown = np.sqrt((explored[:, 1:] ** 2).sum(1))
    toxic = np.bincount(term, label[row], size)
    n1 = label.sum()
    split = n * (toxic * (n - n1 - seen + toxic) - (seen - toxic) * (n1 - toxic)) ** 2 / (seen * (n - seen + 0.5) * (n - n1) * n1)
    alone = np.argsort(-split, kind="stable")[: min(terms_kept, int((split >= least).sum()))]
    # by what a term adds to a text that has it, and by what it adds to all texts
    by_growth = np.stack([np.argsort(-grown, kind="stable"), np.argsort(-grown * np.sqrt(seen), kind="stable")])
    judged = np.arange(n) % 4 == 0
    new = np.cumsum(~judged) - 1

    def of(chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        place = np.full(size, -1, np.int32)
        place[chosen] = np.arange(len(chosen))
        held = place[term] >= 0
        return row[held], place[term[held]], max(1, len(chosen))

    best, more, worse = None, 0, 0
    while worse < 2 and more < 4 * size + pairs_first:
        chosen, before = np.union1d(alone, by_growth[:, :more]), best
        r, t, most = of(chosen)
        mine = ~judged[r]
        for ridge in ridges:
            trial = fit(new[r[mine]], t[mine], label[~judged], most, ridge=ridge)
            found = _loss(_margins(r, t, n, *trial)[0][judged], label[judged])
            if best is None or found < best[0]:
                best = found, chosen, ridge
        worse = worse + 1 if best is before else 0
        more = max(pairs_first, 4 * more)
    _, chosen, ridge = best
    slot = np.full(1 << BITS, -1, np.int32)
    slot[names[chosen]] = np.arange(len(chosen))
    return Model(slot, *fit(*of(chosen)[:2], label, max(1, len(chosen)), ridge=ridge))


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = 20_000, sample_pairs: int = 6_000_000) -> Model:
    """Fit on at most sample_rows labelled documents and sample_pairs pairs of a document and a term."""
    counted = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.avg((F.col("toxic") != 0).cast("int")).alias("share"))
    own = counted.select("doc_id", (F.col("share") >= 0.5).cast("int").alias("toxic"), F.xxhash64("doc_id", F.lit(5)).alias("at"))
    total = own.count()
    empty = Model(np.full(1 << BITS, -1, np.int32), -30.0, np.zeros(1), np.zeros((1, 1)))
    if not total:
        return empty
    # about sample_rows of them (a little more) by 64 bits of hash, then exactly the smallest
    share = (sample_rows + 5 * sample_rows**0.5 + 100) / total
    if share < 1:
        own = own.where(F.col("at") < int(share * 2**64) - 2**63)
    own = own.orderBy("at", "doc_id").limit(sample_rows)
    # at most sample_rows rows of three numbers
    sample = docs.select("doc_id", "text").join(F.broadcast(own), "doc_id").groupBy("doc_id").agg(F.min_by("text", F.xxhash64("text")).alias("text"), F.first("toxic").alias("toxic"), F.first("at").alias("at"))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, at = buffers(b.column("text"))
            for i, j in runs(at):
                row, term = present(data[at[i] : at[j]], at[i : j + 1] - at[i])
                ends = np.searchsorted(row, np.arange(j - i + 1)).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(term.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([*(b.column(c).slice(i, j - i) for c in ("doc_id", "toxic", "at")), lists], ["doc_id", "toxic", "at", "terms"])

    # two passes over a bounded table: how much there is, and what is taken
    taken = sample.select("doc_id", "toxic", "at", "text").mapInArrow(gather, "doc_id long, toxic int, at long, terms array<int>").persist(StorageLevel.DISK_ONLY)
    sizes = taken.select("at", F.size("terms").alias("n")).toPandas().sort_values("at")
    within = np.cumsum(sizes["n"].to_numpy()) <= sample_pairs
    last, total = (int(sizes["at"].to_numpy()[within][-1]), int(sizes["n"].to_numpy()[within].sum())) if within.any() else (-(2**63), 0)
    parts = taken.where(F.col("at") <= last).orderBy("at").select("toxic", "terms").toArrow().to_batches()
    taken.unpersist()
    label = (np.concatenate([np.zeros(0, np.int32), *(np.asarray(p.column("toxic")) for p in parts)]) != 0).astype(float)
    if not len(label) or label.min() == label.max():
        return Model(empty.slot, 30.0 if len(label) and label.max() else -30.0, np.zeros(1), np.zeros((1, 1)))
    bucket, counts, at = np.empty(total, np.int32), [], 0
    for p in parts:
        own = p.column("terms")
        counts.append(np.asarray(pa.compute.list_value_length(own), np.int64))
        flat = np.asarray(own.flatten())
        bucket[at : at + len(flat)] = flat
        at += len(flat)
    del parts, p, own, flat
    row = np.repeat(np.arange(len(label), dtype=np.int32), np.concatenate(counts))
    return learn(row, bucket, label)


def score(docs: DataFrame, model: Model, columns: tuple[str, ...] = ("doc_id",), kept: bool = False) -> DataFrame:
    """The given columns of each row with its `score`, a narrow pass over whole texts.

    kept: give whole rows of `columns` (the text among them) of those scored under 0.5 only.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    asked = list(dict.fromkeys([*columns, "text"]))
    schema = docs.select(*columns).schema.add("score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, at = buffers(b.column("text"))
            out = np.zeros(b.num_rows)
            for i, j in runs(at):
                out[i:j] = shared.value.score(data[at[i] : at[j]], at[i : j + 1] - at[i])
            given = pa.RecordBatch.from_arrays([*(b.column(c) for c in columns), pa.array(out)], [*columns, "score"])
            yield given.filter(pa.array(out < 0.5)) if kept else given
        pa.default_memory_pool().release_unused()

    return docs.select(*asked).mapInArrow(run, schema)
