"""Benchmark decontamination (operator 4): pigeonhole edit matching.

Texts and test items are lower-cased and their white space is collapsed. An item of m characters
may occur with up to k = floor(m * error_rate) edits; cut into k + 1 pieces, at least one piece
of any such occurrence is untouched. One automaton finds all exact hits of all pieces in a text;
the stretch around each hit that could hold its item is verified with Myers' bit-parallel
distance. The search is exact: every occurrence within the budget is found.

Items are shared in blocks of at most `block_chars` characters, or of one longer item: dealt by
hash of id and text, then cut by running sums within each deal. With one block, matching is a
narrow pass without a shuffle. With more, texts are written once with a number, blocks run one
after another over that table, only hits are written, and a block is dropped from the driver and
the executors before the next is read.

Edge cases: null and empty texts match nothing; null, empty and blank items match nothing;
repeated items with one id count once; repeated documents are answered each; empty tables give
empty or unmatched results; extra columns pass through untouched.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, release


def normal(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def myers(pattern: str, text: str) -> int:
    """Least edit distance of the pattern to any part of the text."""
    m = len(pattern)
    if not m:
        return 0
    masks: dict[str, int] = {}
    for i, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score, best = full, 0, m, m
    for c in text:
        same = masks.get(c, 0)
        vertical = same | down
        across = (((same & up) + up) ^ up) | same
        more = down | (~(across | up) & full)
        less = up & across
        if more & top:
            score += 1
        elif less & top:
            score -= 1
            if score < best:
                best = score
        more, less = more << 1 & full, less << 1 & full
        up = less | (~(vertical | more) & full)
        down = more & vertical
    return best


def pieces(item: str, budget: int) -> list[tuple[int, str]]:
    """(start, text) of budget + 1 pieces of nearly equal length."""
    cuts = [len(item) * i // (budget + 1) for i in range(budget + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


class Matcher:
    """All pieces of some items in one automaton."""

    def __init__(self, items: list[tuple[int, str]], error_rate: float) -> None:
        import ahocorasick

        self.items = [(i, t, int(len(t) * error_rate)) for i, t in ((i, normal(t)) for i, t in items) if t]
        owners: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for n, (_, text, budget) in enumerate(self.items):
            for start, piece in pieces(text, budget):
                owners[piece].append((n, start))
        self.automaton = ahocorasick.Automaton()
        for piece, own in owners.items():
            self.automaton.add_word(piece, (len(piece), own))
        if owners:
            self.automaton.make_automaton()

    def find(self, text: str | None) -> list[tuple[int, int]]:
        """(item_id, distance) of each item within its budget, by item_id."""
        text = normal(text)
        if not self.items or not text:
            return []
        stretches: dict[int, list[list[int]]] = defaultdict(list)
        for end, (size, own) in self.automaton.iter(text):
            for n, start in own:
                _, item, budget = self.items[n]
                low = max(0, end + 1 - size - start - budget)
                high = end + 1 - size - start + len(item) + budget
                held = stretches[n]
                if held and low <= held[-1][1]:
                    held[-1][1] = max(held[-1][1], high)
                    held[-1][0] = min(held[-1][0], low)
                else:
                    held.append([low, high])
        found: dict[int, int] = {}
        for n, held in stretches.items():
            item_id, item, budget = self.items[n]
            best = 0 if item in text else min(myers(item, text[a:b]) for a, b in held)
            if best <= budget:
                found[item_id] = min(best, found.get(item_id, best))
        return sorted(found.items())


_built: dict[str, Matcher] = {}


def _matcher(name: str, shared, error_rate: float) -> Matcher:
    """The matcher of a block, built once a Python worker; only the last is kept."""
    if name not in _built:
        _built.clear()
        _built[name] = Matcher(shared.value, error_rate)
    return _built[name]


def _blocks(items: DataFrame, block_chars: int) -> tuple[DataFrame, list]:
    """items with deal and part, and the distinct (deal, part) in order: blocks of bounded size."""
    total = items.agg(F.sum(F.char_length("text"))).first()[0] or 0
    deals = 1 if total <= block_chars else -(-2 * total // block_chars)
    key = F.xxhash64("item_id", "text")
    dealt = items.withColumn("deal", F.pmod(key, F.lit(deals)))
    if deals == 1:
        return dealt.withColumn("part", F.lit(0)), [(0, 0)]
    # an item that would overstep the size begins no later than it, so a part holds a size, or one item more
    before = Window.partitionBy("deal").orderBy("#key", "item_id", "text")
    sized = dealt.withColumn("#key", key).withColumn("#n", F.char_length("text"))
    cutoff = F.floor((F.sum("#n").over(before) - 1) / F.greatest(F.lit(1), F.lit(block_chars // 2)))
    placed = cut(sized.withColumn("part", cutoff.cast("long")).drop("#key", "#n"))
    return placed, [(r.deal, r.part) for r in placed.select("deal", "part").distinct().orderBy("deal", "part").collect()]


def _finder(shared, error_rate: float, passed: list[str], clean_only: bool):
    name = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = _matcher(name, shared, error_rate)
        for b in batches:
            found = [matcher.find(t.as_py()) for t in b.column("#text")]
            if clean_only:
                yield b.select(passed).filter(pa.array([not f for f in found], pa.bool_()))
                continue
            lists = [pa.array([[x[k] for x in f] for f in found], pa.list_(t)) for k, t in ((0, pa.int64()), (1, pa.int32()))]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in passed), *lists], [*passed, "#items", "#distances"])

    return run


def matches(docs: DataFrame, items: DataFrame, error_rate: float = 0.05, block_chars: int = 2_000_000, columns: tuple[str, ...] = ("doc_id",), clean_only: bool = False) -> DataFrame:
    """Each row's `columns` with item_ids and distances of the items found in its text.

    clean_only: give the rows without any item instead, and no more columns.
    """
    spark, given = docs.sparkSession, list(columns)
    items = items.where("item_id is not null and text is not null").select(F.col("item_id").cast("long").alias("item_id"), "text").distinct()
    placed, blocks = _blocks(items, block_chars)

    def shared_block(deal: int, part: int):
        own = placed.where((F.col("deal") == deal) & (F.col("part") == part))
        return spark.sparkContext.broadcast(sorted((r.item_id, r.text) for r in own.select("item_id", "text").collect()))

    rows = docs.select(*given, F.col("text").alias("#text"))
    results = "`#items` array<long>, `#distances` array<int>"
    if len(blocks) <= 1:
        shared = shared_block(*blocks[0]) if blocks else spark.sparkContext.broadcast([])
        if clean_only:
            return rows.mapInArrow(_finder(shared, error_rate, given, True), docs.select(*given).schema)
        found = rows.mapInArrow(_finder(shared, error_rate, given, False), rows.drop("#text").withColumns({"#items": F.array().cast("array<long>"), "#distances": F.array().cast("array<int>")}).schema)
        return found.select(*given, F.col("#items").alias("item_ids"), F.col("#distances").alias("distances"))
    numbered = cut(rows.withColumn("#row", F.monotonically_increasing_id()))
    hits = []
    for block in blocks:
        shared = shared_block(*block)
        found = numbered.select("#row", "#text").mapInArrow(_finder(shared, error_rate, ["#row"], False), f"`#row` long, {results}")
        hits.append(cut(found.where(F.size("#items") > 0).select("#row", F.explode(F.arrays_zip(F.col("#items").alias("item"), F.col("#distances").alias("distance"))).alias("hit")).select("#row", "hit.item", "hit.distance")))
        shared.destroy()
    every = hits[0]
    for more in hits[1:]:
        every = every.unionByName(more)
    best = every.groupBy("#row", "item").agg(F.min("distance").alias("distance"))
    listed = cut(best.groupBy("#row").agg(F.array_sort(F.collect_list(F.struct("item", "distance"))).alias("#hits")))
    release(placed, *hits)
    if clean_only:
        return numbered.join(listed.select("#row"), "#row", "left_anti").select(*given)
    none = F.array().cast(listed.schema["#hits"].dataType)
    held = numbered.drop("#text").join(listed, "#row", "left").withColumn("#hits", F.coalesce("#hits", none))
    return held.select(*given, F.col("#hits.item").alias("item_ids"), F.col("#hits.distance").alias("distances"))
