"""Source divergence audit with late strings.

Counts travel as (language, group, term digest) in fixed-width numbers. A task writes a term once
per language, with its counts in all groups; the digest is not written, as it follows from the
string. Strings are read again only for digests that are kept: their least and greatest strings
tell whether two terms share a digest, in which case the digest is split by string and counted
again. Text is joined to the few terms of the report at the end.

The divergence of two sources is a sum over all kept terms, most of which neither or only few
sources hold. A term is one row of probabilities per block of sources; tasks add up matrices of
sources by sources, and terms that no source of a block holds are one product.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomcast.session import settled


@dataclass(frozen=True)
class Audit:
    """A term is kept in a language where ``least_docs`` of its documents hold it.

    ``top`` terms are reported per group. ``held_terms`` bounds the counts that a task holds
    before it writes them; sources are compared in blocks of ``block_sources``. ``digest_bits``
    under 64 make digests collide, for tests.
    """

    least_docs: int = 10
    scale: int = 1_000_000_000
    prior: int = 2
    top: int = 10
    held_terms: int = 400_000
    block_sources: int = 256
    digest_bits: int = 64


# Small letters for large ones, blanks for all other ASCII; the bytes of other characters stay.
_LETTERS = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256)
)


def terms_of(data: bytes) -> list[bytes]:
    """Terms of a UTF-8 text: runs of ASCII letters and of characters beyond ASCII, A-Z lower-cased."""
    return data.translate(_LETTERS).split()


class _Slots(dict):
    """Terms numbered as they come."""

    def __missing__(self, term: bytes) -> int:
        self[term] = slot = len(self)
        return slot


class _Held:
    """Counts of a task per group and term, until they are written."""

    def __init__(self, params: Audit):
        self.params = params
        self.counts: defaultdict[int, dict[int, tuple[Counter, Counter]]] = defaultdict(dict)
        self.size = 0

    def add(self, lang: int, group: int, terms: list[bytes]) -> None:
        counts, docs = self.counts[lang].setdefault(group, (Counter(), Counter()))
        before = len(counts)
        counts.update(terms)
        docs.update(set(terms))
        self.size += len(counts) - before

    def flushed(self) -> Iterator[pa.RecordBatch]:
        """A row per language and term, with its counts in each group."""
        while self.counts:
            lang, groups = self.counts.popitem()
            slots = _Slots()
            sizes = [len(counts) for counts, _ in groups.values()]
            numbers = lambda parts: np.concatenate([np.fromiter(p, np.int64, k) for p, k in zip(parts, sizes, strict=True)])
            at = numbers(map(slots.__getitem__, counts) for counts, _ in groups.values())
            g = np.repeat(np.fromiter(groups, np.int64, len(groups)), sizes)
            n = numbers(counts.values() for counts, _ in groups.values())
            docs = numbers(map(held.__getitem__, counts) for counts, held in groups.values())
            order = np.argsort(at, kind="stable")
            ends = pa.array(np.concatenate([[0], np.cumsum(np.bincount(at))]).astype(np.int32))
            whole = pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(slots), lang, np.int64)),
                    pa.array(list(slots), pa.binary()),
                    *[pa.ListArray.from_arrays(ends, pa.array(x[order])) for x in (g, n, docs)],
                ],
                names=["l", "term", "g", "n", "docs"],
            )
            for start in range(0, len(slots), 50_000):
                yield whole.slice(start, 50_000)
        self.size = 0


def _counted(params: Audit):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Held(params)
        for batch in batches:
            langs, groups = batch.column("l").to_pylist(), batch.column("g").to_pylist()
            for lang, group, data in zip(langs, groups, batch.column("data"), strict=True):
                terms = terms_of(data.as_py())
                if terms:
                    held.add(lang, group, terms)
                    if held.size > params.held_terms:
                        yield from held.flushed()
        yield from held.flushed()

    return run


def named_groups(docs: DataFrame) -> tuple[DataFrame, int]:
    """All (lang, source) with 64-bit numbers l and g, and the seed that makes all numbers differ."""
    named = settled(docs.select("lang", "source").distinct(), "audit-groups")
    seed = 0
    while True:
        keyed = named.withColumns({"l": _key(seed, "lang"), "g": _key(seed, "lang", "source")})
        n, g, langs, ls = keyed.agg(
            F.count(F.lit(1)), F.count_distinct("g"), F.count_distinct("lang"), F.count_distinct("l")
        ).first()
        if n == g and langs == ls:
            return keyed, seed
        seed += 1


def _key(seed: int, *columns: str) -> Column:
    return F.xxhash64(F.lit(seed), *columns)


def _digest(params: Audit) -> Column:
    whole = F.xxhash64("term")
    return whole if params.digest_bits == 64 else whole.bitwiseAND(F.lit((1 << params.digest_bits) - 1))


def _cells(partials: DataFrame, key: list[str], params: Audit) -> DataFrame:
    """Kept terms per group: count in the group and in the language, one shuffle of numbers.

    Counts are summed per task before; a frequent term is one row per task and group. ``first``
    is 1 in one of the rows of a term in its language.
    """
    placed = partials.select("l", *key, "g", "n", "docs").repartition("l", *key)
    summed = placed.groupBy("l", *key, "g").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    term = Window.partitionBy("l", *key)
    whole = summed.withColumns(
        {"lang_docs": F.sum("docs").over(term), "lang_n": F.sum("n").over(term), "lead": F.min("g").over(term)}
    )
    kept = whole.where(F.col("lang_docs") >= params.least_docs)
    return settled(
        kept.select("l", *key, "g", "n", "lang_n", (F.col("lead") == F.col("g")).cast("int").alias("first")), "audit-cells"
    )


def counted_terms(docs: DataFrame, params: Audit) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Groups, cells (l, digest, split, g, n, lang_n, first) and strings (digest, split, term)."""
    groups, seed = named_groups(docs)
    rows = docs.select(_key(seed, "lang").alias("l"), _key(seed, "lang", "source").alias("g"), F.col("text").cast("binary").alias("data"))
    schema = "l bigint, term binary, g array<bigint>, n array<bigint>, docs array<bigint>"
    partials = settled(rows.mapInArrow(_counted(params), schema), "audit-counts").withColumn("term", F.col("term").cast("string"))
    digest = _digest(params)
    per_group = F.inline(F.arrays_zip("g", "n", "docs"))
    cells = _cells(partials.select("l", digest.alias("digest"), per_group), ["digest"], params)
    # Only strings are shuffled here: their digests are computed again on the other side.
    strings = partials.select("term")
    listed = cells.select("digest").distinct()
    kept = strings.join(listed, digest == listed["digest"], "left_semi")
    edges = kept.groupBy(digest.alias("digest")).agg(F.min("term").alias("term"), F.max("term").alias("high"))
    edges = settled(edges, "audit-strings")
    shared = edges.where("term != high").select("digest")
    if shared.isEmpty():
        return groups, cells.withColumn("split", F.lit(0)), edges.select("digest", F.lit(0).alias("split"), "term")
    # Digests of several terms: number their strings, and count again by digest and number.
    names = strings.withColumn("digest", digest).join(shared, "digest").distinct()
    numbered = names.withColumn("split", F.row_number().over(Window.partitionBy("digest").orderBy("term")))
    numbered = settled(numbered, "audit-split")
    split = partials.withColumn("digest", digest).join(numbered, ["digest", "term"], "left")
    split = split.select("l", "digest", F.coalesce("split", F.lit(0)).alias("split"), per_group)
    sound = edges.where("term = high").select("digest", F.lit(0).alias("split"), "term")
    return groups, _cells(split, ["digest", "split"], params), sound.unionByName(numbered.select("digest", "split", "term"))


def _chance(n: Column, total: Column, vocabulary: Column, params: Audit) -> Column:
    """Smoothed share of a term in whole parts of ``scale``; exact beyond 64 bits."""
    wide = lambda c: c.cast("decimal(20,0)")
    top = F.lit(params.scale).cast("decimal(11,0)") * (wide(n) + params.prior).cast("decimal(21,0)")
    exact = F.call_function("div", top, (wide(total) + params.prior * wide(vocabulary)).cast("decimal(24,0)")) + 1
    # Counts under this bound fit into 64 bits.
    small = F.call_function("div", params.scale * (n + params.prior), total + params.prior * vocabulary) + 1
    return F.when(n < (1 << 62) // params.scale, small).otherwise(exact)


def _distance(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def _totals(groups: DataFrame, cells: DataFrame, params: Audit) -> DataFrame:
    """Per group: words of kept terms, those and the vocabulary of its language, number of its source."""
    sums = cells.groupBy("g").agg(F.sum("n").alias("total"), F.sum("first").alias("firsts"))
    lang = Window.partitionBy("l")
    joined = groups.join(sums, "g", "left").withColumns(
        {"total": F.coalesce("total", F.lit(0)).cast("long"), "firsts": F.coalesce("firsts", F.lit(0))}
    )
    summed = joined.withColumns(
        {
            "vocabulary": F.sum("firsts").over(lang).cast("long"),
            "lang_total": F.sum("total").over(lang).cast("long"),
            "no": F.row_number().over(lang.orderBy("source")) - 1,
            "sources": F.count(F.lit(1)).over(lang).cast("int"),
        }
    )
    absent = F.when(F.col("vocabulary") > 0, _chance(F.lit(0).cast("long"), F.col("total"), F.col("vocabulary"), params))
    return settled(summed.withColumn("absent", absent), "audit-totals")


def _matrices(params: Audit):
    size = params.block_sources

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int, int], list] = {}

        def flushed() -> Iterator[pa.RecordBatch]:
            for (lang, i, j), (matrix, terms) in held.items():
                a, b = np.indices(matrix.shape)
                keep = (a < b) if i == j else np.ones(matrix.shape, bool)
                count = int(keep.sum())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(count, lang, np.int64)),
                        pa.array((a[keep] + i * size).astype(np.int32)),
                        pa.array((b[keep] + j * size).astype(np.int32)),
                        pa.array(matrix[keep]),
                        pa.array(np.full(count, terms, np.int64)),
                    ],
                    names=["l", "a", "b", "value", "terms"],
                )
            held.clear()

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(k).to_numpy().astype(np.int64) for k in ("l", "i", "j")], axis=1)
            for key in np.unique(keys, axis=0):
                rows = pa.array(np.flatnonzero((keys == key).all(axis=1)))
                part = batch.take(rows)
                lang, i, j = key.tolist()
                left = np.array(part.column("left")[0].as_py(), np.int64)
                right = np.array(part.column("right")[0].as_py(), np.int64)
                present = part.column("present")
                owner = np.repeat(np.arange(len(part)), present.value_lengths().to_numpy())
                flat = present.flatten()
                no, p = flat.field("no").to_numpy(), flat.field("p").to_numpy()
                sides = []
                for block, absent in ((i, left), (j, right)):
                    values = np.tile(absent, (len(part), 1))
                    own = no // size == block
                    values[owner[own], no[own] % size] = p[own]
                    sides.append(values)
                if (lang, i, j) not in held:
                    if sum(m.size for m, _ in held.values()) > 4_000_000:
                        yield from flushed()
                    held[lang, i, j] = [np.zeros((len(left), len(right)), np.int64), 0]
                cell = held[lang, i, j]
                for at in range(0, len(part), 1024):
                    x, y = (s[at : at + 1024] for s in sides)
                    for a in range(len(left)):
                        difference = y - x[:, a : a + 1]
                        cell[0][a] += (difference * difference // (y + x[:, a : a + 1])).sum(axis=0)
                cell[1] += len(part)
        yield from flushed()

    return run


def _pairs(scored: DataFrame, totals: DataFrame, key: list[str], params: Audit) -> DataFrame:
    """Value of every ordered pair of sources of a language."""
    size = params.block_sources
    own = F.floor(F.col("no") / size).cast("int")
    meets = F.transform(
        F.sequence(F.lit(0), F.floor((F.col("sources") - 1) / size).cast("int")),
        lambda other: F.struct(F.least(own, other).alias("i"), F.greatest(own, other).alias("j")),
    )
    spread = scored.select("l", *key, "no", "p", F.explode(meets).alias("x"))
    # At most two blocks of sources in a group.
    terms = spread.groupBy("l", *key, "x").agg(F.collect_list(F.struct("no", "p")).alias("present"))
    blocks = totals.groupBy("l", F.floor(F.col("no") / size).cast("int").alias("block")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("no", "absent"))), lambda s: s["absent"]).alias("values")
    )
    blocks = settled(blocks, "audit-blocks")
    side = lambda k, name: blocks.select("l", F.col("block").alias(k), F.col("values").alias(name))
    rows = terms.select("l", "x.i", "x.j", "present").join(side("i", "left"), ["l", "i"]).join(side("j", "right"), ["l", "j"])
    sums = rows.select("l", "i", "j", "left", "right", "present").mapInArrow(
        _matrices(params), "l bigint, a int, b int, value bigint, terms bigint"
    )
    sums = settled(sums.groupBy("l", "a", "b").agg(F.sum("value").alias("value"), F.sum("terms").alias("terms")), "audit-sums")
    one = totals.select("l", "lang", "source", "no", "vocabulary", "absent")
    two = totals.select("l", F.col("source").alias("item"), F.col("no").alias("other"), F.col("absent").alias("other_absent"))
    pairs = one.join(two, "l").where("no != other").withColumns({"a": F.least("no", "other"), "b": F.greatest("no", "other")})
    rest = (F.col("vocabulary") - F.coalesce("terms", F.lit(0))) * _distance(F.col("absent"), F.col("other_absent"))
    # Without kept terms there is no absent probability either: the sum is empty.
    value = F.coalesce("value", F.lit(0)) + F.coalesce(rest, F.lit(0))
    return pairs.join(sums, ["l", "a", "b"], "left").select("lang", "source", F.lit("pair").alias("part"), "item", value.cast("long").alias("value"))


def _top_terms(scored: DataFrame, strings: DataFrame, totals: DataFrame, key: list[str], params: Audit) -> DataFrame:
    """The terms of each group that exceed their language most; only these get their text."""
    q = _chance(F.col("lang_n"), F.col("lang_total"), F.col("vocabulary"), params)
    over = scored.withColumn("q", q).where("p > q").select("g", *key, _distance(F.col("p"), F.col("q")).alias("value"))
    best = Window.partitionBy("g").orderBy(F.desc("value"))
    tied = over.withColumn("r", F.rank().over(best)).where(F.col("r") <= params.top).drop("r")
    named = tied.join(strings, key).withColumnRenamed("term", "item")
    place = F.row_number().over(Window.partitionBy("g").orderBy(F.desc("value"), "item"))
    few = named.withColumn("place", place).where(F.col("place") <= params.top)
    return few.join(totals.select("g", "lang", "source"), "g").select(
        "lang", "source", F.lit("term").alias("part"), "item", "value"
    )


def audit_sources(docs: DataFrame, params: Audit = Audit()) -> DataFrame:
    """lang, source, part, item, value, rank: divergence of sources and the terms behind it.

    Part ``pair`` has a row per other source of the language, part ``term`` the ``top`` kept
    terms that a group holds more often than its language. Null lang, source and text count as
    empty; a group without terms is compared by its prior alone, and a language without kept
    terms has pairs of value 0. Every row is a document, repeated ones too; a text of any length
    is read whole. An empty table gives no rows. Columns besides text, lang and source are not
    read. No source or term is gathered in one task: counts are summed per task first and spread
    by term.
    """
    empty = F.lit("")
    plain = docs.select(*[F.coalesce(F.col(c).cast("string"), empty).alias(c) for c in ("text", "lang", "source")])
    groups, cells, strings = counted_terms(plain, params)
    key = ["digest", "split"]
    totals = _totals(groups, cells, params)
    of_group = totals.select("g", "total", "lang_total", "vocabulary", "no", "sources")
    p = _chance(F.col("n"), F.col("total"), F.col("vocabulary"), params)
    scored = cells.join(of_group, "g").withColumn("p", p)
    found = _pairs(scored, totals, key, params).unionByName(_top_terms(scored, strings, totals, key, params))
    rank = F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item"))
    return found.withColumn("rank", rank)
