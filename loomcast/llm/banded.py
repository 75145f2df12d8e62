"""MinHash near-duplicates with sequential Bayesian verification.

Equal shingle sets are one set. Bands of a MinHash signature propose pairs; signatures are then
compared a batch of hashes at a time, and a pair is dropped as soon as the posterior chance that
its similarity reaches the threshold falls under ``miss``. What survives all looks is compared
exactly on the full shingle sets.

Pairs of a bucket are looked at in two rounds, so that a bucket of many copies costs no square.
First every member meets the hub of its bucket; verified links make components. Then only members
of the same bucket that are still in different components meet, in blocks. Of the pairs that
survive there, a block returns only a tree that ties their sets together; sets that are tied are a
cluster, and inside clusters pairs are compared exactly, again in blocks, until all of a block are
one component or no pair is left. A pair that is skipped lies in one component already, so the
components are those of all links, and rows grow with the sets, not with their pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomcast.llm.common import parallel
from loomcast.llm.components import connected_components
from loomcast.llm.sketch import shingle_hashes
from loomcast.session import settled


@dataclass(frozen=True)
class BandedSearch:
    """Pairs with ``percent`` of 100 shingles of ``words`` words in common are links.

    ``bands`` of ``rows`` hashes propose pairs; ``batch`` hashes are compared between two looks,
    and ``miss`` is the posterior chance below which a look drops a pair. Buckets are compared in
    blocks of ``block`` sets, hubs verified with ``partners`` sets in a task's group, and clusters
    in blocks of about ``cluster_sets`` sets and ``cluster_shingles`` shingles.
    """

    words: int = 4
    percent: int = 80
    bands: int = 25
    rows: int = 5
    hashes: int = 128
    batch: int = 32
    miss: float = 1e-5
    block: int = 2048
    partners: int = 256
    cluster_sets: int = 1000
    cluster_shingles: int = 1_000_000

    def _at_most(self, equal: int, n: int, similarity: float) -> float:
        return sum(math.comb(n, k) * similarity**k * (1 - similarity) ** (n - k) for k in range(equal + 1))

    @cached_property
    def least_equal(self) -> list[int]:
        """Equal hashes that a pair needs at each look.

        With an even prior, ``m`` equal of ``n`` make the similarity Beta(m + 1, n - m + 1); its
        chance to reach the threshold t is that of at most m successes in n + 1 trials of t.
        """
        needs = []
        for n in range(self.batch, self.hashes + 1, self.batch):
            needs.append(next(m for m in range(n + 1) if self._at_most(m, n + 1, self.percent / 100) >= self.miss))
        return needs

    def expected_recall(self, similarity: float) -> float:
        """Chance that a pair shares a band and passes all looks, taken as independent."""
        alive = {0: 1.0}
        step = [math.comb(self.batch, k) * similarity**k * (1 - similarity) ** (self.batch - k) for k in range(self.batch + 1)]
        for need in self.least_equal:
            later: dict[int, float] = {}
            for equal, chance in alive.items():
                for k, p in enumerate(step):
                    if equal + k >= need:
                        later[equal + k] = later.get(equal + k, 0.0) + chance * p
            alive = later
        return sum(alive.values()) * (1 - (1 - similarity**self.rows) ** self.bands)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingle_set(data: bytes, width: int) -> np.ndarray:
    """Sorted distinct hashes of the word runs of a whole text, A-Z lower-cased."""
    words = data.lower().split()
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    return np.unique(shingle_hashes(hashes, width))


def signature(shingles: np.ndarray, hashes: int) -> np.ndarray:
    """Least value of every hash function over a set that is not empty."""
    seeds = _mixed(np.arange(1, 2 * hashes + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    factor, shift = seeds[:hashes].astype(np.uint32) | np.uint32(1), seeds[hashes:].astype(np.uint32)
    low = (shingles >> np.uint64(32)).astype(np.uint32) ^ shingles.astype(np.uint32)
    out = np.full(hashes, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(low), 2048):
        out = np.minimum(out, ((low[at : at + 2048, None] ^ shift) * factor).min(axis=0))
    return out


def band_keys(signatures: np.ndarray, params: BandedSearch) -> np.ndarray:
    """A key per set and band; equal keys have equal hashes in the same band."""
    keys = np.empty((len(signatures), params.bands), np.uint64)
    for band in range(params.bands):
        key = np.full(len(signatures), band + 1, np.uint64)
        for column in range(band * params.rows, (band + 1) * params.rows):
            key = _mixed(key * np.uint64(0x9E3779B97F4A7C15) + signatures[:, column])
        keys[:, band] = key
    return keys.view(np.int64)


def _embedded(params: BandedSearch):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, sizes, rows = [], [], []
            for data in batch.column("data"):
                shingles = shingle_set(data.as_py(), params.words)
                keys.append(xxhash.xxh3_128_digest(shingles.tobytes()))
                sizes.append(len(shingles))
                rows.append(signature(shingles, params.hashes))
            signatures = np.array(rows, np.uint32).reshape(-1, params.hashes)
            bands = pa.FixedSizeListArray.from_arrays(band_keys(signatures, params).ravel(), params.bands)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("text_hash"),
                    pa.array(keys, pa.binary()),
                    pa.array(sizes, pa.int64()),
                    # Two bytes of each hash are enough for the looks.
                    pa.array([s.astype(np.uint16).tobytes() for s in signatures], pa.binary()),
                    bands.cast(pa.list_(pa.int64())),
                ],
                names=["doc_id", "text_hash", "key", "size", "signature", "bands"],
            )

    return run


def _texts(docs: DataFrame) -> DataFrame:
    data = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    return docs.select("doc_id", data.alias("data")).withColumn("text_hash", F.xxhash64("data"))


def _read_signatures(column: pa.ChunkedArray | pa.Array, params: BandedSearch) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, params.hashes)


def _fits(a: np.ndarray, b: np.ndarray, params: BandedSearch) -> np.ndarray:
    """Whether sets of these sizes can reach the threshold at all."""
    return 100 * np.minimum(a, b) >= params.percent * np.maximum(a, b)


def _survives(left: np.ndarray, right: np.ndarray, params: BandedSearch, looks: Sequence[int] | None = None, equal: np.ndarray | None = None) -> np.ndarray:
    """Rows of two signature matrices that no look drops; the first looks may be done already."""
    alive = np.arange(len(left))
    equal = np.zeros(len(left), np.int64) if equal is None else equal
    for look in range(len(params.least_equal)) if looks is None else looks:
        part = slice(look * params.batch, (look + 1) * params.batch)
        equal[alive] += (left[alive, part] == right[alive, part]).sum(axis=1)
        alive = alive[equal[alive] >= params.least_equal[look]]
    return alive


def _pruned(params: BandedSearch):
    """Pairs (a, b) with both signatures, to those that survive."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            fits = _fits(batch.column("a_size").to_numpy(), batch.column("b_size").to_numpy(), params)
            rows = batch.take(pa.array(np.flatnonzero(fits)))
            left, right = (_read_signatures(rows.column(c), params) for c in ("a_signature", "b_signature"))
            alive = pa.array(_survives(left, right, params))
            yield rows.select(["a", "b"]).take(alive)

    return run


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: Sequence[str]) -> Iterator[pa.Table]:
    """The rows of each key as one table; rows come sorted by key and may span batches."""
    held: list[pa.RecordBatch] = []
    last: tuple | None = None
    for batch in batches:
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(max(batch.num_rows - 1, 0), bool)
        for c in columns:
            change |= c[1:] != c[:-1]
        cuts = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
        for start, end in zip(cuts, cuts[1:], strict=False):
            if start == end:
                continue
            key = tuple(c[start] for c in columns)
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(start, end - start))
            last = key
    if held:
        yield pa.Table.from_batches(held)


def _surviving_pairs(table: pa.Table, params: BandedSearch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of surviving pairs of a block (side 0) or between two blocks (sides 1 and 2), of sets
    that are in different components, a few rows of the block at a time."""
    sid, size, component, side = (table.column(c).to_numpy() for c in ("sid", "size", "component", "side"))
    signatures = _read_signatures(table.column("signature").combine_chunks(), params)
    columns = np.ascontiguousarray(signatures[:, : params.batch].T)
    one = np.flatnonzero(side != 2)
    two = np.flatnonzero(side != 1)
    for at in range(0, len(one), 64):
        rows = one[at : at + 64]
        meet = _fits(size[rows, None], size[None, two], params) & (component[rows, None] != component[None, two])
        meet &= (sid[rows, None] < sid[None, two]) | (side[rows, None] == 1)
        if not meet.any():
            continue
        equal = np.zeros(meet.shape, np.uint8)
        for c in columns:
            equal += c[rows, None] == c[None, two]
        r, t = np.nonzero(meet & (equal >= params.least_equal[0]))
        left, right = rows[r], two[t]
        alive = _survives(
            signatures[left], signatures[right], params, range(1, len(params.least_equal)), equal[r, t].astype(np.int64)
        )
        if len(alive):
            yield left[alive], right[alive]


def _joined_labels(labels: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Labels after the rows of each pair got the lesser label of both, and all that shared it."""
    while True:
        a, b = labels[left], labels[right]
        if (a == b).all():
            return labels
        low = np.arange(len(labels))
        np.minimum.at(low, np.maximum(a, b), np.minimum(a, b))
        while (low != low[low]).any():
            low = low[low]
        labels = low[labels]


def _crossing(params: BandedSearch):
    """Edges of trees that tie together the sets of surviving pairs of a block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in sorted_groups(batches, ["band", "i", "j"]):
            labels = np.arange(len(table))
            for left, right in _surviving_pairs(table, params):
                labels = _joined_labels(labels, left, right)
            tied = np.flatnonzero(labels != np.arange(len(table)))
            if len(tied):
                sid = table.column("sid").to_numpy()
                yield pa.RecordBatch.from_arrays([pa.array(sid[tied]), pa.array(sid[labels[tied]])], names=["a", "b"])

    return run


def _alike(a: np.ndarray, b: np.ndarray, params: BandedSearch) -> bool:
    """Whether two full sets are a link."""
    small, large = sorted((a, b), key=len)
    at = np.minimum(np.searchsorted(large, small), len(large) - 1)
    common = int((large[at] == small).sum())
    return 100 * common >= params.percent * (len(a) + len(b) - common)


def _in_clusters(params: BandedSearch):
    """Links that join components of a block of a cluster; pairs inside one are skipped."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in sorted_groups(batches, ["cluster", "i", "j"]):
            sid = table.column("sid").to_numpy()
            sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in table.column("shingles").combine_chunks()]
            _, labels = np.unique(table.column("component").to_numpy(), return_inverse=True)
            found: list[tuple[int, int]] = []
            for left, right in _surviving_pairs(table, params):
                for x, y in zip(left.tolist(), right.tolist(), strict=True):
                    if labels[x] != labels[y] and _alike(sets[x], sets[y], params):
                        labels[labels == max(labels[x], labels[y])] = min(labels[x], labels[y])
                        found.append((sid[x], sid[y]))
            if found:
                a, b = (np.array(x, np.int64) for x in zip(*found, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return run


def _linked(params: BandedSearch):
    """Links between a hub (role 0) and its partners, on their full sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, hub_id, hub = [], None, np.zeros(0, np.uint64)
        b: list[int] = []
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("hub", "role", "sid"))
            for of, role, sid, raw in zip(*columns, batch.column("shingles"), strict=True):
                shingles = np.frombuffer(raw.as_buffer(), np.uint64)
                if role == 0:
                    hub_id, hub = of, shingles.copy()
                    continue
                if hub_id != of:
                    raise ValueError("a hub must stand before its partners")
                if _alike(hub, shingles, params):
                    a.append(of)
                    b.append(sid)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
            a, b = [], []

    return run


def embed(docs: DataFrame, params: BandedSearch) -> DataFrame:
    """Key of the shingle set, its size, signature and band keys, per row; a stored table."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, text_hash bigint, key binary, size bigint, signature binary, bands array<bigint>"
    rows = _texts(docs).select("doc_id", "text_hash", "data").mapInArrow(_embedded(params), schema)
    return settled(rows, "banded-rows")


def distinct_sets(embedded: DataFrame) -> DataFrame:
    """One row per distinct set that is not empty: sid, a row whose text stands for it, its least id."""
    sets = embedded.where("size > 0").groupBy("key").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("row"),
        F.min("doc_id").alias("least_id"),
        F.first("size").alias("size"),
        F.first("signature").alias("signature"),
        F.first("bands").alias("bands"),
    )
    return settled(sets.withColumn("sid", F.monotonically_increasing_id()), "banded-sets")


def bucket_members(sets: DataFrame) -> DataFrame:
    """Members of buckets of two sets or more, with the hub of the bucket: band, sid, hub.

    The hub is the member of least hash, so buckets with much the same members share their hub.
    """
    rows = sets.select("sid", F.explode("bands").alias("band"))
    hubs = rows.groupBy("band").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(F.xxhash64("sid").alias("h"), "sid")).alias("least"))
    hubs = hubs.where("n > 1").select("band", F.col("least.sid").alias("hub"))
    return settled(rows.join(hubs.hint("merge"), "band"), "banded-members")


def surviving(pairs: DataFrame, sets: DataFrame, params: BandedSearch) -> DataFrame:
    """Pairs (a, b) of distinct sets that no look drops."""
    of = lambda name: sets.select(
        F.col("sid").alias(name), F.col("size").alias(f"{name}_size"), F.col("signature").alias(f"{name}_signature")
    )
    both = pairs.join(of("b").hint("merge"), "b").join(of("a").hint("merge"), "a")
    return both.select("a", "b", "a_size", "b_size", "a_signature", "b_signature").mapInArrow(_pruned(params), "a bigint, b bigint")


def _in_blocks(df: DataFrame, blocks: str) -> DataFrame:
    """Each row once per pair of blocks that its own block belongs to: columns i <= j and side."""
    own = F.pmod(F.xxhash64("sid"), F.col(blocks)).cast("int")
    meets = F.transform(
        F.sequence(F.lit(0), F.col(blocks) - 1),
        lambda other: F.struct(
            F.least(own, other).alias("i"),
            F.greatest(own, other).alias("j"),
            F.when(other == own, 0).when(own < other, 1).otherwise(2).alias("side"),
        ),
    )
    return df.withColumn("meets", F.explode(meets)).select("*", "meets.i", "meets.j", "meets.side").drop("meets", blocks)


def _by_blocks(df: DataFrame, *key: str) -> DataFrame:
    return df.repartition(parallel(df), *key).sortWithinPartitions(*key)


def crossing_trees(members: DataFrame, components: DataFrame, sets: DataFrame, params: BandedSearch) -> DataFrame:
    """Trees (a, b) over the sets of surviving pairs in one bucket but different components; hubs
    met all others before."""
    rest = members.where("sid != hub").select("band", "sid")
    placed = rest.join(components.hint("merge"), F.col("sid") == F.col("node"), "left").select(
        "band", "sid", F.coalesce("root", "sid").alias("component")
    )
    placed = settled(placed, "banded-placed")
    buckets = placed.groupBy("band").agg(
        F.count(F.lit(1)).alias("n"), F.min("component").alias("low"), F.max("component").alias("high")
    )
    open_ = buckets.where("low < high").select("band", F.ceil(F.col("n") / params.block).cast("int").alias("blocks"))
    rows = settled(placed.join(open_.hint("merge"), "band"), "banded-open").join(
        sets.select("sid", "size", "signature").hint("merge"), "sid"
    )
    spread = _in_blocks(rows.select("band", "sid", "component", "size", "signature", "blocks"), "blocks")
    return _by_blocks(spread, "band", "i", "j").mapInArrow(_crossing(params), "a bigint, b bigint").distinct()


def full_sets(docs: DataFrame, sets: DataFrame, wanted: DataFrame, params: BandedSearch) -> DataFrame:
    """``sid`` and ``shingles`` of the wanted sets, made from their texts; a stored table."""
    found = wanted.join(sets.select("sid", "row"), "sid")
    found = settled(found.select("sid", F.col("row.doc_id").alias("row_id"), F.col("row.text_hash").alias("row_hash")), "banded-wanted")
    # What is wanted grows with the documents: a merge join at every size.
    same = F.col("doc_id").eqNullSafe(F.col("row_id")) & (F.col("text_hash") == F.col("row_hash"))
    texts = _texts(docs).join(found.hint("merge"), same).select("sid", "data")

    def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [shingle_set(d.as_py(), params.words).tobytes() for d in batch.column("data")]
            yield batch.set_column(1, "shingles", pa.array(made, pa.binary()))

    # A row that is repeated brings its text more than once.
    return settled(texts.mapInArrow(shingled, "sid bigint, shingles binary").dropDuplicates(["sid"]), "banded-shingles")


def verified(pairs: DataFrame, docs: DataFrame, sets: DataFrame, params: BandedSearch) -> DataFrame:
    """The pairs whose full sets are alike enough; a stored table (a, b).

    A set with many partners is copied to groups of about ``partners`` of them.
    """
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("sid")).distinct()
    full = full_sets(docs, sets, wanted, params)
    groups = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / params.partners).cast("int").alias("groups"))
    hubs = groups.select(F.col("a").alias("hub"), F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("part"))
    hubs = hubs.join(full.hint("merge"), F.col("hub") == F.col("sid")).select("hub", "part", F.lit(0).alias("role"), "sid", "shingles")
    partners = pairs.join(groups.hint("merge"), "a").select(
        F.col("a").alias("hub"), F.pmod(F.xxhash64("b"), F.col("groups")).cast("int").alias("part"), F.lit(1).alias("role"), F.col("b").alias("sid")
    )
    partners = partners.join(full.hint("merge"), "sid").select("hub", "part", "role", "sid", "shingles")
    rows = hubs.unionByName(partners)
    placed = rows.repartition(parallel(rows), "hub", "part").sortWithinPartitions("hub", "part", "role")
    return settled(placed.mapInArrow(_linked(params), "a bigint, b bigint"), "banded-links")


def verified_in_clusters(
    clusters: DataFrame, components: DataFrame, docs: DataFrame, sets: DataFrame, params: BandedSearch
) -> DataFrame:
    """Links (a, b) between different components of a cluster, enough to join all that are linked."""
    placed = clusters.unionByName(clusters.select(F.col("root").alias("node"), "root").distinct()).select(
        F.col("node").alias("sid"), F.col("root").alias("cluster")
    )
    full = full_sets(docs, sets, placed.select("sid"), params)
    sized = placed.join(sets.select("sid", "size", "signature").hint("merge"), "sid")
    weight = sized.groupBy("cluster").agg(F.sum("size").alias("shingles"), F.count(F.lit(1)).alias("n"))
    blocks = F.greatest(F.col("n") / params.cluster_sets, F.col("shingles") / params.cluster_shingles)
    weight = weight.select("cluster", F.ceil(blocks).cast("int").alias("blocks"))
    labelled = sized.join(components.hint("merge"), F.col("sid") == F.col("node"), "left").withColumn("component", F.coalesce("root", "sid"))
    rows = labelled.join(weight.hint("merge"), "cluster").join(full.hint("merge"), "sid")
    spread = _in_blocks(rows.select("cluster", "sid", "component", "size", "signature", "shingles", "blocks"), "blocks")
    return _by_blocks(spread, "cluster", "i", "j").mapInArrow(_in_clusters(params), "a bigint, b bigint")


def similar_sets(docs: DataFrame, sets: DataFrame, params: BandedSearch) -> DataFrame:
    """``node`` and ``root`` of every set that is linked to others and is not the least of them."""
    members = bucket_members(sets)
    met = members.where("sid != hub").select(F.col("hub").alias("a"), F.col("sid").alias("b")).distinct()
    links = verified(settled(surviving(met, sets, params), "banded-likely"), docs, sets, params)
    components = settled(connected_components(links), "banded-components")
    trees = settled(crossing_trees(members, components, sets, params), "banded-trees")
    if trees.isEmpty():
        return components
    clusters = settled(connected_components(trees), "banded-clusters")
    return connected_components(links.unionByName(verified_in_clusters(clusters, components, docs, sets, params)))


def near_copies(docs: DataFrame, params: BandedSearch = BandedSearch()) -> DataFrame:
    """doc_id, n_shingles, component_id and kept, one row per input row.

    Linked documents and what they are linked to are a component, named by its least doc_id,
    nulls aside; kept is true where that is the row's own. Equal sets are linked. A null or empty
    text, or one of white space, has no shingle and is linked with nothing; fewer words than a
    shingle are one. Repeated rows count as documents with equal sets, so all rows of the least
    doc_id are kept. A row without doc_id is kept only where its whole component has none. An
    empty table gives no rows; texts are read whole; columns besides doc_id and text are not read.
    """
    embedded = embed(docs, params)
    sets = distinct_sets(embedded)
    tied = similar_sets(docs, sets, params)
    placed = sets.select("sid", "key", "least_id").join(tied.hint("merge"), F.col("sid") == F.col("node"), "left")
    placed = placed.withColumn("component", F.coalesce("root", "sid"))
    names = placed.groupBy("component").agg(F.min("least_id").alias("component_id"))
    named = settled(placed.join(names.hint("merge"), "component").select("key", "component_id"), "banded-names")
    rows = embedded.select("doc_id", "key", F.col("size").alias("n_shingles"))
    full = rows.where("n_shingles > 0").join(named.hint("merge"), "key").drop("key")
    empty = rows.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return full.unionByName(empty).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
