"""N-gram Jaccard join by chosen paths.

Sets of word shingles are embedded as ``coordinates`` minimum hashes, their tokens. A node of the
recursion is a path of tokens; a set follows a token when a hash of (path, token) falls under
1 / (similarity x coordinates), so sets that share tokens share paths. Small nodes are compared
by brute force, large ones are split further, and everything is repeated ``runs`` times with
other hashes. What brute force finds likely is verified on the full shingle sets.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomcast.llm.common import in_parts, packed, parallel, whole
from loomcast.llm.components import connected_components
from loomcast.llm.sketch import shingle_hashes, word_hashes
from loomcast.session import settled


@dataclass(frozen=True)
class PathJoin:
    """Parameters.

    A node is split while it has more than ``bucket`` sets and is less than ``depth`` tokens
    deep; a node that is still larger then (copies that share nearly all tokens) is compared in
    blocks of ``block`` sets. A component is verified in blocks of about ``block_sets`` sets and
    ``block_shingles`` shingles at most. All runs share the minimum hashes of a pair, so its number
    of equal ones is drawn once: ``runs`` repeats lift the recall of a pair at the threshold,
    averaged over that number, to ``recall`` at the greatest depth and so at every other.
    """

    words: int = 5
    similarity: float = 0.8
    coordinates: int = 64
    bucket: int = 256
    depth: int = 3
    recall: float = 0.999
    block: int = 4096
    block_shingles: int = 1_000_000
    block_sets: int = 1000

    def expected_recall(self, runs: int, depth: int) -> float:
        """Chance that a pair at the threshold shares a path of ``depth`` tokens in some of ``runs``."""
        n, p, total = self.coordinates, self.similarity, 0.0
        for equal in range(n + 1):
            alive = 1.0
            for _ in range(depth):
                alive = 1.0 - (1.0 - alive / (n * p)) ** equal
            total += math.comb(n, equal) * p**equal * (1 - p) ** (n - equal) * (1.0 - (1.0 - alive) ** runs)
        return total

    def runs(self) -> int:
        runs = 1
        while self.expected_recall(runs, self.depth) < self.recall:
            runs += 1
        return runs

    def least_equal(self) -> int:
        """Equal coordinates that a pair at the threshold misses once in 30,000 times at most."""
        n, p = self.coordinates, self.similarity
        return math.floor(n * p - 4.0 * math.sqrt(n * p * (1 - p)))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _constants(n: int) -> tuple[np.ndarray, np.ndarray]:
    seeds = _mix(np.arange(1, 2 * n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).astype(np.uint32)
    return seeds[:n] | np.uint32(1), seeds[n:]


def minimum_hashes(shingles: np.ndarray, n: int) -> np.ndarray:
    """The embedding of a set: ``n`` minimum hashes of 32 bits."""
    factor, shift = _constants(n)
    out = np.full(n, 0xFFFFFFFF, np.uint32)
    low = (shingles >> np.uint64(16)).astype(np.uint32)
    for at in range(0, len(low), 4096):
        part = low[at : at + 4096, None]
        out = np.minimum(out, ((part ^ shift) * factor).min(axis=0))
    return out


def _children(paths: np.ndarray, tokens: np.ndarray, params: PathJoin) -> tuple[np.ndarray, np.ndarray]:
    """Paths one token longer: row number and path, for every followed token of every row."""
    place = np.arange(params.coordinates, dtype=np.uint64) << np.uint64(32)
    followed = _mix(paths[:, None] ^ _mix(place[None, :] | tokens.astype(np.uint64)))
    rate = np.uint64(2**64 / (params.similarity * params.coordinates))
    rows, columns = np.nonzero(followed < rate)
    return rows, _mix(followed[rows, columns] ^ paths[rows])


def shingle_set(text: str, width: int) -> np.ndarray:
    """Sorted distinct shingle hashes of a whole text."""
    return np.unique(shingle_hashes(word_hashes(text), width))


def _embedded(params: PathJoin):
    roots = _mix(np.arange(1, params.runs() + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_parts(batches):
            keys, sizes, tokens = [], [], []
            for text in batch.column("text"):
                shingles = shingle_set(text.as_py(), params.words)
                keys.append(xxhash.xxh3_128_digest(shingles.tobytes()))
                sizes.append(len(shingles))
                tokens.append(minimum_hashes(shingles, params.coordinates))
            matrix = np.array(tokens, np.uint32).reshape(-1, params.coordinates)
            paths: list[list[np.ndarray]] = [[] for _ in sizes]
            full = np.flatnonzero(np.array(sizes) > 0)  # an empty set has no token
            for root in roots:
                rows, found = _children(np.full(len(full), root), matrix[full], params)
                cuts = np.searchsorted(rows, np.arange(1, len(full)))
                for k, part in zip(full, np.split(found, cuts) if len(full) else [], strict=True):
                    paths[k].append(part)
            joined = [np.concatenate(p).view(np.int64) if p else np.zeros(0, np.int64) for p in paths]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("text_hash"),
                    pa.array(keys, pa.binary()),
                    pa.array(sizes, pa.int64()),
                    pa.array([m.tobytes() for m in matrix], pa.binary()),
                    pa.array(joined, pa.list_(pa.int64())),
                ],
                names=["doc_id", "text_hash", "key", "size", "tokens", "paths"],
            )

    return run


def _descended(params: PathJoin):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_parts(batches):
            tokens = np.frombuffer(b"".join(batch.column("tokens").to_pylist()), np.uint32)
            paths = batch.column("path").to_numpy().view(np.uint64)
            rows, found = _children(paths, tokens.reshape(-1, params.coordinates), params)
            yield pa.RecordBatch.from_arrays(
                [batch.column("sid").take(pa.array(rows)), pa.array(found.view(np.int64))], names=["sid", "path"]
            )

    return run


def _by_group(
    key: list[str], names: list[str], use: Callable[[pa.Table], list[np.ndarray]]
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Run ``use`` on the rows of each key; rows come sorted by key and may span batches."""

    def flushed(held: list[pa.Table]) -> Iterator[pa.RecordBatch]:
        table = pa.concat_tables(held).combine_chunks()
        columns = [table.column(k).to_numpy() for k in key]
        change = np.zeros(max(0, len(table) - 1), bool)
        for c in columns:
            change |= c[1:] != c[:-1]
        cuts = [0, *(np.flatnonzero(change) + 1).tolist(), len(table)]
        parts: list[list[np.ndarray]] = []
        for a, b in zip(cuts, cuts[1:], strict=False):
            if b > a:
                got = use(table.slice(a, b - a))
                if len(got[0]):
                    parts.append(got)
        if parts:
            arrays = [pa.array(np.concatenate(x)) for x in zip(*parts, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            ends = [batch.column(k)[batch.num_rows - 1].as_py() for k in key]
            if held and ends != last:
                # the group that this batch ends with stays back
                same = np.ones(batch.num_rows, bool)
                for k, v in zip(key, ends, strict=True):
                    same &= batch.column(k).to_numpy(zero_copy_only=False) == v
                at = batch.num_rows - int(same.sum())
                if at:
                    held.append(table.slice(0, at))
                yield from flushed(held)
                held = [table.slice(at)]
            else:
                held.append(table)
            last = ends
        if held:
            yield from flushed(held)

    return run


def _roots(n: int, matches: Iterator[tuple[int, np.ndarray]]) -> np.ndarray:
    """Least member of each member's component; ``matches`` gives a row and its matching columns."""
    label = np.arange(n)
    for row, columns in matches:
        joined = np.unique(np.append(label[columns], label[row]))
        if len(joined) > 1:
            label[np.isin(label, joined[1:])] = joined[0]
    return label


def _likely(params: PathJoin):
    """Stars of the sets of a node that agree in enough coordinates and fit in size."""
    least = params.least_equal()

    def use(table: pa.Table) -> list[np.ndarray]:
        sid = table.column("sid").to_numpy()
        size = table.column("size").to_numpy()
        raw = np.frombuffer(b"".join(table.column("bytes").to_pylist()), np.uint8).reshape(len(sid), -1)
        side = table.column("side").to_numpy()  # 0 in a node's diagonal block, else which block
        n = len(sid)

        def matches() -> Iterator[tuple[int, np.ndarray]]:
            columns = np.ascontiguousarray(raw.T)
            for at in range(0, n, 64):
                equal = np.zeros((min(64, n - at), n), np.uint8)
                for c in columns:
                    equal += c[at : at + 64, None] == c[None, :]
                fits = np.minimum(size[at : at + 64, None], size[None, :]) >= params.similarity * np.maximum(size[at : at + 64, None], size[None, :])
                good = (equal >= least) & fits
                for k in range(len(good)):
                    after = np.flatnonzero(good[k, at + k + 1 :]) + at + k + 1
                    after = after[(side[after] != side[at + k]) | (side[at + k] == 0)]
                    if len(after):
                        yield at + k, after

        label = _roots(n, matches())
        hung = label != np.arange(n)
        return [sid[hung], sid[label[hung]]]

    return _by_group(["path", "i", "j"], ["a", "b"], use)


def _verified(params: PathJoin):
    """Exact similarities of the sets of a component (or of two of its blocks).

    Shared shingles are counted by products of membership matrices, a bounded number of columns
    at a time. Returns per set its links, weighted by copies, and the least set it is tied to.
    """

    def use(table: pa.Table) -> list[np.ndarray]:
        sid = table.column("sid").to_numpy()
        copies = table.column("copies").to_numpy()
        side = table.column("side").to_numpy()
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in table.column("shingles").combine_chunks()]
        n = len(sid)
        size = np.array([len(s) for s in sets], np.int64)
        owner = np.repeat(np.arange(n), size)
        _, number, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        shared = count > 1
        renumber = np.cumsum(shared) - 1
        kept = shared[number]
        owner, number = owner[kept], renumber[number[kept]]
        order = np.argsort(number, kind="stable")
        owner, number = owner[order], number[order]
        total = int(shared.sum())
        width = max(64, min(4096, 8_000_000 // max(1, n)))
        common = np.zeros((n, n), np.float32)
        for at in range(0, total, width):
            a, b = np.searchsorted(number, [at, at + width])
            member = np.zeros((n, min(width, total - at)), np.float32)
            member[owner[a:b], number[a:b] - at] = 1.0
            common += member @ member.T
        either = size[:, None] + size[None, :] - common
        linked = common >= params.similarity * either - 1e-6
        np.fill_diagonal(linked, False)
        linked &= (side[:, None] != side[None, :]) | (side[:, None] == 0)
        links = linked.astype(np.float64) @ copies.astype(np.float64)
        label = _roots(n, ((k, np.flatnonzero(linked[k])) for k in range(n) if linked[k].any()))
        return [sid, sid[label], links.astype(np.int64)]

    return _by_group(["component", "i", "j"], ["sid", "root", "links"], use)


def _in_blocks(df: DataFrame, blocks: str) -> DataFrame:
    """Each row once per pair of blocks that its own block belongs to: columns i <= j and side."""
    own = F.pmod(F.xxhash64("sid"), F.col(blocks)).cast("int")
    pairs = F.transform(
        F.sequence(F.lit(0), F.col(blocks).cast("int") - 1),
        lambda other: F.struct(
            F.least(own, other).alias("i"),
            F.greatest(own, other).alias("j"),
            F.when(other == own, 0).when(own < other, 1).otherwise(2).alias("side"),
        ),
    )
    return df.select("*", F.explode(pairs).alias("x")).select("*", "x.i", "x.j", "x.side").drop("x", blocks)


def _gathered(df: DataFrame, *key: str) -> DataFrame:
    return df.repartition(parallel(df), *key).sortWithinPartitions(*key, "sid")


def embed(docs: DataFrame, params: PathJoin) -> DataFrame:
    """Key of the shingle set, its size, tokens and first paths, per document; a stored table."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return settled(
        docs.select("doc_id", whole().alias("text"))
        .withColumn("text_hash", F.xxhash64("text"))
        .mapInArrow(
            _embedded(params),
            f"doc_id {kind}, text_hash bigint, key binary, size bigint, tokens binary, paths array<bigint>",
        ),
        "path-sets",
    )


def distinct_sets(embedded: DataFrame) -> DataFrame:
    """One row per distinct set: sid, the row whose text stands for it, its least id and its copies.

    The row may have no id although others of its set have one, so ``least_id`` is kept beside it.
    """
    grouped = embedded.groupBy("key").agg(
        F.count(F.lit(1)).alias("copies"),
        F.min(F.struct("doc_id", "text_hash")).alias("rep"),
        F.min("doc_id").alias("least_id"),
        F.first("size").alias("size"),
        F.first("tokens").alias("tokens"),
        F.first("paths").alias("paths"),
    )
    return settled(grouped.withColumn("sid", F.monotonically_increasing_id()), "path-distinct")


def nodes_of(sets: DataFrame, params: PathJoin) -> DataFrame:
    """Members of all nodes that are compared: path, sid and the number of sets of the node."""
    level = sets.select("sid", F.explode("paths").alias("path"))
    done = []
    for depth in range(1, params.depth + 1):
        level = settled(level, "path-level")
        counts = level.groupBy("path").agg(F.count(F.lit(1)).alias("sets")).where("sets > 1")
        members = settled(level.join(counts, "path"), "path-members")
        if depth == params.depth:
            done.append(members)
            break
        done.append(members.where(F.col("sets") <= params.bucket))
        large = members.where(F.col("sets") > params.bucket)
        if large.isEmpty():
            break
        level = large.join(sets.select("sid", "tokens"), "sid").mapInArrow(_descended(params), "sid bigint, path bigint")
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def likely_pairs(sets: DataFrame, params: PathJoin) -> DataFrame:
    """Edges (a, b) that tie together the sets which brute force in some node finds alike."""
    low_bytes = F.expr("unhex(regexp_replace(hex(tokens), '(..)......', '$1'))")
    nodes = nodes_of(sets, params).withColumn("blocks", F.ceil(F.col("sets") / params.block).cast("int"))
    rows = nodes.join(sets.select("sid", "size", low_bytes.alias("bytes")), "sid")
    spread = _in_blocks(rows.select("path", "sid", "size", "bytes", "blocks"), "blocks")
    return _gathered(spread, "path", "i", "j").mapInArrow(_likely(params), "a bigint, b bigint")


def verified_links(docs: DataFrame, sets: DataFrame, components: DataFrame, params: PathJoin) -> DataFrame:
    """Per set of a component: sid, root it is tied to and links found, by exact comparison."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    ties = components.unionByName(components.select(F.col("root").alias("node"), "root").distinct())
    placed = ties.join(sets.select("sid", "size", "copies", "rep"), ties.node == sets.sid)
    weight = placed.groupBy("root").agg(F.sum("size").alias("shingles"), F.count(F.lit(1)).alias("members"))
    blocks = F.greatest(F.col("shingles") / params.block_shingles, F.col("members") / params.block_sets)
    sized = placed.join(weight, "root").select(
        F.col("root").alias("component"),
        "sid",
        "copies",
        F.ceil(blocks).cast("int").alias("blocks"),
        F.col("rep.doc_id").alias("rep_id"),
        F.col("rep.text_hash").alias("rep_hash"),
    )
    texts = docs.select("doc_id", whole().alias("text")).withColumn("text_hash", F.xxhash64("text"))
    # Candidates grow with the documents, so they are never broadcast: a merge join at every size.
    found = texts.join(
        settled(sized, "path-candidates").hint("merge"), F.col("doc_id").eqNullSafe(F.col("rep_id")) & (F.col("text_hash") == F.col("rep_hash"))
    ).select("component", "sid", "copies", "blocks", "text")

    def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_parts(batches):
            sets_ = [shingle_set(t.as_py(), params.words).tobytes() for t in batch.column("text")]
            yield batch.set_column(4, "shingles", pa.array(sets_, pa.binary()))

    names = "component bigint, sid bigint, copies bigint, blocks int"
    shingles = found.mapInArrow(shingled, f"{names}, shingles binary")
    # Repeated rows of a document that stands for a set bring its text more than once.
    once = shingles if kind == "null" else shingles.dropDuplicates(["sid"])
    return _gathered(_in_blocks(once, "blocks"), "component", "i", "j").mapInArrow(
        _verified(params), "sid bigint, root bigint, links bigint"
    )


def _members(docs: DataFrame, params: PathJoin) -> DataFrame:
    """Per input row: doc_id, text_hash, class (a number), class_id and n_links."""
    embedded = embed(docs, params)
    sets = distinct_sets(embedded)
    components = connected_components(likely_pairs(sets, params))  # a stored table already
    links = settled(verified_links(docs, sets, components, params), "path-links")
    counted = links.groupBy("sid").agg(F.sum("links").alias("links"))
    tied = connected_components(links.select(F.col("sid").alias("a"), F.col("root").alias("b")))
    classes = (
        sets.select("sid", "key", "copies", "least_id")
        .join(tied, F.col("sid") == F.col("node"), "left")
        .withColumn("class", F.coalesce("root", "sid"))
        .join(counted, "sid", "left")
    )
    names = classes.groupBy("class").agg(F.min("least_id").alias("class_id"))
    named = classes.join(names, "class").select(
        "key", "class", "class_id", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")
    )
    rows = embedded.select("doc_id", "text_hash", "key").join(settled(named, "path-classes"), "key")
    return rows.select("doc_id", "text_hash", "class", "class_id", "n_links")


def near_duplicates(docs: DataFrame, params: PathJoin = PathJoin()) -> DataFrame:
    """Class and links of every document: doc_id, class_id, n_links; one row per input row.

    Documents whose sets of ``words``-word shingles have a Jaccard similarity of ``similarity``
    or more are linked; a class is what links tie together, named by its smallest doc_id.
    ``n_links`` counts the other documents linked to this one; copies (equal sets, equal texts
    among them) are linked to each other. A text of fewer words than a shingle is one shingle; empty and
    null texts are copies of each other and like nothing else. Repeated rows count as documents;
    null ids have a class, which null names only if it has no other id; an empty table gives no
    rows. Columns besides doc_id and text are not read.
    """
    return _members(docs, params).select("doc_id", "class_id", "n_links")


def keep_one_of_each(docs: DataFrame, params: PathJoin = PathJoin()) -> DataFrame:
    """One document of each class, with all its columns: the one whose doc_id names the class.

    Rows are judged one by one, by doc_id and text, so a null or repeated doc_id does not tie its
    rows together. Of rows of a class that share the doc_id that names it one stays, the first by
    its columns written as text; of documents without an id, all of whose class lack one, all
    stay. Empty and null texts are one class. An empty table stays empty; columns may have any
    name and type.
    """
    names = F.col("doc_id") == F.col("class_id")
    whole_rows = packed(docs)
    rows = _members(whole_rows.select("row.doc_id", "row.text"), params).where(F.col("class_id").isNotNull())
    of_row = [F.col("doc_id").alias("id"), F.col("text_hash").alias("hash")]
    leave = rows.where(~F.coalesce(names, F.lit(False))).select(*of_row).distinct()
    naming = rows.where(names)
    repeated = naming.groupBy("class").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("class")
    several_rows = settled(naming.join(repeated, "class").select(*of_row, "class").distinct(), "path-repeated")
    hashed = whole_rows.withColumn("text_hash", F.xxhash64(whole("row.text")))
    same = F.col("row.doc_id").eqNullSafe(F.col("id")) & (F.col("text_hash") == F.col("hash"))
    # Rows that leave grow with the documents: a merge join at every size.
    stay = hashed.join(several_rows, same, "left_anti").join(leave.hint("merge"), same, "left_anti").select("row")
    several = hashed.join(several_rows, same).groupBy("class")
    one = several.agg(F.min_by("row", F.to_json("row")).alias("row"))
    return stay.unionByName(one.select("row")).select("row.*")
