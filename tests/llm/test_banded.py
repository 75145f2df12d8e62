"""Near-duplicates by bands and sequential verification against brute force."""

from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from loomcast.llm import banded

DOCS = "doc_id bigint, text string, size string, key string, sid string, component string, m map<string,int>"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "s", "k", "x", "c", {"a": 1}) for i, t in rows], DOCS).repartition(4)


def shingles(text, width=4):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + width]) for i in range(max(len(words) - width + 1, 1))} if words else set()


def brute(rows, percent=80):
    """Components by comparing all pairs."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                root[find(i)] = find(j)
    least = defaultdict(list)
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)].append(doc)
    out = []
    for i, (doc, _) in enumerate(rows):
        name = min(least[find(i)], default=None) if sets[i] else doc
        out.append((doc, len(sets[i]), name, doc == name))
    return Counter(out)


def found(df, params=banded.BandedSearch()):
    return Counter(tuple(r) for r in banded.near_copies(df, params).collect())


def texts(rng, words, n):
    return [f"w{x}" for x in rng.integers(0, words, n)]


def test_components_match_brute_force(spark):
    """Chains of edits, copies, a passage that many share, pairs around the threshold."""
    rng = np.random.default_rng(2)
    rows, passage = [], texts(rng, 9999, 60)
    for _ in range(12):
        own = texts(rng, 9999, 120)
        for _ in range(8):  # each is an edit of the one before
            rows.append(" ".join(own))
            for at in rng.integers(0, len(own), 2):
                own = own[:at] + texts(rng, 9999, 1) + own[at + 1 :]
    rows += [" ".join(texts(rng, 9999, 40) + passage + texts(rng, 9999, int(k))) for k in rng.integers(1, 60, 60)]
    rows += [" ".join(passage + texts(rng, 9999, int(k))) for k in rng.integers(1, 16, 40)]
    rows += [rows[3].upper()] * 20
    given = [(i * 3 % 1000, t) for i, t in enumerate(rows)]
    assert len({i for i, _ in given}) == len(given)
    assert found(frame(spark, given)) == brute(given)


@pytest.mark.parametrize("change", [{"block": 7, "partners": 3, "cluster_sets": 9}, {"batch": 16}, {"bands": 32, "rows": 4}])
def test_blocks_and_looks_change_nothing(spark, change):
    """Buckets cut into many blocks, hubs into many groups."""
    rng = np.random.default_rng(3)
    base = texts(rng, 5000, 150)
    rows = []
    for i in range(80):
        own = list(base)
        for at in rng.integers(0, 150, int(rng.integers(0, 9))):
            own[at] = f"e{rng.integers(0, 10**6)}"
        rows.append((i, " ".join(own)))
    assert found(frame(spark, rows), banded.BandedSearch(**change)) == brute(rows)


def test_odd_rows(spark):
    rows = [
        (1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "ONE"), (6, "one two three"), (7, "a b c d"), (7, "a b c d"),
        (None, "a b c d"), (None, "alone and without an id"), (8, "État état x y"), (9, "état état x y"), (10, "a b c d a b c d"),
        (11, " ".join(f"x{i}" for i in range(40_000))), (12, " ".join(f"x{i}" for i in range(39_000))), (5, "a b c d"),
    ]
    df = frame(spark, rows)
    assert found(df) == Counter((a, b, c, d or (a is None and c is None)) for (a, b, c, d) in brute(rows).elements())
    assert banded.near_copies(df.where("false")).count() == 0
    assert banded.near_copies(df).columns == ["doc_id", "n_shingles", "component_id", "kept"]


def test_least_equal_is_the_posterior_bound():
    """Counted by integrating the posterior of an even prior."""
    params = banded.BandedSearch(miss=1e-4)
    x = (np.arange(200_000) + 0.5) / 200_000
    for look, need in enumerate(params.least_equal):
        n = (look + 1) * params.batch

        def above(m, n=n):
            log = m * np.log(x) + (n - m) * np.log1p(-x)
            density = np.exp(log - log.max())
            return density[x >= 0.8].sum() / density.sum()

        assert above(need) >= params.miss > above(need - 1)


def test_measured_recall_at_the_threshold():
    """Pairs just over the threshold: proposed by a band and kept by all looks."""
    params = banded.BandedSearch()
    assert params.expected_recall(0.8) > 0.9998
    rng = np.random.default_rng(4)
    kept = []
    for _ in range(1500):
        pool = rng.integers(0, 2**63, 200, dtype=np.uint64)
        common, own = pool[:160], pool[160:]
        left, right = (np.concatenate([common, part]) for part in (own[:20], own[20:]))
        s = np.array([banded.signature(x, params.hashes) for x in (left, right)])
        bands = banded.band_keys(s, params)
        a, b = (x[None].astype(np.uint16) for x in s)
        kept.append(bool((bands[0] == bands[1]).any()) and len(banded._survives(a, b, params)) == 1)
    assert np.mean(kept) >= 0.999


def test_looks_prune_unlike_pairs_early():
    params = banded.BandedSearch()
    rng = np.random.default_rng(6)
    a = rng.integers(0, 2**16, (4000, params.hashes)).astype(np.uint16)
    same = rng.random(a.shape) < 0.5
    b = np.where(same, a, rng.integers(0, 2**16, a.shape).astype(np.uint16))
    assert len(banded._survives(a, b, params, [0])) < 0.7 * len(a)
    assert len(banded._survives(a, b, params)) < 0.001 * len(a)


def test_groups_may_span_batches():
    keys = np.repeat(np.arange(50), np.arange(50) % 7 + 1)
    batches = pa.table({"k": keys, "v": np.arange(len(keys))}).to_batches(max_chunksize=5)
    groups = [t.column("k").to_pylist() for t in banded.sorted_groups(iter(batches), ["k"])]
    assert [len(g) for g in groups] == [k % 7 + 1 for k in range(50)] and all(len(set(g)) == 1 for g in groups)


def test_a_bucket_of_copies_costs_no_square(spark):
    """Members that are linked to their hub are not compared with each other again."""
    rng = np.random.default_rng(7)
    base = texts(rng, 5000, 200)
    rows = [(i, " ".join(base[:190] + [f"end{i}"] + base[190:])) for i in range(400)]
    params = banded.BandedSearch()
    df = frame(spark, rows)
    sets = banded.distinct_sets(banded.embed(df, params))
    members = banded.bucket_members(sets)
    assert sets.count() == 400 and members.groupBy("band").count().agg(F.max("count")).first()[0] > 100
    met = members.where("sid != hub").select("hub", "sid").distinct().count()
    assert met < 400 * params.bands
    one = sets.select(F.col("sid").alias("node"), F.lit(sets.agg(F.min("sid")).first()[0]).alias("root"))
    assert banded.crossing_trees(members, one, sets, params).count() == 0
    assert {r.component_id for r in banded.near_copies(df).collect()} == {0}


def test_rows_grow_with_the_sets_of_a_bucket(spark):
    """Sets at the threshold to each other: the second round returns trees, not pairs."""
    rng = np.random.default_rng(9)
    base = texts(rng, 5000, 300)
    rows = []
    for i in range(300):
        own = list(base)
        for at in rng.choice(300, 8, replace=False):
            own[at] = f"e{rng.integers(0, 10**6)}"
        rows.append((i, " ".join(own)))
    params = banded.BandedSearch()
    df = frame(spark, rows)
    sets = banded.distinct_sets(banded.embed(df, params))
    members = banded.bucket_members(sets)
    apart = spark.createDataFrame([], "node bigint, root bigint")
    trees = banded.crossing_trees(members, apart, sets, params)
    assert 0 < trees.count() < 300 * params.bands
    assert found(df) == brute(rows)


def test_labels_of_joined_pairs():
    rng = np.random.default_rng(10)
    for n in (1, 2, 30):
        for edges in (0, 1, 5, 40):
            left, right = rng.integers(0, n, edges), rng.integers(0, n, edges)
            labels = banded._joined_labels(np.arange(n), left, right)
            root = list(range(n))
            for a, b in zip(left, right, strict=True):
                x, y = root[a], root[b]
                root = [min(x, y) if r in (x, y) else r for r in root]
            assert labels.tolist() == root
