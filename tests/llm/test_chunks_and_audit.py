"""Fill-in-middle over memoised chunks and the source divergence audit against brute force."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomcast.llm import chunk_memo, term_audit

ODD = "doc_id bigint, text string, lang string, source string, n long, output string, term string, l long, m map<string,int>"
LONG = "".join(f"line {i} é\n" * (1 + i % 3) for i in range(60_000))
PLAIN = [
    (1, "one\ntwo\n\nthree", "en", "a"),
    (2, None, "en", None),
    (3, "", None, None),
    (4, "\n\n\n", "fr", "b"),
    (5, LONG, "en", "b"),
    (6, "has a <S> mark\nhere", "en", "a"),
    (7, "ends with <\nS> and <", "en", "a"),
    (7, "ends with <\nS> and <", "en", "a"),
    (None, "no id \U0001f600\r\nsecond\n", "fr", "c"),
]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, lang, s, 1, "o", "t", 2, {"k": 1}) for i, t, lang, s in PLAIN]
    return spark.createDataFrame(rows, ODD).repartition(3)


def brute_middle(doc_id, text):
    text = text or ""
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(lines)
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, _, h4 = (int(digest[k : k + 8], 16) for k in range(0, 32, 8))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")):
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(lines[:a]), "".join(lines[a:b]), "".join(lines[b:])
    if h4 % 100 < 50:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_middle_of_odd_rows(odd):
    found = chunk_memo.fill_in_middle(odd).withColumn("back", chunk_memo.restored()).collect()
    assert Counter(tuple(r)[:6] for r in found) == Counter((i, *brute_middle(i, t)) for i, t, *_ in PLAIN)
    assert Counter((r.doc_id, r.back) for r in found) == Counter((i, t or "") for i, t, *_ in PLAIN)
    assert chunk_memo.fill_in_middle(odd.where("false")).count() == 0


def test_chunks_follow_content_and_cover_the_text():
    params = chunk_memo.MiddleOut(least=32, mean_bits=6, most=500)
    rng = np.random.default_rng(1)
    body = rng.integers(32, 127, 30_000, dtype=np.uint8).tobytes()

    def cuts(data):
        ends = chunk_memo.chunk_ends(data, params)
        return [data[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]

    whole, moved = cuts(body), cuts(b"another beginning " * 9 + body)
    assert b"".join(whole) == body and max(map(len, whole)) <= 500
    assert all(len(c) >= 32 for c in whole[:-1])
    assert len(set(whole) & set(moved)) > 0.95 * len(whole)
    # Segments of a very long text do not show in its chunks.
    long = body * 80
    limit = np.uint32(32 - params.mean_bits)
    marked = set((np.flatnonzero(chunk_memo.rolling_hashes(long) >> limit == 0) + 1).tolist())
    ends = chunk_memo.chunk_ends(long, params)
    assert all(b in marked or b - a == 500 for a, b in zip([0, *ends], ends[:-1], strict=False))


@pytest.mark.parametrize("bits", [64, 3])
def test_cache_verifies_content(bits):
    """With digests of three bits nearly every look-up meets another chunk's digest."""
    params = chunk_memo.MiddleOut(least=16, mean_bits=4, most=64, digest_bits=bits, cached_bytes=5000)
    cache = chunk_memo.ChunkCache(params)
    shared = "a passage shared\nby all texts <\n" * 20
    for i in range(60):
        text = f"begin {i} <P\n" + shared + (f"<P>{i}" if i % 7 == 0 else f"é end {i}\n")
        n, form, p, m, out = chunk_memo.transformed(text.encode(), str(i), cache, params)
        assert (n, form, p, m, out.decode()) == brute_middle(i, text)
        assert cache.held <= 5000
    assert cache.hits > cache.misses


def test_marks_across_chunks():
    params = chunk_memo.MiddleOut(least=1, mean_bits=1, most=2)
    for text in ("<S>", "a<M>b", "xx<P>", "<<<P>>>", "<S >", "< P>", "P><", "<\n"):
        layout = chunk_memo.Layout(text.encode(), chunk_memo.ChunkCache(params), params)
        assert layout.marked == any(m in text for m in ("<P>", "<S>", "<M>")), text


def brute_audit(rows, least=10, top=10):
    docs = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")) for text, lang, source in rows]
    small = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    holders, cells, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, terms in docs:
        terms = [t.translate(small) for t in terms]
        groups[lang].add(source)
        holders[lang].update(set(terms))
        cells[lang, source].update(terms)
    out = []
    for lang, sources in groups.items():
        kept = [t for t, k in holders[lang].items() if k >= least]
        chance = lambda counts: {t: 1 + 10**9 * (counts[t] + 2) // (sum(counts[x] for x in kept) + 2 * len(kept)) for t in kept}
        own = {s: chance(cells[lang, s]) for s in sources}
        q = chance(sum((cells[lang, s] for s in sources), Counter()))
        f = lambda a, b: (a - b) * (a - b) // (a + b)
        for s in sources:
            pairs = [(o, sum(f(own[s][t], own[o][t]) for t in kept)) for o in sources if o != s]
            terms = [(t, f(own[s][t], q[t])) for t in kept if cells[lang, s][t] and own[s][t] > q[t]]
            for part, items, most in (("pair", pairs, None), ("term", terms, top)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, i, v, r) for r, (i, v) in enumerate(items[:most], 1)]
    return sorted(out)


@pytest.fixture(scope="module")
def mixed(spark):
    rng = np.random.default_rng(5)
    words = ["Wald", "wald", "über", "ÜBER", "été", "a", "b", "zoo"] + [f"t{chr(97 + i)}{chr(97 + i % 7)}" for i in range(26)]
    rows = []
    for i in range(400):
        lang, source = [("en", f"s{rng.zipf(1.6) % 9}"), ("fr", "s1"), (None, None), ("", f"x{i % 4}")][i % 4]
        rows.append((" ".join(rng.choice(words, rng.integers(0, 30))) + "9x_y", lang, source))
    rows += [(None, "de", "u"), ("", "de", "v"), ("...", "de", None), ("rare word", "nl", "only"), ("t " * 50_000, "en", "s1")]
    return rows, spark.createDataFrame(rows, "text string, lang string, source string").withColumn("item", F.lit("x")).repartition(5)


@pytest.mark.parametrize("params", [{}, {"digest_bits": 3}, {"held_terms": 5, "block_sources": 2}])
def test_audit_matches_brute_force(mixed, params):
    """Also with digests that nearly all collide, and with small blocks and counts written early."""
    rows, df = mixed
    found = sorted(tuple(r) for r in term_audit.audit_sources(df, term_audit.Audit(**params)).collect())
    assert found == brute_audit(rows)


def test_audit_of_odd_tables(odd):
    assert term_audit.audit_sources(odd.where("false")).count() == 0
    found = sorted(tuple(r) for r in term_audit.audit_sources(odd).collect())
    assert found == brute_audit([(t, lang, s) for _, t, lang, s in PLAIN])
    assert {r[4] for r in found if r[0] == "fr"} == {0}


def test_audit_shuffles_numbers_only(mixed):
    """The counts that are shuffled by term have no string column."""
    plan = term_audit._cells(
        mixed[1].sparkSession.createDataFrame([], "l long, g long, digest long, n long, docs long, slot long, term binary"), ["digest"], term_audit.Audit()
    )
    assert "term" not in plan.columns


def test_audit_writes_a_term_once_per_language(spark, monkeypatch, capsys):
    """Counts of a term in many sources share its string, and strings are shuffled without digests."""
    made, plans, settled = {}, {}, term_audit.settled

    def seen(df, label):
        df.explain()
        plans[label] = capsys.readouterr().out
        made[label] = settled(df, label)
        return made[label]

    monkeypatch.setattr(term_audit, "settled", seen)
    rows = [("wald und wiese " * (1 + i % 3), "de" if i % 2 else "nl", f"s{i % 30}") for i in range(240)]
    df = spark.createDataFrame(rows, "text string, lang string, source string").coalesce(1)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = sorted(tuple(r) for r in term_audit.audit_sources(df).collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert found == brute_audit(rows)
    assert made["audit-counts"].count() == 2 * 3
    assert "digest" not in made["audit-counts"].columns
    assert "hashpartitioning(xxhash64(term" in plans["audit-strings"]
    assert plans["audit-strings"].count("Exchange ") == 2


def test_chance_beyond_64_bits(spark):
    n = 10**12
    df = spark.range(1).select(F.lit(n).alias("n"), F.lit(3 * n).alias("total"), F.lit(7).cast("long").alias("v"))
    got = df.select(term_audit._chance(F.col("n"), F.col("total"), F.col("v"), term_audit.Audit())).first()[0]
    assert got == 1 + 10**9 * (n + 2) // (3 * n + 14)
