"""Queries of this folder: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomcast.llm.banded import near_copies
from loomcast.llm.chosen_path import near_duplicates
from loomcast.llm.chunk_memo import fill_in_middle, restored
from loomcast.llm.html_text import extract_pages
from loomcast.llm.lang_tags import identify_languages
from loomcast.llm.licenses import scan_licenses
from loomcast.llm.mixing import systematic_copies
from loomcast.llm.packing import pack
from loomcast.llm.quality import judge_quality
from loomcast.llm.secret_tags import scan_secrets
from loomcast.llm.sketch import fingerprint_documents
from loomcast.llm.term_audit import audit_sources
from loomcast.llm.warc import archive_pages
from loomcast.session import prepare

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def _over(name: str, table: str, sql: str | None = None) -> Callable[[Callable[[DataFrame], DataFrame]], Query]:
    def register(use: Callable[[DataFrame], DataFrame]) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return use(prepare(spark).read.parquet(f"{folder}/{table}.parquet"))

        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return run

    return register


@_over("op1_quality_rules", "documents")
def op1(docs: DataFrame) -> DataFrame:
    return judge_quality(docs)


@_over("op2_html_extraction", "pages")
def op2(pages: DataFrame) -> DataFrame:
    return extract_pages(pages)


@_over("op3_ngram_jaccard_join", "documents")
def op3(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs)


# Base 32 in SQL: five hexadecimal digits are four letters.
_BASE32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(h, {5 * g + 1}, 5))::INT // {32**k}) % 32) + 1, 1)"
    for g in range(8)
    for k in (3, 2, 1, 0)
)


@_over(
    "op4_warc",
    "pages",
    f"""
    WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
    d AS (SELECT page_id, octet_length(payload)::BIGINT AS payload_bytes, sha1(payload) AS h FROM p),
    m AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS newest FROM d)
    SELECT page_id, payload_bytes, {_BASE32} AS payload_digest,
           CASE WHEN page_id = newest THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id <> newest THEN newest END AS refers_to
    FROM m
    """,
)
def op4(pages: DataFrame) -> DataFrame:
    return archive_pages(pages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@_over("op5_secret_scans", "documents")
def op5(docs: DataFrame) -> DataFrame:
    found = scan_secrets(docs)
    joined = lambda spans: F.concat_ws(
        ",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    )
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id",
        count("assign"),
        count("access"),
        count("hex"),
        F.sha2(joined("base"), 256).alias("base_sha256"),
        joined("spans").alias("spans"),
    )


@_over("op6_document_fingerprints", "documents")
def op6(docs: DataFrame) -> DataFrame:
    return fingerprint_documents(docs)


@_over("op7_packing", "documents")
def op7(docs: DataFrame) -> DataFrame:
    return pack(docs)


@_over("op8_language_id", "documents")
def op8(docs: DataFrame) -> DataFrame:
    return identify_languages(docs)


@_over("op9_license_scans", "documents")
def op9(docs: DataFrame) -> DataFrame:
    return scan_licenses(docs).drop("spans")


@_over(
    "op10_source_mixing",
    "documents",
    r"""
    WITH d AS (
        SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
               CASE WHEN doc_id IS NULL THEN md5('mix:text:' || coalesce(text, '')) ELSE md5('mix:' || doc_id) END AS salt
        FROM documents),
    s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
    w AS (SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3)::INT + 1] AS weight,
                 source_size * 3 AS cap FROM s),
    l AS (SELECT *, row_number() OVER o AS place,
                 ((sum(source_size) OVER () - coalesce(sum(cap) OVER b, 0))::DOUBLE
                  / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0))::DOUBLE) AS level
          FROM w WINDOW o AS (ORDER BY cap::DOUBLE / weight, encode(source) NULLS LAST),
               b AS (ORDER BY cap::DOUBLE / weight, encode(source) NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    f AS (SELECT arg_min(level, place) AS level FROM l WHERE level * weight < cap),
    t AS (SELECT l.source, l.source_size, least(coalesce(f.level * l.weight, l.cap::DOUBLE), l.cap::DOUBLE) AS target
          FROM l LEFT JOIN f ON true),
    r AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS ratio,
                 ('0x' || substr(md5('mix:' || coalesce(source, 'null')), 1, 8))::BIGINT::DOUBLE / 4294967296.0 AS shift FROM t),
    p AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY size, salt, doc_id) AS position FROM d)
    SELECT p.doc_id, p.size, r.source_size, r.target,
           (least(floor(p.position * r.ratio + r.shift) - floor((p.position - 1) * r.ratio + r.shift), 3) * p.size)::BIGINT AS taken
    FROM p JOIN r ON p.source IS NOT DISTINCT FROM r.source
    """,
)
def op10(docs: DataFrame) -> DataFrame:
    return systematic_copies(docs).select("doc_id", "size", "source_size", "target", "taken")


@_over(
    "op11_fill_in_middle",
    "documents",
    r"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
    l AS (SELECT *, regexp_extract_all(t, '[^\n]*\n|[^\n]+') AS lines FROM d),
    c AS (SELECT *, len(lines)::BIGINT AS n, ('0x' || substr(h, 1, 8))::BIGINT % (len(lines) + 1) AS a,
                 ('0x' || substr(h, 9, 8))::BIGINT % (len(lines) + 1) AS b,
                 CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
                           OR ('0x' || substr(h, 17, 8))::BIGINT % 100 >= 100 THEN 'plain'
                      WHEN ('0x' || substr(h, 25, 8))::BIGINT % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM l),
    p AS (SELECT doc_id, n, form, t, coalesce(array_to_string(lines[1:least(a, b)], ''), '') AS prefix,
                 coalesce(array_to_string(lines[least(a, b) + 1:greatest(a, b)], ''), '') AS middle,
                 coalesce(array_to_string(lines[greatest(a, b) + 1:n], ''), '') AS suffix FROM c)
    SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
           CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
           sha256(CASE form WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                            WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle ELSE t END) AS output_sha256,
           sha256(t) AS restored_sha256
    FROM p
    """,
)
def op11(docs: DataFrame) -> DataFrame:
    return fill_in_middle(docs).select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(), 256).alias("restored_sha256"),
    )


@_over(
    "op12_minhash_near_dedup",
    "documents",
    r"""
    WITH RECURSIVE w AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                          '[^\x20\x09-\x0D]+') AS words FROM documents),
    s AS (SELECT doc_id, CASE WHEN len(words) = 0 THEN [] ELSE list_distinct(list_transform(
                     range(1, greatest(len(words) - 3, 1) + 1), lambda i: array_to_string(words[i:i + 3], ' '))) END AS shingles FROM w),
    n AS (SELECT doc_id, len(shingles)::BIGINT AS n FROM s),
    x AS (SELECT doc_id, hash(unnest(shingles)) AS shingle FROM s),
    c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM x a JOIN x b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL),
    l AS (SELECT a, b FROM c JOIN n m ON m.doc_id = a JOIN n o ON o.doc_id = b WHERE 100 * common >= 80 * (m.n + o.n - common)),
    e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
    r AS (SELECT doc_id AS node, doc_id AS seen FROM n UNION SELECT r.node, e.b FROM r JOIN e ON r.seen = e.a),
    k AS (SELECT node, min(seen) AS component_id FROM r GROUP BY node)
    SELECT n.doc_id, n.n AS n_shingles, k.component_id, n.doc_id = k.component_id AS kept FROM n JOIN k ON k.node = n.doc_id
    """,
)
def op12(docs: DataFrame) -> DataFrame:
    return near_copies(docs)


@_over(
    "op13_source_divergence",
    "documents",
    r"""
    WITH d AS (
        SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
               regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                  '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
        FROM documents),
    t AS (SELECT r, lang, source, unnest(terms) AS term FROM d),
    k AS (SELECT lang, term, count(*) AS n FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= 10),
    v AS (SELECT lang, count(*) AS v, sum(n) AS n FROM k GROUP BY lang),
    g AS (SELECT DISTINCT lang, source FROM d),
    c AS (SELECT lang, source, term, count(*) AS n FROM t SEMI JOIN k USING (lang, term) GROUP BY ALL),
    s AS (SELECT lang, source, coalesce(sum(c.n), 0) AS n FROM g LEFT JOIN c USING (lang, source) GROUP BY ALL),
    p AS (SELECT s.lang, s.source, k.term, coalesce(c.n, 0) AS n,
                 (1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (s.n + 2 * v.v))::BIGINT AS p,
                 (1 + (1000000000::HUGEINT * (k.n + 2)) // (v.n + 2 * v.v))::BIGINT AS q
          FROM s JOIN k USING (lang) JOIN v USING (lang)
               LEFT JOIN c ON c.lang = s.lang AND c.source = s.source AND c.term = k.term),
    f AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
          FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
    parts AS (
        SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0)::BIGINT AS value
        FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
             LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
        UNION ALL
        SELECT lang, source, 'term', term, (((p - q) * (p - q)) // (p + q))::BIGINT FROM p WHERE n > 0 AND p > q),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item))::INT AS rank FROM parts)
    SELECT * FROM ranked WHERE part = 'pair' OR rank <= 10
    """,
)
def op13(docs: DataFrame) -> DataFrame:
    return audit_sources(docs)
