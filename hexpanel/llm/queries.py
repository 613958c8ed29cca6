"""The thin queries of the ten operators, and their SQL where SQL has them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hexpanel.llm import bpe, embeddings, exact, html, minhash, mix, secrets, toxic, urls, warc
from hexpanel.llm._util import new_path


def ranks_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids of every whole text of documents (null as empty) and of the bytes they decode to."""
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.encode(docs, ranks_path()).select("doc_id", F.col("encoded.ids").alias("ids"))
    back = bpe.decode(coded, ranks_path())
    listed = F.array_join(F.col("ids").cast("array<string>"), ",")
    return back.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(listed, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and added spans of every whole text of documents (null as empty): counts, and spans by start, then kind."""
    found = secrets.find(_read(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "secrets")
    base = F.filter("secrets", lambda s: s["kind"].isin(*secrets.BASE))
    told = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long")
    return found.select("doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"), F.sha2(told(base), 256).alias("base_sha256"), told(F.col("secrets")).alias("spans"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes a record per page (null html as empty) and reads the archive back; record_sha256 is of the rebuilt record's
    bytes, so every payload is joined to its header again."""
    archive = warc.write(_read(spark, sf_dir, "pages"), new_path(spark, "warc"))
    return warc.record_bytes(warc.read(spark, archive)).select(
        F.col("record_id").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast("long").alias("refers_to"),
        F.octet_length("record").cast("long").alias("record_bytes"), F.sha2("record", 256).alias("record_sha256"),
    )


def op4_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors of a label; vectors without a direction or a label link with nothing."""
    return embeddings.dedup(_read(spark, sf_dir, "embeddings"))


def op5_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every document: of equal texts (null as empty) that of largest doc_id stays."""
    return exact.find(_read(spark, sf_dir, "documents"))


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set size and component of every document; null texts and texts without words link with nothing."""
    return minhash.link(_read(spark, sf_dir, "documents"))


def op7_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size, target of the source and words taken of every document; null texts have size 0, null is a source."""
    return mix.mix(_read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op8_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page; aliases that pages declare take part; null addresses get the default."""
    return urls.judge(_read(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op9_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page, empty for null and empty pages."""
    found = html.extract(_read(spark, sf_dir, "pages"))
    return found.select("page_id", "url", F.col("main_text").alias("text"), F.char_length("main_text").cast("long").alias("n_chars"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probabilities of the chain and verdict on every document, null texts as texts without words."""
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    return toxic.judge(docs, _read(spark, sf_dir, "labels")).select("doc_id", "p_lexical", "p_severe", "p_toxic", "toxic")


QUERIES = {f.__name__: f for f in (op1_bpe, op2_secrets, op3_warc, op4_embeddings, op5_exact, op6_minhash, op7_mix, op8_urls, op9_html, op10_toxicity)}

_COMPONENTS = """
, both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links)
, reach(node, seen) AS (SELECT a, a FROM both_ways UNION SELECT reach.node, both_ways.b FROM reach JOIN both_ways ON reach.seen = both_ways.a)
, least_seen AS (SELECT node, min(seen) AS component FROM reach GROUP BY node)
"""

ORACLES = {
    "op3_warc": r"""
WITH r AS (SELECT page_id, coalesce(html, '') AS body, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest, coalesce(url, '') AS url FROM pages)
, w AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS winner FROM r)
, t AS (SELECT *, payload_bytes >= 1000 AND page_id <> winner AS again FROM w)
, rec AS (SELECT *, concat(E'WARC/1.1\r\nWARC-Type: ', CASE WHEN again THEN 'revisit' ELSE 'response' END, E'\r\nWARC-Record-ID: <urn:page:', page_id, E'>\r\nWARC-Date: 1970-01-01T00:00:00Z\r\nWARC-Target-URI: ', replace(replace(url, E'\r', '%0D'), E'\n', '%0A'),
  E'\r\nWARC-Payload-Digest: sha1:', payload_digest, E'\r\n', CASE WHEN again THEN concat('WARC-Refers-To: <urn:page:', winner, E'>\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\n') ELSE '' END,
  E'Content-Type: text/html; charset=utf-8\r\nContent-Length: ', CASE WHEN again THEN 0 ELSE payload_bytes END, E'\r\n\r\n', CASE WHEN again THEN '' ELSE body END, E'\r\n\r\n') AS record FROM t)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN again THEN winner END AS refers_to, CAST(strlen(record) AS BIGINT) AS record_bytes, sha256(record) AS record_sha256
FROM rec""",
    "op4_embeddings": """
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings)
, ok AS (SELECT * FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_sum(list_transform(e, lambda x: abs(x))) > 0)
, links AS (SELECT x.vec_id AS a, y.vec_id AS b FROM ok x JOIN ok y ON x.label = y.label AND x.vec_id < y.vec_id AND list_cosine_similarity(x.e, y.e) >= 0.98)
""" + _COMPONENTS + """
, n AS (SELECT a, count(*) AS n FROM both_ways GROUP BY a)
SELECT v.vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, coalesce(component, v.vec_id) AS component_id, v.vec_id = coalesce(component, v.vec_id) AS kept
FROM v LEFT JOIN n ON n.a = v.vec_id LEFT JOIN least_seen ON node = v.vec_id""",
    "op5_exact": """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))""",
    "op6_minhash": r"""
WITH RECURSIVE words AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents)
, sets AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')] ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s FROM words)
, flat AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets)
, links AS (SELECT p.doc_id AS a, q.doc_id AS b FROM flat p JOIN flat q ON p.x = q.x AND p.doc_id < q.doc_id GROUP BY p.doc_id, q.doc_id, p.n, q.n HAVING 100 * count(*) >= 85 * (p.n + q.n - count(*)))
""" + _COMPONENTS + """
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, coalesce(component, doc_id) AS component_id, doc_id = coalesce(component, doc_id) AS kept
FROM sets LEFT JOIN least_seen ON node = doc_id""",
    "op7_mix": r"""
WITH r AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size, substr(md5('7:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 15) AS h FROM documents)
, s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w FROM r GROUP BY source)
, o AS (SELECT *, 3 * source_size AS room, row_number() OVER (ORDER BY 3 * source_size / w, source NULLS LAST) AS place FROM s)
, l AS (SELECT *, CAST(sum(source_size) OVER () - coalesce(sum(room) OVER (ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE) / (sum(w) OVER () - coalesce(sum(w) OVER (ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level FROM o)
, t AS (SELECT source, source_size, least(CAST(room AS DOUBLE), coalesce((SELECT arg_min(level, place) FROM l WHERE level * w <= room) * w, CAST(room AS DOUBLE))) AS target FROM l)
, b AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM t)
, g AS (SELECT source, h, sum(size) AS size FROM r GROUP BY source, h)
, c AS (SELECT g.source, h, size, coalesce(sum(size) OVER (PARTITION BY g.source ORDER BY h ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS upto, target - whole * source_size AS budget FROM g JOIN b ON g.source IS NOT DISTINCT FROM b.source)
, e AS (SELECT source, min(h) AS bound FROM c WHERE upto + size > budget GROUP BY source)
, m AS (SELECT c.source, c.h, CASE WHEN e.bound IS NULL THEN budget > 0 WHEN c.h < e.bound THEN true WHEN c.h = e.bound THEN upto + size - budget < budget - upto ELSE false END AS once FROM c LEFT JOIN e ON c.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, target, CAST(size * least(whole + CASE WHEN once THEN 1 ELSE 0 END, 3) AS BIGINT) AS taken
FROM r JOIN b ON r.source IS NOT DISTINCT FROM b.source JOIN m ON r.source IS NOT DISTINCT FROM m.source AND r.h = m.h""",
    "op8_urls": r"""
WITH RECURSIVE tags AS (SELECT trim(url) AS url, unnest(regexp_extract_all(regexp_replace(html, '<!--.*?(-->|$)', '', 'gs'), '(?is)<(?:link|meta)\b(?:[^>"'']|"[^"]*"|''[^'']*'')*>')) AS tag FROM pages WHERE regexp_matches(html, '(?i)canonical|http-equiv'))
, said AS (SELECT url, CASE WHEN regexp_matches(tag, '(?i)\srel\s*=\s*("[^"]*|''[^'']*)?\bcanonical\b') THEN regexp_extract(tag, '(?i)\shref\s*=\s*["'']?([^\s"''>]*)', 1)
  WHEN regexp_matches(tag, '(?i)\shttp-equiv\s*=\s*["'']?refresh') THEN regexp_extract(tag, '(?i)\scontent\s*=\s*["'']?\s*[\d.]+\s*[;,]\s*(?:url\s*=\s*)?[''"]?([^\s"''>]*)', 1) END AS target FROM tags)
, found AS (SELECT url, replace(target, '&amp;', '&') AS target, regexp_extract(url, '^.*?://[^/?#]*') AS front FROM said WHERE coalesce(target, '') <> '')
, edges AS (SELECT url AS a, CASE WHEN regexp_matches(target, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN target WHEN regexp_matches(target, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN '' WHEN starts_with(target, '//') THEN regexp_extract(front, '^(.*?:)//', 1) || target
  WHEN starts_with(target, '/') THEN front || target ELSE front || CASE WHEN regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1) = '' THEN '/' ELSE regexp_replace(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1), '[^/]*$', '') END || target END AS b FROM found WHERE front <> '')
, bare AS (SELECT regexp_replace(a, '#.*$', '', 's') AS a, regexp_replace(b, '#.*$', '', 's') AS b FROM edges WHERE b <> '')
, links AS (SELECT lower(regexp_extract(a, '^.*?://[^/?#]*')) || substr(a, length(regexp_extract(a, '^.*?://[^/?#]*')) + 1) AS a, lower(regexp_extract(b, '^.*?://[^/?#]*')) || substr(b, length(regexp_extract(b, '^.*?://[^/?#]*')) + 1) AS b FROM bare)
""" + _COMPONENTS + r"""
, addresses AS (SELECT page_id, url AS address, CAST(NULL AS VARCHAR) AS node FROM pages UNION ALL SELECT NULL, node, node FROM least_seen)
, split AS (SELECT *, CASE WHEN contains(address, '://') THEN substr(address, strpos(address, '://') + 3) ELSE '' END AS rest FROM addresses)
, h AS (SELECT page_id, node, address, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM split)
, rules AS (SELECT * FROM (VALUES ('block', 'com', '/en/'), ('allow', 'example.com', '/en/7'), ('allow', 'net', '/de/'), ('block', 'example.net', '/de/8'), ('block', 'org', '/es/')) x(verdict, rh, rp))
, best AS (SELECT host, path, arg_max(rh || rp, length(rh || rp)) AS rule, arg_max(verdict, length(rh || rp)) AS verdict FROM (SELECT DISTINCT host, path FROM h) d JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY host, path)
, ruled AS (SELECT l.component, min(best.verdict) AS verdict FROM h JOIN best USING (host, path) JOIN least_seen l ON l.node = h.node GROUP BY l.component)
, aliases AS (SELECT l.node, r.verdict FROM least_seen l JOIN ruled r USING (component))
, own AS (SELECT *, regexp_replace(trim(address), '#.*$', '', 's') AS bare FROM h WHERE page_id IS NOT NULL)
SELECT page_id, own.host, own.path, rule, coalesce(best.verdict, aliases.verdict, 'allow') AS verdict
FROM own LEFT JOIN best USING (host, path) LEFT JOIN aliases ON aliases.node = lower(regexp_extract(bare, '^.*?://[^/?#]*')) || substr(bare, length(regexp_extract(bare, '^.*?://[^/?#]*')) + 1)""",
}
