"""The registered queries against their SQL, the pipeline against a brute-force version of its stages."""

from __future__ import annotations

import base64
import glob
import hashlib
import os
import re
from collections import Counter

import duckdb
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from hexpanel.llm import mix, queries, toxic

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM read_parquet('{f}')")
    return con


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, sql, name):
    df = queries.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    rows = sorted(str(tuple(f"{v:.9g}" if isinstance(v, float) else v for v in r)) for r in df.select(*columns).collect())
    if name not in queries.ORACLES:
        table = "pages" if "page_id" in columns else "documents"
        assert len(rows) == sql.execute(f"SELECT count(*) FROM {table}").fetchone()[0]
        return
    found = sql.execute(queries.ORACLES[name])
    theirs = [x[0] for x in found.description]
    assert columns == sorted(theirs)
    at = [theirs.index(c) for c in columns]
    assert rows == sorted(str(tuple(f"{r[i]:.9g}" if isinstance(r[i], float) else r[i] for i in at)) for r in found.fetchall())


def test_pipeline_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    judged = toxic.judge(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    left = {r["doc_id"]: (r["text"] or "", r["source"]) for r in judged.where("not toxic").collect()}
    last = {t: i for i, (t, _) in sorted(left.items())}
    left = {i: left[i] for i in last.values()}

    def shingled(text, n=5):
        w = WORD.findall(text.translate(LOWER))
        return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()

    sets = {i: shingled(t) for i, (t, _) in left.items()}
    root = {i: i for i in sorted(left)}
    changed = True
    pairs = [(i, j) for i in sets for j in sets if i < j and sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    while changed:
        changed = False
        for i, j in pairs:
            low = min(root[i], root[j])
            changed |= root[i] != low or root[j] != low
            root[i] = root[j] = low
    assert pairs
    left = {i: left[i] for i in left if root[i] == i}

    kept = spark.createDataFrame([(i, t, s) for i, (t, s) in left.items()], "doc_id long, text string, source string")
    copies = {r["doc_id"]: r["copies"] for r in mix.mix(kept).collect()}  # held against brute force in its own test
    out = corpus_pipeline.run(spark, SF).collect()
    assert Counter(r["doc_id"] for r in out) == Counter({i: n for i, n in copies.items() if n})
    with open(queries.ranks_path(), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    codec = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for r in out:
        text, source = left[r["doc_id"]]
        assert r["ids"] == codec.encode_ordinary(text) and r["source"] == source and r["n_tokens"] == len(r["ids"])
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("stage", range(5))
def test_stages_take_nulls_and_empty_tables(spark, stage):
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (None, "text of nobody", None, "a", None), (4, "one two three four five six", "en", None, 6), (5, "one two three four five six", "en", "a", 6)]
    docs = spark.createDataFrame(rows, schema).withColumn("kept", F.lit("clash"))
    _, f = corpus_pipeline.STAGES[stage]
    some, none = f(spark, docs, SF), f(spark, docs.limit(0), SF)
    assert some.count() > 0 and none.count() == 0
    if stage < 4:
        assert set(schema.names) <= set(some.columns)


def test_encoding_takes_one_worker_a_task(spark):
    out = corpus_pipeline.encoding(spark, spark.read.parquet(f"{SF}/documents.parquet"), SF)
    assert out._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1


def test_exact_dedup_keeps_one_row_of_each_text(spark):
    rows = [(None, "a", "en", "s", 1), (2, "a", "en", "s", 1), (None, "b", "en", "s", 1), (None, "b", "de", "s", 1), (3, "c", "en", "t", 1), (3, "c", "en", "s", 1), (3, "d", "en", "s", 1), (4, "d", "en", "s", 1), (5, None, "en", "s", 0), (5, "", "en", "s", 0), (6, "e", "en", "s", 1), (6, "e", "en", "s", 1), (None, "f", None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
    out = sorted((x["text"] or "", x["doc_id"], x["lang"], x["source"]) for x in corpus_pipeline.exact_dedup(spark, df, SF).collect())
    assert out == [("", 5, "en", "s"), ("a", 2, "en", "s"), ("b", None, "de", "s"), ("c", 3, "en", "s"), ("d", 4, "en", "s"), ("e", 6, "en", "s"), ("f", None, None, None)]
    assert corpus_pipeline.exact_dedup(spark, df, SF).columns == df.columns


@pytest.mark.parametrize("bits", [1 << 26, 64])
def test_dedup_shuffles_only_rows_that_may_go(spark, monkeypatch, bits):
    monkeypatch.setattr(corpus_pipeline, "BITS", bits)
    rows = [(i if i % 7 else None, f"text {i // 2 if i % 20 < 2 else i}", "en", "s", 1) for i in range(4000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumn("word", F.lit("mine"))
    keys = df.where("doc_id % 20 = 0 or doc_id is null and text = 'text 7'").select(F.col("doc_id").alias("key"))
    some, rest = corpus_pipeline._apart(df, keys, "key")
    ids, left = [x["doc_id"] for x in some.collect()], [x["doc_id"] for x in rest.collect()]
    gone = {x["key"] for x in keys.collect()}
    assert None in gone and gone <= set(ids) and not gone & set(left)
    assert Counter(ids + left) == Counter(r[0] for r in rows) and some.columns == rest.columns == df.columns
    assert bits == 64 or len(ids) < 1400  # 200 keys, 572 rows without one, and a sixteenth of the others
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as where the rejected are too many
    try:
        out = corpus_pipeline.exact_dedup(spark, df, SF).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    last = {}
    for k, t, *_ in rows:
        last[t] = max(last.get(t, -1), -1 if k is None else k)
    assert Counter((-1 if x["doc_id"] is None else x["doc_id"], x["text"]) for x in out) == Counter((k, t) for t, k in last.items())


def test_near_dedup_loses_no_text_of_a_repeated_key(spark):
    a = "the river rose by two metres on a long and rainy night in the lower town near the old bridge"
    rows = [(3, a), (5, a + " x"), (5, "quite different words that nothing else in this table has at all"), (6, a.upper()), (6, "one more text that has a key of its own twice"), (None, a)]
    df = spark.createDataFrame([(k, t, "en", "s", len(t)) for k, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    for c in ("_id", "key", "sha", "_sha", "n", "kept", "group", "rep"):
        df = df.withColumn(c, F.lit("mine"))
    out = corpus_pipeline.near_dedup(spark, df, SF)
    assert out.columns == df.columns
    assert sorted((str(x["doc_id"]), x["text"]) for x in out.collect()) == sorted([("3", a), ("5", rows[2][1]), ("6", rows[4][1]), ("None", a)])
    twice = spark.createDataFrame([(3, a, "en", "s", 1), (3, a.upper(), "en", "s", 1), (4, a + " x", "en", "s", 1)], "doc_id long, text string, lang string, source string, n_chars long")
    assert corpus_pipeline.near_dedup(spark, twice, SF).count() == 1
    exact = corpus_pipeline.exact_dedup(spark, df.unionByName(df), SF)
    assert exact.columns == df.columns and exact.count() == len({t for _, t in rows})


def test_op1_digests_equal_the_library(spark):
    with open(queries.ranks_path(), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    codec = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    out = {x["doc_id"]: x for x in queries.op1_bpe(spark, SF).collect()}
    texts = {x["doc_id"]: x["text"] or "" for x in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert out.keys() == texts.keys()
    for i, text in texts.items():
        ids = codec.encode_ordinary(text)
        assert (out[i]["n_tokens"], out[i]["ids_sha256"], out[i]["decoded_sha256"]) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())


def test_op2_digests_equal_the_stated_patterns(spark):
    keyed = "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in "password") + "|" + "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w) for w in ("passwd", "secret", "token"))
    patterns = {"assign": (rf"""(?:{keyed}|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 8), "access": ("(AKIA[A-Z0-9]+)", 16), "hex": ("([0-9a-f]+)", 32)}
    out = {x["doc_id"]: x for x in queries.op2_secrets(spark, SF).collect()}
    texts = {x["doc_id"]: x["text"] or "" for x in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert out.keys() == texts.keys()
    for i, text in texts.items():
        spans = sorted((m.start(), n, k, m.end()) for n, (k, (p, least)) in enumerate(patterns.items()) for m in re.finditer(p, text) if len(m[1]) >= least)
        listed = [f"{k}:{a}:{b}" for a, _, k, b in spans]
        assert out[i]["base_sha256"] == hashlib.sha256(",".join(listed).encode()).hexdigest()
        assert [out[i][f"n_{k}"] for k in patterns] == [sum(x.startswith(k) for x in listed) for k in patterns]
        assert set(listed) <= set(out[i]["spans"].split(","))


def test_op8_and_its_sql_follow_chains_of_aliases(spark, tmp_path):
    """The given pages declare no aliases; on these both must pass decisions along canonical links and redirects."""
    link, move = '<link rel="canonical" href="{}">', "<meta http-equiv=refresh content='0; url={}'>"
    pages = [
        ("http://m.test/a", link.format("/b")), ("http://m.test/b", move.format("http://M.test/c#x")), ("http://m.test/c", link.format("//shop.com/en/")),  # a chain that ends at a blocked address
        ("http://n.test/a", move.format("http://x.org/es/1")), ("http://n.test/b", link.format("http://n.test/a")), ("http://n.test/c", link.format("http://n.test/b") + move.format("https://net/de/1")),  # blocked and allowed
        ("http://o.test/a", "<!-- " + link.format("http://shop.com/en/") + " -->canonical"), ("http://o.test/x/b", "<link title='a>b' rel='canonical' href='c'>"), ("http://o.test/x/c", link.format("http://net/de/2")),
        ("http://net/de/own", link.format("http://shop.com/en/own")), ("http://p.test/", link.format("mailto:a@shop.com")), (None, link.format("http://shop.com/en/x")), ("no scheme", None), ("http://shop.com/en/", None),
    ]
    spark.createDataFrame([(i, u, h) for i, (u, h) in enumerate(pages)], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    mine = sorted(tuple(x) for x in queries.op8_urls(spark, str(tmp_path)).select("page_id", "host", "path", "rule", "verdict").collect())
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    assert mine == sorted(con.execute(f"SELECT page_id, host, path, rule, verdict FROM ({queries.ORACLES['op8_urls']})").fetchall())
    assert [x[4] for x in mine] == ["block"] * 3 + ["allow"] * 3 + ["allow", "allow", "allow"] + ["allow", "allow", "allow", "allow", "block"]
