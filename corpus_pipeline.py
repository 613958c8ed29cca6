"""A training-data pipeline over documents: five stages, each of which rereads what the one before it wrote."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hexpanel.llm import bpe, exact, minhash, mix, toxic
from hexpanel.llm._util import clear, cut, fresh, mark
from hexpanel.llm.queries import ranks_path

NEAR_WORDS, NEAR_PERCENT, NEAR_TREES = 5, 80, 10
BITS = 1 << 26  # of the bitmap of rejected keys that tasks hold; with more keys more rows are shuffled, none is lost


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain doesn't reject. Null and empty texts are texts without words; repeated rows get
    one verdict; without labels of both kinds among them, and for an empty table, nothing is rejected. Other columns may
    have any name, those of the verdict too."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxic.passed(docs, labels)


def _sha(docs: DataFrame) -> Column:
    return exact.sha256(F.coalesce(docs["text"].cast("string"), F.lit("")))


def _apart(docs: DataFrame, keys: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """The rows of docs whose doc_id may be among keys, and all others: by a bitmap of the hashes of keys, about 16 bits a
    key, so that a join on keys that are too many to broadcast shuffles few texts besides those that it is about."""
    word, mask = fresh(docs, "word", "mask")
    bits = min(BITS, 1 << (16 * keys.count() + 1023).bit_length())
    spot = lambda c: F.pmod(F.xxhash64(c.cast("string")), F.lit(bits))
    of = lambda at: F.shiftright(at, 6)
    bit = lambda at: F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(at, F.lit(64)).cast("int"))
    at = spot(keys[key])
    words = F.broadcast(cut(keys.groupBy(of(at).alias(word)).agg(F.bit_or(bit(at)).alias(mask)), "words"))
    at = spot(docs["doc_id"])
    among = (of(at) == F.col(word)) & (F.col(mask).bitwiseAND(bit(at)) != 0)
    return docs.join(words, among, "left_semi"), docs.join(words, among, "left_anti")


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Exactly one document of each text: that of largest doc_id, a null one only where all are null; of rows that repeat both doc_id and
    text, the least by all columns. Null texts count as empty; an empty table gives no rows; other columns may have any
    name. Rejected rows are found by doc_id (null-safely) and digest; where they are too many to broadcast, rows whose doc_id
    may be among theirs are shuffled again, others not."""
    key, sha = fresh(docs, "key", "sha")
    found = exact.find(docs).where("group_size > 1").select(F.col("doc_id").alias(key), "kept", F.col("text_sha256").alias(sha))
    copies = cut(found.groupBy(key, "kept", sha).agg(F.count("*").alias("n")), "copies")
    gone = copies.where("not kept or n > 1")
    some, rest = _apart(docs, gone, key)
    among = some["doc_id"].eqNullSafe(F.col(key)) & (_sha(some) == F.col(sha))
    rest = rest.union(some.join(gone.select(key, sha), among, "left_anti"))
    tied = copies.where("kept and n > 1").select(key, sha)
    if tied.isEmpty():
        return rest
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    one = some.join(tied, among, "left_semi").groupBy("doc_id", _sha(some)).agg(F.min(row).alias("row"))
    return rest.unionByName(one.select("row.*"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that of least doc_id; where that doc_id comes with several texts of the
    group, the one of least digest. Documents without a doc_id, and those without words, link with nothing and stay. Rows
    are rejected by doc_id and digest, so a text goes only if it is a near copy itself. An empty table gives no rows;
    other columns may have any name."""
    key, sha = fresh(docs, "key", "sha")
    found = minhash.link(docs, size=NEAR_WORDS, percent=NEAR_PERCENT, trees=NEAR_TREES, detail=True)
    kept = found.where("kept and group is not null")
    tied = kept.groupBy("group").agg(F.min("text_sha256").alias("least"), F.max("text_sha256").alias("most")).where("least != most").select("group", "least")
    lost = kept.join(tied, "group").where("text_sha256 != least").select("doc_id", "text_sha256")
    gone = found.where("not kept and doc_id is not null").select("doc_id", "text_sha256").union(lost).toDF(key, sha)
    gone = cut(gone.distinct(), "gone")
    some, rest = _apart(docs, gone, key)
    return rest.union(some.join(gone, (some["doc_id"] == F.col(key)) & (_sha(some) == F.col(sha)), "left_anti"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: nulls, ties, repeated rows and empty tables as `mix.take` states."""
    return mix.take(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with the digest of what they decode to. Null and empty texts have no ids; repeated
    rows are encoded each; an empty table gives no rows."""
    coded = bpe.round_trip(docs.select("doc_id", "source", "text"), ranks_path())
    return coded.select("doc_id", "source", F.size("encoded.ids").cast("long").alias("n_tokens"), "encoded.ids", F.sha2("encoded.decoded", 256).alias("decoded_sha256"))


STAGES = [("toxicity", toxicity), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("mixing", mixing), ("encoding", encoding)]

#: The classifier and the tokenizer have no SQL form; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. What a stage has written on its way goes when its result is written, and that when the
    next one's is."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        since, before = mark(), docs
        docs = cut(stage(spark, before, sf_dir), name)
        clear(since, (name,))
    return STAGES[-1][1](spark, docs, sf_dir)
