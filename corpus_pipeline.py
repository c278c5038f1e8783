"""From raw documents to training sequences, stage by stage."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import language, pii, toxicity
from tidemark.llm.darts import near_duplicates
from tidemark.llm.packing import pack
from tidemark.llm.rows import crc_bucket
from tidemark.operators.lookup import broadcast_if_small
from tidemark.session import configure, discard, durable, settle

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

TOXIC_FROM = 0.7
# below this score no family's machine claims a text; told only of texts of so many letters, as a few words say little
LANGUAGE_FROM, LETTERS = 0.4, 100
ROW = "row"


def _carried(docs: DataFrame, **more: Column) -> DataFrame:
    """The row in one column beside its text, so that no operator's column can clash with one of its own. The text itself
    is there once."""
    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    return docs.select(F.struct(*others).alias(ROW), F.col("text"), *[column.alias(name) for name, column in more.items()])


def _row(docs: DataFrame) -> list[Column]:
    """The columns of ``docs`` from what ``_carried`` made."""
    return [F.col("text") if c == "text" else F.col(f"{ROW}.`{c}`").alias(c) for c in docs.columns]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents in no language: null and empty texts, those without a letter, and those of ``LETTERS`` letters or more
    that score below ``LANGUAGE_FROM`` (hex and base64 dumps, most text in languages never learned). Learns
    from three quarters of the documents' own language labels; rows with a null id or label are judged like others. Where no
    language could be learned at all, only texts without a letter go. Repeated rows stay or go together."""
    configure(spark)
    learned = docs.where(F.coalesce(crc_bucket("doc_id", 4) != 2, F.lit(True)))
    model = language.fit(learned)
    found = language.predict(_carried(docs), model, keep=[ROW, "text"])
    lettered = F.coalesce(F.regexp_count("text", F.lit(r"\p{L}")), F.lit(0))
    if not model.languages:
        return found.where(lettered > 0).select(_row(docs))
    claimed = (F.col("score") >= LANGUAGE_FROM) | (lettered < LETTERS)
    return found.where((F.col("lang_pred") != language.UNKNOWN) & claimed).select(_row(docs))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents with a toxicity score of ``TOXIC_FROM`` or more. Learns from two thirds of the labelled ones. A null id
    has no label and is scored like any other; null and empty texts stay; repeated rows stay or go together."""
    configure(spark)
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet").select("doc_id", "toxic")
    tagger = toxicity.fit(docs, labels.where(crc_bucket("doc_id", 3) != 1))
    scored = toxicity.score(_carried(docs), tagger, keep=[ROW, "text"])
    return scored.where(F.col("score") < TOXIC_FROM).select(_row(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each class of near-duplicates, the one with the smallest id.

    Rows whose id is null or repeated are told apart by a number of their own: of these, too, one of each class stays; null
    ids come last, and of rows with the same id and class any one stays. Texts without a word (null and empty
    ones) are classes of their own and all stay. Only rows of null and repeated ids are written to be numbered.
    """
    configure(spark)
    columns = [F.col(f"{ROW}.`{c}`").alias(c) for c in docs.columns]
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(ROW), F.col("doc_id").cast("long").alias("key"))
    odd_keys = durable(whole.groupBy("key").count().where("count > 1 or key is null").select("key"))
    plain = whole.where("key is not null").join(broadcast_if_small(odd_keys.where("key is not null")), "key", "left_anti")
    keyed = plain.select("key", ROW)
    if not odd_keys.isEmpty():
        repeated = whole.join(broadcast_if_small(odd_keys.where("key is not null")), "key", "left_semi").select(ROW)
        odd = repeated.unionByName(whole.where("key is null").select(ROW))
        least, most = whole.agg(F.min("key"), F.max("key")).first()
        # numbers that no id has, fixed by being written
        number = F.monotonically_increasing_id()
        fresh = F.lit((most or 0) + 1) + number if (most or 0) < 1 << 62 else F.lit(least - 1) - number
        keyed = keyed.unionByName(durable(odd.select(fresh.alias("key"), ROW)))

    def classes() -> DataFrame:
        found = near_duplicates(keyed.select("key", F.col(f"{ROW}.text").alias("text")), key="key")
        shared = found.groupBy("class_id").count().where("count > 1").select("class_id")
        members = found.join(shared, "class_id").select(F.col("doc_id").alias("key"), "class_id")
        named = keyed.select("key", F.col(f"{ROW}.doc_id").alias("id"))
        return members.join(named, "key").select("key", "class_id", F.struct(F.col("id").isNull().alias("unnamed"), "id", "key").alias("place"))

    members = settle(classes)
    first = members.groupBy("class_id").agg(F.min("place").alias("first")).select(F.col("first.key").alias("key"))
    others = durable(members.join(first, "key", "left_anti").select("key"))
    return keyed.join(others, "key", "left_anti").select(columns)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Put the kind in brackets in the place of each span of personal data; ``n_chars`` follows the text. Rows without a span,
    null and empty texts among them, stay as they are."""
    configure(spark)
    model = pii.fit(docs.select("doc_id", "text"))
    found = pii.find_personal_data(_carried(docs), model, keep=[ROW, "text"], redacted="clean")
    changed = F.size("spans") > 0
    new = {"text": F.col("clean"), "n_chars": F.length("clean").cast("long")}
    return found.select([F.when(changed, new[c]).otherwise(row).alias(c) if c in new else row
                         for c, row in zip(docs.columns, _row(docs))])


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 2048 tokens, with their ids."""
    configure(spark)
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("language", identify_language),
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("personal_data", redact_personal_data),
    ("packing", pack_sequences),
]

# fitted models, signatures and tokenizers have no SQL form; the tests compare with brute force instead
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages; each one's result is written to the shared folder and read by the next."""
    docs, held = configure(spark).read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet"), []
    for _, stage in STAGES[:-1]:
        docs = durable(stage(spark, docs, sf_dir))
        discard(spark, held)  # this stage's input, unless it was the table itself
        held = [docs]
    return STAGES[-1][1](spark, docs, sf_dir)
