"""The registered queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.chat import format_turns, read_back
from tidemark.llm.darts import near_duplicates
from tidemark.llm.html import extract_text
from tidemark.llm.language import fit as fit_languages
from tidemark.llm.language import predict as predict_language
from tidemark.llm.negatives import hard_negatives
from tidemark.llm.packing import pack
from tidemark.llm.pieces import encode_texts
from tidemark.llm.pii import KINDS, find_personal_data
from tidemark.llm.pii import fit as fit_personal_data
from tidemark.llm.rows import crc_bucket
from tidemark.llm.runs import WORD, periodic_runs
from tidemark.llm.toxicity import fit as fit_toxicity
from tidemark.llm.toxicity import score as score_toxicity
from tidemark.llm.vectors import nearest_vectors, similar_vectors
from tidemark.llm.warc import page_records, read_archives, write_archives
from tidemark.session import configure, durable, scratch_path, settle

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 2048 tokens."""
    pieces = pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


CONFLICT = "</s>[INST] ok [/INST]"


def chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of all conversations, and of one full of control strings, read back from their formatted form."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(1).select(F.explode(F.array(*[
        F.struct(F.lit(-7).cast("long").alias("conv_id"), F.lit(k).cast("long").alias("turn"),
                 F.lit(role).alias("role"), F.lit(CONFLICT).alias("text"))
        for k, role in enumerate(("user", "assistant"))])).alias("t")).select("t.*")
    return read_back(format_turns(turns.unionByName(extra), keep=["conv_id", "turn"]))


def near_duplicate_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of near-duplicates of each document."""
    return settle(lambda: near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text")))


def near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors at a cosine of 0.9 or more."""
    return settle(lambda: similar_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding")))


def nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors of every fiftieth one."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return settle(lambda: nearest_vectors(vectors, F.col("vec_id") % 50 == 0))


def html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    return extract_text(table(spark, sf_dir, "pages"), keep=["page_id", "url"])


def personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all texts: counts and digest of the spans found by rule, and all spans."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_personal_data(documents, fit_personal_data(documents), keep=["doc_id"])

    def listed(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["base"])
    return found.select(
        "doc_id",
        *map(count, KINDS),
        F.sha2(F.encode(listed(base), "UTF-8"), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )


def language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of all texts; a quarter of the documents, by the crc32 of their id, is never learned from."""
    documents = table(spark, sf_dir, "documents").select(
        "doc_id", "text", "lang", F.coalesce(crc_bucket("doc_id", 4) == 2, F.lit(False)).alias("held_out"))
    model = fit_languages(documents.where(~F.col("held_out")))
    return predict_language(documents, model, keep=["doc_id", "held_out"])


TOXIC_FROM = 0.7


def toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all texts; a third of the documents, by the crc32 of their id, is never learned from."""
    held_out = F.coalesce(crc_bucket("doc_id", 3) == 1, F.lit(False))
    documents = table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("held_out", held_out)
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic").where(~held_out)
    tagger = fit_toxicity(documents, labels)
    scored = score_toxicity(documents, tagger, keep=["doc_id", "held_out"])
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"))


def sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text and the text they decode to, as digests."""
    documents = table(spark, sf_dir, "documents")
    coded = encode_texts(documents, public_tokenizers.path("piece_bpe_32k.model"), keep=["doc_id"])
    return coded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )


def repeating(documents: DataFrame) -> DataFrame:
    """Texts by id; in each tenth one, by the crc32 of the id, the words from some place on repeat with a period."""
    mark = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    rest = F.floor(mark / 10)

    def cycled(words: Column) -> Column:
        n = F.size(words)
        begin = rest % n
        period = 1 + F.floor((n - begin) / (3 + rest % 8))
        place = F.sequence(F.lit(0), n - 1)
        return F.transform(place, lambda i: F.get(words, F.when(i < begin, i).otherwise(
            begin + (i - begin) % period).cast("int")))

    words = F.regexp_extract_all(F.col("text"), F.lit(WORD.pattern), F.lit(0))
    # through an array of one, so that the words are found once and not for each place
    joined = F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, F.array_join(cycled(w), " ")).otherwise(F.lit("")))[0]
    return documents.select("doc_id", F.when(mark % 10 == 0, joined).otherwise(F.col("text")).alias("text"))


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words in all texts, and the texts without repeats, as digests."""
    found = periodic_runs(repeating(table(spark, sf_dir, "documents")), keep=["doc_id"])
    ranked = F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period")))
    longest = F.array_max(ranked)
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.array_join(F.transform(lines, lambda line: F.concat(line, F.lit("\n"))), "")
    return found.withColumn("best", longest).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.floor(1000 * F.col("best.length") / -F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.encode(listed, "UTF-8"), 256).alias("runs_sha256"),
        F.sha2(F.encode("collapsed", "UTF-8"), 256).alias("collapsed_sha256"),
    )


def negative_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three hard negatives for each of the five nearest rows of its label of every fiftieth vector, with one
    label in seven wrong."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = table(spark, sf_dir, "embeddings").where(finite).select(
        "vec_id", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label"),
        F.transform("embedding", lambda x: F.floor(256 * x.cast("double"))).alias("embedding"))
    return settle(lambda: hard_negatives(rows, F.col("vec_id") % 50 == 0))


def archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as archives and read back."""
    path = scratch_path(spark, "archives")
    write_archives(table(spark, sf_dir, "pages"), path)
    return page_records(durable(read_archives(spark, path).drop("payload"))).drop("url")


QUERIES: dict[str, Query] = {
    "op1_near_vectors": near_vectors,
    "op2_packing": packing,
    "op3_nearest": nearest,
    "op4_chat": chat,
    "op5_html": html,
    "op6_personal_data": personal_data,
    "op7_language": language,
    "op8_near_duplicates": near_duplicate_documents,
    "op9_sentencepiece": sentencepiece,
    "op10_toxicity": toxicity,
    "op11_runs": runs,
    "op12_negatives": negative_vectors,
    "op13_archives": archives,
}

_VECTORS = """
WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
good AS (SELECT * FROM v WHERE e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b
  ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.9),
reach AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
c AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
n AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT v.vec_id, coalesce(n.n, 0) AS n_links, component_id, v.vec_id = component_id AS kept
FROM v JOIN c ON c.a = v.vec_id LEFT JOIN n ON n.a = v.vec_id"""

_CHAT = rf"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '{CONFLICT}'), (-7, 1, 'assistant', '{CONFLICT}')),
f AS (SELECT *, CASE role WHEN 'user' THEN 15 WHEN 'system' THEN 15 WHEN 'assistant' THEN 7 ELSE 14 + length(role) END
  + length(text) + CASE WHEN role = 'user' AND contains(text, ' [/INST]') OR role = 'assistant' AND contains(text, '</s>')
    OR role = 'system' AND contains(text, '<</SYS>>')
  THEN len(regexp_extract_all(text, '[\[<|]\\*(?:/?INST\]|</?SYS>>|/?s>|\||end\|>)')) ELSE 0 END AS size FROM t)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(size) AS BIGINT) AS formatted_chars
FROM f GROUP BY conv_id"""

_NEAR_DUPLICATES = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}_]+') AS w FROM documents),
s AS (SELECT doc_id, array_to_string(w[i:i + 4], ' ') AS g FROM w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS u(i)
  WHERE len(w) > 0),
c AS (SELECT doc_id, g, row_number() OVER (PARTITION BY doc_id, g) AS k FROM s),
n AS (SELECT doc_id, count(*) AS n FROM c GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS m FROM c a JOIN c b
  ON a.g = b.g AND a.k = b.k AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE m >= 0.8 * (x.n + y.n - m)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT a AS doc_id, min(b) AS class_id, a = min(b) AS kept FROM reach GROUP BY a"""

_CRC = """list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(doc_id::VARCHAR, ''),
  lambda c: list_concat([ascii(c)::BIGINT], [-1::BIGINT, -1, -1, -1, -1, -1, -1, -1])))),
  lambda h, b: CASE WHEN b >= 0 THEN xor(h, b) ELSE xor(h >> 1, 3988292384 * (h & 1)) END)"""

_RUNS = rf"""
WITH t AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
  xor({_CRC}, 4294967295) AS h FROM documents),
a AS (SELECT *, len(w) AS n, (h // 10) % greatest(len(w), 1) AS a, 3 + (h // 10) % 8 AS d FROM t),
d AS (SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN
  list_transform(range(n), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // d) END]) ELSE w END AS w FROM a),
g AS (SELECT doc_id, i, array_to_string(w[i + 1:i + 5], ' ') AS g FROM d, unnest(range(n - 4)) AS u(i)),
s AS (SELECT x.doc_id, x.i, y.i - x.i AS q FROM g x JOIN g y ON x.doc_id = y.doc_id AND x.g = y.g AND x.i < y.i),
i AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS k FROM s),
c AS (SELECT doc_id, q, min(i) AS b, max(i) + 5 + q - min(i) AS len FROM i GROUP BY doc_id, q, k
  HAVING max(i) + 5 + q - min(i) >= greatest(6, 4 * q)),
r AS (SELECT * FROM c WHERE NOT EXISTS (SELECT 1 FROM c o WHERE o.doc_id = c.doc_id AND o.q < c.q
  AND o.b <= c.b AND o.b + o.len >= c.b + c.len)),
l AS (SELECT doc_id, count(*) AS n_runs, arg_max(struct_pack(s := b, l := len, p := q), row(len, -b, -q)) AS best,
  string_agg(b || ',' || len || ',' || q || chr(10), '' ORDER BY b, q) AS listed FROM r GROUP BY doc_id),
x AS (SELECT DISTINCT doc_id, unnest(range(b + q, b + len)) AS i FROM r),
k AS (SELECT p.doc_id, string_agg(p.word, ' ' ORDER BY p.i) AS kept
  FROM (SELECT doc_id, i, w[i + 1] AS word FROM d, unnest(range(n)) AS u(i)) p ANTI JOIN x USING (doc_id, i) GROUP BY p.doc_id)
SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, best.s AS start, best.l AS length, best.p AS period,
  1000 * best.l // best.p AS exponent_milli, sha256(coalesce(listed, '')) AS runs_sha256,
  sha256(coalesce(kept, '')) AS collapsed_sha256
FROM d LEFT JOIN l ON l.doc_id = d.doc_id LEFT JOIN k ON k.doc_id = d.doc_id"""

_NEGATIVES = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
  list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS a, b.vec_id AS b, a.label = b.label AS same, list_dot_product(a.e, b.e)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, b) <= 5)
SELECT p.a AS anchor_id, p.b AS positive_id,
  CAST(row_number() OVER (PARTITION BY p.a, p.b ORDER BY n.score DESC, n.b) AS INTEGER) AS rank,
  n.b AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM p JOIN s n ON n.a = p.a AND NOT n.same AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
QUALIFY rank <= 3"""

_ARCHIVES = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS size FROM pages),
f AS (SELECT html AS h, min(page_id) AS first FROM p WHERE size >= 100 GROUP BY html)
SELECT page_id, size AS payload_bytes, sha256(html) AS payload_digest,
  CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first <> page_id THEN first END AS refers_to
FROM p LEFT JOIN f ON f.h = p.html"""

# the others have no SQL form: tokenizers, trees, fitted models; the tests compare them with libraries,
# brute force and held-out rows
ORACLES: dict[str, str] = {
    "op1_near_vectors": _VECTORS,
    "op4_chat": _CHAT,
    "op8_near_duplicates": _NEAR_DUPLICATES,
    "op11_runs": _RUNS,
    "op12_negatives": _NEGATIVES,
    "op13_archives": _ARCHIVES,
}
