"""The registered queries of the subpackage and the SQL they must agree with."""

from __future__ import annotations

import secrets
from functools import cache

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newstide.llm import (
    bpe,
    edits,
    languages,
    licences,
    merkle,
    packing,
    pseudo_likelihood,
    quality,
    segment_bpe,
    simhash,
    surrogates,
    variants,
    vectors,
)
from newstide.llm.common import fold, table, written

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
BYTE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def op1_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_digest(table(spark, sf_dir, "documents"))


def packed_digest(docs: DataFrame) -> DataFrame:
    """Pieces and places, with a checksum of the ids made before anything is shuffled."""
    pieces = written(packing.tokenized(docs, WORD_BPE), "pieces")
    narrow = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    placed = packing.placed(pieces, narrow)
    return placed.select(
        "doc_id", "piece", "start", F.col("length").cast("long"), "ids_crc32", "sequence_id", "offset"
    )


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), BYTE_BPE), BYTE_BPE)
    return found.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op7_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    # words are found once, for counting, training and scoring
    docs = written(pseudo_likelihood.worded(table(spark, sf_dir, "documents")), "words")
    return pseudo_likelihood.score(docs, pseudo_likelihood.learn(docs))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", F.coalesce(fold(F.col("doc_id"), 4) == 2, F.lit(False)))
    filters = languages.learn(docs, ~F.col("held_out"))
    return languages.predict(docs, filters, "doc_id", "held_out").select("doc_id", "held_out", "lang_pred", "score")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(fold(F.col("doc_id"), 3) == 1, F.lit(False))
    docs = table(spark, sf_dir, "documents").withColumn("held_out", held_out)
    machine = quality.learn(docs, table(spark, sf_dir, "labels"), ~held_out)
    scored = quality.score(docs, machine, "doc_id", "held_out")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op9_edit_prints(spark: SparkSession, sf_dir: str) -> DataFrame:
    stretches = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = edits.followed(table(spark, sf_dir, "documents"), stretches)
    half = F.floor(F.length("text") / 2).cast("int")
    kept, put = F.substr("text", F.lit(1), F.length("text") - half), F.substr("next_text", F.lit(1), half)
    docs = docs.withColumn("n_chars", F.length("text").cast("long")).withColumn("edited", F.concat(kept, put))
    docs = docs.withColumn("edited_sha256", F.sha2(F.col("edited").cast("binary"), 256))
    prints = edits.fingerprints(
        docs,
        {"fingerprint": "text", "edited_fingerprint": "edited", "next_fingerprint": "next_text"},
        {"near_edited": ("fingerprint", "edited_fingerprint"), "near_next": ("fingerprint", "next_fingerprint")},
        "doc_id", "n_chars", "edited_sha256",
    )
    prints = written(prints.drop("next_fingerprint"), "prints")
    return prints.join(edits.near_groups(prints.select("doc_id", "fingerprint")), "fingerprint")


def op5_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(table(spark, sf_dir, "embeddings"))


def surrogate_key(spark: SparkSession) -> bytes:
    """The key of stand-ins, a secret of the session; a key for trials is taken on a single machine only."""
    key = spark.conf.get("newstide.surrogate.key", None)
    if key is None and not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set newstide.surrogate.key: with a key that everybody knows, stand-ins could be traced back")
    return (key or "for trials only").encode()


@cache
def _key_of(application: str) -> bytes:
    """A random key that leaves the application only with the tasks that use it."""
    return secrets.token_bytes(32)


def run_key(spark: SparkSession) -> bytes:
    """The session's key; without one, a cluster's application makes its own, which nobody knows and no other run repeats."""
    try:
        return surrogate_key(spark)
    except ValueError:
        return _key_of(spark.sparkContext.applicationId)


def op2_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = surrogates.surrogates(table(spark, sf_dir, "documents"), run_key(spark))
    entities = F.coalesce(F.size("_spans"), F.lit(0)).alias("n_entities")
    return found.select("doc_id", "text", entities, F.col("_spans").alias("entities"))


def op11_segment_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = BYTE_RANKS, public_tokenizers.PATTERN
    found = segment_bpe.decode(segment_bpe.encode(table(spark, sf_dir, "documents"), *split), *split)
    return found.select(
        "doc_id",
        "n_tokens",
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op12_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.variants(table(spark, sf_dir, "documents"))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    altered = F.when(tampered, F.translate("text", "\n", "")).otherwise(F.col("text"))
    row = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    docs = docs.withColumn("altered", merkle.leaf(*row, altered))
    found = merkle.manifest(docs, F.col("source"), merkle.leaf(*row, F.col("text")), ["doc_id"], ["altered"])
    found = found.withColumn("folded_root", merkle.folded(F.col("altered"), F.col("path")))
    return found.select(
        "doc_id", "leaf", "subroot", "root",
        F.sha2(merkle.proof(F.col("path")).cast("binary"), 256).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"),
    )


QUERIES = {
    "op1_licences": op1_licences,
    "op2_surrogates": op2_surrogates,
    "op3_packing": op3_packing,
    "op4_simhash": op4_simhash,
    "op5_vectors": op5_vectors,
    "op6_bpe": op6_bpe,
    "op7_pseudo_likelihood": op7_pseudo_likelihood,
    "op8_language": op8_language,
    "op9_edit_prints": op9_edit_prints,
    "op10_quality": op10_quality,
    "op11_segment_bpe": op11_segment_bpe,
    "op12_variants": op12_variants,
    "op13_merkle": op13_merkle,
}

#: every pair of equally labelled vectors, and the links followed from each vector
VECTORS_SQL = """
WITH RECURSIVE
given AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
usable AS (
    SELECT vec_id, label, e FROM given
    WHERE label IS NOT NULL AND e IS NOT NULL
      AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND list_dot_product(e, e) > 0
),
links AS (
    SELECT a.vec_id AS x, b.vec_id AS y
    FROM usable a JOIN usable b ON a.label = b.label AND a.vec_id <> b.vec_id
    WHERE list_cosine_similarity(a.e, b.e) >= 0.98
),
reached AS (
    SELECT x, x AS y FROM links
    UNION
    SELECT reached.x, links.y FROM reached JOIN links ON reached.y = links.x
),
parts AS (SELECT x, min(y) AS component FROM reached GROUP BY x),
counts AS (SELECT x, count(*) AS n FROM links GROUP BY x)
SELECT vec_id,
       coalesce(n, 0)::BIGINT AS n_links,
       coalesce(component, vec_id)::BIGINT AS component_id,
       vec_id = coalesce(component, vec_id) AS kept
FROM given LEFT JOIN parts ON vec_id = parts.x LEFT JOIN counts ON vec_id = counts.x
"""

#: the crc32 of a text, from a table of the remainders of single bytes; both are scalar subqueries
CRC_TABLE = """
crc AS (
    SELECT list_transform(range(256), lambda b: list_reduce(
        [b, 0, 0, 0, 0, 0, 0, 0, 0],
        lambda c, unused: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS remainder
)"""
CRC = """
xor(4294967295, list_reduce(
    list_prepend(4294967295, list_transform(
        range(octet_length(encode({text}))),
        lambda i: ('0x' || substr(hex(encode({text})), 2 * i + 1, 2))::BIGINT)),
    lambda c, b: xor(c >> 8, crc.remainder[(xor(c, b) & 255) + 1])))"""

#: words near each other share a text with one place left open, or one is the other without a letter
VARIANTS_SQL = f"""
WITH RECURSIVE {CRC_TABLE},
runs AS (
    SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\u00c0-\u00ff]+')) AS run FROM documents
),
lowered AS (
    SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
    FROM runs WHERE length(run) >= 6 GROUP BY ALL
),
hashed AS (
    SELECT run, n, {CRC.format(text="(coalesce(doc_id::VARCHAR, '') || ':' || run)")} AS h FROM lowered, crc
),
results AS (
    SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2)
                ELSE run END AS word, n
    FROM hashed
),
words AS (
    SELECT word, sum(n)::BIGINT AS n FROM results WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5
),
places AS (
    SELECT word, n, i, substr(word, 1, i - 1) AS head, substr(word, i + 1) AS tail
    FROM words, lateral (SELECT unnest(range(1, length(word) + 1)) AS i)
),
shorter AS (
    SELECT DISTINCT p.word AS a, p.n AS n_a, w.word AS b, w.n AS n_b FROM places p JOIN words w ON w.word = p.head || p.tail
),
near AS (
    SELECT p.word AS a, q.word AS b, q.n AS n_b
    FROM places p JOIN places q ON p.i = q.i AND p.head = q.head AND p.tail = q.tail AND p.word <> q.word
    UNION ALL SELECT a, b, n_b FROM shorter
    UNION ALL SELECT b, a, n_a FROM shorter
),
best AS (
    SELECT a AS word, count(*) AS n_near, min(struct_pack(r := -n_b, b := b)) AS top FROM near GROUP BY a
),
forms AS (
    SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near,
           CASE WHEN -top.r >= 5 * n THEN top.b END AS form, CASE WHEN -top.r >= 5 * n THEN -top.r END AS form_n
    FROM words w LEFT JOIN best USING (word)
),
chain AS (
    SELECT word, word AS root, form AS onward FROM forms
    UNION ALL
    SELECT chain.word, forms.word, forms.form FROM chain JOIN forms ON forms.word = chain.onward
)
SELECT forms.word, n, n_near, form, form_n::BIGINT AS form_n, root
FROM forms JOIN chain ON chain.word = forms.word AND chain.onward IS NULL
"""

#: both trees level by level; a node's siblings are those with its parent, and folding climbs once more
MERKLE_SQL = f"""
WITH RECURSIVE {CRC_TABLE},
given AS (
    SELECT row_number() OVER () AS r, doc_id, source, text,
           list_transform([doc_id::VARCHAR, source, lang, n_chars::VARCHAR],
                          lambda v: coalesce(octet_length(encode(v)) || ':' || v, '-')).list_aggregate('string_agg', '') AS head,
           {CRC.format(text="doc_id::VARCHAR")} AS h
    FROM documents, crc
),
texts AS (
    SELECT *, CASE WHEN h % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS altered FROM given
),
leaves AS (
    SELECT r, doc_id, source,
           sha256(head || coalesce(octet_length(encode(text)) || ':' || text, '-')) AS leaf,
           sha256(head || coalesce(octet_length(encode(altered)) || ':' || altered, '-')) AS altered
    FROM texts
),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
           count(*) OVER (PARTITION BY source) AS n
    FROM leaves
),
nodes AS (
    SELECT source, 0 AS level, pos::BIGINT AS pos, n::BIGINT AS n, leaf AS hash FROM placed
    UNION ALL
    SELECT source, any_value(level) + 1, (pos // 3)::BIGINT, any_value((n + 2) // 3)::BIGINT,
           sha256(string_agg(hash, '' ORDER BY pos))
    FROM nodes WHERE n > 1 GROUP BY source, pos // 3
),
tops AS (
    SELECT source, level AS height, hash,
           row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS n
    FROM nodes WHERE n = 1
),
upper AS (
    SELECT 0 AS level, pos::BIGINT AS pos, n::BIGINT AS n, hash FROM tops
    UNION ALL
    SELECT any_value(level) + 1, (pos // 3)::BIGINT, any_value((n + 2) // 3)::BIGINT, sha256(string_agg(hash, '' ORDER BY pos))
    FROM upper WHERE n > 1 GROUP BY pos // 3
),
levels AS (
    SELECT p.r, s.level, coalesce(string_agg(o.hash, '' ORDER BY o.pos) FILTER (o.pos < p.pos // (3 ** s.level)::BIGINT), '') AS l,
           coalesce(string_agg(o.hash, '' ORDER BY o.pos) FILTER (o.pos > p.pos // (3 ** s.level)::BIGINT), '') AS r_
    FROM placed p
    JOIN (SELECT DISTINCT source, level, n FROM nodes WHERE n > 1) s ON s.source IS NOT DISTINCT FROM p.source
    JOIN nodes o ON o.source IS NOT DISTINCT FROM p.source AND o.level = s.level
        AND o.pos // 3 = p.pos // (3 ** (s.level + 1))::BIGINT
    GROUP BY p.r, s.level
    UNION ALL
    SELECT p.r, t.height + s.level, coalesce(string_agg(o.hash, '' ORDER BY o.pos) FILTER (o.pos < t.pos // (3 ** s.level)::BIGINT), ''),
           coalesce(string_agg(o.hash, '' ORDER BY o.pos) FILTER (o.pos > t.pos // (3 ** s.level)::BIGINT), '')
    FROM placed p JOIN tops t ON t.source IS NOT DISTINCT FROM p.source
    JOIN (SELECT DISTINCT level FROM upper WHERE n > 1) s ON true
    JOIN upper o ON o.level = s.level AND o.pos // 3 = t.pos // (3 ** (s.level + 1))::BIGINT
    GROUP BY p.r, t.height, s.level
),
climbed AS (
    SELECT r, 0 AS level, altered AS hash FROM leaves
    UNION ALL
    SELECT c.r, c.level + 1, sha256(l || hash || r_) FROM climbed c JOIN levels USING (r, level)
),
ends AS (SELECT r, max_by(hash, level) AS folded_root FROM climbed GROUP BY r),
proofs AS (SELECT r, string_agg(l || r_, '' ORDER BY level) AS proof FROM levels GROUP BY r)
SELECT p.doc_id, p.leaf, t.hash AS subroot, u.hash AS root, sha256(coalesce(proof, '')) AS proof_sha256,
       folded_root, folded_root = u.hash AS verified
FROM placed p JOIN tops t ON t.source IS NOT DISTINCT FROM p.source
JOIN (SELECT hash FROM upper WHERE n = 1) u ON true
JOIN ends USING (r) LEFT JOIN proofs USING (r)
"""

ORACLES: dict[str, str] = {"op5_vectors": VECTORS_SQL, "op12_variants": VARIANTS_SQL, "op13_merkle": MERKLE_SQL}
