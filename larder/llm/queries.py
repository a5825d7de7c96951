"""One query per operator over its whole table, with production parameters, and their SQL."""

from __future__ import annotations

import string
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm import (byte_bpe, chat, hash_forest, hyper_language, merkle, radix, shards, simhash,
                        substring, templates, token_counts, token_orc, whitening)
from larder.llm.common import reachable, shared_path, stored


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reachable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_hash_prefix_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = hash_forest.neighbours(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op2_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return templates.matches(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    extra = spark.sql(r"""SELECT * FROM VALUES
        (-7L, 0L, 'user', '\\### Assistant: </turn> ok'),
        (-7L, 1L, 'assistant', '\\### Assistant: </turn> ok') AS t(conv_id, turn, role, text)""")
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    made = chat.documents(chat.segments(rows.unionByName(extra)))
    return chat.digest(chat.read_back(made))


def op4_orc_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "token-orc")
    token_orc.write(token_orc.encoded(_table(spark, sf_dir, "documents"),
                                      public_tokenizers.path("word_bpe_49k.json")), path)
    return token_orc.read(spark, path).select(
        "doc_id", "start", F.size("ids").cast("long").alias("n_tokens"),
        token_orc.crc32("ids").alias("ids_crc32"))


def op5_simhash_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.groups(_table(spark, sf_dir, "documents"), width=3,
                           blocks=simhash.Blocks(distance=2))
    return found.select("doc_id", F.lower(F.lpad(F.hex(F.col("fp")[0]), 16, "0")).alias("fingerprint"),
                        "component_id")


def op6_hyperdimensional_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").withColumn(
        "held_out", F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1,
                               F.lit(False)))
    model = hyper_language.fit(docs.filter(~F.col("held_out")))
    said = docs.select("doc_id", "held_out", hyper_language.predict(F.col("text"), model).alias("p"))
    return said.select("doc_id", "held_out", "p.lang_pred", "p.score")


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    ids = _table(spark, sf_dir, "documents").select(
        "doc_id", byte_bpe.encode(F.col("text"), ranks, pattern).alias("ids"))
    both = ids.select("doc_id", "ids", byte_bpe.decode(F.col("ids"), ranks, pattern).alias("bytes"))
    return both.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"))


def op8_relative_lempel_ziv(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = substring.deduplicated(_table(spark, sf_dir, "documents"), window=50)
    return made.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = token_counts.counts(_table(spark, sf_dir, "documents"),
                               public_tokenizers.path("byte_bpe_50k.json"))
    return made.select("doc_id", "n_bytes", "n_tokens",
                       (F.col("n_tokens") > 1024).alias("over_limit"))


def op10_sampled_splitters(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = shards.shards(_table(spark, sf_dir, "documents"), 8)
    return made.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                       F.lit(None).cast("int").alias("grown_shard"))


def op11_lanczos_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = whitening.whitened(_table(spark, sf_dir, "embeddings"), 16)
    return made.withColumn("deviation", F.col("deviation").cast("long"))


def op12_radix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return radix.classes(_table(spark, sf_dir, "documents"),
                         outputs={"text_sha256": F.sha2("body", 256)})


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    low = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    changed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    claimed = F.when(changed, merkle.record([low if c == "text" else F.col(c) for c in fields])
                     ).otherwise(merkle.record([F.col(c) for c in fields]))
    made = merkle.manifest(_table(spark, sf_dir, "documents"), fields, carry={"claimed": claimed})
    made = made.withColumn("folded_root", merkle.folded(F.col("claimed"), F.col("proof")))
    return made.select(
        "doc_id", "leaf", "subroot", "root",
        F.sha2(F.array_join("proof.siblings", ""), 256).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_hash_prefix_forest, op2_template_decontamination, op3_chat_format, op4_orc_tokens,
        op5_simhash_blocks, op6_hyperdimensional_language, op7_byte_bpe, op8_relative_lempel_ziv,
        op9_token_counts, op10_sampled_splitters, op11_lanczos_whitening, op12_radix_dedup,
        op13_merkle_manifest, pipeline)}

#: Control strings and the escape sign itself get a sign each; marks are "### role: " and " </turn>\n".
_CHAT_SQL = r"""
WITH t AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
    FROM conversations
    UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'),
                     (-7, 1, 'assistant', '\### Assistant: </turn> ok')),
s AS (
    SELECT *, lag(role, 1, '') OVER w AS state, lead(role) OVER w IS NULL AS is_last
    FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text))
           AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text)
                       FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(15 + length(regexp_replace(role, '(\\|###|</turn>)', '\\\1', 'g'))
                + length(regexp_replace(text, '(\\|###|</turn>)', '\\\1', 'g'))) AS BIGINT)
           AS formatted_chars,
       bool_and(CASE state WHEN '' THEN role IN ('system', 'user')
                           WHEN 'system' THEN role = 'user'
                           WHEN 'user' THEN role = 'assistant'
                           WHEN 'assistant' THEN role = 'user' ELSE FALSE END
                AND (NOT is_last OR role = 'assistant')) AS valid
FROM s GROUP BY conv_id
"""

_RADIX_SQL = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body
           FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY body) AS group_size,
       row_number() OVER w = 1 AS kept, sha256(body) AS text_sha256
FROM t WINDOW w AS (PARTITION BY body ORDER BY doc_id NULLS LAST)
"""


def _tree_sql(name: str, levels: int) -> str:
    """Levels of the trees in ``{name}0`` (tree, pos, size, d) and each leaf's way up."""
    parts = []
    for k in range(levels):
        parts.append(f"""{name}r{k} AS (
            SELECT *, coalesce(string_agg(d, '' ORDER BY pos) OVER (PARTITION BY tree, pos // 8
                       ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
                   coalesce(string_agg(d, '' ORDER BY pos) OVER (PARTITION BY tree, pos // 8
                       ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
            FROM {name}{k}),
        {name}{k + 1} AS (
            SELECT tree, pos // 8 AS pos, (max(size) + 7) // 8 AS size,
                   CASE WHEN max(size) = 1 THEN min(d) ELSE sha256(string_agg(d, '' ORDER BY pos)) END AS d
            FROM {name}{k} GROUP BY tree, pos // 8)""")
    return ",\n".join(parts)


def _climb_sql(source: str, name: str, levels: int, key: str) -> str:
    """``source`` (tree, pos, fold, proof) followed up to the root, level by level."""
    now = source
    for k in range(levels):
        now = f"""(SELECT c.* EXCLUDE (fold, proof), c.proof || x.l || x.r AS proof,
            CASE WHEN x.size = 1 THEN c.fold ELSE sha256(x.l || c.fold || x.r) END AS fold
            FROM {now} c JOIN {name}r{k} x ON x.tree IS NOT DISTINCT FROM c.{key}
            AND x.pos = c.pos // {8 ** k})"""
    return now


_LEAF = """sha256(coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-')
    || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-')
    || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-')
    || coalesce(strlen({0}) || ':' || {0}, '-'))"""
_LOW = f"translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"


def _merkle_sql(crc: str, levels: int = 9) -> str:
    """Trees of up to 8 ** ``levels`` leaves; ``crc`` is the document id's crc32."""
    return f"""
WITH crc AS (SELECT list(v ORDER BY i) AS crcs FROM (SELECT i, list_reduce(
    [CAST(i AS BIGINT), 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, z: xor(c >> 1, 3988292384 * (c & 1))) AS v FROM range(256) AS r(i))),
leaves AS (
    SELECT doc_id, lang, {_LEAF.format("text")} AS leaf,
           CASE WHEN {crc} % 3 = 0 THEN {_LEAF.format(_LOW)} ELSE {_LEAF.format("text")} END AS claimed
    FROM documents, crc),
t AS (SELECT *, lang AS tree, leaf AS d, count(*) OVER (PARTITION BY lang) AS size,
      row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM leaves),
a0 AS (SELECT tree, pos, size, d FROM t),
{_tree_sql("a", levels)},
b0 AS (SELECT 1 AS tree, row_number() OVER (ORDER BY tree NULLS FIRST) - 1 AS pos,
       count(*) OVER () AS size, d, tree AS name FROM a{levels}),
{_tree_sql("b", levels)},
low AS (SELECT *, proof AS p, fold AS f FROM {_climb_sql(
    "(SELECT *, claimed AS fold, '' AS proof FROM t)", "a", levels, "tree")}),
mid AS (SELECT low.doc_id, leaf, b0.d AS subroot, 1 AS one, b0.pos, f AS fold, p AS proof
        FROM low JOIN b0 ON b0.name IS NOT DISTINCT FROM low.lang),
top AS (SELECT * FROM {_climb_sql("mid", "b", levels, "one")})
SELECT doc_id, leaf, subroot, b{levels}.d AS root, sha256(proof) AS proof_sha256,
       fold AS folded_root, fold = b{levels}.d AS verified FROM top, b{levels}"""


#: crc32 of a decimal id; ``crcs`` is the 256-entry table of the fixed polynomial 0xEDB88320.
_CRC_SQL = """xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(
    string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
    lambda crc, b: xor(crc >> 8, crcs[xor(crc & 255, b) + 1])))"""

ORACLE = {"op3_chat_format": _CHAT_SQL, "op12_radix_dedup": _RADIX_SQL,
          "op13_merkle_manifest": _merkle_sql(_CRC_SQL)}
