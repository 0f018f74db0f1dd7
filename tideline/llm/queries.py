"""The registered queries of the operators, each over its whole table, with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm import (
    centroids, chains, chat, decontaminate, fingerprints, line_runs, main_text, merkle, packing, simhash, sparse_suffixes, token_files, toxicity,
)
from tideline.llm.rows import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def tokenizer_file(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return register


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


@query("op1_toxicity")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.learn(docs, labels.where(~held_out(F.col("doc_id"))))
    return toxicity.score_documents(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


@query("op2_substring_dedup")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chains.fuzzy_passages(table(spark, sf_dir, "documents"))


@query("op3_main_text")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.extract_main_text(table(spark, sf_dir, "pages"))


@query("op4_benchmark_decontamination")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op5_suffix_array_dedup")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sparse_suffixes.repeated_passages(table(spark, sf_dir, "documents"))


@query("op6_simhash_near_dedup")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def line_dedup_sql(documents: str = "documents", least_words: int = line_runs.LEAST_WORDS) -> str:
    """Every run of any number of lines with enough words that occurs at an earlier place is deleted: runs grow by a
    line at a time while they are shared."""
    return f"""
WITH RECURSIVE l AS (
  SELECT doc_id, unnest(range(len(ls))) AS line, unnest(ls) AS content FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM {documents})
),
p AS MATERIALIZED (
  SELECT doc_id, line, content, row_number() OVER (ORDER BY doc_id, line) AS place, dense_rank() OVER (ORDER BY content) AS id,
    len(regexp_extract_all(content, '[^\\s]+')) AS words FROM l
),
r AS (
  SELECT 1 AS k, doc_id, line, place, first, words FROM (SELECT *, min(place) OVER w AS first, count(*) OVER w AS n FROM p WINDOW w AS (PARTITION BY id)) WHERE n > 1
  UNION ALL
  SELECT k, doc_id, line, place, first, words FROM (
    SELECT r.k + 1 AS k, r.doc_id, r.line, r.place, r.words + p.words AS words, min(r.place) OVER w AS first, count(*) OVER w AS n
    FROM r JOIN p ON p.doc_id = r.doc_id AND p.line = r.line + r.k WINDOW w AS (PARTITION BY r.first, p.id)
  ) WHERE n > 1
),
g AS (SELECT DISTINCT doc_id, line + unnest(range(k)) AS line FROM (SELECT doc_id, line, max(k) AS k FROM r WHERE place > first AND words >= {least_words} GROUP BY doc_id, line)),
k AS (
  SELECT p.doc_id, count(*) AS n_lines, count(g.line) AS n_deleted,
    coalesce(string_agg(p.content, chr(10) ORDER BY p.line) FILTER (g.line IS NULL), '') AS text
  FROM p LEFT JOIN g ON p.doc_id = g.doc_id AND p.line = g.line GROUP BY p.doc_id
)
SELECT doc_id, CAST(n_lines AS INTEGER) AS n_lines, CAST(n_deleted AS INTEGER) AS n_deleted, text FROM k"""


@query("op7_line_dedup", line_dedup_sql())
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    deduped = line_runs.dedupe_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return deduped.select("doc_id", "n_lines", "n_deleted", F.col("kept").alias("text"))


# Escaped as the template does, plus what it writes around a turn: '<|', '|>\n' and '<|end|>\n'.
_FORMATTED = "sum(length(replace(replace(replace({0}, '&', '&amp;'), '<', '&lt;'), '[', '&#91;')))"
_CHAT_SQL = f"""
WITH m AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST({_FORMATTED.format("role")} + {_FORMATTED.format("text")} + 13 * count(*) AS BIGINT) AS formatted_chars
FROM m GROUP BY conv_id
"""


@query("op8_chat_formatting", _CHAT_SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = spark.sql(
        "SELECT -7L AS conv_id, turn, role, '</s>[INST] ok [/INST]' AS text FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(turn, role)"
    )
    messages = rows.unionByName(control).withColumn("content", chat.text_part(F.col("text")))
    done = chat.format_conversations(messages).select(
        "conv_id", "formatted", chat.read_turns(F.col("formatted")).alias("turns"), chat.read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss")
    )
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return done.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


@query("op9_document_fingerprints")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_edits(table(spark, sf_dir, "documents"))


@query("op10_best_fit_packing")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_file())


def _round_sql(i: int) -> str:
    """Assignment to centroids c{i} and the centroids c{i + 1} of their vectors, all in integers."""
    return f"""
d{i} AS (SELECT rid, j, list_sum(list_transform(list_zip(x, c), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS s FROM kept, c{i}),
a{i} AS (SELECT rid, arg_min(j, s * 1000 + j) AS j, min(s) AS s FROM d{i} GROUP BY rid),
m{i} AS (
  SELECT j, list(v ORDER BY p) AS c FROM (
    SELECT j, p, (sum(v) - (((sum(v) % count(*)) + count(*)) % count(*))) // count(*) AS v
    FROM (SELECT j, unnest(x) AS v, unnest(range(64)) AS p FROM a{i} JOIN kept USING (rid)) GROUP BY j, p) GROUP BY j
),
c{i + 1} AS (SELECT j, CAST(coalesce(m{i}.c, c{i}.c) AS BIGINT[]) AS c FROM c{i} LEFT JOIN m{i} USING (j))"""


_CENTROIDS_SQL = f"""
WITH kept AS (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda v: CAST(floor(64 * CAST(v AS DOUBLE)) AS BIGINT)) AS x
  FROM (SELECT * FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0)
),
c0 AS (
  SELECT j, x AS c FROM (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id), x) - 1 AS j, x FROM kept) WHERE j < 16
),
{_round_sql(0)}, {_round_sql(1)}, {_round_sql(2)}, {_round_sql(3)}
SELECT vec_id, CAST(j AS INTEGER) AS cluster, CAST(s AS BIGINT) AS distance, CAST(sum(s) OVER (PARTITION BY j) AS BIGINT) AS cluster_inertia,
  CAST(sum(s) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a3 JOIN kept USING (rid) JOIN c3 USING (j)
"""


@query("op11_centroid_clustering", _CENTROIDS_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster_vectors(table(spark, sf_dir, "embeddings"))


def _encoded_sql(column: str) -> str:
    return f"coalesce(strlen(CAST({column} AS VARCHAR)) || ':' || CAST({column} AS VARCHAR), '-')"


def _level_sql(i: int) -> str:
    """Nodes of level i + 1, and for those of level i the other nodes of their run; a lone node stays as it is."""
    return f"""
r{i} AS (
  SELECT grp, rank // 8 AS run, list(digest ORDER BY rank) AS ds, max(many) AS many FROM (
    SELECT *, count(*) OVER (PARTITION BY grp) > 1 AS many FROM n{i}) GROUP BY grp, run
),
n{i + 1} AS (SELECT grp, run AS rank, CASE WHEN many THEN sha256(array_to_string(ds, '')) ELSE ds[1] END AS digest FROM r{i})"""


def _path_sql(prefix: str, i: int) -> str:
    """One step of the way up: siblings to the proof, the node folded with them."""
    return f"""
{prefix}{i + 1} AS (
  SELECT {prefix}{i}.* EXCLUDE (proof, folded, rank), rank // 8 AS rank,
    CASE WHEN many THEN proof || array_to_string(list_concat(ds[: rank % 8], ds[rank % 8 + 2 :]), '') ELSE proof END AS proof,
    CASE WHEN many THEN sha256(array_to_string(ds[: rank % 8], '') || folded || array_to_string(ds[rank % 8 + 2 :], '')) ELSE folded END AS folded
  FROM {prefix}{i} JOIN r{i} ON {prefix}{i}.grp = r{i}.grp AND {prefix}{i}.rank // 8 = r{i}.run
)"""


_LEVELS = 8  # 8 ** 8 leaves of a group
_LEAF = "||".join(_encoded_sql(c) for c in merkle.COLUMNS)
_CHANGED = "||".join(_encoded_sql(c if c != "text" else "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')") for c in merkle.COLUMNS)
# crc32 bit by bit: the list is the start value, then the bits of the text, lowest of each byte first.
_CRC = """xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
  lambda ch: list_transform(range(8), lambda b: CAST((ord(ch) >> b) & 1 AS BIGINT))))),
  lambda c, b: xor(c >> 1, 3988292384::BIGINT * (xor(c, b) & 1))), 4294967295::BIGINT)"""

_MERKLE_SQL = f"""
WITH l AS (
  SELECT doc_id, coalesce('v' || lang, '-') AS grp, sha256({_LEAF}) AS digest,
    CASE WHEN doc_id IS NOT NULL AND {_CRC} % 3 = 0 THEN sha256({_CHANGED}) END AS tampered FROM documents
),
o AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, digest) - 1 AS rank FROM l),
n0 AS (SELECT grp, rank, digest FROM o),
{", ".join(_level_sql(i) for i in range(_LEVELS))},
p0 AS (SELECT doc_id, digest AS leaf, grp, rank, '' AS proof, coalesce(tampered, digest) AS folded FROM o),
{", ".join(_path_sql("p", i) for i in range(_LEVELS))},
n100 AS (SELECT '' AS grp, row_number() OVER (ORDER BY grp) - 1 AS rank, digest, grp AS name FROM n{_LEVELS}),
{", ".join(_level_sql(i) for i in range(100, 103))},
p100 AS (
  SELECT doc_id, leaf, n100.digest AS subroot, n100.grp AS grp, n100.rank AS rank, proof, folded FROM p{_LEVELS} JOIN n100 ON p{_LEVELS}.grp = n100.name
),
{", ".join(_path_sql("p", i) for i in range(100, 103))}
SELECT doc_id, leaf, subroot, n103.digest AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = n103.digest AS verified
FROM p103, n103
"""


@query("op12_merkle_manifest", _MERKLE_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(table(spark, sf_dir, "documents"))


@query("op13_token_files")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = token_files.written_and_read(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))
    return read.select("doc_id", "start", "n_tokens", "ids_crc32")
