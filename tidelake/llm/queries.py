"""The registered queries of the operators over the given tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidelake.llm import (
    bpe,
    chat,
    decontam,
    jaccard_join,
    langid,
    neighbours,
    packing,
    piece_counts,
    pii,
    prefix_trie,
    suffix_dedup,
    token_records,
    whitening,
)
from tidelake.llm.tables import table, written
from tidelake.session import new_folder


# Texts that hold control strings, as one more conversation.
_ESCAPE_CASE = """VALUES (-7L, 0L, 'user', '</s>[INST] ok [/INST]'), (-7L, 1L, 'assistant', '</s>[INST] ok [/INST]')
AS t(conv_id, turn, role, text)"""


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    case = spark.sql(f"SELECT * FROM {_ESCAPE_CASE}")
    done = chat.format_records(chat.records(rows.unionByName(case)))
    learned = chat.learned_text(F.col("formatted"), F.col("loss_spans"))
    back = done.select("conv_id", "formatted", learned.alias("learned"), chat.read_turns(F.col("formatted")).alias("back"))
    lines = F.transform("back", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return back.select(
        "conv_id",
        F.size("back").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


_OP1_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
), pieces AS (
  SELECT *, regexp_replace(role, '([<\[])(\\*)(/?s>|/?SYS>>|\||/?INST\])', '\1\\\2\3', 'g') AS role_out,
    regexp_replace(text, '([<\[])(\\*)(/?s>|/?SYS>>|\||/?INST\])', '\1\\\2\3', 'g') AS text_out
  FROM turns
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length('<|turn|>' || role_out || '<|text|>' || text_out || '<|end|>'))::BIGINT AS formatted_chars
FROM pieces GROUP BY conv_id
"""


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_SHINGLES_SQL = r"""
words AS (
  SELECT id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM texts
), shingles AS (
  SELECT DISTINCT id, unnest(CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS shingle FROM words
)"""

_OP3_SQL = f"""
WITH texts AS (
  SELECT {{'item': FALSE, 'key': doc_id}} AS id, text FROM documents
  UNION ALL SELECT {{'item': TRUE, 'key': item_id}}, text FROM benchmark
), {_SHINGLES_SQL},
sizes AS (SELECT id, count(*) AS n FROM shingles WHERE id.item GROUP BY id)
SELECT d.id.key AS doc_id, i.id.key AS item_id, n AS n_shingles, count(*) AS n_shared, count(*) / n AS containment
FROM shingles i JOIN sizes USING (id) JOIN shingles d ON d.shingle = i.shingle
WHERE i.id.item AND NOT d.id.item
GROUP BY d.id.key, i.id.key, n HAVING 100 * count(*) >= 80 * n
"""


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join(table(spark, sf_dir, "documents"))


_OP4_SQL = f"""
WITH RECURSIVE texts AS (SELECT doc_id AS id, text FROM documents), {_SHINGLES_SQL},
sizes AS (SELECT id, count(*) AS n FROM shingles GROUP BY id),
links AS (
  SELECT a.id AS a, b.id AS b FROM shingles a JOIN shingles b USING (shingle)
  JOIN sizes x ON x.id = a.id JOIN sizes y ON y.id = b.id
  WHERE a.id <> b.id GROUP BY a.id, b.id, x.n, y.n HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))
),
reached AS (SELECT id, id AS other FROM texts UNION SELECT r.id, l.b FROM reached r JOIN links l ON r.other = l.a)
SELECT r.id AS doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, min(other) AS component_id
FROM reached r LEFT JOIN sizes s ON s.id = r.id GROUP BY r.id
"""


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    digest = F.sha2("kept", 256).alias("kept_sha256")
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", digest, "n_passages", "n_passage_words")


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    back = bpe.round_trip(docs)
    return back.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_counts.count_tokens(table(spark, sf_dir, "documents"))


def op8_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = new_folder(spark, "records")
    token_records.write_records(table(spark, sf_dir, "documents"), target)
    token_records.write_index(spark, target)
    return token_records.read_index(spark, target).select("doc_id", "start", "n_tokens", "ids_crc32")


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.label(docs)

    def count(kind: str):
        return F.size(F.filter("base_spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *map(count, pii.BASE_KINDS),
        F.sha2(pii.as_text(F.col("base_spans")), 256).alias("base_sha256"),
        pii.as_text(F.col("pii")).alias("spans"),
    )


def op10_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = prefix_trie.numbered_turns(table(spark, sf_dir, "conversations"))
    return prefix_trie.trie(*prefix_trie.share_heads(written(turns, "trie-places")))


# Here the subtree of a node is what the paths to its smallest members pass through.
_OP11_SQL = r"""
WITH numbered AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT conv_id, count(*) AS n, conv_id - conv_id % 20 AS opens,
    xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(conv_id::VARCHAR, ''), lambda d: ascii(d)::BIGINT)),
      lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0],
        lambda x, z: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END)))) % 4 AS h
  FROM numbered GROUP BY conv_id
), known AS (
  SELECT c.conv_id, c.opens, c.h, least(c.h, coalesce(o.n, 0)) AS k FROM convs c LEFT JOIN convs o ON o.conv_id = c.opens
), turns AS (
  SELECT k.conv_id, place - h + k AS depth, role, text FROM numbered n JOIN known k USING (conv_id) WHERE place > h
  UNION ALL SELECT k.conv_id, place, role, text FROM numbered n JOIN known k ON n.conv_id = k.opens WHERE place <= k
), hashed AS (
  SELECT conv_id, depth, sha256(length(role) || ':' || role || text) AS turn,
    len(list_filter(string_split_regex(text, '[ 	-
]+'), lambda w: w <> '')) AS words
  FROM turns
), sequences AS (
  SELECT k.conv_id, list(turn ORDER BY depth) FILTER (turn IS NOT NULL) AS turns, list(words ORDER BY depth) FILTER (turn IS NOT NULL) AS words
  FROM known k LEFT JOIN hashed h USING (conv_id) GROUP BY k.conv_id
), prefixes AS (
  SELECT conv_id, depth, sha256(concat_ws(',', turns[1:depth])) AS key, CASE WHEN depth > 0 THEN words[depth] ELSE 0 END AS words,
    depth = coalesce(len(turns), 0) AS ends
  FROM sequences, unnest(range(0, coalesce(len(turns), 0) + 1)) AS t(depth)
), nodes AS (
  SELECT depth, CASE WHEN depth > 0 THEN key ELSE '' END AS key, min(conv_id) AS conv_id, count(*) AS n_convs, max(words) AS words,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM prefixes GROUP BY ALL
), paths AS (
  SELECT p.conv_id AS via, n.* FROM prefixes p
  JOIN nodes n ON n.depth = p.depth AND n.key = CASE WHEN p.depth > 0 THEN p.key ELSE '' END
), parents AS (
  SELECT n.depth, n.key, u.conv_id AS parent_conv_id FROM nodes n JOIN paths u ON u.via = n.conv_id AND u.depth = n.depth - 1
), children AS (
  SELECT depth - 1 AS depth, parent_conv_id AS conv_id, count(*) AS n_children FROM parents GROUP BY ALL
), sums AS (
  SELECT p.depth, p.conv_id, sum(((u.n_convs - 1) * u.words)::BIGINT)::BIGINT AS saved_tokens,
    (count(*) FILTER (c.n_children IS NULL))::BIGINT AS n_leaves
  FROM nodes u JOIN paths p ON p.via = u.conv_id AND p.depth <= u.depth
  LEFT JOIN children c ON c.conv_id = u.conv_id AND c.depth = u.depth GROUP BY p.depth, p.conv_id
)
SELECT n.conv_id, n.depth::BIGINT AS depth, parent_conv_id, n.n_convs, coalesce(n_children, 0)::BIGINT AS n_children, n_leaves, saved_tokens,
  ends_sha256
FROM nodes n LEFT JOIN parents USING (depth, key) LEFT JOIN children c ON c.depth = n.depth AND c.conv_id = n.conv_id
JOIN sums s ON s.depth = n.depth AND s.conv_id = n.conv_id
"""


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_retrieval_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


QUERIES = {
    "op1_chat_format": op1_chat_format,
    "op2_language": op2_language,
    "op3_decontaminate": op3_decontaminate,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_byte_bpe": op6_byte_bpe,
    "op7_token_counts": op7_token_counts,
    "op8_token_records": op8_token_records,
    "op9_personal_data": op9_personal_data,
    "op10_nearest": op10_nearest,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_whitening": op12_whitening,
    "op13_retrieval_packing": op13_retrieval_packing,
}

SQL = {
    "op1_chat_format": _OP1_SQL,
    "op3_decontaminate": _OP3_SQL,
    "op4_jaccard_join": _OP4_SQL,
    "op11_prefix_trie": _OP11_SQL,
}
