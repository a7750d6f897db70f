"""One query per operator over whole tables, with its contract's columns, and their SQL."""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duologue.llm import collocations, language, mixing, packing, pii, repair, repetition, simhash, suffix_counts, topk, url_rules, warc, window_packing, workers
from duologue.session import checkpoint_root

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge_urls(_table(spark, sf_dir, "pages")).withColumnRenamed("key", "page_id")


def op2_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_spans(_table(spark, sf_dir, "documents"))

    def number(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    listed = F.transform("spans", lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return found.select(
        F.col("key").alias("doc_id"),
        *(number(k) for k in pii.BASE),
        F.col("digest").alias("base_sha256"),
        F.array_join(listed, ",").alias("spans"),
    )


def op3_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    scored = suffix_counts.score(docs, workers.hash_remainder(F.col("doc_id"), 7) != 2)
    return scored.withColumnRenamed("key", "doc_id")


def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op5_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.judge(_table(spark, sf_dir, "documents")).withColumnRenamed("key", "doc_id")


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.groups(_table(spark, sf_dir, "documents")).select(
        F.col("key").alias("doc_id"),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.col("group").alias("component_id"),
    )


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{checkpoint_root(spark)}/warc-{uuid4().hex}"
    warc.write(_table(spark, sf_dir, "pages"), folder)
    return warc.read(spark, folder).select(
        F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.plan(_table(spark, sf_dir, "documents"))
    return plan.select(F.col("key").alias("doc_id"), "size", "source_size", "target", "taken", "copies")


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held_out = workers.hash_remainder(F.col("doc_id"), 4) == 2
    model = language.train(docs.where(~held_out), F.col("lang"), F.col("text"))
    found = language.predict(docs, model).withColumnRenamed("key", "doc_id")
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(_table(spark, sf_dir, "documents")).withColumnRenamed("key", "doc_id")


def op11_window_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return window_packing.packed(_table(spark, sf_dir, "documents")).withColumnRenamed("key", "doc_id")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"))


def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = _table(spark, sf_dir, "conversations")
    return repair.summaries(repair.damaged(conversations), conversations.withColumnRenamed("conv_id", "key"), "key").withColumnRenamed("key", "conv_id")


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (op1_url_rules, op2_personal_data, op3_suffix_tree, op4_topk, op5_repetition, op6_simhash, op7_warc, op8_mixing, op9_language, op10_packing, op11_window_packing, op12_collocations, op13_repair)
}


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def _url_sql() -> str:
    rules = sorted(url_rules.SITE_RULES, key=lambda r: -len(r[1]))

    def case(value: Callable[[str, str], str], otherwise: str) -> str:
        arms = []
        for verdict, rule in rules:
            host, slash, rest = rule.partition("/")
            fits = f"(host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{slash}{rest}')"
            arms.append(f"WHEN {fits} THEN '{value(verdict, rule)}'")
        return f"CASE {' '.join(arms)} ELSE {otherwise} END"

    def pattern(glob: str) -> str:
        out = "".join(f"\\x{ord(c):02x}" if c not in "*?" else c for c in glob)
        return "(?s)^" + out.replace("**", "\0").replace("*", "[^/]*").replace("\0", ".*").replace("?", "[^/]") + "$"

    globs = " OR ".join(f"regexp_matches(host || path, '{pattern(g)}')" for g in url_rules.BLOCK_GLOBS)
    first = "CASE " + " ".join(f"WHEN regexp_matches(host || path, '{pattern(g)}') THEN '{g}'" for g in url_rules.BLOCK_GLOBS) + " END"
    return f"""
WITH cut AS (
  SELECT page_id, coalesce(regexp_extract(url, '(?s)^.*?://(.*)$', 1), '') AS rest FROM pages
), parts AS (
  SELECT page_id,
    translate(regexp_extract(rest, '(?s)^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '(?s)^[^/?#]*([^?#]*)', 1) AS path
  FROM cut
)
SELECT page_id, host, path, {case(lambda v, r: r, 'NULL')} AS rule,
  {case(lambda v, r: v, f"CASE WHEN host = '' OR {globs} THEN 'block' ELSE 'allow' END")} AS verdict,
  {first} AS glob
FROM parts"""


TOPK_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id AND len(q.e) = len(c.e)
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scored
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 10"""


WARC_SQL = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS digest FROM pages
), f AS (
  SELECT *, n >= 100 AND page_id > min(page_id) OVER (PARTITION BY digest) AS again,
    min(page_id) OVER (PARTITION BY digest) AS first_id
  FROM p
)
SELECT page_id, n AS payload_bytes, digest AS payload_digest,
  CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN again THEN first_id END AS refers_to
FROM f"""


COLLOCATIONS_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), words AS (
  SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces
), starts AS (
  SELECT lang, w, unnest(generate_series(1, len(w))) AS i FROM words WHERE len(w) > 0
), counts AS MATERIALIZED (
  SELECT lang, m AS words, array_to_string(w[i : i + m - 1], ' ') AS phrase, count(*) AS f
  FROM starts, (VALUES (1), (2), (3)) AS sizes(m)
  WHERE i + m - 1 <= len(w)
  GROUP BY ALL
), totals AS (
  SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counts WHERE words = 1 GROUP BY lang
), candidates AS (
  SELECT lang, words, phrase, f AS a, string_split(phrase, ' ') AS w FROM counts WHERE words >= 2 AND f >= 10
), parts AS MATERIALIZED (
  SELECT lang, phrase, words, a, k, struct_pack(g := lang, p := array_to_string(w[1 : k], ' ')) AS lp, struct_pack(g := lang, p := array_to_string(w[k + 1 : words], ' ')) AS rp
  FROM candidates, (VALUES (1), (2)) AS places(k) WHERE k < words
), cuts AS (
  SELECT c.lang, c.phrase, c.words, c.a, k, x.f AS l, y.f AS r,
    CAST(1000000::HUGEINT * c.a * c.a // (x.f::HUGEINT * y.f) AS BIGINT) AS score
  FROM parts c JOIN counts x ON struct_pack(g := x.lang, p := x.phrase) = c.lp JOIN counts y ON struct_pack(g := y.lang, p := y.phrase) = c.rp
), weakest AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), inner_phrases AS (
  SELECT lang, array_to_string(w[1 : 2], ' ') AS phrase, a AS longer FROM candidates WHERE words = 3
  UNION ALL
  SELECT lang, array_to_string(w[2 : 3], ' '), a FROM candidates WHERE words = 3
), longest AS (
  SELECT lang, phrase, max(longer) AS longer FROM inner_phrases GROUP BY ALL
), kept AS (
  SELECT s.*, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, s.phrase) AS rank
  FROM weakest s LEFT JOIN longest g ON g.lang = s.lang AND g.phrase = s.phrase
  WHERE g.longer IS NULL OR 100 * g.longer < 50 * s.a
)
SELECT lang, rank, phrase, a, l, r, n, score FROM kept JOIN totals USING (lang) WHERE rank <= 2000"""


REPAIR_SQL = r"""
WITH RECURSIVE steps AS (
  SELECT list(list_reduce(list_prepend(b, range(8)), lambda v, x: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END) ORDER BY b) AS crc
  FROM range(256) AS bytes(b)
), marked AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(4294967295, list_reduce(
      list_prepend(4294967295::BIGINT, list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda c: ascii(c)::BIGINT)),
      lambda v, b: xor(v >> 8, crc[(xor(v, b) & 255) + 1]))) % 20 AS fault
  FROM conversations, steps
), damaged AS (
  SELECT conv_id, turn, CASE fault WHEN 4 THEN 'user' ELSE role END AS role,
    CASE fault WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(range(CASE fault WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM marked WHERE fault <> 0
), ordered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i,
    regexp_extract(text, '(?s)([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS last
  FROM damaged
), faults AS (
  SELECT conv_id, turn, role, text, i, left(role, 1) AS initial,
    CASE WHEN last = '' THEN 'blank'
      WHEN i > min(i) OVER (PARTITION BY conv_id, role, text) THEN 'duplicate'
      WHEN last NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
    lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before
  FROM ordered
), counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (i > 1 AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n
  FROM faults GROUP BY conv_id
), moves(state, letter, initial, next, price) AS (
  VALUES (0, 'K', 's', 1, 0), (0, 'K', 'u', 2, 0), (1, 'K', 'u', 2, 0), (2, 'K', 'a', 3, 0), (3, 'K', 'u', 2, 0),
    (0, 'R', NULL, 2, 1), (1, 'R', NULL, 2, 1), (2, 'R', NULL, 3, 1), (3, 'R', NULL, 2, 1),
    (0, 'D', NULL, 0, 2), (1, 'D', NULL, 1, 2), (2, 'D', NULL, 2, 2), (3, 'D', NULL, 3, 2)
), inserts(state, next, letters, lines) AS (
  VALUES (0, 0, '', ''), (1, 1, '', ''), (2, 2, '', ''), (3, 3, '', ''),
    (0, 2, 'I', chr(10) || 'user:'), (1, 2, 'I', chr(10) || 'user:'), (2, 3, 'I', chr(10) || 'assistant:'), (3, 2, 'I', chr(10) || 'user:'),
    (0, 3, 'II', chr(10) || 'user:' || chr(10) || 'assistant:'), (1, 3, 'II', chr(10) || 'user:' || chr(10) || 'assistant:')
), walked AS (
  SELECT conv_id, 0::BIGINT AS i, 0 AS state, 0::BIGINT AS cost, '' AS audit, '' AS lines FROM counted
  UNION ALL
  SELECT conv_id, i, state, cost, audit, lines FROM (
    SELECT w.conv_id, f.i, m.next AS state,
      w.cost + 5 * length(x.letters) + m.price + CASE WHEN f.fault = 'truncated' AND m.letter <> 'D' THEN 5 ELSE 0 END AS cost,
      w.audit || x.letters || m.letter AS audit,
      w.lines || x.lines || CASE m.letter WHEN 'D' THEN '' WHEN 'K' THEN chr(10) || f.role || ':' || f.text
        ELSE chr(10) || CASE m.next WHEN 2 THEN 'user' ELSE 'assistant' END || ':' || f.text END AS lines
    FROM walked w JOIN faults f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.i = w.i + 1
    JOIN inserts x ON x.state = w.state JOIN moves m ON m.state = x.next
    WHERE (m.initial IS NULL OR m.initial = f.initial) AND (m.letter = 'D' OR f.fault NOT IN ('blank', 'duplicate'))
  ) AS tried
  QUALIFY row_number() OVER (PARTITION BY conv_id, state ORDER BY cost, audit) = 1
), ended AS (
  SELECT w.conv_id, w.cost + 5 * length(x.letters) AS cost, w.audit || x.letters AS audit, w.lines || x.lines AS lines
  FROM walked w JOIN counted c ON c.conv_id IS NOT DISTINCT FROM w.conv_id AND c.n = w.i
  JOIN inserts x ON x.state = w.state AND (x.next = 3 OR (x.state = 0 AND x.next = 0))
  QUALIFY row_number() OVER (PARTITION BY w.conv_id ORDER BY w.cost + 5 * length(x.letters), w.audit || x.letters) = 1
)
SELECT d.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, sha256(coalesce(substr(lines, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) d
LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM d.conv_id
LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM d.conv_id"""


def oracle_sql() -> dict[str, str]:
    return {"op1_url_rules": _url_sql(), "op4_topk": TOPK_SQL, "op7_warc": WARC_SQL, "op12_collocations": COLLOCATIONS_SQL, "op13_repair": REPAIR_SQL}
