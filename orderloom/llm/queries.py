"""The registered queries over whole tables, and the SQL they must equal where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm import (
    centroids,
    chat,
    line_dedup,
    middle,
    minhash,
    mixing,
    packing,
    pivots,
    quality,
    suffixes,
    tokens,
    toxicity,
    urls,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

SEQUENCE_TOKENS = 2048
TOKEN_LIMIT = 512


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query
def op3_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Pieces of all documents, packed into sequences of at most 2048 tokens."""
    pieces = tokens.token_pieces(F.col("text"), vocabulary(), SEQUENCE_TOKENS)
    cut = table(spark, folder, "documents").select("doc_id", F.inline(pieces))
    return packing.pack(cut, "length", SEQUENCE_TOKENS)


@query
def op4_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Bytes and tokens of each whole document."""
    counted = table(spark, folder, "documents").select(
        "doc_id", tokens.token_counts(F.col("text"), vocabulary()).alias("c")
    )
    over = (F.col("c.n_tokens") > TOKEN_LIMIT).alias("over_limit")
    return counted.select("doc_id", "c.n_bytes", "c.n_tokens", over)


@query
def op9_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Counts and verdict of each whole document; the line field is trained on its labels."""
    documents = table(spark, folder, "documents").select("doc_id", "text")
    model = quality.train(documents, table(spark, folder, "labels"))
    judged = quality.judge(documents, model)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "content_words"]
    return judged.select("doc_id", *(f"quality.{n}" for n in [*names, "base_failed", "kept"]))


@query
def op7_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """How many words of each document the mix takes."""
    documents = table(spark, folder, "documents")
    mixed = mixing.mix(documents.select("doc_id", "source", mixing.word_count(F.col("text")).alias("words")), F.col("words"))
    taken = (F.col("copies") * F.col("size")).alias("taken")
    return mixed.select("doc_id", "size", "source_size", "target", taken)


@query
def op1_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of each document, lines deleted, and a digest of what is left."""
    documents = table(spark, folder, "documents").select("doc_id", "text")
    left = line_dedup.dedup_lines(documents)
    digest = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256")
    return left.select("doc_id", "n_lines", "n_removed", digest)


ORACLES["op1_line_dedup"] = r"""
WITH split AS (
  SELECT doc_id, text, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
counted AS (
  SELECT *, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words FROM split),
placed AS (
  SELECT doc_id, pos, line, words, sum(words) OVER (PARTITION BY doc_id ORDER BY pos) - words AS word_at
  FROM counted WHERE words > 0),
-- A repeated run of 50 words or more is covered by the shortest windows from each line on and up to each line.
spans AS (
  SELECT doc_id, pos AS first, max(pos) OVER w AS last, max(word_at + words) OVER w - word_at AS held,
         list(line) OVER w AS content
  FROM placed WINDOW w AS (PARTITION BY doc_id ORDER BY word_at RANGE BETWEEN CURRENT ROW AND 49 FOLLOWING)
  UNION ALL
  SELECT doc_id, min(pos) OVER w, pos, word_at + words - min(word_at) OVER w, list(line) OVER w
  FROM placed WINDOW w AS (PARTITION BY doc_id ORDER BY word_at + words RANGE BETWEEN 49 PRECEDING AND CURRENT ROW)),
ranked AS (
  SELECT doc_id, first, last, rank() OVER (PARTITION BY content ORDER BY doc_id, first) AS nth
  FROM spans WHERE held >= 50),
gone AS (
  SELECT DISTINCT p.doc_id, p.pos FROM placed p JOIN ranked r
  ON p.doc_id = r.doc_id AND p.pos BETWEEN r.first AND r.last WHERE r.nth > 1),
left_over AS (
  SELECT s.doc_id, count(*) AS n_lines, count(g.pos) AS n_removed,
         coalesce(string_agg(s.line, chr(10) ORDER BY s.pos) FILTER (WHERE g.pos IS NULL), '') AS rest,
         bool_or(s.text IS NULL) AS missing
  FROM counted s LEFT JOIN gone g ON s.doc_id = g.doc_id AND s.pos = g.pos GROUP BY s.doc_id)
SELECT doc_id, CASE WHEN missing THEN 0 ELSE n_lines END AS n_lines, n_removed, sha256(rest) AS kept_sha256
FROM left_over
"""


@query
def op8_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """The near-duplicate component of each document, by four-word shingles."""
    documents = table(spark, folder, "documents")
    found = minhash.near_duplicates(documents, size=4, percent=80)
    kept = F.coalesce(F.col("id") == F.col("component"), F.lit(True))
    return found.select(
        F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"), kept.alias("kept")
    )


@query
def op10_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Links and component of each vector at cosine 0.9 or more."""
    found = pivots.near_duplicates(table(spark, folder, "embeddings"), threshold=0.9)
    kept = F.coalesce(F.col("id") == F.col("component"), F.lit(True))
    return found.select(
        F.col("id").alias("vec_id"), "n_links", F.col("component").alias("component_id"), kept.alias("kept")
    )


# Rules of the url check: fixed values.
URL_RULES = (
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
)


@query
def op6_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    """Host, path, longest rule and verdict of each page."""
    pages = table(spark, folder, "pages").select("page_id", "url")
    return urls.judge_urls(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


ORACLES["op6_url_filters"] = r"""
WITH rest AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages),
hosts AS (SELECT page_id, r, regexp_extract(r, '^[^/?#]*') AS h FROM rest),
parts AS (
  SELECT page_id, translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(r, length(h) + 1), '^[^?#]*') AS path FROM hosts),
rules(rule, rule_host, rule_path, verdict) AS (VALUES
  ('org/', 'org', '/', 'allow'), ('example.org/es/', 'example.org', '/es/', 'block'),
  ('example.org/en/1', 'example.org', '/en/1', 'block'), ('com/fr/', 'com', '/fr/', 'allow'),
  ('com/de/', 'com', '/de/', 'block'))
SELECT p.page_id, p.host, p.path, max_by(r.rule, length(r.rule)) AS rule,
       coalesce(max_by(r.verdict, length(r.rule)), 'allow') AS verdict
FROM parts p LEFT JOIN rules r
  ON (p.host = r.rule_host OR ends_with(p.host, '.' || r.rule_host)) AND starts_with(p.path, r.rule_path)
GROUP BY p.page_id, p.host, p.path
"""

# What the two tools of the query accept.
CALL_SCHEMAS = {
    name: {
        "properties": {
            "text": {"type": "string", "maxLength": 600},
            "words": {"type": "integer", "minimum": 5},
        },
        "required": ["text", "words"],
        "additionalProperties": False,
    }
    for name in ("open", "continue")
}


@query
def op2_tool_call_linking(spark: SparkSession, folder: str) -> DataFrame:
    """Each user turn as a tool call, the assistant turn after it as its result, all other turns as messages.

    A call builds on the call two turns before it; the first user turn of a conversation opens it.
    """
    turns = table(spark, folder, "conversations")
    name = lambda turn: F.concat_ws("-", F.col("conv_id").cast("string"), turn.cast("string"))
    words = mixing.word_count(F.col("text"))
    asked = turns.where("role = 'user'")
    opened = asked.groupBy("conv_id").agg(F.min("turn").alias("opening"))
    # One row per conversation.
    asked = asked.join(opened.hint("shuffle_hash"), "conv_id", "left")
    calls = asked.select(
        F.col("conv_id").alias("conversation"),
        name(F.col("turn")).alias("call_id"),
        F.when(F.col("turn") >= 2, name(F.col("turn") - 2)).alias("after"),
        F.col("turn").alias("seq"),
        F.when(F.col("turn") == F.col("opening"), "open").otherwise("continue").alias("tool"),
        F.to_json(F.struct(words.alias("words"), "text")).alias("arguments"),
    )
    results = turns.where("role = 'assistant'").select(
        F.col("conv_id").alias("conversation"),
        name(F.col("turn") - 1).alias("call_id"),
        F.col("turn").alias("seq"),
        F.col("text").alias("result"),
    )
    others = turns.where("role is null or role not in ('user', 'assistant')").select(
        F.col("conv_id").alias("conversation"),
        name(F.col("turn")).alias("call_id"),
        F.col("turn").alias("seq"),
        F.col("text").alias("result"),
    )
    linked = chat.link_calls(calls, results, CALL_SCHEMAS, every_result=True)
    return linked.unionByName(chat.messages(others)).withColumnRenamed("conversation", "conv_id")


ORACLES["op2_tool_call_linking"] = r"""
WITH RECURSIVE calls AS (
  SELECT conv_id, conv_id || '-' || turn AS call_id, CASE WHEN turn >= 2 THEN conv_id || '-' || (turn - 2) END AS after,
         turn AS seq, CASE WHEN turn = min(turn) OVER (PARTITION BY conv_id) THEN 'open' ELSE 'continue' END AS tool, text,
         len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words
  FROM conversations WHERE role = 'user'),
results AS (
  SELECT conv_id, conv_id || '-' || (turn - 1) AS call_id, turn AS seq, text AS result
  FROM conversations WHERE role = 'assistant'),
leveled AS (
  SELECT conv_id, call_id, 0 AS level FROM calls c
  WHERE NOT EXISTS (SELECT 1 FROM calls p WHERE p.conv_id = c.conv_id AND p.call_id = c.after)
  UNION ALL
  SELECT c.conv_id, c.call_id, l.level + 1 FROM calls c JOIN leveled l ON c.conv_id = l.conv_id AND c.after = l.call_id),
linked AS (
  SELECT coalesce(c.conv_id, r.conv_id) AS conv_id, coalesce(c.call_id, r.call_id) AS call_id,
         coalesce(c.seq, r.seq) AS seq, c.after, c.tool, c.text, c.words, r.result,
         CASE WHEN c.call_id IS NULL THEN 'no_call' WHEN r.call_id IS NULL THEN 'no_result' ELSE 'linked' END AS status
  FROM calls c FULL JOIN results r ON c.conv_id = r.conv_id AND c.call_id = r.call_id
  UNION ALL
  SELECT conv_id, conv_id || '-' || turn, turn, NULL, NULL, NULL, NULL, text, 'message'
  FROM conversations WHERE role IS NULL OR role NOT IN ('user', 'assistant'))
SELECT k.conv_id, k.call_id, k.seq, CASE WHEN k.status <> 'message' THEN l.level END AS level, k.status,
       concat_ws('; ', CASE WHEN length(k.text) > 600 THEN 'text is longer than 600' END,
                       CASE WHEN k.words < 5 THEN 'words is below 5' END) AS errors,
       '{"after":' || coalesce(to_json(k.after)::VARCHAR, 'null')
       || ',"arguments":' || CASE WHEN k.tool IS NULL THEN 'null'
            ELSE '{"text":' || to_json(k.text)::VARCHAR || ',"words":' || k.words || '}' END
       || ',"id":' || to_json(k.call_id)::VARCHAR || ',"result":' || coalesce(to_json(k.result)::VARCHAR, 'null')
       || ',"tool":' || coalesce(to_json(k.tool)::VARCHAR, 'null') || '}' AS json
FROM linked k LEFT JOIN leveled l ON k.conv_id = l.conv_id AND k.call_id = l.call_id
"""


@query
def op5_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Each document without the bytes of 100-byte strings that begin earlier too."""
    documents = table(spark, folder, "documents").select("doc_id", "text")
    left = suffixes.remove_repeats(documents, length=100)
    return left.select(
        "doc_id", "left.n_bytes", "left.n_removed", "left.n_spans", F.sha2("left.kept", 256).alias("kept_sha256")
    )


@query
def op11_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    """Form, cut lengths and digests of each whole document for fill-in-middle training."""
    cut = middle.fill_in_middle(table(spark, folder, "documents").select("doc_id", "text"))
    digest = lambda text: F.sha2(text.cast("binary"), 256)
    return cut.select(
        "doc_id",
        "fim.n",
        "fim.form",
        "fim.prefix_chars",
        "fim.middle_chars",
        digest(F.col("fim.output")).alias("output_sha256"),
        digest(middle.restored(F.col("fim.output"), F.col("fim.form"))).alias("restored_sha256"),
    )


ORACLES["op11_fill_in_middle"] = r"""
WITH drawn AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || doc_id) AS h,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units
  FROM documents),
placed AS (
  SELECT *, len(units) AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
         ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM drawn),
cut AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN text = '' OR text LIKE '%<P>%' OR text LIKE '%<S>%' OR text LIKE '%<M>%' OR h3 % 100 >= 50 THEN 'plain'
              WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM placed),
parts AS (
  SELECT *, array_to_string(units[1:a], '') AS p, array_to_string(units[a + 1:b], '') AS m,
         array_to_string(units[b + 1:], '') AS s FROM cut)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
              ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""


@query
def op12_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity score of each whole document, learnt from the labels of four documents in five."""
    documents = table(spark, folder, "documents").select("doc_id", "text")
    model = toxicity.train(documents, table(spark, folder, "labels"))
    return toxicity.judge(documents, model).select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "toxicity.score", "toxicity.predicted"
    )


@query
def op13_centroid_clustering(spark: SparkSession, folder: str) -> DataFrame:
    """Cluster, distance and inertia of each vector after five rounds with 40 centroids."""
    found = centroids.cluster(table(spark, folder, "embeddings").select("vec_id", "embedding"))
    return found.select(
        F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def _clustering_sql(rounds: int) -> str:
    """The rounds one after another: distances of all vectors to all centroids, then floors of means."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
near{r} AS MATERIALIZED (
  SELECT vec_id, v, arg_min(c, (d, c)) AS c, min(d) AS d FROM (
    SELECT vec_id, v, c, list_sum(list_transform(list_zip(v, w), lambda x: (x[1] - x[2]) * (x[1] - x[2])))::BIGINT AS d
    FROM kept, means{r}) GROUP BY vec_id, v)""")
        if r < rounds:
            steps.append(f"""
sums{r} AS (
  SELECT c, pos, sum(x)::BIGINT AS total, count(*) AS n
  FROM (SELECT c, unnest(v) AS x, generate_subscripts(v, 1) AS pos FROM near{r}) GROUP BY c, pos),
floors{r} AS (SELECT c, list((total - ((total % n) + n) % n) // n ORDER BY pos) AS w FROM sums{r} GROUP BY c),
means{r + 1} AS MATERIALIZED (
  SELECT c, coalesce(f.w, m.w) AS w FROM means{r} m LEFT JOIN floors{r} f USING (c))""")
    return f"""
WITH kept AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
means0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS c, v AS w FROM kept
  ORDER BY sha256('2:' || vec_id) LIMIT 40),{",".join(steps)}
SELECT n.vec_id, n.c::INTEGER AS cluster, n.d AS distance, (sum(n.d) OVER (PARTITION BY n.c))::BIGINT AS cluster_inertia,
       (sum(n.d) OVER ())::BIGINT AS inertia, sha256(array_to_string(m.w, ',')) AS centroid_sha256
FROM near{rounds} n JOIN means{rounds} m USING (c)
"""


ORACLES["op13_centroid_clustering"] = _clustering_sql(5)
