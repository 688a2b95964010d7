"""The registered queries of this subpackage and their SQL twins.

Each query applies its operator, with production parameters, to the whole
table and derives the digest columns of its contract from the result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablework.llm import (bpe, chat_format, conversation_trie, hnsw, language_id, lexical_search, line_dedup, ngram_join,
                           quality_rules, source_mix, token_counts, url_filter, warc)
from tablework.llm.common import handover

Q: dict = {}
SQL: dict = {}


def query(name: str, sql: str | None = None):
    def put(fn):
        Q[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return put


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# The rules of the contract.
URL_RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"),
             ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]

OP1_SQL = r"""
WITH cut AS (
  SELECT page_id, CASE WHEN contains(coalesce(url, ''), '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
         regexp_extract(rest, '^[^?#]*\?([^#]*)', 1) AS query
  FROM cut
), canon AS (
  SELECT page_id, host, path,
         array_to_string(list_filter(string_split(query, '&'),
             lambda p: p <> '' AND NOT regexp_matches(p, '^(ref|utm_[^=]*)(=.*)?$')), '&') AS kept,
         regexp_replace(regexp_replace(host, '^www\.', ''), ':(80|443)$', '') AS site
  FROM parts
), keyed AS (
  SELECT page_id, host, path,
         CASE WHEN site <> '' THEN site || regexp_replace(path, '/+$', '') || CASE WHEN kept <> '' THEN '?' || kept ELSE '' END END AS entry
  FROM canon
), listed AS (
  SELECT DISTINCT entry FROM keyed
  WHERE entry IS NOT NULL AND page_id IN (SELECT doc_id FROM labels WHERE toxic = 1)
), rules(verdict, rhost, rpath) AS (
  VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')
)
SELECT k.page_id, k.host, k.path,
       (SELECT arg_max(rhost || rpath, length(rhost || rpath)) FROM rules
        WHERE (k.host = rhost OR k.host LIKE '%.' || rhost) AND starts_with(k.path, rpath)) AS rule,
       coalesce((SELECT arg_max(verdict, length(rhost || rpath)) FROM rules
                 WHERE (k.host = rhost OR k.host LIKE '%.' || rhost) AND starts_with(k.path, rpath)),
                CASE WHEN k.entry IN (SELECT entry FROM listed) THEN 'block' ELSE 'allow' END) AS verdict
FROM keyed k"""


@query("op1_url_filter", OP1_SQL)
def op1_url_filter(spark, sf_dir):
    """Rules of the contract; listed are the URLs of pages whose number is
    labelled toxic in ``labels``."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    toxic = table(spark, sf_dir, "labels").filter("toxic = 1").select(F.col("doc_id").alias("page_id")).distinct()
    listed = pages.join(toxic, "page_id", "left_semi")
    return (url_filter.filter_urls(pages, listed, URL_RULES)
            .select("page_id", "host", "path", "rule", "verdict"))


@query("op2_source_mix")
def op2_source_mix(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return source_mix.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


@query("op3_hnsw")
def op3_hnsw(spark, sf_dir):
    """No SQL twin: the graph's answers are approximate (recall is tested
    against brute force)."""
    return hnsw.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def level_values() -> str:
    return ", ".join("(" + ", ".join(str(x) for x in (level, *cutoffs)) + ")"
                     for level, cutoffs in enumerate(quality_rules.LEVELS, 1))


OP4_SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents
), starts AS (
  SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM d
), wins AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, array_to_string(w[i:i+7], ' ')) AS times FROM starts
), inside AS (
  SELECT DISTINCT doc_id, i + j AS pos FROM wins, range(0, 8) AS r(j) WHERE times > 1
), repeats AS (
  SELECT doc_id, count(*) AS n FROM inside GROUP BY doc_id
), counts AS (
  SELECT d.doc_id, source, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, len(l) AS n_lines,
         coalesce(r.n, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN repeats r ON d.doc_id = r.doc_id
), based AS (
  SELECT *, (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed FROM counts
), levels(level, c1, c2, c3, c4) AS (VALUES @LEVELS@), failing AS (
  SELECT b.*, coalesce((SELECT min(level) FROM levels WHERE
      (b.word_chars > 0 AND b.n_symbols / b.word_chars > c1) OR (b.n_lines > 0 AND b.n_dup_lines / b.n_lines > c2)
      OR (b.n_words > 0 AND (b.n_repeat_words / b.n_words > c3 OR b.word_chars / b.n_words > c4))), 1000) AS fails_from
  FROM based b
), good AS (
  SELECT f.source, f.fails_from FROM failing f
  JOIN (SELECT doc_id FROM labels WHERE quality IS NOT NULL GROUP BY doc_id HAVING min(quality) = 1) g ON f.doc_id = g.doc_id
  WHERE NOT f.base_failed
), strata AS (
  SELECT source, count(*) AS n FROM good GROUP BY source
), tested AS (
  SELECT s.source, s.n, l.level, (SELECT count(*) FROM strata) AS tests,
         (SELECT count(*) FROM good g WHERE g.source IS NOT DISTINCT FROM s.source AND g.fails_from <= l.level) AS k
  FROM strata s, levels l
), passed AS (
  SELECT source, level, k < n * @RISK@ AND
    (SELECT sum(exp(lgamma(n + 1) - (CASE WHEN i < 2 THEN 0 ELSE lgamma(i + 1) END) - (CASE WHEN n - i < 2 THEN 0 ELSE lgamma(n - i + 1) END)
                    + i * ln(@RISK@) + (n - i) * ln(1 - @RISK@))) FROM range(0, k + 1) AS r(i)) <= @ERROR@ / tests AS ok
  FROM tested
), proven AS (
  SELECT source, coalesce(min(level) FILTER (NOT ok) - 1, max(level)) AS level FROM passed GROUP BY source
)
SELECT f.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       (NOT base_failed AND fails_from > coalesce(p.level, 0)) AS kept
FROM failing f LEFT JOIN proven p ON f.source IS NOT DISTINCT FROM p.source"""
OP4_SQL = (OP4_SQL.replace("@LEVELS@", level_values()).replace("@RISK@", str(quality_rules.MAX_FALSE_REJECT))
           .replace("@ERROR@", str(quality_rules.ERROR)))


@query("op4_quality_rules", OP4_SQL)
def op4_quality_rules(spark, sf_dir):
    """Counts of every document are worked out once and written; labels,
    cutoffs and verdicts work on that narrow table."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    counted = handover(quality_rules.features(docs).drop("text"), "quality-counts")
    labelled = quality_rules.with_labels(counted, table(spark, sf_dir, "labels"))
    levels = handover(quality_rules.calibrate(labelled), "quality-levels")
    return (quality_rules.judge(counted, levels)
            .select("doc_id", *quality_rules.COUNTS, "base_failed", "kept"))


def derived_edits(text: str = "text"):
    """Three edits per document, places following from its length: a cut
    after a third, an insertion in the middle, a line at the end."""
    n = F.coalesce(F.char_length(text), F.lit(0)).cast("long")

    def edit(start, stop, new):
        return F.struct(start.cast("long").alias("start"), stop.cast("long").alias("stop"), new.alias("replacement"))

    third, half = F.floor(n / 3), F.floor(n / 2)
    return F.array(edit(third, third + 20, F.lit("")), edit(half, half, F.lit(" it's 2 new\n\n words")),
                   edit(n + 100, n + 100, F.concat(F.lit("\nDocument "), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))))


@query("op5_token_counts")
def op5_token_counts(spark, sf_dir):
    """Token counts of every document, before and after its edits."""
    path = vocabulary_path()
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    trees = token_counts.build(docs.withColumn("edits", derived_edits()), path)
    edited = token_counts.apply_edits(trees.withColumn("n_before", F.col("n_tokens")), path)
    return edited.select("doc_id", F.col("n_before").alias("n_tokens"), F.col("n_tokens").alias("n_tokens_edited"),
                         "n_reencoded")


@query("op6_ngram_join")
def op6_ngram_join(spark, sf_dir):
    return ngram_join.link_groups(table(spark, sf_dir, "documents").select("doc_id", "text"), 3, 90, 100)


OP7_SQL = r"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS x FROM pages
), d AS (
  SELECT page_id, octet_length(encode(h))::BIGINT AS payload_bytes,
         array_to_string(list_transform(range(0, 32), lambda k:
             substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                    (((('0x' || substr(x, (k // 4) * 5 + 1, 5))::BIGINT >> (15 - 5 * (k % 4))) & 31) + 1)::BIGINT, 1)), '') AS payload_digest
  FROM p
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = max(page_id) OVER w THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> max(page_id) OVER w THEN max(page_id) OVER w END AS refers_to
FROM d WINDOW w AS (PARTITION BY payload_digest)"""


@query("op7_warc", OP7_SQL)
def op7_warc(spark, sf_dir):
    captures = warc.round_trip(table(spark, sf_dir, "pages").select("page_id", "url", "html"), min_bytes=0)

    def page(of):
        return F.nullif(F.get(F.col(of), 0)["fields"]["pageId"], F.lit("")).cast("long")

    return (captures
            .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.get("metadata", F.lit(0))["fields"]["copies"].cast("int"))))
            .select(page("metadata").alias("page_id"),
                    F.coalesce("original.response.payload_bytes", "response.payload_bytes").alias("payload_bytes"),
                    F.coalesce("original.response.read_digest", "response.read_digest").alias("payload_digest"),
                    F.col("response.warc_type").alias("record_type"),
                    F.when(F.col("response.warc_type") == "revisit", page("original.metadata")).alias("refers_to")))


OP8_SQL = r"""
WITH split AS (
  SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), lined AS (
  SELECT rid, doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM split
), keyed AS (
  SELECT *, translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lined
), common AS (
  SELECT key, max(doc_id) AS top FROM keyed WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT rid) >= 3
), judged AS (
  SELECT k.*, (c.key IS NOT NULL AND k.doc_id IS DISTINCT FROM c.top) AS gone FROM keyed k LEFT JOIN common c ON k.key = c.key
)
SELECT doc_id, count(*) AS n_lines, sum(gone::INT)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY rid, doc_id"""


@query("op8_line_dedup", OP8_SQL)
def op8_line_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = line_dedup.drop_common_lines(docs)
    return kept.select("doc_id", "n_lines", "n_dropped",
                       F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def vocabulary_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.tiktoken")


@query("op9_byte_bpe")
def op9_byte_bpe(spark, sf_dir):
    path = vocabulary_path()
    coded = bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), path)
    digest = coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                          F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")).cast("binary"), 256)
                          .alias("ids_sha256"), "ids")
    return (bpe.decode(digest, path)
            .select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256")))


@query("op10_language_id")
def op10_language_id(spark, sf_dir):
    docs = (table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
            .withColumn("held_out", language_id.held_out(F.col("doc_id"))))
    model = language_id.train(docs.filter(~F.col("held_out") & F.col("doc_id").isNotNull()))
    return (language_id.identify(docs.select("doc_id", "held_out", "text"), model)
            .select("doc_id", "held_out", "lang_pred", "score"))


OP11_SQL = r"""
WITH t AS (
  SELECT conv_id, list({'r': coalesce(role, ''), 'x': coalesce(text, '')} ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS turns,
         xor(list_reduce([4294967295::BIGINT] || list_transform(string_split(conv_id::VARCHAR, ''), lambda a: ascii(a)::BIGINT),
             lambda c, b: list_reduce([xor(c, b)] || range(8), lambda v, i: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)),
             4294967295) % 4 AS h
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), whole AS (
  SELECT t.conv_id, coalesce(b.turns[1:t.h], []) || t.turns[t.h + 1:] AS s
  FROM t LEFT JOIN t b ON b.conv_id = t.conv_id - t.conv_id % 20
), paths AS (
  SELECT conv_id, d, s[1:d] AS p, d = len(s) AS last, s[d].x AS x FROM (SELECT conv_id, s, unnest(range(0, len(s) + 1)) AS d FROM whole)
), nodes AS (
  SELECT p, d, min(conv_id) AS conv_id, count(*) AS n_convs,
         (count(*) - 1) * (CASE WHEN d = 0 THEN 0 ELSE len(regexp_extract_all(any_value(x), '[^\x20\x09-\x0D]+')) END) AS value,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (last), '')) AS ends
  FROM paths GROUP BY p, d
), children AS (
  SELECT p[1:d - 1] AS p, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1
), figures AS (
  SELECT n.*, coalesce(c.n, 0) AS n_children FROM nodes n LEFT JOIN children c ON n.p = c.p
), below AS (
  SELECT p[1:k] AS p, sum((n_children = 0)::INT)::BIGINT AS n_leaves, sum(value)::BIGINT AS saved
  FROM (SELECT *, unnest(range(0, d + 1)) AS k FROM figures) GROUP BY 1
)
SELECT f.conv_id, f.d AS depth, up.conv_id AS parent_conv_id, f.n_convs, f.n_children, b.n_leaves, b.saved AS saved_tokens, f.ends AS ends_sha256
FROM figures f JOIN below b ON f.p = b.p LEFT JOIN nodes up ON f.d > 0 AND up.p = f.p[1:f.d - 1]"""


@query("op11_conversation_trie", OP11_SQL)
def op11_conversation_trie(spark, sf_dir):
    return conversation_trie.trie(table(spark, sf_dir, "conversations"))


# The conversation that the contract adds.
ADDED_ID, ADDED_TEXT = -7, r"\### Assistant: </turn> ok"

OP12_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (@ID@, 0, 'user', '@TEXT@'), (@ID@, 1, 'assistant', '@TEXT@')
), sized AS (
  SELECT *, 14 + list_sum([length(v) + length(v) - length(replace(v, chr(92), '')) + (length(v) - length(replace(v, '</turn>', ''))) // 7
                           + coalesce(list_sum(list_transform(regexp_extract_all(v, '#{3,}'), lambda m: length(m) - 2)), 0)
                           for v in [role, text]]) + length(role) - length(replace(role, ':', '')) AS chars
  FROM t
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(chars)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id""".replace("@ID@", str(ADDED_ID)).replace("@TEXT@", ADDED_TEXT)


@query("op12_chat_format", OP12_SQL)
def op12_chat_format(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.createDataFrame([(ADDED_ID, 0, "user", ADDED_TEXT), (ADDED_ID, 1, "assistant", ADDED_TEXT)], turns.schema)
    return chat_format.round_trip(turns.unionAll(added))


OP13_SQL = r"""
WITH toks AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents
), size AS (
  SELECT count(*) FILTER (len(w) > 0) AS nd, sum(len(w))::BIGINT AS nt FROM toks
), tf AS (
  SELECT rid, term, count(*) AS tf FROM (SELECT rid, unnest(w) AS term FROM toks) GROUP BY ALL
), asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
), freq AS (
  SELECT term, count(*) AS df, floor(1000 * ln((2 * nd + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tf, size GROUP BY term, nd
), parts AS (
  SELECT a.item_id, t.rid, k.doc_id, f.w * ((1000000000 * t.tf) // (1000 * t.tf + 8 * (10 + (90 * len(k.w) * nd) // nt))) AS part
  FROM asked a JOIN freq f ON a.term = f.term JOIN tf t ON a.term = t.term JOIN toks k ON k.rid = t.rid, size
), scores AS (
  SELECT item_id, rid, doc_id, sum(part)::BIGINT AS score FROM parts GROUP BY ALL HAVING sum(part) > 0
)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank, doc_id, score
FROM scores QUALIFY rank <= 10"""


@query("op13_lexical_search", OP13_SQL)
def op13_lexical_search(spark, sf_dir):
    return lexical_search.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
