"""The registered queries of the thirteen operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadlens.llm import decontam, embedding_dedup, html_text, line_dedup, packing, prefix_trie, repeats, secrets, simhash, spelling, token_store, toxicity, url_rules
from leadlens.llm.common import table
from leadlens.session import scratch_path

# The rules that pages are judged by (host, path, verdict).
URL_RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)


def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "sequence_length")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))


OP3_SQL = r"""
WITH l AS (
  SELECT doc_id, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) - 1 AS no, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents
), w AS (
  SELECT *, list_filter(regexp_split_to_array(lower(line), '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS ws FROM l
), s AS (
  SELECT *, CASE WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) END AS sh FROM w WHERE len(ws) > 0
), d AS (
  SELECT array_to_string(ws, ' ') AS k, min((doc_id, no)) AS place, any_value(sh) AS sh FROM s GROUP BY 1
), t AS (
  SELECT k, place, len(sh) AS n, unnest(sh) AS token FROM d
), p AS (
  SELECT a.k, any_value(a.n) AS n, any_value(b.n) AS m, count(*) AS shared FROM t a JOIN t b ON a.token = b.token AND b.place < a.place GROUP BY a.k, b.k
), gone AS (
  SELECT DISTINCT k FROM p WHERE shared >= 0.8 * (n + m - shared)
), stay AS (
  SELECT place.doc_id AS doc_id, place.no AS no FROM (SELECT k, {'doc_id': place[1], 'no': place[2]} AS place FROM d) WHERE k NOT IN (SELECT k FROM gone)
  UNION ALL SELECT doc_id, no FROM w WHERE len(ws) = 0
), kept AS (
  SELECT l.doc_id, count(*) AS n, string_agg(line, chr(10) ORDER BY no) AS text FROM l JOIN stay USING (doc_id, no) GROUP BY l.doc_id
)
SELECT documents.doc_id, CASE WHEN documents.text IS NOT NULL THEN coalesce(kept.text, '') END AS text,
  CAST(CASE WHEN documents.text IS NULL THEN 0 ELSE len(string_split(documents.text, chr(10))) END AS BIGINT) AS n_lines,
  CAST(CASE WHEN documents.text IS NULL THEN 0 ELSE len(string_split(documents.text, chr(10))) - coalesce(kept.n, 0) END AS BIGINT) AS n_removed
FROM documents LEFT JOIN kept USING (doc_id)
"""


def op4_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = ", ".join(str(r) for r in URL_RULES)
    rules = spark.sql(f"SELECT * FROM VALUES {values} AS rules(host, path, verdict)")
    return url_rules.judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"), rules).select("page_id", "host", "path", "rule", "verdict")


OP4_SQL = f"""
WITH r(rhost, rpath, rverdict) AS (VALUES {", ".join(str(r) for r in URL_RULES)}),
rest AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS x FROM pages
), u AS (
  SELECT row_number() OVER () AS row, page_id, translate(coalesce(regexp_extract(x, '^[^/?#]*'), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(x, '^[^/?#]*([^?#]*)', 1), '') AS path FROM rest
), m AS (
  SELECT u.*, rhost || rpath AS rule, rverdict, row_number() OVER (PARTITION BY row ORDER BY length(rhost || rpath) DESC NULLS LAST, length(rhost) DESC) AS place
  FROM u LEFT JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
)
SELECT page_id, host, path, rule, coalesce(rverdict, 'allow') AS verdict FROM m WHERE place = 1
"""


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score_documents(docs, toxicity.fit_on(docs, table(spark, sf_dir, "labels")))


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


OP6_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
fine AS (
  SELECT * FROM v WHERE e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM fine a JOIN fine b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.95
), reach(a, b) AS (
  SELECT vec_id, vec_id FROM v UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), n AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT reach.a AS vec_id, coalesce(any_value(n.n), 0) AS n_links, min(reach.b) AS component_id, min(reach.b) = reach.a AS kept
FROM reach LEFT JOIN n ON n.a = reach.a GROUP BY reach.a
"""


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.scan(docs, secrets.fit_models(secrets.labelled_tokens(docs)))
    base = F.array_sort(F.concat("assign", "access", "hex"))

    def digest(spans):
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")

    counts = [F.size(k).cast("long").alias(f"n_{k}") for k in ("assign", "access", "hex")]
    return found.select("doc_id", *counts, F.sha2(digest(base), 256).alias("base_sha256"), digest(F.array_sort(F.concat("assign", "access", "hex", "markov"))).alias("spans"))


def op8_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token_store")
    token_store.write_token_store(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"))
    return token_store.read_token_store(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.find_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    copies, texts = repeats.cut_texts(table(spark, sf_dir, "documents"), length=100)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    digests = texts.select("doc", "first", removed.alias("n_removed"), F.size("spans").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
    return repeats.removed_bytes(copies, digests, length=100)


OP11_SQL = """
WITH d AS (
  SELECT row_number() OVER (ORDER BY doc_id NULLS LAST, md5(coalesce(text, ''))) AS num, doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents
), b AS (
  SELECT num, 500 * i AS start, substring(x, 1000 * i + 1, 1198) AS x FROM (SELECT num, x, unnest(range(0, length(x) // 1000 + 1)) AS i FROM d)
), p AS (
  SELECT num, start + i AS pos, substring(x, 2 * i + 1, 200) AS w FROM (SELECT num, start, x, unnest(range(0, 500)) AS i FROM b)
), s AS (
  SELECT num, pos, row_number() OVER (PARTITION BY md5(w) ORDER BY num, pos) AS nth FROM p WHERE length(w) = 200
), o AS (
  SELECT num, pos, lag(pos) OVER (PARTITION BY num ORDER BY pos) AS prev FROM s WHERE nth > 1
), g AS (
  SELECT num, pos, count(*) FILTER (WHERE prev IS NULL OR pos > prev + 100) OVER (PARTITION BY num ORDER BY pos) AS run FROM o
), r AS (
  SELECT num, run, min(pos) AS a, max(pos) + 100 AS z FROM g GROUP BY ALL
), k AS (
  SELECT num, run, a, z, lag(z, 1, 0) OVER (PARTITION BY num ORDER BY run) AS free FROM r
), e AS (
  SELECT num, sum(z - a) AS n, count(*) AS runs, string_agg(substring(x, 2 * free + 1, 2 * (a - free)), '' ORDER BY run) || substring(any_value(x), 2 * max(z) + 1) AS rest
  FROM k JOIN d USING (num) GROUP BY num
)
SELECT doc_id, CAST(length(x) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n, 0) AS BIGINT) AS n_removed, CAST(coalesce(runs, 0) AS BIGINT) AS n_spans,
  sha256(unhex(coalesce(rest, x))) AS kept_sha256
FROM d LEFT JOIN e USING (num)
"""


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = prefix_trie.ranked_turns(table(spark, sf_dir, "conversations"))
    conv = F.col("conv_id")
    shared = F.crc32(conv.cast("string").cast("binary")) % 6
    rebuilt, convs = prefix_trie.rebuild_forks(turns, conv - conv % 100, shared, most=5)
    nodes, ends = prefix_trie.prefix_trie(rebuilt, convs)
    full = nodes.join(prefix_trie.list_digests(ends), ["depth", "k1", "k2"], "left")
    none = F.sha2(F.lit("").cast("binary"), 256)
    return full.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", none).alias("ends_sha256"))


def _crc32_sql(hex_text: str) -> str:
    """Unsigned CRC-32 of the bytes written in ``hex_text``, bit by bit."""
    data = f"list_transform(range(1, length({hex_text}) // 2 + 1), lambda i: CAST('0x' || substring({hex_text}, 2 * i - 1, 2) AS BIGINT))"
    bits = "list_reduce(list_prepend(xor(a, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {data}), lambda a, b: {bits}), 4294967295)"


OP12_SQL = f"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, turn FROM conversations WHERE conv_id IS NOT NULL
), r AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(role) || ':' || role || text)) - 1 AS pos FROM t
), c AS (
  SELECT conv_id, conv_id - conv_id % 100 AS base, {_crc32_sql("x")} % 6 AS h FROM (SELECT DISTINCT conv_id, hex(encode(CAST(conv_id AS VARCHAR))) AS x FROM t)
), b AS (
  SELECT c.conv_id, 0 AS part, pos, role, text FROM c JOIN r ON r.conv_id = c.base AND pos < h
  UNION ALL SELECT c.conv_id, 1, pos, role, text FROM c JOIN r ON r.conv_id = c.conv_id AND pos >= h
), n AS (
  SELECT conv_id, row_number() OVER w AS depth, list(md5(length(role) || ':' || role || text)) OVER w AS key, length(text) AS chars
  FROM b WINDOW w AS (PARTITION BY conv_id ORDER BY part, pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
), m AS (
  SELECT * FROM n UNION ALL SELECT conv_id, 0, [], 0 FROM c
), v AS (
  SELECT depth, key, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars FROM m GROUP BY ALL
), kids AS (
  SELECT depth - 1 AS depth, key[1:depth - 1] AS key, count(*) AS n_children FROM v WHERE depth > 0 GROUP BY ALL
), e AS (
  SELECT depth, key, sha256(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)) AS ends_sha256
  FROM (SELECT conv_id, max(depth) AS depth, arg_max(key, depth) AS key FROM m GROUP BY conv_id) GROUP BY ALL
), f AS (
  SELECT v.*, coalesce(n_children, 0) AS n_children FROM v LEFT JOIN kids USING (depth, key)
), s AS (
  SELECT a.depth, a.key, count(*) FILTER (WHERE z.n_children = 0) AS n_leaves, CAST(sum((z.n_convs - 1) * z.chars) AS BIGINT) AS saved_tokens
  FROM f a JOIN f z ON z.depth >= a.depth AND z.key[1:a.depth] = a.key GROUP BY ALL
)
SELECT f.conv_id, f.depth, p.conv_id AS parent_conv_id, f.n_convs, f.n_children, s.n_leaves, s.saved_tokens, coalesce(ends_sha256, sha256('')) AS ends_sha256
FROM f JOIN s USING (depth, key) LEFT JOIN e USING (depth, key) LEFT JOIN f p ON p.depth = f.depth - 1 AND p.key = f.key[1:f.depth - 1]
"""


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling.count_words(table(spark, sf_dir, "documents"))
    return spelling.group_variants(words)


OP13_SQL = f"""
WITH RECURSIVE u AS (
  SELECT doc_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
), runs AS (
  SELECT doc_id, run, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[a-zÀ-ÿ]+')) AS run FROM u) WHERE length(run) >= 7 GROUP BY ALL
), hashed AS (
  SELECT run, n, {_crc32_sql("x")} AS h FROM (SELECT *, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS x FROM runs)
), written AS (
  SELECT CASE WHEN h % 31 = 0 THEN substring(run, 1, h % length(run)) || substring(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed
), w AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM written WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2
), cut AS (
  SELECT word, n, i, substring(word, 1, i) || substring(word, i + 2) AS rest FROM (SELECT word, n, unnest(range(length(word))) AS i FROM w)
), near AS (
  SELECT a.word, b.word AS other, b.n AS m FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND length(a.word) = length(b.word) AND a.word <> b.word
  UNION SELECT cut.word, w.word, w.n FROM cut JOIN w ON w.word = rest
  UNION SELECT w.word, cut.word, cut.n FROM cut JOIN w ON w.word = rest
), best AS (
  SELECT word, count(*) AS n_near, arg_min({{'o': other, 'm': m}}, {{'m': -m, 'o': other}}) AS b FROM near GROUP BY word
), forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN b.m >= 10 * w.n THEN b.o END AS form, CASE WHEN b.m >= 10 * w.n THEN b.m END AS form_n FROM w LEFT JOIN best USING (word)
), walk(word, root) AS (
  SELECT word, word FROM forms UNION ALL SELECT walk.word, forms.form FROM walk JOIN forms ON forms.word = walk.root WHERE forms.form IS NOT NULL
), last AS (
  SELECT walk.word, walk.root FROM walk JOIN forms ON forms.word = walk.root WHERE forms.form IS NULL
)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN last USING (word)
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_html_text, op2_packing, op3_line_dedup, op4_url_rules, op5_toxicity, op6_embedding_dedup, op7_secrets, op8_token_store, op9_decontamination, op10_simhash, op11_suffix_dedup, op12_prefix_trie, op13_spelling)
}
ORACLE = {"op3_line_dedup": OP3_SQL, "op4_url_rules": OP4_SQL, "op6_embedding_dedup": OP6_SQL, "op11_suffix_dedup": OP11_SQL, "op12_prefix_trie": OP12_SQL, "op13_spelling": OP13_SQL}
