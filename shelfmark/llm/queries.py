"""Registered queries of the training-data operators: each over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shelfmark.llm.common import documents, new_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn
    return register


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query()
def op1_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shelfmark.llm.token_file import read_tokens, write_tokens

    path = new_path(spark, "token-file")
    write_tokens(documents(spark, sf_dir), path, vocabulary("byte_bpe_50k.json"), end_id=0)
    return read_tokens(spark, path, kind="digest")


@query()
def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shelfmark.llm.token_counts import token_counts

    return token_counts(documents(spark, sf_dir), vocabulary("word_bpe_49k.json"), limit=2048)


@query("""
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))""")
def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shelfmark.llm.exact_dedup import exact_dedup

    return exact_dedup(documents(spark, sf_dir))


@query(r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
b AS (SELECT item_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, n, array_to_string(w[k:k + n - 1], ' ') AS gram FROM (SELECT item_id, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS k FROM b WHERE len(w) > 0)),
dw AS (SELECT rid, k, n, array_to_string(w[k:k + n - 1], ' ') AS gram FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)),
hits AS (SELECT rid, k, dw.n, item_id FROM dw JOIN bw USING (gram, n)),
h AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(k, k + n)) AS p FROM hits) GROUP BY rid),
i AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT rid, item_id::VARCHAR AS item FROM hits) GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (rid) LEFT JOIN i USING (rid)""")
def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shelfmark.llm.decontaminate import digest, leaks

    return digest(leaks(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), width=10))


@query()
def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shelfmark.llm.secret_scan import digest, scan

    return digest(scan(documents(spark, sf_dir), new_path(spark, "secret-ledger")))


@query()
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shelfmark.llm.toxicity import scores, train

    docs = documents(spark, sf_dir)
    return scores(docs, train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


@query(r"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
e AS (SELECT DISTINCT doc_id, array_to_string(w[k:k + 4], ' ') AS x FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS k FROM w WHERE len(w) > 0)),
s AS (SELECT doc_id, count(*) AS n FROM e GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS inter FROM e AS a JOIN e AS b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM shared JOIN s AS p ON p.doc_id = a JOIN s AS q ON q.doc_id = b WHERE 100 * inter >= 85 * (p.n + q.n - inter)),
r AS (SELECT doc_id, doc_id AS reached FROM documents UNION SELECT r.doc_id, l.b FROM r JOIN l ON l.a = r.reached),
c AS (SELECT doc_id, min(reached) AS component_id FROM r GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept FROM c LEFT JOIN s USING (doc_id)""")
def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shelfmark.llm.minhash import near_duplicates

    return near_duplicates(documents(spark, sf_dir), percent=85)


@query()
def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shelfmark.llm.packing import packed

    return packed(documents(spark, sf_dir), vocabulary("byte_bpe_50k.json"), length=2048, end_id=1, kind="digest")


@query("""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
win AS (SELECT doc_id, p * 512 + o AS k, substr(part, 2 * o + 1, 100) AS s FROM (
    SELECT doc_id, p, part, unnest(range(0, least(512, length(part) // 2 - 49))) AS o FROM (
    SELECT doc_id, p, substr(h, 1024 * p + 1, 1122) AS part FROM (SELECT doc_id, h, unnest(range(0, length(h) // 1024 + 1)) AS p FROM d)))),
hit AS (SELECT doc_id, k FROM win JOIN (SELECT s, min(doc_id) AS first FROM win GROUP BY s) USING (s) WHERE first < doc_id),
runs AS (SELECT doc_id, min(k) AS a, max(k) + 50 AS b FROM (SELECT doc_id, k, sum(fresh) OVER (PARTITION BY doc_id ORDER BY k) AS run FROM (
    SELECT doc_id, k, CASE WHEN k <= lag(k) OVER (PARTITION BY doc_id ORDER BY k) + 50 THEN 0 ELSE 1 END AS fresh FROM hit)) GROUP BY doc_id, run),
gone AS (SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans, list(a ORDER BY a) AS starts, list(b ORDER BY a) AS ends FROM runs GROUP BY doc_id)
SELECT doc_id, length(h) // 2 AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(CASE WHEN starts IS NULL THEN h ELSE array_to_string(list_transform(range(0, len(starts) + 1), lambda i:
           substr(h, 2 * coalesce(ends[i], 0) + 1, 2 * (coalesce(starts[i + 1], length(h) // 2) - coalesce(ends[i], 0)))), '') END)) AS kept_sha256
FROM d LEFT JOIN gone USING (doc_id)""")
def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shelfmark.llm.suffix_dedup import remove_repeats

    return remove_repeats(documents(spark, sf_dir), length=50)


@query("""
WITH l AS (SELECT doc_id, i AS pos, trim(ls[i], ' ') AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS ls, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM documents)),
c AS (SELECT *, len(string_split(line, ' ')) AS n FROM l WHERE line <> '' AND len(string_split(line, ' ')) >= 3),
f AS (SELECT line, n, min((doc_id, pos)) AS first FROM c GROUP BY line, n),
g AS (SELECT line, n, first, string_split(line, ' ') AS w FROM f WHERE n >= 8),
k AS (SELECT line, n, first, j, array_to_string(list_concat(w[1:j - 1], w[j + 1:]), ' ') AS k FROM (SELECT *, unnest(range(1, n + 1)) AS j FROM g)),
near AS (SELECT a.line FROM k a JOIN k b ON a.k = b.k AND a.n = b.n AND a.j = b.j WHERE b.first < a.first
         UNION SELECT a.line FROM k a JOIN g b ON a.k = b.line WHERE b.first < a.first
         UNION SELECT b.line FROM k a JOIN g b ON a.k = b.line WHERE a.first < b.first),
r AS (SELECT DISTINCT doc_id, pos FROM c JOIN f USING (line, n) WHERE (doc_id, pos) > first OR line IN (SELECT line FROM near)),
t AS (SELECT l.doc_id, count(r.pos) AS n_removed, count(*) AS n_lines, max(CASE WHEN r.pos IS NULL AND line <> '' THEN 1 ELSE 0 END) AS has_rest FROM l LEFT JOIN r ON l.doc_id = r.doc_id AND l.pos = r.pos GROUP BY l.doc_id),
x AS (SELECT d.doc_id, string_agg(raw, chr(10) ORDER BY i) AS kept FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS raw, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM documents) d LEFT JOIN r ON d.doc_id = r.doc_id AND d.i = r.pos WHERE r.pos IS NULL GROUP BY d.doc_id)
SELECT d.doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(t.n_removed, 0)::BIGINT AS n_removed,
       sha256(CASE WHEN coalesce(t.n_removed, 0) = 0 THEN coalesce(text, '') WHEN has_rest = 0 THEN '' ELSE kept END) AS kept_sha256
FROM documents d LEFT JOIN t USING (doc_id) LEFT JOIN x USING (doc_id)""")
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from shelfmark.llm.line_dedup import dedup_lines

    done = dedup_lines(documents(spark, sf_dir))
    return done.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


@query()
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shelfmark.llm.periodic import digest, periodic_runs, with_planted_runs

    return digest(periodic_runs(with_planted_runs(documents(spark, sf_dir)), least=24, times=3))


@query(r"""
WITH a AS (SELECT page_id, url, regexp_replace(regexp_replace(regexp_extract(coalesce(html, ''), '(?s)<article>(.*)</article>', 1), '</?b>', '', 'g'), '<[^>]*>', ' ', 'g') AS h FROM pages),
t AS (SELECT page_id, url, trim(regexp_replace(regexp_replace(replace(replace(replace(replace(h, '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&#x27;', chr(39)), '&amp;?', '&', 'g'), '\s+', ' ', 'g')) AS text FROM a)
SELECT page_id, url, text, length(text)::BIGINT AS n_chars FROM t""")
def op12_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shelfmark.llm.main_text import main_text

    return main_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))


@query()
def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shelfmark.llm.repair import damaged, digest

    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return digest(damaged(conversations), every=conversations)
