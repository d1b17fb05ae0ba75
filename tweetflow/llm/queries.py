"""One query per operator over its whole table, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tweetflow.llm import (
    bpe_stream,
    chat_trees,
    decontaminate,
    filter_audit,
    language_id,
    license_scan,
    line_dedup,
    prob_minhash,
    quality_net,
    secret_scan,
    sketches,
    token_alignment,
    warc_index,
)
from tweetflow.llm.frames import fold, pick, scratch, table
from tweetflow.session import configure

Query = Callable[[SparkSession, str], DataFrame]


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pick(table(spark, sf_dir, "documents"), doc_id="doc_id", text="text")


def _joined(kind: Column, start: Column, end: Column) -> Column:
    return F.concat_ws(":", kind, start.cast("string"), end.cast("string"))


def tokenizer_path() -> str:
    """Where the public byte-level vocabulary lies, here and on every executor."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def piece_path() -> str:
    """Where the public piece vocabulary lies, here and on every executor."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op1_chat_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = pick(
        table(spark, sf_dir, "conversations"), conv_id="conv_id", turn="turn", role="role", text="text"
    )
    said = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame(
        [(-7, 0, "user", said), (-7, 1, "assistant", said)],
        "conv_id bigint, turn bigint, role string, text string",
    )
    return chat_trees.read_back(*chat_trees.chat_trees(own.unionByName(extra)))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned = license_scan.scan_licenses(_texts(spark, sf_dir), drop=("text",))
    phrases, blocks = F.col("licenses.phrases"), F.col("licenses.blocks")
    base = F.transform(phrases, lambda p: p.label)
    starts = F.transform(phrases, lambda p: p.start)
    labels = F.concat(base, F.transform(blocks, lambda b: b.label))
    best = F.array_max(F.transform(blocks, lambda b: b.share))
    return scanned.select(
        "doc_id",
        F.col("licenses.n_words").alias("n_words"),
        F.size(phrases).cast("bigint").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(base)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(labels)), ",").alias("labels"),
        F.when(F.size(phrases) > 0, 1.0).otherwise(F.coalesce(best, F.lit(0.0))).alias("score"),
    )


def op3_prob_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prob_minhash.near_duplicates(_texts(spark, sf_dir)).select("doc_id", "class_id")


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = table(spark, sf_dir, "benchmark")
    found = decontaminate.decontaminate(_texts(spark, sf_dir), benchmark, drop=("text",))
    result = F.col("contamination")
    return found.select(
        "doc_id",
        result.n_words.alias("n_words"),
        result.n_hit.alias("n_hit"),
        F.size(result["items"]).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(result["items"], ","), 256).alias("items_sha256"),
        result.contaminated.alias("contaminated"),
    )


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = F.col("secrets.spans")
    said = lambda s: _joined(s.kind, s.start, s.end)
    base = F.filter(spans, lambda s: s.kind != "random")
    count = lambda kind: F.size(F.filter(spans, lambda s: s.kind == kind)).cast("bigint")
    return secret_scan.scan_secrets(_texts(spark, sf_dir), drop=("text",)).select(
        "doc_id",
        *(count(kind).alias(f"n_{kind}") for kind in secret_scan.KINDS),
        F.sha2(F.array_join(F.transform(base, said), ","), 256).alias("base_sha256"),
        F.array_join(F.transform(spans, said), ",").alias("spans"),
    )


def op6_scaled_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketches.edited_fingerprints(_texts(spark, sf_dir)).select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        "near_edited",
        "near_next",
    )


def op7_ppm_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = pick(table(spark, sf_dir, "documents"), doc_id="doc_id", text="text", lang="lang")
    model = language_id.train(docs.filter(fold("doc_id") != 1))
    named = language_id.identify(docs.select("doc_id", "text"), model, drop=("text",))
    return named.select(
        "doc_id",
        (fold("doc_id") == 1).alias("held_out"),
        F.col("language.lang").alias("lang_pred"),
        F.col("language.score").alias("score"),
    )


def op8_bpe_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = F.col("tokens.ids")
    encoded = bpe_stream.encode(_texts(spark, sf_dir), tokenizer_path(), drop=("text",), and_decode=True)
    return encoded.select(
        "doc_id",
        F.size(ids).cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(ids.cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("tokens.decoded", 256).alias("decoded_sha256"),
    )


def op9_quality_net(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _texts(spark, sf_dir)
    labels = table(spark, sf_dir, "labels")
    net = quality_net.train(docs, labels.filter(fold(labels["doc_id"]) != 1))
    return quality_net.judge(docs, net, drop=("text",)).select(
        "doc_id",
        (fold("doc_id") == 1).alias("held_out"),
        F.col("quality.score").alias("score"),
        F.col("quality.predicted").alias("predicted"),
    )


def op10_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch(spark, "warc")
    index = warc_index.write_archives(table(spark, sf_dir, "pages"), folder)
    return warc_index.read_records(index, folder).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"
    )


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    failed = filter_audit.failures(table(spark, sf_dir, "documents"))
    return filter_audit.audit(filter_audit.patterns(failed, table(spark, sf_dir, "labels")))


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _texts(spark, sf_dir)
    bitmaps = line_dedup.keep_bitmaps(docs)
    lines = F.col("deduplicated")
    return line_dedup.without_lines(docs, bitmaps, drop=("text",)).select(
        "doc_id",
        lines.n_lines.alias("n_lines"),
        lines.n_dropped.alias("n_dropped"),
        F.sha2(lines.text, 256).alias("kept_sha256"),
    )


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    measures, _ = token_alignment.align(_texts(spark, sf_dir), tokenizer_path(), piece_path())
    return measures


_QUERIES: tuple[Query, ...] = (
    op1_chat_trees,
    op2_license_scan,
    op3_prob_minhash,
    op4_decontaminate,
    op5_secret_scan,
    op6_scaled_sketch,
    op7_ppm_language,
    op8_bpe_transducer,
    op9_quality_net,
    op10_warc_index,
    op11_filter_audit,
    op12_line_dedup,
    op13_token_alignment,
)


def queries() -> dict[str, Query]:
    def bound(query: Query) -> Query:
        return lambda spark, sf_dir: query(configure(spark), sf_dir)

    return {query.__name__: bound(query) for query in _QUERIES}


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

_ESCAPED = r"replace(replace(replace({0}, '\', '\\'), '###', '\#\#\#'), '</turn>', '\</turn>')"

_OP1 = rf"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn)) AS loss_sha256,
  CAST(sum(14 + length(replace({_ESCAPED.format("role")}, ':', '\:')) + length({_ESCAPED.format("text")}))
    AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id
"""

_OP4 = f"""
WITH item_words AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_WORDS} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item, array_to_string(w[i : i + 12], ' ') AS win, least(13, len(w)) AS n
  FROM (SELECT item, w, unnest(range(1, greatest(2, len(w) - 11))) AS i FROM item_words WHERE len(w) > 0)
),
sizes AS (SELECT DISTINCT n FROM windows),
doc_words AS (SELECT doc_id, {_WORDS} AS w FROM documents),
places AS (
  SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS win
  FROM (SELECT doc_id, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM doc_words, sizes)
),
hits AS (SELECT doc_id, item, p.i, p.n FROM places p JOIN windows USING (win)),
hit_words AS (
  SELECT doc_id, count(DISTINCT k) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM hits) GROUP BY doc_id
),
hit_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc_words LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""

_OP10 = """
WITH own AS (
  SELECT page_id, url, sha1(coalesce(html, '')) AS payload_digest, strlen(coalesce(html, '')) AS payload_bytes
  FROM pages
),
best AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS top FROM own
)
SELECT page_id, payload_bytes, payload_digest, coalesce(url, '') AS url,
  CASE WHEN payload_bytes >= 1000 AND page_id < top THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id < top THEN top END AS refers_to
FROM best
"""

_OP11 = r"""
WITH marked AS (
  SELECT doc_id, coalesce(max(CASE WHEN quality = 1 THEN 1 ELSE 0 END), 0) AS good,
    coalesce(max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END), 0) AS toxic
  FROM labels GROUP BY doc_id
),
own AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents
),
failed AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    {'A': len(w) < 50,
     'B': 100 * len(list_distinct(w)) < 65 * len(w),
     'C': 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t),
     'D': regexp_matches(t, '[#$%&*|]'),
     'E': coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)} AS f
  FROM own LEFT JOIN marked USING (doc_id)
),
fails AS (
  SELECT part, good, toxic,
    (CASE WHEN f.A THEN 'A' ELSE '' END) || (CASE WHEN f.B THEN 'B' ELSE '' END) || (CASE WHEN f.C THEN 'C' ELSE '' END)
      || (CASE WHEN f.D THEN 'D' ELSE '' END) || (CASE WHEN f.E THEN 'E' ELSE '' END) AS p
  FROM failed
),
counted AS (SELECT part, p, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM fails GROUP BY part, p),
letter AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c),
orders AS (
  SELECT a.c || b.c || c.c || d.c || e.c AS o
  FROM letter a, letter b, letter c, letter d, letter e
  WHERE len(list_distinct([a.c, b.c, c.c, d.c, e.c])) = 5
),
steps AS (SELECT o, s, substr(o, s, 1) AS c, substr(o, 1, s - 1) AS before FROM orders, range(1, 6) r(s)),
judged AS (
  SELECT part, o, s, c, n, good, toxic, p, contains(p, c) AS hit,
    len(translate(p, before, '')) < len(p) AS gone
  FROM counted, steps
),
summed AS (
  SELECT part, o AS filter_order, CAST(s AS INTEGER) AS step, c,
    sum(CASE WHEN NOT hit AND NOT gone THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN hit AND NOT gone THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN hit AND gone THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN p = c THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN hit AND NOT gone THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN hit AND NOT gone THEN toxic ELSE 0 END) AS toxic_lost
  FROM judged GROUP BY part, o, s, c
)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
  CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, c) AS BIGINT) AS shapley
FROM summed
"""

_OP12 = """
WITH lines AS (
  SELECT doc_id, unnest(range(1, len(l) + 1)) AS i, unnest(l) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)
),
keyed AS (
  SELECT doc_id, i, line,
    translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
),
often AS (SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10),
judged AS (SELECT keyed.*, often.key IS NOT NULL AS gone FROM keyed LEFT JOIN often USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""


def oracle_sql() -> dict[str, str]:
    """The others learn a model, draw hashes or keep state; brute force tests them."""
    return {
        "op1_chat_trees": _OP1,
        "op4_decontaminate": _OP4,
        "op10_warc_index": _OP10,
        "op11_filter_audit": _OP11,
        "op12_line_dedup": _OP12,
    }
