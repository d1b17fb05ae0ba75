"""The same queries as DuckDB SQL over the driver's tables."""

from __future__ import annotations

from tweetflow.operators.throughput import BATCH_SIZES
from tweetflow.plans.feed import CONVERSATIONS_EPOCH, DOCUMENTS_EPOCH, LEXICON

_FORMAT = "'%a %b %d %H:%M:%S PDT %Y'"
_MENTION = r"'@[\p{L}\p{N}_]+'"

_EVENT_MESSAGES = f"""
  SELECT
    CASE WHEN event_id % 79 = 0 THEN 'not a date' ELSE strftime(ts, {_FORMAT}) END AS date,
    CASE WHEN event_id % 89 = 0 THEN NULL
         WHEN event_type = 'purchase' THEN 'positive'
         WHEN event_type = 'signup' THEN 'Positive'
         WHEN event_type = 'error' THEN 'negative'
         ELSE 'neutral' END AS sentiment,
    CASE WHEN event_id % 97 = 0 THEN NULL
         WHEN event_id % 101 = 0 THEN ''
         WHEN event_id % 11 = 0 THEN '@user' || CAST(user_id AS VARCHAR)
         WHEN event_id % 5 = 0 THEN body
         ELSE '@user' || CAST(user_id AS VARCHAR) || ' ' || body
              || CASE WHEN event_id % 3 = 0 THEN ' @support' ELSE '' END
              || CASE WHEN event_id % 13 = 0 THEN ' @josé' ELSE '' END END AS text,
    CASE WHEN event_id % 83 = 0 THEN '' ELSE 'user' || CAST(user_id AS VARCHAR) END AS "user"
  FROM (SELECT *, event_type || repeat(' ' || event_type, CAST(floor(value) AS BIGINT) % 4)
                  || ' ' || props AS body
        FROM events)"""

_DOCUMENT_MESSAGES = f"""
  SELECT
    strftime(epoch_ms(({DOCUMENTS_EPOCH} + doc_id * 61) * 1000), {_FORMAT}) AS date,
    CASE lang WHEN 'en' THEN 'positive' WHEN 'de' THEN 'negative' WHEN 'fr' THEN 'neutral' END
      AS sentiment,
    CASE WHEN doc_id % 7 = 0 THEN text
         ELSE '@' || source || ' ' || text
              || CASE WHEN doc_id % 4 = 0 THEN ' @' || lang || ' @' || source ELSE '' END END
      AS text,
    source AS "user"
  FROM documents"""

_CONVERSATION_MESSAGES = f"""
  SELECT
    strftime(epoch_ms(({CONVERSATIONS_EPOCH} + conv_id * 3600 + turn * 30) * 1000), {_FORMAT})
      AS date,
    CASE role WHEN 'user' THEN 'positive' WHEN 'assistant' THEN 'negative' ELSE 'neutral' END
      AS sentiment,
    CASE role WHEN 'user' THEN '@assistant ' || text
              WHEN 'assistant' THEN '@user' || CAST(conv_id AS VARCHAR) || ' ' || text
              ELSE text END AS text,
    role || '_' || CAST(conv_id AS VARCHAR) AS "user"
  FROM conversations"""


def _words(words: tuple[str, ...]) -> str:
    return ", ".join(f"'{word}'" for word in words)


_TWEETS = f"""tweets AS (
{_EVENT_MESSAGES}
  UNION ALL
{_DOCUMENT_MESSAGES}
  UNION ALL
{_CONVERSATION_MESSAGES}
)"""


def _tweets_of(*messages: str) -> str:
    return f"tweets AS ({' UNION ALL '.join(messages)})"


_SILVER = rf"""silver AS (
  SELECT * FROM (
    SELECT
      try_strptime(
        regexp_replace(date, '^[A-Za-z]{{3}} (.*) [A-Z]{{3}} (\d{{4}})$', '\1 \2'),
        '%b %d %H:%M:%S %Y') AS "timestamp",
      unnest(regexp_extract_all(text, {_MENTION})) AS mention,
      regexp_replace(text, {_MENTION}, '', 'g') AS cleaned_text,
      sentiment
    FROM tweets)
  WHERE length(trim(cleaned_text)) > 0
)"""

_GOLD = rf"""gold AS (
  SELECT "timestamp", mention, cleaned_text, sentiment,
    CASE WHEN neg >= 1 AND neg >= pos THEN 'NEG'
         WHEN 1 >= pos THEN 'NEU' ELSE 'POS' END AS predicted_sentiment,
    CAST(greatest(neg, 1, pos) AS DOUBLE) / (pos + neg + 1) AS predicted_score,
    CASE WHEN neg >= 1 AND neg >= pos THEN 0
         WHEN 1 >= pos THEN CASE WHEN pos > neg THEN 1 ELSE 0 END
         ELSE 1 END AS predicted_sentiment_id,
    CASE WHEN lower(sentiment) = 'positive' THEN 1 ELSE 0 END AS sentiment_id
  FROM (
    SELECT *,
      len(list_filter(tokens, lambda w: w IN ({_words(LEXICON.positive)}))) AS pos,
      len(list_filter(tokens, lambda w: w IN ({_words(LEXICON.negative)}))) AS neg
    FROM (SELECT *, regexp_split_to_array(lower(cleaned_text), '[^\p{{L}}]+') AS tokens
          FROM silver))
)"""

_PIVOT = """pivoted AS (
  SELECT mention,
    count(*) FILTER (WHERE predicted_sentiment = 'NEG') AS "NEG",
    count(*) FILTER (WHERE predicted_sentiment = 'NEU') AS "NEU",
    count(*) FILTER (WHERE predicted_sentiment = 'POS') AS "POS",
    count(*) FILTER (WHERE predicted_sentiment NOT IN ('NEG', 'NEU', 'POS')
      OR predicted_sentiment IS NULL) AS other,
    count(*) AS total
  FROM gold GROUP BY mention
)"""

_CONFUSION = """confusion AS (
  SELECT a AS sentiment_id, p AS predicted_sentiment_id,
    count(g.sentiment_id) AS n
  FROM (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) cells(a, p)
  LEFT JOIN gold g ON g.sentiment_id = a AND g.predicted_sentiment_id = p
  GROUP BY a, p
)"""

_REPORT = """report AS (
  SELECT label, support, hits,
    CASE WHEN predicted > 0 THEN CAST(hits AS DOUBLE) / predicted ELSE 0 END AS prec,
    CASE WHEN support > 0 THEN CAST(hits AS DOUBLE) / support ELSE 0 END AS rec,
    CASE WHEN predicted + support > 0 THEN 2.0 * hits / (predicted + support) ELSE 0 END AS f1
  FROM (
    SELECT label,
      CAST(sum(n) FILTER (WHERE sentiment_id = label) AS BIGINT) AS support,
      CAST(sum(n) FILTER (WHERE predicted_sentiment_id = label) AS BIGINT) AS predicted,
      CAST(sum(n) FILTER (WHERE sentiment_id = label AND predicted_sentiment_id = label) AS BIGINT)
        AS hits
    FROM (VALUES (0), (1)) labels(label), confusion GROUP BY label)
)"""

_EVALUATION = """evaluation AS (
  SELECT CAST(sum(hits) AS DOUBLE) / sum(support) AS accuracy,
    sum(prec * support) / sum(support) AS weighted_precision,
    sum(rec * support) / sum(support) AS weighted_recall,
    sum(f1 * support) / sum(support) AS weighted_f1,
    CAST(sum(support) AS BIGINT) AS n_rows
  FROM report
)"""

_PROGRESS = """progress AS (
  SELECT event_type AS query, event_id AS batch_id, ts, event_id % 50 AS input_rows,
    CASE WHEN event_id % 50 <> 0 THEN CAST(floor(value * 10) AS BIGINT) END AS processing_time
  FROM events
)"""

_LABEL_SCORES = """scores AS (
  SELECT event_id, e.label, e.score, e.position
  FROM (
    SELECT event_id, unnest(list_transform(
      CASE event_id % 6
        WHEN 0 THEN [{'label': 'NEG', 'score': neg, 'position': 0},
                     {'label': 'NEU', 'score': neu, 'position': 1},
                     {'label': 'POS', 'score': pos, 'position': 2}]
        WHEN 1 THEN [{'label': 'POS', 'score': pos, 'position': 0},
                     {'label': 'NEU', 'score': neu, 'position': 1},
                     {'label': 'NEG', 'score': neg, 'position': 2}]
        WHEN 2 THEN [{'label': 'NEU', 'score': neu, 'position': 0},
                     {'label': 'NEG', 'score': neg, 'position': 1},
                     {'label': 'POS', 'score': pos, 'position': 2}]
        WHEN 3 THEN [{'label': 'NEU', 'score': neu, 'position': 0},
                     {'label': 'POS', 'score': pos, 'position': 1},
                     {'label': 'NEG', 'score': neg, 'position': 2}]
        WHEN 4 THEN [{'label': 'X', 'score': neu, 'position': 0},
                     {'label': 'POS', 'score': pos, 'position': 1},
                     {'label': 'NEG', 'score': neg, 'position': 2}]
        ELSE [{'label': 'NEU', 'score': neu, 'position': 0}] END,
      lambda s: s)) AS e
    FROM (SELECT event_id,
            CAST(CAST(floor(value) AS BIGINT) % 5 AS DOUBLE) / 4 AS pos,
            CAST(user_id % 5 AS DOUBLE) / 4 AS neg,
            CAST(event_id % 5 AS DOUBLE) / 4 AS neu
          FROM events))
)"""


def _columns(kind: str, *names: str) -> dict[str, tuple[str, str]]:
    """What is counted for a column of a layer, and the column's type."""
    return {name: (f'"{name}"', kind) for name in names}


_BRONZE_COLUMNS = _columns("string", "date", "sentiment", "text", "user") | {
    "source_file": ("*", "string"),
    "processing_time": ("*", "timestamp"),
}
_SILVER_COLUMNS = _columns("timestamp", "timestamp") | _columns("string", "mention", "cleaned_text", "sentiment")
_GOLD_COLUMNS = (
    _columns("string", "predicted_sentiment")
    | _columns("double", "predicted_score")
    | _columns("int", "predicted_sentiment_id", "sentiment_id")
)


def _with(*parts: str, select: str) -> str:
    return f"WITH {', '.join(parts)}\n{select}"


def oracle_sql() -> dict[str, str]:
    layers = (_TWEETS, _SILVER, _GOLD)

    def tweets(select: str) -> str:
        return _with(_TWEETS, select=select)

    def gold(select: str) -> str:
        return _with(*layers, select=select)

    def pivot(select: str) -> str:
        return _with(*layers, _PIVOT, select=select)

    def evaluated(select: str) -> str:
        return _with(*layers, _CONFUSION, _REPORT, _EVALUATION, select=select)

    raw = 'SELECT date, sentiment, text, "user" FROM tweets'
    silver = 'SELECT "timestamp", mention, cleaned_text, sentiment FROM silver'
    app_table = gold(
        'SELECT min("timestamp") AS min_timestamp, max("timestamp") AS max_timestamp, mention,'
        " count(*) FILTER (WHERE predicted_sentiment = 'NEG') AS negative,"
        " count(*) FILTER (WHERE predicted_sentiment = 'NEU') AS neutral,"
        " count(*) FILTER (WHERE predicted_sentiment = 'POS') AS positive,"
        " count(*) AS total FROM gold GROUP BY mention"
    )
    missing = {
        c: f"count(*) FILTER (WHERE \"{c}\" IS NULL OR \"{c}\" = '')"
        for c in ("date", "sentiment", "text", "user")
    }
    cleaned = f"trim(regexp_replace(text, {_MENTION}, '', 'g'))"
    only_mentions = f"count(*) FILTER (WHERE {cleaned} = '')"
    series = (
        "CAST(sum(input_rows) AS BIGINT) AS input_rows,"
        " round(avg(processing_time), 6) AS avg_processing_time, count(*) AS n_batches"
    )
    windows = _with(
        _PROGRESS,
        select="SELECT query, time_bucket(INTERVAL 10 SECONDS, ts) AS window_start,"
        f" {series} FROM progress GROUP BY 1, 2",
    )
    metrics = (
        " UNION ALL ".join(
            f"SELECT '{m}' AS metric, round(CAST({m} AS DOUBLE), 9) AS value FROM evaluation"
            for m in ("accuracy", "weighted_precision", "weighted_recall", "weighted_f1", "n_rows")
        )
        + " UNION ALL SELECT 'n_' || sentiment_id || '_' || predicted_sentiment_id, CAST(n AS DOUBLE) FROM confusion"
    )
    with_corrupt = tweets(
        f"SELECT *, CAST(NULL AS VARCHAR) AS _corrupt_record FROM ({raw})"
        " UNION ALL SELECT NULL, NULL, NULL, NULL,"
        " '{\"bad ' || CAST(event_id AS VARCHAR) FROM events"
    )
    return {
        "bronze_scan": tweets(raw),
        "silver_mentions": _with(_TWEETS, _SILVER, select=silver),
        "gold_scored": gold("SELECT * FROM gold"),
        "gold_direct": gold("SELECT * FROM gold"),
        "gold_pandas_udf": gold("SELECT * FROM gold"),
        "label_rule": _with(
            _LABEL_SCORES,
            "ranked AS (SELECT *, row_number() OVER"
            " (PARTITION BY event_id ORDER BY score DESC, position) AS r FROM scores)",
            select="SELECT a.event_id, a.label, a.score,"
            " CASE WHEN a.label = 'POS' OR (a.label = 'NEU' AND b.label = 'POS') THEN 1 ELSE 0 END"
            ' AS "binary" FROM ranked a'
            " LEFT JOIN ranked b ON b.event_id = a.event_id AND b.r = 2 WHERE a.r = 1",
        ),
        "mention_app_table": app_table,
        "mention_pivot": pivot("SELECT * FROM pivoted"),
        "mention_ranking": pivot("SELECT * FROM pivoted ORDER BY total DESC, mention"),
        "mention_total": gold("SELECT count(*) AS total_mentions FROM gold"),
        "top_mentions_total": pivot("SELECT * FROM pivoted ORDER BY total DESC, mention LIMIT 20"),
        "top_mentions_positive": pivot(
            'SELECT mention, "POS" FROM pivoted ORDER BY "POS" DESC, mention LIMIT 20'
        ),
        "top_mentions_negative": pivot(
            'SELECT mention, "NEG" FROM pivoted ORDER BY "NEG" DESC, mention LIMIT 20'
        ),
        "null_profile": tweets(
            " UNION ALL ".join(
                f"SELECT '{c}' AS column_name, {n} AS n_missing FROM tweets"
                for c, n in missing.items()
            )
        ),
        "tweets_per_user": tweets(
            'SELECT "user", count(*) AS n_tweets FROM tweets GROUP BY "user"'
            ' ORDER BY n_tweets DESC, "user"'
        ),
        "top_users": tweets(
            'SELECT "user", count(*) AS n_tweets FROM tweets GROUP BY "user"'
            ' ORDER BY n_tweets DESC, "user" LIMIT 20'
        ),
        "mention_presence": tweets(
            "SELECT CASE WHEN text LIKE '%@%' THEN 1 ELSE 0 END AS has_mention,"
            " count(*) AS n_tweets FROM tweets GROUP BY 1"
        ),
        "only_mention_count": tweets(f"SELECT {only_mentions} AS n_only_mention FROM tweets"),
        "length_distribution": tweets(
            f"SELECT CAST(length({cleaned}) AS INTEGER) AS char_length, count(*) AS n_tweets"
            " FROM tweets GROUP BY 1"
        ),
        "quality_summary": tweets(
            "SELECT count(*) AS n_tweets, "
            + ", ".join(f"{n} AS missing_{c}" for c, n in missing.items())
            + ", count(*) FILTER (WHERE text LIKE '%@%') AS n_with_mention,"
            f" {only_mentions} AS n_only_mention FROM tweets"
        ),
        "confusion_matrix": _with(*layers, _CONFUSION, select="SELECT * FROM confusion"),
        "class_report": evaluated(
            "SELECT label, round(prec, 9) AS prec, round(rec, 9) AS rec, round(f1, 9) AS f1,"
            " support FROM report"
        ),
        "eval_weighted": evaluated(
            "SELECT round(accuracy, 9) AS accuracy,"
            " round(weighted_precision, 9) AS weighted_precision,"
            " round(weighted_recall, 9) AS weighted_recall,"
            " round(weighted_f1, 9) AS weighted_f1, n_rows FROM evaluation"
        ),
        "bronze_stream": tweets(raw),
        "silver_stream": _with(_TWEETS, _SILVER, select=silver),
        "gold_stream": gold("SELECT * FROM gold"),
        "gold_stream_pandas_udf": gold("SELECT * FROM gold"),
        "streamed_app_table": app_table,
        "continuous_app_table": app_table,
        "stage_report": gold(
            "SELECT 'bronze' AS stage, count(*) AS written_rows FROM tweets"
            " UNION ALL SELECT 'silver', count(*) FROM silver"
            " UNION ALL SELECT 'gold', count(*) FROM gold"
        ),
        "layer_counts": gold(
            "SELECT 'bronze' AS layer, count(*) AS n_rows FROM tweets"
            " UNION ALL SELECT 'silver', count(*) FROM silver"
            " UNION ALL SELECT 'gold', count(*) FROM gold"
        ),
        "json_declared_scan": tweets(raw),
        "json_inferred_scan": tweets(raw),
        "schema_merge": (
            f'SELECT *, CAST(NULL AS INTEGER) AS n_letters FROM ({_EVENT_MESSAGES})'
            f" UNION ALL SELECT *, CAST(NULL AS INTEGER) FROM ({_CONVERSATION_MESSAGES})"
            f" UNION ALL SELECT *, CAST(length(text) AS INTEGER) FROM ({_DOCUMENT_MESSAGES})"
        ),
        "archived_ingest": tweets(f"SELECT *, 0 AS n_left FROM ({raw})"),
        "rescued_fields": (
            f'SELECT *, CAST(NULL AS INTEGER) AS n_letters, CAST(NULL AS INTEGER) AS n_left FROM ({_EVENT_MESSAGES})'
            f" UNION ALL SELECT *, CAST(length(text) AS INTEGER), NULL FROM ({_CONVERSATION_MESSAGES})"
            f" UNION ALL SELECT *, CAST(length(text) AS INTEGER), NULL FROM ({_DOCUMENT_MESSAGES})"
        ),
        "trained_scorer": _with(
            _TWEETS, _SILVER,
            select="SELECT count(*) AS n_held_out, TRUE AS has_learned FROM silver"
            " WHERE lower(sentiment) IN ('positive', 'neutral', 'negative') AND substr(md5(cleaned_text), 1, 1) < '5'",
        ),
        "trained_gold_stream": _with(
            _TWEETS, _SILVER, select="SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_differing FROM silver"
        ),
        "corrupt_rows": with_corrupt,
        "corrupt_stream": with_corrupt,
        "replay_feed": tweets(raw),
        "compact_table": _with(_TWEETS, _SILVER, select=silver),
        "table_version": gold(
            "SELECT 'bronze' AS layer, 2 AS version, count(*) AS n_rows FROM tweets"
            " UNION ALL SELECT 'silver', 2, count(*) FROM silver"
            " UNION ALL SELECT 'gold', 2, count(*) FROM gold"
        ),
        "run_log": evaluated(
            "SELECT 'lexicon' AS run_name, 'lexicon-11' AS model_name, true AS of_this_version,"
            f" metric, value FROM ({metrics})"
        ),
        "progress_by_query": _with(
            _PROGRESS, select=f"SELECT query, {series} FROM progress GROUP BY query"
        ),
        "progress_by_window": windows,
        "progress_elapsed": _with(
            _PROGRESS,
            select="SELECT query, batch_id,"
            " CAST(date_diff('microsecond', first_ts, ts) AS DOUBLE) / 1000000 AS elapsed_time,"
            " input_rows, processing_time"
            " FROM progress JOIN"
            " (SELECT query, min(ts) AS first_ts FROM progress GROUP BY query) USING (query)",
        ),
        "active_streams": tweets(
            "SELECT 'bronze_stream' AS name, TRUE AS is_active, count(*) AS n_messages FROM tweets"
        ),
        "newest_files": tweets(
            "SELECT TRUE AS complete, TRUE AS in_order, count(*) AS n_messages FROM tweets"
        ),
        "replay_rounds": tweets(f"{raw} UNION ALL {raw}"),
        "bronze_provenance": tweets(
            "SELECT count(*) AS n_messages, count(*) AS n_from_listed_files, count(*) AS n_in_time FROM tweets"
        ),
        "compacted_read": _with(_TWEETS, _SILVER, select=silver),
        "table_as_of": _with(
            _tweets_of(_EVENT_MESSAGES, _DOCUMENT_MESSAGES), _SILVER, _GOLD, select="SELECT * FROM gold"
        ),
        "evaluation_as_of": _with(
            _tweets_of(_EVENT_MESSAGES), _SILVER, _GOLD, _CONFUSION, _REPORT, _EVALUATION,
            f"metrics AS ({metrics})",
            select="SELECT metric, value, value AS logged FROM metrics",
        ),
        "progress_history": (
            "SELECT CAST(0 AS BIGINT) AS first_batch, count(*) AS input_rows FROM events"
            " UNION ALL SELECT 1, (SELECT count(*) FROM documents) + (SELECT count(*) FROM conversations)"
        ),
        "running_windows": windows,
        "mention_partials": app_table,
        "quality_report": tweets(
            " UNION ALL ".join(
                f"SELECT 'null_profile' AS section, '{c}' AS key, {n} AS n FROM tweets"
                for c, n in (missing | dict.fromkeys(("source_file", "processing_time"), "count(*) FILTER (WHERE false)")).items()
            )
            + " UNION ALL SELECT * FROM (SELECT 'top_users', \"user\", count(*) AS n FROM tweets"
            ' GROUP BY "user" ORDER BY n DESC, "user" LIMIT 20)'
            " UNION ALL SELECT 'mention_presence', CASE WHEN text LIKE '%@%' THEN '1' ELSE '0' END, count(*)"
            " FROM tweets GROUP BY 2"
            f" UNION ALL SELECT 'only_mention_count', '', {only_mentions} FROM tweets"
            f" UNION ALL SELECT 'length_distribution', CAST(length({cleaned}) AS VARCHAR), count(*)"
            " FROM tweets GROUP BY 2"
        ),
        "mention_report": pivot(
            "SELECT 'total_mentions' AS section, '' AS key, count(*) AS n FROM gold"
            + "".join(
                f" UNION ALL SELECT * FROM (SELECT 'top_{name}', mention, {column} FROM pivoted"
                f" ORDER BY {column} DESC, mention LIMIT 20)"
                for name, column in (("total", "total"), ("positive", '"POS"'), ("negative", '"NEG"'))
            )
        ),
        "progress_report": _with(
            _PROGRESS,
            select="SELECT 'input_rows' AS section, query AS key, CAST(sum(input_rows) AS BIGINT) AS n"
            " FROM progress GROUP BY query"
            " UNION ALL SELECT 'windows', query, count(DISTINCT time_bucket(INTERVAL 10 SECONDS, ts))"
            " FROM progress GROUP BY query"
            " UNION ALL SELECT 'batches', query, count(*) FROM progress GROUP BY query",
        ),
        "layer_report": gold(
            " UNION ALL ".join(
                f"SELECT '{layer}' AS layer, '{column}' AS column_name, '{kind}' AS type,"
                f' count({value}) AS n_values, count(*) AS n_rows FROM {source}'
                for layer, source, columns in (
                    ("bronze", "tweets", _BRONZE_COLUMNS),
                    ("silver", "silver", _SILVER_COLUMNS),
                    ("gold", "gold", _SILVER_COLUMNS | _GOLD_COLUMNS),
                )
                for column, (value, kind) in columns.items()
            )
        ),
        "landing_files": tweets("SELECT 0 AS n_unread_files, count(*) AS n_messages FROM tweets"),
        "landing_file_count": tweets("SELECT TRUE AS complete, count(*) AS n_messages FROM tweets"),
        "stream_progress": tweets(
            "SELECT 'bronze_stream' AS query, count(*) AS input_rows,"
            " CAST(0 AS DOUBLE) AS first_elapsed FROM tweets"
        ),
        "scoring_throughput": gold(
            "SELECT CAST(b AS INTEGER) AS batch_size, (SELECT count(*) FROM silver) AS n_rows"
            f" FROM (VALUES {', '.join(f'({b})' for b in BATCH_SIZES)}) sizes(b)"
        ),
        "stream_input_rows": tweets(
            "SELECT 'bronze_stream' AS query, count(*) AS input_rows FROM tweets"
        ),
    }
