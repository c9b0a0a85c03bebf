"""The same queries as plain SQL, straight from the table columns."""

COMMENT_REASON = """
    CASE WHEN event_id % 89 = 0 OR event_id % 97 = 0 THEN 'bad_lines'
         WHEN event_type NOT IN ('click', 'view') THEN 'not_interest_subreddit'
         WHEN user_id < 10 THEN 'bots'
         WHEN event_id % 11 = 0 THEN 'banned'
         WHEN event_id % 13 = 0 THEN 'crowd_control'
         WHEN event_id % 17 = 0 THEN 'non_text'
         WHEN event_id % 19 = 0 THEN 'controversial'
         WHEN event_id % 23 = 0 OR event_id % 29 = 0 THEN 'removed'
         ELSE 'kept' END"""

SUBMISSION_REASON = """
    CASE WHEN event_id % 89 = 0 OR event_id % 97 = 0 THEN 'bad_lines'
         WHEN event_type NOT IN ('click', 'view') THEN 'not_interest_subreddit'
         WHEN user_id < 10 THEN 'bots'
         WHEN event_id % 11 = 0 THEN 'quarantine'
         WHEN event_id % 13 = 0 THEN 'banned'
         WHEN event_id % 17 = 0 THEN 'removed'
         WHEN event_id % 19 = 0 THEN 'removed_category'
         WHEN event_id % 23 = 0 THEN 'over_18'
         ELSE 'kept' END"""

DOCUMENT_REASON = """
    CASE WHEN lower(d.source) NOT IN ('src0', 'src3', 'src5', 'src8', 'src9', 'src10')
              THEN 'not_interest_subreddit'
         WHEN lower(d.lang) = 'fr' THEN 'bots'
         WHEN l.quality = 0 THEN 'removed'
         WHEN l.toxic = 1 THEN 'over_18'
         ELSE 'kept' END"""

LABELLED = "documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"
COMMENTS = f"(SELECT *, {COMMENT_REASON} AS reason FROM events)"
SUBMISSIONS = f"(SELECT *, {SUBMISSION_REASON} AS reason FROM events)"

GROUPS = f"""
    SELECT event_type AS subreddit, count(*) AS n_all,
           count(CASE WHEN reason <> 'not_interest_subreddit' THEN 1 END) AS n_topic,
           count(CASE WHEN reason = 'kept' THEN 1 END) AS n_kept
    FROM {COMMENTS} WHERE reason <> 'bad_lines' GROUP BY event_type"""

BARE_NAME = "regexp_replace(url, '^.*/', '')"

REPORT_REASONS = [
    "not_interest_subreddit", "bad_lines", "bots", "banned",
    "crowd_control", "non_text", "controversial", "removed",
]
SUBMISSION_REASONS = [
    "not_interest_subreddit", "bad_lines", "bots", "quarantine", "author_blocked",
    "banned", "removed", "removed_category", "over_18",
]

_report_sums = " UNION ALL ".join(
    f"SELECT 'Lines filtered out due to {r.replace('_', ' ')}: ' ||"
    f" count(CASE WHEN reason = '{r}' THEN 1 END) FROM judged"
    for r in REPORT_REASONS
)

# What becomes of the comment columns: in every line, absent but with a default,
# absent and left NULL.
GIVEN = "author subreddit controversiality gildings"
FILLED = """
    body unrepliable_reason collapsed_reason collapsed_reason_code associated_award all_awardings awarders
    mod_reports user_reports report_reasons distinguished permalink author_fullname name approved_by"""
EMPTY = """
    created_utc retrieved_on approved_at_utc banned_at_utc author_premium author_is_blocked stickied
    score_hidden collapsed no_follow can_gild can_mod_post is_submitter send_replies archived locked saved
    author_patreon_flair likes ups downs total_awards_received num_reports gilded"""


def _audit_rows(columns, before, after):
    return " ".join(
        f"UNION ALL SELECT 'comments', '{c}', {before}, {after} FROM kept"
        for c in columns.split()
    )


def _constants(columns):
    return ", ".join(f"{value} AS {name}" for value, names in columns.items() for name in names.split())


ORACLE = {
    "lookup_list": "SELECT DISTINCT lower(trim(role)) AS item FROM conversations WHERE trim(role) <> ''",
    "base_name": f"""
        SELECT page_id, {BARE_NAME} || '.tar' AS base_name,
               CASE WHEN strpos({BARE_NAME}, '.') > 1
                    THEN regexp_replace({BARE_NAME}, '\\.[^.]*$', '') ELSE {BARE_NAME} END AS bare_name
        FROM pages""",
    "topic_semi": """
        SELECT doc_id, source FROM documents
        WHERE lower(source) IN ('src0', 'src3', 'src5', 'src8', 'src9', 'src10')""",
    "author_anti": """
        SELECT conv_id, turn, role FROM conversations
        WHERE lower(coalesce(role, '')) NOT IN ('system', '[deleted]')""",
    "pred_not_null": f"SELECT d.doc_id FROM {LABELLED} WHERE l.quality IS NOT NULL OR l.toxic IS NOT NULL",
    "pred_truthy": f"SELECT d.doc_id FROM {LABELLED} WHERE coalesce(l.toxic, 0) <> 0",
    "parse_records": f"""
        SELECT event_id, CASE WHEN reason = 'bad_lines' THEN 'bad_lines' ELSE 'ok' END AS parse_status,
               CASE WHEN reason <> 'bad_lines' THEN event_type END AS subreddit
        FROM {COMMENTS}""",
    "reason_cascade": f"SELECT d.doc_id, {DOCUMENT_REASON} AS reason FROM {LABELLED}",
    "reason_cascade_comments": f"SELECT event_id, reason FROM {COMMENTS}",
    "reason_cascade_submissions": f"SELECT event_id, reason FROM {SUBMISSIONS}",
    "stats_totals": f"""
        SELECT 'comments' AS kind, count(*) AS n_read,
               count(CASE WHEN reason = 'kept' THEN 1 END) AS n_processed,
               count(CASE WHEN reason = 'kept' THEN 1 END) AS n_written,
               count(CASE WHEN reason <> 'kept' THEN 1 END) AS n_filtered,
               CAST(0 AS BIGINT) AS n_filtered_legacy
        FROM {COMMENTS}""",
    "stats_by_reason": " UNION ALL ".join(
        f"SELECT 'submissions' AS kind, '{r}' AS reason, count(CASE WHEN reason = '{r}' THEN 1 END) AS n"
        f" FROM {SUBMISSIONS}"
        for r in SUBMISSION_REASONS
    ),
    "stats_by_group": f"SELECT 'comments' AS kind, * FROM ({GROUPS})",
    "stats_report": f"""
        WITH judged AS (SELECT * FROM {COMMENTS}), per_group AS ({GROUPS}), lines(line) AS (
            SELECT 'Total lines read: ' || count(*) FROM judged
            UNION ALL SELECT 'Total lines processed: ' || count(*) FROM judged WHERE reason = 'kept'
            UNION ALL SELECT 'Total lines kept for analysis: ' || count(*) FROM judged WHERE reason = 'kept'
            UNION ALL SELECT 'Total lines filtered out: 0'
            UNION ALL {_report_sums}
            UNION ALL SELECT '' UNION ALL SELECT ''
            UNION ALL SELECT 'Subreddit counts (including filtered lines):'
            UNION ALL SELECT subreddit || ': ' || n_all FROM per_group
            UNION ALL SELECT 'Subreddit counts (lines kept for analysis):'
            UNION ALL SELECT subreddit || ': ' || n_topic FROM per_group WHERE n_topic > 0)
        SELECT 'comments' AS kind, line FROM lines""",
    "flatten_text": """
        SELECT conv_id, turn, replace(replace(coalesce(text, ''), chr(10), ' '), chr(13), ' ') AS body
        FROM conversations""",
    "coerce_boolean": f"""
        SELECT d.doc_id, CASE WHEN l.toxic = 1 THEN true WHEN l.toxic = 0 THEN false END AS over_18
        FROM {LABELLED}""",
    "coerce_numeric": """
        SELECT event_id, CASE WHEN event_id % 10 <> 0 THEN user_id END AS score,
               CASE WHEN event_id % 10 <> 0 THEN value END AS upvote_ratio
        FROM events""",
    "epoch_ts": """
        SELECT o_orderkey,
               CASE WHEN o_orderkey % 10 <> 0 THEN o_orderdate + INTERVAL 250 MILLISECONDS END AS created
        FROM orders""",
    "json_text": f"""
        SELECT event_id, CASE WHEN reason = 'bad_lines' OR event_id % 5 = 0 THEN 'null'
                              ELSE replace(props, ' ', '') END AS props_json
        FROM {COMMENTS}""",
    "fill_defaults": f"""
        SELECT d.doc_id,
               coalesce(CASE WHEN l.quality = 1 THEN 'good' WHEN l.quality = 0 THEN 'bad' END, 'none')
                   AS distinguished,
               coalesce(CASE WHEN l.toxic = 1 THEN 'toxic' END, '') AS category
        FROM {LABELLED}""",
    "null_audit": f"""
        SELECT 'score' AS col, CAST(0 AS BIGINT) AS nulls_before,
               count(CASE WHEN event_id % 10 = 0 THEN 1 END) AS nulls_after FROM events
        UNION ALL
        SELECT 'quality', count(CASE WHEN l.quality IS NULL THEN 1 END),
               count(CASE WHEN l.quality IS NULL THEN 1 END)
        FROM {LABELLED}""",
    "null_audit_kept": f"""
        WITH kept AS (SELECT * FROM {COMMENTS} WHERE reason = 'kept')
        SELECT 'comments' AS kind, 'score' AS col, CAST(0 AS BIGINT) AS nulls_before,
               count(CASE WHEN event_id % 10 = 0 THEN 1 END) AS nulls_after FROM kept
        {_audit_rows(GIVEN, '0 * count(*)', '0')}
        {_audit_rows(FILLED, 'count(*)', '0')}
        {_audit_rows(EMPTY, 'count(*)', 'count(*)')}""",
    "clean_submissions": f"""
        SELECT CAST(d.doc_id AS VARCHAR) AS id, d.source AS subreddit, d.lang AS author, '' AS title,
               replace(replace(d.text, chr(10), ' '), chr(13), ' ') AS selftext, d.n_chars AS score,
               CASE WHEN l.quality IS NULL THEN 'none' ELSE 'labelled' END AS distinguished,
               l.quality = 1 AS is_original_content, CAST(NULL AS TIMESTAMP) AS created_utc,
               'null' AS media, '' AS permalink, CAST(NULL AS VARCHAR) AS subreddit_id
        FROM {LABELLED} WHERE {DOCUMENT_REASON} = 'kept'""",
    "clean_comments": """
        SELECT 'c' || conv_id AS link_id, 'Long' AS subreddit, role AS author,
               replace(replace(text, chr(10), ' '), chr(13), ' ') AS body, turn AS score,
               'none' AS distinguished, 'null' AS all_awardings
        FROM conversations WHERE length(text) >= 100 AND lower(role) NOT IN ('system', '[deleted]')""",
    "dup_rows": """
        SELECT doc_id, source FROM documents
        WHERE text IN (SELECT text FROM documents GROUP BY text HAVING count(*) > 1)""",
    "dup_summary": """
        SELECT count(*) AS total_rows, count(CASE WHEN c > 1 THEN 1 END) AS dup_rows,
               count(DISTINCT CASE WHEN c > 1 THEN text END) AS dup_keys
        FROM (SELECT text, count(*) OVER (PARTITION BY text) AS c FROM documents)""",
    "dup_null_keys": f"""
        SELECT count(*) AS total_rows, count(CASE WHEN c > 1 THEN 1 END) AS dup_rows,
               count(DISTINCT CASE WHEN c > 1 THEN quality END) AS dup_keys
        FROM (SELECT quality, count(*) OVER (PARTITION BY quality) AS c FROM {LABELLED})""",
    "dup_null_rows": f"""
        SELECT doc_id, quality
        FROM (SELECT d.doc_id, quality, count(*) OVER (PARTITION BY quality) AS c FROM {LABELLED})
        WHERE c > 1""",
    "dedup_keep_first": """
        SELECT doc_id, source, lang
        FROM (SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS rn FROM documents)
        WHERE rn = 1""",
    "dup_csv": """
        SELECT doc_id, text, source FROM documents
        WHERE text IN (SELECT text FROM documents GROUP BY text HAVING count(*) > 1)""",
    "zst_scan": f"""
        SELECT event_id, event_type, 'user_' || user_id AS author
        FROM {COMMENTS} WHERE reason <> 'bad_lines'""",
    "dataset_scan": """
        SELECT kind, event_type AS name, count(*) AS n
        FROM (SELECT 'comments' AS kind, event_type FROM events
              UNION ALL SELECT 'submissions', event_type FROM events)
        GROUP BY kind, event_type""",
    "csv_round_trip": "SELECT doc_id, nullif(text, '') AS text, lang, source FROM documents",
    "parquet_sink": f"""
        SELECT event_id, 'comments' AS kind, event_type AS base_name, 'User_' || user_id AS author,
               CASE WHEN event_id % 10 <> 0 THEN user_id END AS score,
               CASE WHEN event_id % 5 = 0 THEN 'null' ELSE replace(props, ' ', '') END AS gildings
        FROM {COMMENTS} WHERE reason = 'kept'""",
    "dataset_run": f"""
        SELECT event_id, 'User_' || user_id AS author,
               upper(substr(event_type, 1, 1)) || substr(event_type, 2) AS subreddit,
               CASE WHEN event_id % 10 <> 0 THEN user_id END AS score
        FROM {COMMENTS} WHERE reason = 'kept'""",
    "file_errors": """
        SELECT event_type AS name, CASE WHEN event_type = 'error' THEN 0 ELSE count(*) END AS n_read
        FROM events GROUP BY event_type""",
    "incremental_files": GROUPS,
    "zst_frames": f"""
        SELECT event_id, event_type, 'user_' || user_id AS author
        FROM {COMMENTS} WHERE reason <> 'bad_lines'""",
    "reclean_replaces": f"""
        WITH judged AS (SELECT *, CAST(reason = 'kept' AND event_type = 'click' AS INT) AS again FROM {COMMENTS})
        SELECT 'parquet' AS what, event_type AS name, CAST(sum(again) AS BIGINT) AS n FROM judged GROUP BY event_type HAVING sum(again) > 0
        UNION ALL SELECT 'csv', event_type, CAST(sum(again) AS BIGINT) FROM judged GROUP BY event_type HAVING sum(again) > 0
        UNION ALL SELECT 'totals', event_type, CAST(sum(again) AS BIGINT) FROM judged GROUP BY event_type
        UNION ALL SELECT 'audit', event_type, count(*) FROM judged WHERE again = 1 AND event_id % 10 = 0 GROUP BY event_type
        UNION ALL SELECT 'rejected', event_type, count(*) FROM judged WHERE again = 1 AND event_id % 10 = 0 GROUP BY event_type""",
    "rejected_values": f"""
        SELECT event_id, 'score' AS col, 'x' AS value FROM {COMMENTS} WHERE reason = 'kept' AND event_id % 10 = 0""",
    "incremental_errors": """
        SELECT event_type AS name, CASE WHEN event_type = 'error' THEN 0 ELSE count(*) END AS n_read
        FROM events GROUP BY event_type""",
    "dedup_incremental": """
        WITH first AS (SELECT text, min(doc_id) AS doc_id FROM documents WHERE doc_id % 2 = 0 GROUP BY text),
             later AS (SELECT text, min(doc_id) AS doc_id FROM documents
                       WHERE doc_id % 2 = 1 AND text NOT IN (SELECT text FROM first WHERE text IS NOT NULL) GROUP BY text),
             kept AS (SELECT doc_id, 0 AS delivery FROM first UNION ALL SELECT doc_id, 1 FROM later
                      UNION ALL SELECT doc_id, 1 FROM later)
        SELECT doc_id, source, delivery FROM kept JOIN documents USING (doc_id)""",
    "dup_named_key": """
        SELECT doc_id, source AS item, 1 AS n FROM documents
        WHERE text IN (SELECT text FROM documents GROUP BY text HAVING count(*) > 1)
          AND lower(source) IN ('src0', 'src3', 'src5', 'src8', 'src9', 'src10')""",
    "json_typed": f"""
        SELECT event_id, CASE event_id % 10 WHEN 0 THEN '"0"' WHEN 1 THEN '"12"' WHEN 2 THEN '"[x"' WHEN 3 THEN '"false"'
               WHEN 4 THEN 'null' WHEN 5 THEN 'null' WHEN 6 THEN '[1,"b"]' WHEN 7 THEN '{{"a":1,"a":2}}'
               WHEN 8 THEN '"{{}}"' ELSE '"plain"' END AS awarders
        FROM {COMMENTS} WHERE reason = 'kept'""",
    "clean_comments_all": f"""
        SELECT CAST(event_id AS VARCHAR) AS id, 'User_' || user_id AS author,
               upper(substr(event_type, 1, 1)) || substr(event_type, 2) AS subreddit,
               CASE WHEN event_id % 10 <> 0 THEN user_id END AS score, CAST(0 AS BIGINT) AS controversiality,
               CASE WHEN event_id % 5 = 0 THEN 'null' ELSE replace(props, ' ', '') END AS gildings, 'none' AS distinguished,
               {_constants({
                   "CAST(NULL AS VARCHAR)": "subreddit_id subreddit_type parent_id link_id",
                   "''": "author_fullname permalink name approved_by body collapsed_reason collapsed_reason_code"
                         " associated_award unrepliable_reason",
                   "CAST(NULL AS TIMESTAMP)": "created_utc retrieved_on banned_at_utc approved_at_utc",
                   "CAST(NULL AS BOOLEAN)": "author_is_blocked author_premium stickied score_hidden collapsed no_follow"
                         " can_gild can_mod_post is_submitter send_replies archived locked saved author_patreon_flair likes",
                   "CAST(NULL AS BIGINT)": "ups downs total_awards_received gilded num_reports",
                   "'null'": "all_awardings awarders mod_reports user_reports report_reasons",
               })}
        FROM {COMMENTS} WHERE reason = 'kept'""",
    "clean_submissions_all": f"""
        SELECT CAST(d.doc_id AS VARCHAR) AS id, d.source AS subreddit, d.lang AS author,
               replace(replace(coalesce(d.text, ''), chr(10), ' '), chr(13), ' ') AS selftext, d.n_chars AS score,
               CASE WHEN l.quality IS NULL THEN 'none' ELSE 'labelled' END AS distinguished,
               l.quality = 1 AS is_original_content,
               {_constants({
                   "CAST(NULL AS VARCHAR)": "subreddit_id subreddit_type",
                   "''": "author_fullname title name author_flair_text permalink url category",
                   "CAST(NULL AS TIMESTAMP)": "created_utc retrieved_on",
                   "CAST(NULL AS BOOLEAN)": "author_is_blocked stickied is_self is_video locked saved spoiler media_only"
                         " can_gild contest_mode no_follow author_premium author_patreon_flair pinned hide_score",
                   "CAST(NULL AS BIGINT)": "ups downs num_comments total_awards_received gilded num_crossposts",
                   "CAST(NULL AS DOUBLE)": "upvote_ratio",
                   "'null'": "gildings all_awardings awarders media media_metadata secure_media",
               })}
        FROM {LABELLED} WHERE {DOCUMENT_REASON} = 'kept'""",
    "csv_split": "SELECT doc_id, nullif(text, '') AS text, lang, source FROM documents",
}
