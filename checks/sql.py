"""Reference SQL for the registered queries, in the DuckDB dialect.

Every statement derives the support messages from ``events`` again and works on whole transcripts with plain SQL
(recursive threads, regular expressions over full text), independently of how the Spark operators compute.
"""

from __future__ import annotations

from checks.adapter import AGENT_TEXTS, CUSTOMER_TEXTS
from threadloom.functions import rules, sentiment
from threadloom.operators import classifiers
from threadloom.operators.cohorts import RULE_COHORTS

import json

AS_OF = "2024-02-01 10:00:00"


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def text_list(values) -> str:
    return "[" + ", ".join(text(value) for value in values) + "]"


WORD = r"[\p{L}\p{N}_]"
SPACE = r"[\t-\r\x1c-\x1f\x{85}\p{Z}]"
NOT_SPACE = r"[^\t-\r\x1c-\x1f\x{85}\p{Z}]"


def clean_text(column: str) -> str:
    steps = [(f"https?://{NOT_SPACE}+", ""), (f"@{WORD}+", "@USER"), (f"#{WORD}+", ""), (f"{SPACE}+", " ")]
    result = f"coalesce({column}, '')"
    for pattern, replacement in steps:
        result = f"regexp_replace({result}, '{pattern}', '{replacement}', 'g')"
    return f"trim({result})"


def clean_id(column: str) -> str:
    bare = f"regexp_replace({column}, '^{SPACE}+|{SPACE}+$', '', 'g')"
    return f"""CASE WHEN {column} IS NULL OR {column} IN ('', 'nan') THEN '' ELSE coalesce(
      CASE WHEN regexp_full_match({bare}, '[+-]?\\d+(\\.\\d*)?')
           THEN CAST(TRY_CAST(replace(regexp_extract({bare}, '^[+-]?\\d+'), '+', '') AS HUGEINT) AS VARCHAR) END,
      CASE WHEN regexp_full_match({bare}, '[+-]?\\.\\d+') THEN '0' END,
      CASE WHEN regexp_full_match({bare}, '[+-]?(\\d+(\\.\\d*)?|\\.\\d+)[eE][+-]?\\d+')
           THEN CAST(TRY_CAST(trunc(TRY_CAST({bare} AS DOUBLE)) AS BIGINT) AS VARCHAR) END,
      {column}) END"""


def clock(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S')"


def hits(column: str, pattern: str) -> str:
    return f"len(regexp_extract_all({column}, {text(pattern)}))"


def total_hits(column: str, patterns) -> str:
    return "(" + " + ".join(hits(column, pattern) for pattern in patterns) + ")"


def said(*words: str) -> str:
    return "(" + " OR ".join(f"contains(t, {text(word)})" for word in words) + ")"


def present(words) -> str:
    return "(" + " + ".join(f"CAST(contains(t, {text(word)}) AS INT)" for word in words) + ")"


def best(prefix: str, labels) -> str:
    top = f"greatest({', '.join(f'{prefix}_{label}' for label in labels)})"
    return "CASE " + " ".join(f"WHEN {prefix}_{label} = {top} THEN '{label}'" for label in labels) + " END"


def confidence(prefix: str, labels) -> str:
    names = [f"{prefix}_{label}" for label in labels]
    return f"CAST(greatest({', '.join(names)}) AS DOUBLE) / ({' + '.join(names)} + 1)"


def criteria(fields) -> str:
    def literal(value):
        return str(value).lower() if isinstance(value, bool) else text(value)

    tests = []
    for field, expected in fields.items():
        if isinstance(expected, list):
            tests.append(f"{field} IN ({', '.join(map(literal, expected))})")
        else:
            tests.append(f"{field} = {literal(expected)}")
    return " AND ".join(tests)


def _resolved_score() -> str:
    score = f"CAST({total_hits('t', rules.RESOLUTION_PATTERNS['resolved_positive'])} AS DOUBLE)"
    for pattern in rules.RESOLUTION_PATTERNS["resolved_confirmation"]:
        score = f"({score} + {hits('t', pattern)} * CAST(0.8 AS DOUBLE))"
    return score


def _family_columns() -> str:
    columns = [
        f"{total_hits('c', patterns)} AS {prefix}_{label}"
        for prefix, families in (
            ("urgency", rules.URGENCY_PATTERNS),
            ("nature", rules.NATURE_PATTERNS),
            ("behaviour", rules.BEHAVIOUR_PATTERNS),
        )
        for label, patterns in families.items()
    ]
    return ",\n    ".join(columns)


def _values(mapping) -> str:
    return ", ".join(f"({text(word)}, CAST({value} AS DOUBLE))" for word, value in mapping.items())


def valences(source: str) -> str:
    """Valences of the customer messages in ``source`` by joins and lags over word positions."""
    return f"""
spoken AS (SELECT conversation_id, sequence_number, message_text AS said,
    regexp_extract_all(message_text, {text(sentiment.TOKEN)}) AS words FROM {source} WHERE is_customer),
placed AS (SELECT conversation_id, sequence_number, nth, lower(raw) AS word, raw = upper(raw) AND raw <> lower(raw) AS loud
    FROM (SELECT conversation_id, sequence_number, unnest(words) AS raw, generate_subscripts(words, 1) AS nth FROM spoken)),
around AS (SELECT *, lag(word, 1) OVER w AS w1, lag(word, 2) OVER w AS w2, lag(word, 3) OVER w AS w3,
    lag(loud, 1) OVER w AS l1, lag(loud, 2) OVER w AS l2, lag(loud, 3) OVER w AS l3,
    bool_or(NOT loud) OVER m AS mixed, min(CASE WHEN word = 'but' THEN nth END) OVER m AS turn
    FROM placed WINDOW w AS (PARTITION BY conversation_id, sequence_number ORDER BY nth),
    m AS (PARTITION BY conversation_id, sequence_number)),
lexicon(word, valence) AS (VALUES {_values(sentiment.LEXICON)}),
boosters(word, boost) AS (VALUES {_values(sentiment.BOOSTERS)}),
word_values AS (SELECT a.conversation_id, a.sequence_number,
    (l.valence + sign(l.valence) * (CASE WHEN loud AND mixed THEN CAST(0.733 AS DOUBLE) ELSE 0 END
        + coalesce(b1.boost + CASE WHEN l1 AND mixed THEN CAST(0.733 AS DOUBLE) ELSE 0 END, 0)
        + coalesce(b2.boost + CASE WHEN l2 AND mixed THEN CAST(0.733 AS DOUBLE) ELSE 0 END, 0) * CAST(0.95 AS DOUBLE)
        + coalesce(b3.boost + CASE WHEN l3 AND mixed THEN CAST(0.733 AS DOUBLE) ELSE 0 END, 0) * CAST(0.9 AS DOUBLE)))
    * CASE WHEN list_has_any({text_list(sentiment.NEGATORS)}, [coalesce(w1, ''), coalesce(w2, ''), coalesce(w3, '')])
        THEN CAST(-0.74 AS DOUBLE) ELSE CAST(1 AS DOUBLE) END
    * CASE WHEN nth < turn THEN CAST(0.5 AS DOUBLE) WHEN nth > turn THEN CAST(1.5 AS DOUBLE) ELSE CAST(1 AS DOUBLE) END AS valence
    FROM around a JOIN lexicon l ON a.word = l.word
    LEFT JOIN boosters b1 ON b1.word = w1 LEFT JOIN boosters b2 ON b2.word = w2 LEFT JOIN boosters b3 ON b3.word = w3),
marks AS (SELECT conversation_id, sequence_number, length(said) - length(replace(said, '!', '')) AS cries,
    length(said) - length(replace(said, '?', '')) AS questions FROM spoken),
valued AS (SELECT conversation_id, sequence_number, valence + sign(valence) * (least(cries, 4) * CAST(0.292 AS DOUBLE)
    + CASE WHEN questions > 3 THEN CAST(0.96 AS DOUBLE) WHEN questions > 1 THEN questions * CAST(0.18 AS DOUBLE)
        ELSE CAST(0 AS DOUBLE) END) AS valence
    FROM (SELECT conversation_id, sequence_number, sum(valence) AS valence FROM word_values GROUP BY ALL)
    JOIN marks USING (conversation_id, sequence_number)),
valence_totals AS (SELECT conversation_id, sum(valence) AS valence FROM valued GROUP BY conversation_id)"""


def _analysis_ctes(source: str) -> dict[str, str]:
    natures, behaviours = list(rules.NATURE_PATTERNS), list(rules.BEHAVIOUR_PATTERNS)
    issues = "[" + ", ".join(f"CASE WHEN contains(c, {text(w)}) THEN {text(w)} END" for w in rules.ISSUE_WORDS) + "]"
    return {
        "transcripts": f"""transcripts AS (SELECT conversation_id,
    string_agg(CASE WHEN is_customer THEN 'CUSTOMER: ' ELSE 'AGENT: ' END || author_id || ': ' || message_text, ' | '
        ORDER BY sequence_number) AS full_conversation,
    count(*) AS message_count, min(created_at) AS start_time, max(created_at) AS end_time
    FROM {source} GROUP BY conversation_id)""",
        "heard": """split_up AS (SELECT conversation_id, message_count, lower(full_conversation) AS t,
    string_split(full_conversation, ' | ') AS pieces FROM transcripts),
heard AS (SELECT *, lower(array_to_string(customer_list, ' ')) AS c FROM (
    SELECT *, list_transform(list_filter(pieces,
        lambda p: contains(p, 'CUSTOMER:') AND len(string_split(p, ':')) >= 3),
        lambda p: trim(regexp_extract(p, '^[^:]*:[^:]*:(.*)$', 1))) AS customer_list FROM split_up))""",
        "valence": valences(source),
        "scores": f"""scores AS (SELECT conversation_id, message_count, t, c, len(pieces) AS piece_count,
    len(customer_list) AS customer_messages,
    {_resolved_score()} AS resolved_score,
    {total_hits('t', rules.RESOLUTION_PATTERNS['unresolved_indicators'])} AS unresolved_score,
    {_family_columns()}
    FROM heard)""",
        "judged": f"""judged AS (SELECT s.*,
    resolved_score > unresolved_score AND resolved_score > 0 AS rule_resolved,
    CASE WHEN resolved_score > unresolved_score AND resolved_score > 0
        THEN least(resolved_score / (resolved_score + unresolved_score + 1), CAST(0.95 AS DOUBLE))
        ELSE least(unresolved_score / (resolved_score + unresolved_score + 1), CAST(0.85 AS DOUBLE)) END AS rule_confidence,
    CASE WHEN urgency_critical > 0 THEN 'critical' WHEN urgency_high > 0 THEN 'high'
        WHEN urgency_low > urgency_medium THEN 'low' ELSE 'medium' END AS rule_urgency,
    {best('nature', natures)} AS rule_nature, {confidence('nature', natures)} AS nature_confidence,
    {best('behaviour', behaviours)} AS rule_behaviour, {confidence('behaviour', behaviours)} AS behavior_confidence,
    round(coalesce(v.valence, 0) / sqrt(coalesce(v.valence, 0) * coalesce(v.valence, 0) + 15), 4) AS compound
    FROM scores s LEFT JOIN valence_totals v USING (conversation_id))""",
        "assessed": f"""moods AS (SELECT *, CASE WHEN compound >= 0.05 THEN 'positive' WHEN compound <= -0.5 THEN 'frustrated'
        WHEN compound <= -0.05 THEN 'negative' ELSE 'neutral' END AS rule_sentiment,
    CASE WHEN abs(compound) >= 0.05 THEN abs(compound) ELSE 1 - abs(compound) END AS sentiment_confidence FROM judged),
drafts AS (SELECT *,
    list_filter([CASE WHEN rule_nature <> 'general' THEN rule_nature || '_issue' END,
        CASE WHEN rule_sentiment <> 'neutral' THEN rule_sentiment || '_customer' END,
        CASE WHEN rule_urgency IN ('critical', 'high') THEN rule_urgency || '_urgency' END,
        CASE WHEN {said('escalat')} THEN 'escalation' END,
        CASE WHEN {said('first', 'new', 'never')} THEN 'first_time_customer' END,
        CASE WHEN {said('again', 'before', 'previous')} THEN 'repeat_customer' END,
        CASE WHEN {said('thank', 'appreciate')} THEN 'polite_customer' END],
        lambda x: x IS NOT NULL)[1:5] AS rule_tags,
    CASE WHEN piece_count <= 2 THEN 'simple_inquiry' WHEN {said('escalat', 'manager')} THEN 'escalation'
        WHEN piece_count > 6 THEN 'complex_issue' ELSE 'follow_up' END AS rule_type,
    list_filter({issues}, lambda x: x IS NOT NULL)[1:3] AS rule_issues,
    {present(rules.GOOD_AGENT_WORDS)} AS good_words, {present(rules.POOR_AGENT_WORDS)} AS poor_words
    FROM moods),
assessed AS (SELECT conversation_id, message_count, piece_count, customer_messages, resolved_score, unresolved_score,
    urgency_critical, urgency_high, urgency_medium, urgency_low, nature_confidence, behavior_confidence, compound,
    sentiment_confidence,
    customer_messages > 0 AND rule_resolved AS is_resolved,
    CASE WHEN customer_messages > 0 THEN rule_confidence ELSE 0.5 END AS resolution_confidence,
    CASE WHEN customer_messages > 0 THEN rule_tags ELSE ['analysis_failed'] END AS tags,
    CASE WHEN customer_messages > 0 THEN rule_nature ELSE 'general' END AS nature_of_request,
    CASE WHEN customer_messages > 0 THEN rule_sentiment ELSE 'neutral' END AS customer_sentiment,
    CASE WHEN customer_messages > 0 THEN rule_urgency ELSE 'medium' END AS urgency_level,
    CASE WHEN customer_messages > 0 THEN rule_type ELSE 'simple_inquiry' END AS conversation_type,
    CASE WHEN customer_messages > 0 THEN rule_behaviour ELSE 'neutral' END AS customer_behavior,
    CASE WHEN customer_messages = 0 THEN 'Unable to analyze conversation'
        WHEN rule_resolved THEN 'Customer''s ' || rule_nature || ' issue was successfully resolved'
        ELSE 'Customer''s ' || rule_nature || ' issue remains unresolved' END AS resolution_summary,
    CASE WHEN customer_messages > 0 THEN rule_issues ELSE ['unknown'] END AS key_issues,
    CASE WHEN customer_messages = 0 THEN 'fair' WHEN good_words > poor_words AND good_words > 0 THEN 'good'
        WHEN poor_words > good_words THEN 'poor' ELSE 'fair' END AS agent_performance,
    customer_messages > 0 AND (rule_confidence < 0.6 OR nature_confidence < 0.6 OR behavior_confidence < 0.6
        OR (rule_nature IN ('complaint', 'technical') AND rule_sentiment IN ('frustrated', 'angry'))) AS needs_llm
    FROM drafts)""",
    }


def _rule_cohort_union() -> str:
    return "\n    UNION ALL ".join(
        f"SELECT conversation_id, 0 AS kind, {n} AS position, CAST(NULL AS VARCHAR) AS tag FROM assessed"
        f" WHERE {criteria(each['criteria'])}"
        for n, each in enumerate(RULE_COHORTS)
    )


def _by_position(field) -> str:
    return "CASE position " + " ".join(
        f"WHEN {n} THEN {text(field(each))}" for n, each in enumerate(RULE_COHORTS)
    ) + " END"


_TITLE = (
    "array_to_string(list_transform(string_split(tag, '_'),"
    " lambda w: upper(w[1]) || lower(w[2:])), ' ')"
)

CTES: dict[str, str] = {
    "raw": f"""raw AS (SELECT CAST(event_id AS VARCHAR) AS tweet_id,
    CASE WHEN pos % 2 = 0 THEN CAST(100000 + block AS VARCHAR) ELSE 'Support' || CAST(block % 5 AS VARCHAR) END AS author_id,
    CASE WHEN pos % 2 = 0 THEN 'True' ELSE 'False' END AS inbound, ts AS created_at,
    CASE WHEN pos % 2 = 0 THEN ({text_list(CUSTOMER_TEXTS)})[(event_id * 7 + block * 3) % 16 + 1]
        ELSE ({text_list(AGENT_TEXTS)})[(event_id * 5 + block) % 8 + 1] END AS text,
    CAST(NULL AS VARCHAR) AS response_tweet_id,
    CAST(CASE WHEN pos = 0 OR block % 7 = 3 THEN NULL WHEN pos = 3 THEN block * 6 + 1
        WHEN pos = 4 AND block % 4 = 0 THEN 1000000000 + event_id ELSE event_id - 1 END AS VARCHAR) || '.0'
        AS in_response_to_tweet_id
    FROM (SELECT event_id, ts, event_id // 6 AS block, event_id % 6 AS pos FROM events))""",
    "clean": f"""clean AS (SELECT * FROM (SELECT {clean_id('tweet_id')} AS tweet_id, author_id, inbound = 'True' AS inbound,
    created_at, {clean_text('text')} AS text, {clean_id('response_tweet_id')} AS response_tweet_id,
    {clean_id('in_response_to_tweet_id')} AS in_response_to_tweet_id FROM raw) WHERE length(text) > 0)""",
    "reach": """links AS (SELECT tweet_id, created_at, CASE WHEN in_response_to_tweet_id NOT IN ('', 'nan', 'None')
        AND in_response_to_tweet_id <> tweet_id THEN in_response_to_tweet_id END AS parent_id FROM clean),
reach AS (SELECT tweet_id, created_at, tweet_id AS root_id FROM links l
    WHERE parent_id IS NULL OR NOT EXISTS (SELECT 1 FROM clean p WHERE p.tweet_id = l.parent_id)
    UNION ALL SELECT l.tweet_id, l.created_at, r.root_id FROM links l JOIN reach r ON l.parent_id = r.tweet_id)""",
    "numbered": """sized AS (SELECT root_id, count(*) AS size, min(created_at) AS started_at FROM reach GROUP BY root_id),
numbered AS (SELECT root_id, size, started_at, row_number() OVER (ORDER BY started_at, root_id) AS conversation_id
    FROM sized WHERE size > 1)""",
    "grouped": """grouped AS (SELECT n.conversation_id, c.tweet_id, c.author_id, c.inbound AS is_customer,
    c.text AS message_text, c.created_at, c.response_tweet_id, c.in_response_to_tweet_id,
    row_number() OVER (PARTITION BY n.conversation_id ORDER BY c.created_at, c.tweet_id) - 1 AS sequence_number
    FROM clean c JOIN reach r USING (tweet_id) JOIN numbered n ON n.root_id = r.root_id)""",
    **_analysis_ctes("grouped"),
    "found": f"""tag_uses AS (SELECT tag, count(*) AS uses FROM (SELECT unnest(tags) AS tag FROM assessed) GROUP BY tag),
top_tags AS (SELECT tag, uses, row_number() OVER (ORDER BY uses DESC, tag) - 1 AS position FROM tag_uses
    ORDER BY uses DESC, tag LIMIT 10),
found AS ({_rule_cohort_union()}
    UNION ALL SELECT DISTINCT conversation_id, 1, position, a.tag
    FROM (SELECT conversation_id, unnest(tags) AS tag FROM assessed) a JOIN top_tags p ON a.tag = p.tag
    WHERE p.uses >= 3)""",
    "cohorts": f"""sizes AS (SELECT kind, position, tag, count(*) AS conversation_count FROM found
    GROUP BY kind, position, tag HAVING kind = 0 OR count(*) >= 3),
cohorts AS (SELECT row_number() OVER (ORDER BY kind, position) AS cohort_id,
    CASE WHEN kind = 0 THEN {_by_position(lambda each: each['name'])} ELSE 'Tag: ' || {_TITLE} END AS cohort_name,
    CASE WHEN kind = 0 THEN {_by_position(lambda each: each['description'])}
        ELSE 'Conversations tagged with ''' || tag || '''' END AS cohort_description,
    CASE WHEN kind = 0 THEN {_by_position(lambda each: json.dumps(each['criteria']))}
        ELSE '{{"tag": "' || tag || '"}}' END AS cohort_criteria,
    conversation_count, kind, position FROM sizes)""",
    "members": """members AS (SELECT f.conversation_id, c.cohort_id FROM found f
    JOIN cohorts c ON c.kind = f.kind AND c.position = f.position)""",
    "context": f"""ends AS (SELECT conversation_id, arg_min(author_id, sequence_number) FILTER (WHERE is_customer) AS customer_id,
    arg_max(message_text, sequence_number) AS latest_message, max(created_at) AS latest_interaction,
    count(DISTINCT tweet_id) AS total_messages,
    string_agg({clock('created_at')} || ' | ' || author_id || ': ' || message_text, ' ### ' ORDER BY sequence_number)
        AS chat_history FROM grouped GROUP BY conversation_id),
cohort_lists AS (SELECT conversation_id, string_agg(cohort_name, '; ' ORDER BY cohort_id) AS customer_cohorts
    FROM members JOIN cohorts USING (cohort_id) GROUP BY conversation_id),
context AS (SELECT a.conversation_id, a.is_resolved, a.tags, a.nature_of_request, a.customer_sentiment, a.urgency_level,
    a.conversation_type, a.customer_behavior, e.customer_id, e.latest_message, e.latest_interaction, e.total_messages,
    e.chat_history, l.customer_cohorts FROM assessed a JOIN ends e USING (conversation_id)
    LEFT JOIN cohort_lists l USING (conversation_id) WHERE NOT a.is_resolved)""",
    "ruled": f"""ruled AS (SELECT *, CASE WHEN personal THEN 'scheduling_phone_call' WHEN written THEN 'email_reply'
        ELSE 'twitter_dm_reply' END AS channel,
    strftime(TIMESTAMP '{AS_OF}' + INTERVAL 2 HOUR, '%Y-%m-%dT%H:%M:%SZ') AS send_time,
    'Hi! We''re sorry for the inconvenience. Let us help resolve your ' || nature_of_request || ' issue.' AS message,
    CASE WHEN personal THEN 'Phone call recommended due to ' || urgency_level || ' urgency and ' || customer_sentiment
            || ' sentiment requiring immediate personal attention.'
        WHEN written THEN 'Email selected for technical customer requiring detailed written solution and documentation.'
        ELSE 'Twitter DM chosen for quick acknowledgment of ' || urgency_level || ' priority ' || nature_of_request
            || ' issue.' END AS reasoning,
    CASE WHEN personal OR written THEN 'pending_customer_reply' ELSE 'resolved' END AS issue_status
    FROM (SELECT *, urgency_level IN ('high', 'critical') OR customer_sentiment IN ('frustrated', 'angry') AS personal,
        customer_sentiment = 'technical' OR customer_behavior = 'technical' AS written FROM context))""",
    # Recommendations with every kind of channel, time, text and defect, derived from the conversations.
    "asked": f"""asked AS (SELECT conversation_id, urgency_level, customer_id,
    CASE WHEN conversation_id % 19 = 0 THEN 'fax' WHEN conversation_id % 3 = 0 THEN 'twitter_dm_reply'
        WHEN conversation_id % 3 = 1 THEN 'email_reply' ELSE 'scheduling_phone_call' END AS channel,
    CASE WHEN conversation_id % 11 = 0 THEN 'tomorrow' WHEN conversation_id % 13 = 0 THEN NULL
        ELSE strftime(latest_interaction, '%Y-%m-%dT%H:%M:%SZ') END AS send_time,
    CASE WHEN conversation_id % 11 = 0 THEN NULL WHEN conversation_id % 13 = 0 THEN TIMESTAMP '{AS_OF}'
        ELSE date_trunc('second', latest_interaction) END AS asked_at,
    CASE conversation_id % 5 WHEN 0 THEN repeat(latest_message || ' ', 30) WHEN 1 THEN 'Hi there. ' || latest_message
        WHEN 2 THEN 'Dear customer, ' || latest_message WHEN 3 THEN 'Please Call us. ' || latest_message
        ELSE latest_message END AS message,
    CASE WHEN conversation_id % 17 = 0 THEN '' ELSE 'because' END AS reasoning,
    CASE WHEN conversation_id % 23 = 0 THEN 'odd' ELSE 'resolved' END AS issue_status FROM context)""",
}


def optimised(source: str, asked_at: str) -> str:
    """CTE text ``optimised``: send time and message of ``source`` after the channel rules, at AS_OF."""
    limits = {"max_length": (500, 1000, 500), "opening": (9, 9, 9), "closing": (20, 18, 17)}
    names = ("twitter_dm_reply", "email_reply", "scheduling_phone_call")
    columns = ", ".join(
        "CASE channel " + " ".join(f"WHEN '{n}' THEN {v}" for n, v in zip(names, values)) + f" END AS {name}"
        for name, values in limits.items()
    )
    return f"""limited AS (SELECT *, {asked_at} AS due, {columns} FROM {source}),
clamped AS (SELECT *, CASE WHEN urgency_level IN ('critical', 'high') THEN TIMESTAMP '{AS_OF}' + INTERVAL 1 HOUR
        WHEN hour(due) < opening THEN date_trunc('day', due) + to_hours(opening) + to_seconds(second(due))
        WHEN hour(due) >= closing THEN date_trunc('day', due) + to_hours(closing - 1) + to_seconds(second(due))
        ELSE due END AS chosen,
    CASE WHEN length(message) > max_length THEN message[1:max_length - 3] || '...' ELSE message END AS start FROM limited),
framed AS (SELECT *, CASE WHEN due IS NULL OR opening IS NULL THEN TIMESTAMP '{AS_OF}' + INTERVAL 2 HOUR
        WHEN channel = 'email_reply' AND isodow(chosen) >= 6
            THEN date_trunc('day', chosen) + to_days(CAST(8 - isodow(chosen) AS INT)) + INTERVAL 9 HOUR
                + to_seconds(second(chosen)) ELSE chosen END AS final_time,
    CASE WHEN channel = 'twitter_dm_reply' AND NOT starts_with(start, 'Hi') AND NOT starts_with(start, 'Hello')
            THEN 'Hi ' || customer_id || ', ' || start
        WHEN channel = 'email_reply' AND NOT starts_with(start, 'Dear') AND NOT starts_with(start, 'Hello')
            THEN 'Dear ' || customer_id || ',' || chr(10) || chr(10) || start ELSE start END AS greeted FROM clamped),
optimised AS (SELECT * EXCLUDE (send_time, message), strftime(final_time, '%Y-%m-%dT%H:%M:%SZ') AS send_time,
    CASE WHEN max_length IS NULL THEN message
        WHEN channel = 'email_reply' THEN greeted || chr(10) || chr(10) || 'Best regards,' || chr(10)
            || 'Customer Support Team'
        WHEN channel = 'scheduling_phone_call' THEN greeted || CASE WHEN contains(lower(start), 'call') THEN ''
            ELSE ' We''d like to schedule a quick call to resolve this personally.' END
            || ' Please let us know your preferred time.' ELSE greeted END AS message FROM framed),
validated AS (SELECT *, CASE WHEN coalesce(customer_id, '') = '' THEN 'missing_customer_id'
    WHEN coalesce(channel, '') = '' THEN 'missing_channel' WHEN coalesce(message, '') = '' THEN 'missing_message'
    WHEN coalesce(reasoning, '') = '' THEN 'missing_reasoning'
    WHEN coalesce(issue_status, '') = '' THEN 'missing_issue_status'
    WHEN channel NOT IN ('twitter_dm_reply', 'email_reply', 'scheduling_phone_call') THEN 'bad_channel'
    WHEN issue_status NOT IN ('resolved', 'pending_customer_reply') THEN 'bad_issue_status'
    WHEN length(message) > max_length THEN 'message_too_long' END AS reject_reason FROM optimised)"""


def upto(last: str, select: str, *extra: str) -> str:
    """A statement with all CTEs up to ``last``, then ``extra`` ones, then the select."""
    names = list(CTES)
    parts = [CTES[name] for name in names[: names.index(last) + 1]] + list(extra)
    return "WITH RECURSIVE " + ",\n".join(parts) + "\n" + select


def turns(last: str, select: str) -> str:
    """The analysis CTEs over the ``conversations`` table instead of the adapter messages."""
    source = f"""turns AS (SELECT conv_id AS conversation_id, CAST(turn AS INT) AS sequence_number, role AS author_id,
    role = 'user' AS is_customer, {clean_text('text')} AS message_text,
    TIMESTAMP '2024-01-01 00:00:00' + to_minutes(turn) AS created_at FROM conversations)"""
    chain = _analysis_ctes("turns")
    names = list(chain)
    return "WITH " + ",\n".join([source] + [chain[n] for n in names[: names.index(last) + 1]]) + "\n" + select


def _weighted_examples(examples) -> str:
    """CTEs up to L2-normalised TF-IDF weights of the training sentences."""
    stop = "(" + ", ".join(map(text, classifiers.STOP_WORDS)) + ")"
    rows = ", ".join(f"({n}, {text(t)}, {text(y)})" for n, (t, y) in enumerate(examples))
    return f"""training(doc, body, label) AS (VALUES {rows}),
uses AS (SELECT doc, label, term, count(*) AS n FROM (SELECT doc, label,
    unnest(regexp_extract_all(lower(body), '[\\p{{L}}\\p{{N}}_]{{2,}}')) AS term FROM training)
    WHERE term NOT IN {stop} GROUP BY ALL),
idfs AS (SELECT term, ln((1.0 + (SELECT count(*) FROM training)) / (1 + count(*))) + 1 AS idf FROM uses GROUP BY term),
weights AS (SELECT doc, label, term, n * idf / sqrt(sum(n * idf * n * idf) OVER (PARTITION BY doc)) AS w
    FROM uses JOIN idfs USING (term)),
spoken_terms AS (SELECT conversation_id, term, count(*) * any_value(idf) AS x FROM (SELECT conversation_id,
    unnest(regexp_extract_all(lower(array_to_string(customer_list, ' ')), '[\\p{{L}}\\p{{N}}_]{{2,}}')) AS term FROM heard)
    JOIN idfs USING (term) GROUP BY conversation_id, term),
norms AS (SELECT conversation_id, sqrt(sum(x * x)) AS norm FROM spoken_terms GROUP BY conversation_id)"""


def _predicted(label: str, confidence_name: str) -> str:
    """CTEs from (label, prior) and (label, term, share) to the best label and its probability."""
    return f"""dots AS (SELECT conversation_id, label, sum(x * share) / any_value(norm) AS dot FROM spoken_terms JOIN norms
    USING (conversation_id) JOIN shares USING (term) GROUP BY conversation_id, label),
joint AS (SELECT h.conversation_id, l.label, prior + coalesce(dot, 0) AS score FROM heard h CROSS JOIN labels l
    LEFT JOIN dots d ON d.conversation_id = h.conversation_id AND d.label = l.label WHERE len(customer_list) > 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY conversation_id ORDER BY round(score, 6) DESC, label) AS place,
    sum(exp(score)) OVER (PARTITION BY conversation_id) AS mass FROM joint),
predicted AS (SELECT conversation_id, label AS {label}, exp(score) / mass AS {confidence_name} FROM ranked WHERE place = 1)"""


def naive_bayes(select: str) -> str:
    """Training and scoring of the nature classifier in SQL."""
    fitted = """labels AS (SELECT label, ln(count(*) * 1.0 / (SELECT count(*) FROM training)) AS prior FROM training GROUP BY label),
grid AS (SELECT label, term, coalesce(sum(w), 0) + 1 AS mass FROM labels CROSS JOIN idfs LEFT JOIN weights
    USING (label, term) GROUP BY label, term),
shares AS (SELECT label, term, ln(mass / sum(mass) OVER (PARTITION BY label)) AS share FROM grid)"""
    parts = [_weighted_examples(classifiers.NATURE_EXAMPLES), fitted]
    return upto("heard", select, *parts, _predicted("nature_of_request", "nature_confidence"))


def logistic(select: str, steps: int = 800, rate: float = 0.1) -> str:
    """Training of the behaviour classifier by gradient descent in a recursive query, and scoring.

    The term weights stay a combination of the training rows, so a step moves one number per row and label, using the
    inner products of the rows, and one intercept per label.
    """
    rows, labels = len(classifiers.BEHAVIOUR_EXAMPLES), sorted({label for _, label in classifiers.BEHAVIOUR_EXAMPLES})
    docs, codes = f"range(1, {rows + 1})", f"range(1, {len(labels) + 1})"
    fitted = f"""names(code, label) AS (VALUES {', '.join(f'({n}, {text(name)})' for n, name in enumerate(labels, 1))}),
products AS (SELECT i.doc AS i, j.doc AS j, coalesce(sum(a.w * b.w), 0) AS k FROM training i CROSS JOIN training j
    LEFT JOIN weights a ON a.doc = i.doc LEFT JOIN weights b ON b.doc = j.doc AND b.term = a.term
    GROUP BY i.doc, j.doc),
kernel AS (SELECT list(r ORDER BY i) AS k FROM (SELECT i, list(k ORDER BY j) AS r FROM products GROUP BY i)),
targets AS (SELECT list(r ORDER BY doc) AS y FROM (SELECT doc,
    list(CASE WHEN t.label = n.label THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END ORDER BY code) AS r
    FROM training t CROSS JOIN names n GROUP BY doc)),
fit(step, a, b) AS (SELECT 0, list_transform(y, lambda r: list_transform(r, lambda v: v * 0)),
    list_transform({codes}, lambda c: CAST(0 AS DOUBLE)) FROM targets
    UNION ALL
    SELECT step + 1, list_transform({docs}, lambda i: list_transform({codes},
            lambda c: a[i][c] - CAST({rate} AS DOUBLE) * (p[i][c] - y[i][c] + a[i][c]))),
        list_transform({codes}, lambda c: b[c] - CAST({rate} AS DOUBLE)
            * list_sum(list_transform({docs}, lambda i: p[i][c] - y[i][c])))
    FROM (SELECT *, list_transform(s, lambda r: list_transform(r,
            lambda v: exp(v) / list_sum(list_transform(r, lambda u: exp(u))))) AS p
        FROM (SELECT step, a, b, y, list_transform({docs}, lambda i: list_transform({codes},
                lambda c: b[c] + list_sum(list_transform({docs}, lambda j: k[i][j] * a[j][c])))) AS s
            FROM fit, kernel, targets WHERE step < {steps}))),
fitted AS (SELECT a, b FROM fit WHERE step = {steps}),
labels AS (SELECT label, b[code] AS prior FROM names, fitted),
shares AS (SELECT n.label, w.term, sum(a[w.doc + 1][n.code] * w.w) AS share FROM weights w CROSS JOIN names n CROSS JOIN
    fitted GROUP BY n.label, w.term)"""
    parts = [_weighted_examples(classifiers.BEHAVIOUR_EXAMPLES), fitted]
    return upto("heard", select, *parts, _predicted("customer_behavior", "behavior_confidence"))
