"""The same queries as SQL over the given tables, to check results with another engine."""

from __future__ import annotations

VIEWS = {
    "topic_log": """
        SELECT event_type AS topic, CAST(user_id % 4 AS INT) AS part,
               CAST(row_number() OVER (PARTITION BY event_type, user_id % 4 ORDER BY event_id) - 1
                    AS BIGINT) AS off,
               user_id AS key_id, props AS payload, value AS amount, ts, event_id
        FROM events""",
    "bounds": """
        SELECT topic, part, CAST(CASE WHEN part = 0 THEN 20 ELSE 0 END AS BIGINT) AS oldest,
               max(off) + 1 AS newest
        FROM topic_log GROUP BY topic, part""",
    "committed": """
        SELECT topic, part,
               CAST(CASE WHEN part = 0 THEN 10 WHEN part = 1 THEN floor(newest / 2) ELSE newest END
                    AS BIGINT) AS off,
               concat('ck-', topic) AS metadata
        FROM bounds WHERE part < 3""",
    "state": """
        SELECT b.topic, b.part, coalesce(c.off, -1) AS off, coalesce(c.metadata, '') AS metadata
        FROM bounds b LEFT JOIN committed c ON b.topic = c.topic AND b.part = c.part""",
    "commands": """
        SELECT event_id AS seq, topic, part,
               CASE WHEN off % 7 = 3 THEN 'reset' ELSE 'mark' END AS op,
               CASE WHEN off % 7 = 3 THEN off - 2 WHEN off % 5 = 0 THEN off - 3 ELSE off END AS off,
               concat('e', CAST(event_id AS VARCHAR)) AS metadata
        FROM topic_log""",
    "commits": """
        SELECT concat('g', CAST(key_id % 3 AS VARCHAR)) AS group_id,
               CAST(key_id % 5 AS INT) AS generation, topic, part, off + 1 AS off,
               payload AS metadata, ts AS committed_at, event_id AS batch_id
        FROM topic_log""",
    "deliveries": """
        SELECT topic, part, off, concat('c', CAST(key_id % 3 AS VARCHAR)) AS consumer_id
        FROM topic_log
        UNION ALL
        SELECT topic, part, off, concat('c', CAST((key_id + 1) % 3 AS VARCHAR)) AS consumer_id
        FROM topic_log WHERE off % 7 = 3""",
    "catalog": "SELECT DISTINCT topic, part FROM topic_log",
    "subs": "SELECT topic, part FROM catalog WHERE topic <> 'view' AND part <> 2",
    "selected": """
        SELECT t.topic, 'core' AS origin FROM (VALUES ('click'), ('gone')) AS t(topic)
        UNION ALL
        SELECT DISTINCT topic, 'extra' AS origin FROM catalog
        WHERE topic NOT IN ('click', 'gone') AND regexp_matches(topic, 'e')
          AND NOT regexp_matches(topic, '^v')""",
    "marked": """
        SELECT s.topic, s.part, CASE WHEN m.off + 1 > s.off THEN m.off + 1 ELSE s.off END AS off,
               CASE WHEN m.off + 1 > s.off THEN m.metadata ELSE s.metadata END AS metadata,
               coalesce(m.off + 1 > s.off, FALSE) AS dirty
        FROM state s LEFT JOIN (
          SELECT * FROM commands WHERE op = 'mark'
          QUALIFY row_number() OVER (PARTITION BY topic, part ORDER BY off DESC, seq) = 1
        ) m ON m.topic = s.topic AND m.part = s.part""",
    "growing_events": """
        SELECT CASE WHEN event_id * 3 >= 2 * n AND user_id % 5 = 0 THEN concat('late-', event_type)
                    ELSE event_type END AS topic,
               CAST(user_id % 4 + CASE WHEN event_id * 3 >= n AND user_id % 7 = 0 THEN 4 ELSE 0 END
                    AS INT) AS part,
               event_id, event_id * 3 < n AS early
        FROM events, (SELECT max(event_id) + 1 AS n FROM events)""",
    "growing": """
        SELECT topic, part, event_id, early,
               CAST(row_number() OVER (PARTITION BY topic, part ORDER BY event_id) - 1 AS BIGINT)
                 AS off
        FROM growing_events
        WHERE topic IN ('click', 'gone')
           OR (regexp_matches(topic, 'e') AND NOT regexp_matches(topic, '^v'))""",
    "growing_starts": """
        SELECT topic, part, CASE WHEN part = 0 THEN CAST(floor((max(off) + 1) / 2) AS BIGINT)
                                 ELSE max(off) + 1 END AS resolved_offset,
               CASE WHEN part = 0 THEN 'committed' ELSE 'default' END AS how
        FROM growing WHERE early GROUP BY topic, part""",
    "commit_attempts": """
        SELECT concat('m', CAST(key_id % 3 AS VARCHAR)) AS member_id,
               CAST(CASE WHEN key_id % 3 = 1 THEN 2 ELSE 3 END AS INT) AS generation,
               CAST(floor(event_id * 10 / (SELECT max(event_id) + 1 FROM events)) AS BIGINT)
                 AS batch_id,
               topic, part, max(off) + 1 AS off, max(ts) AS committed_at
        FROM topic_log GROUP BY ALL""",
    "wide_catalog": "SELECT DISTINCT event_type AS topic, CAST(user_id AS INT) AS part FROM events",
    "days": """
        SELECT CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS INT) AS generation,
               concat('m', CAST(user_id % 100 AS VARCHAR)) AS member_id, event_type AS topic
        FROM events""",
    "members": "SELECT DISTINCT generation, member_id, topic FROM days",
    "failures": """
        SELECT generation, member_id,
               CASE n % 9 WHEN 1 THEN 'refresh' WHEN 3 THEN 'release' WHEN 5 THEN 'rebalance'
                          WHEN 7 THEN 'subscribe' END AS stage
        FROM (SELECT generation, member_id, count(*) FILTER (WHERE topic = 'error') AS n
              FROM days GROUP BY generation, member_id)
        WHERE n % 9 IN (1, 3, 5, 7)""",
    "ranked_members": """
        SELECT generation, topic, member_id,
               row_number() OVER (PARTITION BY generation, topic ORDER BY member_id) - 1 AS pos,
               count(*) OVER (PARTITION BY generation, topic) AS mlen
        FROM members""",
    "ranked_parts": """
        SELECT topic, part, row_number() OVER (PARTITION BY topic ORDER BY part) - 1 AS idx,
               count(*) OVER (PARTITION BY topic) AS plen
        FROM wide_catalog""",
    "assignments": """
        SELECT m.generation, m.member_id, p.topic, p.part
        FROM ranked_members m JOIN ranked_parts p ON p.topic = m.topic
         AND p.idx >= floor(m.pos * (p.plen::DOUBLE / m.mlen::DOUBLE) + 0.5)
         AND p.idx < floor((m.pos + 1) * (p.plen::DOUBLE / m.mlen::DOUBLE) + 0.5)""",
    "attempts": """
        SELECT generation, member_id, stage,
               CASE WHEN lag(stage, 1, 'none') OVER w IS NULL
                    THEN lag(generation) OVER w END AS base
        FROM (SELECT m.generation, m.member_id, f.stage
              FROM (SELECT DISTINCT generation, member_id FROM members) m
              LEFT JOIN failures f USING (generation, member_id))
        WHERE stage IS NULL OR stage <> 'refresh'
        WINDOW w AS (PARTITION BY member_id ORDER BY generation)""",
    "history": """
        SELECT a.generation, a.member_id, 'rebalance OK' AS type, 'current' AS change, c.topic, c.part
        FROM attempts a JOIN assignments c USING (generation, member_id) WHERE a.stage IS NULL
        UNION ALL
        SELECT a.generation, a.member_id, 'rebalance OK', 'claimed', c.topic, c.part
        FROM attempts a JOIN assignments c USING (generation, member_id)
        LEFT JOIN assignments b ON b.generation = a.base AND b.member_id = a.member_id
         AND b.topic = c.topic AND b.part = c.part
        WHERE a.stage IS NULL AND b.topic IS NULL
        UNION ALL
        SELECT a.generation, a.member_id, 'rebalance OK', 'released', b.topic, b.part
        FROM attempts a JOIN assignments b ON b.generation = a.base AND b.member_id = a.member_id
        LEFT JOIN assignments c ON c.generation = a.generation AND c.member_id = a.member_id
         AND b.topic = c.topic AND b.part = c.part
        WHERE a.stage IS NULL AND c.topic IS NULL
        UNION ALL
        SELECT a.generation, a.member_id, 'rebalance error', 'current', b.topic, b.part
        FROM attempts a JOIN assignments b ON b.generation = a.base AND b.member_id = a.member_id
        WHERE a.stage IN ('rebalance', 'subscribe')""",
    "owners": """
        SELECT p.o_orderpriority, s.s_suppkey,
               row_number() OVER (PARTITION BY p.o_orderpriority ORDER BY s.s_suppkey) - 1 AS pos,
               count(*) OVER (PARTITION BY p.o_orderpriority) AS mlen
        FROM supplier s, (VALUES ('1-URGENT'), ('2-HIGH'), ('3-MEDIUM'), ('4-NOT SPECIFIED'),
                                 ('5-LOW')) AS p(o_orderpriority)""",
    "items": """
        SELECT o_orderpriority, o_orderkey,
               row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) - 1 AS idx,
               count(*) OVER (PARTITION BY o_orderpriority) AS plen
        FROM orders""",
}


def _with(*names: str) -> str:
    """The named views and what they are built on, as a WITH clause."""
    wanted: list[str] = []

    def add(name: str) -> None:
        for other in VIEWS:
            if other != name and other not in wanted and _uses(VIEWS[name], other):
                add(other)
        if name not in wanted:
            wanted.append(name)

    for name in names:
        add(name)
    return "WITH " + ",\n".join(f"{n} AS ({VIEWS[n]})" for n in wanted) + "\n"


def _uses(sql: str, name: str) -> bool:
    words = sql.replace("(", " ").replace(")", " ").replace(",", " ").split()
    return any(a in ("FROM", "JOIN") and b == name for a, b in zip(words, words[1:]))


def _check(body: str) -> str:
    names = [n for n in VIEWS if _uses(body, n)]
    return (_with(*names) if names else "") + body


def _starts(default: str) -> str:
    symbol = {"oldest": -2, "newest": -1}[default]
    return f"""
        SELECT s.topic, s.part,
               CASE WHEN lost THEN -1 ELSE s.off END AS state_offset, s.metadata,
               CAST(CASE WHEN lost OR s.off <= -1 THEN {symbol} ELSE s.off END AS BIGINT)
                 AS initial_offset,
               CASE WHEN lost OR s.off <= -1 THEN {default} ELSE s.off END AS resolved_offset,
               CASE WHEN s.off <= -1 THEN 'default' WHEN lost THEN 'out_of_range'
                    ELSE 'committed' END AS how
        FROM (SELECT s.*, b.oldest, b.newest,
                     s.off > -1 AND NOT s.off BETWEEN b.oldest AND b.newest AS lost
              FROM state s JOIN bounds b ON b.topic = s.topic AND b.part = s.part) s"""


def _fold(rule: str, source: str, start: str) -> str:
    """Commands applied one after the other. ``start`` yields topic, part, off, metadata."""
    if rule == "partition":
        mark, reset, value = "x.off + 1 > s.off", "x.off + 1 <= s.off", "x.off + 1"
    else:
        mark, reset, value = "x.off >= s.off", "x.off <= s.off", "x.off"
    return f"""
        SELECT topic, part, r.off AS off, r.metadata AS metadata, r.op = 'won' AS dirty
        FROM (SELECT i.topic, i.part, list_reduce(
                coalesce(c.steps, []),
                lambda s, x: CASE WHEN (x.op = 'mark' AND {mark}) OR (x.op = 'reset' AND {reset})
                                  THEN {{'op': 'won', 'off': {value}, 'metadata': x.metadata}}
                                  ELSE s END,
                {{'op': '', 'off': i.off, 'metadata': i.metadata}}) AS r
              FROM ({start}) i LEFT JOIN (
                SELECT topic, part,
                       list({{'op': op, 'off': off, 'metadata': metadata}} ORDER BY seq) AS steps
                FROM {source} GROUP BY topic, part) c
              ON c.topic = i.topic AND c.part = i.part)"""


_WIDE_COMMANDS = """
        SELECT event_id AS seq, topic, CAST(key_id AS INT) AS part,
               CASE WHEN off % 7 = 3 THEN 'reset' ELSE 'mark' END AS op,
               CASE WHEN off % 7 = 3 THEN off - 2 WHEN off % 5 = 0 THEN off - 3 ELSE off END AS off,
               concat('e', CAST(event_id AS VARCHAR)) AS metadata
        FROM topic_log"""
VIEWS["wide_commands"] = _WIDE_COMMANDS

_READ = """FROM topic_log t JOIN ({starts}) s ON s.topic = t.topic AND s.part = t.part
        WHERE t.off >= s.resolved_offset"""

_STASH_STEP = """
        SELECT s.topic, s.part, CASE WHEN won THEN target ELSE s.off END AS off,
               CASE WHEN won THEN stash_metadata ELSE s.metadata END AS metadata, won AS dirty
        FROM (SELECT s.*, CAST(floor(b.newest / 3) AS BIGINT) + 1 AS target,
                     concat('st-', s.topic) AS stash_metadata,
                     CAST(floor(b.newest / 3) AS BIGINT) + 1 {compare} s.off AS won
              FROM state s JOIN bounds b ON b.topic = s.topic AND b.part = s.part) s"""

_LATEST = """
        SELECT group_id, topic, part, off, metadata FROM commits
        QUALIFY row_number() OVER (PARTITION BY group_id, topic, part
                                   ORDER BY committed_at DESC, batch_id DESC) = 1"""

_STASH_MARKS = """
        SELECT topic, part, off, metadata FROM commands WHERE op = 'mark' AND off >= 0
        QUALIFY row_number() OVER (PARTITION BY topic, part ORDER BY off DESC, seq DESC) = 1"""

_MIXED = _fold("partition", "commands", "SELECT * FROM state")

_DIFF = """
        SELECT {now}.generation, {now}.member_id, {now}.topic, {now}.part
        FROM {sides}"""

_BY_TOPIC = """
        SELECT member_id, topic,
               coalesce(string_agg(CAST(part AS VARCHAR), ',' ORDER BY part)
                        FILTER (WHERE is_now AND NOT was), '') AS claimed,
               coalesce(string_agg(CAST(part AS VARCHAR), ',' ORDER BY part)
                        FILTER (WHERE was AND NOT is_now), '') AS released,
               coalesce(string_agg(CAST(part AS VARCHAR), ',' ORDER BY part)
                        FILTER (WHERE is_now), '') AS current,
               bool_or(was) AS in_previous, bool_or(is_now) AS in_current
        FROM (SELECT member_id, topic, part, bool_or(side = 0) AS was, bool_or(side = 1) AS is_now
              FROM (SELECT concat(member_id, '@', CAST(generation + 1 AS VARCHAR)) AS member_id,
                           topic, part, 0 AS side FROM assignments
                    UNION ALL
                    SELECT concat(member_id, '@', CAST(generation AS VARCHAR)), topic, part, 1
                    FROM assignments)
              GROUP BY member_id, topic, part)
        GROUP BY member_id, topic"""

_TURNS = """
        SELECT role AS topic, CAST(conv_id % 4 AS INT) AS part,
               CAST(row_number() OVER (PARTITION BY role, conv_id % 4 ORDER BY conv_id, turn) - 1
                    AS BIGINT) AS off, text AS payload
        FROM conversations"""

_RESUMED = """
        SELECT t.topic, t.part, t.off, t.event_id
        FROM topic_log t JOIN selected x ON x.topic = t.topic
        LEFT JOIN (SELECT topic, part, off AS start FROM commits WHERE group_id = 'g1'
                   QUALIFY row_number() OVER (PARTITION BY topic, part
                                              ORDER BY committed_at DESC, batch_id DESC) = 1) c
          ON c.topic = t.topic AND c.part = t.part
        WHERE t.off >= coalesce(c.start, 0)"""

_BODIES = {
    "resume_scan": "SELECT t.topic, t.part, t.off, t.event_id "
    + _READ.format(starts=_starts("oldest")),
    "offset_range_read": "SELECT t.topic, t.part, t.off, t.payload, t.amount "
    + _READ.format(starts=_starts("newest")),
    "multiplexed_read": """
        SELECT t.topic, t.part, t.off, t.key_id, t.payload, t.amount
        FROM topic_log t JOIN selected s ON s.topic = t.topic""",
    "partitioned_read": """
        SELECT topic, part, off, count(*) OVER w AS running_count,
               CAST(sum(CAST(round(amount * 100) AS BIGINT)) OVER w AS BIGINT) AS running_cents
        FROM topic_log WINDOW w AS (PARTITION BY topic, part ORDER BY off)""",
    "partition_streams": f"""
        SELECT t.topic, t.part, s.initial_offset, count(*) AS messages,
               max(t.off) - min(t.off) + 1 - count(*) AS breaks
        {_READ.format(starts=_starts("oldest"))}
        GROUP BY t.topic, t.part, s.initial_offset""",
    "topic_catalog": "SELECT topic, part FROM catalog",
    "log_ranges": """
        SELECT topic, part, min(off) AS oldest, max(off) + 1 AS newest
        FROM topic_log GROUP BY topic, part""",
    "high_water_marks": """
        SELECT topic, part, max(off) + 1 AS high_water_mark FROM topic_log GROUP BY topic, part""",
    "topic_write": """
        SELECT lang AS topic, CAST(doc_id % 4 AS INT) AS part,
               CAST(row_number() OVER (PARTITION BY lang, doc_id % 4 ORDER BY doc_id) - 1 AS BIGINT)
                 AS off, doc_id, source AS key, text AS value
        FROM documents""",
    "message_lines": """
        SELECT concat(topic, '/', part, '/', off, chr(9), coalesce(payload, '')) AS line
        FROM topic_log""",
    "message_lines_keyed": """
        SELECT concat(topic, '/', part, '/', off, chr(9), 'u', key_id, chr(9),
                      coalesce(payload, '')) AS line
        FROM topic_log""",
    "first_messages": """
        SELECT topic, part, off, event_id FROM topic_log ORDER BY topic, part, off LIMIT 100""",
    "first_messages_per_partition": """
        SELECT topic, part, off, event_id FROM topic_log
        QUALIFY row_number() OVER (PARTITION BY topic, part ORDER BY off) <= 10""",
    "topic_selection": "SELECT topic, origin FROM selected",
    "topic_union": """
        SELECT t.topic FROM (VALUES ('click'), ('gone')) AS t(topic)
        UNION
        SELECT topic FROM catalog WHERE regexp_matches(topic, 'i')""",
    "known_topics": """
        SELECT DISTINCT c.topic, coalesce(s.origin = 'core', FALSE) AS is_core,
               coalesce(s.origin = 'extra', FALSE) AS is_extra
        FROM catalog c LEFT JOIN selected s ON s.topic = c.topic""",
    "subscribed_commands": """
        SELECT c.seq, c.topic, c.part, c.op, c.off, c.metadata
        FROM commands c JOIN subs s ON s.topic = c.topic AND s.part = c.part""",
    "unknown_topics": """
        SELECT topic FROM selected WHERE topic NOT IN (SELECT topic FROM catalog)""",
    "committed_offsets": f"""
        SELECT c.topic, c.part, coalesce(l.off, -1) AS off, coalesce(l.metadata, '') AS metadata
        FROM catalog c LEFT JOIN ({_LATEST}) l
          ON l.group_id = 'g1' AND l.topic = c.topic AND l.part = c.part""",
    "latest_commits": _LATEST,
    "start_positions_oldest": _starts("oldest"),
    "start_positions_newest": _starts("newest"),
    "out_of_range_starts": f"""
        SELECT topic, part, metadata FROM ({_starts("oldest")}) WHERE how = 'out_of_range'""",
    "mark_fold": "SELECT topic, part, off, metadata, dirty FROM marked",
    "reset_fold": """
        SELECT s.topic, s.part, CASE WHEN won THEN m.off + 1 ELSE s.off END AS off,
               CASE WHEN won THEN m.metadata ELSE s.metadata END AS metadata, won AS dirty
        FROM (SELECT s.*, coalesce(m.off + 1 <= s.off, FALSE) AS won
              FROM state s LEFT JOIN (
                SELECT topic, part, min(off) AS off FROM commands WHERE op = 'reset'
                GROUP BY topic, part) m ON m.topic = s.topic AND m.part = s.part) s
        LEFT JOIN (
          SELECT * FROM commands WHERE op = 'reset'
          QUALIFY row_number() OVER (PARTITION BY topic, part ORDER BY off, seq DESC) = 1
        ) m ON m.topic = s.topic AND m.part = s.part""",
    "mixed_fold": _MIXED,
    "mixed_fold_by_user": _fold(
        "partition",
        "wide_commands",
        "SELECT DISTINCT topic, part, CAST(-1 AS BIGINT) AS off, '' AS metadata FROM wide_commands",
    ),
    "stash_fold": "SELECT topic, part, off, metadata FROM ("
    + _fold(
        "stash",
        "commands",
        "SELECT DISTINCT topic, part, CAST(0 AS BIGINT) AS off, '' AS metadata FROM commands",
    )
    + ") WHERE dirty",
    "stash_marks": _STASH_MARKS,
    "stash_map": f"""
        SELECT concat(topic, '-', CAST(part AS VARCHAR)) AS key, off FROM ({_STASH_MARKS})""",
    "stash_applied_mark": _STASH_STEP.format(compare=">"),
    "stash_applied_reset": _STASH_STEP.format(compare="<="),
    "state_snapshot": """
        SELECT m.topic, m.part, m.off, m.metadata, m.dirty
        FROM marked m JOIN subs s ON s.topic = m.topic AND s.part = m.part""",
    "commit_rows": """
        SELECT 'g1' AS group_id, 'm1' AS member_id, CAST(3 AS INT) AS generation, topic, part, off,
               metadata, CAST(-1 AS BIGINT) AS retention_ms, CAST(7 AS BIGINT) AS batch_id
        FROM marked WHERE dirty""",
    "acknowledged_state": """
        SELECT topic, part, off, metadata, dirty AND part IN (1, 2) AS dirty FROM marked""",
    "error_rows": """
        SELECT 'mark' AS ctx, c.topic, c.part, c.off, concat('not subscribed: ', c.op) AS message
        FROM commands c WHERE NOT EXISTS (
          SELECT 1 FROM subs s WHERE s.topic = c.topic AND s.part = c.part)
        UNION ALL
        SELECT 'commit', c.topic, c.part, c.off, 'illegal generation'
        FROM commits c JOIN (SELECT group_id, max(generation) AS latest FROM commits
                             GROUP BY group_id) l ON l.group_id = c.group_id
        WHERE c.generation < l.latest""",
    "delivery_audit": """
        SELECT topic, part, off, count(*) AS deliveries,
               string_agg(DISTINCT consumer_id, ',' ORDER BY consumer_id) AS consumers
        FROM deliveries GROUP BY topic, part, off""",
    "delivery_totals": """
        SELECT CAST(sum(n) AS BIGINT) AS delivered, count(*) AS distinct_messages,
               count(*) FILTER (WHERE n > 1) AS repeated_messages
        FROM (SELECT count(*) AS n FROM deliveries GROUP BY topic, part, off)""",
    "distinct_deliveries": "SELECT DISTINCT topic, part, off FROM deliveries",
    "multiplex_union": f"""
        SELECT topic, part, off, payload FROM topic_log
        UNION ALL {_TURNS}""",
    "range_assignment": """
        SELECT i.o_orderpriority, i.o_orderkey, o.s_suppkey
        FROM items i JOIN owners o ON o.o_orderpriority = i.o_orderpriority
         AND i.idx >= floor(o.pos * (i.plen::DOUBLE / o.mlen::DOUBLE) + 0.5)
         AND i.idx < floor((o.pos + 1) * (i.plen::DOUBLE / o.mlen::DOUBLE) + 0.5)""",
    "round_robin_assignment": """
        SELECT i.o_orderpriority, i.o_orderkey, o.s_suppkey
        FROM items i JOIN owners o
          ON o.o_orderpriority = i.o_orderpriority AND o.pos = i.idx % o.mlen""",
    "group_assignment_range": "SELECT generation, member_id, topic, part FROM assignments",
    "group_assignment_round_robin": """
        SELECT m.generation, m.member_id, p.topic, p.part
        FROM ranked_members m JOIN ranked_parts p
          ON p.topic = m.topic AND p.idx % m.mlen = m.pos""",
    "subscriptions": """
        SELECT generation, member_id, topic,
               string_agg(CAST(part AS VARCHAR), ',' ORDER BY part) AS partitions
        FROM assignments GROUP BY generation, member_id, topic""",
    "ordering_rules": """
        SELECT topic, name, row_number() OVER (PARTITION BY topic ORDER BY name) - 1 AS pos
        FROM (SELECT DISTINCT topic, concat('u', CAST(key_id AS VARCHAR)) AS name FROM topic_log)""",
    "partition_difference": """
        SELECT generation, member_id, topic, part FROM assignments
        EXCEPT
        SELECT generation + 1, member_id, topic, part FROM assignments""",
    "rebalance_success": """
        SELECT concat(member_id, '@', CAST(generation AS VARCHAR)) AS member_id, topic, part,
               'claimed' AS change
        FROM (SELECT generation, member_id, topic, part FROM assignments
              EXCEPT SELECT generation + 1, member_id, topic, part FROM assignments)
        UNION ALL
        SELECT concat(member_id, '@', CAST(generation AS VARCHAR)), topic, part, 'released'
        FROM (SELECT generation + 1 AS generation, member_id, topic, part FROM assignments
              EXCEPT SELECT generation, member_id, topic, part FROM assignments)""",
    "rebalance_by_topic": _BY_TOPIC,
    "rebalance_runs": """
        SELECT member_id, topic, change, min(part) AS first_part, max(part) AS last_part
        FROM (SELECT *, part - row_number() OVER (PARTITION BY member_id, topic, change ORDER BY part) AS stretch
              FROM (SELECT concat(member_id, '@', CAST(generation AS VARCHAR)) AS member_id, topic, part, change
                    FROM (SELECT *, 'claimed' AS change FROM (
                            SELECT generation, member_id, topic, part FROM assignments
                            EXCEPT SELECT generation + 1, member_id, topic, part FROM assignments)
                          UNION ALL
                          SELECT *, 'released' FROM (
                            SELECT generation + 1 AS generation, member_id, topic, part FROM assignments
                            EXCEPT SELECT generation, member_id, topic, part FROM assignments)
                          UNION ALL
                          SELECT DISTINCT generation, member_id, topic, part, 'current' FROM assignments)))
        GROUP BY member_id, topic, change, stretch""",
    "rebalance_history": "SELECT generation, member_id, type, change, topic, part FROM history",
    "rebalance_notifications": """
        SELECT generation, member_id, CAST(0 AS INT) AS step, 'rebalance start' AS type
        FROM attempts WHERE stage IS NULL OR stage <> 'release'
        UNION ALL
        SELECT generation, member_id, 1,
               CASE WHEN stage IS NULL THEN 'rebalance OK' ELSE 'rebalance error' END
        FROM attempts WHERE stage IS NULL OR stage <> 'release'""",
    "scalar_functions": """
        SELECT event_id, concat(topic, '-', CAST(part AS VARCHAR)) AS tp_key,
               CASE WHEN off - 10 > -1 THEN off - 10 ELSE -2 END AS next_off,
               CASE off % 5 WHEN 1 THEN 'rebalance start' WHEN 2 THEN 'rebalance OK'
                            WHEN 3 THEN 'rebalance error' ELSE 'unknown' END AS name,
               CAST(floor(off::DOUBLE * ((key_id + 1)::DOUBLE / 7::DOUBLE) + 0.5) AS BIGINT) AS bound,
               printf('PLAINDATA-%08d', event_id) AS seed_value
        FROM topic_log""",
    "stream_mixed_fold": _MIXED,
    "stream_mark_fold": """
        SELECT topic, part, off + 1 AS off, metadata FROM commands WHERE op = 'mark'
        QUALIFY row_number() OVER (PARTITION BY topic, part ORDER BY off DESC, seq) = 1""",
    "stream_marked_state": "SELECT topic, part, off, metadata, dirty FROM marked",
    "stream_auto_commit": """
        SELECT 'g1' AS group_id, topic, part, max(off) + 1 AS off, '' AS metadata
        FROM topic_log GROUP BY topic, part""",
    "stream_topic_watch": "SELECT topic FROM selected WHERE origin = 'extra'",
    "stream_rebalance": "SELECT generation, member_id, type, change, topic, part FROM history",
    "stream_rebalance_parts": "SELECT generation, member_id, type, change, topic, part FROM history",
    "stream_dedup": "SELECT DISTINCT topic, part, off FROM deliveries",
    "stream_resume": _RESUMED,
    "stream_resume_restarts": """
        SELECT g.topic, g.part, g.off, g.event_id
        FROM growing g LEFT JOIN growing_starts s ON s.topic = g.topic AND s.part = g.part
        WHERE s.topic IS NULL OR g.off >= s.resolved_offset""",
    "stream_admission": """
        SELECT topic, part, resolved_offset, how FROM growing_starts
        UNION ALL
        SELECT topic, part, CAST(0 AS BIGINT), 'admitted' FROM growing g
        WHERE NOT EXISTS (SELECT 1 FROM growing_starts s WHERE s.topic = g.topic AND s.part = g.part)
        GROUP BY topic, part""",
    "stream_admitted_marks": """
        SELECT topic, part, count(*) AS off, '' AS metadata, TRUE AS dirty
        FROM growing_events GROUP BY topic, part""",
    "member_commits": """
        SELECT member_id, batch_id, generation, topic, part, off,
               concat(member_id, '/', CAST(batch_id AS VARCHAR)) AS metadata
        FROM commit_attempts WHERE member_id = 'm0'""",
    "refused_commits": """
        SELECT 'commit' AS ctx, topic, part, off,
               CASE WHEN member_id = 'm1' THEN 'illegal generation' ELSE 'unknown member' END
                 AS message
        FROM commit_attempts WHERE member_id <> 'm0'""",
    "compacted_commits": """
        SELECT 'g1' AS group_id, topic, part, off,
               concat(member_id, '/', CAST(batch_id AS VARCHAR)) AS metadata
        FROM commit_attempts WHERE generation = 3
        QUALIFY row_number() OVER (PARTITION BY topic, part
                                   ORDER BY committed_at DESC, batch_id DESC, off DESC) = 1""",
}

_BODIES["mixed_fold_sliced"] = _BODIES["mixed_fold"]
_BODIES["group_read"] = _RESUMED
_BODIES["stream_dedup_intervals"] = _BODIES["stream_dedup"]
_BODIES["zoned_read"] = _BODIES["resume_scan"]
_BODIES["zoned_ranges"] = _BODIES["log_ranges"]
_BODIES["stream_partitioned_read"] = _BODIES["partitioned_read"]
_BODIES["stash_fold_sliced"] = _BODIES["stash_fold"]

CHECKS = {name: _check(body) for name, body in _BODIES.items()}
