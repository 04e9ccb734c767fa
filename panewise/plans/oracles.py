"""The registered queries once more, as SQL for DuckDB on the same tables."""

from __future__ import annotations

_LINES = r"""
pieces as (
  select doc_id, regexp_split_to_array(text, '\r\n|\r|\n') p from documents where text is not null),
arrays as (
  select doc_id, case when p[len(p)] = '' then p[1:len(p) - 1] else p end p from pieces),
flat as (
  select doc_id, (generate_subscripts(p, 1) - 1)::bigint line_no, unnest(p) line from arrays),
lines as (
  select doc_id, line_no, row_number() over (order by doc_id, line_no) - 1 seq, line from flat)
"""

_SENTENCES = _LINES + """,
sentences as (
  select doc_id, line_no, seq, line, timestamp '2024-01-01' + to_seconds(seq // 100) arrival_ts from lines)
"""

_WORDS = _SENTENCES + r""",
pieces_of_line as (select seq, arrival_ts, unnest(string_split(line, ' ')) word from sentences),
words as (
  select seq, arrival_ts, word from pieces_of_line
  where length(word) + length(regexp_replace(word, '[^\x{10000}-\x{10FFFF}]', '', 'g')) = 5)
"""

_COUNTS = _WORDS + """,
counts as (
  select window_start, window_start + interval 5 second window_end, word, count(*) n
  from (select arrival_ts - to_seconds(k) window_start, word from words, range(0, 5) t(k))
  group by all)
"""

_TOPK = _COUNTS + """,
topk as (
  select window_start, window_end, row_number() over (partition by window_start order by n desc, word) rank, word, n
  from counts qualify rank <= 10)
"""

_JSON = _TOPK + """,
lists as (
  select window_start, window_end,
         to_json(list({'word': word, 'count': n} order by rank))::varchar json
  from topk group by all)
"""

_TOPK_COLUMNS = "window_start, window_end, rank, word, n as count"

_REPLAY = _LINES + """,
total as (select count(*) line_count, count(*) * 5 // 2 // 100 + 1 as secs from lines),
sent as (
  select unnest(range(secs * 100)) "position", line_count from total)
"""

_HOURS = """
expanded as (
  select *, time_bucket(interval 1 hour, ts, timestamp '1970-01-01') - to_hours(k::int) window_start
  from events, range(0, 5) t(k))
"""

_HOURLY = """
rates as (
  select time_bucket(interval 1 hour, ts, timestamp '1970-01-01') slot, count(*) n from events group by all)
"""


def _replay(producers: int) -> str:
    return f"""with {_REPLAY}
        select p::int producer, "position", seq, line as text,
               timestamp '2024-01-01' + to_seconds("position" // 100) arrival_ts
        from sent join lines on seq = "position" % line_count, range(0, {producers}) t(p)"""


_JOINED = """
        with hourly as (
          select time_bucket(interval 1 hour, ts, timestamp '1970-01-01') window_start, user_id, event_type, count(*) n
          from events group by all)
        select v.window_start, v.window_start + interval 1 hour window_end, v.user_id, v.n views, p.n purchases
        from hourly v join hourly p on v.window_start = p.window_start and v.user_id = p.user_id
        where v.event_type = 'view' and p.event_type = 'purchase'"""


def _every_slide(events: str, slide: str, panes: int) -> str:
    """Lists of the three most frequent types per sliding window, one for every window."""
    return f"""
        with expanded as (
          select event_type, time_bucket(interval 1 {slide}, ts, timestamp '1970-01-01') - to_{slide}s(k::int) window_start
          from {events} e, range(0, {panes}) t(k)),
        spine as (
          select unnest(generate_series(min(window_start), max(window_start), interval 1 {slide})) window_start
          from expanded),
        counted as (
          select window_start, event_type, count(*) n from expanded where event_type is not null group by all),
        ranked as (
          select *, row_number() over (partition by window_start order by n desc, event_type) rank from counted),
        lists as (
          select window_start, to_json(list({{'word': event_type, 'count': n}} order by rank))::varchar json
          from ranked where rank <= 3 group by window_start)
        select window_start, window_start + interval {panes} {slide} window_end, coalesce(json, '[]') json
        from spine left join lists using (window_start)"""


ORACLES: dict[str, str] = {
    "lines_source": f"with {_LINES} select doc_id, line_no, seq, line as text from lines",
    "assign_ids": f"""with {_LINES}
        select md5(concat(doc_id, ':', line_no)) id, doc_id, line_no from lines""",
    "tokenize": f"""with {_LINES},
        token_arrays as (
          select doc_id, line_no,
                 case when line = '' then [''] when rtrim(line, ' ') = '' then []
                      else string_split(rtrim(line, ' '), ' ') end t
          from lines)
        select doc_id, line_no, (generate_subscripts(t, 1) - 1)::bigint word_no, unnest(t) word from token_arrays""",
    "five_char_words": f"with {_WORDS} select seq, arrival_ts, word from words",
    "pane_counts": f"with {_WORDS} select arrival_ts, word, count(*) as count from words group by all",
    "sliding_word_counts": f"with {_COUNTS} select window_start, window_end, word, n as count from counts",
    "sliding_word_counts_panes": f"with {_COUNTS} select window_start, window_end, word, n as count from counts",
    "windowed_topk": f"with {_TOPK} select {_TOPK_COLUMNS} from topk",
    "topk_last_window": f"""with {_WORDS}
        select word, count(*) as count from words
        where arrival_ts >= (select max(arrival_ts) from sentences) - interval 4 second
        group by word order by count desc, word limit 10""",
    "word_weights": f"""with {_TOPK}
        select {_TOPK_COLUMNS}, round(n / (max(n) over (partition by window_start) / 100.0::double), 6) weight
        from topk""",
    "topk_json": f"with {_JSON} select window_start, window_end, json from lists",
    "global_sort": f"""with {_WORDS}
        select row_number() over (order by n desc, word) rank, word, n as count
        from (select word, count(*) n from words group by word)""",
    "latest_snapshot": f"""with {_JSON}
        select 1::int id, window_end as version, json from lists order by window_end desc limit 1""",
    "snapshot_or_empty": f"""with {_JSON},
        current as (select 1 id, json from lists order by window_end desc limit 1)
        select asked.id::int id, coalesce(json, '[]') json
        from (values (1), (2)) asked(id) left join current using (id)""",
    "upsert_latest": """
        select * from events qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1""",
    "template_match": "select * from events where event_type = 'click'",
    "demux_templates": """
        select 'all' stream, event_id, user_id, event_type from events
        union all
        select 'clicks', event_id, user_id, event_type from events where event_type = 'click'
        union all
        select 'user_7', event_id, user_id, event_type from events where user_id = 7
        union all
        select 'user_7_clicks', event_id, user_id, event_type from events
        where user_id = 7 and event_type = 'click'""",
    "fifo_batches": """
        select event_id, event_type, value, p "position", p // 50 batch
        from (select *, row_number() over (order by event_id) - 1 p from events where event_type = 'click')""",
    "fifo_head": """
        select * from events where user_id = 7 and event_type = 'click' order by event_id limit 1""",
    "substreams_split": "select event_id, event_type, value, event_id % 8 reader from events",
    "union_streams": """
        select 'documents' origin, doc_id id, 0::bigint part, text from documents
        union all
        select 'conversations', conv_id, turn, text from conversations""",
    "cyclic_replay": _replay(2),
    "cyclic_replay_stream": _replay(1),
    "sliding_event_counts": f"""with {_HOURS}
        select window_start, window_start + interval 5 hour window_end, event_type, count(*) as count
        from expanded group by all""",
    "sliding_counts_with_empty": """
        with expanded as (
          select time_bucket(interval 1 minute, ts, timestamp '1970-01-01') - to_minutes(k::int) window_start
          from events, range(0, 5) t(k)),
        counted as (select window_start, count(*) n from expanded group by all),
        spine as (
          select unnest(generate_series(min(window_start), max(window_start), interval 1 minute)) window_start
          from counted)
        select window_start, window_start + interval 5 minute window_end, coalesce(n, 0) as count
        from spine left join counted using (window_start)""",
    "arrival_rate": """
        select time_bucket(interval 1 minute, ts, timestamp '1970-01-01') slot, count(*) n from events group by all""",
    "overrun_report": f"""with {_HOURLY},
        limits as (select (sum(n) * 3)::bigint // (count(*) * 2) budget from rates)
        select slot, n, n - budget as "over" from rates, limits where n > budget""",
    "windowed_rows": f"""with {_HOURS}
        select event_id, ts, event_type, window_start, window_start + interval 5 hour window_end from expanded""",
    "windowed_reduce": f"""with {_HOURS}
        select window_start, window_start + interval 5 hour window_end, count(*) n,
               sum(value::decimal(28, 10))::double total, min(value) least, max(value) most
        from expanded group by window_start""",
    "windowed_join": _JOINED,
    "append_sink": "select * from events",
    "stream_source": "select * from events where event_type = 'purchase'",
    "poll_source": "select * from conversations where role = 'user'",
    "sliding_topk_stream": f"with {_TOPK} select {_TOPK_COLUMNS} from topk",
    "foreach_batch_topk": f"with {_JSON} select 1::int id, window_end as version, json from lists",
    "fifo_stream": """
        select event_id, event_type, value, p "position", p // 50 batch
        from (select *, row_number() over (order by event_id) - 1 p from events where user_id = 7)""",
    "template_index": """
        with templates as (
          select distinct t.event_type, u.user_id
          from events e, lateral (values (null), (e.event_type)) t(event_type), lateral (values (null), (e.user_id)) u(user_id))
        select coalesce(t.event_type, '*') || ':' || coalesce(t.user_id::varchar, '*') stream, e.event_id
        from templates t join events e
          on coalesce(t.event_type = e.event_type, t.event_type is null) and coalesce(t.user_id = e.user_id, t.user_id is null)""",
    "sliding_reduce": """
        with expanded as (
          select value, time_bucket(interval 1 minute, ts, timestamp '1970-01-01') - to_minutes(k::int) window_start
          from events, range(0, 300) t(k))
        select window_start, window_start + interval 5 hour window_end, count(*) n,
               sum(value::decimal(28, 10))::double total, min(value) least, max(value) most
        from expanded group by window_start""",
    "topk_every_slide": _every_slide("events", "minute", 5),
    "topk_every_slide_stream": _every_slide("(select * from events where user_id = 7)", "hour", 5),
    "windowed_join_stream": _JOINED,
    "union_live": """
        select time_bucket(interval 1 hour, ts, timestamp '1970-01-01') slot, count(*) n
        from events where event_type in ('view', 'purchase') group by all""",
}
