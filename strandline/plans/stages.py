"""Queries on staged counts, logs and events."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..catalog import query
from ..operators import matrix as ops


@query("w9_stage_delta", """
    WITH n AS (SELECT event_type AS stage, count(*) AS reads, count(DISTINCT user_id % 25) AS otus FROM events GROUP BY 1)
    SELECT stage, reads, otus, coalesce(reads - lead(reads) OVER (ORDER BY stage), 0) AS lost, round(100.0 * abs(coalesce(reads - lead(reads) OVER (ORDER BY stage), 0)) / first_value(reads) OVER (ORDER BY stage), 6) AS pct FROM n""")
def _(v):
    s = v.table("events").select(F.col("event_type").alias("stage"), (F.col("user_id") % 25).alias("otu"), F.lit(1).cast("long").alias("count"))
    return ops.stage_track(s, "stage")


@query("a46_track_counts", "SELECT sample, event_type AS stage, count(*) AS n, count(*) - coalesce(lead(count(*)) OVER (PARTITION BY sample ORDER BY event_type), 0) AS drop_ FROM (SELECT user_id % 40 AS sample, event_type FROM events) GROUP BY 1, 2")
def _(v):
    n = v.table("events").groupBy((F.col("user_id") % 40).alias("sample"), F.col("event_type").alias("stage")).agg(F.count("*").alias("n"))
    return n.withColumn("drop_", F.col("n") - F.coalesce(F.lead("n").over(W.partitionBy("sample").orderBy("stage")), F.lit(0)))


@query("w9_step_durations", "SELECT event_id, coalesce(CAST(epoch(date_trunc('second', lead(ts) OVER w)) - epoch(date_trunc('second', ts)) AS BIGINT), 0) AS seconds FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)")
def _(v):
    w = W.partitionBy("user_id").orderBy("ts", "event_id")
    return v.table("events").select("event_id", F.coalesce(F.unix_timestamp(F.lead("ts").over(w)) - F.unix_timestamp("ts"), F.lit(0)).alias("seconds"))


@query("a48_before_after_marks", """
    WITH m AS (SELECT user_id, event_type AS test, CAST(strftime(ts, '%d') AS INTEGER) <= 15 AS early, max(CASE WHEN value > 49 THEN 'FAIL' ELSE 'PASS' END) AS mark FROM events GROUP BY 1, 2, 3)
    SELECT a.user_id, a.test, a.mark AS was, b.mark AS now_ FROM m a JOIN m b ON a.user_id = b.user_id AND a.test = b.test AND a.early AND NOT b.early WHERE a.mark <> b.mark""")
def _(v):
    m = v.table("events").groupBy("user_id", F.col("event_type").alias("test"), (F.dayofmonth("ts") <= 15).alias("early")).agg(F.max(F.when(F.col("value") > 49, "FAIL").otherwise("PASS")).alias("mark"))
    w = m.groupBy("user_id", "test").agg(F.max(F.when(F.col("early"), F.col("mark"))).alias("was"), F.max(F.when(~F.col("early"), F.col("mark"))).alias("now_"))
    return w.where("was <> now_")


@query("a47_line_counts", "SELECT source, count(*) FILTER (regexp_matches(text, '[0-9]')) AS with_digits, count(*) FILTER (regexp_matches(text, '@')) AS with_at FROM documents GROUP BY 1")
def _(v):
    return v.table("documents").groupBy("source").agg(F.count_if(F.col("text").rlike("[0-9]")).alias("with_digits"), F.count_if(F.col("text").rlike("@")).alias("with_at"))


@query("t1_tumbling_window", "SELECT time_bucket(INTERVAL 6 HOURS, ts) AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def _(v):
    """Extra: event-time windows; streaming/events.py has the same on a stream."""
    from ..streaming.events import tumbling

    return tumbling(v.table("events"), "6 hours").withColumn("total", F.round("total", 4))


@query("t1_session_window", """
    WITH m AS (SELECT user_id, ts, CASE WHEN ts < lag(ts) OVER w + INTERVAL 6 HOURS THEN 0 ELSE 1 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
    s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM m) SELECT user_id, min(ts) AS start, count(*) AS n FROM s GROUP BY user_id, k""")
def _(v):
    """Extra: sessions."""
    from ..streaming.events import sessions

    return sessions(v.table("events"), "6 hours").select("user_id", "start", "n")


@query("t1_paired_mates", """
    WITH m AS (SELECT conv_id || ':' || (turn // 2) AS pair, min({'ts': 700 * turn * turn, 'seq': coalesce(text, '')}) FILTER (turn % 2 = 0) AS a, min({'ts': 700 * turn * turn, 'seq': coalesce(text, '')}) FILTER (turn % 2 = 1) AS b
      FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL GROUP BY 1),
    n AS (SELECT *, coalesce(abs(a.ts - b.ts) <= 3600, false) AS near FROM m)
    SELECT pair, a.seq AS first, b.seq AS second, CAST(greatest(a.ts, b.ts) AS BIGINT) AS at FROM n WHERE near
    UNION ALL SELECT pair, a.seq, NULL, CAST(a.ts AS BIGINT) FROM n WHERE NOT near AND a IS NOT NULL UNION ALL SELECT pair, NULL, b.seq, CAST(b.ts AS BIGINT) FROM n WHERE NOT near AND b IS NOT NULL""")
def _(v):
    """Turns as mates that come later and later: those within an hour are one row; on a stream, the same by state (see events.paired)."""
    from ..streaming.events import paired

    turn = F.col("turn")
    reads = v.table("conversations").select(F.concat(F.col("conv_id").cast("string"), F.lit(":"), F.floor(turn / 2).cast("string")).alias("pair"), (turn % 2).alias("mate"), F.col("text").alias("seq"), F.timestamp_seconds(700 * turn * turn).alias("ts"))
    return paired(reads, "1 hour").select("pair", "first", "second", F.unix_seconds("at").alias("at"))
