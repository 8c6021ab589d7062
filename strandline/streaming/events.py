"""Event-time aggregates. The same functions take a batch or a stream; on a stream, rows later than the watermark are dropped by Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def watermarked(events: DataFrame, late: str) -> DataFrame:
    return events.withWatermark("ts", late) if events.isStreaming else events


def tumbling(events: DataFrame, width: str, late: str = "1 hour", slide: str | None = None) -> DataFrame:
    """start, event_type, n, total of windows; with slide, windows overlap."""
    w = F.window("ts", width, slide) if slide else F.window("ts", width)
    return watermarked(events, late).groupBy(w.alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), "event_type", "n", "total")


def sessions(events: DataFrame, gap: str, late: str = "1 hour") -> DataFrame:
    """user_id, start, stop, n of sessions that end after a gap."""
    s = watermarked(events, late).groupBy(F.session_window("ts", gap).alias("s"), "user_id").agg(F.count("*").alias("n"))
    return s.select("user_id", F.col("s.start").alias("start"), F.col("s.end").alias("stop"), "n")


PAIRED = "pair string, first string, second string, at timestamp"


def paired(reads: DataFrame, wait: str = "1 hour", late: str = "1 hour") -> DataFrame:
    """Mates that come apart, as one row: pair, first, second (seq of mate 0 and 1, null if it never came), at (the later one's ts).

    reads: pair, mate (0 or 1), seq, ts. Two mates are one pair if their ts are at most `wait` apart, else each comes alone. Of several rows
    of one mate the earliest counts, then the lesser seq. The batch is an aggregate.

    On a stream a key's state is the mates seen so far. They are given out once the watermark, `late` behind the newest ts, is past all that
    could still change them: `wait` after the later one, or after the only one. Then the state goes, so it holds what lies between the
    watermark and the newest rows, and no more. Rows behind the watermark are dropped by Spark. Batch and stream agree if none was, and no
    mate comes again after its pair was given out.
    """
    if not reads.isStreaming:
        mate = lambda k: F.min(F.when(F.col("mate") == k, F.struct("ts", F.coalesce("seq", F.lit("")).alias("seq"))))
        both = reads.where("pair is not null and ts is not null").groupBy(F.col("pair").cast("string").alias("pair")).agg(mate(0).alias("a"), mate(1).alias("b"))
        near = F.abs(F.unix_micros("a.ts") - F.unix_micros("b.ts")) <= F.lit(_micros(wait))
        one = lambda a, b, at: F.struct(a.alias("first"), b.alias("second"), at.alias("at"))
        none = F.lit(None).cast("string")
        whole = F.array(one(F.col("a.seq"), F.col("b.seq"), F.greatest("a.ts", "b.ts")))
        alone = F.array_compact(F.array(F.when(F.col("a").isNotNull(), one(F.col("a.seq"), none, F.col("a.ts"))), F.when(F.col("b").isNotNull(), one(none, F.col("b.seq"), F.col("b.ts")))))
        return both.select("pair", F.explode(F.when(F.coalesce(near, F.lit(False)), whole).otherwise(alone)).alias("x")).select("pair", "x.first", "x.second", "x.at")
    rows = reads.where("pair is not null and ts is not null and mate in (0, 1)").select(F.col("pair").cast("string").alias("pair"), F.col("mate").cast("int").alias("mate"), F.coalesce("seq", F.lit("")).alias("seq"), "ts")
    held = "ts0 long, seq0 string, ts1 long, seq1 string"
    return rows.withWatermark("ts", late).groupBy("pair").applyInPandasWithState(_pairing(_micros(wait)), PAIRED, held, "append", "EventTimeTimeout")


def _micros(span: str) -> int:
    import pandas as pd

    return int(pd.Timedelta(span).total_seconds() * 1_000_000)


def _pairing(wait: int):
    import pandas as pd

    def out(pair: str, first, second, at: int) -> pd.DataFrame:
        return pd.DataFrame({"pair": [pair], "first": [first], "second": [second], "at": [pd.Timestamp(at, unit="us")]})

    def run(key, frames, state):
        (pair,) = key
        ts0, seq0, ts1, seq1 = state.get if state.exists else (None, None, None, None)
        if state.hasTimedOut:
            state.remove()
            if ts0 is not None and ts1 is not None and abs(ts0 - ts1) <= wait:
                yield out(pair, seq0, seq1, max(ts0, ts1))
                return
            if ts0 is not None:
                yield out(pair, seq0, None, ts0)
            if ts1 is not None:
                yield out(pair, None, seq1, ts1)
            return
        for pdf in frames:
            micros = pdf.ts.astype("datetime64[us]").astype("int64")
            for mate, seq, ts in zip(pdf.mate, pdf.seq, micros):
                if mate == 0 and (ts0 is None or (ts, seq) < (ts0, seq0)):
                    ts0, seq0 = int(ts), seq
                elif mate == 1 and (ts1 is None or (ts, seq) < (ts1, seq1)):
                    ts1, seq1 = int(ts), seq
        state.update((ts0, seq0, ts1, seq1))
        # never behind the watermark, which Spark refuses
        due = (max(x for x in (ts0, ts1) if x is not None) + wait) // 1000 + 1
        state.setTimeoutTimestamp(max(due, state.getCurrentWatermarkMs() + 1))

    return run
