"""SQL functions of the library, as temporary SQL functions: the optimizer sees their bodies."""

from __future__ import annotations

from pyspark.sql import SparkSession

BODIES = {
    "revcomp(s STRING) RETURNS STRING": "translate(reverse(upper(s)), 'ACGT', 'TGCA')",
    "gc_percent(s STRING) RETURNS DOUBLE": "try_divide(100.0D * (length(s) - length(translate(upper(s), 'GC', ''))), length(s))",
    "kmers(s STRING, k INT) RETURNS ARRAY<STRING>": "CASE WHEN length(s) >= k THEN transform(sequence(1, length(s) - k + 1), i -> substring(s, i, k)) ELSE CAST(array() AS ARRAY<STRING>) END",
    "canonical_kmer(s STRING) RETURNS STRING": "least(s, translate(reverse(upper(s)), 'ACGT', 'TGCA'))",
    "mean_phred(q STRING) RETURNS DOUBLE": "try_divide(aggregate(transform(filter(split(q, ''), c -> c <> ''), c -> ascii(c) - 33), 0, (a, x) -> a + x), length(q))",
    "degap(s STRING) RETURNS STRING": "btrim(replace(s, '-', ''), '.')",
    "count_runs(s STRING, c STRING, least INT) RETURNS INT": "regexp_count(s, concat('[', c, ']{', least, ',}'))",
}


def register(spark: SparkSession) -> list[str]:
    """Make revcomp, gc_percent, kmers, canonical_kmer, mean_phred, degap and count_runs known to SQL; gives their names."""
    for head, body in BODIES.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")
    return [h.split("(")[0] for h in BODIES]
