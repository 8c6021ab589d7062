"""Spelling variants: words one edit apart, found by a rare-first filter on positional bigrams, and grouped under their most frequent form.

One inserted, deleted or replaced letter touches at most two bigrams of a word. So if all bigrams are put in one global order, the rarest
first, then of two words an edit apart the three first ones of each share a bigram that the edit does not touch. The edit lies either
behind that bigram, and then it stands at the same position after the same letters, or before it, and then it stands as far from the
end with the same letters behind: these limits of position are the join's key, along with the length. A pair is verified within the
join, so only words that are one edit apart leave it. Which bigrams are rare is counted over all words; letters bound how many there are.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, give_back, small_batches, table

RUN = re.compile("[A-Za-zÀ-ÿ]+")
NO_RUN = re.compile("[^A-Za-zÀ-ÿ]")
#: Only these are lower-cased.
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
#: A run loses a letter if this divides its checksum.
NOISE = 97
#: Least letters and occurrences of a word.
LETTERS, TIMES = 5, 3
#: Characters that are searched at once, and distinct words that a task holds before it sends their counts.
BLOCK, HELD = 1 << 20, 100_000
#: Bigrams of a word, the rarest first, of which two words an edit apart share one: an edit touches two.
RAREST = 3


def runs(text: str) -> Iterator[list[str]]:
    """The runs of letters, a block of text at a time."""
    at = 0
    while at < len(text):
        end = m.start() if len(text) - at > BLOCK and (m := NO_RUN.search(text, at + BLOCK)) else len(text)
        yield RUN.findall(text, at, end)
        at = end


def noisy(doc_id: int | None, run: str) -> str:
    """The lower-cased run, less one letter if the checksum of document and run says so."""
    word = run.lower() if run.isascii() else run.translate(LOWER)
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
    if h % NOISE:
        return word
    k = h % len(word)
    return word[:k] + word[k + 1 :]


def _count(batches):
    held: Counter[str] = Counter()

    def sent():
        out = pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], names=["word", "n"])
        held.clear()
        return out

    for batch in batches:
        for k in range(0, batch.num_rows, 64):
            for i, text in zip(*(c.to_pylist() for c in batch.slice(k, 64).columns)):
                for some in runs(text or ""):
                    for run, n in Counter(some).items():
                        if len(run) >= LETTERS and len(word := noisy(i, run)) >= LETTERS:
                            held[word] += n
                    if len(held) > HELD:
                        yield sent()
    yield sent()
    give_back()


def words(docs: DataFrame) -> DataFrame:
    """(word, n) of the words of at least LETTERS letters that occur TIMES times in the texts of all rows."""
    small_batches(docs.sparkSession)
    each = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_count, "word string, n long")
    return each.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= TIMES)


def near_pairs(vocabulary: DataFrame, keep: Scratch) -> DataFrame:
    """(word, n, near, near_n) of every two words (word, n) that are one edit apart, each way round, once."""
    grams = vocabulary.select("word", "n", F.expr("posexplode(transform(sequence(1, length(word) - 1), i -> substring(word, i, 2)))").alias("at", "gram"))
    # at most a row for every two of the 90 letters
    order = F.broadcast(grams.groupBy("gram").agg(F.count("*").alias("c")))
    rarest = grams.join(order, "gram").groupBy("word").agg(F.first("n").alias("n"), F.expr(f"slice(array_sort(collect_list(struct(c, gram, at))), 1, {RAREST})").alias("g"))
    rarest = rarest.withColumn("size", F.length("word"))
    # the letters as bits: an edit changes two at most
    rarest = rarest.withColumn("bits", F.expr("aggregate(split(word, ''), 0L, (a, c) -> a | shiftleft(1L, pmod(ascii(c), 64)))"))
    sides = "explode(flatten(transform(g, x -> array(xxhash64(x.gram, x.at, substring(word, 1, x.at)), xxhash64(x.gram, 'end', substring(word, x.at + 3))))))"
    keys = keep.save(rarest.select("word", "n", "size", "bits", F.expr(sides).alias("key")), "keys")
    short = keys.select("key", F.explode(F.array("size", F.col("size") + 1)).alias("length"), "size", "word", "n", "bits")
    far = keys.select(F.col("key").alias("near_key"), F.col("size").alias("near_size"), F.col("word").alias("near"), F.col("n").alias("near_n"), F.col("bits").alias("near_bits"))
    one = (F.bit_count(F.col("bits").bitwiseXOR(F.col("near_bits"))) <= 2) & ((F.col("size") < F.col("near_size")) | (F.col("word") < F.col("near"))) & (F.levenshtein("word", "near", 1) == 1)
    found = short.join(far, (F.col("key") == F.col("near_key")) & (F.col("length") == F.col("near_size")) & one).select("word", "n", "near", "near_n")
    both = found.unionByName(found.select(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n")))
    return both.distinct()


def roots(forms: DataFrame, keep: Scratch) -> DataFrame:
    """(word, root) of forms (word, form), root being the last form that is reached.

    A form occurs twice as often as its word at least, so no chain is longer than the logarithm of a count; each round doubles the steps.
    """
    now, mark, was = keep.save(forms.select("word", F.col("form").alias("root")), "roots"), None, -1
    while mark != was:
        was, seen = mark, Observation()
        on = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        new = now.join(on, "root", "left").observe(seen, F.count("next").alias("n"))
        new = keep.save(new.select("word", F.coalesce("next", "root").alias("root")), "roots")
        keep.drop(now)
        now, mark = new, seen.get["n"]
        if not mark:
            break
    return now


def variants(docs: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of the words of all documents.

    A word's form is its near word of largest n, of equals the first in code-point order, if that n is at least twice the word's; else
    null, as is form_n. n_near counts near words. root is where forms lead to, the word itself if it has none. Null and empty texts have no
    words. Rows may repeat and each counts; a null doc_id is written as nothing; other columns are ignored, whatever their names; an empty
    table gives no rows. Texts and words may be of any length.
    """
    keep = Scratch(docs.sparkSession)
    vocabulary = keep.save(words(docs), "words")
    best = near_pairs(vocabulary, keep).groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("m"), F.col("near").alias("form"))).alias("best"))
    known = vocabulary.join(best, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.expr("if(-best.m >= 2 * n, best, null)").alias("best"))
    known = keep.save(known.select("word", "n", "n_near", "best.form", (-F.col("best.m")).alias("form_n")), "forms")
    return known.join(roots(known.where("form is not null"), keep), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(table(spark, sf_dir, "documents"))


def _crc32_steps() -> list[int]:
    """What half a byte does to a CRC-32."""
    out = []
    for c in range(16):
        for _ in range(4):
            c = c >> 1 ^ (0xEDB88320 if c & 1 else 0)
        out.append(c)
    return out


OP11_SQL = f"""
WITH RECURSIVE found AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) AS run FROM documents) GROUP BY 1, 2),
coded AS (
  SELECT run, n, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS x FROM found),
hashed AS (
  SELECT run, n, xor(4294967295, list_reduce(
    list_transform(range(0, length(x)), lambda i: (strpos('0123456789ABCDEF', substr(x, xor(i, 1) + 1, 1)) - 1)::BIGINT),
    lambda c, d: xor(c >> 4, list_extract({_crc32_steps()}::BIGINT[], (xor(c, d) & 15) + 1)), 4294967295)) AS h FROM coded),
words AS (
  SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT CASE WHEN h % {NOISE} = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed)
  WHERE length(word) >= {LETTERS} GROUP BY word HAVING sum(n) >= {TIMES}),
less AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
pairs AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM less a JOIN less b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM less a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM less a JOIN words b ON a.rest = b.word),
best AS (SELECT word, near, near_n, count(*) OVER (PARTITION BY word) AS n_near, row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near) AS r FROM pairs),
forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN near_n >= 2 * w.n THEN near END AS form, CASE WHEN near_n >= 2 * w.n THEN near_n END AS form_n
  FROM words w LEFT JOIN best b ON b.word = w.word AND r = 1),
walk AS (SELECT word, word AS root, form AS next FROM forms UNION ALL SELECT walk.word, f.word, f.form FROM walk JOIN forms f ON f.word = walk.next)
SELECT f.word, f.form, root, f.n, f.n_near, f.form_n FROM forms f JOIN walk ON walk.word = f.word AND walk.next IS NULL"""
