"""Column helpers for sequences, qualities and labels. All are built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LETTERS, BASES = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "ACGTACGTACGTACGTACGTACGTNN"


def letters(text: Column) -> Column:
    """ASCII letters of a text, upper case. Other letters go first: engines differ in their upper case."""
    return F.upper(F.regexp_replace(text, "[^A-Za-z]", ""))


def dna(seq: Column) -> Column:
    """A deterministic base for each letter of an upper-case text."""
    return F.translate(seq, LETTERS, BASES)


def reverse_complement(seq: Column) -> Column:
    """Upper case, reversed, A<->T and C<->G; other letters stay."""
    return F.translate(F.reverse(F.upper(seq)), "ACGT", "TGCA")


def base_count(seq: Column, bases: str) -> Column:
    """Occurrences of any of the bases, in either case."""
    up = F.upper(seq)
    return (F.length(up) - F.length(F.translate(up, bases, ""))).cast("long")


def percent(part: Column, whole: Column) -> Column:
    """100 part / whole, null where whole is 0."""
    return F.try_divide(part * F.lit(100.0), whole)


def gc_percent(seq: Column) -> Column:
    return percent(base_count(seq, "GC"), F.length(seq))


def kmers(seq: Column, k: int) -> Column:
    """Overlapping k-mers as an array, empty for sequences shorter than k."""
    n = F.length(seq) - F.lit(k - 1)
    return F.when(n > 0, F.transform(F.sequence(F.lit(1), n), lambda i: F.substring(seq, i, F.lit(k)))).otherwise(F.array().cast("array<string>"))


def canonical(kmer: Column) -> Column:
    """The lesser of a k-mer and its reverse complement."""
    return F.least(kmer, reverse_complement(kmer))


def degap(seq: Column) -> Column:
    """Without gaps, and without dots at the ends."""
    return F.btrim(F.replace(seq, F.lit("-"), F.lit("")), F.lit("."))


#: Five-bit digits of base32 in order.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32(text: Column) -> Column:
    """RFC 4648 base32 of a text's UTF-8 bytes, without padding: a header as letters and digits that every tool keeps."""
    code = F.hex(F.encode(F.coalesce(text, F.lit("")), "UTF-8"))
    # five bytes at a time are a number of 40 bits, and eight digits
    numbers = F.transform(_blocks(code, 10), lambda x: F.conv(F.rpad(x, 10, "0"), 16, 10).cast("long"))
    digits = F.transform(numbers, lambda x: F.concat(*(F.substring(F.lit(BASE32), F.shiftright(x, s).bitwiseAND(31).cast("int") + 1, F.lit(1)) for s in range(35, -1, -5))))
    return F.left(F.array_join(digits, ""), F.ceil(F.length(code) * 4 / 5).cast("int"))


def from_base32(code: Column) -> Column:
    """The text that base32() was given; letters of either case, other characters are ignored."""
    digits = F.regexp_replace(F.upper(F.coalesce(code, F.lit(""))), f"[^{BASE32}]", "")
    value = lambda x, i: F.shiftleft((F.position(F.substring(x, i + 1, 1), F.lit(BASE32)) - 1).cast("long"), 35 - 5 * i)
    whole = F.transform(_blocks(digits, 8), lambda x: F.rpad(x, 8, BASE32[0]))
    codes = F.transform(F.transform(whole, lambda x: sum((value(x, i) for i in range(1, 8)), value(x, 0))), lambda x: F.lpad(F.hex(x), 10, "0"))
    return F.decode(F.unhex(F.left(F.array_join(codes, ""), (F.floor(F.length(digits) * 5 / 8) * 2).cast("int"))), "UTF-8")


def _blocks(text: Column, size: int) -> Column:
    """A text cut into parts of `size` characters, the last one shorter; each is cut out once."""
    return F.regexp_extract_all(text, F.lit(f"(.{{1,{size}}})"), F.lit(1))


def dna_letters(seq: Column) -> Column:
    """U to T, and no dots, dashes or blanks."""
    return F.translate(seq, "U.- \t\n\r", "T")


def phred(qual: Column, offset: int = 33) -> Column:
    """Quality values of a quality string."""
    return F.transform(F.filter(F.split(qual, ""), lambda c: c != ""), lambda c: F.ascii(c) - offset)


def mean_phred(qual: Column, offset: int = 33) -> Column:
    q = phred(qual, offset)
    return F.try_divide(F.aggregate(q, F.lit(0), lambda a, x: a + x), F.size(q))


def quality_string(values: Column, offset: int = 33) -> Column:
    """A quality string of space-separated values."""
    return F.array_join(F.transform(F.split(F.trim(values), r"\s+"), lambda x: F.char(x.cast("int") + offset)), "")


def beautify(header: Column) -> Column:
    """Blanks and other characters than letters and digits to one underscore, none at the ends."""
    return F.btrim(F.regexp_replace(F.regexp_replace(F.regexp_replace(header, r"\s+", "_"), r"\W+", "_"), "_+", "_"), F.lit("_"))


def first_token(header: Column) -> Column:
    return F.regexp_extract(header, r"^(\S*)", 1)


def column_at(line: Column, i: int, sep: str = "\t") -> Column:
    """Column i of a line, from 1, or from the end if negative; null if there is none."""
    return F.try_element_at(F.split(line, sep), F.lit(i))


def number_in(label: Column) -> Column:
    """The digits of a label as a number, for natural order."""
    return F.regexp_replace(label, r"\D", "").try_cast("bigint")


def jaccard(both: Column, a: Column, b: Column) -> Column:
    return F.try_divide(both.cast("double"), a + b - both)


def wrap_lines(seq: Column, width: int = 60) -> Column:
    return F.btrim(F.regexp_replace(seq, f"(.{{{width}}})", "$1\n"), F.lit("\n"))


def capital_first(s: Column) -> Column:
    """First letter upper case, the rest as it is."""
    return F.concat(F.upper(F.left(s, F.lit(1))), F.substring(s, F.lit(2), F.length(s)))
