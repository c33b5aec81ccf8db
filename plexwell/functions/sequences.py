"""Column functions on bases and qualities; all stay in the JVM."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

#: IUPAC codes as sets of A=1, C=2, G=4, T=8 (fixed values of the nomenclature).
IUPAC = {
    "=": 0, "A": 1, "C": 2, "G": 4, "T": 8, "U": 8, "M": 3, "R": 5, "W": 9, "S": 6, "Y": 10, "K": 12, "V": 7, "H": 11, "D": 13, "B": 14, "N": 15,
}


def iupac_mask(base: Column) -> Column:
    """The code of one base; letters that are none count as N."""
    table = F.create_map(*(F.lit(x) for pair in IUPAC.items() for x in pair))
    return F.coalesce(F.try_element_at(table, F.upper(base)), F.lit(15))


def iupac_masks(seq: Column) -> Column:
    return F.transform(F.filter(F.split(seq, ""), lambda c: c != ""), iupac_mask)


def count_of(seq: Column, letters: str) -> Column:
    """How many characters of ``seq`` are among ``letters``."""
    return F.length(seq) - F.length(F.translate(seq, letters, ""))


def low_qualities(qual: Column, least: int, phred: int = 33) -> Column:
    """How many qualities lie below ``least``: characters below a code, counted without decoding."""
    return count_of(qual, "".join(map(chr, range(phred, phred + least))))


def qualities(qual: Column, phred: int = 33) -> Column:
    return F.transform(F.filter(F.split(qual, ""), lambda c: c != ""), lambda c: F.ascii(c) - phred)


def mismatches(a: Column, b: Column, length: int) -> Column:
    """Places where two sequences of ``length`` share no base; N shares all. Plain letters and N only."""
    n = F.lit("N")
    terms = []
    for k in range(1, length + 1):
        x, y = F.substr(a, F.lit(k), F.lit(1)), F.substr(b, F.lit(k), F.lit(1))
        terms.append(F.when((x == y) | (x == n) | (y == n), 0).otherwise(1))
    return reduce(add, terms)


def iupac_mismatches(a: Column, b: Column) -> Column:
    """Places where two sequences of one length share no base under IUPAC codes."""
    return F.aggregate(F.zip_with(iupac_masks(a), iupac_masks(b), lambda x, y: F.when(x.bitwiseAND(y) == 0, 1).otherwise(0)), F.lit(0), add)


def hamming(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: F.when(x.eqNullSafe(y), 0).otherwise(1)), F.lit(0), add)


def homopolymer_at(seq: Column, length: int) -> Column:
    """Bases before the first run of ``length`` equal ones; null without one."""
    found = [F.nullif(F.instr(seq, F.lit(b * length)), F.lit(0)) for b in "ACGTN"]
    return F.least(*found) - 1


def fuzzy_homopolymer_at(seq: Column, length: int, allowed: int) -> Column:
    """Bases before the first window of ``length`` in which at most ``allowed`` differ from one base; null without one."""
    starts = F.when(F.length(seq) >= length, F.sequence(F.lit(1), F.length(seq) - length + 1)).otherwise(F.array().cast("array<int>"))

    def near(i: Column) -> Column:
        window = F.substr(seq, i, F.lit(length))
        return F.greatest(*(count_of(window, b) for b in "ACGTN")) >= length - allowed

    return F.get(F.filter(starts, near), 0) - 1


def adapter_at(seq: Column, adapter: str, min_overlap: int = 5) -> Column:
    """Bases before a 3' adapter with at most one mismatch; null without one.

    The leftmost exact hit; else 0 where the read starts with the adapter less its first base; else the rightmost hit with
    one mismatch; else the longest part of the adapter that hangs over the end with at most one.
    """
    m = len(adapter)
    n = F.length(seq)
    exact = F.nullif(F.regexp_instr(seq, F.lit(_with_mismatch(adapter, 0))), F.lit(0)) - 1
    start = F.when(seq.rlike("^" + _with_mismatch(adapter[1:], 0)), 0)
    # the rightmost hit is the leftmost one of the reversed read
    near = n - m + 1 - F.nullif(F.regexp_instr(F.reverse(seq), F.lit(_with_mismatch(adapter[::-1], 1))), F.lit(0))
    tail = F.right(seq, F.lit(m - 1))
    ends = "|".join(_with_mismatch(adapter[:k], 1) for k in range(m - 1, min_overlap - 1, -1))
    hanging = n - F.length(tail) + F.nullif(F.regexp_instr(tail, F.lit(f"(?:{ends})$")), F.lit(0)) - 1
    return F.coalesce(exact, start, near, hanging).cast("int")


def _with_mismatch(bases: str, allowed: int) -> str:
    """A pattern of ``bases``, N standing for any, with at most ``allowed`` (0 or 1) of them different."""
    told = [f"[{b}N]" for b in bases]
    if not allowed:
        return "".join(told)
    return "(?:" + "|".join("".join([*told[:k], "[^\\n]", *told[k + 1 :]]) for k in range(len(bases))) + ")"


def quality_cut(seq: Column, qual: Column, least: int, phred: int = 33) -> Column:
    """Bases that stay when the 3' end is cut where the sum of ``least`` less quality is greatest; G counts as below."""
    start = F.struct(F.lit(0).alias("s"), F.lit(0).alias("top"), F.length(seq).alias("cut"), F.lit(False).alias("over"))

    def step(acc: Column, i: Column) -> Column:
        q = F.when(F.substr(seq, i, F.lit(1)) == "G", least - 1).otherwise(F.ascii(F.substr(qual, i, F.lit(1))) - phred)
        s = acc["s"] + least - q
        over = acc["over"] | (s < 0)
        better = ~over & (s > acc["top"])
        return F.struct(
            s.alias("s"), F.when(better, s).otherwise(acc["top"]).alias("top"), F.when(better, i - 1).otherwise(acc["cut"]).alias("cut"), over.alias("over")
        )

    places = F.when(F.length(seq) > 0, F.sequence(F.length(seq), F.lit(1), F.lit(-1))).otherwise(F.array().cast("array<int>"))
    # a good last base that is no G ends the scan at once, which spares most reads the aggregate
    good = (F.right(seq, F.lit(1)) != "G") & (F.ascii(F.right(qual, F.lit(1))) - phred > least)
    return F.when(good, F.length(seq)).otherwise(F.aggregate(places, start, step, lambda acc: acc["cut"]))


def well_id(bc_idx: Column) -> Column:
    return F.when(bc_idx < 0, "noBC").otherwise(F.lpad(bc_idx.cast("string"), 4, "0"))


def placement(chrom: Column, strand: Column, start: Column, end: Column) -> Column:
    """chromosome, strand and range as one text."""
    return F.concat(chrom, F.lit(":"), strand, F.lit(":"), start.cast("string"), F.lit("-"), end.cast("string"))


def split_words(text: Column, delimiter: str) -> Column:
    """Parts between delimiters; adjacent delimiters count as one."""
    return F.filter(F.split(text, f"\\Q{delimiter}\\E"), lambda x: x != "")


def join_words(parts: Column, delimiter: str) -> Column:
    return F.array_join(parts, delimiter)
