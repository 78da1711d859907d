"""Column functions on sequences, alignments, names and annotations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def reverse_complement(seq: Column) -> Column:
    """Upper case, reversed, ACGT complemented; N, _ and - stay."""
    return F.translate(F.reverse(F.upper(seq)), "ACGT", "TGCA")


def has_foreign_letters(seq: Column) -> Column:
    return F.upper(seq).rlike("[^ACGTN_-]")


def alignment_end(pos: Column, cigar: Column) -> Column:
    """Last reference position (inclusive) of an alignment that starts at pos; pos - 1 if it covers none."""
    lengths = F.transform(F.regexp_extract_all(cigar, F.lit("([0-9]+)[MDN=X]"), F.lit(1)), lambda n: n.cast("int"))
    return pos + F.aggregate(lengths, F.lit(0), lambda a, n: a + n) - 1


def sanitize_name(name: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(name, "[^A-Za-z0-9._-]", "_"), "_+", "_"), F.lit("_"))


def first_token(name: Column) -> Column:
    return F.split(name, "[ \\t]").getItem(0)


def last_field(name: Column) -> Column:
    return F.element_at(F.split(name, ":"), -1)


def second_last_field(name: Column) -> Column:
    """Null if there are fewer than two fields."""
    return F.try_element_at(F.split(name, ":"), F.lit(-2))


# The fields of an annotation, " ALN=", "DEL= INS= SUB=" and "ALN_REF", in the patterns below.


def annotation_reference(line: Column) -> Column:
    return F.regexp_extract(line, r" ALN=(\S+) ", 1)


def annotation_edits(line: Column, ignore_substitutions: bool = False) -> Column:
    """The edit fields of an annotation, or the empty string."""
    pattern = "(DEL=.* INS=.*) SUB=.* ALN_REF" if ignore_substitutions else "(DEL=.* INS=.* SUB=.*) ALN_REF"
    return F.regexp_extract(line, pattern, 1)


def mutation_type(edits: Column) -> Column:
    """U if no field of `DEL=.. INS=.. SUB=..` has a value, else the letters D, I, S of those that have."""
    kinds = F.concat(*[F.when(F.regexp_extract(edits, rf"{name}=(\S+)", 1) != "", letter).otherwise("") for name, letter in (("DEL", "D"), ("INS", "I"), ("SUB", "S"))])
    return F.when(kinds == "", "U").otherwise(kinds)


def pct_half_up(part: Column, whole: Column) -> Column:
    """100 * part / whole rounded half up to two decimals from integers; null if whole is 0 or null."""
    part, whole = part.cast("long"), whole.cast("long")
    scaled = F.when(whole > 0, F.expr("1").cast("long") * (part * 20000 + whole))
    return F.floor(scaled / (whole * 2)).cast("double") / 100


def safe_pct(part: Column, whole: Column) -> Column:
    """100 * part / whole with two decimals, 0 if whole is not positive."""
    return F.coalesce(pct_half_up(part, whole), F.lit(0.0))


def parse_na_number(token: Column) -> Column:
    """A number, or null for NA and whatever is none."""
    return token.try_cast("double")
