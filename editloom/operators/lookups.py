"""Lookup tables from variants to names, with conflicts resolved in the order of insertion.

Exact entries (E) always write. A variant entry (V) whose key is there already deletes the key and bars it from
variants; later exact entries still write. In closed form: order the entries of a key; let c be the first V that is not
the key's first entry. Without c the last entry holds; else the last E after c, or none.

A whole lookup has a row for each variant: 83 for a primer of 18 bases. Jobs need only the keys that their reads show.
`entries_of_keys` finds those keys' entries by seeds, six rows a primer of 18 bases: a key with one substitution keeps
all but one of its parts, a shifted one all but its last or first base. The rule then decides among the same entries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.sequence import reverse_complement
from ..params import AssignParams

BASES = ("A", "C", "T", "G", "N")


def _spread(rows: DataFrame, by: str) -> DataFrame:
    """rows dealt out to spark.sql.shuffle.partitions tasks: a small file is one split, but each of its rows has hundreds of variants."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), by)


def _entries(named: DataFrame, substitutions: bool, shifts: bool) -> DataFrame:
    """(ord, key, value, kind) of names (base, name_key, value): each key itself; with each other base at each place, by place, then in the order of BASES;
    with each base before it but without its last (from 9,000 on), then after it but without its first. One pass, without lambda functions, which Spark interprets."""
    key, n, i = F.col("name_key"), F.length("name_key"), F.col("i")
    count = len(BASES)
    places = n * count if substitutions else F.lit(0)
    nth = F.expr(f"CAST((i - 1) % {count} AS INT)")
    at = F.expr(f"CAST((i - 1) DIV {count} AS INT)") + 1
    base = F.substring(F.lit("".join(BASES)), nth + 1, F.lit(1))
    substituted = F.when(F.substring(key, at, F.lit(1)) != base, F.concat(F.substring(key, F.lit(1), at - 1), base, F.substring(key, at + 1, n)))
    right, left = F.concat(base, F.substring(key, F.lit(1), n - 1)), F.concat(F.substring(key, F.lit(2), n), base)
    upto = F.coalesce(places + (2 * count if shifts else 0), F.lit(0))
    each = _spread(named, "base").select("base", "name_key", "value", F.explode(F.sequence(F.lit(0), upto)).alias("i"))
    variant = F.when(i <= places, substituted).when(i <= places + count, right).otherwise(left)
    found = each.select((F.col("base") + F.when(i == 0, i).when(i <= places, i).otherwise(9_000 + i - places - 1)).alias("ord"), F.when(i == 0, key).otherwise(variant).alias("key"), "value", F.when(i == 0, "E").otherwise("V").alias("kind"))
    return found.where("key IS NOT NULL OR kind = 'E'")


def primer_ends(amplicons: DataFrame, k: int) -> DataFrame:
    """(ordinal, amplicon, end_no, primer): first k bases, their reverse complement, last k bases, theirs (end_no 0 to 3)."""
    first, last = F.substring("sequence", F.lit(1), F.lit(k)), F.substring("sequence", F.greatest(F.lit(1), F.length("sequence") - k + 1), F.lit(k))
    ends = F.array(first, reverse_complement(first), last, reverse_complement(last))
    return amplicons.select("ordinal", "amplicon", F.posexplode(ends).alias("end_no", "primer"))


def _named_barcodes(barcodes: DataFrame) -> DataFrame:
    return barcodes.select((F.col("ordinal").cast("long") * 10_000).alias("base"), F.col("barcode").alias("name_key"), F.col("barcode").alias("value"))


def _named_primers(amplicons: DataFrame, params: AssignParams) -> DataFrame:
    return primer_ends(amplicons, params.primer_length).select(((F.col("ordinal").cast("long") * 4 + F.col("end_no")) * 10_000).alias("base"), F.col("primer").alias("name_key"), F.col("amplicon").alias("value"))


def barcode_entries(barcodes: DataFrame, mismatches: bool = True) -> DataFrame:
    """Entries of a whitelist (ordinal, barcode) in order: each barcode, then its one-base variants."""
    return _entries(_named_barcodes(barcodes), mismatches, False)


def primer_entries(amplicons: DataFrame, params: AssignParams = AssignParams(), substitutions: bool = True) -> DataFrame:
    """Entries of the primers of amplicons (ordinal, amplicon, sequence): each primer, its substitutions (if wanted), its shifts."""
    return _entries(_named_primers(amplicons, params), params.off_by_one and substitutions, params.off_by_one)


def _least_repeats(named: DataFrame) -> DataFrame:
    """Of equal names with equal values the first two and the last: the first two decide a conflict of their variants, the last writes last. Others change no lookup."""
    same = Window.partitionBy("name_key", "value")
    marked = named.withColumn("_up", F.row_number().over(same.orderBy("base"))).withColumn("_last", F.max("base").over(same))
    return marked.where("_up <= 2 OR base = _last").drop("_up", "_last")


#: Kinds of seeds: the whole key, if it has no parts; a key that starts, or ends, with another base; from 1 on, the key without one of its parts.
_WHOLE, _RIGHT, _LEFT = 0, -1, -2
#: Bases that a seed keeps where the key has more, about: so many that different keys hardly share one.
_KEPT = 13


def _part(key: Column) -> Column:
    """Length of a key's parts: one base of short keys."""
    return F.greatest(F.lit(1), F.length(key) - _KEPT)


def _without(key: Column, kind: Column) -> Column:
    """The key without its part of that number, with the key's length."""
    size = _part(key)
    return F.concat(F.substring(key, F.lit(1), (kind - 1) * size), F.lit("|"), F.substring(key, kind * size + 1, F.length(key)), F.lit(":"), F.length(key).cast("string"))


def _but_first(key: Column) -> Column:
    return F.substring(key, F.lit(2), F.length(key))


def _but_last(key: Column) -> Column:
    return F.substring(key, F.lit(1), F.length(key) - 1)


def _seeded(rows: DataFrame, key: str, substitutions: bool, shifts: bool, right, left) -> DataFrame:
    """A row for each seed of key: its kind and seed, which is a hash of kind and text. One pass, without lambda functions, which Spark interprets."""
    k, kind = F.col(key), F.col("kind")
    parts = F.when(F.length(k) > 0, F.ceil(F.length(k) / _part(k)).cast("int")).otherwise(0) if substitutions else F.lit(0)
    each = rows.where(k.isNotNull()).withColumn("kind", F.explode(F.sequence(F.lit(_LEFT if shifts else _WHOLE), parts))).where((kind != _WHOLE) | (parts == 0))
    text = F.when(kind == _WHOLE, k).when(kind == _RIGHT, right(k)).when(kind == _LEFT, left(k)).otherwise(_without(k, kind))
    return each.withColumn("seed", F.xxhash64("kind", text))


def entries_of_keys(keys: DataFrame, named: DataFrame, substitutions: bool = True, shifts: bool = False) -> DataFrame:
    """(ord, key, value, kind) of all entries whose key is one of keys (key, distinct): exact ones and variants of named (base, name_key, value); values are null if named has none.

    Both sides are joined by hashes of seeds; of what meets, only pairs one substitution or shift apart remain. Keys of null
    have none. Names with bases instead of base (see _repeats_in_one) give an exact entry at the first and the last of them,
    and a variant at the first two: the others change no lookup.
    """
    q, p, kind, repeated = F.col("key"), F.col("name_key"), F.col("kind"), "bases" in named.columns
    base, values = "bases" if repeated else "base", [c for c in ("value",) if c in named.columns]
    seen = _seeded(keys.select("key"), "key", substitutions, shifts, _but_first, _but_last)
    known = _seeded(_spread(named, "name_key" if repeated else "base").select(base, "name_key", *values), "name_key", substitutions, shifts, _but_last, _but_first)
    # Spark's estimate of either side does not see that it was exploded, so without the hint it would broadcast large ones too.
    # A hash is half as long as its text and sorts as a number; texts are compared where hashes meet, as two can have one hash.
    met = seen.join(known.drop("kind").hint("merge"), "seed")
    # A key meets itself by each of its parts: all but the first of those pairs go before their letters are compared, which costs most here.
    exact = (kind == _WHOLE) | ((kind == 1) & (q == p))
    met = met.where(F.when(exact, q == p).when(kind == _RIGHT, _but_first(q) == _but_last(p)).when(kind == _LEFT, _but_last(q) == _but_first(p)).otherwise((q != p) & (_without(q, kind) == _without(p, kind))))

    bases = F.array(*map(F.lit, BASES))
    base_at = lambda place: F.array_position(bases, F.substring(q, place, F.lit(1))) - 1  # noqa: E731  under 0: another letter
    start, length = (kind - 1) * _part(p), F.least(_part(p), F.length(p) - (kind - 1) * _part(p))
    places = F.filter(F.sequence(F.lit(1), length), lambda j: F.substring(p, start + j, F.lit(1)) != F.substring(q, start + j, F.lit(1)))
    # A column of its own, so that the comparison runs once for a pair and not for each of its uses.
    met = met.withColumn("place", F.when((kind > 0) & ~exact, start + F.when(length == 1, 1).otherwise(F.when(F.size(places) == 1, F.get(places, F.lit(0))))))
    place = F.col("place")

    offset = F.when(exact, F.lit(0).cast("long"))
    offset = offset.when((kind > 0) & place.isNotNull() & (base_at(place) >= 0), (F.lit(1) + (place - 1) * len(BASES) + base_at(place)).cast("long"))
    offset = offset.when((kind == _RIGHT) & (F.length(q) > 0) & (base_at(F.lit(1)) >= 0), (9_000 + base_at(F.lit(1))).cast("long"))
    last = base_at(F.length(q))
    offset = offset.when((kind == _LEFT) & (F.length(q) > 0) & (last >= 0), (9_000 + len(BASES) + last).cast("long"))
    found = met.withColumn("offset", offset).where("offset IS NOT NULL")
    if repeated:
        kept = F.when(exact, F.array_distinct(F.array(F.element_at("bases", 1), F.element_at("bases", -1)))).otherwise(F.slice("bases", 1, 2))
        found = found.select("offset", "key", *values, F.explode(kept).alias("base"))
    return found.select((F.col("base") + F.col("offset")).alias("ord"), "key", *(values or [F.lit(None).cast("string").alias("value")]), F.when(F.col("offset") == 0, "E").otherwise("V").alias("kind"))


def _repeats_in_one(named: DataFrame) -> DataFrame:
    """A row for each name and value with its bases, ascending: the first two and the last. Short barcodes repeat, so seeds of repeats would meet each key many times."""
    return _least_repeats(named).groupBy("name_key", "value").agg(F.array_sort(F.collect_list("base")).alias("bases"))


def barcode_lookup_of(keys: DataFrame, barcodes: DataFrame, mismatches: bool = True) -> DataFrame:
    """The rows of barcode_lookup for keys (key, distinct)."""
    return resolve(entries_of_keys(keys, _repeats_in_one(_named_barcodes(barcodes)), substitutions=mismatches))


def primer_lookup_of(keys: DataFrame, amplicons: DataFrame, params: AssignParams = AssignParams()) -> DataFrame:
    """The rows of primer_lookup for keys (key, distinct)."""
    return resolve(entries_of_keys(keys, _named_primers(amplicons, params), params.off_by_one, params.off_by_one))


def primer_homes_of(keys: DataFrame, amplicons: DataFrame, params: AssignParams = AssignParams()) -> DataFrame:
    """The rows of primer_lookup for keys (key, distinct), each with a home: what is known of its amplicon, so that a pair need not be joined for it.

    home: amplicon; ends, those of its own primers that are among keys and name it; chr, start, end; room1 and room2, see `rooms`.
    Seeds carry no names: an ord tells its ordinal, and the rest is joined by that, to fewer rows than there are pairs.
    """
    entries = entries_of_keys(keys, _named_primers(amplicons, params).drop("value"), params.off_by_one, params.off_by_one)
    held = _by_key(entries).select("key", _held()["ord"].alias("ord")).where("ord IS NOT NULL")
    held = held.select("key", F.expr(f"(ord - pmod(ord, {4 * 10_000})) DIV {4 * 10_000}").alias("ordinal"), F.expr("pmod(ord, 10000) = 0").alias("exact"))
    # An amplicon of 18-base primers has at most 332 keys, and 4 of them are exact.
    of_amplicon = held.groupBy("ordinal").agg(F.collect_list("key").alias("keys"), F.collect_list(F.when(F.col("exact"), F.col("key"))).alias("ends"))
    places = amplicons.withColumn("ordinal", F.col("ordinal").cast("long")).groupBy("ordinal").agg(F.min(F.struct("amplicon", "chr", "start", "end")).alias("at"))
    known = of_amplicon.hint("merge").join(places, "ordinal").hint("merge").join(rooms(amplicons), "ordinal", "left")
    return known.select(F.explode("keys").alias("key"), F.struct("at.amplicon", "ends", "at.chr", "at.start", "at.end", "room1", "room2").alias("home"))


#: Distance up to which the neighbours of an amplicon are looked for, and the width of the bins that they are looked for in.
REACH, _BIN = 1_024, 8_192


def rooms(amplicons: DataFrame) -> DataFrame:
    """(ordinal, room1, room2): distance from an amplicon's start (1), or end (2), to the nearest other one's, REACH at most; null where amplicons share the place.

    A place nearer to the start than room1 less a window's half width lies in this amplicon's window or in none.
    Equal places are one row, so a task's group has at most one row for each position of a bin and its margins.
    """
    sides = F.array(*[F.struct(F.lit(i).alias("side"), F.col(c).cast("long").alias("pos")) for i, c in ((1, "start"), (2, "end"))])
    at = amplicons.select(F.col("ordinal").cast("long").alias("ordinal"), "chr", F.explode(sides).alias("s")).select("ordinal", "chr", "s.*").where("chr IS NOT NULL AND pos IS NOT NULL")
    places = at.groupBy("pos", "chr", "side").agg(F.count("*").alias("n"), F.min("ordinal").alias("ordinal"))
    binned = places.withColumn("bin", F.explode(F.expr(f"sequence((pos - {REACH}) DIV {_BIN}, (pos + {REACH}) DIV {_BIN})")))
    row = Window.partitionBy("bin", "chr", "side").orderBy("pos")
    gap = F.least(F.col("pos") - F.lag("pos").over(row), F.lead("pos").over(row) - F.col("pos"), F.lit(REACH))
    own = binned.withColumn("room", gap).where(f"n = 1 AND bin = pos DIV {_BIN}")
    return own.groupBy("ordinal").agg(*[F.max(F.when(F.col("side") == i, F.col("room"))).alias(f"room{i}") for i in (1, 2)])


def _by_key(entries: DataFrame) -> DataFrame:
    """A row for each key: exact and last (ord, value), its last exact entry and its last entry; conflict, the ord of the first V that is not the first entry, or null;
    first_variants (1 if a V is first), later_variants and exact_entries, which are counts. One shuffle and one sort by key and ord."""
    nth = F.row_number().over(Window.partitionBy("key").orderBy("ord"))
    exact, later = F.col("kind") == "E", (F.col("kind") == "V") & (F.col("nth") > 1)
    entry = F.struct("ord", "value")
    return entries.withColumn("nth", nth).groupBy("key").agg(
        F.max(F.when(exact, entry)).alias("exact"), F.max(entry).alias("last"), F.min(F.when(later, F.col("ord"))).alias("conflict"),
        F.count_if((F.col("kind") == "V") & (F.col("nth") == 1)).alias("first_variants"), F.count_if(later).alias("later_variants"), F.count_if(exact).alias("exact_entries"))


def _held() -> Column:
    """The entry (ord, value) of a key of _by_key that holds, or null."""
    return F.when(F.col("conflict").isNull(), F.col("last")).when(F.col("exact.ord") > F.col("conflict"), F.col("exact"))


def resolve(entries: DataFrame) -> DataFrame:
    """(key, value) of the entries that hold."""
    return _by_key(entries).select("key", _held().alias("held")).where("held IS NOT NULL").select("key", F.col("held.value").alias("value"))


def barcode_lookup(barcodes: DataFrame, mismatches: bool = True) -> DataFrame:
    return resolve(_entries(_least_repeats(_named_barcodes(barcodes)), mismatches, False))


def primer_lookup(amplicons: DataFrame, params: AssignParams = AssignParams()) -> DataFrame:
    return resolve(primer_entries(amplicons, params))


def lookup_counts(entries: DataFrame) -> DataFrame:
    """One row: exact entries, variants that were written, keys that hold, clashes (2 for each deletion, 1 for each later variant)."""
    clashes = F.when(F.col("later_variants") > 0, F.col("later_variants") + 1).otherwise(0)
    return _by_key(entries).agg(F.coalesce(F.sum("exact_entries"), F.lit(0)).alias("exact_entries"), F.coalesce(F.sum("first_variants"), F.lit(0)).alias("variants_added"), F.sum(clashes).cast("long").alias("clashes"),
                                F.count_if(_held().isNotNull()).alias("keys"))


def position_windows(amplicons: DataFrame, params: AssignParams = AssignParams(), places: DataFrame | None = None) -> DataFrame:
    """(side, chr, pos, amplicon): positions within the window of an amplicon's start (side 1) and exclusive end (side 2).

    Later amplicons overwrite earlier ones. With places (side, chr, pos, distinct), only those of them.
    """
    w = params.window
    at = F.explode(F.sequence(F.lit(-w), F.lit(w)))
    sides = amplicons.select("ordinal", "amplicon", "chr", "start", "end", at.alias("d"))
    sides = sides.select("ordinal", "amplicon", "chr", F.explode(F.array(
        F.struct(F.lit(1).alias("side"), (F.col("start") + F.col("d")).alias("pos")), F.struct(F.lit(2).alias("side"), (F.col("end") + F.col("d")).alias("pos")))).alias("s"))
    sides = sides.select("ordinal", "amplicon", F.col("s.side").alias("side"), "chr", F.col("s.pos").alias("pos"))
    if places is not None:
        sides = sides.hint("merge").join(places, ["pos", "chr", "side"])
    return sides.groupBy("pos", "chr", "side").agg(F.max_by("amplicon", "ordinal").alias("amplicon")).select("side", "chr", "pos", "amplicon")


def windows_by_place(amplicons: DataFrame, params: AssignParams, side: int) -> DataFrame:
    """(pos, chr, amplicon): all position windows of one side, grouped by what pairs are joined by."""
    at = F.explode(F.sequence(F.lit(-params.window), F.lit(params.window)))
    each = amplicons.select("ordinal", "amplicon", "chr", F.col("start" if side == 1 else "end").alias("mid"), at.alias("d"))
    return each.select("ordinal", "amplicon", "chr", (F.col("mid") + F.col("d")).alias("pos")).groupBy("pos", "chr").agg(F.max_by("amplicon", "ordinal").alias("amplicon"))


def duplicate_locations(amplicons: DataFrame, params: AssignParams = AssignParams()) -> DataFrame:
    """(amplicon, earlier): amplicons whose start, or last base, lies in the window of an earlier amplicon.

    Places are joined by bins as wide as a window, which lies in two of them at most. Spark's estimate does not see that
    rows were exploded, so without the hint it would broadcast large ones too, through the driver.
    """
    w = params.window
    bin_of = lambda pos: pos - F.pmod(pos, F.lit(2 * w + 1))
    start, end = F.col("start").cast("long"), F.col("end").cast("long")
    side = lambda i, pos: F.struct(F.lit(i).alias("side"), pos.alias("pos"))
    windows = amplicons.select(F.col("ordinal").alias("o"), F.col("amplicon").alias("earlier"), "chr", F.explode(F.array(side(1, start), side(2, end))).alias("s"))
    windows = windows.select("o", "earlier", "chr", "s.side", F.col("s.pos").alias("mid"), F.explode(F.array_distinct(F.array(bin_of(F.col("s.pos") - w), bin_of(F.col("s.pos") + w)))).alias("bin"))
    ends = amplicons.select("ordinal", "amplicon", "chr", F.explode(F.array(side(1, start), side(2, end - 1))).alias("e"))
    ends = ends.select("ordinal", "amplicon", "chr", "e.side", "e.pos", bin_of(F.col("e.pos")).alias("bin"))
    met = ends.hint("merge").join(windows, ["bin", "chr", "side"]).where((F.col("o") < F.col("ordinal")) & (F.abs(F.col("pos") - F.col("mid")) <= w))
    return met.select("amplicon", "earlier").distinct()


def amplicon_locations(alignments: DataFrame) -> DataFrame:
    """One row per amplicon from its alignments (qname, flag, chr, pos, mapq, cigar): primary and secondary place, number of alignments.

    The end is exclusive and comes from the alignment's length on the reference; unmapped records give no place.
    """
    from ..functions.sequence import alignment_end

    secondary = F.col("flag").bitwiseAND(0x100) != 0
    mapped = F.col("flag").bitwiseAND(0x4) == 0
    place = F.struct(F.col("chr"), F.col("pos").alias("start"), (alignment_end(F.col("pos"), F.col("cigar")) + 1).alias("end"), F.col("mapq"))
    found = alignments.groupBy(F.col("qname").alias("amplicon")).agg(
        F.min(F.when(mapped & ~secondary, place)).alias("aln"), F.min(F.when(mapped & secondary, place)).alias("secondary"), F.count("*").alias("aln_count"))
    return found.select("amplicon", *[F.col(f"aln.{c}").alias(f"aln_{c}") for c in ("chr", "start", "end", "mapq")],
                        *[F.col(f"secondary.{c}").alias(f"secondary_{c}") for c in ("chr", "start", "end", "mapq")], "aln_count")


def override_alt_alleles(amplicons: DataFrame, alternates: DataFrame) -> DataFrame:
    """amp_seqs replaced by the alternates' sequences (amplicon, alt_seqs) where there are any."""
    return amplicons.join(alternates, "amplicon", "left").withColumn("amp_seqs", F.coalesce("alt_seqs", "amp_seqs")).drop("alt_seqs")


def adapter_in_amplicons(amplicons: DataFrame, adapter: str) -> DataFrame:
    """Amplicons that hold the adapter or its reverse complement: an empty result is right."""
    both = F.col("sequence").contains(adapter) | F.col("sequence").contains(reverse_complement(F.lit(adapter)))
    return amplicons.where(both)


def repeated_alternates(alternates: DataFrame) -> DataFrame:
    """(sequence, amplicons) of allele sequences that more than one amplicon lists: an empty result is right."""
    each = alternates.select("amplicon", F.explode("alt_seqs").alias("sequence")).distinct()
    return each.groupBy("sequence").agg(F.count("*").alias("amplicons")).where("amplicons > 1")
