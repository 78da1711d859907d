"""Domain tables derived from the order tables by SQL that Spark and DuckDB read alike.

Reads are rows of lineitem with their orders, told apart by the digits of an md5; sequences are md5 digits as bases.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..params import DemuxParams
from ..sources.sinks import scratch

P = DemuxParams()


def _s(x: str) -> str:
    return f"cast({x} as varchar(20))"


def _dna(x: str) -> str:
    return f"translate({x},'0123456789abcdef','ACGTACGTACGTACGT')"


def _h(i: int, n: int = 1) -> str:
    return f"substr(h,{i},{n})"


def _half(x: str) -> str:
    return _dna(f"substr(md5(concat('bc',{_s(x)})),1,9)")


def _amp(a: str) -> str:
    return f"concat(md5(concat('ampA',{_s(a)})),md5(concat('ampB',{_s(a)})))"


_STAGGER = f"case when {_h(11)}<'4' then '' when {_h(11)}<'8' then 'A' when {_h(11)}<'c' then 'AC' else 'ACG' end"
_B1, _B2, _TAIL = _half("l_partkey"), _half("l_suppkey"), _dna("concat(h,h)")


def _name(a: str) -> str:
    return f"concat('AMP_',case when {a}<10 then '0' else '' end,{_s(a)})"


def _cell(key: str) -> str:
    return f"concat('C',{_s(key)})"


#: Amplicons with reads. A read's amplicon is its part's number within the panel, so every part takes part.
PANEL = 12
PANEL_PLACE = f"l_partkey%{PANEL}"
#: Columns of the first mates' and the second mates' alignments, of names (h, a).
_MATES = (f"""concat('R',h) AS qname, cast(64 + case when {_h(9)}='0' then 4 else 0 end + case when {_h(13)}='0' then 256 else 0 end as int) AS flag,
        case when {_h(9)}='0' then '*' else 'chr1' end AS chr, cast(case when {_h(9)}='0' then -1 else 1000*(a+1) end as {{position}}) AS pos, cast(case when {_h(9)}='0' then 0 else 40 end as int) AS mapq,
        case when {_h(9)}='0' then '*' when {_h(14)}<'8' then '64M' when {_h(14)}<'c' then '20M4I40M' else '10S30M5D24M' end AS cigar, {_dna(_amp('a'))} AS seq, concat(repeat('I', 32), repeat('F', 32)) AS qual""",
          f"""concat('R',h), cast(128 + 16 + case when {_h(10)}='0' then 4 else 0 end as int), case when {_h(10)}='0' then '*' else 'chr1' end,
        cast(case when {_h(10)}='0' then -1 else 1000*(a+1) end as {{position}}), cast(case when {_h(10)}='0' then 0 else 40 end as int),
        case when {_h(10)}='0' then '*' when {_h(15)}<'8' then '64M' else '60M4S' end, {_dna(_amp('a'))}, concat(repeat('I', 32), repeat('F', 32))""")
#: Tables by name, each built on earlier ones. DuckDB has int positions.
TABLES = {
    "base": f"""SELECT md5(concat('r',{_s('l_orderkey')},'_',{_s('l_linenumber')},'_',{_s('l_partkey')},'_',{_s('l_suppkey')},'_',
        {_s('cast(round(l_extendedprice*100) as bigint)')})) AS h, l_partkey, l_suppkey, o_custkey
      FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey""",
    "barcodes": f"""SELECT cast(p_partkey+2 as int) AS ordinal, {_half('p_partkey')} AS barcode FROM {{part}}
      UNION ALL SELECT 0, 'AAAAAAAAA' UNION ALL SELECT 1, 'AAAAAAAAC'""",
    "read_pairs": f"""SELECT name, seq1, repeat('I', cast(length(seq1) as int)) AS qual1, seq2, repeat('I', cast(length(seq2) as int)) AS qual2 FROM (
      SELECT concat('R',h) AS name, case {_h(10)}
        when '0' then concat({_dna(_h(20, 9))},{_STAGGER},'{P.constant1}',{_B2},'{P.constant2}',{_TAIL})
        when '1' then concat({_B1},{_STAGGER},'{P.constant1}',{_B2},{_TAIL})
        when '2' then concat(substr({_B1},1,3),'N',substr({_B1},5,5),{_STAGGER},'{P.constant1}',{_B2},'{P.constant2}',{_TAIL})
        when '3' then concat({_B1},{_STAGGER},{_B2},'{P.constant2}',{_TAIL})
        when '4' then concat({_B1},{_STAGGER},'{P.constant1}',{_B2},'{P.constant2}',substr({_TAIL},1,15))
        else concat({_B1},{_STAGGER},'{P.constant1}',{_B2},'{P.constant2}',{_TAIL}) end AS seq1,
        case when {_h(12)}='0' then concat('{P.adapter}',{_TAIL}) else {_TAIL} end AS seq2
      FROM base) q""",
    "amplicons": f"""SELECT cast(p_partkey as int) AS ordinal, {_name('p_partkey')} AS amplicon, {_dna(_amp('p_partkey'))} AS sequence,
        'chr1' AS chr, cast(1000*(p_partkey+1) as {{position}}) AS start_pos, cast(1000*(p_partkey+1)+64 as {{position}}) AS end_pos,
        case cast(p_partkey%4 as int) when 0 then '2,1' when 1 then '1' when 2 then 'NA' else '2,2' end AS ref_counts FROM {{part}}""",
    "alternates": f"""SELECT {_name('p_partkey')} AS amplicon, concat({_dna("md5(concat('alt'," + _s('p_partkey%4') + "))")},',',{_dna("md5(concat('alt',md5(" + _s('p_partkey') + ")))")}) AS alt_list
      FROM {{part}} WHERE p_size > 25""",
    "aligned_pairs": f"""SELECT concat('R',h) AS qname, cell,
        case {_h(8)} when '0' then concat('N',substr(s,2,17)) when '1' then concat(substr(s,2,17),'A') when '2' then {_dna("substr(md5(h),1,18)")} else substr(s,1,18) end AS primer1,
        substr(s2,47,18) AS primer2, case when {_h(9)}='0' then '*' else 'chr1' end AS chr1,
        cast(case when {_h(9)}='0' then -1 when {_h(9)}='1' then 1000*(a+1)+500 when {_h(9)}<'8' then 1000*(a+1) when {_h(9)}<'c' then 1000*(a+1)+3 else 1000*(a+1)-2 end as {{position}}) AS pos1,
        case when {_h(10)}='0' then '*' else 'chr1' end AS chr2,
        cast(case when {_h(10)}='0' then -1 when {_h(10)}='1' then 1000*(a+2)+64 when {_h(10)}<'8' then 1000*(a+1)+63 when {_h(10)}<'c' then 1000*(a+1)+67 else 1000*(a+1)+61 end as {{position}}) AS pos2
      FROM (SELECT h, a, {_cell('o_custkey')} AS cell, {_dna(_amp('a'))} AS s, {_dna(_amp("case when substr(h,7,1)='0' then a+1 else a end"))} AS s2
        FROM (SELECT h, o_custkey, l_partkey AS a FROM base) r) q""",
    "alignments": f"""SELECT {_MATES[0]}
      FROM (SELECT h, l_partkey AS a FROM base) q
      UNION ALL SELECT {_MATES[1]}
      FROM (SELECT h, l_partkey AS a FROM base) q2""",
    "amplicon_alignments": """SELECT amplicon AS qname, cast(0 as int) AS flag, chr, start_pos AS pos, cast(42 as int) AS mapq, '64M' AS cigar, sequence AS seq, repeat('I', 64) AS qual FROM amplicons
      UNION ALL SELECT amplicon, cast(256 as int), 'chr2', cast(start_pos + 7 as {position}), cast(3 as int), '30M4D30M4S', '*', '*' FROM amplicons WHERE ordinal % 3 = 0""",
    "annotated_reads": f"""SELECT read_id, cell, amplicon, aln_ref, ann, {_dna("md5(concat(amplicon, ann, tail))")} AS seq FROM (
      SELECT concat('R',h) AS read_id, cell, amplicon, case {_h(3, 2)} when '00' then 'NA' when '01' then 'Reference&Amplicon1' else case when {_h(3)}='8' then 'Amplicon1' else 'Reference' end end AS aln_ref,
        case when {_h(1)}='0' then concat('DEL= INS= SUB=',{_h(2)}) when substr(g,1,1)<'8' then 'DEL= INS= SUB='
          when substr(g,1,1)<'b' then case when {_h(2)}<'8' then 'DEL= INS= SUB=' else concat('DEL=',substr(g,2,1),' INS= SUB=') end
          when substr(g,1,1)<'d' then concat('DEL=',substr(g,2,1),' INS= SUB=')
          else case when {_h(2)}<'8' then concat('DEL=',substr(g,2,1),' INS= SUB=') else concat('DEL= INS=',substr(g,3,1),' SUB=') end end AS ann,
        case when {_h(5)}='0' then {_h(6)} else '' end AS tail
      FROM (SELECT h, {_cell('o_custkey')} AS cell, {_name(PANEL_PLACE)} AS amplicon,
          md5(concat('g',{_s('o_custkey')},'_',{_s(PANEL_PLACE)})) AS g FROM base) r) q""",
    "status": """SELECT amplicon, cast(ordinal * 10 as bigint) AS reads, concat('run_', amplicon) AS result,
      case when ordinal % 12 = 11 then 'Failed' else 'Completed' end AS status FROM amplicons""",
    # The panel of the experiment: amplicons that each cell is read at, the last one Completed with an empty summary.
    "panel": f"SELECT amplicon, status FROM status WHERE amplicon IN ({', '.join(f"'AMP_{i:02d}'" for i in range(PANEL + 1))})",
    "ploidies": """SELECT amplicon, case when place = 0 then 'Reference' else 'Amplicon1' end AS ref, cast(substr(counts, 2*place+1, 1) as int) AS ploidy
      FROM (SELECT amplicon, case ref_counts when 'NA' then '2' else ref_counts end AS counts FROM amplicons) q, (SELECT 0 AS place UNION ALL SELECT 1) p WHERE length(counts) > 2*place""",
    "allele_frequencies": """SELECT amplicon, seq AS aligned_sequence, case when ann = 'DEL= INS= SUB=' then 'UNMODIFIED' else 'MODIFIED' end AS read_status,
        cast(case when ann LIKE 'DEL= %' then 0 else 1 end as int) AS n_deleted, cast(case when ann LIKE '%INS= %' then 0 else 1 end as int) AS n_inserted,
        cast(case when ann LIKE '%SUB=' then 0 else 1 end as int) AS n_mutated, count(*) AS reads FROM annotated_reads GROUP BY amplicon, seq, ann""",
}
_NEEDS = {"read_pairs": ["base"], "aligned_pairs": ["base"], "alignments": ["base"], "amplicon_alignments": ["amplicons"], "annotated_reads": ["base"], "status": ["amplicons"], "panel": ["amplicons", "status"], "ploidies": ["amplicons"],
          "allele_frequencies": ["base", "annotated_reads"]}
#: Tables that are read from files in a real run.
WRITTEN = ("read_pairs", "aligned_pairs")


def ctes(*names: str) -> str:
    """`name AS (...)` of the tables and of what they need, in order."""
    wanted = {n for name in names for n in [*_NEEDS.get(name, []), name]}
    return ", ".join(f"{n} AS ({t})" for n, t in TABLES.items() if n in wanted)


def duckdb_ctes(*names: str) -> str:
    return ctes(*names).format(lineitem="lineitem", orders="orders", part="part", position="int")


class Fixtures:
    """The derived tables of one folder of test tables, as DataFrames."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir
        self._stages: dict[str, DataFrame] = {}
        self._position: str | None = None

    def position(self) -> str:
        """The type of positions: int, as in the SQL, or bigint of a panel whose last place does not fit, for which the SQL's own casts fail."""
        if self._position is None:
            last = self.spark.read.parquet(f"{self.dir}/part.parquet").agg(F.max("p_partkey")).first()[0]
            self._position = "bigint" if last is not None and 1000 * (last + 2) + 64 > 2**31 - 1 else "int"
        return self._position

    def stage(self, name: str, make) -> DataFrame:
        """A step of the pipeline as a table: written once to the shared folder, so that later steps start from its rows."""
        if name not in self._stages:
            df = make()
            path = scratch(self.spark, name)
            df.write.parquet(path, compression="zstd")
            self._stages[name] = self.spark.read.schema(df.schema).parquet(path)
        return self._stages[name]

    def table(self, name: str) -> DataFrame:
        """Pairs are written first, as they would be when they come from files: they are read more than once, and are long expressions."""
        return self.written(name) if name in WRITTEN or name in self._stages else self._derived(name)

    def written(self, name: str) -> DataFrame:
        """A table for queries that read it more than once, directly or through tables that are built on it."""
        return self.stage(name, lambda: self._derived(name))

    def _derived(self, name: str) -> DataFrame:
        reads = self._stages.get("annotated_reads")
        if reads is not None and "annotated_reads" in _NEEDS.get(name, []):
            return self.spark.sql(TABLES[name].replace("FROM annotated_reads", "FROM {annotated_reads}"), annotated_reads=reads)
        sql = ctes(name)
        if "{position}" in sql:
            sql = sql.replace("{position}", self.position())
        used = {t: self.spark.read.parquet(f"{self.dir}/{t}.parquet") for t in ("lineitem", "orders", "part") if f"{{{t}}}" in sql}
        return self.spark.sql(f"WITH {sql} SELECT * FROM {name}", **used)

    def alignments_by_name(self) -> DataFrame:
        """The rows of alignments, those of equal names behind one another in one partition, first mates before their seconds.

        Names are dealt out and sorted with what lines derive from, so that no sequences are shuffled.
        """
        names = self._derived("base").selectExpr("h", "l_partkey AS a").repartition("h").sortWithinPartitions("h")
        row = "struct<qname string, flag int, chr string, pos {position}, mapq int, cigar string, seq string, qual string>"
        mates = ", ".join(f"CAST(struct({columns}) AS {row})" for columns in _MATES).replace("{position}", self.position())
        return self.spark.sql(f"SELECT inline(array({mates})) FROM {{names}}", names=names)

    def amplicons(self) -> DataFrame:
        counts = F.transform(F.split("ref_counts", ","), lambda n: n.try_cast("int"))
        return self.table("amplicons").withColumnsRenamed({"start_pos": "start", "end_pos": "end"}).withColumn("ref_allele_counts", counts).drop("ref_counts")
