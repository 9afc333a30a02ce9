"""Fixed-layout bulk files: pipe-delimited, without header, every column text, blank and never null."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from moneyflow.functions import numbers as N, text as T
from moneyflow.operators import relational as R

# Columns by position
TRANSACTION = (
    "cmte_id amndt_ind rpt_tp transaction_pgi image_num transaction_tp entity_tp name city state zip_code employer occupation "
    "transaction_dt transaction_amt other_id tran_id file_num memo_cd memo_text sub_id"
).split()
TO_CANDIDATE = [*TRANSACTION[:16], "cand_id", *TRANSACTION[16:]]
COMMITTEE = (
    "cmte_id cmte_nm tres_nm cmte_st1 cmte_st2 cmte_city cmte_st cmte_zip cmte_dsgn cmte_tp cmte_pty_affiliation cmte_filing_freq "
    "org_tp connected_org_nm cand_id"
).split()
CANDIDATE = (
    "cand_id cand_name cand_pty_affiliation cand_election_yr cand_office_st cand_office cand_office_district cand_ici cand_status cand_pcc "
    "cand_st1 cand_st2 cand_city cand_st cand_zip"
).split()
LINKAGE = "cand_id cand_election_yr fec_election_yr cmte_id cmte_tp cmte_dsgn linkage_id".split()
CURATED = ["employer", "include", "canonical_name", "sector", "notes", "matched_searches"]


@dataclass(frozen=True)
class BulkFile:
    """One kind of file of a cycle: its place below the cycle's folder, and its columns."""

    name: str
    folder: str
    file: str
    columns: list[str]
    has_amount: bool = False

    def path(self, root: str, cycle: int) -> str:
        return f"{root}/{cycle}/{self.folder.format(yy=f'{cycle % 100:02d}')}/{self.file}"


REGISTRY = {
    f.name: f
    for f in (
        BulkFile("cm", "cm{yy}", "cm.txt", COMMITTEE),
        BulkFile("cn", "cn{yy}", "cn.txt", CANDIDATE),
        BulkFile("ccl", "ccl{yy}", "ccl.txt", LINKAGE),
        BulkFile("itcont", "indiv{yy}", "itcont.txt", TRANSACTION, True),
        BulkFile("itoth", "oth{yy}", "itoth.txt", TRANSACTION, True),
        BulkFile("itpas2", "pas2{yy}", "itpas2.txt", TO_CANDIDATE, True),
    )
}


def scan(spark: SparkSession, root: str, cycle: int, name: str, columns: list[str] | None = None) -> DataFrame:
    """A bulk file as blank-safe text columns, the amount as a number (0.0 if unreadable).

    Quotes have no meaning in this format. A missing file raises. With ``columns``, only these are parsed.
    """
    spec = REGISTRY[name]
    schema = StructType([StructField(c, StringType()) for c in spec.columns])
    raw = spark.read.schema(schema).option("sep", "|").option("quote", "").option("mode", "PERMISSIVE").csv(spec.path(root, cycle))
    out = R.blank_safe(raw.select(*(columns or spec.columns)))
    if spec.has_amount and "transaction_amt" in out.columns:
        out = out.withColumn("transaction_amt", N.money(F.col("transaction_amt")))
    return out


def with_file_order(df: DataFrame, name: str = "_row_ord") -> DataFrame:
    """A number that follows the order of rows in the files read: partitions of a scan keep it, so no shuffle is needed.

    It is taken right after the scan; files of one scan must be split in order (Spark packs large files
    first, so scans of several files should be numbered one by one).
    """
    return df.withColumn(name, F.monotonically_increasing_id())


def bronze(spark: SparkSession, root: str, cycle: int, name: str, out: str) -> DataFrame:
    """Text to Parquet, partitioned by cycle, with the file order kept: later scans prune columns and push filters."""
    with_file_order(scan(spark, root, cycle, name)).withColumn("cycle", F.lit(cycle)).write.mode("overwrite").partitionBy("cycle").parquet(f"{out}/{name}")
    return spark.read.parquet(f"{out}/{name}")


def curated(spark: SparkSession, path: str) -> DataFrame:
    """The hand-kept employer list: included rows only, file order kept."""
    schema = StructType([StructField(c, StringType()) for c in CURATED])
    raw = with_file_order(spark.read.schema(schema).option("header", True).option("escape", '"').csv(path))
    return R.blank_safe(raw).where(T.key(F.col("include")) == "TRUE")


def cycles_in(spark: SparkSession, root: str) -> list[int]:
    """Numeric folder names below ``root``, in any store that Spark reads."""
    place = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = place.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(place) if s.isDirectory()]
    return sorted(int(n) for n in names if n.isdigit())


def scan_cycles(spark: SparkSession, root: str, name: str, cycles: list[int], columns: list[str] | None = None) -> DataFrame:
    """One kind of file over several cycles, with the cycle as a column."""
    return R.union_all(*[scan(spark, root, c, name, columns).withColumn("cycle", F.lit(c)) for c in cycles])
