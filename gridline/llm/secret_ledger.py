"""Secret scans with an incremental ledger of content-addressed blobs.

Every version of a text is addressed by its SHA-256. The ledger has a row for each blob and scan:
which rule versions the scan ran and where they hit. A scan takes each distinct blob once, runs only
the rule versions that the ledger lacks for it, and adds a row. Findings are then joined back from
the ledger to all paths that hold the blob.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import checkpoint_root, scratch_path
from .common import spread_join, stored, text_of


@dataclass(frozen=True)
class Rule:
    """A pattern; a match counts if its ``group`` has at least ``least`` characters."""
    kind: str
    pattern: str
    version: int = 1
    group: int = 0
    least: int = 1

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


# Fixed patterns of the base kinds, in their order. A run of hex digits (or an access key) shorter
# than the bound never counts and ends where its characters end, so the bound stands in the pattern;
# a failing assignment uses its characters up, so there it is checked afterwards.
BASE_RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         group=2, least=6),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)
# Further kinds: key blocks, signed tokens, and keys that public services mark by a prefix.
MORE_RULES = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("url_login", r"[a-z][a-z0-9+.-]{1,20}://[A-Za-z0-9._~%-]{1,200}:[A-Za-z0-9._~%!$-]{1,200}@"),
)
RULES = BASE_RULES + MORE_RULES

HITS = "array<struct<rule:string,before:array<int>,len:array<int>,ok:array<boolean>>>"
SPANS = "array<struct<start:bigint,order:int,end:bigint,kind:string>>"
LEDGER = f"blob string, rules array<string>, hits {HITS}"


def _hits(text: Column, rule: Rule) -> Column:
    """Lengths of the text before each match and of the match, or null if there is none."""
    pattern = F.lit(rule.pattern)
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    counted = F.regexp_extract_all(text, pattern, F.lit(rule.group))
    before = F.transform(F.split(text, rule.pattern, -1), lambda x: F.length(x))
    return F.when(F.rlike(text, pattern), F.struct(
        F.lit(rule.key).alias("rule"), before.alias("before"),
        F.transform(found, lambda x: F.length(x)).alias("len"),
        F.transform(counted, lambda x: F.length(x) >= rule.least).alias("ok")))


class BlobLedger:
    """The ledger under ``root``, a folder that all executors share."""

    def __init__(self, spark: SparkSession, root: str | None = None):
        checkpoint_root(spark)
        self.spark, self.root = spark, root or scratch_path(spark, "secret-ledger")

    def rows(self) -> DataFrame:
        try:
            return self.spark.read.schema(LEDGER).parquet(self.root)
        except AnalysisException:   # no scan yet: the folder isn't there
            return self.spark.createDataFrame([], LEDGER)

    def scan(self, texts: DataFrame, rules: tuple[Rule, ...]) -> None:
        """Run on each distinct (blob, text) the rules it hasn't had, and add them to the ledger.

        The ledger is asked by hashes alone, before any text is shuffled: only the texts of blobs that
        lack a rule go on. A ledger without rows has nothing to tell, and all texts go on.
        """
        wanted = F.array(*[F.lit(r.key) for r in rules])
        if self.rows().isEmpty():
            new = texts.groupBy("blob").agg(F.first("text").alias("text")).withColumn("rules", wanted)
        else:
            had = (self.rows().select("blob", F.explode("rules").alias("rule")).groupBy("blob")
                   .agg(F.collect_set("rule").alias("had")))
            lacks = F.array_except(wanted, F.coalesce("had", F.array().cast("array<string>")))
            unseen = (texts.groupBy("blob").agg(F.count(F.lit(1)).alias("copies")).join(had, "blob", "left")
                      .select("blob", "copies", lacks.alias("rules")).filter(F.size("rules") > 0))
            unseen = stored(unseen, "secret-unseen")     # its size is known when the join is planned
            total = unseen.agg(F.sum("copies")).first()[0] or 0
            new = (spread_join(texts, unseen, ["blob"], "copies", total, F.spark_partition_id())
                   .groupBy("blob", "rules").agg(F.first("text").alias("text")))
        hits = F.array(*[F.when(F.array_contains("rules", r.key), _hits(F.col("text"), r)) for r in rules])
        (new.select("blob", "rules", F.filter(hits, lambda h: h.isNotNull()).cast(HITS).alias("hits"))
         .write.mode("append").parquet(self.root))

    def findings(self, rules: tuple[Rule, ...]) -> DataFrame:
        """(blob, spans): spans of the given rules by start, then rule; blobs without any have no row."""
        match = (self.rows().select("blob", F.explode("hits").alias("hit"))
                 .filter(F.col("hit.rule").isin([r.key for r in rules]))
                 .dropDuplicates(["blob", "hit"])   # two scans at once may both have added a pair
                 .select("blob", F.col("hit.rule").alias("rule"), F.posexplode(F.arrays_zip(
                     F.slice("hit.before", F.lit(1), F.size("hit.len")).alias("before"),
                     F.col("hit.len").alias("len"), F.col("hit.ok").alias("ok"))).alias("i", "m")))
        upto = Window.partitionBy("blob", "rule").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
        end = F.sum(F.col("m.before") + F.col("m.len")).over(upto)
        order = F.coalesce(*[F.when(F.col("rule") == r.key, F.lit(i)) for i, r in enumerate(rules)])
        kind = F.coalesce(*[F.when(F.col("rule") == r.key, F.lit(r.kind)) for r in rules])
        spans = match.withColumn("end", end).filter("m.ok").select("blob", F.struct(
            (F.col("end") - F.col("m.len")).alias("start"), order.alias("order"), "end", kind.alias("kind")).alias("s"))
        return spans.groupBy("blob").agg(F.array_sort(F.collect_list("s")).alias("spans"))


def find_secrets(docs: DataFrame, ledger: BlobLedger | None = None,
                 rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` without text, plus blob and spans (start, order, end, kind; code points, end exclusive).

    Each row is a path (or a version of one) and gets its blob's spans; null text is an empty blob,
    repeated rows and equal texts share one scan, a text of any length is scanned whole, an empty
    table gives no rows. Input columns named blob or spans are replaced.
    """
    spark = docs.sparkSession
    ledger = ledger or BlobLedger(spark)
    text = text_of(docs)
    paths = stored(docs.drop("blob", "spans").withColumn("blob", F.sha2(text, 256)).drop("text"), "secret-paths")
    ledger.scan(docs.select(F.sha2(text, 256).alias("blob"), text.alias("text")), rules)
    copies = paths.groupBy("blob").agg(F.count(F.lit(1)).alias("__copies"))
    found = stored(ledger.findings(rules).join(copies, "blob"), "secret-findings")
    total = paths.count()
    spread = F.struct(*[c for c in paths.columns if c != "blob"]) if len(paths.columns) > 1 else F.lit(0)
    return (spread_join(paths, found, ["blob"], "__copies", total, spread, how="left").drop("__copies")
            .withColumn("spans", F.coalesce(F.col("spans").cast(SPANS), F.array().cast(SPANS))))


def spans_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
