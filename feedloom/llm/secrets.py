"""Secret scans with a ledger: every distinct blob is scanned once for every version of every rule.

A blob is a text by its SHA-256. The ledger is a folder of committed batches; a row says which rule versions were
applied to a blob and which spans they found, also if none. A run scans the pairs of blob and rule version that no
committed batch has, writes them as one more batch, and joins the findings of the current rules back to every path.
A batch counts when Spark's ``_SUCCESS`` file is there: a run that dies leaves nothing behind that is read.

Defined cases: a null text is the empty blob; paths may be null or repeat, each row gets its blob's findings; an empty
table gives an empty result; other columns are not looked at; equal spans of two rules stay two. A text is one row's
work, in time nearly proportional to its length and its matches. Offsets count code points, the end is exclusive.
"""

from __future__ import annotations

import hashlib
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm.common import let, whole


@dataclass(frozen=True)
class Rule:
    """Leftmost matches that don't overlap. ``group``: what has to have ``least`` characters, 0 for the whole match."""

    kind: str
    pattern: str
    least: int = 0
    group: int = 0
    base: bool = False

    @property
    def version(self) -> str:
        said = f"{self.kind}\n{self.pattern}\n{self.least}\n{self.group}"
        return f"{self.kind}-{hashlib.sha256(said.encode()).hexdigest()[:12]}"


# Patterns of known secrets. Runs of one character class need no check of their length after the match: a run that is
# too short holds no other match.
RULES = (
    Rule(
        "assign",
        r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        8,
        2,
        base=True,
    ),
    Rule("access", r"AKIA[A-Z0-9]{12,}", base=True),
    Rule("hex", r"[0-9a-f]{32,}", base=True),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)
#: Lengths that are summed up one after the other; longer lists are summed by blocks.
BLOCK = 64
_SPAN = "array<struct<start:int,no:int,kind:string,stop:int>>"


def _sums(values: Column) -> Column:
    """The sum before each value, by copying the list at every step: for short lists."""
    start = F.struct(F.lit(0).alias("sum"), F.array().cast("array<int>").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        return F.struct((acc["sum"] + x).alias("sum"), F.concat(acc["out"], F.array(acc["sum"])).alias("out"))

    return F.aggregate(values, start, step, lambda acc: acc["out"])


def sums_before(values: Column, levels: int = 3) -> Column:
    """The sum before each value of an array of any length. Blocks are summed up first, then the sums of blocks in the
    same way, so that no list of more than ``BLOCK`` values is copied on any level but the last."""
    if levels == 0:
        return _sums(values)

    def of_blocks(blocks: Column) -> Column:
        totals = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0), lambda n, x: n + x))

        def shifted(before: Column) -> Column:
            return F.transform(blocks, lambda b, i: F.transform(F.array(F.get(before, i)), lambda s: F.transform(_sums(b), lambda x: x + s))[0])

        return F.flatten(let(sums_before(totals, levels - 1), shifted))

    def cut(v: Column) -> Column:
        n = F.ceil(F.size(v) / BLOCK).cast("int")
        blocks = F.transform(F.sequence(F.lit(0), n - 1), lambda k: F.slice(v, k * BLOCK + 1, BLOCK))
        return F.when(n > 0, let(blocks, of_blocks)).otherwise(F.array().cast("array<int>"))

    return let(values, cut)


def spans(text: Column, rule: Rule, number: int) -> Column:
    """Places follow from the lengths of the matches and of what is between them."""
    none = F.array().cast(_SPAN)

    def placed(p: Column) -> Column:
        lengths = F.transform(p["hits"], lambda h, i: F.length(F.get(p["gaps"], i)) + F.length(h))

        def span(before: Column) -> Column:
            def one(h: Column, i: Column) -> Column:
                begin = F.get(before, i) + F.length(F.get(p["gaps"], i))
                return F.struct(
                    begin.alias("start"), F.lit(number).alias("no"), F.lit(rule.kind).alias("kind"), (begin + F.length(h)).alias("stop")
                )

            found = F.transform(p["hits"], one)
            if not rule.least:
                return found
            checked = lambda h: F.regexp_extract(h, rule.pattern, rule.group) if rule.group else h
            return F.filter(found, lambda s, i: F.length(checked(F.get(p["hits"], i))) >= rule.least)

        return let(sums_before(lengths), span)

    parts = F.struct(
        F.split(text, rule.pattern, -1).alias("gaps"), F.regexp_extract_all(text, F.lit(rule.pattern), 0).alias("hits")
    )
    return F.when(text.rlike(rule.pattern), let(parts, placed).cast(_SPAN)).otherwise(none)


def _batches(spark: SparkSession, ledger: str) -> list[str]:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    root = hadoop(ledger)
    system = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(root):
        return []
    found = sorted(status.getPath().toString() for status in system.listStatus(root))
    return [b for b in found if system.exists(hadoop(f"{b}/_SUCCESS"))]


def scan(versions: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``versions``: path, text. Returns path, blob (hexadecimal), spans (start, no, kind, stop; by start, then rule)."""
    spark = versions.sparkSession
    current = F.array(*[F.lit(r.version) for r in rules])
    keyed = versions.select("path", whole("text").alias("text"))
    keyed = keyed.withColumn("blob", F.unhex(F.sha2("text", 256)))
    blobs = keyed.groupBy("blob").agg(F.any_value("text").alias("text"))
    if before := _batches(spark, ledger):
        past = spark.read.parquet(*before).select("blob", F.explode("versions").alias("v"))
        seen = past.groupBy("blob").agg(F.collect_set("v").alias("seen"))
        blobs = blobs.join(seen, "blob", "left")
        todo = F.array_except(current, F.coalesce("seen", F.array().cast("array<string>")))
        blobs = blobs.withColumn("versions", todo).where(F.size("versions") > 0)
    else:
        blobs = blobs.withColumn("versions", current)
    found = [
        F.when(F.array_contains("versions", r.version), spans(F.col("text"), r, i)).otherwise(F.array().cast(_SPAN))
        for i, r in enumerate(rules)
    ]
    scanned = blobs.select("blob", "versions", F.concat(*found).alias("spans"))
    scanned.write.parquet(f"{ledger.rstrip('/')}/batch-{uuid.uuid4().hex}")
    # A kind's spans are of the current version if the batch applied that version.
    kinds = {r.kind: r.version for r in rules}
    version = F.element_at(F.create_map(*[F.lit(x) for pair in kinds.items() for x in pair]), F.col("s.kind"))
    findings = (
        spark.read.parquet(*_batches(spark, ledger))
        .where(F.size("spans") > 0)
        .select("blob", "versions", F.explode("spans").alias("s"))
        .where(F.array_contains("versions", version))
        .groupBy("blob")
        .agg(F.sort_array(F.collect_set("s")).alias("spans"))
    )
    paths = keyed.select("path", "blob").join(findings, "blob", "left")
    return paths.select(
        "path", F.lower(F.hex("blob")).alias("blob"), F.coalesce("spans", F.array().cast(_SPAN)).alias("spans")
    )


def listed(found: Column) -> Column:
    """Spans as text: kind:start:end, joined by commas."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")
