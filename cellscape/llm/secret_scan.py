"""Secret scans with an incremental ledger of blobs, in DataFrame operations only.

Every version of a text is addressed by its SHA-256. The ledger keeps, for each blob and each rule at
its version, the spans found (none is an entry too). A scan reads the ledger, scans only the pairs of
blob and rule version that it lacks, each blob once however many paths hold it, appends what it found,
and joins the findings of all current rules back to every path.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import shared_dir, table


@dataclass(frozen=True)
class Rule:
    """A match of ``pattern`` (leftmost, not overlapping) counts if its ``group`` has ``least`` characters or more."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    version: int = 1
    base: bool = False

    @property
    def pair(self) -> str:
        return f"{self.kind}@{self.version}"


# The base kinds in the order in which they are listed, then kinds of known key formats.
RULES = (
    Rule("assign", r"""((?i)password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, base=True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20, base=True),
    Rule("hex", r"[0-9a-f]{24,}", 0, 24, base=True),  # maximal runs, so a shorter one hides none
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
    Rule("forge", r"gh[opsu]_[A-Za-z0-9]+", 0, 40),
)

SPANS = "array<struct<start:int,end:int>>"


def spans(text: Column, rule: Rule, chunk: int = 256) -> Column:
    """Spans in code points, end exclusive: the lengths of matches and of what lies between them give the places.

    Matches are folded in chunks whose starts are known from the chunks' lengths, so a text of very many costs in
    proportion to them.
    """
    found = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    kept = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)) if rule.group else found
    between = F.split(text, rule.pattern, -1)
    none, zero = F.array().cast(SPANS), F.lit(0)

    def starts(acc: Column, x: Column) -> Column:
        return F.struct((acc["at"] + x).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out"))

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + x["between"]
        end = begin + x["found"]
        hit = F.when(x["kept"] >= rule.least, F.array(F.struct(begin.alias("start"), end.alias("end")))).otherwise(none)
        return F.struct(end.alias("at"), F.concat(acc["out"], hit).alias("out"))

    lengths = [F.transform(x, F.length).alias(k) for x, k in ((found, "found"), (F.slice(between, F.lit(1), F.size(found)), "between"), (kept, "kept"))]
    pieces = F.transform(F.sequence(zero, F.ceil(F.size(found) / chunk).cast("int") - 1), lambda i: F.slice(F.arrays_zip(*lengths), i * chunk + 1, F.lit(chunk)))
    sums = F.transform(pieces, lambda c: F.aggregate(c, zero, lambda acc, x: acc + x["found"] + x["between"]))
    begins = F.aggregate(sums, F.struct(zero.alias("at"), F.array().cast("array<int>").alias("out")), starts, lambda acc: acc["out"])
    parts = F.zip_with(pieces, begins, lambda c, at: F.aggregate(c, F.struct(at.alias("at"), none.alias("out")), step, lambda acc: acc["out"]))
    return F.when(F.rlike(text, F.lit(rule.pattern)), F.flatten(parts)).otherwise(none)


def read_ledger(like: DataFrame, path: str) -> DataFrame | None:
    """The ledger at ``path``, or None where there is none yet."""
    try:
        return like.sparkSession.read.schema(f"blob string, pair string, spans {SPANS}").parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def scan(versions: DataFrame, ledger: str | None = None, rules: Sequence[Rule] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, blob, found) of every row: ``found`` holds structs (start, place of the rule in ``rules``, end, kind) by start, then place.

    A null text counts as empty; a text of any length is scanned whole. Rows that repeat an id, or have none, are each
    returned. ``ledger`` is a path that outlives the scan; without one a new ledger is begun in the shared folder, and
    every blob is unseen. An append that is tried again repeats entries, which count once. Other columns aren't read.
    """
    spark = versions.sparkSession
    ledger = ledger or shared_dir(spark, "ledger")
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = versions.select(F.col(id_col), F.sha2(text.cast("binary"), 256).alias("blob"), text.alias("body"))
    paths = table(rows.select(id_col, "blob"), "paths")
    blobs = rows.groupBy("blob").agg(F.first("body").alias("body"))
    wanted = F.col("pair").isin([r.pair for r in rules])
    known = read_ledger(versions, ledger)
    if known is None:
        blobs = blobs.withColumn("seen", F.array().cast("array<string>"))
    else:  # as many pairs a blob as there are rule versions
        seen = known.where(wanted).groupBy(F.col("blob").alias("b")).agg(F.collect_set("pair").alias("seen"))
        blobs = blobs.join(seen, F.col("blob") == F.col("b"), "left").withColumn("seen", F.coalesce("seen", F.array().cast("array<string>")))
        blobs = blobs.where(F.size(F.array_except(F.array(*[F.lit(r.pair) for r in rules]), "seen")) > 0)
    new = F.array(
        *[F.when(~F.array_contains("seen", r.pair), F.struct(F.lit(r.pair).alias("pair"), spans(F.col("body"), r).alias("spans"))) for r in rules]
    )
    entries = blobs.select("blob", F.explode(F.array_compact(new)).alias("entry")).select("blob", "entry.pair", "entry.spans")
    entries.write.mode("append").partitionBy("pair").parquet(ledger)  # so that only the pairs asked for are read
    places = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(r.pair), F.struct(F.lit(i).alias("place"), F.lit(r.kind).alias("kind")))])
    hits = read_ledger(versions, ledger).where(wanted & (F.size("spans") > 0)).withColumn("rule", places[F.col("pair")])
    each = F.transform("spans", lambda s: F.struct(s["start"].alias("start"), F.col("rule.place").alias("place"), s["end"].alias("end"), F.col("rule.kind").alias("kind")))
    by_blob = table(
        hits.select("blob", each.alias("each")).groupBy(F.col("blob").alias("b")).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("each")))).alias("found")), "found"
    )
    return paths.join(by_blob, F.col("blob") == F.col("b"), "left").select(
        id_col, "blob", F.coalesce("found", F.array().cast("array<struct<start:int,place:int,end:int,kind:string>>")).alias("found")
    )


def digest(found: Column) -> Column:
    """kind:start:end of each, comma-joined."""
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
