"""Secret scans over versions of files, with a ledger of what has been scanned.

Every version is addressed by the SHA-256 of its content. The ledger, a Parquet table in the
shared folder, has a row for each blob and rule version that was ever scanned, with the spans
found. A scan takes only the pairs of blob and rule version that the ledger lacks, reads one
copy of each such blob, appends the outcome, and joins the ledger back to all paths. A
repeated scan, a moved file or a copy costs no matching; a new rule version rescans all blobs
for that rule alone.

Everything is built-in SQL. Cutting a text at a pattern and extracting the same pattern give
the pieces between and the matches themselves; running totals of their lengths are the
offsets, in code points.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridmarts.llm.common import scratch, whole_text


@dataclass(frozen=True)
class Rule:
    """``pattern`` matches leftmost and non-overlapping; then ``group`` needs ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    version: int = 1


# The three base rules. A run of hexadecimal digits is taken whole either way, so
# the shortest length may stand in the pattern; the same holds for access keys.
BASE_RULES = (
    Rule("assign", r"""((?i)password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)
MORE_RULES = (
    Rule("bearer", r"[Bb]earer\x20+[A-Za-z0-9._~+/-]{20,}=*"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("pem", r"-----BEGIN\x20[A-Z\x20]{0,40}PRIVATE\x20KEY-----"),
    Rule("prefixed", r"\b(gh[pousr]_[A-Za-z0-9]{36}|xox[abpr]-[A-Za-z0-9-]{10,}|sk_live_[A-Za-z0-9]{16,})"),
)
RULES = BASE_RULES + MORE_RULES

LEDGER = "blob binary, kind string, version int, spans array<struct<start:int,end:int>>"
SPAN = "array<struct<start:int,rank:int,end:int,kind:string>>"


def blob_of(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def _hits(rule: Rule) -> Column:
    """Per match: length of the text before it, its own length, and whether it is long enough."""
    text, pattern = F.col("text"), F.lit(rule.pattern)
    before = F.transform(F.split(text, rule.pattern, -1), F.length)
    whole = F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), F.length)
    if rule.group:
        tested = F.transform(F.regexp_extract_all(text, pattern, F.lit(rule.group)), F.length)
    else:
        tested = whole
    found = F.arrays_zip(
        F.slice(before, 1, F.size(whole)).alias("before"), whole.alias("own"), tested.alias("tested")
    )
    wanted = F.array_contains("kinds", rule.kind) & F.regexp_like(text, pattern)
    return F.struct(
        F.lit(rule.kind).alias("kind"),
        F.lit(rule.version).alias("version"),
        F.lit(rule.least).alias("least"),
        F.array_contains("kinds", rule.kind).alias("wanted"),
        F.when(wanted, found).alias("hits"),
    )


def scan(versions: DataFrame, ledger: str, path_column: str, text_column: str = "text", rules=RULES) -> DataFrame:
    """Bring the ledger up to date with these versions and return (blob, spans) of their blobs.

    ``ledger`` is the table's folder; it need not exist. A null text is an empty blob.
    """
    spark = versions.sparkSession
    rows = versions.select(F.col(path_column).alias("path"), whole_text(text_column).alias("text"))
    rows = rows.withColumn("blob", blob_of(F.col("text"))).withColumn("copy", F.xxhash64("path"))
    known = _ledger(spark, ledger)
    every = F.array(*(F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version")) for r in rules))
    with scratch(spark, "secrets") as tables:
        # one copy of a blob is read: the one whose path has the smallest hash
        blobs = tables.store(rows.groupBy("blob").agg(F.min("copy").alias("copy")), "blobs")
        unseen = (
            blobs.select("blob", "copy", F.inline(every))
            .join(known.select("blob", "kind", "version").distinct(), ["blob", "kind", "version"], "left_anti")
            .groupBy("blob", "copy")
            .agg(F.collect_set("kind").alias("kinds"))
        )
        unseen = tables.store(unseen, "unseen")
        texts = rows.select("blob", "copy", "text").join(unseen.hint("shuffle_hash"), ["blob", "copy"])
        tried = texts.select("blob", F.inline(F.array(*(_hits(r) for r in rules)))).where("wanted")
        tried = tables.store(tried.drop("wanted"), "tried")
        place = Window.partitionBy("blob", "kind", "version").orderBy("at")
        hit = (
            tried.where("hits is not null")
            .dropDuplicates(["blob", "kind", "version"])
            .select("blob", "kind", "version", "least", F.posexplode("hits").alias("at", "hit"))
            .withColumn("end", F.sum(F.col("hit.before") + F.col("hit.own")).over(place).cast("int"))
            .where(F.col("hit.tested") >= F.col("least"))
        )
        spans = hit.groupBy("blob", "kind", "version").agg(
            F.sort_array(
                F.collect_list(F.struct((F.col("end") - F.col("hit.own")).cast("int").alias("start"), "end"))
            ).alias("spans")
        )
        done = (
            tried.select("blob", "kind", "version").distinct()
            .join(spans, ["blob", "kind", "version"], "left")
            .withColumn("spans", F.coalesce("spans", F.expr("cast(array() as array<struct<start:int,end:int>>)")))
        )
        done.write.mode("append").option("compression", "zstd").parquet(ledger)
        ranks = F.create_map(*(x for i, r in enumerate(rules) for x in (F.lit(r.kind), F.lit(i))))
        current = _ledger(spark, ledger).join(
            F.broadcast(spark.range(1).select(F.inline(every))), ["kind", "version"], "left_semi"
        )
        one = F.transform(
            "spans", lambda s: F.struct(s["start"].alias("start"), ranks[F.col("kind")].alias("rank"), s["end"].alias("end"), F.col("kind").alias("kind"))
        )
        per_blob = current.dropDuplicates(["blob", "kind", "version"]).where(F.size("spans") > 0).groupBy("blob").agg(
            F.sort_array(F.flatten(F.collect_list(one))).alias("spans")
        )
        return tables.store(
            blobs.select("blob").join(per_blob, "blob", "left").withColumn("spans", F.coalesce("spans", F.expr(f"cast(array() as {SPAN})"))),
            "result",
        )


def _ledger(spark, path: str) -> DataFrame:
    """The ledger so far; a folder that does not exist is an empty one."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    if place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        return spark.read.schema(LEDGER).parquet(path)
    return spark.createDataFrame([], LEDGER)


def find_secrets(versions: DataFrame, ledger: str, path_column: str, text_column: str = "text", rules=RULES) -> DataFrame:
    """All rows and columns of ``versions`` with ``secret_spans`` (start, rank, end, kind), sorted.

    Empty and null texts have no spans. Repeated paths and texts are fine. A column named
    ``secret_spans`` is replaced. An empty table gives an empty result.
    """
    found = scan(versions, ledger, path_column, text_column, rules).toDF("_blob", "_spans")
    rows = versions.withColumn("_blob", blob_of(whole_text(text_column)))
    joined = rows.join(found.hint("merge"), "_blob").withColumn("secret_spans", F.col("_spans"))
    return joined.drop("_blob", "_spans")


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with every span, or run of overlapping spans, replaced by a mark."""

    def step(state: Column, span: Column) -> Column:
        at, out = state["at"], state["out"]
        fresh = F.concat(out, F.substr(text, at + 1, span["start"] - at), F.lit(mark))
        return F.struct(
            F.greatest(at, span["end"]).alias("at"),
            F.when(span["start"] >= at, fresh).otherwise(out).alias("out"),
        )

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    done = F.aggregate(spans, start, step, lambda s: F.concat(s["out"], F.substr(text, s["at"] + 1, F.length(text))))
    return F.when(F.size(spans) == 0, text).otherwise(done)


def of_kind(spans: Column, *kinds: str) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))


def as_text(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    one = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(one, ",")
