"""Secret scans through a ledger of blobs, in DataFrame functions only.

Every version of every text is addressed by its content (SHA-256). A ledger of written rows says which rules, in which
version, have been put to which blob and what they found. ``update`` scans only pairs of blob and rule version that
the ledger lacks and appends one row for each such blob; ``report`` joins the findings of a blob back to all rows that
hold it. A copy is scanned once, a new version of a rule is put to every blob, an old one is not repeated.

Spans count code points, the end lies outside. The matches of a rule are its leftmost, non-overlapping ones; matches
that are too short are dropped after matching, so they still use up their characters.

Defined results: a null text is empty; rows with one id or none are reported each on its own; copies share findings;
a text without findings has empty spans and the hash of the empty string; an empty table adds nothing and reports
nothing; other columns are not read. A text is scanned whole however long it is. A failed update leaves the ledger as
it was; the next one scans what is still missing.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.utils import AnalysisException

from .common import bind, new_folder, written

#: So many matches are summed in one go; see ``starts``.
CHUNK = 256


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern`` whose ``group`` has at least ``least`` characters. Raise ``version`` with any change."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    version: int = 1

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: A run of hex digits of 16 or more is what is left of all runs once short ones are dropped; so with access keys.
BASE = (
    Rule("assign", ASSIGN, group=2, least=12),
    Rule("access", "AKIA[A-Z0-9]{14,}"),
    Rule("hex", "[0-9a-f]{16,}"),
)
ADDED = (
    Rule("private_key", "-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("signed_token", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("host_token", "(ghp|gho|ghu|ghs|ghr|glpat|xoxb|xoxp)[_-][A-Za-z0-9-]{20,}"),
    Rule("url_login", "[a-z]{2,20}://[^/:@\\x20\\x09-\\x0D]{1,100}:[^/@\\x20\\x09-\\x0D]{1,100}@"),
)
RULES = BASE + ADDED

SPANS = "array<struct<begin:int,end:int>>"
FOUND = "array<struct<kind:string,version:int,begin:int,end:int>>"
LEDGER = f"blob binary, rules array<string>, found {FOUND}"


def address(text: Column) -> Column:
    """The content address of a text."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))


def starts(steps: Column) -> Column:
    """Spans of kept matches out of ``steps``, one struct (gap, size, kept) a match: ``gap`` characters, then the match.

    Arrays grow by copying, so matches are summed in chunks: m of them copy about m * CHUNK + m * m / CHUNK entries.
    """

    def step(total: Column, s: Column) -> Column:
        begin = total["at"] + s["gap"]
        span = F.array(F.struct(begin.alias("begin"), (begin + s["size"]).alias("end")))
        spans = F.when(s["kept"], F.concat(total["spans"], span)).otherwise(total["spans"])
        return F.struct((begin + s["size"]).alias("at"), spans.alias("spans"))

    def zero(at: Column) -> Column:
        return F.struct(at.alias("at"), F.array().cast(SPANS).alias("spans"))

    def chunk(total: Column, i: Column) -> Column:
        inner = F.aggregate(F.slice(steps, i * CHUNK + 1, F.lit(CHUNK)), zero(total["at"]), step)
        return bind(inner, lambda x: F.struct(x["at"].alias("at"), F.concat(total["spans"], x["spans"]).alias("spans")))

    last = F.floor((F.size(steps) - 1) / CHUNK).cast("int")
    return F.aggregate(F.sequence(F.lit(0), last), zero(F.lit(0)), chunk)["spans"]


def matches(text: Column, rule: Rule) -> Column:
    """The spans of one rule in a text. A text without a match is passed over once and nothing more."""
    hits = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    held = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group))
    pieces = F.arrays_zip(F.split(text, rule.pattern, -1).alias("gap"), hits.alias("hit"), held.alias("held"))
    # the piece after the last match has no match and falls away
    steps = F.transform(
        F.filter(pieces, lambda p: p["hit"].isNotNull()),
        lambda p: F.struct(
            F.length(p["gap"]).alias("gap"), F.length(p["hit"]).alias("size"), (F.length(p["held"]) >= rule.least).alias("kept")
        ),
    )
    return F.when(text.rlike(rule.pattern), bind(steps, starts)).otherwise(F.array().cast(SPANS))


def read(spark: SparkSession, folder: str) -> DataFrame:
    """The ledger in ``folder``; an empty one where none was written."""
    try:
        return spark.read.schema(LEDGER).parquet(folder)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], LEDGER)


def unseen(docs: DataFrame, ledger: DataFrame, rules: Sequence[Rule], text: str = "text") -> DataFrame:
    """(blob, text, rules): each blob once, with the keys of the rules that the ledger has not put to it yet.

    Copies meet on the map side first, so a blob that a third of all rows hold sends one row a task.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    blobs = docs.select(address(body).alias("blob"), body.alias("text")).groupBy("blob").agg(F.first("text").alias("text"))
    seen = ledger.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("rules"))).alias("seen"))
    keys = F.array(*[F.lit(r.key) for r in rules]) if rules else F.array().cast("array<string>")
    missing = F.array_except(keys, F.coalesce("seen", F.array().cast("array<string>")))
    return blobs.join(seen, "blob", "left").select("blob", "text", missing.alias("rules")).where(F.size("rules") > 0)


def scan(fresh: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Ledger rows of ``fresh`` (blob, text, rules): only the rules named in a row are put to it."""

    def tagged(rule: Rule) -> Column:
        spans = F.transform(
            matches(F.col("text"), rule),
            lambda s: F.struct(
                F.lit(rule.kind).alias("kind"), F.lit(rule.version).alias("version"), s["begin"].alias("begin"), s["end"].alias("end")
            ),
        )
        return F.when(F.array_contains("rules", rule.key), spans).otherwise(F.array().cast(FOUND))

    return fresh.select("blob", "rules", F.concat(*[tagged(r) for r in rules]).cast(FOUND).alias("found"))


def update(docs: DataFrame, folder: str, rules: Sequence[Rule] = RULES, text: str = "text") -> None:
    """Scans what the ledger in ``folder`` lacks and appends it."""
    if rules:
        ledger = read(docs.sparkSession, folder)
        scan(unseen(docs, ledger, rules, text), rules).write.mode("append").parquet(folder)


def findings(ledger: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(blob, spans): the findings of the given rule versions, by start and then by the order of the rules."""
    order = F.create_map(*[F.lit(x) for i, r in enumerate(rules) for x in (r.key, i)])
    key = lambda s: F.concat(s["kind"], F.lit("@"), s["version"].cast("string"))
    asked = F.filter("found", lambda s: key(s).isin([r.key for r in rules]))
    rows = ledger.select("blob", asked.alias("found")).where(F.size("found") > 0)
    rows = rows.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("found"))).alias("found"))
    ranked = F.transform(
        "found", lambda s: F.struct(s["begin"].alias("begin"), order[key(s)].alias("rank"), s["end"].alias("end"), s["kind"].alias("kind"))
    )
    return rows.select("blob", F.sort_array(ranked).alias("spans"))


def report(docs: DataFrame, ledger: DataFrame, rules: Sequence[Rule] = RULES, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, spans) for every row of ``docs``: the findings of the blob it holds, none if there are none."""
    paths = docs.select(F.col(id).alias("doc_id"), address(F.col(text)).alias("blob"))
    # written first: the join then knows the size of its small side, and can split a blob that very many rows hold
    found = written(findings(ledger, rules), "findings")
    none = F.array().cast("array<struct<begin:int,rank:int,end:int,kind:string>>")
    return paths.join(found, "blob", "left").select("doc_id", F.coalesce("spans", none).alias("spans"))


def digest(reported: DataFrame, base: Sequence[Rule] = BASE) -> DataFrame:
    """Counts of the base kinds, the hash of their spans, and all spans as ``kind:start:end`` joined by commas."""
    names = [r.kind for r in base]
    joined = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["begin"].cast("string"), s["end"].cast("string"))), ","
    )
    # two parameters would make the second one the place in the array
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    counts = [count(kind).alias(f"n_{kind}") for kind in names]
    held = joined(F.filter("spans", lambda s: s["kind"].isin(names)))
    return reported.select("doc_id", *counts, F.sha2(held.cast("binary"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def scanned(docs: DataFrame, folder: str | None = None, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Updates the ledger in ``folder`` (a new one in the shared folder if none is named) and reports all rows."""
    spark = docs.sparkSession
    folder = folder or new_folder(spark, "ledger")
    update(docs, folder, rules)
    return digest(report(docs, read(spark, folder), rules))
