"""Secret scans with an incremental blob ledger.

Every version of a text is a blob, addressed by the SHA-256 of its UTF-8
bytes. A ledger holds the (blob, rule version) pairs already scanned with
their findings; a scan runs each rule only over blobs that the ledger does
not have for that rule's version, once for all copies, and joins the
findings back to every path that holds the blob. ``Ledger`` keeps these rows
in a folder that outlives a run: an update appends what is new, and a job that
fails before its commit leaves the folder as it was.

Everything is a DataFrame function; matching uses ``split`` and
``regexp_extract_all`` (the pieces between matches and the matches, which
together give every match's place).

Edge cases: a null text is the empty blob; paths may repeat and may be null;
an empty table gives empty results; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from netloom.session import materialize


@dataclass(frozen=True)
class Rule:
    """A kind of secret. A match counts if ``group`` of it has at least
    ``least`` characters; others are dropped after they are matched. Raising
    ``version`` makes earlier scans of the rule out of date."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    version: int = 1


#: The base rules, in the order that spans of one place take.
ASSIGN = Rule(
    "assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6
)
ACCESS = Rule("access", r"AKIA[A-Z0-9]+", 0, 20)
HEX = Rule("hex", r"[0-9a-f]+", 0, 24)
BASE = (ASSIGN, ACCESS, HEX)
#: A private key is its header and all up to its END line, if no other line of
#: dashes comes before that. Without END it is the header, the key's own header
#: lines and the base64 lines that follow; the last of these may be short. The
#: group that repeats without a bound is possessive: it takes no stack, and what
#: it stops at can only be a run of five dashes or the end.
PRIVATE_KEY = Rule(
    "private_key",
    r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"
    r"(?:[^-]*(?:-{1,4}+[^-]++)*+-{5,}END (?:[A-Z]+ )*PRIVATE KEY-----"
    r"|(?:\s*(?:Proc-Type|DEK-Info):[^\r\n]*){0,2}[A-Za-z0-9+/=\s\\]*[A-Za-z0-9+/=]{16,}"
    r"(?:\s+[A-Za-z0-9+/]{1,15}={1,2}|[\x20\t]*\r?\n[\x20\t]*[A-Za-z0-9+/]+(?m:$))?)?",
    version=3,
)
#: Rules beyond the base: private keys, signed tokens, vendor tokens.
MORE = (
    PRIVATE_KEY,
    Rule("signed_token", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 40),
    Rule("vendor_token", r"(?:gh[pousr]_|xox[abprs]-|sk_live_)[A-Za-z0-9_-]+", 0, 24),
)
RULES = BASE + MORE

#: Unseen blobs (64 bytes each) that are broadcast; beyond it all texts are
#: grouped by blob, and the ledger tells which pairs are left to scan.
SENT = 1 << 18
FINDING = "array<struct<start:int,end:int,rank:int,kind:string>>"


def blob_id(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def spans_of(text: Column, rule: Rule, rank: int) -> Column:
    """The rule's matches in ``text``: (start, end, rank, kind), offsets in
    code points, end exclusive."""
    pattern = F.lit(rule.pattern)
    gaps = F.transform(F.split(text, rule.pattern, -1), F.char_length)
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    weighed = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else found
    zero = F.struct(F.lit(0).alias("at"), F.array().cast(FINDING).alias("out"))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["gap"]
        end = start + F.char_length(x["found"])
        span = F.struct(start.alias("start"), end.alias("end"), F.lit(rank).alias("rank"), F.lit(rule.kind).alias("kind"))
        kept = F.char_length(x["weighed"]) >= rule.least
        return F.struct(end.alias("at"), F.when(kept, F.concat(acc["out"], F.array(span))).otherwise(acc["out"]).alias("out"))

    pieces = F.arrays_zip(F.slice(gaps, F.lit(1), F.size(found)).alias("gap"), found.alias("found"), weighed.alias("weighed"))
    spans = F.aggregate(pieces, zero, step, lambda acc: acc["out"])
    # most texts hold no match at all; one look spares them the rest
    likely = F.rlike(text, pattern)
    return F.when(likely, spans).otherwise(F.array().cast(FINDING))


def rule_table(rules: Sequence[Rule]) -> Column:
    """The rules as (rank, kind, version) structs."""
    return F.array(
        *[F.struct(F.lit(i).alias("rank"), F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version")) for i, r in enumerate(rules)]
    )


def scan(versions: DataFrame, rules: Sequence[Rule] = RULES, ledger: DataFrame | None = None) -> DataFrame:
    """New ledger rows (blob, kind, version, spans) for ``versions`` (with a
    column ``text``): every pair of a blob and a rule version that ``ledger``
    does not have, spans empty where nothing was found.

    One row per blob reaches the rules. The text of a blob crosses the network
    once for each task that holds a copy, however many copies there are.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    blobs = versions.select(blob_id(F.col("text")).alias("blob"), text.alias("text"))
    blobs = blobs.groupBy("blob").agg(F.first("text").alias("text"))
    if ledger is not None:
        # rules whose current version each blob has been scanned with
        seen = ledger.groupBy("blob").agg(F.collect_set(F.struct("kind", "version")).alias("seen"))
        blobs = blobs.join(seen, "blob", "left")
    else:
        blobs = blobs.withColumn("seen", F.array().cast("array<struct<kind:string,version:int>>"))

    def one(i: int, r: Rule) -> Column:
        had = F.array_contains(
            F.coalesce("seen", F.array().cast("array<struct<kind:string,version:int>>")),
            F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version")),
        )
        found = F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version"), spans_of(F.col("text"), r, i).alias("spans"))
        return F.when(~had, found)

    found = blobs.select("blob", F.array_compact(F.array(*[one(i, r) for i, r in enumerate(rules)])).alias("f"))
    return found.select("blob", F.explode("f").alias("f")).select("blob", "f.kind", "f.version", "f.spans")


def _current(rules: Sequence[Rule]) -> Column:
    return reduce(lambda a, b: a | b, [(F.col("kind") == r.kind) & (F.col("version") == r.version) for r in rules])


class Ledger:
    """The (blob, kind, version, spans) rows of all scans so far, in the folder
    ``path`` (shared by all executors), which is made if it is not there."""

    SCHEMA = f"blob string, kind string, version int, spans {FINDING}"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        spark.createDataFrame([], self.SCHEMA).write.mode("ignore").parquet(path)

    def rows(self) -> DataFrame:
        return self.spark.read.schema(self.SCHEMA).parquet(self.path)

    def unseen(self, versions: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
        """(blob): those of ``versions`` that some rule's current version has not
        scanned. Only hashes cross the network."""
        pairs = self.rows().where(_current(rules)).select("blob", "kind").distinct()
        done = pairs.groupBy("blob").agg(F.count("*").alias("n")).where(F.col("n") == len(rules))
        return versions.select(blob_id(F.col("text")).alias("blob")).distinct().join(done, "blob", "left_anti")

    def update(self, versions: DataFrame, rules: Sequence[Rule] = RULES) -> None:
        """Scan the pairs that are not in the ledger and append them, in one commit.
        Where few blobs are new, only their texts cross the network."""
        new = materialize(self.unseen(versions, rules), "ledger_unseen")
        if new.count() <= SENT:
            at = versions.select("text", blob_id(F.col("text")).alias("blob"))
            versions = at.join(F.broadcast(new), "blob", "left_semi").select("text")
        # a blob with some of its pairs seen is scanned for the others alone
        scan(versions, rules, self.rows().where(_current(rules))).write.mode("append").parquet(self.path)


def findings(scanned: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """(blob, spans): all spans that the rules' current versions found in a
    blob, by start, then in the order of the rules. Blobs without any are
    left out; a pair that two scans at once appended counts once."""
    current = scanned.where("size(spans) > 0").where(_current(rules))
    return current.groupBy("blob").agg(F.sort_array(F.flatten(F.collect_set("spans"))).alias("spans"))


def paths_with_findings(versions: DataFrame, found: DataFrame, path: str) -> DataFrame:
    """(path, spans) of every version, copies included; spans is empty where
    its blob has none."""
    at = versions.select(path, blob_id(F.col("text")).alias("blob"))
    rows = at.join(found, "blob", "left")
    return rows.select(path, F.coalesce("spans", F.array().cast(FINDING)).alias("spans"))


def redact(docs: DataFrame, ledger: Ledger, rules: Sequence[Rule] = RULES, mask: str = "[secret]") -> DataFrame:
    """``docs`` with every span found in its texts replaced by ``mask``; overlapping
    spans become one. ``ledger`` is brought up to date first, and the findings
    come from it. Null texts stay null, n_chars, if there, is counted anew."""
    ledger.update(docs, rules)
    found = findings(ledger.rows(), rules)
    rows = docs.withColumn("_blob", blob_id(F.col("text"))).join(found.select(F.col("blob").alias("_blob"), F.col("spans").alias("_spans")), "_blob", "left")
    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        before = F.substring(F.col("text"), acc["at"] + 1, s["start"] - acc["at"])
        fresh = F.concat(acc["out"], before, F.lit(mask))
        return F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            # an overlap is masked already
            F.when((s["start"] < acc["at"]) & (acc["at"] > 0), acc["out"]).otherwise(fresh).alias("out"),
        )

    rest = lambda acc: F.concat(acc["out"], F.substring(F.col("text"), acc["at"] + 1, F.char_length(F.col("text"))))
    out = rows.withColumn("text", F.when(F.size("_spans") > 0, F.aggregate("_spans", zero, step, rest)).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)
