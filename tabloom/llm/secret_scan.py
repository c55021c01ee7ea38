"""Secret scans by an incremental ledger of blobs.

Every version of every path is addressed by the SHA-256 of its content. The ledger holds, for each
blob, the rule versions that have scanned it and the spans they found; only pairs of blob and rule
version that it lacks are scanned, however many paths or versions share the blob, and findings are
joined back to all of them. Raising a rule's version, or adding a rule, scans old blobs with that
rule alone; old entries stay and are read only for the versions asked for.

A blob that a third of all rows hold is combined before the shuffle and scanned once; the join back
has one row per blob on its other side, so that adaptive execution can split the paths. The ledger
is a Parquet table that Spark appends to and commits whole: a lost executor or a failed run leaves
nothing half written, and a run that is started again scans what is still missing.

Cases: a null text is an empty text, which has a blob like any other; repeated rows, null paths and
rows with equal texts each get all spans of their text; whole texts are scanned, however long; an
empty table scans nothing and gives no rows; columns other than the text and the kept ones are not
read, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LEDGER = "blob binary, rules array<string>, spans array<struct<rule: string, kind: string, start: int, end: int>>"


@dataclass(frozen=True)
class Rule:
    """A kind of secret: matches of ``pattern``, leftmost and apart, whose ``group`` has ``least`` characters."""

    kind: str
    pattern: str
    least: int
    group: int = 0
    any_case: bool = False
    version: int = 1
    needs: tuple[str, ...] = ()  # a text without any of these holds no match

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"

    def spans(self, text: str) -> list[tuple[int, int]]:
        if self.needs and not any(n in text for n in self.needs):
            return []
        flags = re.ASCII | (re.IGNORECASE if self.any_case else 0)
        found = re.compile(self.pattern, flags).finditer(text)
        return [m.span() for m in found if m.end(self.group) - m.start(self.group) >= self.least]


# The base kinds, in the order of the report.
BASE_RULES = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2, True, needs=(":", "=")),
    Rule("access", r"AKIA[A-Z0-9]+", 20, needs=("AKIA",)),
    # Runs that are long enough at once: the same matches as of shorter ones judged afterwards.
    Rule("hex", r"[0-9a-f]{24,}", 24),
)
# Further kinds: heads of private keys, signed web tokens, tokens of a code host.
MORE_RULES = (
    Rule("pem", r"-----BEGIN [A-Z0-9 ]*PRIVATE KEY-----", 27, needs=("-----BEGIN ",)),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 40, needs=("eyJ",)),
    Rule("host_token", r"gh[oprsu]_[A-Za-z0-9]+", 40, needs=("gho_", "ghp_", "ghr_", "ghs_", "ghu_")),
)
RULES = (*BASE_RULES, *MORE_RULES)


def blob_of(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def open_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger at ``path``; a new one is an empty table."""
    try:
        return spark.read.schema(LEDGER).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
    spark.createDataFrame([], LEDGER).write.mode("append").parquet(path)
    return spark.read.schema(LEDGER).parquet(path)


def unseen(versions: DataFrame, ledger: DataFrame, rules: Sequence[Rule], text_col: str = "text") -> DataFrame:
    """(blob, text, todo): one row for each blob that some of the rule versions have not scanned."""
    keys = F.array(*[F.lit(r.key) for r in rules])
    seen = (
        ledger.select("blob", F.explode(F.array_intersect("rules", keys)).alias("rule"))
        .groupBy("blob").agg(F.collect_set("rule").alias("seen"))
    )
    # Texts are combined per blob and shuffled by it once; the ledger comes to them.
    blobs = versions.select(blob_of(F.col(text_col)).alias("blob"), F.col(text_col).alias("text"))
    blobs = blobs.groupBy("blob").agg(F.first("text").alias("text"))
    todo = F.when(F.col("seen").isNull(), keys).otherwise(F.array_except(keys, F.col("seen")))
    return blobs.join(seen, "blob", "left").select("blob", "text", todo.alias("todo")).filter(F.size("todo") > 0)


def scan(todo: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Ledger rows of blobs that are to be scanned."""
    import pyarrow as pa

    by_key = {r.key: r for r in rules}
    span = pa.struct([("rule", pa.string()), ("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(2).to_pylist()
            spans = []
            for i, names in enumerate(keys):
                text = batch.column(1)[i].as_py() or ""
                spans.append([(name, by_key[name].kind, a, b) for name in names for a, b in by_key[name].spans(text)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(keys, pa.list_(pa.string())), pa.array(spans, pa.list_(span))],
                names=["blob", "rules", "spans"],
            )

    return todo.select("blob", "text", "todo").mapInArrow(run, LEDGER)


def record(versions: DataFrame, path: str, rules: Sequence[Rule] = RULES, text_col: str = "text") -> None:
    """Scan what the ledger at ``path`` lacks for these versions and append it."""
    ledger = open_ledger(versions.sparkSession, path)
    scan(unseen(versions, ledger, rules, text_col), rules).write.mode("append").parquet(path)


def findings(
    versions: DataFrame, path: str, rules: Sequence[Rule] = RULES, keep: Sequence[str] = ("doc_id",), text_col: str = "text"
) -> DataFrame:
    """One row for each version: the kept columns and its ``spans`` (kind, start, end; code points).

    Spans come from the ledger, those of the given rule versions only, by start and then by the
    order of ``rules``; versions that were never recorded have none.
    """
    keys = F.array(*[F.lit(r.key) for r in rules])
    ledger = open_ledger(versions.sparkSession, path).filter(F.size("spans") > 0)
    order = F.array_position(keys, F.col("s.rule"))
    found = (
        ledger.select("blob", F.explode("spans").alias("s"))
        .filter(order > 0)
        .groupBy("blob")
        .agg(F.collect_set(F.struct("s.start", order.alias("place"), "s.end", "s.kind")).alias("spans"))
        .select("blob", F.array_sort("spans").alias("spans"))
    )
    paths = versions.select(F.struct(*keep).alias("kept"), blob_of(F.col(text_col)).alias("blob"))
    spans = F.transform("spans", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    spans = F.coalesce(spans, F.array().cast("array<struct<kind: string, start: int, end: int>>"))
    return paths.join(found, "blob", "left").select(*[F.col("kept")[c].alias(c) for c in keep], spans.alias("spans"))


def written(spans: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def report(found: DataFrame, base: Sequence[Rule] = BASE_RULES) -> DataFrame:
    """Counts and digests of findings: ``n_<kind>`` of the base kinds, ``base_sha256``, ``spans`` as text."""
    spans = F.col("spans")
    names = F.array(*[F.lit(r.kind) for r in base])

    def count(kind: str) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    own = F.filter(spans, lambda s: F.array_contains(names, s["kind"]))
    return found.select(
        *[c for c in found.columns if c != "spans"], *[count(r.kind) for r in base], F.sha2(written(own), 256).alias("base_sha256"), written(spans).alias("spans")
    )
