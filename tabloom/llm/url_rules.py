"""URL filtering by association rules, beside a list of fixed host and path rules.

A URL becomes a set of tokens: the labels of its host, the segments of its path, the keys of its
query. Spark's FP-growth mines the token combinations of labelled URLs; a combination implies a
verdict if it is frequent enough and its share of that verdict high enough, and a rule is pruned if
a part of its tokens alone is at least as sure. Rules are looked up through an inverted index that
holds each rule under its rarest token. Fixed rules come first; the longest that fits wins.

Cases: a URL that is null or lacks ``://`` has an empty host and path and no tokens; with no
labels, or no rule that matches, the verdict is the default; labels that are neither verdict or
null are not learned from; repeated rows count and each give a row, also with a null id; only the
columns named by the arguments are read.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.llm.common import lower_ascii, stored

VERDICTS = ("allow", "block")


def after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def host_of(url: Column) -> Column:
    return F.coalesce(lower_ascii(F.regexp_extract(after_scheme(url), r"(?s)^([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(after_scheme(url), r"(?s)^[^/?#]*([^?#]*)", 1), F.lit(""))


def tokens_of(url: Column) -> Column:
    """Distinct tokens: ``h:`` host labels, ``p:`` path segments, ``q:`` query keys."""
    query = F.regexp_extract(F.coalesce(after_scheme(url), F.lit("")), r"(?s)^[^?#]*\?([^#]*)", 1)
    parts = [
        F.transform(F.split(host_of(url), "\\."), lambda t: F.concat(F.lit("h:"), t)),
        F.transform(F.split(lower_ascii(path_of(url)), "/"), lambda t: F.concat(F.lit("p:"), t)),
        F.transform(F.split(query, "&"), lambda t: F.concat(F.lit("q:"), F.split(t, "=")[0])),
    ]
    return F.array_distinct(F.filter(F.concat(*parts), lambda t: F.length(t) > 2))


def fixed_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """Rule and verdict of the longest of ``(verdict, host, path)`` that fits, else nulls."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, rule_host, rule_path in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        name = F.when(fits, F.lit(rule_host + rule_path)).otherwise(name)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return name, verdict


def mine(
    labelled: DataFrame, tokens: str = "tokens", label: str = "verdict", min_support: float = 0.01,
    min_confidence: float = 0.8, longest: int = 3, partitions: int | None = None,
) -> DataFrame:
    """Rules (``needs`` tokens, ``verdict``, ``confidence``, ``seen`` rows with the tokens), pruned.

    ``min_support`` bounds the number of rules whatever the size of the input; ``longest`` is the
    most tokens a rule may need.
    """
    labelled = labelled.filter(F.col(label).isin(*VERDICTS) & (F.size(tokens) > 0))
    baskets = labelled.select(F.concat(tokens, F.array(F.concat(F.lit("="), F.col(label)))).alias("items"))
    baskets = stored(baskets, "url-baskets")
    rules_schema = "needs array<string>, verdict string, confidence double, seen long"
    if baskets.isEmpty():
        return baskets.sparkSession.createDataFrame([], rules_schema)
    settings = {"numPartitions": partitions} if partitions else {}
    sets = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence, **settings).fit(baskets).freqItemsets
    verdict = F.filter("items", lambda t: t.startswith("="))
    needs = F.array_sort(F.filter("items", lambda t: ~t.startswith("=")))
    sets = stored(sets.select(needs.alias("needs"), F.get(verdict, 0).alias("verdict"), F.size(verdict).alias("n"), "freq"), "url-sets")
    sets = sets.filter((F.size("needs") > 0) & (F.size("needs") <= longest))
    whole = sets.filter("n = 0").select("needs", F.col("freq").alias("seen"))
    rules = sets.filter("n = 1").join(whole, "needs")
    rules = rules.select("needs", F.substring("verdict", 2, 9).alias("verdict"), (F.col("freq") / F.col("seen")).alias("confidence"), "seen")
    rules = stored(rules.filter(F.col("confidence") >= min_confidence), "url-rules")
    return _pruned(rules)


def _pruned(rules: DataFrame) -> DataFrame:
    """Without the rules of which a part, as a rule of its own, is at least as sure."""
    surer = rules.select(F.col("needs").alias("part"), F.col("confidence").alias("sure"), F.get("needs", 0).alias("token"))
    tokens = rules.select("needs", "verdict", "confidence", F.explode("needs").alias("token"))
    beaten = tokens.join(surer, "token").filter(
        (F.size("part") < F.size("needs")) & (F.size(F.array_except("part", "needs")) == 0) & (F.col("sure") >= F.col("confidence"))
    )
    return stored(rules.join(beaten.select("needs", "verdict").distinct(), ["needs", "verdict"], "left_anti"), "url-pruned")


def apply_rules(urls: DataFrame, rules: DataFrame, row: str, tokens: str = "tokens") -> DataFrame:
    """(row, verdict) of the rows that a rule matches: by the surest rule, then the most seen, the shortest, block first.

    The index holds a rule under its rarest token, so that common tokens find few rules.
    """
    counts = urls.select(F.explode(tokens).alias("token")).groupBy("token").count()
    wanted = rules.select(F.explode("needs").alias("token")).distinct()
    counts = stored(wanted.join(counts, "token", "left").fillna(0, ["count"]), "url-token-counts")
    anchors = rules.select("*", F.explode("needs").alias("token")).join(counts, "token")
    index = anchors.groupBy("needs", "verdict", "confidence", "seen").agg(F.min(F.struct("count", "token")).alias("a"))
    index = stored(index.select(F.col("a.token").alias("token"), "needs", "verdict", "confidence", "seen"), "url-index")
    found = urls.select(row, tokens, F.explode(tokens).alias("token")).join(index, "token")
    found = found.filter(F.size(F.array_except("needs", tokens)) == 0)
    best = F.max(F.struct("confidence", "seen", (-F.size("needs")).alias("short"), "verdict")).alias("best")
    return found.groupBy(row).agg(best).select(row, F.col("best.verdict").alias("verdict"))


def judge(
    pages: DataFrame, rules: list[tuple[str, str, str]], id_col: str = "page_id", url_col: str = "url",
    min_support: float = 0.01, min_confidence: float = 0.8, longest: int = 3, default: str = "allow",
) -> DataFrame:
    """Per page: id, ``host``, ``path``, ``rule`` and ``verdict``.

    The pages that a fixed rule judges are the labelled ones; what their tokens tell is carried
    over to all other pages.
    """
    url = F.col("_url")
    rows = pages.select(F.col(id_col), F.col(url_col).alias("_url"))
    rows = rows.select(id_col, host_of(url).alias("host"), path_of(url).alias("path"), tokens_of(url).alias("tokens"))
    name, verdict = fixed_rule(F.col("host"), F.col("path"), rules)
    rows = rows.withColumns({"rule": name, "fixed": verdict, "_row": F.monotonically_increasing_id()})
    rows = stored(rows, "url-rows")
    mined = mine(rows.filter("fixed is not null"), "tokens", "fixed", min_support, min_confidence, longest)
    others = stored(apply_rules(rows.filter("fixed is null"), mined, "_row"), "url-found")
    out = rows.join(others, "_row", "left")
    return out.select(id_col, "host", "path", "rule", F.coalesce("fixed", "verdict", F.lit(default)).alias("verdict"))
