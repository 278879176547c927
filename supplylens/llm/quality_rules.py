"""Quality rules judged by host, in DataFrame operations only.

Each document is measured inside its own row. Failures of each rule are then summed by host, the
hosts' failure rates give an empirical beta prior by the method of moments, every host's rate is
shrunk towards that prior, and the verdict goes back to the documents of the host. A host of three
documents cannot be condemned by two bad ones; a host of a million is judged by its own record.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.frames import with_scalars
from ..functions.workspace import hold

_WHITE = r"[\x20\x09-\x0D]+"
_SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MOST_REPEATED_PERCENT = 50


def host_of(source: Column) -> Column:
    """The host of a URL, or the value itself where it is no URL; null is the empty host."""
    host = F.regexp_extract(source, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@]*@)?([^/:?#]+)", 1)
    return F.coalesce(F.when(host != "", F.lower(host)).otherwise(source), F.lit(""))


def _repeated_words(docs: DataFrame) -> DataFrame:
    """Add ``_repeat``: words inside three-word windows that occur twice or more in the text.

    Windows are compared by a 64-bit hash within one text. Only a text that has a repeated window
    sorts its windows; equal neighbours are the repeats, so the cost is n log n for any length.
    """
    windows = F.transform(
        F.sequence(F.lit(0), F.size("_words") - 3),
        lambda i: F.xxhash64(F.get("_words", i), F.get("_words", i + 1), F.get("_words", i + 2)),
    )
    docs = docs.withColumn("_hashes", F.when(F.size("_words") >= 3, windows).otherwise(F.array().cast("array<bigint>")))
    docs = docs.withColumn("_any", F.size(F.array_distinct("_hashes")) < F.size("_hashes"))
    pairs = F.transform("_hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    docs = docs.withColumn("_sorted", F.when(F.col("_any"), F.sort_array(pairs)))
    docs = docs.withColumn(
        "_at",
        F.filter(
            F.transform(
                "_sorted",
                lambda x, k: F.when(
                    x["h"].eqNullSafe(F.get("_sorted", k - 1)["h"]) | x["h"].eqNullSafe(F.get("_sorted", k + 1)["h"]), x["i"]
                ),
            ),
            lambda i: i.isNotNull(),
        ),
    )
    covered = F.array_distinct(F.concat("_at", F.transform("_at", lambda i: i + 1), F.transform("_at", lambda i: i + 2)))
    return docs.withColumn("_repeat", F.when(F.col("_any"), F.size(covered)).otherwise(0))


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per input row: id, host and the counts the rules use."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("_id"), host_of(F.col(source_col)).alias("_host"), text.alias("_text"))
    rows = rows.withColumn("_words", F.filter(F.split("_text", _WHITE), lambda w: w != ""))
    rows = rows.withColumn("_lines", F.filter(F.split("_text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    rows = _repeated_words(rows)
    return rows.select(
        F.col("_id").alias(id_col),
        F.col("_host").alias("host"),
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.translate("_text", " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
        (F.length("_text") - F.length(F.translate("_text", _SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.col("_repeat").cast("long").alias("n_repeat_words"),
        F.size("_lines").cast("long").alias("n_lines"),
    )


def rule_failures() -> dict[str, Column]:
    """Rules by name; each is true where a document fails. The first two make base_failed."""
    n = F.col("n_words")
    return {
        "short": n < MIN_WORDS,
        "repeats": 100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * n,
        "symbols": 10 * F.col("n_symbols") > n,
        "dup_lines": 10 * F.col("n_dup_lines") > 3 * F.col("n_lines"),
        "word_length": (F.col("word_chars") < 3 * n) | (F.col("word_chars") > 10 * n),
    }


def host_verdicts(measured: DataFrame, most: float = 0.5) -> DataFrame:
    """One row per host: documents, and for each rule the failures and the shrunk rate.

    The prior of a rule is Beta(a, b) with the mean of all documents and the strength that the
    spread of the hosts' rates beyond chance suggests, held between 2 and 1000 pseudo-documents; if
    hosts differ no more than chance, the strength is 1000. A host is rejected if the shrunk rate of
    some rule is over ``most``, that is if most of its documents break the same rule.
    """
    rules = rule_failures()
    hosts = measured.groupBy("host").agg(
        F.count(F.lit(1)).alias("n_docs"),
        *[F.sum(F.coalesce(c, F.lit(False)).cast("long")).alias(f"{r}_failed") for r, c in rules.items()],
    )
    n = F.col("n_docs")
    moments = [F.sum(n).alias("_n"), F.sum(n * n).alias("_nn"), F.count(F.lit(1)).alias("_k")]
    for r in rules:
        f = F.col(f"{r}_failed")
        moments += [F.sum(f).alias(f"_{r}_f"), F.sum(f * f / n).alias(f"_{r}_ff")]
    prior = hosts.agg(*moments)
    for r in rules:
        mean = F.try_divide(F.col(f"_{r}_f"), F.col("_n"))
        between = F.col(f"_{r}_ff") - F.col("_n") * mean * mean  # weighted squared distance of the rates
        chance = mean * (1 - mean) * (F.col("_k") - 1)
        size = F.col("_n") - F.try_divide(F.col("_nn"), F.col("_n"))
        variance = F.try_divide(between - chance, size)
        strength = F.when(variance > 0, F.try_divide(mean * (1 - mean), variance) - 1).otherwise(F.lit(1000.0))
        prior = prior.withColumn(f"_{r}_m", mean).withColumn(
            f"_{r}_s", F.greatest(F.lit(2.0), F.least(F.lit(1000.0), strength))
        )
    prior = prior.select(*[c for r in rules for c in (f"_{r}_m", f"_{r}_s")])
    judged = with_scalars(hosts, prior)
    for r in rules:
        a = F.col(f"_{r}_m") * F.col(f"_{r}_s")
        judged = judged.withColumn(f"{r}_rate", (F.col(f"{r}_failed") + a) / (n + F.col(f"_{r}_s")))
    worst = F.greatest(*[F.col(f"{r}_rate") for r in rules])
    return judged.withColumn("host_ok", worst <= most).drop(*prior.columns)


def judge(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", most: float = 0.5
) -> DataFrame:
    """One row per input row: id, host, the measures, base_failed and kept.

    Null text has no words and fails; null source is one host of its own; repeated rows are judged
    alike, each gives a row. Columns of other names are ignored. An empty table gives no rows.
    """
    measured = hold(measures(docs, id_col, text_col, source_col), "measures")
    rules = rule_failures()
    verdicts = host_verdicts(measured, most).select("host", "host_ok")
    base = rules["short"] | rules["repeats"]
    return (
        measured.join(verdicts, "host", "left")
        .withColumn("base_failed", base)
        .withColumn("kept", ~F.col("base_failed") & F.col("host_ok"))
    )
