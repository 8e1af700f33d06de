"""Quality rules by host: documents fail rules, hosts fail by shrunken rates.

Each document is held against a base rule and a few style rules. Failures are
summed by host, and each host's failure rate per rule is shrunk towards the rate
of all hosts with a beta prior whose two parameters come from the hosts
themselves (method of moments). A host whose shrunken rate of any rule is above
the limit is rejected, and so are its documents. Built-in functions only.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stewardry.llm.staging import hidden, staged
from stewardry.llm.texts import BREAKS, words

# Symbol characters of the base facts.
SYMBOLS = "#*$%&|<>"

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
WINDOW = 3
# A host with a shrunken failure rate above this loses its documents.
MAX_HOST_RATE = 0.5

# Rules over the base facts, as SQL.
RULES = {
    "base": f"n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words",
    "symbols": "10 * n_symbols > n_words",
    "lines": "2 * n_dup_lines > n_lines",
    "word_length": "word_chars < 2 * n_words OR word_chars > 15 * n_words",
}
FACTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]


def with_facts(documents: DataFrame, text: str = "text") -> DataFrame:
    """Add the base facts of each whole text; a null text has none of anything.

    Repeated 3-word windows are found by 64-bit hash: only a text whose windows
    aren't all different has them sorted, which brings equal ones together. A
    repeated window covers its words up to the next one's start or its own end.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    whole = lambda c: c.cast("long")
    has_word = lambda line: F.length(F.btrim(line, F.lit(BREAKS))) > 0
    nothing = F.array().cast("array<struct<h:bigint,i:int>>")

    rows = documents.withColumns(
        {
            "_words": words(F.col(text)),
            "_lines": F.filter(F.split(body, "\n"), has_word),
            "word_chars": whole(F.length(F.translate(body, BREAKS, ""))),
            "n_symbols": whole(F.length(body) - F.length(F.translate(body, SYMBOLS, ""))),
        }
    )
    rows = rows.withColumns(
        {
            "n_words": whole(F.size("_words")),
            "n_lines": whole(F.size("_lines")),
            "n_dup_lines": whole(F.size("_lines") - F.size(F.array_distinct("_lines"))),
            "_windows": F.when(
                F.size("_words") >= WINDOW,
                F.transform(
                    F.sequence(F.lit(0), F.size("_words") - WINDOW),
                    lambda i: F.xxhash64(*[F.get("_words", i + k) for k in range(WINDOW)]),
                ),
            ).otherwise(F.array().cast("array<bigint>")),
        }
    ).drop("_words", "_lines")
    rows = rows.withColumn(
        "_sorted",
        F.when(
            F.size(F.array_distinct("_windows")) < F.size("_windows"),
            F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ).otherwise(nothing),
    ).drop("_windows")
    window = lambda k: F.get("_sorted", k)["h"]
    rows = rows.withColumn(
        "_starts",
        F.array_sort(
            F.transform(
                F.filter(
                    F.transform("_sorted", lambda one, k: F.struct(one["h"].alias("h"), one["i"].alias("i"), k.alias("k"))),
                    lambda one: F.coalesce(one["h"] == window(one["k"] - 1), F.lit(False))
                    | F.coalesce(one["h"] == window(one["k"] + 1), F.lit(False)),
                ),
                lambda one: one["i"],
            )
        ),
    ).drop("_sorted")
    gaps = F.transform(
        "_starts",
        lambda at, k: F.coalesce(F.least(F.get("_starts", k + 1) - at, F.lit(WINDOW)), F.lit(WINDOW)),
    )
    covered = F.aggregate(gaps, F.lit(0).cast("long"), lambda total, gap: total + gap)
    return rows.withColumn("n_repeat_words", covered).drop("_starts")


def host_rates(failures: DataFrame, host: str, rules: list[str]) -> DataFrame:
    """One row per host: documents, and for each rule the shrunken failure rate.

    ``failures`` has a boolean column ``fails_<rule>`` per rule. The prior of a
    rule has the mean m of all documents and the strength s = m (1 - m) / v - 1,
    where v is the variance of the hosts' rates, each host weighing as much as it
    has documents, less what chance adds to it; a variance of nothing or less
    means that the hosts are alike, and each gets m.
    """
    counted = failures.groupBy(host).agg(
        F.count(F.lit(1)).alias("n_documents"),
        *[F.sum(F.col(f"fails_{r}").cast("long")).alias(f"n_{r}") for r in rules],
    )
    share = lambda r: F.col(f"n_{r}") / F.col("n_documents")
    # One row of sums, whatever the number of hosts.
    total = counted.agg(
        F.sum("n_documents").alias("documents"),
        F.count(F.lit(1)).alias("hosts"),
        *[F.sum(f"n_{r}").alias(f"sum_{r}") for r in rules],
        *[F.sum(F.col(f"n_{r}") * share(r)).alias(f"squares_{r}") for r in rules],
    ).first()
    n = total["documents"] or 1
    rates = []
    for r in rules:
        mean = (total[f"sum_{r}"] or 0) / n
        chance = mean * (1 - mean)
        between = (total[f"squares_{r}"] or 0) / n - mean * mean - chance * total["hosts"] / n
        strength = max(chance / between - 1, 0) if between > 0 else 0
        shrunk = (F.col(f"n_{r}") + mean * strength) / (F.col("n_documents") + strength)
        rates.append((shrunk if between > 0 else F.lit(float(mean))).alias(f"rate_{r}"))
    return counted.select(host, "n_documents", *rates)


def judge(
    documents: DataFrame,
    text: str = "text",
    host: str = "source",
    max_rate: float = MAX_HOST_RATE,
    keep_text: bool = True,
) -> DataFrame:
    """Every document with its facts, ``base_failed``, ``host_failed`` and ``kept``.

    Facts are staged once, for the hosts and for the result; ``keep_text`` says
    whether the text goes with them.

    Null or empty text: no words, so the base rule fails. A null host is a host
    of its own. Repeated rows each count and each come back; columns named like
    the new ones give way to them. No documents: no rows.
    """
    made = {*FACTS, "base_failed", "host_failed", "kept"} - {text, host}
    facts = with_facts(documents.drop(*made), text)
    facts = facts.withColumns({f"_fails_{r}": F.coalesce(F.expr(rule), F.lit(False)) for r, rule in RULES.items()})
    facts = staged(facts if keep_text else facts.drop(text), "facts")
    renamed = facts.select(F.col(host), *[F.col(f"_fails_{r}").alias(f"fails_{r}") for r in RULES])
    rates = host_rates(renamed, host, list(RULES))
    bad = reduce(lambda a, b: a | b, [F.col(f"rate_{r}") > max_rate for r in RULES])
    # Staged, so that the join knows the size of the hosts: where they are few,
    # documents stay where they are, and no host's documents meet in one task.
    verdicts = staged(rates.select(F.col(host).alias("_host"), bad.alias("host_failed")), "verdicts")
    rows = facts.join(verdicts, F.col(host).eqNullSafe(F.col("_host"))).drop("_host")
    rows = rows.withColumn("base_failed", F.col("_fails_base"))
    return rows.withColumn("kept", ~F.col("base_failed") & ~F.col("host_failed")).drop(*[f"_fails_{r}" for r in RULES])


def keep(documents: DataFrame, text: str = "text", host: str = "source") -> DataFrame:
    """The documents that :func:`judge` keeps, with their columns as they are."""
    given, names = hidden(documents)
    kept = judge(given, names[text], names[host]).where("kept")
    return kept.select(*[F.col(given_as).alias(c) for c, given_as in names.items()])
