"""Quality rules by weak supervision: rules vote or abstain, EM weighs them, a posterior decides.

Only Spark expressions: all counts are made inside the row in one pass over the
text, which is never shuffled; the counts are written and read from then on. What leaves the rows is one count per pattern of votes, at most
3 ** len(RULES) rows whatever the corpus holds.
"""

from dataclasses import dataclass
from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chorus.llm.common import words
from chorus.operators.scale import pin

SYMBOLS = "[#*$%&|<>]"
RUNS = r"[!-/:-@\[-`{-~]{2,}"
WINDOW = 3
FEW_REPEATS = 24
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rule:
    """Votes good up to ``good``, bad from ``bad`` on, and abstains between or without a value."""

    name: str
    value: Column
    good: float
    bad: float

    def vote(self) -> Column:
        return F.when(self.value <= self.good, F.lit(1)).when(self.value >= self.bad, F.lit(0))


def _ratio(part: Column, whole: Column) -> Column:
    return part / F.nullif(whole, F.lit(0))


def rules() -> list[Rule]:
    n, lines = F.col("_n"), F.col("_n_lines")
    return [
        Rule("odd_characters", _ratio(F.col("_n_symbols") + F.col("_n_odd"), F.col("_word_chars")), 0.06, 0.12),
        Rule("decorated_words", _ratio(F.col("_n_runs"), n), 0.10, 0.40),
        Rule("repeated_lines", F.when(lines > 1, _ratio(F.col("_n_dup_lines"), lines)), 0.05, 0.30),
        Rule("repeated_words", _ratio(F.col("_n_repeat_words"), n), 0.20, 0.40),
        Rule("word_length", F.abs(_ratio(F.col("_word_chars"), n) - 5.5), 2.5, 4.5),
    ]


def _with_repeat_words(counted: DataFrame) -> DataFrame:
    """Replace ``_windows`` by the number of words inside a window that occurs twice or more.

    Every array a lambda looks into is a column made one step before: an
    expression inside a lambda would be evaluated again for every element.
    """
    h, order, twice, placed = F.col("_windows"), F.col("_order"), F.col("_twice"), F.col("_placed")
    ordered = counted.withColumn("_order", F.sort_array(h))
    repeated = ordered.withColumn(
        "_twice", F.array_distinct(F.filter(order, lambda x, i: (i > 0) & (x == F.get(order, i - 1))))
    ).drop("_order")
    laid = repeated.withColumn(
        "_placed",
        F.when(
            F.size(twice) > FEW_REPEATS,
            F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))),
        ),
    )
    few = F.filter(F.transform(h, lambda x, i: F.when(F.array_contains(twice, x), i)), lambda i: i.isNotNull())
    many = F.sort_array(F.transform(
        F.filter(
            placed, lambda x, i: x["h"].eqNullSafe(F.get(placed, i - 1)["h"]) | x["h"].eqNullSafe(F.get(placed, i + 1)["h"])
        ),
        lambda x: x["i"],
    ))
    starts = F.col("_starts")
    found = laid.withColumn(
        "_starts",
        F.when(F.size(twice) == 0, F.array().cast("array<int>")).when(F.size(twice) <= FEW_REPEATS, few).otherwise(many),
    ).drop("_placed", "_twice", "_windows")
    steps = F.transform(
        starts, lambda x, i: F.coalesce(F.least(F.lit(WINDOW), F.get(starts, i + 1) - x), F.lit(WINDOW))
    )
    covered = F.aggregate(steps, F.lit(0), lambda total, x: total + x)
    return found.withColumn("_n_repeat_words", covered.cast("bigint")).drop("_starts")


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the raw counts, in columns with a leading underscore, to every row.

    Words are compared by 64-bit hashes of their windows inside one text.
    Null and empty texts count zero throughout.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(body, "\n", -1), lambda x: x.rlike(r"[^ \t\n\x0B\f\r]"))
    kept = [F.col(c) for c in docs.columns]
    split = docs.select(
        *kept,
        words(F.col(text)).alias("_words"),
        lines.alias("_lines"),
        *[
            (F.length(body) - F.length(F.regexp_replace(body, chars, ""))).cast("bigint").alias(name)
            for name, chars in (("_n_symbols", SYMBOLS), ("_n_odd", r"[\p{Lu}\p{Nd}]"), ("_n_runs", RUNS))
        ],
    )
    w = F.col("_words")
    counted = split.select(
        *kept, "_n_symbols", "_n_odd", "_n_runs",
        F.size(w).cast("bigint").alias("_n"),
        F.length(F.array_join(w, "")).cast("bigint").alias("_word_chars"),
        F.size("_lines").cast("bigint").alias("_n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("_n_dup_lines"),
        F.when(
            F.size(w) >= WINDOW,
            F.transform(
                F.sequence(F.lit(0), F.size(w) - WINDOW),
                lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW)]),
            ),
        ).otherwise(F.array().cast("array<bigint>")).alias("_windows"),
    )
    return _with_repeat_words(counted)


@dataclass(frozen=True)
class VoteModel:
    """Prior of good, and per rule the chance of a good vote on good and of a bad vote on bad documents."""

    prior: float
    on_good: dict[str, float]
    on_bad: dict[str, float]

    def posterior(self) -> Column:
        odds = F.lit(log(self.prior / (1 - self.prior)))
        for name, good in self.on_good.items():
            bad, vote = self.on_bad[name], F.col(f"_vote_{name}")
            odds = odds + F.when(vote == 1, F.lit(log(good / (1 - bad)))).when(
                vote == 0, F.lit(log((1 - good) / bad))
            ).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-odds))


def _within(x: float, low: float, high: float) -> float:
    return min(max(x, low), high)


def fit_votes(voted: DataFrame, names: list[str], rounds: int = 20, tolerance: float = 1e-3) -> VoteModel:
    """Expectation-maximisation over the counts of vote patterns of all rows.

    A rule may miss most bad documents, as each looks for one fault only, but is
    held to blame at most one good document in fifty: that fixes which side is
    "good" and keeps faults that never meet in one document both bad. Parameters are rounded to nine places, so the order of a sum
    does not show. An empty table gives the starting model.
    """
    columns = [f"_vote_{n}" for n in names]
    patterns = pin(voted.groupBy(*columns).agg(F.count("*").alias("_rows")), "votes")
    model = VoteModel(0.8, {n: 0.99 for n in names}, {n: 0.4 for n in names})
    for _ in range(rounds):
        good = model.posterior()
        seen = patterns.select(*columns, F.col("_rows"), (good * F.col("_rows")).alias("_good"))
        bad = F.col("_rows") - F.col("_good")
        sums = [F.sum("_rows").alias("all"), F.sum("_good").alias("good")]
        for n in names:
            vote = F.col(f"_vote_{n}")
            for label, side, what in (("gg", F.col("_good"), 1), ("gb", F.col("_good"), 0), ("bg", bad, 1), ("bb", bad, 0)):
                sums.append(F.sum(F.when(vote == what, side).otherwise(F.lit(0.0))).alias(f"{label}_{n}"))
        got = seen.agg(*sums).first().asDict()
        if not got["all"]:
            return model

        def share(label: str, n: str, low: float) -> float:
            hit, miss = got[f"{label}{label[0]}_{n}"], got[f"{label}{'b' if label == 'g' else 'g'}_{n}"]
            return round(_within((hit + 1.0) / (hit + miss + 2.0), low, 0.998), 9)

        on_good = {n: share("g", n, 0.98) for n in names}
        new = VoteModel(
            round(_within((got["good"] + 4.0) / (got["all"] + 5.0), 0.5, 0.98), 9),
            on_good,
            {n: share("b", n, 1.05 - on_good[n]) for n in names},
        )
        moved = [abs(new.prior - model.prior)]
        moved += [abs(getattr(new, k)[n] - getattr(model, k)[n]) for k in ("on_good", "on_bad") for n in names]
        model = new
        if max(moved) < tolerance:
            break
    return model


def quality_rules(
    docs: DataFrame, text: str = "text", keep_at: float = 0.5, min_words: int = 50, max_repeat_percent: int = 50
) -> DataFrame:
    """All rows with the base counts, ``base_failed``, ``posterior`` and ``kept``.

    ``kept`` is false where the base check fails, otherwise whether the
    posterior reaches ``keep_at``. Repeated rows are judged alike; a text that
    no rule votes on gets the prior. Columns of ``docs`` named like a result
    are replaced, all others but ``text`` are kept. An empty table gives an empty result.
    """
    used = rules()
    names = [r.name for r in used]
    results = [*BASE, "base_failed", "posterior", "kept"]
    carried = [c for c in docs.columns if c != text and c not in results]
    rows = docs.select(F.struct(F.lit(0).alias("_"), *carried).alias("_row"), F.col(text).alias("_text"))
    measured = pin(measures(rows, "_text").drop("_text"), "measures")
    voted = measured.select("*", *[r.vote().alias(f"_vote_{r.name}") for r in used])
    model = fit_votes(voted, names)
    n, repeats = F.col("_n"), F.col("_n_repeat_words")
    judged = voted.withColumn("_posterior", model.posterior()).withColumn(
        "_failed", (n < min_words) | (100 * repeats > max_repeat_percent * n)
    )
    return judged.select(
        *[F.col("_row")[c].alias(c) for c in carried],
        n.alias("n_words"), F.col("_word_chars").alias("word_chars"), F.col("_n_symbols").alias("n_symbols"),
        F.col("_n_dup_lines").alias("n_dup_lines"), repeats.alias("n_repeat_words"),
        F.col("_failed").alias("base_failed"), F.col("_posterior").alias("posterior"),
        (~F.col("_failed") & (F.col("_posterior") >= keep_at)).alias("kept"),
    )
