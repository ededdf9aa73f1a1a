"""Quality rules learned as a decision list: sequential covering over threshold conjunctions.

Everything on the data is DataFrame expressions. The driver only sees counts: for each feature
and each of its thresholds, how many bad and good labelled rows lie on either side. A rule is
grown on two thirds of the labelled rows by the condition with the best FOIL gain, then pruned
on the last third by cutting conditions from its end. Rows that a rule covers are taken away
and the next one is grown. The list is emitted as one ordered ``CASE WHEN``.

* null text has no words; a text without words fails the base rule (fewer than 50 words)
* labels: null ids and ids with both labels are left out; without labels there are no rules
* rows that repeat an id are judged each; an empty table gives no rows
* columns of the input are kept by ``keep`` whatever their names; ``judged`` returns its own
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log2

from pyspark.sql import Column, DataFrame, functions as F

from galley.llm.common import Stage, boxed

SAMPLE = 40_000  # labelled rows that are used at most: those with the smallest hashes of their ids
CUTS = 24  # thresholds per feature and label
MAX_RULES, MAX_CONDITIONS = 8, 3
LEAST_PRECISION, LEAST_COVERED = 0.97, 4
MIN_WORDS, MAX_REPEATED = 50, 50  # the base rule: fewest words, percent of words in repeated windows

_SPACE = r"[\x20\x09-\x0D]+"
_P = "q__"  # prefix of helper columns
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
FEATURES = ["n_words", "mean_word", "symbol_share", "dup_line_share", "repeat_share", "unique_share", "upper_share", "bang_share"]


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        value = F.col(_P + self.feature)
        return value > F.lit(self.threshold) if self.above else value <= F.lit(self.threshold)

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:g}"


Rule = tuple[Condition, ...]


def _lacking(text: Column, pattern: str) -> Column:
    """How many characters of ``text`` the pattern matches."""
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def _repeated_words() -> Column:
    """Words inside three-word windows that occur twice or more in the text.

    Windows are sorted by hash with their places; equal neighbours are repeats; the places'
    spans are then added up without overlaps. ``n log n`` in the words of one text.
    """
    return F.expr(
        f"""
        aggregate(
          array_sort(transform(
            filter({_P}windows, (x, i) -> x.h = get({_P}windows, i - 1).h or x.h = get({_P}windows, i + 1).h),
            x -> x.i)),
          named_struct('n', 0L, 'end', 0),
          (s, i) -> named_struct('n', s.n + (i + 3 - greatest(s.end, i)), 'end', i + 3),
          s -> s.n)"""
    )


def with_features(docs: DataFrame) -> DataFrame:
    """Adds the base counts and the shares that rules may use, under prefixed names. No shuffle."""
    text = F.col(_P + "text")
    docs = docs.withColumn(_P + "text", F.coalesce(F.col("text").cast("string"), F.lit("")))
    docs = docs.withColumns({
        _P + "words": F.array_remove(F.split(text, _SPACE), ""),
        _P + "lines": F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
    })
    docs = docs.withColumns({
        _P + "n_words": F.size(_P + "words").cast("long"),
        _P + "word_chars": F.length(F.regexp_replace(text, _SPACE, "")).cast("long"),
        _P + "n_symbols": _lacking(text, r"[#*$%&|<>]+").cast("long"),
        _P + "n_dup_lines": (F.size(_P + "lines") - F.size(F.array_distinct(_P + "lines"))).cast("long"),
        _P + "n_lines": F.size(_P + "lines"),
        _P + "n_unique": F.size(F.array_distinct(_P + "words")),
        _P + "n_upper": _lacking(text, r"\p{Lu}+"),
        _P + "n_bang": _lacking(text, r"[!?]+"),
        _P + "windows": F.expr(
            f"""sort_array(transform(
                  if(size({_P}words) < 3, array(), sequence(0, size({_P}words) - 3)),
                  i -> named_struct('h', xxhash64({_P}words[i], {_P}words[i + 1], {_P}words[i + 2]), 'i', i)))"""
        ),
    })
    docs = docs.withColumn(_P + "n_repeat_words", _repeated_words().cast("long"))
    words, chars = F.greatest(_P + "n_words", F.lit(1)), F.greatest(_P + "word_chars", F.lit(1))
    docs = docs.withColumns({
        _P + "mean_word": F.col(_P + "word_chars") / words,
        _P + "symbol_share": F.col(_P + "n_symbols") / chars,
        _P + "dup_line_share": F.col(_P + "n_dup_lines") / F.greatest(_P + "n_lines", F.lit(1)),
        _P + "repeat_share": F.col(_P + "n_repeat_words") / words,
        _P + "unique_share": F.col(_P + "n_unique") / words,
        _P + "upper_share": F.col(_P + "n_upper") / chars,
        _P + "bang_share": F.col(_P + "n_bang") / chars,
        _P + "base_failed": (F.col(_P + "n_words") < MIN_WORDS)
        | (100 * F.col(_P + "n_repeat_words") > MAX_REPEATED * F.col(_P + "n_words")),
    })
    return docs.drop(*[_P + c for c in ("text", "words", "lines", "windows")])


def _labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Features of the labelled documents in the sample, with ``bad`` and ``fold`` (0, 1: grow, 2: prune)."""
    known = (
        labels.select("doc_id", "quality").dropna().groupBy("doc_id")
        .agg(F.min("quality").alias("lo"), F.max("quality").alias("hi")).filter("lo = hi")
        .select("doc_id", (F.col("lo") == 0).alias(_P + "bad"), F.xxhash64("doc_id").alias(_P + "hash"))
        .orderBy(_P + "hash", "doc_id").limit(SAMPLE)
    )
    # At most SAMPLE rows of 17 bytes: small enough to send to every task.
    rows = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")
    return with_features(rows).select(
        *[F.col(_P + f).cast("double").alias(_P + f) for f in FEATURES],
        F.col(_P + "bad").cast("int").alias("bad"), F.pmod(_P + "hash", F.lit(3)).alias("fold"),
    )


def _thresholds(rows: DataFrame) -> dict[str, list[float]]:
    """Quantiles of each feature among the bad and among the good rows."""
    shares = F.array(*[F.lit(i / CUTS) for i in range(CUTS + 1)])
    found: dict[str, set] = {f: set() for f in FEATURES}
    for r in rows.groupBy("bad").agg(*[F.percentile_approx(_P + f, shares, 10_000).alias(f) for f in FEATURES]).collect():
        for f in FEATURES:
            found[f] |= set(r[f])
    return {f: sorted(v) for f, v in found.items()}


def _tally(rows: DataFrame, cuts: dict[str, list[float]]) -> dict[str, list[tuple[int, int]]]:
    """For each feature, bad and good rows by the number of thresholds below the value."""
    pairs = F.array(*[F.struct(F.lit(f).alias("f"), F.col("bin_" + f).alias("bin")) for f in FEATURES])
    counted = (
        rows.select("bad", F.explode(pairs).alias("x")).groupBy("x.f", "x.bin").agg(F.sum("bad").alias("p"), F.count("*").alias("n")).collect()
    )
    out = {f: [(0, 0)] * (len(cuts[f]) + 1) for f in FEATURES}
    for r in counted:
        out[r["f"]][r["bin"]] = (r["p"], r["n"] - r["p"])
    return out


def _best(
    tally: dict[str, list[tuple[int, int]]], cuts: dict[str, list[float]], without: set[str] = frozenset()
) -> tuple[Condition | None, int, int]:
    """The condition with the best FOIL gain, with the bad and good rows that it leaves."""
    total_p, total_n = (sum(x[i] for x in tally[FEATURES[0]]) for i in (0, 1))
    best, found = 1e-9, (None, total_p, total_n)
    for f in FEATURES:
        if f in without:
            continue
        p = n = 0
        for at, t in enumerate(cuts[f]):
            p, n = p + tally[f][at][0], n + tally[f][at][1]
            for above, a, b in ((False, p, n), (True, total_p - p, total_n - n)):
                if a:
                    gain = a * (log2(a / (a + b)) - log2(total_p / (total_p + total_n)))
                    if gain > best:
                        best, found = gain, (Condition(f, above, t), a, b)
    return found


def _covers(rule: Rule) -> Column:
    out = F.lit(True)
    for c in rule:
        out = out & c.column()
    return out


def learn(docs: DataFrame, labels: DataFrame) -> list[Rule]:
    """The ordered rules; a document that meets one is rejected."""
    stage = Stage(docs.sparkSession, "rules")
    rows = stage.save(_labelled(docs, labels), "labelled")
    cuts = _thresholds(rows)
    bins = {
        "bin_" + f: sum((F.when(F.col(_P + f) > F.lit(t), 1).otherwise(0) for t in cuts[f]), F.lit(0)) for f in FEATURES
    }
    rows = stage.save(rows.withColumns(bins).repartition(2), "binned")
    rules: list[Rule] = []
    left, failed = F.lit(True), set()
    while len(rules) < MAX_RULES:
        rule: Rule = ()
        grow = rows.filter(left & (F.col("fold") < 2))
        for _ in range(MAX_CONDITIONS):
            condition, p, n = _best(_tally(grow.filter(_covers(rule)), cuts), cuts, set() if rule else failed)
            if condition is None:
                break
            rule = (*rule, condition)
            if not n:
                break
        if not rule:
            break
        # Prune: of all beginnings of the rule take the one that is best on the held-out rows.
        starts = [rule[: i + 1] for i in range(len(rule))]
        held, bad = F.col("fold") == 2, F.col("bad") == 1
        seen = rows.filter(left).agg(*[
            F.count(F.when(_covers(s) & side & kind, 1)).alias(f"{name}{i}")
            for i, s in enumerate(starts) for name, side, kind in
            (("p", held, bad), ("n", held, ~bad), ("gp", ~held, bad), ("gn", ~held, ~bad))
        ]).first()
        worth = [(seen[f"p{i}"] - seen[f"n{i}"]) / max(seen[f"p{i}"] + seen[f"n{i}"], 1) for i in range(len(starts))]
        at = max(range(len(starts)), key=lambda i: (worth[i], seen[f"p{i}"]))
        p, n = seen[f"p{at}"] + seen[f"gp{at}"], seen[f"n{at}"] + seen[f"gn{at}"]
        if p < LEAST_COVERED or p < LEAST_PRECISION * (p + n):
            failed.add(rule[0].feature)  # begin the next rule with another feature
            continue
        rules.append(starts[at])
        left = left & ~_covers(starts[at])
    stage.free()
    return rules


def rule_number(rules: list[Rule]) -> Column:
    """The number of the first rule that a row of ``with_features`` meets; 0 if none."""
    out = None
    for i, rule in enumerate(rules, 1):
        out = F.when(_covers(rule), i) if out is None else out.when(_covers(rule), i)
    return F.lit(0) if out is None else out.otherwise(0)


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, the base counts, ``base_failed, rule, kept`` for every document."""
    rules = learn(docs, labels)
    rows = with_features(docs.select("doc_id", "text"))
    rows = rows.withColumn("rule", rule_number(rules))
    return rows.select(
        "doc_id", *[F.col(_P + c).alias(c) for c in BASE], F.col(_P + "base_failed").alias("base_failed"), "rule",
        (~F.col(_P + "base_failed") & (F.col("rule") == 0)).alias("kept"),
    )


def keep(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that pass, with all their columns."""
    rules = learn(docs, labels)
    # A condition on a column that is not deterministic stays above the features; pushed below
    # them, it would be worked out from the text once for every mention.
    rows = with_features(boxed(docs)).withColumn(_P + "place", F.monotonically_increasing_id())
    passed = ~F.col(_P + "base_failed") & (rule_number(rules) == 0) & (F.col(_P + "place") >= 0)
    return rows.filter(passed).select("row.*")
