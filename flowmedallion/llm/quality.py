"""Quality rules: a decision list learned by sequential covering.

Each rule is a conjunction of thresholds on text statistics.  On a growing part of the
labelled rows a rule takes, condition by condition, the threshold with the best
information gain until it covers no good document; on the pruning part its last
conditions go again while that raises its worth.  Rules are added until none is precise
enough or no bad document is left uncovered.  The list becomes one ordered Spark
expression, ``when(rule 1, reject).when(rule 2, reject)...otherwise(keep)``.

Statistics of a text are whole-text counts.  Null and empty texts have zero everywhere.
Documents without a label are judged like all others; without any usable label the list is
empty and only the fixed base rule decides.  A document id labelled twice counts as bad if
any of its labels is.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowmedallion.llm.batches import append_columns, numbered, place, restored

FIT_ROWS = 20_000
"""Most labelled documents that are fitted on: those with the smallest id hashes."""
THRESHOLDS = 256
"""Cut points tried for each statistic, at equal steps of rank."""
PRECISION = 0.9
"""Least share of bad documents that a rule must cover among the pruning rows."""

BLOCK = 100
"""Words in which distinct words are counted, so that long texts compare with short ones."""

SPACES = b" \t\n\r\x0b\x0c"
SYMBOLS = b"#*$%&|<>"
CAPITALS = bytes(range(65, 91))

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MORE = ("n_lines", "n_capitals", "n_exclaims", "n_echoes", "n_distinct")
STATISTICS = BASE + MORE


def text_statistics(data: bytes | None) -> tuple[int, ...]:
    """The STATISTICS of one text: words, their code points, symbols, repeated lines, words in
    repeated 3-word windows; then lines with a word, capitals, exclamation marks, words equal
    to the word before, and words that are new in their block of BLOCK words."""
    if not data:
        return (0,) * len(STATISTICS)
    words = data.split()
    n = len(words)
    chars = len(data.decode(errors="replace")) - (len(data) - len(data.translate(None, SPACES)))
    lines = [line for line in data.split(b"\n") if line.strip()]
    windows = list(zip(words, words[1:], words[2:]))
    repeated = 0
    if len(set(windows)) < len(windows):
        times = Counter(windows)
        marked = bytearray(n)
        for i, window in enumerate(windows):
            if times[window] > 1:
                marked[i : i + 3] = b"\1\1\1"
        repeated = sum(marked)
    return (
        n, chars, len(data) - len(data.translate(None, SYMBOLS)), len(lines) - len(set(lines)), repeated,
        len(lines), len(data) - len(data.translate(None, CAPITALS)), data.count(b"!"),
        sum(map(bytes.__eq__, words, words[1:])), sum(len(set(words[i : i + BLOCK])) for i in range(0, n, BLOCK)),
    )


def with_statistics(df: DataFrame, text: str = "text") -> DataFrame:
    """Add the STATISTICS (long) of each text; columns called so are replaced."""

    def make() -> Callable:
        def work(texts: list[bytes | None]) -> list[pa.Array]:
            table = np.array([text_statistics(data) for data in texts], dtype=np.int64).reshape(-1, len(STATISTICS))
            return [pa.array(table[:, i]) for i in range(len(STATISTICS))]

        return work

    return append_columns(df, text, ", ".join(f"{name} long" for name in STATISTICS), make)


def shares() -> dict[str, Column]:
    """The quantities that rules may test, as expressions over the STATISTICS."""

    def over(top: str, bottom: str) -> Column:
        return F.coalesce(F.try_divide(F.col(top).cast("double"), F.col(bottom)), F.lit(0.0))

    return {
        "mean_word": over("word_chars", "n_words"),
        "symbol_share": over("n_symbols", "word_chars"),
        "dup_line_share": over("n_dup_lines", "n_lines"),
        "repeat_share": over("n_repeat_words", "n_words"),
        "capital_share": over("n_capitals", "word_chars"),
        "exclaim_share": over("n_exclaims", "n_words"),
        "echo_share": over("n_echoes", "n_words"),
        "distinct_share": over("n_distinct", "n_words"),
    }


def base_failed() -> Column:
    """Under 50 words, or over half of the words in repeated 3-word windows."""
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


@dataclass(frozen=True)
class Condition:
    name: str
    above: bool
    cut: float

    def column(self) -> Column:
        value = shares()[self.name]
        return value > self.cut if self.above else value <= self.cut

    def __str__(self) -> str:
        return f"{self.name} {'>' if self.above else '<='} {self.cut:.6g}"


@dataclass(frozen=True)
class RuleList:
    """Rejecting conjunctions in the order in which they are tried."""

    rules: tuple[tuple[Condition, ...], ...]

    def rule_number(self) -> Column:
        """The first rule that fits, from 1; 0 if none does."""
        out = None
        for number, rule in enumerate(self.rules, 1):
            fits = rule[0].column()
            for condition in rule[1:]:
                fits = fits & condition.column()
            out = F.when(fits, number) if out is None else out.when(fits, number)
        return F.lit(0) if out is None else out.otherwise(0)

    def rejects(self) -> Column:
        return self.rule_number() > 0

    def __str__(self) -> str:
        return "\n".join("reject if " + " and ".join(map(str, rule)) for rule in self.rules) + "\notherwise keep"


def grow(x: np.ndarray, bad: np.ndarray, cuts: list[np.ndarray]) -> list[tuple[int, bool, float]]:
    """Add the condition with the best gain until the rule covers no good row or nothing gains."""
    rule: list[tuple[int, bool, float]] = []
    inside = np.ones(len(bad), dtype=bool)
    while (~bad & inside).any():
        p, n = int((bad & inside).sum()), int((~bad & inside).sum())
        if not p:
            break
        best, before = (0.0, None), np.log2(p / (p + n))
        for j, points in enumerate(cuts):
            values = x[inside, j]
            order = np.argsort(values, kind="stable")
            place = np.searchsorted(values[order], points, side="right")  # rows at or below each cut
            low_p = np.concatenate([[0], np.cumsum(bad[inside][order])])[place]
            low_n = place - low_p
            for above, ps, ns in ((False, low_p, low_n), (True, p - low_p, n - low_n)):
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = np.where(ps > 0, ps * (np.log2(ps / (ps + ns)) - before), 0.0)
                k = int(np.argmax(gain)) if len(gain) else 0
                if len(gain) and gain[k] > best[0] + 1e-9:
                    best = (float(gain[k]), (j, above, float(points[k])))
        if best[1] is None:
            break
        rule.append(best[1])
        j, above, cut = best[1]
        inside &= (x[:, j] > cut) if above else (x[:, j] <= cut)
    return rule


def covered(x: np.ndarray, rule: list[tuple[int, bool, float]]) -> np.ndarray:
    inside = np.ones(len(x), dtype=bool)
    for j, above, cut in rule:
        inside &= (x[:, j] > cut) if above else (x[:, j] <= cut)
    return inside


def learn(x: np.ndarray, bad: np.ndarray, names: list[str], precision: float = PRECISION) -> RuleList:
    """Sequential covering over rows x with labels bad; every third row prunes, the others grow."""
    cuts = []
    for j in range(x.shape[1]):
        ranked = np.unique(np.quantile(x[:, j], np.linspace(0, 1, THRESHOLDS + 1), method="lower")) if len(x) else np.array([])
        cuts.append((ranked[:-1] + ranked[1:]) / 2)
    prunes = np.arange(len(bad)) % 3 == 2
    left = np.ones(len(bad), dtype=bool)
    rules = []
    while (bad & left & ~prunes).any():
        rule = grow(x[left & ~prunes], bad[left & ~prunes], cuts)
        if not rule:
            break
        px, pbad = x[left & prunes], bad[left & prunes]

        def worth(r: list) -> float:
            hit = covered(px, r)
            p, n = int((pbad & hit).sum()), int((~pbad & hit).sum())
            return (p - n) / (p + n) if p + n else -1.0

        rule = max((rule[:k] for k in range(len(rule), 0, -1)), key=worth)
        hit = covered(px, rule)
        if not hit.any() or (pbad & hit).sum() < precision * hit.sum():
            break
        rules.append(tuple(Condition(names[j], above, cut) for j, above, cut in rule))
        left &= ~covered(x, rule)
    return RuleList(tuple(rules))


def fit_rules(
    docs: DataFrame, labels: DataFrame, text: str = "text", fit_rows: int = FIT_ROWS, precision: float = PRECISION
) -> RuleList:
    """Learn rules from documents whose label ``quality`` is 0 or 1.

    At most ``fit_rows`` ids are drawn, so the join that finds their texts may broadcast
    them, and only their statistics reach the driver.
    """
    chosen = (
        labels.filter("doc_id is not null and quality in (0, 1)")
        .groupBy("doc_id")
        .agg(F.min("quality").alias("_good"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(fit_rows)
    )
    known = docs.select("doc_id", F.col(text).alias("text")).join(F.broadcast(chosen), "doc_id")
    quantities = shares()
    rows = (
        with_statistics(known)
        .filter(~base_failed())  # those are decided already
        .groupBy("doc_id", "_good")
        .agg(*[F.max(F.struct(*STATISTICS)).alias("s")])  # repeated ids: one row each
        .select("doc_id", "_good", "s.*")
        .select("doc_id", "_good", *[column.alias(name) for name, column in quantities.items()])
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(fit_rows)
        .toArrow()
        .to_pandas()
    )
    return learn(rows[[*quantities]].to_numpy(dtype=float), (rows["_good"] == 0).to_numpy(), [*quantities], precision)


def judge(docs: DataFrame, rules: RuleList, text: str = "text") -> DataFrame:
    """Add the STATISTICS, base_failed, rule (number of the rejecting rule, 0 for none) and kept."""
    return with_statistics(docs, text).withColumns(
        {"base_failed": base_failed(), "rule": rules.rule_number()}
    ).withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0))


def keep_good(docs: DataFrame, labels: DataFrame, text: str = "text") -> DataFrame:
    """The documents that pass base rule and learned rules, with the columns they had."""
    rules = fit_rules(docs, labels, text)
    return restored(judge(numbered(docs), rules, place(docs, text)).filter("kept"), docs)
