"""Ordered rules over the current state of a row, and rule sets that only add messages.

Two forms with the same meaning where both apply. `apply_rules` folds: each rule sees what the earlier ones
wrote. All rules go into one select, in which every state of a column has a name of its own that later
expressions refer to (lateral aliases), so the frame is analysed once, not once per rule, and no state is
written out twice. `accumulate` serves rule sets in which a rule can only add a message and turn the status to
ERROR: all conditions stand side by side in one projection.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.text import as_col, cat

MESSAGE_END = "####"  # fixed value: separates accumulated messages


State = Callable[[str], Column]


@dataclass(frozen=True)
class Rule:
    """`when` is a condition over columns that no earlier rule sets, or a function that gets the current state (column
    name -> Column) and returns the condition."""

    name: str
    when: Column | Callable[[State], Column]
    sets: Mapping[str, object] = field(default_factory=dict)
    message: Column | str | None = None
    replace_message: bool = False
    statuses: tuple[str, ...] | None = None

    def condition(self, state: State = F.col) -> Column:
        when = self.when if isinstance(self.when, Column) else self.when(state)
        return when if self.statuses is None else state("status_code").isin(*self.statuses) & when


def apply_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    now: dict[str, str] = {}
    made: list[Column] = []

    def state(name: str) -> Column:
        return F.col(now.get(name, name))

    for k, rule in enumerate(rules):
        made.append(rule.condition(state).alias(f"_hit_{k}"))
        hit = F.col(f"_hit_{k}")
        changed = {c: F.when(hit, as_col(v)).otherwise(state(c)) for c, v in rule.sets.items()}
        if rule.message is not None:
            text = cat(rule.message, MESSAGE_END)
            new = text if rule.replace_message else cat(state("status_message"), text)
            changed["status_message"] = F.when(hit, new).otherwise(state("status_message"))
        made += [value.alias(f"_{c}_{k}") for c, value in changed.items()]
        now |= {c: f"_{c}_{k}" for c in changed}
    return df.select("*", *made).select(*[state(c).alias(c) for c in df.columns])


def accumulate(df: DataFrame, rules: Sequence[Rule], open_statuses: Sequence[str] = ("PENDING", "ERROR")) -> DataFrame:
    """Append the messages of all rules that hit, in order, and set ERROR if any did."""
    texts = F.array_compact(F.array(*[F.when(r.condition(), cat(r.message, MESSAGE_END)) for r in rules]))
    checked = df.withColumn("_texts", F.when(F.col("status_code").isin(*open_statuses), texts))
    failed = F.size("_texts") > 0
    return checked.withColumns(
        {
            "status_message": F.when(
                failed, cat(F.col("status_message"), F.array_join("_texts", ""))
            ).otherwise(F.col("status_message")),
            "status_code": F.when(failed, "ERROR").otherwise(F.col("status_code")),
        }
    ).drop("_texts")
