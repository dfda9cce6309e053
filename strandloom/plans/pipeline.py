"""Phases of enrichment: each derives from all facts so far; its new facts are added as a set difference.

A rule set that raises adds nothing and is reported, like a source that is absent.  Between phases the facts are written
to the shared folder, so plans stay small.  The counts close: initial + added = final.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..model import SPO, added, detect, union_frames
from ..storage import settle

log = logging.getLogger(__name__)
Rule = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Phase:
    """rules: name -> rule; needs: name -> sources that must be present for it."""

    name: str
    rules: Mapping[str, Rule]
    needs: Mapping[str, frozenset[str]] = field(default_factory=dict)
    least_sources: int = 0


@dataclass
class Account:
    """What happened: facts before and after, facts added by phase, and the rules that failed or were not run."""

    initial: int = 0
    added: dict[str, int] = field(default_factory=dict)
    failed: dict[str, str] = field(default_factory=dict)
    skipped: list[str] = field(default_factory=list)

    @property
    def final(self) -> int:
        return self.initial + sum(self.added.values())


def sources_present(triples: DataFrame, prefixes: Mapping[str, Sequence[str]]) -> set[str]:
    """Which sources have subjects; one row for each comes back."""
    rows = triples.select(detect(F.col("subject"), {k: list(v) for k, v in prefixes.items()}).alias("s")).distinct()
    return {r["s"] for r in rows.collect() if r["s"]}


def enrich(triples: DataFrame, phases: Sequence[Phase], prefixes: Mapping[str, Sequence[str]] | None = None) -> tuple[DataFrame, Account]:
    """All facts, and the account."""
    facts = settle(triples.select(*SPO).distinct(), "facts")
    account = Account(initial=facts.count())
    for phase in phases:
        here = sources_present(facts, prefixes) if prefixes else set()
        made = []
        for name, rule in phase.rules.items():
            wanted = phase.needs.get(name, frozenset())
            if prefixes and (len(here) < phase.least_sources or not wanted <= here):
                account.skipped.append(f"{phase.name}/{name}")
                continue
            try:
                made.append(settle(rule(facts).select(*SPO), f"rule-{name}"))
            except Exception as e:  # one rule's failure must not lose the others' facts
                log.exception("rule %s of phase %s failed", name, phase.name)
                account.failed[f"{phase.name}/{name}"] = str(e)
        new = settle(added(union_frames(made), facts), "added") if made else None
        account.added[phase.name] = new.count() if new is not None else 0
        if new is not None:
            facts = facts.unionByName(new)
    return facts, account
